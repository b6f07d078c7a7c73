"""End-to-end runs: incremental (C1) and full refresh (C2).

``run_incremental`` is the production entry point: read the current target
version, bring one date (the watermark) to the driver, extract, enrich,
materialise the enriched batch once (reliable checkpoint, so the upsert's
size checks and joins never recompute -- or re-pay -- the enrichment),
upsert and write the next version, then return the verification counts.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealscope.operators import enrich as en
from dealscope.operators import extract as ex
from dealscope.operators import upsert as up
from dealscope.plans.reporting import verification_counts
from dealscope.session import ensure_checkpoint_dir, freed_shuffles
from dealscope.settings import DEFAULT, Settings
from dealscope.sources.bucketed import BucketedTable, RunProperties
from dealscope.sources.target import VersionedTable, conform


@dataclass
class RunResult:
    watermark: _dt.date
    version: int
    batch_rows: int
    metrics: DataFrame
    #: rows per action (insert, update, unchanged); a table without buckets does not report them
    actions: dict[str, int] | None = None


def incremental_batch(source: DataFrame, watermark, settings: Settings = DEFAULT, backend="rule",
                      **infer_opts) -> DataFrame:
    """Extract + enrichment of the rows changed after ``watermark``."""
    return en.enrich(ex.extract(source, watermark, settings), settings, backend, **infer_opts)


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared ``spark.checkpoint.dir``: the data
    is computed once (and survives executor loss); later plans read it."""
    ensure_checkpoint_dir(df.sparkSession)
    with freed_shuffles(df.sparkSession):
        # Spark notes the setting when a DataFrame is made, so the one that is stored is made in here
        return df.select("*").checkpoint(eager=True)


def incremental_state(target: DataFrame, source: DataFrame, settings: Settings = DEFAULT, backend="rule",
                      watermark=None) -> DataFrame:
    """Side-effect-free form of one run: the next table state as a DataFrame
    (the enriched batch is materialised once, as in ``run_incremental``)."""
    wm = ex.watermark(target, settings) if watermark is None else watermark
    batch = materialize(conform(incremental_batch(source, wm, settings, backend)))
    return up.upsert(conform(target), batch)


def run_properties(settings: Settings, watermark: _dt.date | None, pipeline_type: str = "incremental") -> RunProperties:
    return RunProperties(settings.primary_model, settings.confidence_model, settings.business_label_model,
                         settings.prompt_version, pipeline_type, settings.quality_tier, watermark, settings.as_of)


def run_incremental(spark: SparkSession, source: DataFrame, table: VersionedTable,
                    settings: Settings = DEFAULT, backend="rule", max_failure_rate: float = 0.2,
                    before_commit=None, **infer_opts) -> RunResult:
    """Process the rows changed since the last run and write the next version.

    A ``BucketedTable`` rewrites only the buckets of changed keys and keeps
    the run's changes and properties with the version.  A level in which more
    than ``max_failure_rate`` of the model calls fail stops the run before the
    table is touched; a run that ends before its commit leaves the table as it
    was and can be started again."""
    ensure_checkpoint_dir(spark)
    if backend != "rule":
        infer_opts["max_failure_rate"] = max_failure_rate
    table.create_if_missing()
    version = table.current_version()
    target = table.read(version)
    wm = ex.watermark(target, settings)
    batch = conform(incremental_batch(source, wm, settings, backend, **infer_opts))
    up.assert_unique_keys(batch, "usecase_id")
    # Materialise the enriched batch in the shared checkpoint folder: it is
    # read several times below, and an executor loss must not recompute it.
    batch = materialize(batch)
    actions = None
    if isinstance(table, BucketedTable):
        merged = table.merge(batch, version, run_properties(settings, wm), before_commit)
        n, new_version, actions = merged.batch_rows, merged.version, merged.actions
    else:
        n = batch.count()
        new_version = table.write_next(up.upsert(target, batch), expected_version=version)
    metrics = verification_counts(table.read(new_version), settings)
    return RunResult(wm, new_version, n, metrics, actions)


def full_refresh(source: DataFrame, settings: Settings = DEFAULT, backend="rule", **infer_opts) -> DataFrame:
    """Wide table: every in-scope source row with all columns, defaults,
    the staleness flag and all enrichment columns (one chain, each stage
    evaluated once per row).  Its assessment also reads the urgency column."""
    settings = replace(settings, urgency_input=True)
    scope = ex.full_refresh_extract(source, settings)
    return en.enrich(scope, settings, backend, keep_inputs=True, **infer_opts)


def bootstrap_from_wide(wide: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Target rows seeded from an older wide table (processing date = as_of - 1)."""
    return conform(up.bootstrap(wide, en.ENRICHED_COLUMNS, settings.as_of))


FIXTURE_CUT_DATE = _dt.date(2001, 6, 1)
FIXTURE_SYNC_DATE = _dt.date(2001, 4, 1)


def fixture_target_v0(source: DataFrame, watermark: _dt.date, settings: Settings = DEFAULT) -> DataFrame:
    """Target "version 0" for tests: the state left by an earlier sync.

    It holds the enriched in-scope rows changed up to ``FIXTURE_CUT_DATE``,
    processed on ``watermark``, with change dates as the earlier sync saw
    them (capped at ``FIXTURE_SYNC_DATE``).  Against the next batch (rows
    changed after ``watermark``) this gives every outcome by date alone:
    kept (changed before the watermark), unchanged (equal dates), updated
    (source changed after the sync date) and inserted (after the cut)."""
    scope = ex.extract(source, None, settings)
    e = en.enrich(scope, settings).where(F.col("last_modified_date") <= F.lit(FIXTURE_CUT_DATE))
    return conform(e.withColumns({
        "last_modified_date": F.least(F.col("last_modified_date"), F.lit(FIXTURE_SYNC_DATE)),
        "processed_date": F.lit(watermark),
    }))
