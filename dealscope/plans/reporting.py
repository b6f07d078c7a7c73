"""Reporting views over the target (C3, C4) and run checks (A3, A4, K2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealscope.functions.answers import SCORE_COLUMNS
from dealscope.operators import extract as ex
from dealscope.settings import ARCHITECT_DEFAULT, DEFAULT, FIELD_MANAGER_DEFAULT, Settings

# Columns of the reporting view up to the enrichment block, in view order
# (``usecase_id`` and ``num_of_blockers`` come from the target).
_SOURCE_HEAD = (
    "snapshot_date", "field_manager", "account_name", "usecase_id", "usecase_name", "last_modified_date",
    "account_executive", "account_solution_architect", "stage", "target_cloud", "primary_competitor",
    "target_live_date", "target_onboarding_date", "estimated_monthly_value", "usecase_description",
    "demand_plan_stage_next_steps", "implementation_notes", "sales_region", "sales_subregion_level_1",
    "sales_subregion_level_2", "sales_subregion_level_3", "sales_subregion_level_4", "sales_manager",
    "sales_leader", "field_leader", "use_case_product", "blockers_last_modified_date", "sdr_bdr_notes",
    "business_impact", "business_outcome_description", "ae_authority", "ae_money_budget", "business_unit",
    "num_of_blockers", "last_modified_blocker_category", "last_modified_blocker_comment", "competition_string",
)
_TEXT_BLOCK = ("context", "one_liner", "next_steps_summary", "implementation_notes_summary", "blockers_summary",
               "usecase_type", "business_usecase_type", "soundbyte")
_SCORE_BLOCK = ("ai_confidence_score_advanced", "confidence_score", "confidence_level",
                "rationale_for_confidence_score", *SCORE_COLUMNS, "confidence_level_normalized",
                "next_best_action_recommendation", "likely_to_slip", "slippage_category", "can_be_accelerated",
                "accel_category")
REPORTING_COLUMNS = (*_SOURCE_HEAD, *_TEXT_BLOCK, "is_stale", *_SCORE_BLOCK, "vertical")
RADAR_COLUMNS = tuple(c for c in REPORTING_COLUMNS if c != "soundbyte")

# Columns taken from the target rather than the source.
_FROM_TARGET = {"usecase_id", "num_of_blockers", *_TEXT_BLOCK, *_SCORE_BLOCK}


#: Source columns that a shown column is made of, where these are others than itself.
_MADE_OF = {"sales_region": ("sales_region", "business_unit"), "is_stale": ("last_modified_date",)}


def source_columns(columns) -> tuple[str, ...]:
    """Source columns that a view with these ``columns`` reads, the key and the filters' columns included."""
    shown = [m for c in columns if c not in _FROM_TARGET for m in _MADE_OF.get(c, (c,))]
    return tuple(dict.fromkeys(["usecase_id", *shown, ex.VALUE, "stage", "target_live_date"]))


def _joined(target: DataFrame, source: DataFrame, settings: Settings, columns=REPORTING_COLUMNS) -> DataFrame:
    """Target x source on the key, both cut to the columns that the view
    shows.  The source's keys meet the target's first: that predicate sinks
    below whatever derives the source's texts, so only rows of the target get
    theirs (a semi join would not: Spark takes none below a computed column).
    Spark chooses the joins by bytes: the narrower side is broadcast when its
    measured size allows, otherwise both are exchanged on the key."""
    t = target.select(*[c for c in target.columns if c == "usecase_id" or c in _FROM_TARGET and c in columns])
    src = source.sparkSession.sql("SELECT * FROM {source} WHERE usecase_id IN (SELECT usecase_id FROM {target})",
                                  source=source.select(*source_columns(columns)), target=target.select("usecase_id"))
    return t.join(src, "usecase_id", "inner")


def _present(j: DataFrame, settings: Settings, columns) -> DataFrame:
    out = {
        "field_manager": F.coalesce(F.col("field_manager"), F.lit(FIELD_MANAGER_DEFAULT)),
        "account_solution_architect": F.coalesce(F.col("account_solution_architect"), F.lit(ARCHITECT_DEFAULT)),
        "sales_region": ex.region_fallback(),
        "is_stale": ex.stale(settings),
        "vertical": ex.vertical_default(),
    }
    return j.select(*[out[c].alias(c) if c in out else F.col(c) for c in columns])


def reporting_view(target: DataFrame, source: DataFrame, settings: Settings = DEFAULT,
                   columns=REPORTING_COLUMNS) -> DataFrame:
    """Business view (65 columns): target enrichment re-joined to the source
    on the key, owner/region/vertical defaults, staleness flag, look-ahead
    filters (value, stage, live-date window; no recency floor).  With
    ``columns`` it shows these alone, and reads of the source what they need
    (``source_columns``)."""
    src = source.where(ex.lookahead(settings))  # pushed into the source scan
    return _present(_joined(target, src, settings, columns), settings, columns)


def radar_view(target: DataFrame, source: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Reporting projection without the soundbyte and without look-ahead filters."""
    return _present(_joined(target, source, settings, RADAR_COLUMNS), settings, RADAR_COLUMNS)


def verification_counts(target: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Six labelled counts in one scan (no six-way UNION of scans)."""
    lvl = F.col("confidence_level_normalized")
    agg = target.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("context").isNotNull()).alias("enriched"),
        F.count_if(F.col("confidence_score").isNotNull()).alias("scored"),
        F.count_if(lvl == "High").alias("high"),
        F.count_if(lvl == "Medium").alias("medium"),
        F.count_if(lvl == "Low").alias("low"),
    )
    return agg.select(F.stack(
        F.lit(6),
        F.lit("Total Records"), F.col("total"),
        F.lit("Records with AI Enrichment"), F.col("enriched"),
        F.lit("Records with Confidence Score"), F.col("scored"),
        F.lit("High Confidence"), F.col("high"),
        F.lit("Medium Confidence"), F.col("medium"),
        F.lit("Low Confidence"), F.col("low"),
    ).alias("metric", "count"))


def rows_per_run(target: DataFrame) -> DataFrame:
    return target.groupBy("processed_date").agg(F.count(F.lit(1)).alias("n"))


RECENT_COLUMNS = ("usecase_id", "one_liner", "confidence_score", "confidence_level_normalized", "usecase_type",
                  "business_usecase_type", "likely_to_slip", "slippage_category", "can_be_accelerated",
                  "accel_category", "last_modified_date", "processed_date")


def recent_top(target: DataFrame, settings: Settings = DEFAULT, n: int = 10) -> DataFrame:
    """Top-``n`` rows processed on ``as_of`` by score (a top-k report: the
    limit is the feature; planned as TakeOrderedAndProject)."""
    return (target.where(F.col("processed_date") == F.lit(settings.as_of))
            .select(*RECENT_COLUMNS)
            .orderBy(F.desc_nulls_last("confidence_score"), F.asc("usecase_id"))
            .limit(n))
