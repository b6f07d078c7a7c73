"""MERGE semantics on plain DataFrames: newer-wins upsert, outcome
accounting, change feed and bootstrap.

Scale notes: the target can be large, the batch is the incremental slice.
The target is only touched through (a) a semi join that keeps the target
keys present in the batch (build side: batch keys), and (b) one anti join
that drops replaced rows (build side: winning keys).  Both build sides are
batch-sized; whether they are broadcast is left to Spark, which compares
their bytes (estimated, or measured by AQE after their exchange) with
``autoBroadcastJoinThreshold``.  The target's payload columns are never
shuffled through a full-outer join.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def assert_unique_keys(batch: DataFrame, key: str) -> None:
    dup = batch.groupBy(key).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"batch has duplicate key {dup[0][key]!r}: a MERGE source must be unique on {key}")


def classify_batch(target: DataFrame, batch: DataFrame, key: str = "usecase_id", date_col: str = "last_modified_date") -> DataFrame:
    """Batch rows with ``_action``: ``insert`` (key not in target),
    ``update`` (batch date strictly newer) or ``unchanged``."""
    # Semi-join build side: duplicates would not change the result, and batch
    # keys are unique by the MERGE contract, so no distinct() (no shuffle).
    bkeys = batch.select(key)
    matched = (target.select(key, F.col(date_col).alias("_t_date"), F.lit(True).alias("_in_t"))
               .join(bkeys, key, "left_semi"))
    j = batch.join(matched, key, "left")
    action = (F.when(F.col("_in_t").isNull(), F.lit("insert"))
              .when(F.col(date_col) > F.col("_t_date"), F.lit("update"))
              .otherwise(F.lit("unchanged")))
    return j.withColumn("_action", action).drop("_t_date", "_in_t")


def upsert(target: DataFrame, batch: DataFrame, key: str = "usecase_id", date_col: str = "last_modified_date") -> DataFrame:
    """New table state: matched rows whose batch date is newer are replaced
    whole, unmatched batch rows are inserted, everything else is kept.
    No deletes."""
    cols = target.columns
    cls = classify_batch(target, batch, key, date_col)
    winners = cls.where(F.col("_action") != "unchanged").select(*cols)
    wkeys = cls.where(F.col("_action") == "update").select(key)
    kept = target.join(wkeys, key, "left_anti")
    return kept.unionByName(winners)


def upsert_actions(target: DataFrame, batch: DataFrame, key: str = "usecase_id", date_col: str = "last_modified_date") -> DataFrame:
    """Outcome accounting of one upsert: rows per action."""
    return (classify_batch(target, batch, key, date_col)
            .groupBy(F.col("_action").alias("action")).agg(F.count(F.lit(1)).alias("n")))


def change_feed(target: DataFrame, batch: DataFrame, key: str = "usecase_id", date_col: str = "last_modified_date") -> DataFrame:
    """Changes produced by one upsert, with ``_change_type`` in {insert,
    update_preimage, update_postimage}: derived from the batch and the
    matched target rows only, never by diffing two full versions."""
    cols = target.columns
    cls = classify_batch(target, batch, key, date_col)
    post = cls.where(F.col("_action") != "unchanged").select(
        *cols, F.when(F.col("_action") == "insert", F.lit("insert"))
                .otherwise(F.lit("update_postimage")).alias("_change_type"))
    upd_keys = cls.where(F.col("_action") == "update").select(key)
    pre = target.join(upd_keys, key, "left_semi").select(*cols, F.lit("update_preimage").alias("_change_type"))
    return post.unionByName(pre)


def row_digest(columns: Sequence[str]) -> Column:
    """Checksum of a whole row; names are part of it, so a NULL in one column never looks like one in another."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def changed_keys(old: DataFrame, new: DataFrame, key: str = "usecase_id") -> DataFrame:
    """``key`` and ``_kind`` (insert, delete, update) of the rows that differ between two versions.

    Only keys and row digests meet in the full-outer join, whatever the width of the rows."""
    cols = new.columns
    o = old.select(F.col(key).alias("_old_key"), row_digest(cols).alias("_old_digest"))
    n = new.select(F.col(key).alias("_new_key"), row_digest(cols).alias("_new_digest"))
    j = o.join(n, F.col("_old_key").eqNullSafe(F.col("_new_key")), "full")
    kind = (F.when(F.col("_old_digest").isNull(), F.lit("insert")).when(F.col("_new_digest").isNull(), F.lit("delete"))
            .when(F.col("_old_digest") != F.col("_new_digest"), F.lit("update")))
    return (j.select(F.coalesce("_new_key", "_old_key").alias(key), kind.alias("_kind"))
            .where(F.col("_kind").isNotNull()))


def diff_versions(old: DataFrame, new: DataFrame, key: str = "usecase_id") -> DataFrame:
    """Generic change feed between two table versions, without any stored changes.

    The changed keys are found by digest and checkpointed; the payload is then
    fetched for these keys alone, from the old version for deletes and
    pre-images and from the new one for inserts and post-images.  Keys are
    unique in each version; a NULL key is a key like any other."""
    cols = list(new.columns)
    changed = changed_keys(old, new, key).checkpoint(eager=True)

    def fetch(side: DataFrame, gone: str, update: str) -> DataFrame:
        wanted = changed.where(F.col("_kind").isin(gone, "update")).select(
            F.col(key).alias("_key"), F.when(F.col("_kind") == "update", F.lit(update)).otherwise(F.lit(gone)).alias("_change_type"))
        return side.join(wanted, F.col(key).eqNullSafe(F.col("_key"))).select(*cols, "_change_type")

    return fetch(old, "delete", "update_preimage").unionByName(fetch(new, "insert", "update_postimage"))


def bootstrap(wide: DataFrame, columns, as_of: _dt.date, processed_col: str = "processed_date") -> DataFrame:
    """Seed rows for an empty target from an older wide table: project to the
    target columns, stamping the processing date as ``as_of - 1 day``."""
    stamp: Column = F.date_sub(F.lit(as_of), 1)
    return wide.select(*[stamp.alias(c) if c == processed_col else F.col(c) for c in columns])
