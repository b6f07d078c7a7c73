"""Sharding: global byte-size prefix sums, cut at equal targets into contiguous balanced shards.

Documents are laid out in ascending doc_id order (ties by checksum and size).  The narrow (id, size) rows are
range-partitioned and sorted; running sums inside each partition plus the bases from the partition totals give
every document its global byte position.  A document belongs to the shard that holds its middle byte, so a shard
differs from the target by at most one document at each end.  Texts never leave the scan.

Edge cases: a null text has size ``OVERHEAD`` and checksum 0, like an empty one; a null doc_id sorts first;
repeated rows follow each other; an empty table gives no row; other columns are ignored.  Shards may stay empty
when one document is larger than a shard's target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealscope.llm import common

SHARDS = 24
#: Bytes that a document costs besides its text.
OVERHEAD = 8


def shard(docs: DataFrame, shards: int = SHARDS, overhead: int = OVERHEAD) -> DataFrame:
    """doc_id, size, text_crc32, start (bytes before it), shard, slot (place in its shard)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
                         F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    order = ("doc_id", "text_crc32", "size")
    laid = common.materialise(common.sorted_parts(narrow, *order), "shard")
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = laid.select("*", (F.sum("size").over(inside) - F.col("size")).alias("local_start"),
                       (F.row_number().over(inside) - 1).cast("long").alias("local_row"))
    sums = laid.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    bases = sums.select(  # one row per partition
        "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base_row"), F.sum("bytes").over(whole).alias("all"))
    placed = common.materialise(rows.join(F.broadcast(bases), "part").select(
        "doc_id", "size", "text_crc32", (F.col("base") + F.col("local_start")).alias("start"),
        (F.col("base_row") + F.col("local_row")).alias("row"),
        F.expr(f"cast((2 * (base + local_start) + size) * {shards} div (2 * all) as int)").alias("shard")), "placed")
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first"))  # one row per shard
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "start", "shard", (F.col("row") - F.col("first")).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write the documents as one folder per shard, each in slot order.

    Every row is written once: rows of one doc_id, null included, are told apart by checksum and size, and rows that
    agree in these too take the slots of their group one by one.  Own columns named shard or slot are replaced.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = ("doc_id", "text_crc32", "size")
    plan = shard(docs, shards).select(*[F.col(c).alias(f"__{c}") for c in own], "shard", "slot")
    plan = plan.withColumn("__nth", F.row_number().over(Window.partitionBy(*[f"__{c}" for c in own]).orderBy("slot")))
    rows = docs.drop("shard", "slot").withColumns({
        "__own_doc_id": F.col("doc_id").cast("long"), "__own_text_crc32": F.crc32(F.encode(text, "UTF-8")),
        "__own_size": (F.octet_length(text) + F.lit(OVERHEAD)).cast("long")})
    rows = rows.withColumn("__own_nth", F.row_number().over(
        Window.partitionBy(*[f"__own_{c}" for c in own]).orderBy(F.lit(0))))
    same = [F.col(f"__own_{c}").eqNullSafe(F.col(f"__{c}")) for c in (*own, "nth")]
    rows.join(plan, same).select(*docs.drop("shard", "slot").columns, "shard", "slot") \
        .repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
