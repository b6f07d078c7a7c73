"""A versioned target laid out by hash buckets of its key.

A version's folder holds only the buckets that its run rewrote, each whole,
as ``v=00000003/bucket=17``.  The state of a version takes every bucket from
the newest version up to it that holds the bucket: files of untouched
buckets are never copied, read or listed by a run, so a run reads and writes
in proportion to its batch, whatever the table's size.

Beside the data, each version keeps the rows it changed (``changes/``, with
pre- and post-images) and one row of run properties (``properties/``).  Both
are written before the version is committed and count only with it.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import astuple, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealscope.operators import upsert as up
from dealscope.session import freed_shuffles
from dealscope.sources.target import VersionedTable, conform

BUCKETS = 64
CHANGE_TYPE, VERSION = "_change_type", "_version"
PROPERTIES = T.StructType([
    T.StructField("primary_model", T.StringType(), metadata={"comment": "Model of the summaries and classes"}),
    T.StructField("confidence_model", T.StringType(), metadata={"comment": "Model of the assessment"}),
    T.StructField("business_label_model", T.StringType(), metadata={"comment": "Model of the business label"}),
    T.StructField("prompt_version", T.StringType(), metadata={"comment": "Version of the prompt wording"}),
    T.StructField("pipeline_type", T.StringType(), metadata={"comment": "Kind of run: incremental or full"}),
    T.StructField("quality_tier", T.StringType(), metadata={"comment": "Data quality tier of the table"}),
    T.StructField("watermark", T.DateType(), metadata={"comment": "Source rows changed after it were read"}),
    T.StructField("as_of", T.DateType(), metadata={"comment": "Processing date of the run"}),
    T.StructField("batch_rows", T.LongType(), metadata={"comment": "Rows the run offered to the table"}),
])


@dataclass(frozen=True)
class RunProperties:
    """What is known of the run that wrote a version."""

    primary_model: str | None = None
    confidence_model: str | None = None
    business_label_model: str | None = None
    prompt_version: str | None = None
    pipeline_type: str | None = None
    quality_tier: str | None = None
    watermark: _dt.date | None = None
    as_of: _dt.date | None = None


@dataclass
class MergeResult:
    version: int
    batch_rows: int
    read_buckets: list[int] = field(default_factory=list)
    written_buckets: list[int] = field(default_factory=list)
    #: rows per action: insert, update, unchanged
    actions: dict[str, int] = field(default_factory=dict)


class BucketedTable(VersionedTable):
    """``buckets`` is fixed when the table is created; choose it so that one
    bucket stays within some hundred megabytes."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | None = None, key: str = "usecase_id",
                 date_col: str = "last_modified_date", buckets: int = BUCKETS):
        super().__init__(spark, path, schema)
        self.key, self.date_col, self.buckets = key, date_col, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    # -- reading ------------------------------------------------------------

    def _is_whole(self, version: int) -> bool:
        return self._fs().exists(self._path(self._folder(version) + "/_WHOLE"))

    def _held(self) -> list[int]:
        """Committed versions, and expired ones of which a later version still takes buckets."""
        fs = self._fs()
        return [v for v in self._numbers(self.path, "v=")
                if any(fs.exists(self._path(f"{self._folder(v)}/{m}")) for m in ("_SUCCESS", "_EXPIRED"))]

    def layout(self, version: int | None = None) -> dict[int, int]:
        """bucket -> the version whose folder holds it, by folder names alone."""
        upto = self.current_version() if version is None else version
        found: dict[int, int] = {}
        for v in reversed([v for v in self._held() if v <= upto]):
            for b in self._numbers(self._folder(v), "bucket="):
                found.setdefault(b, v)
            if self._is_whole(v):
                break
        return found

    def read_buckets(self, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The table's columns and ``bucket``.  With ``buckets`` only their folders are listed and read."""
        layout = self.layout(version)
        wanted = sorted(layout if buckets is None else set(layout) & set(buckets))
        if not wanted:
            return self.spark.createDataFrame([], T.StructType([*self.schema, T.StructField("bucket", T.IntegerType())]))
        df = (self.spark.read.schema(self.schema).option("basePath", self.path)
              .parquet(*[f"{self._folder(layout[b])}/bucket={b}" for b in wanted]).drop("v"))
        return df if buckets is None else df.where(F.col("bucket").isin(wanted))

    def read(self, version: int | None = None) -> DataFrame:
        return self.read_buckets(version).drop("bucket")

    # -- writing ------------------------------------------------------------

    def _write_rows(self, rows: DataFrame, version: int) -> None:
        """Rows with their bucket; a bucket's rows meet in few files, and AQE splits what is too large for one."""
        rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in self.schema], "bucket")
        self._write(rows.hint("rebalance", "bucket"), self._folder(version), "bucket")

    def _write_whole(self, df: DataFrame, version: int) -> int:
        self._write_rows(conform(df, self.schema).withColumn("bucket", self.bucket()), version)
        self._create(self._folder(version) + "/_WHOLE")  # older buckets do not shine through
        return version

    def merge(self, batch: DataFrame, expected_version: int | None = None, properties: RunProperties | None = None,
              before_commit=None) -> MergeResult:
        """Newer-wins upsert of ``batch`` (unique keys, the table's columns) as the next version.

        The batch's keys name the buckets to look at; of these, the ones with
        an insert or update are written again, whole, into the new version.
        ``before_commit(version)`` is called when all files are written and
        nothing counts yet; what it raises leaves the table as it was.
        The classified batch lies in a folder of its own while the merge runs.
        """
        work = f"{self.path}/work/{uuid.uuid4().hex}"
        try:
            with freed_shuffles(self.spark):
                return self._merge(batch, work, expected_version, properties, before_commit)
        finally:
            self._fs().delete(self._path(work), True)

    def _merge(self, batch: DataFrame, work: str, expected_version: int | None, properties: RunProperties | None,
               before_commit) -> MergeResult:
        current = self._expected(expected_version)
        rows = conform(batch, self.schema).withColumn("bucket", self.bucket())
        read = sorted(r.bucket for r in rows.select("bucket").distinct().collect())  # at most ``buckets`` numbers
        target = self.read_buckets(current, read)
        # batch-sized, read several times below; a column that a reader does not need is not read
        found = up.classify_batch(target, rows, self.key, self.date_col)
        self._write(found, work)
        classified = self.spark.read.schema(found.schema).parquet(work)
        counts = {r["_action"]: r["count"] for r in classified.groupBy("_action").count().collect()}
        winners = classified.where(F.col("_action") != "unchanged")
        written = sorted(r.bucket for r in winners.select("bucket").distinct().collect())
        updated = winners.where(F.col("_action") == "update").select(self.key)

        version = self._claim(current)
        if written:
            kept = self.read_buckets(current, written).join(updated, self.key, "left_anti")
            self._write_rows(kept.unionByName(winners.drop("_action")), version)
            self._write(self._feed(target, winners, updated), f"{self.path}/changes/v={version:08d}")
        self._fs().mkdirs(self._path(self._folder(version)))  # a run without changes is a version too
        row = (*astuple(properties or RunProperties()), sum(counts.values()))
        self._write(self.spark.createDataFrame([row], PROPERTIES).coalesce(1), f"{self.path}/properties/v={version:08d}")
        if before_commit is not None:
            before_commit(version)
        self._commit(version, current if self.exists() else None)
        return MergeResult(version, sum(counts.values()), read, written, counts)

    def _feed(self, target: DataFrame, winners: DataFrame, updated: DataFrame) -> DataFrame:
        columns = [f.name for f in self.schema]
        after = winners.select(*columns, F.when(F.col("_action") == "insert", F.lit("insert"))
                               .otherwise(F.lit("update_postimage")).alias(CHANGE_TYPE))
        before = target.join(updated, self.key, "left_semi").select(*columns, F.lit("update_preimage").alias(CHANGE_TYPE))
        return after.unionByName(before)

    # -- change feed and run properties -------------------------------------

    def _beside(self, folder: str, after: int | None = None, upto: int | None = None) -> list[int]:
        kept = {v for v in self.versions() if (after is None or v > after) and (upto is None or v <= upto)}
        return [v for v in self._numbers(f"{self.path}/{folder}", "v=") if v in kept]

    def _read_beside(self, folder: str, versions: list[int], schema: T.StructType) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], T.StructType([*schema, T.StructField(VERSION, T.LongType())]))
        base = f"{self.path}/{folder}"
        df = self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/v={v:08d}" for v in versions])
        return df.withColumn(VERSION, F.col("v").cast("long")).drop("v")

    def changes(self, after: int | None = None, upto: int | None = None) -> DataFrame:
        """The stored changes of the versions in (after, upto], with their version; no state is read or compared.
        A version that replaced the whole table stores none."""
        schema = T.StructType([*self.schema, T.StructField(CHANGE_TYPE, T.StringType())])
        return self._read_beside("changes", self._beside("changes", after, upto), schema)

    def net_changes(self, after: int | None = None, upto: int | None = None) -> DataFrame:
        """What the changes of (after, upto] come to: per key its state before (if it was there) and after.

        Several changes of a key collapse: a key inserted and then updated is
        one insert of its last state, a key updated twice one update from the
        first pre-image to the last post-image.
        """
        per_key = Window.partitionBy(self.key)
        old = F.col(CHANGE_TYPE) == "update_preimage"
        feed = self.changes(after, upto).withColumns({
            "_first": F.min(VERSION).over(per_key), "_last": F.max(VERSION).over(per_key),
            "_new": F.max(F.col(CHANGE_TYPE) == "insert").over(per_key)})
        before = feed.where(old & (F.col(VERSION) == F.col("_first")) & ~F.col("_new"))
        after_ = feed.where(~old & (F.col(VERSION) == F.col("_last"))).withColumn(
            CHANGE_TYPE, F.when(F.col("_new"), F.lit("insert")).otherwise(F.lit("update_postimage")))
        columns = [*[f.name for f in self.schema], CHANGE_TYPE, VERSION]
        return before.select(*columns).unionByName(after_.select(*columns))

    def properties(self) -> DataFrame:
        """One row per version that a merge wrote: the properties of its run."""
        return self._read_beside("properties", self._beside("properties"), PROPERTIES)

    def rows_per_version(self) -> DataFrame:
        """Per version that a merge wrote: its run's properties and the rows it inserted and updated."""
        counted = self.changes().groupBy(VERSION).agg(
            F.count_if(F.col(CHANGE_TYPE) == "insert").alias("inserted"),
            F.count_if(F.col(CHANGE_TYPE) == "update_postimage").alias("updated"))
        return self.properties().join(counted, VERSION, "left").na.fill(0, ["inserted", "updated"])

    def expire(self, keep: int = 2) -> list[int]:
        """Delete what the newest ``keep`` versions do not need; returns the versions that can no longer be read.

        Buckets that a kept version still takes from an old folder stay, and
        so does that folder; the changes and properties of old versions go."""
        versions = self.versions()
        old, kept = (versions[:-keep], versions[-keep:]) if keep > 0 else ([], versions)
        needed = {(v, b) for k in kept for b, v in self.layout(k).items()}
        fs = self._fs()
        for v in [v for v in self._held() if v not in kept]:
            # first no version any more, then fewer buckets: a reader never meets half of one
            self._create(self._folder(v) + "/_EXPIRED")
            fs.delete(self._path(self._folder(v) + "/_SUCCESS"), False)
            buckets = self._numbers(self._folder(v), "bucket=")
            if any((v, b) in needed for b in buckets):
                for b in buckets:
                    if (v, b) not in needed:
                        fs.delete(self._path(f"{self._folder(v)}/bucket={b}"), True)
            else:
                fs.delete(self._path(self._folder(v)), True)
            for folder in ("changes", "properties"):
                fs.delete(self._path(f"{self.path}/{folder}/v={v:08d}"), True)
        return old
