"""Helpers shared by the operators of this subpackage: scratch tables, running totals, text batches."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dealscope.session import freed_shuffles

#: UTF-8 bytes of text that a Python helper handles at a time.
SLICE_BYTES = 4 << 20
#: Bytes of an Arrow batch between executor and Python worker, and Spark's setting for it with its default.
ARROW_BYTES = 8 << 20
ARROW_KEY, ARROW_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
#: The C library of this process; glibc alone has malloc_trim.
_LIBC = ctypes.CDLL(None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.  Unset is accepted in local mode only (tests, bench)."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="dealscope-llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def bound_batches(spark: SparkSession) -> None:
    """Hand texts to Python workers in batches of about ARROW_BYTES, unless the session names another size itself.

    Spark's default is 64 MB a batch, which executor and worker hold several times over."""
    if spark.conf.get(ARROW_KEY) == ARROW_DEFAULT:
        spark.conf.set(ARROW_KEY, str(ARROW_BYTES))


def new_path(spark: SparkSession, label: str) -> str:
    bound_batches(spark)
    return f"{shared_folder(spark)}/llm/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back: cuts lineage, survives lost executors; the
    job's shuffle files go when it ends."""
    path = new_path(df.sparkSession, label)
    with freed_shuffles(df.sparkSession):
        # Spark notes the setting when a DataFrame is made, so the one that is written is made in here
        df.select("*").write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables of this application; call it when no result is read any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        f"{shared_folder(spark)}/llm/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read_documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def add_global_start(table: DataFrame, total: str, part: str = "part", local: str = "local_start",
                     start: str = "start") -> DataFrame:
    """Add the global offset of every row of a materialised table.

    ``part`` numbers the partitions in global order, ``local`` is the running total before the row in its
    partition and ``total`` the row's own amount.  The bases hold one row per partition, so they are broadcast;
    their running sum is the only thing that one task computes alone.
    """
    ends = table.groupBy(part).agg(F.max(F.col(local) + F.col(total)).alias("_sum"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = ends.select(part, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    return table.join(F.broadcast(bases), part).withColumn(start, F.col("_base") + F.col(local)).drop("_base")


def sorted_parts(df: DataFrame, *order: Column | str) -> DataFrame:
    """Range-partition and sort by ``order``; ``part`` numbers the partitions in that order."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())


def partition_index() -> int:
    return TaskContext.get().partitionId()


def row_slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int | None = None) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that no slice holds much more text than ``limit`` (SLICE_BYTES); rows stay as they are."""
    limit = limit or SLICE_BYTES
    for batch in batches:
        if not batch.num_rows:
            continue
        begin, held = 0, 0
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        for i, n in enumerate(sizes.to_pylist()):
            if held and held + n > limit:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += n
        yield batch.slice(begin)
        del batch
        trim()


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int | None = None) -> Iterator[pa.RecordBatch]:
    """Slices of bounded text (see ``row_slices``) in which nulls in ``column`` are '' and its type is large_string."""
    return row_slices(map(partial(_filled, column=column), batches), column, limit)


def _filled(batch: pa.RecordBatch, column: str) -> pa.RecordBatch:
    # before slicing: some Arrow kernels misread what a cast makes of a sliced array
    at = batch.schema.get_field_index(column)
    text = pc.fill_null(batch.column(at).cast(pa.large_string()), "")
    return pa.RecordBatch.from_arrays(
        [text if i == at else c for i, c in enumerate(batch.columns)], names=batch.schema.names)


def trim() -> None:
    """Give freed memory back to the system: a worker lives on for other tasks, and both allocators would keep it."""
    pa.default_memory_pool().release_unused()
    if (give_back := getattr(_LIBC, "malloc_trim", None)) is not None:
        give_back(0)


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; pass another path to the operators where the package is not installed."""
    import public_tokenizers
    path = public_tokenizers.path(name)
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    return path
