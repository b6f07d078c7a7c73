"""Token-ID output as ORC: integer run-length encoding, row indexes and Bloom filters on document ids.

Texts are range-partitioned and sorted by doc_id, encoded, and written by Spark's ORC writer in that order: file
i holds smaller ids than file i + 1, and ids rise inside each file.  ORC stores the id lists with its integer
run-length encoding, keeps minima and maxima per stripe and row group, and a Bloom filter on doc_id, so a point
or range read skips files, stripes and row groups; stripes are read in parallel.  Every row carries the tokens
before it in its file's partition; the partition totals, read back from the files, give the global offsets.

Edge cases: a null or empty text is the end id alone; a null doc_id sorts first; rows with the same doc_id are
ordered by text; an empty table writes no row; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealscope.llm import common
from dealscope.llm.packing import encode

END_ID = 1
#: UTF-8 bytes of text that are encoded at a time; one such slice is in a task's memory.
SLICE_BYTES = 8 << 20
SCHEMA = "doc_id long, part int, local_start long, n_tokens long, ids array<int>"
ORC_OPTIONS = {
    "orc.create.index": "true", "orc.row.index.stride": "2000", "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01", "orc.stripe.size": str(16 << 20), "compression": "zstd",
}


def write(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID) -> None:
    """Encode every text and write the ids in ascending doc_id order."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    laid = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    encoded = encode(laid, vocabulary or common.tokenizer_path("word_bpe_49k.json"), end_id, SLICE_BYTES)
    encoded.withColumnRenamed("doc_tokens", "n_tokens").write.options(**ORC_OPTIONS).orc(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (global token offset), n_tokens, ids."""
    table = spark.read.schema(SCHEMA).orc(path)
    return common.add_global_start(table, "n_tokens").select("doc_id", "start", "n_tokens", "ids")


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Rows of a few documents: the predicate reaches the reader, which skips by statistics and Bloom filters."""
    return spark.read.schema(SCHEMA).orc(path).where(F.col("doc_id").isin(doc_ids)).select("doc_id", "n_tokens", "ids")


def checksums(table: DataFrame) -> DataFrame:
    """ids_crc32 (unsigned, ids as little-endian unsigned 32-bit integers) in place of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            view = memoryview(np.asarray(batch.column(3).flatten()).view("<u4")).cast("B")  # the reader's own buffer
            ends = (4 * np.cumsum(np.asarray(batch.column(2)))).tolist()
            crc = [zlib.crc32(view[a:b]) for a, b in zip([0, *ends], ends, strict=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, pa.int64())],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return table.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")
