"""Packing: concatenate all documents' tokens and cut them into fixed windows.

Two passes.  The first encodes every document once and writes its ids with the running token total inside its
partition.  The partition totals give each partition's base, so every document knows its global token offset
without a sort or a shuffle.  The second pass cuts at the multiples of the window length: a document that
crosses a cut yields one boundary record (piece) per window.

Edge cases: a null or empty text is the end id alone; repeated rows are packed once per row; a null doc_id is
kept; an empty table gives no piece; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealscope.llm import common
from dealscope.llm.tokens import word_encoder

WINDOW = 4096
END_ID = 2

ENCODED = "doc_id long, part int, local_start long, doc_tokens long, ids array<int>"
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def encode(docs: DataFrame, vocabulary: str, end_id: int, slice_bytes: int | None = None,
           as_bytes: bool = False) -> DataFrame:
    """Ids of every document (closed by ``end_id``) with its partition and the tokens before it there.

    With ``as_bytes`` the ids are little-endian 32-bit integers in one binary value: executors then copy them whole,
    where a list's readers and writers hold its levels and numbers once more and in ever larger arrays.  Every distinct
    chunk of a slice of texts is encoded once, so larger slices cost more memory and less time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, done = word_encoder(vocabulary), common.partition_index(), 0
        for batch in common.text_slices(batches, limit=slice_bytes):
            ids, offsets = encoder.batch(batch.column(1), end_id)
            n = np.diff(offsets)
            if as_bytes:
                ends = pa.py_buffer((4 * offsets).astype(np.int32))
                column = pa.Array.from_buffers(pa.binary(), len(n), [None, ends, pa.py_buffer(ids.astype("<i4", copy=False))])
            else:
                column = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(np.full(len(n), part, np.int32)), pa.array(done + offsets[:-1]),
                pa.array(n), column],
                names=["doc_id", "part", "local_start", "doc_tokens", "ids"])
            done += int(offsets[-1])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, ENCODED.replace("array<int>", "binary") if as_bytes else ENCODED)


def _held(column: pa.Array) -> memoryview:
    """Bytes of all values of a binary column, one after the other, in the reader's own buffer."""
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(column.buffers()[1], wide)[column.offset:column.offset + len(column) + 1]
    return memoryview(column.buffers()[2])[ends[0]:ends[-1]]


def cut(encoded: DataFrame, window: int, with_ids: bool) -> DataFrame:
    """Pieces of documents that know their global ``start``; their ids are bytes (see ``encode``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            begin, n = np.asarray(batch.column(1)), np.asarray(batch.column(2))
            view = _held(batch.column(3))
            first = np.cumsum(n) - n
            pieces = (begin + n - 1) // window - begin // window + 1
            row = np.repeat(np.arange(len(n)), pieces)
            number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            sequence = begin[row] // window + number
            start = np.maximum(sequence * window - begin[row], 0)
            length = np.minimum((sequence + 1) * window - begin[row], n[row]) - start
            at = first[row] + start
            crc = np.fromiter((zlib.crc32(view[4 * a:4 * (a + k)]) for a, k in zip(at.tolist(), length.tolist(),
                                                                                  strict=True)), np.int64, len(row))
            columns = [batch.column(0).take(pa.array(row)), pa.array(start), pa.array(length), pa.array(crc),
                       pa.array(n[row]), pa.array(sequence), pa.array(begin[row] + start - sequence * window)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:  # pieces of a document follow each other, so their ids do too
                cuts = np.concatenate((at, at[-1:] + length[-1:])).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.frombuffer(view, "<i4"))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)
            del batch, view, columns
            common.trim()

    return encoded.select("doc_id", "start", "doc_tokens", "ids").mapInArrow(
        run, PIECES + (", ids array<int>" if with_ids else ""))


def pack(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID, window: int = WINDOW,
         with_ids: bool = True) -> DataFrame:
    """Boundary records of the packed corpus: which ids of which document lie where in which sequence.

    Sequence k holds the ids [k * window, (k + 1) * window) of the concatenation; only the last may be short.
    With ``with_ids`` every piece carries its ids.
    """
    encoded = common.materialise(encode(docs, vocabulary or common.tokenizer_path("word_bpe_49k.json"), end_id,
                                        as_bytes=True), "pack")
    return cut(common.add_global_start(encoded, "doc_tokens"), window, with_ids)


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """Training rows (sequence_id, n_tokens, input_ids padded to ``window``, doc_ids and starts of its pieces).

    A group holds at most ``window`` ids, so no group grows with the data.
    """
    piece = F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "start", "ids"))).alias("p")
    ids = F.flatten(F.col("p.ids"))
    return pieces.groupBy("sequence_id").agg(piece).select(
        "sequence_id", F.size(ids).cast("long").alias("n_tokens"),
        F.concat(ids, F.array_repeat(F.lit(pad_id), F.lit(window) - F.size(ids))).alias("input_ids"),
        F.col("p.doc_id").alias("doc_ids"), F.col("p.start").alias("doc_starts"))
