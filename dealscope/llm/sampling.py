"""Bounded samples of labelled rows for the trainers, and the task that trains on them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope.llm import common
from dealscope.llm.linear import Distinct, presence


def remainder(divisor: int) -> Column:
    """crc32 of the doc_id's text, modulo ``divisor``; a null doc_id counts as the text ''."""
    return F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % divisor


def draw(share: Column, *further: str) -> Column:
    """True for about ``share`` of the doc_ids, always the same ones; ``further`` columns tell rows of one id apart."""
    return (F.xxhash64("doc_id", *further, F.lit("sample")).bitwiseAND(F.lit((1 << 30) - 1)) / F.lit(float(1 << 30))) < share


def features(rows: DataFrame, orders: tuple[int, ...], bits: int, lower: bool) -> DataFrame:
    """label and distinct n-gram ids (binary, int32) of rows (label, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distinct = Distinct(bits)
        for batch in common.text_slices(batches):
            found = [presence(t.lower() if lower else t, orders, bits, distinct).tobytes()
                     for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["label", "ids"])

    return rows.select("label", "text").mapInArrow(run, rows.select("label").schema.simpleString()[7:-1].replace(
        ":", " ") + ", ids binary")


def scaled(sample: DataFrame, known: np.ndarray) -> DataFrame:
    """A sample (label, ids) with the ids for which ``known`` holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(x, np.int32) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[known[x]].tobytes() for x in ids], pa.binary())],
                                             names=["label", "ids"])

    return sample.mapInArrow(run, sample.schema)


def train(sample: DataFrame, fitter: Callable[[list, np.ndarray, np.ndarray], bytes]) -> bytes:
    """Run ``fitter(labels, ids, offsets)`` in one task over a sample of bounded size; the model comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, parts = [], []
        for batch in batches:
            labels += batch.column(0).to_pylist()
            parts += [np.frombuffer(x, np.int32) for x in batch.column(1).to_pylist()]
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        ids, at = np.empty(int(sizes.sum()), np.int32), 0
        while parts:  # every part is let go as soon as it is copied
            part = parts.pop()
            ids[len(ids) - at - len(part):len(ids) - at] = part
            at += len(part)
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        yield pa.RecordBatch.from_arrays([pa.array([fitter(labels, ids, offsets)], pa.binary())], names=["model"])

    # repartition, not coalesce: the scan and the features stay parallel, only the bounded sample meets in the task;
    # sorted so that the sums, and with them the model, come out the same each time
    row = sample.repartition(1).sortWithinPartitions("label", "ids").mapInArrow(run, "model binary").first()
    if row is None:  # no task runs on an empty sample
        return fitter([], np.zeros(0, np.int32), np.zeros(1, np.int64))
    return bytes(row.model)
