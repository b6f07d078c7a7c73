"""Toxicity: a character n-gram linear classifier whose features are scaled by naive Bayes log-count ratios.

A text's features are the distinct hashed character n-grams of the whole lower-cased text.  Feature f is scaled by
r(f) = log of its smoothed share among toxic texts' features over its share among the others'; a logistic model
with an L2 penalty is fitted on the scaled features, and its weights times r give one weight per n-gram, so scoring
adds the weights of the n-grams present.  The model is fitted on about ``SAMPLE`` labelled rows of the learning
fold at most, equal shares of both classes as far as they go, weighted back to the classes' sizes: labels are drawn by
a hash of doc_id, and where ids repeat their documents by a hash of doc_id and text.  The n-grams' counts are summed
first, and only n-grams with a scale go to the trainer's task.  Every text is scored whole.

Edge cases: null and empty texts have no n-grams but the padding and get the model's score for that; labels that
are null or belong to no document are ignored; several labels of a document count once each; with no label, or one
class only, the score is that class's share (0 without labels); an n-gram in fewer than ``LEAST_TEXTS`` learned texts
has no scale, so with one or two toxic rows every score is near their share; repeated documents are scored per row; an empty
table gives no row; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope.llm import common, sampling
from dealscope.llm.linear import Distinct, fit, presence, sigmoid

ORDERS = (3, 4, 5)
BITS = 18
#: Bound of the labelled rows that the model is fitted on.
SAMPLE = 8000
#: Features with a smaller scale, or in fewer sampled texts, carry no signal and get weight 0.
LEAST_SCALE = 0.7
LEAST_TEXTS = 3


def scales(sample: DataFrame) -> np.ndarray:
    """The scale of every feature, from a sample (label, ids); 0 for those without signal."""
    size = 1 << BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, size), np.int32)
        for batch in batches:
            for label, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[int(label > 0.5)][np.frombuffer(ids, np.int32)] += 1  # a text's ids are distinct
        if seen.any():
            yield pa.RecordBatch.from_arrays([pa.array([seen.tobytes()], pa.binary())], names=["seen"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, size), np.int64)
        for batch in batches:
            for x in batch.column(0):
                seen += np.frombuffer(x.as_buffer(), np.int32).reshape(2, size)
        yield pa.RecordBatch.from_arrays([pa.array([seen.astype(np.int32).tobytes()], pa.binary())], names=["seen"])

    row = sample.mapInArrow(count, "seen binary").repartition(1).mapInArrow(total, "seen binary").first()
    clean, toxic = np.frombuffer(row.seen, np.int32).reshape(2, size) if row else np.zeros((2, size), np.int32)
    p, q = toxic + 1, clean + 1
    scale = np.log((p / p.sum()) / (q / q.sum()))
    scale[(np.abs(scale) < LEAST_SCALE) | (toxic + clean < LEAST_TEXTS)] = 0
    return scale.astype(np.float32)


def fit_model(labels: list, ids: np.ndarray, offsets: np.ndarray, scale: np.ndarray, sizes: tuple[int, int]) -> bytes:
    """One float32 weight per feature and the bias; ``sizes`` are the classes' labels, of which the rows are a sample."""
    y = np.array(labels, dtype=float)
    size = 1 << BITS
    share = y.mean() if len(y) else 0.0
    if not 0 < share < 1:
        return np.append(np.zeros(size), 30.0 if share else -30.0).astype("<f4").tobytes()
    drawn = np.bincount((y > 0.5).astype(int), minlength=2)
    weight = (np.array(sizes) / np.maximum(drawn, 1))[(y > 0.5).astype(int)]
    w, bias = fit(ids, offsets, scale[ids], y, weight, size, "logistic", l2=1e-4, steps=120, rate=0.05)
    return np.append(w * scale, bias).astype("<f4").tobytes()


def learn(docs: DataFrame, labels: DataFrame, keep: Column, sample: int = SAMPLE) -> bytes:
    """The model, from labelled documents for which ``keep`` holds."""
    marked = labels.where(keep & F.col("toxic").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    toxic = F.col("label") > 0.5
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def shares(rows: DataFrame) -> tuple[tuple[int, int], Column]:
        """The sizes of both classes, and the share to draw of each: halves, or all of a class that is smaller."""
        found = dict(rows.groupBy(toxic.cast("int").alias("c")).count().collect())
        n = found.get(0, 0), found.get(1, 0)
        quota = [max(sample / 2, sample - other) for other in reversed(n)]
        part = [min(1.0, q / max(x, 1)) for q, x in zip(quota, n, strict=True)]
        return n, F.when(toxic, F.lit(part[1])).otherwise(F.lit(part[0]))

    sizes, share = shares(marked)
    # of bounded size, hence broadcast: texts are not shuffled for the join
    drawn = F.broadcast(marked.where(sampling.draw(share)))
    _, again = shares(texts.select("doc_id").join(drawn, "doc_id"))  # below 1 where documents repeat an id
    rows = texts.join(drawn, "doc_id").where(sampling.draw(again, "text")).select("label", "text")
    found = common.materialise(sampling.features(rows, ORDERS, BITS, lower=True), "toxic_sample")
    scale = scales(found)

    def fitter(labels: list, ids: np.ndarray, offsets: np.ndarray) -> bytes:
        return fit_model(labels, ids, offsets, scale, sizes)

    return sampling.train(sampling.scaled(found, scale != 0), fitter)


def score(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.frombuffer(shared.value, "<f4").astype(np.float64)
        distinct = Distinct(BITS)
        for batch in common.text_slices(batches):
            out = [sigmoid(weights[presence(t.lower(), ORDERS, BITS, distinct)].sum() + weights[-1])
                   for t in batch.column(-1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.float64())],
                                             names=[*batch.schema.names[:-1], "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, fold: int = 5, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted; rows whose id's checksum is 0 modulo ``fold`` are never learned from."""
    model = learn(docs, labels, sampling.remainder(fold) != 0, sample)
    return score(docs, model).select("doc_id", (sampling.remainder(fold) == 0).alias("held_out"), "score",
                                     (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, limit: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """The documents whose score is below ``limit``, with all their columns; one pass, no join."""
    model = learn(docs, labels, F.lit(True), sample)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.frombuffer(shared.value, "<f4").astype(np.float64)
        distinct = Distinct(BITS)
        for batch in common.row_slices(batches):
            text = batch.column(batch.schema.get_field_index("text")).to_pylist()
            ok = [sigmoid(weights[presence((t or "").lower(), ORDERS, BITS, distinct)].sum() + weights[-1]) < limit
                  for t in text]
            yield batch.filter(pa.array(ok, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
