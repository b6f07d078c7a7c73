"""Quality classifier from weak labels: no hand labels are read.

Overlapping heuristic labellers vote good, bad or nothing on every document.  The votes of a document are one
pattern, and the corpus counts of the patterns (at most three to the power of the labellers) hold all that
expectation-maximisation needs: it estimates each labeller's accuracy on either class and the share of good
documents, over all documents.  The posterior of a drawn sample's patterns then labels a hashed linear scorer
(character n-grams and style buckets), which scores every whole text.

Edge cases: null and empty texts are scored as empty ones (every labeller but the length one abstains); repeated
documents count per row in the estimates; an empty table gives no row; other columns are never read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealscope.llm import common, sampling
from dealscope.llm.linear import Distinct, fit, presence, sigmoid

ORDERS = (2, 3)
BITS = 15
#: Style buckets are hashed into as many slots after the n-grams'.
STYLE = 512
#: Bound of the documents that the scorer is fitted on.
SAMPLE = 6000
SYMBOLS = re.compile(r"[#$%&*|{}<>=~^_@\\]")
#: What is taken for granted about every labeller: a complaint is at least this much likelier about a bad document.
#: Kinds of junk exclude each other, so that without it a rare kind's labellers may end up on the good side.
LIFT = 100

#: name, whether large values are good, value from which it votes bad, value from which it votes good.
LABELLERS = (
    ("words", True, 4, 30),
    ("symbols", False, 0.02, 0.004),
    ("capitals", False, 0.3, 0.12),
    ("repeats", False, 0.05, 0.01),
    ("bars", False, 0.05, 0.01),
    ("shouts", False, 0.1, 0.02),
    ("variety", True, 0.3, 0.6),
    ("line_variety", True, 0.6, 0.9),
)


def style(text: str) -> dict[str, float]:
    """What the labellers look at, over the whole text."""
    words = text.split()
    n = max(1, len(words))
    letters = sum(map(len, words)) or 1
    lines = [x for x in text.split("\n") if x.strip()]
    distinct = len(set(words))
    return {
        "words": float(len(words)),
        "symbols": len(SYMBOLS.findall(text)) / letters,
        "capitals": sum(1 for w in words if len(w) > 1 and w.isupper()) / n,
        "repeats": sum(1 for a, b in zip(words, words[1:], strict=False) if a == b) / n,
        "bars": words.count("|") / n,
        "shouts": text.count("!!") / n,
        "variety": distinct / n ** 0.8 if words else 0.0,  # distinct words grow slower than words
        "line_variety": len(set(lines)) / max(1, len(lines)),
    }


def votes(stats: dict[str, float]) -> str:
    """One character per labeller: + good, - bad, 0 no vote."""
    if not stats["words"]:
        return "-" + "0" * (len(LABELLERS) - 1)
    out = []
    for name, large_is_good, bad, good in LABELLERS:
        x = stats[name]
        if large_is_good:
            out.append("-" if x < bad else "+" if x >= good else "0")
        else:
            out.append("-" if x > bad else "+" if x <= good else "0")
    return "".join(out)


def vote_patterns(docs: DataFrame) -> DataFrame:
    """pattern, n: how often each combination of votes occurs in the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.text_slices(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([votes(style(t)) for t in batch.column(0).to_pylist()])], names=["pattern"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "pattern string") \
        .groupBy("pattern").agg(F.count("*").alias("n"))


def estimate(patterns: dict[str, int], steps: int = 200) -> tuple[float, np.ndarray, dict[str, float]]:
    """Expectation-maximisation over the pattern counts.

    Returns the share of good documents, each labeller's P(+ | good, votes) and P(+ | bad, votes) as a 2 x k
    array, and the posterior P(good) of every pattern.  It starts from the majority of the votes, which fixes
    which class is called good.
    """
    names = sorted(patterns)
    if not names:
        return 0.5, np.full((2, len(LABELLERS)), 0.5), {}
    n = np.array([patterns[p] for p in names], dtype=float)
    plus = np.array([[c == "+" for c in p] for p in names], dtype=float)
    minus = np.array([[c == "-" for c in p] for p in names], dtype=float)
    good = np.where(minus.sum(1) > 0, 0.1, 0.9)
    for _ in range(steps):
        prior = np.clip((n * good).sum() / n.sum(), 0.01, 0.99)
        accuracy = []
        for w in (n * good, n * (1 - good)):
            a, b = w @ plus, w @ minus
            accuracy.append((a + 1) / (a + b + 2))
        accuracy = np.array(accuracy)
        accuracy[0] = np.maximum(accuracy[0], 1 - (1 - accuracy[1]) / LIFT)
        yes = np.log(prior) + plus @ np.log(accuracy[0]) + minus @ np.log1p(-accuracy[0])
        no = np.log1p(-prior) + plus @ np.log(accuracy[1]) + minus @ np.log1p(-accuracy[1])
        good = 1 / (1 + np.exp(np.clip(no - yes, -50, 50)))
    return float(prior), accuracy, dict(zip(names, good.tolist(), strict=True))


def style_ids(stats: dict[str, float]) -> np.ndarray:
    """Hashed slots of the text's style buckets."""
    tokens = [f"{k}:{int(min(30, np.log2(1 + (v if k == 'words' else 256 * v)) * 2))}" for k, v in stats.items()]
    return np.array([(1 << BITS) + zlib.crc32(t.encode()) % STYLE for t in tokens], np.int32)


def ids_of(text: str, stats: dict[str, float], distinct: Distinct) -> np.ndarray:
    return np.concatenate([presence(text, ORDERS, BITS, distinct), style_ids(stats)])


def values_of(ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """n-grams scaled to unit length per text; style buckets count as they are."""
    own = ids >= 1 << BITS
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    n = np.bincount(rows, ~own, len(offsets) - 1)
    return np.where(own, 1.0, 1 / np.sqrt(np.maximum(n, 1))[rows])


def fit_scorer(labels: list, ids: np.ndarray, offsets: np.ndarray) -> bytes:
    size = (1 << BITS) + STYLE
    if not labels:
        return np.zeros(size + 1, "<f4").tobytes()
    y = np.array(labels, dtype=float)
    w, b = fit(ids, offsets, values_of(ids, offsets), y, np.ones(len(y)), size, "logistic", l2=1e-4, steps=100)
    return np.append(w, b).astype("<f4").tobytes()


def learn(docs: DataFrame, sample: int = SAMPLE) -> tuple[bytes, dict[str, float]]:
    """The scorer and the posteriors it was trained on."""
    counts = {r.pattern: r.n for r in vote_patterns(docs).collect()}  # at most 3 ** len(LABELLERS) rows
    posterior = estimate(counts)[2]
    total = sum(counts.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distinct = Distinct(BITS)
        for batch in common.text_slices(batches):
            texts = batch.column(0).to_pylist()
            stats = [style(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([posterior[votes(s)] for s in stats]),
                 pa.array([ids_of(t, s, distinct).tobytes() for t, s in zip(texts, stats, strict=True)], pa.binary())],
                names=["label", "ids"])

    # a repeated row counts once, so that the draw stays bounded whatever repeats
    drawn = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(
        sampling.draw(F.lit(min(1.0, sample / max(1, total))), "text")).distinct().select("text")
    return sampling.train(drawn.mapInArrow(run, "label double, ids binary"), fit_scorer), posterior


def score(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, votes, posterior of the votes, score and predicted (1 good, 0 bad) of every whole text."""
    model, posterior = learn(docs, sample)
    shared = docs.sparkSession.sparkContext.broadcast((model, posterior))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.frombuffer(shared.value[0], "<f4").astype(np.float64)
        distinct, known = Distinct(BITS), shared.value[1]
        for batch in common.text_slices(batches):
            out = []
            for t in batch.column(1).to_pylist():
                stats = style(t)
                ids = ids_of(t, stats, distinct)
                margin = weights[ids] @ values_of(ids, np.array([0, len(ids)])) + weights[-1]
                pattern = votes(stats)
                out.append((pattern, known[pattern], sigmoid(margin)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in out]), pa.array([x[1] for x in out], pa.float64()),
                 pa.array([x[2] for x in out], pa.float64()), pa.array([int(x[2] >= 0.5) for x in out], pa.int32())],
                names=["doc_id", "votes", "posterior", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, votes string, posterior double, score double, predicted int")
