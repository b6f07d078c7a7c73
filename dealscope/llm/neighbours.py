"""Approximate nearest neighbours by learned partitions.

A neighbour graph over a bounded sample is cut into parts of equal size with few edges between them; a small network
learns from these parts to which of them a vector's neighbours belong.  Every vector of the table is then indexed under
its most probable part, and a query is routed to its several most probable parts, whose vectors are ranked by their
exact cosine.  How many parts a query tries is calibrated on sampled vectors that the network was not fitted on: as many
as hold the share ``RECALL`` of their neighbours in the graph.  Only the sample (``SAMPLE`` vectors, a documented bound)
is ever in one task; index, routing and ranking run over the whole table.

Equal vectors are folded first: of each, the K + 1 smallest ids answer for all, and equal queries are searched once.  A
part's vectors and queries are dealt into blocks of about ``BLOCK``, so neither a popular part nor a popular vector
meets in one task, and ranking sees pairs of such blocks, never all pairs of the table.

Edge cases: rows with a null id, and vectors that are null, empty, zero or hold a null or a component that is not finite
take no part.  Of several rows with one id, the one with the smallest vector counts.  Vectors of unlike length are
compared as if the shorter went on with zeros.  Ties go to the smaller id; with fewer than K candidates all are given;
an empty table gives no row; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealscope.llm import common

K = 5
#: Vectors (about) that the partition is learned from.
SAMPLE = 16_384
#: Parts at most, and sampled vectors a part has at least.
PARTS, LEAST = 64, 64
#: Neighbours of a vector in the graph, units of the network's hidden layer.
GRAPH, HIDDEN = 10, 128
#: Share of the neighbours of held-out sampled vectors that the tried parts hold.
RECALL = 0.97
#: Vectors, and queries, that are ranked against each other at a time.
BLOCK = 4096
#: Scores this close may differ by the order of summation alone.
CLOSE = 1e-9


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of float64, shorter ones filled with zeros, each scaled by a power of two against overflow."""
    flat = np.asarray(vectors.flatten()).astype(np.float64)
    n = np.asarray(pc.list_value_length(vectors)).astype(np.int64)
    out = np.zeros((len(n), width))
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return np.ldexp(out, -np.frexp(np.abs(out).max(axis=1, initial=0))[1][:, None])


def unit(x: np.ndarray) -> np.ndarray:
    return (x / np.sqrt((x * x).sum(axis=1))[:, None]).astype(np.float32)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest others of every row of unit vectors."""
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), 512):
        near = x[at:at + 512] @ x.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        out[at:at + 512] = np.argpartition(near, -k, axis=1)[:, -k:]
    return out


def balanced_parts(graph: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Equal parts (a power of two) of a graph with few edges between them.

    Every part is halved at the median of a slow mode of the random walk on its own edges; then vertices move to the
    part of most of their neighbours, as far as parts stay within 5 % of their share.
    """
    n = len(graph)
    source, target = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    label = np.zeros(n, np.int64)
    while (count := int(label.max(initial=0)) + 1) < parts:
        inside = label[source] == label[target]
        s, t = source[inside], target[inside]
        degree = np.bincount(s, minlength=n) + np.bincount(t, minlength=n) + 1e-9
        mass = np.bincount(label, degree)
        mode = rng.standard_normal(n)
        for _ in range(60):
            mode -= (np.bincount(label, mode * degree) / mass)[label]
            walked = np.bincount(s, mode[t], n) + np.bincount(t, mode[s], n)
            mode = mode / 2 + walked / (2 * degree)
            mode /= np.sqrt(np.bincount(label, mode * mode) / np.bincount(label) + 1e-300)[label]
        order = np.lexsort((mode, label))
        size = np.bincount(label, minlength=count)
        place = np.empty(n, np.int64)
        place[order] = np.arange(n) - np.repeat(np.cumsum(size) - size, size)
        label = 2 * label + (place >= (size[label] + 1) // 2)
    room = int(np.ceil(1.05 * n / parts))
    for _ in range(5):
        held = np.bincount(np.concatenate((source * parts + label[target], target * parts + label[source])),
                           minlength=n * parts).reshape(n, parts)
        best = held.argmax(axis=1)
        gain = held[np.arange(n), best] - held[np.arange(n), label]
        size = np.bincount(label, minlength=parts)
        for v in np.argsort(-gain, kind="stable")[:int((gain > 0).sum())].tolist():
            if size[best[v]] < room:
                size[label[v]] -= 1
                size[best[v]] += 1
                label[v] = best[v]
    return label


class Router:
    """A network of one hidden layer: unit vector -> probability of every part."""

    def __init__(self, width: int, parts: int, rng: np.random.Generator) -> None:
        self.weights = [rng.standard_normal((width, HIDDEN)).astype(np.float32) * np.float32(np.sqrt(2)),
                        np.zeros(HIDDEN, np.float32),
                        rng.standard_normal((HIDDEN, parts)).astype(np.float32) * np.float32(np.sqrt(1 / HIDDEN)),
                        np.zeros(parts, np.float32)]

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w, b, v, c = self.weights
        hidden = np.maximum(x @ w + b, 0)
        score = hidden @ v + c
        score = np.exp(score - score.max(axis=1, keepdims=True))
        return hidden, score / score.sum(axis=1, keepdims=True)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.forward(x[i:i + 4096])[1] for i in range(0, len(x), 4096)])

    def fit(self, x: np.ndarray, target: np.ndarray, rng: np.random.Generator, epochs: int = 20, size: int = 256) -> None:
        """Adam on the cross-entropy with ``target``, rows of probabilities; the step falls to zero."""
        first, second = ([np.zeros_like(w) for w in self.weights] for _ in range(2))
        steps, step = epochs * -(-len(x) // size), 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), size):
                rows = order[at:at + size]
                hidden, p = self.forward(x[rows])
                out = (p - target[rows]) / len(rows)
                back = (out @ self.weights[2].T) * (hidden > 0)
                rate = 0.003 * (1 - step / steps)
                step += 1
                for i, g in enumerate((x[rows].T @ back, back.sum(axis=0), hidden.T @ out, out.sum(axis=0))):
                    first[i] += (g - first[i]) * np.float32(0.1)
                    second[i] += (g * g - second[i]) * np.float32(0.001)
                    self.weights[i] -= np.float32(rate / (1 - 0.9 ** step)) * first[i] / (
                        np.sqrt(second[i] / np.float32(1 - 0.999 ** step)) + np.float32(1e-8))


def fit(x: np.ndarray, recall: float = RECALL) -> tuple[Router | None, int]:
    """The router of a sample of unit vectors and the number of parts to try; no router where there is one part."""
    parts = min(PARTS, 1 << max(0, (len(x) // LEAST).bit_length() - 1))
    if parts == 1:
        return None, 1
    rng = np.random.default_rng(13)
    graph = neighbour_graph(x, GRAPH)
    label = balanced_parts(graph, parts, rng)
    target = np.zeros((len(x), parts), np.float32)
    for near in (np.arange(len(x)), *graph.T):
        target[np.arange(len(x)), label[near]] += np.float32(1 / (GRAPH + 1))
    held = rng.random(len(x)) < 0.2
    router = Router(x.shape[1], parts, rng)
    router.fit(x[~held], target[~held], rng)
    likely = router(x)
    place = np.empty((int(held.sum()), parts), np.int64)
    np.put_along_axis(place, np.argsort(-likely[held], axis=1), np.arange(parts)[None, :], axis=1)
    tried = np.take_along_axis(place, likely.argmax(axis=1)[graph[held]], axis=1)
    share = np.cumsum(np.bincount(tried.ravel(), minlength=parts)) / max(1, tried.size)
    return router, min(parts, int(np.searchsorted(share, recall)) + 1)


def rank_block(x: np.ndarray, ids: list[list[int]], q: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``keep`` nearest ids of every query, as query, id and cosine; ties to the smaller id."""
    size_x, size_q = (np.sqrt((m * m).sum(axis=1)) for m in (x, q))
    n = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter((i for own in ids for i in own), np.int64, int(n.sum()))
    begin = np.cumsum(n) - n
    found = []
    unit_x = x / size_x[:, None]
    for at in range(0, len(q), 256):
        near = (q[at:at + 256] / size_q[at:at + 256, None]) @ unit_x.T
        least = np.partition(near, -keep, axis=1)[:, -keep] if near.shape[1] > keep else near.min(axis=1)
        query, row = np.nonzero(near >= least[:, None] - CLOSE)
        query += at
        # the same sum for each pair wherever its block lies, so that equal cosines come out equal
        score = np.concatenate([(x[row[i:i + 65536]] * q[query[i:i + 65536]]).sum(axis=1) for i in range(0, len(row), 65536)])
        score /= size_x[row] * size_q[query]
        times = n[row]
        pick = np.arange(int(times.sum())) + np.repeat(begin[row] - (np.cumsum(times) - times), times)
        query, score, vec = np.repeat(query, times), np.repeat(score, times), flat[pick]
        order = np.lexsort((vec, -score, query))
        query, score, vec = query[order], score[order], vec[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        found.append((query[place < keep], vec[place < keep], score[place < keep]))
    return tuple(np.concatenate(f) for f in zip(*found, strict=True))


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector of the rows that take part, one per id."""
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector")) \
        .where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()) \
        .where(finite & F.exists("vector", lambda v: v != 0)) \
        .groupBy("vec_id").agg(F.min("vector").alias("vector"))


def fold(rows: DataFrame, keep: int) -> DataFrame:
    """vector and ids, the ``keep`` smallest, of every distinct vector.

    The rank limit is applied before the shuffle too, so a vector that a third of the rows share costs ``keep`` rows a task.
    """
    smallest = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    return rows.withColumn("n", smallest).where(F.col("n") <= keep).groupBy("vector").agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids"))


def train(index: DataFrame, rows: int, width: int, recall: float) -> tuple[Router | None, int]:
    """Fit on about ``SAMPLE`` distinct vectors, drawn by hash; one task holds them."""
    share = F.xxhash64("vector", F.lit("sample")).bitwiseAND(F.lit((1 << 30) - 1)) / F.lit(float(1 << 30))
    sample = index.where(share < SAMPLE / max(1, rows)).select(F.col("ids")[0].alias("id"), "vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = [unit(matrix(b.column(1), width)) for b in batches]
        model = pickle.dumps(fit(np.concatenate(x), recall)) if x else pickle.dumps((None, 1))
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])

    row = sample.repartition(1).sortWithinPartitions("id").mapInArrow(run, "model binary").first()
    return pickle.loads(row.model) if row else (None, 1)


def routed(rows: DataFrame, column: str, router: Router | None, width: int, tried: int,
           sizes: np.ndarray | None = None) -> DataFrame:
    """``column``, vector and parts: the ``tried`` most probable parts of every vector, more where these have less than
    K + 1 vectors (``sizes``: of each part)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if router is None:
                parts = pa.array([[0]] * batch.num_rows, pa.list_(pa.int32()))
            else:
                likely = router(unit(matrix(batch.column(1), width)))
                order = np.argsort(-likely, axis=1, kind="stable").astype(np.int32)
                n = np.full(len(order), tried)
                if sizes is not None:
                    n = np.maximum(n, np.minimum((sizes[order].cumsum(axis=1) <= K).sum(axis=1) + 1, len(sizes)))
                parts = pa.array([o[:m] for o, m in zip(order, n, strict=True)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, parts], names=[*batch.schema.names, "parts"])

    source = rows.select(column, "vector")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema)
    return source.mapInArrow(run, f"{fields}, parts array<int>").withColumn("part", F.explode("parts")).drop("parts")


def _blocks(sizes: dict[int, int], parts: int) -> np.ndarray:
    return np.array([-(-sizes.get(p, 0) // BLOCK) for p in range(parts)])


def nearest(vectors: DataFrame, queries: DataFrame, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: the K nearest rows of ``vectors`` (vec_id, embedding) of every row of ``queries``
    (the same columns; a query's own id is no candidate)."""
    rows = common.materialise(usable(vectors), "vectors")
    index = common.materialise(fold(rows, K + 1), "index")
    asked = usable(queries)
    width = index.agg(F.max(F.size("vector"))).first()[0] or 0
    width = max(width, asked.agg(F.max(F.size("vector"))).first()[0] or 0)
    router, tried = train(index, index.count(), width, recall)
    parts = 1 if router is None else len(router.weights[3])

    placed = common.materialise(routed(index, "ids", router, width, 1), "placed")
    count = {r.part: r["count"] for r in placed.groupBy("part").count().collect()}  # at most PARTS rows
    sizes = np.array([count.get(p, 0) for p in range(parts)])
    asked = common.materialise(asked, "asked")
    folded = asked.groupBy("vector").agg(F.min("vec_id").alias("query"))
    sent = common.materialise(routed(folded, "query", router, width, tried, sizes), "sent")
    count_sent = {r.part: r["count"] for r in sent.groupBy("part").count().collect()}
    row_blocks, query_blocks = _blocks(count, parts), _blocks(count_sent, parts)

    def of_part(numbers: np.ndarray) -> Column:
        return F.get(F.array(*[F.lit(int(x)) for x in numbers]), F.col("part"))

    def dealt(df: DataFrame, own: str, own_blocks: np.ndarray, other: str, other_blocks: np.ndarray) -> DataFrame:
        """Each row in a block of its own side, once for every block of the other side of its part."""
        df = df.withColumn(own, F.pmod(F.xxhash64("vector"), of_part(own_blocks)).cast("int"))
        return df.where(of_part(other_blocks) > 0).withColumn(
            other, F.explode(F.sequence(F.lit(0), of_part(other_blocks) - 1)))

    left = dealt(placed, "row_block", row_blocks, "query_block", query_blocks)
    right = dealt(sent, "query_block", query_blocks, "row_block", row_blocks)
    right = right.select(*[F.col(c).alias(f"of_{c}") for c in ("part", "row_block", "query_block", "query", "vector")])

    def run(block: pa.Table, asked: pa.Table) -> pa.Table:
        if not block.num_rows or not asked.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.float64())})
        block, asked = block.combine_chunks(), asked.combine_chunks()
        query, vec, score = rank_block(
            matrix(block.column("vector").chunk(0), width), block.column("ids").to_pylist(),
            matrix(asked.column("of_vector").chunk(0), width), K + 1)
        return pa.table({"query": np.asarray(asked.column("of_query"))[query], "vec_id": vec, "score": score})

    found = left.groupBy("part", "row_block", "query_block").cogroup(
        right.groupBy("of_part", "of_row_block", "of_query_block")).applyInArrow(
        run, "query bigint, vec_id bigint, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= K + 1)
    answers = found.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("found"))
    # equal queries share the answer, each without itself
    members = asked.join(folded.withColumnRenamed("vector", "of"), F.col("vector") == F.col("of")).select("vec_id", "query")
    own = F.slice(F.filter("found", lambda r: r.vec_id != F.col("query_id")), 1, K)
    return members.withColumnRenamed("vec_id", "query_id").join(answers, "query").select(
        "query_id", F.posexplode(own).alias("at", "r")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "r.vec_id", "r.score")
