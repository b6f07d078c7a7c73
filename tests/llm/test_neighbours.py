"""Learned partitions against the exact nearest neighbours."""

import math
from collections import Counter

import numpy as np
import pytest

from dealscope.llm import neighbours as nn
from dealscope.llm import queries

SCHEMA = "vec_id long, embedding array<float>, rank string, score int"


def brute(ids, x, asked):
    """query -> the K nearest (vec_id, score), exactly."""
    out = {}
    size = np.sqrt((x * x).sum(axis=1))
    for i in asked:
        at = ids.index(i)
        score = (x * x[at]).sum(axis=1) / (size * size[at])
        near = sorted((-s, j) for s, j in zip(score.tolist(), ids, strict=True) if j != i)[:nn.K]
        out[i] = [(j, -s) for s, j in near]
    return out


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def recall(got, want):
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    return hits / sum(map(len, want.values()))


def test_query_on_whole_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], np.float64)
    got = answers(queries.op13_neighbours(spark, "/root/testdata/sf0.1"))
    want = brute(ids, x, [i for i in ids if i % 50 == 0])
    assert got.keys() == want.keys() and all(len(v) == nn.K for v in got.values())
    assert recall(got, want) >= 0.9
    exact = {q: dict(v) for q, v in brute(ids, x, want).items()}
    for q, found in got.items():
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
        for v, s in found:
            assert math.isclose(s, exact[q].get(v, s), abs_tol=1e-12)


def test_clustered_vectors_need_few_parts(monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((200, 24))
    x = nn.unit(centres[rng.integers(200, size=9000)] + 0.3 * rng.standard_normal((9000, 24)))
    router, tried = nn.fit(x)
    assert tried <= 8 and len(router.weights[3]) == nn.PARTS
    label = nn.balanced_parts(nn.neighbour_graph(x, nn.GRAPH), 16, np.random.default_rng(2))
    sizes = np.bincount(label, minlength=16)
    assert sizes.max() <= math.ceil(1.05 * 9000 / 16) and sizes.min() > 0
    graph = nn.neighbour_graph(x, nn.GRAPH)
    assert (label[graph] == label[:, None]).mean() > 0.75


def test_blocks_folding_and_parts(spark, monkeypatch):
    """Many parts and blocks, a vector that a third of the rows share, queries among them."""
    monkeypatch.setattr(nn, "BLOCK", 100)
    monkeypatch.setattr(nn, "LEAST", 32)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((40, 12))
    x = (centres[rng.integers(40, size=3000)] + 0.4 * rng.standard_normal((3000, 12))).astype(np.float32)
    x[rng.random(3000) < 0.33] = x[0]
    x[7] = -x[0]
    rows = [(i, x[i].tolist(), "x", 1) for i in range(3000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = answers(nn.nearest(docs, docs.where("vec_id % 50 = 0")))
    want = brute(list(range(3000)), x.astype(np.float64), range(0, 3000, 50))
    assert got.keys() == want.keys()
    assert recall(got, want) >= 0.95
    same = [i for i in range(0, 3000, 50) if (x[i] == x[0]).all()]
    assert len(same) > 10
    first = [i for i in range(3000) if (x[i] == x[0]).all()]
    for i in same:
        assert [v for v, _ in got[i]] == [v for v in first if v != i][:nn.K]


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [0.0, 2.0]), (100, None), (150, [0.0, 0.0]), (200, [1.0, None]), (250, [nan, 1.0]),
            (300, [1.0, inf]), (350, []), (None, [1.0, 1.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]),
            (400, [1e30, -1e30]), (4, [1e-30, 1e-30]), (450, [0.0, 2.0, 0.0]), (-50, [-1.0])]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    got = answers(nn.nearest(docs, docs.where("vec_id % 50 = 0")))
    assert set(got) == {0, 50, 400, 450, -50}
    assert [v for v, _ in got[0]] == [1, 2, 4, 400, 50] and [s for _, s in got[0][:2]] == [1.0, 1.0]
    assert math.isclose(got[0][2][1], math.sqrt(0.5)) and got[50][0] == (450, 1.0)
    few = spark.createDataFrame([(0, [1.0], "x", 1), (1, [1.0], "x", 1), (3, [-2.0], "x", 1)], SCHEMA)
    assert answers(nn.nearest(few, few.where("vec_id = 0"))) == {0: [(1, 1.0), (3, -1.0)]}
    assert nn.nearest(few.limit(0), few).count() == 0
    assert nn.nearest(few, few.limit(0)).count() == 0
    one = few.where("vec_id = 0")
    assert nn.nearest(one, one).count() == 0


@pytest.mark.parametrize("n", [0, 1, 63, 127, 128, 700])
def test_fit_of_few_vectors(n):
    x = np.random.default_rng(n).standard_normal((n, 8)).astype(np.float32)
    router, tried = nn.fit(nn.unit(x.astype(np.float64)) if n else x)
    assert (router is None) == (n < 2 * nn.LEAST) and tried >= 1
    if router:
        assert Counter(router(x).argmax(axis=1)).total() == n
