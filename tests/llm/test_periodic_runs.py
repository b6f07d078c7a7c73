"""Periodic runs against a scan of every lag."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from dealscope.llm import periodic_runs as pr
from dealscope.llm import queries

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w):
    """Every run (start, length, period) of a list of words, by comparing each lag."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def fast(lists):
    kinds = {}
    words = np.array([kinds.setdefault(x, len(kinds)) for w in lists for x in w], np.int64)
    docs = np.repeat(np.arange(len(lists)), [len(w) for w in lists])
    at, segment = pr.split(words, docs)
    bounds = np.cumsum([0, *map(len, lists)])
    out = [[] for _ in lists]
    for start, length, period in pr.lag_scan(words, at, segment):
        d = int(np.searchsorted(bounds, start, side="right")) - 1
        out[d].append((start - int(bounds[d]), length, period))
    return out


def edited(doc_id, text):
    w = WORDS.findall(text or "")
    if doc_id is None or not w:
        return w
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    w = edited(doc_id, text)
    runs = brute(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = None
    for s, n, q in runs:
        if top is None or n * top[2] > top[1] * q:
            top = (s, n, q)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(top or (None, None, None)), 1000 * top[1] // top[2] if top else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@pytest.mark.parametrize("letters", [1, 2, 3, 8, 40])
def test_random_words(letters):
    rng = random.Random(letters)
    lists = []
    for _ in range(250):
        w = [rng.randrange(letters) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(4)):  # repeated stretches of all exponents, some of them next to each other
            unit = [rng.randrange(letters) for _ in range(rng.randrange(1, 9))]
            at = rng.randrange(len(w) + 1)
            w[at:at] = (unit * 12)[:rng.randrange(1, len(unit) * 9)]
        lists.append(w)
    assert fast(lists) == [brute(w) for w in lists]


def test_long_runs_and_long_periods():
    rng = random.Random(7)
    unit = [rng.randrange(50) for _ in range(700)]
    one = [1] * 5000
    lists = [unit * 5, [*range(900), *unit * 4, *range(30)], one, [*one, 2, *one[:6]], (unit * 4)[:-1], [0, 1] * 900 + [1, 0] * 700,
             ([*([3] * 6), *unit[:40]]) * 6]
    assert fast(lists) == [brute(w) for w in lists]


def test_rows(spark):
    rng = random.Random(3)
    rows = [(None, "a a a a a a a"), (1, None), (2, ""), (3, " \t\n "), (4, "\x0bx y x y x y x y\x0c"), (4, "x y x y x y x y"),
            (5, "b\x1cb " * 9), (6, "\xa0 " * 8), (7, "é é é é é"), (8, "c " * 6), (9, "d d d d d")]
    for i in range(10, 400):
        unit = [rng.choice("abcdef") for _ in range(rng.randrange(1, 5))]
        rows.append((i, " ".join([rng.choice("abcdef") for _ in range(rng.randrange(30))] + unit * rng.randrange(9))))
    docs = spark.createDataFrame([(i, t, 0, "z") for i, t in rows], "doc_id long, text string, runs int, n_words string")
    got = pr.digest(pr.periodic_runs(pr.planted(docs.repartition(3)))).collect()
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else x for x in r)
    assert sorted(map(tuple, got), key=key) == sorted((expected(*r) for r in rows), key=key)
    assert sum(r.n_runs > 0 for r in got) > 100
    assert pr.periodic_runs(docs.limit(0)).count() == 0


def test_query_on_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in queries.op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert got == {r.doc_id: expected(r.doc_id, r.text) for r in docs}
