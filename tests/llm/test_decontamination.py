"""Benchmark decontamination against a direct search over all aligned windows."""

import random
import re
from collections import Counter

from dealscope.llm import decontamination as dc
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, start int, h string, block int"
ITEMS = "item_id long, text string, doc_id long"


def words(t):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").lower()) if w]


def shingles(w):
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)]


def brute(docs, items):
    out = {}
    for d, t in docs:
        w = words(t)
        where = {}
        for i, s in enumerate(shingles(w)):
            where.setdefault(s, []).append(i)
        for item, it in items:
            iw = words(it)
            for start in {i - j for j, s in enumerate(shingles(iw)) for i in where.get(s, ())}:
                a, b = Counter(shingles(w[max(0, start):max(0, start + len(iw))])), Counter(shingles(iw))
                x = sum((a & b).values()) / sum((a | b).values())
                if x * 100 >= 75:
                    key, new = (d, item), (x, -max(0, start), len(iw))
                    out[key] = max(out.get(key, new), new)
    return sorted(((d, i, -s, n, x) for (d, i), (x, s, n) in out.items()), key=repr)


def run(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, "h", 2) for i, t in docs], DOCS)
    b = spark.createDataFrame([(i, t, 5) for i, t in items], ITEMS)
    return sorted(map(tuple, dc.matches(d, b).collect()), key=repr), d, b


def planted(seed):
    random.seed(seed)
    word = lambda: "".join(random.choices("abcdefghij", k=5))
    items = [(i, " ".join(word() for _ in range(random.randint(14, 60)))) for i in range(25)]
    docs = []
    for d in range(200):
        w = [word() for _ in range(random.randint(0, 300))]
        for _ in range(random.randint(0, 2)):
            p = words(random.choice(items)[1])
            for _ in range(random.randint(0, 2)):
                p[random.randrange(len(p))] = word()
            p = p[random.randint(0, 5):len(p) - random.randint(0, 5)]
            w[(at := random.choice([0, len(w), random.randint(0, len(w))])):at] = p
        docs.append((d, " ".join(w).capitalize()))
    return docs, items


def test_planted_passages(spark):
    for seed in (1, 2):
        docs, items = planted(seed)
        assert run(spark, docs, items)[0] == brute(docs, items)


def test_edges(spark):
    item = " ".join(f"w{i}" for i in range(20))
    rep = "a b c d e f " * 4
    docs = [(1, None), (2, ""), (3, "w1 w2"), (None, "x " + item), (5, item.upper()), (5, "clean row of the same id"),
            (6, rep), (7, item + " " + item), (8, "y " * 30000 + item), (8, "y " * 30000 + item)]
    items = [(1, item), (2, item), (3, None), (4, "w1 w2 w3"), (5, rep), (None, "y y y y y y y"), (7, "")]
    got, d, b = run(spark, docs, items)
    assert got == brute(docs, items)
    kept = dc.decontaminate(d, b)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3]
    assert dc.matches(d.limit(0), b).count() == 0 == dc.matches(d, b.limit(0)).count()
    assert dc.decontaminate(d, b.limit(0)).count() == len(docs)


def test_joins_without_broadcast_give_the_same(spark, monkeypatch):
    docs, items = planted(3)
    monkeypatch.setattr(dc, "BROADCAST_ROWS", -1)
    assert run(spark, docs, items)[0] == brute(docs, items)


def test_index_finds_every_fingerprint_within_the_radius():
    random.seed(5)
    for _ in range(2000):
        bits = random.sample(range(64), dc.RADIUS)
        assert min(sum(1 for b in bits if b // dc.BITS == k) for k in range(dc.BLOCKS)) <= dc.RADIUS // dc.BLOCKS


def test_simhash_of_one_and_of_many(spark):
    df = spark.createDataFrame([([5],), ([5, 5, -1],), ([-1],), ([1 << 40, 3, 1],)], "h array<bigint>")
    assert [r.p for r in df.select(dc.simhash("h").alias("p")).collect()] == [5, 5, -1, 1]
    assert df.select(F.size("h")).count() == 4


def best_of_all_starts(text, item):
    a, b = shingles(words(text)), Counter(shingles(words(item)))
    n, out = sum(b.values()), 0.0
    for start in range(max(1, len(a) - n + 1)):
        w = Counter(a[start:start + n])
        out = max(out, sum((w & b).values()) / sum((w | b).values()))
    return out


def test_reordered_passages(spark):
    random.seed(7)
    word = lambda: "".join(random.choices("abcdefghij", k=5))
    items = [(i, " ".join(word() for _ in range(random.choice([40, 60, 61])))) for i in range(12)]
    docs = []
    for d in range(150):
        p = words(random.choice(items)[1])
        cut = random.choice([12, len(p) // 2, random.randint(1, len(p) - 1)])
        p = p[cut:] + p[:cut]
        p = p[:len(p) - random.randint(0, 6)]
        before, after = ([word() for _ in range(random.choice([0, 3, 80]))] for _ in range(2))
        docs.append((d, " ".join(before + p + after)))
    alone, expected = {(r[0], r[1]) for r in brute(docs, items)}, {}
    for d, t in docs:
        for i, x in items:
            if (found := best_of_all_starts(t, x)) >= 0.75:
                expected[d, i] = found
    got, d, b = run(spark, docs, items)
    assert {(r[0], r[1]) for r in got} == set(expected) | alone
    assert all(abs(r[4] - expected[r[0], r[1]]) < 1e-12 for r in got if (r[0], r[1]) not in alone)
    assert len(set(expected) - alone) > 50
    assert dc.decontaminate(d, b).count() == len(docs) - len({x for x, _ in set(expected) | alone})
