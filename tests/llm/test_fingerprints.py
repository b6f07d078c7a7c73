"""Merkle fingerprints against a direct statement of the edited texts."""

import hashlib
import random

from dealscope.llm import fingerprints as fp

SCHEMA = "doc_id long, text string, part int, fingerprint string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA).repartition(3)


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for k, (d, t) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        e = t[:len(t) - len(t) // 3] + n[:len(t) // 3]
        a, b, c = (fp.tree(x)[0] for x in (t, e, n))
        out[d] = (len(t), hashlib.sha256(e.encode()).hexdigest(), a, b, fp.likeness(a, b), fp.likeness(a, c))
    return out


def check(spark, rows):
    got = fp.with_edits(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: tuple(r)[1:] for r in got} == brute(rows)


def test_rows_of_every_partition_see_their_follower(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    check(spark, [(r.doc_id, r.text) for r in docs])


def test_edges(spark):
    check(spark, [(5, None), (3, ""), (9, "é\n\nÀ b c d e f g"), (None, "null id"), (-7, "x" * 70000), (8, "é\n\nÀ b c d e f g")])
    check(spark, [(1, "alone on its own")])
    check(spark, [(None, "alone without id")])
    assert fp.with_edits(frame(spark, [(1, "a")]).limit(0)).count() == 0


def test_repeated_ids_are_kept(spark):
    rows = [(4, "b b b b b b"), (4, "a a a a a a"), (4, "a a a a a a"), (2, "z")]
    assert sorted(r.doc_id for r in fp.with_edits(frame(spark, rows)).collect()) == [2, 4, 4, 4]


def test_roots_and_branches():
    a = "\n".join(f"paragraph {i} has some words of its own, as they all have" for i in range(60))
    b = a.replace("paragraph 31 has", "paragraph 31 had")
    x, y = fp.tree(a)[0], fp.tree(b)[0]
    assert x.split(":")[0] != y.split(":")[0] and fp.tree(a)[0] == x
    assert 0.95 < fp.likeness(x, y) < 1 == fp.likeness(x, x)
    assert len(fp.edits(x, y)) == 1 and fp.edits(x, x) == []
    assert fp.leaves_of(x) == fp.tree(a)[1]
    assert fp.tree("a\n")[0] != fp.tree("a")[0] != fp.tree("")[0]


def test_fingerprints_alone(spark):
    rows = fp.fingerprints(frame(spark, [(1, "a"), (2, "a"), (3, None)])).collect()
    assert len({r.fingerprint for r in rows}) == 2


def test_an_edit_changes_only_the_spans_around_it():
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9)))
    words = [word() for _ in range(1000)]
    a = fp.tree(" ".join(words))
    assert 200 <= len(a[1]) <= 300
    for at in (0, 1, 500, 999):
        for b in (words[:at] + ["inserted"] + words[at:], words[:at] + words[at + 1:], words[:at] + ["other"] + words[at + 1:]):
            assert 0.97 < fp.likeness(a[0], fp.tree(" ".join(b))[0]) < 1
    run = "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(3000))
    c = fp.tree(run)[0]
    for at in (0, 1500, 2999):
        assert 0.9 < fp.likeness(c, fp.tree(run[:at] + "字" + run[at:])[0]) < 1
    assert fp.likeness(a[0], fp.tree(" ".join(word() for _ in range(1000)))[0]) < 0.05
    assert fp.leaves_of(c) == fp.tree(run)[1]
