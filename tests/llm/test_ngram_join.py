"""The n-gram Jaccard join against brute force."""

import os
import random
import re
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from dealscope.llm import common, ngram_join
from dealscope.llm.components import components
from dealscope.llm.shingles import Shingler, set_key

SCHEMA = "doc_id long, text string, n long, class string, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], SCHEMA).repartition(4)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        return x if root[x] == x else find(root[x])

    for i in range(len(rows)):
        for j in range(i):
            o = len(sets[i] & sets[j])
            if o and 100 * o >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    named = {}
    for i, (d, _) in enumerate(rows):
        named.setdefault(find(i), []).append(d)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in named.items()}
    return sorted(((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)), key=repr)


def linked(spark, rows, **options):
    return sorted(map(tuple, ngram_join.link(frame(spark, rows), **options).collect()), key=repr)


def test_sets_equal_plain_shingles():
    texts = ["", " ", "One two", "a b c d e f", "A\x0bB\x0cC d\te\nf\r g", "é É ß x y z z z z z z z", "x " * 50]
    for t, s in zip(texts, Shingler().sets([t.encode() for t in texts]), strict=True):
        assert len(s) == len(shingles(t))
    a, b = Shingler().sets([b"ONE two three four five six", b"one  two\nthree four five six"])
    assert set_key(a) == set_key(b) and np.array_equal(a, b)


def test_long_texts_in_steps(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(3000)).encode()
    whole = Shingler().sets([text])[0]
    monkeypatch.setattr("dealscope.llm.shingles._STEP", 100)
    assert np.array_equal(Shingler().sets([text])[0], whole)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  B"), (6, "a b c d e"), (7, "a b c d e"), (7, "a b c d e"),
            (None, "a b c d e"), (None, "only here with a null id"), (None, "only here with a null id"), (8, "word " * 9000),
            (9, "word " * 8000), (10, "a b c d")]
    assert linked(spark, rows) == brute(rows)
    assert linked(spark, rows[:0]) == []


def near_copies(seed, groups=12, size=25, own=60):
    random.seed(seed)
    word = lambda: "".join(random.choices("abcdefgh", k=4))
    passage = [word() for _ in range(55)]
    rows = []
    for g in range(groups):
        base = [word() for _ in range(random.randint(8, own * 2))]
        for _ in range(random.randint(1, size)):
            w = list(base)
            for _ in range(random.randint(0, max(1, len(w) // 25))):
                w[random.randrange(len(w))] = word()
            w = w[:len(w) - random.randint(0, len(w) // 6)]
            if random.random() < 0.4:
                w[random.randint(0, len(w)):0] = passage
            rows.append((len(rows) * 7 % 1000003, " ".join(w)))
    random.shuffle(rows)
    return rows


def test_against_brute_force(spark):
    rows = near_copies(1)
    assert linked(spark, rows) == brute(rows)


def test_chunked_blocks_against_brute_force(spark):
    rows = near_copies(2)
    assert linked(spark, rows, block=300) == brute(rows)
    rows = near_copies(3, groups=4, size=60, own=20)
    assert linked(spark, rows, block=200, percent=75, words=5) == brute(rows)


def test_any_frequency_table_gives_the_same(spark, monkeypatch):
    rows = near_copies(4)
    monkeypatch.setattr(ngram_join, "CELL_BITS", 6)
    assert linked(spark, rows) == brute(rows)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=8), min_size=1, max_size=12))
def test_product_links_span_the_links(lists):
    texts = [" ".join("abcd"[i] for i in x) for x in lists]
    sets = Shingler().sets([t.encode() for t in texts])
    keep = [i for i in range(len(sets)) if len(sets[i])]
    if len(keep) < 2:
        return
    links = ngram_join.product_links(keep, [sets[i] for i in keep], np.zeros(len(keep), np.int64), 75)
    root = list(range(len(texts)))
    find = lambda x: x if root[x] == x else find(root[x])
    for a, b in links:
        root[find(a)] = find(b)
    got = [(i, len(sets[i]), min(j for j in range(len(texts)) if find(j) == find(i))) for i in range(len(texts))]
    assert sorted(got, key=repr) == brute(list(enumerate(texts)))


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100)}


def test_shingles_shared_by_chance_make_no_candidates(spark):
    random.seed(5)
    word = lambda: "".join(random.choices("abcdefgh", k=6))
    passage = [word() for _ in range(14)]
    texts = [[word() for _ in range(1280)] for _ in range(6)]
    rows = [(i, " ".join([*w[:600], *passage, *w[600:]])) for i, w in enumerate(texts)]
    rows.append((9, rows[0][1] + " and one word more"))
    cells = np.zeros(1 << ngram_join.CELL_BITS, np.uint8)
    edges = ngram_join.candidate_edges(ngram_join._texts(frame(spark, rows)), cells, 5, 75, 4).collect()
    near = {set_key(s) for s in Shingler().sets([rows[0][1].encode(), rows[-1][1].encode()])}
    assert [{e.u, e.v} for e in edges] == [near]
    assert linked(spark, rows) == brute(rows)


def test_groups_of_any_size_and_rounds_against_brute_force(spark, monkeypatch):
    rows = near_copies(6, groups=4, size=30, own=80)
    want = brute(rows)
    monkeypatch.setattr(ngram_join, "ROUND", 1)
    for group in (1, 8):
        monkeypatch.setattr(ngram_join, "GROUP", group)
        assert linked(spark, rows + rows, block=300) == sorted(want + want, key=repr)


def test_scratch_tables_give_their_shuffle_files_back(spark):
    manager = spark._jsc.sc().env().blockManager().diskBlockManager()

    def shuffles() -> set[str]:
        files = [d.getPath() for d in manager.localDirs()]
        return {f for d in files for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}

    before = shuffles()
    table = common.materialise(spark.range(1000).repartition(4, "id"), "spread")
    for _ in range(50):
        if shuffles() <= before:
            break
        time.sleep(0.1)
    assert shuffles() <= before
    assert table.count() == 1000
