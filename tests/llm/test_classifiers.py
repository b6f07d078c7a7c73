"""Toxicity, language identification and quality: held-out accuracy, folds and edge cases."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dealscope.llm import language_id, linear, quality, toxicity

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, score string, label string"
LABELS = "doc_id long, toxic int, quality int, text string"


def auc(rows):
    """Share of (positive, negative) pairs in the right order."""
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    return float(np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg]))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(SF + "/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(SF + "/labels.parquet")


def test_grams_are_whole_and_distinct():
    codes = linear.code_points("abcabc")
    found = linear.presence("abcabc", (3,), 18, linear.Distinct(18))
    assert len(found) == 5 == len(set(found.tolist()))  # " ab", "abc", "bca", "cab", "bc "
    assert sum(len(g) for g in linear.grams(codes, (3, 4), 18)) == 6 + 5
    old, linear.STEP = linear.STEP, 7
    try:
        text = "Größe straße " * 9
        small = sorted(linear.presence(text, (1, 2, 3), 16, linear.Distinct(16)).tolist())
    finally:
        linear.STEP = old
    assert small == sorted(linear.presence(text, (1, 2, 3), 16, linear.Distinct(16)).tolist())


def test_toxicity_held_out(docs, labels):
    out = toxicity.classify(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert auc([(r.score, r.toxic) for r in out if r.held_out]) > 0.8
    assert auc([(r.score, r.toxic) for r in out if not r.held_out]) > 0.95


def test_toxicity_never_sees_the_held_out_labels(spark, docs, labels):
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
                                                1 - F.col("toxic")).otherwise(F.col("toxic")))
    some = docs.where("doc_id < 50")
    learn = lambda x: toxicity.learn(docs, x, toxicity.sampling.remainder(5) != 0)
    assert learn(labels) == learn(flipped)
    assert some.count() == toxicity.score(some, learn(labels)).count()


def test_toxicity_edges(spark, labels):
    d = spark.createDataFrame([(1, None, None, "s", "l"), (2, "", "en", "s", "l"), (2, "you idiot", None, "s", "l"), (None, "x " * 40000, "en", "s", "l")], DOCS)
    none = spark.createDataFrame([], LABELS)
    assert [r.score for r in toxicity.classify(d, none).collect()] == pytest.approx([0.0] * 4, abs=1e-6)
    odd = spark.createDataFrame([(1, None, 1, "t"), (2, 1, 1, "t"), (2, 1, 1, "t"), (99, 0, 1, "t"), (None, 1, 1, "t")], LABELS)
    assert toxicity.classify(d, odd).count() == 4
    assert toxicity.classify(d.limit(0), odd).count() == 0
    assert toxicity.keep_clean(d, none).collect() == d.collect()


def test_languages_held_out(docs):
    out = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    held = [r for r in out if r.held_out]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_language_edges(spark, docs):
    rows = [(1, None, "en", "s", "l"), (2, "", None, "s", "l"), (3, "12 % 34", "fr", "s", "l"), (4, "Wörter", "de", "s", "l"),
            (4, "mots é", "fr", "s", "l"), (5, "third", "xx", "s", "l"), (None, "words", "en", "s", "l")] * 2
    d = spark.createDataFrame(rows, DOCS)
    out = {(r.doc_id, r.lang_pred) for r in language_id.identify(d, held=9).collect()}
    assert {(1, "und"), (2, "und"), (3, "und")} <= out
    assert all(p in {"en", "fr", "de", "xx"} for i, p in out if i not in (1, 2, 3))
    assert {r.lang_pred for r in language_id.identify(d.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_id.identify(d.limit(0)).count() == 0
    kept = language_id.keep_identified(d)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {4, 5, None}


def test_estimate_finds_the_accuracies():
    rng = np.random.default_rng(3)
    k, n = len(quality.LABELLERS), 20000
    caught = np.linspace(0.4, 0.9, k)  # complaints about bad documents; one in a thousand good ones gets one too
    good = rng.random(n) < 0.8
    complaint = rng.random((n, k)) < np.where(good[:, None], 0.001, caught)
    silent = rng.random((n, k)) < 0.3
    patterns = {}
    for i in range(n):
        p = "".join("0" if silent[i, j] else "-" if complaint[i, j] else "+" for j in range(k))
        patterns[p] = patterns.get(p, 0) + 1
    prior, found, posterior = quality.estimate(patterns)
    assert abs(prior - 0.8) < 0.02
    assert np.abs(found[0] - 0.999).max() < 0.01 and np.abs(found[1] - (1 - caught)).max() < 0.04
    assert quality.estimate({})[2] == {}


def test_quality_follows_the_hand_labels_it_never_read(docs, labels):
    out = quality.score(docs).join(labels, "doc_id").collect()
    assert auc([(r.score, r.quality) for r in out]) > 0.9


def test_quality_edges(spark):
    d = spark.createDataFrame([(1, None, None, "s", "l"), (1, "", None, "s", "l"), (None, "a b c", None, "s", "l"), (3, "w " * 50000, None, "s", "l")], DOCS)
    out = quality.score(d).collect()
    assert len(out) == 4 and all(0 <= r.score <= 1 for r in out)
    assert quality.score(d.limit(0)).count() == 0


def test_toxicity_learns_from_all_rare_labels_and_bounds_repeated_ids(spark, monkeypatch):
    words = ["vile", "scum", "idiot", "loser"]
    rows = [(i, f"{words[i // 500 % 4]} {words[i // 2000 % 4]} you are" if i % 500 == 0 else f"plain note {i} on the weather", 1 if i % 500 == 0 else 0)
            for i in range(8000)]
    d = spark.createDataFrame([(i, t, "en", "s", "l") for i, t, _ in rows], DOCS)
    b = spark.createDataFrame([(i, y, 1, "t") for i, _, y in rows], LABELS)
    sizes = []
    train = toxicity.sampling.train
    monkeypatch.setattr(toxicity.sampling, "train", lambda s, f: sizes.append(dict(s.groupBy("label").count().collect())) or train(s, f))
    model = toxicity.learn(d, b, F.lit(True), sample=200)
    assert sizes[0][1] == 16 and 120 < sizes[0][0] < 260
    scores = toxicity.score(d, model).join(b.select("doc_id", "toxic"), "doc_id").collect()
    assert auc([(r.score, r.toxic) for r in scores]) > 0.99
    same = d.withColumn("doc_id", F.lit(1).cast("long"))
    toxicity.learn(same, spark.createDataFrame([(1, 1, 1, "t"), (1, 0, 1, "t")], LABELS), F.lit(True), sample=200)
    assert 0 < sum(sizes[1].values()) < 300


def test_texts_whose_language_cannot_be_told_go(spark, docs):
    rng = random.Random(8)
    text = lambda letters: " ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(rng.randint(20, 200)))
    latin, greek, thai = ("".join(map(chr, range(a, b))) for a, b in ((97, 123), (0x3B1, 0x3CA), (0xE01, 0xE2F)))
    odd = [(-1000 * k - i, text(letters), None) for k, letters in enumerate((latin, greek, thai), 1) for i in range(100)]
    clean = docs.select("doc_id", "text", "lang")
    kept = language_id.keep_identified(clean.unionByName(spark.createDataFrame(odd, clean.schema))).select("doc_id").collect()
    ids = {r.doc_id for r in kept}
    gone = [sum(-1000 * k - i not in ids for i in range(100)) for k in (1, 2, 3)]
    assert gone[0] >= 80 and gone[1] >= 99 and gone[2] >= 99, gone
    assert sum(i >= 0 for i in ids) >= 0.998 * clean.where("doc_id >= 0").count()
    none = clean.withColumn("lang", F.lit(None).cast("string"))
    assert language_id.keep_identified(none).count() == none.where(F.col("text").rlike(r"\p{L}")).count() > 0
