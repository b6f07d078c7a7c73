"""The corpus pipeline: every stage against a plain statement of what it must keep."""

import corpus_pipeline as cp
from dealscope.llm import common, language_id, packing, sampling, toxicity
from pyspark.sql import functions as F
from test_decontamination import brute as contaminated
from test_ngram_join import brute as linked

SF = "/root/testdata/sf0.001"


def test_stages_one_after_the_other(spark):
    docs = common.read_documents(spark, SF)
    labels = common.read_documents(spark, SF, "labels")
    benchmark = [tuple(r) for r in common.read_documents(spark, SF, "benchmark").select("item_id", "text").collect()]
    kept = []
    for name, stage in cp.STAGES:
        before = docs
        docs = common.materialise(stage(spark, docs, SF), name)
        kept.append((before, docs))
        if name != "packing":
            assert docs.columns == before.columns
    (a, b), (_, c), (_, d), (_, e), (_, f) = kept
    ids = lambda x: sorted(r.doc_id for r in x.select("doc_id").collect())
    rows = lambda x: [tuple(r) for r in x.select("doc_id", "text").collect()]
    scores = toxicity.score(a, toxicity.learn(a, labels, F.lit(True)))
    assert ids(b) == ids(scores.where("score < 0.5"))
    marked = labels.where("toxic = 1").join(a, "doc_id")
    assert marked.join(b, "doc_id").count() <= marked.count() // 3
    assert ids(c) == ids(language_id.predict(b, language_id.learn(b, F.lit(True))).where("lang_pred != 'und'"))
    assert ids(d) == sorted(x for x, _, first in linked(rows(c)) if x == first)
    assert ids(e) == sorted(set(ids(d)) - {r[0] for r in contaminated(rows(d), benchmark)})
    pieces = f.collect()
    assert sorted({r.doc_id for r in pieces}) == ids(e)
    assert sum(r.length for r in pieces) == sum({r.doc_id: r.doc_tokens for r in pieces}.values())
    assert sampling.draw is not None and packing.WINDOW == 4096


def test_repeated_rows_and_other_columns(spark):
    rows = [(1, "one two three four five six", None), (1, "one two three four five six", None), (2, None, "x"), (None, "", "y"),
            (3, "one two three four five six", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    out = cp.drop_near_copies(spark, docs, SF)
    assert out.columns == docs.columns
    assert sorted(map(repr, (r.doc_id for r in out.collect()))) == sorted(map(repr, (1, 2, None)))
