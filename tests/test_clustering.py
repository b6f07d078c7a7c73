"""Closed-form silhouette against MLlib's, and the fixpoint of a converged clustering."""

import math
import random

import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from dealscope.operators import clustering as cl

WORDS = "fraud churn forecast ledger stock price claim route risk lead".split()


@pytest.fixture(scope="module")
def labels(spark):
    rng = random.Random(3)
    rows = [(" ".join(rng.sample(WORDS, rng.randrange(1, 4))),) for _ in range(400)] + [(None,), ("alone here",)]
    return spark.createDataFrame(rows, "business_usecase_type string")


def test_scores_equal_mllib(spark, labels):
    feats = cl.weighted_label_features(labels).cache()
    got = {r.k: r.silhouette_score for r in cl.silhouette_sweep(spark, labels, ks=range(2, 7)).collect()}
    assert sorted(got) == [2, 3, 4, 5, 6]
    for k, score in got.items():
        clustered = cl.fit_clusters(feats, k).transform(feats)
        want = ClusteringEvaluator(featuresCol="features", weightCol="weight").evaluate(clustered)
        assert math.isclose(score, want, abs_tol=1e-9)
    feats.unpersist()


def test_items_alone_and_one_cluster(spark):
    items = spark.createDataFrame([("a", 0, 1.0), ("b", 1, 1.0), ("c", 1, 2.0), ("none", 1, 1.0)], "item string, cluster int, weight double")
    cells = spark.createDataFrame([("a", 1, 1.0), ("b", 2, 1.0), ("c", 2, 2.0)], "item string, bucket int, tf double")
    got = {r.item: r.silhouette for r in cl.silhouette_items(items, cells).collect()}
    # b: own (2 * 1 + 1 * 1) / 3 = 1, other 2; c: own (1 + 4) / 2, other 5; an item without features lies at the origin
    assert got["a"] == 0.0 and math.isclose(got["b"], 0.5) and math.isclose(got["c"], 0.5)
    # own (1 * 1 + 2 * 4) / 3 = 3, other 1
    assert math.isclose(got["none"], 1 / 3 - 1)
    one = items.withColumn("cluster", F.lit(0))
    assert {r.silhouette for r in cl.silhouette_items(one, cells).collect()} == {0.0}
    assert cl.silhouette_items(items.limit(0), cells).count() == 0


def test_a_converged_clustering_is_a_fixpoint(spark, labels):
    """Centres are the weighted means of their labels, and each label's own centre is its nearest."""
    feats = cl.weighted_label_features(labels).cache()
    model = KMeans(featuresCol="features", weightCol="weight", k=5, seed=cl.SEED, maxIter=200, tol=0.0).fit(feats)
    rows = model.transform(feats).select("prediction", "weight", vector_to_array("features").alias("x")).collect()
    centres = model.clusterCenters()
    for c, centre in enumerate(centres):
        own = [(r.weight, r.x) for r in rows if r.prediction == c]
        total = sum(w for w, _ in own)
        assert all(math.isclose(sum(w * x[i] for w, x in own) / total, centre[i], abs_tol=1e-9) for i in range(len(centre)))
    for r in rows:
        far = [sum((a - b) ** 2 for a, b in zip(r.x, centre)) for centre in centres]
        assert far[r.prediction] <= min(far) + 1e-9
    feats.unpersist()


def test_named_rows_names_the_clusters_too(spark, monkeypatch):
    """The query fits the clusters; their names and sizes are flags, the category's are values."""
    from dealscope.plans import queries
    rows = [(str(i), "BI" if i % 2 else "ETL", f"{WORDS[i % 8]} {WORDS[i // 4]}") for i in range(40)] + [("x", "BI", None)]
    view = spark.createDataFrame(rows, "usecase_id string, usecase_type string, business_usecase_type string")
    fitted = []
    monkeypatch.setattr(queries, "_labels_view", lambda *_: view)
    monkeypatch.setattr(cl, "fit_clusters", lambda feats, k, *a, f=cl.fit_clusters: fitted.append(k) or f(feats, k, *a))
    got = queries.named_rows(spark, "").collect()
    assert fitted == [queries.CLUSTER_K]
    assert sorted(r.usecase_id for r in got) == sorted(str(i) for i in range(40))
    assert all(r.size_ok and r.named and r.usecase_count == 20 for r in got)
    assert {r.usecase_type for r in got} == {"BI", "ETL"} and len({r.category_name for r in got}) == 2
