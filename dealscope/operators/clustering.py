"""Text clustering of business labels with MLlib (tokenise, hashing TF,
KMeans, silhouette sweep, cluster naming by top words).

All steps are distributed: feature vectors are sparse (1000 hash buckets),
KMeans and the silhouette evaluator aggregate per cluster on the executors,
and naming keeps only the top words of each group (bounded, never a whole
group on one task).  KMeans depends on partitioning even with a seed, so
the features are laid out deterministically (hash-partitioned and sorted
by key) and persisted once for all fits of a sweep.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

NUM_FEATURES = 1000
SEED = 42


def label_tokens(df: DataFrame, text_col: str = "business_usecase_type", out: str = "words") -> DataFrame:
    """Lower-case whitespace tokens of non-NULL labels."""
    return Tokenizer(inputCol=text_col, outputCol=out).transform(df.na.drop(subset=[text_col]))


def label_features(df: DataFrame, words_col: str = "words", out: str = "features",
                   num_features: int = NUM_FEATURES) -> DataFrame:
    return HashingTF(inputCol=words_col, outputCol=out, numFeatures=num_features).transform(df)


def weighted_label_features(df: DataFrame, text_col: str = "business_usecase_type") -> DataFrame:
    """One row per distinct label with ``weight`` = its number of rows.

    Labels are short phrases, so distinct labels are far fewer than rows:
    pre-aggregating before the iterative fits shrinks every KMeans pass and
    silhouette evaluation; weights make the objective equal to the one on
    the repeated rows.  Deterministic layout (hash-partitioned and sorted by
    label, partition count sized by AQE from the data) so a seeded fit does
    not depend on upstream partitioning."""
    distinct = (df.where(F.col(text_col).isNotNull())
                .groupBy(text_col).agg(F.count(F.lit(1)).cast("double").alias("weight")))
    feats = label_features(label_tokens(distinct, text_col))
    return feats.repartition(text_col).sortWithinPartitions(text_col)


def fit_clusters(features: DataFrame, k: int, seed: int = SEED):
    return KMeans(featuresCol="features", weightCol="weight", k=k, seed=seed).fit(features)


def assign_clusters(rows: DataFrame, k: int, seed: int = SEED, text_col: str = "business_usecase_type") -> DataFrame:
    """Rows with their cluster ``prediction``: fit on the weighted distinct
    labels, then apply the model (k centres) to the rows themselves -- no join
    by label, so a frequent label meets in no task."""
    feats = weighted_label_features(rows, text_col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = fit_clusters(feats, k, seed)  # iterative: reads the persisted features
    finally:
        feats.unpersist()
    return model.transform(label_features(label_tokens(rows, text_col))).drop("features")


def silhouette_sweep(spark: SparkSession, rows: DataFrame, ks=range(2, 16), seed: int = SEED,
                     text_col: str = "business_usecase_type", parallelism: int = 4) -> DataFrame:
    """``(k, silhouette_score)`` for each k; one distributed fit per k on the
    persisted weighted features.  The fits are independent, so up to
    ``parallelism`` of them are submitted concurrently (like
    ``CrossValidator(parallelism=...)``); each fit is still seeded and
    deterministic.  The assignments of all k are scored together by one plan
    over sufficient statistics."""
    from concurrent.futures import ThreadPoolExecutor

    feats = weighted_label_features(rows, text_col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        feats.count()  # materialise once before the concurrent fits
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            models = list(pool.map(lambda k: fit_clusters(feats, k, seed), list(ks)))
        assigned = None
        for k, model in zip(ks, models, strict=True):
            one = model.transform(feats).select(F.lit(int(k)).alias("k"), F.col(text_col).alias("item"),
                                                F.col("prediction").alias("cluster"), "weight")
            assigned = one if assigned is None else assigned.unionByName(one)
        scores = silhouette(assigned, feature_cells(feats, text_col), "k").orderBy("k").collect()  # one row per k
    finally:
        feats.unpersist()
    return spark.createDataFrame([(r.k, r.silhouette_score) for r in scores], "k int, silhouette_score double")


def feature_cells(features: DataFrame, item_col: str, features_col: str = "features") -> DataFrame:
    """``item, bucket, tf``: the non-zero entries of every item's feature vector."""
    entries = F.transform(vector_to_array(features_col), lambda x, i: F.struct(i.alias("bucket"), x.alias("tf")))
    return features.select(F.col(item_col).alias("item"), F.explode(F.filter(entries, lambda e: e.tf != 0)).alias("e")) \
        .select("item", "e.bucket", "e.tf")


def silhouette_items(assigned: DataFrame, cells: DataFrame, *by: str) -> DataFrame:
    """Every row of ``assigned`` (``by``, item, cluster, weight) with its ``silhouette``, squared Euclidean.

    The mean squared distance of a point x to a cluster of weight N, vector
    sum Y and sum of squared norms P is |x|^2 + P/N - 2 x.Y/N, so the clusters'
    sums are all that is needed: no distances between items.  Its own cluster
    counts without the item itself; an item alone in its cluster scores 0.

    ``cells`` holds the items' sparse features (item, bucket, tf).  The sums
    have one row per cluster and bucket at most, and each item meets every
    cluster's statistics, not every other item.
    """
    norms = cells.groupBy("item").agg(F.sum(F.col("tf") * F.col("tf")).alias("norm"))
    points = assigned.join(norms, "item", "left").na.fill(0.0, ["norm"])
    stats = points.groupBy(*by, "cluster").agg(
        F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("norm")).alias("p"))
    sums = assigned.join(cells, "item").groupBy(*by, "cluster", "bucket").agg(
        F.sum(F.col("weight") * F.col("tf")).alias("y"))
    dots = (assigned.select(*by, "item").join(cells, "item").join(sums, [*by, "bucket"])
            .groupBy(*by, "item", "cluster").agg(F.sum(F.col("tf") * F.col("y")).alias("dot")))
    # a list of its clusters per setting: as many entries as there are clusters
    every = stats.groupBy(*by, F.lit(0).alias("_all")).agg(F.collect_list(F.struct(F.col("cluster").alias("c"), "n", "p")).alias("_s"))
    pairs = (points.withColumn("_all", F.lit(0)).join(F.broadcast(every), [*by, "_all"]).withColumn("_s", F.explode("_s"))
             .select(*by, "item", F.col("cluster").alias("own"), "weight", "norm", F.col("_s.c").alias("cluster"), "_s.n", "_s.p")
             .join(dots, [*by, "item", "cluster"], "left").na.fill(0.0, ["dot"]))
    distance = F.col("norm") + F.col("p") / F.col("n") - 2 * F.col("dot") / F.col("n")
    others = F.col("n") - F.col("weight")
    mine = F.col("cluster") == F.col("own")
    found = pairs.groupBy(*by, "item", F.col("own").alias("cluster"), "weight").agg(
        F.max(F.when(mine & (others > 0), distance * F.col("n") / others)).alias("a"),
        F.min(F.when(~mine, distance)).alias("b"))
    score = (F.when(F.col("a").isNull() | F.col("b").isNull(), F.lit(0.0))
             .when(F.col("a") < F.col("b"), 1 - F.col("a") / F.col("b"))
             .when(F.col("a") > F.col("b"), F.col("b") / F.col("a") - 1).otherwise(F.lit(0.0)))
    return found.withColumn("silhouette", score).drop("a", "b")


def silhouette(assigned: DataFrame, cells: DataFrame, *by: str) -> DataFrame:
    """``silhouette_score`` per ``by``: the weighted mean over the items."""
    return silhouette_items(assigned, cells, *by).groupBy(*by).agg(
        (F.sum(F.col("silhouette") * F.col("weight")) / F.sum("weight")).alias("silhouette_score"))


def cluster_sizes(clusters: DataFrame, group_col: str = "prediction") -> DataFrame:
    return clusters.groupBy(group_col).agg(F.count(F.lit(1)).alias("usecase_count"))


def top_words(df: DataFrame, group_col: str, words_col: str = "words", top: int = 5) -> DataFrame:
    """Per group: its ``top`` most frequent words (ties by word) joined by a
    space in rank order -- the group's name."""
    counts = (df.select(group_col, F.explode(words_col).alias("word"))
              .groupBy(group_col, "word").agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy(group_col).orderBy(F.desc("n"), F.asc("word"))
    ranked = counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    named = ranked.groupBy(group_col).agg(
        F.sort_array(F.collect_list(F.struct("rank", "word"))).alias("_ranked"))
    return named.select(group_col, F.array_join(F.col("_ranked.word"), " ").alias("category_name"))


def cluster_names(clusters: DataFrame, group_col: str = "prediction", top: int = 5) -> DataFrame:
    """Cluster name and size per cluster (names joined to sizes)."""
    return top_words(clusters, group_col, top=top).join(cluster_sizes(clusters, group_col), group_col, "left")


def named_rows(clusters: DataFrame, group_col: str = "prediction", top: int = 5) -> DataFrame:
    """Every clustered row with its cluster's name and size (one row per
    cluster, so that side is broadcast)."""
    return clusters.join(F.broadcast(cluster_names(clusters, group_col, top)), group_col, "left")
