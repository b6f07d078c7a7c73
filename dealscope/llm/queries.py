"""Registered queries of this subpackage: each applies one operator to its whole table and derives the digest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealscope.llm import (
    alignment,
    common,
    decontamination,
    fingerprints,
    language_id,
    neighbours,
    ngram_join,
    packing,
    periodic_runs,
    quality,
    sharding,
    token_counts,
    token_orc,
    toxicity,
)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.read_documents(spark, sf_dir), with_ids=False)


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_edits(common.read_documents(spark, sf_dir))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(common.read_documents(spark, sf_dir), common.read_documents(spark, sf_dir, "labels"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(common.read_documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link(common.read_documents(spark, sf_dir))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(common.read_documents(spark, sf_dir))


def op7_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.new_path(spark, "tokens")
    token_orc.write(common.read_documents(spark, sf_dir), path)
    return token_orc.checksums(token_orc.read(spark, path))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(common.read_documents(spark, sf_dir),
                                   common.read_documents(spark, sf_dir, "benchmark"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(common.read_documents(spark, sf_dir))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(common.read_documents(spark, sf_dir))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_figures(common.read_documents(spark, sf_dir))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.planted(common.read_documents(spark, sf_dir))
    return periodic_runs.digest(periodic_runs.periodic_runs(docs))


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = common.read_documents(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0"))


QUERIES = {f.__name__: f for f in (
    op1_packing, op2_fingerprints, op3_toxicity, op4_sharding, op5_ngram_jaccard, op6_language_id, op7_token_orc,
    op8_decontamination, op9_quality, op10_token_counts, op11_alignment,
    op12_periodic_runs, op13_neighbours)}

#: The same join stated as SQL: all pairs that share a shingle, then the transitive closure of the links.
SQL = {"op5_ngram_jaccard": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) END AS s
  FROM words),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
rows_ AS (SELECT doc_id, unnest(s) AS g FROM sets),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM rows_ a JOIN rows_ b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * o >= 75 * (p.n + q.n - o)),
reach AS (SELECT doc_id, doc_id AS r FROM n UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.r)
SELECT n.doc_id, n.n AS n_shingles, min(r) AS component_id FROM n JOIN reach USING (doc_id) GROUP BY ALL
""",
    "op8_decontamination": r"""
WITH words AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents),
ds AS (
  SELECT doc_id, unnest(range(0, len(w) - 4)) AS i,
    unnest([array_to_string(w[k:k + 4], ' ') for k in range(1, len(w) - 3)]) AS g
  FROM words WHERE len(w) >= 5),
items AS (
  SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
bs AS (
  SELECT item_id, len(w) AS l, unnest(range(0, len(w) - 4)) AS j,
    unnest([array_to_string(w[k:k + 4], ' ') for k in range(1, len(w) - 3)]) AS g
  FROM items WHERE len(w) >= 5),
wins AS (SELECT DISTINCT doc_id, item_id, l, i - j AS start FROM ds JOIN bs USING (g)),
wc AS (
  SELECT wins.doc_id, item_id, start, l, g, count(*) AS c FROM wins JOIN ds ON ds.doc_id = wins.doc_id
    AND ds.i BETWEEN start AND start + l - 5 GROUP BY ALL),
ic AS (SELECT item_id, g, count(*) AS c FROM bs GROUP BY ALL),
mins AS (
  SELECT doc_id, item_id, start, l, sum(least(wc.c, ic.c)) AS m FROM wc JOIN ic USING (item_id, g) GROUP BY ALL),
n AS (SELECT doc_id, item_id, start, sum(c) AS n FROM wc GROUP BY ALL),
sims AS (
  SELECT doc_id, item_id, greatest(start, 0) AS start, l, CAST(m AS DOUBLE) / (n + l - 4 - m) AS similarity
  FROM mins JOIN n USING (doc_id, item_id, start))
SELECT doc_id, item_id, CAST(start AS BIGINT) AS start, CAST(l AS BIGINT) AS n_words, similarity FROM sims
WHERE similarity * 100 >= 75
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""}
