"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory.  Each reads the test tables (through the
``usecases`` fixture mapping) so its work grows with them."""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealscope.functions import answers as ans
from dealscope.functions import text as tx
from dealscope.operators import clustering as cl
from dealscope.operators import enrich as en
from dealscope.operators import extract as ex
from dealscope.operators import inference as inf
from dealscope.operators import rollup as ru
from dealscope.operators import upsert as up
from dealscope.plans import incremental as inc
from dealscope.plans import reporting as rp
from dealscope.settings import ACCELERATION_LABELS, DEFAULT, DIMENSIONS, SLIPPAGE_LABELS, USECASE_TYPES
from dealscope.sources import fixtures as fx
from dealscope.sources.bucketed import BucketedTable
from dealscope.sources.target import conform

S = DEFAULT
REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def _uc(spark, sf_dir, *columns: str) -> DataFrame:
    """The source; a query over all its rows names the columns it reads."""
    return fx.usecases(spark, sf_dir, S, columns)


#: For sources that come spread: the chain does not partition their rows, texts included, once more.
SPREAD = dataclasses.replace(S, enrich_partitions=1)


def _spread(spark, sf_dir, *columns: str) -> DataFrame:
    """The source for the enrichment chain and the views: by key in as many parts as they would make of it, without its
    texts being shuffled."""
    return fx.usecases(spark, sf_dir, S, columns, spread=S.enrich_partitions or int(spark.conf.get("spark.sql.shuffle.partitions")))


# -- sources and filters ------------------------------------------------------

@register("source_scan")
def source_scan(spark, sf_dir):
    cols = ("usecase_id", "last_modified_date", "stage", "estimated_monthly_value", "target_live_date")
    return _uc(spark, sf_dir, *cols).select(*cols)


@register("incremental_rows")
def incremental_rows(spark, sf_dir):
    return (_uc(spark, sf_dir, "usecase_id", "last_modified_date").where(ex.changed_since(fx.FIXTURE_WATERMARK))
            .select("usecase_id", "last_modified_date"))


@register("value_threshold")
def value_threshold(spark, sf_dir):
    return _uc(spark, sf_dir, "usecase_id", "estimated_monthly_value").where(ex.value_at_least(S)).select("usecase_id", "estimated_monthly_value")


@register("stage_exclusion")
def stage_exclusion(spark, sf_dir):
    return _uc(spark, sf_dir, "usecase_id", "stage").where(ex.stage_allowed(S)).select("usecase_id", "stage")


@register("lookahead_window")
def lookahead_window(spark, sf_dir):
    return _uc(spark, sf_dir, "usecase_id", "target_live_date").where(ex.live_in_window(S)).select("usecase_id", "target_live_date")


@register("recency_floor")
def recency_floor(spark, sf_dir):
    return _uc(spark, sf_dir, "usecase_id", "last_modified_date").where(ex.recently_modified(S)).select("usecase_id", "last_modified_date")


@register("filtered_usecases")
def filtered_usecases(spark, sf_dir):
    return ex.extract(_uc(spark, sf_dir), fx.FIXTURE_WATERMARK, S)


@register("filtered_full_refresh")
def filtered_full_refresh(spark, sf_dir):
    return ex.full_refresh_extract(_uc(spark, sf_dir), S)


@register("owner_defaults")
def owner_defaults(spark, sf_dir):
    cols = ("usecase_id", "field_manager", "account_solution_architect", "sales_manager")
    return ex.owner_defaults(_uc(spark, sf_dir, *cols), sales_manager=True).select(*cols)


@register("region_fallback")
def region_fallback(spark, sf_dir):
    return _uc(spark, sf_dir, "usecase_id", "sales_region", "business_unit").select("usecase_id", ex.region_fallback().alias("sales_region"))


@register("vertical_default")
def vertical_default(spark, sf_dir):
    return _uc(spark, sf_dir, "usecase_id", "vertical").select("usecase_id", ex.vertical_default().alias("vertical"))


@register("blocker_default")
def blocker_default(spark, sf_dir):
    return _uc(spark, sf_dir, "usecase_id", "num_of_blockers").select("usecase_id", ex.blockers_default().alias("num_of_blockers"))


@register("text_presence")
def text_presence(spark, sf_dir):
    return _uc(spark, sf_dir).select(
        "usecase_id",
        tx.has_text("demand_plan_stage_next_steps").alias("has_next_steps"),
        tx.any_text("usecase_name", "usecase_description").alias("has_name_or_description"),
        tx.any_text("sdr_bdr_notes", "business_impact", "business_outcome_description",
                    "ae_authority", "ae_money_budget").alias("has_context"),
    )


@register("stale_flag")
def stale_flag(spark, sf_dir):
    return _uc(spark, sf_dir, "usecase_id", "last_modified_date").select("usecase_id", ex.stale(S).alias("is_stale"))


@register("cloud_match")
def cloud_match(spark, sf_dir):
    return _uc(spark, sf_dir, "usecase_id", "target_cloud").select(
        "usecase_id", F.coalesce(ex.cloud_matches(S.cloud_keyword), F.lit(False)).alias("cloud_match"))


@register("non_null_rows")
def non_null_rows(spark, sf_dir):
    cols = ("usecase_id", "sales_region", "business_unit", "vertical")
    return _uc(spark, sf_dir, *cols).select(*cols).na.drop()


@register("extract_profile")
def extract_profile(spark, sf_dir):
    return ex.extract_profile(ex.extract(_uc(spark, sf_dir), fx.FIXTURE_WATERMARK, S))


# -- answer parsing and decision rules on the stand-in answer column ----------


@register("parse_confidence")
def parse_confidence(spark, sf_dir):
    a = F.col("answer_text")
    return _uc(spark, sf_dir, "usecase_id", "answer_text").select(
        "usecase_id", ans.score_of(a).alias("confidence_score"), ans.level_of(a).alias("confidence_level"),
        ans.rationale_of(a, S.multiline_rationale).alias("rationale_for_confidence_score"))


@register("parse_dimensions")
def parse_dimensions(spark, sf_dir):
    a = F.col("answer_text")
    return _uc(spark, sf_dir, "usecase_id", "answer_text").select(
        "usecase_id", *[ans.dimension_of(a, d).alias(c) for d, c in zip(DIMENSIONS, ans.SCORE_COLUMNS)])


def _parsed_extract(spark, sf_dir):
    cols = ex.EXTRACT_COLUMNS + ("answer_text",)
    e = ex.extract(_uc(spark, sf_dir), fx.FIXTURE_WATERMARK, S, columns=cols)
    return ans.parse_answer(e, "answer_text", "num_of_blockers", S)


@register("blocker_override")
def blocker_override(spark, sf_dir):
    return _parsed_extract(spark, sf_dir).select(
        "usecase_id", "num_of_blockers", "confidence_score", "confidence_level", "rationale_for_confidence_score")


@register("normalize_level")
def normalize_level(spark, sf_dir):
    return _parsed_extract(spark, sf_dir).select(
        "usecase_id", "confidence_score",
        ans.normalized_level(F.col("confidence_score"), S).alias("confidence_level_normalized"))


@register("level_histogram")
def level_histogram(spark, sf_dir):
    return (_parsed_extract(spark, sf_dir)
            .groupBy(ans.normalized_level(F.col("confidence_score"), S).alias("confidence_level_normalized"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("weighted_score")
def weighted_score(spark, sf_dir):
    a = F.col("answer_text")
    dims = {d: ans.dimension_of(a, d) for d in DIMENSIONS}
    return _uc(spark, sf_dir, "usecase_id", "answer_text").select("usecase_id", ans.weighted_score(dims, S).alias("weighted_score"))


# -- enrichment (rule backend) -------------------------------------------------

def _enriched(spark, sf_dir, keep_inputs: bool = False):
    return en.enrich(ex.extract(_spread(spark, sf_dir), fx.FIXTURE_WATERMARK, S), SPREAD, keep_inputs=keep_inputs)


@register("enriched_results")
def enriched_results(spark, sf_dir):
    return _enriched(spark, sf_dir)


def _stage_query(name: str, *cols: str):
    def q(spark, sf_dir):
        return _enriched(spark, sf_dir).select("usecase_id", *cols)
    register(name)(q)
    return q


_stage_query("infer_context", "context")
_stage_query("infer_one_liner", "one_liner")
_stage_query("infer_next_steps", "next_steps_summary")
_stage_query("infer_implementation", "implementation_notes_summary")
_stage_query("infer_blockers", "blockers_summary")
_stage_query("classify_usecase_type", "usecase_type")
_stage_query("label_business_usecase", "business_usecase_type")
_stage_query("gen_soundbyte", "soundbyte")
_stage_query("assess_confidence", "ai_confidence_score_advanced", "confidence_score", "confidence_level",
             "rationale_for_confidence_score")
_stage_query("recommend_action", "next_best_action_recommendation")
_stage_query("classify_slippage", "likely_to_slip", "slippage_category")
_stage_query("classify_acceleration", "can_be_accelerated", "accel_category")
_stage_query("risk_flags", "confidence_level_normalized", "likely_to_slip", "can_be_accelerated")


@register("level_disagreement")
def level_disagreement(spark, sf_dir):
    return _enriched(spark, sf_dir).select(
        "usecase_id", "confidence_level", "confidence_level_normalized",
        (~F.col("confidence_level").eqNullSafe(F.col("confidence_level_normalized"))).alias("levels_disagree"))


# -- target lifecycle: watermark, upsert, change feed, bootstrap, runs ----------


def _v0(spark, sf_dir):
    """Target version 0 (a stored table in a real deployment)."""
    key = (sf_dir, repr(S), fx.input_identity(spark, sf_dir), spark.sparkContext.applicationId)
    return fx.materialized(spark, "target_v0", key,
                           lambda: inc.fixture_target_v0(_spread(spark, sf_dir), fx.FIXTURE_WATERMARK, SPREAD),
                           partition_col="usecase_id")


def _batch(spark, sf_dir, target=None):
    target = _v0(spark, sf_dir) if target is None else target
    wm = ex.watermark(target, S)
    return inc.materialize(conform(inc.incremental_batch(_spread(spark, sf_dir), wm, SPREAD)))


@register("watermark_read")
def watermark_read(spark, sf_dir):
    return ex.watermark_frame(_v0(spark, sf_dir), S)


@register("upsert_newer_wins")
def upsert_newer_wins(spark, sf_dir):
    v0 = _v0(spark, sf_dir)
    return up.upsert(v0, _batch(spark, sf_dir, v0))


@register("upsert_actions")
def upsert_actions(spark, sf_dir):
    v0 = _v0(spark, sf_dir)
    return up.upsert_actions(v0, _batch(spark, sf_dir, v0))


@register("change_feed")
def change_feed(spark, sf_dir):
    v0 = _v0(spark, sf_dir)
    return up.change_feed(v0, _batch(spark, sf_dir, v0))


@register("incremental_run")
def incremental_run(spark, sf_dir):
    return inc.incremental_state(_v0(spark, sf_dir), _spread(spark, sf_dir), SPREAD)


@register("full_refresh_run")
def full_refresh_run(spark, sf_dir):
    return inc.full_refresh(_spread(spark, sf_dir), SPREAD)


@register("bootstrap_target")
def bootstrap_target(spark, sf_dir):
    return inc.bootstrap_from_wide(inc.full_refresh(_spread(spark, sf_dir), SPREAD), S)


def _state(spark, sf_dir):
    return incremental_run(spark, sf_dir)


@register("verification_counts")
def verification_counts(spark, sf_dir):
    return rp.verification_counts(_state(spark, sf_dir), S)


@register("rows_per_run")
def rows_per_run(spark, sf_dir):
    return rp.rows_per_run(_state(spark, sf_dir))


@register("recent_top10")
def recent_top10(spark, sf_dir):
    return rp.recent_top(_state(spark, sf_dir), S, 10)


# -- reporting views -----------------------------------------------------------

def _view(spark, sf_dir, columns=rp.REPORTING_COLUMNS):
    return rp.reporting_view(_state(spark, sf_dir), _spread(spark, sf_dir, *rp.source_columns(columns)), S, columns)


@register("reporting_view")
def reporting_view(spark, sf_dir):
    return _view(spark, sf_dir)


@register("radar_view")
def radar_view(spark, sf_dir):
    return rp.radar_view(_state(spark, sf_dir), _spread(spark, sf_dir), S)


# -- roll-ups --------------------------------------------------------------------

@register("field_manager_summary")
def field_manager_summary(spark, sf_dir):
    return ru.manager_summary(_view(spark, sf_dir, ru.VIEW_COLUMNS), "field_manager", spark, S).orderBy("field_manager")


@register("sales_manager_summary")
def sales_manager_summary(spark, sf_dir):
    d = fx.directory(spark, sf_dir, S)
    return ru.manager_summary(_view(spark, sf_dir, ru.VIEW_COLUMNS), "sales_manager", spark, S, directory=d).orderBy("sales_manager")


@register("field_manager_summary_with_directory")
def field_manager_summary_with_directory(spark, sf_dir):
    d = fx.directory(spark, sf_dir, S)
    return ru.manager_summary(_view(spark, sf_dir, ru.VIEW_COLUMNS), "field_manager", spark, S, directory=d)


@register("sales_manager_summary_basic")
def sales_manager_summary_basic(spark, sf_dir):
    return ru.manager_summary(_view(spark, sf_dir, ru.VIEW_COLUMNS), "sales_manager", spark, S, contact_columns=False)


def _fm_cols(*cols):
    def q(spark, sf_dir):
        agg = ru.category_aggregate(_view(spark, sf_dir, ru.VIEW_COLUMNS), "field_manager", S)
        return ru.manager_kpis(agg, "field_manager").select("field_manager", *cols)
    return q


register("manager_totals")(_fm_cols("total_use_cases", "total_estimated_monthly_value"))
register("manager_representatives")(_fm_cols("snapshot_date", "sales_region", "sales_subregion_level_1",
                                             "sales_subregion_level_2", "sales_subregion_level_3",
                                             "sales_subregion_level_4"))
register("manager_confidence_mix")(_fm_cols("total_use_cases", "high_confidence_count", "high_confidence_pct",
                                            "medium_confidence_count", "medium_confidence_pct",
                                            "low_confidence_count", "low_confidence_pct"))
register("manager_slip_exposure")(_fm_cols("slip_usecase_count", "slip_total_monthly_value"))
register("manager_accel_exposure")(_fm_cols("accel_usecase_count", "accel_total_monthly_value"))
register("manager_stale")(_fm_cols("stale_usecase_count", "stale_total_monthly_value", "u3_stale_usecase_count",
                                   "u3_stale_total_monthly_value", "u5_stale_usecase_count",
                                   "u5_stale_total_monthly_value"))
register("manager_blockers")(_fm_cols("one_blocker_usecase_count", "one_blocker_total_monthly_value",
                                      "threeplus_blocker_usecase_count", "threeplus_blocker_total_monthly_value"))
register("manager_cloud_slice")(_fm_cols("cloud_medhigh_usecase_count", "cloud_medhigh_total_monthly_value"))


@register("category_counts")
def category_counts(spark, sf_dir):
    agg = ru.category_aggregate(_view(spark, sf_dir, ru.VIEW_COLUMNS), "sales_manager", S)
    return agg.where(F.col("dim").isin(*ru.RANK_DIMS)).select(
        "sales_manager", "dim", "category", F.col("n").alias("usecase_count"),
        F.col("value").cast("double").alias("monthly_value"))


def _top(dim):
    def q(spark, sf_dir):
        agg = ru.category_aggregate(_view(spark, sf_dir, ru.VIEW_COLUMNS), "field_manager", S)
        return (ru.ranked_categories(agg, "field_manager").where(F.col("dim") == dim)
                .select("field_manager", "category", F.col("n").alias("usecase_count"),
                        F.col("value").cast("double").alias("monthly_value"), F.col("rn").cast("long").alias("rn")))
    return q


register("top_usecase_types")(_top("usecase_type"))
register("top_slippage")(_top("slippage"))
register("top_acceleration")(_top("accel"))
register("top_verticals")(_top("vertical"))


@register("top3_slots")
def top3_slots(spark, sf_dir):
    cols = [n for n, _ in ru.slot_columns()]
    return sales_manager_summary_basic(spark, sf_dir).select("sales_manager", *cols)


@register("category_descriptions")
def category_descriptions(spark, sf_dir):
    cols = [f"top{k}_{c}" for k in (1, 2, 3) for c in ("slippage_category", "slippage_category_description",
                                                       "accel_category", "accel_category_description")]
    return field_manager_summary(spark, sf_dir).select("field_manager", *cols)


@register("directory_join")
def directory_join(spark, sf_dir):
    return sales_manager_summary(spark, sf_dir).select("sales_manager", "email", "email_status")


@register("slippage_lookup")
def slippage_lookup_counts(spark, sf_dir):
    counts = _state(spark, sf_dir).groupBy(F.col("slippage_category").alias("type")).agg(
        F.count(F.lit(1)).alias("usecase_count"))
    return ru.slippage_lookup(spark).join(counts, "type", "left").select(
        "type", "description", F.coalesce("usecase_count", F.lit(0)).alias("usecase_count"))


@register("acceleration_lookup")
def acceleration_lookup_counts(spark, sf_dir):
    counts = _state(spark, sf_dir).groupBy(F.col("accel_category").alias("type")).agg(
        F.count(F.lit(1)).alias("usecase_count"))
    return ru.acceleration_lookup(spark).join(counts, "type", "left").select(
        "type", "description", F.coalesce("usecase_count", F.lit(0)).alias("usecase_count"))


# -- scalar text operators ---------------------------------------------------------

@register("strip_html_notes")
def strip_html_notes(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages")
    return pages.select("page_id", tx.strip_html("html", S.cut_notes_at).alias("notes"))


def _managers(spark, sf_dir):
    u = _uc(spark, sf_dir, "field_manager", "sales_manager")
    return (u.select(F.col("field_manager").alias("manager"))
            .unionByName(u.select(F.col("sales_manager").alias("manager")))
            .distinct())


@register("name_parts")
def name_parts(spark, sf_dir):
    m = F.col("manager")
    return _managers(spark, sf_dir).select("manager", tx.name_first(m).alias("name"), tx.name_last(m).alias("surname"))


@register("generated_contact")
def generated_contact_q(spark, sf_dir):
    m = F.col("manager")
    return _managers(spark, sf_dir).select("manager", tx.generated_contact(m, S).alias("generated_email"))


@register("contact_resolution")
def contact_resolution(spark, sf_dir):
    return sales_manager_summary(spark, sf_dir).select("sales_manager", "name", "surname", "generated_email",
                                                       "email", "email_status")


TEMPLATE = "Account {account}: {one_liner} Type: {usecase_type}. Stage {stage}."


@register("template_fill")
def template_fill(spark, sf_dir):
    e = _enriched(spark, sf_dir, keep_inputs=True)
    st = _uc(spark, sf_dir, "usecase_id", "stage")
    j = e.join(st, "usecase_id")
    filled = tx.template_fill(TEMPLATE, {"account": F.col("account_name"), "one_liner": F.col("one_liner"),
                                         "usecase_type": F.col("usecase_type"), "stage": F.col("stage")})
    return j.select("usecase_id", filled.alias("filled"))


# -- text clustering -----------------------------------------------------------------


CLUSTER_K = 16


def _labels_view(spark, sf_dir):
    return _view(spark, sf_dir, ("usecase_id", "usecase_type", "business_usecase_type"))


@register("label_tokens")
def label_tokens(spark, sf_dir):
    return cl.label_tokens(_labels_view(spark, sf_dir)).select("usecase_id", "business_usecase_type", "words")


@register("label_features")
def label_features(spark, sf_dir):
    return cl.label_features(cl.label_tokens(_labels_view(spark, sf_dir))).select("usecase_id", "features")


def _clusters(spark, sf_dir, k=CLUSTER_K):
    return cl.assign_clusters(_labels_view(spark, sf_dir), k)


@register("label_clusters")
def label_clusters(spark, sf_dir):
    return _clusters(spark, sf_dir).select("usecase_id", "business_usecase_type", "prediction")


@register("silhouette_sweep")
def silhouette_sweep(spark, sf_dir):
    return cl.silhouette_sweep(spark, _labels_view(spark, sf_dir))


@register("cluster_sizes")
def cluster_sizes(spark, sf_dir):
    return cl.cluster_sizes(_clusters(spark, sf_dir))


@register("cluster_names")
def cluster_names(spark, sf_dir):
    return cl.cluster_names(_clusters(spark, sf_dir))


@register("named_rows")
def named_rows(spark, sf_dir):
    """Every labelled row with the name (top words) and size of its groups.  The KMeans cluster's are checked against
    the rows: its size is the number of rows returned for it, its name is not empty.  The technical category's, by the
    same functions, can be compared by value."""
    named = cl.named_rows(_clusters(spark, sf_dir)).withColumnsRenamed(
        {"category_name": "cluster_name", "usecase_count": "cluster_size"})
    returned = named.groupBy("prediction").agg(F.count(F.lit(1)).alias("returned"))
    rows = named.join(F.broadcast(returned), "prediction", "left")
    return cl.named_rows(rows, "usecase_type").select(
        "usecase_id", "business_usecase_type", (F.col("cluster_size") == F.col("returned")).alias("size_ok"),
        (F.length("cluster_name") > 0).alias("named"), "usecase_type", "category_name", "usecase_count")


@register("silhouette_by_type")
def silhouette_by_type(spark, sf_dir):
    """Silhouette of the labels' word counts for the grouping by technical category: per category its distinct labels,
    rows and mean score, by the statistics that score the sweep."""
    tokens = cl.label_tokens(_labels_view(spark, sf_dir)).select("business_usecase_type", "usecase_type", "words")
    items = (tokens.groupBy("business_usecase_type", "usecase_type").agg(F.count(F.lit(1)).cast("double").alias("weight"))
             .select(F.concat_ws("|", "business_usecase_type", "usecase_type").alias("item"),
                     F.col("usecase_type").alias("cluster"), "weight"))
    cells = (tokens.distinct().select(F.concat_ws("|", "business_usecase_type", "usecase_type").alias("item"),
                                      F.explode("words").alias("bucket"))
             .groupBy("item", "bucket").agg(F.count(F.lit(1)).cast("double").alias("tf")))
    return cl.silhouette_items(items, cells).groupBy(F.col("cluster").alias("usecase_type")).agg(
        F.count(F.lit(1)).alias("labels"), F.sum("weight").cast("long").alias("rows"),
        F.round(F.sum(F.col("silhouette") * F.col("weight")) / F.sum("weight"), 9).alias("silhouette"))


@register("label_feature_mass")
def label_feature_mass(spark, sf_dir):
    """Term-frequency mass of every row's feature vector: its number of words."""
    feats = cl.label_features(cl.label_tokens(_labels_view(spark, sf_dir)))
    mass = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x)
    return feats.select("usecase_id", mass.cast("long").alias("mass"))


@register("cluster_consistency")
def cluster_consistency(spark, sf_dir):
    """Per label: its rows, and whether they all lie in one cluster."""
    return _clusters(spark, sf_dir).groupBy("business_usecase_type").agg(
        F.count(F.lit(1)).alias("n"), (F.min("prediction") == F.max("prediction")).alias("one_cluster"))


@register("silhouette_range")
def silhouette_range(spark, sf_dir):
    return silhouette_sweep(spark, sf_dir).select(
        "k", F.col("silhouette_score").between(-1.0, 1.0).alias("in_range"))


@register("cluster_total")
def cluster_total(spark, sf_dir):
    """Rows of all clusters together."""
    return cl.cluster_sizes(_clusters(spark, sf_dir)).agg(F.sum("usecase_count").alias("n"))


@register("group_top_words")
def group_top_words(spark, sf_dir):
    toks = cl.label_tokens(_labels_view(spark, sf_dir))
    return cl.top_words(toks, "usecase_type").join(cl.cluster_sizes(toks, "usecase_type"), "usecase_type", "left")


# -- prompt de-duplication (I13) -------------------------------------------------------


@register("infer_distinct_prompts")
def infer_distinct_prompts(spark, sf_dir):
    """Per stage, for all twelve: rows, prompts actually sent (guard true) and
    distinct prompts after the ``sha2`` de-duplication -- the calls a model
    backend would pay.  Later levels' prompts are built on the enriched rows."""
    e = _enriched(spark, sf_dir, keep_inputs=True)
    long, _ = inf.distinct_prompts(e, "usecase_id", {s.name: s.guarded_prompt() for s in en.all_stages(S)})
    return long.groupBy("stage").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("prompt").alias("sent"),
        F.count_distinct(F.when(F.col("prompt").isNotNull(), F.col("h"))).alias("distinct_prompts"))


def _prompt_length(prompts: list[str]) -> list[str]:
    return [str(len(p)) for p in prompts]


@register("infer_model_answers")
def infer_model_answers(spark, sf_dir):
    """The model path end to end with a deterministic function (a prompt's
    length) in place of a model: all twelve stages' prompts, de-duplicated,
    sent in batches, checkpointed and joined back; NULL where the guard is
    false."""
    e = _enriched(spark, sf_dir, keep_inputs=True)
    return inf.infer_long(e, "usecase_id", {s.name: s.guarded_prompt() for s in en.all_stages(S)}, _prompt_length)


@register("version_diff")
def version_diff(spark, sf_dir):
    """Change feed between target version 0 and the state after the run,
    computed by diffing the two versions (null-safe whole-row compare)."""
    return up.diff_versions(conform(_v0(spark, sf_dir)), _state(spark, sf_dir))


# -- runs on a bucketed table ------------------------------------------------------------

RUN_BUCKETS = 16
#: Source state that each of three successive runs sees: changes up to this date (None: all).
RUN_CUTS = (dt.date(2001, 5, 1), dt.date(2001, 6, 15), None)


def _seeded(spark, sf_dir, name: str) -> BucketedTable:
    """A table of its own in the shared folder, holding target version 0."""
    table = BucketedTable(spark, f"{fx.shared_root(spark)}/dealscope-runs/{name}-{uuid.uuid4().hex}", buckets=RUN_BUCKETS)
    table.write_next(_v0(spark, sf_dir))
    return table


@register("bucketed_upsert")
def bucketed_upsert(spark, sf_dir):
    """Upsert into a written table, touched buckets only, and the table read back."""
    table = _seeded(spark, sf_dir, "upsert")
    table.merge(_batch(spark, sf_dir, table.read()))
    return table.read()


@register("incremental_run_written")
def incremental_run_written(spark, sf_dir):
    """One whole run on a written table: key check, write, commit, read-back, the six counts and the rows per action.
    A first attempt ends when its files are written and nothing is committed; the run is then started again."""
    table = _seeded(spark, sf_dir, "run")
    before = table.current_version()

    def ends(version: int) -> None:
        raise InterruptedError(f"planted end before the commit of version {version}")

    source = _uc(spark, sf_dir)
    try:
        inc.run_incremental(spark, source, table, S, before_commit=ends)
    except InterruptedError:
        pass
    lost = table.current_version() != before
    run = inc.run_incremental(spark, source, table, S)
    read_back = table.read().agg(F.count(F.lit(1)).alias("count"), F.count_distinct("usecase_id").alias("keys"))
    counted = read_back.select(F.inline(F.array(
        F.struct(F.lit("Rows read back").alias("metric"), F.col("count")),
        F.struct(F.lit("Keys read back").alias("metric"), F.col("keys").alias("count")))))
    noted = [(f"Rows {a}", run.actions.get(a, 0)) for a in ("insert", "update", "unchanged")]
    noted += [("Rows in the batch", run.batch_rows), ("Versions committed by an ended run", int(lost))]
    return run.metrics.unionByName(counted).unionByName(spark.createDataFrame(noted, "metric string, count long"))


def _three_runs(spark, sf_dir, name: str) -> tuple[BucketedTable, int]:
    """A table after three runs over the same rows as the source showed them at three dates, and its version before."""
    table = _seeded(spark, sf_dir, name)
    base = table.current_version()
    batch = _batch(spark, sf_dir, table.read())
    for i, cut in enumerate(RUN_CUTS):
        as_of = S.as_of - dt.timedelta(days=len(RUN_CUTS) - 1 - i)
        seen = F.col("last_modified_date") if cut is None else F.least(F.col("last_modified_date"), F.lit(cut))
        properties = dataclasses.replace(inc.run_properties(S, cut), as_of=as_of)
        table.merge(batch.withColumns({"last_modified_date": seen, "processed_date": F.lit(as_of)}), properties=properties)
    return table, base


@register("change_feed_range")
def change_feed_range(spark, sf_dir):
    """The stored changes of the second and third run: a range of versions, read without comparing states."""
    table, base = _three_runs(spark, sf_dir, "feed")
    return table.changes(base + 1, base + 3).withColumn("run", F.col("_version") - base).drop("_version")


@register("change_feed_net")
def change_feed_net(spark, sf_dir):
    """What three runs come to per key: one insert, or one update from its first to its last state."""
    table, base = _three_runs(spark, sf_dir, "net")
    return table.net_changes(base).withColumn("run", F.col("_version") - base).drop("_version")


@register("run_properties")
def run_properties(spark, sf_dir):
    """The properties stored with each version, with the rows that its run inserted and updated."""
    table, base = _three_runs(spark, sf_dir, "properties")
    return table.rows_per_version().withColumn("run", F.col("_version") - base).drop("_version")


# -- answers of earlier runs; the chain on model answers -----------------------------------


@register("infer_cached")
def infer_cached(spark, sf_dir):
    """Three runs that share stored answers: per run and stage the distinct prompts asked for, found and sent.
    The first run has the earlier rows only, the others all; the third sends nothing."""
    rows = _enriched(spark, sf_dir, keep_inputs=True)
    prompts = {s.name: s.guarded_prompt() for s in en.all_stages(S)}
    path = f"{fx.shared_root(spark)}/dealscope-runs/answers-{uuid.uuid4().hex}"
    out = None
    for run, part in enumerate((rows.where(F.col("last_modified_date") <= F.lit(inc.FIXTURE_CUT_DATE)), rows, rows), 1):
        cache = inf.AnswerCache(spark, path, "length", "v1", run=f"run-{run}")
        inf.infer_long(part, "usecase_id", prompts, _prompt_length, cache=cache)
        asked = inf.distinct_prompts(part, "usecase_id", prompts)[0].where(F.col("prompt").isNotNull()).select("stage", "h")
        sent = F.count_if(F.col("run") == cache.run)
        one = asked.distinct().join(inc.materialize(cache.known().select("h", "run")), "h").groupBy("stage").agg(
            F.lit(run).cast("long").alias("run"), F.count(F.lit(1)).alias("asked"),
            (F.count(F.lit(1)) - sent).alias("found"), sent.alias("sent"))
        out = one if out is None else out.unionByName(one)
    return out


def structured_answers(prompts: list[str]) -> list[str | None]:
    """A deterministic stand-in for a model: what it answers depends on the task a prompt names and on its length.

    It gives structured assessments and labels, and now and then what a model does wrong: a label outside the closed
    set, an assessment without structure, no answer, a failing call."""
    def closed(labels, n: int) -> str:
        return (*labels, "Nonsense")[n % (len(labels) + 1)]

    out = []
    for prompt in prompts:
        n = len(prompt)
        if n % 29 == 0:
            raise RuntimeError("the call fails")
        if prompt.startswith("Pick the technical category"):
            out.append(closed(USECASE_TYPES, n))
        elif prompt.startswith("Pick the main reason"):
            out.append(closed(SLIPPAGE_LABELS, n))
        elif prompt.startswith("Pick the main lever"):
            out.append(closed(ACCELERATION_LABELS, n))
        elif prompt.startswith("Score this use case"):
            scores = ", ".join(f"{d}={n * (i + 1) % 11}" for i, d in enumerate(DIMENSIONS))
            level = ("High", "Medium", "Low")[n % 3]
            out.append("no assessment" if n % 7 == 0 else
                       f"CONFIDENCE_SCORE: {n % 21 * 5}\nLEVEL: {level}\nRATIONALE: a prompt of {n} characters.\n"
                       f"DIMENSION_SCORES: {scores}")
        elif prompt.startswith("Recommend"):
            out.append(f"NEXT_BEST_ACTION: call {n}\nRATIONALE: {n % 10} reasons.")
        else:
            out.append(None if n % 13 == 0 else f"answer {n}")
    return out


@register("enriched_by_model")
def enriched_by_model(spark, sf_dir):
    """The whole five-level chain on answers of a model function: every level's prompts are built on the answers of the
    levels before, checkpointed per level, parsed, and replaced by defaults where the model fails."""
    return en.enrich(ex.extract(_spread(spark, sf_dir), fx.FIXTURE_WATERMARK, S), SPREAD, structured_answers)
