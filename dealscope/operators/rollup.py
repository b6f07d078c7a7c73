"""Per-manager roll-up (KPIs, level mix, exposures, top-3 categories,
contact columns), one function for any manager column.

Physical plan: the view is read once.  Each row is expanded into five
records -- one ``__all__`` record carrying the KPI measures and one per
ranking dimension (use-case type, slippage category, acceleration
category, vertical) -- and a single aggregation (partial aggregation on the
map side, so the shuffle carries at most managers x categories rows per
task) produces both the KPIs and the category counts.  Rankings, slot
pivoting and the look-up joins then run on that small aggregate: no
twelve rank-slot self joins, no repeated scans of the view.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealscope.functions.text import generated_contact, name_first, name_last
from dealscope.settings import ACCELERATION_CATEGORIES, DEFAULT, SLIPPAGE_CATEGORIES, Settings

VALUE = "estimated_monthly_value"
MONEY = T.DecimalType(18, 4)  # exact sums; reported as double

# Ranking dimensions: (name, category column, row filter, order by value sum?)
DIMENSIONS = (
    ("usecase_type", "usecase_type", None, True),
    ("slippage", "slippage_category", "likely_to_slip", False),
    ("accel", "accel_category", "can_be_accelerated", False),
    ("vertical", "vertical", None, False),
)
ALL = "__all__"
RANK_DIMS = tuple(d[0] for d in DIMENSIONS)
# Representative columns (any value per manager; we take the minimum) travel
# as records too, so the large aggregate keeps fixed-width buffers only
# (HashAggregate); their min is taken on the small aggregate.
REPRESENTATIVES = ("sales_region", *[f"sales_subregion_level_{i}" for i in range(1, 5)])
#: Columns of the reporting view that the roll-ups read.
VIEW_COLUMNS = ("field_manager", "sales_manager", "snapshot_date", VALUE, "stage", "target_cloud", "last_modified_date",
                *REPRESENTATIVES, "num_of_blockers", "confidence_level_normalized", "usecase_type", "likely_to_slip",
                "slippage_category", "can_be_accelerated", "accel_category", "vertical")


def _rep_dim(c: str) -> str:
    return "rep:" + c


def lookup_frame(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(list(rows), "type string, description string")


def slippage_lookup(spark: SparkSession) -> DataFrame:
    return lookup_frame(spark, SLIPPAGE_CATEGORIES)


def acceleration_lookup(spark: SparkSession) -> DataFrame:
    return lookup_frame(spark, ACCELERATION_CATEGORIES)


def money_sum(cond: Column | None = None) -> Column:
    v = F.col(VALUE).cast(MONEY)
    if cond is not None:
        v = F.when(cond, v).otherwise(F.lit(0).cast(MONEY))
    return F.sum(v)


def pct(n: Column, total: Column) -> Column:
    """``round(100 * n / total, 2)`` half-up, computed exactly."""
    return (F.floor((F.lit(20000) * n + total) / (F.lit(2) * total)) / F.lit(100)).cast("double")


_MEASURES: dict = {}


def _kpi_measures(s: Settings) -> dict[str, tuple[Column | None, bool]]:
    """name -> (row condition, with value sum); built once per settings
    (Column trees are immutable; building them costs driver round trips)."""
    key = repr(s)
    if key not in _MEASURES:
        _MEASURES[key] = _build_kpi_measures(s)
    return _MEASURES[key]


def _build_kpi_measures(s: Settings) -> dict[str, tuple[Column | None, bool]]:
    lvl = F.col("confidence_level_normalized")
    stale = F.col("last_modified_date") < F.date_sub(F.lit(s.as_of), s.stale_days)
    cloud = F.lower(F.col("target_cloud")).contains(s.cloud_keyword.lower())
    return {
        "high_confidence": (lvl == "High", False),
        "medium_confidence": (lvl == "Medium", False),
        "low_confidence": (lvl == "Low", False),
        "slip": (F.col("likely_to_slip") == F.lit(True), True),
        "accel": (F.col("can_be_accelerated") == F.lit(True), True),
        "stale": (F.col("stage").isin(*s.stale_kpi_stages) & stale, True),
        "u3_stale": ((F.col("stage") == "U3") & stale, True),
        "u5_stale": ((F.col("stage") == "U5") & stale, True),
        "one_blocker": (F.col("num_of_blockers") == 1, True),
        "cloud_medhigh": (F.col("stage").isin(*s.cloud_slice_stages) & lvl.isin("Medium", "High") & cloud, True),
        "threeplus_blocker": (F.col("num_of_blockers") >= 3, True),
    }


def _cnt(cond: Column) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")


def category_aggregate(view: DataFrame, entity: str, settings: Settings = DEFAULT) -> DataFrame:
    """One pass: per (entity, dim, category) count and value, the KPI
    measures on the ``__all__`` records, and one record per representative
    column value.  The measures' conditions are evaluated once per row and
    travel on its ``__all__`` record alone, as bits of one number.  All
    aggregation buffers are fixed-width (HashAggregate with map-side partial
    aggregation)."""
    measures = _kpi_measures(settings)
    bits = None
    for i, (cond, _) in enumerate(measures.values()):
        bit = F.when(cond, F.lit(1 << i)).otherwise(F.lit(0))
        bits = bit if bits is None else bits + bit

    def record(dim: str, category: Column, flags: Column) -> Column:
        return F.struct(F.lit(dim).alias("dim"), category.cast("string").alias("category"), flags.alias("flags"))

    recs = [record(ALL, F.lit(None), bits)]
    for name, col, flt, _ in DIMENSIONS:
        rec = record(name, F.col(col), F.lit(0))
        recs.append(rec if flt is None else F.when(F.col(flt) == F.lit(True), rec))
    recs += [record(_rep_dim(c), F.col(c), F.lit(0)) for c in REPRESENTATIVES]
    exploded = (view.select(entity, VALUE, "snapshot_date",
                            F.explode(F.filter(F.array(*recs), lambda r: r.isNotNull())).alias("r"))
                .select("*", "r.dim", "r.category", "r.flags").drop("r"))
    is_all = F.col("dim") == ALL
    aggs = [
        F.count(F.lit(1)).alias("n"),
        money_sum().alias("value"),
        # representative snapshot date: deterministic min() instead of any_value()
        F.min(F.when(is_all, F.col("snapshot_date"))).alias("snapshot_date"),
    ]
    for i, (n, (_, with_value)) in enumerate(measures.items()):
        holds = F.col("flags").bitwiseAND(F.lit(1 << i)) != 0
        aggs.append(_cnt(holds).alias(f"{n}_n"))
        if with_value:
            aggs.append(money_sum(holds).alias(f"{n}_value"))
    return exploded.groupBy(entity, "dim", "category").agg(*aggs)


def _representatives() -> list[Column]:
    return [F.min(F.when(F.col("dim") == _rep_dim(c), F.col("category"))).alias(c) for c in REPRESENTATIVES]


def ranked_categories(agg: DataFrame, entity: str, top: int = 3) -> DataFrame:
    """Rank categories within (entity, dim): by value sum for use-case types,
    by count otherwise; ties broken by category name."""
    by_value = F.col("dim") == "usecase_type"
    w = Window.partitionBy(entity, "dim").orderBy(
        F.when(by_value, F.col("value")).otherwise(F.col("n").cast(MONEY)).desc(),
        F.col("category").asc_nulls_last())
    return (agg.where(F.col("dim").isin(*RANK_DIMS))
            .withColumn("rn", F.row_number().over(w))
            .where(F.col("rn") <= top))


_SLOT_AGGS: dict = {}


def _slot_aggs(top: int = 3) -> list[Column]:
    if top not in _SLOT_AGGS:
        _SLOT_AGGS[top] = _build_slot_aggs(top)
    return _SLOT_AGGS[top]


def _build_slot_aggs(top: int) -> list[Column]:
    def slot(dim, k, c):
        return F.max(F.when((F.col("dim") == dim) & (F.col("rn") == k), F.col(c)))

    aggs = []
    for k in range(1, top + 1):
        aggs += [slot("usecase_type", k, "category").alias(f"top{k}_usecase_type"),
                 slot("usecase_type", k, "n").alias(f"top{k}_usecase_type_count"),
                 slot("usecase_type", k, "value").alias(f"top{k}_usecase_type_monthly_value")]
    for k in range(1, top + 1):
        aggs += [slot("slippage", k, "category").alias(f"top{k}_slippage_category"),
                 slot("slippage", k, "n").alias(f"top{k}_slip_usecase_count"),
                 slot("slippage", k, "description").alias(f"top{k}_slippage_category_description")]
    for k in range(1, top + 1):
        aggs += [slot("accel", k, "category").alias(f"top{k}_accel_category"),
                 slot("accel", k, "n").alias(f"top{k}_accel_usecase_count"),
                 slot("accel", k, "description").alias(f"top{k}_accel_category_description")]
    for k in range(1, top + 1):
        aggs += [slot("vertical", k, "category").alias(f"top{k}_vertical"),
                 slot("vertical", k, "n").alias(f"top{k}_vertical_usecase_count")]
    return aggs


KPI_COLUMNS = (
    "total_use_cases", "total_estimated_monthly_value",
    "high_confidence_count", "high_confidence_pct", "medium_confidence_count", "medium_confidence_pct",
    "low_confidence_count", "low_confidence_pct",
    "slip_usecase_count", "slip_total_monthly_value", "accel_usecase_count", "accel_total_monthly_value",
    "stale_usecase_count", "stale_total_monthly_value", "u3_stale_usecase_count", "u3_stale_total_monthly_value",
    "u5_stale_usecase_count", "u5_stale_total_monthly_value", "one_blocker_usecase_count",
    "one_blocker_total_monthly_value", "cloud_medhigh_usecase_count", "cloud_medhigh_total_monthly_value",
    "threeplus_blocker_usecase_count", "threeplus_blocker_total_monthly_value",
)


def slot_columns(top: int = 3) -> list[tuple[str, str]]:
    """(name, kind) of the slot columns in output order; kind in text/count/money."""
    out = []
    for k in range(1, top + 1):
        out += [(f"top{k}_usecase_type", "text"), (f"top{k}_usecase_type_count", "count"),
                (f"top{k}_usecase_type_monthly_value", "money")]
    for k in range(1, top + 1):
        out += [(f"top{k}_slippage_category", "text"), (f"top{k}_slip_usecase_count", "count"),
                (f"top{k}_slippage_category_description", "text")]
    for k in range(1, top + 1):
        out += [(f"top{k}_accel_category", "text"), (f"top{k}_accel_usecase_count", "count"),
                (f"top{k}_accel_category_description", "text")]
    for k in range(1, top + 1):
        out += [(f"top{k}_vertical", "text"), (f"top{k}_vertical_usecase_count", "count")]
    return out


def manager_kpis(agg: DataFrame, entity: str) -> DataFrame:
    is_all = F.col("dim") == ALL
    kpi_cols = [c for c in agg.columns if c not in (entity, "dim", "category")]
    a = (agg.where(is_all | F.col("dim").startswith("rep:"))
         .groupBy(entity).agg(*[F.max(F.when(is_all, F.col(c))).alias(c) for c in kpi_cols], *_representatives()))
    total = F.col("n")
    cols = [F.col(entity), F.col("snapshot_date"), F.col("sales_region"),
            *[F.col(f"sales_subregion_level_{i}") for i in range(1, 5)],
            total.alias("total_use_cases"), F.col("value").cast("double").alias("total_estimated_monthly_value")]
    for lvl in ("high", "medium", "low"):
        n = F.col(f"{lvl}_confidence_n")
        cols += [n.alias(f"{lvl}_confidence_count"), pct(n, total).alias(f"{lvl}_confidence_pct")]
    for m in ("slip", "accel", "stale", "u3_stale", "u5_stale", "one_blocker", "cloud_medhigh", "threeplus_blocker"):
        cols += [F.col(f"{m}_n").alias(f"{m}_usecase_count"),
                 F.col(f"{m}_value").cast("double").alias(f"{m}_total_monthly_value")]
    return a.select(*cols)


def manager_summary(view: DataFrame, entity: str, spark: SparkSession, settings: Settings = DEFAULT,
                    directory: DataFrame | None = None, contact_columns: bool = True) -> DataFrame:
    """Roll-up per ``entity`` (69 columns with contact columns, 67 without;
    with a directory the address comes from it when present).

    One path from the view: a single aggregate (KPI records + category
    counts), a rank within (entity, dim) on that small result, and one
    ``groupBy(entity)`` that pivots both the KPIs and the top-3 slots -- no
    second read of the view and no join of KPIs to slots."""
    agg = category_aggregate(view, entity, settings)
    by_value = F.col("dim") == "usecase_type"
    is_rep = F.col("dim").startswith("rep:")
    w = Window.partitionBy(entity, "dim").orderBy(
        F.when(is_rep, F.lit(0).cast(MONEY))
         .when(by_value, F.col("value")).otherwise(F.col("n").cast(MONEY)).desc(),
        F.col("category").asc_nulls_last())  # representatives: rank 1 is the minimum
    ranked = (agg.withColumn("rn", F.row_number().over(w))
              .where((F.col("dim") == ALL) | (F.col("rn") <= 3)))
    slip = slippage_lookup(spark).select(F.col("type").alias("_st"), F.col("description").alias("_sd"))
    acc = acceleration_lookup(spark).select(F.col("type").alias("_at"), F.col("description").alias("_ad"))
    r = (ranked
         .join(F.broadcast(slip), (F.col("dim") == "slippage") & (F.col("category") == F.col("_st")), "left")
         .join(F.broadcast(acc), (F.col("dim") == "accel") & (F.col("category") == F.col("_at")), "left")
         .withColumn("description", F.coalesce(F.col("_sd"), F.col("_ad"))))
    is_all = F.col("dim") == ALL

    def kpi(c):
        return F.max(F.when(is_all, F.col(c))).alias(c)

    kpi_cols = ["snapshot_date", "n", "value",
                *[f"{m}_n" for m in _kpi_measures(settings)],
                *[f"{m}_value" for m, (_, wv) in _kpi_measures(settings).items() if wv]]
    j = r.groupBy(entity).agg(*[kpi(c) for c in kpi_cols], *_representatives(), *_slot_aggs())
    total = F.col("n")
    out = [F.col("snapshot_date"), F.col(entity), F.col("sales_region"),
           *[F.col(f"sales_subregion_level_{i}") for i in range(1, 5)],
           total.alias("total_use_cases"), F.col("value").cast("double").alias("total_estimated_monthly_value")]
    for lvl in ("high", "medium", "low"):
        n = F.col(f"{lvl}_confidence_n")
        out += [n.alias(f"{lvl}_confidence_count"), pct(n, total).alias(f"{lvl}_confidence_pct")]
    for m in ("slip", "accel", "stale", "u3_stale", "u5_stale", "one_blocker", "cloud_medhigh", "threeplus_blocker"):
        out += [F.col(f"{m}_n").alias(f"{m}_usecase_count"),
                F.col(f"{m}_value").cast("double").alias(f"{m}_total_monthly_value")]
    # A NULL manager forms its own group but, as with key equality, gets no
    # slot values (blank slots).
    blank = F.col(entity).isNull()
    for name, kind in slot_columns():
        c = F.col(name)
        if kind == "text":
            out.append(F.when(blank, F.lit("")).otherwise(F.coalesce(c, F.lit(""))).alias(name))
        elif kind == "count":
            out.append(F.when(blank, F.lit(0)).otherwise(F.coalesce(c, F.lit(0))).cast("long").alias(name))
        else:
            out.append(F.when(blank, F.lit(0.0)).otherwise(F.coalesce(c.cast("double"), F.lit(0.0))).alias(name))
    res = j.select(*out)
    m = F.col(entity)
    gen = generated_contact(m, settings)
    if not contact_columns:  # the older variant: name parts and the generated address, no directory and no status
        return res.withColumns({"name": name_first(m), "surname": name_last(m), "email": gen})
    res = res.withColumns({"name": name_first(m), "surname": name_last(m), "generated_email": gen})
    if directory is None:
        return res.withColumns({"email": gen, "email_status": F.lit("correct")})
    d = (directory.select(F.concat(F.trim(F.col("Name")), F.lit(" "), F.trim(F.col("Surname"))).alias("_dk"),
                          F.col("email").alias("_de"))
         .groupBy("_dk").agg(F.min("_de").alias("_de")))  # duplicate names must not multiply rows
    res = res.join(d, res[entity] == d["_dk"], "left")
    status = (F.when(F.col("_de").isNull(), F.lit("correct"))
              .when(F.col("_de") == gen, F.lit("correct")).otherwise(F.lit("mismatch")))
    return res.withColumns({"email": F.coalesce(F.col("_de"), gen), "email_status": status}).drop("_dk", "_de")
