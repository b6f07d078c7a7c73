"""Derive the ``usecases`` source table from the generated test tables.

The mapping is a plain star join (orders -> customer -> nation -> region)
plus look-ups into the text tables by ``key % count``.  Everything stays
lazy, nothing is stored: filters on order-derived columns (value, stage,
dates) and semi joins on the key are pushed below the text joins by Catalyst,
so only surviving orders ever meet the large ``documents`` / ``pages`` texts.  The ``count`` of each look-up table
is a scalar subquery (``DataFrame.scalar()``), not a driver round trip.
"""

from __future__ import annotations

import datetime as _dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealscope.session import freed_shuffles
from dealscope.settings import DEFAULT, DIMENSIONS, Settings

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Multipliers of the stand-in answer's dimension scores, in DIMENSIONS order.
ANSWER_DIMENSION_FACTORS = (1, 3, 5, 7, 2, 4, 6, 8)
FIXTURE_WATERMARK = _dt.date(2001, 2, 15)


_CACHE: dict = {}


def _cached(spark: SparkSession, key: tuple, build):
    """Reuse a lazily built DataFrame per session: building a plan costs
    driver round trips (schema reads, expression trees) but a DataFrame is
    an immutable plan, so one object serves every query of the session."""
    k = (id(spark),) + key
    hit = _CACHE.get(k)
    if hit is not None and hit.sparkSession is spark:
        return hit
    df = build()
    _CACHE[k] = df
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return _cached(spark, ("table", path, file_identity(spark, path)), lambda: spark.read.parquet(path))


def _by_mod(k: Column, n: int, cases: dict[int, object], default) -> Column:
    expr = None
    for r, v in cases.items():
        cond = (k % n) == r
        val = v if isinstance(v, Column) else F.lit(v)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    d = default if isinstance(default, Column) else F.lit(default)
    return expr.otherwise(d) if expr is not None else d


def _stage(k: Column) -> Column:
    by9 = _by_mod(k, 9, {0: "U1", 1: "U2", 2: "U3", 3: "U4", 4: "U5", 5: "U6", 6: "U3", 7: "U5", 8: "Lost"}, None)
    return F.when(k % 29 == 0, F.lit(None).cast("string")).otherwise(by9)


def answer_text(k: Column) -> Column:
    """Stand-in model answer in the 4-line structured format."""
    level = _by_mod(k, 3, {0: "High", 1: "Medium"}, "Low")
    sep = F.when(k % 13 == 0, F.lit("\n")).otherwise(F.lit(" "))
    dims = []
    for i, (name, f) in enumerate(zip(DIMENSIONS, ANSWER_DIMENSION_FACTORS)):
        dims.append(F.lit(("" if i == 0 else ", ") + name + "="))
        dims.append(((k * f) % 11).cast("string"))
    text = F.concat(
        F.lit("CONFIDENCE_SCORE: "), ((k % 11) * 10).cast("string"),
        F.lit("\nLEVEL: "), level,
        F.lit("\nRATIONALE: evidence"), sep, k.cast("string"), F.lit("."),
        F.lit("\nDIMENSION_SCORES: "), *dims,
    )
    return (F.when(k % 19 == 0, F.lit(None).cast("string"))
            .when(k % 17 == 0, F.lit("no answer"))
            .otherwise(text))


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (set by the
    cluster; only unit tests fall back to a scratch folder)."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    from dealscope.session import ensure_checkpoint_dir
    return ensure_checkpoint_dir(spark).rstrip("/")


def _code_key() -> str:
    """Digest of the modules that derive the materialised fixtures, so a code
    change never reads a stale copy."""
    import hashlib
    import pathlib
    base = pathlib.Path(__file__).resolve().parent.parent
    h = hashlib.sha256()
    for rel in ("settings.py", "sources/fixtures.py", "sources/target.py", "functions/text.py",
                "functions/answers.py", "operators/extract.py", "operators/inference.py",
                "operators/enrich.py", "plans/incremental.py"):
        h.update((base / rel).read_bytes())
    return h.hexdigest()[:16]


def file_identity(spark: SparkSession, path: str) -> tuple:
    """(name, length, modification time) of every file under ``path``: what a
    derived table depends on, so it never outlives its input."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return ()
    files, out = fs.listFiles(root, True), []
    while files.hasNext():
        s = files.next()
        out.append((s.getPath().getName(), s.getLen(), s.getModificationTime()))
    return tuple(sorted(out))


def input_identity(spark: SparkSession, sf_dir: str) -> str:
    """Digest of the identity of every given table."""
    import hashlib
    parts = [(t, file_identity(spark, f"{sf_dir}/{t}.parquet")) for t in TABLES]
    return hashlib.sha256(repr(parts).encode()).hexdigest()[:20]


def materialized(spark: SparkSession, name: str, key: tuple, build, partition_col: str | None = None,
                 partitions: int | None = None) -> DataFrame:
    """Read a derived table from the shared folder, deriving and writing it
    (by Spark, from the given tables) the first time.  ``key`` must hold the
    identity of the input.  A table is written to a folder of its own, then
    renamed once; it counts only with Spark's ``_SUCCESS`` marker, and of two
    concurrent writers the first rename wins."""
    import hashlib
    import uuid

    digest = hashlib.sha256(repr((name, key, _code_key())).encode()).hexdigest()[:20]
    path = f"{shared_root(spark)}/dealscope-tables/{name}-{digest}"

    def get():
        jpath = spark._jvm.org.apache.hadoop.fs.Path
        fs = jpath(path).getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(jpath(path + "/_SUCCESS")):
            df = build()
            n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
            if partition_col is not None:
                df = df.repartition(n, partition_col)
            own = f"{path}-{uuid.uuid4().hex}"
            with freed_shuffles(spark):
                df.write.mode("errorifexists").parquet(own)
            if fs.exists(jpath(path)) or not fs.rename(jpath(own), jpath(path)):
                fs.delete(jpath(own), True)  # another job published it meanwhile
        return spark.read.parquet(path)
    return _cached(spark, ("materialized", path), get)


def drop_derived(spark: SparkSession) -> None:
    """Delete the derived tables, and the tables and answers that registered runs wrote, from the shared folder.
    Call it when no query over them is read any more; the next query derives what it needs again."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    for folder in ("dealscope-tables", "dealscope-runs"):
        path = jpath(f"{shared_root(spark)}/{folder}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _CACHE.clear()


#: Columns that need a look-up table; every other column follows from orders, customer, nation and region.
LOOKUP_COLUMNS = {
    "returns": ("num_of_blockers", "blockers_last_modified_date"),
    "part": ("usecase_name", "implementation_notes", "last_modified_blocker_category", "competition_string"),
    "benchmark": ("business_impact",),
    "conversations": ("demand_plan_stage_next_steps", "last_modified_blocker_comment"),
    "documents": ("usecase_description",),
    "pages": ("sdr_bdr_notes",),
}
LOOKUP_KEYS = {"part": "p_partkey", "benchmark": "item_id", "documents": "doc_id", "pages": "page_id"}
#: Look-up tables of texts with their text column, and the bytes of texts that the executors are sent to hold, all such
#: tables together: a row's texts then meet it where it is.  Larger tables are joined by their key.
TEXTS = {"benchmark": "text", "conversations": "text", "documents": "text", "pages": "html"}
HELD_BYTES = 64 << 20
#: Bytes counted for a row besides its text.
ROW_BYTES = 64


def usecases(spark: SparkSession, sf_dir: str, settings: Settings = DEFAULT, columns: tuple[str, ...] = (),
             spread: int = 0) -> DataFrame:
    """The source fact table, one row per use case (key ``usecase_id``), derived lazily for each state of the test
    tables: a row's texts are far larger than the row, so they are never stored or sorted per row, and a query's
    filters run before the look-ups.  With ``columns`` only these are derived, and look-up tables that they do not
    need are left out where that cannot change the rows.  With ``spread`` the rows that the filters leave are
    partitioned by key, into so many parts, before they meet any text: what follows need not shuffle the texts."""
    return _cached(spark, ("usecases", sf_dir, repr(settings), columns, spread, input_identity(spark, sf_dir)),
                   lambda: _usecases(spark, sf_dir, settings, columns, spread))


def _repeats(spark: SparkSession, sf_dir: str, name: str) -> bool:
    """Whether a key of a look-up table comes twice, so that its join repeats rows."""
    key, path = LOOKUP_KEYS[name], f"{sf_dir}/{name}.parquet"
    return _cached(spark, ("repeats", path, file_identity(spark, path)), lambda: _Answer(
        spark, not table(spark, sf_dir, name).where(F.col(key).isNotNull()).groupBy(key).count()
        .where(F.col("count") > 1).isEmpty())).value


class _Answer(NamedTuple):
    sparkSession: SparkSession
    value: bool | int


def _text_bytes(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Bytes of the rows of a look-up table of texts, as read."""
    path = f"{sf_dir}/{name}.parquet"
    return _cached(spark, ("bytes", path, file_identity(spark, path)), lambda: _Answer(spark, table(spark, sf_dir, name).agg(
        F.coalesce(F.sum(F.coalesce(F.octet_length(TEXTS[name]), F.lit(0)) + ROW_BYTES), F.lit(0))).first()[0])).value


def _held(spark: SparkSession, sf_dir: str, names: list[str]) -> set[str]:
    """Those of the tables of texts that are small enough to be held, the smallest first."""
    held, left = set(), HELD_BYTES
    for size, name in sorted((_text_bytes(spark, sf_dir, n), n) for n in names if n in TEXTS):
        left -= size
        if left >= 0:
            held.add(name)
    return held


def _lookups(spark: SparkSession, sf_dir: str, columns: tuple[str, ...]) -> list[str]:
    """Look-up tables to join, those with the longest texts last.  Returns and conversations are grouped by their key,
    so their joins keep the rows as they are."""
    return [t for t, own in LOOKUP_COLUMNS.items() if not columns or not set(own).isdisjoint(columns)
            or t in LOOKUP_KEYS and _repeats(spark, sf_dir, t)]


def _usecases(spark: SparkSession, sf_dir: str, settings: Settings, columns: tuple[str, ...], spread: int) -> DataFrame:
    as_of = F.lit(settings.as_of)
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # Pre-aggregate lineitem per order before joining (map-side partial agg).
    returns = (table(spark, sf_dir, "lineitem")
               .groupBy("l_orderkey")
               .agg(F.count_if(F.col("l_returnflag") == "R").alias("n_returned")))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("doc_text"))
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    bench = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("bench_text"))
    conv = (table(spark, sf_dir, "conversations")
            .groupBy("conv_id").agg(F.min("text").alias("conv_text")))

    k = F.col("o_orderkey")
    joined = (orders
              .join(customer, orders.o_custkey == customer.c_custkey)
              .join(nation, F.col("c_nationkey") == nation.n_nationkey)
              .join(region, F.col("n_regionkey") == region.r_regionkey))
    sides = {"returns": (returns, "l_orderkey", ("n_returned",)),
             "part": (part, "p_partkey", ("p_name", "p_brand", "p_type")),
             "benchmark": (bench, "item_id", ("bench_text",)), "conversations": (conv, "conv_id", ("conv_text",)),
             "documents": (docs, "doc_id", ("doc_text",)), "pages": (pages, "page_id", ("html",))}
    wanted = _lookups(spark, sf_dir, columns)
    held = _held(spark, sf_dir, wanted)
    usecase_id = k.cast("string")
    for name, (side, key, values) in sides.items():
        if name == "benchmark" and spread > 1:  # the first of the look-ups of texts
            joined, usecase_id = joined.withColumn("_key", usecase_id).repartition(spread, "_key"), F.col("_key")
        if name not in wanted:  # no column asked for reads these
            joined = joined.withColumns({v: F.lit(None).cast(side.schema[v].dataType) for v in values})
            continue
        at = k if name == "returns" else k % side.select(F.count(F.lit(1))).scalar()
        side = F.broadcast(side) if name in held else side
        joined = joined.withColumn("_at", at).join(side, F.col("_at") == side[key], "left").drop("_at")

    null_s = F.lit(None).cast("string")
    lmd = F.col("o_orderdate").cast("date")
    live = F.date_add(as_of, ((k % 300) - 60).cast("int"))
    cols = {
        "usecase_id": usecase_id,
        "account_name": F.col("c_name"),
        "snapshot_date": as_of,
        "last_modified_date": lmd,
        "target_live_date": live,
        "target_onboarding_date": F.date_sub(live, 30),
        "stage": _stage(k),
        "estimated_monthly_value": F.col("o_totalprice") / 100,
        "num_of_blockers": F.col("n_returned").cast("long"),
        "field_manager": F.when(F.col("n_nationkey") % 8 == 7, null_s)
                          .otherwise(F.concat(F.lit("Fm"), F.col("r_name"), F.lit(" "), F.col("n_name"))),
        "field_leader": F.concat(F.lit("Fl "), F.col("r_name")),
        "sales_manager": F.when(F.col("c_mktsegment") == "FURNITURE", null_s)
                          .otherwise(F.concat(F.lit("Sm"), F.col("c_mktsegment"), F.lit(" Q "), F.col("r_name"))),
        "sales_leader": F.concat(F.lit("Sl "), F.col("r_name")),
        "account_executive": F.concat(F.lit("Ae "), F.col("c_name")),
        "account_solution_architect": F.when(k % 5 == 0, null_s).otherwise(F.concat(F.lit("Sa "), F.col("n_name"))),
        "sales_region": F.when(k % 3 == 0, null_s).otherwise(F.col("r_name")),
        "business_unit": F.when(k % 6 == 0, null_s).otherwise(F.col("n_name")),
        "sales_subregion_level_1": F.col("r_name"),
        "sales_subregion_level_2": F.col("n_name"),
        "sales_subregion_level_3": F.col("c_mktsegment"),
        "sales_subregion_level_4": F.when(k % 2 == 0, null_s).otherwise(F.col("o_orderpriority")),
        "target_cloud": _by_mod(k, 4, {0: "Azure", 1: "AWS", 2: "AWS, AZURE"}, None),
        "vertical": F.when(k % 11 == 0, null_s).otherwise(F.col("c_mktsegment")),
        "usecase_name": (F.when(k % 23 == 0, null_s).when(k % 31 == 0, F.lit("   "))
                          .otherwise(F.col("p_name"))),
        "usecase_description": F.when(k % 10 == 0, null_s).otherwise(F.col("doc_text")),
        "sdr_bdr_notes": F.when(k % 7 == 0, null_s).otherwise(F.col("html")),
        "business_impact": F.when(k % 8 == 0, F.lit(" ")).otherwise(F.col("bench_text")),
        "business_outcome_description": F.when(k % 6 == 0, null_s)
                                         .otherwise(F.concat(F.lit("Outcome priority "), F.col("o_orderpriority"))),
        "ae_authority": _by_mod(k, 5, {0: "Executive sponsor", 1: "Technical decision maker",
                                       2: "Economic decision maker", 3: "  "}, None),
        "ae_money_budget": _by_mod(k, 4, {0: "Approved", 1: "Pending approval", 3: "Not available"}, None),
        "demand_plan_stage_next_steps": F.when(k % 4 == 0, null_s).otherwise(F.col("conv_text")),
        "implementation_notes": F.when(k % 5 == 0, null_s)
                                 .otherwise(F.concat(F.lit("Owner "), F.col("c_name"), F.lit(" plans "),
                                                     F.col("p_name"), F.lit(" rollout"))),
        "last_modified_blocker_category": F.when(k % 3 == 0, null_s).otherwise(F.col("p_type")),
        "last_modified_blocker_comment": F.when(k % 3 == 0, F.lit(" ")).otherwise(F.col("conv_text")),
        "blockers_last_modified_date": F.when(F.col("n_returned").isNull(), F.lit(None).cast("date"))
                                        .otherwise(F.date_sub(lmd, (k % 20).cast("int"))),
        "competition_string": F.when(k % 2 == 0, null_s).otherwise(F.col("p_brand")),
        "industry_imperative": F.when(k % 9 == 0, null_s)
                                .otherwise(F.concat(F.col("c_mktsegment"), F.lit(" modernization"))),
        "primary_competitor": _by_mod(k, 3, {0: "Vendor A", 1: "Vendor B"}, None),
        "use_case_product": _by_mod(k, 3, {0: "SQL", 1: "ML"}, "ETL"),
        "timeline_urgency": _by_mod(k, 3, {0: "High", 1: "Medium"}, "Low"),
        "answer_text": answer_text(k),
    }
    return joined.select(*[c.alias(n) for n, c in cols.items() if not columns or n in columns])


def directory(spark: SparkSession, sf_dir: str, settings: Settings = DEFAULT) -> DataFrame:
    return _cached(spark, ("directory", sf_dir, repr(settings), input_identity(spark, sf_dir)), lambda: _directory(spark, sf_dir, settings))


def _directory(spark: SparkSession, sf_dir: str, settings: Settings) -> DataFrame:
    """Contact directory (Name, Surname, email): one row per distinct manager
    name, chosen by region: MIDDLE EAST managers have no entry, AFRICA and
    ASIA managers have an address that differs from the generated one, the
    others match it.  Built from customer, nation and region only (the
    manager names depend on nothing else), so it never scans orders."""
    customer = table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
    field = (geo.where(F.col("n_nationkey") % 8 != 7)
             .select(F.concat(F.lit("Fm"), F.col("r_name"), F.lit(" "), F.col("n_name")).alias("m")))
    sales = (customer.where(F.col("c_mktsegment") != "FURNITURE")
             .join(nation, customer.c_nationkey == nation.n_nationkey)
             .join(region, F.col("n_regionkey") == region.r_regionkey)
             .select(F.concat(F.lit("Sm"), F.col("c_mktsegment"), F.lit(" Q "), F.col("r_name")).alias("m")))
    names = field.unionByName(sales).distinct()
    m = F.col("m")
    first = F.split(m, " ").getItem(0)
    last = F.element_at(F.split(m, " "), -1)
    generated = F.concat(F.lower(first), F.lit("."), F.lower(last), F.lit("@" + settings.email_domain))
    differs = m.contains("AFRICA") | m.contains("ASIA")
    email = F.when(differs, F.concat(F.lit("x."), generated)).otherwise(generated)
    # trim(Name) || ' ' || trim(Surname) rebuilds the manager name.
    rest = F.substr(m, F.length(first) + 2)
    return (names.where(~m.contains("MIDDLE EAST"))
            .select(first.alias("Name"), rest.alias("Surname"), email.alias("email")))
