"""The source is derived lazily, by columns, with the same rows whatever the look-up tables hold."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from dealscope.plans import queries as qs
from dealscope.plans import reporting as rp
from dealscope.settings import DEFAULT
from dealscope.sources import fixtures as fx

GROUPS = (("usecase_id", "target_cloud"), ("usecase_id", "num_of_blockers"), ("usecase_id", "usecase_name"),
          ("usecase_id", "sdr_bdr_notes", "field_manager"), ("usecase_id", "last_modified_blocker_comment", "vertical"))


def _tables(spark, folder: str, twice: bool) -> str:
    day = dt.datetime(2001, 7, 1)
    again = [1, 1, None] if twice else []
    made = {
        "region": ([(0, "ASIA"), (1, "AFRICA")], "r_regionkey int, r_name string"),
        "nation": ([(0, "CHINA", 0), (1, "KENYA", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(i, f"C{i}", (i or 0) % 2, "BUILDING") for i in [0, 1, 2, *again]],
                     "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
        "part": ([(i, f"part {i}", "b", "t") for i in [0, 1, 2, *again]],
                 "p_partkey long, p_name string, p_brand string, p_type string"),
        "orders": ([(i, (i or 0) % 3, 9e5, day, "1-URGENT") for i in [*range(40), *again]],
                   "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(i // 2, "R" if i % 3 else "N") for i in range(60)], "l_orderkey long, l_returnflag string"),
        "documents": ([(i, f"document {i}") for i in [0, 1, 2, 3, *again]], "doc_id long, text string"),
        "pages": ([(i, f"<p>page {i}</p>") for i in [0, 1, 2, *again]], "page_id long, html string"),
        "benchmark": ([(i, f"item {i}") for i in [0, 1, *again]], "item_id long, text string"),
        "conversations": ([(i, f"turn {i}") for i in [0, 1, 1, 2]], "conv_id long, text string"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def _rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("twice", [False, True])
def test_columns_leave_the_rows_as_they_are(spark, tmp_dir, twice):
    sf = _tables(spark, tmp_dir + "/sf", twice)
    whole = fx.usecases(spark, sf, DEFAULT)
    assert (whole.count() == 40) != twice
    for columns in GROUPS:
        some = fx.usecases(spark, sf, DEFAULT, columns)
        assert set(some.columns) == set(columns)
        assert _rows(some.select(*columns)) == _rows(whole.select(*columns))
    plan = fx.usecases(spark, sf, DEFAULT, GROUPS[0])._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and ("documents" in plan) == twice


def test_no_texts_are_stored_per_row(spark, tmp_dir):
    sf = _tables(spark, tmp_dir + "/sf", False)
    kept = fx.shared_root(spark).removeprefix("file:") + "/dealscope-tables"
    before = set(os.listdir(kept)) if os.path.isdir(kept) else set()
    assert fx.usecases(spark, sf, DEFAULT).count() == 40
    assert before == (set(os.listdir(kept)) if os.path.isdir(kept) else set())


def test_a_view_of_some_columns_shows_the_same(spark, tmp_dir):
    sf = _tables(spark, tmp_dir + "/sf", True)
    source = fx.usecases(spark, sf, DEFAULT)
    target = spark.createDataFrame([(str(i), i, "BI") for i in [0, 1, 2, 5, 10, 80]] + [(None, 1, "BI")],
                                   "usecase_id string, num_of_blockers long, usecase_type string")
    columns = ("usecase_id", "usecase_type", "num_of_blockers", "sales_region", "is_stale", "account_solution_architect")
    narrow = fx.usecases(spark, sf, DEFAULT, rp.source_columns(columns))
    got = rp.reporting_view(target, narrow, DEFAULT, columns)
    # by the plain join, whose source rows have not met the target's keys before
    want = rp._present(target.join(source.where(rp.ex.lookahead(DEFAULT)).drop("num_of_blockers"), "usecase_id"),
                       DEFAULT, columns)
    assert _rows(got) == _rows(want)


def _nodes(plan, name: str) -> list:
    below = plan.children()
    found = [n for i in range(below.size()) for n in _nodes(below.apply(i), name)]
    return [plan, *found] if plan.nodeName() == name else found


def test_the_chain_shuffles_no_texts(spark, tmp_dir, monkeypatch):
    """F4, F8: a row's texts are looked up where the row already lies for the chain."""
    sf = _tables(spark, tmp_dir + "/sf", True)
    spark.createDataFrame([(i, i % 3, 9e5, dt.datetime(2001, 7, 1), "1-URGENT") for i in [*range(60, 80), 61, 61]],
                          spark.read.parquet(f"{sf}/orders.parquet").schema).write.mode("overwrite").parquet(f"{sf}/orders.parquet")
    for df in (got := qs._enriched(spark, sf), qs.full_refresh_run(spark, sf)):
        spread = _nodes(df._jdf.queryExecution().optimizedPlan(), "RepartitionByExpression")
        assert len(spread) == 1
        shuffled = spread[0].output().mkString(",")
        assert "p_name" in shuffled and not any(t in shuffled for t in ("doc_text", "html", "conv_text", "bench_text", "description"))
    monkeypatch.setattr(qs, "_spread", lambda s, d: fx.usecases(s, d, DEFAULT))
    monkeypatch.setattr(qs, "SPREAD", DEFAULT)
    want = qs._enriched(spark, sf)
    assert got.columns == want.columns and _rows(got) == _rows(want) != []


def test_texts_are_held_where_they_fit_and_rows_stay(spark, tmp_dir, monkeypatch):
    """F8, F5: with small tables of texts no row is shuffled with its texts; with large ones the rows are the same."""
    sf = _tables(spark, tmp_dir + "/sf", True)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    try:
        spark.conf.set(threshold, "-1")
        plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
        held = fx.usecases(spark, sf)
        assert plan(held).count("rightHint=(strategy=broadcast)") == len(fx.TEXTS)
        want = sorted(map(repr, held.collect()))
        monkeypatch.setattr(fx, "HELD_BYTES", 0)
        fx._CACHE.clear()
        large = fx.usecases(spark, sf)
        assert "strategy=broadcast" not in plan(large)
        assert sorted(map(repr, large.collect())) == want
    finally:
        spark.conf.set(threshold, before)
        fx._CACHE.clear()


def test_the_largest_texts_are_not_held(spark, tmp_dir, monkeypatch):
    sf = _tables(spark, tmp_dir + "/sf", True)
    sizes = {n: fx._text_bytes(spark, sf, n) for n in fx.TEXTS}
    monkeypatch.setattr(fx, "HELD_BYTES", sum(sizes.values()) - 1)
    assert fx._held(spark, sf, ["part", *sizes]) == set(sizes) - {max(sizes, key=sizes.get)}


def test_keys_of_a_view_meet_the_orders_before_any_text(spark, tmp_dir):
    """only rows of the target get their texts."""
    sf = _tables(spark, tmp_dir + "/sf", True)
    columns = [c for c in rp.RADAR_COLUMNS if c in rp._FROM_TARGET and c not in ("usecase_id", "num_of_blockers")]
    target = spark.createDataFrame([("1", 1), ("9", 2), (None, 3), ("absent", 4)], "usecase_id string, num_of_blockers int")
    target = target.select("*", *[F.lit("x").alias(c) for c in columns])
    for source in (fx.usecases(spark, sf), fx.usecases(spark, sf, spread=3)):
        view = rp.radar_view(target, source)
        plan = view._jdf.queryExecution().optimizedPlan().toString().split("\n")
        at = [i for i, line in enumerate(plan) if "Join LeftSemi" in line]
        looked_up = [i for i, line in enumerate(plan) if "Join LeftOuter" in line]
        assert any(i > max(looked_up) for i in at)
        shown = source.where("usecase_id in ('1', '9')")
        assert sorted(r.usecase_id for r in view.collect()) == sorted(r.usecase_id for r in shown.collect())
