"""Roll-up edge cases: ties, fewer than three categories, NULL manager,
duplicate directory names, exact percentages."""

import datetime as dt

from pyspark.sql import functions as F

from dealscope.operators import rollup as ru

COLS = ("field_manager string, sales_manager string, snapshot_date date, sales_region string, "
        "sales_subregion_level_1 string, sales_subregion_level_2 string, sales_subregion_level_3 string, "
        "sales_subregion_level_4 string, estimated_monthly_value double, confidence_level_normalized string, "
        "likely_to_slip boolean, can_be_accelerated boolean, stage string, last_modified_date date, "
        "num_of_blockers long, target_cloud string, usecase_type string, slippage_category string, "
        "accel_category string, vertical string")


def _row(m, value, level, slip_cat, ut="ETL", vertical="V1", sm="Sm X"):
    d = dt.date(2001, 7, 1)
    slip = level == "Medium"
    return (m, sm, dt.date(2001, 8, 2), "R", "a", "b", "c", None, value, level, slip, level in ("Medium", "High"),
            "U3", d, 1, "Azure", ut, slip_cat if slip else "N/A", "Funding" if slip else "N/A", vertical)


def test_summary_ties_blanks_and_null_group(spark):
    rows = [_row("Ann Lee", 1000.0, "Medium", "Budget"), _row("Ann Lee", 1000.0, "Medium", "Data"),
            _row("Ann Lee", 1000.0, "Low", "x"), _row(None, 10.0, "Medium", "Data")]
    view = spark.createDataFrame(rows, COLS)
    out = {r["field_manager"]: r for r in ru.manager_summary(view, "field_manager", spark).collect()}
    ann = out["Ann Lee"]
    assert ann["total_use_cases"] == 3 and ann["total_estimated_monthly_value"] == 3000.0
    assert ann["medium_confidence_pct"] == 66.67 and ann["low_confidence_pct"] == 33.33
    # tie 1:1 between Budget and Data -> alphabetical
    assert (ann["top1_slippage_category"], ann["top2_slippage_category"]) == ("Budget", "Data")
    assert ann["top1_slippage_category_description"].startswith("Slippage is caused by funding")
    assert ann["top3_slippage_category"] == "" and ann["top3_slip_usecase_count"] == 0
    assert ann["generated_email"] == "ann.lee@example.com" and ann["email_status"] == "correct"
    # NULL manager keeps its KPIs but gets blank slots
    null = out[None]
    assert null["total_use_cases"] == 1 and null["top1_slippage_category"] == "" and null["top1_vertical"] == ""
    assert len(ru.manager_summary(view, "field_manager", spark).columns) == 69


def test_directory_duplicates_do_not_multiply(spark):
    view = spark.createDataFrame([_row("Ann Lee", 1.0, "High", "x")], COLS)
    directory = spark.createDataFrame([("Ann", "Lee", "z@example.com"), (" Ann", "Lee ", "ann.lee@example.com")],
                                      "Name string, Surname string, email string")
    out = ru.manager_summary(view, "field_manager", spark, directory=directory).collect()
    assert len(out) == 1
    assert out[0]["email"] == "ann.lee@example.com" and out[0]["email_status"] == "correct"


def test_pct_half_up_exact(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (1, 32)], "n long, t long")
    got = [r[0] for r in df.select(ru.pct(F.col("n"), F.col("t"))).collect()]
    assert got == [12.5, 33.33, 66.67, 3.13]


def test_reporting_join_is_the_same_with_and_without_broadcast(spark):
    """Spark's choice of the join by size changes the plan, never the rows."""
    from dealscope.operators.extract import lookahead
    from dealscope.plans import reporting as rp
    from dealscope.plans.queries import _state
    from dealscope.settings import DEFAULT
    from dealscope.sources import fixtures as fx

    sf = "/root/testdata/sf0.001"
    target, source = _state(spark, sf), fx.usecases(spark, sf, DEFAULT)
    src = source.where(lookahead(DEFAULT))
    cols = ["usecase_id", "stage", "context", "estimated_monthly_value"]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    rows = []
    for threshold in ("-1", "100MB"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        rows.append(sorted(map(tuple, rp._joined(target, src, DEFAULT).select(cols).collect())))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows[0] == rows[1] and rows[0]


def test_older_summary_variant_has_name_parts_and_address(spark):
    from dealscope.plans.queries import REGISTRY

    df = REGISTRY["sales_manager_summary_basic"](spark, "/root/testdata/sf0.001")
    assert len(df.columns) == 67 and df.columns[-3:] == ["name", "surname", "email"]
