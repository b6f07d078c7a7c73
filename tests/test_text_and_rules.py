"""Scalar helpers and decision rules on edge tables (NULL, blank, tabs,
boundaries, multi-line answers)."""

import datetime as dt

from pyspark.sql import functions as F

from dealscope.functions import answers as ans
from dealscope.functions import text as tx
from dealscope.settings import DIMENSIONS, Settings


def _one(spark, col, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_has_text_edges(spark):
    rows = [(None,), ("",), ("   ",), ("\t",), ("<b></b>",), ("a",)]
    out = [r["r"] for r in spark.createDataFrame(rows, "x string").select(tx.has_text("x").alias("r")).collect()]
    # TRIM strips spaces only: a tab-only text counts as text; tag-only passes the guard.
    assert out == [False, False, False, True, True, True]


def test_strip_html_and_cut(spark):
    assert _one(spark, tx.strip_html("x"), "  <p>Hello</p> <b>world</b>  ") == "Hello world"
    assert _one(spark, tx.strip_html("x", 3), "<i>abcdef</i>") == "abc"
    assert _one(spark, tx.strip_html("x"), "<br/>") == ""


def test_first_words_and_count(spark):
    assert _one(spark, tx.first_words("x", 3), "  one\ttwo \n three  four ") == "one two three"
    assert _one(spark, tx.word_count("x"), "  one\ttwo \n three  four ") == 4
    assert _one(spark, tx.word_count("x"), "   ") == 0
    assert _one(spark, tx.word_count("x"), None) == 0


def test_template_fill_rescans_inserted_text(spark):
    df = spark.createDataFrame([("{b}!", "B")], "a string, b string")
    r = df.select(tx.template_fill("[{a}|{b}]", {"a": F.col("a"), "b": F.col("b")}).alias("r")).first()["r"]
    assert r == "[B!|B]"  # the slot inserted for {a} is filled again by {b}


def test_name_parts_and_contact(spark):
    df = spark.createDataFrame([("FLM not assigned",), ("Solo",), ("A  B",), (None,)], "m string")
    got = df.select(tx.name_first("m").alias("n"), tx.name_last("m").alias("s"),
                    tx.generated_contact("m").alias("e")).collect()
    assert (got[0]["n"], got[0]["s"], got[0]["e"]) == ("FLM", "assigned", "flm.assigned@example.com")
    assert (got[1]["n"], got[1]["s"]) == ("Solo", "Solo")
    assert got[2]["s"] == "B" and got[2]["n"] == "A"
    assert got[3]["e"] is None


ANSWER = ("CONFIDENCE_SCORE: 80\nLEVEL: High\nRATIONALE: Strong sponsor.\nDIMENSION_SCORES: Pain=9, Champion=8, "
          "ImplementationPlan=7, DecisionProcess=6, Urgency=5, CompetitionAwareness=4, MajorBlockers=3, "
          "MeasurableImpact=2")


def _parse(spark, rows):
    df = spark.createDataFrame(rows, "a string, n long")
    return ans.parse_answer(df, "a", "n").withColumn(
        "lvl", ans.normalized_level(F.col("confidence_score"))).collect()


def test_parse_answer_and_override(spark):
    r = _parse(spark, [(ANSWER, 0), (ANSWER, 4), (ANSWER, 3), (ANSWER, None)])
    assert (r[0]["confidence_score"], r[0]["confidence_level"], r[0]["rationale_for_confidence_score"]) == \
        (80, "High", "Strong sponsor.")
    assert r[0]["pain_score"] == 9 and r[0]["measurableimpact_score"] == 2
    # more than 3 blockers: score 10, Low, fixed rationale; dimensions untouched
    assert (r[1]["confidence_score"], r[1]["confidence_level"], r[1]["lvl"]) == (10, "Low", "Low")
    assert r[1]["rationale_for_confidence_score"] == "The use case has too many blockers"
    assert r[1]["pain_score"] == 9
    assert r[2]["confidence_score"] == 80 and r[3]["confidence_score"] == 80


def test_parse_no_digits_is_null_not_error(spark):
    r = _parse(spark, [("no answer", 0), ("CONFIDENCE_SCORE: x\nLEVEL: high", 0), (None, 0)])
    assert r[0]["confidence_score"] is None and r[0]["lvl"] == "Not computed"
    assert r[1]["confidence_level"] == ""  # lower-case level does not match
    assert r[2]["confidence_score"] is None


def test_multiline_rationale(spark):
    a = "CONFIDENCE_SCORE: 50\nLEVEL: Medium\nRATIONALE: line one\nline two\nDIMENSION_SCORES: Pain=1"
    df = spark.createDataFrame([(a, 0)], "a string, n long")
    assert ans.parse_answer(df, "a", "n").first()["rationale_for_confidence_score"] == ""
    multi = ans.parse_answer(df, "a", "n", settings=Settings(multiline_rationale=True)).first()
    assert multi["rationale_for_confidence_score"] == "line one\nline two"


def test_level_boundaries(spark):
    df = spark.createDataFrame([(44,), (45,), (74,), (75,), (None,)], "s int")
    got = [r["l"] for r in df.select(ans.normalized_level(F.col("s")).alias("l")).collect()]
    assert got == ["Low", "Medium", "Medium", "High", "Not computed"]


def test_weighted_score(spark):
    def score(vals):
        df = spark.createDataFrame([tuple(vals)], ", ".join(f"{d} int" for d in DIMENSIONS))
        return df.select(ans.weighted_score({d: F.col(d) for d in DIMENSIONS}).alias("w")).first()["w"]
    perfect = [10, 10, 10, 10, 10, 10, 0, 10]  # MajorBlockers = 0
    assert score(perfect) == 90  # positive weights sum to 0.92 -> 92 -> nearest 10
    assert score([0, 0, 0, 0, 0, 0, 10, 0]) == 0  # clamped at 0
    assert score([5, 5, 5, 5, 5, 5, 5, 5]) == 40  # 42 -> 40
    assert score([None] * 8) == 0


def test_flags_null_safe(spark):
    df = spark.createDataFrame([("Medium",), ("High",), ("Low",), (None,)], "l string")
    got = df.select(ans.slip_flag(F.col("l")).alias("s"), ans.accel_flag(F.col("l")).alias("a")).collect()
    assert [(r["s"], r["a"]) for r in got] == [(True, True), (False, True), (False, False), (False, False)]


def test_add_months_clamps_month_end(spark):
    from dealscope.operators import extract as ex
    s = Settings(as_of=dt.date(2026, 8, 31))
    df = spark.createDataFrame([(dt.date(2027, 2, 28),), (dt.date(2027, 3, 1),), (dt.date(2026, 8, 31),)],
                               "target_live_date date")
    got = [r[0] for r in df.select(ex.live_in_window(s)).collect()]
    assert got == [True, False, True]  # both window ends inclusive
