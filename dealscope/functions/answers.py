"""Structured-answer parsing and decision rules (pure Catalyst)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope.settings import (DEFAULT, DIMENSIONS, NOT_COMPUTED, OVERRIDE_RATIONALE,
                                Settings)

SCORE_COLUMNS = tuple(d.lower() + "_score" for d in DIMENSIONS)


def _int(x: Column) -> Column:
    # A no-match gives '' and must become NULL, not a cast error (ANSI mode).
    return x.try_cast("int")


def score_of(answer: Column) -> Column:
    return _int(F.regexp_extract(answer, r"CONFIDENCE_SCORE:\s*(\d+)", 1))


def level_of(answer: Column) -> Column:
    return F.regexp_extract(answer, r"LEVEL:\s*(High|Medium|Low)", 1)


def rationale_of(answer: Column, multiline: bool = False) -> Column:
    flag = "(?s)" if multiline else ""
    return F.regexp_extract(answer, flag + r"RATIONALE:\s*(.+?)\s*DIMENSION_SCORES:", 1)


def dimension_of(answer: Column, name: str) -> Column:
    return _int(F.regexp_extract(answer, name + r"=(\d+)", 1))


def parse_answer(df: DataFrame, answer_col: str, blockers_col: str = "num_of_blockers",
                 settings: Settings = DEFAULT) -> DataFrame:
    """Parse the 4-line assessment into typed columns, with the blocker
    override (more than ``blocker_override_above`` blockers -> fixed score,
    level Low and a fixed rationale; dimensions untouched)."""
    a = F.col(answer_col)
    over = F.coalesce(F.col(blockers_col), F.lit(0)) > settings.blocker_override_above
    cols = {
        "confidence_score": F.when(over, F.lit(settings.override_score)).otherwise(score_of(a)),
        "confidence_level": F.when(over, F.lit("Low")).otherwise(level_of(a)),
        "rationale_for_confidence_score": F.when(over, F.lit(OVERRIDE_RATIONALE))
                                           .otherwise(rationale_of(a, settings.multiline_rationale)),
    }
    for d, c in zip(DIMENSIONS, SCORE_COLUMNS):
        cols[c] = dimension_of(a, d)
    return df.withColumns(cols)


def normalized_level(score: Column, settings: Settings = DEFAULT) -> Column:
    return (F.when(score >= settings.high_threshold, F.lit("High"))
            .when(score >= settings.medium_threshold, F.lit("Medium"))
            .when(score.isNotNull(), F.lit("Low"))
            .otherwise(F.lit(NOT_COMPUTED)))


def weighted_score(dims: dict[str, Column], settings: Settings = DEFAULT) -> Column:
    """Weighted assessment score: sum(dim * weight) * 10, clamped to 0..100
    and rounded half-up to the nearest 10.  Exact integer arithmetic: with
    weights in percent, ``raw = sum(dim * pct)`` is the score in tenths."""
    raw = None
    for d in DIMENSIONS:
        term = F.coalesce(dims[d], F.lit(0)) * F.lit(settings.weights_pct[d])
        raw = term if raw is None else raw + term
    clamped = F.greatest(F.lit(0), F.least(F.lit(1000), raw))
    return (F.floor((clamped + F.lit(50)) / F.lit(100)) * F.lit(10)).cast("int")


def slip_flag(level: Column) -> Column:
    return F.coalesce(level == "Medium", F.lit(False))


def accel_flag(level: Column) -> Column:
    return F.coalesce(level.isin("Medium", "High"), F.lit(False))
