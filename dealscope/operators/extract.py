"""Selection of the rows to process: filters, defaults, watermark, profile.

All filters are plain predicates on source columns so Catalyst pushes them
into the parquet scan (or right above it for derived columns) and prunes
every column the extract does not project.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope.settings import (ARCHITECT_DEFAULT, DEFAULT, FIELD_MANAGER_DEFAULT,
                                REGION_DEFAULT, SALES_MANAGER_DEFAULT, VERTICAL_DEFAULT,
                                Settings)

VALUE = "estimated_monthly_value"

# Columns the incremental extract carries into the enrichment stages.
EXTRACT_COLUMNS = (
    "usecase_id", "last_modified_date", "account_name", "sdr_bdr_notes", "business_impact",
    "business_outcome_description", "ae_authority", "ae_money_budget", "usecase_name",
    "usecase_description", "demand_plan_stage_next_steps", "implementation_notes",
    "num_of_blockers", "last_modified_blocker_category", "last_modified_blocker_comment",
    "competition_string", "industry_imperative",
)


def _d(x) -> Column:
    return F.lit(x) if isinstance(x, _dt.date) else x


# -- single predicates (F1-F5, F14-F17) -------------------------------------

def changed_since(watermark, inclusive: bool = False) -> Column:
    c = F.col("last_modified_date")
    return c >= _d(watermark) if inclusive else c > _d(watermark)


def value_at_least(settings: Settings = DEFAULT) -> Column:
    return F.col(VALUE) >= F.lit(settings.min_value)


def stage_allowed(settings: Settings = DEFAULT) -> Column:
    # NOT IN drops NULL stages (three-valued logic), as in SQL.
    return ~F.col("stage").isin(*settings.excluded_stages)


def live_in_window(settings: Settings = DEFAULT) -> Column:
    as_of = F.lit(settings.as_of)
    return F.col("target_live_date").between(as_of, F.add_months(as_of, settings.months_ahead))


def recently_modified(settings: Settings = DEFAULT) -> Column:
    return F.col("last_modified_date") >= F.add_months(F.lit(settings.as_of), settings.months_back)


def lookahead(settings: Settings = DEFAULT) -> Column:
    """Value, stage and live-date window: the filters of the reporting view."""
    return value_at_least(settings) & stage_allowed(settings) & live_in_window(settings)


def stale(settings: Settings = DEFAULT) -> Column:
    cond = F.col("last_modified_date") < F.date_sub(F.lit(settings.as_of), settings.stale_days)
    return F.coalesce(cond, F.lit(False))


def cloud_matches(keyword: str, col: str = "target_cloud") -> Column:
    return F.lower(F.col(col)).contains(keyword.lower())


# -- defaults (F9-F12) ------------------------------------------------------

def region_fallback() -> Column:
    return F.coalesce(F.col("sales_region"), F.col("business_unit"), F.lit(REGION_DEFAULT))


def owner_defaults(df: DataFrame, sales_manager: bool = False) -> DataFrame:
    cols = {
        "field_manager": F.coalesce(F.col("field_manager"), F.lit(FIELD_MANAGER_DEFAULT)),
        "account_solution_architect": F.coalesce(F.col("account_solution_architect"), F.lit(ARCHITECT_DEFAULT)),
    }
    if sales_manager:
        cols["sales_manager"] = F.coalesce(F.col("sales_manager"), F.lit(SALES_MANAGER_DEFAULT))
    return df.withColumns(cols)


def vertical_default() -> Column:
    return F.coalesce(F.col("vertical"), F.lit(VERTICAL_DEFAULT))


def blockers_default() -> Column:
    return F.coalesce(F.col("num_of_blockers"), F.lit(0).cast("long"))


# -- extracts (F6, F7) ------------------------------------------------------

def extract(source: DataFrame, watermark, settings: Settings = DEFAULT,
            columns=EXTRACT_COLUMNS) -> DataFrame:
    """Incremental extract: rows changed after ``watermark`` (``None``: no
    watermark) that pass the value, stage, window and recency filters,
    projected to ``columns``.

    No ORDER BY: ordering inside a pipeline is a wasted global sort; callers
    sort terminal outputs only.
    """
    cond = (value_at_least(settings) & stage_allowed(settings) & live_in_window(settings)
            & recently_modified(settings))
    if watermark is not None:
        cond = changed_since(watermark, settings.inclusive_watermark) & cond
    out = source.where(cond)
    proj = [blockers_default().alias("num_of_blockers") if c == "num_of_blockers" else F.col(c)
            for c in columns]
    return out.select(*proj)


def full_refresh_extract(source: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """All columns of the rows in scope (no watermark), with owner, region and
    blocker defaults and the staleness flag."""
    cond = (value_at_least(settings) & stage_allowed(settings) & live_in_window(settings)
            & recently_modified(settings))
    out = source.where(cond)
    out = owner_defaults(out, sales_manager=True)
    return out.withColumns({
        "sales_region": region_fallback(),
        "num_of_blockers": blockers_default(),
        "is_stale": F.coalesce(F.col("last_modified_date").isNotNull()
                               & (F.col("last_modified_date") < F.date_sub(F.lit(settings.as_of),
                                                                            settings.stale_days)),
                               F.lit(False)),
    })


# -- scalars from the target (A1, A2) ---------------------------------------

def watermark_frame(target: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """One row: max processing date, else the default watermark."""
    return target.agg(F.coalesce(F.max("processed_date"), F.lit(settings.watermark_default))
                      .alias("watermark"))


def watermark(target: DataFrame, settings: Settings = DEFAULT) -> _dt.date:
    """The only value the run brings to the driver: one date."""
    return watermark_frame(target, settings).first()["watermark"]


def extract_profile(extract_df: DataFrame) -> DataFrame:
    return extract_df.agg(F.count(F.lit(1)).alias("new_usecases_count"),
                          F.min("last_modified_date").alias("oldest_modified"),
                          F.max("last_modified_date").alias("newest_modified"))
