"""CTE builders shared by the oracle queries (DuckDB dialect).

Dialect notes: ``||`` (not ``concat``) so NULL propagates as in Spark's
``concat``; ``regexp_replace`` needs the ``'g'`` flag; date arithmetic is
cast back to DATE.
"""

from __future__ import annotations

from dealscope.settings import DEFAULT, DIMENSIONS, Settings
from oracle.fixed import ANSWER_DIMENSION_FACTORS, EXTRACT_COLUMNS


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def d(x) -> str:
    return f"DATE '{x.isoformat()}'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def with_(*ctes: tuple[str, str], body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS (\n{s}\n)" for n, s in ctes) + "\n" + body


def usecases_sql(s: Settings = DEFAULT) -> str:
    a = d(s.as_of)
    k = "o.o_orderkey"
    dims = " || ', ' || ".join(
        f"'{name}=' || CAST(({k} * {f}) % 11 AS VARCHAR)"
        for name, f in zip(DIMENSIONS, ANSWER_DIMENSION_FACTORS))
    answer = (f"'CONFIDENCE_SCORE: ' || CAST(({k} % 11) * 10 AS VARCHAR) || chr(10) || 'LEVEL: ' || "
              f"CASE {k} % 3 WHEN 0 THEN 'High' WHEN 1 THEN 'Medium' ELSE 'Low' END || chr(10) || "
              f"'RATIONALE: evidence' || CASE WHEN {k} % 13 = 0 THEN chr(10) ELSE ' ' END || "
              f"CAST({k} AS VARCHAR) || '.' || chr(10) || 'DIMENSION_SCORES: ' || {dims}")
    live = f"CAST({a} + CAST({k} % 300 - 60 AS INTEGER) AS DATE)"
    return f"""SELECT
  CAST({k} AS VARCHAR) AS usecase_id,
  c.c_name AS account_name,
  {a} AS snapshot_date,
  CAST(o.o_orderdate AS DATE) AS last_modified_date,
  {live} AS target_live_date,
  CAST({live} - 30 AS DATE) AS target_onboarding_date,
  CASE WHEN {k} % 29 = 0 THEN NULL ELSE CASE {k} % 9 WHEN 0 THEN 'U1' WHEN 1 THEN 'U2' WHEN 2 THEN 'U3'
    WHEN 3 THEN 'U4' WHEN 4 THEN 'U5' WHEN 5 THEN 'U6' WHEN 6 THEN 'U3' WHEN 7 THEN 'U5' ELSE 'Lost' END END AS stage,
  o.o_totalprice / 100 AS estimated_monthly_value,
  CAST(li.n_returned AS BIGINT) AS num_of_blockers,
  CASE WHEN n.n_nationkey % 8 = 7 THEN NULL ELSE 'Fm' || r.r_name || ' ' || n.n_name END AS field_manager,
  'Fl ' || r.r_name AS field_leader,
  CASE WHEN c.c_mktsegment = 'FURNITURE' THEN NULL ELSE 'Sm' || c.c_mktsegment || ' Q ' || r.r_name END AS sales_manager,
  'Sl ' || r.r_name AS sales_leader,
  'Ae ' || c.c_name AS account_executive,
  CASE WHEN {k} % 5 = 0 THEN NULL ELSE 'Sa ' || n.n_name END AS account_solution_architect,
  CASE WHEN {k} % 3 = 0 THEN NULL ELSE r.r_name END AS sales_region,
  CASE WHEN {k} % 6 = 0 THEN NULL ELSE n.n_name END AS business_unit,
  r.r_name AS sales_subregion_level_1,
  n.n_name AS sales_subregion_level_2,
  c.c_mktsegment AS sales_subregion_level_3,
  CASE WHEN {k} % 2 = 0 THEN NULL ELSE o.o_orderpriority END AS sales_subregion_level_4,
  CASE {k} % 4 WHEN 0 THEN 'Azure' WHEN 1 THEN 'AWS' WHEN 2 THEN 'AWS, AZURE' ELSE NULL END AS target_cloud,
  CASE WHEN {k} % 11 = 0 THEN NULL ELSE c.c_mktsegment END AS vertical,
  CASE WHEN {k} % 23 = 0 THEN NULL WHEN {k} % 31 = 0 THEN '   ' ELSE p.p_name END AS usecase_name,
  CASE WHEN {k} % 10 = 0 THEN NULL ELSE dc.text END AS usecase_description,
  CASE WHEN {k} % 7 = 0 THEN NULL ELSE pg.html END AS sdr_bdr_notes,
  CASE WHEN {k} % 8 = 0 THEN ' ' ELSE b.text END AS business_impact,
  CASE WHEN {k} % 6 = 0 THEN NULL ELSE 'Outcome priority ' || o.o_orderpriority END AS business_outcome_description,
  CASE {k} % 5 WHEN 0 THEN 'Executive sponsor' WHEN 1 THEN 'Technical decision maker'
    WHEN 2 THEN 'Economic decision maker' WHEN 3 THEN '  ' ELSE NULL END AS ae_authority,
  CASE {k} % 4 WHEN 0 THEN 'Approved' WHEN 1 THEN 'Pending approval' WHEN 3 THEN 'Not available' ELSE NULL END AS ae_money_budget,
  CASE WHEN {k} % 4 = 0 THEN NULL ELSE cv.conv_text END AS demand_plan_stage_next_steps,
  CASE WHEN {k} % 5 = 0 THEN NULL ELSE 'Owner ' || c.c_name || ' plans ' || p.p_name || ' rollout' END AS implementation_notes,
  CASE WHEN {k} % 3 = 0 THEN NULL ELSE p.p_type END AS last_modified_blocker_category,
  CASE WHEN {k} % 3 = 0 THEN ' ' ELSE cv.conv_text END AS last_modified_blocker_comment,
  CASE WHEN li.n_returned IS NULL THEN NULL ELSE CAST(CAST(o.o_orderdate AS DATE) - CAST({k} % 20 AS INTEGER) AS DATE) END AS blockers_last_modified_date,
  CASE WHEN {k} % 2 = 0 THEN NULL ELSE p.p_brand END AS competition_string,
  CASE WHEN {k} % 9 = 0 THEN NULL ELSE c.c_mktsegment || ' modernization' END AS industry_imperative,
  CASE {k} % 3 WHEN 0 THEN 'Vendor A' WHEN 1 THEN 'Vendor B' ELSE NULL END AS primary_competitor,
  CASE {k} % 3 WHEN 0 THEN 'SQL' WHEN 1 THEN 'ML' ELSE 'ETL' END AS use_case_product,
  CASE {k} % 3 WHEN 0 THEN 'High' WHEN 1 THEN 'Medium' ELSE 'Low' END AS timeline_urgency,
  CASE WHEN {k} % 19 = 0 THEN NULL WHEN {k} % 17 = 0 THEN 'no answer' ELSE {answer} END AS answer_text
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN (SELECT l_orderkey, count_if(l_returnflag = 'R') AS n_returned FROM lineitem GROUP BY l_orderkey) li
  ON li.l_orderkey = {k}
LEFT JOIN part p ON p.p_partkey = {k} % (SELECT count(*) FROM part)
LEFT JOIN documents dc ON dc.doc_id = {k} % (SELECT count(*) FROM documents)
LEFT JOIN pages pg ON pg.page_id = {k} % (SELECT count(*) FROM pages)
LEFT JOIN benchmark b ON b.item_id = {k} % (SELECT count(*) FROM benchmark)
LEFT JOIN (SELECT conv_id, min(text) AS conv_text FROM conversations GROUP BY conv_id) cv
  ON cv.conv_id = {k} % (SELECT count(DISTINCT conv_id) FROM conversations)"""


# -- predicates --------------------------------------------------------------

def lookahead_sql(s: Settings = DEFAULT, alias: str = "") -> str:
    p = alias + "." if alias else ""
    a = d(s.as_of)
    return (f"{p}estimated_monthly_value >= {s.min_value} AND {p}stage NOT IN {in_list(s.excluded_stages)} "
            f"AND {p}target_live_date BETWEEN {a} AND CAST({a} + INTERVAL {s.months_ahead} MONTH AS DATE)")


def recency_sql(s: Settings = DEFAULT, alias: str = "") -> str:
    p = alias + "." if alias else ""
    return f"{p}last_modified_date >= CAST({d(s.as_of)} + INTERVAL ({s.months_back}) MONTH AS DATE)"


def stale_sql(s: Settings = DEFAULT, alias: str = "") -> str:
    p = alias + "." if alias else ""
    return f"COALESCE({p}last_modified_date < CAST({d(s.as_of)} - {s.stale_days} AS DATE), false)"


def extract_sql(watermark, s: Settings = DEFAULT) -> str:
    op = ">=" if s.inclusive_watermark else ">"
    cols = ",\n  ".join("COALESCE(num_of_blockers, 0) AS num_of_blockers" if c == "num_of_blockers" else c
                        for c in EXTRACT_COLUMNS)
    wm = "" if watermark is None else f"last_modified_date {op} {d(watermark)} AND "
    return f"""SELECT
  {cols}
FROM usecases
WHERE {wm}{lookahead_sql(s)}
  AND {recency_sql(s)}"""


def has_text_sql(x: str) -> str:
    return f"COALESCE(length(trim({x})) > 0, false)"
