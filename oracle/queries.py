"""Oracle SQL per registered query (DuckDB dialect)."""

from __future__ import annotations

from dealscope.settings import ACCELERATION_LABELS, SLIPPAGE_LABELS, DEFAULT
from oracle import fixed
from oracle.base import (d, extract_sql, has_text_sql, in_list, lookahead_sql, q,
                         recency_sql, stale_sql, usecases_sql, with_)

S = DEFAULT
SQL: dict[str, str] = {}


def _uc(body: str, *more: tuple[str, str]) -> str:
    return with_(("usecases", usecases_sql(S)), *more, body=body)


SQL["source_scan"] = _uc(
    "SELECT usecase_id, last_modified_date, stage, estimated_monthly_value, target_live_date FROM usecases")
SQL["incremental_rows"] = _uc(
    f"SELECT usecase_id, last_modified_date FROM usecases WHERE last_modified_date > {d(fixed.WATERMARK)}")
SQL["value_threshold"] = _uc(
    f"SELECT usecase_id, estimated_monthly_value FROM usecases WHERE estimated_monthly_value >= {S.min_value}")
SQL["stage_exclusion"] = _uc(
    f"SELECT usecase_id, stage FROM usecases WHERE stage NOT IN {in_list(S.excluded_stages)}")
SQL["lookahead_window"] = _uc(
    f"SELECT usecase_id, target_live_date FROM usecases WHERE target_live_date BETWEEN {d(S.as_of)} "
    f"AND CAST({d(S.as_of)} + INTERVAL {S.months_ahead} MONTH AS DATE)")
SQL["recency_floor"] = _uc(
    f"SELECT usecase_id, last_modified_date FROM usecases WHERE {recency_sql(S)}")
SQL["filtered_usecases"] = _uc("SELECT * FROM ex", ("ex", extract_sql(fixed.WATERMARK, S)))
SQL["filtered_full_refresh"] = _uc(f"""SELECT * EXCLUDE (field_manager, account_solution_architect, sales_region,
    num_of_blockers, sales_manager),
  COALESCE(field_manager, 'FLM not assigned') AS field_manager,
  COALESCE(account_solution_architect, 'SA not assigned') AS account_solution_architect,
  COALESCE(sales_manager, 'Sales Manager not assigned') AS sales_manager,
  COALESCE(sales_region, business_unit, 'No assigned') AS sales_region,
  COALESCE(num_of_blockers, 0) AS num_of_blockers,
  {stale_sql(S)} AS is_stale
FROM usecases WHERE {lookahead_sql(S)} AND {recency_sql(S)}""")
SQL["owner_defaults"] = _uc("""SELECT usecase_id,
  COALESCE(field_manager, 'FLM not assigned') AS field_manager,
  COALESCE(account_solution_architect, 'SA not assigned') AS account_solution_architect,
  COALESCE(sales_manager, 'Sales Manager not assigned') AS sales_manager
FROM usecases""")
SQL["region_fallback"] = _uc(
    "SELECT usecase_id, COALESCE(sales_region, business_unit, 'No assigned') AS sales_region FROM usecases")
SQL["vertical_default"] = _uc(
    "SELECT usecase_id, COALESCE(vertical, 'Not specified') AS vertical FROM usecases")
SQL["blocker_default"] = _uc(
    "SELECT usecase_id, COALESCE(num_of_blockers, 0) AS num_of_blockers FROM usecases")
SQL["text_presence"] = _uc(f"""SELECT usecase_id,
  {has_text_sql('demand_plan_stage_next_steps')} AS has_next_steps,
  {has_text_sql('usecase_name')} OR {has_text_sql('usecase_description')} AS has_name_or_description,
  {' OR '.join(has_text_sql(c) for c in ('sdr_bdr_notes', 'business_impact', 'business_outcome_description',
                                          'ae_authority', 'ae_money_budget'))} AS has_context
FROM usecases""")
SQL["stale_flag"] = _uc(f"SELECT usecase_id, {stale_sql(S)} AS is_stale FROM usecases")
SQL["cloud_match"] = _uc(
    f"SELECT usecase_id, COALESCE(lower(target_cloud) LIKE {q('%' + S.cloud_keyword + '%')}, false) AS cloud_match "
    "FROM usecases")
SQL["non_null_rows"] = _uc(
    "SELECT usecase_id, sales_region, business_unit, vertical FROM usecases "
    "WHERE usecase_id IS NOT NULL AND sales_region IS NOT NULL AND business_unit IS NOT NULL "
    "AND vertical IS NOT NULL")
SQL["extract_profile"] = _uc(
    "SELECT count(*) AS new_usecases_count, min(last_modified_date) AS oldest_modified, "
    "max(last_modified_date) AS newest_modified FROM ex", ("ex", extract_sql(fixed.WATERMARK, S)))


# -- answer parsing and decision rules ------------------------------------------

from dealscope.settings import DIMENSIONS, OVERRIDE_RATIONALE  # noqa: E402
from oracle.enrich import enriched_ctes  # noqa: E402

_A = "answer_text"
_SCORE = f"TRY_CAST(regexp_extract({_A}, 'CONFIDENCE_SCORE:\\s*(\\d+)', 1) AS INTEGER)"
_LEVEL = f"regexp_extract({_A}, 'LEVEL:\\s*(High|Medium|Low)', 1)"
_RAT = f"regexp_extract({_A}, 'RATIONALE:\\s*(.+?)\\s*DIMENSION_SCORES:', 1)"


def _dim(k):
    return f"TRY_CAST(regexp_extract({_A}, '{k}=(\\d+)', 1) AS INTEGER)"


SQL["parse_confidence"] = _uc(
    f"SELECT usecase_id, {_SCORE} AS confidence_score, {_LEVEL} AS confidence_level, "
    f"{_RAT} AS rationale_for_confidence_score FROM usecases")
SQL["parse_dimensions"] = _uc(
    "SELECT usecase_id, " + ", ".join(f"{_dim(k)} AS {c}" for k, c in zip(DIMENSIONS, fixed.SCORE_COLUMNS))
    + " FROM usecases")

_OVER = f"COALESCE(num_of_blockers, 0) > {S.blocker_override_above}"
_PX = ("px", f"""SELECT e.*, u.answer_text FROM ex e JOIN usecases u USING (usecase_id)""")
_PARSED = ("parsed", f"""SELECT *,
  CASE WHEN {_OVER} THEN {S.override_score} ELSE {_SCORE} END AS confidence_score,
  CASE WHEN {_OVER} THEN 'Low' ELSE {_LEVEL} END AS confidence_level,
  CASE WHEN {_OVER} THEN {q(OVERRIDE_RATIONALE)} ELSE {_RAT} END AS rationale_for_confidence_score
FROM px""")
_NORM = (f"CASE WHEN confidence_score >= {S.high_threshold} THEN 'High' WHEN confidence_score >= "
         f"{S.medium_threshold} THEN 'Medium' WHEN confidence_score IS NOT NULL THEN 'Low' ELSE 'Not computed' END")
_EX = ("ex", extract_sql(fixed.WATERMARK, S))

SQL["blocker_override"] = _uc(
    "SELECT usecase_id, num_of_blockers, confidence_score, confidence_level, rationale_for_confidence_score "
    "FROM parsed", _EX, _PX, _PARSED)
SQL["normalize_level"] = _uc(
    f"SELECT usecase_id, confidence_score, {_NORM} AS confidence_level_normalized FROM parsed", _EX, _PX, _PARSED)
SQL["level_histogram"] = _uc(
    f"SELECT {_NORM} AS confidence_level_normalized, count(*) AS n FROM parsed GROUP BY 1", _EX, _PX, _PARSED)
_RAW = " + ".join(f"COALESCE({_dim(k)}, 0) * ({S.weights_pct[k]})" for k in DIMENSIONS)
SQL["weighted_score"] = _uc(
    f"SELECT usecase_id, CAST(floor((greatest(0, least(1000, {_RAW})) + 50) / 100) * 10 AS INTEGER) "
    "AS weighted_score FROM usecases")


def _enr(body: str, *more) -> str:
    return _uc(body, _EX, *enriched_ctes(S), *more)


SQL["enriched_results"] = _enr("SELECT * FROM enr")
for _name, _cols in {
    "infer_context": "context", "infer_one_liner": "one_liner", "infer_next_steps": "next_steps_summary",
    "infer_implementation": "implementation_notes_summary", "infer_blockers": "blockers_summary",
    "classify_usecase_type": "usecase_type", "label_business_usecase": "business_usecase_type",
    "gen_soundbyte": "soundbyte",
    "assess_confidence": "ai_confidence_score_advanced, confidence_score, confidence_level, "
                         "rationale_for_confidence_score",
    "recommend_action": "next_best_action_recommendation",
    "classify_slippage": "likely_to_slip, slippage_category",
    "classify_acceleration": "can_be_accelerated, accel_category",
    "risk_flags": "confidence_level_normalized, likely_to_slip, can_be_accelerated",
}.items():
    SQL[_name] = _enr(f"SELECT usecase_id, {_cols} FROM enr")
SQL["level_disagreement"] = _enr(
    "SELECT usecase_id, confidence_level, confidence_level_normalized, "
    "confidence_level IS DISTINCT FROM confidence_level_normalized AS levels_disagree FROM enr")


# -- lifecycle, views, roll-ups -------------------------------------------------------

from oracle.enrich import strip as _strip  # noqa: E402
from oracle.reporting import (COLS, KPI_NAMES, directory_sql, lookups_ctes, money, radar_ctes,  # noqa: E402
                              rollup_ctes, rollup_select, state_ctes, view_ctes)


def _st(body: str, *more) -> str:
    return with_(*state_ctes(S), *more, body=body)


def _rv(body: str, *more) -> str:
    return with_(*view_ctes(S), *more, body=body)


SQL["watermark_read"] = _st(f"SELECT COALESCE(max(processed_date), {d(S.watermark_default)}) AS watermark FROM v0")
SQL["upsert_newer_wins"] = _st("SELECT * FROM state")
SQL["upsert_actions"] = _st("SELECT _action AS action, count(*) AS n FROM cls GROUP BY 1")
SQL["change_feed"] = _st(f"""SELECT {COLS}, CASE WHEN _action = 'insert' THEN 'insert' ELSE 'update_postimage' END
  AS _change_type FROM cls WHERE _action <> 'unchanged'
UNION ALL
SELECT {COLS}, 'update_preimage' AS _change_type FROM v0
WHERE EXISTS (SELECT 1 FROM cls WHERE cls._action = 'update' AND cls.usecase_id = v0.usecase_id)""")
SQL["incremental_run"] = _st("SELECT * FROM state")
SQL["verification_counts"] = _st("""SELECT * FROM (VALUES
  ('Total Records', (SELECT count(*) FROM state)),
  ('Records with AI Enrichment', (SELECT count(*) FROM state WHERE context IS NOT NULL)),
  ('Records with Confidence Score', (SELECT count(*) FROM state WHERE confidence_score IS NOT NULL)),
  ('High Confidence', (SELECT count(*) FROM state WHERE confidence_level_normalized = 'High')),
  ('Medium Confidence', (SELECT count(*) FROM state WHERE confidence_level_normalized = 'Medium')),
  ('Low Confidence', (SELECT count(*) FROM state WHERE confidence_level_normalized = 'Low'))
) t(metric, count)""")
SQL["rows_per_run"] = _st("SELECT processed_date, count(*) AS n FROM state GROUP BY ALL")
SQL["recent_top10"] = _st(f"""SELECT usecase_id, one_liner, confidence_score, confidence_level_normalized,
  usecase_type, business_usecase_type, likely_to_slip, slippage_category, can_be_accelerated, accel_category,
  last_modified_date, processed_date
FROM state WHERE processed_date = {d(S.as_of)}
ORDER BY confidence_score DESC NULLS LAST, usecase_id ASC LIMIT 10""")

# full refresh: every in-scope row, all source columns with defaults, + enrichment
_FR_SRC = f"""SELECT * EXCLUDE (field_manager, account_solution_architect, sales_region, num_of_blockers,
    sales_manager),
  COALESCE(field_manager, 'FLM not assigned') AS field_manager,
  COALESCE(account_solution_architect, 'SA not assigned') AS account_solution_architect,
  COALESCE(sales_manager, 'Sales Manager not assigned') AS sales_manager,
  COALESCE(sales_region, business_unit, 'No assigned') AS sales_region,
  COALESCE(num_of_blockers, 0) AS num_of_blockers,
  {stale_sql(S)} AS is_stale
FROM usecases WHERE {lookahead_sql(S)} AND {recency_sql(S)}"""
_FR = [("fr", _FR_SRC), *enriched_ctes(S, "fr", "fr_", urgency=True)]
# all source columns, the staleness flag and the enrichment: what begins with _ is a helper of the chain above
SQL["full_refresh_run"] = _uc("SELECT COLUMNS(lambda c: c[1] <> '_') FROM fr_l5", *_FR)
SQL["bootstrap_target"] = _uc(
    f"SELECT * REPLACE (CAST({d(S.as_of)} - 1 AS DATE) AS processed_date) FROM fr_enr", *_FR)

SQL["reporting_view"] = _rv("SELECT * FROM rv")
SQL["radar_view"] = with_(*radar_ctes(S), body="SELECT * FROM radar")

_LK = lookups_ctes()
_DIR = ("directory", directory_sql(S))


def _roll(m: str, body: str, *more) -> str:
    return _rv(body, *_LK, _DIR, *rollup_ctes(m, S), *more)


SQL["field_manager_summary"] = _roll("field_manager", rollup_select("field_manager", S))
SQL["sales_manager_summary"] = _roll("sales_manager", rollup_select("sales_manager", S, directory=True))
SQL["field_manager_summary_with_directory"] = _roll("field_manager",
                                                    rollup_select("field_manager", S, directory=True))
SQL["sales_manager_summary_basic"] = _roll("sales_manager", rollup_select("sales_manager", S, contact=False))


def _fm(*cols):
    return _roll("field_manager", f"SELECT field_manager, {', '.join(cols)} FROM summary")


SQL["manager_totals"] = _fm("total_use_cases", "total_estimated_monthly_value")
SQL["manager_representatives"] = _fm("snapshot_date", "sales_region", *[f"sales_subregion_level_{i}"
                                                                        for i in range(1, 5)])
SQL["manager_confidence_mix"] = _fm("total_use_cases", *[f"{lvl}_confidence_{x}" for lvl in ("high", "medium", "low")
                                                         for x in ("count", "pct")])
SQL["manager_slip_exposure"] = _fm("slip_usecase_count", "slip_total_monthly_value")
SQL["manager_accel_exposure"] = _fm("accel_usecase_count", "accel_total_monthly_value")
SQL["manager_stale"] = _fm(*[f"{n}_{x}" for n in ("stale", "u3_stale", "u5_stale")
                             for x in ("usecase_count", "total_monthly_value")])
SQL["manager_blockers"] = _fm(*[f"{n}_{x}" for n in ("one_blocker", "threeplus_blocker")
                                for x in ("usecase_count", "total_monthly_value")])
SQL["manager_cloud_slice"] = _fm("cloud_medhigh_usecase_count", "cloud_medhigh_total_monthly_value")
SQL["category_counts"] = _rv(f"""SELECT sales_manager, 'usecase_type' AS dim, usecase_type AS category,
  count(*) AS usecase_count, {money('estimated_monthly_value')} AS monthly_value FROM rv GROUP BY 1, 3
UNION ALL SELECT sales_manager, 'slippage', slippage_category, count(*), {money('estimated_monthly_value')}
  FROM rv WHERE likely_to_slip = TRUE GROUP BY 1, 3
UNION ALL SELECT sales_manager, 'accel', accel_category, count(*), {money('estimated_monthly_value')}
  FROM rv WHERE can_be_accelerated = TRUE GROUP BY 1, 3
UNION ALL SELECT sales_manager, 'vertical', vertical, count(*), {money('estimated_monthly_value')}
  FROM rv GROUP BY 1, 3""")
for _q, _t in (("top_usecase_types", "r_type"), ("top_slippage", "r_slip"), ("top_acceleration", "r_accel"),
               ("top_verticals", "r_vert")):
    SQL[_q] = _roll("field_manager", f"SELECT field_manager, category, n AS usecase_count, value AS monthly_value, "
                                     f"rn FROM {_t} WHERE rn <= 3")
SQL["top3_slots"] = _roll("sales_manager", "SELECT sales_manager, " + ", ".join(fixed.SLOT_COLUMNS)
                          + " FROM fms", ("fms", rollup_select("sales_manager", S, contact=False)))
_DESC = [f"top{k}_{c}" for k in (1, 2, 3) for c in ("slippage_category", "slippage_category_description",
                                                    "accel_category", "accel_category_description")]
SQL["category_descriptions"] = _roll("field_manager", "SELECT field_manager, " + ", ".join(_DESC) + " FROM fms",
                                     ("fms", rollup_select("field_manager", S)))
SQL["directory_join"] = _roll("sales_manager", "SELECT sales_manager, email, email_status FROM sms",
                              ("sms", rollup_select("sales_manager", S, directory=True)))
SQL["contact_resolution"] = _roll("sales_manager", "SELECT sales_manager, name, surname, generated_email, email, "
                                                   "email_status FROM sms",
                                  ("sms", rollup_select("sales_manager", S, directory=True)))
SQL["slippage_lookup"] = _st("""SELECT l.type, l.description, COALESCE(c.n, 0) AS usecase_count
FROM slippage_categories l LEFT JOIN (SELECT slippage_category AS type, count(*) AS n FROM state GROUP BY 1) c
  ON l.type = c.type""", *_LK)
SQL["acceleration_lookup"] = _st("""SELECT l.type, l.description, COALESCE(c.n, 0) AS usecase_count
FROM acceleration_categories l LEFT JOIN (SELECT accel_category AS type, count(*) AS n FROM state GROUP BY 1) c
  ON l.type = c.type""", *_LK)

SQL["strip_html_notes"] = f"SELECT page_id, {_strip('html', S.cut_notes_at)} AS notes FROM pages"
_MGR = ("mgr", "SELECT DISTINCT manager FROM (SELECT field_manager AS manager FROM usecases "
               "UNION ALL SELECT sales_manager FROM usecases)")
SQL["name_parts"] = _uc("SELECT manager, string_split(manager, ' ')[1] AS name, string_split(manager, ' ')[-1] "
                        "AS surname FROM mgr", _MGR)
SQL["generated_contact"] = _uc(
    f"SELECT manager, lower(string_split(manager, ' ')[1]) || '.' || lower(string_split(manager, ' ')[-1]) || "
    f"{q('@' + S.email_domain)} AS generated_email FROM mgr", _MGR)


def _template_sql() -> str:
    out = q(fixed.TEMPLATE)
    for slot, col in (("account", "e.account_name"), ("one_liner", "e.one_liner"),
                      ("usecase_type", "e.usecase_type"), ("stage", "u.stage")):
        out = f"replace({out}, {q('{' + slot + '}')}, COALESCE({col}, ''))"
    return out


SQL["template_fill"] = _uc(f"SELECT e.usecase_id, {_template_sql()} AS filled FROM l5 e "
                           "JOIN usecases u ON e.usecase_id = u.usecase_id", _EX, *enriched_ctes(S))


# -- text clustering (tokenise and group naming; KMeans is rows-only) ----------------

SQL["label_tokens"] = _rv("SELECT usecase_id, business_usecase_type, string_split(lower(business_usecase_type), ' ') "
                          "AS words FROM rv WHERE business_usecase_type IS NOT NULL")
_LABELLED = "FROM rv WHERE business_usecase_type IS NOT NULL"
SQL["label_feature_mass"] = _rv("SELECT usecase_id, CAST(len(string_split(lower(business_usecase_type), ' ')) AS BIGINT) "
                                f"AS mass {_LABELLED}")
SQL["cluster_consistency"] = _rv(f"SELECT business_usecase_type, count(*) AS n, true AS one_cluster {_LABELLED} GROUP BY 1")
SQL["silhouette_range"] = _rv("SELECT CAST(k AS INTEGER) AS k, true AS in_range FROM range(2, 16) t(k)")
SQL["cluster_total"] = _rv(f"SELECT count(*) AS n {_LABELLED}")
SQL["group_top_words"] = _rv("""SELECT n.usecase_type, n.category_name, s.usecase_count FROM (
  SELECT usecase_type, string_agg(word, ' ' ORDER BY rank) AS category_name FROM (
    SELECT usecase_type, word, ROW_NUMBER() OVER (PARTITION BY usecase_type ORDER BY count(*) DESC, word ASC) AS rank
    FROM (SELECT usecase_type, unnest(string_split(lower(business_usecase_type), ' ')) AS word
          FROM rv WHERE business_usecase_type IS NOT NULL)
    GROUP BY usecase_type, word)
  WHERE rank <= 5 GROUP BY usecase_type) n
LEFT JOIN (SELECT usecase_type, count(*) AS usecase_count FROM rv WHERE business_usecase_type IS NOT NULL
           GROUP BY 1) s ON n.usecase_type = s.usecase_type""")

_GROUPS = SQL["group_top_words"].rpartition("SELECT n.usecase_type")
SQL["named_rows"] = (f"{_GROUPS[0].rstrip()},\ngroups_ AS (SELECT n.usecase_type{_GROUPS[2]})\n"
                     "SELECT usecase_id, business_usecase_type, true AS size_ok, true AS named, usecase_type, "
                     "category_name, usecase_count FROM rv "
                     "LEFT JOIN groups_ USING (usecase_type) WHERE business_usecase_type IS NOT NULL")
# by the distances of all pairs of items
SQL["silhouette_by_type"] = _rv(f"""SELECT g AS usecase_type, count(*) AS labels, CAST(sum(w) AS BIGINT) AS rows,
  round(sum(s * w) / sum(w), 9) AS silhouette
FROM (SELECT g, w, CASE WHEN a IS NULL OR b IS NULL THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END AS s
      FROM scored) GROUP BY g""",
    ("items", f"""SELECT *, row_number() OVER (ORDER BY g, label) AS i FROM (
  SELECT usecase_type AS g, business_usecase_type AS label, CAST(count(*) AS DOUBLE) AS w {_LABELLED} GROUP BY 1, 2)"""),
    ("cells", """SELECT i, word, CAST(count(*) AS DOUBLE) AS tf FROM (
  SELECT i, unnest(string_split(lower(label), ' ')) AS word FROM items) GROUP BY ALL"""),
    ("norms", "SELECT i, sum(tf * tf) AS norm FROM cells GROUP BY i"),
    ("dots", "SELECT x.i, y.i AS j, sum(x.tf * y.tf) AS dot FROM cells x JOIN cells y USING (word) GROUP BY ALL"),
    ("far", """SELECT x.i, x.g AS own, x.w AS own_w, y.i AS j, y.g, y.w, nx.norm + ny.norm - 2 * COALESCE(dot, 0) AS far
FROM items x CROSS JOIN items y JOIN norms nx ON nx.i = x.i JOIN norms ny ON ny.i = y.i
LEFT JOIN dots ON dots.i = x.i AND dots.j = y.i"""),
    ("means", """SELECT i, own, own_w, g, CASE WHEN g = own THEN sum(CASE WHEN j = i THEN 0 ELSE w * far END) /
  nullif(sum(w) - own_w, 0) ELSE sum(w * far) / sum(w) END AS far FROM far GROUP BY i, own, own_w, g"""),
    ("scored", """SELECT i, own AS g, own_w AS w, max(CASE WHEN g = own THEN far END) AS a,
  min(CASE WHEN g <> own THEN far END) AS b FROM means GROUP BY i, own, own_w"""))


# -- prompt de-duplication (I13) ---------------------------------------------------------

def _prompts() -> dict[str, tuple[str, str]]:
    """stage -> (guard, prompt) of all twelve stages, spelled out, over rows with the inputs and the stages before."""
    from oracle.enrich import ht, strip

    def told(c, blank):
        return f"COALESCE(trim({c}), {q(blank)})"

    def or_none(c, blank="none"):
        return f"COALESCE({c}, {q(blank)})"
    name_or_desc = f"({ht('usecase_name')} OR {ht('usecase_description')})"
    noted = " OR ".join(ht(c) for c in ("sdr_bdr_notes", "business_impact", "business_outcome_description",
                                        "ae_authority", "ae_money_budget"))
    evidence = (f"'Context: ' || {or_none('context')} || chr(10) || 'Use case: ' || {or_none('one_liner')} || chr(10) "
                f"|| 'Next steps: ' || {or_none('next_steps_summary')} || chr(10) || 'Implementation: ' || "
                f"{or_none('implementation_notes_summary')} || chr(10) || 'Blockers: ' || "
                f"{or_none('blockers_summary')} || chr(10) || 'Competition: ' || {or_none('competition_string')}")
    names = ("Pain", "Champion", "ImplementationPlan", "DecisionProcess", "Urgency", "CompetitionAwareness",
             "MajorBlockers", "MeasurableImpact")
    scores = " || ', ' || ".join(f"'{n}=' || COALESCE(CAST({n.lower()}_score AS VARCHAR), 'None')" for n in names)
    reason = ("'Rationale: ' || COALESCE(left(rationale_for_confidence_score, 200), 'N/A') || chr(10) || "
              "'Next step: ' || COALESCE(left(next_best_action_recommendation, 200), 'N/A')")
    n = "CAST(num_of_blockers AS VARCHAR)"
    prompts = {
        "context": (noted, f"""'Summarise in at most four sentences the customer''s challenge, the expected value, '
            || 'the role of the main contact and whether funding is approved.' || chr(10)
            || 'Notes: ' || COALESCE({strip('sdr_bdr_notes', S.cut_notes_at)}, 'no context provided.')
            || ' Impact: ' || {told('business_impact', 'no business impact provided.')}
            || ' Outcome: ' || {told('business_outcome_description', 'no business outcome provided.')}
            || ' Main contact: ' || {told('ae_authority', 'not specified.')}
            || ' Funding: ' || {told('ae_money_budget', 'not specified.')}"""),
        "next_steps_summary": (ht("demand_plan_stage_next_steps"), """'Condense these next steps into one '
            || 'action-focused sentence:' || chr(10) || trim(demand_plan_stage_next_steps)"""),
        "implementation_notes_summary": (ht("implementation_notes"), """'Condense these implementation notes into a '
            || 'short paragraph on steps, milestones and owners:' || chr(10) || implementation_notes"""),
        "blockers_summary": (
            f"COALESCE(num_of_blockers <> 0, true) AND ({ht('last_modified_blocker_category')} OR "
            f"{ht('last_modified_blocker_comment')})",
            f"""'Name the main theme of the latest blocker in one sentence.' || chr(10) || 'There are ' || {n}
            || ' blockers. ' || CASE WHEN {ht('last_modified_blocker_category')}
                THEN 'Category: ' || trim(last_modified_blocker_category) || '. ' ELSE '' END
            || {told('last_modified_blocker_comment', 'No blocker comment provided.')}"""),
        "usecase_type": (name_or_desc, f"""'Pick the technical category of this use case.' || chr(10) || 'Use case: '
            || {told('usecase_name', '.')} || ' Description: ' || {told('usecase_description', '.')}"""),
        "business_usecase_type": ("true", f"""'Give a business label of at most five words, nothing else. Use case: '
            || {told('usecase_name', 'unknown')} || '. Description: ' || {told('usecase_description', 'none')}
            || '. Industry priority: ' || {told('industry_imperative', 'none')}"""),
        "one_liner": (name_or_desc, f"""'State the core business objective of this use case in one line.' || chr(10)
            || 'Use case: ' || {told('usecase_name', 'not named')} || '. Description: '
            || {told('usecase_description', 'none')} || '. Account context: ' || {told('context', 'none')}"""),
        "soundbyte": ("true", f"""'Write one executive sentence linking the technical solution to the business outcome.'
            || chr(10) || 'Customer: ' || {or_none('account_name', 'unknown')} || chr(10) || 'Challenge: '
            || {or_none('one_liner', 'not specified')} || chr(10) || 'Solution: '
            || {or_none('usecase_type', 'not specified')} || chr(10) || 'Benefit: '
            || {or_none('business_usecase_type', 'not specified')} || chr(10) || 'Goal: '
            || {or_none('context', 'not specified')}"""),
        "ai_confidence_score_advanced": ("true", f"""'Score this use case''s chance to reach production on eight '
            || 'dimensions (0-10): {', '.join(names)}. Answer in four lines: CONFIDENCE_SCORE, LEVEL, RATIONALE, '
            || 'DIMENSION_SCORES.' || chr(10) || {evidence}"""),
        "next_best_action_recommendation": ("true", f"""'Recommend the single next best action for the account team '
            || 'this week, in two lines: NEXT_BEST_ACTION and RATIONALE.' || chr(10) || {evidence} || chr(10)
            || 'Scores: ' || {scores} || chr(10) || 'Level: ' || {or_none('confidence_level_normalized')}"""),
        "slippage_category": ("likely_to_slip", f"""'Pick the main reason this use case may slip: {", ".join(SLIPPAGE_LABELS)}.' || chr(10) || {reason}"""),
        "accel_category": ("can_be_accelerated", f"""'Pick the main lever to accelerate this use case: {", ".join(ACCELERATION_LABELS)}.' || chr(10) || {reason}"""),
    }
    return prompts


def _prompts_sql() -> str:
    """(usecase_id, last_modified_date, stage, prompt) over the enriched rows with their inputs (l5)."""
    return " UNION ALL ".join(f"SELECT usecase_id, last_modified_date, {q(k)} AS stage, "
                              f"CASE WHEN {guard} THEN {p} END AS prompt FROM l5" for k, (guard, p) in _prompts().items())


SQL["infer_distinct_prompts"] = _enr("SELECT stage, count(*) AS rows, count(prompt) AS sent, count(DISTINCT prompt) AS "
                                     f"distinct_prompts FROM ({_prompts_sql()}) GROUP BY stage")
SQL["infer_model_answers"] = _enr("SELECT usecase_id, stage, CAST(length(prompt) AS VARCHAR) AS answer, false AS failed "
                                  f"FROM ({_prompts_sql()})")


# -- change feed as a diff of two versions -------------------------------------------------

def _version_diff_sql() -> str:
    o_cols = ", ".join(f"o.{c}" for c in fixed.ENRICHED_COLUMNS)
    n_cols = ", ".join(f"n.{c}" for c in fixed.ENRICHED_COLUMNS)
    differs = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in fixed.ENRICHED_COLUMNS)
    return _st(f"""SELECT {n_cols}, 'insert' AS _change_type FROM state n
WHERE NOT EXISTS (SELECT 1 FROM v0 o WHERE o.usecase_id = n.usecase_id)
UNION ALL
SELECT {o_cols}, 'delete' FROM v0 o WHERE NOT EXISTS (SELECT 1 FROM state n WHERE o.usecase_id = n.usecase_id)
UNION ALL
SELECT {o_cols}, 'update_preimage' FROM v0 o JOIN state n ON o.usecase_id = n.usecase_id WHERE {differs}
UNION ALL
SELECT {n_cols}, 'update_postimage' FROM v0 o JOIN state n ON o.usecase_id = n.usecase_id WHERE {differs}""")


SQL["version_diff"] = _version_diff_sql()


# -- runs on a bucketed table ------------------------------------------------------------------

SQL["bucketed_upsert"] = SQL["upsert_newer_wins"]
SQL["incremental_run_written"] = (
    SQL["verification_counts"] + " UNION ALL SELECT 'Rows read back', count(*) FROM state"
    " UNION ALL SELECT 'Keys read back', count(DISTINCT usecase_id) FROM state"
    " UNION ALL SELECT 'Rows in the batch', count(*) FROM cls"
    " UNION ALL SELECT 'Versions committed by an ended run', 0" + "".join(
        f" UNION ALL SELECT 'Rows {a}', count(*) FROM cls WHERE _action = '{a}'" for a in ("insert", "update", "unchanged")))


def _run_ctes() -> list[tuple[str, str]]:
    """s1..s3: states after each of three runs; c1..c3: their batches with actions; feed: what they changed."""
    ctes, feeds, before = [], [], "v0"
    for run, cut in enumerate(fixed.RUN_CUTS, 1):
        seen = "last_modified_date" if cut is None else f"least(last_modified_date, {d(cut)})"
        ctes.append((f"c{run}", f"""SELECT b.*, CASE WHEN t.usecase_id IS NULL THEN 'insert'
  WHEN b.last_modified_date > t.last_modified_date THEN 'update' ELSE 'unchanged' END AS _action
FROM (SELECT * REPLACE ({seen} AS last_modified_date, CAST({d(S.as_of)} - {len(fixed.RUN_CUTS) - run} AS DATE) AS processed_date)
      FROM b_enr) b LEFT JOIN {before} t ON t.usecase_id = b.usecase_id"""))
        ctes.append((f"s{run}", f"""SELECT {COLS} FROM {before} t
WHERE NOT EXISTS (SELECT 1 FROM c{run} c WHERE c._action = 'update' AND c.usecase_id = t.usecase_id)
UNION ALL SELECT {COLS} FROM c{run} WHERE _action <> 'unchanged'"""))
        feeds.append(f"""SELECT {COLS}, CASE _action WHEN 'insert' THEN 'insert' ELSE 'update_postimage' END AS _change_type,
  {run} AS run FROM c{run} WHERE _action <> 'unchanged'
UNION ALL SELECT {COLS}, 'update_preimage', {run} FROM {before} t
WHERE EXISTS (SELECT 1 FROM c{run} c WHERE c._action = 'update' AND c.usecase_id = t.usecase_id)""")
        before = f"s{run}"
    return [*ctes, ("feed", " UNION ALL ".join(feeds))]


SQL["change_feed_range"] = _st("SELECT * FROM feed WHERE run > 1", *_run_ctes())
# the net change from the states themselves: before the first and after the last run
SQL["change_feed_net"] = _st(f"""SELECT n.*, CASE WHEN o.usecase_id IS NULL THEN 'insert' ELSE 'update_postimage' END
  AS _change_type, last AS run
FROM (SELECT {COLS} FROM s3) n JOIN touched USING (usecase_id) LEFT JOIN v0 o USING (usecase_id)
UNION ALL SELECT o.*, 'update_preimage', first FROM (SELECT {COLS} FROM v0) o JOIN touched USING (usecase_id)""",
                            *_run_ctes(), ("touched", "SELECT usecase_id, min(run) AS first, max(run) AS last FROM feed GROUP BY 1"))
SQL["run_properties"] = _st(" UNION ALL ".join(
    f"""SELECT 'rule' AS primary_model, 'rule' AS confidence_model, 'rule' AS business_label_model, 'v1' AS prompt_version,
  'incremental' AS pipeline_type, 'gold' AS quality_tier, CAST({'NULL' if cut is None else d(cut)} AS DATE) AS watermark,
  CAST({d(S.as_of)} - {len(fixed.RUN_CUTS) - run} AS DATE) AS as_of, count(*) AS batch_rows,
  count(*) FILTER (WHERE _action = 'insert') AS inserted, count(*) FILTER (WHERE _action = 'update') AS updated,
  {run} AS run FROM c{run}""" for run, cut in enumerate(fixed.RUN_CUTS, 1)), *_run_ctes())


# -- answers of earlier runs; the chain on model answers -----------------------------------------

_ASKED = (f"SELECT DISTINCT stage, prompt, last_modified_date <= {d(fixed.CUT_DATE)} AS early FROM ({_prompts_sql()}) "
          "WHERE prompt IS NOT NULL")
SQL["infer_cached"] = _enr(f"""SELECT stage, run, count(*) AS asked, count(*) FILTER (WHERE known) AS found,
  count(*) FILTER (WHERE NOT known) AS sent
FROM (SELECT stage, prompt, 1 AS run, false AS known FROM prompts WHERE early
      UNION ALL SELECT stage, prompt, 2, early FROM prompts UNION ALL SELECT stage, prompt, 3, true FROM prompts)
GROUP BY stage, run""", ("prompts", f"SELECT stage, prompt, bool_or(early) AS early FROM ({_ASKED}) GROUP BY 1, 2"))


def _model_sql() -> str:
    """The five levels on the answers of the stand-in model, spelled out by the length n of a prompt."""
    from dealscope.settings import (DEFAULT_ACTION, DEFAULT_ASSESSMENT, DIMENSIONS as dims, NO_BLOCKER_DETAILS, NO_CONTEXT,
                                    NO_IMPLEMENTATION_PLAN, NO_NAME_OR_DESCRIPTION, NO_NEXT_STEPS, NO_SOUNDBYTE,
                                    NOT_APPLICABLE, UNKNOWN_ACCELERATION, UNKNOWN_BUSINESS_LABEL, UNKNOWN_SLIPPAGE,
                                    USECASE_TYPES, ZERO_BLOCKERS)
    n = "CAST({n} AS VARCHAR)"
    plain = f"CASE WHEN {{n}} % 13 <> 0 THEN 'answer ' || {n} END"

    def closed(labels) -> str:  # the label after the last one is outside the set and counts as none
        return f"([{', '.join(q(x) for x in labels)}])[{{n}} % {len(labels) + 1} + 1]"
    scores = " || ', ' || ".join(f"'{x}=' || CAST({{n}} * {i + 1} % 11 AS VARCHAR)" for i, x in enumerate(dims))
    assessed = (f"CASE WHEN {{n}} % 7 = 0 THEN 'no assessment' ELSE 'CONFIDENCE_SCORE: ' || CAST({{n}} % 21 * 5 AS VARCHAR) || "
                "chr(10) || 'LEVEL: ' || CASE {n} % 3 WHEN 0 THEN 'High' WHEN 1 THEN 'Medium' ELSE 'Low' END || chr(10) || "
                f"'RATIONALE: a prompt of ' || {n} || ' characters.' || chr(10) || 'DIMENSION_SCORES: ' || {scores} END")
    action = (f"'NEXT_BEST_ACTION: call ' || {n} || chr(10) || 'RATIONALE: ' || CAST({{n}} % 10 AS VARCHAR) || ' reasons.'")
    blocked = "'There are ' || CAST(num_of_blockers AS VARCHAR) || ' blockers. ' || {a}"
    no_blockers = f"CASE WHEN num_of_blockers = 0 THEN {q(ZERO_BLOCKERS)} ELSE {q(NO_BLOCKER_DETAILS)} END"
    # stage -> answer by n, default, wrapping, value where the guard is false
    stages = [
        {"context": (plain, None, "{a}", q(NO_CONTEXT)), "next_steps_summary": (plain, None, "{a}", q(NO_NEXT_STEPS)),
         "implementation_notes_summary": (plain, None, "{a}", q(NO_IMPLEMENTATION_PLAN)),
         "blockers_summary": (plain, None, blocked, no_blockers),
         "usecase_type": (closed(USECASE_TYPES), "Other", "{a}", "'Other'"),
         "business_usecase_type": (plain, UNKNOWN_BUSINESS_LABEL, "{a}", "NULL")},
        {"one_liner": (plain, None, "{a}", q(NO_NAME_OR_DESCRIPTION))},
        {"soundbyte": (plain, NO_SOUNDBYTE, "{a}", "NULL"),
         "ai_confidence_score_advanced": (assessed, DEFAULT_ASSESSMENT, "{a}", "NULL")},
        {"next_best_action_recommendation": (action, DEFAULT_ACTION, "{a}", "NULL")},
        {"slippage_category": (closed(SLIPPAGE_LABELS), UNKNOWN_SLIPPAGE, "{a}", q(NOT_APPLICABLE)),
         "accel_category": (closed(ACCELERATION_LABELS), UNKNOWN_ACCELERATION, "{a}", q(NOT_APPLICABLE))}]
    prompts, parse = _prompts(), dict(enriched_ctes(S))
    ctes, source = [], "ex"
    for level, named in enumerate(stages, 1):
        if level == 4:  # the assessment is parsed and normalised natively
            ctes += [("m_p", parse["p"].replace("FROM l3", f"FROM {source}")), ("m_pn", parse["pn"].replace("FROM p", "FROM m_p"))]
            source = "m_pn"
        if level == 5:
            ctes.append(("m_flags", f"""SELECT *, COALESCE(confidence_level_normalized = 'Medium', false) AS likely_to_slip,
  COALESCE(confidence_level_normalized IN ('Medium', 'High'), false) AS can_be_accelerated FROM {source}"""))
            source = "m_flags"
        asked = ", ".join(f"CASE WHEN {prompts[k][0]} THEN {prompts[k][1]} END AS _p_{k}" for k in named)
        ctes.append((f"m{level}_asked", f"SELECT *, {asked} FROM {source}"))
        done = []
        for k, (answer, default, wrap, otherwise) in named.items():
            a = f"CASE WHEN length(_p_{k}) % 29 <> 0 THEN {answer.format(n=f'length(_p_{k})')} END"
            a = f"({a})" if default is None else f"COALESCE({a}, {q(default)})"
            done.append(f"CASE WHEN {prompts[k][0]} THEN {wrap.format(a=a)} ELSE {otherwise} END AS {k}")
        ctes.append((f"m{level}", f"SELECT *, {', '.join(done)} FROM m{level}_asked"))
        source = f"m{level}"
    columns = ", ".join(f"{d(S.as_of)} AS processed_date" if c == "processed_date" else c for c in fixed.ENRICHED_COLUMNS)
    return _uc(f"SELECT {columns} FROM {source}", _EX, *ctes)


SQL["enriched_by_model"] = _model_sql()
