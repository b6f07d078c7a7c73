"""DuckDB oracle of the enrichment chain (rule backend)."""

from __future__ import annotations

from dealscope.settings import (ACCELERATION_LABELS, DEFAULT, DEFAULT_ACTION, DEFAULT_ASSESSMENT,
                                DIMENSIONS, NO_BLOCKER_DETAILS, NO_CONTEXT, NO_IMPLEMENTATION_PLAN,
                                NO_NAME_OR_DESCRIPTION, NO_NEXT_STEPS, NO_SOUNDBYTE, NOT_APPLICABLE,
                                NOT_COMPUTED, OVERRIDE_RATIONALE, SLIPPAGE_LABELS, UNKNOWN_ACCELERATION,
                                UNKNOWN_BUSINESS_LABEL, UNKNOWN_SLIPPAGE, USECASE_TYPES, ZERO_BLOCKERS,
                                Settings)
from oracle import fixed
from oracle.base import d, q
from oracle.fixed import SCORE_COLUMNS

NL = "chr(10)"
WS = "'[\\t\\n\\x0B\\f\\r ]+'"


def ht(x):
    return f"COALESCE(length(trim({x})) > 0, false)"


def collapse(x):
    return f"trim(regexp_replace({x}, {WS}, ' ', 'g'))"


def fw(x, n):
    return f"array_to_string(string_split({collapse(x)}, ' ')[1:{n}], ' ')"


def ws(x):
    """The words of a text; kept in a column of its own, as summaries use it several times."""
    return f"string_split({collapse(x)}, ' ')"


def sm(w, n):
    """Whole-text summary of a word-list column: the runs of ten words with most distinct long words, in text order."""
    run = f"{w}[i * 10 + 1:i * 10 + 10]"
    ranked = (f"list_sort([{{'rank': -len(list_distinct([lower(y) for y in {run} if length(y) >= 5])), 'at': i}} "
              f"for i in range(0, (len({w}) - 1) // 10 + 1)])[1:{n // 10}]")
    return (f"array_to_string(CASE WHEN len({w}) <= {n} THEN {w} ELSE "
            f"flatten([{run} for i in list_sort([r.at for r in {ranked}])]) END, ' ')")


def wc(x):
    c = collapse(x)
    return f"(CASE WHEN COALESCE(length({c}), 0) = 0 THEN 0 ELSE len(string_split({c}, ' ')) END)"


def strip(x, n=2000):
    return f"trim(left(regexp_replace({x}, '<[^>]+>', '', 'g'), {n}))"


def cls(content, labels, kw):
    toks = f"list_distinct(regexp_split_to_array(lower({content}), '[^a-z0-9]+'))"
    items = []
    for i, label in enumerate(labels):
        kws = kw[label]
        hits = "0" if not kws else f"len(list_intersect({toks}, [{', '.join(q(w) for w in kws)}]))"
        items.append(f"{{'hits': {hits}, 'rank': {-i}, 'label': {q(label)}}}")
    best = f"list_max([{', '.join(items)}])"
    return f"(CASE WHEN ({best}).hits > 0 THEN ({best}).label END)"


def s_(x):
    return f"CAST({x} AS VARCHAR)"


def enriched_ctes(s: Settings = DEFAULT, src: str = "ex", prefix: str = "", urgency: bool = False) -> list[tuple[str, str]]:
    """CTEs l1..l5 + ``enr`` (31 target columns) on top of an extract CTE;
    ``prefix`` renames every CTE so two chains can live in one query;
    ``urgency``: the assessment also reads the timeline urgency."""
    ctx_content = (
        f"'Notes: ' || COALESCE({strip('sdr_bdr_notes', s.cut_notes_at)}, 'no context provided.') || "
        f"' Impact: ' || COALESCE(trim(business_impact), 'no business impact provided.') || "
        f"' Outcome: ' || COALESCE(trim(business_outcome_description), 'no business outcome provided.') || "
        f"' Main contact: ' || COALESCE(trim(ae_authority), 'not specified.') || "
        f"' Funding: ' || COALESCE(trim(ae_money_budget), 'not specified.')")
    ctx_guard = " OR ".join(ht(c) for c in ("sdr_bdr_notes", "business_impact", "business_outcome_description",
                                            "ae_authority", "ae_money_budget"))
    blk_content = (
        f"'There are ' || {s_('num_of_blockers')} || ' blockers. ' || "
        f"CASE WHEN {ht('last_modified_blocker_category')} THEN 'Category: ' || trim(last_modified_blocker_category) "
        f"|| '. ' ELSE '' END || COALESCE(trim(last_modified_blocker_comment), 'No blocker comment provided.')")
    no_details = f"(NOT {ht('last_modified_blocker_category')} AND NOT {ht('last_modified_blocker_comment')})"
    blk_guard = f"(NOT COALESCE(num_of_blockers = 0, false) AND NOT {no_details})"
    type_content = ("'Use case: ' || COALESCE(trim(usecase_name), '.') || ' Description: ' || "
                    "COALESCE(trim(usecase_description), '.')")
    name_or_desc = f"({ht('usecase_name')} OR {ht('usecase_description')})"
    industry = f"CASE WHEN {ht('industry_imperative')} THEN lower({fw('industry_imperative', 1)}) ELSE 'general' END"
    l0 = f"""SELECT *, {ws(ctx_content)} AS _w_ctx, {ws('trim(demand_plan_stage_next_steps)')} AS _w_next,
  {ws('implementation_notes')} AS _w_impl, {ws(blk_content)} AS _w_blk,
  {ws("concat_ws(' ', trim(usecase_name), trim(usecase_description))")} AS _w_told
FROM {src}"""
    l1 = f"""SELECT *,
  CASE WHEN {ctx_guard} THEN {sm('_w_ctx', 100)} ELSE {q(NO_CONTEXT)} END AS context,
  CASE WHEN {ht('demand_plan_stage_next_steps')} THEN {sm('_w_next', 100)}
       ELSE {q(NO_NEXT_STEPS)} END AS next_steps_summary,
  CASE WHEN {ht('implementation_notes')} THEN {sm('_w_impl', 100)}
       ELSE {q(NO_IMPLEMENTATION_PLAN)} END AS implementation_notes_summary,
  CASE WHEN {blk_guard} THEN 'There are ' || {s_('num_of_blockers')} || ' blockers. ' || {sm('_w_blk', 50)}
       WHEN num_of_blockers = 0 THEN {q(ZERO_BLOCKERS)} ELSE {q(NO_BLOCKER_DETAILS)} END AS blockers_summary,
  CASE WHEN {name_or_desc} THEN COALESCE({cls(type_content, USECASE_TYPES, fixed.USECASE_KEYWORDS)}, 'Other')
       ELSE 'Other' END AS usecase_type,
  COALESCE(CASE WHEN {name_or_desc} THEN lower({fw(sm('_w_told', 10), 3)}) || ' for ' || {industry} END,
           {q(UNKNOWN_BUSINESS_LABEL)}) AS business_usecase_type
FROM l0"""
    one_content = ("'Use case: ' || COALESCE(trim(usecase_name), 'not named') || '. Description: ' || "
                   "COALESCE(trim(usecase_description), 'none') || '. Account context: ' || "
                   "COALESCE(trim(context), 'none')")
    l1b = f"SELECT *, {ws(one_content)} AS _w_one FROM l1"
    l2a = f"""SELECT *,
  CASE WHEN {name_or_desc} THEN {sm('_w_one', 50)} ELSE {q(NO_NAME_OR_DESCRIPTION)} END AS one_liner
FROM l1b"""
    l2 = f"SELECT *, {ws('one_liner')} AS _w_line FROM l2a"
    ctxw = wc("context")
    dims = {
        "Pain": f"least(10, CAST(floor({ctxw} / 10) AS INTEGER))",
        "Champion": "CASE WHEN contains(lower(context), 'sponsor') OR contains(lower(context), 'decision maker') "
                    "THEN 8 ELSE 3 END",
        "ImplementationPlan": f"CASE WHEN implementation_notes_summary = {q(NO_IMPLEMENTATION_PLAN)} THEN 1 "
                              f"ELSE least(10, 3 + {wc('implementation_notes_summary')} % 8) END",
        "DecisionProcess": f"CASE WHEN next_steps_summary = {q(NO_NEXT_STEPS)} THEN 2 "
                           f"ELSE least(10, 2 + CAST(floor({wc('next_steps_summary')} / 12) AS INTEGER)) END",
        "Urgency": "length(next_steps_summary) % 11" if not urgency else
                   "greatest(length(next_steps_summary) % 11, CASE trim(timeline_urgency) " + " ".join(
                       f"WHEN {q(k)} THEN {v}" for k, v in fixed.TIMELINE_URGENCY.items()) + " ELSE 0 END)",
        "CompetitionAwareness": f"CASE WHEN {ht('competition_string')} THEN 7 ELSE 2 END",
        "MajorBlockers": "least(10, CAST(num_of_blockers * 2 AS INTEGER))",
        "MeasurableImpact": f"{ctxw} % 11",
    }
    dim_cols = ",\n  ".join(f"{v} AS _d_{k}" for k, v in dims.items())
    l3a = f"SELECT *,\n  {dim_cols}\nFROM l2"
    raw = " + ".join(f"COALESCE(_d_{k}, 0) * ({s.weights_pct[k]})" for k in DIMENSIONS)
    l3b = f"SELECT *, CAST(floor((greatest(0, least(1000, {raw})) + 50) / 100) * 10 AS INTEGER) AS _score FROM l3a"
    dim_text = " || ', ' || ".join(f"'{k}=' || {s_('_d_' + k)}" for k in DIMENSIONS)
    rationale = (f"'Evidence covers ' || {s_(ctxw)} || ' context words, ' || {s_('num_of_blockers')} || "
                 f"' blockers and ' || CASE WHEN {ht('competition_string')} THEN 'a known competitor' "
                 f"ELSE 'no known competitor' END || '.'")
    answer = (f"'CONFIDENCE_SCORE: ' || {s_('_score')} || {NL} || 'LEVEL: ' || "
              f"CASE WHEN _score >= 70 THEN 'High' WHEN _score >= 40 THEN 'Medium' ELSE 'Low' END || {NL} || "
              f"'RATIONALE: ' || {rationale} || {NL} || 'DIMENSION_SCORES: ' || {dim_text}")
    soundbyte = ("'By delivering ' || lower(usecase_type) || ' for ' || COALESCE(account_name, 'the customer') || "
                 f"', the team turns ' || {sm('_w_line', 10)} || ' into ' || business_usecase_type || '.'")
    l3 = f"""SELECT *,
  COALESCE({soundbyte}, {q(NO_SOUNDBYTE)}) AS soundbyte,
  COALESCE({answer}, {q(DEFAULT_ASSESSMENT)}) AS ai_confidence_score_advanced
FROM l3b"""
    over = f"COALESCE(num_of_blockers, 0) > {s.blocker_override_above}"
    a = "ai_confidence_score_advanced"
    flag = "(?s)" if s.multiline_rationale else ""
    parsed_dims = ",\n  ".join(
        f"TRY_CAST(regexp_extract({a}, '{k}=(\\d+)', 1) AS INTEGER) AS {c}" for k, c in zip(DIMENSIONS, SCORE_COLUMNS))
    p = f"""SELECT *,
  CASE WHEN {over} THEN {s.override_score}
       ELSE TRY_CAST(regexp_extract({a}, 'CONFIDENCE_SCORE:\\s*(\\d+)', 1) AS INTEGER) END AS confidence_score,
  CASE WHEN {over} THEN 'Low' ELSE regexp_extract({a}, 'LEVEL:\\s*(High|Medium|Low)', 1) END AS confidence_level,
  CASE WHEN {over} THEN {q(OVERRIDE_RATIONALE)}
       ELSE regexp_extract({a}, '{flag}RATIONALE:\\s*(.+?)\\s*DIMENSION_SCORES:', 1) END AS rationale_for_confidence_score,
  {parsed_dims}
FROM l3"""
    pn = f"""SELECT *,
  CASE WHEN confidence_score >= {s.high_threshold} THEN 'High' WHEN confidence_score >= {s.medium_threshold}
       THEN 'Medium' WHEN confidence_score IS NOT NULL THEN 'Low' ELSE {q(NOT_COMPUTED)} END
    AS confidence_level_normalized
FROM p"""

    def z(c):
        return f"COALESCE({c}, 0)"

    def sc(c):
        return f"COALESCE({s_(c)}, 'None')"
    action = (f"CASE WHEN {z('pain_score')} < 5 OR {z('champion_score')} < 5 OR {z('implementationplan_score')} < 5 "
              f"THEN {q(fixed.ACTIONS['foundations'])} WHEN {z('majorblockers_score')} > 5 THEN {q(fixed.ACTIONS['blockers'])} "
              f"WHEN {z('urgency_score')} > 7 THEN {q(fixed.ACTIONS['urgent'])} ELSE {q(fixed.ACTIONS['steady'])} END")
    why = (f"'Pain=' || {sc('pain_score')} || ', Champion=' || {sc('champion_score')} || "
           f"', ImplementationPlan=' || {sc('implementationplan_score')} || ', MajorBlockers=' || "
           f"{sc('majorblockers_score')} || ', Urgency=' || {sc('urgency_score')} || '; level ' || "
           f"confidence_level_normalized || '.'")
    l4 = f"""SELECT *,
  COALESCE('NEXT_BEST_ACTION: ' || {action} || {NL} || 'RATIONALE: ' || {why}, {q(DEFAULT_ACTION)})
    AS next_best_action_recommendation
FROM pn"""
    reason = (f"'Rationale: ' || COALESCE(left(rationale_for_confidence_score, {s.cut_reason_at}), 'N/A') || {NL} || "
              f"'Next step: ' || COALESCE(left(next_best_action_recommendation, {s.cut_reason_at}), 'N/A')")
    l5 = f"""SELECT *,
  COALESCE(confidence_level_normalized = 'Medium', false) AS likely_to_slip,
  COALESCE(confidence_level_normalized IN ('Medium', 'High'), false) AS can_be_accelerated,
  CASE WHEN COALESCE(confidence_level_normalized = 'Medium', false)
       THEN COALESCE({cls(reason, SLIPPAGE_LABELS, fixed.SLIPPAGE_KEYWORDS)}, {q(UNKNOWN_SLIPPAGE)})
       ELSE {q(NOT_APPLICABLE)} END AS slippage_category,
  CASE WHEN COALESCE(confidence_level_normalized IN ('Medium', 'High'), false)
       THEN COALESCE({cls(reason, ACCELERATION_LABELS, fixed.ACCELERATION_KEYWORDS)}, {q(UNKNOWN_ACCELERATION)})
       ELSE {q(NOT_APPLICABLE)} END AS accel_category,
  {d(s.as_of)} AS processed_date
FROM l4"""
    enr = "SELECT " + ", ".join(fixed.ENRICHED_COLUMNS) + " FROM l5"
    ctes = [("l0", l0), ("l1", l1), ("l1b", l1b), ("l2a", l2a), ("l2", l2), ("l3a", l3a), ("l3b", l3b), ("l3", l3), ("p", p), ("pn", pn),
            ("l4", l4), ("l5", l5), ("enr", enr)]
    if not prefix:
        return ctes
    import re
    names = [n for n, _ in ctes]
    pat = re.compile(r"\bFROM (" + "|".join(names) + r")\b")
    return [(prefix + n, pat.sub(lambda m: "FROM " + prefix + m.group(1), body)) for n, body in ctes]
