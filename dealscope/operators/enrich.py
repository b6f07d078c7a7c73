"""The twelve enrichment stages as one column chain over the extract.

Stages are grouped by dependency level; each level is one projection for
the rule backend (or one de-duplicated model pass for a callable backend),
so every stage is evaluated exactly once per row -- the view-per-stage
design would re-evaluate upstream stages at every reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope.functions import answers as ans
from dealscope.functions.text import any_text, first_words, has_text, strip_html, word_count
from dealscope.operators.inference import Backend, Stage, apply_level, rule_classify, rule_summarize
from dealscope.settings import (ACCELERATION_LABELS, DEFAULT, DEFAULT_ACTION, DEFAULT_ASSESSMENT,
                                DIMENSIONS, NO_BLOCKER_DETAILS, NO_CONTEXT,
                                NO_IMPLEMENTATION_PLAN, NO_NAME_OR_DESCRIPTION, NO_NEXT_STEPS,
                                NO_SOUNDBYTE, NOT_APPLICABLE, SLIPPAGE_LABELS, UNKNOWN_ACCELERATION,
                                UNKNOWN_BUSINESS_LABEL, UNKNOWN_SLIPPAGE, USECASE_TYPES, ZERO_BLOCKERS,
                                Settings)

# Options of the model calls (fixed values): short label, structured answers.
LABEL_OPTIONS = (("max_tokens", 20), ("temperature", 0.0))
ANSWER_OPTIONS = (("max_tokens", 200), ("temperature", 0.0), ("top_p", 0.1))

# Keyword lists of the rule classifier (our own vocabulary, lower case).
USECASE_KEYWORDS = {
    "Machine Learning": ("model", "prediction", "predictive", "forecast", "forecasting", "churn", "scoring"),
    "Generative AI": ("genai", "llm", "chatbot", "assistant", "generative", "agent", "rag"),
    "Data Warehousing": ("warehouse", "warehousing", "dwh", "sql", "olap", "mart"),
    "Migration AI": ("migration", "migrate", "ml", "ai"),
    "Migration Unity Catalog": ("migration", "migrate", "catalog", "permissions"),
    "Migration DWH": ("migration", "migrate", "warehouse", "dwh"),
    "Migration ETL": ("migration", "migrate", "etl", "pipelines"),
    "Migration Streaming": ("migration", "migrate", "streaming", "kafka"),
    "Migration BI": ("migration", "migrate", "bi", "dashboards"),
    "BI": ("bi", "dashboard", "dashboards", "reporting", "report", "reports"),
    "ETL": ("etl", "pipeline", "pipelines", "transform", "transformation"),
    "Governance": ("governance", "lineage", "audit", "compliance", "access"),
    "Streaming": ("streaming", "stream", "realtime", "kafka", "events"),
    "Ingestion": ("ingestion", "ingest", "connector", "cdc", "load"),
    "Platform": ("platform", "infrastructure", "workspace", "cluster", "compute"),
    "Other": (),
}
SLIPPAGE_KEYWORDS = {
    "Technical": ("technical", "bug", "feature", "defect", "performance"),
    "Business": ("priority", "priorities", "value", "business"),
    "Stakeholder": ("sponsor", "champion", "stakeholder", "stakeholders"),
    "Budget": ("budget", "funding", "approval", "spend"),
    "Project Timelines": ("timeline", "milestone", "milestones", "deadline", "schedule"),
    "Data": ("data", "quality", "access"),
    "Integration": ("integration", "connectivity", "api", "tooling"),
    "Partner": ("partner", "si", "consultancy"),
    "Hyperscaler": ("quota", "region", "hyperscaler"),
    "Competition": ("competitor", "competition", "rival"),
    "Other": (),
    "External dependencies": ("external", "vendor", "dependency", "dependencies"),
}
ACCELERATION_KEYWORDS = {
    "Implementation Planning": ("plan", "owners", "milestones", "implementation"),
    "Resource Allocation": ("resources", "staff", "capacity", "compute"),
    "Stakeholder Engagement": ("sponsor", "decision", "makers", "alignment", "cadence"),
    "Technical Optimization": ("blocker", "blockers", "fix", "tuning", "architecture"),
    "Partnership Leverage": ("partner", "partners"),
    "Governance and Support": ("steering", "sla", "support", "governance"),
    "Innovation and Technology Enablement": ("template", "templates", "automation", "accelerator"),
    "Capability Development": ("training", "upskilling", "enablement"),
    "Funding": ("budget", "funding", "approval"),
    "Other": (),
}


def _labels(order, kw):
    return [(label, kw[label]) for label in order]


def _t(c: str) -> Column:
    return F.trim(F.col(c))


def _cs(x: Column) -> Column:
    return x.cast("string")


# -- level 1: from the extract ----------------------------------------------

def context_stage(s: Settings) -> Stage:
    content = F.concat(
        F.lit("Notes: "), F.coalesce(strip_html("sdr_bdr_notes", s.cut_notes_at), F.lit("no context provided.")),
        F.lit(" Impact: "), F.coalesce(_t("business_impact"), F.lit("no business impact provided.")),
        F.lit(" Outcome: "), F.coalesce(_t("business_outcome_description"), F.lit("no business outcome provided.")),
        F.lit(" Main contact: "), F.coalesce(_t("ae_authority"), F.lit("not specified.")),
        F.lit(" Funding: "), F.coalesce(_t("ae_money_budget"), F.lit("not specified.")),
    )
    prompt = F.concat(F.lit("Summarise in at most four sentences the customer's challenge, the expected "
                            "value, the role of the main contact and whether funding is approved.\n"), content)
    return Stage("context", prompt, rule_summarize(content, 100),
                 guard=any_text("sdr_bdr_notes", "business_impact", "business_outcome_description",
                                "ae_authority", "ae_money_budget"),
                 otherwise=F.lit(NO_CONTEXT))


def next_steps_stage(s: Settings) -> Stage:
    content = _t("demand_plan_stage_next_steps")
    prompt = F.concat(F.lit("Condense these next steps into one action-focused sentence:\n"), content)
    return Stage("next_steps_summary", prompt, rule_summarize(content, 100),
                 guard=has_text("demand_plan_stage_next_steps"), otherwise=F.lit(NO_NEXT_STEPS))


def implementation_stage(s: Settings) -> Stage:
    content = F.col("implementation_notes")
    prompt = F.concat(F.lit("Condense these implementation notes into a short paragraph on steps, "
                            "milestones and owners:\n"), content)
    return Stage("implementation_notes_summary", prompt, rule_summarize(content, 100),
                 guard=has_text("implementation_notes"), otherwise=F.lit(NO_IMPLEMENTATION_PLAN))


def blockers_stage(s: Settings) -> Stage:
    n = _cs(F.col("num_of_blockers"))
    content = F.concat(
        F.lit("There are "), n, F.lit(" blockers. "),
        F.when(has_text("last_modified_blocker_category"),
               F.concat(F.lit("Category: "), _t("last_modified_blocker_category"), F.lit(". ")))
         .otherwise(F.lit("")),
        F.coalesce(_t("last_modified_blocker_comment"), F.lit("No blocker comment provided.")),
    )
    prompt = F.concat(F.lit("Name the main theme of the latest blocker in one sentence.\n"), content)
    no_details = ~has_text("last_modified_blocker_category") & ~has_text("last_modified_blocker_comment")
    guard = ~F.coalesce(F.col("num_of_blockers") == 0, F.lit(False)) & ~no_details
    otherwise = F.when(F.col("num_of_blockers") == 0, F.lit(ZERO_BLOCKERS)).otherwise(F.lit(NO_BLOCKER_DETAILS))
    return Stage("blockers_summary", prompt, rule_summarize(content, 50), guard=guard, otherwise=otherwise,
                 post=lambda a: F.concat(F.lit("There are "), n, F.lit(" blockers. "), a))


def usecase_type_stage(s: Settings) -> Stage:
    content = F.concat(F.lit("Use case: "), F.coalesce(_t("usecase_name"), F.lit(".")),
                       F.lit(" Description: "), F.coalesce(_t("usecase_description"), F.lit(".")))
    prompt = F.concat(F.lit("Pick the technical category of this use case.\n"), content)
    return Stage("usecase_type", prompt, rule_classify(content, _labels(USECASE_TYPES, USECASE_KEYWORDS)),
                 guard=any_text("usecase_name", "usecase_description"), otherwise=F.lit("Other"),
                 default="Other", labels=tuple(USECASE_TYPES))


def business_label_stage(s: Settings) -> Stage:
    industry = F.when(has_text("industry_imperative"),
                      F.lower(first_words(F.col("industry_imperative"), 1))).otherwise(F.lit("general"))
    # the first three words of the most telling run of the name and the whole description
    told = F.concat_ws(" ", _t("usecase_name"), _t("usecase_description"))
    rule = F.when(any_text("usecase_name", "usecase_description"),
                  F.concat(F.lower(first_words(rule_summarize(told, 10), 3)), F.lit(" for "), industry))
    prompt = F.concat(
        F.lit("Give a business label of at most five words, nothing else. Use case: "),
        F.coalesce(_t("usecase_name"), F.lit("unknown")),
        F.lit(". Description: "), F.coalesce(_t("usecase_description"), F.lit("none")),
        F.lit(". Industry priority: "), F.coalesce(_t("industry_imperative"), F.lit("none")))
    return Stage("business_usecase_type", prompt, rule, default=UNKNOWN_BUSINESS_LABEL, options=LABEL_OPTIONS)


# -- level 2 -----------------------------------------------------------------

def one_liner_stage(s: Settings) -> Stage:
    content = F.concat(F.lit("Use case: "), F.coalesce(_t("usecase_name"), F.lit("not named")),
                       F.lit(". Description: "), F.coalesce(_t("usecase_description"), F.lit("none")),
                       F.lit(". Account context: "), F.coalesce(F.trim(F.col("context")), F.lit("none")))
    prompt = F.concat(F.lit("State the core business objective of this use case in one line.\n"), content)
    return Stage("one_liner", prompt, rule_summarize(content, 50),
                 guard=any_text("usecase_name", "usecase_description"), otherwise=F.lit(NO_NAME_OR_DESCRIPTION))


# -- level 3 -----------------------------------------------------------------

def soundbyte_stage(s: Settings) -> Stage:
    rule = F.concat(
        F.lit("By delivering "), F.lower(F.col("usecase_type")), F.lit(" for "),
        F.coalesce(F.col("account_name"), F.lit("the customer")), F.lit(", the team turns "),
        rule_summarize(F.col("one_liner"), 10), F.lit(" into "), F.col("business_usecase_type"), F.lit("."))
    prompt = F.concat(
        F.lit("Write one executive sentence linking the technical solution to the business outcome.\n"),
        F.lit("Customer: "), F.coalesce(F.col("account_name"), F.lit("unknown")),
        F.lit("\nChallenge: "), F.coalesce(F.col("one_liner"), F.lit("not specified")),
        F.lit("\nSolution: "), F.coalesce(F.col("usecase_type"), F.lit("not specified")),
        F.lit("\nBenefit: "), F.coalesce(F.col("business_usecase_type"), F.lit("not specified")),
        F.lit("\nGoal: "), F.coalesce(F.col("context"), F.lit("not specified")))
    return Stage("soundbyte", prompt, rule, default=NO_SOUNDBYTE)


#: Urgency that a use case has at least where its timeline urgency is read.
TIMELINE_URGENCY = {"High": 9, "Medium": 6, "Low": 3}


def rule_dimensions(s: Settings = DEFAULT) -> dict[str, Column]:
    """Evidence rules of the stand-in assessor (0..10 each)."""
    ctx_words = word_count(F.col("context"))
    ns = F.col("next_steps_summary")
    imp = F.col("implementation_notes_summary")
    ctx = F.lower(F.col("context"))
    urgency = F.length(ns) % 11
    if s.urgency_input:
        told = [F.when(_t("timeline_urgency") == level, F.lit(least)) for level, least in TIMELINE_URGENCY.items()]
        urgency = F.greatest(urgency, F.coalesce(*told, F.lit(0)))
    return {
        "Pain": F.least(F.lit(10), F.floor(ctx_words / 10).cast("int")),
        "Champion": F.when(ctx.contains("sponsor") | ctx.contains("decision maker"), F.lit(8)).otherwise(F.lit(3)),
        "ImplementationPlan": F.when(imp == NO_IMPLEMENTATION_PLAN, F.lit(1))
                               .otherwise(F.least(F.lit(10), F.lit(3) + word_count(imp) % 8)),
        "DecisionProcess": F.when(ns == NO_NEXT_STEPS, F.lit(2))
                            .otherwise(F.least(F.lit(10), F.lit(2) + F.floor(word_count(ns) / 12).cast("int"))),
        "Urgency": urgency,
        "CompetitionAwareness": F.when(has_text("competition_string"), F.lit(7)).otherwise(F.lit(2)),
        "MajorBlockers": F.least(F.lit(10), (F.col("num_of_blockers") * 2).cast("int")),
        "MeasurableImpact": ctx_words % 11,
    }


def assessment_stage(s: Settings) -> Stage:
    dims = rule_dimensions(s)
    score = ans.weighted_score(dims, s)
    # The stand-in reports its own level with slightly looser cut-offs than
    # the normalisation rule, so self-reported and normalised levels can differ.
    level = F.when(score >= 70, F.lit("High")).when(score >= 40, F.lit("Medium")).otherwise(F.lit("Low"))
    rationale = F.concat(
        F.lit("Evidence covers "), _cs(word_count(F.col("context"))), F.lit(" context words, "),
        _cs(F.col("num_of_blockers")), F.lit(" blockers and "),
        F.when(has_text("competition_string"), F.lit("a known competitor")).otherwise(F.lit("no known competitor")),
        F.lit("."))
    dim_text = []
    for i, d in enumerate(DIMENSIONS):
        dim_text += [F.lit(("" if i == 0 else ", ") + d + "="), _cs(dims[d])]
    rule = F.concat(F.lit("CONFIDENCE_SCORE: "), _cs(score), F.lit("\nLEVEL: "), level,
                    F.lit("\nRATIONALE: "), rationale, F.lit("\nDIMENSION_SCORES: "), *dim_text)
    prompt = F.concat(
        F.lit("Score this use case's chance to reach production on eight dimensions (0-10): "
              + ", ".join(DIMENSIONS) + ". Answer in four lines: CONFIDENCE_SCORE, LEVEL, RATIONALE, "
              "DIMENSION_SCORES.\n"),
        F.lit("Context: "), F.coalesce(F.col("context"), F.lit("none")),
        F.lit("\nUse case: "), F.coalesce(F.col("one_liner"), F.lit("none")),
        F.lit("\nNext steps: "), F.coalesce(F.col("next_steps_summary"), F.lit("none")),
        F.lit("\nImplementation: "), F.coalesce(F.col("implementation_notes_summary"), F.lit("none")),
        F.lit("\nBlockers: "), F.coalesce(F.col("blockers_summary"), F.lit("none")),
        F.lit("\nCompetition: "), F.coalesce(F.col("competition_string"), F.lit("none")))
    if s.urgency_input:
        prompt = F.concat(prompt, F.lit("\nTimeline urgency: "), F.coalesce(
            F.when(has_text("timeline_urgency"), F.col("timeline_urgency")), F.lit("none")))
    return Stage("ai_confidence_score_advanced", prompt, rule, default=DEFAULT_ASSESSMENT, options=ANSWER_OPTIONS)


# -- level 4 -----------------------------------------------------------------

ACTIONS = {
    "foundations": ("Schedule a sponsor workshop this week to confirm the business pain, name the champion "
                    "and agree an implementation plan with owners and milestones."),
    "blockers": ("Run a technical blocker review with the data and integration owners and agree a fix date "
                 "for each blocker."),
    "urgent": "Lock the go-live timeline with the decision makers and secure the budget approval before the deadline.",
    "steady": ("Keep the weekly cadence, track consumption against the success metrics and plan the next "
               "workload with the partner team."),
}


def action_stage(s: Settings) -> Stage:
    def z(c):
        return F.coalesce(F.col(c), F.lit(0))
    weak = (z("pain_score") < 5) | (z("champion_score") < 5) | (z("implementationplan_score") < 5)
    action = (F.when(weak, F.lit(ACTIONS["foundations"]))
              .when(z("majorblockers_score") > 5, F.lit(ACTIONS["blockers"]))
              .when(z("urgency_score") > 7, F.lit(ACTIONS["urgent"]))
              .otherwise(F.lit(ACTIONS["steady"])))

    def sc(c):
        return F.coalesce(_cs(F.col(c)), F.lit("None"))
    why = F.concat(F.lit("Pain="), sc("pain_score"), F.lit(", Champion="), sc("champion_score"),
                   F.lit(", ImplementationPlan="), sc("implementationplan_score"),
                   F.lit(", MajorBlockers="), sc("majorblockers_score"), F.lit(", Urgency="), sc("urgency_score"),
                   F.lit("; level "), F.col("confidence_level_normalized"), F.lit("."))
    rule = F.concat(F.lit("NEXT_BEST_ACTION: "), action, F.lit("\nRATIONALE: "), why)
    dims = [F.concat(F.lit(f"{d}="), sc(c)) for d, c in zip(DIMENSIONS, ans.SCORE_COLUMNS)]
    prompt = F.concat(
        F.lit("Recommend the single next best action for the account team this week, in two lines: "
              "NEXT_BEST_ACTION and RATIONALE.\n"),
        F.lit("Context: "), F.coalesce(F.col("context"), F.lit("none")),
        F.lit("\nUse case: "), F.coalesce(F.col("one_liner"), F.lit("none")),
        F.lit("\nNext steps: "), F.coalesce(F.col("next_steps_summary"), F.lit("none")),
        F.lit("\nImplementation: "), F.coalesce(F.col("implementation_notes_summary"), F.lit("none")),
        F.lit("\nBlockers: "), F.coalesce(F.col("blockers_summary"), F.lit("none")),
        F.lit("\nCompetition: "), F.coalesce(F.col("competition_string"), F.lit("none")),
        F.lit("\nScores: "), F.concat_ws(", ", *dims),
        F.lit("\nLevel: "), F.coalesce(F.col("confidence_level_normalized"), F.lit("none")))
    return Stage("next_best_action_recommendation", prompt, rule, default=DEFAULT_ACTION, options=ANSWER_OPTIONS)


# -- level 5 -----------------------------------------------------------------

def _reason_content(s: Settings) -> Column:
    return F.concat(
        F.lit("Rationale: "), F.coalesce(F.left(F.col("rationale_for_confidence_score"), F.lit(s.cut_reason_at)),
                                         F.lit(NOT_APPLICABLE)),
        F.lit("\nNext step: "), F.coalesce(F.left(F.col("next_best_action_recommendation"), F.lit(s.cut_reason_at)),
                                           F.lit(NOT_APPLICABLE)))


def slippage_stage(s: Settings) -> Stage:
    content = _reason_content(s)
    prompt = F.concat(F.lit("Pick the main reason this use case may slip: " + ", ".join(SLIPPAGE_LABELS)
                            + ".\n"), content)
    return Stage("slippage_category", prompt, rule_classify(content, _labels(SLIPPAGE_LABELS, SLIPPAGE_KEYWORDS)),
                 guard=ans.slip_flag(F.col("confidence_level_normalized")), otherwise=F.lit(NOT_APPLICABLE),
                 default=UNKNOWN_SLIPPAGE, labels=tuple(SLIPPAGE_LABELS))


def acceleration_stage(s: Settings) -> Stage:
    content = _reason_content(s)
    prompt = F.concat(F.lit("Pick the main lever to accelerate this use case: " + ", ".join(ACCELERATION_LABELS)
                            + ".\n"), content)
    return Stage("accel_category", prompt,
                 rule_classify(content, _labels(ACCELERATION_LABELS, ACCELERATION_KEYWORDS)),
                 guard=ans.accel_flag(F.col("confidence_level_normalized")), otherwise=F.lit(NOT_APPLICABLE),
                 default=UNKNOWN_ACCELERATION, labels=tuple(ACCELERATION_LABELS))


# -- the chain ---------------------------------------------------------------

ENRICHED_COLUMNS = (
    "usecase_id", "last_modified_date", "processed_date", "competition_string", "num_of_blockers",
    "context", "one_liner", "next_steps_summary", "implementation_notes_summary", "blockers_summary",
    "usecase_type", "business_usecase_type", "soundbyte",
    "ai_confidence_score_advanced", "confidence_score", "confidence_level", "rationale_for_confidence_score",
    *ans.SCORE_COLUMNS, "confidence_level_normalized",
    "next_best_action_recommendation", "likely_to_slip", "slippage_category", "can_be_accelerated",
    "accel_category",
)


_STAGES: dict = {}


def _stage_set(s: Settings) -> dict:
    """All stage definitions for ``s``, built once (expression trees are
    immutable and cost driver round trips to build)."""
    key = repr(s)
    if key not in _STAGES:
        _STAGES[key] = {"levels": _stage_levels(s), "action": action_stage(s),
                        "reasons": [slippage_stage(s), acceleration_stage(s)]}
    return _STAGES[key]


def stage_levels(s: Settings = DEFAULT) -> list[list[Stage]]:
    return _stage_set(s)["levels"]


def all_stages(s: Settings = DEFAULT) -> list[Stage]:
    """The twelve stages in the order of their levels."""
    st = _stage_set(s)
    return [x for level in st["levels"] for x in level] + [st["action"], *st["reasons"]]


def _stage_levels(s: Settings) -> list[list[Stage]]:
    return [
        [context_stage(s), next_steps_stage(s), implementation_stage(s), blockers_stage(s),
         usecase_type_stage(s), business_label_stage(s)],
        [one_liner_stage(s)],
        [soundbyte_stage(s), assessment_stage(s)],
    ]


def enrich(extract_df: DataFrame, settings: Settings = DEFAULT, backend: Backend = "rule",
           key: str = "usecase_id", keep_inputs: bool = False, **infer_opts) -> DataFrame:
    """Add all enrichment columns (I1-I12, D1-D9) to the extract.

    With a callable backend every level's answers are checkpointed inside
    ``apply_level`` (calls are paid once); the rule backend is one lazy
    projection chain with no shuffle.
    """
    s = settings
    df = extract_df
    parts = s.enrich_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if parts > 1:
        # Spread the CPU-heavy stage chain over the cluster by key (filters
        # can leave the surviving rows in a few scan partitions).  The key
        # joins downstream (upsert, reporting) reuse this partitioning.
        df = df.repartition(parts, key)
    stages = _stage_set(s)
    for lvl in stages["levels"]:
        df = apply_level(df, key, lvl, backend, **infer_opts)
    df = ans.parse_answer(df, "ai_confidence_score_advanced", "num_of_blockers", s)
    df = df.withColumn("confidence_level_normalized", ans.normalized_level(F.col("confidence_score"), s))
    df = apply_level(df, key, [stages["action"]], backend, **infer_opts)
    df = df.withColumns({
        "likely_to_slip": ans.slip_flag(F.col("confidence_level_normalized")),
        "can_be_accelerated": ans.accel_flag(F.col("confidence_level_normalized")),
    })
    df = apply_level(df, key, stages["reasons"], backend, **infer_opts)
    df = df.withColumn("processed_date", F.lit(s.as_of))
    if keep_inputs:
        return df
    return df.select(*ENRICHED_COLUMNS)
