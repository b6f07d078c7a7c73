"""Run settings and the fixed vocabularies the results depend on."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values.  These must stay equal to the values of the original
# workflow, because they appear verbatim in filters, closed label sets and
# roll-up outputs.  Keep them as written, in their natural order.
# ---------------------------------------------------------------------------

EXCLUDED_STAGES = ("U1", "Lost", "Closed", "Disqualified")

USECASE_TYPES = (
    "Machine Learning", "Generative AI", "Data Warehousing",
    "Migration AI", "Migration Unity Catalog", "Migration DWH",
    "Migration ETL", "Migration Streaming", "Migration BI",
    "BI", "ETL", "Governance", "Streaming", "Ingestion", "Platform", "Other",
)

SLIPPAGE_CATEGORIES = (
    ("Technical", "Slippage stems from missing features, technical blockers, or unresolved bugs"),
    ("Business", "Slippage is due to shifting business priorities, unclear value, or deprioritization"),
    ("Stakeholder", "Slippage results from lack of stakeholder buy-in, engagement, or sponsor turnover"),
    ("Budget", "Slippage is caused by funding gaps, delayed approvals, or budget freezes"),
    ("Project Timelines", "Slippage is driven by unrealistic schedules, missed milestones, or dependencies"),
    ("Data", "Slippage comes from data issues (access, quality, privacy, or integration)"),
    ("Integration", "Slippage is due to system connectivity, API, or tooling integration problems"),
    ("Partner", "Slippage originates from partner-side limitations, bandwidth, or enablement gaps"),
    ("Hyperscaler", "Slippage stems from hyperscaler constraints (region, quota, roadmap, or policies)"),
    ("Competition", "Slippage is triggered by market shifts or competitive reprioritization"),
    ("External dependencies", "Slippage comes from external third parties or customer-side dependencies"),
    ("Other", "Slippage cause unclear"),
)

ACCELERATION_CATEGORIES = (
    ("Implementation Planning", "Acceleration comes from clarifying the WHAT/WHEN/WHO (critical path, milestones, owners)"),
    ("Resource Allocation", "The plan exists but we need people/tools/compute NOW"),
    ("Stakeholder Engagement", "Acceleration is through stakeholder alignment, exec cadence, or clearing decisions"),
    ("Technical Optimization", "Acceleration is via performance, architecture, or integration tuning"),
    ("Innovation and Technology Enablement", "Acceleration is via templates, automation, or accelerators (including AI assistants)"),
    ("Governance and Support", "Acceleration is via operating rhythm (steering, dashboards, SLAs, support processes)"),
    ("Capability Development", "Acceleration is via training/upskilling/knowledge transfer"),
    ("Partnership Leverage", "Acceleration comes when a partner's expertise/assets are the key lever"),
    ("Funding", "Acceleration n is due to securing or expediting funding, budget approvals, or financial resources"),
    ("Other", "Unclear or does not fit any other acceleration motion"),
)

# Label order used by the classifiers (closed label sets of the stages).
SLIPPAGE_LABELS = (
    "Technical", "Business", "Stakeholder", "Budget", "Project Timelines", "Data",
    "Integration", "Partner", "Hyperscaler", "Competition", "Other", "External dependencies",
)
ACCELERATION_LABELS = (
    "Implementation Planning", "Resource Allocation", "Stakeholder Engagement",
    "Technical Optimization", "Partnership Leverage", "Governance and Support",
    "Innovation and Technology Enablement", "Capability Development", "Funding", "Other",
)

# The eight assessment dimensions, in answer order, and their score weights in
# percent (the blocker dimension is deducted).
DIMENSIONS = (
    "Pain", "Champion", "ImplementationPlan", "DecisionProcess",
    "Urgency", "CompetitionAwareness", "MajorBlockers", "MeasurableImpact",
)
DIMENSION_WEIGHTS_PCT = {
    "Pain": 25, "Champion": 20, "ImplementationPlan": 20, "DecisionProcess": 10,
    "Urgency": 10, "CompetitionAwareness": 5, "MeasurableImpact": 2, "MajorBlockers": -8,
}

# Fallback texts of the original workflow that surface in stored results.
NO_CONTEXT = "No context or business impact provided."
NO_NAME_OR_DESCRIPTION = "No use case name or description provided"
NO_NEXT_STEPS = "No next steps provided"
NO_IMPLEMENTATION_PLAN = "There is no implementation plan or not specified in Salesforce"
ZERO_BLOCKERS = "There are 0 blockers"
NO_BLOCKER_DETAILS = "Blocker details not provided"
UNKNOWN_BUSINESS_LABEL = "Unknown Business Use Case"
NO_SOUNDBYTE = "No soundbyte generated"
OVERRIDE_RATIONALE = "The use case has too many blockers"
NOT_COMPUTED = "Not computed"
NOT_APPLICABLE = "N/A"
UNKNOWN_SLIPPAGE = "Unable to determine slippage category"
UNKNOWN_ACCELERATION = "Unable to determine acceleration category"
DEFAULT_ASSESSMENT = (
    "CONFIDENCE_SCORE: 0\nLEVEL: Low\nRATIONALE: No information provided.\n"
    "DIMENSION_SCORES: Pain=0, Champion=0, ImplementationPlan=0, DecisionProcess=0, "
    "Urgency=0, CompetitionAwareness=0, MajorBlockers=0, MeasurableImpact=0"
)
DEFAULT_ACTION = (
    "NEXT_BEST_ACTION: Review MEDDPICC evidence and address missing information.\n"
    "RATIONALE: No sufficient context or scores provided to generate a specific action."
)
FIELD_MANAGER_DEFAULT = "FLM not assigned"
ARCHITECT_DEFAULT = "SA not assigned"
SALES_MANAGER_DEFAULT = "Sales Manager not assigned"
REGION_DEFAULT = "No assigned"
VERTICAL_DEFAULT = "Not specified"


@dataclass(frozen=True)
class Settings:
    """Everything a run depends on; no hidden session variables.

    ``as_of`` replaces ``CURRENT_DATE()`` so every result is reproducible.
    """

    as_of: _dt.date = _dt.date(2001, 8, 2)
    default_watermark: _dt.date | None = None  # None -> as_of - 1 day
    min_value: float = 1000.0
    excluded_stages: tuple[str, ...] = EXCLUDED_STAGES
    months_ahead: int = 6
    months_back: int = -6
    stale_days: int = 14
    high_threshold: int = 75
    medium_threshold: int = 45
    blocker_override_above: int = 3
    override_score: int = 10
    email_domain: str = "example.com"
    cloud_keyword: str = "azure"
    cloud_slice_stages: tuple[str, ...] = ("U2", "U4", "U5")
    stale_kpi_stages: tuple[str, ...] = ("U3", "U5")
    inclusive_watermark: bool = False
    multiline_rationale: bool = False
    cut_notes_at: int = 2000
    cut_reason_at: int = 200
    enrich_partitions: int | None = None  # None -> spark.sql.shuffle.partitions
    urgency_input: bool = False  # the assessment also reads timeline_urgency (older full refresh)
    primary_model: str = "rule"
    confidence_model: str = "rule"
    business_label_model: str = "rule"
    prompt_version: str = "v1"
    quality_tier: str = "gold"
    weights_pct: dict = field(default_factory=lambda: dict(DIMENSION_WEIGHTS_PCT))

    @property
    def watermark_default(self) -> _dt.date:
        if self.default_watermark is not None:
            return self.default_watermark
        return self.as_of - _dt.timedelta(days=1)


DEFAULT = Settings()
