"""Values that the oracles state on their own: column lists, keyword lists, texts and dates.  Nothing here is taken
from the operators that the oracles check."""

import datetime as dt

WATERMARK = dt.date(2001, 2, 15)
CUT_DATE = dt.date(2001, 6, 1)
SYNC_DATE = dt.date(2001, 4, 1)
RUN_CUTS = (dt.date(2001, 5, 1), dt.date(2001, 6, 15), None)
ANSWER_DIMENSION_FACTORS = (1, 3, 5, 7, 2, 4, 6, 8)
TEMPLATE = 'Account {account}: {one_liner} Type: {usecase_type}. Stage {stage}.'

EXTRACT_COLUMNS = tuple("""
    usecase_id last_modified_date account_name sdr_bdr_notes business_impact business_outcome_description
    ae_authority ae_money_budget usecase_name usecase_description demand_plan_stage_next_steps
    implementation_notes num_of_blockers last_modified_blocker_category last_modified_blocker_comment
    competition_string industry_imperative
""".split())
SCORE_COLUMNS = tuple("""
    pain_score champion_score implementationplan_score decisionprocess_score urgency_score
    competitionawareness_score majorblockers_score measurableimpact_score
""".split())
ENRICHED_COLUMNS = tuple("""
    usecase_id last_modified_date processed_date competition_string num_of_blockers context one_liner
    next_steps_summary implementation_notes_summary blockers_summary usecase_type business_usecase_type
    soundbyte ai_confidence_score_advanced confidence_score confidence_level rationale_for_confidence_score
    pain_score champion_score implementationplan_score decisionprocess_score urgency_score
    competitionawareness_score majorblockers_score measurableimpact_score confidence_level_normalized
    next_best_action_recommendation likely_to_slip slippage_category can_be_accelerated accel_category
""".split())
REPORTING_COLUMNS = tuple("""
    snapshot_date field_manager account_name usecase_id usecase_name last_modified_date account_executive
    account_solution_architect stage target_cloud primary_competitor target_live_date target_onboarding_date
    estimated_monthly_value usecase_description demand_plan_stage_next_steps implementation_notes sales_region
    sales_subregion_level_1 sales_subregion_level_2 sales_subregion_level_3 sales_subregion_level_4
    sales_manager sales_leader field_leader use_case_product blockers_last_modified_date sdr_bdr_notes
    business_impact business_outcome_description ae_authority ae_money_budget business_unit num_of_blockers
    last_modified_blocker_category last_modified_blocker_comment competition_string context one_liner
    next_steps_summary implementation_notes_summary blockers_summary usecase_type business_usecase_type
    soundbyte is_stale ai_confidence_score_advanced confidence_score confidence_level
    rationale_for_confidence_score pain_score champion_score implementationplan_score decisionprocess_score
    urgency_score competitionawareness_score majorblockers_score measurableimpact_score
    confidence_level_normalized next_best_action_recommendation likely_to_slip slippage_category
    can_be_accelerated accel_category vertical
""".split())
RADAR_COLUMNS = tuple("""
    snapshot_date field_manager account_name usecase_id usecase_name last_modified_date account_executive
    account_solution_architect stage target_cloud primary_competitor target_live_date target_onboarding_date
    estimated_monthly_value usecase_description demand_plan_stage_next_steps implementation_notes sales_region
    sales_subregion_level_1 sales_subregion_level_2 sales_subregion_level_3 sales_subregion_level_4
    sales_manager sales_leader field_leader use_case_product blockers_last_modified_date sdr_bdr_notes
    business_impact business_outcome_description ae_authority ae_money_budget business_unit num_of_blockers
    last_modified_blocker_category last_modified_blocker_comment competition_string context one_liner
    next_steps_summary implementation_notes_summary blockers_summary usecase_type business_usecase_type is_stale
    ai_confidence_score_advanced confidence_score confidence_level rationale_for_confidence_score pain_score
    champion_score implementationplan_score decisionprocess_score urgency_score competitionawareness_score
    majorblockers_score measurableimpact_score confidence_level_normalized next_best_action_recommendation
    likely_to_slip slippage_category can_be_accelerated accel_category vertical
""".split())
#: Columns of the reporting views that come from the target, the others come from the source.
FROM_TARGET = tuple("""
    usecase_id num_of_blockers context one_liner next_steps_summary implementation_notes_summary
    blockers_summary usecase_type business_usecase_type soundbyte ai_confidence_score_advanced confidence_score
    confidence_level rationale_for_confidence_score pain_score champion_score implementationplan_score
    decisionprocess_score urgency_score competitionawareness_score majorblockers_score measurableimpact_score
    confidence_level_normalized next_best_action_recommendation likely_to_slip slippage_category
    can_be_accelerated accel_category
""".split())
SLOT_COLUMNS = tuple("""
    top1_usecase_type top1_usecase_type_count top1_usecase_type_monthly_value top2_usecase_type
    top2_usecase_type_count top2_usecase_type_monthly_value top3_usecase_type top3_usecase_type_count
    top3_usecase_type_monthly_value top1_slippage_category top1_slip_usecase_count
    top1_slippage_category_description top2_slippage_category top2_slip_usecase_count
    top2_slippage_category_description top3_slippage_category top3_slip_usecase_count
    top3_slippage_category_description top1_accel_category top1_accel_usecase_count
    top1_accel_category_description top2_accel_category top2_accel_usecase_count top2_accel_category_description
    top3_accel_category top3_accel_usecase_count top3_accel_category_description top1_vertical
    top1_vertical_usecase_count top2_vertical top2_vertical_usecase_count top3_vertical
    top3_vertical_usecase_count
""".split())
USECASE_KEYWORDS = {
    'Machine Learning': 'model prediction predictive forecast forecasting churn scoring'.split(),
    'Generative AI': 'genai llm chatbot assistant generative agent rag'.split(),
    'Data Warehousing': 'warehouse warehousing dwh sql olap mart'.split(),
    'Migration AI': 'migration migrate ml ai'.split(),
    'Migration Unity Catalog': 'migration migrate catalog permissions'.split(),
    'Migration DWH': 'migration migrate warehouse dwh'.split(),
    'Migration ETL': 'migration migrate etl pipelines'.split(),
    'Migration Streaming': 'migration migrate streaming kafka'.split(),
    'Migration BI': 'migration migrate bi dashboards'.split(),
    'BI': 'bi dashboard dashboards reporting report reports'.split(),
    'ETL': 'etl pipeline pipelines transform transformation'.split(),
    'Governance': 'governance lineage audit compliance access'.split(),
    'Streaming': 'streaming stream realtime kafka events'.split(),
    'Ingestion': 'ingestion ingest connector cdc load'.split(),
    'Platform': 'platform infrastructure workspace cluster compute'.split(),
    'Other': ''.split(),
}
SLIPPAGE_KEYWORDS = {
    'Technical': 'technical bug feature defect performance'.split(),
    'Business': 'priority priorities value business'.split(),
    'Stakeholder': 'sponsor champion stakeholder stakeholders'.split(),
    'Budget': 'budget funding approval spend'.split(),
    'Project Timelines': 'timeline milestone milestones deadline schedule'.split(),
    'Data': 'data quality access'.split(),
    'Integration': 'integration connectivity api tooling'.split(),
    'Partner': 'partner si consultancy'.split(),
    'Hyperscaler': 'quota region hyperscaler'.split(),
    'Competition': 'competitor competition rival'.split(),
    'Other': ''.split(),
    'External dependencies': 'external vendor dependency dependencies'.split(),
}
ACCELERATION_KEYWORDS = {
    'Implementation Planning': 'plan owners milestones implementation'.split(),
    'Resource Allocation': 'resources staff capacity compute'.split(),
    'Stakeholder Engagement': 'sponsor decision makers alignment cadence'.split(),
    'Technical Optimization': 'blocker blockers fix tuning architecture'.split(),
    'Partnership Leverage': 'partner partners'.split(),
    'Governance and Support': 'steering sla support governance'.split(),
    'Innovation and Technology Enablement': 'template templates automation accelerator'.split(),
    'Capability Development': 'training upskilling enablement'.split(),
    'Funding': 'budget funding approval'.split(),
    'Other': ''.split(),
}
ACTIONS = {'foundations': 'Schedule a sponsor workshop this week to confirm the business pain, name the champion and agree '
                'an implementation plan with owners and milestones.',
 'blockers': 'Run a technical blocker review with the data and integration owners and agree a fix date for each '
             'blocker.',
 'urgent': 'Lock the go-live timeline with the decision makers and secure the budget approval before the deadline.',
 'steady': 'Keep the weekly cadence, track consumption against the success metrics and plan the next workload with '
           'the partner team.'}
TIMELINE_URGENCY = {'High': 9, 'Medium': 6, 'Low': 3}
