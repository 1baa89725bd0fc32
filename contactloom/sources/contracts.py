"""Column contracts.  Names and order are fixed values that consumers rely on."""

from __future__ import annotations

from pyspark.sql import types as T


def _of(kind: T.DataType, names: str) -> T.StructType:
    return T.StructType([T.StructField(n, kind, True) for n in names.split()])


TARGET_LIST = _of(T.StringType(), """
    id provider_id npi name address city state zip specialty neuros pcps granular_specialty segment
    biib_group group_a group_b group_c initiator_treator initiator_count treator_count
    total_initiations symptomatic_trx patient_volume composite_decile kme_hcp_flag kme_count
    tbm_territory_id tbm_territory tbm_region_id tbm_region tbm_zone_id tbm_zone aal_territory_id
    aal_territory aal_region_id aal_region adrm_territory_id adrm_territory adrm_region_id
    adrm_region account parent_id tier soc""")

_NOT_TEXT = {"activity_date": T.DateType(), "timestamp": T.TimestampType(),
             "activity_seq_number": T.LongType(), "bounce_flag": T.IntegerType(),
             "metric_type_null_flag": T.IntegerType()}

COMBINED = T.StructType([T.StructField(n, _NOT_TEXT.get(n, T.StringType()), True) for n in """
    record_id activity_seq_number alignment_string activity_date timestamp product_id product_name
    activity_class source_type activity_source activity_source_channel activity_channel
    activity_subchannel tactic_type tactic_title tactic_code tactic_code_desc hcp_tactic_type
    siteorigin identified_flag sales_force_target_flag deep_engagement_flag light_engagement_flag
    contacted_flag cae_flag engagement_type light_deep_engagement_flag therapeutic_area
    firewall_click_flag activity_em_stream activity_em_category activity_sub_stream
    activity_em_number activity_em_number_with_ab_split activity_type activity_offer_code
    activity_offer_description new_desc attendee_role party_class party_subtype customer_type
    bounce_flag monthly_resends_exclude_flag overall_resends_exclude_flag destination_id_value
    unsubcribe_clicks_flag metric_type metric_type_null_flag is_active geo_region_code""".split()])

INTERACTION = T.StructType([T.StructField(n, T.DateType() if n.endswith("_activity") or
                                          n.endswith("_distribution_date") else T.StringType(), True)
                            for n in """
    hcp_id product_name marketing_vendor channel_id content_id offer_description website
    date_of_activity activity_type event_type click_through_url send_id rep_id title document_name
    approved_for_distribution_date is_active_flag""".split()])

FLEX_COLUMNS = [f"attribute_{part}_{i}" for i in range(1, 6) for part in ("name", "value")]


def _contract(names: str, **kinds: T.DataType) -> T.StructType:
    """Columns in order; text where ``kinds`` names no other type."""
    return T.StructType([T.StructField(n, kinds.get(n, T.StringType()), True) for n in names.split()])


UNIVERSE = _contract("""
    customer_id customer_first_name customer_last_name customer_type gender date_of_birth
    primary_specialty secondary_specialty address_1 address_2 city state country zip_code
    account_readiness_flag pdrp_opt_out_flag attitudinal_segment decile hcp_segment segment_category
    customer_email is_active_flag customer_target """ + " ".join(FLEX_COLUMNS), date_of_birth=T.DateType())

TARGETED = _contract("""
    hcp target_group ad_primary_account health_system insight_started all_key_questions_answered
    patient_volume insights_complete_key_questions target_status hcp_type primary_specialty
    initiator_treator total_initiations symptomatic_trx composite_decile kme ama_do_not_contact
    tbm_territory vnid npi_number segment address city aal state zip adrm tbm email_1 email_2""")

METRIC = _contract("customer_id product_name time_bucket_date metric_id metric_name metric_value",
                   time_bucket_date=T.DateType(), metric_value=T.DoubleType())

REP_METRIC = _contract("customer_id product_name rep_id metric_id metric_name metric_value", metric_value=T.DateType())

_REPEATS = ("monthly_duplicate_flag", "weekly_duplicate_flag", "overall_duplicate_flag")
_DAYS = ("month_date", "week_begin_date", "time_date")
EMAIL_BASE = _contract("""
    mdm_id tactic_code activity_offer_description activity_source product_name therapeutic_area
    activity_type month_date week_begin_date time_date identified_flag customer_type party_class
    party_subtype resend_flag actual_tactic_code lead_source web_lead_source base_tactic
    monthly_duplicate_flag weekly_duplicate_flag overall_duplicate_flag tactic_category tactic_stream
    tactic_sub_stream activity_em_number activity_em_number_with_ab_split destination_id_type
    destination_id_value unsubcribe_clicks_flag firewall_click_flag is_active geo_region_code
    ms_digital_segment sma_digital_segment alz_digital_segment""",
    **dict.fromkeys(_REPEATS, T.IntegerType()), **dict.fromkeys(_DAYS, T.DateType()))

_TOTALS = ("total_sends", "total_opens", "total_clicks", "total_bounces", "total_delivered")
EMAIL_FUNNEL = _contract("""
    therapeutic_area product_name base_tactic actual_tactic_code aggregate_date identified_flag
    party_class customer_type party_subtype tactic_category tactic_stream tactic_sub_stream
    activity_source activity_offer_description activity_em_number activity_em_number_with_ab_split
    lead_source web_lead_source is_active geo_region_code ms_digital_segment sma_digital_segment
    alz_digital_segment total_sends total_opens total_clicks total_bounces total_delivered kpi_level""",
    **dict.fromkeys(_TOTALS, T.LongType()), aggregate_date=T.DateType())
