"""Interactions of professionals and organisations across sources, and their universe."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom import fixed_values as V
from contactloom.functions.engagement import audience_code, segment_priority, vendor_weight
from contactloom.functions.scalar import any_slot_equals, day_from_digits, first_token, present
from contactloom.operators.joins import left_lookup, renamed_apart
from contactloom.operators.pick import group_distinct
from contactloom.operators.reshape import union_conformed
from contactloom.plans.activity import activity_rows, look_up_mail, mail_events, unanswered_mails
from contactloom.sources.contracts import FLEX_COLUMNS, INTERACTION

Frames = Mapping[str, DataFrame]

PRODUCT_SLOTS = ["first_product", "second_product", "third_product", "fourth_product", "fifth_product"]


def covered_accounts(t: Frames) -> DataFrame:
    return t["account_ad_dim"].filter(F.upper("account_class").isin("HCP", "HCO"))


def field_reps(t: Frames) -> DataFrame:
    return t["crm_user"].filter(F.upper("country").isin("US", "UNITED STATES") & (F.col("isactive") > 0))


def _with_status(rows: DataFrame, t: Frames, key: str) -> DataFrame:
    return left_lookup(rows, covered_accounts(t), {key: "mk_account_vnt_id"},
                       {"is_active_flag": "account_status_name"}, how="inner")


# Columns of the activity that the digital interactions read.
_READ = """mdm_id product_name source_code source_channel_lvl2_name actual_tactic_code time_date activity_type session_id
    tactic_title tactic_document_name approvedfordistribution_date is_active activity_offer_description attribute_2_value
    destination_id_type destination_id_value""".split()
_OTHER_SOURCES = ("KNIPPER", "SFDC_US")


def digital_interactions(t: Frames, activity: DataFrame | None = None) -> DataFrame:
    """Grouped on more columns than are kept, so equal output rows may remain.

    Without a finished activity the rows come from the fact, whose scan leaves out the other sources."""
    if activity is None:
        activity = activity_rows(t, _READ, ~F.upper("source_cd").isin(*_OTHER_SOURCES))
    rows = activity.filter(~F.upper("source_code").isin(*_OTHER_SOURCES) & F.upper("product_name").isin(V.ALZ_BRANDS))
    rows = _with_status(rows, t, "mdm_id").withColumns({
        "website": F.when(F.upper("source_code") == "WEB_NEURO", F.upper(F.trim("attribute_2_value"))),
        "click_through_url": F.when(F.upper("destination_id_type") == "URL", F.col("destination_id_value"))})
    rows = group_distinct(rows, """mdm_id product_name source_code source_channel_lvl2_name actual_tactic_code
        time_date activity_type website click_through_url session_id tactic_title tactic_document_name
        approvedfordistribution_date is_active activity_offer_description is_active_flag""".split())
    kept = {c: c for c in "activity_type website click_through_url is_active_flag".split()}
    return renamed_apart(rows, {
        "hcp_id": "mdm_id", "marketing_vendor": "source_code", "channel_id": "source_channel_lvl2_name",
        "content_id": "actual_tactic_code", "offer_description": "activity_offer_description",
        "date_of_activity": "time_date", "send_id": "session_id", "title": "tactic_title",
        "document_name": "tactic_document_name",
        "approved_for_distribution_date": "approvedfordistribution_date", **kept,
    }).withColumn("product_name", F.lit(V.ALZ_PRODUCT))


def mail_interactions(t: Frames, mails: DataFrame, status: str, moment: str) -> DataFrame:
    rows = _with_status(mails.filter(F.upper("_product") == V.ALZ_PRODUCT), t, "_account")
    rows = rows.withColumn("date_of_activity", F.to_date(moment))
    rows = group_distinct(rows, ["_account", "_product", "_document", "date_of_activity", status, "is_active_flag"])
    return rows.select(F.col("_account").alias("hcp_id"), F.upper("_product").alias("product_name"),
                       F.lit("SFDC_US").alias("marketing_vendor"), F.lit("EMAIL").alias("channel_id"),
                       F.col("_document").alias("content_id"), "date_of_activity",
                       F.concat(F.lit("EMAIL "), F.trim(first_token(status))).alias("activity_type"),
                       "is_active_flag")


def product_calls(t: Frames) -> DataFrame:
    """Field calls of the covered teams that mention the product in any slot."""
    return t["field_call"].filter(any_slot_equals(PRODUCT_SLOTS, V.ALZ_PRODUCT)
                                  & F.upper("field_force_name").isin(V.FIELD_FORCES_CALLS))


def call_interactions(t: Frames) -> DataFrame:
    rows = product_calls(t).filter(F.col("call_start_date").isNotNull())
    rows = _with_status(rows, t, "mk_account_vnt_id")
    rows = left_lookup(rows, field_reps(t), {"employee_id": "mk_worker_bam_id"}, {"rep_id": "id"})
    rows = rows.select(F.col("mk_account_vnt_id").alias("hcp_id"),
                       F.to_date("call_start_date").alias("date_of_activity"),
                       F.col("call_type").alias("activity_type"), "rep_id", "is_active_flag").distinct()
    return rows.withColumns({"product_name": F.lit(V.ALZ_PRODUCT), "marketing_vendor": F.lit("VEEVA"),
                             "channel_id": F.lit("ACTUAL CALL")})


def program_interactions(t: Frames) -> DataFrame:
    """Attended professional programs, with status, subtype, role and type decoded by domain."""
    def domain(entity: str, kind: str) -> DataFrame:
        return t["reference_map"].filter((F.upper("src_entity") == entity) & (F.upper("src_entity_type") == kind))

    events = t["event"].filter(F.upper("product_code") == V.ALZ_PRODUCT)
    rows = left_lookup(t["attendee"].withColumn("content_id", F.col("event_id")), events,
                       {"event_id": "event_id"},
                       {c: c for c in ("product_code event_start_date_time event_type event_sub_type_code "
                                       "event_format_code event_status_code").split()}, how="inner")
    rows = _with_status(rows, t, "mk_account_vnt_id")
    for entity, kind, on, out, how in (
            ("MFR_MF_EVENT_ATTENDEE", "ATTENDEE_STATUS", "attendee_status", "_attended", "inner"),
            ("MFR_MF_EVENT", "EVENT_STATUS", "event_status_code", "_status", "inner"),
            ("MFR_MF_EVENT", "EVENT_SUB_TYPE", "event_sub_type_code", "_subtype", "inner"),
            ("MFR_MF_EVENT_ATTENDEE", "ATTENDEE_ROLE", "attendee_role", "_role", "left"),
            ("MFR_MF_EVENT", "EVENT_TYPE", "event_type", "_type", "left")):
        rows = left_lookup(rows, domain(entity, kind), {on: "src_value"}, {out: "trgt_value"}, how)
    rows = rows.filter((F.upper("_attended") == "ATTENDED") & (F.upper("_subtype") == "HCP PROGRAM")
                       & F.upper("_status").isin("OCCURED", "CLOSED"))
    rows = rows.withColumn("date_of_activity", day_from_digits("event_start_date_time"))
    rows = group_distinct(rows, ["mk_account_vnt_id", "product_code", "source_name", "_subtype", "content_id",
                                 "date_of_activity", "_role", "attendee_role", "_type", "event_type",
                                 "is_active_flag"])
    return rows.select(F.col("mk_account_vnt_id").alias("hcp_id"), F.upper("product_code").alias("product_name"),
                       F.col("source_name").alias("marketing_vendor"), F.col("_subtype").alias("channel_id"),
                       "content_id", "date_of_activity",
                       F.coalesce("_role", "attendee_role").alias("activity_type"),
                       F.coalesce("_type", "event_type").alias("event_type"), "is_active_flag")


def interactions(t: Frames, activity: DataFrame | None = None) -> DataFrame:
    answered = look_up_mail(t, mail_events(t, how="inner"), required=True)
    events = t["crm_email_activity"].filter(F.col("activity_datetime_vod__c").isNotNull())
    return union_conformed(
        digital_interactions(t, activity),
        mail_interactions(t, answered, "event_type_vod__c", "activity_datetime_vod__c"),
        mail_interactions(t, unanswered_mails(t, events), "status_vod__c", "email_sent_date_vod__c"),
        call_interactions(t), program_interactions(t), contract=INTERACTION)


def audience(contacts: DataFrame) -> DataFrame:
    """Audience code per customer.  One row per vendor is what the sum needs, so distinct vendors
    stand in for the newest row of each."""
    vendors = contacts.select("hcp_id", "marketing_vendor").distinct()
    return (vendors.groupBy("hcp_id").agg(F.sum(vendor_weight("marketing_vendor")).alias("_w"))
            .select("hcp_id", audience_code("_w").alias("customer_target")))


def universe(t: Frames, contacts: DataFrame, target_list: DataFrame) -> DataFrame:
    accounts = t["account_ad_dim"].filter(present("mk_account_vnt_id"))
    hcp = t["hcp"].filter((F.upper("record_state__v") == "VALID") & (F.upper("hcp_status__v") == "A"))
    rows = left_lookup(accounts, hcp, {"mk_account_vnt_id": "mk_account_vnt_id"},
                       {"_first": "first_name__v", "_last": "last_name__v", "gender": "gender__v",
                        "date_of_birth": "birth_date__v"})
    rows = left_lookup(rows, target_list, {"mk_account_vnt_id": "vnid"},
                       {"attitudinal_segment": "segment", "decile": "composite_decile"})
    rows = left_lookup(rows, audience(contacts), {"mk_account_vnt_id": "hcp_id"},
                       {"customer_target": "customer_target"})
    names = {"customer_id": "mk_account_vnt_id", "customer_type": "account_class",
             "primary_specialty": "primary_specialty_name", "secondary_specialty": "secondary_specialty_name",
             "address_1": "address_line_1__v", "address_2": "address_line_2__v", "state": "state_cd",
             "country": "country__v", "zip_code": "postal_code",
             "account_readiness_flag": "willingness_capability_flag", "pdrp_opt_out_flag": "pdrp_optout",
             "hcp_segment": "biib_group__c", "customer_email": "email_1", "is_active_flag": "account_status_name"}
    return rows.select(
        *[F.col(old).alias(new) for new, old in names.items()],
        F.coalesce("_first", "account_name").alias("customer_first_name"),
        F.coalesce("_last", "account_name").alias("customer_last_name"), "gender", "date_of_birth", "city",
        "attitudinal_segment", "decile", segment_priority("attitudinal_segment").alias("segment_category"),
        "customer_target", *[F.lit(None).cast("string").alias(c) for c in FLEX_COLUMNS])
