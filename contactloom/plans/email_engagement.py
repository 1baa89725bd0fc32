"""E-mail engagement: deduplicated base and the funnel at three grains."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom.functions.engagement import base_tactic
from contactloom.functions.identity import contact_as_patient, resolve_identity, resolve_identity_by_type
from contactloom.functions.scalar import as_date, month_start, week_start
from contactloom.operators.aggregates import delivered, email_funnel, rollup_grains
from contactloom.operators.joins import left_lookup
from contactloom.operators.pick import first_touch
from contactloom.operators.sequence import repeat_flags
from contactloom.plans.activity import activity_rows, since

Frames = Mapping[str, DataFrame]

# Column names of the result (fixed values).
_SEGMENTS = ["ms_digital_segment", "sma_digital_segment", "alz_digital_segment"]
_PASSED = """activity_offer_description product_name therapeutic_area activity_type month_date
    week_begin_date time_date identified_flag party_class party_subtype resend_flag actual_tactic_code
    base_tactic activity_em_number activity_em_number_with_ab_split destination_id_type
    destination_id_value unsubcribe_clicks_flag firewall_click_flag is_active geo_region_code""".split()

# Columns of the activity that the base reads.
_READ = [*(c for c in _PASSED if c not in ("month_date", "week_begin_date", "base_tactic")), *"""mdm_id activity_subchannel source_code
    customer_type tactic_code alignment_string date_timestamp integration_key orig_tactic_code_of_resends
    activity_em_category activity_em_stream activity_sub_stream""".split()]
MAIL_FROM = "2019-01-01"


def web_lead_source(t: Frames, customer: Column) -> DataFrame:
    """Site of each customer's first web registration, under the key the caller joins on."""
    visits = t["marketing_fact"].filter((F.upper("source_cd") == "WEB_NEURO")
                                        & (F.upper("activity_type_name") == "WEB REG"))
    rows = visits.select(customer.alias("mdm_id"), "source_cd", "activity_type_name", "activity_time",
                         "integration_key", F.col("attribute_2_value").alias("web_lead_source"))
    return first_touch(rows, ["mdm_id", "source_cd", "activity_type_name"], "activity_time",
                       "integration_key").select("mdm_id", "web_lead_source")


def by_type_key() -> Column:
    return resolve_identity_by_type("mk_account_vnt_id", "mk_patient_gne_id", "customer_identity_value",
                                    "customer_type")


def plain_key() -> Column:
    return resolve_identity("mk_account_vnt_id", "mk_patient_gne_id", "customer_identity_value", prefix=False)


def mail_activity(t: Frames) -> DataFrame:
    """Mail activity since MAIL_FROM straight from the fact: its source and time are filters of the scan, and no lookup is
    made but those that its columns stand on."""
    days = month_start("activity_time") >= as_date(MAIL_FROM)
    return activity_rows(t, _READ, (F.upper("source_cd") == "SFMC") & days & (F.col("activity_time") >= as_date(MAIL_FROM)))


def email_base(t: Frames, ranking: DataFrame, activity: DataFrame | None = None) -> DataFrame:
    """Mail activity with first-touch and segment columns, and repeat flags at three grains.

    The activity may be given, as a product with monthly partitions or not; else it is taken from the fact."""
    mail = since(mail_activity(t) if activity is None else activity, MAIL_FROM)
    mail = mail.filter((F.upper("activity_subchannel") == "EMAIL") & (F.upper("source_code") == "SFMC")
                       & F.upper("customer_type").isin("PATIENT", "HCP", "CONTACT"))
    mail = mail.withColumns({"month_date": month_start("time_date"), "week_begin_date": week_start("time_date"),
                             "base_tactic": base_tactic("actual_tactic_code", F.upper("tactic_code"))})
    mail = left_lookup(mail, ranking, {"mdm_id": "mdm_id"}, {c: c for c in _SEGMENTS})
    mail = left_lookup(mail, web_lead_source(t, by_type_key()), {"alignment_string": "mdm_id"},
                       {"web_lead_source": "web_lead_source"})
    mail = left_lookup(mail, t["party_first_source"], {"alignment_string": "mdm_id"},
                       {"lead_source": "lead_source"})
    flags = {"monthly_duplicate_flag": ["month_date"], "weekly_duplicate_flag": ["week_begin_date"],
             "overall_duplicate_flag": []}
    rest = [c for name in ("integration_key", "web_lead_source", "lead_source") for c in (F.col(name).isNull(), F.col(name))]
    mail = repeat_flags(mail, ["mdm_id", "activity_type", "base_tactic"], flags,
                        [F.col("time_date"), F.col("date_timestamp"), *rest])
    mapped = {out: F.coalesce(F.upper(c), F.lit("UNMAPPED")) for out, c in
              (("tactic_category", "activity_em_category"), ("tactic_stream", "activity_em_stream"),
               ("tactic_sub_stream", "activity_sub_stream"))}
    return mail.select(
        F.col("alignment_string").alias("mdm_id"), F.col("orig_tactic_code_of_resends").alias("tactic_code"),
        F.col("source_code").alias("activity_source"), contact_as_patient("customer_type").alias("customer_type"),
        *_PASSED, "lead_source", "web_lead_source", *_SEGMENTS,
        *[F.col(f).cast("int").alias(f) for f in flags], *[c.alias(n) for n, c in mapped.items()])


# Grouping columns of the funnel (fixed values).
_FUNNEL_KEYS = """therapeutic_area product_name base_tactic actual_tactic_code identified_flag party_class
    customer_type party_subtype tactic_category tactic_stream tactic_sub_stream activity_source
    activity_offer_description activity_em_number activity_em_number_with_ab_split lead_source
    web_lead_source is_active geo_region_code ms_digital_segment sma_digital_segment
    alz_digital_segment""".split()


def email_engagement(base: DataFrame) -> DataFrame:
    """Sends, opens, clicks, bounces and deliveries by day, month and week."""
    counted = base.filter((F.upper("unsubcribe_clicks_flag") == "N") & (F.upper("firewall_click_flag") == "N"))
    grains = [("Overall_Level", "time_date", "overall_duplicate_flag"),
              ("Monthly_Level", "month_date", "monthly_duplicate_flag"),
              ("Weekly_Level", "week_begin_date", "weekly_duplicate_flag")]
    rows = rollup_grains(counted, _FUNNEL_KEYS, grains, email_funnel("activity_type", "mdm_id"),
                         "aggregate_date", "kpi_level")
    return rows.withColumn("total_delivered", delivered())
