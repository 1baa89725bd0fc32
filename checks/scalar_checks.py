"""Scalar functions, one query per function family, each over a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from checks.registry import AS_OF, Check
from checks.standins import pick, quote
from checks.suppression_checks import BAND, SEGMENT, STAGE, bad_mail, blocked, cause_sql
from checks.activity_checks import _AREA, cut, party_class
from contactloom import fixed_values as V
from contactloom.functions import engagement as E
from contactloom.functions import identity as I
from contactloom.functions import scalar as S
from contactloom.functions.email import blocked_domain, invalid_email
from contactloom.operators import joins as J
from contactloom.operators import suppression as sup
from contactloom.operators.aggregates import delivered, metric_rows
from contactloom.plans import affiliation as aff
from contactloom.plans import interactions as inter


def over(table: str, keys: str, columns: dict[str, tuple[Callable[[], Column], str]], ints: str = "", texts: str = "", doubles: str = "") -> Check:
    """Keys plus computed columns, as Spark expressions and as SQL expressions."""
    sql = ", ".join([*keys.split(), *[f"{text} AS {name}" for name, (_, text) in columns.items()]])
    return Check(lambda t: t[table].select(*keys.split(), *[make().alias(n) for n, (make, _) in columns.items()]),
                 f"SELECT {sql} FROM {table}", ints, texts, doubles)


C = F.col

BASICS = {
    "case_expressions": over("customer", "c_custkey", {
        "band": (lambda: F.when(C("c_acctbal") < 0, "debt").when(C("c_acctbal") < 1000, "low").otherwise("high"),
                 "CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 1000 THEN 'low' ELSE 'high' END"),
        "letter": (lambda: S.label_code(C("c_mktsegment"), {"BUILDING": "B", "MACHINERY": "M"}),
                   "CASE c_mktsegment WHEN 'BUILDING' THEN 'B' WHEN 'MACHINERY' THEN 'M' END")}),
    "coalesce_chain": over("first_source", "party_fk", {
        "lead": (lambda: F.coalesce(C("true_source"), C("source_name"), F.lit("none")), "coalesce(true_source, source_name, 'none')")}),
    "concatenation": over("first_source", "party_fk", {
        "strict": (lambda: S.glue("true_source", F.lit("/"), "source_name"), "true_source || '/' || source_name"),
        "lenient": (lambda: S.glue("true_source", F.lit("/"), "source_name", null_as_empty=True), "concat(true_source, '/', source_name)")}),
    "case_and_trim": over("marketing_fact", "integration_key", {
        "up": (lambda: F.upper("activity_type_name"), "upper(activity_type_name)"),
        "both": (lambda: F.trim("channel_level_2_name"), "trim(channel_level_2_name)"),
        "left_only": (lambda: F.ltrim("channel_level_2_name"), "ltrim(channel_level_2_name)"),
        "right_only": (lambda: F.rtrim("channel_level_2_name"), "rtrim(channel_level_2_name)"),
        "folded": (lambda: S.folded("activity_type_name"), "upper(trim(activity_type_name))")}),
    "substring_prefix": over("customer", "c_custkey", {"head": (lambda: F.substring("c_name", 1, 11), "left(c_name, 11)")}),
    "text_tail": over("sma_hcp_hco_raw", "mdm_id", {
        "last": (lambda: S.tail("mdm_id", 18), "right(mdm_id, 18)"),
        "whole": (lambda: S.tail("mdm_id", 18, whole_only=True), "CASE WHEN length(mdm_id) >= 18 THEN right(mdm_id, 18) END")}),
    "text_before_comma": over("documents", "doc_id", {
        "head": (lambda: S.before_comma("text"), "CASE WHEN strpos(text, ',') > 1 THEN split_part(text, ',', 1) ELSE text END")}),
    "text_positions": over("crm_sent_email", "id", {
        "bar": (lambda: F.instr("product_display_vod__c", "|"), "strpos(product_display_vod__c, '|')"),
        "after": (lambda: S.after_bar("product_display_vod__c"), "substr(product_display_vod__c, strpos(product_display_vod__c, '|') + 1)")}, doubles="bar"),
    "text_length": over("pages", "page_id", {"n": (lambda: F.length("url"), "length(url)")}, "n"),
    "replace_and_reverse": over("part", "p_partkey", {
        "flat": (lambda: F.replace("p_name", F.lit(" "), F.lit("")), "replace(p_name, ' ', '')"), "back": (lambda: F.reverse("p_name"), "reverse(p_name)")}),
    "first_token": over("crm_sent_email", "id", {
        "word": (lambda: S.first_token("status_vod__c"), "regexp_extract(status_vod__c, '[^_]+')")}),
    "to_date_and_truncate": over("events", "event_id", {
        "d": (lambda: F.to_date("ts"), "CAST(ts AS DATE)"), "s": (lambda: S.to_second("ts"), "date_trunc('second', ts)"),
        "back": (lambda: F.to_date(F.date_format("ts", "MM/dd/yyyy"), "MM/dd/yyyy"), "CAST(strptime(strftime(ts, '%m/%d/%Y'), '%m/%d/%Y') AS DATE)")},
        "", "d s back"),
    "date_from_digits": over("event", "event_id", {
        "d": (lambda: S.day_from_digits("event_start_date_time"), "CAST(strptime(left(event_start_date_time, 8), '%Y%m%d') AS DATE)")}, "", "d"),
    "date_to_text": over("marketing_fact", "integration_key", {
        "clock": (lambda: F.date_format("activity_time", "HH:mm:ss"), "strftime(activity_time, '%H:%M:%S')"),
        "number": (lambda: S.day_number("activity_time"), "CAST(strftime(activity_time, '%Y%m%d') AS BIGINT)"),
        "spent": (lambda: C("time_spent").cast("string"), "CAST(time_spent AS VARCHAR)")}),
    "text_to_number": over("nba_hcp", "email", {
        "n": (lambda: S.whole_number("prof_sk"), "TRY_CAST(prof_sk AS BIGINT)"), "bad": (lambda: S.whole_number("email"), "TRY_CAST(email AS BIGINT)")}, doubles="bad"),
    "date_truncation": over("orders", "o_orderkey", {
        "month": (lambda: S.month_start("o_orderdate"), "CAST(date_trunc('month', o_orderdate) AS DATE)"),
        "week": (lambda: S.week_start("o_orderdate"), "CAST(date_trunc('week', o_orderdate) AS DATE)"),
        "quarter": (lambda: S.quarter_start("o_orderdate"), "CAST(date_trunc('quarter', o_orderdate) AS DATE)")}, "", "month week quarter"),
    "date_arithmetic": over("orders", "o_orderkey", {
        "yesterday": (lambda: F.date_sub(F.to_date("o_orderdate"), 1), "CAST(o_orderdate - INTERVAL 1 DAY AS DATE)"),
        "year_ago": (lambda: F.add_months(S.month_start("o_orderdate"), -12), "CAST(date_trunc('month', o_orderdate) - INTERVAL 12 MONTH AS DATE)"),
        "last_quarter": (lambda: F.add_months(S.quarter_start("o_orderdate"), -3), "CAST(date_trunc('quarter', o_orderdate) - INTERVAL 3 MONTH AS DATE)")},
        "", "yesterday year_ago last_quarter"),
    "friday_bucket": over("lineitem", "l_orderkey l_partkey", {
        "friday": (lambda: S.friday_of_week("l_shipdate"), "CAST(l_shipdate - CAST(isodow(l_shipdate) AS INTEGER) * INTERVAL 1 DAY + INTERVAL 5 DAY AS DATE)")},
        "", "friday"),
    "age_in_years": over("party_patient", "party_fk", {
        "age": (lambda: S.age_years("birth_dt", AS_OF), f"CAST(floor(date_diff('day', birth_dt, DATE '{AS_OF}') / 365.2425) AS BIGINT)")}, doubles="age"),
    "rounding": over("shipment", "account_1", {"n": (lambda: F.round("kpi_numerator"), "round(kpi_numerator)")}),
    "attribute_slot_lookup": over("marketing_fact", "integration_key", {
        "campaign": (lambda: S.slot_lookup("CAMPAIGN", [(f"attribute_{i}_name", f"attribute_{i}_value") for i in range(1, 26)]),
                     "CASE " + " ".join(f"WHEN upper(attribute_{i}_name) = 'CAMPAIGN' THEN attribute_{i}_value" for i in range(1, 26)) + " ELSE 'UNKNOWN' END")}),
    "never_date": over("party_merge_map", "survivor_party_fk", {
        "until": (lambda: sup.cause_date("src_merge_dt", C("record_state_cd_fk") != 10),
                  "CASE WHEN record_state_cd_fk = 10 THEN src_merge_dt ELSE TIMESTAMP '9999-12-31 00:00:00' END")}, "", "until"),
}

_IDS = ("mk_account_vnt_id", "mk_patient_gne_id", "customer_identity_value")
_UNKNOWN = "mk_account_vnt_id = '-1' AND mk_patient_gne_id = '-1'"

BUSINESS = {
    "identity_resolution": over("marketing_fact", "integration_key", {
        "prefixed": (lambda: I.resolve_identity(*_IDS), f"CASE WHEN {_UNKNOWN} THEN customer_identity_value WHEN mk_patient_gne_id = '-1' "
                     "THEN 'VNID' || mk_account_vnt_id ELSE 'LH' || mk_patient_gne_id END"),
        "bare": (lambda: I.resolve_identity(*_IDS, prefix=False), f"CASE WHEN {_UNKNOWN} THEN customer_identity_value WHEN mk_patient_gne_id = '-1' "
                 "THEN mk_account_vnt_id ELSE mk_patient_gne_id END"),
        "by_type": (lambda: I.resolve_identity_by_type(*_IDS, "customer_type"), f"CASE WHEN {_UNKNOWN} THEN customer_identity_value "
                    "WHEN upper(customer_type) = 'HCP' THEN 'VNID' || mk_account_vnt_id ELSE 'LH' || mk_patient_gne_id END")}),
    "identified_flag": over("marketing_fact", "integration_key", {
        "known": (lambda: I.identified_flag(*_IDS[:2]), f"CASE WHEN {_UNKNOWN} THEN 'N' ELSE 'Y' END")}),
    "known_attendee": over("attendee", "event_id", {
        "known": (lambda: I.known_customer("mdm_id"), "CASE WHEN coalesce(mdm_id, 'NA') = 'NA' THEN 'N' ELSE 'Y' END"),
        "key": (lambda: I.long_key("mdm_id"), "CASE WHEN length(mdm_id) >= 17 THEN 'VNID' || mdm_id ELSE mdm_id END")}),
    "party_class_normalisation": over("patient_dim", "mk_patient_gne_id", {
        "class": (lambda: I.normalize_class("patient_class"), party_class("patient_class"))}),
    "email_validity": over("party_communication", "integration_key", {
        "bad": (lambda: invalid_email("comm_value"), bad_mail("comm_value"))}, "bad"),
    "blocked_domain": over("party_communication", "integration_key", {
        "blocked": (lambda: blocked_domain("comm_value"), blocked("comm_value"))}, doubles="blocked"),
    "tactic_parsing": over("marketing_fact", "integration_key", {
        "code": (lambda: E.tactic_code("source_cd", "tactic_cd"), cut("tactic_cd", "y", V.TACTIC_CAMPAIGN, V.TACTIC_HOUSE)),
        "original": (lambda: E.original_tactic("source_cd", "tactic_cd"), cut("tactic_cd", "y", V.TACTIC_CAMPAIGN_RESEND, V.TACTIC_HOUSE_RESEND)),
        "resend": (lambda: E.resend_flag("source_cd", "tactic_cd"),
                   f"CASE WHEN upper(source_cd) = 'SFMC' AND (upper(tactic_cd) LIKE {quote(V.TACTIC_CAMPAIGN_RESEND)} ESCAPE '!' "
                   f"OR upper(tactic_cd) LIKE {quote(V.TACTIC_HOUSE_RESEND)} ESCAPE '!') THEN 'Y' ELSE 'N' END"),
        "base": (lambda: E.base_tactic("tactic_cd"), f"left(tactic_cd, CASE WHEN tactic_cd LIKE {quote(V.TACTIC_HOUSE_ANY)} THEN 12 ELSE 11 END)")}),
    "engagement_tier": Check(
        lambda t: J.left_lookup(t["marketing_fact"].select("integration_key", F.upper("activity_type_name").alias("k")),
                                t["kpi_definition"].filter(S.open_ended("end_date")), {"k": "activity_type_key2"},
                                {c: c for c in ("deep_flag", "light_flag", "contacted_flag", "cae_flag")}).select(
            "integration_key", *[c.alias(n) for n, c in E.tier_columns("deep_flag", "light_flag", "contacted_flag", "cae_flag").items()]),
        """SELECT integration_key, CASE WHEN deep_flag = '1' THEN 'Y' ELSE 'N' END AS deep_engagement_flag,
           CASE WHEN light_flag = '1' THEN 'Y' ELSE 'N' END AS light_engagement_flag, CASE WHEN contacted_flag = '1' THEN 'Y' ELSE 'N' END AS contacted_flag,
           CASE WHEN cae_flag = '1' THEN 'Y' ELSE 'N' END AS cae_flag,
           CASE '1' WHEN deep_flag THEN 'Deep Engagement' WHEN light_flag THEN 'Light Engagement' WHEN contacted_flag THEN 'Contacted' END AS engagement_type,
           CASE WHEN '1' IN (deep_flag, light_flag) THEN 'Y' ELSE 'N' END AS light_deep_engagement_flag FROM marketing_fact
           LEFT JOIN kpi_definition ON activity_type_key2 = upper(activity_type_name) AND year(end_date) % 100 = 99"""),
    "click_hygiene_flags": over("marketing_fact", "integration_key", {
        "unsubscribe": (lambda: E.unsubscribe_click("destination_id_type", "destination_id_value"),
                        "CASE WHEN upper(destination_id_type) = 'URL' AND (" + " OR ".join(
                            f"upper(destination_id_value) LIKE {quote(u)}" for u in V.UNSUBSCRIBE_URLS) + ") THEN 'Y' ELSE 'N' END"),
        "firewall": (lambda: E.firewall_click("attribute_24_name", "attribute_24_value"),
                     "CASE WHEN upper(attribute_24_name) = 'FIREWALL_FLAG' AND upper(attribute_24_value) = 'Y' THEN 'Y' ELSE 'N' END")}),
    "area_mapping": Check(
        lambda t: t["crm_sent_email"].join(t["crm_product"].withColumnRenamed("id", "pid"), C("pid") == C("product_vod__c"), "left").select(
            "id", E.area_of("name", "product_display_vod__c", "therapeutic_area_vod__c").alias("area")),
        f"SELECT m.id, {_AREA} AS area FROM crm_sent_email m LEFT JOIN crm_product p ON p.id = m.product_vod__c"),
    "area_groups": Check(
        lambda t: J.left_lookup(t["party_market"], t["therapeutic_area"], {"therapeutic_area_fk": "therapeutic_area_sk"}, {"area": "therapeutic_area"}).select(
            "party_market_sk", E.area_group("area").alias("grp"), E.program_of("area").alias("program")),
        f"""SELECT party_market_sk, CASE WHEN therapeutic_area IN ('HEMOPHILIA', 'HEMATOLOGY') THEN 'HEM'
            WHEN therapeutic_area IN ('NEUROLOGY', 'MULTIPLE SCLEROSIS', 'CNS') THEN 'MS' END AS grp,
            CASE therapeutic_area WHEN {quote(V.AREA_MS)} THEN {quote(V.MS_PROGRAM)} WHEN {quote(V.AREA_SMA)} THEN {quote(V.SMA_PROGRAM)}
            ELSE therapeutic_area END AS program FROM party_market LEFT JOIN therapeutic_area ON therapeutic_area_sk = therapeutic_area_fk"""),
    "decile_groups": over("account_ms_dim", "mk_account_vnt_id", {
        "grp": (lambda: E.decile_group("decile_rating"), "CASE WHEN TRY_CAST(decile_rating AS INTEGER) BETWEEN 8 AND 10 THEN '8-10 DECILE' "
                "WHEN TRY_CAST(decile_rating AS INTEGER) BETWEEN 5 AND 7 THEN '5-7 DECILE' WHEN decile_rating IN ('3', '4') THEN '3-4 DECILE' "
                "WHEN decile_rating IN ('1', '2') THEN '1-2 DECILE' WHEN decile_rating = '0' THEN '0 DECILE' ELSE 'NO DECILE' END")}),
    "segment_priority": over("target_hcp_list", "npi", {
        "priority": (lambda: E.segment_priority("segment"), "CASE WHEN segment IN ('N1', 'N2', 'P1') THEN 'Priority1' "
                     "WHEN segment IN ('N3', 'N4', 'P2', 'P3') THEN 'Priority2' END")}),
}

_ROLE = pick("o_orderkey", "Caregiver", "patient", "CONTACT", None)
_AGE = "CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_custkey % 90 END"
_ANSWER = pick("o_orderkey + o_custkey", "AGE_RANGE_0_12", "AGE_RANGE_13_17", "AGE_RANGE_ADULT", None)
_JOURNEY = f"""SELECT o_orderkey, {_ROLE} AS raw_role, {_AGE} AS age, {_ANSWER} AS answer, CASE WHEN o_orderkey % 5 < 2 THEN 1 END AS web,
    CASE WHEN o_orderkey % 7 = 0 THEN o_orderdate END AS injected, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate END AS referred FROM orders"""


def journeys(t):
    t["orders"].createOrReplaceTempView("orders")
    rows = t["orders"].sparkSession.sql(_JOURNEY)
    return rows.select("o_orderkey", E.patient_segment("raw_role", "age", "answer", "web").alias("segment"),
                       E.journey_stage("injected", "referred").alias("stage"))


_DATED = f"""SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS source_dt, {pick('o_custkey', 'Prod', None)} AS product_name,
    {pick('o_orderkey', V.EMAILABLE, V.BAD_EMAIL, V.HELD, V.BLOCKED)} AS tmp_suppression_criteria,
    {pick('o_orderkey + o_custkey', 'Y', 'N', None)} AS opt_out_flag, {pick('o_orderkey', 'N', 'Y')} AS et_active,
    {pick('o_custkey + 1', 1, 0, None)} AS bounce_flag,
    CASE WHEN o_orderkey % 4 = 0 THEN TIMESTAMP '9999-12-31 00:00:00' ELSE CAST(DATE '1997-01-01' + CAST(o_custkey % 700 AS INT) AS TIMESTAMP) END AS party_suppression_date,
    CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '9999-12-31 00:00:00' ELSE CAST(DATE '1997-03-01' + CAST(o_orderkey % 600 AS INT) AS TIMESTAMP) END AS opt_out_date,
    CASE WHEN o_orderkey % 5 < 2 THEN TIMESTAMP '9999-12-31 00:00:00' ELSE CAST(DATE '1997-02-01' + CAST(o_orderkey % 500 AS INT) AS TIMESTAMP) END AS merge_record_date,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN TIMESTAMP '9999-12-31 00:00:00'
         ELSE CAST(DATE '1997-02-01' + CAST(o_orderkey % 500 AS INT) AS TIMESTAMP) END AS bounce_date FROM orders"""


def causes(t):
    t["orders"].createOrReplaceTempView("orders")
    rows = t["orders"].sparkSession.sql(_DATED)
    return sup.clamp_dates(sup.earliest_cause(rows), V.CLAMP_PROFESSIONAL)


_CAUSE_TEXTS = ("source_dt party_suppression_date opt_out_date merge_record_date bounce_date suppression_date final_suppression_date "
                "final_source_dt")
_RULED = f"""SELECT o_orderkey, {pick('o_orderkey', 'Active', 'Active', 'Active', 'Retired', None)} AS hcp_status,
    {pick('o_orderkey', 'ACTIVE', 'ACTIVE', 'ACTIVE', 'ACTIVE', 'ACTIVE', 'DELETED', None)} AS record_state_cd,
    {pick('o_custkey', 'N', 'N', None, 'Y')} AS ama_opt_out_flag, {pick('o_custkey', 'Prescriber', 'Prescriber', None, 'Office', 'Prescriber')} AS hcp_type,
    {pick('o_orderkey + o_custkey', 'NBA HCP', 'SFMC HCP', None)} AS hcp_source,
    {pick('o_orderkey', 'a.b@c.org', 'x@kp.org', None, 'bad', 'd.e@f.com')} AS nba_email_address,
    {pick('o_custkey', 'a.b@c.org', 'x@KPPP.com', 'two words@c.d', 'd.e@f.com')} AS party_email_address, {pick('o_orderkey', 'Y', None, 'N')} AS et_active,
    {pick('o_custkey', 0, 1, None)} AS bounce_flag, {pick('o_orderkey + 1', 'N', 'Y', None)} AS opt_out_flag, {pick('o_custkey', 'Prod', None)} AS product_name
    FROM orders"""


def reasons(t):
    t["orders"].createOrReplaceTempView("orders")
    rows = t["orders"].sparkSession.sql(_RULED)
    return rows.select("o_orderkey", sup.suppression_reason(sup.professional_rules()).alias("reason"))


REASON_SQL = f"""SELECT o_orderkey, CASE WHEN hcp_status <> 'Active' THEN 'Status Inactive' WHEN record_state_cd <> 'ACTIVE' THEN 'Record State Inactive'
    WHEN ama_opt_out_flag = 'Y' THEN 'AMA Opt Out' WHEN hcp_type = 'Office' THEN 'Non Prescribers'
    WHEN hcp_source = 'NBA HCP' AND (nba_email_address IS NULL OR nba_email_address = 'bad') THEN {quote(V.BAD_EMAIL)}
    WHEN hcp_source = 'SFMC HCP' AND party_email_address = 'two words@c.d' THEN {quote(V.BAD_EMAIL)}
    WHEN hcp_source = 'NBA HCP' AND nba_email_address = 'x@kp.org' THEN {quote(V.BLOCKED)}
    WHEN hcp_source = 'SFMC HCP' AND party_email_address = 'x@KPPP.com' THEN {quote(V.BLOCKED)}
    WHEN et_active = 'N' THEN 'Merged Record' WHEN bounce_flag = 1 THEN 'Held Record' WHEN opt_out_flag = 'Y' THEN concat(product_name, ' Opt Out')
    ELSE 'Emailable Record' END AS reason FROM ({_RULED}) r"""

COMPOSED = {
    "patient_segment_and_stage": Check(
        journeys, f"""SELECT o_orderkey, {SEGMENT} AS segment, {STAGE} AS stage FROM (SELECT *, upper(raw_role) AS role, {BAND} AS band
            FROM ({_JOURNEY}) j) k"""),
    "earliest_cause_and_clamp": Check(causes, cause_sql(_DATED, V.CLAMP_PROFESSIONAL), "", _CAUSE_TEXTS, "bounce_flag"),
    "suppression_waterfall": Check(reasons, REASON_SQL),
    "affiliation_labels": Check(
        lambda t: aff.affiliation_rows(t).select("mk_account_vnt_id", "affiliation_name", E.affiliation_label(
            "affiliation_name", "affiliation_type").alias("label")),
        " UNION ALL ".join(f"""SELECT mk_account_vnt_id, {quote(c.upper())} AS affiliation_name, CASE WHEN upper({c}) IN ('PRIMARY__C', 'SECONDARY__C')
            THEN replace(upper({c}), '__C', '') || ' AD ' || {quote(V.AFFILIATION_SITES.get(c.upper()))} || ' LOCATION'
            {"WHEN upper(" + c + ") = 'Y' THEN 'PRIMARY AD AFFILIATION'" if i == 0 else ''} END AS label FROM parent_hco WHERE {c} <> 'N'
            AND record_state__v = 'VALID' AND mk_account_vnt_id <> '-1' AND mk_parent_account_vnt_id <> '-1'""" for i, c in enumerate(V.AFFILIATION_COLUMNS))),
    "health_system_of_parents": Check(
        lambda t: aff.health_systems(t["hco"].filter("record_state__v = 'VALID'"), aff.affiliation_rows(t)).select("mk_account_vnt_id", "health_care_system"),
        """SELECT DISTINCT h.mk_account_vnt_id, coalesce(g.n, p.n, CASE WHEN h.hco_type__v IN ('4:37', '26:13') THEN {'v': h.corporate_name__v} END).v AS health_care_system
           FROM hco h LEFT JOIN (SELECT * FROM parent_hco WHERE record_state__v = 'VALID' AND ad_primary_affiliation__c = 'Y' AND mk_account_vnt_id <> '-1'
               AND mk_parent_account_vnt_id <> '-1' QUALIFY row_number() OVER (PARTITION BY mk_account_vnt_id ORDER BY modified_date__v DESC NULLS LAST,
               mk_parent_account_vnt_id DESC) = 1) a ON a.mk_account_vnt_id = h.mk_account_vnt_id
           LEFT JOIN (SELECT * FROM parent_hco WHERE record_state__v = 'VALID' AND ad_primary_affiliation__c = 'Y' AND mk_account_vnt_id <> '-1'
               AND mk_parent_account_vnt_id <> '-1' QUALIFY row_number() OVER (PARTITION BY mk_account_vnt_id ORDER BY modified_date__v DESC NULLS LAST,
               mk_parent_account_vnt_id DESC) = 1) b ON b.mk_account_vnt_id = a.mk_parent_account_vnt_id
           LEFT JOIN (SELECT mk_account_vnt_id, {'v': corporate_name__v} AS n FROM hco WHERE record_state__v = 'VALID' AND hco_type__v IN ('4:37', '26:13')) p
               ON p.mk_account_vnt_id = a.mk_parent_account_vnt_id
           LEFT JOIN (SELECT mk_account_vnt_id, {'v': corporate_name__v} AS n FROM hco WHERE record_state__v = 'VALID' AND hco_type__v IN ('4:37', '26:13')) g
               ON g.mk_account_vnt_id = b.mk_parent_account_vnt_id WHERE h.record_state__v = 'VALID'"""),
    "audience_code": Check(
        lambda t: inter.audience(t["marketing_fact"].select(C("mk_account_vnt_id").alias("hcp_id"), F.when(
            C("source_cd") == "Knipper", "Veeva").otherwise(C("source_cd")).alias("marketing_vendor"))),
        """SELECT hcp_id, CASE sum(w) WHEN 1 THEN 'F' WHEN 2 THEN 'E' WHEN 3 THEN 'B' ELSE '' END AS customer_target FROM (SELECT DISTINCT
           mk_account_vnt_id AS hcp_id, source_cd, CASE WHEN source_cd = 'Knipper' THEN 1 WHEN upper(source_cd) = 'SFMC' THEN 2 ELSE 0 END AS w
           FROM marketing_fact) v GROUP BY 1"""),
    "metric_long_rows": Check(
        lambda t: metric_rows(t["lineitem"].groupBy("l_suppkey", "l_returnflag", S.friday_of_week("l_shipdate").alias("bucket")).agg(
            F.count_distinct("l_partkey").alias("n")), "X1", "Parts per week", "l_suppkey", "l_returnflag", "bucket", C("n")),
        """SELECT CAST(l_suppkey AS VARCHAR) AS customer_id, l_returnflag AS product_name, CAST(date_trunc('week', l_shipdate) AS DATE) + 4 AS time_bucket_date,
           'X1' AS metric_id, 'Parts per week' AS metric_name, count(DISTINCT l_partkey) AS metric_value FROM lineitem GROUP BY ALL""", "", "time_bucket_date"),
    "delivered_never_negative": Check(
        lambda t: t["events"].groupBy("user_id").agg(F.count(F.when(C("event_type") == "signup", 1)).alias("total_sends"),
                                                     F.count(F.when(C("event_type") == "error", 1)).alias("total_bounces")).withColumn("delivered", delivered()),
        """SELECT *, CASE WHEN total_sends < total_bounces THEN 0 ELSE total_sends - total_bounces END AS delivered FROM (SELECT user_id,
           count(*) FILTER (WHERE event_type = 'signup') AS total_sends, count(*) FILTER (WHERE event_type = 'error') AS total_bounces FROM events GROUP BY 1) s"""),
}

CHECKS = {**BASICS, **BUSINESS, **COMPOSED}
