"""Input tables of the plans, derived from the driver's tables.

Each stand-in is one SELECT that both Spark SQL and DuckDB understand, over the driver's tables or
earlier stand-ins, so both sides of a comparison start from the same rows; what is compared is what
the library and the check SQL make of them.  Every fact-like table grows with the driver's data.
Keys, dates and dirty values (NULL, '-1', blanks, mixed case, ties) come from modulus rules."""

from __future__ import annotations

import re

from contactloom import fixed_values as V

BASE = ("region nation customer supplier part orders lineitem events documents embeddings pages "
        "benchmark labels conversations").split()

# Order dates run from 1995 to 2001; twenty years later they pass the plans' date floors.
SHIFT = 7305
ACCOUNT_BASE = 242000000000000000
HOUSE = V.TACTIC_HOUSE_ANY.strip("%")


def quote(v: object) -> str:
    if v is None:
        return "NULL"
    return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"


def pick(expr: str, *values: object) -> str:
    """``expr % n`` chooses among the n values."""
    arms = " ".join(f"WHEN {i} THEN {quote(v)}" for i, v in enumerate(values))
    return f"CASE ({expr}) % {len(values)} {arms} END"


def text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def account(expr: str) -> str:
    return f"CAST({ACCOUNT_BASE} + ({expr}) AS STRING)"


def day(expr: str) -> str:
    return f"(CAST({expr} AS DATE) + {SHIFT})"


def moment(day_sql: str, k: str) -> str:
    return (f"CAST(CAST({day_sql} AS STRING) || ' ' || lpad(CAST(({k}) % 24 AS STRING), 2, '0') || ':' || "
            f"lpad(CAST(({k}) % 60 AS STRING), 2, '0') || ':00' AS TIMESTAMP)")


def digits(day_sql: str) -> str:
    return f"replace(CAST({day_sql} AS STRING), '-', '')"


def plus(start: str, k: str) -> str:
    return f"(DATE '{start}' + CAST({k} AS INT))"


BRANDS = [*V.UNIT_BRANDS.values(), V.SMA_DRUG, *V.ALZ_BRANDS]
NO_TEXT = "CAST(NULL AS STRING)"

CODES = ["HCP", "PAT", "Prescriber", "Non-Prescribing Health Care Professional", "Other Staff", "Office",
         "Hospital", "Active", "Retired", "ACTIVE", "INACTIVE", "DELETED", "PENDING", V.AMA_FLAG, "OTHER_FLG",
         "COMM_PHONE_1", "Comm_Email_1", "COMM_FAX", "M", "F", "Patient,Self", "Caregiver", "Contact",
         "Patient/Caregiver", "Vendor,External"]
AREAS = [("NEUROLOGY", -1), ("HEMATOLOGY", -1), (V.AREA_MS, 1), (V.AREA_SMA, 1), ("HEMOPHILIA", 2),
         ("ONCOLOGY", -1), ("LUNG", 6), ("CNS", -1), (V.AREA_MS, 8), (V.AREA_MS, 2)]


def _nth(column: str, values: list) -> str:
    arms = " ".join(f"WHEN {i} THEN {quote(v)}" for i, v in enumerate(values))
    return f"CASE {column} {arms} END"


def _attributes() -> str:
    names = {
        1: (pick("o_orderkey", "campaign", "Other", None), "'CMP' || " + text("o_orderkey % 9")),
        2: (pick("o_orderkey", "SiteOrigin", None, "x", "Campaign"),
            f"CASE WHEN o_orderkey % 7 = 4 THEN {pick('o_custkey', *V.SMA_WEB_SITES.values(), ' site.com')} "
            f"WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'V' || {text('o_orderkey % 5')} END"),
        5: ("'BOUNCE_CATEGORY'", pick("o_orderkey", "Hard bounce", "Soft bounce", None)),
        24: (pick("o_orderkey", "FIREWALL_FLAG", "firewall_flag", None, "z"),
             pick("o_orderkey + o_custkey", "N", "y", "N", None, "N", "Y", "N")),
        25: (pick("o_orderkey", None, "CAMPAIGN"), "'LAST'"),
    }
    return ", ".join(f"{names.get(i, (NO_TEXT, NO_TEXT))[0]} AS attribute_{i}_name, "
                     f"{names.get(i, (NO_TEXT, NO_TEXT))[1]} AS attribute_{i}_value" for i in range(1, 26))


_ODAY = day("o_orderdate")

STANDINS: dict[str, str] = {
    # ---- dictionaries ------------------------------------------------------------------------
    "code": f"""SELECT CAST(n_nationkey + 1 AS BIGINT) AS code_sk, {_nth('n_nationkey', CODES)} AS code_name,
        CASE WHEN n_nationkey BETWEEN 9 AND 12 THEN 'y' ELSE 'N' END AS active_flg,
        CASE WHEN n_nationkey < 2 THEN 1 WHEN n_nationkey < 9 THEN 2
             WHEN n_nationkey < 13 THEN 3 ELSE 4 END AS domain_fk FROM nation
        UNION ALL SELECT CAST(40 AS BIGINT), 'ACTIVE', ' y ', 3""",
    "domain_code": f"""SELECT r_regionkey + 1 AS domain_sk,
        {_nth('r_regionkey', ['Party Type', 'HCP Type', V.RECORD_STATE_DOMAIN, 'Communication', 'Other'])}
        AS domain_name FROM region""",
    "date_param": f"""SELECT {_nth('r_regionkey', [V.HCP_DATE_PARAM, V.MARKET_DATE_PARAM, V.MERGE_DATE_PARAM,
        'OTHER', 'MORE'])} AS etl_name, CASE WHEN r_regionkey = 1 THEN DATE '2014-01-01'
        ELSE DATE '2020-05-05' END AS extract_date FROM region""",
    "rdm_country_code": """SELECT CAST(n_nationkey + 1 AS BIGINT) AS country_sk,
        CASE n_nationkey WHEN 0 THEN 'US' WHEN 1 THEN 'US' ELSE 'X' || CAST(n_nationkey AS STRING) END AS iso_2_cd FROM nation""",
    "country_code": """SELECT CAST(n_nationkey + 1 AS BIGINT) AS country_sk, n_name AS country_name,
        CASE WHEN n_nationkey = 0 THEN 'USA' ELSE 'C' || CAST(n_nationkey AS STRING) END AS iso_3_cd,
        CASE WHEN n_nationkey = 0 THEN 'US' ELSE 'X' || CAST(n_nationkey AS STRING) END AS iso_2_cd
        FROM nation""",
    "therapeutic_area": f"""SELECT CAST(n_nationkey + 1 AS BIGINT) AS therapeutic_area_sk,
        {_nth('n_nationkey', [a for a, _ in AREAS])} AS therapeutic_area,
        CAST({_nth('n_nationkey', [p for _, p in AREAS])} AS BIGINT) AS parent_therapeutic_area_fk,
        CAST(CASE WHEN n_nationkey = 9 THEN 11 ELSE 10 END AS BIGINT) AS record_state_cd_fk
        FROM nation WHERE n_nationkey < 10""",
    # ---- parties -----------------------------------------------------------------------------
    "party": f"""SELECT c_custkey AS party_sk,
        CASE WHEN c_custkey % 37 = 5 THEN NULL WHEN c_custkey % 2 = 0 THEN {account('c_custkey')}
             ELSE '{V.PERSON_PREFIX}' || {text('c_custkey')} END AS mdm_key,
        CAST(CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 2 END AS BIGINT) AS party_type_cd_fk,
        CASE WHEN c_custkey % 29 = 4 THEN NULL ELSE 21 + c_custkey % 5 END AS party_subtype_cd_fk,
        CAST(CASE WHEN c_custkey % 19 = 3 THEN 2 ELSE 1 END AS BIGINT) AS primary_country_fk,
        {plus('2016-01-01', 'c_custkey % 1500')} AS created_dt FROM customer""",
    "party_hcp": f"""SELECT c_custkey AS party_fk, 'F' || {text('c_custkey % 50')} AS first_name,
        CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'M' END AS middle_name, c_name AS last_name,
        {pick('c_custkey', 'Dr', None, 'Prof')} AS title,
        CASE WHEN c_custkey % 31 = 2 THEN NULL ELSE 3 + c_custkey % 3 END AS hcp_type_cd_fk,
        6 + c_custkey % 2 AS practice_type_cd_fk,
        CAST(CASE WHEN c_custkey % 13 = 0 THEN 9 ELSE 8 END AS BIGINT) AS hcp_status_cd_fk,
        CAST(CASE WHEN c_custkey % 11 = 0 THEN 11 WHEN c_custkey % 17 = 0 THEN 13 ELSE 10 END AS BIGINT)
        AS record_state_cd_fk,
        CAST(CASE WHEN c_custkey % 19 = 3 THEN 2 ELSE 1 END AS BIGINT) AS primary_country_cd_fk
        FROM customer WHERE c_custkey % 2 = 0""",
    "v_party_hcp": """SELECT c_custkey AS party_fk,
        CASE WHEN c_custkey % 19 = 3 THEN 'CAN' ELSE 'USA' END AS primary_country_cd,
        CASE WHEN c_custkey % 11 = 0 THEN 'INACTIVE' WHEN c_custkey % 17 = 0 THEN 'PENDING' ELSE 'ACTIVE' END
        AS record_state_cd FROM customer WHERE c_custkey % 2 = 0""",
    "party_patient": f"""SELECT c_custkey AS party_fk, {pick('c_custkey', 'Mr', 'Ms', None)} AS salutation,
        'P' || {text('c_custkey % 40')} AS first_name, {NO_TEXT} AS middle_name, c_name AS last_name,
        {NO_TEXT} AS title, {pick('c_custkey', 'Jr', None)} AS suffix,
        CASE WHEN c_custkey % 7 = 1 THEN NULL ELSE {plus('1935-06-15', '(c_custkey * 37) % 31000')} END AS birth_dt,
        19 + c_custkey % 2 AS gender_cd_fk, 21 + c_custkey % 3 AS patient_type_cd_fk,
        CAST(CASE WHEN c_custkey % 41 = 1 THEN 11 WHEN c_custkey % 43 = 1 THEN 13 ELSE 10 END AS BIGINT)
        AS record_state_cd_fk, {moment(plus('2017-01-01', 'c_custkey % 1200'), 'c_custkey')} AS last_load_ts
        FROM customer WHERE c_custkey % 2 = 1 AND c_custkey % 9 <> 1""",
    "party_contact": "SELECT c_custkey AS party_fk FROM customer WHERE c_custkey % 9 = 1 OR c_custkey % 12 = 1",
    "party_market": f"""SELECT o_orderkey AS party_market_sk, o_custkey AS party_fk,
        3 + o_orderkey % 8 AS therapeutic_area_fk, 1 + o_orderkey % 9 AS product_brand_fk,
        CAST(CASE WHEN o_orderkey % 11 = 0 THEN 11 ELSE 10 END AS BIGINT) AS record_state_cd_fk FROM orders""",
    "product_brand": "SELECT CAST(r_regionkey + 1 AS BIGINT) AS product_brand_sk, r_name AS brand_name FROM region",
    "party_flag": f"""SELECT c_custkey AS party_fk, {pick('c_custkey', 'N', 'Y', 'N', None, 'N')} AS allowed_flg,
        14 + c_custkey % 2 AS flag_type_cd_fk FROM customer WHERE c_custkey % 4 <> 3""",
    "party_merge_map": f"""SELECT o_custkey AS survivor_party_fk,
        CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE (o_custkey + 2 * (o_orderkey % 50)) END AS non_survivor_party_fk,
        {moment(_ODAY, 'o_orderkey')} AS src_merge_dt,
        10 + o_orderkey % 3 AS record_state_cd_fk FROM orders WHERE o_orderkey % 6 = 1""",
    "sma_hcp_hco_raw": f"""SELECT CASE WHEN o_custkey % 53 = 0 THEN 'short' ELSE 'XY' || {account('o_custkey')} END
        AS mdm_id, {pick('o_orderkey', 'Tier 2', 'Tier 1', None, 'Tier 3')} AS sma_segment__c
        FROM orders WHERE o_orderkey % 3 = 0""",
    "party_communication": f"""SELECT o_custkey AS party_fk, 16 + o_orderkey % 3 AS communication_type_cd_fk,
        CASE WHEN o_orderkey % 3 = 1 THEN {pick('o_orderkey + o_custkey', 'a.b@site.org', 'two words@x.org',
        'x@kp.org', None, 'end.@dot.', 'no-dot@site', 'a@b@c.d', 'c.d@mail.com', ' e.f@mail.com ', '.@', '   ')}
        ELSE '555-' || {text('o_orderkey % 1000')} END AS comm_value,
        {moment(_ODAY, 'o_orderkey % 5')} AS effective_dt, 'K' || lpad({text('o_orderkey')}, 12, '0') AS integration_key,
        {pick('o_orderkey', 'Y', 'Y', 'N', 'Y')} AS primary_flg,
        {pick('o_orderkey + 1', 'N', 'N', None, 'Y', 'N')} AS bounced_inform_flg,
        CAST(CASE WHEN o_orderkey % 8 = 0 THEN 12 WHEN o_orderkey % 8 = 2 THEN 40 ELSE 10 END AS BIGINT) AS record_state_cd_fk FROM orders""",
    "party_address": f"""SELECT o_custkey AS party_fk, 'Street ' || {text('o_orderkey % 100')} AS address_line_1,
        {NO_TEXT} AS address_line_2, 'US' AS country_name, 'ST' || {text('o_orderkey % 50')} AS state_name,
        'County' AS county_name, 'City' || {text('o_orderkey % 70')} AS city_name,
        lpad({text('o_orderkey % 99999')}, 5, '0') AS postal_cd,
        CASE WHEN o_orderkey % 15 = 0 THEN NULL ELSE {moment(_ODAY, 'o_orderkey % 3')} END AS last_load_ts,
        'K' || lpad({text('o_orderkey')}, 12, '0') AS integration_key,
        {pick('o_orderkey', 'Y', 'N', 'Y')} AS primary_address_flg, {pick('o_orderkey', 'Y', 'Y', 'Y', 'N')} AS current_flg,
        {pick('o_orderkey', 'N', 'N', 'Y', None, 'N')} AS bounced_inform_flg,
        CAST(CASE WHEN o_orderkey % 10 = 0 THEN 11 WHEN o_orderkey % 10 = 4 THEN 40 ELSE 10 END AS BIGINT) AS record_state_cd_fk FROM orders""",
    "first_source": f"""SELECT {text('c_custkey')} AS party_fk,
        CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'Lead ' || {text('c_custkey % 6')} END AS true_source,
        'Source ' || {text('c_custkey % 4')} AS source_name, {plus('2016-06-01', 'c_custkey % 1400')} AS create_dt
        FROM customer WHERE c_custkey % 10 <> 9""",
    "party_dim": f"""SELECT c_custkey AS party_sk, {account('c_custkey')} AS vnid,
        {pick('c_custkey', 'doc@clinic.org', None, 'doc@@clinic.org', 'doc@KaiserPermanente.com', 'doc@clinic')}
        AS email_addr FROM customer WHERE c_custkey % 2 = 0""",
    "comm_email": f"""SELECT {text('c_custkey')} AS party_fk, 'own.' || {text('c_custkey')} || '@mail.org' AS comm_value
        FROM customer WHERE c_custkey % 8 = 0""",
    "nba_hcp": f"""SELECT {account('c_custkey + 4 * (c_custkey % 2)')} AS prof_sk,
        {pick('c_custkey', 'n.b@list.com', 'plain', None, 'n@kpchr.net', 'a b@list.com', '.', 'ok.ok@list.com')} AS email
        FROM customer WHERE c_custkey % 5 < 2""",
    "hcp_marketing": f"""SELECT {pick('p_partkey', *BRANDS, V.AREA_MS, V.AREA_SMA)} AS product_name,
        {pick('p_partkey', *([V.AREA_MS] * 5 + [V.AREA_SMA] + ['ALZ'] * 2 + [V.AREA_MS, V.AREA_SMA]))}
        AS therapeutic_area FROM part""",
    # ---- workflow facts ----------------------------------------------------------------------
    "time_dim": f"""SELECT DISTINCT CAST({digits(_ODAY)} AS BIGINT) AS time_sk, {_ODAY} AS time_dt FROM orders""",
    "activity_fact": f"""SELECT o_custkey AS customer_fk, CAST({digits(_ODAY)} AS BIGINT) AS time_fk,
        CASE WHEN o_orderkey % 4 = 0 THEN CAST({V.BOUNCE_ACTIVITY_TYPE} AS BIGINT) ELSE 1 + o_orderkey % 4 END AS activity_type_fk,
        CASE WHEN o_orderkey % 33 = 0 THEN NULL ELSE 'I' || {text('o_orderkey - o_orderkey % 2')} END AS integration_key,
        {pick('o_orderkey', 'BOUNCE_CATEGORY', 'BOUNCE_CATEGORY', 'X')} AS attribute_5_name,
        CASE WHEN o_custkey % 5 = 0 THEN 'Hard bounce' WHEN o_custkey % 5 < 3 THEN 'Soft bounce' ELSE 'None' END AS attribute_5_value,
        {pick('o_orderkey', *V.SMA_WEB_SITES.values(), 'OTHER.COM')} AS attribute_2_value,
        {pick('o_custkey + o_orderkey', 'WEB_NEURO', 'WEBXNEURO', 'SFMC')} AS source_cd FROM orders""",
    "activity_type_dim": f"""SELECT CAST(n_nationkey + 1 AS BIGINT) AS activity_type_sk,
        {pick('n_nationkey', 'LOGIN', 'WEB REG', 'CLICK', 'VIEW', 'OPEN')} AS activity_type_name FROM nation""",
    "iw_program": f"""SELECT CAST(n_nationkey + 1 AS BIGINT) AS iw_program_sk,
        {_nth('n_nationkey', V.OPT_PROGRAMS[:4] + ['Vumerity'] + V.OPT_PROGRAMS[5:] + ['OTHER'])} AS program_name
        FROM nation WHERE n_nationkey < 9""",
    "iw_topic": f"""SELECT CAST(r_regionkey + 1 AS BIGINT) AS iw_topic_sk,
        {pick('r_regionkey', 'Informational', 'Clinical')} AS topic_name FROM region WHERE r_regionkey < 2""",
    "iw_snapshot": f"""SELECT o_custkey AS party_fk, 1 + o_orderkey % 9 AS iw_program_fk, 1 + o_orderkey % 2 AS iw_topic_fk,
        {pick('o_orderkey + o_custkey', 'Y', 'N', 'Y', None, 'N')} AS iw_flg,
        {moment(_ODAY, 'o_orderkey')} AS last_load_ts, {pick('o_orderkey', 'Email', 'EMAIL', 'email', 'PHONE', 'EMAIL')}
        AS channel_cd FROM orders""",
    "party_segmentation": f"""SELECT o_custkey AS party_fk, {pick('o_orderkey', 'Patient', 'Prospect', 'None', 'PATIENT')}
        AS code_value, 1 + o_orderkey % 6 AS product_brand_fk,
        CASE WHEN o_orderkey % 5 = 0 THEN 'Other' ELSE '{V.LEAD_TYPE}' END AS segmentation_cd
        FROM orders WHERE o_custkey % 7 <> 1""",
    "marketing_product": f"""SELECT CAST(n_nationkey + 1 AS BIGINT) AS product_sk,
        {_nth('n_nationkey', [*V.UNIT_BRANDS.values()])} AS product_name FROM nation WHERE n_nationkey < 5""",
    "survey_response": f"""SELECT o_orderkey AS survey_response_sk, o_custkey AS party_fk, {_ODAY} AS response_dt
        FROM orders WHERE o_orderkey % 4 = 2""",
    "survey_answer": f"""SELECT o_orderkey * 10 AS response_answer_sk, o_orderkey AS survey_response_fk,
        {pick('o_custkey + o_orderkey', 'AGE_RANGE_0_12', 'AGE_RANGE_13_17', 'AGE_RANGE_ADULT', 'OTHER')} AS response_value
        FROM orders WHERE o_orderkey % 2 = 0""",
    "campaign_variables": f"""SELECT '{V.PERSON_PREFIX}' || {text('c_custkey')} AS mdmid,
        CASE WHEN c_custkey % 3 = 1 THEN {plus('2018-01-01', 'c_custkey % 300')} END AS first_injection_date,
        CASE WHEN c_custkey % 5 < 3 THEN {plus('2017-01-01', 'c_custkey % 300')} END AS referral_received_date
        FROM customer WHERE c_custkey % 4 <> 3""",
    # ---- marketing activity ------------------------------------------------------------------
    "marketing_fact": f"""SELECT
        {pick('o_orderkey', 'SFMC', 'sfmc', 'SFMC', 'SFMC', 'WEB_NEURO', 'SFDC_US', 'Knipper')} AS source_cd,
        CASE WHEN o_orderkey % 23 = 0 OR o_custkey % 2 = 0 THEN '-1' ELSE {text('o_custkey')} END AS mk_patient_gne_id,
        CASE WHEN o_orderkey % 23 = 0 OR o_custkey % 2 = 1 THEN '-1' ELSE {account('o_custkey')} END AS mk_account_vnt_id,
        'raw' || {text('o_custkey - o_custkey % 7')} AS customer_identity_value, 'COOKIE' AS customer_identity_type,
        CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 9 = 1 THEN 'unknown'
             WHEN o_custkey % 2 = 0 THEN 'Hcp' WHEN o_orderkey % 9 = 2 THEN 'Contact' ELSE 'Patient' END AS customer_type,
        'R' || {text('o_orderkey % 40')} AS rep_id,
        {pick('o_orderkey', 'Offer one', None, 'Offer two')} AS offer_des, 'T' || {text('o_custkey % 30')} AS territory_id,
        'S' || {text('o_orderkey % 500')} AS session_id, {NO_TEXT} AS transaction_id, {NO_TEXT} AS parent_transaction_id,
        {text('o_orderkey % 90')} AS content_id, {NO_TEXT} AS referal_id_type, {NO_TEXT} AS referal_id_value,
        {NO_TEXT} AS referal_content_id, {pick('o_orderkey', 'URL', 'url', 'OTHER')} AS destination_id_type,
        {pick('o_orderkey + o_custkey', 'http://a.com/x', 'http://a.com/Unsubscribe?id', 'http://b.com', None)}
        AS destination_id_value, {NO_TEXT} AS destination_content_id, 1 AS activity_cnt, o_orderkey % 60 AS time_spent,
        'N' AS is_aggregated, {pick('o_custkey', 'Y', 'N', 'Y')} AS is_active,
        'A' || lpad({text('o_orderkey')}, 12, '0') AS integration_key, {text('o_orderkey * 31')} AS row_hash_key,
        {text('o_orderkey % 12')} AS job_run_id, {moment(_ODAY, 'o_orderkey % 7')} AS last_load_ts, {NO_TEXT} AS device_type,
        {_attributes()},
        'US' AS geo_region_cd, 'N' AS has_interaction_detail,
        {moment(_ODAY, 'o_orderkey % 6')} AS activity_time, {text('o_orderkey % 3')} AS channel_cd,
        CASE WHEN o_orderkey % 7 < 4 THEN {pick('o_orderkey', 'Exact Target Email', 'EXACT TARGET EMAIL ')}
             WHEN o_orderkey % 7 = 4 THEN 'Web' WHEN o_orderkey % 7 = 5 THEN NULL ELSE 'Print' END AS channel_name,
        ' level2 ' AS channel_level_2_name,
        CASE WHEN o_orderkey % 7 = 4 THEN {pick('o_orderkey', 'Web Reg', 'Web Reg', 'Login')}
             WHEN o_orderkey % 71 = 5 THEN NULL
             ELSE {pick('o_orderkey', 'Email Sent', 'email opened', ' Email Sent', 'Email Bounced', 'Clicked Link on Email')}
        END AS activity_type_name,
        {pick('o_custkey', 'b0', 'B1', 'b2', 'B3', 'b6', 'B7', None)} AS mk_product_brand_pm_id,
        {pick('o_custkey', 'c0', 'C1', None, 'c9')} AS mk_therapeutic_class_pm_id,
        {pick('o_custkey', *V.ALZ_BRANDS, 'Other', None)} AS marketing_brand,
        CASE WHEN o_orderkey % 7 < 4 THEN {pick('o_custkey % 6 + o_orderkey % 2', 'TEC-US-0001', 'TEC-US-0001_R1',
        'tec-us-0001_A', HOUSE.lower() + '12345_r1', HOUSE + '12345', 'ABC-DE-777_x', None)}
             ELSE 'K' || {text('o_orderkey % 8')} END AS tactic_cd,
        'Desc ' || {text('o_orderkey % 8')} AS tactic_desc, {pick('o_orderkey', None, 'o1')} AS offer_cd1,
        {pick('o_orderkey', 'o2', None, None)} AS offer_cd2, {NO_TEXT} AS offer_cd3, {NO_TEXT} AS offer_cd4,
        {pick('o_orderkey', 'o5', None)} AS offer_cd5
        FROM orders""",
    "kpi_definition": f"""SELECT {pick('n_nationkey', 'EMAIL SENT', 'Email Opened ', 'CLICKED LINK ON EMAIL',
        'EMAIL BOUNCED', 'WEB REG')} AS activity_type_key2,
        CASE WHEN n_nationkey < 5 THEN 'EXACT TARGET EMAIL' WHEN n_nationkey < 10 THEN 'Web'
             WHEN n_nationkey < 15 THEN 'VEEVA APPROVED EMAIL' ELSE 'EXACT TARGET EMAIL' END AS activity_source_key1,
        CASE WHEN n_nationkey < 5 THEN 'EMAIL & ALERTS' END AS activity_channel,
        CASE WHEN n_nationkey < 5 THEN ' Email' ELSE 'Site' END AS activity_subchannel, ' Vendor ' AS activity_vendor,
        {pick('n_nationkey', 'Sent', None, 'Click', 'Bounce')} AS metric_type, 'c' AS comments, 'tt' AS hcp_tactic_type,
        {pick('n_nationkey', '0', '0', '1', None)} AS deep_flag, {pick('n_nationkey', '0', '1', '1')} AS light_flag,
        {pick('n_nationkey', '1', None)} AS contacted_flag, {pick('n_nationkey', '0', '1')} AS cae_flag, '1' AS engaged_flag,
        '0' AS acted_flag, CASE WHEN n_nationkey < 15 THEN DATE '2099-12-31' ELSE DATE '2019-12-31' END AS end_date
        FROM nation""",
    "tactic_definition": f"""SELECT {_nth('n_nationkey % 5', ['TEC-US-0001', 'tec-us-0001', HOUSE + '12345', 'K1', 'K2'])}
        AS activity_tactic_code, 'Title ' || {text('n_nationkey')} AS tactic_title,
        'Doc ' || {text('n_nationkey')} AS tactic_document_name, 'P' AS tactic_product, 'D' AS tactic_description,
        'T' AS tactic_type, {plus('2018-01-01', 'n_nationkey')} AS approvedfordistribution_date,
        CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE {plus('2020-01-01', 'n_nationkey * 7 % 11')} END AS tactic_expiration_date
        FROM nation""",
    "kit_code_definition": f"""SELECT {_nth('n_nationkey', ['tec-us-0001_R1', 'TEC-US-0001_a', HOUSE + '12345', 'TEC-US-0001'])}
        AS activity_tactic_code, 'cat' AS activity_em_category, {pick('n_nationkey', 'stream', None)} AS activity_em_stream,
        'sub' AS activity_sub_stream, {text('n_nationkey')} AS activity_em_number,
        {text('n_nationkey')} || 'A' AS activity_em_number_with_ab_split FROM nation WHERE n_nationkey < 4""",
    "account_dim": f"""SELECT CASE WHEN c_custkey = 96 THEN '-1' WHEN c_custkey % 89 = 88 THEN NULL
             ELSE {account('c_custkey')} END AS mk_account_vnt_id,
        CASE WHEN c_custkey % 14 = 0 THEN 'Hco' WHEN c_custkey % 26 = 0 THEN NULL ELSE 'HCP' END AS account_class,
        CASE WHEN c_custkey % 21 = 0 THEN NULL ELSE c_name END AS account_name,
        {pick('c_custkey', 'VALID', 'Valid', 'VALID', 'INVALID')} AS record_state
        FROM customer WHERE c_custkey % 2 = 0""",
    "patient_dim": f"""SELECT CASE WHEN c_custkey = 1 THEN '-1' WHEN c_custkey % 89 = 3 THEN NULL ELSE {text('c_custkey')} END
        AS mk_patient_gne_id, {pick('c_custkey', 'Patient', 'Other', 'Caregiver of patient', 'vendor', None)} AS patient_class,
        {pick('c_custkey', 'Active', 'Inactive', None)} AS patient_status_name FROM customer WHERE c_custkey % 2 = 1""",
    "brand_master": f"""SELECT 'B' || {text('n_nationkey')} AS mk_product_brand_pm_id,
        {_nth('n_nationkey', BRANDS + ['RIVAL'])} AS product_brand_name,
        CASE WHEN n_nationkey < 8 THEN 'n' ELSE 'Y' END AS brand_competitor_flag FROM nation WHERE n_nationkey < 9""",
    "therapeutic_class_master": f"""SELECT 'C' || {text('n_nationkey')} AS mk_therapeutic_class_pm_id,
        {pick('n_nationkey', 'Ms', 'Sma')} AS therapeutic_class FROM nation WHERE n_nationkey < 4""",
    "cycle_plan": f"""SELECT CASE WHEN o_orderkey % 50 = 0 THEN '-1' ELSE {account('o_custkey')} END AS mk_account_vnt_id,
        {moment(_ODAY, 'o_orderkey')} AS cycle_plan_start_date,
        CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE CAST({_ODAY} + CAST(o_orderkey % 300 AS INT) AS TIMESTAMP) END
        AS cycle_plan_end_date, CAST(o_orderkey % 4 AS INT) AS planned_call_count FROM orders WHERE o_custkey % 2 = 0""",
    # ---- calls, events, rep mails ------------------------------------------------------------
    "call_plan_activity": f"""SELECT o_orderkey AS call_id, {account('o_custkey')} AS mk_account_vnt_id,
        {moment(_ODAY, 'o_orderkey')} AS call_start_date, {pick('o_orderkey', 'Hcp', 'HCP', 'Hco')} AS account_type,
        {pick('o_orderkey', *[b.title() for b in BRANDS])} AS first_product, {pick('o_orderkey', 'Y', 'N')} AS call_plan_target_flag,
        'B' || {text('o_orderkey % 9')} AS primary_product_brand_id, {pick('o_orderkey', 'Ms', None)} AS primary_therapeutic_area
        FROM orders WHERE o_orderkey % 3 = 1""",
    "field_call": f"""SELECT {account('o_custkey')} AS mk_account_vnt_id,
        CASE WHEN o_orderkey % 47 = 0 THEN NULL ELSE {moment(_ODAY, 'o_orderkey')} END AS call_start_date,
        {pick('o_orderkey', 'Detail', 'Remote')} AS call_type, 'W' || {text('o_custkey')} AS employee_id,
        {pick('o_orderkey', 'HCP', 'Hcp', 'HCO')} AS account_type,
        {pick('o_orderkey', *[f.lower() for f in V.FIELD_FORCES_CALLS], 'NEURO')} AS field_force_name,
        {pick('o_orderkey', V.ALZ_PRODUCT, 'x', None)} AS first_product, {pick('o_orderkey', None, 'x')} AS second_product,
        {NO_TEXT} AS third_product, {pick('o_orderkey', 'x', 'y', V.ALZ_PRODUCT.lower(), 'x')} AS fourth_product,
        {NO_TEXT} AS fifth_product FROM orders""",
    "event": f"""SELECT 'E' || {text('p_partkey')} AS event_id,
        {pick('p_partkey', 'Franchise Pep', *[b.lower() for b in BRANDS], None, V.ALZ_PRODUCT)} AS product_code,
        {digits(plus('2018-09-01', 'p_partkey % 900'))} || '093000' AS event_start_date_time,
        {pick('p_partkey', 'TYPE_A', 'TYPE_B')} AS event_type, {pick('p_partkey', 'SUB_1', 'SUB_2', 'SUB_9')} AS event_sub_type_code,
        {pick('p_partkey', 'LIVE', 'WEB')} AS event_format_code, {pick('p_partkey', 'Closed', 'OCC', 'CLOSED', 'OPEN')} AS event_status_code,
        CASE WHEN p_partkey % 77 = 0 THEN NULL ELSE p_name END AS event_name, {pick('p_partkey', 'Sma', 'Ms', None)} AS therapeutic_area_code
        FROM part""",
    "attendee": f"""SELECT DISTINCT 'E' || {text('l_partkey')} AS event_id,
        CASE WHEN l_orderkey % 41 = 0 THEN NULL WHEN l_orderkey % 43 = 0 THEN 'NA' WHEN l_suppkey % 3 = 0 THEN 'm' || {text('l_orderkey')}
             ELSE {account('l_suppkey * 2 + l_orderkey % 40')} END AS mdm_id, {account('l_suppkey * 2 + l_orderkey % 40')} AS mk_account_vnt_id,
        {pick('l_linenumber', 'ATND', 'Atnd', 'NOSHOW')} AS attendee_status, {pick('l_suppkey', 'ROLE_1', 'ROLE_9')} AS attendee_role,
        {pick('l_orderkey', 'Hcp', 'Caregiver', 'PATIENT')} AS attendee_type, 'MF' AS source_name,
        {digits(day('l_shipdate'))} AS created_date FROM lineitem""",
    "reference_map": f"""SELECT {_nth('n_nationkey', ['ATND', 'Atnd', 'NOSHOW', 'Closed', 'OCC', 'CLOSED', 'OPEN', 'SUB_1', 'SUB_2',
        'ROLE_1', 'TYPE_A', 'LIVE'])} AS src_value, {_nth('n_nationkey', ['Attended', 'ATTENDED', 'No Show', 'Closed', 'Occured', 'CLOSED',
        'Open', 'HCP Program', 'Other', 'Speaker', 'Dinner', 'Live'])} AS trgt_value,
        CASE WHEN n_nationkey < 3 OR n_nationkey = 9 THEN 'mfr_mf_event_attendee' ELSE 'MFR_MF_EVENT' END AS src_entity,
        CASE WHEN n_nationkey < 3 THEN 'Attendee_Status' WHEN n_nationkey < 7 THEN 'EVENT_STATUS' WHEN n_nationkey < 9 THEN 'EVENT_SUB_TYPE'
             WHEN n_nationkey = 9 THEN 'ATTENDEE_ROLE' WHEN n_nationkey = 10 THEN 'EVENT_TYPE' ELSE 'EVENT_FORMAT' END AS src_entity_type
        FROM nation WHERE n_nationkey < 12""",
    "crm_sent_email": f"""SELECT 'M' || {text('o_orderkey')} AS id,
        CASE WHEN o_orderkey % 39 = 0 THEN NULL ELSE {moment(_ODAY, 'o_orderkey')} END AS email_sent_date_vod__c,
        CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE 'AC' || {text('o_custkey')} END AS account_vod__c,
        'D' || {text('o_custkey')} AS approved_email_template_vod__c,
        CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE 'PR' || {text('o_orderkey % 12')} END AS product_vod__c,
        {pick('o_orderkey', 'Delivered_vod', 'Sent_vod', 'Failed_vod', ' Sent _x')} AS status_vod__c, 'U' || {text('o_custkey + o_orderkey % 3')} AS ownerid,
        {pick('o_orderkey', 'Plain', 'Left|Right side', None, 'A|B|c')} AS product_display_vod__c FROM orders""",
    "crm_email_activity": f"""SELECT 'EA' || {text('o_orderkey')} AS id,
        CASE WHEN o_orderkey % 40 = 0 THEN NULL ELSE {moment(_ODAY, 'o_orderkey + 3')} END AS activity_datetime_vod__c,
        {pick('o_orderkey', 'Opened_vod', 'Clicked_vod', 'Bounced_vod', None)} AS event_type_vod__c,
        CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE 'M' || {text('o_orderkey - o_orderkey % 10')} END AS sent_email_vod__c
        FROM orders WHERE o_orderkey % 10 < 3""",
    "crm_account": f"""SELECT 'AC' || {text('c_custkey')} AS id, CASE WHEN c_custkey % 33 = 0 THEN NULL ELSE {account('c_custkey')} END
        AS external_id_vod__c FROM customer WHERE c_custkey % 15 <> 7""",
    "crm_document": f"""SELECT 'D' || {text('p_partkey')} AS id, p_name AS name, 'RT' || {text('p_partkey % 4')} AS recordtypeid
        FROM part WHERE p_partkey % 20 <> 11""",
    "crm_product": f"""SELECT 'PR' || {text('n_nationkey')} AS id, {_nth('n_nationkey', [b.title() for b in BRANDS] +
        [V.FRANCHISE_NEURO, 'New alz drug', 'Mystery', 'Unlisted'])} AS name, {pick('n_nationkey', 'Rare', None)} AS therapeutic_area_vod__c
        FROM nation WHERE n_nationkey < 12""",
    "crm_user": f"""SELECT 'U' || {text('p_partkey')} AS id, 'W' || {text('p_partkey')} AS mk_worker_bam_id,
        {pick('p_partkey', 'us', 'United States', 'US', 'CA')} AS country, CAST(CASE WHEN p_partkey % 6 = 0 THEN 0 ELSE 1 END AS INT) AS isactive
        FROM part WHERE p_partkey % 23 <> 9""",
    "crm_recordtype": f"SELECT 'RT' || {text('r_regionkey')} AS id FROM region WHERE r_regionkey < 3",
    # ---- ranking -----------------------------------------------------------------------------
    "kpi_metric_fact": f"""SELECT CASE WHEN o_orderkey % 45 = 0 THEN NULL ELSE {account('o_custkey - o_custkey % 2')} END AS mk_account_vnt_id,
        {_ODAY} AS dt, {pick('o_orderkey', *[b.title() for b in BRANDS], *BRANDS, 'RIVAL')} AS product_brand_name,
        {pick('o_orderkey', 'Units - Market', 'UNITS - MARKET', 'Other')} AS metric_name, o_orderkey % 90 + 1 AS metric_value,
        {pick('o_orderkey', 'Commercial', 'commercial', 'FREE')} AS free_comm, {pick('o_orderkey', 'Month', 'MONTH', 'month', 'WEEK')} AS time_type
        FROM orders""",
    "sma_digital_segment": f"""SELECT {account('o_custkey')} AS vnt_id, 'S' || {text('o_orderkey % 6')} AS digital_segment,
        {_ODAY} AS effective_start_date, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE {plus('2021-01-01', 'o_orderkey % 3')} END
        AS effective_end_date FROM orders WHERE o_orderkey % 4 = 0""",
    "ms_digital_segment": f"""SELECT {account('o_custkey')} AS mdm_id, CASE WHEN o_orderkey % 12 = 1 THEN NULL ELSE 'D' || {text('o_orderkey % 5')} END
        AS digital_segment, {_ODAY} AS eff_date FROM orders WHERE o_orderkey % 3 = 1""",
    "account_ms_dim": f"""SELECT {account('c_custkey')} AS mk_account_vnt_id, CASE WHEN c_custkey % 9 = 0 THEN NULL
        ELSE {text('c_custkey % 12')} END AS decile_rating, 'HS' || {text('c_custkey % 3')} AS hcp_segment FROM customer WHERE c_custkey % 2 = 0""",
    "engagement_segment": f"SELECT 'VNID' || {account('c_custkey')} AS mdm_id, 'CE' || {text('c_custkey % 4')} AS cust_eng_segment FROM customer WHERE c_custkey % 3 = 0",
    "engagement_score_tec": f"SELECT 'VNID' || {account('c_custkey')} AS mdm_id, {text('c_custkey % 100')} AS cust_eng_score FROM customer WHERE c_custkey % 4 = 0",
    "engagement_score_tys": f"SELECT 'VNID' || {account('c_custkey')} AS mdm_id, {text('c_custkey % 70')} AS cust_eng_score FROM customer WHERE c_custkey % 6 = 0",
    "party_first_source": f"""SELECT CASE WHEN c_custkey % 2 = 0 THEN 'VNID' || {account('c_custkey')} ELSE 'LH' || {text('c_custkey')} END AS mdm_id,
        'Lead ' || {text('c_custkey % 5')} AS lead_source, {plus('2016-01-01', 'c_custkey % 900')} AS lead_source_date
        FROM customer WHERE c_custkey % 3 <> 1""",
    # ---- affiliations, universe, field force -------------------------------------------------
    "parent_hco": f"""SELECT CASE WHEN o_orderkey % 55 = 0 THEN '-1' WHEN o_orderkey % 56 = 0 THEN NULL ELSE {account('o_custkey')} END AS mk_account_vnt_id,
        CASE WHEN o_orderkey % 57 = 0 THEN '-1' ELSE {account('o_custkey - o_custkey % 6 + o_orderkey % 3 + 1')} END AS mk_parent_account_vnt_id,
        CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE {moment(_ODAY, 'o_orderkey % 4')} END AS modified_date__v,
        {pick('o_orderkey', 'VALID', 'VALID', 'VALID', 'OLD')} AS record_state__v, {pick('o_orderkey', 'HCP_HCO', 'HCO_HCO')} AS hierarchy_type__v,
        {', '.join(f"{pick(f'o_orderkey + {i}', 'Y', 'N', None) if i == 0 else pick(f'o_orderkey + {i}', 'Primary__c', None, 'SECONDARY__C', 'N', 'odd')} AS {c}"
                   for i, c in enumerate(V.AFFILIATION_COLUMNS))}
        FROM orders""",
    "hco": f"""SELECT {account('c_custkey')} AS mk_account_vnt_id, {pick('c_custkey', '4:37', '1:1', '26:13', '2:2', '3:3')} AS hco_type__v,
        CASE WHEN c_custkey % 15 = 0 THEN NULL ELSE 'Corp ' || {text('c_custkey')} END AS corporate_name__v,
        {pick('c_custkey', 'Y', 'N', None)} AS ad_infusion_site__c, {pick('c_custkey', 'VALID', 'VALID', 'VALID', 'VALID', 'X')} AS record_state__v,
        {pick('c_custkey', 'A', 'A', 'I')} AS hco_status__v, {pick('c_custkey', 'US', 'US', 'US', 'CA')} AS primary_country__v
        FROM customer WHERE c_custkey % 8 <> 5""",
    "hcp": f"""SELECT {account('c_custkey')} AS mk_account_vnt_id, 'Name ' || {text('c_custkey')} AS formatted_name__v, {text('1000000 + c_custkey')} AS npi_num__v,
        'First' || {text('c_custkey % 20')} AS first_name__v, CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE c_name END AS last_name__v,
        {pick('c_custkey', 'M', 'F')} AS gender__v, {plus('1950-01-01', 'c_custkey % 9000')} AS birth_date__v,
        {pick('c_custkey', 'VALID', 'Valid', 'OLD')} AS record_state__v, {pick('c_custkey', 'A', 'a', 'A', 'I')} AS hcp_status__v
        FROM customer WHERE c_custkey % 3 <> 1""",
    "account_ad_dim": f"""SELECT CASE WHEN c_custkey % 83 = 1 THEN '-1' WHEN c_custkey % 79 = 1 THEN NULL ELSE {account('c_custkey')} END AS mk_account_vnt_id,
        {pick('c_custkey', 'HCP', 'HCP', 'Hco', 'HCP', 'OTHER')} AS account_class, {pick('c_custkey', 'Active', 'Inactive')} AS account_status_name,
        c_name AS account_name, {pick('c_custkey', 'A', 'B', 'NEW', 'Z', None, 'D')} AS biib_group__c, 'Site ' || {text('c_custkey % 9')} AS site_name,
        'Idn ' || {text('c_custkey % 5')} AS idn_name, {pick('c_custkey', 'Y', 'N')} AS insight_started, {pick('c_custkey', 'N', 'Y', None)} AS all_key_ques_answrd_flg,
        CASE WHEN c_custkey % 16 = 0 THEN NULL ELSE CAST(c_custkey % 101 AS DOUBLE) + 0.25 END AS perc_insights_completed,
        {pick('c_custkey', 'Target', 'None')} AS hcp_target_status, c_mktsegment AS primary_specialty_name, {NO_TEXT} AS secondary_specialty_name,
        {pick('c_custkey', 'Y', None)} AS biib_kme__c, {pick('c_custkey', 'N', 'Y')} AS ama_do_not_contact_flg, 'Terr ' || {text('c_custkey % 11')} AS tbm_terr_name,
        {text('1000000 + c_custkey')} AS npi_num, 'Line ' || {text('c_custkey')} AS address_line_1__v, {NO_TEXT} AS address_line_2__v,
        'City' || {text('c_custkey % 50')} AS city, 'AAL ' || {text('c_custkey % 7')} AS aal_employee_name, 'S' || {text('c_custkey % 50')} AS state_cd,
        'US' AS country__v, lpad({text('c_custkey')}, 5, '0') AS postal_code, 'ADRM ' || {text('c_custkey % 6')} AS adrm_employee_name,
        'TBM ' || {text('c_custkey % 8')} AS tbm_employee_name, 'W' AS willingness_capability_flag, {pick('c_custkey', 'N', 'Y', None)} AS pdrp_optout,
        c_name || '@x.org' AS email_1 FROM customer""",
    "target_hcp_list": f"""SELECT {text('1000000 + c_custkey')} AS npi, {pick('c_custkey', '12', '', '-', None)} AS patient_volume,
        {pick('c_custkey', '-', 'Initiator', '')} AS initiator_treator, {pick('c_custkey', '3', '-')} AS total_initiations,
        {pick('c_custkey', '', '44', None)} AS symptomatic_trx, {pick('c_custkey', '1', '10', '-', '')} AS composite_decile,
        {pick('c_custkey', 'N1', 'P3', '', '-', 'Q', None)} AS segment, {pick('c_custkey', '1', '0')} AS neuros, {pick('c_custkey', '0', '1', '0')} AS pcps
        FROM customer WHERE c_custkey % 7 <> 2""",
    "hcp_dim": f"""SELECT {account('c_custkey')} AS mk_account_vnt_id, 'p' || {text('c_custkey')} || '@y.org' AS email_1, {pick('c_custkey', 'q@y.org', None)} AS email_2
        FROM customer WHERE c_custkey % 3 <> 0""",
    "employee_to_territory": f"""SELECT 'Emp ' || {text('s_suppkey')} AS employee_name, 'T' || {text('s_suppkey')} AS territory_number,
        'Terr ' || {text('s_suppkey % 40')} AS territory_name, {pick('s_suppkey', *V.FIELD_FORCES_REPS, 'OTHER')} AS field_force_name,
        'W' || {text('s_suppkey - s_suppkey % 2')} AS mk_worker_bam_id,
        CASE WHEN s_suppkey % 20 < 14 THEN 'territory__aln' WHEN s_suppkey % 20 < 16 THEN 'region__aln' WHEN s_suppkey % 20 = 16 THEN 'division__aln'
             WHEN s_suppkey % 20 < 19 THEN 'nation__aln' ELSE 'zone__c' END AS territory_hierarchy_level,
        CASE WHEN s_suppkey % 27 = 0 THEN NULL ELSE ' Region ' || {text('s_suppkey % 3')} END AS region_name, 'login' || {text('s_suppkey')} AS employee_network_id,
        'R' || {text('s_suppkey % 3')} AS region_number, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'D' || {text('s_suppkey % 2')} END AS division_number,
        'Z' || {text('s_suppkey % 2')} AS zone_number, CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE 'N' || {text('s_suppkey % 2')} END AS nation_number,
        {pick('s_suppkey', 'Y', 'Y', 'Y', 'Y', 'Y', 'Y', 'N')} AS territory_active_flg,
        CAST(CASE WHEN s_suppkey % 19 = 1 THEN 2 ELSE 1 END AS INT) AS employee_territory_rank, {pick('s_suppkey', 'Active', 'ACTIVE', 'active')} AS position_status
        FROM supplier""",
    "geo_to_territory": f"""SELECT lpad({text('p_partkey')}, 5, '0') AS postal_code, ' terr ' || {text('p_partkey % 40')} AS territory_name,
        'REGION ' || {text('p_partkey % 3')} AS region_name, {pick('p_partkey', *[f.lower() for f in V.FIELD_FORCES_REPS], 'OTHER')} AS field_force_name,
        {pick('p_partkey', 'True_Curr', 'OLD')} AS alignment_type FROM part""",
    "account_to_territory": f"""SELECT CASE WHEN c_custkey % 47 = 0 THEN '-1' ELSE {account('c_custkey')} END AS mk_account_vnt_id,
        'T' || {text('c_custkey % 120')} AS territory_number, {pick('c_custkey', 'TRUE_CURR', 'true_curr', 'PAST')} AS alignment_type,
        {pick('c_custkey', *V.FIELD_FORCES, 'ad-tbm', 'NEURO')} AS field_force_name FROM customer""",
    "lab_result": f"""SELECT CASE WHEN o_orderkey % 35 = 0 THEN '-1' ELSE {account('o_custkey')} END AS mk_account_vnt_id, {_ODAY} AS result_date,
        'PT' || {text('o_custkey - o_custkey % 3')} AS patient_id, {pick('o_orderkey', 'Positive', 'NEGATIVE', 'negative', 'Unclear')} AS test_result,
        {pick('o_orderkey', 'Mayo', 'MAYO', 'LABCORP')} AS data_source FROM orders""",
    "shipment": f"""SELECT CASE WHEN l_orderkey % 29 = 0 THEN NULL WHEN l_orderkey % 31 = 0 THEN 'VNID-1' WHEN l_orderkey % 37 = 0 THEN 'ZIP' || {text('l_orderkey')}
             WHEN l_orderkey % 3 = 0 THEN 'A' || {text('l_suppkey')} ELSE 'VNID' || {account('l_partkey')} END AS account_1,
        {day('l_shipdate')} AS kpi_date, {pick('l_suppkey', V.ALZ_PRODUCT, V.ALZ_PRODUCT, 'Other')} AS kpi_product, l_quantity + 0.5 AS kpi_numerator,
        {pick('l_partkey', 'Commercial', 'COMMERCIAL', 'FREE')} AS referral_type, {pick('l_linenumber', 'ValueTrak', 'VALUETRAK')} AS data_source,
        {pick('l_suppkey', 'Day', 'DAY', 'WEEK')} AS time_type FROM lineitem""",
}

def needed_by(sql: str, known: dict[str, str]) -> list[str]:
    """Names from ``known`` that ``sql`` mentions, in definition order, with what those mention."""
    words = set(re.findall(r"\b[a-z_0-9]+\b", sql))
    out: list[str] = []
    for name in known:
        if name in words:
            out += [n for n in needed_by(known[name], {k: v for k, v in known.items() if k != name}) if n not in out]
            if name not in out:
                out.append(name)
    return out
