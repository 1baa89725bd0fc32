"""The professional and the patient workflow."""

from __future__ import annotations

import uuid

from checks.registry import AS_OF, Check
from checks.standins import quote
from contactloom import fixed_values as V
from contactloom.plans import patient as pat
from contactloom.plans import published
from contactloom.plans import professional as pro


def listing(values) -> str:
    return "(" + ", ".join(quote(v) for v in values) + ")"


# ---- shared SQL -----------------------------------------------------------------------------


def states(job: str) -> str:
    return f"""SELECT k.code_sk, k.code_name FROM code k JOIN domain_code d ON d.domain_sk = k.domain_fk
        CROSS JOIN (SELECT extract_date AS run_day FROM date_param WHERE etl_name = {quote(job)}) r
        WHERE d.domain_name = 'Record State' AND CASE WHEN run_day = DATE '2014-01-01' THEN k.code_name = 'ACTIVE'
        WHEN run_day > DATE '2014-01-01' THEN k.code_name IN ('ACTIVE', 'INACTIVE', 'DELETED') ELSE FALSE END"""


IN_AREA = f"""SELECT m.party_fk FROM party_market m JOIN therapeutic_area c ON c.therapeutic_area_sk = m.therapeutic_area_fk
    JOIN therapeutic_area p ON p.therapeutic_area_sk = c.parent_therapeutic_area_fk
    WHERE p.therapeutic_area IN {listing(V.HEM_PARENT_AREAS + V.MS_PARENT_AREAS)}"""
ACTIVE = "SELECT code_sk FROM code WHERE upper(trim(code_name)) = 'ACTIVE' AND upper(active_flg) = 'Y'"
#: The contact filters trim the flag as well (addresses and e-mails), the market filters do not.
ACTIVE_TRIMMED = "SELECT code_sk FROM code WHERE upper(trim(code_name)) = 'ACTIVE' AND upper(trim(active_flg)) = 'Y'"
ELIGIBLE = f"""SELECT DISTINCT u.party_fk, p.mdm_key FROM (SELECT party_fk FROM party_patient UNION SELECT party_fk FROM party_contact) u
    JOIN party p ON p.party_sk = u.party_fk JOIN country_code n ON n.country_sk = p.primary_country_fk
    JOIN party_market m ON m.party_fk = u.party_fk JOIN therapeutic_area c ON c.therapeutic_area_sk = m.therapeutic_area_fk
    JOIN therapeutic_area a ON a.therapeutic_area_sk = c.parent_therapeutic_area_fk
    WHERE trim(p.mdm_key) LIKE 'LH%' AND n.iso_2_cd = 'US' AND a.therapeutic_area IN ('NEUROLOGY', 'HEMATOLOGY')
    AND m.record_state_cd_fk IN ({ACTIVE}) AND c.record_state_cd_fk IN ({ACTIVE}) AND a.record_state_cd_fk IN ({ACTIVE})"""
PUBLISHED = ELIGIBLE.replace("JOIN country_code n", "JOIN rdm_country_code n")
BOUNCES = f"""SELECT customer_fk, min(CASE WHEN activity_type_fk = {V.BOUNCE_ACTIVITY_TYPE} AND soft_or_hard THEN time_dt END) AS bounce_date,
    CASE WHEN count(DISTINCT CASE WHEN hard THEN integration_key END) > 0
           OR count(DISTINCT CASE WHEN soft_or_hard AND NOT hard THEN integration_key END) > 2 THEN 1 ELSE 0 END AS bounce_flag
    FROM (SELECT f.*, d.time_dt, coalesce(attribute_5_name = 'BOUNCE_CATEGORY' AND attribute_5_value = 'Hard bounce', FALSE) AS hard,
          coalesce(attribute_5_name = 'BOUNCE_CATEGORY' AND attribute_5_value IN ('Hard bounce', 'Soft bounce'), FALSE) AS soft_or_hard
          FROM activity_fact f JOIN time_dim d ON d.time_sk = f.time_fk) marked GROUP BY customer_fk"""


def opts(filtered: bool) -> str:
    extra = f"AND upper(program_name) IN {listing(V.OPT_PROGRAMS)}" if filtered else ""
    return f"""SELECT s.party_fk, {'upper(program_name)' if filtered else 'program_name'} AS program_name, s.iw_flg,
        CASE WHEN s.iw_flg = 'N' THEN 'Y' ELSE 'N' END AS opt_out_flag, s.last_load_ts AS opt_out_date
        FROM iw_snapshot s JOIN iw_program g ON g.iw_program_sk = s.iw_program_fk JOIN iw_topic i ON i.iw_topic_sk = s.iw_topic_fk
        WHERE upper(s.channel_cd) = 'EMAIL' AND upper(i.topic_name) = 'INFORMATIONAL' {extra}
        QUALIFY row_number() OVER (PARTITION BY s.party_fk, s.iw_program_fk, s.iw_topic_fk
            ORDER BY s.last_load_ts DESC NULLS FIRST, s.iw_flg DESC NULLS FIRST) = 1"""


def bad_mail(c: str) -> str:
    t = f"trim({c})"
    return (f"({c} IS NULL OR {c} = '' OR ({t} <> '' AND (strpos({t}, ' ') > 0 OR right({t}, 1) = '.' OR strpos({t}, '.') = 0 "
            f"OR length({t}) - length(replace({t}, '@', '')) > 1 OR {c} = '.@')))")


def blocked(c: str) -> str:
    return "(" + " OR ".join(f"upper({c}) LIKE {quote(p)}" for p in V.BLOCKED_DOMAINS) + ")"


NEVER = "TIMESTAMP '9999-12-31 00:00:00'"
CAUSES = {"party_suppression_date": "TRUE", "opt_out_date": "opt_out_flag = 'Y'",
          "merge_record_date": "et_active = 'N'", "bounce_date": "bounce_flag = 1"}


def cause_sql(rows: str, clamped: list[str]) -> str:
    """Number the one cause that lies before the three others, then decode it."""
    arms = []
    for i, (name, cond) in enumerate(CAUSES.items()):
        others = " AND ".join(f"{name} < {o}" for o in CAUSES if o != name)
        arms.append(f"WHEN {others} AND {cond} THEN {i}")
    return f"""SELECT * EXCLUDE (cause), CASE WHEN suppression_criteria IN {listing(clamped)} AND source_dt < suppression_date
            THEN source_dt ELSE suppression_date END AS final_suppression_date,
            CASE WHEN source_dt > suppression_date THEN suppression_date ELSE source_dt END AS final_source_dt
        FROM (SELECT *, CASE cause WHEN 0 THEN party_suppression_date WHEN 1 THEN opt_out_date WHEN 2 THEN merge_record_date
                WHEN 3 THEN bounce_date ELSE source_dt END AS suppression_date,
            CASE cause WHEN 1 THEN coalesce(product_name, '') || ' Opt Out' WHEN 2 THEN 'Merged Record' WHEN 3 THEN 'Held Record'
                ELSE tmp_suppression_criteria END AS suppression_criteria,
            CASE WHEN cause = 1 THEN 'Opt table' WHEN cause = 2 THEN 'Merge Table' WHEN cause = 3 THEN 'Bounce Table'
                WHEN tmp_suppression_criteria <> 'Emailable Record' THEN 'Party Table' ELSE 'No Suppression' END AS suppression_source
            FROM (SELECT *, CASE {' '.join(arms)} END AS cause FROM ({rows}) dated) caused) done"""


def final_dates(party_reasons: list[str], created: str) -> str:
    return f"""CASE WHEN tmp_suppression_criteria IN {listing(party_reasons)} THEN CAST({created} AS TIMESTAMP)
        ELSE {NEVER} END AS party_suppression_date"""


def dated(column: str, off: str) -> str:
    return f"CASE WHEN {column} IS NULL OR {off} THEN {NEVER} ELSE CAST({column} AS TIMESTAMP) END"


# ---- professional ---------------------------------------------------------------------------

PRO_BASE = f"""SELECT h.* FROM party_hcp h JOIN country_code n ON n.country_sk = h.primary_country_cd_fk
    WHERE n.iso_3_cd = 'USA' AND h.party_fk IN ({IN_AREA})"""

PARTY_SQL = f"""SELECT DISTINCT p.party_sk, p.mdm_key, p.party_type_cd_fk, h.first_name, h.middle_name, h.last_name, h.title,
    h.hcp_type_cd_fk, h.practice_type_cd_fk, h.hcp_status_cd_fk, f.allowed_flg AS ama_opt_out_flag, h.record_state_cd_fk,
    p.created_dt AS create_dt, k1.code_name AS party_type, k2.code_name AS hcp_type, k3.code_name AS practice_type,
    k4.code_name AS hcp_status, k5.code_name AS record_state_cd, s.segment AS sma_hcp_segment
    FROM party p JOIN ({PRO_BASE}) h ON h.party_fk = p.party_sk
    LEFT JOIN (SELECT party_fk, allowed_flg FROM party_flag JOIN code ON code_sk = flag_type_cd_fk
               WHERE code_name = {quote(V.AMA_FLAG)}) f ON f.party_fk = p.party_sk
    LEFT JOIN code k1 ON k1.code_sk = p.party_type_cd_fk LEFT JOIN code k2 ON k2.code_sk = h.hcp_type_cd_fk
    LEFT JOIN code k3 ON k3.code_sk = h.practice_type_cd_fk LEFT JOIN code k4 ON k4.code_sk = h.hcp_status_cd_fk
    LEFT JOIN code k5 ON k5.code_sk = h.record_state_cd_fk
    LEFT JOIN (SELECT CASE WHEN length(mdm_id) >= 18 THEN right(mdm_id, 18) END AS id, sma_segment__c AS segment FROM sma_hcp_hco_raw
               QUALIFY row_number() OVER (PARTITION BY mdm_id ORDER BY sma_segment__c NULLS LAST) = 1) s ON s.id = p.mdm_key
    WHERE p.party_sk > 0 AND p.mdm_key IS NOT NULL AND h.record_state_cd_fk IN (SELECT code_sk FROM ({states(V.HCP_DATE_PARAM)}) x)"""

MARKET_SQL = f"""SELECT DISTINCT p.mdm_key AS mdm_id, m.party_market_sk AS party_market_id, c.therapeutic_area AS child_ta
    FROM party p JOIN v_party_hcp h ON h.party_fk = p.party_sk JOIN party_market m ON m.party_fk = h.party_fk
    JOIN therapeutic_area c ON c.therapeutic_area_sk = m.therapeutic_area_fk
    JOIN therapeutic_area a ON a.therapeutic_area_sk = c.parent_therapeutic_area_fk
    JOIN ({states(V.MARKET_DATE_PARAM)}) s ON s.code_name = h.record_state_cd
    WHERE p.party_sk > 0 AND p.mdm_key IS NOT NULL AND h.primary_country_cd = 'USA'
    AND a.therapeutic_area IN ('HEMATOLOGY', 'NEUROLOGY') AND upper(c.therapeutic_area) IN {listing(V.MARKET_AREAS)}"""

MERGE_SQL = f"""SELECT DISTINCT s.mdm_key AS new_mdm_id, l.mdm_key AS existing_mdm_id, upper(left(k.code_name, 3)) AS party_type,
    g.src_merge_dt, r.code_name AS record_status_cd
    FROM party_merge_map g JOIN party s ON s.party_sk = g.survivor_party_fk LEFT JOIN party l ON l.party_sk = g.non_survivor_party_fk
    JOIN code k ON k.code_sk = s.party_type_cd_fk LEFT JOIN code r ON r.code_sk = g.record_state_cd_fk
    JOIN ({PRO_BASE}) h ON h.party_fk = s.party_sk
    WHERE s.party_sk > 0 AND s.mdm_key IS NOT NULL AND k.code_name = 'HCP'
    AND h.record_state_cd_fk IN (SELECT code_sk FROM ({states(V.MERGE_DATE_PARAM)}) x)"""


def _lead_branch(area: str, tag: str) -> str:
    return f"""SELECT DISTINCT CAST(d.party_sk AS BIGINT) AS party_fk, m.mdm_id, coalesce(f.true_source, f.source_name) AS lead_source,
        CAST(f.create_dt AS TIMESTAMP) AS source_dt, m.child_ta, coalesce(e.comm_value, d.email_addr) AS party_email_address,
        CAST(NULL AS VARCHAR) AS nba_email_address, {tag} AS hcp_source
        FROM pro_market m JOIN party_dim d ON d.vnid = m.mdm_id JOIN first_source f ON f.party_fk = CAST(d.party_sk AS VARCHAR)
        LEFT JOIN comm_email e ON e.party_fk = f.party_fk WHERE m.child_ta = {quote(area)}"""


SOURCE_SQL = f"""WITH pro_party AS ({PARTY_SQL}), pro_market AS ({MARKET_SQL}), leads AS (
    {_lead_branch(V.AREA_MS, "'SFMC HCP'")} UNION ALL {_lead_branch(V.AREA_SMA, "CAST(NULL AS VARCHAR)")} UNION ALL
    SELECT DISTINCT CAST(coalesce(f.party_fk, b.prof_sk) AS BIGINT), b.prof_sk, coalesce(f.true_source, f.source_name, 'NBA HCP'),
        CAST(coalesce(f.create_dt, p.create_dt, DATE '2020-01-01') AS TIMESTAMP), {quote(V.AREA_MS)}, coalesce(e.comm_value, d.email_addr),
        b.email, 'NBA HCP' FROM nba_hcp b LEFT JOIN party_dim d ON d.vnid = b.prof_sk LEFT JOIN pro_party p ON p.mdm_key = b.prof_sk
        LEFT JOIN first_source f ON f.party_fk = CAST(p.party_sk AS VARCHAR) LEFT JOIN comm_email e ON e.party_fk = f.party_fk)
    SELECT leads.*, CASE product_name WHEN {quote(V.AREA_MS)} THEN {quote(V.MS_PROGRAM)} WHEN {quote(V.AREA_SMA)} THEN {quote(V.SMA_PROGRAM)}
        ELSE product_name END AS product_name FROM leads LEFT JOIN (SELECT DISTINCT product_name, therapeutic_area FROM hcp_marketing
        WHERE product_name IN {listing(V.MARKETED_PRODUCTS)}) g ON g.therapeutic_area = leads.child_ta"""

_NBA, _OWN = "nba_email_address", "party_email_address"
PRO_RESULT_SQL = f"""WITH pro_source AS ({SOURCE_SQL}), pro_p AS ({PARTY_SQL}), pro_merge AS ({MERGE_SQL}),
    joined AS (SELECT s.*, p.ama_opt_out_flag, p.create_dt, p.party_type, p.hcp_type, p.practice_type, p.hcp_status, p.record_state_cd,
        p.sma_hcp_segment, CASE WHEN g.existing_mdm_id IS NOT NULL THEN 'N' ELSE 'Y' END AS et_active, g.merged AS merged_at, b.bounce_flag,
        b.bounce_date AS bounced_at, o.iw_flg, o.opt_out_flag, o.opt_out_date AS opted_at
        FROM pro_source s LEFT JOIN pro_p p ON p.party_sk = s.party_fk
        LEFT JOIN (SELECT existing_mdm_id, min(src_merge_dt) AS merged FROM pro_merge GROUP BY 1) g ON g.existing_mdm_id = s.mdm_id
        LEFT JOIN ({BOUNCES}) b ON b.customer_fk = s.party_fk
        LEFT JOIN ({opts(False)}) o ON o.party_fk = s.party_fk AND o.program_name = s.product_name),
    judged AS (SELECT DISTINCT * EXCLUDE (mdm_id, merged_at, bounced_at, opted_at), mdm_id AS mdm_key,
        {dated('merged_at', "et_active <> 'N'")} AS merge_record_date, {dated('bounced_at', 'bounce_flag <> 1')} AS bounce_date,
        {dated('opted_at', "opt_out_flag <> 'Y'")} AS opt_out_date,
        CASE WHEN hcp_status <> 'Active' THEN 'Status Inactive' WHEN record_state_cd <> 'ACTIVE' THEN 'Record State Inactive'
        WHEN ama_opt_out_flag = 'Y' THEN 'AMA Opt Out' WHEN hcp_type NOT IN {listing(V.PRESCRIBER_TYPES)} THEN 'Non Prescribers'
        WHEN CASE hcp_source WHEN 'NBA HCP' THEN {bad_mail(_NBA)} WHEN 'SFMC HCP' THEN {bad_mail(_OWN)} END THEN {quote(V.BAD_EMAIL)}
        WHEN CASE hcp_source WHEN 'NBA HCP' THEN {blocked(_NBA)} WHEN 'SFMC HCP' THEN {blocked(_OWN)} END THEN {quote(V.BLOCKED)}
        WHEN et_active = 'N' THEN 'Merged Record' WHEN bounce_flag = 1 THEN 'Held Record'
        WHEN opt_out_flag = 'Y' THEN coalesce(product_name, '') || ' Opt Out' ELSE 'Emailable Record' END AS tmp_suppression_criteria
        FROM joined)
    SELECT *, 'HCP' AS wf_customer_type FROM ({cause_sql(
        f"SELECT *, {final_dates(V.PARTY_REASONS_PROFESSIONAL, 'create_dt')} FROM judged", V.CLAMP_PROFESSIONAL)}) z"""

# ---- patient --------------------------------------------------------------------------------


def letter(c: str) -> str:
    return f"CASE trim({c}) WHEN 'ACTIVE' THEN 'A' WHEN 'DELETED' THEN 'D' WHEN 'INACTIVE' THEN 'I' END"


PHONE_SQL = """SELECT party_fk, comm_value FROM party_communication WHERE communication_type_cd_fk IN
    (SELECT code_sk FROM code WHERE upper(code_name) LIKE '%PHONE_1%') AND record_state_cd_fk IN
    (SELECT code_sk FROM code WHERE upper(code_name) = 'ACTIVE' AND upper(active_flg) = 'Y')
    QUALIFY row_number() OVER (PARTITION BY party_fk ORDER BY effective_dt DESC NULLS FIRST, integration_key DESC) = 1"""
MAIL_SQL = f"""SELECT party_fk, comm_value FROM party_communication WHERE (communication_type_cd_fk IN
    (SELECT code_sk FROM code WHERE upper(trim(code_name)) LIKE '%EMAIL_1%') AND primary_flg = 'Y' AND bounced_inform_flg = 'N')
    OR (bounced_inform_flg IS NULL AND record_state_cd_fk IN ({ACTIVE_TRIMMED}))
    QUALIFY row_number() OVER (PARTITION BY party_fk ORDER BY effective_dt DESC NULLS FIRST, integration_key DESC) = 1"""
HOME_SQL = f"""SELECT * FROM party_address WHERE primary_address_flg = 'Y' AND current_flg = 'Y' AND bounced_inform_flg = 'N'
    AND record_state_cd_fk IN ({ACTIVE_TRIMMED})
    QUALIFY row_number() OVER (PARTITION BY party_fk ORDER BY last_load_ts DESC NULLS FIRST, integration_key DESC) = 1"""
PATIENT_SQL = f"""SELECT DISTINCT 'PAT' AS feed_origin, t.party_fk, e.mdm_key AS party_master_id, t.salutation, t.first_name, t.middle_name,
    t.last_name, t.title, t.suffix, g.code_name AS gender_code, t.birth_dt AS birth_date,
    floor(date_diff('day', t.birth_dt, DATE '{AS_OF}') / 365.2425) AS age, y.code_name AS patient_type_code, h.address_line_1, h.address_line_2,
    h.country_name, h.state_name, h.county_name, h.city_name, h.postal_cd AS postal_code, 'PAT' AS party_type,
    CASE WHEN strpos(c.code_name, ',') > 1 THEN split_part(c.code_name, ',', 1) ELSE c.code_name END AS patient_class,
    f.comm_value AS phone_number, m.comm_value AS primary_email, t.last_load_ts AS create_date, 'N' AS suppressed_code,
    {letter('r.code_name')} AS record_state, TIMESTAMP '{AS_OF} 00:00:00' AS last_load_ts
    FROM ({ELIGIBLE}) e JOIN party_patient t ON t.party_fk = e.party_fk JOIN party p ON p.party_sk = e.party_fk
    LEFT JOIN code g ON g.code_sk = t.gender_cd_fk LEFT JOIN code y ON y.code_sk = t.patient_type_cd_fk
    LEFT JOIN code c ON c.code_sk = p.party_subtype_cd_fk LEFT JOIN code r ON r.code_sk = t.record_state_cd_fk
    LEFT JOIN ({HOME_SQL}) h ON h.party_fk = e.party_fk LEFT JOIN ({PHONE_SQL}) f ON f.party_fk = e.party_fk
    LEFT JOIN ({MAIL_SQL}) m ON m.party_fk = e.party_fk WHERE e.party_fk > 0"""
PAT_MARKET_SQL = f"""SELECT DISTINCT m.party_fk AS party_sk, c.therapeutic_area AS child_therapeutic_area FROM party_market m
    JOIN ({PUBLISHED}) e ON e.party_fk = m.party_fk JOIN product_brand b ON b.product_brand_sk = m.product_brand_fk
    JOIN therapeutic_area c ON c.therapeutic_area_sk = m.therapeutic_area_fk
    JOIN therapeutic_area a ON a.therapeutic_area_sk = c.parent_therapeutic_area_fk
    WHERE a.therapeutic_area IN ('NEUROLOGY', 'HEMATOLOGY') AND c.parent_therapeutic_area_fk <> -1
    AND c.therapeutic_area IN {listing(V.MARKET_AREAS)}"""

BAND = """CASE WHEN age < 13 THEN 'Pediatric' WHEN age < 18 THEN 'Adolscent' WHEN age IS NOT NULL THEN 'Adult'
    WHEN answer = 'AGE_RANGE_0_12' THEN 'Pediatric' WHEN answer = 'AGE_RANGE_13_17' THEN 'Adolscent'
    WHEN answer = 'AGE_RANGE_ADULT' THEN 'Adult' END"""
SEGMENT = """CASE WHEN role IN ('CAREGIVER', 'PATIENT') AND band IS NOT NULL
        THEN CASE role WHEN 'CAREGIVER' THEN 'Caregiver of ' ELSE '' END || band || ' Patient'
    WHEN role IN ('CAREGIVER', 'PATIENT') THEN 'Other ' || CASE role WHEN 'CAREGIVER' THEN 'Caregivers' ELSE 'Patients' END ||
        CASE WHEN web = 1 THEN ' who are Web-Registered' ELSE ' and not Web-Registered' END
    WHEN role IS NOT NULL AND web = 1 THEN 'Others who are Web-Registered' ELSE 'Others who are not Web-Registered' END"""
STAGE = """CASE WHEN injected IS NOT NULL THEN 'Retention' WHEN referred IS NOT NULL THEN 'Queued' ELSE 'Acquisition' END"""


def _site_branch(product: str, site: str) -> str:
    return f"""SELECT party_fk, lead_source, source_dt, area, {quote(product)}, NULL, {SEGMENT}, {STAGE} FROM (
        SELECT l.*, upper(p.patient_class) AS role, p.age, v.response_value AS answer, w.web, q.first_injection_date AS injected,
        q.referral_received_date AS referred, {BAND} AS band FROM leads l JOIN pat_party p ON p.party_fk = l.party_fk
        LEFT JOIN (SELECT r.party_fk, a.response_value FROM survey_answer a JOIN survey_response r ON r.survey_response_sk = a.survey_response_fk
            WHERE a.response_value LIKE '%AGE_RANGE%' AND r.party_fk IN (SELECT party_fk FROM pat_party)
            QUALIFY row_number() OVER (PARTITION BY r.party_fk ORDER BY r.response_dt DESC NULLS FIRST, a.response_answer_sk DESC) = 1) v
            ON v.party_fk = l.party_fk
        LEFT JOIN (SELECT customer_fk, source_cd, 1 AS web FROM activity_fact JOIN activity_type_dim ON activity_type_sk = activity_type_fk
            WHERE source_cd LIKE 'WEB_NEURO' AND activity_type_name IN ('LOGIN', 'WEB REG') AND attribute_2_value = {quote(site)}
            GROUP BY 1, 2) w ON w.customer_fk = l.party_fk
        LEFT JOIN campaign_variables q ON q.mdmid = p.party_master_id WHERE l.area = {quote(V.AREA_SMA)}) staged"""


PAT_SOURCE_SQL = f"""WITH pat_party AS ({PATIENT_SQL}), pat_market AS ({PAT_MARKET_SQL}), leads AS (
    SELECT CAST(f.party_fk AS BIGINT) AS party_fk, coalesce(f.true_source, f.source_name) AS lead_source, f.create_dt AS source_dt, a.area
    FROM first_source f JOIN (SELECT party_sk, CASE WHEN bool_and(child_therapeutic_area = {quote(V.AREA_MS)}) THEN {quote(V.AREA_MS)}
        ELSE {quote(V.AREA_SMA)} END AS area FROM pat_market GROUP BY 1) a ON CAST(a.party_sk AS VARCHAR) = f.party_fk),
    segs AS (SELECT DISTINCT s.party_fk, s.code_value, s.product_brand_fk, m.product_name FROM party_segmentation s
        LEFT JOIN marketing_product m ON m.product_sk = s.product_brand_fk WHERE s.segmentation_cd = {quote(V.LEAD_TYPE)})
    SELECT l.party_fk, l.lead_source, l.source_dt, l.area AS child_therapeutic_area, s.product_name, {quote(V.LEAD_TYPE)} AS segmentation_cd,
        s.code_value AS pat_segment, CAST(NULL AS VARCHAR) AS stream FROM leads l JOIN segs s ON s.party_fk = l.party_fk WHERE l.area = {quote(V.AREA_MS)}
    UNION ALL SELECT l.party_fk, l.lead_source, l.source_dt, l.area, {quote(V.MS_PROGRAM)}, {quote(V.LEAD_TYPE)},
        CASE WHEN s.is_patient THEN 'PATIENT' ELSE 'NONE' END, NULL FROM leads l
        JOIN (SELECT party_fk, bool_or(coalesce(upper(code_value) = 'PATIENT', FALSE)) AS is_patient FROM segs GROUP BY 1) s ON s.party_fk = l.party_fk
        WHERE l.area = {quote(V.AREA_MS)}
    UNION ALL SELECT l.party_fk, l.lead_source, l.source_dt, l.area, {quote(V.MS_NEW_BRAND)}, {quote(V.LEAD_TYPE)}, 'NONE', NULL FROM leads l
        WHERE l.area = {quote(V.AREA_MS)} AND NOT EXISTS (SELECT 1 FROM segs s WHERE s.party_fk = l.party_fk
        AND upper(s.product_name) = {quote(V.MS_NEW_BRAND)})
    UNION ALL {' UNION ALL '.join(_site_branch(p, s) for p, s in V.SMA_WEB_SITES.items())}"""

PAT_MERGE_SQL = f"""SELECT DISTINCT 'PAT' AS feed_origin, s.mdm_key AS new_mdm_id, l.mdm_key AS existing_mdm_id, 'PAT' AS party_type,
    strftime(g.src_merge_dt, '%m/%d/%Y %H:%M:%S') AS date_of_merge, {letter('r.code_name')} AS record_state, TIMESTAMP '{AS_OF} 00:00:00' AS archival_ts
    FROM party_merge_map g LEFT JOIN (SELECT * FROM party WHERE mdm_key LIKE 'LH%') s ON s.party_sk = g.survivor_party_fk
    LEFT JOIN (SELECT * FROM party WHERE mdm_key LIKE 'LH%') l ON l.party_sk = g.non_survivor_party_fk
    LEFT JOIN code r ON r.code_sk = g.record_state_cd_fk WHERE g.survivor_party_fk IN (SELECT party_fk FROM ({PUBLISHED}) e)"""

PAT_RESULT_SQL = f"""WITH pat_source AS ({PAT_SOURCE_SQL}), pat_p AS ({PATIENT_SQL}), pat_merge AS ({PAT_MERGE_SQL}),
    joined AS (SELECT p.party_fk, p.party_master_id, s.product_name, s.pat_segment, p.birth_date, p.patient_type_code AS party_type_code,
        p.party_type, p.patient_class AS party_class, s.stream, p.primary_email, p.suppressed_code, p.record_state, p.age, s.lead_source,
        s.child_therapeutic_area AS therapeutic_area, p.feed_origin, o.iw_flg, o.opt_out_flag, b.bounce_flag,
        CASE WHEN g.existing_mdm_id IS NULL THEN 'Y' ELSE 'N' END AS et_active, p.create_date, CAST(s.source_dt AS TIMESTAMP) AS source_dt,
        {dated('o.opt_out_date', "o.opt_out_flag <> 'Y'")} AS opt_out_date, {dated('g.merged', 'FALSE')} AS merge_record_date,
        {dated('b.bounce_date', 'b.bounce_flag <> 1')} AS bounce_date
        FROM pat_source s JOIN pat_p p ON p.party_fk = s.party_fk
        LEFT JOIN (SELECT DISTINCT * FROM ({opts(True)}) w) o ON o.party_fk = s.party_fk AND o.program_name = upper(s.product_name)
        LEFT JOIN ({BOUNCES}) b ON b.customer_fk = s.party_fk
        LEFT JOIN (SELECT existing_mdm_id, min(strptime(date_of_merge, '%m/%d/%Y %H:%M:%S')) AS merged FROM pat_merge GROUP BY 1) g
            ON g.existing_mdm_id = p.party_master_id),
    judged AS (SELECT *, CASE WHEN record_state <> 'A' THEN 'Record State Inactive' WHEN feed_origin <> 'PAT' THEN 'Feed Origin Suppression'
        WHEN party_type <> 'PAT' THEN 'Party Type Suppression' WHEN party_class NOT IN {listing(V.PATIENT_CLASSES)} THEN 'Patient Class Suppression'
        WHEN suppressed_code <> 'N' THEN 'Suppressed Record' WHEN {bad_mail('primary_email')} THEN {quote(V.BAD_EMAIL)}
        WHEN age < 18 OR pat_segment IN {listing(V.MINOR_SEGMENTS)} THEN 'Invalid Age' WHEN {blocked('primary_email')} THEN {quote(V.BLOCKED)}
        WHEN et_active = 'N' THEN 'Merged Record' WHEN opt_out_flag = 'Y' THEN coalesce(product_name, '') || ' Opt Out'
        WHEN bounce_flag = 1 THEN 'Held Record' ELSE 'Emailable Record' END AS tmp_suppression_criteria FROM joined)
    SELECT *, 'Patient' AS wf_customer_type FROM ({cause_sql(
        f"SELECT *, {final_dates(V.PARTY_REASONS_PATIENT, 'create_date')} FROM judged", V.CLAMP_PATIENT)}) z"""

_DATES = ("opt_out_date merge_record_date bounce_date party_suppression_date suppression_date final_suppression_date "
          "final_source_dt source_dt")

def published_suppression(t):
    """The patient workflow stored as tables; its last result is read by name."""
    spark = t["orders"].sparkSession
    prefix = f"patient_{uuid.uuid4().hex[:8]}"
    published.publish_patient(spark, t, AS_OF, prefix)
    return spark.table(f"{prefix}_suppression")


CHECKS = {
    "professional_party_base": Check(pro.professional_party, PARTY_SQL, texts="create_dt",
                                     ints="party_sk party_type_cd_fk hcp_type_cd_fk practice_type_cd_fk hcp_status_cd_fk record_state_cd_fk", doubles="hcp_type_cd_fk"),
    "professional_market": Check(pro.professional_market, MARKET_SQL),
    "professional_merge_map": Check(pro.professional_merge, MERGE_SQL, texts="src_merge_dt"),
    "professional_source": Check(lambda t: pro.professional_workflow(t)["source"], SOURCE_SQL, texts="source_dt"),
    "professional_suppression": Check(lambda t: pro.professional_workflow(t)["suppression"], PRO_RESULT_SQL,
                                      texts=f"{_DATES} create_dt", doubles="bounce_flag"),
    "patient_party_base": Check(lambda t: pat.patient_party(t, AS_OF), PATIENT_SQL, doubles="age",
                                texts="birth_date create_date last_load_ts"),
    "patient_market": Check(pat.patient_market, PAT_MARKET_SQL),
    "patient_source": Check(lambda t: pat.patient_workflow(t, AS_OF)["source"], PAT_SOURCE_SQL, texts="source_dt"),
    "patient_merge_records": Check(lambda t: pat.patient_merge(t, AS_OF), PAT_MERGE_SQL, texts="archival_ts"),
    "published_patient_suppression": Check(published_suppression, PAT_RESULT_SQL, texts=f"{_DATES} create_date birth_date", doubles="age bounce_flag"),
    "patient_suppression": Check(lambda t: pat.patient_workflow(t, AS_OF)["suppression"], PAT_RESULT_SQL,
                                 texts=f"{_DATES} create_date birth_date", doubles="age bounce_flag"),
    "home_address": Check(pat.home_address, f"SELECT party_fk, address_line_1, address_line_2, country_name, state_name, county_name, "
                          f"city_name, postal_cd FROM ({HOME_SQL}) h"),
    "latest_contact_phone": Check(lambda t: pat.contact_rows(t, "phone"), PHONE_SQL),
    "latest_contact_email": Check(lambda t: pat.contact_rows(t, "email"), MAIL_SQL),
}
