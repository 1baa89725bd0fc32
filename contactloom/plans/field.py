"""Field force: representatives, alignment, target list, field metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom import fixed_values as V
from contactloom.functions.scalar import as_date, blank_to_null, folded, friday_of_week, percent_text, tail
from contactloom.operators.aggregates import count_distinct, last_date, metric_rows, sum_by
from contactloom.operators.joins import left_lookup, level_managers, list_lookup, renamed_apart
from contactloom.plans.interactions import field_reps, product_calls

Frames = Mapping[str, DataFrame]


#: What a representative shares with the postal codes of the territory.
_PLACE = {"_region": "_r", "_territory": "_t", "_force": "_f"}


def representatives(t: Frames) -> DataFrame:
    """Representatives with territory, postal codes and two levels of supervisors."""
    geo = t["geo_to_territory"].filter(F.upper("alignment_type") == "TRUE_CURR").select(
        "postal_code", folded("region_name").alias("_r"), folded("territory_name").alias("_t"),
        F.upper("field_force_name").alias("_f"))
    rows = list_lookup(supervised(t, then=[(geo, _PLACE)]), geo, _PLACE, {"zip_code": "postal_code"})
    return rows.select("rep_id", "rep_name", "team_name", "territory_id", "territory_name", "region_name", "zip_code", "rep_login",
                       *[f"supervisor_level{n}_{part}" for n in (1, 2) for part in ("login", "name")])


def supervised(t: Frames, then: Sequence[tuple[DataFrame, Mapping[str, str]]] = ()) -> DataFrame:
    """Representatives with territory and two levels of supervisors, dealt for their result and that of the lookups ``then``."""
    staff = t["employee_to_territory"].filter(
        F.upper("field_force_name").isin(V.FIELD_FORCES_REPS) & (F.col("territory_active_flg") == "Y")
        & (F.col("employee_territory_rank") == 1) & (F.upper("position_status") == "ACTIVE"))
    # the second country literal of the source can never equal an upper-cased value
    users = t["crm_user"].filter((F.upper("country") == "US") & (F.col("isactive") > 0))
    rows = staff.filter(F.col("territory_hierarchy_level") == "territory__aln")
    rows = left_lookup(rows, users, {"mk_worker_bam_id": "mk_worker_bam_id"}, {"rep_id": "id"}, how="inner")
    # what a row says of itself is worked out before it meets its managers, once and not for each of them
    rows = rows.withColumns({"_region": folded("region_name"), "_territory": folded("territory_name"),
                             "_force": F.upper("field_force_name")})
    levels = {"region": "region__aln", "division": "division__aln", "nation": "nation__aln", "zone": "zone__c"}
    rows = level_managers(rows, staff, "field_force_name", "territory_hierarchy_level", [
        (value, f"{level}_number", {f"_{level}_login": "employee_network_id", f"_{level}_name": "employee_name"})
        for level, value in levels.items()], then=then)
    second = ("division", "nation", "zone")
    return rows.select(
        "rep_id", F.col("employee_name").alias("rep_name"), F.col("field_force_name").alias("team_name"),
        F.col("territory_number").alias("territory_id"), "territory_name", "region_name",
        F.col("employee_network_id").alias("rep_login"),
        F.col("_region_login").alias("supervisor_level1_login"),
        F.col("_region_name").alias("supervisor_level1_name"),
        F.coalesce(*[f"_{s}_login" for s in second]).alias("supervisor_level2_login"),
        F.coalesce(*[f"_{s}_name" for s in second]).alias("supervisor_level2_name"), *_PLACE)


def rep_alignment(t: Frames, reps: DataFrame) -> DataFrame:
    """Accounts with the representatives of their territory.  ``reps`` may come without postal codes (``supervised``), which say
    nothing about who they are."""
    accounts = t["account_to_territory"].filter(
        (F.upper("alignment_type") == "TRUE_CURR") & F.upper("field_force_name").isin(V.FIELD_FORCES)
        & (F.col("mk_account_vnt_id") != V.UNKNOWN_ID))
    people = reps.select("rep_name", "territory_id", "territory_name", "rep_id").distinct()
    rows = left_lookup(accounts.withColumn("territory_id", F.col("territory_number")), people,
                       {"territory_number": "territory_id"},
                       {"rep_id": "rep_id", "rep_name": "rep_name", "_territory": "territory_name"}, how="inner")
    return rows.select(F.col("mk_account_vnt_id").alias("customer_id"), F.lit(V.ALZ_PRODUCT).alias("product_name"),
                       "rep_id", "rep_name", "territory_id", F.col("_territory").alias("territory_name"))


def target_list(t: Frames) -> DataFrame:
    """Targeted professionals with the profile from the static list."""
    accounts = t["account_ad_dim"].filter((F.col("account_class") == "HCP")
                                          & F.col("biib_group__c").isin(V.TARGET_GROUPS)
                                          & F.col("mk_account_vnt_id").isNotNull())
    profile = "patient_volume initiator_treator total_initiations symptomatic_trx composite_decile".split()
    rows = left_lookup(accounts, t["target_hcp_list"], {"npi_num": "npi"},
                       {f"_{c}": c for c in (*profile, "segment", "neuros", "pcps")})
    rows = left_lookup(rows, t["hcp_dim"], {"mk_account_vnt_id": "mk_account_vnt_id"},
                       {"_email_1": "email_1", "_email_2": "email_2"})
    names = {"hcp": "account_name", "target_group": "biib_group__c", "ad_primary_account": "site_name",
             "health_system": "idn_name", "insight_started": "insight_started",
             "all_key_questions_answered": "all_key_ques_answrd_flg", "target_status": "hcp_target_status",
             "primary_specialty": "primary_specialty_name", "kme": "biib_kme__c",
             "ama_do_not_contact": "ama_do_not_contact_flg", "tbm_territory": "tbm_terr_name",
             "vnid": "mk_account_vnt_id", "npi_number": "npi_num", "address": "address_line_1__v", "city": "city",
             "aal": "aal_employee_name", "state": "state_cd", "zip": "postal_code", "adrm": "adrm_employee_name",
             "tbm": "tbm_employee_name", "email_1": "_email_1", "email_2": "_email_2"}
    return rows.select(
        *[F.col(old).alias(new) for new, old in names.items()],
        *[blank_to_null(f"_{c}").alias(c) for c in profile],
        percent_text("perc_insights_completed").alias("insights_complete_key_questions"),
        F.when(F.col("_neuros") == "1", "Neuro").when(F.col("_pcps") == "1", "PCP").alias("hcp_type"),
        blank_to_null("_segment", [""]).alias("segment"))


def non_promotional_metrics(t: Frames, as_of: date) -> DataFrame:
    """Test results, last call and shipments in the long metric layout."""
    tests = t["lab_result"].filter((F.col("mk_account_vnt_id") != V.UNKNOWN_ID) & (F.upper("data_source") == "MAYO"))
    tests = tests.withColumns({"bucket": friday_of_week("result_date"), "product": F.lit(V.ALZ_PRODUCT)})
    parts = []
    for metric, outcome in (("M101", "POSITIVE"), ("M102", "NEGATIVE")):
        counts = count_distinct(tests.filter(F.upper("test_result") == outcome),
                                ["mk_account_vnt_id", "product", "bucket"], "patient_id", "n")
        parts.append(metric_rows(counts, metric, V.METRICS[metric], "mk_account_vnt_id", "product", "bucket",
                                 F.col("n").cast("double")))
    calls = product_calls(t).filter((F.col("call_start_date") <= as_date(as_of))
                                    & (F.upper("account_type") == "HCP"))
    last = last_date(calls.withColumn("product", F.lit(V.ALZ_PRODUCT)), ["mk_account_vnt_id", "product"],
                     F.to_date("call_start_date"), "bucket")
    parts.append(metric_rows(last, "M103", V.METRICS["M103"], "mk_account_vnt_id", "product", "bucket",
                             F.lit(1.0)))
    shipped = t["shipment"].filter(
        (F.upper("referral_type") == "COMMERCIAL") & (F.upper("data_source") == "VALUETRAK")
        & (F.col("kpi_product") == V.ALZ_PRODUCT) & F.col("account_1").isNotNull()
        & (F.col("account_1") != "VNID-1") & (F.upper("time_type") == "DAY") & ~F.col("account_1").like("%ZIP%"))
    shipped = shipped.select(tail("account_1", 18).alias("customer"), friday_of_week("kpi_date").alias("bucket"),
                             "kpi_product", F.round("kpi_numerator").alias("n"))
    total = sum_by(shipped, ["customer", "kpi_product", "bucket"], "n", "n")
    parts.append(metric_rows(total, "M104", V.METRICS["M104"], "customer", "kpi_product", "bucket",
                             F.col("n").cast("double")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def promotional_metrics(t: Frames, as_of: date) -> DataFrame:
    """Last call per customer and representative.  The account type is compared as it stands."""
    calls = product_calls(t).filter((F.col("call_start_date") <= as_date(as_of)) & (F.col("account_type") == "HCP"))
    rows = left_lookup(calls, field_reps(t), {"employee_id": "mk_worker_bam_id"}, {"rep_id": "id"}, how="inner")
    last = last_date(rows, ["mk_account_vnt_id", "rep_id"], F.to_date("call_start_date"), "metric_value")
    return renamed_apart(last, {"customer_id": "mk_account_vnt_id", "rep_id": "rep_id",
                                "metric_value": "metric_value"}).withColumns({
        "product_name": F.lit(V.ALZ_PRODUCT), "metric_id": F.lit("M105"),
        "metric_name": F.lit(V.METRICS["M105"])})
