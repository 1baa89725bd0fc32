"""Patient suppression workflow: party base, market, source, merges, result."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom import fixed_values as V
from contactloom.functions.engagement import journey_stage, patient_segment
from contactloom.functions.scalar import age_years, as_date, before_comma, folded, like_any, whole_number
from contactloom.operators.aggregates import flag_lattice
from contactloom.operators.joins import decode, keep_matching, left_lookup, renamed_apart, without_match
from contactloom.operators.pick import first_merge, first_per_key, latest_contact, newest
from contactloom.operators.suppression import (cause_date, clamp_dates, earliest_cause, party_date,
                                               patient_rules, suppression_reason)
from contactloom.plans.party import (Frames, active_codes, area_path, bounces, eligible_persons,
                                     opt_states, record_letter)
from contactloom.sources.tables import settle

_ADDRESS = ("address_line_1 address_line_2 country_name state_name county_name city_name "
            "postal_cd").split()


def contact_rows(t: Frames, kind: str) -> DataFrame:
    """Latest phone or e-mail per party.  The e-mail filter binds as
    (type and primary and not bounced) or (bounce unknown and active), without the brackets one
    might expect around the bounce test."""
    names = folded("code_name") if kind == "email" else F.upper("code_name")
    pattern = "%EMAIL_1%" if kind == "email" else "%PHONE_1%"
    typed = t["code"].filter(names.like(pattern)).select("code_sk").distinct()
    active = active_codes(t, trim=kind == "email", trim_flag=kind == "email").distinct()
    rows = t["party_communication"]
    if kind == "email":
        rows = left_lookup(rows, typed, {"communication_type_cd_fk": "code_sk"}, {"_typed": "code_sk"})
        rows = left_lookup(rows, active, {"record_state_cd_fk": "code_sk"}, {"_active": "code_sk"})
        usable = (F.col("_typed").isNotNull() & (F.col("primary_flg") == "Y")
                  & (F.col("bounced_inform_flg") == "N"))
        unknown = F.col("bounced_inform_flg").isNull() & F.col("_active").isNotNull()
        rows = rows.filter(usable | unknown)
    else:
        rows = keep_matching(rows, typed, "communication_type_cd_fk", "code_sk", unique=True)
        rows = keep_matching(rows, active, "record_state_cd_fk", "code_sk", unique=True)
    return latest_contact(rows, "party_fk", "effective_dt", "integration_key").select(
        "party_fk", "comm_value")


def home_address(t: Frames) -> DataFrame:
    usable = t["party_address"].filter((F.col("primary_address_flg") == "Y")
                                       & (F.col("current_flg") == "Y")
                                       & (F.col("bounced_inform_flg") == "N"))
    usable = keep_matching(usable, active_codes(t, trim_flag=True), "record_state_cd_fk", "code_sk", unique=True)
    return latest_contact(usable, "party_fk", "last_load_ts", "integration_key").select(
        "party_fk", *_ADDRESS)


def patient_party(t: Frames, as_of: date) -> DataFrame:
    patients = t["party_patient"]
    people = eligible_persons(t).filter(F.col("party_fk") > 0)
    rows = left_lookup(patients, people, {"party_fk": "party_fk"}, {"party_master_id": "mdm_key"},
                       how="inner")
    # traits are looked up by party, so a party with two patient rows sees both of its values
    gender = decode(patients, t["code"], {"gender_cd_fk": "_value"}).select(
        "party_fk", "gender_cd_fk", "_value").distinct()
    kind = decode(patients, t["code"], {"patient_type_cd_fk": "_value"}).select(
        "party_fk", "patient_type_cd_fk", "_value").distinct()
    role = decode(keep_matching(t["party"], patients, "party_sk", "party_fk"), t["code"],
                  {"party_subtype_cd_fk": "_name"}).select(
        F.col("party_sk").alias("party_fk"), "party_subtype_cd_fk",
        before_comma("_name").alias("_value")).distinct()
    for dim, out in ((gender, "gender_code"), (kind, "patient_type_code"), (role, "patient_class")):
        rows = left_lookup(rows, dim, {"party_fk": "party_fk"}, {out: "_value"})
    rows = left_lookup(rows, home_address(t), {"party_fk": "party_fk"}, {c: c for c in _ADDRESS})
    rows = left_lookup(rows, contact_rows(t, "phone"), {"party_fk": "party_fk"},
                       {"phone_number": "comm_value"})
    rows = left_lookup(rows, contact_rows(t, "email"), {"party_fk": "party_fk"},
                       {"primary_email": "comm_value"})
    rows = decode(rows, t["code"], {"record_state_cd_fk": "_state"})
    own = "salutation first_name middle_name last_name title suffix".split()
    return rows.select(
        F.lit("PAT").alias("feed_origin"), "party_fk", "party_master_id", *own, "gender_code",
        F.to_date("birth_dt").alias("birth_date"),
        age_years(F.to_date("birth_dt"), as_of).alias("age"), "patient_type_code",
        *_ADDRESS[:-1], F.col("postal_cd").alias("postal_code"), F.lit("PAT").alias("party_type"),
        "patient_class", "phone_number", "primary_email", F.col("last_load_ts").alias("create_date"),
        F.lit("N").alias("suppressed_code"), record_letter("_state").alias("record_state"),
        as_date(as_of).cast("timestamp").alias("last_load_ts")).distinct()


def market_persons(t: Frames) -> DataFrame:
    """Eligible persons by the published country table, which market and merge records go by."""
    return eligible_persons(t, "rdm_country_code").select("party_fk")


def patient_market(t: Frames, people: DataFrame | None = None) -> DataFrame:
    market = keep_matching(t["party_market"], market_persons(t) if people is None else people, "party_fk")
    market = keep_matching(market, t["product_brand"], "product_brand_fk", "product_brand_sk", unique=True)
    rows = area_path(t, market).filter((F.col("_parent_fk") != -1)
                                       & F.col("parent_ta").isin(V.PARENT_AREAS)
                                       & F.col("child_ta").isin(V.MARKET_AREAS))
    return rows.select(F.col("party_fk").alias("party_sk"),
                       F.col("child_ta").alias("child_therapeutic_area")).distinct()


def _survey_ages(t: Frames, party: DataFrame) -> DataFrame:
    answers = t["survey_answer"].filter(F.col("response_value").like("%AGE_RANGE%"))
    rows = left_lookup(answers, t["survey_response"], {"survey_response_fk": "survey_response_sk"},
                       {"party_fk": "party_fk", "response_dt": "response_dt"}, how="inner")
    rows = keep_matching(rows, party, "party_fk")
    return first_per_key(rows, ["party_fk"], [newest("response_dt"), newest("response_answer_sk")])


def _web_registrations(t: Frames) -> DataFrame:
    """Customers who logged in or registered, per site.  Only existence matters: distinct keys
    replace the newest-row window of the source."""
    kinds = t["activity_type_dim"].filter(F.col("activity_type_name").isin("LOGIN", "WEB REG"))
    visits = t["activity_fact"].filter(F.col("source_cd").like("WEB_NEURO")
                                       & F.col("attribute_2_value").isin(*V.SMA_WEB_SITES.values()))
    visits = keep_matching(visits, kinds, "activity_type_fk", "activity_type_sk", unique=True)
    return visits.select("customer_fk", "source_cd",
                         F.col("attribute_2_value").alias("site")).distinct()


def patient_source(t: Frames, party: DataFrame, market: DataFrame) -> DataFrame:
    """Five branches over the parties' lead source: three for one area, two for the other."""
    area = market.groupBy("party_sk").agg(
        F.max(F.when(F.col("child_therapeutic_area") == V.AREA_MS, 0).otherwise(1)).alias("_other"))
    area = area.select("party_sk", F.when(F.col("_other") == 1, V.AREA_SMA).otherwise(V.AREA_MS)
                       .alias("child_therapeutic_area"))
    leads = left_lookup(t["first_source"].withColumn("lead_source", F.coalesce("true_source", "source_name")),
                        area, {"party_fk": "party_sk"},
                        {"child_therapeutic_area": "child_therapeutic_area"}, how="inner")
    leads = leads.select(whole_number("party_fk").alias("party_fk"), "lead_source", F.col("create_dt").alias("source_dt"),
                         "child_therapeutic_area")
    ms = leads.filter(F.col("child_therapeutic_area") == V.AREA_MS)
    sma = leads.filter(F.col("child_therapeutic_area") == V.AREA_SMA)

    typed = t["party_segmentation"].filter(F.col("segmentation_cd") == V.LEAD_TYPE)
    by_product = left_lookup(
        typed.select("party_fk", "code_value", "product_brand_fk", "segmentation_cd").distinct(),
        t["marketing_product"], {"product_brand_fk": "product_sk"},
        {"product_name": "product_name"}).distinct()
    columns = ["party_fk", "lead_source", "source_dt", "child_therapeutic_area", "product_name",
               "segmentation_cd", "pat_segment", "stream"]
    no_text = F.lit(None).cast("string")

    segmented = left_lookup(ms, by_product, {"party_fk": "party_fk"},
                            {"product_name": "product_name", "segmentation_cd": "segmentation_cd",
                             "pat_segment": "code_value"}, how="inner").withColumn("stream", no_text)
    # the weight of 2 is never decoded, so a prospect ends as NONE
    weights = flag_lattice(typed, ["party_fk"], F.upper("code_value"), {"PATIENT": 3, "PROSPECT": 2},
                           1, "_weight")
    overall = left_lookup(ms, weights, {"party_fk": "party_fk"}, {"_weight": "_weight"}, how="inner")
    overall = overall.withColumns({
        "product_name": F.lit(V.MS_PROGRAM), "segmentation_cd": F.lit(V.LEAD_TYPE),
        "pat_segment": F.when(F.col("_weight") == 3, "PATIENT").otherwise("NONE"), "stream": no_text})
    have = by_product.filter(F.upper("product_name") == V.MS_NEW_BRAND)
    missing = without_match(ms, have, "party_fk", "party_fk").withColumns({
        "product_name": F.lit(V.MS_NEW_BRAND), "segmentation_cd": F.lit(V.LEAD_TYPE),
        "pat_segment": F.lit("NONE"), "stream": no_text})

    people = left_lookup(sma, party, {"party_fk": "party_fk"},
                         {"patient_class": "patient_class", "age": "age",
                          "party_master_id": "party_master_id"}, how="inner")
    people = left_lookup(people, _survey_ages(t, party), {"party_fk": "party_fk"},
                         {"_answer": "response_value"})
    people = left_lookup(people, t["campaign_variables"], {"party_master_id": "mdmid"},
                         {"_injected": "first_injection_date", "_referred": "referral_received_date"})
    # one row per program, each with its own web site
    programs = F.array(*[F.struct(F.lit(p).alias("product_name"), F.lit(s).alias("site"))
                         for p, s in V.SMA_WEB_SITES.items()])
    people = people.withColumn("_program", F.explode(programs)).select("*", "_program.*")
    people = left_lookup(people, _web_registrations(t).withColumn("_web", F.lit(1)),
                         {"party_fk": "customer_fk", "site": "site"}, {"_web": "_web"})
    staged = people.withColumns({
        "segmentation_cd": no_text,
        "pat_segment": patient_segment("patient_class", "age", "_answer", "_web"),
        "stream": journey_stage("_injected", "_referred")})
    parts = [p.select(*columns) for p in (segmented, overall, missing, staged)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def patient_merge(t: Frames, as_of: date, people: DataFrame | None = None) -> DataFrame:
    """Merged person keys with the merge date as text, and when the records were made."""
    rows = keep_matching(t["party_merge_map"], market_persons(t) if people is None else people, "survivor_party_fk", "party_fk")
    persons = t["party"].filter(like_any("mdm_key", [V.PERSON_PREFIX + "%"]))
    rows = left_lookup(rows, persons, {"survivor_party_fk": "party_sk"}, {"new_mdm_id": "mdm_key"})
    rows = left_lookup(rows, persons, {"non_survivor_party_fk": "party_sk"}, {"existing_mdm_id": "mdm_key"})
    rows = decode(rows, t["code"], {"record_state_cd_fk": "_state"})
    return rows.select(F.lit("PAT").alias("feed_origin"), "new_mdm_id", "existing_mdm_id",
                       F.lit("PAT").alias("party_type"),
                       F.date_format("src_merge_dt", "MM/dd/yyyy HH:mm:ss").alias("date_of_merge"),
                       record_letter("_state").alias("record_state"),
                       as_date(as_of).cast("timestamp").alias("archival_ts")).distinct()


def patient_suppression(t: Frames, source: DataFrame, party: DataFrame, merge: DataFrame) -> DataFrame:
    traits = ("party_master_id birth_date patient_type_code party_type patient_class primary_email "
              "suppressed_code record_state age feed_origin create_date").split()
    rows = left_lookup(source, party, {"party_fk": "party_fk"}, {c: c for c in traits}, how="inner")
    opts = opt_states(t, keep_programs=True).withColumn("program_name", F.upper("program_name")).distinct()
    rows = left_lookup(rows.withColumn("_product", F.upper("product_name")), opts,
                       {"party_fk": "party_fk", "_product": "program_name"},
                       {c: c for c in ("iw_flg", "opt_out_flag", "opt_out_date")})
    rows = left_lookup(rows, bounces(t), {"party_fk": "customer_fk"},
                       {"bounce_flag": "bounce_flag", "bounce_date": "bounce_date"})
    merged_at = F.to_timestamp("date_of_merge", "MM/dd/yyyy HH:mm:ss")
    losers = first_merge(merge.withColumn("_at", merged_at), "existing_mdm_id", "_at").withColumn(
        "_gone", F.lit("N"))
    rows = left_lookup(rows, losers, {"party_master_id": "existing_mdm_id"},
                       {"et_active": "_gone", "merge_record_date": "_at"})
    rows = rows.withColumns({"et_active": F.coalesce("et_active", F.lit("Y")),
                             "source_dt": F.col("source_dt").cast("timestamp")})
    rows = rows.withColumns({
        "tmp_suppression_criteria": suppression_reason(patient_rules()),
        "merge_record_date": cause_date("merge_record_date", F.col("et_active") != "N"),
        "bounce_date": cause_date("bounce_date", F.col("bounce_flag") != 1),
        "opt_out_date": cause_date("opt_out_date", F.col("opt_out_flag") != "Y")})
    rows = rows.withColumn("party_suppression_date", party_date(
        "tmp_suppression_criteria", V.PARTY_REASONS_PATIENT, "create_date"))
    done = clamp_dates(earliest_cause(rows), V.CLAMP_PATIENT)
    final = """party_fk party_master_id product_name pat_segment birth_date party_type_code party_type
        party_class stream primary_email suppressed_code record_state age lead_source therapeutic_area
        feed_origin iw_flg opt_out_flag bounce_flag et_active tmp_suppression_criteria create_date
        opt_out_date merge_record_date bounce_date party_suppression_date suppression_criteria
        suppression_source suppression_date source_dt final_suppression_date final_source_dt""".split()
    names = {c: c for c in final} | {"party_type_code": "patient_type_code",
                                     "party_class": "patient_class",
                                     "therapeutic_area": "child_therapeutic_area"}
    return renamed_apart(done, names).withColumn("wf_customer_type", F.lit("Patient"))


def patient_workflow(t: Frames, as_of: date) -> dict[str, DataFrame]:
    """All five results.  The first four are written to the shared folder as they are made,
    since later steps read them several times."""
    party = settle(patient_party(t, as_of), "patient-party")
    people = settle(market_persons(t), "market-persons")
    market, merge = settle(patient_market(t, people), "patient-market"), settle(patient_merge(t, as_of, people), "patient-merge")
    source = settle(patient_source(t, party, market), "patient-source")
    return {"party": party, "market": market, "source": source, "merge": merge,
            "suppression": patient_suppression(t, source, party, merge)}
