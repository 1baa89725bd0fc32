"""Professional suppression workflow: party base, market, merges, source, result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom import fixed_values as V
from contactloom.functions.engagement import program_of
from contactloom.functions.scalar import tail, whole_number
from contactloom.operators.joins import decode, keep_matching, left_lookup, renamed_apart
from contactloom.operators.pick import first_merge
from contactloom.operators.suppression import (cause_date, clamp_dates, earliest_cause, party_date,
                                               professional_rules, suppression_reason)
from contactloom.plans.party import (Frames, area_path, bounces, opt_states, parties_in_area,
                                     record_states)
from contactloom.sources.tables import settle

_PARTY_COLUMNS = """party_sk mdm_key party_type_cd_fk first_name middle_name last_name title
    hcp_type_cd_fk practice_type_cd_fk hcp_status_cd_fk ama_opt_out_flag record_state_cd_fk
    create_dt party_type hcp_type practice_type hcp_status record_state_cd sma_hcp_segment""".split()


def _professionals(t: Frames, job: str) -> DataFrame:
    """US professionals in the covered areas with an extractable record state."""
    usa = t["country_code"].filter(F.col("iso_3_cd") == "USA")
    hcp = keep_matching(t["party_hcp"], usa, "primary_country_cd_fk", "country_sk", unique=True)
    hcp = keep_matching(hcp, record_states(t, job), "record_state_cd_fk", "code_sk", unique=True)
    return keep_matching(hcp, parties_in_area(t), "party_fk")


def professional_party(t: Frames) -> DataFrame:
    known = t["party"].filter((F.col("party_sk") > 0) & F.col("mdm_key").isNotNull())
    base = renamed_apart(known, {"party_sk": "party_sk", "mdm_key": "mdm_key", "create_dt": "created_dt",
                                 "party_type_cd_fk": "party_type_cd_fk"})
    details = {c: c for c in ("first_name middle_name last_name title hcp_type_cd_fk "
                              "practice_type_cd_fk hcp_status_cd_fk record_state_cd_fk").split()}
    rows = left_lookup(base, _professionals(t, V.HCP_DATE_PARAM), {"party_sk": "party_fk"}, details,
                       how="inner")
    asked = keep_matching(t["party_flag"], t["code"].filter(F.col("code_name") == V.AMA_FLAG),
                          "flag_type_cd_fk", "code_sk")
    rows = left_lookup(rows, asked, {"party_sk": "party_fk"}, {"ama_opt_out_flag": "allowed_flg"})
    rows = decode(rows, t["code"], {"party_type_cd_fk": "party_type", "hcp_type_cd_fk": "hcp_type",
                                    "practice_type_cd_fk": "practice_type",
                                    "hcp_status_cd_fk": "hcp_status",
                                    "record_state_cd_fk": "record_state_cd"})
    # the first segment in ascending order is the minimum, NULL only when all are
    segment = (t["sma_hcp_hco_raw"].groupBy("mdm_id").agg(F.min("sma_segment__c").alias("_segment"))
               .withColumn("_key", tail("mdm_id", 18, whole_only=True)))
    rows = left_lookup(rows, segment, {"mdm_key": "_key"}, {"sma_hcp_segment": "_segment"})
    return rows.select(*_PARTY_COLUMNS).distinct()


def professional_market(t: Frames) -> DataFrame:
    """Party, market row and child area.  The product market is not part of the result and an
    outer join to it changes nothing under DISTINCT, so it is left out."""
    states = record_states(t, V.MARKET_DATE_PARAM)
    hcp = keep_matching(t["v_party_hcp"].filter(F.col("primary_country_cd") == "USA"), states,
                        "record_state_cd", "code_name")
    market = area_path(t, keep_matching(t["party_market"], hcp, "party_fk"))
    # filtering on the parent makes the outer joins to market and area inner ones
    market = market.filter(F.col("parent_ta").isin("HEMATOLOGY", "NEUROLOGY")
                           & F.upper("child_ta").isin(V.MARKET_AREAS))
    known = t["party"].filter((F.col("party_sk") > 0) & F.col("mdm_key").isNotNull())
    rows = left_lookup(market, known, {"party_fk": "party_sk"}, {"mdm_id": "mdm_key"}, how="inner")
    return rows.select("mdm_id", F.col("party_market_sk").alias("party_market_id"), "child_ta").distinct()


def professional_merge(t: Frames) -> DataFrame:
    """Survivor and non-survivor keys of merged professionals."""
    survivors = keep_matching(t["party"].filter((F.col("party_sk") > 0) & F.col("mdm_key").isNotNull()),
                              _professionals(t, V.MERGE_DATE_PARAM), "party_sk", "party_fk")
    survivors = decode(survivors, t["code"], {"party_type_cd_fk": "_type"}).filter(F.col("_type") == "HCP")
    rows = left_lookup(t["party_merge_map"], survivors, {"survivor_party_fk": "party_sk"},
                       {"new_mdm_id": "mdm_key", "_type": "_type"}, how="inner")
    rows = left_lookup(rows, t["party"], {"non_survivor_party_fk": "party_sk"},
                       {"existing_mdm_id": "mdm_key"})
    rows = decode(rows, t["code"], {"record_state_cd_fk": "record_status_cd"})
    return rows.select("new_mdm_id", "existing_mdm_id",
                       F.upper(F.substring("_type", 1, 3)).alias("party_type"), "src_merge_dt",
                       "record_status_cd").distinct()


def professional_source(t: Frames, party: DataFrame, market: DataFrame) -> DataFrame:
    """Lead source, mail addresses and product of each professional.

    The two lead branches of the source differ only in area and tag, so one join serves both.
    The customer key is carried along because the result needs it to find merges."""
    first = t["first_source"].withColumn("_lead", F.coalesce("true_source", "source_name"))
    take_first = {"lead_source": "_lead", "source_dt": "create_dt"}
    areas = market.filter(F.col("child_ta").isin(V.AREA_MS, V.AREA_SMA))
    leads = left_lookup(areas, t["party_dim"], {"mdm_id": "vnid"},
                        {"party_sk": "party_sk", "_own": "email_addr"}, how="inner")
    leads = left_lookup(leads, first, {"party_sk": "party_fk"}, take_first, how="inner")
    leads = left_lookup(leads, t["comm_email"], {"party_sk": "party_fk"}, {"_mail": "comm_value"})
    columns = ["party_fk", "mdm_id", "lead_source", "source_dt", "child_ta", "party_email_address",
               "nba_email_address", "hcp_source"]
    # '' is NULL in the source dialect: the second area has no source tag at all
    leads = leads.withColumns({
        "party_fk": whole_number("party_sk"), "party_email_address": F.coalesce("_mail", "_own"),
        "nba_email_address": F.lit(None).cast("string"),
        "hcp_source": F.when(F.col("child_ta") == V.AREA_MS, "SFMC HCP")}).select(*columns).distinct()

    listed = renamed_apart(t["nba_hcp"], {"mdm_id": "prof_sk", "nba_email_address": "email"})
    listed = left_lookup(listed, t["party_dim"], {"mdm_id": "vnid"}, {"_own": "email_addr"})
    listed = left_lookup(listed, party, {"mdm_id": "mdm_key"},
                         {"_party": "party_sk", "_created": "create_dt"})
    listed = left_lookup(listed, first.withColumn("_first", F.col("party_fk")), {"_party": "party_fk"},
                         {"_first": "_first", **take_first})
    listed = left_lookup(listed, t["comm_email"], {"_first": "party_fk"}, {"_mail": "comm_value"})
    listed = listed.withColumns({
        "party_fk": F.coalesce(whole_number("_first"), whole_number("mdm_id")),
        "lead_source": F.coalesce("lead_source", F.lit("NBA HCP")),
        "source_dt": F.coalesce(F.col("source_dt").cast("timestamp"), F.col("_created").cast("timestamp"),
                                F.lit("2020-01-01").cast("timestamp")),
        "child_ta": F.lit(V.AREA_MS), "party_email_address": F.coalesce("_mail", "_own"),
        "hcp_source": F.lit("NBA HCP")}).select(*columns).distinct()

    products = (t["hcp_marketing"].filter(F.col("product_name").isin(V.MARKETED_PRODUCTS))
                .select("product_name", "therapeutic_area").distinct()
                .withColumn("product_name", program_of("product_name")))
    both = leads.withColumn("source_dt", F.col("source_dt").cast("timestamp")).unionByName(listed)
    return left_lookup(both, products, {"child_ta": "therapeutic_area"}, {"product_name": "product_name"})


def professional_suppression(t: Frames, source: DataFrame, party: DataFrame,
                             merge: DataFrame) -> DataFrame:
    traits = "ama_opt_out_flag create_dt party_type hcp_type practice_type hcp_status " \
             "record_state_cd sma_hcp_segment".split()
    rows = left_lookup(source, party, {"party_fk": "party_sk"}, {c: c for c in traits})
    losers = first_merge(merge, "existing_mdm_id", "src_merge_dt").withColumn("_gone", F.lit("N"))
    rows = left_lookup(rows, losers, {"mdm_id": "existing_mdm_id"},
                       {"et_active": "_gone", "merge_record_date": "src_merge_dt"})
    rows = left_lookup(rows, bounces(t), {"party_fk": "customer_fk"},
                       {"bounce_flag": "bounce_flag", "bounce_date": "bounce_date"})
    rows = left_lookup(rows, opt_states(t, keep_programs=False),
                       {"party_fk": "party_fk", "product_name": "program_name"},
                       {c: c for c in ("iw_flg", "opt_out_flag", "opt_out_date")})
    rows = rows.withColumns({
        "tmp_suppression_criteria": suppression_reason(professional_rules()),
        "merge_record_date": cause_date("merge_record_date", F.col("et_active") != "N"),
        "bounce_date": cause_date("bounce_date", F.col("bounce_flag") != 1),
        "opt_out_date": cause_date("opt_out_date", F.col("opt_out_flag") != "Y"),
        "et_active": F.coalesce("et_active", F.lit("Y")),
    }).withColumnRenamed("mdm_id", "mdm_key").distinct()
    rows = rows.withColumn("party_suppression_date", party_date(
        "tmp_suppression_criteria", V.PARTY_REASONS_PROFESSIONAL, "create_dt"))
    return (clamp_dates(earliest_cause(rows), V.CLAMP_PROFESSIONAL)
            .withColumn("wf_customer_type", F.lit("HCP")))


def professional_workflow(t: Frames) -> dict[str, DataFrame]:
    """All five results.  Those that later steps read are written to the shared folder."""
    party = settle(professional_party(t), "professional-party")
    market = settle(professional_market(t), "professional-market")
    merge = settle(professional_merge(t), "professional-merge")
    source = settle(professional_source(t, party, market), "professional-source")
    return {"party": party, "market": market, "merge": merge, "source": source,
            "suppression": professional_suppression(t, source, party, merge)}
