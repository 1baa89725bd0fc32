"""Pieces that the professional and the patient plans share."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom import fixed_values as V
from contactloom.functions.engagement import area_group
from contactloom.functions.scalar import folded, label_code, record_state_policy
from contactloom.operators.aggregates import bounce_summary
from contactloom.operators.joins import keep_matching, left_lookup
from contactloom.operators.pick import latest_opt_state
from contactloom.operators.reshape import union_distinct
from contactloom.sources.tables import run_parameter

Frames = Mapping[str, DataFrame]


def record_states(t: Frames, job: str) -> DataFrame:
    """Record-state codes that the job's extract date lets through."""
    codes = left_lookup(t["code"], t["domain_code"], {"domain_fk": "domain_sk"},
                        {"domain_name": "domain_name"}, how="inner")
    return codes.filter((F.col("domain_name") == V.RECORD_STATE_DOMAIN) & record_state_policy(
        "code_name", run_parameter(t["date_param"], job), V.FIRST_RUN_DATE,
        V.RECORD_STATES_FIRST_RUN, V.RECORD_STATES_LATER_RUNS)).select("code_sk", "code_name")


def parties_in_area(t: Frames) -> DataFrame:
    """Parties with a market row under one of the two area groups."""
    area = t["therapeutic_area"]
    child = left_lookup(t["party_market"].select("party_fk", "therapeutic_area_fk"), area,
                        {"therapeutic_area_fk": "therapeutic_area_sk"},
                        {"_parent": "parent_therapeutic_area_fk"}, how="inner")
    both = left_lookup(child, area, {"_parent": "therapeutic_area_sk"}, {"_area": "therapeutic_area"})
    return both.filter(area_group("_area").isin("HEM", "MS")).select("party_fk")


def active_codes(t: Frames, trim: bool = True, trim_flag: bool = False) -> DataFrame:
    """Codes of the active record state.  The source trims the name, the flag, both or neither, by place."""
    name = folded("code_name") if trim else F.upper("code_name")
    flag = folded("active_flg") if trim_flag else F.upper("active_flg")
    return t["code"].filter((name == "ACTIVE") & (flag == "Y")).select("code_sk")


def eligible_persons(t: Frames, countries: str = "country_code") -> DataFrame:
    """US persons (by the named country table) with an active market row under an active area of one of the parent areas.

    One row per party: everything beyond the party is an existence test, so the market side is
    cut to distinct keys and semi-joined, and no fan-out arises."""
    active = active_codes(t)
    areas = keep_matching(t["therapeutic_area"], active, "record_state_cd_fk", "code_sk", unique=True)
    parents = areas.filter(F.col("therapeutic_area").isin(V.PARENT_AREAS))
    children = keep_matching(areas, parents, "parent_therapeutic_area_fk", "therapeutic_area_sk", unique=True)
    market = keep_matching(t["party_market"], active, "record_state_cd_fk", "code_sk", unique=True)
    market = keep_matching(market, children, "therapeutic_area_fk", "therapeutic_area_sk", unique=True)
    us = t[countries].filter(F.col("iso_2_cd") == "US")
    party = t["party"].filter(F.trim("mdm_key").like(V.PERSON_PREFIX + "%"))
    party = keep_matching(party, us, "primary_country_fk", "country_sk", unique=True)
    people = union_distinct(t["party_patient"].select("party_fk"), t["party_contact"].select("party_fk"))
    keyed = left_lookup(people, party, {"party_fk": "party_sk"}, {"mdm_key": "mdm_key"}, how="inner")
    return keep_matching(keyed, market, "party_fk")


def opt_states(t: Frames, keep_programs: bool) -> DataFrame:
    """Latest e-mail opt-in per party and program for the informational topic."""
    rows = left_lookup(t["iw_snapshot"].filter(F.upper("channel_cd") == "EMAIL"), t["iw_program"],
                       {"iw_program_fk": "iw_program_sk"}, {"program_name": "program_name"}, "inner")
    rows = left_lookup(rows, t["iw_topic"].filter(F.upper("topic_name") == "INFORMATIONAL"),
                       {"iw_topic_fk": "iw_topic_sk"}, {"topic_name": "topic_name"}, "inner")
    if keep_programs:
        rows = rows.filter(F.upper("program_name").isin(V.OPT_PROGRAMS))
    keys = ["party_fk", "iw_program_fk", "iw_topic_fk", "program_name", "topic_name"]
    return (latest_opt_state(rows, keys, "last_load_ts", "iw_flg")
            .withColumnRenamed("last_load_ts", "opt_out_date")
            .select(*keys, "iw_flg", "opt_out_date", "opt_out_flag"))


def bounces(t: Frames) -> DataFrame:
    dated = left_lookup(t["activity_fact"], t["time_dim"], {"time_fk": "time_sk"},
                        {"time_dt": "time_dt"}, how="inner")
    named = F.col("attribute_5_name") == "BOUNCE_CATEGORY"
    return bounce_summary(dated, "customer_fk", "integration_key",
                          F.when(named, F.col("attribute_5_value")),
                          F.col("activity_type_fk") == V.BOUNCE_ACTIVITY_TYPE, "time_dt")


def record_letter(name: str):
    """Record state as a letter; unknown states are NULL, as '' is in the source dialect."""
    return label_code(F.trim(F.col(name)), V.RECORD_STATE_LETTERS)


def area_path(t: Frames, market: DataFrame) -> DataFrame:
    """Child and parent area of each market row, inner on both steps."""
    area = t["therapeutic_area"]
    down = left_lookup(market, area, {"therapeutic_area_fk": "therapeutic_area_sk"},
                       {"child_ta": "therapeutic_area", "_parent_fk": "parent_therapeutic_area_fk"},
                       how="inner")
    return left_lookup(down, area, {"_parent_fk": "therapeutic_area_sk"},
                       {"parent_ta": "therapeutic_area"}, how="inner")

