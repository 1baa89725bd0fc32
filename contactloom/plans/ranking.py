"""Professional ranking by trailing units."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom import fixed_values as V
from contactloom.functions.engagement import decile_group
from contactloom.functions.identity import normalize_class, party_key
from contactloom.functions.scalar import as_date, month_start, quarter_start, yes_no
from contactloom.operators.aggregates import trailing_units
from contactloom.operators.joins import exists_flag, left_lookup
from contactloom.operators.pick import first_per_key, newest
from contactloom.operators.ranking import global_rank
from contactloom.plans.email_engagement import plain_key, web_lead_source
from contactloom.sources.tables import settle

Frames = Mapping[str, DataFrame]


def party_classes(t: Frames) -> DataFrame:
    """Persons and accounts under their bare keys, with their class."""
    persons = t["patient_dim"].filter(F.col("mk_patient_gne_id") != V.UNKNOWN_ID).select(
        F.col("mk_patient_gne_id").alias("mdm_id"), "patient_class").distinct()
    accounts = t["account_dim"].filter(F.col("mk_account_vnt_id") != V.UNKNOWN_ID).select(
        F.col("mk_account_vnt_id").alias("mdm_id"), "account_class").distinct()
    return persons.union(accounts).select("mdm_id", F.upper("patient_class").alias("_class"))


def brand_units(t: Frames, as_of: date) -> DataFrame:
    """Trailing units per account: the market, own brands, and each brand of the fixed list."""
    facts = t["kpi_metric_fact"].filter(
        (F.upper("metric_name") == "UNITS - MARKET") & (F.upper("free_comm") == "COMMERCIAL")
        & (F.upper("time_type") == "MONTH") & F.col("mk_account_vnt_id").isNotNull())
    facts = left_lookup(facts, t["brand_master"], {"product_brand_name": "product_brand_name"},
                        {"_rival": "brand_competitor_flag"})
    facts = facts.withColumn("_month", month_start("dt"))
    brand = F.upper("product_brand_name")
    slices = {"ms": F.lit(True), "biib": F.upper("_rival") == "N",
              **{stem: brand == name for stem, name in V.UNIT_BRANDS.items()}}
    return trailing_units(facts, "mk_account_vnt_id", "_month", "metric_value", as_of, slices)


def professional_ranking(t: Frames, target_list: DataFrame, as_of: date) -> DataFrame:
    rows = party_classes(t).withColumn("alignment_string", party_key("mdm_id", "_class"))
    sma = first_per_key(t["sma_digital_segment"], ["vnt_id"],
                        [newest("effective_end_date"), newest("effective_start_date"), newest("digital_segment")])
    ms = first_per_key(t["ms_digital_segment"], ["mdm_id"], [newest("eff_date"), newest("digital_segment")])
    rows = left_lookup(rows, ms, {"mdm_id": "mdm_id"}, {"ms_digital_segment": "digital_segment"})
    rows = left_lookup(rows, sma, {"mdm_id": "vnt_id"}, {"sma_digital_segment": "digital_segment"})
    rows = left_lookup(rows, target_list, {"mdm_id": "vnid"}, {"alz_digital_segment": "segment"})
    rows = left_lookup(rows, t["account_ms_dim"], {"mdm_id": "mk_account_vnt_id"},
                       {"hcp_decile": "decile_rating", "hcp_portfolio_segment": "hcp_segment"})
    rows = rows.withColumn("_prefixed", F.concat(F.lit(V.ACCOUNT_PREFIX), "mdm_id"))
    rows = left_lookup(rows, t["engagement_segment"], {"_prefixed": "mdm_id"},
                       {"customer_engagement_segment": "cust_eng_segment"})
    for table, out in V.ENGAGEMENT_SCORES.items():
        rows = left_lookup(rows, t[table], {"_prefixed": "mdm_id"}, {out: "cust_eng_score"})
    rows = left_lookup(rows, t["party_first_source"], {"alignment_string": "mdm_id"},
                       {"lead_source": "lead_source", "lead_source_date": "lead_source_date"})
    rows = left_lookup(rows, web_lead_source(t, plain_key()), {"mdm_id": "mdm_id"},
                       {"web_lead_source": "web_lead_source"})
    units = brand_units(t, as_of)
    measures = [c for c in units.columns if c != "mk_account_vnt_id"]
    rows = left_lookup(rows, units, {"mdm_id": "mk_account_vnt_id"}, {c: c for c in measures})
    recent = F.to_date("cycle_plan_start_date") >= F.add_months(quarter_start(as_date(as_of)), -3)
    rows = exists_flag(rows, t["cycle_plan"].filter(recent), "mdm_id", "mk_account_vnt_id", "sf_target")

    # ranks look at the zero-filled values
    rows = rows.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in measures})
    rows = rows.select(
        "mdm_id", normalize_class("_class").alias("party_class"),
        F.when(F.col("_class") == "HCP", 1).otherwise(0).alias("hcp_flag"), "web_lead_source", "lead_source",
        "lead_source_date", "hcp_decile", decile_group("hcp_decile").alias("hcp_decile_group"),
        "hcp_portfolio_segment", "customer_engagement_segment", *V.ENGAGEMENT_SCORES.values(), "alignment_string",
        *[c for stem in ("ms", "sma", "alz") for c in (
            F.col(f"{stem}_digital_segment"),
            yes_no(F.col(f"{stem}_digital_segment").isNotNull()).alias(f"{stem}_npp_target_flag"))],
        "sf_target", *[c for c in measures if c.endswith("_12_months")],
        *[F.when(F.col(f"{stem}_units_12_months") > 0, 1).otherwise(0).alias(out) for out, stem in V.WRITER_INDICATORS.items()],
        *V.SHORT_WINDOW_UNITS)
    # read by both ranks and by the result: the joins above run once
    rows = settle(rows, "ranking")
    market, *rest = [F.col(c).desc() for c in V.SHORT_WINDOW_UNITS]
    own = [*rest, F.col("mdm_id").asc_nulls_last()]
    first, *others = V.SHORT_WINDOW_UNITS
    rows = global_rank(rows, ["hcp_flag", first, *others, "mdm_id"], [F.col("hcp_flag").desc(), market, *own],
                       "ms_ranking_6_months")
    return global_rank(rows, ["hcp_flag", *others, "mdm_id"], [F.col("hcp_flag").desc(), *own], "biib_ranking_6_months")
