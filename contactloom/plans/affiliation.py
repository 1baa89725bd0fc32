"""Affiliations between professionals, organisations and health systems."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contactloom import fixed_values as V
from contactloom.functions.engagement import affiliation_label
from contactloom.functions.scalar import present
from contactloom.operators.joins import left_lookup, resolve_ancestor
from contactloom.operators.pick import first_per_key, newest
from contactloom.operators.reshape import conform, unpivot_cols
from contactloom.sources.contracts import FLEX_COLUMNS

Frames = Mapping[str, DataFrame]


def affiliation_rows(t: Frames) -> DataFrame:
    """One row per parent, child and kind of affiliation that is marked."""
    links = t["parent_hco"].filter((F.col("record_state__v") == "VALID") & present("mk_parent_account_vnt_id")
                                   & present("mk_account_vnt_id"))
    ids = ["mk_account_vnt_id", "mk_parent_account_vnt_id", "modified_date__v", "record_state__v",
           "hierarchy_type__v"]
    rows = unpivot_cols(links, ids, V.AFFILIATION_COLUMNS, "affiliation_name", "affiliation_type")
    return rows.filter(F.col("affiliation_type") != "N").withColumns({
        "affiliation_name": F.upper("affiliation_name"), "affiliation_type": F.upper("affiliation_type")})


def health_systems(hco: DataFrame, links: DataFrame) -> DataFrame:
    """Health system of an organisation: grandparent's, else parent's, else its own."""
    primary = links.filter((F.col("affiliation_name") == "AD_PRIMARY_AFFILIATION__C")
                           & (F.col("affiliation_type") == "Y"))
    parents = first_per_key(primary, ["mk_account_vnt_id"],
                            [newest("modified_date__v", nulls_last=True), newest("mk_parent_account_vnt_id")])
    rows = resolve_ancestor(hco.select("mk_account_vnt_id", "corporate_name__v", "hco_type__v"), parents,
                            "mk_account_vnt_id", "mk_account_vnt_id", "mk_parent_account_vnt_id")
    for level in (1, 2):
        rows = left_lookup(rows, hco, {f"_ancestor{level}": "mk_account_vnt_id"},
                           {f"_type{level}": "hco_type__v", f"_name{level}": "corporate_name__v"})
    system = F.coalesce(*[F.when(F.col(kind).isin(V.HEALTH_SYSTEM_TYPES), F.struct(F.col(name).alias("n")))
                          for kind, name in (("_type2", "_name2"), ("_type1", "_name1"),
                                             ("hco_type__v", "corporate_name__v"))])
    return rows.select("mk_account_vnt_id", F.col("corporate_name__v"),
                       system.getField("n").alias("health_care_system")).distinct()


def affiliation(t: Frames) -> DataFrame:
    hco = t["hco"].filter(F.col("record_state__v") == "VALID")
    hcp = t["hcp"].filter(F.col("record_state__v") == "VALID")
    accounts = t["account_dim"].filter((F.col("record_state") == "VALID") & present("mk_account_vnt_id"))
    links = affiliation_rows(t)
    named = {"_hco": "corporate_name__v"}
    rows = left_lookup(links, hco, {"mk_parent_account_vnt_id": "mk_account_vnt_id"}, {"_p_hco": "corporate_name__v"})
    rows = left_lookup(rows, accounts, {"mk_parent_account_vnt_id": "mk_account_vnt_id"},
                       {"_p_name": "account_name", "_p_class": "account_class"})
    rows = left_lookup(rows, health_systems(hco, links), {"mk_parent_account_vnt_id": "mk_account_vnt_id"},
                       {"health_care_system": "health_care_system"})
    rows = left_lookup(rows, hco, {"mk_account_vnt_id": "mk_account_vnt_id"}, named)
    rows = left_lookup(rows, hcp, {"mk_account_vnt_id": "mk_account_vnt_id"}, {"_hcp": "formatted_name__v"})
    rows = left_lookup(rows, accounts, {"mk_account_vnt_id": "mk_account_vnt_id"},
                       {"_name": "account_name", "_class": "account_class"})
    sites = hco.filter((F.col("hco_status__v") == "A") & (F.col("primary_country__v") == "US"))
    rows = left_lookup(rows, sites, {"mk_account_vnt_id": "mk_account_vnt_id"}, {"_site": "ad_infusion_site__c"})
    rows = rows.withColumns({
        "parent_id": F.col("mk_parent_account_vnt_id"), "parent_name": F.coalesce("_p_name", "_p_hco"),
        "parent_type": F.coalesce("_p_class", F.lit("HCO")), "child_id": F.col("mk_account_vnt_id"),
        "child_name": F.coalesce("_name", "_hco", "_hcp"),
        "child_type": F.when(F.col("_site") == "Y", "INFUSION FACILITY")
        .otherwise(F.coalesce("_class", F.substring("hierarchy_type__v", 1, 3))),
        "_kind": F.col("affiliation_type"),
        "affiliation_type": affiliation_label("affiliation_name", "affiliation_type"),
        "status": F.col("record_state__v")})
    rows = rows.filter(F.col("parent_name").isNotNull() & F.col("child_name").isNotNull())
    # the kind and the names settle equal dates
    rows = first_per_key(rows, ["parent_id", "child_id", "affiliation_name"],
                         [newest("modified_date__v"), newest("_kind"), newest("parent_name"),
                          newest("child_name"), newest("child_type"), newest("health_care_system")])
    kept = ("parent_id parent_name parent_type child_id child_name child_type health_care_system "
            "affiliation_type status").split()
    return conform(rows.select(*kept), T.StructType(
        [T.StructField(n, T.StringType()) for n in [*kept, *FLEX_COLUMNS]]))
