"""Marketing activity, bounce flags, and the combined activity of all channels."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom import fixed_values as V
from contactloom.functions import engagement as E
from contactloom.functions.identity import (identified_flag, known_customer, long_key,
                                            normalize_class, record_owner, resolve_identity)
from contactloom.functions.scalar import (activity_bounds, as_date, ci_eq, day_from_digits, day_number,
                                          first_token, flag_letter, folded, month_start, open_ended,
                                          slot_lookup, yes_no)
from contactloom.operators.aggregates import net_bounce
from contactloom.operators.joins import drop_matching, hot_keys, left_lookup, split_lookup, spread_lookup
from contactloom.operators.pick import first_per_key, newest
from contactloom.operators.reshape import union_conformed
from contactloom.operators.sequence import repeat_flags, row_numbers_by_code
from contactloom.operators.spans import clip_spans, interval_join
from contactloom.sources.contracts import COMBINED
from contactloom.sources.tables import settle

Frames = Mapping[str, DataFrame]
MARKETING_FROM, COMBINED_FROM = "2015-01-01", "2019-01-01"
SLOTS = range(1, 26)

# Column names of the fact and definition tables and of the result (fixed values).
_KEPT = """customer_identity_value customer_identity_type rep_id territory_id session_id transaction_id
    parent_transaction_id content_id destination_id_type destination_id_value destination_content_id
    activity_cnt time_spent is_aggregated is_active integration_key row_hash_key job_run_id last_load_ts
    device_type has_interaction_detail mk_product_brand_pm_id mk_therapeutic_class_pm_id
    tactic_desc""".split()
_RENAMED = {"source_code": "source_cd", "activity_offer_description": "offer_des",
            "referral_id_type": "referal_id_type", "referral_id_value": "referal_id_value",
            "referral_content_id": "referal_content_id", "geo_region_code": "geo_region_cd",
            "date_timestamp": "activity_time", "source_channel_code": "channel_cd",
            **{f"offer_code{i}": f"offer_cd{i}" for i in range(1, 6)}}
_TACTIC = ("activity_tactic_code tactic_title tactic_document_name tactic_product tactic_description "
           "tactic_type approvedfordistribution_date tactic_expiration_date").split()
_KIT = ("activity_tactic_code activity_em_category activity_em_stream activity_sub_stream "
        "activity_em_number activity_em_number_with_ab_split").split()
_DEFINITION = ("activity_source_key1 activity_type_key2 activity_channel activity_subchannel "
               "activity_vendor metric_type comments hcp_tactic_type deep_flag light_flag contacted_flag "
               "cae_flag engaged_flag acted_flag").split()
_FLAGS = ["cae_flag", "contacted_flag", "engaged_flag", "acted_flag", "light_flag", "deep_flag"]


def target_spans(t: Frames) -> DataFrame:
    """Disjoint spans in which an account is on a call plan."""
    planned = t["cycle_plan"].filter(F.col("planned_call_count") > 0)
    return clip_spans(planned, "mk_account_vnt_id", "cycle_plan_start_date", "cycle_plan_end_date",
                      "updated_cycle_plan_end_date")


def _with_target(rows: DataFrame, spans: DataFrame, key: str, row_id: str, day: Column) -> DataFrame:
    return interval_join(rows, spans, key, "mk_account_vnt_id", row_id, day, "cycle_plan_start_date",
                         "updated_cycle_plan_end_date", "_planned", sentinels=(V.UNKNOWN_ID, "NA"))


def _definitions(t: Frames) -> DataFrame:
    return t["kpi_definition"].filter(open_ended("end_date"))


# Lookups that a column stands on; all others come from the fact alone.
_STANDS_ON = {
    "definition": {"activity_source", "type", "activity_subchannel", "activity_vendor", "metric_type", "metric_type_null_flag", "comments",
                   "hcp_tactic_type", "activity_channel", "activity_source_channel", "source_type", "activity_type", "tactic_em_type", *_FLAGS},
    "tactic": {*_TACTIC, "tactic_code_flag"},
    "kit": {"kit_code", "kit_code_flag", *_KIT[1:]},
    "brand": {"product_name", "therapeutic_area"},
    "area": {"therapeutic_area"},
    "party": {"customer_type", "party_class", "party_subtype"},
    "plan": {"sf_target"},
}
#: Lookups by keys that one value may own a third of: they move every row.
_MOVING = ("party", "plan")
_NUMBERS = {"activity_seq_number": "tactic_code", "bounce_activity_seq_number": "actual_tactic_code"}


def activity_rows(t: Frames, columns: Sequence[str] | None = None, where: Column | None = None) -> DataFrame:
    """One row per activity with the columns that the reader asks for (all but the numbers if it does not say), lazily.

    Only the lookups that these columns stand on are joined.  ``where`` speaks of the fact's own columns and holds before
    any lookup, so it reaches the fact's scan."""
    made = _activity_columns()
    columns = list(made) if columns is None else list(columns)
    needs = {name for name, own in _STANDS_ON.items() if own & set(columns)}
    source = _facts(t)
    if where is not None:
        source = source.filter(where)
    # A fact that is kept nearly whole travels through the joins as one struct, which is copied in one piece, next to the
    # few columns that are joined on; of a fact that few columns are asked of, the scan reads only those.
    packed = len(columns) > len(made) // 2
    rows = source.select(*([F.struct(*source.columns).alias("_fact")] if packed else source.columns), *[c.alias(n) for n, c in _lookup_keys().items()])
    rows = _looked_up(rows, t, needs)
    # person rows all carry account -1 and the other way round: spread those keys
    if "party" in needs:
        rows = spread_lookup(rows, t["patient_dim"], "_person", "mk_patient_gne_id", "_row_id", {"_patient_class": "patient_class"})
        rows = spread_lookup(rows, t["account_dim"], "_account", "mk_account_vnt_id", "_row_id", {"_account_class": "account_class"})
    if "plan" in needs:
        rows = _with_target(rows, target_spans(t), "_account", "_row_id", F.col("_on"))
    if packed:
        rows = rows.select("_fact.*", *[c for c in rows.columns if c != "_fact"])
    return rows.select(*[made[c].alias(c) for c in columns])


def _facts(t: Frames) -> DataFrame:
    return t["marketing_fact"].filter(activity_bounds("activity_time", MARKETING_FROM))


def _lookup_keys(fact: str = "") -> dict[str, Column]:
    """What lookups join on, from the columns of the fact, or of the struct ``fact`` that holds them."""
    own = lambda name: F.col(f"{fact}{name}")
    return {
        "_row_id": own("integration_key"), "_account": own("mk_account_vnt_id"), "_person": own("mk_patient_gne_id"),
        "_on": F.to_date(own("activity_time")), "_type": folded(own("activity_type_name")),
        "_channel": folded(own("channel_name")), "_tactic_up": F.upper(own("tactic_cd")),
        "_tactic_key": E.tactic_code(own("source_cd"), own("tactic_cd"), fold=False),
        "_brand": F.upper(own("mk_product_brand_pm_id")), "_class": F.upper(own("mk_therapeutic_class_pm_id"))}


def _looked_up(rows: DataFrame, t: Frames, needs: Collection[str]) -> DataFrame:
    """The lookups in dictionaries, which move no row as long as those are small."""
    if "definition" in needs:
        definitions = _definitions(t).withColumns({"_t": folded("activity_type_key2"), "_c": folded("activity_source_key1")})
        rows = left_lookup(rows, definitions, {"_type": "_t", "_channel": "_c"}, {f"_def_{c}": c for c in _DEFINITION})
    if "tactic" in needs:
        tactics = first_per_key(t["tactic_definition"], ["activity_tactic_code"],
                                [newest("tactic_expiration_date", nulls_last=True), newest("tactic_title")])
        rows = left_lookup(rows, tactics, {"_tactic_key": "activity_tactic_code"}, {f"_tac_{c}": c for c in _TACTIC})
    if "kit" in needs:
        kits = t["kit_code_definition"].withColumn("_k", F.upper("activity_tactic_code"))
        rows = left_lookup(rows, kits, {"_tactic_up": "_k"}, {f"_kit_{c}": c for c in _KIT})
    if "brand" in needs:
        brand = t["brand_master"].withColumn("_b", F.upper("mk_product_brand_pm_id"))
        rows = left_lookup(rows, brand, {"_brand": "_b"}, {"_brand_name": "product_brand_name"})
    if "area" in needs:
        area = t["therapeutic_class_master"].withColumn("_c", F.upper("mk_therapeutic_class_pm_id"))
        rows = left_lookup(rows, area, {"_class": "_c"}, {"_area": "therapeutic_class"})
    return rows


def activity_numbers(t: Frames) -> DataFrame:
    """Both numbers of every activity, newest first, under its integration key; keys of any size are cut into ranges."""
    rows = activity_rows(t, ["integration_key", "mdm_id", "activity_type", *_NUMBERS.values(), "time_date", "date_timestamp"])
    order = [newest("time_date"), newest("date_timestamp"), newest("integration_key")]
    rows = row_numbers_by_code(rows, ["mdm_id", "activity_type"], _NUMBERS, order, "activity-numbers")
    return rows.select("integration_key", *_NUMBERS)


def activity_by_month(t: Frames) -> DataFrame:
    """The whole activity with its month (``activity_month``), in order of months for a write in a partition per month.

    What moves rows by account or person, and the numbers, are worked out on narrow rows and meet the wide ones on the
    integration key, which is the fact's key and tells its rows apart.  That is the only time wide rows move, and they
    move as the fact has them: dictionaries are looked up and columns made where the rows are written."""
    moved = [c for name in _MOVING for c in _STANDS_ON[name]]
    made = _activity_columns()
    source = _facts(t)
    wide = source.select("integration_key", F.struct(*source.columns).alias("_fact"))
    side = activity_rows(t, ["integration_key", *moved]).join(activity_numbers(t), "integration_key")
    side = side.select("integration_key", F.struct(*moved, *_NUMBERS).alias("_side"))
    rows = wide.join(side, "integration_key").select(month_start("_fact.activity_time").alias("activity_month"), "_fact", "_side")
    rows = rows.sortWithinPartitions("activity_month")
    rows = rows.select("activity_month", "_fact", "_side", *[c.alias(n) for n, c in _lookup_keys("_fact.").items()])
    rows = _looked_up(rows, t, set(_STANDS_ON) - set(_MOVING))
    rows = rows.select("_fact.*", *[c for c in rows.columns if c != "_fact"])
    return rows.select(*[F.col(f"_side.{c}").alias(c) if c in moved else expr.alias(c) for c, expr in made.items()],
                       *[f"_side.{c}" for c in _NUMBERS], "activity_month")


def activity_product(t: Frames) -> DataFrame:
    """The whole activity, written once to the shared folder in a partition per month, so that readers with a lower bound
    leave the older files alone."""
    return settle(activity_by_month(t), "activity", "activity_month")


def marketing_activity(t: Frames) -> DataFrame:
    """One row per activity with tactic, kit, definition, party, brand and call-plan columns, and its numbers."""
    return activity_product(t).drop("activity_month")


def since(rows: DataFrame, first: str) -> DataFrame:
    """Rows from a day on, that being the first of a month; a product in monthly partitions is read from there."""
    if "activity_month" in rows.columns:
        rows = rows.filter(F.col("activity_month") >= as_date(first))
    return rows.filter(F.col("time_date") >= as_date(first))


def _activity_columns() -> dict[str, Column]:
    account, person, raw = "mk_account_vnt_id", "mk_patient_gne_id", "customer_identity_value"
    owner = record_owner(account, person)
    d = {c: F.col(f"_def_{c}") for c in _DEFINITION}
    party = F.coalesce(F.upper("_account_class"), normalize_class("_patient_class"))
    undeclared = F.col("customer_type").isNull() | (F.upper("customer_type") == "UNKNOWN")
    kind = F.trim(F.coalesce(d["metric_type"], d["activity_type_key2"]))
    subchannel = F.trim(F.upper(d["activity_subchannel"]))
    mailed = F.upper("source_cd") == "SFMC"
    home = (F.upper("source_cd") == "SFDC_US") | (
        F.upper(d["activity_subchannel"]).isin("EMAIL", "DIRECT MAIL") & mailed)
    on_site = F.upper("attribute_2_name") == "SITEORIGIN"
    exact = F.coalesce(folded("channel_name"), F.upper(d["activity_source_key1"])) == "EXACT TARGET EMAIL"
    slots = [(f"attribute_{i}_name", f"attribute_{i}_value") for i in SLOTS]
    new = {
        "source_cust_date_key": F.concat("source_cd", owner, raw, F.col("last_load_ts").cast("string")),
        "rdm_key": owner,
        "customer_type": F.when(undeclared, party).otherwise(F.upper("customer_type")),
        "party_class": party,
        "party_subtype": F.coalesce(F.upper("_account_class"), F.upper("_patient_class")),
        "time_date": F.to_date("activity_time"),
        "date_nbr": day_number("activity_time"),
        "timestamp": F.date_format("activity_time", "HH:mm:ss"),
        "source_channel_name": F.trim("channel_name"),
        "source_channel_lvl2_name": F.trim("channel_level_2_name"),
        "source_act_type": F.col("_type"),
        "product_name": F.coalesce("_brand_name", "marketing_brand"),
        "therapeutic_area": F.coalesce("_area", "_brand_name", "marketing_brand"),
        "actual_tactic_code": F.upper("tactic_cd"),
        "tactic_code": E.tactic_code("source_cd", "tactic_cd"),
        "orig_tactic_code_of_resends": E.original_tactic("source_cd", "tactic_cd"),
        "resend_flag": E.resend_flag("source_cd", "tactic_cd"),
        "base_tactic": E.base_tactic("tactic_cd"),
        "identified_flag": identified_flag(account, person),
        "activity_source": F.trim(d["activity_source_key1"]),
        "type": kind,
        "activity_subchannel": subchannel,
        "activity_vendor": F.trim(d["activity_vendor"]),
        "metric_type": d["metric_type"],
        "metric_type_null_flag": F.when(d["metric_type"].isNull(), 1).otherwise(0),
        "campaign": slot_lookup("CAMPAIGN", slots),
        "comments": d["comments"],
        "hcp_tactic_type": d["hcp_tactic_type"],
        **{c: F.col(f"_tac_{c}") for c in _TACTIC if c != "tactic_title"},
        "tactic_code_flag": F.when(F.col("_tac_activity_tactic_code").isNotNull(), 1).otherwise(0),
        "kit_code": F.col("_kit_activity_tactic_code"),
        "kit_code_flag": F.when(F.col("_kit_activity_tactic_code").isNotNull(), 1).otherwise(0),
        **{c: F.upper(f"_kit_{c}") for c in _KIT[1:4]},
        **{c: F.col(f"_kit_{c}") for c in _KIT[4:]},
        "activity_class": F.lit("Non-Personal"),
        "activity_channel": F.when(on_site & d["activity_channel"].isNull(), "WEB")
        .otherwise(d["activity_channel"]),
        "activity_source_channel": F.coalesce(F.trim("channel_name"), d["activity_source_key1"]),
        "source_type": F.when(home, "HOME OFFICE").otherwise("3RD PARTY"),
        "activity_type": F.coalesce(F.col("_type"), kind),
        **{c: flag_letter(d[c]) for c in _FLAGS},
        "sf_target": yes_no(F.col("_planned")),
        "mdm_id": resolve_identity(account, person, raw, prefix=False),
        "tactic_title": F.coalesce("_tac_tactic_title", "tactic_desc"),
        "tactic_em_type": F.when(exact, F.col("attribute_1_value")).otherwise("UNKNOWN"),
        "activity_offer_code": F.coalesce(*[f"offer_cd{i}" for i in range(1, 6)]),
        "alignment_string": resolve_identity(account, person, raw),
        "unsubcribe_clicks_flag": E.unsubscribe_click("destination_id_type", "destination_id_value"),
        "firewall_click_flag": E.firewall_click("attribute_24_name", "attribute_24_value"),
    }
    attributes = [f"attribute_{i}_{part}" for i in SLOTS for part in ("name", "value")]
    return {**{c: F.col(c) for c in _KEPT}, **{n: F.col(old) for n, old in _RENAMED.items()}, **{a: F.col(a) for a in attributes}, **new}


# Columns of the activity that the bounce view passes on (fixed values).
_BOUNCE_VIEW = """acted_flag activity_channel activity_class activity_em_category activity_em_stream
    activity_offer_code activity_offer_description activity_seq_number activity_source_channel
    activity_sub_stream activity_subchannel activity_type activity_vendor actual_tactic_code
    alignment_string attribute_1_name attribute_1_value attribute_13_name attribute_13_value
    attribute_2_name attribute_2_value bounce_activity_seq_number cae_flag contacted_flag
    customer_identity_type customer_identity_value customer_type date_nbr date_timestamp deep_flag
    destination_id_type destination_id_value engaged_flag firewall_click_flag geo_region_code
    identified_flag integration_key is_active light_flag mdm_id metric_type metric_type_null_flag
    hcp_tactic_type offer_code2 offer_code3 offer_code4 offer_code5 orig_tactic_code_of_resends
    product_name rdm_key rep_id resend_flag session_id sf_target source_code source_type tactic_code
    tactic_description tactic_document_name tactic_em_type tactic_product tactic_title tactic_type
    territory_id therapeutic_area time_date timestamp unsubcribe_clicks_flag mk_product_brand_pm_id
    mk_therapeutic_class_pm_id party_class party_subtype activity_em_number
    activity_em_number_with_ab_split""".split()


def net_bounces(latest: DataFrame) -> DataFrame:
    """Net-bounce figures per customer and tactic, from the newest activity of each type."""
    mailed = latest.filter((F.upper("source_code") == "SFMC") & (F.upper("activity_subchannel") == "EMAIL"))
    kinds = mailed.select("mdm_id", "actual_tactic_code", F.upper("activity_type").alias("_kind"), "date_nbr")
    return net_bounce(kinds, ["mdm_id", "actual_tactic_code"], "_kind", "date_nbr")


def newest_activity(t: Frames) -> DataFrame:
    """The newest activity per customer, type and tactic, without numbering the others."""
    rows = activity_rows(t, """mdm_id activity_type actual_tactic_code source_code activity_subchannel date_nbr time_date
        date_timestamp integration_key""".split())
    return first_per_key(rows, ["mdm_id", "activity_type", "actual_tactic_code"],
                         [newest("time_date"), newest("date_timestamp"), newest("integration_key")])


def _with_repeats(rows: DataFrame, bounced: DataFrame) -> DataFrame:
    """The net bounce of a row's customer and tactic, and whether the row repeats another one in its month and overall."""
    rows = left_lookup(rows, bounced, {"mdm_id": "mdm_id", "actual_tactic_code": "actual_tactic_code"},
                       {"_bounce": "bounce_flag"})
    rows = rows.withColumn("_month", month_start("time_date"))
    return repeat_flags(rows, ["alignment_string", "activity_type", "base_tactic"],
                        {"_month_repeat": ["_month"], "_repeat": []},
                        [F.col("_bounce").isNull(), F.col("_bounce"), F.col("time_date"), F.col("date_timestamp"),
                         F.col("integration_key").isNull(), F.col("integration_key")])


def _bounce_columns() -> list[Column]:
    sent = (F.upper("activity_type") == "EMAIL SENT") & F.upper("source_code").isin(V.RESEND_SOURCES)
    return [yes_no(F.col("_month_repeat") & sent).alias("monthly_resends_exclude_flag"),
            yes_no(F.col("_repeat") & sent).alias("overall_resends_exclude_flag"),
            F.coalesce("_bounce", F.lit(0)).alias("bounce_flag")]


def activity_with_bounce(activity: DataFrame) -> DataFrame:
    """Net-bounce flag per customer and tactic, and flags for repeated sends.  A month of the activity stays."""
    months = [c for c in activity.columns if c == "activity_month"]
    bounced = net_bounces(activity.filter(F.col("bounce_activity_seq_number") == 1))
    rows = _with_repeats(activity.select(*_BOUNCE_VIEW, "base_tactic", *months), bounced)
    return rows.select(*_BOUNCE_VIEW, *months, *_bounce_columns())


def bounce_activity(t: Frames) -> DataFrame:
    """``activity_with_bounce`` of the whole activity, from the tables.

    Nothing wide is written, and wide rows move once, as the fact has them and only the columns of the view: the numbers,
    what is looked up by account or person, net bounces and repeats are worked out on narrow rows before.  These flags hang on
    what tells rows of one integration key apart (``told``), so facts that share a key get their own."""
    made = _activity_columns()
    moved = [c for name in _MOVING for c in _STANDS_ON[name]]
    told = ["mdm_id", "actual_tactic_code", "date_timestamp"]
    side = settle(activity_rows(t, ["integration_key", *moved]).join(activity_numbers(t), "integration_key"), "activity-side")
    first = side.filter(F.col("bounce_activity_seq_number") == 1).select("integration_key")
    kinds = activity_rows(t, ["integration_key", "mdm_id", "actual_tactic_code", "source_code", "activity_subchannel", "activity_type", "date_nbr"])
    rows = activity_rows(t, ["integration_key", *told, "alignment_string", "activity_type", "base_tactic", "time_date"])
    rows = _with_repeats(rows.filter(F.col("integration_key").isNotNull()), net_bounces(kinds.join(first, "integration_key")))
    flags = rows.groupBy("integration_key", F.struct(*told).alias("_told")).agg(
        *[F.max(c).alias(c) for c in ("_bounce", "_month_repeat", "_repeat")])
    flags = flags.join(side, "integration_key").select(
        F.col("integration_key").alias("_key"), "_told", "_bounce", "_month_repeat", "_repeat",
        *[F.col(c).alias(f"_side_{c}") for c in (*moved, *_NUMBERS)])
    own = F.struct(*[made[c].alias(c) for c in told])
    rows = _facts(t).join(flags, (F.col("integration_key") == F.col("_key")) & (own == F.col("_told")))
    rows = rows.withColumns(_lookup_keys())
    rows = _looked_up(rows, t, set(_STANDS_ON) - set(_MOVING))
    rows = rows.select(*[(F.col(f"_side_{c}") if c in moved or c in _NUMBERS else made[c]).alias(c) for c in _BOUNCE_VIEW],
                       "_bounce", "_month_repeat", "_repeat")
    return rows.select(*_BOUNCE_VIEW, *_bounce_columns())


def party_states(t: Frames) -> DataFrame:
    """Both populations under one prefixed key, with their status."""
    persons = t["patient_dim"].filter(F.col("mk_patient_gne_id") != V.UNKNOWN_ID).select(
        F.concat(F.lit(V.PERSON_PREFIX), "mk_patient_gne_id").alias("rdm_key"), "patient_status_name").distinct()
    accounts = t["account_dim"].filter(F.col("mk_account_vnt_id") != V.UNKNOWN_ID).select(
        F.concat(F.lit(V.ACCOUNT_PREFIX), "mk_account_vnt_id").alias("rdm_key"), "record_state").distinct()
    return persons.union(accounts).select("rdm_key", F.upper("patient_status_name").alias("party_status"))


def hot_parties(t: Frames) -> DataFrame:
    """Party keys that own more than a task's share of calls, event guests and sent mails: read from the sources'
    key columns, ahead of the branches' joins."""
    mails = left_lookup(t["crm_sent_email"].select("account_vod__c"), t["crm_account"], {"account_vod__c": "id"},
                        {"_account": "external_id_vod__c"})
    keys = [t["call_plan_activity"].select(F.concat(F.lit(V.ACCOUNT_PREFIX), "mk_account_vnt_id").alias("key")),
            t["attendee"].select(long_key("mdm_id").alias("key")),
            mails.select(F.concat(F.lit(V.ACCOUNT_PREFIX), "_account").alias("key"))]
    return hot_keys(keys[0].union(keys[1]).union(keys[2]), "key")


def _with_state(rows: DataFrame, t: Frames) -> DataFrame:
    """Whether the party is active; parties with many rows, and rows without a party, are dealt over the tasks."""
    rows = split_lookup(rows.drop("is_active"), party_states(t), "alignment_string", "rdm_key", "record_id",
                        {"_state": "party_status"}, hot=hot_parties(t))
    return rows.withColumn("is_active", yes_no(F.col("_state").isin("VALID", "ACTIVE")))


def _constants(**values: object) -> dict[str, Column]:
    return {k: F.lit(v) for k, v in values.items()}


_PERSONAL = dict(activity_class="Personal", deep_engagement_flag="Y", light_engagement_flag="N",
                 contacted_flag="Y", cae_flag="N", engagement_type="Deep Engagement",
                 light_deep_engagement_flag="Y", metric_type_null_flag=0)
_NO_RESENDS = dict(firewall_click_flag="N", unsubcribe_clicks_flag="N", bounce_flag=0,
                   monthly_resends_exclude_flag="N", overall_resends_exclude_flag="N")


def call_branch(t: Frames, as_of: date) -> DataFrame:
    calls = t["call_plan_activity"].filter((F.upper("account_type") == "HCP")
                                           & activity_bounds("call_start_date", COMBINED_FROM, as_of))
    kind = F.upper("account_type")
    rows = calls.select(
        F.col("call_id").cast("string").alias("record_id"),
        F.concat(F.lit(V.ACCOUNT_PREFIX), "mk_account_vnt_id").alias("alignment_string"),
        F.to_date("call_start_date").alias("activity_date"), F.col("call_start_date").alias("timestamp"),
        F.col("primary_product_brand_id").alias("product_id"), F.upper("first_product").alias("product_name"),
        F.col("call_plan_target_flag").alias("sales_force_target_flag"),
        F.upper("primary_therapeutic_area").alias("therapeutic_area"),
        kind.alias("party_class"), kind.alias("party_subtype"), kind.alias("customer_type"))
    own = dict.fromkeys(("source_type", "activity_source", "activity_source_channel"), "SALES FORCE")
    return rows.withColumns(_constants(
        activity_seq_number=1, identified_flag="Y", **own, **_PERSONAL, **_NO_RESENDS))


def event_branch(t: Frames, spans: DataFrame, as_of: date) -> DataFrame:
    day = day_from_digits("created_date")
    seen = t["attendee"].filter((F.upper("attendee_status") == "ATND") & (day >= as_date(COMBINED_FROM))
                                & (day < as_date(as_of))).withColumn("_on", day)
    closed = t["event"].filter(F.upper("event_status_code") == "CLOSED")
    rows = left_lookup(seen.withColumn("_event", F.col("event_id")), closed, {"event_id": "event_id"},
                       {f"_{c}": c for c in ("product_code event_sub_type_code event_format_code event_name "
                                             "therapeutic_area_code").split()}, how="inner")
    brand = t["brand_master"].withColumn("_n", F.upper("product_brand_name"))
    rows = left_lookup(rows.withColumn("_product", F.upper("_product_code")), brand, {"_product": "_n"},
                       {"product_id": "mk_product_brand_pm_id"})
    rows = rows.withColumn("_row", F.concat_ws("|", "event_id", "mdm_id", "created_date"))
    rows = _with_target(rows, spans, "mdm_id", "_row", F.col("_on"))
    title = F.concat("_event_name", F.lit(" ("), "event_id", F.lit(")"))
    kind = F.upper("attendee_type")
    rows = rows.select(
        F.concat("mdm_id", "event_id").alias("record_id"), long_key("mdm_id").alias("alignment_string"),
        F.col("_on").alias("activity_date"), F.col("_on").cast("timestamp").alias("timestamp"), "product_id",
        E.renamed("_product_code", V.FRANCHISE_PRODUCT).alias("product_name"),
        F.col("_event_sub_type_code").alias("activity_subchannel"),
        F.col("_event_format_code").alias("tactic_type"), F.col("_event_name").alias("tactic_title"),
        F.col("event_id").alias("tactic_code"), title.alias("tactic_code_desc"),
        known_customer("mdm_id").alias("identified_flag"),
        yes_no(F.col("_planned")).alias("sales_force_target_flag"),
        E.renamed("_therapeutic_area_code", {"SMA": V.AREA_SMA}).alias("therapeutic_area"),
        F.col("attendee_status").alias("activity_type"), title.alias("new_desc"), "attendee_role",
        F.when(kind == "CAREGIVER", "PATIENT").otherwise(F.col("attendee_type")).alias("party_class"),
        kind.alias("party_subtype"), kind.alias("customer_type"))
    own = dict.fromkeys(("source_type", "activity_source", "activity_source_channel"), "MEDFORCE")
    return rows.withColumns(_constants(
        activity_seq_number=1, activity_channel="EVENTS", **own, **_PERSONAL, **_NO_RESENDS))


def digital_branch(flagged: DataFrame, as_of: date) -> DataFrame:
    rows = since(flagged, COMBINED_FROM).filter(F.col("time_date") < as_date(as_of))
    deep, light, contacted = (F.upper(c) == "Y" for c in ("deep_flag", "light_flag", "contacted_flag"))
    coded = F.concat("tactic_title", F.lit("("), "tactic_code", F.lit(")"))
    offered = F.concat("activity_offer_description", F.lit("("), "tactic_code", F.lit(")"))
    mail = F.upper("activity_channel") == "EMAIL & ALERTS"
    new = {
        "record_id": F.col("integration_key"),
        "activity_seq_number": F.when(mail, F.col("activity_seq_number")).otherwise(1),
        "activity_date": F.col("time_date"), "timestamp": F.col("date_timestamp"),
        "product_id": F.col("mk_product_brand_pm_id"), "product_name": F.upper("product_name"),
        "activity_source": F.col("source_code"), "tactic_type": F.col("tactic_em_type"),
        "tactic_code": F.col("actual_tactic_code"), "tactic_code_desc": coded,
        "hcp_tactic_type": F.lit(None).cast("string"),
        "siteorigin": F.when(F.upper("attribute_2_name") == "SITEORIGIN", F.col("attribute_2_value")),
        "sales_force_target_flag": F.col("sf_target"), "deep_engagement_flag": F.col("deep_flag"),
        "light_engagement_flag": F.col("light_flag"),
        "engagement_type": E.engagement_tier(deep, light, contacted),
        "light_deep_engagement_flag": yes_no(deep | light),
        "therapeutic_area": F.upper("therapeutic_area"),
        "new_desc": F.when(F.col("activity_offer_description").isNull(), coded).otherwise(offered),
    }
    kept = [f.name for f in COMBINED.fields if f.name not in new and f.name in rows.columns]
    return rows.select(*kept, *[c.alias(n) for n, c in new.items()])


def mail_key(status: Column | str) -> Column:
    return F.concat(F.lit("EMAIL "), F.upper(F.trim(first_token(status))))


def rep_mail_branch(t: Frames, mails: DataFrame, status: str, moment: str, spans: DataFrame) -> DataFrame:
    """Columns shared by e-mail events and sent e-mails; ``mails`` brings id, status, time and the
    looked-up account, document and product columns."""
    definitions = _definitions(t).filter(ci_eq("activity_source_key1", "VEEVA APPROVED EMAIL"))
    definitions = definitions.withColumn("_t", folded("activity_type_key2"))
    rows = left_lookup(mails.withColumn("_kind", mail_key(status)), definitions, {"_kind": "_t"},
                       {f"_def_{c}": c for c in ("deep_flag", "light_flag", "contacted_flag", "cae_flag",
                                                 "metric_type")})
    brand = t["brand_master"].withColumn("_n", F.upper("product_brand_name"))
    rows = left_lookup(rows.withColumn("_product_up", F.upper("_product")), brand, {"_product_up": "_n"},
                       {"product_id": "mk_product_brand_pm_id"})
    rows = _with_target(rows, spans, "_account", "id", F.to_date(moment))
    tiers = E.tier_columns("_def_deep_flag", "_def_light_flag", "_def_contacted_flag", "_def_cae_flag")
    rows = rows.select(
        F.col("id").alias("record_id"),
        F.concat(F.lit(V.ACCOUNT_PREFIX), "_account").alias("alignment_string"),
        F.to_date(moment).alias("activity_date"), F.col(moment).alias("timestamp"), "product_id",
        F.col("_product_up").alias("product_name"), F.col("_document").alias("tactic_code_desc"),
        F.when(F.col("_account").isNull(), "N").otherwise("Y").alias("identified_flag"),
        yes_no(F.col("_planned")).alias("sales_force_target_flag"),
        *[c.alias(n) for n, c in tiers.items()],
        E.area_of("_product", "_display", "_area").alias("therapeutic_area"),
        F.col("_kind").alias("activity_type"), F.col("_document").alias("new_desc"),
        F.col("_def_metric_type").alias("metric_type"),
        F.when(F.col("_def_metric_type").isNull(), 1).otherwise(0).alias("metric_type_null_flag"))
    party = dict.fromkeys(("party_class", "party_subtype", "customer_type"), "HCP")
    return rows.withColumns(_constants(
        activity_seq_number=1, activity_class="Non-Personal", source_type="RTE", activity_source="SFDC_US",
        activity_source_channel="REP TRIGGERED EMAILS", activity_channel="EMAIL AND ALERTS",
        activity_subchannel="EMAIL", geo_region_code="US", **party, **_NO_RESENDS))


SENT = {"_acct_fk": "account_vod__c", "_doc_fk": "approved_email_template_vod__c",
        "_prod_fk": "product_vod__c", "_display": "product_display_vod__c"}


def look_up_mail(t: Frames, mails: DataFrame, required: bool, hot: DataFrame | None = None) -> DataFrame:
    """Account, document and product of a sent mail; ``required`` drops mails without the first two.  ``hot`` lists
    the accounts whose mails are to be dealt over several tasks."""
    how = "inner" if required else "left"
    account = {"_account": "external_id_vod__c"}
    rows = (left_lookup(mails, t["crm_account"], {"_acct_fk": "id"}, account, how) if hot is None else
            split_lookup(mails, t["crm_account"], "_acct_fk", "id", "id", account, how, hot))
    rows = left_lookup(rows, t["crm_document"], {"_doc_fk": "id"},
                       {"_document": "name", "_record_type": "recordtypeid"}, how)
    return left_lookup(rows, t["crm_product"], {"_prod_fk": "id"},
                       {"_product": "name", "_area": "therapeutic_area_vod__c"})


def mail_events(t: Frames, how: str = "left") -> DataFrame:
    events = t["crm_email_activity"].filter(F.col("activity_datetime_vod__c").isNotNull())
    return left_lookup(events, t["crm_sent_email"], {"sent_email_vod__c": "id"}, SENT, how)


def unanswered_mails(t: Frames, events: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Sent mails without any event, from known owners, with a known record type."""
    sent = t["crm_sent_email"].filter(F.col("email_sent_date_vod__c").isNotNull())
    sent = drop_matching(sent, events, "id", "sent_email_vod__c")
    sent = sent.withColumns({new: F.col(old) for new, old in SENT.items()})
    rows = look_up_mail(t, sent, required=True, hot=hot)
    rows = left_lookup(rows, t["crm_user"], {"ownerid": "id"}, {}, how="inner")
    return left_lookup(rows, t["crm_recordtype"], {"_record_type": "id"}, {}, how="inner")


def combined_activity(t: Frames, flagged: DataFrame, as_of: date) -> DataFrame:
    """Calls, events, digital activity, rep mail events and unanswered rep mails in one contract.

    The four branches that need the party's status look it up together.  Accounts and parties with more than a
    task's share of the rows are found beforehand, by a summary of the sources' keys."""
    spans, hot = target_spans(t), hot_keys(t["crm_sent_email"], "account_vod__c")
    events = look_up_mail(t, mail_events(t), required=False, hot=hot).filter(
        activity_bounds("activity_datetime_vod__c", COMBINED_FROM))
    sent = unanswered_mails(t, t["crm_email_activity"], hot).filter(
        activity_bounds("email_sent_date_vod__c", COMBINED_FROM))
    field = union_conformed(
        call_branch(t, as_of), event_branch(t, spans, as_of),
        rep_mail_branch(t, events, "event_type_vod__c", "activity_datetime_vod__c", spans),
        rep_mail_branch(t, sent, "status_vod__c", "email_sent_date_vod__c", spans), contract=COMBINED)
    return union_conformed(_with_state(field, t), digital_branch(flagged, as_of), contract=COMBINED)
