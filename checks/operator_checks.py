"""Single operators: scans, projections, filters, joins, aggregates, windows, set operations."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.activity_checks import ACTIVITY_SQL, NET_BOUNCE_SQL, SPANS_SQL, UNITS_SQL, WEB_SQL, _BY_TYPE
from checks.registry import AS_OF, Check
from checks.standins import quote
from checks.suppression_checks import ACTIVE, BOUNCES, ELIGIBLE, IN_AREA, opts, states
from contactloom import fixed_values as V
from contactloom.functions import scalar as S
from contactloom.operators import aggregates as A
from contactloom.operators import joins as J
from contactloom.operators import pick as P
from contactloom.operators import reshape as R
from contactloom.operators.ranking import global_rank
from contactloom.operators.rejects import reject_counts, split_rejects
from contactloom.operators.sequence import repeat_flags, row_numbers
from contactloom.operators.spans import clip_spans, interval_join
from contactloom.plans import activity as act
from contactloom.plans import email_engagement as mail
from contactloom.plans import party
from contactloom.plans import ranking as rank
from contactloom.session import use_checkpoint_dir
from contactloom.sources.contracts import TARGET_LIST
from contactloom.sources.layouts import KeyedLayout
from contactloom.sources.tables import load_target_list, materialize, run_parameter, view, write_products

DAY_OF = f"DATE '{AS_OF}'"


def scratch(df: DataFrame) -> str:
    """A fresh path in the shared folder."""
    use_checkpoint_dir(df.sparkSession)
    return f"{df.sparkSession.sparkContext.getCheckpointDir()}/snapshot-{uuid.uuid4().hex}"


def day(c: str) -> str:
    return f"CAST({c} AS DATE)"


# ---- scans, sinks, clock --------------------------------------------------------------------


def partitioned_product(t):
    """Two products written as tables, one partitioned, and read back by partition."""
    counts = t["orders"].groupBy("o_custkey", F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))
    prefix = f"product_{uuid.uuid4().hex[:8]}"
    written = write_products({"counts": counts, "total": t["orders"].agg(F.count("*").alias("n"))}, prefix, {"counts": "status"})
    return written["counts"].filter("status <> 'P'")


def dirty_orders(t):
    """Orders whose customer and day come as text, some of it unreadable or blank."""
    customer = F.when(F.col("o_orderkey") % 13 == 0, F.concat(F.lit("C"), "o_custkey")).when(
        F.col("o_orderkey") % 17 == 0, " ").otherwise(F.col("o_custkey").cast("string"))
    day_text = F.when(F.col("o_orderkey") % 11 == 0, "20219999").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    rows = t["orders"].select("o_orderkey", customer.alias("customer"), day_text.alias("day"))
    return split_rejects(rows, {"customer": S.whole_number("customer"), "day": S.day_from_digits("day")})


def accepted_and_rejected(t):
    accepted, rejected = dirty_orders(t)
    return accepted.withColumn("why", F.lit("")).unionByName(
        rejected.withColumn("why", F.concat_ws("; ", "reject_reasons")).drop("reject_reasons"))


def layered_view(t):
    name = f"big_orders_{uuid.uuid4().hex[:8]}"
    first = view(name, t["orders"].select("o_custkey", "o_orderkey"))
    return view(name + "_by_customer", first.groupBy("o_custkey").agg(F.count("*").alias("n")))


#: All 44 columns in the order of the table; the stand-in fills nine of them, and blank text in a CSV file loads as NULL.
TARGET_LIST_SQL = """SELECT NULL AS id, NULL AS provider_id, nullif(npi, '') AS npi, NULL AS name, NULL AS address, NULL AS city, NULL AS state, NULL AS zip, NULL AS specialty, nullif(neuros, '') AS neuros, nullif(pcps, '') AS pcps, NULL
    AS granular_specialty, nullif(segment, '') AS segment, NULL AS biib_group, NULL AS group_a, NULL AS group_b, NULL AS group_c, nullif(initiator_treator, '') AS initiator_treator, NULL AS initiator_count,
    NULL AS treator_count, nullif(total_initiations, '') AS total_initiations, nullif(symptomatic_trx, '') AS symptomatic_trx, nullif(patient_volume, '') AS patient_volume, nullif(composite_decile, '') AS composite_decile, NULL AS kme_hcp_flag, NULL AS kme_count, NULL AS
    tbm_territory_id, NULL AS tbm_territory, NULL AS tbm_region_id, NULL AS tbm_region, NULL AS tbm_zone_id, NULL AS tbm_zone, NULL AS aal_territory_id,
    NULL AS aal_territory, NULL AS aal_region_id, NULL AS aal_region, NULL AS adrm_territory_id, NULL AS adrm_territory, NULL AS adrm_region_id, NULL AS
    adrm_region, NULL AS account, NULL AS parent_id, NULL AS tier, NULL AS soc
    FROM target_hcp_list"""


def typed_target_list(t):
    source = R.conform(t["target_hcp_list"], TARGET_LIST)
    path = scratch(source)
    source.write.option("header", True).csv(path)
    spark = source.sparkSession
    return load_target_list(spark, path)


SOURCES = {
    "scan_pushdown": Check(
        lambda t: t["lineitem"].filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 40)).select(
            "l_orderkey", "l_linenumber", "l_quantity"),
        "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 40", "l_linenumber"),
    "snapshot_refresh": Check(
        lambda t: materialize(x := t["orders"].groupBy("o_custkey").agg(F.count("*").alias("n")), scratch(x)),
        "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1"),
    "partitioned_product": Check(
        partitioned_product, "SELECT o_custkey, o_orderstatus AS status, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 2"),
    "reject_output": Check(
        accepted_and_rejected,
        """SELECT o_orderkey, customer, day, concat_ws('; ', CASE WHEN o_orderkey % 13 = 0 THEN 'customer: ' || customer END,
           CASE WHEN o_orderkey % 11 = 0 THEN 'day: ' || day END) AS why
           FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'C' || o_custkey WHEN o_orderkey % 17 = 0 THEN ' '
           ELSE CAST(o_custkey AS VARCHAR) END AS customer, CASE WHEN o_orderkey % 11 = 0 THEN '20219999'
           ELSE strftime(CAST(o_orderdate AS DATE), '%Y%m%d') END AS day FROM orders) AS o"""),
    "reject_counts": Check(
        lambda t: reject_counts(dirty_orders(t)[1], "orders"),
        """SELECT 'orders' AS source, column_name, count(*) AS rows FROM (
           SELECT 'customer' AS column_name FROM orders WHERE o_orderkey % 13 = 0 UNION ALL SELECT 'day' FROM orders WHERE o_orderkey % 11 = 0) AS f
           GROUP BY column_name"""),
    "layered_view": Check(layered_view, "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1"),
    "typed_target_list": Check(typed_target_list, TARGET_LIST_SQL, texts="id provider_id name address city state zip specialty granular_specialty biib_group group_a group_b group_c initiator_count treator_count kme_hcp_flag kme_count tbm_territory_id tbm_territory tbm_region_id tbm_region tbm_zone_id tbm_zone aal_territory_id aal_territory aal_region_id aal_region adrm_territory_id adrm_territory adrm_region_id adrm_region account parent_id tier soc"),
    "run_parameter": Check(
        lambda t: t["orders"].filter(S.as_date("2021-01-01") > F.to_date("o_orderdate")).select("o_orderkey").filter(
            run_parameter(t["date_param"], V.HCP_DATE_PARAM) > F.lit("2014-01-01").cast("date")),
        f"""SELECT o_orderkey FROM orders, (SELECT extract_date FROM date_param WHERE etl_name = {quote(V.HCP_DATE_PARAM)}) p
            WHERE p.extract_date > DATE '2014-01-01' AND o_orderdate < DATE '2021-01-01'"""),
    "record_state_policy": Check(
        lambda t: reduce(DataFrame.union, [J.keep_matching(
            t["party_hcp"], party.record_states(t, j), "record_state_cd_fk", "code_sk").select("party_fk", F.lit(j).alias("job"))
            for j in (V.HCP_DATE_PARAM, V.MARKET_DATE_PARAM, "no such job")]),
        " UNION ALL ".join(f"SELECT party_fk, {quote(j)} AS job FROM party_hcp WHERE record_state_cd_fk IN (SELECT code_sk FROM ({states(j)}) s)"
                           for j in (V.HCP_DATE_PARAM, V.MARKET_DATE_PARAM))),
    "as_of_clock": Check(
        lambda t: t["marketing_fact"].filter(S.activity_bounds("activity_time", "2019-01-01", AS_OF)).select("integration_key"),
        f"SELECT integration_key FROM marketing_fact WHERE activity_time >= DATE '2019-01-01' AND activity_time < {DAY_OF}"),
}

# ---- projections ----------------------------------------------------------------------------

_CONTRACT = T.StructType([T.StructField("kind", T.StringType()), T.StructField("id", T.LongType()),
                          T.StructField("amount", T.DoubleType()), T.StructField("note", T.StringType())])


def conform_branches(t):
    orders = t["orders"].select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"))
    events = t["events"].select(F.col("event_id").alias("id"), F.col("event_type").alias("note"), F.lit("event").alias("kind"))
    parts = t["part"].select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("amount"),
                             F.col("p_name").alias("note"))
    return R.union_conformed(orders, events, parts, contract=_CONTRACT)


PROJECTIONS = {
    "renamed_projection": Check(
        lambda t: J.renamed_apart(t["customer"], {"id": "c_custkey", "name": "c_name"}),
        "SELECT c_custkey AS id, c_name AS name FROM customer"),
    "star_plus_columns": Check(
        lambda t: t["supplier"].withColumns({"rich": F.col("s_acctbal") > 5000, "tag": F.lit("S")}),
        "SELECT *, s_acctbal > 5000 AS rich, 'S' AS tag FROM supplier", "s_nationkey rich"),
    "constant_tags": Check(
        lambda t: t["part"].select("p_partkey", F.lit("HCP").alias("customer_type"), F.lit(0).alias("bounce_flag")),
        "SELECT p_partkey, 'HCP' AS customer_type, 0 AS bounce_flag FROM part", "bounce_flag"),
    "conform_union_all": Check(
        conform_branches,
        """SELECT 'order' AS kind, o_orderkey AS id, o_totalprice AS amount, CAST(NULL AS VARCHAR) AS note FROM orders
           UNION ALL SELECT 'event', event_id, NULL, event_type FROM events UNION ALL SELECT 'part', p_partkey, p_retailprice, p_name FROM part"""),
    "chained_alias": Check(
        lambda t: t["lineitem"].withColumn("month_date", S.month_start("l_shipdate")).withColumn(
            "next_month", F.add_months("month_date", 1)).select("month_date", "next_month").distinct(),
        """SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS month_date,
           CAST(date_trunc('month', l_shipdate) + INTERVAL 1 MONTH AS DATE) AS next_month FROM lineitem""", "", "month_date next_month"),
    "blank_to_null": Check(
        lambda t: t["target_hcp_list"].select("npi", S.blank_to_null("patient_volume").alias("volume"), S.blank_to_null("segment", [""]).alias("segment")),
        "SELECT npi, CASE WHEN patient_volume NOT IN ('', '-') THEN patient_volume END AS volume, nullif(segment, '') AS segment FROM target_hcp_list"),
    "sentinel_to_null": Check(
        lambda t: t["attendee"].select("event_id", S.sentinel_to_null("mdm_id").alias("mdm_id")),
        "SELECT event_id, CASE WHEN mdm_id NOT IN ('-1', '', '-', 'NA') THEN mdm_id END AS mdm_id FROM attendee"),
    "percent_text": Check(
        lambda t: t["account_ad_dim"].select("npi_num", S.percent_text("perc_insights_completed").alias("done")),
        "SELECT npi_num, CAST(CAST(round(perc_insights_completed) AS BIGINT) AS VARCHAR) || '%' AS done FROM account_ad_dim"),
    "distinct_wide": Check(
        lambda t: t["lineitem"].select("l_suppkey", "l_returnflag", "l_linestatus", "l_linenumber").distinct(),
        "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus, l_linenumber FROM lineitem", "l_linenumber"),
}

# ---- filters --------------------------------------------------------------------------------

FILTERS = {
    "compare_and_or": Check(
        lambda t: t["customer"].filter(((F.col("c_acctbal") > 5000) & (F.col("c_mktsegment") == "BUILDING")) | (F.col("c_nationkey") < 2)).select("c_custkey"),
        "SELECT c_custkey FROM customer WHERE c_acctbal > 5000 AND c_mktsegment = 'BUILDING' OR c_nationkey < 2"),
    "case_insensitive_equals": Check(
        lambda t: t["marketing_fact"].filter(S.ci_eq("activity_type_name", "email sent")).select("integration_key", "activity_type_name"),
        "SELECT integration_key, activity_type_name FROM marketing_fact WHERE trim(lower(activity_type_name)) = 'email sent'"),
    "in_and_not_in_list": Check(
        lambda t: t["party_communication"].select("integration_key", F.col("bounced_inform_flg").isin("N", "X").alias("listed"),
                                                  (~F.col("bounced_inform_flg").isin("N", "X")).alias("unlisted")),
        "SELECT integration_key, bounced_inform_flg IN ('N', 'X') AS listed, bounced_inform_flg NOT IN ('N', 'X') AS unlisted FROM party_communication",
        doubles="listed unlisted"),
    "semi_join": Check(
        lambda t: J.keep_matching(t["customer"], t["orders"].filter("o_orderstatus = 'P'"), "c_custkey", "o_custkey").select("c_custkey"),
        "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')"),
    "anti_join_null_guard": Check(
        lambda t: J.drop_matching(t["crm_sent_email"], t["crm_email_activity"], "id", "sent_email_vod__c").select("id"),
        "SELECT id FROM crm_sent_email WHERE id NOT IN (SELECT sent_email_vod__c FROM crm_email_activity WHERE sent_email_vod__c IS NOT NULL)"),
    "anti_join_is_null": Check(
        lambda t: J.without_match(t["customer"], t["orders"].filter("o_totalprice > 300000"), "c_custkey", "o_custkey").select("c_custkey"),
        "SELECT c_custkey FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 300000) o ON o_custkey = c_custkey WHERE o_custkey IS NULL"),
    "like_patterns": Check(
        lambda t: t["part"].filter(S.like_any(F.upper("p_name"), ["RED%", "%BOLT%"]) & ~F.col("p_brand").like("%1%")).select("p_partkey"),
        "SELECT p_partkey FROM part WHERE (starts_with(upper(p_name), 'RED') OR contains(upper(p_name), 'BOLT')) AND p_brand NOT LIKE '%1%'"),
    "like_escape": Check(
        lambda t: t["marketing_fact"].select("integration_key", S.like_escape(F.upper("tactic_cd"), V.TACTIC_CAMPAIGN_RESEND).alias("resend")),
        "SELECT integration_key, regexp_full_match(upper(tactic_cd), '.*-.*-.*_R.*') AS resend FROM marketing_fact",
        doubles="resend"),
    "present_sentinel": Check(
        lambda t: t["parent_hco"].filter(S.present("mk_account_vnt_id") & S.present("mk_parent_account_vnt_id")).groupBy("mk_account_vnt_id").agg(F.count("*").alias("n")),
        """SELECT mk_account_vnt_id, count(*) AS n FROM parent_hco WHERE coalesce(mk_account_vnt_id, '-1') <> '-1'
           AND coalesce(mk_parent_account_vnt_id, '-1') <> '-1' GROUP BY 1"""),
    "any_slot_equals": Check(
        lambda t: t["field_call"].filter(S.any_slot_equals(["first_product", "second_product", "third_product", "fourth_product", "fifth_product"],
                                                           V.ALZ_PRODUCT)).groupBy("call_type").agg(F.count("*").alias("n")),
        f"""SELECT call_type, count(*) AS n FROM field_call WHERE {quote(V.ALZ_PRODUCT)} IN (coalesce(upper(first_product), ''),
            coalesce(upper(second_product), ''), coalesce(upper(third_product), ''), coalesce(upper(fourth_product), ''), coalesce(upper(fifth_product), ''))
            GROUP BY 1"""),
    "open_ended_definitions": Check(
        lambda t: J.left_lookup(t["marketing_fact"].select("integration_key", S.folded("activity_type_name").alias("k")),
                                t["kpi_definition"].filter(S.open_ended("end_date")).withColumn("d", S.folded("activity_type_key2")),
                                {"k": "d"}, {"source": "activity_source_key1"}),
        """SELECT integration_key, upper(trim(activity_type_name)) AS k, activity_source_key1 AS source FROM marketing_fact LEFT JOIN kpi_definition
           ON upper(trim(activity_type_key2)) = upper(trim(activity_type_name)) AND strftime(end_date, '%y') = '99'"""),
}

# ---- joins ----------------------------------------------------------------------------------


def hot_lookup(t):
    """A third of the orders carry the unknown key."""
    facts = t["orders"].select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, "-1").otherwise(
        F.col("o_custkey").cast("string")).alias("key"))
    dim = t["customer"].select(F.when(F.col("c_custkey") == 7, "-1").otherwise(F.col("c_custkey").cast("string")).alias("id"), "c_name")
    return J.spread_lookup(facts, dim, "key", "id", "o_orderkey", {"name": "c_name"})


def unnamed_hot_lookup(t):
    """A third of the line items belong to one order, a fifth to none; nobody says so."""
    key = F.when(F.col("l_linenumber") == 1, 7).when(F.col("l_linenumber") == 2, None).otherwise(F.col("l_orderkey"))
    facts = t["lineitem"].select("l_orderkey", "l_linenumber", key.cast("bigint").alias("key"))
    facts = facts.withColumn("row", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    orders = t["orders"].withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))
    return J.split_lookup(facts, orders, "key", "o_orderkey", "row", {"status": "o_orderstatus"}).drop("row")


def plan_days(t):
    facts = t["marketing_fact"].select("integration_key", "mk_account_vnt_id", "activity_time")
    return interval_join(facts, act.target_spans(t), "mk_account_vnt_id", "mk_account_vnt_id", "integration_key", F.to_date("activity_time"),
                         "cycle_plan_start_date", "updated_cycle_plan_end_date", "planned").select("integration_key", "planned")


def stored_plan_days(t):
    """The same from tables in the same buckets, where no fact moves."""
    facts = t["marketing_fact"].select("integration_key", "mk_account_vnt_id", F.to_date("activity_time").alias("day"))
    layout = KeyedLayout.create(f"plan_days_{uuid.uuid4().hex[:8]}", facts, "mk_account_vnt_id",
                                int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    layout.store_facts(facts, "facts", "mk_account_vnt_id", "integration_key")
    layout.store_lookup(act.target_spans(t), "spans", "mk_account_vnt_id")
    return layout.interval_join("facts", "mk_account_vnt_id", "spans", "mk_account_vnt_id", "day", "cycle_plan_start_date",
                                "updated_cycle_plan_end_date", "planned").select("integration_key", "planned")


#: Facts with the flag whether their day is in a span of their account.
PLAN_DAYS_SQL = f"""SELECT integration_key, s.mk_account_vnt_id IS NOT NULL AS planned FROM marketing_fact f LEFT JOIN ({SPANS_SQL}) s
            ON s.mk_account_vnt_id = f.mk_account_vnt_id AND CAST(activity_time AS DATE) >= cycle_plan_start_date
            AND CAST(activity_time AS DATE) <= updated_cycle_plan_end_date"""


def managers(t):
    staff = t["employee_to_territory"]
    rows = staff.filter("territory_hierarchy_level = 'territory__aln'").select("employee_name", "field_force_name", "region_number", "zone_number")
    return J.level_managers(rows, staff, "field_force_name", "territory_hierarchy_level", [
        ("region__aln", "region_number", {"region_boss": "employee_name"}), ("zone__c", "zone_number", {"zone_boss": "employee_name"})])


def regions_of(t):
    nations = t["nation"].select(F.col("n_nationkey").alias("child"), F.col("n_regionkey").cast("int").alias("parent"))
    return J.resolve_ancestor(t["customer"].select("c_custkey", "c_nationkey"), nations, "c_nationkey", "child", "parent").select(
        "c_custkey", F.col("_ancestor1").alias("parent"), F.col("_ancestor2").alias("grandparent"))


JOINS = {
    "inner_equi_join": Check(
        lambda t: J.left_lookup(t["orders"].select("o_orderkey", "o_custkey"), t["customer"],
                                {"o_custkey": "c_custkey"}, {"segment": "c_mktsegment"}, how="inner"),
        "SELECT o_orderkey, o_custkey, c_mktsegment AS segment FROM orders JOIN customer ON c_custkey = o_custkey"),
    "left_equi_join": Check(
        lambda t: J.left_lookup(t["customer"].select("c_custkey"), t["orders"], {"c_custkey": "o_custkey"}, {"o_orderkey": "o_orderkey"}),
        "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders o ON o_custkey = c_custkey",
        doubles="o_orderkey"),
    "defeated_outer_join": Check(
        lambda t: party.area_path(t, t["party_market"]).filter(F.col("parent_ta") == "NEUROLOGY").select("party_market_sk", "child_ta"),
        """SELECT party_market_sk, c.therapeutic_area AS child_ta FROM party_market LEFT JOIN therapeutic_area c ON c.therapeutic_area_sk = therapeutic_area_fk
           LEFT JOIN therapeutic_area p ON p.therapeutic_area_sk = c.parent_therapeutic_area_fk WHERE p.therapeutic_area = 'NEUROLOGY'"""),
    "comma_join": Check(
        lambda t: party.opt_states(t, keep_programs=False).select("party_fk", "program_name", "opt_out_flag"),
        f"SELECT party_fk, program_name, opt_out_flag FROM ({opts(False)}) o"),
    "interval_join": Check(plan_days, PLAN_DAYS_SQL, "planned"),
    "stored_interval_join": Check(stored_plan_days, PLAN_DAYS_SQL, "planned"),
    "computed_key_join": Check(
        lambda t: J.left_lookup(t["account_dim"].withColumn("key", F.concat(F.lit("VNID"), "mk_account_vnt_id")), t["engagement_segment"],
                                {"key": "mdm_id"}, {"segment": "cust_eng_segment"}).select("key", "segment"),
        """SELECT 'VNID' || mk_account_vnt_id AS key, cust_eng_segment AS segment FROM account_dim
           LEFT JOIN engagement_segment ON mdm_id = 'VNID' || mk_account_vnt_id"""),
    "sentinel_spread_join": Check(
        hot_lookup,
        """SELECT o_orderkey, key, c_name AS name FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '-1' ELSE CAST(o_custkey AS VARCHAR) END AS key
           FROM orders) o LEFT JOIN (SELECT CASE WHEN c_custkey = 7 THEN '-1' ELSE CAST(c_custkey AS VARCHAR) END AS id, c_name FROM customer) c ON id = key"""),
    "split_hot_lookup": Check(
        unnamed_hot_lookup,
        """SELECT l_orderkey, l_linenumber, key, o_orderstatus AS status FROM (SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 7
           WHEN 2 THEN NULL ELSE l_orderkey END AS key FROM lineitem) l LEFT JOIN orders ON o_orderkey = key""", "l_orderkey l_linenumber", doubles="key"),
    "level_managers": Check(
        managers,
        """SELECT e.employee_name, e.field_force_name, e.region_number, e.zone_number, r.employee_name AS region_boss, z.employee_name AS zone_boss
           FROM employee_to_territory e LEFT JOIN employee_to_territory r ON r.field_force_name = e.field_force_name AND r.region_number = e.region_number
           AND r.territory_hierarchy_level = 'region__aln' LEFT JOIN employee_to_territory z ON z.field_force_name = e.field_force_name
           AND z.zone_number = e.zone_number AND z.territory_hierarchy_level = 'zone__c' WHERE e.territory_hierarchy_level = 'territory__aln'"""),
    "ancestor_lookup": Check(
        regions_of,
        """SELECT c_custkey, a.n_regionkey AS parent, b.n_regionkey AS grandparent FROM customer LEFT JOIN nation a ON a.n_nationkey = c_nationkey
           LEFT JOIN nation b ON b.n_nationkey = a.n_regionkey""", "parent grandparent"),
    "multi_role_decode": Check(
        lambda t: J.decode(t["party_hcp"], t["code"], {"hcp_type_cd_fk": "hcp_type", "practice_type_cd_fk": "practice", "hcp_status_cd_fk": "status"}).select(
            "party_fk", "hcp_type", "practice", "status"),
        """SELECT party_fk, a.code_name AS hcp_type, b.code_name AS practice, c.code_name AS status FROM party_hcp LEFT JOIN code a ON a.code_sk = hcp_type_cd_fk
           LEFT JOIN code b ON b.code_sk = practice_type_cd_fk LEFT JOIN code c ON c.code_sk = hcp_status_cd_fk"""),
    "scalar_lookup": Check(
        lambda t: J.left_lookup(t["party_merge_map"], t["party"].filter(F.col("mdm_key").like("LH%")), {"survivor_party_fk": "party_sk"},
                                {"new_mdm_id": "mdm_key"}).select("survivor_party_fk", "new_mdm_id"),
        """SELECT survivor_party_fk, (SELECT max(mdm_key) FROM party WHERE party_sk = survivor_party_fk AND mdm_key LIKE 'LH%') AS new_mdm_id
           FROM party_merge_map"""),
    "presence_flag": Check(
        lambda t: J.exists_flag(t["customer"].select("c_custkey"), t["orders"].filter("o_totalprice > 450000"), "c_custkey", "o_custkey", "big"),
        "SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000) THEN 'Y' ELSE 'N' END AS big FROM customer"),
    "eligible_persons": Check(party.eligible_persons, ELIGIBLE),
    "parties_in_area": Check(lambda t: party.parties_in_area(t).distinct(), f"SELECT DISTINCT party_fk FROM ({IN_AREA}) a"),
    "active_market_rows": Check(
        lambda t: J.keep_matching(t["party_market"], party.active_codes(t), "record_state_cd_fk", "code_sk").select("party_market_sk"),
        f"SELECT party_market_sk FROM party_market WHERE record_state_cd_fk IN ({ACTIVE})"),
}

# ---- aggregates -----------------------------------------------------------------------------

_BUCKET = ["SENT", "OPENED", "CLICKED", "BOUNCED"]
CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"


def cents(c: str = "l_extendedprice"):
    return F.round(F.col(c) * 100).cast("bigint")


def event_days(t):
    return t["events"].select("event_id", "user_id", "event_type", "props", "ts", F.to_date("ts").alias("time_date"),
                              S.month_start("ts").alias("month_date"), S.week_start("ts").alias("week_begin_date"))


_KINDS = {"signup": "EMAIL SENT", "view": "EMAIL OPENED", "click": "CLICKED LINK ON EMAIL", "error": "EMAIL BOUNCED"}


def event_funnel(t):
    """The mail funnel on the events table: repeat flags, three grains, conditional counts."""
    rows = event_days(t).withColumn("activity_type", S.label_code("event_type", _KINDS))
    flags = {"monthly": ["month_date"], "weekly": ["week_begin_date"], "overall": []}
    rows = repeat_flags(rows, ["user_id", "activity_type", "props"], flags, [F.col("ts"), F.col("event_id")])
    rows = rows.withColumns({f: F.col(f).cast("int") for f in flags})
    grains = [("Overall_Level", "time_date", "overall"), ("Monthly_Level", "month_date", "monthly"), ("Weekly_Level", "week_begin_date", "weekly")]
    out = A.rollup_grains(rows, ["props"], grains, A.email_funnel("activity_type", "user_id"), "aggregate_date", "kpi_level")
    return out.withColumn("total_delivered", A.delivered())


def _event_grain(level: str, trunc: str, part: str) -> str:
    counts = ", ".join(f"count(*) FILTER (WHERE event_type = {quote(e)}) AS {n}" for e, n in (
        ("signup", "total_sends"), ("view", "total_opens"), ("click", "total_clicks"), ("error", "total_bounces")))
    return f"""SELECT props, {trunc} AS aggregate_date, {quote(level)} AS kpi_level, {counts} FROM (SELECT * FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type, props{part} ORDER BY CAST(ts AS DATE), ts, event_id) = 1) e GROUP BY 1, 2"""


_WEEK, _MONTH = "CAST(date_trunc('week', ts) AS DATE)", "CAST(date_trunc('month', ts) AS DATE)"
EVENT_FUNNEL_SQL = f"""SELECT *, greatest(total_sends - total_bounces, 0) AS total_delivered FROM ({_event_grain('Overall_Level', 'CAST(ts AS DATE)', '')}
    UNION ALL {_event_grain('Monthly_Level', _MONTH, ', ' + _MONTH)} UNION ALL {_event_grain('Weekly_Level', _WEEK, ', ' + _WEEK)}) g"""


def net_bounce_rows(t):
    return act.net_bounces(act.newest_activity(t))


NET_INTS = "email_opened email_bounced email_sent clicked_link_on_email bounce_flag"

AGGREGATES = {
    "group_distinct": Check(lambda t: P.group_distinct(t["lineitem"], ["l_suppkey", "l_returnflag"]),
                            "SELECT l_suppkey, l_returnflag FROM lineitem GROUP BY 1, 2"),
    "sum_by": Check(lambda t: A.sum_by(t["lineitem"].withColumn("c", cents()), ["l_partkey"], "c", "cents"),
                    f"SELECT l_partkey, CAST(sum({CENTS}) AS BIGINT) AS cents FROM lineitem GROUP BY 1"),
    "sum_when": Check(
        lambda t: t["lineitem"].groupBy("l_suppkey").agg(A.sum_when(F.col("l_returnflag") == "R", cents()).alias("returned"),
                                                         A.sum_when(F.col("l_returnflag") != "R", cents()).alias("kept")),
        f"""SELECT l_suppkey, CAST(sum({CENTS}) FILTER (WHERE l_returnflag = 'R') AS BIGINT) AS returned,
            CAST(sum({CENTS}) FILTER (WHERE l_returnflag <> 'R') AS BIGINT) AS kept FROM lineitem GROUP BY 1"""),
    "count_when": Check(
        lambda t: t["events"].groupBy("user_id").agg(A.count_when(F.col("event_type") == "click", "event_id").alias("clicks"),
                                                     A.count_when(F.col("value") > 50).alias("large")),
        "SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS clicks, count(*) FILTER (WHERE value > 50) AS large FROM events GROUP BY 1"),
    "count_distinct": Check(lambda t: A.count_distinct(t["lineitem"], ["l_suppkey"], "l_partkey", "parts"),
                            "SELECT l_suppkey, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1"),
    "count_distinct_when": Check(
        lambda t: A.count_distinct_when(t["lineitem"], ["l_returnflag"], "l_partkey", {
            "open_parts": F.col("l_linestatus") == "O", "bulk_parts": F.col("l_quantity") > 45}),
        """SELECT l_returnflag, count(DISTINCT CASE WHEN l_linestatus = 'O' THEN l_partkey END) AS open_parts,
           count(DISTINCT CASE WHEN l_quantity > 45 THEN l_partkey END) AS bulk_parts FROM lineitem GROUP BY 1"""),
    "min_max_when": Check(
        lambda t: t["orders"].groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"), F.max("o_totalprice").alias("top"),
                                                       A.min_when(F.col("o_orderstatus") == "P", "o_orderdate").alias("first_p")),
        """SELECT o_custkey, min(o_orderdate) AS first, max(o_totalprice) AS top, min(o_orderdate) FILTER (WHERE o_orderstatus = 'P') AS first_p
           FROM orders GROUP BY 1""", "", "first first_p"),
    "flag_lattice": Check(
        lambda t: A.flag_lattice(t["events"], ["user_id", "props"], F.col("event_type"), {"purchase": 3, "click": 2}, 1, "level"),
        """SELECT user_id, props, CASE WHEN bool_or(event_type = 'purchase') THEN 3 WHEN bool_or(event_type = 'click') THEN 2 ELSE 1 END AS level
           FROM events GROUP BY 1, 2""", "level"),
    "event_mail_funnel": Check(event_funnel, EVENT_FUNNEL_SQL, "", "aggregate_date"),
    "pivot_sum": Check(
        lambda t: R.pivot_sum(t["lineitem"].withColumn("c", cents()), ["l_suppkey"], "l_returnflag", ["A", "N", "R"], "c", ["a", "n", "r"]),
        f"SELECT l_suppkey, " + ", ".join(f"CAST(sum(CASE WHEN l_returnflag = '{x}' THEN {CENTS} END) AS BIGINT) AS {x.lower()}" for x in "ANR")
        + " FROM lineitem GROUP BY 1"),
    "unpivot_without_nulls": Check(
        lambda t: R.unpivot_cols(t["parent_hco"], ["mk_account_vnt_id", "mk_parent_account_vnt_id"], V.AFFILIATION_COLUMNS, "name", "kind"),
        " UNION ALL ".join(f"SELECT mk_account_vnt_id, mk_parent_account_vnt_id, {quote(c)} AS name, {c} AS kind FROM parent_hco WHERE {c} IS NOT NULL"
                           for c in V.AFFILIATION_COLUMNS)),
    "last_date_per_pair": Check(
        lambda t: A.last_date(t["lineitem"], ["l_partkey", "l_suppkey"], F.to_date("l_shipdate"), "last"),
        "SELECT l_partkey, l_suppkey, max(CAST(l_shipdate AS DATE)) AS last FROM lineitem GROUP BY 1, 2", "", "last"),
    "bounce_summary": Check(lambda t: party.bounces(t).select("customer_fk", "bounce_date", "bounce_flag"), BOUNCES, "bounce_flag", "bounce_date"),
    "net_bounce": Check(net_bounce_rows, f"WITH activity AS ({ACTIVITY_SQL}) {NET_BOUNCE_SQL}", NET_INTS),
    "trailing_units": Check(lambda t: rank.brand_units(t, AS_OF), UNITS_SQL, doubles=" ".join(
        f"{stem}_units_{n}_months" for n in (12, 6) for stem in ("ms", "biib", *V.UNIT_BRANDS))),
}

# ---- windows --------------------------------------------------------------------------------


def sequence_rows(t):
    """Newest first per customer and status; a third of the rows share one key."""
    rows = t["orders"].select("o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice", F.when(F.col("o_orderkey") % 3 == 0, None).otherwise(
        F.col("o_custkey")).alias("who")).withColumn("d", F.to_date("o_orderdate"))
    out = row_numbers(rows, ["who", "o_orderstatus"], [F.col("d").desc(), F.col("o_totalprice").desc_nulls_first(), F.col("o_orderkey").asc()], "seq")
    return out.select("o_orderkey", "seq")


def repeat_rows(t):
    rows = repeat_flags(event_days(t), ["event_type", "props"], {"monthly": ["month_date"], "weekly": ["week_begin_date"], "overall": []},
                        [F.col("ts"), F.col("event_id")])
    return rows.select("event_id", "monthly", "weekly", "overall")


def customer_value(t):
    totals = t["orders"].groupBy("o_custkey").agg(F.sum(cents("o_totalprice")).alias("cents"), F.max("o_orderstatus").alias("status"))
    return totals.withColumn("band", (F.col("cents") / 20000000).cast("bigint"))


def neighbours(t):
    order = Window.partitionBy("mk_account_vnt_id").orderBy(F.col("cycle_plan_start_date").asc_nulls_last())
    spans = act.target_spans(t)
    return spans.select("mk_account_vnt_id", "cycle_plan_start_date", F.lag("cycle_plan_end_date").over(order).alias("before"),
                        F.lead("cycle_plan_start_date").over(order).alias("after"))


_SPAN_TEXTS = "cycle_plan_start_date cycle_plan_end_date updated_cycle_plan_end_date"
_ORDER_SPANS = """SELECT o_custkey, CAST(o_orderdate AS DATE) AS start, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INTEGER) AS stop FROM orders"""


def order_spans(t):
    spans = t["orders"].select("o_custkey", F.to_date("o_orderdate").alias("start"),
                               F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 90).cast("int")).alias("stop"))
    return clip_spans(spans, "o_custkey", "start", "stop", "clipped")


ORDER_SPANS_SQL = f"""SELECT o_custkey, start, stop, least(stop, coalesce(CAST(nxt - 1 AS DATE), stop)) AS clipped FROM (
    SELECT *, lead(start) OVER (PARTITION BY o_custkey ORDER BY start) AS nxt FROM (SELECT * FROM (
        SELECT o_custkey, start, max(stop) AS stop, lag(max(stop)) OVER (PARTITION BY o_custkey ORDER BY start) AS prev FROM ({_ORDER_SPANS}) r GROUP BY 1, 2) l
        WHERE prev IS NULL OR stop > prev) k) n"""

WINDOWS = {
    "first_per_key": Check(
        lambda t: P.first_per_key(t["orders"], ["o_custkey"], [P.newest("o_totalprice"), P.oldest("o_orderkey")]).select("o_custkey", "o_orderkey"),
        "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1"),
    "latest_address": Check(
        lambda t: P.latest_contact(t["party_address"], "party_fk", "last_load_ts", "integration_key").select("party_fk", "city_name"),
        """SELECT party_fk, city_name FROM party_address QUALIFY row_number() OVER (PARTITION BY party_fk ORDER BY date_trunc('second', last_load_ts)
           DESC NULLS FIRST, integration_key DESC) = 1"""),
    "first_touch": Check(lambda t: mail.web_lead_source(t, mail.by_type_key()), WEB_SQL.format(key=_BY_TYPE)),
    "first_merge": Check(
        lambda t: P.first_merge(t["party_merge_map"], "non_survivor_party_fk", "src_merge_dt"),
        "SELECT non_survivor_party_fk, min(src_merge_dt) AS src_merge_dt FROM party_merge_map GROUP BY 1", "", "src_merge_dt",
        "non_survivor_party_fk"),
    "latest_opt_state": Check(lambda t: party.opt_states(t, keep_programs=True).select("party_fk", F.upper("program_name").alias("program_name"),
                                                                                         "iw_flg", "opt_out_flag", "opt_out_date"),
                              opts(True), "", "opt_out_date"),
    "activity_sequence": Check(
        sequence_rows,
        """SELECT o_orderkey, row_number() OVER (PARTITION BY CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END, o_orderstatus
           ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey) AS seq FROM orders"""),
    "repeat_flags": Check(
        repeat_rows,
        """SELECT event_id, row_number() OVER (PARTITION BY event_type, props, date_trunc('month', ts) ORDER BY ts, event_id) > 1 AS monthly,
           row_number() OVER (PARTITION BY event_type, props, date_trunc('week', ts) ORDER BY ts, event_id) > 1 AS weekly,
           row_number() OVER (PARTITION BY event_type, props ORDER BY ts, event_id) > 1 AS overall FROM events""", "monthly weekly overall"),
    "span_neighbours": Check(
        neighbours,
        f"""SELECT mk_account_vnt_id, cycle_plan_start_date, lag(cycle_plan_end_date) OVER w AS before, lead(cycle_plan_start_date) OVER w AS after
            FROM ({SPANS_SQL}) s WINDOW w AS (PARTITION BY mk_account_vnt_id ORDER BY cycle_plan_start_date)""", "", "cycle_plan_start_date before after"),
    "clip_plan_spans": Check(act.target_spans, SPANS_SQL, "", _SPAN_TEXTS),
    "clip_order_spans": Check(order_spans, ORDER_SPANS_SQL, "", "start stop clipped"),
    "global_rank": Check(
        lambda t: global_rank(customer_value(t), ["status", "band"], [F.col("status").desc(), F.col("band").desc()], "position").select("o_custkey", "position"),
        """SELECT o_custkey, rank() OVER (ORDER BY max(o_orderstatus) DESC,
           CAST(floor(sum(CAST(round(o_totalprice * 100) AS BIGINT)) / 20000000) AS BIGINT) DESC) AS position FROM orders GROUP BY 1"""),
}

SETS = {
    "union_all_positional": Check(
        lambda t: t["customer"].select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")).union(t["supplier"].select("s_name", "s_nationkey")),
        "SELECT c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT s_name, s_nationkey FROM supplier", "nation"),
    "union_distinct": Check(
        lambda t: R.union_distinct(t["party_patient"].select("party_fk"), t["party_contact"].select("party_fk")),
        "SELECT party_fk FROM party_patient UNION SELECT party_fk FROM party_contact"),
    "parties_of_two_populations": Check(
        rank.party_classes,
        """SELECT DISTINCT mk_patient_gne_id AS mdm_id, upper(patient_class) AS _class FROM patient_dim WHERE mk_patient_gne_id <> '-1'
           UNION ALL SELECT mk_account_vnt_id, upper(account_class) FROM account_dim WHERE mk_account_vnt_id <> '-1'"""),
}

CHECKS = {**SOURCES, **PROJECTIONS, **FILTERS, **JOINS, **AGGREGATES, **WINDOWS, **SETS}
