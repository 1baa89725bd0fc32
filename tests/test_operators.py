"""Operators on small tables: NULLs, ties, sentinels, hot keys; compared with plain windows and joins."""

import re
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from contactloom import fixed_values as V
from contactloom.functions import scalar as S
from contactloom.functions.email import blocked_domain, invalid_email
from contactloom.functions.engagement import patient_segment
from contactloom.operators import joins as J
from contactloom.operators import suppression as sup
from contactloom.operators.aggregates import bounce_summary, count_distinct_when, delivered, rollup_grains
from contactloom.operators.pick import first_per_key, newest, oldest
from contactloom.operators.ranking import global_rank
from contactloom.operators.reshape import conform, union_conformed, unpivot_cols
from contactloom.operators.sequence import in_ranges, repeat_flags, row_numbers, row_numbers_by_code
from contactloom.operators.spans import clip_spans, interval_join
from contactloom.sources.contracts import COMBINED, INTERACTION, TARGET_LIST


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.fixture(scope="module")
def hot(spark):
    """2,000 rows; a third share one key, some keys and days are NULL, many times tie."""
    return spark.range(2000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 17 == 0, None).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))).alias("key"),
        F.when(F.col("id") % 29 == 0, None).otherwise(F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 45).cast("int"))).alias("day"),
        (F.col("id") % 5).alias("hour")).repartition(6)


def test_row_numbers_equal_window(hot):
    order = [F.col("day").desc_nulls_first(), F.col("hour").desc(), F.col("id").asc()]
    expected = hot.select("id", F.row_number().over(Window.partitionBy("key").orderBy(*order)).alias("n"))
    assert rows_of(row_numbers(hot, ["key"], order, "n").select("id", "n")) == rows_of(expected)
    assert row_numbers(hot.filter("false"), ["key"], order, "n").isEmpty()


def test_row_numbers_split_any_key(spark):
    """Half of all rows share key and day: no range has more than twice the mean, and the numbers run through all of them."""
    rows = spark.range(40_000).select("id", F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("key"), F.lit(date(2024, 1, 1)).alias("day"))
    order = [F.col("day").desc(), F.col("id").asc()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would make one range
    try:
        sizes = [r["count"] for r in in_ranges(rows, ["key"], order, "test-ranges").groupBy("_range").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 1 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    got = row_numbers(rows, ["key"], order, "n").filter("key = 0").orderBy("id").collect()
    assert [r.n for r in got] == list(range(1, 20_001))


def test_repeat_flags_equal_windows(hot):
    data = hot.filter("day is not null").withColumn("month", S.month_start("day")).withColumn("week", S.week_start("day"))

    def flag(*extra):
        return F.row_number().over(Window.partitionBy("key", *extra).orderBy("day", "hour", "id")) > 1

    expected = data.select("id", flag("month").alias("m"), flag("week").alias("w"), flag().alias("o"))
    got = repeat_flags(data, ["key"], {"m": ["month"], "w": ["week"], "o": []}, [F.col("day"), F.col("hour"), F.col("id")])
    assert rows_of(got.select("id", "m", "w", "o")) == rows_of(expected)


def test_repeat_flags_of_one_hot_day(spark):
    """Half of all rows share key and day: no window and no sort of the group is left in the plan."""
    rows = spark.range(10_000).select("id", F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("key"))
    got = repeat_flags(rows, ["key"], {"o": []}, [F.col("id")])
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.filter("key = 0 AND NOT o").count() == 1 and got.filter("key <> 0 AND o").isEmpty()


def test_global_rank_equals_window(hot):
    order = [F.col("hour").desc(), F.col("key").asc_nulls_last()]
    expected = hot.select("id", F.rank().over(Window.orderBy(*order)).alias("r"))
    assert rows_of(global_rank(hot, ["hour", "key"], order, "r", 7).select("id", "r")) == rows_of(expected)


def test_global_rank_moves_tuples_not_rows(spark):
    """Ten tuples and many rows: what is ranked has ten rows."""
    rows = spark.range(20_000).select("id", (F.col("id") % 10).alias("band"))
    ranked = global_rank(rows, ["band"], [F.col("band").desc()], "r", 4)
    assert rows_of(ranked.groupBy("band", "r").count()) == rows_of(spark.createDataFrame([(9 - k, 1 + 2000 * k, 2000) for k in range(10)], "band long, r long, n long"))
    written = spark.read.parquet(*{f.rsplit("/", 1)[0] for f in ranked.inputFiles()})
    assert written.count() == 10 and set(written.columns) == {"band", "_n", "_part"}


def test_spread_join_equals_plain_join(spark, hot):
    dim = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), (None, 4), ("zz", 5)], "k string, v int")
    got = J.spread_join(hot, dim, "key", "k", "id", sentinels=("hot",), salts=5).select("id", "v")
    expected = hot.join(dim, hot["key"] == dim["k"], "left").select("id", "v")
    assert rows_of(got) == rows_of(expected)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_split_join_equals_plain_join(spark, hot, how):
    dim = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), (None, 4), ("zz", 5)], "k string, v int")
    got = J.split_join(hot, dim, "key", "k", "id", how, partitions=8).select("id", "v")
    assert rows_of(got) == rows_of(hot.join(dim, hot["key"] == dim["k"], how).select("id", "v"))
    none = J.split_join(hot.filter("false"), dim, "key", "k", "id", how)
    assert none.isEmpty() and J.split_join(hot, dim.filter("false"), "key", "k", "id", how).count() == (2000 if how == "left" else 0)


def test_split_join_finds_and_deals_out_a_hot_key(spark):
    """Half of all rows under a key nobody named, an eighth under none: no salt gets far above a task's share."""
    rows = spark.range(8000).select("id", F.when(F.col("id") % 2 == 0, -5).when(F.col("id") % 8 != 1, F.col("id")).alias("key"))
    assert rows_of(J.hot_keys(rows, "key", 16)) == [(-5, 10)]  # 4000 of 7000 keyed rows, 437.5 a share
    dim = spark.createDataFrame([(-5, "x"), (3, "y")], "k bigint, v string")
    joined = J.split_join(rows.hint("merge"), dim, "key", "k", "id", partitions=16)
    left = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in left and joined.filter("v = 'x'").count() == 4000
    sizes = rows.filter("key = -5").groupBy(F.pmod(F.xxhash64("id"), F.lit(10))).count().collect()
    assert len(sizes) == 10 and max(r["count"] for r in sizes) < 2 * 4000 / 10


def test_first_per_key_null_order_and_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", None, "y"), ("b", 2, "z"), ("b", 2, "w"), (None, 5, "n")], "k string, v int, id string")
    assert rows_of(first_per_key(df, ["k"], [newest("v"), oldest("id")])) == [("a", None, "y"), ("b", 2, "w"), (None, 5, "n")]
    assert ("a", 1, "x") in rows_of(first_per_key(df, ["k"], [newest("v", nulls_last=True), oldest("id")]))


def test_clipped_spans_are_disjoint(spark):
    base = spark.range(3000).select((F.col("id") % 50).cast("string").alias("k"),
                                    F.date_add(F.lit(date(2020, 1, 1)), (F.col("id") * 37 % 400).cast("int")).alias("s"), "id")
    spans = base.withColumn("e", F.date_add("s", (F.col("id") * 13 % 60).cast("int")))
    out = clip_spans(spans, "k", "s", "e", "c").collect()
    per = {}
    for r in out:
        per.setdefault(r["k"], []).append((r["s"], r["c"]))
    for items in per.values():
        items.sort()
        assert all(a[1] < b[0] for a, b in zip(items, items[1:], strict=False))


def test_clip_spans_rules(spark):
    d = date
    spans = spark.createDataFrame([
        ("a", d(2020, 1, 1), d(2020, 1, 31)), ("a", d(2020, 1, 1), d(2020, 2, 10)),   # the longer of one start stays
        ("a", d(2020, 1, 5), d(2020, 2, 1)),                                        # inside the one before: dropped
        ("a", d(2020, 2, 5), d(2020, 3, 1)),                                        # clips its predecessor
    ], "k string, s date, e date")
    got = rows_of(clip_spans(spans, "k", "s", "e", "c").select("k", "s", "c"))
    assert got == [("a", d(2020, 1, 1), d(2020, 2, 4)), ("a", d(2020, 2, 5), d(2020, 3, 1))]
    facts = spark.createDataFrame([(1, "a", d(2020, 2, 4)), (2, "a", d(2020, 2, 5)), (3, "a", d(2020, 3, 2)), (4, "-1", d(2020, 1, 1)), (5, None, d(2020, 1, 1))],
                                  "id int, k string, day date")
    hits = interval_join(facts, clip_spans(spans, "k", "s", "e", "c"), "k", "k", "id", F.col("day"), "s", "c", "hit")
    assert rows_of(hits.select("id", "hit")) == [(1, True), (2, True), (3, False), (4, False), (5, False)]


def test_anti_joins_and_null_keys(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    right = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows_of(J.drop_matching(left, right, "id", "k")) == [("b",)]
    assert rows_of(J.without_match(left, right, "id", "k")) == [("b",), (None,)]
    assert rows_of(J.keep_matching(left, right, "id", "k")) == [("a",)]
    assert rows_of(J.exists_flag(left, right, "id", "k", "f")) == [("a", "Y"), ("b", "N"), (None, "N")]


@pytest.mark.parametrize(("address", "bad"), [
    (None, True), ("", True), ("a.b@c.org", False), ("no.at.sign", False), ("nodot@site", True), ("a b@c.org", True),
    (" a.b@c.org ", False), ("a.b@c.", True), ("a@b@c.org", True), ("   ", False), (".@", True), (".", True), ("..", True), ("@", True)])
def test_email_rule_as_it_takes_effect(spark, address, bad):
    df = spark.createDataFrame([(address,)], "e string")
    assert df.select(invalid_email("e")).first()[0] is bad


def test_blocked_domain_ignores_case(spark):
    df = spark.createDataFrame([("x@Kp.Org",), ("x@mail.org",), (None,)], "e string")
    assert [r[0] for r in df.select(blocked_domain("e")).collect()] == [True, False, None]


_CAUSE = ("source_dt timestamp, product_name string, tmp_suppression_criteria string, opt_out_flag string, et_active string, bounce_flag int, "
          "party_suppression_date timestamp, opt_out_date timestamp, merge_record_date timestamp, bounce_date timestamp")


def test_earliest_cause_ties_and_flags(spark):
    never, one, two, src = datetime(9999, 12, 31), datetime(2020, 1, 1), datetime(2020, 1, 2), datetime(2019, 5, 5)
    data = [
        (src, "P", V.MERGED, "Y", "N", 0, never, one, two, never),      # opt-out first
        (src, "P", V.MERGED, "Y", "N", 0, never, one, one, never),      # tie: source date, interim reason
        (src, "P", V.EMAILABLE, None, "Y", None, never, never, never, never),
        (src, None, V.HELD, None, "Y", 1, never, one, never, never),     # earliest but not flagged
        (src, "P", V.BAD_EMAIL, "N", "Y", 0, one, never, never, never),  # party reason first, no source of its own
    ]
    out = sup.clamp_dates(sup.earliest_cause(spark.createDataFrame(data, _CAUSE)), V.CLAMP_PROFESSIONAL).collect()
    got = [(r["suppression_date"], r["suppression_criteria"], r["suppression_source"], r["final_suppression_date"], r["final_source_dt"]) for r in out]
    assert got == [
        (one, "P Opt Out", "Opt table", one, src), (src, V.MERGED, "Party Table", src, src), (src, V.EMAILABLE, "No Suppression", src, src),
        (src, V.HELD, "Party Table", src, src), (one, V.BAD_EMAIL, "Party Table", src, src)]


def test_waterfall_gives_one_reason_and_nulls_fall_through(spark):
    schema = ("hcp_status string, record_state_cd string, ama_opt_out_flag string, hcp_type string, hcp_source string, nba_email_address string, "
              "party_email_address string, et_active string, bounce_flag int, opt_out_flag string, product_name string")
    data = [(None,) * 11, ("Active", "ACTIVE", "N", "Prescriber", "SFMC HCP", None, "a.b@c.d", None, 1, "Y", "P"),
            ("Retired", "DELETED", "Y", None, None, None, None, "N", 1, "Y", "P"), (None, None, None, None, None, "x@kp.org", "x@kp.org", None, None, "Y", None)]
    out = spark.createDataFrame(data, schema).select(sup.suppression_reason(sup.professional_rules())).collect()
    assert [r[0] for r in out] == [V.EMAILABLE, V.HELD, V.STATUS_INACTIVE, " Opt Out"]


def test_cause_date_keeps_date_when_flag_unknown(spark):
    df = spark.createDataFrame([(datetime(2020, 1, 1), None), (datetime(2020, 1, 1), "N"), (None, "Y")], "d timestamp, f string")
    got = [r[0].year for r in df.select(sup.cause_date("d", F.col("f") != "Y")).collect()]
    assert got == [2020, 9999, 9999]


def test_patient_segments(spark):
    data = [("caregiver", 12, None, None), ("CAREGIVER", None, "AGE_RANGE_13_17", 1), ("Patient", 40, "AGE_RANGE_0_12", None), ("Patient", None, None, 1),
            ("Patient", None, "x", None), ("Contact", None, None, 1), (None, 5, None, 1)]
    got = [r[0] for r in spark.createDataFrame(data, "r string, a int, s string, w int").select(patient_segment("r", "a", "s", "w")).collect()]
    assert got == ["Caregiver of Pediatric Patient", "Caregiver of Adolscent Patient", "Adult Patient", "Other Patients who are Web-Registered",
                   "Other Patients and not Web-Registered", "Others who are Web-Registered", "Others who are not Web-Registered"]


def test_bounce_summary_counts_items_once(spark):
    data = [(1, "i1", "Soft bounce", 3), (1, "i1", "Soft bounce", 1), (1, "i2", "Soft bounce", 2), (2, "a", "Soft bounce", 1), (2, "b", "Soft bounce", 1),
            (2, "c", "Soft bounce", 1), (3, None, "Hard bounce", 9), (4, "x", None, 1), (5, "h", "Hard bounce", 7)]
    df = spark.createDataFrame(data, "c int, i string, k string, d int")
    out = {r["c"]: tuple(r)[1:] for r in bounce_summary(df, "c", "i", F.col("k"), F.lit(True), "d").collect()}
    assert out == {1: (0, 2, 1, 0), 2: (0, 3, 1, 1), 3: (0, 0, 9, 0), 4: (0, 0, None, 0), 5: (1, 0, 7, 1)}


def test_count_distinct_when_ignores_null_items(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 1), ("a", "y", 0), ("a", None, 1)], "k string, i string, f int")
    assert count_distinct_when(df, ["k"], "i", {"n": F.col("f") == 1}).collect()[0]["n"] == 1


def test_rollup_counts_each_row_once_per_grain(spark):
    df = spark.createDataFrame([("a", date(2024, 1, 3), date(2024, 1, 1), 0, 1), ("a", date(2024, 1, 3), date(2024, 1, 1), 1, 1)],
                               "k string, d date, m date, fd int, fm int")
    out = rollup_grains(df, ["k"], [("D", "d", "fd"), ("M", "m", "fm")], {"n": F.count("*")}, "on", "level")
    assert rows_of(out) == [("a", date(2024, 1, 3), "D", 1)]


def test_delivered_is_never_negative(spark):
    df = spark.createDataFrame([(1, 3), (5, 2)], "total_sends bigint, total_bounces bigint")
    assert [r[0] for r in df.select(delivered()).collect()] == [0, 3]


def test_unpivot_drops_nulls(spark):
    df = spark.createDataFrame([(1, "x", None)], "id int, a string, b string")
    assert rows_of(unpivot_cols(df, ["id"], ["a", "b"], "n", "v")) == [(1, "a", "x")]


def test_contracts(spark):
    assert (len(COMBINED.fields), len(INTERACTION.fields), len(TARGET_LIST.fields)) == (51, 17, 44)
    one = spark.range(1).select(F.lit("r").alias("record_id"))
    assert [(f.name, f.dataType) for f in conform(one, COMBINED).schema] == [(f.name, f.dataType) for f in COMBINED]
    assert union_conformed(one, one, contract=COMBINED).count() == 2


@pytest.mark.parametrize(("day", "friday"), [(date(2024, 1, 1), date(2024, 1, 5)), (date(2024, 1, 5), date(2024, 1, 5)), (date(2024, 1, 7), date(2024, 1, 5))])
def test_friday_of_week(spark, day, friday):
    assert spark.createDataFrame([(day,)], "d date").select(S.friday_of_week("d")).first()[0] == friday


def test_text_helpers(spark):
    df = spark.createDataFrame([("a,b", "x", None), (",b", "y_z", "n"), ("plain", None, "m")], "t string, u string, w string")
    out = df.select(S.before_comma("t"), S.first_token("u"), S.glue("u", "w"), S.glue("u", "w", null_as_empty=True), S.tail("t", 4, whole_only=True)).collect()
    assert [tuple(r) for r in out] == [("a", "x", None, "x", None), (",b", "y", "y_zn", "y_zn", None), ("plain", None, None, "m", "lain")]


def test_slot_lookup_takes_first_match_even_if_null(spark):
    df = spark.createDataFrame([("Campaign", None, "CAMPAIGN", "v"), ("x", "1", "campaign", "v"), ("x", "1", "y", "2")], "n1 string, v1 string, n2 string, v2 string")
    got = [r[0] for r in df.select(S.slot_lookup("CAMPAIGN", [("n1", "v1"), ("n2", "v2")])).collect()]
    assert got == [None, "v", "UNKNOWN"]


def test_level_managers_deal_rows_of_one_file_over_all_tasks(spark):
    i = F.col("id")
    staff = spark.range(44).coalesce(1).select(
        F.concat_ws("", F.when(i < 40, "p").when(i < 43, "b").otherwise("q"), F.when(i < 40, i).when(i < 43, i - 40).cast("string")).alias("name"),
        F.lit("f").alias("force"), F.when(i < 43, "r").alias("number"), F.when((i >= 40) & (i < 43), "high").otherwise("low").alias("level"))
    made = J.level_managers(staff.filter("level = 'low'").select("name", "force", "number"), staff, "force", "level",
                            [("high", "number", {"boss": "name"})])
    rows = made.withColumn("task", F.spark_partition_id()).collect()
    assert sorted((r["name"], r["boss"] or "") for r in rows) == sorted([(f"p{i}", f"b{k}") for i in range(40) for k in range(3)] + [("q", "")])
    tasks = Counter(r["task"] for r in rows)
    assert len(tasks) > 1 and max(tasks.values()) < len(rows) / 2


def test_interval_join_meets_only_spans_of_the_month(spark):
    """A sentinel has a span on each of 3,000 days; spans without an end, turned round, or far outside the calendar stay right."""
    spans = spark.range(3000).select(F.lit("-1").alias("k"), F.date_add(F.lit(date(2015, 1, 1)), F.col("id").cast("int")).alias("s")).withColumn("e", F.col("s"))
    odd = spark.createDataFrame([("a", date(1, 1, 1), date(9999, 12, 31)), ("b", date(2020, 1, 1), None), ("c", date(2020, 2, 1), date(2020, 1, 1)),
                                 ("d", date(1950, 5, 1), date(1950, 5, 2)), ("a", date(2020, 1, 5), date(2020, 3, 1))], "k string, s date, e date")
    facts = spark.createDataFrame([(i, k, day) for i, (k, day) in enumerate(
        [("-1", date(2016, 2, 29)), ("-1", date(2014, 12, 31)), ("a", date(1900, 1, 1)), ("a", date(2020, 2, 1)), ("b", date(2020, 1, 2)),
         ("c", date(2020, 1, 15)), ("d", date(1950, 5, 2)), ("d", date(1950, 5, 3)), ("-1", None), (None, date(2016, 1, 1))])], "id int, k string, day date")
    hits = interval_join(facts, spans.union(odd), "k", "k", "id", F.col("day"), "s", "e", "hit")
    assert rows_of(hits.select("id", "hit")) == [
        (0, True), (1, False), (2, True), (3, True), (3, True), (4, False), (5, False), (6, True), (7, False), (8, False), (9, False)]
    assert hits.columns == ["id", "k", "day", "hit"]
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Join \[[^\]]*_month#\d+", plan)


def test_numbers_by_code_equal_windows(hot):
    data = hot.withColumn("code", F.col("id") % 4).withColumn("other", F.when(F.col("id") % 5 > 0, F.col("id") % 3))
    order = [F.col("day").desc_nulls_first(), F.col("hour").desc(), F.col("id").asc()]
    expected = data.select("id", *[F.row_number().over(Window.partitionBy("key", c).orderBy(*order)).alias(n) for n, c in (("x", "code"), ("y", "other"))])
    spark = data.sparkSession
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would make one range
    try:
        got = row_numbers_by_code(data, ["key"], {"x": "code", "y": "other"}, order).select("id", "x", "y")
        assert rows_of(got) == rows_of(expected)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert row_numbers_by_code(data.filter("false"), ["key"], {"x": "code"}, order).isEmpty()


def test_rows_are_dealt_for_their_result(spark, monkeypatch):
    """Six people of one number and 50 managers of it: 300 rows, 20 a task; before, the shuffle partitions whatever came out."""
    monkeypatch.setattr(J, "ROWS_PER_TASK", 20)
    staff = spark.range(56).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("name"), F.lit("f").alias("force"), F.lit("r").alias("number"),
                                   F.when(F.col("id") < 50, "high").otherwise("low").alias("level"))
    low = staff.filter("level = 'low'").select("name", "force", "number").union(spark.createDataFrame([("alone", "f", None)], "a string, b string, c string"))
    managers = [("high", "number", {"boss": "name"})]
    made = J.level_managers(low, staff, "force", "level", managers)
    assert made.rdd.getNumPartitions() == 16  # 301 rows
    twice = spark.createDataFrame([("f", 1), ("f", 2)], "of string, code int")
    assert J.level_managers(low, staff, "force", "level", managers, then=[(twice, {"force": "of"})]).rdd.getNumPartitions() == 31
    expected = [(f"p{i}", f"p{k}") for i in range(50, 56) for k in range(50)] + [("alone", "")]
    assert sorted((r["name"], r["boss"] or "") for r in made.collect()) == sorted(expected)
    monkeypatch.setattr(J, "CARRIED_ROWS", 10)  # managers of more rows are joined as Spark sees fit
    assert J.level_managers(low, staff, "force", "level", managers).count() == 301


def test_list_lookup_equals_left_lookup(spark, monkeypatch):
    monkeypatch.setattr(J, "LIST_ROWS", 3)
    facts = spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (2, "b", "x"), (3, None, "x"), (4, "a", None), (5, "c", "x")], "id int, k string, l string")
    dim = spark.createDataFrame([("a", "x", str(i % 7)) for i in range(20)] + [("a", "x", None), ("b", "x", None), ("b", "x", None), (None, "x", "0"), ("a", None, "9")],
                                "dk string, dl string, v string")
    on = {"k": "dk", "l": "dl"}
    got, expected = J.list_lookup(facts, dim, on, {"w": "v"}), J.left_lookup(facts, dim, on, {"w": "v"})
    assert got.columns == expected.columns == ["id", "k", "l", "w"]
    assert rows_of(got) == rows_of(expected)
