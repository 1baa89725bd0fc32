"""Joins over stored buckets: no row moves, and results are those of the plain join."""

import uuid
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from contactloom.sources.layouts import SALT, KeyedLayout

BUCKETS = 8


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.fixture(scope="module")
def facts(spark):
    """3,000 rows; a third under one key nobody named, some without key or day."""
    return spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "busy").when(F.col("id") % 13 == 0, None).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 60).cast("string"))).alias("account"),
        F.when(F.col("id") % 31 == 0, None).otherwise(F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 50).cast("int"))).alias("day"))


@pytest.fixture(scope="module")
def spans(spark):
    first = date(2024, 1, 1)
    rows = [(k, first + timedelta(s), first + timedelta(s + 6)) for k in ["busy", "k1", "k2", "k44", "nobody", None] for s in (3, 12, 40)]
    return spark.createDataFrame(rows, "account string, since date, until date")


@pytest.fixture(scope="module")
def layout(spark, facts, spans):
    made = KeyedLayout.create(f"layout_{uuid.uuid4().hex[:8]}", facts, "account", BUCKETS)
    made.store_facts(facts.filter("id < 2000"), "facts", "account", "id")
    made.store_facts(facts.filter("id >= 2000"), "facts", "account", "id", append=True)
    made.store_lookup(spans, "spans", "account")
    yield made
    made.drop()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(made.prefix)]


def plain(facts, spans):
    s = spans.withColumnRenamed("account", "a")
    cond = (F.col("account") == F.col("a")) & F.col("day").between(F.col("since"), F.col("until"))
    return facts.join(s, cond, "left").withColumn("planned", F.col("a").isNotNull()).select("id", "account", "day", "planned")


def test_interval_join_over_buckets(facts, spans, layout):
    got = layout.interval_join("facts", "account", "spans", "account", "day", "since", "until", "planned")
    assert got.columns == ["id", "account", "day", "planned"]
    assert rows_of(got) == rows_of(plain(facts, spans))


def test_no_row_moves(spark, layout):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = layout.interval_join("facts", "account", "spans", "account", "day", "since", "until", "planned")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert plan.count(f"SelectedBucketsCount: {BUCKETS} out of {BUCKETS}") == 2 or plan.count("Bucketed: true") == 2


def test_busy_key_is_dealt_out(layout):
    stored = layout.table("facts")
    own = {r[0]: r[1] for r in stored.filter("account = 'busy'").groupBy(SALT).count().collect()}
    assert sum(own.values()) == 1000 and len(own) > 1 and max(own.values()) < 2 * 3000 / BUCKETS
    assert stored.filter("account IS NULL").select(SALT).distinct().count() > 1
    assert stored.filter("account = 'k1'").select(SALT).distinct().count() == 1


def test_inner_join_and_empty_tables(spark, facts, spans, layout):
    inner = layout.join("facts", "account", "spans", "account", how="inner").select("id", "since")
    s = spans.withColumnRenamed("account", "a")
    assert rows_of(inner) == rows_of(facts.join(s, F.col("account") == F.col("a")).select("id", "since"))
    with pytest.raises(ValueError):
        layout.join("facts", "account", "spans", "account", how="full")
    none = KeyedLayout.create(f"layout_{uuid.uuid4().hex[:8]}", facts.filter("false"), "account", 2)
    none.store_facts(facts.filter("false"), "facts", "account", "id")
    none.store_lookup(spans.filter("false"), "spans", "account")
    assert none.interval_join("facts", "account", "spans", "account", "day", "since", "until", "planned").isEmpty()
    none.drop()
