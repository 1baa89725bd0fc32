"""Products under their names: contracts, swaps, layers in another session, intermediates, rejects."""

import uuid

import pytest
from conftest import SF
from pyspark.sql import functions as F

from checks.registry import AS_OF, open_tables
from contactloom.functions import scalar as S
from contactloom.operators.rejects import split_rejects
from contactloom.plans import published
from contactloom.sources import contracts as C
from contactloom.sources.products import checked, publish, versions
from contactloom.sources.tables import intermediates, settle


@pytest.fixture
def prefix(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    yield name
    for table in spark.catalog.listTables():
        if table.name.startswith(name):
            spark.sql(f"DROP {'VIEW' if table.tableType == 'VIEW' else 'TABLE'} IF EXISTS {table.name}")


def test_names_go_over_when_all_is_written(spark, prefix):
    first = publish(spark, lambda: {"a": spark.range(3), "b": spark.range(4)}, prefix)
    assert (first["a"].count(), first["b"].count()) == (3, 4)
    publish(spark, lambda: {"a": spark.range(5), "b": spark.range(6)}, prefix)
    assert (spark.table(f"{prefix}_a").count(), spark.table(f"{prefix}_b").count()) == (5, 6)
    assert len(versions(spark, f"{prefix}_a")) == len(versions(spark, f"{prefix}_b")) == 1


def test_a_failed_run_leaves_the_old_products(spark, prefix):
    publish(spark, lambda: {"a": spark.range(3), "b": spark.range(4)}, prefix)
    broken = spark.range(9).select(F.raise_error(F.lit("no such day")).alias("id"))
    with pytest.raises(Exception, match="no such day"):
        publish(spark, lambda: {"a": spark.range(7), "b": broken}, prefix)
    assert (spark.table(f"{prefix}_a").count(), spark.table(f"{prefix}_b").count()) == (3, 4)
    assert len(versions(spark, f"{prefix}_a")) == len(versions(spark, f"{prefix}_b")) == 1


def test_contract_gives_order_and_type_and_refuses_other_columns(spark):
    want = C.METRIC
    row = spark.range(1).select(F.lit(1).alias("METRIC_VALUE"), *[F.lit("2021-01-01").alias(f.name) for f in want if f.name != "metric_value"])
    got = checked(row, want, "metrics")
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want]
    with pytest.raises(ValueError, match="missing .*rep_id"):
        checked(row, C.REP_METRIC, "metrics")
    with pytest.raises(ValueError, match=r"unknown \['more'\]"):
        checked(row.withColumn("more", F.lit(1)), want, "metrics")


def test_intermediates_are_removed(spark):
    with intermediates(spark):
        kept = settle(spark.range(3), "part")
        folder = kept.inputFiles()[0].rsplit("/", 1)[0]
        assert kept.count() == 3
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_mail_layers_by_name_in_another_session(spark, prefix):
    published.publish_mail(spark, open_tables(spark, SF), AS_OF, prefix)
    other = spark.newSession()
    funnel, base = other.table(f"{prefix}_email_engagement"), other.table(f"{prefix}_email_base")
    assert funnel.columns == [f.name for f in C.EMAIL_FUNNEL] and base.columns == [f.name for f in C.EMAIL_BASE]
    assert funnel.agg(F.sum("total_sends")).first()[0] > 0
    plan = other.sql(f"SELECT count(mdm_id) FROM {prefix}_activity WHERE activity_month >= DATE '2019-01-01'")
    assert "activity_month" in plan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_field_products_keep_reference_order(spark, prefix):
    made = published.publish_field(spark, open_tables(spark, SF), AS_OF, prefix)
    for name, df in made.items():
        assert df.columns == [f.name for f in published.CONTRACTS[name]], name
        assert not df.isEmpty(), name


def test_accepted_and_rejected_make_up_the_input(spark):
    rows = spark.createDataFrame([(1, "7", "20210105"), (2, "x7", "20210105"), (3, None, ""), (4, "y", "2021"), (5, "8", "20211399"), (5, "8", "20211399")],
                                 "id int, key string, day string")
    rules = {"key": S.whole_number("key"), "day": S.day_from_digits("day")}
    accepted, rejected = split_rejects(rows, rules)
    assert sorted(r.id for r in accepted.collect()) == [1, 3] and accepted.columns == rows.columns
    assert sorted((r.id, r.reject_reasons) for r in rejected.collect()) == [
        (2, ["key: x7"]), (4, ["key: y", "day: 2021"]), (5, ["day: 20211399"]), (5, ["day: 20211399"])]
    none_accepted, none_rejected = split_rejects(rows.filter("false"), rules)
    assert none_accepted.isEmpty() and none_rejected.isEmpty()


def test_parsed_sources_take_dirty_rows_out(spark):
    t = open_tables(spark, SF)
    guests = t["attendee"]
    t = t.with_results(attendee=guests.withColumn("created_date", F.when(F.col("mdm_id") == "NA", "soon").otherwise(F.col("created_date"))))
    clean, rejected = published.parsed_sources(t)
    assert rejected["attendee"].count() == guests.filter("mdm_id = 'NA'").count() > 0
    assert clean["attendee"].count() + rejected["attendee"].count() == guests.count()
