"""Rows whose keys or dates do not parse, kept apart with the reason."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom.sources.tables import settle


def split_rejects(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): ``rules`` gives the parsed form of each text column.

    A value is at fault if it is neither NULL nor blank and its parsed form is NULL.  Accepted rows keep their
    columns; rejected ones get ``reject_reasons``, one ``column: value`` for each fault in the order of the rules.  Every
    input row is in exactly one of the two.  The input is evaluated once and written in two partitions, so reading one
    side does not read the other."""
    faults = [F.when((F.trim(F.col(c)) != "") & parsed.isNull(), F.concat(F.lit(f"{c}: "), F.col(c))) for c, parsed in rules.items()]
    marked = df.withColumn("reject_reasons", F.array_compact(F.array(*faults)))
    marked = settle(marked.withColumn("_rejected", F.size("reject_reasons") > 0), "parsed", "_rejected")
    accepted = marked.filter(~F.col("_rejected")).drop("_rejected", "reject_reasons")
    return accepted, marked.filter("_rejected").drop("_rejected")


def reject_counts(rejected: DataFrame, source: str) -> DataFrame:
    """How many rows each column made fail: source, column_name, rows.  A row with two faults counts for both."""
    faults = rejected.select(F.explode("reject_reasons").alias("_fault"))
    return (faults.groupBy(F.substring_index("_fault", ": ", 1).alias("column_name")).agg(F.count("*").alias("rows"))
            .select(F.lit(source).alias("source"), "column_name", "rows"))
