"""Validity intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactloom import fixed_values as V
from contactloom.operators.joins import spread_join


def clip_spans(df: DataFrame, key: str, start: str, end: str, clipped: str) -> DataFrame:
    """Make the spans of a key disjoint.

    Of the spans starting on one day the longest stays; a span that ends no later than the one
    before it goes; every other span ends the day before its successor starts at the latest.
    The look back is one row, as the source has it.  At most one span per key and day is left
    before the windows run, so their groups are bounded by the calendar."""
    days = df.select(key, F.to_date(start).alias(start), F.to_date(end).alias(end))
    # NULL ends sort first, as the largest, in the source dialect
    longest = days.groupBy(key, start).agg(
        F.when(F.count("*") == F.count(end), F.max(end)).alias(end))
    order = Window.partitionBy(key).orderBy(F.col(start).asc_nulls_last())
    kept = (longest.withColumn("_last_end", F.lag(end).over(order))
            .filter(F.col("_last_end").isNull() | (F.col(end) > F.col("_last_end"))))
    following = F.lead(start).over(order)
    return (kept.withColumn("_next", following)
            .withColumn(clipped, F.when(F.col("_next") <= F.col(end), F.date_sub("_next", 1))
                        .otherwise(F.col(end)))
            .select(key, start, end, clipped))


#: Months that spans are cut by; days before and after fall to the first and the last of them.
FIRST_MONTH, LAST_MONTH = 1990 * 12, 2059 * 12 + 11


def calendar_month(day: Column) -> Column:
    """Number of a day's month, held between FIRST_MONTH and LAST_MONTH."""
    month = F.year(day) * 12 + F.month(day) - 1
    return F.when(day.isNotNull(), F.least(F.greatest(month, F.lit(FIRST_MONTH)), F.lit(LAST_MONTH)))


def interval_join(facts: DataFrame, spans: DataFrame, fact_key: str, span_key: str, row_id: str,
                  day: Column, start: str, end: str, hit: str,
                  sentinels: Sequence[str] = (V.UNKNOWN_ID,)) -> DataFrame:
    """Left join on the key with ``start <= day <= end``; ``hit`` tells whether a span matched.

    Key and calendar month drive the join and the date test rides along: a span stands once in every month it touches and
    a fact in the month of its day, so a fact meets the spans of its month, not all that its key, perhaps a sentinel, has
    over the years, and any span once.  Clipped spans are disjoint, so a fact keeps its multiplicity."""
    right = spans.filter(F.col(start) <= F.col(end)).select(
        F.col(span_key).alias("_span_key"), F.col(start).alias("_from"), F.col(end).alias("_to"), F.lit(True).alias(hit),
        F.explode(F.sequence(calendar_month(F.col(start)), calendar_month(F.col(end)))).alias("_span_month"))
    return (spread_join(facts.withColumn("_day", day).withColumn("_month", calendar_month(F.col("_day"))), right, fact_key, "_span_key", row_id,
                        lambda: (F.col("_month") == F.col("_span_month")) & F.col("_day").between(F.col("_from"), F.col("_to")), sentinels)
            .withColumn(hit, F.coalesce(hit, F.lit(False)))
            .drop("_span_key", "_from", "_to", "_day", "_month", "_span_month"))
