"""Conditional aggregates and the measures built from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom.functions.scalar import as_date, month_start
from contactloom.operators.reshape import pivot_sum


def sum_by(df: DataFrame, keys: Sequence[str], measure: str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(measure).alias(out))


def sum_when(cond: Column, measure: Column | str) -> Column:
    return F.sum(F.when(cond, F.col(measure) if isinstance(measure, str) else measure))


def count_when(cond: Column, what: Column | str | None = None) -> Column:
    what = F.lit(1) if what is None else F.col(what) if isinstance(what, str) else what
    return F.count(F.when(cond, what))


def count_distinct(df: DataFrame, keys: Sequence[str], col: str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_distinct(col).alias(out))


def min_when(cond: Column, col: str) -> Column:
    return F.min(F.when(cond, F.col(col)))


def count_distinct_when(df: DataFrame, keys: Sequence[str], item: str,
                        conditions: Mapping[str, Column]) -> DataFrame:
    """Several conditional distinct counts of one item column.

    Reduced to one row per (key, item) first; the flags are then summed.  That shuffles partial
    results once per step, where several COUNT(DISTINCT CASE ...) would copy every input row
    once per count."""
    per_item = df.groupBy(*keys, item).agg(
        *[F.max(F.when(c, 1).otherwise(0)).alias(n) for n, c in conditions.items()])
    known = F.col(item).isNotNull()
    return per_item.groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.when(known, F.col(n))), F.lit(0)).alias(n) for n in conditions])


def flag_lattice(df: DataFrame, keys: Sequence[str], category: Column, weights: Mapping[str, int],
                 default: int, out: str) -> DataFrame:
    """Highest weight among the categories seen per key."""
    weight = None
    for label, w in weights.items():
        weight = F.when(category == label, w) if weight is None else weight.when(category == label, w)
    return df.groupBy(*keys).agg(F.max(weight.otherwise(default)).alias(out))


def rollup_grains(df: DataFrame, keys: Sequence[str], grains: Sequence[tuple[str, str, str]],
                  measures: Mapping[str, Column], date_out: str, level_out: str) -> DataFrame:
    """The same measures at several date grains, stacked.

    A grain is (label, date column, repeat-flag column) and counts only rows whose flag is 0.
    Every row is turned into one row per grain it counts for and all grains are aggregated
    together: the input, windows included, is computed once, not once per grain."""
    entries = F.array(*[F.when(F.col(flag) == 0, F.struct(F.lit(label).alias("level"),
                                                         F.col(day).alias("day")))
                        for label, day, flag in grains])
    # rows that count for no grain leave before the fan-out
    spread = (df.withColumn("_grain", F.explode(F.filter(entries, lambda e: e.isNotNull())))
              .withColumn(date_out, F.col("_grain.day")).withColumn(level_out, F.col("_grain.level"))
              .drop("_grain"))
    return spread.groupBy(*keys, date_out, level_out).agg(
        *[m.alias(n) for n, m in measures.items()])


def last_date(df: DataFrame, keys: Sequence[str], day: Column, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(day).alias(out))


def email_funnel(kind: Column | str, customer: str) -> dict[str, Column]:
    """Sends, opens, clicks and bounces as conditional counts."""
    kind = F.upper(F.col(kind) if isinstance(kind, str) else kind)
    return {"total_sends": count_when(kind == "EMAIL SENT", customer),
            "total_opens": count_when(kind == "EMAIL OPENED", customer),
            "total_clicks": count_when(kind == "CLICKED LINK ON EMAIL", customer),
            "total_bounces": count_when(kind == "EMAIL BOUNCED", customer)}


def delivered(sends: str = "total_sends", bounces: str = "total_bounces") -> Column:
    return F.greatest(F.col(sends) - F.col(bounces), F.lit(0).cast("long"))


def bounce_summary(facts: DataFrame, customer: str, item: str, category: Column,
                   is_dated: Column, day: str) -> DataFrame:
    """Per customer: distinct hard and soft bounces, first bounce date, held flag."""
    hard, soft = category == "Hard bounce", category == "Soft bounce"
    marked = facts.select(customer, item, F.when(hard, 1).otherwise(0).alias("_hard"),
                          F.when(soft, 1).otherwise(0).alias("_soft"),
                          F.when(is_dated & (hard | soft), F.col(day)).alias("_day"))
    per_item = marked.groupBy(customer, item).agg(
        F.max("_hard").alias("_hard"), F.max("_soft").alias("_soft"), F.min("_day").alias("_day"))
    counted = F.col(item).isNotNull()
    totals = per_item.groupBy(customer).agg(
        F.coalesce(F.sum(F.when(counted, F.col("_hard"))), F.lit(0)).alias("hard_bounce_count"),
        F.coalesce(F.sum(F.when(counted, F.col("_soft"))), F.lit(0)).alias("soft_bounce_count"),
        F.min("_day").alias("bounce_date"))
    held = (F.col("hard_bounce_count") > 0) | (F.col("soft_bounce_count") > 2)
    return totals.withColumn("bounce_flag", F.when(held, 1).otherwise(0))


MAIL_KINDS = ["EMAIL OPENED", "EMAIL BOUNCED", "EMAIL SENT", "CLICKED LINK ON EMAIL"]


def net_bounce(latest: DataFrame, keys: Sequence[str], kind: str, day_number: str) -> DataFrame:
    """1 when the last bounce is no older than the last send and nothing was opened or clicked."""
    wide = pivot_sum(latest, keys, kind, MAIL_KINDS, day_number,
                     ["email_opened", "email_bounced", "email_sent", "clicked_link_on_email"])
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in wide.columns if c not in keys}
    untouched = F.col("clicked_link_on_email").isNull() & F.col("email_opened").isNull()
    flag = F.when((zero["email_bounced"] >= zero["email_sent"]) & untouched, 1).otherwise(0)
    return wide.withColumn("bounce_flag", flag).withColumns(zero)


def trailing_units(facts: DataFrame, key: str, month: str, value: str, as_of: date,
                   slices: Mapping[str, Column]) -> DataFrame:
    """Sums over the last 12 and 6 full months, one pair of columns per slice."""
    this_month = month_start(as_date(as_of))
    windows = {12: F.col(month) >= F.add_months(this_month, -12),
               6: F.col(month) >= F.add_months(this_month, -6)}
    past = facts.filter(F.col(month) != this_month)
    return past.groupBy(key).agg(*[
        sum_when(inside & cond, value).alias(f"{name}_units_{n}_months")
        for n, inside in windows.items() for name, cond in slices.items()])


def metric_rows(df: DataFrame, metric_id: str, metric_name: str, customer: str, product: str,
                bucket: str, value: Column) -> DataFrame:
    """Bring one measure to the long metric layout."""
    return df.select(F.col(customer).cast("string").alias("customer_id"),
                     F.col(product).alias("product_name"),
                     F.col(bucket).alias("time_bucket_date"), F.lit(metric_id).alias("metric_id"),
                     F.lit(metric_name).alias("metric_name"), value.alias("metric_value"))
