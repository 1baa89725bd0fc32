"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest(name: str, nulls_last: bool = False) -> Column:
    """Descending as the source dialects sort: NULL counts as the largest value."""
    c = F.col(name)
    return c.desc_nulls_last() if nulls_last else c.desc_nulls_first()


def oldest(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key.  End ``order`` with a unique column so ties are settled.

    The filter on row_number lets Spark cut every map partition down to one row per key before
    the shuffle (WindowGroupLimit), so a key that owns much of the table costs no more than
    any other."""
    spec = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(spec)).filter("_rn = 1").drop("_rn")


def group_distinct(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """GROUP BY without aggregates."""
    return df.select(*keys).distinct()


def first_touch(df: DataFrame, keys: Sequence[str], when: str, tiebreak: str) -> DataFrame:
    return first_per_key(df, keys, [oldest(when), oldest(tiebreak)])


def latest_contact(df: DataFrame, party: str, when: str, tiebreak: str) -> DataFrame:
    """Current contact point per party: newest to the second, then the highest integration key."""
    spec = [F.date_trunc("second", F.col(when)).desc_nulls_first(), newest(tiebreak)]
    return first_per_key(df, [party], spec)


def first_merge(df: DataFrame, loser: str, merged_at: str) -> DataFrame:
    """Earliest merge per losing id; only the date is kept, so a minimum will do."""
    return df.groupBy(loser).agg(F.min(merged_at).alias(merged_at))


def latest_opt_state(df: DataFrame, keys: Sequence[str], when: str, flag: str) -> DataFrame:
    """Newest opt-in row per subscription, with the opt-out flag decoded."""
    newest_row = first_per_key(df, keys, [newest(when), newest(flag)])
    return newest_row.withColumn("opt_out_flag", F.when(F.col(flag) == "N", "Y").otherwise("N"))
