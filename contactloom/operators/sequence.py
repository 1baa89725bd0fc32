"""Numbering rows within keys without giving any key to a single task.

row_number() over a key sorts the whole key in one task.  ``row_numbers`` cuts any key into ranges of its order and
carries counts over the borders; ``repeat_flags`` needs no numbers at all."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactloom.sources.tables import settle


def in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[Column], label: str) -> DataFrame:
    """The rows dealt into ranges of (keys, order) of about one size, written with the number of their range."""
    ranges = df.repartitionByRange(*[F.col(k).asc() for k in keys], *order)
    return settle(ranges.withColumn("_range", F.spark_partition_id()), label)


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str, label: str = "numbers") -> DataFrame:
    """``row_number() over (partition by keys order by order)`` in which no task holds more than its share of the rows.

    The rows are dealt into ranges of (keys, order), so that a key with many rows is cut wherever its share of a range ends,
    and written with the number of their range, which must not change between counting and numbering even when executors are
    lost.  They are numbered inside (range, key).  Only a key that began in an earlier range carries a count over from there:
    one row per range at most, which is all that is broadcast.  ``order`` should tell rows of a key apart: ties stay in one
    range, and which of them comes first is open.  Rows travel twice, so bring narrow ones and join the rest back."""
    placed = in_ranges(df, keys, order, label)
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (placed.groupBy("_range", *keys).agg(F.count("*").alias("_n")).withColumn("_before", F.sum("_n").over(earlier))
               .filter("_before > 0").select(F.struct("_range", *keys).alias("_carried"), "_before"))
    inside = Window.partitionBy("_range", *keys).orderBy(*order)
    return (placed.withColumn("_inside", F.row_number().over(inside)).withColumn("_group", F.struct("_range", *keys))
            .join(F.broadcast(carried), F.col("_group") == F.col("_carried"), "left")
            .withColumn(out, (F.col("_inside") + F.coalesce("_before", F.lit(0))).cast("bigint"))
            .drop("_range", "_inside", "_group", "_carried", "_before"))


def row_numbers_by_code(df: DataFrame, keys: Sequence[str], codes: Mapping[str, str], order: Sequence[Column],
                        label: str = "numbers") -> DataFrame:
    """Several ``row_number() over (partition by keys, code order by order)``, one per entry (number, code) of ``codes``.

    The rows are dealt into ranges of (keys, order) once for all numbers.  Inside keys the ranges follow the order, so for
    every code the rows of earlier ranges come first.  Counts are carried only for keys that more than one range holds;
    those are ends of their ranges, so their number is bounded by that of the ranges."""
    placed = in_ranges(df, keys, order, label)
    ends = placed.select("_range", F.struct(*keys).alias("_key")).groupBy("_range").agg(
        F.explode(F.array_distinct(F.array(F.min("_key"), F.max("_key")))).alias("_key"))
    cut = F.broadcast(ends.groupBy("_key").agg(F.count("*").alias("_ranges")).filter("_ranges > 1").select("_key"))
    numbered = placed.repartitionByRange("_range")
    for out, code in codes.items():
        earlier = Window.partitionBy(*keys, code).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        carried = (placed.join(cut, F.struct(*keys).eqNullSafe(F.col("_key")), "left_semi").groupBy("_range", *keys, code).agg(F.count("*").alias("_n"))
                   .withColumn("_before", F.sum("_n").over(earlier)).filter("_before > 0")
                   .select(F.struct("_range", *keys, code).alias("_carried"), "_before"))
        inside = Window.partitionBy("_range", *keys, code).orderBy(*order)
        numbered = (numbered.withColumn("_inside", F.row_number().over(inside)).withColumn("_group", F.struct("_range", *keys, code))
                    .join(F.broadcast(carried), F.col("_group") == F.col("_carried"), "left")
                    .withColumn(out, (F.col("_inside") + F.coalesce("_before", F.lit(0))).cast("bigint"))
                    .drop("_inside", "_group", "_carried", "_before"))
    return numbered.drop("_range")


def repeat_flags(df: DataFrame, keys: Sequence[str], grains: Mapping[str, Sequence[str]],
                 order: Sequence[Column]) -> DataFrame:
    """One boolean column per grain, true for every row but the first of its group.

    ``grains`` maps a flag name to the columns that refine ``keys`` (none for the overall flag).  ``order``
    is ascending with NULLs first, and tells every row from all others.  The first row of a group is a minimum,
    which is combined before the shuffle, so no group meets in a task however many rows it has.  The
    minima of the finest groups are taken once and rolled up to the grains; the firsts then meet the rows on the
    whole order, which is unique."""
    rows = df.withColumn("_order", F.struct(*[c.alias(f"_{k}") for k, c in enumerate(order)]))
    refined = dict.fromkeys(c for extra in grains.values() for c in extra)
    finest = rows.groupBy(*keys, *refined).agg(F.min("_order").alias("_order"))
    firsts = [finest.groupBy(*keys, *extra).agg(F.min("_order").alias("_order")).select("_order", F.lit(flag).alias("_flag"))
              for flag, extra in grains.items()]
    marks = (reduce(DataFrame.unionAll, firsts).groupBy("_order")
             .agg(*[F.max(F.col("_flag") == flag).alias(f"_first_{flag}") for flag in grains]))
    flags = {flag: ~F.coalesce(F.col(f"_first_{flag}"), F.lit(False)) for flag in grains}
    return rows.join(marks, "_order", "left").withColumns(flags).drop("_order", *[f"_first_{flag}" for flag in grains])
