"""A global rank that no single task has to compute."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactloom.sources.tables import settle


def global_rank(df: DataFrame, columns: Sequence[str], order: Sequence[Column], out: str,
                partitions: int | None = None) -> DataFrame:
    """``rank() over (order by ...)`` without pulling the table into one partition.

    ``columns`` are those that ``order`` looks at.  Only their distinct tuples are ranked, each with its
    number of rows, so rows that tie never meet in a task and wide rows are not moved.  The tuples are
    range-partitioned on the order and written with their partition number, which must not change
    between counting and ranking, even when executors are lost.  The sizes of the partitions have one
    row each, the only thing broadcast.  Ranks are then joined back on the tuple."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tuples = df.groupBy(*columns).agg(F.count("*").alias("_n"))
    placed = settle(tuples.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "rank")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_part").agg(F.sum("_n").alias("_n"))
               .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
               .select(F.col("_part").alias("_p"), "_before"))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (placed.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
             .join(F.broadcast(offsets), F.col("_part") == F.col("_p"))
             .select(F.struct(*columns).alias("_tuple"), (1 + F.col("_inside") + F.col("_before")).alias(out)))
    return df.withColumn("_tuple", F.struct(*columns)).join(ranks, "_tuple").drop("_tuple")
