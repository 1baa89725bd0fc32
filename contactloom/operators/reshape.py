"""Contracts, unions, pivots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Contract columns in contract order and type; columns the input lacks become typed NULLs."""
    have = {c.lower() for c in df.columns}
    return df.select(*[(F.col(f.name) if f.name.lower() in have else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in contract.fields])


def union_conformed(*branches: DataFrame, contract: T.StructType) -> DataFrame:
    """UNION ALL of branches brought to one contract."""
    return reduce(DataFrame.unionByName, [conform(b, contract) for b in branches])


def union_distinct(*branches: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, branches).distinct()


def unpivot_cols(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str,
                 value: str) -> DataFrame:
    """Columns to name/value rows; NULL values leave no row."""
    return df.unpivot(list(ids), list(cols), name, value).filter(F.col(value).isNotNull())


def pivot_sum(df: DataFrame, keys: Sequence[str], on: str, values: Sequence[str],
              measure: str, names: Sequence[str]) -> DataFrame:
    """Sum per listed value, one column each.  Listing them saves the job that would find them."""
    wide = df.groupBy(*keys).pivot(on, list(values)).agg(F.sum(measure))
    for value, new in zip(values, names, strict=True):
        wide = wide.withColumnRenamed(value, new)
    return wide
