"""Products as named tables: written under a contract, shown together, layered by name."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from contactloom.operators.reshape import conform
from contactloom.sources.tables import Tables, intermediates, materialize_table

_VERSION = "__v_"


def checked(df: DataFrame, contract: T.StructType, name: str) -> DataFrame:
    """The columns of ``df`` in contract order and type.  A column that is missing, or that the contract does not
    know, is an error: a product must not lose or gain columns unseen."""
    have, want = {c.lower() for c in df.columns}, {f.name.lower() for f in contract.fields}
    if have != want:
        raise ValueError(f"{name}: missing {sorted(want - have)}, unknown {sorted(have - want)}")
    return conform(df, contract)


def versions(spark: SparkSession, name: str) -> list[str]:
    """Tables that were written for a product."""
    return [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name.lower()}{_VERSION}")]


def publish(spark: SparkSession, make: Callable[[], Mapping[str, DataFrame]], prefix: str,
            contracts: Mapping[str, T.StructType] | None = None, partitions: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """Write all products of a workflow, then show them under ``<prefix>_<name>``.

    ``make`` builds the products; what it settles on the way is removed at the end.  Each product is written in
    full to a table of its own version.  Only when all are written do the names, which are catalog views, go over
    to the new versions, and the versions before are dropped.  If anything fails until then, the names keep showing
    the products of the last good run and the new versions are dropped.  Each name changes in one step; readers that
    ask for several names in that moment may see some of the old run."""
    run, written = uuid.uuid4().hex[:12], {}
    try:
        with intermediates(spark):
            for name, df in make().items():
                table = f"{prefix}_{name}{_VERSION}{run}"
                written[name] = table
                if contracts and name in contracts:
                    df = checked(df, contracts[name], name)
                materialize_table(df, table, (partitions or {}).get(name))
    except BaseException:
        for table in written.values():
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        raise
    for name, table in written.items():
        spark.sql(f"CREATE OR REPLACE VIEW {prefix}_{name} AS SELECT * FROM {table}")
    for name, table in written.items():
        for old in versions(spark, f"{prefix}_{name}"):
            if old != table.lower():
                spark.sql(f"DROP TABLE IF EXISTS {old}")
    return {name: spark.table(f"{prefix}_{name}") for name in written}


def publish_layers(t: Tables, layers: Mapping[str, Callable[[Tables], DataFrame]], prefix: str, spark: SparkSession,
                   contracts: Mapping[str, T.StructType] | None = None,
                   partitions: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """Publish products that stand on one another, in the order given: each builder sees the stored products of the
    layers before it under their short names, next to the sources."""
    out: dict[str, DataFrame] = {}
    for name, build in layers.items():
        out |= publish(spark, lambda build=build, name=name: {name: build(t.with_results(**out))}, prefix, contracts, partitions)
    return out
