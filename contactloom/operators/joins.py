"""Lookups, semi and anti joins, hierarchies."""

from __future__ import annotations

import math
import operator
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom import fixed_values as V
from contactloom.sources.tables import settle

SALTS = 64
# counters of the frequent-keys summary for each key that may be told hot: bounds its error
COUNTERS_PER_KEY = 16
#: Result rows of a task where a lookup multiplies the rows; a writer's memory grows with the rows of its file.
ROWS_PER_TASK, MOST_TASKS = 1 << 24, 100_000
#: Rows of a dimension that are brought to every task where a join on its few keys would gather the facts.
CARRIED_ROWS = 1 << 20
#: Rows of a dimension that are gathered in one list.
LIST_ROWS = 1 << 12


def renamed_apart(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Select columns under new names: ``{new: old}``."""
    return df.select(*[F.col(old).alias(new) for new, old in columns.items()])


def left_lookup(facts: DataFrame, dim: DataFrame, on: Mapping[str, str],
                take: Mapping[str, str], how: str = "left") -> DataFrame:
    """Join ``dim`` on ``{fact column: dim column}`` and take ``{new name: dim column}``.

    No broadcast hint: Spark broadcasts when the dimension's measured size allows it and sorts
    otherwise."""
    right = dim.select(*[F.col(c).alias(f"_on{i}") for i, c in enumerate(on.values())],
                       *[F.col(old).alias(new) for new, old in take.items()])
    cond = [F.col(c) == F.col(f"_on{i}") for i, c in enumerate(on)]
    return facts.join(right, cond, how).drop(*[f"_on{i}" for i in range(len(on))])


def spread_join(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, row_id: str,
                residual: Callable[[], Column] | None = None,
                sentinels: Sequence[str] = (V.UNKNOWN_ID,), salts: int = SALTS) -> DataFrame:
    """Left join that spreads the facts whose key is a sentinel or NULL over ``salts`` tasks.

    Such keys may own a third of all rows.  Dimension rows of a sentinel key are repeated once
    per salt, all other rows get salt 0, so the result is that of the plain left join.  The salt
    comes from ``row_id``, not from a random number, so a task that is run again agrees with
    its first run.  Hot keys that are not known beforehand are found by ``split_join``."""
    hot = F.col(fact_key).isin(list(sentinels)) | F.col(fact_key).isNull()
    salt = F.pmod(F.xxhash64(row_id), F.lit(salts)).cast("int")
    left = facts.withColumn("_salt", F.when(hot, salt).otherwise(0))
    all_salts = F.sequence(F.lit(0), F.lit(salts - 1))
    right = dim.filter(F.col(dim_key).isNotNull()).withColumn("_salt_r", F.explode(
        F.when(F.col(dim_key).isin(list(sentinels)), all_salts).otherwise(F.array(F.lit(0)))))
    cond = (F.col(fact_key) == F.col(dim_key)) & (F.col("_salt") == F.col("_salt_r"))
    if residual is not None:
        cond = cond & residual()
    return left.join(right, cond, "left").drop("_salt", "_salt_r")


def spread_lookup(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, row_id: str,
                  take: Mapping[str, str]) -> DataFrame:
    right = dim.select(F.col(dim_key).alias("_key"),
                       *[F.col(old).alias(new) for new, old in take.items()])
    return spread_join(facts, right, fact_key, "_key", row_id).drop("_key")


def hot_keys(facts: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """(``_hot``, ``_salts``): the keys that own more rows than a task's fair share, and how many fair shares.

    A frequent-keys summary of bounded size is made in every partition and merged, so no key is shuffled or
    grouped.  At most ``partitions`` keys can own a fair share.  The summary's error is below a sixteenth of a
    share; a key missed or told wrongly by it costs balance, never rows.  Written down, because both sides of a
    join have to see the same salts, also when a task runs again.  Reads ``key`` of ``facts`` alone."""
    n = partitions or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = facts.select(F.col(key).alias("k")).filter(F.col("k").isNotNull())
    found = keys.agg(F.expr(f"approx_top_k(k, {n}, {max(1024, n * COUNTERS_PER_KEY)})").alias("top"), F.count("*").alias("_all"))
    shares = found.select("_all", F.inline("top").alias("_hot", "_count")).withColumn("_shares", F.col("_count") * n / F.col("_all"))
    return settle(shares.filter(F.col("_shares") > 1).select("_hot", F.ceil("_shares").cast("int").alias("_salts")), "hot-keys")


def split_join(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, row_id: str, how: str = "left",
               residual: Callable[[], Column] | None = None, hot: DataFrame | None = None,
               partitions: int | None = None) -> DataFrame:
    """Left or inner join that splits hot keys nobody named beforehand.

    Facts of a hot key are dealt over as many salts as the key owns fair shares; only the dimension rows of hot
    keys are repeated, once per salt, and the salts of all keys together are at most twice the number of tasks.
    Facts without a key are dealt over all tasks.  The salt comes from ``row_id``.  ``hot`` is a result of
    ``hot_keys``, from a cheaper source of the same keys if there is one; the broadcast has at most one row a task."""
    if how not in ("left", "inner"):
        raise ValueError(f"left or inner, not {how}")
    n = partitions or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(facts, fact_key, n) if hot is None else hot)
    dealt = F.xxhash64(row_id)
    left = facts.join(hot, F.col(fact_key) == F.col("_hot"), "left").withColumn("_salt", F.when(
        F.col(fact_key).isNull(), F.pmod(dealt, F.lit(n))).otherwise(F.coalesce(F.pmod(dealt, F.col("_salts")), F.lit(0))).cast("int")
    ).drop("_hot", "_salts")
    right = dim.filter(F.col(dim_key).isNotNull()).join(hot, F.col(dim_key) == F.col("_hot"), "left").withColumn(
        "_salt_r", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))).drop("_hot", "_salts")
    cond = (F.col(fact_key) == F.col(dim_key)) & (F.col("_salt") == F.col("_salt_r"))
    if residual is not None:
        cond = cond & residual()
    return left.join(right, cond, how).drop("_salt", "_salt_r")


def split_lookup(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, row_id: str, take: Mapping[str, str],
                 how: str = "left", hot: DataFrame | None = None) -> DataFrame:
    right = dim.select(F.col(dim_key).alias("_key"), *[F.col(old).alias(new) for new, old in take.items()])
    return split_join(facts, right, fact_key, "_key", row_id, how, hot=hot).drop("_key")


def _keys(keys: DataFrame, key: str, unique: bool) -> DataFrame:
    """Key column of a subquery.  Repeats are combined before the shuffle, which the join then
    shares, so a key that fills much of the subquery does not end up in one task."""
    right = keys.select(F.col(key).alias("_k")).filter(F.col("_k").isNotNull())
    return right if unique else right.distinct()


def keep_matching(df: DataFrame, keys: DataFrame, on: str, key: str | None = None,
                  unique: bool = False) -> DataFrame:
    """IN (subquery).  ``unique`` says that the keys do not repeat, as in a dictionary."""
    return df.join(_keys(keys, key or on, unique), F.col(on) == F.col("_k"), "left_semi")


def drop_matching(df: DataFrame, keys: DataFrame, on: str, key: str | None = None) -> DataFrame:
    """NOT IN (subquery without NULLs).  A row whose own key is NULL is dropped as well, unless
    the subquery is empty, which the callers' data rules out.  A plain anti join, because the
    null-aware one has to broadcast the subquery."""
    right = _keys(keys, key or on, unique=False)
    return df.filter(F.col(on).isNotNull()).join(right, F.col(on) == F.col("_k"), "left_anti")


def without_match(df: DataFrame, keys: DataFrame, on: str, key: str) -> DataFrame:
    """Outer join then IS NULL: rows with a NULL key stay."""
    return df.join(_keys(keys, key, unique=False), F.col(on) == F.col("_k"), "left_anti")


def exists_flag(df: DataFrame, keys: DataFrame, on: str, key: str, out: str) -> DataFrame:
    """Y when ``keys`` holds the value.  Keys are made distinct first: no fan-out."""
    right = keys.select(F.col(key).alias("_k")).filter(F.col("_k").isNotNull()).distinct()
    return (df.join(right, F.col(on) == F.col("_k"), "left")
            .withColumn(out, F.when(F.col("_k").isNotNull(), "Y").otherwise("N")).drop("_k"))


def decode(df: DataFrame, codes: DataFrame, names: Mapping[str, str], key: str = "code_sk",
           name: str = "code_name") -> DataFrame:
    """Decode several foreign keys with one dictionary: ``{fk column: output column}``."""
    for fk, out in names.items():
        df = left_lookup(df, codes, {fk: key}, {out: name})
    return df


def resolve_ancestor(df: DataFrame, parents: DataFrame, child: str, child_key: str,
                     parent_key: str, depth: int = 2) -> DataFrame:
    """Add ``_ancestor1`` .. ``_ancestorN`` by walking a child-to-parent table."""
    at = child
    for level in range(1, depth + 1):
        df = left_lookup(df, parents, {at: child_key}, {f"_ancestor{level}": parent_key})
        at = f"_ancestor{level}"
    return df


def deal_by_result(df: DataFrame, lookups: Sequence[tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """The rows dealt over as many tasks as the result of these left lookups fills, ``ROWS_PER_TASK`` rows of it each.

    ``lookups`` are (dimension, {row column: dimension column}).  A narrow count tells how many rows come out; it groups
    the dimensions by their keys and multiplies the counts, so nothing is fanned out for it."""
    rows = df.select(*{c: None for _, on in lookups for c in on})
    for k, (dim, on) in enumerate(lookups):
        counts = dim.groupBy(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(on.values())]).agg(F.count("*").alias("_n"))
        rows = left_lookup(rows, counts, {c: f"_c{i}" for i, c in enumerate(on)}, {f"_n{k}": "_n"})
    product = reduce(operator.mul, [F.coalesce(f"_n{k}", F.lit(1)).cast("double") for k in range(len(lookups))], F.lit(1.0))
    total = rows.agg(F.sum(product)).first()[0] or 0
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, min(MOST_TASKS, math.ceil(total / ROWS_PER_TASK))))


def carried(dims: Sequence[DataFrame], counted: Sequence[DataFrame] | None = None) -> list[DataFrame]:
    """The dimensions, those of at most ``CARRIED_ROWS`` rows (in ``counted``, if they are made from it) marked to be sent to
    every task: counted, not estimated."""
    sizes = reduce(DataFrame.unionAll, [d.agg(F.lit(k).alias("k"), F.count("*").alias("n")) for k, d in enumerate(counted or dims)])
    rows = {r["k"]: r["n"] for r in sizes.collect()}
    return [F.broadcast(d) if rows[k] <= CARRIED_ROWS else d for k, d in enumerate(dims)]


def list_lookup(facts: DataFrame, dim: DataFrame, on: Mapping[str, str], take: Mapping[str, str]) -> DataFrame:
    """``left_lookup`` in a dimension that has many rows of each key.

    They are gathered in lists of about ``LIST_ROWS``.  A fact meets the lists of its key and unfolds each from one piece of
    memory, where a hash table would be walked through row by row; so it is also the lists that move, if anything does."""
    keys = [f"_key{i}" for i in range(len(on))]
    right = dim.select(*[F.col(c).alias(k) for k, c in zip(keys, on.values(), strict=True)],
                       F.struct(*[F.col(old).alias(new) for new, old in take.items()]).alias("_one")).dropna(subset=keys)
    pieces = right.groupBy(*[F.col(k).alias(f"{k}_of") for k in keys]).agg(F.ceil(F.count("*") / LIST_ROWS).alias("_pieces"))
    right = left_lookup(right, pieces, {k: f"{k}_of" for k in keys}, {"_pieces": "_pieces"}, how="inner")
    lists = right.groupBy(*keys, F.pmod(F.xxhash64("_one"), "_pieces").alias("_piece")).agg(F.collect_list("_one").alias("_many"))
    met = left_lookup(facts, *carried([lists], [dim]), {c: k for c, k in zip(on, keys, strict=True)}, {"_many": "_many"})
    return met.select(*facts.columns, F.explode_outer("_many").alias("_one")).select(*facts.columns, "_one.*")


def level_managers(df: DataFrame, staff: DataFrame, force: str, level: str, managers: Sequence[tuple[str, str, Mapping[str, str]]],
                   then: Sequence[tuple[DataFrame, Mapping[str, str]]] = ()) -> DataFrame:
    """Attach the managers that ``staff`` lists at the given hierarchy levels.

    Each entry is (level value, number column of both sides, columns to take).  A force has few numbers and many people of
    each, so a row meets a growing share of the managers and the result grows much faster than the input, while the
    input is small enough for a single file.  The rows are dealt over as many tasks as the result needs before they meet
    anybody, also that of the lookups the caller lets follow (``then``: dimension, {row column: dimension column}).  They stay
    there: managers are brought to them as long as their counted rows are few, since a join on so few keys would gather
    the rows in a few tasks and move them fanned out."""
    sides = [(staff.filter(F.col(level) == value).select(force, number, *take.values()), {force: force, number: number})
             for value, number, take in managers]
    df = deal_by_result(df, [*sides, *then])
    for (_, on), dim, (_, _, take) in zip(sides, carried([dim for dim, _ in sides]), managers, strict=True):
        df = left_lookup(df, dim, on, take)
    return df
