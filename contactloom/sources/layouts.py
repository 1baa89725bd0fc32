"""Facts and the tables they meet, stored in the same buckets, so that joins on the key move no row."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.operators.joins import hot_keys

SALT = "_layout_salt"


@dataclass(frozen=True)
class KeyedLayout:
    """Tables ``<prefix>_<name>`` in ``buckets`` buckets of (key, salt), each bucket sorted by both.

    Facts of a key that owns more than a bucket's share are dealt over as many salts as it owns shares, those without a
    key over all buckets; tables that facts meet repeat the rows of such keys once per salt.  Which keys these are is
    decided once, by ``create``, and kept in ``<prefix>_hot``; facts that are appended later and tables written anew
    follow it.  A key that becomes hot afterwards costs balance, never rows; ``create`` under a new prefix mends that.
    The salt comes from the row's id, so a task that runs again agrees with its first run."""

    spark: SparkSession
    prefix: str
    buckets: int

    @classmethod
    def create(cls, prefix: str, facts: DataFrame, key: str, buckets: int) -> KeyedLayout:
        """Decide about the keys of ``facts``; nothing but ``key`` is read."""
        hot_keys(facts, key, buckets).write.mode("overwrite").saveAsTable(f"{prefix}_hot")
        return cls(facts.sparkSession, prefix, buckets)

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.prefix}_{name}")

    def _hot(self) -> DataFrame:
        # at most one row a bucket
        return F.broadcast(self.table("hot"))

    def _write(self, df: DataFrame, name: str, key: str, mode: str) -> DataFrame:
        """One file a bucket: rows are dealt the way buckets are."""
        (df.repartition(self.buckets, key, SALT).write.mode(mode).bucketBy(self.buckets, key, SALT)
         .sortBy(key, SALT).saveAsTable(f"{self.prefix}_{name}"))
        return self.table(name)

    def store_facts(self, df: DataFrame, name: str, key: str, row_id: str, append: bool = False) -> DataFrame:
        """Write facts, each row once."""
        dealt = F.xxhash64(row_id)
        salt = F.when(F.col(key).isNull(), F.pmod(dealt, F.lit(self.buckets))).otherwise(
            F.coalesce(F.pmod(dealt, F.col("_salts")), F.lit(0)))
        rows = df.join(self._hot(), F.col(key) == F.col("_hot"), "left").withColumn(SALT, salt.cast("int")).drop("_hot", "_salts")
        return self._write(rows, name, key, "append" if append else "overwrite")

    def store_lookup(self, df: DataFrame, name: str, key: str) -> DataFrame:
        """Write a table that facts are joined to; rows without a key, which match nothing, are left out."""
        salts = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
        rows = (df.filter(F.col(key).isNotNull()).join(self._hot(), F.col(key) == F.col("_hot"), "left")
                .withColumn(SALT, F.explode(salts)).drop("_hot", "_salts"))
        return self._write(rows, name, key, "overwrite")

    def join(self, facts: str, fact_key: str, lookup: str, lookup_key: str, residual: Callable[[DataFrame, DataFrame], Column] | None = None,
             how: str = "left") -> DataFrame:
        """Left or inner join of two stored tables, bucket by bucket.  Columns keep their names but for the salt; the
        lookup's key goes, since the facts have it."""
        if how not in ("left", "inner"):
            raise ValueError(f"left or inner, not {how}")
        left, right = self.table(facts), self.table(lookup)
        cond = (left[fact_key] == right[lookup_key]) & (left[SALT] == right[SALT])
        if residual is not None:
            cond = cond & residual(left, right)
        return left.join(right, cond, how).drop(right[lookup_key], left[SALT], right[SALT])

    def interval_join(self, facts: str, fact_key: str, spans: str, span_key: str, day: str, start: str, end: str, hit: str) -> DataFrame:
        """Left join on the key with ``start <= day <= end``; ``hit`` tells whether a span matched.  Of the spans only
        that is kept."""
        rows = self.join(facts, fact_key, spans, span_key, lambda f, s: f[day].between(s[start], s[end]))
        known = F.col(start).isNotNull()
        kept = [c for c in self.table(facts).columns if c != SALT]
        return rows.withColumn(hit, known).select(*kept, hit)

    def drop(self) -> None:
        """Remove all tables of the layout."""
        for t in self.spark.catalog.listTables():
            if not t.isTemporary and t.name.startswith(f"{self.prefix.lower()}_"):
                self.spark.sql(f"DROP TABLE IF EXISTS {t.name}")
