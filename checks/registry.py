"""How a registered query is put next to its SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.standins import BASE, STANDINS, needed_by
from contactloom.sources.tables import Tables, load

AS_OF = date(2021, 7, 1)


@dataclass(frozen=True)
class Check:
    """``build`` makes the result from the tables; ``sql`` is the same result in plain SQL.

    Results are compared as text, integers and doubles: ``ints`` and ``texts`` list the SQL
    columns to bring to BIGINT and VARCHAR, the Spark side is converted by type.  ``doubles``
    lists integer columns with NULLs, which clients show in different ways; both sides make
    them doubles."""

    build: Callable[[Tables], DataFrame]
    sql: str | None = None
    ints: str = ""
    texts: str = ""
    doubles: str = ""

    def query(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.present(self.build(open_tables(spark, folder)))

    def present(self, result: DataFrame) -> DataFrame:
        return plain_types(result).withColumns({c: F.col(c).cast("double") for c in self.doubles.split()})

    def oracle(self) -> str:
        casts = [f"CAST({c} AS BIGINT) AS {c}" for c in self.ints.split()
                 if c not in self.doubles.split()]
        casts += [f"CAST({c} AS VARCHAR) AS {c}" for c in self.texts.split()]
        casts += [f"CAST({c} AS DOUBLE) AS {c}" for c in self.doubles.split()]
        star = f"* REPLACE ({', '.join(casts)})" if casts else "*"
        names = needed_by(self.sql, STANDINS)
        with_inputs = ", ".join(f"{n} AS ({STANDINS[n]})" for n in names)
        prefix = f"WITH {with_inputs} " if with_inputs else ""
        return f"{prefix}SELECT {star} FROM ({self.sql}) AS result"


def open_tables(spark: SparkSession, folder: str) -> Tables:
    """Driver tables by name, and stand-ins derived from them, all lazy."""
    def open_table(name: str) -> DataFrame:
        if name in BASE:
            return load(spark, name, folder)
        for base in needed_by(STANDINS[name], dict.fromkeys(BASE, "")):
            load(spark, base, folder).createOrReplaceTempView(base)
        return spark.sql(STANDINS[name])

    return Tables(open_table)


def plain_types(df: DataFrame) -> DataFrame:
    out = []
    for field in df.schema.fields:
        c, kind = F.col(field.name), field.dataType
        if isinstance(kind, (T.IntegralType, T.BooleanType)):
            c = c.cast("bigint")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.DateType):
            c = c.cast("string")
        elif isinstance(kind, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        out.append(c.alias(field.name))
    return df.select(*out)
