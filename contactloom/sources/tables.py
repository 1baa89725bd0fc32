"""Table access: lazy scans by name, snapshots, views, run parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.session import use_checkpoint_dir
from contactloom.sources.contracts import TARGET_LIST

#: Folders that ``settle`` made inside the innermost ``intermediates`` block.
_SETTLED: ContextVar[list[str] | None] = ContextVar("settled", default=None)


def load(spark: SparkSession, name: str, folder: str | None = None) -> DataFrame:
    """Scan one table: a Parquet file of that name in ``folder``, else a catalog table.

    The scan is lazy, so the columns and filters of the query reach the Parquet reader."""
    if folder is None:
        return spark.table(name)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


class Tables(Mapping[str, DataFrame]):
    """Tables by short name, opened on first use.

    ``open_table`` maps a short name to a DataFrame, e.g. ``lambda n: spark.table(db[n])``;
    results that later plans build on are added with ``with_results``."""

    def __init__(self, open_table: Callable[[str], DataFrame],
                 results: Mapping[str, DataFrame] | None = None):
        self._open, self._known = open_table, dict(results or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            self._known[name] = self._open(name)
        return self._known[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._known)

    def __len__(self) -> int:
        return len(self._known)

    def with_results(self, **results: DataFrame) -> Tables:
        return Tables(self._open, {**self._known, **results})


def materialize(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Full-refresh snapshot: overwrite ``path`` and read it back."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_table(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Full-refresh snapshot under a table name, as the workflows keep their products."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def write_products(products: Mapping[str, DataFrame], prefix: str, partitions: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """Write the results of a workflow, each as table ``<prefix>_<name>``, partitioned where ``partitions`` names a column."""
    return {name: materialize_table(df, f"{prefix}_{name}", (partitions or {}).get(name)) for name, df in products.items()}


def settle(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write an intermediate result to the shared folder and go on from the files.

    For results that are costly to make and read more than once.  Readers of a few columns read
    only those from the files, and a lost executor costs a re-read instead of the whole lineage.
    Every call takes a new folder; inside ``intermediates`` it goes at the block's end, else who owns the shared
    folder cleans it."""
    use_checkpoint_dir(df.sparkSession)
    folder = f"{df.sparkSession.sparkContext.getCheckpointDir()}/{label}-{uuid.uuid4().hex}"
    if (made := _SETTLED.get()) is not None:
        made.append(folder)
    return materialize(df, folder, partition_by)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Remove what ``settle`` writes inside the block when it ends, also after a failure.  Frames that stand on it
    cannot be read afterwards, so results have to be written inside."""
    made: list[str] = []
    token = _SETTLED.set(made)
    try:
        yield
    finally:
        _SETTLED.reset(token)
        for folder in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def view(name: str, df: DataFrame) -> DataFrame:
    """Register a result so that SQL users can build on it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def load_target_list(spark: SparkSession, path: str, file_format: str = "csv") -> DataFrame:
    """The static target list; every column is text, whatever the file suggests."""
    reader = spark.read.schema(TARGET_LIST)
    return reader.option("header", True).csv(path) if file_format == "csv" else (
        reader.format(file_format).load(path))


def run_parameter(params: DataFrame, etl_name: str) -> Column:
    """Extract date of one job as a scalar subquery; NULL when the job has no row."""
    return (params.filter(F.col("etl_name") == etl_name)
            .select(F.col("extract_date").cast("date")).scalar())
