"""What the text operators share: the scratch folder, Arrow batches as byte arrays, words and their hashes."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy step works on; the temporaries are about 40 times this.
SLICE = 1 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; below the warehouse where that is unset (as in tests)."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    return (named or spark.conf.get("spark.sql.warehouse.dir") + "/llm-scratch").rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result as Parquet to the shared folder and go on from the files."""
    folder = new_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def hold_batches(spark: SparkSession, size: str = "8m") -> None:
    """Hold batches for Python to so many bytes from now on, unless the session names a size of its own: with long texts
    the usual 64 MB stand in the JVM and in the worker at once, twice each."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.sparkContext.getConf().get(name) is None:
        spark.conf.set(name, size)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function for mapInArrow, which gives unused memory back when its task ends: workers live on between
    tasks, and what their allocators keep counts against the executor."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
            if trim:
                trim(0)

    return wrapped


@contextmanager
def arrow_batches(spark: SparkSession, size: str) -> Iterator[None]:
    """Hold batches for Python to so many bytes during the jobs inside: rows of packed arrays are large, and a worker
    and the JVM both keep a batch or two."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def texts(docs: DataFrame, *more: Column) -> DataFrame:
    """The id and the text of every row, null text as empty; other columns are left behind."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def crc_of_id(name: str = "doc_id") -> Column:
    """CRC-32 of the id as text; of the empty text for a null id."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def bytes_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text or binary column without nulls, and the offsets of its values, without a copy."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8)[off[0]:off[-1]] if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, off.astype(np.int64) - int(off[0])


def slices(off: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` bytes together; a longer row stands alone."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def byte_set(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


SPACE = byte_set(b"\x20\x09\x0a\x0b\x0c\x0d")
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

_MULT, _SEED = 0x9E3779B97F4A7C15, 20_240_607
_BYTE = np.random.default_rng(_SEED).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MASK = 2**64


def powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    m = 1
    while m < n:
        k = min(m, n - m)
        out[m:m + k] = out[:k] * np.uint64(pow(base, m, _MASK))
        m += k
    return out


_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse; a table of the usual size is kept in the worker."""
    size = max(SLICE, n)
    if size not in _tables:
        made = powers(_MULT, size), powers(pow(_MULT, -1, _MASK), size)
        if size > SLICE:
            return made
        _tables[size] = made
    return _tables[size]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def runs(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True; a run never crosses the start of a row."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < len(inside))]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit hash of the bytes of each span (sorted, not overlapping); A-Z count as a-z if ``fold``."""
    out = np.empty(len(starts), np.uint64)
    table = _BYTE[FOLD] if fold else _BYTE
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SLICE, side="right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        up, down = _powers_to(hi - lo)
        total = np.empty(hi - lo + 1, np.uint64)
        total[0] = 0
        np.cumsum(table[data[lo:hi]] * up[:hi - lo], out=total[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (total[e] - total[s]) * down[s]
        i = j
    return mix(out)


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs of bytes that are no ASCII space) of consecutive rows: starts, ends, and the row of each."""
    starts, ends = runs(~SPACE[data], off)
    return starts, ends, np.searchsorted(off, starts, side="right") - 1


def hash_ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive hashes, rows not regarded: len(h) - n + 1 values."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = h[:m].copy()
    for k in range(1, n):
        out = out * np.uint64(_MULT) + h[k:k + m]
    return mix(out)


def hash_text(value: str) -> int:
    """The hash that ``hash_spans`` gives to a word."""
    raw = np.frombuffer(value.encode(), np.uint8)
    return int(hash_spans(raw, np.array([0]), np.array([len(raw)]))[0]) if len(raw) else 0


def class_runs(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of letters, of digits and of other signs of consecutive rows: starts, ends, class (1, 2, 3)."""
    kind = CLASS[data]
    if not len(kind):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), kind
    first = np.ones(len(kind), bool)
    first[1:] = kind[1:] != kind[:-1]
    first[off[1:-1][off[1:-1] < len(kind)]] = True
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(kind))
    black = kind[starts] > 0
    return starts[black], ends[black], kind[starts[black]]


#: 0 for ASCII white space, 1 for letters and every byte outside ASCII, 2 for digits, 3 for the rest.
CLASS = np.full(256, 3, np.uint8)
CLASS[SPACE] = 0
CLASS[48:58] = 2
CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def sum_blocks(parts: DataFrame, label: str, kind: type = np.float32) -> DataFrame:
    """Sum of vectors of one kind by ``block``: of (block, values binary), with one row in memory per running sum."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, values in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.frombuffer(values.as_buffer(), kind)
                if block in sums:
                    sums[block] += own
                else:
                    sums[block] = own.astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()),
                                          pa.array([v.astype(kind).tobytes() for v in sums.values()], pa.binary())],
                                         ["block", "values"])

    return settle(parts.repartition("block").mapInArrow(run, "block int, values binary"), label)


def smallest_by_hash(rows: DataFrame, n: int) -> DataFrame:
    """At most n rows, those whose hashed id is smallest: a sample that does not depend on the order of the rows."""
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
