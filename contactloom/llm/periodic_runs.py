"""Periodic runs of words: tiles by octave of the period, boundary matches inside a tile, stitching by document and period.

A run is a maximal stretch of words with smallest period q that is at least ``max(6, 4 * q)`` words long.  Said otherwise:
a maximal stretch of places i at which word i equals word i + q, of at least ``max(6, 4 * q) - q`` places.  Such a stretch
contains a whole block of 2**k places for the octave 2**k <= q < 2**(k + 1), wherever blocks are laid.

A document is exploded into overlapping tiles per octave: 32 blocks long, the next one 24 blocks further, so that any
three blocks in a row lie in a tile with their partners.  Octaves whose tiles would be shorter than ``TILE`` words share
tiles of that size, and a document that fits in a tile is one tile for all octaves; it is solved where it is read, while
tiles of longer documents are dealt out to all tasks.  Tiles are solved independently: the word at each block boundary is
compared with the words one octave further, by names of blocks (64-bit hashes of 2**k words, from those of half the size),
and where a block equals its partner the two Z values of the boundary, how far the match goes on to the right and to the
left inside the tile, are found by halving block sizes.  Matches inside a stretch with a smaller period are skipped.

What a tile finds is an interval of places.  Intervals that end at an edge of their tile may go on in the next one: all
are shuffled by (document, period), those that touch are stitched, and those that are long enough are the runs.

Null and empty text has no words and no run.  Repeated rows are documents of their own; a null id stays null.  Only
doc_id and text are read, so other columns may have any names.  A text of any length is one row of one task when it is
read and when its runs are collapsed."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contactloom.llm.byte_bpe import take_spans
from contactloom.llm.shared import bytes_of, crc_of_id, hash_spans, mix, settle, slices, words

#: Words of the smallest tile, and bytes of text that one numpy step works on.
TILE, STEP = 1 << 13, 1 << 19
BLOCKS, STRIDE = 32, 24
INTERVALS = "array<struct<period:int,lo:int,hi:int>>"


def octaves_of(n: int) -> int:
    """Number of octaves whose periods can have a run in n words."""
    return (n // 4).bit_length()


def tiles_of(n: int, tile: int = TILE) -> list[tuple[int, int, int, int]]:
    """(first octave, octave after the last, start, end) of the tiles of a document of n words."""
    last = octaves_of(n)
    if n <= tile:
        return [(0, last, 0, n)]
    out, k = [], max(1, (tile // BLOCKS).bit_length())  # octaves below k share tiles
    groups = [(0, k), *((j, j + 1) for j in range(k, last))]
    for first, after in groups:
        size, step = BLOCKS << (after - 1), STRIDE << (after - 1)
        if size >= n:
            return [*out, (first, last, 0, n)]
        out += [(first, min(after, last), a, min(a + size, n)) for a in range(0, n - (size - step), step)]
    return out


def block_names(x: np.ndarray, levels: int) -> list[np.ndarray]:
    """Names of the 2**k words from each place on; names that reach over the end of a tile are not looked at."""
    out = [mix(x)]
    for k in range(levels):
        h, half = out[-1], 1 << k
        further = np.zeros_like(h)
        further[:max(0, len(h) - half)] = h[half:]
        out.append(mix(h * np.uint64(0x9E3779B97F4A7C15) + (further ^ np.uint64(0x5851F42D4C957F2D + k))))
    return out


def solve(x: np.ndarray, off: np.ndarray, first: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, ...]:
    """Intervals (tile, period, lo, hi) of equal places found in consecutive tiles, lo and hi counted from the tile's start.

    Every octave of a tile is looked at up to its last one, since stretches with small periods hide matches of their
    multiples; only those from its first octave on are told."""
    n, none = len(x), np.zeros(0, np.int64)
    levels = int(after.max(initial=0))
    if not n or not levels:
        return none, none, none, none
    names = block_names(x, levels - 1)
    size = np.diff(off)
    tile = np.repeat(np.arange(len(size)), size)
    start, end, most = off[:-1][tile], off[1:][tile], after[tile]
    cover = np.zeros(n, np.int64)  # end of the stretch found so far that starts here
    found: list[tuple[np.ndarray, ...]] = []
    place = np.arange(n)
    for k in range(levels):
        block = 1 << k
        place = place[most[place] > k]
        i = place[(place - start[place] >= block) & (place + block <= end[place])]
        at = start[i] + (((i - start[i]) >> k) - 1 << k)
        same = np.zeros(n, bool)
        hit = names[k][i] == names[k][at]
        i, at = i[hit], at[hit]
        same[i] = True
        go_on = (at - start[i] >= block) & same[i - block]  # the block before matches too
        hidden = np.maximum.accumulate(cover)[at] >= i + block
        i, at = i[~go_on & ~hidden], at[~go_on & ~hidden]
        if not len(i):
            continue
        q, begin, stop = i - at, start[i], end[i]
        ahead, back = np.full(len(i), block), np.zeros(len(i), np.int64)
        going = np.arange(len(i))
        while len(going):  # whole steps of the largest block
            going = _step(names[levels - 1], 1 << (levels - 1), at, q, ahead, stop, going)
        for j in range(levels - 2, -1, -1):
            _step(names[j], 1 << j, at, q, ahead, stop, np.arange(len(i)))
        for j in range(k - 1, -1, -1):
            to = at - back - (1 << j)
            ok = to >= begin
            to = np.where(ok, to, begin)
            back += (ok & (names[j][to] == names[j][to + q])) * (1 << j)
        lo, hi = at - back, at + ahead
        np.maximum.at(cover, lo, hi + q)
        own = tile[i]
        told = first[own] <= k
        found.append(tuple(v[told] for v in (own, q, lo - begin, hi - begin)))
    return tuple(np.concatenate([f[c] for f in found] or [none]) for c in range(4))


def _step(name: np.ndarray, size: int, at: np.ndarray, q: np.ndarray, ahead: np.ndarray, stop: np.ndarray, who: np.ndarray) -> np.ndarray:
    """Go one block further where it matches its partner; those that did."""
    to = at[who] + ahead[who]
    fits = to + q[who] + size <= stop[who]
    who, to = who[fits], to[fits]
    who = who[name[to] == name[to + q[who]]]
    ahead[who] += size
    return who


def least_places(q: np.ndarray | Column) -> np.ndarray | Column:
    """Equal places that a run of period q has at least."""
    return F.greatest(F.lit(6), 4 * q) - q if isinstance(q, Column) else np.maximum(6, 4 * q) - q


def word_order(n: int, crc: int) -> np.ndarray | None:
    """Numbers of the words that a document is looked at in; None where that is their own order."""
    if crc % 10 or not n:
        return None
    g = crc // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    out = np.arange(n)
    out[a:] = a + (out[a:] - a) % p
    return out


def _intervals(own: np.ndarray, q: np.ndarray, lo: np.ndarray, hi: np.ndarray, rows: int) -> pa.ListArray:
    order = np.argsort(own, kind="stable")
    upto = np.searchsorted(own[order], np.arange(rows + 1))
    made = pa.StructArray.from_arrays([pa.array(v[order].astype(np.int32)) for v in (q, lo, hi)], ["period", "lo", "hi"])
    return pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), made)


def _read(tile: int, step: int, repeat: bool) -> Callable:
    """Per document: number of words, digest of all of them, its intervals if it fits in a tile, and its words where they
    are needed later: for a document with intervals or with more than one tile."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = bytes_of(batch.column(2))
            crc = batch.column(3).to_numpy()
            for i, j in slices(off, step):
                part, own = data[off[i]:off[j]], off[i:j + 1] - off[i]
                starts, ends, _ = words(part, own)
                upto = np.searchsorted(starts, own)
                n = np.diff(upto)
                if repeat:
                    order = np.arange(len(starts))
                    for r in np.flatnonzero((crc[i:j] % 10 == 0) & (n > 0)):
                        order[upto[r]:upto[r + 1]] = upto[r] + word_order(int(n[r]), int(crc[i + r]))
                    x = hash_spans(part, starts, ends, fold=False)[order]
                    starts, ends = starts[order], ends[order]
                else:
                    x = hash_spans(part, starts, ends, fold=False)
                size = ends - starts + 1
                joined = take_spans(np.append(part, np.uint8(32)), starts, size)
                cut = np.cumsum(size)
                joined[cut - 1] = 32
                at = np.concatenate([[0], cut])[upto]
                raw = joined.tobytes()
                text = [raw[a:max(a, b - 1)] for a, b in zip(at[:-1], at[1:], strict=True)]
                short = n <= tile
                after = np.where(short, [octaves_of(int(v)) for v in n], 0)
                where, q, lo, hi = solve(x, upto, np.zeros_like(after), after)
                long_enough = hi - lo >= least_places(q)
                found = _intervals(*(v[long_enough] for v in (where, q, lo, hi)), rows=j - i)
                has = np.bincount(where[long_enough], minlength=j - i) > 0
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(n), found,
                     pa.array([hashlib.sha256(t).hexdigest() for t in text], pa.string()),
                     pa.array([t if keep else None for t, keep in zip(text, has | ~short, strict=True)], pa.binary())],
                    ["uid", "doc_id", "n", "found", "whole_sha256", "words"])

    return run


def _explode(tile: int) -> Callable:
    """Tiles of long documents, each with the hashes of its words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uid, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = np.frombuffer(raw.as_buffer(), np.uint8)
                starts, ends, _ = words(part, np.array([0, len(part)]))
                x = hash_spans(part, starts, ends, fold=False)
                for first, after, a, b in tiles_of(len(x), tile):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([uid], pa.int64()), pa.array([len(x)], pa.int32()), *[pa.array([v], pa.int32()) for v in (first, after, a)],
                         pa.array([x[a:b].tobytes()], pa.binary())], ["uid", "n", "first", "after", "start", "hashes"])

    return run


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Intervals of tiles, one tile at a time; those that cannot go on beyond their tile are told only if long enough."""
    for batch in batches:
        for k in range(len(batch)):
            uid, n, first, after, start = (batch.column(c)[k].as_py() for c in range(5))
            x = np.frombuffer(batch.column(5)[k].as_buffer(), np.uint64)
            _, q, lo, hi = solve(x, np.array([0, len(x)]), np.array([first]), np.array([after]))
            open_left, open_right = (lo == 0) & (start > 0), (hi + q == len(x)) & (start + len(x) < n)
            told = open_left | open_right | (hi - lo >= least_places(q))
            m = int(told.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, uid), pa.int64()), *[pa.array(v[told].astype(np.int32)) for v in (q, lo + start, hi + start)]],
                ["uid", "period", "lo", "hi"])


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of a document's runs and of the words that stay, and its run of the greatest exponent."""
    def ahead(a: tuple[int, int, int], b: tuple[int, int, int]) -> int:
        more = b[1] * a[2] - a[1] * b[2]  # length / period, compared without a fraction
        return more or (a[0], a[2]) > (b[0], b[2]) or -1

    for batch in batches:
        out: list[list] = [[] for _ in range(7)]
        for raw, found in zip(batch.column(1), batch.column(2), strict=True):
            part = np.frombuffer(raw.as_buffer(), np.uint8)
            starts, ends, _ = words(part, np.array([0, len(part)]))
            runs = sorted((r["start"], r["length"], r["period"]) for r in found.as_py())
            change = np.zeros(len(starts) + 1, np.int64)
            for s, length, q in runs:
                change[s + q] += 1
                change[s + length] -= 1
            kept = np.flatnonzero(np.cumsum(change)[:-1] == 0)
            text = take_spans(np.append(part, np.uint8(32)), starts[kept], ends[kept] - starts[kept] + 1).tobytes()[:-1]
            best = min(runs, key=cmp_to_key(ahead), default=(None, None, None))
            told = "".join(f"{s},{length},{q}\n" for s, length, q in sorted(runs, key=lambda r: (r[0], r[2])))
            for column, value in zip(out, (len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                                           hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(text).hexdigest()), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in out[:5]], *[pa.array(c, pa.string()) for c in out[5:]]],
                                         ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])


def stitched(found: DataFrame) -> DataFrame:
    """Runs (uid, start, length, period) from the intervals of all tiles."""
    own = Window.partitionBy("uid", "period").orderBy("lo", "hi")
    reach = F.max("hi").over(own.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.when(reach >= F.col("lo"), 0).otherwise(1)
    groups = found.withColumn("_apart", apart).withColumn("_group", F.sum("_apart").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    whole = groups.groupBy("uid", "period", "_group").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return whole.filter(F.col("hi") - F.col("lo") >= least_places(F.col("period"))).select(
        "uid", F.col("lo").alias("start"), (F.col("hi") - F.col("lo") + F.col("period")).alias("length"), "period")


def periodic_runs(docs: DataFrame, tile: int = TILE, step: int = STEP, repeat: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents, runs): (uid, doc_id, n, whole_sha256, words) of every row, and (uid, start, length, period) of every run.

    With ``repeat`` a tenth of the documents, by the CRC-32 of their id, are looked at with a tail that repeats."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), crc_of_id().alias("crc"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    read = settle(rows.mapInArrow(_read(tile, step, repeat), f"uid bigint, doc_id {kind}, n bigint, found {INTERVALS}, whole_sha256 string, words binary"), "runs-read")
    single = read.filter(F.size("found") > 0).select("uid", F.inline("found"))
    tiles = read.filter(F.col("n") > tile).select("uid", "words").mapInArrow(_explode(tile), "uid bigint, n int, first int, after int, start int, hashes binary")
    many = tiles.repartition("uid", "first", "start").mapInArrow(_solve, "uid bigint, period int, lo int, hi int")
    return read.drop("found"), stitched(single.unionAll(many))


def collapsed(read: DataFrame, runs: DataFrame) -> DataFrame:
    """One row per document: its runs counted and digested, the one of the greatest exponent, and the words that stay."""
    kind = read.schema["doc_id"].dataType.simpleString()
    per_document = runs.groupBy("uid").agg(F.collect_list(F.struct("start", "length", "period")).alias("runs"))
    having = read.filter(F.col("words").isNotNull()).join(per_document, "uid", "left").select(
        "doc_id", "words", F.coalesce("runs", F.array().cast("array<struct<start:int,length:int,period:int>>")).alias("runs"))
    some = having.mapInArrow(_collapse, f"doc_id {kind}, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
                                        "runs_sha256 string, collapsed_sha256 string")
    unknown = F.lit(None).cast("bigint")
    none = read.filter(F.col("words").isNull()).select(
        "doc_id", F.lit(0).cast("bigint").alias("n_runs"), *[unknown.alias(c) for c in ("start", "length", "period", "exponent_milli")],
        F.sha2(F.lit("").cast("binary"), 256).alias("runs_sha256"), F.col("whole_sha256").alias("collapsed_sha256"))
    return some.unionAll(none)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapsed(*periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), repeat=True))
