"""Removal of repeated passages by merging Burrows-Wheeler transforms of shards.

A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document with a smaller id, or earlier
in its own.  Strings are judged on the input and never cross documents.

1. Anchors.  In every stretch of ``length`` bytes the 36-byte string of least hash is an anchor, so two equal stretches hold
   the same anchor at the same place.  Anchors are counted over all documents; stretches without an anchor that occurs
   twice cannot repeat and go no further.
2. Shard transforms.  A task takes what surrounds each repeated anchor (so much on both sides that every stretch with the
   anchor is in it), as collections of strings aligned at their anchor, and sends their transform instead of the strings:
   column by column from the right, the symbols before the suffixes in sorted order.  Equal surroundings in a shard
   are sent once; all but the earliest are covered.
3. Merge.  A bucket holds the transforms of all shards for a range of anchors.  Which shard each suffix of the merged order
   comes from (the interleave) is refined from column to column: the next symbols are read off the transforms in turn and
   partition the interleave stably.  Suffixes are never sorted or compared.  Along the way each suffix learns how far it
   agrees with the one before it; runs that agree on ``length`` bytes are the repeated intervals, of which all but the
   earliest member are marked.
4. Marked stretches meet the texts again and are cut out.

Rows with the same id and the same text count as one document; of different texts with one id the order is that of their
hash; rows without an id come last.  Null and empty texts have no bytes.  Only doc_id (an integer) and text are read.  Long
texts go through whole; a shard takes at most SHARD surroundings at a time, whatever the size of a partition."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm.katz import planes, unplanes
from contactloom.llm.shared import SLICE, _BYTE, _powers_to, bytes_of, mix, slices, texts

GRAM = 36
#: Of an anchor's name so many high bits are compared when anchors are counted.  A chance match costs some work later,
#: where strings are told apart by their bytes; it changes no result.
NAME_BITS = 40
SHARD = 1 << 15
PAD = 0xFF  # occurs in no UTF-8 text
NO_ID = 2**63 - 1


@dataclass(frozen=True)
class Shape:
    """Bytes of a repeated string, and of the surroundings of an anchor: ``before`` bytes up to it, ``width`` in all."""

    length: int = 100

    @property
    def before(self) -> int:
        return self.length - GRAM

    @property
    def width(self) -> int:
        return 2 * self.length - GRAM


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of every GRAM consecutive bytes, worked off in blocks."""
    out = np.empty(max(0, len(data) - GRAM + 1), np.uint64)
    up, down = _powers_to(SLICE)
    step = SLICE - GRAM
    for a in range(0, len(out), step):
        b = min(len(out), a + step)
        part = data[a:b + GRAM - 1]
        total = np.empty(len(part) + 1, np.uint64)
        total[0] = 0
        np.cumsum(_BYTE[part] * up[:len(part)], out=total[1:])
        out[a:b] = (total[GRAM:] - total[:-GRAM]) * down[:b - a]
    return out


def slide(x: np.ndarray, n: int, best: np.ufunc) -> np.ndarray:
    """Best of every n consecutive values, by doubling."""
    size, out = 1, x
    while 2 * size <= n:
        out = best(out[:-size], out[size:])
        size *= 2
    rest = n - size
    return best(out[:-rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, off: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Places and names of the anchors of consecutive texts."""
    n = len(data)
    if n < shape.length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = gram_hashes(data)
    order = ((h * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(33)).astype(np.uint32) + np.uint32(1)
    window = shape.length - GRAM + 1
    least = slide(order, window, np.minimum)  # of the stretch that starts here
    ok = np.zeros(len(least), bool)
    for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        ok[a:max(a, b - shape.length + 1)] = True
    least[~ok] = 0
    wide = np.zeros(len(order) + window - 1, np.uint32)
    wide[window - 1:window - 1 + len(least)] = least
    at = np.flatnonzero(slide(wide, window, np.maximum)[:len(order)] == order)
    return at, mix(h[at]) >> np.uint64(64 - NAME_BITS) << np.uint64(64 - NAME_BITS)


def keyed(docs: DataFrame) -> DataFrame:
    return texts(docs).select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("hash"), "text")


def _postings(shape: Shape, bits: int):
    """(bucket, names, row, place, ids, hashes): the anchors of a slice by range of names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = (batch.column(k).to_numpy() for k in (0, 1))
            data, off = bytes_of(batch.column(2))
            for i0, j0 in slices(off):
                for i in range(i0, j0, 1 << 16):
                    j = min(j0, i + (1 << 16))
                    own = off[i:j + 1] - off[i]
                    at, name = anchors(data[off[i]:off[j]], own, shape)
                    if not len(at):
                        continue
                    order = np.argsort(name)
                    at, name = at[order], name[order]
                    row = np.searchsorted(own, at, side="right") - 1
                    some, cut = np.unique((name >> np.uint64(64 - bits)).astype(np.int64), return_index=True)
                    cut = np.append(cut, len(at))
                    cols: list[list] = [[], [], [], [], []]
                    for a, b in zip(cut[:-1], cut[1:], strict=True):
                        used, which = np.unique(row[a:b], return_inverse=True)
                        for col, x in zip(cols, (name[a:b], which.astype(np.uint16), (at[a:b] - own[row[a:b]]).astype(np.uint32),
                                                 ids[i + used], hashes[i + used]), strict=True):
                            col.append(planes(x))
                    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *(pa.array(c, pa.binary()) for c in cols)],
                                                     ["bucket", "names", "row", "place", "ids", "hashes"])

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each bucket and document the places of the anchors that occur more than once."""
    def close(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        name, ids, hashes, place = (np.concatenate([p[k] for p in parts]) for k in range(4))
        order = np.argsort(name, kind="stable")
        new = np.concatenate([[True], name[order][1:] != name[order][:-1]])
        keep = order[~(new & np.append(new[1:], True))]
        ids, hashes, place = ids[keep], hashes[keep], place[keep]
        order = np.lexsort((place, hashes, ids))
        ids, hashes, place = ids[order], hashes[order], place[order]
        if len(ids):
            yield by_document(ids, hashes, place.astype(np.int64), None)

    now, parts = None, []
    for batch in batches:
        for r, bucket in enumerate(batch.column(0).to_pylist()):
            if now is not None and bucket != now:
                yield from close(parts)
                parts = []
            now = bucket
            name, row, place, ids, hashes = (unplanes(batch.column(k + 1)[r].as_buffer(), kind)
                                             for k, kind in enumerate((np.uint64, np.uint16, np.uint32, np.int64, np.int64)))
            parts.append((name, ids[row], hashes[row], place))
    if now is not None:
        yield from close(parts)


def by_document(ids: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray | None) -> pa.RecordBatch:
    """One row per document of sorted entries, with the list of its numbers (and of a second kind of them)."""
    first = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1])]))
    off = pa.array(np.append(first, len(ids)), pa.int32())
    lists = [pa.ListArray.from_arrays(off, pa.array(x)) for x in (starts, ends) if x is not None]
    return pa.RecordBatch.from_arrays([pa.array(ids[first]), pa.array(hashes[first]), *lists], ["id", "hash", "starts", "ends"][:2 + len(lists)])


def surroundings(data: np.ndarray, places: np.ndarray, shape: Shape) -> np.ndarray:
    """The bytes around each anchor of one text, PAD outside of it."""
    at = places[:, None] + np.arange(-shape.before, shape.width - shape.before)
    inside = (at >= 0) & (at < len(data))
    return np.where(inside, data[np.clip(at, 0, len(data) - 1)], np.uint8(PAD))


def refine(group: np.ndarray, symbol: np.ndarray) -> np.ndarray | None:
    """Stable partition of each group by symbol; None if it stands that way already."""
    key = group * 256 + symbol
    return None if (key[1:] >= key[:-1]).all() else np.argsort(key, kind="stable")


def transform(strings: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Transform of aligned strings, by column: the symbols at a column in the order of what follows them."""
    out = np.empty(strings.shape[::-1], np.uint8)
    order = np.arange(len(group))
    for c in range(strings.shape[1] - 1, -1, -1):
        out[c] = strings[order, c]
        moved = refine(group, out[c])
        if moved is not None:
            order = order[moved]
    return out


def merge(transforms: np.ndarray, shard: np.ndarray, group: np.ndarray, valid: tuple[np.ndarray, np.ndarray], rank: np.ndarray,
          shape: Shape) -> np.ndarray:
    """For each string and each column up to the anchor: whether the stretch that starts there starts earlier elsewhere.

    ``transforms`` has those of all shards side by side, ``shard`` and ``group`` say of each string in the first order
    of its shard where it belongs, ``rank`` which comes earlier, and ``valid`` how many bytes at either end are PAD."""
    m, width = len(group), shape.width
    who = np.argsort(group, kind="stable")
    interleave, group = shard[who], group[who]
    agrees = np.full(m, width)
    marked = np.zeros((m, shape.before + 1), bool)
    for c in range(width - 1, -1, -1):
        symbol = np.empty(m, np.uint8)
        symbol[np.argsort(interleave, kind="stable")] = transforms[c]
        moved = refine(group, symbol)
        if moved is None:
            same = (group[1:] == group[:-1]) & (symbol[1:] == symbol[:-1])
            agrees[1:] = np.where(same, agrees[1:], c)
        else:
            symbol = symbol[moved]
            same = (group[1:] == group[:-1]) & (symbol[1:] == symbol[:-1])
            before, own = moved[:-1][same] + 1, moved[1:][same]
            new = np.full(m, c)
            new[1:][same] = least_between(agrees, before, own)
            agrees, who, interleave = new, who[moved], interleave[moved]
        agrees[0] = c
        if c <= shape.before:
            starts = np.flatnonzero(agrees < c + shape.length)
            if len(starts) < m:
                first = np.minimum.reduceat(rank[who], starts)
                later = rank[who] > np.repeat(first, np.diff(np.append(starts, m)))
                found = who[later]
                found = found[(valid[0][found] <= c) & (c + shape.length <= width - valid[1][found])]
                marked[found, c] = True
    return marked


def least_between(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least of values[a..b], both ends in, for each pair."""
    out = values[b].copy()
    wide = np.flatnonzero(a < b)
    if len(wide):
        at = np.empty(2 * len(wide), np.int64)
        at[0::2], at[1::2] = a[wide], b[wide]
        out[wide] = np.minimum(out[wide], np.minimum.reduceat(values, at)[0::2])
    return out


@dataclass
class Pending:
    """Surroundings that wait to be sent as a shard."""

    shape: Shape
    bits: int

    def __post_init__(self) -> None:
        self.strings: list[np.ndarray] = []
        self.ids: list[np.ndarray] = []
        self.hashes: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.size = 0

    def add(self, doc: int, text_hash: int, data: np.ndarray, places: np.ndarray) -> None:
        self.strings.append(surroundings(data, places, self.shape))
        self.ids.append(np.full(len(places), doc))
        self.hashes.append(np.full(len(places), text_hash))
        self.places.append(places)
        self.size += len(places)

    def give(self, shard: int) -> pa.RecordBatch | None:
        if not self.size:
            return None
        strings, ids, hashes, places = (np.concatenate(x) for x in (self.strings, self.ids, self.hashes, self.places))
        self.__post_init__()
        pads = strings == PAD
        left, right = pads[:, :self.shape.before].sum(1), pads[:, self.shape.before:].sum(1)
        up, _ = _powers_to(self.shape.width)
        name = mix((_BYTE[strings[:, self.shape.before:self.shape.before + GRAM]] * up[:GRAM]).sum(1, dtype=np.uint64))
        whole = mix((_BYTE[strings] * up[:self.shape.width]).sum(1, dtype=np.uint64))
        order = np.lexsort((places, hashes, ids, whole))
        first = np.concatenate([[True], whole[order][1:] != whole[order][:-1]])
        leader = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
        equal = (strings[order] == strings[leader]).all(1) & ~first
        copies, kept = order[equal], order[~equal]
        kept = kept[np.argsort(name[kept], kind="stable")]
        group = np.cumsum(np.concatenate([[0], name[kept][1:] != name[kept][:-1]]))
        columns = transform(strings[kept], group)
        some, cut = np.unique((name[kept] >> np.uint64(64 - self.bits)).astype(np.int64), return_index=True)
        cut = np.append(cut, len(kept))
        rows: list[list] = [[], [], [], [], [], [], []]
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            k = kept[a:b]
            for col, x in zip(rows, (pa.compress(np.ascontiguousarray(columns[:, a:b]).tobytes(), "zstd", asbytes=True), planes(name[k]), planes(ids[k]), planes(hashes[k]),
                                     planes(places[k].astype(np.uint32)), left[k].astype(np.uint8).tobytes(),
                                     right[k].astype(np.uint8).tobytes()), strict=True):
                col.append(x)
        if len(copies):  # covered as they stand; they travel as rows of their own
            start, end = places - self.shape.before + left, places - self.shape.before + self.shape.width - right
            some = np.append(some, shard % (1 << self.bits))
            for col, x in zip(rows, (None, None, planes(ids[copies]), planes(hashes[copies]), planes(start[copies].astype(np.uint32)),
                                     planes(end[copies].astype(np.uint32)), None), strict=True):
                col.append(x)
        return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *(pa.array(r, pa.binary()) for r in rows)], SENT)


SENT = ["bucket", "columns", "names", "ids", "hashes", "places", "left", "right"]


def _shards(shape: Shape, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, shard = Pending(shape, bits), 0
        for batch in batches:
            ids, hashes = (batch.column(k).to_numpy() for k in (0, 1))
            data, off = bytes_of(batch.column(2))
            for r in np.flatnonzero(batch.column(3).is_valid().to_numpy(zero_copy_only=False)):
                places = np.sort(batch.column(3)[int(r)].values.to_numpy())
                for k in range(0, len(places), SHARD):
                    pending.add(int(ids[r]), int(hashes[r]), data[off[r]:off[r + 1]], places[k:k + SHARD])
                    if pending.size >= SHARD:
                        yield pending.give(shard)
                        shard += 1
        rest = pending.give(shard)
        if rest is not None:
            yield rest

    return run


def _merged(shape: Shape):
    """Stretches to remove, by document, from the shards of each bucket."""
    def close(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        columns = np.concatenate([p[0] for p in parts], axis=1)
        name, ids, hashes, places, left, right = (np.concatenate([p[k] for p in parts]) for k in range(1, 7))
        shard = np.repeat(np.arange(len(parts)), [len(p[1]) for p in parts]).astype(np.uint16 if len(parts) < 1 << 16 else np.int64)
        _, group = np.unique(name, return_inverse=True)
        rank = np.empty(len(name), np.int64)
        rank[np.lexsort((places, hashes, ids))] = np.arange(len(name))
        marked = merge(columns, shard, group, (left, right), rank, shape)
        edge = np.diff(np.pad(marked.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, a = np.nonzero(edge == 1)
        _, b = np.nonzero(edge == -1)
        start = places[row] - shape.before + a
        yield from give(ids[row], hashes[row], start, start + (b - a) - 1 + shape.length)

    def give(ids: np.ndarray, hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((start, hashes, ids))
        if len(order):
            yield by_document(ids[order], hashes[order], start[order], end[order])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            for r, bucket in enumerate(batch.column(0).to_pylist()):
                raw = [None if not c[r].is_valid else c[r].as_buffer() for c in batch.columns[1:]]
                ids, hashes, places = unplanes(raw[2], np.int64), unplanes(raw[3], np.int64), unplanes(raw[4], np.uint32).astype(np.int64)
                if raw[0] is None:
                    yield from give(ids, hashes, places, unplanes(raw[5], np.uint32).astype(np.int64))
                    continue
                if now is not None and bucket != now:
                    yield from close(parts)
                    parts = []
                now = bucket
                columns = pa.decompress(raw[0], len(ids) * shape.width, "zstd")
                parts.append((np.frombuffer(columns, np.uint8).reshape(shape.width, -1), unplanes(raw[1], np.uint64), ids, hashes, places,
                              np.frombuffer(raw[5], np.uint8).astype(np.int64), np.frombuffer(raw[6], np.uint8).astype(np.int64)))
        if now is not None:
            yield from close(parts)

    return run


def covered(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs that the stretches cover."""
    order = np.argsort(starts, kind="stable")
    starts, upto = starts[order], np.maximum.accumulate(ends[order])
    first = np.flatnonzero(np.concatenate([[True], starts[1:] > upto[:-1]]))
    return starts[first], upto[np.append(first[1:], len(starts)) - 1]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, off = bytes_of(batch.column(1))
        known = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
        kept, spans = [], []
        for r in range(batch.num_rows):
            own = data[off[r]:off[r + 1]]
            if known[r]:
                a, b = covered(batch.column(2)[r].values.to_numpy(), batch.column(3)[r].values.to_numpy())
                edge = np.zeros(len(own) + 1, np.int8)
                edge[a] += 1
                edge[b] -= 1
                kept.append(own[np.cumsum(edge[:-1]) == 0].tobytes())
                spans.append([{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)])
            else:
                kept.append(own.tobytes())
                spans.append([])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(off)), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
             pa.array(kept, pa.binary())], ["id", "n_bytes", "removed", "kept"])


def without_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """(doc_id, n_bytes, removed, kept) of every row: the removed runs as byte spans, and the remaining bytes."""
    if length < GRAM + 1:
        raise ValueError(f"strings of at least {GRAM + 1} bytes")
    shape = Shape(length)
    bits = max(4, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")).bit_length())
    rows = keyed(docs)
    places = (rows.mapInArrow(_postings(shape, bits), "bucket int, names binary, row binary, place binary, ids binary, hashes binary")
              .repartition("bucket").sortWithinPartitions("bucket")
              .mapInArrow(_repeated, "id bigint, hash bigint, starts array<bigint>")
              .groupBy("id", "hash").agg(F.flatten(F.collect_list("starts")).alias("places")))
    held = rows.join(places.hint("shuffle_hash"), ["id", "hash"], "left").select("id", "hash", "text", "places")
    sent = held.mapInArrow(_shards(shape, bits), "bucket int, columns binary, names binary, ids binary, hashes binary, places binary, left binary, right binary")
    gone = (sent.repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(_merged(shape), "id bigint, hash bigint, starts array<bigint>, ends array<bigint>")
            .groupBy("id", "hash").agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends")))
    cut = rows.join(gone.hint("shuffle_hash"), ["id", "hash"], "left").select("id", "text", "starts", "ends").mapInArrow(
        _cut, "id bigint, n_bytes bigint, removed array<struct<start: bigint, end: bigint>>, kept binary")
    return cut.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_bytes", "removed", "kept")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.coalesce(F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"]), F.lit(0).cast("bigint"))
    return without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
