"""Benchmark decontamination: rare words and word pairs find passages, Smith-Waterman alignment scores them.

Words are runs of letters or digits, capitals (ASCII and Latin-1) as small letters.  Items are aligned with documents word
by word (match 2, other word -1, gap -1), and the score is divided by that of a full match.  From ``threshold`` on the
document counts as contaminated with the item.

Only regions that hold a seed are aligned, and no alignment that reaches the threshold is lost: if M of an item's m words
match, in r runs without an edit inside, at least r - 1 edits part the runs, so the score is at most 2 M - (r - 1), which is
1 + M + the matched word pairs.  To reach t it needs t - 1 of the item's m words and m - 1 pairs, so one of any
2 m - t + 1 of these.  Those that the fewest documents have (counted over the whole corpus; most often none) are the seeds.
Edits number 2 m - t at most, which bounds how far from the seed a passage can start and end.

Test items are taken in blocks of at most ``block_seeds`` seeds, which bounds what is broadcast; every block meets every
document, and there is one block unless the benchmark is very large.  Documents are never shuffled.

Null and empty texts and items have no words and match nothing.  An item of up to ``short`` words has one seed, all its
words, and counts only where they stand whole.  Items with the same text are each reported; rows that repeat in documents are reported once each; a null
doc_id stays null; items without an id are reported with a null one.  Only doc_id, text, item_id and text are read.
Regions of long texts are cut into overlapping pieces of a few item lengths, each aligned."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm.shared import bytes_of, class_runs, hash_ngrams, hash_spans, lean, slices, texts

SHORT, THRESHOLD = 3, 0.5


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start, end and row of the words of consecutive texts."""
    data = small_accents(data)
    starts, ends, kind = class_runs(data, off)
    plain = kind < 3
    starts, ends = starts[plain], ends[plain]
    return hash_spans(data, starts, ends), starts, ends, np.searchsorted(off, starts, side="right") - 1


def small_accents(data: np.ndarray) -> np.ndarray:
    """Capital letters of the Latin-1 block as small ones; in UTF-8 they differ in one bit of the second byte."""
    at = np.flatnonzero(data == 0xC3) + 1
    at = at[at < len(data)]
    at = at[(data[at] >= 0x80) & (data[at] <= 0x9E) & (data[at] != 0x97)]
    if not len(at):
        return data
    out = data.copy()
    out[at] |= 0x20
    return out


@dataclass
class Items:
    """A block of test items: words one after the other, and the seeds of all of them, sorted."""

    ids: list
    words: np.ndarray
    off: np.ndarray
    seed: np.ndarray  # distinct hashes, sorted
    place_off: np.ndarray  # of each seed in the two below
    item: np.ndarray
    at: np.ndarray
    sizes: list[int]
    short: int

    @classmethod
    def of(cls, rows: list[tuple], short: int) -> Items:
        data, off = bytes_of(pa.array([t or "" for _, t in rows], pa.string()))
        h, _, _, row = word_hashes(data, off)
        words_off = np.searchsorted(row, np.arange(len(rows) + 1))
        seeds, items, at, sizes = [], [], [], set()
        for k in range(len(rows)):
            own = h[words_off[k]:words_off[k + 1]]
            if not len(own):
                continue
            for n in (1, 2) if len(own) > short else (len(own),):
                found = hash_ngrams(own, n)
                if len(found):
                    sizes.add(n)
                seeds.append(found)
                items.append(np.full(len(found), k))
                at.append(np.arange(len(found)))
        return cls([i for i, _ in rows], h, words_off, *cls._index(seeds, items, at), sorted(sizes), short)

    @staticmethod
    def _index(seeds: list, items: list, at: list) -> tuple:
        seeds, items, at = (np.concatenate([*x, np.zeros(0, t)]).astype(t) for x, t in ((seeds, np.uint64), (items, np.int64), (at, np.int64)))
        order = np.argsort(seeds, kind="stable")
        distinct, first = np.unique(seeds[order], return_index=True)
        return distinct, np.append(first, len(seeds)), items[order], at[order]

    def edits(self, threshold: float) -> np.ndarray:
        """How many edits an alignment of each item may hold at most."""
        size = np.diff(self.off)
        return 2 * size - np.ceil(2 * threshold * size - 1e-9).astype(np.int64)

    def rare(self, counts: np.ndarray, threshold: float) -> Items:
        """The same items with as many of their rarest seeds as the threshold asks for (ties: the smaller hash)."""
        which = np.repeat(np.arange(len(self.seed)), np.diff(self.place_off))
        rank = np.empty(len(self.seed), np.int64)
        rank[np.lexsort((self.seed, counts))] = np.arange(len(self.seed))
        order = np.lexsort((self.at, rank[which], self.item))
        which, item, at = which[order], self.item[order], self.at[order]
        nth = np.arange(len(item)) - np.searchsorted(item, item)
        keep = (nth <= self.edits(threshold)[item]) | (np.diff(self.off)[item] <= self.short)
        chosen = self._index([self.seed[which[keep]]], [item[keep]], [at[keep]])
        return Items(self.ids, self.words, self.off, *chosen, self.sizes, self.short)

    def filter_bits(self) -> np.ndarray:
        """For each of 2**20 hash classes whether a seed falls into it."""
        out = np.zeros(1 << 20, bool)
        out[(self.seed >> np.uint64(44)).astype(np.int64)] = True
        return out


def find_seeds(h: np.ndarray, row: np.ndarray, items: Items, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, seed number) of every word and word pair of the texts that is a seed."""
    words, seeds = [], []
    for n in items.sizes:
        grams = hash_ngrams(h, n)
        if not len(grams):
            continue
        maybe = np.flatnonzero(bits[(grams >> np.uint64(44)).astype(np.int64)])
        maybe = maybe[row[maybe] == row[maybe + n - 1]]
        k = np.minimum(np.searchsorted(items.seed, grams[maybe]), len(items.seed) - 1)
        hit = items.seed[k] == grams[maybe]
        words.append(maybe[hit])
        seeds.append(k[hit])
    return np.concatenate([*words, np.zeros(0, np.int64)]), np.concatenate([*seeds, np.zeros(0, np.int64)])


def regions(word: np.ndarray, seed: np.ndarray, row: np.ndarray, row_words: np.ndarray, items: Items, threshold: float) -> np.ndarray:
    """Rows (row, item, first word, end word) of the stretches in which an item may stand."""
    n = np.diff(items.place_off)[seed]
    place = np.repeat(items.place_off[seed] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))
    word, item, at = np.repeat(word, n), items.item[place], items.at[place]
    size = np.diff(items.off)[item]
    slack = items.edits(threshold)[item]
    own = row[word]
    lo = np.maximum(word - at - slack, row_words[own])
    hi = np.minimum(word - at + size + slack, row_words[own + 1])
    order = np.lexsort((lo, item, own))
    own, item, lo, hi, size = own[order], item[order], lo[order], hi[order], size[order]
    if not len(own):
        return np.zeros((0, 4), np.int64)
    pair = np.concatenate([[0], np.cumsum((own[1:] != own[:-1]) | (item[1:] != item[:-1]))])
    big = int(row_words[-1]) + 1
    upto = np.maximum.accumulate(pair * big + hi) - pair * big  # end of what was seen of the same pair
    first = np.concatenate([[True], (pair[1:] != pair[:-1]) | (lo[1:] > upto[:-1])])
    start = np.flatnonzero(first)
    end = upto[np.append(start[1:], len(first)) - 1]
    out = []
    for r, i, a, b, m in zip(own[start].tolist(), item[start].tolist(), lo[start].tolist(), end.tolist(), size[start].tolist(), strict=True):
        step = 4 * m + 16
        out += [(r, i, x, min(b, x + 2 * step)) for x in range(a, max(a + 1, b - step), step)]
    return np.array(out, np.int64)


def align(windows: list[np.ndarray], wanted: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment of each window with its item: (score, end in the window).  All pairs go through the same
    rows of the table at once; a gap along the window is a running maximum."""
    m, n = max(map(len, wanted)), max(map(len, windows))
    win, item = np.zeros((len(windows), n), np.uint64), np.ones((len(windows), m), np.uint64)
    for k, (w, i) in enumerate(zip(windows, wanted, strict=True)):
        win[k, :len(w)] = w | np.uint64(2)
        item[k, :len(i)] = i | np.uint64(2)
    steps = np.arange(n, dtype=np.int32)
    table = np.zeros((len(windows), n + 1), np.int32)
    best, end = np.zeros(len(windows), np.int32), np.zeros(len(windows), np.int64)
    for j in range(m):
        new = table[:, :-1] + np.where(win == item[:, j, None], 2, -1)
        np.maximum(new, table[:, 1:] - 1, out=new)
        np.maximum(new, 0, out=new)
        new = np.maximum.accumulate(new + steps, axis=1) - steps
        table[:, 1:] = new
        where = new.argmax(axis=1)
        top = new[np.arange(len(new)), where]
        better = top > best
        best[better], end[better] = top[better], where[better] + 1
    return best, end


def score_regions(found: np.ndarray, h: np.ndarray, items: Items, threshold: float, cells: int = 1 << 20) -> list[tuple]:
    """(row, item, score, first word, end word) of the regions whose score reaches the threshold."""
    out: list[tuple] = []
    size = np.diff(items.off)[found[:, 1]]
    order = np.lexsort((found[:, 3] - found[:, 2], size))
    k = 0
    while k < len(order):
        width = int((found[order[k:k + 256], 3] - found[order[k:k + 256], 2]).max())
        part = found[order[k:k + max(1, min(256, cells // max(1, width)))]]
        k += len(part)
        windows = [h[a:b] for _, _, a, b in part]
        wanted = [items.words[items.off[i]:items.off[i + 1]] for _, i, _, _ in part]
        best, end = align(windows, wanted)
        full = np.array([2 * len(w) for w in wanted])
        good = np.flatnonzero(best >= threshold * full)
        if not len(good):
            continue
        _, back = align([windows[g][:end[g]][::-1] for g in good], [wanted[g][::-1] for g in good])
        out += [(int(part[g, 0]), int(part[g, 1]), float(best[g] / full[g]), int(part[g, 2] + end[g] - b), int(part[g, 2] + end[g]))
                for g, b in zip(good, back, strict=True)]
    return out


def _count(shared) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, bits = shared.value
        counts = np.zeros(len(items.seed), np.int64)
        for batch in batches:
            data, off = bytes_of(batch.column(0))
            for i, j in slices(off):
                h, _, _, row = word_hashes(data[off[i]:off[j]], off[i:j + 1] - off[i])
                word, seed = find_seeds(h, row, items, bits)
                both = np.unique(row[word] * len(counts) + seed)
                counts += np.bincount(both % len(counts), minlength=len(counts))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(counts[some])], ["seed", "docs"])

    return run


def hits_of(column: pa.Array, items: Items, bits: np.ndarray, threshold: float) -> Iterator[tuple[int, int, float, int, int]]:
    """(row, item, score, start, end) of each item found in each text of a column; a span of code points."""
    data, off = bytes_of(column)
    for i, j in slices(off):
        part, own = data[off[i]:off[j]], off[i:j + 1] - off[i]
        h, starts, ends, row = word_hashes(part, own)
        word, seed = find_seeds(h, row, items, bits)
        if not len(word):
            continue
        found = regions(word, seed, row, np.searchsorted(row, np.arange(j - i + 1)), items, threshold)
        best: dict[tuple[int, int], tuple] = {}
        for r, item, score, a, b in score_regions(found, h, items, threshold):
            if score > best.get((r, item), (0.0,))[0]:
                best[r, item] = (score, a, b)
        for (r, item), (score, a, b) in sorted(best.items()):
            chars = (part[own[r]:own[r + 1]] & 0xC0) != 0x80
            yield i + r, item, score, int(chars[:starts[a] - own[r]].sum()), int(chars[:ends[b - 1] - own[r]].sum())


def _find(shared, threshold: float, id_type: pa.DataType) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, bits = shared.value
        for batch in batches:
            hits = list(hits_of(batch.column(1), items, bits, threshold))
            docs, found, score, start, end = zip(*hits, strict=True) if hits else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(docs, pa.int64())), pa.array([items.ids[k] for k in found], id_type),
                 pa.array(score, pa.float64()), pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                ["doc_id", "item_id", "score", "start", "end"])

    return run


def _keep_clean(shared, threshold: float, place: int) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, bits = shared.value
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            clean[[k for k, *_ in hits_of(batch.column(place).fill_null(""), items, bits, threshold)]] = False
            yield batch.filter(pa.array(clean))

    return run


def rare_seeds(docs: DataFrame, benchmark: DataFrame, short: int, threshold: float, block_seeds: int) -> Iterator[object]:
    """Broadcasts of the test items with their rare seeds, block by block."""
    spark = docs.sparkSession
    tests = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    seeds = tests.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first().n + 2  # at most this many: two a word
    blocks = -(-seeds // block_seeds)
    for k in range(blocks):
        own = tests if blocks == 1 else tests.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        items = Items.of([(r.item_id, r.text) for r in own.collect()], short)
        if not len(items.seed):
            continue
        shared = spark.sparkContext.broadcast((items, items.filter_bits()))
        counted = (texts(docs).select("text").mapInArrow(_count(shared), "seed bigint, docs bigint")
                   .groupBy("seed").agg(F.sum("docs").alias("docs")))
        counts = np.zeros(len(items.seed), np.int64)
        for r in counted.collect():  # a row for each seed of the block at most
            counts[r.seed] = r.docs
        rare = items.rare(counts, threshold)
        yield spark.sparkContext.broadcast((rare, rare.filter_bits()))


def contaminated(docs: DataFrame, benchmark: DataFrame, short: int = SHORT, threshold: float = THRESHOLD,
                 block_seeds: int = 1 << 20) -> DataFrame:
    """(doc_id, item_id, score, start, end): for every document and test item found in it the best passage, as a span of
    code points of the text."""
    from pyspark.sql.pandas.types import to_arrow_type

    rows = texts(docs)
    kind = {f.name: f.dataType for f in (*rows.schema, *benchmark.select("item_id").schema)}
    schema = f"doc_id {kind['doc_id'].simpleString()}, item_id {kind['item_id'].simpleString()}, score double, start bigint, end bigint"
    out: DataFrame | None = None
    for shared in rare_seeds(docs, benchmark, short, threshold, block_seeds):
        found = rows.mapInArrow(_find(shared, threshold, to_arrow_type(kind["item_id"])), schema)
        out = found if out is None else out.unionAll(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, short: int = SHORT, threshold: float = THRESHOLD,
                    block_seeds: int = 1 << 20) -> DataFrame:
    """The rows in whose text no test item is found, with all their columns as they are; nothing is shuffled."""
    out = docs
    for shared in rare_seeds(docs, benchmark, short, threshold, block_seeds):
        out = out.mapInArrow(lean(_keep_clean(shared, threshold, docs.columns.index("text"))), docs.schema)
    return out
