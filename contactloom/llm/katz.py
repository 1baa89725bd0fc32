"""Language-model scores by Katz backoff over bigrams.

Words ([^ASCII space]+, A-Z as a-z) and one end per document are the tokens; every word of the training documents keeps its
own count and its own pairs, however many words there are.  With Good-Turing discounts d:

    P(w | h)  = d(c(h,w)) c(h,w) / c(h)             if the pair was seen
              = alpha(h) P(w)                       otherwise, alpha(h) making the sum over all words 1
    P(w)      = d(c(w)) c(w) / N; the mass the discounts free goes in equal parts to the unseen words, as many as
                Chao's estimate n1^2 / (2 n2) says
    alpha(h)  = 1 for a word h that was never seen

Discounts apply to counts up to 5; where counts of counts give none between 0 and 1, or where a context (or the corpus) has no
count that small, half a count is taken off.  So something is always freed and no probability is 0.

Codes: the ``vocabulary`` most frequent words, the end and the start have short codes, sent to all tasks; the code of
any other word is its hash of 64 bits.  That saves bytes and lookups and changes no result.

Counting: tasks send sorted hashes and counts by range of hash (words), and pairs by range of the follower, where its count is
looked up in the word table, or by context where the follower has a short code; then pairs meet by context.  A bucket is
merged as it streams by.  Both tables are written partitioned by bucket.  Scoring: log10 P(w | h) is log10 P(w) plus what the
pair adds, which is log10 alpha(h) if it was not seen; so words and pairs are asked apart and added up.  Tasks send, for
each bucket, which pairs and words with long codes their documents hold; these meet the bucket's part of the table in sorted
order, buckets with many pairs in several copies; sums come back by row.  Equal hashes of 64 bits would merge two words.
The distinct followers of one word are evaluated in one task, 32 bytes each.

Null and empty texts have the one token end; rows repeat as they are; null ids stay null (and count as the empty text for
the split).  Without training text every score is the base score.  Only doc_id and text are read."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm.shared import arrow_batches, bytes_of, crc_of_id, hash_spans, lean, mix, new_folder, settle, slices, texts, words

END_HASH = np.uint64(2**64 - 1)
ROW_BITS, SLICE_BYTES, SMALL = 14, 1 << 21, 5
MAX_VOCABULARY = 1 << 17
#: Codes from here on are hashes; the hash of a word is never below.
LONG = np.uint64(1 << 18)
BATCH = "8m"


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every token: the words of each text, then its end."""
    starts, ends, row = words(data, off)
    h = hash_spans(data, starts, ends)
    h[h < LONG] += LONG
    n = len(off) - 1
    per_row = np.bincount(row, minlength=n)
    place = np.arange(len(h)) + row
    out = np.full(len(h) + n, END_HASH)
    out[place] = h
    return out, np.repeat(np.arange(n), per_row + 1)


def batches_of(batch: pa.RecordBatch, text: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a batch with their tokens: (first row, end row, hashes, rows)."""
    data, off = bytes_of(batch.column(text))
    for a, b in slices(off, SLICE_BYTES):
        for i in range(a, b, 1 << ROW_BITS):
            j = min(b, i + (1 << ROW_BITS))
            yield i, j, *tokens(data[off[i]:off[j]], off[i:j + 1] - off[i])


def planes(values: np.ndarray) -> bytes:
    """Bytes of an array, all first bytes first: sorted or small numbers then compress well."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def unplanes(raw: bytes | pa.Buffer, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def pack(values: np.ndarray) -> bytes:
    """The bytes of an array, small ones as few: codes are numbered by frequency, so most of their high bytes are 0."""
    raw = planes(values)
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def unpack(value: bytes | pa.Buffer, kind: type) -> np.ndarray:
    value = pa.py_buffer(value)
    size = int.from_bytes(value[:8], "little")
    return unplanes(pa.decompress(value[8:], decompressed_size=size, codec="zstd"), kind) if size else np.zeros(0, kind)


def merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Sum of counts, the last array, by the keys, which are all arrays before; sorted by them."""
    *keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    if not len(counts):
        return *keys, counts
    order = np.lexsort(keys[::-1])
    keys, counts = [k[order] for k in keys], counts[order]
    new = np.ones(len(counts), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    first = np.flatnonzero(new)
    return *(k[first] for k in keys), np.add.reduceat(counts, first)


def packed(bucket: np.ndarray, arrays: Sequence[np.ndarray], names: Sequence[str]) -> pa.RecordBatch:
    """One row for each bucket with its part of the arrays, in their order."""
    order = np.argsort(bucket, kind="stable")
    some, cut = np.unique(bucket[order], return_index=True)
    ends = [*cut[1:].tolist(), len(bucket)]
    columns = [[pack(x[i:j]) for i, j in zip(cut.tolist(), ends, strict=False)] for x in (y[order] for y in arrays)]
    return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *(pa.array(c, pa.binary()) for c in columns)], ["bucket", *names])


class Tally:
    """Counts by one key or several, merged now and then."""

    def __init__(self, keys: int = 1, most: int = 1 << 20):
        self.keys, self.most = keys, most
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, *arrays: np.ndarray) -> bool:
        """Add keys and their counts; tells whether it is time to give."""
        self.parts.append((*arrays[:-1], arrays[-1].astype(np.int64)))
        self.size += len(arrays[-1])
        if self.size > self.most:
            self.parts = [merged(self.parts)]
            self.size = len(self.parts[0][0])
            return self.size > self.most // 2
        return False

    def give(self) -> tuple[np.ndarray, ...]:
        out = merged(self.parts) if self.parts else (*[np.zeros(0, np.uint64)] * self.keys, np.zeros(0, np.int64))
        self.parts, self.size = [], 0
        return out


COUNTS = "bucket int, keys binary, counts binary"
PAIR_COUNTS = "bucket int, keys binary, follows binary, of binary, counts binary"
NUMBERS = ", types bigint, total bigint, of_counts array<bigint>"
KINDS = {"keys": np.uint64, "follows": np.uint64, "of": np.int64, "counts": np.int64}


def merge_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the rows of each bucket, which come one after the other."""
    tally, now, names = Tally(most=1 << 20), None, []

    def close() -> pa.RecordBatch:
        arrays = tally.give()
        counts = arrays[-1]
        of = np.bincount(np.minimum(counts, SMALL + 2), minlength=SMALL + 3)[1:SMALL + 2]
        return pa.RecordBatch.from_arrays(
            [pa.array([now], pa.int32()), *(pa.array([pack(x)], pa.binary()) for x in arrays),
             pa.array([len(counts)], pa.int64()), pa.array([int(counts.sum())], pa.int64()), pa.array([of.tolist()], pa.list_(pa.int64()))],
            ["bucket", *names, "types", "total", "of_counts"])

    for batch in batches:
        names = batch.schema.names[1:]
        for r, bucket in enumerate(batch.column(0).to_pylist()):
            if now is not None and bucket != now:
                yield close()
            now = bucket
            tally.add(*(unpack(batch.column(n)[r].as_buffer(), KINDS[n]) for n in names))
    if now is not None:
        yield close()


def table_of(parts: DataFrame, label: str) -> DataFrame:
    """Write the merged counts as a table partitioned by bucket."""
    whole = (parts.repartition("bucket").sortWithinPartitions("bucket")
             .mapInArrow(lean(merge_buckets), parts.schema.simpleString()[len("struct<"):-1].replace(":", " ") + NUMBERS))
    folder = new_folder(parts.sparkSession, label)
    whole.write.partitionBy("bucket").parquet(folder)
    return parts.sparkSession.read.schema(whole.schema).parquet(folder)


def totals(table: DataFrame) -> tuple[int, int, np.ndarray]:
    """Types, tokens, and how many types have count 1, 2, ... SMALL + 1."""
    of = [F.coalesce(F.sum(F.col("of_counts")[k]), F.lit(0)) for k in range(SMALL + 1)]
    r = table.agg(F.coalesce(F.sum("types"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0)), *of).first()
    return int(r[0]), int(r[1]), np.array(r[2:], np.float64)


def discounts(of: np.ndarray) -> np.ndarray:
    """Factor for each count up to SMALL, Katz's form of Good-Turing; index 0 and those above SMALL are 1."""
    out = np.ones(SMALL + 2)
    n = np.concatenate([[0], of])
    tail = (SMALL + 1) * n[SMALL + 1] / n[1] if n[1] else 1.0
    for r in range(1, SMALL + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail) if n[r] and tail != 1 else 0.0
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


@dataclass
class Unigrams:
    """What is known of single tokens.  Short codes: the words of ``head`` by frequency, then end, start."""

    head: np.ndarray
    code: np.ndarray
    head_counts: np.ndarray  # by code
    end_count: int
    factor: np.ndarray
    tokens: int
    types: int
    freed: float
    p_unseen: float

    @property
    def end(self) -> int:
        return len(self.head)

    @property
    def start(self) -> int:
        return len(self.head) + 1

    def codes(self, h: np.ndarray) -> np.ndarray:
        out = h.copy()
        if len(self.head):
            at = np.minimum(np.searchsorted(self.head, h), len(self.head) - 1)
            out = np.where(self.head[at] == h, self.code[at], h)
        out[h == END_HASH] = self.end
        return out

    def counts(self, short: np.ndarray) -> np.ndarray:
        """Counts of tokens by short code."""
        return np.append(self.head_counts, self.end_count)[short.astype(np.int64)]

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.tokens + 0.1 * (self.types + 1)))

    def word(self, counts: np.ndarray) -> np.ndarray:
        """P(w) by the count of the word."""
        seen = kept(self.factor, counts) / max(1, self.tokens)
        return np.where(counts > 0, seen, self.p_unseen)

    def pairs(self, h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct codes of some tokens, sorted, and for each token the places of the code before it and of its own."""
        found, own = np.unique(h, return_inverse=True)
        codes = np.append(self.codes(found), np.uint64(self.start))
        order = np.argsort(codes)
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        own = rank[own]
        before = np.empty_like(own)
        before[1:] = own[:-1]
        before[np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else []] = rank[-1]
        return codes[order], before.astype(np.uint64), own.astype(np.uint64)


def kept(factor: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """What discounts leave of counts; half a count is taken off all where the factors take nothing off any."""
    return np.where(factor[SMALL + 1] < 0, counts - 0.5, factor[np.minimum(counts, SMALL + 1)] * counts)


def context_bucket(code: np.ndarray, bits: int) -> np.ndarray:
    return (mix(code) >> np.uint64(64 - bits)).astype(np.int64)


def count_words(docs: DataFrame, bits: int) -> DataFrame:
    """Counts of all tokens of (text, train), over the rows to train on."""
    def give(tally: Tally) -> pa.RecordBatch:
        keys, counts = tally.give()
        return packed((keys >> np.uint64(64 - bits)).astype(np.int64), [keys, counts], ["keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            train = batch.column(1).to_numpy(zero_copy_only=False)
            for i, j, h, row in batches_of(batch, 0):
                if tally.add(*np.unique(h[train[i:j][row]], return_counts=True)):
                    yield give(tally)
        yield give(tally)

    return table_of(docs.select("text", "train").mapInArrow(lean(run), COUNTS), "katz-words")


def frequent(table: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent words, as many as have a count for which no more than ``most`` words are as frequent.

    The driver gets a histogram of counts with less than 4,000 classes, and then those words."""
    def classes(counts: np.ndarray) -> np.ndarray:
        fine = np.floor(np.log2(np.maximum(counts, 1)) * 64).astype(np.int64)
        return np.where(counts < 1024, counts, 1024 - 640 + fine)

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1024 - 640 + 64 * 64, np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                total += np.bincount(classes(unpack(raw, np.int64)), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["class", "n"])

    rows = table.select("counts").mapInArrow(histogram, "class bigint, n bigint").groupBy("class").agg(F.sum("n").alias("n")).collect()
    least, seen = 1, 0
    for r in sorted(rows, key=lambda r: -r["class"]):
        seen += r.n
        if seen > most:
            least = r["class"] + 1
            break

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw_keys, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys, counts = unpack(raw_keys, np.uint64), unpack(raw, np.int64)
                ok = (classes(counts) >= least) & (keys != END_HASH)
                yield pa.RecordBatch.from_arrays([pa.array([keys[ok].tobytes()], pa.binary()), pa.array([counts[ok].tobytes()], pa.binary())],
                                                 ["keys", "counts"])

    found = table.select("keys", "counts").mapInArrow(take, "keys binary, counts binary").collect()
    keys = np.frombuffer(b"".join(r.keys for r in found), np.uint64)
    counts = np.frombuffer(b"".join(r.counts for r in found), np.int64)
    order = np.argsort(keys)
    return keys[order], counts[order]


def unigrams(table: DataFrame, train_docs: int, most: int) -> Unigrams:
    types, n, of = totals(table)
    factor = discounts(of)
    small = np.arange(1, SMALL + 1)
    freed = float(np.sum(of[:SMALL] * small * (1 - factor[small])))
    if not of[:SMALL].any():  # no count is small: half a count off each
        factor[SMALL + 1], freed = -1.0, types / 2
    freed = freed / n if n else 1.0
    unseen = max(1.0, of[0] ** 2 / (2 * of[1]) if of[1] else of[0] * (of[0] - 1) / 2)
    head, counts = frequent(table, most)
    order = np.argsort(-counts, kind="stable")
    code = np.empty(len(head), np.uint64)
    code[order] = np.arange(len(head))
    return Unigrams(head, code, counts[order], train_docs, factor, n, types, freed, freed / unseen)


def count_pairs(docs: DataFrame, uni: Unigrams, word_table: DataFrame, word_bits: int, bits: int) -> DataFrame:
    """Counts of all pairs of (text, train), over the rows to train on, by context, with the count of a follower that has
    a long code."""
    shared = docs.sparkSession.sparkContext.broadcast(uni)

    def give(tally: Tally) -> pa.RecordBatch:
        context, follows, counts = tally.give()
        bucket = np.where(follows < LONG, (1 << word_bits) + context_bucket(context, bits),
                          (follows >> np.uint64(64 - word_bits)).astype(np.int64))
        return packed(bucket, [context, follows, counts], ["keys", "follows", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(2, 1 << 19)
        for batch in batches:
            train = batch.column(1).to_numpy(zero_copy_only=False)
            for i, j, h, row in batches_of(batch, 0):
                codes, before, own = shared.value.pairs(h, row)
                width = np.uint64(len(codes).bit_length())
                both, n = np.unique((before << width | own)[train[i:j][row]], return_counts=True)
                if tally.add(codes[(both >> width).astype(np.int64)], codes[(both & (np.uint64(1) << width) - np.uint64(1)).astype(np.int64)], n):
                    yield give(tally)
        yield give(tally)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs with the counts of their followers; rows of the word table come first in their bucket."""
        tally, now, table = Tally(2, 1 << 20), None, None

        def close() -> pa.RecordBatch:
            context, follows, counts = tally.give()
            of = np.zeros(len(follows), np.int64)
            if now < 1 << word_bits and len(follows):
                of = table[1][np.searchsorted(table[0], follows)]
            return packed(context_bucket(context, bits), [context, follows, of, counts], ["keys", "follows", "of", "counts"])

        for batch in batches:
            for r, bucket in enumerate(batch.column(0).to_pylist()):
                if now is not None and bucket != now:
                    yield close()
                    table = None
                now = bucket
                keys, counts = (unpack(batch.column(n)[r].as_buffer(), KINDS[n]) for n in ("keys", "counts"))
                if batch.column("follows")[r].as_py() is None:
                    table = keys, counts
                else:
                    tally.add(keys, unpack(batch.column("follows")[r].as_buffer(), np.uint64), counts)
        if now is not None:
            yield close()

    parts = docs.select("text", "train").mapInArrow(lean(run), "bucket int, keys binary, follows binary, counts binary")
    words = word_table.select("bucket", "keys", F.lit(None).cast("binary").alias("follows"), "counts")
    met = (words.unionByName(parts).repartition("bucket")
           .sortWithinPartitions("bucket", F.col("follows").isNotNull()).mapInArrow(lean(counted), PAIR_COUNTS))
    return table_of(met, "katz-pairs")


class Pairs:
    """One bucket of the pair table, ready for evaluation."""

    def __init__(self, context: np.ndarray, follows: np.ndarray, of: np.ndarray, counts: np.ndarray, factor: np.ndarray, uni: Unigrams):
        first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(context) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(first, len(context)))
        c = counts.astype(np.float64)
        short = follows < LONG
        p = uni.word(np.where(short, uni.counts(np.where(short, follows, np.uint64(0))), of))
        own = lambda x: np.add.reduceat(x, first) if len(first) else x
        total, known = own(c), own(p)
        d = factor[np.minimum(counts, SMALL + 1)]
        whole = np.repeat(own(np.where(d < 1, 1.0, 0.0)) == 0, sizes)
        d = np.where(whole, (c - 0.5) / c, d)
        seen = d * c / np.repeat(total, sizes)
        self.contexts, self.added = context[first], np.log10(seen) - np.log10(p)
        # what no word of the corpus has is outside every context, so the rest is never less
        self.log_alpha = np.log10((1 - own(seen)) / np.maximum(1 - known, uni.freed))
        self.follows, at = np.unique(follows, return_inverse=True)
        self.places = np.repeat(np.arange(len(first)), sizes) * len(self.follows) + at

    def add(self, context: np.ndarray, follows: np.ndarray) -> np.ndarray:
        """What each pair adds to log10 P of its follower: its own value if seen, else the backoff weight of its context."""
        if not len(self.contexts):
            return np.zeros(len(context))
        h = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
        w = np.minimum(np.searchsorted(self.follows, follows), len(self.follows) - 1)
        known = self.contexts[h] == context
        place = h * len(self.follows) + w
        at = np.minimum(np.searchsorted(self.places, place), len(self.places) - 1)
        seen = known & (self.follows[w] == follows) & (self.places[at] == place)
        return np.where(seen, self.added[at], np.where(known, self.log_alpha[h], 0.0))


REQUESTS = "bucket int, salt int, kind int, base bigint, keys binary, follows binary, of binary, n binary, doc_id array<{id}>"
PARTS = "base bigint, doc_id array<{id}>, row binary, n_known binary, base_score binary, score binary"
SCORES = "doc_id {id}, n_tokens bigint, n_known bigint, base_score double, score double"


def by_bucket(bucket: np.ndarray, keys: np.ndarray, follows: np.ndarray | None, row: np.ndarray, n: np.ndarray, salts: np.ndarray,
              base: int) -> Iterator[tuple]:
    """Request rows of a slice: distinct keys of each bucket with the rows that have them."""
    order = np.argsort(bucket, kind="stable")
    bucket, keys, row, n = bucket[order], keys[order], row[order].astype(np.uint16), n[order].astype(np.uint32)
    follows = follows[order] if follows is not None else None
    some, cut = np.unique(bucket, return_index=True)
    for b, i, j in zip(some.tolist(), cut.tolist(), [*cut[1:].tolist(), len(keys)], strict=False):
        yield (b, base % int(salts[b]), 1, base, pack(keys[i:j]), pack(follows[i:j]) if follows is not None else None,
               pack(row[i:j]), pack(n[i:j]))


def requests(docs: DataFrame, uni: Unigrams, word_bits: int, pair_bits: int, salts: np.ndarray) -> DataFrame:
    """What each slice of documents asks of the buckets: words with long codes of the word table (its buckets come first),
    pairs of the pair table; and one row with the ids of its documents and their numbers of tokens.  ``base`` names the
    slice; ``of`` has the row of each key."""
    shared = docs.sparkSession.sparkContext.broadcast((uni, salts))
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uni, salts = shared.value
        for batch in batches:
            uid = batch.column(2).to_numpy()
            for i, j, h, row in batches_of(batch, 1):
                base, count = int(uid[i]), np.bincount(row, minlength=j - i)
                codes, before, own = uni.pairs(h, row)
                width, deep = np.uint64(len(codes).bit_length()), np.uint64((j - i).bit_length())
                part = lambda x, at, size: ((x >> at) & ((np.uint64(1) << size) - np.uint64(1))).astype(np.int64)
                rows = row.astype(np.uint64)
                rare = codes[own.astype(np.int64)] >= LONG
                both, n = np.unique((own << deep | rows)[rare], return_counts=True)
                asked = codes[part(both, deep, width)]
                found = [*by_bucket((asked >> np.uint64(64 - word_bits)).astype(np.int64), asked, None, part(both, np.uint64(0), deep), n, salts, base)]
                both, n = np.unique((before << width | own) << deep | rows, return_counts=True)
                context, follows = codes[part(both, width + deep, width)], codes[part(both, deep, width)]
                found += by_bucket((1 << word_bits) + context_bucket(context, pair_bits), context, follows, part(both, np.uint64(0), deep), n, salts, base)
                found.append((base % len(salts), 0, 2, base, None, None, None, pack(count)))
                kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
                ids = pa.ListArray.from_arrays(pa.array([*[0] * len(found), j - i], pa.int32()), batch.column(0).slice(i, j - i))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)), ids], NAMES)

    return docs.select("doc_id", "text", "uid").mapInArrow(lean(run), REQUESTS.format(id=kind.simpleString()))


NAMES = ["bucket", "salt", "kind", "base", "keys", "follows", "of", "n", "doc_id"]


def answer(shared, word_buckets: int) -> Callable:
    """Evaluate requests, which follow the table rows of their bucket: sums for each row of the slice that asks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uni: Unigrams = shared.value[0]
        factor = shared.value[1]
        now, table = None, None
        for batch in batches:
            bucket, salt, kind, base = (batch.column(k).to_pylist() for k in range(4))
            of, sums = [], []

            def take(r: int, name: str, kind: type, batch: pa.RecordBatch = batch) -> np.ndarray:
                value = batch.column(name)[r]
                return unpack(value.as_buffer(), kind) if value.is_valid else np.zeros(0, kind)

            for r in range(batch.num_rows):
                if kind[r] == 2:
                    of.append(r)
                    sums.append((None, batch.column("n")[r].as_py(), None, None))
                    continue
                if (bucket[r], salt[r]) != now or kind[r] == 0:
                    now = bucket[r], salt[r]
                    held = [take(r, name, k) if kind[r] == 0 else np.zeros(0, k)
                            for name, k in (("keys", np.uint64), ("follows", np.uint64), ("of", np.int64), ("n", np.int64))]
                    table = (held[0], held[3]) if bucket[r] < word_buckets else Pairs(*held, factor, uni)
                if kind[r] == 0:
                    continue
                asked, row, n = take(r, "keys", np.uint64), take(r, "of", np.uint16).astype(np.int64), take(r, "n", np.uint32).astype(np.float64)
                if bucket[r] < word_buckets:
                    keys, counts = table
                    at = np.minimum(np.searchsorted(keys, asked), max(0, len(keys) - 1))
                    c = np.where(keys[at] == asked, counts[at], 0) if len(keys) else np.zeros(len(asked), np.int64)
                    own_base, own_score, known = uni.base(c), np.log10(uni.word(c)), c > 0
                else:
                    follows = take(r, "follows", np.uint64)
                    short = follows < LONG  # of the others, the word table tells
                    c = uni.counts(np.where(short, follows, np.uint64(0)))
                    own_base = np.where(short, uni.base(c), 0.0)
                    own_score = table.add(asked, follows) + np.where(short, np.log10(uni.word(c)), 0.0)
                    known = short & (c > 0)
                some = np.flatnonzero(np.bincount(row))
                own_known, own_base, own_score = (np.bincount(row, x * n)[some] for x in (known, own_base, own_score))
                of.append(r)
                sums.append((some.astype(np.uint16).tobytes(), own_known.astype(np.uint32).tobytes(), own_base.tobytes(), own_score.tobytes()))
            rows = pa.array(of, pa.int64())
            cols = list(zip(*sums, strict=True)) if sums else [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column("base").take(rows), batch.column("doc_id").take(rows), *(pa.array(c, pa.binary()) for c in cols)],
                                             ["base", "doc_id", "row", "n_known", "base_score", "score"])

    return run


def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores of the documents of each slice; the row with their ids comes first, then the sums of all buckets."""
    ids, tokens, known, base_score, score = None, None, None, None, None

    def close() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([ids, *(pa.array(x) for x in (tokens, known, base_score, score))],
                                          ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    for batch in batches:
        for r in range(batch.num_rows):
            if batch.column(2)[r].as_py() is None:
                if ids is not None:
                    yield close()
                ids, tokens = batch.column(1)[r].values, unpack(batch.column(3)[r].as_buffer(), np.int64)
                known, base_score, score = (np.zeros(len(tokens), kind) for kind in (np.int64, np.float64, np.float64))
            else:
                row = np.frombuffer(batch.column(2)[r].as_buffer(), np.uint16)
                known[row] += np.frombuffer(batch.column(3)[r].as_buffer(), np.uint32)
                base_score[row] += np.frombuffer(batch.column(4)[r].as_buffer(), np.float64)
                score[row] += np.frombuffer(batch.column(5)[r].as_buffer(), np.float64)
    if ids is not None:
        yield close()


@dataclass
class KatzModel:
    """Unigrams, the two tables, and what scoring needs to know of them."""

    uni: Unigrams
    word_table: DataFrame
    pair_table: DataFrame
    factor: np.ndarray
    word_bits: int
    pair_bits: int

    @classmethod
    def train(cls, docs: DataFrame, vocabulary: int = MAX_VOCABULARY) -> KatzModel:
        """From (text, train): learn from the rows with train; so many frequent words get short codes."""
        if not 0 < vocabulary <= MAX_VOCABULARY:
            raise ValueError(f"vocabulary has to be from 1 to {MAX_VOCABULARY}")
        spark = docs.sparkSession
        bits = max(4, min(12, int(spark.conf.get("spark.sql.shuffle.partitions")).bit_length()))
        train_docs = docs.filter("train").count()
        with arrow_batches(spark, BATCH):
            word_table = count_words(docs, bits)
            uni = unigrams(word_table, train_docs, vocabulary)
            pair_table = count_pairs(docs, uni, word_table, bits, bits)
        return cls(uni, word_table, pair_table, discounts(totals(pair_table)[2]), bits, bits)

    def salts(self) -> np.ndarray:
        """Copies of each bucket: one for each half of an average bucket's tokens, in whole numbers."""
        out = []
        for table, n in ((self.word_table, 1 << self.word_bits), (self.pair_table, 1 << self.pair_bits)):
            total = np.zeros(n)
            for r in table.select("bucket", "total").collect():
                total[r.bucket] = r.total
            out.append(np.maximum(1, total / max(1.0, 2 * total.mean())).astype(np.int64))
        return np.concatenate(out)

    def score(self, docs: DataFrame) -> DataFrame:
        """(doc_id, n_tokens, n_known, base_score, score) of every row of (doc_id, text)."""
        spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType
        salts = self.salts()
        asked = requests(docs.withColumn("uid", F.monotonically_increasing_id()), self.uni, self.word_bits, self.pair_bits, salts)
        first = F.when(F.col("pairs"), 1 << self.word_bits).otherwise(0)
        copies = spark.createDataFrame([(b, int(n)) for b, n in enumerate(salts)], "bucket int, copies int")
        none = F.lit(None).cast("binary")
        tables = (self.word_table.select("bucket", "keys", none.alias("follows"), none.alias("of"), "counts", F.lit(False).alias("pairs"))
                  .unionByName(self.pair_table.select("bucket", "keys", "follows", "of", "counts", F.lit(True).alias("pairs")))
                  .withColumn("bucket", F.col("bucket") + first).join(F.broadcast(copies), "bucket")
                  .select("bucket", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("salt"), F.lit(0).alias("kind"),
                          F.lit(None).cast("bigint").alias("base"), "keys", "follows", "of", F.col("counts").alias("n"),
                          F.lit(None).cast(asked.schema["doc_id"].dataType).alias("doc_id")))
        shared = spark.sparkContext.broadcast((self.uni, self.factor))
        parts = (tables.unionByName(asked).repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", "kind")
                 .mapInArrow(lean(answer(shared, 1 << self.word_bits)), PARTS.format(id=kind.simpleString())))
        with arrow_batches(spark, BATCH):
            out = settle(parts.repartition("base").sortWithinPartitions("base", F.col("row").asc_nulls_first())
                         .mapInArrow(add_up, SCORES.format(id=kind.simpleString())), "katz-scores")
        score = F.col("score") if self.uni.tokens else F.col("base_score")
        return out.select("doc_id", "n_tokens", "n_known", "base_score", score.alias("score"))


def op9_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumn("train", crc_of_id() % 10 != 0)
    model = KatzModel.train(docs)
    return model.score(docs).select(
        "doc_id", (crc_of_id() % 10 == 0).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.uni.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
