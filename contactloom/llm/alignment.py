"""Alignment of two tokenizers over the same bytes: groups, links, and how widespread each link is.

A is a byte-level BPE of the tokenizers library, which gets a space and the text; B is a sentencepiece model, which gets
the text and puts the space before it itself.  The spans that the libraries report (characters of A, bytes of B) are
coarse cuts: several tokens that share one character report that character, or nothing.  Such tokens are cut by their
own bytes, counted from the last cut that is sure.  Where an A and a B token both end, a group ends; an A and a B token
are linked where their bytes overlap.

Neither tokenizer joins anything across a space that follows a sign other than white space, nor a letter and a sign after
it (which the vocabulary of B is asked for, sign by sign).  So a text is taken apart there, each distinct unit is handed to the libraries once (a worker remembers units it has met, at most ``REMEMBERED``),
and a text's tokens are those of its units.  What is remembered decides the speed only.

Links are counted by document.  Consecutive documents of a task form a segment of at most ``SEGMENT`` bytes (a longer
text is one of its own), which asks for each of its id pairs once and says in how many of its documents it has it.
These questions are summed by pair over the corpus, compared with the highest of their A id, and answered by segment.

Null and empty text, and a text whose tokens of A or B do not join to a space and the text, have no tokens: zeros and an
empty digest.  Repeated rows count as documents of their own; a null id stays null.  Only doc_id and text are read, so
other columns may have any names.  Both files are read where tasks run, by paths of the installation (``Pair``)."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm.byte_bpe import Vocabulary, take_spans
from contactloom.llm.katz import planes, unplanes
from contactloom.llm.shared import SPACE, arrow_batches, byte_set, bytes_of, hash_spans, settle, slices

LETTER = byte_set(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
#: Bytes of text whose questions are asked together, bytes that one numpy step works on, units a worker remembers.
SEGMENT, STEP, REMEMBERED = 1 << 22, 1 << 19, 1 << 19


@dataclass(frozen=True)
class Pair:
    """Paths of the two tokenizer files; empty ones mean the public files of this installation."""

    byte_level: str = ""
    pieces: str = ""

    def paths(self) -> tuple[str, str]:
        import public_tokenizers

        return (self.byte_level or public_tokenizers.path("byte_bpe_50k.json"),
                self.pieces or public_tokenizers.path("piece_bpe_32k.model"))


def cuts(coarse_start: np.ndarray, coarse_end: np.ndarray, size: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """End of each token in its unit, in bytes.  A coarse end is sure where the token has a span and the next one starts
    no earlier than that; other tokens end as many bytes after the last sure cut as they have themselves."""
    n = len(size)
    if not n:
        return np.zeros(0, np.int64)
    same = np.zeros(n, bool)
    same[:-1] = unit[1:] == unit[:-1]
    sure = coarse_end > coarse_start
    sure[:-1] &= ~same[:-1] | (coarse_start[1:] >= coarse_end[:-1])
    first = np.ones(n, bool)
    first[1:] = ~same[:-1]
    upto = np.cumsum(size)
    before = upto - size
    place = np.arange(n)
    last = np.maximum.accumulate(np.where(sure, place, -1))
    begin = np.maximum.accumulate(np.where(first, place, 0))
    own = last >= begin  # a sure cut of the same unit stands at or before the token
    at = np.maximum(last, 0)
    return np.where(own, coarse_end[at] + upto - upto[at], upto - before[begin]).astype(np.int64)


class Tokenizers:
    """Both tokenizers, opened once in a worker, and the bytes of their tokens."""

    def __init__(self, pair: Pair):
        import sentencepiece
        import tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        left, right = pair.paths()
        self.a = tokenizers.Tokenizer.from_file(left)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=right)
        vocab = Vocabulary.read(left)
        raw = vocab.token_bytes.tobytes()
        self.a_bytes = [raw[i:j] for i, j in zip(vocab.token_off[:-1], vocab.token_off[1:], strict=True)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.tables = [(np.frombuffer(b"".join(t), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in t])])) for t in (self.a_bytes, self.b_bytes)]
        self.a_size, self.b_size = (np.diff(off) for _, off in self.tables)
        plain = [p for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size()))) if not (self.b.is_byte(i) or self.b.is_control(i))]
        mixed = set("".join(re.findall(r"[A-Za-z]([!-/:-@\[-`{-~])", "\n".join(plain))))
        #: Signs that no token of B has after a letter; A never has.  A text can be cut before them too.
        self.signs = byte_set(bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) not in mixed))

    def left(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, unit and end of the A tokens; spans are in characters."""
        texts = [u.decode() for u in units]
        told = self.a.encode_batch(texts, add_special_tokens=False)
        ids = [e.ids for e in told]
        n = np.array([len(x) for x in ids], np.int64)
        total = int(n.sum())
        spans = np.fromiter(chain.from_iterable(chain.from_iterable(e.offsets for e in told)), np.int64, 2 * total).reshape(-1, 2)
        unit = np.repeat(np.arange(len(units)), n)
        data, off = bytes_of(pa.array(units, pa.binary()))
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        byte = np.append(lead, len(data))  # byte of each character, units one after the other
        start = np.searchsorted(lead, off[:-1])
        start, end = (byte[start[unit] + spans[:, k]] - off[unit] for k in (0, 1))
        flat = np.fromiter(chain.from_iterable(ids), np.int64, total)
        return flat, unit, cuts(start, end, self.a_size[flat], unit)

    def right(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same of B; spans are in bytes of the text, which lacks the space that B puts before it.  A unit without a
        space of its own stands after a letter, which no token shares with it."""
        own = [u[:1] == b" " for u in units]
        told = [[(p.id, p.begin, p.end) for p in proto.pieces] for proto in self.b.encode(
            [(u[1:] if space else b"a" + u).decode() for u, space in zip(units, own, strict=True)], return_type="proto", num_threads=1)]
        told = [t if space else t[1:] for t, space in zip(told, own, strict=True)]
        n = np.array([len(x) for x in told], np.int64)
        flat = np.fromiter(chain.from_iterable(chain.from_iterable(told)), np.int64, 3 * int(n.sum())).reshape(-1, 3)
        unit = np.repeat(np.arange(len(units)), n)
        spaced = np.array(own, bool)[unit]
        first = np.zeros(len(flat), bool)
        first[(np.cumsum(n) - n)[n > 0]] = True
        first &= spaced
        start, end = (flat[:, k] + np.where(spaced, 1, -1) for k in (1, 2))
        # the space that B adds belongs to its first token, even where that is all it has
        return flat[:, 0], unit, cuts(np.where(first, 0, start), np.where(first & (flat[:, 2] == 0), 1, end), self.b_size[flat[:, 0]], unit)


def _digits(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Each number below ``most`` in decimal digits with a byte to spare, one after the other, and their offsets."""
    rows = [b"%d," % i for i in range(most)]
    return np.frombuffer(b"".join(rows), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in rows])])


class Units:
    """What the tokenizers say of the units met so far: numbers of tokens, groups and links, id pairs, group texts."""

    def __init__(self, pair: Pair, remembered: int = REMEMBERED):
        self.tokenizers, self.remembered = Tokenizers(pair), remembered
        self.digits = _digits(max(len(self.tokenizers.a_bytes), len(self.tokenizers.b_bytes)))
        self.hashes, self.place, self.met = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.counts = np.zeros((0, 4), np.int64)  # A tokens, B tokens, groups, links; all 0 where the bytes differ
        self.fits = np.zeros(0, bool)
        self.pairs, self.said = np.zeros(0, np.int64), np.zeros(0, np.uint8)
        self.said_off = np.zeros(1, np.int64)

    def forget(self) -> None:
        """Keep the units met most often, at most half of what may be remembered; each counts half from now on."""
        order = np.argsort(-self.met, kind="stable")[:self.remembered // 2]
        keep = np.sort(order[self.met[order] > 1])
        old, n_pairs = self.place[keep], self.counts[self.place[keep], 3]
        size = self.said_off[old + 1] - self.said_off[old]
        self.pairs, self.said = take_spans(self.pairs, self.pair_off[old], n_pairs), take_spans(self.said, self.said_off[old], size)
        self.said_off = np.concatenate([[0], np.cumsum(size)])
        self.counts, self.fits = self.counts[old], self.fits[old]
        self.hashes, self.place, self.met = self.hashes[keep], np.arange(len(keep)), self.met[keep] // 2

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of every unit; new ones are tokenized."""
        hashes, first, which = np.unique(hash_spans(data, starts, ends, fold=False), return_index=True, return_inverse=True)
        if len(self.hashes) > self.remembered:
            self.forget()
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(0, len(self.hashes) - 1))
        known = self.hashes[at] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        new = np.flatnonzero(~known)
        if len(new):
            base = len(self.counts)
            for k in range(0, len(new), 1 << 13):
                part = first[new[k:k + (1 << 13)]]
                self._learn([data[a:b].tobytes() for a, b in zip(starts[part], ends[part], strict=True)])
            order = np.searchsorted(self.hashes, hashes[new])
            self.place = np.insert(self.place, order, base + np.arange(len(new)))
            self.hashes = np.insert(self.hashes, order, hashes[new])
            self.met = np.insert(self.met, order, np.int32(0))
        at = np.searchsorted(self.hashes, hashes)
        self.met[at] += 1
        return self.place[at][which]

    def _learn(self, units: list[bytes]) -> None:
        t, m = self.tokenizers, len(units)
        (a, of_a, end_a), (b, of_b, end_b) = t.left(units), t.right(units)
        size = np.array([len(u) for u in units], np.int64)
        whole, off = np.frombuffer(b"".join(units), np.uint8), np.concatenate([[0], np.cumsum(size)])
        fits = np.ones(m, bool)
        for ids, unit, (raw, at) in ((a, of_a, t.tables[0]), (b, of_b, t.tables[1])):
            long = at[ids + 1] - at[ids]
            joined = np.bincount(unit, long, m).astype(np.int64)
            fits &= joined == size
            k = np.flatnonzero(joined == size)
            same = take_spans(raw, at[ids], long)[np.repeat((joined == size)[unit], long)] == take_spans(whole, off[k], size[k])
            fits[k] &= np.bincount(np.repeat(k, size[k]), ~same, m)[k] == 0
        a, of_a, end_a = a[fits[of_a]], of_a[fits[of_a]], end_a[fits[of_a]]
        b, of_b, end_b = b[fits[of_b]], of_b[fits[of_b]], end_b[fits[of_b]]
        base = np.cumsum(size) - size
        end_a, end_b = end_a + base[of_a], end_b + base[of_b]
        every = np.sort(np.concatenate([end_a, end_b]), kind="stable")
        again = np.zeros(len(every), bool)
        again[1:] = every[1:] == every[:-1]
        both, every = every[again], every[~again]  # each stretch between two ends lies in one A and one B token: a link
        link_a, link_b = np.searchsorted(end_a, every), np.searchsorted(end_b, every)
        unit = of_a[link_a] if len(every) else np.zeros(0, np.int64)
        groups = np.bincount(of_a[np.searchsorted(end_a, both)], minlength=m) if len(both) else np.zeros(m, np.int64)
        links = np.bincount(unit, minlength=m)
        self.counts = np.concatenate([self.counts, np.stack([np.bincount(of_a, minlength=m), np.bincount(of_b, minlength=m), groups, links], 1)])
        self.fits = np.concatenate([self.fits, fits])
        self.pairs = np.concatenate([self.pairs, a[link_a] << 32 | b[link_b]])
        text, off = self._texts(a, end_a, b, end_b, both)
        upto = np.concatenate([[0], off])[np.searchsorted(both, base + size, side="right")]
        self.said = np.concatenate([self.said, text])
        self.said_off = np.concatenate([self.said_off, self.said_off[-1] + upto])

    def _texts(self, a: np.ndarray, end_a: np.ndarray, b: np.ndarray, end_b: np.ndarray, both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each group as ``a1,a2|b1;`` one after the other, and the offset after each group."""
        group_a, group_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
        n_a, n_b = np.bincount(group_a, minlength=len(both)), np.bincount(group_b, minlength=len(both))
        ids = np.zeros(len(a) + len(b), np.int64)
        ids[np.arange(len(a)) + (np.cumsum(n_b) - n_b)[group_a]] = a
        ids[np.arange(len(b)) + np.cumsum(n_a)[group_b]] = b
        digits, off = self.digits
        size = off[ids + 1] - off[ids]
        text, upto = take_spans(digits, off[ids], size), np.cumsum(size)
        last_b = np.cumsum(n_a + n_b) - 1
        text[upto[last_b - n_b] - 1] = ord("|")
        text[upto[last_b] - 1] = ord(";")
        return text, upto[last_b]

    @property
    def pair_off(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.counts[:, 3])])


def units(data: np.ndarray, off: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the units of consecutive texts, each text with its space before it.  A unit starts at a space
    after a sign that is surely no white space, unless the space is the last byte of the text, and at one of ``signs``
    after a letter of ASCII."""
    space = data == 0x20
    start = np.zeros(len(data), bool)
    black = ~SPACE
    black[0x1C:0x20] = False  # white space to Unicode
    start[1:] = space[1:] & black[data[:-1]]
    wide = np.flatnonzero(start & (np.concatenate([[0], data[:-1]]) >= 0x80))
    if len(wide):  # the white space outside ASCII starts with C2, E1, E2 or E3
        doubt = (data[wide - 2] == 0xC2) | ((wide >= 3) & np.isin(data[wide - 3], [0xE1, 0xE2, 0xE3]))
        start[wide[doubt]] = False
    last = off[1:][off[1:] > off[:-1]] - 1
    start[last] = False
    start[1:] |= signs[data[1:]] & LETTER[data[:-1]]
    start[off[:-1][off[1:] > off[:-1]]] = True
    starts = np.flatnonzero(start)
    return starts, np.append(starts[1:], len(data))


class _Segment:
    """Documents of a segment so far: their figures, and the distinct id pairs of each with how often it is linked."""

    def __init__(self) -> None:
        self.size, self.ids, self.figures, self.digests = 0, [], [], []
        self.doc, self.pair, self.times, self.docs = [], [], [], 0

    def add(self, ids: pa.Array, data: np.ndarray, off: np.ndarray, known: Units) -> None:
        n = len(off) - 1
        starts, ends = units(data, off, known.tokenizers.signs)
        which = known.find(data, starts, ends)
        row = np.searchsorted(off, starts, side="right") - 1
        fits = np.bincount(row[~known.fits[which]], minlength=n) == 0
        which, row = which[fits[row]], row[fits[row]]
        figures = np.stack([np.bincount(row, known.counts[which, k], n) for k in range(4)], 1).astype(np.int64)
        first = np.searchsorted(row, np.arange(n + 1))
        size = known.said_off[which + 1] - known.said_off[which]
        text, upto = take_spans(known.said, known.said_off[which], size).tobytes(), np.concatenate([[0], np.cumsum(size)])
        self.digests += [hashlib.sha256(text[upto[i]:upto[j] - 1]).hexdigest() if j > i else "" for i, j in zip(first[:-1], first[1:], strict=True)]
        key, times = np.unique(row << 32 | which, return_counts=True)
        row, which = key >> 32, key & 0xFFFFFFFF
        n_pairs, pair_off = known.counts[which, 3], known.pair_off
        pair = take_spans(known.pairs, pair_off[which], n_pairs)
        row, times = np.repeat(row, n_pairs), np.repeat(times, n_pairs)
        order = np.lexsort((pair, row))
        pair, row, times = pair[order], row[order], times[order]
        new = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (row[1:] != row[:-1])])) if len(pair) else np.zeros(0, np.int64)
        self.doc.append(row[new].astype(np.int32) + self.docs)
        self.pair.append(pair[new])
        self.times.append((np.add.reduceat(times, new) if len(new) else times).astype(np.int32))
        self.ids.append(ids)
        self.figures.append(figures)
        self.docs += n
        self.size += len(data)

    def row(self, number: int) -> pa.RecordBatch:
        doc, pair, times = (np.concatenate(x) for x in (self.doc, self.pair, self.times))
        asked, at, having = np.unique(pair, return_inverse=True, return_counts=True)
        n = np.bincount(doc, minlength=self.docs).astype(np.int32)
        packed = [pa.compress(planes(x), "zstd", asbytes=True) for x in (np.concatenate(self.figures).reshape(-1), n, at.astype(np.int32), times)]
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([self.docs], pa.int32()), pa.array([len(at)], pa.int32()),
             _list_of(pa.chunked_array(self.ids).combine_chunks()), _list_of(pa.array(self.digests, pa.string())),
             *[pa.array([x], pa.binary()) for x in packed], _list_of(pa.array(asked)), _list_of(pa.array(having.astype(np.int32)))],
            ["segment", "docs", "entries", "ids", "digests", "figures", "n", "at", "times", "asked", "having"])


def _list_of(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


_known: dict[tuple[Pair, int], Units] = {}


def _segments(pair: Pair, segment: int, step: int, remembered: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (pair, remembered) not in _known:
            _known[pair, remembered] = Units(pair, remembered)
        known = _known[pair, remembered]
        number, open_one = TaskContext.get().partitionId() << 32, _Segment()
        for batch in batches:
            data, off = bytes_of(batch.column(1))
            for i, j in slices(off, step):
                size = int(off[j] - off[i])
                if open_one.docs and open_one.size + size > segment:
                    yield open_one.row(number)
                    number, open_one = number + 1, _Segment()
                open_one.add(batch.column(0).slice(i, j - i), data[off[i]:off[j]], off[i:j + 1] - off[i], known)
        if open_one.docs:
            yield open_one.row(number)

    return run


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document of each segment, from its figures and the answers to its questions."""
    for batch in batches:
        c = dict(zip(batch.schema.names, batch.columns, strict=True))
        for k in range(len(batch)):
            docs, entries = c["docs"][k].as_py(), c["entries"][k].as_py()
            read = lambda name, size, kind: unplanes(pa.decompress(c[name][k].as_buffer(), size, "zstd"), kind) if size else np.zeros(0, kind)  # noqa: B023, E731
            figures = read("figures", 32 * docs, np.int64).reshape(-1, 4) if docs else np.zeros((0, 4), np.int64)
            doc = np.repeat(np.arange(docs), read("n", 4 * docs, np.int32))
            at, times = read("at", 4 * entries, np.int32), read("times", 4 * entries, np.int32).astype(np.int64)
            answers = c["answers"].slice(k, 1).flatten()
            order = np.argsort(answers.field(0).to_numpy())
            n, best = answers.field(1).to_numpy()[order], answers.field(2).to_numpy(zero_copy_only=False)[order]
            total = np.zeros(docs, np.int64)
            np.add.at(total, doc, n[at] * times)
            highest = np.zeros(docs, np.int64)
            np.add.at(highest, doc, best[at].astype(np.int64) * times)
            yield pa.RecordBatch.from_arrays(
                [c["ids"].slice(k, 1).flatten(), *[pa.array(np.ascontiguousarray(figures[:, f])) for f in range(4)],
                 pa.array(highest), pa.array(total), c["digests"].slice(k, 1).flatten()], _COLUMNS)


_COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def aligned(docs: DataFrame, pair: Pair = Pair(), segment: int = SEGMENT, step: int = STEP, remembered: int = REMEMBERED) -> DataFrame:
    """Figures of every row's alignment; see the top of this module."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.when(F.length("text") > 0, F.concat(F.lit(" "), F.col("text"))).otherwise("").alias("text"))
    packed = rows.mapInArrow(_segments(pair, segment, step, remembered),
                             f"segment bigint, docs int, entries int, ids array<{kind}>, digests array<string>, figures binary, n binary, "
                             "at binary, times binary, asked array<bigint>, having array<int>")
    with arrow_batches(docs.sparkSession, "8m"):
        packed = settle(packed, "alignment-segments")
    asks = packed.select("segment", F.inline(F.arrays_zip(F.col("asked").alias("pair"), F.col("having").alias("docs"))))
    counts = asks.groupBy("pair").agg(F.sum("docs").alias("n")).withColumn("a", F.shiftright("pair", 32))
    counts = settle(counts, "alignment-counts")
    best = counts.groupBy("a").agg(F.max("n").alias("most"))
    told = counts.join(best, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    answers = asks.select("segment", "pair").join(told, "pair").groupBy("segment").agg(F.collect_list(F.struct("pair", "n", "best")).alias("answers"))
    empty = F.array().cast("array<struct<pair:bigint,n:bigint,best:boolean>>")
    joined = packed.drop("asked", "having").join(answers, "segment", "left").withColumn("answers", F.coalesce("answers", empty))
    schema = f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    return joined.mapInArrow(_answered, schema)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(spark.read.parquet(f"{sf_dir}/documents.parquet"))
