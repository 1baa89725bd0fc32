"""Byte-level BPE by a minimal acyclic transducer.

The frequent pieces of the corpus are compiled, with the ids each one encodes to, into an automaton in which equal
suffixes share their states; the way through it adds up to the number of the piece, which points to its ids.  The
automaton is one file, handed to every executor and memory-mapped there.  A slice of text is cut into pieces with
array operations, its distinct pieces walk the automaton side by side, and those it lacks are merged exactly.

Frequent means: at least ``share`` of all pieces of some task, and then the ``size`` most frequent over the corpus.
What the lexicon holds decides the speed only, never the ids.

``vocabulary`` is the path of a byte-level BPE tokenizer file (JSON); it is read on the driver.  Null text counts as
empty and gives no ids; decoding null ids gives empty text.  Rows repeat as they are; a null id stays null.  Only
doc_id and text are read, so other columns may have any names.  A text of any length is one row of one task."""

from __future__ import annotations

import json
import mmap
import sys
import unicodedata
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm.shared import bytes_of, hash_spans, lean, new_folder, slices, texts

LETTER, NUMBER, WHITE, OTHER = 1, 2, 3, 0
#: Bytes of text that one numpy step works on.
STEP = 1 << 19
#: White space of the Unicode standard.
WHITE_SPACE = [(0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
               (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]
#: Letters and numbers that Unicode 16 added to 15.1, which Python's own table has.
LETTERS_16 = [(0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
              (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
              (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
              (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
              (0x1E5F0, 0x1E5F0)]
NUMBERS_16 = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
              (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]
#: What follows an apostrophe in an English contraction.
CONTRACTIONS = [b"s", b"t", b"d", b"m", b"re", b"ve", b"ll"]

_classes: np.ndarray | None = None


def char_classes() -> np.ndarray:
    """Class of every code point, made once in a process."""
    global _classes
    if _classes is None:
        kind = {"L": LETTER, "N": NUMBER}
        out = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)),
                          np.uint8, sys.maxunicode + 1)
        for ranges, value in ((LETTERS_16, LETTER), (NUMBERS_16, NUMBER), (WHITE_SPACE, WHITE)):
            for a, b in ranges:
                out[a:b + 1] = value
        _classes = out
    return _classes


def pieces(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Byte positions at which a piece starts, in consecutive texts: a word with the space before it, a number, a run
    of other signs, a contraction, or white space up to the last sign before the next piece."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(lead):
        return lead
    code = data[lead].astype(np.int32)
    wide = np.flatnonzero(code >= 0x80)
    if len(wide):
        at, first = lead[wide], code[wide]
        size = 2 + (first >= 0xE0) + (first >= 0xF0)
        value = first & np.array([0, 0, 0x1F, 0x0F, 0x07], np.int32)[size]
        for k in range(1, 4):
            more = size > k
            value[more] = (value[more] << 6) | (data[at[more] + k] & 0x3F)
        code[wide] = value
    kind = char_classes()[code]
    n = len(lead)
    is_start = np.zeros(n + 1, bool)  # of a text
    is_start[np.searchsorted(lead, off[:-1])] = True
    is_start[n] = True
    white = kind == WHITE
    plain_space = code == 0x20
    before_white = np.zeros(n, bool)
    before_white[1:] = white[:-1]
    before_space = np.zeros(n, bool)
    before_space[1:] = plain_space[:-1]
    changes = np.ones(n, bool)
    changes[1:] = kind[1:] != kind[:-1]
    text_ends = is_start[1:]
    next_black = np.zeros(n, bool)
    next_black[:-1] = ~white[1:]
    next_black &= ~text_ends
    start = np.where(white, ~before_white | next_black, changes & ~before_space)
    start |= is_start[:n]
    for i in np.flatnonzero(code == 0x27):
        if not is_start[i] and (kind[i - 1] == OTHER or code[i - 1] == 0x20):
            continue
        follow = bytes(data[lead[i] + 1:lead[i] + 3])
        for c in CONTRACTIONS:
            if follow.startswith(c) and not is_start[i + 1:i + 1 + len(c)].any():
                start[i + 1:i + 1 + len(c)] = False
                if i + 1 + len(c) < n:
                    start[i + 1 + len(c)] = True
                break
    return lead[start[:n]]


def _byte_chars() -> dict[str, int]:
    """The printable stand-in that the vocabulary uses for each byte: itself where printable, else from 256 on."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass
class Vocabulary:
    """Ids of the 256 bytes, merges as sorted pair keys with rank and result, bytes of every id, special tokens."""

    byte_id: np.ndarray
    pair: np.ndarray
    rank: np.ndarray
    made: np.ndarray
    token_bytes: np.ndarray
    token_off: np.ndarray
    special: dict[bytes, int]

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        vocab, merges = told["model"]["vocab"], told["model"]["merges"]
        char = _byte_chars()
        special = {t["content"]: t["id"] for t in told["added_tokens"]}
        raw: dict[int, bytes] = {i: bytes(char[c] for c in word) for word, i in vocab.items() if word not in special}
        raw |= {i: word.encode() for word, i in special.items()}
        joined = [raw.get(i, b"") for i in range(max(raw) + 1)]
        merges = [m.split(" ") if isinstance(m, str) else m for m in merges]
        pair = np.array([(vocab[a] << 32) | vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int32)
        pair, first = np.unique(pair, return_index=True)
        return cls(np.array([vocab[c] for c, _ in sorted(char.items(), key=lambda x: x[1])], np.int32),
                   pair, first.astype(np.int32), made[first], np.frombuffer(b"".join(joined), np.uint8),
                   np.concatenate([[0], np.cumsum([len(x) for x in joined])]).astype(np.int64),
                   {w.encode(): i for w, i in special.items()})

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (the largest number if it is no merge) and the id it merges to."""
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.rank[at], np.int32(2**31 - 1)), self.made[at]

    def merge(self, found: list[bytes], longest: int = 48) -> list[np.ndarray]:
        """Ids of each piece by merging: always the pair of lowest rank, of equal ones the leftmost."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(found)
        by_length: dict[int, list[int]] = {}
        for i, piece in enumerate(found):
            by_length.setdefault(len(piece), []).append(i)
        for length, rows in by_length.items():
            if length > longest:
                for i in rows:
                    out[i] = self._merge_long(found[i])
                continue
            where = np.array(rows)
            ids = self.byte_id[np.frombuffer(b"".join(found[i] for i in rows), np.uint8).reshape(-1, length)]
            self._merge_block(ids, where, out)
        return out

    def _merge_block(self, ids: np.ndarray, where: np.ndarray, out: list[np.ndarray]) -> None:
        """Pieces of one length at a time; a step makes every piece that goes on one id shorter."""
        none = 2**31 - 1
        if ids.shape[1] > 1:
            rank, made = self.ranks(ids[:, :-1], ids[:, 1:])
        while ids.shape[1] > 1:
            at = rank.argmin(axis=1)
            going = rank[np.arange(len(ids)), at] < none
            for i, row in zip(where[~going], ids[~going], strict=True):
                out[i] = row
            ids, rank, made, at, where = ids[going], rank[going], made[going], at[going], where[going]
            m, n = ids.shape
            if not m:
                return
            row = np.arange(m)
            ids[row, at] = made[row, at]
            keep = np.ones((m, n), bool)
            keep[row, at + 1] = False
            ids = ids[keep].reshape(m, n - 1)
            keep = np.ones((m, n - 1), bool)
            keep[row, at] = False
            rank, made = rank[keep].reshape(m, n - 2), made[keep].reshape(m, n - 2)
            for shift in (-1, 0):
                k = at + shift
                ok = (k >= 0) & (k < n - 2)
                if ok.any():
                    r, kk = row[ok], k[ok]
                    rank[r, kk], made[r, kk] = self.ranks(ids[r, kk], ids[r, kk + 1])
        for i, r in zip(where, ids, strict=True):
            out[i] = r

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """The same for one long piece: a heap of pairs over a linked list."""
        import heapq

        ids = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank, made = self.ranks(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(r, i, m, ids[i], ids[i + 1]) for i, (r, m) in enumerate(zip(rank.tolist(), made.tolist(), strict=True))
                if r < 2**31 - 1]
        heapq.heapify(heap)
        known = self.__dict__.setdefault("_pairs", {})
        if not known:
            known.update(zip(self.pair.tolist(), zip(self.rank.tolist(), self.made.tolist(), strict=True), strict=True))
        while heap:
            _, i, m, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = m, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (hit := known.get((ids[left] << 32) | ids[right])):
                    heapq.heappush(heap, (hit[0], left, hit[1], ids[left], ids[right]))
        return np.array([x for x in ids if x >= 0], np.int32)


class Lexicon:
    """Minimal acyclic automaton over bytes.  The outputs on the way to an accepting state add up to the number of the
    piece in sorted order; ``ids`` of that number are the ids of the piece."""

    FIELDS = ("edge", "target", "output", "accepts", "id_off", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.edge, self.target, self.output, self.accepts, self.id_off, self.ids = (arrays[k] for k in self.FIELDS)

    @classmethod
    def compile(cls, entries: dict[bytes, np.ndarray]) -> Lexicon:
        """Build from sorted words: a state is frozen as soon as no later word can reach it, and takes the place of
        an equal one that is there already."""
        register: dict[tuple, int] = {}
        frozen: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
        below: list[int] = []  # accepted words from each state on
        path: list[tuple[bool, dict[int, int]]] = [(False, {})]
        before = b""

        def freeze(depth: int) -> int:
            accepts, edges = path[depth]
            key = (accepts, tuple(sorted(edges.items())))
            if key not in register:
                register[key] = len(frozen)
                frozen.append(key)
                below.append(accepts + sum(below[s] for s in edges.values()))
            return register[key]

        def close(to: int) -> None:
            for depth in range(len(path) - 1, to, -1):
                path[depth - 1][1][before[depth - 1]] = freeze(depth)
                path.pop()

        words = sorted(entries)
        for word in words:
            common = next((k for k, (a, b) in enumerate(zip(word, before, strict=False)) if a != b),
                          min(len(word), len(before)))
            close(common)
            path.extend((False, {}) for _ in word[common:])
            path[len(word)] = (True, path[len(word)][1])
            before = word
        close(0)
        root = freeze(0)
        order = [root, *(s for s in range(len(frozen)) if s != root)]
        place = {s: k for k, s in enumerate(order)}
        edge, target, output = [], [], []
        for s in order:
            accepts, edges = frozen[s]
            passed = int(accepts)
            for byte, t in edges:
                edge.append(place[s] * 256 + byte)
                target.append(place[t])
                output.append(passed)
                passed += below[t]
        ids = [entries[w] for w in words]
        return cls({"edge": np.array(edge, np.int64), "target": np.array(target, np.int32),
                    "output": np.array(output, np.int32), "accepts": np.array([frozen[s][0] for s in order], bool),
                    "id_off": np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64),
                    "ids": np.concatenate([*ids, np.zeros(0, np.int32)]).astype(np.int32)})

    def dump(self) -> bytes:
        """All arrays in one block: a header of kinds and sizes, then each array at a multiple of 8."""
        arrays = [np.ascontiguousarray(getattr(self, k)) for k in self.FIELDS]
        head = json.dumps([(a.dtype.str, len(a)) for a in arrays]).encode()
        parts, at = [len(head).to_bytes(8, "little"), head], 8 + len(head)
        for a in arrays:
            parts += [b"\0" * (-at % 8), a.tobytes()]
            at += -at % 8 + a.nbytes
        return b"".join(parts)

    @classmethod
    def load(cls, buffer: bytes | mmap.mmap) -> Lexicon:
        size = int.from_bytes(buffer[:8], "little")
        at, arrays = 8 + size, {}
        for name, (kind, n) in zip(cls.FIELDS, json.loads(buffer[8:at]), strict=True):
            at += -at % 8
            arrays[name] = np.frombuffer(buffer, np.dtype(kind), n, at)
            at += arrays[name].nbytes
        return cls(arrays)

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of each span of bytes, -1 if it is no word: all spans take a step at a time."""
        out = np.full(len(starts), -1, np.int64)
        if not len(self.edge):
            return out
        row, state, total = np.arange(len(starts)), np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        depth = 0
        while len(row):
            done = ends[row] - starts[row] == depth
            fits = done & self.accepts[state]
            out[row[fits]] = total[fits]
            row, state, total = row[~done], state[~done], total[~done]
            key = state * 256 + data[starts[row] + depth]
            at = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
            ok = self.edge[at] == key
            row, at = row[ok], at[ok]
            state, total = self.target[at].astype(np.int64), total[ok] + self.output[at]
            depth += 1
        return out


def take_spans(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The values of the spans, one after the other."""
    total = int(sizes.sum())
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    return data[shift + np.arange(total)]


def distinct_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first span of each distinct one, which distinct one each span is), by 64-bit hash."""
    _, first, which = np.unique(hash_spans(data, starts, ends, fold=False), return_index=True, return_inverse=True)
    return first, which


def encode_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lexicon: Lexicon,
                 vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces one after the other, and how many ids each piece has."""
    first, which = distinct_spans(data, starts, ends)
    s, e = starts[first], ends[first]
    number = lexicon.numbers(data, s, e)
    known = number >= 0
    unseen = vocab.merge([data[a:b].tobytes() for a, b in zip(s[~known], e[~known], strict=True)])
    size = np.zeros(len(s), np.int64)
    place = np.zeros(len(s), np.int64)
    size[known] = lexicon.id_off[number[known] + 1] - lexicon.id_off[number[known]]
    place[known] = lexicon.id_off[number[known]]
    size[~known] = [len(x) for x in unseen]
    place[~known] = len(lexicon.ids) + np.cumsum(size[~known]) - size[~known]
    pool = np.concatenate([lexicon.ids, *unseen])
    return take_spans(pool, place[which], size[which]), size[which]


def encode_texts(data: np.ndarray, off: np.ndarray, lexicon: Lexicon, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of consecutive texts, and the offsets of the texts in them.  Special tokens are cut out first; what stands
    between them is encoded as texts of their own."""
    cuts: list[tuple[int, int, int]] = []
    raw = data.tobytes() if vocab.special else b""
    for word, i in vocab.special.items():
        at = raw.find(word)
        while at >= 0:
            row = int(np.searchsorted(off, at, side="right")) - 1
            if at + len(word) <= off[row + 1]:
                cuts.append((at, at + len(word), i))
                at = raw.find(word, at + len(word))
            else:
                at = raw.find(word, at + 1)
    cuts.sort()
    borders = np.unique(np.concatenate([off, np.array([x for a, b, _ in cuts for x in (a, b)], np.int64)]))
    starts = pieces(data, borders) if len(data) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(data))
    special = np.zeros(len(starts), np.int64) - 1
    drop = np.zeros(len(starts), bool)
    for a, b, i in cuts:  # a special token is one piece, whatever the rules say of its inside
        lo, hi = np.searchsorted(starts, [a, b])
        special[lo], drop[lo + 1:hi], ends[lo] = i, True, b
    starts, ends, special = starts[~drop], ends[~drop], special[~drop]
    ids, size = encode_spans(data, starts, ends, lexicon, vocab)
    if cuts:
        upto = np.concatenate([[0], np.cumsum(size)])
        new = np.where(special >= 0, 1, size)
        parts = np.split(ids, upto[1:-1]) if len(size) else []
        ids = np.concatenate([np.array([s], np.int32) if s >= 0 else p for s, p in zip(special, parts, strict=True)])
        size = new
    upto = np.concatenate([[0], np.cumsum(size)])
    return ids.astype(np.int32), upto[np.searchsorted(starts, off)]


def _count(share: float):
    """A task's pieces that make up at least ``share`` of all its pieces; rarer ones are dropped as they come up
    against the whole task only, so no piece with that share over the corpus is missed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        total = 0
        for batch in batches:
            data, off = bytes_of(batch.column(0))
            for i, j in slices(off, STEP):
                part, own = data[off[i]:off[j]], off[i:j + 1] - off[i]
                starts = pieces(part, own)
                if not len(starts):
                    continue
                ends = np.append(starts[1:], len(part))
                first, which = distinct_spans(part, starts, ends)
                n = np.bincount(which)
                total += len(starts)
                for a, b, c in zip(starts[first], ends[first], n.tolist(), strict=True):
                    word = part[a:b].tobytes()
                    counts[word] = counts.get(word, 0) + c
                if len(counts) > 1 << 18:  # rare by now; a piece loses less than half the share this way
                    least = share * total / 2
                    counts = {w: c for w, c in counts.items() if c >= least}
        kept = [(w, c) for w, c in counts.items() if c >= share * total / 2]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.binary()),
                                          pa.array([c for _, c in kept], pa.int64())], ["piece", "n"])

    return run


def frequent_pieces(docs: DataFrame, size: int = 1 << 16, share: float = 2.0**-17) -> list[bytes]:
    """The most frequent pieces over all texts, at most ``size`` of them."""
    found = texts(docs).select("text").mapInArrow(lean(_count(share)), "piece binary, n bigint")
    top = found.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(size)
    return [bytes(r.piece) for r in top.collect() if len(r.piece) <= 48]


def share_lexicon(spark: SparkSession, lexicon: Lexicon) -> str:
    """Write the automaton to the shared folder and have every executor fetch it; the name to find it by."""
    folder = new_folder(spark, "bpe-lexicon")
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    block = lexicon.dump()
    stream.write(bytearray(block), 0, len(block))
    stream.close()
    spark.sparkContext.addFile(f"{folder}/{name}")
    return name


_mapped: dict[str, Lexicon] = {}


def mapped_lexicon(name: str) -> Lexicon:
    """The memory-mapped automaton, opened once in a worker."""
    if name not in _mapped:
        with open(SparkFiles.get(name), "rb") as file:
            _mapped[name] = Lexicon.load(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
    return _mapped[name]


@dataclass
class Codec:
    """Encode and decode columns with one vocabulary and one lexicon."""

    spark: SparkSession
    vocab: Vocabulary
    lexicon: str

    @classmethod
    def build(cls, docs: DataFrame, vocabulary: str, size: int = 1 << 16) -> Codec:
        vocab = Vocabulary.read(vocabulary)
        words = [w for w in frequent_pieces(docs, size) if w not in vocab.special]
        lexicon = Lexicon.compile(dict(zip(words, vocab.merge(words), strict=True)))
        return cls(docs.sparkSession, vocab, share_lexicon(docs.sparkSession, lexicon))

    def encode(self, docs: DataFrame) -> DataFrame:
        """(doc_id, ids) of every row."""
        vocab, name = self.spark.sparkContext.broadcast(self.vocab), self.lexicon

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, off = bytes_of(batch.column(1))
                for i, j in slices(off, STEP):
                    ids, at = encode_texts(data[off[i]:off[j]], off[i:j + 1] - off[i], mapped_lexicon(name), vocab.value)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids))],
                        ["doc_id", "ids"])

        rows = texts(docs)
        return rows.mapInArrow(lean(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")

    def decode(self, encoded: DataFrame) -> DataFrame:
        """The given columns with ``decoded``, the text of the ids, added; bytes that are no UTF-8 become U+FFFD."""
        vocab = self.spark.sparkContext.broadcast((self.vocab.token_bytes, self.vocab.token_off))
        rows = encoded.withColumn("ids", F.coalesce("ids", F.array().cast("array<int>")))
        place = rows.columns.index("ids")
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", decoded string"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            raw, upto = vocab.value
            for batch in batches:
                column = batch.column(place)
                off = column.offsets.to_numpy().astype(np.int64)
                ids = column.values.to_numpy(zero_copy_only=False)
                for i, j in slices(off, 1 << 17):
                    part = ids[off[i]:off[j]]
                    size = (upto[1:] - upto[:-1])[part]
                    data = take_spans(raw, upto[part], size).tobytes()
                    at = np.concatenate([[0], np.cumsum(size)])[off[i:j + 1] - off[i]]
                    text = [data[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns), pa.array(text, pa.string())],
                                                     [*batch.schema.names, "decoded"])

        return rows.mapInArrow(lean(run), schema)


def vocabulary_path() -> str:
    """The public 50k byte-level vocabulary of this installation."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def digests(decoded: DataFrame, *more: Column) -> DataFrame:
    """Number of ids, and digests of the ids and of the text, of (doc_id, ids, decoded)."""
    return decoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), *more)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    codec = Codec.build(docs, vocabulary_path())
    return digests(codec.decode(codec.encode(docs)))
