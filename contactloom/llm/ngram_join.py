"""Similarity join of texts on their word shingles, by prefix filters under several token orders.

A document's set holds the hashes of its distinct shingles.  Two sets link when
100 * |A and B| >= percent * |A or B|.  Documents with equal sets are one node.

An order puts the tokens of its own class (a fifth of all, by hash) first, the rarer before the more frequent, then the
rest by hash.  Under every such order, two sets that link share one of their first n - ceil(percent n / 100) + 1 tokens.
Tokens that only one node has link nothing; they fill the front of the prefix, so that most nodes have no shared
token there, and too many of them rule a node out by themselves.  A candidate pair shares a prefix token under the first
order, passes the bounds that sizes, places and counts of lone tokens set, and has to share a prefix token under every
other order too, before whole sets are compared.

Groups of nodes with one prefix token are not expanded into pairs.  First each node meets the node of its group in which
the token stands furthest to the front; links make components.  Then only nodes outside the group's largest component
meet the others, only across components, and only where bitmaps of their sets leave a link possible.  Of the pairs
that may link a group writes those that tie two components, or what was tied before, together: fewer than it has members.
What these and the first links tie is a cluster; no link leaves one.  Each set goes to its cluster once, and there the
nodes of different components meet under all orders and by whole sets; again only links that tie something are written.
No link between components is lost, and members of one need none.

Nothing here is cut off: no bound on partners, frequent tokens or group sizes.  Hashes have 52 bits for shingles and 64
for whole sets.

Null and empty texts have an empty set and link with nothing; texts with fewer words than a shingle have the whole
sequence as their only one.  Rows repeat as they are, a null id stays null; rows without an id link only with rows of an equal
set; a component is named by its smallest id, or null if none has one.  Only doc_id and text are read."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm.byte_bpe import take_spans
from contactloom.llm.components import components
from contactloom.llm.katz import planes, unplanes
from contactloom.llm.shared import bytes_of, hash_ngrams, hash_spans, lean, mix, settle, slices, texts, words

#: Bitmaps have 64 * WORDS classes: several times the shingles of most texts, so that few of them fall together and pairs that
#: are near copies of one text, but no link, are told apart before they are written.
HASH_BITS, ROW_BITS, CLASSES, WORDS = 52, 12, 5, 64
#: Put on the frequency of tokens outside an order's class, which come after those in it.
LATE = 1 << 40


@dataclass(frozen=True)
class Measure:
    """Words of a shingle, and the least similarity in hundredths."""

    size: int = 4
    percent: int = 85

    def prefix(self, n):
        """Length of the prefix of a set of n."""
        return n - (self.percent * n + 99) // 100 + 1


def shingle_sets(data: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of consecutive texts, by row and then hash; rows at most 2**ROW_BITS."""
    starts, ends, row = words(data, off)
    h = hash_spans(data, starts, ends)
    grams = hash_ngrams(h, size)
    whole = row[:len(grams)] == row[size - 1:] if len(grams) else np.zeros(0, bool)
    rows, hashes = row[:len(grams)][whole], grams[whole]
    n = np.bincount(row, minlength=len(off) - 1)
    first = np.concatenate([[0], np.cumsum(n)])
    for m in range(1, size):
        short = np.flatnonzero(n == m)
        rows = np.concatenate([rows, short])
        hashes = np.concatenate([hashes, mix(np.array([hash_ngrams(h[first[k]:first[k] + m], m)[0] for k in short], np.uint64) + np.uint64(m))])
    both = np.unique(rows.astype(np.uint64) << np.uint64(HASH_BITS) | hashes >> np.uint64(64 - HASH_BITS))
    return (both >> np.uint64(HASH_BITS)).astype(np.int64), both & np.uint64((1 << HASH_BITS) - 1)


def set_slices(batch: pa.RecordBatch, text: int, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, off = bytes_of(batch.column(text))
    for a, b in slices(off, 1 << 19):
        for i in range(a, b, 1 << ROW_BITS):
            j = min(b, i + (1 << ROW_BITS))
            yield i, j, *shingle_sets(data[off[i]:off[j]], off[i:j + 1] - off[i], size)


def class_of(token: np.ndarray) -> np.ndarray:
    """Which order a token belongs to; hashes of one class are one range."""
    return ((token >> np.uint64(HASH_BITS - 20)) * np.uint64(CLASSES) >> np.uint64(20)).astype(np.int64)


def node_names(row: np.ndarray, token: np.ndarray, n: np.ndarray) -> np.ndarray:
    """64-bit name of each set: a mixed sum over its tokens, with its size."""
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    total = np.zeros(len(n), np.uint64)
    some = n > 0
    if some.any():
        total[some] = np.add.reduceat(mix(token * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)), first[some])
    return mix(total + n.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def document_sets(docs: DataFrame, measure: Measure, orders: int) -> DataFrame:
    """(doc_id, node, n, own) of every row: name and size of its set, and how many tokens are in each order's class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, row, token in set_slices(batch, 1, measure.size):
                n = np.bincount(row, minlength=j - i)
                kind = class_of(token)
                own = [np.bincount(row[kind == k], minlength=j - i) for k in range(orders)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(node_names(row, token, n)), pa.array(n),
                     pa.array(np.stack(own, axis=1).tolist(), pa.list_(pa.int64()))], ["doc_id", "node", "n", "own"])

    rows = texts(docs)
    return rows.mapInArrow(lean(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, node bigint, n bigint, own array<bigint>")


def _postings(measure: Measure, orders: int, bits: int):
    """For each order and range of tokens: the tokens that may stand in a prefix, with the nodes that have them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, row, token in set_slices(batch, 0, measure.size):
                n = np.bincount(row, minlength=j - i)
                node = node_names(row, token, n)
                kind = class_of(token)
                for k in range(orders):
                    ours = kind == k
                    short = measure.prefix(n) - np.bincount(row[ours], minlength=j - i)  # tokens of other classes in the prefix
                    late = np.flatnonzero(~ours & (short[row] > 0))
                    order = np.arange(len(late)) - np.searchsorted(row[late], row[late])  # place among them, by hash
                    late = late[order < short[row[late]]]
                    at = np.concatenate([np.flatnonzero(ours), late])
                    at = at[np.argsort(token[at], kind="stable")]
                    bucket = (token[at] >> np.uint64(HASH_BITS - bits)).astype(np.int64)
                    some, cut = np.unique(bucket, return_index=True)
                    cut = np.append(cut, len(at))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), k), pa.int32()), pa.array(some, pa.int32()),
                         pa.array([planes(token[at[a:b]]) for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
                         pa.array([planes(row[at[a:b]].astype(np.uint16)) for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
                         pa.array([_nodes(node, row[at[a:b]]) for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())],
                        ["order", "bucket", "tokens", "row", "nodes"])

    return run


def _nodes(node: np.ndarray, row: np.ndarray) -> bytes:
    return node[:int(row.max()) + 1].tobytes()


def _shared(bits: int):
    """Tokens of more than one node, dealt out by node: (order, range of nodes, nodes, tokens, frequencies)."""
    def close(order: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        token, node = np.concatenate([t for t, _ in parts]), np.concatenate([n for _, n in parts])
        at = np.lexsort((node, token))
        token, node = token[at], node[at]
        new = np.concatenate([[True], (token[1:] != token[:-1]) | (node[1:] != node[:-1])])
        token, node = token[new], node[new]
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        often = np.repeat(np.diff(np.append(first, len(token))), np.diff(np.append(first, len(token))))
        keep = often > 1
        token, node, often = token[keep], node[keep], often[keep] + np.where(class_of(token[keep]) == order, 0, LATE)
        at = np.argsort(node, kind="stable")
        token, node, often = token[at], node[at], often[at]
        bucket = (node.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
        at = np.argsort(bucket, kind="stable")
        token, node, often, bucket = token[at], node[at], often[at], bucket[at]
        some, cut = np.unique(bucket, return_index=True)
        cut = np.append(cut, len(node))
        cols = [[planes(x[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)] for x in (node, token, often)]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(some), order), pa.int32()), pa.array(some, pa.int32()),
                                           *(pa.array(c, pa.binary()) for c in cols)], ["order", "bucket", "nodes", "tokens", "often"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            for order, bucket, tokens, row, nodes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is not None and now != (order, bucket):
                    yield close(now[0], parts)
                    parts = []
                now = order, bucket
                parts.append((unplanes(tokens, np.uint64), np.frombuffer(nodes, np.int64)[unplanes(row, np.uint16)]))
        if now is not None:
            yield close(now[0], parts)

    return run


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each order and node its shared tokens as the order has them: those in class first, the rarer before the more
    frequent, then the rest by hash, as the prefix was cut; with how many are in class."""
    def close(order: int, parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        node, token, often = (np.concatenate([p[k] for p in parts]) for k in range(3))
        at = np.lexsort((token, np.minimum(often, LATE), node))
        node, token, often = node[at], token[at], often[at]
        first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        off = np.append(first, len(node))
        early = np.add.reduceat((often < LATE).astype(np.int64), first)
        for i in range(0, len(first), 4096):
            j = min(len(first), i + 4096)
            lists = pa.ListArray.from_arrays(pa.array(off[i:j + 1] - off[i], pa.int32()), pa.array(token[off[i]:off[j]].view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(j - i, order), pa.int32()), pa.array(node[first[i:j]]), pa.array(early[i:j]), lists],
                                             ["order", "node", "in_class", "tokens"])

    now, parts = None, []
    for batch in batches:
        for order, bucket, nodes, tokens, often in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is not None and now != (order, bucket):
                yield from close(now[0], parts)
                parts = []
            now = order, bucket
            parts.append((unplanes(nodes, np.int64), unplanes(tokens, np.uint64), unplanes(often, np.int64)))
    if now is not None:
        yield from close(now[0], parts)


def prefixes(docs: DataFrame, nodes: DataFrame, measure: Measure, orders: int) -> DataFrame:
    """Nodes that may link: (node, n, lone, prefix0, prefix1, ...), the shared tokens in the prefix under each order, and
    how many lone tokens stand before them (lone0, lone1, ...)."""
    bits = max(4, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")).bit_length())
    packed = (texts(docs).select("text").mapInArrow(lean(_postings(measure, orders, bits)),
                                                    "order int, bucket int, tokens binary, row binary, nodes binary")
              .repartition("order", "bucket").sortWithinPartitions("order", "bucket")
              .mapInArrow(lean(_shared(bits)), "order int, bucket int, nodes binary, tokens binary, often binary")
              .repartition("order", "bucket").sortWithinPartitions("order", "bucket")
              .mapInArrow(lean(_gathered), "order int, node bigint, in_class bigint, tokens array<bigint>"))
    shared = settle(packed, "ngram-shared")
    out = nodes
    for k in range(orders):
        own = shared.filter(F.col("order") == k).select("node", F.col("in_class").alias(f"in{k}"), F.col("tokens").alias(f"tokens{k}"))
        out = out.join(own, "node")
        out = out.withColumn(f"lone{k}", F.col("own")[k] - F.col(f"in{k}"))
    longest = F.col("n") - F.ceil(F.col("n") * measure.percent / F.lit(100)) + 1
    lone = sum((F.col(f"lone{k}") for k in range(orders)), F.lit(0))
    out = out.withColumn("most", longest).filter(lone < F.col("most"))
    cut = [F.slice(f"tokens{k}", F.lit(1), F.greatest(F.lit(0), F.col("most") - F.col(f"lone{k}")).cast("int")).alias(f"prefix{k}")
           for k in range(orders)]
    out = out.select("node", "n", "rep", lone.alias("lone"), *(f"lone{k}" for k in range(orders)), *cut)
    for k in range(orders):
        out = out.filter(F.size(f"prefix{k}") > 0)
    return settle(out, "ngram-prefixes")


def may_link(percent: int, na: Column, nb: Column, most: Column) -> Column:
    """Whether sets of these sizes could still link if they share ``most`` tokens."""
    most = F.least(most, na, nb)
    return 100 * most >= percent * (na + nb - most)


def distinct_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def verified(pairs: DataFrame, survivors: DataFrame, sets: DataFrame, measure: Measure, orders: int) -> DataFrame:
    """The pairs that link.  Every other order has its say first; then whole sets are compared."""
    def side(name: str) -> DataFrame:
        return survivors.select(F.col("node").alias(name), F.col("n").alias(f"n{name}"), F.col("lone").alias(f"l{name}"),
                                *(F.col(f"prefix{k}").alias(f"p{k}{name}") for k in range(1, orders)))

    pairs = pairs.join(side("b"), "b").join(side("a"), "a")
    ok = may_link(measure.percent, F.col("na"), F.col("nb"), F.least(F.col("na") - F.col("la"), F.col("nb") - F.col("lb")))
    for k in range(1, orders):
        ok &= F.arrays_overlap(f"p{k}a", f"p{k}b")
    pairs = settle(pairs.filter(ok).select("a", "b"), "ngram-candidates")
    whole = pairs.join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb")), "b").join(
        sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta")), "a")
    both = F.size(F.array_intersect("ta", "tb"))
    return settle(whole.filter(100 * both >= measure.percent * (F.size("ta") + F.size("tb") - both)).select("a", "b"), "ngram-links")


def bitmaps(row: np.ndarray, token: np.ndarray, rows: int) -> np.ndarray:
    """For each set a bitmap of the hash classes of its tokens, as WORDS whole numbers."""
    out = np.zeros((rows, 64 * WORDS), bool)
    out[row, (token % np.uint64(64 * WORDS)).astype(np.int64)] = True
    return np.packbits(out, axis=1).view(np.int64)


def node_sets(docs: DataFrame, survivors: DataFrame, measure: Measure) -> DataFrame:
    """(node, tokens, bits) of the surviving nodes, from the text of one document of each.  Rows of a repeated id give the set
    of each of their texts; the name of the set tells which is meant."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, row, token in set_slices(batch, 0, measure.size):
                n = np.bincount(row, minlength=j - i)
                off = np.concatenate([[0], np.cumsum(n)])
                yield pa.RecordBatch.from_arrays([pa.array(node_names(row, token, n)), batch.column(1).slice(i, j - i),
                                                  pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(token.view(np.int64))),
                                                  pa.array(list(bitmaps(row, token, j - i)), pa.list_(pa.int64()))],
                                                 ["node", "wanted", "tokens", "bits"])

    wanted = survivors.select(F.col("rep").alias("doc_id"), F.col("node").alias("wanted"))
    rows = texts(docs).join(wanted, "doc_id").select("text", "wanted")
    made = rows.mapInArrow(lean(run), "node bigint, wanted bigint, tokens array<bigint>, bits array<bigint>").filter("node = wanted")
    return settle(made.dropDuplicates(["node"]).select("node", "tokens", "bits"), "ngram-sets")


def first_meetings(entries: DataFrame) -> DataFrame:
    """Each node with the node of its token group in which the token stands furthest to the front."""
    centre = entries.groupBy("token").agg(F.min(F.struct("place", "node")).alias("c"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    return distinct_pairs(entries.join(centre.select("token", F.col("c.node").alias("centre")), "token")
                          .filter("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")))


#: Members of a group that meet in one piece of work, and tokens of their sets where these go along; larger groups are cut into
#: pairs of blocks.
BLOCK, SET_BLOCK = 8192, 1 << 20
#: Tokens at the front of each prefix by which a pair is known to have met before.
FRONT = 12


def _in_common(size: np.ndarray, tokens: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """How many of their listed tokens two members have in common, for arrays of members; ``size`` distinct tokens of each."""
    known, rank = np.unique(tokens, return_inverse=True)
    has = np.sort(np.repeat(np.arange(len(size)), size) * max(1, len(known)) + rank)
    first = np.cumsum(size) - size

    def common(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.int64)
        cut = [0]
        if len(has):
            upto = np.cumsum(size[i])
            while cut[-1] < len(i):
                done = upto[cut[-1] - 1] if cut[-1] else 0
                cut.append(max(cut[-1] + 1, int(np.searchsorted(upto, done + (1 << 19), side="right"))))
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            own, other = i[a:b], j[a:b]
            pair = np.repeat(np.arange(len(own)), size[own])
            asked = take_spans(has, first[own], size[own]) % len(known) + other[pair] * len(known)
            at = np.minimum(np.searchsorted(has, asked), len(has) - 1)
            out[a:b] = np.bincount(pair[has[at] == asked], minlength=len(own))
        return out

    return common


def _ties(tree: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of the pairs (x, y) tie two trees together that are apart when their turn comes.  ``tree`` names the root of
    each element and is brought up to date."""
    out = np.zeros(len(x), bool)
    low, high = np.minimum(tree[x], tree[y]), np.maximum(tree[x], tree[y])
    first = np.unique(low * len(tree) + high, return_index=True)[1]
    for k in first[low[first] < high[first]].tolist():
        a, b = int(low[k]), int(high[k])
        while tree[a] != a:
            a = int(tree[a])
        while tree[b] != b:
            b = int(tree[b])
        if a != b:
            tree[max(a, b)] = min(a, b)
            out[k] = True
    while (tree != (up := tree[tree])).any():
        tree[:] = up
    return out


def _groups(batches: Iterator[pa.RecordBatch], plain: int, lists: int) -> Iterator[list[np.ndarray]]:
    """The columns after the key of each (token, left block, right block) of a sorted stream: the plain ones, then
    lengths and values of each list."""
    def whole(parts: list[tuple]) -> list[np.ndarray]:
        return [np.concatenate([p[k] for p in parts]) for k in range(len(parts[0]))]

    now, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(k).to_numpy() for k in range(3)])
        cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3, 3 + plain)]
        sized = [(c.value_lengths().to_numpy(), c.flatten().to_numpy()) for c in (batch.column(k) for k in range(3 + plain, 3 + plain + lists))]
        sized = [(size, np.concatenate([[0], np.cumsum(size)]), values) for size, values in sized]
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows], strict=True):
            if now is not None and now != tuple(key[:, a]):
                yield whole(parts)
                parts = []
            now = tuple(key[:, a])
            parts.append((*(c[a:b] for c in cols), *(x for size, upto, values in sized for x in (size[a:b], values[upto[a]:upto[b]]))))
    if parts:
        yield whole(parts)


def _met(left: np.ndarray, node: np.ndarray, n: np.ndarray, component: np.ndarray, major: np.ndarray, place: np.ndarray, bits: np.ndarray,
         percent: int, asked: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Pairs that tie: the left members, all outside the largest component, meet those right members that are in another
    component and not yet tied to theirs, as far as sizes, places and bitmaps allow; ``asked`` has the last word."""
    def may(na: np.ndarray, nb: np.ndarray, most: np.ndarray) -> np.ndarray:
        most = np.minimum(np.minimum(most, na), nb)
        return 100 * most >= percent * (na + nb - most)

    known, of = np.unique(component, return_inverse=True)
    tree = np.arange(len(known))
    a, b = np.flatnonzero(left), np.flatnonzero(~left)
    step = max(1, (1 << 16) // max(1, len(b)))
    for k in range(0, len(a), step):
        i, j = (x.ravel() for x in np.meshgrid(a[k:k + step], b, indexing="ij"))
        ok = (tree[of[i]] != tree[of[j]]) & ((component[j] == major[j]) | (node[i] < node[j]))
        i, j = i[ok], j[ok]
        ok = may(n[i], n[j], np.minimum(n[i] - place[i], n[j] - place[j]))
        i, j = i[ok], j[ok]
        for c in range(0, len(i), 1 << 13):
            p, q = i[c:c + (1 << 13)], j[c:c + (1 << 13)]
            apart = tree[of[p]] != tree[of[q]]
            p, q = p[apart], q[apart]
            x, y = bits[p], bits[q]
            ok = may(n[p], n[q], np.minimum(n[p] - np.bitwise_count(x & ~y).sum(1, dtype=np.int64), n[q] - np.bitwise_count(y & ~x).sum(1, dtype=np.int64)))
            p, q = p[ok], q[ok]
            ok = asked(p, q)
            p, q = p[ok], q[ok]
            new = _ties(tree, of[p], of[q])
            if new.any():
                yield pa.RecordBatch.from_arrays([pa.array(node[p[new]]), pa.array(node[q[new]])], ["a", "b"])


def _across(percent: int):
    """Ties of each (token, left block, right block) among the pairs that may link.  A pair is not looked at where one of the
    FRONT first tokens of the order has brought it together before, however many tokens its sets share."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for left, node, n, component, major, place, _, bits, size, earlier in _groups(batches, 6, 2):
            met_before = _in_common(size, earlier)
            yield from _met(left, node, n, component, major, place, bits.view(np.uint64).reshape(-1, WORDS), percent,
                            lambda p, q, met_before=met_before: met_before(p, q) == 0)

    return run


def _linked(percent: int, orders: int):
    """Ties of each (cluster, left block, right block) among the pairs that link.  Prefixes under every order have their say
    before whole sets are compared."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for left, node, n, component, major, size, tokens, *prefix in _groups(batches, 5, 1 + orders):
            every = [_in_common(prefix[2 * k], prefix[2 * k + 1]) for k in range(orders)]
            whole = _in_common(size, tokens)

            def links(p: np.ndarray, q: np.ndarray, n=n, every=every, whole=whole) -> np.ndarray:
                at = np.arange(len(p))
                for shared in every:
                    at = at[shared(p[at], q[at]) > 0]
                both = whole(p[at], q[at])
                out = np.zeros(len(p), bool)
                out[at[100 * both >= percent * (n[p[at]] + n[q[at]] - both)]] = True
                return out

            upto = np.concatenate([[0], np.cumsum(size)])
            bits = np.concatenate([bitmaps(np.repeat(np.arange(b - a), size[a:b]), tokens[upto[a]:upto[b]].view(np.uint64), b - a)
                                   for a, b in zip(range(0, len(size), 1024), [*range(1024, len(size), 1024), len(size)], strict=True)])
            yield from _met(left, node, n, component, major, np.zeros_like(n), bits.view(np.uint64), percent, links)

    return run


def _of_several(members: DataFrame, group: str) -> DataFrame:
    """The groups of (group, node, n, component) with more than one component: the largest one, and into how many blocks of
    BLOCK members or SET_BLOCK tokens the members are dealt."""
    counts = members.groupBy(group, "component").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("all"))
    return (counts.groupBy(group).agg(F.max(F.struct("c", "component")).alias("m"), F.count(F.lit(1)).alias("kinds"), F.sum("c").alias("size"), F.sum("all").alias("all"))
            .filter("kinds > 1").select(group, F.col("m.component").alias("major"), F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"),
                                        F.ceil(F.greatest(F.col("size") / BLOCK, F.col("all") / SET_BLOCK)).cast("int").alias("set_blocks")))


def _in_blocks(members: DataFrame, group: str, blocks: str, own: tuple[str, ...]) -> DataFrame:
    """Every left block of a group, the members outside its largest component, with every right block, all members.  A group
    is dealt out as pairs of blocks, so that no piece of work grows with the group."""
    block = F.pmod(F.xxhash64("node"), F.col(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    left = members.filter("component <> major").select(group, block.alias("i"), every.alias("j"), F.lit(True).alias("left"), *own)
    right = members.select(group, every.alias("i"), block.alias("j"), F.lit(False).alias("left"), *own)
    return left.unionAll(right).repartition(group, "i", "j").sortWithinPartitions(group, "i", "j")


def later_meetings(entries: DataFrame, labels: DataFrame, sets: DataFrame, fronts: DataFrame, measure: Measure) -> DataFrame:
    """Pairs that tie all nodes that may link, though in different components, as far as sizes, places and bitmaps allow: the
    members of a token group outside its largest component meet all others."""
    named = entries.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = settle(named.join(_of_several(named, "token"), "token").join(sets.select("node", "bits"), "node").join(fronts, "node")
                   .withColumn("earlier", F.slice("front", F.lit(1), F.least("nth", F.lit(FRONT)))).drop("front", "nth"), "ngram-groups")
    rows = _in_blocks(named, "token", "blocks", ("node", "n", "component", "major", "place", "bits", "earlier"))
    return settle(distinct_pairs(rows.mapInArrow(lean(_across(measure.percent)), "a bigint, b bigint")), "ngram-later")


def links_within(clusters: DataFrame, labels: DataFrame, survivors: DataFrame, sets: DataFrame, measure: Measure, orders: int) -> DataFrame:
    """Links that tie all nodes of a cluster that links tie, though in different components."""
    prefix = [f"prefix{k}" for k in range(orders)]
    named = clusters.select("node", F.col("component").alias("cluster")).join(labels, "node", "left").join(survivors.select("node", "n", *prefix), "node")
    named = named.withColumn("component", F.coalesce("component", "node"))
    named = settle(named.join(_of_several(named.select("cluster", "node", "n", "component"), "cluster"), "cluster")
                   .join(sets.select("node", "tokens"), "node"), "ngram-clusters")
    rows = _in_blocks(named, "cluster", "set_blocks", ("node", "n", "component", "major", "tokens", *prefix))
    return settle(rows.mapInArrow(lean(_linked(measure.percent, orders)), "a bigint, b bigint"), "ngram-ties")


def similar_components(docs: DataFrame, measure: Measure | None = None, orders: int = 2) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    measure = measure or Measure()
    if not 1 <= orders <= CLASSES:
        raise ValueError(f"from 1 to {CLASSES} orders")
    sized = settle(document_sets(docs, measure, orders), "ngram-documents")
    nodes = settle(sized.filter("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.max("own").alias("own")), "ngram-nodes")
    survivors = prefixes(docs, nodes.filter("rep IS NOT NULL"), measure, orders)
    sets = node_sets(docs, survivors, measure)
    entries = settle(survivors.select("node", "n", "lone0", F.posexplode("prefix0").alias("nth", "token")).select(
        "token", "node", "n", (F.col("lone0") + F.col("nth")).alias("place"), "nth"), "ngram-entries")
    links = verified(first_meetings(entries), survivors, sets, measure, orders)
    labels = components(links)
    later = later_meetings(entries, labels, sets, survivors.select("node", F.slice("prefix0", 1, FRONT).alias("front")), measure)
    if not later.isEmpty():
        more = links_within(components(links.unionAll(later)), labels, survivors, sets, measure, orders)
        labels = components(links.unionAll(more))
    first = labels.join(nodes, "node").groupBy("component").agg(F.min("rep").alias("component_id"))
    named = nodes.select("node", "rep").join(labels.join(first, "component").select("node", "component_id"), "node", "left")
    named = named.select("node", F.coalesce("component_id", "rep").alias("component_id"))
    return sized.join(named, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def one_of_each(docs: DataFrame, measure: Measure | None = None) -> DataFrame:
    """The documents whose id names their component, with all their columns; documents without an id stay, and of rows
    that repeat an id all stay."""
    gone = similar_components(docs, measure).filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
