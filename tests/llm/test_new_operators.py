"""Alignment, ring shards and periodic runs against plain counterparts."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF
from test_text_operators import AWKWARD, SCHEMA, WORD, awkward, documents, nothing, order, passage, texts_of  # noqa: F401

from contactloom.llm import alignment, catalog, periodic_runs, ring_shards

STRANGE = ["a①b\t\U00011234x ünïcode  日本語 text", "hello   world \n\n x", "it's we'll <|endoftext|> </s> 123 4567", "é　 x \xa0 y", "tail ", "  lead", "a▁b c",
           "x" * 3000 + " yy", "\x1c \x1d a", "—“ ”« » z", " ", "a  ", "​ ﻿", "\x00 \x00"]


# ---- alignment of two tokenizers -----------------------------------------------------------------------------------
def plain_alignment(rows):
    """Whole texts through both libraries, cut by the bytes of the tokens."""
    t = alignment.Tokenizers(alignment.Pair())
    docs, counts = [], Counter()
    for i, text in rows:
        raw = (" " + text).encode()
        a = t.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = t.b.encode(text) if text else []
        ends = [np.cumsum([len(table[x]) for x in ids]).tolist() for ids, table in ((a, t.a_bytes), (b, t.b_bytes))]
        if b"".join(t.a_bytes[x] for x in a) != raw or b"".join(t.b_bytes[x] for x in b) != raw:
            a, b, ends = [], [], [[], []]
        links, x, y, told, part = [], 0, 0, [], ([], [])
        for end in sorted({*ends[0], *ends[1]}):
            links.append((a[x], b[y]))
            both = end == ends[0][x], end == ends[1][y]
            if both[0]:
                part[0].append(a[x])
                x += 1
            if both[1]:
                part[1].append(b[y])
                y += 1
            if all(both):
                told.append("|".join(",".join(map(str, p)) for p in part))
                part = ([], [])
        docs.append((i, len(a), len(b), told, links))
        counts.update(set(links))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    return [(i, a, b, len(told), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
             hashlib.sha256(";".join(told).encode()).hexdigest() if a else "") for i, a, b, told, links in docs]


@pytest.mark.parametrize(("segment", "step", "remembered"), [(alignment.SEGMENT, alignment.STEP, alignment.REMEMBERED), (5000, 900, 50)])
def test_alignment(spark, awkward, documents, segment, step, remembered):  # noqa: F811
    rows = [*texts_of(AWKWARD), *[(100 + k, t) for k, t in enumerate(STRANGE)], *[(1000 + i, t) for i, t in texts_of(documents)[:120]]]
    frame = awkward.select("doc_id", "text", "digest", "n").unionAll(
        spark.createDataFrame([(i, t, "x", 1) for i, t in rows[len(AWKWARD):]], "doc_id bigint, text string, digest string, n int")).repartition(3)
    got = alignment.aligned(frame, segment=segment, step=step, remembered=remembered).collect()
    assert order(map(tuple, got)) == order(plain_alignment(rows))


def test_alignment_of_nothing(nothing):  # noqa: F811
    assert alignment.aligned(nothing).isEmpty()


def test_alignment_query(spark, documents):  # noqa: F811
    got = catalog.QUERIES["op11_alignment"](spark, SF)
    assert got.columns == alignment._COLUMNS
    assert order(map(tuple, got.collect())) == order(plain_alignment(texts_of(documents)))


def test_coarse_cuts_are_refined():
    """The cuts from the libraries' spans stand where the bytes of the tokens end, in every unit that is kept whole."""
    t = alignment.Tokenizers(alignment.Pair())
    rng = np.random.default_rng(8)
    signs = [*"ab 1é日①　“.\n\t", "the", " and", "\U00011234", "\xa0", "ﬁ"]
    made = [(" " + "".join(rng.choice(signs, rng.integers(1, 30)))).encode() for _ in range(1500)]
    for ids, unit, ends, size in ((*t.left(made), t.a_size), (*t.right(made), t.b_size)):
        upto = np.cumsum(size[ids])
        assert (ends == upto - (upto - size[ids])[np.searchsorted(unit, unit)]).all()


# ---- shards on a ring ----------------------------------------------------------------------------------------------
def plain_ring(ids, shards, nodes):
    """Arc of every id and shard of every arc, by walking the ring."""
    cell = lambda text: int(hashlib.md5(text.encode()).hexdigest()[:15], 16)
    ring = {}
    for s in range(shards):
        for k in range(nodes):
            at = cell(f"node/{s}/{k}") >> 44
            ring[at] = min(s, ring.get(at, shards))
    ring = sorted(ring.items())
    owner = []
    for i in ids:
        h = cell("" if i is None else str(i))
        owner.append((next((a for a, (at, _) in enumerate(ring) if at >= h >> 44), 0), h))
    return [s for _, s in ring], owner


def plain_shards(rows, shards, nodes, load):
    """Rows one by one: round after round each row that is left asks the next different shard clockwise."""
    sizes = [len(t.encode()) + 1 for _, t in rows]
    crc = [zlib.crc32(t.encode()) for _, t in rows]
    of_arc, owner = plain_ring([i for i, _ in rows], shards, nodes)
    todo = sorted(range(len(rows)), key=lambda k: (owner[k], sizes[k], crc[k], k))
    own = Counter(of_arc[owner[k][0]] for k in todo)
    if load is None:
        odd = sorted(range(shards), key=lambda s: (-own[s], s))[:len(rows) % shards]
        room = [len(rows) // shards + (s in odd) for s in range(shards)]
    else:
        room = [-int(-(load * len(rows)) // shards)] * shards
    filled, out = [0] * shards, {}
    for turn in range(shards):
        left = []
        for k in todo:
            walk = list(dict.fromkeys(of_arc[(owner[k][0] + d) % len(of_arc)] for d in range(len(of_arc))))
            s = walk[turn]
            if filled[s] < room[s]:
                out[k] = (s, filled[s])
                filled[s] += 1
            else:
                left.append(k)
        todo = left
    return [(rows[k][0], sizes[k], crc[k], *out[k]) for k in range(len(rows))]


@pytest.mark.parametrize(("shards", "nodes", "load"), [(16, 64, None), (16, 4, 1.2), (3, 8, None), (1, 2, None), (5, 3, 1.0)])
def test_ring(spark, documents, shards, nodes, load):  # noqa: F811
    rows = [(i, t) for i, t in {i: t for i, t in [*texts_of(AWKWARD), *texts_of(documents)]}.items()]
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id bigint, text string, arc int, _number int").repartition(3)
    got = ring_shards.in_shards(frame, shards, nodes, load).collect()
    assert order(map(tuple, got)) == order(plain_shards(rows, shards, nodes, load))


def test_ring_with_rows_that_repeat(spark, nothing):  # noqa: F811
    """A third of all rows share one id, or have none: shards stay even, slots have no gap, and no task gets an arc whole."""
    rows = [(7, "same")] * 400 + [(None, None)] * 400 + [(k, str(k)) for k in range(100, 500)]
    got = ring_shards.in_shards(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert len(got) == 1200 and {len(v) for v in slots.values()} == {75} and all(sorted(v) == list(range(75)) for v in slots.values())
    assert ring_shards.in_shards(nothing).isEmpty()


def test_ring_moves_few_rows(spark):
    frame = spark.range(20_000).select(ring_shards.F.col("id").alias("doc_id"), ring_shards.F.lit("x").alias("text"))
    places = lambda df, shards, load: {r.doc_id: r.shard for r in ring_shards.in_shards(df, shards, 64, load).collect()}
    for load, grown, more in ((1.25, 0.12, 0.02), (None, 0.25, 0.06)):
        before = places(frame, 16, load)
        after = places(frame, 17, load)
        assert sum(before[i] != after[i] for i in before) < grown * len(before)
        added = places(frame.unionAll(spark.range(20_000, 20_400).selectExpr("id AS doc_id", "'x' AS text")), 16, load)
        assert sum(before[i] != added[i] for i in before) < more * len(before)


def test_ring_query_and_plan(spark, documents):  # noqa: F811
    got = catalog.QUERIES["op12_ring_shards"](spark, SF)
    rows = got.collect()
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(16)) and {r.law for r in rows} == {"rows"}
    plan = got._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "InArrow", "InPandas", "ExistingRDD"))


# ---- periodic runs -------------------------------------------------------------------------------------------------
def plain_runs(w):
    """Every period in turn; a stretch is a run if no divisor of its period is a period of it."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            length = i - s + q
            if length >= max(6, 4 * q) and not any(q % d == 0 and w[s:s + q - d] == w[s + d:s + q] and all(w[s + x] == w[s + x % d] for x in range(q)) for d in range(1, q)):
                out.append((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(i, t, repeat=True):
    w = WORD.findall(t)
    h = zlib.crc32(("" if i is None else str(i)).encode())
    if repeat and h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]
    runs = plain_runs(w)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    return (i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest())


def periodic_texts():
    rng = np.random.default_rng(12)
    out = ["a " * n for n in (5, 6, 7, 40, 700)] + ["a b " * n for n in (2, 3, 4, 100)]
    thue = [0]
    for _ in range(9):
        thue += [1 - x for x in thue]
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 900:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    out += [" ".join(map(str, thue)), " ".join(fibonacci[-1])]
    for k in range(120):
        words = []
        while len(words) < rng.integers(1, 500):
            q = int(rng.integers(1, [3, 9, 40, 90][k % 4]))
            base = [str(x) for x in rng.integers(0, [2, 3, 50][k % 3], q)]
            words += (base * 12)[:int(rng.integers(1, 7 * q + 2))] + [str(x) for x in rng.integers(0, 4, rng.integers(0, 5))]
        out.append("\n ".join(words))
    return out


@pytest.mark.parametrize(("tile", "step"), [(periodic_runs.TILE, periodic_runs.STEP), (32, 700), (64, 1), (256, 4000)])
def test_runs(spark, awkward, nothing, documents, tile, step):  # noqa: F811
    rows = [*[r for r in texts_of(AWKWARD) if r[0] != 10], *[(100 + k, t) for k, t in enumerate(periodic_texts())], *[(1000 + i, t) for i, t in texts_of(documents) if len(t) < 6000]]
    frame = spark.createDataFrame([(i, t, 3, 4) for i, t in rows], "doc_id bigint, text string, uid int, words int").repartition(4)
    got = periodic_runs.collapsed(*periodic_runs.periodic_runs(frame, tile, step, repeat=True)).collect()
    assert order(map(tuple, got)) == order([plain_row(*r) for r in rows])
    assert periodic_runs.collapsed(*periodic_runs.periodic_runs(awkward, tile, step)).count() == len(AWKWARD)
    assert periodic_runs.collapsed(*periodic_runs.periodic_runs(nothing, tile, step)).isEmpty()


def test_tiles_cover_every_stretch():
    """Three blocks in a row, and the words one period further, lie in one tile of their octave."""
    for n in (33, 100, 1000, 5000):
        tiles = periodic_runs.tiles_of(n, 32)
        for k in range(periodic_runs.octaves_of(n)):
            own = [(a, b) for first, after, a, b in tiles if first <= k < after]
            q = min((2 << k) - 1, n // 4)
            assert own and all(any(a <= i and i + min(3 * q, 3 << k) + q <= b for a, b in own) for i in range(n - 4 * q + 1))


def test_runs_query(spark, documents):  # noqa: F811
    got = {r.doc_id: tuple(r) for r in catalog.QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(documents)
    some = [r for r in texts_of(documents) if len(r[1]) < 20_000]
    assert [got[i] for i, _ in some] == [plain_row(i, t) for i, t in some]
