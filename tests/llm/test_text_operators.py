"""The text operators against plain counterparts: on the smallest tables, and on rows made to be awkward."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from pyspark.sql import functions as F

from contactloom.llm import byte_bpe, catalog, decontaminate, digest_index, katz, ngram_join, personal_data, quality, suffix_dedup, toxicity, warc
from contactloom.llm.shared import bytes_of, new_folder

SPACES = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = ("doc_id bigint, text string, digest string, node int, token int, score double, bucket int, id int, hash int, keys int, "
          "row int, n int, kind int, uid int, kept boolean, keep_id int, first int, `rank` int, component int, train boolean")


def passage(n, seed):
    rng = np.random.default_rng(seed)
    return " ".join("w" + str(x) for x in rng.integers(0, 5000, n))


AWKWARD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one two three"), (5, "One  two\nthree"), (6, "one two three"), (6, "one two three"), (None, "one two three"),
    (None, None), (7, passage(300, 1)), (8, passage(300, 1) + " tail"), (9, passage(300, 1)), (10, passage(20_000, 2)), (11, "x" * 5000), (12, "ab " * 900),
    (13, "É日本　語 ́ ~ \U0001F600 <|endoftext|> it's we'll"), (14, "word"), (15, "WORD"), (16, passage(300, 3) + " " + passage(60, 4)),
    (17, passage(60, 4) + " " + passage(300, 5)), (-3, passage(60, 4)),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([(*r, *[None] * 18) for r in AWKWARD], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()


@pytest.fixture(scope="module")
def label_rows(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts_of(rows):
    return [(i, t or "") for i, t in rows]


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_sql(spark, name):
    got = catalog.QUERIES[name](spark, SF)
    db = duckdb.connect()
    for table in ("documents", "pages"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    expected = db.sql(catalog.ORACLES[name])
    assert sorted(got.columns) == sorted(expected.columns)
    assert order(map(tuple, got.select(*expected.columns).collect())) == order(expected.fetchall())


# ---- exact dedup ---------------------------------------------------------------------------------------------------
def test_index_over_two_batches(spark, awkward):
    folder = new_folder(spark, "test-index")
    index = digest_index.DigestIndex(spark, folder, 4)
    rows = {r.doc_id: r for r in digest_index.deduplicate(awkward.filter("doc_id IS NOT NULL"), index).collect()}
    assert (rows[5].keep_id, rows[5].group_size, rows[5].kept) == (5, 1, True)
    assert rows[4].kept and rows[6].keep_id == 4 and rows[6].group_size == 3 and not rows[6].kept
    assert rows[1].keep_id == 1 and rows[2].keep_id == 1 and not rows[2].kept and rows[3].keep_id == 3
    assert rows[9].keep_id == 7
    n = index.table().count()
    index.close()
    again = digest_index.DigestIndex(spark, folder, 4)  # the same folder, opened anew
    later = digest_index.deduplicate(spark.createDataFrame([(0, "one two three"), (99, "new text")], "doc_id bigint, text string"), again)
    assert order(map(tuple, later.select("doc_id", "keep_id", "kept").collect())) == order([(0, 4, False), (99, 99, True)])
    assert again.table().count() == n + 1
    told = [order(map(tuple, digest_index.deduplicate(awkward, index_).collect())) for index_ in [digest_index.new_index(spark)] * 2]
    assert told[0] == told[1] and any(r[3] for r in told[0])  # a batch that is run again gets its verdict again
    copies = awkward.filter("doc_id IS NOT NULL").withColumn("doc_id", F.col("doc_id") + 1000)
    assert digest_index.deduplicate(copies, again).filter("kept").isEmpty()


def test_kept_documents(awkward, nothing):
    kept = digest_index.kept_documents(awkward)
    assert kept.columns == awkward.columns
    expected = {}
    for i, t in texts_of(AWKWARD):
        t = SPACES.sub(" ", t)
        if t not in expected or i is not None and (expected[t] is None or i < expected[t]):
            expected[t] = i
    assert order((r.doc_id,) for r in kept.collect()) == order((i,) for i in expected.values())
    assert digest_index.kept_documents(nothing).isEmpty()
    names = ["__keep", "__digest", "__nth", "key", "row", "digest", "row_id", "id"]
    clashing = awkward.withColumns({n: F.concat(F.lit(n), "text") for n in names})
    again = digest_index.kept_documents(clashing)
    assert again.columns == clashing.columns
    assert again.count() == kept.count() and again.filter(F.col("row_id") != F.concat(F.lit("row_id"), "text")).isEmpty()
    # which of repeated rows stays is open only where all its columns are the same
    assert order((r.doc_id, SPACES.sub(" ", r.text or "")) for r in again.collect()) == order((r.doc_id, SPACES.sub(" ", r.text or "")) for r in kept.collect())


def test_batches_meet_the_index(spark, docs, awkward, nothing, monkeypatch):
    """Query and stage bring the second batch to an index that holds the first."""
    held, add = [], digest_index.DigestIndex.add
    monkeypatch.setattr(digest_index.DigestIndex, "add", lambda self, prints: (held.append(self.table().count()), add(self, prints))[1])
    catalog.QUERIES["op7_exact_dedup"](spark, SF)
    digest_index.kept_documents(docs)
    assert len(held) == 4 and held[0] == held[2] == 0 and held[1] == held[3] > 0
    prints = digest_index.fingerprints(awkward)
    got = digest_index.verdicts(prints, digest_index.add_in_batches(digest_index.new_index(spark), prints)).collect()
    once = digest_index.deduplicate(awkward, digest_index.new_index(spark)).collect()
    told = lambda rows: order((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows)
    assert told(got) == told(once)
    assert sum(r.kept for r in got) == sum(r.kept for r in once) == len({r.text_sha256 for r in got})
    assert digest_index.add_in_batches(digest_index.new_index(spark), digest_index.fingerprints(nothing)).isEmpty()


# ---- byte-pair encoding --------------------------------------------------------------------------------------------
def test_bpe_equals_library(spark, docs, awkward, documents, nothing):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(byte_bpe.vocabulary_path())
    codec = byte_bpe.Codec.build(docs, byte_bpe.vocabulary_path(), 2000)
    for frame, rows in ((docs, documents), (awkward, AWKWARD)):
        got = codec.decode(codec.encode(frame)).collect()
        expected = [(i, library.encode(t, add_special_tokens=False).ids, t) for i, t in texts_of(rows)]
        assert order((r.doc_id, r.ids, r.decoded) for r in got) == order(expected)
    assert codec.encode(nothing).isEmpty()
    assert byte_bpe.Codec.build(nothing, byte_bpe.vocabulary_path()).encode(awkward).count() == len(AWKWARD)


def test_lexicon_is_minimal_and_exact():
    words = [a + b for a in ("walk", "talk", "jump") for b in ("", "s", "ed", "ing")]
    entries = {w.encode(): np.array([k, len(w)], np.int32) for k, w in enumerate(sorted(words))}
    lexicon = byte_bpe.Lexicon.load(byte_bpe.Lexicon.compile(entries).dump())
    ask = [*sorted(words), "wal", "walker", "", "zed"]
    data, off = bytes_of(pa.array(ask))
    assert lexicon.numbers(data, off[:-1], off[1:]).tolist() == [*range(12), -1, -1, -1, -1]
    right = {""}
    for w in words:
        right |= {w[:k] for k in range(len(w) + 1)}
    classes = {frozenset(w[len(p):] for w in words if w.startswith(p)) for p in right}
    assert len(lexicon.accepts) == len(classes)


# ---- personal data -------------------------------------------------------------------------------------------------
def plain_spans(t):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in reversed(m.group()) if c.isdigit()]
        if 14 <= len(d) <= 19 and sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(d)) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(out, key=lambda s: (s[1], personal_data.KINDS.index(s[0])))


def test_plain_detectors_equal_patterns():
    rng = np.random.default_rng(5)
    signs = list("ab@@..-+ 0127 ()9é%1255")
    for _ in range(20_000):
        t = "".join(rng.choice(signs, rng.integers(0, 40)))
        assert personal_data.detect(t) == plain_spans(t), t


@pytest.mark.parametrize(("text", "kind", "span"), [
    ("mail john [at] example (dot) com now", "email", "john [at] example (dot) com"),
    ("x john dot doe at example dot com", "email", "john dot doe at example dot com"),
    ("see jоhn@exаmple.com there", "email", "jоhn@exаmple.com"),
    ("call plus one five five five zero one two three four five six ok", "phone", "plus one five five five zero one two three four five six"),
    ("ip one nine two dot one six eight dot zero dot one", "ip", "one nine two dot one six eight dot zero dot one"),
    ("card ４１１１ １１１１ １１１１ １１１１ x", "card", "４１１１ １１１１ １１１１ １１１１"),
    ("a​b@x​.com", "email", "a​b@x​.com"),
])
def test_disguised(text, kind, span):
    found = personal_data.spans_of(text, True)
    assert [(k, text[a:b], base) for k, a, b, base in found] == [(kind, span, False)]


@pytest.mark.parametrize("text", ["meet me at example.com", "at noon (at) home", "the dot is one", "one two three", "un deux de 1 2"])
def test_not_disguised(text):
    assert personal_data.spans_of(text, True) == []


def test_disguised_in_documents(spark):
    """Each sign of disguise alone in its document, through the step that tells which documents are rewritten."""
    rows = [("mail john@example[.]com now", "email", "john@example[.]com"), ("mail john@example(.)com", "email", "john@example(.)com"),
            ("mail john@example{ . }com", "email", "john@example{ . }com"), ("john[@\t]example.com", "email", "john[@\t]example.com"),
            ("card 4111 1111 1111 111 one", "card", "4111 1111 1111 111 one"), ("card \u00d7four 111 1111 1111 1111", "card", "four 111 1111 1111 1111"),
            ("host 192[.]168[.]1[.]10 up", "ip", "192[.]168[.]1[.]10"), ("host 192.168(dot)1.10 up", "ip", "192.168(dot)1.10"),
            ("john at 10[.]0[.]0[.]com", "email", "john at 10[.]0[.]0[.]com"), ("call +49[.]30[.]12345678", "phone", "+49[.]30[.]12345678")]
    frame = spark.createDataFrame([(k, t) for k, (t, *_) in enumerate(rows)], "doc_id bigint, text string")
    got = {r.doc_id: {(s.kind, rows[r.doc_id][0][s.start:s.end]) for s in r.spans} for r in personal_data.find_personal_data(frame).collect()}
    assert got == {k: {(kind, span)} for k, (_, kind, span) in enumerate(rows)}


def test_what_is_rewritten_shows_a_sign():
    rng = np.random.default_rng(17)
    pieces = ["john", "example", "com", "at", "AT", "dot", "point", "one", "Two", "f\u00fcnf", "plus", "dash", "12", "4111", "7", ".", "@", "[", "]", "(", ")",
              "{", ">", " ", "  ", "\t", "\n", "-", ",", "+", "_", "\u00e9", "\u00d7", "\u00f7", "\u00b2", "\u200b", "x"]
    made = ["".join(rng.choice(pieces, rng.integers(3, 16))) for _ in range(4000)]
    made += [" ".join(rng.choice(pieces[7:15], rng.integers(3, 9))) for _ in range(1000)]
    data, off = bytes_of(pa.array(made))
    shown = personal_data.signs_of_disguise(data, off)
    rewritten = np.array([bool(personal_data.deobfuscate(t).new.any() or personal_data.deobfuscate(t).text != t) for t in made])
    assert rewritten.sum() > 300 and not (rewritten & ~shown).any()


def test_personal_data_of_tables(spark, docs, awkward, documents):
    for frame, rows in ((docs, documents), (awkward, AWKWARD)):
        got = [(r.doc_id, [(s.kind, s.start, s.end) for s in r.spans if s.base]) for r in personal_data.find_personal_data(frame).collect()]
        assert order(got) == order([(i, plain_spans(t)) for i, t in texts_of(rows)])
    for r in catalog.QUERIES["op5_personal_data"](spark, SF).collect():
        base = plain_spans(dict(documents)[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in base) for kind in personal_data.KINDS]


# ---- archives ------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archives_round_trip(spark, compression):
    warc.register(spark)
    rows = [("response", "<a>", "http://x/\r\nWARC/1.1\r\n", b"WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 50, "no"), ("revisit", "<b>", None, None, "no"),
            ("response", "<c>", "http://y", b"", "no"), ("response", "<d>", "http://z", bytes(range(256)) * 2000, "no")]
    frame = spark.createDataFrame(rows, "record_type string, record_id string, target_uri string, payload binary, other string")
    folder = new_folder(spark, "test-warc")
    frame.repartition(2).write.format("warc").mode("append").option("compression", compression).option("file_bytes", 1000).save(folder)
    read = spark.read.format("warc").load(folder)
    got = {r.record_id: r for r in read.collect()}
    assert got["<a>"].payload == rows[0][3] and got["<d>"].payload == rows[3][3] and got["<c>"].payload == b"" and got["<b>"].payload == b""
    assert got["<a>"].target_uri == "http://x/ WARC/1.1" and got["<b>"].target_uri is None
    assert [r.record_id for r in read.filter("record_type = 'revisit'").select("record_id").collect()] == ["<b>"]
    assert read.filter("target_uri LIKE 'http://z%' AND record_type IN ('response', 'x')").select("payload_bytes").first()[0] == 512_000
    only = spark.read.format("warc").schema("record_id string").option("types", "response").load(folder)
    assert sorted(r.record_id for r in only.collect()) == ["<a>", "<c>", "<d>"]
    assert "PushedFilters" in only.filter("record_id = '<a>'")._jdf.queryExecution().toString() or only.filter("record_id = '<a>'").count() == 1


def test_foreign_gzip_members_and_no_files(spark):
    import gzip
    import io

    plain = [b"WARC/1.0\r\nWARC-Type: %s\r\nContent-Length: %d\r\n\r\n" % (kind, len(body)) + body + b"\r\n\r\n"
             for kind, body in ((b"warcinfo", b"x" * 200_000), (b"response", b"HTTP"), (b"response", b""))]
    for raw in (b"".join(map(gzip.compress, plain)), b"".join(plain)):
        for want in (True, False):
            got = list(warc.records(io.BufferedReader(io.BytesIO(raw)), warc.Pushed("response"), want))
            assert [p for _, p in got] == ([b"HTTP", b""] if want else [None, None])
    warc.register(spark)
    assert spark.read.format("warc").load(new_folder(spark, "nowhere")).isEmpty()


def test_awkward_pages(spark):
    rows = [(1, "u", "p" * 200, 1), (2, None, "p" * 200, 1), (None, "u", "p" * 200, 1), (3, "u", None, 1), (4, "u", "", 1), (5, "u", "q" * 99, 1),
            (6, "u", "q" * 99, 1), (1, "u", "p" * 200, 1), (-7, "u", "é" * 50, 1), (8, "u", "é" * 50, 1)]
    folder = new_folder(spark, "test-pages")
    warc.archive_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string, digest int"), folder)
    got = [(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.read_pages(spark, folder).collect()]
    assert order(got) == order([(1, "response", None, 200), (2, "revisit", 1, 200), (None, "revisit", 1, 200), (3, "response", None, 0), (4, "response", None, 0),
                                (5, "response", None, 99), (6, "response", None, 99), (1, "response", None, 200), (-7, "response", None, 100), (8, "revisit", -7, 100)])


def test_no_pages(spark):
    folder = new_folder(spark, "test-no-pages")
    warc.archive_pages(spark.createDataFrame([], "page_id bigint, url string, html string"), folder)
    assert warc.read_pages(spark, folder).isEmpty()


# ---- similarity join -----------------------------------------------------------------------------------------------
def shingles(t, size=4):
    w = WORD.findall(t.translate(FOLD))
    return frozenset(tuple(w[k:k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def plain_components(rows, percent=85, size=4):
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    having = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            having[x].append(k)
    for k, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in having[x] if j < k).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[find(k)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        least.setdefault(find(k), []).append(i)
    return [(rows[k][0], len(sets[k]), min((x for x in least[find(k)] if x is not None), default=None)) for k in range(len(rows))]


def near_family(n, seed):
    """Copies of one text with one to six words changed, and copies of copies."""
    rng = np.random.default_rng(seed)
    base = passage(150, seed).split()
    out = []
    for k in range(n):
        words = list(base if k % 3 or not out else out[rng.integers(len(out))])
        for at in rng.integers(0, len(words), rng.integers(1, 7)):
            words[at] = f"v{rng.integers(200)}"
        out.append(words)
    return [" ".join(w) for w in out]


@pytest.mark.parametrize("orders", [2, 3])
def test_similar_components(spark, awkward, documents, orders):
    rows = [*texts_of(AWKWARD), *[(1000 + k, t) for k, t in enumerate(near_family(150, 7))], *[(5000 + i, t) for i, t in documents]]
    frame = awkward.select("doc_id", "text", "node", "token").unionAll(
        spark.createDataFrame([(i, t, 1, 2) for i, t in rows[len(AWKWARD):]], "doc_id bigint, text string, node int, token int"))
    got = ngram_join.similar_components(frame, orders=orders).collect()
    assert order(map(tuple, got)) == order(plain_components(rows))


def test_similar_components_of_short_texts(spark):
    """Texts of 8 to 20 words with a copy of one or two words more; their phrases stand in other texts too."""
    rng = np.random.default_rng(41)
    phrases = [passage(int(rng.integers(5, 8)), 900 + k).split() for k in range(1200)]
    texts = []
    for k in range(2500):
        words = [w for p in rng.integers(0, len(phrases), int(rng.integers(1, 3))) for w in phrases[p]]
        words += [f"own{k}x{i}" for i in range(int(rng.integers(0, 5)))]
        words = words[:int(rng.integers(8, 19))]
        texts += [words, [*words, f"more{k}"], [f"less{k}", *words]][:int(rng.integers(1, 4))]
    rows = [(k, " ".join(w)) for k, w in enumerate(texts)]
    got = ngram_join.similar_components(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert order(map(tuple, got)) == order(plain_components(rows))


def linking_family(n, seed):
    """Copies of one text that choose among a few words in five places and have a word of their own; most link."""
    rng = np.random.default_rng(seed)
    base = passage(150, seed).split()
    out = []
    for k in range(n):
        words = list(base)
        for place in range(10, 150, 30):
            if rng.random() < 0.5:
                words[place] = f"x{rng.integers(3)}"
        words[149 - int(rng.integers(3))] = f"own{k}"
        out.append(" ".join(words))
    return out


def test_later_pairs_do_not_grow_with_the_square_of_a_family(spark, monkeypatch):
    """Pairs across components tie nodes together; a group does not write all that may link (2,688 here)."""
    written, settle = {}, ngram_join.settle

    def counted(df, label):
        out = settle(df, label)
        written.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "settle", counted)
    rows = list(enumerate(linking_family(300, 5)))
    got = ngram_join.similar_components(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert order(map(tuple, got)) == order(plain_components(rows))
    assert 0 < sum(written["ngram-later"]) < len(rows) and len(written["ngram-candidates"]) == 1


def test_similar_components_in_blocks(spark, monkeypatch):
    """Groups and clusters cut into pairs of blocks give the same components, two families of them and texts of their own."""
    monkeypatch.setattr(ngram_join, "BLOCK", 40)
    monkeypatch.setattr(ngram_join, "SET_BLOCK", 3000, raising=False)
    rows = list(enumerate([*linking_family(200, 5), *near_family(150, 7), *(passage(60, 500 + k) for k in range(20))]))
    got = ngram_join.similar_components(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert order(map(tuple, got)) == order(plain_components(rows))


def test_ties():
    """Of the pairs those stay that tie two trees, in one call or the next."""
    tree = np.arange(6)
    assert ngram_join._ties(tree, np.array([0, 1, 2, 2, 3]), np.array([1, 0, 1, 0, 3])).sum() == 2
    assert tree.tolist() == [0, 0, 0, 3, 4, 5]
    assert ngram_join._ties(tree, np.array([5, 4, 5, 2]), np.array([4, 1, 0, 5])).sum() == 2
    assert tree.tolist() == [0, 0, 0, 3, 0, 0]


def test_bitmaps_tell_near_copies_from_links():
    """Sets of 300 of which 270 are common (0.82) mostly go by their bitmaps alone; with 280 in common (0.875) none goes."""
    rng, measure = np.random.default_rng(7), ngram_join.Measure()

    def may(common):
        token = rng.integers(0, 1 << ngram_join.HASH_BITS, (100, 600 - common), dtype=np.uint64)
        x, y = (ngram_join.bitmaps(np.repeat(np.arange(100), 300), side.ravel(), 100) for side in (token[:, :300], token[:, -300:]))
        most = 300 - np.maximum(np.bitwise_count((x & ~y).view(np.uint64)).sum(1), np.bitwise_count((y & ~x).view(np.uint64)).sum(1)).astype(int)
        return int((100 * most >= measure.percent * (600 - most)).sum())

    assert may(270) < 10 and may(280) == 100


def test_similar_components_of_nothing(nothing):
    assert ngram_join.similar_components(nothing).isEmpty()


def test_components_of_a_long_chain(spark):
    from contactloom.llm.components import components

    got = components(spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101)], "a bigint, b bigint"))
    assert {r.node: r.component for r in got.collect()} == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}


# ---- repeated passages ---------------------------------------------------------------------------------------------
def plain_removal(rows, length=100):
    """Rows of one id and text are one document; of different texts with one id the order is not told here."""
    seen, out = set(), {}
    for i, t in sorted(dict.fromkeys(rows), key=lambda r: (r[0] is None, r[0])):
        raw = t.encode()
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - length + 1):
            if raw[s:s + length] in seen:
                gone[s:s + length] = True
            seen.add(raw[s:s + length])
        out[i, t] = (len(raw), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), np.frombuffer(raw, np.uint8)[~gone].tobytes())
    return [(i, *out[i, t]) for i, t in rows]


def removal(frame):
    return order((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.removed), len(r.removed), bytes(r.kept)) for r in suffix_dedup.without_repeats(frame).collect())


def test_repeats_are_removed(spark, awkward, docs, documents, nothing):
    rows = [r for r in texts_of(AWKWARD) if r[0] is not None]
    assert removal(awkward.filter("doc_id IS NOT NULL")) == order(plain_removal(rows))
    assert removal(docs) == order(plain_removal(documents))
    assert suffix_dedup.without_repeats(nothing).isEmpty()


def test_repeats_in_periodic_text(spark):
    rng = np.random.default_rng(3)
    rows = [(k, "".join(rng.choice(list("ab"), rng.integers(90, 400))) + "xy" * int(rng.integers(0, 150)) + "é" * int(rng.integers(0, 80))) for k in range(40)]
    rows += [(50 + k, rows[k][1][5:] + rows[k + 1][1]) for k in range(20)]
    assert removal(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)) == order(plain_removal(rows))


# ---- language model ------------------------------------------------------------------------------------------------
def katz_rows(spark, rows, vocabulary):
    frame = spark.createDataFrame([(i, t, k % 4 != 0) for k, (i, t) in enumerate(rows)], "doc_id bigint, text string, train boolean")
    model = katz.KatzModel.train(frame, vocabulary)
    return model, model.score(frame)


@pytest.mark.parametrize("vocabulary", [300, 1 << 17])
def test_katz_base_scores(spark, documents, vocabulary):
    rows = [*[r for r in texts_of(AWKWARD) if r[0] != 6], *documents[20:60]]
    model, scored = katz_rows(spark, rows, vocabulary)
    tokens = [[*WORD.findall(t.translate(FOLD)), None] for _, t in rows]
    counts = Counter(w for k, own in enumerate(tokens) if k % 4 for w in own)
    n, v = sum(counts.values()), len(counts)
    expected = order((i, len(own), sum(counts[w] > 0 for w in own)) for (i, _), own in zip(rows, tokens, strict=True))
    got = scored.collect()
    assert order((r.doc_id, r.n_tokens, r.n_known) for r in got) == expected
    assert (model.uni.tokens, model.uni.types) == (n, v)
    base = order((round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own), 6),) for own in tokens)
    assert np.allclose([float(x[0]) for x in base], [float(x[0]) for x in order((round(r.base_score, 6),) for r in got)])
    assert all(r.score < 0 for r in got)


def plain_discounts(counts):
    of = Counter(counts)
    tail = 6 * of[6] / of[1] if of[1] else 1
    out = {}
    for r in range(1, 6):
        d = ((r + 1) * of[r + 1] / (r * of[r]) - tail) / (1 - tail) if of[r] and tail != 1 else 0
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


class PlainKatz:
    """Katz backoff over dictionaries."""

    def __init__(self, tokens):
        self.words = Counter(w for own in tokens for w in own)
        self.pairs = Counter(p for own in tokens for p in zip(["<s>", *own], own, strict=False))
        self.n, self.d, self.pd = sum(self.words.values()), plain_discounts(self.words.values()), plain_discounts(self.pairs.values())
        self.halved = all(c > 5 for c in self.words.values())
        of = Counter(self.words.values())
        self.unseen = max(1, of[1] ** 2 / (2 * of[2]) if of[2] else of[1] * (of[1] - 1) / 2)
        self.after = {}
        for (h, w), c in self.pairs.items():
            self.after.setdefault(h, {})[w] = c

    def word(self, w):
        if w not in self.words:
            return (1 - sum(self.word(x) for x in self.words)) / self.unseen
        c = self.words[w]
        return (c - 0.5 if self.halved else self.d.get(c, 1) * c) / self.n

    def seen(self, h):
        after = self.after.get(h, {})
        small = any(c <= 5 for c in after.values())
        return {w: (self.pd.get(c, 1) * c if small else c - 0.5) / sum(after.values()) for w, c in after.items()}

    def alpha(self, h):
        seen = self.seen(h)
        return (1 - sum(seen.values())) / (1 - sum(self.word(w) for w in seen))

    def score(self, own):
        total = 0.0
        for h, w in zip(["<s>", *own], own, strict=False):
            seen = self.seen(h)
            total += math.log10(seen[w] if w in seen else self.alpha(h) * self.word(w))
        return total


def test_katz_equals_dictionaries(spark, documents):
    """Scores do not depend on which words have short codes, and are those of the formula, which sum to one."""
    rows = [(i, " ".join(t.split()[:60])) for i, t in documents[:50]] + [(1000 + i, t) for i, t in [(0, "never seen words"), (1, ""), (2, "A a  A a")]]
    tokens = [[*WORD.findall(t.translate(FOLD)), None] for _, t in rows]
    plain = PlainKatz([own for k, own in enumerate(tokens) if k % 4])
    assert abs(sum(map(plain.word, plain.words)) + plain.unseen * plain.word("never-seen") - 1) < 1e-9
    for h in ["<s>", *list(plain.words)[:5]]:
        seen = plain.seen(h)
        rest = 1 - sum(plain.word(w) for w in seen)
        assert abs(sum(seen.values()) + plain.alpha(h) * rest - 1) < 1e-9
    expected = {i: plain.score(own) for (i, _), own in zip(rows, tokens, strict=True)}
    for vocabulary in (1, 40, 1 << 17):
        got = {r.doc_id: r.score for r in katz_rows(spark, rows, vocabulary)[1].collect()}
        assert got.keys() == expected.keys()
        assert all(math.isclose(got[i], expected[i], rel_tol=1e-9, abs_tol=1e-9) for i in got)


def test_katz_without_small_counts(spark):
    """Where no count is small, half a count is taken off, so an unseen word scores low, not minus infinity."""
    rows = [(k, "a b " * 8) for k in range(8)] + [(9, "zz a")]
    got = {r.doc_id: r.score for r in katz_rows(spark, rows, 1)[1].collect()}
    plain = PlainKatz([[*t.split(), None] for k, (_, t) in enumerate(rows) if k % 4])
    assert math.isfinite(got[9]) and math.isclose(got[0], plain.score([*rows[0][1].split(), None]), rel_tol=1e-9)


def test_katz_without_training_text(spark, nothing):
    frame = spark.createDataFrame([(1, "a b", False), (2, None, False)], "doc_id bigint, text string, train boolean")
    got = katz.KatzModel.train(katz.texts(frame, frame["train"])).score(katz.texts(frame)).collect()
    assert order((r.doc_id, r.n_tokens, r.score == r.base_score) for r in got) == order([(1, 3, True), (2, 1, True)])


def test_katz_of_nothing(nothing):
    model = katz.KatzModel.train(nothing.select("text", "train"))
    assert model.score(nothing.select("doc_id", "text")).isEmpty() and model.uni.tokens == 0


def test_katz_beats_the_base_on_held_out_text(spark, documents):
    rows = catalog.QUERIES["op9_katz"](spark, SF).collect()
    assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in rows)


# ---- decontamination -----------------------------------------------------------------------------------------------
def test_leaks(spark, nothing):
    item = passage(40, 21)
    words = item.split()
    edited = [w if k % 6 else "changed" for k, w in enumerate(words)]
    swapped = words[:10] + ["extra", "words"] + words[10:25] + words[28:]
    rows = [(1, "before " + item.upper() + " after"), (2, passage(200, 22)), (3, " ".join(["x"] * 50 + edited + ["y"] * 50)), (4, " ".join(swapped)),
            (5, " ".join(words[:6]) + " " + passage(80, 23)), (6, None), (7, ""), (None, item), (8, (item + " ") * 30), (1, "before " + item.upper() + " after"),
            (9, passage(20_000, 24) + " " + item)]
    frame = spark.createDataFrame([(*r, 1.0, 2) for r in rows], "doc_id bigint, text string, score double, item_id int")
    tests = spark.createDataFrame([(70, item, "a"), (71, None, "a"), (72, "", "a"), (73, passage(35, 25), "a"), (None, "w0 qq", "a")], "item_id bigint, text string, doc_id string")
    for blocks in (1 << 20, 40):
        got = decontaminate.contaminated(frame, tests, block_seeds=blocks).collect()
        assert order((r.doc_id, r.item_id) for r in got) == order([(1, 70), (1, 70), (3, 70), (4, 70), (None, 70), (8, 70), (9, 70)])
        spans = {r.doc_id: rows[[x[0] for x in rows].index(r.doc_id)][1][r.start:r.end] for r in got}
        assert spans[1] == item.upper() and spans[9] == item and spans[4] == " ".join(swapped)
        assert order((r.doc_id,) for r in decontaminate.clean_documents(frame, tests, block_seeds=blocks).collect()) == order([(2,), (5,), (6,), (7,)])
    assert decontaminate.contaminated(nothing, tests).isEmpty()
    assert decontaminate.contaminated(frame, tests.filter("false")).isEmpty()
    assert decontaminate.clean_documents(frame, tests.filter("false")).count() == len(rows)


def test_exact_leaks_of_tables(spark, documents):
    pattern = re.compile(r"[A-Za-z\u0080-\U0010ffff]+|[0-9]+")
    plain = lambda t: f" {' '.join(pattern.findall(t.lower()))} "
    items = [(i, plain(t)) for i, t in duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()]
    expected = {(d, i) for d, t in documents for i, x in items if x in plain(t)}
    got = {(r.doc_id, r.item_id) for r in catalog.QUERIES["op10_decontaminate"](spark, SF).collect()}
    assert expected <= got and len(got - expected) <= 0.1 * len(expected) + 1


def edited(words, rate, rng):
    """Words with some replaced, left out, or followed by one or two others."""
    out = []
    for w in words:
        kind = rng.integers(0, 4) if rng.random() < rate else -1
        out += {-1: [w], 0: ["other"], 1: [], 2: [w, "more"], 3: [w, "some", "more"]}[int(kind)]
    return out


def test_leaks_equal_aligning_everything(spark):
    """Every pair of a document and an item, exact copies present or not, against the full table of alignment scores."""
    rng = np.random.default_rng(31)
    letters = lambda n, seed: passage(int(n), seed).translate(str.maketrans("0123456789", "abcdefghij")).split()
    items = [letters(rng.integers(4, 40), 100 + k) for k in range(20)]
    texts = [items[k % 20] if k < 10 else edited(items[k % 20], rng.uniform(0.1, 0.8), rng) for k in range(160)]
    texts += [[w if k % 5 != 3 else "other" for k, w in enumerate(items[4])], [x for w in items[5] for x in (w, "more")],
              [w if k % 3 else "other" for k, w in enumerate(items[6])]]
    texts = [letters(rng.integers(0, 60), 300 + k) + t + letters(rng.integers(0, 60), 600 + k) for k, t in enumerate(texts)]
    number = {w: 4 * k for k, w in enumerate(sorted({w for t in (*items, *texts) for w in t}))}
    coded = lambda t: np.array([number[w] for w in t], np.uint64)
    best = {(d, i): decontaminate.align([coded(t)], [coded(x)])[0][0] / (2 * len(x)) for d, t in enumerate(texts) for i, x in enumerate(items)}
    frame = spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(texts)], "doc_id bigint, text string").repartition(3)
    tests = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id bigint, text string")
    for threshold in (0.5, 0.8):
        expected = {k: s for k, s in best.items() if s >= threshold}
        got = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(frame, tests, threshold=threshold).collect()}
        assert len(expected) > 40 and got == pytest.approx(expected)


def test_alignment_scores():
    rng = np.random.default_rng(9)
    for _ in range(200):
        a, b = rng.integers(4, 9, rng.integers(1, 25)).astype(np.uint64), rng.integers(4, 9, rng.integers(1, 12)).astype(np.uint64)
        table = np.zeros((len(b) + 1, len(a) + 1), int)
        for i in range(1, len(b) + 1):
            for j in range(1, len(a) + 1):
                table[i, j] = max(0, table[i - 1, j - 1] + (2 if a[j - 1] | 2 == b[i - 1] | 2 else -1), table[i - 1, j] - 1, table[i, j - 1] - 1)
        best, end = decontaminate.align([a], [b])
        assert best[0] == table.max() and (best[0] == 0 or table[:, end[0]].max() == table.max())


# ---- classifiers ---------------------------------------------------------------------------------------------------
def auc(rows):
    yes, no = [s for s, y in rows if y], [s for s, y in rows if not y]
    return np.mean([(a > b) + 0.5 * (a == b) for a in yes for b in no])


@pytest.mark.parametrize(("name", "label", "modulus", "rest", "least"), [("op1_quality", "quality", 5, 0, 0.9), ("op6_toxicity", "toxic", 4, 2, 0.75)])
def test_held_out_accuracy(spark, name, label, modulus, rest, least):
    folder = Path(SF).parent / "sf0.01"
    rows = catalog.QUERIES[name](spark, str(folder)).collect()
    labels = dict(duckdb.sql(f"SELECT doc_id, {label} FROM '{folder}/labels.parquet'").fetchall())
    assert len(rows) == duckdb.sql(f"SELECT count(*) FROM '{folder}/documents.parquet'").limit(1).fetchall()[0][0]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == rest) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert auc(held) > least


def test_classifiers_on_awkward_rows(spark, awkward, nothing, docs, label_rows):
    model = toxicity.fit(docs, label_rows)
    assert toxicity.score(awkward, model).count() == len(AWKWARD)
    assert toxicity.without_toxic(awkward, model, 2.0).columns == awkward.columns
    assert toxicity.without_toxic(awkward, model, 2.0).count() == len(AWKWARD) and toxicity.without_toxic(awkward, model, 0.0).isEmpty()
    vectors = quality.word_vectors(docs)
    own = quality.document_vectors(awkward, vectors)
    net = quality.fit(quality.document_vectors(docs, vectors), label_rows)
    scores = {(r.doc_id, r.score) for r in quality.score(own, net).collect()}
    assert len({s for i, s in scores if i in (1, 2, 3)}) == 1 and len({s for i, s in scores if i in (4, 6)}) == 1
    none = label_rows.filter("false")
    assert {r.score for r in quality.score(own, quality.fit(own, none)).collect()} == {0.5}
    assert {round(r.score, 4) for r in toxicity.score(awkward, toxicity.fit(docs, none)).collect()} == {0.0}
    assert quality.score(quality.document_vectors(nothing, quality.word_vectors(nothing)), net).isEmpty()
    assert toxicity.score(nothing, toxicity.fit(nothing, label_rows)).isEmpty()


def test_risk_stays_positive():
    """With 4 of 5 unlabelled documents negative, the classifier finds the feature of the positive ones."""
    rng = np.random.default_rng(2)
    positive = [np.array([0, *rng.integers(2, 40, 5)]) for _ in range(60)]
    unlabelled = [np.array([0 if k % 5 == 0 else 1, *rng.integers(2, 40, 5)]) for k in range(600)]
    w, _ = toxicity.train(positive, unlabelled, 40, 0.2)
    assert w[0] > 0.5 > w[1]
