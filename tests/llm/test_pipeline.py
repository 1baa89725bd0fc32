"""The pipeline: every stage against a plain counterpart on what it was given."""

import re

import duckdb
import pytest
from conftest import SF
from pyspark.sql import functions as F
from test_text_operators import SPACES, plain_components

import corpus_pipeline
from contactloom.llm import byte_bpe, decontaminate, toxicity
from contactloom.llm.shared import crc_of_id, settle


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, given = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "BPE encoding and decoding"]
    results = []
    for _, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, SF), "test-stage")
        results.append(docs)
    assert all(r.columns == columns for r in results[:-1])
    ids = [{r.doc_id for r in x.select("doc_id").collect()} for x in results]

    seen = crc_of_id() % 4 != 2
    whole = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fit(whole.filter(seen), spark.read.parquet(f"{SF}/labels.parquet").filter(seen))
    assert ids[0] == {r.doc_id for r in toxicity.score(whole, model).filter(f"score < {toxicity.THRESHOLD}").collect()}

    first = {}
    for i in sorted(ids[0]):
        first.setdefault(SPACES.sub(" ", given[i] or ""), i)
    assert ids[1] == set(first.values())

    assert ids[2] == {i for i, n, c in plain_components([(i, given[i] or "") for i in sorted(ids[1])], 80, 5) if c == i or not n}

    leaks = decontaminate.contaminated(results[2], spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert ids[3] == ids[2] - {r.doc_id for r in leaks.collect()}
    pattern = re.compile(r"[A-Za-z\u0080-\U0010ffff]+|[0-9]+")
    plain = lambda t: f" {' '.join(pattern.findall(t.lower()))} "
    items = [plain(t) for _, t in duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()]
    assert not any(x in plain(given[i]) for i in ids[3] for x in items)

    vocab = byte_bpe.Vocabulary.read(byte_bpe.vocabulary_path())
    assert ids[4] == ids[3]
    for r in results[4].collect():
        raw = b"".join(vocab.token_bytes[vocab.token_off[k]:vocab.token_off[k + 1]].tobytes() for k in r.ids)
        assert raw.decode() == given[r.doc_id] and r.n_tokens == len(r.ids)


def test_near_copies_by_five_words(spark):
    words = [f"w{k}" for k in range(49)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:24], "other", *words[25:]])), (3, " ".join(["x", *words[:20], "y", *words[21:40], "z"]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, SF).orderBy("doc_id").collect()] == [1, 3]


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]


CLASHING = ["digest", "key", "row", "row_id", "id", "keep_id", "__keep", "__digest", "score", "predicted", "component_id", "n_shingles", "item_id",
            "tokens", "bucket", "kept", "ids", "words", "train", "_salt", "node", "sets"]


@pytest.mark.parametrize("k", range(5))
def test_stages_on_awkward_input(spark, k):
    """Null ids and texts, empty and repeated rows, ties, and columns with names that stages use themselves."""
    name, stage = corpus_pipeline.STAGES[k]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(900001, text), (900001, text), (900002, text), (None, text), (None, None), (900003, None), (900004, ""), (900005, " \t"), (900006, "x")]
    odd = spark.createDataFrame(rows, "doc_id bigint, text string").select(
        *[F.col(c) if c in ("doc_id", "text") else F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
    extra = [c for c in CLASHING if c not in docs.columns]
    clashing = odd.withColumns({c: F.lit(c) for c in extra})
    got = settle(stage(spark, clashing, SF), "awkward-stage")
    last = k == len(corpus_pipeline.STAGES) - 1
    plain = settle(stage(spark, odd, SF), "awkward-stage")
    assert got.count() == plain.count()
    if not last:
        assert got.columns == clashing.columns
        assert not got.filter(F.col("doc_id") == 900006).isEmpty(), "a clean short text stays"
        if name == "exact dedup":
            assert got.filter(F.col("text") == text).count() == 1
    empty = settle(stage(spark, clashing.filter("false"), SF), "awkward-stage")
    assert empty.isEmpty()
