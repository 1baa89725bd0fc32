"""Quality classifier: random-indexing word vectors, pooled per document, under a two-layer network.

Every word has an index vector with a few +1 and -1, which its hash tells.  A word's vector is the sum of the index
vectors of its neighbours over all texts, of length one after that; the vectors of ``ROWS`` hash classes of words are
kept.  Words are runs of letters, of digits or of other signs; a word in capitals is another word than in small
letters.  A document is the mean of its words' vectors.  The network (tanh, then a logistic unit) is trained with numpy
on at most ``most`` labelled documents, and a temperature fitted on a fifth of these, which the weights never saw,
calibrates its probabilities.

Null and empty text is the zero vector and gets the score of that.  Labels that are null, or of unknown documents, are
not used; a document with several labels counts once for each.  Without two classes to learn from, every score is the
share of label 1, and 0.5 without any label.  Repeated rows are scored alike; only doc_id and text of the documents are
read.  Words of a text of any length are worked off in slices."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm.shared import (bytes_of, class_runs, crc_of_id, hash_spans, settle, slices, smallest_by_hash, sum_blocks,
                                    texts)

DIM, ROWS, BLOCK_ROWS, WINDOW, MARKS = 64, 1 << 14, 64, 2, 4
_CAPITAL = np.zeros(256, np.uint8)
_CAPITAL[65:91] = 1


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word of consecutive texts."""
    starts, ends, kind = class_runs(data, off)
    h = hash_spans(data, starts, ends)
    capitals = np.concatenate([[0], np.cumsum(_CAPITAL[data])])
    loud = (kind == 1) & (ends - starts > 1) & (capitals[ends] - capitals[starts] == ends - starts)
    return np.where(loud, ~h, h), np.searchsorted(off, starts, side="right") - 1


def add_contexts(total: np.ndarray, h: np.ndarray, row: np.ndarray) -> None:
    """Add to each word's vector the index vectors of the words up to WINDOW before and after it."""
    own = (h % np.uint64(ROWS)).astype(np.int64) * DIM
    places, signs = [], []
    for k in range(1, WINDOW + 1):
        same = row[:-k] == row[k:]
        for a, b in ((own[:-k][same], h[k:][same]), (own[k:][same], h[:-k][same])):
            for m in range(MARKS):
                bits = b >> np.uint64(16 + 8 * m)
                places.append(a + (bits % np.uint64(DIM)).astype(np.int64))
                signs.append(np.where(bits & np.uint64(128), 1.0, -1.0))
    total += np.bincount(np.concatenate(places), np.concatenate(signs), ROWS * DIM)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Vectors of all hash classes of words, over all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ROWS * DIM)
        for batch in batches:
            data, off = bytes_of(batch.column(0))
            for i, j in slices(off):
                h, row = word_hashes(data[off[i]:off[j]], off[i:j + 1] - off[i])
                if len(h) > 1:
                    add_contexts(total, h, row)
        blocks = total.astype(np.float32).reshape(-1, BLOCK_ROWS * DIM)
        some = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([blocks[k].tobytes() for k in some], pa.binary())],
                                         ["block", "values"])

    summed = sum_blocks(texts(docs).select("text").mapInArrow(run, "block int, values binary"), "word-vectors")
    out = np.zeros((ROWS // BLOCK_ROWS, BLOCK_ROWS * DIM), np.float32)
    for r in summed.collect():  # as many as there are blocks of hash classes, whatever the corpus
        out[r.block] = np.frombuffer(r.values, np.float32)
    out = out.reshape(ROWS, DIM)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def document_vectors(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    """(doc_id, vector float32 binary) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = bytes_of(batch.column(1))
            out = np.zeros((batch.num_rows, DIM), np.float32)
            for i, j in slices(off):
                h, row = word_hashes(data[off[i]:off[j]], off[i:j + 1] - off[i])
                if len(h):
                    place = np.flatnonzero(np.diff(row, prepend=-1))
                    n = np.diff(np.append(place, len(row)))
                    at = (h % np.uint64(ROWS)).astype(np.int64)
                    out[i + row[place]] = np.add.reduceat(shared.value[at], place, axis=0) / n[:, None]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v.tobytes() for v in out], pa.binary())],
                                             ["doc_id", "vector"])

    rows = texts(docs)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, vector binary")


@dataclass
class Network:
    """tanh layer and logistic unit over standardised inputs; ``temperature`` divides the logit."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.tanh((x - self.mean) / self.scale @ a + b) @ c[:, 0] + d[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))


def constant(share: float) -> Network:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return Network(np.zeros(DIM), np.ones(DIM), [np.zeros((DIM, 1)), np.zeros(1), np.zeros((1, 1)), np.array([np.log(share / (1 - share))])])


def train(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, seed: int = 7) -> Network:
    """Adam on the logistic loss with a little decay; the temperature that fits the part held back is then found."""
    if len(y) < 10 or y.min() == y.max():
        return constant(float(y.mean()) if len(y) else 0.5)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held, used = order[:len(y) // 5], order[len(y) // 5:]
    net = Network(x[used].mean(0), x[used].std(0) + 1e-6,
                  [rng.normal(0, DIM**-0.5, (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, (hidden, 1)), np.zeros(1)])
    z = (x - net.mean) / net.scale
    first, second = ([np.zeros_like(w) for w in net.weights] for _ in range(2))
    step = 0
    for _ in range(epochs):
        shuffled = rng.permutation(used)
        for k in range(0, len(shuffled), 128):
            rows = shuffled[k:k + 128]
            a, b, c, d = net.weights
            mid = np.tanh(z[rows] @ a + b)
            p = 1 / (1 + np.exp(-np.clip(mid @ c[:, 0] + d[0], -50, 50)))
            back = ((p - y[rows]) / len(rows))[:, None]
            inner = back @ c.T * (1 - mid**2)
            grads = [z[rows].T @ inner + 1e-4 * a, inner.sum(0), mid.T @ back + 1e-4 * c, back.sum(0)]
            step += 1
            for w, g, m, v in zip(net.weights, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    raw = net.logits(x[held])
    tries = np.exp(np.linspace(-2, 3, 101))
    net.temperature = float(min(tries, key=lambda t: np.mean(np.logaddexp(0, raw / t) - y[held] * raw / t)))
    return net


def fit(vectors: DataFrame, labels: DataFrame, most: int = 20_000) -> Network:
    """Train on at most ``most`` rows of labels (doc_id, quality), those whose hashed id is smallest.  Join and limit
    run on ids and labels; only the vectors of the sample come to the driver (``most`` times 64 floats)."""
    given = smallest_by_hash(labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", "quality"), most)
    rows = vectors.join(F.broadcast(given), "doc_id").select("doc_id", "vector", "quality").collect()
    rows.sort(key=lambda r: r.doc_id)
    x = np.frombuffer(b"".join(r.vector for r in rows), np.float32).reshape(-1, DIM).astype(np.float64)
    return train(x, np.array([r.quality for r in rows], np.float64))


def score(vectors: DataFrame, net: Network) -> DataFrame:
    """(doc_id, score) of every row of document vectors."""
    shared = vectors.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float32).reshape(-1, DIM)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.scores(x.astype(np.float64)))], ["doc_id", "score"])

    return vectors.mapInArrow(run, f"doc_id {vectors.schema['doc_id'].dataType.simpleString()}, score double")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    vectors = settle(document_vectors(docs, word_vectors(docs)), "document-vectors")
    net = fit(vectors, labels.filter(crc_of_id() % 5 != 0))
    return score(vectors, net).select("doc_id", (crc_of_id() % 5 == 0).alias("held_out"), "score",
                                      (F.col("score") >= 0.3).cast("int").alias("predicted"))
