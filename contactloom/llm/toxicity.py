"""Toxicity by non-negative positive-unlabelled learning.

Known are some toxic documents and many of which nothing is known.  The risk of a classifier over the unknown ones is
corrected by the share of toxic documents (the prior): R = prior * E_P[l(+)] + max(0, E_U[l(-)] - prior * E_P[l(-)]); where the
second term would fall below zero, its gradient is followed the other way.  Labels 0 serve for the prior alone.

Features are words (runs of letters) and their first 4, 5 and 6 bytes, in small letters, by hash; of these the
``features`` that tell the toxic sample best from all documents are kept, four for each toxic document at most, and a
document has each of them or not.  Features are counted over all documents; the classifier is trained on bounded samples
(``positives`` and ``unlabelled`` documents, those whose hashed id is smallest, one row of each id), with weights held
the closer to zero the fewer toxic documents there are.  Every document is scored on its whole text.

Null and empty text has no feature and gets the score of that.  Without a toxic example, or without an unlabelled text,
every score is the prior (0 without labels).  Repeated rows are scored alike; only doc_id and text are read."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm.shared import bytes_of, class_runs, crc_of_id, hash_spans, lean, settle, slices, smallest_by_hash, sum_blocks, texts

SPACE_BITS = 18
PREFIXES = (4, 5, 6)


def feature_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature (a number below 2**SPACE_BITS) and row, for every word and prefix of consecutive texts."""
    starts, ends, kind = class_runs(data, off)
    starts, ends = starts[kind == 1], ends[kind == 1]
    row = np.searchsorted(off, starts, side="right") - 1
    hashes, rows = [hash_spans(data, starts, ends)], [row]
    for n in PREFIXES:
        longer = ends - starts > n
        hashes.append(~hash_spans(data, starts[longer], starts[longer] + n))
        rows.append(row[longer])
    return (np.concatenate(hashes) >> np.uint64(64 - SPACE_BITS)).astype(np.int64), np.concatenate(rows)


def has_features(data: np.ndarray, off: np.ndarray, chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs; ``chosen`` gives the new number of each feature, -1 for those left out."""
    f, row = feature_hashes(data, off)
    if chosen is not None:
        f = chosen[f]
        row, f = row[f >= 0], f[f >= 0]
    key = np.unique(row << SPACE_BITS | f)
    return key >> SPACE_BITS, key & ((1 << SPACE_BITS) - 1)


@dataclass
class Model:
    chosen: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        row, f = has_features(data, off, self.chosen)
        z = np.bincount(row, self.weights[f], len(off) - 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def constant(share: float) -> Model:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return Model(np.full(1 << SPACE_BITS, -1, np.int32), np.zeros(1), float(np.log(share / (1 - share))))


def choose(positive: np.ndarray, unlabelled: np.ndarray, n_positive: int, n_unlabelled: int, features: int) -> np.ndarray:
    """Features with the largest log ratio of document shares, weighted by the root of how often it is met."""
    ratio = np.log((positive + 0.5) / (n_positive + 1)) - np.log((unlabelled + 0.5) / (n_unlabelled + 1))
    weight = np.abs(ratio) * np.sqrt(np.maximum(positive, unlabelled * n_positive / max(1, n_unlabelled)))
    best = np.argsort(-weight, kind="stable")[:features]
    best = best[weight[best] > 0]
    chosen = np.full(len(positive), -1, np.int32)
    chosen[best] = np.arange(len(best))
    return chosen


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], size: int, prior: float, epochs: int = 30,
          seed: int = 11, decay: float = 2e-4) -> tuple[np.ndarray, float]:
    """Logistic classifier under the non-negative risk, by Adam over batches with both kinds of documents."""
    rng = np.random.default_rng(seed)
    w = np.zeros(size + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    step, batches = 0, max(1, len(unlabelled) // 512)

    def dense(rows: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(rows), size + 1), np.float32)
        out[:, -1] = 1
        for k, r in enumerate(rows):
            out[k, r] = 1
        return out

    def sigmoid(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))

    for _ in range(epochs):
        order_p, order_u = rng.permutation(len(positive)), rng.permutation(len(unlabelled))
        for part_p, part_u in zip(np.array_split(order_p, batches), np.array_split(order_u, batches), strict=True):
            part_p = part_p if len(part_p) else order_p[:1]
            p, u = dense([positive[k] for k in part_p]), dense([unlabelled[k] for k in part_u])
            zp, zu = p @ w, u @ w
            grad_plus = prior * ((sigmoid(zp) - 1) @ p) / len(p)
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            grad_minus = sigmoid(zu) @ u / len(u) - prior * (sigmoid(zp) @ p) / len(p)
            grad = grad_plus + grad_minus if negative >= 0 else -grad_minus
            grad[:-1] += decay * w[:-1]
            step += 1
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            w -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


#: Parts that a vector of counts travels in.
BLOCKS = 16


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each feature, in BLOCKS parts of a vector, and their number."""
    counts, n = np.zeros(1 << SPACE_BITS, np.int64), 0
    for batch in batches:
        data, off = bytes_of(batch.column(0))
        n += batch.num_rows
        for i, j in slices(off):
            _, f = has_features(data[off[i]:off[j]], off[i:j + 1] - off[i])
            counts += np.bincount(f, minlength=1 << SPACE_BITS)
    parts = [*np.split(counts.astype(np.float64), BLOCKS), np.array([n], np.float64)]
    yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS + 1), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())], ["block", "values"])


def document_counts(rows: DataFrame, label: str) -> tuple[np.ndarray, int]:
    """The sums of these over all rows of (text): a vector of fixed size, added up part by part."""
    told = sum_blocks(rows.select("text").mapInArrow(lean(_document_counts), "block int, values binary"), label, np.float64)
    parts = {r.block: np.frombuffer(r["values"], np.float64) for r in told.collect()}
    if not parts:
        return np.zeros(1 << SPACE_BITS), 0
    return np.concatenate([parts[k] for k in range(BLOCKS)]), int(parts[BLOCKS][0])


def fit(docs: DataFrame, labels: DataFrame, positives: int = 4096, unlabelled: int = 16_384, features: int = 1024) -> Model:
    """Model from (doc_id, toxic) and the documents, which are all taken as unlabelled text.

    The driver gets two count vectors of fixed size, and the features of the sampled documents."""
    labels = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL")
    told = labels.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    prior = (told.toxic or 0) / told.n if told.n else 0.0
    if not 0 < prior < 1:
        return constant(prior)
    known = smallest_by_hash(labels.filter("toxic = 1").select("doc_id").distinct(), positives).withColumn("toxic", F.lit(1))
    other = smallest_by_hash(docs.select("doc_id").filter("doc_id IS NOT NULL").distinct(), unlabelled).withColumn("toxic", F.lit(0))
    sample = settle(texts(docs).join(F.broadcast(known.unionAll(other)), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "toxic-sample")
    toxic, n_toxic = document_counts(sample.filter("toxic = 1"), "toxic-counts")
    every, n = document_counts(texts(docs), "unlabelled-counts")
    if not n or not n_toxic:
        return constant(prior)
    chosen = choose(toxic, every, n_toxic, n, min(features, 4 * n_toxic))
    shared = docs.sparkSession.sparkContext.broadcast(chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = bytes_of(batch.column(0))
            out: list[np.ndarray] = []
            for i, j in slices(off):
                row, f = has_features(data[off[i]:off[j]], off[i:j + 1] - off[i], shared.value)
                out += np.split(f.astype(np.int16), np.searchsorted(row, np.arange(1, j - i)))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([x.tobytes() for x in out], pa.binary())], ["toxic", "has"])

    rows = sorted((r.toxic, bytes(r.has)) for r in sample.select("text", "toxic").mapInArrow(lean(run), "toxic int, has binary").collect())
    shared.destroy()
    has = [[np.frombuffer(h, np.int16) for t, h in rows if t == k] for k in (0, 1)]
    weights, bias = train(has[1], has[0], int(chosen.max(initial=-1)) + 1, prior, decay=0.1 / n_toxic)
    return Model(chosen, weights, bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = bytes_of(batch.column(1))
            parts = [shared.value.scores(data[off[i]:off[j]], off[i:j + 1] - off[i]) for i, j in slices(off)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([*parts, np.zeros(0)]))], ["doc_id", "score"])

    rows = texts(docs)
    return rows.mapInArrow(lean(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


#: From this score on a document counts as toxic.
THRESHOLD = 0.3


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score stays below the threshold, with all their columns as they are; nothing is shuffled."""
    shared, place = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = bytes_of(batch.column(place).fill_null(""))
            scores = [shared.value.scores(data[off[i]:off[j]], off[i:j + 1] - off[i]) for i, j in slices(off)]
            yield batch.filter(pa.array(np.concatenate([*scores, np.zeros(0)]) < threshold))

    return docs.mapInArrow(lean(run), docs.schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    seen = crc_of_id() % 4 != 2
    model = fit(docs.filter(seen), labels.filter(seen))
    return score(docs, model).select("doc_id", (crc_of_id() % 4 == 2).alias("held_out"), "score",
                                     (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
