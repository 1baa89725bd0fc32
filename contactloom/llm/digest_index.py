"""Exact deduplication against a persistent digest index.

The index is a Parquet table, bucketed and sorted by digest, with one row per distinct text seen so far.  A batch of
new documents is reduced to digests, one row per digest is taken before anything is shuffled, a sort-merge anti-join
finds the digests the index lacks, and these are appended.  The bucketed side is never shuffled.

Texts are equal when they are identical after each run of ASCII white space has become one space; null is empty.
The order of keeping is: a text that an earlier batch brought stays with that batch's document; inside a batch the row
with the smallest doc_id stays (rows without an id come last; of repeated rows exactly one stays).  A document that the
index keeps a text by stays when it comes again, so a batch that is run again gets the verdict it got at first.  An empty
batch changes nothing.  Ids are integers of up to 64 bits.  Other columns are carried in one struct or not read,
whatever their names."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm.shared import new_folder, settle

WHITE = r"[\x20\x09-\x0D]+"


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WHITE, " ")


def digest(text: str = "text") -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


def _key(doc_id: str = "doc_id") -> Column:
    """Id and digest as one join key: rows of a text that many documents share are dealt out by id, and no id equals no
    id, as fields of a struct do."""
    return F.struct(F.col(doc_id).cast("bigint").alias("id"), F.col("digest")).alias("key")


class DigestIndex:
    """The index in one folder.  Opening a folder that holds an index goes on with it.

    ``buckets`` fixes the layout at creation and has to be the same whenever the folder is opened; choose it so that
    a bucket of the final index fits a task (40 bytes a distinct text: 1,024 buckets hold some 10^10 texts in 400 MB
    each)."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64):
        self.spark, self.name = spark, f"digest_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {int(buckets)} BUCKETS LOCATION '{folder}'")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def close(self) -> None:
        """Forget the table's name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def add(self, prints: DataFrame) -> DataFrame:
        """Append what is new in a batch of (doc_id, row_id, digest); a verdict for each digest of the batch:
        (digest, keep_id, keep_row, group_size).  keep_row is the row of this batch that stays, null if the text stays
        with a document that is not in the batch.

        Running a batch again after a failure changes neither index nor verdict: what was appended is found, is not
        appended twice, and its document is known by its id."""
        order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_id")
        groups = settle(prints.groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("group_size")),
                        "digest-groups")
        fresh = groups.hint("merge").join(self.table(), "digest", "left_anti")
        fresh = settle(fresh.select("digest", F.col("first.doc_id").alias("keep_id"),
                                    F.col("first.row_id").alias("keep_row"), "group_size"), "digest-fresh")
        known = settle(groups.hint("merge").join(self.table(), "digest").select("digest", "keep_id", "group_size"), "digest-seen")
        again = prints.select(_key(), "row_id").join(known.select(_key("keep_id")), "key")
        again = again.groupBy("key").agg(F.min("row_id").alias("keep_row")).select("key.digest", "keep_row")
        known = settle(known.join(again, "digest", "left").select("digest", "keep_id", "keep_row", "group_size"), "digest-known")
        fresh.select("digest", "keep_id").write.insertInto(self.name)
        return fresh.unionByName(known)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, row_id, digest) of every row, written down, so that row_id stays what it is."""
    return settle(docs.select("doc_id", F.monotonically_increasing_id().alias("row_id"), digest().alias("digest")),
                  "digest-prints")


def add_in_batches(index: DigestIndex, prints: DataFrame) -> DataFrame:
    """What ``index.add`` tells of a whole table, group_size over all of it, brought to the index in two batches: the
    smaller half of the ids first, so that the smallest id stays; rows without an id come with the second."""
    middle = (prints.approxQuantile("doc_id", [0.5], 0.05) or [0.0])[0]
    early = F.coalesce(F.col("doc_id") <= F.lit(middle), F.lit(False))
    first, second = index.add(prints.filter(early)), index.add(prints.filter(~early))
    return first.unionByName(second).groupBy("digest").agg(
        F.max("keep_id").alias("keep_id"), F.max("keep_row").alias("keep_row"), F.sum("group_size").alias("group_size"))


def deduplicate(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """One row per document of the batch: doc_id, keep_id, group_size (rows of this batch with that text), kept,
    text_sha256 (hex).  The batch's new texts are in the index afterwards."""
    prints = fingerprints(docs)
    return verdicts(prints, index.add(prints))


def verdicts(prints: DataFrame, verdict: DataFrame) -> DataFrame:
    """The verdict on each digest, told to its rows."""
    return (prints.join(verdict, "digest")
            .select("doc_id", "keep_id", "group_size",
                    F.coalesce(F.col("row_id") == F.col("keep_row"), F.lit(False)).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def _buckets(spark: SparkSession) -> int:
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))


def new_index(spark: SparkSession) -> DigestIndex:
    return DigestIndex(spark, new_folder(spark, "digest-index"), _buckets(spark))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    index = new_index(spark)
    verdict = add_in_batches(index, prints)
    index.close()
    return verdicts(prints, verdict)


OP7_SQL = """
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id) = 1 AS kept, sha256(body) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS body FROM documents) AS d
WINDOW same AS (PARTITION BY body)"""


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns: the filtering form of ``deduplicate`` with an index of its own.

    Documents meet the verdict on id and digest, so the copies of a frequent text are not gathered; of rows that repeat
    with id and text, one stays, combined before anything is gathered."""
    index = new_index(docs.sparkSession)
    stay = add_in_batches(index, fingerprints(docs)).select(_key("keep_id"))
    index.close()
    marked = docs.select(F.struct("*").alias("row"), F.col("doc_id"), digest().alias("digest")).select("row", _key())
    return marked.join(stay, "key").groupBy("key").agg(F.first("row").alias("row")).select("row.*")
