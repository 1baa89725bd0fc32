"""Shards by a consistent-hash ring with virtual nodes and bounded loads, in DataFrame functions alone.

Every shard has ``nodes`` places on a ring of 2**16 cells, at hashes of its number; a row stands in the cell of its
hashed id and belongs to the first node at or after it.  The cells up to a node form its arc.  A shard takes no more
rows than its capacity: rows of its own arcs come first, and what does not fit continues clockwise to the next shard,
round after round, until it meets one with room.  A shard without a surplus never gives a row away, so a change of the
rows or of the shards moves few of them.

Without ``load`` the capacities add up to the number of rows, so that counts differ by one at most (law ``rows``); the
shards with most rows of their own take the odd ones.  With a load of 1.1, say, a shard takes up to 1.1 times its even
share, rounded up, and fewer rows move.

Within an arc the rows are numbered in the order of their hash, without giving an arc to a single task.  Which numbers
of an arc go to which shard is worked out on the driver from one count per arc: at most ``shards * nodes`` numbers,
however many rows there are.  The answer has one row per arc, and one more per shard and round at most, and is broadcast.

Null ids share the cell of the empty text; rows that repeat stand in one cell and are told apart by their order in the
files.  Null text has no bytes.  Only doc_id and text are read.  Without rows there are no shards to fill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm.shared import settle
from contactloom.operators.sequence import row_numbers

CELL_BITS, HASH_BITS = 16, 60


def hash_of(text: Column) -> Column:
    """The first 60 bits of the MD5 of a text, which a reader without Spark can repeat."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def cell_of(hashed: Column) -> Column:
    return F.shiftright(hashed, HASH_BITS - CELL_BITS).cast("int")


def arcs(spark: SparkSession, shards: int, nodes: int) -> DataFrame:
    """(arc, shard, first_cell, last_cell) in clockwise order.  The cells after the last node belong to the first one's
    arc, so that arc has two rows.  Of nodes in one cell, that of the smallest shard counts."""
    place = spark.range(shards * nodes).select((F.col("id") % shards).cast("int").alias("shard"),
                                               cell_of(hash_of(F.concat_ws("/", F.lit("node"), F.col("id") % shards, F.floor(F.col("id") / shards)))).alias("cell"))
    taken = place.groupBy("cell").agg(F.min("shard").alias("shard")).orderBy("cell").collect()
    cells = [r.cell for r in taken]
    rows = [(k, r.shard, (cells[k - 1] + 1) if k else 0, r.cell) for k, r in enumerate(taken)]
    if cells[-1] + 1 < 1 << CELL_BITS:
        rows.append((0, taken[0].shard, cells[-1] + 1, (1 << CELL_BITS) - 1))
    return listed(spark, rows, "arc int, shard int, first_cell int, last_cell int")


def listed(spark: SparkSession, rows: list[tuple[int, ...]], schema: str) -> DataFrame:
    """A short table of whole numbers that stands in the plan itself."""
    names, kinds = zip(*(c.split() for c in schema.split(", ")), strict=True)
    if not rows:
        return spark.sql(f"SELECT {', '.join(f'CAST(NULL AS {k}) AS {n}' for n, k in zip(names, kinds, strict=True))}").filter("false")
    values = ", ".join(f"({', '.join(map(str, r))})" for r in rows)
    return spark.sql(f"SELECT {', '.join(f'CAST({n} AS {k}) AS {n}' for n, k in zip(names, kinds, strict=True))} FROM VALUES {values} AS t({', '.join(names)})")


def capacities(own: list[int], total: int, load: float | None) -> list[int]:
    """Rows that each shard may take, given how many its own arcs have."""
    shards = len(own)
    if load is not None:
        return [-int(-(load * total) // shards)] * shards
    most = sorted(range(shards), key=lambda s: (-own[s], s))[:total % shards]
    return [total // shards + (s in most) for s in range(shards)]


def spread(order: list[int], counts: list[int], shards: int, load: float | None) -> list[tuple[int, int, int, int, int]]:
    """(arc, from, to, shard, slot): rows from..to-1 of an arc go to the shard, the first of them to that slot.

    ``order`` names the shard of each arc, clockwise, ``counts`` the rows of each arc.  In round r every row that is
    left asks the r-th different shard clockwise from its arc; arcs are served in their order."""
    own = [0] * shards
    for s, n in zip(order, counts, strict=True):
        own[s] += n
    room = capacities(own, sum(counts), load)
    if sum(room) < sum(counts):
        raise ValueError("the shards have no room for all rows: the load must be 1 at least")
    filled, done, out = [0] * shards, [0] * len(order), []
    asks: list[list[int]] = []
    for a in range(len(order)):
        seen: list[int] = []
        k = a
        while len(seen) < len(set(order)):
            if order[k % len(order)] not in seen:
                seen.append(order[k % len(order)])
            k += 1
        asks.append(seen + [s for s in range(shards) if s not in seen])
    for turn in range(shards):
        for a, n in enumerate(counts):
            s = asks[a][turn]
            take = min(n - done[a], room[s] - filled[s])
            if take > 0:
                out.append((a, done[a], done[a] + take, s, filled[s]))
                done[a] += take
                filled[s] += take
    return out


def in_shards(docs: DataFrame, shards: int = 16, nodes: int = 64, load: float | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row; slots of a shard count from 0 without a gap."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    hashed = hash_of(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = settle(docs.select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"),
                              hashed.alias("_hash"), F.monotonically_increasing_id().alias("_row")), "ring-rows")
    around = arcs(spark, shards, nodes)
    told = {r.arc: r.shard for r in around.collect()}
    cells = around.select("arc", F.explode(F.sequence("first_cell", "last_cell")).alias("_cell"))
    placed = rows.withColumn("_cell", cell_of(F.col("_hash"))).join(F.broadcast(cells), "_cell").drop("_cell")
    numbered = row_numbers(placed, ["arc"], [F.col("_hash"), F.col("size"), F.col("text_crc32"), F.col("_row")], "_number")
    counted = {r.arc: r.n for r in placed.groupBy("arc").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = [told[a] for a in range(len(told))]
    plan = spread(order, [counted.get(a, 0) for a in range(len(told))], shards, load)
    parts = listed(spark, plan, "arc int, first_number bigint, end_number bigint, shard int, first_slot bigint")
    at = F.col("_number") - 1
    here = (F.col("own.arc") == F.col("part.arc")) & (at >= F.col("first_number")) & (at < F.col("end_number"))
    return numbered.alias("own").join(F.broadcast(parts.alias("part")), here).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("first_slot") + at - F.col("first_number")).alias("slot"))


def op12_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = in_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
