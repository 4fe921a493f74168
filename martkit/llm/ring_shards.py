"""Shards on a consistent-hash ring with virtual nodes and bounded loads (DataFrame functions only).

The ring has ``CELLS`` cells. A key lies in the cell of its id's MD5, and every
shard has ``VNODES`` points on the ring. A key belongs to the first point
clockwise; when that point's shard is full, it continues clockwise to the next
point, and so on. Capacities are the row count divided evenly (the first
``rows mod shards`` shards hold one more), so row counts are at most one apart.

Only counts meet on the driver: one number per cell, ``CELLS`` at most whatever
the input. From them follows how many keys of each cell go to which shard; keys
of a cell are told apart by their rank (ordered by id, checksum and size). A cell
is a small slice of the keys; one with more than ``CELL_ROWS`` rows (many rows with
one id, or none) is ranked in blocks of rows, behind each other. A key's slot in its
shard follows from the same table, so neither a shard nor a cell is gathered in one task.

Defined results: a null id counts as the empty string, a null text as zero bytes.
Rows that repeat an id share a cell and get ranks of their own. An empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkit.llm.common import stored

CELLS = 1 << 16
VNODES = 64
OVERHEAD_BYTES = 8
#: Rows of a cell that one task ranks, on average.
CELL_ROWS = 100_000


def cell_of(key: Column) -> Column:
    """Cell of a key: the first four hexadecimal digits of its MD5."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 4), 16, 10).cast("int")


def ring(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise."""
    return sorted((int(hashlib.md5(f"shard {s} point {v}".encode()).hexdigest()[:4], 16), s)
                  for s in range(shards) for v in range(vnodes))


def capacities(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def allocate(counts: dict[int, int], shards: int, vnodes: int = VNODES) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, last rank + 1, shard, slot of the first rank) for the keys of every cell.

    In round r the keys left over of each arc try the r-th point clockwise from
    their own; a shard takes keys until it is full.
    """
    points = ring(shards, vnodes)
    room = capacities(sum(counts.values()), shards)
    used = [0] * shards
    arcs: list[list[list[int]]] = [[] for _ in points]  # cells of each arc: [cell, next rank, keys left]
    at = 0
    for cell in sorted(counts):
        while at < len(points) and points[at][0] < cell:
            at += 1
        arcs[at % len(points)].append([cell, 0, counts[cell]])
    out = []
    turn = 0
    waiting = [i for i, arc in enumerate(arcs) if arc]
    while waiting:
        for i in waiting:
            shard = points[(i + turn) % len(points)][1]
            arc = arcs[i]
            while arc and used[shard] < room[shard]:
                cell, rank, left = arc[0]
                take = min(left, room[shard] - used[shard])
                out.append((cell, rank, rank + take, shard, used[shard]))
                used[shard] += take
                if take == left:
                    arc.pop(0)
                else:
                    arc[0] = [cell, rank + take, left - take]
        waiting = [i for i in waiting if arcs[i]]
        turn += 1
    return out


def shard_rows(docs: DataFrame, shards: int = 24, vnodes: int = VNODES, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot), one row per row of ``docs``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    # stored, so that row numbers stay what they are
    keyed = stored(docs.select("doc_id", cell_of(F.col("doc_id")).alias("cell"),
                               (F.octet_length(text) + OVERHEAD_BYTES).cast("long").alias("size"),
                               F.crc32(text).alias("text_crc32"))).withColumn("row", F.monotonically_increasing_id())
    counts = {r["cell"]: r["count"] for r in keyed.groupBy("cell").count().collect()}
    parts = spark.createDataFrame(allocate(counts, shards, vnodes),
                                  "cell int, first long, until long, shard int, base long")
    # at most CELLS rows
    large = spark.createDataFrame([(c, -(-n // cell_rows)) for c, n in counts.items() if n > cell_rows], "cell int, blocks long")
    block = F.coalesce(F.pmod(F.xxhash64("row"), F.col("blocks")), F.lit(0).cast("long"))
    dealt = keyed.join(F.broadcast(large), "cell", "left").withColumn("block", block)
    held = stored(dealt.filter("blocks IS NOT NULL").groupBy("cell", "block").count())
    before = F.sum("count").over(Window.partitionBy("cell").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    ahead = held.select("cell", "block", F.coalesce(before, F.lit(0)).alias("ahead"))
    rank = F.row_number().over(Window.partitionBy("cell", "block").orderBy("doc_id", "text_crc32", "size", "row")) - 1
    ranked = (dealt.withColumn("own", rank).join(ahead, ["cell", "block"], "left")
              .withColumn("rank", F.col("own") + F.coalesce("ahead", F.lit(0))))
    # at most CELLS + shards * points rows, by construction of the ring
    return (ranked.join(F.broadcast(parts), "cell").filter("rank >= first AND rank < until")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - F.col("first")).alias("slot")))
