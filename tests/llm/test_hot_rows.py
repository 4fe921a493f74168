"""Equal rows and hot keys: a third of all rows alike, in operators that deal rows out by key or content."""
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from martkit.llm import language_id, packing, piece_lattice, ring_shards
from martkit.llm.queries import PIECES, TOKENIZER

ROWS = 3000


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows without id and text, a third with one id and other texts, the rest unique."""
    i = F.col("id")
    return spark.range(ROWS, numPartitions=7).select(
        F.when(i % 3 == 1, F.lit(5)).when(i % 3 == 2, i).alias("doc_id"),
        F.when(i % 3 != 0, F.concat(F.lit("text number "), i % 700)).alias("text"))


@pytest.mark.parametrize("cell_rows", [100_000, 50])
def test_ring_ranks_a_hot_cell_in_blocks(hot, cell_rows):
    out = ring_shards.shard_rows(hot, 7, cell_rows=cell_rows).collect()
    assert len(out) == ROWS
    load = Counter(r["shard"] for r in out)
    assert max(load.values()) - min(load.values()) <= 1
    assert {(r["shard"], r["slot"]) for r in out} == {(s, i) for s, n in load.items() for i in range(n)}
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 8) for r in hot.collect())
    assert Counter((r["doc_id"], r["size"]) for r in out) == want


def walk(ids, shards, vnodes):
    """Bounded loads key by key: in rounds, every key left over tries its next point clockwise."""
    cell = {i: int(__import__("hashlib").md5(str(i).encode()).hexdigest()[:4], 16) for i in ids}
    points = ring_shards.ring(shards, vnodes)
    room = ring_shards.capacities(len(ids), shards)
    own = {i: next((p for p, (at, _) in enumerate(points) if at >= cell[i]), 0) for i in ids}
    # arcs take their turn in ring order, keys of an arc clockwise, keys of a cell by id
    waiting = sorted(ids, key=lambda i: (own[i], cell[i], i))
    out, turn = {}, 0
    while waiting:
        left = []
        for i in waiting:
            shard = points[(own[i] + turn) % len(points)][1]
            if room[shard]:
                room[shard] -= 1
                out[i] = shard
            else:
                left.append(i)
        waiting, turn = left, turn + 1
    return out


def test_shards_equal_a_walk_key_by_key_also_with_one_more_shard(spark):
    docs = spark.range(700).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    got = {}
    for shards in (6, 7):
        got[shards] = {r["doc_id"]: r["shard"] for r in ring_shards.shard_rows(docs, shards, 8).collect()}
        assert got[shards] == walk(range(700), shards, 8)
    moved = [i for i in range(700) if got[6][i] != got[7][i]]
    assert 100 <= len(moved) <= 350 and sum(got[7][i] == 6 for i in moved) == 100        # 700 / 7 go to the new shard


def test_packing_spreads_equal_rows(hot):
    out = packing.pack(hot, TOKENIZER, bucket_rows=200).toPandas()
    assert len(out) == ROWS and out["piece"].max() == 0
    buckets = out.groupby(out["sequence_id"].to_numpy() >> 40).size()
    assert len(buckets) == 15 and buckets.max() <= 300
    for _, rows in out.groupby("sequence_id"):
        rows = rows.sort_values("offset")
        assert (rows["offset"].to_numpy() == np.r_[0, rows["length"].cumsum()[:-1]]).all() and rows["length"].sum() <= 2048


def test_packing_is_near_the_least_number_of_sequences(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = packing.pack(docs, TOKENIZER)
    total, used = out.agg(F.sum("length"), F.count_distinct("sequence_id")).first()
    assert used <= 1.013 * -(-total // packing.CAPACITY)


def test_pieces_of_equal_rows(hot):
    out = piece_lattice.encode(hot, PIECES, part_bytes=5_000)
    rows = out.select("doc_id", piece_lattice.decode_column(out["ids"], PIECES).alias("text")).collect()
    assert Counter(map(tuple, rows)) == Counter((r["doc_id"], r["text"] or "") for r in hot.collect())


def test_training_rows_are_the_lowest_draws_of_a_hot_language(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"),
                                    F.when(F.col("id") % 3 == 0, "aa").otherwise("bb").alias("lang"))
    got = language_id.training_rows(docs, 300)
    draws = docs.select("lang", "text", F.xxhash64(F.col("doc_id").cast("string")).alias("draw")).toPandas()
    want = draws.sort_values("draw").groupby("lang").head(300)
    assert Counter(got) == Counter(zip(want["lang"], want["text"]))
