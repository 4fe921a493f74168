"""SimHash near-duplicates over a hierarchical index in Gray order.

Fingerprints: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, word shingles with
repeats joined by single spaces, XXH64 with seed 42; a bit is set when over half
of the shingle hashes have it. Texts with fewer words than a shingle are one
shingle; a text without words (or null) has fingerprint zero and is linked like
any other.

Links: two fingerprints that differ in at most ``bits`` of 64 agree on at least
``BLOCKS - bits`` of ``BLOCKS`` equal blocks. Distinct fingerprints are dealt
out under every choice of blocks to drop (28 for 2 of 8), so any linked pair
meets in a group that shares 48 masked bits; such a group has at most 65,536
members by construction, whatever the data. In each group the rows arrive
sorted by Gray rank. Consecutive rows form nodes, and a node keeps the bit
pattern its members share; children keep only what their parent has not. A
search goes down from the group's node, adds up the differences on each level
and drops a whole subtree as soon as they exceed ``bits``. Links found are
folded into one edge per fingerprint inside the task; components over all
groups follow from ``graph.connected_components``.

Defined results: rows with a null doc_id take part; ``component_id`` is the
smallest non-null doc_id of the component. Repeated rows give repeated rows.
Extra columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import cut
from martkit.llm.graph import connected_components

SHINGLE = 3
BITS = 2
BLOCKS = 8
FAN = 8
#: (query, node) pairs expanded at a time.
FRONTIER = 1 << 18
_SIGN = -(1 << 63)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of one text."""
    words = [] if text is None else text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    count = max(len(words) - shingle + 1, 1)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = [0, *ends[:count - 1].tolist()]
    stops = (ends[-count:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, stops, strict=True)], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, count, 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """Signed long column with the 64 bits of the fingerprint."""

    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            bits = np.array([fingerprint(t, shingle) for t in batch.to_numpy()], dtype=np.uint64)
            yield pd.Series(bits.view(np.int64))

    return prints.asNondeterministic()(text)


def gray_rank(bits: Column) -> Column:
    """Rank of the 64 bits in the reflected Gray code, as a long that sorts like the unsigned rank."""
    rank = bits
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(_SIGN))


def _masks(bits: int) -> list[int]:
    """Signed masks that keep all but ``bits`` of the blocks."""
    width = 64 // BLOCKS
    out = []
    for drop in combinations(range(BLOCKS), bits):
        mask = (1 << 64) - 1
        for block in drop:
            mask &= ~(((1 << width) - 1) << (block * width))
        out.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    return out


class GrayIndex:
    """Forest over rows sorted by (group, Gray rank): one tree for each group."""

    def __init__(self, prints: np.ndarray, group: np.ndarray):
        self.prints = prints
        pattern, mask, owner = prints, np.full(len(prints), ~np.uint64(0)), group
        self.levels = [(pattern, mask, np.arange(len(prints)), np.ones(len(prints), dtype=np.int64))]
        while len(owner) and (owner[1:] == owner[:-1]).any():
            new_group = np.r_[True, owner[1:] != owner[:-1]]
            start = np.maximum.accumulate(np.where(new_group, np.arange(len(owner)), 0))
            first = np.flatnonzero((np.arange(len(owner)) - start) % FAN == 0)
            size = np.diff(np.r_[first, len(owner)])
            parent = np.repeat(np.arange(len(first)), size)
            differ = np.bitwise_or.reduceat(pattern ^ pattern[first][parent], first)
            shared = np.bitwise_and.reduceat(mask, first) & ~differ
            old = self.levels[-1]
            self.levels[-1] = (old[0], mask & ~shared[parent], old[2], old[3])
            pattern, mask, owner = pattern[first] & shared, shared, owner[first]
            self.levels.append((pattern, mask, first, size))
        self.root_of = np.searchsorted(owner, group)

    def linked(self, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (row, other row) in one group with at most ``bits`` different bits."""
        top = len(self.levels) - 1
        rows = np.arange(len(self.prints))
        todo = [(top, rows, self.root_of, np.zeros(len(rows), dtype=np.uint8))]
        while todo:
            level, query, node, far = todo.pop()
            if len(query) > FRONTIER:
                todo += [(level, query[FRONTIER:], node[FRONTIER:], far[FRONTIER:])]
                query, node, far = query[:FRONTIER], node[:FRONTIER], far[:FRONTIER]
            pattern, own, first, size = self.levels[level]
            far = far + np.bitwise_count((self.prints[query] ^ pattern[node]) & own[node])
            near = far <= bits
            query, node, far = query[near], node[near], far[near]
            if not level:
                pair = query < node
                yield query[pair], node[pair]
            elif len(query):
                times = size[node]
                offset = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                todo.append((level - 1, np.repeat(query, times), np.repeat(first[node], times) + offset,
                             np.repeat(far, times)))


def fold(size: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest row that each row reaches over ``pairs``; pairs already joined cost one comparison."""
    root = np.arange(size)
    for a, b in pairs:
        a, b = root[a], root[b]
        open_ = a != b
        for x, y in np.unique(np.stack([a[open_], b[open_]], axis=1), axis=0).tolist():
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            root[max(x, y)] = min(x, y)
        while not np.array_equal(root, root[root]):
            root = root[root]
    return root


def _edges_of(frame: pd.DataFrame, bits: int) -> pd.DataFrame:
    group = (frame["choice"].to_numpy()[1:] != frame["choice"].to_numpy()[:-1]) | (
        frame["shared"].to_numpy()[1:] != frame["shared"].to_numpy()[:-1])
    group = np.r_[0, np.cumsum(group)]
    many = np.bincount(group)[group] > 1
    prints = frame["print"].to_numpy()[many]
    index = GrayIndex(prints.view(np.uint64), group[many])
    root = fold(len(prints), index.linked(bits))
    moved = root != np.arange(len(root))
    return pd.DataFrame({"a": prints[moved], "b": prints[root[moved]]})


def link_edges(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``print`` whose components are those of all links."""
    masks = _masks(bits)
    choices = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("print").bitwiseAND(F.lit(m)).alias("shared"))
                        for i, m in enumerate(masks)])
    dealt = (prints.select("print", F.explode(choices).alias("at")).select("print", "at.choice", "at.shared")
             .repartition("choice", "shared").sortWithinPartitions("choice", "shared", gray_rank(F.col("print"))))

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            if held is not None:
                frame = pd.concat([held, frame], ignore_index=True)
            last = frame.iloc[-1]
            tail = ((frame["choice"] == last["choice"]) & (frame["shared"] == last["shared"])).to_numpy()
            held = frame[tail]
            if not tail.all():
                yield _edges_of(frame[~tail], bits)
        if held is not None:
            yield _edges_of(held, bits)

    return dealt.mapInPandas(search, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """(doc_id, print, component_id), one row per row of ``docs``."""
    prints = cut(docs.select("doc_id", fingerprint_column(F.col("text"), shingle).alias("print")))
    distinct = prints.groupBy("print").agg(F.min("doc_id").alias("first_id"))
    found = connected_components(link_edges(distinct.select("print"), bits))
    labelled = (distinct.join(found.withColumnRenamed("node", "print"), "print", "left")
                .withColumn("component", F.coalesce("component", "print")))
    least = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    member = labelled.select("print", "component").join(least, "component").select("print", "component_id")
    return prints.join(member, "print").select("doc_id", "print", "component_id")
