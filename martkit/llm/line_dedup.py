"""Line dedup that can be taken back: sharded cuckoo filters over exact reference counts.

A line's key is the line without blanks at its ends, A-Z lower-cased; the key's
name is its SHA-256. The index has two parts:

* ``refs`` (key, docs): in how many documents each key occurs, exactly;
* ``filters`` (shard, slots): one cuckoo filter per shard of the names, holding a
  16-bit fingerprint of every key that ``threshold`` documents have.

Inserting documents adds to the counts, deleting them subtracts; only the keys whose
count crosses the threshold are put into, or taken out of, the filter of their shard
(a cuckoo filter, unlike a Bloom filter, can forget a key). Insertions and deletions
that cancel give the counts, and so the results, from before. A filter has a fixed
size; when the frequent keys need more room, the shards are doubled and filled from
the exact table.

Cleaning reads the filters first: a line that no filter knows is kept and leaves its
task as nothing but text. Lines that a filter knows are looked up in ``refs``, so a
false positive is never dropped. Filters are broadcast in groups of shards of at most
``GROUP_BYTES``; with more shards, each group probes the texts in a pass of its own.

Defined results: a null or empty text is one empty line. A key shorter than
``min_chars`` characters is never dropped. Every row is a document, repeated rows too;
texts are named by 128 bits of their hash, as equal texts have equal results. Extra
columns are ignored. Deleting documents that were never inserted fails the job when a
count falls below zero.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.llm.common import stored, utf8_bytes

THRESHOLD = 10
BLANKS = b" \t\n\x0b\x0c\r"
#: Buckets of a filter (a power of two), fingerprints in a bucket, and frequent keys that a shard is made for.
BUCKETS, SLOTS, SHARD_KEYS = 1 << 15, 4, 100_000
KICKS = 500
#: Filters broadcast at a time.
GROUP_BYTES = 64 << 20
#: Different keys that a task holds before it hands their counts on.
KEYS_HELD = 300_000


def line_key(line: bytes) -> bytes:
    return line.strip(BLANKS).lower()      # of bytes, lower() changes A-Z only


def names_of(data: bytes, min_chars: int) -> dict[bytes, bytes]:
    """Name of every distinct key of a text that is long enough, by key."""
    keys = {line_key(line) for line in data.split(b"\n")}
    return {k: sha256(k).digest() for k in keys if len(k) >= min_chars and len(k.decode("utf-8", "replace")) >= min_chars}


def places(names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(shard number, fingerprint, first bucket, second bucket) of names given as rows of 32 bytes."""
    words = np.ascontiguousarray(names).view(">u4").astype(np.int64)
    print_ = np.maximum(words[:, 1] & 0xFFFF, 1)
    first = words[:, 2] & (BUCKETS - 1)
    return words[:, 0], print_, first, first ^ (print_ * 0x5BD1E995 & (BUCKETS - 1))


class Cuckoo:
    """One shard's filter: each fingerprint lies in one of two buckets."""

    def __init__(self, slots: bytes | None = None):
        table = np.frombuffer(slots, dtype="<u2") if slots is not None else np.zeros(BUCKETS * SLOTS, dtype="<u2")
        self.table = table.reshape(BUCKETS, SLOTS).tolist()

    def insert(self, print_: int, first: int, second: int) -> bool:
        """False if there is no room; the filter has then lost a fingerprint and must be filled anew."""
        for at in (first, second):
            if 0 in self.table[at]:
                self.table[at][self.table[at].index(0)] = print_
                return True
        at = second
        for kick in range(KICKS):
            slot = (kick + print_) % SLOTS
            print_, self.table[at][slot] = self.table[at][slot], print_
            at ^= print_ * 0x5BD1E995 & (BUCKETS - 1)
            if 0 in self.table[at]:
                self.table[at][self.table[at].index(0)] = print_
                return True
        return False

    def delete(self, print_: int, first: int, second: int) -> bool:
        for at in (first, second):
            if print_ in self.table[at]:
                self.table[at][self.table[at].index(print_)] = 0
                return True
        return False

    def slots(self) -> bytes:
        return np.array(self.table, dtype="<u2").tobytes()


def _names_array(keys) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, keys)), dtype=np.uint8).reshape(-1, 32)


def _shard(shards: int):
    return (F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("long") % shards).cast("int").alias("shard")


def line_counts(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """(key, docs): the name of every key with the number of rows of ``docs`` that have it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"key": pa.array(list(seen), pa.binary()),
                                              "docs": pa.array(list(seen.values()), pa.int64())})
            seen.clear()
            return out

        for batch in batches:
            for data in batch.column("data").to_pylist():
                seen.update(names_of(data, min_chars).values())
                if len(seen) >= KEYS_HELD:
                    yield rows()
        yield rows()

    return (docs.select(utf8_bytes(F.col("text")).alias("data")).mapInArrow(count, "key binary, docs long")
            .groupBy("key").agg(F.sum("docs").alias("docs")))


def _turn(filters: DataFrame, crossed: DataFrame) -> DataFrame:
    """Filters after the keys of ``crossed`` (shard, key, up) went in or out; ``full`` where one has no room."""

    def turn(old: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        shard = (old if len(old) else keys)["shard"].iloc[0]
        cuckoo = Cuckoo(bytes(old["slots"].iloc[0]) if len(old) else None)
        full = False
        if len(keys):
            _, *where = places(_names_array(keys["key"]))
            moves = sorted(zip(keys["up"].tolist(), *[w.tolist() for w in where], strict=True))   # out before in
            for up, *at in moves:
                done = cuckoo.insert(*at) if up else cuckoo.delete(*at)
                if not up and not done:
                    raise ValueError("a key to forget is not in its filter")
                full |= not done
        return pd.DataFrame({"shard": np.array([shard], dtype=np.int32), "slots": [cuckoo.slots()], "full": [full]})

    return (filters.select("shard", "slots").groupBy("shard").cogroup(crossed.groupBy("shard"))
            .applyInPandas(turn, "shard int, slots binary, full boolean"))


@dataclass(frozen=True)
class LineIndex:
    """Reference counts and filters; every change gives a new index and leaves this one as it is."""

    refs: DataFrame
    filters: DataFrame
    shards: int = 1
    threshold: int = THRESHOLD
    min_chars: int = 1

    @classmethod
    def empty(cls, spark: SparkSession, threshold: int = THRESHOLD, min_chars: int = 1) -> LineIndex:
        return cls(spark.createDataFrame([], "key binary, docs long"),
                   spark.createDataFrame([], "shard int, slots binary"), 1, threshold, min_chars)

    def insert(self, docs: DataFrame) -> LineIndex:
        return self._change(docs, 1)

    def delete(self, docs: DataFrame) -> LineIndex:
        """Forget the lines of ``docs``, which must have been inserted."""
        return self._change(docs, -1)

    def _change(self, docs: DataFrame, sign: int) -> LineIndex:
        by = line_counts(docs, self.min_chars).select("key", F.lit(0).cast("long").alias("was"), (sign * F.col("docs")).alias("by"))
        both = self.refs.select("key", F.col("docs").alias("was"), F.lit(0).cast("long").alias("by")).union(by)
        total = F.col("was") + F.col("by")
        now = F.when(total >= 0, total).otherwise(F.raise_error(F.lit("deleted a line that was not inserted")).cast("long"))
        counts = stored(both.groupBy("key").agg(F.sum("was").alias("was"), F.sum("by").alias("by"))
                        .select("key", "was", now.alias("docs")))
        refs = counts.filter("docs > 0").select("key", "docs")
        after = replace(self, refs=refs)
        frequent = refs.filter(F.col("docs") >= self.threshold).count()
        if frequent > self.shards * SHARD_KEYS:
            return after._filled(1 << (-(-frequent // SHARD_KEYS) - 1).bit_length())
        up, was_up = F.col("docs") >= self.threshold, F.col("was") >= self.threshold
        crossed = counts.filter(up != was_up).select(_shard(self.shards), "key", up.alias("up"))
        return after._with(_turn(self.filters, crossed))

    def _filled(self, shards: int) -> LineIndex:
        """The same with so many shards, filled from the exact table."""
        nothing = self.filters.limit(0)
        keys = self.refs.filter(F.col("docs") >= self.threshold).select(_shard(shards), "key", F.lit(True).alias("up"))
        return replace(self, shards=shards)._with(_turn(nothing, keys))

    def _with(self, turned: DataFrame) -> LineIndex:
        filters = stored(turned)
        if filters.filter("full").isEmpty():
            return replace(self, filters=filters.select("shard", "slots"))
        return self._filled(2 * self.shards)

    def save(self, path: str) -> None:
        """Write the index to a new folder."""
        self.refs.write.parquet(f"{path}/refs")
        self.filters.write.parquet(f"{path}/filters")
        state = [(self.shards, self.threshold, self.min_chars)]
        self.refs.sparkSession.createDataFrame(state, "shards int, threshold long, min_chars int").write.parquet(f"{path}/state")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LineIndex:
        state = spark.read.parquet(f"{path}/state").first()
        return cls(spark.read.parquet(f"{path}/refs"), spark.read.parquet(f"{path}/filters"), *state)

    def _suspects(self, texts: DataFrame, low: int, high: int) -> DataFrame:
        """(k1, k2, key): keys of the texts that the filters of shards from ``low`` up to ``high`` seem to know."""
        shards, min_chars = self.shards, self.min_chars
        tables = np.zeros((high - low, BUCKETS, SLOTS), dtype="<u2")
        for row in self.filters.filter(F.col("shard").between(low, high - 1)).toLocalIterator():
            tables[row["shard"] - low] = np.frombuffer(bytes(row["slots"]), dtype="<u2").reshape(BUCKETS, SLOTS)
        held = texts.sparkSession.sparkContext.broadcast(tables)

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            filters = held.value
            for batch in batches:
                rows, names = [], []
                for row, data in enumerate(batch.column("data").to_pylist()):
                    found = names_of(data, min_chars)
                    rows += [row] * len(found)
                    names += found.values()
                if not names:
                    continue
                table = _names_array(names)
                number, print_, first, second = places(table)
                shard = number % shards - low
                ours = (shard >= 0) & (shard < high - low)
                shard = np.where(ours, shard, 0)
                known = ours & ((filters[shard, first] == print_[:, None]).any(axis=1)
                                | (filters[shard, second] == print_[:, None]).any(axis=1))
                pick = np.flatnonzero(known)
                owner = pa.array(np.array(rows)[pick], pa.int64())
                yield pa.RecordBatch.from_pydict({
                    "k1": batch.column("k1").take(owner), "k2": batch.column("k2").take(owner),
                    "key": pa.array([names[i] for i in pick.tolist()], pa.binary())})

        return texts.mapInArrow(probe, "k1 long, k2 long, key binary")

    def clean(self, docs: DataFrame) -> DataFrame:
        """(doc_id, n_lines, n_dropped, kept): every row of ``docs`` without its frequent lines."""
        min_chars = self.min_chars
        data = utf8_bytes(F.col("text"))
        texts = docs.select("doc_id", data.alias("data"), F.xxhash64(data).alias("k1"), F.xxhash64(F.lit(1), data).alias("k2"))
        step = max(1, GROUP_BYTES // (2 * BUCKETS * SLOTS))
        passes = [self._suspects(texts.select("data", "k1", "k2"), low, min(low + step, self.shards))
                  for low in range(0, self.shards, step)]
        # stored, so that Spark can split the join at a line that very many documents have
        suspects = stored(reduce(DataFrame.union, passes).distinct())
        frequent = stored(self.refs.filter(F.col("docs") >= self.threshold).select("key"))
        gone = stored(suspects.join(frequent, "key").groupBy("k1", "k2").agg(F.collect_set("key").alias("gone")))

        def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lines, dropped, kept = [], [], []
                for data, names in zip(batch.column("data").to_pylist(), batch.column("gone").to_pylist(), strict=True):
                    every = data.split(b"\n")
                    stay = every
                    if names:
                        names = set(names)
                        keys = {k for k, name in names_of(data, min_chars).items() if name in names}
                        stay = [line for line in every if line_key(line) not in keys]
                    lines.append(len(every))
                    dropped.append(len(every) - len(stay))
                    kept.append(b"\n".join(stay))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()),
                     pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept"])

        kind = docs.schema["doc_id"].dataType.simpleString()
        return (texts.join(gone, ["k1", "k2"], "left").select("doc_id", "data", "gone")
                .mapInArrow(drop, f"doc_id {kind}, n_lines long, n_dropped long, kept string"))


def drop_frequent_lines(docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = 1) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): lines whose key ``threshold`` rows of ``docs`` have are dropped."""
    return LineIndex.empty(docs.sparkSession, threshold, min_chars).insert(docs).clean(docs)
