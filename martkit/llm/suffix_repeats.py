"""Repeated byte strings through common-prefix intervals of a sparse suffix array.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere
else (in any text, the same one included). Not every suffix is sorted: of the
``LENGTH - GRAM + 1`` grams of ``GRAM`` bytes inside any ``LENGTH`` bytes, the one
with the smallest hash is an anchor, so equal strings hold equal anchors at equal
places, about one for each hundred bytes. An anchor's context is what lies within
reach of a string around it: ``LENGTH - GRAM`` bytes before and behind the gram.

1. Anchors whose gram occurs once go. Anchors with equal contexts are combined
   by a partial aggregate; a context that occurs twice or more is repeated whole.
2. One occurrence of each context that shares its gram with other contexts is
   looked up in the texts. Spark sorts these contexts by (gram, bytes behind):
   a sparse suffix array, cut at grams. Each task scans it with a stack and gets
   the tree of common-prefix intervals. The members of an interval are compared
   by the bytes before the gram (their order and common lengths follow from a
   second sort); left lengths that differ inside an interval give maximal repeats,
   and every member learns its longest repeat to the left and to the right, with
   all occurrences and not only with its neighbours.
3. What is found for a context holds for all its occurrences; spans are merged for
   each text, and the bytes are removed.

A gram shared by more than ``MAX_CONTEXTS`` different contexts is not scanned by one
task: a repeat of ``LENGTH`` bytes there goes on for half of the remaining bytes behind the
gram, or for the other half before it, so its contexts are dealt anew by the bytes of
either half, and groups that are still larger again, until the tree of every group fits
a task or the group shares ``LENGTH`` bytes as a whole. Results are the same at any bound.
Texts are named by 128 bits of their hash, contexts by gram and context hash.

Defined results: a null text counts as empty. Texts shorter than ``LENGTH`` stay.
Repeated rows count as different places. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import stored, utf8_bytes

LENGTH = 400
GRAM = 160
MAX_CONTEXTS = 20_000
#: Positions handled at a time in one text; below 2 ** 24.
SEGMENT = 1 << 20
_PLACE_BITS = np.uint64(24)
_rng = np.random.default_rng(400)
_BYTE_CODE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, np.uint64(base), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER = _powers(_BASE, SEGMENT + LENGTH + 2)
_POWER_BACK = _powers(_INVERSE, SEGMENT + LENGTH + 2)


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """Places of the grams that have the smallest hash in some string of ``length`` bytes."""
    found = []
    window = length - gram + 1
    for first in range(0, len(data) - length + 1, SEGMENT):
        part = np.frombuffer(data, dtype=np.uint8, offset=first, count=min(SEGMENT + length - 1, len(data) - first))
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODE[part] * _POWER[:len(part)], out=sums[1:])
        count = len(part) - gram + 1
        value = (sums[gram:] - sums[:-gram]) * _POWER_BACK[:count]
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        value >>= _PLACE_BITS
        value <<= _PLACE_BITS
        top = np.uint64((1 << 24) - 1)
        value |= top - np.arange(count, dtype=np.uint64)
        padded = np.full(-(-count // window) * window, np.iinfo(np.uint64).max, dtype=np.uint64)
        padded[:count] = value
        blocks = padded.reshape(-1, window)
        ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
        back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        least = np.minimum(back[:count - window + 1], ahead[window - 1:count])
        found.append(first + np.unique((top - (least & top)).astype(np.int64)))
    return np.unique(np.concatenate(found)) if found else np.empty(0, dtype=np.int64)


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, data, k1, k2): the bytes of each text and two hashes that name it."""
    data = utf8_bytes(F.col("text"))
    return docs.select("doc_id", data.alias("data"), F.xxhash64(data).alias("k1"),
                       F.xxhash64(F.lit(1), data).alias("k2"))


def anchor_rows(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, k1, k2, gram, context, place, before, behind), one row per anchor.

    ``before`` and ``behind`` are the bytes of the context on either side of the
    gram's first byte.
    """
    reach = length - gram
    keyed = _keyed(docs)
    schema = keyed.select("doc_id", "k1", "k2", *[F.lit(0).cast("long").alias(c) for c in ("gram", "context", "place")],
                          *[F.lit(0).alias(c) for c in ("before", "behind")]).schema

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            owner, grams, contexts, places, befores, behinds = [], [], [], [], [], []
            for row, data in enumerate(batch.column("data").to_pylist()):
                found = anchors(data, length, gram)
                before, behind = np.minimum(found, reach).tolist(), np.minimum(len(data) - found, length).tolist()
                found = found.tolist()
                owner += [row] * len(found)
                grams += [digest(data[p:p + gram]) for p in found]
                contexts += [digest(data[p - b:p + e], b) for p, b, e in zip(found, before, behind, strict=True)]
                places += found
                befores += before
                behinds += behind
            pick = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pick) for c in ("doc_id", "k1", "k2")]
                + [pa.array(np.array(c, dtype=np.uint64).view(np.int64)) for c in (grams, contexts)]
                + [pa.array(places, pa.int64()), pa.array(befores, pa.int32()), pa.array(behinds, pa.int32())],
                names=schema.names)

    return keyed.mapInArrow(find, schema)


def _common(rows: list[bytes], same: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the one before it; -1 where ``same`` is false."""
    width = max(map(len, rows), default=0) + 1
    grid = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), dtype=np.uint8).reshape(-1, width)
    size = np.array([len(r) for r in rows])
    differ = grid[1:] != grid[:-1]
    differ[:, -1] = True
    shared = np.minimum(differ.argmax(axis=1), np.minimum(size[1:], size[:-1]))
    return np.r_[-1, np.where(same, shared, -1)]


def intervals(common: np.ndarray) -> list[tuple[int, int, int]]:
    """(common prefix, first row, last row) of every interval of the tree, children before parents."""
    out, stack = [], []
    for i, shared in enumerate([*common[1:].tolist(), -1], start=1):
        first = i - 1
        while stack and stack[-1][0] > shared:
            depth, first = stack.pop()
            out.append((depth, first, i - 1))
        if shared >= 0 and (not stack or stack[-1][0] < shared):
            stack.append((shared, first))
    return out


class _RangeMin:
    def __init__(self, values: np.ndarray):
        self.table = [values]
        step = 1
        while 2 * step <= len(values):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Smallest value of each range, both ends included."""
        level = np.log2(high - low + 1).astype(np.int64)
        out = np.empty(len(low), dtype=np.int64)
        for k in np.unique(level).tolist():
            pick = level == k
            out[pick] = np.minimum(self.table[k][low[pick]], self.table[k][high[pick] - (1 << k) + 1])
        return out


def extents(group: np.ndarray, left: list[bytes], right: list[bytes], reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes before and behind the gram up to which each context is repeated; -1 where it is not.

    Rows are sorted by (group, right); ``left`` runs away from the gram. A repeat
    needs ``reach`` bytes on both sides together.
    """
    size = len(group)
    best_left, best_right = np.full(size, -1), np.full(size, -1)
    if size < 2:
        return best_left, best_right
    tree = intervals(_common(right, group[1:] == group[:-1]))
    order = np.array(sorted(range(size), key=lambda i: (group[i], left[i])))
    rank = np.empty(size, dtype=np.int64)
    rank[order] = np.arange(size)
    least = _RangeMin(_common([left[i] for i in order], group[order][1:] == group[order][:-1]))

    def learn(rows: np.ndarray, shared: np.ndarray, depth: np.ndarray | int) -> None:
        repeated = shared + depth >= reach
        rows = rows[repeated]
        np.maximum.at(best_left, rows, shared[repeated])
        np.maximum.at(best_right, rows, np.broadcast_to(depth, repeated.shape)[repeated])

    pairs = np.array([(d, a) for d, a, b in tree if b == a + 1], dtype=np.int64).reshape(-1, 2)
    if len(pairs):
        depth, first = pairs.T
        ends = np.sort(np.stack([rank[first], rank[first + 1]]), axis=0)
        shared = least(ends[0] + 1, ends[1])
        learn(first, shared, depth)
        learn(first + 1, shared, depth)
    for depth, first, last in tree:
        if last > first + 1:
            ranks = np.sort(rank[first:last + 1])
            between = least(ranks[:-1] + 1, ranks[1:])
            if between.max() + depth >= reach:
                learn(order[ranks], np.maximum(np.r_[0, between], np.r_[between, 0]), depth)
    return best_left, best_right


def _contexts(wanted: DataFrame, docs: DataFrame, gram: int) -> DataFrame:
    """(gram, context, left, right): the bytes of one occurrence of each wanted context."""
    by_text = wanted.groupBy("k1", "k2", F.col("doc_id").alias("own_id")).agg(
        F.collect_list(F.struct("gram", "context", "place", "before", "behind")).alias("wanted"))
    texts = _keyed(docs)
    joined = texts.join(by_text, ["k1", "k2"]).filter(F.col("doc_id").eqNullSafe(F.col("own_id")))
    at = F.col("at")
    return joined.select("data", F.explode("wanted").alias("at")).select(
        at["gram"].alias("gram"), at["context"].alias("context"),
        F.substring("data", at["place"] - at["before"] + 1, at["before"]).alias("left"),
        F.substring("data", at["place"] + gram + 1, at["behind"] - gram).alias("right"))


def _scan(frame: pd.DataFrame, reach: int, gram: int) -> pd.DataFrame:
    frame = frame.drop_duplicates(["group", "context"], ignore_index=True)
    left, right = extents(frame["group"].to_numpy(), [bytes(x)[::-1] for x in frame["left"]],
                          [bytes(x) for x in frame["right"]], reach)
    found = left >= 0
    return pd.DataFrame({"gram": frame["gram"][found], "context": frame["context"][found],
                         "before": left[found].astype(np.int32),
                         "behind": (right[found] + gram).astype(np.int32)})


def interval_extents(contexts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(gram, context, before, behind): how far each context is repeated in its group, by the interval tree."""
    reach = length - gram

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            if held is not None:
                frame = pd.concat([held, frame], ignore_index=True)
            tail = (frame["group"] == frame["group"].iloc[-1]).to_numpy()
            held = frame[tail]
            if not tail.all():
                yield _scan(frame[~tail], reach, gram)
        if held is not None:
            yield _scan(held, reach, gram)

    return (contexts.select("group", "gram", "context", "left", "right").repartition("group")
            .sortWithinPartitions("group", "right", "context")
            .mapInPandas(scan, "gram long, context long, before int, behind int"))


def split_extents(contexts: DataFrame, length: int = LENGTH, gram: int = GRAM,
                  max_contexts: int = MAX_CONTEXTS) -> DataFrame:
    """The same for grams of more than ``max_contexts`` contexts: groups are split until a task can scan them.

    The members of a group share ``x`` bytes before the gram and ``y`` behind it. With r bytes missing for a
    repeat, a pair that repeats shares half of r more behind the gram, or else more than the other half before it.
    """
    reach = length - gram
    rows = stored(contexts.dropDuplicates(["gram", "context"]).select(
        F.col("gram").alias("group"), F.lit(0).alias("x"), F.lit(0).alias("y"), "gram", "context", "left", "right"))
    parts: list[DataFrame] = []
    while True:
        half = F.ceil((reach - F.col("x") - F.col("y")) / 2).cast("int")
        behind = rows.withColumn("y", F.col("y") + half).filter(F.octet_length("right") >= F.col("y"))
        before = rows.withColumn("x", reach - F.col("y") - half + 1).filter(F.octet_length("left") >= F.col("x"))
        dealt = behind.withColumn("group", F.xxhash64("group", F.lit(1), F.expr("substring(right, 1, y)"))).union(
            before.withColumn("group", F.xxhash64("group", F.lit(0), F.expr("substring(left, octet_length(left) - x + 1, x)"))))
        dealt = stored(dealt)
        sizes = stored(dealt.groupBy("group").agg(F.count("*").alias("n")).filter("n > 1"))
        shared = dealt.join(sizes, "group")
        whole = F.col("x") + F.col("y") >= reach
        parts.append(shared.filter(whole).select("gram", "context", F.col("x").alias("before"), (F.col("y") + gram).alias("behind")))
        parts.append(interval_extents(shared.filter(~whole & (F.col("n") <= max_contexts)), length, gram))
        rows = stored(shared.filter(~whole & (F.col("n") > max_contexts)).select(*rows.columns))
        if rows.isEmpty():
            break
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
            max_contexts: int = MAX_CONTEXTS) -> DataFrame:
    """(k1, k2, spans): for each text with repeats, the sorted spans (from, until) that go."""
    found = stored(anchor_rows(docs, length, gram))
    # counted sides are stored: a join of two stored tables can be split where a gram is hot
    again = stored(found.groupBy("gram").agg(F.count("*").alias("uses")).filter("uses > 1").select("gram"))
    kept = stored(found.join(again, "gram", "left_semi"))
    contexts = stored(kept.groupBy("gram", "context").agg(
        F.count("*").alias("uses"),
        F.min(F.struct("k1", "k2", "place", "before", "behind", "doc_id")).alias("one")))
    grams = stored(contexts.groupBy("gram").agg(F.count("*").alias("kinds")).filter("kinds > 1"))
    shared = contexts.join(grams, "gram").select("gram", "context", "kinds", "one.*")
    parts = []
    for wide in (False, True):
        pick = shared.filter(F.col("kinds") > max_contexts if wide else F.col("kinds") <= max_contexts)
        text = _contexts(pick, docs, gram)
        if not wide:
            parts.append(interval_extents(text.withColumn("group", F.col("gram")), length, gram))
        elif not pick.isEmpty():
            parts.append(split_extents(text, length, gram, max_contexts))
    parts.append(contexts.filter("uses > 1").select("gram", "context", "one.before", "one.behind"))
    extent = parts[0]
    for part in parts[1:]:
        extent = extent.union(part)
    extent = stored(extent.groupBy("gram", "context").agg(F.max("before").alias("back"), F.max("behind").alias("on")))
    spans = kept.join(extent, ["gram", "context"]).select(
        "k1", "k2", F.struct((F.col("place") - F.col("back")).alias("from"),
                             (F.col("place") + F.col("on")).alias("until")).alias("span"))
    return spans.groupBy("k1", "k2").agg(F.sort_array(F.collect_set("span")).alias("spans"))


def removed(data: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """Bytes removed, runs removed and the rest; ``spans`` sorted."""
    kept = []
    gone = runs = end = 0
    for start, until in spans:
        if runs == 0 or start > end:
            kept.append(data[end:start])
            gone += until - start
            runs += 1
            end = until
        elif until > end:
            gone += until - end
            end = until
    kept.append(data[end:])
    return gone, runs, b"".join(kept)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                   max_contexts: int = MAX_CONTEXTS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text), one row per row of ``docs``.

    ``kept_text`` are the remaining bytes as text; a character cut in two shows as U+FFFD.
    """
    joined = _keyed(docs).join(repeats(docs, length, gram, max_contexts), ["k1", "k2"], "left")

    @F.pandas_udf("struct<n_removed: long, n_spans: long, kept_sha256: string, kept_text: string>")
    def apply(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for data, spans in batches:
            rows = []
            for d, s in zip(data, spans, strict=True):
                gone, runs, kept = removed(bytes(d), [(x["from"], x["until"]) for x in s] if s is not None else [])
                rows.append((gone, runs, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
            yield pd.DataFrame(rows, columns=["n_removed", "n_spans", "kept_sha256", "kept_text"])

    return (joined.select("doc_id", F.octet_length("data").cast("long").alias("n_bytes"),
                          apply.asNondeterministic()("data", "spans").alias("done"))
            .select("doc_id", "n_bytes", "done.*"))
