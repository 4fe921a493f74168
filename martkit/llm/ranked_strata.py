"""Ranked lexical search over an index stratified by length.

Terms are runs of ASCII letters, digits and characters from U+0080 on, A-Z lower-cased.
A document's normaliser m depends on its length alone, so all documents of a stratum
(equal m) give equal impacts for equal term frequencies tf:
``impact(tf, m) = 10^9 * tf div (1000 * tf + 12 * m)``. A document scores the sum over
the query's terms, repeats included, of weight(term) * impact(tf, m).

1. Tasks read whole texts and count documents by their number of terms; N, L and the size of
   every stratum follow from that histogram.
2. Spark deals the documents' distinct terms out by stratum; a stratum with many documents or
   postings is dealt in several parts. At most ``BLOCK_DOCS`` documents or ``BLOCK_POSTINGS``
   postings of one stratum (a longer document comes alone) become a block: one row with the
   block's sorted terms and its postings, ordered by term and by tf within the term. Impacts
   are computed once per tf. Every row is indexed; the index does not depend on any query.
3. Queries come in bounded groups of whole items. Each block tells, for each term of the
   group, in how many documents it is (sums: df) and its largest tf. These give a bound for
   every item and block: no document there scores more.
4. Blocks are visited by their bounds: each item's ``FIRST_VISITS`` highest first, then every
   other block whose bound reaches the score of the item's last place so far. Other blocks
   cannot hold a result. A visited block hands on its best ``k``. The index stays where it is:
   what goes to its blocks (weights, last places, first visits) is bounded by the group.

Defined results: a null text has no terms; documents without a term score nothing.
Every row is a document, repeated rows too; equal scores are ordered by doc_id, null
last. An item without a term of the corpus has no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martkit.llm.common import stored, utf8_bytes

TOP = 20
BLOCK_DOCS, BLOCK_POSTINGS = 4096, 400_000
FIRST_VISITS = 8
#: Bytes of distinct terms that a task holds before it hands them on.
BYTES_HELD = 2 << 20
#: UTF-8 bytes of the terms of the items that are searched at a time (a longer item comes alone).
QUERY_BYTES = 4 << 20

_ALNUM = b"0123456789abcdefghijklmnopqrstuvwxyz"
_TERMS = bytes(ord(chr(b).lower()) if 65 <= b <= 90 else b if b >= 0x80 or b in _ALNUM else 32 for b in range(256))


def terms_of(data: bytes) -> list[bytes]:
    """Terms of UTF-8 bytes, in order, with repeats."""
    return data.translate(_TERMS).split()


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def normaliser(n: int, docs: int, length: int) -> int:
    return 100 - 25 + (25 * n * docs) // length


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    tf = tf.astype(np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def length_histogram(docs: DataFrame) -> DataFrame:
    """(n, docs, postings): rows of ``docs`` with n terms, n above 0, and the sum of their distinct terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes: Counter[int] = Counter()
        postings: Counter[int] = Counter()
        for batch in batches:
            for row in range(batch.num_rows):
                every = terms_of(batch.column("data")[row].as_py())
                if every:
                    sizes[len(every)] += 1
                    postings[len(every)] += len(set(every))
        yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in (
            ("n", list(sizes)), ("docs", list(sizes.values())), ("postings", [postings[n] for n in sizes]))})

    return (docs.select(utf8_bytes(F.col("text")).alias("data")).mapInArrow(count, "n long, docs long, postings long")
            .groupBy("n").agg(F.sum("docs").alias("docs"), F.sum("postings").alias("postings")))


def term_counts(docs: DataFrame, corpus: int, length: int) -> DataFrame:
    """(doc_id, m, terms, tfs, spread): one row per row of ``docs`` with a term.

    ``terms`` are joined by spaces, ``tfs`` little-endian 32-bit numbers; ``spread`` numbers the
    rows of a task. ``corpus`` and ``length`` are N and L.
    """
    texts = docs.select("doc_id", utf8_bytes(F.col("text")).alias("data"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            rows: list[int] = []
            columns: tuple[list, list, list] = ([], [], [])
            size = 0
            for row in range(batch.num_rows):
                every = terms_of(batch.column("data")[row].as_py())
                if every:
                    found = Counter(every)
                    rows.append(row)
                    for column, value in zip(columns, (
                            normaliser(len(every), corpus, length), b" ".join(found),
                            np.fromiter(found.values(), dtype="<u4", count=len(found)).tobytes()), strict=True):
                        column.append(value)
                    size += len(columns[1][-1])
                if rows and (size >= BYTES_HELD or row + 1 == batch.num_rows):
                    m, terms, tfs = columns
                    number = np.arange(before, before + len(rows), dtype=np.int64) * 0x9E3779B1 % (1 << 31)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(rows)), pa.array(m, pa.int64()), pa.array(terms, pa.binary()),
                         pa.array(tfs, pa.binary()), pa.array(number)], names=["doc_id", "m", "terms", "tfs", "spread"])
                    before += len(rows)
                    rows, columns, size = [], ([], [], []), 0

    return texts.mapInArrow(count, f"doc_id {kind}, m long, terms binary, tfs binary, spread long")


def _block(m: int, ids: pa.Array, terms: pa.Array, tfs: np.ndarray, docs: np.ndarray) -> dict:
    """A stratum's documents as postings ordered by term, then tf, then document."""
    coded = terms.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    term = rank[coded.indices.to_numpy()]
    by = np.lexsort((docs, tfs, term))
    return {"m": m, "ids": ids, "terms": coded.dictionary.take(pa.array(order)),
            "starts": np.searchsorted(term[by], np.arange(len(order))).astype(np.int32),
            "tfs": tfs[by].astype(np.int32), "docs": docs[by].astype(np.int32)}


def build_index(docs: DataFrame) -> tuple[DataFrame, int]:
    """The index and N. Index: (m, ids, terms, starts, tfs, docs), one row per block.

    The postings of ``terms[i]`` begin at ``starts[i]`` in ``tfs`` and ``docs``; ``docs``
    are places in ``ids``.
    """
    sizes = stored(length_histogram(docs))
    corpus, length = sizes.agg(F.sum("docs"), F.sum(F.col("n") * F.col("docs"))).first()
    corpus, length = corpus or 0, length or 1
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"m long, ids array<{kind}>, terms array<binary>, starts array<int>, tfs array<int>, docs array<int>"

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        docs_held = postings = 0
        stratum = None

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal docs_held, postings
            if docs_held:
                table = pa.Table.from_batches(held)
                tfs = [np.frombuffer(x, dtype="<u4") for x in table["tfs"].to_pylist()]
                terms = b" ".join(table["terms"].to_pylist()).split(b" ")
                made = _block(stratum, table["doc_id"].combine_chunks(), pa.array(terms, pa.binary()), np.concatenate(tfs),
                              np.repeat(np.arange(len(tfs)), [len(x) for x in tfs]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([made["m"]], pa.int64())]
                    + [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v if isinstance(v, pa.Array) else pa.array(v))
                       for v in (made[c] for c in ("ids", "terms", "starts", "tfs", "docs"))],
                    names=["m", "ids", "terms", "starts", "tfs", "docs"])
            held.clear()
            docs_held = postings = 0

        for batch in batches:
            here = batch.column("m").to_numpy()
            more = pc.divide(pc.binary_length(batch.column("tfs")), 4).to_numpy()
            first = 0
            for row in range(batch.num_rows):
                if here[row] != stratum or docs_held + row - first >= BLOCK_DOCS or postings + more[row] > BLOCK_POSTINGS:
                    if row > first:
                        held.append(batch.slice(first, row - first))
                        docs_held += row - first
                    yield from out()
                    first, stratum = row, int(here[row])
                postings += int(more[row])
            held.append(batch.slice(first))
            docs_held += batch.num_rows - first
        yield from out()

    m = F.lit(75).cast("long") + F.expr(f"(25 * n * {corpus}) div {length}")
    parts = sizes.groupBy(m.alias("m")).agg(F.sum("docs").alias("docs"), F.sum("postings").alias("postings")).select(
        "m", F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS), F.ceil(F.col("postings") / BLOCK_POSTINGS)).alias("parts"))
    # only strata of several parts: few rows, whose size Spark knows when it plans the join
    large = stored(parts.filter("parts > 1"))
    part = F.coalesce(F.col("spread") % F.col("parts"), F.lit(0).cast("long"))
    dealt = term_counts(docs, corpus, length).join(large, "m", "left").select("doc_id", "m", "terms", "tfs", part.alias("part"))
    index = (dealt.repartition("m", "part").sortWithinPartitions("m", "part")
             .select("doc_id", "m", "terms", "tfs").mapInArrow(blocks, schema))
    return index, corpus


def query_groups(items: DataFrame) -> Iterator[list[tuple]]:
    """Items as (item_id, Counter of terms), in bounded groups; the driver holds one group at a time."""
    group, size = [], 0
    for row in items.select("item_id", utf8_bytes(F.col("text")).alias("data")).toLocalIterator():
        found = Counter(terms_of(bytes(row["data"])))
        more = sum(map(len, found)) + 16 * len(found)
        if group and size + more > QUERY_BYTES:
            yield group
            group, size = [], 0
        group.append((row["item_id"], found))
        size += more
    if group:
        yield group


class _Queries:
    """A group of items over its own sorted vocabulary."""

    def __init__(self, group: list[tuple]):
        self.terms = sorted(set().union(*[found for _, found in group]))
        place = {t: i for i, t in enumerate(self.terms)}
        self.items = [(np.array([place[t] for t in found], dtype=np.int64),
                       np.array(list(found.values()), dtype=np.int64)) for _, found in group]
        self.weights = np.zeros(len(self.terms), dtype=np.int64)

    def flat(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, term, weight * repeats) of all items."""
        item = np.repeat(np.arange(len(self.items)), [len(t) for t, _ in self.items])
        term = np.concatenate([t for t, _ in self.items])
        return item, term, self.weights[term] * np.concatenate([q for _, q in self.items])


def _marks(index: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(block, m, term, df, tf): for each block and query term (by number) its documents and its largest tf."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(vocabulary, pa.binary())
        for batch in batches:
            for row in range(batch.num_rows):
                at = pc.index_in(wanted, value_set=batch.column("terms")[row].values)
                there = pc.is_valid(at).to_numpy(zero_copy_only=False)
                place = at.drop_null().to_numpy()
                tfs = batch.column("tfs")[row].values.to_numpy()
                starts = batch.column("starts")[row].values.to_numpy().astype(np.int64)
                ends = np.r_[starts[1:], len(tfs)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("block").slice(row, 1), batch.column("m").slice(row, 1)]
                    + [pa.ListArray.from_arrays(pa.array([0, len(place)], pa.int32()), pa.array(v.astype(np.int32))) for v in (
                        np.flatnonzero(there), (ends - starts)[place], tfs[ends[place] - 1])],
                    names=["block", "m", "term", "df", "tf"])

    return index.select("block", "m", "terms", "starts", "tfs").mapInArrow(
        read, "block long, m long, term array<int>, df array<int>, tf array<int>")


def _bounds(marks: DataFrame, queries: _Queries) -> DataFrame:
    """(block, item, bound) where the bound is above 0."""
    item, term, gain = queries.flat()
    count = len(queries.items)

    def bound(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = np.zeros(len(queries.terms), dtype=np.int64)
        for frame in frames:
            for block, m, terms, tfs in frame[["block", "m", "term", "tf"]].itertuples(index=False):
                best[:] = 0
                best[terms] = impact(np.asarray(tfs), m)
                total = np.zeros(count, dtype=np.int64)
                np.add.at(total, item, gain * best[term])
                some = np.flatnonzero(total)
                yield pd.DataFrame({"block": np.int64(block), "item": some.astype(np.int32), "bound": total[some]})

    return marks.mapInPandas(bound, "block long, item int, bound long")


def _visit(index: DataFrame, queries: _Queries, k: int, first: dict[int, list[int]], least: np.ndarray | None) -> DataFrame:
    """(item, doc_id, score): the ``k`` best of each visited block and item, above 0.

    Without ``least``: the visits in ``first`` (block: items). With it: every other visit whose bound
    reaches the item's ``least``, where lower scores are left out.
    """
    kind = index.schema["ids"].dataType.elementType.simpleString()
    flat = queries.flat()

    def due(block: int, best: np.ndarray) -> list[int]:
        """Items to visit, by the impact of each query term's largest tf."""
        if least is None:
            return first[block]
        item, term, gain = flat
        bound = np.zeros(len(queries.items), dtype=np.int64)
        np.add.at(bound, item, gain * best[term])
        bound[first.get(block, [])] = 0
        return np.flatnonzero(bound >= least).tolist()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(queries.terms, pa.binary())
        for batch in batches:
            for row in range(batch.num_rows):
                at = pc.index_in(vocabulary, value_set=batch.column("terms")[row].values).fill_null(-1).to_numpy()
                tfs, docs = (batch.column(c)[row].values.to_numpy() for c in ("tfs", "docs"))
                starts = np.r_[batch.column("starts")[row].values.to_numpy().astype(np.int64), len(tfs)]
                kinds, which = np.unique(tfs, return_inverse=True)
                gains = impact(kinds, batch.column("m")[row].as_py())            # once per tf
                best = np.where(at >= 0, gains[which[starts[at + 1] - 1]], 0)
                ids = batch.column("ids")[row].values
                order = pc.rank(ids, sort_keys="ascending", null_placement="at_end", tiebreaker="first").to_numpy()
                for item in due(batch.column("block")[row].as_py(), best):
                    terms, repeats = queries.items[item]
                    place = at[terms]
                    known = place >= 0
                    place, worth = place[known], queries.weights[terms[known]] * repeats[known]
                    sizes = starts[place + 1] - starts[place]
                    if not sizes.sum():
                        continue
                    posting = np.repeat(starts[place] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
                    total = np.zeros(len(ids), dtype=np.int64)
                    np.add.at(total, docs[posting], np.repeat(worth, sizes) * gains[which[posting]])
                    found = np.flatnonzero(total >= (1 if least is None else least[item]))
                    chosen = found[np.lexsort((order[found], -total[found]))[:k]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(chosen), item, dtype=np.int32)), ids.take(pa.array(chosen)),
                         pa.array(total[chosen])], names=["item", "doc_id", "score"])

    chosen = index if least is not None else index.filter(F.col("block").isin(list(first)))
    return chosen.select("block", "m", "ids", "terms", "starts", "tfs", "docs").mapInArrow(
        score, f"item int, doc_id {kind}, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` highest of each item, with their rank."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(index: DataFrame, items: DataFrame, docs: int, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``k`` best documents of each item.

    ``index`` is a stored index with a column ``block`` that numbers its rows; ``docs``
    counts the documents with a term.
    """
    spark = index.sparkSession
    ids, key = index.schema["ids"].dataType.elementType.simpleString(), items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {key}, rank int, doc_id {ids}, score long")
    for group in query_groups(items):
        queries = _Queries(group)
        if not queries.terms:
            continue
        marks = stored(_marks(index, queries.terms))
        counted = marks.select(F.explode(F.arrays_zip("term", "df")).alias("at")).groupBy("at.term").agg(F.sum("at.df").alias("df"))
        for row in counted.toLocalIterator():
            queries.weights[row["term"]] = weight(docs, row["df"])
        by_bound = Window.partitionBy("item").orderBy(F.desc("bound"), "block")
        visits: dict[int, list[int]] = {}
        for row in (_bounds(marks, queries).withColumn("place", F.row_number().over(by_bound))
                    .filter(F.col("place") <= FIRST_VISITS).toLocalIterator()):
            visits.setdefault(row["block"], []).append(row["item"])
        if not visits:
            continue
        early = stored(_best(_visit(index, queries, k, visits, None), k))
        least = np.ones(len(group), dtype=np.int64)
        for row in early.filter(F.col("rank") == k).toLocalIterator():
            least[row["item"]] = row["score"]
        late = _visit(index, queries, k, visits, least)
        names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(group)], f"item int, item_id {key}")
        best = stored(_best(early.drop("rank").union(late), k))
        out = out.union(best.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return out


def rank(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """Index ``docs`` and search it for ``items``."""
    index, n = build_index(docs)
    return search(stored(index.withColumn("block", F.monotonically_increasing_id())), items, n, k)
