"""Ranked search against scoring every document, with blocks small enough to be skipped."""
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from martkit.llm import ranked_strata
from martkit.llm.common import stored

from .conftest import SF_SMALL

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k):
    """(item_id, rank, doc_id, score) by scoring every row for every item."""
    def terms(text):
        return Counter(TERM.findall((text or "").translate(UPPER)))

    rows = [(i, terms(t)) for i, t in docs]
    rows = [(i, c) for i, c in rows if c]
    n, length = len(rows), sum(sum(c.values()) for _, c in rows)
    df = Counter(t for _, c in rows for t in c)
    out = []
    for item_id, text in items:
        asked, scores = terms(text), []
        for i, c in rows:
            m = 100 - 25 + 25 * sum(c.values()) * n // length
            score = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t, q in asked.items() if c[t])
            if score > 0:
                scores.append((-score, i is None, i))
        best = sorted(scores)[:k]
        out += [(item_id, at + 1, i, -s) for at, (s, _, i) in enumerate(best)]
    return sorted(out, key=str)


def ranked(docs, items, k):
    return sorted((tuple(r) for r in ranked_strata.rank(docs, items, k).select("item_id", "rank", "doc_id", "score").collect()),
                  key=str)


@pytest.mark.parametrize("block,visits,query_bytes", [(4096, 8, 4 << 20), (5, 1, 200)])
def test_equals_brute_force(spark, documents, monkeypatch, block, visits, query_bytes):
    monkeypatch.setattr(ranked_strata, "BLOCK_DOCS", block)
    monkeypatch.setattr(ranked_strata, "FIRST_VISITS", visits)
    monkeypatch.setattr(ranked_strata, "QUERY_BYTES", query_bytes)
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").limit(6 if block == 5 else 40)
    texts = [(r["doc_id"], r["text"]) for r in documents.collect()]
    asked = [(r["item_id"], r["text"]) for r in items.collect()]
    assert ranked(documents, items, 20) == brute(texts, asked, 20)


def test_odd_rows_ties_and_empty_tables(spark, odd, empty):
    items = spark.createDataFrame([(1, "one ONE seven nothing"), (2, None), (3, ""), (4, "zzz"), (5, "X1 w5x5 é 12345"),
                                   (5, "three")], "item_id long, text string").withColumn("score", F.lit(1))
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    for k in (2, 20):
        assert ranked(odd, items, k) == brute(texts, [(r["item_id"], r["text"]) for r in items.collect()], k)
    assert ranked(empty, items, 3) == [] and ranked(odd, items.limit(0), 3) == []


def test_index_orders_postings_by_tf_in_strata(documents):
    index, n = ranked_strata.build_index(documents)
    rows, postings = index.collect(), 0
    for row in rows:
        starts = [*row["starts"], len(row["tfs"])]
        assert sorted(row["terms"]) == row["terms"]
        for a, b in zip(starts, starts[1:]):
            assert b > a and row["tfs"][a:b] == sorted(row["tfs"][a:b])
        postings += len(row["docs"])
    assert sum(len(row["ids"]) for row in rows) == n == documents.count()
    assert postings == sum(len({*ranked_strata.terms_of(r["text"].encode())}) for r in documents.collect())


def test_blocks_below_the_last_place_are_not_visited(spark, monkeypatch):
    rows = [(i, "rare " * 5 + "filler") for i in range(20)] + [(100 + i, "filler " * 40 + "rare") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(ranked_strata, "FIRST_VISITS", 1)
    items = spark.createDataFrame([(1, "rare")], "item_id long, text string")
    assert [r[2] for r in sorted(ranked(docs, items, 20), key=lambda r: r[1])] == list(range(20))
    index, n = ranked_strata.build_index(docs)
    index = stored(index.withColumn("block", F.monotonically_increasing_id()))
    queries = ranked_strata._Queries([(1, Counter([b"rare"]))])
    queries.weights[:] = ranked_strata.weight(n, 220)
    best = sorted((r["bound"], r["block"]) for r in ranked_strata._bounds(
        ranked_strata._marks(index, queries.terms), queries).collect())
    early = ranked_strata._visit(index, queries, 20, {best[-1][1]: [0]}, None).collect()
    least = np.array([min(r["score"] for r in early)])
    assert len(early) == 20 and len(best) > 1 and best[-2][0] < least[0]
    assert ranked_strata._visit(index, queries, 20, {best[-1][1]: [0]}, least).count() == 0
