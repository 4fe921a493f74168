"""Line dedup: cuckoo filters, exact counts, taking documents back, brute force."""
import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from martkit.llm import line_dedup
from martkit.llm.line_dedup import Cuckoo, LineIndex

from .conftest import ODD

LINES = "doc_id long, text string"


def key(line):
    line = line.strip(" \t\n\x0b\x0c\r")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)


def brute(rows, threshold, min_chars=1, counted=None):
    seen = Counter(k for _, t in (counted or rows) for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(key(x)) < min_chars or seen[key(x)] < threshold]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def cleaned(index, docs):
    return sorted((tuple(r) for r in index.clean(docs).collect()), key=str)


def test_equals_brute_force(spark, documents, odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    for threshold in (2, 10):
        out = line_dedup.drop_frequent_lines(documents, threshold)
        assert sorted(map(tuple, out.collect()), key=str) == brute(rows, threshold)
    out = line_dedup.drop_frequent_lines(odd.withColumn("gone", F.lit(1)), 3, min_chars=2)
    assert sorted(map(tuple, out.collect()), key=str) == brute([(r[0], r[1]) for r in ODD], 3, 2)
    assert line_dedup.drop_frequent_lines(empty).count() == 0


def test_keys_fold_blanks_and_ascii_case_only(spark):
    rows = [(1, "A b\nx"), (2, " a B\t\n\xa0x"), (3, "\x0ba b\r\nÉ"), (4, "é"), (5, "a  b"), (6, "a b\na b"), (7, "\n\n")]
    docs = spark.createDataFrame(rows, LINES)
    out = sorted(map(tuple, line_dedup.drop_frequent_lines(docs, 4).collect()))
    assert out == brute(rows, 4)
    assert [r[2] for r in out] == [1, 1, 1, 0, 0, 2, 0]


def test_deleting_takes_an_insertion_back(spark):
    old = spark.createDataFrame([(i, f"head\nold {i}\ntail") for i in range(9)], LINES)
    new = spark.createDataFrame([(100 + i, f"HEAD\nold {i}\nown {i}") for i in range(4)], LINES)
    first = LineIndex.empty(spark).insert(old)
    both = first.insert(new)
    back = both.delete(new)
    rows = [tuple(r) for r in old.collect()]
    assert cleaned(first, old) == cleaned(back, old) == brute(rows, 10)
    assert cleaned(both, old) == brute(rows, 10, counted=rows + [tuple(r) for r in new.collect()])
    assert sum(r[2] for r in cleaned(both, old)) == 9 and sum(r[2] for r in cleaned(first, old)) == 0
    assert sorted(map(tuple, first.refs.collect())) == sorted(map(tuple, back.refs.collect()))
    held = [np.count_nonzero(np.frombuffer(bytes(r["slots"]), "<u2")) for r in back.filters.collect()]
    assert held == [0]
    assert both.delete(new).delete(old).refs.count() == 0
    with pytest.raises(Exception, match="not inserted"):
        first.delete(new)


def test_shards_double_and_filters_go_out_in_groups(spark, documents, monkeypatch, tmp_path):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 20)
    monkeypatch.setattr(line_dedup, "GROUP_BYTES", 2 * line_dedup.BUCKETS * line_dedup.SLOTS * 3)
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    index = LineIndex.empty(spark, threshold=2).insert(documents)
    assert index.shards > 4 and index.shards & (index.shards - 1) == 0
    assert cleaned(index, documents) == brute(rows, 2)
    index.save(f"{tmp_path}/index")
    again = LineIndex.load(spark, f"{tmp_path}/index")
    assert cleaned(again.insert(documents.limit(0)), documents) == brute(rows, 2)


def test_a_filter_without_room_is_filled_anew_with_more_shards(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 10**9)
    long = "\n".join(f"line {i}" for i in range(140_000))                          # above 131,072 places
    rows = [(1, long), (2, long), (3, "line 7\nown")]
    docs = spark.createDataFrame(rows, LINES)
    index = LineIndex.empty(spark, threshold=2).insert(docs)
    assert index.shards > 1 and cleaned(index, docs) == brute(rows, 2)


def test_cuckoo_filter_holds_and_forgets():
    names = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(100_000)), np.uint8).reshape(-1, 32)
    _, *where = line_dedup.places(names)
    where = list(zip(*[w.tolist() for w in where]))
    cuckoo = Cuckoo()
    assert all(cuckoo.insert(*at) for at in where)
    table = np.frombuffer(Cuckoo(cuckoo.slots()).slots(), "<u2").reshape(line_dedup.BUCKETS, line_dedup.SLOTS)
    assert all(p in table[a] or p in table[b] for p, a, b in where)
    assert all(cuckoo.delete(*at) for at in where) and not any(cuckoo.slots())
    assert not cuckoo.delete(*where[0])
    assert not all(cuckoo.insert(7, 3, 3 ^ (7 * 0x5BD1E995 & (line_dedup.BUCKETS - 1))) for _ in range(9))
