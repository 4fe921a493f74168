"""Chains followed by link targets, against a client that follows them one by one."""
import os
import random

from pyspark.sql import functions as F

from martkit.sources import follow_links

PAGE = "day string, at string, link string, status int, is_first boolean, body int"


def client(pages):
    """{(day, at): (rank, complete)} as a client would see it."""
    days = {}
    for day, at, link, status, first, _ in pages:
        if at is not None:
            days.setdefault(day, {}).setdefault(at, set()).add((link or None, status == 200, first))
    out = {}
    for day, addresses in days.items():
        starts = [at for at, seen in addresses.items() if any(f for _, _, f in seen)]
        good = {at: next(iter(seen))[0] for at, seen in addresses.items()
                if len({link for link, _, _ in seen}) == 1 and all(ok for _, ok, _ in seen)}
        starts = [s for s in starts if s in good]
        if len(starts) != 1:
            continue
        at, got = starts[0], {}
        while at in good and at not in got:
            got[at] = len(got)
            at = good[at]
        out |= {(day, a): (r, at is None) for a, r in got.items()}
    return out


def check(spark, pages):
    df = spark.createDataFrame(pages, PAGE)
    out = follow_links(df, ["day"], "at", "link", F.col("is_first"), F.col("status") == 200)
    assert out.columns == [*df.columns, "page_rank", "complete"]
    got = [(r.day, r.at, r.body, r.page_rank, r.complete) for r in out.collect()]
    want = client(pages)
    assert sorted(got, key=str) == sorted(((d, a, b, *want[(d, a)]) for d, a, _, _, _, b in pages if (d, a) in want), key=str)


def test_kinds_of_chains(spark):
    chains = {
        "one": [("a", None, 200, True)], "empty link": [("a", "", 200, True)],
        "whole": [("a", "b", 200, True), ("c", None, 200, False), ("b", "c", 200, False)],
        "failed": [("a", "b", 200, True), ("b", "c", 500, False), ("c", None, 200, False)],
        "null status": [("a", "b", 200, True), ("b", None, None, False)],
        "dangling": [("a", "b", 200, True), ("b", "x", 200, False)],
        "cycle": [("a", "b", 200, True), ("b", "c", 200, False), ("c", "b", 200, False)],
        "self": [("a", "a", 200, True)],
        "fork": [("a", "b", 200, True), ("b", "c", 200, False), ("b", "d", 200, False), ("c", None, 200, False)],
        "half fork": [("a", "b", 200, True), ("b", "c", 200, False), ("b", None, 200, False), ("c", None, 200, False)],
        "repeated": [("a", "b", 200, True), ("b", None, 200, False), ("b", None, 200, False)],
        "merge": [("a", "c", 200, True), ("b", "c", 200, False), ("c", None, 200, False)],
        "two firsts": [("a", "b", 200, True), ("b", None, 200, True)],
        "no first": [("b", None, 200, False)], "first failed": [("a", None, 500, True)],
        "no address": [("a", "b", 200, True), (None, None, 200, False)],
        None: [("a", "b", 200, True), ("b", None, 200, False)],
    }
    check(spark, [(day, *page, i) for day, pages in chains.items() for i, page in enumerate(pages)])


def test_random_chains_and_a_long_hot_one(spark):
    pick = random.Random(7)
    pages = []
    for day in range(40):
        size = pick.randint(1, 12)
        for at in range(size):
            link = pick.choice([None, *[str(pick.randrange(size + 1)) for _ in range(5)]])
            pages.append((str(day), str(at), link, pick.choice([200] * 9 + [500]), at == 0, at))
    order = list(range(700))
    pick.shuffle(order)
    pages += [("hot", str(a), str(b) if b is not None else None, 200, i == 0, i)
              for i, (a, b) in enumerate(zip(order, [*order[1:], None]))]
    check(spark, pages)


def test_rounds_leave_only_the_last_tables(spark):
    df = spark.createDataFrame([("d", str(i), str(i + 1), 200, i == 0, i) for i in range(9)], PAGE)
    out = follow_links(df, ["day"], "at", "link", F.col("is_first"), F.col("status") == 200)
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    newest = max((f"{folder}/{f}" for f in os.listdir(folder) if f.startswith("links-")), key=os.path.getmtime)
    assert sorted(os.listdir(newest)) == ["nodes", "reached-32"] or len(os.listdir(newest)) == 2
    assert out.count() == 9 and not out.filter("complete").count()


def test_rounds_move_page_numbers_only(spark):
    df = spark.createDataFrame([("d", str(i), str(i + 1), 200, i == 0, i) for i in range(9)], PAGE)
    follow_links(df, ["day"], "at", "link", F.col("is_first"), F.col("status") == 200)
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    newest = max((f"{folder}/{f}" for f in os.listdir(folder) if f.startswith("links-")), key=os.path.getmtime)
    for name in os.listdir(newest):
        if name != "nodes":
            assert {t for _, t in spark.read.parquet(f"{newest}/{name}").dtypes} == {"bigint"}, name
