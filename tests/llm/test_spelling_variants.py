"""Spelling variants against all pairs."""
import itertools
import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from martkit.llm import spelling_variants
from martkit.llm.common import stored

from .conftest import ODD


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute_counts(rows, every=199, min_chars=6, min_count=5):
    seen = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= min_chars and n >= min_count}


def brute_variants(counts, ratio=5):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted((w, form[w] or "", root(w), n, len(near[w]), counts.get(form[w], -1)) for w, n in counts.items())


def found(words, ratio=5):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], -1 if r["form_n"] is None else r["form_n"])
                  for r in spelling_variants.variants(words, ratio).collect())


def test_counts_equal_brute_force(documents, odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    for every, chars, least in ((199, 6, 5), (3, 2, 2)):
        out = spelling_variants.word_counts(documents, every, chars, least)
        assert {r["word"]: r["n"] for r in out.collect()} == brute_counts(rows, every, chars, least)
    clash = odd.withColumn("n", F.lit(1)).withColumn("word", F.lit("x"))
    assert {r["word"]: r["n"] for r in spelling_variants.word_counts(clash, 2, 1, 1).collect()} == brute_counts(
        [(r[0], r[1]) for r in ODD], 2, 1, 1)
    assert spelling_variants.word_counts(empty).count() == 0


def test_variants_equal_all_pairs(spark, documents):
    counts = brute_counts([(r["doc_id"], r["text"]) for r in documents.collect()], 3, 6, 2)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found(words) == brute_variants(counts)
    assert found(words.limit(0)) == []


def test_short_and_repetitive_words_equal_all_pairs(spark):
    pick = random.Random(13)
    words = {"".join(w) for size in range(1, 6) for w in itertools.product("ab", repeat=size)}
    words |= {"".join(pick.choice("abé") for _ in range(pick.randint(5, 8))) for _ in range(300)}
    counts = {w: pick.choice([1, 2, 5, 9, 50, 300, 2000]) for w in sorted(words)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found(df) == brute_variants(counts)
    assert found(df, ratio=2) == brute_variants(counts, 2)


def test_a_chain_of_forms_ends_at_its_root(spark):
    counts = {"a" * (6 + i): 6 ** i for i in range(20)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found(df) == brute_variants(counts)
    assert {r[2] for r in found(df)} == {"a" * 25}


def test_grams_lie_within_one_place_of_a_chunk(spark):
    words = spark.createDataFrame([("abcdefg",)], "word string")
    whole = {(r["size"], r["half"], r["part"], r["at"]) for r in spelling_variants.chunks(words).collect()}
    assert whole == {(7, 0, "abc", 0), (7, 1, "defg", 3)}
    parts = stored(spelling_variants.grams(words)).collect()
    assert {r["size"] for r in parts} == {6, 7}
    assert all(r["part"] == "abcdefg"[r["at"]:r["at"] + len(r["part"])] for r in parts)
    assert all(abs(r["at"] - r["half"] * (r["size"] // 2)) <= 1 for r in parts)
