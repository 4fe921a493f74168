"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

Words are maximal runs of Latin letters, A-Z lower-cased. Of two words within one
edit, the shorter (of equally long ones, the smaller) contributes two disjoint
chunks, its first and its second half; the other contributes its positional grams
of the same two lengths. One edit changes at most one half and moves what stands
behind it by at most one place, so the words share a chunk and a gram of equal
text whose positions differ by one at most. Chunks and grams meet in an equi-join
on (length of the shorter word, which half, text); every meeting pair is verified by
its edit distance.

1. Tasks count words; the counts are combined by Spark, rare words go.
2. Each word gives two chunks, and the grams that lie within one place of a chunk:
   others have nothing to meet. Both sides are stored, so that Spark can split a
   chunk that many words share.
3. Verified pairs give, for each word, the number of its near words and the most
   frequent of them (ties: the smallest in code-point order); that is its form if
   it is ``RATIO`` times as frequent.
4. Roots follow forms to the last by pointer doubling: counts grow by ``RATIO`` along
   a chain, so chains are short and have no cycles.

Defined results: a null text has no words; a null doc_id reads as the empty text in
the rule that makes misspellings. Repeated rows count again. Extra columns are
ignored. ``near_pairs`` takes each word once.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import stored

MIN_CHARS, MIN_COUNT, RATIO = 6, 5, 5
#: One document in so many (by word) has the word misspelt by the deletion of a letter; 0: none.
MISSPELL = 199
#: Different words that a task holds before it hands their counts on.
WORDS_HELD = 400_000

# Latin-1 bytes of the letters, A-Z lower-cased; every other byte separates words.
_LETTERS = bytes(ord(chr(b).lower()) if chr(b) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else b if b >= 0xC0 or 97 <= b <= 122 else 32
                 for b in range(256))


def runs(text: str) -> list[bytes]:
    """Words of a text as Latin-1 bytes (other characters cannot be part of a word)."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split(b" ")


def misspelt(word: str, head: int, every: int = MISSPELL) -> str:
    """``word`` without one letter if ``every`` divides the CRC-32 that continues ``head`` with the word."""
    h = zlib.crc32(word.encode(), head)
    return word if h % every else word[:h % len(word)] + word[h % len(word) + 1:]


def word_counts(docs: DataFrame, misspell: int = MISSPELL, min_chars: int = MIN_CHARS,
                min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words with at least ``min_chars`` characters and ``min_count`` occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.string()),
                                              "n": pa.array(list(seen.values()), pa.int64())})
            seen.clear()
            return out

        for batch in batches:
            for own, text in zip(batch.column("own").to_pylist(), batch.column("text").to_pylist(), strict=True):
                head = zlib.crc32(f"{own}:".encode())
                for run, n in Counter(runs(text)).items():
                    if len(run) >= min_chars:
                        word = run.decode("latin-1")
                        if misspell:
                            word = misspelt(word, head, misspell)
                            if len(word) < min_chars:
                                continue
                        seen[word] += n
                if len(seen) >= WORDS_HELD:
                    yield rows()
        yield rows()

    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("own"),
                        F.coalesce("text", F.lit("")).alias("text"))
    return (texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= min_count))


def chunks(words: DataFrame) -> DataFrame:
    """(size, half, part, at, word): the two halves of each word; ``size`` is the word's length."""
    size = F.char_length("word")
    half = F.floor(size / 2).cast("int")
    return (words.select("word", size.alias("size"), half.alias("mid"))
            .select("word", "size", F.posexplode(F.array(F.expr("substring(word, 1, mid)"),
                                                         F.expr("substring(word, mid + 1)"))).alias("half", "part"), "mid")
            .select("size", "half", "part", (F.col("half") * F.col("mid")).alias("at"), "word"))


def grams(words: DataFrame) -> DataFrame:
    """(size, half, part, at, word): positional grams that a chunk of a word of length ``size`` can meet.

    A word meets words as long as it is and words one shorter. Grams are as long as the
    half that they are meant for and start at most one place from it.
    """
    spread = words.select("word", F.explode(F.expr(
        "filter(flatten(flatten(transform(array(char_length(word), char_length(word) - 1), size -> "
        "transform(array(0, 1), half -> transform(array(-1, 0, 1), move -> named_struct("
        "'size', size, 'half', half, 'at', half * (size div 2) + move, "
        "'gram', size div 2 + half * (size % 2))))))), "
        "g -> g.size > 0 AND g.at >= 0 AND g.at + g.gram <= char_length(word))")).alias("g"))
    return spread.select(F.col("g.size").cast("int").alias("size"), F.col("g.half").alias("half"),
                         F.expr("substring(word, cast(g.at as int) + 1, cast(g.gram as int))").alias("part"),
                         F.col("g.at").cast("int").alias("at"), "word")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near): pairs of different words exactly one insertion, deletion or replacement apart, both ways."""
    whole = stored(chunks(words))
    parts = stored(grams(words))
    on = ["size", "half", "part"]
    small, large = whole.alias("c"), parts.alias("g")
    met = small.join(large, on).filter(
        (F.abs(F.col("c.at") - F.col("g.at")) <= 1)
        & ((F.char_length("g.word") > F.col("size")) | (F.col("c.word") < F.col("g.word")))
        & (F.levenshtein(F.col("c.word"), F.col("g.word"), 1) == 1))
    # a pair can meet in both halves
    once = stored(met.select(F.col("c.word").alias("word"), F.col("g.word").alias("near")).distinct())
    return once.union(once.select("near", "word"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the rows (word, form): follow forms to the last, doubling the steps each round."""
    state = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        step = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stored(state.join(step, "root", "left")
                       .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("went")))
        if moved.filter("went").isEmpty():
            return moved.select("word", "root")
        state = moved.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per row of ``words`` (word, n)."""
    counted = stored(words.select("word", "n"))
    near = near_pairs(counted.select("word")).join(counted.select(F.col("word").alias("near"), "n"), "near")
    best = stored(near.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("n")).alias("less"), F.col("near").alias("form"))).alias("best")))
    known = counted.join(best, "word", "left").withColumn("form_n", -F.col("best.less"))
    formed = F.col("form_n") >= ratio * F.col("n")
    marked = stored(known.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                 F.when(formed, F.col("best.form")).alias("form"),
                                 F.when(formed, F.col("form_n")).alias("form_n")))
    last = roots(marked.filter("form is not null").select("word", "form"))
    return marked.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
