"""Document quality: rules plus gradient-boosted trees over document statistics.

Words are ``[^\\x20\\x09-\\x0D]+``. The trees are learned in numpy from labelled
documents: logistic loss, splits between quantile bins, and monotonic constraints
on the features of ``MONOTONE`` (a split that would turn the direction is not
taken, and both sides keep to the middle value). For scoring, all trees are
flattened into arrays (feature, threshold, children, value) and every tree moves
a whole batch of rows one level at a time.

Training reads at most ``MAX_LABELLED`` labelled documents, chosen by a hash of
their id; statistics and scores cover all rows and whole texts.

Defined results: a null text has no words and fails the base rules. Without
labels of both kinds the trees keep everything, so only the base rules decide.
Repeated rows get equal results; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LABELLED = 6000
TREES, DEPTH, BINS, RATE, MIN_LEAF, RIDGE = 40, 3, 32, 0.2, 20, 1.0
KEEP_FROM = 0.5
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
_SPACES = re.compile(f"[{SPACE}]+")

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_digits",
         "n_lines", "n_distinct"]
FEATURES = ["words", "word_length", "symbols", "dup_lines", "repeats", "capitals", "digits", "distinct"]
#: +1: the score may only rise with the feature; -1: only fall.
MONOTONE = {"symbols": -1, "dup_lines": -1, "repeats": -1}


def repeated_words(words: list[str], width: int = 3) -> int:
    """Words that lie in a window of ``width`` words that the text holds at least twice."""
    count = len(words) - width + 1
    if count < 2:
        return 0
    seen: dict[str, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=len(words))
    window = ids[:count]
    kinds = len(seen)
    for step in range(1, width):
        if step > 1 and kinds * len(seen) >= 1 << 62:
            _, window = np.unique(window, return_inverse=True)
            kinds = int(window.max()) + 1
        window = window * len(seen) + ids[step:count + step]
        kinds *= len(seen)
    order = np.argsort(window, kind="stable")
    same = window[order][1:] == window[order][:-1]
    twice = np.zeros(count, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(len(words) + 1, dtype=np.int64)
    change[:count] += twice
    change[width:] -= twice
    return int((np.cumsum(change) > 0).sum())


def statistics(text: str | None) -> list[int]:
    """The values of ``STATS`` for one text."""
    text = text or ""
    words = [w for w in _SPACES.split(text) if w]
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    letters = text.translate(_CLASS) if text.isascii() else None
    if letters is None:
        capitals = sum(map(str.isupper, text))
        digits = sum(map(str.isdigit, text))
    else:
        capitals, digits = letters.count("A"), letters.count("0")
    return [len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(words), capitals, digits, len(lines), len(set(words))]


_CLASS = {**{c: "A" for c in range(65, 91)}, **{c: "0" for c in range(48, 58)}}


def feature_rows(stats: np.ndarray) -> np.ndarray:
    """Matrix with the columns of ``FEATURES`` from one with those of ``STATS``."""
    s = dict(zip(STATS, stats.T.astype(np.float64), strict=True))
    words, chars, lines = (np.maximum(s[c], 1) for c in ("n_words", "word_chars", "n_lines"))
    return np.stack([np.log1p(s["n_words"]), chars / words, s["n_symbols"] / words, s["n_dup_lines"] / lines,
                     s["n_repeat_words"] / words, s["n_capitals"] / chars, s["n_digits"] / chars,
                     s["n_distinct"] / words], axis=1)


@dataclass
class Trees:
    """All trees in one set of node arrays; a leaf points to itself."""

    start: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of good quality for each row of features."""
        total = np.full(len(rows), self.start)
        every = np.arange(len(rows))
        for root in self.roots:
            node = np.full(len(rows), root)
            for _ in range(DEPTH):
                low = rows[every, self.feature[node]] <= self.threshold[node]
                node = np.where(low, self.left[node], self.right[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def train(rows: np.ndarray, good: np.ndarray) -> Trees | None:
    """Trees learned from feature rows and 0/1 labels; None unless both labels occur."""
    if len(good) == 0 or good.min() == good.max():
        return None
    cuts = [np.unique(np.quantile(col, np.linspace(0, 1, BINS + 1)[1:-1])) for col in rows.T]
    binned = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, rows.T, strict=True)], axis=1)
    start = float(np.log(good.mean() / (1 - good.mean())))
    score = np.full(len(good), start)
    nodes: list[list[float]] = []
    roots = []

    def leaf(value: float) -> int:
        at = len(nodes)
        nodes.append([0, 0.0, at, at, value])
        return at

    def grow(pick: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int, low: float, high: float) -> int:
        g, h = grad[pick].sum(), hess[pick].sum()
        best = (1e-6, None)
        for f in range(rows.shape[1]) if depth else ():
            size = len(cuts[f]) + 1
            gs, hs, ns = (np.cumsum(np.bincount(binned[pick, f], w, minlength=size))[:-1]
                          for w in (grad[pick], hess[pick], None))
            wl, wr = (np.clip(-a / (b + RIDGE), low, high) for a, b in ((gs, hs), (g - gs, h - hs)))
            gain = (gs ** 2 / (hs + RIDGE) + (g - gs) ** 2 / (h - hs + RIDGE) - g ** 2 / (h + RIDGE))
            way = MONOTONE.get(FEATURES[f], 0)
            bad = (ns < MIN_LEAF) | (len(pick) - ns < MIN_LEAF) | (way * (wr - wl) < 0)
            gain[bad] = -np.inf
            if len(gain) and gain.max() > best[0]:
                cut = int(gain.argmax())
                best = (gain[cut], (f, cut, wl[cut], wr[cut]))
        if best[1] is None:
            return leaf(RATE * float(np.clip(-g / (h + RIDGE), low, high)))
        f, cut, wl, wr = best[1]
        way, middle = MONOTONE.get(FEATURES[f], 0), (wl + wr) / 2
        go = binned[pick, f] <= cut
        bounds = [(low, high), (low, high)]
        if way:
            bounds = [(low, middle), (middle, high)] if way > 0 else [(middle, high), (low, middle)]
        at = leaf(0.0)
        sides = [grow(pick[side], grad, hess, depth - 1, *b) for side, b in ((go, bounds[0]), (~go, bounds[1]))]
        nodes[at] = [f, float(cuts[f][cut]), *sides, 0.0]
        return at

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        roots.append(grow(np.arange(len(good)), p - good, p * (1 - p), DEPTH, -np.inf, np.inf))
        f, t, left, right, value = (np.array(c) for c in zip(*nodes, strict=True))
        tree = Trees(0.0, np.array(roots[-1:]), f.astype(int), t, left.astype(int), right.astype(int), value)
        gained = tree.score(rows)
        score += np.log(gained / (1 - gained))
    f, t, left, right, value = (np.array(c) for c in zip(*nodes, strict=True))
    return Trees(start, np.array(roots), f.astype(int), t, left.astype(int), right.astype(int), value)


def stats_column(text: Column, trees: Trees | None = None) -> Column:
    """Struct of ``STATS`` (long) and ``score``: the trees' probability, 1 without trees."""

    @F.pandas_udf(f"struct<{', '.join(f'{c}: long' for c in STATS)}, score: double>")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            stats = np.array([statistics(t) for t in batch.to_numpy()], dtype=np.int64).reshape(-1, len(STATS))
            score = np.ones(len(stats)) if trees is None else trees.score(feature_rows(stats))
            yield pd.DataFrame(stats, columns=STATS).assign(score=score)

    return measure.asNondeterministic()(text)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Trees | None:
    """Trees learned from at most ``max_labelled`` documents with a quality label."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").select("doc_id", "quality")
    # at most max_labelled rows
    sample = known.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id", "quality").limit(max_labelled)
    rows = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
            .select("doc_id", "quality", stats_column(F.col("text")).alias("s")).select("doc_id", "quality", "s.*")
            .drop("score").orderBy("doc_id", "quality", *STATS).limit(max_labelled).toPandas())
    return train(feature_rows(rows[STATS].to_numpy()), rows["quality"].to_numpy(dtype=np.float64))


def assess(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """(doc_id, the base statistics, base_failed, score, kept), one row per row of ``docs``."""
    seen = docs.select("doc_id", stats_column(F.col("text"), trees).alias("s"))
    failed = (F.col("s.n_words") < MIN_WORDS) | (
        100 * F.col("s.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("s.n_words"))
    return seen.select("doc_id", *[F.col(f"s.{c}") for c in STATS[:5]], failed.alias("base_failed"),
                       F.col("s.score"), (~failed & (F.col("s.score") >= KEEP_FROM)).alias("kept"))
