"""Language identification with a bidirectional GRU over UTF-8 bytes, trained in numpy.

Every byte is read by a forward and a backward gated recurrent unit; a linear
layer labels every position with class probabilities, and a document's
probabilities are the mean over all its positions. Documents are cut into
windows of ``WINDOW`` bytes so that many windows run as one matrix product;
every byte of the text lies in exactly one window. A-Z is lower-cased first.
Gates and candidate use x / (1 + |x|) (for gates moved to 0..1) where the usual
unit has tanh and the logistic function: the same shape, a third of the time.

Training: ``train`` takes (lang, text) rows on the driver. ``training_rows``
bounds them: ``per_lang`` documents per language, one passage of
``PASSAGE_CHARS`` characters each, taken at a place that follows from the
document's id. Prediction reads whole texts inside Spark tasks.

Defined results: a null text, a text without a letter, or a model without
classes gives ``und`` with score 0. Ties go to the first language in
alphabetical order. Repeated rows get equal results; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WINDOW = 64
HIDDEN = 6
PASSAGE_CHARS = 256
PER_LANG = 400
UNDETERMINED = "und"
#: Windows that run as one matrix product.
BLOCK = 1024
#: Text bytes that one task holds in window form at a time.
CHUNK_BYTES = 8 << 20


@dataclass
class Model:
    """Weights: ``wx`` (2, 3H, 256), ``u`` (2, 3H, H), ``b`` (2, 3H, 1), ``wo`` (C, 2H), ``bo`` (C, 1)."""

    langs: list[str]
    wx: np.ndarray
    u: np.ndarray
    b: np.ndarray
    wo: np.ndarray
    bo: np.ndarray

    def weights(self) -> list[np.ndarray]:
        return [self.wx, self.u, self.b, self.wo, self.bo]


def _squash(x: np.ndarray, room: np.ndarray) -> None:
    """x / (1 + |x|) in place: the bounded activation, a few times cheaper than tanh in numpy."""
    np.abs(x, out=room)
    room += 1
    x /= room


def _states(model: Model, win: np.ndarray, length: np.ndarray | None, keep: bool = False):
    """Hidden states (T, H, 2B) of windows ``win`` (T, B); ``length`` where some are shorter than T.

    Columns up to B read forwards, those from B on read the same windows
    backwards, so step ``t`` of the second half stands at position T - 1 - t.
    """
    steps, size = win.shape
    hid = model.u.shape[2]
    table = np.concatenate([model.wx[0], model.wx[1]], axis=1)
    table += np.repeat(model.b[:, :, 0].T, 256, axis=1)
    place = np.empty((steps, 2 * size), dtype=np.intp)
    place[:, :size] = win
    place[:, size:] = win[::-1]
    place[:, size:] += 256
    out = np.empty((steps, hid, 2 * size), dtype=np.float32)
    a, uh, room = (np.empty((3 * hid, 2 * size), dtype=np.float32) for _ in range(3))
    h = np.zeros((hid, 2 * size), dtype=np.float32)
    tape = []
    for t in range(steps):
        np.take(table, place[t], axis=1, out=a, mode="clip")
        np.matmul(model.u[0], h[:, :size], out=uh[:, :size])
        np.matmul(model.u[1], h[:, size:], out=uh[:, size:])
        gates, n = a[:2 * hid], a[2 * hid:]
        gates += uh[:2 * hid]
        _squash(gates, room[:2 * hid])
        gates += 1
        gates *= 0.5
        z, r = gates[:hid], gates[hid:]
        np.multiply(uh[2 * hid:], r, out=room[2 * hid:])
        n += room[2 * hid:]
        _squash(n, room[2 * hid:])
        if keep:
            tape.append((h, z.copy(), r.copy(), n.copy(), uh[2 * hid:].copy()))
        new = np.subtract(h, n, out=out[t])
        new *= z
        new += n
        if length is not None:
            new[:, size:] *= steps - 1 - t < length
        h = new
    return out, tape


def _probabilities(model: Model, states: np.ndarray) -> np.ndarray:
    """Class probabilities (T, C, B) of every position."""
    hid, size = states.shape[1], states.shape[2] // 2
    prob = np.matmul(model.wo[:, :hid], states[:, :, :size])
    prob += np.matmul(model.wo[:, hid:], states[::-1, :, size:])
    prob += model.bo
    prob -= prob.max(axis=1, keepdims=True)
    np.exp(prob, out=prob)
    prob /= prob.sum(axis=1, keepdims=True)
    return prob


def _windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (N, WINDOW), their lengths and the index of the text each comes from."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    counts = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(texts)), counts)
    first = np.cumsum(counts) - counts
    within = np.arange(len(owner)) - first[owner]
    length = np.minimum(sizes[owner] - within * WINDOW, WINDOW)
    win = np.zeros((len(owner), WINDOW), dtype=np.uint8)
    flat = win.reshape(-1)
    at = first * WINDOW
    for text, size, start in zip(texts, sizes, at, strict=True):
        flat[start:start + size] = np.frombuffer(text, dtype=np.uint8)
    return win, length, owner


def train(rows: list[tuple[str, str]], epochs: int = 10, batch: int = 256, rate: float = 0.02,
          seed: int = 7) -> Model:
    """Fit the network by backpropagation through time (Adam, cross-entropy at every position)."""
    rows = sorted((lang, text) for lang, text in rows if lang is not None and text)
    langs = sorted({lang for lang, _ in rows})
    rng = np.random.default_rng(seed)
    scale = 0.3
    model = Model(
        langs,
        rng.normal(0, scale, (2, 3 * HIDDEN, 256)).astype(np.float32),
        rng.normal(0, scale, (2, 3 * HIDDEN, HIDDEN)).astype(np.float32),
        np.zeros((2, 3 * HIDDEN, 1), dtype=np.float32),
        rng.normal(0, scale, (len(langs), 2 * HIDDEN)).astype(np.float32),
        np.zeros((len(langs), 1), dtype=np.float32),
    )
    if not rows:
        return model
    win, length, owner = _windows([text.encode().lower() for _, text in rows])
    label = np.array([langs.index(lang) for lang, _ in rows])[owner]
    weight = len(label) / (len(langs) * np.maximum(np.bincount(label, minlength=len(langs)), 1))
    first = [np.zeros_like(w) for w in model.weights()]
    second = [np.zeros_like(w) for w in model.weights()]
    turn = 0
    for epoch in range(epochs):
        order = rng.permutation(len(win))
        for start in range(0, len(order), batch):
            pick = order[start:start + batch]
            grads = _gradients(model, np.ascontiguousarray(win[pick].T), length[pick], label[pick], weight[label[pick]])
            turn += 1
            step = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999 ** turn) / (1 - 0.9 ** turn)
            for w, g, m, v in zip(model.weights(), grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= (step * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return model


def _gradients(model: Model, win: np.ndarray, length: np.ndarray, label: np.ndarray,
               weight: np.ndarray) -> list[np.ndarray]:
    steps, size = win.shape
    hid = HIDDEN
    states, tape = _states(model, win, length, keep=True)
    delta = _probabilities(model, states)
    delta[:, label, np.arange(size)] -= 1
    valid = (np.arange(steps)[:, None] < length) * (weight / np.maximum(length, 1) / size)
    delta *= valid.astype(np.float32)[:, None, :]
    g_wo = np.concatenate([np.einsum("tcb,thb->ch", delta, states[:, :, :size], optimize=True),
                           np.einsum("tcb,thb->ch", delta, states[::-1, :, size:], optimize=True)], axis=1)
    g_bo = delta.sum(axis=(0, 2))[:, None]
    out = np.concatenate([np.matmul(model.wo[:, :hid].T, delta),
                          np.matmul(model.wo[:, hid:].T, delta)[::-1]], axis=2)
    g_wx, g_u, g_b = np.zeros_like(model.wx), np.zeros_like(model.u), np.zeros_like(model.b)
    carry = np.zeros((hid, 2 * size), dtype=np.float32)
    halves = (slice(0, size), slice(size, 2 * size))
    for t in reversed(range(steps)):
        back = steps - 1 - t
        before, z, r, n, un = tape[t]
        dh = carry + out[t]
        dh[:, size:] *= back < length
        dn = dh * (1 - z) * (1 - np.abs(n)) ** 2
        dz = dh * (before - n) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
        dr = dn * un * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
        da = np.concatenate([dz, dr, dn])
        du = np.concatenate([dz, dr, dn * r])
        carry = dh * z
        for d, x in ((0, win[t]), (1, win[back])):
            half = halves[d]
            g_u[d] += du[:, half] @ before[:, half].T
            g_b[d] += da[:, half].sum(axis=1, keepdims=True)
            hot = np.zeros((size, 256), dtype=np.float32)
            hot[np.arange(size), x] = 1
            g_wx[d] += da[:, half] @ hot
            carry[:, half] += model.u[d].T @ du[:, half]
    return [g_wx, g_u, g_b, g_wo, g_bo]


def pooled(model: Model, texts: list[bytes]) -> np.ndarray:
    """Mean class probabilities (len(texts), C) over all positions of each text; zero for an empty text."""
    total = np.zeros((len(texts), len(model.langs)))
    start = 0
    while start < len(texts):
        end, held = start, 0
        while end < len(texts) and (end == start or held + len(texts[end]) <= CHUNK_BYTES):
            held += len(texts[end])
            end += 1
        win, length, owner = _windows([t.lower() for t in texts[start:end]])
        order = np.argsort(-length, kind="stable")
        for at in range(0, len(order), BLOCK):
            pick = order[at:at + BLOCK]
            short = length[pick] if length[pick[-1]] < WINDOW else None
            states, _ = _states(model, np.ascontiguousarray(win[pick].T), short)
            prob = _probabilities(model, states)
            if short is not None:
                prob *= (np.arange(WINDOW)[:, None] < short)[:, None, :]
            part = prob.sum(axis=0)
            for c in range(len(model.langs)):
                total[start:end, c] += np.bincount(owner[pick], part[c], minlength=end - start)
        start = end
    sizes = np.array([max(len(t), 1) for t in texts])
    return total / sizes[:, None]


def predict_column(model: Model, text: Column) -> Column:
    """Struct column (lang string, score double) of the model's verdict on ``text``."""

    @F.pandas_udf("struct<lang: string, score: double>")
    def verdict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            langs = np.full(len(batch), UNDETERMINED, dtype=object)
            scores = np.zeros(len(batch))
            values = batch.to_numpy()
            known = [i for i, t in enumerate(values) if t is not None]
            if known and model.langs:
                prob = pooled(model, [values[i].encode() for i in known])
                best = prob.argmax(axis=1)
                langs[known] = np.array(model.langs, dtype=object)[best]
                scores[known] = np.clip(prob[np.arange(len(known)), best], 0, 1)
            yield pd.DataFrame({"lang": langs, "score": scores})

    return verdict.asNondeterministic()(F.when(text.rlike(r"\p{L}"), text))


#: Ranges of hashes in which the rows of a language are ranked first.
RANK_RANGES = 64


def training_rows(docs: DataFrame, per_lang: int = PER_LANG) -> list[tuple[str, str]]:
    """At most ``per_lang`` passages for each language of ``docs``.

    ``docs`` has doc_id, text and lang. The choice and the place of the passage
    follow from the id alone, so that a rerun trains the same model.
    """
    known = docs.filter(F.col("lang").isNotNull() & (F.length("text") > 0))
    draw = F.xxhash64(F.col("doc_id").cast("string"))
    spare = F.greatest(F.length("text") - F.lit(PASSAGE_CHARS), F.lit(0)) + F.lit(1)
    passage = F.substring("text", (F.pmod(draw, spare) + F.lit(1)).cast("int"), F.lit(PASSAGE_CHARS))
    rows = known.select("lang", draw.alias("draw"), passage.alias("passage"))
    # in two steps, so that a language with a third of all rows is not ranked in one task: the lowest draws of
    # each range of hashes first, then the lowest of those, whose number does not grow
    rows = rows.withColumn("range", F.pmod(F.hash("draw"), F.lit(RANK_RANGES)))
    for keys in (["lang", "range"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("draw", "passage"))
        rows = rows.withColumn("rank", rank).filter(F.col("rank") <= per_lang)
    return [(r["lang"], r["passage"]) for r in rows.select("lang", "passage").collect()]


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, per_lang: int = PER_LANG) -> Model:
    """Model learned from the documents that are not held out."""
    return train(training_rows(docs.filter(~held_out(F.col("doc_id"))), per_lang))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row per row of ``docs``."""
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                        predict_column(model, F.col("text")).alias("verdict"))
    return found.select("doc_id", "held_out", F.col("verdict.lang").alias("lang_pred"),
                        F.col("verdict.score").alias("score"))
