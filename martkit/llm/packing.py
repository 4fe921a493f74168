"""Pack token sequences by the sum-of-squares rule.

Tokens: the ids of a byte-level BPE vocabulary file, then id 0. A document of
more than ``CAPACITY`` tokens is cut; its first piece takes what is left over, the
others are full. A piece goes into the open bin, or a new one, for which the sum
over all residual gaps of (number of open bins with that gap) squared becomes
smallest; ties go to the tightest bin, then to an open one.

Spark tokenizes whole texts where they are read and checkpoints one narrow row
for each piece. The pieces are dealt by a hash of the piece and its row number
into buckets of about ``BUCKET_ROWS`` rows, so a bucket's work is bounded (equal
rows are spread too) and the number of buckets grows with the input. Each bucket
is packed on its own, in two orders, of which the one with fewer bins stays: by
falling length, and in the order of the hash with pieces of at most an eighth of
the capacity last, largest first, to fill the gaps that the others leave open.

Ids are those of the ``tokenizers`` file at ``path``; its merges are applied by
tiktoken's faster merge loop over the same vocabulary (the tests compare both).
Units between single spaces or line ends are encoded once for each Python worker
and remembered (``CACHED_UNITS`` of them at most): the vocabulary's splitting
rule always starts anew at a space or line end between other characters, so the
ids of a text are those of its units in a row. Other texts are encoded whole.
Strings of special tokens count as text.

Defined results: a null text counts as empty: one piece of one token. Repeated
rows are packed each. Extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import cut

CAPACITY = 2048
END_ID = 0
BUCKET_ROWS = 50_000
CACHED_UNITS = 600_000
CACHED_LENGTH = 48

#: Fixed value: the published splitting rule of this byte-level vocabulary.
SPLIT_RULE = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_DOUBLE_SPACE = re.compile(r"\s\s")
_encoders: dict[str, tuple[Units, Units]] = {}


class Units(dict):
    """Ids (little-endian unsigned 32-bit) of units, with ``prefix`` before each."""

    def __init__(self, encoding, prefix: str):
        super().__init__()
        self.encoding, self.prefix = encoding, prefix

    def __missing__(self, unit: str) -> bytes:
        out = array("I", self.encoding.encode_ordinary(self.prefix + unit)).tobytes()
        if len(unit) <= CACHED_LENGTH and len(self) < CACHED_UNITS:
            self[unit] = out
        return out


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable
    Latin-1 characters stand for themselves, the others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def _encoder(path: str) -> tuple[Units, Units]:
    if path not in _encoders:
        model = json.loads(Path(path).read_text())
        special = {t["content"] for t in model["added_tokens"]}
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in model["model"]["vocab"].items()
                 if token not in special}
        encoding = tiktoken.Encoding("file", pat_str=SPLIT_RULE, mergeable_ranks=ranks, special_tokens={})
        _encoders[path] = Units(encoding, ""), Units(encoding, " ")
    return _encoders[path]


def encode(text: str | None, path: str) -> bytes:
    """Ids of ``text`` as little-endian unsigned 32-bit numbers."""
    if not text:
        return b""
    head, tail = _encoder(path)
    if _DOUBLE_SPACE.search(text):
        return head[text]
    lines = []
    for line in text.split("\n"):
        first, *rest = line.split(" ")
        lines.append((head[first] if first else b"") + b"".join([tail[u] for u in rest]))
    return head["\n"].join(lines)


def piece_bounds(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Starts of the pieces of a document, and its end."""
    return [0, *range(tokens % capacity or capacity, tokens + 1, capacity)]


def pieces_column(text: Column, path: str, capacity: int = CAPACITY) -> Column:
    """Array of (start, length, ids_crc32), one for each piece of the text."""

    @F.pandas_udf("struct<start: array<long>, length: array<long>, ids_crc32: array<long>>")
    def cut_pieces(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        end = array("I", [END_ID]).tobytes()
        for batch in batches:
            rows = []
            for text in batch.to_numpy():
                ids = encode(text, path) + end
                at = piece_bounds(len(ids) // 4, capacity)
                rows.append((at[:-1], np.diff(at).tolist(),
                             [zlib.crc32(ids[4 * a:4 * b]) for a, b in zip(at, at[1:], strict=False)]))
            yield pd.DataFrame(rows, columns=["start", "length", "ids_crc32"])

    return cut_pieces.asNondeterministic()(text)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32), one row per piece."""
    cutup = docs.select("doc_id", pieces_column(F.col("text"), path, capacity).alias("cut"))
    zipped = F.arrays_zip(F.col("cut.start").alias("start"), F.col("cut.length").alias("length"),
                          F.col("cut.ids_crc32").alias("ids_crc32"))
    return (cutup.select("doc_id", F.posexplode(zipped).alias("piece", "at"))
            .select("doc_id", "piece", "at.start", "at.length", "at.ids_crc32"))


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each length, placed in the given order."""
    count = np.zeros(capacity + 1, dtype=np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    place, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    bins = 0
    never = np.iinfo(np.int64).max
    for i, size in enumerate(lengths.tolist()):
        gap = capacity
        if size < capacity:
            now = count[size:capacity]
            change = 2 * (count[:capacity - size] - now + 1)
            change[0] -= 1
            change[now == 0] = never
            best = int(change.argmin())
            if change[best] <= 2 * count[capacity - size] + 1:
                gap = best + size
        if gap == capacity:
            place[i] = bins
            bins += 1
        else:
            place[i] = open_bins[gap].pop()
            count[gap] -= 1
        offset[i] = capacity - gap
        left = gap - size
        if left:
            open_bins[left].append(int(place[i]))
            count[left] += 1
    return place, offset


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece."""
    found = cut(pieces(docs, path, capacity))
    buckets = max(1, -(-found.count() // bucket_rows))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    # the pieces are stored, so their row numbers stay what they are
    numbered = found.withColumn("draw", F.xxhash64(*names, F.monotonically_increasing_id()))
    dealt = numbered.withColumn("bucket", F.pmod("draw", F.lit(buckets)))

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("draw", kind="stable")
        length = rows["length"].to_numpy()
        small = np.where(length * 8 <= capacity, capacity - length, -1)
        tries = []
        for order in (np.argsort(-length, kind="stable"), np.argsort(small, kind="stable")):
            place, offset = sum_of_squares(length[order], capacity)
            tries.append((place.max(), order, place, offset))
        _, order, place, offset = min(tries, key=lambda t: t[0])
        return rows[names].iloc[order].assign(sequence_id=place + (int(rows["bucket"].iloc[0]) << 40), offset=offset)

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("bucket").applyInPandas(
        fill, f"doc_id {doc_id}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
