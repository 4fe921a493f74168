"""SentencePiece encoding by a relational lattice, and decoding.

Text: one space is put in front, spaces become U+2581, and the text falls into
words (a run of U+2581 and what follows up to the next). No piece of the table
reaches over the end of a word, nor over two neighbouring characters that stand
side by side in no piece: there a word is cut into units, and the best path of a
word is that of its units, one after the other. Each distinct unit is solved once:

1. Spark collects the distinct units of all documents.
2. Every unit's substrings up to the longest piece are exploded and joined to the
   piece table on equality (the table is the vocabulary file, its size is fixed).
   A character that no piece matches becomes an edge of its UTF-8 byte pieces
   with a score below all others.
3. Edges are grouped by unit, and a higher-order ``aggregate`` folds them in order
   of their ends into the best score of each place (Viterbi); a second one walks
   back. Ties go to the longer last piece.
4. Documents are dealt into parts of about ``PART_BYTES``; each part gets its own
   units and the sizes of their pieces, packed (the ids follow from them), and its
   documents are put together from them.

The scores are those of the file, and the result has the largest sum of scores, as in
a unigram model with this table. For a file made for merging pieces in order of rank
this is not always the segmentation that merging gives; decoding returns the text in
both cases.

Defined results: a null or empty text has no ids. Repeated rows give repeated rows.
Extra columns are ignored. A unit's fold takes time with the square of its length in
characters. Equal rows travel as one row and a count, so copies make no part larger.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import stored

MARK = "▁"
PART_BYTES = 16 << 20
#: Bytes of texts that a task splits into words, or packs, at a time, and that it puts together.
SPLIT_BYTES, PACK_BYTES, SLICE_BYTES = 4 << 20, 8 << 20, 2 << 20
UNITS_PER_TASK = 20_000
#: Units that a task holds to pack them.
PACKED_UNITS = 100_000
#: A unit's parts are bits of a number, so many at a time.
PART_BLOCK = 62
UNKNOWN_PENALTY = 10.0
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    marked = MARK + text.replace(" ", MARK)
    if MARK + MARK in marked or marked[-1] == MARK:
        return _WORD.findall(marked)
    return [MARK + word for word in marked[1:].split(MARK)]


class Pieces:
    """The vocabulary of a SentencePiece model file."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.byte_ids = [0] * 256
        self.rows: list[tuple[str, int, float]] = []
        self.output = [b""] * len(ids)
        for i in ids:
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.output[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.rows.append((piece, i, model.get_score(i)))
                self.output[i] = piece.replace(MARK, " ").encode()
        if any(MARK in piece.lstrip(MARK) for piece, _, _ in self.rows):
            raise ValueError("a piece reaches over the end of a word")
        self.joined = {a + b for piece, _, _ in self.rows for a, b in zip(piece, piece[1:])}
        self.longest = max(len(piece) for piece, _, _ in self.rows)
        self.unknown = min(score for _, _, score in self.rows) - UNKNOWN_PENALTY
        # a character that no piece matches is written in bytes: one alone is a piece only if the table has no such piece
        names = {piece.encode(): i for piece, i, _ in self.rows}
        names |= {bytes([b]): i for b, i in enumerate(self.byte_ids) if bytes([b]) not in names}
        self.names, self.ids = pa.array(list(names), pa.binary()), np.array(list(names.values()), dtype=np.uint32)
        self.sizes = np.zeros(len(ids), dtype=np.min_scalar_type(max(map(len, names))))
        self.sizes[self.ids] = [len(name) for name in names]


class Cutter:
    """Cuts words where two neighbouring characters stand side by side in no piece."""

    SMALL = 1024

    def __init__(self, joined: set[str]):
        self.small = np.zeros((self.SMALL, self.SMALL), dtype=bool)
        large = []
        for a, b in joined:
            if max(a, b) < chr(self.SMALL - 1):
                self.small[ord(a), ord(b)] = True
            else:
                large.append(ord(a) << 21 | ord(b))
        self.large = np.array(sorted(large), dtype=np.int64)

    def cut(self, words: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
        """The units of all words in order, and the number of units up to the end of each word."""
        sizes = pc.utf8_length(words).to_numpy()
        data = "".encode() if not len(words) else _text_bytes(words)
        if not len(data):
            return pa.array([], pa.string()), np.zeros(len(words), dtype=np.int64)
        codes = np.frombuffer(str(data, "utf-8").encode("utf-32-le"), dtype="<u4")
        a, b = codes[:-1], codes[1:]
        last = np.uint32(self.SMALL - 1)
        together = self.small[np.minimum(a, last), np.minimum(b, last)]
        high = np.flatnonzero(np.maximum(a, b) >= last)
        together[high] = np.isin(a[high].astype(np.int64) << 21 | b[high], self.large, kind="sort")
        ends = np.cumsum(sizes)
        cut = np.append(~together, True)
        cut[ends - 1] = True
        places = np.flatnonzero(cut) + 1
        letters = np.flatnonzero((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)      # the first byte of every letter
        offsets = np.append(0, np.append(letters, len(data))[places]).astype(np.int32)
        units = pa.StringArray.from_buffers(len(places), pa.py_buffer(offsets), pa.py_buffer(data))
        return units, np.searchsorted(places, ends) + 1

    def units(self, words: list[str]) -> list[list[str]]:
        """The units of each word."""
        units, ends = self.cut(pa.array(words, pa.string()))
        units = units.to_pylist()
        return [units[x:y] for x, y in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)] if words else []


def _text_bytes(texts: pa.StringArray) -> bytes:
    """The UTF-8 bytes of all texts in a row (none is null)."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32, count=len(texts) + 1, offset=4 * texts.offset)
    return texts.buffers()[2].to_pybytes()[offsets[0]:offsets[-1]] if offsets[-1] > offsets[0] else b""


_ID_BITS, _SIZE_BITS = 20, 12


def lattice(units: DataFrame, pieces: Pieces) -> DataFrame:
    """(number, edge): all edges of each unit (number, unit).

    An edge is one number, in the order of its end and size: end, size and id + 1, where id -1 stands
    for byte pieces.
    """
    table = units.sparkSession.createDataFrame([(p, i + 1) for p, i, _ in pieces.rows], "piece string, code long")
    spans = (units.select("number", "unit", F.char_length("unit").alias("n"))
             .select("number", "unit", "n", F.explode(F.expr("sequence(1, n)")).alias("until"))
             .select("number", "unit", "until", F.explode(F.expr(f"sequence(1, least({pieces.longest}, until))")).alias("size"))
             .withColumn("piece", F.expr("substring(unit, until - size + 1, size)")))
    place = F.shiftleft(F.col("until").cast("long"), _ID_BITS + _SIZE_BITS) + F.shiftleft(F.col("size").cast("long"), _ID_BITS)
    return (spans.join(F.broadcast(table), "piece", "left").filter("code IS NOT NULL OR size = 1")
            .select("number", (place + F.coalesce("code", F.lit(0).cast("long"))).alias("edge")))


def best_paths(edges: DataFrame, units: DataFrame, pieces: Pieces) -> DataFrame:
    """(unit, ids): the path with the largest sum of scores through each unit's edges."""
    scores = np.full(max(i for _, i, _ in pieces.rows) + 2, pieces.unknown)
    for _, i, score in pieces.rows:
        scores[i + 1] = score
    score_of = F.split(F.lit(",".join(map(repr, scores.tolist()))), ",").cast("array<double>")     # folded to a constant
    grouped = edges.groupBy("number").agg(F.sort_array(F.collect_list("edge")).alias("edges"))

    def until(edge: Column) -> Column:
        return F.shiftright(edge, _ID_BITS + _SIZE_BITS).cast("int")

    def size(edge: Column) -> Column:
        return F.shiftright(edge, _ID_BITS).bitwiseAND((1 << _SIZE_BITS) - 1).cast("int")

    def code(edge: Column) -> Column:
        return edge.bitwiseAND((1 << _ID_BITS) - 1).cast("int")

    def reached(before: Column, edge: Column) -> Column:
        return F.struct((before["score"] + score_of[code(edge)]).alias("score"), edge.alias("edge"))

    # The edges of a place come together, its single character (which is always there) first: then the place before
    # is settled. Of equal scores the larger edge, which has the longer piece, is the greater one.
    def step(state: Column, edge: Column) -> Column:
        done, now = state["done"], state["now"]
        longer = F.greatest(now, reached(done[until(edge) - size(edge)], edge))
        return (F.when(size(edge) == 1, F.struct(F.concat(done, F.array(now)).alias("done"), reached(now, edge).alias("now")))
                .otherwise(F.struct(done.alias("done"), longer.alias("now"))))

    nowhere = "array<struct<score: double, edge: bigint>>"
    start = F.struct(F.array().cast(nowhere).alias("done"), F.struct(F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("edge")).alias("now"))
    places = F.aggregate("edges", start, step, lambda state: F.concat(state["done"], F.array(state["now"])))
    solved = grouped.select("number", F.transform(places, lambda x: x["edge"]).alias("best"))
    byte_ids = F.array(*[F.lit(i) for i in pieces.byte_ids])

    def back(state: Column, _: Column) -> Column:
        at = state["at"]
        here = F.col("best")[at]
        letter = F.encode(F.substring(F.col("unit"), at, F.lit(1)), "utf-8")
        as_bytes = F.transform(
            F.sequence(F.lit(1), F.octet_length(letter)),
            lambda i: F.element_at(byte_ids, F.conv(F.hex(F.substring(letter, i, F.lit(1))), 16, 10).cast("int") + 1))
        ids = F.when(code(here) > 0, F.array(code(here) - 1)).otherwise(as_bytes)
        return F.when(at > 0, F.struct((at - size(here)).alias("at"), F.concat(ids, state["ids"]).alias("ids"))
                      ).otherwise(state)

    end = F.struct((F.size("best") - 1).alias("at"), F.array().cast("array<int>").alias("ids"))
    return units.join(solved, "number").select("unit", F.aggregate("best", end, back)["ids"].alias("ids"))


def _pack(table: pa.Table | pa.RecordBatch, level: int = 6) -> bytes:
    codec = pa.Codec("zstd", compression_level=level)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=codec)) as out:
        out.write(table)
    return sink.getvalue().to_pybytes()


def _unpack(blobs: pa.ChunkedArray) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(blob.as_buffer()).read_all() for blob in blobs])


def _slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Rows of a batch with texts of about ``size`` bytes together."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy())
    steps = np.arange(size, sizes[-1] if len(sizes) else 0, size)
    cuts = np.unique([0, *(np.searchsorted(sizes, steps) + 1), batch.num_rows]).tolist()
    return (batch.slice(first, end - first) for first, end in zip(cuts, cuts[1:], strict=False))


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the runs that begin at ``starts``, one run after the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


class _Words:
    """The words of some texts, each distinct one with its units.

    ``row`` and ``code`` tell for every word in order its text and its number; the units of word ``w``
    are ``unit_of[first[w]:first[w] + size[w]]``, numbers into ``units``.
    """

    def __init__(self, texts: pa.Array, cutter: Cutter):
        marked = pc.replace_substring(pc.fill_null(texts, ""), " ", MARK)
        # a word is a mark and what follows; only runs of marks need the pattern
        odd = pc.or_(pc.match_substring(marked, MARK + MARK),
                     pc.or_(pc.starts_with(marked, MARK), pc.ends_with(marked, MARK))).to_numpy(zero_copy_only=False)
        empty = pc.equal(pc.binary_length(marked), 0).to_numpy(zero_copy_only=False)
        plain = np.flatnonzero(~odd & ~empty)
        lists = pc.split_pattern(marked.take(pa.array(plain)), MARK)
        rows, parts = [plain[pc.list_parent_indices(lists).to_numpy()]], [pc.list_flatten(lists)]
        for row in np.flatnonzero(odd).tolist():
            found = [w[1:] for w in words_of(texts[row].as_py())]
            rows.append(np.full(len(found), row))
            parts.append(pa.array(found, pa.string()))
        row = np.concatenate(rows)
        coded = pa.chunked_array(parts, pa.string()).combine_chunks().dictionary_encode()
        order = np.argsort(row, kind="stable")
        self.row, self.code = row[order], coded.indices.to_numpy()[order].astype(np.int64)
        found, ends = cutter.cut(pc.binary_join_element_wise(MARK, coded.dictionary, ""))
        units = found.dictionary_encode()
        self.units, self.unit_of = units.dictionary, units.indices.to_numpy().astype(np.int64)
        self.first = np.r_[0, ends[:-1]].astype(np.int64) if len(ends) else np.zeros(0, dtype=np.int64)
        self.size = ends - self.first


def _distinct_units(cutter: Cutter, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (unit, block, bits): the parts that need a unit."""
    for batch in batches:
        for rows in _slices(batch, SPLIT_BYTES):
            words = _Words(rows.column("text"), cutter)
            part = rows.column("part").to_numpy().astype(np.int64)[words.row]
            block, bit = part // PART_BLOCK, np.int64(1) << part % PART_BLOCK
            order = np.argsort(block, kind="stable")
            word_bits, unit_bits = np.zeros(len(words.first), dtype=np.int64), np.zeros(len(words.units), dtype=np.int64)
            for mine in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
                if not len(mine):
                    continue
                np.bitwise_or.at(word_bits, words.code[mine], bit[mine])
                word = np.flatnonzero(word_bits)
                np.bitwise_or.at(unit_bits, words.unit_of[_spread(words.first[word], words.size[word])],
                                 np.repeat(word_bits[word], words.size[word]))
                unit = np.flatnonzero(unit_bits)
                yield pa.RecordBatch.from_arrays(
                    [words.units.take(pa.array(unit)), pa.array(np.full(len(unit), block[mine[0]], dtype=np.int32)),
                     pa.array(unit_bits[unit])], names=["unit", "block", "bits"])
                word_bits[word] = 0
                unit_bits[unit] = 0
    pa.default_memory_pool().release_unused()


def _cuts(ids: pa.ListArray, sizes: np.ndarray) -> bytes:
    """The bytes of each piece, and a 0 behind each unit."""
    count = pc.list_value_length(ids).to_numpy()
    out = np.zeros(count.sum() + len(count), dtype=sizes.dtype)
    out[_spread(np.cumsum(count + 1) - count - 1, count)] = sizes[pc.list_flatten(ids).to_numpy()]
    return out.tobytes()


def _known(packed: pa.Table, pieces: Pieces) -> pa.Table:
    """(unit, ids) of packed units: the ids are those of the pieces that the sizes cut out."""
    units, cuts = (b"".join(packed.column(c).to_pylist()) for c in ("units", "cuts"))
    size = np.frombuffer(cuts, dtype=pieces.sizes.dtype)
    inner = size > 0
    last = np.flatnonzero(~inner)
    until = np.cumsum(size, dtype=np.int32)
    data = pa.py_buffer(units)

    def starts(ends: np.ndarray) -> pa.Buffer:
        return pa.py_buffer(np.r_[0, ends].astype(np.int32))

    cut = pa.Array.from_buffers(pa.binary(), int(inner.sum()), [None, starts(until[inner]), data])
    at = pc.index_in(cut, value_set=pieces.names)
    if at.null_count:
        raise ValueError("a size that cuts out no piece")
    ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(inner)[last]], pa.int32()), pa.array(pieces.ids[at.to_numpy()]))
    return pa.table({"unit": pa.StringArray.from_buffers(len(last), starts(until[last]), data), "ids": ids})


def _packed_units(batches: Iterator[pa.RecordBatch], sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (part, blob) with the units of each part and the sizes of their pieces."""
    held: list[pa.RecordBatch] = []

    def packs() -> Iterator[pa.RecordBatch]:
        # in order of the units, which then share their beginnings: that packs best
        rows = pa.Table.from_batches(held).sort_by("unit").combine_chunks()
        held.clear()
        block, bits = rows.column("block").to_numpy(), rows.column("bits").to_numpy()
        for b in np.unique(block).tolist():
            for i in range(PART_BLOCK):
                mine = np.flatnonzero((block == b) & (bits >> i & 1 == 1))
                if len(mine):
                    unit, ids = (rows.column(c).chunk(0).take(pa.array(mine)) for c in ("unit", "ids"))
                    blob = _pack(pa.table({"units": pa.array([_text_bytes(unit)], pa.binary()),
                                           "cuts": pa.array([_cuts(ids, sizes)], pa.binary())}))
                    yield pa.RecordBatch.from_pydict({"part": pa.array([b * PART_BLOCK + i], pa.int32()),
                                                      "blob": pa.array([blob], pa.binary())})

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= PACKED_UNITS:
            yield from packs()
    if held:
        yield from packs()


def _packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, blob) with the texts of each part; equal rows are one row with a count."""
    for batch in batches:
        for rows in _slices(batch, PACK_BYTES):
            once = pa.Table.from_batches([rows]).group_by(["part", "doc_id", "text"]).aggregate([([], "count_all")])
            part = once.column("part").to_numpy()
            for p in np.unique(part).tolist():
                own = once.filter(pa.array(part == p)).select(["doc_id", "text", "count_all"])
                yield pa.RecordBatch.from_pydict({"part": pa.array([p], pa.int32()), "blob": pa.array([_pack(own)], pa.binary())})


def _ids_of(texts: pa.Array, known: pa.Table, cutter: Cutter) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in a row, and the number of ids up to the end of each; ``known`` (unit, ids) has every unit."""
    words = _Words(texts, cutter)
    at = pc.index_in(words.units, value_set=known.column("unit"))
    if at.null_count:
        raise ValueError("a unit without ids")
    lists = known.column("ids").combine_chunks()
    flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy().astype(np.int64)
    unit = at.to_numpy()[words.unit_of]
    start, size = offsets[unit], offsets[unit + 1] - offsets[unit]
    by_word = flat[_spread(start, size)]                              # ids of every distinct word in a row
    ends = np.r_[0, np.cumsum(size)]
    start, size = ends[words.first], ends[words.first + words.size] - ends[words.first]
    count = size[words.code]
    ids = by_word[_spread(start[words.code], count)].astype("<u4")
    return ids, np.cumsum(np.bincount(words.row, count, minlength=len(texts)).astype(np.int64))


def _blobs(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary array of the runs of ``values`` that end at ``ends``."""
    offsets = (np.r_[0, ends] * values.itemsize).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())]
                                 ).cast(pa.binary())


class _Output:
    """The bytes of every piece, to turn many ids into text at once."""

    def __init__(self, output: list[bytes]):
        self.data = np.frombuffer(b"".join(output), dtype=np.uint8)
        self.size = np.array([len(x) for x in output], dtype=np.int64)
        self.first = np.cumsum(self.size) - self.size

    def texts(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The text of each run of ``ids``, without the space in front."""
        size = self.size[ids]
        data = self.data[_spread(self.first[ids], size)].tobytes()
        at = np.r_[0, np.cumsum(size)][np.r_[0, ends]].tolist()
        return [data[a + 1:b] for a, b in zip(at, at[1:], strict=False)]


def encode(docs: DataFrame, path: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, text_crc32, ids, round_trip), one row per row of ``docs``.

    ``ids`` are little-endian unsigned 32-bit numbers; ``round_trip`` tells whether decoding them gives the text.
    """
    pieces = Pieces(path)
    output = _Output(pieces.output)
    cutter = Cutter(pieces.joined)
    sizes = pieces.sizes
    kind = docs.schema["doc_id"].dataType.simpleString()
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + total // part_bytes
    dealt = docs.select("doc_id", "text",
                        F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "text"), F.lit(parts)).cast("int")
                        .alias("part"))
    needs = stored(dealt.select("part", "text").mapInArrow(lambda b: _distinct_units(cutter, b), "unit string, block int, bits long")
                   .groupBy("unit", "block").agg(F.bit_or("bits").alias("bits")), "zstd")
    units = stored(needs.select("unit").distinct().withColumn("number", F.monotonically_increasing_id()), "zstd")
    # edges are some twenty times as many as units: small partitions, so that they are sorted in memory
    spread = units.repartition(1 + units.count() // UNITS_PER_TASK, "number")
    solved = best_paths(lattice(spread, pieces), spread, pieces)
    known = needs.join(solved, "unit").select("unit", "ids", "block", "bits").mapInArrow(
        lambda b: _packed_units(b, sizes), "part int, blob binary")
    texts = dealt.mapInArrow(_packed_texts, "part int, blob binary")

    def assemble(texts: pa.Table, known: pa.Table) -> pa.Table:
        solved = _known(_unpack(known.column("blob")) if known.num_rows else pa.table({"units": [], "cuts": []}), pieces)
        rows = _unpack(texts.column("blob")).group_by(["doc_id", "text"]).aggregate([("count_all", "sum")])
        made = []
        for batch in rows.combine_chunks().to_batches():
            for part in _slices(batch, SLICE_BYTES):
                ids, ends = _ids_of(part.column("text"), solved, cutter)
                own = pc.fill_null(part.column("text"), "").cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
                made.append(pa.table({
                    "doc_id": part.column("doc_id"), "copies": part.column("count_all_sum"),
                    "text_crc32": pa.array([zlib.crc32(t) for t in own], pa.int64()), "ids": _blobs(ids, ends),
                    "round_trip": pa.array([a == b for a, b in zip(own, output.texts(ids, ends), strict=True)], pa.bool_())}))
        pa.default_memory_pool().release_unused()
        return pa.concat_tables(made).combine_chunks()

    encoded = texts.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(
        assemble, f"doc_id {kind}, copies long, text_crc32 long, ids binary, round_trip boolean")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return encoded.select("doc_id", "text_crc32", "ids", "round_trip", copies.alias("copy")).drop("copy")


def decode_column(ids: Column, path: str) -> Column:
    """Text of a column of ids (little-endian unsigned 32-bit numbers)."""
    output = _Output(Pieces(path).output)

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            rows = [np.frombuffer(bytes(x), dtype="<u4") for x in batch]
            ends = np.cumsum([len(x) for x in rows])
            texts = output.texts(np.concatenate(rows), ends) if rows else []
            yield pd.Series([t.decode("utf-8", "replace") for t in texts], dtype=object)

    return decode.asNondeterministic()(ids)
