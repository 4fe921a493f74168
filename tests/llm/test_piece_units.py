"""Units of the piece lattice, and its ids against the sentencepiece library with the same table as a unigram model."""
import numpy as np
import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from martkit.llm import piece_lattice
from martkit.llm.piece_lattice import MARK, Cutter, Pieces, words_of
from martkit.llm.queries import PIECES

TABLE = Pieces(PIECES)
CUTTER = Cutter(TABLE.joined)


def _number(data, at):
    n = shift = 0
    while True:
        n |= (data[at] & 127) << shift
        shift, at = shift + 7, at + 1
        if data[at - 1] < 128:
            return n, at


def _bytes(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def as_unigram(model):
    """The model file with the type of its trainer (field 3 of field 2) set to unigram; all else as it is."""
    out, at = b"", 0
    while at < len(model):
        key, first = _number(model, at)
        size, first = _number(model, first)
        body = model[first:first + size]
        if key >> 3 == 2:
            new, here = b"", 0
            while here < len(body):
                tag, end = _number(body, here)
                if tag & 7 == 2:
                    n, end = _number(body, end)
                    end += n
                else:
                    end = _number(body, end)[1] if tag & 7 == 0 else end + (4 if tag & 7 == 5 else 8)
                new += _bytes(3 << 3) + _bytes(1) if tag >> 3 == 3 else body[here:end]
                here = end
            body = new
        out += _bytes(key) + _bytes(len(body)) + body
        at = first + size
    return out


def test_ids_equal_the_library_as_a_unigram_model(spark, texts):
    # The library's exact lattice (its n-best search); its greedy variant for one result can miss the best sum. Words
    # with a character that only bytes can spell are left out: there its 32-bit sums are rounded to multiples of 64.
    library = sentencepiece.SentencePieceProcessor(model_proto=as_unigram(open(PIECES, "rb").read()))
    letters = {p for p, _, _ in TABLE.rows if len(p) == 1 and p != MARK}
    words = sorted({w for t in texts.values() for w in words_of(t) if w[0] == MARK and len(w) > 1 and set(w[1:]) <= letters})
    assert len(words) > 15_000
    docs = spark.createDataFrame([(i, w[1:]) for i, w in enumerate(words)], "doc_id long, text string")
    ids = {r["doc_id"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in piece_lattice.encode(docs, PIECES).collect()}
    for i, w in enumerate(words):
        assert ids[i] == library.nbest_encode(w[1:], nbest_size=2)[0], w


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aeTthins,.\n▁éñ \U0001f600中国"), min_size=1, max_size=12), max_size=6))
def test_units_join_to_their_words_and_no_piece_crosses_a_cut(words):
    units = CUTTER.units(words)
    assert ["".join(u) for u in units] == words
    assert CUTTER.cut(pa.array(words, pa.string()))[0].to_pylist() == [u for us in units for u in us]
    pieces = {p for p, _, _ in TABLE.rows}
    for word, own in zip(words, units):
        at = 0
        for unit in own[:-1]:
            at += len(unit)
            assert not any(word[a:b] in pieces for a in range(at) for b in range(at + 1, len(word) + 1))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab ▁\n"), max_size=12))
def test_words_are_runs_of_marks_and_what_follows(text):
    words = words_of(text)
    assert "".join(words) == ((" " + text).replace(" ", MARK) if text else "")
    for word in words:
        assert MARK not in word.lstrip(MARK)


def test_units_needed_in_many_parts(spark):
    rows = [(i, f"common text {i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = piece_lattice.encode(docs, PIECES, part_bytes=20)
    back = out.select("doc_id", piece_lattice.decode_column(out["ids"], PIECES).alias("back"))
    assert sorted(map(tuple, back.collect())) == rows


def test_packed_units_give_the_ids_back_and_stay_small(spark, texts):
    # With an id of 32 bits for each piece the same units took 11 bytes each
    own = piece_lattice._Words(pa.array([*texts.values(), "\U00010348 中é"]), CUTTER).units.to_pylist()
    units = spark.createDataFrame(list(enumerate(own)), "number long, unit string")
    solved = piece_lattice.best_paths(piece_lattice.lattice(units, TABLE), units, TABLE).collect()
    want = {r["unit"]: r["ids"] for r in solved}
    assert sorted(want) == sorted(own) and want["\U00010348"] == [TABLE.byte_ids[b] for b in "\U00010348".encode()]
    batch = pa.RecordBatch.from_pydict({
        "unit": pa.array(list(want), pa.string()), "ids": pa.array(list(want.values()), pa.list_(pa.int32())),
        "block": pa.array([1] * len(want), pa.int32()),
        "bits": pa.array([1 << 3 | (i % 2) << 5 for i in range(len(want))], pa.int64())})
    parts = {}
    for rows in piece_lattice._packed_units(iter([batch]), TABLE.sizes):
        part, blob = rows.column("part")[0].as_py(), rows.column("blob")
        known = piece_lattice._known(piece_lattice._unpack(pa.chunked_array([blob])), TABLE)
        parts[part] = dict(zip(known["unit"].to_pylist(), known["ids"].to_pylist(), strict=True)), len(blob[0].as_py())
    assert sorted(parts) == [65, 67]
    assert parts[65][0] == want and parts[67][0] == {u: want[u] for u in [*want][1::2]}
    assert parts[65][1] < 5 * len(want)
