"""Every operator on odd rows and on an empty table."""
import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from martkit.llm import (
    chunk_recipes, language_id, packing, piece_lattice, quality_trees, ring_shards, secret_forest, simhash_gray,
    suffix_repeats, warc_derivatives,
)
from martkit.llm.queries import PIECES, TOKENIZER

from .conftest import ODD


def test_chunk_recipes(odd, empty):
    out = chunk_recipes.exact_duplicates(odd).collect()
    assert len(out) == len(ODD)
    same = [r for r in out if r["group_size"] == 4]              # ids 4, 5, 5 and none
    assert len(same) == 4 and {r["keep_id"] for r in same} == {5}
    assert sorted(r["doc_id"] is None for r in same if not r["kept"]) == [False, True]
    nothing = [r for r in out if r["group_size"] == 3]           # two nulls and the empty text
    assert {r["keep_id"] for r in nothing} == {2}
    kept = chunk_recipes.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 5, 6, 8, 9, 10, 11]
    assert chunk_recipes.exact_duplicates(empty).count() == 0 and chunk_recipes.keep_one(empty).count() == 0


def test_simhash(odd, empty):
    out = simhash_gray.near_duplicates(odd).collect()
    assert len(out) == len(ODD)
    zero = [r for r in out if r["print"] == 0]
    assert len(zero) == 4 and {r["component_id"] for r in zero} == {1}       # null, empty, blank, null id
    copies = {r["component_id"] for r in out if r["doc_id"] in (4, 5, 6)}     # A-Z is lower-cased
    assert copies == {4}
    assert simhash_gray.near_duplicates(empty).count() == 0


def test_language(odd, empty):
    out = {r["doc_id"]: r for r in language_id.identify(odd, language_id.fit(odd)).collect()}
    assert all(out[i]["lang_pred"] == "und" and out[i]["score"] == 0 for i in (1, 2, 3, 11))
    assert all(out[i]["lang_pred"] in ("en", "es", "de", "fr") for i in (4, 7, 9, 10))
    none = language_id.identify(odd, language_id.fit(empty)).collect()
    assert len(none) == len(ODD) and {r["lang_pred"] for r in none} == {"und"}


def test_shards(odd, empty):
    out = ring_shards.shard_rows(odd, 4).collect()
    assert len(out) == len(ODD)
    assert {r["doc_id"]: r["size"] for r in out}[1] == 8
    counts = [sum(r["shard"] == s for r in out) for s in range(4)]
    assert max(counts) - min(counts) <= 1
    assert ring_shards.shard_rows(empty, 4).count() == 0


def test_quality(odd, empty):
    trees = quality_trees.fit(odd, empty.selectExpr("doc_id", "cast(null as int) as quality"))
    assert trees is None
    out = {r["doc_id"]: r for r in quality_trees.assess(odd, trees).collect()}
    assert out[1]["n_words"] == 0 and out[1]["base_failed"] and not out[1]["kept"]
    assert out[7]["n_words"] == 30_000 and out[7]["kept"]
    assert quality_trees.assess(empty, None).count() == 0


def test_secrets(odd, empty):
    found = secret_forest.scan(odd)
    assert {r["length"] for r in found.filter("doc_id = 9").collect()} == {3000}
    same = secret_forest.redact(odd, found)
    assert same.columns == odd.columns and same.count() == len(ODD)
    assert secret_forest.scan(empty).count() == 0


def test_pieces(odd, empty):
    out = piece_lattice.encode(odd, PIECES, part_bytes=100_000)
    rows = out.select("doc_id", "ids", "text_crc32", piece_lattice.decode_column(out["ids"], PIECES).alias("back"))
    back = {r["doc_id"]: r["back"] for r in rows.collect()}
    assert out.count() == len(ODD)
    assert all(back[i] == (t or "") for i, t, *_ in ODD if i is not None)
    assert piece_lattice.encode(empty, PIECES).count() == 0


def test_repeats(odd, empty):
    out = suffix_repeats.remove_repeats(odd).collect()
    assert len(out) == len(ODD)
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[7]["n_removed"] == by_id[7]["n_bytes"] and by_id[7]["n_spans"] == 1
    assert by_id[9]["n_removed"] == 3000 and by_id[1]["n_bytes"] == by_id[1]["n_spans"] == 0
    assert suffix_repeats.remove_repeats(empty).count() == 0


def test_packing(odd, empty):
    out = packing.pack(odd, TOKENIZER).collect()
    assert len({(r["doc_id"], r["piece"]) for r in out if r["doc_id"] == 1}) == 1
    assert [r["length"] for r in out if r["doc_id"] in (1, 2)] == [1, 1]
    assert packing.pack(empty, TOKENIZER).count() == 0


def test_warc(spark):
    pages = spark.createDataFrame(
        [(1, None, None), (2, "http://a/ b", ""), (2, "http://a/ b", ""), (None, "u", "<p>a<!-- b"),
         (3, "u", "<p>" * 20_000)], "page_id long, url string, html string").selectExpr("*", "'x' as record_type")
    out = warc_derivatives.derivatives(warc_derivatives.responses_of_pages(pages), "page_id").collect()
    assert len(out) == 10
    assert {r["block"] for r in out if r["record_type"] == "conversion"} == {"", "a"}
    broken = spark.createDataFrame([(1, None), (2, b""), (3, b"no head"), (4, b"WARC/1.1\r\nWARC-Type: request\r\n\r\n")],
                                   "k long, record binary")
    assert warc_derivatives.derivatives(broken, "k").count() == 0


def test_languages_beyond_64_and_none(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text number {i}", f"l{i % 70:02}") for i in range(210)],
                                 "doc_id long, text string, lang string")
    assert len({lang for lang, _ in language_id.training_rows(docs)}) == 70
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language(spark, unlabelled, "").count() == 210
    even = language_id.Model([f"l{i:02}" for i in range(70)], *[np.zeros(s, dtype=np.float32) for s in (
        (2, 18, 256), (2, 18, 6), (2, 18, 1), (70, 12), (70, 1))])
    even.bo[3] = 1.0                                        # 3 of 72: above twice an even guess
    monkeypatch.setattr(language_id, "fit", lambda docs: even)
    assert corpus_pipeline.language(spark, docs, "").count() == 210


def test_near_stage_names_rows_by_id_and_text(spark):
    words = [f"w{i}" for i in range(400)]
    def text(first, end=""):
        return " ".join(words[first:first + 40]) + end
    rows = [(None, text(0)), (None, text(0).upper()), (None, text(0).title()),    # near copies without an id
            (1, text(50)), (2, text(50).upper()), (2, text(100)),                 # id 2: a near copy and a clean text
            (3, text(150)), (3, text(150).upper()),                               # near copies with one id
            (4, text(200)), (None, text(200).upper())]                            # an id goes before none
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near(spark, docs, "").collect()
    assert sorted((r["doc_id"] or 0, r["text"].lower()) for r in kept) == [
        (0, text(0)), (1, text(50)), (2, text(100)), (3, text(150)), (4, text(200))]


def test_pipeline_stages(spark, odd, empty):
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, "").columns == docs.columns, name
    kept = corpus_pipeline.near(spark, odd, "")
    assert sorted(r["doc_id"] for r in kept.filter("doc_id is not null").collect()) == [1, 4, 7, 9, 10, 11]
    assert corpus_pipeline.language(spark, empty, "").count() == 0
