"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.llm import (
    chunk_recipes,
    language_id,
    line_dedup,
    packing,
    piece_lattice,
    quality_trees,
    ranked_strata,
    ring_shards,
    secret_forest,
    simhash_gray,
    spelling_variants,
    suffix_repeats,
    warc_derivatives,
)

#: Vocabulary file of the packing query.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Model file of the piece lattice query.
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = warc_derivatives.responses_of_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    made = warc_derivatives.derivatives(responses, "page_id")
    return made.select("page_id", "record_type", "record_id", "refers_to", "target_uri", "source_payload_digest",
                       "block_digest", "block", F.crc32("record").alias("record_crc32"))


def op2_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_forest.scan(_documents(spark, sf_dir))


def op3_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_gray.near_duplicates(_documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op4_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_recipes.exact_duplicates(_documents(spark, sf_dir))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return language_id.identify(docs, language_id.fit(docs))


def op6_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring_shards.shard_rows(_documents(spark, sf_dir), 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op7_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    trees = quality_trees.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_trees.assess(docs, trees)


def op8_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_lattice.encode(_documents(spark, sf_dir), PIECES).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"),
        "text_crc32", "round_trip")


def op9_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_repeats.remove_repeats(_documents(spark, sf_dir))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), TOKENIZER).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op11_ranked_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_strata.rank(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_frequent_lines(_documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(spelling_variants.word_counts(_documents(spark, sf_dir)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_warc_derivatives, op2_secret_forest, op3_simhash_gray, op4_chunk_recipes, op5_language_id, op6_ring_shards,
        op7_quality_trees, op8_piece_lattice, op9_suffix_repeats, op10_packing, op11_ranked_strata, op12_line_dedup,
        op13_spelling_variants)
}

# Pieces of SQL. Only A-Z are lower-cased.
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _LOWER(value: str) -> str:
    return f"translate({value}, '{_UPPER}', '{_UPPER.lower()}')"


def _CRC_STEP(value: str, bits: int) -> str:
    """An entry of the CRC-32 table: ``bits`` shifts by the reversed polynomial."""
    for _ in range(bits):
        value = f"(SELECT xor(v >> 1, (v & 1) * 3988292384) FROM (SELECT {value} AS v))"
    return value


ORACLE: dict[str, str] = {
    "op4_chunk_recipes": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,

    "op11_ranked_strata": rf"""
        WITH words AS (
          SELECT 'doc' AS kind, doc_id AS id, unnest(regexp_extract_all({_LOWER('text')}, '{_TERM}')) AS term FROM documents
          UNION ALL
          SELECT 'item', item_id, unnest(regexp_extract_all({_LOWER('text')}, '{_TERM}')) FROM benchmark),
        tf AS (SELECT id AS doc_id, term, count(*) AS tf FROM words WHERE kind = 'doc' GROUP BY ALL),
        sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY ALL),
        corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM sizes),
        strata AS (SELECT doc_id, 100 - 25 + ((25 * n * docs) // length) AS m FROM sizes, corpus),
        weights AS (
          SELECT term, CAST(floor(1000 * ln(CAST(2 * max(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
          FROM tf, corpus GROUP BY term),
        asked AS (SELECT id AS item_id, term, count(*) AS times FROM words WHERE kind = 'item' GROUP BY ALL),
        scores AS (
          SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
          FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN strata USING (doc_id) GROUP BY ALL)
        SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0
        WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER best <= 20
    """,
    "op12_line_dedup": rf"""
        WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
        lines AS (
          SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place FROM cut),
        keyed AS (SELECT *, {_LOWER("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM lines),
        gone AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(gone.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (gone.key IS NULL), '')) AS kept_sha256
        FROM keyed LEFT JOIN gone USING (key) GROUP BY doc_id
    """,
    "op13_spelling_variants": rf"""
        WITH RECURSIVE runs AS (
          SELECT doc_id, {_LOWER("run")} AS run, count(*) AS times
          FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents) GROUP BY ALL),
        crcs AS (SELECT list(c ORDER BY i) AS crc FROM (SELECT i, {_CRC_STEP('i', 8)} AS c FROM range(256) AS b(i))),
        hashed AS (
          SELECT run, times, length(run) AS size,
            xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(doc_id || ':' || run)), '..'),
                                                     lambda x: CAST('0x' || x AS BIGINT))),
                            lambda c, b: xor(c >> 8, crc[CAST(xor(c & 255, b) AS INTEGER) + 1])), 4294967295) AS h
          FROM runs, crcs),
        words AS (
          SELECT if(h % 199 = 0, substr(run, 1, h % size) || substr(run, h % size + 2), run) AS word,
                 CAST(sum(times) AS BIGINT) AS n
          FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(times) >= 5),
        less AS (
          SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
          FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
        found AS (
          SELECT a.word, b.word AS near FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
          UNION SELECT rest, word FROM less WHERE rest IN (SELECT word FROM words)
          UNION SELECT word, rest FROM less WHERE rest IN (SELECT word FROM words)),
        nears AS (
          SELECT f.word, count(*) AS n_near, first(near ORDER BY w.n DESC, near) AS near, max(w.n) AS near_n
          FROM found f JOIN words w ON w.word = near GROUP BY ALL),
        formed AS (
          SELECT word, n, coalesce(n_near, 0) AS n_near, if(near_n >= 5 * n, near, NULL) AS form,
                 if(near_n >= 5 * n, near_n, NULL) AS form_n
          FROM words LEFT JOIN nears USING (word)),
        chain AS (
          SELECT word, word AS reached FROM formed
          UNION ALL SELECT chain.word, form FROM chain JOIN formed ON formed.word = reached WHERE form IS NOT NULL)
        SELECT f.word, f.form, reached AS root, f.n, f.n_near, f.form_n
        FROM formed f JOIN chain USING (word) JOIN formed e ON e.word = reached WHERE e.form IS NULL
    """,
}
