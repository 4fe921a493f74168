"""Exact duplicates by content-defined chunk recipes (DataFrame functions only).

A text is cut where its content says so: after at least ``MIN_CHARS`` characters,
behind a run of ``RUN`` characters with even code points below 256, or at
``MAX_CHARS``. Equal chunks get one identifier, the SHA-256 of their bytes. The
chunk store holds every distinct chunk once; identifiers are verified there by
comparing bytes: two contents under one identifier stop the job. A document is
then its recipe, the ordered list of identifiers, and documents are equal when
their recipes are. Long texts are moved at most once (as distinct chunks);
everything after that moves recipes.

Defined results: null counts as empty (an empty recipe). Of equal texts the
largest doc_id stays; null ids never beat others. Rows that repeat a doc_id and
its text are all marked alike. Extra columns are ignored by ``exact_duplicates``
and pass through ``keep_one``, which also drops repeated rows of the kept id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import fresh, stored

MIN_CHARS = 256
MAX_CHARS = 8192
RUN = 9


def chunks(text: Column) -> Column:
    """Array of the content-defined chunks of ``text``; joined they are the text again."""
    even = "[" + "".join(f"\\x{code:02x}" for code in range(0, 256, 2)) + "]"
    pattern = (rf"(?s).{{{MIN_CHARS},{MAX_CHARS}}}?(?:(?<={even}{{{RUN}}})|\z)|.{{1,{MAX_CHARS}}}")
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def identifier(chunk: Column) -> Column:
    return F.unhex(F.sha2(chunk, 256))


def chunk_store(docs: DataFrame) -> DataFrame:
    """(ident, chunk, uses): every distinct chunk once; copies are combined before the shuffle."""
    return (docs.select(F.explode(chunks(F.col("text"))).alias("chunk"))
            .select(identifier(F.col("chunk")).alias("ident"), "chunk")
            .groupBy("ident", "chunk").agg(F.count("*").alias("uses")))


def verify(store: DataFrame) -> None:
    """Stop if two different chunks share an identifier."""
    clash = store.groupBy("ident").agg(F.count("*").alias("contents")).filter("contents > 1").limit(1).collect()
    if clash:
        raise ValueError(f"two chunks share identifier {bytes(clash[0]['ident']).hex()}")


def recipes(docs: DataFrame) -> DataFrame:
    """(doc_id, recipe, text_sha256): the ordered chunk identifiers of every document."""
    return docs.select(
        "doc_id",
        F.transform(chunks(F.col("text")), identifier).alias("recipe"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``."""
    verify(chunk_store(docs))
    listed = stored(recipes(docs))
    # stored too: a join of two stored tables can be split where a recipe is hot
    groups = stored(listed.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    return listed.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one for each text."""
    own, sha = fresh(docs, "kept_id"), fresh(docs, "kept_sha")
    # a struct, so that a missing id equals a missing id
    mine = {own: F.struct(F.col("doc_id")), sha: F.sha2(F.coalesce("text", F.lit("")), 256)}
    stay = (exact_duplicates(docs).filter("kept").select(F.struct("doc_id").alias(own), F.col("text_sha256").alias(sha))
            .distinct())
    # the rows are already dealt by the two columns on which repeated rows are dropped
    return docs.withColumns(mine).join(stay, [own, sha]).dropDuplicates([own, sha]).select(*docs.columns)
