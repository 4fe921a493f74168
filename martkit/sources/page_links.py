"""Chains of landed pages by the addresses they link to (no page numbers)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.session import shared_folder
from martkit.sources.sinks import discard


class _Copies:
    """Tables of one run in the shared folder: a lost executor costs nothing that came before a copy."""

    def __init__(self, spark: SparkSession):
        self.spark, self.base = spark, f"{shared_folder(spark)}/links-{uuid.uuid4().hex}"

    def put(self, name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{self.base}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.base}/{name}")

    def drop(self, name: str) -> None:
        discard(self.spark, f"{self.base}/{name}")


def follow_links(df: DataFrame, chain: list[str], address: str, link: str, first: Column, ok: Column,
                 rank_name: str = "page_rank", complete_name: str = "complete") -> DataFrame:
    """Pages of each chain in the order in which a client that follows links would get them.

    A chain starts at its page marked ``first``; the next page is the one whose ``address`` equals the
    page's ``link`` (empty and NULL: the last page). It ends before a page that is not ``ok`` (NULL counts
    as not ok), at a link to an address that was not landed, and before a page that it had before (a
    cycle). Pages that are not reached are dropped. ``page_rank`` counts from 0; ``complete`` is true only
    if the chain reached a page without a link. Repeated rows of an address share its rank if they agree;
    an address whose rows disagree on the link or on being ok (a fork) counts as not ok, as does a
    second address marked ``first``.

    The rank comes from pointer doubling: in round k every page knows the page 2^k links ahead, and every
    page reached so far passes the rank on over that jump, so a chain of n pages takes log2(n) rounds of
    two joins on the number of a page, which stands for its (chain, address). Each round is kept in the shared
    folder until the next one is there. No chain is ever gathered in one task.
    """
    copies = _Copies(df.sparkSession)
    keys = [f"_k{i}" for i in range(len(chain))]
    good = F.coalesce(ok, F.lit(False))
    target = F.when(F.col(link) != "", F.col(link))
    rows = df.select(*[F.col(c).alias(k) for c, k in zip(chain, keys)], F.col(address).alias("_at"),
                     target.alias("_next"), good.alias("_ok"), F.coalesce(first, F.lit(False)).alias("_first"))
    pages = rows.filter(F.col("_at").isNotNull()).groupBy(*keys, "_at").agg(
        F.min("_next").alias("_next"), F.max("_next").alias("_other"),
        F.max(F.col("_next").isNull()).alias("_ends"), F.min("_ok").alias("_ok"), F.max("_first").alias("_first"))
    # one link for all rows of the address, or none for any
    agree = F.coalesce(F.when(~F.col("_ends"), F.col("_next") == F.col("_other")), F.col("_next").isNull())
    # written once, so a page keeps its number
    nodes = copies.put("nodes", pages.filter(F.col("_ok") & agree).select(
        *keys, "_at", "_next", "_first", F.monotonically_increasing_id().alias("_page")))
    # a link whose target is not there leads nowhere
    there = nodes.select(*[F.col(k).alias(f"r{k}") for k in keys], F.col("_at").alias("_to"), F.col("_page").alias("_far"))
    on = nodes["_next"] == there["_to"]
    for k in keys:
        on = on & nodes[k].eqNullSafe(there[f"r{k}"])
    jump = copies.put("jump-1", nodes.filter("_next IS NOT NULL").join(there, on).select("_page", F.col("_far").alias("_next")))
    starts = nodes.filter("_first").groupBy(*keys).agg(F.min("_page").alias("_page"), F.max("_page").alias("_last"))
    reached = copies.put("reached-1", starts.filter("_page = _last").select("_page", F.lit(0).cast("long").alias("_rank")))
    step = 1
    while True:
        far = jump.select(F.col("_page").alias("_to"), F.col("_next").alias("_far"))
        onward = reached.join(far, reached["_page"] == far["_to"]).select(
            F.col("_far").alias("_page"), (F.col("_rank") + step).alias("_rank"))
        # in a cycle a page is met again with a higher rank
        now = copies.put(f"reached-{2 * step}", reached.union(onward).groupBy("_page").agg(F.min("_rank").alias("_rank")))
        done = now.count() == reached.count()
        if not done:
            jump = copies.put(f"jump-{2 * step}", jump.join(far, jump["_next"] == far["_to"])
                              .select("_page", F.col("_far").alias("_next")))
        copies.drop(f"jump-{step}")
        copies.drop(f"reached-{step}")
        reached = now
        if done:
            break
        step *= 2
    ranks = reached.select(F.col("_page").alias("_to"), "_rank")
    placed = nodes.join(ranks, nodes["_page"] == ranks["_to"])
    ended = placed.filter("_next IS NULL").select(*[F.col(k).alias(f"e{k}") for k in keys], F.lit(True).alias("_ended"))
    found = placed.select(*keys, "_at", "_rank")
    found = found.join(ended, [found[k].eqNullSafe(ended[f"e{k}"]) for k in keys], "left").select(
        *[F.col(k).alias(f"r{k}") for k in keys], F.col("_at").alias("_to"), "_rank",
        F.coalesce("_ended", F.lit(False)).alias("_done"))
    on = df[address] == found["_to"]
    for c, k in zip(chain, keys):
        on = on & df[c].eqNullSafe(found[f"r{k}"])
    return df.join(found, on).select(*[df[c] for c in df.columns], F.col("_rank").alias(rank_name),
                                    F.col("_done").alias(complete_name))
