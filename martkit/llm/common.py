"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.sources.sinks import discard


def fresh(df: DataFrame, base: str) -> str:
    """A column name starting with ``base`` that ``df`` does not have (names compare case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make sure a checkpoint folder is set.

    ``spark.checkpoint.dir`` is the folder that driver and executors share. A
    temporary folder is used only in local mode (tests), where the driver is
    the only process; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        sc.setCheckpointDir(given)
    elif sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="martkit-checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def utf8_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


_scratch: list[str] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are stored inside go when the block is left: write what depends on them before that."""
    ensure_checkpoint_dir(spark)
    _scratch.append(f"{spark.sparkContext.getCheckpointDir()}/scratch-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        discard(spark, _scratch.pop())


def stored(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back (compressed, by column).

    ``codec``: a Parquet compression other than the session's.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{_scratch[-1] if _scratch else spark.sparkContext.getCheckpointDir()}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)
