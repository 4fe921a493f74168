"""Session helper.

On a cluster the session is created by the platform; :func:`build_session`
only fills in settings that nobody has set, so a cluster's own configuration
and a running session's settings win.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings we want when nobody chose otherwise.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}
# The same for settings that only a new session can take.
_STATIC = {
    "spark.ui.enabled": "false",
    # Call-site capture for error messages costs several JVM round trips per
    # DataFrame call; plans with hundreds of expressions pay seconds for it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "martkit", extra: dict | None = None) -> SparkSession:
    """The running session, or a new one (with the UI off), with unset settings filled in.

    ``shuffle_partitions`` and ``extra`` are the caller's own choices and are
    always applied.
    """
    chosen = dict(extra or {})
    if shuffle_partitions:
        chosen["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if SparkSession.getActiveSession() is None:
        builder = builder.config(map=_STATIC)
    for key, value in chosen.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    given = {row["key"] for row in spark.sql("SET").collect()}
    for key, value in _DEFAULTS.items():
        if key not in given:
            spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that driver and executors share: ``spark.checkpoint.dir``.

    Where nobody has set it, a temporary folder is used in local mode (tests), in which the driver is
    the only process; on a cluster that is an error.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="martkit-shared-")
        sc.setCheckpointDir(folder)
    return folder
