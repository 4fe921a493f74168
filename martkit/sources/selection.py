"""Row selection at the source: detail rows of chosen keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def details_for(details: DataFrame, keys: DataFrame, detail_key: str, key_col: str,
                stamp: str | None = None) -> DataFrame:
    """Detail rows that belong to the selected keys, stamped with the key.

    A ``left_semi`` join restricts the details before any further work.
    """
    k = keys.select(F.col(key_col).alias("_sel_key"))
    sel = details.join(k, details[detail_key] == F.col("_sel_key"), "left_semi")
    return sel.withColumn(stamp, F.col(detail_key)) if stamp else sel
