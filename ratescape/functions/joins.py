"""Join helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which null keys match each other; keys come from the left.

    Comparing the keys as one struct keeps it a plain hash or sort-merge join.
    """
    a = left.withColumn("_key", F.struct(*keys))
    b = right.withColumn("_key", F.struct(*keys)).drop(*keys)
    return a.join(b, "_key", how).drop("_key")
