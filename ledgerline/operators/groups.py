"""Steps on groups of unknown size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` columns for each key.

    An aggregation rather than a ranked window: every task keeps one row per key before
    the shuffle, so a key with a third of all rows sends one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("best")
    return df.groupBy(*keys).agg(best).select(*[
        F.col(c) if c in keys else F.col(f"best.{c}").alias(c) for c in df.columns
    ])
