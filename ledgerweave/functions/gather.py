"""Ordered values of a group as one array, gathered in two rounds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEGMENT = 1024


def segment_of(position: Column, size: int = SEGMENT) -> Column:
    return F.floor(position / F.lit(size)).cast("long")


def gather_ordered(df: DataFrame, keys: Sequence[str], order: str, value: Column,
                   name: str) -> DataFrame:
    """One row per key with its values in the order of an integer position.

    The first round gathers and sorts runs of positions, so a very long group is
    spread over many tasks; the second only puts finished runs together.
    """
    runs = (df.groupBy(*keys, segment_of(F.col(order)).alias("_segment"))
            .agg(F.array_sort(F.collect_list(
                F.struct(F.col(order).alias("o"), value.alias("v")))).alias("_run")))
    whole = runs.groupBy(*keys).agg(F.array_sort(F.collect_list(
        F.struct("_segment", "_run"))).alias("_runs"))
    ordered = F.transform(F.flatten(F.col("_runs._run")), lambda x: x["v"])
    return whole.select(*keys, ordered.alias(name))
