"""Per-tenant top-k and row caps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SALT_FROM = 50
_SALTS, _MANY_SALTS = 1024, 16384


def _ranked(df: DataFrame, keys: Sequence, order: Sequence[Column], k: int, name: str) -> DataFrame:
    spec = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(spec)).where(F.col(name) <= k)


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int,
          rank: str = "rank") -> DataFrame:
    """First ``k`` rows of each tenant in the given order, numbered from 1.

    ``row_number() <= k`` lets Spark drop all but ``k`` rows per tenant in every
    map task before the shuffle, so a tenant that owns a third of the data sends
    only ``k`` rows per task.  Over very many tasks these still add up for a
    larger ``k``; a first round then ranks them per group of map tasks.  Where
    ``k`` is beyond the size Spark limits in the map task, that round ranks
    hash-salted parts of each tenant; the salt includes the map task, so that
    copies of a row are spread as well.
    """
    if not by:
        top = df.orderBy(*order).limit(k)
        return top.withColumn(rank, F.row_number().over(W.orderBy(*order)))
    if k >= _SALT_FROM:
        limit = int(df.sparkSession.conf.get(
            "spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
        task = F.spark_partition_id()
        if k <= limit:
            salt = F.pmod(task, F.lit(_SALTS))
        else:
            flat = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
            salt = F.pmod(F.xxhash64(task, *flat), F.lit(_MANY_SALTS))
        df = _ranked(df.withColumn("_salt", salt), [*by, "_salt"], order, k, "_r")
        df = df.drop("_salt", "_r")
    return _ranked(df, by, order, k, rank)
