"""Joins and aggregates that keep whole results under hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot if it holds more than this share of all rows; so at most 1 / HOT_SHARE keys are hot.
HOT_SHARE = 0.001


def salted_join(big: DataFrame, small: DataFrame, key: str | Sequence[str], spread: Column, count: str, total: int, how: str = "inner", salts: int | None = None) -> DataFrame:
    """Equi-join of big with small (one row per key) in which the rows of hot keys are spread over ``salts`` partitions.

    ``key`` is one column or several; ``count`` is small's column with the number of big's rows of that key; ``spread`` is
    hashed to choose the salt. Hot keys are those above ``total * HOT_SHARE``: at most 1 / HOT_SHARE of them exist, which
    bounds what is broadcast (the keys alone) and how many rows of small are replicated. Rows of either side are neither
    lost nor multiplied.
    """
    keys = [key] if isinstance(key, str) else list(key)
    salts = salts or int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_hot = F.col(count) > max(1000, int(total * HOT_SHARE))
    hot = small.filter(is_hot).select(*[F.col(k).alias(f"_hot{i}") for i, k in enumerate(keys)])
    tagged = big.join(F.broadcast(hot), reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_hot{i}") for i, k in enumerate(keys)]), "left")
    tagged = tagged.withColumn("_salt", F.when(F.col("_hot0").isNotNull(), F.pmod(F.xxhash64(spread), F.lit(salts))).otherwise(F.lit(0).cast("bigint"))).drop(*hot.columns)
    copies = small.withColumn("_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).otherwise(F.array(F.lit(0).cast("bigint")))))
    return tagged.join(copies, [*keys, "_salt"], how).drop("_salt")
