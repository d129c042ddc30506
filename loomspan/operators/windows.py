"""Order within groups: keep-first, fill, neighbours, running budgets, numbering, samples (WIN-01 to WIN-13, SRT-01 to SRT-09)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.operators.joins import first_by
from loomspan.operators.shape import q
from loomspan.session import cut

# Sources of aliases, the most trusted last.
SOURCE_PRECEDENCE = ["base", "codebook", "scan_raw", "scan", "seed"]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the order (WIN-01, WIN-03, WIN-13, SRC-24); combined before it is sent."""
    return first_by(df, keys, order)


def alias_winners(df: DataFrame, alias: str, source: str, tie: str) -> DataFrame:
    """For each alias, without case, the row of its most trusted source; the first of several (WIN-02)."""
    rank = F.array_position(F.array(*[F.lit(s) for s in SOURCE_PRECEDENCE]), F.col(q(source)))
    rows = df.filter(F.col(q(alias)).isNotNull()).withColumn("alias_key", F.lower(F.trim(F.col(q(alias)))))
    return first_by(rows, ["alias_key"], [-F.coalesce(rank, F.lit(0)), F.col(q(tie))])


def head_of_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of each group, with their number (WIN-04, WIN-11, SRT-09)."""
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rn") <= n)


def first_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows in an order of several keys (SRT-01, SRT-06); each task keeps its own n, the driver's merge is of those."""
    return df.orderBy(*order).limit(n)


def filled(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str) -> DataFrame:
    """A value's gaps filled from before, then from after, within its group (WIN-05)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    back = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first(value, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return df.withColumn(f"{value}_filled", F.coalesce(back, ahead))


def neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str) -> DataFrame:
    """The value before and after in the group's order (WIN-06)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({f"prev_{value}": F.lag(value).over(w), f"next_{value}": F.lead(value).over(w)})


def within_budget(df: DataFrame, keys: Sequence[str], order: Sequence[Column], size: str, cap: int) -> DataFrame:
    """How much of each row fits into its group's budget, taken in order: the last that begins within it in part (WIN-08)."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(size).over(w)
    return df.withColumn("taken", F.greatest(F.lit(0), F.least(F.col(size), F.lit(cap) - (end - F.col(size)))))


def carried(df: DataFrame, keys: Sequence[str], order: Sequence[Column], header: Column, to: str = "section", default: str = "UNKNOWN") -> DataFrame:
    """The last header at or before each row (WIN-12); header is null where a row is none."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(to, F.coalesce(F.last(header, ignorenulls=True).over(w), F.lit(default)))


def _ranged(df: DataFrame, *order: str) -> DataFrame:
    """The rows range-partitioned and sorted, with their partition _p and their place _n in it, as a written table.

    Written, because a second evaluation may sample other bounds; whoever reads sizes and rows must read the same ones.
    """
    spark = df.sparkSession
    rows = df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    return cut(rows.withColumns({"_p": F.spark_partition_id(), "_n": F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)}))


def numbered(df: DataFrame, order: str, to: str, pattern: str | None = "P%08d") -> DataFrame:
    """Sequential ids in the order of a distinct column (WIN-09), without gathering all rows in one partition.

    Rows are range-partitioned, sorted and written; each partition's size (one number a partition) gives where its numbers
    begin. Without a pattern the ids are numbers from 1. Rows of equal order come one after the other, in any order.
    """
    ranged = _ranged(df, order)
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("n"))
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    starts = sizes.select(F.col("_p").alias("_q"), F.coalesce(F.sum("n").over(w), F.lit(0)).alias("_start"))
    number = F.col("_start") + F.col("_n") + 1
    return ranged.join(F.broadcast(starts), F.col("_p") == F.col("_q")).withColumn(to, F.format_string(pattern, number) if pattern else number).drop("_p", "_n", "_q", "_start")


def every_kth(df: DataFrame, number: str, k: int) -> DataFrame:
    """Every k-th row by a running number (WIN-10): a sampling operator."""
    return df.filter(F.col(number) % k == 0)


def bernoulli(df: DataFrame, share: float, seed: int = 42) -> DataFrame:
    """A random share of the rows, the same for the same seed and partitions (SRT-07)."""
    return df.sample(fraction=share, seed=seed)


def split_by_id(df: DataFrame, key: str, test: int = 20) -> DataFrame:
    """A column part, test or train: test for about so many of a hundred rows, by the id alone, alike in every run (SRT-08)."""
    bucket = F.pmod(F.col(q(key)) * 7919 + 104729, F.lit(100))
    return df.withColumn("part", F.when(bucket < test, "test").otherwise("train"))


def balanced(df: DataFrame, label: str, key: str) -> DataFrame:
    """As many rows of each class as the smallest has, chosen by the md5 of the key (ABS-05); rows without a label go.

    Rows are ranked without gathering a class in one task: they are range-partitioned by class and md5, sorted and written;
    each partition's number of rows of a class (few numbers) tells where its ranks begin.
    """
    ranged = _ranged(df.filter(F.col(q(label)).isNotNull()).withColumn("_h", F.md5(F.col(q(key)).cast("string"))), q(label), "_h", q(key))
    sizes = ranged.groupBy(F.col(q(label)).alias("_label"), F.col("_p").alias("_q")).agg(F.count("*").alias("n"), F.min("_n").alias("_first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("_label").orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_label", "_q", (before - F.col("_first")).alias("_start"), F.sum("n").over(Window.partitionBy("_label")).alias("_all"))
    starts = starts.join(F.broadcast(starts.agg(F.min("_all").alias("_least"))), how="cross")  # one row
    out = ranged.join(F.broadcast(starts), (F.col(q(label)) == F.col("_label")) & (F.col("_p") == F.col("_q")))  # one row a class and partition
    return out.withColumn("rn", F.col("_start") + F.col("_n") + 1).filter("rn <= _least").drop("_h", "_p", "_n", "_q", "_label", "_first", "_start", "_all", "_least")
