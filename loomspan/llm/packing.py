"""Items into containers of fixed capacity: best-fit decreasing, certified by dual feasible functions, repacked where open."""

from __future__ import annotations

from bisect import bisect_left, insort
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.session import cut

#: Items that one group packs at once.
GROUP_ITEMS = 60_000
#: Groups whose open containers are thrown together in an exchange.
FAN_IN = 8
#: Up to this capacity the room that containers have left is kept as bits of one number; above it, as a sorted list.
BIT_ROOM = 1 << 16
#: More budgets than this are refused: every item gets a row for each.
MAX_BUDGETS = 100


def lower_bound(values: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """Containers that any packing needs of so many items of each size (distinct, ascending, within the capacity).

    Three families of dual feasible functions, each over its whole range of parameters: the plain sum; sizes above
    capacity - p as whole containers and sizes below p as nothing, for every size p up to half the capacity; and rounding
    by u_k for k up to 30.
    """
    values, counts = values[values > 0], counts[values > 0]
    if not len(values):
        return 0
    best = -(-int((values * counts).sum()) // capacity)
    total = np.concatenate([[0], np.cumsum(values * counts)])
    number = np.concatenate([[0], np.cumsum(counts)])
    p = values[values * 2 <= capacity]
    if len(p):
        low, high = np.searchsorted(values, p), np.searchsorted(values, capacity - p, side="right")
        filled = total[high] - total[low] + capacity * (number[-1] - number[high])
        best = max(best, int((-(-filled // capacity)).max()))
    best = max(best, int(counts[values * 2 > capacity].sum()))
    for k in range(1, 31):
        scaled = (k + 1) * values
        rounded = np.where(scaled % capacity == 0, k * values, (scaled // capacity) * capacity)  # u_k times k * capacity
        best = max(best, -(-int((rounded * counts).sum()) // (k * capacity)))
    return best


class _Bits:
    """A set of small numbers, one bit each."""

    def __init__(self) -> None:
        self.bits = 0

    def add(self, n: int) -> None:
        self.bits |= 1 << n

    def remove(self, n: int) -> None:
        self.bits ^= 1 << n

    def least_from(self, n: int) -> int:
        """The least number of at least n, or -1."""
        high = self.bits >> n
        return n + (high & -high).bit_length() - 1 if high else -1


class _Sorted:
    """A set of numbers of any size, as a sorted list."""

    def __init__(self) -> None:
        self.numbers: list[int] = []

    def add(self, n: int) -> None:
        insort(self.numbers, n)

    def remove(self, n: int) -> None:
        del self.numbers[bisect_left(self.numbers, n)]

    def least_from(self, n: int) -> int:
        at = bisect_left(self.numbers, n)
        return self.numbers[at] if at < len(self.numbers) else -1


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container of each item: largest first, each into the fullest container that still holds it."""
    out = np.zeros(len(sizes), np.int64)
    free: dict[int, list[int]] = {}
    room, n = _Bits() if capacity <= BIT_ROOM else _Sorted(), 0  # the rooms that some container has left
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        if not size:
            break
        left = room.least_from(size)
        if left >= 0:
            bin_ = free[left].pop()
            if not free[left]:
                room.remove(left)
        else:
            left, bin_, n = capacity, n, n + 1
        out[i] = bin_
        rest = left - size
        if rest:
            held = free.setdefault(rest, [])
            if not held:
                room.add(rest)
            held.append(bin_)
    return out  # items of no size stay in container 0


def _pack(level: int, last: bool):
    def run(items: pd.DataFrame) -> pd.DataFrame:
        capacity = int(items["capacity"].iloc[0])
        items = items.iloc[np.lexsort((items["piece"].to_numpy(), items["doc_id"].to_numpy()))]
        sizes = items["size"].to_numpy(np.int64)
        bins = best_fit_decreasing(sizes, capacity)
        n = int(bins.max()) + 1
        gap = n - max(1, lower_bound(*np.unique(sizes, return_counts=True), capacity))
        fill = np.bincount(bins, weights=sizes, minlength=n)
        open_ = np.zeros(n, bool)
        if not last:
            emptiest = np.argsort(fill, kind="stable")[: max(4 * (gap + 1), n // 10 if gap > 0 else 0)]
            open_[emptiest[fill[emptiest] < capacity]] = True
        container = (np.int64(level) << np.int64(56)) + (items["grp"].to_numpy(np.int64) << np.int64(24)) + bins
        return items.assign(container_id=container, open=open_[bins])[["budget_name", "capacity", "grp", "doc_id", "piece", "size", "container_id", "open"]]

    return run


_ROW = "budget_name string, capacity bigint, grp bigint, doc_id bigint, piece bigint, size bigint, container_id bigint, open boolean"


def pack(sizes: DataFrame, budgets: DataFrame, group_items: int = GROUP_ITEMS) -> DataFrame:
    """(budget_name, capacity, container_id, doc_id, piece, token_start, token_end): every item in a container, per budget.

    sizes has doc_id and n_tokens; budgets has budget_name and capacity. An item within the capacity is one piece; a larger
    one is cut into full pieces and a rest, and only such an item is cut. Items of no tokens and items without a size get a
    place of no room. Rows without doc_id are items too; repeated rows are items of their own; budgets without a positive
    capacity are left out. Other columns are ignored, an empty input gives no rows.

    Items are packed in groups of about group_items by best-fit decreasing. A group whose number of containers meets its
    lower bound is done but for its few emptiest ones, whose room only other groups can use; the others give up their
    emptiest tenth. What is given up is packed anew together with that of other groups, FAN_IN groups at a time, until one
    group is left: a tenth of FAN_IN groups is less than a group, so the groups never grow, and their number falls to one
    after as many exchanges as its logarithm. bounds() sets the result against the lower bound of all items together.
    """
    spark = sizes.sparkSession
    limits = budgets.filter("capacity > 0").groupBy("budget_name", "capacity").agg(F.lit(1)).limit(MAX_BUDGETS + 1).collect()
    if len(limits) > MAX_BUDGETS:
        raise ValueError(f"more than {MAX_BUDGETS} budgets")
    if not limits:
        return spark.createDataFrame([], "budget_name string, capacity bigint, container_id bigint, doc_id bigint, piece bigint, token_start bigint, token_end bigint")
    pairs = F.array(*[F.struct(F.lit(r["budget_name"]).alias("budget_name"), F.lit(r["capacity"]).cast("bigint").alias("capacity")) for r in limits])
    rows = sizes.select("doc_id", F.coalesce("n_tokens", F.lit(0)).cast("bigint").alias("n")).select("doc_id", "n", F.inline(pairs))
    last_piece = F.greatest(F.ceil(F.col("n") / F.col("capacity")) - 1, F.lit(0)).cast("bigint")
    items = rows.select("budget_name", "capacity", "doc_id", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), last_piece)).alias("piece"))
    items = items.withColumn("size", F.least("capacity", F.col("n") - F.col("piece") * F.col("capacity")))
    counts = {(r["budget_name"], r["capacity"]): r["count"] for r in items.groupBy("budget_name", "capacity").count().collect()}
    groups = max(1, -(-max(counts.values(), default=0) // group_items))
    todo = items.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", F.col("n")), F.lit(groups)))
    done = []
    while True:
        level, last = len(done), groups == 1
        packed = cut(todo.select("budget_name", "capacity", "grp", "doc_id", "piece", "size").groupBy("budget_name", "capacity", "grp").applyInPandas(_pack(level, last), _ROW))
        done.append(packed.filter("not open"))
        if last:
            break
        groups = -(-groups // FAN_IN)
        todo = packed.filter("open").withColumn("grp", F.pmod("grp", F.lit(groups)))
    all_ = reduce(DataFrame.unionByName, done)
    start = F.col("piece") * F.col("capacity")
    return all_.select("budget_name", "capacity", "container_id", "doc_id", "piece", start.alias("token_start"), (start + F.col("size")).alias("token_end"))


def bounds(packed: DataFrame) -> DataFrame:
    """(budget_name, capacity, n_items, n_containers, lower_bound, fill): how near a packing is to what any one needs.

    The bound is taken over all items together, from their counts by size: at most as many rows as the capacity has tokens.
    """
    sized = packed.withColumn("size", F.col("token_end") - F.col("token_start"))
    histogram = sized.groupBy("budget_name", "capacity", "size").agg(F.count("*").alias("n"))

    def bound(rows: pd.DataFrame) -> pd.DataFrame:
        capacity = int(rows["capacity"].iloc[0])
        rows = rows.sort_values("size")
        need = lower_bound(rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64), capacity)
        return pd.DataFrame({"budget_name": [rows["budget_name"].iloc[0]], "capacity": [capacity], "lower_bound": [need]})

    least = histogram.groupBy("budget_name", "capacity").applyInPandas(bound, "budget_name string, capacity bigint, lower_bound bigint")
    per = sized.groupBy("budget_name", "capacity", "container_id").agg(F.count("*").alias("n"), F.sum("size").alias("tokens"))
    total = per.groupBy("budget_name", "capacity").agg(F.sum("n").alias("n_items"), F.count("*").alias("n_containers"), F.sum("tokens").alias("tokens"))
    return total.join(least, ["budget_name", "capacity"]).select("budget_name", "capacity", "n_items", "n_containers", "lower_bound", F.round(F.col("tokens") / (F.col("n_containers") * F.col("capacity")), 6).alias("fill"))
