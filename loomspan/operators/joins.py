"""Joins beyond the plain one: null-safe, n-way, by chosen keys, by priority, overlaps (JN-01 to JN-18, SET-01 to SET-08)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.operators.shape import q


def keyed(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", null_safe: bool = False, suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Equi-join by columns of one name; other columns that both have get suffixes (JN-01). null_safe: null keys match."""
    clash = [c for c in left.columns if c in right.columns and c not in keys]
    a = left.select(*[F.col(q(c)).alias(c + suffixes[0] if c in clash else c) for c in left.columns])
    b = right.select(*[F.col(q(c)).alias(c + suffixes[1] if c in clash else c) for c in right.columns])
    if not null_safe:
        return a.join(b, list(keys), how)
    b = b.select(*[F.col(q(c)).alias(f"_r_{c}" if c in keys else c) for c in b.columns])
    on = reduce(lambda x, y: x & y, [F.col(q(k)).eqNullSafe(F.col(q(f"_r_{k}"))) for k in keys])
    return a.join(b, on, how).drop(*[f"_r_{k}" for k in keys])


def with_vocabulary(df: DataFrame, column: str, vocabulary: DataFrame, term: str) -> DataFrame:
    """Every row with what the vocabulary says of a column's value, null where it says nothing (JN-02)."""
    right = vocabulary.select(*[F.col(q(c)).alias(c) for c in vocabulary.columns])
    return df.join(right, df[column] == right[term], "left")


def outer_all(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """All tables side by side by one key, with a row for every key of any (JN-03).

    Done as one union and one aggregation instead of a chain of outer joins: one shuffle for any number of tables. Each
    table must have one row per key; columns must differ by name.
    """
    names = [c for f in frames for c in f.columns if c != key]
    long = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return long.groupBy(key).agg(*[F.first(F.col(q(c)), ignorenulls=True).alias(c) for c in names])


def by_shared_keys(left: DataFrame, right: DataFrame, priority: Sequence[str]) -> DataFrame:
    """Full outer join on all priority keys that both have; without any, the rows of both (JN-04)."""
    shared = [k for k in priority if k in left.columns and k in right.columns]
    return keyed(left, right, shared, "full_outer") if shared else left.unionByName(right, allowMissingColumns=True)


def by_first_key(left: DataFrame, right: DataFrame, candidates: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on the first candidate that both have (JN-05); refused without one."""
    key = next((k for k in candidates if k in left.columns and k in right.columns), None)
    if key is None:
        raise ValueError(f"no common key among {list(candidates)}")
    return keyed(left, right, [key], how)


def distinct_keys(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """(key, in_left, in_right): every key of either side (JN-06)."""
    a = left.select(F.col(q(left_key)).alias("key")).withColumns({"l": F.lit(True), "r": F.lit(False)})
    b = right.select(F.col(q(right_key)).alias("key")).withColumns({"l": F.lit(False), "r": F.lit(True)})
    return a.unionByName(b).filter("key is not null").groupBy("key").agg(F.bool_or("l").alias("in_left"), F.bool_or("r").alias("in_right"))


def members(df: DataFrame, key: str, of: DataFrame, of_key: str) -> DataFrame:
    """The rows whose key is there (JN-08, FLT-03)."""
    return df.join(of.select(F.col(q(of_key)).alias("_m")), F.col(q(key)) == F.col("_m"), "left_semi")


def strangers(df: DataFrame, key: str, of: DataFrame, of_key: str) -> DataFrame:
    """The rows whose key isn't there; a null key never is (JN-09, FLT-04, JN-18)."""
    return df.join(of.select(F.col(q(of_key)).alias("_m")), F.col(q(key)) == F.col("_m"), "left_anti")


def edges_between(edges: DataFrame, nodes: DataFrame, node: str = "id") -> DataFrame:
    """The edges both of whose ends are nodes (JN-10)."""
    return members(members(edges, "src", nodes, node), "dst", nodes, node)


def canonical_or_self(df: DataFrame, term: str, vocabulary: DataFrame, alias: str, canonical: str, to: str = "canonical") -> DataFrame:
    """Each term's canonical form, looked up without case, or the term itself (JN-11); of several the least."""
    table = vocabulary.filter(F.col(q(alias)).isNotNull()).groupBy(F.lower(F.trim(F.col(q(alias)))).alias("_k")).agg(F.min(F.col(q(canonical))).alias("_c"))
    joined = df.join(table, F.lower(F.trim(F.col(q(term)))) == F.col("_k"), "left")
    return joined.withColumn(to, F.coalesce("_c", F.col(q(term)))).drop("_k", "_c")


def keyword_hits(df: DataFrame, text: str, keywords: Sequence[str]) -> DataFrame:
    """A row for each keyword that a text holds as a substring, with the keyword (JN-13): an expression, no nested-loop join."""
    low = F.lower(F.col(q(text)))
    hits = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(k.lower())), F.lit(k)) for k in keywords]))
    return df.withColumn("keyword", F.explode(hits))


def pairs_within(df: DataFrame, group: Sequence[str], item: str, kind: str | None = None, most: int = 2000) -> DataFrame:
    """Ordered pairs (left_item, right_item) of distinct items of one group (JN-14), of differing kinds if a kind is named.

    For groups that are small by nature, such as a sentence's mentions: its distinct items are paired within the row. A
    group of more than ``most`` distinct items is none of these; it fails the query instead of flooding it.
    """
    cells = F.struct(F.col(q(item)).alias("i"), (F.col(q(kind)) if kind else F.lit(None).cast("string")).alias("k"))
    distinct = df.filter(F.col(q(item)).isNotNull()).select(*group, cells.alias("c")).distinct()
    sizes = F.when(F.count("*") <= most, F.array_sort(F.collect_list("c"))).otherwise(F.raise_error(F.lit(f"a group has more than {most} items to pair")))
    lists = distinct.groupBy(*group).agg(sizes.alias("items"))
    rows = lists.withColumn("l", F.explode("items")).withColumn("r", F.explode("items"))
    apart = (F.col("l.i") != F.col("r.i")) & (F.col("l.k") != F.col("r.k") if kind else F.lit(True))
    return rows.filter(apart).select(*group, F.col("l.i").alias("left_item"), F.col("r.i").alias("right_item"))


def role_overlaps(ids: DataFrame, role: str, value: str) -> DataFrame:
    """(role_a, role_b, n_a, n_shared, share): how much of one role's ids another has (JN-15, SET-07).

    Each id's roles are collected, few by nature, and paired within the row.
    """
    roles = ids.filter(F.col(q(value)).isNotNull()).groupBy(F.col(q(value))).agg(F.array_sort(F.collect_set(F.col(q(role)))).alias("roles"))
    pairs = roles.select(F.explode("roles").alias("role_a"), "roles").select("role_a", F.explode("roles").alias("role_b"))
    counts = pairs.groupBy("role_a", "role_b").agg(F.count("*").alias("n_shared"))
    own = counts.filter("role_a = role_b").select(F.col("role_a").alias("_a"), F.col("n_shared").alias("n_a"))
    return counts.filter("role_a <> role_b").join(F.broadcast(own), F.col("role_a") == F.col("_a")).select("role_a", "role_b", "n_a", "n_shared", F.round(F.col("n_shared") / F.col("n_a"), 6).alias("share"))


def best_column_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """(left_column, right_column, n_shared, share, status): which columns of two tables share values (JN-16, RPT-10).

    Every column becomes (column, value) rows, distinct; values meet in one equi-join instead of a loop over columns. share
    is of the smaller column; ok from 0.5 on, warn above 0, of each left column the best.
    """

    def cells(df: DataFrame, name: str) -> DataFrame:
        texts = df.select(*[F.col(q(c)).cast("string").alias(c) for c in df.columns])
        return texts.unpivot([], [F.col(q(c)) for c in df.columns], name, "value").filter("value is not null").distinct()

    a, b = cells(left, "left_column"), cells(right, "right_column")
    sizes_a, sizes_b = a.groupBy("left_column").agg(F.count("*").alias("n_left")), b.groupBy("right_column").agg(F.count("*").alias("n_right"))
    met = a.join(b, "value").groupBy("left_column", "right_column").agg(F.count("*").alias("n_shared"))
    met = met.join(F.broadcast(sizes_a), "left_column").join(F.broadcast(sizes_b), "right_column")  # one row a column
    share = F.round(F.col("n_shared") / F.least("n_left", "n_right"), 6)
    best = met.withColumn("share", share).groupBy("left_column").agg(F.max(F.struct("share", "n_shared", F.col("right_column"))).alias("b"))
    return best.select("left_column", "b.right_column", "b.n_shared", "b.share", F.when(F.col("b.share") >= 0.5, "ok").when(F.col("b.share") > 0, "warn").otherwise("fail").alias("status"))


def first_of_matches(left: DataFrame, key: str, attempts: Sequence[tuple[DataFrame, Column, Column]], value: str) -> DataFrame:
    """For each row of left the match of the first attempt that has one (JN-17): attempts are (table, left key, table key).

    Each attempt is an equi-join of its own with one row a key; of several matches in one attempt the least value counts.
    """
    out = None
    for rank, (table, own, other) in enumerate(attempts):
        keys = left.select(F.col(q(key)).alias("_id"), own.alias("_k")).filter("_k is not null")
        one = table.groupBy(other.alias("_o")).agg(F.min(F.col(q(value))).alias("match"))
        hits = keys.join(one, F.col("_k") == F.col("_o")).select("_id", F.lit(rank).alias("attempt"), "match")
        out = hits if out is None else out.unionByName(hits)
    best = out.groupBy("_id").agg(F.min(F.struct("attempt", "match")).alias("b"))
    return left.join(best, F.col(q(key)) == F.col("_id"), "left").withColumns({"attempt": F.col("b.attempt"), "match": F.col("b.match")}).drop("_id", "b")


def united(frames: Sequence[DataFrame]) -> DataFrame:
    """The rows of all tables, columns by name, missing ones null (SET-01, SET-02)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the given order (SET-03, SET-04, SET-08, WIN-01).

    An aggregation that combines before it sends, not a window: a hot key is no bottleneck.
    """
    sort = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    row = F.struct(*[F.col(q(c)) for c in df.columns])
    return df.groupBy(*keys).agg(F.min_by(row, sort).alias("_r")).select("_r.*")
