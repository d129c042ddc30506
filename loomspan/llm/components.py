"""Pairwise links into groups: union-find per partition, spanning forests, hierarchical merging."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.operators.identifiers import least_roots
from loomspan.session import cut
from loomspan.skew import salted_join

#: A union-find merges about so many links at once.
FOREST_LINKS = 500_000

# What stands for no identifier, compared like identifiers: upper case, no white space, - for _.
NO_IDENTIFIER = ["", "NA", "N/A", "#N/A", "#NA", "N.A.", "NAN", "NULL", "NONE", "NIL", "UNKNOWN", "UNK", "UNASSIGNED", "UNDEFINED", "MISSING", "NOTAVAILABLE", "NOT-AVAILABLE", "NOTASSIGNED", "NOTAPPLICABLE", "NOID", "TBD", "ANONYMOUS"]


def with_identifiers(rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(_i0, _i1, ...): the identifiers of the fields as they are compared; null for nulls, blanks and placeholders.

    Placeholders are the words of NO_IDENTIFIER, anything without letters and digits, and zeros alone or after one letter
    (0, P00000000): a counter that was never set. The compared form is a projection of its own, evaluated once.
    """
    plain = lambda c: F.replace(F.regexp_replace(F.upper(c), r"(?U)\s+", ""), F.lit("_"), F.lit("-"))
    keys = rows.select(*[plain(rows[f].cast("string")).alias(f"_i{i}") for i, f in enumerate(fields)])
    names = lambda c: F.when(~c.isin(NO_IDENTIFIER) & c.rlike(r"[\p{L}\p{N}]") & ~c.rlike(r"^[A-Z]?[-]?0+$"), c)
    return keys.select(*[names(F.col(c)).alias(c) for c in keys.columns])


def _priority(nodes: np.ndarray, level: int) -> np.ndarray:
    """A permutation of 64-bit numbers, another at each level."""
    x = nodes.astype(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) & 0xFFFFFFFFFFFFFFFF)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _distinct(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct 128-bit nodes (rows of two numbers), and the place of each given node among them."""
    order = np.lexsort((nodes[:, 1], nodes[:, 0]))
    there = nodes[order]
    new = np.ones(len(there), bool)
    new[1:] = (there[1:] != there[:-1]).any(axis=1)
    where = np.empty(len(there), np.int64)
    where[order] = np.cumsum(new) - 1
    return there[new], where


def spanning_forest(a: np.ndarray, b: np.ndarray, level: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, roots) of the links between nodes a and b, 128-bit numbers as rows of two: union-find with whole arrays.

    The root of a tree is its node of least priority.
    """
    nodes, where = _distinct(np.concatenate([a, b]))
    order = np.argsort(_priority(nodes[:, 0], level), kind="stable")
    rank = np.empty(len(nodes), np.int64)
    rank[order] = np.arange(len(nodes))
    u, v = rank[where[: len(a)]], rank[where[len(a) :]]
    return nodes, nodes[order[least_roots(u, v, len(nodes))[rank]]]


_LINK = "a1 bigint, a2 bigint, b1 bigint, b2 bigint"


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = lambda i: batch.column(i).to_numpy(zero_copy_only=False)
    return np.stack([column(0), column(1)], axis=1), np.stack([column(2), column(3)], axis=1)


def _batches(names: list[str], *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), 100_000):
        yield pa.record_batch([pa.array(c[at : at + 100_000]) for c in columns], names=names)


class _Forest:
    """Links held as a spanning forest: whenever they are more than the limit, they are merged, and only the forest stays."""

    def __init__(self, level: int, limit: int) -> None:
        self.level, self.limit = level, limit
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.n = 0

    def add(self, batch: pa.RecordBatch) -> bool:
        """Whether the links have been merged now."""
        self.held.append(_arrays(batch))
        self.n += batch.num_rows
        if self.n <= self.limit:
            return False
        self.held = [self.merged()]
        self.n = len(self.held[0][0])
        return True

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        return spanning_forest(np.concatenate([a for a, _ in self.held]), np.concatenate([b for _, b in self.held]), self.level)


def _edge_forests(level: int, limit: int):
    """Of an edge partition, as it lies, the spanning forest; of a very large one, several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = _Forest(level, limit)
        rows = lambda f: _batches(["a1", "a2", "b1", "b2"], f[0][:, 0], f[0][:, 1], f[1][:, 0], f[1][:, 1])
        for batch in batches:
            if batch.num_rows and forest.add(batch) and forest.n > limit // 2:  # the forest alone is as much as may be held
                yield from rows(forest.held[0])
                forest = _Forest(level, limit)
        if forest.n:
            yield from rows(forest.merged())

    return run


def _merged_forests(level: int, limit: int):
    """A partition of nodes with their roots from all edge partitions, merged: (node, head, False) for each node, and
    (root, head, True) for each root that has another head here, which links this partition with the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, own, ends = _Forest(level, limit), [], []
        for batch in batches:
            if batch.num_rows:
                a, b = _arrays(batch)
                own.append(a)
                ends.append(b)
                forest.add(batch)
        if not forest.n:
            return
        nodes, heads = forest.merged()
        of = {True: _distinct(np.concatenate(ends))[0], False: _distinct(np.concatenate(own))[0]}
        for is_link, kept in of.items():
            places, where = _distinct(np.concatenate([nodes, kept]))
            head = np.empty((len(places), 2), np.int64)
            head[where[: len(nodes)]] = heads
            top = head[where[len(nodes) :]]
            if is_link:
                apart = (kept != top).any(axis=1)
                kept, top = kept[apart], top[apart]
            yield from _batches(["a1", "a2", "b1", "b2", "is_link"], kept[:, 0], kept[:, 1], top[:, 0], top[:, 1], np.full(len(kept), is_link))

    return run


def forest_levels(links: DataFrame, limit: int = FOREST_LINKS, sizes: list[int] | None = None) -> list[DataFrame]:
    """Tables (a1, a2, b1, b2), written: the head (b1, b2) of every node (a1, a2) of the links, then of every head that another
    one lies above, and so on; a head that is no node of the table above is a root. All columns are BIGINT.

    Union-find runs over each edge partition as it lies and keeps the spanning forest only. Forests are merged through as
    many partitions, by hash of the node, as hold about ``limit`` rows each: there union-find runs again, each node gets its
    head, and of the forests remain the roots that have different heads in different partitions, as links between roots
    alone. They are the next level's graph, and a level of one partition leaves none. The order of roots changes at random
    with each level, so that of roots with links at most half stay roots, in expectation; levels grow with the logarithm of
    the links. A node with any share of all links leaves an edge partition as one row; a component has at most one head in
    each merging partition.

    The same steps run at every size. ``sizes``, if given, receives the number of merging partitions of each level.
    """
    levels: list[DataFrame] = []
    graph = cut(links.select("a1", "a2", "b1", "b2").mapInArrow(_edge_forests(0, limit), _LINK))
    rows = graph.count()
    while True:
        level, parts = len(levels), -(-max(1, rows) // limit)
        if level:
            graph = graph.mapInArrow(_edge_forests(level, limit), _LINK)  # a link has two nodes, so a forest is at most twice as large
            parts = -(-2 * rows // limit)
        merged = cut(graph.repartition(parts, "a1", "a2").mapInArrow(_merged_forests(level, limit), _LINK + ", is_link boolean"))
        levels.append(merged.filter("not is_link").drop("is_link"))
        if sizes is not None:
            sizes.append(parts)
        graph = merged.filter("is_link").drop("is_link")
        if parts == 1 or (rows := graph.count()) == 0:
            return levels


def _above(levels: list[DataFrame]) -> DataFrame:
    """(b1, b2, t1, t2): the root (t1, t2) of every node (b1, b2) of the first of the levels."""
    names = ("b1", "b2", "t1", "t2")
    top = levels[-1].toDF(*names)
    for below in reversed(levels[:-1]):
        counts = below.groupBy("b1", "b2").agg(F.count("*").alias("n")).join(top, ["b1", "b2"], "left")
        joined = salted_join(below, counts, ["b1", "b2"], F.col("a1"), "n", below.count())
        top = cut(joined.select("a1", "a2", F.coalesce("t1", "b1"), F.coalesce("t2", "b2")).toDF(*names))
    return top


def node(name: Column) -> tuple[Column, Column]:
    """The two halves of an identifier's 128-bit number, hashes with different seeds."""
    return F.xxhash64(name), F.xxhash64(F.lit(7), name)


def link_rows(rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(a1, a2, b1, b2): for every row the links of its first identifier with each of the others, as 128-bit nodes."""
    ids = with_identifiers(rows, fields)
    stars = ids.select(F.array_compact(F.array(*ids.columns)).alias("ids")).filter("size(ids) > 1")
    stars = stars.select(F.transform("ids", lambda x: F.struct(node(x)[0].alias("h1"), node(x)[1].alias("h2"))).alias("ids"))
    pairs = stars.select(F.col("ids")[0].alias("a"), F.explode(F.slice("ids", 2, len(fields))).alias("b")).filter("a <> b")
    return pairs.select(F.col("a.h1").alias("a1"), F.col("a.h2").alias("a2"), F.col("b.h1").alias("b1"), F.col("b.h2").alias("b2"))


def linked_groups(rows: DataFrame, key: str = "patient_key", others: Sequence[str] = ("raw_value", "master_patient_id"), limit: int = FOREST_LINKS, sizes: list[int] | None = None) -> DataFrame:
    """(key, group_key): every distinct identifier of the key field with the smallest one, by bytes, that it is linked with.

    Identifiers of all fields are compared in upper case, without white space, with ``-`` for ``_``, and are one space of
    names. A row links all its identifiers; nulls, blanks and placeholders link nothing. An identifier without links has
    itself as group. Repeated rows change nothing, other columns are ignored, an empty input gives no rows.

    Identifiers are nodes by 128-bit hash (two seeded 64-bit hashes): even of a trillion identifiers two share one with a
    chance below 1 in 10^14. Groups of any size are safe: their smallest key is found by head (combined before it is sent),
    then by root (a root has at most one head in each merging partition), and the join that hands it to the members is
    salted where a head is hot.
    """
    base, *upper = forest_levels(link_rows(rows, (key, *others)), limit, sizes)
    names = with_identifiers(rows, [key]).select(F.col("_i0").alias("name")).filter("name is not null").distinct()
    keys = names.select("name", *[h.alias(n) for h, n in zip(node(F.col("name")), ("a1", "a2"), strict=True)])
    members = cut(keys.join(base, ["a1", "a2"], "left").select("name", F.coalesce("b1", "a1").alias("b1"), F.coalesce("b2", "a2").alias("b2")))
    heads = members.groupBy("b1", "b2").agg(F.min("name").alias("group_key"), F.count("*").alias("n"))
    if upper:
        heads = cut(heads.join(_above(upper), ["b1", "b2"], "left").withColumns({"t1": F.coalesce("t1", "b1"), "t2": F.coalesce("t2", "b2")}))
        heads = heads.drop("group_key").join(heads.groupBy("t1", "t2").agg(F.min("group_key").alias("group_key")), ["t1", "t2"]).drop("t1", "t2")
    return salted_join(members, heads, ["b1", "b2"], F.col("name"), "n", members.count()).select(F.col("name").alias(key), "group_key")


def group_sizes(groups: DataFrame) -> DataFrame:
    """(group_key, n_keys): the size of every group."""
    return groups.groupBy("group_key").agg(F.count("*").alias("n_keys"))
