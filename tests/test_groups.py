"""Operators that must not gather groups: quantiles, examples, ranks; and finders of entities."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspan.operators import aggregates, joins, shape, text, windows


def test_quantiles(spark):
    rng = random.Random(11)
    groups = {"a": [rng.gauss(0, 1) for _ in range(501)], "b": [5.0] * 3000 + [1.0], "c": [2.0], "d": [1.0, 2.0]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("e", None), (None, 3.0)], "g string, v double")
    shares = (0.0, 0.25, 0.5, 0.9, 1.0)
    got = {r["g"]: (r["n"], r["quantiles"]) for r in aggregates.exact_quantiles(df, "g", "v", shares).collect()}
    assert set(got) == {*groups, None}
    for g, vs in groups.items():
        assert got[g][0] == len(vs) and np.allclose(got[g][1], np.quantile(vs, shares))


def test_least_values(spark):
    rows = [("hot", f"{i:05}") for i in range(4000)] * 2 + [("k", "b"), ("k", "a"), ("k", None), (None, "z")]
    got = {r["g"]: r["examples"] for r in aggregates.least_values(spark.createDataFrame(rows, "g string, v string"), ["g"], "v", 3).collect()}
    assert got == {"hot": ["00000", "00001", "00002"], "k": ["a", "b"], None: ["z"]}
    found = aggregates.duplicate_groups(spark.createDataFrame(rows, "g string, v string"), [F.col("g")], "v", 2).collect()
    assert {r["key0"]: (r["n"], r["examples"]) for r in found} == {"hot": (8000, ["00000", "00001"]), "k": (3, ["a", "b"])}


def test_first_by(spark):
    rows = [("k", 2, "x"), ("k", 1, "y"), ("k", 1, "z"), (None, 3, "w")]
    got = sorted(map(tuple, joins.first_by(spark.createDataFrame(rows, "k string, o int, v string"), ["k"], [F.col("o"), F.col("v")]).collect()), key=str)
    assert got == sorted([("k", 1, "y"), (None, 3, "w")], key=str)


@pytest.mark.parametrize("n", [0, 1, 500])
def test_numbered(spark, n):
    words = [f"w{i:04}" for i in range(n)]
    random.Random(12).shuffle(words)
    got = {r["w"]: r["id"] for r in windows.numbered(spark.createDataFrame([(w,) for w in words], "w string"), "w", "id").collect()}
    assert got == {w: f"P{i + 1:08}" for i, w in enumerate(sorted(words))}


def test_melt_and_pivot_are_inverse(spark):
    rows = [(f"s{i}", float(i), float(-i) if i % 3 else None, f"t{i}" if i % 2 else None) for i in range(40)]
    wide = spark.createDataFrame(rows, "id string, a double, b double, c string")
    store = shape.melted_by_type(wide, "id", "src")
    assert store.count() == sum(x is not None for r in rows for x in r[1:])
    back = shape.pivoted(store.filter("value_num is not null"), ["sample_id"], value="value_num", features=["a", "b"])
    assert {tuple(r) for r in back.collect()} == {(r[0], r[1], r[2]) for r in rows}
    matrix = shape.occurrence_matrix(store, "sample_id", "feature", ["a", "b", "c"]).collect()
    assert {tuple(r) for r in matrix} == {(r[0], 1, int(r[2] is not None), int(r[3] is not None)) for r in rows}


def test_role_overlaps(spark):
    ids = {"x": {1, 2, 3}, "y": {2, 3, 4, 5}, "z": {9}}
    df = spark.createDataFrame([(r, i) for r, vs in ids.items() for i in vs] * 2, "role string, id int")
    got = {(r["role_a"], r["role_b"]): (r["n_a"], r["n_shared"]) for r in joins.role_overlaps(df, "role", "id").collect()}
    assert got == {(a, b): (len(ids[a]), len(ids[a] & ids[b])) for a in ids for b in ids if a != b and ids[a] & ids[b]}


def test_outer_all(spark):
    a = spark.createDataFrame([("k", 1), ("l", 2)], "key string, a int")
    b = spark.createDataFrame([("k", "x"), ("m", "y")], "key string, b string")
    assert sorted(map(tuple, joins.outer_all([a, b], "key").collect())) == [("k", 1, "x"), ("l", 2, None), ("m", None, "y")]


def test_entities_and_annotation(spark):
    df = spark.createDataFrame([(1, 0, "ERBB2 and BRCA1 at 5 mg"), (1, 1, None), (2, 0, "")], "doc int, s int, t string")
    finders = [text.pattern_backend({"gene": r"[A-Z]{4}\d"}, 0.9), text.pattern_backend({"code": r"[A-Z]{2}\d", "dose": r"\d mg"}, 0.5)]
    got = [(r["start"], r["text"], r["kind"]) for r in text.entities(df, ["doc", "s"], "t", finders).collect()]
    assert got == [(0, "ERBB2", "gene"), (10, "BRCA1", "gene"), (19, "5 mg", "dose")]
    vocabulary = spark.createDataFrame([("brca1", "BRCA1", "gene")], "term string, canonical string, entity string")
    rows = {(r["doc"], r["s"]): (r["mentions"], r["normalized_terms"]) for r in text.annotated(df.withColumn("k", F.concat_ws("-", "doc", "s")), "k", ["t"], vocabulary, "term", "canonical", "entity").collect()}
    assert rows == {(1, 0): (["BRCA1"], ["BRCA1"]), (1, 1): ([], []), (2, 0): ([], [])}


def test_source_gaps(spark):
    rows = [("t", "a", None)] * 3 + [("t", "b", "")] * 3 + [("t", "c", "x")] + [("u", "c", None)]
    df = spark.createDataFrame(rows, "topic string, src string, v string")
    got = [tuple(r) for r in aggregates.source_gaps(df, "topic", "src", F.coalesce("v", F.lit("")) == "", 1).orderBy("topic").collect()]
    assert got == [("t", "a", 3, 1), ("u", "c", 1, 1)]
    profile = aggregates.column_profile(df, "x")
    assert {(r["keyword"], r["column_name"]) for r in aggregates.keyword_columns(profile, ["TOP", "r"]).collect()} == {("TOP", "topic"), ("r", "src")}


def test_profile(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2)], "x string, y int")
    got = {r["column_name"]: (r["n_rows"], r["n_filled"], r["n_distinct"]) for r in aggregates.column_profile(df, "t").collect()}
    assert got == {"x": (3, 2, 1), "y": (3, 2, 2)}
    assert Counter(r["column_name"] for r in aggregates.best_id_column(aggregates.column_profile(df, "t")).collect()) == Counter(["y"])


def test_numbered_with_other_columns(spark):
    """Ids are contiguous and distinct and classes equal, whatever columns are carried or read."""
    n = 600_000
    rows = spark.range(0, n, 1, 8).select((F.col("id") * 7919 % n).alias("k"), F.repeat(F.md5(F.col("id").cast("string")), 4).alias("payload"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int")).alias("label"))
    got = windows.numbered(rows, "k", "id").agg(F.count_distinct("id"), F.min("id"), F.max("id"), F.count_distinct("payload"), F.sum((F.substring("id", 2, 8).cast("bigint") != F.col("k") + 1).cast("int"))).first()
    assert tuple(got) == (n, "P00000001", f"P{n:08}", n, 0)
    kept = windows.balanced(rows.filter("label <> 'c' or k % 2 = 0"), "label", "k")
    by = {r["label"]: (r["n"], r["d"], r["m"]) for r in kept.groupBy("label").agg(F.count("*").alias("n"), F.count_distinct("rn").alias("d"), F.max("rn").alias("m")).collect()}
    assert len(by) == 3 and len(set(by.values())) == 1 and all(a == b == c for a, b, c in by.values())
