import random
import re
from collections import Counter

import pytest

from loomspan.llm import duplicates

SCHEMA = "vocab_id bigint, term string, term_type string, fingerprint string, n string"


def brute(rows):
    groups = {}
    for i, term, kind in rows:
        if term is None or not term.strip():
            continue
        words = Counter(re.findall(r"[^\W_]+", f"{term} {kind or ''}".lower()))
        groups.setdefault(tuple(sorted(words.items())), set()).add(i)
    return {(min(ids - {None}), i) for ids in groups.values() for i in ids - {None} if i != min(ids - {None})}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


CASES = [
    [], [(1, None, "x"), (2, "", "x"), (3, " \t", "x")], [(5, "T-cell  receptor", "gene"), (3, "GENE", "receptor; cell t"), (9, "t cell receptor gene gene", None), (3, "GENE", "receptor; cell t")],
    [(1, "a a b", None), (2, "a b b", None), (3, "a b a", "")], [(1, "???", None), (2, "!!", None), (None, "..", None)], [(i, "hot term", "x" if i % 2 else "X.") for i in range(4000)],
    [(1, "β-Catenin naïve", "ß"), (2, "naïve (β) catenin", "ß")], [(1, "w " * 3000, None), (2, "W " * 3000, None), (3, "w " * 2999, None)],
]


@pytest.mark.parametrize("rows", CASES)
def test_equals_brute_force(spark, rows):
    assert {tuple(r) for r in duplicates.copies(frame(spark, rows)).collect()} == brute(rows)


def test_random(spark):
    rng = random.Random(4)
    rows = [(i, " -/"[rng.randrange(3)].join(rng.choice(["a", "B", "c1", "é"]) for _ in range(rng.randrange(1, 4))), rng.choice([None, "a", "B."])) for i in range(500)]
    assert {tuple(r) for r in duplicates.copies(frame(spark, rows)).collect()} == brute(rows)


def test_collision_is_split(spark, monkeypatch):
    """With a fingerprint that says nothing, equality alone must tell groups apart."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(duplicates, "multiset_fingerprint", lambda pairs: F.lit("same"))
    rows = [(1, "a b", None), (2, "b a", None), (3, "c", None), (4, "C!", None), (5, "d", None)]
    assert {tuple(r) for r in duplicates.copies(frame(spark, rows)).collect()} == {(1, 2), (3, 4)}
    sizes = {r["record_id"]: r["n_copies"] for r in duplicates.duplicate_groups(frame(spark, rows)).collect()}
    assert sizes == {1: 2, 2: 2, 3: 2, 4: 2, 5: 1}


def test_collapse(spark):
    got = {(r["vocab_id"], r["n_copies"]) for r in duplicates.collapse(frame(spark, [(1, "a b", "x"), (2, "B-A", "X"), (3, "c", None)])).collect()}
    assert got == {(1, 2), (3, 1)}


def test_fields_apart(spark):
    rows = [(1, "a", "b"), (2, "b", "a")]
    apart = {"term": ("term",), "term_type": ("term_type",)}
    assert duplicates.copies(frame(spark, rows), groups=apart).count() == 0 and duplicates.copies(frame(spark, rows)).count() == 1


@pytest.mark.parametrize("collide", [False, True])
def test_every_record_without_an_id_counts(spark, monkeypatch, collide):
    from pyspark.sql import functions as F

    if collide:
        monkeypatch.setattr(duplicates, "multiset_fingerprint", lambda pairs: F.lit("same"))
    rows = [(1, "a b", None), *[(None, "B a", None)] * 3, *[(None, "a-b", None)] * 2, (2, "a b", None), (2, "b a", None), (3, "c", None), (None, "C.", None), (None, "C", None), (None, "d", None)]
    assert {(r["record_id"], r["n_copies"]) for r in duplicates.duplicate_groups(frame(spark, rows)).collect()} == {(1, 7), (2, 7), (3, 3)}
    assert {(r["vocab_id"], r["n_copies"]) for r in duplicates.collapse(frame(spark, rows)).collect()} == {(1, 7), (3, 3)}
