import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from loomspan.llm import components

SCHEMA = "raw_value string, patient_key string, master_patient_id string, node string, root string"


def brute(rows):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    def clean(x):
        x = "".join((x or "").upper().split()).replace("_", "-")
        return None if x in components.NO_IDENTIFIER or not any(c.isalnum() for c in x) or set(x) <= {"0"} or (x[:1].isalpha() and set(x[1:]) == {"0"}) else x

    keys = set()
    for row in rows:
        ids = [y for y in map(clean, row) if y]
        if k := clean(row[1]):
            keys.add(k)
        for y in ids:
            a, b = find(ids[0]), find(y)
            up[max(a, b)] = min(a, b)
    groups = {}
    for k in keys:
        groups.setdefault(find(k), []).append(k)
    return {k: min(g) for g in groups.values() for k in g}


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    return {r["patient_key"]: r["group_key"] for r in components.linked_groups(df, **options).collect()}


CASES = [
    [], [(None, None, None), ("", "unknown", "P00000000"), ("-", "n/a", " ")], [("x1", None, "m1")], [("a 1", "A_1", None), ("a-1", "B2", "P00000000"), ("c3", "D4", "p00000000 ")], [("a1", "k1", None), ("a1", "k2", None), ("a1", "k1", None)],
    [(f"r{i}", f"k{i}", None) for i in range(50)] + [(f"r{i + 1}", f"k{i}", None) for i in range(49)], [("hub", f"k{i}", None) for i in range(3000)], [("y" * 100_000, "k1", None), ("Y" * 100_000, "k2", None)], [("0", "k1", "0"), ("000", "k2", None)],
]


@pytest.mark.parametrize("rows", CASES)
@pytest.mark.parametrize("limit", [components.FOREST_LINKS, 40])
def test_equals_brute_force(spark, rows, limit):
    assert run(spark, rows, limit=limit) == brute(rows)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(*[st.one_of(st.none(), st.sampled_from(["", "NA", "P00000000"]), st.integers(1, 40).map(lambda i: f"id{i}"))] * 3), max_size=60))
def test_random(spark, rows):
    assert run(spark, rows, limit=10) == brute(rows)


def test_levels(spark):
    """Links far beyond the limit are merged over several levels of bounded partitions; the groups stay the same."""
    rows = [(f"r{i % 700}", f"k{i * 37 % 900}", f"m{i // 3}") for i in range(1500)] + [(f"s{i}", f"t{i}", f"s{i + 1}") for i in range(600)]
    levels = []
    assert run(spark, rows, limit=200, sizes=levels) == brute(rows)
    assert len(levels) >= 3 and levels[0] > 5 and levels[-1] == 1


def test_equal_halves():
    """Nodes that share one half of their number stay apart."""
    a, b = np.array([[1, 1], [1, 2], [2, 1]]), np.array([[5, 1], [5, 2], [5, 1]])
    nodes, roots = components.spanning_forest(a, b)
    up = dict(zip(map(tuple, nodes.tolist()), map(tuple, roots.tolist()), strict=True))
    assert len(up) == 5 and len(set(up.values())) == 2 and up[1, 1] == up[2, 1] == up[5, 1] != up[1, 2] == up[5, 2]


def test_forest():
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 500, 400), rng.integers(0, 500, 400)
    wide = lambda x: np.stack([x, x % 3], axis=1)
    nodes, roots = (x[:, 0] for x in components.spanning_forest(wide(a), wide(b), 3))
    up = dict(zip(nodes.tolist(), roots.tolist(), strict=True))
    assert all(up[x] == up[y] for x, y in zip(a.tolist(), b.tolist(), strict=True)) and all(up[r] == r for r in up.values())
    links = {}
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        links.setdefault(x, set()).add(y)
        links.setdefault(y, set()).add(x)
    seen, parts = set(), 0
    for x in links:
        if x not in seen:
            parts += 1
            todo = [x]
            while todo:
                z = todo.pop()
                if z not in seen:
                    seen.add(z)
                    todo += links[z]
    assert parts == len(set(up.values()))
