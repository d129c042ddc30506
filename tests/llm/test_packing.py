import random

import pytest

from loomspan.llm import packing

SIZES = [(0, 0), (1, 5), (2, 8), (3, 8), (4, 3), (5, 3), (6, 30), (7, None), (7, 2), (None, 4)]


def packed(spark, sizes, budgets=(("s", 8), ("l", 100), ("z", 0), (None, 8)), **options):
    df = spark.createDataFrame([(a, b, "clash") for a, b in sizes], "doc_id bigint, n_tokens bigint, size string")
    caps = spark.createDataFrame(list(budgets), "budget_name string, capacity bigint")
    return packing.pack(df, caps, **options)


def check(rows, sizes):
    fill, taken = {}, {}
    for r in rows:
        fill[r["budget_name"], r["container_id"]] = fill.get((r["budget_name"], r["container_id"]), 0) + r["token_end"] - r["token_start"]
        assert fill[r["budget_name"], r["container_id"]] <= r["capacity"]
        taken.setdefault((r["budget_name"], r["capacity"]), []).append((r["doc_id"], r["token_start"], r["token_end"]))
    for (_, capacity), pieces in taken.items():
        want = sorted([(d, s, min(s + capacity, n or 0)) for d, n in sizes for s in range(0, max(1, n or 0), capacity)], key=str)
        assert sorted(pieces, key=str) == want


def test_packing_is_whole(spark):
    rows = packed(spark, SIZES).collect()
    check(rows, SIZES)
    assert len({r["container_id"] for r in rows if r["budget_name"] == "l"}) == 1
    assert packed(spark, []).count() == 0 and packed(spark, SIZES, [("z", 0)]).count() == 0


@pytest.mark.parametrize("group", [60_000, 40, 5])
def test_exchanges(spark, group):
    rng = random.Random(9)
    sizes = [(i, int(rng.paretovariate(0.8))) for i in range(1500)]
    df = packed(spark, sizes, [("m", 64)], group_items=group)
    rows = df.collect()
    check(rows, sizes)
    b = packing.bounds(df).first()
    if group > 5:
        assert b["n_containers"] <= b["lower_bound"] * 1.02 + 1
    assert b["n_containers"] == len({r["container_id"] for r in rows}) and b["lower_bound"] <= b["n_containers"]


def test_lower_bound_holds():
    import itertools

    import numpy as np

    rng = random.Random(10)
    for _ in range(60):
        sizes = [rng.randrange(1, 11) for _ in range(rng.randrange(1, 7))]
        best = next(k for k in range(1, len(sizes) + 1) if any(all(sum(s for s, b in zip(sizes, bins, strict=True) if b == j) <= 10 for j in range(k)) for bins in itertools.product(range(k), repeat=len(sizes))))
        low = packing.lower_bound(*np.unique(sizes, return_counts=True), 10)
        assert low <= best <= len(set(packing.best_fit_decreasing(np.array(sizes), 10).tolist()))


def test_large_capacities(monkeypatch):
    """The same containers, however the rooms left are kept."""
    import numpy as np

    sizes = np.array([random.Random(i).randrange(1, 300) for i in range(2000)])
    by_bits = packing.best_fit_decreasing(sizes, 1000)
    monkeypatch.setattr(packing, "BIT_ROOM", 0)
    assert packing.best_fit_decreasing(sizes, 1000).tolist() == by_bits.tolist()
    huge = packing.best_fit_decreasing(sizes * 10_000_000, 10_000_000_000)
    assert huge.tolist() == by_bits.tolist()
