import random
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from loomspan.llm import frequency

SCHEMA = "occ_id bigint, term string, source_file string, freq bigint, n_files bigint, h string"


def brute(rows):
    once = {}
    for i, (occ, term, file, freq, *_) in enumerate(rows):
        key = " ".join((term or "").lower().split())
        if key:
            at = (occ, key, file) if occ is not None else (("row", i), key, file)
            once[at] = max(once.get(at, 0), 1 if freq is None else freq)
    total, files = defaultdict(int), defaultdict(set)
    for (_, key, file), f in once.items():
        total[key] += f
        if file is not None:
            files[key].add(file)
    all_files = len({r[2] for r in rows if r[2] is not None})
    return {(k, n, len(files[k]), n <= 3, len(files[k]) > all_files * 0.5) for k, n in total.items()}


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA)
    return {tuple(r) for r in frequency.term_frequencies(df, **options).collect()}


CASES = [
    [], [(1, None, None, None), (2, "  ", "f", 3), (3, "", "g", 1)], [(1, "A\t b ", "f", None), (1, "A\t b ", "f", None), (2, "a  B", "g", 2), (None, "a b", "f", 1), (None, "a b", "f", 1)],
    [(i, "hot", f"f{i % 5}", 1) for i in range(3000)] + [(i, "hot", f"f{i % 5}", 1) for i in range(500)], [(1, "x" * 300_000, "f", 2), (2, "X" * 300_000, "g", 2)],
]


@pytest.mark.parametrize("rows", CASES)
@pytest.mark.parametrize("limit", [frequency.PARTITION_BYTES, 2000])
def test_equals_brute_force(spark, rows, limit):
    assert run(spark, rows, partition_bytes=limit) == brute(rows)


def test_hot_terms(spark):
    """Terms that hold much of all rows are found, spread, and counted like others."""
    rng = random.Random(9)
    rows = [(i, "hot" if i % 3 == 0 else "warm" if i % 20 == 1 else f"t{rng.randrange(3000)}", f"f{rng.randrange(30)}", rng.choice([None, 1, 5])) for i in range(20_000)]
    rows += rows[::7] + [(None, "hot", "f1", 2)] * 500
    hashes = spark.createDataFrame([(hash(r[1]) % 1000003,) for r in rows], "h bigint")
    assert {hash("hot") % 1000003, hash("warm") % 1000003} == set(frequency.hot_hashes(hashes, 0.02))
    for limit in (frequency.PARTITION_BYTES, 20_000):
        assert run(spark, rows, partition_bytes=limit, hot_share=0.02) == brute(rows)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 20)), st.sampled_from([None, "", "a", "A ", "b c", "b c", "é"]), st.sampled_from([None, "", "f", "g"]), st.one_of(st.none(), st.integers(0, 4))), max_size=30))
def test_random(spark, rows):
    rows = [(o, t, f, n) for o, t, f, n in {r[0]: r for r in rows if r[0] is not None}.values()] + [r for r in rows if r[0] is None]
    assert run(spark, rows, partition_bytes=200) == brute(rows)


def test_marks(spark):
    rng = random.Random(3)
    rows = [(i, f"t{int(rng.paretovariate(0.7))}", f"f{rng.randrange(4)}", None) for i in range(2000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    marks = {tuple(r) for r in frequency.marked_terms(frequency.term_frequencies(df)).collect()}
    assert marks == {(k, m) for k, _, _, rare, common in brute(rows) for m, on in (("rare", rare), ("common", common)) if on}
