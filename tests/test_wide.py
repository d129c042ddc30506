import datetime as dt
import random

import pytest

from loomspan.operators import wide

BOOK = [("size_mm", "numeric", "mm"), ("zeta", "numeric", "mV"), ("er_status", "boolean", None), ("stage", "category", None)]
FACTS = "fact_id bigint, sample_id string, feature string, value_num double, value_txt string, source string, measured_at timestamp, loaded_at timestamp, sample string, v string"
DAY = [dt.datetime(2024, 1, d) for d in range(1, 10)]


def book(spark, rows=BOOK):
    return spark.createDataFrame(rows, "feature string, value_kind string, unit string")


def fact(i, sample, feature, num=None, txt=None, day=0, loaded=0):
    return (i, sample, feature, num, txt, "x", None if day is None else DAY[day], None if loaded is None else DAY[loaded], "clash", "clash")


def cells(spark, rows):
    facts = spark.createDataFrame(rows, FACTS)
    table = wide.wide_table(facts, book(spark))
    return {(r["sample_id"], r["feature"]): r["cell"] for r in wide.long_cells(table, wide.read_codebook(book(spark))).collect()}, table


@pytest.mark.parametrize(
    ("text", "unit", "value"),
    [("12", None, 12.0), (" +1,5 ", None, 1.5), ("1,234.5", None, 1234.5), ("1.234,5", None, 1234.5), ("1,234,567", None, 1234567.0), ("−3.5", None, -3.5), ("1.20e+2", None, 120.0), ("7 mm", "mm", 7.0), ("2cm", "mm", 20.0),
     ("7 kg", "mm", None), ("abc", None, None), ("", None, None), (None, None, None), ("-", None, None), ("5.5MV", "mV", 5.5), (".5", None, 0.5)],
)
def test_numbers(spark, text, unit, value):
    rows = spark.createDataFrame([(text, wide.unit_factors(unit))], "t string, u map<string,double>")
    assert wide.parse_number(rows, "t", "u", "n").first()["n"] == value


@pytest.mark.parametrize("laid_out", [wide.LAID_OUT, 8, 1])
def test_cells(spark, laid_out, monkeypatch):
    monkeypatch.setattr(wide, "LAID_OUT", laid_out)
    rows = [
        fact(1, "a", "Size-MM ", 3.0, day=1), fact(2, "a", "size.mm", None, "4,25 mm", day=2), fact(3, "a", "SIZE_MM", -9999.0, None, day=3), fact(4, "a", "er status", None, "Ja", day=1),
        fact(5, "a", "stage", None, "  II  a ", day=1), fact(6, "b", "er_status", 0.0, day=None), fact(7, "b", "er_status", 1.0, day=0), fact(8, "c", "stage", None, "n/a"), fact(9, None, "stage", None, "i"),
        fact(10, "d", "nothing", 1.0), fact(11, "e", "zeta", float("nan"), "−0.0", day=1), fact(12, "e", "zeta", 7.0, None, day=1, loaded=None), fact(13, "e", None, 7.0), fact(14, "f", "er_status", None, "maybe"),
    ]
    found, table = cells(spark, rows)
    assert found == {("a", "size_mm"): "4.2500", ("a", "er_status"): "true", ("a", "stage"): "ii a", ("b", "er_status"): "true", ("e", "zeta"): "0.0000"}
    assert table.columns == ["sample_id", "er_status", "size_mm", "stage", "zeta"]
    assert sorted(r["sample_id"] for r in table.collect()) == list("abcdef")
    assert dict(table.dtypes)["er_status"] == "boolean" and dict(table.dtypes)["size_mm"] == "double"


@pytest.mark.parametrize("sets", [1, 3, 300])
def test_sets(spark, sets):
    """Few sets or as many as entities: the same cells as placed one by one."""
    rng, names = random.Random(sets), [n for n, _, _ in BOOK]
    chosen = [rng.sample(names, rng.randrange(5)) for _ in range(sets)]
    rows, want = [], {}
    for i in range(300):
        for name in chosen[i % sets]:
            rows.append(fact(len(rows), f"s{i}", name, float(rng.randrange(2)) if name != "stage" else None, f"iv {i}" if name == "stage" else None))
            v = rows[-1]
            want[f"s{i}", name] = v[4] if name == "stage" else ("true" if v[3] else "false") if name == "er_status" else f"{v[3]:.4f}"
        rows.append(fact(len(rows), f"s{i}", "no such", 1.0))
    found, table = cells(spark, rows)
    assert found == want and table.count() == 300


def test_ties_and_repeats(spark):
    rows = [fact(i, "hot", "size_mm", float(i % 7), day=3, loaded=i % 5) for i in range(3000)] * 2
    found, table = cells(spark, rows)
    assert found == {("hot", "size_mm"): f"{max((i % 5, i) for i in range(3000))[1] % 7:.4f}"}
    assert table.count() == 1


def test_empty(spark):
    assert cells(spark, [])[0] == {}
    assert wide.wide_table(spark.createDataFrame([fact(1, "a", "x", 1.0)], FACTS), book(spark, [])).columns == ["sample_id"]


def test_long_texts(spark):
    found, _ = cells(spark, [fact(1, "a", "stage", None, "word " * 50_000), fact(2, "a", "size_mm", None, "9" * 5000), fact(3, "a", "x" * 100_000, 1.0)])
    assert len(found["a", "stage"]) == 249_999


def test_unknown(spark):
    facts = spark.createDataFrame([fact(1, "a", "Other-x", 1.0), fact(2, "a", "stage", None, "i")], FACTS)
    assert [tuple(r) for r in wide.unknown_attributes(facts, book(spark)).collect()] == [("other_x", 1)]
