"""Pivots of facts without a sample, and of NaN, equal their SQL."""

import math

import duckdb
import pytest

from loomspan.plans import catalog
from loomspan.plans.wide import CODEBOOK

FACTS = [("a", "dose_mg", math.nan, None), ("a", "stage", None, "II"), ("b", "dose_mg", math.nan, None), ("b", "dose_mg", 2.0, "x"), ("c", "other", 1.0, "y"), ("d", "stage", None, None)]
FACTS += [(None, "dose_mg", 1.0, None), (None, "stage", None, "III")]


@pytest.mark.parametrize("name, samples", [("q_feature_pivot", ["a", "b", "d", None]), ("q_pivots_joined", ["a", "b"])])
def test_null_samples_and_nan(spark, tmp_path, name, samples):
    names = [(f,) for fs in CODEBOOK.values() for f in fs.split()]
    db = duckdb.connect()
    for t, rows, schema in (("features", FACTS, "sample_id string, feature string, value_num double, value_txt string"), ("feature_dictionary", names, "feature string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{t}.parquet")
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    df = catalog.QUERIES[name](spark, str(tmp_path))
    result = db.sql(catalog.SQL[name])
    got, expected = ({r[0]: dict(zip(columns, r)) for r in rows} for columns, rows in ((df.columns, df.collect()), (result.columns, result.fetchall())))
    assert set(got) == set(samples) and math.isnan(got["a"]["dose_mg"]) and got["b"]["dose_mg"] == 2
    assert {k: {c: str(v) for c, v in r.items()} for k, r in got.items()} == {k: {c: str(v) for c, v in r.items()} for k, r in expected.items()}
