import datetime as dt
import zipfile

import pytest
from pyspark.sql import functions as F

from loomspan.operators import identifiers
from loomspan.plans.runner import Run, Step
from loomspan.sources import files, sinks
from loomspan.streaming import incremental


def put(path, content):
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_ragged(spark, tmp_path):
    p = put(tmp_path / "r.csv", "a,b\n1,2\n3\n4,5,6\n")
    assert rows(files.read_csv(spark, p)) == [(1, 2), (3, None), (4, 5)]
    assert rows(files.read_csv_strict(spark, p)) == [("1", "2"), ("3", None)]


def test_latin1_and_headers(spark, tmp_path):
    assert rows(files.read_csv(spark, put(tmp_path / "l.csv", b"n,v\ncaf\xe9,NA\n"))) == [("café", None)]
    df = files.read_csv(spark, put(tmp_path / "d.tsv", "a\ta\t\n1\t2.5\tx\n"))
    assert df.columns == ["a", "a_1", "col_2"] and rows(df) == [(1, 2.5, "x")]
    assert rows(files.read_csv(spark, put(tmp_path / "c.csv", "#note\na,b\n1,x\n"), comment="#")) == [(1, "x")]


def test_other_formats(spark, tmp_path):
    g = put(tmp_path / "m.gct", "#1.2\n1\t2\nName\tS1\tS2\ng1\t1\t2\n")
    assert rows(files.read_gct(spark, g)) == [("g1", "1", "2")]
    c = put(tmp_path / "case.txt", "cancer_study_identifier: st\ncase_list_name: All\ncase_list_ids: A\tB C\n")
    assert rows(files.case_lists(files.read_texts(spark, c), "path", "text")) == [("st", "All", "A"), ("st", "All", "B"), ("st", "All", "C")]
    j = spark.createDataFrame([('{"a": {"b": "hello", "c": ["xyz", 1]}}',), ("no json",), (None,)], "t string")
    assert sorted(r["leaf"] for r in files.json_strings(j, "t").collect()) == ["hello", "xyz"]
    lines = spark.createDataFrame([("f", "# [ONE]\nhttp://a\n\n# [TWO]\nhttp://b")], "p string, t string")
    assert [(r["section"], r["line"]) for r in files.sectioned_lines(lines, "p", "t").orderBy("line_no").collect()] == [("ONE", "http://a"), ("TWO", "http://b")]
    z = str(tmp_path / "a.zip")
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("x/y.txt", "1")
    assert [p.rsplit("/", 2)[-2:] for p in files.unpacked(z, str(tmp_path / "out"))] == [["x", "y.txt"]]
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("../evil.txt", "1")
    with pytest.raises(ValueError, match="leads out"):
        files.unpacked(z, str(tmp_path / "out2"))


def test_inventory_and_footers(spark, tmp_path):
    sinks.write_parquet(spark.range(10).withColumn("s", F.lit("x")), str(tmp_path / "t"))
    put(tmp_path / "broken.parquet", "no")
    found = files.inventory(spark, str(tmp_path), "*.parquet")
    foot = {r["path"].rsplit("/", 1)[-1]: r for r in files.footers(found, "path").collect()}
    assert foot["broken.parquet"]["error"] and sum(r["n_rows"] or 0 for r in foot.values()) == 10
    names = [r["name"] for r in files.discovered(found, ["parquet"], exclude=["*broken*"], order="size_desc").collect()]
    assert names and "broken.parquet" not in names


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], {"k": "v"}), (2, [], None)], "i int, l array<string>, m map<string,string>")
    sinks.write_both(df, str(tmp_path / "both"))
    assert rows(spark.read.option("header", True).csv(str(tmp_path / "both/csv")).select("i", "l"))[0] == ("1", "a|b")
    sinks.write_parquet(df.limit(0), str(tmp_path / "none"))
    assert spark.read.parquet(str(tmp_path / "none")).columns == df.columns
    assert "| 1 |" in sinks.report(df.select("i"), "T")


def test_incremental(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    schema = spark.createDataFrame([], "src string, dst string").schema
    for n, edges in enumerate([[("a", "b"), ("c", "d")], [("b", "c")], [("x", "y")]]):
        spark.createDataFrame(edges, schema).write.mode("append").parquet(src)
        incremental.append_new(incremental.new_files(spark, src, schema), out, str(tmp_path / "ck1"))
        incremental.grow_components(incremental.new_files(spark, src, schema), identifiers.connected, state, str(tmp_path / "ck2"))
        assert spark.read.parquet(out).count() == sum([2, 1, 1][: n + 1])
    assert {r["node"]: r["root"] for r in incremental.latest_state(spark, state).collect()} == {"a": "a", "b": "a", "c": "a", "d": "a", "x": "x", "y": "x"}
    assert incremental.until_settled(lambda i: [100, 101, 300][i]) == [100, 101]


def test_stream_equals_batch(spark, tmp_path):
    events = spark.createDataFrame([(dt.datetime(2024, 1, 1, h, m), "u", "click", 1.0) for h in range(3) for m in (0, 10)], "ts timestamp, user_id string, event_type string, value double")
    events.write.parquet(str(tmp_path / "ev"))
    stream = incremental.new_files(spark, str(tmp_path / "ev"), events.schema)
    query = incremental.windowed_counts(stream, "ts", "event_type").writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows(spark.table("w")) == rows(incremental.windowed_counts(events, "ts", "event_type"))


def test_runner(spark, tmp_path):
    made = []

    def build(name):
        def f(inputs):
            made.append(name)
            return spark.range(3) if not inputs else list(inputs.values())[0].filter("id > 0")

        return f

    steps = [Step("one", build("one")), Step("two", build("two"), ["one"])]
    Run(spark, str(tmp_path), steps).go()
    report = Run(spark, str(tmp_path), steps).go()
    assert made == ["one", "two"] and [r["state"] for r in report] == ["there", "there"]
    with pytest.raises(ValueError, match="no earlier step"):
        Run(spark, str(tmp_path), steps[::-1]).go()
    with pytest.raises(RuntimeError, match="three failed"):
        Run(spark, str(tmp_path), [Step("three", lambda i: 1 / 0)]).go()
