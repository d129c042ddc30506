"""Queries of sources, sinks, streams and the runner: what is written into the shared folder comes back as the SQL says."""

from __future__ import annotations

import gzip
import io
import os
import sqlite3
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.operators import identifiers, reports
from loomspan.plans.runner import Run, Step
from loomspan.session import cut, shared_dir, table, track
from loomspan.sources import files, sinks
from loomspan.streaming import incremental


def _folder(spark: SparkSession) -> str:
    """A new folder of the shared one, deleted when the program ends."""
    return track(spark, f"{shared_dir(spark)}/loomspan-{uuid.uuid4().hex}")


def _named(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


# Small files with the faults of real ones; their content is in the SQL as well.


def q_csv_ragged(spark: SparkSession, d: str) -> DataFrame:
    """Short lines padded, long ones cut, types found, the separator sniffed (SRC-01, SRC-07)."""
    return files.read_csv(spark, files.put(spark, f"{_folder(spark)}/r.csv", "a;b;c\n1;2.5;x\n3\n4;5;NA;6\n"))


def q_csv_latin1(spark: SparkSession, d: str) -> DataFrame:
    """A file that isn't UTF-8, with repeated and empty header names (SRC-01)."""
    return files.read_csv(spark, files.put(spark, f"{_folder(spark)}/l.tsv", "n\tn\t\ncaf\xe9\t1\tna\xefve\nplain\t2\tn/a\n".encode("latin-1")))


def q_csv_strict(spark: SparkSession, d: str) -> DataFrame:
    """All cells as text, lines with too many cells left out; missing cells as empty texts (SRC-02, SRC-03)."""
    return files.empty_as_text(files.read_csv_strict(spark, files.put(spark, f"{_folder(spark)}/s.csv", "a,b\n1,NA\n3\n4,5,6\n,x\n")))


def q_csv_comments(spark: SparkSession, d: str) -> DataFrame:
    """Comment lines before and among the rows of a segment table with tabs (SRC-04, SRC-17)."""
    return files.read_csv(spark, files.put(spark, f"{_folder(spark)}/m.seg", "#version 2\nID\tchrom\tloc.start\tseg.mean\ns1\tchr1\t100\t-0.5\n#note\ns2\tchrX\t200\t1.25\n"), sep="\t", comment="#")


def q_first_header(spark: SparkSession, d: str) -> DataFrame:
    """The first of several files whose header has the required columns (SRC-06)."""
    at = _folder(spark)
    paths = [files.put(spark, f"{at}/{n}", text) for n, text in (("a.csv", "x,y\n1,2\n"), ("b.tsv", "Hugo_Symbol\tTumor_Sample_Barcode\tz\ng\ts\t1\n"), ("c.csv", "Hugo_Symbol,Tumor_Sample_Barcode\n"))]
    found = files.first_file_with(spark, paths, ["Hugo_Symbol", "Tumor_Sample_Barcode"])
    return _named(spark, [(found.rsplit("/", 1)[-1], c) for c in files.header(spark, found)], "file string, column_name string")


def q_gct(spark: SparkSession, d: str) -> DataFrame:
    """A packed matrix file; a data line equal to its header is data (SRC-16, SRC-08)."""
    text = "#1.2\n3\t2\nName\tS1\tS2\ng1\t1\t2.5\nName\tS1\tS2\ng2\t\t4\n"
    return files.read_gct(spark, files.put(spark, f"{_folder(spark)}/m.gct.gz", gzip.compress(text.encode())))


def q_json_array(spark: SparkSession, d: str) -> DataFrame:
    """A table that is one JSON array (SRC-14)."""
    return files.read_json(spark, files.put(spark, f"{_folder(spark)}/t.json", '[{"a": 1, "b": "x"},\n {"a": 2},\n {"b": null, "a": 3}]'), lines=False)


def q_texts_cut(spark: SparkSession, d: str) -> DataFrame:
    """Whole files of a folder, cut at a number of characters (SRC-18, STR-09)."""
    at = _folder(spark)
    for name, text in (("one.txt", "first line\nsecond line"), ("deep/two.md", "ü" * 30), ("empty.txt", "")):
        files.put(spark, f"{at}/{name}", text)
    return files.read_texts(spark, at, 12).select(F.substring_index("path", "/", -1).alias("file"), "text")


def q_archive(spark: SparkSession, d: str) -> DataFrame:
    """The members of an archive, unpacked by the driver and read (SRC-26)."""
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        z.writestr("x/a.csv", "k,v\n1,one\n")
        z.writestr("b.csv", "k,v\n2,two\n")
    with tempfile.TemporaryDirectory() as scratch:
        at = os.path.join(scratch, "a.zip")
        with open(at, "wb") as f:
            f.write(packed.getvalue())
        members = {os.path.basename(p): open(p, encoding="utf-8").read() for p in files.unpacked(at, os.path.join(scratch, "out"))}
    shared = _folder(spark)
    for name, text in members.items():
        files.put(spark, f"{shared}/{name}", text)
    return files.read_csv(spark, shared)


def q_sqlite(spark: SparkSession, d: str) -> DataFrame:
    """A query of a SQLite file (SRC-25)."""
    nations = [tuple(r) for r in table(spark, d, "nation").select("n_nationkey", "n_name").collect()]
    with tempfile.TemporaryDirectory() as scratch:
        at = os.path.join(scratch, "n.db")
        with sqlite3.connect(at) as db:
            db.execute("CREATE TABLE n (k INTEGER, name TEXT)")
            db.executemany("INSERT INTO n VALUES (?, ?)", nations)
        return files.read_sqlite(spark, at, "SELECT k, upper(name) AS name FROM n WHERE k % 2 = 0")


def q_manifest(spark: SparkSession, d: str) -> DataFrame:
    """A manifest with its required columns, and a list with section headers carried down (SRC-31)."""
    at = _folder(spark)
    table_ = files.manifest(spark, files.put(spark, f"{at}/m.csv", "source_url,destination_folder,priority\nhttps://a.org/x.csv,raw,1\nftp://b.org/y.gz,,2\n"), ["source_url", "destination_folder"])
    files.put(spark, f"{at}/list/l.txt", "https://none.org\n# [ONE]\nhttps://c.org\n\n# comment\n# [TWO]\nhttps://d.org\nhttps://e.org\n")
    listed = files.sectioned_lines(files.read_texts(spark, f"{at}/list"), "path", "text")
    return table_.select(F.col("source_url").alias("url"), F.coalesce("destination_folder", F.lit("(none)")).alias("section")).unionByName(listed.select(F.col("line").alias("url"), "section"))


def q_discovered(spark: SparkSession, d: str) -> DataFrame:
    """Files by extension and path patterns, side-car files left out, largest first (SRC-22, SRC-23, FLT-14)."""
    at = _folder(spark)
    for name, size in (("a.csv", 10), ("sub/b.CSV", 30), ("sub/c.tsv", 20), ("sub/._b.csv", 5), ("d.txt", 7), ("scratch/e.csv", 9)):
        files.put(spark, f"{at}/{name}", "x" * size)
    found = files.discovered(files.inventory(spark, at), ["csv", ".tsv"], exclude=["*/scratch/*", "*/.[_]*"], order="size_desc", most=3)
    return found.select("name", "extension", "bytes")


# Whole test tables, written and read again.


def q_csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """A table as packed text with tabs, read forgivingly, some of its columns only (SRC-01, SRC-05, SRC-08, SNK-02)."""
    at = _folder(spark)
    sinks.write_csv(table(spark, d, "part"), at, codec="gzip", sep="\t")
    return files.read_csv(spark, at, sep="\t", columns=["p_partkey", "p_name", "p_size", "p_retailprice"])


def q_written_both(spark: SparkSession, d: str) -> DataFrame:
    """Parquet with its list as it is, and CSV with the list joined (SNK-02, SNK-04)."""
    at = _folder(spark)
    terms = table(spark, d, "canonical_terms").select("canonical_id", F.split("canonical", " ").alias("words"))
    sinks.write_both(terms, at)
    flat = files.read_csv(spark, f"{at}/csv").select("canonical_id", F.col("words").alias("joined"))
    return spark.read.parquet(f"{at}/parquet").join(flat, "canonical_id").select("canonical_id", F.size("words").alias("n_words"), "joined")


def q_json_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """JSON lines in folders by event type (SNK-06, SRC-14)."""
    at = _folder(spark)
    sinks.write_json(table(spark, d, "events").select("event_id", "user_id", "event_type", "value"), at, ["event_type"])
    return files.read_json(spark, at).select("event_id", "user_id", "event_type", F.col("value").cast("double").alias("value"))


def q_json_leaves(spark: SparkSession, d: str) -> DataFrame:
    """Every string of free JSON of three characters or more (SRC-15)."""
    rows = table(spark, d, "canonical_terms").select("canonical_id", F.to_json(F.struct(F.col("canonical").alias("name"), F.array("short_form", F.lit("ab")).alias("forms"), F.struct("entity").alias("more"))).alias("j"))
    return files.json_strings(rows, "j").select("canonical_id", "leaf")


def q_parquet_parts(spark: SparkSession, d: str) -> DataFrame:
    """Parquet in folders by flag, in files of at most 500 rows; read back whole (SNK-01, SNK-05, SNK-09, SNK-12)."""
    at = _folder(spark)
    sinks.write_parquet(table(spark, d, "lineitem"), at, ["l_returnflag"], rows_per_file=500, codec="snappy")
    back = spark.read.parquet(at).withColumn("_f", F.input_file_name())
    sizes = back.groupBy("l_returnflag", "_f").agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("s"))
    return sizes.groupBy("l_returnflag").agg(F.sum("n").alias("n_rows"), F.sum("s").alias("lines"), (F.max("n") <= 500).alias("within"))


def q_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """A saved table bucketed by its key, aggregated from its buckets (SNK-07)."""
    name = f"loomspan_{uuid.uuid4().hex}"
    sinks.write_bucketed(table(spark, d, "orders"), name, "o_custkey", 4, _folder(spark))
    return spark.table(name).groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def q_graph_files(spark: SparkSession, d: str) -> DataFrame:
    """A graph as a pair of tables with the headers of graph importers, read back and joined (SNK-08)."""
    at = _folder(spark)
    nodes = reports.graph_nodes([(table(spark, d, "nation"), "n_nationkey", "n_name", "nation"), (table(spark, d, "region"), "r_regionkey", "r_name", "region")])
    sinks.write_graph(nodes, reports.graph_edges([(table(spark, d, "nation"), "n_nationkey", "nation", "n_regionkey", "region", "IN")], nodes), at)
    names = files.read_csv(spark, f"{at}/nodes").toDF("id", "label", "kind").select("id", "label")
    edges = files.read_csv(spark, f"{at}/edges").toDF("src", "dst", "type", "weight")
    src, dst = names.toDF("src", "src_label"), names.toDF("dst", "dst_label")
    return edges.join(src, "src").join(dst, "dst").select("src_label", "type", "dst_label", F.col("weight").cast("double").alias("weight"))


def q_report_lines(spark: SparkSession, d: str) -> DataFrame:
    """A small table as the lines of a Markdown report (SNK-10)."""
    text = sinks.report(table(spark, d, "region").select("r_regionkey", "r_name").orderBy("r_regionkey"), "Regions")
    return _named(spark, [(i, line) for i, line in enumerate(text.splitlines())], "line_no int, line string")


def q_bars(spark: SparkSession, d: str) -> DataFrame:
    """The bars of a chart of the largest nations, by their place and width (SNK-11)."""
    counts = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "c_nationkey").limit(10)
    svg = sinks.bar_chart(counts, "c_nationkey", "n", "Customers by nation")
    bars = spark.createDataFrame([(svg,)], "svg string").select(F.explode(F.regexp_extract_all("svg", F.lit('(<rect [^>]*data-label="[^"]*"[^>]*>)'), F.lit(1))).alias("bar"))
    return bars.select(F.regexp_extract("bar", 'data-label="([^"]*)"', 1).alias("label"), F.regexp_extract("bar", ' y="([0-9]+)"', 1).cast("int").alias("y"), F.regexp_extract("bar", ' width="([0-9.]+)"', 1).cast("double").alias("width"))


def q_treemap(spark: SparkSession, d: str) -> DataFrame:
    """The areas of a treemap: each in proportion to its value, together the whole (SNK-11)."""
    sizes = table(spark, d, "part").groupBy("p_type").agg(F.count("*").alias("n"))
    svg = sinks.treemap(sizes, "p_type", "n", "Parts by type", 1000, 600)
    tiles = spark.createDataFrame([(svg,)], "svg string").select(F.explode(F.regexp_extract_all("svg", F.lit('(<rect [^>]*data-label="[^"]*"[^>]*>)'), F.lit(1))).alias("t"))
    side = lambda name: F.regexp_extract("t", f' {name}="([0-9.]+)"', 1).cast("double")
    return tiles.select(F.regexp_extract("t", 'data-label="([^"]*)"', 1).alias("label"), F.round(side("width") * side("height") / 600000 * table(spark, d, "part").count()).cast("bigint").alias("n"))


def q_fetch_plan(spark: SparkSession, d: str) -> DataFrame:
    """What a manifest still has to fetch, and how, beside what is there (SRC-27, SRC-28, JN-18)."""
    at = _folder(spark)
    for name, size in (("x.csv", 10), ("y.gz.part", 4), ("w.csv", 3)):
        files.put(spark, f"{at}/{name}", "x" * size)
    wanted = spark.createDataFrame([("https://a.org/x.csv", 10), ("ftp://b.org/y.gz", 9), ("file:///data/z.csv", None), ("https://a.org/w.csv", 5), ("gopher://old", None), (None, 1)], "url string, size bigint")
    return files.fetch_plan(wanted, "url", "size", files.inventory(spark, at)).select("url", "way", "action", "have")


def q_reached(spark: SparkSession, d: str) -> DataFrame:
    """What a crawl from some places reaches within three steps, and after how many (GR-07, SRC-29)."""
    n = table(spark, d, "orders").count()
    links = table(spark, d, "orders").select(F.concat(F.lit("p"), F.col("o_orderkey")).alias("src"), F.explode(F.array((F.col("o_orderkey") * 3 + 1) % n, (F.col("o_orderkey") * 7 + 2) % n)).alias("k")).select("src", F.concat(F.lit("p"), F.col("k")).alias("dst"))
    return identifiers.reached(links, spark.createDataFrame([("p0",), ("p5",), ("p5",), (None,)], "src string"), 3)


def q_failures(spark: SparkSession, d: str) -> DataFrame:
    """Lines of a log that tell of a failure, with the first address in them (SRC-32, FLT-11)."""
    at = _folder(spark)
    host = F.concat(F.lit("https://h.org/"), F.col("event_id").cast("string"), F.lit(".csv"))
    line = F.when(F.col("event_type") == "click", F.concat(F.lit("ERROR 404 at "), host, F.lit(", see https://x.org"))).when(F.col("event_type") == "view", F.concat(F.lit("read "), host)).otherwise("Timeout")
    table(spark, d, "events").select(line.alias("value")).write.text(at)
    return files.failures(spark.read.text(at), "value").groupBy("url").agg(F.count("*").alias("n"))


def q_footer_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows and columns of the data's Parquet files from their footers, and a broken file beside them (SRC-11)."""
    at = _folder(spark)
    for name in ("region", "nation", "supplier", "customer", "orders"):
        sinks.write_parquet(table(spark, d, name).coalesce(1).withColumn("name", F.lit(name)), f"{at}/t", ["name"], mode="append")
    files.put(spark, f"{at}/t/name=broken/x.parquet", "no")
    foot = files.footers(files.inventory(spark, f"{at}/t", "*.parquet"), "path")
    return foot.select(F.regexp_extract("path", "name=([a-z]+)/", 1).alias("name"), "n_columns", "n_rows", F.col("error").isNotNull().alias("broken"), (F.col("raw_bytes") > 0).alias("sized"))


def q_unsafe_written(spark: SparkSession, d: str) -> DataFrame:
    """Files that are unreadable, too wide or too dense, by their footers (RPT-06, RPT-07, FLT-10, ORC-07)."""
    at = _folder(spark)
    sinks.write_parquet(table(spark, d, "region").coalesce(1), f"{at}/fine")
    sinks.write_parquet(table(spark, d, "part").coalesce(1), f"{at}/wide")
    sinks.write_parquet(spark.range(0, 3_000_000, 1, 1).select(F.lit(1).alias("x")), f"{at}/dense")
    files.put(spark, f"{at}/broken/x.parquet", "PAR1")
    foot = files.footers(files.inventory(spark, at, "*.parquet"), "path")
    sized = files.expansion(foot).select("path", (F.col("raw_mb") > 0).alias("sized"))
    return reports.unsafe_files(foot, most_columns=5).join(sized, "path", "left").select(F.element_at(F.split("path", "/"), -2).alias("folder"), "reason", "sized")


def q_repository_written(spark: SparkSession, d: str) -> DataFrame:
    """An inventory by extension (RPT-11, SRC-22)."""
    at = _folder(spark)
    for name, size in (("a.csv", 10), ("b/c.CSV", 30), ("d.txt", 7), ("none", 4)):
        files.put(spark, f"{at}/{name}", "x" * size)
    return reports.repository_summary(files.inventory(spark, at))


# Work in portions.


def q_stream_appended(spark: SparkSession, d: str) -> DataFrame:
    """New files appended exactly once, one file a portion, over two runs with one checkpoint (STM-01 to STM-03, STM-05)."""
    at, events = _folder(spark), table(spark, d, "events").select("event_id", "user_id", "event_type")
    for half in (0, 1):
        events.filter(F.pmod("event_id", F.lit(2)) == half).repartition(2).write.mode("append").parquet(f"{at}/in")
        incremental.append_new(incremental.new_files(spark, f"{at}/in", events.schema, most_files=1), f"{at}/out", f"{at}/checkpoint")
    return spark.read.parquet(f"{at}/out")


def q_stream_components(spark: SparkSession, d: str) -> DataFrame:
    """Components kept up to date with links that come in two portions (STM-04)."""
    at = _folder(spark)
    links = table(spark, d, "orders").select(F.concat(F.lit("c"), F.col("o_custkey") % 97).alias("src"), F.concat(F.lit("d"), F.col("o_orderkey") % 1009).alias("dst"), "o_orderkey")
    schema = links.select("src", "dst").schema
    for half in (0, 1):
        links.filter(F.pmod("o_orderkey", F.lit(2)) == half).select("src", "dst").write.mode("append").parquet(f"{at}/in")
        incremental.grow_components(incremental.new_files(spark, f"{at}/in", schema), identifiers.connected, f"{at}/state", f"{at}/checkpoint")
    return incremental.latest_state(spark, f"{at}/state")


def q_stream_windows(spark: SparkSession, d: str) -> DataFrame:
    """Events counted by hour and type in a stream over files (STM-01)."""
    at, events = _folder(spark), table(spark, d, "events").select("ts", "event_type", "value")
    cut(events).repartition(3).write.parquet(f"{at}/in")
    name = f"windows_{uuid.uuid4().hex}"
    counts = incremental.windowed_counts(incremental.new_files(spark, f"{at}/in", events.schema), "ts", "event_type")

    def keep(portion: DataFrame, _: int) -> None:
        portion.write.mode("overwrite").parquet(f"{at}/{name}")

    counts.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{at}/{name}")


def q_until_settled(spark: SparkSession, d: str) -> DataFrame:
    """A step repeated until it gains less than a fiftieth, at most three times (STM-07): links added by order of magnitude."""
    orders = table(spark, d, "orders")
    counts = incremental.until_settled(lambda i: orders.filter(F.col("o_orderkey") < F.lit(10) ** (2 + 4 * i)).count())
    return _named(spark, list(enumerate(counts)), "turn int, n bigint")


def q_run_steps(spark: SparkSession, d: str) -> DataFrame:
    """Steps run, found there in a second run, and made again once what they read is newer (ORC-01 to ORC-06, RPT-13)."""
    at = _folder(spark)
    steps = [
        Step("orders", lambda _: table(spark, d, "orders")),
        Step("per_customer", lambda made: made["orders"].groupBy("o_custkey").count(), ["orders"], tries=2),
        Step("report", lambda made: made["per_customer"].agg(F.count("*").alias("n")), ["per_customer"]),
    ]
    rows = [(1, r["step"], r["state"]) for r in Run(spark, at, steps).go()]
    rows += [(2, r["step"], r["state"]) for r in Run(spark, at, steps).go()]
    table(spark, d, "orders").limit(0).write.mode("overwrite").parquet(f"{at}/orders")
    rows += [(3, r["step"], r["state"]) for r in Run(spark, at, steps).go(begin="per_customer")]
    return _named(spark, rows, "run int, step string, state string")


def q_step_states(spark: SparkSession, d: str) -> DataFrame:
    """The states of a run's steps by what lies in its folder (RPT-13)."""
    at = _folder(spark)
    table(spark, d, "region").write.parquet(f"{at}/read")
    files.put(spark, f"{at}/cleaned/part-0.parquet", "cut short")
    return reports.steps_of_folder(spark, at, ["read", "cleaned", "linked"])


QUERIES = {n: f for n, f in list(globals().items()) if n.startswith("q_")}


def _values(columns: str, *rows: str) -> str:
    return f"SELECT * FROM (VALUES {', '.join(f'({r})' for r in rows)}) AS v({columns})"


_LINKED = """
WITH RECURSIVE e AS (SELECT DISTINCT 'c' || o_custkey % 97 AS a, 'd' || o_orderkey % 1009 AS b FROM orders), pairs AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT a AS node, a AS root FROM pairs UNION SELECT pairs.b, reach.root FROM reach JOIN pairs ON pairs.a = reach.node)
SELECT node, min(root) AS root FROM reach GROUP BY node"""

SQL = {
    "q_csv_ragged": _values("a, b, c", "1::BIGINT, 2.5::DOUBLE, 'x'", "3, NULL, NULL", "4, 5, NULL"),
    "q_csv_latin1": _values("n, n_1, col_2", "'café', 1::BIGINT, 'naïve'", "'plain', 2, NULL"),
    "q_csv_strict": _values("a, b", "'1', 'NA'", "'3', ''", "'', 'x'"),
    "q_csv_comments": _values('"ID", chrom, "loc.start", "seg.mean"', "'s1', 'chr1', 100::BIGINT, -0.5::DOUBLE", "'s2', 'chrX', 200, 1.25"),
    "q_first_header": _values("file, column_name", "'b.tsv', 'Hugo_Symbol'", "'b.tsv', 'Tumor_Sample_Barcode'", "'b.tsv', 'z'"),
    "q_gct": _values('"Name", "S1", "S2"', "'g1', '1', '2.5'", "'Name', 'S1', 'S2'", "'g2', '', '4'"),
    "q_json_array": _values("a, b", "1::BIGINT, 'x'", "2, NULL", "3, NULL"),
    "q_texts_cut": _values("file, text", "'one.txt', 'first line' || chr(10) || 's'", "'two.md', repeat('ü', 12)"),
    "q_archive": _values("k, v", "1::BIGINT, 'one'", "2, 'two'"),
    "q_sqlite": "SELECT CAST(n_nationkey AS BIGINT) AS k, upper(n_name) AS name FROM nation WHERE n_nationkey % 2 = 0",
    "q_manifest": _values("url, section", "'https://a.org/x.csv', 'raw'", "'ftp://b.org/y.gz', '(none)'", "'https://none.org', 'UNKNOWN'", "'https://c.org', 'ONE'", "'https://d.org', 'TWO'", "'https://e.org', 'TWO'"),
    "q_discovered": _values("name, extension, bytes", "'b.CSV', 'csv', 30::BIGINT", "'c.tsv', 'tsv', 20", "'a.csv', 'csv', 10"),
    "q_csv_round_trip": "SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part",
    "q_written_both": "SELECT canonical_id, CAST(len(string_split(canonical, ' ')) AS INTEGER) AS n_words, replace(canonical, ' ', '|') AS joined FROM canonical_terms",
    "q_json_round_trip": "SELECT event_id, user_id, event_type, value FROM events",
    "q_json_leaves": "SELECT canonical_id, leaf FROM (SELECT canonical_id, unnest([canonical, short_form, entity]) AS leaf FROM canonical_terms) WHERE length(leaf) >= 3",
    "q_parquet_parts": "SELECT l_returnflag, count(*) AS n_rows, CAST(sum(l_linenumber) AS BIGINT) AS lines, true AS within FROM lineitem GROUP BY l_returnflag",
    "q_bucketed": "SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey",
    "q_graph_files": "SELECT n_name AS src_label, 'IN' AS type, r_name AS dst_label, 1.0::DOUBLE AS weight FROM nation JOIN region ON n_regionkey = r_regionkey",
    "q_report_lines": """
SELECT CAST(row_number() OVER (ORDER BY o) - 1 AS INTEGER) AS line_no, line FROM (
    SELECT -4 AS o, '# Regions' AS line UNION ALL SELECT -3, '' UNION ALL SELECT -2, '| r_regionkey | r_name |' UNION ALL SELECT -1, '| --- | --- |'
    UNION ALL SELECT r_regionkey, '| ' || r_regionkey || ' | ' || r_name || ' |' FROM region)""",
    "q_failures": """
WITH l AS (SELECT CASE event_type WHEN 'click' THEN 'ERROR 404 at https://h.org/' || event_id || '.csv, see https://x.org' WHEN 'view' THEN 'read https://h.org/' || event_id || '.csv' ELSE 'Timeout' END AS line FROM events)
SELECT nullif(regexp_extract(line, 'https://[^ ,]+'), '') AS url, count(*) AS n FROM l WHERE regexp_matches(lower(line), 'error|fail|timeout|404|403') GROUP BY 1""",
    "q_bars": """
WITH c AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1 ORDER BY n DESC, c_nationkey LIMIT 10)
SELECT CAST(c_nationkey AS VARCHAR) AS label, CAST(40 + 24 * (row_number() OVER (ORDER BY n DESC, CAST(c_nationkey AS VARCHAR)) - 1) AS INTEGER) AS y, round(600.0 * n / max(n) OVER (), 1)::DOUBLE AS width FROM c""",
    "q_treemap": "SELECT p_type AS label, count(*) AS n FROM part GROUP BY p_type",
    "q_fetch_plan": _values("url, way, action, have", "'https://a.org/x.csv', 'http', 'skip', 10::BIGINT", "'ftp://b.org/y.gz', 'ftp', 'resume', 4", "'file:///data/z.csv', 'copy', 'fetch', 0", "'https://a.org/w.csv', 'http', 'fetch', 3", "'gopher://old', 'unknown', 'refuse', 0"),
    "q_reached": """
WITH RECURSIVE n AS (SELECT count(*) AS n FROM orders), l AS (SELECT 'p' || o_orderkey AS src, 'p' || unnest([(o_orderkey * 3 + 1) % n, (o_orderkey * 7 + 2) % n]) AS dst FROM orders, n),
r AS (SELECT 'p0' AS node, 0 AS depth UNION SELECT 'p5', 0 UNION SELECT dst, depth + 1 FROM r JOIN l ON src = node WHERE depth < 3)
SELECT node, CAST(min(depth) AS INTEGER) AS depth FROM r GROUP BY node""",
    "q_footer_counts": """
SELECT 'region' AS name, 2::BIGINT AS n_columns, count(*) AS n_rows, false AS broken, true AS sized FROM region UNION ALL SELECT 'nation', 3, count(*), false, true FROM nation
UNION ALL SELECT 'supplier', 4, count(*), false, true FROM supplier UNION ALL SELECT 'customer', 5, count(*), false, true FROM customer UNION ALL SELECT 'orders', 6, count(*), false, true FROM orders
UNION ALL SELECT 'broken', NULL, NULL, true, NULL""",
    "q_unsafe_written": _values("folder, reason, sized", "'wide', 'width', true", "'dense', 'density', true", "'broken', 'unreadable', NULL"),
    "q_repository_written": _values("extension, n_files, bytes, largest", "'csv', 2::BIGINT, 40::BIGINT, 30::BIGINT", "'txt', 1, 7, 7", "'', 1, 4, 4"),
    "q_stream_appended": "SELECT event_id, user_id, event_type FROM events",
    "q_stream_components": _LINKED,
    "q_stream_windows": "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2",
    "q_until_settled": "SELECT 0 AS turn, (SELECT count(*) FROM orders WHERE o_orderkey < 100) AS n UNION ALL SELECT 1, count(*) FROM orders WHERE o_orderkey < 1000000 UNION ALL SELECT 2, count(*) FROM orders WHERE o_orderkey < 10000000000",
    "q_run_steps": _values("run, step, state", *[f"1, '{s}', 'made'" for s in ("orders", "per_customer", "report")], *[f"2, '{s}', 'there'" for s in ("orders", "per_customer", "report")], *[f"3, '{s}', 'made'" for s in ("per_customer", "report")]),
    "q_step_states": _values("step, state", "'read', 'complete'", "'cleaned', 'incomplete'", "'linked', 'missing'"),
}
