"""Queries of coverage, gaps, files and models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.operators import reports, text
from loomspan.session import table
from loomspan.sources import files


def q_coverage(spark: SparkSession, d: str) -> DataFrame:
    """All canonical terms; the terms of the atlas files stand for what was found."""
    terms = table(spark, d, "structured_vocab_raw").filter("trim(canonical) <> ''").select(F.col("canonical").alias("term"), F.coalesce("term_type", F.lit("none")).alias("domain"))
    found = table(spark, d, "structured_vocab_raw").filter("source_file like '%atlas%'")
    return reports.coverage(terms, "term", "domain", found, "term")


def q_linkage(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "structured_vocab_raw").select("source_file", F.coalesce("term_type", F.lit("none")).alias("term_type"))
    return reports.linkage(rows, "source_file", "term_type", "nanoparticle", ["gene", "drug", "pathway"])


def q_gap_report(spark: SparkSession, d: str) -> DataFrame:
    names = [r["feature"] for r in table(spark, d, "feature_dictionary").select("feature").collect()]
    shell = spark.createDataFrame([], ", ".join(f"`{n}` string" for n in names))
    return reports.required_features(shell, {"nano": reports.REQUIRED_NANO, "genomic": reports.REQUIRED_GENOMIC}).drop("query")


def q_vocabulary_gaps(spark: SparkSession, d: str) -> DataFrame:
    counts = text.tokens(table(spark, d, "documents"), "doc_id", "text").groupBy(F.col("token").alias("term")).agg(F.count("*").alias("n"))
    structured = table(spark, d, "structured_vocab_raw").filter("term is not null").groupBy("term").agg(F.count("*").alias("n"))
    return reports.vocabulary_gaps(counts, structured, table(spark, d, "vocabulary"), "term")


def q_regression_line(spark: SparkSession, d: str) -> DataFrame:
    return reports.fitted_line(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice")


def q_boosted_regression(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return reports.boosted_regression(rows, "o_orderkey", "o_totalprice", ["c_acctbal", "c_nationkey"], ["o_orderpriority", "c_mktsegment"], rounds=5)


def q_boosted_fit(spark: SparkSession, d: str) -> DataFrame:
    """Trees that must explain a line's revenue by its price and discount; split by id, measured on the held-out part (ML-01)."""
    rows = table(spark, d, "lineitem").withColumns({"line_id": F.col("l_orderkey") * 8 + F.col("l_linenumber"), "revenue": F.col("l_extendedprice") * (1 - F.col("l_discount"))})
    made = reports.boosted_regression(rows, "line_id", "revenue", ["l_extendedprice", "l_discount", "l_tax"], ["l_returnflag"], rounds=8)
    return made.select("n_train", "n_test", (F.col("r2") > 0.9).alias("fits"), (F.col("mse") > 0).alias("has_error"))


def q_footers(spark: SparkSession, d: str) -> DataFrame:
    paths = files.inventory(spark, d, "*.parquet")
    return files.expansion(files.footers(paths, "path"))


def q_unsafe_files(spark: SparkSession, d: str) -> DataFrame:
    return reports.unsafe_files(files.footers(files.inventory(spark, d, "*.parquet"), "path"), most_columns=10)


def q_repository_summary(spark: SparkSession, d: str) -> DataFrame:
    return reports.repository_summary(files.inventory(spark, d))


def q_manifest_dropped(spark: SparkSession, d: str) -> DataFrame:
    """All source files as the manifest; those with an unassigned patient stand for the files that are there."""
    wanted = table(spark, d, "id_map").select("source_file").filter("source_file is not null").distinct()
    return reports.dropped_manifest(wanted, "source_file", table(spark, d, "id_map").filter("master_patient_id = 'UNASSIGNED'"), "source_file")


def q_json_values(spark: SparkSession, d: str) -> DataFrame:
    from loomspan.functions.strings import json_field

    return table(spark, d, "events").select("event_id", json_field(F.col("props"), "$.k").cast("bigint").alias("k"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), F.datediff(F.lit("2024-12-31").cast("date"), "ts").alias("age_days"))


QUERIES = {n: f for n, f in list(globals().items()) if n.startswith("q_")}

_GUESS = r"""CASE WHEN contains(lower(term), ' pathway') OR contains(lower(term), ' signaling') OR contains(lower(term), 'signalling') OR starts_with(lower(term), 'pi3k') THEN 'pathway'
WHEN regexp_matches(lower(term), ' carcinoma| cancer| tumor| tumour| neoplasm| syndrome') THEN 'disease' WHEN regexp_matches(lower(term), ' inhibitor| antibody| drug| therapeutic| therapy') THEN 'drug'
WHEN regexp_full_match(term, '[A-Z0-9-]{1,6}') AND regexp_matches(term, '[A-Z]') THEN 'gene' ELSE 'unknown' END"""

SQL = {
    "q_coverage": """
WITH t AS (SELECT DISTINCT lower(canonical) AS t, coalesce(term_type, 'none') AS domain FROM structured_vocab_raw WHERE trim(canonical, ' ') <> ''), f AS (SELECT DISTINCT lower(term) AS v FROM structured_vocab_raw WHERE source_file LIKE '%atlas%' AND term IS NOT NULL)
SELECT domain, count(*) AS n_terms, count(v) AS n_found, round(count(v) / count(*), 6) AS share FROM t LEFT JOIN f ON t = v GROUP BY domain""",
    "q_linkage": """
WITH f AS (SELECT source_file, coalesce(bool_or(term_type = 'nanoparticle'), false) AS a, coalesce(bool_or(term_type = 'gene'), false) AS g, coalesce(bool_or(term_type = 'drug'), false) AS dr, coalesce(bool_or(term_type = 'pathway'), false) AS p FROM structured_vocab_raw GROUP BY 1)
SELECT count(*) AS n_nanoparticle, count(*) FILTER (g) AS with_gene, count(*) FILTER (dr) AS with_drug, count(*) FILTER (p) AS with_pathway FROM f WHERE a""",
    "q_gap_report": "SELECT kind, feature, lower(feature) IN (SELECT lower(feature) FROM feature_dictionary) AS present FROM (VALUES "
    + ", ".join(f"('{k}', '{f}')" for k, fs in (("nano", reports.REQUIRED_NANO), ("genomic", reports.REQUIRED_GENOMIC)) for f in fs)
    + ") AS r(kind, feature)",
    "q_vocabulary_gaps": f"""
WITH u AS (SELECT lower(t) AS term, count(*) AS n, 'unstructured' AS s FROM (SELECT unnest(regexp_extract_all(text, '({text.TOKEN})', 1)) AS t FROM documents) GROUP BY 1),
s AS (SELECT term, count(*) AS n, 'structured' AS s FROM structured_vocab_raw WHERE term IS NOT NULL GROUP BY 1),
g AS (SELECT lower(term) AS candidate, {_GUESS} AS suggested_type, n, s FROM (SELECT * FROM u UNION ALL SELECT * FROM s))
SELECT candidate, suggested_type, CAST(sum(n) AS BIGINT) AS total_count, string_agg(DISTINCT s, '|' ORDER BY s) AS sources FROM g WHERE candidate NOT IN (SELECT lower(term) FROM vocabulary WHERE term IS NOT NULL) GROUP BY 1, 2""",
    "q_regression_line": """
SELECT CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem""",
    "q_boosted_fit": "SELECT count(*) FILTER (b >= 20) AS n_train, count(*) FILTER (b < 20) AS n_test, true AS fits, true AS has_error FROM (SELECT ((l_orderkey * 8 + l_linenumber) * 7919 + 104729) % 100 AS b FROM lineitem)",
    "q_manifest_dropped": "SELECT DISTINCT source_file FROM id_map WHERE source_file IS NOT NULL AND source_file NOT IN (SELECT source_file FROM id_map WHERE master_patient_id = 'UNASSIGNED' AND source_file IS NOT NULL)",
    "q_json_values": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, CAST(date_diff('day', CAST(ts AS DATE), DATE '2024-12-31') AS INTEGER) AS age_days FROM events",
}
