"""Queries of projections, filters and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.functions import urls
from loomspan.operators import aggregates, identifiers, joins, shape
from loomspan.plans.wide import CODEBOOK
from loomspan.session import table


def q_folder_summary(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n_files"), F.sum("n_chars").alias("n_chars"))


def q_top_parts(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.top_values(table(spark, d, "lineitem"), "l_partkey", 150)


def q_occurrence_matrix(spark: SparkSession, d: str) -> DataFrame:
    return shape.occurrence_matrix(table(spark, d, "orders"), "o_custkey", "o_orderstatus", ["F", "O", "P"])


def _store(spark: SparkSession, d: str) -> DataFrame:
    parts = [shape.melted_by_type(table(spark, d, name), key, name) for name, key in (("customer", "c_custkey"), ("supplier", "s_suppkey"), ("part", "p_partkey"))]
    return joins.united(parts)


def q_feature_melt(spark: SparkSession, d: str) -> DataFrame:
    return _store(spark, d)


def q_feature_prevalence(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.feature_prevalence(table(spark, d, "features"))


def q_feature_pivot(spark: SparkSession, d: str) -> DataFrame:
    names = shape.distinct_values(table(spark, d, "feature_dictionary"), "feature")
    facts = joins.members(table(spark, d, "features"), "feature", table(spark, d, "feature_dictionary"), "feature")
    return shape.pivoted(facts, ["sample_id"], value="value_num", features=names)


def q_pivots_joined(spark: SparkSession, d: str) -> DataFrame:
    """Numbers and texts of a feature store, each pivoted, side by side by sample; facts without one have no row (JN-07, PRJ-14)."""
    names = shape.distinct_values(table(spark, d, "feature_dictionary"), "feature")
    facts = joins.members(table(spark, d, "features").filter("sample_id is not null"), "feature", table(spark, d, "feature_dictionary"), "feature")
    numbers = shape.pivoted(facts.filter("value_num is not null"), ["sample_id"], value="value_num", features=names)
    texts = shape.pivoted(facts.filter("value_txt is not null"), ["sample_id"], value="value_txt", features=names)
    return joins.outer_all([numbers, texts.toDF("sample_id", *[f"txt_{c}" for c in texts.columns[1:]])], "sample_id")


def q_typed_aggregate(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", (F.col("o_totalprice") > 400000).alias("large"), "o_totalprice", "o_orderpriority")
    out = aggregates.typed_aggregate(orders, "o_custkey", [F.col("o_orderkey")])
    return out.select("o_custkey", "large", F.round("o_totalprice", 3).alias("o_totalprice"), "o_orderpriority")


def q_text_lists(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.typed_aggregate(table(spark, d, "orders").select("o_custkey", "o_orderpriority"), "o_custkey", [F.col("o_orderpriority")], "list")


def q_one_hot(spark: SparkSession, d: str) -> DataFrame:
    return shape.one_hot(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["F", "O", "P"])


def q_column_profile(spark: SparkSession, d: str) -> DataFrame:
    names = ("customer", "documents", "id_map", "alias_map")
    return joins.united([aggregates.column_profile(table(spark, d, n), n) for n in names])


def q_best_id_columns(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.best_id_column(q_column_profile(spark, d))


def q_describe(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.described(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


def q_role_crosswalk(spark: SparkSession, d: str) -> DataFrame:
    return identifiers.role_crosswalk(_roles(spark, d), "id", "role", "source", "raw", ["clinical", "expression", "mutations"])


def _roles(spark: SparkSession, d: str) -> DataFrame:
    parts = []
    for name, column, role in (("customer", "c_custkey", "clinical"), ("orders", "o_custkey", "expression"), ("events", "user_id", "mutations")):
        parts.append(table(spark, d, name).select(F.col(column).alias("id"), F.lit(role).alias("role"), F.lit(name).alias("source"), F.col(column).cast("string").alias("raw")))
    return joins.united(parts)


def q_term_statistics(spark: SparkSession, d: str) -> DataFrame:
    out = aggregates.term_statistics(table(spark, d, "structured_vocab_raw"), "term", "source_file", "context")
    return out.withColumn("example_files", F.array_join("example_files", "|"))


def q_alias_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.conflicts(table(spark, d, "alias_map"), "alias", "normalized").withColumn("normalized_variants", F.array_join("normalized_variants", "|"))


def q_host_counts(spark: SparkSession, d: str) -> DataFrame:
    links = table(spark, d, "documents").select(F.explode(urls.urls_in(F.col("text"))).alias("url")).select(urls.host(F.col("url")).alias("host"))
    return aggregates.top_values(links, "host", 15)


def q_size_strata(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.counts_by(shape.size_strata(table(spark, d, "documents"), "n_chars", 1000), "stratum")


def q_repeated_failures(spark: SparkSession, d: str) -> DataFrame:
    return shape.repeated(table(spark, d, "events").filter("event_type = 'error'"), "user_id", 3)


def q_exact_duplicates(spark: SparkSession, d: str) -> DataFrame:
    groups = aggregates.duplicate_groups(table(spark, d, "documents").filter("text is not null"), [F.md5("text"), F.length("text")], "doc_id")
    return groups.withColumn("examples", F.array_join(F.transform("examples", lambda x: x.cast("string")), ","))


def q_duplicate_rows(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.duplicate_rows(table(spark, d, "structured_vocab_raw"), ["occ_id"])


def q_column_signals(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.column_signals(table(spark, d, "features").select("sample_id", "feature", "value_txt", "source"), ["sample_id", "feature", "value_txt", "source"])


def q_relations_to_edges(spark: SparkSession, d: str) -> DataFrame:
    return _edges(spark, d, "tfidf")


def q_relations_to_edges_const(spark: SparkSession, d: str) -> DataFrame:
    return _edges(spark, d, "tfidf_const")


def _edges(spark: SparkSession, d: str, weight: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("subject"), F.col("l_returnflag").alias("predicate"), F.col("l_partkey").alias("object"), (1 - F.col("l_discount")).alias("confidence"),
        (F.col("l_linestatus") == "O").alias("negated"), F.col("l_linestatus").alias("section"), F.col("l_orderkey").alias("doc"),
    )
    return aggregates.relations_to_edges(rows, 0.93, weight).withColumn("sections", F.array_join("sections", "|"))


def q_binarized(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "features").select("fact_id", shape.binarized(F.col("value_num")).alias("flag"), shape.binarized(F.col("value_num"), None).alias("flag_or_null"))


def q_text_columns(spark: SparkSession, d: str) -> DataFrame:
    return joins.united([shape.text_column_list(table(spark, d, n), n) for n in ("alias_map", "documents", "features", "id_map", "vocabulary")])


def q_merged_counts(spark: SparkSession, d: str) -> DataFrame:
    per = table(spark, d, "structured_vocab_raw").filter("term is not null").groupBy("source_file", F.lower("term").alias("term")).agg(F.count("*").alias("n"))
    return aggregates.merged_counts(per, 2, 200)


def q_file_ratios(spark: SparkSession, d: str) -> DataFrame:
    """Rows per thousand characters, mean size and fill of each document source (PRJ-19)."""
    out = table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"), F.count("study_id").alias("filled"))
    return out.select("source", F.round(F.col("n") * 1000 / F.col("chars"), 6).alias("rows_per_kchar"), F.round(F.col("chars") / F.col("n"), 4).alias("mean_chars"), F.round(F.col("filled") / F.col("n"), 6).alias("fill"))


def q_keyword_columns(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.keyword_columns(q_column_profile(spark, d), ["id", "patient", "term", "name"])


def q_source_gaps(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "structured_vocab_raw")
    return aggregates.source_gaps(rows, "origin", "source_file", F.coalesce(F.trim("term_type"), F.lit("")) == "")


QUERIES = {n: f for n, f in list(globals().items()) if n.startswith("q_")}

_PROFILE = """
SELECT '{t}' AS table_name, column_name, count(*) AS n_rows, count(value) AS n_filled, round(count(value) / count(*), 6) AS fill_rate, count(DISTINCT value) AS n_distinct,
       CASE WHEN count(value) > 0 THEN round(count(DISTINCT value) / count(value), 6) END AS unique_rate
FROM (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM {t}) UNPIVOT INCLUDE NULLS (value FOR column_name IN (*)) GROUP BY column_name"""
_PROFILES = " UNION ALL ".join(_PROFILE.format(t=t) for t in ("customer", "documents", "id_map", "alias_map"))
_MELT = """
SELECT CAST({k} AS VARCHAR) AS sample_id, feature, value_num, CAST(NULL AS VARCHAR) AS value_txt, '{t}' AS source
FROM (UNPIVOT (SELECT {k}, {nums} FROM {t}) ON {ns} INTO NAME feature VALUE value_num)
UNION ALL SELECT CAST({k} AS VARCHAR), feature, CAST(NULL AS DOUBLE), value_txt, '{t}' FROM (UNPIVOT (SELECT {k}, {ts} FROM {t}) ON {ts} INTO NAME feature VALUE value_txt)"""


def _melt(t: str, k: str, numbers: str, texts: str) -> str:
    return _MELT.format(t=t, k=k, nums=", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in numbers.split()), ns=", ".join(numbers.split()), ts=", ".join(texts.split()))


_EDGE = """
WITH r AS (SELECT * FROM lineitem WHERE 1 - l_discount >= 0.93 AND l_suppkey <> l_partkey),
n AS (SELECT count(DISTINCT l_orderkey) AS n FROM r),
e AS (SELECT l_suppkey AS subject, l_returnflag AS predicate, l_partkey AS object, count(*) AS sentence_count, count(DISTINCT l_orderkey) AS doc_count, round(avg(1 - l_discount), 6) AS mean_conf,
        round(avg(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END), 6) AS neg_frac, string_agg(DISTINCT l_linestatus, '|' ORDER BY l_linestatus) AS sections FROM r GROUP BY ALL)
SELECT e.*, round(doc_count * mean_conf * ln(1 + n.n / {by}), 6) AS weight FROM e, n"""

SQL = {
    "q_folder_summary": "SELECT source, count(*) AS n_files, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM documents GROUP BY source",
    "q_top_parts": "SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 150",
    "q_occurrence_matrix": "SELECT o_custkey, " + ", ".join(f"""max(CASE WHEN o_orderstatus = '{s}' THEN 1 ELSE 0 END) AS "{s}\"""" for s in "FOP") + " FROM orders GROUP BY o_custkey",
    "q_feature_melt": " UNION ALL ".join([_melt("customer", "c_custkey", "c_nationkey c_acctbal", "c_name c_mktsegment"), _melt("supplier", "s_suppkey", "s_nationkey s_acctbal", "s_name"), _melt("part", "p_partkey", "p_size p_retailprice", "p_name p_brand p_type")]),
    "q_feature_prevalence": "SELECT feature, count(DISTINCT sample_id) AS n FROM features WHERE value_num IS NOT NULL OR value_txt IS NOT NULL GROUP BY feature",
    "q_feature_pivot": "SELECT sample_id, " + ", ".join(f"min(value_num) FILTER (feature = '{n}') AS {n}" for ns in CODEBOOK.values() for n in ns.split()) + " FROM features WHERE feature IN (SELECT feature FROM feature_dictionary) GROUP BY sample_id",
    "q_pivots_joined": "SELECT sample_id, " + ", ".join(f"min(value_num) FILTER (feature = '{n}') AS {n}, min(value_txt) FILTER (feature = '{n}') AS txt_{n}" for ns in CODEBOOK.values() for n in ns.split())
    + " FROM features WHERE feature IN (SELECT feature FROM feature_dictionary) AND sample_id IS NOT NULL AND (value_num IS NOT NULL OR value_txt IS NOT NULL) GROUP BY sample_id",
    "q_typed_aggregate": "SELECT o_custkey, bool_or(o_totalprice > 400000) AS large, round(avg(o_totalprice), 3) AS o_totalprice, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY o_custkey",
    "q_text_lists": "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) AS o_orderpriority FROM orders GROUP BY o_custkey",
    "q_one_hot": "SELECT o_orderkey, " + ", ".join(f"CASE WHEN o_orderstatus = '{s}' THEN 1 ELSE 0 END AS o_orderstatus_{s}" for s in "FOP") + " FROM orders",
    "q_column_profile": _PROFILES,
    "q_best_id_columns": f"SELECT table_name, b.column_name, b.unique_rate FROM (SELECT table_name, max(struct_pack(unique_rate, n_filled, column_name)) AS b FROM ({_PROFILES}) WHERE unique_rate IS NOT NULL GROUP BY table_name)",
    "q_keyword_columns": f"SELECT keyword, table_name, column_name, fill_rate FROM ({_PROFILES}), (SELECT unnest(['id', 'patient', 'term', 'name']) AS keyword) WHERE contains(lower(column_name), keyword)",
    "q_source_gaps": """
SELECT topic, source, n_missing, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY topic ORDER BY n_missing DESC, source NULLS FIRST) AS INTEGER) AS rank FROM (
    SELECT origin AS topic, source_file AS source, count(*) AS n_missing FROM structured_vocab_raw WHERE coalesce(trim(term_type, ' '), '') = '' GROUP BY 1, 2)) WHERE rank <= 15""",
    "q_describe": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 4) AS q25,
        round(quantile_cont({c}, 0.5), 4) AS median, round(quantile_cont({c}, 0.75), 4) AS q75, max({c}) AS max FROM lineitem"""
        for c in ("l_quantity", "l_extendedprice", "l_discount")
    ),
    "q_role_crosswalk": """
WITH r AS (SELECT c_custkey AS id, 'clinical' AS role, 'customer' AS source FROM customer UNION ALL SELECT o_custkey, 'expression', 'orders' FROM orders UNION ALL SELECT user_id, 'mutations', 'events' FROM events)
SELECT id AS key, string_agg(DISTINCT role, ';' ORDER BY role) AS roles, string_agg(DISTINCT source, ';' ORDER BY source) AS sources, coalesce(CAST(id AS VARCHAR), '') AS raw_ids,
       coalesce(bool_or(role = 'clinical'), false) AS in_clinical, coalesce(bool_or(role = 'expression'), false) AS in_expression, coalesce(bool_or(role = 'mutations'), false) AS in_mutations FROM r GROUP BY id""",
    "q_term_statistics": """
SELECT term, count(*) AS n_occurrences, count(DISTINCT source_file) AS n_files, count(DISTINCT context) AS n_contexts, coalesce(array_to_string(list_sort(list(DISTINCT source_file))[1:3], '|'), '') AS example_files
FROM structured_vocab_raw WHERE term IS NOT NULL GROUP BY term""",
    "q_alias_conflicts": """
SELECT lower(trim(alias)) AS alias_key, string_agg(DISTINCT normalized, '|' ORDER BY normalized) AS normalized_variants FROM alias_map WHERE alias IS NOT NULL AND trim(normalized) <> '' GROUP BY 1
HAVING count(DISTINCT normalized) > 1""",
    "q_host_counts": r"""
WITH u AS (SELECT unnest(regexp_extract_all(text, '((?:https?|ftp)://[^ \t\n\r<>"'')]+)', 1)) AS url FROM documents)
SELECT lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host, count(*) AS n FROM u GROUP BY 1 HAVING host <> '' ORDER BY n DESC, host LIMIT 15""",
    "q_size_strata": "SELECT CASE WHEN n_chars >= 1000 THEN 'large' ELSE 'small' END AS stratum, count(*) AS n FROM documents GROUP BY 1",
    "q_repeated_failures": "SELECT user_id, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY user_id HAVING count(*) >= 3",
    "q_exact_duplicates": "SELECT md5(text) AS key0, CAST(length(text) AS INTEGER) AS key1, count(*) AS n, array_to_string(list_sort(list(DISTINCT doc_id))[1:5], ',') AS examples FROM documents WHERE text IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1",
    "q_duplicate_rows": "SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS n_duplicated FROM (SELECT count(*) AS n FROM structured_vocab_raw GROUP BY occ_id)",
    "q_column_signals": r"""
SELECT column_name, round(avg(CASE WHEN regexp_matches(value, '^[ ]*[+-]?[0-9]+([.][0-9]+)?[ ]*$') THEN 1 ELSE 0 END), 6) AS numeric_share, round(avg(length(value)), 4) AS mean_length,
       round(avg(CASE WHEN regexp_matches(value, '^[A-Za-z0-9._-]+$') THEN 1 ELSE 0 END), 6) AS code_share, round(avg(CASE WHEN regexp_matches(value, '[ \t\n]') THEN 1 ELSE 0 END), 6) AS space_share
FROM (UNPIVOT (SELECT sample_id, feature, value_txt, source FROM features) ON COLUMNS(*) INTO NAME column_name VALUE value) GROUP BY column_name""",
    "q_relations_to_edges": _EDGE.format(by="(1 + doc_count)"),
    "q_relations_to_edges_const": _EDGE.format(by="2.0"),
    "q_binarized": "SELECT fact_id, CASE WHEN value_num = 0 THEN 0 ELSE 1 END AS flag, CASE WHEN value_num = 0 THEN 0 WHEN value_num IS NOT NULL THEN 1 END AS flag_or_null FROM features",
    "q_text_columns": "SELECT table_name AS file_path, column_name FROM duckdb_columns() WHERE table_name IN ('alias_map', 'documents', 'features', 'id_map', 'vocabulary') AND data_type = 'VARCHAR'",
    "q_merged_counts": """
SELECT term, CAST(sum(n) AS BIGINT) AS n FROM (SELECT source_file, lower(term) AS term, count(*) AS n FROM structured_vocab_raw WHERE term IS NOT NULL GROUP BY 1, 2) WHERE n >= 2 GROUP BY term
ORDER BY n DESC, term LIMIT 200""",
    "q_file_ratios": "SELECT source, round(count(*) * 1000 / sum(length(text)), 6) AS rows_per_kchar, round(sum(length(text)) / count(*), 4) AS mean_chars, round(count(study_id) / count(*), 6) AS fill FROM documents GROUP BY source",
}
