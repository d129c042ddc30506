"""Queries of projections, filters, name rules and text functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.functions import rules, strings, urls
from loomspan.operators import identifiers, joins, shape, windows
from loomspan.session import table

# The names of a wide table's header, as sources spell them.
HEADER = ["Patient ID", "TCGA_Barcode", "gene", "Gene", "BRCA1_mutation", "TP53_mutation", "outcome_os", "Sample.Type", "DepMap_ID", "x"]
# Files with their headers, as an audit meets them.
AUDITED = [
    ("raw/brca/mut.maf", "Hugo_Symbol,Tumor_Sample_Barcode", 12, 900), ("raw/brca/expr.gct", "Name,S1,S2", 1200, 20_000), ("raw/x/clinical_patients.tsv", "patient_id,age,nanoparticle", 3, 40),
    ("raw/x/zeta.csv", "zeta_potential,size_nm,polydispersity,breast_model", 4, 10), ("raw/y/cases_all.txt", "case_list_ids: a b", 1, 1), ("raw/y/none.csv", "", 0, 0), ("raw/y/misc.dat", "liposome,brca", 2, 5),
]


def _header(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([tuple(str(i) for i in range(len(HEADER)))], ", ".join(f"c{i} string" for i in range(len(HEADER)))).toDF(*HEADER)


def q_picked(spark: SparkSession, d: str) -> DataFrame:
    """Some columns under other names, ids first (PRJ-01, PRJ-10), others left out (PRJ-08)."""
    rows = shape.pick(table(spark, d, "lineitem"), {"l_orderkey": "order_id", "l_linenumber": "line", "l_quantity": "quantity", "l_tax": "c"})
    return shape.without(rows, ["c", "not there"])


def q_columns_with(spark: SparkSession, d: str) -> DataFrame:
    """The columns whose names hold a part (PRJ-02)."""
    found = [("mutation", c) for c in shape.columns_with(_header(spark), "_mutation")] + [("outcome", c) for c in shape.columns_with(_header(spark), "outcome", "survival")]
    return spark.createDataFrame(found, "part string, column_name string")


def q_lower_names(spark: SparkSession, d: str) -> DataFrame:
    """Names in lower case, aliases by their canonical one, repeated ones numbered (PRJ-05); signs replaced (STR-07)."""
    low = shape.lower_names(_header(spark), {"patient id": "patient_id", "depmap_id": "model_id"})
    return shape.melted(shape.clean_names(low), ["x"], [c for c in shape.clean_names(low).columns if c != "x"]).select("feature", "value")


def q_prefixed(spark: SparkSession, d: str) -> DataFrame:
    """All columns but the key under their source's name (PRJ-06)."""
    return shape.prefixed(table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal"), "raw/supplier v2.csv", ["s_suppkey"])


def q_with_source(spark: SparkSession, d: str) -> DataFrame:
    """The table that each row was read from (PRJ-07)."""
    rows = shape.with_source(table(spark, d, "nation").select("n_nationkey"))
    return rows.select("n_nationkey", F.regexp_extract("source_relpath", r"([a-z]+)\.parquet", 1).alias("source"), F.endswith(F.col("source_relpath"), F.col("source_file")).alias("ends"), F.startswith(F.col("source_relpath"), F.col("source_dir")).alias("begins"))


def q_first_present(spark: SparkSession, d: str) -> DataFrame:
    """The first non-null of those columns that a table has, else a fill (PRJ-09), and all as one text (PRJ-11)."""
    rows = table(spark, d, "alias_map")
    return rows.select("alias_id", shape.first_present(rows, ["canonical", "normalized", "alias"], "?").alias("name"), shape.first_present(rows, ["none"], "?").alias("none"), shape.text_blob("alias_id", "alias", "entity").alias("blob"))


def q_exploded(spark: SparkSession, d: str) -> DataFrame:
    """A row for each part of a text with separators (PRJ-17), and back to one cell (STR-10)."""
    rows = table(spark, d, "part").select("p_partkey", F.replace("p_name", F.lit(" "), F.lit("|")).alias("word"), F.split("p_name", " ").alias("words"))
    return shape.exploded(rows, "word").select("p_partkey", "word", strings.joined(F.col("words"), "+").alias("all_words"))


def q_gene_ids(spark: SparkSession, d: str) -> DataFrame:
    """The gene id of tables that call it gene_id, or Id, or have none (PRJ-18)."""
    terms = table(spark, d, "canonical_terms").filter("entity = 'gene'").select(F.col("short_form").alias("Gene_ID"), F.col("canonical_id").alias("n"))
    ids = table(spark, d, "canonical_terms").filter("entity = 'drug'").select(F.col("canonical_id").alias("Id"), F.col("canonical_id").alias("n"))
    none = shape.gene_id(table(spark, d, "region").select(F.col("r_regionkey").cast("bigint").alias("n")))
    numbered = none.agg(F.count_distinct("gene_id").cast("string").alias("gene_id"), F.lit(-1).cast("bigint").alias("n"))
    return shape.gene_id(terms).select("gene_id", "n").unionByName(shape.gene_id(ids).select("gene_id", "n")).unionByName(numbered)


def q_resolved_columns(spark: SparkSession, d: str) -> DataFrame:
    """Wanted columns found in a header but for case and signs, by alias, or as a part (PRJ-20)."""
    found = shape.resolve_columns(["patient_id", "barcode", "cell line", "outcome", "missing"], HEADER, {"cell line": "DepMap ID"})
    return spark.createDataFrame(list(found.items()), "wanted string, column_name string")


def q_any_matches(spark: SparkSession, d: str) -> DataFrame:
    """Rows of which a text column matches (FLT-05), with cells that hold something (FLT-09), long enough (FLT-08)."""
    rows = table(spark, d, "structured_vocab_raw").filter(shape.any_matches(["term", "canonical", "context"], "(?i)recept|kinase"))
    return rows.filter(shape.not_junk(F.col("term_type")) & shape.long_enough(F.col("term"), 8, 9)).select("occ_id", "term", "term_type")


def q_url_kept(spark: SparkSession, d: str) -> DataFrame:
    """Addresses relevant enough to be kept (FLT-16, STR-20), and each as a query parameter (FN-07)."""
    words = sorted(urls.RELEVANCE)
    url = F.concat(F.lit("https://h.org/"), F.element_at(F.array(*[F.lit(w) for w in words]), (F.col("event_id") % len(words) + 1).cast("int")), F.lit("/"), F.element_at(F.array(*[F.lit(w) for w in words]), (F.col("event_id") * 7 % len(words) + 1).cast("int")), F.lit(" a&b"))
    rows = table(spark, d, "events").select(url.alias("url"))
    return rows.withColumn("score", urls.relevance(F.col("url"))).filter("score >= 15").groupBy("url", "score").agg(F.count("*").alias("n")).withColumn("quoted", strings.url_quote(F.col("url")))


def q_vocabulary_of_columns(spark: SparkSession, d: str) -> DataFrame:
    """A crosswalk's columns with what the vocabulary says of them, those it lacks included (JN-02)."""
    crosswalk = shape.text_column_list(table(spark, d, "customer"), "customer").unionByName(shape.text_column_list(table(spark, d, "features"), "features"))
    book = table(spark, d, "feature_dictionary").select(F.col("feature").alias("term"), "value_kind").unionByName(spark.createDataFrame([("source", "category"), ("c_name", "name")], "term string, value_kind string"))
    return joins.with_vocabulary(crosswalk, "column_name", book, "term")


def q_sorted_head(spark: SparkSession, d: str) -> DataFrame:
    """The first rows by several keys (SRT-01, SRT-06)."""
    return windows.first_rows(table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice"), [F.col("o_orderpriority"), F.desc("o_totalprice"), F.col("o_orderkey")], 25)


def q_bernoulli(spark: SparkSession, d: str) -> DataFrame:
    """A random tenth: the same rows every time, all of them rows of the table, and about as many as asked for (SRT-07)."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    one, again = windows.bernoulli(rows, 0.1), windows.bernoulli(rows, 0.1)
    n = rows.count()
    return one.agg((F.abs(F.count("*") - 0.1 * n) < 6 * (0.09 * n) ** 0.5).alias("about_a_tenth"), F.lit(one.exceptAll(again).isEmpty()).alias("same"), F.lit(one.exceptAll(rows).isEmpty()).alias("all_rows"))


def q_id_columns(spark: SparkSession, d: str) -> DataFrame:
    """Which columns hold identifiers: by hint, by priority, by part; and those of a header of identifiers (ID-01 to ID-03, ID-05)."""
    wide = ["gene_id", *[f"TCGA-{i:04}" for i in range(999)]]
    rows = [("hinted", c) for c in identifiers.id_columns(HEADER, {"gene": ["gene"]})]
    rows += [("first", identifiers.first_id_column(HEADER, ["sample_id", "DEPMAP_ID"])), ("part", identifiers.first_id_column(HEADER, ["barcode"], partly=True)), ("none", identifiers.first_id_column(HEADER, ["barcode"]))]
    rows += [("wide", str(identifiers.is_header_like(wide)).lower()), ("narrow", str(identifiers.is_header_like(HEADER)).lower()), ("in_header", str(len(identifiers.header_ids(wide, ["GENE_ID"]))))]
    return spark.createDataFrame(rows, "what string, value string")


def q_custom_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys by rules of one's own (ID-08), and the patient part of a barcode (ID-10)."""
    keys = identifiers.custom_keys(F.upper("raw_value"), {"tcga": r"^(TCGA[-_][A-Z0-9]{2})", "digits": r"([0-9]{4,})"})
    return table(spark, d, "id_map").select("map_id", F.explode(keys).alias("k"), identifiers.patient_of(F.col("raw_value")).alias("patient")).select("map_id", "k.key", "k.rule", "patient")


def q_folded(spark: SparkSession, d: str) -> DataFrame:
    """Terms as keys without case (STR-02), in compatible composition (STR-03), and whether they are all capitals (STR-13)."""
    c = F.col("term")
    made = table(spark, d, "vocabulary").filter("term is not null").select("vocab_id", strings.casefold(c).alias("folded"), strings.nfkc(F.concat(F.regexp_replace(c, "[^ -~]", ""), F.lit("ﬁ½"))).alias("composed"), strings.is_upper(c).alias("is_upper"))
    return made


def q_windows_around(spark: SparkSession, d: str) -> DataFrame:
    """What stands around the first number of a text (STR-09), found by expression (STR-12), and the text's beginning."""
    t = F.col("text")
    number = F.regexp_extract(t, "([0-9]+)", 1)
    at = F.locate("7", t) - 1
    rows = table(spark, d, "documents").filter(F.contains(t, F.lit("7")))
    return rows.select("doc_id", strings.window_around(t, at, at + 1, 10).alias("around"), F.substring(t, 1, 20).alias("begin"), number.alias("number"))


def q_audited(spark: SparkSession, d: str) -> DataFrame:
    """Files by modality (STR-23), kind (STR-26) and tags of their headers (STR-25)."""
    files_ = spark.createDataFrame(AUDITED, "path string, header string, n_columns int, n_rows int")
    path, header = F.col("path"), F.col("header")
    kind = rules.modality(path, header, {"maf": "mutation", "gct": "expression"}, [("clinical", "clinical"), ("patients", "clinical")], {"nano": ["zeta_potential", "size_nm", "polydispersity"], "expression": ["gene_id", "tpm"]})
    return files_.select("path", kind.alias("modality"), rules.table_kind(F.col("n_columns"), F.col("n_rows"), F.contains(header, F.lit("patient_id")), F.contains(header, F.lit("case_list_ids"))).alias("kind"), F.array_join(rules.header_tags(header), "|").alias("tags"))


def q_times(spark: SparkSession, d: str) -> DataFrame:
    """Points in time as text and as age in days (FN-03), and values looked up in a table of fixed ones (FN-06)."""
    kinds = F.create_map(*[F.lit(x) for kv in (("click", 1), ("view", 2), ("purchase", 3)) for x in kv])
    return table(spark, d, "events").select("event_id", strings.stamp(F.col("ts")).alias("at"), strings.age_in_days(F.col("ts"), F.lit("2025-01-01").cast("date")).alias("age"), F.coalesce(F.try_element_at(kinds, F.col("event_type")), F.lit(0)).alias("kind"))


QUERIES = {n: f for n, f in list(globals().items()) if n.startswith("q_")}


def _values(columns: str, *rows: str) -> str:
    return f"SELECT * FROM (VALUES {', '.join(f'({r})' for r in rows)}) AS v({columns})"


_WORDS = sorted(urls.RELEVANCE)
_WORD_LIST = ", ".join(f"'{w}'" for w in _WORDS)
_SCORE = " + ".join(f"CASE WHEN contains(lower(url), '{w}') THEN {n} ELSE 0 END" for w, n in urls.RELEVANCE.items())

SQL = {
    "q_picked": "SELECT l_orderkey AS order_id, l_linenumber AS line, l_quantity AS quantity FROM lineitem",
    "q_columns_with": _values("part, column_name", "'mutation', 'BRCA1_mutation'", "'mutation', 'TP53_mutation'", "'outcome', 'outcome_os'"),
    "q_lower_names": _values("feature, value", "'patient_id', '0'", "'tcga_barcode', '1'", "'gene', '2'", "'gene_1', '3'", "'brca1_mutation', '4'", "'tp53_mutation', '5'", "'outcome_os', '6'", "'sample_type', '7'", "'model_id', '8'"),
    "q_prefixed": "SELECT s_suppkey, s_name AS raw_supplier_v2_csv__s_name, s_acctbal AS raw_supplier_v2_csv__s_acctbal FROM supplier",
    "q_with_source": "SELECT n_nationkey, 'nation' AS source, true AS ends, true AS begins FROM nation",
    "q_first_present": "SELECT alias_id, coalesce(normalized, alias, '?') AS name, '?' AS none, concat_ws(' ', alias_id, alias, entity) AS blob FROM alias_map",
    "q_exploded": "SELECT p_partkey, word, replace(p_name, ' ', '+') AS all_words FROM (SELECT p_partkey, p_name, unnest(string_split(p_name, ' ')) AS word FROM part) WHERE word <> ''",
    "q_gene_ids": "SELECT short_form AS gene_id, canonical_id AS n FROM canonical_terms WHERE entity = 'gene' UNION ALL SELECT CAST(canonical_id AS VARCHAR), canonical_id FROM canonical_terms WHERE entity = 'drug' UNION ALL SELECT CAST(count(*) AS VARCHAR), -1 FROM region",
    "q_resolved_columns": _values("wanted, column_name", "'patient_id', 'Patient ID'", "'barcode', 'TCGA_Barcode'", "'cell line', 'DepMap_ID'", "'outcome', 'outcome_os'", "'missing', NULL"),
    "q_any_matches": """
SELECT occ_id, term, term_type FROM structured_vocab_raw WHERE (coalesce(regexp_matches(term, '(?i)recept|kinase'), false) OR coalesce(regexp_matches(canonical, '(?i)recept|kinase'), false) OR coalesce(regexp_matches(context, '(?i)recept|kinase'), false))
AND lower(trim(term_type, ' ')) NOT IN ('', 'na', 'n/a', 'null', 'none', 'unknown') AND length(term) >= 8 AND strlen(term) >= 9""",
    "q_url_kept": f"""
WITH u AS (SELECT 'https://h.org/' || [{_WORD_LIST}][event_id % {len(_WORDS)} + 1] || '/' || [{_WORD_LIST}][event_id * 7 % {len(_WORDS)} + 1] || ' a&b' AS url FROM events)
SELECT url, CAST({_SCORE} AS INTEGER) AS score, count(*) AS n, replace(replace(replace(replace(url, ':', '%3A'), '/', '%2F'), ' ', '+'), '&', '%26') AS quoted FROM u GROUP BY url HAVING {_SCORE} >= 15""",
    "q_vocabulary_of_columns": """
WITH c(file_path, column_name) AS (VALUES ('customer', 'c_name'), ('customer', 'c_mktsegment'), ('features', 'sample_id'), ('features', 'feature'), ('features', 'value_txt'), ('features', 'source')),
b AS (SELECT feature AS term, value_kind FROM feature_dictionary UNION ALL VALUES ('source', 'category'), ('c_name', 'name')) SELECT file_path, column_name, term, value_kind FROM c LEFT JOIN b ON column_name = term""",
    "q_sorted_head": "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 25",
    "q_bernoulli": "SELECT true AS about_a_tenth, true AS same, true AS all_rows",
    "q_id_columns": _values("what, value", "'hinted', 'Patient ID'", "'hinted', 'TCGA_Barcode'", "'hinted', 'gene'", "'hinted', 'Gene'", "'hinted', 'Sample.Type'", "'hinted', 'DepMap_ID'", "'first', 'DepMap_ID'", "'part', 'TCGA_Barcode'", "'none', NULL", "'wide', 'true'", "'narrow', 'false'", "'in_header', '999'"),
    "q_custom_keys": r"""
WITH v AS (SELECT map_id, upper(raw_value) AS u, array_to_string(string_split(nullif(replace(upper(regexp_replace(raw_value, '[ \t\n\r\f\x0B]+', '', 'g')), '_', '-'), ''), '-')[1:3], '-') AS patient FROM id_map),
k AS (SELECT map_id, patient, regexp_extract(u, '^(TCGA[-_][A-Z0-9]{2})', 1) AS key, 'regex:tcga' AS rule FROM v UNION ALL SELECT map_id, patient, regexp_extract(u, '([0-9]{4,})', 1), 'regex:digits' FROM v)
SELECT map_id, key, rule, patient FROM k WHERE key <> ''""",
    "q_folded": r"SELECT vocab_id, replace(replace(lower(term), 'ß', 'ss'), 'ς', 'σ') AS folded, regexp_replace(term, '[^ -~]', '', 'g') || 'fi1⁄2' AS composed, term = upper(term) AND upper(term) <> lower(term) AS is_upper FROM vocabulary WHERE term IS NOT NULL",
    "q_windows_around": """
SELECT doc_id, substring(text, CAST(greatest(instr(text, '7') - 11, 0) + 1 AS BIGINT), CAST(instr(text, '7') + 10 - greatest(instr(text, '7') - 11, 0) AS BIGINT)) AS around, substring(text, 1, 20) AS begin, regexp_extract(text, '([0-9]+)', 1) AS number
FROM documents WHERE contains(text, '7')""",
    "q_audited": _values(
        "path, modality, kind, tags", "'raw/brca/mut.maf', 'mutation', 'table', ''", "'raw/brca/expr.gct', 'expression', 'wide_matrix', ''", "'raw/x/clinical_patients.tsv', 'clinical', 'metadata', 'nano'",
        "'raw/x/zeta.csv', 'nano', 'table', ''", "'raw/y/cases_all.txt', 'unknown', 'caselist', ''", "'raw/y/none.csv', 'unknown', 'empty', ''", "'raw/y/misc.dat', 'unknown', 'table', 'breast|nano'",
    ),
    "q_times": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, CAST(date_diff('day', CAST(ts AS DATE), DATE '2025-01-01') AS INTEGER) AS age, CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 ELSE 0 END AS INTEGER) AS kind FROM events",
}
