"""Queries of identifiers, links, graphs and addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.functions import rules, strings, urls
from loomspan.operators import identifiers, reports
from loomspan.session import cut, table


# What stands in the test tables where there is no id.
NO_IDS = ["NA", "N/A", "#N/A", "NONE", "NULL", "NAN", "UNKNOWN", "NOTAVAILABLE", "UNASSIGNED"]


def q_tokens_normalized(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "id_map").select("map_id", identifiers.token(F.col("raw_value")).alias("token"), identifiers.token(F.col("raw_value"), True).alias("strict_token"))


def q_derived_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "id_map").select("map_id", F.inline(identifiers.derived_keys(F.col("raw_value"), F.col("source_col"))))


def q_barcode_levels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "id_map").select("map_id", identifiers.barcode_level(F.col("raw_value")).alias("x")).filter("x is not null").select("map_id", "x.*")


def q_best_crosswalk(spark: SparkSession, d: str) -> DataFrame:
    level = identifiers.barcode_level(F.col("raw_value"))
    rows = table(spark, d, "id_map").select("source_col", identifiers.token(F.col("patient_key")).alias("value"), level["key"].alias("key"), level["confidence"].alias("confidence"))
    return identifiers.best_crosswalk(rows.filter("key is not null and value is not null"), "source_col", "value", "key", "confidence")


def q_namespaces(spark: SparkSession, d: str) -> DataFrame:
    return identifiers.namespace_hits(table(spark, d, "documents"), "text").withColumn("examples", F.array_join("examples", "|"))


def q_table_namespaces(spark: SparkSession, d: str) -> DataFrame:
    """Accessions among the rows of the link table, and in the headers of a narrow and a wide matrix (ID-11, ID-05)."""
    narrow = spark.createDataFrame([("x", "GSE9 and more", 1)], "`brca liposome` string, `GSM12` string, `TCGA-A1-A0SB` int")
    wide = spark.range(1).select(*[F.lit(1).alias(f"GSM{i}") for i in range(1000)])
    found = [identifiers.table_namespaces(table(spark, d, "id_map"), "id_map"), identifiers.table_namespaces(narrow, "narrow"), identifiers.table_namespaces(wide, "wide")]
    return found[0].unionByName(found[1]).unionByName(found[2])


def q_stable_ids(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("term")
    return table(spark, d, "vocabulary").filter("term is not null").select("vocab_id", strings.short_hash(c).alias("uid"), strings.short_hash(c, "md5", 12).alias("file_id"), F.concat(F.lit("P"), F.upper(strings.short_hash(c, "sha1", 12))).alias("person_id"))


def q_well_formed(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "id_map").filter("raw_value is not null")
    return ids.groupBy("source_file").agg(F.sum(identifiers.well_formed(F.col("raw_value")).cast("int")).alias("n_formed"), F.count("*").alias("n"), F.min(F.length("raw_value")).alias("shortest"), F.max(F.length("raw_value")).alias("longest"))


def q_accessions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", identifiers.accession_of(F.col("doc_path")).alias("accession"))


def q_sniffed_ids(spark: SparkSession, d: str) -> DataFrame:
    return identifiers.sniffed_id_column(table(spark, d, "id_map").select("source_file", "source_col", "raw_value", "patient_key", "rule"), "(?i)^tcga[-_][a-z0-9]{2}[-_][a-z0-9]{4}")


def _links(spark: SparkSession, d: str) -> DataFrame:
    """Both ids of every row, as far as they are ids: no words for nothing, no signs alone, no counters that were never set."""
    a, b = identifiers.token(F.col("raw_value")), identifiers.token(F.col("patient_key"))
    rows = table(spark, d, "id_map").select(a.alias("src"), b.alias("dst"))
    return rows.filter(" and ".join(f"{c} not in ({', '.join(repr(w) for w in NO_IDS)}) and {c} rlike '[A-Z0-9]' and not {c} rlike '^[A-Z]?-?0+$'" for c in ("src", "dst")))


def q_components(spark: SparkSession, d: str) -> DataFrame:
    return identifiers.connected(_links(spark, d))


def q_component_sizes(spark: SparkSession, d: str) -> DataFrame:
    return identifiers.component_sizes(cut(identifiers.connected(_links(spark, d)))).withColumn("members", F.array_join("members", "|"))


def q_shortest_names(spark: SparkSession, d: str) -> DataFrame:
    return identifiers.shortest_names(cut(identifiers.connected(_links(spark, d))))


def q_master_index(spark: SparkSession, d: str) -> DataFrame:
    return identifiers.master_index(cut(identifiers.connected(_links(spark, d))))


def _graph(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    nodes = reports.graph_nodes([(table(spark, d, "customer"), "c_custkey", "c_name", "sample"), (table(spark, d, "nation"), "n_nationkey", "n_name", "list"), (table(spark, d, "orders"), "o_orderkey", "o_orderstatus", "document")])
    edges = reports.graph_edges([(table(spark, d, "customer"), "c_custkey", "sample", "c_nationkey", "list", "IN_LIST"), (table(spark, d, "orders"), "o_orderkey", "document", "o_custkey", "sample", "MENTIONS")], nodes)
    return nodes, edges


def q_graph_nodes(spark: SparkSession, d: str) -> DataFrame:
    return _graph(spark, d)[0]


def q_graph_edges(spark: SparkSession, d: str) -> DataFrame:
    return _graph(spark, d)[1]


def q_graph_counts(spark: SparkSession, d: str) -> DataFrame:
    return reports.graph_counts(*_graph(spark, d))


def _urls(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.explode(urls.urls_in(F.col("text"))).alias("url")).distinct()


def q_url_parts(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("url")
    return _urls(spark, d).select("url", urls.host(c).alias("host"), urls.leaf(c).alias("leaf"), urls.extension(c).alias("extension"), urls.access(c).alias("access"))


def q_url_scores(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("url")
    known = spark.createDataFrame([(f"https://{h}/dataset/brca.csv",) for names in urls.TRUST.values() for h in names], "url string")
    rows = _urls(spark, d).unionByName(known)
    return rows.select("url", urls.relevance(c).alias("relevance"), (urls.relevance(c) >= urls.KEEP_RELEVANCE).alias("keep"), urls.trust(c).alias("trust"), urls.repository(c).alias("repository"))


def q_url_manifest(spark: SparkSession, d: str) -> DataFrame:
    return urls.url_manifest(table(spark, d, "documents"), "text", "source", "doc_id")


def q_dois(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.explode(urls.dois_in(F.col("text"))).alias("doi"))


def q_series_folders(spark: SparkSession, d: str) -> DataFrame:
    found = F.regexp_extract_all(F.col("text"), F.lit("(GSE[0-9]{4,})"), F.lit(1))
    rows = table(spark, d, "documents").select("doc_id", F.explode(found).alias("accession"))
    return rows.select("doc_id", "accession", urls.series_folder(F.col("accession")).alias("folder"))


def q_path_rules(spark: SparkSession, d: str) -> DataFrame:
    paths = table(spark, d, "features").select("source").distinct().unionByName(table(spark, d, "id_map").select(F.col("source_file").alias("source")).distinct())
    return paths.filter("source is not null").select("source", *rules.path_rules(F.col("source")))


_LAYOUT = {"03_primary": {"atlas": ["parquet"], "nanolib": ["csv"], "trialset": ["parquet", "csv"]}}


def q_layout_status(spark: SparkSession, d: str) -> DataFrame:
    paths = table(spark, d, "structured_vocab_raw").select("source_file").filter("source_file is not null").distinct()
    return paths.select("source_file", rules.layout_status(F.col("source_file"), _LAYOUT, [".part", "tmp"]).alias("status"))


def q_surface_forms(spark: SparkSession, d: str) -> DataFrame:
    terms = table(spark, d, "vocabulary").filter("term is not null").select("vocab_id", strings.tidy(F.col("term")).alias("term"))
    return terms.select("vocab_id", F.explode(strings.surface_forms(F.col("term"))).alias("surface"))


def q_alias_lists(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "alias_map").filter("alias is not null").select("alias_id", F.posexplode(strings.alias_list(F.col("alias"))).alias("pos", "part"))


def q_cleaned_terms(spark: SparkSession, d: str) -> DataFrame:
    terms = table(spark, d, "vocabulary").select("vocab_id", strings.tidy(F.col("term")).alias("term"))
    kept = terms.filter((F.octet_length("term") >= 3) & ~F.lower("term").isin(strings.STOP_TERMS))
    return kept.select("vocab_id", "term", strings.safe_name(F.lower("term")).alias("name"), F.concat_ws(",", strings.token_set(F.col("term"))).alias("tokens"))


def q_human_sizes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", strings.human_size(F.octet_length("text") * F.lit(100)).alias("size"))


QUERIES = {n: f for n, f in list(globals().items()) if n.startswith("q_")}

_TOKEN = "nullif(replace(upper(regexp_replace({c}, '[ \\t\\n\\r\\f\\v]+', '', 'g')), '_', '-'), '')"
_RAW, _KEY = _TOKEN.format(c="raw_value"), _TOKEN.format(c="patient_key")
_LEVEL = f"""
l AS (SELECT *, {_RAW} AS v FROM id_map), x AS (SELECT *, regexp_extract(v, '^(TCGA-[A-Z0-9]{{2}}-[A-Z0-9]{{4}}-[0-9]{{2}}[A-Z])', 1) AS s, regexp_extract(v, '^(TCGA-[A-Z0-9]{{2}}-[A-Z0-9]{{4}})', 1) AS p FROM l WHERE v IS NOT NULL),
y AS (SELECT *, CASE WHEN s <> '' THEN s WHEN p <> '' THEN p ELSE v END AS key, CASE WHEN s <> '' THEN 'sample' WHEN p <> '' THEN 'patient' ELSE 'verbatim' END AS level,
      CASE WHEN s <> '' THEN 0.95::DOUBLE WHEN p <> '' THEN 0.9::DOUBLE ELSE 0.7::DOUBLE END AS confidence FROM x)"""
_IS_ID = lambda c: f"{c} NOT IN ({', '.join(repr(w) for w in NO_IDS)}) AND regexp_matches({c}, '[A-Z0-9]') AND NOT regexp_matches({c}, '^[A-Z]?-?0+$')"
_GROUPS = f"""
WITH RECURSIVE e AS (SELECT DISTINCT {_RAW} AS a, {_KEY} AS b FROM id_map WHERE {_IS_ID(_RAW)} AND {_IS_ID(_KEY)}), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
g(node, root) USING KEY (node) AS (SELECT DISTINCT a, a FROM u UNION (SELECT g.node, min(o.root) FROM recurring.g JOIN u ON u.a = g.node JOIN g o ON o.node = u.b WHERE o.root < g.root GROUP BY g.node))"""
_URLS = r"""u AS (SELECT DISTINCT regexp_replace(x, '[.,;:)\]]+$', '') AS url FROM (SELECT unnest(regexp_extract_all(text, '((?:https?|ftp)://[^ \t\n\r<>"'')]+)', 1)) AS x FROM documents))"""
_HOST = "nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '')"
_LEAF = "split_part(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*', ''), '/', -1)"
_KNOWN = ", ".join(f"('https://{h}/dataset/brca.csv')" for names in urls.TRUST.values() for h in names)
_TRUSTED = ", ".join(f"('{h}', {level})" for level, names in urls.TRUST.items() for h in names)
_SCORE = " + ".join(f"CASE WHEN contains(lower(url), '{w}') THEN {n} ELSE 0 END" for w, n in urls.RELEVANCE.items())
_REPO = " ".join(f"WHEN contains(lower(url), '{p}') THEN '{n}'" for p, n in urls.REPOSITORIES)
_RULE = lambda i: "CASE " + " ".join(f"WHEN contains(lower(source), '{r[0]}') THEN {r[i + 1]!r}" for r in rules.PATH_RULES) + f" ELSE {rules.NO_PATH_RULE[i]!r} END"
_GREEK = "term"
for _letter, _name in strings.GREEK.items():
    _GREEK = f"replace({_GREEK}, '{_letter}', '{_name}')"
_TIDY = r"trim(regexp_replace(term, '[ \t\n\r\f\v]+', ' ', 'g'), ' ')"
_HINT = lambda hints: "regexp_matches(lower(source_col), '" + "|".join(hints) + "')"

_SIZE = "strlen(text) * 100"

SQL = {
    "q_accessions": r"""
WITH p AS (SELECT doc_id, doc_path, split_part(doc_path, '/', -1) AS name, regexp_replace(doc_path, '[^/]*$', '') AS parents, '((?:GSE|GSM|SRR|SRX|SRS|ERR|ERX|ERP|PXD)[0-9]+|PRJ[A-Z]{2}[0-9]+|E-[A-Z]{4}-[0-9]+|TCGA-[A-Z0-9]{2,4}(?:-[A-Z0-9]{4})?)' AS form FROM documents)
SELECT doc_id, coalesce(nullif(regexp_extract(upper(name), form, 1), ''), nullif(regexp_extract(upper(parents), form, 1), ''), regexp_replace(name, '\.[^.]*$', '')) AS accession FROM p""",
    "q_human_sizes": "SELECT doc_id, CASE " + " ".join(f"WHEN {_SIZE} < 1024.0 ** {i + 1} THEN round({_SIZE} / (1024.0 ** {i}), 1)::VARCHAR || ' {u}'" for i, u in enumerate(("B", "KB", "MB", "GB", "TB"))) + " END AS size FROM documents",
    "q_tokens_normalized": f"SELECT map_id, {_RAW} AS token, nullif(regexp_replace(coalesce({_RAW}, ''), '-', '', 'g'), '') AS strict_token FROM id_map",
    "q_derived_keys": f"""
WITH l AS (SELECT map_id, source_col, {_RAW} AS v, coalesce({_HINT(identifiers.PATIENT_HINTS)}, false) AS ph, coalesce({_HINT(identifiers.SAMPLE_HINTS)}, false) AS sh, coalesce({_HINT(identifiers.MODEL_HINTS)}, false) AS mh FROM id_map),
x AS (SELECT *, nullif(regexp_extract(v, '^(TCGA-[A-Z0-9]{{2}}-[A-Z0-9]{{4}})', 1), '') AS p FROM l WHERE v IS NOT NULL)
SELECT map_id, p AS key, 'tcga_patient_from_value' AS rule FROM x WHERE p IS NOT NULL
UNION ALL SELECT map_id, v, 'uuid_as_patient' FROM x WHERE regexp_matches(v, '^[0-9A-F]{{8}}-[0-9A-F]{{4}}-[0-9A-F]{{4}}-[0-9A-F]{{4}}-[0-9A-F]{{12}}$')
UNION ALL SELECT map_id, regexp_replace(replace(replace(v, 'ACH', 'ACH-'), '--', '-'), '^ACH-?', 'ACH-'), 'depmap_ach' FROM x WHERE lower(source_col) = 'ach' OR starts_with(lower(source_col), 'depmap') OR regexp_matches(v, '^ACH[-_ ]?[0-9]{{4,6}}$')
UNION ALL SELECT map_id, v, 'patient_col_value' FROM x WHERE ph UNION ALL SELECT map_id, v, 'sample_col_value' FROM x WHERE sh AND p IS NULL UNION ALL SELECT map_id, v, 'model_col_value' FROM x WHERE mh""",
    "q_barcode_levels": f"WITH {_LEVEL} SELECT map_id, key, level, confidence FROM y",
    "q_best_crosswalk": f"""
WITH {_LEVEL}, m AS (SELECT source_col, {_KEY} AS value, key, round(avg(confidence), 6) AS mean_confidence, count(*) AS n FROM y WHERE {_KEY} IS NOT NULL GROUP BY 1, 2, 3),
b AS (SELECT *, row_number() OVER (PARTITION BY source_col, value ORDER BY mean_confidence DESC, n DESC, key) AS rn FROM m) SELECT source_col, value, key, mean_confidence, n FROM b WHERE rn = 1""",
    "q_namespaces": "WITH h AS (" + " UNION ALL ".join(f"SELECT '{n}' AS namespace, text, upper(regexp_extract(text, '(?i)(?:^|[^A-Za-z0-9_])({p})(?:$|[^A-Za-z0-9_])', 1)) AS example FROM documents" for n, p in identifiers.NAMESPACES.items())
    + ") SELECT namespace, count(*) AS n, count(DISTINCT text) AS n_distinct, array_to_string(list_sort(list(DISTINCT example))[1:5], '|') AS examples FROM h WHERE example <> '' GROUP BY namespace",
    "q_table_namespaces": "WITH t AS (SELECT concat_ws(' ', source_file, source_loc, source_col, raw_value, patient_key, rule, master_patient_id) AS t FROM id_map), h AS ("
    + " UNION ALL ".join(f"SELECT 'id_map' AS table_name, '' AS tags, 'value' AS mode, '{n}' AS namespace, count(*) AS n FROM t WHERE regexp_matches(t, '(?i)(^|[^A-Za-z0-9_])(?:{p})($|[^A-Za-z0-9_])')" for n, p in identifiers.NAMESPACES.items())
    + """) SELECT * FROM h WHERE n > 0 UNION ALL VALUES ('narrow', 'breast|nano', 'header', 'GSM', 1), ('narrow', 'breast|nano', 'header', 'TCGA_PAT', 1), ('narrow', 'breast|nano', 'value', 'GSE', 1), ('wide', '', 'wide', 'GSM', 1000)""",
    "q_stable_ids": "SELECT vocab_id, left(sha256(term), 8) AS uid, left(md5(term), 12) AS file_id, 'P' || upper(left(sha1(term), 12)) AS person_id FROM vocabulary WHERE term IS NOT NULL",
    "q_well_formed": "SELECT source_file, count(*) FILTER (regexp_matches(raw_value, '^[A-Za-z0-9_.-]+$')) AS n_formed, count(*) AS n, CAST(min(length(raw_value)) AS INTEGER) AS shortest, CAST(max(length(raw_value)) AS INTEGER) AS longest FROM id_map WHERE raw_value IS NOT NULL GROUP BY 1",
    "q_sniffed_ids": """
SELECT column_name, hits, round(hits / n, 6) AS share FROM (SELECT column_name, count(*) FILTER (regexp_matches(value, '(?i)^tcga[-_][a-z0-9]{2}[-_][a-z0-9]{4}')) AS hits, count(*) AS n
FROM (UNPIVOT (SELECT source_file, source_col, raw_value, patient_key, rule FROM id_map) ON COLUMNS(*) INTO NAME column_name VALUE value) GROUP BY 1) WHERE hits >= 10 AND hits >= n * 0.02""",
    "q_components": _GROUPS + " SELECT * FROM g",
    "q_component_sizes": _GROUPS + " SELECT root, count(*) AS size, array_to_string(list_sort(list(node))[1:50], '|') AS members FROM g GROUP BY root",
    "q_shortest_names": _GROUPS + " SELECT node, first_value(node) OVER (PARTITION BY root ORDER BY length(node), node) AS name FROM g",
    "q_master_index": _GROUPS + " SELECT printf('P%08d', dense_rank() OVER (ORDER BY root)) AS master_patient_id, node AS patient_key FROM g",
    "q_graph_nodes": "SELECT 'sample:' || c_custkey AS id, c_name AS label, 'sample' AS type FROM customer UNION ALL SELECT 'list:' || n_nationkey, n_name, 'list' FROM nation UNION ALL SELECT 'document:' || o_orderkey, min(o_orderstatus), 'document' FROM orders GROUP BY o_orderkey",
    "q_graph_edges": """
SELECT 'sample:' || c_custkey AS src, 'list:' || c_nationkey AS dst, 'IN_LIST' AS type, count(*)::DOUBLE AS weight FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation) GROUP BY 1, 2
UNION ALL SELECT 'document:' || o_orderkey, 'sample:' || o_custkey, 'MENTIONS', count(*)::DOUBLE FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer) GROUP BY 1, 2""",
    "q_graph_counts": """
SELECT 'node' AS part, 'sample' AS type, count(DISTINCT c_custkey) AS n FROM customer UNION ALL SELECT 'node', 'list', count(DISTINCT n_nationkey) FROM nation UNION ALL SELECT 'node', 'document', count(DISTINCT o_orderkey) FROM orders
UNION ALL SELECT 'edge', 'IN_LIST', count(*) FROM (SELECT DISTINCT c_custkey, c_nationkey FROM customer JOIN nation ON c_nationkey = n_nationkey) UNION ALL SELECT 'edge', 'MENTIONS', count(*) FROM (SELECT DISTINCT o_orderkey, o_custkey FROM orders JOIN customer ON o_custkey = c_custkey)""",
    "q_url_parts": f"""
WITH {_URLS} SELECT url, {_HOST} AS host, {_LEAF} AS leaf, lower(regexp_extract({_LEAF}, '\\.([A-Za-z0-9]+)$', 1)) AS extension,
CASE WHEN regexp_matches(lower(url), '^https?:') THEN 'HTTP' ELSE coalesce(nullif(upper(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)), ''), 'UNKNOWN') END AS access FROM u""",
    "q_url_scores": f"""
WITH {_URLS}, w AS (SELECT url FROM u UNION ALL SELECT * FROM (VALUES {_KNOWN})), t(name, level) AS (VALUES {_TRUSTED}), h AS (SELECT url, {_HOST} AS host FROM w),
m AS (SELECT url, level, row_number() OVER (PARTITION BY url ORDER BY length(name) DESC) AS rn FROM h JOIN t ON host = name OR ends_with(host, '.' || name))
SELECT h.url, {_SCORE.replace("url", "h.url")} AS relevance, ({_SCORE.replace("url", "h.url")}) >= 15 AS keep, coalesce(level, 1) AS trust,
CASE {_REPO.replace("(url)", "(h.url)")} WHEN starts_with(lower(h.url), 'ftp://') THEN 'FTP (generic)' WHEN regexp_matches(lower(h.url), '^https://(github\\.com|raw\\.githubusercontent\\.com)') THEN 'GitHub' ELSE 'Web (generic)' END AS repository
FROM h LEFT JOIN m ON m.url = h.url AND rn = 1""",
    "q_url_manifest": r"""
WITH x AS (SELECT source, doc_id, unnest(regexp_extract_all(text, '((?:https?|ftp)://[^ \t\n\r<>"'')]+)', 1)) AS x FROM documents), u AS (SELECT source, doc_id, regexp_replace(x, '[.,;:)\]]+$', '') AS url FROM x),
k AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY source NULLS FIRST, doc_id) AS rn, count(*) OVER (PARTITION BY url) AS n FROM u)"""
    + f" SELECT url, {_HOST} AS domain, {_LEAF} AS leaf, lower(regexp_extract({_LEAF}, '\\.([A-Za-z0-9]+)$', 1)) AS ext_hint, source AS source_file, doc_id AS source_line, left(sha256(url), 8) AS uid, n FROM k WHERE rn = 1",
    "q_dois": r"SELECT doc_id, regexp_replace(x, '[).,;\]]+$', '') AS doi FROM (SELECT doc_id, unnest(regexp_extract_all(text, '(10\.[0-9]{4,9}/[A-Za-z0-9._;()/:-]+)', 1)) AS x FROM documents)",
    "q_series_folders": "SELECT doc_id, a AS accession, 'ftp://ftp.ncbi.nlm.nih.gov/geo/series/' || left(a, greatest(length(a) - 3, 3)) || 'nnn/' || a || '/' AS folder FROM (SELECT doc_id, unnest(regexp_extract_all(text, '(GSE[0-9]{4,})', 1)) AS a FROM documents)",
    "q_path_rules": f"WITH p AS (SELECT DISTINCT source FROM features UNION ALL SELECT DISTINCT source_file FROM id_map) SELECT source, {_RULE(0)} AS destination_folder, {_RULE(1)} AS data_type, {_RULE(2)} AS priority FROM p WHERE source IS NOT NULL",
    "q_layout_status": r"""
SELECT source_file, CASE WHEN regexp_matches(lower(split_part(source_file, '/', -1)), '\.part|tmp') THEN 'NOISY' WHEN NOT starts_with(source_file, '03_primary/') THEN 'OUT_OF_TREE'
 WHEN starts_with(source_file, '03_primary/nanolib/') AND NOT ends_with(lower(source_file), '.csv') THEN 'EXT_MISMATCH' WHEN starts_with(source_file, '03_primary/atlas/') AND NOT ends_with(lower(source_file), '.parquet') THEN 'EXT_MISMATCH'
 WHEN starts_with(source_file, '03_primary/atlas/') OR starts_with(source_file, '03_primary/nanolib/') OR starts_with(source_file, '03_primary/trialset/') THEN 'OK' ELSE 'MISPLACED' END AS status
FROM (SELECT DISTINCT source_file FROM structured_vocab_raw WHERE source_file IS NOT NULL)""",
    "q_surface_forms": f"""
WITH t AS (SELECT vocab_id, {_TIDY} AS term FROM vocabulary WHERE term IS NOT NULL)
SELECT vocab_id, surface FROM (SELECT DISTINCT vocab_id, unnest([term, replace(term, '-', ' '), replace(term, ' ', '-'), {_GREEK}, replace({_GREEK}, '-', ' ')]) AS surface FROM t) WHERE length(surface) >= 3""",
    "q_alias_lists": r"""
WITH w AS (SELECT alias_id, trim(alias, ' ') AS w FROM alias_map WHERE alias IS NOT NULL),
p AS (SELECT alias_id, w, list_filter(list_transform(regexp_split_to_array(w, '[|;,/]'), lambda x: trim(regexp_replace(regexp_replace(trim(x, ' '), '^["'']+|["'']+$', '', 'g'), '[ \t\n\r\f\v]+', ' ', 'g'), ' ')), lambda x: x <> '') AS parts FROM w WHERE w <> ''),
q AS (SELECT alias_id, CASE WHEN len(parts) > 0 THEN parts ELSE [w] END AS parts FROM p)
SELECT alias_id, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS pos, unnest(parts) AS part FROM q""",
    "q_cleaned_terms": f"""
WITH t AS (SELECT vocab_id, {_TIDY} AS term FROM vocabulary)
SELECT vocab_id, term, regexp_replace(lower(term), '[^A-Za-z0-9_]+', '_', 'g') AS name,
       array_to_string(list_filter(list_transform(generate_series(1, len(x)), lambda i: CASE WHEN list_position(x, x[i]) = i THEN x[i] ELSE '' END), lambda w: w <> ''), ',') AS tokens
FROM (SELECT *, string_split(regexp_replace(lower(term), '[^a-z0-9_]+', ' ', 'g'), ' ') AS x FROM t)
WHERE strlen(term) >= 3 AND lower(term) NOT IN ({", ".join(f"'{w}'" for w in strings.STOP_TERMS)})""",
}
