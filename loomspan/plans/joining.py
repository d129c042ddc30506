"""Queries of joins, set operations and order within groups."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.functions.rules import GENOMIC_WORDS, NANO_WORDS, term_domain
from loomspan.operators import joins, reports, shape, windows
from loomspan.session import table
from loomspan.streaming import incremental


def q_nway_outer(spark: SparkSession, d: str) -> DataFrame:
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), "c_mktsegment")
    orders = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.count("*").alias("n_orders"))
    events = table(spark, d, "events").groupBy(F.col("user_id").alias("key")).agg(F.count("*").alias("n_events"))
    return joins.outer_all([customers, orders, events], "key")


def q_first_key(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"))
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    return joins.by_first_key(orders, customers, ["aliquot_id", "custkey"])


def q_shared_keys(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "id_map").filter("source_col is not null").groupBy("source_file", "source_col").agg(F.count("*").alias("n_rows"))
    b = table(spark, d, "id_map").filter("master_patient_id is not null and source_col is not null").groupBy("source_file", "source_col").agg(F.count_distinct("master_patient_id").alias("n_masters"))
    return joins.by_shared_keys(a, b, ["source_file", "source_col", "aliquot_id"])


def q_distinct_keys(spark: SparkSession, d: str) -> DataFrame:
    return joins.distinct_keys(table(spark, d, "lineitem"), "l_orderkey", table(spark, d, "orders"), "o_orderkey")


def q_members(spark: SparkSession, d: str) -> DataFrame:
    return joins.members(table(spark, d, "customer"), "c_custkey", table(spark, d, "orders"), "o_custkey").select("c_custkey", "c_name")


def q_strangers(spark: SparkSession, d: str) -> DataFrame:
    return joins.strangers(table(spark, d, "orders"), "o_orderkey", table(spark, d, "lineitem"), "l_orderkey").select("o_orderkey", "o_custkey")


def q_role_overlaps(spark: SparkSession, d: str) -> DataFrame:
    parts = [table(spark, d, n).select(F.col(c).alias("id"), F.lit(r).alias("role")) for n, c, r in (("customer", "c_custkey", "clinical"), ("orders", "o_custkey", "expression"), ("events", "user_id", "mutations"))]
    return joins.role_overlaps(joins.united(parts), "role", "id")


def q_best_column_pairs(spark: SparkSession, d: str) -> DataFrame:
    return joins.best_column_pairs(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linestatus"))


_KEYWORDS = ["receptor", "factor", "carcinoma", "repair", "micelle"]


def q_keyword_hits(spark: SparkSession, d: str) -> DataFrame:
    return joins.keyword_hits(table(spark, d, "vocabulary").select("vocab_id", "term"), "term", _KEYWORDS).select("vocab_id", "keyword")


def q_union_widen(spark: SparkSession, d: str) -> DataFrame:
    return joins.united([table(spark, d, "customer").select(F.col("c_name").alias("name"), "c_mktsegment"), table(spark, d, "supplier").select(F.col("s_name").alias("name"), "s_acctbal")])


def q_set_operations(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "orders").select(F.col("o_custkey").alias("k"))
    b = table(spark, d, "events").select(F.col("user_id").alias("k"))
    parts = {"union_all": a.unionByName(b), "union": a.union(b).distinct(), "intersect": a.intersect(b), "except": a.exceptAll(b).distinct(), "only_events": b.distinct().join(a, "k", "left_anti")}
    return joins.united([df.agg(F.lit(name).alias("operation"), F.count("*").alias("n"), F.sum("k").alias("total")) for name, df in parts.items()])


def q_canonical_or_self(spark: SparkSession, d: str) -> DataFrame:
    vocabulary = table(spark, d, "structured_vocab_raw").filter("trim(canonical) <> ''")
    return joins.canonical_or_self(table(spark, d, "vocabulary").select("vocab_id", "term"), "term", vocabulary, "term", "canonical")


def q_null_safe_join(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    a = docs.groupBy("lang", "study_id").agg(F.count("*").alias("n"))
    b = docs.groupBy("lang", "study_id").agg(F.max("doc_id").alias("n"))
    return joins.keyed(a, b, ["lang", "study_id"], null_safe=True)


def q_first_of_matches(spark: SparkSession, d: str) -> DataFrame:
    aliases = table(spark, d, "alias_map").select("alias_id", "alias")
    terms = table(spark, d, "canonical_terms")
    low = F.lower(F.trim("alias"))
    attempts = [(terms, low, F.lower("canonical")), (terms, low, F.lower("short_form"))]
    return joins.first_of_matches(aliases, "alias_id", attempts, "canonical_id").select("alias_id", "attempt", "match")


def q_pairs_within(spark: SparkSession, d: str) -> DataFrame:
    pairs = joins.pairs_within(table(spark, d, "lineitem"), ["l_orderkey"], "l_suppkey")
    return pairs.groupBy("left_item", "right_item").agg(F.count("*").alias("n"))


def q_term_domains(spark: SparkSession, d: str) -> DataFrame:
    terms = table(spark, d, "structured_vocab_raw").select(F.lower(F.trim("term")).alias("term")).filter("term <> ''").distinct()
    return terms.groupBy(term_domain(F.col("term")).alias("domain")).agg(F.count("*").alias("n_terms"))


def q_scorecard(spark: SparkSession, d: str) -> DataFrame:
    return reports.scorecard(table(spark, d, "structured_vocab_raw"), "source_file", "term")


def q_scorecard_loose(spark: SparkSession, d: str) -> DataFrame:
    return reports.scorecard(table(spark, d, "structured_vocab_raw"), "source_file", "term", "loose")


def q_intersections(spark: SparkSession, d: str) -> DataFrame:
    out = reports.intersections(table(spark, d, "structured_vocab_raw").filter("source_file is not null"), "source_file", "term")
    return out.select("source_file", F.array_join("genomic_columns", "|").alias("genomic_columns"), F.array_join("nano_columns", "|").alias("nano_columns"))


def q_keep_first(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").filter("text is not null").select("doc_id", "source", "loaded_at", F.md5("text").alias("digest"))
    return windows.keep_first(docs, ["digest"], [F.col("loaded_at"), F.col("doc_id")]).select("doc_id", "source", "digest")


def q_alias_winners(spark: SparkSession, d: str) -> DataFrame:
    return windows.alias_winners(table(spark, d, "alias_map"), "alias", "source", "alias_id").select("alias_key", "alias_id", "source")


def q_head_of_group(spark: SparkSession, d: str) -> DataFrame:
    return windows.head_of_group(table(spark, d, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3).select("o_custkey", "o_orderkey", "rn")


_LINE = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", *_LINE, "l_returnflag")


def q_filled(spark: SparkSession, d: str) -> DataFrame:
    rows = _lines(spark, d).withColumn("flag", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")))
    return windows.filled(rows, ["l_orderkey"], [F.col(c) for c in _LINE], "flag").select("l_orderkey", *_LINE, "flag_filled")


def q_neighbours(spark: SparkSession, d: str) -> DataFrame:
    out = windows.neighbours(_lines(spark, d), ["l_orderkey"], [F.col(c) for c in _LINE], "l_partkey")
    return out.select("l_orderkey", *_LINE, "prev_l_partkey", "next_l_partkey")


def q_within_budget(spark: SparkSession, d: str) -> DataFrame:
    return windows.within_budget(_lines(spark, d), ["l_orderkey"], [F.col(c) for c in _LINE], "l_quantity", 60).select("l_orderkey", *_LINE, "taken")


def q_sequential_ids(spark: SparkSession, d: str) -> DataFrame:
    terms = table(spark, d, "vocabulary").filter("term is not null").groupBy("term").agg(F.min("vocab_id").alias("first_id"), F.count("*").alias("n"))
    return windows.numbered(terms, "term", "master_id")


def q_every_kth(spark: SparkSession, d: str) -> DataFrame:
    return windows.every_kth(table(spark, d, "orders"), "o_orderkey", 10).select("o_orderkey", "o_custkey")


def q_section_carried(spark: SparkSession, d: str) -> DataFrame:
    from loomspan.operators.text import lines_of

    rows = lines_of(table(spark, d, "documents").select("doc_id", "text"), "text")
    head = F.nullif(F.regexp_extract("line", r"^([A-Za-z]+)[ :,]", 1), F.lit(""))
    out = windows.carried(rows, ["doc_id"], [F.col("line_no")], head, "head")
    return out.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_distinct("head").alias("n_heads"), F.max_by("head", "line_no").alias("last_head"))


def q_balanced(spark: SparkSession, d: str) -> DataFrame:
    return windows.balanced(table(spark, d, "customer"), "c_mktsegment", "c_custkey").select("c_custkey", "c_mktsegment", "c_name", "c_acctbal", "rn")


def q_split(spark: SparkSession, d: str) -> DataFrame:
    return windows.split_by_id(table(spark, d, "orders"), "o_orderkey").select("o_orderkey", "part")


def q_transposed(spark: SparkSession, d: str) -> DataFrame:
    segments = table(spark, d, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.max("c_custkey").alias("last_key"))
    return shape.transposed(segments, "c_mktsegment")


def q_event_windows(spark: SparkSession, d: str) -> DataFrame:
    return incremental.windowed_counts(table(spark, d, "events"), "ts", "event_type")


def q_event_sessions(spark: SparkSession, d: str) -> DataFrame:
    return incremental.sessions(table(spark, d, "events"), "ts", "user_id")


QUERIES = {n: f for n, f in list(globals().items()) if n.startswith("q_")}


def _any(column: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower({column}), '{w}')" for w in words) + ")"


_G, _N = _any("term", GENOMIC_WORDS), _any("term", NANO_WORDS)
_DOMAIN = f"CASE WHEN {_G} AND {_N} THEN 'Genomic & Nanomedicine' WHEN {_G} THEN 'Genomic' WHEN {_N} THEN 'Nanomedicine' ELSE 'Other' END"
_CARD = """
WITH f AS (SELECT source_file, coalesce(bool_or({g}), false) AS g, coalesce(bool_or({n}), false) AS n FROM structured_vocab_raw GROUP BY source_file)
SELECT count(*) AS n_files, count(*) FILTER (g) AS n_genomic, count(*) FILTER (n) AS n_nano, count(*) FILTER (g AND n) AS n_both FROM f"""
_W = "(PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity{})"
_COLS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity"
_UNIONS = [
    ("union_all", "SELECT k FROM a UNION ALL SELECT k FROM b"), ("union", "SELECT k FROM a UNION SELECT k FROM b"), ("intersect", "SELECT k FROM a INTERSECT SELECT k FROM b"),
    ("except", "SELECT DISTINCT k FROM (SELECT k FROM a EXCEPT ALL SELECT k FROM b)"), ("only_events", "SELECT k FROM b EXCEPT SELECT k FROM a"),
]
_CELLS = {
    "l": "SELECT DISTINCT name, value FROM (UNPIVOT (SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus FROM orders) ON COLUMNS(*) INTO NAME name VALUE value)",
    "r": "SELECT DISTINCT name, value FROM (UNPIVOT (SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey, CAST(l_suppkey AS VARCHAR) AS l_suppkey, l_linestatus FROM lineitem) ON COLUMNS(*) INTO NAME name VALUE value)",
}

SQL = {
    "q_nway_outer": """
SELECT key, c_mktsegment, n_orders, n_events FROM (SELECT c_custkey AS key, c_mktsegment FROM customer) FULL JOIN (SELECT o_custkey AS key, count(*) AS n_orders FROM orders GROUP BY 1) USING (key)
FULL JOIN (SELECT user_id AS key, count(*) AS n_events FROM events GROUP BY 1) USING (key)""",
    "q_first_key": "SELECT o_orderkey, o_custkey AS custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey",
    "q_shared_keys": """
SELECT source_file, source_col, n_rows, n_masters FROM (SELECT source_file, source_col, count(*) AS n_rows FROM id_map WHERE source_col IS NOT NULL GROUP BY 1, 2)
FULL JOIN (SELECT source_file, source_col, count(DISTINCT master_patient_id) AS n_masters FROM id_map WHERE master_patient_id IS NOT NULL AND source_col IS NOT NULL GROUP BY 1, 2) USING (source_file, source_col)""",
    "q_distinct_keys": "SELECT key, bool_or(l) AS in_left, bool_or(NOT l) AS in_right FROM (SELECT l_orderkey AS key, true AS l FROM lineitem UNION ALL SELECT o_orderkey, false FROM orders) WHERE key IS NOT NULL GROUP BY key",
    "q_members": "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)",
    "q_strangers": "SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
    "q_role_overlaps": """
WITH r AS (SELECT DISTINCT * FROM (SELECT c_custkey AS id, 'clinical' AS role FROM customer UNION ALL SELECT o_custkey, 'expression' FROM orders UNION ALL SELECT user_id, 'mutations' FROM events) WHERE id IS NOT NULL),
n AS (SELECT role, count(*) AS n_a FROM r GROUP BY role)
SELECT a.role AS role_a, b.role AS role_b, any_value(n.n_a) AS n_a, count(*) AS n_shared, round(count(*) / any_value(n.n_a), 6) AS share FROM r a JOIN r b USING (id) JOIN n ON n.role = a.role WHERE a.role <> b.role GROUP BY 1, 2""",
    "q_best_column_pairs": f"""
WITH l AS ({_CELLS["l"]}), r AS ({_CELLS["r"]}), nl AS (SELECT name, count(*) AS n FROM l GROUP BY 1), nr AS (SELECT name, count(*) AS n FROM r GROUP BY 1),
m AS (SELECT l.name AS left_column, r.name AS right_column, count(*) AS n_shared FROM l JOIN r USING (value) GROUP BY 1, 2),
s AS (SELECT m.*, round(n_shared / least(nl.n, nr.n), 6) AS share FROM m JOIN nl ON nl.name = left_column JOIN nr ON nr.name = right_column),
k AS (SELECT *, row_number() OVER (PARTITION BY left_column ORDER BY share DESC, n_shared DESC, right_column DESC) AS rn FROM s)
SELECT left_column, right_column, n_shared, share, CASE WHEN share >= 0.5 THEN 'ok' WHEN share > 0 THEN 'warn' ELSE 'fail' END AS status FROM k WHERE rn = 1""",
    "q_keyword_hits": f"SELECT vocab_id, keyword FROM vocabulary, (SELECT unnest({_KEYWORDS}) AS keyword) WHERE contains(lower(term), keyword)",
    "q_union_widen": "SELECT c_name AS name, c_mktsegment, NULL::DOUBLE AS s_acctbal FROM customer UNION ALL SELECT s_name, NULL, s_acctbal FROM supplier",
    "q_set_operations": "WITH a AS (SELECT o_custkey AS k FROM orders), b AS (SELECT user_id AS k FROM events) " + " UNION ALL ".join(f"SELECT '{n}' AS operation, count(*) AS n, CAST(sum(k) AS BIGINT) AS total FROM ({s})" for n, s in _UNIONS),
    "q_canonical_or_self": """
WITH c AS (SELECT lower(trim(term)) AS k, min(canonical) AS c FROM structured_vocab_raw WHERE trim(canonical) <> '' AND term IS NOT NULL GROUP BY 1)
SELECT vocab_id, term, coalesce(c, term) AS canonical FROM vocabulary LEFT JOIN c ON k = lower(trim(term))""",
    "q_null_safe_join": """
WITH a AS (SELECT lang, study_id, count(*) AS n FROM documents GROUP BY 1, 2), b AS (SELECT lang, study_id, max(doc_id) AS n FROM documents GROUP BY 1, 2)
SELECT a.lang, a.study_id, a.n AS n_x, b.n AS n_y FROM a JOIN b ON a.lang IS NOT DISTINCT FROM b.lang AND a.study_id IS NOT DISTINCT FROM b.study_id""",
    "q_first_of_matches": """
WITH m AS (SELECT alias_id, 0 AS attempt, canonical_id AS match FROM alias_map JOIN canonical_terms ON lower(trim(alias)) = lower(canonical)
           UNION ALL SELECT alias_id, 1, canonical_id FROM alias_map JOIN canonical_terms ON lower(trim(alias)) = lower(short_form)),
b AS (SELECT *, row_number() OVER (PARTITION BY alias_id ORDER BY attempt, match) AS rn FROM m)
SELECT a.alias_id, attempt, match FROM alias_map a LEFT JOIN b ON b.alias_id = a.alias_id AND rn = 1""",
    "q_pairs_within": """
WITH i AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem WHERE l_suppkey IS NOT NULL)
SELECT a.l_suppkey AS left_item, b.l_suppkey AS right_item, count(*) AS n FROM i a JOIN i b USING (l_orderkey) WHERE a.l_suppkey <> b.l_suppkey GROUP BY 1, 2""",
    "q_term_domains": f"SELECT {_DOMAIN} AS domain, count(*) AS n_terms FROM (SELECT DISTINCT lower(trim(term)) AS term FROM structured_vocab_raw WHERE trim(term) <> '') GROUP BY 1",
    "q_scorecard": _CARD.format(g=f"{_G} AND NOT {_N}", n=f"{_N} AND NOT {_G}"),
    "q_scorecard_loose": _CARD.format(g=_G, n=_N),
    "q_intersections": f"""
WITH t AS (SELECT source_file, coalesce(list_sort(list(DISTINCT term) FILTER ({_G}))[1:5], []) AS g, coalesce(list_sort(list(DISTINCT term) FILTER ({_N}))[1:5], []) AS n FROM structured_vocab_raw WHERE source_file IS NOT NULL GROUP BY 1)
SELECT source_file, array_to_string(g, '|') AS genomic_columns, array_to_string(n, '|') AS nano_columns FROM t WHERE len(g) > 0 AND len(n) > 0""",
    "q_keep_first": """
SELECT doc_id, source, digest FROM (SELECT doc_id, source, md5(text) AS digest, row_number() OVER (PARTITION BY md5(text) ORDER BY loaded_at NULLS FIRST, doc_id) AS rn FROM documents WHERE text IS NOT NULL) WHERE rn = 1""",
    "q_alias_winners": """
SELECT alias_key, alias_id, source FROM (SELECT lower(trim(alias)) AS alias_key, alias_id, source, row_number() OVER (PARTITION BY lower(trim(alias))
    ORDER BY -coalesce(list_position(['base', 'codebook', 'scan_raw', 'scan', 'seed'], source), 0), alias_id) AS rn FROM alias_map WHERE alias IS NOT NULL) WHERE rn = 1""",
    "q_head_of_group": "SELECT o_custkey, o_orderkey, rn FROM (SELECT *, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rn FROM orders) WHERE rn <= 3",
    "q_filled": f"""
WITH f AS (SELECT *, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS flag FROM lineitem)
SELECT {_COLS}, coalesce(last_value(flag IGNORE NULLS) OVER {_W.format(" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")}, first_value(flag IGNORE NULLS) OVER {_W.format(" ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING")}) AS flag_filled FROM f""",
    "q_neighbours": f"SELECT {_COLS}, lag(l_partkey) OVER {_W.format('')} AS prev_l_partkey, lead(l_partkey) OVER {_W.format('')} AS next_l_partkey FROM lineitem",
    "q_within_budget": f"SELECT {_COLS}, greatest(0, least(l_quantity, 60 - (sum(l_quantity) OVER {_W.format(' ROWS UNBOUNDED PRECEDING')} - l_quantity))) AS taken FROM lineitem",
    "q_sequential_ids": "SELECT term, min(vocab_id) AS first_id, count(*) AS n, printf('P%08d', row_number() OVER (ORDER BY term)) AS master_id FROM vocabulary WHERE term IS NOT NULL GROUP BY term",
    "q_every_kth": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 10 = 0",
    "q_section_carried": r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents WHERE text IS NOT NULL),
h AS (SELECT *, nullif(regexp_extract(line, '^([A-Za-z]+)[ :,]', 1), '') AS h FROM l),
c AS (SELECT *, coalesce(last_value(h IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING), 'UNKNOWN') AS head FROM h)
SELECT doc_id, count(*) AS n_lines, count(DISTINCT head) AS n_heads, arg_max(head, line_no) AS last_head FROM c GROUP BY doc_id""",
    "q_balanced": """
WITH r AS (SELECT c_custkey, c_mktsegment, c_name, c_acctbal, row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5(CAST(c_custkey AS VARCHAR)), c_custkey) AS rn FROM customer WHERE c_mktsegment IS NOT NULL)
SELECT * FROM r WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM r GROUP BY c_mktsegment))""",
    "q_split": "SELECT o_orderkey, CASE WHEN (o_orderkey * 7919 + 104729) % 100 < 20 THEN 'test' ELSE 'train' END AS part FROM orders",
    "q_transposed": "WITH c AS (SELECT c_mktsegment, unnest(['n', 'last_key']) AS feature, unnest([CAST(count(*) AS VARCHAR), CAST(max(c_custkey) AS VARCHAR)]) AS value FROM customer GROUP BY c_mktsegment) SELECT feature, "
    + ", ".join(f"min(value) FILTER (c_mktsegment = '{s}') AS {s}" for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")) + " FROM c GROUP BY feature",
    "q_event_windows": "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2",
    "q_event_sessions": """
WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS no FROM g)
SELECT user_id, min(ts) AS session_start, count(*) AS n FROM s GROUP BY user_id, no""",
}
