"""Queries of text mining."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.operators import text
from loomspan.session import table


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "text")


def _headed() -> F.Column:
    part = lambda c: F.coalesce(F.col(c), F.lit(""))
    return F.when(F.pmod("doc_id", F.lit(7)) == 0, F.col("text")).otherwise(F.concat(part("source"), F.lit("\nAbstract\n\n"), part("text"), F.lit("\n  METHODS \n"), part("study_id"), F.lit("\nResults: none\n\tReferences\nConclusion\n"), part("doc_path"), F.lit(" ")))


def q_line_counts(spark: SparkSession, d: str) -> DataFrame:
    return text.lines_of(_docs(spark, d), "text").groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.max(F.length("line")).alias("longest"))


def q_sentences(spark: SparkSession, d: str) -> DataFrame:
    return text.sentence_rows(_docs(spark, d), "doc_id", "text")


def q_sentences_guarded(spark: SparkSession, d: str) -> DataFrame:
    return text.sentence_rows(_docs(spark, d), "doc_id", "text", guard=True, least=20)


def q_sections(spark: SparkSession, d: str) -> DataFrame:
    """The texts under headings, as a paper's parts are: an abstract, methods, a line that only looks like a heading, references."""
    return text.sections_of(table(spark, d, "documents").select("doc_id", _headed().alias("text")), "doc_id", "text")


def q_cleaned_texts(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", F.md5(text.cleaned(F.col("text"))).alias("digest"))


def q_token_hits(spark: SparkSession, d: str) -> DataFrame:
    out = text.token_hits(_docs(spark, d), "doc_id", "text", table(spark, d, "structured_vocab_raw"), "term")
    return out.withColumn("hits", F.array_join("hits", "|"))


def _vocabulary(spark: SparkSession, d: str) -> DataFrame:
    """Names and short forms of the reference list, the words its names begin with, and some of several words."""
    terms = table(spark, d, "canonical_terms")
    forms = F.array("canonical", "short_form", F.substring_index("canonical", " ", 1))
    more = spark.createDataFrame([("lobular carcinoma", "lobular carcinoma", "disease"), ("ductal carcinoma", "ductal carcinoma", "disease"), ("liposome", "liposome", "nanoparticle"), ("ELISA", "ELISA", "assay"), ("RNA-seq", "RNA-seq", "assay")], "term string, canonical string, entity string")
    return terms.select(F.explode(forms).alias("term"), "canonical", "entity").unionByName(more)


def q_mentions(spark: SparkSession, d: str) -> DataFrame:
    return text.mentions(_docs(spark, d), "doc_id", "text", _vocabulary(spark, d), "term", "canonical", "entity")


def q_mention_snippets(spark: SparkSession, d: str) -> DataFrame:
    return text.mentions_in_context(_docs(spark, d), "doc_id", "text", _vocabulary(spark, d), "term", "canonical", "entity").select("doc_id", "char_start", "surface", "snippet")


def q_unknown_terms(spark: SparkSession, d: str) -> DataFrame:
    return text.unknown_tokens(_docs(spark, d), "doc_id", "text", table(spark, d, "structured_vocab_raw"), "term")


def _line_rows(spark: SparkSession, d: str) -> DataFrame:
    return text.lines_of(_docs(spark, d), "text").select("doc_id", "line_no", "line")


def q_predicates(spark: SparkSession, d: str) -> DataFrame:
    rows = _line_rows(spark, d).withColumns({"predicate": text.predicate(F.col("line")), "negated": text.negated(F.col("line"))})
    return rows.filter("predicate <> ''").select("doc_id", "line_no", "predicate", "negated")


def q_predicates_short(spark: SparkSession, d: str) -> DataFrame:
    rows = _line_rows(spark, d).withColumn("predicate", text.predicate(F.col("line"), text.PREDICATES_SHORT))
    return rows.groupBy("predicate").agg(F.count("*").alias("n"))


def q_quantities(spark: SparkSession, d: str) -> DataFrame:
    return _line_rows(spark, d).select("doc_id", "line_no", F.explode(text.quantities(F.col("line"))).alias("name", "value"))


def q_confidence(spark: SparkSession, d: str) -> DataFrame:
    """Lines of headed texts that state a relation: confidence by predicate, quantities and entities, then by section and denial."""
    parts = text.sections_of(table(spark, d, "documents").select("doc_id", _headed().alias("text")), "doc_id", "text")
    rows = text.lines_of(parts, "body").withColumns({"predicate": text.predicate(F.col("line")), "found": text.quantities(F.col("line")), "negated": text.negated(F.col("line"))}).filter("predicate <> ''")
    base = text.confidence(F.col("predicate"), F.col("found"), F.size(F.regexp_extract_all("line", F.lit("([A-Z][A-Z0-9-]{3,})"), F.lit(1))))
    return rows.select("doc_id", "section_no", "line_no", F.round(base, 6).alias("confidence"), F.round(text.section_confidence(base, F.col("section"), F.col("negated")), 6).alias("weighted"))


def q_roles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "vocabulary").filter("term is not null").select("vocab_id", text.role(F.col("term"), F.col("term_type")).alias("role"), text.guessed_type(F.col("term")).alias("guess"))


def q_code_labels(spark: SparkSession, d: str) -> DataFrame:
    return text.code_label_pairs(_docs(spark, d), "doc_id", "text", 1, 0.05)


def q_records_about(spark: SparkSession, d: str) -> DataFrame:
    return text.records_about(table(spark, d, "documents"), ["text", "source"], "(?i)breast|mamma|carcinoma").select("doc_id", "source")


def q_sentence_relations(spark: SparkSession, d: str) -> DataFrame:
    """Mentions of one line in pairs, with the line's predicate."""
    terms = table(spark, d, "canonical_terms").select(F.lower("canonical").alias("term"), "canonical", "entity")
    more = spark.createDataFrame([("lobular carcinoma", "lobular carcinoma", "disease"), ("ductal carcinoma", "ductal carcinoma", "disease"), ("panel", "panel", "gene"), ("liposome", "liposome", "drug")], "term string, canonical string, entity string")
    lines = _line_rows(spark, d).withColumn("key", F.concat_ws(":", "doc_id", "line_no"))
    found = text.mentions(lines, "key", "line", terms.unionByName(more), "term", "canonical", "entity")
    stated = lines.select("key", "doc_id", F.col("line_no").alias("sentence_id"), text.predicate(F.col("line")).alias("predicate")).filter("predicate <> ''")
    rows = found.join(stated, "key").select("doc_id", "sentence_id", "predicate", "normalized", text.role(F.col("normalized"), F.col("entity")).alias("role"))
    return text.sentence_relations(rows, "doc_id")


def q_candidate_terms(spark: SparkSession, d: str) -> DataFrame:
    return text.candidate_terms(table(spark, d, "features"), "features", ["feature", "source", "sample_id"])


def q_filtered_by_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    hits = text.token_hits(_docs(spark, d), "doc_id", "text", table(spark, d, "structured_vocab_raw"), "term")
    return _docs(spark, d).join(hits, "doc_id", "left_semi").select("doc_id")


def q_annotated(spark: SparkSession, d: str) -> DataFrame:
    terms = table(spark, d, "canonical_terms").select(F.coalesce("short_form", "canonical").alias("term"), "canonical", "entity")
    rows = text.annotated(table(spark, d, "alias_map").select("alias_id", "alias", "normalized"), "alias_id", ["alias", "normalized"], terms, "term", "canonical", "entity")
    return rows.select("alias_id", F.array_join("mentions", "|").alias("mentions"), F.array_join("normalized_terms", "|").alias("normalized_terms"))


def q_entities(spark: SparkSession, d: str) -> DataFrame:
    finders = [text.pattern_backend({"gene": r"\b[A-Z]{3}[0-9]\b", "line": r"\b[A-Z]{3}-[0-9]{3}\b"}, 0.85), text.pattern_backend({"dose": r"\b[0-9]+ (?:mg/kg|mg|nM|µM)"}, 0.6)]
    return text.entities(text.sentence_rows(_docs(spark, d), "doc_id", "text"), ["doc_id", "sentence_id"], "sentence", finders)


QUERIES = {n: f for n, f in list(globals().items()) if n.startswith("q_")}

_LINES = "l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS line_no FROM documents WHERE text IS NOT NULL)"
_W = lambda p: f"regexp_matches(line, '(?i)(^|[^a-zA-Z0-9_])({p})($|[^a-zA-Z0-9_])')"
_PREDICATE = lambda rules: "CASE " + " ".join(f"WHEN {_W(p)} THEN '{n}'" for n, p in rules) + " ELSE '' END"
_PLAIN = "replace(replace(line, 'µ', 'u'), 'μ', 'u')"
_FOUND = " UNION ALL ".join(f"SELECT doc_id, line_no, '{n}' AS name, regexp_extract({_PLAIN}, '(?i){p}', 1) AS value FROM l" for n, p in text.QUANTITIES.items())
_BASE = "CASE WHEN predicate IN ({}) THEN 0.9 WHEN predicate IN ({}) THEN 0.7 WHEN predicate IN ({}) THEN 0.6 ELSE 0.4 END".format(*[", ".join(f"'{p}'" for p in ps) for ps in (text.STRONG, text.MEDIUM, text.WEAK)])
_WORDS = "w AS (SELECT DISTINCT doc_id, w FROM (SELECT doc_id, unnest(string_split(regexp_replace(lower(text), '[^a-z0-9_]+', ' ', 'g'), ' ')) AS w FROM documents) WHERE w <> '')"

_HEADED = """CASE WHEN doc_id % 7 = 0 THEN text ELSE coalesce(source, '') || chr(10) || 'Abstract' || chr(10) || chr(10) || coalesce(text, '') || chr(10) || '  METHODS ' || chr(10) || coalesce(study_id, '')
|| chr(10) || 'Results: none' || chr(10) || chr(9) || 'References' || chr(10) || 'Conclusion' || chr(10) || coalesce(doc_path, '') || ' ' END"""
_SECTIONS = rf"""
hl AS (SELECT doc_id, t, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS n FROM (SELECT doc_id, {_HEADED} AS t FROM documents) WHERE t IS NOT NULL),
hh AS (SELECT *, nullif(upper(regexp_extract(line, '(?i)^[ \t]*({"|".join(text.SECTIONS)})[ \t]*$', 1)), '') AS head FROM hl),
hg AS (SELECT *, count(head) OVER (PARTITION BY doc_id ORDER BY n ROWS UNBOUNDED PRECEDING) AS no, count(head) OVER (PARTITION BY doc_id) AS n_heads FROM hh),
hs AS (SELECT doc_id, no, any_value(n_heads) AS n_heads, coalesce(max(head), CASE WHEN any_value(n_heads) = 0 THEN 'UNKNOWN' ELSE 'PREFACE' END) AS section,
    CASE WHEN any_value(n_heads) = 0 THEN any_value(t) ELSE regexp_replace(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (head IS NULL), ''), '^\s+|\s+$', '', 'g') END AS body FROM hg GROUP BY doc_id, no),
sections AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY no) - 1 AS INTEGER) AS section_no, section, body FROM hs WHERE section <> 'PREFACE' OR body <> '')"""
_SENTENCES = r"""
sentences AS (SELECT doc_id, unnest(s) AS sentence, CAST(generate_subscripts(s, 1) - 1 AS INTEGER) AS sentence_id FROM (
    SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+|\n+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x, ' ')), lambda x: length(x) >= 1) AS s FROM documents WHERE text IS NOT NULL))"""
_PROTECTED = r"regexp_replace({}, '(^|[^\pL\pN_])([A-Z][a-z]?)\.(\s)', '\1\2' || chr(3) || '\3', 'g')"  # twice, as neighbours share a blank
_GUARDED = rf"""
WITH m AS (SELECT doc_id, regexp_replace({_PROTECTED.format(_PROTECTED.format("text"))}, '([.!?])\s+([A-Z])', '\1' || chr(1) || '\2', 'g') AS t FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, list_filter(list_transform(string_split(replace(t, chr(3), '.'), chr(1)), lambda x: trim(x, ' ')), lambda x: length(x) >= 20) AS s FROM m)
SELECT doc_id, CAST(generate_subscripts(s, 1) - 1 AS INTEGER) AS sentence_id, unnest(s) AS sentence FROM s"""
_VOCABULARY = """
v AS (SELECT unnest([canonical, short_form, split_part(canonical, ' ', 1)]) AS term, canonical, entity FROM canonical_terms UNION ALL VALUES ('lobular carcinoma', 'lobular carcinoma', 'disease'), ('ductal carcinoma', 'ductal carcinoma', 'disease'),
    ('liposome', 'liposome', 'nanoparticle'), ('ELISA', 'ELISA', 'assay'), ('RNA-seq', 'RNA-seq', 'assay'))"""


def _mention_sql(source: str) -> str:
    """CTEs from v (term, canonical, entity) and (key, text) to found: the longest of those that begin first, word by word."""
    return rf"""
terms AS (SELECT lower(trim(term, ' ')) AS term, min(struct_pack(c := coalesce(canonical, term), k := entity)) AS x FROM v WHERE length(trim(term, ' ')) > 0 GROUP BY 1),
occ AS (SELECT key, text, term, x, unnest(list_transform(range(1, len(p)), lambda i: list_sum(list_transform(p[1:i], lambda y: length(y))) + (i - 1) * length(term))) AS s
    FROM (SELECT key, text, term, x, string_split(lower(text), term) AS p FROM ({source}) JOIN terms ON contains(lower(text), term))),
spans AS (SELECT key, text, CAST(s AS INTEGER) AS a, CAST(s + length(term) AS INTEGER) AS z, x.c AS normalized, x.k AS entity FROM occ
    WHERE NOT regexp_matches(substring(text, CAST(s AS BIGINT), 1), '[\pL\pN_]') AND NOT regexp_matches(substring(text, CAST(s + length(term) + 1 AS BIGINT), 1), '[\pL\pN_]')),
longest AS (SELECT * FROM spans QUALIFY row_number() OVER (PARTITION BY key, a ORDER BY z DESC) = 1),
found AS (SELECT key, a AS char_start, z AS char_end, substring(text, a + 1, z - a) AS surface, normalized, entity, substring(text, greatest(a - 60, 0) + 1, z + 60 - greatest(a - 60, 0)) AS snippet
    FROM longest l WHERE NOT EXISTS (SELECT 1 FROM longest o WHERE o.key = l.key AND o.a < l.a AND o.z > l.a))"""


_ROLE = "CASE " + " ".join(f"WHEN contains(lower(entity), '{p}') THEN '{n}'" for p, n in text.ROLES) + " WHEN regexp_matches(normalized, '[/-]') THEN 'gene' ELSE 'unknown' END"
_ACTION, _STATE = (", ".join(f"'{p}'" for p in ps) for ps in ([*text.STRONG, "suppresses", "induces", "sensitizes"], [*text.WEAK, "pathway_activation"]))
_ENTITY = r"\b[A-Z]{3}[0-9]\b|\b[A-Z]{3}-[0-9]{3}\b|\b[0-9]+ (?:mg/kg|mg|nM|µM)"

SQL = {
    "q_sentences": f"WITH {_SENTENCES} SELECT doc_id, sentence_id, sentence FROM sentences",
    "q_sentences_guarded": _GUARDED,
    "q_sections": f"WITH {_SECTIONS} SELECT doc_id, section_no, section, body FROM sections",
    "q_mentions": f"WITH {_VOCABULARY}, {_mention_sql('SELECT doc_id AS key, text FROM documents')} SELECT key AS doc_id, char_start, char_end, surface, normalized, entity FROM found",
    "q_mention_snippets": f"WITH {_VOCABULARY}, {_mention_sql('SELECT doc_id AS key, text FROM documents')} SELECT key AS doc_id, char_start, surface, snippet FROM found",
    "q_annotated": f"""
WITH v AS (SELECT coalesce(short_form, canonical) AS term, canonical, entity FROM canonical_terms), {_mention_sql("SELECT alias_id AS key, concat_ws(' ', alias, normalized) AS text FROM alias_map")}
SELECT alias_id, coalesce(m, '') AS mentions, coalesce(t, '') AS normalized_terms FROM alias_map LEFT JOIN (SELECT key, string_agg(DISTINCT surface, '|' ORDER BY surface) AS m, string_agg(DISTINCT normalized, '|' ORDER BY normalized) AS t FROM found GROUP BY key) ON key = alias_id""",
    "q_entities": f"""
WITH {_SENTENCES}, e AS (SELECT doc_id, sentence_id, regexp_extract_all(sentence, '{_ENTITY}') AS f, string_split_regex(sentence, '{_ENTITY}') AS p FROM sentences),
i AS (SELECT doc_id, sentence_id, f, p, unnest(range(1, len(f) + 1)) AS i FROM e)
SELECT doc_id, sentence_id, CAST(a AS INTEGER) AS start, CAST(a + length(text) AS INTEGER) AS "end", text, kind, CASE kind WHEN 'dose' THEN 0.6::DOUBLE ELSE 0.85 END AS score FROM (
    SELECT *, f[i] AS text, list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0) AS a,
    CASE WHEN regexp_matches(f[i], '^[0-9]') THEN 'dose' WHEN contains(f[i], '-') THEN 'line' ELSE 'gene' END AS kind FROM i)""",
    "q_sentence_relations": f"""
WITH {_LINES}, v AS (SELECT lower(canonical) AS term, canonical, entity FROM canonical_terms UNION ALL VALUES ('lobular carcinoma', 'lobular carcinoma', 'disease'), ('ductal carcinoma', 'ductal carcinoma', 'disease'), ('panel', 'panel', 'gene'), ('liposome', 'liposome', 'drug')),
{_mention_sql("SELECT doc_id || ':' || line_no AS key, line AS text FROM l")},
stated AS (SELECT doc_id || ':' || line_no AS key, doc_id, line_no AS sentence_id, {_PREDICATE(text.PREDICATES)} AS predicate FROM l),
m AS (SELECT DISTINCT doc_id, sentence_id, predicate, normalized, {_ROLE} AS role FROM found JOIN stated USING (key) WHERE predicate <> ''),
n AS (SELECT doc_id, sentence_id, CAST(count(*) AS INTEGER) AS n_entities FROM m GROUP BY ALL),
p AS (SELECT s.doc_id, s.sentence_id, s.normalized AS subject, s.role AS subject_role, s.predicate, o.normalized AS object, o.role AS object_role, n_entities,
    (s.predicate IN ({_ACTION}) AND s.role = 'drug' AND o.role IN ('gene', 'pathway', 'disease')) OR (s.predicate IN ({_STATE}) AND s.role = 'gene' AND o.role IN ('disease', 'pathway')) AS typed
    FROM m s JOIN m o ON s.doc_id = o.doc_id AND s.sentence_id = o.sentence_id AND s.normalized <> o.normalized JOIN n ON n.doc_id = s.doc_id AND n.sentence_id = s.sentence_id)
SELECT * EXCLUDE (typed, best) FROM (SELECT *, bool_or(typed) OVER (PARTITION BY doc_id, sentence_id) AS best FROM p) WHERE typed = best""",
    "q_line_counts": f"WITH {_LINES} SELECT doc_id, count(*) AS n_lines, CAST(max(length(line)) AS INTEGER) AS longest FROM l GROUP BY doc_id",
    "q_cleaned_texts": r"""
SELECT doc_id, md5(regexp_replace(regexp_replace(replace(regexp_replace(text, '([A-Za-z0-9_])-\n([A-Za-z0-9_])', '\1\2', 'g'), chr(13), ''), '[ \t]+', ' ', 'g'), '\n\n+', chr(10) || chr(10), 'g')) AS digest FROM documents""",
    "q_token_hits": f"""
WITH {_WORDS} SELECT doc_id, count(*) AS hit_count, array_to_string(list_sort(list(w)), '|') AS hits FROM w WHERE w IN (SELECT lower(term) FROM structured_vocab_raw WHERE term IS NOT NULL) GROUP BY doc_id""",
    "q_filtered_by_vocabulary": f"WITH {_WORDS} SELECT DISTINCT doc_id FROM w WHERE w IN (SELECT lower(term) FROM structured_vocab_raw WHERE term IS NOT NULL)",
    "q_unknown_terms": f"""
SELECT term, count(*) AS n FROM (SELECT lower(unnest(regexp_extract_all(text, '({text.TOKEN})', 1))) AS term FROM documents)
WHERE term NOT IN ({", ".join(f"'{w}'" for w in text.STOPWORDS)}) AND term NOT IN (SELECT lower(term) FROM structured_vocab_raw WHERE term IS NOT NULL) GROUP BY term""",
    "q_predicates": f"WITH {_LINES} SELECT * FROM (SELECT doc_id, line_no, {_PREDICATE(text.PREDICATES)} AS predicate, {_W(text.NEGATIONS)} AS negated FROM l) WHERE predicate <> ''",
    "q_predicates_short": f"WITH {_LINES} SELECT {_PREDICATE(text.PREDICATES_SHORT)} AS predicate, count(*) AS n FROM l GROUP BY 1",
    "q_quantities": f"WITH {_LINES} SELECT * FROM ({_FOUND}) WHERE value <> ''",
    "q_confidence": f"""
WITH {_SECTIONS}, l AS (SELECT doc_id, section_no, section, unnest(string_split(body, chr(10))) AS line, CAST(generate_subscripts(string_split(body, chr(10)), 1) - 1 AS INTEGER) AS line_no FROM sections),
f AS (SELECT DISTINCT doc_id, section_no, line_no FROM ({_FOUND.replace("doc_id, line_no,", "doc_id, section_no, line_no,")}) WHERE value <> '' AND name IN ('IC50', 'EC50', 'GI50', 'Ki', 'Kd', 'HR', 'OR', 'p')),
p AS (SELECT *, {_PREDICATE(text.PREDICATES)} AS predicate, {_W(text.NEGATIONS)} AS negated, len(regexp_extract_all(line, '[A-Z][A-Z0-9-]{{3,}}')) >= 3 AS many FROM l),
b AS (SELECT p.*, CAST(least(1.0, {_BASE} + CASE WHEN f.doc_id IS NOT NULL THEN 0.05 ELSE 0.0 END + CASE WHEN many THEN 0.05 ELSE 0.0 END) AS DOUBLE) AS base FROM p LEFT JOIN f USING (doc_id, section_no, line_no) WHERE predicate <> '')
SELECT doc_id, section_no, line_no, round(base, 6) AS confidence, round(greatest(0, least(1, base * CASE section {" ".join(f"WHEN '{n}' THEN {w}" for n, w in text.SECTION_WEIGHTS.items())} ELSE 0.7 END - CASE WHEN negated THEN 0.3 ELSE 0 END)), 6) AS weighted FROM b""",
    "q_roles": "SELECT vocab_id, CASE " + " ".join(f"WHEN contains(lower(term_type), '{p}') THEN '{n}'" for p, n in text.ROLES) + r""" WHEN regexp_matches(term, '[/-]') THEN 'gene' ELSE 'unknown' END AS role,
CASE WHEN contains(lower(term), ' pathway') OR contains(lower(term), ' signaling') OR contains(lower(term), 'signalling') OR starts_with(lower(term), 'pi3k') THEN 'pathway'
WHEN regexp_matches(lower(term), ' carcinoma| cancer| tumor| tumour| neoplasm| syndrome') THEN 'disease' WHEN regexp_matches(lower(term), ' inhibitor| antibody| drug| therapeutic| therapy') THEN 'drug'
WHEN regexp_full_match(term, '[A-Z0-9-]{1,6}') AND regexp_matches(term, '[A-Z]') THEN 'gene' ELSE 'unknown' END AS guess FROM vocabulary WHERE term IS NOT NULL""",
    "q_code_labels": rf"""
WITH {_LINES}, p AS (SELECT doc_id, regexp_extract(line, '^[ \t]*([A-Za-z][A-Za-z0-9._/-]{{1,24}})[ \t]*(?:=|:|--?|–|—)[ \t]+([^ \t].{{1,199}})$', 1) AS code,
trim(regexp_extract(line, '^[ \t]*([A-Za-z][A-Za-z0-9._/-]{{1,24}})[ \t]*(?:=|:|--?|–|—)[ \t]+([^ \t].{{1,199}})$', 2), ' ') AS label FROM l WHERE length(trim(line, ' ')) > 0),
e AS (SELECT doc_id FROM p GROUP BY 1 HAVING count(*) FILTER (length(code) >= 2 AND length(label) >= 2) >= greatest(1, floor(count(*) * 0.05)))
SELECT doc_id, code, label FROM p WHERE length(code) >= 2 AND length(label) >= 2 AND doc_id IN (SELECT doc_id FROM e)""",
    "q_records_about": "SELECT doc_id, source FROM documents WHERE regexp_matches(concat_ws(' ', text, source), '(?i)breast|mamma|carcinoma')",
    "q_candidate_terms": """
WITH v AS (SELECT feature AS v FROM features UNION SELECT source FROM features UNION SELECT sample_id FROM features)
SELECT DISTINCT term, origin, 'features' AS source FROM (SELECT v AS term, 'value' AS origin FROM v WHERE v IS NOT NULL
UNION ALL SELECT column_name, 'colname' FROM duckdb_columns() WHERE table_name = 'features') WHERE length(trim(term, ' ')) >= 3""",
}
