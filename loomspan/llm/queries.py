"""The queries of this package's operators over the test tables, and their SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomspan.llm import canonical, components, duplicates, frequency, packing, privacy, tokens
from loomspan.session import cut, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return frequency.marked_terms(frequency.term_frequencies(table(spark, d, "structured_vocab_raw")))


def p1_term_frequencies(spark: SparkSession, d: str) -> DataFrame:
    return frequency.term_frequencies(table(spark, d, "structured_vocab_raw"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.match_values(table(spark, d, "alias_map"), table(spark, d, "canonical_terms")).select("alias_id", "canonical_id")


def p3_unmatched(spark: SparkSession, d: str) -> DataFrame:
    aliases = table(spark, d, "alias_map")
    return canonical.unmatched(aliases, canonical.match_values(aliases, table(spark, d, "canonical_terms")))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return duplicates.copies(table(spark, d, "vocabulary"))


def p4_collapsed(spark: SparkSession, d: str) -> DataFrame:
    return duplicates.collapse(table(spark, d, "vocabulary")).select("vocab_id", "term", "term_type", "n_copies")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return components.linked_groups(table(spark, d, "id_map"))


def p5_group_sizes(spark: SparkSession, d: str) -> DataFrame:
    return components.group_sizes(components.linked_groups(table(spark, d, "id_map")))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_texts(table(spark, d, "documents"))


def p7_pack(spark: SparkSession, d: str) -> DataFrame:
    sizes = cut(tokens.count_tokens(table(spark, d, "documents")))
    return packing.pack(sizes, table(spark, d, "token_budgets"))


def p7_bounds(spark: SparkSession, d: str) -> DataFrame:
    return packing.bounds(cut(p7_pack(spark, d)))


#: For the test tables only, so that runs can be compared.
_SECRET = b"test tables"


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return privacy.occurrences(privacy.personal_information(table(spark, d, "documents"), secret=_SECRET))


def p8_replaced(spark: SparkSession, d: str) -> DataFrame:
    return privacy.replaced(privacy.personal_information(table(spark, d, "documents"), secret=_SECRET))


QUERIES = {f.__name__: f for f in (p1_found, p1_term_frequencies, p3_found, p3_unmatched, p4_found, p4_collapsed, p5_found, p5_group_sizes, p6_ids, p7_pack, p7_bounds, p8_found, p8_replaced)}

_TERMS = r"""
WITH o AS (
    SELECT DISTINCT occ_id, regexp_replace(regexp_replace(lower(term), '[\s\x{a0}\x{2009}]+', ' ', 'g'), '^ | $', '', 'g') AS term, source_file, coalesce(freq, 1) AS freq
    FROM structured_vocab_raw WHERE term IS NOT NULL
), t AS (
    SELECT term, CAST(sum(freq) AS BIGINT) AS freq, count(DISTINCT source_file) AS n_files FROM o WHERE term <> '' GROUP BY term
), m AS (
    SELECT *, freq <= 3 AS rare, n_files > 0.5 * (SELECT count(DISTINCT source_file) FROM structured_vocab_raw) AS common FROM t
)
"""
_GROUPS = r"""
WITH w AS (
    SELECT vocab_id, term, term_type, list_sort(regexp_extract_all(lower(concat_ws(' ', term, term_type)), '[\pL\pN]+')) AS words
    FROM vocabulary WHERE length(regexp_replace(term, '[\s\x{a0}\x{2009}]+', '', 'g')) > 0
), g AS (SELECT words, min(vocab_id) AS keep_id, count(*) AS n_copies FROM w GROUP BY words)
"""
_LINKED = r"""
WITH RECURSIVE up AS (
    SELECT row_number() OVER () AS r, unnest([raw_value, patient_key, master_patient_id]) AS raw, unnest([false, true, false]) AS is_key FROM id_map
), n AS (
    SELECT r, is_key, replace(regexp_replace(upper(raw), '\s+', '', 'g'), '_', '-') AS name FROM up
), ids AS (
    SELECT * FROM n WHERE name NOT IN ('', 'NA', 'N/A', '#N/A', 'NONE', 'NULL', 'NAN', 'UNKNOWN', 'NOTAVAILABLE', 'UNASSIGNED') AND regexp_matches(name, '[A-Z0-9]') AND NOT regexp_matches(name, '^[A-Z]?-?0+$')
), links AS (
    SELECT DISTINCT a.name AS x, b.name AS y FROM ids a JOIN ids b USING (r)
), reach AS (
    SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
), keys AS (SELECT DISTINCT name FROM ids WHERE is_key),
g AS (SELECT k.name AS patient_key, min(r.y) AS group_key FROM keys k JOIN reach r ON r.x = k.name JOIN keys o ON o.name = r.y GROUP BY k.name)
"""

SQL = {
    "p1_found": _TERMS + "SELECT term, 'rare' AS mark FROM m WHERE rare UNION ALL SELECT term, 'common' FROM m WHERE common",
    "p1_term_frequencies": _TERMS + "SELECT * FROM m",
    "p4_found": _GROUPS + "SELECT keep_id, vocab_id AS copy_id FROM w JOIN g USING (words) WHERE vocab_id <> keep_id",
    "p4_collapsed": _GROUPS + "SELECT vocab_id, term, term_type, n_copies FROM w JOIN g USING (words) WHERE vocab_id = keep_id",
    "p5_found": _LINKED + "SELECT * FROM g",
    "p5_group_sizes": _LINKED + "SELECT group_key, count(*) AS n_keys FROM g GROUP BY group_key",
}
