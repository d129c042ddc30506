"""Queries of the entity-attribute-value operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomspan.operators import wide
from loomspan.session import table


def p2_wide(spark: SparkSession, d: str) -> DataFrame:
    return wide.wide_table(table(spark, d, "features"), table(spark, d, "feature_dictionary"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return wide.long_cells(p2_wide(spark, d), wide.read_codebook(table(spark, d, "feature_dictionary")))


def p2_unknown_attributes(spark: SparkSession, d: str) -> DataFrame:
    return wide.unknown_attributes(table(spark, d, "features"), table(spark, d, "feature_dictionary"))


QUERIES = {"p2_found": p2_found, "p2_wide": p2_wide, "p2_unknown_attributes": p2_unknown_attributes}

_BEST = r"""
WITH book AS (SELECT *, lower(regexp_replace(feature, '[^A-Za-z0-9]+', '_', 'g')) AS k, lower(coalesce(unit, '')) AS u FROM feature_dictionary),
raw AS (
    SELECT f.sample_id, b.feature, b.value_kind, b.u, f.measured_at, f.loaded_at, f.fact_id,
           CASE WHEN isnan(f.value_num) OR f.value_num = -9999 OR isinf(f.value_num) THEN NULL ELSE f.value_num END AS num,
           lower(trim(regexp_replace(f.value_txt, '\s+', ' ', 'g'))) AS txt
    FROM features f JOIN book b ON b.k = regexp_replace(lower(regexp_replace(f.feature, '[^A-Za-z0-9]+', '_', 'g')), '^_+|_+$', '', 'g')
    WHERE f.sample_id IS NOT NULL
), clean AS (
    SELECT * REPLACE (CASE WHEN txt IN ('', '-', '#n/a', 'n/a', 'na', 'nan', 'null', 'none', 'missing', 'unknown', 'not done', '-9999', '-9999.0') THEN NULL ELSE txt END AS txt) FROM raw
), bare AS (
    SELECT *, replace(replace(txt, ' ', ''), '−', '-') AS z FROM clean
), cut AS (
    SELECT *, CASE WHEN u <> '' AND ends_with(z, replace(u, ' ', '')) THEN left(z, length(z) - length(replace(u, ' ', ''))) ELSE z END AS y FROM bare
), parsed AS (
    SELECT *, try_cast(CASE
        WHEN y LIKE '%,%' AND y LIKE '%.%' AND regexp_matches(y, '\.[^,]*$') THEN replace(y, ',', '')
        WHEN y LIKE '%,%' AND y LIKE '%.%' THEN replace(replace(y, '.', ''), ',', '.')
        ELSE replace(y, ',', '.') END AS DOUBLE) AS p FROM cut
), cells AS (
    SELECT sample_id, feature, measured_at, loaded_at, fact_id, coalesce(num, p) AS number, CASE value_kind
        WHEN 'numeric' THEN CAST(CAST(round(coalesce(num, p), 4) AS DECIMAL(24, 4)) AS VARCHAR)
        WHEN 'boolean' THEN CASE WHEN num = 1 THEN 'true' WHEN num = 0 THEN 'false'
            WHEN txt IN ('true', 't', 'yes', 'y', 'ja', 'positive', 'pos', 'present', '1', '1.0') THEN 'true'
            WHEN txt IN ('false', 'f', 'no', 'n', 'nein', 'negative', 'neg', 'absent', '0', '0.0') THEN 'false' END
        ELSE txt END AS cell FROM parsed
), best AS (
    SELECT *, row_number() OVER (PARTITION BY sample_id, feature ORDER BY measured_at DESC NULLS LAST, loaded_at DESC NULLS LAST, fact_id DESC) AS rn FROM cells WHERE cell IS NOT NULL
)
"""

# The codebook of the test tables, by kind.
CODEBOOK = {
    "numeric": """age_at_diagnosis cell_count dose_mg drug_loading_pct expr_cowo7 expr_diwa6 expr_geba6 expr_hazi5 expr_judi5 expr_kocu4 expr_migu4 expr_nege3 expr_qake3 expr_qujo2 expr_somo2
expr_tima1 expr_weqa1 expr_zusi7 followup_days ki_index_pct mutation_burden node_count particle_size_nm polydispersity rna_integrity tumor_size_mm viability_pct zeta_potential_mv""",
    "boolean": "brx1_mutation er_status her2_status menopausal pr_status prior_chemo relapse tpv3_mutation",
    "category": "carrier_class grade_label lineage response sample_type stage subtype vendor_batch",
}
_AS = {"numeric": "number", "boolean": "cell = 'true'", "category": "cell"}
_COLUMNS = ", ".join(f"any_value({_AS[kind]}) FILTER (feature = '{name}') AS {name}" for kind, names in CODEBOOK.items() for name in names.split())

SQL = {
    "p2_wide": _BEST + f", one AS (SELECT sample_id, {_COLUMNS} FROM best WHERE rn = 1 GROUP BY sample_id) SELECT * FROM (SELECT DISTINCT sample_id FROM features WHERE sample_id IS NOT NULL) LEFT JOIN one USING (sample_id)",
    "p2_found": _BEST + "SELECT sample_id, feature, cell FROM best WHERE rn = 1",
    "p2_unknown_attributes": r"""
SELECT k AS feature_key, count(*) AS n FROM (
    SELECT regexp_replace(lower(regexp_replace(feature, '[^A-Za-z0-9]+', '_', 'g')), '^_+|_+$', '', 'g') AS k FROM features
) WHERE k NOT IN (SELECT lower(feature) FROM feature_dictionary) OR k IS NULL GROUP BY k""",
}
