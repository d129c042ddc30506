"""Projections and filters: columns by name, type and kind, melting, pivoting, encoding (PRJ-01 to PRJ-20, FLT-01 to FLT-14)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspan.functions.strings import JUNK_TOKENS

#: Tables of more columns aren't read as tables (FLT-10).
WIDTH_LIMIT = 50_000
#: Columns that are encoded or pivoted at most; what becomes columns is collected.
VALUE_LIMIT = 10_000


def q(name: str) -> str:
    """A column's name in backticks, whatever signs it holds."""
    return "`" + name.replace("`", "``") + "`"


def pick(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """The columns of a mapping, renamed, in its order (PRJ-01, PRJ-10)."""
    return df.select(*[F.col(q(old)).alias(new) for old, new in names.items()])


def columns_with(df: DataFrame, *parts: str) -> list[str]:
    """The columns whose names hold one of the parts, those there are, in the table's order (PRJ-02)."""
    return [c for c in df.columns if any(p in c for p in parts)]


def binarized(c: Column, null_as: int | None = 1) -> Column:
    """1 for anything but 0, 0 for 0; a missing value is 1 as well, or as null_as says (PRJ-03)."""
    flag = (c != 0).cast("int")
    return flag if null_as is None else F.coalesce(flag, F.lit(null_as))


def text_column_list(df: DataFrame, source: str) -> DataFrame:
    """(file_path, column_name): the text columns of a table, from its schema alone (PRJ-04); empty with its schema without any (SNK-03)."""
    rows = [(source, f.name) for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.sparkSession.createDataFrame(rows, "file_path string, column_name string")


def lower_names(df: DataFrame, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """All columns in lower case, aliases by their canonical name; a name that is then taken gets a number (PRJ-05)."""
    out: list[str] = []
    for c in df.columns:
        name = (aliases or {}).get(c.strip().lower(), c.strip().lower())
        out.append(name if name not in out else f"{name}_{sum(o == name or o.startswith(name + '_') for o in out)}")
    return df.toDF(*out)


def prefixed(df: DataFrame, prefix: str, keys: Sequence[str]) -> DataFrame:
    """All columns but the keys with the source's name before them (PRJ-06)."""
    import re

    clean = re.sub(r"[^A-Za-z0-9]+", "_", prefix).strip("_")
    return df.select(*[F.col(q(c)) if c in keys else F.col(q(c)).alias(f"{clean}__{c}") for c in df.columns])


def with_source(df: DataFrame) -> DataFrame:
    """The file, folder and path that each row was read from (PRJ-07)."""
    path = F.input_file_name()
    return df.withColumns({"source_relpath": path, "source_dir": F.regexp_extract(path, r"^(.*)/[^/]*$", 1), "source_file": F.substring_index(path, "/", -1)})


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The table without the named columns, as far as it has them (PRJ-08)."""
    return df.drop(*names)


def first_present(df: DataFrame, names: Sequence[str], default: object = None) -> Column:
    """The first non-null of those columns that the table has (PRJ-09)."""
    there = [F.col(q(n)) for n in names if n in df.columns]
    return F.coalesce(*there, F.lit(default)) if there else F.lit(default)


def text_blob(*columns: str) -> Column:
    """All non-null columns as one text (PRJ-11)."""
    return F.concat_ws(" ", *[F.col(q(c)).cast("string") for c in columns])


def melted(df: DataFrame, keys: Sequence[str], columns: Sequence[str], keep_null: bool = True) -> DataFrame:
    """Wide to long: one row a cell, (keys, feature, value); the columns must share a type (PRJ-13)."""
    long = df.unpivot([F.col(q(k)) for k in keys], [F.col(q(c)) for c in columns], "feature", "value")
    return long if keep_null else long.filter("value is not null")


def melted_by_type(df: DataFrame, key: str, source: str) -> DataFrame:
    """(sample_id, feature, value_num, value_txt, source): every non-null cell, numbers and texts in columns of their own (PRJ-13)."""
    numbers = [f.name for f in df.schema if f.name != key and isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    texts = [f.name for f in df.schema if f.name != key and isinstance(f.dataType, T.StringType)]
    sample = F.col(q(key)).cast("string").alias("sample_id")
    parts = []
    if numbers:
        parts.append(melted(df.select(sample, *[F.col(q(c)).cast("double").alias(c) for c in numbers]), ["sample_id"], numbers, False).select("sample_id", "feature", F.col("value").alias("value_num"), F.lit(None).cast("string").alias("value_txt")))
    if texts:
        parts.append(melted(df.select(sample, *[F.col(q(c)) for c in texts]), ["sample_id"], texts, False).select("sample_id", "feature", F.lit(None).cast("double").alias("value_num"), F.col("value").alias("value_txt")))
    empty = df.sparkSession.createDataFrame([], "sample_id string, feature string, value_num double, value_txt string")
    return reduce(DataFrame.unionByName, parts, empty).withColumn("source", F.lit(source))


def distinct_values(df: DataFrame, column: str) -> list:
    """The values that become columns, in order; refuses more than VALUE_LIMIT."""
    rows = df.select(F.col(q(column)).alias("v")).filter("v is not null").distinct().orderBy("v").limit(VALUE_LIMIT + 1).collect()
    if len(rows) > VALUE_LIMIT:
        raise ValueError(f"{column} has more than {VALUE_LIMIT} values")
    return [r["v"] for r in rows]


def pivoted(long: DataFrame, keys: Sequence[str], feature: str = "feature", value: str = "value", features: Sequence | None = None) -> DataFrame:
    """Long to wide: one row per key, one column per feature; of several values the least (PRJ-14)."""
    return long.groupBy(*keys).pivot(feature, list(features) if features is not None else distinct_values(long, feature)).agg(F.min(value))


def occurrence_matrix(df: DataFrame, key: str, item: str, items: Sequence | None = None) -> DataFrame:
    """One row per key, one column per item: 1 where they occur together, else 0 (PRJ-15)."""
    names = list(items) if items is not None else distinct_values(df, item)
    wide = df.groupBy(key).pivot(item, names).agg(F.max(F.lit(1)))
    return wide.fillna(0, subset=[str(n) for n in names]) if names else wide


def one_hot(df: DataFrame, column: str, values: Sequence | None = None) -> DataFrame:
    """A 0/1 column for each value of a column, which goes; null has none of them (PRJ-16)."""
    import re

    values = list(values) if values is not None else distinct_values(df, column)
    flags = [F.when(F.col(q(column)) == F.lit(v), 1).otherwise(0).alias(re.sub(r"[^A-Za-z0-9_]+", "_", f"{column}_{v}")) for v in values]
    return df.select(*[F.col(q(c)) for c in df.columns if c != column], *flags)


def exploded(df: DataFrame, column: str, by: str | None = r"\|") -> DataFrame:
    """A row for each part of a list, or of a text with separators; empty parts and nulls have none (PRJ-17)."""
    parts = F.col(q(column)) if by is None else F.split(F.col(q(column)), by)
    return df.withColumn(column, F.explode(parts)).filter(F.col(q(column)) != "")


def transposed(df: DataFrame, header: str) -> DataFrame:
    """Rows and columns exchanged: the header's values become columns, the other columns rows (PRJ-12)."""
    rest = [c for c in df.columns if c != header]
    return pivoted(melted(df.select(header, *[F.col(q(c)).cast("string").alias(c) for c in rest]), [header], rest), ["feature"], header)


def gene_id(df: DataFrame) -> DataFrame:
    """A gene_id column: gene_id, else id, else a row number (PRJ-18)."""
    low = {c.lower(): c for c in df.columns}
    for name in ("gene_id", "id"):
        if name in low:
            return df.withColumn("gene_id", F.col(q(low[name])).cast("string"))
    return df.withColumn("gene_id", F.monotonically_increasing_id().cast("string"))


def resolve_columns(wanted: Sequence[str], header: Sequence[str], aliases: Mapping[str, str] | None = None) -> dict[str, str | None]:
    """Each wanted column's name in a header: equal but for case and signs, by alias, or as part of it (PRJ-20)."""
    import re

    plain = lambda s: re.sub(r"[^a-z0-9]", "", s.lower())
    by_plain = {plain(h): h for h in reversed(header)}
    out: dict[str, str | None] = {}
    for w in wanted:
        keys = [plain(w), plain((aliases or {}).get(w, w))]
        hit = next((by_plain[k] for k in keys if k in by_plain), None)
        out[w] = hit or next((h for h in header if plain(w) and plain(w) in plain(h)), None)
    return out


def any_matches(columns: Sequence[str], pattern: str) -> Column:
    """Whether one of the text columns matches; null doesn't (FLT-05, FLT-06)."""
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(q(c)).rlike(pattern), F.lit(False)) for c in columns], F.lit(False))


def not_junk(c: Column) -> Column:
    """Whether a cell holds something: neither null nor a word for nothing (FLT-09)."""
    return F.coalesce(~F.lower(F.trim(c)).isin(JUNK_TOKENS), F.lit(False))


def long_enough(c: Column, characters: int = 1, octets: int = 0) -> Column:
    """Whether a text has at least so many characters and bytes (FLT-08)."""
    return (F.length(c) >= characters) & (F.octet_length(c) >= octets)


def repeated(df: DataFrame, column: str, least: int) -> DataFrame:
    """(column, n): what comes up at least so often, as files that fail again and again (FLT-13)."""
    return df.groupBy(column).agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def size_strata(df: DataFrame, size: str, limit: float) -> DataFrame:
    """A column stratum: large from the limit on, else small; null sizes are small (FLT-12, SNK-12)."""
    return df.withColumn("stratum", F.when(F.col(q(size)) >= limit, "large").otherwise("small"))


def too_wide(df: DataFrame, limit: int = WIDTH_LIMIT) -> bool:
    """Whether a table has more columns than can be read as such (FLT-10)."""
    return len(df.columns) > limit


def clean_names(df: DataFrame) -> DataFrame:
    """All column names without signs (STR-07)."""
    import re

    return df.toDF(*[re.sub(r"[^A-Za-z0-9_]+", "_", c) for c in df.columns])

