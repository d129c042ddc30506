"""Reading files that nobody vouches for (SRC-01 to SRC-32)."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspan.operators.shape import q
from loomspan.operators.windows import numbered

# Texts that a table's reader takes for missing cells.
MISSING = ["", "NA", "N/A", "#N/A", "NaN", "nan", "null", "NULL", "None", "n/a"]


def _unique(names: Sequence[str]) -> list[str]:
    """Header names without blanks and repetitions: a second x is x_1, an empty one col_3."""
    out: list[str] = []
    for i, n in enumerate(names):
        base = n.strip().lstrip("﻿") or f"col_{i}"
        name, k = base, 0
        while name in out:
            k += 1
            name = f"{base}_{k}"
        out.append(name)
    return out


def put(spark: SparkSession, path: str, content: str | bytes) -> str:
    """Write a small file to any store the engine knows; gives its path."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(content.encode() if isinstance(content, str) else content))
    out.close()
    return path


def first_line(spark: SparkSession, path: str, encoding: str = "UTF-8") -> str:
    row = spark.read.option("encoding", encoding).text(path).first()
    return row[0] if row else ""


def separator(spark: SparkSession, path: str) -> str:
    """Tab, semicolon or comma, whichever the first line has most of (SRC-07)."""
    line = first_line(spark, path)
    return max("\t;,", key=lambda s: (line.count(s), s == ","))


def header(spark: SparkSession, path: str, sep: str | None = None) -> list[str]:
    """A table's column names, from its first line alone (SRC-06)."""
    return _unique([c.strip('"') for c in first_line(spark, path).split(sep or separator(spark, path))])


def first_file_with(spark: SparkSession, paths: Sequence[str], required: Sequence[str]) -> str | None:
    """The first file whose header has all the required columns (SRC-06)."""
    return next((p for p in paths if set(required) <= set(header(spark, p))), None)


def read_csv(spark: SparkSession, path: str, sep: str | None = None, infer: bool = True, comment: str | None = None, columns: Sequence[str] | None = None, missing: Sequence[str] = MISSING) -> DataFrame:
    """A delimited file read forgivingly (SRC-01, SRC-04, SRC-05, SRC-08, SRC-17).

    Short lines are padded with nulls, long ones cut; a file that isn't UTF-8 is read as Latin-1; repeated header names are
    numbered; cells that stand for nothing are null; .gz is unpacked.
    """
    sep = sep or separator(spark, path)
    sample = spark.read.text(path).filter(~F.is_valid_utf8("value")).limit(1)
    encoding = "ISO-8859-1" if not sample.isEmpty() else "UTF-8"
    names = _unique([c.strip('"') for c in first_line(spark, path, encoding).split(sep)])
    reader = spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE").option("encoding", encoding).option("enforceSchema", True)
    if comment:
        reader = reader.option("comment", comment)
        lines = spark.read.option("encoding", encoding).text(path).filter(~F.col("value").startswith(comment)).first()
        names = _unique([c.strip('"') for c in (lines[0] if lines else "").split(sep)])
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    df = reader.schema(schema).csv(path)
    df = df.select(*[F.when(~F.trim(F.col(q(c))).isin(list(missing)), F.col(q(c))).alias(c) for c in df.columns])
    if columns is not None:
        df = df.select(*[F.col(q(c)) for c in columns if c in df.columns])
    return inferred(df) if infer else df


def inferred(df: DataFrame) -> DataFrame:
    """Text columns whose every cell is a whole number or a number get that type, found in one pass over all rows."""
    tests = []
    for i, c in enumerate(df.columns):
        v = F.trim(F.col(q(c)))
        tests += [F.count(v).alias(f"n{i}"), F.count(F.when(v.rlike(r"^[+-]?[0-9]{1,18}$"), 1)).alias(f"i{i}"), F.count(v.try_cast("double")).alias(f"d{i}")]
    r = df.agg(*tests).first() if tests else None
    kind = lambda i: "string" if not r[f"n{i}"] else "bigint" if r[f"i{i}"] == r[f"n{i}"] else "double" if r[f"d{i}"] == r[f"n{i}"] else "string"
    return df.select(*[F.trim(F.col(q(c))).try_cast(kind(i)).alias(c) if kind(i) != "string" else F.col(q(c)) for i, c in enumerate(df.columns)])


def read_csv_strict(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """All cells as text; lines with too many cells are left out, short ones padded (SRC-02)."""
    names = header(spark, path, sep)
    schema = T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField("_broken", T.StringType())])
    df = spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken").schema(schema).csv(path)
    cells = F.size(F.split("_broken", re.escape(sep), -1))
    return df.filter(F.col("_broken").isNull() | (cells <= len(names))).drop("_broken")


def empty_as_text(df: DataFrame) -> DataFrame:
    """Missing cells of text columns as empty texts (SRC-03)."""
    return df.select(*[F.coalesce(F.col(q(f.name)), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(q(f.name)) for f in df.schema])


def read_json(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    """A table of JSON objects, one a line or one array (SRC-14)."""
    return spark.read.option("multiLine", not lines).json(path)


def json_strings(df: DataFrame, text: str, least: int = 3) -> DataFrame:
    """Every string of free JSON, keys aside, of at least that length (SRC-15); texts that are no JSON give none."""
    body = F.regexp_replace(F.when(F.try_parse_json(F.col(q(text))).isNotNull(), F.col(q(text))), r'"(?:[^"\\]|\\.)*"[ \t\r\n]*:', "")
    leaves = F.regexp_extract_all(body, F.lit(r'"((?:[^"\\]|\\.)*)"'), F.lit(1))
    return df.select("*", F.explode(leaves).alias("leaf")).filter(F.length("leaf") >= least)


def read_gct(spark: SparkSession, path: str) -> DataFrame:
    """A matrix file with two lines before its header (SRC-16), all cells as text; .gz is unpacked.

    The three lines are told by their place at the file's beginning, so that lines equal to them elsewhere are data.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_m"))
    first = lines.filter("_block = 0").orderBy("_m").limit(3).collect()
    names = _unique(first[2][0].split("\t")) if len(first) == 3 else []
    cells = F.split("value", "\t")
    keep = lines.filter(~F.col("_m").isin([r["_m"] for r in first]))
    return keep.select(*[F.get(cells, F.lit(i)).alias(n) for i, n in enumerate(names)])


def read_texts(spark: SparkSession, path: str, most_chars: int | None = None) -> DataFrame:
    """(path, text): whole files, cut at most_chars if given (SRC-18, STR-09); the engine skips files of no bytes."""
    text = F.col("content").cast("string")
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", (F.substring(text, 1, most_chars) if most_chars else text).alias("text"))


def case_lists(texts: DataFrame, path: str, text: str) -> DataFrame:
    """(study, case_list, sample_id): the ids of case-list files, one row each (SRC-21)."""
    line = lambda name: F.trim(F.regexp_extract(F.col(q(text)), rf"(?m)^{name}:[ \t]*(.*)$", 1))
    ids = F.split(line("case_list_ids"), r"[ \t,]+")
    return texts.select(line("cancer_study_identifier").alias("study"), F.coalesce(F.nullif(line("case_list_name"), F.lit("")), F.col(q(path))).alias("case_list"), F.explode(ids).alias("sample_id")).filter("sample_id <> ''")


def inventory(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """(path, name, parent, extension, bytes, modified): the files below a folder, without reading them (SRC-22, SRC-23); files of no bytes are skipped."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(root).select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    name = F.substring_index("path", "/", -1)
    return files.select("path", name.alias("name"), F.element_at(F.split("path", "/"), -2).alias("parent"), F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1)).alias("extension"), "bytes", "modified")


def discovered(files: DataFrame, extensions: Sequence[str], include: Sequence[str] = (), exclude: Sequence[str] = (), order: str = "name", most: int | None = None) -> DataFrame:
    """The files of an inventory with the wanted extensions and paths, ordered by name, size_asc or size_desc (SRC-23, FLT-14)."""
    import fnmatch

    rows = files.filter(F.col("extension").isin([e.lower().lstrip(".") for e in extensions]))
    for globs, wanted in ((include, True), (exclude, False)):
        if globs:
            hit = F.col("path").rlike("|".join(f"(?:{fnmatch.translate(g)})" for g in globs).replace(r"\Z", "$").replace(r"\z", "$"))
            rows = rows.filter(hit if wanted else ~hit)
    by = {"name": [F.lower("path")], "size_asc": [F.col("bytes"), F.col("path")], "size_desc": [F.desc("bytes"), F.col("path")]}[order]
    rows = rows.orderBy(*by)
    return rows.limit(most) if most else rows


def overriding(old: DataFrame, new: DataFrame) -> DataFrame:
    """Files of two trees, the new one's in place of the old one's of the same stem, Parquet before other kinds (SRC-24)."""
    from loomspan.operators.joins import first_by

    stem = F.regexp_replace("name", r"\.[^.]*$", "")
    both = old.withColumn("_tree", F.lit(1)).unionByName(new.withColumn("_tree", F.lit(0))).withColumn("stem", stem)
    return first_by(both, ["stem"], [F.col("_tree"), (F.col("extension") != "parquet").cast("int"), F.col("path")]).drop("_tree")


def manifest(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame:
    """A manifest table; refused if it lacks a required column (SRC-31)."""
    df = read_csv(spark, path, infer=False)
    if lacking := [c for c in required if c not in df.columns]:
        raise ValueError(f"{path} lacks {lacking}")
    return df


def fetch_plan(manifest: DataFrame, url: str, size: str, there: DataFrame) -> DataFrame:
    """Each address of a manifest with how it is fetched (way: copy, http, ftp or unknown), what to do (action: skip, resume,
    fetch or refuse) and how many bytes are there (SRC-27, SRC-28); the fetching itself is left to others.

    A file that is there is skipped, unless the manifest has its size and that differs; a part of it (.part) is resumed.
    Addresses are matched by their last part; ``there`` is an inventory. Null addresses have no row.
    """
    from loomspan.functions.urls import leaf

    sizes = there.groupBy(F.regexp_replace("name", r"\.part$", "").alias("_leaf")).agg(F.max(F.when(~F.col("name").endswith(".part"), F.col("bytes"))).alias("_whole"), F.max(F.when(F.col("name").endswith(".part"), F.col("bytes"))).alias("_part"))
    rows = manifest.filter(F.col(q(url)).isNotNull()).withColumn("_leaf", leaf(F.col(q(url)))).join(sizes, "_leaf", "left")
    scheme = F.lower(F.regexp_extract(F.col(q(url)), r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    way = F.when(scheme == "file", "copy").when(scheme.isin("http", "https"), "http").when(scheme == "ftp", "ftp").otherwise("unknown")
    whole = (F.col("_whole") > 0) & (F.col(q(size)).isNull() | (F.col("_whole") == F.col(q(size))))
    action = F.when(way == "unknown", "refuse").when(F.coalesce(whole, F.lit(False)), "skip").when(F.col("_part") > 0, "resume").otherwise("fetch")
    return rows.withColumns({"way": way, "action": action, "have": F.coalesce("_whole", "_part", F.lit(0).cast("bigint"))}).drop("_leaf", "_whole", "_part")


def sectioned_lines(texts: DataFrame, path: str, text: str) -> DataFrame:
    """(path, line_no, section, line): lines of lists with headers of the form # [NAME], each with its section (SRC-31, WIN-12)."""
    from loomspan.operators.windows import carried

    rows = texts.select(F.col(q(path)).alias("path"), F.posexplode(F.split(F.col(q(text)), "\n")).alias("line_no", "line"))
    name = F.nullif(F.regexp_extract("line", r"^#[ \t]*\[([^\]]+)\]", 1), F.lit(""))
    return carried(rows, ["path"], [F.col("line_no")], name).filter("trim(line) <> '' and not startswith(line, '#')")


def failures(lines: DataFrame, line: str, words: Sequence[str] = ("error", "fail", "timeout", "404", "403")) -> DataFrame:
    """Log lines that tell of a failure, with the first address in them (SRC-32, FLT-11)."""
    from loomspan.functions.strings import any_contains
    from loomspan.functions.urls import urls_in

    return lines.filter(any_contains(F.lower(F.col(q(line))), list(words))).withColumn("url", F.try_element_at(urls_in(F.col(q(line))), F.lit(1)))


def footers(paths: DataFrame, path: str) -> DataFrame:
    """(path, n_columns, n_rows, raw_bytes, file_bytes, error): Parquet files by their footers alone (SRC-11).

    Paths are addresses of any store that the executors' Arrow knows (file, hdfs, s3, gs, abfs).
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            rows = []
            for p in batch["path"]:
                try:
                    address = re.sub("^file:/+", "file:///", p)
                    store, place = fs.FileSystem.from_uri(address) if ":/" in address else (fs.LocalFileSystem(), address)
                    with store.open_input_file(place) as source:
                        meta, size = pq.ParquetFile(source).metadata, source.size()
                    raw = sum(meta.row_group(i).total_byte_size for i in range(meta.num_row_groups))
                    rows.append((p, meta.num_columns, meta.num_rows, raw, size, None))
                except Exception as e:  # noqa: BLE001, any broken file is a finding
                    rows.append((p, None, None, None, None, type(e).__name__))
            yield pd.DataFrame(rows, columns=["path", "n_columns", "n_rows", "raw_bytes", "file_bytes", "error"]).astype({c: "Int64" for c in ("n_columns", "n_rows", "raw_bytes", "file_bytes")})

    return paths.select(F.col(q(path)).alias("path")).mapInPandas(read, "path string, n_columns bigint, n_rows bigint, raw_bytes bigint, file_bytes bigint, error string")


def expansion(foot: DataFrame) -> DataFrame:
    """Megabytes, expansion and rows per kilobyte of Parquet files (PRJ-19, RPT-06)."""
    return foot.select("path", F.round(F.col("raw_bytes") / 1048576, 4).alias("raw_mb"), F.round(F.col("raw_bytes") / F.col("file_bytes"), 4).alias("expansion"), F.round(F.col("n_rows") / (F.col("file_bytes") / 1024), 4).alias("rows_per_kb"))


def read_sqlite(spark: SparkSession, path: str, query: str) -> DataFrame:
    """A query's result of a SQLite file (SRC-25): read by the driver, for the small stores this format holds."""
    import sqlite3

    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        return spark.createDataFrame(pd.read_sql_query(query, db))


def read_workbook(spark: SparkSession, path: str) -> DataFrame:
    """(path, sheet, row_no, cells): an .xlsx file's sheets as text cells (SRC-12); needs openpyxl on the executors."""
    schema = "path string, sheet string, row_no bigint, cells array<string>"

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        import openpyxl

        for batch in batches:
            for p, content in zip(batch["path"], batch["content"], strict=True):
                book = openpyxl.load_workbook(io.BytesIO(content), read_only=True, data_only=True)
                for sheet in book.worksheets:
                    rows = [(p, sheet.title, i, [None if x is None else str(x) for x in r]) for i, r in enumerate(sheet.iter_rows(values_only=True))]
                    yield pd.DataFrame(rows, columns=["path", "sheet", "row_no", "cells"])

    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content").mapInPandas(read, schema)


def sheet_tables(cells: DataFrame) -> DataFrame:
    """Workbook rows with their sheet's header: the first row of at least two filled cells (SRC-12)."""
    from loomspan.operators.joins import first_by

    filled = F.size(F.filter("cells", lambda x: x.isNotNull()))
    heads = first_by(cells.filter(filled >= 2), ["path", "sheet"], [F.col("row_no")]).select("path", "sheet", F.col("row_no").alias("head_no"), F.col("cells").alias("header"))
    return cells.join(heads, ["path", "sheet"]).filter("row_no > head_no").drop("head_no")


def read_pdf(spark: SparkSession, path: str, most_pages: int | None = None) -> DataFrame:
    """(path, page_index, text) of PDF files by the first of pymupdf, pdfminer and pypdf that the executors have (SRC-19)."""

    def pages(content: bytes) -> list[str]:
        import io

        try:
            import fitz

            return [p.get_text("text") for p in fitz.open(stream=content, filetype="pdf")]
        except ImportError:
            pass
        try:
            from pdfminer.high_level import extract_text

            return (extract_text(io.BytesIO(content)) or "").split("\f")
        except ImportError:
            pass
        import pypdf

        return [p.extract_text() or "" for p in pypdf.PdfReader(io.BytesIO(content)).pages]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p, content in zip(batch["path"], batch["content"], strict=True):
                texts = pages(bytes(content))[:most_pages]
                yield pd.DataFrame({"path": [p] * len(texts), "page_index": range(len(texts)), "text": texts})

    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content").mapInPandas(read, "path string, page_index int, text string")


def unpacked(path: str, to: str) -> list[str]:
    """The members of a zip or tar archive, unpacked into a folder by the driver (SRC-26); members that lead out of it are refused."""
    import os
    import tarfile
    import zipfile

    root = os.path.realpath(to)
    os.makedirs(root, exist_ok=True)
    inside = lambda name: os.path.realpath(os.path.join(root, name)).startswith(root + os.sep)
    if zipfile.is_zipfile(path):
        with zipfile.ZipFile(path) as z:
            names = [n for n in z.namelist() if not n.endswith("/")]
            if not all(map(inside, names)):
                raise ValueError("a member leads out of the folder")
            z.extractall(root, names)
    else:
        with tarfile.open(path) as t:
            names = [m.name for m in t.getmembers() if m.isfile()]
            if not all(map(inside, names)):
                raise ValueError("a member leads out of the folder")
            t.extractall(root, filter="data")
    return sorted(os.path.join(root, n) for n in names)


def with_positions(df: DataFrame, order: str) -> DataFrame:
    """Rows with a running number in the order of a column, for files whose order matters."""
    return numbered(df, order, "row_no", None)
