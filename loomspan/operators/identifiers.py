"""Identifiers: columns that hold them, keys derived from them, namespaces, groups of linked ones (ID-01 to ID-16, GR-01, GR-02)."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.functions.rules import header_tags
from loomspan.operators.aggregates import least_values
from loomspan.operators.shape import q
from loomspan.operators.windows import numbered
from loomspan.session import cut
from loomspan.skew import salted_join

# Parts of column names that hold identifiers of patients, samples and models.
PATIENT_HINTS = ["patient", "patient_id", "case", "case_id", "subject", "subject_id", "participant", "participant_id", "donor", "donor_id", "individual"]
SAMPLE_HINTS = ["sample", "sample_id", "tumor_sample_barcode", "tcga_barcode", "barcode", "aliquot", "aliquot_id", "specimen", "specimen_id"]
MODEL_HINTS = ["model", "model_id", "cell_line", "cell_line_id", "depmap_id", "ach"]
# Namespaces of accessions and their form, word limits aside.
NAMESPACES = {
    "GSE": "GSE[0-9]+", "GSM": "GSM[0-9]+", "SRR": "SRR[0-9]+", "SRX": "SRX[0-9]+", "SRS": "SRS[0-9]+", "PRJNA": "PRJNA[0-9]+", "SAMN": "SAMN[0-9]+", "ERR": "ERR[0-9]+", "ERX": "ERX[0-9]+",
    "ERP": "ERP[0-9]+", "EGAD": "EGAD[0-9]+", "EGAS": "EGAS[0-9]+", "EGAN": "EGAN[0-9]+", "E-MTAB": "E-MTAB-[0-9]+", "E-GEOD": "E-GEOD-[0-9]+", "E-MEXP": "E-MEXP-[0-9]+", "PXD": "PXD[0-9]{5,7}",
    "TCGA_PAT": "TCGA-[A-Z0-9]{2}-[A-Z0-9]{4}", "TCGA_SAMP": "TCGA-[A-Z0-9]{2}-[A-Z0-9]{4}-[0-9]{2}[A-Z]", "CPTAC": "CPTAC[-_ ]?[0-9]+",
    "UUID": "[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[089ab][0-9a-f]{3}-[0-9a-f]{12}",
}

_PATIENT = r"^(TCGA-[A-Z0-9]{2}-[A-Z0-9]{4})"
_UUID = r"^[0-9A-F]{8}-[0-9A-F]{4}-[0-9A-F]{4}-[0-9A-F]{4}-[0-9A-F]{12}$"
_MODEL = r"^ACH[-_ ]?[0-9]{4,6}$"


def id_columns(columns: Sequence[str], more: Mapping[str, Sequence[str]] | None = None) -> list[str]:
    """The columns whose names hint at identifiers (ID-01)."""
    hints = [*PATIENT_HINTS, *SAMPLE_HINTS, *MODEL_HINTS, *[n.lower() for names in (more or {}).values() for n in names]]
    return list(dict.fromkeys(c for c in columns if any(h in c.strip().lower() for h in hints)))


def first_id_column(columns: Sequence[str], priority: Sequence[str], partly: bool = False) -> str | None:
    """The first of a priority list that the columns have, without case (ID-02), or that one of them contains (ID-03)."""
    low = {c.lower(): c for c in reversed(columns)}
    exact = next((low[p.lower()] for p in priority if p.lower() in low), None)
    return exact or (next((c for p in priority for c in columns if p.lower() in c.lower()), None) if partly else None)


def is_header_like(columns: Sequence[str]) -> bool:
    """Whether a table is so wide that its header holds the identifiers (ID-05)."""
    return len(columns) >= 1000


def header_ids(columns: Sequence[str], no_ids: Sequence[str]) -> list[str]:
    """The identifiers in a wide table's header: all but the columns that describe rows (ID-05)."""
    skip = {n.lower() for n in no_ids}
    return [c for c in columns if c.lower() not in skip]


def sniffed_id_column(df: DataFrame, pattern: str, least: int = 10, share: float = 0.02) -> DataFrame:
    """(column_name, hits, share): columns of which enough cells look like identifiers, best first (ID-04)."""
    cells = df.select(*[F.col(q(c)).cast("string").alias(c) for c in df.columns]).unpivot([], [F.col(q(c)) for c in df.columns], "column_name", "value").filter("value is not null")
    found = cells.groupBy("column_name").agg(F.sum(F.col("value").rlike(pattern).cast("int")).alias("hits"), F.count("*").alias("n"))
    return found.filter((F.col("hits") >= least) & (F.col("hits") >= F.col("n") * share)).select("column_name", "hits", F.round(F.col("hits") / F.col("n"), 6).alias("share"))


def token(c: Column, strict: bool = False) -> Column:
    """An identifier without white space, in upper case, - for _; strict: without separators at all (ID-06). Empty is null."""
    x = F.upper(F.regexp_replace(c, r"[ \t\n\r\f\x0B]+", ""))
    x = F.regexp_replace(x, "[-_]", "") if strict else F.replace(x, F.lit("_"), F.lit("-"))
    return F.when(x != "", x)


def derived_keys(value: Column, column: Column) -> Column:
    """The keys that a cell gives, as a list of (key, rule) (ID-07).

    The patient part of a sample's barcode; a UUID as it is; a model's id in its usual form, if the column or the value is
    one; the value itself in columns that are patients', samples' (unless it was a barcode) or models'.
    """
    v, name = token(value), F.lower(column)
    has = lambda hints: F.lit(False) if not hints else F.coalesce(name.rlike("|".join(hints)), F.lit(False))
    barcode = F.nullif(F.regexp_extract(v, _PATIENT, 1), F.lit(""))
    model = F.regexp_replace(F.replace(F.replace(v, F.lit("ACH"), F.lit("ACH-")), F.lit("--"), F.lit("-")), "^ACH-?", "ACH-")
    by_name = (name == "ach") | name.startswith("depmap")
    entry = lambda key, rule: F.struct(key.alias("key"), F.lit(rule).alias("rule"))
    found = F.array(
        entry(barcode, "tcga_patient_from_value"), entry(F.when(v.rlike(_UUID), v), "uuid_as_patient"), entry(F.when(by_name | v.rlike(_MODEL), model), "depmap_ach"),
        entry(F.when(has(PATIENT_HINTS), v), "patient_col_value"), entry(F.when(has(SAMPLE_HINTS) & barcode.isNull(), v), "sample_col_value"), entry(F.when(has(MODEL_HINTS), v), "model_col_value"),
    )
    return F.array_distinct(F.filter(found, lambda x: x["key"].isNotNull()))


def custom_keys(value: Column, rules: Mapping[str, str]) -> Column:
    """Keys by rules of one's own, each a regular expression whose first group is the key (ID-08)."""
    found = F.array(*[F.struct(F.nullif(F.regexp_extract(value, p, 1), F.lit("")).alias("key"), F.lit(f"regex:{n}").alias("rule")) for n, p in rules.items()])
    return F.filter(found, lambda x: x["key"].isNotNull())


def barcode_level(c: Column) -> Column:
    """(key, level, confidence): a barcode's patient or sample part, else the value itself (ID-09)."""
    v = token(c)
    sample, patient = F.regexp_extract(v, r"^(TCGA-[A-Z0-9]{2}-[A-Z0-9]{4}-[0-9]{2}[A-Z])", 1), F.regexp_extract(v, _PATIENT, 1)
    pick = lambda a, b, d: F.when(sample != "", a).when(patient != "", b).otherwise(d)
    return F.when(v.isNotNull(), F.struct(pick(sample, patient, v).alias("key"), pick(F.lit("sample"), F.lit("patient"), F.lit("verbatim")).alias("level"), pick(F.lit(0.95), F.lit(0.9), F.lit(0.7)).alias("confidence")))


def patient_of(c: Column) -> Column:
    """The first three parts of a barcode (ID-10)."""
    return F.substring_index(token(c), "-", 3)


def namespace_hits(df: DataFrame, text: str, namespaces: Mapping[str, str] = NAMESPACES, examples: int = 5) -> DataFrame:
    """(namespace, n, n_distinct, examples): rows with an accession of each namespace, and the least of the accessions, in
    upper case, that stand first in a row (ID-11, AGG-23).

    A text is searched for a namespace only if it holds the letters that its accessions begin with.
    """
    rows = df.select(F.col(q(text)).alias("t"), F.lower(F.col(q(text))).alias("low"))

    def found(name: str, pattern: str) -> Column:
        letters = re.match(r"[A-Za-z]{2,}", pattern)
        first = F.nullif(F.regexp_extract("t", f"(?i)(?:^|[^A-Za-z0-9_])({pattern})(?:$|[^A-Za-z0-9_])", 1), F.lit(""))
        first = F.when(F.contains("low", F.lit(letters.group().lower())), first) if letters else first
        return F.struct(F.lit(name).alias("namespace"), F.upper(first).alias("example"))

    hits = F.filter(F.array(*[found(n, p) for n, p in namespaces.items()]), lambda x: x["example"].isNotNull())
    per = cut(rows.select(F.md5("t").alias("v"), F.inline(hits)).groupBy("namespace", "example", "v").agg(F.count("*").alias("n")))
    counts = per.groupBy("namespace").agg(F.sum("n").alias("n"), F.count("*").alias("n_distinct"))
    return counts.join(least_values(per, ["namespace"], "example", examples), "namespace")


def table_namespaces(df: DataFrame, name: str, namespaces: Mapping[str, str] = NAMESPACES) -> DataFrame:
    """(table_name, tags, mode, namespace, n): where a table has accessions, and what its header is about (ID-11).

    mode is header for accessions among the column names (wide for a table that is_header_like), value for rows with one in a
    text column; n counts columns or rows. The header is read by the driver, the rows in one pass.
    """
    mode = "wide" if is_header_like(df.columns) else "header"
    hit = lambda c, p: re.search(rf"(?i)(?:^|[^A-Za-z0-9_])(?:{p})(?:$|[^A-Za-z0-9_])", c)
    counts = [(mode, n, sum(bool(hit(c, p)) for c in df.columns)) for n, p in namespaces.items()]
    header = df.sparkSession.createDataFrame([r for r in counts if r[2]], "mode string, namespace string, n bigint")
    texts = [f.name for f in df.schema if f.dataType.simpleString() == "string"]
    rows = header
    if texts:
        cells = df.select(F.concat_ws(" ", *[F.col(q(c)) for c in texts]).alias("t"))
        rows = header.unionByName(namespace_hits(cells, "t", namespaces).select(F.lit("value").alias("mode"), "namespace", "n"))
    tags = header_tags(F.lit(" ".join(df.columns)))
    return rows.select(F.lit(name).alias("table_name"), F.array_join(tags, "|").alias("tags"), "mode", "namespace", "n")


def accession_of(path: Column) -> Column:
    """The accession in a file's name, else in its folders, else its stem (ID-12)."""
    pattern = r"((?:GSE|GSM|SRR|SRX|SRS|ERR|ERX|ERP|PXD)[0-9]+|PRJ[A-Z]{2}[0-9]+|E-[A-Z]{4}-[0-9]+|TCGA-[A-Z0-9]{2,4}(?:-[A-Z0-9]{4})?)"
    name = F.substring_index(path, "/", -1)
    parents = F.regexp_replace(path, r"[^/]*$", "")
    some = lambda c: F.nullif(F.regexp_extract(F.upper(c), pattern, 1), F.lit(""))
    return F.coalesce(some(name), some(parents), F.regexp_replace(name, r"\.[^.]*$", ""))


def well_formed(c: Column) -> Column:
    """Whether an identifier holds letters, digits, points, dashes and underscores only (ID-16)."""
    return c.rlike(r"^[A-Za-z0-9_.-]+$")


def role_crosswalk(rows: DataFrame, key: str, role: str, source: str, raw: str, roles: Sequence[str], examples: int = 5) -> DataFrame:
    """One row per key: its roles and sources, sorted and joined, its least raw ids, and whether it has each role (AGG-13, ID-14, JN-15).

    Null is a key. Roles and sources are as many as a study has kinds of files; raw ids, of which a key (null above all) can
    have any number, are never gathered.
    """
    values = rows.select(F.col(q(key)).alias("key"), F.col(q(role)).alias("role"), F.col(q(source)).alias("source"), F.col(q(raw)).alias("raw"))
    once = lambda c, to: values.groupBy("key", c).agg(F.lit(1)).groupBy("key").agg(F.array_join(F.array_sort(F.collect_list(c)), ";").alias(to))
    per_role = values.groupBy("key", "role").agg(F.lit(1)).groupBy("key").agg(F.array_join(F.array_sort(F.collect_list("role")), ";").alias("roles"), *[F.coalesce(F.bool_or(F.col("role") == r), F.lit(False)).alias(f"in_{r}") for r in roles])
    least = least_values(values, ["key"], "raw", examples, "raw_ids").withColumn("raw_ids", F.array_join("raw_ids", ";"))
    out = per_role
    for part in (once("source", "sources"), least):
        other = part.withColumnRenamed("key", "_k")
        out = out.join(other, F.col("key").eqNullSafe(F.col("_k")), "left").drop("_k")
    return out.select("key", "roles", "sources", F.coalesce("raw_ids", F.lit("")).alias("raw_ids"), *[f"in_{r}" for r in roles])


def best_crosswalk(rows: DataFrame, column: str, value: str, key: str, confidence: str) -> DataFrame:
    """For each (column, value) the key of greatest mean confidence, then the most frequent, then the least (AGG-10, WIN-03)."""
    means = rows.groupBy(column, value, key).agg(F.round(F.avg(confidence), 6).alias("mean_confidence"), F.count("*").alias("n"))
    best = means.groupBy(column, value).agg(F.min_by(F.struct(key, "mean_confidence", "n"), F.struct(-F.col("mean_confidence"), -F.col("n"), F.col(key))).alias("b"))
    return best.select(column, value, "b.*")


def least_roots(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Of each of the numbers below n the least that the links u - v join it with: union-find with whole arrays.

    Each round hooks the larger root of every link under the smallest root it meets, then halves paths until all numbers
    point at roots; links within one tree are dropped.
    """
    parent = np.arange(n)
    while len(u):
        low, high = np.minimum(u, v), np.maximum(u, v)
        np.minimum.at(parent, high, low)
        while True:
            above = parent[parent]
            if np.array_equal(above, parent):
                break
            parent = above
        u, v = parent[u], parent[v]
        apart = u != v
        u, v = u[apart], v[apart]
        if len(u):
            u, v = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)]), axis=1)
    return parent


def _forests(limit: int):
    """Of each partition's links, at most ``limit`` held at once, the nodes with the least node of their tree."""

    def forest(links: list[pa.RecordBatch]) -> pa.Table:
        table = pa.Table.from_batches(links)
        both = pa.chunked_array([*table.column(0).chunks, *table.column(1).chunks]).combine_chunks().dictionary_encode()
        nodes, codes = both.dictionary, both.indices.to_numpy()
        order = pc.sort_indices(nodes).to_numpy()
        rank = np.empty(len(nodes), np.int64)
        rank[order] = np.arange(len(nodes))
        u, v = rank[codes[: len(table)]], rank[codes[len(table) :]]
        return pa.table([nodes.take(pa.array(order)), nodes.take(pa.array(order[least_roots(u, v, len(nodes))]))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n > limit:
                yield from forest(held).to_batches(max_chunksize=100_000)
                held, n = [], 0
        if held:
            yield from forest(held).to_batches(max_chunksize=100_000)

    return run


def connected(edges: DataFrame, limit: int = 1_000_000) -> DataFrame:
    """(node, root): the least node of each component of the edges (src, dst), which have one type (GR-01); null ends are none.

    Union-find runs over each partition as it lies, at most ``limit`` links at once, and keeps the spanning forest alone: a
    node leaves a partition as one row. Each node then gets the least of its roots (combined before it is sent), and where a
    node has several, they are linked: a graph of roots, in which every link's larger end goes away, is the next level. Its
    roots are handed down by joins in which hot roots are spread. Each level's tables are written, so that lineage stays
    short; their number grows with the logarithm of the partitions a component lies in.
    """
    kind = edges.schema["src"].dataType.simpleString()
    graph = edges.select(F.col("src").alias("a"), F.col("dst").cast(kind).alias("b")).filter("a is not null and b is not null")
    levels: list[DataFrame] = []
    while True:
        forest = cut(graph.mapInArrow(_forests(limit), f"a {kind}, b {kind}"))
        levels.append(cut(forest.groupBy("a").agg(F.min("b").alias("b"))))
        heads = levels[-1].select("a", F.col("b").alias("head"))
        graph = cut(forest.join(heads, "a").filter("b <> head").select(F.col("b").alias("a"), F.col("head").alias("b")).distinct())
        if graph.isEmpty():
            break
    top = levels.pop().toDF("b", "root")
    for below in reversed(levels):
        counts = below.groupBy("b").agg(F.count("*").alias("n")).join(top, "b", "left")
        joined = salted_join(below, counts, "b", F.col("a"), "n", below.count())
        top = cut(joined.select("a", F.coalesce("root", "b")).toDF("b", "root"))
    return top.toDF("node", "root")


def reached(links: DataFrame, starts: DataFrame, most_steps: int) -> DataFrame:
    """(node, depth): what the links (src, dst) reach from the starts (src) within so many steps, and after how few (GR-07).

    Breadth first: each step joins what is new with the links and leaves out what was visited; steps are written tables, at
    most most_steps of them.
    """
    visited = cut(starts.select(F.col("src").alias("node")).filter("node is not null").distinct().withColumn("depth", F.lit(0)))
    new = visited
    for step in range(1, most_steps + 1):
        ahead = new.join(links.filter("dst is not null"), F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct()
        new = cut(ahead.join(visited.select("node"), "node", "left_anti").withColumn("depth", F.lit(step)))
        if new.isEmpty():
            break
        visited = visited.unionByName(new)
    return visited


def shortest_names(components: DataFrame) -> DataFrame:
    """(node, name): each component's shortest node, then the least, as its name (GR-02)."""
    names = components.groupBy("root").agg(F.min_by("node", F.struct(F.length("node"), "node")).alias("name"))
    return components.join(names, "root").select("node", "name")


def component_sizes(components: DataFrame, examples: int = 50) -> DataFrame:
    """(root, size, members): how many nodes each component has, and the least of them (AGG-29); no component is gathered."""
    sizes = components.groupBy("root").agg(F.count("*").alias("size"))
    return sizes.join(least_values(components, ["root"], "node", examples, "members"), "root")


def master_index(components: DataFrame) -> DataFrame:
    """(master_patient_id, patient_key): a number for each component, in the order of roots (WIN-09, GR-01, JN-12)."""
    ids = numbered(components.select("root").distinct(), "root", "master_patient_id")
    return components.join(ids, "root").select("master_patient_id", F.col("node").alias("patient_key"))
