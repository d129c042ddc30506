"""Entity-attribute-value rows into one typed row per entity, by characteristic sets."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for a missing value, compared trimmed and in lower case.
PLACEHOLDER_TEXTS = ["", "-", "--", ".", "?", "#n/a", "#na", "n/a", "na", "n.a.", "nan", "null", "none", "nil", "missing", "unknown", "unk", "not done", "not available", "not applicable", "nd", "tbd", "-9999", "-9999.0"]
# Numbers that stand for a missing value.
PLACEHOLDER_NUMBERS = [-9999.0]
# Words for true and false, in lower case.
TRUE_TEXTS = ["true", "t", "yes", "y", "ja", "j", "si", "sí", "oui", "positive", "positiv", "pos", "+", "present", "1", "1.0"]
FALSE_TEXTS = ["false", "f", "no", "n", "nein", "non", "negative", "negativ", "neg", "absent", "0", "0.0"]
# Fixed values: (unit as written, unit of the codebook, factor), units in lower case.
UNIT_FACTORS = [("cm", "mm", 10.0), ("µm", "nm", 1000.0), ("um", "nm", 1000.0), ("g", "mg", 1000.0), ("µg", "mg", 0.001), ("ug", "mg", 0.001), ("v", "mv", 1000.0)]

#: So many cells of the united table are laid out at once.
LAID_OUT = 2_000_000
#: A codebook larger than this is refused: its entries are the columns of the result.
MAX_ATTRIBUTES = 5000


@dataclass(frozen=True)
class Attribute:
    name: str
    kind: str
    unit: str | None


def attribute_key(name: Column) -> Column:
    """Attribute names that differ only in case, outer white space or separators have one key."""
    return F.regexp_replace(F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}%]+", "_"), "^_+|_+$", "")


def read_codebook(dictionary: DataFrame) -> list[Attribute]:
    """The codebook's entries by name; an entry without a name is left out, of repeated names the first kind counts."""
    rows = (
        dictionary.filter(F.length(attribute_key(F.col("feature"))) > 0)
        .groupBy(attribute_key(F.col("feature")).alias("key"))
        .agg(F.min(F.struct("value_kind", "feature", "unit")).alias("e"))
        .select("key", "e.*").orderBy("feature").limit(MAX_ATTRIBUTES + 1).collect()
    )
    if len(rows) > MAX_ATTRIBUTES:
        raise ValueError(f"the codebook has more than {MAX_ATTRIBUTES} attributes")
    return [Attribute(r["feature"], r["value_kind"] or "category", r["unit"]) for r in rows]


_NUMBER = r"[+-]?[0-9][0-9.,']*(?:[eE][+-]?[0-9]+)?|[+-]?[.,][0-9]+"


def unit_factors(unit: str | None) -> dict[str, float]:
    """What a number is multiplied by for each unit that may stand after it, in lower case; no unit and one's own count 1."""
    own = "".join((unit or "").lower().split())
    return {written: by for written, target, by in UNIT_FACTORS if target == own} | {"": 1.0, own: 1.0}


def parse_number(rows: DataFrame, text: str, factors: str, to: str) -> DataFrame:
    """rows with a column ``to``: the number that column text states, by the unit_factors in column factors, else null.

    Understood are signs (also U+2212), exponents, a decimal point or comma, thousands separators, a unit after the
    number, and outer white space. Of two kinds of separator the last is the decimal one; one separator that comes more
    than once separates thousands. Each step is a projection of its own, so that no expression is evaluated twice and the
    generated code stays small enough to be compiled.
    """
    number = lambda sign: F.length("_digits") - F.length(F.replace("_digits", F.lit(sign), F.lit("")))
    commas, points = F.col("_commas"), F.col("_points")
    point_last = F.instr(F.substring_index("_digits", ".", -1), ",") == 0
    drop = F.when((commas > 0) & (points > 0), F.when(point_last, ",").otherwise(".")).when(commas > 1, ",").when(points > 1, ".").otherwise("'")
    return (
        rows.withColumn("_clean", F.replace(F.regexp_replace(text, r"(?U)\s+", ""), F.lit("−"), F.lit("-")))
        .withColumn("_digits", F.regexp_extract("_clean", f"^({_NUMBER})", 1))
        .withColumn("_factor", F.try_element_at(factors, F.lower(F.substr("_clean", F.length("_digits") + 1))))
        .withColumns({"_commas": number(","), "_points": number(".")})
        .withColumn("_digits", F.replace(F.replace(F.replace("_digits", F.lit("'"), F.lit("")), drop, F.lit("")), F.lit(","), F.lit(".")))
        .withColumn(to, F.col("_digits").try_cast("double") * F.col("_factor"))
        .drop("_clean", "_digits", "_factor", "_commas", "_points")
    )


def typed_values(facts: DataFrame, book: list[Attribute]) -> DataFrame:
    """Rows (entity, slot, at, tie, num, txt) of the facts; slot is the attribute's place in the codebook, null if it has none.

    Booleans are 0 and 1 in num. Null values, placeholders, and texts that aren't of the attribute's kind carry no value:
    num and txt are null then. They aren't filtered here, since that would evaluate the parsing twice.
    """
    spark = facts.sparkSession
    schema = "_key string, slot int, _kind string, _factors map<string,double>"
    entries = spark.createDataFrame([(a.name, i, a.kind, unit_factors(a.unit)) for i, a in enumerate(book)], schema).withColumn("_key", attribute_key(F.col("_key")))
    rows = facts.filter(F.col("sample_id").isNotNull()).select(
        F.col("sample_id").alias("entity"), F.coalesce(attribute_key(F.col("feature")), F.lit("")).alias("_key"), F.col("value_num").cast("double").alias("_num"),
        F.col("value_txt").alias("_raw"), F.lower(F.trim(F.regexp_replace("value_txt", r"(?U)\s+", " "))).alias("_txt"), F.col("measured_at").alias("at"), F.struct("loaded_at", "fact_id").alias("tie"),
    )
    rows = rows.join(F.broadcast(entries), "_key", "left")
    no_number = F.isnan("_num") | F.col("_num").isin(PLACEHOLDER_NUMBERS) | (F.abs("_num") == float("inf"))
    rows = rows.withColumns({"_num": F.when(~no_number, F.col("_num")), "_txt": F.when(~F.col("_txt").isin(PLACEHOLDER_TEXTS), F.col("_txt"))})
    rows = rows.withColumn("_raw", F.when(F.col("_txt").isNotNull() & F.col("_num").isNull() & (F.col("_kind") == "numeric"), F.col("_raw")))
    rows = parse_number(rows, "_raw", "_factors", "_parsed")
    number, text, parsed = F.col("_num"), F.col("_txt"), F.col("_parsed")
    truth = F.when(text.isin(TRUE_TEXTS), 1.0).when(text.isin(FALSE_TEXTS), 0.0)
    parsed = F.when(~parsed.isin(PLACEHOLDER_NUMBERS) & ~F.isnan(parsed), parsed)
    num = (
        F.when(F.col("_kind") == "numeric", F.coalesce(number, parsed))
        .when(F.col("_kind") == "boolean", F.coalesce(F.when(number.isin(0.0, 1.0), number), truth))
    )
    txt = F.when(~F.col("_kind").isin("numeric", "boolean"), F.coalesce(text, number.cast("string")))
    return rows.select("entity", "slot", "at", "tie", (num + 0.0).alias("num"), txt.alias("txt"))


def _united(names: list[str], kinds: list[str]):
    """Rows (sample_id, signature, cells), sorted by signature, to rows of the united table.

    Rows of one signature form a dense table: their cells lie row by row, one for each attribute of the set and no others.
    Each such table has its columns placed among all columns, by attribute; columns that a set lacks are null.
    """
    width = len(names)

    def laid_out(ids: pa.Array, signatures: pa.Array, cells: pa.ListArray) -> pa.RecordBatch:
        n, flat = len(ids), cells.flatten()
        slots, numbers, texts = flat.field(0).to_numpy(zero_copy_only=False), flat.field(1), flat.field(2)
        lengths = pc.list_value_length(cells).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(lengths)])
        edges = np.flatnonzero(pc.not_equal(signatures[1:], signatures[:-1]).to_numpy(zero_copy_only=False)) + 1
        at = np.full((n, width), -1, np.int64)
        for first, last in zip([0, *edges.tolist()], [*edges.tolist(), n], strict=True):
            if (k := lengths[first]) > 0:
                low = starts[first]
                dense = np.arange(low, starts[last]).reshape(last - first, k)
                at[first:last, slots[low : low + k]] = dense
        columns = [ids]
        for j, kind in enumerate(kinds):
            where = pa.array(at[:, j], mask=at[:, j] < 0)
            columns.append(numbers.take(where) if kind == "numeric" else pc.equal(numbers.take(where), 1.0) if kind == "boolean" else texts.take(where))
        return pa.record_batch(columns, names=["sample_id", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, LAID_OUT // width)
        for batch in batches:
            for low in range(0, batch.num_rows, step):
                yield laid_out(*(c.slice(low, step) for c in batch.columns))

    return run


def wide_table(facts: DataFrame, dictionary: DataFrame) -> DataFrame:
    """One row per sample_id with one typed column per attribute of the codebook, null where the sample has no value.

    The value with the latest measured_at counts; ties go to the latest loaded_at, then the largest fact_id; a null
    measured_at is older than any other. A sample whose facts carry no value at all still gets its row of nulls; facts
    without a sample_id have none. Repeated facts change nothing. Names outside the codebook have no column
    (unknown_attributes lists them); columns that the facts have beside those named are ignored. Numbers are DOUBLE,
    boolean attributes BOOLEAN, all others STRING (lower case, trimmed, single blanks).

    Entities are grouped by characteristic set, the exact set of attributes that they have values of: within a partition
    their rows are sorted by that signature, each signature's rows make a dense table with just its columns, and the tables
    are united by name with missing columns null. Any number of sets will do; real stores can have as many as entities. Sets
    aren't brought together across partitions, so a set that a third of the entities share makes no partition large.

    Facts are read once and sent twice: to the value of each (entity, attribute), combined before it is sent, so a hot
    sample costs nothing; and to one packed row per entity, whose cells are at most the codebook's.
    """
    book = read_codebook(dictionary)
    if not book:
        return facts.select("sample_id").filter("sample_id is not null").distinct()
    values = typed_values(facts, book)
    carries = F.col("num").isNotNull() | F.col("txt").isNotNull()
    best = values.groupBy("entity", "slot").agg(F.max(F.when(F.col("slot").isNotNull() & carries, F.struct("at", "tie", "num", "txt"))).alias("v"))
    cells = F.array_sort(F.collect_list(F.when(F.col("v").isNotNull(), F.struct("slot", "v.num", "v.txt"))))
    packed = best.groupBy("entity").agg(cells.alias("cells")).select("entity", F.array_join(F.transform("cells", lambda c: c["slot"].cast("string")), ",").alias("signature"), "cells")
    types = {"numeric": T.DoubleType(), "boolean": T.BooleanType()}
    schema = T.StructType([T.StructField("sample_id", T.StringType()), *[T.StructField(a.name, types.get(a.kind, T.StringType())) for a in book]])
    return packed.sortWithinPartitions("signature").mapInArrow(_united([a.name for a in book], [a.kind for a in book]), schema)


def cell_text(name: str, kind: str) -> Column:
    """A wide table's value as text: numbers with four decimals, booleans as true and false."""
    c = F.col(f"`{name}`")
    if kind == "numeric":
        return F.when(c.isNotNull(), F.coalesce(F.round(c, 4).try_cast("decimal(24,4)").cast("string"), F.format_string("%.4f", c)))
    return c.cast("string")


def long_cells(wide: DataFrame, book: list[Attribute]) -> DataFrame:
    """One row (sample_id, feature, cell) per non-null cell of a wide table."""
    if not book:
        return wide.sparkSession.createDataFrame([], "sample_id string, feature string, cell string")
    texts = wide.select("sample_id", *[cell_text(a.name, a.kind).alias(a.name) for a in book])
    return texts.unpivot(["sample_id"], [F.col(f"`{a.name}`") for a in book], "feature", "cell").filter("cell is not null")


def unknown_attributes(facts: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Attribute names that the codebook lacks, with their number of facts."""
    known = dictionary.select(attribute_key(F.col("feature")).alias("feature_key")).distinct()
    return facts.groupBy(attribute_key(F.col("feature")).alias("feature_key")).agg(F.count("*").alias("n")).join(F.broadcast(known), "feature_key", "left_anti")
