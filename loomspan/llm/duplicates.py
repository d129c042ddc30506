"""Duplicates hidden by formatting: commutative multiset fingerprints, verified without sorting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.session import cut
from loomspan.skew import salted_join

#: The words of a pooled group of fields count together, whichever of its fields holds them.
RECORD = {"record": ("term", "term_type")}


def words_of(columns: Sequence[str]) -> Column:
    """The runs of letters and digits of the columns together, in lower case; a null column has none."""
    return F.regexp_extract_all(F.lower(F.concat_ws(" ", *columns)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def pairs_of(groups: Mapping[str, Sequence[str]]) -> Column:
    """Every (field name, word) pair of a record, in any order; of a sole group of fields the words alone."""
    if len(groups) == 1:
        return words_of(*groups.values())
    return F.concat(*[F.transform(words_of(columns), lambda w, name=name: F.concat(F.lit(f"{name}="), w)) for name, columns in groups.items()])


def multiset_fingerprint(pairs: Column) -> Column:
    """160 bits that depend on how often each pair occurs, not on order: the sums of four 32-bit hashes, and the number."""

    def sum_of(seed: int, shift: int) -> Column:
        part = lambda x: F.shiftrightunsigned(F.xxhash64(F.lit(seed), x), shift).bitwiseAND(F.lit(0xFFFFFFFF))
        return F.aggregate(pairs, F.lit(0).cast("bigint"), lambda total, x: total + part(x))

    return F.concat_ws(".", F.size(pairs), *[F.hex(sum_of(seed, shift)) for seed in (11, 47) for shift in (0, 32)])


def same_multiset(a: Column, b: Column) -> Column:
    """Whether each pair occurs in both equally often; counts are compared, nothing is sorted."""
    count = lambda xs, w: F.size(F.filter(xs, lambda x: x == w))
    return (F.size(a) == F.size(b)) & F.forall(F.array_distinct(a), lambda w: count(a, w) == count(b, w))


def duplicate_groups(records: DataFrame, id_column: str = "vocab_id", required: str = "term", groups: Mapping[str, Sequence[str]] = RECORD) -> DataFrame:
    """(record_id, keep_id, n_copies): every record with the smallest id of its group of copies and the group's size.

    Two records are copies if the words of each group of fields are the same ones equally often, whatever separates,
    orders or capitalizes them. Records whose required field is null or blank are left out. Records without an id count as
    copies but have no row; a record delivered repeatedly under one id is one record. A required field without any letter
    or digit has no words, and equals others of that kind. Other columns are ignored; an empty input gives no rows.

    Pairs are hashed one by one and combined by addition, so no record's words are sorted; a fingerprint's group is combined
    before it is sent, and its members are compared with its smallest record in a join whose hot groups are salted. Should
    a member differ, its words' counts become part of the fingerprint for it, so that a collision of hashes costs nothing
    but that step.
    """
    kept = records.filter(F.length(F.regexp_replace(F.col(required), r"(?U)\s+", "")) > 0)
    rows = kept.select(F.col(id_column).alias("record_id"), pairs_of(groups).alias("pairs"))
    rows = rows.select("record_id", multiset_fingerprint(F.col("pairs")).alias("fingerprint"), F.array_join("pairs", " ").alias("text"))
    no_id = F.col("record_id").isNull()
    ids = rows.groupBy("fingerprint", "record_id", F.when(no_id, F.col("text")).alias("words")).agg(F.first("text").alias("text"), F.count("*").alias("rows"))
    ids = cut(ids.select("fingerprint", "record_id", "text", F.when(no_id, F.col("rows")).otherwise(1).alias("copies")))
    heads = ids.groupBy("fingerprint").agg(F.count("*").alias("n"), F.sum("copies").alias("n_copies"), F.min_by("text", "record_id").alias("head"), F.min("record_id").alias("keep_id"))
    heads = cut(heads)
    total = heads.agg(F.sum("n")).first()[0] or 0
    joined = salted_join(ids, heads, "fingerprint", F.concat_ws(" ", "record_id", F.when(no_id, F.col("text"))), "n", total)
    joined = joined.withColumns({"pairs": F.split("text", " "), "other": F.split("head", " ")})
    joined = joined.withColumn("same", (F.col("text") == F.col("head")) | same_multiset(F.col("pairs"), F.col("other")))
    counted = F.to_json(F.map_from_entries(F.transform(F.array_sort(F.array_distinct("pairs")), lambda w: F.struct(w, F.size(F.filter("pairs", lambda x: x == w))))))
    settled = cut(joined.select("record_id", "keep_id", "copies", "n_copies", "same", F.when(~F.col("same"), F.concat("fingerprint", F.lit("|"), counted)).alias("exact")))
    apart = settled.filter("not same")
    if apart.isEmpty():
        return settled.filter("record_id is not null").select("record_id", "keep_id", "n_copies")
    again = apart.groupBy("exact").agg(F.min("record_id").alias("keep_id"), F.sum("copies").alias("n_copies"))
    split = apart.select("record_id", "exact").join(again, "exact").select("record_id", "keep_id", "n_copies")
    stay = settled.filter("same").select("record_id", "keep_id", "copies")
    sizes = stay.groupBy("keep_id").agg(F.sum("copies").alias("n_copies"))
    return stay.join(sizes, "keep_id").select("record_id", "keep_id", "n_copies").unionByName(split).filter("record_id is not null")


def collapse(records: DataFrame, id_column: str = "vocab_id", required: str = "term", groups: Mapping[str, Sequence[str]] = RECORD) -> DataFrame:
    """One record for each group of copies, the one of smallest id, with its number of copies (itself included)."""
    found = duplicate_groups(records, id_column, required, groups)
    heads = found.filter("record_id = keep_id").select(F.col("keep_id").alias("_keep"), "n_copies")
    own = [f"`{c}`" for c in records.columns if c != "n_copies"]
    first = records.select(*own).dropDuplicates([id_column])
    return first.join(heads, F.col(id_column) == F.col("_keep")).drop("_keep")


def copies(records: DataFrame, **options) -> DataFrame:
    """(keep_id, copy_id): every record that isn't the smallest of its group."""
    found = duplicate_groups(records, **options)
    return found.filter("record_id <> keep_id").select("keep_id", F.col("record_id").alias("copy_id"))
