"""Frequency of every distinct term, by recursive radix spilling and out-of-core aggregation."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.session import cut

#: Of one radix partition so much is aggregated at once, little enough that its hash tables stay in a core's cache; a larger
#: one is split by further hash bits first.
PARTITION_BYTES = 4 << 20
#: Hash bits per level of splitting.
RADIX_BITS = 4
#: What one aggregation may hold in memory before it spills by itself.
AGGREGATE_MEMORY = "192MB"

#: A term with more than this share of all rows is hot: its rows are spread over all partitions.
HOT_SHARE = 0.001
#: Counters of the search for hot terms; it errs by at most one in so many rows, so few enough terms are hot.
COUNTERS = 4000

_PARTIAL = "term string, source_file string, freq bigint, n_files bigint, hot boolean"
_ONCE = """SELECT term, source_file, freq, hot FROM (
               SELECT term, source_file, hot, max(freq) AS freq FROM rows WHERE occ_id IS NOT NULL GROUP BY occ_id, term, source_file, hot
               UNION ALL SELECT term, source_file, hot, freq FROM rows WHERE occ_id IS NULL)"""
#: What a radix partition is aggregated to: of occurrences the final row of each term, or, of hot terms, one by source file;
#: of those the share of this partition in the term.
_OCCURRENCES = f"""WITH once AS ({_ONCE})
    SELECT term, NULL AS source_file, sum(freq) AS freq, count(DISTINCT source_file) AS n_files, false AS hot FROM once WHERE NOT hot GROUP BY term
    UNION ALL SELECT term, source_file, sum(freq), NULL, true FROM once WHERE hot GROUP BY term, source_file"""
_BY_FILE = """SELECT term, NULL AS source_file, sum(freq) AS freq, count(source_file) AS n_files, true AS hot
    FROM (SELECT term, source_file, sum(freq) AS freq FROM rows GROUP BY term, source_file) GROUP BY term"""


def term_key(term: Column) -> Column:
    """Lower case, trimmed, each inner run of white space as one blank; a blank term is null."""
    key = F.regexp_replace(F.regexp_replace(F.lower(term), r"(?U)\s+", " "), "^ | $", "")
    return F.when(F.length(key) > 0, key)


def _scratch(local_dirs: str) -> str:
    """A folder of this task's own on the disks that the engine itself spills to; it holds nothing that another task needs."""
    named = os.environ.get("LOCAL_DIRS") or os.environ.get("SPARK_LOCAL_DIRS") or local_dirs
    return tempfile.mkdtemp(prefix="radix-", dir=next(d for d in named.split(",") if os.path.isdir(d)))


class _Aggregate:
    """Aggregations of tables in memory that spill into the folder; one database for all of a task."""

    def __init__(self, folder: str, sql: str) -> None:
        import duckdb

        self.sql = sql
        self.db = duckdb.connect(config={"memory_limit": AGGREGATE_MEMORY, "threads": 1, "temp_directory": folder, "preserve_insertion_order": False})

    def __call__(self, rows: pa.Table) -> pa.Table:
        self.db.register("rows", rows)
        try:
            return self.db.sql(self.sql).to_arrow_table()
        finally:
            self.db.unregister("rows")


class _Spill:
    """The 2**RADIX_BITS files that rows are split into by the hash bits of one level."""

    def __init__(self, folder: str, level: int) -> None:
        self.folder, self.level = tempfile.mkdtemp(dir=folder), level
        self.writers: dict[int, pa.RecordBatchFileWriter] = {}
        self.size: dict[int, int] = {}

    def add(self, rows: pa.Table | pa.RecordBatch) -> None:
        import numpy as np

        bits = (rows.column("h").to_numpy(zero_copy_only=False) >> (RADIX_BITS * self.level)) & ((1 << RADIX_BITS) - 1)
        order = np.argsort(bits, kind="stable")
        edges = np.searchsorted(bits[order], np.arange((1 << RADIX_BITS) + 1))
        split = rows.take(pa.array(order))
        for b in np.flatnonzero(np.diff(edges)).tolist():
            part = split.slice(int(edges[b]), int(edges[b + 1] - edges[b]))
            if b not in self.writers:
                self.writers[b] = pa.ipc.new_file(self.path(b), part.schema)
                self.size[b] = 0
            self.writers[b].write(part)
            self.size[b] += part.nbytes

    def path(self, bucket: int) -> str:
        return f"{self.folder}/{bucket}.arrow"

    def parts(self) -> Iterator[tuple[int, pa.Table]]:
        for b, w in self.writers.items():
            w.close()
        for b in list(self.writers):
            with pa.memory_map(self.path(b)) as source:
                yield self.size[b], pa.ipc.open_file(source).read_all()
            os.remove(self.path(b))


def _drain(spill: _Spill, folder: str, limit: int, aggregate: _Aggregate) -> Iterator[pa.Table]:
    for size, rows in spill.parts():
        if size <= limit or RADIX_BITS * (spill.level + 2) > 64:
            yield aggregate(rows)
        else:
            deeper = _Spill(folder, spill.level + 1)
            for batch in rows.to_batches(max_chunksize=50_000):
                deeper.add(batch)
            del rows
            yield from _drain(deeper, folder, limit, aggregate)


def _radix_aggregate(limit: int, sql: str, local_dirs: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = _scratch(local_dirs)
        try:
            aggregate = _Aggregate(folder, sql)
            held, held_bytes, spill = [], 0, None
            for batch in batches:
                if not batch.num_rows:
                    continue
                held.append(batch)
                held_bytes += batch.nbytes
                if held_bytes > limit:
                    spill = spill or _Spill(folder, 0)
                    spill.add(pa.Table.from_batches(held).combine_chunks())
                    held, held_bytes = [], 0
            if spill is None:
                tables = iter([aggregate(pa.Table.from_batches(held))] if held else [])
            else:
                if held:
                    spill.add(pa.Table.from_batches(held).combine_chunks())
                tables = _drain(spill, folder, limit, aggregate)
            schema = pa.schema([("term", pa.string()), ("source_file", pa.string()), ("freq", pa.int64()), ("n_files", pa.int64()), ("hot", pa.bool_())])
            for table in tables:
                yield from table.cast(schema).to_batches(max_chunksize=50_000)
            aggregate.db.close()
        finally:
            shutil.rmtree(folder, ignore_errors=True)

    return run


def _heavy(counters: int):
    """Of each partition the counters of the most frequent hashes (Misra and Gries), each short by at most rows / counters,
    and, under null, its number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        keys, counts, rows = np.empty(0, np.int64), np.empty(0, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            new, n = np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_counts=True)
            keys, where = np.unique(np.concatenate([keys, new]), return_inverse=True)
            counts = np.bincount(where, np.concatenate([counts, n]), len(keys)).astype(np.int64)
            if len(keys) > counters:
                counts = counts - np.partition(counts, -counters - 1)[-counters - 1]
                keys, counts = keys[counts > 0], counts[counts > 0]
        yield pa.record_batch([pa.array([*keys.tolist(), None], pa.int64()), pa.array([*counts.tolist(), rows], pa.int64())], names=["h", "n"])

    return run


def hot_hashes(hashes: DataFrame, share: float = HOT_SHARE, counters: int = COUNTERS) -> list[int]:
    """The hashes (column h) that more than the share of all rows have, and perhaps some nearly as frequent ones.

    All rows are counted, with a bounded number of counters a partition. At most 1 / (share - 1 / counters) are returned.
    """
    per = cut(hashes.select("h").mapInArrow(_heavy(counters), "h bigint, n bigint"))
    total = per.filter("h is null").agg(F.sum("n")).first()[0] or 0
    return [r["h"] for r in per.filter("h is not null").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") > total * (share - 1 / counters)).collect()]


def term_frequencies(occurrences: DataFrame, rare: int = 3, common: float = 0.5, partition_bytes: int = PARTITION_BYTES, hot_share: float = HOT_SHARE) -> DataFrame:
    """(term, freq, n_files, rare, common): every distinct term with its total freq and number of source files.

    Terms are compared in lower case, trimmed, with single blanks; null and blank terms are left out. Rows with one occ_id
    are one occurrence, counted once (their largest freq, should they differ); rows without an occ_id count each. A null
    freq counts as 1, a null source_file as no file. rare: freq is at most ``rare``. common: the term occurs in more than
    the share ``common`` of all distinct non-null source files of the whole input, those of blank terms included. Other
    columns are ignored; an empty input gives no rows; texts of any length are terms like others.

    Terms are partitioned by hash. Within a task, rows beyond partition_bytes go to disk by four hash bits at a time until
    each part is small enough for one out-of-core aggregation, which gives the term's final row. Only hot terms, those with
    more than ``hot_share`` of all rows (found first, by a bounded summary of all rows), are spread: a salt from occ_id, so
    that redelivered rows still meet, joins their hash; what leaves the tasks, one row a file, goes through the same
    aggregation by hash of term and file, and the shares of a hot term (one a partition) are added up.
    """
    spark = occurrences.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    local_dirs = spark.sparkContext.getConf().get("spark.local.dir", "/tmp")  # where the engine spills, unless the cluster names other disks
    rows = occurrences.select(F.col("occ_id").cast("bigint").alias("occ_id"), term_key(F.col("term")).alias("term"), "source_file", F.coalesce(F.col("freq").cast("bigint"), F.lit(1)).alias("freq"))
    rows = rows.filter("term is not null").withColumn("h", F.xxhash64("term"))
    hot = hot_hashes(rows.select("h"), hot_share)
    salt = F.when(F.col("occ_id").isNull(), F.floor(F.rand(7) * parts)).otherwise(F.pmod(F.xxhash64("occ_id"), F.lit(parts)))
    rows = rows.withColumn("hot", F.col("h").isin(hot)).withColumn("h", F.when(F.col("hot"), F.xxhash64("h", salt)).otherwise(F.col("h")))
    first = rows.repartition(parts, "h").mapInArrow(_radix_aggregate(partition_bytes, _OCCURRENCES, local_dirs), _PARTIAL)
    if hot:
        first = cut(first)
        by_file = first.filter("hot").drop("n_files").withColumn("h", F.xxhash64("term", "source_file")).repartition(parts, "h")
        shares = by_file.mapInArrow(_radix_aggregate(partition_bytes, _BY_FILE, local_dirs), _PARTIAL)
        first = first.filter("not hot").unionByName(shares.groupBy("term").agg(F.sum("freq").alias("freq"), F.sum("n_files").alias("n_files")), allowMissingColumns=True)
    files = occurrences.agg(F.count_distinct("source_file").alias("all_files"))
    marked = first.join(F.broadcast(files), how="cross")  # one row, by construction
    return marked.select("term", "freq", "n_files", (F.col("freq") <= rare).alias("rare"), (F.col("n_files") > F.col("all_files") * common).alias("common"))


def marked_terms(frequencies: DataFrame) -> DataFrame:
    """(term, mark): one row per term marked rare, one per term marked common."""
    marks = F.array_compact(F.array(F.when(F.col("rare"), "rare"), F.when(F.col("common"), "common")))
    return frequencies.select("term", F.explode(marks).alias("mark"))
