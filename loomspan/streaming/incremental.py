"""Work in portions that can be taken up again (STM-01 to STM-07), as Structured Streaming over files and events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def new_files(spark: SparkSession, path: str, schema: StructType, kind: str = "parquet", most_files: int = 250) -> DataFrame:
    """A stream of a folder's files, at most so many a portion; which were read is kept by the query's checkpoint (STM-03, STM-05)."""
    return spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", most_files).option("recursiveFileLookup", True).load(path)


def append_new(stream: DataFrame, path: str, checkpoint: str) -> None:
    """What is new, appended as Parquet exactly once; returns when all of it is done (STM-01, STM-03)."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()


def for_each_new(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """work(portion, number) for each new portion; a portion that was cut short comes again under its number (STM-03)."""
    stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def grow_components(stream: DataFrame, components_of: Callable[[DataFrame], DataFrame], state: str, checkpoint: str) -> None:
    """Components kept up to date with new links (src, dst) (STM-04).

    Each portion's links join the spanning star of what is known (one link a node), so that old links aren't read again.
    The state of portion n is written as a table of its own before the pointer to it: a portion that comes again finds the
    state it began with.
    """
    spark = stream.sparkSession

    def merge(links: DataFrame, number: int) -> None:
        both = links.select("src", "dst")
        if number:
            known = spark.read.parquet(f"{state}/v{number - 1}")
            both = both.unionByName(known.select(F.col("node").alias("src"), F.col("root").alias("dst")))
        components_of(both).write.mode("overwrite").parquet(f"{state}/v{number}")

    for_each_new(stream, merge, checkpoint)


def latest_state(spark: SparkSession, state: str) -> DataFrame:
    """The last state that grow_components wrote."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(state)
    found = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    versions = [int(s.getPath().getName()[1:]) for s in found if s.getPath().getName().startswith("v")]
    return spark.read.parquet(f"{state}/v{max(versions)}")


def until_settled(step: Callable[[int], int], most: int = 3, least_gain: float = 0.02) -> list[int]:
    """The counts of a repeated step, ended when the gain falls below a share of the last count (STM-07)."""
    counts: list[int] = []
    for i in range(most):
        counts.append(step(i))
        if i and counts[-1] - counts[-2] < least_gain * max(1, counts[-2]):
            break
    return counts


def windowed_counts(events: DataFrame, at: str, kind: str, length: str = "1 hour", lateness: str = "2 hours") -> DataFrame:
    """(window_start, kind, n, total): events by time window, late ones up to the watermark; batch or stream alike."""
    kind_of_time = events.schema[at].dataType  # watermarks are for points in time; the session's zone reads plain ones as such
    rows = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, lateness) if events.isStreaming else events
    out = rows.groupBy(F.window(at, length), kind).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return out.select(F.col("window.start").cast(kind_of_time).alias("window_start"), kind, "n", "total")


def sessions(events: DataFrame, at: str, user: str, gap: str = "30 minutes") -> DataFrame:
    """(user, session_start, n): events of a user without a longer gap are one session; batch or stream alike."""
    rows = events.withWatermark(at, gap) if events.isStreaming else events
    return rows.groupBy(F.session_window(at, gap), user).agg(F.count("*").alias("n")).select(user, F.col("session_window.start").alias("session_start"), "n")
