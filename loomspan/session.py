"""Session defaults, table access and the cutting of lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.showConsoleProgress": "false",
}

_own_dir: dict[str, str] = {}
_written: list[tuple[SparkSession, str]] = []


def build_session(master: str = "local[*]", partitions: int = 8, **conf: str) -> SparkSession:
    """A session with the library's defaults; a cluster passes its own settings instead."""
    builder = SparkSession.builder.master(master).appName("loomspan")
    for key, value in (DEFAULTS | {"spark.sql.shuffle.partitions": str(partitions)} | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The Parquet table ``name`` (a file or a folder of files) of a data directory."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset, one of our own on a single machine only:
    on a cluster each executor would write to its own disk, so that is refused."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dir:
        _own_dir[app] = "file://" + tempfile.mkdtemp(prefix="loomspan-")
    return _own_dir[app]


def track(spark: SparkSession, path: str) -> str:
    """Have a folder of the shared one deleted when the program ends; gives its path."""
    _written.append((spark, path))
    return path


def write_out(df: DataFrame, *partition_by: str) -> str:
    """Write df as a Parquet table into the shared folder; gives its path."""
    spark = df.sparkSession
    path = track(spark, f"{shared_dir(spark)}/loomspan-{uuid.uuid4().hex}")
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """The same rows read back from a written table: lineage ends there, and a lost executor costs no recomputation."""
    return df.sparkSession.read.schema(df.schema).parquet(write_out(df))


def drop_written() -> None:
    """Delete the tables that write_out left; runs at exit, best effort."""
    while _written:
        spark, path = _written.pop()
        try:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001, the JVM may be gone already
            return


atexit.register(drop_written)
