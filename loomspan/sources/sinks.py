"""Writing tables (SNK-01 to SNK-12)."""

from __future__ import annotations

from collections.abc import Sequence
from html import escape as _escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspan.operators.shape import q


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), rows_per_file: int | None = None, codec: str = "zstd", mode: str = "overwrite") -> None:
    """A Parquet table, in folders by columns, in files of at most so many rows (SNK-01, SNK-03, SNK-05).

    An empty frame leaves a readable table with its schema. The engine's commit makes it visible as a whole (SNK-09).
    """
    writer = df.write.mode(mode).option("compression", codec)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        df.sparkSession.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def flat(df: DataFrame, by: str = "|") -> DataFrame:
    """Lists as joined texts, maps and structs as JSON, for formats without them (SNK-02)."""
    out = []
    for f in df.schema:
        c = F.col(q(f.name))
        if isinstance(f.dataType, T.ArrayType) and not isinstance(f.dataType.elementType, (T.StructType, T.ArrayType, T.MapType)):
            c = F.array_join(c.cast("array<string>"), by)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", codec: str = "none", sep: str = ",") -> None:
    """A flattened table as delimited text with a header (SNK-02)."""
    flat(df).write.mode(mode).option("header", True).option("emptyValue", "").option("compression", codec).option("sep", sep).csv(path)


def write_both(df: DataFrame, path: str) -> None:
    """The table as Parquet, which counts, and as CSV beside it (SNK-02, SNK-04); computed once."""
    write_parquet(df, f"{path}/parquet")
    write_csv(df.sparkSession.read.parquet(f"{path}/parquet"), f"{path}/csv")


def write_json(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """JSON lines, in folders by columns (SNK-06)."""
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).json(path)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> None:
    """A saved table bucketed and sorted by a key, so that later joins and aggregations on it need no shuffle (SNK-07).

    It takes the place of an indexed file database; appending to one, its other indexes and VACUUM have no counterpart.
    """
    writer = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Nodes and edges as two CSV tables with the headers of graph importers (SNK-08)."""
    write_csv(nodes.select(F.col("id").alias(":ID"), "label", F.col("type").alias(":LABEL")), f"{path}/nodes")
    write_csv(edges.select(F.col("src").alias(":START_ID"), F.col("dst").alias(":END_ID"), F.col("type").alias(":TYPE"), "weight"), f"{path}/edges")


def write_strata(df: DataFrame, stratum: str, path: str) -> None:
    """One folder for each stratum, in one pass (SNK-12)."""
    write_parquet(df, path, [stratum])


def report(df: DataFrame, title: str, most: int = 200) -> str:
    """A small table as Markdown (SNK-10); a report's rows are few, and no more than ``most`` are shown."""
    rows = df.limit(most).collect()
    lines = [f"# {title}", "", "| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    return "\n".join([*lines, *["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows]]) + "\n"


def _shapes(df: DataFrame, label: str, value: str, most: int) -> list[tuple[str, float]]:
    rows = df.select(F.col(q(label)).cast("string").alias("l"), F.col(q(value)).cast("double").alias("v")).filter("v > 0").orderBy(F.desc("v"), "l").limit(most).collect()
    return [(_escape(r["l"] or ""), r["v"]) for r in rows]


def bar_chart(df: DataFrame, label: str, value: str, title: str, most: int = 50) -> str:
    """A bar chart as SVG, the largest values first (SNK-11); a chart shows no more than ``most`` bars."""
    rows = _shapes(df, label, value, most)
    top = max((v for _, v in rows), default=1.0)
    bars = [f'<rect data-label="{name}" x="160" y="{40 + 24 * i}" width="{round(600 * v / top, 1)}" height="18" fill="#4878a8"/><text x="150" y="{54 + 24 * i}" text-anchor="end">{name}</text>' for i, (name, v) in enumerate(rows)]
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="800" height="{60 + 24 * len(rows)}"><text x="10" y="24">{_escape(title)}</text>{"".join(bars)}</svg>'


def treemap(df: DataFrame, label: str, value: str, title: str, width: int = 1000, height: int = 600, most: int = 200) -> str:
    """A treemap as SVG (SNK-11): the values halved again and again, the longer side cut each time."""
    tiles: list[str] = []

    def lay(rows: list[tuple[str, float]], x: float, y: float, w: float, h: float) -> None:
        if len(rows) == 1:
            tiles.append(f'<rect data-label="{rows[0][0]}" x="{x:.4f}" y="{y:.4f}" width="{w:.4f}" height="{h:.4f}" fill="#cfe0f0" stroke="#fff"/><text x="{x + 4:.1f}" y="{y + 16:.1f}">{rows[0][0]}</text>')
            return
        total, half, at = sum(v for _, v in rows), 0.0, 0
        while at < len(rows) - 1 and (at == 0 or half + rows[at][1] <= total / 2):
            half += rows[at][1]
            at += 1
        share = half / total
        if w >= h:
            lay(rows[:at], x, y, w * share, h)
            lay(rows[at:], x + w * share, y, w * (1 - share), h)
        else:
            lay(rows[:at], x, y, w, h * share)
            lay(rows[at:], x, y + h * share, w, h * (1 - share))

    if rows := _shapes(df, label, value, most):
        lay(rows, 0.0, 0.0, float(width), float(height))
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height}"><title>{_escape(title)}</title>{"".join(tiles)}</svg>'
