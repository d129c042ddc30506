"""Coverage, linkage, gaps, graphs and a regression (RPT-01 to RPT-13, GR-03 to GR-06, ML-01, ABS-01 to ABS-05)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.functions.rules import term_domain
from loomspan.operators.shape import q
from loomspan.operators.text import guessed_type

# Features that a complete table must have.
REQUIRED_NANO = ["size_nm", "zeta_potential_mv", "core_material", "surface_chemistry", "drug_payload"]
REQUIRED_GENOMIC = ["BRCA1_mutation", "TP53_mutation", "PIK3CA_mutation", "HER2_status"]


def coverage(terms: DataFrame, term: str, domain: str, found: DataFrame, value: str) -> DataFrame:
    """(domain, n_terms, n_found, share): how much of each domain's vocabulary occurs (RPT-01)."""
    there = found.select(F.lower(F.col(q(value))).alias("_v")).filter("_v is not null").distinct().withColumn("_in", F.lit(1))
    rows = terms.select(F.lower(F.col(q(term))).alias("_t"), F.col(q(domain)).alias("domain")).filter("_t is not null").distinct()
    out = rows.join(there, F.col("_t") == F.col("_v"), "left").groupBy("domain").agg(F.count("*").alias("n_terms"), F.count("_in").alias("n_found"))
    return out.withColumn("share", F.round(F.col("n_found") / F.col("n_terms"), 6))


def linkage(rows: DataFrame, file: str, domain: str, anchor: str, others: Sequence[str]) -> DataFrame:
    """One row: files with a term of the anchor's domain, and how many of them have one of each other domain (RPT-02)."""
    has = lambda d: F.coalesce(F.bool_or(F.col(q(domain)) == d), F.lit(False))
    per = rows.groupBy(file).agg(has(anchor).alias("_a"), *[has(o).alias(f"_{i}") for i, o in enumerate(others)])
    return per.filter("_a").agg(F.count("*").alias(f"n_{anchor}"), *[F.coalesce(F.sum(F.col(f"_{i}").cast("int")), F.lit(0)).alias(f"with_{o}") for i, o in enumerate(others)])


def scorecard(crosswalk: DataFrame, file: str, column: str, by: str = "strict") -> DataFrame:
    """(n_files, n_genomic, n_nano, n_both): files by the domains of their columns (RPT-03, AGG-03).

    strict: a column of both domains counts as neither; loose: as each of them.
    """
    domain = term_domain(F.col(q(column)))
    both = domain == "Genomic & Nanomedicine" if by == "loose" else F.lit(False)
    per = crosswalk.groupBy(file).agg(F.coalesce(F.bool_or((domain == "Genomic") | both), F.lit(False)).alias("g"), F.coalesce(F.bool_or((domain == "Nanomedicine") | both), F.lit(False)).alias("n"))
    count = lambda c: F.coalesce(F.sum(c.cast("int")), F.lit(0))
    return per.agg(F.count("*").alias("n_files"), count(F.col("g")).alias("n_genomic"), count(F.col("n")).alias("n_nano"), count(F.col("g") & F.col("n")).alias("n_both"))


def intersections(crosswalk: DataFrame, file: str, column: str, n: int = 5) -> DataFrame:
    """(file, genomic_columns, nano_columns): of files that have both, the first columns of each domain (RPT-04)."""
    domain = term_domain(F.col(q(column)))
    columns = lambda d: F.slice(F.array_sort(F.collect_set(F.when(domain.contains(d), F.col(q(column))))), 1, n)
    return crosswalk.groupBy(file).agg(columns("Genomic").alias("genomic_columns"), columns("Nanomedicine").alias("nano_columns")).filter("size(genomic_columns) > 0 and size(nano_columns) > 0")


def required_features(df: DataFrame, required: Mapping[str, Sequence[str]]) -> DataFrame:
    """(kind, feature, present, query): which required columns a table lacks, with words to search them by (RPT-05)."""
    have = {c.lower() for c in df.columns}
    rows = [(kind, f, f.lower() in have) for kind, features in required.items() for f in features]
    out = df.sparkSession.createDataFrame(rows, "kind string, feature string, present boolean")
    return out.withColumn("query", F.when(~F.col("present"), F.url_encode(F.concat(F.lit('"breast cancer" "'), F.col("feature"), F.lit('" "raw data"')))))


def unsafe_files(footers: DataFrame, most_columns: int = 50_000, rows_per_kb: float = 10_000.0) -> DataFrame:
    """(path, reason): files that can't be read, are too wide, or expand too much (RPT-06, RPT-07, FLT-10, ORC-07)."""
    density = F.col("n_rows") / F.greatest(F.col("file_bytes") / 1024.0, F.lit(1e-9))
    reason = F.when(F.col("error").isNotNull(), "unreadable").when(F.col("n_columns") > most_columns, "width").when(density > rows_per_kb, "density")
    return footers.select("path", reason.alias("reason")).filter("reason is not null")


def vocabulary_gaps(unstructured: DataFrame, structured: DataFrame, vocabulary: DataFrame, term: str) -> DataFrame:
    """(candidate, suggested_type, total_count, sources): terms (term, n) of either kind that the vocabulary lacks (RPT-08, AGG-12)."""
    known = vocabulary.select(F.lower(F.col(q(term))).alias("_k")).filter("_k is not null").distinct()
    tagged = lambda df, name: df.select(F.lower("term").alias("candidate"), guessed_type(F.col("term")).alias("suggested_type"), F.col("n").alias("n"), F.lit(name).alias("source"))
    rows = tagged(unstructured, "unstructured").unionByName(tagged(structured, "structured")).filter("candidate is not null")
    out = rows.join(known, F.col("candidate") == F.col("_k"), "left_anti").groupBy("candidate", "suggested_type")
    return out.agg(F.sum("n").alias("total_count"), F.array_join(F.array_sort(F.collect_set("source")), "|").alias("sources"))


def repository_summary(files: DataFrame) -> DataFrame:
    """(extension, n_files, bytes, largest): an inventory by extension (RPT-11, AGG-01, AGG-17, SRC-22)."""
    return files.groupBy("extension").agg(F.count("*").alias("n_files"), F.sum("bytes").alias("bytes"), F.max("bytes").alias("largest"))


def dropped_manifest(manifest: DataFrame, key: str, present: DataFrame, present_key: str) -> DataFrame:
    """Manifest rows whose file isn't there (ABS-04, JN-18)."""
    return manifest.join(present.select(F.col(q(present_key)).alias("_p")).distinct(), F.col(q(key)) == F.col("_p"), "left_anti")


def graph_nodes(parts: Sequence[tuple[DataFrame, str, str, str]]) -> DataFrame:
    """(id, label, type): nodes from tables given as (table, id column, label column, type); one row per id, the least label (GR-03)."""
    rows = [df.select(F.concat(F.lit(f"{kind}:"), F.col(q(i)).cast("string")).alias("id"), F.col(q(label)).cast("string").alias("label"), F.lit(kind).alias("type")) for df, i, label, kind in parts]
    return reduce(DataFrame.unionByName, rows).filter("id is not null").groupBy("id").agg(F.min(F.struct("label", "type")).alias("x")).select("id", "x.label", "x.type")


def graph_edges(parts: Sequence[tuple[DataFrame, str, str, str, str, str]], nodes: DataFrame) -> DataFrame:
    """(src, dst, type, weight): edges from tables given as (table, source column, source type, target column, target type, type), only between nodes; weight is how often (GR-04, JN-10)."""
    from loomspan.operators.joins import edges_between

    end = lambda c, kind: F.concat(F.lit(f"{kind}:"), F.col(q(c)).cast("string"))
    rows = [df.select(end(a, ka).alias("src"), end(b, kb).alias("dst"), F.lit(kind).alias("type")) for df, a, ka, b, kb, kind in parts]
    counted = reduce(DataFrame.unionByName, rows).filter("src is not null and dst is not null").groupBy("src", "dst", "type").agg(F.count("*").cast("double").alias("weight"))
    return edges_between(counted, nodes)


def graph_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(part, type, n) (GR-05, AGG-18)."""
    return nodes.groupBy(F.lit("node").alias("part"), "type").agg(F.count("*").alias("n")).unionByName(edges.groupBy(F.lit("edge").alias("part"), "type").agg(F.count("*").alias("n")))


def graphml(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The lines (part, line) of a graph as GraphML elements, nodes before edges; written with the frame's sink (SNK-08)."""
    safe = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    n = nodes.select(F.lit(0).alias("part"), F.concat(F.lit('<node id="'), safe(F.col("id")), F.lit('"><data key="type">'), safe(F.col("type")), F.lit("</data></node>")).alias("line"))
    e = edges.select(F.lit(1).alias("part"), F.concat(F.lit('<edge source="'), safe(F.col("src")), F.lit('" target="'), safe(F.col("dst")), F.lit('"><data key="type">'), safe(F.col("type")), F.lit("</data></edge>")).alias("line"))
    return n.unionByName(e)


def fitted_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """(n, slope, intercept, r2): least squares in one aggregation (ML-01, AGG-28)."""
    a, b = F.col(q(y)), F.col(q(x))
    return df.agg(F.regr_count(a, b).alias("n"), F.round(F.regr_slope(a, b), 6).alias("slope"), F.round(F.regr_intercept(a, b), 4).alias("intercept"), F.round(F.regr_r2(a, b), 6).alias("r2"))


def boosted_regression(df: DataFrame, key: str, label: str, numeric: Sequence[str], categorical: Sequence[str], least_rows: int = 100, rounds: int = 20) -> DataFrame:
    """(n_train, n_test, mse, r2): gradient-boosted trees on an 80/20 split by id, measured on the held-out part (ML-01, SRT-08).

    Texts are indexed, numbers' gaps filled by the median; rows without a label are left out; fewer than least_rows are
    refused. The split depends on the id alone, so every run has the same one.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    from loomspan.operators.windows import split_by_id

    rows = split_by_id(df.filter(F.col(q(label)).isNotNull()), key).select("part", F.col(q(label)).cast("double").alias("label"), *[F.col(q(c)).cast("double").alias(c) for c in numeric], *[F.coalesce(F.col(q(c)).cast("string"), F.lit("")).alias(c) for c in categorical])
    train, test = rows.filter("part = 'train'"), rows.filter("part = 'test'")
    n_train, n_test = train.count(), test.count()
    if n_train + n_test < least_rows:
        raise ValueError(f"fewer than {least_rows} rows")
    stages = [Imputer(strategy="median", inputCols=list(numeric), outputCols=[f"_{c}" for c in numeric])] if numeric else []
    stages += [StringIndexer(inputCol=c, outputCol=f"_{c}", handleInvalid="keep") for c in categorical]
    stages += [VectorAssembler(inputCols=[f"_{c}" for c in [*numeric, *categorical]], outputCol="features"), GBTRegressor(maxIter=rounds, maxDepth=4, seed=42, maxBins=128)]
    scored = Pipeline(stages=stages).fit(train).transform(test)
    measure = lambda name: float(RegressionEvaluator(metricName=name).evaluate(scored))
    return df.sparkSession.createDataFrame([(n_train, n_test, measure("mse"), measure("r2"))], "n_train bigint, n_test bigint, mse double, r2 double")


def steps_of_folder(spark: SparkSession, folder: str, steps: Sequence[str]) -> DataFrame:
    """(step, state): which steps' tables in a run's folder are complete, incomplete or missing (RPT-13)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def there(path: str) -> bool:
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(conf).exists(target)

    states = [(s, "complete" if there(f"{folder}/{s}/_SUCCESS") else "incomplete" if there(f"{folder}/{s}") else "missing") for s in steps]
    return spark.createDataFrame(states, "step string, state string")
