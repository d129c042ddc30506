"""The fusion of experiments with profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.session import table


def q_fused(spark: SparkSession, d: str) -> DataFrame:
    """Experiments (one row a measurement) with the profile of their source, of one lineage only."""
    experiments = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("key_id"), F.col("l_partkey").alias("drug_id"), F.col("l_quantity").alias("concentration"), F.col("l_extendedprice").alias("outcome"))
    region = table(spark, d, "region").filter("r_name = 'EUROPE'")
    lineage = table(spark, d, "nation").join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))  # 25 rows, fixed
    profiles = table(spark, d, "supplier").join(F.broadcast(lineage), F.col("s_nationkey") == F.col("n_nationkey"))
    flags = F.coalesce(F.col("s_acctbal") != 0, F.lit(True)).cast("int")
    profiles = profiles.select(F.col("s_suppkey").alias("key_id"), F.col("n_name").alias("lineage"), flags.alias("acct_mutation"))
    return experiments.join(profiles, "key_id")


QUERIES = {"q_fused": q_fused}
SQL = {
    "q_fused": """
SELECT l_suppkey AS key_id, l_partkey AS drug_id, l_quantity AS concentration, l_extendedprice AS outcome, n_name AS lineage, CAST(coalesce(s_acctbal <> 0, true) AS INTEGER) AS acct_mutation
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE'""",
}
