"""Model registry as an append-only table of (name, version, alias, roc_auc, path)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PROMOTE_BAR = 0.95
SCHEMA = "name string, version int, alias string, roc_auc double, path string"
# Which alias serves first.
PREFERENCE = ["staging", "candidate"]


def register_runs(runs: DataFrame, bar: float = PROMOTE_BAR, first: int = 1) -> DataFrame:
    """Registry rows for finished runs, oldest first; ``runs`` is (name, run, roc_auc, path).

    Every run becomes the next version and a candidate, and also staging when its
    ROC-AUC reaches the bar.
    """
    order = Window.partitionBy("name").orderBy("run")
    numbered = runs.withColumn("version", (F.row_number().over(order) + (first - 1)).cast("int"))
    aliases = F.when(F.col("roc_auc") >= bar, F.array(F.lit("candidate"), F.lit("staging"))).otherwise(
        F.array(F.lit("candidate")))
    return numbered.select("name", "version", F.explode(aliases).alias("alias"), "roc_auc", "path")


def load_registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def register_model(spark: SparkSession, path: str, name: str, run: str, roc_auc: float, model_path: str,
                   bar: float = PROMOTE_BAR) -> int:
    """Append one run as the next version; returns the version."""
    try:
        newest = load_registry(spark, path).filter(F.col("name") == name).agg(F.max("version")).first()[0]
    except Exception as exc:  # the table appears with its first row
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        newest = None
    version = (newest or 0) + 1
    row = spark.createDataFrame([(name, run, float(roc_auc), model_path)], "name string, run string, roc_auc double, path string")
    register_runs(row, bar, version).write.mode("append").parquet(path)
    return version


def resolve_version(registry: DataFrame) -> DataFrame:
    """Per model, the version to serve: newest staging, else newest candidate, else newest."""
    preference = F.lit(0)
    for rank, alias in enumerate(reversed(PREFERENCE), 1):
        preference = F.when(F.col("alias") == alias, rank).otherwise(preference)
    best = F.max_by(F.struct("version", F.when(preference > 0, F.col("alias")).otherwise("latest").alias("alias"), "path"),
                    F.struct(preference.alias("p"), F.col("version").alias("v")))
    return registry.groupBy("name").agg(best.alias("b")).select("name", "b.version", "b.alias", "b.path")
