"""Readers and writers: flow files, bundles, JSON lines, layers and reports."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsleuth.functions.schema import BUNDLE_SCHEMA, FLOW_SCHEMA


def read_flows(spark: SparkSession, sources: list[str], schema=FLOW_SCHEMA) -> tuple[DataFrame, str]:
    """First readable CSV source of an ordered list, and which one it was.

    A source counts as readable when its header, read as a one-line probe, holds
    every declared column.
    """
    problems = []
    for path in sources:
        try:
            header = spark.read.option("header", True).csv(path).columns
        except PySparkException as exc:
            problems.append(f"{path}: {type(exc).__name__}")
            continue
        missing = [c for c in schema.fieldNames() if c not in header]
        if missing:
            problems.append(f"{path}: lacks {missing[:3]}")
            continue
        # enforceSchema=False checks each file's header against the declared order
        ordered = [next(f for f in schema.fields if f.name == c) if c in schema.fieldNames() else None for c in header]
        ddl = ", ".join(f"`{c}` {f.dataType.simpleString() if f else 'string'}" for c, f in zip(header, ordered))
        df = spark.read.schema(ddl).option("header", True).option("enforceSchema", False).csv(path)
        return df.select(*schema.fieldNames()), f"csv:{path}"
    raise FileNotFoundError("no readable flow source: " + "; ".join(problems))


def read_bundle(spark: SparkSession, path: str) -> DataFrame:
    """Objects of one threat-knowledge bundle, or of a folder of bundles."""
    bundles = spark.read.schema(BUNDLE_SCHEMA).option("multiLine", True).json(path)
    return bundles.select(F.inline("objects"))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines under a declared schema; blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def tag_ingest(df: DataFrame, provenance: str, batch_ts: str) -> DataFrame:
    """Add where a batch came from and its batch time, a parameter so reruns agree."""
    return df.withColumns({
        "_ingest_source": F.lit(provenance), "_ingest_ts": F.lit(batch_ts).cast("timestamp")})


def land_bronze(df: DataFrame, path: str, provenance: str, batch_ts: str) -> None:
    """Overwrite the bronze layer; the rebalance hint lets AQE choose sensible file sizes."""
    tag_ingest(df, provenance, batch_ts).hint("rebalance").write.mode("overwrite").parquet(path)


def write_layer(df: DataFrame, path: str, partition_by: list[str] = ()) -> None:
    """Overwrite a layer; with partitions, only those the frame holds."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def load_layer(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_report(df: DataFrame, path: str) -> None:
    """A short metric table as JSON, one file."""
    df.coalesce(1).write.mode("overwrite").json(path)
