"""Structured Streaming jobs over the same column code as the batch operators.

Each job takes a streaming DataFrame and returns either a streaming DataFrame or a
``DataStreamWriter`` the caller starts. State is bounded by the watermark.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from netsleuth.operators import gate
from netsleuth.operators.drift import JS_BAR, js_distance
from netsleuth.operators.gate import Rule
from netsleuth.session import shared_dir


def read_table_stream(spark: SparkSession, folder: str, name: str, schema, max_files: int | None = None) -> DataFrame:
    """Stream a Parquet table: the files of ``folder`` called ``name``.parquet."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for a run's output and checkpoint, where every executor reaches it."""
    return f"{shared_dir(spark)}/streams/{name}-{uuid.uuid4().hex}"


def drain_to_parquet(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Process all available input once, append to Parquet, and read the result."""
    spark = df.sparkSession
    folder = folder or new_run_dir(spark, name)
    query = (
        df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True).start(f"{folder}/out"))
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


def drain_batches(df: DataFrame, write, folder: str) -> None:
    """Process all available input once through ``write(batch, batch_id)``."""
    df.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/checkpoint").trigger(
        availableNow=True).start().awaitTermination()


def gate_batches(rules: list[Rule], folder: str):
    """Writer of good and bad rows in one pass; a replayed batch overwrites its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        verdict = F.when(F.size("failed_rules") == 0, "good").otherwise("bad")
        gate.mark_failures(batch, rules).withColumn("verdict", verdict).write.mode("overwrite").partitionBy("verdict").parquet(
            f"{folder}/gated/batch={batch_id}")

    return write


def gated_rows(spark: SparkSession, folder: str, schema, verdict: str) -> DataFrame:
    """Rows that :func:`gate_batches` called good or bad, with the rules they failed; ``schema`` is the stream's."""
    whole = StructType([*schema.fields, StructField("failed_rules", ArrayType(StringType())),
                        StructField("verdict", StringType()), StructField("batch", LongType())])
    rows = spark.read.schema(whole).option("basePath", f"{folder}/gated").parquet(f"{folder}/gated")
    return rows.filter(F.col("verdict") == verdict).drop("verdict", "batch")


def tumbling_counts(df: DataFrame, source: str, value: str, length: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Rows and value total per source and window; late rows beyond the delay are dropped."""
    return _window_counts(df, F.window("ts", length), source, value, delay)


def sliding_counts(df: DataFrame, source: str, value: str, length: str = "2 hours", slide: str = "1 hour",
                   delay: str = "1 hour") -> DataFrame:
    return _window_counts(df, F.window("ts", length, slide), source, value, delay)


def session_counts(df: DataFrame, source: str, value: str, gap: str = "2 hours", delay: str = "1 hour") -> DataFrame:
    return _window_counts(df, F.session_window("ts", gap), source, value, delay)


def _window_counts(df, window, source, value, delay):
    cents = F.sum(F.round(F.col(value) * 100).cast("bigint"))
    counted = df.withWatermark("ts", delay).groupBy(window.alias("w"), source).agg(
        F.count(F.lit(1)).alias("n"), cents.alias("cents"))
    return counted.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), source, "n", "cents")


def category_windows(df: DataFrame, category: str, length: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Rows per window and category."""
    counted = df.withWatermark("ts", delay).groupBy(F.window("ts", length).alias("w"), F.col(category).alias("category"))
    return counted.agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "category", "n")


def category_drift(windows: DataFrame, reference: DataFrame, bar: float = JS_BAR) -> DataFrame:
    """Jensen-Shannon distance of each window's categories from reference shares.

    A reference category the window lacks adds half its share, so the absent ones
    come from the sum of the present ones and no outer join is needed.
    """
    total = F.sum("n").alias("_total")
    totals = windows.groupBy(F.col("start").alias("_start")).agg(total)
    joined = windows.join(totals, F.col("start") == F.col("_start")).join(reference, "category", "left")
    p, q = F.coalesce("share", F.lit(0.0)), F.col("n") / F.col("_total")
    squared = F.sum(js_distance(p, q)) + (1.0 - F.sum(p)) / 2.0
    return joined.groupBy("start").agg(
        F.sum("n").alias("n"), F.round(F.sqrt(F.greatest(squared, F.lit(0.0))), 6).alias("statistic")
    ).withColumn("drifted", F.col("statistic") >= bar)


def drift_batches(reference: DataFrame, folder: str):
    """Writer of one drift row per window closed in a batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # the closed windows are read twice, the stream once
        batch.persist()
        try:
            category_drift(batch, reference).write.mode("overwrite").parquet(f"{folder}/drift/batch={batch_id}")
        finally:
            batch.unpersist()

    return write


def distinct_flows(df: DataFrame, key: list[str], delay: str = "1 hour") -> DataFrame:
    """First copy of each flow record; keys are forgotten once the watermark passes."""
    return df.withWatermark("ts", delay).dropDuplicatesWithinWatermark(key)
