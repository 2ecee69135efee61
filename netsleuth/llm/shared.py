"""Written tables in the shared folder, and connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsleuth.session import shared_dir, ship, shuffles_given_back


def new_folder(spark: SparkSession, kind: str) -> str:
    return f"{shared_dir(spark)}/llm/{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame, kind: str = "table", **options) -> DataFrame:
    """Write the rows to the shared folder and read them back; ``options`` are those of the Parquet writer.

    Later jobs restart from these files, so a lost executor costs a reread only.
    """
    spark = df.sparkSession
    path = new_folder(spark, kind)
    with shuffles_given_back(spark):
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """(id, text) alone, whatever else the table holds; rows without an id have no place in a result."""
    ship(documents.sparkSession)
    return documents.select(F.col(key).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter(
        F.col("doc_id").isNotNull())


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(id, component): the smallest id reachable over ``edges`` (a, b).

    Alternating large-star and small-star steps. Each step is a grouped minimum and a
    join, so a node with very many links is aggregated map-side and never gathered;
    every round is written to the shared folder. A graph that still changes after
    ``max_rounds`` rounds raises instead of answering wrongly.
    """
    links = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .filter(F.col("a") != F.col("b")).distinct(), "links")
    state = None
    for _ in range(max_rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("_m"))
        low = low.select("a", F.least("a", "_m").alias("_m"))
        large = both.filter(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
        large = written(large.filter(F.col("a") != F.col("b")).distinct(), "links")
        down = large.groupBy("a").agg(F.min("b").alias("_m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("_m").alias("b")).unionByName(
            down.select("a", F.col("_m").alias("b")))
        links = written(small.filter(F.col("a") != F.col("b")).distinct(), "links")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                        F.count_distinct("a")).first()
        # a forest of stars: every node points at one root
        if now == state:
            return links.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("id"), "component")
        state = now
    raise RuntimeError(f"links still change after {max_rounds} rounds")
