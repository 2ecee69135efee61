"""Reproducible splits, samples and folds on a hashed row key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsleuth.functions.columns import hash_hex, hash_long
from netsleuth.operators.ranking import hash_prefix, hash_rank, ranks_beyond


def hash_split(df: DataFrame, key: str, test_frac: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``part`` (train or test); a row's side depends on its key only, no shuffle."""
    is_test = hash_long(seed, F.col(key)) % 10000 < int(10000 * test_frac)
    return df.withColumn("part", F.when(is_test, "test").otherwise("train"))


def stratified_sample(df: DataFrame, key: str, label: str, n: int, seed: int = 42) -> DataFrame:
    """About ``n`` rows that keep the label shares; all rows when there are fewer."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_size"))
    quota = sizes.select(F.col(label).alias("_label"), F.when(
        sizes.agg(F.sum("_size")).scalar() <= n, F.col("_size")
    ).otherwise(F.round(F.col("_size") * F.lit(float(n)) / sizes.agg(F.sum("_size")).scalar())).alias("_quota"))
    ranked = hash_rank(df, [key], seed, by=[label], out="_rank")
    kept = ranked.join(quota, F.col(label).eqNullSafe(F.col("_label"))).filter("_rank <= _quota")
    return kept.select(*df.columns)


def stratified_kfold(df: DataFrame, key: str, label: str, k: int = 3, seed: int = 42) -> DataFrame:
    """Add ``fold`` 0..k-1, even within each label."""
    ranked = hash_rank(df, [key], seed, by=[label], out="_rank")
    return ranked.withColumn("fold", (F.col("_rank") % k).cast("int")).drop("_rank")


def three_way_split(df: DataFrame, key: list[str], val_frac: float = 0.1, test_frac: float = 0.1,
                    seed: int = 42) -> DataFrame:
    """Add ``part``: the first floor(n*test) rows in hash order test, then val, then train.

    Only the rows around the two cuts are ranked.
    """
    n = df.agg(F.count(F.lit(1))).scalar()
    n_test, n_val = F.floor(n * F.lit(test_frac)), F.floor(n * F.lit(val_frac))
    keys = [F.col(k) for k in key]
    h = hash_hex(seed, *keys)
    placed = ranks_beyond(df, hash_prefix(df, h), [h, *keys], [n_test, n_test + n_val], out="_beyond")
    part = F.when(F.col("_beyond") == 0, "test").when(F.col("_beyond") == 1, "val").otherwise("train")
    return placed.withColumn("part", part).drop("_beyond")
