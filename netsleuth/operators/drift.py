"""Distribution drift per column, and the retrain decision.

Numeric tests work on (col, side, value) rows. Values are counted per side first;
every later step runs on distinct values with range-bucketed prefix sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsleuth.functions.schema import RETRAIN, SKIP
from netsleuth.operators.ranking import exact_quantiles, place_among, prefix_sums
from netsleuth.session import durable

WASSERSTEIN_BAR = 0.1
PSI_BAR = 0.2
JS_BAR = 0.1
KS_FACTOR = 1.358
SHARE_FLOOR = 1e-4
DECILES = [i / 10 for i in range(1, 10)]


def drift_long(df: DataFrame, side: str, columns: list[str]) -> DataFrame:
    """Numeric columns as (side, col, value) rows; missing values leave."""
    wide = df.select(F.col(side).alias("side"), *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(["side"], columns, "col", "value").filter(F.col("value").isNotNull())


def _value_counts(long: DataFrame, value: str = "value") -> DataFrame:
    return long.groupBy("col", value).agg(
        F.count_if(F.col("side") == "ref").alias("n_ref"), F.count_if(F.col("side") == "cur").alias("n_cur"))


def _curves(long: DataFrame) -> DataFrame:
    """Both empirical distribution functions at every distinct value."""
    mean = F.sum(F.col("n_ref") * F.col("value")) / F.sum("n_ref")
    sums = prefix_sums(_value_counts(long), "value", ["n_ref", "n_cur"], by=["col"], stats={"mean_ref": mean})
    return sums.withColumn("gap", F.abs(
        F.col("cum_n_ref") / F.col("total_n_ref") - F.col("cum_n_cur") / F.col("total_n_cur")))


def drift_wasserstein(long: DataFrame, bar: float = WASSERSTEIN_BAR) -> DataFrame:
    """Area between the distribution functions over the reference deviation."""
    off = F.col("value") - F.col("mean_ref")
    freedom = F.max("total_n_ref") - 1
    spread = F.sqrt(F.sum(F.col("n_ref") * off * off) / F.when(freedom > 0, freedom))
    area = F.sum(F.col("gap") * (F.coalesce("next_value", "value") - F.col("value")))
    scale = F.when(F.coalesce("sd", F.lit(0.0)) == 0, F.lit(1e-3)).otherwise(F.col("sd"))
    return _curves(long).groupBy("col").agg(area.alias("area"), spread.alias("sd")).select(
        "col", F.round(F.col("area") / scale, 6).alias("statistic")
    ).withColumn("drifted", F.col("statistic") >= bar)


def drift_ks(long: DataFrame, factor: float = KS_FACTOR) -> DataFrame:
    """Largest gap between the distribution functions and its asymptotic cut."""
    n, m = F.max("total_n_ref").cast("double"), F.max("total_n_cur").cast("double")
    return _curves(long).groupBy("col").agg(
        F.round(F.max("gap"), 6).alias("statistic"),
        F.round(F.lit(factor) * F.sqrt((n + m) / (n * m)), 6).alias("cut"),
    ).withColumn("drifted", F.col("statistic") >= F.col("cut"))


def drift_psi(long: DataFrame, bar: float = PSI_BAR) -> DataFrame:
    """Population stability index over the reference deciles, open-ended and right-closed."""
    counts = durable(_value_counts(long))
    ref = prefix_sums(counts.filter("n_ref > 0"), "value", ["n_ref"], by=["col"])
    edges = exact_quantiles(ref, "value", "n_ref", DECILES, by=["col"]).select(
        F.col("col").alias("_col"), F.array_distinct("quantiles").alias("edges"))
    # one short array per monitored column, so the broadcast side is bounded by the schema
    placed = place_among(
        counts.join(F.broadcast(edges), F.col("col") == F.col("_col")), "value", "edges", "bin", len(DECILES), right=False)
    binned = placed.groupBy("col", "bin").agg(
        F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    totals = binned.groupBy(F.col("col").alias("_col")).agg(
        F.sum("n_ref").alias("all_ref"), F.sum("n_cur").alias("all_cur"))
    share = lambda n, total: F.greatest(F.col(n) / F.col(total), F.lit(SHARE_FLOOR))
    p, q = share("n_ref", "all_ref"), share("n_cur", "all_cur")
    return binned.join(F.broadcast(totals), F.col("col") == F.col("_col")).groupBy("col").agg(
        F.round(F.sum((p - q) * F.log(p / q)), 6).alias("statistic")
    ).withColumn("drifted", F.col("statistic") >= bar)


def js_distance(p: Column, q: Column) -> Column:
    """One category's share of the squared Jensen-Shannon distance, base 2."""
    m = (p + q) / 2.0
    half = lambda a: F.when(a > 0, a * F.log2(a / m) / 2.0).otherwise(F.lit(0.0))
    return half(p) + half(q)


def drift_js(long: DataFrame, bar: float = JS_BAR) -> DataFrame:
    """Jensen-Shannon distance of (side, col, category) rows per categorical column."""
    counts = _value_counts(long, "category")
    totals = counts.groupBy(F.col("col").alias("_col")).agg(
        F.sum("n_ref").alias("all_ref"), F.sum("n_cur").alias("all_cur"))
    part = js_distance(F.col("n_ref") / F.col("all_ref"), F.col("n_cur") / F.col("all_cur"))
    return counts.join(F.broadcast(totals), F.col("col") == F.col("_col")).groupBy("col").agg(
        F.round(F.sqrt(F.greatest(F.sum(part), F.lit(0.0))), 6).alias("statistic")
    ).withColumn("drifted", F.col("statistic") >= bar)


def drift_decision(columns: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row from per-column results: share drifted, counts, threshold, decision."""
    n, hit = F.count(F.lit(1)), F.count_if(F.col("drifted"))
    fired = hit / n >= threshold
    return columns.agg(
        F.coalesce(fired, F.lit(False)).alias("drift_detected"),
        F.round(hit / n, 4).alias("share_of_drifted_columns"),
        hit.alias("n_drifted_columns"),
        n.alias("n_columns"),
        F.lit(threshold).alias("threshold"),
        F.when(fired, RETRAIN).otherwise(SKIP).alias("decision"))


def next_task(results: DataFrame) -> DataFrame:
    """Decision of the newest result; skip when there is none."""
    return results.agg(F.coalesce(F.max_by("decision", "ts"), F.lit(SKIP)).alias("task"))


def perturb(df: DataFrame, columns: list[str]) -> DataFrame:
    """Shift the first half of ``columns`` to x*3 + stddev(x), to rehearse a drift."""
    moved = columns[: max(1, len(columns) // 2)]
    spread = df.agg(F.struct(*[F.stddev_samp(c).alias(c) for c in moved])).scalar()
    return df.withColumns({c: F.col(c) * 3.0 + spread[c] for c in moved})
