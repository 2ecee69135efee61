"""Detector evaluation as aggregates; exact and free of single-task sorts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsleuth.functions.columns import verdict_columns
from netsleuth.operators.ranking import prefix_sums


def with_verdict(df: DataFrame, score: str = "score", threshold: float = 0.5) -> DataFrame:
    return df.select("*", *verdict_columns(F.col(score), threshold))


def confusion(df: DataFrame, y: str = "y", predicted: str = "prediction") -> DataFrame:
    cell = lambda truth, guess: F.count_if((F.col(y) == truth) & (F.col(predicted) == guess))
    return df.agg(cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp"))


def _rates() -> dict:
    """Precision, recall and F1 over a confusion row; 0 where undefined."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    ratio = lambda num, den: F.round(F.when(den > 0, num / den).otherwise(F.lit(0.0)), 4)
    return {"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn)}


def precision_recall_f1(counts: DataFrame) -> DataFrame:
    return counts.select(*[c.alias(n) for n, c in _rates().items()])


def _score_steps(df: DataFrame, y: str, score: str) -> DataFrame:
    """Distinct scores with their class counts and running totals."""
    counts = df.groupBy(F.col(score).alias("_s")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))
    return prefix_sums(counts, "_s", ["pos", "neg"])


def ranking_metrics(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """ROC-AUC with ties counted half, and average precision over distinct scores; one row."""
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    n1, n0 = F.max("total_pos").cast("double"), F.max("total_neg").cast("double")
    beaten = F.sum(pos * ((F.col("cum_neg") - F.col("neg")) + neg / 2.0))
    hits = (F.col("total_pos") - F.col("cum_pos") + F.col("pos")).cast("double")
    flagged = hits + (F.col("total_neg") - F.col("cum_neg") + F.col("neg"))
    return _score_steps(df, y, score).agg(
        F.round(beaten / F.nullif(n1 * n0, F.lit(0.0)), 6).alias("roc_auc"),
        F.round(F.sum(pos * hits / flagged) / F.nullif(n1, F.lit(0.0)), 6).alias("average_precision"))


def roc_auc(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    return ranking_metrics(df, y, score).select("roc_auc")


def average_precision(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    return ranking_metrics(df, y, score).select("average_precision")


def evaluate_detector(df: DataFrame, y: str = "y", score: str = "score", threshold: float = 0.5) -> DataFrame:
    """All held-out figures of a detector in one row."""
    counts = confusion(with_verdict(df, score, threshold), y)
    ranks = ranking_metrics(df, y, score)
    return counts.select(
        ranks.select("roc_auc").scalar().alias("test_roc_auc"),
        ranks.select("average_precision").scalar().alias("test_pr_auc"),
        *[c.alias("test_" + n) for n, c in _rates().items()],
        *[F.col(n).alias("test_" + n) for n in ("tn", "fp", "fn", "tp")])


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """Negatives per positive, the weight a rare positive class gets."""
    return df.agg(F.round(
        F.count_if(F.col(label) == 0) / F.greatest(F.count_if(F.col(label) == 1), F.lit(1)), 4).alias("class_weight"))


def metric_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean of each score column over its scored rows, with scored and total counts."""
    long = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns]).unpivot(
        [], columns, "metric", "value")
    return long.groupBy("metric").agg(
        F.round(F.avg("value"), 4).alias("mean"),
        F.count("value").alias("n_scored"),
        F.count(F.lit(1)).alias("n_total"))
