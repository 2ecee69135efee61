"""Detector training, search, explanation and scoring on ``pyspark.ml``."""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsleuth.functions.columns import hash_uniform, linear_probability, verdict_columns
from netsleuth.functions.schema import LABEL, MODEL_FEATURES
from netsleuth.operators import boosting, cleaning, metrics, splits
from netsleuth.operators.ranking import hash_rank
from netsleuth.session import durable, shuffle_width

SEARCH_ROWS = 80_000
#: Rounds without gain after which boosting stops.
PATIENCE = 30
#: Share of the sample and number of trees of each rung of a search.
RUNGS = [(0.25, 6), (0.5, 12), (1.0, 24)]
MISSING = -1.0  # below every flow counter, so missing values form their own branch

# Search ranges. A gain here is a drop in the variance of labels of -1 and 1, which is at most 1.
SEARCH_SPACE = {
    "maxIter": ("int", 150, 500),
    "maxDepth": ("int", 3, 10),
    "stepSize": ("log", 0.02, 0.3),
    "subsamplingRate": ("float", 0.6, 1.0),
    "minInstancesPerNode": ("int", 1, 10),
    "minInfoGain": ("log", 1e-5, 1e-2),
}


def feature_vectors(matrix: DataFrame, keep: list[str], features: list[str] = MODEL_FEATURES) -> DataFrame:
    """Model matrix rows as (keep..., features)."""
    filled = matrix.select(*keep, *[F.coalesce(F.col(f).cast("double"), F.lit(MISSING)).alias(f) for f in features])
    return VectorAssembler(inputCols=features, outputCol="features").transform(filled).select(*keep, "features")


def _weighted(vectors: DataFrame, label: str) -> DataFrame:
    """Give each positive row the weight that evens out the classes."""
    weight = metrics.class_weight(vectors, label).scalar()
    return vectors.withColumn("weight", F.when(F.col(label) == 1, weight).otherwise(F.lit(1.0)))


def patient_round(losses: list[float], patience: int = PATIENCE) -> int:
    """The round (from 1) of the smallest loss, looking no further than ``patience`` rounds past the smallest so far."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def train_detector(vectors: DataFrame, key: str, label: str = LABEL, seed: int = 42, patience: int = PATIENCE,
                   **params) -> GBTClassificationModel:
    """Boosted trees with class weights, up to the round after which ``patience`` more bring no gain.

    The gain is the log loss on a stratified tenth of the rows. The library fits from
    the start each time, so there is one fit of all ``maxIter`` rounds: its cost does not depend
    on when patience runs out. Every prefix of it is judged in one pass, and the model keeps the best one.
    """
    most = params.pop("maxIter", 100)
    folded = splits.stratified_kfold(_weighted(vectors, label), key, label, 10, seed)
    train = durable(folded.withColumn("held_out", F.col("fold") == 0).drop("fold"))
    fitted, held_out = train.filter(~F.col("held_out")), train.filter("held_out")
    model = GBTClassifier(featuresCol="features", labelCol=label, weightCol="weight", seed=seed,
                          **{"maxDepth": 5, **params, "maxIter": most}).fit(fitted)
    return boosting.first_trees(model, patient_round(model.evaluateEachIteration(held_out), patience))


def draw_params(trials: int, seed: int, space: dict = SEARCH_SPACE) -> list[dict]:
    """Seeded random draws from the search space."""
    rng = random.Random(seed)
    draw = {
        "int": lambda low, high: rng.randint(low, high),
        "float": lambda low, high: rng.uniform(low, high),
        "log": lambda low, high: low * (high / low) ** rng.random(),
    }
    return [{name: draw[kind](low, high) for name, (kind, low, high) in space.items()} for _ in range(trials)]


def search_params(vectors: DataFrame, key: str, label: str = LABEL, trials: int = 25, folds: int = 3, seed: int = 42,
                  rows: int = SEARCH_ROWS, space: dict = SEARCH_SPACE, rungs: list[tuple[float, int]] = RUNGS,
                  parallelism: int = 8) -> tuple[dict, DataFrame]:
    """Best parameters by mean cross-validated ROC-AUC on a stratified sample, and all trials.

    Successive halving: all trials start on a share of the sample and a few trees, the
    best third goes on to the next rung of ``rungs`` (share of the sample, trees). Every
    prefix of an ensemble is scored, so a trial's score is that of its best number of
    trees, at most its own ``maxIter``. The report has each trial's last rung, number of trees and score;
    the best one is the highest score of the last rung.
    """
    sample = splits.stratified_sample(vectors, key, label, rows, seed)
    folded = splits.stratified_kfold(_weighted(sample, label), key, label, folds, seed)
    folded = durable(folded.withColumn("_u", hash_uniform(seed + 1, F.col(key))))
    drawn = draw_params(trials, seed, space)
    alive, standing = list(range(trials)), {}
    for rung, (share, trees) in enumerate(rungs):
        # a fit of a bounded sample is many tiny tasks; several fits run side by side
        part = durable(folded.filter(F.col("_u") < share).coalesce(1))

        def fit(job):
            trial, fold = job
            params = {**drawn[trial], "maxIter": min(trees, drawn[trial].get("maxIter", trees))}
            model = GBTClassifier(featuresCol="features", labelCol=label, weightCol="weight", seed=seed, **params).fit(
                part.filter(F.col("fold") != fold))
            return job, boosting.read_trees(model)

        with ThreadPoolExecutor(parallelism) as pool:
            models = dict(pool.map(inheritable_thread_target(fit), [(t, f) for t in alive for f in range(folds)]))
        spread = part.repartition(shuffle_width(vectors.sparkSession)).withColumn("x", vector_to_array("features"))
        auc = boosting.grouped_auc(boosting.staged_scores(spread, models, "fold", label), ["trial", "fold", "stage"])
        means = auc.groupBy("trial", "stage").agg(F.avg("auc").alias("auc")).groupBy("trial").agg(
            F.max(F.struct("auc", (-F.col("stage")).alias("less"))).alias("top"))
        for row in means.collect():
            standing[row["trial"]] = (rung + 1, -row["top"]["less"], round(row["top"]["auc"], 6))
        alive = sorted(alive, key=lambda t: (-standing[t][2], t))
        if rung + 1 < len(rungs):
            alive = alive[:max(1, -(-len(alive) // 3))]
    best = alive[0]
    rows_out = [(i, *[float(p[n]) for n in space], *standing[i], i == best) for i, p in enumerate(drawn)]
    columns = ", ".join(f"{n} double" for n in space)
    report = vectors.sparkSession.createDataFrame(
        rows_out, f"trial int, {columns}, rung int, trees int, cv_roc_auc double, best boolean")
    return {**drawn[best], "maxIter": standing[best][1]}, report


def model_probability(scored: DataFrame, out: str = "probability") -> DataFrame:
    return scored.withColumn(out, vector_to_array("probability")[1])


def linear_importance(matrix: DataFrame, weights: dict[str, float], top: int = 15) -> DataFrame:
    """Mean absolute Shapley value w * (x - mean x) per feature of a linear model, best first."""
    names = list(weights)
    value = lambda n: F.coalesce(F.col(n).cast("double"), F.lit(0.0))
    means = matrix.agg(F.struct(*[F.avg(value(n)).alias(n) for n in names])).scalar()
    centred = matrix.select(*[value(n).alias(n) for n in names]).withColumn("_means", means)
    sizes = centred.agg(*[F.avg(F.abs(F.lit(weights[n]) * (F.col(n) - F.col(f"_means.{n}")))).alias(n) for n in names])
    long = sizes.unpivot([], names, "feature", "value")
    return long.select("feature", F.round("value", 6).alias("mean_abs")).orderBy(F.desc("mean_abs"), "feature").limit(top)


def swap_importance(model, vectors: DataFrame, key: str, features: list[str] = MODEL_FEATURES,
                    top: int = 15, seed: int = 0) -> DataFrame:
    """Mean absolute change of the probability when one feature comes from another row.

    Works for any model: each row meets its neighbour in hash order once, and lends
    every feature in turn; the mean is over all rows. The row's own probability goes along, so
    swapped rows never meet again. A value that stays the same, or that no tree of a boosted model
    looks at, moves nothing and is not scored.
    """
    ranked = hash_rank(vectors, [key], seed, out="_rank")
    ranked = durable(ranked.select(F.col("_rank"), vector_to_array("features").alias("_x")))
    n = ranked.agg(F.max("_rank")).scalar()
    partner = ranked.select((F.col("_rank") % n + 1).alias("_rank"), F.col("_x").alias("_other"))
    pairs = ranked.join(partner, "_rank").select("_x", "_other", array_to_vector("_x").alias("features"))
    based = model_probability(model.transform(pairs), "_base").select("_x", "_other", "_base")
    read = range(len(features))
    if isinstance(model, GBTClassificationModel):
        read = sorted({f for f in boosting.read_trees(model).feature if f >= 0})
    lent = based.select("*", F.explode(F.array(*[F.lit(f) for f in read]).cast("array<int>")).alias("_f")).filter(
        ~F.get("_x", F.col("_f")).eqNullSafe(F.get("_other", F.col("_f"))))
    swapped = lent.select("_f", "_base", array_to_vector(F.transform(
        "_x", lambda v, i: F.when(i == F.col("_f"), F.get("_other", i)).otherwise(v))).alias("features"))
    moved = model_probability(model.transform(swapped), "_p").groupBy("_f").agg(
        F.sum(F.abs(F.col("_p") - F.col("_base"))).alias("_moved"))
    named = vectors.sparkSession.createDataFrame(list(enumerate(features)), "_f int, feature string").withColumn("_n", n)
    return named.filter(F.col("_n").isNotNull()).join(moved, "_f", "left").select(
        "feature", F.round(F.coalesce("_moved", F.lit(0.0)) / F.col("_n"), 6).alias("mean_abs")).orderBy(
        F.desc("mean_abs"), "feature").limit(top)


def score_requests(df: DataFrame, flow_map: str, keep: list[str], probability: Column, name: str, version: str,
                   alias: str, threshold: float = 0.5) -> DataFrame:
    """Complete, engineer and score request maps; the same plan serves batch and stream."""
    gold = cleaning.engineer(cleaning.complete_flows(df, flow_map, keep))
    matrix = cleaning.model_matrix(gold, keep)
    return matrix.select(
        *keep, F.lit(name).alias("model_name"), F.lit(version).alias("model_version"), F.lit(alias).alias("model_alias"),
        *verdict_columns(probability, threshold))


def score_with_linear(df: DataFrame, flow_map: str, keep: list[str], weights: dict[str, float], bias: float,
                      name: str = "linear", version: str = "1", alias: str = "staging") -> DataFrame:
    return score_requests(df, flow_map, keep, linear_probability(weights, bias), name, version, alias)


def score_with_model(df: DataFrame, flow_map: str, keep: list[str], model, name: str, version: str, alias: str,
                     threshold: float = 0.5) -> DataFrame:
    """Score request maps with a fitted ``pyspark.ml`` classifier."""
    gold = cleaning.engineer(cleaning.complete_flows(df, flow_map, keep))
    vectors = feature_vectors(cleaning.model_matrix(gold, keep), keep)
    scored = model_probability(model.transform(vectors), "p")
    return scored.select(
        *keep, F.lit(name).alias("model_name"), F.lit(version).alias("model_version"), F.lit(alias).alias("model_alias"),
        *verdict_columns(F.col("p"), threshold))
