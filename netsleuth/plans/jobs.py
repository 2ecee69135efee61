"""The scheduled detection job as one function over the operators."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from netsleuth.functions.schema import LABEL, MODEL_FEATURES, RETRAIN, SKIP
from netsleuth.operators import cleaning, drift, gate, metrics, registry, splits, training
from netsleuth.sources import io
from netsleuth.streaming.jobs import drain_batches


def job_steps(decision: DataFrame) -> DataFrame:
    """Steps a run takes for a drift decision, in order."""
    taken = F.when(F.col("decision") == RETRAIN, F.array(*map(F.lit, [RETRAIN, "retrain_train"]))).otherwise(F.array(F.lit(SKIP)))
    steps = F.concat(F.array(*map(F.lit, ["ingest", "drift_check", "drift_branch"])), taken, F.array(F.lit("done")))
    return decision.select(F.posexplode(steps).alias("ord", "step"))


def publish_gold(spark: SparkSession, folder: str, key: str, test_frac: float = 0.2, seed: int = 42) -> None:
    """Bronze to silver to the two gold layers; the split is one pass over silver."""
    silver = cleaning.silver(io.load_layer(spark, f"{folder}/bronze"))
    io.write_layer(silver, f"{folder}/silver")
    gold = splits.hash_split(cleaning.engineer(io.load_layer(spark, f"{folder}/silver")), key, test_frac, seed)
    io.write_layer(gold, f"{folder}/gold", ["part"])


def gold_part(spark: SparkSession, folder: str, part: str) -> DataFrame:
    return io.load_layer(spark, f"{folder}/gold").filter(F.col("part") == part).drop("part", "batch")


def train_and_register(spark: SparkSession, folder: str, key: str, run: str, params: dict | None = None,
                       bar: float = registry.PROMOTE_BAR) -> dict:
    """Train on gold, evaluate on the held-out part, store the model and register it."""
    vectors = lambda part: training.feature_vectors(
        cleaning.model_matrix(gold_part(spark, folder, part), [key, LABEL]), [key, LABEL])
    model = training.train_detector(vectors("train"), key, **(params or {}))
    scored = training.model_probability(model.transform(vectors("test")), "p").select(F.col(LABEL).alias("y"), F.col("p").alias("score"))
    result = metrics.evaluate_detector(scored)
    io.write_report(result, f"{folder}/reports/metrics")
    figures = spark.read.json(f"{folder}/reports/metrics").first().asDict()
    path = f"{folder}/models/{run}"
    model.write().overwrite().save(path)
    version = registry.register_model(spark, f"{folder}/registry", "nids-detector", run, figures["test_roc_auc"], path, bar)
    return {"version": version, **figures}


def load_serving_model(spark: SparkSession, folder: str) -> tuple[GBTClassificationModel, dict]:
    """The model the registry says to serve, with its name, version and alias."""
    row = registry.resolve_version(registry.load_registry(spark, f"{folder}/registry")).first()
    return GBTClassificationModel.load(row["path"]), row.asDict()


def drift_check(spark: SparkSession, folder: str, columns: list[str] = MODEL_FEATURES, threshold: float = 0.5,
                simulate: bool = False) -> str:
    """Compare the two gold layers column by column and store the decision."""
    ref, cur = gold_part(spark, folder, "train"), gold_part(spark, folder, "test")
    columns = [c for c in columns if c in ref.columns]
    if simulate:
        cur = drift.perturb(cur, columns)
    sides = ref.select(F.lit("ref").alias("side"), *columns).unionByName(cur.select(F.lit("cur").alias("side"), *columns))
    result = drift.drift_decision(drift.drift_wasserstein(drift.drift_long(sides, "side", columns)), threshold)
    io.write_report(result, f"{folder}/reports/drift")
    return spark.read.json(f"{folder}/reports/drift").first()["decision"]


def last_decision(spark: SparkSession, folder: str) -> str:
    """The stored decision, skip when no drift check has run."""
    try:
        return spark.read.json(f"{folder}/reports/drift").first()["decision"]
    except Exception as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return SKIP


def nids_job(spark: SparkSession, flows: DataFrame, provenance: str, batch_ts: str, folder: str, key: str = "flow_id",
             rules: list | None = None, simulate: bool = False, params: dict | None = None) -> list[str]:
    """Ingest behind the gate, check drift, retrain if it fired; returns the steps taken."""
    steps = ["ingest"]
    passed = gate.require(flows, gate.flow_suite() if rules is None else rules)
    io.land_bronze(passed, f"{folder}/bronze", provenance, batch_ts)
    try:
        gold_part(spark, folder, "train")
    except Exception as exc:  # the first run has no gold to compare
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        publish_gold(spark, folder, key)
    steps += ["drift_check", "drift_branch"]
    drift_check(spark, folder, simulate=simulate)
    if last_decision(spark, folder) == RETRAIN:
        publish_gold(spark, folder, key)
        train_and_register(spark, folder, key, batch_ts[:10], params)
        steps += [RETRAIN, "retrain_train"]
    else:
        steps.append(SKIP)
    return steps + ["done"]


# --- new batches -----------------------------------------------------------
BRONZE, REJECTED = "bronze", "rejected"


def _with(schema: StructType, columns: str) -> StructType:
    return StructType([*schema.fields, *StructType.fromDDL(columns).fields])


def land_batches(spark: SparkSession, inbox: str, folder: str, schema: StructType, rules: list) -> None:
    """Land the files of ``inbox/batch=<id>`` that no earlier call has seen.

    The stream's checkpoint remembers files, so a rerun lands nothing twice; a replayed
    micro-batch overwrites its own folder. What arrives of a batch is refused as a whole
    if one of its rows breaks a rule: it is kept as ``rejected`` and none of it becomes
    ``bronze``. ``schema`` is that of the rows, beside the string ``batch``.
    """
    def write(arrived: DataFrame, run: int) -> None:
        _, bad = gate.quarantine(arrived, rules)
        # ids of the batches of one trigger, not rows
        failing = [r["batch"] for r in bad.select("batch").distinct().collect()]
        state = F.when(F.col("batch").isin(failing), REJECTED).otherwise(BRONZE)
        arrived.withColumn("state", state).write.mode("overwrite").partitionBy("state", "batch").parquet(
            f"{folder}/landed/landing={run}")

    stream = spark.readStream.schema(_with(schema, "batch string")).parquet(inbox)
    drain_batches(stream, write, f"{folder}/landing")


def landed(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """All landed rows with ``batch`` and ``state``; empty before anything has landed."""
    full = _with(schema, "batch string, state string, landing int")
    try:
        return spark.read.schema(full).parquet(f"{folder}/landed").drop("landing")
    except Exception as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], full).drop("landing")


def batch_decision(train: DataFrame, batch: DataFrame, columns: list[str] = MODEL_FEATURES, threshold: float = 0.5) -> DataFrame:
    """Drift decision of one batch's features against the gold that the model was trained on."""
    seen = lambda df, side: cleaning.model_matrix(df, [F.lit(side).alias("side")]).select("side", *columns)
    sides = seen(train, "ref").unionByName(seen(cleaning.engineer(cleaning.silver(batch)), "cur"))
    return drift.drift_decision(drift.drift_wasserstein(drift.drift_long(sides, "side", columns)), threshold)


def batch_job(spark: SparkSession, inbox: str, folder: str, schema, key: str = "flow_id", rules: list | None = None,
              params: dict | None = None) -> DataFrame:
    """Land what is new, decide on each new batch in order of id, and retrain where it drifted.

    The first batch founds gold and the model. A drifted batch joins gold before the
    training; a batch that skips stays in bronze. Decisions are kept in ``decisions``,
    one row per batch, and returned: (batch, n_rows, decision).
    """
    land_batches(spark, inbox, folder, schema, gate.flow_suite() if rules is None else rules)
    bronze = landed(spark, folder, schema).filter(F.col("state") == BRONZE).drop("state")
    kept = f"{folder}/decisions"
    decided = "batch string, n_rows bigint, decision string"
    try:
        done = {r["batch"] for r in spark.read.schema(decided).json(kept).select("batch").collect()}
    except Exception as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        done = set()
    sizes = {r["batch"]: r["n"] for r in bronze.groupBy("batch").agg(F.count(F.lit(1)).alias("n")).collect()}
    for name in sorted(set(sizes) - done):
        batch = bronze.filter(F.col("batch") == name).drop("batch")
        if done:
            decision = batch_decision(gold_part(spark, folder, "train"), batch).select("decision").first()[0]
        else:
            decision = RETRAIN
        if decision == RETRAIN:
            publish_batch(spark, folder, batch, name, key)
            train_and_register(spark, folder, key, name, params)
        row = spark.createDataFrame([(name, sizes[name], decision)], decided)
        row.write.mode("append").json(kept)
        done.add(name)
    return spark.read.schema(decided).json(kept)


def publish_batch(spark: SparkSession, folder: str, batch: DataFrame, name: str, key: str, test_frac: float = 0.2, seed: int = 42) -> None:
    """Add a batch to gold in its own folder, which a rerun overwrites."""
    gold = splits.hash_split(cleaning.engineer(cleaning.silver(batch)), key, test_frac, seed).withColumn("batch", F.lit(name))
    io.write_layer(gold, f"{folder}/gold", ["part", "batch"])
