"""Training, registry, the scheduled job and importance."""

import pytest
from pyspark.sql import functions as F

from netsleuth.functions.schema import FLOW_COLUMNS, MODEL_FEATURES, NUMERIC_FEATURES
from netsleuth.operators import boosting, cleaning, gate, metrics, registry, training
from netsleuth.plans import jobs


@pytest.fixture(scope="module")
def flows(spark):
    """Attacks send more packets; the rest of the features is noise from the key."""
    noise = lambda i: (F.abs(F.hash(F.col("id"), F.lit(i))) % 100).cast("double")
    label = F.when(F.abs(F.hash("id", F.lit("y"))) % 3 == 0, 1).otherwise(0)
    values = {c: F.lit("10.0.0.1") if "ADDR" in c else F.lit(80) if "PORT" in c else noise(i) for i, c in enumerate(FLOW_COLUMNS)}
    values.update(Label=label, Attack=F.when(label == 1, "dos").otherwise("Benign"), IN_PKTS=noise("p") + label * 60)
    return spark.range(1500).select(F.col("id").alias("flow_id"), *[values[c].alias(c) for c in FLOW_COLUMNS]).cache()


def test_train_evaluate_explain_score(spark, flows):
    gold = cleaning.engineer(cleaning.silver(flows))
    vectors = training.feature_vectors(cleaning.model_matrix(gold, ["flow_id", "Label"]), ["flow_id", "Label"])
    model = training.train_detector(vectors, "flow_id", maxIter=5, maxDepth=3)
    scored = training.model_probability(model.transform(vectors), "score").withColumnRenamed("Label", "y")
    assert metrics.roc_auc(scored).first()[0] > 0.85
    top = [r["feature"] for r in training.swap_importance(model, vectors, "flow_id", top=5).collect()]
    assert set(top) & {"IN_PKTS", "TOTAL_PKTS", "PKT_DIR_RATIO", "BYTES_PER_PKT_IN", "RETRANS_RATE"} and len(top) == 5
    asked = spark.createDataFrame([(1, {"IN_PKTS": 150.0}), (2, {"IN_PKTS": 1.0})], "id int, flow map<string,double>")
    rows = training.score_with_model(asked, "flow", ["id"], model, "m", "3", "staging").collect()
    assert all(0 <= r["malicious_probability"] <= 1 and r["model_version"] == "3" for r in rows)


def test_swapped_rows_carry_their_own_probability(spark):
    """Only values that change are scored again, no scored row meets another, and the means are those of plain swaps."""
    import hashlib

    from pyspark.ml.classification import GBTClassifier

    rows = [(i, float(i % 3), float(i % 7), 1.0, int(i % 7 > 3)) for i in range(60)]
    names = ["a", "b", "same"]
    vectors = training.feature_vectors(spark.createDataFrame(rows, "id long, a double, b double, same double, Label int"), ["id", "Label"], names)
    model = GBTClassifier(featuresCol="features", labelCol="Label", maxIter=2, maxDepth=2, seed=1).fit(vectors)
    order = sorted(rows, key=lambda r: (hashlib.md5(f"0|{r[0]}".encode()).hexdigest(), r[0]))
    # row r meets the one before it, the first meets the last
    met = [(r[1:4], order[i - 1][1:4]) for i, r in enumerate(order)]
    chance = lambda x: model.predictProbability(x)[1]
    from pyspark.ml.linalg import Vectors
    swap = lambda x, y, f: Vectors.dense([y[i] if i == f else v for i, v in enumerate(x)])
    want = {n: round(sum(abs(chance(swap(x, y, f)) - chance(Vectors.dense(x))) for x, y in met) / len(met), 6) for f, n in enumerate(names)}

    class Plain:
        seen = []

        def transform(self, df):
            self.seen.append(df)
            return model.transform(df)

    for asked in (model, Plain()):
        got = {r["feature"]: r["mean_abs"] for r in training.swap_importance(asked, vectors, "id", names).collect()}
        assert got == pytest.approx(want, abs=1e-6)
    changed = sum(u != v for x, y in met for u, v in zip(x, y))
    assert [df.count() for df in Plain.seen] == [60, changed]


def test_search_reports_every_trial(spark, flows):
    gold = cleaning.engineer(cleaning.silver(flows))
    vectors = training.feature_vectors(cleaning.model_matrix(gold, ["flow_id", "Label"]), ["flow_id", "Label"])
    space = {"maxIter": ("int", 2, 3), "maxDepth": ("int", 1, 3)}
    best, report = training.search_params(vectors, "flow_id", trials=4, folds=2, rows=400, space=space, rungs=[(0.5, 2), (1.0, 3)])
    rows = report.collect()
    assert len(rows) == 4 and sorted(r["rung"] for r in rows) == [1, 1, 2, 2] and sum(r["best"] for r in rows) == 1
    (top,) = [r for r in rows if r["best"]]
    assert top["rung"] == 2 and top["cv_roc_auc"] == max(r["cv_roc_auc"] for r in rows if r["rung"] == 2) > 0.6
    assert best["maxDepth"] == top["maxDepth"] and best["maxIter"] == top["trees"] <= top["maxIter"]
    assert len(training.draw_params(25, 42)) == 25 and training.draw_params(3, 1) == training.draw_params(3, 1)


def test_patience_looks_only_so_far():
    assert training.patient_round([3, 2, 2, 1, 4, 4, 4, 0], 3) == 4
    assert training.patient_round([3, 2, 2, 1, 4, 4, 0], 3) == 7
    assert training.patient_round([1.0], 30) == 1 and training.patient_round([5, 4, 3], 1) == 3


def test_trees_as_arrays_say_what_the_model_says(spark, flows):
    import numpy as np
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import vector_to_array

    gold = cleaning.engineer(cleaning.silver(flows))
    data = training.feature_vectors(cleaning.model_matrix(gold, ["flow_id", "Label"]), ["flow_id", "Label"]).withColumn(
        "x", vector_to_array("features")).cache()
    model = GBTClassifier(featuresCol="features", labelCol="Label", maxIter=4, maxDepth=3, seed=2).fit(data)
    rows = {r["flow_id"]: r for r in data.collect()}
    x = np.array([r["x"] for r in rows.values()])
    staged = boosting.read_trees(model).staged(x)
    for n in (1, 3, 4):
        cut = boosting.first_trees(model, n)
        said = {r["flow_id"]: r["rawPrediction"][1] for r in cut.transform(data).select("flow_id", "rawPrediction").collect()}
        assert cut.getNumTrees == n and np.allclose(staged[:, n - 1], [said[i] for i in rows], atol=1e-12)
    parts = boosting.contributions(model, data, ["flow_id"], x.shape[1])
    for r in parts.collect():
        assert r["raw"] == pytest.approx(said[r["flow_id"]], abs=1e-9)
        assert r["base"] + sum(r["contributions"]) == pytest.approx(r["raw"], abs=1e-9)
    top = boosting.contribution_ranking(parts, MODEL_FEATURES, 3).collect()
    assert top[0]["feature"] in ("IN_PKTS", "TOTAL_PKTS", "PKT_DIR_RATIO", "BYTES_PER_PKT_IN", "RETRANS_RATE")
    assert boosting.contributions(model, data.limit(0), ["flow_id"], x.shape[1]).count() == 0
    # staged AUC of the rows of each fold against the plain definition
    folded = data.withColumn("fold", (data["flow_id"] % 2).cast("int"))
    trees = boosting.read_trees(model)
    auc = boosting.grouped_auc(boosting.staged_scores(folded, {(0, 0): trees, (0, 1): trees}, "fold", "Label"), ["trial", "fold", "stage"])
    y, f = np.array([r["Label"] for r in rows.values()]), np.array(list(rows)) % 2
    for r in auc.collect():
        s = staged[:, r["stage"] - 1]
        a, b = s[(f == r["fold"]) & (y == 1)], s[(f == r["fold"]) & (y == 0)]
        assert r["auc"] == pytest.approx(np.mean((a[:, None] > b) + (a[:, None] == b) / 2))


def test_registry_promotes_at_the_bar(spark, tmp_path):
    path = str(tmp_path / "registry")
    assert registry.register_model(spark, path, "m", "r1", 0.95, "p1") == 1
    assert registry.resolve_version(registry.load_registry(spark, path)).first().asDict() == {
        "name": "m", "version": 1, "alias": "staging", "path": "p1"}
    assert registry.register_model(spark, path, "m", "r2", 0.9499, "p2") == 2
    assert registry.resolve_version(registry.load_registry(spark, path)).first()["version"] == 1
    candidates = registry.load_registry(spark, path).filter("alias = 'candidate'")
    assert registry.resolve_version(candidates).first()["version"] == 2
    assert registry.resolve_version(candidates.withColumn("alias", F.lit("x"))).first()["alias"] == "latest"


def test_job_takes_both_branches(spark, flows, tmp_path):
    folder = str(tmp_path / "lake")
    assert jobs.last_decision(spark, folder) == "skip_retrain"
    run = lambda **kw: jobs.nids_job(spark, flows, "fixture", "2024-01-01 00:00:00", folder, params={"maxIter": 3, "maxDepth": 2}, **kw)
    assert run() == ["ingest", "drift_check", "drift_branch", "skip_retrain", "done"] or jobs.last_decision(spark, folder) == "retrain_features"
    assert run(simulate=True) == ["ingest", "drift_check", "drift_branch", "retrain_features", "retrain_train", "done"]
    model, row = jobs.load_serving_model(spark, folder)
    assert row["version"] == 1 and model.getNumTrees >= 1
    with pytest.raises(gate.GateFailed):
        jobs.nids_job(spark, flows.withColumn("Label", F.lit(7)), "bad", "2024-01-02 00:00:00", folder)


def test_linear_importance_centres_features(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "IN_PKTS float, OUT_PKTS float")
    rows = training.linear_importance(df, {"IN_PKTS": 2.0, "OUT_PKTS": 9.0}).collect()
    assert [(r["feature"], r["mean_abs"]) for r in rows] == [("IN_PKTS", 2.0), ("OUT_PKTS", 0.0)]
    assert len(MODEL_FEATURES) == 49


def test_model_queries_run_the_operators_defaults(spark, monkeypatch):
    from netsleuth.plans import model_queries

    asked = []

    def seen(name):
        def call(*args, **params):
            asked.append((name, params))
            raise StopIteration
        return call

    for name in ("train_detector", "search_params"):
        monkeypatch.setattr(training, name, seen(name))
    for query in ("train_detector", "search_params", "swap_importance"):
        with pytest.raises(StopIteration):
            model_queries.FAMILY.queries[query](spark, "/root/testdata/sf0.001")
    assert asked == [("train_detector", {}), ("search_params", {}), ("train_detector", {})]


def test_no_round_is_grown_twice(spark, flows, monkeypatch):
    """Losses that fall past the first rounds of patience take one fit, whose best prefix is the model."""
    from pyspark.ml.classification import GBTClassifier

    fits, plain = [], GBTClassifier.fit

    def fit(self, data):
        fits.append((self.getMaxIter(), plain(self, data)))
        return fits[-1][1]

    monkeypatch.setattr(GBTClassifier, "fit", fit)
    gold = cleaning.engineer(cleaning.silver(flows))
    vectors = training.feature_vectors(cleaning.model_matrix(gold, ["flow_id", "Label"]), ["flow_id", "Label"])
    model = training.train_detector(vectors, "flow_id", patience=1, maxIter=6, maxDepth=2)
    assert [rounds for rounds, _ in fits] == [6]
    n = model.getNumTrees
    assert 2 <= n <= 6
    tail = lambda m: m.toDebugString.splitlines()[1:]
    assert tail(model) == tail(fits[0][1])[:len(tail(model))] and model.treeWeights == fits[0][1].treeWeights[:n]


def test_batch_job_decides_once_per_batch(spark, flows, tmp_path):
    """A clean batch skips, a shifted one retrains, a failing one publishes nothing, a rerun lands nothing twice."""
    inbox, folder = str(tmp_path / "inbox"), str(tmp_path / "job")
    put = lambda df, name: df.write.parquet(f"{inbox}/batch={name}")
    state = lambda: {(r["state"], r["batch"]): r["count"] for r in jobs.landed(
        spark, folder, flows.schema).groupBy("state", "batch").count().collect()}
    run = lambda: {r["batch"]: (r["n_rows"], r["decision"]) for r in jobs.batch_job(
        spark, inbox, folder, flows.schema, params={"maxIter": 2, "maxDepth": 2}).collect()}
    assert state() == {}
    put(flows.filter("flow_id < 1000"), "a")
    put(flows.filter("flow_id >= 1000"), "b")
    assert run() == {"a": (1000, "retrain_features"), "b": (500, "skip_retrain")}
    put(flows.filter("flow_id < 400").withColumns({c: F.col(c) * 3 + 100 for c in NUMERIC_FEATURES if c != "PROTOCOL"}), "c")
    put(flows.withColumn("Label", F.lit(7)), "d")
    second = run()
    assert second == {"a": (1000, "retrain_features"), "b": (500, "skip_retrain"), "c": (400, "retrain_features")}
    assert run() == second
    assert state() == {("bronze", "a"): 1000, ("bronze", "b"): 500, ("bronze", "c"): 400, ("rejected", "d"): 1500}
    gold = sum(jobs.gold_part(spark, folder, part).count() for part in ("train", "test"))
    assert gold == 1400 and jobs.load_serving_model(spark, folder)[1]["version"] == 2
