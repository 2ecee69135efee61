"""Recovery of a known effect, refutations and invariants."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from netsleuth.operators import causal, logistic
from netsleuth.operators.logistic import Logistic

X = ["risk", "tenure", "prior"]


@pytest.fixture(scope="module")
def study(spark):
    """8,000 units with both potential outcomes; riskier units are treated more."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(3)
    n = 8000
    risk, tenure, prior = rng.normal(size=n), rng.normal(size=n), rng.poisson(0.5, n).astype(float)
    logistic = lambda v: 1 / (1 + np.exp(-v))
    t = rng.binomial(1, logistic(-0.2 + 1.1 * risk + 0.5 * prior - 0.2 * tenure))
    base = -1.0 + 1.4 * risk + 0.7 * prior - 0.3 * tenure
    p0, p1, u = logistic(base), logistic(base - 1.2), rng.uniform(size=n)
    y0, y1 = (u < p0).astype(int), (u < p1).astype(int)
    frame = pd.DataFrame({"unit": range(n), "risk": risk, "tenure": tenure, "prior": prior, "t": t,
                          "y": np.where(t == 1, y1, y0), "y0": y0, "y1": y1, "tau": p1 - p0})
    return spark.createDataFrame(frame).cache()


def test_adjusted_estimates_recover_the_effect(study):
    profile = causal.study_profile(study, "t", "y").first()
    truth = profile["true_ate"]
    assert truth < 0 and profile["naive_ate"] > truth and abs(profile["naive_bias"]) > 0.15
    effects = causal.logistic_effects(study, "t", "y", X).first()
    assert all(abs(effects[n] - truth) < 0.03 for n in ("regression_adjustment", "ipw", "aipw"))
    assert abs(causal.ols_ate(study, "t", "y", X).first()[0] - truth) < 0.04


def test_cate_follows_the_truth(study):
    cate = causal.logistic_cate(study, "t", "y", X)
    assert causal.effect_corr(cate, "cate", "tau").first()[0] > 0.9
    bins = {r["quartile"]: r["cate"] for r in causal.effect_by_quartile(cate, "risk", ["cate", "tau"]).collect()}
    assert set(bins) == {1, 2, 3, 4} and bins[1] > bins[4]


def test_refutations(study):
    effect = causal.ols_ate(study, "t", "y", X).first()[0]
    assert abs(causal.refute_random_cause(study, "unit", "t", "y", X).first()[0] - effect) < 0.01
    placebo = causal.refute_placebo(study, "unit", "t", "y", X, 20).first()
    assert abs(placebo["new_effect"]) < 0.01 and placebo["n_sims"] == 20


def test_placebo_equals_a_plain_permutation(spark, study):
    """The cut found from prefix counts treats exactly as many units as were treated."""
    from pyspark.sql import Window

    small = study.filter("unit < 700")
    n1 = small.agg(F.sum("t")).first()[0]
    order = Window.partitionBy("sim").orderBy(F.md5(F.concat_ws("|", F.col("sim").cast("string"), F.col("unit").cast("string"))))
    plain = small.withColumn("sim", F.explode(F.sequence(F.lit(0), F.lit(4)))).withColumn(
        "p", (F.row_number().over(order) <= n1).cast("int"))
    want = {r["sim"]: r["effect"] for r in causal.ols_coefficient(plain, "p", X, "y", by=["sim"]).collect()}
    got = {r["sim"]: r["effect"] for r in causal.placebo_effects(small, "unit", "t", "y", X, 5).collect()}
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s]) for s in want)


def test_strata_fall_back_and_constant_propensity(spark):
    rows = [("a", 1, 1, 1), ("a", 1, 0, 0), ("a", 2, 1, 1), ("b", 1, 0, 1)]
    df = spark.createDataFrame(rows, "s string, c int, t int, y int")
    cells = {(r["s"], r["c"]): r for r in causal.strata_cells(df, "t", "y", ["s", "c"]).collect()}
    assert cells["a", 2]["mu0"] == 0.0 and cells["a", 2]["borrowed"] == 1 and cells["a", 2]["e"] == 0.98
    assert cells["b", 1]["mu1"] == 1.0
    flat = df.withColumn("one", F.lit("x"))
    effects = causal.strata_effects(flat, "t", "y", ["one"]).first()
    assert effects["ipw"] == pytest.approx(causal.naive_ate(flat, "t", "y").first()[0])


def test_placebo_takes_only_zero_and_one(spark):
    units = spark.createDataFrame([(i, i % 3, float(i), float(i % 5)) for i in range(30)], "u long, t int, y double, c double")
    with pytest.raises(ValueError, match="other than 0 and 1"):
        causal.placebo_effects(units, "u", "t", "y", ["c"], 2)


def test_logistic_models_settle_together(spark):
    """Gradients vanish for wide and constant features, unequal arms, missing values and one-sided labels."""
    rng = np.random.default_rng(5)
    n = 4000
    a, b = rng.normal(size=n), rng.normal(size=n) * 300 + 1000
    y = (rng.uniform(size=n) < 1 / (1 + np.exp(1 - a - (b - 1000) / 300))).astype(int)
    rows = [(float(u), float(v), 2.0, int(w), int(i % 10 == 0)) for i, (u, v, w) in enumerate(zip(a, b, y))]
    rows += [(None, 1.0, 2.0, 1, 0), (1.0, 1.0, 2.0, None, 1)]
    df = spark.createDataFrame(rows, "a double, b double, k double, y int, t int")
    one = lambda: F.col("t") == 1
    models = logistic.fit(df, {
        "all": Logistic(["a", "b", "k"], "y"), "arm": Logistic(["a", "b"], "y", one()),
        "none": Logistic(["a"], "y", F.lit(False)), "ones": Logistic(["a"], "y", F.col("y") == 1)})
    found = {(r["model"], r["coefficient"]): r for r in logistic.gradients(df, models).collect()}
    assert all(abs(r["gradient"]) <= 1.01e-6 for r in found.values()) and len(found) == 11
    assert found["all", "a"]["n"] == n and found["arm", "a"]["n"] == n // 10 and found["none", "a"]["n"] == 0
    assert abs(models["all"].weights[1] - 1) < 0.2 and abs(models["all"].weights[2] * 300 - 1) < 0.2
    assert not models["none"].weights.any() and models["ones"].weights[0] > 5


def test_logistic_fit_equals_a_plain_newton(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(500, 2))
    y = (rng.uniform(size=500) < 1 / (1 + np.exp(-x[:, 0]))).astype(int)
    df = spark.createDataFrame([(float(u), float(v), int(w)) for (u, v), w in zip(x, y)], "a double, b double, y int")
    got = logistic.fit(df, {"m": Logistic(["a", "b"], "y")})["m"].weights
    design, want, pull = np.c_[np.ones(500), x], np.zeros(3), np.array([0.0, 1.0, 1.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-design @ want))
        want -= np.linalg.solve((design.T * (p * (1 - p))) @ design + np.diag(pull), design.T @ (p - y) + pull * want)
    assert np.allclose(got, want, atol=1e-8)


def test_cells_beyond_the_bound_give_the_same(spark, study, monkeypatch):
    """The lookup that spreads full cells against the broadcast, with null, zero of both signs and a full cell."""
    units = study.select("unit", "t", "y", F.when(F.col("unit") % 3 > 0, "most").when(F.col("unit") % 9 > 0, None).otherwise("few").alias("s"),
                         F.when(F.col("unit") % 2 == 0, F.lit(0.0)).when(F.col("unit") % 5 == 0, F.lit(-0.0)).otherwise(F.lit(1.5)).alias("b"))
    sent = causal.outcome_preds(units, "t", "y", ["s", "b"])
    assert "BroadcastHashJoin" in sent._jdf.queryExecution().executedPlan().toString()
    rows = sorted(map(tuple, sent.select("unit", "mu1", "mu0").collect()))
    monkeypatch.setattr(causal, "SENT_CELLS", 0)
    spread = causal.outcome_preds(units, "t", "y", ["s", "b"])
    assert spread.columns == sent.columns
    assert sorted(map(tuple, spread.select("unit", "mu1", "mu0").collect())) == rows and len(rows) == 8000
