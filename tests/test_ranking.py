"""Two-level helpers against plain global windows, with ties and hot keys."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from netsleuth.operators import drift, metrics, ranking
from netsleuth.operators.ranking import exact_quantiles, hash_rank, place_among, prefix_sums, spread_lookup


def test_hash_rank_equals_global_window(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") < 2500, "hot").otherwise(F.lit(None)).alias("label"))
    ranked = hash_rank(df, ["id"], 1, by=["label"])
    order = Window.partitionBy("label").orderBy(F.md5(F.concat(F.lit("1|"), F.col("id").cast("string"))))
    assert ranked.withColumn("plain", F.row_number().over(order)).filter("rank <> plain").count() == 0
    assert ranked.count() == 3000


def test_prefix_sums_equal_global_window(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 1777 / 8.0).alias("v"), F.lit("a").alias("c"))
    df = df.unionByName(df.filter("v < 50").withColumn("c", F.lit("b")))
    counts = df.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    got = prefix_sums(counts, "v", ["n"], by=["c"])
    plain = Window.partitionBy("c").orderBy("v")
    checked = got.withColumn("p", F.sum("n").over(plain)).withColumn("nx", F.lead("v").over(plain))
    assert checked.filter("p <> cum_n or not (nx <=> next_value)").count() == 0
    assert got.count() == counts.count()


def test_exact_quantiles(spark):
    counts = spark.range(1001).select(F.col("id").cast("double").alias("v"), F.lit(3).alias("n"))
    got = exact_quantiles(prefix_sums(counts, "v", ["n"]), "v", "n", [0.1, 0.5, 0.9]).first()[0]
    want = spark.range(1001).select(F.explode(F.array_repeat("id", 3)).alias("v")).agg(F.percentile("v", [0.1, 0.5, 0.9])).first()[0]
    assert got == pytest.approx(want)


@pytest.mark.parametrize("n_cuts", [0, 1, 2, 3, 4, 7, 9])
def test_place_among(spark, n_cuts):
    cuts = [float(2 * i) for i in range(n_cuts)]
    df = spark.range(-1, 20).select(F.col("id").cast("double").alias("v"), F.lit(cuts).cast("array<double>").alias("c"))
    for right in (True, False):
        for row in place_among(df, "v", "c", "b", 9, right).collect():
            assert row["b"] == sum(c <= row["v"] if right else c < row["v"] for c in cuts)


def test_spread_lookup_with_hot_and_missing_keys(spark):
    facts = spark.range(2000).select("id", F.when(F.col("id") < 1500, 1).when(F.col("id") < 1600, None).otherwise(
        F.col("id") % 300).cast("bigint").alias("k"))
    dim = spark.range(250).select(F.col("id").alias("k"), (F.col("id") * 10).alias("x"))
    got = spread_lookup(facts, dim, "k", ["x"])
    want = facts.join(dim, "k", "left").select("id", "k", "x")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def brute_auc(rows):
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_and_average_precision(spark):
    rows = [(int((i * 37) % 5 < 2), float((i * 13) % 17)) for i in range(300)]
    df = spark.createDataFrame(rows, "y int, score double")
    got = metrics.ranking_metrics(df).first()
    assert got["roc_auc"] == pytest.approx(brute_auc(rows), abs=1e-6)
    flipped = metrics.roc_auc(df.withColumn("score", -F.col("score"))).first()[0]
    assert flipped == pytest.approx(1 - got["roc_auc"], abs=2e-6)
    n1, ap, last = sum(y for y, _ in rows), 0.0, 0.0
    for cut in sorted({s for _, s in rows}, reverse=True):
        kept = [y for y, s in rows if s >= cut]
        ap += (sum(kept) / n1 - last) * sum(kept) / len(kept)
        last = sum(kept) / n1
    assert got["average_precision"] == pytest.approx(ap, abs=1e-6)
    assert metrics.roc_auc(df.filter("y = 1")).first()[0] is None


def test_undefined_rates_are_zero(spark):
    df = spark.createDataFrame([(0, 0.1)], "y int, score double")
    row = metrics.evaluate_detector(df).first()
    assert row["test_precision"] == row["test_recall"] == row["test_f1"] == 0 and row["test_tn"] == 1


def test_metric_summary_skips_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (0.0,)], "m double")
    row = metrics.metric_summary(df, ["m"]).first()
    assert (row["mean"], row["n_scored"], row["n_total"]) == (0.5, 2, 4)


def sides(spark, shift, n=500):
    return spark.range(2 * n).select(
        F.when(F.col("id") < n, "ref").otherwise("cur").alias("side"), F.lit("x").alias("col"),
        (F.col("id") % n + F.when(F.col("id") < n, 0).otherwise(shift)).cast("double").alias("value"))


@pytest.mark.parametrize("test", [drift.drift_wasserstein, drift.drift_ks, drift.drift_psi])
def test_drift_zero_and_shift(spark, test):
    same, moved = test(sides(spark, 0)).first(), test(sides(spark, 400)).first()
    assert same["statistic"] == 0 and not same["drifted"] and moved["drifted"]


def test_drift_wasserstein_of_a_shift_is_the_shift(spark):
    df = sides(spark, 100)
    sd = df.filter("side = 'ref'").agg(F.stddev_samp("value")).first()[0]
    assert drift.drift_wasserstein(df).first()["statistic"] == pytest.approx(100 / sd, abs=1e-6)


def test_drift_constant_reference(spark):
    df = spark.createDataFrame([("ref", "x", 1.0), ("ref", "x", 1.0), ("cur", "x", 2.0)], "side string, col string, value double")
    assert drift.drift_wasserstein(df).first()["statistic"] == 1000.0


def test_drift_decision_is_inclusive(spark):
    rows = spark.createDataFrame([("a", True), ("b", False)], "col string, drifted boolean")
    row = drift.drift_decision(rows, 0.5).first()
    assert row["drift_detected"] and row["decision"] == "retrain_features" and row["share_of_drifted_columns"] == 0.5
    assert drift.drift_decision(rows, 0.51).first()["decision"] == "skip_retrain"
    assert drift.next_task(spark.createDataFrame([], "decision string, ts int")).first()[0] == "skip_retrain"


def test_js_distance_bounds(spark):
    df = spark.createDataFrame([("ref", "c", "a"), ("cur", "c", "b")], "side string, col string, category string")
    assert drift.drift_js(df).first()["statistic"] == 1.0


@pytest.mark.parametrize("value", ["id % 3", "0", "id", "case when id < 4000 then 7 else id end", "cast(null as double)"])
def test_sketch_rank_bounds_buckets_and_ties(spark, value):
    """Few buckets and no large one, whatever repeats; ranks are those of a plain sort."""
    from netsleuth.functions.columns import hash_hex

    df = spark.range(6000).selectExpr("id", f"cast({value} as double) as v")
    h = hash_hex(0, F.col("id"))
    sizes = ranking.sketch_buckets(df, "v", h).groupBy("_bucket").count()
    n, largest = sizes.agg(F.count(F.lit(1)), F.max("count")).first()
    assert n <= 16 * 8 and (value.startswith("cast(null") or largest < 6000 / 8)
    plain = df.withColumn("want", F.row_number().over(Window.orderBy("v", h, "id")))
    got = ranking.sketch_rank(df, "v", h, [F.col("id")])
    assert got.columns == ["id", "v", "rank"]
    assert got.join(plain, "id").filter("rank <> want").count() == 0 and got.count() == 6000
    assert ranking.sketch_rank(df.limit(0), "v", h, [F.col("id")]).count() == 0


@pytest.mark.parametrize("hot", ["neither", "left", "right", "both"])
def test_spread_join_equals_plain_join(spark, hot):
    key = lambda share: F.when(F.rand(5) < share, "hub").otherwise((F.col("id") % 300).cast("string"))
    left = spark.range(900).select(F.col("id").alias("l"), key(0.4 if hot in ("left", "both") else 0.0).alias("k"))
    right = spark.range(700).select(F.col("id").alias("r"), key(0.4 if hot in ("right", "both") else 0.0).alias("k"))
    left = left.unionByName(spark.createDataFrame([(-1, None), (-2, "alone")], "l long, k string")).cache()
    right = right.unionByName(right.limit(9)).unionByName(spark.createDataFrame([(-3, None)], "r long, k string")).cache()
    got = ranking.spread_join(left, right, "k", ["l"], ["r"]).select("k", "l", "r")
    want = left.join(right, "k").select("k", "l", "r")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert ranking.spread_join(left.limit(0), right, "k", ["l"], ["r"]).count() == 0


def test_tables_give_back_their_shuffle_files(spark):
    """A table that is written keeps no shuffle files behind, and the setting of the session stays as it was."""
    import time

    from netsleuth import session
    from netsleuth.llm.shared import written

    held = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().size()
    for write in (session.durable, session.durable_partitions, written):
        before = held()
        made = write(spark.range(5000).groupBy((F.col("id") % 70).alias("k")).count())
        end = time.time() + 10
        while held() > before and time.time() < end:
            time.sleep(0.2)
        assert held() <= before, write.__name__
        assert made.count() == 70
    assert spark.conf.get(session.CLEANUP) == "false"


def test_ranks_beyond_marks_against_a_full_rank(spark):
    import random

    from netsleuth.operators.ranking import bucket_rank, ranks_beyond

    rng = random.Random(3)
    rows = [(rng.randint(0, 9), rng.choice([None, *range(40)]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "b int, v int, i int")
    order = [F.col("v"), F.col("i")]
    rank = {r["i"]: r["rank"] for r in bucket_rank(df, F.col("b"), order).collect()}
    for marks in ([0], [300], [400], [1, 299], [30, 31], [95, 210]):
        got = ranks_beyond(df, F.col("b"), order, [F.lit(m) for m in marks]).collect()
        assert len(got) == len(rows)
        assert all(r["beyond"] == sum(rank[r["i"]] > m for m in marks) for r in got), marks
    # equal rows on a cut fall on either side, as many as the rank says
    same = spark.createDataFrame([(0, 1)] * 10, "b int, v int")
    assert ranks_beyond(same, F.col("b"), [F.col("v")], [F.lit(4)]).filter("beyond = 0").count() == 4
    assert ranks_beyond(same.limit(0), F.col("b"), [F.col("v")], [F.lit(4)]).count() == 0
