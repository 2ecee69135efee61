"""Streams against their batch results, over several files with late rows."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from netsleuth.operators import drift, gate
from netsleuth.streaming import jobs, window_drift

SCHEMA = "event_id long, ts timestamp, source string, value double"


@pytest.fixture()
def stream(spark, tmp_path):
    """Four ordered files; the last holds a row far behind the watermark and a repeat.

    Spark judges lateness by the watermark of the batch before, hence the third file.
    """
    def at(h, m=0):
        return dt.datetime(2024, 1, 1 + h // 24, h % 24, m)

    files = [[(1, at(1), "a", 1.0), (2, at(1, 30), "a", 2.0), (3, at(2), "b", -1.0)],
             [(4, at(8), "a", 4.0), (5, at(8, 10), "b", 5.0)],
             [(8, at(9), "c", 8.0)],
             [(6, at(1, 5), "a", 100.0), (5, at(8, 10), "b", 5.0), (7, at(20), "a", 7.0)]]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def test_tumbling_drops_late_rows(stream):
    rows = {(r["start"].hour, r["source"]): (r["n"], r["cents"]) for r in jobs.drain_to_parquet(
        jobs.tumbling_counts(stream, "source", "value"), "t").collect()}
    assert rows[1, "a"] == (2, 300) and rows[2, "b"] == (1, -100) and (20, "a") not in rows


def test_sliding_and_sessions(stream):
    sliding = jobs.drain_to_parquet(jobs.sliding_counts(stream, "source", "value"), "s").collect()
    assert {(r["start"].hour, r["source"]) for r in sliding} >= {(0, "a"), (1, "a"), (1, "b"), (2, "b")}
    sessions = jobs.drain_to_parquet(jobs.session_counts(stream, "source", "value"), "ss").collect()
    assert (2, 300) in {(r["n"], r["cents"]) for r in sessions}


def test_dedup(stream):
    got = jobs.drain_to_parquet(jobs.distinct_flows(stream, ["event_id"], "12 hours"), "d")
    assert sorted(r["event_id"] for r in got.collect()) == [1, 2, 3, 4, 5, 6, 7, 8]


def test_gate_writes_each_row_once(spark, stream):
    folder = jobs.new_run_dir(spark, "gate")
    write = jobs.gate_batches([gate.expect_between("value", 0, 50)], folder)
    jobs.drain_batches(stream, write, folder)
    rows = lambda verdict: jobs.gated_rows(spark, folder, stream.schema, verdict)
    write(rows("good").drop("failed_rules").limit(0), 99)  # a replayed empty batch adds nothing
    assert rows("good").count() == 7 and rows("bad").count() == 2
    assert {tuple(r["failed_rules"]) for r in rows("bad").collect()} == {("expect_column_values_to_be_between:value",)}


def test_category_drift_counts_absent_categories(spark):
    windows = spark.createDataFrame([(1, "a", 3)], "start int, category string, n long")
    reference = spark.createDataFrame([("b", 1.0)], "category string, share double")
    assert jobs.category_drift(windows, reference).first()["statistic"] == 1.0
    same = spark.createDataFrame([("a", 1.0)], "category string, share double")
    assert jobs.category_drift(windows, same).first()["statistic"] == 0.0


def test_window_drift_equals_batch_after_a_restart(spark, tmp_path):
    """Files come in two runs of one checkpoint; the counts of closed windows are those of a batch."""
    first = dt.datetime(2024, 1, 1)
    event = lambda i: (i, first + dt.timedelta(minutes=20 * i), "ab"[i % 2] if i < 150 else "c", float(i * 7 % 50) + (60 if i > 210 else 0))
    frames = [spark.createDataFrame([event(i) for i in range(lo, lo + 75)], SCHEMA) for lo in (0, 75, 150, 225)]
    source, folder = str(tmp_path / "in"), str(tmp_path / "run")
    every = frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])
    reference = every.filter("event_id < 100")
    edges = window_drift.decile_edges(reference, ["value"])

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        with window_drift.rocks_state(spark):
            return jobs.drain_to_parquet(window_drift.window_bins(stream, edges, ["source"], salts=3), "bins", folder)

    for frame in frames[:2]:
        frame.coalesce(1).write.mode("append").parquet(source)
    closed_first = {r["start"] for r in run().collect()}
    for frame in frames[2:]:
        frame.coalesce(1).write.mode("append").parquet(source)
    bins = run()
    closed = {r["start"] for r in bins.collect()}
    assert closed_first < closed and len(closed) == 4

    shares = window_drift.reference_shares(reference, edges, ["source"])
    got = {(r["start"], r["col"]): r for r in window_drift.window_drift(bins, shares).collect()}
    for day in closed:
        window = every.filter(F.col("ts").between(F.lit(day), F.lit(day + dt.timedelta(hours=23, minutes=59))))
        sides = reference.withColumn("side", F.lit("ref")).unionByName(window.withColumn("side", F.lit("cur")))
        psi = drift.drift_psi(drift.drift_long(sides, "side", ["value"])).first()
        js = drift.drift_js(sides.select("side", F.lit("source").alias("col"), F.col("source").alias("category"))).first()
        assert got[day, "value"]["n"] == window.count()
        assert got[day, "value"]["statistic"] == pytest.approx(psi["statistic"], abs=2e-6)
        assert got[day, "source"]["statistic"] == pytest.approx(js["statistic"], abs=2e-6)
        assert (got[day, "value"]["drifted"], got[day, "source"]["drifted"]) == (psi["drifted"], js["drifted"])
    last = window_drift.window_decisions(window_drift.window_drift(bins, shares)).orderBy(F.desc("start")).first()
    assert last["n_columns"] == 2 and last["drift_detected"]


def test_window_bins_leave_missing_values_out(spark):
    df = spark.createDataFrame([(None, "x"), (1.0, None), (3.0, "x")], "v double, s string")
    rows = window_drift.binned(df, {"v": [1.0, 2.0]}, ["s"], []).collect()
    assert sorted((r["col"], r["bin"]) for r in rows) == [("s", "x"), ("s", "x"), ("v", "0"), ("v", "2")]
    assert window_drift.binned(df.limit(0), {"v": [1.0]}, ["s"], []).count() == 0
