"""Cleaning, features, gate, splits and layers on small frames."""

import pytest
from pyspark.sql import functions as F

from netsleuth.functions.schema import ENGINEERED_FEATURES, FLOW_COLUMNS, FLOW_SCHEMA, MODEL_FEATURES, NUMERIC_FEATURES
from netsleuth.operators import cleaning, gate, splits
from netsleuth.sources import io

COLUMNS = ["IN_BYTES", "IN_PKTS", "OUT_BYTES", "OUT_PKTS", "FLOW_DURATION_MILLISECONDS", "MAX_IP_PKT_LEN",
           "MIN_IP_PKT_LEN", "MAX_TTL", "MIN_TTL", "RETRANSMITTED_IN_PKTS", "RETRANSMITTED_OUT_PKTS", "Label", "Attack"]
ORDINARY = (1000.0, 10.0, 500.0, 5.0, 99.0, 1500.0, 40.0, 64.0, 32.0, 1.0, 2.0, 1, "dos")
EMPTY = (0.0,) * 11 + (0, "Benign")


@pytest.fixture(scope="module")
def silver(spark):
    return spark.createDataFrame([ORDINARY, EMPTY], COLUMNS)


def flow_batch(spark, n=200, **fixed):
    values = {c: F.lit("10.0.0.1") if "ADDR" in c else F.lit(80) if "PORT" in c else (F.col("id") % 200).cast("double")
              for c in FLOW_COLUMNS}
    values.update(Label=(F.col("id") % 2).cast("int"), Attack=F.when(F.col("id") % 2 == 1, "dos").otherwise("Benign"))
    values.update({k: F.lit(v) for k, v in fixed.items()})
    return spark.range(n).select(*[values[c].alias(c) for c in FLOW_COLUMNS])


def test_feature_lists():
    assert len(NUMERIC_FEATURES) == 39 and len(MODEL_FEATURES) == 49
    assert set(MODEL_FEATURES).isdisjoint({"Label", "Attack"})


def test_engineered_values(silver):
    first, second = cleaning.engineer(silver).orderBy(F.desc("IN_BYTES")).collect()
    assert first["TOTAL_BYTES"] == 1500.0 and first["BYTES_PER_PKT_IN"] == 100.0
    assert first["BYTES_PER_MS"] == 15.0 and first["RETRANS_RATE"] == pytest.approx(0.2)
    assert all(second[c] is not None and abs(second[c]) < float("inf") for c in ENGINEERED_FEATURES)
    assert not {"Label", "Attack"} & set(cleaning.feature_columns(cleaning.engineer(silver)))


def test_safe_division_keeps_null(spark):
    from netsleuth.functions.columns import safe_div
    df = spark.createDataFrame([(6.0, 0.0), (6.0, 2.0), (6.0, None)], "a double, b double")
    assert [r[0] for r in df.select(safe_div(F.col("a"), F.col("b"))).collect()] == [6.0, 3.0, None]


def test_coerce_numeric(spark):
    df = spark.createDataFrame([("1.5", "x"), ("abc", "y"), (None, "z")], "v string, k string")
    assert [r["v"] for r in cleaning.coerce_numeric(df, ["v", "absent"]).orderBy("k").collect()] == [1.5, 0.0, 0.0]


def test_model_matrix_drops_overflow(spark):
    df = spark.createDataFrame([(1e300, float("nan"), 2.0)], "IN_BYTES double, IN_PKTS double, OUT_PKTS double")
    assert tuple(cleaning.model_matrix(df).first()) == (None, None, 2.0)


def test_complete_flow_defaults(spark):
    df = spark.createDataFrame([({"IN_BYTES": 5.0, "junk": 1.0},), ({"IN_BYTES": None},)], "flow map<string,double>")
    rows = cleaning.complete_flows(df, "flow").collect()
    assert rows[0]["IN_BYTES"] == 5.0 and rows[1]["IN_BYTES"] == 0.0 and len(rows[0]) == 39


def test_gate_passes_clean_batch(spark):
    report = gate.gate_report(flow_batch(spark), gate.flow_suite()).first()
    assert report["success"] and report["evaluated"] == 14 and report["passed"] == 14


@pytest.mark.parametrize("bad,rule", [({"Label": 7}, "in_set"), ({"IN_BYTES": -5.0}, "between"),
                                      ({"PROTOCOL": 256.0}, "between")])
def test_gate_fails(spark, bad, rule):
    batch = flow_batch(spark, **bad)
    report = gate.gate_report(batch, gate.flow_suite()).first()
    assert not report["success"] and any(rule in name for name in report["failed"])
    with pytest.raises(gate.GateFailed):
        gate.require(batch, gate.flow_suite())


def test_gate_edge_cases(spark):
    missing = flow_batch(spark).drop("Attack").withColumn("Attack", F.lit(None).cast("string"))
    failed = gate.gate_report(missing, gate.flow_suite()).first()["failed"]
    assert failed == ["expect_column_values_to_not_be_null:Attack"]
    lacking = flow_batch(spark).drop("TCP_FLAGS")
    assert "expect_table_columns_to_match_set" in gate.gate_report(lacking, gate.flow_suite()).first()["failed"]
    assert gate.gate_report(flow_batch(spark, 0), gate.flow_suite()).first()["success"]


def test_quarantine_is_complete(spark):
    batch = flow_batch(spark).withColumn("IN_BYTES", F.col("IN_BYTES") - 3)
    good, bad = gate.quarantine(batch, gate.flow_suite())
    assert good.count() + bad.count() == 200 and bad.count() == 3


def test_split_and_folds(spark):
    df = spark.range(1000).withColumn("label", F.when(F.col("id") < 700, 1).otherwise(0))
    parts = splits.hash_split(df, "id")
    assert 130 < parts.filter("part = 'test'").count() < 270
    folds = splits.stratified_kfold(df, "id", "label", 4).groupBy("label", "fold").count().collect()
    assert {(r["label"], r["count"]) for r in folds} == {(1, 175), (0, 75)}
    sample = splits.stratified_sample(df, "id", "label", 100).groupBy("label").count().collect()
    assert {(r["label"], r["count"]) for r in sample} == {(1, 70), (0, 30)}
    assert splits.stratified_sample(df, "id", "label", 5000).count() == 1000


def test_three_way_split(spark):
    edges = spark.range(10).select(F.col("id").alias("src"), (F.col("id") + 100).alias("dst"))
    parts = splits.three_way_split(edges, ["src", "dst"], 0.2, 0.2).groupBy("part").count().collect()
    assert {r["part"]: r["count"] for r in parts} == {"train": 6, "val": 2, "test": 2}


def test_flow_files_and_layers(spark, tmp_path):
    batch = flow_batch(spark, 50)
    batch.write.option("header", True).csv(str(tmp_path / "csv"))
    read, provenance = io.read_flows(spark, [str(tmp_path / "absent"), str(tmp_path / "csv")])
    assert provenance.endswith("csv") and read.schema == FLOW_SCHEMA and read.exceptAll(batch).count() == 0
    with pytest.raises(FileNotFoundError):
        io.read_flows(spark, [str(tmp_path / "absent")])
    io.land_bronze(read, str(tmp_path / "bronze"), provenance, "2024-01-01 00:00:00")
    bronze = io.load_layer(spark, str(tmp_path / "bronze"))
    assert bronze.select("_ingest_source").distinct().count() == 1 and bronze.count() == 50
    assert io.load_layer(spark, str(tmp_path / "bronze"), ["Label"]).columns == ["Label"]
    silver = cleaning.silver(bronze)
    assert not [c for c in silver.columns if c.startswith(("_ingest", "IPV4", "L4_"))]
    io.write_layer(silver, str(tmp_path / "silver"), ["Attack"])
    io.write_layer(silver.filter("Attack = 'dos'"), str(tmp_path / "silver"), ["Attack"])
    assert io.load_layer(spark, str(tmp_path / "silver")).count() == 50


def test_jsonl_and_report(spark, tmp_path):
    (tmp_path / "q.jsonl").write_text('{"user_input": "a", "reference": "T1"}\n\n{"user_input": "b", "reference": "T2"}\n')
    rows = io.read_jsonl(spark, str(tmp_path / "q.jsonl"), "user_input string, reference string")
    assert rows.count() == 2
    io.write_jsonl(rows, str(tmp_path / "out"))
    assert io.read_jsonl(spark, str(tmp_path / "out"), "user_input string, reference string").exceptAll(rows).count() == 0
    io.write_report(rows.limit(1), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).count() == 1


def test_feature_parity_counts_what_cannot_be_compared(spark):
    left = spark.createDataFrame([(1, 1.0, 2.0), (2, 1.0, None), (3, 1.0, 2.0)], "k int, x double, y double")
    right = spark.createDataFrame([(1, 1.0, 2.5), (2, 1.0, 3.0), (4, 1.0, 2.0)], "k int, x double, y double")
    got = {r["feature"]: tuple(r)[1:] for r in cleaning.feature_parity(left, right, "k", ["x", "y"]).collect()}
    assert got == {"x": (0.0, 2, False), "y": (0.5, 3, False)}
    same = {r["feature"]: r["within"] for r in cleaning.feature_parity(left, left, "k", ["x", "y"]).collect()}
    assert same == {"x": True, "y": True}
