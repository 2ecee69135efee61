"""Views that give the test tables the shapes the operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsleuth.functions.schema import ATTACK, FLOW_COLUMNS, LABEL, MODEL_FEATURES
from netsleuth.operators.cleaning import engineer, model_matrix
from netsleuth.sources.tables import table

DAY_MS = 86_400_000.0


def _ipv4(key: str) -> Column:
    k = F.col(key)
    octet = lambda shift: (F.shiftright(k, shift) % 256).cast("string")
    return F.concat_ws(".", F.lit("10"), octet(16), octet(8), octet(0))


def build_flows(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Roll event lines up to one flow record per key, in the full flow layout.

    Lines are aggregated before the join, so the join reuses their partitioning
    and moves one row per flow. Money is summed in whole cents, which is exact.
    """
    inbound, outbound = F.col("l_linestatus") == "F", F.col("l_linestatus") == "O"
    resent = F.col("l_returnflag") == "R"
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    money = lambda cond: F.coalesce(F.sum(F.when(cond, cents)), F.lit(0)) / F.lit(100.0)
    n = lambda cond: F.count_if(cond).cast("double")
    day = F.to_date("l_shipdate")
    span = lambda cond: F.coalesce(
        F.datediff(F.max(F.when(cond, day)), F.min(F.when(cond, day))), F.lit(0)) * F.lit(DAY_MS)
    flags = lambda cond: sum(
        (F.max(F.when(cond & (F.col("l_returnflag") == flag), F.lit(bit)).otherwise(0)) for flag, bit in
         (("A", 1), ("N", 2), ("R", 4))), F.lit(0)).cast("double")
    qty = F.col("l_quantity")
    size_band = lambda lo, hi: n((qty > lo) & (qty <= hi))
    everything = F.lit(True)
    top_quantity = lambda cond: F.coalesce(F.max(F.when(cond, qty)), F.lit(0.0))
    as_double = lambda agg: agg.cast("double")

    measures = {
        "L7_PROTO": as_double(F.max("l_linenumber")),
        "IN_BYTES": money(inbound), "IN_PKTS": n(inbound),
        "OUT_BYTES": money(outbound), "OUT_PKTS": n(outbound),
        "TCP_FLAGS": flags(everything), "CLIENT_TCP_FLAGS": flags(inbound), "SERVER_TCP_FLAGS": flags(outbound),
        "FLOW_DURATION_MILLISECONDS": span(everything), "DURATION_IN": span(inbound), "DURATION_OUT": span(outbound),
        "MIN_TTL": F.min(qty), "MAX_TTL": F.max(qty),
        "LONGEST_FLOW_PKT": F.max("l_extendedprice"), "SHORTEST_FLOW_PKT": F.min("l_extendedprice"),
        "RETRANSMITTED_IN_BYTES": money(resent & inbound), "RETRANSMITTED_IN_PKTS": n(resent & inbound),
        "RETRANSMITTED_OUT_BYTES": money(resent & outbound), "RETRANSMITTED_OUT_PKTS": n(resent & outbound),
        "NUM_PKTS_UP_TO_128_BYTES": size_band(0, 10), "NUM_PKTS_128_TO_256_BYTES": size_band(10, 20),
        "NUM_PKTS_256_TO_512_BYTES": size_band(20, 30), "NUM_PKTS_512_TO_1024_BYTES": size_band(30, 40),
        "NUM_PKTS_1024_TO_1514_BYTES": n(qty > 40),
        "TCP_WIN_MAX_IN": top_quantity(inbound), "TCP_WIN_MAX_OUT": top_quantity(outbound),
        "ICMP_TYPE": as_double(F.min("l_linenumber")),
        "DNS_QUERY_ID": as_double(F.min("l_partkey")), "DNS_QUERY_TYPE": as_double(F.max("l_suppkey")),
        "DNS_TTL_ANSWER": as_double(F.sum(F.round(F.col("l_discount") * 100).cast("bigint"))),
        "FTP_COMMAND_RET_CODE": as_double(F.sum(F.round(F.col("l_tax") * 100).cast("bigint"))),
    }
    rolled = lines.groupBy("l_orderkey").agg(
        *[m.alias(name) for name, m in measures.items()], F.min("l_suppkey").alias("_supp"))
    joined = rolled.join(orders, rolled["l_orderkey"] == orders["o_orderkey"])
    hostile = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    derived = {
        "IPV4_SRC_ADDR": _ipv4("o_custkey"),
        "L4_SRC_PORT": (F.lit(1024) + F.col("o_orderkey") % 64512).cast("int"),
        "IPV4_DST_ADDR": _ipv4("_supp"),
        "L4_DST_PORT": (F.col("DNS_QUERY_ID") % 65536).cast("int"),
        "PROTOCOL": (F.col("o_orderkey") % 256).cast("double"),
        "MIN_IP_PKT_LEN": F.col("SHORTEST_FLOW_PKT"),
        "MAX_IP_PKT_LEN": F.col("LONGEST_FLOW_PKT"),
        "SRC_TO_DST_SECOND_BYTES": F.when(F.col("IN_PKTS") >= 4, F.lit(1e300)).otherwise(F.col("IN_BYTES")),
        "DST_TO_SRC_SECOND_BYTES": F.col("OUT_BYTES"),
        "SRC_TO_DST_AVG_THROUGHPUT": F.col("IN_BYTES") * 8.0,
        "DST_TO_SRC_AVG_THROUGHPUT": F.col("OUT_BYTES") * 8.0,
        "ICMP_IPV4_TYPE": F.col("ICMP_TYPE"),
        LABEL: F.when(hostile, 1).otherwise(0),
        ATTACK: F.when(hostile, F.col("o_orderpriority")).otherwise("Benign"),
    }
    return joined.select(
        F.col("o_orderkey").alias("flow_id"), F.col("o_orderdate").alias("ts"),
        *[derived.get(name, F.col(name)).alias(name) for name in FLOW_COLUMNS])


def flows(spark: SparkSession, folder: str) -> DataFrame:
    return build_flows(table(spark, folder, "lineitem"), table(spark, folder, "orders"))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Event value as a detector score, error events as positives; scores tie."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"), (F.col("event_type") == "error").cast("int").alias("y"),
        F.col("value").alias("score"))


FLOW_CUT = "1998-01-01"
EVENT_CUT = "2024-01-16"
ASKED_FEATURES = ["IN_BYTES", "IN_PKTS", "OUT_BYTES", "OUT_PKTS", "FLOW_DURATION_MILLISECONDS",
                  "MIN_TTL", "MAX_TTL", "MIN_IP_PKT_LEN", "MAX_IP_PKT_LEN", "DNS_TTL_ANSWER"]


def flow_sides(spark: SparkSession, folder: str) -> DataFrame:
    """Every feature as the model sees it, with the side of the cut each flow lies on."""
    side = F.when(F.col("ts") < F.lit(FLOW_CUT).cast("timestamp_ntz"), "ref").otherwise("cur").alias("side")
    seen = model_matrix(engineer(flows(spark, folder)), ["flow_id", side])
    return seen.select("flow_id", "side", *[F.col(c).cast("double").alias(c) for c in MODEL_FEATURES])


def event_sides(spark: SparkSession, folder: str) -> DataFrame:
    side = F.when(F.col("ts") < F.lit(EVENT_CUT).cast("timestamp_ntz"), "ref").otherwise("cur")
    return table(spark, folder, "events").select(side.alias("side"), "event_type", "value")


def study(spark: SparkSession, folder: str) -> DataFrame:
    """Observational frame: priority handling as treatment, a returned line as outcome."""
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("y"))
    orders = table(spark, folder, "orders")
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    joined = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).join(
        customers, orders["o_custkey"] == customers["c_custkey"])
    return joined.select(
        F.col("o_orderkey").alias("unit"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1).otherwise(0).alias("t"),
        "y",
        (F.col("o_totalprice") / 100000.0).alias("price"),
        F.col("n_lines").cast("double").alias("lines"),
        (F.col("c_acctbal") / 1000.0).alias("balance"),
        F.col("c_mktsegment").alias("segment"),
        F.floor(F.col("o_totalprice") / 125000.0).alias("price_band"),
        F.least(F.col("n_lines"), F.lit(6)).alias("lines_band"))


def knowledge_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """Bundle-like entity objects: suppliers, parts and customers."""
    def entity(name, kind, key, label, ext, retired):
        df = table(spark, folder, name)
        return df.select(
            F.concat(F.lit(kind + "--"), F.col(key).cast("string")).alias("id"), F.lit(kind).alias("type"),
            F.col(label).alias("name"), F.lit(None).cast("boolean").alias("revoked"),
            retired.alias("x_mitre_deprecated"),
            F.array(reference("vendor", F.lit("x")), reference("mitre-attack", ext)).alias("external_references"))

    def reference(source, ext):
        return F.struct(F.lit(source).alias("source_name"), ext.alias("external_id"), F.lit("").alias("url"))

    none = F.lit(None).cast("string")
    part_no = F.concat(F.lit("T"), F.lpad(F.col("p_partkey").cast("string"), 7, "0"))
    return (
        entity("supplier", "intrusion-set", "s_suppkey", "s_name", none, F.col("s_acctbal") < 0)
        .unionByName(entity("part", "attack-pattern", "p_partkey", "p_name", part_no, F.lit(None).cast("boolean")))
        .unionByName(entity("customer", "malware", "c_custkey", "c_name", none, F.col("c_acctbal") < 0)))


def knowledge_relations(spark: SparkSession, folder: str) -> DataFrame:
    """Bundle-like relationship objects among those entities, each once."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    sold = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    # keys are made distinct before they become ids, and lines meet their orders once for both relations of a customer:
    # that moves less than half the bytes
    bought = sold.select(F.inline(F.array(
        F.struct(F.lit(True).alias("is_part"), F.col("o_custkey").alias("src"), F.col("l_partkey").alias("dst")),
        F.struct(F.lit(False).alias("is_part"), F.col("l_suppkey").alias("src"), F.col("o_custkey").alias("dst"))))).distinct()
    ref = lambda kind, key: F.concat(F.lit(kind + "--"), F.col(key).cast("string"))

    def relation(df, rel, src, dst):
        return df.select(F.lit(rel).alias("relationship_type"), src.alias("source_ref"), dst.alias("target_ref"))

    parts = table(spark, folder, "part").select("p_partkey", "p_brand")
    heads = parts.groupBy("p_brand").agg(F.min("p_partkey").alias("head"))
    subs = parts.join(heads, "p_brand").filter("p_partkey <> head")
    return (
        relation(lines.select("l_suppkey", "l_partkey").distinct(), "uses",
                 ref("intrusion-set", "l_suppkey"), ref("attack-pattern", "l_partkey"))
        .unionByName(relation(bought, "uses",
                              F.when(F.col("is_part"), ref("malware", "src")).otherwise(ref("intrusion-set", "src")),
                              F.when(F.col("is_part"), ref("attack-pattern", "dst")).otherwise(ref("malware", "dst"))))
        .unionByName(relation(subs.select("p_partkey", "head").distinct(), "subtechnique-of",
                              ref("attack-pattern", "p_partkey"), ref("attack-pattern", "head")))
        .withColumn("revoked", F.lit(None).cast("boolean"))
        .withColumn("x_mitre_deprecated", F.lit(None).cast("boolean")))
