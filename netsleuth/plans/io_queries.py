"""Registered queries that write the given tables through each writer and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from netsleuth.functions.schema import FLOW_COLUMNS
from netsleuth.operators import gate
from netsleuth.plans.flow_queries import FLOWS_SQL
from netsleuth.plans.registry import Family
from netsleuth.session import shared_dir
from netsleuth.sources import io, views
from netsleuth.sources.tables import table

FAMILY = Family()
register = FAMILY.register

BUNDLE_SIZE = 500
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def new_place(spark, kind):
    return f"{shared_dir(spark)}/layers/{kind}-{uuid.uuid4().hex}"


@register("csv_flows", f"with {FLOWS_SQL} select {', '.join(FLOW_COLUMNS)}, 'csv' as provenance from flows")
def _(spark, d):
    """Flows as CSV, read from the second of two sources; the first does not exist."""
    place = new_place(spark, "csv")
    views.flows(spark, d).drop("ts").write.option("header", True).csv(place)
    flows, provenance = io.read_flows(spark, [place + "-absent", place])
    return flows.withColumn("provenance", F.lit(provenance.split(":")[0]))


@register("bundle_objects",
          "select 'intrusion-set--' || s_suppkey as id, 'intrusion-set' as type, s_name as name, s_acctbal < 0 as x_mitre_deprecated, "
          "2::bigint as n_references, null::varchar as ext_id from supplier union all "
          "select 'attack-pattern--' || p_partkey, 'attack-pattern', p_name, null, 2, 'T' || lpad(p_partkey::varchar, 7, '0') from part "
          "union all select 'malware--' || c_custkey, 'malware', c_name, c_acctbal < 0, 2, null from customer")
def _(spark, d):
    """Entities written as a folder of bundles of at most ``BUNDLE_SIZE`` objects a kind, one bundle a file."""
    place = new_place(spark, "bundles")
    entities = views.knowledge_nodes(spark, d)
    number = F.element_at(F.split("id", "--"), -1).cast("bigint")
    # keys are unique, so a bundle holds at most BUNDLE_SIZE objects
    bundles = entities.groupBy("type", F.floor(number / BUNDLE_SIZE).alias("no")).agg(
        F.collect_list(F.struct(*entities.columns)).alias("objects")).select("objects")
    bundles.write.option("maxRecordsPerFile", 1).json(place)
    return io.read_bundle(spark, place).select(
        "id", "type", "name", "x_mitre_deprecated", F.size("external_references").cast("bigint").alias("n_references"),
        F.col("external_references")[1]["external_id"].alias("ext_id"))


@register("jsonl_documents", "select doc_id, text, lang, source, n_chars from documents")
def _(spark, d):
    place = new_place(spark, "jsonl")
    io.write_jsonl(table(spark, d, "documents"), place)
    return io.read_jsonl(spark, place, DOCUMENTS)


@register("bronze_layer", f"with {FLOWS_SQL} select flow_id, {', '.join(FLOW_COLUMNS)}, 'second' as _ingest_source, "
          "'2024-01-02 00:00:00' as _ingest_ts from flows where Label = 1")
def _(spark, d):
    """Two batches landed one after the other: the layer holds the second alone."""
    place, flows = new_place(spark, "bronze"), views.flows(spark, d).drop("ts")
    io.land_bronze(flows, place, "first", "2024-01-01 00:00:00")
    io.land_bronze(flows.filter("Label = 1"), place, "second", "2024-01-02 00:00:00")
    return io.load_layer(spark, place).withColumn("_ingest_ts", F.date_format("_ingest_ts", "yyyy-MM-dd HH:mm:ss"))


@register("layer_partitions", f"with {FLOWS_SQL} select flow_id, Attack, case when Attack = 'Benign' then 'first' else 'second' end "
          "as batch from flows")
def _(spark, d):
    """A partitioned layer, then only its hostile partitions written anew; three columns are loaded."""
    place = new_place(spark, "layer")
    flows = views.flows(spark, d).drop("ts")
    io.write_layer(flows.withColumn("batch", F.lit("first")), place, ["Attack"])
    io.write_layer(flows.filter("Attack <> 'Benign'").withColumn("batch", F.lit("second")), place, ["Attack"])
    return io.load_layer(spark, place, ["flow_id", "Attack", "batch"])


@register("report_file", f"with {FLOWS_SQL} select Label, count(*) as flows, 1::bigint as files from flows group by 1")
def _(spark, d):
    place = new_place(spark, "report")
    io.write_report(gate.label_distribution(views.flows(spark, d)), place)
    rows = spark.read.schema("Label int, flows long").json(place).withColumn("_file", F.input_file_name())
    return rows.withColumn("files", rows.agg(F.count_distinct("_file")).scalar()).drop("_file")
