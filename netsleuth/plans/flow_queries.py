"""Registered queries of the flow family, each beside its SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from netsleuth.functions.columns import linear_probability, safe_div, verdict_columns
from netsleuth.functions.schema import (
    ATTACK, ENGINEERED_FEATURES, FLOW_COLUMNS, LABEL, MODEL_FEATURES, NUMERIC_FEATURES)
from netsleuth.operators import cleaning, drift, gate, metrics, splits
from netsleuth.plans.registry import Family
from netsleuth.sources import views
from netsleuth.sources.io import tag_ingest
from netsleuth.sources.tables import table

FAMILY = Family()
register = FAMILY.register


# --- SQL twins of the views ------------------------------------------------
def _span(cond):
    return (f"coalesce(date_diff('day', min(case when {cond} then l_shipdate::date end), "
            f"max(case when {cond} then l_shipdate::date end)), 0) * 86400000.0::double")


def _money(cond):
    return f"coalesce(sum(case when {cond} then round(l_extendedprice * 100)::bigint end), 0)::bigint / 100.0::double"


def _n(cond):
    return f"count(*) filter (where {cond})::double"


def _flags(cond):
    return "(" + " + ".join(
        f"max(case when {cond} and l_returnflag = '{f}' then {b} else 0 end)" for f, b in
        (("A", 1), ("N", 2), ("R", 4))) + ")::double"


_IN, _OUT, _R = "l_linestatus = 'F'", "l_linestatus = 'O'", "l_returnflag = 'R'"
_MEASURES = {
    "L7_PROTO": "max(l_linenumber)::double",
    "IN_BYTES": _money(_IN), "IN_PKTS": _n(_IN), "OUT_BYTES": _money(_OUT), "OUT_PKTS": _n(_OUT),
    "TCP_FLAGS": _flags("true"), "CLIENT_TCP_FLAGS": _flags(_IN), "SERVER_TCP_FLAGS": _flags(_OUT),
    "FLOW_DURATION_MILLISECONDS": _span("true"), "DURATION_IN": _span(_IN), "DURATION_OUT": _span(_OUT),
    "MIN_TTL": "min(l_quantity)", "MAX_TTL": "max(l_quantity)",
    "LONGEST_FLOW_PKT": "max(l_extendedprice)", "SHORTEST_FLOW_PKT": "min(l_extendedprice)",
    "RETRANSMITTED_IN_BYTES": _money(f"{_R} and {_IN}"), "RETRANSMITTED_IN_PKTS": _n(f"{_R} and {_IN}"),
    "RETRANSMITTED_OUT_BYTES": _money(f"{_R} and {_OUT}"), "RETRANSMITTED_OUT_PKTS": _n(f"{_R} and {_OUT}"),
    "NUM_PKTS_UP_TO_128_BYTES": _n("l_quantity > 0 and l_quantity <= 10"),
    "NUM_PKTS_128_TO_256_BYTES": _n("l_quantity > 10 and l_quantity <= 20"),
    "NUM_PKTS_256_TO_512_BYTES": _n("l_quantity > 20 and l_quantity <= 30"),
    "NUM_PKTS_512_TO_1024_BYTES": _n("l_quantity > 30 and l_quantity <= 40"),
    "NUM_PKTS_1024_TO_1514_BYTES": _n("l_quantity > 40"),
    "TCP_WIN_MAX_IN": f"coalesce(max(case when {_IN} then l_quantity end), 0)",
    "TCP_WIN_MAX_OUT": f"coalesce(max(case when {_OUT} then l_quantity end), 0)",
    "ICMP_TYPE": "min(l_linenumber)::double",
    "DNS_QUERY_ID": "min(l_partkey)::double", "DNS_QUERY_TYPE": "max(l_suppkey)::double",
    "DNS_TTL_ANSWER": "sum(round(l_discount * 100)::bigint)::double",
    "FTP_COMMAND_RET_CODE": "sum(round(l_tax * 100)::bigint)::double",
}


def _ip(key):
    return f"'10.' || ({key} // 65536 % 256) || '.' || ({key} // 256 % 256) || '.' || ({key} % 256)"


_DERIVED = {
    "IPV4_SRC_ADDR": _ip("o_custkey"), "L4_SRC_PORT": "(1024 + o_orderkey % 64512)::integer",
    "IPV4_DST_ADDR": _ip("supp"), "L4_DST_PORT": "(DNS_QUERY_ID % 65536)::integer",
    "PROTOCOL": "(o_orderkey % 256)::double",
    "MIN_IP_PKT_LEN": "SHORTEST_FLOW_PKT", "MAX_IP_PKT_LEN": "LONGEST_FLOW_PKT",
    "SRC_TO_DST_SECOND_BYTES": "case when IN_PKTS >= 4 then 1e300 else IN_BYTES end",
    "DST_TO_SRC_SECOND_BYTES": "OUT_BYTES",
    "SRC_TO_DST_AVG_THROUGHPUT": "IN_BYTES * 8.0::double", "DST_TO_SRC_AVG_THROUGHPUT": "OUT_BYTES * 8.0::double",
    "ICMP_IPV4_TYPE": "ICMP_TYPE",
    "Label": "case when o_orderpriority in ('1-URGENT', '2-HIGH') then 1 else 0 end::integer",
    "Attack": "case when o_orderpriority in ('1-URGENT', '2-HIGH') then o_orderpriority else 'Benign' end",
}
FLOWS_SQL = (
    "rolled as (select l_orderkey, min(l_suppkey) as supp, "
    + ", ".join(f"{sql} as {name}" for name, sql in _MEASURES.items())
    + " from lineitem group by l_orderkey), flows as (select o_orderkey as flow_id, o_orderdate as ts, "
    + ", ".join(f"{_DERIVED[n]} as {n}" if n in _DERIVED else n for n in FLOW_COLUMNS)
    + " from rolled join orders on l_orderkey = o_orderkey)")


def _sdiv(num, den):
    return f"({num}) / (case when ({den}) = 0 then 1.0::double else ({den}) end)"


_TB, _TP = "IN_BYTES + OUT_BYTES", "IN_PKTS + OUT_PKTS"
ENGINEERED_SQL = {
    "TOTAL_BYTES": _TB, "TOTAL_PKTS": _TP,
    "BYTES_PER_PKT_IN": _sdiv("IN_BYTES", "IN_PKTS"), "BYTES_PER_PKT_OUT": _sdiv("OUT_BYTES", "OUT_PKTS"),
    "BYTE_DIR_RATIO": _sdiv("IN_BYTES", "OUT_BYTES + 1"), "PKT_DIR_RATIO": _sdiv("IN_PKTS", "OUT_PKTS + 1"),
    "BYTES_PER_MS": _sdiv(_TB, "FLOW_DURATION_MILLISECONDS + 1"),
    "PKT_SIZE_RANGE": "MAX_IP_PKT_LEN - MIN_IP_PKT_LEN", "TTL_RANGE": "MAX_TTL - MIN_TTL",
    "RETRANS_RATE": _sdiv("RETRANSMITTED_IN_PKTS + RETRANSMITTED_OUT_PKTS", _TP),
}
GOLD_SQL = FLOWS_SQL + ", gold as (select *, " + ", ".join(
    f"{sql} as {n}" for n, sql in ENGINEERED_SQL.items()) + " from flows)"
SCORED_SQL = "scored as (select event_id as id, (event_type = 'error')::integer as y, value as score from events)"


def md5_long(seed, key):
    return f"('0x' || substr(md5('{seed}|' || {key}), 1, 8))::bigint"


# --- landing, cleaning, features -------------------------------------------
register("build_flows", f"with {FLOWS_SQL} select * exclude (ts) from flows")(
    lambda spark, d: views.flows(spark, d).drop("ts"))


@register("bronze_land", f"with {FLOWS_SQL} select * exclude (ts), 'lineitem+orders' as _ingest_source, "
          "'2024-01-01 00:00:00' as _ingest_ts from flows")
def _(spark, d):
    landed = tag_ingest(views.flows(spark, d).drop("ts"), "lineitem+orders", "2024-01-01 00:00:00")
    return landed.withColumn("_ingest_ts", F.date_format("_ingest_ts", "yyyy-MM-dd HH:mm:ss"))


@register("silver", f"with {FLOWS_SQL} select flow_id, {', '.join(NUMERIC_FEATURES)}, Label, Attack from flows")
def _(spark, d):
    bronze = tag_ingest(views.flows(spark, d), "lineitem+orders", "2024-01-01 00:00:00")
    return cleaning.silver(bronze).drop("ts")


@register("coerce_numeric", "select event_id, coalesce(try_cast(json_extract_string(props, '$.k') as double), 0) as k, "
          "coalesce(try_cast(event_type as double), 0) as word from events")
def _(spark, d):
    raw = table(spark, d, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"), F.col("event_type").alias("word"))
    return cleaning.coerce_numeric(raw, ["k", "word", "absent"])


@register("safe_div", f"with {FLOWS_SQL} select flow_id, {_sdiv('IN_BYTES', 'IN_PKTS')} as per_packet, "
          f"{_sdiv('OUT_BYTES', 'OUT_PKTS - 1')} as shifted from flows")
def _(spark, d):
    return views.flows(spark, d).select(
        "flow_id", safe_div(F.col("IN_BYTES"), F.col("IN_PKTS")).alias("per_packet"),
        safe_div(F.col("OUT_BYTES"), F.col("OUT_PKTS") - 1.0).alias("shifted"))


register("engineer_features", f"with {GOLD_SQL} select flow_id, {', '.join(ENGINEERED_FEATURES)} from gold")(
    lambda spark, d: cleaning.engineer(views.flows(spark, d)).select("flow_id", *ENGINEERED_FEATURES))


@register("complete_flow", f"with {FLOWS_SQL} select flow_id, " + ", ".join(
    n if n in views.ASKED_FEATURES else f"0.0::double as {n}" for n in NUMERIC_FEATURES) + " from flows")
def _(spark, d):
    pairs = [x for n in views.ASKED_FEATURES for x in (F.lit(n), F.col(n))]
    asked = views.flows(spark, d).select("flow_id", F.create_map(*pairs, F.lit("unknown"), F.lit(1.0)).alias("flow"))
    return cleaning.complete_flows(asked, "flow", ["flow_id"])


@register("model_matrix", f"with {GOLD_SQL} select flow_id, " + ", ".join(
    f"case when abs({n}) > 3.4028235677973366e38 then null else {n} end::float as {n}" for n in MODEL_FEATURES)
    + " from gold")
def _(spark, d):
    return cleaning.model_matrix(cleaning.engineer(views.flows(spark, d)), ["flow_id"])


@register("feature_parity", "select unnest([" + ", ".join(f"'{n}'" for n in ENGINEERED_FEATURES) + "]) as feature, "
          "0.0::double as max_abs_diff, 0::bigint as missing, true as within")
def _(spark, d):
    gold = cleaning.engineer(views.flows(spark, d))
    asked = views.flows(spark, d).select(
        "flow_id", F.map_from_arrays(
            F.array(*[F.lit(n) for n in NUMERIC_FEATURES]),
            F.array(*[F.col(n) for n in NUMERIC_FEATURES])).alias("flow"))
    online = cleaning.engineer(cleaning.complete_flows(asked, "flow", ["flow_id"]))
    return cleaning.feature_parity(gold, online, "flow_id", ENGINEERED_FEATURES)


# --- quality gate ----------------------------------------------------------
def strict_rules():
    """A suite that part of the flows break, so failing paths run too."""
    return [gate.expect_between("IN_PKTS", 1), gate.expect_between("PROTOCOL", 0, 200),
            gate.expect_in_set(ATTACK, ["Benign", "1-URGENT"])]


_VOLUMES = ["IN_BYTES", "OUT_BYTES", "IN_PKTS", "OUT_PKTS"]
_RULES_SQL = (
    [("expect_column_values_to_not_be_null:" + c, f"{c} is null") for c in ["Label"]]
    + [("expect_column_values_to_be_in_set:Label", "Label not in (0, 1)")]
    + [("expect_column_values_to_not_be_null:" + c, f"{c} is null") for c in ["Attack"] + _VOLUMES + ["PROTOCOL"]]
    + [("expect_column_values_to_be_between:" + c, f"{c} < 0") for c in _VOLUMES]
    + [("expect_column_values_to_be_between:PROTOCOL", "PROTOCOL < 0 or PROTOCOL > 255")])
_STRICT_SQL = [("expect_column_values_to_be_between:IN_PKTS", "IN_PKTS < 1"),
               ("expect_column_values_to_be_between:PROTOCOL", "PROTOCOL < 0 or PROTOCOL > 200"),
               ("expect_column_values_to_be_in_set:Attack", "Attack not in ('Benign', '1-URGENT')")]


def _rule_rows(rules, source="flows"):
    return " union all ".join(
        f"select '{name}' as rule, count(*) as evaluated, count(*) filter (where {bad}) as violations from {source}"
        for name, bad in rules)


_ALL_RULES = (f"rules as (select 'expect_table_columns_to_match_set' as rule, count(*) as evaluated, "
              f"0::bigint as violations from flows union all {_rule_rows(_RULES_SQL)})")
register("gate_rules", f"with {FLOWS_SQL}, {_ALL_RULES} select *, violations = 0 as success from rules")(
    lambda spark, d: gate.gate_rules(views.flows(spark, d), gate.flow_suite()))


@register("gate_report", f"with {FLOWS_SQL}, rules as ({_rule_rows(_RULES_SQL + _STRICT_SQL)} union all "
          "select 'expect_table_columns_to_match_set', count(*), 0 from flows) "
          "select bool_and(violations = 0) as success, count(*) as evaluated, "
          "count(*) filter (where violations = 0) as passed, "
          "string_agg(rule, ', ' order by rule) filter (where violations > 0) as failed from rules")
def _(spark, d):
    report = gate.gate_report(views.flows(spark, d), gate.flow_suite() + strict_rules())
    return report.withColumn("failed", F.array_join("failed", ", "))


@register("gate_quarantine", f"with {FLOWS_SQL} select flow_id, concat_ws(', ', " + ", ".join(
    f"case when {bad} then '{name}' end" for name, bad in _STRICT_SQL) + ") as failed_rules from flows where "
    + " or ".join(bad for _, bad in _STRICT_SQL))
def _(spark, d):
    _, bad = gate.quarantine(views.flows(spark, d), strict_rules())
    return bad.select("flow_id", F.array_join("failed_rules", ", ").alias("failed_rules"))


register("label_distribution", f"with {FLOWS_SQL} select Label, count(*) as flows from flows group by 1")(
    lambda spark, d: gate.label_distribution(views.flows(spark, d)))

# --- splits ----------------------------------------------------------------
register("split_train_test", f"with {FLOWS_SQL} select flow_id, case when {md5_long(42, 'flow_id')} % 10000 < 2000 "
         "then 'test' else 'train' end as part from flows")(
    lambda spark, d: splits.hash_split(views.flows(spark, d).select("flow_id"), "flow_id"))

_RANKED = "row_number() over (partition by Label order by md5('42|' || flow_id), flow_id)"
register("stratified_sample", f"with {FLOWS_SQL}, n as (select Label as lab, count(*) as c, sum(count(*)) over () as tot "
         f"from flows group by 1), r as (select flow_id, Label, {_RANKED} as rk from flows) "
         "select flow_id, Label from r join n on lab = Label "
         "where rk <= case when tot <= 5000 then c else round(c * 5000.0::double / tot) end")(
    lambda spark, d: splits.stratified_sample(
        views.flows(spark, d).select("flow_id", LABEL), "flow_id", LABEL, 5000))
register("kfold", f"with {FLOWS_SQL} select flow_id, Label, ({_RANKED} % 3)::integer as fold from flows")(
    lambda spark, d: splits.stratified_kfold(views.flows(spark, d).select("flow_id", LABEL), "flow_id", LABEL))

# --- evaluation ------------------------------------------------------------
register("verdict", f"with {SCORED_SQL} select id, y, score, round(score, 6) as malicious_probability, "
         "(score >= 20)::integer as prediction, case when score >= 20 then 'attack' else 'benign' end as verdict "
         "from scored")(lambda spark, d: metrics.with_verdict(views.scored(spark, d), threshold=20.0))

_CONF = (f"{SCORED_SQL}, cm as (select count(*) filter (where y = 0 and score < 20) as tn, "
         "count(*) filter (where y = 0 and score >= 20) as fp, count(*) filter (where y = 1 and score < 20) as fn, "
         "count(*) filter (where y = 1 and score >= 20) as tp from scored)")
_PRF = ("round(case when tp + fp > 0 then tp / (tp + fp) else 0 end, 4) as {0}precision, "
        "round(case when tp + fn > 0 then tp / (tp + fn) else 0 end, 4) as {0}recall, "
        "round(case when tp > 0 then 2 * tp / (2 * tp + fp + fn) else 0 end, 4) as {0}f1")
_RANKS = (
    "g as (select score, sum(y)::bigint as pos, sum(1 - y)::bigint as neg from scored group by 1), "
    "s as (select *, sum(neg) over (order by score)::double as cneg, sum(pos) over (order by score desc)::double as tp, "
    "sum(neg) over (order by score desc)::double as fp, sum(pos) over ()::double as n1, sum(neg) over ()::double as n0 from g), "
    "auc as (select round(sum(pos * (cneg - neg + neg / 2.0::double)) / nullif(max(n1 * n0), 0), 6) as roc_auc, "
    "round(sum(pos * tp / (tp + fp)) / nullif(max(n1), 0), 6) as average_precision from s)")


def ranking_sql(source_ctes, columns="roc_auc, average_precision"):
    """Exact ranking metrics over a CTE named ``scored`` with y and score."""
    return f"with {source_ctes}, {_RANKS} select {columns} from auc"


_confused = lambda spark, d: metrics.confusion(metrics.with_verdict(views.scored(spark, d), threshold=20.0))
register("confusion", f"with {_CONF} select * from cm")(_confused)
register("prf", f"with {_CONF} select {_PRF.format('')} from cm")(
    lambda spark, d: metrics.precision_recall_f1(_confused(spark, d)))
register("roc_auc", ranking_sql(SCORED_SQL, "roc_auc"))(lambda spark, d: metrics.roc_auc(views.scored(spark, d)))
register("average_precision", ranking_sql(SCORED_SQL, "average_precision"))(
    lambda spark, d: metrics.average_precision(views.scored(spark, d)))
register("evaluate_detector", f"with {_CONF}, {_RANKS} select roc_auc as test_roc_auc, average_precision as test_pr_auc, "
         f"{_PRF.format('test_')}, tn as test_tn, fp as test_fp, fn as test_fn, tp as test_tp from cm, auc")(
    lambda spark, d: metrics.evaluate_detector(views.scored(spark, d), threshold=20.0))
register("class_weight", f"with {FLOWS_SQL} select round(count(*) filter (where Label = 0) / "
         "greatest(count(*) filter (where Label = 1), 1), 4) as class_weight from flows")(
    lambda spark, d: metrics.class_weight(views.flows(spark, d), LABEL))


@register("metric_summary", "with j as (select quality, toxic from documents left join labels using (doc_id)) "
          "select 'quality' as metric, round(avg(quality), 4) as mean, count(quality) as n_scored, count(*) as n_total "
          "from j union all select 'toxic', round(avg(toxic), 4), count(toxic), count(*) from j")
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id")
    return metrics.metric_summary(docs.join(table(spark, d, "labels"), "doc_id", "left"), ["quality", "toxic"])


# --- drift -----------------------------------------------------------------
SIDES_SQL = GOLD_SQL + (
    f", sides as (select flow_id, case when ts < timestamp '{views.FLOW_CUT}' then 'ref' else 'cur' end as side, "
    + ", ".join(f"case when abs({n}) > 3.4028235677973366e38 then null else {n} end::float::double as {n}" for n in MODEL_FEATURES)
    + " from gold)")
EVENT_SIDES_SQL = (f"esides as (select case when ts < timestamp '{views.EVENT_CUT}' then 'ref' else 'cur' end as side, "
                   "event_type, value from events)")


def _long_sql(source, features):
    return " union all ".join(
        f"select side, '{c}' as col, {c}::double as value from {source} where {c} is not null" for c in features)


LONG_SQL = f"{SIDES_SQL}, {EVENT_SIDES_SQL}, long as ({_long_sql('sides', MODEL_FEATURES)} union all {_long_sql('esides', ['value'])})"
MOVED = MODEL_FEATURES[: len(MODEL_FEATURES) // 2]
PERTURBED_SQL = (SIDES_SQL + ", cur as (select * from sides where side = 'cur'), moved as (select * replace ("
                 + ", ".join(f"{c} * 3 + (select stddev_samp({c}) from cur) as {c}" for c in MOVED)
                 + ") from cur union all select * from sides where side = 'ref'), "
                 f"long as ({_long_sql('moved', MODEL_FEATURES)})")
_CURVES = (
    "vc as (select col, value, count(*) filter (where side = 'ref') as nr, count(*) filter (where side = 'cur') as nc "
    "from long group by 1, 2), curves as (select col, value, sum(nr) over w as cr, sum(nc) over w as cc, "
    "sum(nr) over (partition by col)::double as tr, sum(nc) over (partition by col)::double as tc, "
    "lead(value) over w as nxt from vc window w as (partition by col order by value))")
WASSERSTEIN_SQL = _CURVES + (
    ", sd as (select col, stddev_samp(value) as sd from long where side = 'ref' group by 1), "
    "area as (select col, sum(abs(cr / tr - cc / tc) * (coalesce(nxt, value) - value)) as area from curves group by 1), "
    "wass as (select col, round(area / case when coalesce(sd, 0) = 0 then 1e-3 else sd end, 6) as statistic, "
    "round(area / case when coalesce(sd, 0) = 0 then 1e-3 else sd end, 6) >= 0.1 as drifted from area join sd using (col))")
KS_SQL = _CURVES + (
    ", ks as (select col, round(max(abs(cr / tr - cc / tc)), 6) as statistic, "
    "round(1.358 * sqrt((max(tr) + max(tc)) / (max(tr) * max(tc))), 6) as cut from curves group by 1)")
_JS_SQL = (
    "c as (select event_type, count(*) filter (where side = 'ref') as nr, count(*) filter (where side = 'cur') as nc "
    "from esides group by 1), p as (select nr / sum(nr) over () as p, nc / sum(nc) over () as q from c), "
    "js as (select 'event_type' as col, round(sqrt(greatest(sum("
    "case when p > 0 then p * log2(p / ((p + q) / 2)) / 2 else 0 end + "
    "case when q > 0 then q * log2(q / ((p + q) / 2)) / 2 else 0 end), 0)), 6) as statistic from p)")


def drift_rows(spark, d):
    flows = drift.drift_long(views.flow_sides(spark, d), "side", MODEL_FEATURES)
    return flows.unionByName(drift.drift_long(views.event_sides(spark, d), "side", ["value"]))


def category_rows(spark, d):
    return views.event_sides(spark, d).select("side", F.lit("event_type").alias("col"), F.col("event_type").alias("category"))


def perturbed_rows(spark, d):
    sides = views.flow_sides(spark, d)
    moved = drift.perturb(sides.filter("side = 'cur'"), MODEL_FEATURES)
    return drift.drift_long(moved.unionByName(sides.filter("side = 'ref'")), "side", MODEL_FEATURES)


def decision_sql(table_name):
    return ("select coalesce(count(*) filter (where drifted) / count(*) >= 0.5, false) as drift_detected, "
            "round(count(*) filter (where drifted) / count(*), 4) as share_of_drifted_columns, "
            "count(*) filter (where drifted) as n_drifted_columns, count(*) as n_columns, 0.5::double as threshold, "
            "case when count(*) filter (where drifted) / count(*) >= 0.5 then 'retrain_features' else 'skip_retrain' end "
            f"as decision from {table_name}")


register("drift_wasserstein", f"with {LONG_SQL}, {WASSERSTEIN_SQL} select * from wass")(
    lambda spark, d: drift.drift_wasserstein(drift_rows(spark, d)))
register("drift_ks", f"with {LONG_SQL}, {KS_SQL} select *, statistic >= cut as drifted from ks")(
    lambda spark, d: drift.drift_ks(drift_rows(spark, d)))
register("drift_psi", f"with {LONG_SQL}, e as (select col, list_distinct(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, "
         "0.6, 0.7, 0.8, 0.9])) as edges from long where side = 'ref' group by 1), "
         "b as (select col, len(list_filter(edges, lambda x: x < value)) as bin, count(*) filter (where side = 'ref') as nr, "
         "count(*) filter (where side = 'cur') as nc from long join e using (col) group by 1, 2), "
         "s as (select col, greatest(nr / sum(nr) over (partition by col), 1e-4) as p, "
         "greatest(nc / sum(nc) over (partition by col), 1e-4) as q from b), "
         "r as (select col, round(sum((p - q) * ln(p / q)), 6) as statistic from s group by 1) "
         "select *, statistic >= 0.2 as drifted from r")(lambda spark, d: drift.drift_psi(drift_rows(spark, d)))
register("drift_js", f"with {EVENT_SIDES_SQL}, {_JS_SQL} select *, statistic >= 0.1 as drifted from js")(
    lambda spark, d: drift.drift_js(category_rows(spark, d)))


@register("drift_decision", f"with {LONG_SQL}, {WASSERSTEIN_SQL}, {_JS_SQL}, every_col as (select col, drifted from wass "
          f"union all select col, statistic >= 0.1 from js) {decision_sql('every_col')}")
def _(spark, d):
    tested = drift.drift_wasserstein(drift_rows(spark, d)).unionByName(drift.drift_js(category_rows(spark, d)))
    return drift.drift_decision(tested)


register("drift_perturbed", f"with {PERTURBED_SQL}, {WASSERSTEIN_SQL} {decision_sql('wass')}")(
    lambda spark, d: drift.drift_decision(drift.drift_wasserstein(perturbed_rows(spark, d))))


@register("next_task", f"with {PERTURBED_SQL}, {WASSERSTEIN_SQL} select decision as task from ({decision_sql('wass')})")
def _(spark, d):
    first = drift.drift_decision(drift.drift_js(category_rows(spark, d))).withColumn("ts", F.lit(1))
    second = drift.drift_decision(drift.drift_wasserstein(perturbed_rows(spark, d))).withColumn("ts", F.lit(2))
    return drift.next_task(first.unionByName(second))


# --- flagship --------------------------------------------------------------
WEIGHTS = {"IN_PKTS": 0.35, "RETRANS_RATE": 1.5, "TTL_RANGE": -0.02, "PKT_DIR_RATIO": 0.1}
BIAS = -0.8
LOGIT_SQL = "(1 / (1 + exp(-(" + f"{BIAS}::double + " + " + ".join(
    f"{n}::float::double * {WEIGHTS[n]}::double" for n in MODEL_FEATURES if n in WEIGHTS) + "))))"
FLAGSHIP_SQL = (f"with {GOLD_SQL}, p as (select Label, case when {LOGIT_SQL} >= 0.5 then 'attack' else 'benign' end as verdict, "
                f"TOTAL_BYTES from gold where PROTOCOL between 0 and 255) select Label, verdict, count(*) as flows, "
                "round(sum(round(TOTAL_BYTES * 100)::bigint) / 100.0::double, 2) as total_bytes from p group by 1, 2")


@register("flow_verdicts", FLAGSHIP_SQL)
def flow_verdicts(spark, d):
    """Roll up flows, keep the rows that pass the gate, engineer, score, count verdicts."""
    good, _ = gate.quarantine(views.flows(spark, d), gate.flow_suite())
    gold = cleaning.engineer(good)
    matrix = cleaning.model_matrix(gold, [LABEL, F.col("TOTAL_BYTES").alias("_bytes")])
    judged = matrix.select(LABEL, "_bytes", *verdict_columns(linear_probability(WEIGHTS, BIAS)))
    return judged.groupBy(LABEL, "verdict").agg(
        F.count(F.lit(1)).alias("flows"),
        F.round(F.sum(F.round(F.col("_bytes") * 100).cast("bigint")) / F.lit(100.0), 2).alias("total_bytes"))
