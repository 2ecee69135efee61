"""Registered streaming queries; the SQL twin is the batch result of closed windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from netsleuth.operators import gate, training
from netsleuth.plans import flow_queries as fq
from netsleuth.plans.registry import Family
from netsleuth.sources import views
from netsleuth.sources.tables import table
from netsleuth.streaming import jobs, window_drift

FAMILY = Family()
register = FAMILY.register

CLOSED = "(select max(ts) - interval 1 hour from events)"
_STAMP = "'%Y-%m-%d %H:%M:%S'"


def event_stream(spark, d):
    schema = table(spark, d, "events").schema
    return jobs.read_table_stream(spark, d, "events", schema).withColumn("ts", F.col("ts").cast("timestamp"))


def _stamped(df, *columns):
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns})


_EVENT_FLOW = {"IN_BYTES": "value", "IN_PKTS": "k", "MAX_TTL": "user_id"}
_EVENT_SQL = ("ev as (select event_id, value as IN_BYTES, json_extract_string(props, '$.k')::double as IN_PKTS, user_id::double as MAX_TTL from events), "
              "p as (select event_id, 1 / (1 + exp(-(-0.8::double + IN_PKTS::float::double * 0.35::double + "
              "(IN_PKTS / 1)::float::double * 0.1::double + MAX_TTL::float::double * -0.02::double))) as p from ev)")


@register("stream_score", f"with {_EVENT_SQL} select event_id, 'linear' as model_name, '1' as model_version, 'staging' as model_alias, "
          "round(p, 6) as malicious_probability, (p >= 0.5)::integer as prediction, "
          "case when p >= 0.5 then 'attack' else 'benign' end as verdict from p")
def _(spark, d):
    weights = {"IN_PKTS": 0.35, "PKT_DIR_RATIO": 0.1, "TTL_RANGE": -0.02}
    sources = {"value": F.col("value"), "k": F.get_json_object("props", "$.k").cast("double"), "user_id": F.col("user_id").cast("double")}
    flow = F.create_map(*[x for name, src in _EVENT_FLOW.items() for x in (F.lit(name), sources[src])])
    asked = event_stream(spark, d).select("event_id", flow.alias("flow"))
    return jobs.drain_to_parquet(training.score_with_linear(asked, "flow", ["event_id"], weights, -0.8), "score")


def event_rules():
    return [gate.expect_between("value", 1, 100), gate.expect_in_set("event_type", ["view", "click", "error", "signup"])]


@register("stream_gate", "select event_id, concat_ws(', ', case when value < 1 or value > 100 then "
          "'expect_column_values_to_be_between:value' end, case when event_type not in ('view', 'click', 'error', 'signup') then "
          "'expect_column_values_to_be_in_set:event_type' end) as failed_rules from events")
def _(spark, d):
    folder = jobs.new_run_dir(spark, "gate")
    events = event_stream(spark, d)
    jobs.drain_batches(events, jobs.gate_batches(event_rules(), folder), folder)
    good, bad = (jobs.gated_rows(spark, folder, events.schema, verdict) for verdict in ("good", "bad"))
    return good.unionByName(bad).select("event_id", F.array_join("failed_rules", ", ").alias("failed_rules"))


def _window_sql(windows, source):
    return (f"with w as ({windows}) select strftime(s, {_STAMP}) as start, strftime(e, {_STAMP}) as \"end\", {source}, count(*) as n, "
            f"sum(round(value * 100)::bigint)::bigint as cents from w where e <= {CLOSED} group by s, e, {source}")


register("stream_tumbling", _window_sql(
    "select *, time_bucket(interval 1 hour, ts) as s, time_bucket(interval 1 hour, ts) + interval 1 hour as e from events", "event_type"))(
    lambda spark, d: _stamped(jobs.drain_to_parquet(
        jobs.tumbling_counts(event_stream(spark, d), "event_type", "value"), "tumbling"), "start", "end"))
register("stream_sliding", _window_sql(
    "select *, time_bucket(interval 1 hour, ts) - i * interval 1 hour as s, time_bucket(interval 1 hour, ts) + (2 - i) * interval 1 hour as e "
    "from events, range(2) as r(i)", "event_type"))(
    lambda spark, d: _stamped(jobs.drain_to_parquet(
        jobs.sliding_counts(event_stream(spark, d), "event_type", "value"), "sliding"), "start", "end"))
register("stream_session",
         "with g as (select *, (ts - lag(ts) over w > interval 2 hours)::integer as brk from events window w as (partition by user_id order by ts)), "
         "n as (select *, sum(coalesce(brk, 0)) over (partition by user_id order by ts, event_id) as no from g), "
         "s as (select user_id, min(ts) as s, max(ts) + interval 2 hours as e, count(*) as n, sum(round(value * 100)::bigint)::bigint as cents "
         f"from n group by user_id, no) select user_id, strftime(s, {_STAMP}) as start, strftime(e, {_STAMP}) as \"end\", n, cents "
         f"from s where e <= {CLOSED}")(
    lambda spark, d: _stamped(jobs.drain_to_parquet(
        jobs.session_counts(event_stream(spark, d), "user_id", "value"), "session"), "start", "end"))


@register("stream_drift", "with ref as (select event_type, count(*) / sum(count(*)) over () as p from events where ts < timestamp "
          f"'{views.EVENT_CUT}' group by 1), w as (select date_trunc('day', ts) as s, event_type, count(*) as n from events group by 1, 2), "
          f"closed as (select * from w where s + interval 1 day <= {CLOSED}), days as (select distinct s from closed), "
          "f as (select days.s, coalesce(p, 0) as p, coalesce(n, 0) as n, sum(coalesce(n, 0)) over (partition by days.s) as t "
          "from days, ref left join closed on closed.s = days.s and closed.event_type = ref.event_type), "
          "q as (select s, n, p, n / t as q from f), r as (select s, sum(n)::bigint as n, round(sqrt(greatest(sum("
          "case when p > 0 then p * log2(p / ((p + q) / 2)) / 2 else 0 end + case when q > 0 then q * log2(q / ((p + q) / 2)) / 2 else 0 end), 0)), 6) "
          f"as statistic from q group by 1) select strftime(s, {_STAMP}) as start, n, statistic, statistic >= 0.1 as drifted from r")
def _(spark, d):
    before = table(spark, d, "events").filter(F.col("ts") < F.lit(views.EVENT_CUT).cast("timestamp_ntz"))
    counts = before.groupBy(F.col("event_type").alias("category")).agg(F.count(F.lit(1)).alias("c"))
    reference = counts.select("category", (F.col("c") / counts.agg(F.sum("c")).scalar()).alias("share"))
    folder = jobs.new_run_dir(spark, "drift")
    jobs.drain_batches(jobs.category_windows(event_stream(spark, d), "event_type"), jobs.drift_batches(reference, folder), folder)
    return _stamped(spark.read.parquet(f"{folder}/drift").select("start", "n", "statistic", "drifted"), "start")


_DRIFT_CELLS = ("edges as (select list_distinct(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) as ev, "
                "list_distinct(quantile_cont(k, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) as ek from ev where ref), "
                "cells as (select ref, s, 'value' as col, 'psi' as method, len(list_filter(ev, lambda x: x < value))::varchar as bin "
                "from ev, edges where value is not null union all select ref, s, 'k', 'psi', len(list_filter(ek, lambda x: x < k))::varchar "
                "from ev, edges where k is not null union all select ref, s, 'event_type', 'js', event_type from ev where event_type is not null)")
_WINDOW_DRIFT_SQL = (
    "with ev as (select *, json_extract_string(props, '$.k')::double as k, date_trunc('day', ts) as s, "
    f"ts < timestamp '{views.EVENT_CUT}' as ref from events), {_DRIFT_CELLS}, "
    "p as (select col, method, bin, count(*) / sum(count(*)) over (partition by col) as p from cells where ref group by 1, 2, 3), "
    f"n as (select s, col, method, bin, count(*) as n from cells where s + interval 1 day <= {CLOSED} group by 1, 2, 3, 4), "
    "win as (select distinct s, col, method from n), "
    "every_bin as (select s, col, method, bin from win join p using (col, method) union select s, col, method, bin from n), "
    "f as (select s, col, method, coalesce(p, 0) as p, coalesce(n, 0) as n, sum(coalesce(n, 0)) over (partition by s, col) as t "
    "from every_bin left join p using (col, method, bin) left join n using (s, col, method, bin)), "
    "q as (select s, col, method, n, p, n / t as q, greatest(p, 1e-4) as fp, greatest(n / t, 1e-4) as fq from f), "
    "r as (select s, col, method, sum(n)::bigint as n, round(case when method = 'psi' then sum((fp - fq) * ln(fp / fq)) else "
    "sqrt(greatest(sum(case when p > 0 then p * log2(p / ((p + q) / 2)) / 2 else 0 end + "
    "case when q > 0 then q * log2(q / ((p + q) / 2)) / 2 else 0 end), 0)) end, 6) as statistic from q group by 1, 2, 3), "
    "dr as (select *, statistic >= case when method = 'psi' then 0.2 else 0.1 end as drifted from r) ")


def window_columns(spark, d):
    """Drift of value, k and event_type in every closed day against the days before the cut."""
    with_k = lambda df: df.select("event_id", "ts", "value", F.get_json_object("props", "$.k").cast("double").alias("k"), "event_type")
    before = with_k(table(spark, d, "events").filter(F.col("ts") < F.lit(views.EVENT_CUT).cast("timestamp_ntz")))
    edges = window_drift.decile_edges(before, ["value", "k"])
    bins = window_drift.window_bins(with_k(event_stream(spark, d)), edges, ["event_type"])
    with window_drift.rocks_state(spark):
        counted = jobs.drain_to_parquet(bins, "bins")
    return window_drift.window_drift(counted, window_drift.reference_shares(before, edges, ["event_type"]))


register("stream_window_drift", f"{_WINDOW_DRIFT_SQL} select strftime(s, {_STAMP}) as start, col, method, n, statistic, drifted from dr")(
    lambda spark, d: _stamped(window_columns(spark, d), "start"))
register("stream_window_decision", f"{_WINDOW_DRIFT_SQL} select strftime(s, {_STAMP}) as start, "
         "count(*) filter (where drifted) as n_drifted_columns, count(*) as n_columns, "
         "count(*) filter (where drifted) / count(*) >= 0.5 as drift_detected from dr group by s")(
    lambda spark, d: _stamped(window_drift.window_decisions(window_columns(spark, d)), "start"))


@register("stream_dedup", "select event_id, event_type from events")
def _(spark, d):
    twice = event_stream(spark, d).unionByName(event_stream(spark, d))
    return jobs.drain_to_parquet(jobs.distinct_flows(twice, ["event_id"]), "dedup").select("event_id", "event_type")
