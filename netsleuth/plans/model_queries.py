"""Registered queries of the model family and the scheduled job, each beside its SQL twin."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from netsleuth.functions.schema import LABEL, MODEL_FEATURES, NUMERIC_FEATURES
from netsleuth.operators import boosting, cleaning, drift, gate, registry, training
from netsleuth.plans import flow_queries as fq
from netsleuth.plans import jobs
from netsleuth.plans.registry import Family
from netsleuth.sources import views
from netsleuth.streaming.jobs import new_run_dir

FAMILY = Family()
register = FAMILY.register

SHAP_WEIGHTS = {"IN_PKTS": 0.35, "OUT_PKTS": -0.2, "MIN_TTL": 0.01, "MAX_TTL": 0.02, "RETRANS_RATE": 1.5,
                "PKT_DIR_RATIO": 0.1, "TCP_FLAGS": 0.4}


def matrix(spark, d):
    return cleaning.model_matrix(cleaning.engineer(views.flows(spark, d)), ["flow_id", LABEL])


def vectors(spark, d):
    return training.feature_vectors(matrix(spark, d), ["flow_id", LABEL])


# fits have no SQL twin; tests check what they learn
@register("train_detector")
def _(spark, d):
    from netsleuth.session import durable

    data = durable(vectors(spark, d))
    model = training.train_detector(data, "flow_id")
    scored = training.model_probability(model.transform(data), "p")
    return scored.select("flow_id", F.round("p", 6).alias("probability"))


def _drawn_sql():
    """The trials a search draws, which are fixed by its seed."""
    names = list(training.SEARCH_SPACE)
    rows = ", ".join("(" + ", ".join([str(i), *[f"{float(p[n])!r}::double" for n in names]]) + ")"
                     for i, p in enumerate(training.draw_params(25, 42)))
    return f"select *, true as scored, true as best_is_highest from (values {rows}) as t(trial, {', '.join(names)})"


@register("search_params", _drawn_sql())
def _(spark, d):
    report = training.search_params(vectors(spark, d), "flow_id")[1]
    last = report.filter(F.col("rung") == report.agg(F.max("rung")).scalar())
    top, best = last.agg(F.max("cv_roc_auc")).scalar(), last.filter("best").agg(F.max("cv_roc_auc")).scalar()
    return report.select("trial", *training.SEARCH_SPACE, F.col("cv_roc_auc").between(0, 1).alias("scored"),
                         (top == best).alias("best_is_highest"))


def explained(spark, d):
    """An ensemble of a dozen trees, the rows it was fitted on and the contributions of every row."""
    from netsleuth.session import durable

    data = durable(vectors(spark, d).withColumn("x", vector_to_array("features")))
    model = GBTClassifier(featuresCol="features", labelCol=LABEL, maxIter=12, maxDepth=5, seed=42).fit(data)
    return model, data, boosting.contributions(model, data, ["flow_id"], len(MODEL_FEATURES))


FLOW_COUNT_SQL = f"with {fq.FLOWS_SQL} select count(*) as flows"


# the contributions of every row add up to what the model itself says, and so do those of a ranking
@register("tree_contributions", f"{FLOW_COUNT_SQL}, true as additive, true as several_trees, true as ranked from flows")
def _(spark, d):
    model, data, parts = explained(spark, d)
    said = model.transform(data).select("flow_id", vector_to_array("rawPrediction")[1].alias("_raw"))
    off = parts.join(said, "flow_id").agg(F.count(F.lit(1)).alias("flows"), F.max(F.abs(F.col("raw") - F.col("_raw"))).alias("_off"))
    ranking = boosting.contribution_ranking(parts, MODEL_FEATURES)
    return off.select("flows", (F.col("_off") < 1e-9).alias("additive"), F.lit(model.getNumTrees > 1).alias("several_trees"),
                      (ranking.agg(F.count_if(F.col("mean_abs") > 0)).scalar() > 1).alias("ranked"))


register("tree_importance")(lambda spark, d: boosting.contribution_ranking(
    explained(spark, d)[2], MODEL_FEATURES))


@register("swap_importance")
def _(spark, d):
    from netsleuth.session import durable

    data = durable(vectors(spark, d))
    model = training.train_detector(data, "flow_id")
    return training.swap_importance(model, data, "flow_id")


register("linear_importance", f"with {fq.GOLD_SQL}, m as (select " + ", ".join(
    f"{n}::float::double as {n}" for n in SHAP_WEIGHTS) + " from gold), r as (" + " union all ".join(
    f"select '{n}' as feature, round(avg(abs({w}::double * ({n} - (select avg({n}) from m)))), 6) as mean_abs from m"
    for n, w in SHAP_WEIGHTS.items()) + ") select * from r order by mean_abs desc, feature limit 15")(
    lambda spark, d: training.linear_importance(matrix(spark, d), SHAP_WEIGHTS))


@register("score_flows", f"with {fq.GOLD_SQL} select flow_id, 'linear' as model_name, '1' as model_version, 'staging' as "
          f"model_alias, round({fq.LOGIT_SQL}, 6) as malicious_probability, ({fq.LOGIT_SQL} >= 0.5)::integer as prediction, "
          f"case when {fq.LOGIT_SQL} >= 0.5 then 'attack' else 'benign' end as verdict from gold")
def _(spark, d):
    asked = views.flows(spark, d).select("flow_id", F.map_from_arrays(
        F.array(*[F.lit(n) for n in NUMERIC_FEATURES]), F.array(*[F.col(n) for n in NUMERIC_FEATURES])).alias("flow"))
    return training.score_with_linear(asked, "flow", ["flow_id"], fq.WEIGHTS, fq.BIAS)


RUNS_SQL = (f"{fq.FLOWS_SQL}, runs as (select 'nids-detector' as name, strftime(ts, '%Y-%m') as run, "
            "round(0.55 + avg(Label), 4) as roc_auc from flows group by 2), "
            "numbered as (select *, row_number() over (partition by name order by run)::integer as version from runs), "
            "reg as (select name, version, 'candidate' as alias, roc_auc, 'models/' || run as path from numbered union all "
            "select name, version, 'staging', roc_auc, 'models/' || run from numbered where roc_auc >= 0.95)")


def registered(spark, d):
    """One training run per month of flows; its metric is the month's label share plus a base."""
    runs = views.flows(spark, d).groupBy(F.date_format("ts", "yyyy-MM").alias("run")).agg(
        F.round(F.lit(0.55) + F.avg(LABEL), 4).alias("roc_auc"))
    return registry.register_runs(runs.select(
        F.lit("nids-detector").alias("name"), "run", "roc_auc", F.concat(F.lit("models/"), "run").alias("path")))


register("registry_promote", f"with {RUNS_SQL} select * from reg")(registered)
register("registry_resolve", f"with {RUNS_SQL} select name, version, alias, path from reg "
         "order by (alias = 'staging') desc, version desc limit 1")(
    lambda spark, d: registry.resolve_version(registered(spark, d)))


def _steps_sql(ctes):
    return (f"with {ctes}, {fq.WASSERSTEIN_SQL}, dec as ({fq.decision_sql('wass')}), s as (select unnest(list_concat("
            "['ingest', 'drift_check', 'drift_branch'], case when decision = 'retrain_features' then "
            "['retrain_features', 'retrain_train'] else ['skip_retrain'] end, ['done'])) as step, "
            "generate_subscripts(list_concat(['a', 'b', 'c'], case when decision = 'retrain_features' then ['d', 'e'] else ['d'] end, "
            "['f']), 1)::integer - 1 as ord from dec) select ord, step from s")


register("nids_job", _steps_sql(fq.LONG_SQL))(
    lambda spark, d: jobs.job_steps(drift.drift_decision(drift.drift_wasserstein(fq.drift_rows(spark, d)))))
register("nids_job_drifted", _steps_sql(fq.PERTURBED_SQL))(
    lambda spark, d: jobs.job_steps(drift.drift_decision(drift.drift_wasserstein(fq.perturbed_rows(spark, d)))))


@register("batch_landing", f"with {fq.FLOWS_SQL} select strftime(ts, '%Y') as batch, case when strftime(ts, '%Y') = '1995' then 'rejected' "
          "else 'bronze' end as state, count(*) as n from flows group by 1, 2")
def _(spark, d):
    """A batch per year, the labels of 1995 spoilt, landed by two runs."""
    folder = new_run_dir(spark, "batches")
    year = F.date_format("ts", "yyyy")
    spoilt = F.when(year == "1995", 7).otherwise(F.col(LABEL))
    arrived = views.flows(spark, d).withColumns({"batch": year, LABEL: spoilt})
    arrived.write.partitionBy("batch").parquet(f"{folder}/inbox")
    schema = arrived.drop("batch").schema
    for _ in range(2):
        jobs.land_batches(spark, f"{folder}/inbox", folder, schema, gate.flow_suite())
    return jobs.landed(spark, folder, schema).groupBy("batch", "state").agg(F.count(F.lit(1)).alias("n"))
