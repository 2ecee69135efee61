"""Registered queries of the causal family, each beside its SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from netsleuth.operators import causal, logistic
from netsleuth.plans.registry import Family
from netsleuth.session import durable
from netsleuth.sources import views

FAMILY = Family()
register = FAMILY.register

T, Y = "t", "y"
STRATA = ["segment", "price_band", "lines_band"]
CONFOUNDERS = ["price", "lines", "balance"]

STUDY_SQL = (
    "l as (select l_orderkey, count(*) as n_lines, max((l_returnflag = 'R')::integer) as y from lineitem group by 1), "
    "study as (select o_orderkey as unit, (o_orderpriority in ('1-URGENT', '2-HIGH'))::integer as t, y, "
    "o_totalprice / 100000.0::double as price, n_lines::double as lines, c_acctbal / 1000.0::double as balance, "
    "c_mktsegment as segment, floor(o_totalprice / 125000.0::double) as price_band, least(n_lines, 6) as lines_band "
    "from l join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey)")


def cells_sql(strata=STRATA, name="cells"):
    keys = ", ".join(strata)
    return (
        f"{name}_raw as (select {keys}, count(*) filter (where t = 1) as n1, count(*) filter (where t = 0) as n0, "
        "coalesce(sum(y) filter (where t = 1), 0) as s1, coalesce(sum(y) filter (where t = 0), 0) as s0 "
        f"from study group by {keys}), "
        f"{name} as (select *, greatest(least(n1 / (n1 + n0), 0.98), 0.02) as e, "
        f"coalesce(s1 / nullif(n1, 0), sum(s1) over (partition by {strata[0]}) / nullif(sum(n1) over (partition by {strata[0]}), 0), "
        "sum(s1) over () / nullif(sum(n1) over (), 0)) as mu1, "
        f"coalesce(s0 / nullif(n0, 0), sum(s0) over (partition by {strata[0]}) / nullif(sum(n0) over (partition by {strata[0]}), 0), "
        "sum(s0) over () / nullif(sum(n0) over (), 0)) as mu0, "
        f"case when n1 = 0 or n0 = 0 then n1 + n0 else 0 end as borrowed from {name}_raw)")


EFFECTS_SQL = (
    f"{STUDY_SQL}, {cells_sql()}, effects as (select round(sum((n1 + n0) * (mu1 - mu0)) / sum(n1 + n0), 6) as regression_adjustment, "
    "round(sum(s1 / e) / sum(n1 / e) - sum(s0 / (1 - e)) / sum(n0 / (1 - e)), 6) as ipw, "
    "round(sum((n1 + n0) * (mu1 - mu0) + (s1 - n1 * mu1) / e - (s0 - n0 * mu0) / (1 - e)) / sum(n1 + n0), 6) as aipw, "
    "sum(borrowed)::bigint as borrowed_units from cells)")
NAIVE_SQL = "naive as (select avg(y) filter (where t = 1) - avg(y) filter (where t = 0) as effect from study)"


def ols_sql(source, target, others, by="", name="ols"):
    """Coefficient of ``target`` by orthogonalising one confounder after another."""
    over = f"over (partition by {by})" if by else "over ()"
    steps, prev, done = [], source, []
    for i, x in enumerate([*others, target]):
        fitted = "".join(f" - regr_slope({x}, z{j}) {over} * z{j}" for j in done)
        steps.append(f"{name}{i} as (select *, {x} - avg({x}) {over}{fitted} as z{i} from {prev})")
        prev, done = f"{name}{i}", [*done, i]
    last = f"z{len(others)}"
    group = f"{by}, " if by else ""
    tail = f" group by {by}" if by else ""
    steps.append(f"{name} as (select {group}sum({last} * y) / sum({last} * {last}) as effect from {prev}{tail})")
    return ", ".join(steps)


OLS_SQL = ols_sql("study", "t", CONFOUNDERS)

register("naive_ate", f"with {STUDY_SQL}, {NAIVE_SQL} select round(effect, 6) as naive from naive")(
    lambda spark, d: causal.naive_ate(views.study(spark, d), T, Y))


def _unit_sql(columns):
    return (f"with {STUDY_SQL}, {cells_sql()} select unit, {columns} from study join cells "
            "using (segment, price_band, lines_band)")


register("propensity", _unit_sql("round(e, 6) as e"))(
    lambda spark, d: causal.propensity(views.study(spark, d), T, Y, STRATA).select("unit", F.round("e", 6).alias("e")))
register("outcome_preds", _unit_sql("round(mu1, 6) as mu1, round(mu0, 6) as mu0"))(
    lambda spark, d: causal.outcome_preds(views.study(spark, d), T, Y, STRATA).select(
        "unit", F.round("mu1", 6).alias("mu1"), F.round("mu0", 6).alias("mu0")))
register("cate", _unit_sql("round(mu1 - mu0, 6) as cate"))(
    lambda spark, d: causal.t_learner_cate(views.study(spark, d), T, Y, STRATA).select(
        "unit", F.round("cate", 6).alias("cate")))

for _name, _column in (("ate_gcomp", "regression_adjustment"), ("ate_ipw", "ipw"), ("ate_aipw", "aipw")):
    register(_name, f"with {EFFECTS_SQL} select {_column}, borrowed_units from effects")(
        lambda spark, d, column=_column: causal.strata_effects(views.study(spark, d), T, Y, STRATA).select(
            column, "borrowed_units"))

register("ate_ols", f"with {STUDY_SQL}, {OLS_SQL} select round(effect, 6) as ols from ols")(
    lambda spark, d: causal.ols_ate(views.study(spark, d), T, Y, CONFOUNDERS))
register("refute_placebo", f"with {STUDY_SQL}, drawn as (select sim, y, price, lines, balance, (row_number() over "
         "(partition by sim order by md5(sim || '|' || unit), unit) <= (select sum(t) from study))::integer as placebo "
         f"from study, range(20) as r(sim)), {ols_sql('drawn', 'placebo', CONFOUNDERS, 'sim')} "
         "select round(avg(effect), 6) as new_effect, round(max(abs(effect)), 6) as largest, count(*) as n_sims from ols")(
    lambda spark, d: causal.refute_placebo(views.study(spark, d), "unit", T, Y, CONFOUNDERS))
register("refute_random_cause", f"with {STUDY_SQL}, noisy as (select *, ('0x' || substr(md5('rcc|' || unit), 1, 8))::bigint "
         f"/ 4294967296.0::double as noise from study), {ols_sql('noisy', 't', [*CONFOUNDERS, 'noise'])} "
         "select round(effect, 6) as new_effect from ols")(
    lambda spark, d: causal.refute_random_cause(views.study(spark, d), "unit", T, Y, CONFOUNDERS))

_FINE_SQL = f"{STUDY_SQL}, {cells_sql()}, fine as (select study.*, mu1 - mu0 as cate from study join cells using (segment, price_band, lines_band))"


@register("cate_by_quartile", f"with {_FINE_SQL}, q as (select quantile_cont(price, [0.25, 0.5, 0.75]) as cuts from study) "
          "select len(list_filter(cuts, lambda c: c < price))::integer + 1 as quartile, count(*) as units, "
          "round(avg(cate), 4) as cate, round(avg(y), 4) as y from fine, q group by 1")
def _(spark, d):
    fine = causal.t_learner_cate(views.study(spark, d), T, Y, STRATA)
    return causal.effect_by_quartile(fine, "price", ["cate", "y"])


@register("effect_corr", f"with {_FINE_SQL}, {cells_sql(['price_band'], 'bands')} select round(corr(cate, mu1 - mu0), 6) "
          "as correlation from fine join bands using (price_band)")
def _(spark, d):
    fine = causal.t_learner_cate(views.study(spark, d), T, Y, STRATA)
    return causal.effect_corr(causal.t_learner_cate(fine, T, Y, ["price_band"], "coarse"), "cate", "coarse")


register("estimate_table", f"with {EFFECTS_SQL}, {NAIVE_SQL}, {OLS_SQL}, r as (select 'regression_adjustment' as estimator, "
         "regression_adjustment as v from effects union all select 'ipw', ipw from effects union all select 'aipw', aipw "
         "from effects union all select 'naive', round(effect, 6) from naive union all select 'ols', round(effect, 6) from ols) "
         "select estimator, round(v, 4) as estimate, round(v - -0.01, 4) as error from r")(
    lambda spark, d: causal.estimate_table(views.study(spark, d), T, Y, STRATA, CONFOUNDERS, -0.01))
register("study_profile", f"with {STUDY_SQL}, {NAIVE_SQL} select count(*) as n, round(avg(t), 4) as treated_frac, "
         "round((select effect from naive), 4) as naive_ate from study")(
    lambda spark, d: causal.study_profile(views.study(spark, d), T, Y))
_E_SQL = f"{STUDY_SQL}, {cells_sql()}, w as (select study.*, e from study join cells using (segment, price_band, lines_band))"
register("overlap_report", f"with {_E_SQL} select t as arm, count(*) as n, round(min(e), 6) as e_min, round(max(e), 6) as e_max, "
         "round(count(*) filter (where e <= 0.02 or e >= 0.98) / count(*), 4) as clipped_share from w group by 1")(
    lambda spark, d: causal.overlap_report(causal.propensity(views.study(spark, d), T, Y, STRATA), T, "e"))
register("balance_report", f"with {_E_SQL}, x as (" + " union all ".join(
    f"select t, e, '{c}' as covariate, {c} as x from w" for c in CONFOUNDERS)
    + "), s as (select covariate, sqrt((var_samp(x) filter (where t = 1) + var_samp(x) filter (where t = 0)) / 2) as scale, "
    "avg(x) filter (where t = 1) - avg(x) filter (where t = 0) as raw, "
    "sum(x / e) filter (where t = 1) / sum(1 / e) filter (where t = 1) - "
    "sum(x / (1 - e)) filter (where t = 0) / sum(1 / (1 - e)) filter (where t = 0) as weighted from x group by 1) "
    "select covariate, round(raw / scale, 6) as smd_raw, round(weighted / scale, 6) as smd_weighted from s")(
    lambda spark, d: causal.balance_report(
        causal.propensity(views.study(spark, d), T, Y, STRATA), T, "e", CONFOUNDERS))

_MODELS = {"e": (CONFOUNDERS, "t", "true"), "mu": (["t", *CONFOUNDERS], "y", "true"),
           "mu1": (CONFOUNDERS, "y", "t = 1"), "mu0": (CONFOUNDERS, "y", "t = 0")}
_MOMENTS_SQL = " union all ".join(
    f"select '{m}' as model, '{c}' as coefficient, count(*) as n, round(sum({label} * {'1' if c == 'intercept' else c}::double), 4) as moment, "
    f"true as settled from study where {rows}" for m, (names, label, rows) in _MODELS.items() for c in ["intercept", *names])


# the optimum of a ridge fit is where its penalised gradient vanishes, so that is checked for every coefficient
@register("logistic_gradients", f"with {STUDY_SQL} {_MOMENTS_SQL}")
def _(spark, d):
    study = durable(views.study(spark, d).select(T, Y, *CONFOUNDERS))
    found = logistic.gradients(study, logistic.fit(study, causal.outcome_models(T, Y, CONFOUNDERS)))
    return found.select("model", "coefficient", "n", F.round("moment", 4).alias("moment"), (F.abs("gradient") <= 1e-6).alias("settled"))


# iterative fits have no SQL twin; their recovery of a known effect is tested
register("ate_logistic")(lambda spark, d: causal.logistic_effects(views.study(spark, d), T, Y, CONFOUNDERS))
register("cate_logistic")(
    lambda spark, d: causal.logistic_cate(views.study(spark, d), T, Y, CONFOUNDERS).select(
        "unit", F.round("cate", 6).alias("cate")))
