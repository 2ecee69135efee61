"""Treatment effects from observational tables.

Two model families: ``strata`` (cell means of discrete confounders) and logistic
regression by Newton steps. Strata estimators need one aggregate of the units
to cells; all else happens on the cell table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netsleuth.functions.columns import hash_uniform
from netsleuth.operators.logistic import Logistic, fit
from netsleuth.operators.ranking import exact_quantiles, hash_prefix, place_among, prefix_sums, spread_lookup
from netsleuth.session import durable

CLIP = (0.02, 0.98)


def clip(e: Column) -> Column:
    return F.greatest(F.least(e, F.lit(CLIP[1])), F.lit(CLIP[0]))


def naive_ate(df: DataFrame, t: str, y: str) -> DataFrame:
    arm = lambda v: F.avg(F.when(F.col(t) == v, F.col(y)))
    return df.agg(F.round(arm(1) - arm(0), 6).alias("naive"))


# --- strata models ---------------------------------------------------------
def strata_cells(df: DataFrame, t: str, y: str, strata: list[str]) -> DataFrame:
    """Per cell: arm sizes and sums, clipped propensity, outcome means per arm.

    An arm missing in a cell takes its mean from the cells sharing the first
    stratum, then from the whole table; ``borrowed`` counts the units concerned.
    """
    arm = lambda v: F.col(t) == v
    cells = df.groupBy(*strata).agg(
        F.count_if(arm(1)).alias("n1"), F.count_if(arm(0)).alias("n0"),
        F.sum(F.when(arm(1), F.col(y)).otherwise(0)).alias("s1"),
        F.sum(F.when(arm(0), F.col(y)).otherwise(0)).alias("s0"))
    parts = ("n1", "n0", "s1", "s0")
    coarse = cells.groupBy(F.col(strata[0]).alias("_first")).agg(*[F.sum(c).alias("mid_" + c) for c in parts])
    whole = cells.agg(F.struct(*[F.sum(c).alias(c) for c in parts])).scalar()
    mean = lambda s, n: F.col(s) / F.when(F.col(n) > 0, F.col(n))
    return cells.join(coarse, F.col(strata[0]).eqNullSafe(F.col("_first"))).withColumn("_whole", whole).select(
        *strata, "n1", "n0", "s1", "s0",
        clip(F.col("n1") / (F.col("n1") + F.col("n0"))).alias("e"),
        F.coalesce(mean("s1", "n1"), mean("mid_s1", "mid_n1"), mean("_whole.s1", "_whole.n1")).alias("mu1"),
        F.coalesce(mean("s0", "n0"), mean("mid_s0", "mid_n0"), mean("_whole.s0", "_whole.n0")).alias("mu0"),
        F.when((F.col("n1") == 0) | (F.col("n0") == 0), F.col("n1") + F.col("n0")).otherwise(0).alias("borrowed"))


def strata_effects(df: DataFrame, t: str, y: str, strata: list[str]) -> DataFrame:
    """Regression adjustment, Hajek-weighted and doubly robust effects in one row."""
    c = F.col
    n = c("n1") + c("n0")
    lift = c("mu1") - c("mu0")
    treated = F.sum(c("s1") / c("e")) / F.sum(c("n1") / c("e"))
    control = F.sum(c("s0") / (1.0 - c("e"))) / F.sum(c("n0") / (1.0 - c("e")))
    robust = n * lift + (c("s1") - c("n1") * c("mu1")) / c("e") - (c("s0") - c("n0") * c("mu0")) / (1.0 - c("e"))
    return strata_cells(df, t, y, strata).agg(
        F.round(F.sum(n * lift) / F.sum(n), 6).alias("regression_adjustment"),
        F.round(treated - control, 6).alias("ipw"),
        F.round(F.sum(robust) / F.sum(n), 6).alias("aipw"),
        F.sum("borrowed").alias("borrowed_units"))


#: Cells up to which they are sent to every task.
SENT_CELLS = 200_000


def _cell_key(df: DataFrame, strata: list[str]) -> Column:
    """One string per cell; nulls are kept and both zeros are the same."""
    kinds = dict(df.dtypes)
    parts = [F.col(s) + F.lit(0).cast(kinds[s]) if kinds[s] in ("double", "float") else F.col(s) for s in strata]
    return F.to_json(F.struct(*[p.alias(f"s{i}") for i, p in enumerate(parts)]), {"ignoreNullFields": "false"})


def _attach_cells(df: DataFrame, cells: DataFrame, strata: list[str], values: list[str]) -> DataFrame:
    """Cell values on every unit. Counted cells within the bound are broadcast, so no unit
    moves; beyond it units meet them by a lookup that spreads the fullest cells."""
    cells = durable(cells.select(*strata, *values))
    if cells.count() > SENT_CELLS:
        keyed = cells.select(_cell_key(cells, strata).alias("_cell"), *values)
        return spread_lookup(df.withColumn("_cell", _cell_key(df, strata)), keyed, "_cell", values).drop("_cell")
    right = F.broadcast(cells.select(*[F.col(s).alias("_c_" + s) for s in strata], *values))
    cond = F.lit(True)
    for s in strata:
        cond = cond & df[s].eqNullSafe(right["_c_" + s])
    return df.join(right, cond).select(*[df[c] for c in df.columns], *values)


def propensity(df: DataFrame, t: str, y: str, strata: list[str]) -> DataFrame:
    return _attach_cells(df, strata_cells(df, t, y, strata), strata, ["e"])


def outcome_preds(df: DataFrame, t: str, y: str, strata: list[str]) -> DataFrame:
    return _attach_cells(df, strata_cells(df, t, y, strata), strata, ["mu1", "mu0"])


def t_learner_cate(df: DataFrame, t: str, y: str, strata: list[str], out: str = "cate") -> DataFrame:
    """Per-unit effect: one outcome model per arm, difference of their predictions."""
    return outcome_preds(df, t, y, strata).withColumn(out, F.col("mu1") - F.col("mu0")).drop("mu1", "mu0")


# --- linear model ----------------------------------------------------------
def ols_coefficient(df: DataFrame, target: str, others: list[str], y: str, by: list[str] = ()) -> DataFrame:
    """Least-squares coefficient of ``target`` beside ``others``, per ``by``.

    The normal equations are sums of products, taken in one aggregate; only the
    small square system of each group is solved, inside a task.
    """
    names = ["_one", target, *others]
    k = len(names)
    base = df.withColumn("_one", F.lit(1.0))
    products = [F.sum(F.col(a).cast("double") * F.col(b)).alias(f"_g{i}_{j}")
                for i, a in enumerate(names) for j, b in enumerate(names) if i <= j]
    moments = [F.sum(F.col(a).cast("double") * F.col(y)).alias(f"_m{i}") for i, a in enumerate(names)]
    sums = base.groupBy(*by).agg(*products, *moments)
    cell = lambda i, j: F.col(f"_g{min(i, j)}_{max(i, j)}")
    systems = sums.select(
        *by, F.array(*[cell(i, j) for i in range(k) for j in range(k)]).alias("gram"),
        F.array(*[F.col(f"_m{i}") for i in range(k)]).alias("moments"))

    def solve(batches):
        import numpy as np

        for pdf in batches:
            pdf["effect"] = [
                float(np.linalg.lstsq(np.asarray(g).reshape(k, k), np.asarray(m), rcond=None)[0][1])
                for g, m in zip(pdf["gram"], pdf["moments"])]
            yield pdf.drop(columns=["gram", "moments"])

    kinds = "".join(f"{b} {df.schema[b].dataType.simpleString()}, " for b in by)
    return systems.mapInPandas(solve, f"{kinds}effect double")


def ols_ate(df: DataFrame, t: str, y: str, confounders: list[str]) -> DataFrame:
    return ols_coefficient(df, t, confounders, y).select(F.round("effect", 6).alias("ols"))


def refute_random_cause(df: DataFrame, unit: str, t: str, y: str, confounders: list[str], seed="rcc") -> DataFrame:
    """The linear effect again beside an independent random confounder."""
    noisy = df.withColumn("_noise", hash_uniform(seed, F.col(unit)))
    return ols_coefficient(noisy, t, [*confounders, "_noise"], y).select(F.round("effect", 6).alias("new_effect"))


def _sim_hash(sim: str, unit: str) -> Column:
    return F.md5(F.concat_ws("|", F.col(sim).cast("string"), F.col(unit).cast("string")))


def placebo_effects(df: DataFrame, unit: str, t: str, y: str, confounders: list[str], n_sims: int = 20) -> DataFrame:
    """The linear effect of a permuted treatment, per simulation, in one job.

    Permuting a 0/1 treatment is choosing which units get the ones: in simulation s
    the units with the lowest md5(s, unit), as many as are treated. The cut hash is
    found from prefix counts, so no simulation sorts or joins its units.
    """
    found = df.agg(F.sum(F.col(t).cast("bigint")).alias("n"), F.count_if(~F.col(t).cast("double").isin(0.0, 1.0)).alias("odd")).first()
    if found["odd"]:
        raise ValueError(f"the treatment {t} has {found['odd']} values other than 0 and 1")
    treated = F.lit(found["n"])
    units = df.select(unit, F.explode(F.sequence(F.lit(0), F.lit(n_sims - 1))).alias("sim"))
    units = units.withColumn("_h", _sim_hash("sim", unit))
    sizes = units.groupBy("sim", hash_prefix(df, F.col("_h")).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("sim").orderBy("_p"))
    edge = sizes.withColumn("_upto", upto).filter(
        (F.col("_upto") >= treated) & (F.col("_upto") - F.col("_n") < treated)
    ).select(F.col("sim").alias("_s"), F.col("_p").alias("_edge"),
             (treated - (F.col("_upto") - F.col("_n"))).alias("_left"))
    # one edge bucket per simulation
    near = units.join(F.broadcast(edge), (F.col("sim") == F.col("_s")) & (hash_prefix(df, F.col("_h")) == F.col("_edge")))
    place = F.row_number().over(Window.partitionBy("sim").orderBy("_h", unit))
    cuts = near.withColumn("_place", place).filter("_place = _left").select("sim", F.col("_h").alias("cut"))
    cut_map = cuts.agg(F.map_from_entries(F.collect_list(F.struct("sim", "cut")))).scalar()
    drawn = df.withColumn("_cuts", cut_map).withColumn(
        "sim", F.explode(F.sequence(F.lit(0), F.lit(n_sims - 1)))
    ).withColumn("_placebo", (_sim_hash("sim", unit) <= F.try_element_at("_cuts", F.col("sim"))).cast("int"))
    return ols_coefficient(drawn.fillna(0, ["_placebo"]), "_placebo", confounders, y, by=["sim"])


def refute_placebo(df: DataFrame, unit: str, t: str, y: str, confounders: list[str], n_sims: int = 20) -> DataFrame:
    return placebo_effects(df, unit, t, y, confounders, n_sims).agg(
        F.round(F.avg("effect"), 6).alias("new_effect"),
        F.round(F.max(F.abs("effect")), 6).alias("largest"),
        F.count(F.lit(1)).alias("n_sims"))


# --- reports ---------------------------------------------------------------
def effect_by_quartile(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """Mean of the effect columns in right-closed quartile bins of ``by``."""
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    cuts = exact_quantiles(prefix_sums(counts, by, ["n"]), by, "n", [0.25, 0.5, 0.75])
    placed = place_among(df.withColumn("_cuts", cuts.scalar()), by, "_cuts", "_below", 3, right=False)
    return placed.groupBy((F.col("_below") + 1).alias("quartile")).agg(
        F.count(F.lit(1)).alias("units"), *[F.round(F.avg(c), 4).alias(c) for c in columns])


def effect_corr(df: DataFrame, estimated: str, true: str) -> DataFrame:
    return df.agg(F.round(F.corr(estimated, true), 6).alias("correlation"))


def estimate_table(df: DataFrame, t: str, y: str, strata: list[str], confounders: list[str],
                   reference: float) -> DataFrame:
    """Every estimator with its distance from a reference effect."""
    effects = strata_effects(df, t, y, strata)
    long = effects.unpivot([], ["regression_adjustment", "ipw", "aipw"], "estimator", "estimate")
    single = lambda frame, column: frame.select(F.lit(column).alias("estimator"), F.col(column).alias("estimate"))
    rows = long.unionByName(single(naive_ate(df, t, y), "naive")).unionByName(
        single(ols_ate(df, t, y, confounders), "ols"))
    return rows.select("estimator", F.round("estimate", 4).alias("estimate"),
                       F.round(F.col("estimate") - F.lit(reference), 4).alias("error"))


def study_profile(df: DataFrame, t: str, y: str) -> DataFrame:
    """Units, treated share and naive effect; with y0 and y1 also the truth and the bias."""
    arm = lambda v: F.avg(F.when(F.col(t) == v, F.col(y)))
    naive = arm(1) - arm(0)
    columns = [F.count(F.lit(1)).alias("n"), F.round(F.avg(t), 4).alias("treated_frac"),
               F.round(naive, 4).alias("naive_ate")]
    if {"y0", "y1"} <= set(df.columns):
        truth = F.avg("y1") - F.avg("y0")
        columns += [F.round(truth, 4).alias("true_ate"), F.round(naive - truth, 4).alias("naive_bias")]
    return df.agg(*columns)


def overlap_report(df: DataFrame, t: str, e: str) -> DataFrame:
    """Propensity range and clipped share per arm."""
    at_edge = (F.col(e) <= CLIP[0]) | (F.col(e) >= CLIP[1])
    return df.groupBy(F.col(t).alias("arm")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.min(e), 6).alias("e_min"), F.round(F.max(e), 6).alias("e_max"),
        F.round(F.count_if(at_edge) / F.count(F.lit(1)), 4).alias("clipped_share"))


def balance_report(df: DataFrame, t: str, e: str, covariates: list[str]) -> DataFrame:
    """Standardised mean difference of each covariate, raw and inverse-propensity weighted."""
    treated = F.col(t) == 1
    long = df.select(t, e, *[F.col(c).cast("double").alias(c) for c in covariates]).unpivot(
        [t, e], covariates, "covariate", "x")
    x = F.col("x")
    w1, w0 = F.when(treated, 1.0 / F.col(e)), F.when(~treated, 1.0 / (1.0 - F.col(e)))
    arm = lambda cond, agg: agg(F.when(cond, x))
    scale = F.sqrt((arm(treated, F.var_samp) + arm(~treated, F.var_samp)) / 2.0)
    raw = arm(treated, F.avg) - arm(~treated, F.avg)
    weighted = F.sum(w1 * x) / F.sum(w1) - F.sum(w0 * x) / F.sum(w0)
    return long.groupBy("covariate").agg(
        F.round(raw / scale, 6).alias("smd_raw"), F.round(weighted / scale, 6).alias("smd_weighted"))


# --- logistic models -------------------------------------------------------
def outcome_models(t: str, y: str, confounders: list[str]) -> dict[str, Logistic]:
    """Propensity and outcome models, the outcome with both arms and for each arm."""
    return {"e": Logistic(confounders, t), "mu": Logistic([t, *confounders], y),
            "mu1": Logistic(confounders, y, F.col(t) == 1), "mu0": Logistic(confounders, y, F.col(t) == 0)}


def _fitted(df: DataFrame, t: str, y: str, confounders: list[str], names: list[str]) -> list[Logistic]:
    models = outcome_models(t, y, confounders)
    return list(fit(df.select(t, y, *confounders), {n: models[n] for n in names}).values())


def logistic_preds(df: DataFrame, t: str, y: str, confounders: list[str]) -> DataFrame:
    """Units with clipped propensity e and both potential-outcome predictions."""
    df = durable(df)
    e, mu = _fitted(df, t, y, confounders, ["e", "mu"])
    arm = lambda value: mu.probability({t: F.lit(value)})
    return df.select("*", clip(e.probability()).alias("e"), arm(1.0).alias("mu1"), arm(0.0).alias("mu0"))


def logistic_effects(df: DataFrame, t: str, y: str, confounders: list[str]) -> DataFrame:
    """Regression adjustment, Hajek-weighted and doubly robust effects in one row."""
    c = F.col
    w1, w0 = c(t) / c("e"), (1 - c(t)) / (1.0 - c("e"))
    robust = c("mu1") - c("mu0") + w1 * (c(y) - c("mu1")) - w0 * (c(y) - c("mu0"))
    return logistic_preds(df, t, y, confounders).agg(
        F.round(F.avg(c("mu1") - c("mu0")), 6).alias("regression_adjustment"),
        F.round(F.sum(w1 * c(y)) / F.sum(w1) - F.sum(w0 * c(y)) / F.sum(w0), 6).alias("ipw"),
        F.round(F.avg(robust), 6).alias("aipw"))


def logistic_cate(df: DataFrame, t: str, y: str, confounders: list[str], out: str = "cate") -> DataFrame:
    """Per-unit effect from one logistic outcome model per arm."""
    df = durable(df)
    m1, m0 = _fitted(df, t, y, confounders, ["mu1", "mu0"])
    return df.withColumn(out, m1.probability() - m0.probability())
