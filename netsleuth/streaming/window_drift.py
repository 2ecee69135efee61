"""Drift of every closed window of a stream, from bin counts held in state.

The reference is cut into bins once, in batch: numeric columns at their deciles,
categorical ones by value. The stream keeps one counter per (window, column, salt,
bin) in RocksDB and an event-time timer gives the counts out when the watermark
passes the window's end. A salt splits the rows of one window, so a window that
holds most of a day's rows is counted by several tasks.
"""

from __future__ import annotations

from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.streaming import StatefulProcessor

from netsleuth.operators.drift import DECILES, JS_BAR, PSI_BAR, SHARE_FLOOR, drift_long, js_distance
from netsleuth.operators.ranking import exact_quantiles, place_among, prefix_sums

SALTS = 8
PSI, JS = "psi", "js"
COUNTS_SCHEMA = "start timestamp, col string, bin string, n bigint"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def decile_edges(reference: DataFrame, numeric: list[str]) -> dict[str, list[float]]:
    """Distinct deciles per numeric column: nine numbers at most for each column of the schema."""
    long = drift_long(reference.withColumn("_side", F.lit("ref")), "_side", numeric)
    counts = long.groupBy("col", "value").agg(F.count(F.lit(1)).alias("n"))
    cut = exact_quantiles(prefix_sums(counts, "value", ["n"], by=["col"]), "value", "n", DECILES, by=["col"])
    rows = cut.select("col", F.array_distinct("quantiles").alias("edges")).collect()
    return {r["col"]: list(r["edges"]) for r in rows}


def binned(df: DataFrame, edges: dict[str, list[float]], categorical: list[str], keep: list[str]) -> DataFrame:
    """(keep, col, bin) rows: a right-closed decile number or the category; missing values leave."""
    wide = df
    for name, cuts in edges.items():
        wide = wide.withColumn("_cuts", F.array(*[F.lit(float(c)) for c in cuts])).withColumn("_v", F.col(name).cast("double"))
        wide = place_among(wide, "_v", "_cuts", "_bin", len(DECILES), right=False)
        wide = wide.withColumn("_b_" + name, F.when(F.col("_v").isNotNull(), F.col("_bin").cast("string"))).drop("_cuts", "_v", "_bin")
    cell = lambda name, value: F.struct(F.lit(name).alias("col"), value.cast("string").alias("bin"))
    cells = [cell(n, F.col("_b_" + n)) for n in edges] + [cell(c, F.col(c)) for c in categorical]
    return wide.select(*keep, F.inline(F.array(*cells))).filter(F.col("bin").isNotNull())


def reference_shares(reference: DataFrame, edges: dict[str, list[float]], categorical: list[str]) -> DataFrame:
    """(col, method, bin, share) of the reference."""
    counts = binned(reference, edges, categorical, []).groupBy("col", "bin").agg(F.count(F.lit(1)).alias("n"))
    method = F.when(F.col("col").isin(list(categorical)), JS).otherwise(PSI)
    share = F.col("n") / F.sum("n").over(Window.partitionBy("col"))
    return counts.select("col", method.alias("method"), "bin", share.alias("share"))


def _bin_counter():
    # a class of this function travels to the workers with the job, so they need no installed package
    class BinCounter(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.counts = handle.getMapState("counts", "bin string", "n bigint")

        def handleInputRows(self, key, rows, timerValues):
            for batch in rows:
                for name, n in batch["bin"].value_counts().items():
                    held = self.counts.getValue((name,))[0] if self.counts.containsKey((name,)) else 0
                    self.counts.updateValue((name,), (int(held) + int(n),))
                self.handle.registerTimer(int(batch["end_ms"].iloc[0]))
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            held = [(key[0], key[1], name[0], int(n[0])) for name, n in self.counts.iterator()]
            self.counts.clear()
            yield pd.DataFrame(held, columns=["start", "col", "bin", "n"])

        def close(self):
            pass

    return BinCounter()


def window_bins(stream: DataFrame, edges: dict[str, list[float]], categorical: list[str], ts: str = "ts",
                length: str = "1 day", delay: str = "1 hour", salts: int = SALTS) -> DataFrame:
    """Streaming (start, col, bin, n) rows, up to ``salts`` of them per bin of a closed window.

    A row is late once the watermark has passed the end of its window. Start the result
    inside :func:`rocks_state`; its state store is the one that holds maps and timers.
    """
    salt = F.pmod(F.xxhash64(*stream.columns), F.lit(salts)).cast("int")
    timed = stream.withWatermark(ts, delay).withColumns({"_w": F.window(ts, length), "_salt": salt})
    cells = binned(timed, edges, categorical, ["_w", "_salt"]).select(
        "_w", "_salt", F.col("_w.start").alias("start"), F.unix_millis("_w.end").alias("end_ms"), "col", "bin")
    return cells.groupBy("start", "col", "_salt").transformWithStateInPandas(
        _bin_counter(), COUNTS_SCHEMA, outputMode="append", timeMode="EventTime")


@contextmanager
def rocks_state(spark):
    """State in RocksDB for the streams started inside; the session's own setting returns afterwards."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def _psi(p: Column, q: Column) -> Column:
    floor = lambda share: F.greatest(share, F.lit(SHARE_FLOOR))
    return (floor(p) - floor(q)) * F.log(floor(p) / floor(q))


def window_drift(bins: DataFrame, shares: DataFrame, psi_bar: float = PSI_BAR, js_bar: float = JS_BAR) -> DataFrame:
    """(start, col, method, n, statistic, drifted) of (start, col, bin, n) counts against reference shares.

    Bins that a window lacks come from the sum over all reference bins less that of the
    bins it holds, so there is no outer join. Columns without a reference are left out.
    """
    c = F.col
    part = lambda p, q: F.when(c("method") == PSI, _psi(p, q)).otherwise(js_distance(p, q))
    absent = part(c("share"), F.lit(0.0))
    base = shares.groupBy(c("col").alias("_bc"), "method").agg(F.sum(absent).alias("_base"))
    known = shares.select(c("col").alias("_sc"), c("bin").alias("_sb"), "share")
    held = bins.groupBy("start", "col", "bin").agg(F.sum("n").alias("n"))
    totals = held.groupBy(c("start").alias("_ts"), c("col").alias("_tc")).agg(F.sum("n").alias("_total"))
    # one row for each monitored column of the schema
    joined = (
        held.join(F.broadcast(base), c("col") == c("_bc"))
        .join(known, (c("col") == c("_sc")) & (c("bin") == c("_sb")), "left")
        .join(totals, (c("start") == c("_ts")) & (c("col") == c("_tc")))
        .withColumn("share", F.coalesce("share", F.lit(0.0))))
    moved = F.sum(part(c("share"), c("n") / c("_total")) - absent) + F.max("_base")
    per_column = joined.groupBy("start", "col", "method").agg(F.sum("n").alias("n"), moved.alias("_s"))
    psi = c("method") == PSI
    statistic = F.round(F.when(psi, c("_s")).otherwise(F.sqrt(F.greatest(c("_s"), F.lit(0.0)))), 6)
    return per_column.select("start", "col", "method", "n", statistic.alias("statistic")).withColumn(
        "drifted", c("statistic") >= F.when(psi, psi_bar).otherwise(js_bar))


def window_decisions(columns: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per window: columns that drifted, columns tested, and whether their share reaches the threshold."""
    hit, n = F.count_if(F.col("drifted")), F.count(F.lit(1))
    return columns.groupBy("start").agg(
        hit.alias("n_drifted_columns"), n.alias("n_columns"), (hit / n >= threshold).alias("drift_detected"))
