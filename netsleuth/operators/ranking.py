"""Global ranks, prefix sums and quantiles without a single-task sort.

Every helper works in two levels: rows go to many ordered buckets, the short
table of bucket totals is accumulated, and a window inside each bucket adds the rest.
The results do not depend on how many buckets are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netsleuth.functions.columns import hash_hex
from netsleuth.session import durable, shuffle_width


def _hex_digits(df: DataFrame) -> int:
    """Prefix length giving some sixteen hash buckets per reduce task (256 to 65,536)."""
    return max(2, min(4, math.ceil(math.log(16 * shuffle_width(df.sparkSession), 16))))


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & left[n].eqNullSafe(right["_o" + n])
    return cond


def bucket_rank(df: DataFrame, bucket: Column, order: list[Column], by: list[str] = (), out: str = "rank") -> DataFrame:
    """Rank rows 1..n by (bucket, order) within each value of ``by``.

    ``bucket`` must be a short list of sortable values that spreads the rows; only
    its sizes are accumulated in one place.
    """
    by = list(by)
    placed = df.withColumn("_b", bucket)
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_n"))
        .select(*[F.col(b).alias("_o" + b) for b in by], F.col("_b").alias("_o_b"),
                F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    )
    inside = Window.partitionBy(*by, "_b").orderBy(*order)
    ranked = placed.withColumn("_rn", F.row_number().over(inside))
    joined = ranked.join(offsets, _same(ranked, offsets, by + ["_b"]))
    return joined.select(*[ranked[c] for c in df.columns], (F.col("_off") + F.col("_rn")).alias(out))


def ranks_beyond(df: DataFrame, bucket: Column, order: list[Column], marks: list[Column], out: str = "beyond") -> DataFrame:
    """Add ``out``: how many of ``marks`` the row's rank by (bucket, order) exceeds.

    ``bucket`` as in :func:`bucket_rank`. A bucket that lies on one side of every mark is settled by the bucket
    sizes alone, so only the rows of the few buckets that hold a mark are shuffled and sorted. ``df`` is read
    three times, so a frame that is dear to compute should be a table.
    """
    placed = df.withColumn("_b", bucket)
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")).select(
        "_b", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # the first bucket with rows beyond a mark; null if no row is
    first = lambda mark: F.min(F.when(F.col("_off") + F.col("_n") > mark, F.struct("_b", "_off")))
    cuts = sizes.agg(F.array(*[first(mark) for mark in marks]).alias("_cuts")).scalar()
    placed = placed.withColumn("_cuts", cuts)
    cut = lambda i: F.get("_cuts", F.lit(i))
    past = lambda i: F.coalesce(F.col("_b") > cut(i)["_b"], F.lit(False))
    at = lambda i: F.coalesce(F.col("_b") == cut(i)["_b"], F.lit(False))
    split = F.lit(False)
    for i in range(len(marks)):
        split = split | at(i)
    number = lambda beyond: sum((beyond(i).cast("int") for i in range(len(marks))), F.lit(0)).alias(out)
    settled = placed.filter(~split).select(*df.columns, number(past))
    ranked = placed.filter(split).withColumn("_rn", F.row_number().over(Window.partitionBy("_b").orderBy(*order)))
    counted = ranked.select(*df.columns, number(
        lambda i: F.when(at(i), cut(i)["_off"] + F.col("_rn") > marks[i]).otherwise(past(i))))
    return settled.unionByName(counted)


def hash_prefix(df: DataFrame, hex_hash: Column) -> Column:
    """Leading digits of an md5: an even, order-keeping bucket for any key."""
    return F.substring(hex_hash, 1, _hex_digits(df))


def hash_rank(df: DataFrame, key: list[str], seed=0, by: list[str] = (), out: str = "rank") -> DataFrame:
    """Rank rows 1..n in md5 order of ``key``, within each value of ``by``.

    Hash prefixes spread any key evenly, so a label holding most rows still
    splits over all buckets. ``by`` is a short key such as a class label.
    """
    h = hash_hex(seed, *[F.col(k) for k in key])
    return bucket_rank(df, hash_prefix(df, h), [h, *[F.col(k) for k in key]], by, out)


def sketch_buckets(df: DataFrame, value: str, hex_hash: Column, out: str = "_bucket") -> DataFrame:
    """Add ``out``: an ordered bucket by (``value``, ``hex_hash``), at most 16 for each reduce task.

    Cuts come from a quantile sketch. A value that takes k places among the cuts is a
    heavy tie and gets k buckets of its own, by leading hash bits; all other values share the
    bucket between two cuts. So both the number of buckets and the rows of one are bounded,
    however the values repeat. Null values go to the first bucket.
    """
    parts = 8 * shuffle_width(df.sparkSession)
    probs = [i / parts for i in range(1, parts)]
    cuts = df.agg(F.percentile_approx(value, probs, F.lit(max(10_000, 10 * parts))).alias("_cuts")).select("_cuts").scalar()
    placed = place_among(df.withColumn("_cuts", cuts), value, "_cuts", "_below", parts, right=False)
    placed = place_among(placed, value, "_cuts", "_upto", parts)
    below, upto = F.col("_below"), F.col("_upto")
    bits = F.conv(F.substring(hex_hash, 1, 8), 16, 10).cast("bigint")
    part = F.when(upto - below > 1, F.shiftright(bits * (upto - below), 32)).otherwise(F.lit(0)).cast("int")
    return placed.withColumn(out, F.struct(below.alias("b"), upto.alias("u"), part.alias("p"))).drop("_cuts", "_below", "_upto")


def sketch_rank(df: DataFrame, value: str, hex_hash: Column, ties: list[Column], out: str = "rank") -> DataFrame:
    """Rank rows 1..n by (``value``, ``hex_hash``, ``ties``) over :func:`sketch_buckets`.

    ``df`` is read three times, so a frame that is dear to compute should be a table.
    """
    ranked = bucket_rank(sketch_buckets(df, value, hex_hash), F.col("_bucket"), [F.col(value), hex_hash, *ties], out=out)
    return ranked.drop("_bucket")


def place_among(df: DataFrame, value: str, cuts: str, out: str, max_cuts: int, right: bool = True) -> DataFrame:
    """Add ``out``: how many sorted ``cuts`` lie at or below ``value`` (below it if not ``right``).

    A binary search unrolled to one projection per halving, so it compiles with the
    rest of the stage. An index past the array reads as null and counts as above.
    """
    placed = df.withColumn(out, F.lit(0))
    for bit in reversed(range(max_cuts.bit_length())):
        step = 1 << bit
        at = F.get(cuts, F.col(out) + (step - 1))
        passed = (at <= F.col(value)) if right else (at < F.col(value))
        placed = placed.withColumn(out, F.col(out) + F.when(passed, step).otherwise(0))
    return placed


def prefix_sums(counts: DataFrame, value: str, sums: list[str], by: list[str] = (),
                stats: dict[str, Column] | None = None) -> DataFrame:
    """Running totals over distinct sorted values.

    ``counts`` has one row per (by, value). Adds ``cum_x`` (this value included) and
    ``total_x`` for every x in ``sums``, ``next_value``, and any further aggregates
    per ``by`` named in ``stats``. ``by`` names a bounded set, such as the monitored
    columns of a schema, so the row of cut points each has fits a broadcast. The
    counts are checkpointed because three branches read them.
    """
    by, stats = list(by), stats or {}
    counts = durable(counts)
    parts = max(8, shuffle_width(counts.sparkSession))
    probs = [i / parts for i in range(1, parts)]
    named = [*["total_" + s for s in sums], *stats]
    profile = counts.groupBy(*by).agg(
        F.array_distinct(F.percentile_approx(value, probs)).alias("_cuts"),
        *[F.sum(s).alias("total_" + s) for s in sums],
        *[agg.alias(name) for name, agg in stats.items()],
    ).select(*[F.col(b).alias("_o" + b) for b in by], "_cuts", *named)
    if by:
        placed = counts.join(F.broadcast(profile), _same(counts, profile, by))
    else:
        row = profile.select(F.struct("_cuts", *named)).scalar()
        placed = counts.withColumn("_profile", row).select("*", "_profile.*")
    bucketed = place_among(placed, value, "_cuts", "_b", parts).select(*counts.columns, *named, "_b")

    order = Window.partitionBy(*by).orderBy("_b")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    heads = bucketed.groupBy(*by, "_b").agg(
        F.min(value).alias("_min"), *[F.sum(s).alias("_s_" + s) for s in sums])
    offsets = heads.select(
        *[F.col(b).alias("_o" + b) for b in by], F.col("_b").alias("_o_b"),
        F.lead("_min").over(order).alias("_after"),
        *[F.coalesce(F.sum("_s_" + s).over(before), F.lit(0)).alias("_off_" + s) for s in sums],
    )
    inside = Window.partitionBy(*by, "_b").orderBy(value)
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    local = bucketed.select(
        "*", F.lead(value).over(inside).alias("_next"),
        *[F.sum(s).over(running).alias("_run_" + s) for s in sums])
    joined = local.join(offsets, _same(local, offsets, by + ["_b"]))
    return joined.select(
        *[local[c] for c in counts.columns],
        F.coalesce("_next", "_after").alias("next_value"),
        *[(F.col("_run_" + s) + F.col("_off_" + s)).alias("cum_" + s) for s in sums],
        *named,
    )


def exact_quantiles(sums: DataFrame, value: str, count: str, probs: list[float], by: list[str] = ()) -> DataFrame:
    """Interpolated quantiles read off :func:`prefix_sums`, one array per ``by``."""
    position = [F.lit(p) * (F.col("total_" + count) - 1) for p in probs]
    covers = lambda at: (F.col("cum_" + count) - F.col(count) <= at) & (at < F.col("cum_" + count))
    picks = []
    for i, pos in enumerate(position):
        picks.append(F.max(F.when(covers(F.floor(pos)), F.col(value))).alias(f"_lo{i}"))
        picks.append(F.max(F.when(covers(F.ceil(pos)), F.col(value))).alias(f"_hi{i}"))
        picks.append(F.max(pos - F.floor(pos)).alias(f"_f{i}"))
    row = sums.groupBy(*by).agg(*picks)
    points = [
        F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}") for i in range(len(probs))
    ]
    return row.select(*by, F.array(*points).alias("quantiles"))


HOT_KEYS = 64


def spread_lookup(facts: DataFrame, dim: DataFrame, key: str, values: list[str],
                  sketch: DataFrame | None = None, parts: int = 0) -> DataFrame:
    """Left join ``facts`` to ``dim`` on ``key`` when a few keys may hold most rows.

    A frequent-items sketch names the 64 commonest keys; their ``dim`` rows, at most
    64, are broadcast. Rows of other keys shuffle on the key as usual, while hot rows,
    already matched, spread over all tasks. Which keys the sketch picks changes the
    speed only, so ``sketch`` may name a cheaper frame with the same key column.
    ``dim`` has one row per key. More ``parts`` than the session plans for keep the tasks of a large lookup small.
    """
    top = (facts if sketch is None else sketch).agg(F.expr(f"approx_top_k({key}, {HOT_KEYS}, {16 * HOT_KEYS})").alias("_top"))
    hot_keys = top.select(F.col("_top.item").alias("_items")).scalar()
    sided = dim.withColumn("_items", hot_keys).filter(F.array_contains("_items", F.col(key)))
    hot = sided.select(F.col(key).alias("_hot"), *[F.col(v).alias("_hot_" + v) for v in values])
    tagged = facts.join(F.broadcast(hot), facts[key] == hot["_hot"], "left")
    matched = F.col("_hot").isNotNull()
    elsewhere = F.concat(F.lit("\u0001"), F.xxhash64(*facts.columns).cast("string"))
    tagged = tagged.withColumn(
        "_cold", F.when(matched | F.col(key).isNull(), elsewhere).otherwise(F.col(key).cast("string")))
    cold = dim.select(F.col(key).cast("string").alias("_ck"), *[F.col(v).alias("_cold_" + v) for v in values])
    if parts > shuffle_width(facts.sparkSession):
        tagged, cold = tagged.repartition(parts, "_cold"), cold.repartition(parts, "_ck")
    joined = tagged.join(cold, tagged["_cold"] == cold["_ck"], "left")
    return joined.select(
        *[facts[c] for c in facts.columns],
        *[F.when(matched, F.col("_hot_" + v)).otherwise(F.col("_cold_" + v)).alias(v) for v in values])


SPLITS = 16


def spread_join(left: DataFrame, right: DataFrame, key: str, left_by: list[str], right_by: list[str],
                right_counts: DataFrame | None = None, splits: int = SPLITS) -> DataFrame:
    """Inner join on ``key`` when single keys may hold much of either side; ``key`` appears once.

    A key with more than a fixed share of a side's rows has them dealt out into ``splits``
    by a hash of that side's columns, and the other side's rows of it are sent to each. At
    most as many keys as the shares allow can pass, so their table is broadcast. A key hot
    on both sides meets in ``splits`` squared parts. ``right_counts`` is (key, n), if known.
    """
    shares = 4 * shuffle_width(left.sparkSession)

    def heavy(counts, name):
        total = counts.agg(F.sum("n")).scalar()
        return counts.filter(F.col("n") * shares > total).select(F.col(key), F.lit(splits).alias(name))

    count = lambda df: df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col(key).isNotNull())
    right_counts = count(right) if right_counts is None else right_counts
    hot = durable(heavy(count(left), "_lp").join(heavy(right_counts, "_rp"), key, "full"))

    def dealt(df, by, own, other, mine, theirs):
        sided = df.join(F.broadcast(hot), key, "left").withColumn(
            mine, F.pmod(F.xxhash64(*by), F.coalesce(own, F.lit(1))).cast("int"))
        return sided.withColumn(theirs, F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))).drop("_lp", "_rp")

    sides = (dealt(left, left_by, F.col("_lp"), F.col("_rp"), "_a", "_b"),
             dealt(right, right_by, F.col("_rp"), F.col("_lp"), "_b", "_a"))
    return sides[0].join(sides[1], [key, "_a", "_b"]).drop("_a", "_b")
