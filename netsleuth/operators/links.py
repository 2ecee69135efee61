"""Link prediction: learned factors, neighbourhood heuristics, evaluation and ranking."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsleuth.functions.columns import dot, hash_hex, sigmoid
from netsleuth.operators.graph import dense_index
from netsleuth.operators.logistic import Logistic, fit
from netsleuth.operators.metrics import ranking_metrics
from netsleuth.operators.ranking import sketch_rank, spread_join, spread_lookup
from netsleuth.session import durable


def link_factors(train: DataFrame, nodes: DataFrame, rank: int = 16, iterations: int = 10, seed: int = 42) -> DataFrame:
    """Group and technique vectors from implicit-feedback factorisation: (id, kind, z)."""
    indexed = dense_index(nodes.select("id", "kind"), by=["kind"])
    side = lambda kind, key, name: indexed.filter(F.col("kind") == kind).select(
        F.col("id").alias(key), F.col("idx").cast("int").alias(name))
    rated = spread_lookup(train.select("src", "dst"), side("group", "src", "user"), "src", ["user"])
    rated = spread_lookup(rated, side("technique", "dst", "item"), "dst", ["item"], sketch=train)
    rated = durable(rated.filter("user is not null and item is not null").select("user", "item", F.lit(1.0).alias("rating")))
    model = ALS(
        rank=rank, maxIter=iterations, implicitPrefs=True, seed=seed, userCol="user", itemCol="item",
        ratingCol="rating").fit(rated)
    vectors = lambda kind, factors: indexed.filter(F.col("kind") == kind).join(
        factors.withColumnRenamed("id", "_i"), F.col("idx") == F.col("_i")).select(
        "id", "kind", F.col("features").alias("z"))
    return vectors("group", model.userFactors).unionByName(vectors("technique", model.itemFactors))


@dataclass
class Neighbours:
    """A message graph made ready for many pair tables: its distinct edges (src, dst) and the degrees (src, degree)."""

    edges: DataFrame
    degrees: DataFrame


def neighbours(message: DataFrame) -> Neighbours:
    """Distinct edges and degrees of a message graph, each stored once."""
    edges = durable(message.select("src", "dst").distinct())
    return Neighbours(edges, durable(edges.groupBy("src").agg(F.count(F.lit(1)).alias("degree"))))


def link_heuristics(pairs: DataFrame, message: DataFrame | Neighbours) -> DataFrame:
    """Common neighbours, Jaccard, Adamic-Adar and preferential attachment per pair.

    Only the endpoint with fewer neighbours is expanded, then the other end is
    probed by (node, neighbour); no group of neighbours is paired with itself.
    A pair's own edge does not count. Expanded rows carry the number of their pair,
    not its two ids.
    """
    around = message if isinstance(message, Neighbours) else neighbours(message)
    edges = around.edges
    degree_of = lambda key, name: around.degrees.select(F.col("src").alias(key), F.col("degree").alias(name))

    asked = durable(pairs.select("src", "dst").distinct().withColumn("_p", F.monotonically_increasing_id()))
    placed = spread_lookup(asked, degree_of("src", "_ds"), "src", ["_ds"])
    placed = durable(spread_lookup(placed, degree_of("dst", "_dd"), "dst", ["_dd"], sketch=asked))

    small_first = F.col("_ds") <= F.col("_dd")
    expanded = placed.filter(F.col("_ds").isNotNull() & F.col("_dd").isNotNull()).select(
        F.when(small_first, F.col("src")).otherwise(F.col("dst")).alias("pivot"),
        F.when(small_first, F.col("dst")).otherwise(F.col("src")).alias("other"), "_p")
    reach = edges.select(F.col("src").alias("pivot"), F.col("dst").alias("via"))
    probe = edges.select(F.col("src").alias("other"), F.col("dst").alias("via"), F.lit(True).alias("_met"))
    # a hub's neighbours and its pairs are dealt out
    reached = spread_join(expanded, reach, "pivot", ["_p"], ["via"], degree_of("pivot", "n")).drop("pivot")
    # the other end itself among the neighbours is the pair's own edge
    own = F.col("via") == F.col("other")
    met = reached.join(probe, ["other", "via"], "left").filter(F.col("_met") | own).select(
        "_p", "via", F.col("_met").isNotNull().alias("_met"), own.alias("_own"))
    shared = durable(met)
    shared = spread_lookup(shared, degree_of("via", "_dv"), "via", ["_dv"])
    weight = F.when(F.col("_met") & (F.col("_dv") > 1), 1.0 / F.log(F.col("_dv").cast("double"))).otherwise(0.0)
    scores = shared.groupBy(F.col("_p").alias("_q")).agg(
        F.count_if("_met").alias("cn"), F.sum(weight).alias("aa"), F.max(F.col("_own").cast("int")).alias("_own"))
    less_own = lambda d: F.coalesce(d, F.lit(0)) - F.coalesce("_own", F.lit(0))
    joined = placed.join(scores, F.col("_p") == F.col("_q"), "left").withColumns(
        {"deg_src": less_own("_ds"), "deg_dst": less_own("_dd")})
    cn = F.coalesce("cn", F.lit(0))
    union = F.col("deg_src") + F.col("deg_dst") - cn
    return joined.select(
        "src", "dst", cn.alias("common_neighbours"),
        F.round(F.when(union > 0, cn / union).otherwise(0.0), 6).alias("jaccard"),
        F.round(F.coalesce("aa", F.lit(0.0)), 6).alias("adamic_adar"),
        (F.col("deg_src") * F.col("deg_dst")).alias("preferential_attachment"))


def evaluate_links(positives: DataFrame, negatives: DataFrame, score: str = "score") -> DataFrame:
    """ROC-AUC and average precision of scored held-out and negative pairs."""
    labelled = positives.select(F.lit(1).alias("y"), F.col(score).alias("score")).unionByName(
        negatives.select(F.lit(0).alias("y"), F.col(score).alias("score")))
    return ranking_metrics(labelled)


#: What a trained link score reads of a pair, each on a log scale.
SIGNALS = ["common_neighbours", "jaccard", "adamic_adar", "preferential_attachment"]


def link_signals(pairs: DataFrame, message: DataFrame | Neighbours) -> DataFrame:
    """``pairs`` (src, dst, ...) with the logs of their heuristics on the message graph."""
    found = link_heuristics(pairs, message).select(
        F.col("src").alias("_s"), F.col("dst").alias("_d"), *[F.log1p(F.col(c).cast("double")).alias(c) for c in SIGNALS])
    return pairs.join(found, (F.col("src") == F.col("_s")) & (F.col("dst") == F.col("_d"))).drop("_s", "_d")


def train_link_score(positives: DataFrame, negatives: DataFrame, message: DataFrame | Neighbours) -> tuple[Logistic, DataFrame]:
    """A logistic score of the signals and the labelled pairs it was fitted on.

    Both pair tables lie outside the message graph, as held-out edges do, so the signals of
    an edge do not come from the edge itself. Pairs in both tables count as positive.
    """
    pairs = positives.select("src", "dst").distinct().withColumn("y", F.lit(1)).unionByName(
        negatives.select("src", "dst").distinct().join(positives, ["src", "dst"], "left_anti").withColumn("y", F.lit(0)))
    labelled = durable(link_signals(durable(pairs), message))
    return fit(labelled, {"link": Logistic(SIGNALS, "y")})["link"], labelled


def score_links(pairs: DataFrame, message: DataFrame | Neighbours, model: Logistic) -> DataFrame:
    """``pairs`` with the chance that the trained score gives them."""
    return link_signals(pairs, message).withColumn("score", model.probability()).drop(*SIGNALS)


def find_group(indexed_nodes: DataFrame, text: str) -> DataFrame:
    """Groups whose name holds ``text``, case aside, by index."""
    return indexed_nodes.filter((F.col("kind") == "group") & F.lower("name").contains(text.lower())).select(
        "idx", "id", "name").orderBy("idx")


def rank_techniques(nodes: DataFrame, z: DataFrame, known: DataFrame, group: str | None, vector: str = "z") -> DataFrame:
    """Every technique by its score for one group, best first, with a known flag.

    Equal scores follow md5 order of the id, so a large tie spreads over tasks; buckets of a
    quantile sketch keep the table of bucket sizes short. A group that has no vector, or None,
    gives no rows.
    """
    wanted = z.filter(F.col("id") == group).agg(F.first(vector)).scalar()
    techniques = nodes.filter(F.col("kind") == "technique").select("id", "name", "ext_id")
    vectors = z.select(F.col("id").alias("_z"), F.col(vector).alias("_v"))
    scored = (
        techniques.join(vectors, F.col("id") == F.col("_z")).withColumn("_w", wanted).filter(F.col("_w").isNotNull())
        .withColumn("score", F.round(sigmoid(dot(F.col("_v"), F.col("_w"))), 4)))
    return _ranked(scored, known, group)


def rank_by_link_score(nodes: DataFrame, message: DataFrame | Neighbours, known: DataFrame, group: str | None,
                       model: Logistic) -> DataFrame:
    """The same ranking by a trained score; every technique counts, linked or not.

    A group that the nodes lack, or None, gives no rows.
    """
    there = nodes.filter((F.col("kind") == "group") & (F.col("id") == group)).select(F.max("id").alias("src"))
    techniques = nodes.filter(F.col("kind") == "technique").select("id", "name", "ext_id")
    pairs = techniques.withColumns({"src": there.scalar(), "dst": F.col("id")}).filter(F.col("src").isNotNull())
    scored = score_links(durable(pairs), message, model).withColumn("score", F.round("score", 4))
    return _ranked(scored, known, group)


def _ranked(scored: DataFrame, known: DataFrame, group: str | None) -> DataFrame:
    documented = known.filter(F.col("src") == group).select(F.col("dst").alias("_known")).distinct()
    flagged = scored.join(documented, F.col("id") == F.col("_known"), "left").select(
        "id", F.col("ext_id").alias("technique_id"), "name", "score", F.col("_known").isNotNull().alias("known"))
    flagged = durable(flagged.withColumn("_down", -F.col("score")))
    return sketch_rank(flagged, "_down", hash_hex(0, F.col("id")), [F.col("id")]).drop("_down")


def recovered_at_known(ranked: DataFrame) -> DataFrame:
    """How many documented techniques sit in the top as many ranks."""
    n_known = ranked.agg(F.count_if(F.col("known"))).scalar()
    return ranked.agg(
        F.count_if(F.col("known")).alias("n_known"),
        F.count_if(F.col("known") & (F.col("rank") <= n_known)).alias("recovered"))


def new_predictions(ranked: DataFrame, n: int = 10) -> DataFrame:
    """The best ``n`` techniques not yet documented for the group."""
    return ranked.filter(~F.col("known")).orderBy("rank").limit(n)
