"""Retrieval and answer quality by ids and words."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netsleuth.functions.columns import tokens
from netsleuth.session import durable

SUPPORT_BAR = 0.5


GRAM = 3


def _runs(parts, size, hashed: bool):
    """Every run of ``size`` consecutive entries of an array; one shorter run where there are fewer."""
    one = (lambda i: F.xxhash64(F.slice(parts, i, size))) if hashed else (lambda i: F.array_join(F.slice(parts, i, size), ""))
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - size + 1, F.lit(1))), one)


def passages_containing(passages: DataFrame, documents: DataFrame, shingle: int = 6) -> DataFrame:
    """Documents holding a passage verbatim: (q_id, doc_id).

    Candidates come from equi-joins and are then checked in full. The whole words inside
    a passage, its first and last left out, must recur in such a document, so a run of
    up to ``shingle`` of them is the key. A passage without an inner word is keyed by
    that run of up to ``GRAM`` characters of it that fewest documents have. ``passages``
    is (q_id, passage), ``documents`` (doc_id, text); null passages are held by no
    document, empty ones by every document with a text.
    """
    words = tokens(F.col("passage"))
    inner = F.slice(words, 2, F.greatest(F.size(words) - 2, F.lit(0)))
    held = durable(passages.filter(F.col("passage").isNotNull()).select("q_id", "passage", F.slice(inner, 1, shingle).alias("_run")))
    asked = held.filter(F.size("_run") > 0).select("q_id", F.size("_run").alias("_n"), F.xxhash64("_run").alias("_key"))
    # run lengths in use, ``shingle`` at most
    lengths = asked.agg(F.collect_set("_n").alias("_ns")).select("_ns").scalar()
    body = documents.select("doc_id", tokens(F.col("text")).alias("_t")).withColumn("_ns", lengths)
    keyed = body.select("doc_id", F.explode(F.array_distinct(F.flatten(F.transform(
        "_ns", lambda n: _runs(F.col("_t"), n, True))))).alias("_key"))
    pairs = keyed.join(asked.select("q_id", "_key"), "_key").select("q_id", "doc_id")

    letters = lambda c: F.when(F.length(c) > 0, F.split(c, "")).otherwise(F.array().cast("array<string>"))
    short = held.filter(F.size("_run") == 0).select("q_id", letters("passage").alias("_c")).withColumn(
        "_n", F.least(F.size("_c"), F.lit(GRAM)))
    grams = short.select("q_id", F.explode(F.array_distinct(_runs(F.col("_c"), F.col("_n"), False))).alias("_gram"))
    sizes = short.agg(F.collect_set("_n").alias("_ns")).select("_ns").scalar()
    text = documents.filter(F.col("text").isNotNull()).select("doc_id", letters("text").alias("_c")).withColumn("_ns", sizes)
    spelt = text.select("doc_id", F.explode(F.array_distinct(F.flatten(F.transform(
        "_ns", lambda n: F.when(n > 0, _runs(F.col("_c"), n, False)).otherwise(F.array(F.lit(""))))))).alias("_gram"))
    wanted = durable(spelt.join(grams.select("_gram").distinct(), "_gram"))
    counted = grams.join(wanted.groupBy("_gram").agg(F.count(F.lit(1)).alias("_df")), "_gram")
    rarest = counted.groupBy("q_id").agg(F.min_by("_gram", F.struct("_df", "_gram")).alias("_gram"))
    pairs = pairs.unionByName(wanted.join(rarest, "_gram").select("q_id", "doc_id")).distinct()
    return pairs.join(documents, "doc_id").join(passages, "q_id").filter(
        F.contains(F.col("text"), F.col("passage"))).select("q_id", "doc_id").distinct()


def context_precision(hits: DataFrame, relevant: DataFrame) -> DataFrame:
    """Per query, the mean of precision@rank over the relevant ranks; 0 when none is.

    ``hits`` is (q_id, item, rank) with few ranks per query, ``relevant`` (q_id, item).
    """
    flagged = hits.join(relevant.distinct().withColumn("_rel", F.lit(1)), ["q_id", "item"], "left")
    rel = F.coalesce("_rel", F.lit(0))
    upto = F.sum(rel).over(Window.partitionBy("q_id").orderBy("rank"))
    gain = flagged.select("q_id", rel.alias("rel"), (upto / F.col("rank") * rel).alias("gain"))
    found = F.sum("rel")
    return gain.groupBy("q_id").agg(
        F.round(F.when(found > 0, F.sum("gain") / found).otherwise(0.0), 4).alias("context_precision"))


def context_recall(hits: DataFrame, relevant: DataFrame) -> DataFrame:
    """Per query with relevant items, the share of them found."""
    seen = hits.select("q_id", "item").distinct().withColumn("_hit", F.lit(1))
    return relevant.distinct().join(seen, ["q_id", "item"], "left").groupBy("q_id").agg(
        F.round(F.count("_hit") / F.count(F.lit(1)), 4).alias("context_recall"))


def groundedness(answers: DataFrame, contexts: DataFrame, bar: float = SUPPORT_BAR) -> DataFrame:
    """Share of answer sentences whose words mostly occur in earlier context of the run.

    ``answers`` is (run, turn, answer), ``contexts`` (run, turn, text). A word counts
    as covered when its first turn in the run precedes the answer, so no answer is
    paired with every context.
    """
    first = contexts.select("run", F.explode(F.array_distinct(tokens(F.col("text")))).alias("word"), "turn").groupBy(
        "run", "word").agg(F.min("turn").alias("first_turn"))
    sentences = answers.select("run", "turn", F.posexplode(F.split("answer", r"[.!?]\s+")).alias("no", "sentence"))
    words = sentences.select("run", "turn", "no", F.explode(F.array_distinct(tokens(F.col("sentence")))).alias("word"))
    covered = words.join(first, ["run", "word"], "left").groupBy("run", "turn", "no").agg(
        (F.count_if(F.col("first_turn") < F.col("turn")) / F.count(F.lit(1)) >= bar).alias("supported"))
    shares = covered.groupBy("run", "turn").agg(
        F.round(F.count_if(F.col("supported")) / F.count(F.lit(1)), 4).alias("groundedness"))
    return answers.select("run", "turn").join(shares, ["run", "turn"], "left")


def answer_relevancy(pairs: DataFrame, weights: DataFrame) -> DataFrame:
    """Cosine of the weighted terms of question and answer; ``pairs`` is (q_id, a_id)."""
    asked = weights.select(F.col("id").alias("q_id"), "term", F.col("weight").alias("_wq"))
    said = weights.select(F.col("id").alias("a_id"), "term", F.col("weight").alias("_wa"))
    shared = pairs.join(asked, "q_id").join(said, ["a_id", "term"])
    cosine = shared.groupBy("q_id", "a_id").agg(F.sum(F.col("_wq") * F.col("_wa")).alias("_c"))
    return pairs.join(cosine, ["q_id", "a_id"], "left").select(
        "q_id", "a_id", F.round(F.coalesce("_c", F.lit(0.0)), 4).alias("relevancy"))
