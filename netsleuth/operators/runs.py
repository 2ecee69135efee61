"""Investigation runs: lookups the tools make, and scores of the runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsleuth.operators.ranking import bucket_rank
from netsleuth.operators.retrieval import _in_rank_order

MAX_ITERS = 6
SNIPPET = 280
TURNS_PER_BUCKET = 10_000

# Replies when a lookup finds nothing.
NO_SEARCH_HIT = "No matching ATT&CK techniques found."
NO_TECHNIQUE = "No technique match."


def attack_search(questions: DataFrame, hits: DataFrame) -> DataFrame:
    """Reply per question: cited snippets of its hits in rank order."""
    cite = F.concat(F.col("source_id").cast("string"), F.lit(" — "), F.col("name"), F.lit(": "),
                    F.substring("passage", 1, SNIPPET))
    replies = hits.withColumn("cite", cite).groupBy("q_id").agg(
        F.array_join(_in_rank_order("cite"), "\n\n").alias("_reply"))
    return questions.select("q_id").join(replies, "q_id", "left").select(
        "q_id", F.coalesce("_reply", F.lit(NO_SEARCH_HIT)).alias("reply"))


def map_indicator(questions: DataFrame, hits: DataFrame) -> DataFrame:
    """The single best technique per observation."""
    top = hits.filter("rank = 1").select("q_id", F.concat(
        F.col("source_id").cast("string"), F.lit(" — "), F.col("name")).alias("_reply"))
    return questions.select("q_id").join(top, "q_id", "left").select(
        "q_id", F.coalesce("_reply", F.lit(NO_TECHNIQUE)).alias("technique"))


def flatten_cves(cves: DataFrame) -> DataFrame:
    """Nested CVE records to (id, description, severity); the newest CVSS version wins."""
    english = F.get(F.filter("descriptions", lambda d: d["lang"] == "en"), F.lit(0))["value"]
    data = F.coalesce(*[F.get(F.col(f"metrics.{m}"), F.lit(0))["cvssData"]
                        for m in ("cvssMetricV31", "cvssMetricV30", "cvssMetricV2")])
    severity = F.when(data.isNotNull(), F.concat(
        F.coalesce(data["baseScore"].cast("string"), F.lit("None")), F.lit(" ("),
        F.coalesce(data["baseSeverity"], F.lit("n/a")), F.lit(")"))).otherwise("unknown")
    return cves.select("id", F.coalesce(english, F.lit("(no description)")).alias("description"), severity.alias("severity"))


def cve_lookup(asked: DataFrame, cves: DataFrame) -> DataFrame:
    """Reply per asked id; blanks around an id are ignored in the lookup."""
    flat = flatten_cves(cves)
    return asked.join(flat, F.trim("cve_id") == F.col("id"), "left").select(
        "cve_id",
        F.when(F.col("id").isNull(), F.concat(F.lit("No NVD record found for "), F.col("cve_id"), F.lit(".")))
        .otherwise(F.concat(F.col("cve_id"), F.lit(": CVSS "), F.col("severity"), F.lit(". "), F.col("description")))
        .alias("reply"))


def trajectories(messages: DataFrame) -> DataFrame:
    """Tool calls in order, one row each: (run, step, tool).

    ``messages`` is (run, turn, tool, text). Steps are ranked in bands of turns, so a
    run of any length spreads over tasks and is never gathered into one array.
    """
    calls = messages.filter(F.col("tool").isNotNull()).select("run", "turn", "tool")
    ranked = bucket_rank(calls, F.floor(F.col("turn") / TURNS_PER_BUCKET), [F.col("turn")], by=["run"], out="step")
    return ranked.select("run", "step", "tool")


def run_outcomes(messages: DataFrame) -> DataFrame:
    """Final answer and message count per run."""
    return messages.groupBy("run").agg(F.max_by("text", "turn").alias("answer"), F.count(F.lit(1)).alias("n_steps"))


def score_runs(tasks: DataFrame, steps: DataFrame, outcomes: DataFrame, max_iters: int = MAX_ITERS) -> DataFrame:
    """Tool selection, completion and trajectory validity per task.

    ``tasks`` is (run, expected_tool, expected_contains). Calls are counted per tool
    before anything is compared.
    """
    per_tool = steps.groupBy("run", "tool").agg(F.count(F.lit(1)).alias("n"))
    expected = tasks.select(F.col("run").alias("_run"), "expected_tool")
    shape = per_tool.join(expected, F.col("run") == F.col("_run")).groupBy("run").agg(
        F.sum("n").alias("calls"), F.max("n").alias("most"),
        F.max(F.col("tool") == F.col("expected_tool")).alias("selected"))
    scored = tasks.join(shape, "run", "left").join(outcomes.select("run", "answer"), "run", "left")
    answer = F.lower(F.coalesce("answer", F.lit("")))
    calls = F.coalesce("calls", F.lit(0))
    return scored.select(
        "run", "expected_tool",
        F.coalesce("selected", F.lit(False)).alias("tool_selection_ok"),
        F.forall("expected_contains", lambda s: F.contains(answer, F.lower(s))).alias("task_completed"),
        ((calls >= 1) & (calls <= max_iters) & (F.coalesce("most", F.lit(0)) <= 2)).alias("trajectory_valid"))


def steps_of(runs: DataFrame) -> DataFrame:
    """Long form of runs whose trajectory arrives as an array column."""
    return runs.select("run", F.posexplode("trajectory").alias("_i", "tool")).select(
        "run", (F.col("_i") + 1).alias("step"), "tool")


def run_summary(scores: DataFrame) -> DataFrame:
    rate = lambda c: F.round(F.avg(F.col(c).cast("int")), 3)
    return scores.agg(
        F.count(F.lit(1)).alias("n_tasks"),
        rate("tool_selection_ok").alias("tool_selection_accuracy"),
        rate("trajectory_valid").alias("trajectory_validity_rate"),
        rate("task_completed").alias("task_completion_rate"))


def cve_technique_links(cves: DataFrame, hits: DataFrame) -> DataFrame:
    """Each CVE with the technique its description maps to; ``hits`` were asked by CVE id."""
    asked = flatten_cves(cves).select(F.col("id").alias("q_id"))
    return map_indicator(asked, hits).withColumnRenamed("q_id", "cve_id")
