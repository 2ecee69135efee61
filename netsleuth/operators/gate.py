"""Data-quality gate: every rule of a suite in one pass over all rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsleuth.functions.schema import ATTACK, FLOW_COLUMNS, LABEL


@dataclass(frozen=True)
class Rule:
    """A named expectation; ``violation`` is true on a bad row, null counts as good."""

    name: str
    violation: Column | None = None
    columns: tuple[str, ...] = ()


def expect_columns(required: list[str]) -> Rule:
    return Rule("expect_table_columns_to_match_set", columns=tuple(required))


def expect_not_null(column: str) -> Rule:
    return Rule(f"expect_column_values_to_not_be_null:{column}", F.col(column).isNull())


def expect_in_set(column: str, allowed: list) -> Rule:
    return Rule(f"expect_column_values_to_be_in_set:{column}", ~F.col(column).isin(allowed))


def expect_between(column: str, low=None, high=None) -> Rule:
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < low)
    if high is not None:
        bad = bad | (F.col(column) > high)
    return Rule(f"expect_column_values_to_be_between:{column}", bad)


def expect_match(column: str, pattern: str) -> Rule:
    return Rule(f"expect_column_values_to_match_regex:{column}", ~F.col(column).rlike(pattern))


def flow_suite() -> list[Rule]:
    """The fourteen expectations on a flow batch."""
    volumes = ["IN_BYTES", "OUT_BYTES", "IN_PKTS", "OUT_PKTS"]
    return (
        [expect_columns(FLOW_COLUMNS), expect_not_null(LABEL), expect_in_set(LABEL, [0, 1]), expect_not_null(ATTACK)]
        + [expect_not_null(c) for c in volumes + ["PROTOCOL"]]
        + [expect_between(c, 0) for c in volumes]
        + [expect_between("PROTOCOL", 0, 255)])


def _row_rules(rules: list[Rule]) -> list[Rule]:
    return [r for r in rules if r.violation is not None]


def gate_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per rule: rows evaluated, violations, success. One aggregate over the table."""
    row_rules = _row_rules(rules)
    counted = df.agg(
        F.count(F.lit(1)).alias("evaluated"),
        *[F.count_if(r.violation).alias(f"v{i}") for i, r in enumerate(row_rules)])
    entries = [
        F.struct(F.lit(r.name).alias("rule"), F.col("evaluated"), F.col(f"v{i}").alias("violations"))
        for i, r in enumerate(row_rules)]
    for rule in rules:
        if rule.violation is None:
            missing = len(set(rule.columns) - set(df.columns))
            entries.append(F.struct(F.lit(rule.name).alias("rule"), F.col("evaluated"),
                                    F.lit(missing).cast("bigint").alias("violations")))
    return counted.select(F.inline(F.array(*entries))).withColumn("success", F.col("violations") == 0)


def gate_report(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row: overall success, rules evaluated and passed, names of the failed ones."""
    failed = F.array_sort(F.collect_list(F.when(~F.col("success"), F.col("rule"))))
    return gate_rules(df, rules).agg(
        F.every("success").alias("success"),
        F.count(F.lit(1)).alias("evaluated"),
        F.count_if(F.col("success")).alias("passed"),
        failed.alias("failed"))


def mark_failures(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``failed_rules``, the names of the rules each row breaks."""
    names = [F.when(r.violation, F.lit(r.name)) for r in _row_rules(rules)]
    return df.withColumn("failed_rules", F.array_compact(F.array(*names)))


def quarantine(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with their failed rules."""
    marked = mark_failures(df, rules)
    return (marked.filter(F.size("failed_rules") == 0).drop("failed_rules"),
            marked.filter(F.size("failed_rules") > 0))


class GateFailed(RuntimeError):
    """Raised in abort mode before anything is published."""


def require(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The batch itself if it passes; raises otherwise."""
    report = gate_report(df, rules).first()
    if not report["success"]:
        raise GateFailed(f"{report['passed']}/{report['evaluated']} rules met, failed: {report['failed']}")
    return df


def label_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy(LABEL).agg(F.count(F.lit(1)).alias("flows")).orderBy(LABEL)
