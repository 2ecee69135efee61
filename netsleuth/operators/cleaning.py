"""Bronze to silver to gold: cleaning, typing and flow features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsleuth.functions.columns import completed, engineered, matrix_value
from netsleuth.functions.schema import ATTACK, ID_COLUMNS, INGEST_COLUMNS, LABEL, MODEL_FEATURES, NUMERIC_FEATURES


def drop_identifiers(df: DataFrame, columns: list[str] = ID_COLUMNS + INGEST_COLUMNS) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in columns])


def coerce_numeric(df: DataFrame, columns: list[str] = NUMERIC_FEATURES) -> DataFrame:
    """Columns to double; text that is no number, and null, become 0."""
    present = set(columns) & set(df.columns)
    return df.select(*[
        F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)).alias(c) if c in present else F.col(c)
        for c in df.columns])


def type_labels(df: DataFrame) -> DataFrame:
    return df.withColumns({LABEL: F.col(LABEL).cast("int"), ATTACK: F.col(ATTACK).cast("string")})


def silver(bronze: DataFrame) -> DataFrame:
    return type_labels(coerce_numeric(drop_identifiers(bronze)))


def engineer(df: DataFrame) -> DataFrame:
    """Add the ten flow features in one projection."""
    return df.select("*", *[c.alias(name) for name, c in engineered().items()])


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (LABEL, ATTACK)]


def complete_flows(df: DataFrame, flow_map: str, keep: list[str] = ()) -> DataFrame:
    """Project request maps to the raw feature columns; unknown keys are ignored."""
    return df.select(*keep, *completed(F.col(flow_map)))


def model_matrix(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Single-precision features in model order; overflow becomes null."""
    return df.select(*keep, *[matrix_value(F.col(c)).alias(c) for c in MODEL_FEATURES if c in df.columns])


def feature_parity(a: DataFrame, b: DataFrame, key: str, columns: list[str], tol: float = 1e-9) -> DataFrame:
    """Per feature: the largest absolute difference between two feature paths, and the rows that cannot be compared.

    ``missing`` counts keys absent on one side and values null on one side only; a
    feature is ``within`` if there are none and no difference exceeds ``tol``.
    """
    side = lambda df, mark: df.select(F.col(key).alias("_k" + mark), *[F.col(c).alias(mark + c) for c in columns])
    both = side(a, "_l_").join(side(b, "_r_"), F.col("_k_l_") == F.col("_k_r_"), "full_outer")
    absent = F.col("_k_l_").isNull() | F.col("_k_r_").isNull()
    lone = lambda c: absent | (F.col("_l_" + c).isNull() != F.col("_r_" + c).isNull())
    sums = both.agg(*[F.struct(F.lit(c).alias("feature"), F.max(F.abs(F.col("_l_" + c) - F.col("_r_" + c))).cast("double").alias("max_abs_diff"),
                               F.count_if(lone(c)).alias("missing")).alias(c) for c in columns])
    long = sums.select(F.explode(F.array(*columns)).alias("_f")).select("_f.*")
    return long.withColumn("within", (F.coalesce("max_abs_diff", F.lit(0.0)) <= tol) & (F.col("missing") == 0))
