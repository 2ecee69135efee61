"""Column expressions shared by batch and streaming code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from netsleuth.functions.schema import MODEL_FEATURES, NUMERIC_FEATURES


def safe_div(num: Column, den: Column) -> Column:
    """Quotient that treats a zero denominator as 1; a null one stays null."""
    return num / F.when(den == 0, F.lit(1.0)).otherwise(den)


def engineered() -> dict[str, Column]:
    """The ten derived flow features by name, over the raw feature columns."""
    c = F.col
    total_bytes = c("IN_BYTES") + c("OUT_BYTES")
    total_pkts = c("IN_PKTS") + c("OUT_PKTS")
    resent = c("RETRANSMITTED_IN_PKTS") + c("RETRANSMITTED_OUT_PKTS")
    return {
        "TOTAL_BYTES": total_bytes,
        "TOTAL_PKTS": total_pkts,
        "BYTES_PER_PKT_IN": safe_div(c("IN_BYTES"), c("IN_PKTS")),
        "BYTES_PER_PKT_OUT": safe_div(c("OUT_BYTES"), c("OUT_PKTS")),
        "BYTE_DIR_RATIO": safe_div(c("IN_BYTES"), c("OUT_BYTES") + 1.0),
        "PKT_DIR_RATIO": safe_div(c("IN_PKTS"), c("OUT_PKTS") + 1.0),
        "BYTES_PER_MS": safe_div(total_bytes, c("FLOW_DURATION_MILLISECONDS") + 1.0),
        "PKT_SIZE_RANGE": c("MAX_IP_PKT_LEN") - c("MIN_IP_PKT_LEN"),
        "TTL_RANGE": c("MAX_TTL") - c("MIN_TTL"),
        "RETRANS_RATE": safe_div(resent, total_pkts),
    }


def completed(flow_map: Column) -> list[Column]:
    """The raw features of a ``map<string,double>`` request; missing or null is 0."""
    return [F.coalesce(F.try_element_at(flow_map, F.lit(n)), F.lit(0.0)).alias(n) for n in NUMERIC_FEATURES]


def matrix_value(col: Column) -> Column:
    """Single-precision model input; overflow and NaN count as missing."""
    as_float = col.cast("float")
    return F.when(F.isnan(as_float) | (F.abs(as_float) == float("inf")), None).otherwise(as_float)


def linear_probability(weights: dict[str, float], bias: float) -> Column:
    """Logistic score of a linear model over matrix columns; missing adds nothing."""
    logit = F.lit(bias)
    for name in [n for n in MODEL_FEATURES if n in weights] + [n for n in weights if n not in MODEL_FEATURES]:
        logit = logit + F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * F.lit(weights[name])
    return sigmoid(logit)


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def verdict_columns(probability: Column, threshold: float = 0.5) -> list[Column]:
    """Rounded probability, 0/1 prediction and its word; the bar is inclusive."""
    hit = probability >= threshold
    return [
        F.round(probability, 6).alias("malicious_probability"),
        F.when(hit, 1).otherwise(0).alias("prediction"),
        F.when(hit, "attack").otherwise("benign").alias("verdict"),
    ]


def hash_hex(seed, *keys: Column) -> Column:
    """Reproducible pseudo-random order key: md5 over the seed and the row key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]))


def hash_long(seed, *keys: Column) -> Column:
    """The first eight hex digits of :func:`hash_hex` as a number below 2^32."""
    return F.conv(F.substring(hash_hex(seed, *keys), 1, 8), 16, 10).cast("bigint")


def hash_uniform(seed, *keys: Column) -> Column:
    """Reproducible uniform draw in [0, 1)."""
    return hash_long(seed, *keys) / F.lit(4294967296.0)


def tokens(text: Column) -> Column:
    """Runs of letters, lower-cased; accented letters count."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), 1)


def dot(a: Column, b: Column) -> Column:
    """Double-precision inner product of two numeric arrays."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def technique_ids(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"\b(T\d{4}(?:\.\d{3})?)\b"), 1)


def cve_ids(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"\b(CVE-\d{4}-\d{4,})\b"), 1)
