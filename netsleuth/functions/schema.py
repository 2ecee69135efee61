"""Declared schemas and the fixed column lists of the flow model."""

from pyspark.sql import types as T

# The NetFlow-v2 column names in file order.
ID_COLUMNS = ["IPV4_SRC_ADDR", "L4_SRC_PORT", "IPV4_DST_ADDR", "L4_DST_PORT"]

NUMERIC_FEATURES = [
    "PROTOCOL", "L7_PROTO", "IN_BYTES", "IN_PKTS", "OUT_BYTES", "OUT_PKTS",
    "TCP_FLAGS", "CLIENT_TCP_FLAGS", "SERVER_TCP_FLAGS",
    "FLOW_DURATION_MILLISECONDS", "DURATION_IN", "DURATION_OUT",
    "MIN_TTL", "MAX_TTL", "LONGEST_FLOW_PKT", "SHORTEST_FLOW_PKT",
    "MIN_IP_PKT_LEN", "MAX_IP_PKT_LEN",
    "SRC_TO_DST_SECOND_BYTES", "DST_TO_SRC_SECOND_BYTES",
    "RETRANSMITTED_IN_BYTES", "RETRANSMITTED_IN_PKTS",
    "RETRANSMITTED_OUT_BYTES", "RETRANSMITTED_OUT_PKTS",
    "SRC_TO_DST_AVG_THROUGHPUT", "DST_TO_SRC_AVG_THROUGHPUT",
    "NUM_PKTS_UP_TO_128_BYTES", "NUM_PKTS_128_TO_256_BYTES",
    "NUM_PKTS_256_TO_512_BYTES", "NUM_PKTS_512_TO_1024_BYTES",
    "NUM_PKTS_1024_TO_1514_BYTES",
    "TCP_WIN_MAX_IN", "TCP_WIN_MAX_OUT",
    "ICMP_TYPE", "ICMP_IPV4_TYPE",
    "DNS_QUERY_ID", "DNS_QUERY_TYPE", "DNS_TTL_ANSWER",
    "FTP_COMMAND_RET_CODE",
]

LABEL = "Label"
ATTACK = "Attack"
FLOW_COLUMNS = ID_COLUMNS + NUMERIC_FEATURES + [LABEL, ATTACK]
INGEST_COLUMNS = ["_ingest_source", "_ingest_ts"]

# The derived features, in model order after the raw ones.
ENGINEERED_FEATURES = [
    "TOTAL_BYTES", "TOTAL_PKTS", "BYTES_PER_PKT_IN", "BYTES_PER_PKT_OUT",
    "BYTE_DIR_RATIO", "PKT_DIR_RATIO", "BYTES_PER_MS", "PKT_SIZE_RANGE",
    "TTL_RANGE", "RETRANS_RATE",
]
MODEL_FEATURES = NUMERIC_FEATURES + ENGINEERED_FEATURES

# Names a drift check hands to the scheduler.
RETRAIN = "retrain_features"
SKIP = "skip_retrain"


def _fields(names, kind):
    return [T.StructField(n, kind) for n in names]


FLOW_SCHEMA = T.StructType(
    [
        T.StructField("IPV4_SRC_ADDR", T.StringType()),
        T.StructField("L4_SRC_PORT", T.IntegerType()),
        T.StructField("IPV4_DST_ADDR", T.StringType()),
        T.StructField("L4_DST_PORT", T.IntegerType()),
    ]
    + _fields(NUMERIC_FEATURES, T.DoubleType())
    + [T.StructField(LABEL, T.IntegerType()), T.StructField(ATTACK, T.StringType())]
)

# Superset of the object kinds in a threat-knowledge bundle.
BUNDLE_OBJECT = (
    "id string, type string, name string, description string, revoked boolean, "
    "x_mitre_deprecated boolean, x_mitre_is_subtechnique boolean, x_mitre_platforms array<string>, "
    "kill_chain_phases array<struct<kill_chain_name: string, phase_name: string>>, "
    "external_references array<struct<source_name: string, external_id: string, url: string>>, "
    "relationship_type string, source_ref string, target_ref string"
)
BUNDLE_SCHEMA = f"objects array<struct<{BUNDLE_OBJECT}>>"

_CVSS = "array<struct<cvssData: struct<baseScore: double, baseSeverity: string>>>"
CVE_SCHEMA = (
    "id string, descriptions array<struct<lang: string, value: string>>, "
    f"metrics struct<cvssMetricV31: {_CVSS}, cvssMetricV30: {_CVSS}, cvssMetricV2: {_CVSS}>"
)

DOCUMENT_SCHEMA = (
    "id string, technique_id string, name string, tactics array<string>, "
    "platforms array<string>, is_subtechnique boolean, url string, text string"
)
QUESTION_SCHEMA = "user_input string, reference string"
TASK_SCHEMA = "question string, expected_tool string, expected_contains array<string>"
RUN_SCHEMA = "question string, answer string, trajectory array<string>, n_steps int"
