"""Declared schemas of the input and result tables."""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "timestamp": T.TimestampType(), "date": T.DateType(),
    "double": T.DoubleType(), "bigint": T.LongType(),
}


def _struct(spec: str) -> T.StructType:
    """A struct from ``name type, ...`` that needs no running session."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (f.split() for f in spec.split(", "))])


TRANSACTIONS = _struct(
    "transaction_id string, client_id string, datetime timestamp, amount double, currency string, "
    "merchant string, transaction_type string, ip_address string"
)

# Columns that later files added; all nullable text.
EVOLVED_COLUMNS = {
    "category": "string",
    "country_code": "string",
    "region": "string",
    "device_type": "string",
    "session_id": "string",
    "channel": "string",
    "recipient_id": "string",
    "transaction_purpose": "string",
}

TRANSACTIONS_EVOLVED = T.StructType(
    TRANSACTIONS.fields + [T.StructField(n, T.StringType()) for n in EVOLVED_COLUMNS]
)

CLIENTS = _struct(
    "client_id string, first_name string, last_name string, email string, passport_id string, "
    "registration_date date, status string"
)

RATES = _struct("date date, currency string, rate double")

CLIENT_COMMUNITIES = _struct(
    "client_id string, community_id string, influence_score double, community_size bigint, "
    "w_degree double, degree bigint"
)

GRAPH_FACT_COLUMNS = [
    "transaction_id", "client_id", "datetime", "amount", "currency", "merchant",
    "transaction_type", "ip_network", "category",
]
GRAPH_FEATURE_COLUMNS = ["community_id", "influence_score", "community_size", "w_degree"]
