"""Column names and schemas shared by every stage."""

from __future__ import annotations

from pyspark.sql import types as T

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("entity_id", T.StringType()),
        T.StructField("business_name", T.StringType()),
        T.StructField("business_address", T.StringType()),
        T.StructField("country", T.StringType()),
    ]
)

TRUTH_SCHEMA = T.StructType(
    [
        T.StructField("source1_entity_id", T.StringType()),
        T.StructField("matched_entity_ids", T.StringType()),
    ]
)

PAIR_KEYS = ["source1_entity_id", "candidate_entity_id", "source"]

# Fixed order: a saved model reads its inputs in this order.
FEATURES = [
    "country_match",
    "name_exact",
    "name_first_match",
    "name_last_match",
    "name_first_two_match",
    "name_contains",
    "name_length_diff",
    "name_length_ratio",
    "address_exact",
    "address_first_match",
    "address_number_match",
    "address_contains",
    "address_length_diff",
    "address_length_ratio",
    "name_missing",
    "address_missing",
]

# Features that are NULL when one of the two fields is NULL.
NULLABLE_FEATURES = [
    "name_length_diff",
    "name_length_ratio",
    "address_length_diff",
    "address_length_ratio",
]

MATCH_HEADER = ["source1_entity_id", "matched_entity_ids"]
CANDIDATE_HEADER = ["source1_entity_id", "candidate_entity_ids"]
