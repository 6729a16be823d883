"""Fixed StructTypes per layer and entity.

Readers pass these schemas to ``spark.read`` so that no file footer has to be
sampled for inference and a drifting file fails loudly instead of silently
changing a column type.
"""

from __future__ import annotations

from pyspark.sql import types as T

SEQ = "_seq"          # arrival order of a Bronze row (keep-first dedupe)
DATE = "date"         # partition column of every layer
PROCESSED_AT = "_silver_processed_at"
SOURCE = "_source"

BRONZE = {
    "users": T.StructType([
        T.StructField("user_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField(SEQ, T.LongType()),
    ]),
    "transactions": T.StructType([
        T.StructField("transaction_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField(SEQ, T.LongType()),
    ]),
    "transaction_details": T.StructType([
        T.StructField("detail_id", T.StringType()),
        T.StructField("transaction_id", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("processing_time_ms", T.LongType()),
        T.StructField(SEQ, T.LongType()),
    ]),
}

_AUDIT = [T.StructField(PROCESSED_AT, T.StringType()), T.StructField(SOURCE, T.StringType())]


def _without_seq(schema: T.StructType) -> list[T.StructField]:
    return [f for f in schema.fields if f.name != SEQ]


SILVER = {
    "users": T.StructType(_without_seq(BRONZE["users"]) + _AUDIT),
    "transactions": T.StructType(
        [f if f.name != "created_at" else T.StructField("created_at", T.TimestampNTZType())
         for f in _without_seq(BRONZE["transactions"])] + _AUDIT),
    "transaction_details": T.StructType(_without_seq(BRONZE["transaction_details"]) + _AUDIT),
}

GOLD = {
    "gold_user_metrics": T.StructType([
        T.StructField("user_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("total_transactions", T.LongType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("avg_amount", T.DoubleType()),
        T.StructField("max_amount", T.DoubleType()),
        T.StructField("min_amount", T.DoubleType()),
        T.StructField("successful_transactions", T.LongType()),
        T.StructField("failed_transactions", T.LongType()),
        T.StructField("success_rate_pct", T.DoubleType()),
        T.StructField("first_transaction_at", T.TimestampNTZType()),
        T.StructField("last_transaction_at", T.TimestampNTZType()),
    ]),
    "gold_channel_metrics": T.StructType([
        T.StructField("channel", T.StringType()),
        T.StructField("total_transactions", T.LongType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("avg_amount", T.DoubleType()),
        T.StructField("avg_processing_time_ms", T.DoubleType()),
        T.StructField("successful", T.LongType()),
        T.StructField("failed", T.LongType()),
        T.StructField("success_rate_pct", T.DoubleType()),
    ]),
    "gold_payment_method_metrics": T.StructType([
        T.StructField("payment_method", T.StringType()),
        T.StructField("total_transactions", T.LongType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("avg_amount", T.DoubleType()),
        T.StructField("avg_processing_time_ms", T.DoubleType()),
        T.StructField("success_rate_pct", T.DoubleType()),
    ]),
    "gold_summary": T.StructType([
        T.StructField("total_transactions", T.LongType()),
        T.StructField("active_users", T.LongType()),
        T.StructField("total_volume", T.DoubleType()),
        T.StructField("avg_transaction_amount", T.DoubleType()),
        T.StructField("overall_success_rate_pct", T.DoubleType()),
        T.StructField("avg_processing_time_ms", T.DoubleType()),
        T.StructField("pipeline_start", T.TimestampNTZType()),
        T.StructField("pipeline_end", T.TimestampNTZType()),
        T.StructField("generated_at", T.TimestampType()),
    ]),
}

QUALITY_REPORT = T.StructType([
    T.StructField("entity", T.StringType()),
    T.StructField("check", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("detail", T.StringType()),
    T.StructField("checked_at", T.StringType()),
])


def with_date(schema: T.StructType) -> T.StructType:
    """The stored form of a layer table: the schema plus the partition column."""
    return T.StructType(list(schema.fields) + [T.StructField(DATE, T.DateType())])
