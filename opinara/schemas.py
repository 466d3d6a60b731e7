"""Record layouts shared by all layers."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXTS = T.ArrayType(T.StringType())

RAW = T.StructType([
    T.StructField("ingest_seq", T.LongType(), False),
    T.StructField("source_id", T.StringType(), False),
    T.StructField("source_url", T.StringType()),
    T.StructField("raw_text", T.StringType(), False),
    T.StructField("scraped_at", T.TimestampType()),
    T.StructField("metadata", T.VariantType()),
])

ANALYZED = T.StructType([
    T.StructField("source_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("sentiment", T.StringType()),
    T.StructField("sentiment_score", T.DoubleType()),
    T.StructField("confidence_score", T.DoubleType()),
    T.StructField("review_date", T.TimestampType()),
    T.StructField("summary", T.StringType()),
    T.StructField("key_topics", _TEXTS),
    T.StructField("pros", _TEXTS),
    T.StructField("cons", _TEXTS),
    T.StructField("reviewer_rating", T.DoubleType()),
    T.StructField("is_verified_purchase", T.BooleanType()),
    T.StructField("reviewer_expertise", T.StringType()),
    T.StructField("urgency_level", T.StringType()),
    T.StructField("action_required", T.BooleanType()),
    T.StructField("action_notes", T.StringType()),
    T.StructField("mentioned_competitors", _TEXTS),
    T.StructField("data_quality", T.StringType()),
    T.StructField("language_detected", T.StringType()),
    T.StructField("is_spam_or_fake", T.BooleanType()),
    T.StructField("analyzed_at", T.TimestampType()),
])

SERIES = T.StructType([
    T.StructField("period", T.StringType()),
    T.StructField("avg_sentiment", T.DoubleType()),
    T.StructField("review_count", T.LongType()),
    T.StructField("avg_rating", T.DoubleType()),
    T.StructField("negative_rate", T.DoubleType()),
    T.StructField("positive_rate", T.DoubleType()),
])

ANOMALY = T.StructType([
    T.StructField("period", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("z_score", T.DoubleType()),
    T.StructField("severity", T.StringType()),
    T.StructField("mean", T.DoubleType()),
    T.StructField("std", T.DoubleType()),
])

REJECT = T.StructType([
    T.StructField("source_id", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("rule", T.StringType()),
    T.StructField("payload", T.StringType()),
])

# The closed value sets of the record contract.
SENTIMENTS = ("positive", "neutral", "negative", "mixed")
CATEGORIES = ("electronics", "clothing", "home_garden", "sports", "books", "beauty", "unknown")
URGENCIES = ("critical", "high", "medium", "low")
QUALITIES = ("high", "medium", "low")
EXPERTISE = ("novice", "intermediate", "expert")
