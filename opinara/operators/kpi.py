"""Counts, means, shares and top-k tables over the clean review table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.functions.numeric import not_nan, round_exact, steady_mean
from opinara.functions.text import strip

# Fixed values.
TOP_N = 10
REPORT_TOPICS = 5
DISTRIBUTIONS = ("sentiment", "product_category", "data_quality", "language_detected")
NO_COMPETITOR = ("", "nan", "None")


def safe_mean(column: str | Column, digits: int = 4) -> Column:
    """Aggregate: rounded mean of the numeric values, 0.0 when there are none."""
    value = F.col(column) if isinstance(column, str) else column
    return F.coalesce(round_exact(steady_mean(not_nan(value.try_cast("double"))), digits), F.lit(0.0))


def value_counts(df: DataFrame, column: str, top_n: int | None = None) -> DataFrame:
    """(value, count) by falling count; equal counts by value."""
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc("value"))
    )
    return counts.limit(top_n) if top_n else counts


def list_items(df: DataFrame, column: str, copy: str) -> Column:
    """The list column, or its pipe-joined copy when the list is missing."""
    name = column if column in df.columns else copy
    if isinstance(df.schema[name].dataType, T.ArrayType):
        return F.col(name)
    return F.split(F.col(name), r"\|")


def top_topics(df: DataFrame, top_n: int = TOP_N) -> DataFrame:
    """(topic, count, avg_sentiment): a row naming a topic twice counts twice."""
    named = df.select(
        F.explode(list_items(df, "key_topics", "key_topics_str")).alias("topic"), "sentiment_score"
    ).withColumn("topic", strip(F.col("topic")))
    return (
        named.filter("topic <> ''")
        .groupBy("topic")
        .agg(F.count(F.lit(1)).alias("count"), steady_mean(not_nan(F.col("sentiment_score"))).alias("avg_sentiment"))
        .orderBy(F.desc("count"), F.asc("topic"))
        .limit(top_n)
        .withColumn("avg_sentiment", round_exact(F.col("avg_sentiment"), 3))
    )


def competitor_mentions(df: DataFrame, top_n: int = TOP_N) -> DataFrame:
    """(value, count) of named competitors."""
    named = df.select(
        F.explode(list_items(df, "mentioned_competitors", "competitors_str")).alias("competitor")
    ).withColumn("competitor", strip(F.col("competitor")))
    return value_counts(named.filter(~F.col("competitor").isin(*NO_COMPETITOR)), "competitor", top_n)


def scalar_kpis(df: DataFrame) -> DataFrame:
    """One row of totals and means; zeros for an empty table."""
    means = {"average_sentiment_score": 4, "average_rating": 2, "average_confidence": 4}
    totals = df.agg(
        F.count(F.lit(1)).alias("total_reviews_analyzed"),
        F.count_if(F.col("data_quality") == "high").alias("high_quality_reviews"),
        steady_mean(not_nan(F.col("sentiment_score"))).alias("average_sentiment_score"),
        steady_mean(not_nan(F.col("reviewer_rating"))).alias("average_rating"),
        steady_mean(not_nan(F.col("confidence_score"))).alias("average_confidence"),
        F.count_if(F.coalesce(F.col("action_required"), F.lit(False))).alias("action_required_count"),
        F.count_if(F.col("urgency_level") == "critical").alias("critical_urgency_count"),
        F.count_if(F.col("urgency_level") == "high").alias("high_urgency_count"),
    ).withColumns({name: round_exact(F.col(name), digits) for name, digits in means.items()})
    return totals.fillna(0.0, ["average_sentiment_score", "average_confidence"])


def spam_excluded(raw: DataFrame) -> DataFrame:
    """Spam rows of the uncleaned table, copies included."""
    return raw.agg(F.count_if(F.coalesce(F.col("is_spam_or_fake"), F.lit(False))).alias("spam_excluded"))


def distributions(df: DataFrame, columns: tuple[str, ...] = DISTRIBUTIONS) -> DataFrame:
    """(dimension, value, count) of several label columns in one pass."""
    present = [name for name in columns if name in df.columns]
    return (
        df.unpivot([], present, "dimension", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("dimension", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def with_share(counts: DataFrame, by: str = "dimension") -> DataFrame:
    """Share of the dimension's total, as a number and as percent text.

    The window sees the finished counts - one row per label - not the reviews.
    """
    total = F.greatest(F.sum("count").over(Window.partitionBy(by)), F.lit(1))
    ratio = F.col("count") / total
    return counts.withColumns({"share": round_exact(ratio, 4), "percent": percent(ratio)})


def percent(ratio: Column, digits: int = 1) -> Column:
    return F.format_string(f"%.{digits}f%%", round_exact(ratio * F.lit(100.0), digits))


def report_topics(df: DataFrame) -> DataFrame:
    """The few topics a short report shows."""
    return top_topics(df, TOP_N).orderBy(F.desc("count"), F.asc("topic")).limit(REPORT_TOPICS)
