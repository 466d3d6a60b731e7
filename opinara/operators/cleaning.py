"""Flattening, cleaning in its fixed order, and the removal audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.functions.numeric import clip
from opinara.functions.text import strip

# Fixed values.
MIN_CONFIDENCE = 0.50
CRITICAL_COLUMNS = ("source_id", "sentiment", "sentiment_score")
ENUM_COLUMNS = ("sentiment", "product_category", "urgency_level", "data_quality")
LABEL_COLUMNS = ("sentiment", "product_category", "urgency_level", "language_detected")
TEXT_COPIES = {
    "key_topics": "key_topics_str",
    "pros": "pros_str",
    "cons": "cons_str",
    "mentioned_competitors": "competitors_str",
}
UNKNOWN_PRODUCT = "Unknown"


def flatten(df: DataFrame) -> DataFrame:
    """Analytic table: typed columns and a pipe-joined copy of every list.

    Columns that are not there are left out; a value of the wrong kind becomes
    null, except that an unknown flag becomes false.
    """
    kinds = {field.name: field.dataType for field in df.schema.fields}
    changes: dict[str, Column] = {}
    for name in ENUM_COLUMNS:
        if name in kinds:
            changes[name] = F.lower(F.col(name))
    for name in ("review_date", "analyzed_at"):
        if name in kinds:
            text = isinstance(kinds[name], T.StringType)
            changes[name] = F.try_to_timestamp(F.col(name)) if text else F.col(name).cast("timestamp")
    for name in ("sentiment_score", "confidence_score", "reviewer_rating"):
        if name in kinds:
            changes[name] = F.nullif(F.col(name).try_cast("double"), F.lit(float("nan")))
    for name in ("action_required", "is_spam_or_fake", "is_verified_purchase"):
        if name in kinds:
            changes[name] = F.coalesce(F.col(name).try_cast("boolean"), F.lit(False))
    for name, copy in TEXT_COPIES.items():
        if name in kinds:
            is_list = isinstance(kinds[name], T.ArrayType)
            changes[copy] = F.coalesce(F.array_join(name, "|"), F.lit("")) if is_list else F.lit("")
    return df.withColumns(changes) if changes else df


def _removal_step(columns: list[str], min_confidence: float) -> Column:
    """Name of the first row filter that removes the row, null if none does."""
    step: Column | None = None

    def add(condition: Column, name: str) -> None:
        nonlocal step
        step = F.when(condition, name) if step is None else step.when(condition, name)

    if "is_spam_or_fake" in columns:
        add(F.coalesce(F.col("is_spam_or_fake"), F.lit(False)), "spam")
    if "confidence_score" in columns:
        # Comparing with null or NaN removes nothing.
        low = (F.col("confidence_score") < min_confidence) & ~F.isnan("confidence_score")
        add(F.coalesce(low, F.lit(False)), "low_confidence")
    for name in CRITICAL_COLUMNS:
        if name in columns:
            add(F.col(name).isNull(), "null_critical")
    return F.lit(None).cast("string") if step is None else step


def drop_unusable(df: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Without spam, low confidence and rows lacking a critical value."""
    kept = df
    if "is_spam_or_fake" in df.columns:
        kept = kept.filter(~F.coalesce(F.col("is_spam_or_fake"), F.lit(False)))
    if "confidence_score" in df.columns:
        score = F.col("confidence_score")
        kept = kept.filter(score.isNull() | F.isnan(score) | (score >= min_confidence))
    return kept.dropna(subset=[name for name in CRITICAL_COLUMNS if name in df.columns])


def first_per_id(df: DataFrame, key: str = "source_id", order: str = "ingest_seq") -> DataFrame:
    """First row of every id in input order.

    Spark limits each id to one row before the exchange and again after it, so
    an id that holds a third of all rows sends one row per map task.
    """
    place = Window.partitionBy(key).orderBy(order)
    return df.withColumn("_place", F.row_number().over(place)).filter("_place = 1").drop("_place")


def clean(df: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Filters, first copy of each id, then value repairs.

    The filters run before deduplication: a spam first copy does not hide a
    good second one. The repairs do not touch the id, so they may follow.
    """
    kept = drop_unusable(df, min_confidence)
    if "source_id" in kept.columns:
        kept = first_per_id(kept)
    changes: dict[str, Column] = {}
    if "reviewer_rating" in kept.columns:
        changes["reviewer_rating"] = F.when(F.col("reviewer_rating").between(1.0, 5.0), F.col("reviewer_rating"))
    if "sentiment_score" in kept.columns:
        changes["sentiment_score"] = clip(F.col("sentiment_score"), -1.0, 1.0)
    for name in LABEL_COLUMNS:
        if name in kept.columns:
            changes[name] = F.lower(strip(F.col(name)))
    if "product_name" in kept.columns:
        name = strip(F.col("product_name"))
        changes["product_name"] = F.when(name.isin("", "nan") | name.isNull(), UNKNOWN_PRODUCT).otherwise(name)
    return kept.withColumns(changes) if changes else kept


def removal_audit(df: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rows removed per cleaning step, with the share of all rows: one pass.

    Survivors are first counted per id, which both partial-aggregates a hot id
    and yields the duplicates (rows beyond the first) without a distinct.
    """
    step = _removal_step(df.columns, min_confidence)
    per_id = (
        df.select(step.alias("step"), "source_id")
        .groupBy("step", F.when(F.col("step").isNull(), F.col("source_id")).alias("id"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("initial"),
        *[
            F.coalesce(F.sum(F.when(F.col("step") == name, F.col("n"))), F.lit(0)).alias(name)
            for name in ("spam", "low_confidence", "null_critical")
        ],
        F.coalesce(F.sum(F.when(F.col("step").isNull(), F.col("n") - 1)), F.lit(0)).alias("duplicate"),
    )
    steps = ("spam", "low_confidence", "null_critical", "duplicate")
    removed = sum((F.col(name) for name in steps[1:]), F.col(steps[0]))
    named = [F.struct(F.lit(name).alias("step"), F.col(name).alias("removed")) for name in steps]
    named.append(F.struct(F.lit("total").alias("step"), removed.alias("removed")))
    return totals.select("initial", F.inline(F.array(*named))).withColumn(
        "removed_share", F.coalesce(F.try_divide(F.col("removed"), F.col("initial")), F.lit(0.0))
    )
