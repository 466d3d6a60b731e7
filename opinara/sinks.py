"""Exports: column choice, JSON and CSV renderings, KPI tables, run folders."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.functions.numeric import round_exact, round_scaled
from opinara.operators.kpi import percent

log = logging.getLogger(__name__)

# Exported columns in order.
EXPORT_COLUMNS = (
    "source_id", "product_name", "product_category", "sentiment", "sentiment_score",
    "confidence_score", "reviewer_rating", "urgency_level", "action_required", "action_notes",
    "summary", "key_topics_str", "pros_str", "cons_str", "is_verified_purchase",
    "reviewer_expertise", "mentioned_competitors", "language_detected", "data_quality",
    "is_spam_or_fake", "analyzed_at",
)
BASE_NAME = "reviews_analysis"

# Row labels of the KPI table.
KPI_LABELS = {
    "total_reviews_analyzed": "Toplam Analiz Edilen Yorum",
    "high_quality_reviews": "Yüksek Kaliteli Kayıt",
    "spam_excluded": "Spam/Sahte Filtrelenen",
    "average_sentiment_score": "Ortalama Sentiment Skoru",
    "average_rating": "Ortalama Müşteri Puanı",
    "average_confidence": "Ortalama AI Güven Skoru",
    "action_required_count": "Aksiyon Gerektiren Kayıt",
    "critical_urgency_count": "CRITICAL Öncelikli",
    "high_urgency_count": "HIGH Öncelikli",
}


def export_projection(df: DataFrame) -> DataFrame:
    """The exported columns that exist, in their order."""
    return df.select(*[name for name in EXPORT_COLUMNS if name in df.columns])


def json_records(df: DataFrame) -> DataFrame:
    """Export rows for a JSON writer: null as "", times as text.

    A field may hold a number in one row and "" in the next, hence VARIANT.
    """
    export = export_projection(df)
    blank = F.parse_json(F.lit('""'))

    def render(field: T.StructField) -> Column:
        value = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return value
        if isinstance(field.dataType, T.TimestampType):
            value = _time_text(value)
        return F.coalesce(value.cast("variant"), blank).alias(field.name)

    return export.select(*[render(field) for field in export.schema.fields])


def csv_records(df: DataFrame) -> DataFrame:
    """Export rows as text: four decimals, True/False, pipe-joined lists."""
    export = export_projection(df)

    def render(field: T.StructField) -> Column:
        value, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.ArrayType):
            value = F.array_join(value, "|")
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            value = F.when(value.isNotNull(), F.format_string("%.4f", round_scaled(value, 4)))
        elif isinstance(kind, T.BooleanType):
            value = F.initcap(value.cast("string"))
        elif isinstance(kind, T.TimestampType):
            value = _time_text(value)
        return value.cast("string").alias(field.name)

    return export.select(*[render(field) for field in export.schema.fields])


def _time_text(moment: Column) -> Column:
    """``2024-03-10 08:00:00+00:00``, with microseconds when there are any."""
    text = F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(text, r"\.000000$", ""), F.lit("+00:00"))


def join_lists(df: DataFrame) -> DataFrame:
    """Every list column as pipe-joined text."""
    lists = [field.name for field in df.schema.fields if isinstance(field.dataType, T.ArrayType)]
    return df.withColumns({name: F.coalesce(F.array_join(name, "|"), F.lit("")) for name in lists}) if lists else df


def humanize(name: str) -> str:
    """Column name as a heading."""
    return name.replace("_", " ").replace("str", "").title().strip()


def with_headings(df: DataFrame) -> DataFrame:
    return df.toDF(*[humanize(name) for name in df.columns])


def title_case(text: Column) -> Column:
    return F.initcap(F.replace(text, F.lit("_"), F.lit(" ")))


def kpi_table(summary: DataFrame) -> DataFrame:
    """(position, label, value) rows of a one-row summary, values as text."""
    total = F.greatest(F.col("total_reviews_analyzed"), F.lit(1))
    values = {name: F.col(name).cast("string") for name in KPI_LABELS}
    values["average_sentiment_score"] = F.format_string("%+.4f", "average_sentiment_score")
    # A rating of zero cannot occur, so only a missing one prints N/A.
    values["average_rating"] = F.when(
        F.col("average_rating").isNotNull(), F.format_string("%.2f/5.0", "average_rating")
    ).otherwise("N/A")
    values["average_confidence"] = percent(F.col("average_confidence"))

    def row(label: Column, value: Column) -> Column:
        return F.struct(label.alias("label"), value.alias("value"))

    fixed = F.array(*[row(F.lit(label), values[name]) for name, label in KPI_LABELS.items()])
    sentiments = F.transform(
        F.map_entries("sentiment_distribution"),
        lambda e: row(
            F.initcap(e["key"]),
            F.concat(e["value"].cast("string"), F.lit(" ("), percent(e["value"] / total), F.lit(")")),
        ),
    )
    categories = F.transform(
        F.map_entries("category_distribution"), lambda e: row(title_case(e["key"]), e["value"].cast("string"))
    )
    return summary.select(F.posexplode(F.concat(fixed, sentiments, categories)).alias("position", "row")).select(
        "position", "row.label", "row.value"
    )


def sentiment_table(summary: DataFrame) -> DataFrame:
    """(sentiment, count, share) rows of a one-row summary."""
    total = F.greatest(F.col("total_reviews_analyzed"), F.lit(1))
    return summary.select(total.alias("total"), F.explode("sentiment_distribution").alias("label", "count")).select(
        F.initcap("label").alias("sentiment"), "count", round_exact(F.col("count") / F.col("total"), 4).alias("share")
    )


# --- writing -------------------------------------------------------------------

def output_name(base: str, extension: str, moment: datetime | None = None) -> str:
    """``base_YYYYMMDD_HHMMSS.ext`` in UTC, or ``base.ext`` without a moment."""
    stamp = f"_{moment.astimezone(timezone.utc):%Y%m%d_%H%M%S}" if moment else ""
    return f"{base}{stamp}.{extension}"


def write_json(clean: DataFrame, summary: DataFrame, path: str) -> str:
    """Folder with ``records``, ``summary`` and ``meta``; records stay distributed."""
    json_records(clean).write.mode("overwrite").json(f"{path}/records")
    summary.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/summary")
    # Two rows, folded into one.
    both = clean.agg(F.count(F.lit(1)).alias("total_records")).unionByName(
        summary.select([name for name in ("report_id",) if name in summary.columns]), allowMissingColumns=True
    )
    meta = both.agg(*[F.max(name).alias(name) for name in both.columns]).withColumn(
        "exported_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    )
    meta.write.mode("overwrite").json(f"{path}/meta")
    return path


def write_csv(clean: DataFrame, summary: DataFrame, path: str) -> str:
    csv_records(clean).write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="")
    return path


def write_kpi(clean: DataFrame, summary: DataFrame, path: str) -> str:
    """The two report tables; one row per label, hence one file each."""
    kpi_table(summary).orderBy("position").coalesce(1).write.mode("overwrite").csv(f"{path}/kpi", header=True)
    sentiment_table(summary).coalesce(1).write.mode("overwrite").csv(f"{path}/sentiment", header=True)
    return path


Writer = Callable[[DataFrame, DataFrame, str], str]
WRITERS: dict[str, Writer] = {
    "json": write_json,
    "csv": write_csv,
    "kpi": write_kpi,
}


def export_all(
    clean: DataFrame,
    summary: DataFrame,
    folder: str,
    formats: Sequence[str] = ("json", "csv"),
    moment: datetime | None = None,
    writers: Mapping[str, Writer] | None = None,
) -> dict[str, str | None]:
    """Path per format, None where writing failed; one failure stops no other.

    The formats are written side by side, so that the small ones fill the slots
    the large ones leave. Each job carries the tag ``export-<format>``. Give
    stored tables: every format reads them. A repeated format is written once,
    an unknown one counts as failed. ``writers`` adds to or replaces WRITERS.
    """
    spark, known = clean.sparkSession, {**WRITERS, **(writers or {})}

    def write(name: str) -> str:
        tag = f"export-{name}"
        spark.addTag(tag)
        try:
            return known[name](clean, summary, f"{folder}/{output_name(BASE_NAME, name, moment)}")
        finally:
            spark.removeTag(tag)

    wanted = list(dict.fromkeys(formats))
    paths: dict[str, str | None] = {}
    with ThreadPoolExecutor(max(len(wanted), 1)) as pool:
        # Wrapped one by one: each call gets its own copy of the caller's local properties.
        started = {name: pool.submit(inheritable_thread_target(spark)(write), name) for name in wanted}
        for name, done in started.items():
            try:
                paths[name] = done.result()
            except Exception:
                log.exception("export %s failed", name)
                paths[name] = None
    return paths
