"""The KPI document: everything the summary holds, from one pass over the reviews.

Each clean row is expanded into small facts - one for the totals, one per
label column, topic, competitor and period - and a single grouped aggregate
counts them all. Only that aggregate is shuffled; it has one row per distinct
label, topic, competitor and period. The document is then assembled from it
without joining anything back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.functions.numeric import not_nan, round_exact, round_scaled, steady_mean
from opinara.functions.text import strip
from opinara.operators.kpi import DISTRIBUTIONS, NO_COMPETITOR, TOP_N, list_items
from opinara.operators.series import ALERT_METRICS, MIN_DATED_ROWS, period_label, with_alerts
from opinara.schemas import ANOMALY, SERIES

_TOPIC, _COMPETITOR, _PERIOD, _TOTAL, _SPAM = "topic", "competitor", "period", "total", "spam"


def summarize(
    clean: DataFrame,
    raw: DataFrame | None = None,
    granularity: str = "day",
    top_n: int = TOP_N,
    report_id: str | None = None,
    now: Column | None = None,
) -> DataFrame:
    """One-row summary of a clean table with its ``top_n`` topics and competitors; ``raw`` is where spam is counted.

    Without a ``report_id`` it gets a random one; the report of nothing is called "empty".
    """
    facts = _facts(clean, granularity)
    if raw is not None and "is_spam_or_fake" in raw.columns:
        spam = raw.filter(F.coalesce(F.col("is_spam_or_fake"), F.lit(False)))
        facts = facts.unionByName(
            spam.select(F.lit(_SPAM).alias("section"), F.lit("").alias("key")), allowMissingColumns=True
        )
    document = _document(_mark_alerts(_keep_top(_count(facts), top_n)))
    name = F.lit(report_id) if report_id else F.uuid()
    return document.withColumns({
        "report_id": F.when(F.col("total_reviews_analyzed") == 0, "empty").otherwise(name),
        "generated_at": F.current_timestamp() if now is None else now,
    })


def _facts(df: DataFrame, granularity: str) -> DataFrame:
    def one(section: str, key: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), key.cast("string").alias("key"))

    def many(section: str, keys: Column, keep) -> Column:
        kept = F.filter(F.transform(F.coalesce(keys, F.array().cast("array<string>")), strip), keep)
        return F.transform(kept, lambda key: one(section, key))

    columns = df.columns
    parts = [F.array(one(_TOTAL, F.lit("")))]
    parts += [
        F.array(one(name, F.col(name))) for name in DISTRIBUTIONS if name in columns
    ]
    if "review_date" in columns:
        parts.append(F.array(one(_PERIOD, period_label(F.col("review_date"), granularity))))
    if "key_topics" in columns or "key_topics_str" in columns:
        parts.append(many(_TOPIC, list_items(df, "key_topics", "key_topics_str"), lambda t: t != ""))
    if "mentioned_competitors" in columns or "competitors_str" in columns:
        names = list_items(df, "mentioned_competitors", "competitors_str")
        parts.append(many(_COMPETITOR, names, lambda c: ~c.isin(*NO_COMPETITOR)))

    def column(name: str, kind: str) -> Column:
        return (F.col(name) if name in columns else F.lit(None)).cast(kind).alias(name)

    def flag(name: str, condition: Column) -> Column:
        return condition if name in columns else F.lit(False)

    # Labels are judged once per review; every fact carries the small results.
    label = F.lower(F.col("sentiment")) if "sentiment" in columns else F.lit("")
    return df.select(
        F.explode(F.concat(*parts)).alias("fact"),
        *[column(name, "double") for name in _NUMBERS],
        flag("source_id", F.col("source_id").isNotNull()).alias("has_id"),
        flag("sentiment", label == "negative").alias("negative"),
        flag("sentiment", label == "positive").alias("positive"),
        flag("data_quality", F.col("data_quality") == "high").alias("high_quality"),
        flag("action_required", F.col("action_required")).alias("actions"),
        flag("urgency_level", F.col("urgency_level") == "critical").alias("critical"),
        flag("urgency_level", F.col("urgency_level") == "high").alias("high"),
    ).select("fact.section", "fact.key", *_NUMBERS, *_FLAGS).filter("key IS NOT NULL")


_NUMBERS = ("sentiment_score", "confidence_score", "reviewer_rating")
_FLAGS = ("has_id", "negative", "positive", "high_quality", "actions", "critical", "high")


def _count(facts: DataFrame) -> DataFrame:
    rows = F.count(F.lit(1))

    def mean(name: str) -> Column:
        return steady_mean(not_nan(F.col(name)))

    return facts.groupBy("section", "key").agg(
        rows.alias("n"),
        F.count_if("has_id").alias("ids"),
        mean("sentiment_score").alias("score"),
        mean("confidence_score").alias("confidence"),
        mean("reviewer_rating").alias("rating"),
        (F.count_if("negative") / rows).alias("negative"),
        (F.count_if("positive") / rows).alias("positive"),
        *[F.count_if(name).alias(name) for name in ("high_quality", "actions", "critical", "high")],
    )


def _keep_top(counted: DataFrame, top_n: int) -> DataFrame:
    """The first topics and competitors; all rows of the other sections.

    Every row of an unlimited section is a group of its own, so one rank limit
    serves all and Spark applies it before the exchange.
    """
    limited = F.col("section").isin(_TOPIC, _COMPETITOR)
    group = F.when(limited, F.lit("")).otherwise(F.col("key"))
    place = Window.partitionBy("section", group).orderBy(F.desc("n"), F.asc("key"))
    return counted.withColumn("place", F.row_number().over(place)).filter(F.col("place") <= top_n)


def _mark_alerts(rows: DataFrame) -> DataFrame:
    """Series columns and alerts on the period rows (a handful per calendar year)."""
    is_period = F.col("section") == _PERIOD
    series = rows.withColumns({
        "period": F.when(is_period, F.col("key")),
        "avg_sentiment": F.when(is_period, round_scaled(F.col("score"), 4)),
        "review_count": F.when(is_period, F.col("ids")),
        "avg_rating": F.when(is_period, round_scaled(F.col("rating"), 2)),
        "negative_rate": F.when(is_period, round_scaled(F.col("negative"), 4)),
        "positive_rate": F.when(is_period, round_scaled(F.col("positive"), 4)),
    })
    scope = Window.partitionBy("section")
    # Outside the period rows the metrics are null and raise no alert.
    return with_alerts(series, ALERT_METRICS, scope).withColumns({
        "alerts": F.array_compact("alerts"), "_section_rows": F.sum("n").over(scope),
    })


def _document(rows: DataFrame) -> DataFrame:
    section = F.col("section")
    total = section == _TOTAL

    def scalar(value: str) -> Column:
        return F.max(F.when(total, F.col(value)))

    def counts_of(name: str) -> Column:
        entry = F.struct((-F.col("n")).alias("fall"), F.col("key").alias("key"))
        listed = F.array_sort(F.collect_list(F.when(section == name, entry)))
        return F.map_from_entries(
            F.transform(listed, lambda e: F.struct(e["key"].alias("key"), (-e["fall"]).alias("value")))
        )

    topic = F.struct("place", F.struct(
        F.col("key").alias("topic"), F.col("n").alias("count"), round_exact(F.col("score"), 3).alias("avg_sentiment"),
    ).alias("item"))
    listed = (section == _PERIOD) & (F.col("_section_rows") >= MIN_DATED_ROWS)
    point = F.struct(*SERIES.names)
    alert_type = F.array().cast(f"array<{ANOMALY.simpleString()}>")
    alerts = F.flatten(F.coalesce(F.collect_list(F.when(listed, F.col("alerts"))), F.array(alert_type)))

    document = rows.agg(
        F.coalesce(scalar("n"), F.lit(0)).alias("total_reviews_analyzed"),
        F.coalesce(scalar("high_quality"), F.lit(0)).alias("high_quality_reviews"),
        F.coalesce(F.max(F.when(section == _SPAM, F.col("n"))), F.lit(0)).alias("spam_excluded"),
        counts_of("sentiment").alias("sentiment_distribution"),
        scalar("score").alias("average_sentiment_score"),
        scalar("rating").alias("average_rating"),
        scalar("confidence").alias("average_confidence"),
        counts_of("product_category").alias("category_distribution"),
        F.coalesce(scalar("actions"), F.lit(0)).alias("action_required_count"),
        F.coalesce(scalar("critical"), F.lit(0)).alias("critical_urgency_count"),
        F.coalesce(scalar("high"), F.lit(0)).alias("high_urgency_count"),
        F.transform(
            F.array_sort(F.collect_list(F.when(section == _TOPIC, topic))), lambda t: t["item"]
        ).alias("top_topics"),
        counts_of(_COMPETITOR).alias("competitor_mentions"),
        counts_of("data_quality").alias("data_quality_distribution"),
        counts_of("language_detected").alias("language_distribution"),
        F.array_sort(F.collect_list(F.when(listed, point))).alias("time_series_data"),
        alerts.alias("_alerts"),
    ).withColumns({
        "average_sentiment_score": F.coalesce(round_exact(F.col("average_sentiment_score"), 4), F.lit(0.0)),
        "average_rating": round_exact(F.col("average_rating"), 2),
        "average_confidence": F.coalesce(round_exact(F.col("average_confidence"), 4), F.lit(0.0)),
    })

    def alerts_on(metric: str) -> Column:
        return F.array_sort(F.filter("_alerts", lambda alert: alert["metric"] == metric))

    by_metric = F.flatten(F.array(*[alerts_on(metric) for metric in ALERT_METRICS]))
    empty = F.col("total_reviews_analyzed") == 0
    return (
        document.withColumn("anomaly_details", by_metric)
        .withColumn("anomaly_detected", F.size("anomaly_details") > 0)
        # A summary of nothing reports nothing, spam included.
        .withColumn("spam_excluded", F.when(empty, F.lit(0)).otherwise(F.col("spam_excluded")))
        .drop("_alerts")
    )
