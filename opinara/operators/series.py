"""Daily and weekly series, and z-score alerts on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from opinara.functions.numeric import not_nan, round_exact, round_scaled, steady_mean
from opinara.schemas import ANOMALY, SERIES

# Fixed values.
Z_THRESHOLD = 2.0
MIN_DATED_ROWS = 2
MIN_PERIODS_FOR_Z = 3
FLAT_STD = 1e-9
ALERT_METRICS = ("negative_rate", "avg_sentiment")
REPORT_PERIODS = 5
_SERIES_DIGITS = {"avg_sentiment": 4, "avg_rating": 2, "negative_rate": 4, "positive_rate": 4}


def period_label(moment: Column, granularity: str = "day") -> Column:
    """``YYYY-MM-DD``, or the Monday/Sunday span of the week."""
    if granularity == "week":
        monday = F.to_date(F.date_trunc("week", moment))
        return F.concat(_day(monday), F.lit("/"), _day(F.date_add(monday, 6)))
    return _day(moment)


def _day(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd")


def time_series(df: DataFrame, granularity: str = "day") -> DataFrame:
    """SERIES rows in period order; empty when fewer than two rows have a date.

    Rows collapse to one per period before anything is shuffled. The floor
    counts rows, not periods, so it is summed over the finished periods.
    """
    if "review_date" not in df.columns:
        return df.sparkSession.createDataFrame([], SERIES)
    label = F.lower(F.col("sentiment"))
    rating = steady_mean(not_nan(F.col("reviewer_rating"))) if "reviewer_rating" in df.columns else F.lit(None)
    periods = (
        df.filter(F.col("review_date").isNotNull())
        .groupBy(period_label(F.col("review_date"), granularity).alias("period"))
        .agg(
            steady_mean(F.col("sentiment_score")).alias("avg_sentiment"),
            F.count("source_id").alias("review_count"),
            rating.cast("double").alias("avg_rating"),
            (F.count_if(label == "negative") / F.count(F.lit(1))).alias("negative_rate"),
            (F.count_if(label == "positive") / F.count(F.lit(1))).alias("positive_rate"),
            F.count(F.lit(1)).alias("_rows"),
        )
        .withColumns({name: round_scaled(F.col(name), digits) for name, digits in _SERIES_DIGITS.items()})
    )
    # One row per calendar period is left here, so an unpartitioned window is small.
    dated = F.sum("_rows").over(Window.partitionBy())
    return (
        periods.withColumn("_dated", dated)
        .filter(F.col("_dated") >= MIN_DATED_ROWS)
        .select(*SERIES.names)
        .orderBy("period")
    )


def last_periods(series: DataFrame, n: int = REPORT_PERIODS) -> DataFrame:
    """The ``n`` latest periods, oldest first."""
    return series.orderBy(F.desc("period")).limit(n).orderBy("period")


def with_alerts(
    series: DataFrame, metrics: Sequence[str], scope: WindowSpec, threshold: float = Z_THRESHOLD
) -> DataFrame:
    """Add ``alerts``: per metric an ANOMALY struct, null where it is unremarkable.

    Mean and deviation are those of the whole series (``scope``).
    """
    statistics, scores, alerts = {}, {}, []
    for metric in metrics:
        value = F.col(metric).cast("double")
        mean, std, count, score = (f"_{part}_{metric}" for part in ("mean", "std", "count", "score"))
        statistics |= {
            mean: F.avg(value).over(scope),
            std: F.stddev_samp(value).over(scope),
            count: F.count(value).over(scope),
        }
        scores[score] = (value - F.col(mean)) / F.when(F.col(std) >= FLAT_STD, F.col(std))
        alert = F.struct(
            F.col("period").alias("period"),
            F.lit(metric).alias("metric"),
            round_exact(value, 4).alias("value"),
            round_exact(F.col(score), 3).alias("z_score"),
            severity(F.col(score)).alias("severity"),
            round_exact(F.col(mean), 4).alias("mean"),
            round_exact(F.col(std), 4).alias("std"),
        )
        striking = (F.col(count) >= MIN_PERIODS_FOR_Z) & (F.abs(F.col(score)) > threshold)
        alerts.append(F.when(striking, alert))
    scored = series.withColumns(statistics).withColumns(scores)
    return scored.withColumn("alerts", F.array(*alerts)).drop(*statistics, *scores)


def severity(score: Column) -> Column:
    size = F.abs(score)
    return F.when(size > 3.0, "critical").when(size > 2.5, "high").otherwise("medium")


def detect_anomalies(
    series: DataFrame,
    metrics: Sequence[str] = ALERT_METRICS,
    threshold: float = Z_THRESHOLD,
) -> DataFrame:
    """ANOMALY rows, by metric in the given order, then period.

    The series holds one row per calendar period, so its global statistics are
    a window over a small table; joining them back would compute it twice.
    """
    present = [name for name in metrics if name in series.columns]
    if not present:
        return series.sparkSession.createDataFrame([], ANOMALY)
    scope = Window.partitionBy()
    found = with_alerts(series, present, scope, threshold).select(
        F.posexplode("alerts").alias("_order", "alert")
    )
    return (
        found.filter(F.col("alert").isNotNull())
        .orderBy("_order", "alert.period")
        .select("alert.*")
    )


def anomaly_flag(alerts: DataFrame) -> DataFrame:
    return alerts.agg((F.count(F.lit(1)) > 0).alias("anomaly_detected"))
