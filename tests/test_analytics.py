import pytest
from conftest import frame, review, rows

from opinara.operators import cleaning, kpi, series
from opinara.operators.rules import check_analyzed
from opinara.plans.jobs import analytics
from opinara.schemas import SERIES
from opinara.sinks import kpi_table

POINTS = "period string, negative_rate double, avg_sentiment double"


def points(spark, values):
    return spark.createDataFrame([(f"2024-01-{i + 1:03d}", n, s) for i, (n, s) in enumerate(values)], POINTS)


def test_cleaning_rules(spark):
    got = rows(cleaning.clean(cleaning.flatten(frame(spark, [
        review(1, "s1", "positive", 0.9, 0.95, is_spam_or_fake=True),
        review(2, "s2", "negative", -0.5, 0.30),
        review(3, "s3", " Neutral ", 0.0, 0.80, product_name="nan"),
        review(4, "edge", "mixed", 3.0, 0.50, reviewer_rating=6.0),
        review(5, "unsure", "mixed", -0.1, None),
        review(6, "notext", None, 0.1, 0.9),
        review(7, "dup", "positive", 0.8, 0.9, is_spam_or_fake=True),
        review(8, "dup", "positive", 0.7, 0.9),
        review(9, "dup", "negative", -0.5, 0.85),
    ]))))
    by_id = {r["source_id"]: r for r in got}
    assert set(by_id) == {"s3", "edge", "unsure", "dup"}
    assert (by_id["s3"]["sentiment"], by_id["s3"]["product_name"]) == ("neutral", "Unknown")
    assert (by_id["edge"]["sentiment_score"], by_id["edge"]["reviewer_rating"]) == (1.0, None)
    assert by_id["dup"]["ingest_seq"] == 8


def test_removal_audit(spark):
    df = frame(spark, [
        review(1, "a", "positive", 0.5, 0.9), review(2, "a", "positive", 0.5, 0.9), review(3, "a", "positive", 0.5, 0.9),
        review(4, "b", "positive", 0.5, 0.2), review(5, "c", None, 0.5, 0.9), review(6, "d", None, 0.5, 0.2, is_spam_or_fake=True),
    ])
    got = {r["step"]: (r["removed"], r["initial"]) for r in rows(cleaning.removal_audit(df))}
    assert got == {"spam": (1, 6), "low_confidence": (1, 6), "null_critical": (1, 6), "duplicate": (2, 6), "total": (5, 6)}
    assert {r["removed"] for r in rows(cleaning.removal_audit(df.limit(0)))} == {0}


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_first_copy_for_any_partitioning(spark, parts):
    df = frame(spark, [review(i, "hot" if i % 3 else f"x{i}", "positive", i / 1000, 0.9) for i in range(1, 300)])
    got = {r["source_id"]: r["ingest_seq"] for r in rows(cleaning.clean(df.repartition(parts)))}
    assert got["hot"] == 1 and len(got) == 100


def test_day_and_week_series(spark, sample):
    flat = cleaning.clean(cleaning.flatten(sample))
    day = [tuple(r.values()) for r in rows(series.time_series(flat))]
    assert day == [
        ("2024-03-10", 0.075, 2, 3.5, 0.5, 0.5), ("2024-03-11", -0.9, 1, 1.0, 1.0, 0.0), ("2024-03-12", 0.3, 2, 4.0, 0.0, 0.5),
    ]
    week = [tuple(r.values()) for r in rows(series.time_series(flat, "week"))]
    assert week == [
        ("2024-03-04/2024-03-10", 0.075, 2, 3.5, 0.5, 0.5), ("2024-03-11/2024-03-17", -0.1, 3, 2.5, 0.3333, 0.3333),
    ]
    assert series.time_series(flat).schema.names == SERIES.names


def test_series_needs_two_dated_rows(spark, sample):
    assert series.time_series(sample.filter("source_id = 'r3'")).count() == 0
    assert series.time_series(sample.filter("source_id IN ('r1', 'r2')")).count() == 1
    assert series.time_series(sample.drop("review_date")).count() == 0


def test_anomalies(spark):
    assert series.detect_anomalies(points(spark, [(0.1, 0.5), (0.9, -0.9)])).count() == 0
    assert series.detect_anomalies(points(spark, [(0.1, 0.5)] * 7)).count() == 0
    spike = rows(series.detect_anomalies(points(spark, [(0.1, 0.5)] * 7 + [(0.95, -0.9)])))
    assert [(a["metric"], a["severity"], abs(a["z_score"])) for a in spike] == [
        ("negative_rate", "medium", 2.475), ("avg_sentiment", "medium", 2.475),
    ]
    high = rows(series.detect_anomalies(points(spark, [(0.0, 0.0)] * 99 + [(100.0, 0.0)])))
    assert [(a["mean"], a["std"], a["z_score"], a["severity"]) for a in high] == [(1.0, 10.0, 9.9, "critical")]
    assert series.anomaly_flag(series.detect_anomalies(points(spark, [(0.1, 0.5)] * 7))).first()[0] is False


def test_topics_and_scalars(spark, sample):
    flat = cleaning.clean(cleaning.flatten(check_analyzed(sample)))
    assert [tuple(r.values()) for r in rows(kpi.top_topics(flat))] == [("battery", 2, 0.725), ("sound", 2, 0.075), ("price", 1, -0.7)]
    assert rows(kpi.top_topics(flat.drop("key_topics"))) == rows(kpi.top_topics(flat))
    scalars = rows(kpi.scalar_kpis(flat))[0]
    assert (scalars["total_reviews_analyzed"], scalars["average_sentiment_score"]) == (5, -0.03)
    assert (scalars["average_rating"], scalars["average_confidence"]) == (3.0, 0.836)
    assert (scalars["action_required_count"], scalars["critical_urgency_count"], scalars["high_urgency_count"]) == (2, 1, 1)


@pytest.mark.parametrize("granularity", ["day", "week"])
def test_summary_agrees_with_the_single_operators(spark, sample, granularity):
    kept, summary = analytics(check_analyzed(sample).drop("errors"), granularity)
    document = rows(summary)[0]
    for name, value in rows(kpi.scalar_kpis(kept))[0].items():
        assert document[name] == value, name
    assert document["top_topics"] == rows(kpi.top_topics(kept))
    assert document["time_series_data"] == rows(series.time_series(kept, granularity))
    assert document["anomaly_details"] == rows(series.detect_anomalies(series.time_series(kept, granularity)))
    assert document["sentiment_distribution"] == {"negative": 2, "positive": 2, "neutral": 1}
    assert [r["label"].strip() for r in rows(kpi_table(summary))][-4:] == ["Negative", "Positive", "Neutral", "Unknown"]


def test_summary_of_nothing(spark, sample):
    spam = frame(spark, [review(1, "s", "positive", 0.5, 0.9, is_spam_or_fake=True)])
    document = rows(analytics(spam).summary)[0]
    assert document["total_reviews_analyzed"] == 0 and document["spam_excluded"] == 0
    assert document["average_rating"] is None and document["average_sentiment_score"] == 0.0
    assert document["top_topics"] == [] and document["sentiment_distribution"] == {} and not document["anomaly_detected"]
