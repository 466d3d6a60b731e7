from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from opinara.session import build_session  # noqa: E402

SUMMARY = "A fixed summary text for tests."


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("opinara-tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df):
    return [row.asDict(recursive=True) for row in df.collect()]


def review(seq, source_id, sentiment, score, confidence, **more):
    base = {
        "ingest_seq": seq, "source_id": source_id, "product_name": "Test Product Alpha", "sentiment": sentiment,
        "sentiment_score": score, "confidence_score": confidence, "summary": SUMMARY, "reviewer_rating": None,
        "urgency_level": "low", "review_date": None, "key_topics": [], "is_spam_or_fake": False,
    }
    return base | more


REVIEW_SCHEMA = (
    "ingest_seq long, source_id string, product_name string, sentiment string, sentiment_score double, "
    "confidence_score double, summary string, reviewer_rating double, urgency_level string, review_date timestamp, "
    "key_topics array<string>, is_spam_or_fake boolean"
)


def frame(spark, records):
    names = [part.split()[0] for part in REVIEW_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(record[name] for name in names) for record in records], REVIEW_SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    day = lambda d: datetime(2024, 3, d)
    return frame(spark, [
        review(1, "r1", "positive", 0.85, 0.92, reviewer_rating=5.0, review_date=day(10), key_topics=["battery", "sound"]),
        review(2, "r2", "negative", -0.70, 0.88, reviewer_rating=2.0, review_date=day(10), key_topics=["sound", "price"]),
        review(3, "r3", "negative", -0.90, 0.95, reviewer_rating=1.0, urgency_level="critical", review_date=day(11)),
        review(4, "r4", "positive", 0.60, 0.78, reviewer_rating=4.0, review_date=day(12), key_topics=["battery"]),
        review(5, "r5", "neutral", 0.0, 0.65, review_date=day(12)),
    ])
