import json

from conftest import SUMMARY, frame, review, rows
from pyspark.sql import functions as F

from opinara.operators.intake import check_raw, split_valid
from opinara.operators.prompts import parse_replies, unfence
from opinara.operators.rules import check_analyzed, is_object
from opinara.schemas import RAW, REJECT

BASE = {
    "source_id": "c1", "product_name": "Thing", "sentiment": "positive", "sentiment_score": 0.5,
    "confidence_score": 0.9, "summary": SUMMARY,
}


def check(spark, *changes):
    """One checked row per change; a value of ... removes the key."""
    payloads = [(i, json.dumps({k: v for k, v in (BASE | c).items() if v is not ...})) for i, c in enumerate(changes)]
    df = spark.createDataFrame(payloads, "i int, text string").select("i", F.parse_json("text").alias("payload"))
    return sorted(rows(check_analyzed(df, payload="payload")), key=lambda r: r["i"])


def test_raw_contract(spark):
    data = [
        (1, "", "long enough text"), (2, "   ", "long enough text"), (3, "  comment_42  ", "  long enough text  "),
        (4, "a", "Too short"), (5, "a", "1234567890"), (6, None, None),
    ]
    checked = check_raw(spark.createDataFrame(data, "ingest_seq long, source_id string, raw_text string"))
    good, bad = split_valid(checked, "raw")
    assert sorted((r["source_id"], r["raw_text"]) for r in rows(good)) == [("a", "1234567890"), ("comment_42", "long enough text")]
    assert good.columns == RAW.names and bad.columns == REJECT.names
    assert bad.count() == 4
    assert {r["rule"] for r in rows(bad)} == {"source_id_empty", "raw_text_short", "source_id_empty,raw_text_short"}


def test_rating(spark):
    cases = [
    (1.0, 1.0), (2.5, 2.5), (5.0, 5.0), (4.35, 4.3), (0.0, None), (0.5, None), (5.1, None), (-1.0, None), (None, None),
    ("4.5", 4.5), ("many", None), ("nan", None), ([4], None), (True, 1.0),
]
    got = check(spark, *[{"reviewer_rating": value} for value, _ in cases])
    assert [r["reviewer_rating"] for r in got] == [expected for _, expected in cases]
    assert all(r["errors"] == [] for r in got)


def test_confidence(spark):
    cases = [
    (0.0, 0.0), (0.5, 0.5), (1.0, 1.0), (92.0, 0.92), ("88", 0.88), (150.0, None), (-0.1, None), (None, None), (..., None),
]
    got = check(spark, *[{"confidence_score": value} for value, _ in cases])
    assert [r["confidence_score"] for r in got] == [expected for _, expected in cases]
    assert [r["errors"] for r in got] == [["confidence_score"] if expected is None else [] for _, expected in cases]


def test_score(spark):
    cases = [(-2.0, -1.0), (1.5, 1.0), (0.12345, round(0.12345, 4)), ("0.25", 0.25), ("nan", None), (None, None)]
    got = check(spark, *[{"sentiment_score": value} for value, _ in cases])
    assert [r["sentiment_score"] for r in got] == [expected for _, expected in cases]
    assert [r["errors"] for r in got] == [["sentiment_score"] if expected is None else [] for _, expected in cases]


def test_lists_language_expertise(spark):
    got = check(
        spark,
        {"key_topics": "battery, sound, design", "language_detected": " ZH-cn-x ", "reviewer_expertise": " Expert"},
        {"key_topics": None, "language_detected": "", "reviewer_expertise": "wizard"},
        {"key_topics": [" a ", "", 5, None, True], "language_detected": None},
        {"key_topics": {"a": 1}, "language_detected": " e "},
    )
    assert [r["key_topics"] for r in got] == [["battery", "sound", "design"], [], ["a", "5", "None", "True"], []]
    assert [r["language_detected"] for r in got] == ["zh-cn", "en", "en", "e"]
    assert [r["reviewer_expertise"] for r in got][:2] == ["expert", None]
    assert [r["errors"] for r in got] == [[], [], [], ["language_detected"]]


def test_rejections(spark):
    cases = [
    ({"source_id": "  "}, "source_id"), ({"source_id": None}, "source_id"), ({"product_name": ...}, "product_name"),
    ({"product_name": 7}, "product_name"), ({"product_name": "x" * 201}, "product_name"), ({"summary": "short"}, "summary"),
    ({"summary": "x" * 501}, "summary"), ({"sentiment": "Positive"}, "sentiment"), ({"urgency_level": None}, "urgency_level"),
    ({"product_category": "toys"}, "product_category"), ({"action_notes": "x" * 301}, "action_notes"),
    ({"is_spam_or_fake": None}, "is_spam_or_fake"), ({"is_verified_purchase": "maybe"}, "is_verified_purchase"),
    ({"review_date": "yesterday"}, "review_date"), ({"product_id": 5}, "product_id"), ({"analyzed_at": None}, "analyzed_at"),
]
    got = check(spark, *[change for change, _ in cases])
    assert [r["errors"] for r in got] == [[error] for _, error in cases]


def test_defaults_and_flags(spark):
    got = check(spark, {}, {"is_verified_purchase": "yes", "action_required": 1, "source_id": 5, "review_date": "2024-03-10T08:00:00Z"})
    first, second = got
    assert (first["product_category"], first["urgency_level"], first["data_quality"]) == ("unknown", "low", "medium")
    assert (first["action_required"], first["is_spam_or_fake"], first["is_verified_purchase"]) == (False, False, None)
    assert first["key_topics"] == [] and first["review_date"] is None and first["analyzed_at"] is not None
    assert (second["is_verified_purchase"], second["action_required"], second["source_id"]) == (True, True, "5")
    assert second["errors"] == [] and str(second["review_date"]) == "2024-03-10 08:00:00"


def test_business_rules(spark, sample):
    got = {r["source_id"]: r for r in rows(check_analyzed(sample))}
    assert (got["r2"]["urgency_level"], got["r2"]["action_required"]) == ("high", True)
    assert (got["r3"]["urgency_level"], got["r3"]["action_required"]) == ("critical", True)
    assert (got["r1"]["urgency_level"], got["r1"]["action_required"]) == ("low", False)
    spam = frame(spark, [review(1, "s", "positive", 0.5, 0.9, is_spam_or_fake=True)])
    assert rows(check_analyzed(spam))[0]["data_quality"] == "low"


def test_every_row_is_good_or_rejected(spark):
    checked = check_analyzed(frame(spark, [
        review(1, "a", "positive", 0.5, 0.9), review(2, "", "odd", None, 400.0), review(3, "b", "mixed", 3.0, 50.0),
    ]))
    good, bad = split_valid(checked, "analyzed")
    assert (good.count(), bad.count()) == (2, 1)
    assert rows(bad)[0]["rule"] == "source_id,sentiment,sentiment_score,confidence_score"


def test_unfence(spark):
    texts = ["[1]", "```json\n[1]\n```", " ```\n[1]\n  ```  ", "```", "```json\n[1]", "x ```"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(unfence(F.col("t"))).collect()]
    assert got == ["[1]", "[1]", "[1]", "", "[1]", "x ```"]


def test_reply_shapes(spark):
    replies = [
        (1, '[{"source_id": "a"}, "text", 5, {"x": 1}]'), (2, '{"reviews": [{"source_id": 7}]}'), (3, '{"source_id": "solo"}'),
        (4, "not json"), (5, '"text"'), (6, '{"reviews": "none"}'), (7, "[]"),
    ]
    parsed = parse_replies(spark.createDataFrame(replies, "batch_no int, response string"))
    got = sorted((r["batch_no"], r["place"], r["source_id"]) for r in rows(parsed.drop("payload")))
    assert got == [(1, 0, "a"), (1, 3, "unknown"), (2, 0, "7"), (3, 0, "solo")]


def test_numbers_and_times_are_spelled_out(spark):
    from opinara.operators.rules import check_analyzed

    base = {"source_id": "a", "product_name": "P", "sentiment": "neutral", "sentiment_score": "0.5", "confidence_score": "0.9", "summary": "long enough"}
    cases = [{"reviewer_rating": "4d"}, {"reviewer_rating": "4f"}, {"reviewer_rating": " 4.0 "}, {"sentiment_score": "0.5d"}, {"review_date": "12:30"}, {"review_date": "2024-03-10 12:30"}]
    frame = spark.createDataFrame([(i, json.dumps(base | case)) for i, case in enumerate(cases)], "i int, j string").select("i", F.parse_json("j").alias("p"))
    got = {r["i"]: r for r in check_analyzed(frame, payload="p").collect()}
    assert [got[i]["reviewer_rating"] for i in range(3)] == [None, None, 4.0]
    assert got[3]["errors"] == ["sentiment_score"] and got[4]["errors"] == ["review_date"] and got[5]["errors"] == []


def test_payload_is_read_in_one_pass(spark):
    """A reply's kind is told without a schema of all it holds, and its fields come from one pass over it."""
    texts = ['{"a": 1}', "{}", '{"source_id": null}', "[]", '[{"source_id": "x"}]', '"{}"', "1", "null", "true", None]
    items = spark.createDataFrame([(n, text) for n, text in enumerate(texts)], "n int, text string")
    payloads = items.select("n", F.parse_json("text").alias("payload"))
    found = payloads.select("n", is_object(F.col("payload")).alias("object"))
    assert {row.n for row in found.collect() if row.object} == {0, 1, 2}
    plan = check_analyzed(payloads, payload="payload")._jdf.queryExecution().analyzed().toString()
    assert plan.count("variant_get(payload") == 1, plan
