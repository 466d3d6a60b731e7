import json
import threading
import sys
from datetime import datetime, timezone

import pytest
from conftest import SUMMARY, rows
from pyspark import cloudpickle
from pyspark.sql import functions as F

from opinara import sinks
from opinara.operators.cleaning import clean, flatten
from opinara.operators.enrich import (
    AnalyzerError,
    LexiconAnalyzer,
    PromptAnalyzer,
    create_analyzer,
    register_analyzer,
    run_metrics,
)
from opinara.operators.intake import check_raw, split_valid
from opinara.operators.prompts import parse_replies, reply_rejects
from opinara.operators.rules import check_analyzed
from opinara.schemas import REJECT
from opinara.plans.jobs import EmptyRun, analytics, run

# The calls defined below run in workers that cannot import this file.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def raw(spark, texts):
    data = [(i, f"r{i}", t) for i, t in enumerate(texts)]
    return check_raw(spark.createDataFrame(data, "ingest_seq long, source_id string, raw_text string"))


def record(name, **more):
    return {
        "source_id": name, "product_name": "P", "sentiment": "neutral", "sentiment_score": 0.1,
        "confidence_score": 0.9, "summary": SUMMARY,
    } | more


def _ids(prompt):
    return [part.split("]:")[0] for part in prompt.split("[source_id: ")[1:]]


def _outcome(spark, call, texts, **options):
    good = split_valid(raw(spark, texts), "raw")[0]
    result = PromptAnalyzer(call, "{}", **options).enrich(good)
    return sorted(r["source_id"] for r in rows(result.analyzed)), sorted(r["source_id"] for r in rows(result.failed))


TEXTS = [f"review number {i} with some text" for i in range(6)]


def test_failed_batch_falls_back_to_single_calls(spark):
    def call(prompt):
        if _ids(prompt):
            raise AnalyzerError("rate limit")
        if "number 4" in prompt:
            raise AnalyzerError("again")
        return json.dumps(record("whatever"))

    assert _outcome(spark, call, TEXTS) == (["r0", "r1", "r2", "r3", "r5"], ["r4"])


def test_other_exceptions_stop_the_run(spark):
    def call(prompt):
        raise KeyError("bug")

    with pytest.raises(Exception, match="bug"):
        _outcome(spark, call, TEXTS)


def test_invented_ids_and_invalid_records(spark):
    def call(prompt):
        names = _ids(prompt)
        if not names:
            return json.dumps(record("x", sentiment="odd"))
        return json.dumps([record(n, **({"summary": "bad"} if n == "r1" else {})) for n in names] + [record("ghost")])

    assert _outcome(spark, call, TEXTS) == (["ghost", "r0", "r2", "r3", "r4", "r5"], ["r1"])
    assert _outcome(spark, call, TEXTS, drop_unknown=True)[0] == ["r0", "r2", "r3", "r4", "r5"]


def test_copies_in_a_batch_share_an_answer(spark):
    def call(prompt):
        return json.dumps([record(n) for n in _ids(prompt)])

    # Copies of an id inside one batch are all answered by one record.
    assert _outcome(spark, call, TEXTS, max_tokens=900)[0] == [f"r{i}" for i in range(6)]


def test_first_answer_wins_in_input_order(spark):
    data = [(i, "same", f"review number {i} with some text") for i in range(4)]
    good = split_valid(check_raw(spark.createDataFrame(data, "ingest_seq long, source_id string, raw_text string")), "raw")[0]

    def call(prompt):
        number = int(prompt.split("review number ")[1][0])
        return json.dumps([record("same", sentiment_score=number / 10)])

    result = PromptAnalyzer(call, "{}", max_tokens=850).enrich(good)
    assert result.analyzed.count() == 4
    assert [r["sentiment_score"] for r in rows(clean(flatten(result.analyzed)))] == [0.0]


def test_registry():
    assert isinstance(create_analyzer("lexicon"), LexiconAnalyzer)
    with pytest.raises(ValueError, match="unknown analyzer"):
        create_analyzer("nobody")
    register_analyzer("mine", LexiconAnalyzer)
    assert create_analyzer("mine", confidence=0.7).confidence == 0.7


def test_lexicon_analyzer_uses_metadata(spark):
    df = spark.createDataFrame(
        [(1, "a", "this is terrible and broken stuff", '{"star_rating": 2, "post_title": "Lamp"}')],
        "ingest_seq long, source_id string, raw_text string, m string",
    ).withColumn("metadata", F.parse_json("m"))
    got = rows(LexiconAnalyzer().enrich(split_valid(check_raw(df), "raw")[0]).analyzed)[0]
    assert (got["product_name"], got["reviewer_rating"], got["urgency_level"], got["action_required"]) == ("Lamp", 2.0, "high", True)
    assert got["summary"] == "Lamp: word lists say negative, rated 2.0 of 5; needs an answer."


def test_lexicon_analyzer_rejects_what_breaks_the_contract(spark):
    df = spark.createDataFrame(
        [(1, "a", "some text of a review", json.dumps({"post_title": "L" * 260})), (2, "b", "some text of a review", "{}")],
        "ingest_seq long, source_id string, raw_text string, m string",
    ).withColumn("metadata", F.parse_json("m"))
    good = split_valid(check_raw(df), "raw")[0]
    result = LexiconAnalyzer().enrich(good)
    assert [r["source_id"] for r in rows(result.analyzed)] == ["b"]
    assert [(r["source_id"], r["stage"], r["rule"]) for r in rows(result.rejects)] == [("a", "analyzed", "product_name")]
    assert result.rejects.schema.fieldNames() == REJECT.fieldNames()
    unsure = LexiconAnalyzer(confidence=150).enrich(good)
    assert unsure.analyzed.count() == 0 and unsure.rejects.count() == 2


def test_unreadable_replies_are_rejected(spark):
    replies = spark.createDataFrame([(1, "[1, {"), (2, '[{"source_id": "a"}, 7, null]'), (3, "[]"), (4, None)], "batch_no long, response string")
    assert parse_replies(replies).count() == 1
    found = sorted((r["rule"], r["payload"]) for r in rows(reply_rejects(replies).fillna("-")))
    assert found == [("item_not_an_object", "7"), ("item_not_an_object", "null"), ("reply_unreadable", "-"), ("reply_unreadable", "[1, {")]


def test_run_metrics_of_nothing(spark):
    good = split_valid(raw(spark, []), "raw")[0]
    got = rows(run_metrics(good, LexiconAnalyzer().enrich(good), "lexicon", 1.0))[0]
    assert (got["total_input"], got["success_rate"], got["avg_time_per_record"], got["estimated_cost_usd"]) == (0, 0.0, 0.0, 0.0)


def test_headings_and_names():
    assert sinks.humanize("key_topics_str") == "Key Topics"
    assert sinks.output_name("base", "csv") == "base.csv"
    moment = datetime(2024, 6, 15, 14, 30, 22, tzinfo=timezone.utc)
    assert sinks.output_name("base", "csv", moment) == "base_20240615_143022.csv"


def test_exports_read_back(spark, sample, tmp_path):
    done = analytics(check_analyzed(sample).drop("errors"), report_id="r1")
    paths = sinks.export_all(done.clean, done.summary, str(tmp_path), ("json", "csv", "kpi"))
    assert sorted(paths) == ["csv", "json", "kpi"] and all(paths.values())
    table = spark.read.csv(paths["csv"], header=True)
    assert table.columns == [c for c in sinks.EXPORT_COLUMNS if c in done.clean.columns]
    by_id = {r["source_id"]: r for r in rows(table)}
    assert by_id["r1"]["sentiment_score"] == "0.8500" and by_id["r1"]["key_topics_str"] == "battery|sound"
    assert by_id["r5"]["reviewer_rating"] is None and by_id["r2"]["action_required"] == "True"
    lines = [json.loads(r["value"]) for r in rows(spark.read.text(paths["json"] + "/records"))]
    assert {r["source_id"]: r["reviewer_rating"] for r in lines} == {"r1": 5.0, "r2": 2.0, "r3": 1.0, "r4": 4.0, "r5": ""}
    assert spark.read.json(paths["json"] + "/summary").first()["total_reviews_analyzed"] == 5
    meta = spark.read.json(paths["json"] + "/meta").first()
    assert meta["total_records"] == 5 and meta["report_id"] == "r1"
    assert analytics(sample.limit(0), report_id="r").summary.first()["report_id"] == "empty"
    assert spark.read.csv(paths["kpi"] + "/sentiment", header=True).count() == 3


def test_one_failing_format_stops_no_other(spark, sample, tmp_path, monkeypatch):
    def broken(clean_table, summary, path):
        raise OSError("disk")

    monkeypatch.setitem(sinks.WRITERS, "json", broken)
    done = analytics(sample)
    paths = sinks.export_all(done.clean, done.summary, str(tmp_path), ("json", "csv"))
    assert paths["json"] is None and paths["csv"]


def test_formats_are_written_side_by_side(spark, sample, tmp_path):
    meet, tags = threading.Barrier(2, timeout=60), []

    def waiting(clean_table, summary, path):
        meet.wait()  # passes only while the other format is being written
        tags.append(sorted(spark.getTags()))
        clean_table.write.parquet(path)
        return path

    done = analytics(sample)
    paths = sinks.export_all(
        done.clean, done.summary, str(tmp_path), ("one", "two", "one", "none"), writers={"one": waiting, "two": waiting}
    )
    assert list(paths) == ["one", "two", "none"] and paths["none"] is None
    assert spark.read.parquet(paths["one"]).count() == spark.read.parquet(paths["two"]).count() == done.clean.count()
    assert sorted(tags) == [["export-one"], ["export-two"]] and not spark.getTags()
    assert sinks.export_all(done.clean, done.summary, str(tmp_path), ()) == {}


def test_full_run(spark, tmp_path):
    checked = raw(spark, ["great product, I love it", "terrible and broken thing", "short", "nothing special to report"])
    record_row = rows(run(checked, str(tmp_path / "out"), moment=datetime(2024, 1, 1, tzinfo=timezone.utc)))[0]
    assert (record_row["status"], record_row["records_scraped"], record_row["records_analyzed"]) == ("success", 3, 3)
    assert record_row["success_rate"] == 1.0 and set(record_row["export_paths"]) == {"json", "csv"}
    tables = str(tmp_path / "out" / "tables")
    rejects = spark.read.parquet(tables + "/rejects")
    assert rejects.first()["rule"] == "raw_text_short" and rejects.schema.fieldNames() == REJECT.fieldNames()
    assert spark.read.parquet(tables + "/clean").count() == 3
    run(checked, str(tmp_path / "out"), max_records=1)
    assert spark.read.parquet(tables + "/runs").count() == 2


def test_empty_run_is_an_error(spark, tmp_path):
    with pytest.raises(EmptyRun):
        run(raw(spark, ["short"]), str(tmp_path / "out"))


def test_scorer_stays_out_of_the_plans_of_its_results(spark):
    result = LexiconAnalyzer().enrich(split_valid(raw(spark, TEXTS), "raw")[0])
    for part in (result.analyzed, result.failed, result.rejects):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(") == 0 and len(plan) < 20_000
