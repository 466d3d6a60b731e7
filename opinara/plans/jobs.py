"""End-to-end jobs: analytics over analyzed reviews, and the full run."""

from __future__ import annotations

import json
import time
from collections.abc import Sequence
from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.operators.cleaning import clean, flatten
from opinara.operators.enrich import Analyzer, LexiconAnalyzer, run_metrics
from opinara.operators.intake import cap_records, split_valid
from opinara.operators.kpi import TOP_N
from opinara.plans.summary import summarize
from opinara.session import checkpoint_folder
from opinara.sinks import export_all


class Analytics(NamedTuple):
    clean: DataFrame
    summary: DataFrame


def analytics(
    analyzed: DataFrame, granularity: str = "day", top_n: int = TOP_N, report_id: str | None = None, now: Column | None = None
) -> Analytics:
    """Clean table and one-row summary of analyzed reviews."""
    flat = flatten(analyzed)
    kept = clean(flat)
    return Analytics(kept, summarize(kept, flat, granularity, top_n, report_id, now))


class EmptyRun(RuntimeError):
    """Nothing came in, or nothing could be analyzed."""


def run(
    checked: DataFrame,
    folder: str,
    analyzer: Analyzer | None = None,
    formats: Sequence[str] = ("json", "csv"),
    granularity: str = "day",
    max_records: int = 0,
    moment: datetime | None = None,
) -> DataFrame:
    """Full run over checked raw rows; returns (and appends) its run record.

    Each stage is written as a table under ``folder`` and read back by the next
    ones: nothing is computed twice, and a lost executor costs no more than the
    stage in progress.
    """
    spark = checked.sparkSession
    checkpoint_folder(spark, f"{folder}/checkpoints")
    analyzer = analyzer or LexiconAnalyzer()
    moment = moment or datetime.now(timezone.utc)
    started = time.monotonic()

    def store(df: DataFrame, name: str) -> DataFrame:
        path = f"{folder}/tables/{name}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    # The input is read and judged once; good and rejected rows both come from that table.
    judged = store(checked, "judged")
    good, rejects = split_valid(judged, "raw")
    raw = store(cap_records(good, max_records), "raw")
    if raw.isEmpty():
        store(rejects, "rejects")
        raise EmptyRun("no usable raw records")

    result = analyzer.enrich(raw)
    result = result._replace(analyzed=store(result.analyzed, "analyzed"), failed=store(result.failed, "failed"))
    store(rejects.unionByName(result.rejects), "rejects")
    if result.analyzed.isEmpty():
        raise EmptyRun("no record could be analyzed")
    enriched_in = time.monotonic() - started
    metrics = store(
        run_metrics(raw, result, analyzer.model, round(enriched_in, 2), f"{moment:%Y%m%d%H%M%S}"), "run_metrics"
    )

    flat = flatten(result.analyzed)
    kept = store(clean(flat), "clean")
    summary = store(summarize(kept, flat, granularity, report_id=f"report_{moment:%Y%m%d%H%M%S}", now=F.lit(moment)), "summary")
    paths = export_all(kept, summary, folder, formats, moment)

    record = run_record(metrics, summary, paths, time.monotonic() - started)
    record.write.mode("append").parquet(f"{folder}/tables/runs")
    return record


def run_record(
    metrics: DataFrame, summary: DataFrame, paths: dict[str, str | None], seconds: float
) -> DataFrame:
    """One row: status, counts, success rate, paths, elapsed time, anomaly flag.

    Both inputs have one row; they are stacked and folded into one.
    """
    flag = summary.select("anomaly_detected")
    both = metrics.select("batch_id", "total_input", "successful", "success_rate").unionByName(
        flag, allowMissingColumns=True
    )
    written = json.dumps({name: path for name, path in paths.items() if path})
    return both.agg(
        F.lit("success").alias("status"),
        F.max("batch_id").alias("batch_id"),
        F.max("total_input").alias("records_scraped"),
        F.max("successful").alias("records_analyzed"),
        F.max("success_rate").alias("success_rate"),
        F.from_json(F.lit(written), "map<string,string>").alias("export_paths"),
        F.lit(round(seconds, 2)).alias("elapsed_seconds"),
        F.max("anomaly_detected").alias("anomaly_detected"),
    )
