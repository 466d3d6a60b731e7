"""Enrichment: analyzers, reconciliation of failures, run metrics."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions.numeric import round_exact
from opinara.functions.text import (
    OUTPUT_TOKENS_PER_RECORD,
    Lexicon,
    cost_usd,
    score_sentiment,
    token_count,
)
from opinara.operators.packing import MAX_TOKENS_PER_BATCH, pack_batches, record_costs
from opinara.operators.prompts import batch_prompts, parse_replies, reply_rejects, single_prompt, unfence
from opinara.operators.rules import check_analyzed
from opinara.schemas import ANALYZED
from opinara.session import materialize


# Input order of an analyzed record: its batch, the attempt that answered it, its place.
_BATCHED, _SINGLE = 1, 2


class Enriched(NamedTuple):
    analyzed: DataFrame  # ANALYZED + ingest_seq (any type that sorts in input order)
    failed: DataFrame  # ingest_seq, source_id, rule: inputs without a result
    rejects: DataFrame  # REJECT: every answer that broke the contract, and every unreadable reply


class Analyzer(Protocol):
    """A strategy that turns checked raw rows into analyzed ones."""

    model: str

    def enrich(self, raw: DataFrame, now: Column | None = None) -> Enriched: ...


class AnalyzerError(Exception):
    """Raised by a model call that failed; the batch falls back to single calls."""


class LexiconAnalyzer:
    """Default analyzer: word-list sentiment as column expressions, no workers.

    Product and rating come from the metadata when a source recorded them.
    """

    model = "lexicon"

    def __init__(self, lexicon: Lexicon = Lexicon(), confidence: float = 0.85) -> None:
        self.lexicon, self.confidence = lexicon, confidence

    def draft(self, raw: DataFrame) -> DataFrame:
        """Contract columns before validation, one row per raw row."""
        scored = score_sentiment(raw, self.lexicon)
        rating = F.try_variant_get("metadata", "$.star_rating", "double")
        staged = scored.withColumns({
            "product_name": F.coalesce(
                F.nullif(F.try_variant_get("metadata", "$.post_title", "string"), F.lit("")),
                F.lit("Unknown"),
            ),
            "reviewer_rating": F.when(rating.between(1, 5), rating),
        }).withColumn(
            "urgency_level",
            F.when((F.col("sentiment") == "negative") & (F.col("reviewer_rating") <= 2.0), "high")
            .otherwise(F.col("urgency_level")),
        ).withColumn("action_required", F.col("urgency_level").isin("high", "critical"))
        act, rated = F.col("action_required"), F.col("reviewer_rating").isNotNull()
        return staged.select(
            "ingest_seq", "source_id", "product_name", "sentiment", "sentiment_score",
            F.lit(self.confidence).alias("confidence_score"),
            F.concat(
                "product_name", F.lit(": word lists say "), "sentiment",
                F.when(rated, F.format_string(", rated %.1f of 5", "reviewer_rating")).otherwise(F.lit("")),
                F.when(act, "; needs an answer.").otherwise("."),
            ).alias("summary"),
            "reviewer_rating", "urgency_level", "action_required",
            F.when(act, "Answer this customer first.").alias("action_notes"),
        )

    def enrich(self, raw: DataFrame, now: Column | None = None) -> Enriched:
        return split_analyzed(check_analyzed(self.draft(raw), now=now))


class PromptAnalyzer:
    """Analyzer behind a text-in, text-out call that runs in Python workers.

    ``call`` gets a prompt and returns the reply. Raising AnalyzerError (or
    replying with broken JSON) sends the batch's records through single calls;
    any other exception stops the job. Calls run as Spark schedules their
    tasks; the result does not depend on it.
    """

    def __init__(
        self,
        call: Callable[[str], str],
        schema: str,
        model: str = "custom",
        max_tokens: int = MAX_TOKENS_PER_BATCH,
        drop_unknown: bool = False,
    ) -> None:
        self.call, self.schema, self.model = call, schema, model
        self.max_tokens, self.drop_unknown = max_tokens, drop_unknown

    def enrich(self, raw: DataFrame, now: Column | None = None) -> Enriched:
        # Two narrow columns, read by the prompts and again when reconciling.
        batches = materialize(pack_batches(record_costs(raw), self.max_tokens).select("ingest_seq", "batch_no"))
        packed = raw.select("ingest_seq", "source_id", "raw_text").join(batches, "ingest_seq")
        # The replies are costly and read three times below.
        replies = materialize(self._ask(batch_prompts(packed, self.schema), "batch_no"))
        place = F.struct("batch_no", F.lit(_BATCHED).alias("attempt"), F.col("place").cast("long").alias("place"))
        records = parse_replies(replies).withColumn("ingest_seq", place).drop("place")
        found = split_analyzed(check_analyzed(_with_text(records), payload="payload", now=now))
        found = found._replace(rejects=found.rejects.unionByName(reply_rejects(replies)))
        return reconcile(packed, found, self._single(now), self.drop_unknown)

    def _ask(self, prompts: DataFrame, *keys: str) -> DataFrame:
        call = self.call

        def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                yield frame.drop(columns="prompt").assign(response=[_reply(call, p) for p in frame["prompt"]])

        kinds = dict(prompts.dtypes)
        schema = ", ".join(f"{key} {kinds[key]}" for key in keys)
        return prompts.select(*keys, "prompt").mapInPandas(ask, f"{schema}, response string")

    def _single(self, now: Column | None) -> Callable[[DataFrame], Enriched]:
        def analyze(rest: DataFrame) -> Enriched:
            prompts = rest.select(
                "batch_no", "ingest_seq", "source_id", single_prompt(F.col("raw_text"), self.schema).alias("prompt")
            )
            replies = materialize(self._ask(prompts, "batch_no", "ingest_seq", "source_id"))
            payload = F.try_parse_json(unfence(F.col("response")))
            checked = check_analyzed(
                replies.select(
                    F.struct("batch_no", F.lit(_SINGLE).alias("attempt"), F.col("ingest_seq").alias("place")).alias("ingest_seq"),
                    F.col("source_id").alias("asked_id"), payload.alias("payload"),
                    F.coalesce(F.to_json(payload), F.col("response")).alias("_text"),
                ),
                payload="payload", now=now,
            )
            # The record keeps the id it was asked for, whatever the reply says.
            return split_analyzed(
                checked.withColumns({
                    "source_id": F.col("asked_id"), "errors": F.array_remove("errors", "source_id"),
                }).drop("asked_id")
            )

        return analyze


def _reply(call: Callable[[str], str], prompt: str) -> str | None:
    try:
        return call(prompt)
    except Exception as failure:
        # By name: the class travels with the job and may also be installed.
        if any(kind.__name__ == AnalyzerError.__name__ for kind in type(failure).__mro__):
            return None
        raise


def _with_text(records: DataFrame) -> DataFrame:
    """Records with their payload as text beside it, for the reject table."""
    return records.withColumn("_text", F.to_json("payload"))


def split_analyzed(checked: DataFrame, stage: str = "analyzed") -> Enriched:
    """Rows that keep the contract, and the others: as failed inputs and as REJECT rows.

    A column ``_text`` holds the answer as it came; without it, the reject
    table shows the columns as they were read. The checked rows are stored
    once: a filter on ``errors`` would otherwise be pushed below them and carry
    a copy of every expression that the rules are made of, scorer included.
    """
    checked = materialize(checked)
    text = "_text" in checked.columns
    good = F.size("errors") == 0
    bad = checked.filter(~good)
    rule = F.array_join("errors", ",").alias("rule")
    payload = F.col("_text") if text else F.to_json(F.struct(*[name for name in ANALYZED.names if name in checked.columns]))
    return Enriched(
        checked.filter(good).drop("errors", "_text"),
        bad.select("ingest_seq", "source_id", rule),
        bad.select("source_id", F.lit(stage).alias("stage"), rule, payload.alias("payload")),
    )


def reconcile(
    packed: DataFrame,
    found: Enriched,
    single: Callable[[DataFrame], Enriched],
    drop_unknown: bool = False,
) -> Enriched:
    """Second, single-record attempt for inputs whose id their batch did not answer.

    ``found.analyzed`` has (batch_no, source_id, ...). Matching is per batch, so even an
    id that fills a third of the input meets at most a batch of its copies in
    one join group. Answers with ids nobody asked for count as results, as long
    as ``drop_unknown`` is not set.
    """
    keys = ["batch_no", "source_id"]
    answered = found.analyzed.select(*keys).distinct()
    rest = single(packed.join(answered, keys, "left_anti"))
    known = found.analyzed
    if drop_unknown:
        known = known.join(packed.select(*keys).distinct(), keys, "left_semi")
    columns = ["ingest_seq", *ANALYZED.names]
    analyzed = known.select(*columns).unionByName(rest.analyzed.select(*columns))
    return Enriched(analyzed, rest.failed, found.rejects.unionByName(rest.rejects))


# --- registry --------------------------------------------------------------------

_ANALYZERS: dict[str, Callable[..., Analyzer]] = {"lexicon": LexiconAnalyzer, "prompt": PromptAnalyzer}


def register_analyzer(name: str, factory: Callable[..., Analyzer]) -> None:
    _ANALYZERS[name] = factory


def create_analyzer(name: str, **options) -> Analyzer:
    if name not in _ANALYZERS:
        raise ValueError(f"unknown analyzer {name!r}; registered: {', '.join(sorted(_ANALYZERS))}")
    return _ANALYZERS[name](**options)


# --- run metrics -----------------------------------------------------------------

def run_metrics(
    raw: DataFrame,
    result: Enriched,
    model: str,
    seconds: float = 0.0,
    batch_id: str = "run",
    now: Column | None = None,
) -> DataFrame:
    """One RUN_METRICS row. Tokens and cost are estimates from the review texts."""
    parts = [
        raw.select(F.lit("input").alias("part"), token_count(F.col("raw_text")).alias("tokens")),
        result.analyzed.select(F.lit("ok").alias("part"), F.lit(0).cast("long").alias("tokens")),
        result.failed.select(F.lit("failed").alias("part"), F.lit(0).cast("long").alias("tokens")),
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    totals = rows.agg(
        F.count_if(F.col("part") == "input").alias("total_input"),
        F.count_if(F.col("part") == "ok").alias("successful"),
        F.count_if(F.col("part") == "failed").alias("failed"),
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("total_tokens_used"),
    )
    spent = F.lit(float(seconds))
    return totals.select(
        F.lit(batch_id).alias("batch_id"),
        "total_input", "successful", "failed",
        F.coalesce(F.try_divide("successful", "total_input"), F.lit(0.0)).alias("success_rate"),
        spent.alias("processing_time_seconds"),
        F.coalesce(round_exact(F.try_divide(spent, F.col("total_input")), 4), F.lit(0.0)).alias("avg_time_per_record"),
        F.lit(model).alias("model_used"),
        "total_tokens_used",
        cost_usd(
            F.lit(model), F.col("total_tokens_used"), F.col("successful") * F.lit(OUTPUT_TOKENS_PER_RECORD)
        ).alias("estimated_cost_usd"),
        (F.current_timestamp() if now is None else now).alias("processed_at"),
    )
