"""Raw record contract: trimming, length rules, record cap, good/reject split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions.text import strip

# Fixed value: shorter texts carry nothing to analyze.
MIN_TEXT_LENGTH = 10
# A cap of up to so many records is a top list; cells of one histogram of a larger one.
TOP_ROWS, CELLS = 10_000, 4096


def check_raw(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Shape rows into the RAW layout and list every broken rule in ``errors``.

    ``source_id`` and ``raw_text`` are required; the other columns may be
    missing. A source may bring its own ``errors`` column with findings from
    parsing, which are kept.
    """
    now = F.current_timestamp() if now is None else now
    have = set(df.columns)
    found = F.col("errors") if "errors" in have else F.array().cast("array<string>")
    shaped = df.select(
        F.col("ingest_seq").cast("long").alias("ingest_seq"),
        strip(F.col("source_id").cast("string")).alias("source_id"),
        (F.col("source_url").cast("string") if "source_url" in have else F.lit(None).cast("string")).alias("source_url"),
        strip(F.col("raw_text").cast("string")).alias("raw_text"),
        (F.coalesce(F.col("scraped_at"), now) if "scraped_at" in have else now).alias("scraped_at"),
        (F.col("metadata") if "metadata" in have else F.parse_json(F.lit("{}"))).alias("metadata"),
        found.alias("_found"),
    )
    broken = F.array(
        F.when(F.coalesce(F.col("source_id"), F.lit("")) == "", "source_id_empty"),
        F.when(F.length(F.coalesce(F.col("raw_text"), F.lit(""))) < MIN_TEXT_LENGTH, "raw_text_short"),
    )
    return shaped.withColumn("errors", F.concat("_found", F.array_compact(broken))).drop("_found")


def split_valid(checked: DataFrame, stage: str) -> tuple[DataFrame, DataFrame]:
    """(rows without errors, REJECT rows) of a frame with an ``errors`` column."""
    clean = F.size("errors") == 0
    good = checked.filter(clean).drop("errors")
    payload = F.col("raw_text") if "raw_text" in checked.columns else F.to_json(F.struct(
        *[name for name in checked.columns if name not in ("errors", "payload", "ingest_seq")]
    ))
    rejects = checked.filter(~clean).select(
        "source_id",
        F.lit(stage).alias("stage"),
        F.array_join("errors", ",").alias("rule"),
        payload.alias("payload"),
    )
    return good, rejects


def cap_records(df: DataFrame, max_records: int) -> DataFrame:
    """First ``max_records`` rows in input order (``ingest_seq``); zero means no cap.

    Up to TOP_ROWS rows are taken, sorted, from what each task hands on. More
    never meet in one task: the last number of the cap is found by histograms of
    the numbers alone, and the rows up to it stay where they are, unsorted.
    """
    if not max_records or max_records <= TOP_ROWS:
        return df.orderBy("ingest_seq").limit(max_records) if max_records else df
    order = F.coalesce(F.col("ingest_seq").cast("long"), F.lit(-1))  # rows without a number come first
    numbers = df.select(order.alias("k")).persist()
    edge, room, there = _edge(numbers, max_records)
    numbers.unpersist()
    if edge is None:
        return df
    if room == there:
        return df.filter(order <= edge)
    return df.filter(order < edge).unionByName(df.filter(order == edge).limit(room))


def _edge(numbers: DataFrame, rank: int) -> tuple[int | None, int, int]:
    """(the number ``k`` of this rank, rows of it up to the rank, all rows of it); no number if there are fewer rows."""
    whole = numbers.agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("low"), F.max("k").alias("high")).first()
    if whole.n <= rank:
        return None, 0, 0
    low, high, left, there = whole.low, whole.high, rank, whole.n
    while low < high:
        width = (high - low) // CELLS + 1
        cell = F.expr(f"(k - {low}L) div {width}L").alias("cell")
        counts = numbers.filter(F.col("k").between(low, high)).groupBy(cell).agg(F.count(F.lit(1)).alias("n")).collect()
        for row in sorted(counts, key=lambda row: row.cell):
            if row.n >= left:
                break
            left -= row.n
        there, low = row.n, low + row.cell * width
        high = min(high, low + width - 1)
    return low, left, there
