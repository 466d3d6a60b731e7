"""Review files: JSON arrays, JSON lines and CSV into checked raw rows.

Each reader returns rows ready for ``operators.intake.check_raw``: malformed
records stay in, with the reason in ``errors``, so that good plus rejected
rows always add up to the input. ``ingest_seq`` counts the records from 0 by
file path and place in the file, whatever the sizes of files and splits; store
it with the rows, later steps (deduplication, packing, caps) rely on it.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable
from pathlib import PurePosixPath
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinara.operators.intake import check_raw
from opinara.operators.rules import variant_text
from opinara.sources.ranges import CSV, JSON, read_records

_MISSING = "None"  # how a missing text prints; too short to pass the length rule


def load_records(spark: SparkSession, path: str, now: Column | None = None, **options) -> DataFrame:
    """Checked raw rows of a ``.json``, ``.jsonl`` or ``.csv`` path."""
    return check_raw(_reader(path)(spark, path, **options), now)


def _reader(path: str) -> Callable[..., DataFrame]:
    readers = {".json": read_json_array, ".jsonl": read_json_lines, ".csv": read_csv}
    suffix = PurePosixPath(path.rstrip("/")).suffix.lower()
    if suffix not in readers:
        raise ValueError(f"unsupported file format {suffix!r}; supported: {', '.join(readers)}")
    return readers[suffix]


def first_records(spark: SparkSession, path: str, max_records: int, now: Column | None = None, **options) -> DataFrame:
    """Checked rows of the first files of ``path`` in input order, enough for ``max_records`` good ones.

    Later files are never opened. The files are taken in growing groups (1, 1,
    2, 4, ...) whose good rows are counted until there are enough, so at most
    about twice the needed files are read, twice. The rows equal those that
    ``load_records`` gives for the same files, rejects among them; hand the good
    ones to ``operators.intake.cap_records``. Zero means no cap; a path with too
    few good rows is read whole.
    """
    if not max_records:
        return load_records(spark, path, now, **options)
    reader = _reader(path)
    names = sorted(spark.read.text(path).inputFiles())
    found, taken, group = 0, 0, 1
    while found < max_records and taken < len(names):
        checked = check_raw(reader(spark, _literal(names[taken:taken + group]), **options), now)
        good = checked.filter(F.size("errors") == 0)
        found, taken, group = found + good.count(), taken + len(names[taken:taken + group]), max(taken, 1)
    return check_raw(reader(spark, _literal(names[:taken]) or path, **options), now)


def _literal(names: list[str]) -> list[str]:
    """Listed addresses as paths that stand for themselves: decoded, with pattern characters escaped."""
    return [re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(name)) for name in names]


# --- input order -------------------------------------------------------------------

# A table of so many splits (or files) is sent to all executors; a larger one is joined.
BROADCAST_SPLITS = 1_000_000


def _where() -> tuple[Column, Column]:
    return F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")


def _offsets(sizes: DataFrame, *order: str) -> DataFrame:
    """``sizes`` with ``_before``: the rows in splits before this one. One row per split or file, never per record."""
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    return F.broadcast(placed) if sizes.count() <= BROADCAST_SPLITS else placed


def _in_order(read: DataFrame) -> DataFrame:
    """Rows just read, with ``_file`` and ``_block``, numbered by file path, split and place: ``_seq``.

    Spark deals splits out by size, so its own row ids follow that. Within a
    split they count the rows, which gives the place; one narrow pass counts
    the rows of each split.
    """
    rows = read.withColumn("_id", F.monotonically_increasing_id())
    sizes = rows.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_rows"), F.min("_id").alias("_first"))
    numbered = rows.join(_offsets(sizes, "_file", "_block"), ["_file", "_block"])
    return numbered.withColumn("_seq", F.col("_before") + F.col("_id") - F.col("_first")).drop(
        "_file", "_block", "_id", "_rows", "_first", "_before"
    )


# --- JSON ----------------------------------------------------------------------

def read_json_array(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One JSON array per file, read in byte ranges (``sources.ranges``); an element has to fit a row.

    Elements are parsed one by one, so a broken one costs only itself, as long
    as its quotes and brackets close. Anything but an array at the top stops the job.
    """
    items, sizes = read_records(spark, path, JSON)
    placed = _offsets(sizes.withColumn("_rows", F.col("records")), "file")
    opened, closed = r"^\s*\[", r"\]\s*\z"
    text, last = F.col("text"), F.col("number") == F.col("records") - 1
    is_list = F.col("sound") & ((F.col("number") > 0) | text.rlike(opened)) & (~last | text.rlike(closed))
    bare = F.when(F.col("number") == 0, F.regexp_replace(text, opened, "")).otherwise(text)
    bare = F.trim(F.when(last, F.regexp_replace(bare, closed, "")).otherwise(bare), F.lit(" \t\r\n"))
    wrong = F.raise_error(F.concat(F.lit("JSON document must be a list: "), "file")).cast("string")
    found = items.join(placed, "file").select(
        F.when(is_list & (bare != ""), bare).otherwise(wrong).alias("text"), (F.col("_before") + F.col("number")).alias("ingest_seq")
    )
    item = found.withColumn("item", F.try_parse_json("text"))
    return _from_items(item.withColumn("text", F.coalesce(F.to_json("item"), "text")))


def read_json_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return from_json_lines(_in_order(spark.read.text(path).select("value", *_where())), seq="_seq")


def from_json_lines(lines: DataFrame, value: str = "value", seq: str | None = None) -> DataFrame:
    """One JSON object per row; blank rows are no records. ``seq`` names the column of their order."""
    text = F.col(value)
    order = F.col(seq) if seq else F.monotonically_increasing_id()
    return _from_items(
        lines.withColumn("_order", order).filter(F.trim(text) != "")
        .select(F.try_parse_json(text).alias("item"), text.alias("text"), F.col("_order").alias("ingest_seq"))
    )


def _array_items(text: Column, origin: Column) -> Column:
    return F.coalesce(
        F.from_json(text, "array<variant>"),
        # A repeated key fails the typed parse when the session forbids it.
        F.transform(F.from_json(text, "array<string>"), F.try_parse_json),
        F.raise_error(F.concat(F.lit("JSON document must be a list: "), origin)).cast("array<variant>"),
    )


def from_json_arrays(
    documents: DataFrame, value: str = "value", origin: str = "origin", before: str | None = None
) -> DataFrame:
    """Elements of JSON array texts, each judged on its own.

    Anything but an array at the top is an error. Elements are parsed one by
    one, so a broken one costs only itself. ``before`` names the column that
    counts the elements of the texts before this one.
    """
    items = F.posexplode(_array_items(F.col(value), F.col(origin))).alias("place", "item")
    found = documents.select(*([before] if before else []), items)
    order = F.col(before) + F.col("place") if before else F.monotonically_increasing_id()
    return _from_items(found.withColumns({"text": F.to_json("item"), "ingest_seq": order}))


def _from_items(items: DataFrame) -> DataFrame:
    kind = F.coalesce(F.schema_of_variant("item"), F.lit(""))
    fields = {
        name: F.try_variant_get(F.col("item"), f"$.{name}", "variant")
        for name in ("source_id", "source_url", "raw_text", "scraped_at", "metadata")
    }
    staged = items.select(
        "ingest_seq",
        "text",
        kind.startswith("OBJECT").alias("is_object"),
        *[column.alias(f"v_{name}") for name, column in fields.items()],
    )
    kind_of = {name: F.coalesce(F.schema_of_variant(f"v_{name}"), F.lit("VOID")) for name in fields}
    absent = {name: F.col(f"v_{name}").isNull() for name in fields}
    moment = F.try_to_timestamp(F.try_variant_get(F.col("v_scraped_at"), "$", "string"))
    broken = F.array(
        F.when(~F.col("is_object"), "not_an_object"),
        F.when(F.col("is_object") & absent["raw_text"], "raw_text_missing"),
        F.when(~kind_of["source_url"].isin("STRING", "VOID"), "source_url_type"),
        F.when(~absent["scraped_at"] & moment.isNull(), "scraped_at_type"),
        F.when(~absent["metadata"] & ~kind_of["metadata"].startswith("OBJECT"), "metadata_type"),
    )
    source_id = F.when(kind_of["source_id"] != "VOID", variant_text(F.col("v_source_id")))
    return staged.select(
        "ingest_seq",
        source_id.alias("source_id"),
        F.try_variant_get(F.col("v_source_url"), "$", "string").alias("source_url"),
        F.when(F.col("is_object"), variant_text(F.col("v_raw_text"))).otherwise(F.col("text")).alias("raw_text"),
        moment.alias("scraped_at"),
        F.when(kind_of["metadata"].startswith("OBJECT"), F.col("v_metadata"))
        .otherwise(F.parse_json(F.lit("{}"))).alias("metadata"),
        F.array_compact(broken).alias("errors"),
    )


# --- CSV -----------------------------------------------------------------------

_CSV = {"quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """CSV with a header row, read in byte ranges. Files without line breaks inside
    cells may be read with ``multi_line=False``, which leaves all to Spark's reader."""
    if multi_line:
        return _read_csv_records(spark, path)
    head = spark.read.options(**_CSV).csv(path, header=True)
    schema = ", ".join(f"`{name}` string" for name in head.columns)
    rows = spark.read.options(
        **_CSV, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad", enforceSchema=False
    ).schema(f"{schema}, _bad string").csv(path, header=True)
    return _from_csv_rows(_in_order(rows.select(*[f"`{name}`" for name in head.columns], "_bad", *_where())), head.columns, "_seq")


def _read_csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    records, sizes = read_records(spark, path, CSV)
    plain = records.withColumn("text", F.regexp_replace("text", r"\r\z", ""))
    first = plain.filter("number = 0").select("text").limit(1).collect()  # one line: the header of any file
    if not first:
        return _from_csv_rows(spark.createDataFrame([], "raw_text string, _bad string, _seq long"), ["raw_text"], "_seq")
    header = first[0]["text"]
    names = [name or f"_c{place}" for place, name in enumerate(next(csv.reader([header], doublequote=True)))]
    placed = _offsets(sizes.withColumn("_rows", F.col("records") - 1), "file")
    # Every file has the same header; another one stops the job.
    wrong = F.raise_error(F.concat(F.lit("CSV header differs: "), "file")).cast("boolean")
    told = plain.join(placed, "file").filter(F.when(F.col("number") > 0, F.lit(True)).when(F.col("text") == header, F.lit(False)).otherwise(wrong))
    schema = ", ".join(f"`{name}` string" for name in [*names, "_bad"])
    options = {**_CSV, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "multiLine": "true"}
    rows = told.select(F.from_csv("text", schema, options).alias("r"), (F.col("_before") + F.col("number") - 1).alias("_seq"))
    return _from_csv_rows(rows.select("r.*", "_seq"), names, "_seq")


def from_csv_lines(lines: DataFrame, header: list[str], value: str = "value") -> DataFrame:
    """The same for CSV records already landed as one text per row."""
    schema = ", ".join(f"`{name}` string" for name in [*header, "_bad"])
    options = {**_CSV, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "multiLine": "true"}
    return _from_csv_rows(lines.select(F.from_csv(F.col(value), schema, options).alias("r")).select("r.*"), header)


def _from_csv_rows(rows: DataFrame, header: list[str], seq: str | None = None) -> DataFrame:
    # A short row is padded with nulls and judged by the length rules; a row with
    # more cells than the header is malformed. Spark flags both.
    wide = ", ".join(f"`{name}` string" for name in [*header, "_more"])
    spill = F.from_csv(F.col("_bad"), wide, {**_CSV, "mode": "PERMISSIVE", "multiLine": "true"})["_more"]
    too_wide = F.col("_bad").isNotNull() & (spill.isNotNull() | F.col(f"`{header[-1]}`").isNotNull())
    have = set(header)

    def cell(name: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast("string")

    moment = F.try_to_timestamp(cell("scraped_at"))
    broken = F.array(
        F.when(too_wide, "too_many_cells"),
        F.lit(None if "raw_text" in have else "raw_text_missing"),
        F.when(F.lit("scraped_at" in have) & moment.isNull(), "scraped_at_type"),
        # A CSV cell is text, never an object.
        F.lit("metadata_type" if "metadata" in have else None),
    )
    return rows.select(
        (F.col(seq) if seq else F.monotonically_increasing_id()).alias("ingest_seq"),
        cell("source_id").alias("source_id"),
        cell("source_url").alias("source_url"),
        F.coalesce(cell("raw_text"), F.lit(_MISSING)).alias("raw_text"),
        moment.alias("scraped_at"),
        F.array_compact(broken.cast("array<string>")).alias("errors"),
    )
