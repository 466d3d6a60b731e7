"""Contract of an analyzed review: decode, coerce, check, business rules.

Input is either a VARIANT payload (parsed from a model response) or typed
columns. Both are first read into *cells* - is the key there, is its type
acceptable, what is the value - and then pass the same rules, so one set of
expressions defines the contract. Every broken rule of a row is reported.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.functions.numeric import clip, let, not_nan, round_exact
from opinara.functions.text import strip
from opinara.schemas import ANALYZED, CATEGORIES, EXPERTISE, QUALITIES, SENTIMENTS, URGENCIES

LIST_FIELDS = ("key_topics", "pros", "cons", "mentioned_competitors")
NUMBER_FIELDS = ("sentiment_score", "confidence_score", "reviewer_rating")
FLAG_FIELDS = ("is_verified_purchase", "action_required", "is_spam_or_fake")
TIME_FIELDS = ("review_date", "analyzed_at")
# Spellings accepted for a flag, besides JSON booleans and 0/1.
TRUE_TEXTS = ("true", "t", "yes", "y", "on", "1")
FALSE_TEXTS = ("false", "f", "no", "n", "off", "0")
# Above this, a numeric timestamp is read as milliseconds.
_SECONDS_LIMIT = 2e10


# Spellings of a number and of the date a time stamp begins with. Casts alone would also
# take type suffixes ("4d") and complete a bare time of day with today's date.
NUMBER = r"^\s*[+-]?(\d[\d_]*\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
DATED = r"^\s*[+-]?\d{4,}-?\d"


class Cell(NamedTuple):
    present: Column
    typed: Column  # false when the value has a type the field cannot take
    value: Column


# --- reading cells -------------------------------------------------------------

def variant_text(value: Column) -> Column:
    """Text of any JSON value the way a dynamic language prints it."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "STRING", F.try_variant_get(value, "$", "string"))
        .when(kind == "VOID", F.lit("None"))
        .when(kind == "BOOLEAN", F.initcap(F.try_variant_get(value, "$", "string")))
        .otherwise(F.to_json(value))
    )


def is_object(value: Column) -> Column:
    """Whether a VARIANT is an object; one look-up, while a schema would go through all it holds."""
    return F.try_variant_get(value, "$", "struct<source_id: variant>").isNotNull()


def read_time(text: Column) -> Column:
    """A time stamp that names its date; null for anything else."""
    return F.when(text.rlike(DATED), F.try_to_timestamp(text))


def _variant_cell(name: str, value: Column, kind: Column) -> Cell:
    present = value.isNotNull()
    text = F.try_variant_get(value, "$", "string")
    empty = kind == "VOID"
    if name in NUMBER_FIELDS:
        plain = (kind != "STRING") | F.coalesce(text.rlike(NUMBER), F.lit(False))
        return Cell(present, F.lit(True), F.when(plain, F.try_variant_get(value, "$", "double")))
    if name in LIST_FIELDS:
        items = F.transform(F.try_variant_get(value, "$", "array<variant>"), variant_text)
        listed = F.when(kind == "STRING", F.split(text, ",")).when(kind.startswith("ARRAY"), items)
        return Cell(present, F.lit(True), listed)
    if name in ("source_id", "reviewer_expertise"):
        printed = F.when(empty, F.lit(None)).otherwise(variant_text(value))
        return Cell(present, F.lit(True), printed)
    if name == "language_detected":
        falsy = empty | variant_text(value).isin("", "0", "0.0", "False", "[]", "{}")
        return Cell(present, F.lit(True), F.when(~falsy, variant_text(value)))
    if name in FLAG_FIELDS:
        number = F.try_variant_get(value, "$", "double")
        spelled = F.lower(text)
        flag = (
            F.when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
            .when((kind == "STRING") & spelled.isin(*TRUE_TEXTS), F.lit(True))
            .when((kind == "STRING") & spelled.isin(*FALSE_TEXTS), F.lit(False))
            .when((kind != "STRING") & (number == 1), F.lit(True))
            .when((kind != "STRING") & (number == 0), F.lit(False))
        )
        return Cell(present, empty | flag.isNotNull(), flag)
    if name in TIME_FIELDS:
        number = F.try_variant_get(value, "$", "double")
        seconds = F.when(F.abs(number) > _SECONDS_LIMIT, number / 1000.0).otherwise(number)
        moment = F.when(kind == "STRING", read_time(text)).when(
            kind != "BOOLEAN", F.timestamp_seconds(seconds)
        )
        return Cell(present, empty | moment.isNotNull(), moment)
    return Cell(present, empty | (kind == "STRING"), F.when(kind == "STRING", text))


def _typed_cell(df: DataFrame, name: str) -> Cell:
    if name not in df.columns:
        return Cell(F.lit(False), F.lit(True), F.lit(None).cast(ANALYZED[name].dataType))
    value = F.col(name)
    kind = df.schema[name].dataType
    if name in NUMBER_FIELDS:
        plain = F.when(value.rlike(NUMBER), value) if isinstance(kind, T.StringType) else value
        value = plain.try_cast("double")
    elif name in LIST_FIELDS and not isinstance(kind, T.ArrayType):
        value = F.split(value.cast("string"), ",")
    elif name in FLAG_FIELDS:
        value = value.try_cast("boolean")
        return Cell(F.lit(True), F.col(name).isNull() | value.isNotNull(), value)
    elif name in TIME_FIELDS and isinstance(kind, T.StringType):
        value = read_time(value)
        return Cell(F.lit(True), F.col(name).isNull() | value.isNotNull(), value)
    elif name in TIME_FIELDS:
        value = value.cast("timestamp")
    elif name not in LIST_FIELDS:
        value = value.cast("string")
    return Cell(F.lit(True), F.lit(True), value)


def _read_payload(df: DataFrame, payload: str) -> tuple[DataFrame, dict[str, Cell]]:
    """One column per field, holding its cell; keys outside the contract are dropped.

    All fields are taken from the payload in one pass over it.
    """
    fields = F.try_variant_get(F.col(payload), "$", f"struct<{', '.join(f'{name}: variant' for name in ANALYZED.names)}>")

    def cell(name: str) -> Column:
        field = F.col("_fields")[name]
        kind = F.coalesce(F.schema_of_variant(field), F.lit("VOID"))
        return let(F.struct(field.alias("field"), kind.alias("kind")), lambda found: F.struct(
            *[part.alias(label) for label, part in _variant_cell(name, found["field"], found["kind"])._asdict().items()]
        ))

    kept = [name for name in df.columns if name != payload and name not in ANALYZED.names]
    read = df.select(*kept, fields.alias("_fields")).select(*kept, *[cell(name).alias(f"_{name}") for name in ANALYZED.names])
    return read, {
        name: Cell(*[F.col(f"_{name}")[kind] for kind in Cell._fields]) for name in ANALYZED.names
    }


# --- single-field coercions ----------------------------------------------------

def coerce_rating(value: Column) -> Column:
    """One decimal inside 1..5, null for anything else."""
    return F.when(value.between(1.0, 5.0) & ~F.isnan(value), round_exact(value, 1))


def coerce_confidence(value: Column) -> Column:
    """Percentages become shares; what stays outside 0..1 becomes null (a reject)."""
    share = F.when(value.between(0.0, 1.0), value).when(value.between(1.0, 100.0), value / 100.0)
    return let(share, lambda number: round_exact(number, 4))


def coerce_score(value: Column) -> Column:
    return let(clip(not_nan(value), -1.0, 1.0), lambda number: round_exact(number, 4))


def coerce_expertise(value: Column) -> Column:
    level = F.lower(strip(value))
    return F.when(level.isin(*EXPERTISE), level)


def coerce_list(items: Column) -> Column:
    """Trimmed, non-empty texts; null becomes an empty list."""
    trimmed = F.transform(items.cast("array<string>"), strip)
    return F.coalesce(F.filter(trimmed, lambda item: item != ""), F.array().cast("array<string>"))


def coerce_language(value: Column) -> Column:
    spoken = F.when(value != "", value)
    return F.coalesce(F.substring(F.lower(strip(spoken)), 1, 5), F.lit("en"))


# --- the contract --------------------------------------------------------------

def check_analyzed(
    df: DataFrame,
    payload: str | None = None,
    now: Column | None = None,
) -> DataFrame:
    """ANALYZED columns (coerced) plus ``errors``; extra input columns are kept.

    With ``payload`` the fields come from that VARIANT column, otherwise from
    the columns of the same names.
    """
    now = F.current_timestamp() if now is None else now
    extra = [name for name in df.columns if name not in (*ANALYZED.names, "errors", payload)]
    if payload:
        df, cells = _read_payload(df, payload)
    else:
        cells = {name: _typed_cell(df, name) for name in ANALYZED.names}
    broken_rules: dict[str, Column] = {}

    def reject(name: str, broken: Column) -> None:
        broken_rules[name] = F.when(broken, F.lit(name))

    def text(name: str, low: int, high: int | None, required: bool) -> Column:
        cell = cells[name]
        size = F.length(cell.value)
        wrong = ~cell.typed
        if required:
            wrong = wrong | cell.value.isNull()
        if high is not None:
            wrong = wrong | F.coalesce(~size.between(low, high), F.lit(False))
        reject(name, wrong)
        return cell.value

    def label(name: str, allowed: Iterable[str], default: str | None) -> Column:
        cell = cells[name]
        value = cell.value if default is None else F.when(cell.present, cell.value).otherwise(F.lit(default))
        reject(name, ~F.coalesce(value.isin(*allowed), F.lit(False)))
        return value

    def flag(name: str, default: bool | None) -> Column:
        cell = cells[name]
        if default is None:
            reject(name, ~cell.typed)
            return cell.value
        value = F.when(cell.present, cell.value).otherwise(F.lit(default))
        reject(name, value.isNull())
        return value

    df = df.withColumns({
        "_score": let(cells["sentiment_score"].value, coerce_score),
        "_share": let(cells["confidence_score"].value, coerce_confidence),
        "_rating": let(cells["reviewer_rating"].value, coerce_rating),
    })
    reject("sentiment_score", F.col("_score").isNull())
    reject("confidence_score", F.col("_share").isNull())
    source_id = strip(cells["source_id"].value)
    reject("source_id", F.coalesce(source_id, F.lit("")) == "")
    language = coerce_language(cells["language_detected"].value)
    reject("language_detected", F.length(language) < 2)
    reviewed, analyzed = cells["review_date"], cells["analyzed_at"]
    reject("review_date", ~reviewed.typed)
    analyzed_at = F.when(analyzed.present, analyzed.value).otherwise(now)
    reject("analyzed_at", analyzed_at.isNull())

    columns = {
        "source_id": source_id,
        "product_name": text("product_name", 1, 200, True),
        "product_category": label("product_category", CATEGORIES, "unknown"),
        "product_id": text("product_id", 0, None, False),
        "sentiment": label("sentiment", SENTIMENTS, None),
        "sentiment_score": F.col("_score"),
        "confidence_score": F.col("_share"),
        "review_date": reviewed.value,
        "summary": text("summary", 10, 500, True),
        **{name: coerce_list(cells[name].value) for name in ("key_topics", "pros", "cons")},
        "reviewer_rating": F.col("_rating"),
        "is_verified_purchase": flag("is_verified_purchase", None),
        "reviewer_expertise": coerce_expertise(cells["reviewer_expertise"].value),
        "urgency_level": label("urgency_level", URGENCIES, "low"),
        "action_required": flag("action_required", False),
        "action_notes": text("action_notes", 0, 300, False),
        "mentioned_competitors": coerce_list(cells["mentioned_competitors"].value),
        "data_quality": label("data_quality", QUALITIES, "medium"),
        "language_detected": language,
        "is_spam_or_fake": flag("is_spam_or_fake", False),
        "analyzed_at": analyzed_at,
    }
    # Findings are listed in the order of the fields.
    errors = [broken_rules[name] for name in ANALYZED.names if name in broken_rules]
    checked = df.select(
        *extra,
        *[columns[name].alias(name) for name in ANALYZED.names],
        F.array_compact(F.array(*errors)).alias("errors"),
    )
    return apply_business_rules(checked)


def apply_business_rules(df: DataFrame) -> DataFrame:
    """Escalation and quality rules over coerced columns, in their fixed order."""
    escalated = df.withColumn(
        "_escalate",
        F.coalesce(
            (F.col("sentiment") == "negative")
            & (F.col("reviewer_rating") <= 2.0)
            & (F.col("urgency_level") == "low"),
            F.lit(False),
        ),
    )
    return escalated.withColumns({
        "urgency_level": F.when(F.col("_escalate"), F.lit("high")).otherwise(F.col("urgency_level")),
        "action_required": F.when(
            F.col("_escalate") | (F.col("urgency_level") == "critical"), F.lit(True)
        ).otherwise(F.col("action_required")),
        "data_quality": F.when(F.col("is_spam_or_fake"), F.lit("low")).otherwise(F.col("data_quality")),
    }).drop("_escalate")
