"""Landed web records: posts with their comments, normalized to raw reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
_BODY_COLUMNS = ("comment_body", "post_body", "comment_name")
_PRIVATE_COLUMNS = ("comment_email",)
# What assembly adds for ordering; no part of the landed record.
_PLACE_COLUMNS = ("post_seq", "comment_place")


def assemble_comments(
    posts: DataFrame,
    comments: DataFrame,
    limit: int | None = None,
    comment_order: tuple[str, ...] = ("seq",),
    comments_per_post: int | None = None,
) -> DataFrame:
    """Posts joined with their comments; ``post_seq`` and ``comment_place`` give the order.

    posts(seq, id, title, body), comments(post_id, id, name, email, body, source_url
    and the order columns). Posts without an id or without comments give no
    row. With ``limit``, the first ``limit`` posts and ``limit`` rows in order;
    with ``comments_per_post``, the first so many comments of each post;
    without them, everything.

    That rank is limited before the comments are shuffled, so a post with very
    many comments sends no more than that per task. Without it, such a post is
    only a join key, which Spark splits when it is skewed.
    """
    has_id = ~falsy(F.col("id"), posts.schema["id"].dataType)
    if limit is None:
        usable = posts.filter(has_id)
    else:
        # The cap counts posts as fetched; one without an id uses up its place.
        usable = posts.orderBy("seq").limit(limit).filter(has_id)
        comments = comments.join(usable.select(F.col("id").alias("post_id")), "post_id", "left_semi")
    if comments_per_post is not None:
        rank = F.row_number().over(Window.partitionBy("post_id").orderBy(*comment_order))
        comments = comments.withColumn("_rank", rank).filter(F.col("_rank") <= comments_per_post)
    first = comments.select(
        "post_id",
        F.struct(*comment_order).alias("comment_place"),
        F.col("id").alias("comment_id"),
        F.col("name").alias("comment_name"),
        F.col("email").alias("comment_email"),
        F.col("body").alias("comment_body"),
        "source_url",
    )
    joined = first.join(
        usable.select(
            F.col("seq").alias("post_seq"),
            F.col("id").alias("post_id"),
            F.coalesce("title", F.lit("")).alias("post_title"),
            F.coalesce("body", F.lit("")).alias("post_body"),
        ),
        "post_id",
    )
    columns = (
        "post_seq", "comment_place", "post_id", "post_title", "post_body",
        "comment_id", "comment_name", "comment_email", "comment_body", "source_url",
    )
    if limit is None:
        return joined.select(*columns)
    return joined.select(*columns).orderBy("post_seq", "comment_place").limit(limit)


def falsy(value: Column, kind: T.DataType) -> Column:
    """Null, empty text or zero."""
    if isinstance(kind, T.StringType):
        return F.coalesce(value == "", F.lit(True))
    return F.coalesce(value == 0, F.lit(True))


def normalize(landed: DataFrame, index: str | Column, keep_email: bool = False) -> DataFrame:
    """Landed records to raw rows: review text, id, remaining columns as metadata.

    ``index`` is the record's position; it orders the result and names records
    that carry no id. Records without any text are dropped. Email addresses
    stay out of the metadata unless asked for.
    """
    kinds = {field.name: field.dataType for field in landed.schema.fields}
    position = F.col(index) if isinstance(index, str) else index

    def part(name: str, label: str) -> Column:
        if name not in kinds:
            return F.lit(None).cast("string")
        text = F.col(name).cast("string")
        return F.when(~falsy(F.col(name), kinds[name]), F.concat(F.lit(label), text))

    body, content = part("comment_body", "Review: "), part("post_body", "Content: ")
    text = F.concat_ws(
        "\n",
        part("post_title", "Title: "),
        part("comment_name", "Review Title: "),
        body,
        F.when(body.isNull(), content),
    )
    ids = [
        F.when(~falsy(F.col(name), kinds[name]), F.col(name).cast("string"))
        for name in ("comment_id", "post_id") if name in kinds
    ]
    left_out = {*_BODY_COLUMNS, *_PLACE_COLUMNS} | (set() if keep_email else set(_PRIVATE_COLUMNS))
    if isinstance(index, str):
        left_out.add(index)
    return (
        landed.select(
            position.cast("long").alias("ingest_seq"),
            F.coalesce(*ids, F.concat(F.lit("rec_"), position.cast("string"))).alias("source_id"),
            (F.col("source_url") if "source_url" in kinds else F.lit(None).cast("string")).alias("source_url"),
            text.alias("raw_text"),
            residual_map([name for name in kinds if name not in left_out]).alias("metadata"),
        )
        .filter(F.col("raw_text") != "")
    )


def residual_map(columns: list[str]) -> Column:
    """The given columns as one VARIANT object without its null members."""
    # Rendering to JSON leaves out null members.
    return F.parse_json(F.to_json(F.struct(*columns))) if columns else F.parse_json(F.lit("{}"))
