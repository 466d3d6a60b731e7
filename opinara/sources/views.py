"""Review-shaped views over the test tables (see FIXTURES.md, section 2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.functions.numeric import round_exact


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Analyzed reviews with every kind of flaw the cleaning has to handle."""
    events = table(spark, folder, "events")
    eid, value = F.col("event_id"), F.col("value")
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    return events.select(
        eid.alias("ingest_seq"),
        F.concat(F.lit("r"), F.when(eid % 11 == 0, eid - 1).otherwise(eid).cast("string")).alias("source_id"),
        F.concat(F.lit("product_"), (F.col("user_id") % 20).cast("string")).alias("product_name"),
        F.when(eid % 89 == 0, F.lit(None))
        .when(kind == "error", " Negative").when(kind == "view", "neutral")
        .when(kind == "click", "mixed").otherwise("positive").alias("sentiment"),
        F.when(eid % 6 == 0, " Books").when(eid % 6 == 1, "home_garden").otherwise("beauty").alias("product_category"),
        F.when(eid % 4 == 0, " EN").otherwise("tr").alias("language_detected"),
        round_exact((value - 50) / 50, 4).alias("sentiment_score"),
        F.when(eid % 97 != 0, (eid * 37) % 101 / 100).alias("confidence_score"),
        F.when(eid % 8 != 7, (eid % 7).cast("double")).alias("reviewer_rating"),
        (eid % 23 == 0).alias("is_spam_or_fake"),
        F.when((kind == "error") & (value > 150), "critical").when(kind == "error", "low")
        .otherwise("medium").alias("urgency_level"),
        F.when(eid % 3 == 0, "high").when(eid % 3 == 1, "medium").otherwise("low").alias("data_quality"),
        F.when(eid % 50 != 0, F.col("ts").cast("timestamp")).alias("review_date"),
        F.array(kind, F.concat(F.lit(" topic_"), (k % 12).cast("string")), F.lit(" ")).alias("key_topics"),
        F.when(k % 9 == 0, F.array(F.concat(F.lit("brand_"), (k % 4).cast("string"))))
        .otherwise(F.array(F.lit("nan"))).alias("mentioned_competitors"),
    )


def raw_reviews(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return documents.select(
        F.col("doc_id").alias("ingest_seq"),
        F.col("doc_id").cast("string").alias("source_id"),
        F.col("text").alias("raw_text"),
        F.to_variant_object(F.struct("source", "lang")).alias("metadata"),
    )


def posts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("Order "), "o_orderpriority").alias("title"),
        F.col("o_orderstatus").alias("body"),
    )


COMMENT_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def comments(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as comments; line numbers repeat, hence the four order columns."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("post_id"),
        F.col("l_partkey").alias("id"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("name"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string"), F.lit("@example.com")).alias("email"),
        # Every fifth comment has no body and falls back on the post.
        F.when(F.col("l_partkey") % 5 != 0, F.concat_ws(" ", "l_returnflag", "l_linestatus")).alias("body"),
        F.concat(F.lit("/posts/"), F.col("l_orderkey").cast("string"), F.lit("/comments")).alias("source_url"),
        *COMMENT_ORDER,
    )


# Word lists that occur in the invented documents.
TEST_NEGATIVE = ("at", "from", "les", "der")
TEST_POSITIVE = ("by", "are", "und", "los")


def drafts(spark: SparkSession, folder: str) -> DataFrame:
    """Analyzed records before validation, with a flaw for every rule of the contract."""
    events = table(spark, folder, "events")
    eid, value, kind = F.col("event_id"), F.col("value"), F.col("event_type")
    text = eid.cast("string")
    return events.select(
        eid.alias("ingest_seq"),
        F.when(eid % 41 == 0, "  ").otherwise(F.concat(F.lit("\t r"), text, F.lit("  "))).alias("source_id"),
        F.when(eid % 43 == 0, "").when(eid % 47 == 0, F.repeat(F.lit("x"), 201))
        .otherwise(F.concat(F.lit("product_"), (F.col("user_id") % 20).cast("string"))).alias("product_name"),
        F.when(eid % 37 == 0, "toys").when(eid % 2 == 0, "books").otherwise("home_garden").alias("product_category"),
        F.when(eid % 53 == 0, " Negative").when(kind == "error", "negative").when(kind == "view", "neutral")
        .when(kind == "click", "mixed").otherwise("positive").alias("sentiment"),
        F.when(eid % 59 == 0, "n/a").otherwise(((value - 50) / 50).cast("string")).alias("sentiment_score"),
        F.when(eid % 61 == 0, 150.0).when(eid % 3 == 0, ((eid * 37) % 101).cast("double"))
        .otherwise((eid * 37) % 101 / 100).alias("confidence_score"),
        F.when(eid % 50 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("review_date"),
        F.when(eid % 67 == 0, "too short").otherwise(F.concat(F.lit("Review of event "), text)).alias("summary"),
        F.concat(kind, F.lit(" , topic_"), (eid % 12).cast("string"), F.lit(", ")).alias("key_topics"),
        F.array(F.lit(" fast "), F.lit(""), kind).alias("pros"),
        F.when(eid % 4 == 0, F.concat((eid % 7).cast("string"), F.lit(".25")).cast("double"))
        .otherwise((eid % 7).cast("double")).alias("reviewer_rating"),
        F.when(eid % 5 == 0, " Expert ").when(eid % 5 == 1, "wizard").when(eid % 5 == 2, "novice")
        .alias("reviewer_expertise"),
        F.when((kind == "error") & (value > 150), "critical").when(kind == "error", "low")
        .when(eid % 71 == 0, "urgent").otherwise("medium").alias("urgency_level"),
        F.when(eid % 73 == 0, F.repeat(F.lit("y"), 301)).when(eid % 2 == 0, "call back").alias("action_notes"),
        F.when(eid % 3 == 0, "high").when(eid % 3 == 1, "medium").otherwise("low").alias("data_quality"),
        F.when(eid % 79 == 0, " e ").when(eid % 6 == 0, "").when(eid % 6 == 1, " EN-us-x ").otherwise("tr")
        .alias("language_detected"),
        (eid % 23 == 0).alias("is_spam_or_fake"),
    )


RECORDS_PER_REPLY = 10


def _answer(name: Column, size: Column) -> Column:
    """A model's record as JSON text: numbers spelled as texts and percent, lists as one text, a private key."""
    return F.parse_json(F.to_json(F.struct(
        name.alias("source_id"), F.lit("Product").alias("product_name"), F.lit("neutral").alias("sentiment"),
        F.lit("0.25").alias("sentiment_score"), F.lit(91).alias("confidence_score"),
        F.concat(F.lit("Text of "), size.cast("string"), F.lit(" characters.")).alias("summary"),
        F.lit("a, b").alias("key_topics"), F.lit(1).alias("_trace"),
    )))


def batch_answers(packed: DataFrame) -> DataFrame:
    """First answers: ids ending in 3 are missing, those ending in 7 come back under another id."""
    name = F.col("source_id")
    told = F.when(name.endswith("7"), F.concat(F.lit("other-"), name)).otherwise(name)
    return packed.filter(~name.endswith("3")).select("batch_no", "ingest_seq", _answer(told, F.lit(0)).alias("payload"))


def single_answers(rest: DataFrame) -> DataFrame:
    """Second answers, asked one by one: texts with the word "der" get one that lacks its sentiment."""
    answer = _answer(F.col("source_id"), F.length("raw_text"))
    broken = F.parse_json(F.to_json(F.struct("source_id")))
    return rest.select(
        "batch_no", "ingest_seq", F.when(F.contains("raw_text", F.lit(" der ")), broken).otherwise(answer).alias("payload")
    )


def replies(spark: SparkSession, folder: str) -> DataFrame:
    """Model replies of ten records each: plain, wrapped, fenced, cut off, mixed with text."""
    records = drafts(spark, folder)
    number = F.floor(F.col("ingest_seq") / RECORDS_PER_REPLY).cast("long")
    body = F.to_json(F.struct(*[name for name in records.columns if name != "ingest_seq"], F.lit("x").alias("_private")))
    grouped = (
        records.select(number.alias("batch_no"), F.struct("ingest_seq", body.alias("body")).alias("entry"))
        .groupBy("batch_no")
        .agg(F.sort_array(F.collect_list("entry")).alias("entries"))
        .select("batch_no", F.array_join("entries.body", ",\n").alias("items"))
    )
    items, style = F.col("items"), F.col("batch_no") % 5
    return grouped.select(
        "batch_no",
        F.when(style == 0, F.concat(F.lit("["), items, F.lit("]")))
        .when(style == 1, F.concat(F.lit('{"reviews": ['), items, F.lit("]}")))
        .when(style == 2, F.concat(F.lit("\n```json\n["), items, F.lit("]\n```  ")))
        .when(style == 3, F.concat(F.lit("["), items))
        .otherwise(F.concat(F.lit('["note", '), items, F.lit(", 17, null]"))).alias("response"),
    )
