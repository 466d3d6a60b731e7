"""Text helpers: trimming, words, token estimates, lexicon sentiment."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.functions.numeric import let, round_exact

# Every character Unicode text processing treats as white space. Spark's own
# trim removes blanks only and the \s class stops at ASCII.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
GAP = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"

# First bytes of everything in GAP that \s does not cover.
_RARE_GAP_BYTES = (
    b"\x1c", b"\x1d", b"\x1e", b"\x1f", b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80",
)

# The token estimate.
TOKENS_PER_WORD = 1.3
TOKENS_PER_MESSAGE = 4
TOKENS_PER_CONVERSATION = 2

# Sentiment word lists (English and Turkish).
NEGATIVE_WORDS = (
    "broken", "damaged", "terrible", "awful", "horrible", "worst", "defective", "disappointed",
    "poor", "bad", "slow", "difficult", "wrong", "missing", "fail", "failed", "useless", "garbage",
    "refund", "return", "cracked", "fake", "dead", "stopped", "kötü", "bozuk", "berbat", "korkunç",
    "sorun", "çalışmıyor", "bozuldu", "kırık", "hatalı", "eksik", "rezalet", "pahalı",
)
POSITIVE_WORDS = (
    "great", "excellent", "amazing", "love", "perfect", "fantastic", "outstanding", "best", "happy",
    "satisfied", "recommend", "good", "quality", "fast", "easy", "worth", "awesome", "superb",
    "reliable", "mükemmel", "harika", "süper", "memnun", "tavsiye",
)

# USD per 1,000 tokens, (input, output).
PRICE_PER_1K = {
    "gpt-4o-mini": (0.00015, 0.00060),
    "gpt-4o": (0.00500, 0.01500),
    "gpt-4": (0.03000, 0.06000),
    "claude-3-5-haiku-20241022": (0.00025, 0.00125),
    "claude-3-5-sonnet-20241022": (0.00300, 0.01500),
}
OUTPUT_TOKENS_PER_RECORD = 200
# A lexicon or price table of up to so many words or models is sent to all executors; a larger one is joined.
BROADCAST_WORDS = 1_000_000


@dataclass(frozen=True)
class Lexicon:
    negative: Sequence[str] = NEGATIVE_WORDS
    positive: Sequence[str] = POSITIVE_WORDS


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def words(text: Column, lower: bool = False) -> Column:
    """White-space separated words, none of them empty; no words for null.

    The full class costs three times the ASCII one, so it is used only on
    texts whose bytes may hold one of the rarer characters.
    """
    raw = text.cast("binary")
    rare = reduce(or_, [F.contains(raw, F.lit(piece)) for piece in _RARE_GAP_BYTES])
    source = F.coalesce(F.lower(text) if lower else text, F.lit(""))
    pieces = F.when(rare, F.split(source, GAP)).otherwise(F.split(source, r"\s+"))
    return F.filter(pieces, lambda word: word != "")


def token_count(text: Column) -> Column:
    return F.ceil(F.size(words(text)) * F.lit(TOKENS_PER_WORD)).cast("long")


def conversation_tokens(messages: DataFrame, key: str = "conv_id", text: str = "text") -> DataFrame:
    """Token total of every conversation, with the per-message and fixed overheads."""
    return messages.groupBy(key).agg(
        (
            F.sum(token_count(F.col(text)) + F.lit(TOKENS_PER_MESSAGE)) + F.lit(TOKENS_PER_CONVERSATION)
        ).alias("tokens")
    )


def cost_usd(model: Column, input_tokens: Column, output_tokens: Column) -> Column:
    """Estimated price; a model without a listed price costs nothing."""
    rates = F.create_map(
        *[
            part
            for name, (rate_in, rate_out) in PRICE_PER_1K.items()
            for part in (F.lit(name), F.struct(F.lit(rate_in).alias("i"), F.lit(rate_out).alias("o")))
        ]
    )
    rate = F.try_element_at(rates, model)
    cost = (
        input_tokens * F.coalesce(rate["i"], F.lit(0.0)) + output_tokens * F.coalesce(rate["o"], F.lit(0.0))
    ) / F.lit(1000.0)
    return round_exact(cost, 6)


def price_table(spark: SparkSession) -> DataFrame:
    """PRICE_PER_1K as a price table without limits in time."""
    rows = [(name, None, None, rate_in, rate_out) for name, (rate_in, rate_out) in PRICE_PER_1K.items()]
    return spark.createDataFrame(rows, "model string, valid_from timestamp, valid_to timestamp, input_price double, output_price double")


def cost_by_table(usage: DataFrame, prices: DataFrame, moment: str = "moment") -> DataFrame:
    """``usage`` (model, input_tokens, output_tokens, moment, ...) with ``cost_usd`` at the prices of that time.

    ``prices`` has (model, valid_from, valid_to, input_price, output_price) in
    USD per 1,000 tokens, valid from the first moment up to the second, which is
    not included; null is no limit. Ranges of a model must not overlap: the one
    that begins last counts. Without a price the cost is 0. The prices of a model
    are gathered in one row, a few dozen at most, so no usage row is doubled.
    """
    known = prices.groupBy("model").agg(F.sort_array(F.collect_list(F.struct(
        "valid_from", "valid_to", "input_price", "output_price",
    )), asc=False).alias("_prices"))
    small = known.count() <= BROADCAST_WORDS
    at = F.col(moment)
    valid = F.filter("_prices", lambda price: (price["valid_from"].isNull() | (price["valid_from"] <= at)) & (
        price["valid_to"].isNull() | (at < price["valid_to"])
    ))
    priced = usage.join(F.broadcast(known) if small else known, "model", "left").withColumn("_price", F.get(valid, F.lit(0)))
    cost = sum(
        (F.col(f"{side}_tokens") * F.coalesce(F.col("_price")[f"{side}_price"], F.lit(0.0)) for side in ("input", "output")), F.lit(0.0)
    ) / F.lit(1000.0)
    return priced.withColumn("cost_usd", round_exact(cost, 6)).drop("_prices", "_price")


def score_sentiment(df: DataFrame, lexicon: Lexicon = Lexicon(), text: str = "raw_text") -> DataFrame:
    """Add ``sentiment``, ``sentiment_score`` and ``urgency_level`` from word lists.

    Words are compared as a set and with their punctuation attached. The word
    lists travel inside the plan as constants, so this is a narrow projection.
    """
    vocabulary = F.array_distinct(words(F.col(text), lower=True))
    counts = let(vocabulary, lambda found: F.struct(
        _hits(found, lexicon.negative).alias("neg"),
        _hits(found, lexicon.positive).alias("pos"),
        F.size(found).alias("size"),
    ))
    rated = let(counts, lambda c: F.struct(
        c["neg"].alias("neg"), c["pos"].alias("pos"), c["size"].alias("size"),
        (c["neg"] / F.greatest(c["neg"] + c["pos"], F.lit(1))).alias("ratio"),
    ))
    return df.withColumn("_scored", let(rated, _verdict)).withColumns({
        name: F.col("_scored")[name] for name in ("sentiment", "sentiment_score", "urgency_level")
    }).drop("_scored")


def lexicon_table(spark: SparkSession, lexicon: Lexicon = Lexicon()) -> DataFrame:
    """(word, polarity, weight) of word lists, each word with weight 1."""
    rows = [(word, "negative", 1.0) for word in lexicon.negative] + [(word, "positive", 1.0) for word in lexicon.positive]
    return spark.createDataFrame(rows, "word string, polarity string, weight double")


def score_with_table(df: DataFrame, table: DataFrame, keys: Sequence[str] = ("source_id",), text: str = "raw_text") -> DataFrame:
    """``keys`` with the columns of ``score_sentiment``, for a lexicon of any size: (word, polarity, weight).

    A text's distinct words meet the table and their weights are added up per
    polarity; with weights of 1 the scores are those of the word lists. A word
    may have both polarities. ``keys`` have to tell the texts apart. Up to
    BROADCAST_WORDS words the table is sent to all executors, and all words of a
    text are added up where it was read. A larger one is joined by word; a word
    that most texts hold fills one key, which Spark splits (its side needs no
    order afterwards), and only words with their keys move, no texts.
    """
    known = table.groupBy("word").agg(
        *[F.sum(F.when(F.col("polarity") == name, F.col("weight")).otherwise(0.0)).alias(name) for name in ("negative", "positive")]
    )
    found = df.select(*keys, F.explode_outer(F.array_distinct(words(F.col(text), lower=True))).alias("word"))
    few = known.count() <= BROADCAST_WORDS
    met = found.join(F.broadcast(known) if few else known, "word", "left")
    counts = met.groupBy(*keys).agg(
        F.coalesce(F.sum("negative"), F.lit(0.0)).alias("neg"), F.coalesce(F.sum("positive"), F.lit(0.0)).alias("pos"),
        F.count("word").alias("size"),
    )
    ratio = F.col("neg") / F.greatest(F.col("neg") + F.col("pos"), F.lit(1.0))
    rated = counts.withColumn("_counts", F.struct("neg", "pos", "size", ratio.alias("ratio")))
    return rated.withColumn("_scored", let(F.col("_counts"), _verdict)).select(
        *keys, *[F.col("_scored")[name].alias(name) for name in ("sentiment", "sentiment_score", "urgency_level")]
    )


def _verdict(counts: Column) -> Column:
    neg, pos, size, ratio = (counts[name] for name in ("neg", "pos", "size", "ratio"))
    mostly_negative = ratio >= 0.7
    torn = ratio >= 0.4
    only_positive = (pos > 0) & (neg == 0)
    balance = F.lit(0.1) + (pos - neg) * F.lit(0.05)
    share = F.least(F.lit(0.3) + (pos / F.greatest(size, F.lit(1))) * F.lit(5.0), F.lit(0.95))
    exact = F.when(mostly_negative, -(F.lit(0.4) + ratio * F.lit(0.6))).when(torn, -ratio * F.lit(0.4)).when(
        only_positive, share
    ).otherwise(balance)
    return let(let(exact, lambda score: round_exact(score, 3)), lambda score: F.struct(
        F.when(mostly_negative, "negative").when(torn, "mixed").when(only_positive | (score > 0.15), "positive")
        .otherwise("neutral").alias("sentiment"),
        score.alias("sentiment_score"),
        F.when(ratio >= 0.85, "high").when(torn, "medium").otherwise("low").alias("urgency_level"),
    ))


def _hits(found: Column, vocabulary: Sequence[str]) -> Column:
    if not vocabulary:
        return F.lit(0)
    return F.size(F.array_intersect(found, F.array(*[F.lit(word) for word in vocabulary])))
