import math
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from opinara.functions import text as text_functions
from opinara.functions.numeric import round_exact, round_scaled, steady_mean
from opinara.functions.text import WHITESPACE, cost_usd, score_sentiment, strip, token_count, words


def _numbers():
    rng = random.Random(7)
    ties = [k / 2 ** p for p in range(1, 8) for k in range(-40, 40)]
    halves = [round(n / 1000 + 0.0005, 6) for n in range(-3000, 3000, 7)] + [4.35, 4.15, 0.15, 2.675, 1.005, 0.285]
    return ties + halves + [rng.uniform(-5, 5) for _ in range(500)]


@pytest.mark.parametrize("digits", [1, 2, 3, 4, 6])
def test_round_exact_is_python_round(spark, digits):
    values = _numbers()
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for value, got in df.select("v", round_exact(F.col("v"), digits)).collect():
        assert got == round(value, digits), value


@pytest.mark.parametrize("digits", [2, 4])
def test_round_scaled_is_array_round(spark, digits):
    values = _numbers()
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(round_scaled(F.col("v"), digits)).collect()]
    assert got == list(np.round(values, digits) + 0.0)


def test_rounding_keeps_null(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert df.select(round_exact(F.col("v"), 2), round_scaled(F.col("v"), 2)).first() == (None, None)


def test_steady_mean_ignores_order_and_partitions(spark):
    rng = random.Random(3)
    values = [round(rng.uniform(-1, 1), 4) for _ in range(5000)]
    expected = sum(round(v * 10000) for v in values) / 10000 / 5000
    for parts in (1, 4, 16):
        df = spark.createDataFrame([(v,) for v in rng.sample(values, 5000)], "v double").repartition(parts)
        assert df.agg(steady_mean(F.col("v"))).first()[0] == expected
    wide = spark.createDataFrame([(1e18,), (2e18,), (None,)], "v double")
    assert wide.agg(steady_mean(F.col("v"))).first()[0] == 1.5e18


TEXTS = ["", "   ", "one", " two  words ", "a\tb\nc", "x y　z", "p\x85q r s", "tab\x1cfs", "é à–b", None]


def test_words_and_strip_follow_unicode(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    found = df.select("i", words(F.col("t")), strip(F.col("t")), token_count(F.col("t"))).orderBy("i").collect()
    for (i, got, trimmed, tokens), text in zip(found, TEXTS):
        assert got == (text or "").split()
        assert trimmed == (text.strip() if text is not None else None)
        assert tokens == math.ceil(len((text or "").split()) * 1.3)
    assert all(c.isspace() for c in WHITESPACE)
    assert [chr(c) for c in range(0x110000) if chr(c).isspace()] == sorted(WHITESPACE)


def test_lexicon_golden_rows(spark):
    data = [
        ("neg_en", "Title: Broken Product\nReview: This product is terrible and completely broken. Terrible experience!"),
        ("neg_tr", "Title: Kötü Ürün\nReview: Bu ürün berbat ve tamamen bozuk çıktı. Çok kötü bir deneyim yaşadım."),
        ("pos_en", "Title: Great Product\nReview: This product is absolutely amazing and works perfectly well."),
        ("plain", "Title: Product 1\nReview: This is a detailed review about product 1."),
        ("stuck", "terrible. broken, useless!"),
    ]
    scored = score_sentiment(spark.createDataFrame(data, "source_id string, raw_text string"))
    got = {r["source_id"]: (r["sentiment"], r["sentiment_score"], r["urgency_level"]) for r in rows(scored)}
    assert got["neg_en"] == ("negative", -1.0, "high")
    assert got["neg_tr"] == ("negative", -1.0, "high")
    assert got["pos_en"] == ("positive", 0.95, "low")
    assert got["plain"] == ("neutral", 0.1, "low")
    assert got["stuck"] == ("neutral", 0.1, "low")


def test_cost(spark):
    df = spark.createDataFrame([("gpt-4o-mini", 1000, 500), ("nobody", 1000, 500)], "m string, i long, o long")
    got = [r[0] for r in df.select(cost_usd(F.col("m"), F.col("i"), F.col("o"))).collect()]
    assert got == [round((1000 * 0.00015 + 500 * 0.0006) / 1000, 6), 0.0]


def test_means_of_any_magnitude(spark):
    from opinara.operators.kpi import safe_mean

    for values in ([9e8] * 1000, [1e9, 3e9], [1e12, -1e12, 3e12], [0.1] * 10, [1e300, 1e300], [-5e17, 5e17, 3.0], [None, 2.0]):
        frame = spark.createDataFrame([(value,) for value in values], "v double").repartition(3)
        known = [value for value in values if value is not None]
        want = math.fsum(known) / len(known)
        assert frame.agg(safe_mean("v").alias("m")).first()["m"] == pytest.approx(want, rel=1e-12)


@pytest.mark.parametrize("bound", [1_000_000, 0])
def test_lexicon_table_equals_word_lists(spark, monkeypatch, bound):
    monkeypatch.setattr(text_functions, "BROADCAST_WORDS", bound)
    lists = text_functions.Lexicon()
    rng = random.Random(2)
    pool = [*lists.negative, *lists.positive, "plain", "words", "Great", "bad,", "the"]
    texts = [None, "", " \n ", *(" ".join(rng.choice(pool) for _ in range(rng.randrange(12))) for _ in range(200))]
    # A very frequent word, and a table far larger than the lists.
    df = spark.createDataFrame([(k, None if t is None else t + " the") for k, t in enumerate(texts)], "k int, raw_text string")
    more = spark.range(20_000).selectExpr("concat('w', id) AS word", "'negative' AS polarity", "1.0D AS weight")
    table = text_functions.lexicon_table(spark, lists).unionByName(more)
    names = ["k", "sentiment", "sentiment_score", "urgency_level"]
    assert sorted(text_functions.score_with_table(df, table, ("k",)).select(names).collect()) == sorted(
        text_functions.score_sentiment(df, lists).select(names).collect()
    )


def test_lexicon_weights(spark):
    table = spark.createDataFrame([("meh", "negative", 0.25), ("ok", "positive", 0.5), ("odd", "negative", 2.0), ("odd", "positive", 3.0)], "word string, polarity string, weight double")
    df = spark.createDataFrame([(1, "meh ok"), (2, "odd")], "k int, raw_text string")
    found = {r.k: (r.sentiment, r.sentiment_score) for r in text_functions.score_with_table(df, table, ("k",)).collect()}
    # 0.25 of at least 1 is no tear; 0.1 + 0.25 * 0.05 is stored a little above 0.1125. Two of five is a tear: -0.4 * 0.4.
    assert found == {1: ("neutral", 0.113), 2: ("mixed", -0.16)}


def test_prices_by_time(spark):
    prices = spark.sql("""SELECT * FROM VALUES ('m', NULL, TIMESTAMP '2024-01-01', 1.0D, 2.0D), ('m', TIMESTAMP '2024-01-01', NULL, 3.0D, 4.0D),
        ('n', TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-01', 5.0D, 0.0D) AS t(model, valid_from, valid_to, input_price, output_price)""")
    usage = spark.sql("""SELECT model, TIMESTAMP(day) AS moment, 1000L AS input_tokens, 500L AS output_tokens FROM VALUES ('m', '2023-12-31'),
        ('m', '2024-01-01'), ('n', '2023-01-01'), ('n', '2024-01-31'), ('n', '2024-02-01'), ('x', '2024-01-01'), ('m', NULL) AS t(model, day)""")
    found = sorted((r.model, str(r.moment)[:10], r.cost_usd) for r in text_functions.cost_by_table(usage, prices).collect())
    assert found == [
        ("m", "2023-12-31", 2.0), ("m", "2024-01-01", 5.0), ("m", "None", 0.0),
        ("n", "2023-01-01", 0.0), ("n", "2024-01-31", 5.0), ("n", "2024-02-01", 0.0), ("x", "2024-01-01", 0.0),
    ]
