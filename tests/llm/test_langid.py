import random
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from llm_data import ODD, documents

import opinara.llm.langid as langid
from opinara.llm.common import in_part
from opinara.llm.langid import Automata, identify, training_sample
from opinara.llm.queries import QUERIES


def slow_phrases(known, text):
    """Greedy longest phrases of ``text`` that occur in ``known``, by searching the string."""
    count, place = 0, 0
    while place < len(text):
        size = 1
        while place + size < len(text) and text[place:place + size + 1] in known:
            size += 1
        count, place = count + 1, place + size
    return count


def test_automaton_cuts_the_longest_phrases():
    rng = random.Random(3)
    make = lambda letters, size: "".join(rng.choice(letters) for _ in range(size))
    known = {"a": make("abc ", 400).strip(), "b": make("bcd ", 300).strip()}
    texts = [make("abcd", 200) for _ in range(5)] + ["a", "bcbcbc"]
    automata = Automata({name: [text] for name, text in known.items()})
    phrases, letters = automata.phrases(texts)
    for row, name in zip(phrases, automata.names, strict=True):
        plain = " ".join(known[name].split())
        assert row.tolist() == [slow_phrases(plain, text) for text in texts]
    assert letters.tolist() == [len(text) for text in texts]


def test_long_texts_take_lanes_and_lose_little():
    automata = Automata({"a": ["the quick brown fox jumps over the lazy dog " * 5]})
    text = "the lazy dog jumps over the quick fox " * 300
    short, _ = automata.phrases([text[:langid.LANE]])
    long, _ = automata.phrases([text])
    lanes = -(-len(text.strip()) // langid.LANE)
    assert abs(int(long[0, 0]) - slow_phrases(("the quick brown fox jumps over the lazy dog " * 5).strip(), text)) <= lanes + 1
    assert short[0, 0] < long[0, 0]


@pytest.mark.parametrize("entries", [0, 30_000])
def test_search_equals_table(monkeypatch, entries):
    rng = random.Random(9)
    make = lambda first, count, size: "".join(rng.choice([chr(first + i) for i in range(count)] + [" "]) for _ in range(size))
    texts = {"la": [make(97, 12, 900)], "ru": [make(0x430, 30, 700)], "zh": [make(0x4E00, 500, 3000)], "ja": [make(0x4F00, 300, 900)]}
    asked = [text[0][30:400] for text in texts.values()] + [make(97, 20, 300), make(0x4E00, 600, 2500), "", "aжz 漢"]
    whole = Automata(texts)
    monkeypatch.setattr(langid, "TABLE_ENTRIES", entries)
    part = Automata(texts)
    assert not whole.searched and part.searched and bool(part.tabled) == bool(entries)
    assert (whole.phrases(asked)[0] == part.phrases(asked)[0]).all() and whole.judge(asked) == part.judge(asked)
    assert whole.judge(asked)[0][:4] == ["la", "ru", "zh", "ja"]
    for row, name in zip(whole.phrases(asked[:6])[0], whole.names, strict=True):
        plain = " ".join(texts[name][0].split())
        assert all(abs(n - slow_phrases(plain, " ".join(text.split()))) <= len(text) // langid.LANE + 1 for n, text in zip(row, asked[:6]))


def test_every_language_and_letter_is_learned(spark):
    """Seventy languages in four scripts, some with short texts only, one with a single very long one."""
    rng = random.Random(4)
    blocks = [(97, 26), (0x430, 32), (0x3B1, 24), (0x4E00, 3000)]
    rows, asked = [], []
    for number in range(70):
        first, count = blocks[number % 4]
        words = ["".join(chr(first + rng.randrange(count)) for _ in range(rng.randrange(2, 7))) for _ in range(25)]
        make = lambda size: " ".join(rng.choice(words) for _ in range(size))  # noqa: B023, E731
        name = f"l{number:02}"
        rows += [(make(20000 if number == 1 else 8 if number % 5 == 0 else 90), name) for _ in range(1 if number == 1 else 30)]
        asked.append((make(40), name))
    rows += [(None, "none"), ("", "none"), ("text", None)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    sample = training_sample(docs, F.lit(True))
    assert sorted(sample) == sorted({name for _, name in asked})
    assert max(map(len, sample["l01"])) == langid.SAMPLE_CHARS[1] and len(sample["l05"]) > langid.SAMPLE_ROWS
    found = identify(spark.createDataFrame(asked, "text string, lang string"), sample, ("lang",)).collect()
    assert all(row.lang == row.lang_pred for row in found) and len(found) == 70


def test_sample_stays_within_its_total(spark, monkeypatch):
    docs = spark.createDataFrame([(f"{name} " * 200 + str(n), name) for name in ("ab", "cd") for n in range(9)], "text string, lang string")
    monkeypatch.setattr(langid, "TOTAL_CHARS", 3001)
    sample = training_sample(docs, F.lit(True))
    assert {name: sum(map(len, texts)) for name, texts in sample.items()} == {"ab": 1500, "cd": 1500}


def test_und_ties_and_unknown_letters():
    automata = Automata({"x": ["abc abc"], "w": ["abc abc"]})
    names, scores, lengths = automata.judge(["abc", "", "123 !?", "жжжжжжжж", "ABC"])
    assert names[0] == names[4] == "w" and names[1] == names[2] == "und" and scores[1] == 0
    assert lengths[3] <= 1 and all(0 <= score <= 1 for score in scores)
    assert Automata({}).judge(["abc"])[0] == ["und"]


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op5_language_id"](spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", F.length("text").alias("size"))
    rows = found.join(docs, "doc_id").filter("held_out").collect()
    right = np.mean([row.lang == row.lang_pred for row in rows])
    assert len(rows) > 250 and right > 0.97
    assert all(row.lang == row.lang_pred for row in rows if row["size"] > 2000)


def test_sample_is_bounded_and_skips_copies(spark):
    rng = random.Random(1)
    texts = ["copy " * 60] * 50 + [" ".join(rng.choice(["un", "deux", "trois"]) for _ in range(80)) for _ in range(60)]
    docs = documents(spark, texts).withColumn("lang", F.when(F.col("doc_id") < 90, "fr"))
    sample = training_sample(docs, ~in_part(F.col("doc_id"), 3, 1))
    assert list(sample) == ["fr"] and len(sample["fr"]) <= langid.SAMPLE_ROWS and len(set(sample["fr"])) == len(sample["fr"])
    held = {text for number, text in enumerate(texts) if docs is not None and number >= 90}
    assert not held & set(sample["fr"])


def test_odd_rows_and_empty_tables(spark):
    texts = {"en": ["the cat sat on the mat"], "de": ["die katze sass auf der matte"]}
    docs = documents(spark, ODD, [None, 1, 1, 2, 3, 3, 4])
    found = identify(docs, texts)
    assert found.columns == ["doc_id", "lang_pred", "score", "letters_per_phrase"] and found.count() == len(ODD)
    assert [r.lang_pred for r in found.orderBy("doc_id").collect()][:3] == ["und"] * 3
    assert identify(documents(spark, []), texts).count() == 0
    assert training_sample(documents(spark, []), F.lit(True)) == {}
