import random
import re
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from llm_data import ODD, documents, words

from opinara.llm.quality import Bands, quality_rules, repeated_words


def slow_repeats(row):
    windows = Counter(tuple(row[i:i + 5]) for i in range(len(row) - 4))
    return len({i + j for i in range(len(row) - 4) if windows[tuple(row[i:i + 5])] > 1 for j in range(5)})


@pytest.mark.parametrize("seed", range(8))
def test_repeats_equal_brute_force(seed):
    rng = random.Random(seed)
    row = [str(rng.randrange(rng.choice([1, 2, 3, 50]))).encode() for _ in range(rng.randrange(0, 300))]
    assert repeated_words(row) == slow_repeats(row)


def test_repeats_with_more_words_than_one_number_holds():
    row = [str(number).encode() for number in range(9000)] + [b"a", b"b", b"c", b"d", b"e"] * 2
    assert repeated_words(row) == slow_repeats(row) == 10


def test_counts_and_verdicts(spark):
    texts = [
        " ".join(words(1, 300)), "#$ aé|b\n\n x \nx\nx \n" + " ".join(words(2, 40)), "ab " * 900,
        "".join(chr(33 + (i * i * 7919 + i * 31) % 90) + (" " if i % 7 == 0 else "") for i in range(4000)), *ODD,
    ]
    rows = {row.doc_id: row for row in quality_rules(documents(spark, texts)).collect()}
    assert len(rows) == len(texts)
    for number, text in enumerate(texts):
        text, row = text or "", rows[number]
        found = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
        repeats = slow_repeats(found)
        assert (row.n_words, row.word_chars, row.n_symbols) == (len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)))
        assert (row.n_dup_lines, row.n_repeat_words) == (len(lines) - len(set(lines)), repeats)
        assert row.base_failed == (len(found) < 10 or 100 * repeats > 20 * len(found))
        assert not (row.kept and row.base_failed)
    assert rows[0].kept and not rows[2].kept


def test_bands_follow_length_and_chunks(spark):
    assert Bands().inside(100, 3.5) and not Bands().inside(600, 3.5)
    half_noise = " ".join(words(3, 800)) + " ".join(f"w{i % 3}" for i in range(9000))
    row = quality_rules(documents(spark, [half_noise])).first()
    assert row.n_chunks > 2 and row.n_bad_chunks > 0.25 * row.n_chunks and not row.kept


def test_empty_table(spark):
    assert quality_rules(documents(spark, [])).count() == 0
