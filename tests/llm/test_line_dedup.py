import random
import re
import sys
from pathlib import Path

import pytest
from compare import both, connect

sys.path.insert(0, str(Path(__file__).parent))
from llm_data import ODD, documents, words

from opinara.llm.line_dedup import MIN_WORDS, dedup_lines
from opinara.llm.queries import ORACLES, QUERIES


def split(line):
    return tuple(word for word in re.split(r"[ \t\x0b\f\r]+", line) if word)


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def slow(texts):
    """Every line against every earlier one."""
    seen, out = [], []
    for text in texts:
        kept, removed, total = [], 0, 0
        for line in text.split("\n"):
            row = split(line)
            total += bool(row)
            if row and any(
                row == one or (min(len(row), len(one)) >= MIN_WORDS and near(row, one)) for one in seen
            ):
                removed += 1
            else:
                kept.append(line)
            if row:
                seen.append(row)
        out.append((total, removed, "\n".join(kept)))
    return out


def edited(rng, line):
    row, place = list(line), rng.randrange(len(line))
    kind = rng.randrange(4)
    if kind == 0:
        row[place] = "changed"
    elif kind == 1:
        row.insert(place, "added")
    elif kind == 2 and len(row) > 1:
        del row[place]
    return row


@pytest.mark.parametrize("seed", range(3))
def test_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    lines = [words(rng.random(), rng.choice([3, 9, 10, 11, 12, 25]), 30) for _ in range(25)]
    texts = []
    for _ in range(60):
        rows = [edited(rng, rng.choice(lines)) for _ in range(rng.randrange(1, 6))]
        lines += rows[:1]
        texts.append("\n".join(rng.choice([" ", "  ", "\t"]).join(row) for row in rows))
    found = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in dedup_lines(documents(spark, texts)).collect()}
    assert [found[i] for i in range(len(texts))] == slow(texts)


def test_odd_texts_and_columns(spark):
    docs = documents(spark, ODD)
    found = {r.doc_id: r for r in dedup_lines(docs).collect()}
    assert len(found) == len(ODD) and dedup_lines(docs).columns == [*docs.columns, "n_lines", "n_removed"]
    assert found[0].text is None and found[1].text == "" and found[2].text == ODD[2]
    assert found[4].n_removed == 0 and found[5].n_removed == 1 and found[5].text == ""


def test_repeated_rows_and_null_keys(spark):
    docs = documents(spark, ["a\nb", "a\nb", "b\nc", "d\nb"], [1, 1, None, 3])
    rows = sorted((str(r.doc_id), r.text) for r in dedup_lines(docs).collect())
    # Nulls come first; the copies of document 1 share one result.
    assert rows == [("1", "a"), ("1", "a"), ("3", "d"), ("None", "b\nc")]


def test_empty_table(spark):
    assert dedup_lines(documents(spark, [])).count() == 0


def test_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    ours, theirs = both(spark, connect(folder), QUERIES["op6_line_dedup"], ORACLES["op6_line_dedup"], folder)
    assert ours == theirs
