import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from llm_data import ODD, SF, documents

from opinara.llm import spelling
from opinara.llm.queries import QUERIES
from opinara.llm.spelling import near_pairs, roots, spelling_variants, text_runs, variants


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def slow(counts):
    """Every word against every other one."""
    out = {}
    for word, n in counts.items():
        close = [other for other in counts if other != word and near(word, other)]
        best = min(((-counts[other], other) for other in close), default=None)
        form = best[1] if best and -best[0] >= 5 * n else None
        out[word] = (n, len(close), form, counts[form] if form else None)
    ends = {}
    for word in out:
        end = word
        while out[end][2]:
            end = out[end][2]
        ends[word] = end
    return {word: (*out[word], ends[word]) for word in out}


def found(frame):
    rows = frame.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}


def crowd(seed, count, letters="abcd\u00e9\u00ff"):
    rng = random.Random(seed)
    made = {"".join(rng.choice(letters) for _ in range(rng.randint(6, 10))) for _ in range(count)}
    for word in list(made):
        row, k = list(word), rng.randrange(len(word))
        rng.choice([lambda: row.insert(k, rng.choice(letters)), lambda: row.__setitem__(k, rng.choice(letters))])()
        made.add("".join(row))
    # Chains of forms: each is five times as frequent as the one before.
    made |= {"chainx", "chaina", "chainab", "chainabc"}
    counts = {word: rng.choice([5, 6, 25, 30, 130, 700]) for word in sorted(made)}
    return counts | {"chainx": 5, "chaina": 30, "chainab": 200, "chainabc": 2000}


@pytest.mark.parametrize("block", [20_000, 15])
def test_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block)
    monkeypatch.setattr(spelling, "SHARD_CHARS", 2_000)
    counts = crowd(block, 350, "ab\u00e9")
    table = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    expected = slow(counts)
    assert found(variants(table)) == expected
    assert expected["chainx"][4] == "chainabc" and expected["chainx"][2] == "chaina"


@pytest.mark.parametrize("small", [0, 16])
def test_search_scheme(monkeypatch, small):
    monkeypatch.setattr(spelling, "SMALL", small)
    texts = sorted(crowd(small, 200, "abc"))
    queries = sorted(crowd(9, 200, "abcz")) + texts
    exact = np.array([len(q) - len(q) // 2 for q in queries])
    a, b = near_pairs(texts, queries, exact, np.zeros(len(queries), dtype=bool))
    swapped = {(queries[i], texts[j]) for i, j in zip(a, b, strict=True)}
    order = {letter: k for k, letter in enumerate(sorted(set("".join(texts))))}

    def later(q, t):
        place = next(k for k in range(len(q)) if q[k] != t[k])
        return place < len(q) // 2 and order[t[place]] > order.get(q[place], -1)

    assert swapped == {(q, t) for q in queries for t in texts if len(q) == len(t) and near(q, t) and later(q, t)}
    a, b = near_pairs(texts, queries, exact, np.ones(len(queries), dtype=bool))
    dropped = {(queries[i], texts[j]) for i, j in zip(a, b, strict=True)}
    assert dropped == {
        (q, q[:k] + q[k + 1:]) for q in queries for k in range(len(q) // 2) if q[:k] + q[k + 1:] in set(texts)
    }


def test_runs_of_a_text():
    rng = random.Random(3)
    text = " ".join("".join(rng.choice("ABcd\u00c9\u00e9\u00d7") for _ in range(rng.randint(4, 9))) for _ in range(3000))
    expected, changed = Counter(), 0
    for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text):
        run = "".join(c.lower() if c < "\x80" else c for c in run)
        mark = zlib.crc32(f"17:{run}".encode())
        if mark % 199 == 0:
            run, changed = run[:mark % len(run)] + run[mark % len(run) + 1:], changed + 1
        if len(run) >= 6:
            expected[run] += 1
    assert text_runs(17, text) == expected and changed > 5


def test_whole_query_on_the_smallest_table(spark):
    counts = Counter()
    for row in spark.read.parquet(f"{SF}/documents.parquet").collect():
        counts.update(text_runs(row.doc_id, row.text or ""))
    assert found(QUERIES["op13_spelling_variants"](spark, SF)) == slow({w: n for w, n in counts.items() if n >= 5})


def test_odd_texts_and_columns(spark):
    texts = [*ODD, "x" * 50_000, "Variant variant variant-VARIANT \u00c9variant variant variants " * 5]
    docs = documents(spark, texts, [None, *range(1, len(texts))])
    got = found(spelling_variants(docs))
    assert got["variant"][:2] == (25, 2) and got["variants"][0] == got["\u00c9variant"][0] == 5
    assert got["variants"][2:] == ("variant", 25, "variant") and "x" * 50_000 not in got
    assert found(spelling_variants(docs.union(docs)))["variant"][0] == 50
    assert found(spelling_variants(documents(spark, ["y" * 40_000] * 6)))["y" * 40_000] == (6, 0, None, None, "y" * 40_000)


def test_empty_tables(spark):
    assert found(spelling_variants(documents(spark, []))) == {}
    assert roots(spark.createDataFrame([("a", None)], "word string, form string")).count() == 0


def test_words_are_asked_in_bounded_numbers(monkeypatch):
    """The words of a shard are asked a few at a time, and the pairs are those of all at once."""
    rng = random.Random(5)
    texts = sorted({"".join(rng.choice("abc") for _ in range(7)) for _ in range(300)})
    exact, longer = np.full(len(texts), 3), np.zeros(len(texts), dtype=bool)
    whole = sorted(zip(*(side.tolist() for side in spelling.near_pairs(texts, texts, exact, longer)), strict=True))
    sizes, some = [], spelling._near_some
    monkeypatch.setattr(spelling, "ASKED_WORDS", 40)
    monkeypatch.setattr(spelling, "_near_some", lambda index, queries, *more: sizes.append(len(queries)) or some(index, queries, *more))
    assert sorted(zip(*(side.tolist() for side in spelling.near_pairs(texts, texts, exact, longer)), strict=True)) == whole
    assert max(sizes) <= 40 and sum(sizes) == len(texts) and len(whole) > 100
