import random
import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from compare import both, connect

sys.path.insert(0, str(Path(__file__).parent))
from llm_data import ODD, SF, documents

from opinara.llm import collocations as module
from opinara.llm.collocations import Branch, PhraseTrie, by_language, collocations, phrase_hashes, words_of
from opinara.llm.collocations import bucket_filter, phrase_filter
from opinara.llm.common import receive
from opinara.llm.queries import ORACLES, QUERIES


def slow(rows, least, top):
    """Every phrase counted in one dictionary; (lang, text) rows."""
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if c < "\x80" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            row = re.findall("[^ \t]+", piece)
            total[lang] += len(row)
            for size in range(1, 6):
                for k in range(len(row) - size + 1):
                    counts[lang][tuple(row[k:k + size])] += 1
    out = []
    for lang, found in counts.items():
        often = {phrase: a for phrase, a in found.items() if len(phrase) > 1 and a >= least}
        covered = {
            longer[i:j] for longer, f in often.items() for i in range(len(longer)) for j in range(i + 2, len(longer) + 1)
            if j - i < len(longer) and f >= often[longer[i:j]]
        }
        scored = []
        for phrase in often.keys() - covered:
            a = often[phrase]
            score, k = min(
                (1000 * a * total[lang] // (found[phrase[:k]] * found[phrase[k:]]), k) for k in range(1, len(phrase))
            )
            scored.append((-score, -a, " ".join(phrase).encode(), found[phrase[:k]], found[phrase[k:]]))
        out += [
            (lang, rank, name.decode(), -a, left, right, total[lang], -score)
            for rank, (score, a, name, left, right) in enumerate(sorted(scored)[:top], 1)
        ]
    return sorted(out)


def texts(seed, count):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "New", "york", "\u00c9t\u00e9", "x\u00a0y", "a\x1cb", *("".join(rng.choice("abc") for _ in range(3)) for _ in range(30))]
    made = []
    for _ in range(count):
        row = []
        for _ in range(rng.randrange(60)):
            row += ["once", "upon", "a", "time", "there"][: rng.choice([3, 5, 5])] if rng.random() < 0.1 else [rng.choice(vocabulary)]
        made.append("".join(w + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "!? "]) for w in row))
    return made


def test_equals_slow_version(spark, monkeypatch):
    made = texts(1, 400)
    langs = [random.Random(k).choice(["en", "de", None, "und"]) for k in range(400)]
    frame = spark.createDataFrame(list(zip(langs, made, strict=True)), "lang string, text string").repartition(3)
    for top in (2000, 7):
        got = sorted(tuple(row) for row in collocations(frame, least=12, top=top).collect())
        assert got == slow(list(zip(langs, made, strict=True)), 12, top)
    assert any(row[2] == "once upon a time there" for row in got)
    # A filter that lets everything through loses nothing, nor do tasks that hold little.
    monkeypatch.setattr(module, "MOST_BITS", module.LEAST_BITS)
    monkeypatch.setattr(module, "BITS_PER_PHRASE", 0)
    monkeypatch.setattr(module, "HELD_PHRASES", 50)
    monkeypatch.setattr(module, "LEAST_PARTS", 2)
    assert sorted(tuple(row) for row in collocations(frame, least=12, top=7).collect()) == got


@pytest.mark.parametrize("size", [2, 4])
def test_trie_bursts_and_spills(size):
    rng = np.random.default_rng(size)
    trie, counts, out = PhraseTrie(size, burst=8), Counter(), Counter()
    words = [f"w{k}".encode() for k in range(12)]
    for lang in ("en", "de", "en"):
        ids = rng.integers(1, 12, 2000).astype(np.int32)
        places = np.sort(rng.choice(2000 - size, 900, replace=False))
        trie.add(lang, ids, places)
        for place in places:
            named = [words[k].decode() for k in ids[place:place + size]]
            counts[lang, " ".join(named[:-1]), named[-1]] += 1
        if size > 2:
            assert any(type(node) is Branch for node in trie.roots[lang].values())
        before, keep = trie.held, trie.held // 2
        run = list(trie.spill(words, keep))
        assert trie.held <= keep and len(run) == before - trie.held
        for lang_, prefix, last, n in run:
            out[lang_, prefix, last] += n
    for lang_, prefix, last, n in trie.spill(words):
        out[lang_, prefix, last] += n
    assert out == counts and trie.held == 0


def test_words_and_pieces(monkeypatch):
    monkeypatch.setattr(module, "HELD_BYTES", 12)
    batch = pa.RecordBatch.from_arrays([
        pa.array(["en", None, "en", "en", None]), pa.array(["Ab\tC. d\n\nE  f", "x", "", "g a-piece-longer-than-a-part \u00c9, h", None]),
    ], ["lang", "text"])
    seen = []
    for lang, plain in by_language(batch):
        words = words_of(plain)
        parts = [words.data[a:b].decode() for a, b in zip(words.starts, words.ends, strict=True)]
        seen.append((lang, list(zip(parts, words.pieces.tolist(), strict=True))))
    pieces = [[w for w, k in part if k == piece] for _, part in seen for piece in sorted({k for _, k in part})]
    assert pieces == [["ab", "c"], ["d"], ["e", "f"], ["g", "a-piece-longer-than-a-part", "\u00c9"], ["h"], ["x"]]
    assert [lang for lang, _ in seen][-1] == "und" and len(seen) > 3


def test_hashes_do_not_depend_on_the_place():
    one, two = words_of(b"a b c. x."), words_of(b"zz yy. zz q a  b c.")
    for size in (1, 2, 3):
        assert phrase_hashes(one, "en", size)[0] == phrase_hashes(two, "en", size)[4]
        assert phrase_hashes(one, "en", size)[0] != phrase_hashes(one, "de", size)[0]
    assert len(set(phrase_hashes(one, "en", 1))) == 4 and len(phrase_hashes(one, "en", 5)) == 0


@pytest.mark.parametrize("least", [5, 40])
def test_bucket_filter_never_denies(spark, monkeypatch, least):
    monkeypatch.setattr(module, "HELD_BUCKETS", 500)
    rows = [("en", text) for text in texts(5, 150)]
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    words = [(lang, word) for lang, text in rows for word in re.findall("[^ \t.,;:!?\n-\r]+", text.encode().lower().decode())]
    known = phrase_filter(spark.createDataFrame(sorted(set(words)), "lang string, phrase string"), 1)
    full = receive(bucket_filter(frame, 2, known, 10**7, least))
    pairs, hashes = Counter(), {}
    for lang, text in rows:
        found = words_of(text.replace("!? ", ". ").encode().translate(module.PLAIN) + b".")
        for k, value in enumerate(phrase_hashes(found, lang, 2)):
            if found.pieces[k] == found.pieces[k + 1]:
                pair = found.data[found.starts[k]:found.ends[k + 1]]
                pairs[pair] += 1
                hashes[pair] = int(value) % (len(full) * 8)
    inside = {pair for pair in pairs if full[hashes[pair] >> 3] >> (hashes[pair] & 7) & 1}
    often = {pair for pair, n in pairs.items() if n >= least}
    assert often and often <= inside and len(inside) < 1.05 * len(often) + 5


def test_products_beyond_64_bits(spark, monkeypatch):
    big = 3 * 10**12
    rows = {1: [("en", "", 10 * big), ("en", "a", big), ("en", "b", big + 7)], 2: [("en", "a b", big - 1)]}
    schema = "lang string, phrase string, n long"
    monkeypatch.setattr(module, "count_phrases", lambda docs, size, known, full, words, least: spark.createDataFrame(rows.get(size, []), schema))
    given = iter([rows[1], *(rows.get(size, []) for size in range(2, 6))])
    monkeypatch.setattr(module, "keep_table", lambda frame: spark.createDataFrame(next(given), schema))
    (row,) = module.collocations(documents(spark, ["x"])).collect()
    assert (row.a, row.l, row.r, row.n) == (big - 1, big, big + 7, 10 * big)
    assert row.score == 1000 * (big - 1) * 10 * big // (big * (big + 7))


def test_odd_texts_and_columns(spark):
    odd = [*ODD, "Same text here again. " * 300]
    got = {r.phrase: r for r in collocations(documents(spark, odd)).collect()}
    assert got["same text here again"].a == 302 and "same text" not in got and got["word word"].a == 29_999
    assert {r.rank for r in got.values()} == set(range(1, len(got) + 1))
    assert collocations(documents(spark, [])).count() == 0


def test_equals_sql(spark):
    ours, theirs = both(spark, connect(SF), QUERIES["op12_collocations"], ORACLES["op12_collocations"], SF)
    assert ours == theirs and len(ours[1]) > 20
