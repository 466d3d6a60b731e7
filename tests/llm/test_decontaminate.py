import random
import sys
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).parent))
from llm_data import ODD, documents, words

import opinara.llm.decontaminate as leak
from opinara.llm.decontaminate import common_length, find_leaks, leaked_pairs, words_of
from opinara.llm.queries import QUERIES


def slow_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_common_length_equals_the_table():
    rng = random.Random(3)
    for _ in range(100):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 40))] for _ in range(2))
        assert common_length(a, b) == slow_common(a, b)


def items(spark, texts, ids=None):
    rows = [(i, x, "l", 1) for i, x in zip(ids or range(len(texts)), texts, strict=True)]
    return spark.createDataFrame(rows, "item_id long, text string, leaks string, doc_id int")


def changed(rng, row, share):
    """Words of ``row`` replaced, dropped or followed by another one."""
    out = []
    for word in row:
        if rng.random() < share:
            out += rng.choice([[], ["other"], [word, "more"]])
        else:
            out.append(word)
    return out


def slow_pairs(texts, asked):
    """All stretches of SPREAD times an item's length, aligned with every item."""
    found = set()
    for i, text in enumerate(texts):
        row = words_of(text)
        for j, item in enumerate(asked):
            item = words_of(item)
            span = -(-len(item) * 3 // 2)
            best = max((slow_common(item, row[k:k + span]) for k in range(0, max(1, len(row) - span + 1))), default=0)
            if item and best >= (leak.ALIKE if len(item) >= leak.SHORT_ITEM else 1) * len(item):
                found.add((i, j))
    return found


def test_recall_against_brute_force(spark):
    rng = random.Random(11)
    asked = [" ".join(words(100 + i, rng.randrange(12, 45), 900)) + "." for i in range(25)] + ["short one here", None, "", "zz yy xx ww vv"]
    texts = []
    for number in range(90):
        row = words(1000 + number, rng.randrange(30, 250), 900)
        if number % 3 == 0:
            place = rng.randrange(len(row))
            row[place:place] = changed(rng, (asked[number % 25] or "").rstrip(".").split(), rng.choice([0, 0, 0.06, 0.1]))
        texts.append(" ".join(row).upper() if number % 9 == 0 else " ".join(row))
    texts += ["a short one here b", "a short one her b"]
    found = {(r.doc_id, r.item_id) for r in leaked_pairs(find_leaks(documents(spark, texts), items(spark, asked))).collect()}
    want = slow_pairs(texts, [x or "" for x in asked])
    assert len(want) > 20 and found <= want | {pair for pair in found if pair[0] % 3 == 0}
    assert len(found & want) >= 0.9 * len(want)


def test_paraphrase_needs_the_answer(spark):
    rng = random.Random(2)
    first, answer = words(7, 26, 500), ["berlin", "paris", "rome", "oslo"]
    item = " ".join(first) + ". " + " ".join(answer) + "."
    looser = [word if number % 4 else "new" for number, word in enumerate(first)]
    lost = " ".join(words(8, 40, 500) + looser + answer + words(9, 40, 500))
    other = " ".join(words(8, 40, 500) + looser + list(reversed(answer)) + words(9, 40, 500))
    clean = [" ".join(words(50 + n, 200, 500)) for n in range(20)]
    assert rng and slow_pairs([lost, other], [item]) == set()
    found = leaked_pairs(find_leaks(documents(spark, [lost, other, *clean]), items(spark, [item]))).collect()
    assert [(r.doc_id, r.item_id) for r in found] == [(0, 0)]


def test_paraphrase_between_other_items(spark):
    """A text that lists many items: heavy words beside a passage do not turn it away."""
    answers = [["berlin", "paris", "rome", "oslo"][n:] + ["berlin", "paris", "rome", "oslo"][:n] for n in range(4)] + [["bern", "kiev", "rome"]]
    rows = [words(70 + n, 30, 300) for n in range(5)]
    texts = [" ".join(row) + ". " + " ".join(answer) + "." for row, answer in zip(rows, answers, strict=True)]
    looser = " ".join([word if number % 4 else "new" for number, word in enumerate(rows[2])] + answers[2])
    listed = " ".join([texts[0], texts[1], looser, texts[3], texts[4]])
    clean = [" ".join(words(50 + n, 200, 300)) for n in range(20)]
    assert slow_pairs([looser], texts) == set()
    found = leaked_pairs(find_leaks(documents(spark, [listed, looser, *clean]), items(spark, texts))).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(0, n) for n in range(5)} | {(1, 2)}


def test_cosine_is_that_of_the_best_window():
    rng = np.random.default_rng(4)
    basis = rng.normal(size=(50, 8))
    items_ = [rng.integers(0, 50, 12).tolist() for _ in range(3)]
    idf = rng.uniform(1, 3, 50)
    vectors = np.array([idf[item] @ basis[item] for item in items_])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    index = leak.Index({}, idf, items_, [[]] * 3, [leak.Block(0, basis, vectors)])

    def plain(number, row):
        row = row[row >= 0]
        vector = idf[row] @ basis[row]
        return float(vectors[number] @ vector / np.linalg.norm(vector)) if len(row) else 0.0

    for number in range(3):
        row = rng.integers(-1, 50, 90)
        row[41:53] = items_[number]
        every = [plain(number, row[p:p + width]) for width in (12, 18, 90) for p in range(90 - width + 1)]
        assert 0.9999 < index.cosine(number, row) <= max(every) + 1e-6
        assert plain(number, row) < 0.9
        short = row[:7]
        assert abs(index.cosine(number, short) - max(0.0, plain(number, short))) < 1e-6
        assert index.cosine(number, np.full(5, -1)) == index.cosine(number, row[:0]) == 0.0


def test_clean_and_leaked_documents_of_a_table(spark):
    folder = "/root/testdata/sf0.001"
    found = {(r.doc_id, r.item_id) for r in QUERIES["op2_decontamination"](spark, folder).collect()}
    docs = {r.doc_id: " ".join(words_of(r.text)[0:] and [w.decode() for w in words_of(r.text)]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    asked = {r.item_id: " ".join(w.decode() for w in words_of(r.text)) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    exact = {(i, j) for i, text in docs.items() for j, item in asked.items() if f" {item} " in f" {text} "}
    assert exact and exact <= found and len(found) <= len(exact) + 2


def test_groups_and_repeated_items(spark, monkeypatch):
    monkeypatch.setattr(leak, "GROUP_ITEMS", 3)
    monkeypatch.setattr(leak, "BLOCK_ITEMS", 2)
    asked = [" ".join(words(300 + i, 20, 600)) for i in range(7)]
    texts = [f"x {item} y" for item in asked]
    ids = [10, 11, 12, None, 14, 15, 16, 10, 20]
    found = leaked_pairs(find_leaks(documents(spark, texts), items(spark, [*asked, asked[0], asked[1]], ids))).collect()
    pairs = sorted((r.doc_id, str(r.item_id)) for r in found)
    assert pairs == sorted([*[(i, str(ids[i])) for i in range(7)], (0, "10"), (1, "20")])


def test_odd_rows_and_empty_tables(spark):
    docs = documents(spark, ODD, [None, 1, 1, 2, 3, 3, 4])
    asked = items(spark, ["same text here again", "x"])
    found = find_leaks(docs, asked)
    assert found.count() == len(ODD) and found.columns == [*(c for c in docs.columns if c != "leaks"), "leaks"]
    assert sorted((r.doc_id, r.item_id) for r in leaked_pairs(found).collect()) == [(2, 1), (3, 0), (3, 0)]
    assert leaked_pairs(find_leaks(docs, items(spark, []))).count() == 0
    assert find_leaks(documents(spark, []), asked).count() == 0


def test_space_counts_every_passage_of_every_text(spark):
    """A'A from all texts, long and repeated ones too, equals the product of the passages written out."""
    texts = [" ".join(words(seed, 30 + 40 * seed, 50)) for seed in range(12)] + [" ".join(words(1, 20_000, 50))] * 2 + ODD
    names = sorted({word.encode() for text in texts[:12] for word in text.split()})[::2]
    terms, window = {name: number for number, name in enumerate(names)}, 30
    sent = spark.sparkContext.broadcast(terms)
    counts, passages, together = leak._passage_counts(documents(spark, texts), "text", sent, len(terms), window)
    rows = []
    for text in texts:
        found = words_of(text)
        rows += [np.bincount([terms[w] for w in found[start:start + window] if w in terms], minlength=len(terms)) for start in range(0, len(found), window)]
    plain = np.array(rows, float)
    assert passages == len(plain) and counts.tolist() == (plain > 0).sum(axis=0).tolist()
    idf, right = np.linspace(1, 2, len(terms)), np.random.default_rng(1).standard_normal((len(terms), 7))
    want = (plain * idf).T @ ((plain * idf) @ right)
    assert np.allclose(leak._normal_product(together, idf, right), want, rtol=1e-4, atol=1e-3 * np.abs(want).max())
