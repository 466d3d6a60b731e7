import random
import sys
import zlib
from collections import defaultdict
from itertools import combinations
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
from llm_data import ODD, documents, words

import opinara.llm.packing as packing
from opinara.llm.packing import Encoder, cuts, pack


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))


def own_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


STRANGE = [
    "a<|endoftext|>b", "  two  spaces \n\n x", "it's 'tis ''s x'll 12½ ²", "日本語 text é nbsp", "\x1c\x85 a", "", " ", "😀 ok...\t\t.",
    "İstanbul Ǆ ǅ ʰ", "a​b", "Ж" * 50, "don't\r\n\r\n", "ÄÖÜß ñ ¿qué? ¡sí!", "x" * 3000, "º ª ¹ ²³",
]


def test_ids_are_the_tokenizers(tokenizer):
    encoder = Encoder()
    slow = Encoder(str(public_tokenizers.path("byte_bpe_50k.json")))
    rng = random.Random(1)
    mixed = ["".join(rng.choice(packing.KNOWN) for _ in range(200)) for _ in range(100)]
    for text in STRANGE + mixed:
        assert encoder.encode(text).tolist() == slow.encode(text).tolist() == own_ids(tokenizer, text)


def cost(path, prices, total, window):
    found = 0
    for left, right in zip(path[:-1], path[1:], strict=True):
        size = right - left
        if size > window:
            return None
        found += packing.ONE_WINDOW + (0 if size & (size - 1) == 0 else window - size)
        found += prices.get(right, 0) if right < total else 0
    return found


@pytest.mark.parametrize("seed", range(6))
def test_cuts_cost_the_least(seed):
    rng = random.Random(seed)
    window, total = 16, 40
    prices = {place: rng.choice([0, 2, 9]) for place in rng.sample(range(1, total), 10)} | {13: 9, 27: 9}
    inner = sorted(prices)
    best = min(
        one for size in range(len(inner) + 1) for some in combinations(inner, size)
        if (one := cost([0, *some, total], prices, total, window)) is not None
    )
    assert cost(cuts(prices, total, window), prices, total, window) == best


def check(rows, texts, tokenizer, window=2048):
    """Every token once and in order, sequences gapless and within the window; the share of padding."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for row in rows:
        assert zlib.crc32(row.ids) == row.ids_crc32 and len(row.ids) == 4 * row.length > 0
        pieces[row.doc_id].append(row)
        sequences[row.sequence_id].append(row)
    assert pieces.keys() == texts.keys()
    for key, some in pieces.items():
        some.sort(key=lambda row: row.start)
        assert [row.start for row in some] == [0, *np.cumsum([row.length for row in some])[:-1]]
        ids = np.frombuffer(b"".join(row.ids for row in some), "<u4").tolist()
        assert ids == own_ids(tokenizer, texts[key]) and {row.doc_tokens for row in some} == {len(ids)}
    padding = total = 0
    for some in sequences.values():
        some.sort(key=lambda row: row.offset)
        assert [row.offset for row in some] == [0, *np.cumsum([row.length for row in some])[:-1]]
        size = sum(row.length for row in some)
        assert size <= window
        total += size
        padding += 0 if size & (size - 1) == 0 else window - size
    return padding / (total + padding)


def test_round_trip(spark, tokenizer):
    rng = random.Random(8)
    texts = [" ".join(words(seed, rng.randrange(0, 900))) + rng.choice([".", "!\n", ""]) for seed in range(60)] + STRANGE + ODD
    rows = pack(documents(spark, texts).repartition(3)).collect()
    assert check(rows, dict(enumerate(texts)), tokenizer) < 0.05


def test_order_and_little_padding_on_a_table(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").coalesce(1)
    rows = pack(docs).collect()
    assert check(rows, {row.doc_id: row.text for row in docs.collect()}, tokenizer) < 0.01
    order = [row.doc_id for row in docs.collect()]
    place = {key: number for number, key in enumerate(order)}
    found = [place[row.doc_id] for row in sorted(rows, key=lambda row: (row.sequence_id, row.offset))]
    assert found == sorted(found)


def test_blocks_cut_long_texts(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 1000)
    texts = ["word " * 5000, "a. " * 700, "end"]
    check(pack(documents(spark, texts).coalesce(1), window=128).collect(), dict(enumerate(texts)), tokenizer, 128)


def test_repeated_rows_null_keys_and_empty_table(spark):
    rows = pack(documents(spark, ["a b", "a b", None], [None, None, 3]), with_ids=False).collect()
    assert sum(row.length for row in rows if row.doc_id is None) == 6 and [r.doc_tokens for r in rows if r.doc_id == 3] == [1]
    assert pack(documents(spark, [])).count() == 0
    assert pack(documents(spark, []), with_ids=False).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
