"""Packing into fixed windows by order-preserving dynamic programming.

Documents stay in the order of their partition. The tokens of a block of
documents form a line; cuts may lie at document ends (free), after sentence
ends (cheap) and, where a sentence is longer than MOST_GAP and near the end of
the block, anywhere else (dear). A window between two cuts costs its padding,
the price of the cut that ends it and a little for being one more window. As
padding is a constant minus the window's length, the best window ending at p
starts where cost(q) + q is smallest among the last ``window`` tokens: a
monotone queue gives that in constant time. Lengths that are a power of two
need no padding and are tried besides.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import bounded_batches

WINDOW = 2048
END_ID = 1
# Prices in tokens of padding: a cut after a sentence, a cut within one, a window.
SENTENCE_CUT, HARD_CUT, ONE_WINDOW = 4, 32, 16
# A sentence longer than this many tokens can be cut inside, at every such step.
MOST_GAP = 256
# Documents are gathered up to this many tokens; a longer one is cut into such blocks.
BLOCK = 1 << 18
# The tokenizer's special token, the pattern its words are split by, and characters that
# every version of the Unicode tables puts into the same classes.
SPECIAL = "<|endoftext|>"
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KNOWN = [*map(chr, (9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x250)))]
SENTENCE_ENDS = (".", "!", "?", "Ċ")


class Encoder:
    """Ids of a tokenizer file.

    ``ranks`` may name the same vocabulary as merge ranks: encoding by ranks
    gives the same ids some six times faster. Texts with a character outside
    KNOWN or with the special token go to the tokenizer itself. Without a
    tokenizer file, the public byte-level one and its ranks are used.
    """

    def __init__(self, tokenizer: str | None = None, ranks: str | None = None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if tokenizer is None:
            import public_tokenizers

            tokenizer = public_tokenizers.path("byte_bpe_50k.json")
            ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
        self.whole = Tokenizer.from_file(str(tokenizer))
        self.fast = None
        if ranks is not None:
            import tiktoken

            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=merges, special_tokens={}).encode_ordinary
        self.strange = re.compile(f"[^{re.escape(''.join(KNOWN))}]|{re.escape(SPECIAL)}").search
        size = self.whole.get_vocab_size()
        self.ends = np.array([(self.whole.id_to_token(token) or "").endswith(SENTENCE_ENDS) for token in range(size)])

    def encode(self, text: str) -> np.ndarray:
        if self.fast is None or self.strange(text):
            ids = self.whole.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast(text)
        ids.append(END_ID)
        return np.array(ids, "<u4")


def cuts(prices: dict[int, int], total: int, window: int = WINDOW) -> list[int]:
    """The cheapest cuts of ``total`` tokens, 0 and ``total`` included; ``prices``: where one may cut, at what price."""
    places = sorted(place for place in prices if 0 < place < total) + [total]
    far = float("inf")
    cost = [far] * (total + 1)
    cost[0] = 0
    came = {}
    powers = [1 << k for k in range(window.bit_length()) if 1 << k <= window]
    # Short windows only help to use up the end.
    usual, end = [power for power in powers if 16 * power >= window], total - window
    queue = deque([(0, 0)])  # (cost + place, place), rising in both
    for place in places:
        while queue and queue[0][1] < place - window:
            queue.popleft()
        best, start = far, -1
        if queue:
            value, start = queue[0]
            best = value + window - place
        for power in usual if place < end else powers:
            if power > place:
                break
            if cost[place - power] < best:
                best, start = cost[place - power], place - power
        if start >= 0:
            best += ONE_WINDOW + (prices.get(place, 0) if place < total else 0)
            cost[place] = best
            came[place] = start
            value = best + place
            while queue and queue[-1][0] >= value:
                queue.pop()
            queue.append((value, place))
    path = [total]
    while path[-1]:
        path.append(came[path[-1]])
    return path[::-1]


def cut_prices(ids: np.ndarray, doc_ends: list[int], sentence_end: np.ndarray, window: int) -> dict[int, int]:
    total = len(ids)
    sentences = np.flatnonzero(sentence_end[ids]) + 1
    stops = np.unique(np.concatenate((sentences, doc_ends, [0, total])).astype(np.int64))
    most = min(MOST_GAP, max(1, window // 2))
    gaps = np.flatnonzero(np.diff(stops) > most)
    inside = [place for gap in gaps.tolist() for place in range(int(stops[gap]) + most, int(stops[gap + 1]), most)]
    prices = dict.fromkeys(inside, HARD_CUT)
    prices |= dict.fromkeys(range(max(1, total - window), total), HARD_CUT)
    prices |= dict.fromkeys(sentences.tolist(), SENTENCE_CUT)
    prices |= dict.fromkeys(doc_ends, 0)
    return prices


def pack(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
    tokenizer: str | None = None, ranks: str | None = None, with_ids: bool = True,
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if wanted, ids.

    A document's tokens are the tokenizer's ids and END_ID; a null text counts
    as empty and is END_ID alone. Every token lies in exactly one piece; pieces
    of a sequence have gapless offsets from 0 and at most ``window`` tokens
    together. ``ids`` holds the piece's ids as little-endian 32-bit numbers.
    Repeated rows and null keys are documents like others; other columns are
    not read. There is no shuffle: each partition packs its rows in their
    order, a block in memory at a time, and numbers its sequences from
    partition id * 2**33, so a lost task is redone alone. ``tokenizer`` and
    ``ranks`` are files on the workers (see Encoder).
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    names = ["k", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, ranks)
        sequence = TaskContext.get().partitionId() << 33
        waiting: list[tuple] = []  # (key, first token here, tokens here, all tokens of the document)
        filled = 0
        kind_of_key = None

        def flush() -> pa.RecordBatch:
            nonlocal sequence, filled
            ids = np.concatenate([part[2] for part in waiting])
            ends = np.cumsum([len(part[2]) for part in waiting]).tolist()
            final = [end for end, part in zip(ends, waiting, strict=True) if part[1] + len(part[2]) == part[3]]
            data = ids.astype("<u4").tobytes()
            rows = []
            number, begin = 0, 0
            path = cuts(cut_prices(ids, final, encoder.ends, window), len(ids), window)
            for left, right in zip(path[:-1], path[1:], strict=True):
                place = left
                while place < right:
                    stop = min(right, ends[number])
                    owner, first, _, whole = waiting[number]
                    piece = data[4 * place:4 * stop]
                    rows.append((owner, first + place - begin, stop - place, zlib.crc32(piece), whole, sequence, place - left, piece))
                    place = stop
                    if stop == ends[number]:
                        begin = stop
                        number += 1
                sequence += 1
            waiting.clear()
            filled = 0
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(columns[0], kind_of_key), *(pa.array(column, pa.int64()) for column in columns[1:7])]
            if with_ids:
                arrays.append(pa.array(columns[7], pa.binary()))
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            kind_of_key = batch.schema.field(0).type
            keys = batch.column(0).to_pylist()
            for owner, value in zip(keys, batch.column(1), strict=True):
                ids = encoder.encode(value.as_py() or "")
                for first in range(0, len(ids), BLOCK):
                    part = ids[first:first + BLOCK]
                    waiting.append((owner, first, part, len(ids)))
                    filled += len(part)
                    if filled >= BLOCK:
                        yield flush()
        if waiting:
            yield flush()

    picked = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))
    schema = f"k {kind}, " + ", ".join(f"{name} long" for name in names[1:7]) + ", ids binary" * with_ids
    return picked.mapInArrow(work, schema).withColumnRenamed("k", key)
