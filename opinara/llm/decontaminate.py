"""Benchmark decontamination by latent semantic retrieval.

Passages are weighted by TF-IDF over the words of the benchmark (other words
bring no passage nearer to an item). A randomised SVD of all passages, from
sums over pairs of words that Spark adds up, gives a latent space; passages whose cosine with
an item is high enough are candidates. Each is then aligned with the item: the
longest common subsequence decides, and for looser paraphrases the item's
answer, its last sentence, has to be there too.

Only stretches that could pass the alignment are projected: one that misses at
most m of an item's words holds n - m of its n rarest words at least.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from opinara.llm.common import bounded_batches, keep, receive, send

# Items that share a latent space; items searched in one reading of the texts, and their words: a task counts all pairs of them.
BLOCK_ITEMS, GROUP_ITEMS, GROUP_WORDS = 200, 2000, 10_000
# Dimensions of the space and extra ones of the sketch.
RANK, EXTRA = 256, 16
# Shares of an item's words that the alignment has to cover: by itself, and with the answer.
ALIKE, LOOSE = 0.8, 0.7
# An item with fewer words has to be there whole; an answer with fewer words proves nothing.
SHORT_ITEM, SHORT_ANSWER = 8, 3
# Words of a passage for each word of the item, at most. Least cosine of a candidate.
SPREAD = 1.5
COSINE = 0.35
# Windows of a stretch start at every such part of their width.
STEPS = 8
# Terms whose row of counts moves together; pairs of terms laid out at once.
CHUNK, MET = 16, 500_000

# ASCII capitals become small, other ASCII signs except digits part words.
_PLAIN = bytes(
    code + 32 if 65 <= code <= 90 else code if code >= 128 or chr(code).isalnum() else 32 for code in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_PLAIN).split()


def common_length(item: list[int], row: list[int]) -> int:
    """Length of the longest common subsequence, the item's places as the bits of one number."""
    at: dict[int, int] = {}
    for place, word in enumerate(item):
        at[word] = at.get(word, 0) | 1 << place
    full = (1 << len(item)) - 1
    state = full
    for word in row:
        hit = state & at.get(word, 0)
        state = (state + hit | state - hit) & full
    return len(item) - state.bit_count()


def answer_of(text: str) -> list[bytes]:
    """The words of the last sentence."""
    parts = [words_of(part) for part in text.replace("!", ".").replace("?", ".").replace("\n", ".").split(".")]
    parts = [part for part in parts if part]
    return parts[-1] if len(parts) > 1 else []


@dataclass
class Block:
    """Items from ``first`` on with their latent space: a row of ``basis`` for each term, ``vectors`` of unit length."""

    first: int
    basis: np.ndarray
    vectors: np.ndarray


def numbers_of(words: list[bytes], terms: dict[bytes, int]) -> np.ndarray:
    return np.fromiter(map(terms.get, words, repeat(-1)), np.int32, len(words))


class Index:
    """A group of items ready for the search."""

    def __init__(self, terms: dict[bytes, int], idf: np.ndarray, items: list[list[int]], answers: list[list[int]], blocks: list[Block]) -> None:
        self.terms, self.idf, self.items, self.answers, self.blocks = terms, idf, items, answers, blocks
        sizes = np.array([len(item) for item in items])
        self.spans = np.ceil(SPREAD * sizes).astype(np.int64)
        missing = np.where(sizes < SHORT_ITEM, 0, np.floor((1 - LOOSE) * sizes + 1e-9)).astype(np.int64)
        # So many of the rarest words have to be there, out of as many more as may be missing.
        self.needs = np.minimum(np.ceil(0.1 * sizes).astype(np.int64) + 1, sizes - missing)
        rare = [
            sorted(set(sorted(item, key=lambda term: (-idf[term], term))[:need + lost]))
            for item, need, lost in zip(items, self.needs.tolist(), missing.tolist(), strict=True)
        ]
        pairs = sorted((term, number) for number, some in enumerate(rare) for term in some)
        self.owners = np.array([number for _, number in pairs], np.int64)
        self.counts = np.bincount([term for term, _ in pairs], minlength=len(terms))
        self.heads = np.cumsum(self.counts) - self.counts

    def passages(self, row: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, start, end): every stretch of the text with enough of an item's rare words, overlapping ones as one."""
        at = np.flatnonzero(row >= 0)
        times = self.counts[row[at]]
        at, times = at[times > 0], times[times > 0]
        if not len(at):
            return []
        place = np.repeat(at, times)
        inner = np.arange(len(place)) - np.repeat(np.cumsum(times) - times, times)
        owner = self.owners[np.repeat(self.heads[row[at]], times) + inner]
        order = np.argsort(owner, kind="stable")
        place, owner = place[order], owner[order]
        last = np.arange(len(place)) + self.needs[owner] - 1
        fits = last < len(place)
        first = np.flatnonzero(fits)
        last = last[fits]
        first, last = (side[(owner[first] == owner[last]) & (place[last] - place[first] < self.spans[owner[first]])] for side in (first, last))
        found: list[tuple[int, int, int]] = []
        for number, low, high in zip(owner[first].tolist(), place[first].tolist(), place[last].tolist(), strict=True):
            span = int(self.spans[number])
            start, end = max(0, high - span + 1), min(len(row), low + span)
            if found and found[-1][0] == number and start <= found[-1][2] and end - found[-1][1] <= 4 * span:
                found[-1] = (number, found[-1][1], end)
            else:
                found.append((number, start, end))
        return found

    def _accept(self, number: int, row: list[int], cosine: float) -> float:
        """The share of the item that the passage holds, 0 if that is too little."""
        item, answer = self.items[number], self.answers[number]
        share = common_length(item, row) / len(item)
        if len(item) < SHORT_ITEM:
            return share if share == 1 else 0.0
        if share >= ALIKE:
            return share
        whole = share >= LOOSE and len(answer) >= SHORT_ANSWER and any(
            row[start:start + len(answer)] == answer for start in range(len(row) - len(answer) + 1)
        )
        return share if whole and cosine >= 1.5 * COSINE else 0.0

    def cosine(self, number: int, part: np.ndarray) -> float:
        """The best cosine between the item and the windows of ``part``, of the item's length and of its span, or all of it.

        What stands beside the passage, such as other items, cannot turn the best window away.
        """
        block = self.blocks[number // BLOCK_ITEMS]
        known = np.flatnonzero(part >= 0)
        terms = part[known]
        sums = np.zeros((len(terms) + 1, block.basis.shape[1]))
        np.cumsum(self.idf[terms][:, None] * block.basis[terms], axis=0, out=sums[1:])
        best = 0.0
        for width in {len(self.items[number]), int(self.spans[number]), len(part)}:
            starts = np.arange(0, max(1, len(part) - width + 1), max(1, width // STEPS))
            starts = np.append(starts, max(0, len(part) - width))
            vectors = sums[np.searchsorted(known, starts + width)] - sums[np.searchsorted(known, starts)]
            lengths = np.sqrt((vectors * vectors).sum(axis=1))
            dots = vectors @ block.vectors[number - block.first]
            best = max(best, float((dots / np.where(lengths > 1e-9, lengths, np.inf)).max()))
        return best

    def search(self, text: str | None) -> dict[int, tuple[float, float]]:
        """(share, cosine) of each item found."""
        found: dict[int, tuple[float, float]] = {}
        row = numbers_of(words_of(text), self.terms)
        for number, start, end in self.passages(row):
            part = row[start:end]
            cosine = self.cosine(number, part)
            if cosine >= COSINE:
                # Parts of a long stretch are aligned one by one, as an item's words lie within its span.
                span = int(self.spans[number])
                share = max(
                    self._accept(number, part[place:place + 2 * span].tolist(), cosine)
                    for place in range(0, max(1, len(part) - span), span)
                )
                if share and share > found.get(number, (0.0, 0.0))[0]:
                    found[number] = (share, cosine)
        return found


def _passage_counts(docs: DataFrame, text: str, terms: Broadcast, size: int, window: int) -> tuple[np.ndarray, int, DataFrame]:
    """Passages with each term, passages, and by CHUNK terms how often every two terms stand in one passage.

    All texts count, cut into passages without overlap; of a pair the products of its counts are added up.
    The last is (first, cells, n): places in CHUNK rows of ``size`` cells and what stands there.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = terms.value
        counts, passages = np.zeros(size, np.int64), 0
        together = np.zeros(size * size, np.int32)
        for batch in batches:
            keys, before = [np.empty(0, np.int64)], 0
            for value in batch.column(0).to_pylist():
                row = numbers_of(words_of(value), known)
                places = np.flatnonzero(row >= 0)
                keys.append((places // window + before) * size + row[places])
                before += -(-len(row) // window)
            passages += before
            found, n = np.unique(np.concatenate(keys), return_counts=True)
            passage, term = np.divmod(found, size)
            counts += np.bincount(term, minlength=size)
            # Each entry meets all entries of its passage, itself included.
            heads = np.searchsorted(passage, passage)
            widths = np.searchsorted(passage, passage, side="right") - heads
            ends = np.cumsum(widths)
            start = 0
            while start < len(found):
                stop = max(start + 1, int(np.searchsorted(ends, ends[start] + MET, side="right")))
                width = widths[start:stop]
                one = np.repeat(np.arange(start, stop), width)
                two = np.arange(len(one)) + np.repeat(heads[start:stop] - (np.cumsum(width) - width), width)
                np.add.at(together, term[one] * size + term[two], (n[one] * n[two]).astype(np.int32))
                start = stop
        yield pa.RecordBatch.from_arrays([
            pa.array([-1], pa.int32()), pa.array([np.append(counts, passages).tobytes()], pa.binary()), pa.array([b""], pa.binary()),
        ], names=["first", "cells", "n"])
        for first in range(0, size, CHUNK):
            part = together[first * size:(first + CHUNK) * size]
            cells = np.flatnonzero(part)
            if len(cells):
                yield pa.RecordBatch.from_arrays([
                    pa.array([first], pa.int32()), pa.array([cells.astype(np.uint32).tobytes()], pa.binary()),
                    pa.array([part[cells].astype(np.int64).tobytes()], pa.binary()),
                ], names=["first", "cells", "n"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        first = rows["first"].iat[0]
        if first < 0:
            total = sum(np.frombuffer(part, np.int64) for part in rows["cells"])
            return pd.DataFrame({"first": [first], "cells": [total.tobytes()], "n": [b""]})
        total = np.zeros(CHUNK * size, np.int64)
        for cells, n in zip(rows["cells"], rows["n"], strict=True):
            total[np.frombuffer(cells, np.uint32)] += np.frombuffer(n, np.int64)
        cells = np.flatnonzero(total)
        return pd.DataFrame({"first": [first], "cells": [cells.astype(np.uint32).tobytes()], "n": [total[cells].tobytes()]})

    schema = "first int, cells binary, n binary"
    parts = docs.select(F.col(f"`{text}`").cast("string").alias("t")).mapInArrow(work, schema)
    added = keep(parts.groupBy("first").applyInPandas(add, schema))
    head = added.filter("first < 0").first()
    found = np.frombuffer(head.cells, np.int64) if head else np.zeros(size + 1, np.int64)
    return found[:-1], int(found[-1]), added.filter("first >= 0")


def _normal_product(together: DataFrame, idf: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A'A times ``right``, A the TF-IDF passages of all texts: each task has some rows of A'A."""
    size, width = right.shape
    sent = together.sparkSession.sparkContext.broadcast((idf[:, None] * right).astype(np.float32))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for cells, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                rows = np.zeros(CHUNK * size, np.float32)
                rows[np.frombuffer(cells, np.uint32)] = np.frombuffer(n, np.int64)
                parts.append((rows.reshape(CHUNK, size) @ sent.value).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(parts, pa.binary())], names=["first", "part"])

    found = np.zeros((-(-size // CHUNK) * CHUNK, width))
    for row in together.mapInArrow(work, "first int, part binary").toLocalIterator():
        found[row.first:row.first + CHUNK] = np.frombuffer(row.part, np.float32).reshape(CHUNK, width)
    return found[:size] * idf[:, None]


def _block(first: int, items: list[list[int]], idf: np.ndarray, together: DataFrame) -> Block:
    """The latent space of all passages and, so that none of them gets lost in it, of the items themselves."""
    own = np.zeros((len(items), len(idf)))
    for row, item in zip(own, items, strict=True):
        np.add.at(row, item, 1.0)
    own *= idf
    own /= np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-12)
    random = np.random.default_rng(7).standard_normal((len(idf), min(RANK + EXTRA, len(idf))))
    sketch = _normal_product(together, idf, random)
    # The items weigh as much as the passages do, whatever the texts hold.
    weight = max(float(np.abs(sketch).max()), 1.0)
    frame = np.linalg.qr(sketch + weight * own.T @ (own @ random))[0]
    second = _normal_product(together, idf, frame) + weight * own.T @ (own @ frame)
    values, turn = np.linalg.eigh((frame.T @ second + second.T @ frame) / 2)
    basis = frame @ turn[:, np.argsort(values)[::-1][:RANK]]
    vectors = own @ basis
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    return Block(first, basis.astype(np.float32), vectors.astype(np.float32))


def _index(docs: DataFrame, texts: list[str], text: str) -> Index:
    spelled = [words_of(item) for item in texts]
    terms = {word: number for number, word in enumerate(sorted(set().union(*spelled)))}
    items = [[terms[word] for word in item] for item in spelled]
    answers = [[terms.get(word, -1) for word in answer_of(item)] for item in texts]
    sent = docs.sparkSession.sparkContext.broadcast(terms)
    window = math.ceil(SPREAD * max(map(len, items)))
    counts, passages, together = _passage_counts(docs, text, sent, len(terms), window)
    idf = np.log((passages + 1) / (counts + 0.5))
    idf = np.maximum(idf, 0.05)
    blocks = [_block(first, items[first:first + BLOCK_ITEMS], idf, together) for first in range(0, len(items), BLOCK_ITEMS)]
    return Index(terms, idf, items, answers, blocks)


def find_leaks(
    docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``docs`` with a last column leaks: an array of (item, share, cosine), empty where nothing was found.

    An item leaks into a text if a passage holds LOOSE of its words in order
    together with its answer, or ALIKE of them; items of fewer than SHORT_ITEM
    words have to be there whole. The words lie within SPREAD times the item's
    length. ``share`` is the best such share. Null and empty texts have no leaks, null and wordless items find nothing, repeated
    items each have their entry, and rows do not depend on each other. All
    columns are handed on; one named leaks is replaced. The items are the query
    set: GROUP_ITEMS of them at a time are broadcast and held against all
    texts, so their number bounds what travels. The texts themselves never
    move. The latent space and the document frequencies are those of all
    texts, from one count of the pairs of items' words that share a passage.
    """
    bounded_batches(docs.sparkSession)
    schema = docs.drop("leaks").schema
    item_type = items.schema[item_key].dataType
    leak = f"struct<item:{item_type.simpleString()},share:double,cosine:double>"
    arrow = pa.list_(pa.struct([("item", to_arrow_type(item_type)), ("share", pa.float64()), ("cosine", pa.float64())]))
    found = docs.drop("leaks").withColumn("leaks", F.expr(f"cast(array() as array<{leak}>)"))
    chosen = items.select(F.col(f"`{item_key}`").alias("k"), F.col(f"`{item_text}`").alias("t")).filter("t is not null")
    sizes = chosen.agg(F.count("*").alias("items"), F.sum(F.size(F.split("t", r"\s+"))).alias("words")).first()
    groups = max(1, math.ceil(sizes.items / GROUP_ITEMS), math.ceil((sizes.words or 0) / GROUP_WORDS))
    for group in range(groups):
        # By text, so that groups keep about their size; ids may be null or repeat.
        rows = chosen.filter(F.pmod(F.xxhash64("t"), F.lit(groups)) == group).collect()
        rows = sorted((row for row in rows if words_of(row.t)), key=lambda row: (row.t, str(row.k)))
        if not rows:
            continue
        index = _index(docs, [row.t for row in rows], text)
        sent = send(docs.sparkSession, (index, [row.k for row in rows]))
        place = schema.fieldNames().index(text)

        def work(batches: Iterator[pa.RecordBatch], sent: Broadcast = sent) -> Iterator[pa.RecordBatch]:
            index, keys = receive(sent)
            for batch in batches:
                leaks = []
                for value, before in zip(batch.column(place), batch.column(batch.num_columns - 1), strict=True):
                    hits = index.search(value.as_py())
                    leaks.append(before.as_py() + [
                        {"item": keys[number], "share": share, "cosine": cosine} for number, (share, cosine) in sorted(hits.items())
                    ])
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(leaks, arrow)], names=batch.schema.names)

        found = found.mapInArrow(work, found.schema)
    return found


def leaked_pairs(leaks: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row for each text and item found in it: key, item_id, share, cosine."""
    return leaks.select(F.col(f"`{key}`").alias("k"), F.explode("leaks").alias("one")).select(
        F.col("k").alias(key), F.col("one.item").alias("item_id"), "one.share", "one.cosine"
    )
