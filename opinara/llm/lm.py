"""Language-model scoring with a log-frequency Bloom filter.

Counts of words and word pairs are quantised on a logarithmic scale. The filter
holds a member (n-gram, j) for every step j up to the n-gram's own, so that
asking for steps 1, 2, ... until one is missing gives the quantised count. Its
size follows the members, so that one rule holds for a corpus of any size: all
words are in it and all pairs that occur twice. (``build_filter`` also makes
one of a fixed size, which leaves the rarest steps out if need be.) Pairs are interpolated with words, with a
weight for each step of the context's count: the share of the corpus's tokens
after such contexts whose pair occurs elsewhere too.

Beside it stands the plain unigram score, from exact counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import bounded_batches, keep, receive, send

# The filter: blocks (a power of two, the fewest of a growing filter), bits of one block (a power of two), hash functions.
BLOCKS, BLOCK_BITS, PROBES = 64, 1 << 22, 5
# Members it takes at half its bits set, and the part of them meant for words.
MEMBERS = int(BLOCKS * BLOCK_BITS * math.log(2) / PROBES)
WORD_PART = 0.4
BASE = 1.5
# A pair that occurs once says nothing about other texts.
LEAST_PAIR_STEP = 1
# The most frequent words, up to this many, whose exact counts are broadcast; the others meet theirs in a join.
FREQUENT = 400_000
# Entries gathered by a task before they are handed on.
GATHERED_WORDS, GATHERED_PAIRS = 400_000, 2_000_000
REMEMBERED = 500_000
# Slots for keys whose step is at least KNOWN_STEP, a power of two; lower steps are as soon asked for as remembered.
SLOTS, KNOWN_STEP = 1 << 19, 2
# Texts scored at once.
SCORED_ROWS = 250
SEED = 42
START, END = 0, 1
# Any two numbers that no word's hash is likely to have.
MARKS = (0x5851F42D4C957F2D, 0x14057B7EF767814F)
WORD, PAIR = 0, 1


def mix(value: np.ndarray) -> np.ndarray:
    value = (value ^ value >> np.uint64(31)) * np.uint64(0x7FB5D329728EA185)
    value = (value ^ value >> np.uint64(27)) * np.uint64(0x81DADEF4BC2DD44D)
    return value ^ value >> np.uint64(33)


def pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The upper half names the context, so that a pair's context can be told from its key."""
    upper = first & np.uint64(0xFFFFFFFF00000000)
    return upper | mix(first * np.uint64(0x9E3779B97F4A7C15) + second) >> np.uint64(32)


def steps(count: Column) -> Column:
    """The step of a count: 0 for 1, then one more for each factor BASE."""
    return F.floor(F.log(BASE, count) + 1e-9).cast("int")


def typical(step: np.ndarray) -> np.ndarray:
    """The middle of the counts of a step; 0 below step 0."""
    low = np.ceil(BASE**step - 1e-9)
    high = np.maximum(low, np.ceil(BASE ** (step + 1.0) - 1e-9) - 1)
    return np.where(step < 0, 0.0, np.sqrt(low * high))


def places(keys: np.ndarray, kind: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """First bit and stride, within its block, of the members (key, step)."""
    member = mix(keys + np.uint64((kind + 1) * 0x632BE59BD9B4E019 + step * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF))
    return member & np.uint64(BLOCK_BITS - 1), member >> np.uint64(32) | np.uint64(1)


# ``typical`` of the steps from -1 on.
TYPICAL = typical(np.arange(-1.0, 128.0))


class Known:
    """Steps of keys asked before, one key a slot: the pairs that occur often are asked for again and again."""

    def __init__(self) -> None:
        self.keys = np.zeros(SLOTS, np.uint64)
        self.steps = np.full(SLOTS, -1, np.int16)


@dataclass
class Model:
    bits: np.ndarray  # uint8, block after block
    lowest: tuple[int, int]  # the first step held of words and of pairs
    tokens: int
    kinds: int
    documents: int
    weights: np.ndarray = field(default_factory=lambda: np.zeros(128))  # by step of the context's count

    def step(self, keys: np.ndarray, kind: int) -> np.ndarray:
        """The step of each key's count, -1 if the filter has none."""
        found = np.full(len(keys), -1, np.int16)
        live = np.arange(len(keys))
        step = self.lowest[kind]
        offsets = (keys & np.uint64(len(self.bits) * 8 // BLOCK_BITS - 1)) * np.uint64(BLOCK_BITS)
        while len(live):
            place, stride = places(keys[live], kind, step)
            for _ in range(PROBES):
                bit = offsets[live] + (place & np.uint64(BLOCK_BITS - 1))
                there = (self.bits[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                live, place, stride = live[there], place[there] + stride[there], stride[there]
            found[live] = step
            step += 1
        return found

    def step_again(self, keys: np.ndarray, kind: int, known: Known) -> np.ndarray:
        """The same as ``step``, with what ``known`` remembers of earlier calls for this kind."""
        slot = (keys >> np.uint64(13) & np.uint64(SLOTS - 1)).astype(np.int64)
        found = np.where(known.keys[slot] == keys, known.steps[slot], np.int16(-1))
        new = np.flatnonzero(found < 0)
        asked = found[new] = self.step(keys[new], kind)
        often = new[asked >= KNOWN_STEP]
        known.keys[slot[often]], known.steps[slot[often]] = keys[often], found[often]
        return found


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


class Numbers(dict):
    """Numbers of words in the order they are met; START and END have the first two."""

    def __init__(self) -> None:
        super().__init__()
        self.names: list[bytes] = [b"", b""]

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.names)
        self.names.append(word)
        return number


class Reader:
    """Turns texts into rows of token numbers; what is known of each distinct word is looked up once."""

    def __init__(self, model: Model | None, frequent: dict[bytes, int] | None = None) -> None:
        self.model, self.frequent = model, frequent or {}
        self.forget()

    def forget(self) -> None:
        self.number = Numbers()
        self.hashes = np.array(MARKS, np.uint64)
        ends = self.model.documents if self.model else 0
        self.step = np.full(2, int(math.log(ends, BASE) + 1e-9) if ends else -1, np.int16)
        self.count = np.array([0, ends], np.int64)

    def read(self, texts: list[str | None]) -> np.ndarray:
        """All texts as START, words, END."""
        row: list[int] = []
        number = self.number.__getitem__
        for text in texts:
            row.append(START)
            row.extend(map(number, split_words(text)))
            row.append(END)
        new = self.number.names[len(self.hashes):]
        if new:
            hashes = np.fromiter((xxhash.xxh64_intdigest(word, SEED) for word in new), np.uint64, len(new))
            self.hashes = np.concatenate((self.hashes, hashes))
            if self.model:
                self.step = np.concatenate((self.step, self.model.step(hashes, WORD)))
                known = np.fromiter(map(self.frequent.get, new, repeat(0)), np.int64, len(new))
                self.count = np.concatenate((self.count, known))
        return np.array(row, np.int64)

    def pairs(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(context, token, key) of each token of the texts."""
        inside = row[1:] != START
        first, second = row[:-1][inside], row[1:][inside]
        return first, second, pair_key(self.hashes[first], self.hashes[second])


def _texts(docs: DataFrame, text: str, *more: Column) -> DataFrame:
    return docs.select(*more, F.col(f"`{text}`").cast("string").alias("t"))


def count_ngrams(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, pair, n): every word's count, the end of a text being the empty word, and every pair's hash and count.

    Tasks count what they read before anything moves; a frequent n-gram sends
    one row a task.
    """
    bounded_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, counts, keys, held = Reader(None), np.zeros(2, np.int64), [], 0

        def rows(names: list[bytes] | None, pairs: np.ndarray | None, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for start in range(0, len(n), 100_000):
                part = slice(start, start + 100_000)
                size = len(n[part])
                yield pa.RecordBatch.from_arrays([
                    pa.array(names[part], pa.binary()).cast(pa.string()) if names is not None else pa.nulls(size, pa.string()),
                    pa.array(pairs[part].view(np.int64)) if pairs is not None else pa.nulls(size, pa.int64()),
                    pa.array(n[part], pa.int64()),
                ], names=["word", "pair", "n"])

        def flush_words() -> Iterator[pa.RecordBatch]:
            nonlocal counts
            # From the end on: the end of a text is the empty word.
            if counts[END]:
                yield from rows(reader.number.names[END:], None, counts[END:])
            reader.forget()
            counts = np.zeros(2, np.int64)

        def flush_pairs() -> Iterator[pa.RecordBatch]:
            nonlocal held
            if keys:
                found, n = np.unique(np.concatenate(keys), return_counts=True)
                yield from rows(None, found, n)
            keys.clear()
            held = 0

        for batch in batches:
            row = reader.read(batch.column(0).to_pylist())
            found = np.bincount(row, minlength=len(reader.hashes))
            found[:len(counts)] += counts
            counts = found
            keys.append(reader.pairs(row)[2])
            held += len(keys[-1])
            if len(counts) > GATHERED_WORDS:
                yield from flush_words()
            if held > GATHERED_PAIRS:
                yield from flush_pairs()
        yield from flush_words()
        yield from flush_pairs()

    # Tasks have added up what they can: the rows go to the keys' partitions first and are added there.
    parts = _texts(docs, text).mapInArrow(work, "word string, pair long, n long").repartition("word", "pair")
    return parts.groupBy("word", "pair").agg(F.sum("n").alias("n"))


def build_filter(counts: DataFrame, grow: bool = False) -> Model:
    """The filter of ``counts`` (word, pair, n), pairs of one occurrence left out.

    A filter that may ``grow`` has twice the blocks as often as its members
    need and leaves none out: 7.2 to 14.4 bits a member, BLOCKS blocks at
    least. Another one has BLOCKS blocks, and the rarest steps stay out if they
    do not fit. Only sums over steps reach the driver, and the finished blocks.
    A block is built by one task from at most its share of MEMBERS.
    """
    words, pairs = counts.filter("word is not null"), counts.filter("word is null")
    total = words.agg(F.sum("n").alias("tokens"), F.count("*").alias("kinds"), F.max(F.when(F.col("word") == "", F.col("n"))).alias("ends")).first()
    kind = F.when(F.col("word").isNull(), PAIR).otherwise(WORD)
    table = counts.groupBy(kind.alias("kind"), steps(F.col("n")).alias("step")).agg(F.count("*").alias("ngrams")).collect()
    lowest, blocks = [], BLOCKS
    for number, room in ((WORD, MEMBERS * WORD_PART), (PAIR, MEMBERS * (1 - WORD_PART))):
        sizes = {row.step: row.ngrams for row in table if row.kind == number}
        first = LEAST_PAIR_STEP if number == PAIR else 0
        while sum(n * (step - first + 1) for step, n in sizes.items() if step >= first) > room * blocks / BLOCKS:
            if grow:
                blocks *= 2
            else:
                first += 1
        lowest.append(first)
    first = F.when(F.col("kind") == PAIR, lowest[PAIR]).otherwise(lowest[WORD])
    members = (
        words.select(F.xxhash64("word").alias("key"), F.lit(WORD).alias("kind"), steps(F.col("n")).alias("step")).filter(F.col("word") != "")
        .union(pairs.select("pair", F.lit(PAIR), steps(F.col("n")))).filter(F.col("step") >= first)
    )

    def block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(BLOCK_BITS, bool)
        hashes, top, kinds = rows["key"].to_numpy().view(np.uint64), rows["step"].to_numpy(), rows["kind"].to_numpy()
        for kind in (WORD, PAIR):
            keys, last = hashes[kinds == kind], top[kinds == kind]
            step = lowest[kind]
            while len(keys):
                place, stride = places(keys, kind, step)
                for _ in range(PROBES):
                    bits[(place & np.uint64(BLOCK_BITS - 1)).astype(np.int64)] = True
                    place = place + stride
                step += 1
                keys, last = keys[last >= step], last[last >= step]
        return pd.DataFrame({"block": [key[0]], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    grouped = members.withColumn("block", F.col("key").bitwiseAND(blocks - 1).cast("int")).groupBy("block")
    made = np.zeros((blocks, BLOCK_BITS // 8), np.uint8)
    for row in grouped.applyInPandas(block, "block int, bits binary").toLocalIterator():
        made[row.block] = np.frombuffer(row.bits, np.uint8)
    return Model(made.ravel(), tuple(lowest), int(total.tokens or 0), int(total.kinds or 0), int(total.ends or 0))


def _weights(counts: DataFrame, documents: int) -> np.ndarray:
    """For each step of a context's count, the share of tokens after it whose pair occurs elsewhere.

    Contexts meet under the upper half of their hash; both sides are summed
    before they move, so a frequent context is one row a task.
    """
    start = MARKS[START] >> 32
    words = counts.filter("word <> ''").select(F.shiftrightunsigned(F.xxhash64("word"), 32).alias("context"), "n")
    first = counts.sparkSession.range(1).select(F.lit(start).cast("long"), F.lit(documents).cast("long"))
    every = words.union(first).groupBy("context").agg(F.sum("n").alias("every"))
    pairs = counts.filter("word is null and n > 1")
    seen = pairs.groupBy(F.shiftrightunsigned("pair", 32).alias("context")).agg(F.sum("n").alias("seen"))
    rows = every.filter("every > 0").join(seen, "context", "left").groupBy(steps(F.col("every")).alias("step")).agg(
        F.sum("every").alias("every"), F.coalesce(F.sum("seen"), F.lit(0)).alias("seen")
    ).collect()
    found = np.zeros(128)
    for row in rows:
        # Never certain: a new pair may follow any context.
        found[row.step] = min(row.seen / (row.every + 1), 0.99)
    return found


def score_texts(docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_tokens, n_known, train_tokens, base_score, score.

    Rows for which ``learn`` holds are learned from; all are scored. Words are
    lower-cased in A-Z and parted by ASCII white space; the end of a text is a
    token. ``score`` is the log10 probability by the filter's model,
    ``base_score`` the add-one unigram score from exact counts, ``n_known`` the
    tokens that were learned. A null or empty text is its end alone. Without
    rows to learn from, both scores are 0. Repeated rows and null keys are rows
    like others; other columns are not read. The filter, whose size follows the
    words and pairs, and the FREQUENT most frequent words are broadcast; the
    other words of the texts meet their counts in a join, where none is frequent.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema[key].dataType.simpleString()
    training = docs.filter(learn)
    counted = count_ngrams(training, text)
    counts = keep(counted.filter(F.col("word").isNotNull() | (F.col("n") > 1)))
    model = build_filter(counts, grow=True)
    model.weights = _weights(counts, model.documents)
    words = counts.filter("word is not null")
    sizes = {row.step: row.kinds for row in words.groupBy(steps(F.col("n")).alias("step")).agg(F.count("*").alias("kinds")).collect()}
    least = 0
    while sum(n for step, n in sizes.items() if step >= least) > FREQUENT:
        least += 1
    rows = words.filter((steps(F.col("n")) >= least) & (F.col("word") != "")).select("word", "n").toLocalIterator()
    sent = send(spark, (model, {row.word.encode(): row.n for row in rows}))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, frequent = receive(sent)
        reader, known = Reader(model, frequent), Known()
        row_id = TaskContext.get().partitionId() << 33
        size = model.tokens + model.kinds + 1
        for batch in (whole.slice(start, SCORED_ROWS) for whole in batches for start in range(0, whole.num_rows, SCORED_ROWS)):
            if len(reader.hashes) > REMEMBERED:
                reader.forget()
            row = reader.read(batch.column(1).to_pylist())
            size_of = np.diff(np.append(np.flatnonzero(row == START), len(row))) - 1
            first, second, keys = reader.pairs(row)
            single = (TYPICAL[reader.step[second] + 1] + 1) / size
            before = reader.step[first]
            context = TYPICAL[before + 1]
            weight = np.where(context > 0, model.weights[np.maximum(before, 0)], 0.0)
            both = np.minimum(TYPICAL[model.step_again(keys, PAIR, known) + 1] / np.maximum(context, 1), 1)
            logs = np.log10(weight * both + (1 - weight) * single)
            exact = reader.count[second]
            starts = np.cumsum(size_of) - size_of
            rare = np.flatnonzero(exact == 0)
            names = reader.number.names
            ends = np.searchsorted(rare, np.append(starts, len(exact)))
            rest = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array([names[number] for number in second[rare].tolist()], pa.binary()).cast(pa.string())
            )
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(row_id, row_id + len(starts))), batch.column(0), pa.array(size_of),
                pa.array(np.add.reduceat((exact > 0).astype(np.int64), starts)),
                pa.array(np.add.reduceat(np.log10(exact + 1.0), starts)),
                pa.array(np.add.reduceat(logs, starts)),
                rest,
            ], names=["row", "k", "n_tokens", "known", "logs", "score", "rest"])
            row_id += len(starts)

    scored = keep(_texts(docs, text, F.col(f"`{key}`").alias("k")).mapInArrow(
        work, f"row long, k {kind}, n_tokens long, known long, logs double, score double, rest array<string>"
    ))
    rare = words.filter(steps(F.col("n")) < least)
    met = scored.select("row", F.explode("rest").alias("word")).join(rare, "word").select(
        "row", F.lit(1).cast("long").alias("known"), F.log10(F.col("n") + 1).alias("logs")
    )
    found = met.groupBy("row").agg(F.sum("known").alias("more_known"), F.sum("logs").alias("more_logs"))
    size = F.lit(float(model.tokens + model.kinds + 1))
    return scored.join(found, "row", "left").select(
        F.col("k").alias(key), "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.log10(size)).alias("base_score"),
        "score",
    )
