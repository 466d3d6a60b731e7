"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

A text is the set of its hashed n-grams. Each feature is worth its log ratio
between toxic and other labelled texts, or nothing if chance explains it;
logistic regression on the features so scaled decides how far each is trusted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.llm.common import bounded_batches

# The bounded training sample: rows of each label, and the longest text among them.
SAMPLE_ROWS = 3000
SAMPLE_CHARS = 20_000
LENGTHS = (3, 4, 5, 6)
BITS = 20
# Fewest sampled texts with a feature, fewest standard deviations its count among toxic texts is off by
# chance, smoothing of the counts, strength of the penalty, steps of the fit.
FEWEST, DEVIATIONS, SMOOTH, PENALTY, STEPS = 5, 4.0, 1.0, 1.0, 80


def features(text: str | None, seen: np.ndarray) -> np.ndarray:
    """Distinct hashed n-grams of the lower-cased text that lie in one word and the space on either side.

    ``seen`` is scratch for one number a feature.
    """
    joined = " ".join((text or "").lower().split())
    if not joined:
        return np.zeros(0, np.int32)
    codes = np.frombuffer(f" {joined} ".encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    spaces = np.concatenate(([0], np.cumsum(codes == 32, dtype=np.int32)))
    parts, rolling = [], codes
    for length in range(2, min(max(LENGTHS), len(codes)) + 1):
        rolling = rolling[:-1] * np.uint64(0x100000001B3) + codes[length - 1:]
        if length in LENGTHS:
            within = spaces[length - 1:len(codes)] == spaces[1:len(codes) - length + 2]
            mixed = rolling[within]
            mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15 + 2 * length)
            parts.append((mixed >> np.uint64(64 - BITS)).astype(np.int32))
    found = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    places = np.arange(len(found), dtype=np.int32)
    seen[found] = places  # the last place of each feature stays
    return found[seen[found] == places]


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        seen = np.empty(1 << BITS, np.int32)
        sums = np.array([self.weights[features(text, seen)].sum(dtype=np.float64) for text in texts])
        return 1 / (1 + np.exp(-np.clip(sums + self.bias, -500, 500)))


def fit(texts: list[str], labels: list[int], share: float) -> Model:
    """``share``: the part of all labelled rows that is toxic; the sample is weighted to it."""
    truth = np.array(labels, np.float64)
    size = 1 << BITS
    if not len(truth) or truth.min() == truth.max():
        return Model(np.zeros(size, np.float32), 40.0 if len(truth) and truth[0] else -40.0)
    seen = np.empty(size, np.int32)
    counts = np.zeros((2, size))
    for text, label in zip(texts, labels, strict=True):
        counts[label, features(text, seen)] += 1
    both, toxic = counts.sum(axis=0), truth.sum()
    part = both / len(truth)
    spread = np.sqrt(toxic * part * (1 - part) * (1 - truth.mean())) + 1e-9
    known = (both >= FEWEST) & (np.abs(counts[1] - toxic * part) >= DEVIATIONS * spread)
    ratio = np.where(
        known,
        np.log((counts[1] + SMOOTH) / (toxic + 2 * SMOOTH)) - np.log((counts[0] + SMOOTH) / (len(truth) - toxic + 2 * SMOOTH)), 0.0,
    )
    rows = [row[known[row]] for row in (features(text, seen) for text in texts)]
    index = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(row) for row in rows])
    weight = np.where(truth > 0, share / truth.mean(), (1 - share) / (1 - truth.mean()))
    weight *= len(truth) / weight.sum()
    share = min(max(share, 1e-6), 1 - 1e-6)
    theta, bias = np.zeros(size), float(np.log(share / (1 - share)))
    speed = np.full(size, 1e-8)
    speed_bias = 1e-8
    for _ in range(STEPS):
        sums = np.bincount(owner, (theta * ratio)[index], len(truth)) + bias
        error = weight * (1 / (1 + np.exp(-np.clip(sums, -500, 500))) - truth)
        slope = np.bincount(index, error[owner], size) * ratio + PENALTY * theta
        speed += slope**2
        theta -= 0.1 * slope / np.sqrt(speed)
        speed_bias += error.sum() ** 2
        bias -= 0.1 * error.sum() / np.sqrt(speed_bias)
    return Model((theta * ratio).astype(np.float32), float(bias))


def train(docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model of the labelled rows for which ``learn``, an expression of ``labels``, holds.

    Up to SAMPLE_ROWS keys of each label, in an order fixed by their hash, are
    fitted, those with texts of up to SAMPLE_CHARS characters; null labels and
    texts teach nothing, and a key with both labels counts as toxic. Without
    rows of both labels every score is next to 0 (no toxic rows) or 1.
    """
    known = labels.filter(learn & F.col(f"`{label}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("k")).agg(
        F.max((F.col(f"`{label}`") != 0).cast("int")).alias("label")
    )
    counts = {row.label: row["count"] for row in known.groupBy("label").count().collect()}
    # About twice the rows wanted, by their hash, so that the ranks never see more of a label than that.
    part = F.pmod(F.xxhash64("k"), F.lit(1 << 20)) / (1 << 20)
    share = F.when(F.col("label") == 1, 2 * SAMPLE_ROWS / max(1, counts.get(1, 0))).otherwise(2 * SAMPLE_ROWS / max(1, counts.get(0, 0)))
    place = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("k"), "k"))
    few = known.filter(part < share).withColumn("place", place)
    chosen = few.filter(F.col("place") <= SAMPLE_ROWS).select("k", "label").limit(2 * SAMPLE_ROWS)
    sized = docs.filter(F.length(f"`{text}`") <= SAMPLE_CHARS).select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    rows = sized.join(F.broadcast(chosen), "k").groupBy("k", "label").agg(F.min("t").alias("t")).collect()
    rows.sort(key=lambda row: row.k)
    return fit([row.t for row in rows], [row.label for row in rows], counts.get(1, 0) / max(1, sum(counts.values())))


def score(docs: DataFrame, model: Model, keys: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns ``keys`` of every row of ``docs``, and score: how likely the text is toxic, 0 to 1.

    Null and empty texts have no features and get the score that the bias
    gives. Rows do not depend on each other, other columns are not read, and
    there is no shuffle; the weights (4 MB at 20 bits) are broadcast.
    """
    bounded_batches(docs.sparkSession)
    kinds = [docs.schema[name].dataType.simpleString() for name in keys]
    names = [f"k{number}" for number in range(len(keys))]
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = Model(*sent.value)
        for batch in batches:
            found = ready.scores(batch.column(batch.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.float64())], names=[*names, "score"])

    picked = docs.select(*[F.col(f"`{name}`").alias(new) for name, new in zip(keys, names, strict=True)], F.col(f"`{text}`").alias("t"))
    schema = ", ".join(f"{name} {kind}" for name, kind in zip(names, kinds, strict=True))
    return picked.mapInArrow(work, f"{schema}, score double").toDF(*keys, "score")
