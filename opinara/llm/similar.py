"""Similar texts by word shingles: MinHash bands find candidates, the shingles themselves decide.

Two texts are similar if their sets of WIDTH-word shingles have a Jaccard
similarity of ALIKE or more. A band is the hash of ROWS minima; two texts meet
if one of BANDS bands is equal. At a similarity of exactly 0.8 a pair meets in
no band with probability (1 - 0.8^4)^32 = 5e-8, above it more rarely.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.llm.common import bounded_batches, in_few_files, keep, shuffled
from opinara.llm.components import components

WIDTH, ALIKE = 5, 0.8
BANDS, ROWS = 32, 4
SEED = 42
# Heads that a crowded bucket's members are held against before its components are searched for pairs.
TURNS = 2
# Shingles whose hashes are laid out for all minima at once.
CHUNK = 1024
# Characters of a block of texts, about; texts that have many pairs travel once for each block they have a partner in.
BLOCK_CHARS = 1 << 20

_RANDOM = np.random.default_rng(SEED)
_FACTORS = _RANDOM.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64) | np.uint64(1)
_SUMMANDS = _RANDOM.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """The distinct hashes of all shingles; a shorter text, also one without words, is one shingle."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    joined = b" ".join(words)
    if len(words) <= WIDTH:
        spans = [joined]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = map(joined.__getitem__, map(slice, starts[:1 - WIDTH].tolist(), ends[WIDTH - 1:].tolist()))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(span, SEED) for span in spans], np.uint64))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def bands(found: np.ndarray) -> list[int]:
    """The hash of each band's minima and its number."""
    least = np.full(BANDS * ROWS, 0xFFFFFFFFFFFFFFFF, np.uint64)
    for start in range(0, len(found), CHUNK):
        np.minimum(least, (found[start:start + CHUNK] * _FACTORS + _SUMMANDS).min(axis=1), out=least)
    return [xxhash.xxh64_intdigest(row.tobytes(), number) for number, row in enumerate(least.reshape(BANDS, ROWS))]


def _buckets(texts: DataFrame) -> DataFrame:
    """(node, size, bucket): a row for each band of each of ``texts`` (node, t)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(value.as_py()) for value in batch.column(1)]
            nodes = np.repeat(batch.column(0).to_numpy(), BANDS)
            sizes = np.repeat(np.fromiter(map(len, sets), np.int32, len(sets)), BANDS)
            places = np.array([bands(found) for found in sets], np.uint64).reshape(-1)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(sizes), pa.array(places.view(np.int64))], names=["node", "size", "bucket"])

    return texts.mapInArrow(work, "node long, size int, bucket long")


def _one_each(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, t): the text of each node of ``wanted``, once."""
    return keep(texts.join(shuffled(wanted), "node", "left_semi").groupBy("node").agg(F.first("t").alias("t")))


def _alike(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose texts in ``known`` (node, t) are similar."""
    one = known.select(F.col("node").alias("a"), F.col("t").alias("x"))
    two = known.select(F.col("node").alias("b"), F.col("t").alias("y"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stay = [
                similarity(shingles(x.as_py()), shingles(y.as_py())) >= ALIKE
                for x, y in zip(batch.column(2), batch.column(3), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(stay, pa.bool_()))

    return pairs.join(shuffled(one), "a").join(shuffled(two), "b").select("a", "b", "x", "y").mapInArrow(work, "a long, b long")


def _alike_in_blocks(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The same as ``_alike`` for texts with many pairs each: two blocks of texts meet, and each text is cut into shingles once a meeting."""
    chars = known.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, -(-chars // BLOCK_CHARS))
    one, two = (F.pmod(F.xxhash64(side, F.lit("block")), F.lit(blocks)).alias(name) for side, name in (("a", "i"), ("b", "j")))
    placed = pairs.select("a", "b", one, two)
    wanted = placed.select("i", "j", F.explode(F.array("a", "b")).alias("node")).distinct()

    def compare(some: pd.DataFrame, texts: pd.DataFrame) -> pd.DataFrame:
        sets = dict(zip(texts["node"], map(shingles, texts["t"]), strict=True))
        stay = [similarity(sets[a], sets[b]) >= ALIKE for a, b in zip(some["a"], some["b"], strict=True)]
        return some.loc[stay, ["a", "b"]]

    met = wanted.join(shuffled(known), "node").toDF("node", "k", "l", "t").groupBy("k", "l")
    return placed.groupBy("i", "j").cogroup(met).applyInPandas(compare, "a long, b long")


def _could_be(one: str, two: str) -> Column:
    """Whether sets of these sizes can be similar."""
    return F.least(one, two) >= F.greatest(one, two) * ALIKE - 1e-6


def _stars(members: DataFrame, turn: int) -> DataFrame:
    """(a, b), a < b: each of ``members`` (bucket, node, size, root) with its bucket's head, if that is of another root.

    The head is the first in an order of all nodes that each ``turn`` draws
    anew, so buckets of one crowd mostly agree on it.
    """
    order = F.struct(F.xxhash64("node", F.lit(turn)).alias("order"), "node", "size", "root")
    heads = members.groupBy("bucket").agg(
        F.min(order).alias("head"), F.min("root").alias("low"), F.max("root").alias("high")
    ).filter("low < high").select("bucket", "head")
    met = members.join(shuffled(heads), "bucket").filter((F.col("root") != F.col("head.root")) & _could_be("size", "head.size"))
    return met.select(F.least("node", "head.node").alias("a"), F.greatest("node", "head.node").alias("b")).distinct()


def _sharing_rare(nodes: DataFrame, known: DataFrame) -> DataFrame:
    """(a, b), a < b: all pairs of ``nodes`` (node, root) of different roots that can be similar.

    Sets of m and n shingles have to share s = ALIKE / (1 + ALIKE) * (m + n) of
    them. With the shingles in one order, rarest first, the first that both have
    stands among the first m - s + 1 of one and n - s + 1 of the other, or too
    few would be left. None is missed, and crowds that share only what they all
    have do not meet.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = shingles(value.as_py())
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(found), node)), pa.array(np.full(len(found), len(found), np.int32)), pa.array(found.view(np.int64))
                ], names=["node", "size", "gram"])

    grams = keep(known.join(shuffled(nodes), "node", "left_semi").mapInArrow(work, "node long, size int, gram long"))
    counts = grams.groupBy("gram").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("node").orderBy("n", "gram"))
    rare = keep(grams.join(shuffled(counts), "gram").withColumn("place", place).filter(
        (F.col("place") <= F.col("size") - F.ceil(F.col("size") * ALIKE - 1e-9) + 1) & (F.col("n") > 1)
    ).join(shuffled(nodes), "node").select("gram", "node", "size", "place", "root"))
    one, two = (rare.select("gram", *[F.col(name).alias(f"{side}_{name}") for name in ("node", "size", "place", "root")]) for side in "ab")
    shared = F.ceil((F.col("a_size") + F.col("b_size")) * (ALIKE / (1 + ALIKE)) - 1e-6)
    left = F.least(F.col("a_size") - F.col("a_place"), F.col("b_size") - F.col("b_place")) + 1
    # By components, so that members of one never meet.
    met = one.join(shuffled(two), "gram").filter((F.col("a_root") < F.col("b_root")) & (left >= shared) & _could_be("a_size", "b_size"))
    return met.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()


def similar_texts(
    docs: DataFrame, key: str = "doc_id", text: str = "text",
    also: Callable[[DataFrame, str, str], DataFrame] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: key, component_id, the smallest key reachable over similar texts.

    ``also`` names groups of texts that are linked besides, by key and
    component_id; texts it has joined are not compared again.

    Words are lower-cased in A-Z and parted by ASCII white space. Texts without
    words are alike; null counts as empty; a very long text is read whole. Null
    keys never name a component unless all its keys are null (then it is null).
    Rows with the same text (64-bit hash) are one node; repeated rows each get a
    row. No rows give no rows, and other columns of ``docs`` are not read.

    Each member of a bucket is held against the bucket's head, so a crowd of
    copies costs one comparison a member; buckets that this leaves in several
    components get new heads in up to TURNS turns. Texts of buckets that still
    are of several components are held against each other where they can be
    similar by a rare shingle. Many texts that are just not similar but share
    the same rare shingles still cost their pairs.
    """
    bounded_batches(docs.sparkSession)
    words = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.xxhash64(words).alias("node"), words.alias("t"))
    texts = rows.select("node", "t")
    given = None
    if also:
        first = keep(also(texts, "node", "t").filter("node <> component_id").select("node", F.col("component_id").alias("root")).distinct())
        given = first.select(F.least("node", "root").alias("a"), F.greatest("node", "root").alias("b"))
    placed = keep(_buckets(texts))
    several = placed.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high").select("bucket")
    members = keep(in_few_files(placed.join(shuffled(several), "bucket").select("bucket", "node", "size").distinct()))
    rooted = members.withColumn("root", F.col("node"))
    if given:
        rooted = members.join(shuffled(first), "node", "left").withColumn("root", F.coalesce("root", "node"))
    stars = keep(_stars(rooted, 0))
    links = _alike(stars, _one_each(texts, stars.select(F.explode(F.array("a", "b")).alias("node")).distinct()))
    links = keep(in_few_files(links.union(given) if given else links))
    roots = components(links)

    # What the stars did not join: buckets with members of several components.
    def split(members: DataFrame) -> DataFrame:
        labelled = members.select("bucket", "node", "size").join(shuffled(roots), "node", "left").withColumn("root", F.coalesce("root", "node"))
        open_ = labelled.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("bucket")
        return keep(labelled.join(shuffled(open_), "bucket"))

    members = split(members)
    known = _one_each(texts, members.select("node").distinct())
    for turn in range(1, TURNS):
        again = keep(_stars(members, turn).join(shuffled(stars), ["a", "b"], "left_anti"))
        if again.isEmpty():
            break
        stars, more = stars.union(again), keep(in_few_files(_alike(again, known)))
        if more.isEmpty():
            continue
        links = links.union(more)
        roots = components(links)
        members = split(members)
    others = keep(_sharing_rare(members.select("node", "root").distinct(), known).join(shuffled(stars), ["a", "b"], "left_anti"))
    if not others.isEmpty():
        roots = components(links.union(_alike_in_blocks(others, known)))

    nodes = rows.groupBy("node").agg(F.min("k").alias("first"))
    named = nodes.join(shuffled(roots), "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = named.join(shuffled(least), "root").select("node", "component_id")
    return rows.select("k", "node").join(shuffled(classes), "node").select(F.col("k").alias(key), "component_id")
