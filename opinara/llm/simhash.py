"""SimHash near-duplicates with covering locality-sensitive hashing.

Every bit position gets a non-zero vector of three bits. Table t (1 to 7) keeps
the positions whose vector has an odd inner product with t. Two positions span
at most a plane, so some t is orthogonal to both: two fingerprints that differ
in two bits or fewer agree in the kept bits of at least one of the seven tables.
No pair within the radius is missed, whatever the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import bounded_batches, in_few_files, keep, shuffled
from opinara.llm.components import components

BITS = 64
RADIUS = 2
TABLES = 2 ** (RADIUS + 1) - 1
SHINGLE = 3
SEED = 42
# Up to this many members a bucket's pairs are compared; larger buckets meet at common centres.
FEW = 32


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """Majority bits of the hashes of all word shingles; 0 without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        spans = [joined]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = map(joined.__getitem__, map(slice, starts[:1 - width].tolist(), ends[width - 1:].tolist()))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(span, SEED) for span in spans], np.uint64)
    counts = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, print long): one row per row of ``docs``."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(value.as_py()) for value in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["k", "print"])

    picked = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))
    return picked.mapInArrow(work, f"k {kind}, print long")


def masks() -> list[int]:
    vectors = [position % TABLES + 1 for position in range(BITS)]
    return [
        sum(1 << position for position, vector in enumerate(vectors) if bin(vector & table).count("1") % 2)
        for table in range(1, TABLES + 1)
    ]


def _long(value: int) -> Column:
    return F.lit(value - (1 << BITS) if value >> (BITS - 1) else value).cast("long")


def _differ(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(prints: DataFrame) -> DataFrame:
    """(a, b), a < b: links that join whatever different fingerprints within the radius join.

    Fingerprints that share a bucket differ only outside the table's mask. In a
    bucket of up to FEW members all pairs are compared. In a larger one every
    member visits itself and its one-bit neighbours outside the mask; two
    members within two bits visit a common place, all visitors of one place are
    within two bits of each other, and a place has 65 visitors at most, so each
    is linked to the smallest. That is linear in the members and exact.
    """
    kept = masks()
    buckets = prints.select(
        "print",
        F.explode(F.array(*[
            F.struct(F.lit(number).alias("number"), F.col("print").bitwiseAND(_long(mask)).alias("bucket"))
            for number, mask in enumerate(kept, 1)
        ])).alias("at"),
    ).select("print", "at.number", "at.bucket")
    sizes = buckets.groupBy("number", "bucket").agg(F.count("*").alias("members")).filter("members > 1")
    shared = keep(in_few_files(buckets.join(shuffled(sizes), ["number", "bucket"])))

    few = shared.filter(F.col("members") <= FEW).groupBy("number", "bucket").agg(F.collect_list("print").alias("all"))
    pairs = few.select(F.explode(F.flatten(F.transform("all", lambda a: F.transform(
        F.filter("all", lambda b: (a < b) & (_differ(a, b) <= RADIUS)), lambda b: F.struct(a.alias("a"), b.alias("b"))
    )))).alias("pair")).select("pair.a", "pair.b")

    free = F.array(*[
        F.array(*[_long(1 << bit) for bit in range(BITS) if not mask >> bit & 1]) for mask in kept
    ])
    places = shared.filter(F.col("members") > FEW).select("print", F.explode(F.concat(
        F.array("print"), F.transform(F.element_at(free, F.col("number")), lambda bit: F.col("print").bitwiseXOR(bit))
    )).alias("place"))
    stars = places.groupBy("place").agg(F.collect_set("print").alias("all")).filter(F.size("all") > 1).select(
        F.array_min("all").alias("a"), F.explode("all").alias("b")
    ).filter("a < b")
    return pairs.union(stars).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, fingerprint (16 hex digits), component_id.

    Rows whose fingerprints differ in two bits or fewer are linked;
    component_id is the smallest key reachable over links. Null and empty texts
    and texts without words have fingerprint zero and are linked like others.
    Null keys never name a component unless all its keys are null (then it is
    null). Repeated rows each get a row. Other columns of ``docs`` are not
    read. Equal fingerprints are one node, so copies cost nothing after the
    first aggregate.
    """
    prints = keep(in_few_files(fingerprints(docs, key, text)))
    nodes = keep(prints.groupBy("print").agg(F.min("k").alias("first")))
    roots = components(links(nodes))
    named = nodes.join(shuffled(roots), F.col("print") == F.col("node"), "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    smallest = named.join(shuffled(roots.select("root").distinct()), "root").groupBy("root").agg(F.min("first").alias("least"))
    classes = named.join(shuffled(smallest), "root", "left").select("print", F.coalesce("least", "first").alias("component_id"))
    return prints.join(shuffled(classes), "print").select(
        F.col("k").alias(key), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(
    docs: DataFrame, key: str = "doc_id", text: str = "text",
    grouped: Callable[[DataFrame, str, str], DataFrame] = near_duplicates,
) -> DataFrame:
    """The rows of ``docs`` that stay when each group of near-duplicates keeps the row of its smallest key.

    ``grouped`` names the groups: it gives the key and a component_id of every row.
    ``key`` is an integer column. Rows with the same key are one document, of
    which the row with the smallest text stays (null texts last). A row without
    a key stands under a number made from its text, larger than usual keys, so
    that it stays only where no row with a key is like it. All columns are
    handed on. The texts move once, to meet the keys that stay.
    """
    names = docs.columns
    marked = docs.toDF(*[f"c{number}" for number in range(len(names))])
    own, words = (marked[f"c{names.index(name)}"] for name in (key, text))
    spare = F.shiftrightunsigned(F.xxhash64(words), 2) + F.lit(1 << 62)
    marked = marked.withColumn("id", F.coalesce(own.cast("long"), spare))
    classes = grouped(marked, "id", f"c{names.index(text)}")
    stay = classes.filter("id = component_id").select("id").distinct()
    order = F.struct(words.isNull(), words)
    whole = F.struct(*[f"c{number}" for number in range(len(names))])
    return marked.join(stay, "id", "left_semi").groupBy("id").agg(F.min_by(whole, order).alias("row")).select("row.*").toDF(*names)
