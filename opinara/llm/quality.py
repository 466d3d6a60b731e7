"""Quality rules: repeated words and lines, and bands of the compression ratio.

A text that zstandard shrinks too well repeats itself; one it hardly shrinks
is noise. Ratios depend on length, so the limits do too: the whole text and
each of its fixed chunks is held against the band of its own length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import bounded_batches

# The characters counted as symbols, and white space between words.
SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\v\f\r"


@dataclass(frozen=True)
class Bands:
    """Limits of bytes / compressed bytes.

    ``limits`` holds (fewest bytes, lowest ratio, highest ratio) by rising
    size; the last entry that a text reaches applies. Short texts get a wide
    band, as the frame header weighs more there. A text fails if its own ratio
    lies outside its band, or if more than ``chunk_share`` of its chunks do.
    """

    limits: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, 4.0), (128, 1.0, 2.8), (512, 1.2, 3.2), (2048, 1.4, 3.8), (8192, 1.5, 4.5), (65536, 1.5, 6.0),
    )
    chunk_bytes: int = 4096
    chunk_share: float = 0.25
    level: int = 3

    def inside(self, size: int, ratio: float) -> bool:
        low, high = next((low, high) for least, low, high in reversed(self.limits) if size >= least)
        return low <= ratio <= high


COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long"
)


def repeated_words(words: list[bytes], window: int = 5) -> int:
    """Words inside windows of ``window`` words that occur twice or more, all occurrences counted."""
    if len(words) <= window:
        return 0
    numbers: dict[bytes, int] = {}
    key = np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64)
    base, first = len(numbers), key
    for step in range(1, window):
        if base * len(numbers) >= 1 << 62:  # rename the windows so far, so that the next product fits
            found, key = np.unique(key, return_inverse=True)
            base = len(found)
        key = key[:-1] * len(numbers) + first[step:]
        base *= len(numbers)
    order = np.sort(key)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    starts = np.flatnonzero(np.isin(key, twice))
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def judge(text: str | None, bands: Bands, press: zstandard.ZstdCompressor) -> tuple:
    text = text or ""
    data = text.encode("utf-8", "replace")
    words = data.split()
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    repeats = repeated_words(words)
    failed = len(words) < 10 or 100 * repeats > 20 * len(words)
    whole = len(data) / len(press.compress(data)) if data else 0.0
    chunks = bad = 0
    for start in range(0, len(data) if len(data) > bands.chunk_bytes else 0, bands.chunk_bytes):
        chunk = data[start:start + bands.chunk_bytes]
        chunks += 1
        bad += not bands.inside(len(chunk), len(chunk) / len(press.compress(chunk)))
    good = bands.inside(len(data), whole) and bad <= bands.chunk_share * chunks
    return (
        len(words), len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
        repeats, failed, good and not failed, whole, chunks, bad,
    )


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", bands: Bands | None = None) -> DataFrame:
    """One row per row of ``docs``: the key, the counts, and whether the text is kept.

    A null or empty text has no words, ratio 0 and is not kept. Rows do not
    depend on each other: repeated rows and null keys give a row each. Other
    columns of ``docs`` are not read. No shuffle; one text is in memory at a
    time besides its batch.
    """
    bounded_batches(docs.sparkSession)
    bands = bands or Bands()
    kind = docs.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            found = list(zip(*(judge(value.as_py(), bands, press) for value in batch.column(1)), strict=True))
            if found:
                columns = [pa.array(values) for values in found]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["k", *NAMES])

    picked = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))
    return picked.mapInArrow(work, f"k {kind}, {COLUMNS}").withColumnRenamed("k", key)


NAMES = re.findall(r"(\w+) \w+", COLUMNS)
