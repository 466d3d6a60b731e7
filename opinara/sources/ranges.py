"""Records that Spark's readers cannot split: one JSON array per file, CSV with line breaks inside cells.

Files are read in byte ranges, as pieces between separators (commas, line
feeds). Whether a separator parts two records depends on all that stands before
it: it may lie inside quotes or inside a nested value. So a first pass reads
each range under both assumptions, outside and inside quotes, with depths
counted from its start, and sums it up as a function of the state on entry. The
functions are chained over a file's ranges, one small row each. The second pass
knows every range's state and cuts its records; those that cross a border are
put together from their parts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from typing import Any, NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.session import materialize

# A table of so many ranges or files is sent to all executors; a larger one is joined.
BROADCAST_RANGES = 1_000_000


class Pieces(NamedTuple):
    """What consecutive pieces do, for one state of the quotes on entry; depths count from the entry."""

    inside: np.ndarray  # whether the separator before a piece lies inside quotes
    depth: np.ndarray  # how deep it lies
    inside_after: bool
    depth_after: int


class Format(NamedTuple):
    separator: str
    top: int  # depth at which separators part records
    scan: Callable[[list[str], bool], Pieces]
    blank: Callable[[str], bool]  # whether a piece is no record where one could begin


# --- JSON ----------------------------------------------------------------------

def scan_json(pieces: list[str], inside: bool) -> Pieces:
    """Quotes and brackets of pieces between commas, all at once."""
    joined = np.frombuffer(",".join(pieces).encode(), dtype=np.uint8)
    sizes = np.array([len(piece.encode()) + 1 for piece in pieces])
    commas = np.cumsum(sizes) - sizes - 1  # the one before each piece; the first lies before the text
    quotes = np.flatnonzero(joined == ord('"'))
    back = joined == ord("\\")
    if back.any():
        escaped, reach, step = np.zeros(len(quotes), dtype=bool), np.ones(len(quotes), dtype=bool), 1
        while reach.any():  # backslashes in a row before a quote; an odd number of them escapes it
            reach &= (quotes >= step) & back[quotes - step]
            escaped ^= reach
            step += 1
        quotes = quotes[~escaped]
    flips = np.zeros(len(joined) + 1, dtype=np.int64)
    flips[quotes + 1] = 1
    quoted = (np.cumsum(flips) + inside) % 2 == 1  # at each byte, by the quotes before it
    change = np.zeros(len(joined) + 1, dtype=np.int64)
    for sign, kinds in ((1, b"[{"), (-1, b"]}")):
        for kind in kinds:
            change[1:][(joined == kind) & ~quoted[:-1]] = sign
    depth = np.cumsum(change)
    at = np.maximum(commas, 0)
    lies, deep = quoted[at], depth[at]
    lies[0], deep[0] = inside, 0
    return Pieces(lies, deep, bool(quoted[-1]), int(depth[-1]))


JSON = Format(",", 1, scan_json, lambda piece: piece.strip()[:1] == "[" and piece.strip()[1:].strip() == "]")


# --- CSV -----------------------------------------------------------------------

_FIELDS = r'(?:(?:"(?:[^"]|"")*+"[^,]*+|[^",][^,]*+|),)*+'
_OPENED = re.compile(_FIELDS + r'"(?:[^"]|"")*+', re.DOTALL)
_CLOSING = re.compile(r'(?:[^"]|"")*+"[^,]*+', re.DOTALL)


def _open_after(line: str, inside: bool) -> bool:
    """Whether a line ends inside a quoted cell. Quotes open a cell only at its start; two of them stand for one."""
    if '"' not in line:
        return inside
    if inside:
        closed = _CLOSING.match(line)
        if closed is None:
            return True
        line = line[closed.end():]
        if not line:
            return False
        line = line[1:]  # the comma behind the cell
    return _OPENED.fullmatch(line) is not None


def scan_csv(pieces: list[str], inside: bool) -> Pieces:
    states = []
    for piece in pieces:
        states.append(inside)
        inside = _open_after(piece, inside)
    return Pieces(np.array(states), np.zeros(len(pieces), dtype=np.int64), inside, 0)


CSV = Format("\n", 0, scan_csv, lambda piece: piece in ("", "\r"))


# --- passes --------------------------------------------------------------------

def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[str]]]:
    """(other values, pieces) of runs of rows that differ in the last column only."""
    for batch in batches:
        keys = list(zip(*(column.to_pylist() for column in batch.columns[:-1]), strict=True))
        pieces, start = batch.column(batch.num_columns - 1).to_pylist(), 0
        for end in range(1, len(keys) + 1):
            if end == len(keys) or keys[end] != keys[start]:
                yield keys[start], pieces[start:end]
                start = end


class _Range:
    """Reads a range piece by piece from a given state on."""

    def __init__(self, form: Format, first: bool, inside: bool = False, depth: int = 0) -> None:
        self.form, self.first, self.inside, self.depth = form, first, inside, depth

    def depths(self, pieces: list[str]) -> list[int | None]:
        """The depth at which each piece begins a record, if that is the depth of records; None where it cannot."""
        read = self.form.scan(pieces, self.inside)
        found = [None if inside else depth for inside, depth in zip(read.inside.tolist(), (read.depth + self.depth).tolist(), strict=True)]
        if self.first:  # no separator stands before a file: its first record begins where the others do
            found[0], self.first = self.form.top, False
        self.inside, self.depth = read.inside_after, self.depth + read.depth_after
        return found


def _sum_up(form: Format) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each range as a function: for both assumptions the state behind it and, by depth, how many records begin in it."""

    def passes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, list[tuple[_Range, Counter]]] = {}
        for key, pieces in _runs(batches):
            if key not in found:
                found[key] = [(_Range(form, key[1] == 0, inside), Counter()) for inside in (False, True)]
            for reader, begun in found[key]:
                begun.update(d for d, piece in zip(reader.depths(pieces), pieces, strict=True) if d is not None and not form.blank(piece))
        rows: list[dict[str, Any]] = [{
            "file": file, "block": block, "inside": [reader.inside for reader, _ in both],
            "depth": [reader.depth for reader, _ in both], "begun": [sorted(begun.items()) for _, begun in both],
        } for (file, block), both in found.items()]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
            ("file", pa.string()), ("block", pa.int64()), ("inside", pa.list_(pa.bool_())), ("depth", pa.list_(pa.int64())),
            ("begun", pa.list_(pa.map_(pa.int64(), pa.int64()))),
        ]))

    return passes


def _chain(top: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The state on entry to each range of one file, one row a range, with what holds for the file."""

    def chained(frame: pd.DataFrame) -> pd.DataFrame:
        inside, depth, before, rows = False, 0, 0, []
        for _, row in frame.sort_values("block").iterrows():
            rows.append([row["file"], row["block"], inside, depth, before, False])
            begun, now = dict(row["begun"][int(inside)]), int(inside)
            before += begun.get(top - depth, 0)
            inside, depth = bool(row["inside"][now]), depth + int(row["depth"][now])
        rows[-1][5] = True
        return pd.DataFrame(
            [(*row, before, not inside and depth == 0) for row in rows],
            columns=["file", "block", "inside", "depth", "before", "last", "records", "sound"],
        )

    return chained


def _cut(form: Format, whole: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(file, block, number, text) of the records that lie inside one range, or of the parts of the others."""

    def passes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None  # file, block, inside, depth, before, last
        parts: list[str] = []
        out: list[tuple] = []
        number = -1

        def close(ended: bool) -> None:
            """The record read so far; it is whole if it began in this range and ended there."""
            if parts and (ended and number >= at[4]) == whole:
                out.append((at[0], at[1], number, form.separator.join(parts)))
            parts.clear()

        def written() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[], [], [], []]
            out.clear()
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)], ["file", "block", "number", "text"]
            )

        for key, pieces in _runs(batches):
            if key != at:
                if at is not None:
                    close(at[5])
                at, number, reader = key, key[4] - 1, _Range(form, key[1] == 0, key[2], key[3])
            for piece, depth in zip(pieces, reader.depths(pieces), strict=True):
                if depth == form.top:
                    close(True)
                    if form.blank(piece):
                        continue
                    number += 1
                parts.append(piece)
            if out:
                yield written()
        if at is not None:
            close(at[5])
        yield written()

    return passes


def read_records(spark: SparkSession, path: str | list[str], form: Format) -> tuple[DataFrame, DataFrame]:
    """(file, number, text) of the records of ``path``, numbered from 0 in each file, and (file, records, sound) of the files.

    ``sound`` is false for a file that ends inside quotes or brackets. A file
    without a byte has no row in either table.
    """
    read = spark.read.option("lineSep", form.separator).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    sums = read.mapInArrow(
        _sum_up(form), "file string, block long, inside array<boolean>, depth array<long>, begun array<map<long,long>>"
    )
    states = sums.groupBy("file").applyInPandas(
        _chain(form.top), "file string, block long, inside boolean, depth long, before long, last boolean, records long, sound boolean"
    )
    states = materialize(states)
    placed = states.drop("records", "sound")
    if placed.count() <= BROADCAST_RANGES:
        known = read.join(F.broadcast(placed), ["file", "block"])
    else:
        known = read.withColumn("_id", F.monotonically_increasing_id()).join(placed, ["file", "block"]).sortWithinPartitions(
            "file", "block", "_id"
        )
    known = known.select("file", "block", "inside", "depth", "before", "last", "value")
    schema = "file string, block long, number long, text string"
    parts = known.mapInArrow(_cut(form, False), schema).groupBy("file", "number").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda part: part["text"]), form.separator).alias("text")
    )
    whole = known.mapInArrow(_cut(form, True), schema).select("file", "number", "text")
    return whole.unionByName(parts), states.filter("last").select("file", "records", "sound")
