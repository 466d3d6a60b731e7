"""Token-budget batches.

Greedy packing walks the records in input order and opens a new batch whenever
the next record would not fit. Where a batch ends depends on where the one
before it ended, yet the walk need not be serial: over a stretch of rows, all
that matters about the past is how full the open batch was on entry, and that
only decides at which of the first few rows the stretch opens a batch of its
own. So each stretch (a bounded range of ``ingest_seq``) is summarized for all
these possibilities, the small summaries are chained, and then each stretch
numbers its own rows. The batches are exactly those of the serial walk,
whatever the partitioning.

A tree keeps every group small: 2**18 rows to a chunk, 4096 chunks to a block,
4096 blocks to a block of the next level, and 512 of the third level in all, as
ids have 63 bits. Ids with gaps only leave branches of the tree out.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions.text import token_count

# Fixed values.
MAX_TOKENS_PER_BATCH = 6000
BATCH_OVERHEAD = 800
RECORD_OVERHEAD = 50

CHUNK_ROWS = 1 << 18
BLOCK_CHUNKS = 1 << 12
LEVELS = 3

_SUMMARY = "head array<double>, leave array<double>, opened array<long>, total double"
_ENTRY = "load double, batch_no long"


class Stretch(NamedTuple):
    """What a run of rows does to the walk, for every row its first batch may open at."""

    head: np.ndarray  # cost up to and including that row
    leave: np.ndarray  # fill of the open batch after the last row
    opened: np.ndarray  # batches opened on the way
    total: float  # cost of all rows, for a run the open batch takes in whole


def record_costs(raw: DataFrame) -> DataFrame:
    """(ingest_seq, cost): the only columns packing moves."""
    return raw.select("ingest_seq", (token_count(F.col("raw_text")) + F.lit(RECORD_OVERHEAD)).alias("cost"))


def pack_batches(
    costs: DataFrame,
    max_tokens: int = MAX_TOKENS_PER_BATCH,
    overhead: int = BATCH_OVERHEAD,
    chunk_rows: int = CHUNK_ROWS,
    block_chunks: int = BLOCK_CHUNKS,
) -> DataFrame:
    """(ingest_seq, cost, batch_no, oversize) for rows of (ingest_seq, cost > 0).

    ``ingest_seq`` must be unique: a chunk is a range of ``chunk_rows`` values
    and so never holds more rows than that. Batches count from 1. A record over
    the budget sits alone and is flagged.
    """
    room = max_tokens - overhead

    def chunk_summary(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        spent = _running_cost(rows.sort_values("ingest_seq"))
        return pd.DataFrame([(key[0] // block_chunks, key[0], *_summarize(spent, room))])

    def block_summary(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(key[0] // block_chunks, key[0], *_chain(_stretches(parts.sort_values("part")), room))])

    def top_entries(parts: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values("part")
        # Before the first row no batch is open: an infinite fill opens one.
        return _entries(parts["part"], _stretches(parts), np.inf, 0, room)

    def inner_entries(parts: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values("part")
        return _entries(parts["part"], _stretches(parts), *_entry(entry), room)

    def numbered(rows: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("ingest_seq")
        load, batch_no = _entry(entry)
        opens = _opening_rows(_running_cost(rows), load, room)
        return pd.DataFrame({
            "ingest_seq": rows["ingest_seq"],
            "cost": rows["cost"],
            "batch_no": batch_no + np.cumsum(opens),
            "oversize": rows["cost"] > room,
        })

    # Both passes over the rows read this one exchange of two narrow columns.
    placed = costs.select(
        F.expr(f"ingest_seq div {int(chunk_rows)}").alias("chunk"), "ingest_seq", "cost"
    ).repartition("chunk")
    levels = [placed.groupBy("chunk").applyInPandas(chunk_summary, f"block long, part long, {_SUMMARY}")]
    for _ in range(LEVELS):
        levels.append(levels[-1].groupBy("block").applyInPandas(block_summary, f"block long, part long, {_SUMMARY}"))
    entries = levels.pop().groupBy().applyInPandas(top_entries, f"part long, {_ENTRY}")
    while levels:
        entries = levels.pop().groupBy("block").cogroup(entries.groupBy("part")).applyInPandas(
            inner_entries, f"part long, {_ENTRY}"
        )
    into_chunks = entries
    return (
        placed.groupBy("chunk")
        .cogroup(into_chunks.groupBy("part"))
        .applyInPandas(numbered, "ingest_seq long, cost long, batch_no long, oversize boolean")
    )


def _running_cost(rows: pd.DataFrame) -> np.ndarray:
    """Cost before each row, and after the last."""
    return np.concatenate(([0.0], np.cumsum(rows["cost"].to_numpy(dtype="float64"))))


def _next_opening(spent: np.ndarray, room: int) -> np.ndarray:
    """Row at which the batch after the one opened at each row opens."""
    start = np.arange(len(spent) - 1)
    over = np.searchsorted(spent, spent[:-1] + room, side="right") - 1
    return np.maximum(over, start + 1)


def _summarize(spent: np.ndarray, room: int) -> Stretch:
    rows, following = len(spent) - 1, _next_opening(spent, room)
    first = np.flatnonzero(spent[:-1] <= room)
    at, opened = first.copy(), np.ones(len(first), dtype="int64")
    moving = following[at] < rows
    while moving.any():
        at = np.where(moving, following[at], at)
        opened += moving
        moving = following[at] < rows
    return Stretch(spent[first + 1], spent[-1] - spent[at], opened, spent[-1])


def _advance(stretch: Stretch, load: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """(fill after, batches opened) for each fill on entry."""
    at = np.searchsorted(stretch.head, room - load, side="right")
    whole = at == len(stretch.head)
    at = np.where(whole, 0, at)
    return np.where(whole, load + stretch.total, stretch.leave[at]), np.where(whole, 0, stretch.opened[at])


def _chain(stretches: list[Stretch], room: int) -> Stretch:
    """The summary of consecutive stretches taken as one."""
    head, load, opened = np.empty(0), np.empty(0), np.empty(0, dtype="int64")
    spent = 0.0
    for stretch in stretches:
        load, more = _advance(stretch, load, room)
        opened = opened + more
        reachable = np.concatenate(([0.0], stretch.head[:-1])) + spent <= room
        head = np.concatenate((head, stretch.head[reachable] + spent))
        load = np.concatenate((load, stretch.leave[reachable]))
        opened = np.concatenate((opened, stretch.opened[reachable]))
        spent += stretch.total
    return Stretch(head, load, opened, spent)


def _entries(parts: pd.Series, stretches: list[Stretch], load: float, batch_no: int, room: int) -> pd.DataFrame:
    """Fill and number of the open batch on entry to each part."""
    rows = []
    for part, stretch in zip(parts, stretches):
        rows.append((part, load, batch_no))
        after, opened = _advance(stretch, np.array([load]), room)
        load, batch_no = float(after[0]), batch_no + int(opened[0])
    return pd.DataFrame(rows, columns=["part", "load", "batch_no"])


def _opening_rows(spent: np.ndarray, load: float, room: int) -> np.ndarray:
    """Marks the rows that open a batch."""
    rows, following = len(spent) - 1, _next_opening(spent, room)
    opens = np.zeros(rows, dtype="int64")
    at = int(np.searchsorted(spent[1:], room - load, side="right"))
    while at < rows:
        opens[at] = 1
        at = int(following[at])
    return opens


def _stretches(frame: pd.DataFrame) -> list[Stretch]:
    return [
        Stretch(np.asarray(row.head), np.asarray(row.leave), np.asarray(row.opened), row.total)
        for row in frame.itertuples(index=False)
    ]


def _entry(frame: pd.DataFrame) -> tuple[float, int]:
    return float(frame["load"].iat[0]), int(frame["batch_no"].iat[0])
