"""Language identification by cross-parsing against suffix automata.

A suffix automaton of a language's labelled text accepts exactly the strings
that occur in it. A text is cut greedily into the longest phrases the automaton
accepts; the closer the languages, the longer the phrases. Cut into p phrases,
each a place in labelled text of n letters, it costs about p log2(n) bits. That
product is the normalised number of phrases; the language with the fewest wins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.llm.common import bounded_batches, receive, send

# The bounded training sample of each language: distinct rows, and their lengths. Longer texts are cut to their middle;
# texts outside these lengths are only taken where there are too few within.
SAMPLE_ROWS = 24
SAMPLE_CHARS = (200, 3000)
# Short texts fill up to SAMPLE_ROWS times the lower length, by this many rows at most.
SHORT_ROWS = 200
# All languages together; with more than about 55 each gets an equal share. An edge of an automaton takes 12 bytes,
# a letter of text up to three edges.
TOTAL_CHARS = 4_000_000
# Table entries (4 bytes) a worker lays out. Automata beyond that are searched as sorted edges, with the same result.
TABLE_ENTRIES = 48_000_000
# Code points parsed side by side in one lane; a longer text takes several lanes.
LANE = 1024
UNDETERMINED = "und"


class Automata:
    """The languages' automata, which restart by themselves.

    Letters are numbered over all languages: 0 parts words, 1 is any letter no
    sample has, further ones are letters. A language has classes for its own
    letters only; all others are class 1, which no state accepts. An entry of a
    table is twice the offset of the next state's row, plus one where the step
    starts a new phrase.
    """

    def __init__(self, texts: dict[str, list[str]]) -> None:
        self.names = sorted(texts)
        known = sorted({letter for name in self.names for text in texts[name] for letter in text.lower() if letter.isalpha()})
        self.letters = np.zeros(0x110000, np.int32)
        self.letters[[code for code in range(0x110000) if chr(code).isalpha()]] = 1
        self.letters[[ord(letter) for letter in known]] = np.arange(2, len(known) + 2)
        self.kind = np.min_scalar_type(len(known) + 2)
        codes = [self._encode("\n".join(texts[name]).lower()) for name in self.names]
        # A phrase costs a place in the labelled text, so more text makes each phrase dearer.
        self.bits = np.array([math.log2(len(code) + 1) for code in codes])
        self.classes = np.ones((len(codes), len(known) + 2), self.kind)  # by language and letter
        self.widths: list[int] = []
        for row, code in zip(self.classes, codes, strict=True):
            own = np.unique(code[code > 1])
            row[0] = 0
            row[own] = np.arange(2, len(own) + 2)
            self.widths.append(len(own) + 2)
        built = [self._edges(row[code]) for row, code in zip(self.classes, codes, strict=True)]
        self.sizes = [size + 1 for size, _ in built]  # the last state is for letters the language lacks
        self.edges = [tuple(part.astype(np.int32) for part in edges) for _, edges in built]
        # Tables for the smallest automata, as many as fit.
        entries = [size * width for size, width in zip(self.sizes, self.widths, strict=True)]
        order = sorted(range(len(entries)), key=lambda language: entries[language])
        fitting = int(np.searchsorted(np.cumsum([entries[language] for language in order]), TABLE_ENTRIES, "right"))
        self.tabled, self.searched = sorted(order[:fitting]), sorted(order[fitting:])
        self.starts = np.cumsum([0, *[entries[language] for language in self.tabled]])[:-1]
        self.table: np.ndarray | None = None

    def _encode(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
        found = self.letters[codes].astype(self.kind)
        return found[np.concatenate(([True], (found[1:] != 0) | (found[:-1] != 0)))] if len(found) else found

    @staticmethod
    def _edges(codes: np.ndarray) -> tuple[int, tuple[np.ndarray, ...]]:
        """The suffix automaton of ``codes``, built online, as its edges."""
        step: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for code in codes.tolist():
            new = len(step)
            step.append({})
            length.append(length[last] + 1)
            link.append(0)
            state = last
            while state >= 0 and code not in step[state]:
                step[state][code] = new
                state = link[state]
            if state >= 0:
                target = step[state][code]
                if length[target] == length[state] + 1:
                    link[new] = target
                else:
                    copy = len(step)
                    step.append(dict(step[target]))
                    length.append(length[state] + 1)
                    link.append(link[target])
                    while state >= 0 and step[state].get(code) == target:
                        step[state][code] = copy
                        state = link[state]
                    link[target] = link[new] = copy
            last = new
        flat = [(source, code, target) for source, row in enumerate(step) for code, target in row.items()]
        return len(step), tuple(np.array(column, np.int64) for column in zip(*flat, strict=True)) if flat else (np.zeros(0, np.int64),) * 3

    def _restart(self, language: int) -> np.ndarray:
        """The state after a phrase that starts with each class."""
        source, letter, target = self.edges[language]
        restart = np.full(self.widths[language], self.sizes[language] - 1, np.int64)
        restart[letter[source == 0]] = target[source == 0]
        return restart

    def _build(self) -> np.ndarray:
        table = np.empty(sum(self.sizes[language] * self.widths[language] for language in self.tabled), np.int32)
        for start, language in zip(self.starts.tolist(), self.tabled, strict=True):
            size, width = self.sizes[language], self.widths[language]
            source, letter, target = self.edges[language]
            rows = table[start:start + size * width].reshape(size, width)
            rows[:] = 2 * (start + width * self._restart(language)) + 1
            rows[0] -= 1  # a text's first letter starts no further phrase
            rows[source, letter] = 2 * (start + width * target.astype(np.int64))
        return table

    def _by_table(self, grid: np.ndarray, live: list[int]) -> np.ndarray:
        if self.table is None:
            self.table = self._build()
        classes = self.classes[self.tabled]
        state = np.repeat(self.starts[:, None], grid.shape[1], axis=1).astype(np.int32)
        count = np.zeros(state.shape, np.int32)
        for row, width in zip(grid, live, strict=True):
            found = self.table[state[:, :width] + classes[:, row[:width]]]
            count[:, :width] += found & 1
            state[:, :width] = found >> 1
        return count

    def _by_search(self, grid: np.ndarray, live: list[int], language: int) -> np.ndarray:
        classes, width, restart = self.classes[language], self.widths[language], self._restart(language)
        source, letter, target = self.edges[language]
        keys = source.astype(np.int64) * width + letter
        order = np.argsort(keys)
        keys, target = np.append(keys[order], np.iinfo(np.int64).max), np.append(target[order], 0)
        state, count = np.zeros(grid.shape[1], np.int64), np.zeros(grid.shape[1], np.int32)
        for row, size in zip(grid, live, strict=True):
            at, step = state[:size], classes[row[:size]]
            wanted = at * width + step
            place = np.searchsorted(keys, wanted)
            known = keys[place] == wanted
            count[:size] += ~known & (at != 0)
            state[:size] = np.where(known, target[place], restart[step])
        return count

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(languages x texts) phrases, and the letters of each text.

        Texts run side by side, one letter a step. A text longer than a lane
        continues in the next one, which starts a phrase; that adds less than
        one phrase in LANE letters, to every language alike.
        """
        codes = [self._encode(text.lower()) for text in texts]
        letters = np.array([int(np.count_nonzero(code)) for code in codes], np.int64)
        lanes = [(owner, code[start:start + LANE]) for owner, code in enumerate(codes) for start in range(0, len(code), LANE)]
        lanes.sort(key=lambda lane: -len(lane[1]))
        total = np.zeros((len(self.names), len(texts)), np.int64)
        if not lanes:
            return total, letters
        lengths = np.array([len(code) for _, code in lanes])
        grid = np.zeros((int(lengths[0]), len(lanes)), self.kind)
        for number, (_, code) in enumerate(lanes):
            grid[:len(code), number] = code
        live = np.searchsorted(-lengths, -np.arange(len(grid)), side="left").tolist()
        count = np.zeros((len(self.names), len(lanes)), np.int32)
        if self.tabled:
            count[self.tabled] = self._by_table(grid, live)
        for language in self.searched:
            count[language] = self._by_search(grid, live, language)
        count += 1  # the last phrase of a lane has no step that ends it
        for language in range(len(self.names)):
            total[language] = np.bincount([owner for owner, _ in lanes], count[language], len(texts)).astype(np.int64)
        return total, letters

    def judge(self, texts: list[str]) -> tuple[list[str], list[float], list[float]]:
        """Language, score and letters per phrase of each text."""
        phrases, letters = self.phrases(texts)
        names, scores, lengths = [], [], []
        for column, size in zip(phrases.T, letters.tolist(), strict=True):
            if not size or not self.names:
                names.append(UNDETERMINED)
                scores.append(0.0)
                lengths.append(0.0)
                continue
            bits = column * self.bits
            best = int(bits.argmin())
            scores.append(float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum()))
            names.append(self.names[best])
            lengths.append(size / int(column[best]))
        return names, scores, lengths


def training_sample(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang") -> dict[str, list[str]]:
    """Distinct texts of every language that has a text, in an order fixed by their hash.

    Each gets SAMPLE_ROWS texts of SAMPLE_CHARS characters; where these are under
    SAMPLE_ROWS times the lower length together, longer ones cut to their middle
    and shorter ones fill up to that. Copies
    share a hash, so they are one text here; null and empty texts teach nothing.
    The driver gets at most SHORT_ROWS rows of bounded length a language and
    keeps TOTAL_CHARS characters, shared alike. No rows give no language.
    """
    low, high = SAMPLE_CHARS
    size = F.length(f"`{text}`")
    picked = docs.filter(learn & (size > 0) & F.col(f"`{lang}`").isNotNull()).select(
        F.col(f"`{lang}`").cast("string").alias("lang"),
        F.xxhash64(f"`{text}`").alias("sum"),
        (~size.between(low, high)).alias("odd"),
        (size < low).alias("short"),
        F.least(size, F.lit(high)).alias("size"),
        F.substring(F.col(f"`{text}`"), F.greatest(F.floor((size - high) / 2), F.lit(0)).cast("int") + 1, F.lit(high)).alias("text"),
    )
    order = Window.partitionBy("lang").orderBy("odd", "short", "sum", "size")
    # The rank is limited before the exchange, so a language of most rows sends SHORT_ROWS a task.
    ranked = picked.select("lang", "sum", "odd", "short", "size").distinct().withColumn("place", F.row_number().over(order)).filter(
        F.col("place") <= SHORT_ROWS
    )
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chosen = ranked.withColumn("before", before).filter(
        (~F.col("odd") & (F.col("place") <= SAMPLE_ROWS)) | (F.col("before") < SAMPLE_ROWS * low)
    )
    rows = picked.join(F.broadcast(chosen.select("lang", "sum", "place")), ["lang", "sum"]).groupBy("lang", "sum").agg(
        F.min("place").alias("place"), F.min("text").alias("text")
    ).collect()
    share = TOTAL_CHARS // max(len({row.lang for row in rows}), 1)
    found: dict[str, list[str]] = {}
    taken: dict[str, int] = {}
    for row in sorted(rows, key=lambda row: (row.lang, row.place, row.sum)):
        if taken.get(row.lang, 0) < share:
            found.setdefault(row.lang, []).append(row.text[:share - taken.get(row.lang, 0)])
            taken[row.lang] = taken.get(row.lang, 0) + len(row.text)
    return found


def identify(
    docs: DataFrame, texts: dict[str, list[str]], keys: tuple[str, ...] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """The columns ``keys`` of every row of ``docs``, lang_pred, score and letters_per_phrase.

    ``texts`` holds labelled texts by language. A null text, one without a
    letter, or no languages at all gives ``und``, score 0. The score is the
    winner's share when each language weighs two to the minus its code length;
    ties go to the first name. Rows do not depend on each other, so repeated
    rows get the same answer; other columns are not read, whatever their names.
    A very long text is parsed in lanes of LANE letters; an empty table gives
    an empty result. No shuffle: the automata travel as edges that TOTAL_CHARS
    bounds (150 MB; five languages take about 5), and each worker lays those
    that fit out as tables once.
    """
    bounded_batches(docs.sparkSession)
    model = send(docs.sparkSession, Automata(texts))
    kinds = [docs.schema[name].dataType.simpleString() for name in keys]
    names = [f"k{number}" for number in range(len(keys))] + ["lang_pred", "score", "letters_per_phrase"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = receive(model)
        for batch in batches:
            found = automata.judge([value or "" for value in batch.column(batch.num_columns - 1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(*pair) for pair in zip(found, (pa.string(), pa.float64(), pa.float64()), strict=True))],
                names=names,
            )

    picked = docs.select(*[F.col(f"`{name}`").alias(f"k{number}") for number, name in enumerate(keys)], F.col(f"`{text}`").alias("t"))
    schema = ", ".join(f"k{number} {kind}" for number, kind in enumerate(kinds))
    return picked.mapInArrow(work, f"{schema}, lang_pred string, score double, letters_per_phrase double").toDF(
        *keys, "lang_pred", "score", "letters_per_phrase"
    )
