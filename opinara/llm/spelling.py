"""Spelling variants: words one edit apart, found by search schemes over FM-indexes.

Two words one edit apart agree in a half of the shorter one, as the edit lies
in the other. The vocabulary is dealt out by those halves, so that words that
can be near meet in one shard. A shard writes its words one after the other
between delimiters and indexes them: the suffixes in order, and for a character
and a rank the rank of the suffix with that character in front. A search starts
at the delimiter behind a word, matches the common half exactly, and goes on
across the other half with one error allowed, carrying intervals of suffix
ranks. Front halves are matched on the words read backwards: the two indexes are
the two directions of the scheme.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import bounded_batches, keep, keep_table

# Fixed values of the vocabulary: runs of letters, one of CHANGED runs loses a letter; lengths and occurrences.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
CHANGED = 199
MIN_LENGTH, MIN_COUNT = 6, 5
# A word's form is at least so many times as frequent.
FORM_RATIO = 5
# Distinct words that a task holds before it hands its counts on.
HELD_WORDS = 300_000
# Characters that a shard indexes on average, and words of one half that share an index at most.
SHARD_CHARS, BLOCK_WORDS = 300_000, 20_000
# So many crowded halves are sent to all executors; more are joined.
BROADCAST_HALVES = 100_000
# Intervals up to this size are looked through; larger ones are asked for every character.
SMALL = 16
# Words that are asked at once: each may stand for as many intervals as there are letters.
ASKED_WORDS = 4000


def text_runs(doc_id: int | str | None, text: str) -> Counter[str]:
    """The runs of a text after the deletions, those long enough to be words, with their counts."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    found: Counter[str] = Counter()
    for run, n in Counter(RUN.findall(text.encode().lower().decode())).items():
        if len(run) < MIN_LENGTH:
            continue
        mark = zlib.crc32(run.encode(), start)
        if mark % CHANGED == 0:
            place = mark % len(run)
            run = run[:place] + run[place + 1:]
        if len(run) >= MIN_LENGTH:
            found[run] += n
    return found


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words of ``docs``; tasks add up what they read before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            done = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"]
            )
            held.clear()
            return done

        for batch in batches:
            for doc_id, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if own:
                    held.update(text_runs(doc_id, own))
                if len(held) >= HELD_WORDS:
                    yield flush()
        yield flush()

    bounded_batches(docs.sparkSession)
    read = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    parts = read.mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


class FmIndex:
    """Distinct words between delimiters, searched backwards from the delimiter behind a word."""

    def __init__(self, words: list[str]) -> None:
        codes = np.frombuffer(("\0" + "\0".join(words) + "\0").encode("utf-32-le"), dtype=np.uint32)
        self.alphabet = np.unique(codes)
        self.text = np.searchsorted(self.alphabet, codes).astype(np.int64)
        size = self.size = len(codes)
        ends = np.flatnonzero(self.text == 0)
        self.words = len(words)
        # Suffixes are compared up to their delimiter; equal ones follow their places, as the mapping below needs.
        stop = ends[np.searchsorted(ends, np.arange(size))]
        rank, width, longest = self.text.copy(), 1, int((stop - np.arange(size)).max(initial=0)) + 1
        while width < longest:
            after = np.arange(size) + width
            second = np.where(after <= stop, rank[np.minimum(after, size - 1)] + 1, 0)
            pair = rank * (size + 2) + second
            rank = np.unique(pair, return_inverse=True)[1]
            width *= 2
        self.order = np.argsort(rank, kind="stable")
        self.before = self.text[self.order - 1]
        self.ranks = np.sort(self.before * size + np.arange(size))
        self.word_of = np.cumsum(self.text == 0) - 1  # at a word's first letter: its number

    def codes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(letters of all words, one row each, -1 where the index lacks them or the word has ended; lengths)."""
        sizes = np.array([len(word) for word in words], dtype=np.int64)
        flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        at = np.minimum(np.searchsorted(self.alphabet, flat), len(self.alphabet) - 1)
        known = np.where(self.alphabet[at] == flat, at, -1)
        starts = np.cumsum(sizes) - sizes
        return known, starts

    def step(self, char: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the suffixes with ``char`` in front."""
        base = char * self.size
        none = char < 0
        low, high = np.searchsorted(self.ranks, base + low), np.searchsorted(self.ranks, base + high)
        return np.where(none, 0, low), np.where(none, 0, high)

    def whole(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """For intervals matched to a word's front: the word's number, -1 if no word is just that."""
        first = np.searchsorted(self.ranks, low)
        found = np.minimum(first, self.size - 1)
        row = self.ranks[found]  # the delimiter's own block comes first: its ranks are plain rows
        return np.where((first < self.words + 1) & (row < high), self.word_of[self.order[np.minimum(row, self.size - 1)]], -1)


def near_pairs(texts: list[str], queries: list[str], exact: np.ndarray, longer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the query, number of the text) of pairs one edit apart that agree in the query's last ``exact`` letters.

    A ``longer`` query loses a letter; any other one has a letter replaced by
    a later one. That is every pair once, seen from one of its two words.
    """
    index = FmIndex(texts)
    asked, known = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for start in range(0, len(queries), ASKED_WORDS):
        some = slice(start, start + ASKED_WORDS)
        number, text = _near_some(index, queries[some], exact[some], longer[some])
        asked.append(number + start)
        known.append(text)
    return np.concatenate(asked), np.concatenate(known)


def _near_some(index: FmIndex, queries: list[str], exact: np.ndarray, longer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    letters, starts = index.codes(queries)
    left = np.array([len(query) for query in queries], dtype=np.int64)
    bound = left - exact  # letters that may be wrong
    who = np.arange(len(queries))
    low, high = np.zeros_like(left), np.full_like(left, index.words + 1)
    none = np.empty(0, dtype=np.int64)
    erred = (none, none, none, none)  # query, letters left, interval
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while len(who) or len(erred[0]):
        # Those with their error behind them: out at the front of the word, or one exact step on.
        query, rest, at, to = erred
        done = rest == 0
        if done.any():
            word = index.whole(at[done], to[done])
            found.append((query[done][word >= 0], word[word >= 0]))
            query, rest, at, to = (part[~done] for part in (query, rest, at, to))
        at, to = index.step(letters[starts[query] + rest - 1], at, to)
        alive = at < to
        parts = [(query[alive], rest[alive] - 1, at[alive], to[alive])]
        # The error, where it is allowed.
        may = (left > 0) & (left <= bound[who])
        drop = may & longer[who]
        parts.append((who[drop], left[drop] - 1, low[drop], high[drop]))
        swap = np.flatnonzero(may & ~longer[who])
        if len(swap):
            own = letters[starts[who[swap]] + left[swap] - 1]
            small = high[swap] - low[swap] <= SMALL
            width = np.where(small, high[swap] - low[swap], len(index.alphabet))
            row = np.repeat(np.arange(len(swap)), width)
            place = np.arange(len(row)) - np.repeat(np.cumsum(width) - width, width)
            seen = index.before[np.minimum(low[swap][row] + place, index.size - 1)]
            char = np.where(small[row], seen, place)
            # A letter the index lacks has no code; then all of the index's letters are later ones.
            fits = (char > own[row]) & (char > 0)
            both = np.unique(row[fits] * len(index.alphabet) + char[fits])
            row, char = both // len(index.alphabet), both % len(index.alphabet)
            at, to = index.step(char, low[swap][row], high[swap][row])
            alive = at < to
            row = swap[row[alive]]
            parts.append((who[row], left[row] - 1, at[alive], to[alive]))
        erred = tuple(np.concatenate(columns) for columns in zip(*parts, strict=True))
        # The exact ones go on by a letter; a word at its front has no error left to make.
        more = left > 0
        who, left, low, high = who[more], left[more], low[more], high[more]
        low, high = index.step(letters[starts[who] + left - 1], low, high)
        alive = low < high
        who, left, low, high = who[alive], left[alive] - 1, low[alive], high[alive]
    if not found:
        return none, none
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _search(frame: pd.DataFrame) -> pd.DataFrame:
    """Both directions of all near pairs of a shard: word, near, near_n."""
    words, numbers = frame["word"].tolist(), frame["n"].to_numpy()
    turned = frame["side"].iat[0] == 0
    oriented = [word[::-1] for word in words] if turned else words
    texts: dict[str, int] = {}
    for row in np.flatnonzero(frame["indexed"].to_numpy()):
        texts.setdefault(oriented[row], row)
    asked, known = near_pairs(list(texts), oriented, frame["half"].to_numpy(), frame["longer"].to_numpy())
    rows = np.fromiter(texts.values(), dtype=np.int64, count=len(texts))[known]
    names = np.array(words, dtype=object)
    one, two = np.concatenate([asked, rows]), np.concatenate([rows, asked])
    return pd.DataFrame({"word": names[one], "near": names[two], "near_n": numbers[two]}).drop_duplicates()


def _halves() -> Column:
    """The halves of ``word`` as the shorter or equal one of a pair, and as the longer one."""
    size = F.char_length("word")

    def pair(length: Column, longer: bool) -> list[Column]:
        half = F.floor(length / 2).cast("int")
        rest = (length - half).cast("int")
        return [
            F.struct(F.lit(0).alias("side"), half.alias("half"), F.lit(longer).alias("longer"), length.alias("length"),
                     F.substring("word", F.lit(1), half).alias("part")),
            F.struct(F.lit(1).alias("side"), rest.alias("half"), F.lit(longer).alias("longer"), length.alias("length"),
                     F.substring("word", size - rest + 1, rest).alias("part")),
        ]

    return F.explode(F.array(*pair(size, False), *pair((size - 1).cast("int"), True)))


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): every two words of ``words`` (word, n) that are one edit apart, from both sides, once each."""
    spark = words.sparkSession
    keyed = words.select("word", "n", _halves().alias("key")).select("word", "n", "key.*")
    group = ("side", "length", "part")
    crowded = keep(keyed.groupBy(*group).count().filter(F.col("count") > BLOCK_WORDS).select(
        *group, F.ceil(F.col("count") / BLOCK_WORDS).cast("int").alias("blocks")
    ))
    many = crowded.count()
    if many:
        # The words of a crowded half are indexed in blocks and ask all of them.
        placed = keyed.join(F.broadcast(crowded) if many <= BROADCAST_HALVES else crowded, list(group), "left")
        blocks = F.coalesce("blocks", F.lit(1))
        own = F.pmod(F.xxhash64("word"), blocks)
        placed = placed.withColumns({"own": own, "block": F.explode(F.sequence(F.lit(0), blocks - 1))})
        keyed = placed.withColumn("indexed", F.col("own") == F.col("block"))
    else:
        keyed = keyed.withColumns({"block": F.lit(0), "indexed": F.lit(True)})
    letters = words.agg(F.sum(F.char_length("word"))).first()[0] or 0
    shards = max(1, -(-2 * letters // SHARD_CHARS))  # of each side
    dealt = keyed.select(
        "word", "n", "side", "half", "longer", "indexed",
        F.pmod(F.xxhash64(*group, "block"), F.lit(shards)).alias("shard"),
    )
    spread = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * shards)
    found = dealt.repartition(spread, "side", "shard").groupBy("side", "shard").applyInPandas(
        _search, "word string, near string, near_n long"
    )
    # A pair that agrees in both halves, or in a repeated letter, is found more than once.
    return found.groupBy("word", "near").agg(F.first("near_n").alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form), form null at the end of a chain. A form is far more frequent, so chains are short."""
    linked = keep(forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    moved = not linked.isEmpty()
    while moved:
        jump = linked.select(F.col("word").alias("_at"), F.col("root").alias("_far"))
        linked = keep(linked.select("word", "root").join(jump, F.col("root") == F.col("_at"), "left").select(
            "word", F.coalesce("_far", "root").alias("root"), F.col("_far").isNotNull().alias("moved")
        ))
        moved = not linked.filter("moved").isEmpty()
    return linked.select("word", "root")


def variants(words: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every row of ``words`` (word, n), words once each.

    A word's form is its near word with the largest n (ties: the first by code
    point), if that is at least FORM_RATIO times its own n; root follows the
    forms to the last. A word without a form is its own root. An empty table
    gives an empty result.
    """
    near = near_words(words).groupBy(F.col("word").alias("_word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    best = -F.col("best.less")
    strong = best >= F.col("n") * FORM_RATIO
    formed = keep(words.join(near, F.col("word") == F.col("_word"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("best.near")).alias("form"), F.when(strong, best).alias("form_n"),
    ))
    ends = roots(formed).withColumnRenamed("word", "_word")
    return formed.join(ends, F.col("word") == F.col("_word"), "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The words of ``docs`` with their forms and roots (see ``variants``).

    Null and empty texts have no words; texts of any length are read whole. A
    null key prints as nothing in front of the colon. Every row counts, also a
    repeated one. Other columns, whatever their names, are not read; an empty
    table gives an empty result.
    """
    return variants(keep_table(vocabulary(docs, key, text)))
