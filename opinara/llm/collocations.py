"""Phrases whose words belong together, mined by counting in burstable tries.

Phrases are counted one length after the other. Every task counts in a
HAT-trie: word ids lead to hash containers that hold the rest of a phrase; a
container that grows too large bursts into one container per next word. A task
that holds too many phrases spills whole subtrees, largest first, as sorted
runs of (prefix, last word, count); runs are merged by partitions of prefixes.

A phrase is frequent only if what is left without its first and without its
last word is. So a length is counted only where both parts are frequent: tasks
ask a Bloom filter of the frequent phrases one word shorter. And a first
reading adds up the hashes of the phrases left in buckets, all documents
together: a phrase in a bucket that stays below the least count is infrequent
too. Neither test ever denies a frequent phrase; what they let through wrongly
is counted as it stands and then found infrequent.
"""

from __future__ import annotations

import struct
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.llm.common import bounded_batches, keep_table, receive, send

LEAST = 100  # occurrences of a candidate
LONGEST = 5  # words
TOP = 2000  # phrases of a language in the report
NO_LANGUAGE = "und"
# Phrases and distinct words a task holds before it spills, phrases a container holds before it bursts.
HELD_PHRASES, HELD_WORDS, BURST = 600_000, 400_000, 4_096
# Bytes cut into words at a time, bucket numbers held before they are handed on.
HELD_BYTES, HELD_BUCKETS = 2_000_000, 4_000_000
# Prefix partitions: some, and one more for so many words of the corpus; parts that the last words of one prefix are dealt to.
LEAST_PARTS, WORDS_PER_PART, SLOTS = 64, 4_000_000, 16
# Bits of a filter: BITS_PER_PHRASE a phrase; buckets: one for WORDS_PER_BUCKET words of the corpus. Both stay between
# these bounds. Beyond the upper one more phrases are let through and counted; none is lost.
BITS_PER_PHRASE, WORDS_PER_BUCKET, LEAST_BITS, MOST_BITS = 16, 8, 1 << 17, 1 << 29
BITMAP = 1 << 15  # bits of one of Spark's bitmaps
PART = 1 << 17  # buckets added up together

# What ends a piece becomes a full stop, tabs become spaces, A-Z lower case. No word holds a full stop.
STOP, SPACE = b".", b" "
PLAIN = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b".......... abcdefghijklmnopqrstuvwxyz")


def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    """Texts of a batch of (lang, text), by language, lower case, pieces ended by full stops: about HELD_BYTES at a time.

    A long text is cut behind a piece; only a longer piece makes a longer part.
    """
    found: dict[str, list[str]] = defaultdict(list)
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        if text:
            found[NO_LANGUAGE if lang is None else lang].append(text)
    for lang, texts in found.items():
        plain = ".".join([*texts, ""]).encode().translate(PLAIN)
        start = 0
        while start < len(plain):
            end = plain.rfind(STOP, start, start + HELD_BYTES) + 1 or plain.find(STOP, start) + 1
            yield lang, plain[start:end]
            start = end


class Words(NamedTuple):
    """The words of a part, single spaces between them: where they are, their pieces, their hashes."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    pieces: np.ndarray
    hashes: np.ndarray


# Powers of an odd number, by place, and of its inverse: the hash of a word does not depend on where it stands.
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < count:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(count, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"], _POWERS["down"]


def words_of(plain: bytes) -> Words:
    while b"  " in plain:
        plain = plain.replace(b"  ", SPACE)
    letters = np.frombuffer(plain, dtype=np.uint8)
    stops = letters == STOP[0]
    inside = np.concatenate([[False], ~stops & (letters != SPACE[0]), [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers(len(letters) + 1)
    sums = np.zeros(len(letters) + 1, dtype=np.uint64)
    np.cumsum((letters.astype(np.uint64) + np.uint64(1)) * up[:len(letters)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    return Words(plain, starts, ends, np.cumsum(stops, dtype=np.int64)[starts], _stirred(hashes))


def _stirred(hashes: np.ndarray) -> np.ndarray:
    mixed = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(29))


def phrase_hashes(words: Words, lang: str, size: int) -> np.ndarray:
    """Hashes of the phrases of ``size`` words that begin at each word, in pieces or not, as far as there are words."""
    count = max(len(words.starts) - size + 1, 0)
    lead = np.full(count, int.from_bytes(lang.encode()[:8], "little"), dtype=np.uint64)
    for step in range(size):
        lead = _stirred(lead * np.uint64(3) + words.hashes[step:step + count])
    return lead


# --- filters -------------------------------------------------------------------

def _bits_for(count: int) -> int:
    bits = LEAST_BITS
    while bits < min(count, MOST_BITS):
        bits *= 2
    return bits


def _probes(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return hashes & mask, (hashes >> np.uint64(33)) & mask


def _set(filter_bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (filter_bits[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1 == 1


def phrase_filter(phrases: DataFrame, size: int) -> Broadcast:
    """A Bloom filter of ``phrases`` (lang, phrase, ...): bits set by tasks, put together as bitmaps of 4 KB."""
    bits = _bits_for(phrases.count() * BITS_PER_PHRASE)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, plain in by_language(batch):
                places = np.unique(np.concatenate(_probes(phrase_hashes(words_of(plain), lang, size), bits))).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(places // BITMAP), pa.array(places % BITMAP)], ["part", "bit"])

    parts = phrases.select("lang", "phrase").mapInArrow(probe, "part long, bit long").groupBy("part").agg(
        F.bitmap_construct_agg("bit").alias("bits")
    )
    return _gathered(parts, bits)


def _gathered(parts: DataFrame, bits: int) -> Broadcast:
    """Broadcast (part, bits), all parts equally long, MOST_BITS together at most."""
    filled = np.zeros(bits // 8, dtype=np.uint8)
    for part, found in parts.select("part", "bits").collect():
        filled[part * len(found):(part + 1) * len(found)] = np.frombuffer(found, dtype=np.uint8)
    return send(parts.sparkSession, filled)


def _candidates(words: Words, lang: str, size: int, known: np.ndarray, full: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the phrases inside a piece whose two parts are in ``known`` and whose bucket is ``full``."""
    whole = phrase_hashes(words, lang, size)
    places = np.flatnonzero(words.pieces[:len(whole)] == words.pieces[size - 1:])
    parts = phrase_hashes(words, lang, size - 1)
    for shift, second in ((0, 0), (0, 1), (1, 0), (1, 1)):
        places = places[_set(known, _probes(parts[places + shift], len(known) * 8)[second])]
    if full is not None:
        places = places[_set(full, whole[places] & np.uint64(len(full) * 8 - 1))]
    return places, whole[places]


def bucket_filter(docs: DataFrame, size: int, known: Broadcast, corpus_words: int, least: int) -> Broadcast:
    """Which buckets hold ``least`` or more of the phrases of ``size`` words left by ``known``, over all of ``docs`` (lang, text).

    Tasks hand on sorted bucket numbers as steps of one byte (255: and more)
    and counts cut off at 255; parts of PART buckets are added up as they come.
    """
    buckets, held_buckets = _bits_for(corpus_words // WORDS_PER_BUCKET), HELD_BUCKETS

    def note(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_bits, held = receive(known), []

        def flush() -> Iterator[pa.RecordBatch]:
            numbers, counts = np.unique(np.concatenate([np.empty(0, dtype=np.uint32), *held]), return_counts=True)
            held.clear()
            cuts = [0, *(np.flatnonzero(np.diff(numbers // PART)) + 1).tolist(), len(numbers)]
            rows: list[tuple[int, bytes, bytes]] = []
            for start, end in zip(cuts, cuts[1:], strict=False):
                if end > start:
                    part = numbers[start:end]
                    steps = np.diff(part % PART, prepend=0).astype(np.int64)
                    coded = np.full(int((steps // 255 + 1).sum()), 255, dtype=np.uint8)
                    coded[np.cumsum(steps // 255 + 1) - 1] = steps % 255
                    rows.append((int(part[0]) // PART, coded.tobytes(), np.minimum(counts[start:end], 255).astype(np.uint8).tobytes()))
            columns = [list(column) for column in zip(*rows, strict=True)] if rows else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), *(pa.array(column, pa.binary()) for column in columns[1:])], ["part", "steps", "counts"]
            )

        for batch in batches:
            for lang, plain in by_language(batch):
                held.append((_candidates(words_of(plain), lang, size, filter_bits)[1] & np.uint64(buckets - 1)).astype(np.uint32))
            if sum(map(len, held)) >= held_buckets:
                yield from flush()
        yield from flush()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, coded, counts in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                steps = np.frombuffer(coded, dtype=np.uint8)
                places = np.cumsum(steps, dtype=np.int64)[steps < 255]
                total = sums.setdefault(part, np.zeros(PART, dtype=np.int64))
                total[places] += np.frombuffer(counts, dtype=np.uint8)
        full = [np.packbits(total >= least, bitorder="little").tobytes() for total in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(full, pa.binary())], ["part", "bits"])

    noted = docs.mapInArrow(note, "part long, steps binary, counts binary")
    return _gathered(noted.repartition("part").mapInArrow(add, "part long, bits binary"), buckets)


# --- counting ------------------------------------------------------------------

class Branch(dict):
    """A burst container: the next word's id leads on."""


class PhraseTrie:
    """Counts of phrases of one length; a word is its id in four bytes."""

    def __init__(self, size: int, burst: int = BURST) -> None:
        self.size, self.burst = size, burst
        self.roots: dict[str, Branch] = defaultdict(Branch)
        self.held = 0

    def add(self, lang: str, ids: np.ndarray, places: np.ndarray) -> None:
        """Count the phrases of ``ids`` that begin at ``places``, first word by first word."""
        if not len(places):
            return
        places = places[np.argsort(ids[places], kind="stable")]
        firsts = ids[places]
        rests = ids[places[:, None] + np.arange(1, self.size)].view(f"V{4 * (self.size - 1)}").ravel().tolist()
        cuts = [0, *(np.flatnonzero(np.diff(firsts)) + 1).tolist(), len(places)]
        for start, end in zip(cuts, cuts[1:], strict=False):
            self._insert(self.roots[lang], firsts[start].tobytes(), rests[start:end])

    def _insert(self, above: Branch, step: bytes, rests: list[bytes]) -> None:
        node = above.get(step)
        if type(node) is Branch:
            parted: dict[bytes, list[bytes]] = defaultdict(list)
            for rest in rests:
                parted[rest[:4]].append(rest[4:])
            for lead, more in parted.items():
                self._insert(node, lead, more)
            return
        if node is None:
            node = above[step] = Counter()
        before = len(node)
        node.update(rests)
        self.held += len(node) - before
        if len(node) > self.burst and len(rests[0]) > 4:
            burst = above[step] = Branch()
            for rest, n in node.items():
                if rest[:4] not in burst:
                    burst[rest[:4]] = Counter()
                burst[rest[:4]][rest[4:]] = n

    def _walk(self, node: dict, lead: bytes) -> Iterator[tuple[bytes, int]]:
        if type(node) is Branch:
            for step, child in node.items():
                yield from self._walk(child, lead + step)
        else:
            for rest, n in node.items():
                yield lead + rest, n

    def _held(self, node: dict) -> int:
        return sum(map(self._held, node.values())) if type(node) is Branch else len(node)

    def spill(self, words: list[bytes], keep: int = 0) -> Iterator[tuple[str, str, str, int]]:
        """Take out whole subtrees, largest first, until ``keep`` phrases are left: sorted (lang, prefix, last, n)."""
        sizes = {(lang, first): self._held(node) for lang, roots in self.roots.items() for first, node in roots.items()}
        ids = struct.Struct(f"={self.size}i")
        for lang, first in sorted(sizes, key=lambda root: -sizes[root]):
            if self.held <= keep:
                break
            run = []
            for phrase, n in self._walk(self.roots[lang].pop(first), first):
                *lead, last = ids.unpack(phrase)
                run.append((lang, b" ".join([words[i] for i in lead]).decode(), words[last].decode(), n))
            self.held -= sizes[lang, first]
            run.sort()
            yield from run


class _Ids(dict):
    """Numbers words as they come."""

    def __init__(self) -> None:
        super().__init__()
        self.words: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        return number

    def line(self, words: Words, places: np.ndarray, size: int) -> np.ndarray:
        """The numbers of the words that phrases at ``places`` are made of; other words get none."""
        used = np.zeros(len(words.starts), dtype=bool)
        for step in range(size):
            used[places + step] = True
        at = np.flatnonzero(used)
        found = [words.data[a:b] for a, b in zip(words.starts[at].tolist(), words.ends[at].tolist(), strict=True)]
        numbers = np.full(len(used), -1, dtype=np.int32)
        numbers[at] = np.fromiter(map(self.__getitem__, found), dtype=np.int32, count=len(found))
        return numbers


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, n) of single words; the empty phrase counts all words."""
    held: dict[str, Counter[bytes]] = defaultdict(Counter)

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            counts[b""] = counts.total()
            yield _rows([[lang] * len(counts), [word.decode() for word in counts], list(counts.values())], ["lang", "phrase", "n"])
        held.clear()

    for batch in batches:
        for lang, plain in by_language(batch):
            held[lang].update(plain.replace(STOP, SPACE).split())
        if sum(map(len, held.values())) >= HELD_WORDS:
            yield from flush()
    yield from flush()


def _rows(columns: list[list], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string()] * (len(names) - 1) + [pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names)


def _part(lang: str, prefix: str, last: str, parts: int) -> int:
    """The prefix partition of a phrase; a prefix that stands before very many words has SLOTS of them, by the last word."""
    return zlib.crc32(f"{lang} {prefix} {zlib.crc32(last.encode()) % SLOTS}".encode()) % parts


def count_phrases(
    docs: DataFrame, size: int, known: Broadcast, full: Broadcast, corpus_words: int, least: int = LEAST
) -> DataFrame:
    """(lang, phrase, n) of the phrases of ``size`` words, two or more, found ``least`` times or more in ``docs`` (lang, text).

    A spilled run is cut by prefix partition and packed: its phrases in order,
    a line each, and their counts. A partition is merged run after run.
    """
    held_phrases, held_words = HELD_PHRASES, HELD_WORDS
    parts = LEAST_PARTS + corpus_words // WORDS_PER_PART

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_bits, full_bits, ids, trie = receive(known), receive(full), _Ids(), PhraseTrie(size)

        def runs(keep: int) -> Iterator[pa.RecordBatch]:
            packed: dict[tuple[int, str], tuple[list[str], list[int]]] = defaultdict(lambda: ([], []))
            for lang, prefix, last, n in trie.spill(ids.words, keep):
                phrases, counts = packed[_part(lang, prefix, last, parts), lang]
                phrases.append(f"{prefix} {last}")
                counts.append(n)
            for (part, lang), (phrases, counts) in packed.items():
                yield pa.RecordBatch.from_pydict({
                    "part": [part], "lang": [lang], "phrases": ["\n".join(phrases)], "counts": [np.array(counts, dtype=np.int64).tobytes()],
                })

        for batch in batches:
            for lang, plain in by_language(batch):
                words = words_of(plain)
                places = _candidates(words, lang, size, known_bits, full_bits)[0]
                trie.add(lang, ids.line(words, places, size), places)
                if trie.held >= held_phrases:
                    yield from runs(held_phrases // 2)
            if len(ids) >= held_words:
                yield from runs(0)
                ids = _Ids()
        yield from runs(0)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sums = None, Counter()

        def done() -> pa.RecordBatch:
            often = [(phrase, n) for phrase, n in sums.items() if n >= least]
            return _rows([[at[1]] * len(often), [phrase for phrase, _ in often], [n for _, n in often]], ["lang", "phrase", "n"])

        for batch in batches:
            for part, lang, phrases, counts in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if at is not None and at != (part, lang):
                    yield done()
                    sums.clear()
                at = part, lang
                for phrase, n in zip(phrases.split("\n"), np.frombuffer(counts, dtype=np.int64).tolist(), strict=True):
                    sums[phrase] += n
        if at is not None:
            yield done()

    runs = docs.mapInArrow(count, "part long, lang string, phrases string, counts binary")
    return runs.repartition("part").sortWithinPartitions("part", "lang").mapInArrow(merge, "lang string, phrase string, n long")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int | None = TOP,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): per language the ``top`` phrases (None: all) of 2 to ``longest`` words.

    ``a`` occurrences of the phrase, ``l`` and ``r`` of its parts at the cut
    with the lowest score floor(1000 a n / (l r)), ``n`` of all words of the
    language; arithmetic is exact (38 digits). A phrase that always stands
    inside one and the same longer candidate is left out. Ties: more
    occurrences, then the phrase in byte order.

    Null and empty texts have no words; a null language is NO_LANGUAGE. Texts
    of any length are read whole, a batch at a time. Repeated rows count every
    time. Other columns, whatever their names, are not read. An empty table
    gives an empty result. Counts cover all rows and nothing is sampled: what a
    task holds is bounded by the constants above, filters by MOST_BITS.
    """
    bounded_batches(docs.sparkSession)
    read = docs.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    single = keep_table(read.mapInArrow(_count_words, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(
        F.sum("n").alias("n")
    ).filter((F.col("n") >= least) | (F.col("phrase") == "")))
    totals = single.filter("phrase = ''").select("lang", "n")
    corpus_words = totals.agg(F.sum("n")).first()[0] or 0
    levels = [single.filter("phrase <> ''")]
    for length in range(2, longest + 1):
        known = phrase_filter(levels[-1], length - 1)
        full = bucket_filter(read, length, known, corpus_words, least)
        levels.append(keep_table(count_phrases(read, length, known, full, corpus_words, least)))
    counts = levels[0].withColumn("size", F.lit(1))
    for length, level in enumerate(levels[1:], 2):
        counts = counts.unionByName(level.withColumn("size", F.lit(length)))
    candidates = counts.filter("size > 1").withColumnRenamed("n", "a")
    # A longer candidate as frequent as a part implies one a single word longer, as frequent too.
    def words(start: Column, count: Column) -> Column:
        return F.array_join(F.slice(F.split("phrase", " "), start, count), " ")

    size = F.col("size")
    first, rest = words(F.lit(1), size - 1), words(F.lit(2), size - 1)
    covered = candidates.filter("size > 2").select("lang", F.explode(F.array(first, rest)).alias("phrase"), "a").distinct()
    left = candidates.join(covered, ["lang", "phrase", "a"], "left_anti")
    cut = left.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    sides = cut.withColumns({"lead": words(F.lit(1), F.col("k")), "tail": words(F.col("k") + 1, size - F.col("k"))})

    def counted(name: str, count: str) -> DataFrame:
        return counts.select("lang", F.col("phrase").alias(name), F.col("n").alias(count))

    told = sides.join(counted("lead", "l"), ["lang", "lead"]).join(counted("tail", "r"), ["lang", "tail"]).join(totals, "lang")
    score = F.expr("(cast(a as decimal(38,0)) * n * 1000) div (cast(l as decimal(38,0)) * r)")
    scored = told.select("lang", "phrase", "a", "l", "r", "n", "k", score.alias("score")).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("low")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.select("lang", "phrase", "a", "low.l", "low.r", "n", "low.score").withColumn("rank", F.row_number().over(order))
    shown = ranked if top is None else ranked.filter(F.col("rank") <= top)
    return shown.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
