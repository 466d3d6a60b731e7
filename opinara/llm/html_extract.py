"""Main text of web pages by maximum-scoring subsequence.

A page is a row of words and tags. Words score above zero and tags below, with
weights learned from pages that mark their article themselves; words inside
boilerplate elements score below zero too. One scan finds the contiguous region
with the highest sum; its words outside boilerplate are the text.
"""

from __future__ import annotations

import heapq
import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import bounded_batches

# The bounded training sample: pages, and the longest page among them.
SAMPLE_PAGES = 400
SAMPLE_CHARS = 200_000
# Without labelled pages: a word, a tag that parts blocks, a word of boilerplate.
WORD, TAG, NOISE = 1.0, -1.5, -0.5
# Learned weights stay on their side of zero by this much; tags within a line and within boilerplate weigh no more.
LEAST = 0.01
# What is learned of words as a whole, for those in elements the labelled pages lack.
ANY_WORD = "word"

# What HTML says of its elements, and names that mark boilerplate.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr img".split()
)
HOLDERS = frozenset(
    "html head body div section article main aside nav header footer form ul ol dl table blockquote figure details "
    "fieldset center".split()
)
NOT_TEXT = frozenset(
    "head nav footer aside button select option textarea menu dialog svg iframe object canvas audio video map".split()
)
ARTICLES = frozenset(("article", "main"))
NEVER_NOISE = frozenset(("html", "body", "article", "main"))
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navigation navbar menu "
    "breadcrumb breadcrumbs pagination pager sidebar widget footer cookie cookies consent gdpr notice popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended teaser comment comments "
    "commentlist reply replies respond disqus toolbar skip copyright".split()
)
HEAD_WORDS = frozenset("header masthead topbar".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())

NO, SURE, MAYBE = 0, 1, 2
# An element that may be boilerplate and hides over so many times the words that are left wraps the page.
WRAPPED = 10
PROSE = frozenset("p h1 h2 h3 h4".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    # A quoted value ends at its quote, whatever stands in it.
    r"|<(/?)([a-z][^\s/>]*)((?:[^>\"'<]|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-z][^>]*>|<[!?][^>]*>",
    re.I | re.S,
)
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
WORDS = re.compile("[a-z]+")


def is_noise(name: str, attributes: str, in_article: bool) -> int:
    """NO, SURE or MAYBE boilerplate. A form, or a name that says other things too (``has-sidebar``), may also wrap the page."""
    if name in NOT_TEXT or (name == "header" and not in_article):
        return SURE
    if name in NEVER_NOISE:
        return NO
    if HIDDEN.search(attributes):
        return SURE
    found = MAYBE if name == "form" else NO
    for kind, *values in NAMED.findall(attributes):
        said = set(WORDS.findall("".join(values).lower()))
        if kind.lower() == "role":
            if said & NOISE_ROLES:
                return SURE
        elif said & NOISE_WORDS or (not in_article and said & HEAD_WORDS):
            if said <= NOISE_WORDS | HEAD_WORDS:
                return SURE
            found = MAYBE
    return found


def unmask(parents: list[int], own: list[int], held: list[bool], kept: int) -> list[bool]:
    """Whether each element that may be boilerplate hides its words.

    ``parents`` come before their children, -1 is none; ``own`` words lie in no
    inner one; ``held``: a paragraph or heading lies inside; ``kept`` words lie
    outside all. As long as far fewer words are left than are hidden, the
    element that holds most of the hidden ones was a wrapper of the page; its
    inner ones stay hidden. An element without paragraph or heading never is.
    """
    masked, whole, held = [True] * len(own), list(own), list(held)
    for number in range(len(own) - 1, -1, -1):
        if parents[number] >= 0:
            whole[parents[number]] += whole[number]
            held[parents[number]] = held[parents[number]] or held[number]
    open_ones = [(-whole[number], number) for number, parent in enumerate(parents) if parent < 0 and held[number]]
    inner: dict[int, list[int]] = {}
    for number, parent in enumerate(parents):
        inner.setdefault(parent, []).append(number)
    heapq.heapify(open_ones)
    hidden = sum(own)
    while open_ones and kept * WRAPPED < hidden:
        _, number = heapq.heappop(open_ones)
        masked[number] = False
        kept, hidden = kept + own[number], hidden - own[number]
        for child in inner.get(number, ()):
            if held[child]:
                heapq.heappush(open_ones, (-whole[child], child))
    for number, parent in enumerate(parents):
        masked[number] = masked[number] or (parent >= 0 and masked[parent])
    return masked


def tokens(page: str) -> list[tuple[str, int, str, bool, bool]]:
    """(feature, words, text, noise, inside an article element); a tag has no words, its text is a space if it parts blocks."""
    found: list[tuple[str, int, str, bool, bool]] = []
    inmost: list[int] = []  # of each token: the innermost element around it that may be noise
    stack: list[tuple[str, int, int]] = []  # holders, and any element that is noise: name, kind, the ``inmost`` outside it
    parents: list[int] = []
    held: list[bool] = []
    block, links, noise, articles, place, doubt = "body", 0, 0, 0, 0, -1

    def words(text: str) -> None:
        if text and not text.isspace():
            text = html.unescape(text)
        count = len(text.split())
        if count or text:
            found.append((f"word {'a' if links else block}", count, text, noise > 0, articles > 0))
            inmost.append(doubt)

    def pop() -> str:
        nonlocal noise, articles, doubt
        name, bad, doubt = stack.pop()
        noise -= bad == SURE
        articles -= name in ARTICLES
        return name

    for match in TOKEN.finditer(page):
        if match.start() > place:
            words(page[place:match.start()])
        place = match.end()
        closing, name, attributes = match[2], match[3], match[4]
        if name is None:
            continue
        name = name.lower()
        found.append((f"<{closing}{name}>", 0, "" if name in INLINE else " ", noise > 0, articles > 0 and name not in ARTICLES))
        inmost.append(doubt)
        if name == "a":
            links = 0 if closing else 1
        if closing:
            if any(open_name == name for open_name, *_ in stack):
                while pop() != name:
                    pass
                links = links if name in INLINE else 0
            if name not in INLINE:
                block = next((open_name for open_name, *_ in reversed(stack)), "body")
            continue
        if name == "body":
            while stack and stack[-1][0] != "html":
                pop()
        if name not in INLINE and name not in VOID:
            if stack and stack[-1][0] in ("p", "li", "dt", "dd", "td", "th", "tr") and (stack[-1][0] == name or stack[-1][0] == "p"):
                pop()  # noise that the next block ends
            block = name
        if name in PROSE and doubt >= 0 and not noise:
            held[doubt] = True
        bad = NO if name in VOID else is_noise(name, attributes, articles > 0)
        if name in HOLDERS or bad:
            stack.append((name, bad, doubt))
            noise += bad == SURE
            articles += name in ARTICLES
            if bad == MAYBE:
                parents.append(doubt)
                held.append(False)
                doubt = len(parents) - 1
    if place < len(page):
        words(page[place:])
    if not parents:
        return found
    own, kept = [0] * len(parents), 0
    for (_, count, _, sure, _), inside in zip(found, inmost, strict=True):
        if not sure and inside >= 0:
            own[inside] += count
        elif not sure:
            kept += count
    masked = unmask(parents, own, held, kept)
    return [
        (feature, count, text, sure or (inside >= 0 and masked[inside]), within)
        for (feature, count, text, sure, within), inside in zip(found, inmost, strict=True)
    ]


def learn(pages: list[str]) -> dict[str, float]:
    """Log odds of each feature inside against outside the one article of each page that has exactly one."""
    inside, outside = Counter(), Counter()
    for page in pages:
        row = tokens(page)
        names = Counter(feature for feature, *_ in row)
        if names["<article>"] != 1 and (names["<article>"] or names["<main>"] != 1):
            continue
        for feature, count, _, noise, within in row:
            if not noise:
                (inside if within else outside)[feature] += max(count, feature[0] == "<")
    if not inside:
        return {}
    kinds = inside.keys() | outside.keys()
    a, b = sum(inside.values()) + len(kinds), sum(outside.values()) + len(kinds)
    inside[ANY_WORD], outside[ANY_WORD] = (
        sum(count for kind, count in side.items() if kind[0] != "<") for side in (inside, outside)
    )
    odds = {kind: math.log((inside[kind] + 1) / a) - math.log((outside[kind] + 1) / b) for kind in (*kinds, ANY_WORD)}
    return {kind: min(odd, -LEAST) if kind[0] == "<" else max(odd, LEAST) for kind, odd in odds.items()}


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the highest sum; the first of equals, empty if none is above zero."""
    best, top, total, start = (0, 0), 0.0, 0.0, 0
    for place, one in enumerate(scores):
        if total <= 0:
            total, start = 0.0, place
        total += one
        if total > top:
            top, best = total, (start, place + 1)
    return best


def extract(page: str | None, weights: dict[str, float]) -> str:
    row = tokens(page or "")
    any_word = weights.get(ANY_WORD, WORD)

    def weigh(feature: str, count: int, text: str, noise: bool) -> float:
        if feature[0] != "<":
            return count * (NOISE if noise else weights.get(feature, any_word))
        return -LEAST if noise or not text else weights.get(feature, TAG)

    scores = [weigh(*one[:4]) for one in row]
    start, end = best_region(scores)
    return " ".join("".join(text if not noise else " " for _, _, text, noise, _ in row[start:end]).split())


def training_pages(pages: DataFrame, key: str = "page_id", page: str = "html") -> list[str]:
    """Up to SAMPLE_PAGES pages of up to SAMPLE_CHARS characters, in an order fixed by their text's hash."""
    sized = pages.filter(F.length(f"`{page}`") <= SAMPLE_CHARS)
    marked = sized.filter(F.col(f"`{page}`").rlike("(?i)<(article|main)[ >]"))
    chosen = marked.select(F.xxhash64(f"`{page}`").alias("sum")).distinct().orderBy("sum").limit(SAMPLE_PAGES)
    rows = marked.select(F.xxhash64(f"`{page}`").alias("sum"), F.col(f"`{page}`").alias("page"))
    found = rows.join(F.broadcast(chosen), "sum").groupBy("sum").agg(F.min("page").alias("page")).collect()
    return [row.page for row in sorted(found, key=lambda row: row.sum)]


def extract_pages(
    pages: DataFrame, weights: dict[str, float], keys: tuple[str, ...] = ("page_id", "url"), page: str = "html"
) -> DataFrame:
    """The columns ``keys`` of every row of ``pages``, text and n_chars.

    Null, empty and wordless pages give an empty text. Script, style and
    comments are never text; broken markup ends at the page's end. Rows do not
    depend on each other, repeated rows give a row each, other columns are not
    read, an empty table gives an empty result, and nothing is shuffled. A very
    long page is read whole, in time linear in its length, by one task. ``weights`` are those of ``learn``; missing
    ones have the fixed defaults.
    """
    bounded_batches(pages.sparkSession)
    kinds = [pages.schema[name].dataType.simpleString() for name in keys]
    names = [f"k{number}" for number in range(len(keys))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(value, weights) for value in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[*names, "text", "n_chars"],
            )

    picked = pages.select(
        *[F.col(f"`{name}`").alias(new) for name, new in zip(keys, names, strict=True)], F.col(f"`{page}`").cast("string").alias("t")
    )
    schema = ", ".join(f"{name} {kind}" for name, kind in zip(names, kinds, strict=True))
    return picked.mapInArrow(work, f"{schema}, text string, n_chars long").toDF(*keys, "text", "n_chars")
