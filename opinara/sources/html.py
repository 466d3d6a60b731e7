"""Repeated cards on landed HTML pages.

A CardSpec names the card element and the parts to take from it. The pages are
read by a small parser in Spark's Python workers, page by page without a
shuffle; everything after the raw strings (defaults, star words, texts) is
column expressions.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions.links import resolve_link
from opinara.functions.text import strip

# Star words, and the defaults of missing parts.
STAR_WORDS = {"One": 1, "Two": 2, "Three": 3, "Four": 4, "Five": 5}
NO_TITLE, NO_PRICE, NO_AVAILABILITY = "Unknown", "N/A", "Unknown"
SYSTEM_EMAIL = "scraper@system.local"
# Elements without content and therefore without an end tag.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


@dataclass(frozen=True)
class Part:
    """First element matching ``path`` inside a card: its text or an attribute.

    ``path`` is ``tag``, ``tag.class`` or ``parent > tag``.
    """

    path: str
    attribute: str | None = None


@dataclass(frozen=True)
class CardSpec:
    card: str
    parts: Mapping[str, Part] = field(default_factory=dict)
    link: str | None = None  # the part holding a link to resolve against the page


PRODUCT_CARD = CardSpec(
    card="article.product_pod",
    parts={
        "title_attribute": Part("h3 > a", "title"),
        "title_text": Part("h3 > a"),
        "price": Part("p.price_color"),
        "star_class": Part("p.star-rating", "class"),
        "availability": Part("p.availability"),
        "link": Part("h3 > a", "href"),
    },
    link="link",
)


def _fits(step: str, tag: str, classes: list[str]) -> bool:
    name, _, wanted = step.partition(".")
    return tag == name and (not wanted or wanted in classes)


class _CardReader(HTMLParser):
    """Collects cards in page order, nested ones too. A text part grows until its element ends."""

    def __init__(self, spec: CardSpec) -> None:
        super().__init__(convert_charrefs=True)
        self.spec = spec
        self.paths = {name: [s.strip() for s in part.path.split(">")] for name, part in spec.parts.items()}
        self.stack: list[tuple[str, list[str]]] = []
        self.cards: list[dict[str, str | None]] = []
        self.open_cards: list[tuple[int, int]] = []  # (card, stack depth) of the cards not yet ended
        self.open_parts: dict[tuple[int, str], int] = {}  # stack depth of the text parts not yet ended

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        values = {key: value or "" for key, value in attrs}
        classes = values.get("class", "").split()
        # Parts are looked for inside a card, so an element that is a card itself belongs to those around it.
        for number, _ in self.open_cards:
            self._start_parts(number, tag, classes, values)
        if _fits(self.spec.card, tag, classes):
            self.open_cards.append((len(self.cards), len(self.stack)))
            self.cards.append(dict.fromkeys(self.spec.parts))
        if tag not in _VOID:
            self.stack.append((tag, classes))

    def _start_parts(self, number: int, tag: str, classes: list[str], values: dict[str, str]) -> None:
        card = self.cards[number]
        for name, part in self.spec.parts.items():
            *parents, last = self.paths[name]
            if card[name] is not None or not _fits(last, tag, classes):
                continue
            if parents and not (self.stack and _fits(parents[-1], *self.stack[-1])):
                continue
            if part.attribute:
                card[name] = values.get(part.attribute, "")
            else:
                card[name] = ""
                if tag not in _VOID:
                    self.open_parts[number, name] = len(self.stack)

    def handle_data(self, data: str) -> None:
        for number, name in self.open_parts:
            self.cards[number][name] += data

    def handle_endtag(self, tag: str) -> None:
        depth = next((i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i][0] == tag), None)
        if depth is None:
            return
        del self.stack[depth:]
        self.open_parts = {part: at for part, at in self.open_parts.items() if at < depth}
        self.open_cards = [card for card in self.open_cards if card[1] < depth]


def _read_page(url: str, html: str, spec: CardSpec) -> list[dict[str, str | None]]:
    reader = _CardReader(spec)
    reader.feed(html)
    reader.close()
    for card in reader.cards:
        for name, part in spec.parts.items():
            if card[name] is not None and not part.attribute:
                card[name] = card[name].strip()
        card[_BROKEN] = None
        if spec.link:
            try:
                card[spec.link] = urljoin(url, card[spec.link] or "")
            except ValueError:  # a link that is no address costs only this card
                card[_BROKEN] = "link_no_address"
    return reader.cards


_BROKEN = "_rule"


def extract_cards(pages: DataFrame, spec: CardSpec = PRODUCT_CARD, max_cards: int | None = None) -> DataFrame:
    """(page_id, card_no, one text column per part); pages without cards give no row.

    pages(page_id, url, html). ``max_cards`` keeps the first cards of each page.
    Card numbers count all cards; one whose link is no address is left to
    ``card_rejects``.
    """
    return _cards(pages, spec, max_cards).filter(F.col(_BROKEN).isNull()).drop(_BROKEN)


def card_rejects(pages: DataFrame, spec: CardSpec = PRODUCT_CARD, max_cards: int | None = None) -> DataFrame:
    """REJECT rows of the cards that ``extract_cards`` skips."""
    broken = _cards(pages, spec, max_cards).filter(F.col(_BROKEN).isNotNull())
    return broken.select(
        F.concat_ws("_", "page_id", "card_no").alias("source_id"), F.lit("html").alias("stage"), F.col(_BROKEN).alias("rule"),
        F.to_json(F.struct(*[F.col(f"`{name}`") for name in spec.parts])).alias("payload"),
    )


def _cards(pages: DataFrame, spec: CardSpec, max_cards: int | None) -> DataFrame:
    names = [*spec.parts, _BROKEN]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for page_id, url, html in zip(batch["page_id"], batch["url"], batch["html"]):
                cards = _read_page(url or "", html or "", spec)[:max_cards]
                rows += [(page_id, no, *[card[n] for n in names]) for no, card in enumerate(cards, start=1)]
            yield pd.DataFrame(rows, columns=["page_id", "card_no", *names])

    schema = ", ".join(["page_id long", "card_no int", *[f"`{name}` string" for name in names]])
    return pages.select("page_id", "url", "html").mapInPandas(read, schema)


# Scripts, styles and comments show no links; their text may look like some.
_UNSEEN = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"
_TAG = r"""(?s)<[A-Za-z][^\s/>"']*+(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
_LINK = r"""(?is)^<[^\s/>]+(?:\s+(?!(?:href|src)\s*=)[^\s=>]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?)*\s+(?:href|src)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def page_links(pages: DataFrame) -> DataFrame:
    """(page_id, link_no, tag, href, link): every href or src of a page, in page order, and what it resolves to.

    pages(page_id, url, html). All in the JVM, page by page, without a shuffle.
    ``link`` is null where the link or the page's url is null or no address.
    ``&amp;`` is decoded, other character references are left. Null or empty
    html gives no row; repeated pages and links give repeated rows.
    """
    tags = F.regexp_extract_all(F.regexp_replace("html", _UNSEEN, " "), F.lit(_TAG), 0)
    linking = F.filter(tags, lambda tag: tag.rlike(_LINK))
    opened = pages.select("page_id", "url", F.posexplode(linking).alias("place", "opening"))
    raw = F.concat(*[F.regexp_extract("opening", _LINK, group) for group in (1, 2, 3)])
    named = opened.select(
        "page_id", "url", (F.col("place") + 1).alias("link_no"),
        F.lower(F.regexp_extract("opening", r"^<([^\s/>]+)", 1)).alias("tag"),
        F.replace(raw, F.lit("&amp;"), F.lit("&")).alias("href"),
    )
    return named.select("page_id", "link_no", "tag", "href", resolve_link(F.col("url"), F.col("href")).alias("link"))


def star_rating(word: Column) -> Column:
    """One..Five to 1..5, anything else 0."""
    table = F.create_map(*[F.lit(x) for pair in STAR_WORDS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, word), F.lit(0))


def stars_of_class(classes: Column) -> Column:
    """Stars named by the first star word of a class attribute."""
    named = F.filter(F.split(F.coalesce(classes, F.lit("")), r"\s+"), lambda w: w.isin(*STAR_WORDS))
    return star_rating(F.get(named, F.lit(0)))


def review_sentence(title: Column, price: Column, stars: Column, availability: Column) -> Column:
    """The review text that stands for a card."""
    verdict = F.when(stars >= 4, "highly recommend").otherwise("have mixed opinions about")
    return F.format_string(
        "Product: %s. Price: %s. Customer rating: %d out of 5 stars. Availability: %s. "
        "Customers who rated this %s this product.",
        title, price, stars, availability, verdict,
    )


def product_records(cards: DataFrame) -> DataFrame:
    """Landed records of product cards, ready for ``landing.normalize``.

    Card numbers restart on every page, so the ids carry the page.
    """
    title = F.coalesce(F.nullif(F.col("title_attribute"), F.lit("")), F.col("title_text"), F.lit(NO_TITLE))
    staged = cards.select(
        "page_id", "card_no",
        title.alias("post_title"),
        F.coalesce(strip(F.col("price")), F.lit(NO_PRICE)).alias("price"),
        stars_of_class(F.col("star_class")).alias("star_rating"),
        F.coalesce(strip(F.col("availability")), F.lit(NO_AVAILABILITY)).alias("availability"),
        F.col("link").alias("source_url"),
    )
    number = F.concat_ws("_", "page_id", "card_no")
    return staged.select(
        "page_id", "card_no",
        F.concat(F.lit("html_"), number).alias("post_id"),
        "post_title",
        F.format_string("%s - Price: %s - Rating: %d/5", "post_title", "price", "star_rating").alias("post_body"),
        number.alias("comment_id"),
        F.concat(F.lit("Product Review #"), F.col("card_no").cast("string")).alias("comment_name"),
        F.lit(SYSTEM_EMAIL).alias("comment_email"),
        review_sentence(F.col("post_title"), F.col("price"), F.col("star_rating"), F.col("availability")).alias("comment_body"),
        "source_url", "star_rating", "price", "availability",
    )
