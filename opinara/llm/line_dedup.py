"""Line dedup by a deletion-neighbourhood join, in DataFrame operations only.

A line is its words. Equal lines meet first. Two lines of at least MIN_WORDS
words that are one word apart (changed, added or missing) agree in a half: the
edit lies before or after the middle. Lines whose half no other line has are
out; the rest emit their deletion variants (the line without the word at one
place) as hashed keys, only for places in the other half. Lines with an equal
variant are compared word by word. A line goes if an earlier one, by document
and line number, is equal or one word apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import keep, keep_table

# Shorter lines are compared for equality only: one word would be more than a tenth of them.
MIN_WORDS = 10
# Up to this many lines (16 bytes each) a table of line hashes is sent to all executors.
BROADCAST_LINES = 1_000_000
# White space between words; line feeds end lines.
GAPS = " \t\x0b\f\r"

PREFIX, SUFFIX = 0, 1


def _halves(words: Column, size: Column, length: Column) -> list[Column]:
    """Hashes of the first half and of the rest, when an edited line counts ``length`` words untouched by it."""
    middle = F.floor(length / 2).cast("int")
    rest = (length - middle).cast("int")
    return [
        F.xxhash64(length, F.lit(PREFIX), F.slice(words, F.lit(1), middle)),
        F.xxhash64(length, F.lit(SUFFIX), F.slice(words, size - rest + 1, rest)),
    ]


def _plain(line: Column) -> Column:
    """A line whose white space is blanks, with one between words. Most lines are like that, so they skip the pattern."""
    return F.trim(F.when(F.contains(line, F.lit("  ")), F.regexp_replace(line, " +", " ")).otherwise(line))


def _blanks(text: Column) -> Column:
    return F.translate(text, GAPS, " " * len(GAPS))


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, sum, n, words, h1, h2) of every line with a word."""
    rows = docs.select(
        F.col(f"`{key}`").alias("id"), F.xxhash64(f"`{text}`").alias("sum"),
        F.posexplode(F.split(_blanks(F.col(f"`{text}`")), "\n")).alias("n", "line"),
    )
    plain = rows.withColumn("line", _plain(F.col("line"))).filter("line <> ''")
    return plain.select(
        "id", "sum", "n", F.split("line", " ").alias("words"),
        F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"),
    )


def _where_lines(docs: DataFrame, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """(h1, h2, first, words) of the lines ``wanted`` (h1, h2, first), read at their first places.

    Only documents with such a place are cut into lines again; the size of
    ``wanted`` decides how the places travel.
    """
    places = wanted.select("first.id", "first.sum", F.struct("first.n", "h1", "h2").alias("place")).groupBy("id", "sum").agg(
        F.collect_list("place").alias("places")
    )
    found = F.broadcast(places) if wanted.count() <= BROADCAST_LINES else places
    own = docs.select(F.col(f"`{key}`").alias("_id"), F.xxhash64(f"`{text}`").alias("_sum"), F.col(f"`{text}`").alias("_text"))
    met = own.join(found, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_sum") == F.col("sum")))
    numbers = F.transform("places", lambda place: place["n"])
    lines = F.filter(
        F.transform(F.split(_blanks(F.col("_text")), "\n"), lambda line, n: F.struct(n.alias("n"), line.alias("line"))),
        lambda line: F.array_contains(numbers, line["n"]),
    )
    cut = met.select("id", "sum", "places", lines.alias("lines"))
    each = cut.select("id", "sum", F.explode(F.transform("places", lambda place: F.struct(
        place.alias("place"), F.filter("lines", lambda line: line["n"] == place["n"])[0]["line"].alias("line"),
    ))).alias("at"))
    # Copies of a document hold the same line.
    return each.groupBy(F.col("at.place.h1").alias("h1"), F.col("at.place.h2").alias("h2")).agg(
        F.split(_plain(F.first("at.line")), " ").alias("words"),
        F.first(F.struct("id", "sum", F.col("at.place.n").alias("n"))).alias("first"),
    )


def _near(docs: DataFrame, key: str, text: str, firsts: DataFrame) -> DataFrame:
    """(h1, h2) of the different lines that have an earlier one a word apart."""
    # Only hashes meet here; 64 bits are enough to find candidates.
    sides = firsts.select("h1", F.posexplode("keys").alias("place", "half"))
    # Keys 0 and 1 speak of lines as long as this one, keys 2 and 3 of lines a word shorter.
    longer = F.col("place") >= 2
    counts = sides.groupBy("half").agg(F.count_if(~longer).alias("same"), F.count_if(longer).alias("more")).filter(
        (F.col("same") >= 2) | ((F.col("same") >= 1) & (F.col("more") >= 1))
    )
    shared = keep(sides.join(counts, "half").filter(
        F.when(longer, F.col("same") >= 1).otherwise((F.col("same") >= 2) | (F.col("more") >= 1))
    ))
    hashes = keep(shared.select("h1").distinct())
    hashes = F.broadcast(hashes) if hashes.count() <= BROADCAST_LINES else hashes
    wanted = keep(firsts.select("h1", "h2", "first").join(hashes, "h1", "left_semi"))
    texts = keep(_where_lines(docs, key, text, wanted))
    told = shared.join(texts, "h1").select(
        "half", longer.alias("longer"), "same", "more", F.struct("first", "h1", "h2").alias("line"), "words",
        (F.col("place") % 2 == PREFIX).alias("prefix"), F.size("words").alias("size"),
    )
    length = F.col("size") - F.col("longer").cast("int")
    middle = F.floor(length / 2).cast("int")
    # Places of the words outside the common half, counted from 0.
    low = F.when(F.col("prefix"), middle).otherwise(0)
    high = F.when(F.col("prefix"), F.col("size")).otherwise(F.col("size") - length + middle) - 1
    places = F.sequence(low, high)

    def joined(hashes: Column) -> Column:
        return F.aggregate(hashes, F.lit(0).cast("long"), lambda total, one: total.bitwiseXOR(one))

    # One word changed: equal without the word at the same place. The first of all such lines is near each of them.
    placed = F.transform("words", lambda word, place: F.xxhash64(word, place))
    wild = told.filter(~F.col("longer") & (F.col("same") >= 2)).select(
        "half", "line", placed.alias("hashes"), places.alias("places")
    ).withColumn("all", joined(F.col("hashes"))).select("half", "line", F.explode(F.transform(
        "places", lambda place: F.struct(place.alias("place"), F.col("all").bitwiseXOR(F.get("hashes", place)).alias("rest"))
    )).alias("at")).select("half", "line", "at.place", "at.rest")
    earliest = wild.groupBy("half", "place", "rest").agg(F.min("line").alias("early"), F.count("*").alias("n")).filter("n > 1")
    changed = wild.join(earliest, ["half", "place", "rest"]).filter("early < line").select("line", "early").distinct()

    # One word more: a line without one of its words holds the words of a shorter line.
    plain = F.transform("words", lambda word: F.xxhash64(word))
    bags = told.select(
        "half", "line", "longer", "more", plain.alias("hashes"), places.alias("places")
    ).withColumn("all", joined(F.col("hashes")))
    shorter = bags.filter(~F.col("longer") & (F.col("more") >= 1)).select("half", F.col("line").alias("short"), F.col("all").alias("bag"))
    without = bags.filter("longer").select("half", F.col("line").alias("long"), F.explode(F.array_distinct(F.transform(
        "places", lambda place: F.col("all").bitwiseXOR(F.get("hashes", place))
    ))).alias("bag"))
    added = without.join(shorter, ["half", "bag"]).select(
        F.greatest("short", "long").alias("line"), F.least("short", "long").alias("early")
    ).distinct()

    pairs = changed.union(added)
    one = texts.select(F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("words").alias("a"))
    two = texts.select(F.col("h1").alias("b1"), F.col("h2").alias("b2"), F.col("words").alias("b"))
    proved = pairs.join(one, (F.col("line.h1") == F.col("a1")) & (F.col("line.h2") == F.col("a2"))).join(
        two, (F.col("early.h1") == F.col("b1")) & (F.col("early.h2") == F.col("b2"))
    ).filter(_one_apart(F.col("a"), F.col("b")))
    return proved.select("line.h1", "line.h2").distinct()


def _one_apart(a: Column, b: Column) -> Column:
    """Whether two different word lists are one changed, added or missing word apart."""

    def common(x: Column, y: Column) -> Column:
        """Words alike from the front, up to the shorter length."""
        return F.coalesce(
            F.array_position(F.zip_with(x, y, lambda u, v: ~u.eqNullSafe(v)), True).cast("int") - 1,
            F.least(F.size(x), F.size(y)),
        )

    front, back = common(a, b), common(F.reverse(a), F.reverse(b))
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (front + back >= F.greatest(F.size(a), F.size(b)) - 1)


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with the lines that an earlier line repeats taken out of ``text``; n_lines, n_removed.

    Lines end at line feeds; their white space does not matter for equality,
    and blank lines stay. Earlier means a smaller (key, hash of the text, line
    number), nulls first. Rows with the same key and text are one document in
    several copies: they get the same result. Null and empty texts stay as they
    are. No row is dropped: a text all of whose lines are repeats becomes what
    blank lines leave of it. The other columns are handed on; a column named
    n_lines or n_removed in ``docs`` is replaced. Tables of lines are
    keyed by hashes of 128 bits, the texts of lines move only for those with a
    candidate, and a document's text moves once, to meet its removed lines.
    """
    lines = _lines(docs, key, text)
    size = F.size("words")
    keys = F.when(size >= MIN_WORDS, F.array(
        *_halves(F.col("words"), size, size),
        *[F.when(size > MIN_WORDS, half) for half in _halves(F.col("words"), size, size - 1)],
    ))
    known = keep_table(lines.select("id", "sum", "n", "h1", "h2", F.array_compact(keys).alias("keys")))
    firsts = keep_table(known.groupBy("h1", "h2").agg(
        F.min(F.struct("id", "sum", "n")).alias("first"), F.first("keys").alias("keys"), F.count("*").alias("copies")
    ))
    # A line may be marked twice, as repeated and as near an earlier one; it is taken out once.
    repeated = firsts.filter("copies > 1").select("h1", "h2", "first")
    marked = keep(repeated.unionByName(_near(docs, key, text, firsts), allowMissingColumns=True))
    removed = known.join(marked, ["h1", "h2"]).filter(
        F.col("first").isNull() | (F.struct("id", "sum", "n") != F.col("first"))
    ).groupBy("id", "sum").agg(F.collect_set("n").alias("out"))
    parts = F.split(F.col(f"`{text}`"), "\n")
    stay = F.filter(parts, lambda line, n: ~F.array_contains("__out", n))
    rebuilt = F.when(F.col("__out").isNotNull(), F.array_join(stay, "\n"))
    names = [name for name in docs.columns if name not in ("n_lines", "n_removed")]
    met = docs.withColumn("__sum", F.xxhash64(f"`{text}`")).join(
        removed.select(F.col("id").alias("__id"), F.col("sum").alias("__hash"), F.col("out").alias("__out")),
        F.col(f"`{key}`").eqNullSafe(F.col("__id")) & (F.col("__sum") == F.col("__hash")), "left",
    )
    return met.select(
        *[F.coalesce(rebuilt, F.col(f"`{name}`")).alias(name) if name == text else F.col(f"`{name}`") for name in names],
        F.coalesce(F.size(F.filter(parts, lambda part: F.trim(part, F.lit(GAPS)) != "")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__out"), F.lit(0)).cast("long").alias("n_removed"),
    )
