"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

Every source has a target in words. A document's expected number of copies is
its source's target over its source's size. The whole part is certain; for the
rest a document has an inclusion probability p and a random number u, and
documents are ranked by odds(u) / odds(p). The first ones, as many as fill the
words left, form a sample of fixed size with unequal probabilities.

Ranks are never sorted in one task: a histogram of the ranks finds the cell in
which a source's words run out, a second one splits that cell, and only the
documents of the last cell are walked one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.llm.common import keep, keep_table

# No document is taken more often than this, and no target is above this many times its source's size.
MOST_COPIES = 3
# Weights of the sources in their order, repeating.
CYCLE = (5, 2, 1)
# Cells of the histograms: 2^12 of a source's ranks, then 2^12 of one of those.
CELL_BITS = (12, 24)
# A table of up to so many sources is sent to all executors; beyond, a source's row is joined under SALTS keys.
BROADCAST_SOURCES = 10_000
SALTS = 64


def n_words(text: Column) -> Column:
    """Runs of characters other than white space; null has none. Pieces between gaps, without the empty ones at the ends."""

    def gap(char: Column) -> Column:
        return ((F.ascii(char) == 32) | F.ascii(char).between(9, 13)).cast("int")

    pieces = F.size(F.split(text, r"[\x20\x09-\x0D]+"))
    found = pieces - gap(F.substring(text, 1, 1)) - gap(F.substring(text, -1, 1))
    return F.when(F.coalesce(text, F.lit("")) == "", 0).otherwise(found).cast("long")


def cycled_weights(sources: DataFrame) -> DataFrame:
    """(source, words, weight): the weights of CYCLE dealt to the sources by code point, null last. One row a source."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in CYCLE]), place % len(CYCLE) + 1))


def targets(sources: DataFrame, share: float = 1.0) -> DataFrame:
    """(source, words, weight) with ``target``: ``share`` of all words by weight, at most MOST_COPIES times the words.

    What a full source leaves goes to the others by weight. That ends at a
    common level of words per weight; sources reach their bound in the order of
    bound / weight, so the level follows from sums in that order. One row a
    source passes these windows, no documents.
    """
    bound = F.col("words") * MOST_COPIES
    order = Window.orderBy((bound / F.col("weight")), F.col("source").asc_nulls_last())
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    left = F.sum("words").over(everything) * F.lit(share) - F.coalesce(F.sum(bound).over(before), F.lit(0))
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    placed = sources.withColumns({"level": (left / weights).cast("double"), "place": F.row_number().over(order)})
    # The first source that stays below its bound at the level it would set, sets it.
    free = F.when(F.col("level") * F.col("weight") <= bound, F.struct("place", "level"))
    levelled = placed.withColumn("free", F.min(free).over(everything)["level"])
    return levelled.select(
        "source", "words", "weight",
        F.least(bound.cast("double"), F.coalesce(F.col("free") * F.col("weight"), bound.cast("double"))).alias("target"),
    )


def _met(rows: DataFrame, table: DataFrame, few: bool, how: str = "inner") -> DataFrame:
    """``rows`` with their source's row of ``table``, sent to all executors if ``few``; else a source is spread over SALTS keys."""
    names = [name for name in table.columns if name != "source"]
    told = table.withColumnRenamed("source", "_source")
    same = F.col("source").eqNullSafe(F.col("_source"))
    if few:
        return rows.join(F.broadcast(told), same, how).select(*rows.columns, *names)
    salted = told.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_own", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int")).join(
        salted, same & (F.col("_own") == F.col("_salt")), how
    ).select(*rows.columns, *names)


def _odds(p: Column) -> Column:
    return p / (1 - p)


def _cell(rank: Column, bits: int) -> Column:
    """The place of a rank among 2^bits cells of (0, 1)."""
    return F.floor(rank / (1 + rank) * float(1 << bits)).cast("long")


def _cuts(groups: DataFrame, rooms: DataFrame, few: bool) -> DataFrame:
    """(source, cut, extra): documents ranked up to ``cut`` are in, and the one at ``extra``.

    ``groups`` has (source, rank, size), ranks once each; ``rooms`` has (source, room) in words.
    """
    inside, at = groups, rooms.withColumn("done", F.lit(0).cast("long"))
    for bits in CELL_BITS:
        cells = inside.groupBy("source", _cell(F.col("rank"), bits).alias("place")).agg(F.sum("size").alias("size"))
        walked = cells.withColumn("after", F.sum("size").over(Window.partitionBy("source").orderBy("place")))
        after = F.col("done") + F.col("after")
        edge = _met(walked, at.select("source", "room", "done"), few).filter(after > F.col("room")).groupBy("source").agg(
            F.min(F.struct("place", (after - F.col("size")).alias("before"))).alias("edge")
        )
        at = keep(_met(rooms, edge, few).select("source", "room", F.col("edge.before").alias("done"), F.col("edge.place").alias("cell")))
        inside = keep(_met(inside, at.select("source", "cell"), few).filter(_cell(F.col("rank"), bits) == F.col("cell")).select(*groups.columns))
    walked = inside.withColumn("after", F.sum("size").over(Window.partitionBy("source").orderBy("rank")))
    # What lies in cells before the last one is in anyway.
    last = _met(walked, at, few).filter(F.col("done") + F.col("after") <= F.col("room")).groupBy("source").agg(
        F.max("rank").alias("cut"), F.max(F.col("done") + F.col("after")).alias("taken")
    )
    edges = F.col("cell") / float(1 << CELL_BITS[-1])
    cuts = _met(at, last, few, "left").select(
        "source", F.coalesce("cut", edges / (1 - edges)).alias("cut"), (F.col("room") - F.coalesce("taken", "done")).alias("left")
    )
    cuts = keep(_met(rooms, cuts, few, "left").select("source", F.coalesce("cut", F.lit(float("inf"))).alias("cut"), "left"))
    # The one further document that comes nearest to the words left, if it comes nearer than none does.
    miss = F.abs(F.col("size") - F.col("left"))
    fits = _met(groups, cuts, few).filter((F.col("rank") > F.col("cut")) & (miss < F.col("left")))
    extra = fits.groupBy("source").agg(F.min(F.struct(miss.alias("miss"), "rank"))["rank"].alias("extra"))
    return _met(cuts, extra, few, "left").select("source", "cut", "extra")


def mix(
    docs: DataFrame, weights: DataFrame | None = None, share: float = 1.0,
    key: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """(key, size, source, source_size, target, copies, taken): how often the mix takes each row of ``docs``.

    ``weights`` has (source, weight), weights above zero; sources it does not
    name weigh nothing and are not taken. Without it the weights of CYCLE are
    dealt to the sources. ``share`` is the mix's size over that of all sources
    with a weight, in words, at most MOST_COPIES. ``taken`` is copies x size.

    Documents are taken whole; one larger than all words left beside the
    certain copies takes no part in the draw. In rank order the others are
    taken as long as they fit; then one more, the nearest in size to what is
    still missing, if the source comes nearer to its target by it. So a source
    misses its target by half of the smallest document left out at most.

    Null and empty texts have size 0 and take part without filling anything. A
    null source is a source of its own, last in order. Texts of any length
    count whole. u is the MD5 of key and text, so reruns agree. Rows with the
    same key, text and source have equal ranks and are taken alike. An empty
    table gives an empty result, and so does a table without words one of
    zeros. Other columns, whatever their names, are not read.
    """
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")), F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    drawn = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)
    rows = keep_table(docs.select(
        F.col(f"`{key}`").alias("id"), F.col(f"`{source}`").alias("source"), n_words(F.col(f"`{text}`")).alias("size"),
        drawn.alias("u"),
    ))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("words"))
    if weights is None:
        weighed = cycled_weights(sizes)
    else:
        named = weights.select(F.col("source").alias("_source"), "weight")
        weighed = sizes.join(named, F.col("source").eqNullSafe(F.col("_source"))).select("source", "words", "weight")
    ratio = F.when(F.col("words") > 0, F.col("target") / F.col("words")).otherwise(0.0)
    plan = keep(targets(weighed, share).withColumn("whole", F.floor(ratio).cast("long")).withColumns({
        "p": ratio - F.col("whole"), "room": F.col("target") - F.col("whole") * F.col("words"),
    }))
    few = plan.count() <= BROADCAST_SOURCES
    rank = _odds(F.col("u")) / _odds(F.col("p"))
    ranked = _met(rows, plan, few, "left").withColumn("rank", F.when((F.col("p") > 0) & (F.col("size") <= F.col("room")), rank))
    groups = keep_table(ranked.filter("rank IS NOT NULL").groupBy("source", "rank").agg(F.sum("size").alias("size")))
    rooms = plan.filter("p > 0").select("source", "room")
    chosen = _met(ranked, keep(_cuts(groups, rooms, few)), few, "left")
    lucky = F.coalesce((F.col("rank") <= F.col("cut")) | (F.col("rank") == F.col("extra")), F.lit(False))
    copies = F.coalesce(F.col("whole"), F.lit(0)) + lucky.cast("long")
    return chosen.select(
        F.col("id").alias(key), "size", "source", F.col("words").alias("source_size"), "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )
