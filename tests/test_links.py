"""Resolved links against the standard library's resolver."""

import random
from urllib.parse import urljoin

from conftest import rows
from pyspark.sql import functions as F

from opinara.functions.links import is_address, remove_dots, resolve_link
from opinara.sources import html

# The examples of RFC 3986, 5.4, on http://a/b/c/d;p?q.
BASE = "http://a/b/c/d;p?q"
NORMAL = "g:h g ./g g/ /g //g ?y g?y #s g#s g?y#s ;x g;x g;x?y#s . ./ .. ../ ../g ../.. ../../ ../../g".split()
ABNORMAL = (
    "../../../g ../../../../g /./g /../g g. .g g.. ..g ./../g ./g/. g/./h g/../h g;x=1/./y g;x=1/../y "
    "g?y/./x g?y/../x g#s/./x g#s/../x http:g"
).split()


def resolved(spark, pairs):
    found = spark.createDataFrame(pairs, "n int, base string, link string").repartition(4).select(
        "n", resolve_link(F.col("base"), F.col("link")).alias("address")
    )
    return {r["n"]: r["address"] for r in rows(found)}


def check(spark, pairs):
    got = resolved(spark, [(n, *pair) for n, pair in enumerate(pairs)])
    wrong = [(pair, got[n], urljoin(*pair)) for n, pair in enumerate(pairs) if got[n] != urljoin(*pair)]
    assert not wrong


def test_examples_of_the_standard(spark):
    links = ["", *NORMAL, *ABNORMAL]
    assert len(links) == 42
    check(spark, [(BASE, link) for link in links])


def test_random_links_equal_the_standard_resolver(spark):
    draw = random.Random(5)
    bases = ["http://h", "https://h/", "http://h/a", "http://h/a/b?c#d", "HTTP://u@h:8/a//b/", "http://h/a/../b/c", "", "mailto:x@y", "a/b/c"]
    parts = ["/", "/", "..", ".", "a", "bé", "?", "q=1", "#", "x y", "//", "%20", "...", "http:", "https://k/l/../m", " ", "\t", "&"]
    check(spark, [(base, "".join(draw.choices(parts, k=draw.randrange(7)))) for base in bases[:-1] for _ in range(250)])
    check(spark, [(bases[-1], "/".join(draw.choices(["g", "h", "."], k=3)) + "/z") for _ in range(50)])


def test_nulls_brackets_and_long_paths(spark):
    long = "x/../" * 300 + "y"
    got = resolved(spark, [
        (0, None, "a"), (1, "http://h", None), (2, "http://h/", "http://[k/"), (3, "http://k]/", "a"), (4, "http://h/p", long),
        (5, "http://[::1]/p", "q"),
    ])
    assert got == {0: None, 1: None, 2: None, 3: None, 4: "http://h/y", 5: "http://[::1]/q"}
    row = spark.range(1).select(remove_dots(F.lit("/a/./b/..")).alias("p"), is_address(F.lit("//[x")).alias("ok")).first()
    assert (row.p, row.ok) == ("/a/", False)


def test_page_links(spark):
    page = """<a class=x href="../a?b=1&amp;c=2">1</a><A HREF='#top'>2</A><img src=pic.png><script>var s = '<a href="no">';</script>
    <!-- <a href="hidden"> --><a data-href="data">3</a><a href="http://[bad/">4</a><a href="">5</a><link rel=x href=/style.css/>"""
    pages = spark.createDataFrame(
        [(1, "http://h/p/q/r", page), (2, None, '<a href="x">'), (3, "http://h", None), (4, "http://h", ""),
         (5, "http://h", f"<a title='{'> ' * 100_000}' href=/long>" + "<b>x</b>" * 20_000)],
        "page_id long, url string, html string",
    ).withColumn("link", F.lit(1))
    found = [tuple(r.values()) for r in rows(html.page_links(pages).orderBy("page_id", "link_no"))]
    assert found == [
        (1, 1, "a", "../a?b=1&c=2", "http://h/p/a?b=1&c=2"),
        (1, 2, "a", "#top", "http://h/p/q/r#top"),
        (1, 3, "img", "pic.png", "http://h/p/q/pic.png"),
        (1, 4, "a", "http://[bad/", None),
        (1, 5, "a", "", "http://h/p/q/r"),
        (1, 6, "link", "/style.css/", "http://h/style.css/"),
        (2, 1, "a", "x", None),
        (5, 1, "a", "/long", "http://h/long"),
    ]
    assert html.page_links(pages.limit(0)).count() == 0
