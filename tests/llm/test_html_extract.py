import html
import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from opinara.llm.html_extract import best_region, extract, extract_pages, learn, training_pages, unmask
from opinara.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
PAGE = """<html><head><title>T</title></head><body class="ad-free"><header><h1>Site</h1></header>
<div class="cookie-notice">We use cookies on this site please accept them all</div><nav><a href=x>Home</a></nav>
<div id="content"><div class="post"><h2>Real title</h2><p>First para&nbsp;graph of &lt;the&gt; text <b>bo</b>ld.
<script>var a="<p>no</p>";</script></p><div class="advert">Buy this now</div><p>Second one goes<br>on and on &eacute;.</p>
<ul><li>Item one</li><li>Item two</li></ul></div></div><section class="comments"><p>Great article, I loved it so much,
thanks for sharing it with us all.</p></section><aside>Side</aside><form>Mail <button>Go</button></form><footer>(c)</footer>"""


@pytest.fixture(scope="module")
def weights(spark):
    return learn(training_pages(spark.read.parquet(f"{FOLDER}/pages.parquet")))


def test_region_equals_brute_force():
    import random
    rng = random.Random(2)
    for _ in range(200):
        row = [rng.choice([-3, -1, 0.5, 2]) for _ in range(rng.randrange(0, 12))]
        start, end = best_region(row)
        best = max((sum(row[a:b]) for a in range(len(row)) for b in range(a + 1, len(row) + 1)), default=0)
        assert sum(row[start:end]) == max(best, 0)


def test_marked_articles_come_out_whole(spark):
    """The pages mark their article; the weights are those of that mark, the text is compared with it."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    rows = QUERIES["op3_html_extraction"](spark, FOLDER).collect()
    assert len(rows) == len(pages)
    for row in rows:
        inside = re.search(r"<article>(.*)</article>", pages[row.page_id], re.S)[1]
        plain = re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inside))
        assert row.text == " ".join(html.unescape(plain).split()) and row.n_chars == len(row.text)


def test_boilerplate_around_an_unmarked_article(weights):
    want = "Real title First para graph of <the> text bold. Second one goes on and on é. Item one Item two"
    assert extract(PAGE, weights) == want


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("plain  text", "plain text"), ("<p>a<p>b", "a b"), ("<!-- x", ""), ("<script>a", ""),
    ("a<br>b", "a b"), ("&amp;&#65;", "&A"), ("<p title='<x>'>q</p>", "q"), ("<style>x</style>", ""), ("x<b>y</b>", "xy"),
])
def test_small_pages(weights, page, text):
    assert extract(page, weights) == text
    assert not set(extract(page, {}).split()) - set(text.split())


BODY = "".join(f"<p>{' '.join(f'word{part}x{n}' for n in range(20))}.</p>" for part in range(3))
PLAIN = " ".join(f"{' '.join(f'word{part}x{n}' for n in range(20))}." for part in range(3))


@pytest.mark.parametrize("page", [
    "<div class='layout has-sidebar'>{}</div>", "<form id=page action=/>{}<button>Go</button></form>",
    "<div class='post-with-comments'>{}<ol class=comments><li><p>nice one</p></ol></div>",
    "<article><div class='share-buttons article-body'>{}</div></article>",
    "<article><h1 hidden>T</h1><div class='share-buttons article-body'>{}</div></article>",
    "<form><div class='social-policy'><nav>Home</nav><div class='left-sidebar box'><p>aside text</p></div>{}</div></form>",
    "<div class='layout has-sidebar' data-x='" + "<p>no</p>" * 500 + "'>{}</div>",
])
def test_wrappers_with_odd_names_keep_their_article(weights, page):
    assert extract("<html><body>" + page.format(BODY) + "<footer>f</footer></body></html>", weights) == PLAIN


@pytest.mark.parametrize("extra", [
    "<div class='cookie-box'><p>We use cookies.</p></div>", "<form><p>Mail us</p></form>", "<div class=ad>Buy</div>",
    "<section class=comments>" + "<p>I say so too and more of it.</p>" * 100 + "</section>",
])
def test_real_boilerplate_still_goes(weights, extra):
    assert extract(f"<body>{BODY}{extra}</body>", weights) == PLAIN
    assert extract(f"<body>{extra}{BODY}</body>", weights) == PLAIN


def test_page_of_an_advert_only_is_empty(weights):
    assert extract("<body><div class='ad'><p>Buy this</p></div><div class='promo-box'>Now</div></body>", weights) == ""


def test_unmasking_takes_the_wrapper_and_leaves_what_it_wraps():
    assert unmask([], [], [], 5) == []
    assert unmask([-1, 0], [60, 3], [True, True], 1) == [False, True]
    assert unmask([-1, 0, -1], [0, 60, 50], [False, True, False], 0) == [False, False, True]
    assert unmask([-1], [60], [False], 0) == unmask([-1], [60], [True], 6) == [True]


def test_words_positive_tags_negative(weights):
    assert weights and all((value > 0) == (feature[0] != "<") for feature, value in weights.items())
    assert learn(["<p>no article here</p>"]) == {}


def test_long_and_broken_pages_take_linear_time(weights):
    import time
    started = time.process_time()
    extract("<a title=\"" * 20_000 + "<div" * 20_000 + "<p>" + "word " * 50_000, weights)
    assert time.process_time() - started < 20


def test_odd_rows_and_empty_table(spark, weights):
    rows = [(1, "u", None, "x", 1), (1, "u", None, "x", 1), (None, None, "<p>a b c</p>", "y", 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    found = extract_pages(pages, weights)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((str(r.page_id), r.text) for r in found.collect()) == [("1", ""), ("1", ""), ("None", "a b c")]
    assert extract_pages(pages.limit(0), weights).count() == 0 and training_pages(pages.limit(0)) == []
