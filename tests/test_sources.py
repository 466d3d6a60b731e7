import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from opinara.operators import intake
from opinara.operators.intake import cap_records, split_valid
from opinara.sources import files, html, landing
from opinara.sources.files import load_records

GOOD = "a review text that is long enough"


def write(folder, name, text):
    path = folder / name
    path.write_bytes(text.encode("utf-8"))
    return str(path)


def ids(df):
    return [r["source_id"] for r in rows(df.orderBy("ingest_seq"))]


def test_json_array(spark, tmp_path):
    items = [
        {"source_id": "r1", "raw_text": GOOD, "metadata": {"star_rating": 5}}, "text", {"source_id": 7, "raw_text": GOOD},
        {"source_id": "none"}, None, {"source_id": "", "raw_text": GOOD}, {"source_id": "when", "raw_text": GOOD, "scraped_at": "?"},
        {"source_id": "url", "raw_text": GOOD, "source_url": 5}, {"source_id": "meta", "raw_text": GOOD, "metadata": "x"},
        {"source_id": "r2", "raw_text": " " + GOOD, "scraped_at": "2024-03-10T08:00:00Z", "extra": 1},
    ]
    checked = load_records(spark, write(tmp_path, "in.json", json.dumps(items, indent=1)))
    good, bad = split_valid(checked, "raw")
    assert ids(good) == ["r1", "7", "r2"]
    first = rows(good.select("source_id", F.variant_get("metadata", "$.star_rating", "int").alias("stars")))
    assert {r["source_id"]: r["stars"] for r in first}["r1"] == 5
    assert good.count() + bad.count() == len(items)
    rules = [r["rule"] for r in rows(bad)]
    assert {"scraped_at_type", "source_url_type", "metadata_type", "source_id_empty"} <= set(rules)
    assert sum("not_an_object" in rule for rule in rules) == 2
    assert ids(cap_records(good, 2)) == ["r1", "7"]
    assert cap_records(good, 0).count() == 3


def test_json_array_with_repeated_key(spark, tmp_path):
    text = '[{"source_id": "a", "source_id": "b", "raw_text": "%s"}, {"source_id": "c", "raw_text": "%s"}]' % (GOOD, GOOD)
    assert ids(split_valid(load_records(spark, write(tmp_path, "in.json", text)), "raw")[0]) == ["b", "c"]


@pytest.mark.parametrize("text", ['{"source_id": "a"}', "nonsense", '"text"'])
def test_json_must_be_a_list(spark, tmp_path, text):
    with pytest.raises(Exception, match="must be a list"):
        load_records(spark, write(tmp_path, "in.json", text)).collect()


def test_json_lines(spark, tmp_path):
    lines = [json.dumps({"source_id": f"r{i}", "raw_text": GOOD}) for i in range(50)] + ["", "{broken"]
    good, bad = split_valid(load_records(spark, write(tmp_path, "in.jsonl", "\n".join(lines))), "raw")
    assert ids(good) == [f"r{i}" for i in range(50)]
    assert rows(bad)[0]["payload"] == "{broken"


def test_csv(spark, tmp_path):
    text = (
        "﻿source_id,raw_text,source_url\r\n"
        f'r1,"{GOOD}, with ""quotes""\nand a second line",http://x\r\n'
        f"r2,{GOOD},\r\n"
        f"r3,{GOOD}\r\n"
        f"r4,{GOOD},http://x,surplus\r\n"
        "r5,short,\r\n"
        f",{GOOD},\r\n"
        "r6\r\n"
    )
    good, bad = split_valid(load_records(spark, write(tmp_path, "in.csv", text)), "raw")
    assert ids(good) == ["r1", "r2", "r3"]
    assert rows(good.orderBy("ingest_seq"))[0]["raw_text"] == GOOD + ', with "quotes"\nand a second line'
    assert {r["source_id"]: r["rule"] for r in rows(bad)} == {
        "r4": "too_many_cells", "r5": "raw_text_short", None: "source_id_empty", "r6": "raw_text_short",
    }


def test_unknown_format_and_missing_file(spark, tmp_path):
    with pytest.raises(ValueError, match="unsupported"):
        load_records(spark, "reviews.xml")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        load_records(spark, str(tmp_path / "missing.json")).collect()


def _web(spark):
    posts = spark.createDataFrame(
        [(1, 10, "T1", "B1"), (2, None, "T2", "B2"), (3, 30, "T3", None), (4, 40, "", "B4"), (5, 0, "T5", "B5")],
        "seq int, id int, title string, body string",
    )
    comments = spark.createDataFrame(
        [(s, p, c, f"n{c}", "m@x", b, "/c") for s, p, c, b in [
            (1, 10, 1, "x1"), (2, 10, 2, "x2"), (3, 10, 3, "x3"), (1, 40, 0, None), (1, 99, 9, "x9"), (1, 0, 8, "x8"),
        ]],
        "seq int, post_id int, id int, name string, email string, body string, source_url string",
    )
    return posts, comments


def test_post_comment_assembly(spark):
    posts, comments = _web(spark)
    whole = landing.assemble_comments(posts, comments)
    assert sorted((r["post_seq"], r["comment_id"]) for r in rows(whole)) == [(1, 1), (1, 2), (1, 3), (4, 0)]
    two = landing.assemble_comments(posts, comments, comments_per_post=2)
    assert sorted((r["post_seq"], r["comment_id"]) for r in rows(two)) == [(1, 1), (1, 2), (4, 0)]
    assert [r["comment_id"] for r in rows(landing.assemble_comments(posts, comments, 1))] == [1]
    # Posts two and three use up places without giving rows.
    assert [r["comment_id"] for r in rows(landing.assemble_comments(posts, comments, 3, comments_per_post=2))] == [1, 2]
    assert [r["comment_id"] for r in rows(landing.assemble_comments(posts, comments, 4))] == [1, 2, 3, 0]


def test_limit_alone_decides(spark):
    posts = spark.range(6000).select(F.col("id").alias("seq"), (F.col("id") + 1).alias("id"), F.lit("t").alias("title"), F.lit("b").alias("body"))
    comments = posts.select(
        F.lit(1).alias("seq"), F.col("id").alias("post_id"), "id", F.lit("n").alias("name"), F.lit("m").alias("email"),
        "body", F.lit("/c").alias("source_url"),
    )
    assert landing.assemble_comments(posts, comments, 5000).count() == 5000


def test_normalize(spark):
    posts, comments = _web(spark)
    landed = landing.assemble_comments(posts, comments)
    got = {r["source_id"]: r for r in rows(landing.normalize(landed, "post_seq").withColumn("metadata", F.to_json("metadata")))}
    assert got["1"]["raw_text"] == "Title: T1\nReview Title: n1\nReview: x1"
    # Id 0 counts as no id, an empty body falls back on the post.
    assert got["40"]["raw_text"] == "Review Title: n0\nContent: B4"
    assert json.loads(got["1"]["metadata"]) == {"post_id": 10, "post_title": "T1", "comment_id": 1, "source_url": "/c"}
    mailed = rows(landing.normalize(landed, "post_seq", keep_email=True).select(F.to_json("metadata").alias("m")))
    assert "m@x" in mailed[0]["m"]
    bare = spark.createDataFrame([(3, None, "text"), (4, None, "")], "i int, comment_id int, comment_body string")
    assert [r["source_id"] for r in rows(landing.normalize(bare, "i"))] == ["rec_3"]


CARDS = """<html><body>
<article class="product_pod big"><h3><a title="A &amp; B" href="../a_1/index.html">A...</a></h3>
 <p class="star-rating Three"><i></i></p><p class="price_color">&pound;51.77</p><p class="availability instock">
   In stock </p></article>
<article class="product_pod"><h3><a href="b.html">  Plain <b>title</b> </a></h3><p class="star-rating Five"></p></article>
<article class="product_pod"><p class="price_color">1</p><p class="star-rating Nine"></p></article>
<article class="other"><h3><a title="no">no</a></h3></article>
<article class="product_pod"><h3><a title="D" href="http://[bad">D</a></h3></article>
</body></html>"""


def test_product_cards(spark):
    pages = spark.createDataFrame(
        [(1, "http://books.example/catalogue/page-1.html", CARDS), (2, "http://x/", "<p>none</p>"), (3, None, None)],
        "page_id long, url string, html string",
    )
    cards = html.extract_cards(pages)
    got = rows(html.product_records(cards).orderBy("card_no"))
    assert [r["post_title"] for r in got] == ["A & B", "Plain title", "Unknown"]
    assert [r["star_rating"] for r in got] == [3, 5, 0]
    assert [r["price"] for r in got] == ["£51.77", "N/A", "1"]
    assert [r["availability"] for r in got] == ["In stock", "Unknown", "Unknown"]
    assert [r["source_url"] for r in got][:3] == [
        "http://books.example/a_1/index.html", "http://books.example/catalogue/b.html", "http://books.example/catalogue/page-1.html",
    ]
    assert [(r["source_id"], r["rule"]) for r in rows(html.card_rejects(pages))] == [("1_4", "link_no_address")]
    assert got[0]["comment_body"] == (
        "Product: A & B. Price: £51.77. Customer rating: 3 out of 5 stars. Availability: In stock. "
        "Customers who rated this have mixed opinions about this product."
    )
    assert "highly recommend" in got[1]["comment_body"]
    assert [r["comment_id"] for r in got] == ["1_1", "1_2", "1_3"]
    assert html.extract_cards(pages, max_cards=3).count() == 3
    raw = landing.normalize(html.product_records(cards), F.col("card_no"))
    assert raw.count() == 3


def test_nested_cards(spark):
    spec = html.CardSpec("li", {"text": html.Part("p"), "tag": html.Part("b")})
    page = "<ul><li><p>one<li><p>two</ul><ul><li><p>three</p><b>x</b></li></ul>"
    pages = spark.createDataFrame([(1, "http://x/", page)], "page_id long, url string, html string")
    # Nothing closes the first card before the second starts, so the second lies inside it.
    got = [(r["text"], r["tag"]) for r in rows(html.extract_cards(pages, spec).orderBy("card_no"))]
    assert got == [("onetwo", None), ("two", None), ("three", "x")]


@pytest.mark.parametrize("split", ["128m", "20k", "3k"])
def test_input_order_of_unequal_files(spark, tmp_path, split):
    sizes = {"a": 3, "b": 2000, "c": 5}
    for name, size in sizes.items():
        (tmp_path / f"{name}.jsonl").write_text("\n".join(json.dumps({"source_id": f"{name}{i}", "raw_text": GOOD}) for i in range(size)) + "\n")
        (tmp_path / f"{name}.csv").write_text("source_id,raw_text\n" + "".join(f"{name}{i},{GOOD}\n" for i in range(size)))
        (tmp_path / f"{name}.json").write_text(json.dumps([{"source_id": f"{name}{i}", "raw_text": GOOD} for i in range(size)]))
    want = [f"{name}{i}" for name, size in sizes.items() for i in range(size)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        for found in (
            files.read_json_lines(spark, str(tmp_path / "*.jsonl")),
            files.read_csv(spark, str(tmp_path / "*.csv"), multi_line=False),
            files.read_json_array(spark, str(tmp_path / "*.json")),
        ):
            got = sorted((r["ingest_seq"], r["source_id"]) for r in found.select("ingest_seq", "source_id").collect())
            assert [name for _, name in got] == want and [seq for seq, _ in got] == list(range(len(want)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("form", ["json", "jsonl", "csv"])
def test_first_records_open_only_the_first_files(spark, tmp_path, form):
    folder = tmp_path / f"in put {{x}}.{form}"
    folder.mkdir()
    for part in range(12):
        items = [{"source_id": f"r{part}_{i}", "raw_text": "short" if i == 1 else f'{GOOD}, {part}, "{i}"'} for i in range(4)]
        text = {
            "json": lambda: json.dumps(items),
            "jsonl": lambda: "\n".join(map(json.dumps, items)),
            "csv": lambda: "source_id,raw_text\n" + "\n".join('{},"{}"'.format(r["source_id"], r["raw_text"].replace('"', '""')) for r in items),
        }[form]()
        (folder / f"part-{part:02} %41 [b].txt").write_text(text)
    # An unreadable file behind the cap does no harm.
    (folder / "part-99.txt").write_text('{"no": "list"' if form != "csv" else "other,header\n1,2")
    pattern = str(folder).replace("{", "\\{").replace("}", "\\}")
    first = files.first_records(spark, pattern, 4)
    got = rows(cap_records(split_valid(first, "raw")[0], 4).orderBy("ingest_seq"))
    assert [(r["ingest_seq"], r["source_id"]) for r in got] == [(0, "r0_0"), (2, "r0_2"), (3, "r0_3"), (4, "r1_0")]
    assert first.count() == 8 and len([r for r in rows(first) if r["errors"]]) == 2
    if form == "jsonl":
        assert len(first.inputFiles()) == 2


def test_first_records_of_too_few(spark, tmp_path):
    write(tmp_path, "in.jsonl", json.dumps({"source_id": "a", "raw_text": GOOD}))
    path = str(tmp_path / "in.jsonl")
    assert ids(files.first_records(spark, path, 9)) == ids(files.first_records(spark, path, 0)) == ["a"]
    with pytest.raises(ValueError, match="unsupported file format"):
        files.first_records(spark, str(tmp_path / "in.xml"), 1)


def test_large_cap_takes_no_row_through_one_task(spark, monkeypatch):
    monkeypatch.setattr(intake, "TOP_ROWS", 3)
    monkeypatch.setattr(intake, "CELLS", 5)
    numbers = [None, 0, 0, 7, 7, 7, 7, 10, 500, 501, 2**40, 2**62]
    df = spark.createDataFrame([(n, f"t{place}") for place, n in enumerate(numbers)], "ingest_seq long, raw_text string").repartition(4)
    for cap in (4, 5, 7, 8, 9, 11, 12, 50):
        capped = cap_records(df, cap)
        assert "SinglePartition" not in capped._jdf.queryExecution().toString() or cap in (4, 5)
        found = [row.ingest_seq for row in capped.collect()]
        assert sorted(-1 if n is None else n for n in found) == [-1 if n is None else n for n in numbers[:cap]]
    assert cap_records(df.limit(0), 9).count() == 0
