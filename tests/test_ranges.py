"""Arrays and CSV read in byte ranges against whole-file readers, whatever the ranges."""

import csv
import io
import json
import random
from contextlib import contextmanager

import pytest

from opinara.sources.files import load_records, read_csv, read_json_array
from opinara.sources.ranges import CSV, JSON, _open_after, read_records, scan_json

WIDE = 1 << 20


@contextmanager
def ranges(spark, size):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {name: spark.conf.get(name, None) for name in names}
    spark.conf.set(names[0], str(size))
    spark.conf.set(names[1], "1")
    spark.conf.set(names[2], "1")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def value(rng, depth=0):
    kind = rng.randrange(7 if depth < 3 else 4)
    if kind == 0:
        return rng.choice([None, True, 1.5, -3, 10**9])
    if kind < 4:
        return "".join(rng.choice(['a', ',', '"', '\\', '[', ']', '{', '}', '\n', '\u00e9', '\U0001f600', ' ', ':', '\\"', '",']) for _ in range(rng.randrange(9)))
    if kind < 6:
        return {rng.choice("abc,\"\\"): value(rng, depth + 1) for _ in range(rng.randrange(4))}
    return [value(rng, depth + 1) for _ in range(rng.randrange(4))]


@pytest.fixture
def arrays(tmp_path):
    rng, kept = random.Random(4), []
    for name, count in (("a", 25), ("b", 0), ("c", 1), ("d", 6)):
        items = [{"source_id": f"{name}{k}", "raw_text": "text number %d" % k, "metadata": {"v": value(rng)}, "x": value(rng)} for k in range(count)]
        text = json.dumps(items, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]))
        (tmp_path / f"{name}.json").write_text(rng.choice(["", " \n"]) + text + rng.choice(["", "\n", "  "]), encoding="utf-8")
        kept += items
    return tmp_path, kept


@pytest.mark.parametrize("size", [1, 7, 64, WIDE])
def test_arrays_equal_the_parsed_files(spark, arrays, size):
    folder, items = arrays
    path, part = f"{folder}/*.json", {1: "c", 7: "d"}.get(size)
    if part:  # small ranges are many
        path, items = f"{folder}/{part}.json", [item for item in items if item["source_id"].startswith(part)]
    with ranges(spark, size):
        rows = sorted(read_json_array(spark, path).selectExpr("ingest_seq", "source_id", "raw_text", "to_json(metadata) AS m", "errors").collect())
    assert [(r.ingest_seq, r.source_id, r.raw_text, json.loads(r.m), list(r.errors)) for r in rows] == [
        (k, item["source_id"], item["raw_text"], item["metadata"], []) for k, item in enumerate(items)
    ]


def test_one_array_fills_many_tasks(spark, tmp_path):
    items = [{"source_id": str(k), "raw_text": "some longer text, with a comma"} for k in range(2000)]
    (tmp_path / "big.json").write_text(json.dumps(items))
    with ranges(spark, 8000):
        records, _ = read_records(spark, f"{tmp_path}/big.json", JSON)
        tasks = records.selectExpr("spark_partition_id() AS p").distinct().count()
        assert records.count() == 2000 and tasks > 10


def test_broken_element_costs_only_itself(spark, tmp_path):
    (tmp_path / "x.json").write_text('[{"source_id": "a", "raw_text": "a long enough text"}, {"source_id" 7}, nonsense, {"source_id": "b", "raw_text": "another long text"}]')
    rows = sorted(load_records(spark, f"{tmp_path}/x.json").select("ingest_seq", "source_id", "errors").collect())
    assert [r.ingest_seq for r in rows] == [0, 1, 2, 3] and [r.source_id for r in rows if not r.errors] == ["a", "b"]


@pytest.mark.parametrize("text", ['{"a": [1, 2]}', "7", '"x, y"', "[1, 2", "[1, 2]]", "[1,, 2]", "[1, 2,]", '["a, b]', "[1], 2", " "])
def test_anything_but_an_array_is_an_error(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    with ranges(spark, 3), pytest.raises(Exception, match="must be a list"):
        read_json_array(spark, f"{tmp_path}/x.json").collect()


def test_scan_of_pieces_goes_on():
    pieces = ['[{"a": "x', ' y\\\\"', ' "b": [1', '2]}', '"\\"', '"]']
    whole = scan_json(pieces, False)
    assert whole.inside.tolist() == [False, True, False, False, False, True] and whole.depth.tolist() == [0, 2, 2, 3, 1, 1]
    assert (whole.inside_after, whole.depth_after) == (False, 0)
    for cut in range(1, len(pieces)):
        head, tail = scan_json(pieces[:cut], False), scan_json(pieces[cut:], bool(whole.inside[cut]))
        assert head.inside_after == whole.inside[cut] and head.depth_after == whole.depth[cut]
        assert (tail.depth + head.depth_after).tolist() == whole.depth[cut:].tolist()


def cells(rng):
    return "".join(rng.choice(["a", ",", '"', "\n", "\r\n", " ", "\u00e9", "x y", "[", ";"]) for _ in range(rng.randrange(8)))


@pytest.fixture
def tables(tmp_path):
    rng = random.Random(8)
    for name in ("a", "b", "c"):
        out = io.StringIO()
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(["source_id", "raw_text", "note"])
        for k in range(0 if name == "b" else 25):
            writer.writerow([f"{name}{k}", "t" + cells(rng) + "t", "n" + cells(rng).replace('"', "") + "n"])
            if rng.random() < 0.1:
                out.write("\n")  # a blank line is no record
            if rng.random() < 0.1:
                out.write(f'{name}{k}x,a "literal" quote,plain\n')
            if rng.random() < 0.1:
                out.write(f"{name}{k}y,one,two,three cells too many\n")
        (tmp_path / f"{name}.csv").write_text(out.getvalue(), encoding="utf-8", newline="")
    return tmp_path


def one_task(spark, path):
    """Spark's reader, one file after the other in one partition."""
    read = spark.read.options(quote='"', escape='"', header=True, multiLine=True, mode="PERMISSIVE").schema("source_id string, raw_text string, note string")
    return [tuple(row) for row in read.csv(path).collect()]


@pytest.mark.parametrize("size", [5, 40, WIDE])
def test_csv_equals_the_reader_of_whole_files(spark, tables, size):
    names = "abc" if size > 5 else "c"
    expected = [row for name in names for row in one_task(spark, f"{tables}/{name}.csv")]
    with ranges(spark, size):
        rows = sorted(read_csv(spark, f"{tables}/*.csv" if size > 5 else f"{tables}/c.csv").select("ingest_seq", "source_id", "raw_text", "errors").collect())
    assert [(r.ingest_seq, r.source_id, r.raw_text) for r in rows] == [(k, row[0], row[1]) for k, row in enumerate(expected)]
    assert {r.source_id[-1] for r in rows if "too_many_cells" in r.errors} == {"y"}


def test_csv_in_many_tasks_and_with_another_header(spark, tables):
    with ranges(spark, 60):
        records, sizes = read_records(spark, f"{tables}/*.csv", CSV)
        assert records.selectExpr("spark_partition_id() AS p").distinct().count() > 3
    (tables / "d.csv").write_text("other,header\n1,2\n")
    with pytest.raises(Exception, match="header differs"):
        read_csv(spark, f"{tables}/*.csv").collect()


def test_lines_inside_cells():
    assert [_open_after(line, False) for line in ("a,b", 'a,"b', 'a,"b"', '"a ""b"" c', '"a","b', 'a"b', 'a,"b"" c"', '""', '"""')] == [
        False, True, False, True, True, False, False, False, True
    ]
    assert [_open_after(line, True) for line in ("a,b", 'b",c', 'b",', 'b","c', 'b""', '"', '","')] == [True, False, False, True, True, False, True]
