import random
import re
import sys
from pathlib import Path

import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from llm_data import ODD, documents, words

from opinara.llm.common import shared_folder
from opinara.llm.components import components
from opinara.llm.simhash import FEW, fingerprint, links, masks, near_duplicates, one_of_each


def slow_print(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    spans = [" ".join(found[i:i + 3]) for i in range(max(1, len(found) - 2))] if found else []
    hashes = [xxhash.xxh64_intdigest(span.encode(), 42) for span in spans]
    return sum(1 << bit for bit in range(64) if 2 * sum(one >> bit & 1 for one in hashes) > len(hashes))


def classes(prints):
    """Smallest index reachable over links of at most two bits, all pairs compared."""
    root = list(range(len(prints)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return [find(a) for a in range(len(prints))]


def test_masks_cover_every_pair_of_bits():
    for a in range(64):
        for b in range(a, 64):
            assert any(not mask >> a & 1 and not mask >> b & 1 for mask in masks())


def test_fingerprint_equals_definition():
    for text in ["", None, "One", "One two", "A B c", "Ä x\x0by\x85z ä", " ".join(words(1, 500)), "a a a a a b"]:
        assert fingerprint(text) == slow_print(text)


def test_links_join_what_all_pairs_join(spark):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    prints = {rng.getrandbits(64) for _ in range(200)} | {base}
    for _ in range(12 * FEW):  # one crowd in a few bits: buckets beyond FEW
        one = base
        for _ in range(rng.randrange(1, 5)):
            one ^= 1 << rng.randrange(0, 40)
        prints.add(one)
    prints = sorted(prints)
    signed = [one - (1 << 64) if one >> 63 else one for one in prints]
    found = links(spark.createDataFrame([(one,) for one in signed], "print long")).collect()
    place = {one: number for number, one in enumerate(signed)}
    assert all((prints[place[row.a]] ^ prints[place[row.b]]).bit_count() <= 2 for row in found)
    root = list(range(len(prints)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for row in found:
        low, high = sorted((find(place[row.a]), find(place[row.b])))
        root[high] = low
    assert [find(a) for a in range(len(prints))] == classes(prints)
    assert len(found) < 70 * len(prints)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100)] + [(500, 500 + i) for i in range(1, 60)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(found[i] == 0 for i in range(101)) and all(found[500 + i] == 500 for i in range(60))


def test_rounds_of_components_keep_the_planned_size(spark, capsys):
    """Spark's estimate had 3,500 digits after the rounds of such a chain, twice as many with each further round."""
    roots = components(spark.range(399).selectExpr("id as a", "id + 1 as b"))
    assert roots.filter("root = 0").count() == 400
    roots.explain(mode="cost")
    sizes = re.findall(r"sizeInBytes=([^,)]*)", capsys.readouterr().out)
    assert sizes and not [size for size in sizes if "E+" in size]


def test_tables_are_kept_in_few_files(spark):
    """Twelve tasks of short texts left 12 files of fingerprints, and each call of components stored its first labels too."""
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.rglob("*part-*"))
    docs = documents(spark, [" ".join(words(n, 40)) for n in range(60)] * 2).repartition(12)
    assert near_duplicates(docs).agg(F.countDistinct("component_id")).first()[0] == 60
    files = {file for file in folder.rglob("*part-*") if not file.name.endswith(".crc")} - before
    assert 0 < len(files) <= 8
    stored = set(folder.glob("table-*"))
    components(spark.range(2).selectExpr("id as a", "id + 5 as b")).collect()
    # The ends, and one round that moves no label.
    assert len(set(folder.glob("table-*")) - stored) == 2


def test_near_duplicates_equal_brute_force(spark):
    row = words(9, 400)
    texts = [" ".join(row), " ".join(row[:200] + ["other"] + row[200:]), " ".join(words(10, 300)), " ".join(row).upper(), *ODD]
    ids = [40, 7, 3, 12, *range(100, 100 + len(ODD))]
    found = {r.doc_id: r for r in near_duplicates(documents(spark, texts, ids)).collect()}
    order = sorted(range(len(ids)), key=ids.__getitem__)
    prints = [slow_print(texts[i]) for i in order]
    roots = classes(prints)
    for number, i in enumerate(order):
        assert found[ids[i]].fingerprint == f"{prints[number]:016x}"
        assert found[ids[i]].component_id == ids[order[roots[number]]]


def test_null_and_repeated_keys(spark):
    docs = documents(spark, ["a b c d e f", "a b c d e f", "", None, "q r s t u v"], [None, 5, 5, None, None])
    rows = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in near_duplicates(docs).collect())
    assert len(rows) == 5 and [r[2] for r in rows if r[0] == "5"] == ["5", "5"]
    assert sum(r[2] == "None" for r in rows) == 1
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    # Key 5 has two texts: one document, of which the smallest text stays; the other null key is alone.
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("5", ""), ("None", "q r s t u v")]


def test_one_of_each_keeps_the_smallest(spark):
    texts = ["a b c d e f g", "x y z w v u t", "A b c d e f g", "a b c d e f g"]
    assert sorted(r.doc_id for r in one_of_each(documents(spark, texts, [4, 9, 2, 7])).collect()) == [2, 9]


def test_empty_table(spark):
    assert near_duplicates(documents(spark, [])).count() == 0
    assert one_of_each(documents(spark, [])).count() == 0
    assert components(spark.createDataFrame([], "a long, b long")).agg(F.count("*")).first()[0] == 0
