import random
import sys
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from llm_data import ODD, documents, words

import corpus_pipeline
from opinara.llm import similar
from opinara.llm.simhash import fingerprint
from opinara.llm.similar import _sharing_rare, similar_texts


def shingle_set(text):
    found = (text or "").lower().split()
    return {tuple(found[i:i + 5]) for i in range(max(1, len(found) - 4))}


def classes(texts):
    """Smallest index reachable over pairs of a Jaccard similarity of 0.8, all pairs compared."""
    root, sets = list(range(len(texts))), [shingle_set(text) for text in texts]

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(texts)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return [find(a) for a in range(len(texts))]


def edited(row, seed, edits):
    rng, row = random.Random(seed), list(row)
    for place in rng.sample(range(len(row)), edits):
        row[place] = f"new{seed}x{place}"
    return row


def corpus():
    """Texts with 0 to 8 of 150 words changed (similarity 1 to about 0.6), chains of such, and others."""
    texts = []
    for seed in range(12):
        row = words(seed, 150)
        texts += [" ".join(edited(row, 100 * seed + edits, edits)) for edits in range(9)]
        for step in range(3):
            row = edited(row, 5000 + 10 * seed + step, 3)
            texts.append(" ".join(row))
    return texts + [" ".join(words(50 + n, 3 + n)) for n in range(20)] + ODD


def test_groups_equal_brute_force(spark):
    texts = corpus()
    expected = classes(texts)
    found = {row.doc_id: row.component_id for row in similar_texts(documents(spark, texts)).collect()}
    assert [found[n] for n in range(len(texts))] == expected
    assert 20 < len(set(expected)) < len(texts) - 20


def test_near_dedup_stage_leaves_no_similar_pair(spark):
    texts = corpus()
    kept = {row.doc_id for row in corpus_pipeline.near_dedup(spark, documents(spark, texts), "").collect()}
    assert kept == set(classes(texts))


def test_crowd_of_copies_null_keys_and_empty_table(spark):
    row = words(3, 200)
    texts = [" ".join(edited(row, n, 1)) for n in range(120)] + [" ".join(row)] * 3
    found = similar_texts(documents(spark, texts, [None, *range(7, 129)])).collect()
    assert len(found) == 123 and {one.component_id for one in found} == {7}
    assert similar_texts(documents(spark, [])).count() == 0


def test_crowd_that_shares_buckets_only(spark):
    """Short texts, one word of 20 changed, are not similar (0.5): no pair of them is compared."""
    row = words(4, 20)
    texts = [" ".join(row[:10] + [f"new{n}"] + row[11:]) for n in range(200)]
    docs = documents(spark, texts)
    assert sorted(one.component_id for one in similar_texts(docs).collect()) == list(range(200))
    nodes = docs.selectExpr("doc_id as node", "doc_id as root")
    assert _sharing_rare(nodes, docs.selectExpr("doc_id as node", "text as t")).isEmpty()


def test_blocks_of_texts_decide_as_pair_by_pair(spark, monkeypatch):
    monkeypatch.setattr(similar, "BLOCK_CHARS", 3000)
    texts = corpus()[:60]
    known = documents(spark, texts).selectExpr("doc_id as node", "text as t")
    pairs = known.alias("x").join(known.alias("y"), F.expr("x.node < y.node")).selectExpr("x.node as a", "y.node as b")
    found = {tuple(row) for row in similar._alike_in_blocks(pairs, known).collect()}
    assert found == {tuple(row) for row in similar._alike(pairs, known).collect()} and len(found) > 30


def test_near_dedup_stage_keeps_one_of_texts_whose_fingerprints_are_near(spark):
    """Fingerprints within two bits link texts that share too few five-word shingles."""
    row, texts, rng = words(9, 40, 60), [], random.Random(1)
    while len(texts) < 2:
        # Every fifth word changed: no five-word shingle stays, some three-word ones do.
        other = [f"q{rng.randrange(10**6)}" if place % 5 == 4 else word for place, word in enumerate(row)]
        one, two = " ".join(row * 30), " ".join((row * 29) + other)
        if (fingerprint(one) ^ fingerprint(two)).bit_count() <= 2 and len(shingle_set(one) & shingle_set(two)) < 0.8 * len(shingle_set(one) | shingle_set(two)):
            texts = [one, two]
    kept = [r.doc_id for r in corpus_pipeline.near_dedup(spark, documents(spark, texts), "").collect()]
    assert kept == [0]


def test_jobs_of_near_dedup(spark):
    """The driver holds each job's plans and broadcasts: 242 jobs on these texts with joins broadcast, 204 without."""
    context, group = spark.sparkContext, "near_dedup of a test"
    docs = documents(spark, corpus())
    context.setJobGroup(group, group)
    try:
        corpus_pipeline.near_dedup(spark, docs, "").collect()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    jobs = len(context.statusTracker().getJobIdsForGroup(group))
    assert 50 < jobs <= 215
