import random
import sys
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from llm_data import ODD, documents, words

from opinara.llm.queries import QUERIES
from opinara.llm.toxicity import BITS, features, fit, score, train


def test_features_are_distinct_grams_within_words():
    seen = np.empty(1 << BITS, np.int32)
    row = features("Abc  abc\nab", seen)
    assert len(set(row.tolist())) == len(row)
    # " ab", "abc", "bc ", " abc", "abc ", " abc ", "ab ", " ab " and nothing across words
    assert len(row) == 8 and set(features("abc ab", seen).tolist()) == set(row.tolist())
    assert not len(features("", seen)) and not len(features(None, seen))


def make(seed, bad):
    rng = random.Random(seed)
    row = words(seed, rng.randrange(40, 400), 3000)
    for _ in range(4 * bad):
        row.insert(rng.randrange(len(row)), rng.choice(["zzidiotq", "vvscumx", "qqmoronw"]) + rng.choice(["", "s", "ly"]))
    return " ".join(row)


def test_planted_words_are_learned(spark):
    texts = [make(seed, seed % 5 == 0) for seed in range(500)]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(400)] + [(0, 1, 1), (None, 1, 1), (401, 1, None)], "doc_id long, quality int, toxic int")
    model = train(docs, labels, F.lit(True))
    found = {r.doc_id: r.score for r in score(docs, model).collect()}
    assert np.mean([(found[i] >= 0.5) == (i % 5 == 0) for i in range(400, 500)]) > 0.97
    assert all(0 <= one <= 1 for one in found.values())


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    found = QUERIES["op4_toxicity"](spark, folder)
    rows = found.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out").collect()
    toxic = [row.predicted for row in rows if row.toxic == 1]
    clean = [row.predicted for row in rows if row.toxic == 0]
    assert np.mean(toxic) > 0.8 and np.mean(clean) < 0.01


def test_one_label_only_and_odd_rows(spark):
    docs = documents(spark, ODD, [None, 1, 1, 2, 3, 3, 4])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = train(docs, none, F.lit(True))
    found = score(docs, model)
    assert found.columns == ["doc_id", "score"] and found.count() == len(ODD) and found.agg(F.max("score")).first()[0] < 0.01
    assert fit(["a", "b"], [1, 1], 1.0).scores(["a"])[0] > 0.99
    assert score(documents(spark, []), model).count() == 0
