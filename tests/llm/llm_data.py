"""Small inputs for the tests of the training-text operators."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k string, t string, score string, leaks string, id int, n int"
SF = "/root/testdata/sf0.001"


def documents(spark, texts, ids=None):
    """A documents table with extra columns whose names the operators use inside."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, x, "en", "s", None if x is None else len(x), "k", "t", "x", "y", 1, 2) for i, x in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def words(seed, count, size=400):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(size)]
    return [rng.choice(vocabulary) for _ in range(count)]


ODD = [None, "", " \n\t ", "x", "same text here again", "same text here again", "word " * 30_000]
