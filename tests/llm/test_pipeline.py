import sys
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from llm_data import documents, words

import __spark_entry__ as entry
import corpus_pipeline
from opinara.llm.simhash import fingerprint

FOLDER = "/root/testdata/sf0.001"


def test_stages_on_a_table(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names, sizes = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, path = docs, str(tmp_path / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        sizes[name] = docs.count()
        if name != "packing":
            assert docs.columns == names
            assert docs.join(before, "doc_id", "left_anti").isEmpty()
            assert docs.filter(F.length("text") != F.col("n_chars")).isEmpty()
    assert sizes["language_id"] >= 195 and sizes["line_dedup"] == sizes["language_id"] > sizes["near_dedup"] > sizes["decontamination"]
    kept = spark.read.parquet(str(tmp_path / "near_dedup")).collect()
    prints = [fingerprint(row.text) for row in kept]
    assert all((a ^ b).bit_count() > 2 for n, a in enumerate(prints) for b in prints[:n])
    packed = docs.agg(F.countDistinct("doc_id")).first()[0]
    assert packed == sizes["decontamination"]


def test_run_is_registered_and_whole(spark):
    rows = entry.queries()["pipeline"](spark, FOLDER)
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"} == set(rows.columns)
    assert rows.count() > 100


def test_stages_take_odd_rows_and_empty_tables(spark):
    texts = [" ".join(words(n, 80)) for n in range(30)] + [None, "", "123 456", "жщ" * 40, " ".join(words(0, 80)), "short"]
    docs = documents(spark, texts, [*range(30), None, 31, 32, 33, 34, 35])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        ids = {row.doc_id for row in out.select("doc_id").collect()}
        if name == "language_id":
            assert out.columns == docs.columns and ids == {*range(30), 34, 35}
        if name == "near_dedup":
            assert 34 not in ids and len(ids & set(range(30))) == 30
        stage(spark, docs.limit(0), FOLDER).count()
