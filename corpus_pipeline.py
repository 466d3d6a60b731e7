"""The corpus pipeline: each stage reads what the one before it kept."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm.common import in_part, shared_folder, table
from opinara.llm.decontaminate import find_leaks
from opinara.llm.langid import UNDETERMINED, identify, training_sample
from opinara.llm.line_dedup import dedup_lines
from opinara.llm.packing import pack
from opinara.llm.simhash import near_duplicates, one_of_each
from opinara.llm.similar import similar_texts

# A text of at least FEW_CHARS characters whose phrases are shorter than this has no learned language.
SHORT_PHRASES, FEW_CHARS = 1.5, 40


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without a letter and those that no language's text resembles go."""
    names = docs.columns
    marked = docs.toDF(*[f"c{number}" for number in range(len(names))])
    place = {name: f"c{number}" for number, name in enumerate(names)}
    texts = training_sample(docs, ~in_part(F.col("doc_id"), 3, 1))
    found = identify(marked, texts, tuple(marked.columns), place["text"])
    strange = (F.length(place["text"]) >= FEW_CHARS) & (F.col("letters_per_phrase") < SHORT_PHRASES)
    return found.filter((F.col("lang_pred") != UNDETERMINED) & ~strange).select(*marked.columns).toDF(*names)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat an earlier one; n_chars follows the text."""
    found = dedup_lines(docs).select(*[f"`{name}`" for name in docs.columns])
    return found.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else found


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id.

    Texts are linked by op1's fingerprints (SimHash, two bits). As that leaves
    near copies that differ in more bits, texts of a similarity of 0.8
    (five-word shingles) are linked too.
    """
    return one_of_each(docs, grouped=partial(similar_texts, also=near_duplicates))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.filter(F.size("leaks") == 0).select(*[f"`{name}`" for name in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, with their ids, by sequence."""
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]
# Trained models, searches and packing have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
