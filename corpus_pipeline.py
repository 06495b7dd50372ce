"""From raw documents to packed training sequences, by five operators in a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import decontaminate, jaccard, language, packing, repeats
from starloom.llm.frames import fresh, saved
from starloom.llm.queries import tokenizer_file

# A text whose words agree on no language better than this is rejected, as is one without letters.
LEAST_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a language that the labelled texts teach."""
    into = fresh("language", docs.columns)
    found = language.identify(docs, language.train(docs), into=into)
    sure = (F.col(f"{into}.lang_pred") != language.UNKNOWN) & (F.col(f"{into}.score") >= LEAST_SCORE)
    return found.filter(sure).drop(into)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each group of similar ones."""
    return jaccard.without_near_copies(docs, stored=True)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what an earlier text says too; texts of which nothing is left go."""
    into = fresh("repeats", docs.columns)
    left = repeats.remove(docs, into=into, stored=True).filter(F.trim("text") != "").drop(into)
    return left.withColumn("n_chars", F.char_length("text").cast("long"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that hold no passage of the benchmark."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), stored=True)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts and their places in full sequences."""
    return packing.pack(packing.tokenized(docs, tokenizer_file("word_bpe_49k.json")))


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", decontaminated),
    ("best-fit packing", packed),
]

# Stages with trained models, byte matches and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage is written and read again by the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = saved(docs)
    return docs
