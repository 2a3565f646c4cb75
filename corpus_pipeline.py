"""A corpus pipeline: language, near duplicates, test items, personal data, packing.

Each stage takes all the documents that the stage before it kept, and what it decides takes effect.
A stage's result is written as Parquet in the shared folder and read again, so a lost executor costs a
part of one stage, and no plan grows with the number of stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataprop.functions.runtime import stage
from strataprop.llm.decontaminate import find_contamination
from strataprop.llm.language import fit_language, keep_identified, training_rows
from strataprop.llm.ngram_join import keep_one
from strataprop.llm.packing import pack
from strataprop.llm.pii import redact

#: A document is rejected if no language has this calibrated probability.
MIN_LANGUAGE_SCORE = 0.35
#: A vocabulary file that every executor has.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language the model is sure of; it learns from these documents' labels.

    A null or blank text, or one without a letter, has no language and goes. All columns stay.
    """
    model = fit_language(training_rows(docs, "doc_id", "lang", folds=4, held_out=2), "text", "lang")
    return keep_identified(docs, model, "text", MIN_LANGUAGE_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each group of near duplicates."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a copy of a benchmark item, edited or not.

    Documents are told apart by doc_id and text, so a null or repeated doc_id drops no other document.
    """
    name = F.struct(docs["doc_id"], F.xxhash64(docs["text"]).alias("text"))
    found = find_contamination(docs.select(name.alias("name"), "text"),
                               spark.read.parquet(f"{sf_dir}/benchmark.parquet"), key="name")
    leaks = stage(found.select("name").distinct())
    same = name["doc_id"].eqNullSafe(leaks["name"]["doc_id"]) & (name["text"] == leaks["name"]["text"])
    return docs.join(leaks, same, "left_anti")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put a mark of its kind in place of every personal datum; n_chars follows the text."""
    marked = redact(docs)
    return marked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place every document's tokens in sequences of 4096."""
    return pack(docs, TOKENIZER)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("personal_data", personal_data), ("packing", packing)]

#: No stage but the join of near duplicates can be said in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``: the pieces of the kept documents and their places."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
