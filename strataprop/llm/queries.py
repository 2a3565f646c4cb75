"""One query per operator of this package: name -> function of session and folder."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataprop.llm.class_model import score_language_model
from strataprop.llm.decontaminate import find_contamination
from strataprop.llm.language import identify_language
from strataprop.llm.ngram_join import near_duplicates
from strataprop.llm.packing import pack
from strataprop.llm.phrases import mine_phrases
from strataprop.llm.pii import KINDS, find_pii
from strataprop.llm.quality import repetition_quality
from strataprop.llm.runs import periodic_runs, with_planted_runs
from strataprop.llm.sharding import shard_records
from strataprop.llm.toxicity import score_toxicity
from strataprop.llm.url_filter import filter_urls
from strataprop.llm.warc import archive_round_trip

#: The rules of the url query: host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

#: A vocabulary file that every executor has.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark, sf_dir) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return filter_urls(_table(spark, sf_dir, "pages"), rules)


def op2_quality_rules(spark, sf_dir) -> DataFrame:
    return repetition_quality(_table(spark, sf_dir, "documents"))


def op3_language_id(spark, sf_dir) -> DataFrame:
    return identify_language(_table(spark, sf_dir, "documents"))


def op4_pii(spark, sf_dir) -> DataFrame:
    found = find_pii(_table(spark, sf_dir, "documents"))

    def told(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(spans, kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    counts = [count(base, kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(told(base), 256).alias("base_sha256"),
                        told(F.col("spans")).alias("spans"))


def op5_ngram_jaccard_join(spark, sf_dir) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op6_decontamination(spark, sf_dir) -> DataFrame:
    return find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_packing(spark, sf_dir) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), TOKENIZER)


def op8_toxicity(spark, sf_dir) -> DataFrame:
    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_sharding(spark, sf_dir) -> DataFrame:
    return shard_records(_table(spark, sf_dir, "documents")).withColumn("law", F.lit("key"))


def op10_warc(spark, sf_dir) -> DataFrame:
    return archive_round_trip(_table(spark, sf_dir, "pages"))


def op11_phrase_collocations(spark, sf_dir) -> DataFrame:
    return mine_phrases(_table(spark, sf_dir, "documents"))


def op12_class_language_model(spark, sf_dir) -> DataFrame:
    return score_language_model(_table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark, sf_dir) -> DataFrame:
    found = periodic_runs(with_planted_runs(_table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    told = found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("longest"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = F.col("longest.length"), -F.col("longest.period")
    return told.select(
        "doc_id", "n_runs", (-F.col("longest.before")).alias("start"), length.alias("length"), period.alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


QUERIES = {f.__name__: f for f in (
    op1_url_filters, op2_quality_rules, op3_language_id, op4_pii,
    op5_ngram_jaccard_join, op6_decontamination, op7_packing, op8_toxicity, op9_sharding, op10_warc,
    op11_phrase_collocations, op12_class_language_model, op13_periodic_runs)}
