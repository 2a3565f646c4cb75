"""Nulls, empty and very long texts, ties, repeated rows, clashing extra columns and empty tables."""

import pytest

import corpus_pipeline
from strataprop.llm.decontaminate import find_contamination
from strataprop.llm.language import identify_language
from strataprop.llm.ngram_join import keep_one, near_duplicates
from strataprop.llm.packing import pack
from strataprop.llm.pii import find_pii, redact
from strataprop.llm.quality import repetition_quality
from strataprop.llm.queries import TOKENIZER, URL_RULES
from strataprop.llm.sharding import shard_records
from strataprop.llm.toxicity import score_toxicity
from strataprop.llm.url_filter import filter_urls
from strataprop.llm.warc import archive_round_trip

LONG = " ".join(f"word{k % 5000} of" for k in range(60_000))
TEXT = "one two three four five six seven eight nine ten eleven a@b.com"
ROWS = [
    (1, TEXT, "en", "s"), (1, TEXT, "en", "s"), (2, TEXT.upper(), None, None), (3, None, "en", "s"), (4, "", "fr", "s"),
    (5, " \n\t ", None, "s"), (None, TEXT, "en", None), (None, "ein anderer Text ohne Kopie hier", "de", "s"),
    (6, LONG, "en", "s"), (7, "!!! 123 ???", "en", "s"), (8, "\u00e9\U0001f600 \x00 x", "fr", "s"), (None, None, None, None),
]
CLASH = {"row": 1, "row2": 2, "class": 3, "token": "t", "spans": "s", "score": 0.5, "start": 1, "task": 9, "slice": 1,
         "bytes": "b", "size": 7, "shard": 1, "key": 5, "target": 1, "rule": "r", "host": "h", "path": "p",
         "verdict": "v", "__row": 1, "__name": 2, "found": 1, "item": 1, "words": 1, "file": "f", "sha1": "x", "first": 1}
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def _with_clashes(frame):
    from pyspark.sql import functions as F
    return frame.select("*", *[F.lit(v).alias(c) for c, v in CLASH.items()])


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, lang, s, len(t) if t else None) for k, t, lang, s in ROWS]
    return _with_clashes(spark.createDataFrame(rows, DOCUMENT))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (1, 0), (2, 0), (6, 0), (7, 1), (8, None), (None, 1), (3, 0), (99, 0)],
                                 "doc_id long, toxic long")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, TEXT), (1, TEXT), (2, TEXT), (3, None), (4, ""), (5, "two words"), (None, "x y z")],
                                 "item_id long, text string")


def test_quality(docs):
    found = repetition_quality(docs).collect()
    assert len(found) == len(ROWS) and not any(r["kept"] for r in found if r["doc_id"] in (3, 4, 5, None))
    assert next(r for r in found if r["doc_id"] == 6)["n_words"] == 120_000


def test_language(docs):
    found = identify_language(docs).collect()
    assert len(found) == len(ROWS)
    assert {r["lang_pred"] for r in found if r["doc_id"] in (3, 4, 5, 7)} == {"und"}
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_without_any_label(docs):
    from pyspark.sql import functions as F
    found = identify_language(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in found} == {"und"} and len(found) == len(ROWS)


def test_pii(docs):
    found = find_pii(docs).collect()
    assert len(found) == len(ROWS)
    assert all(r["spans"] == [] for r in found if r["doc_id"] in (3, 4, 5))
    assert all(len(r["spans"]) == 1 for r in found if r["doc_id"] in (1, 2))
    marked = redact(docs)
    assert marked.columns == docs.columns and marked.count() == len(ROWS)
    assert [r["text"] for r in marked.filter("doc_id = 1").collect()] == [TEXT.replace("a@b.com", "[email]")] * 2


def test_near_duplicates(docs):
    found = [tuple(r) for r in near_duplicates(docs).collect()]
    assert sorted(map(str, found)) == sorted(map(str, [
        (1, 8, 1), (1, 8, 1), (2, 8, 1), (None, 8, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (None, 2, None), (None, 0, None),
        (6, 10_000, 6), (7, 1, 7), (8, 1, 8)]))
    kept = [r["doc_id"] for r in keep_one(docs).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [1, None, 3, 4, 5, None, 6, 7, 8]))
    assert keep_one(docs).columns == docs.columns


def test_contamination(docs, items):
    found = {(r["doc_id"], r["item_id"]) for r in find_contamination(docs, items).collect()}
    assert found == {(1, 1), (1, 2), (2, 1), (2, 2), (None, 1), (None, 2)}
    clashing = find_contamination(docs, _with_clashes(items.filter("item_id = 1"))).collect()
    assert {(r["doc_id"], r["item_id"]) for r in clashing} == {(1, 1), (2, 1), (None, 1)}


def test_packing(docs):
    found = pack(docs, TOKENIZER).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in found}) == len(found)
    assert sum(r["length"] == 1 for r in found) == 4
    assert sum(r["doc_id"] == 6 for r in found) > 10 and max(r["length"] for r in found) == 4096


def test_toxicity(docs, labels):
    found = score_toxicity(docs, labels).collect()
    assert len(found) == len(ROWS) and all(0 <= r["score"] <= 1 for r in found)
    assert len({r["score"] for r in found if r["doc_id"] in (3, 4, 5)}) == 1


def test_toxicity_without_a_class_is_the_share_of_the_other(docs, labels):
    from pyspark.sql import functions as F
    for chosen, score in (("toxic = 1", 1.0), ("toxic = 0 and doc_id <> 1", 0.0), ("doc_id = 99", 0.5), ("false", 0.5)):
        found = score_toxicity(docs, labels.filter(chosen).withColumn("text", F.lit("x"))).collect()
        assert len(found) == len(ROWS) and {round(r["score"], 12) for r in found} == {score}
        assert {r["predicted"] for r in found} == {int(score >= 0.5)}


def test_sharding(docs):
    found = shard_records(docs).collect()
    assert len(found) == len(ROWS) and len({(r["shard"], r["slot"]) for r in found}) == len(ROWS)
    assert len({r["shard"] for r in found if r["doc_id"] is None}) == 1


PAGES = [(1, "http://a.net/x", "<p>"), (1, "http://a.net/x", "<p>"), (2, None, "<p>"), (3, "", None), (4, "x y\n", ""),
         (None, "http://b.org/fr/", "<p>"), (None, "http://b.org/", "only"), (5, "http://" + "a." * 5000 + "net/", "long" * 100_000)]


@pytest.fixture(scope="module")
def pages(spark):
    return _with_clashes(spark.createDataFrame(PAGES, "page_id long, url string, html string"))


def test_urls(spark, pages):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    found = filter_urls(pages, rules).collect()
    assert len(found) == len(PAGES)
    assert sorted(str(r["page_id"]) for r in found if r["verdict"] == "block") == ["1", "1", "5"]
    assert all((r["host"], r["path"], r["rule"]) == ("", "", None) for r in found if r["page_id"] in (2, 3, 4))
    assert {r["verdict"] for r in filter_urls(pages, rules.limit(0)).collect()} == {"allow"}


def test_archive(pages):
    found = [(r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in archive_round_trip(pages).collect()]
    assert sorted(map(str, found)) == sorted(map(str, [
        (1, 3, "response", None), (1, 3, "response", None), (2, 3, "revisit", 1), (3, 0, "response", None),
        (4, 0, "revisit", 3), (None, 3, "revisit", 1), (None, 4, "response", None), (5, 400_000, "response", None)]))


def test_small_payloads_are_all_responses(pages):
    found = archive_round_trip(pages, min_bytes=4).collect()
    assert {r["record_type"] for r in found} == {"response"}


def test_empty_tables(docs, pages, labels, items, spark):
    none, no_pages = docs.limit(0), pages.limit(0)
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    for found in (repetition_quality(none), identify_language(none), find_pii(none), redact(none), near_duplicates(none),
                  keep_one(none), find_contamination(none, items), find_contamination(docs, items.limit(0)),
                  pack(none, TOKENIZER), score_toxicity(none, labels), shard_records(none), filter_urls(no_pages, rules),
                  archive_round_trip(no_pages)):
        assert found.count() == 0


def test_every_stage_of_the_pipeline(docs, items, spark, tmp_path):
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for frame in (docs, docs.limit(0)):
        for name, step in corpus_pipeline.STAGES:
            out = step(spark, frame, str(tmp_path))
            if name != "packing":
                assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
            assert (out.count() == 0) <= (frame.count() == 0 or name == "language")
