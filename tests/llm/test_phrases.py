"""Phrase collocations against counting every phrase, with and without room for all words."""

import collections
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from strataprop.llm import phrases
from strataprop.llm.phrases import count_pairs, mine_phrases


def _told(found):
    by_language = collections.defaultdict(list)
    for r in sorted(found.collect(), key=lambda r: (r["lang"], r["rank"])):
        by_language[r["lang"]].append((r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]))
        assert r["rank"] == len(by_language[r["lang"]])
    return dict(by_language)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    words = ["New", "york", "CITY", "é", "of", "the", "x", "a b", "中", "q1", "q2", "q3"]
    weights = [8, 8, 8, 3, 9, 9, 2, 1, 1, 1, 1, 1]
    made = []
    for k in range(400):
        chosen = rng.choices(words, weights, k=rng.randrange(25))
        if k % 3 == 0:
            chosen += ["san", "FRANCISCO", "bay"]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "? "]) for w in chosen)
        made.append((text, rng.choice(["en", "en", "de", None, "und", "rare"]) if k else "rare"))
    return made + [(None, "en"), ("", "de"), ("only one", "xx"), (" \n\t.,", "en")]


@pytest.mark.parametrize("room", [18, 3, 0])
def test_phrases_are_those_of_brute_force(spark, rows, room, monkeypatch):
    monkeypatch.setattr(phrases, "ADDRESS_BITS", room)  # how many words and pairs are addressed, not whether they count
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(3).withColumns(
        {c: F.lit(1) for c in ("hash", "word", "n", "key", "ref", "left", "a", "phrase", "rank")})
    assert _told(mine_phrases(frame)) == brute.phrases(rows)


def test_longer_phrases_lower_counts_and_a_small_top(spark, rows):
    frame = spark.createDataFrame(rows, "text string, lang string")
    found = _told(mine_phrases(frame, min_count=3, max_words=4, top=7, cover_percent=80))
    assert found == brute.phrases(rows, 3, 4, 7, 80)
    assert _told(mine_phrases(frame, max_words=2)) == brute.phrases(rows, max_words=2)


def test_a_long_text_and_repeated_rows(spark):
    rows = [("aa bb cc dd " * 30_000, "en"), ("aa bb", "en"), ("aa bb", "en")]
    assert _told(mine_phrases(spark.createDataFrame(rows, "text string, lang string"))) == brute.phrases(rows)


def test_empty_tables(spark):
    frame = spark.createDataFrame([("a b", "en")], "text string, lang string")
    assert mine_phrases(frame).count() == 0 and mine_phrases(frame.limit(0)).count() == 0
    with pytest.raises(ValueError, match="two words"):
        mine_phrases(frame, max_words=1)


def test_dense_and_sparse_tiles_count_alike():
    rng = np.random.default_rng(3)
    left = np.concatenate([rng.integers(0, 40, 60_000), rng.integers(0, 1 << 18, 5_000)])
    right = np.concatenate([rng.integers(500, 560, 60_000), rng.integers(0, 1 << 18, 5_000)])
    found = sorted(zip(*(x.tolist() for x in count_pairs(left, right))))
    assert found == sorted((*pair, n) for pair, n in collections.Counter(zip(left.tolist(), right.tolist())).items())
    assert [len(x) for x in count_pairs(left[:0], right[:0])] == [0, 0, 0]
