"""Periodic runs against all stretches at all distances, and its edge cases."""

import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from strataprop.llm.runs import find_runs, periodic_runs, with_planted_runs


def _sequences():
    rng = random.Random(11)
    for _ in range(400):
        n, kinds = rng.randrange(100), rng.choice([1, 2, 2, 3, 6])
        words = [rng.randrange(kinds) for _ in range(n)]
        if n > 3 and rng.random() < 0.5:
            a = rng.randrange(n)
            p = rng.randrange(1, n - a + 1)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        yield words
    fibonacci = "0", "01"
    while len(fibonacci[1]) < 400:
        fibonacci = fibonacci[1], fibonacci[1] + fibonacci[0]
    yield [int(c) for c in fibonacci[1]]
    yield [bin(k).count("1") % 2 for k in range(400)]


@pytest.mark.parametrize("least", [2, 3, 12])
def test_runs_are_those_of_brute_force(least):
    for words in _sequences():
        assert find_runs(np.array(words, np.int64), least) == brute.runs(words, least), words


def test_long_periodic_and_uniform_texts():
    assert find_runs(np.zeros(50_000, np.int64)) == [(0, 50_000, 1)]
    assert find_runs(np.arange(50_000) % 997) == [(0, 50_000, 997)]


def test_rows_have_their_own_runs_whatever_the_others_are(spark):
    rng = random.Random(5)
    texts = [" ".join(f"w{w}" for w in words) for words in _sequences()]
    texts += ["  \n".join(rng.choices("ab", k=3000)) + "\t", "x " * 40, None, "", " \n ", "é z " * 13 + "é z"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r for r in periodic_runs(frame).collect()}
    assert len(found) == len(texts)
    for k, text in enumerate(texts):
        words = brute.WORD.findall(text or "")
        runs = brute.runs(words)
        assert [(r["start"], r["length"], r["period"]) for r in found[k]["runs"]] == runs
        dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert found[k]["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in dropped)


def test_edges(spark):
    rows = [(1, "a " * 12), (1, "a " * 12), (None, "a b " * 9), (2, None), (3, "a " * 11)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit(1) for c in ("runs", "collapsed", "key", "words", "n", "h", "a", "p", "g")})
    for docs in (frame, with_planted_runs(frame)):
        found = periodic_runs(docs)
        assert found.columns == ["doc_id", "runs", "collapsed"] and found.count() == 5
        assert periodic_runs(docs.limit(0)).count() == 0
    plain = sorted((r["doc_id"] or 0, len(r["runs"]), r["collapsed"]) for r in periodic_runs(frame).collect())
    assert plain == [(0, 1, "a b"), (1, 1, "a"), (1, 1, "a"), (2, 0, ""), (3, 0, " ".join("a" * 11))]
    with pytest.raises(ValueError, match="two words"):
        periodic_runs(frame, min_length=1)


def test_planted_texts(spark):
    rng = random.Random(2)
    rows = [(k, " ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(30)))) for k in range(300)] + [(None, "x y")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["text"] for r in with_planted_runs(frame).collect()}
    assert len(found) == 301
    for key, text in rows:
        h, words = zlib.crc32(("" if key is None else str(key)).encode()), text.split()
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        assert found[key].split() == words
