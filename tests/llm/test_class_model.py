"""The class-based language model: plain counts, a plain exchange step, probabilities that add up to one."""

import collections
import math
import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strataprop.llm import class_model
from strataprop.llm.class_model import ALL_CLASSES, CLASSES, END, FORMS, fit_class_model, score_language_model
from strataprop.llm.words import blocks


def _tokens(text):
    return [*brute.WORD.findall((text or "").translate(brute.FOLD)), None]


def _held_out(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 7 == 2


def _ids(words):
    """Word ids of the operator by word; None is the end."""
    if not words:
        return {}
    found = [class_model._tokens(block)[0] for block in blocks(pa.array([" ".join(sorted(words))]))]
    return dict(zip(sorted(words), found[0].tolist()))


def _check(spark, rows, found):
    """Every column of the result against plain counting and the formulas, with the model's own classes."""
    train = [_tokens(text) for key, text in rows if not _held_out(key)]
    model, _ = fit_class_model(spark.createDataFrame(
        [(text,) for key, text in rows if not _held_out(key)], "text string"))
    counts = collections.Counter(t for tokens in train for t in tokens)
    every, types = sum(counts.values()), len(counts)
    assert (model.tokens, model.types) == (every, types)
    words = {t for key, text in rows for t in _tokens(text) if t is not None}
    ids, known = _ids(words), dict(zip(model.words.tolist(), model.classes.tolist()))
    class_of = {w: known.get(i, CLASSES + (i & 31)) for w, i in ids.items()} | {None: ALL_CLASSES - 1}
    totals, kinds = collections.Counter(), collections.Counter()
    for token, n in counts.items():
        totals[class_of[token]] += n
        kinds[class_of[token]] += 1
    follows = collections.Counter()
    for tokens in train:
        follows.update(zip([ALL_CLASSES - 1, *map(class_of.get, tokens)], map(class_of.get, tokens)))
    before, after = collections.Counter(), collections.Counter()
    for (a, b), n in follows.items():
        before[a] += n
        after[b] += n

    def score(tokens):
        total, last = 0.0, ALL_CLASSES - 1
        for token in tokens:
            c = class_of[token]
            share = (after[c] + 1) / (every + ALL_CLASSES)
            total += math.log10((follows[last, c] + 10 * share) / (before[last] + 10))
            if token is not None:
                total += math.log10((counts[token] + 0.5) / (totals[c] + 0.5 * (kinds[c] + (c >= CLASSES))))
            last = c
        return total

    assert len(found) == len(rows)
    expected = sorted((str(key), _held_out(key), len(t), sum(counts[w] > 0 for w in t), every,
                       round(sum(math.log10((counts[w] + 1) / (every + types + 1)) for w in t), 6), round(score(t), 6))
                      for key, t in ((key, _tokens(text)) for key, text in rows))
    assert sorted((str(r["doc_id"]), *list(r)[1:5], round(r["base_score"], 6), round(r["score"], 6))
                  for r in found) == expected


def _rows():
    rng = random.Random(4)
    kinds = [["the", "a", "THIS"], ["cat", "dog", "bird", "é"], ["runs", "sleeps.", "sings", "7"], [f"rare{k}" for k in range(300)]]
    rows = [(k, " ".join(rng.choice(kinds[j % 3] if rng.random() < 0.9 else kinds[3]) for j in range(rng.randrange(30))))
            for k in range(300)]
    return [*rows, (None, "the cat"), (None, None), (3, None), (5, ""), (5, " \n"), (6, "x \x00 y z")]


@pytest.mark.parametrize("known", [18, 3, 0])
def test_scores_follow_the_formulas(spark, known, monkeypatch):
    monkeypatch.setattr(class_model, "KNOWN_BITS", known)  # how many words need no join
    frame = spark.createDataFrame(_rows(), "doc_id long, text string").repartition(3).withColumns(
        {c: F.lit(1) for c in ("key", "row", "words", "times", "word", "n", "score")})
    _check(spark, _rows(), score_language_model(frame).collect())


def test_a_long_text(spark):
    rng = random.Random(8)
    rows = [(1, " ".join(f"w{min(int(rng.paretovariate(0.7)), 10**6)}" for _ in range(60_000))), (2, "w1 w2"), (3, "w1 zzz")]
    _check(spark, rows, score_language_model(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_the_model_is_a_distribution(spark):
    model, counted = fit_class_model(spark.createDataFrame([(t,) for _, t in _rows()], "text string"))
    assert np.allclose((10.0 ** model.transitions).sum(1), 1)
    for c in range(ALL_CLASSES - 1):
        own = model.counts[model.classes == c]
        if len(own) or c >= CLASSES:
            assert math.isclose((own + 0.5).sum() + 0.5 * (c >= CLASSES), 10 ** model.wholes[c])
    assert counted.agg(F.sum("n")).first()[0] == model.tokens


def test_exchange_puts_words_that_are_used_alike_together_and_helps(spark):
    rng = random.Random(6)
    kinds = [[f"{letter}{k}x" for k in range(60)] for letter in "pqr"]
    texts = [(" ".join(rng.choice(kinds[j % 3]) for j in range(30)),) for _ in range(1500)]
    frame = spark.createDataFrame(texts, "text string")
    before, _ = fit_class_model(frame, rounds=0)
    after, _ = fit_class_model(frame)
    ids = _ids({w for kind in kinds for w in kind})
    group = {i: w[0] for w, i in ids.items()}

    def pure(model):
        held = collections.defaultdict(collections.Counter)
        for word, c in zip(model.words.tolist(), model.classes.tolist()):
            if word in group:
                held[c][group[word]] += 1
        return sum(max(kinds.values()) for kinds in held.values()) / len(ids)

    assert pure(before) < 0.7 and pure(after) > 0.95

    def scored(model):
        return sum(r["score"] for r in class_model.score_texts(
            frame.withColumn("doc_id", F.lit(1)), model, _, "doc_id", "text").collect())

    assert scored(after) > scored(before) and after.words.tolist() == before.words.tolist()


def test_the_best_class_is_that_of_all_likelihoods():
    rng = np.random.default_rng(5)
    units, sequence = 12, rng.integers(0, 12, 400)
    for _ in range(30):
        classes = rng.integers(0, 6, units)
        of = classes[sequence]

        def matrix(of):
            found = np.zeros((ALL_CLASSES, ALL_CLASSES))
            np.add.at(found, (np.concatenate([[ALL_CLASSES - 1], of]), np.concatenate([of, [ALL_CLASSES - 1]])), 1)
            return found

        word = int(rng.integers(units))
        pairs = list(zip([None, *sequence.tolist()], [*sequence.tolist(), None]))
        after, before = np.zeros(ALL_CLASSES), np.zeros(ALL_CLASSES)
        for a, b in pairs:
            if a == word and b != word:
                after[ALL_CLASSES - 1 if b is None else classes[b]] += 1
            if b == word and a != word:
                before[ALL_CLASSES - 1 if a is None else classes[a]] += 1
        chosen, gain = class_model.best_class(
            matrix(of), int(classes[word]), after, before, sum(p == (word, word) for p in pairs))
        worth = [class_model.likelihood(matrix(np.where(sequence == word, c, of))) for c in range(CLASSES)]
        assert math.isclose(worth[chosen], max(worth), rel_tol=1e-9)
        assert math.isclose(gain, worth[chosen] - worth[classes[word]], rel_tol=1e-6, abs_tol=1e-6)


def test_without_training_rows_and_empty_tables(spark):
    frame = spark.createDataFrame([(k, "a b") for k in range(100) if _held_out(k)], "doc_id long, text string")
    found = score_language_model(frame).collect()
    assert {(r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in found} == {(True, 3, 0, 0, 0.0)}
    assert all(r["score"] < 0 for r in found)
    assert score_language_model(frame.limit(0)).count() == 0


def test_held_out_texts_are_likelier_than_by_word_counts_alone(spark):
    found = score_language_model(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    assert all(r["score"] < 0 for r in found) and FORMS == 30 and END == 29
    for held in (True, False):
        own = [r for r in found if r["held_out"] == held]
        assert sum(r["score"] for r in own) > sum(r["base_score"] for r in own)
