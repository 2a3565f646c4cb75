"""Language by sparse multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataprop.llm.batches import arrow_function, bound_batches, give_back
from strataprop.llm.ftrl import Ftrl, probabilities, temperature
from strataprop.llm.toxicity import bucket_of
from strataprop.llm.vectors import SCHEMA as VECTOR_SCHEMA
from strataprop.llm.vectors import combined, vector_rows
from strataprop.llm.words import Block, blocks, mix

UNDETERMINED = "und"
#: Hashed features (2^16), and the lengths of the n-grams in code points.
BITS, LENGTHS = 16, (1, 2, 3)
#: Labelled rows to learn from, shared evenly by the languages; a fifth of them calibrates.
MAX_ROWS = 2400
#: Languages at most: each has a column of weights on every worker.
MAX_LANGUAGES = 500
#: Term shares are small numbers; this brings typical feature values near one.
SCALE = 20.0
EPOCHS, ALPHA, BETA, L1, L2 = 4, 0.5, 1.0, 0.05, 0.01

_STEPS = np.random.default_rng(31337).integers(0, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray  # per feature and language, inverse document frequency and scale included
    bias: np.ndarray
    temperature: float


def _points(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded code points of all texts, each text's bounds in them, and which texts have a letter.

    A-Z and Latin-1 capitals become small; ASCII characters that are no letters become spaces.
    """
    lead = np.zeros(len(block.data) + 1, np.int64)
    np.cumsum((block.data & 0xC0) != 0x80, out=lead[1:])
    text = block.data.tobytes().decode("utf-8")
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).copy()
    bounds = lead[block.bounds]
    capital = (points - 65 < 26) | ((points - 0xC0 < 0x1F) & (points != 0xD7))
    points[capital] += 32
    letter = points - 97 < 26
    points[~letter & (points < 128)] = 32
    far = np.flatnonzero(points >= 128)
    kinds, which = np.unique(points[far], return_inverse=True)
    letter[far] = np.array([chr(c).isalpha() for c in kinds], bool)[which] if len(far) else False
    upto = np.concatenate([[0], np.cumsum(letter)])
    return points.astype(np.uint64), bounds, upto[bounds[1:]] > upto[bounds[:-1]]


def _features(points: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The feature of each n-gram inside one text, and each text's bounds in them."""
    windows = len(points) - n + 1
    if windows <= 0:
        return np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    total = points[:windows] * _STEPS[0]
    for j in range(1, n):
        total += points[j : j + windows] * _STEPS[j]
    total = mix(total + np.uint64(n))
    total >>= np.uint64(64 - BITS)
    counts = np.maximum(np.diff(bounds) - n + 1, 0)
    own = np.concatenate([[0], np.cumsum(counts)])
    if n > 1:
        inside = np.ones(windows, bool)
        for edge in bounds[1:-1]:
            inside[max(0, edge - n + 1) : min(edge, windows)] = False
        total = total[inside]
    return total.astype(np.int64), own


def _per_text(block: Block) -> Iterator[np.ndarray]:
    """Each text's features, all lengths together."""
    points, bounds, _ = _points(block)
    grams = [_features(points, bounds, n) for n in LENGTHS]
    for k in range(block.texts()):
        yield np.concatenate([features[own[k] : own[k + 1]] for features, own in grams])


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << BITS, np.uint32)
    for batch in batches:
        for block in blocks(batch.column(0)):
            for features in _per_text(block):
                seen = np.zeros(1 << BITS, bool)
                seen[features] = True
                counts += seen
    yield from vector_rows(TaskContext.get().partitionId(), counts)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, counts = [], []
        for block in blocks(batch.column(2)):
            for features in _per_text(block):
                own, n = np.unique(features, return_counts=True)
                ids.append(own.astype(np.int32))
                counts.append(n.astype(np.int32))
        ints = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(ids, ints), pa.array(counts, ints)],
            ["place", "language", "features", "counts"])


def fit_language(docs: DataFrame, text: str, language: str, max_rows: int = MAX_ROWS) -> Model | None:
    """Learn from the text and language of all given rows; None if no row has both.

    Document frequencies cover all rows. The weights come from ``max_rows`` different texts at most (one
    for each language at least), an even share for each language however often its texts are repeated,
    in the order of a hash of the text; every fifth of them sets the temperature, which is 1 with fewer than five.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(text).alias("text"), F.col(language).cast("string").alias("language"))
    labelled = rows.filter(F.col("language").isNotNull() & F.col("text").rlike(r"\p{L}"))
    name = F.xxhash64("text", F.lit(17))
    # copies count once: hashes meet by language and hash, then counts by language
    totals = labelled.select("language", name.alias("name")).distinct().groupBy("language").count().limit(
        MAX_LANGUAGES + 1).collect()
    if len(totals) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not totals:
        return None
    languages = sorted(row["language"] for row in totals)
    share = max(1, max_rows // len(languages))
    place = F.shiftrightunsigned(name, 11) / F.lit(float(1 << 53))
    # enough for a full share but by a chance of one in thousands; the rank cuts what is more
    wanted = share + 4 * math.sqrt(share) + 8
    limit = F.create_map(*[F.lit(x) for row in totals for x in (row["language"], min(1.0, wanted / row["count"]))])
    picked = (labelled.withColumn("place", place).filter(F.col("place") < limit[F.col("language")])
              .select("place", "language", "text").distinct())
    ranked = picked.withColumn("rank", F.row_number().over(Window.partitionBy("language").orderBy("place", "text")))
    found = ranked.filter(F.col("rank") <= share).select("place", "language", "text").mapInArrow(
        arrow_function(_examples), "place double, language string, features array<int>, counts array<int>")
    found = found.orderBy("place", "language").toArrow()

    counts = combined(rows.select("text").mapInArrow(arrow_function(_document_counts), VECTOR_SCHEMA), 1 << BITS, np.uint32)
    documents = rows.count()
    idf = SCALE * np.log((1 + documents) / (1 + counts))
    number = {name: k for k, name in enumerate(languages)}
    targets = np.array([number[name] for name in found.column("language").to_pylist()])
    examples = []
    for ids, times in zip(found.column("features").combine_chunks(), found.column("counts").combine_chunks()):
        ids, times = ids.values.to_numpy(), times.values.to_numpy()
        examples.append((ids, times / times.sum() * idf[ids]))
    if len(languages) == 1:
        return Model(languages, np.zeros((1 << BITS, 1)), np.zeros(1), 1.0)
    held = np.arange(len(examples)) % 5 == 4
    model = Ftrl(1 << BITS, len(languages), ALPHA, BETA, L1, L2).fit(
        [x for x, h in zip(examples, held) if not h], targets[~held], EPOCHS)
    weights, bias = model.weights()
    scores = np.array([x @ weights[ids] + bias for (ids, x), h in zip(examples, held) if h])
    # float32 halves what each worker holds: 2^16 numbers for each language
    return Model(languages, (weights * idf[:, None]).astype(np.float32), bias,
                 temperature(scores, targets[held]) if held.any() else 1.0)


def _judge(model: Model | None, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Language (as an object array) and calibrated probability of each text."""
    names, scores = [np.zeros(0, object)], [np.zeros(0)]
    for block in blocks(column):
        points, bounds, lettered = _points(block)
        if model is None:
            names.append(np.full(block.texts(), UNDETERMINED, object))
            scores.append(np.zeros(block.texts()))
            continue
        total, sizes = np.zeros((block.texts(), len(model.languages))), np.zeros(block.texts())
        for n in LENGTHS:
            features, own = _features(points, bounds, n)
            some = np.flatnonzero(np.diff(own))
            sizes += np.diff(own)
            for k in range(total.shape[1] if len(some) else 0):
                weights = model.weights[features, k].astype(np.float64)
                total[some, k] += np.add.reduceat(weights, own[some])
        logits = (total / np.maximum(sizes, 1)[:, None] + model.bias) / model.temperature
        p = probabilities(logits) if total.shape[1] > 1 else np.ones_like(total)
        best = p.argmax(axis=1)
        names.append(np.where(lettered, np.array(model.languages, object)[best], UNDETERMINED))
        scores.append(np.where(lettered, p[np.arange(len(p)), best], 0.0))
    return np.concatenate(names), np.concatenate(scores)


def predict_language(docs: DataFrame, model: Model | None, key: str, text: str) -> DataFrame:
    """``lang_pred`` and ``score`` of every row under a fitted model."""
    rows = docs.select(key, text)
    kind = rows.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = _judge(shared.value, batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores)], [key, "lang_pred", "score"])

    return rows.mapInArrow(arrow_function(predict), f"`{key}` {kind}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model | None, text: str, min_score: float) -> DataFrame:
    """The rows, with all their columns, whose text has a language of probability ``min_score`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def identified(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for texts in batches:
                names, scores = _judge(shared.value, texts)
                yield pa.array((names != UNDETERMINED) & (scores >= min_score), pa.bool_())
        finally:
            give_back()

    return docs.filter(identified(docs[text]))


def training_rows(docs: DataFrame, key: str, language: str, folds: int, held_out: int) -> DataFrame:
    return docs.filter((bucket_of(F.col(key), folds) != held_out) & F.col(language).isNotNull())


def identify_language(docs: DataFrame, key: str = "doc_id", text: str = "text", language: str = "lang",
                      folds: int = 4, held_out: int = 2) -> DataFrame:
    """``held_out``, ``lang_pred`` and ``score`` (its calibrated probability) of every row.

    Learns from rows whose crc32 of the key, modulo ``folds``, is not ``held_out`` and whose language is
    not null; predicts from the text alone. A text that is null or has no letter is ``und`` with score
    0, and so is every row when nothing can be learnt. A null key counts as empty text for the
    fold. Where only one language can be learnt, every text with a letter has it, with score 1. Ties go to the first
    language by name. Every row is returned, repeated ones too; an
    empty table gives no rows; other columns are not carried.
    """
    model = fit_language(training_rows(docs, key, language, folds, held_out), text, language)
    held = (bucket_of(F.col(key), folds) == held_out).alias("held_out")
    return predict_language(docs, model, key, text).select(key, held, "lang_pred", "score")
