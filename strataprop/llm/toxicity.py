"""Toxicity by logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataprop.functions.runtime import stage
from strataprop.llm.batches import arrow_function, bound_batches
from strataprop.llm.ftrl import Ftrl, probabilities
from strataprop.llm.words import NOT_ALNUM, Block, blocks, hash_ranges, mix, ngrams, text_of
from strataprop.operators.joins import equi_join

#: Hashed features: 2^20.
BITS = 20
#: Labelled rows to learn from, half of them of either class at most.
MAX_ROWS = 12_000
#: Features of a text to learn from; of more, those that come first by a hash. 200 MB for all rows at most.
MAX_FEATURES = 4096
EPOCHS, ALPHA, BETA, L1, L2 = 10, 2.0, 1.0, 4.0, 0.001


def bucket_of(key: Column, buckets: int) -> Column:
    """crc32 of the key as text, modulo ``buckets``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % buckets


def _features(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Feature and text of every word, pair of words, and pair with one word between."""
    starts, ends, bounds = block.ranges(NOT_ALNUM)
    hashes, text = hash_ranges(block.sums(fold=True), starts, ends), text_of(bounds)
    at, pairs = ngrams(hashes, bounds, 2)
    skips = np.flatnonzero(text[2:] == text[:-2])
    skipped = mix(hashes[skips] * np.uint64(3) + hashes[skips + 2] * np.uint64(7))
    every = np.concatenate([hashes, pairs, skipped]) >> np.uint64(64 - BITS)
    return every.astype(np.int64), np.concatenate([text, text[at], text[skips]])


def _bounded(features: np.ndarray) -> np.ndarray:
    if len(features) <= MAX_FEATURES:
        return features
    return np.sort(features[np.argsort(mix(features.astype(np.uint64)))[:MAX_FEATURES]])


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for block in blocks(batch.column(2)):
            features, text = _features(block)
            keys = np.unique((text << BITS) + features)
            edges = np.searchsorted(keys, np.arange(block.texts() + 1) << BITS)
            found += [_bounded((keys[a:b] & (1 << BITS) - 1).astype(np.int32)) for a, b in zip(edges, edges[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))],
            ["key", "target", "features"])


def fit_toxicity(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str,
                 max_rows: int = MAX_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """Features with a weight, their weights, and the bias.

    Of either class, ``max_rows / 2`` labelled keys of the table at most are taken, in the order of a hash. The
    bias is put back to the shares of the classes among all its labelled keys. A key labelled twice is toxic
    if any of its labels says so; labels other than 0 and 1, and of keys that the table does not have, are
    ignored. Of the texts of one key the one with the smallest hash is learnt from. If a class has no
    label, there are no weights, and the bias stands for the share of label 1, or for 1/2 without any label.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(
        F.col(key).alias("key")).agg(F.max(label).cast("int").alias("target"))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).filter(F.col("key").isNotNull())
    present = stage(equi_join(known, rows.select("key"), "key", "left_semi"))
    totals = {row["target"]: row["count"] for row in present.groupBy("target").count().collect()}
    if set(totals) != {0, 1}:
        return np.zeros(0, np.int64), np.zeros(0), {0: -np.inf, 1: np.inf}.get(next(iter(totals), None), 0.0)
    chosen = [present.filter(F.col("target") == c).orderBy(F.xxhash64("key"), "key").limit(max_rows // 2)
              for c in (0, 1)]
    picked = F.broadcast(chosen[0].union(chosen[1]))  # max_rows rows of 12 bytes at most
    one = F.min(F.struct(F.xxhash64("text").alias("place"), "text"))["text"].alias("text")
    texts = rows.join(picked, "key").groupBy("key", "target").agg(one)
    kind = rows.schema["key"].dataType.simpleString()
    found = texts.select("key", "target", "text").mapInArrow(
        arrow_function(_examples), f"key {kind}, target int, features array<int>")
    found = found.orderBy(F.xxhash64("key"), "key").toArrow()
    examples = [row.values.to_numpy() for row in found.column("features").combine_chunks()]
    model = Ftrl(1 << BITS, 1, ALPHA, BETA, L1, L2).fit(
        [(x, np.ones(len(x))) for x in examples], found.column("target").to_pylist(), EPOCHS)
    weights, bias = model.weights()
    used = np.flatnonzero(weights[:, 0])
    taken = [min(totals[c], max_rows // 2) / totals[c] for c in (0, 1)]
    return used, weights[used, 0], float(bias[0] + np.log(taken[0] / taken[1]))


def score_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                   label: str = "toxic", folds: int = 5, held_out: int = 0) -> DataFrame:
    """``held_out``, ``score`` (the probability of label 1) and ``predicted`` of every row.

    Learns from the labels of rows whose crc32 of the key, modulo ``folds``, is not ``held_out``. Only the
    text gives features: letters and digits in runs, A-Z lower-cased, each feature counted once a
    text. A null or empty text has the score of the bias alone. Every row is returned, repeated
    ones too; a null key counts as empty text for the fold and is never learnt from. If the labels of the
    table's rows have one class only, every score is the share of label 1, and 1/2 without any label. The
    result does not depend on how the rows are dealt out. An empty table gives no rows.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(key, text)
    kind = rows.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, score double, predicted int"
    learnt = labels.filter(bucket_of(F.col(key), folds) != held_out)
    used, weights, bias = fit_toxicity(docs, learnt, key, text, label)
    model = docs.sparkSession.sparkContext.broadcast((used, weights, bias))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, weights, bias = model.value
        table = np.zeros(1 << BITS)
        table[used] = weights
        for batch in batches:
            scores = [np.zeros(0)]
            for block in blocks(batch.column(1)):
                features, text = _features(block)
                hit = table[features] != 0
                once = np.unique((text[hit] << BITS) + features[hit])
                total = np.bincount(once >> BITS, table[once & (1 << BITS) - 1], block.texts())
                scores.append(probabilities((total + bias)[:, None])[:, 0])
            scores = np.concatenate(scores)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                [key, "score", "predicted"])

    return rows.mapInArrow(arrow_function(score), schema).select(
        key, (bucket_of(F.col(key), folds) == held_out).alias("held_out"), "score", "predicted")
