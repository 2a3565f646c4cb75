"""Test items inside training texts: rare n-gram seeds, then Smith-Waterman alignment of words.

Seeds are the n-grams of the test items: three words in a row, or with one left out between them, and longer
runs. All texts are searched for them through a filter of fixed size. How many different pairs of words stand
around a seed in the texts says how common it is: a phrase of the language stands in ever new places, while
copies of an item, however many, put it between the same words. Seeds that are rare, and the rarest of each item,
join texts to items; a text and an item are aligned word by word around them, which finds edited copies too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataprop.functions.runtime import stage
from strataprop.llm.batches import arrow_function, bound_batches
from strataprop.llm.vectors import marked, marks
from strataprop.llm.words import NOT_ALNUM, blocks, hash_ranges, mix, text_of
from strataprop.operators.joins import equi_join

#: Words of a seed, by their distance from its first. The first two are only for items of one and two words.
SHAPES = ((0,), (0, 1), (0, 1, 2), (0, 1, 3), (0, 2, 3), tuple(range(6)), tuple(range(12)))
#: A seed is rare up to this many different places in the texts, times the items that have it.
RARE = 1000
#: Points of the alignment for an equal word, another word, and a word left out on one side.
MATCH, MISMATCH, GAP = 2, -1, -1
#: Share of the highest possible score from which on a text counts as a copy of an item.
MIN_SCORE = 0.5

_STEPS = np.random.default_rng(271828).integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SECOND = np.uint64(0x5851F42D4C957F2D)


def _word_hashes(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, word hashes and each text's bounds, block by block."""
    for block in blocks(column):
        starts, ends, bounds = block.ranges(NOT_ALNUM)
        yield block.first, hash_ranges(block.sums(fold=True), starts, ends).view(np.int64), bounds


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the text, the last column, by its word hashes."""
    for batch in batches:
        words = [hashes[a:b] for _, hashes, bounds in _word_hashes(batch.columns[-1])
                 for a, b in zip(bounds, bounds[1:])]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(words, pa.list_(pa.int64()))], [*batch.schema.names[:-1], "words"])


def _shapes_of(words: int) -> list[int]:
    """Numbers of the shapes that seeds of an item of so many words have."""
    if words < 3:
        return [words - 1] if words else []
    return [k for k, shape in enumerate(SHAPES) if k > 1 and shape[-1] < words]


def grams(hashes: np.ndarray, text: np.ndarray, shape: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every n-gram of a shape inside one text; ``text`` numbers the text of each word."""
    span = SHAPES[shape][-1] + 1
    windows = max(len(hashes) - span + 1, 0)
    total = np.zeros(windows, np.uint64)
    for k, at in enumerate(SHAPES[shape]):
        total += hashes[at : at + windows] * _STEPS[k]
    starts = np.flatnonzero(text[span - 1 :] == text[:windows])
    return starts, mix(total[starts] + np.uint64(shape + 1))


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, words in zip(batch.column(0), batch.column(1)):
            hashes = words.values.to_numpy().view(np.uint64)
            for shape in _shapes_of(len(hashes)):
                at, found = grams(hashes, np.zeros(len(hashes), np.int64), shape)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item.as_py()] * len(at), batch.schema.field(0).type), pa.array(found.view(np.int64)),
                     pa.array(mix(found ^ _SECOND).view(np.int64)), pa.array(at),
                     pa.array([len(hashes)] * len(at), pa.int64())],
                    ["item", "gram", "second", "item_at", "item_words"])


def rare_seeds(seeds: DataFrame, hits: DataFrame) -> DataFrame:
    """The seeds that join texts to items: the rare ones, and of each item the rarest, wherever that stands.

    A seed's meetings are the different ``context`` it has in ``hits``, times the items that have it, a
    bound for the alignments it leads to but for those of equal copies.
    """
    places = hits.select("gram", "context").distinct().groupBy("gram").agg(F.count("context").alias("places"))
    owners = seeds.select("gram", "item").distinct().groupBy("gram").agg(F.count("item").alias("owners"))
    known = seeds.drop("second").join(owners, "gram").join(places, "gram", "left").withColumn(
        "meetings", F.coalesce(F.col("places") * F.col("owners"), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("item").orderBy("meetings", "item_at", "gram"))
    return known.withColumn("place", place).filter(
        ((F.col("meetings") <= RARE) | (F.col("place") == 1)) & (F.col("meetings") > 0)).select(
        "item", "gram", "item_at", "item_words")


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two word sequences: its score, and the first and end word in ``text``.

    Row by row; with one price for every left-out word, runs of them are a running maximum. The first
    word is where the best alignment of the reversed sequences, cut at the end word, ends.
    """
    score, end = _best(item, text)
    _, back = _best(item[::-1], text[:end][::-1])
    return score, end - back, end


def _best(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    steps = np.arange(len(text) + 1) * -GAP
    above = np.zeros(len(text) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        row = np.maximum(above + GAP, 0)
        row[1:] = np.maximum(row[1:], above[:-1] + np.where(text == word, MATCH, MISMATCH))
        above = np.maximum.accumulate(row + steps) - steps
        k = int(above.argmax())
        if above[k] > best:
            best, end = int(above[k]), k
    return best, end


def find_contamination(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", min_score: float = MIN_SCORE,
) -> DataFrame:
    """Pairs of a row and a test item of which it holds a copy, edited or not.

    Columns: both keys, ``score`` (the alignment's points as a share of the item's highest possible),
    ``first_word`` and ``end_word`` (the aligned part of the text; words are runs of letters and digits).
    One row for each pair at ``min_score`` or above that shares a seed: the best alignment, the earliest of
    equals. A seed is three words of the item in a row, or of four the first two and the last or the first and the
    last two, so that a copy with every third word replaced still has some; seeds that are common phrases of the
    texts do not count, but for longer runs around them. A whole copy of an item always has one that counts. Items
    of one or two words are found where they stand as they are. Null or empty texts and items match
    nothing. Rows repeated with one key give one pair; rows with a null key are reported under a null key. Items of
    equal text each give pairs; items repeated with one key and text count once. Empty tables give no rows.
    """
    bound_batches(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.xxhash64(key, text).alias("row"), F.col(key).alias("key"), F.col(text).alias("text"))
    kind, item_kind = (df.schema[c].dataType.simpleString() for df, c in ((docs, key), (items, item_key)))
    wanted = items.select(F.xxhash64(item_key, item_text).alias("item"), F.col(item_key).alias("item_key"),
                          F.col(item_text).alias("text")).dropDuplicates(["item"])
    item_words = stage(wanted.mapInArrow(arrow_function(_words), f"item long, item_key {item_kind}, words array<long>"))
    seeds = stage(item_words.select("item", "words").mapInArrow(
        arrow_function(_seeds), "item long, gram long, second long, item_at long, item_words long"))
    size = F.size("words")
    sizes = item_words.agg(F.max(size).alias("most"), F.count_if(size == 1).alias("one"), F.count_if(size == 2).alias("two")).first()
    shapes = sorted({*_shapes_of(sizes["most"] or 0), *([0] if sizes["one"] else []), *([1] if sizes["two"] else [])})
    both = seeds.select(F.explode(F.array("gram", "second")).alias("gram"))
    filter_bits = context.broadcast(marks(both))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = filter_bits.value
        for batch in batches:
            row = batch.column(0).to_numpy()
            for first, hashes, bounds in _word_hashes(batch.column(1)):
                hashes, text = hashes.view(np.uint64), text_of(bounds)
                beside = np.zeros(len(hashes) + 2, np.uint64)  # the word before each, 0 at a text's edges
                beside[1:-1] = hashes
                for shape in shapes:
                    at, found = grams(hashes, text, shape)
                    hit = marked(bits, found)
                    hit[hit] = marked(bits, mix(found[hit] ^ _SECOND))
                    at, found = at[hit], found[hit].view(np.int64)
                    own, end = text[at], at + SHAPES[shape][-1] + 1
                    before = np.where(at > bounds[own], beside[at], np.uint64(0))
                    after = np.where(end < bounds[own + 1], beside[end + 1], np.uint64(0))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row[first + own]), pa.array(found), pa.array(at - bounds[own]),
                         pa.array(mix(before * np.uint64(3) ^ after).view(np.int64))], ["row", "gram", "at", "context"])

    hits = stage(rows.select("row", "text").mapInArrow(arrow_function(search), "row long, gram long, at long, context long"))
    filter_bits.destroy()
    kept = stage(rare_seeds(seeds, hits))
    # one window for hits on nearby diagonals; an item's copy is never longer than a few items
    near = equi_join(hits.drop("context"), kept, "gram", "inner").withColumn(
        "band", F.floor((F.col("at") - F.col("item_at")) / F.col("item_words")))
    candidates = stage(near.groupBy("row", "item", "band").agg(
        F.greatest(F.min(F.col("at") - F.col("item_at") - F.col("item_words")), F.lit(0)).alias("low"),
        F.max(F.col("at") - F.col("item_at") + 2 * F.col("item_words")).alias("high")))

    row_bits = context.broadcast(marks(candidates.select("row").distinct()))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _words([batch.filter(pa.array(marked(row_bits.value, batch.column(0).to_numpy())))])

    words = rows.mapInArrow(arrow_function(keep), f"row long, key {kind}, words array<long>")
    part = F.slice("words", (F.col("low") + 1).cast("int"), (F.col("high") - F.col("low")).cast("int"))
    # written, so that no task runs two Python functions at once
    passages = stage(words.join(candidates, "row").select("key", "item", "low", part.alias("part")))
    row_bits.destroy()
    pairs = equi_join(passages, item_words, "item", "inner").select("key", "item_key", "low", "part", "words")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, kept = batch.column(2).to_numpy(), []
            shares, firsts, ends = [], [], []
            for k, (at, passage, item) in enumerate(zip(low, batch.column(3), batch.column(4))):
                item, passage = item.values.to_numpy(), passage.values.to_numpy()
                # no alignment has more points than the item's words in the passage are worth
                if np.isin(item, passage).sum() / len(item) < min_score:
                    continue
                points, first, end = align(item, passage)
                kept.append(k)
                shares.append(points / (MATCH * len(item)))
                firsts.append(at + first)
                ends.append(at + end)
            kept = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(kept), batch.column(1).take(kept), pa.array(shares, pa.float64()), pa.array(firsts, pa.int64()),
                 pa.array(ends, pa.int64())], ["key", "item_key", "score", "first_word", "end_word"])

    aligned = pairs.mapInArrow(arrow_function(score), f"key {kind}, item_key {item_kind}, score double, first_word long, end_word long")
    best = F.max_by(F.struct("score", "first_word", "end_word"), F.struct("score", -F.col("first_word"))).alias("best")
    return aligned.filter(F.col("score") >= min_score).groupBy("key", "item_key").agg(best).select(
        F.col("key").alias(key), F.col("item_key").alias(item_key), "best.*")
