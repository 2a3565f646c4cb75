"""Phrase collocation: frequent phrases and how much oftener they occur than their parts would suggest.

Words are counted by Spark and ranked by frequency. A word's rank is its address: pairs of neighbouring
words are split into square tiles of ranks. A tile with many of a batch's pairs is counted in a dense array,
the others as sorted coordinates with run lengths; Spark adds the batches' counts up. Frequent pairs are
ranked in turn and take the place of the left word, which counts phrases of three words, and so on.

The ranks that every task gets are those of the most frequent words or phrases, a fixed number. All others that are
frequent enough to matter are addressed by their hash, and looked for through a filter of fixed size:
no phrase is left out, whatever the vocabulary. A phrase is only counted where its first and its last words
but one are frequent phrases themselves, since it cannot be more frequent than they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataprop.functions.runtime import shuffle_partitions, stage
from strataprop.llm.batches import arrow_function, bound_batches
from strataprop.llm.vectors import FILTER_BITS, marked, marks
from strataprop.llm.words import Block, blocks, hash_ranges, mix, range_strings, text_of
from strataprop.operators.joins import equi_join

MIN_COUNT, MAX_WORDS, TOP, COVER_PERCENT = 10, 3, 2000, 50
UNDETERMINED = "und"
#: Words or phrases that have an address: 2^18 at most. A tile has 2^9 of them on either side.
ADDRESS_BITS, TILE_BITS = 18, 9
#: A tile is counted in a dense array from this share of its cells on.
DENSE_SHARE = 1 / 8
#: Scores are shares of one million.
SCALE = 1_000_000

_PIECE_END = np.zeros(256, bool)
_PIECE_END[[*b".,;:!?", 10, 11, 12, 13]] = True
_SEPARATOR = _PIECE_END.copy()
_SEPARATOR[[32, 9]] = True
#: Set in every hash, so that a hash, as a signed number, is never an address.
_HASH = np.uint64(1 << 63)


class Words(NamedTuple):
    """The words of a block: ranges, hash of word and language, text, and whether the next is in the same piece."""

    starts: np.ndarray
    ends: np.ndarray
    keys: np.ndarray
    text: np.ndarray
    linked: np.ndarray


def _words(block: Block, languages: np.ndarray) -> Words:
    """``languages``: the hash of each text's language."""
    starts, ends, bounds = block.ranges(_SEPARATOR)
    text = text_of(bounds)
    keys = word_keys(hash_ranges(block.sums(fold=True), starts, ends), languages[text])
    pieces = np.zeros(len(block.data) + 1, np.int64)
    np.cumsum(_PIECE_END[block.data], out=pieces[1:])
    linked = np.zeros(len(starts), bool)
    linked[:-1] = (text[1:] == text[:-1]) & (pieces[starts[1:]] == pieces[ends[:-1]])
    return Words(starts, ends, keys, text, linked)


def word_keys(words: np.ndarray, languages: np.ndarray) -> np.ndarray:
    return mix(words + mix(languages.view(np.uint64) + np.uint64(1))) | _HASH


def _pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of two references in their order."""
    return mix(mix(left.view(np.uint64)) + right.view(np.uint64) * np.uint64(3)) | _HASH


def count_pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different pairs of addresses and how often each occurs."""
    side, cells = 1 << TILE_BITS, 1 << 2 * TILE_BITS
    tile = (left >> TILE_BITS << TILE_BITS) + (right >> TILE_BITS)
    tiles, held = np.unique(tile, return_counts=True)
    dense = tiles[held >= cells * DENSE_SHARE]
    found = []
    for number in dense:
        own = tile == number
        counts = np.bincount(((left[own] & side - 1) << TILE_BITS) + (right[own] & side - 1), minlength=cells)
        cell = np.flatnonzero(counts)
        found.append((((number >> TILE_BITS) << TILE_BITS) + (cell >> TILE_BITS),
                      ((number & side - 1) << TILE_BITS) + (cell & side - 1), counts[cell]))
    rest = ~np.isin(tile, dense)
    places, counts = np.unique((left[rest] << ADDRESS_BITS) + right[rest], return_counts=True)
    found.append((places >> ADDRESS_BITS, places & (1 << ADDRESS_BITS) - 1, counts))
    return tuple(np.concatenate(parts) for parts in zip(*found))


class Dictionary(NamedTuple):
    """Frequent words or phrases by hash: the address of the most frequent, a filter for all others."""

    keys: np.ndarray  # ascending
    addresses: np.ndarray
    others: np.ndarray

    def references(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Address or hash of each, and whether it is frequent (or, by chance, only taken for so)."""
        known = np.zeros(len(keys), bool)
        found = keys.view(np.int64).copy()
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            known = self.keys[at] == keys
            found[known] = self.addresses[at[known]]
        return found, known | marked(self.others, keys << np.uint64(1))


def _dictionary(counted: DataFrame) -> Dictionary:
    """Of ``key`` and ``n``. Steps of a sixteenth of a doubling of ``n`` decide who has an address."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 16)
    sizes = counted.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()  # 1024 at most
    room, least = 1 << ADDRESS_BITS, None
    for row in sizes:
        room -= row["count"]
        if room < 0:
            break
        least = row["step"]
    if least is None:  # none, or too many equally frequent ones
        head, others = counted.limit(0), counted
    else:
        head, others = counted.filter(step >= least), counted.filter(step < least)
    table = head.select("key", "n").toArrow()
    keys, n = table.column("key").to_numpy().view(np.uint64), table.column("n").to_numpy()
    ranked = np.lexsort((keys, -n))
    address = np.empty(len(keys), np.int64)
    address[ranked] = np.arange(len(keys))
    order = np.argsort(keys)
    bits = marks(others.select(F.shiftleft("key", 1).alias("key"))) if room < 0 else np.zeros(1 << FILTER_BITS - 3, np.uint8)
    return Dictionary(keys[order], address[order], bits)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different words of a batch by language, and each language's words together under a null word."""
    for batch in batches:
        languages = batch.column(1).to_numpy(zero_copy_only=False)
        keys, counts, rows, words = [], [], [], []
        total = np.zeros(len(batch), np.int64)
        for block in blocks(batch.column(2)):
            own = _words(block, languages[block.first : block.first + block.texts()])
            found, first, n = np.unique(own.keys, return_index=True, return_counts=True)
            keys.append(found)
            counts.append(n)
            rows.append(block.first + own.text[first])
            words.append(range_strings(block.data, own.starts[first], own.ends[first], fold=True))
            total[block.first : block.first + block.texts()] = np.bincount(own.text, minlength=block.texts())
        if not keys:
            continue
        _, first, which = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        n = np.bincount(which, np.concatenate(counts), len(first)).astype(np.int64)
        _, speaker, spoken = np.unique(languages, return_index=True, return_inverse=True)
        whole = np.bincount(spoken, total, len(speaker)).astype(np.int64)
        row = pa.array(np.concatenate([np.concatenate(rows)[first], speaker]))
        word = pa.concat_arrays([pa.concat_arrays(words).take(pa.array(first)), pa.nulls(len(speaker), pa.string())])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(row), word, pa.array(np.concatenate([n, whole]))], ["lang", "word", "n"])


def _phrase_counts(dictionaries: list[Dictionary], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each phrase of a batch has one word more than the phrases of the last dictionary."""
    for batch in batches:
        languages = batch.column(0).to_numpy(zero_copy_only=False)
        lefts, rights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for block in blocks(batch.column(1)):
            own = _words(block, languages[block.first : block.first + block.texts()])
            word, frequent = dictionaries[0].references(own.keys)
            phrase, held = word.copy(), frequent.copy()
            for width in range(1, len(dictionaries) + 1):
                # where a phrase of this width goes on with a frequent word, and its end is frequent too
                last = len(word) - width
                on = held[:max(last, 0)] & held[1 : max(last, 0) + 1]
                on &= own.linked[width - 1 : len(word) - 1][:len(on)] & frequent[width:]
                at = np.flatnonzero(on)
                if width == len(dictionaries):
                    lefts.append(phrase[at])
                    rights.append(word[at + width])
                    break
                found, known = dictionaries[width].references(_pair_keys(phrase[at], word[at + width]))
                held = np.zeros(len(word), bool)
                held[at], phrase[at] = known, found
        left, right = np.concatenate(lefts), np.concatenate(rights)
        placed = (left >= 0) & (right >= 0)
        parts = [count_pairs(left[placed], right[placed])]
        far_left, far_right = left[~placed], right[~placed]
        _, first, n = np.unique(_pair_keys(far_left, far_right), return_index=True, return_counts=True)
        parts.append((far_left[first], far_right[first], n))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(column)) for column in zip(*parts)], ["left", "right", "n"])


def _with_references(level: DataFrame, dictionary: Dictionary) -> DataFrame:
    shared = level.sparkSession.sparkContext.broadcast(dictionary)

    @F.arrow_udf("long")
    def reference(keys: pa.Array) -> pa.Array:
        return pa.array(shared.value.references(keys.to_numpy(zero_copy_only=False).view(np.uint64))[0])

    referred = stage(level.withColumn("ref", reference("key")))
    shared.destroy()
    return referred


def _keys_of_words() -> Column:
    @F.arrow_udf("long")
    def key(languages: pa.Array, words: pa.Array) -> pa.Array:
        hashes = [np.zeros(0, np.uint64)]
        for block in blocks(words):
            hashes.append(hash_ranges(block.sums(), block.bounds[:-1], block.bounds[1:]))
        languages = languages.to_numpy(zero_copy_only=False)
        return pa.array(word_keys(np.concatenate(hashes), languages).view(np.int64))

    return key(F.xxhash64("lang"), F.col("word"))


def _keys_of_pairs() -> Column:
    @F.arrow_udf("long")
    def key(left: pa.Array, right: pa.Array) -> pa.Array:
        return pa.array(_pair_keys(left.to_numpy(zero_copy_only=False), right.to_numpy(zero_copy_only=False)).view(np.int64))

    return key("left", "right")


def _scored(phrases: DataFrame, known: DataFrame, cover_percent: int) -> DataFrame:
    """``a``, ``l``, ``r`` and ``score`` of the phrases that no longer one covers."""
    width = F.size("refs")
    cuts = phrases.select("refs", "lang", "phrase", F.col("n").alias("a"), F.explode(
        F.sequence(F.lit(1), width - 1)).alias("cut")).select(
        "*", F.slice("refs", F.lit(1), F.col("cut")).alias("first"),
        F.slice("refs", F.col("cut") + 1, F.size("refs")).alias("rest")).drop("refs")
    cuts = equi_join(cuts, known.select(F.col("refs").alias("first"), F.col("n").alias("l")), "first", "inner")
    cuts = equi_join(cuts, known.select(F.col("refs").alias("rest"), F.col("n").alias("r")), "rest", "inner")
    a, l, r = (f"cast({c} as decimal(15,0))" for c in "alr")
    score = F.expr(f"({SCALE} * {a} * {a}) div ({l} * {r})")  # no product has more than 38 digits
    lowest = cuts.groupBy("lang", "phrase", "a").agg(
        F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("low"))

    def inside(words: Column) -> Column:
        """All shorter phrases of two words or more within one."""
        return F.flatten(F.transform(F.sequence(F.lit(2), F.size(words) - 1), lambda m: F.transform(
            F.sequence(F.lit(1), F.size(words) - m + 1), lambda at: F.slice(words, at, m))))

    longer = phrases.filter(width > 2).select(F.col("n").alias("around"), F.explode(inside(F.col("refs"))).alias("refs"))
    around = longer.groupBy("refs").agg(F.max("around").alias("around"))
    covered = equi_join(phrases.select("refs", "lang", "phrase", "n"), around, "refs", "inner").filter(
        100 * F.col("around") >= cover_percent * F.col("n")).select("lang", "phrase")
    return equi_join(lowest, covered, ["lang", "phrase"], "left_anti").select(
        "lang", "phrase", "a", "low.l", "low.r", "low.score")


def mine_phrases(
    docs: DataFrame, text: str = "text", language: str = "lang", min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS, top: int = TOP, cover_percent: int = COVER_PERCENT,
) -> DataFrame:
    """Each language's best phrases of two to ``max_words`` words: ``lang, rank, phrase, a, l, r, n, score``.

    A-Z count as a-z; texts are split at ``.,;:!?`` and line ends into pieces, these at spaces and tabs into words.
    ``a`` is how often the phrase occurs within pieces, overlaps included, ``min_count`` times at least. Cut in
    two after some word, its parts occur ``l`` and ``r`` times, and the score is floor(10^6 a^2 / (l r)); the cut
    with the lowest score counts, of equals the first. A phrase inside a longer one that occurs
    ``cover_percent`` hundredths as often or more is left out. The first ``top`` by score and ``a``, largest
    first, then by the phrase's bytes, are returned; ``n`` is the number of words of the language. A null
    language is ``und``; a null or empty text has no words; repeated rows count as often as they occur; a language
    without a phrase, or an empty table, gives no rows. Counts up to 10^15 are exact. Runs jobs when called.
    """
    if min_count < 1 or max_words < 2:
        raise ValueError("phrases need two words and one occurrence or more")
    bound_batches(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.coalesce(F.col(language).cast("string"), F.lit(UNDETERMINED)).alias("lang"),
                       F.col(text).alias("text")).filter(F.col("text").isNotNull())
    hashed = rows.select("lang", F.xxhash64("lang").alias("hash"), "text")
    counts = hashed.mapInArrow(arrow_function(_word_counts), "lang string, word string, n long").groupBy(
        "lang", "word").agg(F.sum("n").alias("n"))
    counted = stage(counts.filter((F.col("n") >= min_count) | F.col("word").isNull()))
    totals = counted.filter(F.col("word").isNull()).select("lang", "n")
    keyed = stage(counted.filter(F.col("word").isNotNull()).select(
        "lang", F.col("word").alias("phrase"), "n", _keys_of_words().alias("key")))
    dictionaries = [_dictionary(keyed)]
    words = _with_references(keyed, dictionaries[0]).select("lang", "phrase", F.array("ref").alias("refs"), "n", "ref")
    levels = [words]
    for width in range(2, max_words + 1):
        shared = context.broadcast(dictionaries)

        def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            yield from _phrase_counts(shared.value, batches)

        found = hashed.select("hash", "text").mapInArrow(arrow_function(count), "left long, right long, n long")
        frequent = stage(found.groupBy("left", "right").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count))
        shared.destroy()
        left = levels[-1].select(F.col("ref").alias("left"), "lang", F.col("phrase").alias("before"), F.col("refs").alias("head"))
        right = words.select(F.col("ref").alias("right"), F.col("phrase").alias("word"))
        named = equi_join(equi_join(frequent, left, "left", "inner"), right, "right", "inner").select(
            "lang", F.concat_ws(" ", "before", "word").alias("phrase"),
            F.concat("head", F.array("right")).alias("refs"), "n", "left", "right")
        if width == max_words:
            levels.append(stage(named.drop("left", "right")))
            break
        keyed = stage(named.withColumn("key", _keys_of_pairs()).drop("left", "right"))
        dictionaries.append(_dictionary(keyed))
        levels.append(_with_references(keyed, dictionaries[-1]).drop("key"))

    def together(parts: list[DataFrame]) -> DataFrame:
        whole = parts[0].select("lang", "phrase", "refs", "n")
        for part in parts[1:]:
            whole = whole.union(part.select(whole.columns))
        return whole

    scored = stage(_scored(together(levels[1:]), together(levels[:-1]), cover_percent))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each part of a language first, so that no task ranks a whole language
    part = F.pmod(F.xxhash64("phrase"), F.lit(shuffle_partitions(docs.sparkSession)))
    best = scored.withColumn("part", part).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(
        F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
