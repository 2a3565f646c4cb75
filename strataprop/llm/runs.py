"""Periodic runs: stretches of words that repeat with a period, at least twice over.

A text's suffixes are united into classes by descending length of their common prefixes, as Kruskal's
method takes edges: neighbours in the suffix array, longest common prefix first. A class keeps its
positions in order. Where two classes meet, positions i < j that become neighbours and lie no further
apart than their common prefix is long are the seed of a run: words i to j + prefix have period j - i,
the smallest there is, since a smaller one would have put a position between them. The prefix ends where
the run ends, and the first position of a run is always a seed, so seeds of one period and end are one run.

Only words inside n-grams that occur twice in their text can be part of a run. All others are left out
before the suffixes are sorted, so a text without repeats costs one look at its n-grams.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataprop.llm.batches import arrow_function, bound_batches
from strataprop.llm.words import WHITE, Block, blocks, hash_ranges, mix, ngrams, occurrences, text_of

#: Fewest words in a run.
MIN_LENGTH = 12


def _prefix_ranks(ids: np.ndarray) -> list[np.ndarray]:
    """Ranks of all stretches of 1, 2, 4, ... words: equal for equal stretches, up to where all differ."""
    ranks = [np.unique(ids, return_inverse=True)[1].astype(np.int32)]
    width = 1
    while int(ranks[-1].max()) + 1 < len(ids):
        following = np.zeros(len(ids), np.int64)  # 0: past the end
        following[:-width] = ranks[-1][width:].astype(np.int64) + 1
        pairs = ranks[-1].astype(np.int64) * (len(ids) + 1) + following
        ranks.append(np.unique(pairs, return_inverse=True)[1].astype(np.int32))
        width *= 2
    return ranks


def _neighbours(ids: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in the suffix array with ``least`` equal words or more, longest common prefix first."""
    ranks = _prefix_ranks(ids)
    order = np.empty(len(ids), np.int64)
    order[ranks[-1]] = np.arange(len(ids))
    a, b = order[:-1], order[1:]
    common = np.zeros(len(a), np.int64)
    for level in range(len(ranks) - 2, -1, -1):
        at, to = a + common, b + common
        inside = np.flatnonzero((at < len(ids)) & (to < len(ids)))
        equal = inside[ranks[level][at[inside]] == ranks[level][to[inside]]]
        common[equal] += 1 << level
    far = np.flatnonzero(common >= least)
    far = far[np.argsort(-common[far], kind="stable")]
    return a[far], b[far], common[far]


def _unite(small: list[int], large: list[int]) -> tuple[list[int], list[tuple[int, int]]]:
    """Both ordered sets as one, and the neighbours in it that come from different sets."""
    met, gaps = [], [bisect_left(large, x) for x in small]
    for k, (x, gap) in enumerate(zip(small, gaps)):
        if gap and (k == 0 or gaps[k - 1] != gap):
            met.append((large[gap - 1], x))
        if gap < len(large) and (k + 1 == len(small) or gaps[k + 1] != gap):
            met.append((x, large[gap]))
    if len(small) * 8 > len(large):
        large += small
        large.sort()  # two ordered stretches: merged in one pass
    else:
        for x in small:
            insort(large, x)
    return large, met


def find_runs(ids: np.ndarray, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of a word sequence, by start, then period.

    A run has its smallest period, at least two of them, at least ``min_length`` words, and no equal
    neighbour on either side that would continue it.
    """
    if len(ids) < max(min_length, 2):
        return []
    # a run's first position has a common prefix of its length less one period
    firsts, seconds, commons = _neighbours(ids, max(1, (min_length + 1) // 2))
    above: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    starts: dict[tuple[int, int], int] = {}

    def top(x: int) -> int:
        root = x
        while (up := above.get(root, root)) != root:
            root = up
        while x != root:
            above[x], x = root, above.get(x, x)
        return root

    for i, j, common in zip(firsts.tolist(), seconds.tolist(), commons.tolist()):
        i, j = top(i), top(j)
        large, small = members.pop(i, None) or [i], members.pop(j, None) or [j]
        if len(large) < len(small):
            i, j, large, small = j, i, small, large
        above[j] = i
        members[i], met = _unite(small, large)
        for first, second in met:
            period = second - first
            if period <= common and period + common >= min_length:
                run = (second + common, period)
                if first < starts.get(run, first + 1):
                    starts[run] = first
    return sorted((start, end - start, period) for (end, period), start in starts.items())


def _block_runs(block: Block, min_length: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each text of a block."""
    starts, ends, bounds = block.ranges(WHITE)
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(block.texts())]
    if not len(starts):
        return found
    text = text_of(bounds)
    # equal for equal words of one text, different across texts
    words = mix(hash_ranges(block.sums(), starts, ends) + mix(text.astype(np.uint64) + np.uint64(1)))
    n = max(1, (min_length + 1) // 2)
    at, grams = ngrams(words, bounds, n)
    twice, _ = occurrences(grams)
    steps = np.zeros(len(words) + 1, np.int32)
    steps[at[twice]] += 1
    np.subtract.at(steps, at[twice] + n, 1)
    kept = np.flatnonzero(np.cumsum(steps[:-1]) > 0)
    if not len(kept):
        return found
    # what is left out becomes a word like no other, so nothing is equal across it
    whole = np.flatnonzero(np.diff(kept) > 1) + 1
    places = np.insert(kept, whole, -1)
    ids = np.unique(words[kept], return_inverse=True)[1].astype(np.int64)
    ids = np.insert(ids, whole, len(kept) + np.arange(len(whole)))
    for start, length, period in find_runs(ids, min_length):
        first = int(places[start])
        found[text[first]].append((first - int(bounds[text[first]]), length, period))
    return found


def _collapsed(raw: bytes, runs: list[tuple[int, int, int]]) -> bytes:
    """The words of a text, one space between them, without the repeats in its runs."""
    words = raw.split()
    if runs:
        kept = np.ones(len(words), bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        words = compress(words, kept.tolist())
    return b" ".join(words)


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text",
                  min_length: int = MIN_LENGTH) -> DataFrame:
    """``runs`` (each with ``start``, ``length`` and ``period`` in words, from 0) and ``collapsed`` of every row.

    A word is a run of characters other than ASCII white space, in the case given. A run is a stretch of words
    with smallest period p, at least ``min_length`` and 2 p long, that no word beside it continues. Runs
    may overlap and are listed by start, then period. ``collapsed`` is the text's words joined by one
    space, without every word that some run contains after its first p words. A null or empty text has no
    run and an empty ``collapsed``. Every row is returned, repeated ones and null keys too; an empty table gives
    no rows; other columns are not carried. Needs no shuffle; memory follows the longest text.
    """
    if min_length < 2:
        raise ValueError("a run needs two words or more")
    kinds = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, texts = [], []
            for block in blocks(batch.column(1)):
                raw = block.data.tobytes()
                for k, own in enumerate(_block_runs(block, min_length)):
                    runs.append([{"start": s, "length": n, "period": p} for s, n, p in own])
                    texts.append(_collapsed(raw[block.bounds[k] : block.bounds[k + 1]], own))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(runs, kinds), pa.array(texts, pa.string())], [key, "runs", "collapsed"])

    bound_batches(docs.sparkSession)
    rows = docs.select(key, text)
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(
        arrow_function(find),
        f"`{key}` {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def with_planted_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and text, the texts of about a tenth of the keys made periodic from some word on.

    With h the crc32 of the key as text (a null key: empty), g = h div 10 and n words: if h mod 10 is 0 and
    n > 0, each word i >= a becomes word a + (i - a) mod p, where a = g mod n and
    p = 1 + (n - a) div (3 + g mod 8). Such texts have one space between words; others stay as they are.
    """
    h = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), lambda word: word != "")
    hit = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), h.alias("h"),
                      F.when(h % 10 == 0, words).alias("words"))
    placed = hit.withColumn("n", F.size("words")).withColumn("g", F.expr("h div 10"))
    placed = placed.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    placed = placed.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))

    def part(start: Column, length: Column) -> Column:
        return F.slice("words", start, length)

    tail = F.flatten(F.array_repeat(part(F.col("a") + 1, F.col("p")), F.expr("cast(1 + (n - a) div p as int)")))
    planted = F.array_join(F.slice(F.concat(part(F.lit(1), F.col("a")), tail), F.lit(1), F.col("n")), " ")
    return placed.select(F.col("key").alias(key), F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias(text))
