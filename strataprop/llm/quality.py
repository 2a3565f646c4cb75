"""Repetition rules: how much of a text stands inside n-grams and lines that repeat."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strataprop.llm.batches import bound_batches
from strataprop.llm.words import (
    WHITE, Block, blocks, hash_ranges, mix, ngrams, occurrences, per_text, text_of)

#: Largest share of a text's characters that may stand in repeats of n-grams, by n-gram length.
NGRAM_SHARES = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: The same for repeats of whole lines.
LINE_SHARE = 0.20
MIN_WORDS = 50
REPEATED_WORDS_PERCENT = 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LINE_FEED = np.zeros(256, bool)
_LINE_FEED[10] = True


def _keys(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Equal for equal hashes of one text, different across texts."""
    return mix(hashes + mix(text.astype(np.uint64) + np.uint64(1)))


def _covered(starts: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which words lie in a window of n words that starts at one of ``starts``."""
    steps = np.zeros(words + 1, np.int32)
    steps[starts] += 1
    np.subtract.at(steps, starts + n, 1)
    return np.cumsum(steps[:-1]) > 0


def _facts(block: Block, lengths: list[int]) -> dict[str, np.ndarray]:
    starts, ends, bounds = block.ranges(WHITE)
    sums = block.sums()
    hashes, text = hash_ranges(sums, starts, ends), text_of(bounds)
    points = np.zeros(len(block.data) + 1, np.int64)  # code points before each byte
    np.cumsum((block.data & 0xC0) != 0x80, out=points[1:])
    chars = points[ends] - points[starts]
    found = {"n_words": np.diff(bounds), "word_chars": per_text(chars, bounds),
             "n_symbols": per_text(_SYMBOL[block.data], block.bounds)}

    line_starts, line_ends, line_bounds = block.ranges(_LINE_FEED)
    first = np.searchsorted(starts, line_starts)
    last = np.searchsorted(starts, line_ends)
    wordy = last > first
    _, again = occurrences(_keys(hash_ranges(sums, line_starts, line_ends), text_of(line_bounds)))
    again &= wordy
    found["n_dup_lines"] = per_text(again, line_bounds)
    upto = np.concatenate([[0], np.cumsum(chars)])
    found["dup_line_chars"] = per_text((upto[last] - upto[first]) * again, line_bounds)

    at, grams = ngrams(hashes, bounds, 3)
    twice, _ = occurrences(_keys(grams, text[at]))
    found["n_repeat_words"] = per_text(_covered(at[twice], 3, len(hashes)), bounds)
    for n in lengths:
        at, grams = ngrams(hashes, bounds, n)
        _, later = occurrences(_keys(grams, text[at]))
        inside = _covered(at[later], n, len(hashes))
        found[f"dup_{n}gram_chars"] = per_text(chars * inside, bounds)
    return found


def repetition_quality(
    docs: DataFrame, key: str = "doc_id", text: str = "text",
    ngram_shares: Mapping[int, float] = NGRAM_SHARES, line_share: float = LINE_SHARE,
    min_words: int = MIN_WORDS, repeated_words_percent: int = REPEATED_WORDS_PERCENT,
) -> DataFrame:
    """Counts of words and repeats for every row, and whether to keep it.

    A word is a run without ASCII white space, in the case given. ``dup_line_chars`` and
    ``dup_<n>gram_chars`` count the characters of words inside a line or n-gram that an equal one in
    the same text precedes. ``base_failed``: fewer than ``min_words`` words, or more than
    ``repeated_words_percent`` of them in 3-grams found twice. ``kept`` is false if that failed or
    a share of ``word_chars`` goes beyond its limit. One row for each row, repeated ones too; a null
    or empty text has zeros and is not kept; an empty table gives no rows. Needs no shuffle.
    """
    lengths = sorted(ngram_shares)
    if any(n < 2 for n in lengths):
        raise ValueError("n-grams need two words or more")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "dup_line_chars", *[f"dup_{n}gram_chars" for n in lengths]]
    limits = {"dup_line_chars": line_share} | {f"dup_{n}gram_chars": ngram_shares[n] for n in lengths}

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_facts(block, lengths) for block in blocks(batch.column(1))]
            if not parts:
                continue
            facts = {c: np.concatenate([p[c] for p in parts]) for c in names}
            failed = (facts["n_words"] < min_words) | (
                100 * facts["n_repeat_words"] > repeated_words_percent * facts["n_words"])
            kept = ~failed
            for c, share in limits.items():
                kept &= facts[c] <= share * facts["word_chars"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(facts[c], pa.int64()) for c in names],
                 pa.array(failed), pa.array(kept)],
                names=[key, *names, "base_failed", "kept"])

    bound_batches(docs.sparkSession)
    rows = docs.select(key, text)
    kind = rows.schema[key].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in names)
    return rows.mapInArrow(judge, f"`{key}` {kind}, {counts}, base_failed boolean, kept boolean")
