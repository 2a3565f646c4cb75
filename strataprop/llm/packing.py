"""Packing tokenized texts into sequences: a configuration linear program over the length histogram.

The texts meet only in the histogram of piece lengths, which has one number per possible length,
whatever the number of texts. On it the driver solves the program "fewest sequences, each filled
after a configuration of length classes" by multiplicative weights: the weights of classes that are not
covered yet grow, and a knapsack by dynamic programming prices the best configuration. The
rounded solution is laid out with real lengths, gaps take the longest piece that fits, and what the
program left over follows longest first. The result says, for each length, which ranks of pieces go
to which sequences; ranks are counted by task and added up, so no task or driver sees all pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataprop.functions.runtime import stage
from strataprop.llm.batches import arrow_function, bound_batches
from strataprop.llm.words import WHITE, Block, blocks, hash_ranges

CAPACITY, END_ID = 4096, 1
#: Length classes of the program, knapsack units of a sequence, and rounds at most.
CLASSES, UNITS, ROUNDS = 64, 512, 3000
#: Growth of the weights, and the gap between the solution and its lower bound that is good enough.
STEP, GAP = 0.1, 0.01
#: A task keeps the ids of 2^(WORD_BITS - 1) words (about 25 MB), then begins anew.
WORD_BITS = 20
#: Marks that are a word of their own behind a letter.
MARKS = ".,;:!?"


_MARK, _ASCII_LETTER = (np.array([b < 128 and test(chr(b)) for b in range(256)]) for test in (MARKS.__contains__, str.isalpha))


class Plan(NamedTuple):
    """Runs sorted by length, then rank: ranks from ``rank`` on go to ``sequence``, ``sequence`` + 1, ..."""

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int
    lower_bound: float


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it prints."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class _Table:
    """Numbers of 64-bit hashes, looked up and added many at once: open addressing in two arrays."""

    def __init__(self, bits: int):
        self.keys, self.numbers = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)
        self.shift, self.mask, self.used = np.uint64(64 - bits), (1 << bits) - 1, 0

    def get(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 for those not here."""
        found, open_, slot = np.full(len(hashes), -1, np.int64), np.arange(len(hashes)), (hashes >> self.shift).astype(np.int64)
        while len(open_):
            keys = self.keys[slot]
            hit, other = keys == hashes[open_], keys != 0
            found[open_[hit]] = self.numbers[slot[hit]]
            on = other & ~hit
            open_, slot = open_[on], (slot[on] + 1) & self.mask
        return found

    def add(self, hashes: np.ndarray) -> None:
        """Give different new hashes the next numbers, in their order."""
        open_, slot = np.arange(len(hashes)), (hashes >> self.shift).astype(np.int64)
        while len(open_):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = hashes[open_[free]]  # of several for one slot the last stays
            won = self.keys[slot] == hashes[open_]
            self.numbers[slot[won]] = self.used + open_[won]
            open_, slot = open_[~won], (slot[~won] + 1) & self.mask
        self.used += len(hashes)


class WordTokens:
    """Token ids of words, each word encoded once while it is kept.

    The vocabulary drops white space and never joins words across it, so a text's ids are its words' ids.
    If it also makes letters small and splits letters from marks, case does not tell words apart, a
    mark behind a letter is a word of its own, and words of letters can skip the tokenizer's slow normal
    form: their merges are applied directly. Whether that gives the vocabulary's own ids is tried out on a
    few words at the start; if not, and for all other words, the tokenizer does it all.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.shown = {chr(b): c for b, c in _byte_characters().items()}
        probes = ["the", "Straße", "Élève", "NAÏVE", "X", "Привет", "日本語", "internationalisation", ".", "?", "x.", "Ab?"]
        whole = [self.tokenizer.encode(word, add_special_tokens=False).ids for word in probes]
        self.direct = whole == [sum((self._direct(part) for part in ([p[:-1], p[-1]] if p[1:] and p[-1] in ".?" else [p])), [])
                                for p in probes]
        self.forget()

    def forget(self, words: int = 0) -> None:
        """Forget all words; there is then room for as many, even if one text has more than are kept."""
        bits = max(WORD_BITS, 1 + words.bit_length())
        self.table = _Table(bits)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts, self.sizes = np.zeros(1 << bits - 1, np.int64), np.zeros(1 << bits - 1, np.int32)
        self.filled = 0

    def _direct(self, word: str) -> list[int] | None:
        """The ids of letters, or of one mark, by the merges alone; None if the word is neither."""
        if word.isascii():
            if not word.isalpha() and word not in MARKS:
                return None
            word = word.lower()
        else:
            folded = word.lower()
            # sigma is small in two ways; what is no letter any more would be split
            if not word.isalpha() or "Σ" in word or not folded.isalpha() or not is_normalized("NFC", word):
                return None
            word = "".join(map(self.shown.get, folded.encode().decode("latin-1")))
        return [t.id for t in self.tokenizer.model.tokenize(word)]

    def _encoded(self, words: list[str]) -> list[list[int]]:
        found = list(map(self._direct, words)) if self.direct else [None] * len(words)
        slow = [k for k, ids in enumerate(found) if ids is None]
        for k, e in zip(slow, self.tokenizer.encode_batch_fast([words[k] for k in slow], add_special_tokens=False)):
            found[k] = e.ids
        return found

    def _add(self, hashes: np.ndarray, words: list[str]) -> None:
        found = self._encoded(words)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        more = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
        first, last = self.table.used, self.table.used + len(found)
        if self.filled + len(more) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(self.filled + len(more), np.uint32)])
        self.ids[self.filled : self.filled + len(more)] = more
        self.starts[first:last] = self.filled + np.cumsum(sizes) - sizes
        self.sizes[first:last] = sizes
        self.table.add(hashes)
        self.filled += len(more)

    def _words(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        starts, ends, bounds = block.ranges(WHITE)
        if not self.direct or not len(starts):
            return starts, ends, bounds
        data = block.data
        last = _MARK[data[ends - 1]] & (ends - starts > 1)
        last[last] = _ASCII_LETTER[data[ends[last] - 2]]
        at = ends[last] - 1
        starts = np.sort(np.concatenate([starts, at]), kind="stable")
        return starts, np.sort(np.concatenate([ends, at]), kind="stable"), np.searchsorted(starts, block.bounds)

    def texts(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text; a null is an empty text."""
        for block in blocks(column):
            starts, ends, bounds = self._words(block)
            hashes, first, word = np.unique(
                hash_ranges(block.sums(fold=self.direct), starts, ends), return_index=True, return_inverse=True)
            if self.table.used + len(hashes) > len(self.starts):
                self.forget(len(hashes))
            number = self.table.get(hashes)
            new = np.flatnonzero(number < 0)
            if len(new):
                raw, at = block.data.tobytes(), first[new]
                number[new] = np.arange(self.table.used, self.table.used + len(new))
                self._add(hashes[new], [raw[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist())])
            of_word = number[word]
            sizes = self.sizes[of_word]
            upto = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            flat = self.ids[np.repeat(self.starts[of_word] - upto[:-1], sizes) + np.arange(upto[-1])]
            edges = upto[bounds]
            for k in range(block.texts()):
                yield flat[edges[k] : edges[k + 1]]


@lru_cache(maxsize=1)
def _tokens_of(path: str) -> WordTokens:
    """One tokenizer for all tasks of a worker process."""
    return WordTokens(path)


def _pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """A row per piece, with the task that made it and its rank among that task's pieces of its length."""
    key = docs.columns[0]
    kind = docs.schema[0].dataType.simpleString()
    names = [key, "piece", "start", "length", "ids_crc32", "__task", "__rank"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, task = _tokens_of(tokenizer), TaskContext.get().partitionId()
        ranks = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            row, piece, start, length, crc, rank = ([] for _ in range(6))
            for k, ids in enumerate(tokens.texts(batch.column(1))):
                whole = np.append(ids, np.uint32(end_id)).astype("<u4")
                for number, at in enumerate(range(0, len(whole), capacity)):
                    part = whole[at : at + capacity]
                    row.append(k)
                    piece.append(number)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    rank.append(ranks[len(part)])
                    ranks[len(part)] += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                 *[pa.array(x, pa.int64()) for x in (start, length, crc, [task] * len(row), rank)]], names)
        tokens.forget()

    return docs.mapInArrow(
        arrow_function(cut), f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long, __task long, __rank long")


def _classes(lengths: np.ndarray, counts: np.ndarray, unit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group lengths into classes of about equal mass: largest length, size in units, and demand."""
    mass = np.cumsum(lengths * counts) / (lengths * counts).sum()
    label = np.minimum((mass * CLASSES).astype(int), CLASSES - 1)
    tops = np.append(np.flatnonzero(np.diff(label)), len(lengths) - 1)
    demand = np.diff(np.concatenate([[0], np.cumsum(counts)[tops]]))
    return lengths[tops], -(-lengths[tops] // unit), demand


def _best_configuration(sizes: np.ndarray, prices: np.ndarray, room: int) -> tuple[np.ndarray, float]:
    """Unbounded knapsack: how many of each size fill ``room`` units at the highest price."""
    best, chosen = np.zeros(room + 1), np.full(room + 1, -1)
    order = np.argsort(sizes, kind="stable")
    ordered, worth = sizes[order], prices[order]
    fits = np.searchsorted(ordered, np.arange(room + 1), "right")
    for c in range(1, room + 1):
        if fits[c]:
            values = best[c - ordered[: fits[c]]] + worth[: fits[c]]
            k = int(values.argmax())
            best[c], chosen[c] = values[k], order[k]
    config, c = np.zeros(len(sizes), np.int64), room
    while c > 0 and chosen[c] >= 0:
        config[chosen[c]] += 1
        c -= sizes[chosen[c]]
    return config, float(best[room])


def solve(sizes: np.ndarray, demand: np.ndarray, room: int) -> tuple[list[np.ndarray], np.ndarray, float]:
    """Configurations, how often each is used, and the program's lower bound, by multiplicative weights.

    A round prices every class by its weight per wanted piece, takes the best configuration as often as
    its scarcest class allows, and lowers the weights of what it covered. The prices, scaled so that no
    configuration is worth more than one, are a feasible dual: their value bounds the optimum from below.
    """
    found: dict[bytes, int] = {}
    configs, used = [], []
    log_weight, covered, bound = np.zeros(len(sizes)), np.zeros(len(sizes)), 0.0
    for _ in range(ROUNDS):
        prices = np.exp(log_weight - log_weight.max()) / demand
        config, worth = _best_configuration(sizes, prices, room)
        bound = max(bound, float((prices * demand).sum() / worth))
        inside = config > 0
        times = (demand[inside] / config[inside]).min()
        which = found.setdefault(config.tobytes(), len(configs))
        if which == len(configs):
            configs.append(config)
            used.append(0.0)
        used[which] += times
        share = config * times / demand
        covered += share
        log_weight -= STEP * share
        if covered.min() > 0 and sum(used) / covered.min() <= (1 + GAP) * bound:
            break
    return configs, np.array(used) / max(covered.min(), 1e-9), bound


def plan(histogram: np.ndarray, capacity: int) -> Plan:
    """Lay out all pieces; ``histogram[n]`` counts the pieces of n tokens."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    groups: list[tuple[list[int], int]] = []
    if left[capacity]:
        groups.append(([capacity], int(left[capacity])))
        left[capacity] = 0
    lengths = np.flatnonzero(left)
    bound = float(-(-int((lengths * left[lengths]).sum()) // capacity)) if len(lengths) else 0.0

    def fill(wanted: list[tuple[int, int]], copies: int) -> int:
        """Lay out one configuration with the longest pieces at hand, as often as they last."""
        inside: dict[int, int] = {}
        room = capacity
        have = np.flatnonzero(left)

        def take(low: int, high: int) -> bool:
            nonlocal room
            k = int(np.searchsorted(have, min(high, room), "right")) - 1
            while k >= 0 and have[k] > low:
                n = int(have[k])
                if left[n] > inside.get(n, 0):
                    inside[n] = inside.get(n, 0) + 1
                    room -= n
                    return True
                k -= 1
            return False

        for low, high in wanted:
            take(low, high)
        while room > 0 and take(0, room):
            pass
        if not inside:
            return 0
        times = min(copies, *(int(left[n]) // m for n, m in inside.items()))
        for n, m in inside.items():
            left[n] -= m * times
        groups.append((sorted((n for n, m in inside.items() for _ in range(m)), reverse=True), times))
        return times

    if len(lengths):
        unit = -(-capacity // UNITS)
        tops, sizes, demand = _classes(lengths, left[lengths], unit)
        lows = np.concatenate([[0], tops[:-1]])
        configs, used, _ = solve(sizes, demand, capacity // unit)
        for which in np.argsort(-used, kind="stable"):
            wanted = [(int(lows[c]), int(tops[c])) for c in np.flatnonzero(configs[which])[::-1]
                      for _ in range(configs[which][c])]
            copies = int(used[which])
            while copies and (times := fill(wanted, copies)):
                copies -= times
        while left.any():
            fill([(0, capacity)], int(left.sum()))

    next_rank, runs, sequence = np.zeros(capacity + 1, np.int64), [], 0
    for inside, times in groups:
        offset = 0
        for n in inside:
            runs.append((n, next_rank[n], sequence, offset))
            next_rank[n] += times
            offset += n
        sequence += times
    table = np.array(sorted(runs), np.int64).reshape(-1, 4)
    return Plan(*table.T, sequences=sequence, lower_bound=bound + float(histogram[capacity]))


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Cut tokenized texts into pieces and place every piece in a sequence.

    ``tokenizer`` is the path of a vocabulary file that splits at white space, on every executor. A
    text's tokens end with ``end_id``; only longer texts than ``capacity`` are cut. Columns: the key,
    ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` (from 0) and ``offset``. A null or empty text is
    one piece of one token. Repeated rows and null keys are packed like any other row. An empty
    table gives no rows; other columns are not carried.
    """
    bound_batches(docs.sparkSession)
    made = stage(_pieces(docs.select(key, text), tokenizer, capacity, end_id))
    counts = stage(made.groupBy("__task", "length").agg(F.count(F.lit(1)).alias("rows")))
    histogram = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("rows").alias("rows")).collect():  # capacity rows at most
        histogram[row["length"]] = row["rows"]
    # one run for each slot of each distinct layout: bounded by the capacity, not by the texts
    layout = docs.sparkSession.sparkContext.broadcast(plan(histogram, capacity))
    before = Window.partitionBy("length").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("__task", "length", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("__first"))
    ranked = made.join(first, ["__task", "length"]).select(
        *[made[c] for c in (key, "piece", "start", "length", "ids_crc32")], (F.col("__first") + F.col("__rank")).alias("rank"))
    names = [key, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = layout.value
        order = (runs.length << 48) + runs.rank
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            k = np.searchsorted(order, (length << 48) + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(runs.sequence[k] + rank - runs.rank[k]), pa.array(runs.offset[k])],
                names)

    kind = docs.schema[key].dataType.simpleString()
    return ranked.mapInArrow(
        arrow_function(place), f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
