"""Language model scores by a class-based bigram model, its word classes found by exchange.

The probability of a word is that of its class after the class before it, times that of the word in its class.
The most frequent words are moved between classes, each to the class under which the bigrams of classes
are likeliest, as the exchange method does. The executors look for each word's best class side by side, against the
class counts of the round's start; of all words that would join or leave a class, those that gain most may, a
quarter of an average class in a round, since words that jump all at once spoil what each of them gains alone.
Every other word has the class of its last byte. Counts come from all training texts: of words, a table that grows with the
vocabulary, and of neighbouring units (frequent words and classes of other words), a table of bounded size.

Scoring knows the counts of the most frequent words in every task. The other words of each text are joined with the
count table, so every word counts with its own frequency, whatever the size of the vocabulary.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataprop.functions.runtime import stage
from strataprop.llm.batches import arrow_function, bound_batches
from strataprop.llm.toxicity import bucket_of
from strataprop.llm.words import WHITE, Block, blocks, hash_ranges, text_of
from strataprop.operators.joins import equi_join

#: Words that every task knows the count of, and words with a class by exchange, at most.
KNOWN_BITS, CLUSTERED_BITS = 18, 14
#: Classes by exchange. Others: one for each last letter, one for digits, other ASCII and all else, the text's end.
CLASSES, FORMS = 64, 30
ALL_CLASSES = CLASSES + FORMS
#: Rounds of exchange, and the share of an average class that may join or leave a class in one of them.
ROUNDS, MOVE_SHARE = 12, 0.25
#: Added to the counts of words in their class, and weight of a class's own share in its transitions.
WORD_EXTRA, CLASS_WEIGHT = 0.5, 10.0

_FORM = np.full(256, 28, np.uint64)
_FORM[:128] = 27
_FORM[48:58] = 26
_FORM[97:123] = _FORM[65:91] = np.arange(26)
#: The word that ends every text. Words are 59 bits of a hash and 5 of the form.
_END_FORM = FORMS - 1
END = np.uint64(_END_FORM)
_FORM_MASK = np.uint64(31)
#: Units: clustered words, then forms.
_UNIT_BITS = CLUSTERED_BITS + 1
_UNITS = (1 << CLUSTERED_BITS) + FORMS


class Model(NamedTuple):
    """Word ids (ascending) of the known words, their counts and classes, and what the formulas need."""

    words: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    transitions: np.ndarray  # log10 of the probability of a class (column) after a class (row)
    wholes: np.ndarray  # log10 of the divisor of word counts by class
    tokens: int
    types: int
    least: int  # words with fewer occurrences may be missing here


def _tokens(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """The word ids of a block, each text closed by END, and each text's bounds in them."""
    starts, ends, bounds = block.ranges(WHITE)
    words = hash_ranges(block.sums(fold=True), starts, ends) & ~_FORM_MASK | _FORM[block.data[ends - 1]]
    tokens = np.full(len(words) + block.texts(), END)
    tokens[np.arange(len(words)) + text_of(bounds)] = words
    return tokens, bounds + np.arange(len(bounds))


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, which = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(which, np.concatenate(counts), len(found)).astype(np.int64)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [np.unique(_tokens(block)[0], return_counts=True) for block in blocks(batch.column(0))]
        if parts:
            words, counts = _summed(*map(list, zip(*parts)))
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], ["word", "n"])


def _looked_up(words: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place among the ascending words, and whether it is there."""
    if not len(words):
        return np.zeros(len(tokens), np.int64), np.zeros(len(tokens), bool)
    at = np.minimum(np.searchsorted(words, tokens), len(words) - 1)
    return at, words[at] == tokens


def _pair_counts(words: np.ndarray, units: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often two units are neighbours; the first word's neighbour is the end of the text before."""
    for batch in batches:
        parts = []
        for block in blocks(batch.column(0)):
            tokens, _ = _tokens(block)
            at, known = _looked_up(words, tokens)
            right = ((1 << CLUSTERED_BITS) + (tokens & _FORM_MASK)).astype(np.int64)
            right[known] = units[at[known]]
            left = np.concatenate([[_UNITS - 1], right[:-1]])
            parts.append(np.unique(left << _UNIT_BITS | right, return_counts=True))
        if parts:
            pairs, counts = _summed(*map(list, zip(*parts)))
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], ["pair", "n"])


def _weight(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(matrix: np.ndarray) -> float:
    """Log likelihood of the bigrams of classes, but for a part that does not depend on the classes."""
    return float(_weight(matrix).sum() - _weight(matrix.sum(0)).sum() - _weight(matrix.sum(1)).sum())


def best_class(matrix: np.ndarray, own: int, after: np.ndarray, before: np.ndarray, twice: int) -> tuple[int, float]:
    """The class that a word of class ``own`` fits best, of the first CLASSES, and what it gains by the move.

    ``matrix`` counts bigrams of classes, the word's own included; ``after`` and ``before`` count the classes of
    its neighbours other than itself, ``twice`` how often it follows itself.
    """
    rest = matrix.copy()
    rest[own] -= after
    rest[:, own] -= before
    rest[own, own] -= twice
    rows, columns = matrix.sum(1), matrix.sum(0)
    follows, precedes = after.sum() + twice, before.sum() + twice
    rows[own] -= follows
    columns[own] -= precedes
    right, left = np.flatnonzero(after), np.flatnonzero(before)
    ahead, behind = rest[:CLASSES, right], rest[left, :CLASSES]
    gain = (_weight(ahead + after[right]) - _weight(ahead)).sum(1)
    gain += (_weight(behind + before[left][:, None]) - _weight(behind)).sum(0)
    inner = np.diagonal(rest)[:CLASSES]  # neighbours that would be in the word's own class count once
    gain += _weight(inner + after[:CLASSES] + before[:CLASSES] + twice) + _weight(inner)
    gain -= _weight(inner + after[:CLASSES]) + _weight(inner + before[:CLASSES])
    gain -= _weight(rows[:CLASSES] + follows) - _weight(rows[:CLASSES])
    gain -= _weight(columns[:CLASSES] + precedes) - _weight(columns[:CLASSES])
    best = int(gain.argmax())
    return best, float(gain[best] - gain[own])


def _units(batch: pa.RecordBatch, classes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """Each unit, the class counts of its neighbours after and before it, and how often it follows itself."""
    lists = [(side.offsets.to_numpy(), side.values.to_numpy()) for side in (batch.column("after"), batch.column("before"))]
    for k, unit in enumerate(batch.column("unit").to_pylist()):
        counts, twice = [], 0
        for offsets, values in lists:
            packed = values[offsets[k] : offsets[k + 1]]
            other, n = packed & (1 << _UNIT_BITS) - 1, packed >> _UNIT_BITS
            counts.append(np.bincount(classes[other], n, ALL_CLASSES))
            twice = int(n[other == unit].sum())
        yield unit, *counts, twice


def _class_matrix(neighbours: DataFrame, classes: np.ndarray) -> np.ndarray:
    """Bigrams of classes, summed by Spark: a fixed number of cells."""
    shared = neighbours.sparkSession.sparkContext.broadcast(classes)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((ALL_CLASSES, ALL_CLASSES))
        for batch in batches:
            for unit, after, _, _ in _units(batch, shared.value):
                total[shared.value[unit]] += after
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell), pa.array(total.reshape(-1)[cell].astype(np.int64))], ["cell", "n"])

    matrix = np.zeros(ALL_CLASSES**2)
    for row in neighbours.mapInArrow(arrow_function(cells), "cell long, n long").groupBy("cell").agg(
            F.sum("n").alias("n")).collect():
        matrix[row["cell"]] = row["n"]
    shared.destroy()
    return matrix.reshape(ALL_CLASSES, ALL_CLASSES)


def _moved(neighbours: DataFrame, classes: np.ndarray, matrix: np.ndarray, words: int) -> np.ndarray:
    """The classes after one round in which the words that gain most have moved."""
    shared = neighbours.sparkSession.sparkContext.broadcast((classes, matrix))

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, matrix = shared.value
        for batch in batches:
            found = []
            for unit, after, before, twice in _units(batch, classes):
                own = int(classes[unit])
                after[own] -= twice
                before[own] -= twice
                best, gain = best_class(matrix, own, after, before, twice)
                if best != own and gain > 1e-6:
                    found.append((unit, best, gain))
            units, targets, gains = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(units, pa.int64()), pa.array(targets, pa.int64()), pa.array(gains, pa.float64())],
                ["unit", "target", "gain"])

    clustered = neighbours.filter(F.col("unit") < 1 << CLUSTERED_BITS)
    proposed = clustered.mapInArrow(arrow_function(propose), "unit long, target long, gain double").collect()
    shared.destroy()  # a row for each clustered word at most
    quota = max(1, math.ceil(MOVE_SHARE * words / CLASSES))
    joined, left = np.zeros(ALL_CLASSES, int), np.zeros(ALL_CLASSES, int)
    found = classes.copy()
    for row in sorted(proposed, key=lambda r: (-r["gain"], r["unit"])):
        own, target = classes[row["unit"]], row["target"]
        if joined[target] < quota and left[own] < quota:
            joined[target] += 1
            left[own] += 1
            found[row["unit"]] = target
    return found


def exchange(neighbours: DataFrame, words: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all units, the likeliest of all rounds, and their bigram counts; ``words`` units are clustered."""
    classes = np.full(_UNITS, CLASSES, np.int64)
    classes[1 << CLUSTERED_BITS :] += np.arange(FORMS)
    classes[:words] = np.arange(words) % CLASSES
    matrix = _class_matrix(neighbours, classes)
    best = likelihood(matrix), classes, matrix
    for _ in range(rounds):
        classes = _moved(neighbours, classes, matrix, words)
        matrix = _class_matrix(neighbours, classes)
        best = max(best, (likelihood(matrix), classes, matrix), key=lambda found: found[0])
    return best[1], best[2]


def _most_frequent(counted: DataFrame, room: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Words and counts of the most frequent, most frequent first, and the count from which on all are there."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 16)  # a sixteenth of a doubling
    least = None
    for row in counted.groupBy(step.alias("step")).agg(F.count("n").alias("words"), F.min("n").alias("least")).orderBy(
            F.desc("step")).collect():  # 1024 rows at most
        room -= row["words"]
        if room < 0:
            break
        least = row["least"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.iinfo(np.int64).max
    table = counted.filter(F.col("n") >= least).toArrow()
    words, counts = table.column("word").to_numpy().view(np.uint64), table.column("n").to_numpy()
    order = np.lexsort((words, -counts))
    return words[order], counts[order], least


def neighbour_lists(texts: DataFrame, words: np.ndarray) -> DataFrame:
    """For every unit the packed counts of the units ``after`` and ``before`` it, each list of bounded length.

    ``words`` are the clustered words by unit number.
    """
    order = np.argsort(words)
    shared = texts.sparkSession.sparkContext.broadcast((words[order], order))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _pair_counts(*shared.value, batches)

    pairs = texts.mapInArrow(arrow_function(count), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    left, right = F.shiftright("pair", _UNIT_BITS), F.col("pair").bitwiseAND(F.lit((1 << _UNIT_BITS) - 1))
    sides = pairs.select(F.explode(F.array(
        F.struct(left.alias("unit"), F.lit(True).alias("after"), right.alias("other"), "n"),
        F.struct(right.alias("unit"), F.lit(False).alias("after"), left.alias("other"), "n"))).alias("side")).select("side.*")
    packed = F.shiftleft("n", _UNIT_BITS).bitwiseOR(F.col("other"))
    lists = stage(sides.groupBy("unit").agg(
        F.collect_list(F.when(F.col("after"), packed)).alias("after"),
        F.collect_list(F.when(~F.col("after"), packed)).alias("before")))
    shared.destroy()
    return lists


def fit_class_model(texts: DataFrame, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model of a table's one text column, and the staged counts ``word, n`` of all its words."""
    bound_batches(texts.sparkSession)
    counted = stage(texts.mapInArrow(arrow_function(_word_counts), "word long, n long").groupBy("word").agg(
        F.sum("n").alias("n")))
    words, counts, least = _most_frequent(counted, 1 << KNOWN_BITS)
    clustered = words[words != END][: 1 << CLUSTERED_BITS]
    classes, matrix = exchange(neighbour_lists(texts, clustered), len(clustered), rounds)

    forms = {row["form"]: row for row in counted.groupBy(
        F.col("word").bitwiseAND(F.lit(int(_FORM_MASK))).alias("form")).agg(
        F.sum("n").alias("tokens"), F.count("n").alias("types")).collect()}  # one row per form
    tokens, types = sum(r["tokens"] for r in forms.values()), sum(r["types"] for r in forms.values())
    class_of = CLASSES + (words & _FORM_MASK).astype(np.int64)
    class_of[np.flatnonzero(words != END)[: len(clustered)]] = classes[: len(clustered)]
    inside = class_of < CLASSES
    form = (words & _FORM_MASK).astype(np.int64)
    totals = np.bincount(class_of[inside], counts[inside], ALL_CLASSES)
    different = np.bincount(class_of[inside], minlength=ALL_CLASSES).astype(float)
    for k in range(FORMS - 1):
        own = forms.get(k)
        if own:
            totals[CLASSES + k] = own["tokens"] - counts[inside & (form == k)].sum()
            different[CLASSES + k] = own["types"] - (inside & (form == k)).sum()
        different[CLASSES + k] += 1  # all words that the training texts do not have
    wholes = np.log10(np.maximum(totals + WORD_EXTRA * different, WORD_EXTRA))
    share = (matrix.sum(0) + 1) / (matrix.sum() + ALL_CLASSES)
    transitions = (matrix + CLASS_WEIGHT * share) / (matrix.sum(1, keepdims=True) + CLASS_WEIGHT)
    order = np.argsort(words)
    return Model(words[order], counts[order], class_of[order].astype(np.int16), np.log10(transitions), wholes,
                 int(tokens), int(types), int(least)), counted


def _scores(model: Model, task: int, first: int, keys: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """One row per text; the words without a known count are listed and so far count as never seen."""
    columns: list[list[np.ndarray]] = [[], [], [], []]
    words, times = [], []
    for block in blocks(texts):
        tokens, bounds = _tokens(block)
        at, known = _looked_up(model.words, tokens)
        classes = CLASSES + (tokens & _FORM_MASK).astype(np.int64)
        counts = np.zeros(len(tokens), np.int64)
        if known.any():
            classes[known], counts[known] = model.classes[at[known]], model.counts[at[known]]
        text = text_of(bounds)
        before = np.concatenate([[ALL_CLASSES - 1], classes[:-1]])
        emitted = np.log10(counts + WORD_EXTRA) - model.wholes[classes]
        emitted[tokens == END] = 0.0  # its class has no other word
        columns[0].append(np.diff(bounds))
        columns[1].append(np.bincount(text, known, block.texts()).astype(np.int64))
        columns[2].append(np.bincount(text, np.log10(counts + 1.0), block.texts()))
        columns[3].append(np.bincount(text, model.transitions[before, classes] + emitted, block.texts()))
        far = np.flatnonzero(~known)
        order = far[np.lexsort((tokens[far], text[far]))]
        new = np.ones(len(order), bool)
        new[1:] = (tokens[order][1:] != tokens[order][:-1]) | (text[order][1:] != text[order][:-1])
        at = np.flatnonzero(new)
        listed, often = tokens[order][at].view(np.int64), np.diff(np.append(at, len(order)))
        edges = np.searchsorted(text[order][at], np.arange(block.texts() + 1))
        words += [listed[a:b] for a, b in zip(edges, edges[1:])]
        times += [often[a:b] for a, b in zip(edges, edges[1:])]
    sizes, seen, base, score = (np.concatenate(c) if c else np.zeros(0) for c in columns)
    base = base - sizes * np.log10(model.tokens + model.types + 1)
    longs = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [keys, pa.array((task << 40) + first + np.arange(len(keys))), pa.array(sizes, pa.int64()), pa.array(seen, pa.int64()),
         pa.array(base, pa.float64()), pa.array(score, pa.float64()), pa.array(words, longs), pa.array(times, longs)],
        ["key", "row", "n_tokens", "n_known", "base_score", "score", "words", "times"])


def score_texts(docs: DataFrame, model: Model, counted: DataFrame, key: str, text: str) -> DataFrame:
    """``n_tokens``, ``n_known``, ``base_score`` and ``score`` of every row under a fitted model."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = 0
        for batch in batches:
            yield _scores(shared.value, TaskContext.get().partitionId(), first, batch.column(0), batch.column(1))
            first += len(batch)

    kind = rows.schema["key"].dataType.simpleString()
    scored = stage(rows.mapInArrow(
        arrow_function(score), f"key {kind}, row long, n_tokens long, n_known long, base_score double, score double, "
        "words array<long>, times array<long>"))
    shared.destroy()
    listed = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("word")).select(
        F.col("word.words").alias("word"), "row", F.col("word.times").alias("times"))
    seldom = counted.filter(F.col("n") < model.least)
    found = equi_join(listed, seldom, "word", "inner")
    extra = F.when(F.col("word") == int(END), F.lit(0.0)).otherwise(
        F.log10(F.col("n") + F.lit(WORD_EXTRA)) - F.log10(F.lit(WORD_EXTRA)))
    added = found.groupBy("row").agg(
        F.sum("times").alias("seen"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("base"),
        F.sum(F.col("times") * extra).alias("more"))
    joined = scored.drop("words", "times").join(added, "row", "left")
    return joined.select(
        F.col("key").alias(key), "n_tokens", (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        (F.col("base_score") + F.coalesce("base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"))


def score_language_model(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 7,
                         held_out: int = 2) -> DataFrame:
    """``held_out``, token counts, the unigram ``base_score`` and the model's ``score`` (log10 of the probability).

    Learns from rows whose crc32 of the key, modulo ``folds``, is not ``held_out`` (a null key counts as empty text).
    A-Z count as a-z; tokens are the words, runs of characters other than ASCII white space, and one end per
    text. ``n_known`` counts tokens that training texts have, ``train_tokens`` all their tokens. ``base_score`` adds
    log10((c + 1) / (tokens + different tokens + 1)) over the tokens, c a token's count in training texts. A null or
    empty text is its end alone. Every row is returned, repeated ones too; without training rows every
    word is unknown; an empty table gives no rows; other columns are not carried. Runs jobs when called.
    """
    held = bucket_of(F.col(key), folds) == held_out
    model, counted = fit_class_model(docs.filter(~held).select(F.col(text).alias("text")))
    scored = score_texts(docs, model, counted, key, text)
    return scored.select(key, held.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias(
        "train_tokens"), "base_score", "score")
