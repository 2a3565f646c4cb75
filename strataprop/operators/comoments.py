"""Counts, means and co-moments of all pairs of columns, in blocks that merge.

A task reads its rows once and keeps, for every pair of columns, the rows that have both, their two means, and
sums of squares and products about those means. Such facts of two sets of rows merge without loss of digits, so
values far from zero keep theirs. Pairs are held in square blocks, so many at a time that a task's memory is
bounded; further blocks take further passes. Blocks of all tasks are merged as they come, sorted by
block, and become rows on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataprop.functions.runtime import stage

#: Columns of a block, and blocks in a task's memory at a time: 130 MB.
WIDTH, BLOCKS = 128, 128
#: Values taken together.
CHUNK = 1 << 20
ROWS = -1
FACTS = 8
#: A column varies if its values differ by more than rounding; squared, as a share of their squared mean.
ROUNDING = 1e-28


def _moments(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> np.ndarray:
    """Eight facts of each pair of columns: rows, the columns' bases, how far their means are from these, sums of
    squares about the means, and of products."""
    (here_a, off_a, base_a, mean_a), (here_b, off_b, base_b, mean_b) = a, b
    n = here_a.T @ here_b
    sum_a, sum_b = off_a.T @ here_b, here_a.T @ off_b
    some = np.maximum(n, 1)
    return np.stack([
        n, np.broadcast_to(base_a[:, None], n.shape), np.broadcast_to(base_b, n.shape),
        mean_a[:, None] + sum_a / some, mean_b + sum_b / some,
        np.maximum((off_a**2).T @ here_b - sum_a**2 / some, 0), np.maximum(here_a.T @ off_b**2 - sum_b**2 / some, 0),
        off_a.T @ off_b - sum_a * sum_b / some])


def merged(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The facts of two sets of rows together, about the bases of the first."""
    some = np.maximum(one[0] + two[0], 1)
    both = one[0] * two[0] / some
    # bases and distances apart: near values far from zero differ without a loss of digits
    step_a, step_b = ((two[k] - one[k]) + (two[k + 2] - one[k + 2]) for k in (1, 2))
    sums = [one[5] + two[5] + step_a**2 * both, one[6] + two[6] + step_b**2 * both, one[7] + two[7] + step_a * step_b * both]
    known = np.stack([one[0] + two[0], one[1], one[2], one[3] + step_a * two[0] / some, one[4] + step_b * two[0] / some, *sums])
    return np.where(one[0] > 0, known, two)


def _chunks(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[np.ndarray]:
    rows = max(1, CHUNK // columns)
    for batch in batches:
        for at in range(0, len(batch), rows):
            part = batch.slice(at, rows)
            yield np.column_stack([c.to_numpy(zero_copy_only=False) for c in part.columns])


def _centred(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which values are there, how far each is from its column's mean (0 if not there), a base, and the mean from it."""
    here = ~np.isnan(values)
    first = values[here.argmax(axis=0), np.arange(values.shape[1])]
    first = np.where(np.isnan(first), 0, first)
    off = np.where(here, values - first, 0)  # exactly 0 in a column of one value
    mean = off.sum(axis=0) / np.maximum(here.sum(axis=0), 1)
    return here.astype(float), np.where(here, off - mean, 0), first, mean


def block_moments(df: DataFrame, columns: int) -> DataFrame:
    """Rows ``block, facts`` of a table of double columns: merged facts of blocks of pairs; ROWS has the row count."""
    side = -(-columns // WIDTH)
    wanted = [(i, j) for i in range(side) for j in range(i, side)]
    found = None
    for at in range(0, len(wanted), BLOCKS):
        some, first = wanted[at : at + BLOCKS], at == 0

        def facts(batches: Iterator[pa.RecordBatch], some=some, first=first) -> Iterator[pa.RecordBatch]:
            held: dict[tuple[int, int], np.ndarray] = {}
            rows = 0
            for values in _chunks(batches, columns):
                rows += len(values)
                here, off, base, mean = _centred(values)
                parts = [tuple(x[..., k * WIDTH : (k + 1) * WIDTH] for x in (here, off, base, mean)) for k in range(side)]
                for i, j in some:
                    new = _moments(parts[i], parts[j])
                    held[i, j] = merged(held[i, j], new) if (i, j) in held else new
            for (i, j), own in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i * side + j]), pa.array([own.tobytes()], pa.binary())], ["block", "facts"])
            if first:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ROWS]), pa.array([np.array([float(rows)]).tobytes()], pa.binary())], ["block", "facts"])

        made = df.mapInArrow(facts, "block long, facts binary")
        found = made if found is None else found.union(made)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = None, None
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                new = np.frombuffer(raw.as_buffer(), float)
                new = new if block == ROWS else new.reshape(FACTS, min(WIDTH, columns - block // side * WIDTH), -1)
                if block == held:
                    total = total + new if block == ROWS else merged(total, new)
                    continue
                if held is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([held]), pa.array([total.tobytes()], pa.binary())], ["block", "facts"])
                held, total = block, new
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held]), pa.array([total.tobytes()], pa.binary())], ["block", "facts"])

    # blocks of sixteen parts first, then of all
    part = F.spark_partition_id() % 16
    once = found.withColumn("part", part).repartition("block", "part").sortWithinPartitions("block").select(
        "block", "facts").mapInArrow(merge, "block long, facts binary")
    return stage(once.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block long, facts binary"))


def column_counts(moments: DataFrame, columns: int) -> tuple[int, np.ndarray]:
    """The number of rows, and of each column's values: as many numbers as columns."""
    side, found, rows = -(-columns // WIDTH), np.zeros(columns), 0

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(raw.as_buffer(), float)
                if block == ROWS:
                    places, n = np.array([ROWS]), own
                elif block // side == block % side:
                    width = min(WIDTH, columns - block // side * WIDTH)
                    places, n = block // side * WIDTH + np.arange(width), np.diagonal(own.reshape(FACTS, width, width)[0])
                else:
                    continue
                yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(np.ascontiguousarray(n))], ["place", "n"])

    for row in moments.mapInArrow(counts, "place long, n double").collect():
        if row["place"] == ROWS:
            rows = int(row["n"])
        else:
            found[row["place"]] = row["n"]
    return rows, found


def correlations(moments: DataFrame, names: list[str]) -> DataFrame:
    """Rows ``col_i, col_j, corr`` for every ordered pair of columns, made on the executors.

    Null where a column does not vary over the rows that have both.
    """
    side, columns = -(-len(names) // WIDTH), len(names)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.array(names, object)
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                i, j = divmod(block, side)
                n, base_a, base_b, mean_a, mean_b, var_a, var_b, both = np.frombuffer(raw.as_buffer(), float).reshape(
                    FACTS, min(WIDTH, columns - i * WIDTH), -1)
                flat = (var_a <= ROUNDING * n * (base_a + mean_a)**2) | (var_b <= ROUNDING * n * (base_b + mean_b)**2)
                with np.errstate(divide="ignore", invalid="ignore"):
                    corr = np.clip(both / (np.sqrt(var_a) * np.sqrt(var_b)), -1, 1)
                if i == j:
                    corr = (corr + corr.T) / 2  # equal but for rounding
                    np.fill_diagonal(corr, 1)
                rows, others = np.indices(corr.shape)
                for turned in (False, True) if i != j else (False,):
                    a, b = (rows + i * WIDTH).ravel(), (others + j * WIDTH).ravel()
                    a, b = (b, a) if turned else (a, b)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(known[a], pa.string()), pa.array(known[b], pa.string()),
                         pa.array(corr.ravel(), pa.float64(), mask=flat.ravel())], ["col_i", "col_j", "corr"])

    return moments.filter(F.col("block") != ROWS).mapInArrow(pairs, "col_i string, col_j string, corr double")
