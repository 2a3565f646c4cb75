"""Near-duplicate texts by Jaccard similarity of their word n-gram sets, found exactly.

Two sets of sizes x and y with a similarity of t or more share an element of their *prefixes*: the
first ``x - ceil(t * x) + 1`` elements in one global order. With rare elements first most prefixes
share nothing with any other. The order is by a count sketch of fixed size over all texts, ties by
the element's hash; any order is right, and a truer count only makes it cheaper.

Equal sets are one class, and classes are compared, not rows. Classes that share a prefix element
are first compared with one hub of that element only, the one with the fewest rarer elements; the links found collapse groups of copies
into components. What is left are elements that still meet in two components: only their pairs
across components are compared, each once. A pair inside one component cannot change the result.

Rows of one element meet within bands of set sizes, since sizes far apart cannot link; an element with
many rows in a band has its partners copied to several tasks. Joins on a class that a third of all rows
or pairs may have are spread by ``equi_join``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataprop.functions.runtime import fits_broadcast, stage
from strataprop.llm.batches import arrow_function, bound_batches
from strataprop.llm.components import components
from strataprop.llm.names import free_name
from strataprop.llm.vectors import SCHEMA as VECTOR_SCHEMA
from strataprop.llm.vectors import cells, combined, marked, marks, vector_rows
from strataprop.llm.words import WHITE, blocks, hash_ranges, mix, ngrams
from strataprop.operators.joins import equi_join, find_hot_keys_of

#: Cells of the count sketch that orders the elements (8 MB in each worker, 4 MB from each task).
SKETCH_BITS = 21
#: Rows of one prefix element for one task; an element that the sketch puts above it is salted.
HOT_ROWS = 20_000
#: Parts of the hash space whose element counts the suffix filter compares.
PARTS = 256


def _sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted set of n-gram hashes of each text; all words as one if they are fewer."""
    for block in blocks(column):
        starts, ends, bounds = block.ranges(WHITE)
        hashes = hash_ranges(block.sums(fold=True), starts, ends)
        at, grams = ngrams(hashes, bounds, n)
        grams = grams.view(np.int64)
        edges = np.searchsorted(at, bounds)
        for k in range(block.texts()):
            words = int(bounds[k + 1] - bounds[k])
            if words >= n:
                yield np.unique(grams[edges[k] : edges[k + 1]])
            elif words:
                _, whole = ngrams(hashes[bounds[k] : bounds[k + 1]], np.array([0, words]), words)
                yield whole.view(np.int64)
            else:
                yield grams[:0]


def _class_of(found: np.ndarray) -> int:
    """A 64-bit name of a set: two of n different sets share one with a chance below n^2 / 2^65."""
    values = found.view(np.uint64)
    sums = np.array([mix(values).sum(), mix(values ^ np.uint64(0x5851F42D4C957F2D)).sum()], np.uint64)
    sums = mix(sums + np.uint64(len(values)))
    return int(mix(sums[:1] * np.uint64(3) ^ sums[1:]).view(np.int64)[0])


def _class_rows(docs: DataFrame, n: int) -> DataFrame:
    """Set size and class of each row, and, as rows of another kind, the counts for the sketch."""
    names = [docs.columns[0], "n_shingles", "class", "task", "slice", "bytes"]

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            sizes, ids = [], []
            for found in _sets(batch.column(1), n):
                sizes.append(len(found))
                ids.append(_class_of(found) if len(found) else None)
                np.add.at(counts, cells(found, SKETCH_BITS), 1)
            empty = [pa.nulls(len(sizes), t) for t in (pa.int64(), pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), *empty], names)
        counts = np.minimum(counts, 65_535).astype(np.uint16)  # only the order of elements depends on it
        for part in vector_rows(TaskContext.get().partitionId(), counts) if kind else ():
            none = pa.nulls(len(part), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.nulls(len(part), kind), none, none, *part.columns], names)

    kind = docs.schema[0].dataType.simpleString()
    return docs.mapInArrow(
        arrow_function(classify), f"`{docs.columns[0]}` {kind}, n_shingles long, class long, {VECTOR_SCHEMA}")


def _prefix_rows(docs: DataFrame, n: int, t: Fraction, sketch) -> DataFrame:
    """A row for each prefix element of each class: place is 2^32 times its rank, plus the set size."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = sketch.value, set()
        usual = 2 * int(counts.mean())
        for batch in batches:
            tokens, salts, ids, places = [], [], [], []
            for found in _sets(batch.column(1), n):
                if not len(found) or (name := _class_of(found)) in seen:
                    continue
                seen.add(name)
                size = len(found)
                length = size + (-size * t.numerator) // t.denominator + 1
                rank = counts[cells(found, SKETCH_BITS)].astype(np.int64)
                # the set is sorted by hash, so a stable sort by count breaks ties by hash
                first = np.argsort(rank, kind="stable")[:length]
                tokens.append(found[first])
                spread = np.maximum(rank[first] - usual, 0) // HOT_ROWS
                salts.append(np.where(spread > 0, 1 + (name % (spread + 1)), 0))
                ids.append(np.full(length, name, np.int64))
                places.append((np.arange(length, dtype=np.int64) << 32) + size)
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (tokens, salts, ids, places)],
                    ["token", "salt", "class", "place"])

    return docs.mapInArrow(arrow_function(emit), "token long, salt long, class long, place long")


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by token, salt, place and class: the rows whose token two classes share.

    Each carries the first class of its token as ``hub``: the one with fewest rarer elements. Only that first row is kept between
    batches, so a token with very many rows needs no memory. Rows of a salted token are all kept.
    """
    held, told = None, False
    for batch in batches:
        rows = np.stack([batch.column(k).to_numpy() for k in range(4)])
        before = held is not None
        if before:
            rows = np.concatenate([held, rows], axis=1)
        if not rows.shape[1]:
            continue
        fresh = np.ones(rows.shape[1], bool)
        fresh[1:] = (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)
        rows = rows[:, fresh]
        new = np.ones(rows.shape[1], bool)
        new[1:] = (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, rows.shape[1]))
        hub = np.repeat(first, sizes)
        keep = np.repeat(sizes > 1, sizes) | (rows[1] > 0)
        met_last = bool(sizes[-1] > 1 or rows[1, -1] > 0)
        if before and told:
            keep[0] = False
        told = met_last or (told and before and len(first) == 1)
        held = rows[:, first[-1] : first[-1] + 1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (rows[0, keep], rows[1, keep], rows[2, keep], rows[3, keep],
                                   rows[2, hub[keep]], rows[3, hub[keep]])],
            ["token", "salt", "class", "place", "hub", "hub_place"])


def _may_link(one: str, two: str, t: Fraction) -> Column:
    """Length and positional filter: can the sets overlap enough from this shared element on?

    Sets similar enough have a first shared element, with nothing shared before it; there this holds.
    So a pair that fails it at one element is not lost, and most pairs come up only once or twice.
    """
    size, size2 = (F.col(c).bitwiseAND(0xFFFFFFFF) for c in (one, two))
    rest, rest2 = (size - F.shiftright(one, 32), size2 - F.shiftright(two, 32))
    p, q = t.numerator, t.denominator
    return F.least(rest, rest2) * F.lit(p + q) >= (size + size2) * F.lit(p)


def _band(place: str, t: Fraction) -> Column:
    """Band of the set size: sets that are similar enough lie in one band or in two neighbouring ones.

    A hair wider than the ratio ``t`` of their sizes, so that rounding cannot put them further apart.
    """
    width = max(-math.log(t), 1e-6) * (1 + 1e-9)
    return F.floor(F.log(F.col(place).bitwiseAND(0xFFFFFFFF).cast("double")) / F.lit(width))


def _across_pairs(across: DataFrame, t: Fraction) -> DataFrame:
    """Pairs a, b of classes of different components that share an element and may link, each once.

    ``across`` has ``token``, ``class``, ``place`` and ``root``, and is written. A row meets rows of its own band and of
    the next one. Where a token has many rows in a band these are dealt out over parts by their class, and
    what they meet is copied to each part, so no task has all the pairs of a token.
    """
    rows = across.withColumn("band", _band("place", t))
    many = stage(rows.groupBy("token", "band").agg(F.count(F.lit(1)).alias("rows")).filter(
        F.col("rows") > HOT_ROWS).select("token", "band", F.ceil(F.col("rows") / HOT_ROWS).alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    one = rows.join(many, ["token", "band"], "left").select(
        "token", "band", F.pmod(F.xxhash64("class"), parts).alias("part"), "class", "place", "root")
    shifted = rows.select("token", F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("band"),
                          F.col("class").alias("class2"), F.col("place").alias("place2"), F.col("root").alias("root2"),
                          F.col("band").alias("band2"))
    two = shifted.join(many, ["token", "band"], "left").withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("parts")
    met = one.join(two, ["token", "band", "part"])
    # within a band each pair comes up twice, across bands once
    once = (F.col("class") < F.col("class2")) | (F.col("band") < F.col("band2"))
    return met.filter(once & (F.col("root") != F.col("root2")) & _may_link("place", "place2", t)).select(
        F.least("class", "class2").alias("a"), F.greatest("class", "class2").alias("b")).distinct()


def _from_sets(docs: DataFrame, n: int, holders: DataFrame, classes: DataFrame, schema: str, batch_of) -> DataFrame:
    """``batch_of`` the sets of the given classes, each class once.

    ``docs`` has a hash of each row's key and its text; ``holders`` gives one such hash per class. A
    filter of fixed size over the hashes lets only few other rows be taken apart again.
    """
    rows = holders.join(classes, "class", "left_semi").select("row")
    wanted = docs.sparkSession.sparkContext.broadcast(marks(rows))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = wanted.value, set()
        for batch in batches:
            texts = batch.column(1).filter(pa.array(marked(bits, batch.column(0).to_numpy())))
            ids, sets = [], []
            for found in _sets(texts, n):
                if len(found) and (name := _class_of(found)) not in seen:
                    seen.add(name)
                    ids.append(name)
                    sets.append(found)
                if len(ids) >= 500:
                    yield batch_of(ids, sets)
                    ids, sets = [], []
            if ids:
                yield batch_of(ids, sets)

    found = docs.mapInArrow(arrow_function(emit), schema)
    made = stage(found.join(classes, "class", "left_semi").dropDuplicates(["class"]))
    wanted.destroy()
    return made


def _profile_batch(ids: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
    parts = [np.bincount((x.view(np.uint64) >> np.uint64(56)).astype(np.int64), minlength=PARTS) for x in sets]
    return pa.RecordBatch.from_pydict({
        "class": pa.array(ids, pa.int64()), "parts": pa.array([x.astype(np.uint32).tobytes() for x in parts])})


def _set_batch(ids: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "class": pa.array(ids, pa.int64()), "grams": pa.array(sets, pa.list_(pa.int64()))})


def _verified(pairs: DataFrame, docs: DataFrame, n: int, holders: DataFrame, t: Fraction) -> DataFrame:
    """Pairs a, b that the suffix filter leaves, each with whether its similarity is t or more."""
    p, q = t.numerator, t.denominator

    def both(pairs: DataFrame, schema: str, batch_of, column: str) -> DataFrame:
        pairs = stage(pairs)
        classes = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
        found = _from_sets(docs, n, holders, classes, schema, batch_of)
        sides = [found.select(F.col("class").alias(x), F.col(column).alias(f"of_{x}")) for x in "ab"]
        # a hub is in as many pairs as its element has classes, and its set goes along with each of them
        hot = {} if fits_broadcast(sides[0]) else find_hot_keys_of(pairs, ["a", "b"], HOT_ROWS)
        joined = equi_join(pairs, sides[1], "b", "inner", hot=hot.get("b"))
        joined = equi_join(joined, sides[0], "a", "inner", hot=hot.get("a"), spread_by=["b"])
        return joined.select("a", "b", "of_a", "of_b")

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Elements of different parts differ: the smaller counts bound the overlap."""
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(-1, PARTS).astype(np.int64)
                    for k in (2, 3))
            fits = np.minimum(x, y).sum(axis=1) * (p + q) >= (x.sum(axis=1) + y.sum(axis=1)) * p
            yield batch.select(["a", "b"]).filter(pa.array(fits))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                same = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                linked.append(same * q >= p * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    left = both(pairs, "class long, parts binary", _profile_batch, "parts").mapInArrow(arrow_function(sift), "a long, b long")
    sets = both(left, "class long, grams array<long>", _set_batch, "grams")
    return stage(sets.mapInArrow(arrow_function(compare), "a long, b long, linked boolean"))


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, similarity: str = "0.75",
) -> DataFrame:
    """``n_shingles`` and ``component_id`` of every row.

    A row's set has the n-grams of its words (A-Z lower-cased, split at ASCII white space), or all
    words as one when they are fewer than ``n``. Rows link when intersection / union is at least
    ``similarity``; ``component_id`` is the smallest key reachable by links, the row's own included.
    A null, empty or blank text has an empty set and links with nothing; such a row's component is
    its own key. A null key takes part, but names no component unless all keys in it are null (then
    null). Rows with equal texts link, so repeated rows share a component; each row is returned.
    An empty table gives no rows; other columns are not carried.
    """
    t = Fraction(similarity)
    if not 0 < t <= 1 or n < 1:
        raise ValueError("similarity lies above 0, up to 1, and n is 1 or more")
    spark = docs.sparkSession
    bound_batches(spark)
    docs = docs.select(key, text)
    found = stage(_class_rows(docs, n))
    rows = found.filter("task is null").select(key, "n_shingles", "class")
    counts = combined(found.filter("task is not null").select("task", "slice", "bytes"), 1 << SKETCH_BITS)
    sketch = spark.sparkContext.broadcast(np.minimum(counts, (1 << 31) - 1).astype(np.int32))

    prefixes = _prefix_rows(docs, n, t, sketch)
    met = stage(prefixes.repartition("token", "salt").sortWithinPartitions("token", "salt", "place", "class")
                .mapInArrow(arrow_function(_meetings), "token long, salt long, class long, place long, hub long, "
                                       "hub_place long"))
    sketch.destroy()
    holders = stage(rows.filter("class is not null").groupBy("class").agg(
        F.min(F.xxhash64(key)).alias("row"), F.min(key).alias("low")))
    hashed = docs.select(F.xxhash64(key).alias("row"), text)

    salted = met.filter("salt > 0 and class = hub")
    over = salted.groupBy("token").agg(F.min_by(F.struct("class", "place"), F.struct("place", "class")).alias("top"))
    of_hubs = salted.select("token", "class", "place").join(over, "token").select(
        "class", "place", F.col("top.class").alias("hub"), F.col("top.place").alias("hub_place"))
    stars = met.select("class", "place", "hub", "hub_place").union(of_hubs)
    pairs = stars.filter("class <> hub").filter(_may_link("place", "hub_place", t)).select(
        F.least("class", "hub").alias("a"), F.greatest("class", "hub").alias("b")).distinct()
    known = _verified(pairs, hashed, n, holders, t)
    edges = known.filter("linked").select("a", "b")
    roots = components(edges)

    named = stage(met.select("token", "class", "place").join(
        roots.select(F.col("node").alias("class"), "root"), "class", "left")
        .withColumn("root", F.coalesce("root", "class")))
    apart = named.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter(
        "lo <> hi").select("token")
    across = stage(equi_join(named, apart, "token", "left_semi"))
    rest = stage(_across_pairs(across, t).join(known.select("a", "b"), ["a", "b"], "left_anti"))
    if rest.limit(1).count():
        more = _verified(rest, hashed, n, holders, t).filter("linked").select("a", "b")
        roots = components(edges.union(more))

    under = stage(holders.join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
                  .withColumn("root", F.coalesce("root", "class")))
    lows = stage(under.groupBy("root").agg(F.min("low").alias("component_id")))
    # a component, and a class of copies, can have a third of all rows
    named = stage(equi_join(under, lows, "root", "inner").select("class", "component_id"))
    return equi_join(rows, named, "class", "left").select(
        key, "n_shingles",
        F.when(F.col("class").isNull(), F.col(key)).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, similarity: str = "0.75") -> DataFrame:
    """All columns of one row of each group of near duplicates: the one with the smallest key.

    A null key is the largest; of one key's texts the one with the smallest hash stays, of repeated rows any.
    Rows without a word are in no group and all stay.
    """
    blank = ~F.coalesce(docs[text].rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kind = docs.schema[key].dataType
    name = F.struct(docs[key].isNull().alias("none"), F.coalesce(docs[key], F.lit(0).cast(kind)).alias("key"),
                    F.xxhash64(docs[text]).alias("text"))
    label = free_name(docs, "__name")
    # repeated rows go before the shuffle; the join then finds the rows where they are
    named = docs.filter(~blank).withColumn(label, name).dropDuplicates([label])
    groups = near_duplicates(docs.filter(~blank).select(name.alias("name"), docs[text].alias("text")),
                             "name", "text", n, similarity)
    first = groups.filter(F.col("name") == F.col("component_id")).select(F.col("name").alias(label)).distinct()
    return named.join(first, label, "left_semi").select(*[named[c] for c in docs.columns]).unionByName(docs.filter(blank))
