"""Equi-joins that hold up under hot keys, and the wide feature table built from them."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataprop.functions.checks import (
    require_choice,
    require_columns,
    require_dataframe,
    require_disjoint,
)
from strataprop.functions.expressions import column
from strataprop.functions.runtime import fits_broadcast, settled, shuffle_partitions

SALT = "__salt"
RIGHT_SALT = "__right_salt"
RIGHT = ("right", "right_outer", "rightouter")
FULL = ("full", "full_outer", "fullouter", "outer")
# Join types whose result does not change when left rows are spread over copies of the right rows.
SPREADABLE = ("inner", "left", "left_outer", "leftouter", "left_semi", "leftsemi", "semi",
              "left_anti", "leftanti", "anti")
FILTERING = ("left_semi", "leftsemi", "semi", "left_anti", "leftanti", "anti")
# A key is left alone below this many rows, whatever its share.
HOT_ROWS = 1_000_000
# A key above twice an average partition can be hot, so half as many keys as partitions can be. The
# sketch reports as many, and keeps so many counters for each of them.
COUNTERS_PER_KEY = 20
FEWEST_KEYS = 100
# Pairs of rows that one piece of a key with many rows on both sides makes, unless there would be too many pieces.
PAIRS_PER_PIECE = 1_000_000
MOST_PIECES = 4_000


@dataclass(frozen=True)
class HotKeys:
    """Keys with far more rows than an average shuffle partition.

    The set is a performance hint: any set, even an empty or a wrong one, gives the same rows.
    ``frequent`` are the hashes of the most frequent keys, hot or not. ``rows`` are all rows of the side, and ``copies``
    those that the salts of its keys make of rows of the other side, as far as ``cut_pairs`` counted them.
    """

    per_key: dict[int, int]
    null_salts: int
    frequent: tuple[int, ...] = ()
    rows: int = 0
    copies: int = 0

    def __bool__(self) -> bool:
        return bool(self.per_key) or self.null_salts > 1

    @property
    def hashes(self) -> tuple[int, ...]:
        return tuple(self.per_key)

    @property
    def salts(self) -> int:
        """The number of salts of the hottest key."""
        return max(self.per_key.values(), default=1)

    def salts_of(self, key_hash: Column) -> Column:
        """How many salts the key has; 1 for keys that are not hot.

        Numbers of salts are powers of two, so that the expression has a branch for each power.
        """
        by_number: dict[int, list[int]] = {}
        for key, number in self.per_key.items():
            by_number.setdefault(number, []).append(key)
        salts = F.when(F.lit(False), F.lit(1))
        for number, keys in sorted(by_number.items()):
            salts = salts.when(key_hash.isin(keys), F.lit(number))
        return salts.otherwise(F.lit(1))


def _hash(df: DataFrame, on: list[str]) -> Column:
    """Hash of the key; integer keys are widened so that both sides of a join agree."""
    parts = []
    for name in on:
        integral = isinstance(df.schema[name].dataType, T.IntegralType)
        parts.append(column(name).cast("bigint") if integral else column(name))
    return F.xxhash64(*parts)


def _any_null(on: list[str]) -> Column:
    condition = column(on[0]).isNull()
    for name in on[1:]:
        condition = condition | column(name).isNull()
    return condition


def _comparable(left: DataFrame, right: DataFrame, on: list[str]) -> bool:
    """Whether equal keys also hash equally on both sides."""
    for name in on:
        a, b = left.schema[name].dataType, right.schema[name].dataType
        integral = isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType)
        if a.simpleString() != b.simpleString() and not integral:
            return False
    return True


def find_hot_keys(df: DataFrame, on: list[str], hot_rows: int | None = None) -> HotKeys:
    """One pass over the key columns with a sketch of fixed size and no shuffle of keys.

    A key is hot above ``hot_rows`` rows and above twice the rows of an average partition.
    """
    return _hot_keys(df, [on], hot_rows)[0]


def find_hot_keys_of(
    df: DataFrame, keys: list[str], hot_rows: int | None = None
) -> dict[str, HotKeys]:
    """The hot values of several single-column keys, all from one pass."""
    if not keys:
        return {}
    return dict(zip(keys, _hot_keys(df, [[key] for key in keys], hot_rows)))


def _hot_keys(df: DataFrame, keys: list[list[str]], hot_rows: int | None) -> list[HotKeys]:
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    partitions = shuffle_partitions(df.sparkSession)
    reported = max(partitions // 2, FEWEST_KEYS)
    counters = min(reported * COUNTERS_PER_KEY, 1_000_000)
    parts, facts = [], [F.count(F.lit(1)).alias("total")]
    for i, on in enumerate(keys):
        parts += [_any_null(on).alias(f"is_null_{i}"), _hash(df, on).alias(f"hash_{i}")]
        facts += [F.count_if(F.col(f"is_null_{i}")).alias(f"nulls_{i}"), F.expr(
            f"approx_top_k(if(is_null_{i}, null, hash_{i}), {reported}, {counters})").alias(f"top_{i}")]
    sketch = df.select(*parts).agg(*facts).first()
    average = sketch["total"] / partitions
    limit, piece = max(hot_rows, 2 * average), max(hot_rows, average)
    found = []
    for i in range(len(keys)):
        nulls = sketch[f"nulls_{i}"]
        top = [(r["item"], r["count"]) for r in sketch[f"top_{i}"] or [] if r["item"] is not None]
        found.append(HotKeys(
            per_key={item: 1 << math.ceil(math.log2(count / piece)) for item, count in top if count > limit},
            null_salts=math.ceil(nulls / piece) if nulls > limit else 1,
            frequent=tuple(item for item, count in top if count > 1), rows=sketch["total"]))
    return found


def cut_pairs(
    left: DataFrame, right: DataFrame, on: list[str], left_hot: HotKeys, right_hot: HotKeys
) -> tuple[HotKeys, HotKeys, int]:
    """More salts for keys whose pairs of rows are many, and the number of pieces that all pairs make.

    Pairs grow with the product of both sides, so a key can be no hotter than others in rows and still make most of
    the result. The most frequent keys of either side are counted exactly on both, in one pass each.
    """
    keys = sorted({*left_hot.frequent, *right_hot.frequent})
    if not keys:
        return left_hot, right_hot, 0

    def counts(df: DataFrame, name: str) -> DataFrame:
        hashed = df.filter(~_any_null(on)).select(_hash(df, on).alias("key"))
        return hashed.filter(F.col("key").isin(keys)).groupBy("key").agg(F.count(F.lit(1)).alias(name))

    # one row per frequent key
    counted = counts(left, "n_left").join(counts(right, "n_right"), "key").collect()
    piece = max(PAIRS_PER_PIECE, sum(n * m for _, n, m in counted) // MOST_PIECES)
    of_left, of_right, pieces, others = dict(left_hot.per_key), dict(right_hot.per_key), 0, 0
    left_copies = right_copies = 0
    for key, n, m in counted:
        a, b = of_left.get(key, 1), of_right.get(key, 1)
        while n * m > piece * a * b:
            # the side is cut that costs fewer copies of the other
            a, b = (2 * a, b) if m * a <= n * b else (a, 2 * b)
        of_left |= {key: a} if a > 1 else {}
        of_right |= {key: b} if b > 1 else {}
        left_copies, right_copies = left_copies + (n * b if b > 1 else 0), right_copies + (m * a if a > 1 else 0)
        pieces, others = (pieces + a * b, others) if a * b > 1 else (pieces, others + n * m)
    return (replace(left_hot, per_key=of_left, copies=right_copies),
            replace(right_hot, per_key=of_right, copies=left_copies), pieces + others // piece)


def _spread_by(df: DataFrame, on: list[str]) -> list[str]:
    return [f.name for f in df.schema if f.name not in on
            and isinstance(f.dataType, T.AtomicType)
            and not isinstance(f.dataType, T.VariantType)][:1]


def add_salt(
    df: DataFrame, on: list[str], hot: HotKeys, spread_by: list[str] | None = None,
    name: str = SALT,
) -> DataFrame:
    """Spread the rows of hot keys, and rows with a null key, over salt values.

    The salt depends on the number of the input partition and on the ``spread_by`` columns, by
    default the first other column, so that no more than one extra column is read. Both stay the
    same when a lost task runs again, and identical rows of different partitions still spread.
    """
    if spread_by is None:
        spread_by = _spread_by(df, on)
    spread = F.xxhash64(F.spark_partition_id(), *[column(c) for c in spread_by])
    salt = F.when(_any_null(on), F.pmod(spread, F.lit(hot.null_salts)))
    own = F.pmod(spread, hot.salts_of(_hash(df, on))) if hot.per_key else F.lit(0)
    return df.withColumn(name, salt.otherwise(own).cast("int"))


def add_all_salts(
    df: DataFrame, on: list[str], hot: HotKeys, name: str = SALT
) -> DataFrame:
    """Give the rows of hot keys one copy per salt value. Null keys match nothing and are left out."""
    df = df.filter(~_any_null(on))
    if not hot.per_key:
        return df.withColumn(name, F.lit(0))
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), hot.salts_of(_hash(df, on)) - 1)))


def _dealt(df: DataFrame, own: HotKeys, other: HotKeys) -> DataFrame:
    """Rows in even tasks, if the salts of the other side make more copies of them than one task should make.

    A table of few parts, or with the rows of a key in few of them, would leave all copies to few tasks. Many more tasks
    than that would only cut the shuffle of the copies into small blocks.
    """
    partitions = shuffle_partitions(df.sparkSession)
    if other.copies <= max(HOT_ROWS, 2 * own.rows / partitions):
        return df
    return df.repartition(min(partitions, math.ceil((own.rows + other.copies) / HOT_ROWS)))


def equi_join(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    how: str = "left",
    *,
    hot: HotKeys | None = None,
    spread_by: list[str] | None = None,
    hot_rows: int | None = None,
    repeated_right: bool = False,
) -> DataFrame:
    """Join on shared column names; the key appears once in the result.

    A right side under the broadcast threshold is left to Catalyst, which broadcasts it. Beyond
    that the left rows of hot keys are spread over copies of the matching right rows. Null keys
    match nothing. Repeated right keys repeat left rows.

    ``hot`` passes hot keys that are already known, which saves the pass that looks for them.
    ``repeated_right`` also looks for keys with very many rows on the right, or with very many pairs of rows, and
    spreads those.

    Lazy, but that a right side beyond the threshold starts a job that counts the left keys, and with
    ``repeated_right`` jobs that count the keys of both sides.
    """
    require_dataframe(left, "left")
    require_dataframe(right, "right")
    on = [on] if isinstance(on, str) else list(on)
    require_columns(left, on, "left")
    require_columns(right, on, "right")
    if how in (*RIGHT, *FULL) and _comparable(left, right, on) and not (
            fits_broadcast(left) and fits_broadcast(right)):
        return _keep_right(left, right, on, how, hot, spread_by, hot_rows)
    if how in FILTERING:
        right = right.select(*[column(c) for c in on]).distinct()
    spreadable = how in SPREADABLE and _comparable(left, right, on)
    shuffled = not fits_broadcast(right)
    if hot is None and spreadable and shuffled:
        hot = find_hot_keys(left, on, hot_rows)
    if repeated_right and spreadable and shuffled and how not in FILTERING:
        left_hot, right_hot, pieces = cut_pairs(left, right, on, hot, find_hot_keys(right, on, hot_rows))
        if right_hot.per_key or left_hot.per_key != hot.per_key or pieces > len(left_hot.per_key) + 1:
            return _spread_both(left, right, on, how, left_hot, right_hot, spread_by, pieces)
    if not (spreadable and hot):
        return left.join(right, on, how)
    salted, copies = add_salt(left, on, hot, spread_by), add_all_salts(right, on, hot)
    return salted.join(copies, [*on, SALT], how).drop(SALT)


def _keep_right(
    left: DataFrame, right: DataFrame, on: list[str], how: str, hot: HotKeys | None,
    spread_by: list[str] | None, hot_rows: int | None,
) -> DataFrame:
    """Right and full joins from joins that can be spread, with hot keys on either side."""
    columns = [*on, *[c for df in (left, right) for c in df.columns if c not in on]]
    if how in RIGHT:
        joined = equi_join(right, left, on, "left", hot_rows=hot_rows, repeated_right=True)
    else:
        joined = equi_join(left, right, on, "left", hot=hot, spread_by=spread_by,
                           hot_rows=hot_rows, repeated_right=True).unionByName(
            equi_join(right, left, on, "left_anti", hot_rows=hot_rows), allowMissingColumns=True)
    return joined.select(*[column(c) for c in columns])


def _spread_both(
    left: DataFrame, right: DataFrame, on: list[str], how: str, left_hot: HotKeys,
    right_hot: HotKeys, spread_by: list[str] | None, pieces: int,
) -> DataFrame:
    """Hot right rows are spread too, over copies of the left rows of their keys.

    The number of tasks follows the pieces, not the bytes of the sides: these say little of the pairs to be made.
    A copied left row may miss its matches in one piece and find them in another, so the rows
    without any match are told apart by an anti-join.
    """
    kinds = {c: left.schema[c].dataType for c in on}
    narrow = [c for c in on if kinds[c] != right.schema[c].dataType]  # integers of different width

    def widened(df: DataFrame) -> DataFrame:
        return df.filter(~_any_null(on)).withColumns({c: column(c).cast("bigint") for c in narrow})

    salted, copies = _dealt(widened(left), left_hot, right_hot), _dealt(widened(right), right_hot, left_hot)
    cell = list(on)
    # A salt that is 0 everywhere would drop out of the join's keys, and Spark would shuffle once more.
    if left_hot.per_key:
        salted, copies = add_salt(salted, on, left_hot, spread_by), add_all_salts(copies, on, left_hot)
        cell.append(SALT)
    if right_hot.per_key:
        copies = add_salt(copies, on, right_hot, _spread_by(right, on), RIGHT_SALT)
        salted = add_all_salts(salted, on, right_hot, RIGHT_SALT)
        cell.append(RIGHT_SALT)
    tasks = shuffle_partitions(left.sparkSession) + pieces
    by = [column(c) for c in cell]
    # Catalyst does not see how much larger the copies make a side, so it is kept from broadcasting them.
    matched = salted.repartition(tasks, *by).join(
        copies.repartition(tasks, *by).hint("merge"), cell, "inner").drop(SALT, RIGHT_SALT)
    matched = matched.withColumns({c: column(c).cast(kinds[c]) for c in narrow})
    if how == "inner":
        return matched
    unmatched = equi_join(left, right, on, "left_anti", hot=left_hot, spread_by=spread_by)
    return matched.unionByName(unmatched, allowMissingColumns=True)


def unique_dimension(
    dimension: DataFrame, key: str, on_duplicate: str = "keep", order: list[str] | None = None
) -> DataFrame:
    """Decide what repeated dimension keys mean.

    ``keep`` leaves them, so their entity rows repeat. ``error`` refuses them. ``first`` keeps
    the row that comes first by ``order``, then by the other columns.
    """
    require_choice(on_duplicate, ("keep", "error", "first"), "on_duplicate")
    require_columns(dimension, [key, *(order or [])], "dimension")
    if on_duplicate == "keep":
        return dimension
    if on_duplicate == "error":
        repeated = (
            dimension.groupBy(column(key)).count()
            .filter((F.col("count") > 1) & column(key).isNotNull())
            .select(column(key)).take(5)
        )
        if repeated:
            found = ", ".join(str(r[0]) for r in repeated)
            raise ValueError(f"dimension repeats values of {key!r}, among them: {found}")
        return dimension
    if not order:
        raise ValueError("on_duplicate='first' needs the columns to order by")
    others = [c for c in dimension.columns if c != key]
    ranking = F.struct(*[column(c) for c in [*order, *[o for o in others if o not in order]]])
    row = F.struct(*[column(c) for c in others])
    picked = dimension.groupBy(column(key)).agg(F.min_by(row, ranking).alias("__row"))
    return picked.select(column(key), "__row.*")


def feature_table(
    profile: DataFrame,
    performance: DataFrame,
    dimension: DataFrame,
    target: DataFrame | None = None,
    *,
    key: str,
    dim_key: str,
    on_duplicate: str = "keep",
    dim_order: list[str] | None = None,
    hot_rows: int | None = None,
    repeated: bool = False,
) -> DataFrame:
    """One wide row per profile row: profile, performance, dimension and, if given, the target.

    ``repeated`` says that performance or target may hold very many rows of one key, each of
    which repeats the profile row. Pre-aggregated tables do not need it.

    Left joins on different keys commute, so the entity joins come first and share one shuffle
    of the profile table; the dimension is attached last, by broadcast when it is small. A dimension that is
    itself a join of small tables is written first, so that its true size decides.
    """
    for frame, name in ((profile, "profile"), (performance, "performance"),
                        (dimension, "dimension")):
        require_dataframe(frame, name)
    require_columns(profile, [key], "profile")
    require_columns(performance, [key], "performance")
    entities = [("performance", performance)]
    if target is not None:
        require_dataframe(target, "target")
        require_columns(target, [key], "target")
        entities.append(("target", target))
    dimension = unique_dimension(dimension, dim_key, on_duplicate, dim_order)

    on = [key]
    shuffled = any(not fits_broadcast(right) for _, right in entities)
    comparable = all(_comparable(profile, right, on) for _, right in entities)
    hot = find_hot_keys(profile, on, hot_rows) if shuffled and comparable else None
    share_salt = bool(hot) and not repeated
    spread_by = [dim_key] if dim_key in profile.columns else None
    wide = add_salt(profile, on, hot, spread_by) if share_salt else profile
    for name, right in entities:
        require_disjoint(wide, right, on, name)
        if share_salt:
            wide = wide.join(add_all_salts(right, on, hot), [*on, SALT], "left")
        elif repeated:
            wide = equi_join(wide, right, on, "left", hot=hot, hot_rows=hot_rows,
                             repeated_right=True)
        else:
            wide = wide.join(right, on, "left")
    wide = wide.drop(SALT)

    require_columns(wide, [dim_key], "profile or performance")
    require_disjoint(wide, dimension, [dim_key], "dimension")
    hot, dimension = None, settled(dimension)
    if not fits_broadcast(dimension):
        if dim_key in profile.columns:
            hot = find_hot_keys(profile, [dim_key], hot_rows)
        else:
            # Entities without a performance row add null keys that the table itself does not show.
            hot = replace(
                find_hot_keys(performance, [dim_key], hot_rows),
                null_salts=shuffle_partitions(profile.sparkSession),
            )
    wide = equi_join(wide, dimension, dim_key, "left", hot=hot, spread_by=[key])

    ordered = [key]
    for frame in (profile, performance, dimension, *([target] if target is not None else [])):
        ordered += [c for c in frame.columns if c not in ordered]
    return wide.select(*[column(c) for c in ordered])
