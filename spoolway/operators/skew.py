"""Running totals and joins that stay spread out when one group holds a large share of the rows."""

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolway.schema import ENTITY
from spoolway.scratch import stored

ROWS_PER_TASK = 4_000_000
#: Rows that one task sorts, for a window or a join: what a task holds follows from this, neither
#: from the number of rows nor from that of the session's shuffle partitions.
ROWS_PER_SORT = 250_000
#: Differences of two longs do not fit in a long.
WIDE = "decimal(20,0)"
ROWS_PER_FAN_OUT = 50_000
MAX_SMALL_ROWS = 100_000


def hot_groups(df: DataFrame, by: Sequence[str], order: Sequence[str] = (), limit: int = ROWS_PER_TASK) -> list[Row]:
    """Groups of more than ``limit`` rows, with the bounds of the order columns.

    At most rows/limit groups qualify, all of which are returned.
    """
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *_bounds(order))
    return sizes.where(F.col("rows") > limit).collect()


def _sizes(df: DataFrame, by: Sequence[str], order: Sequence[str], limit: int) -> tuple[int, list[Row], list[str]]:
    """The number of rows, the groups that ``hot_groups`` finds and the columns that tell groups apart, in one pass."""
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *_bounds(order))
    hot = F.collect_list(F.when(F.col("rows") > limit, F.struct(*sizes.columns)))
    same = [F.min(c).eqNullSafe(F.max(c)).alias(f"same_{i}") for i, c in enumerate(by)]
    found = sizes.agg(F.sum("rows").alias("found"), hot.alias("hot"), *same).head()
    return found["found"] or 0, found["hot"], [c for i, c in enumerate(by) if not found[f"same_{i}"]]


def _bounds(order: Sequence[str]) -> list[Column]:
    return [f(c).alias(f"{name}_{i}") for i, c in enumerate(order) for name, f in (("lo", F.min), ("hi", F.max))]


def entity_keys(*tables: DataFrame) -> list[str]:
    """What tells entities apart: the id, and the topic where all tables have it.

    Tenants have topics of their own, in which the same id is another entity. A table
    without a topic speaks of every topic.
    """
    return [name for name in ENTITY if all(name in df.columns for df in tables)]


def broadcast_small(df: DataFrame, most_rows: int = MAX_SMALL_ROWS) -> DataFrame:
    """Mark a side for broadcast if its rows, which are counted, are few; else leave the join to Spark."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def join_few(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a large side with one that usually has few rows, one per key, without a shuffle if it has.

    The right side is stored, so that it is computed once, and its rows are counted.
    """
    right = stored(right, "few")
    if right.count() <= MAX_SMALL_ROWS:
        return left.join(F.broadcast(right), list(on), how)
    return skew_join(left, right, on, how)


def spread(df: DataFrame, found: int, *by: str, rows: int = ROWS_PER_FAN_OUT) -> DataFrame:
    """Partition ``found`` rows ahead of a step that makes many rows of each.

    Their present size says nothing about that, hence an explicit number of partitions.
    """
    partitions = max(-(-found // rows), min(found, df.sparkSession.sparkContext.defaultParallelism), 1)
    return df.repartition(partitions, *by)


def same_group(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    totals: Mapping[str, Column],
    limit: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add running sums per group, in the order of the given whole-number columns.

    Ordinary groups use one window. A group of more than ``limit`` rows is cut into
    slots of its order range, each slot gets its own window, and the sums of the
    slots before it are added. Slots that are still too large (uneven or tied order
    values) are cut again. A slot is a function of the data alone, so a recomputed
    task gives the same numbers. The order has to be total within a group.
    """
    inputs = {f"_{name}_in": value for name, value in totals.items()}
    found, hot, apart = _sizes(df, by, order, limit)
    return _running(df.withColumns(inputs), list(by), list(order), list(totals), limit, 0, hot, found, apart).drop(*inputs)


def numbered(
    df: DataFrame, by: Sequence[str], order: Sequence[str], name: str, limit: int = ROWS_PER_TASK
) -> DataFrame:
    """Add the 1-based position of each row in its group, like ``row_number`` but spread out."""
    return running_totals(df, by, order, {name: F.lit(1).cast("bigint")}, limit)


def _running(
    df: DataFrame,
    by: list[str],
    order: list[str],
    names: list[str],
    limit: int,
    depth: int,
    hot: list[Row],
    found: int,
    apart: list[str],
) -> DataFrame:
    splits = [split for split in (_split(row, by, order, limit) for row in hot) if split]
    # a split at least halves a range, so this ends; groups of equal order values have none
    if not splits:
        window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        if found > ROWS_PER_SORT and apart:
            # a window takes no constant column into account, so rows dealt by one would be dealt again
            df = spread(df, found, *apart, rows=ROWS_PER_SORT // 2)
        return df.withColumns({name: F.sum(f"_{name}_in").over(window) for name in names})

    keys, slot = [f"_k{depth}_{i}" for i in range(len(by))], f"_slot{depth}"
    key_types = ", ".join(f"{key} {df.schema[column].dataType.simpleString()}" for key, column in zip(keys, by))
    picks = sorted({split[len(by)] for split in splits})
    whole = all(isinstance(df.schema[order[i]].dataType, T.IntegralType) for i in picks)
    # decimals are slow, and needed only for a range of longs that is no long
    kind = "bigint" if whole and all(width * slots < 2**62 for *_, width, slots in splits) else WIDE
    number = Decimal if kind == WIDE else int
    rows = [(*group, pick, number(lo), number(width)) for *group, pick, lo, width, _ in splits]
    split_table = df.sparkSession.createDataFrame(rows, f"{key_types}, _pick int, _lo {kind}, _width {kind}")
    picked = reduce(
        lambda rest, i: F.when(F.col("_pick") == i, F.col(order[i]).cast(kind)).otherwise(rest), picks, F.lit(None).cast(kind)
    )
    position = F.coalesce(F.call_function("div", picked - F.col("_lo"), F.col("_width")), F.lit(-1).cast("bigint"))
    slotted = (
        df.join(F.broadcast(split_table), same_group(by, keys), "left")
        .withColumn(slot, F.when(F.col("_width").isNotNull(), position))
        .drop(*keys, "_pick", "_lo", "_width")
    )

    # rows/limit slots at most, so this table is small whatever the number of rows
    slots = stored(
        slotted.where(F.col(slot).isNotNull())
        .groupBy(*by, slot)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            *_bounds(order),
            *[F.sum(f"_{name}_in").alias(f"_{name}_sum") for name in names],
        ),
        "slots",
    )
    again = slots.where(F.col("rows") > limit).collect()
    before = Window.partitionBy(*by).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    base = slots.select(
        *[F.col(column).alias(key) for column, key in zip(by, keys)],
        F.col(slot).alias("_slot_of"),
        *[F.sum(f"_{n}_sum").over(before).alias(f"_{n}_base") for n in names],
    )

    inner = _running(slotted, [*by, slot], order, names, limit, depth + 1, again, found, [*apart, slot])
    return (
        inner.join(F.broadcast(base), same_group([*by, slot], [*keys, "_slot_of"]), "left")
        .withColumns({name: F.col(name) + F.coalesce(F.col(f"_{name}_base"), F.lit(0)) for name in names})
        .drop(*keys, "_slot_of", slot, *[f"_{name}_base" for name in names])
    )


def _split(row: Row, by: list[str], order: list[str], limit: int) -> tuple | None:
    for i in range(len(order)):
        lo, hi = row[f"lo_{i}"], row[f"hi_{i}"]
        if lo is not None and hi > lo:
            slots = -(-2 * row["rows"] // limit)
            return (*[row[column] for column in by], i, lo, max(1, -(-(hi - lo + 1) // slots)), slots)
    return None


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    limit: int = ROWS_PER_TASK,
    hot: list[Row] | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Join a large side with a side that has one row per key.

    Rows of keys with more than ``limit`` rows on the left meet a broadcast of just
    those keys' right rows (rows/limit at most); all others take the usual join.
    ``hot`` names those keys if they are known already, and ``tasks`` the number of tasks
    of the usual join, where both sides are large.
    """
    on = list(on)
    hot = hot_groups(left, on, limit=limit) if hot is None else hot

    def usual(rows: DataFrame) -> DataFrame:
        if tasks is None:
            return rows.join(right, on, how)
        return rows.repartition(tasks, *on).join(right.repartition(tasks, *on), on, how)

    if not hot:
        return usual(left)
    keys = [f"_hot_{i}" for i in range(len(on))]
    key_types = ", ".join(f"{key} {left.schema[column].dataType.simpleString()}" for key, column in zip(keys, on))
    table = left.sparkSession.createDataFrame([tuple(row[column] for column in on) for row in hot], key_types)
    hot_keys = F.broadcast(table)
    matched = same_group(on, keys)
    hot_right = right.join(hot_keys, matched, "left_semi")
    hot_rows = left.join(hot_keys, matched, "left_semi").join(F.broadcast(hot_right), on, how)
    return hot_rows.unionByName(usual(left.join(hot_keys, matched, "left_anti")))
