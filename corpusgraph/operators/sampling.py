"""Top rows, samples and row numbers that do not depend on partitioning."""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from corpusgraph.sources.scratch import materialize, materialize_measured


# Rows that are few enough to be sorted in one task, key and order alone.
SORTED_ROWS = 1 << 17
# Values at which one pass counts the rows before them.
CUTS = 24
# Rows that are worth a range of their own when rows are numbered.
RANGE_ROWS = 1 << 13


class _Order:
    """The order of rows by a column, NULLs last, and then by key, NULLs first."""

    def __init__(self, by: Column, key: Column, descending: bool) -> None:
        self._columns = [
            (by.isNull().cast("int"), False),
            (by, descending),
            (key.isNotNull().cast("int"), False),
            (key, False),
        ]

    def sort(self) -> list[Column]:
        return [c.desc() if down else c.asc() for c, down in self._columns]

    def before(self, row: Row, or_at: bool = False) -> Column:
        """Rows that come before the row with the values ``_by`` and ``_key``."""
        by, key = row["_by"], row["_key"]
        values = [int(by is None), by, int(key is not None), key]
        found = F.lit(or_at)
        for (column, down), value in reversed(list(zip(self._columns, values, strict=True))):
            if value is not None:
                ahead = column > F.lit(value) if down else column < F.lit(value)
                found = ahead | ((column == F.lit(value)) & found)
        return found


def _nth(stored: DataFrame, order: _Order, n: int, total: int) -> tuple[Row, int]:
    """The ``n``-th row of stored ``_by`` and ``_key``, and how many come before its equals.

    Every pass draws some of the rows that are left as cuts and counts the rows before and
    up to each of them. What remains lies between two cuts; a value that many rows share
    is soon a cut itself. No row is shuffled but the drawn ones, until few are left.
    """
    left, need, passed = stored, n, 0
    while total > SORTED_ROWS:
        drawn = left.sample(min(1.0, 4 * CUTS / total), seed=need & 0xFFFF).limit(16 * CUTS)
        found = drawn.distinct().orderBy(*order.sort()).collect() or left.take(1)
        step = max(1, len(found) // CUTS)
        cuts = found[step // 2 :: step][:CUTS]
        counted = left.agg(
            *[F.count_if(order.before(c)).alias(f"b{i}") for i, c in enumerate(cuts)],
            *[F.count_if(order.before(c, True)).alias(f"t{i}") for i, c in enumerate(cuts)],
        ).first()
        reached = [i for i in range(len(cuts)) if counted[f"t{i}"] >= need]
        last = reached[0] if reached else len(cuts)
        if reached and counted[f"b{last}"] < need:
            return cuts[last], passed + counted[f"b{last}"]
        below = counted[f"t{last - 1}"] if last else 0
        above = counted[f"b{last}"] if reached else total
        if last:
            left = left.where(~order.before(cuts[last - 1], True))
        if reached:
            left = left.where(order.before(cuts[last]))
        need, passed, total = need - below, passed + below, above - below
    row = left.orderBy(*order.sort()).offset(need - 1).first()
    return row, passed + left.where(order.before(row)).count()


def _any(rows: DataFrame, n: int) -> DataFrame:
    """``n`` of equal rows, without sending them to one task: as many of each partition as
    are still wanted after the partitions before it."""
    spark = rows.sparkSession
    marked = materialize(rows.withColumn("_mark", F.monotonically_increasing_id()), "equal")
    part = F.shiftright("_mark", 33)
    sizes = marked.groupBy(part.alias("_part")).count().orderBy("_part").collect()
    starts = accumulate((row["count"] for row in sizes), initial=0)
    wanted = [(row["_part"], max(0, n - start)) for row, start in zip(sizes, starts)]
    # One row per partition.
    quota = spark.createDataFrame(wanted, "_part bigint, _wanted bigint")
    place = F.col("_mark").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        marked.withColumn("_part", part)
        .join(F.broadcast(quota), "_part")
        .where(place < F.col("_wanted"))
        .drop("_mark", "_part", "_wanted")
    )


def top_n(
    df: DataFrame, key: str, n: int, by: Column | None = None, descending: bool = False
) -> DataFrame:
    """The first ``n`` rows by ``by`` and then key, for an ``n`` of any size. NULLs of
    ``by`` come last; repeated and NULL keys are rows like others, and of equal rows any
    is as good.

    Key and order alone are written out, and the n-th of them is found by counting. All
    rows before it are in the result, from wherever they are; only if others are equal to
    it in order and key, as many of these as are needed.
    """
    rank = F.lit(0) if by is None else by
    narrow = df.select(rank.alias("_by"), F.col(key).alias("_key"))
    stored, seen = materialize_measured(narrow, "keys", n=F.count(F.lit(1)))
    if n >= seen["n"]:
        return df
    if n <= 0:
        return df.where(F.lit(False))
    last, before = _nth(stored, _Order(F.col("_by"), F.col("_key"), descending), n, seen["n"])
    order = _Order(rank, F.col(key), descending)
    up_to = df.where(order.before(last, True))
    equal = stored.where(F.col("_by").eqNullSafe(last["_by"]) & F.col("_key").eqNullSafe(last["_key"]))
    if equal.count() == n - before:
        return up_to
    ties = up_to.where(~order.before(last))
    return df.where(order.before(last)).unionByName(_any(ties, n - before))


def seeded_sample(df: DataFrame, key: str, n: int = 500, seed: int = 42) -> DataFrame:
    """``n`` rows in the order of a seeded hash of the key, all when there are fewer."""
    code = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return top_n(df, key, n, code)


def with_position(df: DataFrame, *order: str, name: str = "position") -> DataFrame:
    """Number the rows 0, 1, … in the order of unique keys, without one global task.

    Rows are range-partitioned and sorted; a row's number is its place in its
    partition plus the sizes of the partitions before. Only those sizes, one number
    per partition, pass through the driver.
    """
    spark = df.sparkSession
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id holds the partition in its upper 31 bits and the place in the lower 33.
    marked = materialize(ordered.withColumn("_mark", F.monotonically_increasing_id()))
    part: Column = F.shiftright("_mark", 33)
    sizes = marked.groupBy(part.alias("_part")).count().orderBy("_part").collect()
    starts = accumulate((row["count"] for row in sizes), initial=0)
    offsets = spark.createDataFrame(
        [(row["_part"], start) for row, start in zip(sizes, starts)],
        "_part bigint, _start bigint",
    )
    place = F.col("_mark").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        marked.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_start") + place)
        .drop("_mark", "_part", "_start")
    )


@dataclass(frozen=True)
class Positions:
    """Numbers 0, 1, … of rows in the order of a key, kept without the rows.

    The keys alone are range-partitioned, sorted and stored. Rows are numbered later by the
    same ranges: they move once, and are not stored on the way.
    """

    key: str
    stored: DataFrame
    starts: list[int]
    lowest: list  # keys of all ranges but the first

    @classmethod
    def of(cls, df: DataFrame, key: str) -> Positions:
        keys, seen = materialize_measured(df.select(key), "keys", n=F.count(F.lit(1)))
        most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        number = max(1, min(most, math.ceil(seen["n"] / RANGE_ROWS)))
        ordered = keys.repartitionByRange(number, key).sortWithinPartitions(key)
        marked = ordered.withColumn("_mark", F.monotonically_increasing_id())
        stored = materialize(marked, "positions")
        part = F.shiftright("_mark", 33).alias("_part")
        # One row per partition; NULLs are lowest and so in the first.
        sizes = stored.groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("low"))
        ranges = sizes.orderBy("_part").collect()
        starts = list(accumulate((r["n"] for r in ranges), initial=0))[: len(ranges)]
        place = F.col("_mark").bitwiseAND(F.lit((1 << 33) - 1))
        before = cls._of_part([r["_part"] for r in ranges], starts, part)
        numbered = stored.select(key, (before + place).alias("_position"))
        return cls(key, numbered, starts, [r["low"] for r in ranges][1:])

    @staticmethod
    def _of_part(parts: list[int], values: list[int], part: Column) -> Column:
        if not parts:
            return F.lit(0).cast("long")
        table = F.map_from_arrays(
            F.array(*map(F.lit, parts)), F.array(*(F.lit(v).cast("long") for v in values))
        )
        return F.element_at(table, part.cast("int"))

    def numbers(self, name: str) -> DataFrame:
        """The keys and their numbers."""
        return self.stored.withColumnRenamed("_position", name)

    def give(self, df: DataFrame, name: str) -> DataFrame:
        """The same rows with their numbers; of equal keys any has any of their numbers."""
        part = F.lit(0)
        if self.lowest:
            bounds = F.array(*map(F.lit, self.lowest))
            part = F.size(F.filter(bounds, lambda low: low <= F.col(self.key)))
        ranged = df.withColumn("_part", part).repartitionById(
            max(1, len(self.starts)), F.col("_part")
        )
        sorted_rows = ranged.sortWithinPartitions(self.key)
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        start = self._of_part(list(range(len(self.starts))), self.starts, F.col("_part"))
        return sorted_rows.withColumn(name, start + place).drop("_part")


def in_batches(df: DataFrame, *order: str, size: int = 10) -> DataFrame:
    """Add ``batch``: consecutive groups of ``size`` rows in key order."""
    numbered = with_position(df, *order, name="_position")
    batch = F.floor(F.col("_position") / size).cast("long")
    return numbered.withColumn("batch", batch).drop("_position")
