"""Selecting the rows a run still has to process, and counting what it did."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgraph.operators.sampling import top_n


def matching(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    """Rows whose columns equal the constants; pushed down to the scan."""
    for column, value in constants.items():
        df = df.where(F.col(column) == F.lit(value))
    return df


def pending(
    source: DataFrame,
    done: DataFrame,
    key: str,
    done_key: str | None = None,
    constants: Mapping[str, object] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Source rows whose key is not yet in ``done`` for the given constants.

    Source duplicates are kept, and so are NULL keys. The keys of ``done`` are made
    distinct first: that reduces repeated keys on the map side, and leaves a side
    that joins one row per key, whichever key is frequent. With ``limit`` (0 or None
    means all) the first rows by key are taken.
    """
    finished = matching(done, constants or {}).select(F.col(done_key or key).alias(key))
    rest = source.join(finished.distinct(), key, "left_anti").select(*source.columns)
    return top_n(rest, key, limit) if limit else rest


def pending_groups(
    source: DataFrame, done: DataFrame, group: str, done_key: str, per_row: int = 2
) -> DataFrame:
    """Unfinished group ids with their rows and ``per_row`` times as many items.

    Grouping comes first, so only one row per id meets the anti join.
    """
    counted = (
        source.where(F.col(group).isNotNull())
        .groupBy(F.col(group).alias(done_key))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    rest = pending(counted, done, done_key)
    return rest.select(done_key, "rows", (F.col("rows") * per_row).alias("items"))


def lacking_any(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which at least one of the columns is NULL."""
    missing = F.lit(False)
    for column in columns:
        missing = missing | F.col(column).isNull()
    return df.where(missing)


def coverage(df: DataFrame, column: str) -> DataFrame:
    """Rows in total, with the column, and without it."""
    total, present = F.count(F.lit(1)), F.count(column)
    return df.agg(
        total.alias("total"),
        present.alias("with_value"),
        (total - present).alias("without_value"),
    )


def run_counters(df: DataFrame, succeeded: Column) -> DataFrame:
    """Succeeded and failed rows of a run, and the success rate in percent."""
    good = F.count_if(succeeded)
    total = F.count(F.lit(1))
    rate = F.coalesce(F.try_divide(good * 100.0, total), F.lit(0.0))
    return df.agg(
        good.alias("succeeded"),
        (total - good).alias("failed"),
        rate.alias("success_rate_pct"),
    )
