"""Column statistics in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_null(field: T.StructField) -> Column:
    """NULL, or NaN in a float column."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def null_profile(df: DataFrame) -> DataFrame:
    """``(column, nulls)`` for every column that has any."""
    counts = df.agg(*[F.count_if(is_null(f)).alias(f.name) for f in df.schema])
    listed = counts.unpivot([], df.columns, "column", "nulls")
    return listed.where(F.col("nulls") > 0)


def share_present(df: DataFrame, column: str) -> DataFrame:
    """Rows, rows with the column, and their percentage."""
    total, present = F.count(F.lit(1)), F.count(column)
    percent = F.coalesce(F.try_divide(present * 100.0, total), F.lit(0.0))
    return df.agg(
        total.alias("num_records"),
        present.alias("num_present"),
        percent.alias("coverage_pct"),
    )


def value_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("oldest"), F.max(column).alias("newest"))
