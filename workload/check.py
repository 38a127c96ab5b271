"""What a checked query is, and how its two results are compared."""

from __future__ import annotations

import datetime
import decimal
import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Job = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@dataclass(frozen=True)
class Check:
    """A query and the SQL that must give the same rows; None: only run it."""

    job: Job
    sql: str | None = None


def r6(value: Column | str) -> Column:
    """Six digits, without negative zero."""
    rounded = F.round(value, 6)
    return F.when(rounded == 0, F.lit(0.0)).otherwise(rounded)


def sql_r6(value: str) -> str:
    return f"case when round({value}, 6) = 0 then 0.0::double else round({value}, 6) end"


def plain(value: object) -> object:
    """A value of either engine in a form that compares equal."""
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)
