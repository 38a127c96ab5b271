"""Column expressions over the words and lines of a text, without Python in the tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def without_ids(docs: DataFrame, gone: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``docs`` whose id is not in the one column of ``gone``, whatever columns they have."""
    name = "_gone_id"
    while name in {c.lower() for c in docs.columns}:
        name = f"_{name}"
    gone = gone.toDF(name)
    kind = gone.schema[0].dataType
    return docs.join(gone, F.col(f"`{id_col}`").cast(kind) == F.col(name), "left_anti")


def space_words(text: Column) -> Column:
    """The runs of characters other than space and ``\\x09-\\x0D``; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def plain_words(text: Column) -> Column:
    """Lower-cased (A-Z) runs of digits, letters and characters beyond ASCII."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.translate(F.coalesce(text, F.lit("")), capitals, capitals.lower())
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def runs(words: Column, size: int) -> Column:
    """All runs of ``size`` elements, as an array of structs with the fields "0", "1", …

    ``words`` must be a plain column: it is read several times.
    """
    count = F.greatest(F.size(words) - (size - 1), F.lit(0))
    shifted = [words] + [F.slice(words, i + 1, F.size(words)) for i in range(1, size)]
    named = [s.alias(str(i)) for i, s in enumerate(shifted)]
    return F.slice(F.arrays_zip(*named), 1, count)


def run_fields(run: Column, size: int) -> list[Column]:
    return [run.getField(str(i)) for i in range(size)]
