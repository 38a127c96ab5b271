"""Similar pairs and nearest neighbours by cosine similarity, exact."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusgraph.operators import blocks
from corpusgraph.operators.blocks import Best, BlockPairs, VectorTable, load_vectors
from corpusgraph.sources.scratch import materialize


def copy_groups(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Rows with bit-equal vectors as one row: lowest id, vector, number of copies.

    A grouping with partial aggregates: a vector that a third of all rows share is
    reduced to one row per task before the shuffle.
    """
    present = df.where(F.col(vec_col).isNotNull())
    return present.groupBy(F.col(vec_col).alias("vec")).agg(
        F.min(id_col).alias("id"), F.count(F.lit(1)).alias("copies")
    )


def similar_pairs(
    df: DataFrame,
    id_col: str,
    vec_col: str,
    threshold: float,
    block_rows: int | None = None,
    pivots: int | None = None,
) -> DataFrame:
    """Pairs of different vectors with cosine similarity at or above a threshold.

    Equal vectors are one entry under their lowest id with a ``copies`` count, so
    the result does not grow with the square of a group of copies. Columns:
    ``low``, ``high``, ``similarity``, ``low_copies``, ``high_copies``.
    """
    groups = materialize(copy_groups(df, id_col, vec_col))
    vectors = load_vectors(groups, "id", "vec")
    found = all_lower(vectors, threshold, block_rows=block_rows, pivots=pivots)
    result = found.withColumnsRenamed({"neighbour": "low", "id": "high"})
    for side in ("low", "high"):
        count = F.col("copies").alias(f"{side}_copies")
        result = result.join(groups.select(F.col("id").alias(side), count), side)
    return result.select("low", "high", "similarity", "low_copies", "high_copies")


def _every(id_type: str, threshold: float, direction: str):
    """A reducer to all pairs of two blocks, and its schema; directions as in ``_best``."""

    def reducer(pairs: BlockPairs) -> Iterator[pa.Table]:
        for a, b, s in pairs.above(threshold):
            if direction == "higher":
                owner, other = np.maximum(a, b), np.minimum(a, b)
            else:
                wanted = a < b if direction == "lower" else slice(None)
                owner, other, s = b[wanted], a[wanted], s[wanted]
            ids = {"id": pairs.ids[owner], "neighbour": pairs.ids[other]}
            yield blocks.result_table(id_type, ids, s)

    return reducer, f"id {id_type}, neighbour {id_type}, similarity double"


def all_lower(vectors: VectorTable, threshold: float, **layout) -> DataFrame:
    """Every pair of rows at or above the threshold: ``(id, neighbour, similarity)``,
    where the neighbour is the lower id."""
    strips = blocks.self_strips(vectors, threshold, **layout)
    return strips.reduce_pairs(*_every(strips.id_type, threshold, "higher"))


def all_in(
    base: VectorTable,
    queries: VectorTable,
    threshold: float,
    lower_only: bool = False,
    **layout,
) -> DataFrame:
    """Every query's base rows at or above the threshold, columns as in ``all_lower``.

    With ``lower_only`` a query only sees base rows with lower ids.
    """
    direction = "lower" if lower_only else "query"
    reducer, schema = _every(queries.id_type, threshold, direction)
    return blocks.reduce_cross(base, queries, threshold, reducer, schema, **layout)


def first_copies(vectors: VectorTable, known: VectorTable | None = None) -> DataFrame:
    """``(id, new, first)``: for each row the first one with an equal vector, that is
    the lowest id, a known row before a new one.

    Vectors are shuffled as 128 bits of hash. Two different vectors among n share them
    with a chance of n * n / 2 ** 129.
    """

    def marked(table: VectorTable, new: bool) -> DataFrame:
        halves = [F.xxhash64("vec").alias("m0"), F.xxhash64(F.lit(1), "vec").alias("m1")]
        return table.rows.select("id", F.lit(new).alias("new"), *halves)

    rows = marked(vectors, True)
    if known is not None:
        rows = rows.unionByName(marked(known, False))
    least = F.min(F.struct("new", "id")).alias("least")
    groups = rows.groupBy("m0", "m1").agg(least)
    joined = rows.join(groups, ["m0", "m1"])
    return joined.select("id", "new", F.col("least.id").alias("first"))


def linked(
    vectors: VectorTable, threshold: float, known: VectorTable | None = None
) -> DataFrame:
    """Every row's similar earlier rows: ``(id, neighbour, similarity)``.

    Rows with equal vectors are a group. Its first row is linked to the first rows of
    all similar groups, every other row to its first row alone, so that the result is
    complete but does not grow with the square of a group of copies. ``known`` rows
    are earlier than all others; links among them are left out.
    """
    groups = materialize(first_copies(vectors, known), "copies")
    copies = groups.where(F.col("id") != F.col("first"))

    def firsts(table: VectorTable, new: bool) -> VectorTable:
        later = copies.where(F.col("new") == new).select("id")
        return table.subset(table.rows.join(later, "id", "left_anti"))

    leading = firsts(vectors, True)
    found = all_lower(leading, threshold)
    if known is not None:
        found = found.unionByName(all_in(firsts(known, False), leading, threshold))
    own = copies.where("new").select(
        "id", F.col("first").alias("neighbour"), F.lit(1.0).alias("similarity")
    )
    return found.unionByName(own)


def keep_best(partial: DataFrame, k: int) -> DataFrame:
    """The k best over all blocks; a row has at most k candidates per pair of blocks."""
    ranked = Window.partitionBy("id").orderBy(F.desc("similarity"), F.asc("neighbour"))
    return (
        partial.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("id", "neighbour", "similarity", "rank")
    )


def _best(id_type: str, threshold: float, k: int, direction: str):
    """A reducer to the k best per row of two blocks, and its schema.

    ``direction`` says whose neighbours are wanted: 'both' rows of a pair, only the
    'higher' id's, or those of a 'query' on the right, of which 'lower' keeps base rows
    with lower ids.
    """

    def reducer(pairs: BlockPairs) -> Iterator[pa.Table]:
        kept = Best(k, len(pairs.ids))
        for a, b, s in pairs.above(threshold):
            if direction == "both":
                kept.add(np.r_[a, b], np.r_[b, a], np.r_[s, s])
            elif direction == "higher":
                kept.add(np.maximum(a, b), np.minimum(a, b), s)
            else:
                wanted = a < b if direction == "lower" else slice(None)
                kept.add(b[wanted], a[wanted], s[wanted])
        owner, other, s = kept.result()
        ids = {"id": pairs.ids[owner], "neighbour": pairs.ids[other]}
        yield blocks.result_table(id_type, ids, s)

    return reducer, f"id {id_type}, neighbour {id_type}, similarity double"


def nearest(
    vectors: VectorTable,
    k: int,
    threshold: float,
    lower_only: bool = False,
    block_rows: int | None = None,
    pivots: int | None = None,
) -> DataFrame:
    """Each row's k most similar other rows at or above the threshold.

    With ``lower_only`` a row only sees rows with lower ids, as if rows had been
    added in id order. Columns: ``id``, ``neighbour``, ``similarity``, ``rank``.
    """
    strips = blocks.self_strips(vectors, threshold, block_rows, pivots)
    direction = "higher" if lower_only else "both"
    reducer, schema = _best(strips.id_type, threshold, k, direction)
    return keep_best(strips.reduce_pairs(reducer, schema), k)


def nearest_in(
    base: VectorTable,
    queries: VectorTable,
    k: int,
    threshold: float,
    lower_only: bool = False,
    **layout,
) -> DataFrame:
    """Each query's k most similar base rows at or above the threshold.

    A base row with the query's own id is left out. Columns as in ``nearest``.
    """
    direction = "lower" if lower_only else "query"
    reducer, schema = _best(queries.id_type, threshold, k, direction)
    found = blocks.reduce_cross(base, queries, threshold, reducer, schema, **layout)
    return keep_best(found, k)


def knn(
    df: DataFrame,
    id_col: str,
    vec_col: str,
    k: int = 10,
    threshold: float = 0.80,
    block_rows: int | None = None,
    pivots: int | None = None,
) -> DataFrame:
    """Top-k neighbours of every row of a frame, itself excluded."""
    vectors = load_vectors(df, id_col, vec_col)
    return nearest(vectors, k, threshold, False, block_rows, pivots)
