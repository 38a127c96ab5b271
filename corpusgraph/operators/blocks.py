"""Exact similarity joins over blocks of vectors.

Every job here compares rows pair by pair, yet only emits a bounded number of rows per
input row (the k best, or one flag), or the pairs above a threshold, strip by strip.
It is done in three steps:

1. *Cells.* Each vector goes to the cell of its nearest pivot. It also visits a
   cell where a partner above the threshold could live; the triangle inequality
   tells which, so no pair is lost. Homes and visits are counted before any vector
   moves; few rows, or rows that no cells separate, make one cell.
2. *Blocks.* A cell is cut into blocks by a hash of the id, as many as its counted
   size asks for. A cell that holds a third of all rows is therefore just cut
   into more blocks.
3. *Strips.* The strip of a block is one task of bounded memory: it holds the block,
   and the rows to compare with pass by in batches, multiplied as two matrices and
   reduced there. A vector is sent once per strip, straight from the table.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgraph.operators.sampling import top_n
from corpusgraph.sources.scratch import materialize_measured

# A block is limited in bytes, for the memory of a task: each further block is one more
# time that all others are sent. Small tables are cut into more blocks than memory asks
# for, to use all cores, but not below the minimum.
BLOCK_BYTES = 128 << 20
MIN_BLOCK_ROWS = 256
# Rows at which cells are tried, and that one task may walk one by one.
MAX_BLOCK_ROWS = 8192
# Streamed rows are compared with the held block this many at a time, or a batch.
STREAM_ROWS = 1 << 15
# Blocks' worth of rows that pass by in one strip before it is cut into parts.
STREAM_BLOCKS = 64
# Up to so many pivots are one group; cells must leave less than this share of the pairs.
ONE_LEVEL = 32
WORTH_CELLS = 0.75
# Rows whose visits are counted before those of all, and what they may leave for that.
TRIED_ROWS = 1 << 14
TRIED_CELLS = 0.9
# Pivots, and the smaller side of a search, are sent to all tasks up to these sizes.
MAX_PIVOTS = 1024
PIVOT_BYTES = 64 << 20
BROADCAST_BYTES = 64 << 20
# Similarities computed, and pairs kept, at a time within two blocks.
STRIP_CELLS = 1 << 19  # a few megabytes, which stay in a core's cache
TILE_COLUMNS = 1 << 10
KEPT_PAIRS = 1 << 20
# A pair that passes the bound costs about as much as so many elements of it; where more
# than one in so many passes, all products are computed.
PASSING_COST = 1200
PASSING_SHARE = 16

SIMILARITY_DIGITS = 9
# Allows for rounding errors in the bounds, which must never lose a pair.
_SLACK = 1e-6


def to_matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix, without a copy per row."""
    rows = len(column)
    if not rows:
        return np.empty((0, 0))
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _to_lists(matrix: np.ndarray) -> pa.Array:
    rows, dim = matrix.shape
    offsets = np.arange(rows + 1, dtype=np.int32) * dim
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))


def _finite(batch: pa.RecordBatch) -> np.ndarray:
    matrix = to_matrix(batch.column("vec"))
    if not np.isfinite(matrix).all():
        raise ValueError("vectors must be finite")
    return matrix


def _unit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scale every vector of a partition to length one."""
    for batch in batches:
        if batch.num_rows:
            matrix = _finite(batch)
            norms = np.linalg.norm(matrix, axis=1, keepdims=True)
            unit = _to_lists(matrix / np.where(norms == 0, 1.0, norms))
            yield pa.RecordBatch.from_arrays([batch.column("id"), unit], ["id", "vec"])


def _same_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of length one, bit by bit as they are."""
    for batch in batches:
        if batch.num_rows:
            _finite(batch)
            yield batch


@dataclass(frozen=True)
class VectorTable:
    """Stored unit vectors ``(id, vec)`` with their number and dimension."""

    rows: DataFrame
    count: int
    dim: int

    @property
    def id_type(self) -> str:
        return self.rows.schema["id"].dataType.simpleString()

    @property
    def size_bytes(self) -> int:
        return 8 * self.count * self.dim

    @property
    def block_rows(self) -> int:
        return min(MAX_BLOCK_ROWS, self.held_rows)

    @property
    def held_rows(self) -> int:
        """Rows that a task can hold."""
        return max(MIN_BLOCK_ROWS, BLOCK_BYTES // (8 * max(self.dim, 1)))

    def subset(self, rows: DataFrame) -> VectorTable:
        """Some of the rows, written out and counted."""
        kept, found = materialize_measured(
            rows.select("id", "vec"), "vectors", n=F.count(F.lit(1))
        )
        return VectorTable(kept, found["n"], self.dim)


def load_vectors(
    df: DataFrame,
    id_col: str,
    vec_col: str,
    keep_zero: bool = False,
    unit: bool = False,
) -> VectorTable:
    """Unit vectors of a frame, whose ids must be unique. Rows without a vector are left
    out, and so are zero vectors, which are similar to nothing, unless ``keep_zero``.
    Vectors with elements that are not finite are refused. ``unit`` says that the
    vectors are of length one already and must not change."""
    used = F.size("vec") > 0 if keep_zero else F.exists("vec", lambda x: x != 0)
    plain = df.select(
        F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec")
    ).where(used)
    schema = f"id {plain.schema['id'].dataType.simpleString()}, vec array<double>"
    rows, found = materialize_measured(
        plain.mapInArrow(_same_rows if unit else _unit_rows, schema),
        "vectors",
        n=F.count(F.lit(1)),
        low=F.min(F.size("vec")),
        high=F.max(F.size("vec")),
    )
    if found["low"] != found["high"]:
        raise ValueError(f"vectors of {found['low']} to {found['high']} elements")
    repeated = rows.groupBy("id").count().where("count > 1").select("id").first()
    if repeated:
        raise ValueError(f"id {repeated['id']!r} has more than one vector")
    return VectorTable(rows, found["n"], found["high"] or 0)


def stored_vectors(df: DataFrame, id_col: str, vec_col: str) -> VectorTable:
    """Vectors of a stored table that are of length one already, without a copy."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).where(
        F.exists("vec", lambda x: x != 0)
    )
    found = rows.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dim")
    ).first()
    return VectorTable(rows, found["n"], found["dim"] or 0)


# Cells


@dataclass(frozen=True)
class Pivots:
    """Points that divide space into cells, in two levels.

    A vector belongs to the nearest of a few leading points and, within its group, to the
    nearest point; so finding its cell among m takes about 2 * sqrt(m) products.
    ``members`` lists the points of each group.
    """

    points: np.ndarray
    leading: np.ndarray
    members: list[np.ndarray]

    @classmethod
    def of(cls, points: np.ndarray) -> Pivots:
        """Groups around points that lie far apart: each next leading point is the one
        farthest from those before."""
        number = len(points)
        wanted = 1 if number <= ONE_LEVEL else math.ceil(math.sqrt(number))
        chosen = [0] if number else []
        nearest = points @ points[0] if number else np.empty(0)
        while len(chosen) < wanted:
            chosen.append(int(nearest.argmin()))
            nearest = np.maximum(nearest, points @ points[chosen[-1]])
        leading = points[chosen]
        group = (points @ leading.T).argmax(axis=1) if number else np.empty(0, np.int64)
        members = [np.flatnonzero(group == g) for g in range(len(chosen))]
        return cls(points, leading, members)

    def __len__(self) -> int:
        return len(self.points)

    def homes(self, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each row, and the angle to its point."""
        group = (matrix @ self.leading.T).argmax(axis=1)
        home = np.zeros(len(matrix), dtype=np.int64)
        cosine = np.zeros(len(matrix))
        for g, own in enumerate(self.members):
            rows = np.flatnonzero(group == g)
            if len(rows):
                dots = matrix[rows] @ self.points[own].T
                home[rows], cosine[rows] = own[dots.argmax(axis=1)], dots.max(axis=1)
        return home, _angles(cosine)

    def visits(
        self, matrix: np.ndarray, radii: np.ndarray, threshold: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """Rows and the cells in which a partner could live.

        A partner y of x in a cell is nearer to the cell's point than to any other of its
        group, and nearer to the group's leading point than to any other leading one. The
        distance of x and y is at most ``reach``, so x lies at most ``reach`` beyond the
        plane halfway between two such points. And the angle between x and the cell's
        point is at most that between x and y plus the radius of the cell.
        """
        reach = math.sqrt(max(0.0, 2.0 - 2.0 * threshold))
        widest = math.acos(max(-1.0, min(1.0, threshold))) + _SLACK
        near_group = _within_reach(matrix @ self.leading.T, self.leading, reach)
        found = []
        for g, own in enumerate(self.members):
            rows = np.flatnonzero(near_group[:, g])
            if len(rows):
                dots = matrix[rows] @ self.points[own].T
                near = _within_reach(dots, self.points[own], reach)
                near &= _angles(dots) <= radii[own] + widest
                row, cell = np.nonzero(near)
                found.append((rows[row], own[cell]))
        rows, cells = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(rows, kind="stable")
        return rows[order], cells[order]


def _within_reach(dots: np.ndarray, points: np.ndarray, reach: float) -> np.ndarray:
    """For each row, the points whose side of the plane to the nearest one is in reach."""
    best = dots.argmax(axis=1)
    gaps = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (points @ points.T)))
    beyond = dots[np.arange(len(dots)), best][:, None] - dots
    return beyond <= reach * gaps[best] + _SLACK


def choose_pivots(vectors: VectorTable, wanted: int) -> Pivots:
    """Up to ``wanted`` vectors that differ clearly, from a hash-ordered sample.

    The sample is bounded by rows and bytes, whatever the table's size.
    """
    room = PIVOT_BYTES // (8 * max(vectors.dim, 1))
    wanted = max(1, min(wanted, MAX_PIVOTS, room // 4))
    code = F.xxhash64("id", F.lit("pivot"))
    sample = top_n(vectors.rows, "id", 4 * wanted, code).orderBy("id")
    candidates = to_matrix(sample.select("vec").toArrow()["vec"])
    chosen: list[np.ndarray] = []
    for vector in candidates:
        if not chosen or np.max(np.array(chosen) @ vector) < 0.95:
            chosen.append(vector)
        if len(chosen) == wanted:
            break
    return Pivots.of(np.array(chosen).reshape(len(chosen), vectors.dim))


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def cell_radii(vectors: VectorTable, pivots: Pivots) -> np.ndarray:
    """The widest angle between each pivot and the vectors of its cell; negative
    infinity for empty cells. One number per pivot and batch leaves the tasks."""

    def widest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                home, angle = pivots.homes(to_matrix(batch.column("vec")))
                found = np.full(len(pivots), -np.inf)
                np.maximum.at(found, home, angle)
                cells = np.flatnonzero(found >= 0).astype(np.int32)
                columns = [pa.array(cells), pa.array(found[cells])]
                yield pa.RecordBatch.from_arrays(columns, ["cell", "angle"])

    found = vectors.rows.mapInArrow(widest, "cell int, angle double")
    radii = np.full(len(pivots), -np.inf)
    for row in found.groupBy("cell").agg(F.max("angle").alias("angle")).collect():
        radii[row["cell"]] = row["angle"]
    return radii


def _visited(
    matrix: np.ndarray, pivots: Pivots, radii: np.ndarray, threshold: float, role: str
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Home of each row, and (row, cell) of its visits.

    ``role`` is 'self' (a home, and visits to lower cells, so that each pair meets
    once), 'base' (only the home) or 'query' (visits to all reachable cells, no home).
    """
    home, _ = pivots.homes(matrix)
    if role == "base":
        none = np.empty(0, np.int64)
        return home, none, none
    row, cell = pivots.visits(matrix, radii, threshold)
    if role == "self":
        lower = cell < home[row]
        return home, row[lower], cell[lower]
    return np.full(len(home), -1), row, cell


def _cell_counts(
    vectors: VectorTable,
    pivots: Pivots,
    radii: np.ndarray,
    threshold: float,
    role: str,
    share: int = 1,
) -> np.ndarray:
    """Rows at home and visiting per cell. No vector moves: two numbers per cell and batch
    leave the tasks. Of one row in ``share``, by a hash of the id, the numbers stand for
    all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                matrix = to_matrix(batch.column("vec"))
                home, _, cell = _visited(matrix, pivots, radii, threshold, role)
                for at_home, cells in ((True, home[home >= 0]), (False, cell)):
                    number = np.bincount(cells, minlength=len(pivots))
                    used = np.flatnonzero(number)
                    columns = [used.astype(np.int32), np.full(len(used), at_home), number[used]]
                    names = ["cell", "at_home", "n"]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    rows = vectors.rows
    if share > 1:
        rows = rows.where(F.pmod(F.xxhash64("id", F.lit("share")), F.lit(share)) == 0)
    counted = rows.mapInArrow(count, "cell int, at_home boolean, n bigint")
    sizes = np.zeros((2, len(pivots)), dtype=np.int64)
    for row in counted.groupBy("cell", "at_home").agg(F.sum("n").alias("n")).collect():
        sizes[0 if row["at_home"] else 1, row["cell"]] = row["n"] * share
    return sizes


def _in_cells(
    vectors: VectorTable, pivots: Pivots, radii: np.ndarray, threshold: float, role: str
) -> DataFrame:
    """Every vector once with its home and visits: ``(id, vec, home, visits)``."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = to_matrix(batch.column("vec"))
            home, row, cell = _visited(matrix, pivots, radii, threshold, role)
            offsets = np.zeros(len(home) + 1, dtype=np.int32)
            np.cumsum(np.bincount(row, minlength=len(home)), out=offsets[1:])
            visits = pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(cell.astype(np.int32))
            )
            own = pa.array(home.astype(np.int32))
            columns = [batch.column("id"), batch.column("vec"), own, visits]
            yield pa.RecordBatch.from_arrays(columns, ["id", "vec", "home", "visits"])

    schema = f"id {vectors.id_type}, vec array<double>, home int, visits array<int>"
    return vectors.rows.mapInArrow(assign, schema)


# Blocks and strips

PairReducer = Callable[["BlockPairs"], Iterator[pa.Table]]

# What a row is in a strip: held and compared within its block, only held, or streamed.
_WITHIN, _HELD, _STREAMED = range(3)


@dataclass(frozen=True)
class Layout:
    """How many blocks each cell's homes are cut into, and parts each strip.

    The strip of a block compares the block, which a task holds, with half of the other
    blocks of its cell and with all visitors, which are streamed. The blocks stand in a
    circle and each takes the half that follows it, so strips are equally long. A long
    strip is cut into parts, for each of which the block is sent once more.
    """

    homes: np.ndarray
    visitors: np.ndarray
    blocks: np.ndarray
    parts: np.ndarray
    within: bool

    @classmethod
    def plan(
        cls, sizes: np.ndarray, within: bool, block_rows: int, cores: int
    ) -> Layout:
        homes, visitors = sizes
        cells = max(1, int((homes > 0).sum()))
        wanted = math.ceil(cores / cells) if within else 1
        smallest = np.ceil(homes / MIN_BLOCK_ROWS)
        blocks = np.maximum(np.ceil(homes / block_rows), np.minimum(wanted, smallest))
        blocks = blocks.astype(np.int64)
        stream = visitors + (homes / 2 if within else 0)
        parts = np.ceil(stream / (STREAM_BLOCKS * block_rows))
        if not within:
            # Few blocks: strips are cut until all cores have one.
            each = math.ceil(cores / max(1, blocks.sum()))
            parts = np.maximum(parts, np.minimum(each, np.ceil(stream / MIN_BLOCK_ROWS)))
        parts = np.maximum(1, parts).astype(np.int64)
        if len(homes) == 1:
            blocks, parts = cls._even(homes, stream, blocks, parts, within, block_rows, cores)
        return cls(homes, visitors, blocks, parts, within)

    @staticmethod
    def _even(homes, stream, blocks, parts, within, block_rows, cores):
        """Blocks and parts of a single cell, whose strips are equally long: where there are
        more than cores, a multiple of the cores, so that none waits for another."""
        least = int(blocks[0])
        if least * int(parts[0]) <= cores:
            return blocks, parts
        if within:
            if parts[0] == 1:
                blocks = np.array([cores * math.ceil(least / cores)])
            return blocks, parts
        needed = max(1, math.ceil(stream[0] / (STREAM_BLOCKS * block_rows)))
        fitting = []
        for number in range(least, least + cores):
            step = cores // math.gcd(number, cores)
            part = step * math.ceil(needed / step)
            fitting.append((int(stream[0]) * number + int(homes[0]) * part, number, part))
        _, number, part = min(fitting)
        return np.array([number]), np.array([part])

    @property
    def strips(self) -> np.ndarray:
        return self.blocks * self.parts

    @property
    def sent(self) -> int:
        """How many times a row is sent to a task, all rows together."""
        half = (self.blocks - 1) / 2 if self.within else 0
        held = np.where(self.blocks > 0, self.homes * (self.parts + half), 0)
        return int(round((held + self.visitors * self.blocks).sum()))

    @property
    def pairs(self) -> float:
        """How many pairs are compared."""
        own = self.homes * self.homes / 2 if self.within else 0
        return float((own + self.homes * self.visitors).sum())


@dataclass(frozen=True)
class Strips:
    """Rows on their way to the strips: ``(strip, role, id, vec)``, one per time sent."""

    rows: DataFrame
    layout: Layout
    id_type: str

    @property
    def number(self) -> int:
        return int(self.layout.strips.sum())

    def reduce_pairs(self, reducer: PairReducer, schema: str) -> DataFrame:
        """Run ``reducer`` on the pairs of blocks, which together hold every pair above
        the threshold once; it yields rows of ``schema``."""
        return self.reduce(lambda *sides: reducer(BlockPairs(*sides)), schema)

    def reduce(self, reducer: Callable[..., Iterator[pa.Table]], schema: str) -> DataFrame:
        """Run ``reducer(left ids, left, right ids, right, same)`` on pairs of blocks.

        A task holds one block; what it is compared with passes by in Arrow batches.
        """
        cores = self.rows.sparkSession.sparkContext.defaultParallelism
        partitions = max(1, min(self.number, 16 * cores))
        place = F.pmod(F.col("strip"), F.lit(partitions)).cast("int")
        sorted_rows = self.rows.repartitionById(partitions, place).sortWithinPartitions(
            "strip", "role"
        )
        return sorted_rows.mapInArrow(_walk_strips(reducer), schema)


def _side(parts: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    table = pa.Table.from_batches(parts)
    return table["id"].to_numpy(), to_matrix(table["vec"])


def _walk_strips(reducer: Callable[..., Iterator[pa.Table]]):
    """Sorted rows of some strips to the results of their pairs of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strip, waiting, held, passing = None, [], None, []

        def results(*sides) -> Iterator[pa.RecordBatch]:
            for part in reducer(*sides):
                yield from part.to_batches()

        def hold() -> Iterator[pa.RecordBatch]:
            nonlocal held
            if held is None and waiting:
                held = _side(waiting)
                if waiting[0].column("role")[0].as_py() == _WITHIN:
                    yield from results(*held, *held, True)
                waiting.clear()

        def meet(least: int) -> Iterator[pa.RecordBatch]:
            if passing and sum(len(p) for p in passing) >= least:
                sides = _side(passing)
                passing.clear()
                if held is not None:
                    yield from results(*held, *sides, False)

        for batch in batches:
            if not batch.num_rows:
                continue
            strips = batch.column("strip").to_numpy()
            streamed = batch.column("role").to_numpy() == _STREAMED
            code = strips * 2 + streamed
            cuts = np.flatnonzero(np.diff(code)) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(code)], strict=True):
                part = batch.slice(start, stop - start)
                if strips[start] != strip:
                    yield from hold()
                    yield from meet(1)
                    strip, held = strips[start], None
                    waiting.clear()
                if not streamed[start]:
                    waiting.append(part)
                    continue
                yield from hold()
                passing.append(part)
                yield from meet(STREAM_ROWS)
        yield from hold()
        yield from meet(1)

    return run


def _send(placed: DataFrame, layout: Layout, id_type: str) -> Strips:
    """Send each row of ``(id, vec, cell, at_home)`` to the strips it takes part in."""
    spark = placed.sparkSession
    strips = layout.strips
    first = np.cumsum(strips) - strips
    names = ["blocks", "parts", "first"]
    columns = [c.tolist() for c in (layout.blocks, layout.parts, first)]
    if len(strips) == 1:
        sized = placed.withColumns({n: F.lit(c[0]).cast("long") for n, c in zip(names, columns)})
    else:
        # One row per cell, at most MAX_PIVOTS.
        rows = list(zip(range(len(strips)), *columns))
        sheet = spark.createDataFrame(rows, "cell int, blocks long, parts long, first long")
        sized = placed.join(F.broadcast(sheet), "cell")
    code = F.pmod(F.xxhash64("id"), F.lit(1 << 31))
    blocks, parts = F.col("blocks"), F.col("parts")
    # Numbers up to 0 are the parts that hold a home row's block; k above 0 is the strip of
    # the k-th block before it. A visitor goes to every block.
    half = F.floor(blocks / 2) if layout.within else F.lit(0)
    numbers = F.when(F.col("at_home"), F.sequence(1 - parts, half.cast("long"))).otherwise(
        F.sequence(F.lit(0).cast("long"), blocks - 1)
    )
    own = sized.where(blocks > 0).withColumns({"code": code, "block": F.pmod(code, blocks)})
    spread = own.withColumn("k", F.explode(numbers))
    k, block = F.col("k"), F.col("block")
    streamed = (k > 0) | ~F.col("at_home")
    target = (
        F.when(~F.col("at_home"), k).when(k > 0, F.pmod(block - k, blocks)).otherwise(block)
    )
    part = (
        F.when(~F.col("at_home"), F.pmod(F.shiftright("code", 7), parts))
        .when(k > 0, F.pmod(k, parts))
        .otherwise(-k)
    )
    inner = F.lit(_WITHIN) if layout.within else F.lit(_HELD)
    role = F.when(streamed, F.lit(_STREAMED)).when(k == 0, inner).otherwise(F.lit(_HELD))
    # Of an even circle, opposite blocks meet only in the strip of the first half.
    twice = F.col("at_home") & (k > 0) & (2 * k == blocks) & (2 * target >= blocks)
    rows = spread.where(~twice).select(
        (F.col("first") + target * parts + part).alias("strip"),
        role.alias("role"),
        "id",
        "vec",
    )
    return Strips(rows, layout, id_type)


def _in_one_cell(vectors: VectorTable, at_home: bool) -> DataFrame:
    return vectors.rows.select(
        "id", "vec", F.lit(0).alias("cell"), F.lit(at_home).alias("at_home")
    )


def _placed(assigned: DataFrame) -> DataFrame:
    """One row per vector and cell, on its way to the shuffle."""

    def place(cell: Column, at_home: bool) -> Column:
        return F.struct(cell.alias("cell"), F.lit(at_home).alias("at_home"))

    visiting = F.transform("visits", lambda c: place(c, False))
    staying = F.when(F.col("home") >= 0, F.array(place(F.col("home"), True)))
    places = F.concat(F.coalesce(staying, F.slice(visiting, 1, 0)), visiting)
    exploded = assigned.select("id", "vec", F.explode(places).alias("p"))
    return exploded.select("id", "vec", "p.cell", "p.at_home")


def _pivot_number(rows: int, block_rows: int) -> int:
    """Pivots pay once the table is many blocks large."""
    blocks = math.ceil(rows / block_rows)
    return 1 if blocks <= 8 else min(MAX_PIVOTS, blocks)


def _worth(
    counted: Callable[[int], Layout], rows: int, one: Layout, asked: bool
) -> Layout | None:
    """The layout in cells, where they spare enough pairs or are asked for. A share of a
    large table is counted first, and all rows only when that share is promising."""
    share = rows // TRIED_ROWS
    if not asked and share > 1 and counted(share).pairs > TRIED_CELLS * one.pairs:
        return None
    cells = counted(1)
    return cells if asked or cells.pairs < WORTH_CELLS * one.pairs else None


def self_strips(
    vectors: VectorTable,
    threshold: float,
    block_rows: int | None = None,
    pivots: int | None = None,
) -> Strips:
    """Strips in which every pair of rows above the threshold meets exactly once.

    Cells are counted before any vector moves, and given up for one cell, which needs no
    visits, where they would not spare enough pairs; not when ``pivots`` are asked for.
    """
    number = pivots or _pivot_number(vectors.count, block_rows or vectors.block_rows)
    block_rows = block_rows or vectors.held_rows
    cores = vectors.rows.sparkSession.sparkContext.defaultParallelism
    one = np.array([[vectors.count], [0]])
    layout = Layout.plan(one, True, block_rows, cores)
    if number > 1:
        points = choose_pivots(vectors, number)
        radii = cell_radii(vectors, points)

        def counted(share: int) -> Layout:
            sizes = _cell_counts(vectors, points, radii, threshold, "self", share)
            return Layout.plan(sizes, True, block_rows, cores)

        cells = _worth(counted, vectors.count, layout, bool(pivots))
        if cells:
            assigned = _in_cells(vectors, points, radii, threshold, "self")
            return _send(_placed(assigned), cells, vectors.id_type)
    return _send(_in_one_cell(vectors, True), layout, vectors.id_type)


def cross_strips(
    base: VectorTable,
    queries: VectorTable,
    threshold: float,
    block_rows: int | None = None,
    pivots: int | None = None,
) -> Strips:
    """Strips in which every query meets every base row above the threshold once: blocks
    hold base rows and queries are streamed. Cells are given up as in ``self_strips``."""
    number = pivots or _pivot_number(base.count, block_rows or queries.block_rows)
    block_rows = block_rows or queries.held_rows
    cores = queries.rows.sparkSession.sparkContext.defaultParallelism
    one = np.array([[base.count], [queries.count]])
    layout = Layout.plan(one, False, block_rows, cores)
    if number > 1:
        points = choose_pivots(base, number)
        radii = cell_radii(base, points)
        homes = _cell_counts(base, points, radii, threshold, "base")

        def counted(share: int) -> Layout:
            guests = _cell_counts(queries, points, radii, threshold, "query", share)
            return Layout.plan(homes + guests, False, block_rows, cores)

        cells = _worth(counted, queries.count, layout, bool(pivots))
        if cells:
            staying = _in_cells(base, points, radii, threshold, "base")
            visiting = _in_cells(queries, points, radii, threshold, "query")
            placed = _placed(staying.unionByName(visiting))
            return _send(placed, cells, queries.id_type)
    placed = _in_one_cell(base, True).unionByName(_in_one_cell(queries, False))
    return _send(placed, layout, queries.id_type)


def reduce_cross(
    base: VectorTable,
    queries: VectorTable,
    threshold: float,
    reducer: PairReducer,
    schema: str,
    **layout,
) -> DataFrame:
    """Run ``reducer`` on pairs of blocks, base rows left and queries right, that
    together hold every pair above the threshold once.

    When one side is small, counted in bytes, it is broadcast and the other side stays
    where it is. Beyond that size, or when a layout is given, the sides meet in strips.
    """
    small, large = sorted((base, queries), key=lambda v: v.size_bytes)
    if layout or small.size_bytes > BROADCAST_BYTES:
        strips = cross_strips(base, queries, threshold, **layout)
        return strips.reduce_pairs(reducer, schema)
    context = large.rows.sparkSession.sparkContext
    held = small.rows.toArrow()
    sent = context.broadcast((held["id"].to_numpy(), to_matrix(held["vec"])))
    base_is_small = small is base

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = sent.value
            far = (batch["id"].to_numpy(zero_copy_only=False), to_matrix(batch["vec"]))
            sides = (*near, *far) if base_is_small else (*far, *near)
            for part in reducer(BlockPairs(*sides)):
                yield from part.to_batches()

    cores = context.defaultParallelism
    rows = large.rows
    if large.size_bytes < cores * BROADCAST_BYTES:
        rows = rows.repartition(cores)
    return rows.mapInArrow(meet, schema)


# Inside a strip

_ARROW_IDS = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}


def result_table(id_type: str, ids: dict, similarity: np.ndarray | None = None) -> pa.Table:
    """Id columns, typed even when they are empty, and a similarity column."""
    kind = _ARROW_IDS[id_type]
    columns = {name: pa.array(values, kind) for name, values in ids.items()}
    if similarity is not None:
        columns["similarity"] = pa.array(similarity, pa.float64())
    return pa.table(columns)


def _tiles(rows: int, columns: int, same: bool) -> Iterator[tuple[slice, slice]]:
    """Parts of a matrix that stay in a core's cache; of one block with itself, those that
    reach above the diagonal."""
    width = max(1, min(columns, TILE_COLUMNS))
    height = max(1, STRIP_CELLS // width)
    for first in range(0, columns, width):
        stop = min(rows, first + width) if same else rows
        for start in range(0, stop, height):
            yield slice(start, min(start + height, rows)), slice(first, first + width)


def products(
    left: np.ndarray, right: np.ndarray, same: bool = False
) -> Iterator[tuple[int, int, np.ndarray]]:
    """Similarities of left and right rows, tile by tile, with the tile's first row and
    column. A tile is only valid until the next one, which takes its memory."""
    room = np.empty(STRIP_CELLS, np.result_type(left, right))
    for rows, columns in _tiles(len(left), len(right), same):
        a, b = left[rows], right[columns]
        tile = room[: len(a) * len(b)].reshape(len(a), len(b))
        yield rows.start, columns.start, np.matmul(a, b.T, out=tile)


def rounded(similarity: np.ndarray) -> np.ndarray:
    """Similarities rounded, so that exact ties do not depend on the order in which a
    matrix product adds its terms."""
    return np.round(similarity, SIMILARITY_DIGITS)


class BlockPairs:
    """The pairs of two blocks. Rows are positions in ``ids``, which ascends."""

    def __init__(
        self,
        left_ids: np.ndarray,
        left: np.ndarray,
        right_ids: np.ndarray,
        right: np.ndarray,
        same: bool = False,
    ) -> None:
        self._left, self._right, self._same = left, right, same
        both = np.concatenate([left_ids, right_ids])
        self.ids, rank = np.unique(both, return_inverse=True)
        self._left_rank, self._right_rank = np.split(rank, [len(left_ids)])

    def above(self, threshold: float) -> Iterator[tuple[np.ndarray, ...]]:
        """``(left, right, similarity)`` of pairs of different ids at or above the
        threshold, each unordered pair once, some left rows at a time."""
        almost = threshold - 10.0**-SIMILARITY_DIGITS
        for row, col, s in _near_pairs(self._left, self._right, almost, self._same):
            a, b, s = self._left_rank[row], self._right_rank[col], rounded(s)
            if self._same:
                a, b = np.minimum(a, b), np.maximum(a, b)
            keep = (s >= threshold) & (a != b)
            yield a[keep], b[keep], s[keep]


def _heads(matrix: np.ndarray, lead: int) -> np.ndarray:
    """The first ``lead`` elements of each row and the length of the rest, in single
    precision. A product of two such rows is never below that of the whole rows."""
    if lead == matrix.shape[1]:
        return matrix.astype(np.float32)
    rest = matrix[:, lead:]
    length = np.sqrt(np.einsum("ij,ij->i", rest, rest))
    return np.column_stack([matrix[:, :lead], length]).astype(np.float32)


def _lead(left: np.ndarray, right: np.ndarray, almost: float) -> int:
    """How many first elements are worth comparing: of a few numbers the one that costs
    least over some rows, counting a pair that passes as so many elements."""
    dim = left.shape[1]
    some = [m[:: max(1, len(m) // n)][:n] for m, n in ((left, 64), (right, 256))]
    best, least = dim, math.inf
    for lead in sorted({dim * k // 8 for k in (2, 3, 4, 5, 6, 8)} - {0}):
        bound = _heads(some[0], lead) @ _heads(some[1], lead).T
        cost = lead + PASSING_COST * float((bound >= almost).mean())
        if cost < least:
            best, least = lead, cost
    return best


def rare(flags: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Positions of the few flags that are set, which fill the beginning of ``room``; found
    eight at a time."""
    size = -(-len(flags) // 8) * 8
    room[len(flags) : size] = False
    eights = np.flatnonzero(room[:size].view(np.uint64))
    place, offset = np.nonzero(room[:size].reshape(-1, 8)[eights])
    return eights[place] * 8 + offset


def _near_pairs(
    left: np.ndarray, right: np.ndarray, almost: float, same: bool
) -> Iterator[tuple[np.ndarray, ...]]:
    """Positions and similarity of pairs at or above ``almost``, some left rows at a time;
    of one block with itself, each unordered pair once.

    A bound in single precision, which allows for its rounding errors, rules most pairs
    out; the similarities of the rest are products in double precision.
    """
    if not len(left) or not len(right):
        return
    lead = _lead(left, right, almost)
    head, other = _heads(left, lead), _heads(right, lead)
    longest = [math.sqrt(float(np.einsum("ij,ij->i", m, m).max())) for m in (left, right)]
    least = np.float32(almost - 2.0**-22 * (left.shape[1] + 8) * longest[0] * longest[1])
    passes = np.zeros(STRIP_CELLS + 8, bool)
    for start, first, bound in products(head, other, same):
        rows, columns = slice(start, start + len(bound)), slice(first, first + bound.shape[1])
        found = rare(np.greater_equal(bound.ravel(), least, out=passes[: bound.size]), passes)
        if PASSING_SHARE * len(found) > bound.size:
            # A group of similar rows: all products are cheaper than one by one.
            sims = (left[rows] @ right[columns].T).ravel()
            found = np.flatnonzero(sims >= almost)
            row, col = np.divmod(found, bound.shape[1])
            s = sims[found]
        else:
            row, col = np.divmod(found, bound.shape[1])
            s = np.einsum("ij,ij->i", left[row + start], right[col + first])
            kept = s >= almost
            row, col, s = row[kept], col[kept], s[kept]
        row, col = row + start, col + first
        if same:
            once = row < col
            row, col, s = row[once], col[once], s[once]
        yield row, col, s


class Best:
    """The k most similar others of each owner, while pairs arrive in any order.

    Owners are numbered from 0 to ``owners`` - 1. Once an owner has k others, pairs
    below the least similar of them are not even kept.
    """

    def __init__(self, k: int, owners: int) -> None:
        self._k = k
        self._parts = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        self._size = 0
        self._limit = KEPT_PAIRS
        self._floor = np.full(owners, -np.inf)

    def add(self, owner: np.ndarray, other: np.ndarray, similarity: np.ndarray) -> None:
        useful = similarity >= self._floor[owner]
        self._parts.append((owner[useful], other[useful], similarity[useful]))
        self._size += int(useful.sum())
        if self._size > self._limit:
            kept = self.result()
            self._parts, self._size = [kept], len(kept[0])
            self._limit = max(KEPT_PAIRS, 2 * self._size)
            full = np.bincount(kept[0], minlength=len(self._floor)) == self._k
            lowest = np.full(len(self._floor), np.inf)
            np.minimum.at(lowest, kept[0], kept[2])
            self._floor[full] = lowest[full]

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Owners, others and similarities; lower others win ties."""
        owner, other, similarity = (np.concatenate(x) for x in zip(*self._parts))
        if not len(owner):
            return owner, other, similarity
        # Owner and descending similarity as one integer: two sort keys, not three.
        score = np.rint((2.0 - similarity) * 10**SIMILARITY_DIGITS).astype(np.int64)
        order = np.lexsort((other, (owner.astype(np.int64) << 32) + score))
        ranked = owner[order]
        starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
        lengths = np.diff(np.r_[starts, len(order)])
        place = np.arange(len(order)) - np.repeat(starts, lengths)
        kept = order[place < self._k]
        return owner[kept], other[kept], similarity[kept]
