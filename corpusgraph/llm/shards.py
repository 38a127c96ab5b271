"""Shards from a fixed number of virtual slots.

A record belongs to one of 4,096 slots by a hash of its id, for good. Only the map from
slots to shards changes: it starts with slots dealt in turn, or by their counted bytes, and
is edited, as a new version, when shards drift apart or one is added. A stored map has one
row per slot and version, so whatever the data, 4,096 rows reach the driver.

Records without id have no slot of their own and are dealt over all slots. So are those of a
hot slot, one with more than a quarter of a shard's mean: an id that a third of all rows
repeat would make a shard that large.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusgraph.sources.scratch import materialize

SLOTS = 4096
CELL_ROWS = 1 << 16  # rows that are numbered together
TOLERANCE = 0.002  # of the mean bytes of a shard
HOT = 0.25  # of the mean bytes of a shard, in one slot


@dataclass(frozen=True)
class SlotMap:
    """One version: the shard of each slot, and the bytes it was made for."""

    version: int
    shards: int
    shard_of: tuple[int, ...]
    size_of: tuple[int, ...]

    def sizes(self) -> list[int]:
        out = [0] * self.shards
        for shard, size in zip(self.shard_of, self.size_of, strict=True):
            out[shard] += size
        return out

    def rows(self) -> list[tuple[int, int, int, int, int]]:
        return [
            (self.version, self.shards, slot, shard, size)
            for slot, (shard, size) in enumerate(zip(self.shard_of, self.size_of, strict=True))
        ]


def slot_of(id_col: str = "doc_id", slots: int = SLOTS) -> Column:
    """The virtual slot of a record; records without id are dealt by their place in the input."""
    own = F.xxhash64(F.col(id_col).cast("string"))
    dealt = F.xxhash64(F.monotonically_increasing_id())
    return F.pmod(F.when(F.col(id_col).isNull(), dealt).otherwise(own), F.lit(slots)).cast("int")


def slot_sizes(rows: DataFrame, slots: int = SLOTS) -> list[int]:
    """Bytes per slot of ``rows`` (slot, size)."""
    counted = rows.groupBy("slot").agg(F.sum("size").alias("size")).collect()
    found = {r["slot"]: r["size"] for r in counted}
    return [found.get(slot, 0) for slot in range(slots)]


def spread(rows: DataFrame, sizes: Sequence[int], shards: int) -> DataFrame:
    """``rows`` (slot, salt, …), those of hot slots dealt over all slots by their salt."""
    limit = max(1, HOT * sum(sizes) / shards)
    hot = [slot for slot, size in enumerate(sizes) if size > limit]  # at most shards / HOT
    if not hot:
        return rows
    dealt = F.pmod(F.xxhash64("salt"), F.lit(len(sizes))).cast("int")
    return rows.withColumn("slot", F.when(F.col("slot").isin(hot), dealt).otherwise(F.col("slot")))


def even_map(shards: int, slots: int = SLOTS) -> SlotMap:
    """Version 1 of a map made before there are rows: slots in turn, without bytes."""
    return SlotMap(1, shards, tuple(s % shards for s in range(slots)), (0,) * slots)


def first_map(sizes: Sequence[int], shards: int) -> SlotMap:
    """Version 1: slots in order of size, each to the smallest shard so far."""
    totals, shard_of = [0] * shards, [0] * len(sizes)
    for slot in sorted(range(len(sizes)), key=lambda s: (-sizes[s], s)):
        shard = min(range(shards), key=lambda s: (totals[s], s))
        shard_of[slot] = shard
        totals[shard] += sizes[slot]
    return SlotMap(1, shards, tuple(shard_of), tuple(sizes))


def rebalance(
    old: SlotMap, sizes: Sequence[int], shards: int | None = None, tolerance: float = TOLERANCE
) -> SlotMap:
    """The next version: single slots move until no shard is far from the mean.

    A slot leaves the largest shard that it can for the smallest as long as that brings
    them closer, and is the largest such slot, so few slots move. More ``shards`` than before start
    empty. Sizes that are near equal already leave the map as it is.
    """
    shards = shards or old.shards
    if shards < old.shards:
        raise ValueError("shards are only added; empty one by moving its slots")
    shard_of = list(old.shard_of)
    totals = replace(old, shards=shards, size_of=tuple(sizes)).sizes()
    mean = sum(sizes) / shards
    while True:
        least = min(range(shards), key=lambda s: (totals[s], s))
        moves = []
        # From the largest shard that has a slot small enough to bring the two closer.
        for most in sorted(range(shards), key=lambda s: (-totals[s], s)):
            gap = totals[most] - totals[least]
            if gap <= tolerance * mean:
                break
            moves = [s for s, own in enumerate(shard_of) if own == most and 0 < 2 * sizes[s] <= gap]
            if moves:
                break
        if not moves:
            break
        slot = max(moves, key=lambda s: (sizes[s], -s))
        totals[shard_of[slot]] -= sizes[slot]
        shard_of[slot] = least
        totals[least] += sizes[slot]
    return SlotMap(old.version + 1, shards, tuple(shard_of), tuple(sizes))


_STORED = "version int, shards int, slot int, shard int, size bigint"


def save_map(spark: SparkSession, path: str, slots: SlotMap) -> None:
    """Add a version to the stored maps; a version is written once."""
    target = f"{path}/version={slots.version}"
    rows = spark.createDataFrame(slots.rows(), _STORED).drop("version").coalesce(1)
    rows.write.mode("errorifexists").parquet(target)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
    """A stored version, the newest by default."""
    stored = spark.read.parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    rows = stored.filter(F.col("version") == version).orderBy("slot").collect()
    return SlotMap(
        version,
        rows[0]["shards"],
        tuple(r["shard"] for r in rows),
        tuple(r["size"] for r in rows),
    )


def sized(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS
) -> DataFrame:
    """(doc_id, size, text_crc32, slot, salt); a null text has size 1 and the checksum 0.

    The salt is another number for each row of the input.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        slot_of(id_col, slots).alias("slot"),
        F.monotonically_increasing_id().alias("salt"),
    )


def placed(rows: DataFrame, slots: SlotMap, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``rows`` (doc_id, size, text_crc32, slot, salt) with ``shard`` and ``position`` in it.

    Positions run from 0 without gaps. They follow (slot, cell, doc_id), where cells cut a
    slot by a hash of the salt once it has many rows, so no numbering sees a whole shard,
    nor all rows of an id.
    """
    count = rows.count()
    cells = max(1, -(-count // (len(slots.shard_of) * cell_rows)))
    shard = F.element_at(F.array(*[F.lit(s) for s in slots.shard_of]), F.col("slot") + 1)
    cell = F.pmod(F.xxhash64("salt", F.lit(1)), F.lit(cells)).cast("int")
    rows = rows.withColumns({"shard": shard, "cell": cell})
    sizes = rows.groupBy("shard", "slot", "cell").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("slot", "cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("slot", "cell", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("slot", "cell").orderBy("doc_id", "size", "text_crc32", "salt")
    numbered = rows.withColumn("place", F.row_number().over(within) - 1)
    return numbered.join(starts, ["slot", "cell"]).select(
        "doc_id",
        "size",
        "text_crc32",
        "slot",
        "shard",
        (F.col("start") + F.col("place")).cast("long").alias("position"),
    )


def assign_shards(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = 16,
    slots: int = SLOTS,
    map_path: str | None = None,
) -> DataFrame:
    """(doc_id, size, text_crc32, slot, shard, position) of every row.

    Shards are near equal in bytes as far as records allow: one larger than a shard's share
    makes that shard larger. With ``map_path`` the newest stored map is edited for the
    counted bytes, stored as the next version and read back, or the first one is made;
    without it the map is made for these rows alone.

    Null texts count one byte; rows without id, and those of hot slots, are dealt over all
    slots; repeated rows are placed one by one; a long text counts its bytes, and moves
    nowhere; an empty table gives an empty table. Other columns play no part.
    """
    stored = materialize(sized(docs, id_col, text_col, slots), "slot-rows")
    sizes = slot_sizes(stored, slots)
    rows = spread(stored, sizes, shards)
    if rows is not stored:
        sizes = slot_sizes(rows, slots)
    if map_path is None:
        found = first_map(sizes, shards)
    else:
        found = next_map(docs.sparkSession, map_path, sizes, shards)
    return placed(rows, found)


def next_map(spark: SparkSession, path: str, sizes: Sequence[int], shards: int) -> SlotMap:
    """Edit the newest stored map for new sizes, or make the first; stored, and read back."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.exists(folder):
        found = rebalance(load_map(spark, path), sizes, shards)
    else:
        found = first_map(sizes, shards)
    save_map(spark, path, found)
    return load_map(spark, path, found.version)


def write_shards(docs: DataFrame, slots: SlotMap, path: str, id_col: str = "doc_id") -> None:
    """All rows as Parquet below ``path``/shard=N, columns as they are."""
    shard = F.element_at(
        F.array(*[F.lit(s) for s in slots.shard_of]), slot_of(id_col, len(slots.shard_of)) + 1
    )
    docs.withColumn("shard", shard).write.partitionBy("shard").parquet(path)
