"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints are cut into pieces; two that differ in at most ``radius`` bits agree in
``pieces - radius`` pieces at least, so every link is found among fingerprints that share
one choice of pieces. Within such a group, fingerprints are stored as vertical bit planes:
one machine word holds the same bit of 64 fingerprints, so one pass over the planes
updates 64 distances with carry-save counters, and a block of distances is abandoned as
soon as all of them exceed the radius. Comparing rows of different groups in one block is
harmless, since distances are exact; small groups are therefore compared together.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgraph.llm.components import components
from corpusgraph.llm.native import without_ids
from corpusgraph.llm.words import batch_words
from corpusgraph.sources.scratch import materialize

SHINGLE = 4
RADIUS = 4
BITS = 64
SEED = 42
BLOCK = 2048  # rows of a comparison block
GROUP_ROWS = 16  # chance members of a group that the number of pieces aims at
_SHINGLES = 1 << 18
_U8 = np.uint64
_FULL = _U8(0xFFFFFFFFFFFFFFFF)


def _bit_counts(hashes: np.ndarray, text: np.ndarray, counts: np.ndarray) -> None:
    """Add how often each bit is set to the counts of the hashes' texts."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at = np.flatnonzero(np.diff(text, prepend=-1))
    counts[text[at]] += np.add.reduceat(bits, at, axis=0, dtype=np.int64)


def fingerprints_of(column: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """The 64-bit fingerprint of each text; zero for a text without words."""
    out = np.zeros(len(column), dtype=_U8)
    for start, stop, words in batch_words(column, lower=True):
        counts = words.counts
        # Words with one space between them: where each begins, and the bytes.
        begin = np.cumsum(words.length + 1) - words.length - 1
        size = int(begin[-1] + words.length[-1]) if len(begin) else 0
        steps = np.ones(size, dtype=np.int64)
        if size:
            steps[0] = words.start[0]
            steps[begin[1:]] = words.start[1:] - (words.start + words.length - 1)[:-1] - 1
            gaps = begin[1:] - 1
            at = np.cumsum(steps)
            joined = words.data[at]
            joined[gaps] = 32
            raw = joined.tobytes()
        shingles = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
        text = np.repeat(np.arange(stop - start), shingles)
        offset = np.arange(len(text)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
        first = words.first[:-1][text] + offset
        last = first + np.minimum(counts[text], shingle) - 1
        ones = np.zeros((stop - start, BITS), dtype=np.int64)
        for a in range(0, len(text), _SHINGLES):
            part = slice(a, a + _SHINGLES)
            begins = begin[first[part]].tolist()
            ends = (begin[last[part]] + words.length[last[part]]).tolist()
            texts = [raw[s:e] for s, e in zip(begins, ends, strict=True)]
            hashes = map(xxhash.xxh64_intdigest, texts, repeat(SEED))
            _bit_counts(np.fromiter(hashes, dtype=_U8, count=len(texts)), text[part], ones)
        set_bits = np.ascontiguousarray(2 * ones > shingles[:, None], dtype=np.uint8)
        out[start:stop] = np.packbits(set_bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def _fingerprint_batches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = fingerprints_of(batch.column(1), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found)], ["doc_id", "fingerprint"]
            )

    return run


def bit_planes(fingerprints: np.ndarray) -> np.ndarray:
    """64 rows of packed bits: bit ``i`` of row ``b`` is bit ``b`` of fingerprint ``i``."""
    padded = np.zeros(-(-len(fingerprints) // 64) * 64, dtype=_U8)
    padded[: len(fingerprints)] = fingerprints
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view("<u8")


def within_radius(planes: np.ndarray, queries: np.ndarray, radius: int) -> np.ndarray:
    """Packed marks, a row per query: which fingerprints of the planes are that near.

    Counters are ``len(counters)`` bit planes deep and hold ``radius + 1`` at least; a
    mark of excess catches what overflows. Queries all of whose words are in excess are
    abandoned every eight planes.
    """
    depth = (radius + 1).bit_length()
    out = np.zeros((len(queries), planes.shape[1]), dtype=_U8)
    alive = np.arange(len(queries))
    counters = np.zeros((depth, len(queries), planes.shape[1]), dtype=_U8)
    over = np.zeros((len(queries), planes.shape[1]), dtype=_U8)
    for bit in range(BITS):
        turned = np.where((queries[alive] >> _U8(bit)) & _U8(1), _FULL, _U8(0))
        carry = planes[bit][None, :] ^ turned[:, None]
        for level in counters:
            carry_on = level & carry
            level ^= carry
            carry = carry_on
        over |= carry
        if bit % 8 == 7:
            over |= _exceeds(counters, radius)
            live = ~(over == _FULL).all(axis=1)
            if not live.all():
                alive, over, counters = alive[live], over[live], counters[:, live]
            if not alive.size:
                return out
    out[alive] = ~(over | _exceeds(counters, radius))
    return out


def _exceeds(counters: np.ndarray, radius: int) -> np.ndarray:
    """Where the bit-sliced counters are above the radius."""
    above = np.zeros_like(counters[0])
    equal = np.full_like(above, _FULL)
    for level in range(len(counters) - 1, -1, -1):
        if radius >> level & 1:
            equal &= counters[level]
        else:
            above |= equal & counters[level]
            equal &= ~counters[level]
    return above


def _marked(marks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    bits = np.unpackbits(marks.view(np.uint8), axis=1, bitorder="little")[:, :size]
    return np.nonzero(bits)


def spanning_links(fingerprints: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint, the first of its group of linked fingerprints."""
    label = np.arange(len(fingerprints))
    planes = bit_planes(fingerprints)
    for start in range(0, len(fingerprints), 256):
        marks = within_radius(planes, fingerprints[start : start + 256], radius)
        left, right = _marked(marks, len(fingerprints))
        left = left + start
        while True:
            a, b = label[left], label[right]
            low, high = np.minimum(a, b), np.maximum(a, b)
            if (low == high).all():
                break
            np.minimum.at(label, high, low)
            while True:
                jumped = label[label]
                if (jumped == label).all():
                    break
                label = jumped
    return label


def _compare(radius: int):
    """Sorted rows (tile, fingerprint, node) to links; whole tiles, many small ones at once."""

    def links(nodes: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        prints, at = np.unique(prints, return_index=True)
        nodes = nodes[at]
        label = spanning_links(prints, radius)
        linked = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes[linked]), pa.array(nodes[label[linked]])], ["u", "v"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = np.zeros(0, dtype=np.int64)
        held = [keys, keys, keys]
        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = [np.concatenate(pair) for pair in zip(held, new, strict=True)]
            while len(held[0]) > BLOCK // 4:
                ends = np.flatnonzero(held[0][1:] != held[0][:-1]) + 1
                if not ends.size:
                    break
                cut = ends[max(0, np.searchsorted(ends, BLOCK // 4, side="right") - 1)]
                yield links(held[2][:cut], held[1][:cut].view(_U8))
                held = [part[cut:] for part in held]
        if len(held[0]):
            yield links(held[2], held[1].view(_U8))

    return run


def _masks(pieces: int, radius: int) -> list[int]:
    """Bit masks of all choices of ``pieces - radius`` pieces."""
    edges = [BITS * i // pieces for i in range(pieces + 1)]
    piece = [((1 << b) - (1 << a)) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    chosen = [sum(c) for c in combinations(piece, pieces - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def piece_count(rows: int, radius: int) -> int:
    """The fewest pieces whose keys are shared by a few fingerprints by chance."""
    for pieces in range(radius + 1, 2 * radius + 1):
        bits = BITS * (pieces - radius) // pieces
        if rows <= GROUP_ROWS << bits:
            break
    return pieces


def links(nodes: DataFrame, radius: int = RADIUS, pieces: int | None = None) -> DataFrame:
    """Links (u, v) that connect all ``nodes`` (node, fingerprint) within the radius.

    Fingerprints must be distinct. The links span the same components as all pairs.
    Groups above a block are cut into parts by a hash, and every two parts meet in a tile
    of their own, so no task holds more than two parts.
    """
    pieces = pieces or piece_count(nodes.count(), radius)
    assert comb(pieces, radius) <= 256, "too many choices of pieces"
    masks = F.array(*[F.lit(m).cast("long") for m in _masks(pieces, radius)])
    keyed = nodes.select("node", "fingerprint", F.posexplode(masks).alias("choice", "mask")).select(
        "node", "fingerprint", "choice", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("key")
    )
    groups = keyed.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    groups = materialize(groups, "simhash-groups")
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    part = F.pmod(F.xxhash64("fingerprint", F.lit(7)), parts).cast("int")
    meets = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    tiles = (
        keyed.join(groups, ["choice", "key"])
        .select("node", "fingerprint", "choice", "key", parts.alias("parts"), part.alias("part"))
        .select("*", meets)
        .select(
            F.xxhash64("choice", "key", F.least("part", "other"), F.greatest("part", "other")).alias("tile"),
            "fingerprint",
            "node",
        )
    )
    return (
        tiles.repartition("tile").sortWithinPartitions("tile").mapInArrow(_compare(radius), "u bigint, v bigint")
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    Words are lower-cased (A-Z only); a shingle is ``shingle`` of them joined by spaces,
    repeats count, and fewer words are one shingle. A bit is set when it is in over half
    of the shingles' XXH64 values (seed 42). Fingerprints that differ in at most ``radius``
    bits are linked; ``component_id`` is the least id reachable.

    Null and empty texts have the fingerprint zero and link like others. Equal
    fingerprints are one node however many rows have them. Rows with the same id are
    linked through their own fingerprints only. A row without id gets a component like
    any other, but never names it. An empty table gives an empty table.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    prints = materialize(
        source.mapInArrow(_fingerprint_batches(shingle), "doc_id bigint, fingerprint bigint"),
        "fingerprints",
    )
    # Nodes are numbered by their least id; rows without any id by the fingerprint itself.
    nodes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    nodes = materialize(nodes, "simhash-nodes")
    linked = links(nodes.select(F.col("fingerprint").alias("node"), "fingerprint"), radius)
    grouped = components(linked)
    named = nodes.join(grouped, nodes.fingerprint == grouped.node, "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("root")
    )
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("fingerprint", "component_id")
    hexed = F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint")
    return prints.join(named, "fingerprint").select("doc_id", hexed, "component_id")


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """The rows whose id is the least of their component, all columns as they are.

    Rows that share an id are one document and stay or go together: they stay when any of
    them is the least of its component. Rows without id stay.
    """
    found = near_duplicates(docs, id_col, text_col, shingle, radius)
    gone = found.groupBy("doc_id").agg(F.min(F.col("doc_id") - F.col("component_id")).alias("above"))
    return without_ids(docs, gone.filter("above > 0").select("doc_id"), id_col)
