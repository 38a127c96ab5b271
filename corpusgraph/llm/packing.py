"""Packing of documents into training sequences along a space-filling curve.

Token ids of a document are counted into a hashed vector, projected to three dimensions,
and the point's place on a Hilbert curve becomes the sort key. Documents are sorted by
key into ranges; within a range they form one stream of ids, cut every 2,048 ids. What is
left at the end of a range is cut into powers of two, which need no padding, so no id is
ever padded and neighbours on the curve share sequences.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgraph.llm.words import Words, row_slices, split_words, text_bytes
from corpusgraph.sources.scratch import materialize_measured

SEQUENCE = 2048
END_ID = 1
DIMENSIONS = 3
ORDER = 16  # bits of the curve per dimension
BUCKETS = 4096  # of the hashed vector
RANGE_TOKENS = 1 << 22
CACHE_UNITS = 1 << 21
SPREAD = 6.0  # brings mean directions to about unit size

# A text with one of these is encoded whole: white space beyond ASCII, the special token.
_WIDE = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
_WHOLE = re.compile(b"|".join([*(chr(c).encode() for c in _WIDE), rb"<\|endoftext\|>"]))


def segments(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of units that the tokenizer's pattern never joins, in order.

    A unit is a word with one space before it; the white space before that is one unit
    less its last character, which is a unit of its own unless it is the word's space;
    white space at the end of a text is one unit. Texts that need it are one unit.
    """
    whole = np.zeros(len(bounds) - 1, dtype=bool)
    for found in _WHOLE.finditer(data.tobytes()):
        whole[np.searchsorted(bounds, found.start(), side="right") - 1] = True
    words = split_words(data, bounds)
    text = words.text_of_word()
    ends = words.start + words.length
    before = bounds[:-1][text]
    if len(text):
        same = np.flatnonzero(text[1:] == text[:-1]) + 1
        before[same] = ends[same - 1]
    gap = words.start - before
    space = (gap > 0) & (words.data[words.start - 1] == 32)
    last = bounds[:-1].copy()
    filled = words.counts > 0
    last[filled] = ends[words.first[1:][filled] - 1]
    parts = [
        (words.start - space, words.length + space, text),
        (words.start - 1, ((gap > 0) & ~space).astype(np.int64), text),
        (before, gap - 1, text),
        (last, bounds[1:] - last, np.arange(len(whole))),
    ]
    start, length, text = (np.concatenate(c) for c in zip(*parts, strict=True))
    kept = (length > 0) & ~whole[text]
    start = np.concatenate([start[kept], bounds[:-1][whole]])
    length = np.concatenate([length[kept], np.diff(bounds)[whole]])
    order = np.argsort(start)
    return start[order], length[order]


class Encoder:
    """Ids of texts, remembering the ids of units that were seen before.

    ``ranks`` is a rank file of the same vocabulary as the tokenizer file; the ids are the
    same and the library is faster. A unit is remembered in the place that its hash
    names, as long as that place is free, so memory is bounded.
    """

    def __init__(self, tokenizer: str, ranks: str | None = None):
        self._hash = np.zeros(CACHE_UNITS, dtype=np.uint64)
        self._length = np.zeros(CACHE_UNITS, dtype=np.int32)
        self._start = np.zeros(CACHE_UNITS, dtype=np.int64)
        self._count = np.zeros(CACHE_UNITS, dtype=np.int64)
        self._flat = np.zeros(1 << 20, dtype=np.uint32)
        self._used = 0
        if ranks:
            import tiktoken
            from public_tokenizers import PATTERN

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            coder = tiktoken.Encoding(
                "ranks",
                pat_str=PATTERN,
                mergeable_ranks=table,
                special_tokens={"<|endoftext|>": len(table)},
            )
            self._encode = lambda text: coder.encode(text, allowed_special="all")
        else:
            from tokenizers import Tokenizer

            coder = Tokenizer.from_file(tokenizer)
            self._encode = lambda text: coder.encode(text, add_special_tokens=False).ids

    def _append(self, ids: list[int]) -> None:
        end = self._used + len(ids)
        if end > len(self._flat):
            self._flat = np.concatenate([self._flat, np.zeros(end, dtype=np.uint32)])
        self._flat[self._used : end] = ids
        self._used = end

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in ``data``, and where each text's ids begin and end."""
        start, length = segments(data, bounds)
        padded = np.append(data, np.zeros(8, dtype=np.uint8))
        hashes = Words(padded, start, length, start).hashes()
        place = (hashes >> np.uint64(32)) % np.uint64(CACHE_UNITS)
        hit = (self._hash[place] == hashes) & (self._length[place] == length)
        first, count = self._start[place], self._count[place]
        missed = np.flatnonzero(~hit)
        _, one, again = np.unique(hashes[missed], return_index=True, return_inverse=True)
        one = missed[one]
        base, raw = self._used, data.tobytes()
        made = np.zeros(len(one) + 1, dtype=np.int64)
        for k, (a, n) in enumerate(zip(start[one].tolist(), length[one].tolist(), strict=True)):
            self._append(self._encode(raw[a : a + n].decode()))
            made[k + 1] = self._used - base
        made += base
        first[missed], count[missed] = made[:-1][again], np.diff(made)[again]
        total = np.cumsum(count)
        at = np.repeat(first - (total - count), count)
        at += np.arange(len(at))
        ids = self._flat[at]
        cut = np.append(0, total)[np.searchsorted(start, bounds)]
        self._remember(base, one, hashes, length, place, made)
        return ids, cut

    def _remember(self, base, one, hashes, length, place, made) -> None:
        """Keep what found a free place, and drop the ids of the rest."""
        free = np.flatnonzero((self._length[place[one]] == 0) & (length[one] < 64))
        _, kept = np.unique(place[one[free]], return_index=True)
        free = np.sort(free[kept])
        sizes = np.diff(made)[free]
        ids = [self._flat[made[k] : made[k + 1]] for k in free.tolist()]
        spots = place[one[free]]
        self._hash[spots], self._length[spots] = hashes[one[free]], length[one[free]]
        self._start[spots] = base + np.cumsum(sizes) - sizes
        self._count[spots] = sizes
        ids = np.concatenate(ids) if ids else np.zeros(0, dtype=np.uint32)
        self._flat[base : base + len(ids)] = ids
        self._used = base + len(ids)


@lru_cache(maxsize=1)
def encoder(tokenizer: str, ranks: str | None) -> Encoder:
    """One encoder per worker process, so later tasks profit from its memory."""
    return Encoder(tokenizer, ranks)


def hilbert_keys(points: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Places on a Hilbert curve of points with integer coordinates below 2**order.

    Skilling's transform: undo excess rotations from the highest bit down, take the Gray
    code, and interleave the bits.
    """
    axes = [points[:, d].astype(np.int64) for d in range(points.shape[1])]
    count = len(axes)
    bit = 1 << (order - 1)
    while bit > 1:
        low = bit - 1
        for d in range(count):
            high = (axes[d] & bit) != 0
            swap = np.where(high, 0, (axes[0] ^ axes[d]) & low)
            axes[0] = np.where(high, axes[0] ^ low, axes[0] ^ swap)
            axes[d] = axes[d] ^ swap if d else axes[0]
        bit >>= 1
    for d in range(1, count):
        axes[d] = axes[d] ^ axes[d - 1]
    turn = np.zeros_like(axes[0])
    bit = 1 << (order - 1)
    while bit > 1:
        turn = np.where(axes[-1] & bit, turn ^ (bit - 1), turn)
        bit >>= 1
    key = np.zeros_like(axes[0])
    for level in range(order - 1, -1, -1):
        for axis in axes:
            key = key << 1 | ((axis ^ turn) >> level & 1)
    return key


def projection(dimensions: int = DIMENSIONS, buckets: int = BUCKETS) -> np.ndarray:
    """Fixed random directions, one row per bucket of the hashed vector."""
    made = np.random.Generator(np.random.PCG64(20)).standard_normal((buckets, dimensions))
    return made.astype(np.float32)


def curve_keys(
    ids: np.ndarray, cut: np.ndarray, directions: np.ndarray, order: int = ORDER
) -> np.ndarray:
    """Curve keys of documents: their mean direction, in cells of the unit cube."""
    buckets = (ids.astype(np.uint64) * np.uint64(0x9E3779B1) >> np.uint64(7)) % np.uint64(len(directions))
    sums = np.add.reduceat(directions[buckets], cut[:-1], axis=0, dtype=np.float64)
    means = sums / np.diff(cut)[:, None] * SPREAD
    cells = ((np.tanh(means) + 1) / 2 * ((1 << order) - 1)).astype(np.int64)
    return hilbert_keys(cells, order)


def _encode_batches(tokenizer: str, ranks: str | None, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, directions = encoder(tokenizer, ranks), projection()
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            for start, stop in row_slices(bounds):
                part = data[bounds[start] : bounds[stop]]
                plain, cut = encode(part, bounds[start : stop + 1] - bounds[start])
                cut = cut + np.arange(len(cut))
                ids = np.full(cut[-1], end_id, dtype=np.uint32)
                inner = np.ones(len(ids), dtype=bool)
                inner[cut[1:] - 1] = False
                ids[inner] = plain
                narrow = "<u2" if ids.max() < 1 << 16 else "<u4"
                raw = ids.astype(narrow)
                ends = pa.py_buffer((cut * raw.itemsize).astype(np.int32))
                blobs = pa.Array.from_buffers(
                    pa.binary(), stop - start, [None, ends, pa.py_buffer(raw)]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, stop - start),
                        pa.array(curve_keys(ids, cut, directions)),
                        pa.array(np.diff(cut)),
                        blobs,
                    ],
                    ["doc_id", "curve", "tokens", "ids"],
                )

    return run


_PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, ids binary"
)


def _cut_batches(size: int):
    """Sorted documents of one range to pieces; sequences are numbered within the range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 40
        room, held = size, []  # pieces of the sequence that is being filled
        names = [c.split()[0] for c in _PIECES.split(", ")]
        types = [pa.binary() if n == "ids" else pa.int64() for n in names]
        rows: list[tuple] = []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        def piece(doc, start, ids, total, offset) -> tuple:
            raw = ids.tobytes()
            return (doc, start, len(ids), zlib.crc32(raw), total, sequence, offset, raw)

        for batch in batches:
            for doc, total, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.frombuffer(blob, "<u2" if len(blob) == 2 * total else "<u4").astype("<u4")
                at = 0
                while at < total:
                    take = min(room, total - at)
                    held.append((doc, at, ids[at : at + take], total))
                    at, room = at + take, room - take
                    if not room:
                        offset = 0
                        for doc_, start, part, of in held:
                            rows.append(piece(doc_, start, part, of, offset))
                            offset += len(part)
                        sequence, room, held = sequence + 1, size, []
                if len(rows) >= 1024:
                    yield batch_of(rows)
                    rows = []
        # The rest, cut into powers of two.
        left = size - room
        while left:
            room = 1 << (left.bit_length() - 1)
            left, offset = left - room, 0
            while room:
                doc, start, part, of = held.pop(0)
                take = min(room, len(part))
                rows.append(piece(doc, start, part[:take], of, offset))
                if take < len(part):
                    held.insert(0, (doc, start + take, part[take:], of))
                room, offset = room - take, offset + take
            sequence += 1
        if rows:
            yield batch_of(rows)

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SEQUENCE,
    end_id: int = END_ID,
    range_tokens: int = RANGE_TOKENS,
) -> DataFrame:
    """Pieces of all documents: which ids of which document lie where in which sequence.

    Columns: doc_id, start (ids of the document before the piece), length, ids_crc32 (of
    the ids as little-endian unsigned 32-bit numbers), doc_tokens (with the end id),
    sequence_id, offset, ids (those bytes). Sequences have ``size`` ids, or a smaller power
    of two at the end of a range, and no padding.

    Null and empty texts are the end id alone. Documents with equal curve keys, such as
    copies, follow by id and may lie in several ranges. Rows that repeat are packed each
    for itself. Null ids are packed first within their key. An empty table gives no rows.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    encoded, seen = materialize_measured(
        source.mapInArrow(
            _encode_batches(tokenizer, ranks, end_id),
            "doc_id bigint, curve bigint, tokens bigint, ids binary",
        ),
        "packing-ids",
        tokens=F.sum("tokens"),
    )
    ranges = max(1, -(-(seen["tokens"] or 0) // range_tokens))
    return (
        encoded.repartitionByRange(ranges, "curve", "doc_id", F.crc32("ids"))
        .sortWithinPartitions("curve", "doc_id", F.crc32("ids"))
        .select("doc_id", "tokens", "ids")
        .mapInArrow(_cut_batches(size), _PIECES)
    )
