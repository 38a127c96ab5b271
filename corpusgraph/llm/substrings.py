"""Removal of repeated word windows.

Rabin-Karp hashes of every window of 13 words are counted in Spark: each batch of rows
sends one entry per distinct window, with the smallest document that has it, to the
bucket of the window; a bucket finds the windows of several documents. A window that a
smaller document of the same batch has as well is settled in the batch, so a window that
a third of all documents share reaches its bucket once per batch; the settled hits are
dealt by their documents. Hits return to their documents, where overlapping windows merge into maximal intervals.

A window is known by a 64-bit hash within a bucket that another hash of the same words
chooses, so 64 + log2(buckets) bits tell windows apart: 10^13 windows in 10^6 buckets
give about three chance matches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusgraph.llm.words import Words, batch_words, mix, window_hashes, window_texts

WINDOW = 13
BUCKET_BYTES = 8 << 20  # of text; about 1.5 million windows
BATCH_WINDOWS = 1 << 20

_OTHER_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
_SENT = "bucket int, settled boolean, ids binary, ends binary, hashes binary"
_U8 = np.uint64


def _groups(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(new)


def _by_document(ids: np.ndarray, rank: np.ndarray, hashes: np.ndarray) -> list[tuple]:
    """(document, its hashes)."""
    order = np.argsort(rank)
    rank, hashes = rank[order], hashes[order]
    at = np.append(_groups(rank), len(rank))
    return [
        (int(ids[rank[a]]), hashes[a:b].tobytes())
        for a, b in zip(at[:-1], at[1:], strict=True)
    ]


def _by_bucket(ids, rank, hashes, bucket) -> list[tuple[int, bytes, bytes, bytes]]:
    """(bucket, its documents, where the hashes of each end, hashes)."""
    order = np.argsort(bucket * _U8(1 << 32) + rank.astype(_U8))
    rank, hashes, bucket = rank[order], hashes[order], bucket[order]
    out = []
    at = np.append(_groups(bucket), len(bucket))
    for a, b in zip(at[:-1], at[1:], strict=True):
        first = _groups(rank[a:b])
        ends = np.append(first[1:], b - a).astype(np.int32)
        documents = ids[rank[a:b][first]].astype(np.int64)
        out.append(
            (int(bucket[a]), documents.tobytes(), ends.tobytes(), hashes[a:b].tobytes())
        )
    return out


def _rows(entries: list[tuple], settled: bool = False) -> pa.RecordBatch:
    columns = list(zip(*entries, strict=True))
    arrays = [pa.array(columns[0], pa.int32()), pa.array([settled] * len(entries))]
    arrays += [pa.array(c, pa.binary()) for c in columns[1:]]
    return pa.RecordBatch.from_arrays(arrays, ["bucket", "settled", "ids", "ends", "hashes"])


def _settle(ids, rank, hashes, bucket) -> tuple[tuple, tuple]:
    """What a batch sends to the buckets, and the hits that it finds by itself.

    ``ids`` are the documents in order, the other arrays describe windows.
    """
    order = np.argsort(hashes)
    rank, hashes, bucket = rank[order], hashes[order], bucket[order]
    at = _groups(hashes)
    least = np.minimum.reduceat(rank, at)
    late = rank > np.repeat(least, np.diff(np.append(at, len(rank))))
    hits = (rank[late], hashes[late], bucket[late])
    return (least, hashes[at], bucket[at]), hits


def _windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, other hash and text of the windows."""
    base = words.hashes()
    text = window_texts(words, size)
    inside = text >= 0
    return (
        window_hashes(base, size)[inside],
        window_hashes(base, size, _OTHER_BASE)[inside],
        text[inside],
    )


def _send(size: int, buckets: int):
    """Batches of (doc_id, text) to entries for buckets and settled hits."""

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        doc, hashes, bucket = (np.concatenate(part) for part in zip(*held, strict=True))
        ids, rank = np.unique(doc, return_inverse=True)
        sent, hits = _settle(ids, rank, hashes, bucket)
        yield _rows(_by_bucket(ids, *sent))
        if len(hits[0]):
            # Settled hits go by the shard of their document: a window that many documents
            # share would send them all to one bucket.
            late, hashes, _ = hits
            shard = mix(ids.astype(_U8)) % _U8(buckets)
            yield _rows(_by_bucket(ids, late, hashes, shard[late]), settled=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for start, _, words in batch_words(batch.column(1)):
                hashes, other, text = _windows(words, size)
                if len(hashes):
                    held.append((ids[start + text], hashes, other % _U8(buckets)))
                    count += len(hashes)
                if count >= BATCH_WINDOWS:
                    yield from flush(held)
                    held, count = [], 0
        if held:
            yield from flush(held)

    return run


def _entries(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents in order, and the place of its document among them for each hash."""
    none = np.zeros(0, dtype=np.int64)
    ids, counts, hashes = [none], [none], [none.astype(_U8)]
    for documents, ends, values in rows:
        ids.append(np.frombuffer(documents, dtype=np.int64))
        counts.append(np.diff(np.frombuffer(ends, dtype=np.int32), prepend=0))
        hashes.append(np.frombuffer(values, dtype=_U8))
    found, rank = np.unique(np.concatenate(ids), return_inverse=True)
    return found, np.repeat(rank, np.concatenate(counts)), np.concatenate(hashes)


def _reduce(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hits of one bucket: windows that a smaller document has."""
    ids, rank, hashes = _entries(rows)
    order = np.argsort(hashes)
    rank, hashes = rank[order], hashes[order]
    at = _groups(hashes)
    least = np.minimum.reduceat(rank, at) if len(at) else at
    late = rank > np.repeat(least, np.diff(np.append(at, len(rank))))
    return ids, rank[late], hashes[late]


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of each key, without it; rows are sorted by their first column."""
    current, rows = None, []
    for batch in batches:
        for key, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != current and rows:
                yield current, rows
                rows = []
            current = key
            rows.append(row)
    if rows:
        yield current, rows


def _answer(shards: int):
    """Entries, sorted by bucket, to hits for shards of documents; one bucket at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_key(batches):
            ids, rank, hashes = _reduce([row[1:] for row in rows if not row[0]])
            own = [row[1:] for row in rows if row[0]]
            if own:
                found = _entries(own)
                both = np.concatenate([ids, found[0]])
                hashes = np.concatenate([hashes, found[2]])
                rank = np.concatenate([rank, found[1] + len(ids)])
                ids, again = np.unique(both, return_inverse=True)
                rank = again[rank]
            if len(hashes):
                shard = mix(ids.astype(_U8)) % _U8(shards)
                yield _rows(_by_bucket(ids, rank, hashes, shard[rank]))

    return run


def _collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hits, sorted by shard, to one row per document; one shard is held at a time."""
    for _, rows in _by_key(batches):
        ids, rank, hashes = _entries([row[1:] for row in rows])
        found, values = zip(*_by_document(ids, rank, hashes), strict=True)
        for at in range(0, len(found), 4096):
            arrays = [
                pa.array(found[at : at + 4096], pa.int64()),
                pa.array(values[at : at + 4096], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "found"])


def _covered(hit: np.ndarray, size: int) -> np.ndarray:
    """Words below the windows that start at the marked words: a union of intervals."""
    steps = np.zeros(len(hit) + size, dtype=np.int32)
    steps[: len(hit)] += hit
    steps[size:] -= hit
    return np.cumsum(steps)[: len(hit)] > 0


def _shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed for the shuffle; null stays null."""
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary())
        packed = [None if t is None else packer.compress(t) for t in texts.to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(packed, pa.binary()), *batch.columns[2:]],
            batch.schema.names,
        )


def _cut(size: int):
    """Batches of (row, text, hits) to (row, kept text, words, removed, intervals)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            found = batch.column(1).to_pylist()
            out: list[list] = [[], [], [], []]
            texts = [t if t is None else unpack(t) for t in batch.column(0).to_pylist()]
            for start, stop, words in batch_words(pa.array(texts, pa.large_binary())):
                raw = words.data.tobytes()
                ends = words.start + words.length
                for row in range(start, stop):
                    a, b = words.first[row - start], words.first[row - start + 1]
                    gone = np.zeros(b - a, dtype=bool)
                    if found[row]:
                        own = Words(words.data, words.start[a:b], words.length[a:b], None)
                        hashes = window_hashes(own.hashes(), size)
                        hits = np.frombuffer(found[row], dtype=_U8)
                        hit = np.zeros(b - a, dtype=bool)
                        hit[: len(hashes)] = np.isin(hashes, hits)
                        gone = _covered(hit, size)
                    at = np.flatnonzero(~gone) + a
                    kept = b" ".join(
                        [raw[s:e] for s, e in zip(words.start[at].tolist(), ends[at].tolist())]
                    )
                    edges = np.flatnonzero(np.diff(gone, prepend=False, append=False))
                    out[0].append(kept)
                    out[1].append(int(b - a))
                    out[2].append(int(gone.sum()))
                    out[3].append([{"start": int(s), "end": int(e)} for s, e in edges.reshape(-1, 2)])
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            types = (pa.binary(), pa.int64(), pa.int64(), pa.list_(span))
            made = [pa.array(c, t) for c, t in zip(out, types, strict=True)]
            made[0] = made[0].cast(pa.string())
            whole = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[2:], whole, *made],
                [*batch.schema.names[2:], "_text", "kept_text", "n_words", "n_removed", "removed"],
            )

    return run


def bucket_count(docs: DataFrame, text_col: str, bucket_bytes: int) -> int:
    """Buckets for the text at hand, from its counted bytes."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(1, -(-size // bucket_bytes))


def repeated_windows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = WINDOW,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """(doc_id, found): hashes of a document's windows that a smaller document has."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    source = source.filter("doc_id is not null and text is not null")
    buckets = bucket_count(source, "text", bucket_bytes)
    return (
        source.mapInArrow(_send(size, buckets), _SENT)
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_answer(buckets), _SENT)
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_collect, "doc_id bigint, found binary")
    )


def remove_repeated_windows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = WINDOW,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Each row with the words left after removing repeated windows.

    A window is ``size`` consecutive words of one text. It is removed where its words
    also start in a row with a smaller ``id_col``; windows are judged on the input.
    Adds ``kept_text`` (kept words, one space between), ``n_words``, ``n_removed`` and
    ``removed`` (maximal intervals of word positions, end exclusive), replacing columns of
    these names; all other columns stay.

    Null text: no words. Texts of fewer words than a window keep all. Rows with the same
    id do not remove each other's windows. Rows without id are kept whole and remove
    nothing. An empty table gives an empty table.
    """
    made = ("kept_text", "n_words", "n_removed", "removed")
    apart = (*made, text_col.lower())
    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in apart]
    found = repeated_windows(docs, id_col, text_col, size, bucket_bytes)
    rows = docs.select(
        F.col(id_col).cast("long").alias("_doc_id"),
        F.col(text_col).alias("_text"),
        F.struct(*others).alias("_row"),
    )
    row = rows.schema["_row"]
    packed = rows.mapInArrow(
        _shrink, T.StructType([rows.schema["_doc_id"], T.StructField("_text", T.BinaryType()), row])
    )
    joined = packed.join(found.withColumnRenamed("doc_id", "_doc_id"), "_doc_id", "left")
    added = T.StructType.fromDDL(
        "_text string, kept_text string, n_words bigint, n_removed bigint, "
        "removed array<struct<start:bigint,end:bigint>>"
    )
    cut = joined.select("_text", "found", "_row").mapInArrow(
        _cut(size), T.StructType([row, *added.fields])
    )
    return cut.select("_row.*", F.col("_text").alias(text_col), *made)
