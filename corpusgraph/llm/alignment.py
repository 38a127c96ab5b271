"""Alignment of two tokenizations of the same texts by merging their token ends.

Tokens of A and of B cover the same bytes, so both are ascending lists of ends. A merge of
the two lists meets every overlapping pair of tokens exactly once, and an end that both
lists have closes a group. The merge is cut by diagonals of the merge path: a binary search
per diagonal finds how many ends of each list lie before it, so all pieces take the same
number of steps, whatever the texts. The pieces of a batch run side by side, each of them
emits its overlaps and counts the groups that it closes; running sums of these counts
stitch groups that lie across pieces.

How often a pair of ids is linked in the whole corpus is counted in Spark from the counts
per batch. The distinct pairs of each document then meet these counts: the most frequent
pairs, at most ``HEAD``, in the tasks, all others in a shuffle join.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgraph.llm.packing import Encoder
from corpusgraph.llm.words import row_slices, text_bytes
from corpusgraph.sources.scratch import materialize

PIECE = 256  # steps of a piece
HEAD = 1 << 19  # pairs that every task gets, 17 bytes each
STEPS = 8  # of the histogram of counts, per doubling
SLICE = 2 << 20


@dataclass(frozen=True)
class Vocabulary:
    """The bytes of all entries, one after the other."""

    flat: np.ndarray
    start: np.ndarray
    length: np.ndarray

    @classmethod
    def of(cls, entries: list[bytes]) -> Vocabulary:
        length = np.array([len(e) for e in entries], dtype=np.int64)
        flat = np.frombuffer(b"".join(entries), dtype=np.uint8)
        return cls(flat, np.cumsum(length) - length, length)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the entries ``ids``, one after the other."""
        length = self.length[ids]
        ends = np.cumsum(length)
        at = np.repeat(self.start[ids] - (ends - length), length)
        return self.flat[at + np.arange(len(at))]


class ByteLevel(Encoder):
    """A byte-level tokenizer file; its special strings are ordinary text.

    Units that the tokenizer never joins are encoded once and remembered.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        super().__init__(path)
        from tokenizers import Tokenizer

        coder = Tokenizer.from_file(path)
        coder.encode_special_tokens = True
        self._encode = lambda text: coder.encode(text, add_special_tokens=False).ids
        # Bytes that stand for themselves; the others follow from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain}
        byte_of |= {chr(256 + k): b for k, b in enumerate(others)}
        names = [coder.id_to_token(k) or "" for k in range(coder.get_vocab_size())]
        self.vocabulary = Vocabulary.of([bytes(byte_of[c] for c in n) for n in names])


class Pieces:
    """A sentencepiece model, which puts a space before each text."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        entries = []
        for k in range(model.get_piece_size()):
            name = model.id_to_piece(k)
            if model.is_byte(k):
                entries.append(bytes([int(name[3:-1], 16)]))
            else:
                entries.append(name.replace("▁", " ").encode())
        self.vocabulary = Vocabulary.of(entries)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        made = self._model.encode(texts, num_threads=1)
        cut = np.cumsum([0, *map(len, made)])
        return np.array([i for ids in made for i in ids], dtype=np.int64), cut


@lru_cache(maxsize=1)
def byte_level(path: str) -> ByteLevel:
    return ByteLevel(path)


@lru_cache(maxsize=1)
def pieces(path: str) -> Pieces:
    return Pieces(path)


# The merge


def path_cuts(a: np.ndarray, b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """How many elements of ``a`` and of ``b`` come before every ``size``-th step of their
    merge, in which equal elements of ``a`` come first; the end included."""
    total = len(a) + len(b)
    diagonal = np.append(np.arange(0, total, size), total)
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while True:
        open_ones = np.flatnonzero(low < high)
        if not len(open_ones):
            return low, diagonal - low
        middle = (low[open_ones] + high[open_ones]) // 2
        taken = a[middle] <= b[diagonal[open_ones] - 1 - middle]
        low[open_ones[taken]] = middle[taken] + 1
        high[open_ones[~taken]] = middle[~taken]


@dataclass(frozen=True)
class Merge:
    """Overlapping pairs ``a``, ``b`` (positions) in order, and the group of every token."""

    a: np.ndarray
    b: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray


def merge(a_ends: np.ndarray, b_ends: np.ndarray, size: int = PIECE) -> Merge:
    """Merge two ascending lists of ends that have the last one in common."""
    first_a, first_b = path_cuts(a_ends, b_ends, size)
    steps = np.diff(first_a + first_b)
    i, j = first_a[:-1].copy(), first_b[:-1].copy()
    stop = np.iinfo(np.int64).max
    left, right = np.append(a_ends, stop), np.append(b_ends, stop)
    count = len(steps)
    rows = [np.full((size, count), -1) for _ in range(3)]
    pair_a, pair_b, closes = rows
    for step in range(size):
        # Only the last piece can be shorter.
        lanes = count if not count or step < steps[-1] else count - 1
        if not lanes:
            break
        x, y = i[:lanes], j[:lanes]
        ahead, beside = left[x], right[y]
        from_a = ahead <= beside
        # An end of B that A had just before closes the group and is no new overlap.
        tied = ~from_a & (x > 0) & (left[x - 1] == beside)
        pair_a[step, :lanes] = np.where(tied, -1, x)
        pair_b[step, :lanes] = y
        closes[step, :lanes] = tied
        x += from_a
        y += ~from_a
    # Pieces hold consecutive steps, so the whole path is read piece by piece.
    pair_a, pair_b, closes = (r.T.ravel() for r in rows)
    new = pair_a >= 0
    tied = closes == 1
    # Groups that a piece closes, and where the numbers of each piece begin.
    closed = tied.reshape(count, size).sum(axis=1)
    before = np.repeat(np.cumsum(closed) - closed, size)
    inner = tied.reshape(count, size).cumsum(axis=1).ravel()
    group = before + inner
    a_group = np.empty(len(a_ends), dtype=np.int64)
    b_group = np.empty(len(b_ends), dtype=np.int64)
    a_group[pair_a[new]], b_group[pair_b[new]] = group[new], group[new]
    return Merge(pair_a[new], pair_b[new], a_group, b_group)


# Documents


def _separated(ids: np.ndarray, ends_group: np.ndarray, last: str, names) -> np.ndarray:
    """Decimal ids with a comma within a group and ``last`` after it."""
    inside, after = names
    out = inside[ids]
    at = np.flatnonzero(ends_group)
    out[at] = after[last][ids[at]]
    return out


@lru_cache(maxsize=2)
def _names(size: int):
    plain = [str(k) for k in range(size)]
    commas = np.array([f"{n}," for n in plain], dtype=object)
    after = {c: np.array([n + c for n in plain], dtype=object) for c in ";|"}
    return commas, after


def group_texts(
    a_ids: np.ndarray, b_ids: np.ndarray, made: Merge, cut: np.ndarray, names
) -> list[str]:
    """Groups of documents as ``a1,a2|b1;a3|b2,b3``; ``cut`` are sums of both kinds of
    tokens up to each document."""
    if not len(a_ids):
        return []
    a_last = np.append(np.diff(made.a_group) > 0, True)
    b_last = np.append(np.diff(made.b_group) > 0, True)
    groups = np.arange(made.a_group[-1] + 2)
    a_place = np.arange(len(a_ids)) + np.searchsorted(made.b_group, groups)[made.a_group]
    b_place = np.arange(len(b_ids)) + np.searchsorted(made.a_group, groups + 1)[made.b_group]
    parts = np.empty(len(a_ids) + len(b_ids), dtype=object)
    parts[a_place] = _separated(a_ids, a_last, "|", names[0])
    parts[b_place] = _separated(b_ids, b_last, ";", names[1])
    listed = parts.tolist()
    bounds = zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)
    return ["".join(listed[start:stop])[:-1] for start, stop in bounds]


def _spaced(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with a space before each."""
    rows = np.arange(len(bounds))
    wide = bounds + rows
    out = np.full(len(data) + len(bounds) - 1, 32, dtype=np.uint8)
    inside = np.ones(len(out), dtype=bool)
    inside[wide[:-1]] = False
    out[inside] = data
    return out, wide


def _agree(vocabulary: Vocabulary, ids, cut, data, bounds) -> np.ndarray:
    """Texts whose tokens' bytes are the text."""
    made = vocabulary.joined(ids)
    ends = np.append(0, np.cumsum(vocabulary.length[ids]))[cut]
    same = np.diff(ends) == np.diff(bounds)
    if same.all():
        differs = np.flatnonzero(made != data)
        same[np.searchsorted(bounds, differs, side="right") - 1] = False
        return same
    for k in np.flatnonzero(same):
        mine = made[ends[k] : ends[k + 1]]
        same[k] = np.array_equal(mine, data[bounds[k] : bounds[k + 1]])
    return same


def _kept(ids: np.ndarray, cut: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of the chosen texts, and their number per chosen text."""
    number = np.diff(cut)
    return ids[np.repeat(good, number)].astype(np.int64), number[good]


_DOCUMENT = (
    "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups_sha256 string, groups string, pairs binary, times binary"
)


def _blobs(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.append(0, np.cumsum(sizes)) * values.itemsize
    buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values)]
    return pa.Array.from_buffers(pa.binary(), len(sizes), buffers)


def _align(tokenizer: str, model: str, piece: int, with_groups: bool):
    """A row per document with its distinct pairs of ids and how often they are linked."""

    def part(data, bounds, names) -> list[pa.Array]:
        coder, model_coder = byte_level(tokenizer), pieces(model)
        filled = np.diff(bounds) > 0
        text, wide = _spaced(data, bounds)
        a_ids, a_cut = coder(text, wide)
        raw = data.tobytes()
        spans = zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
        b_ids, b_cut = model_coder([raw[x:y].decode() for x, y in spans])
        good = filled & _agree(coder.vocabulary, a_ids, a_cut, text, wide)
        good &= _agree(model_coder.vocabulary, b_ids, b_cut, text, wide)
        a_ids, n_a = _kept(a_ids, a_cut, good)
        b_ids, n_b = _kept(b_ids, b_cut, good)
        a_ends = np.cumsum(coder.vocabulary.length[a_ids])
        b_ends = np.cumsum(model_coder.vocabulary.length[b_ids])
        made = merge(a_ends, b_ends, piece)

        def spread(values):
            out = np.zeros(len(good), dtype=np.int64)
            out[good] = values
            return out

        row_of_a = np.repeat(np.arange(len(n_a)), n_a)
        row = row_of_a[made.a]
        n_links = np.bincount(row, minlength=len(n_a))
        last_group = made.a_group[np.cumsum(n_a) - 1] if len(n_a) else n_a
        n_groups = np.diff(np.append(-1, last_group))
        groups = group_texts(a_ids, b_ids, made, np.append(0, np.cumsum(n_a + n_b)), names)
        # Row, id of B and id of A in one number: a sort finds the distinct pairs of a row.
        key = np.sort(row << 32 | b_ids[made.b] << 16 | a_ids[made.a])
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        at = np.flatnonzero(new)
        times = np.diff(np.append(at, len(key))).astype("<u4")
        sizes = spread(np.bincount(key[at] >> 32, minlength=len(n_a)))
        key = (key[at] & 0xFFFFFFFF).astype("<u4")
        hashes, texts = (np.full(len(good), "", dtype=object) for _ in range(2))
        hashes[good] = [sha256(g.encode()).hexdigest() for g in groups]
        if with_groups:
            texts[good] = groups
        numbers = [pa.array(spread(v)) for v in (n_a, n_b, n_groups, n_links)]
        strings = [pa.array(v, pa.string()) for v in (hashes, texts)]
        return [*numbers, *strings, _blobs(key, sizes), _blobs(times, sizes)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        coder, model_coder = byte_level(tokenizer), pieces(model)
        vocabularies = (coder.vocabulary, model_coder.vocabulary)
        if max(len(v.length) for v in vocabularies) > 1 << 16:
            raise ValueError("vocabularies of more than 65,536 entries")
        names = [_names(len(v.length)) for v in vocabularies]
        columns = [c.split()[0] for c in _DOCUMENT.split(", ")]
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            for start, stop in row_slices(bounds, SLICE):
                here = bounds[start : stop + 1]
                found = part(data[here[0] : here[-1]], here - here[0], names)
                number = pa.array(first + np.arange(start, stop))
                ids = batch.column(0).slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([number, ids, *found], columns)
            first += batch.num_rows

    return run


# Counts over the corpus


def _pairs_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position of the document, pair of ids and number of links, from the columns
    ``pairs`` and ``times``."""
    blobs = [batch.column(n).cast(pa.large_binary()) for n in ("pairs", "times")]
    found = []
    for blob in blobs:
        _, offsets, values = blob.buffers()
        cut = np.frombuffer(offsets, np.int64)[blob.offset :][: len(blob) + 1]
        raw = np.frombuffer(values, np.uint8) if values else np.zeros(0, np.uint8)
        found.append(raw[cut[0] : cut[-1]].copy().view("<u4").astype(np.int64))
    row = np.repeat(np.arange(batch.num_rows), np.diff(cut) // 4)
    return row, *found


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links per pair, summed up batch by batch."""
    for batch in batches:
        if batch.num_rows:
            _, key, times = _pairs_of(batch)
            order = np.argsort(key)
            key = key[order]
            at = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else key
            sums = np.add.reduceat(times[order], at) if len(key) else key
            columns = [pa.array(key[at]), pa.array(sums)]
            yield pa.RecordBatch.from_arrays(columns, ["pair", "links"])


def _counted_pairs(documents: DataFrame) -> DataFrame:
    """``(pair, links, best)``: a pair's links in the corpus, and whether no other pair of
    its id of B has more."""
    batches = documents.select("pairs", "times").mapInArrow(
        _count_batches, "pair bigint, links bigint"
    )
    counted = materialize(batches.groupBy("pair").agg(F.sum("links").alias("links")), "pairs")
    b_id = F.shiftright("pair", 16)
    # At most one row per entry of B's vocabulary, of which there are at most 65,536.
    most = counted.groupBy(b_id.alias("b")).agg(F.max("links").alias("most"))
    joined = counted.join(F.broadcast(most), b_id == F.col("b"))
    return materialize(
        joined.select("pair", "links", (F.col("links") == F.col("most")).alias("best")), "pairs"
    )


def _step() -> F.Column:
    return F.floor(F.log2("links") * STEPS).cast("int")


def _head(counted: DataFrame, size: int) -> tuple[int, tuple[np.ndarray, ...]]:
    """The lowest step of counts of which all pairs fit in ``size`` with the steps above,
    and those pairs, sorted: pair, links, best."""
    total, least = 0, 64 * STEPS
    # At most 64 * STEPS rows.
    for row in counted.groupBy(_step().alias("step")).count().orderBy(F.desc("step")).collect():
        total += row["count"]
        if total > size:
            break
        least = row["step"]
    table = counted.where(_step() >= least).toArrow()
    pair, links = (table[c].to_numpy() for c in ("pair", "links"))
    best = table["best"].to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(pair)
    return least, (pair[order], links[order], best[order])


_SUMS = "row bigint, n_best bigint, count_sum bigint, pair bigint, times bigint"


def _sum_batches(head):
    """Sums over a document's frequent pairs, and one row for each other pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, links, best = head.value
        names = [c.split()[0] for c in _SUMS.split(", ")]
        for batch in batches:
            if not batch.num_rows:
                continue
            number = batch.column("row").to_numpy()
            row, pair, times = _pairs_of(batch)
            hit = np.zeros(len(pair), dtype=bool)
            sums = np.zeros((2, batch.num_rows), dtype=np.int64)
            if len(known):
                place = np.minimum(np.searchsorted(known, pair), len(known) - 1)
                hit = known[place] == pair
                place, at, n = place[hit], row[hit], times[hit]
                np.add.at(sums[0], at, n * best[place])
                np.add.at(sums[1], at, n * links[place])
            none = pa.nulls(batch.num_rows, pa.int64())
            columns = [pa.array(number), pa.array(sums[0]), pa.array(sums[1]), none, none]
            yield pa.RecordBatch.from_arrays(columns, names)
            rare = ~hit
            none = pa.nulls(int(rare.sum()), pa.int64())
            columns = [pa.array(number[row[rare]]), none, none]
            columns += [pa.array(pair[rare]), pa.array(times[rare])]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def align(
    docs: DataFrame,
    tokenizer: str,
    model: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    head: int = HEAD,
    piece: int = PIECE,
    with_groups: bool = False,
) -> DataFrame:
    """Alignment of a byte-level tokenizer's tokens (A, of the text with a space before it)
    with those of a sentencepiece model (B) per document.

    Columns: doc_id; n_a and n_b, the tokens; n_groups, the stretches between places where
    both have an end; n_links, the overlapping pairs of tokens; n_best, the links whose
    pair of ids is linked most often in the corpus among the pairs of that id of B, ties
    included; count_sum, over the links, of how often the pair is linked in the corpus;
    groups_sha256 and, if asked for, groups: ``a1,a2|b1;a3|b2,b3``.

    Texts that are null or empty, and those that A's or B's tokens do not spell, have
    zeros and empty strings, and count nothing. Rows that repeat, and rows without id, are
    taken each for itself; other columns are not looked at. A document is encoded whole, in
    memory that grows with its length; all else is bounded. An empty table gives no rows.
    """
    source = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    documents = materialize(
        source.mapInArrow(_align(tokenizer, model, piece, with_groups), _DOCUMENT), "alignment"
    )
    counted = _counted_pairs(documents)
    least, table = _head(counted, head)
    shared = docs.sparkSession.sparkContext.broadcast(table)
    narrow = documents.select("row", "pairs", "times")
    sums = materialize(narrow.mapInArrow(_sum_batches(shared), _SUMS), "link-sums")
    rest = counted.where(_step() < least)
    rare = sums.where(F.col("pair").isNotNull()).select("row", "pair", "times").join(rest, "pair")
    rare_sums = rare.select(
        "row",
        F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"),
        (F.col("times") * F.col("links")).alias("count_sum"),
    )
    known = sums.where(F.col("pair").isNull()).select("row", "n_best", "count_sum")
    total = known.unionByName(rare_sums).groupBy("row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
    )
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    columns += ["groups_sha256", *["groups"] * with_groups]
    return documents.drop("pairs", "times").join(total, "row").select(*columns)
