"""Token counts of documents from the counts of their distinct pre-tokens.

A byte-level tokenizer cuts a text into pre-tokens and merges bytes within each of them, so
a text has as many tokens as its pre-tokens have together. Three steps:

1. The distinct pre-tokens of all texts are gathered, with how often they occur.
2. The library encodes each distinct pre-token once; only its number of tokens is kept.
3. A second pass over the texts forms the frequencies of pre-tokens per document and joins
   them with these numbers. The most frequent pre-tokens, at most ``HEAD`` of them, meet in
   the tasks; the others meet in a shuffle join, where no key is frequent any more.

Ids are never formed for a text. Pre-tokens meet by two 64-bit hashes: two different ones
among n share both with a chance of n * n / 2 ** 129.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgraph.llm.words import SLICE_BYTES, Words, text_bytes
from corpusgraph.sources.scratch import materialize

LIMIT = 1024
HEAD = 1 << 19  # pre-tokens that every task gets, 24 bytes each
STEPS = 8  # of the histogram of frequencies, per doubling

LETTER, NUMBER, OTHER, WHITE = range(4)
# The white space of Unicode.
_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
_WHITE += [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Endings that the pattern takes off a word, after an apostrophe.
_ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")
_CUT = re.compile(rb"[\x21-\x7E][\x09-\x0D\x20]")


def _load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def special_strings(path: str) -> tuple[str, ...]:
    """Strings that the tokenizer takes as one token wherever they stand.

    Refuses a tokenizer file of another kind than the one this module counts by.
    """
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    splitter = made["pre_tokenizer"] or {}
    plain = splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True)
    if not plain or splitter.get("add_prefix_space") or made["normalizer"]:
        raise ValueError(f"{path} is not a plain byte-level tokenizer")
    for token in made["added_tokens"]:
        flags = ("single_word", "lstrip", "rstrip", "normalized")
        if any(token[f] for f in flags) or re.search(r"\s", token["content"]):
            raise ValueError(f"special token {token['content']!r} is not plain")
    return tuple(token["content"] for token in made["added_tokens"])


@lru_cache(maxsize=2)
def character_kinds(path: str) -> np.ndarray:
    """Letter, number, other or white space for every code point, as the library has it.

    Two versions of Unicode give the same kind to nearly all characters; where they do
    not, the library's own splitter decides.
    """
    import regex

    codes = np.array([c for c in range(0x110000) if not 0xD800 <= c < 0xE000])
    older, newer = (np.full(0x110000, OTHER, dtype=np.uint8) for _ in range(2))
    first = {"L": LETTER, "N": NUMBER}
    names = [unicodedata.category(chr(c))[0] for c in codes.tolist()]
    older[codes] = [first.get(n, OTHER) for n in names]
    everything = "".join(map(chr, codes.tolist()))
    for kind, name in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for run in regex.finditer(name, everything):
            newer[codes[run.start() : run.end()]] = kind
    splitter = _load(path).pre_tokenizer
    open_ones = np.flatnonzero(older != newer)
    kinds = older
    kinds[open_ones] = OTHER
    for kind, lead in ((LETTER, "a"), (NUMBER, "1")):
        # A letter joins a letter before it, a number a number.
        text = "".join(f"{lead}{chr(c)}\n" for c in open_ones.tolist())
        spans = [span for _, span in splitter.pre_tokenize_str(text)]
        joined = [a // 3 for a, b in spans if b - a == 2 and a % 3 == 0]
        kinds[open_ones[joined]] = kind
    kinds[_WHITE] = WHITE
    return kinds


def pretokens(data: np.ndarray, bounds: np.ndarray, kinds: np.ndarray) -> Words:
    """The pre-tokens of texts that lie one after the other in ``data``, in order.

    A pre-token is a run of letters, numbers or other characters with one space before it,
    an ending such as ``'s`` that does not follow a space, white space without its last
    character, that character if it is no space before something, or white space at the
    end of a text.
    """
    padded = np.append(data, np.zeros(8, dtype=np.uint8))
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return Words(padded, none, none, np.zeros(len(bounds), dtype=np.int64))
    at = np.flatnonzero((data & 0xC0) != 0x80)
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype="<u4")
    kind = kinds[codes]
    begin = np.ones(len(at), dtype=bool)
    begin[1:] = kind[1:] != kind[:-1]
    opens = np.zeros(len(at) + 1, dtype=bool)  # where a text begins or all end
    opens[np.searchsorted(at, bounds)] = True
    begin |= opens[:-1]
    last = np.flatnonzero((kind[:-1] == WHITE) & (kind[1:] != WHITE) & ~opens[1:-1])
    begin[last] = True
    begin[last[codes[last] == 32] + 1] = False
    marks = np.flatnonzero((codes == 0x27) & begin)
    for ending in _ENDINGS:
        fits = np.ones(len(marks), dtype=bool)
        for k, letter in enumerate(ending, start=1):
            place = np.minimum(marks + k, len(codes) - 1)
            fits &= (marks + k < len(codes)) & (codes[place] == ord(letter))
            fits &= ~opens[place]
        found = marks[fits]
        begin[found + 1] = False
        after = found + 1 + len(ending)
        begin[after[after < len(begin)]] = True
    start = at[begin]
    length = np.diff(np.append(start, len(data)))
    return Words(padded, start, length, np.searchsorted(start, bounds))


def _chunks(data: np.ndarray, bounds: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``limit`` bytes that cut no pre-token: whole texts, or parts
    of a longer one that end before white space."""
    start, size = 0, len(data)
    while start < size:
        stop = int(bounds[np.searchsorted(bounds, start + limit, side="right") - 1])
        if stop <= start:
            end = int(bounds[np.searchsorted(bounds, start, side="right")])
            stop, wide = end, limit
            while start + wide < end:
                found = [m.start() for m in _CUT.finditer(data[start : start + wide].tobytes())]
                if found:
                    stop = start + found[-1] + 1
                    break
                wide *= 2
        yield start, stop
        start = stop


class Pieces:
    """The pre-tokens of one chunk of texts, and the special strings between them."""

    def __init__(self, data, bounds, start, stop, kinds, special):
        part = data[start:stop]
        edges = {0, stop - start, *(bounds[(bounds > start) & (bounds < stop)] - start).tolist()}
        marked = set()
        if special:
            for found in special.finditer(part.tobytes()):
                edges |= {found.start(), found.end()}
                marked.add(found.start())
        cuts = np.array(sorted(edges), dtype=np.int64)
        row = np.searchsorted(bounds, cuts[:-1] + start, side="right") - 1
        words = pretokens(part, cuts, kinds)
        is_special = np.isin(cuts[:-1], list(marked))
        text = words.text_of_word()
        kept = ~is_special[text]
        none = words.first[:0]
        self.words = Words(words.data, words.start[kept], words.length[kept], none)
        self.row = row[text[kept]]
        self.special_rows = row[is_special]

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        return self.words.hashes(), self.words.hashes(seed=1)


def _distinct(h0: np.ndarray, h1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One position of each distinct pair, and how often it occurs."""
    _, one, back, times = np.unique(h0, return_index=True, return_inverse=True, return_counts=True)
    if (h1 != h1[one][back]).any():
        pairs = np.rec.fromarrays([h0, h1])
        _, one, times = np.unique(pairs, return_index=True, return_counts=True)
    return one, times


def _binaries(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.Array:
    """Stretches of ``data`` as a binary column."""
    ends = np.append(0, np.cumsum(length))
    at = np.repeat(start - ends[:-1], length) + np.arange(ends[-1])
    buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data[at])]
    return pa.Array.from_buffers(pa.binary(), len(start), buffers)


def _chunk_pieces(batch_column, kinds, special, limit):
    data, bounds = text_bytes(batch_column)
    for start, stop in _chunks(data, bounds, limit):
        yield Pieces(data, bounds, start, stop, kinds, special)


def _list_pieces(kinds, special, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pieces in _chunk_pieces(batch.column(0), kinds.value, special, limit):
                one, times = _distinct(*pieces.hashes())
                words = pieces.words
                found = _binaries(words.data, words.start[one], words.length[one])
                yield pa.RecordBatch.from_arrays([found, pa.array(times)], ["piece", "n"])

    return run


def _count_pieces(path: str):
    """Number of tokens of each distinct pre-token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _load(path)
        for batch in batches:
            if not batch.num_rows:
                continue
            pieces = batch.column(0).cast(pa.string())
            texts = pieces.to_pylist()
            sizes = []
            for k in range(0, len(texts), 4096):
                made = tokenizer.encode_batch_fast(texts[k : k + 4096], add_special_tokens=False)
                sizes += [len(e) for e in made]
            data, bounds = text_bytes(pieces)
            padded = np.append(data, np.zeros(8, dtype=np.uint8))
            words = Words(padded, bounds[:-1], np.diff(bounds), bounds)
            columns = [pa.array(words.hashes(s).view(np.int64)) for s in (0, 1)]
            columns += [pa.array(sizes, pa.int64()), batch.column(1)]
            yield pa.RecordBatch.from_arrays(columns, ["h0", "h1", "tokens", "n"])

    return run


def _head(counted: DataFrame, size: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """The lowest frequency step of which all pre-tokens fit in ``size`` with the steps
    above, and those pre-tokens sorted by hash: hashes, hashes, numbers of tokens."""
    step = F.floor(F.log2("n") * STEPS).cast("int")
    total, least = 0, None
    # At most 64 * STEPS rows.
    for row in counted.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        total += row["count"]
        if total > size:
            break
        least = row["step"]
    if least is None:
        least = 64 * STEPS
    table = counted.where(step >= least).select("h0", "h1", "tokens").toArrow()
    h0, h1 = (table[c].to_numpy().view(np.uint64) for c in ("h0", "h1"))
    order = np.argsort(h0)
    return least, h0[order], h1[order], table["tokens"].to_numpy()[order]


_NAMES = ["special", "row", "doc_id", "n_bytes", "tokens", "h0", "h1", "times"]


def _sum_pieces(kinds, special, limit: int, head):
    """Two kinds of rows: a document with its bytes and the tokens known so far, and a
    rarer pre-token of a document with its frequency there."""

    def documents(batch, first, sizes, tokens):
        rows = batch.num_rows
        number = pa.array(np.arange(first, first + rows))
        none = pa.nulls(rows, pa.int64())
        kind = pa.array(np.zeros(rows, dtype=bool))
        columns = [kind, number, batch.column(1), pa.array(sizes), pa.array(tokens)]
        return pa.RecordBatch.from_arrays([*columns, none, none, none], _NAMES)

    def rare(number, h0, h1, times):
        none = pa.nulls(len(number), pa.int64())
        kind = pa.array(np.ones(len(number), dtype=bool))
        hashes = [pa.array(h.view(np.int64)) for h in (h0, h1)]
        columns = [kind, pa.array(number), none, none, none, *hashes, pa.array(times)]
        return pa.RecordBatch.from_arrays(columns, _NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        known0, known1, numbers = head.value
        for batch in batches:
            sizes = np.diff(text_bytes(batch.column(0))[1])
            tokens = np.zeros(batch.num_rows, dtype=np.int64)
            for pieces in _chunk_pieces(batch.column(0), kinds.value, special, limit):
                np.add.at(tokens, pieces.special_rows, 1)
                (h0, h1), row = pieces.hashes(), pieces.row
                if len(known0):
                    place = np.minimum(np.searchsorted(known0, h0), len(known0) - 1)
                    hit = (known0[place] == h0) & (known1[place] == h1)
                    found = np.bincount(row[hit], numbers[place[hit]], len(tokens))
                    tokens += found.astype(np.int64)
                    h0, h1, row = h0[~hit], h1[~hit], row[~hit]
                if len(row):
                    order = np.lexsort((h1, h0, row))
                    h0, h1, row = h0[order], h1[order], row[order]
                    new = np.ones(len(row), dtype=bool)
                    new[1:] = (row[1:] != row[:-1]) | (h0[1:] != h0[:-1]) | (h1[1:] != h1[:-1])
                    at = np.flatnonzero(new)
                    times = np.diff(np.append(at, len(row)))
                    yield rare(first + row[at], h0[at], h1[at], times)
            yield documents(batch, first, sizes, tokens)
            first += batch.num_rows

    return run


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = LIMIT,
    head: int = HEAD,
    chunk_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Bytes and tokens of every text under a byte-level tokenizer file.

    Columns: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens). Counts are
    those of the library without begin, end or added special tokens; a special string
    inside a text is one token.

    Null and empty texts have no bytes and no tokens. Rows that repeat, and rows without
    id, are counted each for itself; other columns are not looked at. A text longer than
    ``chunk_bytes`` is taken in parts that end before white space, so only a text without
    white space is held whole. An empty table gives no rows. ``head`` bounds what every
    task gets; the result does not depend on it.
    """
    spark = docs.sparkSession
    strings = sorted(special_strings(tokenizer), key=len, reverse=True)
    special = re.compile(b"|".join(re.escape(s.encode()) for s in strings)) if strings else None
    kinds = spark.sparkContext.broadcast(character_kinds(tokenizer))
    texts = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("doc_id"))

    listed = texts.select("text").mapInArrow(
        _list_pieces(kinds, special, chunk_bytes), "piece binary, n bigint"
    )
    distinct = listed.groupBy("piece").agg(F.sum("n").alias("n"))
    counted = materialize(
        distinct.mapInArrow(
            _count_pieces(tokenizer), "h0 bigint, h1 bigint, tokens bigint, n bigint"
        ),
        "pieces",
    )
    least, *table = _head(counted, head)
    shared = spark.sparkContext.broadcast(tuple(table))
    schema = "special boolean, row bigint, doc_id bigint, n_bytes bigint, tokens bigint, "
    schema += "h0 bigint, h1 bigint, times bigint"
    parts = materialize(
        texts.mapInArrow(_sum_pieces(kinds, special, chunk_bytes, shared), schema),
        "piece-frequencies",
        ["special"],
    )
    rest = counted.where(F.floor(F.log2("n") * STEPS).cast("int") < least)
    rare = parts.where("special").select("row", "h0", "h1", "times")
    sums = (
        rare.join(rest.select("h0", "h1", F.col("tokens").alias("each")), ["h0", "h1"])
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.col("each")).alias("more"))
    )
    whole = parts.where(~F.col("special")).select("row", "doc_id", "n_bytes", "tokens")
    total = F.col("tokens") + F.coalesce("more", F.lit(0))
    return whole.join(sums, "row", "left").select(
        "doc_id", "n_bytes", total.alias("n_tokens"), (total > limit).alias("over_limit")
    )
