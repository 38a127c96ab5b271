"""Runs of words that repeat with a period, found through suffix trees.

Documents of a batch stand one after the other with separators before, between and after
them, each of which occurs once, so no common extension leaves a document. Over that sequence, and over its
reversal, Ukkonen's algorithm builds a suffix tree; an Euler tour with a sparse table of
minima answers for any two positions in constant time how far they extend alike, to the
right and to the left.

A run's Lyndon root begins at some word and is the longest Lyndon word there, in the order
of words or in its inverse. That word ends where the next smaller suffix begins, so each
position gives two candidates; both are extended to both sides, and are runs if they hold
their root often enough.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_WORDS = 6
LEAST_TIMES = 4
TREE_WORDS = 1 << 14  # words of a tree, unless a document alone has more

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def suffix_tree(text: list[int], symbols: int) -> tuple[dict, list[int], list[int]]:
    """Ukkonen's suffix tree: children by node * symbols + first symbol, and where the
    label of each node's edge begins and ends. The last symbol must occur nowhere else."""
    size, count = len(text), 1
    begins, ends = [0] * (2 * size + 1), [size] * (2 * size + 1)
    ends[0] = 0
    links, children = {}, {}
    find, link_of = children.get, links.get
    node = edge = depth = left = 0
    for i, symbol in enumerate(text):
        left += 1
        unlinked = 0
        while left:
            if depth:
                key = node * symbols + text[edge]
            else:
                edge = i
                key = node * symbols + symbol
            child = find(key)
            if child is None:
                children[key] = count
                begins[count] = i
                count += 1
                if unlinked:
                    links[unlinked] = node
                    unlinked = 0
            else:
                begin = begins[child]
                length = ends[child] - begin
                if depth >= length:
                    edge += length
                    depth -= length
                    node = child
                    continue
                middle = begin + depth
                if text[middle] == symbol:
                    depth += 1
                    if unlinked:
                        links[unlinked] = node
                    break
                children[key] = count
                begins[count], ends[count] = begin, middle
                begins[count + 1] = i
                children[count * symbols + symbol] = count + 1
                begins[child] = middle
                children[count * symbols + text[middle]] = child
                if unlinked:
                    links[unlinked] = count
                unlinked = count
                count += 2
            left -= 1
            if node:
                node = link_of(node, 0)
            elif depth:
                depth -= 1
                edge = i - left + 1
    del begins[count:], ends[count:]
    return children, begins, ends


def _minima(values: np.ndarray) -> list[np.ndarray]:
    """Sparse table: row k has the minimum of 2**k values from each place on."""
    table, step = [values], 1
    while 2 * step <= len(values):
        table.append(np.minimum(table[-1][:-step], table[-1][step:]))
        step *= 2
    return table


class Extensions:
    """Suffix tree of a sequence with constant-time longest common extensions."""

    def __init__(self, text: np.ndarray, symbols: int):
        children, begins, ends = suffix_tree(text.tolist(), symbols)
        keys = np.fromiter(children.keys(), np.int64, len(children))
        nodes = np.fromiter(children.values(), np.int64, len(children))
        self._count = len(begins)
        self._parent = np.full(self._count, -1)
        self._parent[nodes] = keys // symbols
        length = np.fromiter(ends, np.int64, self._count)
        length -= np.fromiter(begins, np.int64, self._count)
        levels, first, counts = self._levels(nodes[np.argsort(keys)])
        self._depth = np.zeros(self._count, dtype=np.int32)
        self._size = np.ones(self._count, dtype=np.int64)
        level = np.zeros(self._count, dtype=np.int64)
        for k, below in enumerate(levels[1:], start=1):
            self._depth[below] = self._depth[self._parent[below]] + length[below]
            level[below] = k
        for below in levels[:0:-1]:
            parents = self._parent[below]
            heads = np.flatnonzero(np.append(True, parents[1:] != parents[:-1]))
            self._size[parents[heads]] += np.add.reduceat(self._size[below], heads)
        leaves = np.flatnonzero(counts == 0)
        self._leaf = np.zeros(len(text), dtype=np.int64)
        self._leaf[len(text) - self._depth[leaves]] = leaves
        # The Euler tour: a node stands where it is entered, and once more after each child.
        place = self._places(levels, first, counts)
        entered = 2 * place - level
        tour = np.zeros(2 * self._count - 1, dtype=np.int32)
        tour[entered] = self._depth
        inner = np.flatnonzero(self._parent >= 0)
        tour[entered[inner] + 2 * self._size[inner] - 1] = self._depth[self._parent[inner]]
        self._tour = _minima(tour)
        self._entered = entered[self._leaf]
        # Ranks of suffixes, and those when all symbols compare the other way round: then
        # the nodes before one are its ancestors and what came after its subtree.
        self.rank = place[self._leaf]
        inverse = level + self._count - place - self._size
        self.inverse_rank = inverse[self._leaf]

    def _levels(self, by_parent: np.ndarray):
        """Nodes level by level, from all nodes but the root by parent and symbol; where
        each node's children begin there, and how many there are."""
        counts = np.bincount(self._parent[by_parent], minlength=self._count)
        first = np.cumsum(counts) - counts
        levels, level = [], np.zeros(1, dtype=np.int64)
        while len(level):
            levels.append(level)
            number = counts[level]
            total = np.cumsum(number)
            at = np.repeat(first[level] - (total - number), number) + np.arange(total[-1])
            level = by_parent[at]
        return levels, first, counts

    def _places(self, levels, first, counts) -> np.ndarray:
        """Places of all nodes when a node comes before its children."""
        place = np.zeros(self._count, dtype=np.int64)
        for above, below in zip(levels, levels[1:], strict=False):
            before = np.cumsum(self._size[below]) - self._size[below]
            number = counts[above][counts[above] > 0]
            head = np.repeat(before[np.cumsum(number) - number], number)
            place[below] = place[self._parent[below]] + 1 + before - head
        return place

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How long the suffixes from ``a`` and from ``b`` are equal, for a != b."""
        x, y = self._entered[a], self._entered[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        power = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.empty(len(a), dtype=np.int64)
        for k in np.unique(power):
            at, row = np.flatnonzero(power == k), self._tour[k]
            out[at] = np.minimum(row[low[at]], row[high[at] + 1 - (1 << k)])
        return out


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """The next place with a smaller value, the length if there is none."""
    size = len(rank)
    table = _minima(rank)
    place = np.arange(1, size + 1)
    for k in range(len(table) - 1, -1, -1):
        row = table[k]
        fits = np.flatnonzero(place + (1 << k) <= size)
        fits = fits[row[place[fits]] > rank[fits]]
        place[fits] += 1 << k
    return place


def runs_of(
    texts: list[np.ndarray], symbols: int, least: int, times: int
) -> tuple[np.ndarray, ...]:
    """Runs of sequences of symbols from 0 on: sequence, start, length and period, by
    sequence, start and period.

    In a run every symbol comes back, so symbols that a sequence has only once cut it like
    its ends do; those that stand together are one separator. Separators are less than all
    symbols in one order and greater in its inverse. In one of the two, what follows a run
    is less than what would continue it, and there its Lyndon root is the longest Lyndon
    word where it begins.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    begin = np.cumsum(sizes) - sizes
    whole = np.concatenate([*texts, np.zeros(0, dtype=np.int64)])
    text = np.repeat(np.arange(len(texts)), sizes)
    _, back, number = np.unique(text * symbols + whole, return_inverse=True, return_counts=True)
    place = np.flatnonzero(number[back] > 1)
    cut = np.ones(len(place), dtype=bool)
    cut[1:] = (np.diff(place) > 1) | (np.diff(text[place]) > 0)
    separators = int(cut.sum()) + 1
    words = np.arange(len(place)) + np.cumsum(cut)
    inside = np.zeros(len(place) + separators, dtype=bool)
    inside[words] = True
    code = np.empty(len(inside), dtype=np.int64)
    code[words], code[~inside] = whole[place] + separators, np.arange(separators)
    symbols += separators
    right, left = Extensions(code, symbols), Extensions(code[::-1], symbols)
    last = len(code) - 1
    found = []
    for rank in (right.rank, right.inverse_rank):
        after = next_smaller(rank)[words]
        first, after = words[after <= last], after[after <= last]
        period = after - first
        start = first - left.common(last - (first - 1), last - (after - 1))
        length = after + right.common(first, after) - start
        kept = (length >= 2 * period) & (length >= np.maximum(least, times * period))
        found.append(np.stack([start[kept], length[kept], period[kept]]))
    runs = np.unique(np.concatenate(found, axis=1), axis=1)
    start, length, period = runs[:, np.lexsort((runs[2], runs[0]))]
    start = place[np.searchsorted(words, start)]
    return text[start], start - begin[text[start]], length, period


def _groups(column: pa.Array, limit: int) -> Iterator[tuple[int, list[list[str]]]]:
    """The words of some texts with at most ``limit`` words together, or of one text, and
    the place of the first of them; few words are held at a time."""
    held: list[list[str]] = []
    start = total = 0
    for k, text in enumerate(column):
        words = _WORD.findall(text.as_py() or "")
        if total and total + len(words) > limit:
            yield start, held
            start, held, total = k, [], 0
        held.append(words)
        total += len(words)
    if held:
        yield start, held


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = (
    "doc_id bigint, n_words bigint, collapsed string, "
    "runs array<struct<start: bigint, length: bigint, period: bigint>>"
)


def _find(least: int, times: int, tree_words: int):
    def part(texts: list[list[str]]) -> tuple[list[str], pa.Array]:
        known: dict[str, int] = {}
        coded = [
            np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
            for words in texts
        ]
        text, *run = runs_of(coded, len(known), least, times)
        cuts = np.searchsorted(text, np.arange(len(texts) + 1))
        collapsed = []
        for k, words in enumerate(texts):
            here = slice(cuts[k], cuts[k + 1])
            if cuts[k] < cuts[k + 1]:
                change = np.zeros(len(words) + 1, dtype=np.int64)
                start, length, period = (c[here] for c in run)
                np.add.at(change, start + period, 1)
                np.add.at(change, start + length, -1)
                gone = np.cumsum(change[:-1]) > 0
                words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            collapsed.append(" ".join(words))
        columns = [pa.array(c, pa.int64()) for c in run]
        rows = pa.StructArray.from_arrays(columns, fields=list(_RUN))
        return collapsed, pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_words", "collapsed", "runs"]
        for batch in batches:
            for start, chosen in _groups(batch.column(1), tree_words):
                collapsed, runs = part(chosen)
                numbers = pa.array([len(w) for w in chosen], pa.int64())
                ids = batch.column(0).slice(start, len(chosen))
                columns = [ids, numbers, pa.array(collapsed, pa.string()), runs]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST_WORDS,
    times: int = LEAST_TIMES,
    tree_words: int = TREE_WORDS,
) -> DataFrame:
    """Runs of words per document, and its text without their repetitions.

    A run is a stretch of words with smallest period q, of at least ``least`` words and
    ``times`` periods (two or more), that no neighbouring word extends. Columns: doc_id,
    n_words, runs (start, length, period; by start, then period) and collapsed, the words
    that no run has after its first q words, joined by one space.

    Null, empty and blank texts have no words, no runs and an empty collapsed text. Rows
    that repeat, and rows without id, are taken each for itself; other columns are not
    looked at. A batch of up to ``tree_words`` words shares a tree; a longer document is a
    tree of its own, in memory that grows with its words (about a kilobyte each). An empty
    table gives no rows. There is no shuffle.
    """
    if times < 2:
        raise ValueError("a run holds its period at least twice")
    source = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    return source.mapInArrow(_find(least, times, tree_words), _SCHEMA)
