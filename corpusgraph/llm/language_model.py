"""A hashed maximum-entropy language model.

Words are taken with A-Z in lower case. The probability of a token is that of its class after the words before it, times that of
the token within its class. Classes are the end of a text, the most frequent words, each
its own, and the rest by a hash of a word's last letters. The class is a softmax over
hashed features: a bias, the previous word, the two previous words, and the word before
the previous one (a skip feature). Within a class the frequent words, and all others
together, are the leaves of a tree of two-way decisions. Each decision starts at the smoothed
counts below it, which without training gives a word its smoothed share of the class, and
learns from the same words before the token, hashed together with the decision. One of the
others has its smoothed share of them. So probabilities sum to one. Tasks train on their
documents from common weights, and the changes are averaged, weighted by tokens, after each
round.

Counts of the most frequent words travel to every task; the rest of the vocabulary stays
in Spark and meets the rarer words of each document in a join.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgraph.llm.words import Words, batch_words, mix
from corpusgraph.operators.sampling import top_n
from corpusgraph.sources.scratch import materialize

SMOOTHING = 0.1
OWN_CLASSES = 15  # most frequent words
SPELLED_CLASSES = 32
FREQUENT = 1 << 17  # counts sent to every task, 2 MB
BUCKETS = 1 << 14  # rows of the weights
LEAST_CELLS, MOST_CELLS = 1 << 12, 1 << 18  # weights of decisions, two for a word at least
CELL_POWER = 30.0  # at first: words that were seen once hardly change a decision
DECIDED_TOKENS = 1 << 12
ROUNDS = 2
RATE = 0.3
MINIBATCH = 1 << 14
SCORE_ROWS = 1 << 10
SLICES = 8
PLACE_BITS = 17  # about a frequent word for each
_U8 = np.uint64
_U4 = np.uint32
_CELL = _U4(0x9E3779B1)
END = _U8(0x0123456789ABCDEF)  # in place of a word's hash
_FEATURES = 4


@dataclass
class Model:
    """What a task needs: frequent words (sorted), class totals, the class weights, and the
    trees of the classes. A tree's leaves are the frequent words, in order, and one for the
    other words of each class. Leaf ``i`` is reached by ``number[i]`` decisions, which begin
    at ``first[i]``. Of each, the lower half is a hash whose last bit says which of two ways
    it takes, and the upper half the logarithm of the odds of that by counts."""

    words: np.ndarray
    counts: np.ndarray
    own: np.ndarray  # words that are their own class, after the end
    tokens: int
    distinct: int
    class_tokens: np.ndarray
    class_distinct: np.ndarray
    weights: np.ndarray
    first: np.ndarray
    number: np.ndarray
    paths: np.ndarray
    others: np.ndarray  # smoothed count of the other words of each class
    cells: np.ndarray  # hashed weights of decisions

    @property
    def classes(self) -> int:
        return 1 + len(self.own) + SPELLED_CLASSES

    def classes_of(self, hashes: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        out = spelled + (1 + len(self.own))
        out[hashes == END] = 0
        for k, word in enumerate(self.own):
            out[hashes == word] = k + 1
        return out

    def leaves(self, hashes: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The leaf of each token, and whether it is that of a frequent word."""
        if not len(self.words):
            return classes.copy(), np.zeros(len(hashes), dtype=bool)
        at = _places(self.words, hashes)
        frequent = self.words[at] == hashes
        return np.where(frequent, at, len(self.words) + classes), frequent


def _tokens(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, spelling class and text of all tokens; each text ends with the end."""
    texts = len(words.counts)
    place = np.arange(len(words.start)) + words.text_of_word()
    hashes = np.full(len(words.start) + texts, END, dtype=_U8)
    hashes[place] = words.hashes(seed=5)
    spelled = np.zeros(len(hashes), dtype=np.int64)
    last = words.start + words.length - 1
    before = np.where(words.length > 1, words.data[last - 1], 0).astype(_U8)
    spelled[place] = mix(before * _U8(256) + words.data[last]) % _U8(SPELLED_CLASSES)
    return hashes, spelled, np.repeat(np.arange(texts), words.counts + 1)


def _contexts(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hashes of what comes before each token: one word, two, and the one before the last."""

    def back(n: int) -> np.ndarray:
        out = np.zeros_like(hashes)
        out[n:] = np.where(text[n:] == text[:-n], hashes[:-n], 0) if len(hashes) > n else 0
        return out

    one, two = back(1), back(2)
    return mix(one), mix(one * _U8(3) + two + _U8(1)), mix(two + _U8(2))


def _features(contexts: tuple[np.ndarray, ...]) -> np.ndarray:
    """Rows of the weights that are active for each token."""
    rows = [m % _U8(BUCKETS - 1) + _U8(1) for m in contexts]
    return np.stack([np.zeros_like(rows[0]), *rows], axis=1).astype(np.int64)


def _scores(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Scores of all classes for each token, less the largest of the token."""
    scores = weights.take(rows[:, 1], axis=0)
    scores += weights[0]  # the bias, active for each token
    for k in range(2, _FEATURES):
        scores += weights.take(rows[:, k], axis=0)
    scores -= scores.max(axis=1, keepdims=True)
    return scores


def _chosen_log(weights: np.ndarray, rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The log10 probability of each token's class."""
    out = np.empty(len(rows))
    for a in range(0, len(rows), SCORE_ROWS):
        part = slice(a, a + SCORE_ROWS)
        scores = _scores(weights, rows[part])
        own = scores[np.arange(len(scores)), classes[part]].astype(np.float64)
        out[part] = own - np.log(np.exp(scores, out=scores).sum(axis=1))
    return out / np.log(10)


def _slope(weights: np.ndarray, rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """How the log probability of each token's class changes with the scores of all."""
    out = np.empty((len(rows), weights.shape[1]), dtype=weights.dtype)
    for a in range(0, len(rows), SCORE_ROWS):
        part = slice(a, a + SCORE_ROWS)
        scores = _scores(weights, rows[part])
        np.exp(scores, out=scores)
        np.divide(scores, -scores.sum(axis=1, keepdims=True), out=out[part])
    out[np.arange(len(rows)), classes] += 1
    return out


def _narrow(contexts: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """The contexts in 32 bits, for the cells of decisions."""
    return tuple((m >> _U8(32)).astype(_U4) for m in contexts)


def _decisions(
    model: Model, cells: np.ndarray, leaves: np.ndarray, contexts: tuple[np.ndarray, ...]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """How many decisions lead to each token's leaf, and of all these which way they take (1
    or -1), the logarithm of the odds of that, and the cells that it comes from."""
    shift = _U4(33 - len(cells).bit_length())
    number = model.number[leaves]
    ends = np.cumsum(number, dtype=np.int64)
    at = np.arange(ends[-1] if len(ends) else 0)
    at += np.repeat(model.first[leaves] - ends + number, number)
    halves = model.paths.take(at)
    node = halves.astype(_U4)
    side = (node & _U4(1)).astype(np.float32)
    side *= 2
    side -= 1
    node |= _U4(1)
    found = []
    learnt = np.zeros(len(at), dtype=np.float32)
    for m in contexts:
        cell = np.repeat(m, number)
        cell ^= node
        cell *= _CELL
        cell >>= shift
        found.append(cell.astype(np.int64))
        learnt += cells.take(found[-1])
    learnt *= side
    learnt += halves.view(np.float32)[1::2]
    return number, side, learnt, found


def _unlikely(odds: np.ndarray) -> np.ndarray:
    """1 / p of decisions, from the logarithm of their odds, which it overwrites."""
    np.maximum(odds, -80, out=odds)
    np.negative(odds, out=odds)
    np.exp(odds, out=odds)
    odds += 1
    return odds


def _inner_log(
    model: Model, leaves: np.ndarray, contexts: tuple[np.ndarray, ...]
) -> np.ndarray:
    """The log10 probability of each token's leaf within its class."""
    out = np.zeros(len(leaves))
    for a in range(0, len(leaves), DECIDED_TOKENS):
        part = slice(a, a + DECIDED_TOKENS)
        before = tuple(m[part] for m in contexts)
        number, _, odds, _ = _decisions(model, model.cells, leaves[part], before)
        some = np.flatnonzero(number)
        if len(some):
            starts = (np.cumsum(number, dtype=np.int64) - number)[some]
            lost = np.log(_unlikely(odds), out=odds)
            out[a + some] = -np.add.reduceat(lost, starts, dtype=np.float64)
    return out / np.log(10)


def _learn_inner(
    model: Model,
    cells: np.ndarray,
    power: np.ndarray,
    leaves: np.ndarray,
    contexts: tuple[np.ndarray, ...],
) -> None:
    """One step of the cells towards the leaves of some tokens."""
    slope = np.zeros(len(cells), dtype=np.float32)
    for a in range(0, len(leaves), DECIDED_TOKENS):
        part = slice(a, a + DECIDED_TOKENS)
        before = tuple(m[part] for m in contexts)
        _, side, odds, found = _decisions(model, cells, leaves[part], before)
        side -= side / _unlikely(odds)
        for at in found:
            np.add.at(slope, at, side)
    power += slope * slope
    slope *= RATE
    slope /= np.sqrt(power)
    cells += slope


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of a sorted array, where each begins, and how often it comes."""
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    first = np.flatnonzero(new)
    return values[first], first, np.diff(first, append=len(values))


def _places(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The place of the first of some sorted words at or after each hash, or the last place:
    a table over the first bits of words leaves a few of them to be passed."""
    shift = _U8(64 - PLACE_BITS)
    table = np.searchsorted(words, np.arange(1 << PLACE_BITS, dtype=_U8) << shift)
    last = max(0, len(words) - 1)
    at = np.minimum(table[hashes >> shift], last)
    rest = np.flatnonzero(words[at] < hashes) if len(words) else np.zeros(0, np.int64)
    while len(rest):
        rest = rest[at[rest] < last]
        at[rest] += 1
        rest = rest[words[at[rest]] < hashes[rest]]
    return at


def _added(values: np.ndarray) -> np.ndarray:
    """The sum of all rows, one at least, added in pairs until done."""
    while len(values) > 1:
        half = values[::2].copy()
        half[: len(values) // 2] += values[1::2]
        values = half
    return values


def _summed(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and the sums of their values: sorted, then added in pairs until done.

    A value is moved once and then only touched while it has a partner.
    """
    order = np.argsort(rows.astype(np.int16), kind="stable")  # rows are below BUCKETS
    rows, values = rows[order], values.take(order, axis=0)
    found, first, length = _runs(rows)
    place = np.arange(len(rows)) - np.repeat(first, length)
    after = np.repeat(length, length) - place
    step, at = 1, np.flatnonzero((place % 2 == 0) & (after > 1))
    while len(at):
        values[at] += values.take(at + step, axis=0)
        step *= 2
        at = at[(place[at] % (2 * step) == 0) & (after[at] > step)]
    return found, values.take(first, axis=0)


def _held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) to (hash, spelled, n) of distinct words of a batch's slices."""
    for batch in batches:
        for _, _, words in batch_words(batch.column(0), lower=True):
            hashes, spelled, _ = _tokens(words)
            order = np.argsort(hashes)
            found, first, n = _runs(hashes[order])
            kinds = spelled[order[first]].astype(np.int32)
            arrays = [pa.array(found.view(np.int64)), pa.array(kinds), pa.array(n)]
            yield pa.RecordBatch.from_arrays(arrays, ["hash", "spelled", "n"])


def _train(shared):
    """(text) to changed weights in slices, weighted by tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        weights, cells, seen = model.weights.copy(), model.cells.copy(), 0
        power = np.full(BUCKETS, 1e-3, dtype=np.float32)
        cell_power = np.full(len(cells), CELL_POWER, dtype=np.float32)
        for batch in batches:
            for _, _, words in batch_words(batch.column(0), lower=True):
                hashes, spelled, text = _tokens(words)
                contexts = _contexts(hashes, text)
                classes, rows = model.classes_of(hashes, spelled), _features(contexts)
                leaves, _ = model.leaves(hashes, classes)
                contexts = _narrow(contexts)
                seen += len(hashes)
                for a in range(0, len(hashes), MINIBATCH):
                    part = slice(a, a + MINIBATCH)
                    before = tuple(m[part] for m in contexts)
                    _learn_inner(model, cells, cell_power, leaves[part], before)
                    active = rows[a : a + MINIBATCH]
                    slope = _slope(weights, active, classes[a : a + MINIBATCH])
                    for k in range(_FEATURES):
                        at, step = _summed(active[:, k], slope) if k else ([0], _added(slope))
                        known = power.take(at)
                        known += (step**2).mean(axis=1)
                        power[at] = known
                        step *= RATE
                        step /= np.sqrt(known)[:, None]
                        step += weights.take(at, axis=0)
                        weights[at] = step
        if seen:
            change = np.append(weights - model.weights, cells - model.cells) * seen
            parts = [part.astype("<f4").tobytes() for part in np.array_split(change, SLICES)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(SLICES), pa.int32()), pa.array([seen] * SLICES), pa.array(parts, pa.binary())],
                ["part", "n", "change"],
            )

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by part, one change at a time."""
    sums: dict[int, list] = {}
    for batch in batches:
        for row in range(batch.num_rows):
            part, n, change = (batch.column(c)[row].as_py() for c in range(3))
            change = np.frombuffer(change, "<f4").astype(np.float64)
            held = sums.setdefault(part, [0, np.zeros(len(change))])
            held[0] += n
            held[1] += change
    if sums:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(sums), pa.int32()),
                pa.array([n for n, _ in sums.values()], pa.int64()),
                pa.array([c.astype("<f4").tobytes() for _, c in sums.values()], pa.binary()),
            ],
            ["part", "n", "change"],
        )


_CHANGE = "part int, n bigint, change binary"


def train(docs: DataFrame, model: Model, rounds: int = ROUNDS) -> Model:
    """Weights after one pass over the texts of ``docs`` (doc_id, text), a share per round."""
    context = docs.sparkSession.sparkContext
    share = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(9)), F.lit(rounds))
    for turn in range(rounds):
        shared = context.broadcast(model)
        changes = docs.filter(share == turn).select("text").mapInArrow(_train(shared), _CHANGE)
        # Twice, so that no task adds up the changes of all others.
        spread = changes.repartition(8 * SLICES, "part", F.pmod(F.spark_partition_id(), F.lit(16)))
        added = spread.mapInArrow(_add, _CHANGE).repartition(SLICES, "part").mapInArrow(_add, _CHANGE)
        found = {r["part"]: r for r in added.collect()}  # the size of the weights, whatever the data
        if found:
            parts = [np.frombuffer(found[k]["change"], "<f4") / found[k]["n"] for k in range(SLICES)]
            change, cells = np.split(np.concatenate(parts), [model.weights.size])
            change = change.reshape(model.weights.shape)
            model.weights = (model.weights + change).astype(np.float32)
            model.cells = (model.cells + cells).astype(np.float32)
        shared.unpersist()
    return model


_SCORED = (
    "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, "
    "score double, hash bigint, class int, n bigint"
)


def _score(shared):
    """(doc_id, held_out, text) to a row per document and one per rarer word of each."""
    names = [c.split()[0] for c in _SCORED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        number = TaskContext.get().partitionId() << 40
        base_log = np.log10((model.counts + SMOOTHING) / _room(model.tokens, model.distinct))
        class_log = np.log10(_room(model.class_tokens, model.class_distinct))
        for batch in batches:
            for start, stop, words in batch_words(batch.column(2), lower=True):
                hashes, spelled, text = _tokens(words)
                contexts = _contexts(hashes, text)
                classes, rows = model.classes_of(hashes, spelled), _features(contexts)
                chosen = _chosen_log(model.weights, rows, classes)
                leaves, frequent = model.leaves(hashes, classes)
                inner = _inner_log(model, leaves, _narrow(contexts))
                # A word that is its own class, or the end, has no tree.
                alone = np.flatnonzero(frequent & (classes <= len(model.own)))
                counts = model.counts[leaves[alone]]
                inner[alone] = np.log10(counts + SMOOTHING) - class_log[classes[alone]]
                base = np.zeros(len(hashes))
                base[frequent] = base_log[leaves[frequent]]
                size = stop - start
                sums = [np.bincount(text, v, minlength=size) for v in (frequent, base, chosen + inner)]
                ids = np.arange(number, number + size)
                number += size
                none = pa.nulls(size, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids),
                        batch.column(0).slice(start, size),
                        batch.column(1).slice(start, size),
                        pa.array(words.counts + 1),
                        pa.array(sums[0].astype(np.int64)),
                        pa.array(sums[1]),
                        pa.array(sums[2]),
                        none,
                        pa.nulls(size, pa.int32()),
                        none,
                    ],
                    names,
                )
                rare = np.flatnonzero(~frequent)
                rare = rare[np.lexsort((hashes[rare], text[rare]))]
                new = np.ones(len(rare), dtype=bool)
                new[1:] = (hashes[rare[1:]] != hashes[rare[:-1]]) | (text[rare[1:]] != text[rare[:-1]])
                first = np.flatnonzero(new)
                one = rare[first]
                columns = [pa.nulls(len(one), t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[text[one]]),
                        *columns,
                        pa.array(hashes[one].view(np.int64)),
                        pa.array(classes[one].astype(np.int32)),
                        pa.array(np.diff(np.append(first, len(rare)))),
                    ],
                    names,
                )

    return run


def _room(tokens, distinct):
    return tokens + SMOOTHING * (distinct + 1)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    A model is trained on the rows whose id's CRC-32, as text, is not divisible by ten;
    the others are held out; all are scored. Scores are sums of log10 probabilities of the
    words and the end; ``base_score`` is that of smoothed counts alone. An unseen word has
    the share of an unseen word among the words of its class that are not frequent.

    Null and empty texts are an end alone. A null id counts as the empty text: held out.
    Repeated rows count, and are scored, one by one. Without training rows every count is
    zero. An empty table gives an empty table. Words are told apart by 64-bit hashes.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    source = source.withColumn("held_out", _held_out())
    training = source.filter("not held_out")
    counted = training.select("text").mapInArrow(_count, "hash bigint, spelled int, n bigint")
    counted = counted.groupBy("hash").agg(F.min("spelled").alias("spelled"), F.sum("n").alias("c"))
    vocabulary = materialize(counted, "vocabulary")
    # A bounded number of frequent words, found by counting; the end is always among them.
    end = F.col("hash") == int(END.view(np.int64))
    common = top_n(vocabulary.filter(~end), "hash", FREQUENT - 1, by=F.col("c"), descending=True)
    top = vocabulary.filter(end).unionByName(common).toPandas()
    first = top["hash"] != int(END.view(np.int64))
    top = top.assign(first=first).sort_values(["first", "c", "hash"], ascending=[True, False, True])
    words, counts = top["hash"].to_numpy(np.int64).view(_U8), top["c"].to_numpy(np.int64)
    own = words[1 : OWN_CLASSES + 1].copy()
    model = _model(words, counts, top["spelled"].to_numpy(np.int64), own, vocabulary)
    model = train(training, model)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = source.select("doc_id", "held_out", "text").mapInArrow(_score(shared), _SCORED)
    scored = materialize(scored, "scored-words")
    rare = scored.filter("hash is not null").select("row", "hash", "class", "n")
    rare = rare.join(vocabulary.select("hash", "c"), "hash", "left")
    count = F.coalesce("c", F.lit(0))
    rooms = F.array(*[F.lit(float(r)) for r in model.others])
    mine = F.log10(count + SMOOTHING)
    sums = rare.groupBy("row").agg(
        F.sum(F.when(count > 0, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * (mine - float(np.log10(_room(model.tokens, model.distinct))))).alias("more_base"),
        F.sum(F.col("n") * (mine - F.log10(F.get(rooms, F.col("class"))))).alias("more_score"),
    )
    zero = F.lit(0)
    return scored.filter("hash is null").join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", zero)).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", zero)).alias("score"),
    )


def _trees(
    classes: np.ndarray, counts: np.ndarray, others: np.ndarray, alone: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The paths of the Huffman trees over the frequent words of each class and its other
    words, as in ``Model``; the first ``alone`` classes have no tree."""
    leaves = len(counts) + len(others)
    parent, right = np.full(2 * leaves, -1), np.zeros(2 * leaves, dtype=_U8)
    mass = np.concatenate([counts + SMOOTHING, others, np.zeros(leaves)])
    order = np.argsort(classes, kind="stable")
    ends = np.searchsorted(classes[order], np.arange(len(others) + 1))
    node = leaves
    for k in range(alone, len(others)):
        members = np.append(order[ends[k] : ends[k + 1]], len(counts) + k)
        heap = list(zip(mass[members].tolist(), members.tolist()))
        heapq.heapify(heap)
        while len(heap) > 1:
            (less, a), (more, b) = heapq.heappop(heap), heapq.heappop(heap)
            parent[a] = parent[b] = node
            right[b], mass[node] = 1, less + more
            heapq.heappush(heap, (less + more, node))
            node += 1
    number, at, steps = np.zeros(leaves, dtype=np.uint8), np.arange(leaves), []
    leaf = at
    while len(leaf):
        inner = np.flatnonzero(parent[at] >= 0)
        leaf, at = leaf[inner], at[inner]
        number[leaf] += 1
        steps.append((leaf, at))
        at = parent[at]
    # The paths of more frequent words come first, which keeps them together in a cache.
    often = np.argsort(-mass[:leaves], kind="stable")
    first = np.empty(leaves, dtype=np.int64)
    first[often] = np.cumsum(number[often], dtype=np.int64) - number[often]
    paths = np.empty(int(number.sum(dtype=np.int64)), dtype="<u8")
    for k, (leaf, at) in enumerate(steps):
        up = parent[at]
        odds = np.log(mass[at] / (mass[up] - mass[at])).astype("<f4")
        way = mix(up.astype(_U8)) >> _U8(33) << _U8(1) | right[at]
        paths[first[leaf] + k] = way | odds.view("<u4").astype(_U8) << _U8(32)
    return first, number, paths


def _model(
    words: np.ndarray,
    counts: np.ndarray,
    spelled_class: np.ndarray,
    own: np.ndarray,
    vocabulary: DataFrame,
) -> Model:
    """A model without training: frequent words in order, totals of the classes, and trees."""
    spelled = vocabulary.filter(~F.col("hash").isin([int(w) for w in np.append(own, END).view(np.int64)]))
    totals = spelled.groupBy("spelled").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()
    size = 1 + len(own) + SPELLED_CLASSES
    tokens, distinct = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
    tokens[: min(len(counts), 1 + len(own))] = counts[: 1 + len(own)]
    distinct[: min(len(counts), 1 + len(own))] = 1
    for row in totals:
        tokens[1 + len(own) + row["spelled"]] = row["c"]
        distinct[1 + len(own) + row["spelled"]] = row["v"]
    order = np.argsort(words)
    weights = np.zeros((BUCKETS, size), dtype=np.float32)
    # Those before are sorted by count: the end, and the words that are their own class.
    classes = spelled_class + 1 + len(own)
    first = min(len(classes), 1 + len(own))
    classes[:first] = np.arange(first)
    listed = np.bincount(classes, counts, minlength=size).astype(np.int64)
    others = _room(tokens - listed, distinct - np.bincount(classes, minlength=size))
    others[: 1 + len(own)] = _room(tokens, distinct)[: 1 + len(own)]
    trees = _trees(classes[order], counts[order], others, 1 + len(own))
    cells = 1 << int(np.clip(2 * distinct.sum(), LEAST_CELLS, MOST_CELLS) - 1).bit_length()
    return Model(
        words[order],
        counts[order],
        own,
        int(tokens.sum()),
        int(distinct.sum()),
        tokens,
        distinct,
        weights,
        *trees,
        others,
        np.zeros(cells, dtype=np.float32),
    )
