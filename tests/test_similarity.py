"""Pair joins, clustering and distributions against brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusgraph.functions import vectors as vec
from corpusgraph.operators import blocks, clustering, distribution
from corpusgraph.operators import similarity as sim

LAYOUTS = [
    {},
    {"block_rows": 90, "pivots": 1},
    {"block_rows": 60, "pivots": 8},
]


def families(seed=0, n=400, dim=12, noise=0.25, copies=80):
    """Noisy copies of a few centres, a hot group of exact copies, and a zero vector."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    found = centres[rng.integers(0, 12, n)] + noise * rng.normal(size=(n, dim))
    found[n - copies : n - 1] = found[0]
    found[n - 1] = 0
    return found


def frame(spark, matrix, ids=None):
    ids = ids or list(range(len(matrix)))
    kind = "string" if isinstance(ids[0], str) else "bigint"
    rows = list(zip(ids, matrix.tolist()))
    return spark.createDataFrame(rows, f"id {kind}, v array<double>").repartition(5)


def cosines(matrix):
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    unit = matrix / np.where(norms == 0, 1, norms)
    return np.round(unit @ unit.T, 9)


def brute_neighbours(sims, k, threshold, allowed):
    found = {}
    for j in range(len(sims)):
        ranked = sorted(
            (-sims[j, i], i)
            for i in range(len(sims))
            if i != j and sims[j, i] >= threshold and allowed(i, j)
        )
        for place, (score, i) in enumerate(ranked[:k]):
            found[j, place + 1] = (i, pytest.approx(-score, abs=1e-8))
    return found


def as_neighbours(df, number=int):
    return {
        (number(r["id"]), r["rank"]): (number(r["neighbour"]), r["similarity"])
        for r in df.collect()
    }


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("lower", [False, True])
def test_nearest_equals_brute_force(spark, layout, lower):
    matrix = families()
    vectors = blocks.load_vectors(frame(spark, matrix), "id", "v")
    found = sim.nearest(vectors, 5, 0.8, lower, **layout)
    expected = brute_neighbours(
        cosines(matrix), 5, 0.8, lambda i, j: not lower or i < j
    )
    assert as_neighbours(found) == expected


@pytest.mark.parametrize("layout", LAYOUTS)
def test_nearest_in_a_base_equals_brute_force(spark, layout):
    matrix = families(1)
    names = [f"k{i:04d}" for i in range(len(matrix))]
    vectors = blocks.load_vectors(frame(spark, matrix, names), "id", "v")
    base = vectors.subset(vectors.rows.where("id < 'k0070'"))
    found = sim.nearest_in(base, vectors, 4, 0.7, **layout)
    expected = brute_neighbours(cosines(matrix), 4, 0.7, lambda i, j: i < 70)
    assert as_neighbours(found, lambda x: int(x[1:])) == expected


@pytest.mark.parametrize("layout", LAYOUTS)
def test_pairs_of_different_vectors_with_their_copies(spark, layout):
    matrix = families()
    sims = cosines(matrix)
    groups = {}
    for i in range(len(matrix) - 1):
        groups.setdefault(matrix[i].tobytes(), []).append(i)
    copies = {g[0]: len(g) for g in groups.values()}
    heads = sorted(copies)
    expected = {
        (i, j): (pytest.approx(sims[i, j], abs=1e-8), copies[i], copies[j])
        for place, i in enumerate(heads)
        for j in heads[place + 1 :]
        if sims[i, j] >= 0.8
    }
    found = {
        (r["low"], r["high"]): (r["similarity"], r["low_copies"], r["high_copies"])
        for r in sim.similar_pairs(frame(spark, matrix), "id", "v", 0.8, **layout).collect()
    }
    assert found == expected
    assert max(copies.values()) == 80


def test_pivots_spare_work_and_blocks_stay_bounded(spark):
    matrix = families(noise=0.1, copies=130)
    vectors = blocks.load_vectors(frame(spark, matrix), "id", "v")
    whole = blocks.self_strips(vectors, 0.95, 50, pivots=1)
    pruned = blocks.self_strips(vectors, 0.95, 50, pivots=12)
    assert pruned.rows.count() < 0.7 * whole.rows.count()
    assert pruned.layout.pairs < 0.3 * whole.layout.pairs
    for strips in (whole, pruned):
        # Half of the blocks of a circle and the parts that hold a block, as planned.
        assert abs(strips.rows.count() / strips.layout.sent - 1) < 0.15
        held = strips.rows.where("role < 2").groupBy("strip").count()
        assert held.agg(F.max("count")).first()[0] < 100
    assert whole.rows.count() < 0.65 * whole.number * vectors.count


def test_every_pair_of_blocks_meets_once(spark):
    for count in (1, 2, 3, 4, 7, 8):
        vectors = blocks.load_vectors(frame(spark, families()[:-1]), "id", "v")
        strips = blocks.self_strips(vectors, 0.0, -(-vectors.count // count), pivots=1)
        assert len(strips.layout.blocks) == 1
        schema = "low bigint, high bigint"

        def pairs(left_ids, left, right_ids, right, same):
            import pyarrow as pa

            a, b = (x.ravel() for x in np.meshgrid(left_ids, right_ids))
            kept = a < b if same else a != b
            low, high = np.minimum(a, b)[kept], np.maximum(a, b)[kept]
            yield pa.table({"low": low, "high": high})

        found = strips.reduce(pairs, schema)
        n = vectors.count
        assert (found.count(), found.distinct().count()) == (n * (n - 1) // 2,) * 2


def test_cells_that_spare_nothing_are_given_up(spark, monkeypatch):
    monkeypatch.setattr(blocks, "_pivot_number", lambda rows, block_rows: 12)
    rng = np.random.default_rng(5)
    spread = blocks.load_vectors(frame(spark, rng.normal(size=(300, 30))), "id", "v")
    near = blocks.load_vectors(frame(spark, families(noise=0.02)), "id", "v")
    assert len(blocks.self_strips(spread, 0.3, 50).layout.blocks) == 1
    assert len(blocks.self_strips(near, 0.95, 50).layout.blocks) > 1
    assert len(blocks.cross_strips(spread, spread, 0.3, 50).layout.blocks) == 1


def test_two_levels_of_pivots_lose_no_pair(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(60, 8))
    matrix = centres[rng.integers(0, 60, 900)] + 0.1 * rng.normal(size=(900, 8))
    vectors = blocks.load_vectors(frame(spark, matrix), "id", "v")
    pivots = blocks.choose_pivots(vectors, 60)
    assert len(pivots) > blocks.ONE_LEVEL and 1 < len(pivots.leading) < 12
    assert sorted(np.concatenate(pivots.members)) == list(range(len(pivots)))
    found = sim.all_lower(vectors, 0.9, block_rows=40, pivots=60)
    sims = cosines(matrix)
    low, high = np.nonzero(np.triu(sims >= 0.9, 1))
    got = {(r["neighbour"], r["id"]) for r in found.collect()}
    assert got == set(zip(low.tolist(), high.tolist())) and len(got) > 1000


def test_plans_have_no_cross_join(spark):
    vectors = blocks.load_vectors(frame(spark, families()), "id", "v")
    plan = sim.nearest(vectors, 3, 0.8, block_rows=50)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_vectors_of_different_lengths_are_refused(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "id int, v array<double>")
    with pytest.raises(ValueError, match="1 to 2 elements"):
        blocks.load_vectors(df, "id", "v")


def test_repeated_ids_are_refused(spark):
    df = spark.createDataFrame([(1, [1.0]), (1, [2.0])], "id int, v array<double>")
    with pytest.raises(ValueError, match="id 1 has more than one vector"):
        blocks.load_vectors(df, "id", "v")


def test_no_vectors_at_all(spark):
    empty = spark.createDataFrame([], "id bigint, v array<double>")
    assert sim.knn(empty, "id", "v").count() == 0
    vectors = blocks.load_vectors(empty, "id", "v")
    assert clustering.cluster(vectors).members.count() == 0


def test_row_functions(spark):
    df = spark.createDataFrame(
        [([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0]), (None, [1.0])],
        "a array<double>, b array<double>",
    )
    a, b = F.col("a"), F.col("b")
    found = df.select(
        vec.normalize(a), vec.cosine(a, b), vec.has_dimension(2, a, b)
    ).collect()
    assert tuple(found[0]) == ([0.6, 0.8], pytest.approx(0.96), True)
    assert tuple(found[1]) == ([0.0, 0.0], 0.0, True)
    assert tuple(found[2]) == (None, None, False)


def hash_order(ids):
    return sorted(ids, key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())


def one_at_a_time(sims, merge=0.9, link=0.8, order=None):
    """Add the rows in order: merge with the best leader or become one."""
    leaders, members, links = [], {}, {}
    order = order or hash_order(range(len(sims)))
    turn = {t: k for k, t in enumerate(order)}
    for t in order:
        near = sorted((-sims[t, o], turn[o], o) for o in leaders if sims[t, o] >= link)
        own = near[0][2] if near and -near[0][0] >= merge else t
        members[t] = own
        for score, _, o in near:
            if link <= -score < merge and o != own:
                links[own, o] = pytest.approx(-score, abs=1e-8)
        if own == t:
            leaders.append(t)
    return members, links


def chained(n=240):
    """A long chain: every row merges with its neighbours but not beyond."""
    angle = np.arange(n) * 0.4
    return np.stack([np.cos(angle), np.sin(angle), np.arange(n) * 0.02], axis=1)


def wheel(spokes=25):
    """Rows far from each other, and a last one that is related to all of them."""
    rows = np.c_[np.full(spokes, 0.85), np.eye(spokes) * 0.5268]
    return np.vstack([rows, np.eye(spokes + 1)[0]])


@pytest.mark.parametrize(
    ("matrix", "options"),
    [
        (families()[:-1], {}),
        (wheel(), {}),
        (families(3)[:-1], {"block_rows": 60, "pivots": 8, "finish_rows": 10}),
        (chained(), {}),
        (chained(60), {"finish_rows": 1}),
    ],
)
def test_clusters_equal_one_at_a_time(spark, matrix, options):
    vectors = blocks.load_vectors(frame(spark, matrix), "id", "v")
    clusters = clustering.cluster(vectors, **options)
    members, links = one_at_a_time(cosines(matrix))
    assert {r["id"]: r["leader"] for r in clusters.members.collect()} == members
    found = clustering.similar_links(clusters).collect()
    assert {(r["src"], r["dst"]): r["similarity"] for r in found} == links


def test_clustering_in_two_runs_equals_one(spark):
    matrix = families(4)[:-1]
    vectors = blocks.load_vectors(frame(spark, matrix), "id", "v")
    first = clustering.cluster(vectors.subset(vectors.rows.where("id < 200")))
    rest = vectors.subset(vectors.rows.where("id >= 200"))
    second = clustering.cluster(rest, known=first.leaders)
    both = first.members.unionByName(second.members).collect()
    order = hash_order(range(200)) + hash_order(range(200, len(matrix)))
    members, links = one_at_a_time(cosines(matrix), order=order)
    assert {r["id"]: r["leader"] for r in both} == members
    found = {(r["src"], r["dst"]): r["similarity"] for r in clustering.similar_links(second).collect()}
    assert found and found.items() <= links.items()


def test_settled_rows_are_not_compared_with_leaders(spark, monkeypatch):
    """Rows with no more earlier neighbours than are kept need one pass over pairs; of a
    larger group, only rows none of whose kept neighbours leads need another."""
    asked = []

    def noted(job):
        def run(base, queries, *rest, **options):
            asked.append(queries.count)
            return job(base, queries, *rest, **options)

        return run

    monkeypatch.setattr(clustering, "_merged", noted(clustering._merged))
    monkeypatch.setattr(clustering, "nearest_in", noted(clustering.nearest_in))
    rng = np.random.default_rng(5)
    centres = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    small = np.repeat(centres, 3, axis=0) + 0.01 * rng.normal(size=(120, 40))
    large = centres[0] + 0.01 * rng.normal(size=(30, 40))
    for matrix, most in ((small, 0), (np.vstack([small, large]), 33)):
        asked.clear()
        vectors = blocks.load_vectors(frame(spark, matrix), "id", "v")
        found = clustering.cluster(vectors, finish_rows=1).members.collect()
        members, _ = one_at_a_time(cosines(matrix))
        assert {r["id"]: r["leader"] for r in found} == members
        assert max(asked, default=0) <= most


@pytest.mark.parametrize("kept", [1, 8])
@pytest.mark.parametrize("matrix", [families()[:-1], wheel(), chained(60)])
def test_links_of_the_first_pass_equal_one_at_a_time(spark, monkeypatch, matrix, kept):
    monkeypatch.setattr(clustering, "KEPT_RELATED", kept)
    vectors = blocks.load_vectors(frame(spark, matrix), "id", "v")
    clusters = clustering.cluster(vectors, link=clustering.LINK_THRESHOLD)
    members, links = one_at_a_time(cosines(matrix))
    assert {r["id"]: r["leader"] for r in clusters.members.collect()} == members
    found = clustering.similar_links(clusters).collect()
    assert {(r["src"], r["dst"]): r["similarity"] for r in found} == links


@pytest.mark.parametrize("split", [0, 200])
def test_links_of_two_runs_of_the_first_pass(spark, split):
    """The second run finds the links of all its rows, and of a run without new leaders."""
    matrix = families(4)[:-1]
    size = len(matrix)
    if not split:
        matrix = np.vstack([matrix, matrix])
    old = split or size
    vectors = blocks.load_vectors(frame(spark, matrix), "id", "v")
    first = clustering.cluster(vectors.subset(vectors.rows.where(F.col("id") < old)))
    rest = vectors.subset(vectors.rows.where(F.col("id") >= old))
    found = {}
    for link in (None, clustering.LINK_THRESHOLD):
        second = clustering.cluster(rest, known=first.leaders, link=link)
        links = clustering.similar_links(second).collect()
        found[link] = sorted((r["src"], r["dst"], r["similarity"]) for r in links)
    assert found[None] and found[None] == found[clustering.LINK_THRESHOLD]


def test_rows_with_few_related_rows_need_no_pass_for_links(spark, monkeypatch):
    asked = []

    def noted(base, queries, *rest, job=blocks.reduce_cross, **options):
        asked.append(queries.count)
        return job(base, queries, *rest, **options)

    monkeypatch.setattr(blocks, "reduce_cross", noted)
    rng = np.random.default_rng(6)
    axes = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    matrix = np.vstack([axes, 0.85 * axes + 0.5268 * np.roll(axes, 1, axis=0)])
    for many in (matrix, np.vstack([matrix, np.c_[np.full(30, 0.85), 0.5268 * np.eye(30)] @ axes[:31]])):
        asked.clear()
        vectors = blocks.load_vectors(frame(spark, many), "id", "v")
        clusters = clustering.cluster(vectors, link=clustering.LINK_THRESHOLD)
        found = clustering.similar_links(clusters).collect()
        _, links = one_at_a_time(cosines(many))
        assert found and {(r["src"], r["dst"]): r["similarity"] for r in found} == links
        assert sum(asked) <= (0 if many is matrix else 10)


def test_a_chain_takes_few_rounds(spark):
    """Of 10,000 rows each merges with the one before and the one after it alone."""
    n = 10_000
    turns = np.random.default_rng(7).uniform(0.2, 0.55, 12)
    angle = np.arange(n)[:, None] * turns
    matrix = np.c_[np.cos(angle), np.sin(angle)]
    by_distance = np.cos(angle).mean(axis=1)
    assert by_distance[1] >= 0.9 and by_distance[2:].max() < 0.9
    vectors = blocks.load_vectors(frame(spark, matrix), "id", "v")
    clusters = clustering.cluster(vectors, finish_rows=4)
    assert clusters.rounds <= 30
    order = hash_order(range(n))
    turn, leaders, members = {t: k for k, t in enumerate(order)}, set(), {}
    for t in order:
        near = [o for o in (t - 1, t + 1) if o in leaders]
        members[t] = min(near, key=turn.get, default=t)
        if members[t] == t:
            leaders.add(t)
    assert {r["id"]: r["leader"] for r in clusters.members.collect()} == members


def test_centroids_are_normalised_means(spark):
    matrix = families()[:-1]
    vectors = blocks.load_vectors(frame(spark, matrix), "id", "v")
    members = clustering.cluster(vectors).members
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    groups = {}
    for r in members.collect():
        groups.setdefault(r["leader"], []).append(r["id"])
    for r in clustering.centroids(vectors, members).collect():
        mean = unit[groups[r["leader"]]].mean(axis=0)
        assert r["merge_count"] == len(groups[r["leader"]])
        assert np.allclose(r["embedding"], mean / np.linalg.norm(mean))


def test_best_keeps_the_same_rows_however_pairs_arrive():
    rng = np.random.default_rng(0)
    owner, other = rng.integers(0, 20, 5000), rng.permutation(5000)
    score = np.round(rng.random(5000), 2)
    whole = blocks.Best(7, 20)
    whole.add(owner, other, score)
    parts = blocks.Best(7, 20)
    parts._limit = 200
    for start in range(0, 5000, 90):
        piece = slice(start, start + 90)
        parts.add(owner[piece], other[piece], score[piece])
    for a, b in zip(whole.result(), parts.result()):
        assert np.array_equal(a, b)


def test_distribution_equals_numpy(spark, monkeypatch):
    monkeypatch.setattr(blocks, "MIN_BLOCK_ROWS", 64)
    matrix = families()[:-1]
    sampled = distribution.sample_pairs(frame(spark, matrix), "id", ["v"], size=300)["v"]
    assert sampled.strips.number > 1
    rows = sampled.strips.rows.select("id").distinct().collect()
    chosen = sorted(r["id"] for r in rows)
    values = cosines(matrix[chosen])[np.triu_indices(300, 1)]

    stats = sampled.statistics()
    assert stats["num_pairs"] == len(values)
    expected = {
        "mean": values.mean(),
        "std": values.std(),
        "min": values.min(),
        "max": values.max(),
        "median": np.median(values),
        "pct_above_60": (values >= 0.6).mean() * 100,
    }
    for name, value in expected.items():
        assert stats[name] == pytest.approx(value, abs=1e-8)

    counts, edges = np.histogram(values, distribution.HISTOGRAM_BINS)
    bins = sampled.histogram()
    assert [b[3] for b in bins] == counts.tolist()
    assert np.allclose([b[1] for b in bins], edges[:-1])

    for threshold, percent in sampled.cumulative()[::7]:
        assert percent == pytest.approx((values >= threshold).mean() * 100)

    box = sampled.box()
    q1, median, q3 = np.quantile(values, [0.25, 0.5, 0.75])
    inside = values[(values >= q1 - 1.5 * (q3 - q1)) & (values <= q3 + 1.5 * (q3 - q1))]
    assert [box["q1"], box["median"], box["q3"]] == pytest.approx([q1, median, q3])
    assert [box["whisker_low"], box["whisker_high"]] == [inside.min(), inside.max()]
    assert box["outliers"] == len(values) - len(inside)


def test_distribution_of_equal_vectors(spark):
    sampled = distribution.sample_pairs(frame(spark, np.ones((5, 3))), "id", ["v"])["v"]
    assert sampled.histogram()[0][3] == 10
    assert sampled.statistics()["std"] == 0
    assert sampled.box()["outliers"] == 0


def test_distribution_counts_zero_vectors(spark):
    matrix = np.array([[1.0, 0.0], [1.0, 1.0], [0.0, 0.0], [0.0, 1.0]])
    pairs = distribution.sample_pairs(frame(spark, matrix), "id", ["v"])["v"]
    values = np.array([np.sqrt(0.5), 0, 0, 0, np.sqrt(0.5), 0])
    stats = pairs.statistics()
    assert stats["num_pairs"] == 6
    assert stats["mean"] == pytest.approx(values.mean(), abs=1e-8)
    assert stats["median"] == 0
    assert sum(row[3] for row in pairs.histogram()) == 6


@pytest.mark.parametrize("rows", [0, 1])
def test_distribution_without_pairs(spark, rows):
    df = frame(spark, np.ones((1, 3))).limit(rows)
    pairs = distribution.sample_pairs(df, "id", ["v"])["v"]
    stats = pairs.statistics()
    assert stats.pop("num_pairs") == 0
    assert set(stats.values()) == {None}
    assert pairs.histogram() == [] and pairs.cumulative() == []
    assert pairs.box()["median"] is None and pairs.box()["outliers"] == 0


def test_counting_passes_are_exact_next_to_their_marks():
    """Single precision leaves the side of these pairs open; values are marks themselves."""
    rng = np.random.default_rng(8)
    left, right = (rng.normal(size=(n, 64)) for n in (300, 1300))
    left, right = (m / np.linalg.norm(m, axis=1, keepdims=True) for m in (left, right))
    left[5], left[7], right[3] = right[9], 0, -left[8]
    left[20:90] = left[4]
    one = 10**blocks.SIMILARITY_DIGITS
    for a, b, same in ((left, right, False), (left, left, True)):
        whole = np.rint(a @ b.T * one).astype(np.int64)
        whole = whole[np.triu_indices(len(a), 1)] if same else whole.ravel()

        def tiles():
            return distribution._pairs_of(a, b, same)

        assert sum(pairs.near.size for pairs in tiles()) == len(whole)
        even = np.arange(60) * 30_000_001 - 800_000_000
        for marks in (even, whole[11] + np.arange(5), whole[:1]):
            reached = np.searchsorted(marks, whole, side="right")
            found = sum(pairs.tally(marks) for pairs in tiles())
            assert found.tolist() == np.bincount(reached, minlength=len(marks) + 1).tolist()
        for mark in (int(whole[0]), int(whole[40]) + 1, -one, 0, one):
            low, high = 2 * one, -2 * one
            for pairs in tiles():
                low, high = pairs.smallest(mark, low), pairs.greatest(mark, high)
            assert sum(pairs.at_least(mark) for pairs in tiles()) == (whole >= mark).sum()
            assert low == whole[whole >= mark].min(initial=2 * one)
            assert high == whole[whole <= mark].max(initial=-2 * one)


def test_curve_and_histogram_need_no_ranks(spark, monkeypatch):
    """The curve is one pass over the pairs, the histogram two; no order statistics."""
    matrix = np.random.default_rng(4).normal(size=(40, 8))
    pairs = distribution.sample_pairs(frame(spark, matrix), "id", ["v"])["v"]
    passes, reduce = [], type(pairs.strips).reduce

    def counted(strips, *args):
        passes.append(args)
        return reduce(strips, *args)

    monkeypatch.setattr(type(pairs.strips), "reduce", counted)
    values = cosines(matrix)[np.triu_indices(40, 1)]
    curve = pairs.cumulative()
    assert len(passes) == 1
    assert [p for _, p in curve] == pytest.approx([(values >= t).mean() * 100 for t, _ in curve])
    assert sum(row[3] for row in pairs.histogram()) == len(values)
    assert len(passes) == 3 and "first_pass" not in vars(pairs)


def test_rough_tally_counts_marks_exactly(monkeypatch):
    from corpusgraph.operators import distribution

    random = np.random.default_rng(3)
    left, right = (random.normal(size=(n, 6)) for n in (90, 70))
    right[:40] = left[:40]
    left[7] = 0
    left, right = (m / np.maximum(np.linalg.norm(m, axis=1), 1e-9)[:, None] for m in (left, right))
    unit = distribution._UNIT
    for placed in (1 << 17, 64, 1000):
        monkeypatch.setattr(distribution, "_PLACED", placed)
        for same in (False, True):
            other = left if same else right
            values = np.rint(left @ other.T * unit).astype(np.int64)
            values = values[np.triu_indices(len(left), 1)] if same else values.ravel()
            # Marks that pairs lie on, one below and one above them, and beyond all.
            marks = [int(v) + d for v in (*values[::400], 0, unit) for d in (-1, 0, 1)]
            tally, above = 0, np.zeros(len(marks), np.int64)
            number, inside = 0, 0
            for pairs in distribution._pairs_of(left, other, same):
                rough, reached = pairs.rough_tally(marks)
                tally, above = tally + rough, above + reached
                below, chosen = pairs.below(0, unit // 2)
                exact = pairs.exact(chosen)
                number += below + (exact < 0).sum()
                inside += ((exact >= 0) & (exact < unit // 2)).sum()
            assert above.tolist() == [(values >= m).sum() for m in marks]
            assert (number, inside) == ((values < 0).sum(), ((values >= 0) & (values < unit // 2)).sum())
            codes = np.floor((values / unit + 1) / distribution._ROUGH_STEP + 1)
            assert tally.sum() == len(values)
            moved = np.cumsum(np.bincount(codes.astype(int), minlength=len(tally)))
            assert (np.cumsum(tally)[1:] >= moved[:-1]).all() and (np.cumsum(tally)[:-1] <= moved[1:]).all()


def test_order_statistics_are_exact_at_every_rank(spark):
    matrix = np.random.default_rng(6).normal(size=(30, 3))
    matrix[[4, 9]] = matrix[2]
    pairs = distribution.sample_pairs(frame(spark, matrix), "id", ["v"])["v"]
    values = np.sort(np.round(cosines(matrix)[np.triu_indices(30, 1)], 9))
    found = pairs.order_statistics(range(len(values)))
    assert [found[r] for r in range(len(values))] == pytest.approx(values.tolist(), abs=2e-9)


def test_vectors_must_be_finite(spark):
    with pytest.raises(Exception, match="vectors must be finite"):
        blocks.load_vectors(frame(spark, np.array([[1.0, np.nan]])), "id", "v")


def test_links_are_complete_and_copies_hang_on_their_first(spark):
    """More than 200 partners of a row, and equal vectors among them."""
    angle = np.arange(260) * 0.003
    matrix = np.stack([np.cos(angle), np.sin(angle)], axis=1)
    matrix[[7, 90, 259]] = matrix[3]
    vectors = blocks.load_vectors(frame(spark, matrix), "id", "v")
    found = sim.linked(vectors, 0.6).collect()
    firsts = [i for i in range(259) if i not in (7, 90)]
    expected = {(b, a) for a in firsts for b in firsts if a < b}
    expected |= {(i, 3) for i in (7, 90, 259)}
    assert len(found) == len(expected)
    assert {(r["id"], r["neighbour"]) for r in found} == expected

    known = vectors.subset(vectors.rows.where("id >= 90"))
    fresh = vectors.subset(vectors.rows.where("id < 90"))
    later = {(r["id"], r["neighbour"]) for r in sim.linked(fresh, 0.6, known).collect()}
    assert {(3, 90), (7, 90)} <= later
    assert (3, 100) not in later and (2, 90) in later and (2, 259) not in later
    assert len(later) == 2 + 88 * 87 // 2 + 88 * 169


def test_a_row_is_sent_as_often_in_six_times_the_rows():
    """2.4 million rows on 12 cores; before, blocks of 8,192 rows sent each one 147 times."""
    for rows in (400_000, 2_400_000):
        table = blocks.VectorTable(None, rows, 64)
        layout = blocks.Layout.plan(np.array([[rows], [0]]), True, table.held_rows, 12)
        assert layout.sent < 8 * rows and layout.strips.sum() % 12 == 0
        both = np.array([[rows // 2], [rows]])
        layout = blocks.Layout.plan(both, False, table.held_rows, 12)
        assert layout.sent < 10 * rows and layout.strips.sum() % 12 == 0


def test_pairs_of_blocks_equal_all_products():
    rng = np.random.default_rng(8)
    far = rng.normal(size=(900, 24))
    near = far[:1] + 0.05 * rng.normal(size=(700, 24))
    matrix = np.r_[far, near, far[:5], np.zeros((2, 24))]
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    matrix = matrix / np.where(norms == 0, 1, norms)
    ids = rng.permutation(len(matrix))
    other = np.r_[matrix[::3], rng.normal(size=(40, 24)) / 5]
    other_ids = len(ids) + np.arange(len(other))
    for threshold in (-1.0, 0.0, 0.3, 0.8, 0.9, 1.0):
        for right_ids, right, same in ((ids, matrix, True), (other_ids, other, False)):
            sims = np.round(matrix @ right.T, 9)
            hits = np.triu(sims >= threshold, 1) if same else sims >= threshold
            wanted = {
                (*sorted((ids[i], right_ids[j])), sims[i, j]) for i, j in zip(*np.nonzero(hits))
            }
            pairs = blocks.BlockPairs(ids, matrix, right_ids, right, same)
            found = [
                (pairs.ids[x], pairs.ids[y], v)
                for a, b, s in pairs.above(threshold)
                for x, y, v in zip(a, b, s)
            ]
            assert len(found) == len(wanted)
            assert {f[:2] for f in found} == {w[:2] for w in wanted}
            assert sum(f[2] for f in found) == pytest.approx(sum(w[2] for w in wanted))


def test_codes_are_counted_two_at_a_time(monkeypatch):
    """Few marks, in pairs of bytes, and many, one by one; odd numbers of pairs."""
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(301, 6))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    whole = np.rint(np.clip(vectors @ vectors.T, -1, 1)[np.triu_indices(301, 1)] * 1e9)
    kinds, count = [], np.bincount

    def noted(codes, *rest, **options):
        kinds.append(codes.dtype.itemsize)
        return count(codes, *rest, **options)

    monkeypatch.setattr(distribution, "_PLACED", 777)
    for number in (1, 49, 100, 255, 256, 400):
        marks = np.rint(np.linspace(-0.9, 0.95, number) * 1e9).astype(np.int64)
        kinds.clear()
        with monkeypatch.context() as patched:
            patched.setattr(distribution.np, "bincount", noted)
            found = sum(p.tally(marks) for p in distribution._pairs_of(vectors, vectors, True))
        reached = np.searchsorted(marks, whole, side="right")
        assert found.tolist() == count(reached, minlength=number + 1).tolist()
        assert (2 in kinds) == (number <= 255)


@pytest.mark.parametrize("dim", [2, 64, 5000])
def test_error_of_single_precision_covers_the_worst_product(dim):
    rng = np.random.default_rng(dim)
    some = [np.ones((1, dim)), np.abs(rng.normal(size=(40, dim))), rng.normal(size=(40, dim))]
    rows = np.concatenate([m / np.linalg.norm(m, axis=1, keepdims=True) for m in some])
    single = rows.astype(np.float32)
    one_by_one = np.zeros((len(rows), len(rows)), np.float32)
    for k in range(dim):
        one_by_one += single[:, k : k + 1] * single[:, k]
    for near in (single @ single.T, one_by_one):
        assert np.abs(near - rows @ rows.T).max() < distribution._error(dim) < dim * 2.0**-23 + 1e-6
