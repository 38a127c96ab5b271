"""Graph tables."""

import hashlib
from itertools import count

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusgraph.operators import sampling
from corpusgraph.plans import graph
from corpusgraph.sources import scratch
from corpusgraph.sources.scratch import scratch_dir
from workload import inputs
from workload.registry import CHECKS

KEY = "publication_number"
UNIT = {"x": [1.0, 0.0, 0.0], "near": [0.95, 0.3, 0.0], "y": [0.0, 0.0, 1.0]}
ZERO = [0.0, 0.0, 0.0]


def patents(spark, rows):
    """Rows of key, problem vector, solution vector."""
    return spark.createDataFrame(
        [(k, None, f"abstract {k}", f"p {k}", f"s {k}", p, s) for k, p, s in rows],
        f"{KEY} string, title_text string, abstract_text string, problem string, "
        "solution string, problem_embedding array<double>, "
        "solution_embedding array<double>",
    )


def seed_for(*ids):
    """A seed whose hash order is the given one."""

    def code(seed, i):
        return hashlib.md5(f"{seed}:{i}".encode()).hexdigest()

    return next(s for s in count() if list(ids) == sorted(ids, key=lambda i: code(s, i)))


ORDER = seed_for("a", "b", "c:1", "e")


def edges(found, kind):
    chosen = found.edges.where(F.col("type") == kind).collect()
    return sorted((r["src"], r["dst"]) for r in chosen)


@pytest.fixture
def rows(spark):
    return patents(
        spark,
        [
            ("a", UNIT["x"], UNIT["y"]),
            ("b", UNIT["near"], UNIT["y"]),
            ("c:1", UNIT["y"], UNIT["x"]),
            ("d", None, UNIT["x"]),
            ("e", ZERO, UNIT["x"]),
        ],
    )


def test_dense_graph(rows):
    found = graph.dense_graph(rows)
    assert edges(found, "SIMILAR_PROBLEM") == [("Problem:a", "Problem:b")]
    assert edges(found, "SIMILAR_SOLUTION") == [
        ("Solution:a", "Solution:b"),
        ("Solution:c:1", "Solution:e"),
    ]
    assert ("Patent:c:1", "Problem:c:1") in edges(found, "HAS_PROBLEM")
    totals = {r["kind"]: r["count"] for r in graph.graph_stats(found).collect()}
    assert totals["Patent"] == totals["Problem"] == totals["SOLVES"] == 4
    patent = found.nodes.where("label = 'Patent'").first()
    assert patent["title"] == "" and patent["abstract"].startswith("abstract")


def test_clustered_graph(rows):
    found = graph.clustered_graph(rows, ORDER)
    assert edges(found, "HAS_PROBLEM") == [
        ("Patent:a", "Problem:a"),
        ("Patent:b", "Problem:a"),
        ("Patent:c:1", "Problem:c:1"),
        ("Patent:e", "Problem:e"),
    ]
    # Parallel SOLVES edges, one per patent.
    assert edges(found, "SOLVES").count(("Solution:a", "Problem:a")) == 2
    nodes = {r["node_id"]: r for r in found.nodes.collect()}
    assert nodes["Problem:a"]["merge_count"] == 2
    assert nodes["Problem:a"]["description"] == "p a"
    assert nodes["Problem:e"]["embedding"] == ZERO
    assert len(nodes) == 4 + 3 + 2


def test_totals_of_a_graph_without_similar_nodes(spark):
    found = graph.dense_graph(patents(spark, [("a", UNIT["x"], UNIT["y"])]))
    totals = {r["kind"]: r["count"] for r in graph.graph_stats(found).collect()}
    assert totals == {
        "Patent": 1,
        "Problem": 1,
        "Solution": 1,
        "HAS_PROBLEM": 1,
        "HAS_SOLUTION": 1,
        "SOLVES": 1,
    }


def stored(spark, *versions):
    path = scratch_dir(spark, "graph")
    for number, part in enumerate(versions):
        graph.write_graph(part, path, number)
    return graph.read_graph(spark, path)


def contents(found):
    names = ["merge_count", "description", "embedding", "leader_embedding", "member_sum"]
    nodes = [
        (r["node_id"], *(str(np.round(r[n], 12) if isinstance(r[n], list) else r[n]) for n in names))
        for r in found.nodes.collect()
    ]
    edges = [(r["src"], r["dst"], r["type"], r["similarity"]) for r in found.edges.collect()]
    return sorted(map(str, nodes)), sorted(map(str, edges))


def test_updates_equal_a_rebuild(spark, rows):
    first = stored(spark, graph.clustered_graph(rows.where(F.col(KEY) < "b"), ORDER))
    assert graph.pending_rows(rows, first.nodes).count() == 3
    grown = graph.update_clustered_graph(first, rows, ORDER)
    whole = graph.clustered_graph(rows, ORDER)
    assert contents(grown) == contents(whole)
    again = graph.update_clustered_graph(stored(spark, whole), rows, ORDER)
    assert contents(again) == contents(whole)


def test_a_change_needs_no_earlier_rows_and_holds_touched_clusters_alone(spark, rows):
    old = graph.clustered_graph(rows.where(F.col(KEY) != "b"), ORDER)
    change = graph.clustered_change(stored(spark, old), rows.where(F.col(KEY) == "b"), ORDER)
    assert sorted(r["node_id"] for r in change.nodes.collect()) == [
        "Patent:b",
        "Problem:a",
        "Solution:a",
    ]
    assert change.edges.count() == 3
    grown = stored(spark, old, change)
    assert contents(grown) == contents(graph.clustered_graph(rows, ORDER))
    # A version more, which touches the same clusters once more.
    late = patents(spark, [("b2", UNIT["near"], UNIT["y"])])
    later = graph.clustered_change(grown, late, ORDER)
    node = {r["node_id"]: r for r in stored(spark, old, change, later).nodes.collect()}
    assert node["Problem:a"]["merge_count"] == node["Solution:a"]["merge_count"] == 3
    assert len(node) == 4 + 3 + 2 + 1


def test_a_change_without_new_rows_is_empty(spark, rows):
    whole = graph.clustered_graph(rows, ORDER)
    change = graph.clustered_change(stored(spark, whole), rows, ORDER)
    assert change.nodes.count() == change.edges.count() == 0
    assert contents(stored(spark, whole, change)) == contents(whole)


def test_dense_updates_equal_a_rebuild(spark, rows):
    first = stored(spark, graph.dense_graph(rows.where(F.col(KEY) < "b")))
    grown = graph.update_dense_graph(first, rows)
    assert contents(grown) == contents(graph.dense_graph(rows))


def test_rows_that_sort_before_known_ones_still_come_later(spark):
    known = patents(spark, [("m", UNIT["x"], UNIT["y"])])
    both = known.unionByName(patents(spark, [("a", UNIT["near"], UNIT["y"])]))
    grown = graph.update_clustered_graph(stored(spark, graph.clustered_graph(known)), both)
    assert ("Patent:a", "Problem:m") in edges(grown, "HAS_PROBLEM")
    dense = graph.update_dense_graph(stored(spark, graph.dense_graph(known)), both)
    assert edges(dense, "SIMILAR_PROBLEM") == [("Problem:m", "Problem:a")]


def test_replica_has_new_ids_and_no_vectors(spark, rows):
    path = scratch_dir(spark, "replica")
    original = graph.dense_graph(rows)
    graph.write_graph(graph.replica(original), path)
    nodes = spark.read.parquet(f"{path}/nodes")
    links = spark.read.parquet(f"{path}/edges")
    assert "embedding" not in nodes.columns
    names = {r["node_id"]: r["source_id"] for r in nodes.collect()}
    assert sorted(names) == list(range(12))
    back = sorted((names[r["src"]], names[r["dst"]]) for r in links.collect())
    assert back == sorted((r["src"], r["dst"]) for r in original.edges.collect())
    assert nodes.where("description is null or title is null").count() == 0


def stored_copies(spark, monkeypatch, job):
    """The labels of the tables that a job stores on the way."""
    labels = []
    write = scratch.materialize

    def noted(df, label="step", partition_by=()):
        labels.append(label)
        return write(df, label, partition_by)

    monkeypatch.setattr(sampling, "materialize", noted)
    monkeypatch.setattr(graph, "materialize", noted)
    return job(), labels


def test_replica_stores_its_nodes_once(spark, rows, monkeypatch):
    """Nodes without an id, or with one that occurs twice, are numbered like others."""
    nodes = graph.dense_nodes(rows)
    odd = nodes.where("node_id = 'Patent:a'")
    odd = odd.unionByName(odd.withColumn("node_id", F.lit(None).cast("string")))
    original = graph.Graph(nodes.unionByName(odd), graph.dense_graph(rows).edges)
    found, labels = stored_copies(spark, monkeypatch, lambda: graph.replica(original))
    assert len(labels) == 1
    numbers = sorted((r["node_id"], r["source_id"]) for r in found.nodes.collect())
    assert [n for n, _ in numbers] == list(range(14))
    assert [s for _, s in numbers][:3] == [None, "Patent:a", "Patent:a"]


def joined_in(plan):
    return sum(plan.count(f"{kind}Join") for kind in ("SortMerge", "BroadcastHash", "ShuffledHash"))


def test_rows_without_later_versions_do_not_move(spark, rows):
    """Only clusters and their links with several versions are compared with each other."""

    def plan(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    path = scratch_dir(spark, "graph")
    graph.write_graph(graph.dense_graph(rows), path)
    one = graph.read_graph(spark, path)
    assert joined_in(plan(one.nodes)) == joined_in(plan(one.edges)) == 0
    graph.write_graph(graph.dense_change(one, patents(spark, [("z", UNIT["x"], UNIT["y"])])), path, 1)
    two = graph.read_graph(spark, path)
    assert joined_in(plan(two.edges)) == 0
    assert two.nodes.count() == 15 and "version" not in two.nodes.columns


def test_links_keep_the_score_that_was_set_last(spark):
    """Two members of one cluster link to the same leader; the later one counts."""
    rows = patents(
        spark,
        [
            ("a", [1.0, 0.0], [1.0, 0.0]),
            ("b", [0.82, 0.5724], [1.0, 0.0]),
            ("c", [0.86, 0.5103], [1.0, 0.0]),
        ],
    )
    found = graph.clustered_graph(rows, seed_for("a", "b", "c")).edges.where("type = 'SIMILAR_TO'").collect()
    assert [(r["src"], r["dst"]) for r in found] == [("Problem:b", "Problem:a")]
    assert found[0]["similarity"] == pytest.approx(0.86, abs=1e-3)


def noted_tables(monkeypatch, *modules):
    """Columns of the tables that some modules store on the way."""
    columns = []
    for module in modules:
        for name in ("materialize", "materialize_measured"):
            if hasattr(module, name):
                def noted(df, *rest, write=getattr(scratch, name), **options):
                    columns.append(df.columns)
                    return write(df, *rest, **options)

                monkeypatch.setattr(module, name, noted)
    return columns


def test_numbers_are_found_from_keys_alone(spark, rows, monkeypatch):
    """Texts are not stored to number the nodes; every number fits in several ranges."""
    monkeypatch.setattr(sampling, "RANGE_ROWS", 2)
    original = graph.dense_graph(rows)
    columns = noted_tables(monkeypatch, sampling, graph)
    found = graph.replica(original)
    assert columns and all(set(c) <= {"source_id", "_mark"} for c in columns)
    names = [r["source_id"] for r in found.nodes.orderBy("node_id").collect()]
    assert names == sorted(r["node_id"] for r in original.nodes.collect())
    assert [r["node_id"] for r in found.nodes.orderBy("source_id").collect()] == list(range(12))
    links = {(names[r["src"]], names[r["dst"]]) for r in found.edges.collect()}
    assert links == {(r["src"], r["dst"]) for r in original.edges.collect()}


@pytest.mark.parametrize("keys", [[], [None, None], [None, "b", "b", "a", "c", "b"], list("hgfedcba")])
def test_positions_of_odd_keys(spark, monkeypatch, keys):
    monkeypatch.setattr(sampling, "RANGE_ROWS", 1)
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, v int").repartition(3)
    positions = sampling.Positions.of(df, "k")
    wanted = sorted((k or "" for k in keys))
    found = positions.give(df, "n").collect()
    assert sorted(r["v"] for r in found) == list(range(len(keys)))
    for got in (found, positions.numbers("n").collect()):
        assert [(r["n"], r["k"] or "") for r in sorted(got, key=lambda r: r["n"])] == list(enumerate(wanted))


@pytest.fixture
def small_tables(spark, tmp_path):
    vectors = [(i, np.eye(3)[i % 3].tolist(), "x") for i in range(4)]
    made = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label string")
    made.write.parquet(f"{tmp_path}/embeddings.parquet")
    texts = [(i, f"head {i}\nbody {i}\nlast {i}") for i in range(20)] + [(20, None)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_texts_of_patents_are_stored_once(spark, small_tables, monkeypatch):
    columns = noted_tables(monkeypatch, inputs)
    found = {r[KEY]: r for r in inputs.patents(spark, small_tables).collect()}
    assert columns == [[KEY, "text", "problem_embedding", "solution_embedding"]]
    assert len(found) == 16
    for i in range(16):
        r, text = found[f"P{i:09}"], "\n".join(f"head {k}\nbody {k}\nlast {k}" for k in range(i, 20, 16))
        assert r["abstract_text"] == r["problem"] == text
        assert (r["title_text"], r["solution"]) == (text.split("\n")[0], text.split("\n")[-1])


@pytest.mark.parametrize("query", ["dense_incremental", "graph_incremental"])
def test_each_version_of_a_graph_is_written_once(spark, small_tables, monkeypatch, query):
    versions, write = [], graph.write_graph

    def noted(part, path, version=0):
        versions.append(version)
        write(part, path, version)

    monkeypatch.setattr(graph, "write_graph", noted)
    found = CHECKS[query].job(spark, small_tables)
    assert versions == [0, 1]
    assert found.where("type = 'HAS_PROBLEM'").count() == 16
