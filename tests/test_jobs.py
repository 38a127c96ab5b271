"""Work selection and model-backed jobs."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from corpusgraph.operators import incremental, jobs, sampling
from corpusgraph.plans import costs, extraction

KEY = "publication_number"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_pending_keeps_duplicates_and_null_keys(spark):
    source = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    done = spark.createDataFrame(
        [("b", "m1"), ("b", "m1"), ("a", "m2"), (None, "m1")], "k string, m string"
    )
    rest = incremental.pending(source, done, "k", constants={"m": "m1"})
    assert rows(rest) == [("a",), ("a",), (None,)]
    assert incremental.pending(source, done.limit(0), "k", limit=0).count() == 4


def test_pending_plans_an_anti_join(spark):
    source, done = spark.range(10).toDF("k"), spark.range(5).toDF("k")
    plan = incremental.pending(source, done, "k")._jdf.queryExecution().toString()
    assert "LeftAnti" in plan and "Cartesian" not in plan


def test_pending_groups_count_rows_and_items(spark):
    source = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "g string")
    done = spark.createDataFrame([("y",)], "id string")
    assert rows(incremental.pending_groups(source, done, "g", "id")) == [("x", 2, 4)]


def test_coverage_counts_one_column_and_lacking_any_asks_for_both(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (1, 2)], "p int, s int")
    assert rows(incremental.coverage(df, "p")) == [(3, 2, 1)]
    assert incremental.lacking_any(df, ["p", "s"]).count() == 2


def test_counters_of_an_empty_run(spark):
    empty = spark.createDataFrame([], "ok boolean")
    assert rows(incremental.run_counters(empty, F.col("ok"))) == [(0, 0, 0.0)]


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_positions_do_not_depend_on_partitions(spark, parts):
    df = spark.range(100).select((99 - F.col("id")).alias("k")).repartition(parts)
    found = sampling.with_position(df, "k").collect()
    assert all(r["k"] == r["position"] for r in found) and len(found) == 100


@pytest.mark.parametrize("parts", [1, 4])
def test_top_n_ranks_over_all_partitions(spark, parts):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("v")).repartition(parts)
    by = F.when(F.col("v") != 6, F.col("v"))
    first = sampling.top_n(df, "id", 200, by, descending=True)
    expected = sorted(range(1000), key=lambda i: (i % 7 == 6, -(i % 7), i))[:200]
    assert {r["id"] for r in first.collect()} == set(expected)


def test_sample_is_the_same_for_any_partitioning(spark):
    df = spark.range(900)
    samples = [
        {r["id"] for r in sampling.seeded_sample(df.repartition(n), "id", 50).collect()}
        for n in (1, 6)
    ]
    assert samples[0] == samples[1] and len(samples[0]) == 50
    assert sampling.seeded_sample(spark.range(20), "id", 50).count() == 20
    other = sampling.seeded_sample(df, "id", 50, seed=1)
    assert {r["id"] for r in other.collect()} != samples[0]


def test_reasons_for_rejection(spark):
    df = spark.createDataFrame(
        [
            ("  long enough ", "also long enough", "g"),
            ("\n short \t  ", "also long enough", "g"),
            ("long enough", None, "g"),
            ("long enough", "also long enough", ""),
            ("long enough", "also long enough", None),
        ],
        "problem string, solution string, generation_id string",
    )
    found = jobs.validate_extractions(df).collect()
    assert [r["reason"] for r in found] == [
        None,
        "too short",
        "too short",
        "no generation id",
        "no generation id",
    ]
    assert found[0]["problem"] == "long enough"


def test_extraction_keeps_failures_apart(spark):
    def model(title, abstract):
        if title == "bad":
            raise RuntimeError("down")
        if title == "none":
            return None
        size = f"{len(title)} {len(abstract)} characters"
        return {"problem": size, "solution": size, "generation_id": "g"}

    df = spark.createDataFrame(
        [
            ("1", "t" * 300, "a" * 3000),
            ("2", None, "abc"),
            ("3", "bad", "x"),
            ("4", "none", "x"),
            ("5", None, ""),
        ],
        f"{KEY} string, title_text string, abstract_text string",
    )
    cut = jobs.extract_pairs(df, model, jobs.TITLE_LIMIT, jobs.ABSTRACT_LIMIT)
    assert cut.where(F.col(KEY) == "1").first()["problem"] == "200 1000 characters"
    found = {r[KEY]: r for r in jobs.extract_pairs(df, model).collect()}
    assert found["1"]["problem"] == "300 3000 characters"
    assert found["2"]["problem"] == "0 3 characters"
    assert found["3"]["reason"] == "failed: down"
    assert found["4"]["reason"] == "no generation id"
    assert found["5"]["reason"] == "no input"
    assert found["1"]["reason"] is None and found["1"]["processing_time_ms"] >= 0


def pairs(spark, n):
    return spark.createDataFrame(
        [(f"k{i:02d}", f"problem {i}", f"solution {i}") for i in range(n)],
        f"{KEY} string, problem string, solution string",
    ).coalesce(1)


def test_embedding_batches_fail_together(spark):
    def model(texts):
        if any("problem 4" in t for t in texts):
            raise RuntimeError("down")
        return [[float(len(t)), 1.0] for t in texts]

    found = jobs.embed_pairs(pairs(spark, 10), model, batch=3, dim=2).collect()
    failed = {r[KEY] for r in found if r["reason"]}
    assert failed == {"k03", "k04", "k05"}


def test_embedding_skips_rows_without_texts(spark):
    seen = pairs(spark, 5).withColumns(
        {c: F.when(F.col(KEY) != "k02", F.col(c)) for c in ("problem", "solution")}
    )
    found = jobs.embed_pairs(seen, lambda t: [[1.0]] * len(t), batch=2, dim=1).collect()
    assert {r[KEY]: r["reason"] for r in found if r["reason"]} == {"k02": "no input"}
    assert len(found) == 5


def test_embedding_checks_count_and_dimension(spark):
    found = jobs.embed_pairs(pairs(spark, 4), lambda t: [[1.0]] * 3, batch=2, dim=1)
    assert {r["reason"] for r in found.collect()} == {"failed: 3 vectors for 4 texts"}
    found = jobs.embed_pairs(pairs(spark, 4), lambda t: [[1.0]] * len(t), dim=2)
    assert {r["reason"] for r in found.collect()} == {"wrong dimension"}


def test_embedding_pairs_vectors_with_their_texts(spark):
    def model(texts):
        return [[float(t.split()[-1]), float("Query: problem" in t)] for t in texts]

    for r in jobs.embed_pairs(pairs(spark, 25), model, dim=2).collect():
        number = float(r[KEY][1:])
        assert r["problem_embedding"] == [number, 1.0]
        assert r["solution_embedding"] == [number, 0.0]


def test_interleaving_goes_back(spark):
    texts = jobs.interleave(pairs(spark, 5), KEY, "problem", "solution")
    assert texts.count() == 10
    back = jobs.deinterleave(texts, KEY, "text")
    assert rows(back) == rows(pairs(spark, 5))
    assert jobs.deinterleave(texts.where("side = 0"), KEY, "text").count() == 0


def test_batches_share_one_made_up_id(spark):
    df = pairs(spark, 25).withColumn("embedding_generation_id", F.lit(None).cast("string"))
    found = jobs.assign_embedding_batches(df, KEY, size=10)
    counted = found.groupBy("embedding_generation_id").count()
    assert sorted(r["count"] for r in counted.collect()) == [5, 10, 10]
    # Calls have the same batches and ids, and other rows of a later run have others.
    calls = jobs.embed_pairs(df.repartition(4), lambda t: [[1.0]] * len(t), dim=1)
    chosen = [KEY, "embedding_generation_id"]
    assert rows(calls.select(*chosen)) == rows(found.select(*chosen))
    later = jobs.assign_embedding_batches(df.where(f"{KEY} > 'k12'"), KEY, size=10)
    ids = {r[1] for r in found.select(*chosen).collect()}
    assert not ids & {r[1] for r in later.select(*chosen).collect()}


def test_metadata_is_unwrapped_and_failures_are_counted(spark):
    def look_up(key):
        if key == "a":
            return {"data": {"total_cost": 1.5, "streamed": True, "created_at": "2024-01-02"}}
        if key == "b":
            return {"total_cost": 2.5}
        if key == "c":
            return None
        raise RuntimeError("timeout")

    ids = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "generation_id string")
    found = {r["generation_id"]: r for r in jobs.fetch_generations(ids, look_up).collect()}
    assert [found[k]["found"] for k in "abcd"] == [True, True, False, False]
    assert found["a"]["streamed"] and found["a"]["created_at"].year == 2024
    assert found["b"]["total_cost"] == 2.5 and found["b"]["tokens_prompt"] is None


def test_runs_resume_and_retry_failures(spark, lake):
    lake.write(
        spark.createDataFrame(
            [(f"p{i}", f"title {i}", "abstract") for i in range(6)],
            f"{KEY} string, title_text string, abstract_text string",
        ),
        "cleaned",
    )

    def model(broken):
        def call(title, abstract):
            if title in broken:
                raise RuntimeError("down")
            return {
                "problem": f"problem of {title}",
                "solution": f"solution of {title}",
                "generation_id": f"g-{title}",
            }

        return call

    def run(broken, **more):
        return extraction.run_extraction(
            lake, "cleaned", "done", model(broken), ("prov", "m"), "v1", **more
        )

    first = run({"title 1"}, limit=3)
    assert (first.selected, first.succeeded, first.failed) == (3, 2, 1)
    second = run(set(), concurrency=2)
    assert (second.selected, second.succeeded) == (4, 4)
    assert run(set()).selected == 0
    assert rows(extraction.processed_count(lake.read("done"), "m", "v1")) == [(6,)]

    embedded = extraction.run_embedding(
        lake, "done", lambda texts: [[1.0, 2.0] for _ in texts], dim=2
    )
    assert (embedded.selected, embedded.succeeded) == (6, 6)
    assert rows(incremental.coverage(lake.read("done"), "solution_embedding")) == [(6, 6, 0)]

    todo = extraction.unfetched_batches(lake.read("done"), lake.read("done").select(
        F.lit("x").alias("generation_id")).limit(0))
    sizes = todo.agg(F.sum("patents_in_batch"), F.sum("embeddings_in_batch"))
    assert rows(sizes) == [(6, 12)]
    fetched = extraction.run_fetch(
        lake, todo, "meta", extraction.EMBEDDING_GENERATIONS, lambda key: {"total_cost": 0.5}
    )
    assert fetched.failed == 0
    rest = extraction.unfetched_batches(lake.read("done"), lake.read("meta"))
    assert rest.count() == 0


def test_cost_summaries_are_zero_without_data(spark):
    empty = spark.createDataFrame(
        [],
        "generation_id string, provider_name string, total_cost double, tokens_prompt int, "
        "tokens_completion int, latency double, patents_in_batch int, "
        "embeddings_in_batch int",
    )
    assert rows(costs.extraction_cost_summary(empty)) == [(0, 0, 0, 0, 0, 0)]
    assert rows(costs.embedding_cost_summary(empty)) == [(0,) * 12]


@pytest.mark.parametrize(
    ("by", "descending"), [(None, False), ("s", True), ("x", False), ("when", True)]
)
def test_top_n_by_counting_passes(spark, monkeypatch, by, descending):
    """NULL and repeated keys and orders, a third of all rows equal, tiny sorted rests."""
    import random

    monkeypatch.setattr(sampling, "SORTED_ROWS", 5)
    monkeypatch.setattr(sampling, "CUTS", 3)
    rng = random.Random(8)
    rows = [
        (
            rng.choice([None, *range(40)]),
            rng.choice([None, "", "é", "z", "Z"]),
            rng.choice([None, -1.5, 0.0, 2.0]),
            datetime(2024, 1, rng.randint(1, 9), 1, 2, 3, 456789),
            n,
        )
        for n in range(200)
    ]
    rows += [(7, "z", 2.0, datetime(2024, 1, 5), 1000 + n) for n in range(100)]
    df = spark.createDataFrame(rows, "id int, s string, x double, when timestamp, n int")
    place = {"s": 1, "x": 2, "when": 3}

    def rank(row):
        value = row[place[by]] if by else 0
        return value, row[0]

    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    if by:
        present = [r for r in ordered if rank(r)[0] is not None]
        present.sort(key=lambda r: rank(r)[0], reverse=descending)
        ordered = present + [r for r in ordered if rank(r)[0] is None]
    for n in (0, 37, 231, 500):
        column = F.col(by) if by else None
        found = sampling.top_n(df.repartition(6), "id", n, column, descending and bool(by))
        got = [tuple(r) for r in found.collect()]
        assert len(got) == len(set(got)) == min(n, 300)
        assert sorted(map(rank, got), key=str) == sorted(map(rank, ordered[:n]), key=str)


def _cleaned(spark, n):
    rows = [(f"p{i:02d}", f"title {i}", "abstract") for i in range(n)]
    return spark.createDataFrame(rows, f"{KEY} string, title_text string, abstract_text string")


def test_a_killed_run_asks_each_row_once(spark, lake, tmp_path, monkeypatch):
    lake.write(_cleaned(spark, 30), "cleaned")
    log = str(tmp_path / "asked")

    def model(title, abstract):
        with open(log, "a") as file:
            file.write(title + "\n")
        return {"problem": f"the problem of {title}", "solution": f"a solution of {title}", "generation_id": title}

    def run():
        return extraction.run_extraction(
            lake, "cleaned", "done", model, ("prov", "m"), "v1", chunk_rows=5
        )

    # Killed after half of the chunks, and once more while the answers are appended.
    asked, calls = extraction.jobs.extract_pairs, []

    def stops(*args):
        calls.append(1)
        if len(calls) > 3:
            raise KeyboardInterrupt
        return asked(*args)

    monkeypatch.setattr(extraction.jobs, "extract_pairs", stops)
    with pytest.raises(KeyboardInterrupt):
        run()
    monkeypatch.setattr(extraction.jobs, "extract_pairs", asked)
    half = len(open(log).readlines())
    assert 0 < half < 30 and lake.read("done").count() == 0
    append = lake.append
    monkeypatch.setattr(lake, "append", lambda *a: (append(*a), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        run()
    monkeypatch.setattr(lake, "append", append)
    report = run()
    assert (report.selected, report.succeeded) == (30, 30)
    assert sorted(open(log).read().split("\n")[:-1]) == sorted(f"title {i}" for i in range(30))
    assert lake.read("done").count() == 30
    assert run().selected == 0


def test_a_chunk_reads_its_own_files_alone(spark, lake, monkeypatch):
    """Chunks that each read all rows read the square of them together."""
    lake.write(_cleaned(spark, 40), "cleaned")
    asked, read, rows_of = extraction.jobs.extract_pairs, [], []

    def looks(rows, *args):
        named = rows.select(F.input_file_name()).collect()
        read.append({r[0] for r in named})
        rows_of.append(len(named))
        return asked(rows, *args)

    def model(title, abstract):
        return {"problem": f"the problem of {title}", "solution": f"a solution of {title}", "generation_id": title}

    monkeypatch.setattr(extraction.jobs, "extract_pairs", looks)
    report = extraction.run_extraction(
        lake, "cleaned", "done", model, ("prov", "m"), "v1", chunk_rows=8
    )
    assert report.selected == report.succeeded == sum(rows_of) == 40
    assert len(read) > 1 and len(set.union(*read)) == sum(map(len, read))


def test_embedding_of_two_versions_of_a_publication(spark, lake):
    lake.write(_cleaned(spark, 4), "cleaned")

    def model(title, abstract):
        return {"problem": f"the problem of {title}", "solution": f"a solution of {title}", "generation_id": title}

    for version in ("v1", "v2"):
        extraction.run_extraction(lake, "cleaned", "done", model, ("prov", "m"), version)
    calls = lambda t: [[float(len(t))]] * len(t)
    report = extraction.run_embedding(lake, "done", calls, dim=1, chunk_rows=3)
    assert (report.selected, report.succeeded) == (8, 8)
    assert lake.read("done").where("problem_embedding is null").count() == 0
    lake.append(lake.read("done").limit(1).drop("problem_embedding"), "done")
    lake.append(lake.read("done").where("problem_embedding is null"), "done")
    with pytest.raises(ValueError, match="twice"):
        extraction.run_embedding(lake, "done", calls, dim=1)
