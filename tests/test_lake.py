"""Table operations."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusgraph.plans import publications
from corpusgraph.sources import files
from corpusgraph.sources.lake import Lake, ReadOnlyError, attach, from_records
from corpusgraph.sources.scratch import scratch_dir


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_records_become_a_table(spark):
    found = from_records(spark, [{"a": 1}, {"a": 2, "b": "x"}], "a int, b string")
    assert rows(found) == [(1, None), (2, "x")]


def test_literal_table(spark, lake):
    schema = "id int, name string, value int"
    lake.write(from_records(spark, [(1, "a", 10), (2, "b", 20), (3, "c", 30)], schema), "t")
    assert lake.read("t").count() == 3


def test_refresh_replaces_rows_and_can_read_its_own_table(spark, lake):
    lake.write(spark.range(5), "t")
    stats = lake.write(lake.read("t").where("id > 2"), "t")
    assert stats.rows == 2
    assert rows(lake.read("t")) == [(3,), (4,)]


def test_a_reader_keeps_the_version_it_started_with(spark, lake):
    lake.write(spark.range(5), "t")
    before = spark.read.parquet(lake._folder("t"))
    lake.write(spark.range(2), "t")
    assert before.count() == 5
    assert lake.read("t").count() == 2


def test_old_versions_go_only_when_told(spark, lake):
    for n in (5, 3, 2):
        lake.write(spark.range(n), "t")
    assert lake.clean("t") == 2
    assert lake.clean("t") == 0
    assert lake.read("t").count() == 2


def test_a_failing_write_leaves_the_table(spark, lake):
    lake.write(spark.range(5), "t")
    broken = spark.range(3).withColumn("id", F.raise_error(F.lit("no")).cast("bigint"))
    with pytest.raises(Exception, match="no"):
        lake.write(broken, "t")
    assert lake.read("t").count() == 5


def test_columns_are_matched_by_name_and_added(spark, lake):
    lake.write(spark.createDataFrame([(1, "x")], "a int, b string"), "t")
    lake.write(spark.createDataFrame([(2.5, "y")], "c double, b string"), "t")
    assert lake.columns("t") == ["a", "b", "c"]
    assert rows(lake.read("t")) == [(None, "y", 2.5)]


def test_append_matches_by_name(spark, lake):
    lake.write(spark.createDataFrame([(1, "x")], "a int, b string"), "t")
    stats = lake.append(spark.createDataFrame([("y", 2)], "b string, a int"), "t")
    lake.append(spark.createDataFrame([], "b string"), "t")
    assert stats.rows == 1
    assert rows(lake.read("t")) == [(1, "x"), (2, "y")]


def test_declared_tables_refuse_missing_values(spark, lake):
    declared = T.StructType(
        [T.StructField("k", T.StringType(), False), T.StructField("v", T.IntegerType())]
    )
    assert lake.ensure_table("t", declared)
    assert not lake.ensure_table("t", declared.add("w", "string"))
    assert lake.columns("t") == ["k", "v", "w"]
    lake.append(spark.createDataFrame([("a", None)], "k string, v int"), "t")
    with pytest.raises(Exception, match="must not be NULL"):
        lake.append(spark.createDataFrame([(None, 1)], "k string, v int"), "t")
    assert lake.read("t").count() == 1


def test_update_hits_every_row_of_a_key_and_the_last_update_wins(spark, lake):
    stored = [("a", 1, 0), ("a", 2, 0), ("b", 3, 0)]
    lake.write(spark.createDataFrame(stored, "k string, n int, v int"), "t")
    updates = spark.createDataFrame(
        [("a", 7, 1), ("a", 9, 3), ("a", 8, 2), ("z", 5, 1)], "k string, v int, o int"
    )
    lake.update_by_key("t", updates, ["k"], ["v"], order_by="o")
    assert rows(lake.read("t")) == [("a", 1, 9), ("a", 2, 9), ("b", 3, 0)]


def _bucket_files(spark, lake, name):
    """Files of each bucket folder."""
    found = lake.spark.table(lake.qualified(name)).select(F.input_file_name().alias("f"))
    paths = sorted(r["f"] for r in found.distinct().collect())
    return {p.split("_bucket=")[1] for p in paths}, paths


def test_an_update_writes_only_the_buckets_it_touches(spark, lake):
    stored = spark.range(400).selectExpr("id k", "id % 5 n", "cast(0 as int) v").repartition(1)
    lake.write_bucketed(stored, "t", ["k"], 16)
    assert lake.columns("t") == ["k", "n", "v"]
    _, before = _bucket_files(spark, lake, "t")
    assert len(before) == 16
    updates = spark.createDataFrame([(3, 7, 1), (3, 9, 2), (5, 8, 1), (9999, 1, 1)], "k int, v int, o int")
    stats = lake.update_by_key("t", updates, ["k"], ["v"], order_by="o")
    _, after = _bucket_files(spark, lake, "t")
    kept = set(before) & set(after)
    assert 13 <= len(kept) < 16 and len(after) == 16 and stats.rows < 120
    expected = [(i, i % 5, {3: 9, 5: 8}.get(i, 0)) for i in range(400)]
    assert sorted(rows(lake.read("t"))) == expected
    # Another key, appended rows, a new column and a refresh work as for other tables.
    lake.update_by_key("t", spark.createDataFrame([(4, 1)], "n long, v int"), ["n"], ["v"])
    assert lake.read("t").where("v = 1").count() == 80
    lake.append(spark.createDataFrame([(400, 2)], "k long, v int"), "t")
    lake.write(lake.read("t").where("k >= 398").withColumn("w", F.lit("x")), "t")
    assert rows(lake.read("t")) == [(398, 3, 0, "x"), (399, 4, 1, "x"), (400, None, 2, "x")]
    lake.update_by_key("t", spark.createDataFrame([(400, None)], "k int, v int"), ["k"], ["v"])
    assert rows(lake.read("t"))[-1] == (400, None, None, "x")


def test_update_can_set_null(spark, lake):
    lake.write(spark.createDataFrame([("a", 1)], "k string, v int"), "t")
    lake.update_by_key("t", spark.createDataFrame([("a", None)], "k string, v int"), ["k"], ["v"])
    assert rows(lake.read("t")) == [("a", None)]


def test_namespaces(spark):
    places = [(f"{n}_{id(spark)}", scratch_dir(spark, n)) for n in ("here", "there")]
    Lake(spark, *places[1]).write(spark.range(10), "numbers")
    current = spark.catalog.currentDatabase()
    here, there = attach(spark, *places)
    try:
        assert there.tables() == ["numbers"]
        assert here.pull(there, "numbers") == 10
        assert here.pull(there, "numbers", limit=0) == 10
        assert here.pull(there, "numbers", limit=4, key="id") == 4
        assert rows(spark.sql("select max(id) from numbers")) == [(3,)]
        for change in (
            lambda: there.write(spark.range(1), "numbers"),
            lambda: there.append(spark.range(1), "numbers"),
            lambda: there.add_column("numbers", "x"),
            lambda: there.drop("numbers"),
        ):
            with pytest.raises(ReadOnlyError):
                change()
        with pytest.raises(LookupError):
            here.read("nothing")
    finally:
        spark.catalog.setCurrentDatabase(current)


AWKWARD = [
    (1, 'quoted "x", comma', "two\nlines"),
    (2, None, ""),
    (3, "  spaces  ", "\ttab\\ end\\"),
    (4, "[{", "}]"),
]


@pytest.mark.parametrize("fmt", files.EXPORT_FORMATS)
def test_exports_read_back(spark, fmt):
    df = spark.createDataFrame(AWKWARD, "i int, a string, b string").repartition(3)
    path = scratch_dir(spark, fmt)
    stats = files.export(df, path, fmt)
    assert stats.rows == 4 and stats.size_bytes > 0
    reader = spark.read.schema(df.schema)
    if fmt == "csv":
        back = files.read_csv(spark, path, df.schema)
    elif fmt == "parquet":
        back = reader.parquet(path)
    else:
        back = reader.option("multiLine", str(fmt == "json").lower()).json(path)
    assert rows(back) == rows(df)


def test_json_files_are_arrays(spark):
    import glob
    import json

    path = scratch_dir(spark, "json")
    files.export(spark.range(10).repartition(2), path, "json")
    found = []
    for name in glob.glob(f"{path}/part-*"):
        with open(name) as part:
            found += json.load(part)
    assert sorted(r["id"] for r in found) == list(range(10))


def test_unknown_formats_are_refused(spark):
    with pytest.raises(ValueError, match="unknown format"):
        files.export(spark.range(1), scratch_dir(spark, "x"), "xml")


def test_csv_rows_are_flagged_and_repeat_unless_told(spark, lake):
    columns = ", ".join(f"{c} string" for c in publications.CSV_COLUMNS)
    row = tuple("abcdefg")
    lake.write(spark.createDataFrame([row], columns).withColumn("assignee", F.lit("o")), "raw")
    new = spark.createDataFrame([row, tuple("hbcdefg")], f"{columns}")
    publications.append_csv(lake, "raw", new)
    publications.append_csv(lake, "raw", new)
    assert lake.read("raw").where("is_evaluation").count() == 4
    assert lake.read("raw").where("is_evaluation is null").count() == 1
    publications.append_csv(lake, "raw", new, dedupe_on="publication_number")
    assert lake.read("raw").count() == 5


def test_items_without_a_field_give_null(spark):
    path = scratch_dir(spark, "items")
    lines = spark.createDataFrame(
        [('{"id": 1, "by": "x"}',), ('{"id": 2, "title": "t"}',)], "value string"
    )
    lines.write.text(path)
    schema = T.StructType().add("id", "long").add("title", "string").add("by", "string")
    assert rows(files.read_items(spark, path, schema)) == [(1, None, "x"), (2, "t", None)]


def test_scratch_follows_the_session_and_is_local_only_in_local_runs(spark, monkeypatch):
    from corpusgraph.sources import scratch

    monkeypatch.setattr(scratch, "_configured", lambda _: "hdfs:///shared/")
    assert scratch.scratch_root(spark) == "hdfs:///shared"
    monkeypatch.setattr(scratch, "_configured", lambda _: None)
    assert scratch.scratch_root(spark) == scratch.scratch_root(spark)
    cluster = type("Session", (), {"sparkContext": type("C", (), {"master": "yarn"})})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_root(cluster)


def test_several_updates_of_a_key_need_an_order(spark, lake):
    lake.write(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), "t")
    updates = spark.createDataFrame([("a", 2), ("a", 3)], "k string, v int")
    with pytest.raises(Exception, match="need an order"):
        lake.update_by_key("t", updates, ["k"], ["v"])
    assert rows(lake.read("t")) == [("a", 1), ("b", 1)]


def test_failing_pull_leaves_the_table(spark):
    places = [(f"{n}_{id(spark)}", scratch_dir(spark, n)) for n in ("near", "far")]
    far = Lake(spark, *places[1])
    far.write(spark.range(3), "numbers")
    current = spark.catalog.currentDatabase()
    here, there = attach(spark, *places)
    try:
        here.pull(there, "numbers")
        there.read = lambda name: far.read(name).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
        with pytest.raises(Exception, match="lost"):
            here.pull(there, "numbers")
        assert rows(here.read("numbers")) == [(0,), (1,), (2,)]
        assert here.pull(here, "numbers", limit=2, key="id") == 2
        assert rows(here.read("numbers")) == [(0,), (1,)]
    finally:
        spark.catalog.setCurrentDatabase(current)
