"""Table operations: every job writes below a folder of its own and reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusgraph.plans import publications as pubs
from corpusgraph.plans import stories
from corpusgraph.sources import files
from corpusgraph.sources.lake import Lake, attach
from corpusgraph.sources.scratch import scratch_dir
from workload import inputs
from workload.check import TABLES, Check
from workload.inputs import table, with_views


def _lake(spark: SparkSession, name: str = "lake") -> Lake:
    database = f"{name}_{uuid.uuid4().hex[:12]}"
    return Lake(spark, database, scratch_dir(spark, database))


def _namespaces(spark: SparkSession, sf: str, *names: str) -> tuple[Lake, Lake]:
    """A local namespace and a read-only one that holds some of the given tables."""
    owner = _lake(spark, "remote")
    for name in names:
        owner.write(table(spark, sf, name), name)
    database = f"local_{uuid.uuid4().hex[:12]}"
    current = spark.catalog.currentDatabase()
    here, there = attach(
        spark,
        (database, scratch_dir(spark, database)),
        (owner.database, owner.location),
    )
    spark.catalog.setCurrentDatabase(current)
    return here, there


def scan_table(spark: SparkSession, sf: str) -> DataFrame:
    lake = _lake(spark)
    lake.write(table(spark, sf, "orders"), "orders")
    return lake.read("orders")


def full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """The second write reads the table it replaces."""
    lake = _lake(spark)
    lake.write(table(spark, sf, "orders"), "orders")
    raised = lake.read("orders").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    lake.write(raised.where("o_orderstatus <> 'F'"), "orders")
    return lake.read("orders")


def schema_evolve(spark: SparkSession, sf: str) -> DataFrame:
    """Columns come in another order, one is new and one is missing."""
    lake = _lake(spark)
    lake.write(table(spark, sf, "supplier"), "supplier")
    columns = ["s_acctbal", "s_name", "s_suppkey"]
    changed = table(spark, sf, "supplier").select(
        *columns, (F.col("s_acctbal") < 0).alias("in_debt")
    )
    lake.write(changed, "supplier")
    return lake.read("supplier")


def write_stats(spark: SparkSession, sf: str) -> DataFrame:
    lake = _lake(spark)
    stats = [lake.write(table(spark, sf, name), name) for name in TABLES]
    return spark.createDataFrame(
        [(s.table, s.rows) for s in stats], "table_name string, row_count bigint"
    )


def csv_append(spark: SparkSession, sf: str) -> DataFrame:
    """Publications in a CSV file with extra columns are added to the table."""
    lake = _lake(spark)
    flat = pubs.flatten(inputs.publications(spark, sf))
    lake.write(flat, "raw")
    landed = scratch_dir(spark, "evaluation")
    extra = {"Cluster": F.lit("c"), "GooglePatentsID": F.col("publication_number")}
    files.export(flat.drop("assignee").withColumns(extra), landed, "csv")
    kept = T.StructType([f for f in flat.schema if f.name != "assignee"])
    for name in extra:
        kept = kept.add(name, "string")
    pubs.append_csv(lake, "raw", files.read_csv(spark, landed, kept))
    columns = [c for c in flat.columns if c != "assignee"]
    return lake.read("raw").select(
        *columns,
        F.array_join("assignee", ",").alias("assignees"),
        "is_evaluation",
    )


def _exported(spark: SparkSession, sf: str, fmt: str, name: str) -> DataFrame:
    lake = _lake(spark)
    source = table(spark, sf, name)
    lake.write(source, name)
    path = scratch_dir(spark, fmt)
    lake.export(name, fmt, path)
    reader = spark.read.schema(source.schema)
    if fmt == "parquet":
        return reader.parquet(path)
    if fmt == "csv":
        return files.read_csv(spark, path, source.schema)
    return reader.option("multiLine", str(fmt == "json").lower()).json(path)


def export_parquet(spark: SparkSession, sf: str) -> DataFrame:
    return _exported(spark, sf, "parquet", "customer")


def export_csv(spark: SparkSession, sf: str) -> DataFrame:
    return _exported(spark, sf, "csv", "documents")


def export_ndjson(spark: SparkSession, sf: str) -> DataFrame:
    return _exported(spark, sf, "ndjson", "pages")


def export_json_array(spark: SparkSession, sf: str) -> DataFrame:
    return _exported(spark, sf, "json", "conversations")


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "stories")
    rows = inputs.stories(spark, sf)
    files.export(rows, path, "csv")
    return files.read_csv(spark, path, rows.schema)


def pull_table(spark: SparkSession, sf: str) -> DataFrame:
    here, there = _namespaces(spark, sf, "part")
    here.pull(there, "part")
    return here.read("part")


def pull_limit(spark: SparkSession, sf: str) -> DataFrame:
    here, there = _namespaces(spark, sf, "part")
    here.pull(there, "part", limit=100, key="p_partkey")
    return here.read("part")


def list_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The tables of a read-only namespace with their sizes."""
    _, there = _namespaces(spark, sf, *TABLES)
    counted = [
        there.read(name).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")
        )
        for name in there.tables()
    ]
    listed = counted[0]
    for one in counted[1:]:
        listed = listed.unionByName(one)
    return listed


def describe_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Columns of a stored table in order, with their numbers of values."""
    lake = _lake(spark)
    lake.write(table(spark, sf, "lineitem"), "lineitem")
    names = lake.columns("lineitem")
    filled = lake.read("lineitem").agg(*[F.count(n).alias(n) for n in names])
    place = F.create_map(*[F.lit(x) for i, n in enumerate(names) for x in (n, i + 1)])
    return filled.unpivot([], names, "column_name", "filled").withColumn(
        "position", place[F.col("column_name")]
    )


def add_column(spark: SparkSession, sf: str) -> DataFrame:
    lake = _lake(spark)
    lake.write(table(spark, sf, "customer"), "customer")
    added = [lake.add_column("customer", c) for c in ("note", "c_name", "note")]
    return lake.read("customer").withColumn("added", F.lit(str(added)))


def ensure_table(spark: SparkSession, sf: str) -> DataFrame:
    """A declared table refuses rows without a key and takes the others."""
    lake = _lake(spark)
    declared = T.StructType(
        [
            T.StructField("id", T.LongType(), False),
            T.StructField("title", T.StringType()),
            T.StructField("flag", T.BooleanType()),
        ]
    )
    first = lake.ensure_table("stories", declared)
    second = lake.ensure_table("stories", declared.add("author", "string"))
    lake.append(inputs.stories(spark, sf), "stories")
    return lake.read("stories").withColumn("created", F.lit(f"{first} {second}"))


def append_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches with different columns; the load time is set for both."""
    lake = _lake(spark)
    rows = inputs.generations(spark, sf).drop("fetched_at")
    lake.write(stories.stamp_fetched_at(rows.limit(0)), "generations")
    known = F.col("provider_name").isNotNull()
    lake.append(stories.stamp_fetched_at(rows.where(known)), "generations")
    lake.append(stories.stamp_fetched_at(rows.where(~known).drop("latency")), "generations")
    stamped = F.col("fetched_at").isNotNull().alias("stamped")
    return lake.read("generations").select(*rows.columns, stamped)


def keyed_update(spark: SparkSession, sf: str) -> DataFrame:
    """Each event sets the last value of its user's customers; the latest event wins. The
    table is in buckets, of which the update writes those with events."""
    lake = _lake(spark)
    customers = table(spark, sf, "customer").withColumn("last_event", F.lit(None).cast("string"))
    lake.write_bucketed(customers, "customer", ["c_nationkey"], 16)
    updates = table(spark, sf, "events").select(
        F.col("user_id").cast("int").alias("c_nationkey"),
        F.col("event_type").alias("last_event"),
        F.col("value").alias("c_acctbal"),
        "ts",
    )
    changed = ["last_event", "c_acctbal"]
    lake.update_by_key("customer", updates, ["c_nationkey"], changed, order_by="ts")
    return lake.read("customer")


def attach_namespaces(spark: SparkSession, sf: str) -> DataFrame:
    """Ad-hoc SQL over a local and a read-only namespace together."""
    here, there = _namespaces(spark, sf, "orders", "customer")
    here.pull(there, "customer")
    return spark.sql(
        f"""select c_mktsegment, count(*) orders, round(sum(o_totalprice), 2) revenue
        from {there.qualified('orders')} join {here.qualified('customer')}
        on o_custkey = c_custkey group by c_mktsegment"""
    )


def enrich_items(spark: SparkSession, sf: str) -> DataFrame:
    """Landed lists (each document's successors) and landed items (the documents, some
    without a title); the last lists name items that do not exist."""
    doc = F.col("doc_id")
    documents = table(spark, sf, "documents")
    lists = documents.select("doc_id", F.sequence(doc + 6, doc, F.lit(-1)).alias("story_ids"))
    titled = F.when(F.col("lang") != "es", F.col("text"))
    items = documents.select(
        doc.alias("id"), titled.alias("title"), F.col("source").alias("by")
    )
    places = [scratch_dir(spark, label) for label in ("lists", "items")]
    lists.write.json(places[0])
    items.write.json(places[1])
    return stories.enrich_items(
        files.read_items(spark, places[0], lists.schema),
        files.read_items(spark, places[1], items.schema),
    )


# Ad-hoc SQL. The text is the same for both engines.

SHARED_SQL = {
    "sql_join_agg": """
        select n_name, count(*) items, count(distinct o_orderkey) orders,
            round(sum(l_extendedprice * (1 - l_discount)), 2) revenue
        from customer join orders on c_custkey = o_custkey
        join lineitem on o_orderkey = l_orderkey
        join nation on c_nationkey = n_nationkey
        left join region on n_regionkey = r_regionkey and r_name <> 'ASIA'
        where r_name is not null
        group by n_name having count(*) > 10""",
    "sql_rollup": """
        select l_returnflag, l_linestatus, grouping(l_linestatus) level, count(*) items,
            round(sum(l_quantity), 2) quantity
        from lineitem group by rollup (l_returnflag, l_linestatus)""",
    "sql_window": """
        select o_custkey, o_orderkey, cast(place as int) place, round(running, 2) running
        from (select o_custkey, o_orderkey,
            rank() over (partition by o_custkey order by o_totalprice desc, o_orderkey)
                place,
            sum(o_totalprice) over (partition by o_custkey order by o_totalprice desc,
                o_orderkey rows between unbounded preceding and current row) running
            from orders) ranked
        where place <= 3""",
    "sql_setops": """
        select c_nationkey from customer intersect select s_nationkey from supplier
        union all
        (select n_nationkey from nation except select s_nationkey from supplier)""",
    "sql_subquery": """
        select p_partkey, p_name from part p
        where p_retailprice > (select avg(q.p_retailprice) from part q
            where q.p_brand = p.p_brand)
        and exists (select 1 from lineitem where l_partkey = p_partkey)
        and p_partkey not in (select l_partkey from lineitem where l_quantity > 49)""",
    "sql_time_window": """
        select date_trunc('hour', ts) hour_start, event_type, count(*) events,
            round(sum(value), 4) total
        from events group by date_trunc('hour', ts), event_type""",
}


def _shared(name: str):
    def job(spark: SparkSession, sf: str) -> DataFrame:
        frames = {t: table(spark, sf, t) for t in TABLES}
        for key, frame in frames.items():
            frame.createOrReplaceTempView(key)
        return spark.sql(SHARED_SQL[name])

    return job


_COUNTS = " union all ".join(
    f"select '{t}' table_name, count(*) row_count from {t}" for t in TABLES
)
_LINEITEM = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount "
    "l_tax l_returnflag l_linestatus l_shipdate"
).split()

CHECKS = {
    "scan_table": Check(scan_table, "select * from orders"),
    "full_refresh": Check(
        full_refresh,
        "select * replace (o_totalprice * 2 as o_totalprice) from orders "
        "where o_orderstatus <> 'F'",
    ),
    "schema_evolve": Check(
        schema_evolve,
        "select s_suppkey, s_name, null::int s_nationkey, s_acctbal, s_acctbal < 0 in_debt "
        "from supplier",
    ),
    "write_stats": Check(write_stats, _COUNTS),
    "csv_append": Check(
        csv_append,
        with_views(
            """select publication_number, application_number, publication_date,
            grant_date, title, abstract, claims_text,
            case when not added then array_to_string(assignee, ',') end assignees,
            case when added then true end is_evaluation
            from publications, (values (false), (true)) f(added)""",
            "publications",
        ),
    ),
    "export_parquet": Check(export_parquet, "select * from customer"),
    "export_csv": Check(export_csv, "select * from documents"),
    "export_ndjson": Check(export_ndjson, "select * from pages"),
    "export_json_array": Check(export_json_array, "select * from conversations"),
    "csv_roundtrip": Check(csv_roundtrip, with_views("select * from stories", "stories")),
    "pull_table": Check(pull_table, "select * from part"),
    "pull_limit": Check(pull_limit, "select * from part order by p_partkey limit 100"),
    "list_tables": Check(list_tables, _COUNTS),
    "describe_columns": Check(
        describe_columns,
        " union all ".join(
            f"select '{c}' column_name, count({c}) filled, {i + 1} as position "
            "from lineitem"
            for i, c in enumerate(_LINEITEM)
        ),
    ),
    "add_column": Check(
        add_column,
        "select *, null::varchar note, '[True, False, False]' added from customer",
    ),
    "ensure_table": Check(
        ensure_table,
        with_views(
            "select id, title, null::boolean flag, author, 'True False' created "
            "from stories",
            "stories",
        ),
    ),
    "append_batch": Check(
        append_batch,
        with_views(
            """select generation_id, provider_name, total_cost, tokens_prompt,
            tokens_completion, case when provider_name is not null then latency end
            latency, true stamped from generations""",
            "generations",
        ),
    ),
    "keyed_update": Check(
        keyed_update,
        """with latest as (select user_id, arg_max(event_type, ts) event_type,
            arg_max(value, ts) value from events group by user_id)
        select c_custkey, c_name, c_nationkey, case when user_id is null then c_acctbal
            else value end c_acctbal, c_mktsegment, event_type last_event
        from customer left join latest on user_id = c_nationkey""",
    ),
    "attach_namespaces": Check(
        attach_namespaces,
        """select c_mktsegment, count(*) orders, round(sum(o_totalprice), 2) revenue
        from orders join customer on o_custkey = c_custkey group by c_mktsegment""",
    ),
    "enrich_items": Check(
        enrich_items,
        """select d.doc_id, place::int as position, d.doc_id + 6 - place id,
            case when i.lang <> 'es' then i.text end title, i.source author
        from documents d, (select unnest(range(5)) place)
        left join documents i on i.doc_id = d.doc_id + 6 - place""",
    ),
    **{name: Check(_shared(name), sql) for name, sql in SHARED_SQL.items()},
}
