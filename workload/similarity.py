"""Vector search, clustering, graphs and similarity distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgraph.functions import vectors as vec
from corpusgraph.operators import clustering, distribution
from corpusgraph.operators import similarity as sim
from corpusgraph.operators.blocks import load_vectors
from corpusgraph.plans import graph
from corpusgraph.session import side_by_side
from corpusgraph.sources.scratch import scratch_dir
from workload import inputs
from workload.check import Check, r6, sql_r6
from workload.inputs import table, with_views

# Row-wise functions


def normalize_vectors(spark: SparkSession, sf: str) -> DataFrame:
    unit = vec.normalize(F.col("emb"))
    long = inputs.vectors(spark, sf).select("id", F.posexplode(unit).alias("pos", "x"))
    return long.select("id", "pos", r6("x").alias("x"))


def cosine_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Problem against solution vector of each patent."""
    value = vec.cosine(F.col("problem_embedding"), F.col("solution_embedding"))
    return inputs.patents(spark, sf).select(
        "publication_number", r6(value).alias("similarity")
    )


# Search


def similar_pairs(spark: SparkSession, sf: str) -> DataFrame:
    found = sim.similar_pairs(inputs.vectors(spark, sf), "id", "emb", 0.60)
    return found.withColumn("similarity", r6("similarity"))


def knn(spark: SparkSession, sf: str) -> DataFrame:
    found = sim.knn(inputs.vectors(spark, sf), "id", "emb", k=10, threshold=0.80)
    return found.withColumn("similarity", r6("similarity"))


# Clusters


def _clusters(spark: SparkSession, sf: str, link: float | None = None):
    vectors = load_vectors(inputs.vectors(spark, sf), "id", "emb")
    return vectors, clustering.cluster(vectors, link=link)


def cluster_assign(spark: SparkSession, sf: str) -> DataFrame:
    _, clusters = _clusters(spark, sf)
    return clusters.members.withColumn("similarity", r6("similarity"))


def cluster_centroids(spark: SparkSession, sf: str) -> DataFrame:
    vectors, clusters = _clusters(spark, sf)
    middle = clustering.centroids(vectors, clusters.members)
    return middle.select(
        "leader", "merge_count", F.posexplode("embedding").alias("pos", "x")
    ).withColumn("x", r6("x"))


def similar_to_links(spark: SparkSession, sf: str) -> DataFrame:
    _, clusters = _clusters(spark, sf, clustering.LINK_THRESHOLD)
    links = clustering.similar_links(clusters)
    return links.withColumn("similarity", r6("similarity"))


# Graphs


def _edge_rows(edges: DataFrame) -> DataFrame:
    return edges.withColumn("similarity", r6("similarity"))


def dense_problem_edges(spark: SparkSession, sf: str) -> DataFrame:
    return _edge_rows(graph.dense_edges(inputs.patents(spark, sf), "Problem"))


def dense_solution_edges(spark: SparkSession, sf: str) -> DataFrame:
    return _edge_rows(graph.dense_edges(inputs.patents(spark, sf), "Solution"))


def graph_nodes(spark: SparkSession, sf: str) -> DataFrame:
    nodes = graph.dense_nodes(inputs.patents(spark, sf))
    last = nodes.withColumn("embedding", r6(F.get("embedding", F.lit(63))))
    return last.drop("leader_embedding", "member_sum")


def graph_edges(spark: SparkSession, sf: str) -> DataFrame:
    return _edge_rows(graph.dense_graph(inputs.patents(spark, sf)).edges)


def cluster_nodes(spark: SparkSession, sf: str) -> DataFrame:
    whole = graph.clustered_graph(inputs.patents(spark, sf))
    nodes = whole.nodes.where(F.col("label") != "Patent")
    return nodes.select(
        "node_id",
        "label",
        "description",
        "merge_count",
        r6(F.get("embedding", F.lit(63))).alias("last_element"),
    )


def cluster_descriptions(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.patents(spark, sf)
    vectors = load_vectors(rows, "publication_number", "problem_embedding")
    members = clustering.cluster(vectors).members
    return graph.cluster_descriptions(rows, "problem", members)


def clustered_graph_edges(spark: SparkSession, sf: str) -> DataFrame:
    return _edge_rows(graph.clustered_graph(inputs.patents(spark, sf)).edges)


def _stored(spark: SparkSession, whole: graph.Graph, change=None) -> graph.Graph:
    """A graph written once and read again, and where ``change`` makes one from it, with
    that stored beside it as its next version."""
    path = scratch_dir(spark, "graph")
    graph.write_graph(whole, path)
    if change:
        graph.write_graph(change(graph.read_graph(spark, path)), path, 1)
    return graph.read_graph(spark, path)


def _halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The patents of the first half in number order, and the others."""
    rows = inputs.patents(spark, sf)
    middle = inputs.patent_number(F.lit(table(spark, sf, "embeddings").count() * 2))
    number = F.col("publication_number")
    return rows.where(number < middle), rows.where(number >= middle)


def graph_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """A stored graph of the first half, and the change by the second half alone, stored
    as its next version: the same as all at once, if the first half comes first."""
    first, second = _halves(spark, sf)
    whole = graph.clustered_graph(first)
    stored = _stored(spark, whole, lambda known: graph.clustered_change(known, second))
    return _edge_rows(stored.edges)


def dense_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The same with the dense graph, which is the same as all at once."""
    first, second = _halves(spark, sf)
    whole = graph.dense_graph(first)
    stored = _stored(spark, whole, lambda known: graph.dense_change(known, second))
    return _edge_rows(stored.edges)


def graph_stats(spark: SparkSession, sf: str) -> DataFrame:
    return graph.graph_stats(graph.dense_graph(inputs.patents(spark, sf)))


def _replica(spark: SparkSession, sf: str) -> graph.Graph:
    whole = graph.dense_graph(inputs.patents(spark, sf))
    return _stored(spark, graph.replica(whole))


def graph_replica_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return _replica(spark, sf).nodes


def graph_replica_edges(spark: SparkSession, sf: str) -> DataFrame:
    return _edge_rows(_replica(spark, sf).edges)


# Distributions


def _distributions(spark: SparkSession, sf: str):
    columns = {"problem": "problem_embedding", "solution": "solution_embedding"}
    found = distribution.sample_pairs(
        inputs.patents(spark, sf), "publication_number", list(columns.values())
    )
    return [(side, found[column]) for side, column in columns.items()]


def _of_both(spark: SparkSession, sf: str, statistic) -> list[tuple]:
    """``(side, statistic of its pairs)``, both sides at the same time."""
    return side_by_side(
        lambda item: (item[0], statistic(item[1])), _distributions(spark, sf)
    )


def similarity_stats(spark: SparkSession, sf: str) -> DataFrame:
    rows = []
    for side, found in _of_both(spark, sf, lambda pairs: pairs.statistics()):
        rows.append((side, found.pop("num_pairs"), *found.values()))
        names = list(found)
    kinds = ", ".join(f"{n} double" for n in names)
    stats = spark.createDataFrame(rows, f"side string, num_pairs bigint, {kinds}")
    return stats.select("side", "num_pairs", *[r6(n).alias(n) for n in names])


def similarity_histogram(spark: SparkSession, sf: str) -> DataFrame:
    rows = [
        (side, *row)
        for side, found in _of_both(spark, sf, lambda pairs: pairs.histogram())
        for row in found
    ]
    listed = spark.createDataFrame(
        rows, "side string, bin int, low double, high double, pairs bigint"
    )
    return listed.withColumns({"low": r6("low"), "high": r6("high")})


def similarity_cumulative(spark: SparkSession, sf: str) -> DataFrame:
    rows = [
        (side, *row)
        for side, found in _of_both(spark, sf, lambda pairs: pairs.cumulative())
        for row in found
    ]
    listed = spark.createDataFrame(
        rows, "side string, threshold double, pct_at_or_above double"
    )
    return listed.withColumns(
        {c: r6(c) for c in ("threshold", "pct_at_or_above")}
    )


def similarity_box(spark: SparkSession, sf: str) -> DataFrame:
    rows = [
        (side, *found.values())
        for side, found in _of_both(spark, sf, lambda pairs: pairs.box())
    ]
    names = ["q1", "median", "q3", "whisker_low", "whisker_high"]
    kinds = ", ".join(f"{n} double" for n in names)
    listed = spark.createDataFrame(rows, f"side string, {kinds}, outliers bigint")
    return listed.withColumns({n: r6(n) for n in names})


# Comparison SQL


def _number(column: str) -> str:
    return f"'P' || lpad(({column})::varchar, 9, '0')"


def _by_id(column: str) -> str:
    return f"md5('42:' || {column})"


def _by_number(column: str) -> str:
    return f"md5('42:' || {_number(column)})"


def _by_half(column: str) -> str:
    """Rows of the first half, which are in the graph already, come first."""
    later = f"({column} >= (select count(*) * 2 from embeddings))::int"
    return f"({later} || {_by_number(column)})"


def _leader_ctes(name: str, pairs: str, key) -> str:
    """Walk the rows in the order of ``key`` and note the leaders; rows without an earlier
    neighbour above the threshold are leaders from the start."""
    return f"""
    {name}_keys as materialized (select id, {key('id')} k from vectors),
    {name}_seen as materialized (select
        case when a.k < b.k then i else j end early, least(a.k, b.k) early_key,
        case when a.k < b.k then j else i end late, greatest(a.k, b.k) late_key, s
        from {pairs} join {name}_keys a on a.id = i join {name}_keys b on b.id = j
        where s >= 0.8),
    {name}_low as materialized (select late id, list(early) lows,
        row_number() over (order by late_key) place
        from {name}_seen where s >= 0.9 group by late, late_key),
    {name}_walk as (
        select 0::bigint place, (select list(id) from vectors where id not in
            (select id from {name}_low)) found
        union all
        select l.place, case when list_has_any(w.found, l.lows) then w.found
            else list_append(w.found, l.id) end
        from {name}_walk w join {name}_low l on l.place = w.place + 1),
    {name}_leaders as materialized (select unnest(arg_max(found, place)) id
        from {name}_walk),
    {name}_ranked as materialized (select late id, early neighbour, s, late_key,
        row_number() over (partition by late order by s desc, early_key) place
        from {name}_seen where early in (select id from {name}_leaders)),
    {name}_members as materialized (select v.id, coalesce(r.neighbour, v.id) leader,
        coalesce(r.s, 1.0::double) similarity
        from vectors v left join {name}_ranked r
        on r.id = v.id and r.place = 1 and r.s >= 0.9),
    {name}_links as materialized (select leader src, neighbour dst,
        arg_max(s, late_key) similarity
        from {name}_ranked r join {name}_members m on m.id = r.id
        where s < 0.9 and leader <> neighbour group by 1, 2)"""


def _both_sides(key) -> str:
    return f"{_leader_ctes('p', 'pairs', key)}, {_leader_ctes('q', 'backwards', key)}"


_FORWARD = _leader_ctes("p", "pairs", _by_id)
_BOTH = _both_sides(_by_number)


def _node(label: str, column: str) -> str:
    return f"'{label}:' || {_number(column)}"


def _weighted(query: str) -> str:
    return f"select src, dst, type, {sql_r6('similarity')} similarity from ({query})"


_STRUCTURE = f"""
    select {_node('Patent', 'p.id')} src, {_node('Problem', 'p.leader')} dst,
        'HAS_PROBLEM' as type, null::double similarity from p_members p
    union all select {_node('Patent', 'q.id')}, {_node('Solution', 'q.leader')},
        'HAS_SOLUTION', null from q_members q
    union all select {_node('Solution', 'q.leader')}, {_node('Problem', 'p.leader')},
        'SOLVES', null from p_members p join q_members q on p.id = q.id"""
_CLUSTERED = _weighted(
    f"""{_STRUCTURE}
    union all select {_node('Problem', 'src')}, {_node('Problem', 'dst')}, 'SIMILAR_TO',
        similarity from p_links
    union all select {_node('Solution', 'src')}, {_node('Solution', 'dst')},
        'SIMILAR_TO', similarity from q_links"""
)


def _dense(label: str, pairs: str, firsts: str) -> str:
    return f"""select {_node(label, 'i')} src, {_node(label, 'j')} dst,
        'SIMILAR_{label.upper()}' as type, s similarity
        from {pairs} join {firsts} a on a.id = i join {firsts} b on b.id = j
        where s >= 0.6 and a.first = i and b.first = j
        union all select {_node(label, 'first')}, {_node(label, 'id')},
            'SIMILAR_{label.upper()}', 1.0 from {firsts} where first <> id"""


_DENSE = f"""
    select {_node('Patent', 'id')} src, {_node('Problem', 'id')} dst,
        'HAS_PROBLEM' as type, null::double similarity from vectors
    union all select {_node('Patent', 'id')}, {_node('Solution', 'id')}, 'HAS_SOLUTION',
        null from vectors
    union all select {_node('Solution', 'id')}, {_node('Problem', 'id')}, 'SOLVES', null
        from vectors
    union all {_dense('Problem', 'pairs', 'firsts')}
    union all {_dense('Solution', 'backwards', 'backfirsts')}"""
_DENSE_VIEWS = ("vectors", "pairs", "backwards", "firsts", "backfirsts")

_PLAIN_NODES = """
    select 'Patent:' || publication_number node_id, 'Patent' as label, publication_number,
        coalesce(title_text, '') title, coalesce(abstract_text, '') abstract,
        null::varchar description, null::bigint merge_count, null::bigint vector_id
        from patents
    union all select 'Problem:' || publication_number, 'Problem', publication_number,
        null, null, problem, null, id from patents
    union all select 'Solution:' || publication_number, 'Solution', publication_number,
        null, null, solution, null, (select max(id) from units) - id from patents"""
_NUMBERED = f"""plain as materialized ({_PLAIN_NODES}),
    numbered as materialized (select *, row_number() over (order by node_id) - 1 number
        from plain)"""

_COMPARED = """
    chosen as materialized (
        select 'problem' side, id, unit::double[64] v from units
        union all
        select 'solution', u.id, u.unit::double[64]
        from units x join units u on u.id = (select max(id) from units) - x.id),
    compared as materialized (
        select side, round(array_inner_product(a.v, b.v), 9) s
        from chosen a join chosen b using (side) where a.id < b.id)"""


def _means(*names: str) -> str:
    return ", ".join(
        f"{sql_r6(f'avg((s >= {t})::int) * 100')} pct_above_{n}"
        for n, t in zip(names, (0.5, 0.6, 0.7, 0.8))
    )


CHECKS = {
    "normalize_vectors": Check(
        normalize_vectors,
        with_views(
            f"select id, (place - 1)::int pos, {sql_r6('unit[place]')} x "
            "from units, (select unnest(range(1, 65)) place)",
            "units",
        ),
    ),
    "cosine_pairs": Check(
        cosine_pairs,
        with_views(
            f"""select {_number('a.id')} publication_number,
            {sql_r6('list_dot_product(a.unit, b.unit)')} similarity
            from units a join units b on b.id = (select max(id) from units) - a.id""",
            "units",
        ),
    ),
    "similar_pairs": Check(
        similar_pairs,
        with_views(
            f"""select i low, j high, {sql_r6('s')} similarity, a.n low_copies,
            b.n high_copies
            from pairs join copies a on i = a.id join copies b on j = b.id""",
            "pairs",
            ctes="copies as materialized (select min(id) id, count(*) n from vectors "
            "group by emb)",
        ),
    ),
    "knn": Check(
        knn,
        with_views(
            f"""select id, neighbour, {sql_r6('s')} similarity, rank::int as rank from (
            select *, row_number() over (partition by id order by s desc, neighbour) rank
            from (select i id, j neighbour, s from pairs
                union all select j, i, s from pairs) where s >= 0.8) where rank <= 10""",
            "pairs",
        ),
    ),
    "cluster_assign": Check(
        cluster_assign,
        with_views(
            f"select id, leader, {sql_r6('similarity')} similarity from p_members",
            "pairs",
            ctes=_FORWARD,
            recursive=True,
        ),
    ),
    "cluster_centroids": Check(
        cluster_centroids,
        with_views(
            f"""select leader, merge_count, pos, {sql_r6(
                'mean / sqrt(sum(mean * mean) over (partition by leader))')} x
            from (select leader, (place - 1)::int pos, avg(unit[place]) mean,
                count(*) merge_count
                from p_members join units using (id), (select unnest(range(1, 65)) place)
                group by leader, place)""",
            "pairs",
            ctes=_FORWARD,
            recursive=True,
        ),
    ),
    "similar_to_links": Check(
        similar_to_links,
        with_views(
            f"select src, dst, {sql_r6('similarity')} similarity from p_links",
            "pairs",
            ctes=_FORWARD,
            recursive=True,
        ),
    ),
    "cluster_nodes": Check(
        cluster_nodes,
        with_views(
            f"""select 'Problem:' || publication_number node_id, 'Problem' as label,
            problem description, n merge_count, {sql_r6('x')} last_element
            from patents join (select leader, n, x[64] / sqrt(list_dot_product(x, x)) x
                from (select leader, first(n) n, list(mean order by place) x from (
                    select leader, place, avg(unit[place]) mean, count(*) n
                    from p_members join units using (id),
                        (select unnest(range(1, 65)) place)
                    group by leader, place) group by leader)) on leader = id
            union all
            select 'Solution:' || publication_number, 'Solution', solution, n,
                {sql_r6('x')}
            from patents join (select leader, n, x[64] / sqrt(list_dot_product(x, x)) x
                from (select leader, first(n) n, list(mean order by place) x from (
                    select leader, place, avg(unit[place]) mean, count(*) n
                    from q_members q join units u
                        on u.id = (select max(id) from units) - q.id,
                        (select unnest(range(1, 65)) place)
                    group by leader, place) group by leader)) on leader = id""",
            "patents",
            "backwards",
            ctes=_BOTH,
            recursive=True,
        ),
    ),
    "cluster_descriptions": Check(
        cluster_descriptions,
        with_views(
            f"""select {_node('Problem', 'leader')} node_id, publication_number as position,
            problem description from p_members join patents using (id)""",
            "patents",
            "pairs",
            ctes=_leader_ctes("p", "pairs", _by_number),
            recursive=True,
        ),
    ),
    "clustered_graph_edges": Check(
        clustered_graph_edges,
        with_views(_CLUSTERED, "backwards", ctes=_BOTH, recursive=True),
    ),
    "graph_incremental": Check(
        graph_incremental,
        with_views(_CLUSTERED, "backwards", ctes=_both_sides(_by_half), recursive=True),
    ),
    "dense_problem_edges": Check(
        dense_problem_edges,
        with_views(_weighted(_dense("Problem", "pairs", "firsts")), "pairs", "firsts"),
    ),
    "dense_solution_edges": Check(
        dense_solution_edges,
        with_views(
            _weighted(_dense("Solution", "backwards", "backfirsts")),
            "backwards",
            "backfirsts",
        ),
    ),
    "dense_incremental": Check(
        dense_incremental, with_views(_weighted(_DENSE), *_DENSE_VIEWS)
    ),
    "graph_nodes": Check(
        graph_nodes,
        with_views(
            f"""select node_id, label, publication_number, title, abstract, description,
            merge_count, {sql_r6('unit[64]')} embedding
            from ({_PLAIN_NODES}) left join units on units.id = vector_id""",
            "patents",
            "units",
        ),
    ),
    "graph_edges": Check(graph_edges, with_views(_weighted(_DENSE), *_DENSE_VIEWS)),
    "graph_stats": Check(
        graph_stats,
        with_views(
            f"""select 'node' element, label as kind, count(*) as count
            from ({_PLAIN_NODES}) group by label
            union all select 'edge', type, count(*) from ({_DENSE}) group by type""",
            "patents",
            *_DENSE_VIEWS,
        ),
    ),
    "graph_replica_nodes": Check(
        graph_replica_nodes,
        with_views(
            """select node_id source_id, label, publication_number,
            coalesce(title, '') title, coalesce(abstract, '') abstract,
            coalesce(description, '') description, merge_count, number node_id
            from numbered""",
            "patents",
            "units",
            ctes=_NUMBERED,
        ),
    ),
    "graph_replica_edges": Check(
        graph_replica_edges,
        with_views(
            _weighted(
                f"""select a.number src, b.number dst, type, similarity from ({_DENSE}) e
                join numbered a on a.node_id = e.src
                join numbered b on b.node_id = e.dst"""
            ),
            "patents",
            *_DENSE_VIEWS,
            ctes=_NUMBERED,
        ),
    ),
    "similarity_stats": Check(
        similarity_stats,
        with_views(
            f"""select side, count(*) num_pairs, {sql_r6('avg(s)')} mean,
            {sql_r6('stddev_pop(s)')} std, {sql_r6('min(s)')} min, {sql_r6('max(s)')} max,
            {sql_r6('quantile_cont(s, 0.5)')} median, {_means('50', '60', '70', '80')}
            from compared group by side""",
            "units",
            ctes=_COMPARED,
        ),
    ),
    "similarity_histogram": Check(
        similarity_histogram,
        with_views(
            f"""select side, bin::int bin, {sql_r6('low + bin * (high - low) / 50')} low,
            {sql_r6('low + (bin + 1) * (high - low) / 50')} high, coalesce(n, 0) pairs
            from (select * from ends, (select unnest(range(50)) bin)) left join (
                select side, least(floor((s - low) / (high - low) * 50), 49) bin,
                    count(*) n from compared join ends using (side) group by all)
                using (side, bin)""",
            "units",
            ctes=f"{_COMPARED}, ends as materialized (select side, min(s) low, max(s) high "
            "from compared group by side)",
        ),
    ),
    "similarity_cumulative": Check(
        similarity_cumulative,
        with_views(
            f"""select side, {sql_r6('step / 99')} threshold,
            {sql_r6('count(*) filter (s >= step / 99) * 100.0::double / count(*)')}
                pct_at_or_above
            from compared, (select unnest(range(100)) step) group by side, step""",
            "units",
            ctes=_COMPARED,
        ),
    ),
    "similarity_box": Check(
        similarity_box,
        with_views(
            f"""select side, {sql_r6('q1')} q1, {sql_r6('q2')} median, {sql_r6('q3')} q3,
            {sql_r6('min(s) filter (s >= q1 - 1.5 * (q3 - q1))')} whisker_low,
            {sql_r6('max(s) filter (s <= q3 + 1.5 * (q3 - q1))')} whisker_high,
            count(*) filter (s < q1 - 1.5 * (q3 - q1) or s > q3 + 1.5 * (q3 - q1))
                outliers
            from compared join (select side, quantile_cont(s, 0.25) q1,
                quantile_cont(s, 0.5) q2, quantile_cont(s, 0.75) q3
                from compared group by side) using (side) group by side, q1, q2, q3""",
            "units",
            ctes=_COMPARED,
        ),
    ),
}
