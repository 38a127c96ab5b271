"""Incremental selection, counters, and model-backed jobs with a pure function as model."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgraph.functions import vectors as vec
from corpusgraph.operators import incremental, jobs, sampling
from corpusgraph.plans import extraction, graph
from corpusgraph.sources.lake import Lake
from corpusgraph.sources.scratch import scratch_dir
from workload import inputs
from workload.check import Check, r6, sql_r6
from workload.inputs import table, with_views

VERSION = {"model_name": "m1", "prompt_version": "v_a"}
KEY = "publication_number"


def _lake(spark: SparkSession) -> Lake:
    database = f"runs_{uuid.uuid4().hex[:12]}"
    return Lake(spark, database, scratch_dir(spark, database))


# Stand-ins for a model, the same function of their input in every run.


def extractor(title: str, abstract: str) -> dict:
    last = abstract.split("\n")[-1]
    found = f"gen-{len(abstract)}" if len(title) != len(abstract) else None
    return {"problem": f"  {title}\n", "solution": last, "generation_id": found}


def embedder(texts: list[str]) -> list[list[float]]:
    return [[len(t), t.count("e"), t.count(" "), t.count("\n")] for t in texts]


def fetcher(generation_id: str) -> dict | None:
    number = int(generation_id.split("-")[1])
    if number % 10 == 7:
        return None
    fields = {
        "provider_name": f"p{number % 3}",
        "total_cost": number / 1000,
        "tokens_prompt": number % 100,
        "latency": float(number),
        "streamed": number % 2 == 0,
    }
    return {"data": fields} if number % 2 else fields


# Selection


def pending_extractions(spark: SparkSession, sf: str) -> DataFrame:
    done = inputs.extractions(spark, sf)
    return incremental.pending(inputs.cleaned(spark, sf), done, KEY, constants=VERSION)


def pending_limited(spark: SparkSession, sf: str) -> DataFrame:
    """The first ten thousand line items of orders that are not finished, with NULL and
    repeated keys: how many of each key."""
    key = F.when(F.col("l_linenumber") != 7, F.col("l_orderkey")).alias("key")
    lines = table(spark, sf, "lineitem").select(key)
    finished = table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
    done = finished.select(F.col("o_orderkey").alias("key"))
    rest = incremental.pending(lines, done, "key", limit=10_000)
    return rest.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def pending_generations(spark: SparkSession, sf: str) -> DataFrame:
    return extraction.unfetched_generations(
        inputs.extractions(spark, sf),
        inputs.generations(spark, sf).where(F.col("fetched_at").isNotNull()),
    )


def pending_embedding_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The batches named after the region keys are fetched already."""
    fetched = table(spark, sf, "region").select(
        F.concat(F.lit("emb-"), "r_regionkey").alias("generation_id")
    )
    return extraction.unfetched_batches(inputs.extractions(spark, sf), fetched)


def pending_graph_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The patents of the labelled documents are in the graph already."""
    known = table(spark, sf, "labels").select(
        inputs.patent_number(F.col("doc_id")).alias(KEY), F.lit("Patent").alias("label")
    )
    return graph.pending_rows(inputs.patents(spark, sf), known).select(KEY)


def pending_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["problem_embedding", "solution_embedding"]
    rows = incremental.lacking_any(inputs.extractions(spark, sf), columns)
    return rows.select(KEY, "problem", "solution")


def embedded_rows(spark: SparkSession, sf: str) -> DataFrame:
    return graph.embedded_rows(inputs.extractions(spark, sf)).select(
        KEY, F.size("problem_embedding").alias("dim"), "embedding_generation_id"
    )


def check_dimension(spark: SparkSession, sf: str) -> DataFrame:
    vectors = (F.col("problem_embedding"), F.col("solution_embedding"))
    return inputs.extractions(spark, sf).select(
        KEY,
        F.when(vectors[0].isNotNull(), F.size(vectors[0])).alias("dim"),
        vec.has_dimension(64, *vectors).alias("both_64"),
        vec.has_dimension(4096, vectors[0]).alias("first_4096"),
    )


# Counters


def total_count(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.cleaned(spark, sf).agg(F.count(F.lit(1)).alias("total"))


def processed_count(spark: SparkSession, sf: str) -> DataFrame:
    return extraction.processed_count(inputs.extractions(spark, sf), *VERSION.values())


def embedding_stats(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.coverage(inputs.extractions(spark, sf), "problem_embedding")


def run_counters(spark: SparkSession, sf: str) -> DataFrame:
    checked = jobs.validate_extractions(inputs.extractions(spark, sf))
    counters = incremental.run_counters(checked, F.col("reason").isNull())
    return counters.withColumn("success_rate_pct", r6("success_rate_pct"))


def seeded_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.seeded_sample(inputs.cleaned(spark, sf), KEY).select(KEY)


# Jobs


def assign_embedding_batches(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.extractions(spark, sf).select(KEY, "embedding_generation_id")
    return jobs.assign_embedding_batches(rows, KEY)


def interleave_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    rows = jobs.model_inputs(inputs.extractions(spark, sf))
    texts = jobs.interleave(rows, KEY, "problem_input", "solution_input")
    sized = texts.withColumn("size", F.length("text"))
    return jobs.deinterleave(sized, KEY, "size")


def extract_pairs(spark: SparkSession, sf: str) -> DataFrame:
    found = jobs.extract_pairs(inputs.cleaned(spark, sf), extractor)
    timed = F.col("processing_time_ms") >= 0
    return found.select(
        KEY, "problem", "solution", "generation_id", "reason", timed.alias("timed")
    )


def embed_pairs(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.extractions(spark, sf).drop("problem_embedding", "solution_embedding")
    found = jobs.embed_pairs(rows, embedder, KEY, dim=4)
    sides = [F.posexplode("problem_embedding").alias("element", "problem_value")]
    return found.select(KEY, "reason", "solution_embedding", *sides).select(
        KEY,
        "element",
        "problem_value",
        F.get("solution_embedding", F.col("element")).alias("solution_value"),
        "reason",
    )


def fetch_generations(spark: SparkSession, sf: str) -> DataFrame:
    lake = _lake(spark)
    todo = inputs.extractions(spark, sf).select("generation_id", KEY)
    extraction.run_fetch(
        lake, todo, "metadata", extraction.EXTRACTION_GENERATIONS, fetcher
    )
    return lake.read("metadata").select(
        "generation_id",
        KEY,
        "provider_name",
        "total_cost",
        "tokens_prompt",
        "tokens_completion",
        "latency",
        "streamed",
        F.col("fetched_at").isNotNull().alias("stamped"),
    )


def resume_two_runs(spark: SparkSession, sf: str) -> DataFrame:
    """A run that stops early and a second one leave what a single run leaves."""
    lake = _lake(spark)
    given = lake.write(inputs.cleaned(spark, sf), "cleaned").rows
    for limit in (given // 2, None):
        extraction.run_extraction(
            lake, "cleaned", "extractions", extractor, ("p", "m"), "v_a", limit
        )
    extraction.run_embedding(lake, "extractions", embedder, dim=4)
    return lake.read("extractions").select(
        KEY,
        "title_text",
        "problem",
        "solution",
        "generation_id",
        "model_name",
        F.get("problem_embedding", F.lit(0)).alias("problem_size"),
        F.get("solution_embedding", F.lit(1)).alias("solution_es"),
    )


# Comparison SQL

_INPUTS = [
    f"'Instruct: {task}' || chr(10) || 'Query: ' || {column}"
    for task, column in (
        (jobs.text.PROBLEM_TASK, "problem"),
        (jobs.text.SOLUTION_TASK, "solution"),
    )
]


def _features(column: str) -> str:
    counts = [
        f"length({column}) - length(replace({column}, {c}, ''))"
        for c in ("'e'", "' '", "chr(10)")
    ]
    return f"[length({column}), {', '.join(counts)}]"


_STRIP = r"'^\s+|\s+$', '', 'g'"
_ANSWERS = rf"""answers as materialized (select *, case when generation_id is null then
        'no generation id' when length(problem) < 10 or length(solution) < 10 then
        'too short' end reason
    from (select publication_number, title_text,
        regexp_replace(title_text, {_STRIP}) problem,
        regexp_replace(split_part(abstract_text, chr(10), -1), {_STRIP}) solution,
        case when length(title_text) <> length(abstract_text)
            then concat('gen-', length(abstract_text)) end generation_id
        from cleaned))"""
_SIZES = (
    f"sized as materialized (select *, {_INPUTS[0]} pi, {_INPUTS[1]} si from extractions)"
)

CHECKS = {
    "pending_extractions": Check(
        pending_extractions,
        with_views(
            """select c.* from cleaned c left join extractions e on
            c.publication_number = e.publication_number and model_name = 'm1'
            and prompt_version = 'v_a' where e.publication_number is null""",
            "cleaned",
            "extractions",
        ),
    ),
    "pending_limited": Check(
        pending_limited,
        """select key, count(*) n from (
            select key from (select case when l_linenumber <> 7 then l_orderkey end key
                from lineitem) where key is null or key not in
                (select o_orderkey from orders where o_orderstatus = 'F')
            order by key nulls first limit 10000) group by key""",
    ),
    "pending_generations": Check(
        pending_generations,
        with_views(
            """select generation_id, publication_number from extractions
            where generation_id not in (select generation_id from generations
                where fetched_at is not null)""",
            "extractions",
            "generations",
        ),
    ),
    "pending_embedding_batches": Check(
        pending_embedding_batches,
        with_views(
            """select embedding_generation_id generation_id, count(*) patents_in_batch,
            count(*) * 2 embeddings_in_batch from extractions
            where embedding_generation_id is not null and embedding_generation_id not in
                (select 'emb-' || r_regionkey from region) group by 1""",
            "extractions",
        ),
    ),
    "pending_graph_rows": Check(
        pending_graph_rows,
        with_views(
            """select publication_number from patents
            where id not in (select doc_id from labels)""",
            "patents",
        ),
    ),
    "pending_embeddings": Check(
        pending_embeddings,
        with_views(
            """select publication_number, problem, solution from extractions
            where problem_embedding is null or solution_embedding is null""",
            "extractions",
        ),
    ),
    "embedded_rows": Check(
        embedded_rows,
        with_views(
            """select publication_number, len(problem_embedding)::int dim,
            embedding_generation_id from extractions
            where problem_embedding is not null and solution_embedding is not null""",
            "extractions",
        ),
    ),
    "check_dimension": Check(
        check_dimension,
        with_views(
            """select publication_number, len(problem_embedding)::int dim,
            coalesce(len(problem_embedding) = 64 and len(solution_embedding) = 64, false)
                both_64,
            coalesce(len(problem_embedding) = 4096, false) first_4096 from extractions""",
            "extractions",
        ),
    ),
    "total_count": Check(
        total_count, with_views("select count(*) total from cleaned", "cleaned")
    ),
    "processed_count": Check(
        processed_count,
        with_views(
            "select count(*) processed from extractions where model_name = 'm1' "
            "and prompt_version = 'v_a'",
            "extractions",
        ),
    ),
    "embedding_stats": Check(
        embedding_stats,
        with_views(
            """select count(*) total, count(problem_embedding) with_value,
            count(*) - count(problem_embedding) without_value from extractions""",
            "extractions",
        ),
    ),
    "run_counters": Check(
        run_counters,
        with_views(
            rf"""select count(*) filter (good) succeeded,
            count(*) filter (not good) failed,
            {sql_r6('count(*) filter (good) * 100.0::double / count(*)')} success_rate_pct
            from (select length(regexp_replace(problem, {_STRIP})) >= 10
                and length(regexp_replace(solution, {_STRIP})) >= 10 good
                from extractions)""",
            "extractions",
        ),
    ),
    "seeded_sample": Check(
        seeded_sample,
        with_views(
            """select publication_number from cleaned
            order by md5('42:' || publication_number), publication_number limit 500""",
            "cleaned",
        ),
    ),
    "assign_embedding_batches": Check(
        assign_embedding_batches,
        with_views(
            """select publication_number, batch, coalesce(embedding_generation_id, 'emb-' ||
                md5(string_agg(publication_number, chr(10) order by publication_number)
                    over (partition by batch))) embedding_generation_id
            from (select publication_number, embedding_generation_id,
                (row_number() over (order by publication_number) - 1) // 10 batch
                from extractions)""",
            "extractions",
        ),
    ),
    "interleave_roundtrip": Check(
        interleave_roundtrip,
        with_views(
            "select publication_number, length(pi)::int as first, length(si)::int as second "
            "from sized",
            "extractions",
            ctes=_SIZES,
        ),
    ),
    "extract_pairs": Check(
        extract_pairs,
        with_views(
            "select publication_number, problem, solution, generation_id, reason, "
            "true timed from answers",
            "cleaned",
            ctes=_ANSWERS,
        ),
    ),
    "embed_pairs": Check(
        embed_pairs,
        with_views(
            f"""select publication_number, (element - 1)::int as element,
            p[element]::double problem_value, s[element]::double solution_value,
            null::varchar reason
            from (select publication_number, {_features('pi')} p, {_features('si')} s
                from sized), (select unnest(range(1, 5)) element)""",
            "extractions",
            ctes=_SIZES,
        ),
    ),
    "fetch_generations": Check(
        fetch_generations,
        with_views(
            """select generation_id, publication_number, 'p' || n % 3 provider_name,
            n / 1000 total_cost, (n % 100)::int tokens_prompt, null::int tokens_completion,
            n::double latency, n % 2 = 0 streamed, true stamped
            from (select *, split_part(generation_id, '-', 2)::bigint n from extractions)
            where n % 10 <> 7""",
            "extractions",
        ),
    ),
    "resume_two_runs": Check(
        resume_two_runs,
        with_views(
            f"""select publication_number, title_text, problem, solution, generation_id,
            'm' model_name, length({_INPUTS[0]})::double problem_size,
            (length({_INPUTS[1]}) - length(replace({_INPUTS[1]}, 'e', '')))::double
                solution_es
            from answers where reason is null""",
            "cleaned",
            ctes=_ANSWERS,
        ),
    ),
}
