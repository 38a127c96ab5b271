"""Title analytics, publication cleaning, text and display functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgraph.functions import text, titles
from corpusgraph.operators import jobs
from corpusgraph.plans import costs, extraction
from corpusgraph.plans import publications as pubs
from corpusgraph.plans import stories
from workload import inputs
from workload.check import Check, r6, sql_r6
from workload.inputs import table, with_views


def story_analytics(spark: SparkSession, sf: str) -> DataFrame:
    return stories.story_analytics(inputs.stories(spark, sf))


def story_preview(spark: SparkSession, sf: str) -> DataFrame:
    return stories.story_preview(inputs.stories(spark, sf))


def story_summary(spark: SparkSession, sf: str) -> DataFrame:
    summary = stories.story_summary(inputs.stories(spark, sf))
    return summary.select(
        "num_stories",
        r6("avg_word_count").alias("avg_word_count"),
        r6("avg_clickbait_score").alias("avg_clickbait_score"),
    )


def top_tags(spark: SparkSession, sf: str) -> DataFrame:
    return stories.top_tags(inputs.stories(spark, sf))


def stamp_fetched_at(spark: SparkSession, sf: str) -> DataFrame:
    return stories.stamp_fetched_at(inputs.stories(spark, sf))


def newest_publications(spark: SparkSession, sf: str) -> DataFrame:
    newest = pubs.newest_publications(inputs.publications(spark, sf), n=100)
    return newest.withColumn("assignee", F.array_join("assignee", ","))


def clean_publications(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = pubs.clean_publications(pubs.flatten(inputs.publications(spark, sf)))
    return cleaned.withColumn("assignee", F.array_join("assignee", ","))


def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return pubs.null_profile(pubs.flatten(inputs.publications(spark, sf)))


def claims_coverage(spark: SparkSession, sf: str) -> DataFrame:
    coverage = pubs.claims_coverage(pubs.flatten(inputs.publications(spark, sf)))
    return coverage.withColumn("coverage_pct", r6("coverage_pct"))


def date_range(spark: SparkSession, sf: str) -> DataFrame:
    return pubs.date_range(inputs.publications(spark, sf))


def model_inputs(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts as a model gets them."""
    return _inputs(spark, sf, None, None, None)


def truncated_inputs(spark: SparkSession, sf: str) -> DataFrame:
    """The same at a model's input limits."""
    limits = (jobs.TITLE_LIMIT, jobs.ABSTRACT_LIMIT, jobs.EMBED_LIMIT)
    return _inputs(spark, sf, *limits)


def _inputs(spark: SparkSession, sf: str, title, abstract, pair) -> DataFrame:
    rows = inputs.extractions(spark, sf).withColumns(
        {
            "title_input": text.truncate(F.col("title_text"), title),
            "abstract_input": text.truncate(F.col("abstract_text"), abstract),
        }
    )
    return jobs.model_inputs(rows, pair).select(
        "publication_number",
        "title_input",
        "abstract_input",
        "problem_input",
        "solution_input",
    )


def reject_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Stories without a title and without an author; here the title is the test."""
    rows = inputs.stories(spark, sf).withColumn("note", F.lit(""))
    usable, missing = jobs.reject_missing(rows, "title", "note")
    return usable.select("id", F.lit("usable").alias("outcome")).unionByName(
        missing.select("id", F.lit("missing").alias("outcome"))
    )


def validate_extractions(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.validate_extractions(
        table(spark, sf, "documents").select(
            "doc_id",
            F.concat(F.lit("\n "), "text", F.lit("\t ")).alias("problem"),
            F.substring_index("text", "\n", -1).alias("solution"),
            F.when(F.col("source") != "src3", F.concat(F.lit("gen-"), "doc_id")).alias(
                "generation_id"
            ),
        )
    )


def parse_model(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses as model strings, words as such without a provider."""
    pages = table(spark, sf, "pages").select(F.col("url").alias("model"))
    names = table(spark, sf, "part").select(F.col("p_name").alias("model"))
    both = pages.unionByName(names)
    return both.select(text.parse_model(F.col("model")).alias("m")).select("m.*")


def prompt_version(spark: SparkSession, sf: str) -> DataFrame:
    fields = [("lang", F.col("lang")), ("source", F.col("source"))]
    name = F.concat(F.lit("doc"), "doc_id")
    version = text.fingerprint(name, F.col("text"), fields)
    return table(spark, sf, "documents").select("doc_id", version.alias("version"))


def generation_preview(spark: SparkSession, sf: str) -> DataFrame:
    return costs.generation_preview(inputs.generations(spark, sf))


def batch_preview(spark: SparkSession, sf: str) -> DataFrame:
    return costs.batch_preview(inputs.batches(spark, sf))


def extraction_preview(spark: SparkSession, sf: str) -> DataFrame:
    return extraction.extraction_preview(inputs.extractions(spark, sf))


def embedding_preview(spark: SparkSession, sf: str) -> DataFrame:
    return extraction.embedding_preview(inputs.extractions(spark, sf))


def latest_generations(spark: SparkSession, sf: str) -> DataFrame:
    return costs.latest_generations(inputs.generations(spark, sf))


def extraction_cost_summary(spark: SparkSession, sf: str) -> DataFrame:
    summary = costs.extraction_cost_summary(inputs.generations(spark, sf))
    return _rounded(summary)


def embedding_cost_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(costs.embedding_cost_summary(inputs.batches(spark, sf)))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *[r6(c).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes]
    )


def preview_rows(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.cleaned(spark, sf).orderBy("publication_number").limit(3)


# Comparison SQL

_TAGS = "[" + ", ".join(f"'{k}'" for k in titles.TECH_KEYWORDS) + "]"
_PHRASES = [p.replace("'", "''") for p in titles.CLICKBAIT_PHRASES]
_SCORE = " + ".join(
    [
        "case when contains(title, '?') then 0.15::double else 0 end",
        "case when regexp_matches(title, '[0-9]') then 0.1::double else 0 end",
        *[
            f"case when contains(lower(title), '{p}') then 0.2::double else 0 end"
            for p in _PHRASES
        ],
        "0.1::double * least(len(list_filter(regexp_split_to_array(title, "
        r"'[^\p{L}\p{N}_]+'), lambda z: regexp_full_match(z, '[A-Z]{4,}'))), 3)",
    ]
)
_ANALYTICS = rf"""analysed as materialized (select *,
    coalesce(len(regexp_extract_all(title, '\S+')), 0)::int word_count,
    coalesce(length(title), 0)::int char_count,
    coalesce(list_filter({_TAGS}, lambda k: contains(lower(title), k)), []) tags,
    case when title is null then 0.0::double else least({_SCORE}, 1.0::double) end
        clickbait_score
    from stories)"""


def _cleaned_sql(column: str) -> str:
    step = column
    for pattern in (r"\n\s*\n+", r"\n\s+", r"\s+\n"):
        step = f"regexp_replace({step}, '{pattern}', chr(10), 'g')"
    return rf"regexp_replace({step}, '^\s+|\s+$', '', 'g')"


_FLAT = (
    "publication_number, application_number, publication_date, grant_date, title, "
    "abstract, array_to_string(assignee, ',') assignee, claims_text"
)
_PROBLEM = f"Instruct: {text.PROBLEM_TASK}"
_SOLUTION = f"Instruct: {text.SOLUTION_TASK}"
_NULLABLE = (
    "publication_number application_number publication_date grant_date title abstract "
    "assignee claims_text"
).split()


_SHOWN = """generation_id, substr(generation_id, 1, 16) || '...' short_id,
    case when coalesce(provider_name, '') = '' then 'Unknown' else provider_name end
        provider,
    coalesce(printf('$%.6f', total_cost), 'N/A') as cost,
    coalesce(tokens_prompt::varchar, 'None') || '+'
        || coalesce(tokens_completion::varchar, 'None') tokens,
    coalesce(printf('%.0fms', round_even(latency, 0)), 'N/A') latency"""


def _short(column: str, limit: int) -> str:
    return (
        f"case when length({column}) > {limit} then substr({column}, 1, {limit}) "
        f"|| '...' else {column} end"
    )


def _avg(expression: str, name: str) -> str:
    return f"{sql_r6(f'coalesce(avg({expression}), 0)')} {name}"


CHECKS = {
    "story_analytics": Check(
        story_analytics,
        with_views(
            """select id, author, title, word_count, char_count, len(tags)::int tech_tag_count,
            clickbait_score, array_to_string(tags, ', ') tech_tags_str from analysed""",
            "stories",
            ctes=_ANALYTICS,
        ),
    ),
    "story_preview": Check(
        story_preview,
        with_views(
            """select id, case when length(title) > 50 then substr(title, 1, 50) || '...'
            else title end title, word_count, printf('%.2f', clickbait_score) clickbait,
            case when len(tags) = 0 then 'none' else array_to_string(tags, ', ') end tags
            from analysed order by id limit 3""",
            "stories",
            ctes=_ANALYTICS,
        ),
    ),
    "story_summary": Check(
        story_summary,
        with_views(
            f"""select count(*) num_stories, {sql_r6('avg(word_count)')} avg_word_count,
            {sql_r6('avg(clickbait_score)')} avg_clickbait_score from analysed""",
            "stories",
            ctes=_ANALYTICS,
        ),
    ),
    "top_tags": Check(
        top_tags,
        with_views(
            """select tag, count(*) stories from (select unnest(tags) tag from analysed)
            group by tag order by stories desc, tag limit 5""",
            "stories",
            ctes=_ANALYTICS,
        ),
    ),
    "stamp_fetched_at": Check(stamp_fetched_at),
    "newest_publications": Check(
        newest_publications,
        with_views(
            f"""select {_FLAT} from publications where country_code = 'US'
            order by publication_date desc, publication_number limit 100""",
            "publications",
        ),
    ),
    "clean_publications": Check(
        clean_publications,
        with_views(
            f"""select publication_number, application_number, publication_date,
            grant_date, title title_text, {_cleaned_sql('abstract')} abstract_text,
            array_to_string(assignee, ',') assignee,
            {_cleaned_sql('claims_text')} claims_text from publications""",
            "publications",
        ),
    ),
    "null_profile": Check(
        null_profile,
        with_views(
            f"""select * from ({' union all '.join(
                f"select '{c}' as column, count(*) - count({c}) nulls from publications"
                for c in _NULLABLE)}) where nulls > 0""",
            "publications",
        ),
    ),
    "claims_coverage": Check(
        claims_coverage,
        with_views(
            f"""select count(*) num_records, count(claims_text) num_present,
            {sql_r6('count(claims_text) * 100.0::double / count(*)')} coverage_pct
            from publications""",
            "publications",
        ),
    ),
    "date_range": Check(
        date_range,
        with_views(
            "select min(publication_date) oldest, max(publication_date) newest "
            "from publications",
            "publications",
        ),
    ),
    "model_inputs": Check(
        model_inputs,
        with_views(
            f"""select publication_number, coalesce(title_text, '') title_input,
            coalesce(abstract_text, '') abstract_input,
            '{_PROBLEM}' || chr(10) || 'Query: ' || problem problem_input,
            '{_SOLUTION}' || chr(10) || 'Query: ' || solution solution_input
            from extractions""",
            "extractions",
        ),
    ),
    "truncated_inputs": Check(
        truncated_inputs,
        with_views(
            f"""select publication_number,
            substr(coalesce(title_text, ''), 1, 200) title_input,
            substr(coalesce(abstract_text, ''), 1, 1000) abstract_input,
            '{_PROBLEM}' || chr(10) || 'Query: ' || substr(problem, 1, 8000)
                problem_input,
            '{_SOLUTION}' || chr(10) || 'Query: ' || substr(solution, 1, 8000)
                solution_input
            from extractions""",
            "extractions",
        ),
    ),
    "reject_missing": Check(
        reject_missing,
        with_views(
            "select id, case when coalesce(title, '') = '' then 'missing' else 'usable' "
            "end outcome from stories",
            "stories",
        ),
    ),
    "validate_extractions": Check(
        validate_extractions,
        r"""select *, case when generation_id is null then 'no generation id'
            when length(problem) < 10 or length(solution) < 10 then 'too short' end reason
        from (select doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') problem,
            regexp_replace(split_part(text, chr(10), -1), '^\s+|\s+$', '', 'g') solution,
            case when source <> 'src3' then concat('gen-', doc_id) end generation_id
            from documents)""",
    ),
    "parse_model": Check(
        parse_model,
        """select case when contains(model, '/') then split_part(model, '/', 1)
            else 'unknown' end provider,
            case when contains(model, '/') then substr(model, instr(model, '/') + 1)
            else model end model_name, model full_string
        from (select url model from pages union all select p_name from part)""",
    ),
    "prompt_version": Check(
        prompt_version,
        """select doc_id, 'v_' || substr(sha256(concat_ws('|', 'doc' || doc_id, text,
            'lang:' || lang, 'source:' || source)), 1, 10) as version from documents""",
    ),
    "generation_preview": Check(
        generation_preview,
        with_views(f"select {_SHOWN} from generations", "generations"),
    ),
    "batch_preview": Check(
        batch_preview,
        with_views(
            f"select {_SHOWN}, patents_in_batch, embeddings_in_batch from batches",
            "batches",
        ),
    ),
    "extraction_preview": Check(
        extraction_preview,
        with_views(
            f"""select publication_number, {_short('generation_id', 16)} generation_id,
            {_short('problem', 100)} problem, {_short('solution', 100)} solution
            from extractions order by publication_number limit 3""",
            "extractions",
        ),
    ),
    "embedding_preview": Check(
        embedding_preview,
        with_views(
            """select publication_number, len(problem_embedding)::int problem_dim,
            coalesce(len(solution_embedding), 0)::int solution_dim,
            substr(embedding_generation_id, 1, 20) || '...' generation_id
            from extractions where problem_embedding is not null
            order by publication_number limit 3""",
            "extractions",
        ),
    ),
    "latest_generations": Check(
        latest_generations,
        with_views(
            "select * from generations order by fetched_at desc, generation_id limit 5",
            "generations",
        ),
    ),
    "extraction_cost_summary": Check(
        extraction_cost_summary,
        with_views(
            f"""select count(*) total_generations,
            {sql_r6('coalesce(sum(total_cost), 0)')} total_cost_usd,
            {_avg('total_cost', 'avg_cost_per_generation')},
            {_avg('tokens_prompt', 'avg_prompt_tokens')},
            {_avg('tokens_completion', 'avg_completion_tokens')},
            {_avg('latency', 'avg_latency_ms')} from generations""",
            "generations",
        ),
    ),
    "embedding_cost_summary": Check(
        embedding_cost_summary,
        with_views(
            f"""select count(*) total_generations,
            sum(patents_in_batch)::bigint total_patents_embedded,
            sum(embeddings_in_batch)::bigint total_embeddings_generated,
            {sql_r6('coalesce(sum(total_cost), 0)')} total_cost_usd,
            {_avg('total_cost', 'avg_cost_per_generation')},
            {_avg('total_cost / nullif(patents_in_batch, 0)', 'avg_cost_per_patent')},
            {_avg('total_cost / nullif(embeddings_in_batch, 0)',
                  'avg_cost_per_embedding')},
            {_avg('tokens_prompt', 'avg_prompt_tokens')},
            {_avg('tokens_completion', 'avg_completion_tokens')},
            {_avg('latency', 'avg_latency_ms')},
            {_avg('patents_in_batch', 'avg_patents_per_batch')},
            {_avg('embeddings_in_batch', 'avg_embeddings_per_batch')} from batches""",
            "batches",
        ),
    ),
    "preview_rows": Check(
        preview_rows,
        with_views(
            "select * from cleaned order by publication_number limit 3", "cleaned"
        ),
    ),
}
