"""Input views the jobs read, derived from the whole given tables.

Every view exists twice: as a Spark frame and as an SQL text in ``SQL``, from which
``with_views`` makes the WITH clause of a comparison query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgraph.sources.scratch import TEXT_CODEC, materialize

_BREAK = ". \n \n\n  "


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _country(lang: Column) -> Column:
    known = {"en": "US", "de": "DE", "fr": "FR"}
    value = F.lit("ES")
    for code, country in known.items():
        value = F.when(lang == code, country).otherwise(value)
    return value


def _number() -> Column:
    return F.concat(_country(F.col("lang")), F.lit("-"), F.col("doc_id"))


def _heading() -> Column:
    return F.substring_index("text", "\n", 1)


def _last_line() -> Column:
    return F.substring_index("text", "\n", -1)


def stories(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts as titles, with endings that set off the scores."""
    endings = {
        1: " ?",
        2: " 10 secret tricks revealed",
        3: " you won't believe this SHOCKING TRUTH",
        4: " Rust and Python on AWS",
        5: " NASA ABCD WXYZ QRST",
        6: " the truth about OpenAI",
    }
    ending = F.lit("")
    for rest, words in endings.items():
        ending = F.when(F.col("doc_id") % 8 == rest, words).otherwise(ending)
    title = F.when(F.col("doc_id") % 97 != 5, F.concat("text", ending))
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.col("source").alias("author"), title.alias("title")
    )


def publications(spark: SparkSession, sf: str) -> DataFrame:
    """Nested source records with whole texts as abstracts."""

    def localized(text: Column, language: Column) -> Column:
        return F.struct(text.alias("text"), language.alias("language"))

    doc, lang = F.col("doc_id"), F.col("lang")
    german, english = F.lit("de"), F.lit("en")
    titles = F.array(localized(_heading(), lang))
    abstract = F.concat(
        F.lit("  "), F.replace("text", F.lit(". "), F.lit(_BREAK)), F.lit("\t")
    )
    claim = F.concat("text", F.lit("\n\n"))
    return table(spark, sf, "documents").select(
        _country(lang).alias("country_code"),
        _number().alias("publication_number"),
        F.concat(F.lit("APP-"), doc).alias("application_number"),
        (20240101 + doc % 28).cast("int").alias("publication_date"),
        F.when(doc % 4 != 0, (20240201 + doc % 28).cast("int")).alias("grant_date"),
        F.when(doc % 50 == 7, F.filter(titles, lambda t: F.lit(False)))
        .otherwise(titles)
        .alias("title_localized"),
        F.array(localized(abstract, lang)).alias("abstract_localized"),
        F.when(doc % 5 == 2, F.array(localized(F.col("text"), german)))
        .otherwise(F.array(localized(F.lit("x"), german), localized(claim, english)))
        .alias("claims_localized"),
        F.array(F.concat(F.lit("org"), doc % 17)).alias("assignee"),
    )


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """Publications as the extraction reads them."""
    return table(spark, sf, "documents").select(
        _number().alias("publication_number"),
        _heading().alias("title_text"),
        F.col("text").alias("abstract_text"),
    )


def extractions(spark: SparkSession, sf: str) -> DataFrame:
    """Extractions of all documents, labelled or not; vectors are taken in turn, and some
    rows lack one or both."""
    embeddings = table(spark, sf, "embeddings")
    number = F.lit(embeddings.count())
    vector = F.col("embedding").cast("array<double>")
    problem = embeddings.select(
        F.col("vec_id").alias("p_id"), vector.alias("problem_embedding"), "label"
    )
    solution = embeddings.select(
        F.col("vec_id").alias("s_id"), vector.alias("solution_embedding")
    )
    labels = table(spark, sf, "labels")
    documents = table(spark, sf, "documents").join(labels, "doc_id", "left")
    numbered = documents.withColumns(
        {
            "p_id": F.when(F.col("doc_id") % 7 != 3, F.col("doc_id") % number),
            "s_id": F.when(F.col("doc_id") % 11 != 2, F.col("n_chars") % number),
        }
    )
    return (
        numbered.join(problem, "p_id", "left")
        .join(solution, "s_id", "left")
        .select(
            _number().alias("publication_number"),
            _heading().alias("title_text"),
            F.col("text").alias("abstract_text"),
            F.when(F.col("quality") == 1, "m1").otherwise("m2").alias("model_name"),
            F.lit("maker").alias("model_provider"),
            F.when(F.col("toxic") == 1, "v_b").otherwise("v_a").alias("prompt_version"),
            F.concat(F.lit("gen-"), "doc_id").alias("generation_id"),
            F.col("text").alias("problem"),
            _last_line().alias("solution"),
            "problem_embedding",
            "solution_embedding",
            F.concat(F.lit("emb-"), "label").alias("embedding_generation_id"),
        )
    )


def _metered(events: DataFrame) -> DataFrame:
    tokens = F.get_json_object("props", "$.k").cast("int")
    provider = F.when(F.col("event_type") == "view", "").when(
        F.col("event_type") != "signup", F.col("event_type")
    )
    return events.withColumns(
        {
            "provider_name": provider,
            "total_cost": F.col("value") / 1000,
            "tokens_prompt": tokens,
            "tokens_completion": tokens % 17,
            "latency": F.col("value") * 10,
            "fetched_at": F.col("ts"),
        }
    )


_METERED = (
    "provider_name",
    "total_cost",
    "tokens_prompt",
    "tokens_completion",
    "latency",
    "fetched_at",
)


def generations(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata of model calls, one per event; that of errors was not found."""
    key = F.concat(F.lit("gen-"), "event_id").alias("generation_id")
    known = [F.when(F.col("event_type") != "error", F.col(c)).alias(c) for c in _METERED]
    return _metered(table(spark, sf, "events")).select(key, *known)


def batches(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata of batched calls, some with an empty batch."""
    size = (F.col("user_id") % 11).cast("int")
    key = F.concat(F.lit("emb-"), "event_id").alias("generation_id")
    return _metered(table(spark, sf, "events")).select(
        key,
        size.alias("patents_in_batch"),
        (size * 2).alias("embeddings_in_batch"),
        *_METERED,
    )


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Four relatives per embedding u and its partner v: u, u + 0.4 v, u + 1.2 v and a
    copy of u. They fall into every similarity band."""
    return spark.sql(
        """
        with paired as (
            select vec_id, embedding,
                (vec_id + (select count(*) from {embeddings}) div 2)
                    % (select count(*) from {embeddings}) as partner
            from {embeddings})
        select p.vec_id * 4 + f.place as id,
            zip_with(cast(p.embedding as array<double>),
                cast(m.embedding as array<double>), (x, y) -> x + f.weight * y) as emb
        from paired p join {embeddings} m on m.vec_id = p.partner
        lateral view inline(array(struct(0, 0.0D), struct(1, 0.4D), struct(2, 1.2D),
            struct(3, 0.0D))) f as place, weight
        """,
        embeddings=table(spark, sf, "embeddings"),
    )


def patents(spark: SparkSession, sf: str) -> DataFrame:
    """Embedded extractions, stored as a table: the vectors forwards as problems,
    backwards as solutions, with the texts of all documents. Documents are dealt to the
    vectors in turn; fewer documents than vectors are dealt again."""
    found = vectors(spark, sf)
    number = table(spark, sf, "embeddings").count() * 4
    backwards = found.select(
        (F.lit(number - 1) - F.col("id")).alias("id"),
        F.col("emb").alias("solution_embedding"),
    )
    documents = table(spark, sf, "documents")
    slots = min(number, documents.count())
    # One or a few texts each: the ratio of the two tables.
    dealt = F.array_sort(F.collect_list(F.struct("doc_id", "text")))
    texts = documents.groupBy((F.col("doc_id") % number).alias("slot")).agg(
        F.array_join(dealt["text"], "\n").alias("text")
    )
    joined = (
        found.withColumnRenamed("emb", "problem_embedding")
        .join(backwards, "id")
        .withColumn("slot", F.col("id") % slots)
        .join(texts, "slot", "left")
        .select(
            patent_number(F.col("id")).alias("publication_number"),
            "text",
            "problem_embedding",
            "solution_embedding",
        )
    )
    # A text is stored once; its other columns are made when they are read.
    return materialize(joined, "patents", compression=TEXT_CODEC).select(
        "publication_number",
        _heading().alias("title_text"),
        F.col("text").alias("abstract_text"),
        F.col("text").alias("problem"),
        _last_line().alias("solution"),
        "problem_embedding",
        "solution_embedding",
    )


def patent_number(number: Column) -> Column:
    return F.concat(F.lit("P"), F.lpad(number.cast("string"), 9, "0"))


_COUNTRY_SQL = (
    "case lang when 'en' then 'US' when 'de' then 'DE' when 'fr' then 'FR' else 'ES' end"
)
_NUMBER_SQL = f"concat({_COUNTRY_SQL}, '-', doc_id)"
_METERED_SQL = """
    case event_type when 'view' then '' when 'signup' then null else event_type end
        provider_name,
    value / 1000 total_cost, json_extract(props, '$.k')::int tokens_prompt,
    json_extract(props, '$.k')::int % 17 tokens_completion, value * 10 latency,
    ts fetched_at"""

# The views in an order in which each only uses earlier ones.
SQL = {
    "stories": """
        select doc_id id, source author, case when doc_id % 97 = 5 then null
            else text || case doc_id % 8 when 1 then ' ?'
            when 2 then ' 10 secret tricks revealed'
            when 3 then ' you won''t believe this SHOCKING TRUTH'
            when 4 then ' Rust and Python on AWS' when 5 then ' NASA ABCD WXYZ QRST'
            when 6 then ' the truth about OpenAI' else '' end end title
        from documents""",
    "publications": f"""
        select {_COUNTRY_SQL} country_code, {_NUMBER_SQL} publication_number,
            concat('APP-', doc_id) application_number,
            (20240101 + doc_id % 28)::int publication_date,
            case when doc_id % 4 = 0 then null else (20240201 + doc_id % 28)::int end
                grant_date,
            case when doc_id % 50 = 7 then null else split_part(text, chr(10), 1) end
                title,
            concat('  ', replace(text, '. ', concat('. ', chr(10), ' ', chr(10), chr(10),
                '  ')), chr(9)) abstract,
            [concat('org', doc_id % 17)] assignee,
            case when doc_id % 5 = 2 then null else concat(text, chr(10), chr(10)) end
                claims_text
        from documents""",
    "cleaned": f"""
        select {_NUMBER_SQL} publication_number, split_part(text, chr(10), 1) title_text,
            text abstract_text
        from documents""",
    "extractions": f"""
        select {_NUMBER_SQL} publication_number, split_part(text, chr(10), 1) title_text,
            text abstract_text,
            case when quality = 1 then 'm1' else 'm2' end model_name,
            'maker' model_provider,
            case when toxic = 1 then 'v_b' else 'v_a' end prompt_version,
            concat('gen-', doc_id) generation_id, text problem,
            split_part(text, chr(10), -1) solution,
            p.embedding problem_embedding, s.embedding solution_embedding,
            'emb-' || p.label embedding_generation_id
        from (select *, (select count(*) from embeddings) number from documents)
        left join labels using (doc_id)
        left join embeddings p on doc_id % 7 <> 3 and p.vec_id = doc_id % number
        left join embeddings s on doc_id % 11 <> 2 and s.vec_id = n_chars % number""",
    "generations": f"""
        select concat('gen-', event_id) generation_id, {_METERED_SQL}
        from events where event_type <> 'error'
        union all select concat('gen-', event_id), null, null, null, null, null, null
        from events where event_type = 'error'""",
    "batches": f"""
        select concat('emb-', event_id) generation_id, (user_id % 11)::int
            patents_in_batch, (user_id % 11 * 2)::int embeddings_in_batch, {_METERED_SQL}
        from events""",
    "vectors": """
        select e.vec_id * 4 + place id, list_transform(list_zip(e.embedding::double[],
            m.embedding::double[]), lambda z: z[1] + weight * z[2]) emb
        from embeddings e join embeddings m on m.vec_id = (e.vec_id
            + (select count(*) from embeddings) // 2) % (select count(*) from embeddings),
        (values (0, 0.0::double), (1, 0.4::double), (2, 1.2::double), (3, 0.0::double))
            f(place, weight)""",
    "units": """
        select id, list_transform(emb, lambda x: x / norm) unit
        from (select id, emb, sqrt(list_dot_product(emb, emb)) norm from vectors)""",
    "patents": """
        select 'P' || lpad(v.id::varchar, 9, '0') publication_number, v.id,
            split_part(text, chr(10), 1) title_text, text abstract_text, text problem,
            split_part(text, chr(10), -1) solution
        from vectors v left join (
            select doc_id % (select count(*) from vectors) slot,
                string_agg(text, chr(10) order by doc_id) as text
            from documents group by 1) d
        on d.slot = v.id % least((select count(*) from vectors),
            (select count(*) from documents))""",
    "pairs": """
        select a.id i, b.id j, round(array_inner_product(a.unit::double[64],
            b.unit::double[64]), 9) s
        from units a join units b on a.id < b.id
        where round(array_inner_product(a.unit::double[64], b.unit::double[64]), 9)
            >= 0.6""",
    "backwards": """
        select last - j i, last - i j, s
        from pairs, (select max(id) last from units)""",
    "firsts": """
        select id, min(id) over (partition by emb) as first from vectors""",
    "backfirsts": """
        select last - id id, min(last - id) over (partition by emb) as first
        from vectors, (select max(id) last from vectors)""",
}

_USES = {
    "units": ["vectors"],
    "patents": ["vectors"],
    "pairs": ["vectors", "units"],
    "backwards": ["vectors", "units", "pairs"],
    "firsts": ["vectors"],
    "backfirsts": ["vectors"],
}


def with_views(query: str, *views: str, ctes: str = "", recursive: bool = False) -> str:
    """``query`` after a WITH clause of the named views and any further ``ctes``."""
    needed = {u for view in views for u in [view, *_USES.get(view, [])]}
    parts = [f"{n} as materialized ({SQL[n]})" for n in SQL if n in needed]
    if ctes:
        parts.append(ctes)
    return f"with {'recursive ' if recursive else ''}{', '.join(parts)} {query}"
