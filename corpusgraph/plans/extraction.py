"""Resumable runs of model-backed jobs against lake tables.

A run writes down its rows first and then asks chunk by chunk; the answers to a chunk are
committed before the next one begins. A run that was stopped goes on when it is called
again: it takes the rows that were written down and skips the finished chunks, so no
answer is asked for twice but those of the chunk that was under way.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusgraph.functions import display
from corpusgraph.operators import jobs
from corpusgraph.operators.incremental import (
    lacking_any,
    matching,
    pending,
    pending_groups,
)
from corpusgraph.operators.sampling import top_n
from corpusgraph.sources import files
from corpusgraph.sources.lake import Lake

KEY = "publication_number"

# Columns of the stored tables, and rows and lengths of previews.
PREVIEW_ROWS = 3
PREVIEW_TEXT = 100
PREVIEW_ID = 16
PREVIEW_BATCH_ID = 20
EXTRACTIONS = T.StructType(
    [
        T.StructField(KEY, T.StringType(), False),
        T.StructField("title_text", T.StringType()),
        T.StructField("abstract_text", T.StringType()),
        T.StructField("model_name", T.StringType(), False),
        T.StructField("model_provider", T.StringType(), False),
        T.StructField("prompt_version", T.StringType(), False),
        T.StructField("generation_id", T.StringType(), False),
        T.StructField("problem", T.StringType(), False),
        T.StructField("solution", T.StringType(), False),
        T.StructField("problem_embedding", T.ArrayType(T.DoubleType())),
        T.StructField("solution_embedding", T.ArrayType(T.DoubleType())),
        T.StructField("embedding_generation_id", T.StringType()),
        T.StructField("extraction_timestamp", T.TimestampType()),
        T.StructField("processing_time_ms", T.IntegerType()),
    ]
)


def _metadata_schema(*leading: T.StructField) -> T.StructType:
    key = T.StructField("generation_id", T.StringType(), False)
    fetched = T.StructField("fetched_at", T.TimestampType())
    return T.StructType([key, *leading, *jobs.GENERATION_FIELDS, fetched])


EXTRACTION_GENERATIONS = _metadata_schema(T.StructField(KEY, T.StringType()))
EMBEDDING_GENERATIONS = _metadata_schema(
    T.StructField("patents_in_batch", T.IntegerType()),
    T.StructField("embeddings_in_batch", T.IntegerType()),
)


@dataclass(frozen=True)
class RunReport:
    """What a run found and did."""

    selected: int
    succeeded: int

    @property
    def failed(self) -> int:
        return self.selected - self.succeeded

    @property
    def success_rate_pct(self) -> float:
        return self.succeeded / self.selected * 100 if self.selected else 0.0


def _spread(df: DataFrame, concurrency: int | None) -> DataFrame:
    """Bound the number of model calls at a time."""
    return df.repartition(concurrency) if concurrency else df


# Rows of a chunk, and the most chunks of a run.
CHUNK_ROWS = 100_000
MAX_CHUNKS = 1_000
VERSION = ["model_name", "prompt_version"]
_CHUNK = "_chunk"


@dataclass(frozen=True)
class _Run:
    """The folder of a run, named after what it is to do."""

    lake: Lake
    folder: str

    @classmethod
    def of(cls, lake: Lake, *about: object) -> _Run:
        name = hashlib.md5(repr(about).encode()).hexdigest()
        return cls(lake, f"{lake.location}/_runs/{name}")

    def answers(
        self,
        todo: DataFrame,
        keys: list[str],
        ask: Callable[[DataFrame], DataFrame],
        chunk_rows: int,
    ) -> DataFrame:
        """The answers to all rows, from earlier calls of the same run where there are any.

        Chunks are cut by a hash of the keys and stored in folders of their own, so they are
        the same in every call, and each reads its own rows alone.
        """
        spark, rows = self.lake.spark, f"{self.folder}/chunks"
        if not files.finished(spark, rows):
            cut = self._cut(todo, keys, chunk_rows).write.partitionBy(_CHUNK)
            cut.mode("overwrite").option("partitionOverwriteMode", "static").parquet(rows)
        kinds = T.StructType([*todo.schema, T.StructField(_CHUNK, T.IntegerType())])
        fixed = spark.read.schema(kinds).parquet(rows)
        # At most MAX_CHUNKS numbers.
        chunks = sorted(r[0] for r in fixed.select(_CHUNK).distinct().collect()) or [0]
        paths = [f"{self.folder}/answers-{k}" for k in chunks]
        for k, path in zip(chunks, paths, strict=True):
            if not files.finished(spark, path):
                chunk = fixed.where(F.col(_CHUNK) == k).drop(_CHUNK)
                ask(chunk).write.mode("overwrite").parquet(path)
        return spark.read.parquet(*paths)

    def _cut(self, todo: DataFrame, keys: list[str], chunk_rows: int) -> DataFrame:
        """The rows with their chunk, each chunk in about as many tasks as there are cores."""
        chunks = max(1, min(MAX_CHUNKS, math.ceil(todo.count() / chunk_rows)))
        cores = self.lake.spark.sparkContext.defaultParallelism
        place = F.pmod(F.xxhash64(*keys), F.lit(chunks)).cast("int")
        numbered = todo.withColumn(_CHUNK, place)
        if chunks == 1:
            return numbered
        # By all columns, as many rows may have one key or none.
        share = F.pmod(F.xxhash64(*todo.columns, F.lit("share")), F.lit(cores))
        return numbered.repartition(min(chunks, 16) * cores, _CHUNK, share)

    def close(self) -> None:
        files.delete_folder(self.lake.spark, self.folder)


def run_extraction(
    lake: Lake,
    source: str,
    table: str,
    extractor: jobs.Extractor,
    model: tuple[str, str],
    prompt_version: str,
    limit: int | None = None,
    concurrency: int | None = None,
    title_limit: int | None = None,
    abstract_limit: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> RunReport:
    """Extract from the publications that this model and prompt have not done yet.

    ``model`` is (provider, name). Rejected rows are not stored, so that the next run
    tries them again.
    """
    provider, name = model
    lake.ensure_table(table, EXTRACTIONS)
    version = {"model_name": name, "prompt_version": prompt_version}
    todo = pending(
        lake.read(source).select(KEY, "title_text", "abstract_text"),
        lake.read(table),
        KEY,
        constants=version,
        limit=limit,
    )

    def ask(rows: DataFrame) -> DataFrame:
        return jobs.extract_pairs(
            _spread(rows, concurrency), extractor, title_limit, abstract_limit
        )

    run = _Run.of(lake, "extract", table, source, model, prompt_version, limit)
    asked = run.answers(todo, [KEY], ask, chunk_rows)
    good = asked.where(F.col("reason").isNull()).withColumns(
        {
            "model_name": F.lit(name),
            "model_provider": F.lit(provider),
            "prompt_version": F.lit(prompt_version),
            "extraction_timestamp": F.current_timestamp(),
        }
    )
    # What a stopped call had appended already is not appended again.
    report = RunReport(asked.count(), good.count())
    lake.append(pending(good, lake.read(table), KEY, constants=version), table)
    run.close()
    return report


def processed_count(
    extractions: DataFrame, model_name: str, prompt_version: str
) -> DataFrame:
    """Rows already extracted with a model and prompt."""
    version = {"model_name": model_name, "prompt_version": prompt_version}
    return matching(extractions, version).agg(F.count(F.lit(1)).alias("processed"))


def run_embedding(
    lake: Lake,
    table: str,
    embedder: jobs.Embedder,
    batch: int = jobs.EMBED_BATCH,
    dim: int = jobs.EMBEDDING_DIM,
    limit: int | None = None,
    concurrency: int | None = None,
    text_limit: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> RunReport:
    """Fill the vectors of all rows that lack one; a row is a publication with a model and
    a prompt version, and a table that has one twice is refused before any call."""
    columns = ["problem_embedding", "solution_embedding"]
    keys = [KEY, *VERSION]
    lacking = lacking_any(lake.read(table), columns).select(*keys, "problem", "solution")
    twice = lacking.groupBy(*keys).count().where("count > 1").first()
    if twice:
        raise ValueError(f"{table} has {twice[KEY]!r} twice for one model and prompt version")
    todo = top_n(lacking, KEY, limit) if limit else lacking

    def ask(rows: DataFrame) -> DataFrame:
        return jobs.embed_pairs(rows, embedder, keys, batch, dim, text_limit, concurrency)

    run = _Run.of(lake, "embed", table, batch, dim, limit, text_limit)
    asked = run.answers(todo, keys, ask, chunk_rows)
    good = asked.where(F.col("reason").isNull())
    report = RunReport(asked.count(), good.count())
    lake.update_by_key(table, good, keys, [*columns, "embedding_generation_id"])
    run.close()
    return report


def extraction_preview(extractions: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """The first extractions by key, in display form."""
    return extractions.orderBy(KEY).limit(n).select(
        KEY,
        display.shorten(F.col("generation_id"), PREVIEW_ID).alias("generation_id"),
        display.shorten(F.col("problem"), PREVIEW_TEXT).alias("problem"),
        display.shorten(F.col("solution"), PREVIEW_TEXT).alias("solution"),
    )


def embedding_preview(extractions: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """Dimensions of the first embedded rows by key; 0 for a missing vector."""
    embedded = extractions.where(F.col("problem_embedding").isNotNull())
    short_id = F.substring("embedding_generation_id", 1, PREVIEW_BATCH_ID)

    def dimension(column: str):
        size = F.when(F.col(column).isNotNull(), F.size(column)).otherwise(0)
        return size.alias(column.replace("embedding", "dim"))

    return embedded.orderBy(KEY).limit(n).select(
        KEY,
        dimension("problem_embedding"),
        dimension("solution_embedding"),
        F.concat(short_id, F.lit("...")).alias("generation_id"),
    )


def unfetched_generations(extractions: DataFrame, fetched: DataFrame) -> DataFrame:
    """Generation ids of extractions without metadata; repeated ids are kept."""
    return pending(extractions.select("generation_id", KEY), fetched, "generation_id")


def unfetched_batches(extractions: DataFrame, fetched: DataFrame) -> DataFrame:
    """Embedding generation ids without metadata, with their batch sizes."""
    groups = pending_groups(
        extractions, fetched, "embedding_generation_id", "generation_id"
    )
    return groups.select(
        "generation_id",
        F.col("rows").alias("patents_in_batch"),
        F.col("items").alias("embeddings_in_batch"),
    )


def run_fetch(
    lake: Lake,
    todo: DataFrame,
    table: str,
    schema: T.StructType,
    fetcher: jobs.Fetcher,
    concurrency: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> RunReport:
    """Fetch metadata of the given generation ids and store what was found."""
    lake.ensure_table(table, schema)

    def ask(rows: DataFrame) -> DataFrame:
        return jobs.fetch_generations(_spread(rows, concurrency), fetcher)

    run = _Run.of(lake, "fetch", table)
    asked = run.answers(todo, ["generation_id"], ask, chunk_rows)
    good = asked.where("found").withColumn("fetched_at", F.current_timestamp())
    report = RunReport(asked.count(), good.count())
    lake.append(pending(good, lake.read(table), "generation_id"), table)
    run.close()
    return report
