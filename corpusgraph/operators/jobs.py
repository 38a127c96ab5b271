"""Jobs that call a user's model for each row or batch.

The caller brings the model as a plain function. Spark selects the work, forms the
batches inside each partition, validates the answers and keeps rejects apart. A task
that is retried calls the model again, so nothing is stored before a whole run is
done; what failed is not stored and is picked up by the next run.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusgraph.functions import text
from corpusgraph.functions.vectors import has_dimension
from corpusgraph.operators.incremental import lacking_any
from corpusgraph.operators.sampling import in_batches

# Input limits that a caller may ask for, shortest accepted answer, rows
# per embedding call, and the dimension of the embedding model.
TITLE_LIMIT = 200
ABSTRACT_LIMIT = 1000
EMBED_LIMIT = 8000
MIN_ANSWER = 10
EMBED_BATCH = 10
EMBEDDING_DIM = 4096
# Answers of small batches leave a task together, up to so many elements of vectors.
YIELDED_ELEMENTS = 1 << 16

Answer = dict[str, Any] | None
Extractor = Callable[[str, str], Answer]
Embedder = Callable[[list[str]], Sequence[Sequence[float]]]
Fetcher = Callable[[str], Answer]

# The fields kept of a generation's metadata.
GENERATION_FIELDS = (
    T.StructField("provider_name", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("total_cost", T.DoubleType()),
    T.StructField("cache_discount", T.DoubleType()),
    T.StructField("upstream_inference_cost", T.DoubleType()),
    T.StructField("tokens_prompt", T.IntegerType()),
    T.StructField("tokens_completion", T.IntegerType()),
    T.StructField("native_tokens_prompt", T.IntegerType()),
    T.StructField("native_tokens_completion", T.IntegerType()),
    T.StructField("native_tokens_cached", T.IntegerType()),
    T.StructField("latency", T.DoubleType()),
    T.StructField("generation_time", T.DoubleType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("finish_reason", T.StringType()),
    T.StructField("streamed", T.BooleanType()),
)


# Extraction


def all_missing(*columns: str) -> Column:
    """True where every one of the texts is NULL or empty."""
    return F.forall(
        F.array(*[text.is_missing(F.col(c)) for c in columns]), lambda missing: missing
    )


def reject_missing(df: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    """Rows with at least one text, and the rows where all are NULL or empty."""
    missing = all_missing(*columns)
    return df.where(~missing), df.where(missing)


def rejection(problem: Column, solution: Column, generation_id: Column) -> Column:
    """Why an answer is refused; NULL when it is accepted. Texts are stripped."""
    long_enough = [
        F.length(F.coalesce(c, F.lit(""))) >= MIN_ANSWER for c in (problem, solution)
    ]
    return (
        F.when(text.is_missing(generation_id), F.lit("no generation id"))
        .when(~(long_enough[0] & long_enough[1]), F.lit("too short"))
        .otherwise(F.lit(None).cast("string"))
    )


def validate_extractions(df: DataFrame) -> DataFrame:
    """Strip the answers and add ``reason``, NULL for accepted rows."""
    problem, solution = (text.strip(F.col(c)) for c in ("problem", "solution"))
    stripped = df.withColumns({"problem": problem, "solution": solution})
    return stripped.withColumn(
        "reason",
        rejection(F.col("problem"), F.col("solution"), F.col("generation_id")),
    )


def extract_pairs(
    df: DataFrame,
    extractor: Extractor,
    title_limit: int | None = None,
    abstract_limit: int | None = None,
) -> DataFrame:
    """Ask for problem and solution of each title and abstract, whole without limits.

    The result has the input's columns plus ``problem``, ``solution``,
    ``generation_id``, ``processing_time_ms`` and ``reason``. Rows without any text
    are not asked about; a failing call rejects its row.
    """
    inputs = df.withColumns(
        {
            "_missing": all_missing("title_text", "abstract_text"),
            "_title": text.truncate(F.col("title_text"), title_limit),
            "_abstract": text.truncate(F.col("abstract_text"), abstract_limit),
        }
    )
    given = df.columns
    names = ["problem", "solution", "generation_id", "processing_time_ms", "_error"]

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                _answer(extractor, title, abstract) if not missing else _NO_INPUT
                for missing, title, abstract in zip(
                    batch["_missing"], batch["_title"], batch["_abstract"]
                )
            ]
            extra = pd.DataFrame(found, columns=names, index=batch.index, dtype=object)
            yield pd.concat([batch[given], extra], axis=1)

    answers = "problem string, solution string, generation_id string"
    timing = "processing_time_ms int, _error string"
    asked = inputs.mapInPandas(ask, f"{_ddl(df.schema)}, {answers}, {timing}")
    checked = validate_extractions(asked)
    reason = F.coalesce("_error", "reason")
    return checked.withColumn("reason", reason).drop("_error")


# Stands for the answer of a row that has nothing to ask about.
_NO_INPUT = (None, None, None, None, "no input")


def _ddl(fields: Iterable[T.StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def _answer(extractor: Extractor, title: str, abstract: str) -> tuple:
    start = time.monotonic()
    try:
        answer = extractor(title, abstract) or {}
        error = None
    except Exception as problem:
        answer, error = {}, f"failed: {problem}"
    elapsed = int((time.monotonic() - start) * 1000)
    fields = (answer.get(n) for n in ("problem", "solution", "generation_id"))
    return (*fields, elapsed, error)


# Embedding


def model_inputs(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Add the instruction texts of problem and solution, whole without a limit."""

    def query(task: str, column: str) -> Column:
        return text.instruct(task, text.truncate(F.col(column), limit))

    return df.withColumns(
        {
            "problem_input": query(text.PROBLEM_TASK, "problem"),
            "solution_input": query(text.SOLUTION_TASK, "solution"),
        }
    )


def interleave(df: DataFrame, key: str, first: str, second: str) -> DataFrame:
    """Two texts per row as two rows ``(key, side, text)``, side 0 before side 1."""
    return df.select(key, F.posexplode(F.array(first, second)).alias("side", "text"))


def deinterleave(df: DataFrame, key: str, value: str) -> DataFrame:
    """Back to one row per key that has both sides: ``(key, first, second)``."""
    sides = [F.max(F.when(F.col("side") == s, F.col(value))) for s in (0, 1)]
    paired = df.groupBy(key).agg(
        sides[0].alias("first"),
        sides[1].alias("second"),
        F.count(F.lit(1)).alias("_n"),
    )
    return paired.where(F.col("_n") == 2).drop("_n")


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _label(keys: Sequence[str]) -> Column:
    return F.concat_ws("\x1f", *[F.col(k).cast("string") for k in keys])


def _in_named_batches(df: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """Add ``batch``, consecutive rows by key, and ``batch_id``, made from the keys of the
    batch alone: the same rows have the same id in every run, other rows another one."""
    batched = in_batches(df, *keys, size=size)
    # A window is one batch, of ``size`` rows.
    labels = F.array_sort(F.collect_list(_label(keys)).over(Window.partitionBy("batch")))
    made = F.concat(F.lit("emb-"), F.md5(F.concat_ws("\n", labels)))
    return batched.withColumn("batch_id", made)


def assign_embedding_batches(
    df: DataFrame, key: str | Sequence[str], size: int = EMBED_BATCH
) -> DataFrame:
    """Number consecutive batches by key and give those without an id one of their own,
    which ``embed_pairs`` gives the same batch.

    Rows that have an ``embedding_generation_id`` keep it.
    """
    named = _in_named_batches(df, _keys(key), size)
    given = F.coalesce("embedding_generation_id", "batch_id")
    return named.withColumn("embedding_generation_id", given).drop("batch_id")


def embed_pairs(
    df: DataFrame,
    embedder: Embedder,
    key: str | Sequence[str] = "publication_number",
    batch: int = EMBED_BATCH,
    dim: int = EMBEDDING_DIM,
    limit: int | None = None,
    concurrency: int | None = None,
) -> DataFrame:
    """Embed problem and solution of the rows that lack a vector.

    Batches are cut by key before any call, so they do not depend on partitions. Each call
    gets the texts of the rows of a batch in pairs; a call that fails or returns a wrong
    number of vectors rejects all of its rows, and a vector of a wrong dimension rejects
    its row. ``limit`` cuts the texts; ``concurrency`` bounds the calls at a time. Columns:
    key, ``problem_embedding``, ``solution_embedding``, ``embedding_generation_id``,
    ``reason``.
    """
    keys = _keys(key)
    todo = df
    if {"problem_embedding", "solution_embedding"} <= set(df.columns):
        todo = lacking_any(df, ["problem_embedding", "solution_embedding"])
    named = _in_named_batches(todo.select(*keys, "problem", "solution"), keys, batch)
    inputs = model_inputs(named, limit).select(
        *keys,
        "batch",
        "batch_id",
        all_missing("problem", "solution").alias("missing"),
        "problem_input",
        "solution_input",
    )
    spread = inputs.repartition(*[concurrency] * bool(concurrency), "batch")
    kinds = _ddl(inputs.schema[k] for k in keys)

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting, room = [], YIELDED_ELEMENTS
        for rows in _whole_batches(batches):
            empty = rows["missing"].to_numpy(bool)
            if not empty.all():
                waiting.append(_embedded(rows[~empty], embedder, keys))
            if empty.any():
                waiting.append(_unasked(rows[empty], keys))
            room -= 2 * max(dim, 1) * len(rows)
            if room <= 0:
                yield pd.concat(waiting, ignore_index=True)
                waiting, room = [], YIELDED_ELEMENTS
        if waiting:
            yield pd.concat(waiting, ignore_index=True)

    asked = spread.sortWithinPartitions("batch", *keys).mapInPandas(
        call,
        f"{kinds}, problem_embedding array<double>, "
        "solution_embedding array<double>, embedding_generation_id string, reason string",
    )
    right = has_dimension(dim, F.col("problem_embedding"), F.col("solution_embedding"))
    wrong = F.when(~right, F.lit("wrong dimension"))
    return asked.withColumn("reason", F.coalesce(F.col("reason"), wrong))


def _whole_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Regroup sorted rows of a partition by their batch."""
    rest: pd.DataFrame | None = None
    for rows in batches:
        if not len(rows):
            continue
        rest = rows if rest is None else pd.concat([rest, rows], ignore_index=True)
        number = rest["batch"].to_numpy()
        cuts = (number[1:] != number[:-1]).nonzero()[0] + 1
        for start, stop in zip([0, *cuts[:-1]], cuts):
            yield rest.iloc[start:stop]
        if len(cuts):
            rest = rest.iloc[cuts[-1] :]
    if rest is not None:
        yield rest


def _unasked(rows: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    result = rows[keys].copy()
    for column in ("problem_embedding", "solution_embedding", "embedding_generation_id"):
        result[column] = None
    result["reason"] = "no input"
    return result


def _embedded(rows: pd.DataFrame, embedder: Embedder, keys: list[str]) -> pd.DataFrame:
    result = rows[keys].copy()
    pairs = zip(rows["problem_input"], rows["solution_input"])
    texts = [t for pair in pairs for t in pair]
    try:
        vectors = [[float(x) for x in v] for v in embedder(texts)] if texts else []
        if len(vectors) != len(texts):
            raise ValueError(f"{len(vectors)} vectors for {len(texts)} texts")
        error = None
    except Exception as problem:
        vectors, error = [None] * len(texts), f"failed: {problem}"
    made = None if error or not texts else rows["batch_id"].iloc[0]
    result["problem_embedding"] = vectors[0::2]
    result["solution_embedding"] = vectors[1::2]
    result["embedding_generation_id"] = made
    result["reason"] = error
    return result


# Metadata of model calls


def fetch_generations(
    ids: DataFrame, fetcher: Fetcher, key: str = "generation_id"
) -> DataFrame:
    """Look up each id; the answer may be wrapped in a ``data`` field.

    Keeps the input's columns and adds the metadata fields and ``found``. An answer
    of None and a failing call leave ``found`` false.
    """
    given = ids.columns
    names = [f.name for f in GENERATION_FIELDS]
    kinds = _ddl(GENERATION_FIELDS)

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = [_metadata(fetcher, value) for value in batch[key]]
            rows = [[(a or {}).get(n) for n in names] for a in answers]
            extra = pd.DataFrame(rows, columns=names, index=batch.index, dtype=object)
            extra["created_at"] = pd.to_datetime(extra["created_at"])
            extra["found"] = [a is not None for a in answers]
            yield pd.concat([batch[given], extra], axis=1)

    return ids.mapInPandas(look_up, f"{_ddl(ids.schema)}, {kinds}, found boolean")


def _metadata(fetcher: Fetcher, generation_id: str) -> Answer:
    try:
        answer = fetcher(generation_id)
    except Exception:
        return None
    return answer["data"] if answer and "data" in answer else answer
