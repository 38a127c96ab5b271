"""Cost summaries and previews of model calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgraph.functions import display

# Fixed value: calls shown in a preview.
LATEST = 5


def _or_zero(value: Column, name: str) -> Column:
    return F.coalesce(value, F.lit(0.0)).alias(name)


def _or_none(value: Column, name: str) -> Column:
    return F.coalesce(value, F.lit(0)).alias(name)


def extraction_cost_summary(generations: DataFrame) -> DataFrame:
    """Number, cost, tokens and latency of all calls; 0 where nothing is known."""
    return generations.agg(
        F.count(F.lit(1)).alias("total_generations"),
        _or_zero(F.sum("total_cost"), "total_cost_usd"),
        _or_zero(F.avg("total_cost"), "avg_cost_per_generation"),
        _or_zero(F.avg("tokens_prompt"), "avg_prompt_tokens"),
        _or_zero(F.avg("tokens_completion"), "avg_completion_tokens"),
        _or_zero(F.avg("latency"), "avg_latency_ms"),
    )


def embedding_cost_summary(generations: DataFrame) -> DataFrame:
    """As above for batched calls. Costs per item are means of the batches' ratios."""
    cost = F.col("total_cost")
    per_patent = F.try_divide(cost, F.col("patents_in_batch"))
    per_embedding = F.try_divide(cost, F.col("embeddings_in_batch"))
    return generations.agg(
        F.count(F.lit(1)).alias("total_generations"),
        _or_none(F.sum("patents_in_batch"), "total_patents_embedded"),
        _or_none(F.sum("embeddings_in_batch"), "total_embeddings_generated"),
        _or_zero(F.sum("total_cost"), "total_cost_usd"),
        _or_zero(F.avg("total_cost"), "avg_cost_per_generation"),
        _or_zero(F.avg(per_patent), "avg_cost_per_patent"),
        _or_zero(F.avg(per_embedding), "avg_cost_per_embedding"),
        _or_zero(F.avg("tokens_prompt"), "avg_prompt_tokens"),
        _or_zero(F.avg("tokens_completion"), "avg_completion_tokens"),
        _or_zero(F.avg("latency"), "avg_latency_ms"),
        _or_zero(F.avg("patents_in_batch"), "avg_patents_per_batch"),
        _or_zero(F.avg("embeddings_in_batch"), "avg_embeddings_per_batch"),
    )


def latest_generations(generations: DataFrame, n: int = LATEST) -> DataFrame:
    """The calls fetched last."""
    newest = F.desc_nulls_last("fetched_at")
    return generations.orderBy(newest, "generation_id").limit(n)


def generation_preview(generations: DataFrame, *others: str) -> DataFrame:
    """Display form of each call, with ``others`` of its columns."""
    return generations.select(
        "generation_id",
        *others,
        F.concat(F.substring("generation_id", 1, 16), F.lit("...")).alias("short_id"),
        display.provider_label(F.col("provider_name")).alias("provider"),
        display.dollars(F.col("total_cost")).alias("cost"),
        display.token_pair(F.col("tokens_prompt"), F.col("tokens_completion")).alias(
            "tokens"
        ),
        display.millis(F.col("latency")).alias("latency"),
    )


def batch_preview(generations: DataFrame) -> DataFrame:
    """Display form of each batched call; a missing batch size is 0."""
    sizes = ("patents_in_batch", "embeddings_in_batch")
    return generation_preview(generations.fillna(0, subset=list(sizes)), *sizes)
