"""Keyword tags and the clickbait score of a title."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keywords looked up as substrings of the lower-cased title.
TECH_KEYWORDS = (
    "ai",
    "ml",
    "llm",
    "gpt",
    "openai",
    "anthropic",
    "claude",
    "chatgpt",
    "rust",
    "python",
    "javascript",
    "typescript",
    "golang",
    "java",
    "kubernetes",
    "docker",
    "aws",
    "cloud",
    "serverless",
    "blockchain",
    "crypto",
    "bitcoin",
    "ethereum",
    "startup",
    "vc",
    "funding",
    "yc",
    "ycombinator",
    "open source",
    "opensource",
    "github",
    "linux",
    "security",
    "hack",
    "vulnerability",
    "breach",
    "apple",
    "google",
    "microsoft",
    "meta",
    "amazon",
)

# Phrases that raise the clickbait score.
CLICKBAIT_PHRASES = (
    "you won't believe",
    "shocking",
    "amazing",
    "incredible",
    "why you should",
    "here's why",
    "the truth about",
    "everything you need",
    "secret",
    "revealed",
)

# Weights of the score's parts.
QUESTION_WEIGHT = 0.15
DIGIT_WEIGHT = 0.1
PHRASE_WEIGHT = 0.2
SHOUT_WEIGHT = 0.1
MAX_SHOUTS = 3


def _contained(title: Column) -> list[Column]:
    """Whether the title contains each keyword.

    One ``contains`` per keyword stays in generated code, which computes
    ``lower(title)`` once; a lambda over the keywords would be interpreted.
    """
    low = F.lower(title)
    return [F.contains(low, F.lit(k)) for k in TECH_KEYWORDS]


def keyword_tags(title: Column) -> Column:
    """Keywords contained in the title, in list order; empty for NULL."""
    hits = [F.when(c, F.lit(k)) for c, k in zip(_contained(title), TECH_KEYWORDS)]
    nothing = F.array(F.lit(None).cast("string"))
    return F.array_except(F.array(*hits), nothing)


def keyword_counts(title: Column) -> list[Column]:
    """Aggregates named after the keywords: the number of titles with each."""
    return [F.count_if(c).alias(k) for c, k in zip(_contained(title), TECH_KEYWORDS)]


def clickbait_score(title: Column) -> Column:
    """Score between 0 and 1; 0 for NULL.

    Terms are added in a fixed order, so that equal titles give equal bits.
    """
    low = F.lower(title)

    def part(condition: Column, weight: float) -> Column:
        return F.when(condition, F.lit(weight)).otherwise(F.lit(0.0))

    # The lookahead only spares most positions the costlier Unicode boundary.
    shouts = F.regexp_count(title, F.lit(r"(?U)(?=[A-Z]{4})\b[A-Z]{4,}\b"))
    parts = [
        part(F.contains(title, F.lit("?")), QUESTION_WEIGHT),
        part(title.rlike(r"\p{Nd}"), DIGIT_WEIGHT),
        *[part(F.contains(low, F.lit(p)), PHRASE_WEIGHT) for p in CLICKBAIT_PHRASES],
        F.lit(SHOUT_WEIGHT) * F.least(F.coalesce(shouts, F.lit(0)), F.lit(MAX_SHOUTS)),
    ]
    # Every part of a missing title is 0. No branch around the sum: within a branch the
    # lower-cased title would be computed once per phrase.
    return F.least(reduce(lambda left, right: left + right, parts), F.lit(1.0))
