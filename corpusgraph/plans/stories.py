"""Story titles: enrichment, analytics, summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgraph.functions import display, text, titles

# Ids kept of a ranked list, and tags in the summary.
TOP_IDS = 5
TOP_TAGS = 5


def enrich_items(lists: DataFrame, items: DataFrame, top: int = TOP_IDS) -> DataFrame:
    """The first ids of each ranked list with title and author of the item.

    ``lists`` has ``story_ids``; ``items`` has ``id``, ``title`` and ``by``. Ids
    without an item keep their place with NULL fields.
    """
    others = [c for c in lists.columns if c != "story_ids"]
    heads = F.slice("story_ids", 1, top)
    ranked = lists.select(*others, F.posexplode(heads).alias("position", "id"))
    known = items.select("id", "title", F.col("by").alias("author"))
    return ranked.join(known, "id", "left")


def stamp_fetched_at(df: DataFrame) -> DataFrame:
    """One load time for all rows of the query."""
    return df.withColumn("fetched_at", F.current_timestamp())


def story_analytics(stories: DataFrame) -> DataFrame:
    """Counts, tags and clickbait score of each title; one narrow stage."""
    title = F.col("title")
    counted = stories.withColumns(
        {
            "word_count": text.word_count(title),
            "char_count": text.char_count(title),
            "tech_tags": titles.keyword_tags(title),
            "clickbait_score": titles.clickbait_score(title),
        }
    )
    return counted.select(
        *stories.columns,
        "word_count",
        "char_count",
        F.size("tech_tags").alias("tech_tag_count"),
        "clickbait_score",
        F.array_join("tech_tags", ", ").alias("tech_tags_str"),
    )


def story_summary(stories: DataFrame) -> DataFrame:
    """Number of stories and the means of word count and score."""
    title = F.col("title")
    return stories.agg(
        F.count(F.lit(1)).alias("num_stories"),
        F.avg(text.word_count(title)).alias("avg_word_count"),
        F.avg(titles.clickbait_score(title)).alias("avg_clickbait_score"),
    )


def top_tags(stories: DataFrame, n: int = TOP_TAGS) -> DataFrame:
    """The most frequent tags, ties in alphabetical order.

    Each keyword is counted in the one pass over the titles, so no row per tag is made.
    """
    counts = stories.agg(*titles.keyword_counts(F.col("title")))
    listed = counts.unpivot([], counts.columns, "tag", "stories")
    return listed.where("stories > 0").orderBy(F.desc("stories"), "tag").limit(n)


def story_preview(stories: DataFrame, n: int = 3) -> DataFrame:
    """The first analysed stories by id, with shortened titles."""
    first = stories.orderBy("id").limit(n)
    tags = F.col("tech_tags_str")
    return story_analytics(first).select(
        "id",
        display.shorten(F.col("title"), 50).alias("title"),
        "word_count",
        F.format_string("%.2f", F.bround("clickbait_score", 2)).alias("clickbait"),
        F.when(tags == "", F.lit("none")).otherwise(tags).alias("tags"),
    )
