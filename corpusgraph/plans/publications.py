"""Publications: extraction from the nested source, CSV additions, cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgraph.functions import text
from corpusgraph.operators import profile
from corpusgraph.operators.incremental import pending
from corpusgraph.operators.sampling import top_n
from corpusgraph.sources.lake import Lake, WriteStats

# Country of the newest publications, and the CSV columns.
COUNTRY = "US"
CSV_COLUMNS = (
    "publication_number",
    "application_number",
    "publication_date",
    "grant_date",
    "title",
    "abstract",
    "claims_text",
)


def first_text(localized: Column) -> Column:
    """Text of the first element, NULL when there is none."""
    return F.get(localized, 0)["text"]


def text_in(localized: Column, language: str) -> Column:
    """Text of the first element in a language, NULL when there is none."""
    return first_text(F.filter(localized, lambda c: c["language"] == language))


def flatten(publications: DataFrame) -> DataFrame:
    """Plain columns from the nested source."""
    return publications.select(
        "publication_number",
        "application_number",
        "publication_date",
        "grant_date",
        first_text(F.col("title_localized")).alias("title"),
        first_text(F.col("abstract_localized")).alias("abstract"),
        "assignee",
        text_in(F.col("claims_localized"), "en").alias("claims_text"),
    )


def newest_publications(
    publications: DataFrame, n: int, country: str = COUNTRY
) -> DataFrame:
    """The ``n`` newest publications of a country, ties by number.

    Dates and numbers are ranked alone; nested columns are read for the rows kept.
    """
    chosen = publications.where(F.col("country_code") == country)
    date = F.col("publication_date")
    return flatten(top_n(chosen, "publication_number", n, date, descending=True))


def append_csv(
    lake: Lake, name: str, rows: DataFrame, dedupe_on: str | None = None
) -> WriteStats:
    """Append CSV rows flagged as evaluation data; columns not listed become NULL.

    Like any append it repeats rows when run twice. With ``dedupe_on`` only keys that
    the table does not have yet are added.
    """
    lake.add_column(name, "is_evaluation", "boolean")
    flagged = rows.select(*CSV_COLUMNS).withColumn("is_evaluation", F.lit(True))
    if dedupe_on:
        flagged = pending(flagged, lake.read(name), dedupe_on)
    return lake.append(flagged, name)


def clean_publications(publications: DataFrame) -> DataFrame:
    """Rename title and abstract, clean abstract and claims where present."""
    renamed = publications.withColumnsRenamed(
        {"title": "title_text", "abstract": "abstract_text"}
    )
    cleaned = {
        name: text.clean_text(F.col(name))
        for name in ("abstract_text", "claims_text")
        if name in renamed.columns
    }
    return renamed.withColumns(cleaned) if cleaned else renamed


def null_profile(publications: DataFrame) -> DataFrame:
    return profile.null_profile(publications)


def claims_coverage(publications: DataFrame) -> DataFrame:
    return profile.share_present(publications, "claims_text")


def date_range(publications: DataFrame) -> DataFrame:
    return profile.value_range(publications, "publication_date")
