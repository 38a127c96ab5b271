"""Short display forms for previews."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shorten(text: Column, limit: int) -> Column:
    """The text, cut to ``limit`` characters plus '...' when it is longer."""
    cut = F.concat(F.substring(text, 1, limit), F.lit("..."))
    return F.when(F.length(text) > limit, cut).otherwise(text)


def provider_label(provider: Column) -> Column:
    """Provider name, 'Unknown' when missing."""
    missing = provider.isNull() | provider.isin("", "nan", "None")
    return F.when(missing, F.lit("Unknown")).otherwise(provider)


def dollars(cost: Column) -> Column:
    """Cost with six decimals, 'N/A' when missing."""
    return F.coalesce(
        F.when(cost.isNotNull(), F.format_string("$%.6f", cost)), F.lit("N/A")
    )


def millis(duration: Column) -> Column:
    """Whole milliseconds, halves to even, 'N/A' when missing."""
    whole = F.format_string("%.0fms", F.bround(duration, 0))
    return F.coalesce(F.when(duration.isNotNull(), whole), F.lit("N/A"))


def token_pair(prompt: Column, completion: Column) -> Column:
    """'prompt+completion' token counts."""
    parts = [F.coalesce(c.cast("string"), F.lit("None")) for c in (prompt, completion)]
    return F.concat(parts[0], F.lit("+"), parts[1])
