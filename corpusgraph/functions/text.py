"""Text cleaning, counting and formatting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Instruction texts sent with every text to embed.
PROBLEM_TASK = (
    "Given a patent problem description, retrieve similar technical problems "
    "that companies or researchers are trying to solve"
)
SOLUTION_TASK = (
    "Given a patent solution description, retrieve similar technical solutions "
    "or innovations that address comparable challenges"
)


# The characters that count as whitespace in Unicode text.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_GAP = r"\t\f\r\x0b\x1c-\x1f\x85\p{Z}"
_BLANK = rf"\n{_GAP}"


def clean_text(text: Column) -> Column:
    """One line break for each run of whitespace that has any; strip the ends.

    That is what dropping blank lines, then whitespace after and before line breaks
    comes to, in one pass. A match starts only where a run starts and never gives
    characters back, so long runs take time in proportion to their length.
    """
    run = rf"(?<![{_BLANK}])[{_GAP}]*+\n[{_BLANK}]*+"
    return strip(F.regexp_replace(text, run, "\n"))


def strip(text: Column) -> Column:
    """Remove whitespace of every kind at both ends (``trim`` only knows spaces)."""
    return F.btrim(text, F.lit(WHITESPACE))


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(rf"[^{_BLANK}]+")), F.lit(0))


def char_count(text: Column) -> Column:
    """Number of code points; 0 for NULL."""
    return F.coalesce(F.length(text), F.lit(0))


def truncate(text: Column, limit: int | None) -> Column:
    """The first ``limit`` characters, all without a limit, and '' for NULL."""
    kept = text if limit is None else F.substring(text, 1, limit)
    return F.coalesce(kept, F.lit(""))


def is_missing(text: Column) -> Column:
    """NULL or empty."""
    return text.isNull() | (text == "")


def instruct(task: str, text: Column) -> Column:
    """The instruction form that embedding models expect."""
    return F.concat(F.lit(f"Instruct: {task}\nQuery: "), text)


def parse_model(model: Column) -> Column:
    """Split 'provider/name' at the first slash into a struct."""
    parts = F.split(model, "/", 2)
    has_provider = F.size(parts) == 2
    return F.struct(
        F.when(has_provider, parts[0]).otherwise("unknown").alias("provider"),
        F.when(has_provider, parts[1]).otherwise(model).alias("model_name"),
        model.alias("full_string"),
    )


def fingerprint(
    name: Column, doc: Column, fields: Sequence[tuple[str, Column]]
) -> Column:
    """Version string that changes when a name, text or field description does."""
    described = [
        F.concat(F.lit(f"{field}:"), F.coalesce(text, F.lit("")))
        for field, text in fields
    ]
    content = F.concat_ws("|", name, F.coalesce(doc, F.lit("")), *described)
    return F.concat(F.lit("v_"), F.substring(F.sha2(content, 256), 1, 10))
