"""Benchmark decontamination by winnowing.

A window is 13 consecutive words of a benchmark item. In every window the smallest hash
of a run of 5 words is its fingerprint, on both sides alike, so a shared window shares its
fingerprint: 9 runs of 5 words make up 13 words, and equal windows choose equal runs.
Documents meet the benchmark in a join of fingerprints; hits are extended to the windows
around them and compared word for word. An item below 13 words is one window and its own
fingerprint, for each length that occurs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgraph.llm.native import plain_words, run_fields, runs, without_ids
from corpusgraph.sources.scratch import materialize

WINDOW = 13
GRAM = 5


def _grams(words: str, size: int) -> Column:
    """Hashes of all runs of ``size`` words; the size is part of the hash."""
    return F.transform(runs(F.col(words), size), lambda run: F.xxhash64(F.lit(size), run))


def _winnowed(hashes: str, width: int) -> Column:
    """The least hash of every ``width`` neighbouring ones."""
    return F.transform(runs(F.col(hashes), width), lambda run: F.least(*run_fields(run, width)))


def _tagged(hashes: Column, length: int) -> Column:
    """Each hash with the length of its window."""
    return F.transform(hashes, lambda h: F.struct(h.alias("hash"), F.lit(length).alias("length")))


def _placed(hashes: Column, length: int) -> Column:
    """Each hash with the length of its window and its place."""
    return F.transform(
        hashes, lambda h, at: F.struct(h.alias("hash"), F.lit(length).alias("length"), at.alias("at"))
    )


def _fingerprints(rows: DataFrame, lengths: list[int], window: int, gram: int) -> DataFrame:
    """``rows`` (…, words) with ``prints``: distinct fingerprints, as (hash, length).

    ``lengths`` are those of the windows of short items; their runs are all kept.
    """
    keep = rows.columns
    rows = rows.withColumn("_grams", _grams("words", gram))
    found = [(_winnowed("_grams", window - gram + 1), window)]
    found += [(_grams("words", length), length) for length in lengths]
    tagged = [_tagged(F.array_distinct(hashes), length) for hashes, length in found]
    return rows.select(*keep, F.concat(*tagged).alias("prints"))


def _item_windows(items: DataFrame, window: int) -> DataFrame:
    """(item_id, length, window) of all items: the words of a window, joined by spaces."""
    count = F.size("words")
    length = F.least(count, F.lit(window))
    starts = F.sequence(F.lit(1), count - length + 1)
    return (
        items.filter(count > 0)
        .select("item_id", "words", length.alias("length"), F.explode(starts).alias("start"))
        .select("item_id", "length", F.array_join(F.slice("words", F.col("start"), F.col("length")), " ").alias("window"))
        .distinct()
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, spans) of every row of ``docs``.

    Words are lower-cased (A-Z); a word is hit when it lies in an occurrence of a window
    of an item. ``items`` are the ids, as strings and in their order, of items with
    windows that occur; ``spans`` are the occurrences (start, length) in words.

    Null and empty texts have no words and no hits; items without words match nothing;
    items with equal windows all count; the windows of an
    item without id hit words, but the item is not listed. Rows that share an id are judged by the windows
    of all of them. Rows without id are not judged and have no hits. Empty tables give
    no rows, or no hits.
    """
    bench = items.select(
        F.col(item_col).cast("string").alias("item_id"), plain_words(F.col(item_text_col)).alias("words")
    )
    bench = materialize(bench, "benchmark-words")
    short = bench.select(F.size("words").alias("n")).filter(f"n > 0 and n < {window}").distinct()
    lengths = sorted(r["n"] for r in short.collect())  # at most window - 1 numbers
    windows = materialize(_item_windows(bench, window), "benchmark-windows")
    prints = _fingerprints(bench, lengths, window, gram)
    prints = prints.select(F.size("words").alias("n"), F.explode("prints").alias("p")).select("n", "p.*")
    # A print of a short length counts for items of just that length.
    prints = prints.filter((F.col("length") == window) | (F.col("length") == F.col("n")))
    prints = materialize(prints.select("hash", "length").distinct(), "benchmark-prints")

    words = docs.select(F.col(id_col).alias("doc_id"), plain_words(F.col(text_col)).alias("words"))
    known = _fingerprints(words, lengths, window, gram).select("doc_id", F.size("words").cast("long").alias("n_words"), "prints")
    known = materialize(known, "document-prints")
    met = (
        known.filter("doc_id is not null")
        .select("doc_id", F.explode("prints").alias("p"))
        .select("doc_id", "p.hash", "p.length")
        .join(prints, ["hash", "length"], "left_semi")
        .select("doc_id")
        .distinct()
    )
    met = materialize(met, "documents-met")
    suspects = materialize(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        .join(met, "doc_id", "left_semi")
        .select(F.monotonically_increasing_id().alias("row"), "doc_id", plain_words(F.col("text")).alias("words")),
        "documents-suspect",
    )
    spans = _extended(suspects, prints, windows, lengths, window, gram)
    spans = materialize(spans, "contaminated-spans")
    covered = F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1)))
    hit = spans.groupBy("doc_id").agg(F.collect_set(F.struct("start", "length")).alias("spans"))
    hit = hit.select("doc_id", F.sort_array("spans").alias("spans"), F.size(F.array_distinct(covered)).cast("long").alias("n_hit"))
    found = spans.select("doc_id", "length", "window").distinct().join(windows, ["length", "window"])
    found = found.filter("item_id is not null").select("doc_id", "item_id").distinct().groupBy("doc_id")
    found = found.agg(F.sort_array(F.collect_list("item_id")).alias("items"))
    return (
        known.select("doc_id", "n_words")
        .join(hit.join(found, "doc_id", "left"), "doc_id", "left")
        .select(
            "doc_id",
            "n_words",
            F.least(F.coalesce("n_hit", F.lit(0)), "n_words").cast("long").alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
            "spans",
        )
    )


def _extended(
    suspects: DataFrame, prints: DataFrame, windows: DataFrame, lengths: list[int], window: int, gram: int
) -> DataFrame:
    """(doc_id, start, length, window): all occurrences of windows around met fingerprints."""
    at = [_placed(_grams("words", gram), window)]
    at += [_placed(_grams("words", n), n) for n in lengths]
    places = suspects.select("row", F.explode(F.concat(*at)).alias("p")).select("row", "p.*")
    places = places.join(prints, ["hash", "length"], "left_semi")
    # A window may begin up to window - gram words before a run of gram words.
    before = F.when(F.col("length") == window, window - gram).otherwise(0)
    starts = places.select("row", "length", F.explode(F.sequence(F.col("at") - before, F.col("at"))).alias("start"))
    starts = starts.filter("start >= 0").groupBy("row").agg(F.collect_set(F.struct("length", "start")).alias("starts"))
    text = F.array_join(F.slice("words", F.col("start") + 1, F.col("length")), " ")
    return (
        suspects.join(starts, "row")
        .select("doc_id", "words", F.explode("starts").alias("s"))
        .select("doc_id", "words", "s.length", "s.start")
        .filter(F.col("start") + F.col("length") <= F.size("words"))
        .select("doc_id", "start", "length", text.alias("window"))
        .join(windows.select("length", "window").distinct(), ["length", "window"], "left_semi")
    )


def is_contaminated() -> Column:
    """Some word is hit, and at least one in twenty."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def keep_clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows that are not contaminated, all columns as they are; rows without id stay."""
    id_col = options.get("id_col", "doc_id")
    found = contamination(docs, items, **options).filter(is_contaminated())
    return without_ids(docs, found.select("doc_id").distinct(), id_col)
