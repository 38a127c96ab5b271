"""Removal of repeated groups of lines.

Texts are cut into content-defined chunks: a hash rolls over two neighbouring line hashes, and
a chunk begins wherever it is a local minimum. Boundaries depend on four lines only, so they
shift with the text; chunks have two lines or more, three on average. A chunk that stood
earlier goes.

Matches then grow by single lines, and repeats shorter than a chunk are found: windows of two
lines are counted wherever no chunk went, across the ends of chunks too. A window that stood
earlier goes. The earliest place of a window is never inside a chunk that stood earlier, so
every repeated passage of two lines or more is found, wherever it begins and ends.

Chunks are grouped by the hashes of all their lines, windows by those of two. All lines of
repeated chunks and windows are compared byte for byte: where different lines share a hash,
chunks with it stay whole and their windows are told apart by their text. The first occurrence
is that with the smallest id, then the smallest place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgraph.sources.scratch import materialize, materialize_measured

BROADCAST_ROWS = 1 << 18  # keys of repeated windows, 40 bytes each: 10 MB
BROADCAST_HASHES = 1 << 19  # line hashes in keys of repeated chunks: 4 MB, and 40 bytes a key
_CHUNK = ["lines"]
_WINDOW = ["a", "b"]
# A unit is a line with a word and the blank lines after it.
_NEXT_UNIT = r"\n(?=[\x20\x09\x0B-\x0D]*[^\x20\x09-\x0D])"


def _units(text: str) -> Column:
    return F.split(text, _NEXT_UNIT, -1)


def _first_line(unit: Column) -> Column:
    return F.substring_index(unit, "\n", 1)


def line_hashes(rows: DataFrame, hashed: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """(doc_id, tag, lead, a, b) of ``rows`` (doc_id, tag, text) with two units or more.

    ``a`` holds the hash of every unit but the last, ``b`` that of the line that follows it.
    Blank lines before the first word of a text are no part of a chunk: then ``lead`` is 1.
    """
    rows = rows.select("doc_id", "tag", _units("text").alias("_units")).filter(F.size("_units") > 1)
    led = F.get("_units", F.lit(0)).rlike(r"[^\x20\x09-\x0D]")
    return rows.select(
        "doc_id",
        "tag",
        F.when(led, 0).otherwise(1).alias("lead"),
        F.slice(F.transform("_units", lambda u: hashed(u)), 1, F.size("_units") - 1).alias("a"),
        F.slice(F.transform("_units", lambda u: hashed(_first_line(u))), 2, F.size("_units") - 1).alias("b"),
    )


def chunks(hashes: DataFrame) -> DataFrame:
    """(doc_id, tag, place, lines) of every chunk of two units or more.

    ``place`` is that of its first unit, ``lines`` the hashes of its units, of the last one
    without the blank lines after it.
    """
    rows = hashes.select("*", F.zip_with("a", "b", lambda x, y: F.xxhash64(x, y)).alias("_rolled"))
    rolled = lambda k: F.get("_rolled", k)
    # Beyond the ends the hash is null, and no minimum.
    least = lambda k: (rolled(k) < rolled(k - 1)) & (rolled(k) <= rolled(k + 1))
    begins = F.filter(F.sequence("lead", F.size("_rolled")), lambda k: (k == F.col("lead")) | least(k))
    rows = rows.select("doc_id", "tag", "a", "b", begins.alias("_begins"))
    after = lambda j: F.coalesce(F.get("_begins", j + 1), F.size("a") + 1)
    spans = F.transform("_begins", lambda k, j: F.struct(k.alias("place"), (after(j) - k).alias("units")))
    rows = rows.select("doc_id", "tag", "a", "b", F.filter(spans, lambda s: s["units"] > 1).alias("_spans"))
    last = lambda s: F.array(F.get("b", s["place"] + s["units"] - 2))
    line_list = lambda s: F.concat(F.slice("a", s["place"] + 1, s["units"] - 1), last(s))
    found = F.transform("_spans", lambda s: F.struct(s["place"].alias("place"), line_list(s).alias("lines")))
    return rows.select("doc_id", "tag", F.inline(found))


def _windows(hashes: DataFrame, gone: DataFrame) -> DataFrame:
    """(doc_id, tag, place, a, b): each unit and the next line, less those inside chunks of ``gone``."""
    inside = F.transform("_gone", lambda s: F.sequence(s["place"], s["place"] + s["units"] - 2))
    spans = F.struct("place", F.size("lines").alias("units"))
    gone = gone.groupBy("doc_id", "tag").agg(F.collect_set(spans).alias("_gone"))
    rows = hashes.join(gone, ["doc_id", "tag"], "left")
    every = F.filter(F.sequence(F.lit(0), F.size("a") - 1), lambda k: k >= F.col("lead"))
    left = F.when(F.col("_gone").isNull(), every).otherwise(F.array_except(every, F.flatten(inside)))
    rows = rows.select("doc_id", "tag", "a", "b", left.alias("_left"))
    window = lambda k: F.struct(k.alias("place"), F.get("a", k).alias("a"), F.get("b", k).alias("b"))
    return rows.select("doc_id", "tag", F.inline(F.transform("_left", window)))


def _small(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table


def _occurrences(pieces: DataFrame, key: list[str], label: str) -> tuple[DataFrame, DataFrame]:
    """The keys that ``pieces`` have twice or more, and all their occurrences."""
    keys = pieces.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"))
    keys = keys.filter("n > 1").drop("n")
    hashes = F.size("lines") if key == _CHUNK else F.lit(2)
    keys, seen = materialize_measured(keys, f"repeated-{label}", rows=F.count(F.lit(1)), hashes=F.sum(hashes))
    few = seen["rows"] <= BROADCAST_ROWS and (seen["hashes"] or 0) <= BROADCAST_HASHES
    return keys, materialize(pieces.join(F.broadcast(keys) if few else keys, key), f"{label}-occurrences")


def _later(found: DataFrame, key: list[str]) -> DataFrame:
    """The rows of ``found`` that are not the first of their key."""
    # Within the first row a key goes from its second place on.
    inside = found.filter("doc_id = first_id")
    twice = inside.groupBy(*key).agg(F.min("place").alias("least"), F.max("place").alias("most"))
    inside = inside.join(twice.filter("least < most"), key).filter("place > least")
    return found.filter("doc_id > first_id").unionByName(inside.select(*found.columns))


def repeated_windows(rows: DataFrame, hashed: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """(doc_id, tag, place) of every window of ``rows`` (doc_id, tag, text) that stood earlier.

    The windows inside a chunk that stood earlier come from the chunk.
    """
    rows = rows.filter("doc_id is not null and text is not null")
    hashes = materialize(line_hashes(rows, hashed), "line-hashes")
    chunk_keys, whole = _occurrences(chunks(hashes), _CHUNK, "chunks")
    gone = _later(whole, _CHUNK)
    keys, found = _occurrences(_windows(hashes, gone), _WINDOW, "windows")

    each = F.explode(F.sequence(F.col("place"), F.col("place") + F.size("lines") - 2)).alias("place")
    in_chunks = whole.select("doc_id", "tag", each)
    places = found.select("doc_id", "tag", "place").unionByName(in_chunks)
    places = places.groupBy("doc_id", "tag").agg(F.sort_array(F.collect_set("place")).alias("places"))
    texts = rows.join(places, ["doc_id", "tag"]).select("doc_id", "tag", "places", _units("text").alias("_units"))
    spelled = F.transform("places", lambda at: F.array(F.get("_units", at), _first_line(F.get("_units", at + 1))))
    lines = texts.select(F.explode(F.flatten(spelled)).alias("line"))
    clashes = lines.distinct().groupBy(hashed(F.col("line")).alias("hash")).agg(F.count(F.lit(1)).alias("n"))
    clashes, seen = materialize_measured(clashes.filter("n > 1").select("hash"), "line-clashes", rows=F.count(F.lit(1)))
    if seen["rows"]:
        clashes = _small(clashes, seen["rows"])
        unsafe = chunk_keys.select("lines", F.explode("lines").alias("hash")).join(clashes, "hash", "left_semi")
        gone = gone.join(unsafe.select("lines").distinct(), "lines", "left_anti")
        keys, found = _occurrences(_windows(hashes, gone), _WINDOW, "windows")
    again = _later(found, _WINDOW)
    if seen["rows"]:
        doubtful = keys.join(clashes, F.col("a") == F.col("hash"), "left_semi").unionByName(
            keys.join(clashes, F.col("b") == F.col("hash"), "left_semi")
        )
        doubtful = materialize(doubtful.select(*_WINDOW).distinct(), "windows-in-doubt")
        again = again.join(doubtful, _WINDOW, "left_anti").select("doc_id", "tag", "place")
        again = again.unionByName(_told_apart(found.join(doubtful, _WINDOW, "left_semi"), texts.drop("places")))
    again = again.select("doc_id", "tag", "place").unionByName(gone.select("doc_id", "tag", each))
    return again.distinct()


def _told_apart(found: DataFrame, texts: DataFrame) -> DataFrame:
    """The places of ``found`` whose window stood earlier, by its text."""
    pair = F.struct(F.get("_units", F.col("place")), _first_line(F.get("_units", F.col("place") + 1)))
    spelled = found.select("doc_id", "tag", "place").distinct().join(texts, ["doc_id", "tag"])
    spelled = materialize(spelled.select("doc_id", "tag", "place", pair.alias("pair")).distinct(), "windows-spelled")
    first = spelled.groupBy("pair").agg(F.min(F.struct("doc_id", "place")).alias("first"))
    later = F.struct("doc_id", "place") > F.col("first")
    return spelled.join(first, "pair").filter(later).select("doc_id", "tag", "place")


def _without_windows(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(_row, text, n_lines, n_removed) of rows that lose lines, and (_row, text) of the others."""
    tag = F.xxhash64(F.col("text")).alias("tag")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).select("doc_id", tag, "text")
    gone = repeated_windows(rows).groupBy(F.col("doc_id").alias("_gone_id"), F.col("tag").alias("_gone_tag"))
    gone = gone.agg(F.collect_list("place").alias("_gone"))
    whole = _with_row(docs, id_col, text_col).withColumn("_tag", F.xxhash64("text"))
    same = (F.col("_id") == F.col("_gone_id")) & (F.col("_tag") == F.col("_gone_tag"))
    whole = whole.join(gone, same, "left").select("_row", "_gone", "text")
    cut = whole.filter("_gone is not null").select("_row", "_gone", "text", _units("text").alias("_units"))
    # A window is its unit and the next one.
    left = F.array_except(
        F.sequence(F.lit(0), F.size("_units") - 1),
        F.concat("_gone", F.transform("_gone", lambda at: at + 1)),
    )
    cut = cut.select("_row", "text", "_units", left.alias("_places"))
    cut = cut.select("_row", "text", F.transform("_places", lambda at: F.get("_units", at)).alias("_kept"))
    kept = F.array_join("_kept", "\n")
    cut = cut.select("_row", "text", F.size("_kept").alias("_n"), kept.alias("_kept"))
    lines = lambda c: F.size(F.split(c, "\n", -1))
    stay = F.when(F.col("_n") == 0, 0).otherwise(lines("_kept"))
    cut = cut.select(
        "_row",
        F.col("_kept").alias(text_col),
        lines("text").cast("long").alias("n_lines"),
        (lines("text") - stay).cast("long").alias("n_removed"),
    )
    return cut, whole.filter("_gone is null").select("_row", "text")


def _with_row(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_row, _id, text): all columns but the text, less earlier counts."""
    row = [F.col(f"`{c}`") for c in _names(docs) if c != text_col]
    return docs.select(F.struct(*row).alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("text"))


def _names(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]


def remove_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every row with its text less repeated lines, and ``n_lines``, ``n_removed``.

    A line with a word goes where it and the next such line, or it and the one before,
    stand with the same bytes from the one to the other in a row with a smaller id or
    earlier in the text. Blank lines go with the line above them. The columns ``n_lines`` (of the text) and ``n_removed`` (lines
    removed) replace columns of these names; all others stay.

    A null text stays null, with no lines; an empty text is one empty line; a line alone
    and blank lines before the first word stay. Of rows that share an id and a text, each
    keeps and loses the same lines. Rows without id are left alone and remove nothing. A
    text may become empty; an empty table gives an empty table. A long text is cut like any
    other, and is held by one task at a time.
    """
    cut, plain = _without_windows(docs, id_col, text_col)
    count = F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0))
    plain = plain.select(
        "_row",
        F.col("text").alias(text_col),
        F.when(F.col("text").isNull(), 0).otherwise(count).cast("long").alias("n_lines"),
        F.lit(0).cast("long").alias("n_removed"),
    )
    both = cut.unionByName(plain)
    columns: list[Column] = [F.col(f"`{c}`") if c == text_col else F.col(f"_row.`{c}`") for c in _names(docs)]
    return both.select(*columns, "n_lines", "n_removed")
