"""Text, title and display functions on hand-made rows."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusgraph.functions import display, text, titles
from corpusgraph.plans import publications, stories


def values(spark, rows, expression, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    found = df.select("i", expression(F.col("x")).alias("y")).collect()
    return [r["y"] for r in sorted(found, key=lambda r: r["i"])]


def three_steps(value):
    """The cleaning rules one after the other."""
    for pattern in (r"\n\s*\n+", r"\n\s+", r"\s+\n"):
        value = re.sub(pattern, "\n", value)
    return value.strip()


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="a \n\t\r\x0b\xa0 \x1fé", max_size=30), min_size=1))
def test_clean_text_equals_the_rules_in_turn(spark, rows):
    assert values(spark, rows, text.clean_text) == [three_steps(r) for r in rows]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t\x0c\x1c\xa0 　é", max_size=30), min_size=1))
def test_word_count_splits_like_unicode_whitespace(spark, rows):
    assert values(spark, rows, text.word_count) == [len(r.split()) for r in rows]


def test_long_runs_take_linear_time(spark):
    gap = " " * 300_000
    assert values(spark, [f"a{gap}b{gap}\n{gap}c{gap}"], text.clean_text) == [f"a{gap}b\nc"]


def test_missing_texts_count_zero(spark):
    assert values(spark, [None, ""], text.word_count) == [0, 0]
    assert values(spark, [None, "añ😀"], text.char_count) == [0, 3]
    assert values(spark, [None], text.clean_text) == [None]


def test_truncate_and_missing(spark):
    assert values(spark, ["abcdef", None], lambda c: text.truncate(c, 3)) == ["abc", ""]
    assert values(spark, ["", None, " "], text.is_missing) == [True, True, False]


def test_parse_model_splits_at_the_first_slash(spark):
    found = values(spark, ["maker/family/x", "nomodel", "/y"], text.parse_model)
    assert [tuple(r) for r in found] == [
        ("maker", "family/x", "maker/family/x"),
        ("unknown", "nomodel", "nomodel"),
        ("", "y", "/y"),
    ]


def test_fingerprint_is_a_short_hash(spark):
    found = values(
        spark, ["doc"], lambda c: text.fingerprint(F.lit("N"), c, [("f", F.lit("d"))])
    )
    assert found == ["v_" + hashlib.sha256(b"N|doc|f:d").hexdigest()[:10]]


def test_instruct(spark):
    assert values(spark, ["q"], lambda c: text.instruct("t", c)) == [
        "Instruct: t\nQuery: q"
    ]


def test_tags_are_substrings_in_list_order(spark):
    rows = ["He said JavaScript", "OpenAI", None, ""]
    assert values(spark, rows, titles.keyword_tags) == [
        ["ai", "javascript", "java"],
        ["ai", "openai"],
        [],
        [],
    ]


@pytest.mark.parametrize(
    ("title", "score"),
    [
        (None, 0.0),
        ("plain", 0.0),
        ("why?", 0.15),
        ("3 things", 0.1),
        ("٣ things", 0.1),
        ("ABC", 0.0),
        ("ABCD", 0.1),
        ("ABCDe", 0.0),
        ("ÉTIONS ABCD", 0.1),
        ("AAAA BBBB CCCC DDDD", 0.1 * 3),
        ("ÉTIONS ABCD you won't believe", 0.2 + 0.1),
        ("secret shocking amazing incredible revealed 1?", 1.0),
    ],
)
def test_clickbait_score(spark, title, score):
    assert values(spark, [title], titles.clickbait_score) == [pytest.approx(score)]


def test_display_forms(spark):
    assert values(spark, ["abcdef", "abc", None], lambda c: display.shorten(c, 3)) == [
        "abc...",
        "abc",
        None,
    ]
    labels = values(spark, ["p", "", None, "nan"], display.provider_label)
    assert labels == ["p", "Unknown", "Unknown", "Unknown"]
    assert values(spark, [0.0012345678, None], display.dollars, "double") == [
        "$0.001235",
        "N/A",
    ]
    durations = values(spark, [64.5, 65.5, 1.2, None], display.millis, "double")
    assert durations == ["64ms", "66ms", "1ms", "N/A"]


def test_story_preview_survives_missing_titles(spark):
    df = spark.createDataFrame(
        [(1, "a", None), (2, "b", "x" * 60)], "id int, author string, title string"
    )
    shown = stories.story_preview(stories_in(df)).orderBy("id").collect()
    assert shown[0]["title"] is None and shown[0]["tags"] == "none"
    assert shown[1]["title"] == "x" * 50 + "..."


def stories_in(df):
    return df.select("id", "author", "title")


def test_nested_extraction(spark):
    localized = "array<struct<text: string, language: string>>"
    df = spark.createDataFrame(
        [
            (1, [("a", "de"), ("b", "en"), ("c", "en")]),
            (2, [("a", "de")]),
            (3, []),
            (4, None),
        ],
        f"i int, x {localized}",
    )
    found = df.select(
        "i",
        publications.first_text(F.col("x")).alias("first"),
        publications.text_in(F.col("x"), "en").alias("english"),
    ).orderBy("i")
    assert [(r["first"], r["english"]) for r in found.collect()] == [
        ("a", "b"),
        ("a", None),
        (None, None),
        (None, None),
    ]


def test_newest_publications_takes_the_newest_with_number_as_tiebreak(spark):
    localized = "array<struct<text: string, language: string>>"
    rows = [("US", f"US-{i:03d}", 20240101 + i // 10) for i in range(100)]
    rows += [("DE", "DE-1", 20250101), ("US", "US-none", None)]
    df = spark.createDataFrame(
        rows, "country_code string, publication_number string, publication_date int"
    ).selectExpr(
        "*",
        "'x' application_number",
        "0 grant_date",
        "array('o') assignee",
        *[f"cast(null as {localized}) {c}_localized" for c in ("title", "abstract", "claims")],
    )
    found = publications.newest_publications(df, n=15).select("publication_number")
    expected = [f"US-{i:03d}" for i in [*range(90, 100), *range(80, 85)]]
    assert {r[0] for r in found.collect()} == set(expected)


def test_cleaning_renames_only_what_is_there(spark):
    df = spark.createDataFrame([(" a \n\n b ",)], "abstract string")
    assert publications.clean_publications(df).collect() == [("a\nb",)]


def test_null_profile_counts_nan_in_float_columns(spark):
    df = spark.createDataFrame(
        [(1, float("nan"), "x"), (2, None, "y")], "a int, b double, c string"
    )
    assert publications.null_profile(df).collect() == [("b", 2)]


def test_coverage_of_an_empty_table_is_zero(spark):
    empty = spark.createDataFrame([], "claims_text string")
    assert publications.claims_coverage(empty).collect() == [(0, 0, 0.0)]
