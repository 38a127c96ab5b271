"""Quality rules: fixed base rules, then robust multivariate outliers.

Counts of each text become a vector of transformed statistics. For every language and
source a minimum-covariance-determinant estimate is found by concentration steps: from a
first estimate, take the half of the rows with the smallest Mahalanobis distances, estimate
mean and covariance from them, and repeat. Three first estimates are followed (medians with
absolute deviations, mean and covariance of all rows, medians with the covariance of
spatial signs), and the one that ends with the least determinant counts. A step is one
aggregation over narrow rows, by group, start and bin of the distance. Of the bin in which
the half ends every row has the same part of a weight, so equal rows are treated alike and
copies do not enter beyond the half. The statistics are integers, so sums do not depend on
the order of rows.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusgraph.llm.native import runs, space_words, without_ids
from corpusgraph.sources.scratch import materialize

UNIT = 1000  # statistics are kept as thousandths
CONSISTENCY = 1.785  # covariance of the nearest half of normal rows in six dimensions
FLOOR = 0.35  # added to every standard deviation: less than this is no difference
STEPS = 6
BINS = 4096  # of the distance, 128 to a doubling
LEAST_ROWS = 100  # smaller groups are pooled
CUTOFF = 40.0  # squared distance; the upper 5e-7 of normal rows in six dimensions

_STATISTICS = ("length", "word", "symbol", "capital", "line", "repeat")
_DIM = len(_STATISTICS)
_KEY = ["group", "start"]
_PAIRS = list(combinations_with_replacement(range(_DIM), 2))


def counted(docs: DataFrame, text: Column, *keep: Column) -> DataFrame:
    """``keep`` and the counts of each text.

    n_words; word_chars (characters in words); n_symbols (of ``#*$%&|<>``); n_capitals;
    n_lines (lines with a word); n_dup_lines (those equal to an earlier one);
    n_repeat_words (words in windows of three that occur twice or more).
    """
    whole = F.coalesce(text, F.lit(""))
    has_word = lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    base = docs.select(
        *keep,
        space_words(text).alias("_words"),
        F.filter(F.split(whole, "\n"), has_word).alias("_lines"),
        (F.size(F.split(whole, r"[#*$%&|<>]", -1)) - 1).cast("long").alias("n_symbols"),
        (F.size(F.split(whole, "[A-Z]", -1)) - 1).cast("long").alias("n_capitals"),
    )
    names = [c for c in base.columns if c not in ("_words", "_lines")]
    # Only texts with an equal pair of hashes are sorted; the sort compares the words.
    base = base.select(*names, "_words", "_lines", runs(F.col("_words"), 3).alias("_runs"))
    hashed = F.transform("_runs", lambda run: F.xxhash64(run))
    base = base.withColumn("_hashes", hashed)
    numbered = F.transform("_runs", lambda run, at: F.struct(run.alias("run"), at.alias("at")))
    again = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    none = F.expr("cast(array() as array<struct<run:struct<`0`:string,`1`:string,`2`:string>,at:int>>)")
    base = base.select(
        *names, "_words", "_lines", F.when(again, F.sort_array(numbered)).otherwise(none).alias("_sorted")
    )
    near = lambda one, at: (
        one["run"].eqNullSafe(F.get("_sorted", at - 1)["run"])
        | one["run"].eqNullSafe(F.get("_sorted", at + 1)["run"])
    )
    starts = F.transform("_sorted", lambda one, at: F.when(near(one, at), one["at"]))
    base = base.select(*names, "_words", "_lines", F.sort_array(F.array_compact(starts)).alias("_starts"))
    following = F.slice("_starts", 2, F.size("_starts"))
    steps = F.zip_with("_starts", following, lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    return base.select(
        *names,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(steps, F.lit(0), lambda total, step: total + step).cast("long").alias("n_repeat_words"),
    )


def statistics() -> list[Column]:
    """The transformed statistics in thousandths; a text without words has zeros."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    values = (
        F.log1p(F.col("n_words")) / 2,
        F.log1p(F.col("word_chars") / words) * 3,
        F.log1p(100 * F.col("n_symbols") / chars),
        F.log1p(100 * F.col("n_capitals") / chars),
        F.log1p(10 * F.col("n_dup_lines") / lines),
        F.log1p(10 * F.col("n_repeat_words") / words),
    )
    return [F.round(v * UNIT).cast("long").alias(f"x{i}") for i, v in enumerate(values)]


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def grouped(rows: DataFrame, least_rows: int) -> DataFrame:
    """``rows`` with ``group``: language and source, or a pool of small groups, or null.

    Groups below ``least_rows`` are pooled by language, small pools into one; rows of a
    last pool that is still too small have no group.
    """
    rows = rows.withColumns({"_lang": F.col("lang"), "_source": F.col("source")})
    sizes = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    own = F.when(F.col("n") >= least_rows, F.to_json(F.struct("lang", "source")))
    pooled = F.to_json(F.struct("lang"))
    by_lang = Window.partitionBy("lang", F.col("own").isNull())
    total = Window.partitionBy(F.col("named").isNull())
    named = (
        sizes.withColumn("own", own)
        .withColumn("in_pool", F.sum("n").over(by_lang))
        .withColumn("named", F.coalesce("own", F.when(F.col("in_pool") >= least_rows, pooled)))
        .withColumn("left", F.sum("n").over(total))
        .withColumn("group", F.coalesce("named", F.when(F.col("left") >= least_rows, F.lit("rest"))))
        .select(F.col("lang").alias("_l"), F.col("source").alias("_s"), "group")
    )
    same = F.col("_lang").eqNullSafe(F.col("_l")) & F.col("_source").eqNullSafe(F.col("_s"))
    return rows.join(named, same).drop("_l", "_s", "_lang", "_source")


def factored(means: list[Column], covariance: dict[tuple[int, int], Column]) -> list[Column]:
    """Means and the Cholesky factor of a covariance as columns m0, …, l00, l10, …"""
    return [m.alias(f"m{i}") for i, m in enumerate(means)] + [
        covariance[i, j].alias(f"c{i}{j}") for i, j in _PAIRS
    ]


def cholesky(estimates: DataFrame) -> DataFrame:
    """Key, means and factor of estimates (group, start, m.., c..), one column at a time."""
    for j in range(_DIM):
        for i in range(j, _DIM):
            value = F.col(f"c{j}{i}")
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            value = F.sqrt(F.greatest(value, F.lit(FLOOR**2))) if i == j else value / F.col(f"l{j}{j}")
            estimates = estimates.withColumn(f"l{i}{j}", value)
    factors = [f"l{i}{j}" for j in range(_DIM) for i in range(j, _DIM)]
    return estimates.select(*_KEY, *[f"m{i}" for i in range(_DIM)], *factors)


def with_distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """``rows`` of a group with their squared distance ``d2`` to its estimate, per ``start``."""
    joined = rows.join(estimates, "group")
    for i in range(_DIM):
        value = F.col(f"x{i}") / UNIT - F.col(f"m{i}")
        for k in range(i):
            value = value - F.col(f"l{i}{k}") * F.col(f"z{k}")
        joined = joined.withColumn(f"z{i}", value / F.col(f"l{i}{i}"))
    squares = [F.col(f"z{i}") * F.col(f"z{i}") for i in range(_DIM)]
    return joined.withColumn("d2", sum(squares[1:], squares[0])).select(*rows.columns, "start", "d2")


def _moments(columns: list[str]) -> list[Column]:
    """Sums and sums of products of integer columns."""
    sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate(columns)]
    return sums + [F.sum(F.col(columns[i]) * F.col(columns[j])).alias(f"q{i}{j}") for i, j in _PAIRS]


def _estimated(n: Column, scale: float) -> list[Column]:
    """Means, and the covariance times ``scale`` with the floor, of moments over ``n`` rows."""
    means = [F.col(f"s{i}") / n / UNIT for i in range(_DIM)]
    spread = {
        (i, j): scale * (F.col(f"q{i}{j}") / n / UNIT**2 - means[i] * means[j])
        + (FLOOR**2 if i == j else 0.0)
        for i, j in _PAIRS
    }
    return factored(means, spread)


def _first_estimates(rows: DataFrame) -> DataFrame:
    """Three starts per group; see the module.

    The statistics are thousandths, so there are few distinct values: these are counted
    first, in all tasks, and medians come from the counts. Spatial signs are thousandths
    as well.
    """
    values = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"x{i}").alias("x")) for i in range(_DIM)]))
    tally = rows.select("group", values.alias("v")).groupBy("group", "v.i", "v.x").agg(F.count(F.lit(1)).alias("n"))
    tally = materialize(tally, "quality-tally")
    middle = tally.groupBy("group", "i").agg(F.percentile("x", F.lit(0.5), F.col("n")).alias("m"))
    off = F.abs(F.col("x") - F.col("m"))
    wide = tally.join(middle, ["group", "i"]).groupBy("group", "i").agg(
        F.first("m").alias("m"), F.percentile(off, F.lit(0.5), F.col("n")).alias("s")
    )
    of = lambda c, i: F.max(F.when(F.col("i") == i, F.col(c))).alias(f"{c}{i}")
    off = wide.groupBy("group").agg(*[of(c, i) for c in "ms" for i in range(_DIM)])
    means = [F.col(f"m{i}") / UNIT for i in range(_DIM)]
    wide = [F.sqrt(F.pow(1.4826 * F.col(f"s{i}") / UNIT, 2) + FLOOR**2) for i in range(_DIM)]
    off = materialize(
        off.select("group", *[m.alias(f"m{i}") for i, m in enumerate(means)], *[w.alias(f"w{i}") for i, w in enumerate(wide)]),
        "quality-medians",
    )
    means = [F.col(f"m{i}") for i in range(_DIM)]
    alone = {(i, j): F.col(f"w{i}") * F.col(f"w{i}") if i == j else F.lit(0.0) for i, j in _PAIRS}
    medians = off.select("group", F.lit(0).alias("start"), *factored(means, alone))

    every = rows.groupBy("group").agg(F.count(F.lit(1)).alias("n"), *_moments([f"x{i}" for i in range(_DIM)]))
    every = every.select("group", F.lit(1).alias("start"), *_estimated(F.col("n"), 1.0))

    scaled = [((F.col(f"x{i}") / UNIT - F.col(f"m{i}")) / F.col(f"w{i}")).alias(f"z{i}") for i in range(_DIM)]
    signs = rows.join(off, "group").select("group", *scaled)
    squares = [F.col(f"z{i}") * F.col(f"z{i}") for i in range(_DIM)]
    signs = signs.withColumn("size", F.sqrt(sum(squares[1:], squares[0])))
    unit = [F.round(F.when(F.col("size") > 0, F.col(f"z{i}") / F.col("size")).otherwise(0) * UNIT).cast("long") for i in range(_DIM)]
    signs = signs.select("group", *[u.alias(f"u{i}") for i, u in enumerate(unit)])
    signs = signs.groupBy("group").agg(F.count(F.lit(1)).alias("n"), *_moments([f"u{i}" for i in range(_DIM)]))
    round_off = {
        (i, j): _DIM * F.col(f"q{i}{j}") / F.col("n") / UNIT**2 * F.col(f"w{i}") * F.col(f"w{j}")
        + (FLOOR**2 if i == j else 0.0)
        for i, j in _PAIRS
    }
    signs = signs.join(off, "group").select("group", F.lit(2).alias("start"), *factored(means, round_off))
    return cholesky(medians.unionByName(every).unionByName(signs))


def _concentrated(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """The estimates of the half of the rows nearest to the present estimates."""
    far = F.least(F.floor(F.log2(F.col("d2") + 1) * 128), F.lit(BINS - 1)).cast("int")
    bins = (
        with_distance(rows, estimates)
        .groupBy(*_KEY, far.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), *_moments([f"x{i}" for i in range(_DIM)]))
    )
    all_rows = Window.partitionBy(*_KEY)
    before = all_rows.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    half = F.least(F.floor((F.col("all") + _DIM + 1) / 2), F.col("all"))
    near = bins.withColumns(
        {"before": F.coalesce(F.sum("n").over(before), F.lit(0)), "all": F.sum("n").over(all_rows)}
    )
    near = near.withColumn("part", F.least(F.lit(1.0), (half - F.col("before")) / F.col("n"))).filter("part > 0")
    names = [*[f"s{i}" for i in range(_DIM)], *[f"q{i}{j}" for i, j in _PAIRS]]
    # Whole bins add up as integers; at most one bin has a part.
    whole = lambda c: F.coalesce(F.sum(F.when(F.col("part") >= 1, F.col(c))), F.lit(0))
    rest = lambda c: F.coalesce(F.sum(F.when(F.col("part") < 1, F.col(c) * F.col("part"))), F.lit(0.0))
    total = near.groupBy(*_KEY).agg(
        F.first(half).cast("double").alias("n"), *[(whole(c).cast("double") + rest(c)).alias(c) for c in names]
    )
    return cholesky(total.select(*_KEY, *_estimated(F.col("n"), CONSISTENCY)))


def robust_estimates(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """Start, mean and Cholesky factor per group of ``rows`` (group, x0, …): the least determinant."""
    estimates = materialize(_first_estimates(rows), "quality-estimates")
    for _ in range(steps):
        estimates = materialize(_concentrated(rows, estimates), "quality-estimates")
    logs = [F.log(f"l{i}{i}") for i in range(_DIM)]
    # Starts that end alike have the lowest number.
    names = [c for c in estimates.columns if c not in _KEY]
    ranked = F.struct(F.round(sum(logs[1:], logs[0]), 9).alias("size"), "start", *names)
    best = estimates.groupBy("group").agg(F.min(ranked).alias("best"))
    return materialize(best.select("group", "best.start", *[f"best.{c}" for c in names]), "quality-best")


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_rows: int = LEAST_ROWS,
    cutoff: float = CUTOFF,
) -> DataFrame:
    """(doc_id, counts, base_failed, kept, distance) of every row.

    ``base_failed``: under 50 words, or over half of the words in repeated windows. Other
    rows are kept unless the squared distance of their statistics to the estimate of their
    language and source exceeds ``cutoff``. Estimates rest on rows that pass the base
    rules. Products of two statistics stay below 4e8, so sums of integers hold for groups
    of 10^10 rows.

    Null and empty texts have no words and fail. Null languages and sources are values of
    their own. Groups below ``least_rows`` are pooled; where even all small groups
    together are too few, the base rules alone decide and ``distance`` is null. Repeated
    rows and ids are judged one by one. An empty table gives an empty table.
    """
    keep = [F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source")]
    rows = counted(docs, F.col(text_col), *keep).withColumn("base_failed", base_failed())
    rows = materialize(rows.select("*", *statistics()), "quality-counts")
    passed = materialize(grouped(rows.filter("not base_failed"), least_rows), "quality-groups")
    inside = passed.filter("group is not null")
    estimates = robust_estimates(inside.select("group", *[f"x{i}" for i in range(_DIM)]))
    judged = with_distance(inside, estimates)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    unknown = F.lit(None).cast("double").alias("distance")
    alone = passed.filter("group is null").select(*names, F.lit(True).alias("kept"), unknown)
    failed = rows.filter("base_failed").select(*names, F.lit(False).alias("kept"), unknown)
    judged = judged.select(*names, (F.col("d2") <= cutoff).alias("kept"), F.col("d2").alias("distance"))
    return judged.unionByName(alone).unionByName(failed)


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows that ``judge`` keeps, all columns as they are.

    Rows that share an id go only if each of them is rejected. Rows without id stay.
    """
    id_col = options.get("id_col", "doc_id")
    verdict = judge(docs, **options).groupBy("doc_id").agg(F.max("kept").alias("kept"))
    return without_ids(docs, verdict.filter("not kept").select("doc_id"), id_col)
