"""The registered queries of the subpackage, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgraph.llm.sql import SQL  # noqa: F401


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Licence of each document, its own or inherited.

    The table has no paths, so a document lies at source/language/thousand/hundred, and
    the one whose id ends a hundred is the licence file of its directory, or of the
    directory above where the id ends a thousand.
    """
    from corpusgraph.llm.licenses import scan_licenses

    folder = F.concat_ws("/", "source", "lang", F.expr("doc_id div 1000"))
    inner = F.concat_ws("/", folder, F.expr("doc_id div 100"))
    doc = F.col("doc_id")
    path = (
        F.when(doc % 1000 == 999, F.concat_ws("/", folder, F.concat(F.lit("LICENSE-"), doc)))
        .when(doc % 100 == 99, F.concat_ws("/", inner, F.concat(F.lit("LICENSE-"), doc)))
        .otherwise(F.concat_ws("/", inner, F.concat(F.lit("file-"), doc)))
    )
    files = _table(spark, sf, "documents").select(path.alias("path"), "text")
    found = scan_licenses(files)
    number = lambda c: F.element_at(F.split(c, "-"), -1).cast("long")
    return found.select(
        number("path").alias("doc_id"),
        "license",
        F.round("similarity", 6).alias("similarity"),
        number("declared_in").alias("declared_in"),
    )


def op2_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Lines removed per document, and a digest of the text that is left."""
    from corpusgraph.llm.lines import remove_repeated_lines

    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return remove_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


def op4_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark words and items per document."""
    from corpusgraph.llm.contamination import contamination, is_contaminated

    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return contamination(docs, _table(spark, sf, "benchmark")).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def op3_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprint and component of near-duplicates per document."""
    from corpusgraph.llm.simhash import near_duplicates

    return near_duplicates(_table(spark, sf, "documents").select("doc_id", "text"))


def op5_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    """Log probabilities of each document under the model and under counts alone."""
    from corpusgraph.llm.language_model import score

    return score(_table(spark, sf, "documents").select("doc_id", "text"))


def op6_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Where the token ids of each document lie in sequences of 2,048."""
    import public_tokenizers

    from corpusgraph.llm.packing import pack

    docs = _table(spark, sf, "documents").select("doc_id", "text")
    path = public_tokenizers.path
    return pack(docs, path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken")).drop("ids")


def op7_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """Shard and place of each document, near equal in bytes, and its virtual slot.

    Version 1 of the map deals slots in turn; the rows lie by version 2, edited for their bytes.
    """
    from corpusgraph.llm.shards import assign_shards, even_map, save_map
    from corpusgraph.sources.scratch import scratch_dir

    path = scratch_dir(spark, "slot-map")
    save_map(spark, path, even_map(16))
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return assign_shards(docs, map_path=path).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("position").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("slot").alias("virtual_slot"),
    )


def op8_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Counts and verdict per document."""
    from corpusgraph.llm.quality import judge

    return judge(_table(spark, sf, "documents").select("doc_id", "text", "lang", "source"))


def op9_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Words left per document after removing repeated windows of 13 words."""
    from corpusgraph.llm.substrings import remove_repeated_windows

    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return remove_repeated_windows(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op10_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Write all pages as an archive, read it back, and tell each page's record."""
    from corpusgraph.llm.warc import read_archive, write_archive
    from corpusgraph.sources.scratch import scratch_dir

    folder = scratch_dir(spark, "warc")
    write_archive(_table(spark, sf, "pages").select("page_id", "url", "html"), folder)
    return read_archive(spark, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op11_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes and tokens of each document."""
    import public_tokenizers

    from corpusgraph.llm.token_counts import count_tokens

    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


def planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; from some word on, a tenth of the texts repeats itself.

    With h the CRC-32 of the id and g = h div 10, those are the texts with h mod 10 = 0 and
    n > 0 words. Word i >= a = g mod n becomes word a + (i - a) mod p, where
    p = 1 + (n - a) div (3 + g mod 8).
    """
    from corpusgraph.llm.native import space_words

    code = F.crc32(F.col("doc_id").cast("string"))
    chosen = docs.select("doc_id", "text", code.alias("h"))
    word_list = F.when(F.col("h") % 10 == 0, space_words(F.col("text")))
    g = F.expr("h div 10")
    split = chosen.select("doc_id", "text", g.alias("g"), word_list.alias("words"))
    n = F.size("words")
    start = split.withColumn("a", F.when(n > 0, F.col("g") % n))
    left = n - F.col("a")
    period = start.withColumn("p", F.lit(1) + F.floor(left / (F.lit(3) + F.col("g") % 8)))
    place = F.expr("transform(sequence(a, size(words) - 1), i -> words[int(a + (i - a) % p)])")
    repeated = F.array_join(F.concat(F.expr("slice(words, 1, int(a))"), place), " ")
    text = F.when(F.col("p").isNotNull(), repeated).otherwise(F.col("text"))
    return period.select("doc_id", text.alias("text"))


def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The strongest run of each document, and digests of all runs and of the words left."""
    from corpusgraph.llm.periodic_runs import periodic_runs

    docs = _table(spark, sf, "documents").select("doc_id", "text")
    found = periodic_runs(planted_periods(docs))
    # The greatest exact quotient of length and period first, then start, then period.
    ranked = F.expr(
        """array_sort(runs, (x, y) -> case
            when x.length * y.period > y.length * x.period then -1
            when x.length * y.period < y.length * x.period then 1
            when x.start < y.start then -1 when x.start > y.start then 1
            when x.period < y.period then -1 when x.period > y.period then 1
            else 0 end)"""
    )
    lines = F.expr(
        "transform(runs, x -> concat(concat_ws(',', x.start, x.length, x.period), chr(10)))"
    )
    listed = F.array_join(lines, "")
    best = F.when(F.size("runs") > 0, F.element_at(ranked, 1))
    named = found.withColumn("best", best)
    return named.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_tokenizer_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """Groups and links of the tokens of two tokenizers per document."""
    import public_tokenizers

    from corpusgraph.llm.alignment import align

    path = public_tokenizers.path
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return align(docs, path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_line_dedup": op2_line_dedup,
    "op4_decontamination": op4_decontamination,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_packing": op6_packing,
    "op7_sharding": op7_sharding,
    "op8_quality_rules": op8_quality_rules,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_warc": op10_warc,
    "op11_token_counts": op11_token_counts,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}
