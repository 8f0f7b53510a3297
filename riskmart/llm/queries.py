"""The operators as queries over the given tables, and the SQL that checks them where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm import ann, decontam, langid, line_dedup, packing, periodic, repeat_dedup, simhash, spelling, substring_dedup, token_counts, token_files, toxicity
from riskmart.llm.tables import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(table(spark, sf_dir, "documents"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.selectExpr("doc_id", "lpad(lower(hex(fp)), 16, '0') AS fingerprint", "component_id")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_held_out(table(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_held_out(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), "id % 20 = 0")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text: in every tenth document by its crc32 the words from some place on repeat a stretch of them."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("h", F.crc32(F.col("doc_id").cast("string")))
    docs = docs.withColumn("w", F.expr(r"CASE WHEN h % 10 = 0 THEN regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0) END"))
    docs = docs.withColumn("a", F.expr("CASE WHEN size(w) > 0 THEN CAST(h div 10 % size(w) AS int) END"))
    docs = docs.withColumn("p", F.expr("CAST(1 + (size(w) - a) div (3 + h div 10 % 8) AS int)"))
    repeated = "concat(slice(w, 1, a), transform(sequence(a, size(w) - 1), i -> w[a + (i - a) % p]))"
    return docs.select("doc_id", F.expr(f"CASE WHEN a IS NULL THEN text ELSE array_join({repeated}, ' ') END").alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    longest = "aggregate(runs, CAST(NULL AS struct<start: bigint, length: bigint, period: bigint>), (a, r) -> IF(a IS NULL OR r.length * a.period > a.length * r.period, r, a))"
    listed = r"array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\n'), '')"
    found = found.selectExpr("*", f"{longest} AS best")
    return found.selectExpr(
        "doc_id",
        "CAST(size(runs) AS bigint) AS n_runs",
        "best.start",
        "best.length",
        "best.period",
        "1000 * best.length div best.period AS exponent_milli",
        f"sha2({listed}, 256) AS runs_sha256",
        "sha2(collapsed, 256) AS collapsed_sha256",
    )


def with_lost_letters(runs: DataFrame) -> DataFrame:
    """word: every 199th run by the crc32 of its document and itself lost one code point."""
    runs = runs.withColumn("h", F.expr("crc32(concat(CAST(doc_id AS string), ':', word))"))
    at = "CAST(h % char_length(word) AS int)"
    lost = f"concat(left(word, {at}), substring(word, {at} + 2))"
    return runs.select(F.expr(f"CASE WHEN h % 199 = 0 THEN {lost} ELSE word END").alias("word"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_lost_letters(spelling.letter_runs(table(spark, sf_dir, "documents")))
    long = found.where(F.char_length("word") >= spelling.LEAST_CHARS)
    return spelling.variants(long.groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_dedup.digests(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_line_dedup,
        op3_simhash_near_dedup,
        op4_token_files,
        op5_language_id,
        op6_benchmark_decontamination,
        op7_toxicity,
        op8_token_counts,
        op9_nearest_neighbours,
        op10_packing,
        op11_periodic_runs,
        op12_spelling_variants,
        op13_suffix_array_dedup,
    )
}
CHECKS: dict[str, str] = {}
