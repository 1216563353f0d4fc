"""The operators as registered queries, each over its whole table with production parameters.

Query N is opN_<name>; contracts are in the README. ``sql.py`` holds their SQL counterparts.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import (
    bpe, class_lm, divergence, fm_index, id_store, language_id, near_dedup, quality, spelling,
    substrings, unigram, url_rules, warc,
)
from shelfmark.llm.tables import table


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeats(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
    )


def op4_id_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = id_store.write_and_read(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.verdicts(table(spark, sf_dir, "pages"))


def op6_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.scores(
        table(spark, sf_dir, "documents"), "crc32(encode(cast(doc_id AS string), 'UTF-8')) % 7 = 2"
    )


def op7_unigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces, byte_pieces = unigram.pieces_of(public_tokenizers.path("piece_bpe_32k.model"))
    return unigram.token_counts(table(spark, sf_dir, "documents"), pieces, byte_pieces)


def op8_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality.judge(docs).drop("lang", "source")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fm_index.occurrences(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    inside = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return found.select(
        "doc_id", "n_words", inside.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (inside > 0).alias("contaminated"),
    )


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict(
        table(spark, sf_dir, "documents"),
        "crc32(encode(coalesce(cast(doc_id AS string), ''), 'UTF-8')) % 5 = 0",
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_near_dedup, op2_substrings, op3_byte_bpe, op4_id_store, op5_url_rules, op6_class_lm,
        op7_unigram_counts, op8_outliers, op9_warc, op10_decontamination, op11_language_id,
        op12_spelling_variants, op13_source_divergence,
    )
}
