"""The registered queries of the corpus operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

import corpus_pipeline
from wardlight.llm import (
    byte_pairs, centroids, decontaminate, licences, line_dedup, mixing, near_dedup, oracle, pairwise_quality,
    quality_rules, substring_dedup, suffix_dedup, url_filter,
    word_runs,
)
from wardlight.llm.common import read_table, stored, words


# The rules of the URL query: verdict, host, path.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_found", "licences"
    )


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    rows = stored(pairwise_quality.with_figures(docs, ("doc_id",)), "quality-figures")
    model = pairwise_quality.fit_figures(
        rows, labels.where(~pairwise_quality.held_out(F.col("doc_id"))))
    return pairwise_quality.score_figures(rows, model).select(
        "row.doc_id", pairwise_quality.held_out(F.col("row.doc_id")).alias("held_out"),
        "score", "predicted",
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.find_overlaps(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    ))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "n_shingles"
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.match_rules(
        read_table(spark, sf_dir, "pages"), url_filter.rule_table(spark, URL_RULES)
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    judged = quality_rules.judge(docs, quality_rules.fit_thresholds(docs, labels))
    return judged.select("row.doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.find_recurring(read_table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"),
                        "dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))


def op11_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = byte_pairs.load(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = byte_pairs.encode(read_table(spark, sf_dir, "documents"), vocabulary)
    return byte_pairs.decode(encoded, vocabulary).select(
        "row.doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def looped(text: Column, doc_id: Column) -> Column:
    """The text of op12: where the id's checksum ends in 0, from some word on a loop."""
    check = F.crc32(doc_id.cast("string"))
    deal = F.floor(check / 10)

    def loop(found: Column) -> Column:
        n = F.greatest(F.size(found), F.lit(1))
        start = (deal % n).cast("int")
        period = (1 + F.floor((n - start) / (3 + deal % 8))).cast("int")
        return F.transform(found, lambda word, i: F.when(
            i >= start, F.get(found, start + (i - start) % period)).otherwise(word))

    # The one-element array binds the words to a name, so that they are split once.
    made = F.transform(F.array(words(text)), lambda found: F.array_join(loop(found), " "))
    return F.when(check % 10 == 0, F.get(made, F.lit(0))).otherwise(text)


def op12_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", looped(F.col("text"), F.col("doc_id")).alias("text"))
    best = F.aggregate(
        "runs", F.get("runs", F.lit(0)), lambda top, run: F.when(
            run["length"] * top["period"] > top["length"] * run["period"], run).otherwise(top))
    lines = F.transform("runs", lambda run: F.concat_ws(
        ",", run["start"], run["length"], F.concat(run["period"], F.lit("\n"))))
    return word_runs.find_runs(docs).withColumn("best", best).select(
        "row.doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read_table(spark, sf_dir, "embeddings")).select(
        "row.vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licence_scan": op1_licence_scan,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_mixing": op3_mixing,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_near_dedup": op6_near_dedup,
    "op7_url_filter": op7_url_filter,
    "op8_quality_rules": op8_quality_rules,
    "op9_line_dedup": op9_line_dedup,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_byte_pairs": op11_byte_pairs,
    "op12_word_runs": op12_word_runs,
    "op13_centroids": op13_centroids,
    "pipeline": corpus_pipeline.run,
}
ORACLE_SQL: dict[str, str] = {
    "op3_mixing": oracle.MIXING,
    "op4_suffix_dedup": oracle.SUFFIX_DEDUP,
    "op5_decontamination": oracle.DECONTAMINATION,
    "op7_url_filter": oracle.URL_FILTER,
    "op8_quality_rules": oracle.QUALITY_RULES,
    "op10_substring_dedup": oracle.SUBSTRING_DEDUP,
    "op12_word_runs": oracle.WORD_RUNS,
    "op13_centroids": oracle.CENTROIDS,
}
