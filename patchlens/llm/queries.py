"""One query per operator over the whole given tables, and SQL twins where SQL can say it."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchlens.llm import (
    jaccard_join,
    language,
    line_dedup,
    lsh_forest,
    oracle,
    packing,
    positional_index,
    rtree,
    secret_scan,
    suffix_dedup,
    token_counts,
    toxicity,
    vantage_trees,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {
    "op5_ngram_jaccard_join": oracle.JACCARD,
    "op9_benchmark_decontamination": oracle.DECONTAMINATION,
    "op12_hard_negatives": oracle.HARD_NEGATIVES,
}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op9_benchmark_decontamination(spark, sf_dir):
    found = positional_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query
def op5_ngram_jaccard_join(spark, sf_dir):
    found = jaccard_join.link_components(table(spark, sf_dir, "documents"), words=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op10_language_id(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op1_toxicity(spark, sf_dir):
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_suffix_dedup(spark, sf_dir):
    kept = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_packing(spark, sf_dir):
    return packing.pack_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op4_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op7_line_dedup(spark, sf_dir):
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", "text")


@query
def op3_approximate_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return lsh_forest.nearest(vectors, vectors.where("vec_id % 50 = 0"), k=5)


@query
def op2_secret_scan(spark, sf_dir):
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    base = F.col("base")
    return found.select(
        "doc_id",
        *(secret_scan.count_kind(base, k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(secret_scan.as_text(base), 256).alias("base_sha256"),
        secret_scan.as_text(F.col("spans")).alias("spans"),
    )


@query
def op11_simhash_near_dedup(spark, sf_dir):
    return vantage_trees.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op13_embedding_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op12_hard_negatives(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    found = rtree.hard_negatives(vectors, vectors.where("vec_id % 100 = 0"))
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
