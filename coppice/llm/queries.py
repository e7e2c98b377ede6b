"""One query per operator of this folder over its whole table, and the SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coppice.llm import (
    bpe,
    chunks,
    exact_dedup,
    kdtree,
    mixing,
    periodic,
    preference,
    quality,
    resampling,
    simhash,
    templates,
    toxicity,
    trie,
)
from coppice.llm.text import stored

#: Added to the share of good labels, so that a good document is rarely dropped.
MARGIN = 0.03

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary())


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fitted(docs, table(spark, sf_dir, "labels")))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.extracted(table(spark, sf_dir, "pages"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op5_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stored(preference.clean_turns(table(spark, sf_dir, "conversations")), "turns")
    return preference.paired_rows(turns)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.marked_copies(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.repeated_passages(table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows labelled good are the target; their share among the labelled, and a bit, is kept."""
    labels = table(spark, sf_dir, "labels").filter(F.col("quality").isin(0, 1))
    share = labels.agg(F.avg("quality")).first()[0] or 0.0
    settings = resampling.ResampleSettings(share=min(1.0, share + MARGIN))
    good = labels.filter("quality = 1")
    return resampling.resampled(table(spark, sf_dir, "documents"), good, settings)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op11_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.highest_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic.with_planted_repeats(table(spark, sf_dir, "documents"))
    return periodic.digested(periodic.period_runs(docs))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_bpe,
        op2_toxicity,
        op3_html_extraction,
        op4_mixing,
        op5_preference,
        op6_quality_rules,
        op7_exact_dedup,
        op8_substring_dedup,
        op9_quality_classifier,
        op10_simhash,
        op11_exact_topk,
        op12_prefix_trie,
        op13_periodic_runs,
    )
}
