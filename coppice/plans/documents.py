"""A labelled feature table from raw text: document shape against a quality label."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.operators.features import FEATURES

INPUTS = ["n_chars", "n_words", "distinct_ratio", "nonalpha_ratio"]
LABEL = "quality"
KEYS = ["doc_id"]


def shape_features(documents: DataFrame) -> DataFrame:
    """Four numbers per document, made before any join so that text is never shuffled."""
    counted = documents.select(
        "doc_id",
        F.split("text", r"\s+").alias("words"),
        F.length(F.regexp_replace("text", "[A-Za-z ]+", "")).alias("n_other"),
        "n_chars",
    )
    # A split has at least one element, an empty one for an empty text.
    return counted.select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size("words").cast("double").alias("n_words"),
        (F.size(F.array_distinct("words")) / F.size("words")).alias("distinct_ratio"),
        F.coalesce(F.try_divide("n_other", "n_chars"), F.lit(0.0)).alias("nonalpha_ratio"),
    )


def labelled_shapes(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", LABEL).join(shape_features(documents), "doc_id")


def labelled_hashes(documents: DataFrame, labels: DataFrame, hashing: PipelineModel) -> DataFrame:
    """Hashed counts of the labelled texts, made before the join so that text is never shuffled."""
    counted = hashing.transform(documents.select("doc_id", "text")).select("doc_id", FEATURES)
    return labels.select("doc_id", LABEL).join(counted, "doc_id")
