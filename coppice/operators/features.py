"""Feature stages of the pipelines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import (
    HashingTF,
    IndexToString,
    StringIndexer,
    StringIndexerModel,
    Tokenizer,
    VectorAssembler,
    VectorIndexer,
    VectorIndexerModel,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coppice.operators.rows import numbered
from coppice.operators.small import join_on, localised

Stage = Estimator | Transformer

# Column names of the scored table.
INDEXED_LABEL = "indexedLabel"
FEATURES = "features"
INDEXED_FEATURES = "indexedFeatures"
PREDICTION = "prediction"
WORDS = "words"

# Names of the decoded classes, and the class of labels unseen at the fit.
ACTUAL_LABEL = "actual_label"
PREDICTED_LABEL = "predicted_label"
UNSEEN = "__unknown"


def label_indexer(
    label: str, order: str = "alphabetAsc", invalid: str = "error", output: str = INDEXED_LABEL
) -> StringIndexer:
    """Class codes 0…k-1. Labels sort as text; ``frequencyDesc`` ranks by count, ties by text."""
    return StringIndexer(
        inputCol=label, outputCol=output, stringOrderType=order, handleInvalid=invalid
    )


def assembler(columns: Sequence[str], invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=FEATURES, handleInvalid=invalid)


def category_indexer(max_categories: int = 4, invalid: str = "error") -> VectorIndexer:
    """Treat slots with at most ``max_categories`` distinct values as categorical."""
    return VectorIndexer(
        inputCol=FEATURES,
        outputCol=INDEXED_FEATURES,
        maxCategories=max_categories,
        handleInvalid=invalid,
    )


def tabular_stages(
    columns: Sequence[str],
    label: str,
    max_categories: int = 4,
    label_order: str = "alphabetAsc",
    invalid: str = "error",
) -> list[Stage]:
    return [
        label_indexer(label, label_order, invalid),
        assembler(columns, invalid),
        category_indexer(max_categories, invalid),
    ]


def text_stages(text: str, features: int = 1 << 18) -> list[Stage]:
    """Lower-cased whitespace tokens, then their hashed counts."""
    return [
        Tokenizer(inputCol=text, outputCol=WORDS),
        HashingTF(inputCol=WORDS, outputCol=FEATURES, numFeatures=features),
    ]


def chain(stages: Sequence[Stage]) -> Pipeline:
    return Pipeline(stages=list(stages))


def stage_of(model: PipelineModel, kind: type) -> object:
    """The one stage of a fitted pipeline that has this type."""
    found = [s for s in model.stages if isinstance(s, kind)]
    if len(found) != 1:
        raise ValueError(f"expected one {kind.__name__} in the pipeline, found {len(found)}")
    return found[0]


def vector_slots(vector: str, names: Sequence[str]) -> list[Column]:
    """The slots of an assembled vector as columns."""
    slots = vector_to_array(F.col(vector))
    return [slots[i].alias(name) for i, name in enumerate(names)]


def vector_total(vector: str) -> Column:
    """Sum of the stored values of a vector; a sparse vector is not expanded."""
    values = F.unwrap_udt(F.col(vector)).getField("values")
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def category_counts(model: VectorIndexerModel, names: Sequence[str]) -> Mapping[str, int]:
    """Number of categories for each slot the indexer found to be categorical."""
    return {names[slot]: len(values) for slot, values in model.categoryMaps.items()}


def decoded(df: DataFrame, labels: Sequence[str], output: str = PREDICTED_LABEL) -> DataFrame:
    """Turn predicted codes back into the labels the model was trained on."""
    return IndexToString(inputCol=PREDICTION, outputCol=output, labels=list(labels)).transform(df)


def model_labels(model: PipelineModel) -> list[str]:
    return list(stage_of(model, StringIndexerModel).labels)


def label_stage(model: PipelineModel) -> StringIndexerModel | None:
    """The stage that codes the label, if the pipeline has one."""
    found = [s for s in model.stages if isinstance(s, StringIndexerModel)]
    return next((s for s in found if s.getOutputCol() == INDEXED_LABEL), None)


def without_label(model: PipelineModel) -> PipelineModel:
    """The pipeline for rows whose label is missing or of no interest."""
    indexer = label_stage(model)
    return PipelineModel([s for s in model.stages if s is not indexer])


def attach_names(df: DataFrame, label: str, names: DataFrame) -> DataFrame:
    """Left join to a ``(label, name, …)`` table with one row per class."""
    return join_on(df, localised(names), [label], "left")


#: Labels of at least one row in so many are looked up by broadcast; there are no more than this.
FREQUENT = 1000


def label_dictionary(df: DataFrame, label: str, order: str = "alphabetAsc") -> DataFrame:
    """``(label, index, n)`` for any number of labels, in the order of :func:`label_indexer`.

    Labels are counted in every task before they move, and ranked by a range sort: no task and no
    driver sees all of them. The table is stored.
    """
    text = F.col(label).cast("string").alias("label")
    counts = df.filter(F.col(label).isNotNull()).groupBy(text).agg(F.count(F.lit(1)).alias("n"))
    kinds = {
        "alphabetAsc": [F.asc("label")],
        "alphabetDesc": [F.desc("label")],
        "frequencyDesc": [F.desc("n"), F.asc("label")],
        "frequencyAsc": [F.asc("n"), F.asc("label")],
    }
    placed = numbered(localised(counts).orderBy(*kinds[order]), "_place")
    index = (F.col("_place") - 1).cast("double").alias("index")
    return localised(placed.select("label", index, "n"))


def with_label_index(
    df: DataFrame,
    dictionary: DataFrame,
    label: str,
    output: str = INDEXED_LABEL,
    invalid: str = "error",
) -> DataFrame:
    """Add the index of every row's label, for dictionaries of any size.

    A label that many rows have would fill one task of a join. Labels of at least one row in
    ``FREQUENT`` of those counted, and there are at most ``FREQUENT`` of these, are joined by broadcast;
    the other rows, none of which has more than that share, meet the rest of the dictionary by shuffle.
    A null or unknown label is an error, or gets the next index (``keep``), or goes (``skip``).
    """
    total, size = dictionary.agg(F.sum("n"), F.count(F.lit(1))).first()
    frequent = localised(dictionary.filter(F.col("n") * FREQUENT >= F.lit(total or 0)))
    names = {"label": "_known", "index": output}
    sides = [part.select(*[F.col(k).alias(v) for k, v in names.items()]) for part in (frequent, dictionary)]
    is_label = F.col(label).cast("string") == F.col("_known")
    often = df.join(F.broadcast(sides[0]), is_label, "left")
    found = often.filter(F.col("_known").isNotNull())
    rest = often.filter(F.col("_known").isNull()).drop("_known", output)
    indexed = found.unionByName(rest.join(sides[1], is_label, "left"))
    if invalid == "skip":
        indexed = indexed.filter(F.col("_known").isNotNull())
    elif invalid == "keep":
        indexed = indexed.withColumn(output, F.coalesce(output, F.lit(float(size))))
    else:
        message = F.concat(F.lit("unknown label: "), F.coalesce(F.col(label).cast("string"), F.lit("null")))
        checked = F.when(F.col("_known").isNotNull(), F.col(output)).otherwise(F.raise_error(message))
        indexed = indexed.withColumn(output, checked)
    return indexed.select(*df.columns, output)
