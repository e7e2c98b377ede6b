"""The three jobs, and a harness that tries any estimator on a table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from itertools import takewhile

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import HashingTF, Tokenizer, VectorAssembler, VectorIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from coppice.operators import features as feat
from coppice.operators import metrics
from coppice.operators.learners import WEIGHT, learner
from coppice.operators.rows import numbered, ranked, shuffled, stable_layout
from coppice.operators.small import localised
from coppice.operators.split import hash_split, sides, stratified_folds, stratified_split
from coppice.operators.weights import balanced_weights
from coppice.settings import TrainSettings
from coppice.sources.models import (
    check_contract,
    contract_of,
    load_contract,
    load_model,
    save_model,
)
from coppice.sources.registry import ModelRegistry, ModelVersion
from coppice.sources.tables import TableRef
from coppice.sources.workspace import shared_dir

ACCURACY = "Accuracy"
POSITIVE_SCORE = "positive_score"

#: Partitions of a scoring history.
HISTORY = (("model_name", "string"), ("model_version", "bigint"), ("batch", "string"))


@dataclass(frozen=True)
class Evaluation:
    """Results per model version, by label.

    ``accuracy`` is ``(model_version, accuracy)``, ``counts`` holds the non-empty cells of the matrix,
    and ``confusion`` the full grid of them, with names if they were given.
    """

    accuracy: DataFrame
    counts: DataFrame
    confusion: DataFrame


def split(df: DataFrame, label: str, keys: Sequence[str], settings: TrainSettings) -> DataFrame:
    """Flag training rows, by class or by key hash alone."""
    if settings.stratified:
        return stratified_split(df, label, keys, settings.fraction, settings.split_seed)
    return hash_split(df, keys, settings.fraction, settings.split_seed)


def fit(
    training: DataFrame,
    inputs: Sequence[str],
    label: str,
    stages: Sequence[feat.Stage],
    settings: TrainSettings,
) -> PipelineModel:
    """Fit a pipeline on the input columns and label, weighted by class if so set.

    The learners pass over their input many times. Leading stages without a fit, such as text
    hashing, run once, before the rows are kept; what is kept is checkpointed in a fixed layout, or
    held by the executors where no layout is asked for. Classes are counted on the kept rows, which
    spares a scan of the source.
    """
    shared_dir(training.sparkSession)
    ready = list(takewhile(lambda stage: not isinstance(stage, Estimator), stages))
    columns = [ready[-1].getOutputCol()] if ready else list(inputs)
    prepared = PipelineModel(ready).transform(training.select(*inputs, label))
    prepared = prepared.select(*columns, label)
    if settings.fit_partitions:
        kept = stable_layout(prepared, settings.fit_partitions)
    else:
        kept = prepared.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        balanced = settings.class_weight == "balanced"
        rows = balanced_weights(kept, label, WEIGHT) if balanced else kept
        fitted = feat.chain(stages[len(ready) :]).fit(rows)
    finally:
        kept.unpersist()
    return PipelineModel([*ready, *fitted.stages])


def tabular_pipeline(
    inputs: Sequence[str], label: str, settings: TrainSettings, estimator: Estimator | None = None
) -> list[feat.Stage]:
    """Index, assemble, detect categories, learn; a forest unless another estimator is given."""
    return [
        *feat.tabular_stages(
            inputs, label, settings.max_categories, settings.label_order, settings.invalid
        ),
        estimator or learner("forest", settings),
    ]


def text_pipeline(text: str, label: str, settings: TrainSettings) -> list[feat.Stage]:
    """Tokens, hashed counts, logistic regression."""
    return [
        *feat.text_stages(text, settings.text_features),
        feat.label_indexer(label, settings.label_order, settings.invalid),
        learner("logistic", settings),
    ]


def train(
    spark: SparkSession,
    source: TableRef | DataFrame,
    heldout: TableRef,
    registry: ModelRegistry,
    name: str,
    model_root: str,
    inputs: Sequence[str],
    label: str,
    keys: Sequence[str],
    settings: TrainSettings,
    stages: Sequence[feat.Stage] | None = None,
) -> ModelVersion:
    """Split, store the held-out rows, fit, store the model and its run, register a version.

    The source is scanned four times, twice for key and label only: write a frame that is costly to
    make to a table first.
    """
    table = source.read(spark) if isinstance(source, TableRef) else source
    training, rest = sides(split(table, label, keys, settings))
    heldout.write(rest)

    run_id = uuid.uuid4().hex
    pipeline = stages or tabular_pipeline(inputs, label, settings)
    model = fit(training, inputs, label, pipeline, settings)
    path = f"{model_root.rstrip('/')}/{name}/{run_id}"
    scored = predict(model, table.select(*inputs))
    outputs = contract_of(scored, [c for c in scored.columns if c not in inputs])
    save_model(model, path, contract_of(table, inputs), outputs)
    registry.log_run_params(run_id, settings.as_params())
    return registry.register_one(name, run_id, path)


def predict(model: PipelineModel, df: DataFrame, truth: bool = False) -> DataFrame:
    """All input columns and the pipeline's own, in types that every table format keeps.

    Vectors become arrays. Hashed text stays sparse, as its stored indices and values. Predictions
    are decoded with the model's own labels, as ``predicted_label``: codes mean different classes in
    different versions. The label is read only with ``truth``, which adds its code and its text,
    ``actual_label``.
    """
    indexer = feat.label_stage(model)
    scored = (model if truth else feat.without_label(model)).transform(df)
    if indexer is not None:
        unseen = [feat.UNSEEN] if indexer.getHandleInvalid() == "keep" else []
        scored = feat.decoded(scored, [*indexer.labels, *unseen])
        if truth:
            text = F.col(indexer.getInputCol()).cast("string")
            scored = scored.withColumn(feat.ACTUAL_LABEL, text)
    hashed = {stage.getOutputCol() for stage in model.stages if isinstance(stage, HashingTF)}
    vectors = [field.name for field in scored.schema if isinstance(field.dataType, VectorUDT)]
    return scored.withColumns(
        {c: F.unwrap_udt(c) if c in hashed else vector_to_array(F.col(c)) for c in vectors}
    )


def truth_and_prediction(scored: DataFrame) -> DataFrame:
    """Only the true and the predicted class code."""
    return scored.select(
        F.col(feat.INDEXED_LABEL).alias("y_test"), F.col(feat.PREDICTION).alias("y_pred")
    )


def score(
    spark: SparkSession,
    source: TableRef,
    sink: TableRef,
    registry: ModelRegistry,
    name: str,
    stage: str,
    mode: str = "overwrite",
    keep: Sequence[str] | None = None,
    truth: bool = False,
    batch: str | None = None,
    positive: str | None = None,
) -> ModelVersion:
    """Score a table with the model at a stage and write it with the model's name and version.

    New data needs no label, and one that it has is not looked at; ``truth`` indexes the label of
    rows that are to be judged. ``keep`` limits the columns written, and so those read;
    ``mode="append"`` collects a scoring history. Inputs and outputs are checked against the
    signature stored with the model.

    An append that runs again adds its rows again. With the name of a ``batch`` the sink is a history
    table (:func:`history_table`), and the job takes the place of what it wrote for that batch and
    model version before, whatever ``mode`` says. ``positive`` adds ``positive_score``, the
    probability of that label, for ROC curves.
    """
    found = registry.lookup(name, stage)
    table = source.read(spark)
    check_contract(table, load_contract(spark, found.source))
    model = load_model(found.source)
    scored = predict(model, table, truth)
    check_contract(scored, load_contract(spark, found.source, "outputs"), "output")
    if keep is not None:
        scored = scored.select(*keep, *(["probability"] if positive and "probability" not in keep else []))
    if positive is not None:
        scored = with_positive_score(model, scored, positive)
        scored = scored.select(*keep, POSITIVE_SCORE) if keep is not None else scored
    named = scored.withColumns(
        {"model_name": F.lit(found.name), "model_version": F.lit(found.version)}
    )
    if batch is None:
        sink.write(named, mode)
    else:
        sink.replace_partitions(named.withColumn("batch", F.lit(batch)))
    return found


@dataclass(frozen=True)
class Outcome:
    """What became of every row: ``accepted`` with the model's columns, ``rejected`` with reasons."""

    version: ModelVersion
    accepted: DataFrame
    rejected: DataFrame


def outcome_table(
    path: str | None = None, name: str | None = None, fmt: str = "parquet"
) -> TableRef:
    """A table with one partition for scored rows and one for those that could not be."""
    return TableRef(path, name, fmt, (("outcome", "string"),))


def _tests(model: PipelineModel, truth: bool) -> dict[str, tuple[list[tuple[Column, str]], object]]:
    """For each column that the model reads: what makes a value unusable, and a usable value."""
    found: dict[str, tuple[list[tuple[Column, str]], object]] = {}
    assembled = next((s for s in model.stages if isinstance(s, VectorAssembler)), None)
    indexed = next((s for s in model.stages if isinstance(s, VectorIndexerModel)), None)
    categories = indexed.categoryMaps if indexed is not None else {}
    for slot, c in enumerate(assembled.getInputCols() if assembled is not None else []):
        value = F.col(c).cast("double")
        tests = [(F.col(c).isNull(), f"null: {c}"), (F.isnan(value), f"not a number: {c}")]
        known = sorted(categories.get(slot, {}))
        if known:
            tests.append((~value.isin(*known), f"unknown: {c}"))
        found[c] = (tests, known[0] if known else 0.0)
    tokens = next((s for s in model.stages if isinstance(s, Tokenizer)), None)
    if tokens is not None:
        found[tokens.getInputCol()] = ([(F.col(tokens.getInputCol()).isNull(), f"null: {tokens.getInputCol()}")], "")
    labels = feat.label_stage(model)
    if truth and labels is not None:
        c = labels.getInputCol()
        unknown = ~F.col(c).cast("string").isin(*labels.labels)
        found[c] = ([(F.col(c).isNull(), f"null: {c}"), (unknown, f"unknown: {c}")], labels.labels[0])
    return found


def score_or_reject(
    spark: SparkSession,
    source: TableRef,
    sink: TableRef,
    registry: ModelRegistry,
    name: str,
    stage: str,
    truth: bool = False,
) -> Outcome:
    """Score the rows that can be, and keep the others with their reasons, in one pass and one write.

    A null or NaN input, a category the model has not seen, and with ``truth`` a null or unknown label
    stop :func:`score`, or make rows disappear where the pipeline skips them. Here such a row goes
    through the model with a usable value in the place of each bad one, and is then written as it came,
    without the model's columns. ``sink`` is an :func:`outcome_table`; accepted and rejected rows
    together are the input.
    """
    found = registry.lookup(name, stage)
    table = source.read(spark)
    check_contract(table, load_contract(spark, found.source))
    model = load_model(found.source)
    tests = _tests(model, truth)
    reasons = F.array_compact(
        F.array(
            *[
                reduce(lambda rest, t: F.when(t[0], F.lit(t[1])).otherwise(rest), reversed(each), F.lit(None))
                for each, _ in tests.values()
            ]
        )
    )
    kept = F.struct(*[F.col(c) for c in tests])
    judged = table.withColumns({"reasons": reasons, "_given": kept})
    usable = {
        c: F.when(reduce(lambda a, b: a | b, [F.coalesce(t, F.lit(False)) for t, _ in each]), F.lit(value).cast(table.schema[c].dataType))
        .otherwise(F.col(c))
        for c, (each, value) in tests.items()
    }
    scored = predict(model, judged.withColumns(usable), truth)
    good = F.size("reasons") == 0
    own = [c for c in scored.columns if c not in judged.columns]
    given = {c: F.col(f"_given.{c}") for c in tests}
    outcome = F.when(good, "accepted").otherwise("rejected")
    named = (
        scored.withColumns({**{c: F.when(good, F.col(c)) for c in own}, **given, "outcome": outcome})
        .drop("_given")
        .withColumns({"model_name": F.lit(found.name), "model_version": F.lit(found.version)})
    )
    sink.write(named)
    rows = sink.read(spark)
    accepted = rows.filter("outcome = 'accepted'").drop("outcome", "reasons")
    rejected = rows.filter("outcome = 'rejected'").select(
        *table.columns, "reasons", "model_name", "model_version"
    )
    return Outcome(found, accepted, rejected)


def history_table(
    path: str | None = None, name: str | None = None, fmt: str = "parquet"
) -> TableRef:
    """A scoring history with one partition for each model version and batch."""
    return TableRef(path, name, fmt, HISTORY)


def with_positive_score(model: PipelineModel, scored: DataFrame, positive: str) -> DataFrame:
    """Add the probability of one label, by the order that this model has the labels in."""
    labels = feat.model_labels(model)
    if positive not in labels:
        raise ValueError(f"the model knows no label {positive!r}; it knows {', '.join(labels)}")
    return scored.withColumn(POSITIVE_SCORE, F.col("probability")[labels.index(positive)])


def evaluate(
    spark: SparkSession,
    heldout: TableRef,
    scored: TableRef,
    registry: ModelRegistry,
    name: str,
    stage: str,
    scoring: bool = True,
    keep: Sequence[str] | None = None,
    actual: str = feat.ACTUAL_LABEL,
    predicted: str = feat.PREDICTED_LABEL,
    names: DataFrame | None = None,
) -> Evaluation:
    """Score the held-out rows unless that is done, then judge every version in the scored table.

    One aggregation covers the whole scoring history, and all results come from its counts. Cells are
    labels, not codes; ``names(label, name)`` adds class names to the matrix. The accuracy is logged
    under the run of each version.
    """
    if scoring:
        score(spark, heldout, scored, registry, name, stage, keep=keep, truth=True)
    history = scored.read(spark).filter(F.col("model_name") == name)
    by = ["model_version"]
    counts = localised(metrics.confusion_counts(history, actual, predicted, by))
    accuracy = metrics.accuracy_from_counts(counts, by)
    logged = accuracy.withColumnRenamed("accuracy", "value").withColumn("key", F.lit(ACCURACY))
    registry.log_version_metrics(name, logged)
    confusion = metrics.matrix_from_counts(counts, by=by)
    if names is not None:
        confusion = metrics.confusion_named(confusion, names)
    return Evaluation(accuracy, counts, confusion)


def fit_and_test(
    df: DataFrame,
    estimator: Estimator,
    inputs: Sequence[str],
    label: str,
    keys: Sequence[str],
    settings: TrainSettings,
) -> tuple[DataFrame, DataFrame]:
    """Stratified split, fit any estimator, predict the held-out rows.

    Returns the scored rows and their accuracy. The estimator reads the columns that
    ``tabular_pipeline`` makes: ``indexedLabel`` and ``indexedFeatures`` or ``features``.
    """
    training, rest = sides(split(df, label, keys, settings.but(stratified=True)))
    pipeline = tabular_pipeline(inputs, label, settings, estimator)
    scored = predict(fit(training, inputs, label, pipeline, settings), rest, truth=True)
    return scored, metrics.accuracy(scored, feat.INDEXED_LABEL, feat.PREDICTION)


def cross_validate(
    df: DataFrame,
    estimator: Estimator,
    inputs: Sequence[str],
    label: str,
    keys: Sequence[str],
    settings: TrainSettings,
    folds: int = 5,
    at_once: int = 2,
) -> tuple[DataFrame, DataFrame]:
    """Fit on all folds but one and predict that one, for every fold; every row is held out once.

    Returns the scored rows with their ``fold``, and ``(fold, n, accuracy)``. What the fits read is
    stored once, with its folds; ``at_once`` fits run side by side, each on a copy of the estimator.
    """
    slim = df.select(*dict.fromkeys([*keys, *inputs, label]))
    rows = localised(stratified_folds(slim, label, keys, folds, settings.split_seed))

    def held_out(fold: int) -> DataFrame:
        here = F.col("fold") == fold
        pipeline = tabular_pipeline(inputs, label, settings, estimator.copy())
        model = fit(rows.filter(~here), inputs, label, pipeline, settings)
        return predict(model, rows.filter(here), truth=True)

    with ThreadPoolExecutor(at_once) as pool:
        parts = list(pool.map(held_out, range(folds)))
    scored = reduce(DataFrame.unionByName, parts)
    right = (F.col(feat.INDEXED_LABEL) == F.col(feat.PREDICTION)).cast("double")
    return scored, scored.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.avg(right).alias("accuracy"))


def permutation_importance(
    model: PipelineModel,
    df: DataFrame,
    inputs: Sequence[str],
    keys: Sequence[str],
    repeats: int = 3,
    seed: int = 42,
) -> DataFrame:
    """``(feature, importance, spread)`` of any model: the accuracy lost when a column is exchanged.

    Rows are numbered in the order of a key hash, and row r takes the column from the row a fixed number
    of places further on, around the end. One join brings the inputs of that row; a row is then
    predicted as it is and once with each column exchanged, all in one pass. ``spread`` is the
    standard deviation over the repeats. Rows without a label count nowhere.
    """
    label = feat.label_stage(model).getInputCol()
    labelled = df.filter(F.col(label).isNotNull()).select(*keys, *inputs, label)
    placed = localised(numbered(shuffled(labelled, keys, seed), "_place"))
    total = placed.count()
    shifts = [max(1, total * (i + 1) // (repeats + 1)) for i in range(repeats)]
    other = placed.select(
        F.col("_place").alias("_from"), F.struct(*inputs).alias("_other")
    )
    moved = placed.select("*", F.posexplode(F.array(*[F.lit(s) for s in shifts])).alias("_repeat", "_shift"))
    source = (F.col("_place") - 1 + F.col("_shift")) % max(1, total) + 1
    paired = moved.withColumn("_from", source).join(other, "_from")
    variants = [
        F.struct(
            F.lit(exchanged).alias("_feature"),
            *[(F.col(f"_other.{c}") if c == exchanged else F.col(c)).alias(c) for c in inputs],
        )
        for exchanged in (None, *inputs)
    ]
    rows = paired.select(label, "_repeat", F.inline(F.array(*variants)))
    scored = model.transform(rows)
    right = (F.col(feat.INDEXED_LABEL) == F.col(feat.PREDICTION)).cast("double")
    shares = localised(scored.groupBy("_repeat", "_feature").agg(F.avg(right).alias("_share")))
    whole = shares.filter("_feature IS NULL").select("_repeat", F.col("_share").alias("_whole"))
    lost = shares.filter("_feature IS NOT NULL").join(whole, "_repeat")
    loss = F.col("_whole") - F.col("_share")
    return ranked(
        lost.groupBy(F.col("_feature").alias("feature")).agg(
            F.avg(loss).alias("importance"), F.stddev_pop(loss).alias("spread")
        ),
        "importance",
        "feature",
    )
