"""One query per operator, each over whole tables of a data folder.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame. Queries that store something
write below the shared folder and return what they read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coppice.functions.columns import cast_columns, class_name, equals_all
from coppice.operators import features as feat
from coppice.operators import metrics
from coppice.operators.learners import feature_ranking as ranking_of
from coppice.operators.learners import learner
from coppice.operators.rows import first_shuffled, latest_per_key, numbered, ranked
from coppice.operators.rows import preview as first_rows
from coppice.operators.rows import shuffled as shuffled_table
from coppice.operators.split import hash_split, sides
from coppice.operators.split import stratified_folds as folds_by_class
from coppice.operators.split import stratified_split as split_by_class
from coppice.operators.timelines import as_of, spans
from coppice.operators.weights import balanced_weights as with_balanced_weights
from coppice.plans import jobs
from coppice.plans.documents import INPUTS, KEYS, LABEL, labelled_hashes, labelled_shapes
from coppice.plans.history import counts_table, evaluate_new_batches
from coppice.settings import FULL_FOREST, SMALL_FOREST, TrainSettings
from coppice.sources.models import load_contract, load_model, save_model
from coppice.sources.registry import ModelRegistry, stage_timeline
from coppice.sources.tables import TableRef
from coppice.sources.workspace import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

ORDER_STATUS = {"F": "finished", "O": "open"}
QUALITY_CLASSES = ["0", "1"]
QUALITY_NAMES = {0: "poor", 1: "good"}
SLOTS = ["line_mod_3", "l_linenumber", "l_tax", "l_discount"]
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
MODEL = "document-quality"
STAGE = "Staging"

DOCUMENT_FOREST = SMALL_FOREST.but(class_weight="balanced", seed=21)
DOCUMENT_FULL_FOREST = FULL_FOREST
DOCUMENT_TEXT = TrainSettings()
DOCUMENT_LINEAR = TrainSettings(class_weight="balanced")
DOCUMENT_KERNEL = DOCUMENT_LINEAR.but(kernel_features=128)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return TableRef(path=f"{sf_dir}/{name}.parquet").read(spark)


# Sources and sinks


def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def format_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    copy = TableRef(path=scratch_path(spark, "orders"), fmt="parquet")
    copy.write(table(spark, sf_dir, "orders"))
    return copy.read(spark)


def orc_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    copy = TableRef(
        path=scratch_path(spark, "customer"), name=f"customer_{uuid.uuid4().hex}", fmt="ORC"
    )
    copy.write(table(spark, sf_dir, "customer"))
    rows = copy.read(spark)
    spark.sql(f"DROP TABLE {copy.name}")  # its files lie in the shared folder and stay
    return rows


# Projections, filters, scalar expressions


def feature_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*MEASURES, "l_returnflag")


def order_class_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = class_name(F.col("o_orderstatus"), ORDER_STATUS)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", name.alias("status_name")
    )


def equality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = equals_all({"o_orderstatus": "F", "o_orderpriority": "1-URGENT"})
    return table(spark, sf_dir, "orders").filter(wanted).select("o_orderkey", "o_totalprice")


def cast_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return cast_columns(
        customers, {"c_custkey": "string", "c_nationkey": "double", "c_acctbal": "int"}
    )


# Row order, sampling, splitting


def shuffle_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return numbered(shuffled_table(orders, ["o_orderkey"], seed=42))


def shuffle_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return first_shuffled(orders, 100, ["o_orderkey"], seed=42)


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return first_rows(orders, 5, [F.desc("o_totalprice"), F.asc("o_orderkey")])


def sort_descending(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.max("l_extendedprice").alias("top_price")
    )
    group = F.concat_ws("-", "l_returnflag", "l_linestatus").alias("price_group")
    return numbered(ranked(prices.select(group, "top_price"), "top_price", "price_group"))


def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return hash_split(orders, ["o_orderkey"], fraction=0.7, seed=42)


def default_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return hash_split(orders, ["o_orderkey"], seed=0)


def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return split_by_class(customers, "c_mktsegment", ["c_custkey"], fraction=0.7, seed=42)


def stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return folds_by_class(customers, "c_mktsegment", ["c_custkey"], 7)


def stratified_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys repeat here, so cut points fall inside groups of rows with one key."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity")
    flagged = split_by_class(items, "l_returnflag", ["l_orderkey"], fraction=0.7, seed=42)
    return flagged.groupBy("l_returnflag").agg(
        F.count_if("is_train").alias("n_train"), F.count_if(~F.col("is_train")).alias("n_heldout")
    )


def heldout_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rest = sides(hash_split(table(spark, sf_dir, "orders"), ["o_orderkey"], 0.7, seed=42))
    stored = TableRef(path=scratch_path(spark, "heldout"))
    stored.write(rest)
    return stored.read(spark)


# Feature stages


def _label_index(spark: SparkSession, sf_dir: str, order: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    indexer = feat.label_indexer("c_mktsegment", order, output="segment_index")
    return indexer.fit(customers).transform(customers)


def label_index_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _label_index(spark, sf_dir, "frequencyDesc")


def label_index_alpha(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _label_index(spark, sf_dir, "alphabetAsc")


def _part_index(spark: SparkSession, sf_dir: str, order: str) -> DataFrame:
    """Many labels, some of them frequent: the quantity for half of the rows, else the part."""
    items = table(spark, sf_dir, "lineitem")
    label = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity").cast("int")).otherwise(
        F.col("l_partkey") + 1000
    )
    rows = items.select("l_orderkey", "l_linenumber", label.cast("string").alias("label"))
    return feat.with_label_index(rows, feat.label_dictionary(rows, "label", order), "label", "index")


def label_dictionary_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part_index(spark, sf_dir, "frequencyDesc")


def label_dictionary_alpha(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part_index(spark, sf_dir, "alphabetAsc")


def assembled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", *MEASURES)
    slots = feat.vector_slots(feat.FEATURES, [f"slot_{m}" for m in MEASURES])
    return feat.assembler(MEASURES).transform(items).select("l_orderkey", "l_partkey", *slots)


def categorical_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(
        (F.col("l_linenumber") % 3).alias("line_mod_3"), "l_linenumber", "l_tax", "l_discount"
    )
    model = feat.chain([feat.assembler(SLOTS), feat.category_indexer(4)]).fit(items)
    found = feat.category_counts(model.stages[-1], SLOTS)
    rows = [
        F.struct(
            F.lit(slot).alias("slot"),
            F.lit(slot in found).alias("is_categorical"),
            F.lit(found.get(slot)).cast("bigint").alias("n_categories"),
        )
        for slot in SLOTS
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return feat.chain(feat.text_stages("text")).fit(documents).transform(documents)


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hashed(spark, sf_dir).select(
        "doc_id", F.size(feat.WORDS).cast("bigint").alias("n_tokens")
    )


def hashed_tf_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = feat.vector_total(feat.FEATURES).cast("bigint")
    return _hashed(spark, sf_dir).select("doc_id", total.alias("total"))


def balanced_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    weighted = with_balanced_weights(labels, "quality")
    return weighted.withColumn("weight", F.round("weight", 6))


# Evaluation on a fixed prediction


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(
        "doc_id", "quality", (1 - F.col("toxic")).alias("guess")
    )


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.accuracy(_judged(spark, sf_dir), "quality", "guess"), "accuracy")


def accuracy_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = _judged(spark, sf_dir)
    return metrics.accuracy(judged, "quality", "guess", normalize=False, output="n_right")


def accuracy_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = with_balanced_weights(_judged(spark, sf_dir), "quality")
    return _rounded(metrics.accuracy(judged, "quality", "guess", weight="weight"), "accuracy")


def _matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(_judged(spark, sf_dir), "quality", "guess")


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matrix(spark, sf_dir).select("actual", "predicted", "n")


def confusion_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_matrix(spark, sf_dir).select("actual", "predicted", "share"), "share")


def confusion_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_wide(_matrix(spark, sf_dir), [0, 1])


def confusion_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = _matrix(spark, sf_dir)
    names = (
        table(spark, sf_dir, "labels")
        .select(F.col("quality").alias("label"))
        .distinct()
        .withColumn("name", class_name(F.col("label"), QUALITY_NAMES))
    )
    named = metrics.confusion_named(matrix, names)
    return _rounded(named.select("actual_name", "predicted_name", "n", "share"), "share")


def confusion_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    languages = table(spark, sf_dir, "documents").select("doc_id", "lang")
    judged = _judged(spark, sf_dir).join(languages, "doc_id")
    matrix = metrics.confusion_matrix(judged, "quality", "guess", classes=[0, 1], by=["lang"])
    return _rounded(matrix, "share")


def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("n_chars").cast("double").alias("score")
    )
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").cast("double").alias("label")
    )
    scored = labels.join(lengths, "doc_id")
    area = metrics.roc_auc(scored, "label", "score")
    return spark.range(1).select(F.round(F.lit(area), 6).alias("auc"))


def _length_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document lengths in steps of 50 as scores for quality, so that many are tied."""
    step = (F.floor(F.col("n_chars") / 50) * 50).cast("double").alias("score")
    lengths = table(spark, sf_dir, "documents").select("doc_id", "lang", step)
    return table(spark, sf_dir, "labels").select("doc_id", "quality").join(lengths, "doc_id")


def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = metrics.roc_curve(_length_scores(spark, sf_dir), "quality", "score", by=["lang"])
    return _rounded(curve, "fpr", "tpr")


def auc_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    areas = metrics.auc_by(_length_scores(spark, sf_dir), "quality", "score", by=["lang"])
    return _rounded(areas, "auc")


# Versions, stages, runs


def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").drop("props")
    return latest_per_key(events, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")])


def _user_models(spark: SparkSession, sf_dir: str) -> tuple[ModelRegistry, DataFrame, DataFrame]:
    """A registry, one model per user, and the models of users with a purchase."""
    events = table(spark, sf_dir, "events")
    user = F.concat(F.lit("user-"), F.col("user_id").cast("string"))
    models = events.groupBy(user.alias("name")).agg(
        F.min("event_id").alias("first_id"),
        F.max(F.when(F.col("event_type") == "purchase", F.col("event_id"))).alias("bought_id"),
    )

    def batch(run: str) -> DataFrame:
        run_id = F.col(run).cast("string")
        return models.filter(F.col(run).isNotNull()).select(
            "name", run_id.alias("run_id"), F.concat(F.lit("models/"), run_id).alias("source")
        )

    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    return registry, batch("first_id"), batch("bought_id")


def register_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry, everyone, buyers = _user_models(spark, sf_dir)
    registry.register(everyone)
    registry.register(buyers)
    return registry.versions()


def stage_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry, everyone, buyers = _user_models(spark, sf_dir)
    first = F.lit(1).alias("version")
    registry.set_stages(everyone.select("name", first, F.lit(STAGE).alias("stage")))
    registry.set_stages(buyers.select("name", first, F.lit("Production").alias("stage")))
    return registry.current_stages()


def version_at_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry, everyone, buyers = _user_models(spark, sf_dir)
    registry.register(everyone)
    registry.register(buyers)
    registry.set_stages(registry.versions().select("name", "version", F.lit(STAGE).alias("stage")))
    return registry.at_stage()


def stage_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The version at Staging after each of three commits of stage changes."""
    registry, everyone, buyers = _user_models(spark, sf_dir)
    registry.register(everyone)
    registry.register(buyers)
    one, two = F.lit(1).alias("version"), F.lit(2).alias("version")
    registry.set_stages(everyone.select("name", one, F.lit(STAGE).alias("stage")))
    registry.set_stages(buyers.select("name", two, F.lit(STAGE).alias("stage")))
    registry.set_stages(buyers.select("name", two, F.lit("Production").alias("stage")))
    past = [
        registry.at_stage(n).filter(F.col("stage") == STAGE).select(F.lit(n).alias("commit"), "name", "version")
        for n in (1, 2, 3)
    ]
    return reduce(DataFrame.unionByName, past)


def _moves(events: DataFrame) -> DataFrame:
    """Stage changes ``(name, version, stage, seq, at)``: every click brings a version to Staging, and
    moves it on to Production and Archived some days later, or at once."""
    steps = """
        inline(array(
            named_struct('stage', 'Staging', 'seq', 1, 'at', ts),
            named_struct('stage', 'Production', 'seq', 2,
                         'at', ts + make_dt_interval(cast(event_id % 5 AS int))),
            named_struct('stage', 'Archived', 'seq', 3,
                         'at', ts + make_dt_interval(cast(event_id % 5 + event_id % 7 AS int)))))
    """
    clicks = events.filter("event_type = 'click'")
    return clicks.select(
        F.col("user_id").alias("name"), F.col("event_id").alias("version"), F.expr(steps)
    )


def version_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The version at each stage of the user's model at the time of every purchase."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    stages = F.array(*[F.lit(s) for s in (STAGE, "Production", "Archived")])
    asked = events.filter("event_type = 'purchase'").select(
        "event_id", "ts", F.col("user_id").alias("name"), F.explode(stages).alias("stage")
    )
    timeline = stage_timeline(_moves(events)).withColumnRenamed("at", "since")
    return as_of(asked, timeline, ["name", "stage"], "ts", "since").select("event_id", "stage", "version")


def stage_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How long every version of the users' models was at each stage."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    held = spans(_moves(events), ["name", "version"], "at", ["seq"])
    return held.select("name", "version", "stage", "since", "until")


def concurrent_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One writer per event type, all at once, each registering its users' models."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type").distinct()
    kinds = sorted(r["event_type"] for r in events.select("event_type").distinct().collect())
    root = scratch_path(spark, "registry")

    def register(kind: str) -> None:
        user = F.concat(F.lit("user-"), F.col("user_id").cast("string"))
        models = events.filter(F.col("event_type") == kind).select(
            user.alias("name"), F.lit(kind).alias("run_id"), F.lit(kind).alias("source")
        )
        ModelRegistry(spark, root).register(models)

    with ThreadPoolExecutor(len(kinds)) as pool:
        list(pool.map(register, kinds))
    versions = ModelRegistry(spark, root).versions()
    return versions.groupBy("name").agg(
        F.array_join(F.sort_array(F.collect_set("run_id")), ",").alias("writers"),
        F.count("version").alias("n_versions"),
        F.count_distinct("version").alias("n_numbers"),
        F.max("version").alias("last_version"),
    )


def run_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"), "o_orderstatus", "o_orderpriority"
    )
    registry.log_params(
        orders.unpivot("run_id", ["o_orderstatus", "o_orderpriority"], "key", "value")
    )
    return registry.params()


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    languages = table(spark, sf_dir, "documents").select("doc_id", "lang")
    judged = _judged(spark, sf_dir).join(languages, "doc_id")
    runs = judged.groupBy(F.col("lang").alias("name")).agg(
        F.min("doc_id").cast("string").alias("run_id")
    )
    registry.register(runs.withColumn("source", F.col("name")))
    found = metrics.accuracy(judged, "quality", "guess", by=["lang"])
    named = registry.versions().select(F.col("name").alias("lang"), "run_id")
    registry.log_metrics(
        found.join(named, "lang").select(
            "run_id", F.lit(jobs.ACCURACY).alias("key"), F.col("accuracy").alias("value")
        )
    )
    return _rounded(registry.leaderboard(jobs.ACCURACY), "value")


# Learners and jobs on document quality


def _shape_table(spark: SparkSession, sf_dir: str) -> TableRef:
    """The labelled feature table, written once: later passes read six narrow columns, no text."""
    stored = TableRef(path=scratch_path(spark, "shapes"))
    stored.write(
        labelled_shapes(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    )
    return stored


def quality_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    shapes = _shape_table(spark, sf_dir).read(spark)
    return _rounded(shapes, "distinct_ratio", "nonalpha_ratio")


def _train_shapes(
    spark: SparkSession, sf_dir: str, settings: TrainSettings
) -> tuple[ModelRegistry, TableRef]:
    """Run the training job and stage its version; returns the registry and held-out table."""
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    return registry, _train_version(spark, registry, _shape_table(spark, sf_dir), settings)


def _train_version(
    spark: SparkSession, registry: ModelRegistry, shapes: TableRef, settings: TrainSettings
) -> TableRef:
    heldout = TableRef(path=scratch_path(spark, "heldout"))
    models = scratch_path(spark, "models")
    version = jobs.train(
        spark, shapes, heldout, registry, MODEL, models, INPUTS, LABEL, KEYS, settings
    )
    registry.set_stage(MODEL, version.version, STAGE)
    return heldout


def _score_shapes(
    spark: SparkSession, sf_dir: str, settings: TrainSettings
) -> tuple[PipelineModel, DataFrame]:
    """The stored model and what it scored."""
    registry, heldout = _train_shapes(spark, sf_dir, settings)
    scored = TableRef(path=scratch_path(spark, "scored"), fmt="orc")
    version = jobs.score(spark, heldout, scored, registry, MODEL, STAGE, truth=True)
    return load_model(version.source), scored.read(spark)


def _in_classes() -> Column:
    return F.col(feat.PREDICTION).isin(0.0, 1.0).alias("in_classes")


def _beats_constant(scored: DataFrame) -> Column:
    """Whether the mean recall of the classes is above that of any constant prediction."""
    right = (F.col(feat.PREDICTION) == F.col(feat.INDEXED_LABEL)).cast("double")
    recalls = scored.groupBy(feat.INDEXED_LABEL).agg(F.avg(right).alias("recall"))
    mean, classes = recalls.agg(F.avg("recall"), F.count(F.lit(1))).first()
    return F.lit(mean > 1 / classes + 0.01).alias("beats_constant")


def _prob_ok() -> Column:
    total = F.aggregate("probability", F.lit(0.0), lambda a, x: a + x)
    return (F.abs(total - 1) < 1e-9).alias("prob_ok")


def forest_train_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, scored = _score_shapes(spark, sf_dir, DOCUMENT_FOREST)
    return scored.select("doc_id", LABEL, _in_classes(), _prob_ok(), _beats_constant(scored))


def forest_full_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the options of the stored forest, which another configuration would not have."""
    model, scored = _score_shapes(spark, sf_dir, DOCUMENT_FULL_FOREST)
    forest = model.stages[-1]
    options = {
        "n_trees": forest.getNumTrees,
        "max_depth": forest.getMaxDepth(),
        "subset": forest.getFeatureSubsetStrategy(),
        "impurity": forest.getImpurity(),
        "bootstrap": forest.getBootstrap(),
        "seed": forest.getSeed(),
        "weighted": forest.isSet("weightCol"),
    }
    return scored.select(
        "doc_id",
        LABEL,
        _in_classes(),
        _prob_ok(),
        *[F.lit(value).alias(name) for name, value in options.items()],
    )


def _fit_shapes(
    spark: SparkSession, sf_dir: str, settings: TrainSettings
) -> tuple[PipelineModel, DataFrame]:
    """A forest fitted without a registry, and the held-out rows."""
    shapes = _shape_table(spark, sf_dir).read(spark)
    training, rest = sides(jobs.split(shapes, LABEL, KEYS, settings))
    stages = jobs.tabular_pipeline(INPUTS, LABEL, settings)
    return jobs.fit(training, INPUTS, LABEL, stages, settings), rest


def scored_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, rest = _fit_shapes(spark, sf_dir, DOCUMENT_FOREST)
    shown = jobs.predict(model, rest, truth=True).select(
        "doc_id", feat.PREDICTION, feat.INDEXED_LABEL, feat.FEATURES
    )
    slots = [F.col(feat.FEATURES)[i].alias(name) for i, name in enumerate(INPUTS)]
    return _rounded(
        shown.select("doc_id", feat.INDEXED_LABEL, _in_classes(), *slots),
        "distinct_ratio",
        "nonalpha_ratio",
    )


def predictions_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, rest = _fit_shapes(spark, sf_dir, DOCUMENT_FOREST)
    labels = feat.model_labels(model)
    scored = jobs.predict(model, rest, truth=True)
    truth = F.element_at(
        F.array(*[F.lit(x) for x in labels]), F.col(feat.INDEXED_LABEL).cast("int") + 1
    )
    return scored.select(
        "doc_id",
        LABEL,
        truth.cast("int").alias("decoded_truth"),
        F.col(feat.PREDICTED_LABEL).isin(QUALITY_CLASSES).alias("in_classes"),
        F.col(feat.ACTUAL_LABEL).alias("actual_label"),
    )


def model_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, rest = _fit_shapes(spark, sf_dir, DOCUMENT_FOREST)
    path = scratch_path(spark, "models")
    save_model(model, path)
    both = model.transform(rest).select(
        *rest.columns, F.col("prediction").alias("first"), F.col("probability").alias("first_prob")
    )
    again = load_model(path).transform(both)
    same = (F.col("first") == F.col("prediction")) & (
        vector_to_array("first_prob") == vector_to_array("probability")
    )
    return again.select("doc_id", same.alias("same_prediction"))


def feature_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, rest = _fit_shapes(spark, sf_dir, DOCUMENT_FOREST)
    lists = ranking_of(model, INPUTS, rest).agg(
        F.collect_list("feature").alias("names"), F.collect_list("importance").alias("shares")
    )
    total = F.aggregate("shares", F.lit(0.0), lambda a, x: a + x)
    return lists.select(
        F.explode("names").alias("feature"),
        (F.abs(total - 1) < 1e-9).alias("sum_is_one"),
        (F.col("shares") == F.sort_array("shares", asc=False)).alias("is_sorted"),
    )


def evaluate_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry, heldout = _train_shapes(spark, sf_dir, DOCUMENT_FOREST)
    scored = TableRef(path=scratch_path(spark, "scored"))
    result = jobs.evaluate(spark, heldout, scored, registry, MODEL, STAGE)
    logged = registry.leaderboard(jobs.ACCURACY, ["version"]).select(
        F.col("version").alias("model_version"), F.col("value").alias("logged")
    )
    rows = result.confusion.groupBy("model_version", "actual").agg(
        F.sum("n").alias("n"), F.sum("share").alias("share")
    )
    best = rows.groupBy("model_version").agg(F.max("share").alias("majority"))
    return (
        rows.join(best, "model_version")
        .join(result.accuracy, "model_version")
        .join(logged, "model_version")
        .select(
            "model_version",
            F.col("actual").cast("int").alias("actual"),
            "n",
            (F.col("accuracy") >= F.col("majority")).alias("beats_majority"),
            (F.abs(F.col("accuracy") - F.col("logged")) < 1e-12).alias("is_logged"),
        )
    )


def evaluate_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions that code the classes in other orders, judged by label in one history."""
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    shapes, scored = _shape_table(spark, sf_dir), TableRef(path=scratch_path(spark, "scored"))
    for order in ("alphabetAsc", "frequencyDesc"):
        settings = DOCUMENT_FOREST.but(trees=5, label_order=order)
        heldout = _train_version(spark, registry, shapes, settings)
        jobs.score(spark, heldout, scored, registry, MODEL, STAGE, mode="append", truth=True)
    names = (
        table(spark, sf_dir, "labels")
        .select(F.col("quality").cast("string").alias("label"), "quality")
        .distinct()
        .select("label", class_name(F.col("quality"), QUALITY_NAMES).alias("name"))
    )
    result = jobs.evaluate(
        spark, heldout, scored, registry, MODEL, STAGE, scoring=False, names=names
    )
    rows = result.confusion.groupBy("model_version", "actual", "actual_name").agg(
        F.sum("n").alias("n")
    )
    return rows.join(result.accuracy, "model_version").select(
        "model_version",
        "actual",
        "actual_name",
        "n",
        (F.col("accuracy") > 0.5).alias("beats_chance"),
    )


def _half(heldout: DataFrame, batch: int) -> DataFrame:
    return heldout.filter(F.pmod(F.col("doc_id"), F.lit(2)) == batch)


def _scored_history(spark: SparkSession, sf_dir: str) -> tuple[ModelRegistry, TableRef, list[TableRef]]:
    """A history table with two batches, and their inputs; the first batch was scored twice."""
    registry, heldout = _train_shapes(spark, sf_dir, DOCUMENT_FOREST)
    history = jobs.history_table(scratch_path(spark, "history"))
    inputs = []
    for i in (0, 1):
        part = TableRef(path=scratch_path(spark, "batch"))
        part.write(_half(heldout.read(spark), i))
        inputs.append(part)
    for i in (0, 1, 0):
        _score_batch(spark, registry, history, inputs, i)
    return registry, history, inputs


def _score_batch(
    spark: SparkSession, registry: ModelRegistry, history: TableRef, inputs: list[TableRef], i: int
) -> None:
    keep = ["doc_id", feat.ACTUAL_LABEL, feat.PREDICTED_LABEL]
    jobs.score(
        spark, inputs[i], history, registry, MODEL, STAGE, keep=keep, truth=True, batch=f"half-{i}"
    )


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that cannot be scored, with the reasons, beside those that were, from one pass."""
    registry, _ = _train_shapes(spark, sf_dir, DOCUMENT_FOREST.but(trees=2, depth=2))
    every = lambda n: F.pmod(F.col("doc_id"), F.lit(n)) == 0
    broken = TableRef(path=scratch_path(spark, "broken"))
    broken.write(
        _shape_table(spark, sf_dir)
        .read(spark)
        .withColumns(
            {
                "n_chars": F.when(every(5), None).otherwise(F.col("n_chars")),
                "n_words": F.when(every(7), float("nan")).otherwise(F.col("n_words")),
                LABEL: F.when(every(11), None).when(every(3), 9).otherwise(F.col(LABEL)),
            }
        )
    )
    sink = jobs.outcome_table(scratch_path(spark, "outcomes"))
    found = jobs.score_or_reject(spark, broken, sink, registry, MODEL, STAGE, truth=True)
    accepted = found.accepted.select("doc_id", F.lit("").alias("reasons"), _in_classes())
    rejected = found.rejected.select(
        "doc_id", F.array_join("reasons", "; ").alias("reasons"), F.lit(False).alias("in_classes")
    )
    return accepted.unionByName(rejected)


def roc_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROC curves of two versions that code the classes in other orders, from one history."""
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    shapes, history = _shape_table(spark, sf_dir), jobs.history_table(scratch_path(spark, "history"))
    for order in ("alphabetAsc", "frequencyDesc"):
        settings = DOCUMENT_FOREST.but(trees=5, label_order=order)
        heldout = _train_version(spark, registry, shapes, settings)
        keep = [feat.ACTUAL_LABEL]
        jobs.score(
            spark, heldout, history, registry, MODEL, STAGE, keep=keep, truth=True, batch="heldout",
            positive="1",
        )
    scored, by = history.read(spark), ["model_version"]
    judged = dict(label=feat.ACTUAL_LABEL, score=jobs.POSITIVE_SCORE, positive="1", by=by)
    curve = metrics.roc_curve(scored, **judged)
    ends = curve.groupBy(*by).agg(
        F.min("fpr").alias("first_fpr"),
        F.max("tpr").alias("last_tpr"),
        (F.count(F.lit(1)) == F.count_distinct("threshold")).alias("ties_combined"),
    )
    sizes = scored.groupBy(*by).agg(
        F.count_if(F.col(feat.ACTUAL_LABEL) == "1").alias("n_positive"),
        F.count_if(F.col(feat.ACTUAL_LABEL) == "0").alias("n_negative"),
    )
    areas = metrics.auc_by(scored, **judged).select(*by, (F.col("auc") > 0.5).alias("beats_chance"))
    return ends.join(sizes, by).join(areas, by)


def append_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that was scored twice is there once."""
    _, history, _ = _scored_history(spark, sf_dir)
    return history.read(spark).select(
        "doc_id",
        "model_version",
        "batch",
        F.col(feat.ACTUAL_LABEL).cast("int").alias("actual"),
        F.col(feat.PREDICTED_LABEL).isin(QUALITY_CLASSES).alias("in_classes"),
    )


def evaluate_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three evaluations of a growing history: two batches, nothing new, one scored again."""
    registry, history, inputs = _scored_history(spark, sf_dir)
    counts = counts_table(scratch_path(spark, "counts"))

    def judge() -> tuple[int, DataFrame]:
        found = evaluate_new_batches(spark, history, counts, registry, MODEL)
        return found.batches_read, found.evaluation.counts

    reads = [judge()[0], judge()[0]]
    _score_batch(spark, registry, history, inputs, 1)
    last, cells = judge()
    whole = metrics.confusion_counts(
        history.read(spark), feat.ACTUAL_LABEL, feat.PREDICTED_LABEL, ["model_version"]
    )
    added = cells.select(*whole.columns)
    equal = added.exceptAll(whole).isEmpty() and whole.exceptAll(added).isEmpty()
    return (
        cells.groupBy("model_version", F.col("actual").cast("int").alias("actual"))
        .agg(F.sum("n").alias("n"))
        .withColumns(
            {
                "batches_read": F.lit("/".join(map(str, [*reads, last]))),
                "equals_full": F.lit(equal),
            }
        )
    )


def model_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides of the signature stored with a model, read back."""
    registry, _ = _train_shapes(spark, sf_dir, DOCUMENT_FOREST.but(trees=2, depth=2))
    path = registry.lookup(MODEL, STAGE).source
    fields = [
        F.struct(
            F.lit(side).alias("side"),
            F.lit(field.name).alias("name"),
            F.lit(field.dataType.simpleString()).alias("type"),
        )
        for side in ("inputs", "outputs")
        for field in load_contract(spark, path, side)
    ]
    return spark.range(1).select(F.inline(F.array(*fields)))


def text_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text is hashed before the join; the narrow table is written once, then split and fitted."""
    stages = jobs.text_pipeline("text", LABEL, DOCUMENT_TEXT)
    hashing = PipelineModel([s for s in stages if not isinstance(s, Estimator)])
    learning = [s for s in stages if isinstance(s, Estimator)]
    documents, labels = (table(spark, sf_dir, n) for n in ("documents", "labels"))
    ref = TableRef(path=scratch_path(spark, "hashed"))
    ref.write(labelled_hashes(documents, labels, hashing))
    training, rest = sides(jobs.split(ref.read(spark), LABEL, KEYS, DOCUMENT_TEXT))
    model = jobs.fit(training, [feat.FEATURES], LABEL, learning, DOCUMENT_TEXT)
    scored = jobs.predict(model, rest, truth=True)
    return scored.select("doc_id", LABEL, _in_classes(), _prob_ok(), _beats_constant(scored))


def _harness(spark: SparkSession, sf_dir: str, name: str, settings: TrainSettings) -> DataFrame:
    shapes = _shape_table(spark, sf_dir).read(spark)
    estimator = learner(name, settings, feat.INDEXED_FEATURES)
    scored, _ = jobs.fit_and_test(shapes, estimator, INPUTS, LABEL, KEYS, settings)
    return scored


def linear_svc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _harness(spark, sf_dir, "linear_svc", DOCUMENT_LINEAR)
    return scored.select("doc_id", LABEL, _in_classes(), _beats_constant(scored))


def kernel_svc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _harness(spark, sf_dir, "kernel_svc", DOCUMENT_KERNEL)
    return scored.select("doc_id", LABEL, _in_classes(), _prob_ok(), _beats_constant(scored))


def harness(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _harness(spark, sf_dir, "logistic", DOCUMENT_LINEAR)
    counts = jobs.truth_and_prediction(scored).groupBy("y_test").agg(F.count("y_pred").alias("n"))
    return counts.select("y_test", "n", _beats_constant(scored))


def cross_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    shapes = _shape_table(spark, sf_dir).read(spark)
    estimator = learner("logistic", DOCUMENT_LINEAR, feat.INDEXED_FEATURES)
    scored, accuracy = jobs.cross_validate(
        shapes, estimator, INPUTS, LABEL, KEYS, DOCUMENT_LINEAR, folds=3
    )
    better = accuracy.select("fold", (F.col("accuracy") > 0.5).alias("beats_chance"))
    return scored.select("doc_id", LABEL, "fold", _in_classes()).join(better, "fold")


def permutation_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column of hashes beside the document shapes; only its rank is certain."""
    noise = (F.crc32(F.col("doc_id").cast("string")) / float(1 << 32)).alias("noise")
    shapes = _shape_table(spark, sf_dir).read(spark).select("*", noise)
    inputs = [*INPUTS, "noise"]
    settings = DOCUMENT_FOREST.but(trees=20, depth=4)
    model = jobs.fit(shapes, inputs, LABEL, jobs.tabular_pipeline(inputs, LABEL, settings), settings)
    found = jobs.permutation_importance(model, shapes, inputs, KEYS)
    best = found.agg(F.max("importance")).first()[0]
    return found.select(
        "feature",
        ((F.col("feature") != "noise") | (F.col("importance") < best / 4)).alias("noise_is_low"),
        F.lit(best > 0.02).alias("some_matter"),
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train, score and evaluate on document quality; the long confusion matrix."""
    registry, heldout = _train_shapes(spark, sf_dir, DOCUMENT_FOREST)
    scored = TableRef(path=scratch_path(spark, "scored"))
    return jobs.evaluate(spark, heldout, scored, registry, MODEL, STAGE).confusion


QUERIES: dict[str, Query] = {
    "table_scan": table_scan,
    "format_roundtrip": format_roundtrip,
    "orc_table_roundtrip": orc_table_roundtrip,
    "feature_projection": feature_projection,
    "class_name": order_class_name,
    "equality_filter": equality_filter,
    "cast_types": cast_types,
    "shuffle_rows": shuffle_rows,
    "shuffle_topn": shuffle_topn,
    "preview": preview,
    "sort_descending": sort_descending,
    "random_split": random_split,
    "default_split": default_split,
    "stratified_split": stratified_split,
    "stratified_counts": stratified_counts,
    "stratified_folds": stratified_folds,
    "heldout_roundtrip": heldout_roundtrip,
    "label_index_frequency": label_index_frequency,
    "label_index_alpha": label_index_alpha,
    "label_dictionary_frequency": label_dictionary_frequency,
    "label_dictionary_alpha": label_dictionary_alpha,
    "assembled_features": assembled_features,
    "categorical_slots": categorical_slots,
    "token_counts": token_counts,
    "hashed_tf_total": hashed_tf_total,
    "balanced_weights": balanced_weights,
    "accuracy": accuracy,
    "accuracy_count": accuracy_count,
    "accuracy_weighted": accuracy_weighted,
    "confusion_matrix": confusion_matrix,
    "confusion_share": confusion_share,
    "confusion_wide": confusion_wide,
    "confusion_named": confusion_named,
    "confusion_by_group": confusion_by_group,
    "roc_auc": roc_auc,
    "roc_curve": roc_curve,
    "auc_by_group": auc_by_group,
    "latest_per_key": latest_event,
    "register_version": register_version,
    "stage_change": stage_change,
    "version_at_stage": version_at_stage,
    "stage_history": stage_history,
    "stage_spans": stage_spans,
    "version_as_of": version_as_of,
    "concurrent_versions": concurrent_versions,
    "run_params": run_params,
    "run_metrics": run_metrics,
    "quality_features": quality_features,
    "forest_train_score": forest_train_score,
    "scored_display": scored_display,
    "forest_full_options": forest_full_options,
    "predictions_decoded": predictions_decoded,
    "model_reload": model_reload,
    "feature_ranking": feature_ranking,
    "evaluate_job": evaluate_job,
    "evaluate_history": evaluate_history,
    "rejected_rows": rejected_rows,
    "roc_versions": roc_versions,
    "append_again": append_again,
    "evaluate_increment": evaluate_increment,
    "model_signature": model_signature,
    "text_logistic": text_logistic,
    "linear_svc": linear_svc,
    "kernel_svc": kernel_svc,
    "harness": harness,
    "cross_validation": cross_validation,
    "permutation_ranking": permutation_ranking,
}
