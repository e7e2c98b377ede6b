"""Repeatable train / held-out splits.

Both splits only add a flag to each row. Neither moves the table: the hash split is a predicate,
and the stratified split a predicate against one cut point per class.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coppice.functions.hashing import content_hash, hash_below, hash_prefix, split_hash
from coppice.operators.rows import repeated
from coppice.operators.small import join_on, localised
from coppice.settings import DEFAULT_FRACTION
from coppice.sources.workspace import shared_dir

BUCKET_DIGITS = 4


def hash_split(
    df: DataFrame,
    keys: Sequence[str],
    fraction: float = DEFAULT_FRACTION,
    seed: int = 42,
    flag: str = "is_train",
) -> DataFrame:
    """Flag rows whose key hash falls below the fraction; rows with equal keys share a side."""
    return df.withColumn(flag, hash_below(split_hash(seed, keys), fraction))


def native_split(df: DataFrame, fraction: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Spark's own random split: needs no key, but depends on how the table is laid out."""
    train, heldout = df.randomSplit([fraction, 1.0 - fraction], seed)
    return train, heldout


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def quotas(counts: DataFrame, label: str, fraction: float) -> DataFrame:
    """Training rows per class, ``(label, quota)``, by largest remainder.

    ``counts`` holds one row ``(label, n)`` per class. Each class gets ``floor(f·n)``; what is left
    of ``floor(f·N)`` goes to the largest fractional parts, ties by label.
    """
    exact = F.round(F.lit(fraction) * F.col("n"), 9)
    shares = counts.withColumn("_base", F.floor(exact)).withColumn(
        "_rest", F.round(exact - F.col("_base"), 9)
    )
    whole = F.floor(F.round(F.lit(fraction) * F.sum("n"), 9)) - F.sum("_base")
    seats = shares.agg(whole.alias("seats")).first()["seats"] or 0
    bonus = shares.orderBy(F.desc("_rest"), F.asc(label)).limit(int(seats))
    return join_on(shares, bonus.select(label, F.lit(1).alias("_one")), [label], "left").select(
        label, (F.col("_base") + F.coalesce("_one", F.lit(0))).alias("quota")
    )


def _crossing(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """Per class the step at which the running count reaches the target.

    Returns ``(_class, _step, _take, _n)``: take ``_take`` of the ``_n`` rows at this step and all
    rows of the steps before it.
    """
    running = counts.withColumn(
        "_upto", F.sum("_n").over(Window.partitionBy("_class").orderBy("_step"))
    )
    before = F.col("_upto") - F.col("_n")
    return (
        join_on(running, targets, ["_class"], "inner")
        .filter((before < F.col("_target")) & (F.col("_target") <= F.col("_upto")))
        .select("_class", "_step", (F.col("_target") - before).alias("_take"), "_n")
    )


def _count_steps(rows: DataFrame, step: Column) -> DataFrame:
    return rows.groupBy("_class", step.alias("_step")).agg(F.count(F.lit(1)).alias("_n"))


def _cut_points(rows: DataFrame, buckets: DataFrame, targets: DataFrame) -> DataFrame:
    """Exact cut hash per class for ``rows(_class, _hash)``.

    ``buckets`` counts the rows per class and leading hash digits. Only the rows of the one bucket
    per class in which the target falls are counted hash by hash, so no window ever holds more
    than a 16⁻⁴ share of a class, and copies of a key are counted before they move.
    """
    coarse = localised(_crossing(buckets, targets))
    inside = join_on(
        rows.withColumn("_bucket", hash_prefix(F.col("_hash"), BUCKET_DIGITS)),
        coarse.select("_class", F.col("_step").alias("_cut_bucket"), "_take"),
        ["_class"],
        "inner",
    ).filter("_bucket = _cut_bucket")
    fine = _count_steps(inside, F.col("_hash"))
    return localised(
        _crossing(fine, coarse.select("_class", F.col("_take").alias("_target")))
    )


def _buckets(rows: DataFrame) -> DataFrame:
    return _count_steps(rows, hash_prefix(F.col("_hash"), BUCKET_DIGITS))


def stratified_split(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    fraction: float,
    seed: int = 42,
    flag: str = "is_train",
) -> DataFrame:
    """Flag the first ``quota`` rows of every class in key-hash order.

    Rows that share a key with the cut point are told apart by the hash of their content. Exact
    copies of one row are interchangeable: they are split by number.
    """
    columns = df.columns
    hashed = df.withColumn("_class", F.col(label)).withColumn("_hash", split_hash(seed, keys))
    rows = hashed.select("_class", "_hash")
    buckets = _buckets(rows).persist()
    try:
        totals = localised(buckets.groupBy("_class").agg(F.sum("_n").alias("n")))
        targets = quotas(totals, "_class", fraction).withColumnRenamed("quota", "_target")
        cuts = _cut_points(rows, buckets, targets)
    finally:
        buckets.unpersist()

    tagged = join_on(hashed, _named(cuts, "cut"), ["_class"], "left")
    shared = cuts.filter("_take < _n")
    if shared.isEmpty():
        chosen = _taken(F.col("_hash"), "cut")
        return tagged.select(*columns, F.coalesce(chosen, F.lit(False)).alias(flag))
    return _split_ties(tagged, shared, columns, flag)


def _named(cuts: DataFrame, name: str) -> DataFrame:
    return cuts.select(
        "_class",
        F.col("_step").alias(f"_{name}"),
        F.col("_take").alias(f"_{name}_take"),
        F.col("_n").alias(f"_{name}_n"),
    )


def _whole(name: str) -> Column:
    """All rows at the cut are taken."""
    return F.col(f"_{name}_take") == F.col(f"_{name}_n")


def _taken(hash_hex: Column, name: str) -> Column:
    cut = F.col(f"_{name}")
    return (hash_hex < cut) | ((hash_hex == cut) & _whole(name))


def _split_ties(
    tagged: DataFrame, shared: DataFrame, columns: Sequence[str], flag: str
) -> DataFrame:
    """Finish a split in which ``shared`` cut points fall inside a group of equal key hashes."""
    spark = tagged.sparkSession
    tied = (F.col("_hash") == F.col("_cut")) & ~_whole("cut")
    rows = tagged.filter(tied).select("_class", content_hash(columns).alias("_hash"))
    targets = shared.select("_class", F.col("_take").alias("_target"))
    cuts = _cut_points(rows, _buckets(rows), targets)

    settled = join_on(
        tagged.withColumn("_content", F.when(tied, content_hash(columns))),
        _named(cuts, "tie"),
        ["_class"],
        "left",
    )
    chosen = _taken(F.col("_hash"), "cut") | (tied & _taken(F.col("_content"), "tie"))
    divided = F.coalesce(
        tied & (F.col("_content") == F.col("_tie")) & ~_whole("tie"), F.lit(False)
    )
    kept = settled.filter(~divided).select(*columns, F.coalesce(chosen, F.lit(False)).alias(flag))
    if cuts.filter("_take < _n").isEmpty():
        return kept

    # One row per class stands for its copies; kept in the shared folder, so that later uses of the
    # split do not look for it again.
    shared_dir(spark)
    models = settled.filter(divided).dropDuplicates(["_class"]).checkpoint()
    numbers = F.array(
        F.struct(F.lit(True).alias(flag), F.col("_tie_take").alias("_copies")),
        F.struct(F.lit(False).alias(flag), (F.col("_tie_n") - F.col("_tie_take")).alias("_copies")),
    )
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return kept.unionByName(
        repeated(models.select(*columns, F.inline(numbers)), "_copies", partitions)
    )


def sides(flagged: DataFrame, flag: str = "is_train") -> tuple[DataFrame, DataFrame]:
    """Training and held-out rows of a flagged table."""
    return flagged.filter(F.col(flag)).drop(flag), flagged.filter(~F.col(flag)).drop(flag)


def fold_cuts(df: DataFrame, label: str, keys: Sequence[str], folds: int, seed: int = 42) -> DataFrame:
    """``(_class, _cuts)``: for every class the hashes after which a new fold begins, rising.

    Fold boundaries lie behind the first ``floor(i·n/folds)`` rows of a class in the order of the key
    hash. One count by class and leading hash digits finds the bucket of every boundary; only those
    buckets are counted hash by hash.
    """
    rows = df.select(F.col(label).alias("_class"), split_hash(seed, keys).alias("_hash"))
    buckets = localised(_buckets(rows))
    totals = buckets.groupBy("_class").agg(F.sum("_n").alias("_rows"))
    boundary = F.transform(
        F.sequence(F.lit(1), F.lit(folds - 1)),
        lambda i: F.struct(i.alias("_fold"), F.floor(i * F.col("_rows") / folds).alias("_target")),
    )
    wanted = totals.select("_class", F.inline(boundary))
    targets = wanted.filter("_target > 0")

    def crossed(counts: DataFrame, wanted: DataFrame, by: list[str]) -> DataFrame:
        steps = counts.withColumn("_upto", F.sum("_n").over(Window.partitionBy(*by).orderBy("_step")))
        before = F.col("_upto") - F.col("_n")
        met = join_on(steps, wanted, by, "inner")
        inside = (before < F.col("_target")) & (F.col("_target") <= F.col("_upto"))
        return met.filter(inside).withColumn("_target", F.col("_target") - before)

    coarse = localised(
        crossed(buckets, targets, ["_class"]).select(
            "_class", "_fold", F.col("_step").alias("_bucket"), "_target"
        )
    )
    digits = hash_prefix(F.col("_hash"), BUCKET_DIGITS)
    needed = coarse.select("_class", "_bucket").distinct()
    inside = join_on(rows.withColumn("_bucket", digits), needed, ["_class", "_bucket"], "inner")
    fine = inside.groupBy("_class", "_bucket", F.col("_hash").alias("_step")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    # A fold of a class with fewer rows than folds may end before the first row.
    before = wanted.filter("_target = 0").select("_class", F.lit("").alias("_step"))
    cuts = crossed(fine, coarse, ["_class", "_bucket"]).select("_class", "_step").unionByName(before)
    return localised(
        cuts.groupBy("_class").agg(F.array_sort(F.collect_list("_step")).alias("_cuts"))
    )


def stratified_folds(
    df: DataFrame, label: str, keys: Sequence[str], folds: int, seed: int = 42, output: str = "fold"
) -> DataFrame:
    """Add a fold from 0 to ``folds - 1``, with each class spread evenly over the folds.

    The table does not move: a row's fold is the number of cuts below its hash. Rows with one key
    share a fold, which keeps copies of a row out of the test of their own training; sizes then
    differ from even ones by the rows of a key.
    """
    if folds < 2:
        raise ValueError(f"folds must be at least 2, not {folds}")
    columns = df.columns
    hashed = df.withColumns({"_class": F.col(label), "_hash": split_hash(seed, keys)})
    tagged = join_on(hashed, fold_cuts(df, label, keys, folds, seed), ["_class"], "left")
    passed = F.size(F.filter("_cuts", lambda cut: cut < F.col("_hash")))
    return tagged.select(*columns, F.coalesce(F.when(F.col("_cuts").isNotNull(), passed), F.lit(0)).alias(output))
