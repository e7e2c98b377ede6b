"""The kernel classifier on rings, its probabilities, and its file."""

import math
import random

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array

from coppice.operators.kernels import KernelSVC, RandomFourierMap
from coppice.operators.learners import learner
from coppice.plans import jobs
from coppice.settings import TrainSettings
from coppice.sources.models import load_model, save_model
from coppice.sources.workspace import scratch_path

SETTINGS = TrainSettings(max_iter=8, gamma=1.0, kernel_features=100)


def rings(spark, radii, n=300):
    rng = random.Random(7)
    rows = []
    for label, radius in enumerate(radii):
        for _ in range(n):
            angle, r = rng.uniform(0, 2 * math.pi), radius + rng.gauss(0, 0.1)
            rows.append((len(rows), r * math.cos(angle), r * math.sin(angle), f"ring {label}"))
    return spark.createDataFrame(rows, "id long, x double, y double, label string").coalesce(2)


def tried(df, name, settings=SETTINGS):
    estimator = learner(name, settings)
    scored, accuracy = jobs.fit_and_test(df, estimator, ["x", "y"], "label", ["id"], settings)
    return scored, accuracy.first()["accuracy"]


def test_two_rings_need_the_kernel(spark):
    df = rings(spark, [1.0, 2.0])
    assert tried(df, "linear_svc")[1] < 0.65
    scored, accuracy = tried(df, "kernel_svc")
    assert accuracy > 0.95
    assert not {"_scaled", "_mapped"} & set(scored.columns)
    rows = scored.select("probability", "indexedLabel").collect()
    assert all(abs(sum(r["probability"]) - 1) < 1e-9 for r in rows)
    assert np.mean([r["probability"][int(r["indexedLabel"])] for r in rows]) > 0.85


def test_three_rings_balanced_and_reloaded(spark):
    df = rings(spark, [0.5, 1.5, 2.5]).filter("label != 'ring 2' OR id % 3 = 0")
    settings = SETTINGS.but(class_weight="balanced")
    scored, accuracy = tried(df, "kernel_svc", settings)
    assert accuracy > 0.95
    assert {len(r["probability"]) for r in scored.select("probability").collect()} == {3}
    stages = jobs.tabular_pipeline(["x", "y"], "label", settings, learner("kernel_svc", settings))
    model = jobs.fit(df, ["x", "y"], "label", stages, settings)
    path = scratch_path(spark, "models")
    save_model(model, path)
    columns = ["id", "prediction", "probability", "rawPrediction", "predicted_label"]
    before = jobs.predict(model, df).select(*columns)
    after = jobs.predict(load_model(path), df).select(*columns)
    assert before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty()


def test_features_approximate_the_kernel(spark):
    rng = np.random.default_rng(1)
    points = rng.normal(size=(20, 3))
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id int, a array<double>")
    mapping = RandomFourierMap(inputCol="v", outputCol="z", features=4000, size=3, gamma=0.5, seed=3)
    rows = mapping.transform(df.select("id", array_to_vector("a").alias("v")))
    z = np.array([r["z"] for r in rows.orderBy("id").select(vector_to_array("z").alias("z")).collect()])
    exact = np.exp(-0.5 * ((points[:, None] - points[None]) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - exact).max() < 0.08
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_class_unseen_by_the_calibration_keeps_a_plain_sigmoid(spark):
    margins = spark.createDataFrame([(0.0, [1.0, -1.0]), (0.0, [2.0, -2.0])], "label double, margins array<double>")
    assert KernelSVC._line(margins, 1) == (1.0, 0.0)


