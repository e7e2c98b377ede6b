"""Fitted pipelines on disk, with their signature beside them: the columns they need and add."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONTRACT = "contract"


def save_model(
    model: PipelineModel,
    path: str,
    inputs: T.StructType | None = None,
    outputs: T.StructType | None = None,
) -> None:
    """Save a pipeline; ``inputs`` are the columns it needs at scoring, ``outputs`` those it adds."""
    model.write().overwrite().save(path)
    if inputs is not None:
        signature = T.StructType().add("inputs", inputs).add("outputs", outputs or T.StructType())
        spark = SparkSession.getActiveSession()
        spark.range(1).select(F.lit(signature.json()).alias("value")).coalesce(1).write.mode(
            "overwrite"
        ).text(f"{path}/{CONTRACT}")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_contract(spark: SparkSession, path: str, side: str = "inputs") -> T.StructType:
    """One side of the signature, ``inputs`` or ``outputs``."""
    text = spark.read.text(f"{path}/{CONTRACT}").first()["value"]
    return T.StructType.fromJson(json.loads(text))[side].dataType


def check_contract(df: DataFrame, contract: T.StructType, side: str = "input") -> None:
    """Raise unless every contracted column is there with its type; more columns are fine."""
    given = {f.name: f.dataType for f in df.schema}
    missing = [f.name for f in contract if f.name not in given]
    if missing:
        raise ValueError(f"missing {side} columns: {', '.join(missing)}")
    changed = [
        f"{f.name} is {given[f.name].simpleString()}, expected {f.dataType.simpleString()}"
        for f in contract
        if given[f.name] != f.dataType
    ]
    if changed:
        raise ValueError(f"{side} columns changed type: {'; '.join(changed)}")


def contract_of(df: DataFrame, columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, df.schema[c].dataType, True) for c in columns])
