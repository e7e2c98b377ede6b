"""Run a job: ``python -m coppice train|stage|score|evaluate``.

On a cluster, submit this file with the package as a zip in ``--py-files``. Tables are given as
paths, or as catalog names with ``--catalog``.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from coppice.operators.features import INDEXED_FEATURES
from coppice.operators.learners import LEARNERS, learner
from coppice.plans import jobs
from coppice.settings import TrainSettings
from coppice.sources.registry import ModelRegistry
from coppice.sources.tables import TableRef


#: The pipeline for one text column; the others are learners over numeric columns.
TEXT = "text"


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="coppice", description=__doc__)
    parser.add_argument("--registry", required=True, help="folder of the registry tables")
    parser.add_argument("--model", required=True, help="registered model name")
    parser.add_argument("--format", default="parquet", help="table format")
    parser.add_argument("--catalog", action="store_true", help="tables are catalog names")
    commands = parser.add_subparsers(dest="command", required=True)

    train = commands.add_parser("train", help="split, fit, store and register")
    train.add_argument("--source", required=True)
    train.add_argument("--heldout", required=True)
    train.add_argument("--model-root", required=True)
    train.add_argument("--inputs", required=True, nargs="+")
    train.add_argument("--label", required=True)
    train.add_argument("--keys", required=True, nargs="+")
    train.add_argument("--learner", default="forest", choices=[*sorted(LEARNERS), TEXT])
    train.add_argument("--set", nargs="*", default=[], metavar="NAME=VALUE")

    stage = commands.add_parser("stage", help="move a version to a stage")
    stage.add_argument("--version", required=True, type=int)
    stage.add_argument("--stage", required=True)

    score = commands.add_parser("score", help="predict a table")
    score.add_argument("--mode", default="overwrite", choices=["overwrite", "append"])
    score.add_argument("--keep", nargs="+")
    score.add_argument("--truth", action="store_true", help="rows have labels to be judged by")

    evaluate = commands.add_parser("evaluate", help="score the held-out rows and judge them")
    evaluate.add_argument("--skip-scoring", action="store_true")

    for command in (score, evaluate):
        command.add_argument("--source", required=True)
        command.add_argument("--sink", required=True)
        command.add_argument("--stage", required=True)
    return parser


def run(spark: SparkSession, argv: Sequence[str]) -> dict[str, object]:
    """Run one command; returns what is worth printing."""
    args = _parser().parse_args(argv)
    registry = ModelRegistry(spark, args.registry)

    def table(place: str) -> TableRef:
        where = {"name": place} if args.catalog else {"path": place}
        return TableRef(fmt=args.format, **where)

    if args.command == "train":
        settings = TrainSettings.from_strings(dict(item.split("=", 1) for item in args.set))
        if args.learner == TEXT:
            stages = jobs.text_pipeline(args.inputs[0], args.label, settings)
        else:
            estimator = learner(args.learner, settings, INDEXED_FEATURES)
            stages = jobs.tabular_pipeline(args.inputs, args.label, settings, estimator)
        version = jobs.train(
            spark,
            table(args.source),
            table(args.heldout),
            registry,
            args.model,
            args.model_root,
            args.inputs,
            args.label,
            args.keys,
            settings,
            stages,
        )
        return {"version": version.version, "run_id": version.run_id, "source": version.source}
    if args.command == "stage":
        registry.set_stage(args.model, args.version, args.stage)
        return {"version": args.version, "stage": args.stage}
    source, sink = table(args.source), table(args.sink)
    if args.command == "score":
        used = jobs.score(
            spark, source, sink, registry, args.model, args.stage, args.mode, args.keep, args.truth
        )
        return {"version": used.version, "sink": args.sink}
    result = jobs.evaluate(
        spark, source, sink, registry, args.model, args.stage, scoring=not args.skip_scoring
    )
    accuracy = {str(r["model_version"]): r["accuracy"] for r in result.accuracy.toLocalIterator()}
    return {"accuracy": accuracy}


def main() -> None:
    spark = SparkSession.builder.appName("coppice").getOrCreate()
    print(json.dumps(run(spark, sys.argv[1:])))


if __name__ == "__main__":
    main()
