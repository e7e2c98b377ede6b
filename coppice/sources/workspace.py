"""The shared folder that checkpoints and intermediate tables go to."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


_LOCAL = re.compile(r"local(\[[^\]]*\])?")


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, also set as the checkpoint directory.

    Only a local session without the setting gets a temporary folder: on a cluster such a folder
    would not be seen by the other machines.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current is None:
        if configured is None and not _LOCAL.fullmatch(context.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="coppice-"))
        current = context.getCheckpointDir()
    return configured or current


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
