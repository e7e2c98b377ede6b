"""Make this package importable in Python workers, wherever the session runs."""

from __future__ import annotations

import io
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame

_PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def with_package(df: DataFrame) -> DataFrame:
    """``df``, after the package's sources were handed to Spark once for this application.

    Spark serves them to the executors, also to those that join later. Installed packages need no
    such help, but a checkout that only the driver has on its path does.
    """
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as archive:
            for file in sorted(_PACKAGE.rglob("*.py")):
                archive.write(file, file.relative_to(_PACKAGE.parent))
        target = Path(tempfile.mkdtemp(prefix="package-")) / f"{_PACKAGE.name}.zip"
        target.write_bytes(packed.getvalue())
        context.addPyFile(str(target))
    return df
