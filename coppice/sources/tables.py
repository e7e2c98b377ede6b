"""Reading and writing tables by path or by catalog name, in any Spark format."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class TableRef:
    """A table at a path, or a catalog table when only ``name`` is given.

    With both, the catalog table keeps its files at that path. A path or table cannot be
    overwritten by a query that reads it; write to a new one.

    ``partitions`` are columns with their types, ``(("day", "string"), …)``, that become folders. The
    types are given because values read back from folder names would be guessed anew by each read.
    """

    path: str | None = None
    name: str | None = None
    fmt: str = "parquet"
    partitions: tuple[tuple[str, str], ...] = ()

    def __post_init__(self) -> None:
        if self.path is None and self.name is None:
            raise ValueError("a table needs a path or a name")

    @property
    def keys(self) -> list[str]:
        return [column for column, _ in self.partitions]

    def read(self, spark: SparkSession) -> DataFrame:
        if self.name is not None:
            return spark.table(self.name)
        reader = spark.read.format(self.fmt)
        if self.partitions:
            kinds = {c: T._parse_datatype_string(kind) for c, kind in self.partitions}
            found = reader.load(self.path).schema
            fields = [T.StructField(f.name, kinds.get(f.name, f.dataType), True) for f in found]
            reader = spark.read.format(self.fmt).schema(T.StructType(fields))
        return reader.load(self.path)

    def exists(self, spark: SparkSession) -> bool:
        if self.name is not None:
            return spark.catalog.tableExists(self.name)
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)

    def write(self, df: DataFrame, mode: str = "overwrite") -> None:
        writer = df.write.format(self.fmt).mode(mode)
        if self.partitions:
            writer = writer.partitionBy(*self.keys)
        if self.name is None:
            writer.save(self.path)
        elif self.path is None:
            writer.saveAsTable(self.name)
        else:
            writer.option("path", self.path).saveAsTable(self.name)

    def replace_partitions(self, df: DataFrame) -> None:
        """Write ``df`` in place of the partitions that it has rows for; all others stay.

        The files of a partition are exchanged when the whole write has succeeded, so a write that is
        repeated, also after a failure, leaves one copy.
        """
        if not self.partitions:
            raise ValueError("a table without partitions can only be overwritten as a whole")
        spark = df.sparkSession
        typed = df.withColumns({c: df[c].cast(kind) for c, kind in self.partitions})
        if self.name is None:
            writer = typed.write.format(self.fmt).mode("overwrite").partitionBy(*self.keys)
            writer.option("partitionOverwriteMode", "dynamic").save(self.path)
        elif not self.exists(spark):
            self.write(typed)
        else:
            # Inserts take the mode from the table's own options.
            spark.sql(
                f"ALTER TABLE {self.name} SET SERDEPROPERTIES ('partitionOverwriteMode' = 'dynamic')"
            )
            columns = spark.table(self.name).columns
            typed.select(*columns).write.mode("overwrite").insertInto(self.name)


def rows_to_table(spark: SparkSession, rows: Iterable, schema: T.StructType | str) -> DataFrame:
    """A few in-memory rows under a declared schema; for class names, settings and fixtures."""
    return spark.createDataFrame(list(rows), schema)
