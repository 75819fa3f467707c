"""Helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which driver and executors share.

    Where the setting is unset, a local session (as in tests) gets a temporary folder of its own;
    any other session is refused, because executors would write to disks nobody else sees.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write df as Parquet to the shared folder and read it: cuts lineage, survives lost executors."""
    path = shared_folder(df.sparkSession)
    writer = df.write if partition_by is None else df.write.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Steps:
    """Tables that the steps of one run write for each other, in one new shared folder.

    The shuffle files of a write are removed when it ends, a table when the run drops it. Left to themselves, shuffle files stay
    until the driver happens to collect its garbage, so that the disk holds all steps at once.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.paths, self.n = spark, shared_folder(spark), {}, 0

    def stored(self, df: DataFrame) -> DataFrame:
        """Write df as Parquet and read it."""
        self.n += 1
        path, before = f"{self.folder}/{self.n}", self.spark.conf.get(RELEASE)
        self.spark.conf.set(RELEASE, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(RELEASE, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = out, path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables that nothing reads any more."""
        context = self.spark.sparkContext
        for t in tables:
            path = context._jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(t))[1])
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, LOWER)


def whole(c: Column) -> Column:
    """A text, with null as the empty text."""
    return F.coalesce(c, F.lit(""))
