"""Session settings and the shared-folder tables that cut long lineages."""

from __future__ import annotations

import itertools
import re
import tempfile
import uuid
from types import TracebackType

from pyspark.sql import DataFrame, SparkSession

# Run-time settings the plans rely on. AQE splits hot PATIDs in joins; the force flag lets it do so
# even where a later step could have reused the join's partitioning.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one only for runs in a single process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="renalis-")


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder from whatever store it is in."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    """Makes the folder, to be removed when the driver's JVM ends, if nobody clears it before."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(folder)
    store.deleteOnExit(folder)


class Workspace:
    """Tables of one run, written to the shared folder and read back; a context that drops them.

    What is not dropped by then goes with the application: results that are not cleared stay readable
    as long as it runs.

    Names may repeat, as each table has a folder of its own. A written table survives the loss of
    executors, is scanned with column pruning by each of its readers, and has a known size, so that
    Spark's own broadcast decision rests on a measured one.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.path = f"{root or scratch_root(spark)}/renalis-{uuid.uuid4().hex}"
        _delete_on_exit(spark, self.path)
        self.numbers = itertools.count(1)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(
        self, kind: type | None, error: BaseException | None, trace: TracebackType | None
    ) -> None:
        self.clear()

    def folder(self, name: str) -> str:
        """A new folder of the run."""
        number = next(self.numbers)  # threads may cut tables at the same time
        return f"{self.path}/{number:03d}-{name}"

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        target = self.folder(name)
        df.write.parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def clear(self) -> None:
        """Drop this run's tables, once nothing reads them any more."""
        delete_folder(self.spark, self.path)
