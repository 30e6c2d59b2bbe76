"""Tables that cut lineage, in the folder that every machine of the cluster sees."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Paths and catalogue tables that this driver has written and not yet removed.
_WRITTEN: list[tuple[str, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; one of our own only in local mode, where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="fringeframe-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the application's own folder that no other table has, removed by ``scratch``."""
    path = f"{shared_folder(spark).rstrip('/')}/fringeframe-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(("path", path))
    return path


def new_table(spark: SparkSession) -> str:
    """A catalogue name that no other table has, dropped by ``scratch``."""
    name = f"fringeframe_{uuid.uuid4().hex}"
    _WRITTEN.append(("table", name))
    return name


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, no lineage, safe when executors are lost."""
    path = new_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Lets go of the shuffles of queries that have ended: Spark removes their files, on every machine, only once the
    driver's garbage is collected, which a driver with little to do may put off for long."""
    spark._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder, in whatever store it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, the intermediate tables written inside: write an operator's result before that."""
    before = len(_WRITTEN)
    try:
        yield
    finally:
        while len(_WRITTEN) > before:
            kind, name = _WRITTEN.pop()
            if kind == "table":
                spark.sql(f"DROP TABLE IF EXISTS {name}")
            else:
                remove(spark, name)
