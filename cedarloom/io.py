"""Reading tables and cutting lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: list[tuple[object, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Taken from spark.checkpoint.dir; only where that is unset
    (tests, a single machine) a temporary folder is made and set."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.conf.get("spark.cedarloom.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="cedarloom-")
        spark.conf.set("spark.cedarloom.checkpoint.dir", path)
    return path.rstrip("/")


def cut(df: DataFrame, label: str = "step") -> DataFrame:
    """Write df to the shared folder and read it back: the lineage ends there, an executor that is
    lost loses nothing, and the planner knows the size. The files go when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cedarloom-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, label: str) -> str:
    """A folder below the shared one for files a query writes and reads again; it goes with the driver."""
    path = f"{shared_dir(spark)}/cedarloom-{label}-{uuid.uuid4().hex}"
    _WRITTEN.append((spark, path))
    return path


def _clean() -> None:
    for spark, path in _WRITTEN:
        try:
            jvm = spark._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the JVM may be gone already
            pass


atexit.register(_clean)
