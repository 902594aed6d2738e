"""Where intermediate tables and checkpoints go."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_given: dict[str, list[str]] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in `spark.checkpoint.dir`; where it is unset, a folder below the session's warehouse,
    which all executors share too.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not path:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
        if not warehouse:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = f"{warehouse.rstrip('/')}/_scratch"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Compute a frame once: written as Parquet to that folder and read back.

    For a frame that is read more than once and costs more to compute than to write, such as
    a resampled series. It outlives lost executors, and readers take only the columns and row
    groups they need. `forget` removes what a session has written this way.
    """
    path = fresh_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nothing has written to yet, below that folder."""
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _given.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def forget(spark: SparkSession) -> None:
    """Remove what this session has put below its scratch folder. Call it when no frame built from there is needed any more."""
    for path in _given.pop(spark.sparkContext.applicationId, []):
        delete_path(spark, path)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target))


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
