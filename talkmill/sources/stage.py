"""Stage boundaries: a DataFrame written to the folder that driver and executors share and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of our own only where it is unset and Spark runs on one machine, as in tests."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="spark-stage-"))
    return "file://" + _own[0]


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder among those of this application, which ``discard_stages`` removes."""
    return f"{shared_folder(spark)}/stages-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Long pattern chains are computed once: filters on what follows are not pushed into them, and lost executors cost only reads."""
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard_stages(spark: SparkSession) -> None:
    """Removes every stage of this application. Frames that read them are of no use after that: write their results first."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/stages-{spark.sparkContext.applicationId}")
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
