"""Lineage cuts in the folder that all nodes share.

``staged`` writes a table under ``spark.checkpoint.dir`` and reads it back, so that what follows neither
recomputes nor depends on executors that may be gone. The session's setting is used where there is one; only
without it, and with a local master (tests, local runs), a folder of this machine is set.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; set to a local one where unset, which only a local master allows."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all nodes share")
        found = "file://" + tempfile.mkdtemp(prefix="quillsift-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses; what is there goes when the application ends."""
    path = f"{shared_dir(spark)}/quillsift/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    target, system = _file_system(spark, path)
    system.deleteOnExit(target)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df``, written once as Parquet to the shared folder and read again."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def dropped(table: DataFrame) -> None:
    """Deletes the files of a table of ``staged`` that no later step reads; of other tables none."""
    if path := vars(table).get("staged_at"):
        target, system = _file_system(table.sparkSession, path)
        system.delete(target, True)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of 1000 texts and 8 MB at most, where the session has Spark's own defaults: whole texts can be long."""
    for name, usual, wanted in (("maxRecordsPerBatch", "10000", "1000"), ("maxBytesPerBatch", "67108864b", "8m")):
        if spark.conf.get(f"spark.sql.execution.arrow.{name}", usual) == usual:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", wanted)
