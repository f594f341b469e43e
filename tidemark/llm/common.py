"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Maps A-Z to a-z and leaves every other byte alone, also inside UTF-8 sequences.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one that the cluster names, else one in the warehouse."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir() or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


#: Spark's own removal of an execution's shuffle files as soon as it ends; its output is a table by then.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def materialize(df: DataFrame, name: str = "step", batch_rows: int | None = None) -> DataFrame:
    """Cut the lineage: write a table to the shared folder and read it back, so a lost executor repeats nothing above.

    The table read back has no partitioning of its own, which leaves Spark free to split skewed keys of a later join.
    It is deleted by discard(), or when the application ends. ``batch_rows``: rows that Python workers get at a time.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    own = {_CLEANUP: "true"} | ({_BATCH: str(batch_rows)} if batch_rows else {})
    before = {k: spark.conf.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    back = spark.read.schema(df.schema).parquet(path)
    back._scratch = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete materialized tables that nothing reads any more."""
    for df in tables:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. lower() is the fast way and right unless a capital beyond ASCII occurs."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    plain = (F.length(text) == F.octet_length(text)) | ~text.rlike(r"[[^\x00-\x7F]&&[\p{Lu}\p{Lt}İⅠ-ⅯⒶ-Ⓩ]]")
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, lower))
