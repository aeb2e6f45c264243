"""Session look-ups shared by the jobs: the folder every executor can reach."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR_SETTING = "spark.checkpoint.dir"
# The setting above belongs to the cluster and is fixed once a session runs; this one is set for a local
# session that has none.
LOCAL_DIR_SETTING = "spark.addrloom.localSharedDir"

# Bytecode size up to which the JVM compiles a method. Address rows take long expressions; fused into
# one larger method they would run interpreted, several times slower than unfused.
COMPILED_METHOD_BYTES = 8000


def tune(spark: SparkSession) -> SparkSession:
    """Let Spark fall back to split expression code where a fused method would be too large."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", COMPILED_METHOD_BYTES)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder that the session names; there is no default, as none would be shared."""
    root = spark.conf.get(SHARED_DIR_SETTING, None) or spark.conf.get(LOCAL_DIR_SETTING, None)
    if not root:
        raise ValueError(f"set {SHARED_DIR_SETTING} to a folder that driver and executors share")
    return root.rstrip("/")


def name_local_shared(spark: SparkSession, folder: str) -> None:
    """Name ``folder`` as the shared one where none is set and all tasks run in this process."""
    try:
        shared_root(spark)
    except ValueError:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise
        spark.conf.set(LOCAL_DIR_SETTING, folder)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/addrloom/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, *, compression: str | None = None) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    path = shared_path(df.sparkSession, name)
    writer = df.write.mode("overwrite")
    if compression is not None:
        writer = writer.option("compression", compression)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
