"""Scratch tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset, a local session gets a folder of its own; a cluster must name one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-scratch-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


#: Files of a slim table for each core.
FILES_A_CORE = 6


def materialize(df: DataFrame, name: str, slim: bool = False) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back; ``slim`` tables (rows of a few numbers) in few files for each core.

    Cuts the lineage, so a lost executor costs a re-read and not a recomputation, and unlike ``checkpoint()`` computes ``df`` once and
    gives the optimizer sizes. The tables stay until the owner of the folder clears it.
    """
    spark = df.sparkSession
    if slim:
        df = df.coalesce(FILES_A_CORE * spark.sparkContext.defaultParallelism)
    path = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_observed(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict[str, object]]:
    """``materialize``, and aggregates of ``df`` taken while it is written, so they cost no scan of their own. They pass the driver: one value each."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    out = materialize(df.observe(seen, *[m.alias(k) for k, m in measures.items()]), name)
    return out, dict(seen.get)


def file_system(path: str):
    """The file system of a path or URI, as Python sees it in tasks, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def pushed(spark: SparkSession) -> str:
    """The option that tells this library's sources whether Spark pushes filters to Python sources in this session; it refuses readers that take them if not."""
    return spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
