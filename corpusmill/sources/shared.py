"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a local one is made only where none is set and one machine does all."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='corpusmill-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialize(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """``df`` written as Parquet and read back: cuts lineage at files that survive lost executors."""
    path = f"{shared_dir(df.sparkSession)}/corpusmill/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Inputs of this size in bytes are dealt out to all cores before heavy work; larger ones have files and row groups enough.
SPREAD_FROM, SPREAD_TO = 4 << 20, 256 << 20


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores if it is small: a small table is often one row group, which one task reads. Others stay as they are."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if SPREAD_FROM <= size <= SPREAD_TO and cores > 1 else df
