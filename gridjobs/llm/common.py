"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir.

    Where that is unset, local mode (tests) has a temporary folder in its place; a cluster has no such folder, so there it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df once as Parquet into the shared folder and read it back: the lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(key: Column, modulus: int, remainder: int) -> Column:
    """crc32 of the key's text, modulo: the fixed split between learning and held-out rows."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def rows_by_key(batches: Iterator, keys: list[str]) -> Iterator:
    """Regroup the pandas batches of a partition that is sorted by keys, so that no key is cut by a batch's end."""
    import pandas as pd

    held = None
    for pdf in batches:
        if held is not None:
            pdf = pd.concat([held, pdf], ignore_index=True)
        if not len(pdf):
            continue
        last = pdf.iloc[-1]
        tail = (pdf[keys] == last[keys]).all(axis=1).to_numpy()
        cut = len(pdf) - int(tail[::-1].argmin() if not tail.all() else len(pdf))
        held = pdf.iloc[cut:]
        if cut:
            yield pdf.iloc[:cut].reset_index(drop=True)
    if held is not None and len(held):
        yield held.reset_index(drop=True)
