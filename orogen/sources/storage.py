"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only in local mode, where driver and tasks are one process."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="orogen-"))
    return sc.getCheckpointDir()


def kept(df: DataFrame) -> DataFrame:
    """`df`, written once to the shared folder: what is read twice is then the same rows both times."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """As `kept`, by a table: a checkpoint keeps what the optimizer knows of its rows, which grows from round to round in a loop."""
    path = f"{shared_folder(df.sparkSession)}/round-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_uri(path: str) -> str:
    """A path or URI as Arrow's file systems take it; a path without a scheme is local or mounted."""
    if path.startswith("file:"):
        return f"file:///{path.removeprefix('file:').lstrip('/')}"
    return path if ":" in path.split("/")[0] else Path(path).absolute().as_uri()
