"""New point tables scored as they arrive, and their class counts by time.

The operators it builds on are stateless, so a stream is scored by the same functions as a table; only the counts keep state, and
the watermark bounds it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from orogen.operators.ml import predict


def table_stream(spark: SparkSession, folder: str, schema: StructType, fmt: str = "parquet", files_per_batch: int = 100) -> DataFrame:
    """Rows of the files that appear in a folder."""
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch).load(folder)


def scored(stream: DataFrame, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    return predict(model, stream, features)


def counts_by_time(stream: DataFrame, time: str, value: str, width: str = "1 hour", lateness: str = "1 hour") -> DataFrame:
    """(start, value, count) per window; rows later than `lateness` are left out."""
    counted = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lateness).groupBy(F.window(time, width), F.col(value).alias("value")).agg(F.count("*").alias("count"))
    return counted.select(F.col("window.start").alias("start"), "value", "count")


def write_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", once: bool = False) -> StreamingQuery:
    writer = stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start(path)
