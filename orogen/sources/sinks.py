"""Sinks: tables by format, split and per-class CSV, rasters as tiles, points as GeoParquet or GeoPackage, metadata."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from orogen.functions.geometry import point_wkb
from orogen.functions.names import safe_filename
from orogen.operators.stats import numbered, sample_n
from orogen.sources.storage import arrow_uri

NODATA = -9999.0


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """csv (with a header), parquet (snappy), json or orc."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.option("compression", "snappy").parquet(path)
    elif fmt in ("json", "orc"):
        writer.format(fmt).save(path)
    else:
        raise ValueError(f"unknown format {fmt}")


def split_parts(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """With a 1-based id in order and the number of its part: n contiguous parts of equal size, the last one maybe shorter."""
    chunk = F.ceil(df.agg(F.count("*")).scalar() / F.lit(n))
    return numbered(df, order).withColumn("part", F.ceil(F.col("id") / chunk).cast("long"))


def write_csv_split(df: DataFrame, path: str, n: int, order: Sequence[str]) -> None:
    """One folder for each part."""
    parts = split_parts(df, n, order)
    parts.select("id", *df.columns, "part").repartition("part").sortWithinPartitions("id").write.mode("overwrite").partitionBy("part").option("header", True).csv(path)


def write_csv_sample(df: DataFrame, path: str, share: float, key: str, seed: int = 42) -> None:
    """A random share of the rows, at least one."""
    write_table(sample_n(df, max(1, int(df.count() * share)), key, seed), path, "csv")


def write_per_class(df: DataFrame, path: str, label: str = "label") -> None:
    """CSV in one folder for each class; the null class is 'NaN'."""
    out = df.withColumn("class_dir", safe_filename(F.col(label)))
    out.write.mode("overwrite").partitionBy("class_dir").option("header", True).csv(path)


def filled(cells: DataFrame, nodata: float = NODATA) -> DataFrame:
    return cells.withColumn("z", F.coalesce("z", F.lit(nodata)))


def tiles_of(cells: DataFrame, size: int = 256, nodata: float = NODATA, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, tile_r, tile_c, h, w, data): float32 tiles, one record each; `cells` must be whole."""
    kinds = "".join(f"`{k}` {cells.schema[k].dataType.simpleString()}, " for k in keys)

    def run(pdf):  # one tile
        h, w = int(pdf["i"].max()) + 1, int(pdf["j"].max()) + 1
        data = np.full((h, w), nodata, dtype="<f4")
        z = pdf["z"].to_numpy(float)
        data[pdf["i"], pdf["j"]] = np.where(np.isnan(z), nodata, z)
        return pdf.iloc[:1][[*keys, "tile_r", "tile_c"]].assign(h=h, w=w, data=[data.tobytes()])

    placed = cells.select(*keys, F.floor(F.col("r") / size).alias("tile_r"), F.floor(F.col("c") / size).alias("tile_c"), (F.col("r") % size).alias("i"), (F.col("c") % size).alias("j"), F.col("z").cast("double"))
    return placed.groupBy(*keys, "tile_r", "tile_c").applyInPandas(run, f"{kinds}tile_r long, tile_c long, h int, w int, data binary")


def cells_of(tiles: DataFrame, size: int = 256, nodata: float = NODATA, keys: Sequence[str] = ()) -> DataFrame:
    """The cells of tiles again; the no-data value is null."""
    kinds = "".join(f"`{k}` {tiles.schema[k].dataType.simpleString()}, " for k in keys)

    def run(parts):
        import pandas as pd

        for pdf in parts:
            for t in pdf.itertuples(index=False):
                z = np.frombuffer(t.data, "<f4").astype(float)
                r, c = np.divmod(np.arange(t.h * t.w), t.w)
                out = pd.DataFrame({"r": r + t.tile_r * size, "c": c + t.tile_c * size, "z": np.where(z == np.float32(nodata), np.nan, z)})
                for k in reversed(keys):
                    out.insert(0, k, getattr(t, k))
                yield out

    out = tiles.mapInPandas(run, f"{kinds}r long, c long, z double")
    return out.withColumn("z", F.when(~F.isnan("z"), F.col("z")))


def with_point_geometry(df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Rows with both coordinates and their WKB point; a column called fid is renamed."""
    out = df.dropna(subset=[x, y]).withColumn("geometry", point_wkb(F.col(x).cast("double"), F.col(y).cast("double")))
    return out.withColumnRenamed("fid", "fid_orig")


def geo_metadata(epsg: int) -> str:
    """The footer entry that marks GeoParquet."""
    column = {"encoding": "WKB", "geometry_types": ["Point"], "crs": {"id": {"authority": "EPSG", "code": epsg}}}
    return json.dumps({"version": "1.0.0", "primary_column": "geometry", "columns": {"geometry": column}})


def write_geoparquet(df: DataFrame, path: str, epsg: int, x: str = "x", y: str = "y", mode: str = "overwrite") -> None:
    """Points as Parquet with WKB, one file for each partition; each has the mark in its footer, which Spark's own writer cannot set.

    Tasks write by Arrow's file systems into a hidden folder beside `path`, each under a hidden name first, so that a task that is run
    again replaces its file. Only when all have ended does the folder take the place of what was there: a job that fails
    changes nothing, and a table may be written over the one it is read from. Modes: 'overwrite', or 'error' if there is something.
    """
    if mode not in ("overwrite", "error"):
        raise ValueError("mode must be 'overwrite' or 'error'")
    out = with_point_geometry(df, x, y)
    schema = to_arrow_schema(out.schema).with_metadata({"geo": geo_metadata(epsg)})
    uri = arrow_uri(path)
    system, root = fs.FileSystem.from_uri(uri)
    root = root.rstrip("/")
    if mode == "error" and system.get_file_info(root).type != fs.FileType.NotFound:
        raise FileExistsError(path)
    parent, name = root.rsplit("/", 1)
    waiting = f"{parent}/_{name}-{uuid.uuid4().hex}"
    system.create_dir(waiting)

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(uri)
        task = TaskContext.get()
        hidden, rows = f"{waiting}/_{task.partitionId()}-{task.taskAttemptId()}", 0
        with system.open_output_stream(hidden) as sink, pq.ParquetWriter(sink, schema, compression="snappy") as writer:
            for batch in parts:
                writer.write_table(pa.Table.from_batches([batch]).cast(schema))
                rows += batch.num_rows
        system.move(hidden, f"{waiting}/part-{task.partitionId():05d}.parquet")
        yield pa.RecordBatch.from_arrays([pa.array([rows])], ["n"])

    try:
        if out.mapInArrow(write, "n long").agg(F.count("*")).first()[0] == 0:  # no partition at all: the schema is kept
            pq.write_table(schema.empty_table(), f"{waiting}/part-00000.parquet", filesystem=system)
    except BaseException:
        system.delete_dir(waiting)
        raise
    found = system.get_file_info(root).type
    if found == fs.FileType.Directory:
        system.delete_dir(root)
    elif found == fs.FileType.File:
        system.delete_file(root)
    for left in system.get_file_info(fs.FileSelector(waiting)):  # files of attempts that failed
        if left.base_name.startswith("_"):
            system.delete_file(left.path)
    system.move(waiting, root)


def json_default(value: object) -> object:
    """numpy values for json."""
    if isinstance(value, np.generic):
        return value.item()
    if isinstance(value, np.ndarray):
        return value.tolist()
    if isinstance(value, (set, tuple)):
        return list(value)
    if isinstance(value, Path):
        return str(value)
    raise TypeError(f"{type(value)} is not JSON")


def save_json(df_or_spark, path: str, content: dict) -> None:
    """A small JSON document, written by Spark so that it reaches any store."""
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    text = json.dumps(content, default=json_default, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_json(spark, path: str) -> dict:
    return json.loads("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))
