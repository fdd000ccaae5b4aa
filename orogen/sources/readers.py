"""Tables from files by format, with their encodings, bounds and metadata."""

from __future__ import annotations

import io
import json
from collections.abc import Iterator, Sequence
from functools import reduce
from operator import or_

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orogen.operators.joins import clipped
from orogen.operators.stats import sample_n
from orogen.operators.tables import number
from orogen.sources import geopackage, rasters
from orogen.sources.storage import arrow_uri

FORMATS = {
    "csv": "csv", "txt": "csv", "tsv": "csv", "parquet": "parquet", "pq": "parquet", "geoparquet": "parquet", "gpkg": "geopackage", "geopackage": "geopackage",
    "geojson": "geojson", "json": "json", "orc": "orc", "tif": "geotiff", "tiff": "geotiff",
}
#: Tried in this order; the last one takes what comes.
ENCODINGS = ("UTF-8", "cp932")


def format_of(path: str) -> str:
    """Format by the extension of a path."""
    ext = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if ext not in FORMATS:
        raise ValueError(f"unknown kind of file: {path}")
    return FORMATS[ext]


def output_name(path: str, ext: str) -> str:
    """The path with another extension."""
    stem, dot, _ = path.rpartition(".")
    return f"{stem if dot else path}.{ext.lstrip('.')}"


def read_csv(spark: SparkSession, path: str, encodings: Sequence[str] = ENCODINGS, **options: object) -> DataFrame:
    """A CSV file with a header in the first encoding that leaves no undecodable character; a byte order mark is dropped.

    Spark splits UTF-8 files. It reads no other eight-bit encodings itself, so such files are decoded whole, a task for each.
    """
    for encoding in encodings:
        if encoding.upper() == "UTF-8":
            df = spark.read.options(**({"header": True, "inferSchema": True} | options)).csv(path)
        else:
            df = _decoded_csv(spark, path, encoding)
        df = df.toDF(*[c.lstrip("\ufeff").strip('"') for c in df.columns])
        text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
        bad = any("\ufffd" in c for c in df.columns)
        if not bad and text:
            bad = df.where(reduce(or_, [F.contains(F.col(f"`{c}`"), F.lit("\ufffd")) for c in text])).limit(1).count() > 0
        if not bad:
            break
    return df


def _decoded_csv(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """Columns as text, or as doubles where every value is a number."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def parsed(content: bytes, **options: object) -> pd.DataFrame:
        return pd.read_csv(io.BytesIO(content), encoding=encoding, encoding_errors="replace", dtype=str, **options)

    def header(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pd.DataFrame({"names": [list(parsed(c, nrows=0).columns) for c in pdf["content"]]})

    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield from (parsed(c).reindex(columns=names) for c in pdf["content"])

    names = files.mapInPandas(header, "names array<string>").first()["names"]
    df = files.mapInPandas(rows, T.StructType([T.StructField(n, T.StringType()) for n in names]))
    whole = df.agg(*[F.min(F.coalesce(number(F.col(f"`{n}`")).isNotNull(), F.col(f"`{n}`").isNull())).alias(f"k{i}") for i, n in enumerate(names)]).first()
    return df.select(*[(number(F.col(f"`{n}`")) if whole[f"k{i}"] else F.col(f"`{n}`")).alias(n) for i, n in enumerate(names)])


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """One row for each feature of a collection: its properties and the geometry as GeoJSON text."""
    got = spark.read.option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    props = got.schema["f"].dataType["properties"].dataType
    names = [f.name for f in props] if isinstance(props, T.StructType) else []
    return got.select(*[F.col(f"f.properties.`{n}`").alias(n) for n in names], F.to_json("f.geometry").alias("geometry"))


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    columns: Sequence[str] | None = None,
    bbox: tuple[float, float, float, float] | None = None,
    head: int | None = None,
    sample: int | None = None,
    key: str | None = None,
    layer: str | None = None,
    geometry: bool = False,
) -> DataFrame:
    """A table by format; with a box it needs columns x and y. Geometry is dropped unless asked for."""
    fmt = fmt or format_of(path)
    if fmt == "csv":
        df = read_csv(spark, path)
    elif fmt == "geopackage":
        df = geopackage.read(spark, path, layer)
    elif fmt == "geojson":
        df = read_geojson(spark, path)
    elif fmt == "geotiff":
        df = rasters.read_cells(spark, path)
    else:
        df = spark.read.format(fmt).load(path)
    if not geometry:
        df = df.drop("geometry", "geom")
    if bbox is not None:
        df = clipped(df, bbox)
    if columns is not None:
        df = df.select(*columns)
    if sample is not None:
        return sample_n(df, sample, key or df.columns[0])
    return df.limit(head) if head is not None else df


def inspect(spark: SparkSession, path: str, fmt: str | None = None) -> dict[str, object]:
    """Columns, kinds and row count; a Parquet count reads footers only."""
    df = read_table(spark, path, fmt, geometry=True)
    geo = (fmt or format_of(path)) == "parquet" and is_geoparquet(spark, path)
    return {"columns": df.columns, "types": dict(df.dtypes), "rows": df.count(), "geo": geo}


def geo_footer(spark: SparkSession, path: str) -> dict | None:
    """The footer entry `geo` of the first file of a Parquet table; none if it has none.

    A task reads the footer alone, by Arrow's file systems, however long the file is. Stores that only Spark's reader knows are read by it.
    """
    files = spark.read.parquet(path).inputFiles()
    if not files:
        return None

    def mark(source) -> str | None:
        found = (pq.read_schema(source).metadata or {}).get(b"geo")
        return found.decode() if found else None

    def footer(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            marks = []
            for name in pdf["path"]:
                system, place = fs.FileSystem.from_uri(name)
                with system.open_input_file(place) as source:
                    marks.append(mark(source))
            yield pd.DataFrame({"geo": marks})

    def whole(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pd.DataFrame({"geo": [mark(io.BytesIO(c)) for c in pdf["content"]]})

    first = arrow_uri(min(files))
    try:
        fs.FileSystem.from_uri(first)
        known = True
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
        known = False
    if known:
        got = spark.createDataFrame([(first,)], "path string").mapInPandas(footer, "geo string").first()
    else:
        got = spark.read.format("binaryFile").load(first).select("content").mapInPandas(whole, "geo string").first()
    return json.loads(got["geo"]) if got and got["geo"] else None


def is_geoparquet(spark: SparkSession, path: str) -> bool:
    """Whether the footer marks GeoParquet, whoever wrote it."""
    return geo_footer(spark, path) is not None


def boxes(spark: SparkSession, path: str) -> DataFrame:
    """(name, Xmin, Ymin, Xmax, Ymax) of a CSV with these columns; rows that do not parse are left out."""
    df = read_csv(spark, path, inferSchema=False)
    needed = ["name", "Xmin", "Ymin", "Xmax", "Ymax"]
    if missing := [c for c in needed if c not in df.columns]:
        raise ValueError(f"the file lacks {missing}")
    return df.select("name", *[F.col(c).try_cast("double").alias(c) for c in needed[1:]]).dropna()


def boxes_from_rows(spark: SparkSession, rows: Sequence[tuple[str, float, float, float, float]]) -> DataFrame:
    return spark.createDataFrame(list(rows), "name string, Xmin double, Ymin double, Xmax double, Ymax double")


def load_config(spark: SparkSession, path: str) -> dict:
    """A batch configuration; it must have 'runs'."""
    config = json.loads("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))
    if not isinstance(config.get("runs"), list):
        raise ValueError("a batch needs a list of 'runs'")
    return config


def list_files(spark: SparkSession, root: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """(path, modificationTime, length) of the files under a folder, contents unread."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive)
    return reader.load(root).select("path", "modificationTime", "length").dropDuplicates(["path"])
