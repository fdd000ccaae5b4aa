"""GeoPackage layers as tables, and tables as GeoPackages.

Spark reads the files, tasks open them in memory; a file is one task's work. Writing gives one package for each partition
as a binary column, as a package cannot be written by many tasks at once.
"""

from __future__ import annotations

import sqlite3
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orogen.functions.geometry import wkb_point
from orogen.functions.names import kind_of_sql


def _open(content: bytes) -> sqlite3.Connection:
    con = sqlite3.connect(":memory:")
    con.deserialize(content)
    return con


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def wkb_of(blob: bytes | None) -> bytes | None:
    """WKB without the package's header."""
    if not blob or blob[:2] != b"GP":
        return None
    envelope = (0, 32, 48, 48, 64)[(blob[3] >> 1) & 7]
    return blob[8 + envelope :]


def point_blob(x: float, y: float, epsg: int) -> bytes:
    return struct.pack("<2sBBi", b"GP", 0, 1, epsg) + struct.pack("<BIdd", 1, 1, x, y)


def layers(spark: SparkSession, path: str) -> DataFrame:
    return layers_from(_files(spark, path))


def layers_from(files: DataFrame) -> DataFrame:
    """(path, layer, srs_id, geometry_column, columns, n_rows) of each layer of each file."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                con = _open(content)
                geometry = dict(con.execute("SELECT table_name, column_name FROM gpkg_geometry_columns"))
                for layer, srs in con.execute("SELECT table_name, srs_id FROM gpkg_contents ORDER BY table_name").fetchall():
                    info = con.execute(f"PRAGMA table_info({_quoted(layer)})").fetchall()
                    n = con.execute(f"SELECT count(*) FROM {_quoted(layer)}").fetchone()[0]
                    rows.append((name, layer, srs, geometry.get(layer), [f"{c[1]}:{kind_of_sql(c[2]) if c[1] != geometry.get(layer) else 'geometry'}" for c in info], n))
            if rows:
                yield pd.DataFrame(rows, columns=["path", "layer", "srs_id", "geometry_column", "columns", "n_rows"])

    return files.mapInPandas(run, "path string, layer string, srs_id int, geometry_column string, columns array<string>, n_rows long")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read(spark: SparkSession, path: str, layer: str | None = None, limit: int | None = None, centroid: bool = False) -> DataFrame:
    return read_from(_files(spark, path), layer, limit, centroid)


def read_from(files: DataFrame, layer: str | None = None, limit: int | None = None, centroid: bool = False) -> DataFrame:
    """One layer (the first, if none is named) of one or more files: numbers as doubles, other columns as text, `geometry` as WKB.

    With `centroid`, x and y of points (or the mean of a polygon's corners) come instead of the geometry.
    """
    known = layers_from(files)
    first = (known.where(F.col("layer") == layer) if layer else known.orderBy("layer")).first()
    if first is None:
        raise ValueError(f"no layer {layer or ''}")
    name, geometry = first["layer"], first["geometry_column"]
    kinds = [c.rsplit(":", 1) for c in first["columns"]]
    fields = [(c, "geometry" if k == "geometry" else k) for c, k in kinds]
    types = {"numeric": T.DoubleType(), "geometry": T.BinaryType()}
    schema = T.StructType([T.StructField("geometry" if k == "geometry" else c, types.get(k, T.StringType())) for c, k in fields])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for content in pdf["content"]:
                query = f"SELECT {', '.join(_quoted(c) for c, _ in fields)} FROM {_quoted(name)}" + (f" LIMIT {int(limit)}" if limit else "")
                cursor = _open(content).execute(query)
                while rows := cursor.fetchmany(20_000):
                    out = pd.DataFrame(rows, columns=[f.name for f in schema], dtype=object)
                    for (_, kind), field in zip(fields, schema, strict=True):
                        if kind == "geometry":
                            out[field.name] = [wkb_of(b) for b in out[field.name]]
                        elif kind == "numeric":
                            out[field.name] = pd.to_numeric(out[field.name], errors="coerce")
                        else:
                            out[field.name] = [None if v is None else str(v) for v in out[field.name]]
                    yield out

    df = files.mapInPandas(run, schema)
    numeric = {f.name: F.when(~F.isnan(f.name), F.col(f.name)) for f in schema if isinstance(f.dataType, T.DoubleType)}
    df = df.withColumns(numeric) if numeric else df
    if centroid and geometry:
        at = wkb_point(F.col("geometry"))
        df = df.withColumn("__p", at).withColumns({"x": F.col("__p.x"), "y": F.col("__p.y")}).drop("__p", "geometry")
    return df


def packages(df: DataFrame, layer: str, epsg: int, x: str = "x", y: str = "y") -> DataFrame:
    """(part, content): a GeoPackage of points for each partition; rows without coordinates are left out, fid is renamed."""
    df = df.dropna(subset=[x, y]).withColumnRenamed("fid", "fid_orig")
    columns = df.columns
    kinds = ["REAL" if isinstance(f.dataType, (T.FractionalType, T.DecimalType)) else "INTEGER" if isinstance(f.dataType, T.IntegralType) else "TEXT" for f in df.schema]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        con = sqlite3.connect(":memory:")
        #: The tables and ids that the format asks for.
        con.executescript(
            "PRAGMA application_id = 1196444487; PRAGMA user_version = 10300;"
            "CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL, organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT);"
            "CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT UNIQUE, description TEXT, last_change TEXT, min_x REAL, min_y REAL, max_x REAL, max_y REAL, srs_id INTEGER);"
            "CREATE TABLE gpkg_geometry_columns (table_name TEXT PRIMARY KEY, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL, srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL);"
        )
        con.execute("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, 'EPSG', ?, 'undefined', NULL)", (f"EPSG:{epsg}", epsg, epsg))
        con.execute("INSERT INTO gpkg_contents (table_name, data_type, identifier, srs_id) VALUES (?, 'features', ?, ?)", (layer, layer, epsg))
        con.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'POINT', ?, 0, 0)", (layer, epsg))
        fields = ", ".join(f"{_quoted(c)} {k}" for c, k in zip(columns, kinds, strict=True))
        con.execute(f"CREATE TABLE {_quoted(layer)} (fid INTEGER PRIMARY KEY AUTOINCREMENT, geom BLOB, {fields})")
        any_rows = False
        for pdf in parts:
            any_rows |= len(pdf) > 0
            rows = pdf.astype(object).where(pdf.notna(), None)
            marks = ", ".join("?" * (len(columns) + 1))
            con.executemany(
                f"INSERT INTO {_quoted(layer)} (geom, {', '.join(map(_quoted, columns))}) VALUES ({marks})",
                [(point_blob(float(r[columns.index(x)]), float(r[columns.index(y)]), epsg), *[v.item() if hasattr(v, "item") else v for v in r]) for r in rows.itertuples(index=False, name=None)],
            )
        con.commit()
        if any_rows:
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "content": [con.serialize()]})

    return df.mapInPandas(run, "part int, content binary")
