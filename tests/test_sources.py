"""Files written and read again: TIFF, GeoPackage, tiles, CSV encodings, boxes, JSON."""

import json
import sqlite3
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from orogen.sources import geopackage, rasters, readers, sinks


def test_tiff_round_trip(spark, tmp_path):
    z = np.arange(12, dtype=float).reshape(3, 4)
    z[1, 2] = -9999
    (tmp_path / "dem.tif").write_bytes(rasters.encode(z, px=2.0, x0=100.0, y0=50.0, nodata=-9999))
    rows = {(r.r, r.c): r for r in rasters.read_cells(spark, str(tmp_path)).collect()}
    assert len(rows) == 12 and rows[1, 2].z is None and rows[2, 3].z == 11
    assert (rows[0, 0].x, rows[0, 0].y, rows[0, 0].raster_id) == (101.0, 49.0, "dem")
    meta = rasters.geometry(spark, str(tmp_path)).first()
    assert (meta["rows"], meta["cols"], meta["px"], meta["nodata"]) == (3, 4, 2.0, -9999)
    assert rasters.wide(rasters.read_cells(spark, str(tmp_path))).columns == ["r", "c", "dem_b1"]


def test_tiff_predictors():
    z = np.arange(20, dtype=np.float32).reshape(4, 5) * 1.5
    planes = z.astype(">f4").view(np.uint8).reshape(4, 5, 4).transpose(0, 2, 1).reshape(4, 20)
    raw = np.diff(planes, axis=1, prepend=np.uint8(0)).astype(np.uint8).tobytes()
    _, own = rasters.decode(rasters.encode(z))
    own.predictor = 3
    assert np.array_equal(own.numbers(0, zlib.compress(raw))[..., 0], z)
    own.predictor, own.kind = 2, "<i4"
    steps = np.diff(np.arange(20, dtype=np.int32).reshape(4, 5) ** 2, axis=1, prepend=0).astype("<i4")
    assert np.array_equal(own.numbers(0, zlib.compress(steps.tobytes()))[..., 0], np.arange(20).reshape(4, 5) ** 2)


def test_lzw():
    rng = np.random.default_rng(1)
    for data in (b"", b"a", b"ab" * 5000, bytes(rng.integers(0, 256, 30_000, dtype=np.uint8)), bytes(rng.integers(0, 3, 60_000, dtype=np.uint8))):
        assert rasters.unpacked_lzw(rasters.packed_lzw(data)) == data
    # codes by hand: clear, 7, 258 (7 7), 8, end in nine bits each
    codes = "".join(f"{c:09b}" for c in (256, 7, 258, 8, 257))
    raw = int(codes.ljust(48, "0"), 2).to_bytes(6)
    assert rasters.unpacked_lzw(raw) == bytes([7, 7, 7, 8]) == rasters.unpacked_lzw(rasters.packed_lzw(bytes([7, 7, 7, 8])))


@pytest.mark.parametrize("codec", [rasters.NONE, rasters.LZW, rasters.DEFLATE])
def test_tiff_variants(spark, codec):
    z = np.random.default_rng(2).normal(size=(50, 37)).astype(np.float32)
    z[3, 4] = -9999
    made = [(f"t{tile}{big}", rasters.encode(z, 2.0, 10.0, 20.0, -9999, codec, tile, 6673, big)) for tile in (None, 16) for big in (False, True)]
    for _, raw in made:
        data, own = rasters.decode(raw)
        assert np.array_equal(data[..., 0], z) and (own.epsg, own.nodata, own.x0, own.y0) == (6673, -9999.0, 10.0, 20.0)
    files = spark.createDataFrame([(n, bytearray(raw)) for n, raw in made], "path string, content binary")
    got = rasters.cells_from(files).toPandas()
    assert len(got) == 4 * z.size and rasters.blocks_of(files).where("raster_id like 't16%'").count() == 2 * 4 * 3
    for _, part in got.groupby("raster_id"):
        back = np.full(z.shape, np.nan)
        back[part["r"], part["c"]] = part["z"].astype(float)
        assert np.isnan(back[3, 4]) and np.allclose(np.where(np.isnan(back), -9999, back), z)
    assert {r["epsg"] for r in rasters.geometry_of(files).collect()} == {6673}
    rasters.check_aligned(rasters.geometry_of(files))
    other = spark.createDataFrame([("u", bytearray(rasters.encode(z, 2.0, 10.0, 20.0, epsg=6674)))], "path string, content binary")
    with pytest.raises(ValueError, match="differ"):
        rasters.check_aligned(rasters.geometry_of(files.union(other)))


def test_separate_bands():
    own, _ = rasters.layout(rasters.encode(np.zeros((20, 20)), tile=16))
    own.bands, own.separate, own.codec = 3, True, rasters.NONE
    assert [own.place(k) for k in (0, 3, 4, 11)] == [(0, 0, 16, 0), (16, 16, 16, 0), (0, 0, 16, 1), (16, 16, 16, 2)]
    assert own.numbers(11, np.arange(256, dtype="<f4").tobytes()).shape == (4, 4, 1)


def test_geopackage_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0, 3.0, "a"), (2, 4.0, None, "b"), (3, 6.0, 7.0, None)], "fid long, x double, y double, name string").coalesce(1)
    content = geopackage.packages(df, "pts", 6673).first()["content"]
    (tmp_path / "a.gpkg").write_bytes(content)
    assert sqlite3.connect(tmp_path / "a.gpkg").execute("SELECT count(*) FROM pts").fetchone() == (2,)
    layer = geopackage.layers(spark, str(tmp_path / "a.gpkg")).first()
    assert (layer["layer"], layer["srs_id"], layer["n_rows"]) == ("pts", 6673, 2)
    rows = geopackage.read(spark, str(tmp_path / "a.gpkg"), centroid=True).orderBy("x").collect()
    assert [(r.x, r.y, r["name"], r.fid_orig) for r in rows] == [(2.0, 3.0, "a", 1.0), (6.0, 7.0, None, 3.0)]
    assert readers.read_table(spark, str(tmp_path / "a.gpkg"), columns=["name"], head=1).count() == 1


def test_tiles_round_trip(spark):
    cells = spark.range(30).select(F.expr("id div 6").alias("r"), (F.col("id") % 6).alias("c"), F.when(F.col("id") % 7 != 0, F.col("id").cast("double")).alias("z"))
    back = sinks.cells_of(sinks.tiles_of(cells, 4), 4)
    assert sorted(back.collect(), key=str) == sorted(cells.select("r", "c", "z").collect(), key=str)
    made = rasters.as_tiffs(sinks.tiles_of(cells, 4), 4, 1.0, 0.0, 0.0, -9999.0).where("tile_r = 0 and tile_c = 1").first()
    data, geo = rasters.decode(bytes(made["content"]))
    assert data.shape == (4, 2, 1) and geo.x0 == 4.0


def test_csv_encodings_and_boxes(spark, tmp_path):
    (tmp_path / "sjis.csv").write_bytes("name,v\n山,1\n".encode("cp932"))
    (tmp_path / "bom.csv").write_bytes("name,Xmin,Ymin,Xmax,Ymax\nA,1,2,3,4\nB,x,2,3,4\n".encode("utf-8-sig"))
    assert readers.read_csv(spark, str(tmp_path / "sjis.csv")).first()["name"] == "山"
    assert [tuple(r) for r in readers.boxes(spark, str(tmp_path / "bom.csv")).collect()] == [("A", 1.0, 2.0, 3.0, 4.0)]
    with pytest.raises(ValueError):
        readers.boxes(spark, str(tmp_path / "sjis.csv"))


def test_tables_and_json(spark, tmp_path):
    df = spark.range(10).select("id", F.col("id").cast("double").alias("x"), F.col("id").cast("double").alias("y"))
    for fmt in ("csv", "parquet", "json", "orc"):
        sinks.write_table(df, str(tmp_path / f"t.{fmt}"), fmt)
        assert readers.read_table(spark, str(tmp_path / f"t.{fmt}"), bbox=(2, 2, 5, 5)).count() == 4
    assert readers.inspect(spark, str(tmp_path / "t.parquet"))["rows"] == 10
    sinks.write_geoparquet(df, str(tmp_path / "g.parquet"), 6673)
    assert readers.is_geoparquet(spark, str(tmp_path / "g.parquet")) and not readers.is_geoparquet(spark, str(tmp_path / "t.parquet"))
    assert readers.geo_footer(spark, str(tmp_path / "g.parquet"))["columns"]["geometry"]["crs"]["id"]["code"] == 6673
    assert readers.read_table(spark, str(tmp_path / "g.parquet"), geometry=True).count() == 10
    footer = pq.read_schema(next((tmp_path / "g.parquet").glob("*.parquet"))).metadata
    assert json.loads(footer[b"geo"])["primary_column"] == "geometry"
    sinks.write_geoparquet(df.where("false"), str(tmp_path / "g.parquet"), 6673)
    assert readers.read_table(spark, str(tmp_path / "g.parquet")).count() == 0
    sinks.write_csv_split(df.select("x"), str(tmp_path / "parts"), 3, ["x"])
    assert [r["count"] for r in spark.read.csv(str(tmp_path / "parts"), header=True).groupBy("part").count().orderBy("part").collect()] == [4, 4, 2]
    sinks.write_per_class(spark.createDataFrame([("a/b", 1), (None, 2)], "label string, v int"), str(tmp_path / "classes"))
    assert {p.name for p in (tmp_path / "classes").iterdir() if p.is_dir()} == {"class_dir=a_b", "class_dir=NaN"}
    sinks.save_json(spark, str(tmp_path / "meta"), {"runs": [], "n": np.int64(3)})
    assert sinks.load_json(spark, str(tmp_path / "meta")) == {"runs": [], "n": 3} == readers.load_config(spark, str(tmp_path / "meta"))
    (tmp_path / "f.geojson").write_text('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"k":1},"geometry":{"type":"Point","coordinates":[1,2]}}]}')
    assert readers.read_table(spark, str(tmp_path / "f.geojson"), geometry=True).first()["k"] == 1
    assert readers.list_files(spark, str(tmp_path), "*.geojson").count() == 1


def test_geoparquet_is_written_beside_and_then_moved(spark, tmp_path):
    """A table may be written over the one it is read from, a job that fails changes nothing, and footers are read alone."""
    place = f"{tmp_path}/a b/points.parquet"
    df = spark.createDataFrame([(i, float(i), 1.0) for i in range(20)], "id long, x double, y double").repartition(3)
    sinks.write_geoparquet(df, place, 6673)
    sinks.write_geoparquet(readers.read_table(spark, place).select("id", "x", "y").where("id < 15"), place, 6673)
    assert readers.read_table(spark, place).count() == 15 and readers.geo_footer(spark, place)["columns"]["geometry"]["crs"]["id"]["code"] == 6673
    with pytest.raises(FileExistsError):
        sinks.write_geoparquet(df, place, 6673, mode="error")
    with pytest.raises(Exception, match="boom"):
        sinks.write_geoparquet(df.withColumn("x", F.when(F.col("id") == 7, F.raise_error(F.lit("boom")).cast("double")).otherwise(F.col("x"))), place, 6673)
    assert readers.read_table(spark, place).count() == 15 and [p.name for p in tmp_path.joinpath("a b").iterdir()] == ["points.parquet"]
    spark.range(2).write.parquet(f"{tmp_path}/plain.parquet")
    assert readers.geo_footer(spark, f"{tmp_path}/plain.parquet") is None
