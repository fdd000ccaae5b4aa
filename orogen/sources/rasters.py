"""Single files of rasters as cells: a small TIFF decoder run by Spark, and tiles written as TIFF.

Spark reads the files (any store; its reader ends at 2 GB a file). A task reads a file's tags and cuts it into its strips or
tiles; these are dealt out and decoded each in a task of its own. Classic and BigTIFF, 8 to 64 bit integers and floats,
uncompressed, deflated or LZW, interleaved or separate bands, with either predictor. JPEG and other codecs raise an error.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: TIFF tag numbers, sizes of field types, GeoTIFF tags and keys, codecs.
WIDTH, HEIGHT, BITS, COMPRESSION, STRIPS, BANDS, STRIP_ROWS, STRIP_BYTES, PLANAR, PREDICTOR = 256, 257, 258, 259, 273, 277, 278, 279, 284, 317
TILE_W, TILE_H, TILES, TILE_BYTES, FORMAT, SCALE, TIEPOINT, GEO_KEYS, NODATA_TAG = 322, 323, 324, 325, 339, 33550, 33922, 34735, 42113
PROJECTED, GEOGRAPHIC = 3072, 2048
NONE, LZW, DEFLATE, OLD_DEFLATE = 1, 5, 8, 32946
_FIELDS = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}


def _tags(raw: bytes) -> tuple[str, dict[int, tuple]]:
    order = "<" if raw[:2] == b"II" else ">"
    version = struct.unpack_from(order + "H", raw, 2)[0]
    if version not in (42, 43):
        raise ValueError("not a TIFF file")
    # BigTIFF has 8-byte offsets and counts
    offset, count, head, room = ("I", "HHI", 4, 4) if version == 42 else ("Q", "HHQ", 8, 8)
    at = struct.unpack_from(order + offset, raw, head)[0]
    entries = struct.unpack_from(order + ("H" if version == 42 else "Q"), raw, at)[0]
    at += 2 if version == 42 else 8
    length = struct.calcsize("<" + count)
    out = {}
    for k in range(entries):
        place = at + k * (length + room)
        tag, kind, n = struct.unpack_from(order + count, raw, place)
        if kind not in _FIELDS:
            continue
        size = struct.calcsize(_FIELDS[kind]) * n
        start = place + length if size <= room else struct.unpack_from(order + offset, raw, place + length)[0]
        if kind == 2:
            out[tag] = (raw[start : start + n].rstrip(b"\0").decode("latin-1"),)
        else:
            out[tag] = struct.unpack_from(f"{order}{n}{_FIELDS[kind]}", raw, start)
    return order, out


def unpacked_lzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, the high bit first; 256 starts afresh, 257 ends; codes grow one entry early."""
    start = [bytes([i]) for i in range(256)] + [b"", b""]
    table, out, before = list(start), [], b""
    bits, have, width = 0, 0, 9
    for byte in data:
        bits, have = (bits << 8) | byte, have + 8
        if have < width:
            continue
        have -= width
        code, bits = bits >> have, bits & ((1 << have) - 1)
        if code == 257:
            break
        if code == 256:
            table, before, width = list(start), b"", 9
            continue
        entry = table[code] if code < len(table) else before + before[:1]
        if before:
            table.append(before + entry[:1])
        out.append(entry)
        before = entry
        width = min(12, max(9, (len(table) + 1).bit_length()))
    return b"".join(out)


def packed_lzw(data: bytes) -> bytes:
    """The inverse of `unpacked_lzw`."""
    start = {bytes([i]): i for i in range(256)}
    table, bits, have, width, out = dict(start), 256, 9, 9, bytearray()
    following, run = 258, b""

    def put(code: int) -> None:
        nonlocal bits, have
        bits, have = (bits << width) | code, have + width
        while have >= 8:
            have -= 8
            out.append(bits >> have)
            bits &= (1 << have) - 1

    for k in range(len(data)):
        longer = run + data[k : k + 1]
        if longer in table:
            run = longer
            continue
        put(table[run])
        table[longer] = following
        following += 1
        width = min(12, max(9, following.bit_length()))
        if following == 4094:
            put(256)
            table, following, width = dict(start), 258, 9
        run = data[k : k + 1]
    if run:
        put(table[run])
        width = min(12, max(9, (following + 1).bit_length()))
    put(257)
    return bytes(out) + (bytes([bits << (8 - have) & 255]) if have else b"")


@dataclass
class Layout:
    """What the tags say of a file: size, kind of numbers, blocks and georeference (upper left corner; nodata and epsg may be none)."""

    rows: int
    cols: int
    bands: int
    kind: str
    codec: int
    predictor: int
    block_rows: int
    block_cols: int
    tiled: bool
    separate: bool
    px: float
    py: float
    x0: float
    y0: float
    nodata: float | None
    epsg: int | None

    def place(self, block: int) -> tuple[int, int, int, int]:
        """(first row, first column, rows as stored, first band) of a block."""
        across = -(-self.cols // self.block_cols)
        each = across * -(-self.rows // self.block_rows)
        band, k = divmod(block, each) if self.separate else (0, block)
        r, c = k // across * self.block_rows, k % across * self.block_cols
        return r, c, self.block_rows if self.tiled else min(self.block_rows, self.rows - r), band

    def numbers(self, block: int, raw: bytes) -> np.ndarray:
        """(rows, columns, bands) of a block, inside the raster."""
        r, c, rows, _ = self.place(block)
        raw = raw if self.codec == NONE else unpacked_lzw(raw) if self.codec == LZW else zlib.decompress(raw)
        kind, shape = np.dtype(self.kind), (rows, self.block_cols, 1 if self.separate else self.bands)
        data = np.frombuffer(raw, kind, int(np.prod(shape))).reshape(shape)
        if self.predictor == 2:
            data = np.cumsum(data, axis=1, dtype=kind)
        elif self.predictor == 3:  # bytes of equal weight side by side, then differences
            h, w, bands = shape
            planes = np.cumsum(np.frombuffer(raw, np.uint8)[: h * w * bands * kind.itemsize].reshape(h, -1, bands), axis=1, dtype=np.uint8)
            planes = planes.reshape(h, kind.itemsize, w * bands).transpose(0, 2, 1)
            data = np.ascontiguousarray(planes).view(kind.newbyteorder(">")).reshape(shape)
        return data[: self.rows - r, : self.cols - c]


def layout(raw: bytes) -> tuple[Layout, list[tuple[int, int]]]:
    """The layout of a file and (offset, size) of its blocks; no pixel is decoded."""
    order, tag = _tags(raw)
    one = lambda t, default: tag.get(t, (default,))[0]
    if one(COMPRESSION, NONE) not in (NONE, LZW, DEFLATE, OLD_DEFLATE):
        raise ValueError(f"TIFF compression {one(COMPRESSION, NONE)} is not read: only none, LZW and deflate")
    w, h, tiled = one(WIDTH, 0), one(HEIGHT, 0), TILES in tag
    scale, tie = tag.get(SCALE, (1.0, 1.0, 0.0)), tag.get(TIEPOINT, (0.0,) * 6)
    keys = {k[0]: k[3] for k in zip(*[iter(tag.get(GEO_KEYS, ())[4:])] * 4, strict=False) if k[1] == 0}
    found = Layout(
        rows=h, cols=w, bands=one(BANDS, 1), kind=f"{order}{ {1: 'u', 2: 'i', 3: 'f'}[one(FORMAT, 1)] }{one(BITS, 8) // 8}",
        codec=one(COMPRESSION, NONE), predictor=one(PREDICTOR, 1), block_rows=one(TILE_H, h) if tiled else min(one(STRIP_ROWS, h), h),
        block_cols=one(TILE_W, w) if tiled else w, tiled=tiled, separate=one(BANDS, 1) > 1 and one(PLANAR, 1) == 2,
        px=scale[0], py=-scale[1], x0=tie[3] - tie[0] * scale[0], y0=tie[4] + tie[1] * scale[1],
        nodata=float(tag[NODATA_TAG][0]) if NODATA_TAG in tag else None, epsg=keys.get(PROJECTED, keys.get(GEOGRAPHIC)),
    )
    return found, list(zip(tag[TILES if tiled else STRIPS], tag[TILE_BYTES if tiled else STRIP_BYTES], strict=True))


def decode(raw: bytes) -> tuple[np.ndarray, Layout]:
    """(rows, columns, bands) of a small file, and its layout."""
    found, blocks = layout(raw)
    out = np.zeros((found.rows, found.cols, found.bands), dtype=np.dtype(found.kind).newbyteorder("="))
    for k, (start, size) in enumerate(blocks):
        r, c, _, band = found.place(k)
        data = found.numbers(k, raw[start : start + size])
        out[r : r + data.shape[0], c : c + data.shape[1], band : band + data.shape[2]] = data
    return out, found


def encode(
    z: np.ndarray, px: float = 1.0, x0: float = 0.0, y0: float = 0.0, nodata: float | None = None, codec: int = DEFLATE, tile: int | None = None, epsg: int | None = None, big: bool = False
) -> bytes:
    """One float32 band as TIFF: one strip, or tiles of `tile` pixels (a multiple of 16); LZW, deflated or plain."""
    h, w = z.shape
    bh, bw = (tile, tile) if tile else (h, w)
    blocks = []
    for r in range(0, h, bh):
        for c in range(0, w, bw):
            block = np.zeros((bh, bw), dtype="<f4")
            part = z[r : r + bh, c : c + bw]
            block[: part.shape[0], : part.shape[1]] = part
            blocks.append({NONE: bytes, LZW: packed_lzw, DEFLATE: zlib.compress}[codec](block.tobytes()))
    head = 16 if big else 8
    offsets = [head + sum(map(len, blocks[:k])) for k in range(len(blocks))]
    sizes, long = [len(b) for b in blocks], 16 if big else 4
    fields = [(WIDTH, 4, (w,)), (HEIGHT, 4, (h,)), (BITS, 3, (32,)), (COMPRESSION, 3, (codec,)), (262, 3, (1,)), (BANDS, 3, (1,)), (FORMAT, 3, (3,))]
    fields += [(SCALE, 12, (px, px, 0.0)), (TIEPOINT, 12, (0.0, 0.0, 0.0, x0, y0, 0.0))]
    if tile:
        fields += [(TILE_W, 4, (bw,)), (TILE_H, 4, (bh,)), (TILES, long, offsets), (TILE_BYTES, long, sizes)]
    else:
        fields += [(STRIPS, long, offsets), (STRIP_ROWS, 4, (h,)), (STRIP_BYTES, long, sizes)]
    if epsg is not None:
        fields.append((GEO_KEYS, 3, (1, 1, 0, 1, PROJECTED, 0, 1, epsg)))
    if nodata is not None:
        fields.append((NODATA_TAG, 2, (f"{nodata:g}".encode() + b"\0",)))
    fields.sort()
    data = b"".join(blocks)
    data += b"\0" * (len(data) % 2)
    number, entry, room = ("<Q", "<HHQ", 8) if big else ("<H", "<HHI", 4)
    at = head + len(data)
    extra, table = b"", struct.pack(number, len(fields))
    base = at + len(table) + (struct.calcsize(entry) + room) * len(fields) + room
    for tag, kind, values in fields:
        body = values[0] if kind == 2 else struct.pack(f"<{len(values)}{_FIELDS[kind]}", *values)
        n = len(body) if kind == 2 else len(values)
        table += struct.pack(entry, tag, kind, n) + (body.ljust(room, b"\0") if len(body) <= room else struct.pack("<Q" if big else "<I", base + len(extra)))
        extra += body + b"\0" * (len(body) % 2) if len(body) > room else b""
    start = struct.pack("<2sHHHQ", b"II", 43, 8, 0, at) if big else struct.pack("<2sHI", b"II", 42, at)
    return start + data + table + b"\0" * room + extra


def read_cells(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(raster_id, band, r, c, x, y, z) of all files; no-data and non-finite values are null. Files come with their own geometry."""
    return cells_from(tiff_files(spark, path, recursive))


def tiff_files(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(path, content) of the TIFF files in a folder."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.{tif,tiff,TIF,TIFF}").option("recursiveFileLookup", recursive)
    return reader.load(path).select("path", "content")


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1].rsplit(".", 1)[0]


def blocks_of(files: DataFrame) -> DataFrame:
    """(raster_id, block, data, and the file's layout): one row for each strip or tile, still compressed."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for name, raw in zip(pdf["path"], pdf["content"], strict=True):
                found, blocks = layout(raw)
                for at in range(0, len(blocks), 64):
                    some = blocks[at : at + 64]
                    yield pd.DataFrame({"raster_id": _name(name), "block": range(at, at + len(some)), "data": [raw[s : s + n] for s, n in some]}).assign(**asdict(found))

    return files.select("path", "content").mapInPandas(run, f"raster_id string, block int, data binary, {_LAYOUT}")


def cells_from(files: DataFrame) -> DataFrame:
    """The cells of TIFF files in a table (path, content)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for row in pdf.to_dict("records"):
                name, block, raw = row.pop("raster_id"), row.pop("block"), row.pop("data")
                found = Layout(**{k: None if v is None or v != v else v for k, v in row.items()})
                data = found.numbers(block, raw).astype(float)
                top, left, _, first = found.place(block)
                for band in range(data.shape[2]):
                    z = data[:, :, band].copy()
                    if found.nodata is not None:
                        z[z == np.float64(found.nodata)] = np.nan
                    r, c = np.divmod(np.arange(z.size), z.shape[1])
                    yield pd.DataFrame(
                        {
                            "raster_id": name,
                            "band": first + band + 1,
                            "r": r + top,
                            "c": c + left,
                            "x": found.x0 + (c + left + 0.5) * found.px,
                            "y": found.y0 + (r + top + 0.5) * found.py,
                            "z": np.where(np.isfinite(z), z, np.nan).ravel(),
                        }
                    )

    got = blocks_of(files).repartition("raster_id", "block").mapInPandas(run, "raster_id string, band int, r long, c long, x double, y double, z double")
    return got.withColumn("z", F.when(~F.isnan("z"), F.col("z")))


_LAYOUT = (
    "rows int, cols int, bands int, kind string, codec int, predictor int, block_rows int, block_cols int, tiled boolean, separate boolean, "
    "px double, py double, x0 double, y0 double, nodata double, epsg int"
)


def geometry(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(raster_id, rows, cols, bands, px, py, x0, y0, nodata, epsg) of each file, from its tags."""
    return geometry_of(tiff_files(spark, path, recursive))


def geometry_of(files: DataFrame) -> DataFrame:
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            if len(pdf):
                yield pd.DataFrame([{"raster_id": _name(name), **asdict(layout(raw)[0])} for name, raw in zip(pdf["path"], pdf["content"], strict=True)])

    got = files.select("path", "content").mapInPandas(run, f"raster_id string, {_LAYOUT}")
    nodata = F.when(~F.isnan("nodata"), F.col("nodata")).alias("nodata")
    return got.select("raster_id", "rows", "cols", "bands", "px", "py", "x0", "y0", nodata, "epsg")


def check_aligned(geometries: DataFrame) -> None:
    """An error unless all rasters have one grid and one CRS."""
    grids = geometries.select("rows", "cols", *[F.round(c, 6) for c in ("px", "py", "x0", "y0")], "epsg").distinct().limit(2).collect()
    if len(grids) > 1:
        raise ValueError(f"rasters differ in grid or CRS: {grids[0]} and {grids[1]}")


def wide(cells: DataFrame) -> DataFrame:
    """(r, c, {raster}_b{band} ...): rasters of one grid side by side; files are checked by `check_aligned` before."""
    names = [r["n"] for r in cells.select(F.concat("raster_id", F.lit("_b"), "band").alias("n")).distinct().orderBy("n").collect()]
    return cells.groupBy("r", "c").agg(*[F.max(F.when(F.concat("raster_id", F.lit("_b"), "band") == n, F.col("z"))).alias(n) for n in names])


def read_wide(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """The rasters of a folder side by side, if they have one grid and CRS."""
    check_aligned(geometry(spark, path, recursive))
    return wide(read_cells(spark, path, recursive))


def as_tiffs(tiles: DataFrame, size: int, px: float, x0: float, y0: float, nodata: float, codec: int = LZW, block: int | None = None, epsg: int | None = None) -> DataFrame:
    """(tile_r, tile_c, content): a TIFF file for each float32 tile."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            made = [
                encode(np.frombuffer(t.data, "<f4").reshape(t.h, t.w), px, x0 + t.tile_c * size * px, y0 - t.tile_r * size * px, nodata, codec, block, epsg)
                for t in pdf.itertuples()
            ]
            yield pdf[["tile_r", "tile_c"]].assign(content=made)

    return tiles.mapInPandas(run, "tile_r long, tile_c long, content binary")
