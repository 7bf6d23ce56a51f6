"""Scans of GeoTIFF files as tables of cells.

Files come through Spark's binary source, so any file system that the cluster knows will do; a task holds files of
spark.sql.files.maxPartitionBytes, or one larger file (2 GB at most), and cells leave it block by block. Blocks outside a box are neither unpacked nor emitted.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import spatial

CELLS = "path string, y int, x int, lon double, lat double, value double"
# Field types of the format (bytes, struct letter) and the tags that are read.
TYPES = {1: (1, "B"), 2: (1, "s"), 3: (2, "H"), 4: (4, "I"), 6: (1, "b"), 8: (2, "h"), 9: (4, "i"), 11: (4, "f"), 12: (8, "d"), 16: (8, "Q"), 17: (8, "q")}
WIDTH, HEIGHT, BITS, COMPRESSION, STRIPS, SAMPLES, STRIP_ROWS, STRIP_BYTES, PLANAR, PREDICTOR = 256, 257, 258, 259, 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES, FORMAT, PIXEL_SCALE, TIEPOINT, NODATA = 322, 323, 324, 325, 339, 33550, 33922, 42113


def tags(data: bytes) -> tuple[str, dict[int, tuple]]:
    """Byte order and the tags of the first image, of the classic and the 64-bit format."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    version = struct.unpack_from(order + "H", data, 2)[0] if order else 0
    if version not in (42, 43):
        raise ValueError("no TIFF file")
    big = version == 43
    at = struct.unpack_from(order + ("Q" if big else "I"), data, 8 if big else 4)[0]
    n = struct.unpack_from(order + ("Q" if big else "H"), data, at)[0]
    at, step, word = at + (8 if big else 2), 20 if big else 12, 8 if big else 4
    out = {}
    for i in range(n):
        tag, kind = struct.unpack_from(order + "HH", data, at + i * step)
        count = struct.unpack_from(order + ("Q" if big else "I"), data, at + i * step + 4)[0]
        size, letter = TYPES.get(kind, (0, ""))
        if not size:
            continue
        place = at + i * step + 4 + word
        if size * count > word:
            place = struct.unpack_from(order + ("Q" if big else "I"), data, place)[0]
        got = struct.unpack_from(f"{order}{count}{letter}", data, place)
        out[tag] = (got[0].split(b"\0")[0].decode(),) if letter == "s" else got
    return order, out


def _unpacked(raw: bytes, how: int) -> bytes:
    if how == 1:
        return raw
    if how in (8, 32946):
        return zlib.decompress(raw)
    if how == 50000:
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj().decompress(raw)
    raise ValueError(f"compression {how} isn't supported")


def _block(raw: bytes, how: int, predictor: int, shape: tuple[int, int, int], kind: np.dtype) -> np.ndarray:
    """The samples (rows, columns, samples) of one block."""
    rows, cols, n = shape
    data = _unpacked(raw, how)
    if predictor == 3:
        flat = np.frombuffer(data, np.uint8).reshape(-1, kind.itemsize * cols * n)
        run = np.cumsum(flat.reshape(len(flat), -1, n), axis=1, dtype=np.uint8)
        planes = run.reshape(len(flat), kind.itemsize, cols * n).transpose(0, 2, 1)
        return np.ascontiguousarray(planes).view(kind.newbyteorder(">")).reshape(-1, cols, n)
    got = np.frombuffer(data, kind, len(data) // kind.itemsize).reshape(-1, cols, n)
    return np.cumsum(got.astype(kind.newbyteorder("=")), axis=1, dtype=kind.newbyteorder("=")) if predictor == 2 else got


def cells(data: bytes, band: int = 1, nodata: float | None = None, within: tuple[float, float, float, float] | None = None) -> Iterator[tuple[np.ndarray, ...]]:
    """y, x, lon, lat (of centres) and value of the cells of a file, by blocks; missing values are NaN.

    Cells with the file's own nodata value or the one given are missing, and so are blocks that the file leaves out.
    """
    order, t = tags(data)
    one = lambda tag, default=None: t.get(tag, (default,))[0]
    width, height, n = one(WIDTH), one(HEIGHT), one(SAMPLES, 1)
    kind = np.dtype(order + {1: "u", 2: "i", 3: "f"}[one(FORMAT, 1)] + str(one(BITS, 8) // 8))
    if one(BITS, 8) % 8 or not 1 <= band <= n or PIXEL_SCALE not in t or TIEPOINT not in t:
        raise ValueError("samples of whole bytes, the band asked for, and a place on the ground are needed")
    tiled = TILES in t
    across, down = (one(TILE_WIDTH), one(TILE_HEIGHT)) if tiled else (width, min(one(STRIP_ROWS, height), height))
    places, sizes = (t[TILES], t[TILE_BYTES]) if tiled else (t[STRIPS], t[STRIP_BYTES])
    per_row = -(-width // across)
    planes = one(PLANAR, 1) == 2
    first = (band - 1) * per_row * -(-height // down) if planes else 0
    held, pick = (1, 0) if planes else (n, band - 1)
    (sx, sy), (px, py, _, lon0, lat0, _) = t[PIXEL_SCALE][:2], t[TIEPOINT][:6]
    gaps = [float(v) for v in (one(NODATA), nodata) if v is not None]
    for k in range(per_row * -(-height // down)):
        y0, x0 = k // per_row * down, k % per_row * across
        ys, xs = np.arange(y0, min(y0 + down, height)), np.arange(x0, min(x0 + across, width))
        lon, lat = lon0 + (xs - px + 0.5) * sx, lat0 - (ys - py + 0.5) * sy
        if within:
            inx, iny = (lon >= within[0]) & (lon <= within[2]), (lat >= within[1]) & (lat <= within[3])
            if not inx.any() or not iny.any():
                continue
        if sizes[first + k]:
            raw = data[places[first + k] : places[first + k] + sizes[first + k]]
            shape = (down if tiled else len(ys), across, held)
            v = _block(raw, one(COMPRESSION, 1), one(PREDICTOR, 1), shape, kind)[: len(ys), : len(xs), pick].astype(np.float64)
        else:
            v = np.full((len(ys), len(xs)), np.nan)
        for g in gaps:
            v = np.where(v == g, np.nan, v)
        if within:
            ys, lat, xs, lon, v = ys[iny], lat[iny], xs[inx], lon[inx], v[iny][:, inx]
        yield np.repeat(ys, len(xs)), np.tile(xs, len(ys)), np.tile(lon, len(ys)), np.repeat(lat, len(xs)), v.reshape(-1)


def decoded(files: DataFrame, band: int = 1, nodata: float | None = None, within: tuple[float, float, float, float] | None = None, scale: float = 1.0, offset: float = 0.0) -> DataFrame:
    """path, y, x, lon, lat, value (null where missing, else scaled) of the cells of files (path, content)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "y", "x", "lon", "lat", "value"]
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                for y, x, lon, lat, v in cells(content.as_py(), band, nodata, within):
                    own = [pa.repeat(pa.scalar(path, pa.string()), len(y)), pa.array(y.astype(np.int32)), pa.array(x.astype(np.int32)), pa.array(lon), pa.array(lat)]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(v * scale + offset, mask=np.isnan(v))], names)

    return files.select("path", "content").where("content IS NOT NULL").mapInArrow(run, CELLS)


def geotiff(spark: SparkSession, path: str, where: str | None = None, **how) -> DataFrame:
    """Cells of the GeoTIFF files of a folder; where may name partition columns (year=2021), whose folders alone are read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tif*").option("recursiveFileLookup", where is None).load(path)
    return decoded(files.where(where) if where else files, **how)


def on_grid(scanned: DataFrame, top: float, left: float, resolution: float) -> DataFrame:
    """Scanned cells with y and x on one grid of all files; where files overlap, the value of the last by path."""
    placed = spatial.nearest_cell(scanned.where("value IS NOT NULL"), top, left, resolution)
    return placed.groupBy("y", "x").agg(F.max_by("value", "path").alias("value"))


def elevation(scanned: DataFrame, template: DataFrame, top: float, left: float, resolution: float) -> DataFrame:
    """Template cells (ty, tx, lon, lat) with the bilinear value of a scan."""
    place = template.select("ty", "tx", ((F.lit(top) - F.col("lat")) / resolution - 0.5).alias("sy"), ((F.col("lon") - left) / resolution - 0.5).alias("sx"))
    return spatial.resampled_bilinear(place, on_grid(scanned, top, left, resolution))


def land_cover(scanned: DataFrame, top: float, left: float, resolution: float, factor: int) -> DataFrame:
    """The most frequent class (least of ties) of cells of factor x factor scanned ones."""
    return spatial.resampled_mode(on_grid(scanned, top, left, resolution), factor)


def encoded(values: np.ndarray, left: float, top: float, resolution: float, nodata: float | None = None, block: int | None = None, predictor: int = 1, deflate: bool = True) -> bytes:
    """A GeoTIFF file (one band, little-endian) of a grid, in square tiles of a side or in strips of 16 rows."""
    height, width = values.shape
    kind = values.dtype.newbyteorder("<")
    down, across = (block, block) if block else (16, width)
    blocks = []
    for y in range(0, height, down):
        for x in range(0, width, across):
            part = values[y : y + down, x : x + across]
            if block:
                part = np.pad(part, ((0, down - part.shape[0]), (0, across - part.shape[1])))
            raw = part.astype(kind)
            if predictor == 2:
                raw = np.diff(raw, axis=1, prepend=raw.dtype.type(0))
            elif predictor == 3:
                planes = np.ascontiguousarray(part.astype(kind.newbyteorder(">"))).view(np.uint8).reshape(len(part), -1, kind.itemsize).transpose(0, 2, 1)
                raw = np.diff(planes.reshape(len(part), -1), axis=1, prepend=np.uint8(0))
            blocks.append(zlib.compress(raw.tobytes()) if deflate else raw.tobytes())
    at, places = 8, []
    for b in blocks:
        places.append(at)
        at += len(b)
    entries = {WIDTH: ("I", [width]), HEIGHT: ("I", [height]), BITS: ("H", [kind.itemsize * 8]), COMPRESSION: ("H", [8 if deflate else 1]), SAMPLES: ("H", [1])}
    entries |= {PREDICTOR: ("H", [predictor]), FORMAT: ("H", [{"u": 1, "i": 2, "f": 3}[kind.kind]]), PIXEL_SCALE: ("d", [resolution, resolution, 0.0]), TIEPOINT: ("d", [0.0, 0.0, 0.0, left, top, 0.0])}
    entries |= {TILE_WIDTH: ("I", [across]), TILE_HEIGHT: ("I", [down]), TILES: ("I", places), TILE_BYTES: ("I", [*map(len, blocks)])} if block else {STRIP_ROWS: ("I", [down]), STRIPS: ("I", places), STRIP_BYTES: ("I", [*map(len, blocks)])}
    if nodata is not None:
        entries[NODATA] = ("s", re.sub(r"\.0$", "", str(nodata)).encode() + b"\0")
    letters = {letter: kind for kind, (_, letter) in TYPES.items()}
    head, extra = b"", b""
    start = at + 2 + 12 * len(entries) + 4
    for tag, (letter, v) in sorted(entries.items()):
        body = v if letter == "s" else struct.pack(f"<{len(v)}{letter}", *v)
        place = body.ljust(4, b"\0") if len(body) <= 4 else struct.pack("<I", start + len(extra))
        extra += b"" if len(body) <= 4 else body
        head += struct.pack("<HHI", tag, letters[letter], len(v)) + place
    return b"II*\0" + struct.pack("<I", at) + b"".join(blocks) + struct.pack("<H", len(entries)) + head + b"\0\0\0\0" + extra
