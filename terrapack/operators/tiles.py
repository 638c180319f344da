"""Tile operators on DataFrames: cut features, encode and decode tiles, and write and read layer files."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codec, geometry
from ..functions import constants as k
from ..functions import exprs as x
from . import relational

ORD = "struct<rank:int,a:bigint,b:bigint>"
RINGS = "array<struct<lon:array<double>,lat:array<double>,outer:boolean>>"
PARTS = "array<array<int>>"
FEATURE = f"ord {ORD}, geom int, cls int, attr int, rings {RINGS}"
_ORD = pa.struct([("rank", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])
_PARTS = pa.list_(pa.list_(pa.int32()))
#: Points of features that are cut together, and tiles that are coded together.
BATCH_POINTS, BATCH_TILES = 400_000, 4096
#: Bytes of encoded tiles that are decoded together, and features that are coded together.
BATCH_BYTES, BATCH_FEATURES = 4 << 20, 200_000


def ragged(lists: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """The number of values of each list (none: 0), and all values one after another."""
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten()


def nested(count: np.ndarray, size: np.ndarray, points: np.ndarray) -> pa.ListArray:
    """Rows of `count` parts each, a part as x, y, x, y ..."""
    ends = lambda n: pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
    return pa.ListArray.from_arrays(ends(count), pa.ListArray.from_arrays(ends(2 * size), pa.array(points.ravel(), pa.int32())))


def slices(weight: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Start and length of runs of BATCH_TILES rows at most that weigh no more than `most` together, or are of one row."""
    upto, at = np.concatenate([[0], np.cumsum(weight)]), 0
    while at < len(weight):
        to = min(at + BATCH_TILES, max(at + 1, int(np.searchsorted(upto, upto[at] + most, "right")) - 1))
        yield at, to - at
        at = to


def cut_features(features: DataFrame, levels: tuple[tuple, ...], region_zoom: int | None = None, shape=geometry.plain_shape) -> DataFrame:
    """A row for each level, tile and feature: its parts in the tile's units (x, y, x, y ...), and whether it fills it.

    `features` are FEATURE, with rx and ry where region_zoom is given: then only the region's tiles are made, as they
    would be without it. Features without an area are left out. `features.least_zoom`, if there, leaves a feature out
    of levels whose last zoom is below it. `shape` says how a ring or line counts (see geometry.plain_shape). Features are
    cut together, as many as have about BATCH_POINTS points.
    """
    zoomed = "least_zoom" in features.columns
    names = ["level", "x", "y", "ord", "geom", "cls", "attr", "parts", "full"]

    def cut(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        geom = b.column("geom").to_numpy(zero_copy_only=False)
        count, rings = ragged(b.column("rings"))
        size, lon = ragged(rings.field("lon"))
        lon, lat = lon.to_numpy(zero_copy_only=False), rings.field("lat").flatten().to_numpy(zero_copy_only=False)
        outer, ends = rings.field("outer").to_numpy(zero_copy_only=False).astype(bool), np.cumsum(size)
        owner = np.repeat(np.arange(len(count)), count)
        last_zoom = b.column("least_zoom").to_numpy(zero_copy_only=False) if zoomed else np.zeros(len(count))
        regions = None if region_zoom is None else np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("rx", "ry")], axis=1)
        for kind in (k.POLYGON, k.LINE):
            shapes, of = [], []
            for r in np.flatnonzero(geom[owner] == kind).tolist():
                found = shape(lon[ends[r] - size[r] : ends[r]], lat[ends[r] - size[r] : ends[r]], outer[r], kind == k.POLYGON)
                if found is not None:
                    shapes.append(found)
                    of.append(owner[r])
            for level, (zoom, _, last, bits, buffer, tolerance) in enumerate(levels):
                here = [n for n, f in enumerate(of) if last_zoom[f] <= last]
                parts, feature = geometry.level_parts([shapes[n] for n in here], np.array([of[n] for n in here], np.int64), kind == k.POLYGON, zoom + bits, tolerance)
                for c in geometry.cut_features(parts, feature, kind == k.POLYGON, zoom, bits, buffer, regions, region_zoom or 0):
                    row = pa.array(c.feature)
                    made = [pa.array(np.full(len(row), level), pa.int32()), pa.array(c.x), pa.array(c.y), b.column("ord").take(row), *(b.column(n).take(row) for n in ("geom", "cls", "attr")), nested(c.count, c.parts.size, c.parts.points), pa.array(c.full)]
                    yield pa.RecordBatch.from_arrays([v.cast(t) for v, t in zip(made, (pa.int32(), pa.int64(), pa.int64(), _ORD, pa.int32(), pa.int32(), pa.int32(), _PARTS, pa.bool_()), strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            count, rings = ragged(b.column("rings"))
            points = np.concatenate([[0], np.cumsum(ragged(rings.field("lon"))[0])])[np.concatenate([[0], np.cumsum(count)])]
            at = 0
            while at < b.num_rows:
                to = max(at + 1, int(np.searchsorted(points, points[at] + BATCH_POINTS, "right")) - 1)
                yield from cut(b.slice(at, to - at))
                at = to

    return features.mapInArrow(run, f"level int, x long, y long, ord {ORD}, geom int, cls int, attr int, parts {PARTS}, full boolean")


def encode_tiles(grouped: DataFrame, levels: tuple[tuple, ...], limits: codec.Limits = codec.FORMAT) -> DataFrame:
    """(level, x, y, key, len, crc, blob) from rows of relational.group_tiles. A tile without features is empty."""
    bits, buffers = np.array([v[3] for v in levels]), np.array([v[4] for v in levels])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(*s) for s in slices(ragged(whole.column("features"))[0], BATCH_FEATURES)):
                level, tx, ty = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("level", "x", "y"))
                features, rows = ragged(b.column("features"))
                column = lambda c: pc.fill_null(rows.field(c), -1).to_numpy(zero_copy_only=False).astype(np.int64)  # noqa: E731, B023
                parts, rings = ragged(rows.field("parts"))
                size, values = ragged(rings)
                points = values.to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, 2)
                raw, sizes = codec.encode_tiles(codec.Tiles(features, column("geom"), column("cls"), column("attr"), parts, size // 2, points), -buffers[level], (1 << bits[level]) + buffers[level], limits)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                blobs = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(raw)])
                crcs = [zlib.crc32(raw[a:z]) for a, z in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(level, pa.int32()), pa.array(tx), pa.array(ty), pa.array(codec.tile_keys(tx, ty)), pa.array(sizes, pa.int32()), pa.array(crcs, pa.int64()), blobs], names=["level", "x", "y", "key", "len", "crc", "blob"])

    return grouped.mapInArrow(run, "level int, x long, y long, key long, len int, crc long, blob binary")


def decode_tiles(tiles: DataFrame, levels: tuple[tuple, ...], attrs: int = 0, limits: codec.Limits = codec.FORMAT) -> DataFrame:
    """(level, key, features, error) of encoded tiles; what breaks a rule gives an error text, never a failed task."""
    feature = "array<struct<geom:int,cls:int,attr:int,parts:array<array<int>>>>"
    bits, buffers = np.array([v[3] for v in levels]), np.array([v[4] for v in levels])

    def fault(raw: bytes, level: int, crc: int) -> str | None:
        try:
            codec.demand(len(raw) <= limits.tile, "tile too large")
            codec.demand(zlib.crc32(raw) == crc, "tile checksum differs")
            codec.decode_tile(raw, int(bits[level]), int(buffers[level]), attrs, limits)
        except codec.FormatError as e:
            return str(e)
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(*s) for s in slices(pc.fill_null(pc.binary_length(whole.column("blob")), 0).to_numpy(zero_copy_only=False), BATCH_BYTES)):
                level, crcs, raws = (b.column(c).to_pylist() for c in ("level", "crc", "blob"))
                sound = [len(raw) <= limits.tile and zlib.crc32(raw) == crc for raw, crc in zip(raws, crcs, strict=True)]
                at = np.array(level, np.int64)
                t, read = codec.decode_tiles([raw if ok else b"\x80" for raw, ok in zip(raws, sound, strict=True)], -buffers[at], (1 << bits[at]) + buffers[at], attrs, limits)
                errors = [None if ok else fault(raw, n, crc) or "unreadable" for raw, n, crc, ok in zip(raws, level, crcs, read.tolist(), strict=True)]
                rows = pa.StructArray.from_arrays([pa.array(t.geom, pa.int32()), pa.array(t.cls, pa.int32()), pa.array(t.attr, pa.int32(), mask=t.attr < 0), nested(t.parts, t.size, t.points)], names=["geom", "cls", "attr", "parts"])
                ends = np.concatenate([[0], np.cumsum(t.features)])
                features = pa.ListArray.from_arrays(pa.array(ends, pa.int32(), mask=np.append(~read, False)), rows)
                yield pa.RecordBatch.from_arrays([pa.array(level, pa.int32()), b.column("key"), features, pa.array(errors, pa.string())], names=["level", "key", "features", "error"])

    return tiles.select("level", "key", "crc", "blob").mapInArrow(run, f"level int, key long, features {feature}, error string")


def spread_out(rows: DataFrame, by: str) -> DataFrame:
    """The rows dealt to all tasks: a kernel costs far more than the shuffle of what it reads, and a file may be one task."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), by)


def tiles_of(features: DataFrame, levels: tuple[tuple, ...], region_zoom: int | None = None, shape=geometry.plain_shape) -> DataFrame:
    """Encoded tiles of features, each tile's features in draw order."""
    cut = cut_features(spread_out(features, "ord"), levels, region_zoom, shape)
    return encode_tiles(relational.group_tiles(cut), levels)


def level_specs(levels: tuple[tuple, ...], full_class: int, grids: dict[int, dict] | None) -> list[codec.LevelSpec]:
    return [codec.LevelSpec(z, z0, z1, bits, buffer, int(tolerance * 10), [], full_class, None if grids is None else grids.get(n, {})) for n, (z, z0, z1, bits, buffer, tolerance) in enumerate(levels)]


def assemble(tiles: DataFrame, layer: codec.Layer) -> bytes:
    """The layer file of encoded tiles. A file is at most 2 GiB by its format, and only one is held at a time."""
    for row in tiles.select("level", "key", "blob").orderBy("level", "key").toLocalIterator(prefetchPartitions=True):
        layer.levels[row["level"]].tiles.append((row["key"], bytes(row["blob"])))
    return codec.write_layer(layer)


def digest(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def file_digest(path: str) -> str:
    """Of a file of any size, block by block."""
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def tile_range(south: float, west: float, north: float, east: float, zoom: int) -> tuple[int, int, int, int]:
    """Least and largest x and y of the zoom's tiles that touch a box."""
    a, b = geometry.project(np.array([west, east]), np.clip([north, south], -85.0511, 85.0511), zoom)
    inside = lambda v: int(min(max(v, 0), (1 << zoom) - 1))
    return inside(a[0]), inside(a[1]), inside(b[0]), inside(b[1])


def crop(entries: DataFrame, levels: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Entries (level, key, ...) whose tiles touch the box (south, west, north, east), as they are.

    `levels` (level, tile_zoom) is the file's own, of eight rows at most.
    """
    south, west, north, east = box
    e = entries.join(F.broadcast(levels), "level").withColumns({"x": x.unmorton_x("key"), "y": x.unmorton_y("key")})
    side = F.pow(F.lit(2.0), F.col("tile_zoom"))
    at = lambda world: F.least(F.greatest((world * side).cast("long"), F.lit(0)), (side - 1).cast("long"))
    px, py = (lambda lon: at(x.world_x(F.lit(lon), 0))), (lambda lat: at(x.world_y(F.lit(lat), 0, 85.0511)))
    return e.filter(F.col("x").between(px(west), px(east)) & F.col("y").between(py(north), py(south)))
