"""The library's functions and sources under SQL names: `SELECT tp_morton(x, y)`, `SELECT * FROM tp_tiles`."""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources import pbf, tilepack
from . import codec
from . import constants as k

#: Expressions of one row, which the optimizer reads like any other: name, parameters, result and body.
EXPRESSIONS = (
    ("tp_zigzag", "v BIGINT", "BIGINT", "shiftleft(v, 1) ^ shiftright(v, 63)"),
    ("tp_unzigzag", "u BIGINT", "BIGINT", "shiftright(u, 1) ^ -(u & 1L)"),
    ("tp_varint_bytes", "v BIGINT", "INT", "CASE " + " ".join(f"WHEN v < {1 << 7 * n} THEN {n}" for n in range(1, 9)) + " ELSE 9 END"),
    ("tp_morton", "x BIGINT, y BIGINT", "BIGINT", " | ".join(f"shiftleft(shiftright(x, {n}) & 1L, {2 * n}) | shiftleft(shiftright(y, {n}) & 1L, {2 * n + 1})" for n in range(k.MOST_TILE_ZOOM))),
    ("tp_tile_x", "tile_key BIGINT", "BIGINT", " | ".join(f"shiftleft(shiftright(tile_key, {2 * n}) & 1L, {n})" for n in range(k.MOST_TILE_ZOOM))),
    ("tp_tile_y", "tile_key BIGINT", "BIGINT", " | ".join(f"shiftleft(shiftright(tile_key, {2 * n + 1}) & 1L, {n})" for n in range(k.MOST_TILE_ZOOM))),
    ("tp_world_x", "lon DOUBLE, bits INT", "DOUBLE", "(lon + 180D) / 360D * pow(2D, bits)"),
    ("tp_world_y", "lat DOUBLE, bits INT", "DOUBLE", f"(0.5D - ln((1 + sin(radians(least(greatest(lat, -{k.MAX_LATITUDE}D), {k.MAX_LATITUDE}D)))) / (1 - sin(radians(least(greatest(lat, -{k.MAX_LATITUDE}D), {k.MAX_LATITUDE}D))))) / (4 * pi())) * pow(2D, bits)"),
)


def _tile_errors(limits: codec.Limits):
    def fault(raw, crc, bits, buffer, attrs):
        try:
            codec.demand(zlib.crc32(raw) == crc, "tile checksum differs")
            codec.decode_tile(bytes(raw), int(bits), int(buffer), int(attrs), limits)
        except codec.FormatError as e:
            return str(e)
        return None

    def tile_error(blob: pd.Series, crc: pd.Series, bits: pd.Series, buffer: pd.Series, attrs: pd.Series) -> pd.Series:
        return pd.Series([None if raw is None else fault(raw, *rest) for raw, *rest in zip(blob, crc, bits, buffer, attrs, strict=True)], dtype=object)

    return F.pandas_udf(tile_error, "string")


def _ring_area(points: pd.Series) -> pd.Series:
    def area(v):
        if v is None:
            return None
        x, y = [int(c) for c in v[::2]], [int(c) for c in v[1::2]]
        return sum(a * d - c * b for a, b, c, d in zip(x, y, x[1:] + x[:1], y[1:] + y[:1], strict=True))

    return points.map(area)


def register(spark: SparkSession) -> None:
    """Makes the functions known to the session, and the data sources osm_pbf and tilepack."""
    for name, params, result, body in EXPRESSIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {result} RETURN {body}")
    spark.udf.register("tp_tile_error", _tile_errors(codec.FORMAT))
    spark.udf.register("tp_any_tile_error", _tile_errors(codec.ANY_SIZE))
    spark.udf.register("tp_twice_area", F.pandas_udf(_ring_area, "long"))
    pbf.register(spark)
    tilepack.register(spark)


def open_views(spark: SparkSession, path: str, prefix: str = "tp", limits: str = "format") -> None:
    """Views of a layer file's parts: PREFIX_tiles, PREFIX_levels, PREFIX_strings, PREFIX_records and PREFIX_grid."""
    register(spark)
    for part in ("tiles", "levels", "strings", "records", "grid"):
        spark.read.format("tilepack").option("part", part).option("limits", limits).load(path).createOrReplaceTempView(f"{prefix}_{part}")
