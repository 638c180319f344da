"""GeoJSON features by Spark's JSON functions, and a source of paged requests."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE = 100


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """(ix, feature): the features of one document, as variants in file order."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.from_json("value", "features array<variant>").alias("d")).select(F.posexplode("d.features").alias("ix", "feature"))


def prop(name: str, feature: str = "feature") -> Column:
    return F.try_variant_get(feature, f"$.properties.{name}", "string")


def polygons(feature: str = "feature") -> Column:
    """Polygons of a feature: an array of arrays of rings (lon, lat, outer).

    Rings of fewer than four points are left out and a repeated last point is dropped; the first ring is the outer one,
    and a polygon without it is none. A null or other geometry has no polygons.
    """
    kind = F.try_variant_get(feature, "$.geometry.type", "string")
    one = F.try_variant_get(feature, "$.geometry.coordinates", "array<array<array<double>>>")
    many = F.try_variant_get(feature, "$.geometry.coordinates", "array<array<array<array<double>>>>")
    given = F.when(kind == "Polygon", F.array(one)).when(kind == "MultiPolygon", many)

    def ring(points: Column, n: Column) -> Column:
        closed = F.element_at(points, 1) == F.element_at(points, -1)
        kept = F.when(closed, F.slice(points, F.lit(1), F.size(points) - 1)).otherwise(points)
        at = lambda k: F.transform(kept, lambda p: F.element_at(p, k))
        return F.when(F.size(points) >= 4, F.struct(at(1).alias("lon"), at(2).alias("lat"), (n == 0).alias("outer")))

    rings = F.transform(F.coalesce(given, F.array()), lambda poly: F.array_compact(F.transform(F.coalesce(poly, F.array()), ring)))
    return F.filter(rings, lambda r: (F.size(r) > 0) & F.element_at(r, 1)["outer"])


def fetch(spark: SparkSession, ids: DataFrame, get: Callable[[list[int]], str], page: int = PAGE) -> DataFrame:
    """(id, feature as JSON text) of all ids, fetched by pages in order of id.

    `get` returns the page's FeatureCollection for a list of ids; a page that cannot be read is halved down to single
    ids. Ids that come back otherwise than asked are an error.
    """
    ranked = ids.select(F.col("id").cast("long").alias("id")).distinct()
    pages = ranked.withColumn("page", F.floor(F.col("id") / F.lit(page))).groupBy("page").agg(F.array_sort(F.collect_list("id")).alias("ids"))

    def load(part: list[int]) -> list[dict]:
        try:
            return json.loads(get(part))["features"]
        except (ValueError, KeyError):
            if len(part) == 1:
                raise
            half = len(part) // 2
            return load(part[:half]) + load(part[half:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in b.column("ids").to_pylist():
                found = [f for lo in range(0, len(part), page) for f in load(part[lo : lo + page])]
                yield pa.RecordBatch.from_arrays([pa.array([int(f["properties"]["OBJECTID"]) for f in found], pa.int64()), pa.array([json.dumps(f) for f in found], pa.string())], names=["id", "feature"])

    out = pages.select("ids").mapInArrow(run, "id long, feature string")
    return out


def check_complete(found: DataFrame, ids: DataFrame) -> None:
    """Raises if ids are missing or were not asked for."""
    asked = ids.select(F.col("id").cast("long").alias("id"))
    missing, extra = asked.join(found, "id", "left_anti").count(), found.join(asked, "id", "left_anti").count()
    if missing or extra:
        raise ValueError(f"{missing} ids are missing and {extra} were not asked for")
