"""The pipelines: zones, overview, water, size estimate, crop, synthetic features, and the files around a pack."""

from __future__ import annotations

import itertools
import json
import os
import subprocess
import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import codec, geometry
from ..functions import constants as k
from ..functions import exprs as x
from ..operators import relational as r
from ..operators import tiles as t
from ..sources import geojson, pbf, shapefile, tilepack

def no_attr():
    return F.lit(None).cast("int")


def _ord(rank, a, b):
    return F.struct(F.lit(rank).cast("int").alias("rank"), a.cast("long").alias("a"), b.cast("long").alias("b"))


# ---- zones ----


def _record(rules: DataFrame) -> DataFrame:
    """`rules` (ord, cls, name, speed, months, days, flags, source, polygons) with `record`, its attribute record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in ("name", "speed", "months", "days", "flags", "source")), strict=True)
            tags = (k.NAME, k.SPEED, k.MONTHS, k.DAYS, k.FLAGS, k.SOURCE)
            made = [codec.encode_record([(tag, v) for tag, v in zip(tags, row, strict=True) if v is not None]) for row in rows]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.binary())], names=[*b.schema.names, "record"])

    schema = rules.select("*", F.lit(b"").alias("record")).schema
    return rules.mapInArrow(run, schema)


def zone_rules(boating: DataFrame, manatee: DataFrame) -> DataFrame:
    """Rules (ord, cls, name, speed, months, days, flags, source, polygons) of GeoJSON features (ix, feature): boating rules
    first, then the manatee seasons. Rules that restrict neither speed nor entry are left out; what is nought or all year
    is null."""
    some = lambda c: F.when(c != 0, c)
    b = boating.select("ix", "feature", x.boating_rule(geojson.prop("RESTRICTION")).alias("r")).filter(F.col("r").isNotNull())
    area = F.trim(F.coalesce(geojson.prop("AREA_NAME"), F.lit("")))
    b = b.select(
        _ord(0, F.col("ix"), F.lit(0)).alias("ord"), "r.cls", F.concat_ws(" · ", "r.name", F.when(area != "", area)).alias("name"), some(F.col("r.speed")).alias("speed"),
        F.lit(None).cast("int").alias("months"), F.lit(None).cast("int").alias("days"), some(F.col("r.flags")).alias("flags"),
        F.concat(F.lit("FAC "), F.coalesce(F.nullif(geojson.prop("RULE_NUM"), F.lit("")), F.lit("68D-24"))).alias("source"), geojson.polygons().alias("polygons"),
    )
    pair = lambda n: F.struct(geojson.prop(f"CLASS{n}_68C").alias("code"), geojson.prop(f"DATE{n}_68C").alias("dates"))
    m = manatee.select("ix", "feature", F.posexplode(F.array(pair(1), pair(2))).alias("season", "p"))
    m = m.select("ix", "feature", "season", x.manatee_rule("p.code").alias("r"), x.season("p.dates").alias("s")).filter(F.col("r").isNotNull())
    county = F.trim(F.coalesce(geojson.prop("COUNTY"), F.lit("")))
    flags = F.col("r.flags").bitwiseOR(F.when(F.col("s.partial"), k.PARTIAL).otherwise(0))
    m = m.select(
        _ord(1, F.col("ix"), F.col("season")).alias("ord"), "r.cls", F.concat_ws(" · ", F.lit("MANATEE ZONE"), "r.name", F.when(county != "", F.concat(county, F.lit(" COUNTY")))).alias("name"),
        some(F.col("r.speed")).alias("speed"), F.when(F.col("s.months") != k.ALL_YEAR, F.col("s.months")).alias("months"), F.col("r.days").alias("days"), some(flags).alias("flags"),
        F.concat(F.lit("FAC "), F.coalesce(F.nullif(geojson.prop("SECT_68C"), F.lit("")), F.lit("68C-22"))).alias("source"), geojson.polygons().alias("polygons"),
    )
    return b.unionByName(m)


def zone_features(boating: DataFrame, manatee: DataFrame) -> DataFrame:
    """Zones (ord, cls, record, rings): a row for each rule and polygon. What is null is not in the record."""
    out = _record(zone_rules(boating, manatee)).select("ord", "cls", "record", F.posexplode("polygons").alias("nth", "rings"))
    return out.select(_ord(F.col("ord.rank"), F.col("ord.a"), F.shiftleft(F.col("ord.b"), 32) + F.col("nth")).alias("ord"), "cls", "record", "rings")


def zone_cells(zones: DataFrame) -> DataFrame:
    """Zoom-8 cells in the box of each zone's outer ring, before it is simplified."""
    ring = F.element_at("rings", 1)
    lon, lat = ring["lon"], ring["lat"]
    span = lambda a, b: F.explode(F.sequence(F.floor(a), F.floor(b)))
    out = zones.select(F.array_min(lon).alias("w"), F.array_max(lon).alias("e"), F.array_min(lat).alias("s"), F.array_max(lat).alias("n"))
    out = out.withColumn("cx", span(x.world_x("w", 8), x.world_x("e", 8)))
    return out.withColumn("cy", span(x.world_y("n", 8), x.world_y("s", 8))).select("cx", "cy").distinct()


#: Bytes of a zones file's records and of their places in its table: what a header may hold, but for 512 KiB that its
#: grids, texts and fullest page tables leave free.
MOST_RECORD_BYTES = k.MOST_HEADER - (1 << 19)


def file_starts(sizes: list[tuple[int, int]], most: int, shift: int) -> list[int]:
    """Least keys of files, of (key, bytes) by rising key: whole cells (keys >> shift) go to a file, and a new one starts
    where the next cell would exceed `most`; a cell that exceeds it by itself is parted."""
    starts, used = [0], 0
    for cell, group in itertools.groupby(sizes, key=lambda s: s[0] >> shift):
        listed = list(group)
        whole = sum(size for _, size in listed)
        for n, (key, size) in enumerate([(0, whole)] if whole <= most else listed):
            if used and used + size > most:
                starts.append(key if n else cell << shift)
                used = 0
            used += size
    return starts


def zone_files(boating: DataFrame, manatee: DataFrame, date: str, build_time: int, data_time: int, name: str = "fwc-zones", most: int = MOST_RECORD_BYTES) -> Iterator[tuple[str, bytes]]:
    """Names and bytes of the zones layer's files, one after another: one, unless its header could not hold all records.

    Then tiles of the first level go to files in Morton order with the tiles below them (see file_starts), and a file
    lists the records that its own tiles name. One file is held at a time; what else reaches the driver is bounded by
    the grid's cells and, where there are several files, by the first level's tiles.
    """
    zones = zone_features(t.spread_out(boating, "ix"), t.spread_out(manatee, "ix")).persist(StorageLevel.DISK_ONLY)  # read for records, features and cells
    records = r.number_records(zones.select("record", "ord"), F.struct("ord.rank", F.shiftright("ord.a", 16))).persist(StorageLevel.DISK_ONLY)
    features = zones.join(records.select("record", "attr"), "record").select("ord", F.lit(k.POLYGON).alias("geom"), "cls", "attr", "rings")
    cut = t.cut_features(t.spread_out(features, "ord"), k.ZONE_LEVELS).drop("full")
    first = k.ZONE_LEVELS[0][0]
    above = lambda key: F.coalesce(*(F.when(F.col("level") == n, F.shiftright(key, 2 * (zoom - first))) for n, (zoom, *_) in enumerate(k.ZONE_LEVELS)))
    room, kept = F.length("record") + 4, [zones, records]
    starts, listed = [0], records.select(F.lit(0).alias("file"), "attr", "record")
    file_of = lambda key: F.size(F.filter(F.array(*(F.lit(s).cast("long") for s in starts)), lambda s: s <= key)) - 1
    if (records.agg(F.sum(room)).first()[0] or 0) > most:
        cut = cut.withColumn("region", above(x.morton("x", "y"))).persist(StorageLevel.DISK_ONLY)
        kept.append(cut)
        named = cut.select("region", "attr").distinct().join(records.select("attr", room.alias("room")), "attr")
        starts = file_starts([tuple(row) for row in named.groupBy("region").agg(F.sum("room")).orderBy("region").collect()], most, 2 * (first - k.GRID_ZOOM))
        cut = cut.withColumn("file", file_of(F.col("region")))
        own = F.row_number().over(Window.partitionBy("file").orderBy("attr")) - 1  # as many as a header holds
        pairs = cut.select("file", "attr").distinct().withColumn("own", own).persist(StorageLevel.DISK_ONLY)
        kept.append(pairs)
        listed = pairs.join(records, "attr").select("file", F.col("own").alias("attr"), "record")
        cut = cut.join(pairs, ["file", "attr"]).withColumn("attr", F.col("own"))
    tiles = t.encode_tiles(r.group_tiles(cut), k.ZONE_LEVELS).withColumn("file", file_of(above(F.col("key")))).persist(StorageLevel.DISK_ONLY)
    kept.append(tiles)
    grids: list[dict[tuple[int, int], int]] = [{} for _ in starts]
    shift, files = 2 * (first - k.GRID_ZOOM), np.array(starts)
    for cx, cy in zone_cells(zones).collect():  # at most 65 536
        low = codec.tile_key(cx, cy) << shift
        a, b = (np.searchsorted(files, [low, low + (1 << shift) - 1], "right") - 1).tolist()
        for n in range(a, b + 1):
            grids[n][cx, cy] = 1
    strings = [name, "FWC", "Public record (Florida FWC); not for navigation", "FWC", date, "terrapack"]
    try:
        for n, cells in enumerate(grids):
            held = [bytes(row["record"]) for row in listed.filter(F.col("file") == n).orderBy("attr").collect()]  # a layer holds them in its header
            layer = codec.Layer(k.ZONES, t.level_specs(k.ZONE_LEVELS, 1, {level: cells for level in range(len(k.ZONE_LEVELS))}), strings, dict(zip(k.ID_FIELDS, range(6), strict=True)), held, build_time, data_time)
            yield f"{name}.pmt" if len(grids) == 1 else f"{name}-{n + 1:02d}.pmt", t.assemble(tiles.filter(F.col("file") == n), layer)
    finally:
        for rows in kept:
            rows.unpersist()


def skipped_rules(boating: DataFrame) -> DataFrame:
    """Restrictions that are no rules of speed or entry, with their counts."""
    return boating.select(geojson.prop("RESTRICTION").alias("restriction")).filter(x.boating_rule("restriction").isNull()).groupBy("restriction").agg(F.count("*").alias("n"))


def build_zones(boating: DataFrame, manatee: DataFrame, date: str, build_time: int, data_time: int, name: str = "fwc-zones") -> tuple[bytes, DataFrame]:
    """The zones layer file, and the rules that were left out with their counts. Zones of several files are an error here
    (see zone_files)."""
    files = [raw for _, raw in itertools.islice(zone_files(boating, manatee, date, build_time, data_time, name), 2)]
    codec.demand(len(files) == 1, "more records than one header holds")
    return files[0], skipped_rules(boating)


# ---- overview ----

#: The shapefiles in order, the class of their shapes, and whether they are polygons.
OVERVIEW_SOURCES = (
    ("ne_10m_land", 1, True),
    ("ne_10m_minor_islands", 1, True),
    ("ne_10m_lakes", 2, True),
    ("ne_10m_lakes_north_america", 2, True),
    ("ne_10m_rivers_lake_centerlines", 3, False),
    ("ne_10m_rivers_north_america", 3, False),
)


def overview_features(spark: SparkSession, folder: str, sources=OVERVIEW_SOURCES) -> DataFrame:
    """Shapes of the sources that are there, in order, whose parts' boxes meet the overview's box."""
    out, files = None, {r_["path"].rsplit("/", 1)[-1] for r_ in spark.read.format("binaryFile").load(folder).select("path").collect()}
    south, west, north, east = k.OVERVIEW_BOX
    for rank, (stem, cls, closed) in enumerate(sources):
        if f"{stem}.zip" not in files:
            continue
        rows = shapefile.read_shapes(spark, f"{folder}/{stem}.zip")
        kinds = F.col("shape_type").isin(*shapefile.POLYGONS)
        meets = lambda p: (F.array_max(p["lon"]) >= west) & (F.array_min(p["lon"]) <= east) & (F.array_max(p["lat"]) >= south) & (F.array_min(p["lat"]) <= north)
        rows = rows.filter((F.size("parts") > 0) & (kinds == F.lit(closed)) & F.exists("parts", meets))
        rings = F.transform("parts", lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"), F.lit(True).alias("outer")))
        rows = rows.select(_ord(rank, F.col("rec_ix"), F.lit(0)).alias("ord"), F.lit(k.POLYGON if closed else k.LINE).alias("geom"), F.lit(cls).alias("cls"), no_attr().alias("attr"), rings.alias("rings"), x.min_zoom("attrs").alias("least_zoom"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError(f"no shapefile of the overview in {folder}")
    return out


def overview_shape(lon: np.ndarray, lat: np.ndarray, outer: bool, closed: bool):
    """As geometry.plain_shape, but the mean latitude counts a repeated last point and is held within 80 degrees, rings
    need four points with it and tell by their winding whether they are outer ones."""
    if len(lon) < (4 if closed else 2):
        return None
    mean, last = float(np.clip(np.mean(lat), -80, 80)), -1 if closed and lon[0] == lon[-1] and lat[0] == lat[-1] else len(lon)
    return lon[:last], lat[:last], geometry.runs_outward(lon, lat) if closed else outer, mean


def build_overview(spark: SparkSession, folder: str, build_time: int, data_time: int, sources=OVERVIEW_SOURCES) -> bytes:
    """The base layer file; tiles outside the overview's box are left out, and it has no grid."""
    tiles = t.tiles_of(overview_features(spark, folder, sources), k.OVERVIEW_LEVELS, None, overview_shape)
    inside = None
    for level, (zoom, *_) in enumerate(k.OVERVIEW_LEVELS):
        south, west, north, east = k.OVERVIEW_BOX
        (x0, y0), (x1, y1) = geometry.project(np.array([west, east]), np.array([north, south]), zoom).astype(int).tolist()
        here = (F.col("level") == level) & F.col("x").between(max(0, x0), min((1 << zoom) - 1, x1)) & F.col("y").between(max(0, y0), min((1 << zoom) - 1, y1))
        inside = here if inside is None else inside | here
    strings = ["overview", "Natural Earth", "Public domain", "Natural Earth", time.strftime("%Y-%m", time.gmtime(data_time)), "terrapack"]
    layer = codec.Layer(k.BASE, t.level_specs(k.OVERVIEW_LEVELS, 0, None), strings, dict(zip(k.ID_FIELDS, range(6), strict=True)), [], build_time, data_time)
    return t.assemble(tiles.filter(inside), layer)


# ---- water ----

POINTS = "array<struct<lat_e7:int,lon_e7:int>>"


def _ring_rows(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([q[n] for q in rows], kind) for n, kind in enumerate(kinds)], names=names)


def way_areas(found: DataFrame) -> DataFrame:
    """Closed ways (blob_ix, elem_ix, cls, refs, ids, pts) as polygons of one ring; `small` ones, below the least area,
    have no ring. `ids` and `pts` are the refs whose nodes are there."""

    def run(batches):
        for b in batches:
            (n_refs, refs), (n_ids, ids), (n_pts, pts) = (t.ragged(b.column(c)) for c in ("refs", "ids", "pts"))
            refs, ids = (v.to_numpy(zero_copy_only=False) for v in (refs, ids))
            some = n_ids > 0
            back = np.zeros(len(some), np.int64)  # the last point is left out if it is the way's last ref, which is its first one
            back[some] = ids[np.cumsum(n_ids)[some] - 1] == refs[np.cumsum(n_refs)[some] - 1]
            size, enough = n_pts - back, n_pts - back >= 3
            at = geometry.spread((np.cumsum(n_pts) - n_pts)[enough], size[enough])
            lat, lon = (1e-9 * (pts.field(c).to_numpy(zero_copy_only=False).astype(float)[at] * 100) for c in ("lat_e7", "lon_e7"))
            small = geometry.ground_areas(lat, lon, size[enough]) < k.LEAST_AREA
            kept, row = np.repeat(~small, size[enough]), pa.array(np.flatnonzero(enough))
            ends = pa.array(np.concatenate([[0], np.cumsum(size[enough][~small])]), pa.int32())
            rings = pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, pa.array(v[kept])) for v in (lon, lat)] + [pa.array(np.ones(len(ends) - 1, bool))], names=["lon", "lat", "outer"])
            listed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(~small)]), pa.int32()), rings)
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(row) for c in ("blob_ix", "elem_ix", "cls")), listed.cast(shapefile.RINGS), pa.array(small)], names=["blob_ix", "elem_ix", "cls", "rings", "small"])

    return found.mapInArrow(run, f"blob_ix int, elem_ix int, cls int, rings {t.RINGS}, small boolean")


def relation_areas(members: DataFrame) -> DataFrame:
    """Relations (blob_ix, elem_ix, cls, ways: role, refs and pts in member order) as polygons, with `unclosed` chains
    and `orphans`, holes whose first point lies in no outer ring. Kept holes count against the least area."""

    def run(batches):
        for b in batches:
            rows = []
            for blob, elem, cls, ways in zip(*(b.column(c).to_pylist() for c in ("blob_ix", "elem_ix", "cls", "ways")), strict=True):
                place = {n: (p["lon_e7"], p["lat_e7"]) for w in ways for n, p in zip(w["ids"], w["pts"], strict=True)}
                rings: dict[bool, list] = {}
                unclosed = 0
                for outer in (True, False):
                    chains, left = geometry.joined_rings([w["refs"] for w in ways if w["role"] in (("outer", "") if outer else ("inner",))])
                    unclosed += left
                    given = [1e-9 * (np.array([place[n] for n in c if n in place], float).reshape(-1, 2) * 100) for c in chains]
                    rings[outer] = [p for p in given if len(p) >= 3]
                kept = [h for h in rings[False] if any(geometry.holds(o, h[0]) for o in rings[True])]
                area = sum(geometry.ground_area(p[:, 1], p[:, 0]) for p in rings[True]) - sum(geometry.ground_area(p[:, 1], p[:, 0]) for p in kept)
                shapes = [{"lon": p[:, 0].tolist(), "lat": p[:, 1].tolist(), "outer": o} for o, some in ((True, rings[True]), (False, kept)) for p in some]
                rows.append((blob, elem, cls, shapes if rings[True] and area >= k.LEAST_AREA else [], unclosed, len(rings[False]) - len(kept) if rings[True] else 0, bool(rings[True]) and area < k.LEAST_AREA))
            yield _ring_rows(rows, ["blob_ix", "elem_ix", "cls", "rings", "unclosed", "orphans", "small"], [pa.int32(), pa.int32(), pa.int32(), shapefile.RINGS, pa.int32(), pa.int32(), pa.bool_()])

    return members.mapInArrow(run, f"blob_ix int, elem_ix int, cls int, rings {t.RINGS}, unclosed int, orphans int, small boolean")


#: The tags of which one makes a way or relation water (see exprs.way_kind).
WATER_TAGS = "natural=water,waterway=riverbank,landuse=reservoir"
LINE_TAGS = "waterway=river,waterway=canal"


def collect_water(spark: SparkSession, extract: str, sea: str | None = None) -> dict[str, DataFrame]:
    """`features` (t.FEATURE and a box in 1e-7 degrees), `cells` and `stats` of an extract and of sea polygons.

    Order is sea in file order, ways, relations, then lines. A later element of an id replaces an earlier one.
    """
    pbf.register(spark)
    load = lambda e, any_tag="": spark.read.format("osm_pbf").option("element", e).option("any_tag", any_tag).load(extract)
    relations = load("relation", WATER_TAGS).filter(x.is_water_relation("tags"))
    ways = r.latest(r.wanted_ways(load("way"), x.way_kind("tags"), r.member_ids(relations)), "id", ["blob_ix", "elem_ix"])
    ways = ways.select("blob_ix", "elem_ix", "id", "kind", "refs").persist(StorageLevel.DISK_ONLY)  # read once, and below
    nodes = r.latest(load("node").join(r.needed_nodes(ways), "id"), "id", ["blob_ix", "elem_ix"])
    ways = r.found_points(ways, nodes).persist(StorageLevel.DISK_ONLY)  # areas, relations and lines are made of them

    areas = way_areas(ways.filter(F.col("kind.area").isNotNull() & x.is_closed("refs")).select("blob_ix", "elem_ix", F.col("kind.area").alias("cls"), "refs", "ids", "pts"))
    made = relation_areas(r.relation_ways(relations.withColumn("cls", x.area_class("tags")), ways))
    line = F.array(F.struct(F.transform("pts", lambda p: x.degrees_e7(p["lon_e7"])).alias("lon"), F.transform("pts", lambda p: x.degrees_e7(p["lat_e7"])).alias("lat"), F.lit(True).alias("outer")))
    lines = ways.filter(F.col("kind.line").isNotNull() & (F.size("pts") >= 2)).select("blob_ix", "elem_ix", F.col("kind.line").alias("cls"), line.alias("rings"))

    cells = r.data_cells(load("node"))
    as_feature = lambda df, rank, geom: df.select(_ord(rank, F.col("blob_ix"), F.col("elem_ix")).alias("ord"), F.lit(geom).alias("geom"), "cls", no_attr().alias("attr"), "rings")
    features = as_feature(areas.filter(~F.col("small")), 1, k.POLYGON).unionByName(as_feature(made.filter(F.size("rings") > 0), 2, k.POLYGON)).unionByName(as_feature(lines, 3, k.LINE))
    n_sea = F.lit(0).cast("long")
    if sea:
        grid = lambda v: F.transform(v, lambda d: x.degrees_e7(F.rint(d * 1e7)))
        on_grid = F.transform("rings", lambda q: F.struct(grid(q["lon"]).alias("lon"), grid(q["lat"]).alias("lat"), q["outer"].alias("outer")))
        shore = shapefile.sea_rings(spark, sea, cells).select(_ord(0, F.col("rec_ix"), F.lit(0)).alias("ord"), F.lit(k.POLYGON).alias("geom"), F.lit(1).alias("cls"), no_attr().alias("attr"), on_grid.alias("rings"))
        features, n_sea = shore.unionByName(features), F.lit(shore.count())
    counts = made.select("unclosed", "orphans", "small").unionByName(areas.select(F.lit(0).alias("unclosed"), F.lit(0).alias("orphans"), "small"))
    stats = counts.agg(n_sea.alias("sea"), F.count_if("small").alias("small"), F.coalesce(F.sum("unclosed"), F.lit(0)).alias("unclosed"), F.coalesce(F.sum("orphans"), F.lit(0)).alias("orphan_holes"))
    return {"features": with_box(features), "cells": cells, "stats": stats}


def keep_store(found: dict[str, DataFrame], folder: str) -> None:
    """Writes features, cells and stats as tables of a store, and last a table that marks it as whole."""
    spark = found["stats"].sparkSession
    for name in ("features", "cells", "stats"):
        found[name].write.mode("overwrite").parquet(f"{folder}/{name}")
    spark.range(1).write.mode("overwrite").parquet(f"{folder}/complete")


def open_store(spark: SparkSession, folder: str) -> dict[str, DataFrame] | None:
    """The tables of a store, or None unless it is whole."""
    try:
        spark.read.parquet(f"{folder}/complete")
    except AnalysisException:
        return None
    return {n: spark.read.parquet(f"{folder}/{n}") for n in ("features", "cells", "stats")}


def in_box(features: DataFrame, south: int, west: int, north: int, east: int) -> DataFrame:
    """Features whose boxes meet a box (1e-7 degrees); on a store the comparisons reach the scan."""
    return features.filter(x.boxes_meet("lat_min", "lon_min", "lat_max", "lon_max", south, west, north, east))


def with_box(features: DataFrame) -> DataFrame:
    flat = lambda c: F.flatten(F.transform("rings", lambda q: q[c]))
    e7 = lambda v: F.rint(v * 1e7).cast("long")
    return features.withColumns({f"{c}_{n}": e7(f(flat(c))) for c in ("lon", "lat") for n, f in (("min", F.array_min), ("max", F.array_max))})


def water_tiles(features: DataFrame, cells: DataFrame, region_zoom: int = k.REGION_ZOOM) -> tuple[DataFrame, dict[int, DataFrame]]:
    """Encoded tiles of the regions that hold data, and each level's grid (cx, cy, value).

    Features go to each region they may meet, and each copy is cut within its region alone. Tiles that the sea fills,
    in cells of which it fills more than half, are told by the grid instead; the other tiles of such cells are stored.
    """
    regions = r.regions_of(cells, region_zoom)
    pairs = r.features_by_region(features, region_zoom).join(regions, ["rx", "ry"])
    cut = t.cut_features(pairs.select("ord", "geom", "cls", "attr", "rings", "rx", "ry").repartition("rx", "ry", F.xxhash64("ord")), k.WATER_LEVELS, region_zoom)
    sea_only = (F.size("features") == 1) & F.element_at("features", 1)["full"] & (F.element_at("features", 1)["cls"] == 1)
    item = F.struct("ord", "geom", "cls", "attr", "parts", "full")
    grouped = cut.groupBy("level", "x", "y").agg(F.array_sort(F.collect_list(item)).alias("features")).withColumn("open_sea", sea_only).persist()
    out, grids = None, {}
    for level, (zoom, *_) in enumerate(k.WATER_LEVELS):
        here = grouped.filter(F.col("level") == level)
        grids[level] = r.coverage(here.select("x", "y", "open_sea"), cells, zoom).persist()
        stored = r.fill_full_cells(here.select("x", "y", "open_sea"), grids[level], zoom)
        rows = stored.join(here.select("x", "y", "features"), ["x", "y"], "left").select(F.lit(level).alias("level"), "x", "y", "features")
        out = rows if out is None else out.unionByName(rows)
    return t.encode_tiles(out, k.WATER_LEVELS), grids


@dataclass
class WaterPack:
    """What a water pack is written from: its tiles with the file that each goes to, and what the files' heads tell."""

    tiles: DataFrame  # file, level, key, blob
    names: list[str]
    layers: list[codec.Layer]


def plan_water(spark: SparkSession, extract: str, sea: str | None = None, build_time: int = 0, most: int = k.MOST_PACK_BYTES, region_zoom: int = k.REGION_ZOOM, name: str = "water", features: DataFrame | None = None, cells: DataFrame | None = None, maker: str = "terrapack") -> WaterPack:
    """Whole regions go to files in Morton order, each file within `most` bytes of tiles.

    Features and cells may be given, as from a store; the extract then only tells its time. What reaches the driver is
    bounded by the grid's 65 536 cells."""
    if features is None:
        found = collect_water(spark, extract, sea)
        features, cells = found["features"].persist(), found["cells"].persist()
    pbf.register(spark)
    stamp = spark.read.format("osm_pbf").option("element", "header").load(extract).first()[0] or int(os.stat(extract).st_mtime)
    tiles, grids = water_tiles(features, cells, region_zoom)
    key = None
    for level, (zoom, *_) in enumerate(k.WATER_LEVELS):
        up = zoom - region_zoom
        here = x.morton(F.shiftright("x", up), F.shiftright("y", up))
        key = F.when(F.col("level") == level, here) if key is None else key.when(F.col("level") == level, here)
    tiles = tiles.withColumn("region_key", key).persist()
    regions = r.regions_of(cells, region_zoom).select("region_key")
    sizes = regions.join(tiles.groupBy("region_key").agg(F.sum("len").alias("bytes")), "region_key", "left").select("region_key", F.coalesce("bytes", F.lit(0)).alias("bytes"))
    files = r.pack_files(sizes, most).select("region_key", "file").persist()
    n_files = (files.agg(F.max("file")).first()[0] or 0) + 1
    strings = ["osm-water", "© OpenStreetMap contributors", "ODbL 1.0", "OpenStreetMap", time.strftime("%Y-%m-%d", time.gmtime(stamp)), maker]
    up = k.GRID_ZOOM - region_zoom
    cell_key = x.morton(F.shiftright("cx", up), F.shiftright("cy", up))
    grid: list[dict[int, dict]] = [{level: {} for level in grids} for _ in range(n_files)]
    for level, g in grids.items():
        for c in g.withColumn("region_key", cell_key).join(files, "region_key").collect():
            grid[c["file"]][level][c["cx"], c["cy"]] = c["value"]
    layers = [codec.Layer(k.WATER, t.level_specs(k.WATER_LEVELS, 1, g), strings, dict(zip(k.ID_FIELDS, range(6), strict=True)), [], build_time, stamp) for g in grid]
    names = [f"{name}.pmt"] if n_files == 1 else [f"{name}-{n + 1:02d}.pmt" for n in range(n_files)]
    return WaterPack(tiles.join(files, "region_key").select("file", "level", "key", "blob"), names, layers)


def build_water(spark: SparkSession, extract: str, sea: str | None = None, **options) -> Iterator[tuple[str, bytes]]:
    """Names and bytes of the pack's files, one after another (see plan_water). One file is held at a time."""
    pack = plan_water(spark, extract, sea, **options)
    for n, (name, layer) in enumerate(zip(pack.names, pack.layers, strict=True)):
        yield name, t.assemble(pack.tiles.filter(F.col("file") == n), layer)


def write_water(pack: WaterPack, folder: str) -> DataFrame:
    """Writes the pack's files to a folder that all executors share: (name, bytes, sha256) of each.

    A file is one task's: its tiles come sorted, their data streams to the file, and only index entries are held."""
    spark, names, layers = pack.tiles.sparkSession, pack.names, pack.layers
    folder = folder.removeprefix("file://")
    none = spark.range(len(names)).select(F.col("id").cast("int").alias("file"), F.lit(-1).alias("level"), F.lit(0).cast("long").alias("key"), F.lit(b"").alias("blob"))
    rows = pack.tiles.select("file", "level", "key", "blob").unionByName(none)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("file", "level", "key", "blob")), strict=True))
        for n, group in itertools.groupby(flat, key=lambda row: row[0]):
            os.makedirs(folder, exist_ok=True)
            path = f"{folder}/{names[n]}"
            size = codec.write_stream(layers[n], ((level, key, raw) for _, level, key, raw in group if level >= 0), path)
            yield _ring_rows([(names[n], size, t.file_digest(path))], ["name", "bytes", "sha256"], [pa.string(), pa.int64(), pa.string()])

    return rows.repartition(len(names), "file").sortWithinPartitions("file", "level", "key").mapInArrow(run, "name string, bytes long, sha256 string")


# ---- size estimate ----

#: The tags that put an element into a category, which are looked at in this order.
ESTIMATE_AREA = (("natural", "water"), ("waterway", "riverbank"), ("landuse", "reservoir"))
ESTIMATE_COAST = (("natural", "coastline"),)
ESTIMATE_LINE = (("waterway", "river"), ("waterway", "canal"))


def estimate_category(tags, is_member):
    has = lambda pairs: F.greatest(*(x.tag(tags, a) == b for a, b in pairs)) if len(pairs) > 1 else x.tag(tags, pairs[0][0]) == pairs[0][1]
    return F.when(has(ESTIMATE_AREA), "area").when(has(ESTIMATE_COAST), "coast").when(has(ESTIMATE_LINE), "line").when(is_member, "member")


def estimate(spark: SparkSession, extract: str) -> DataFrame:
    """By category: ways, their vertices, nodes that are missing, small areas left out, and for each level the vertices
    that simplification leaves and their bytes. Ways of fewer than two nodes count only their missing ones."""
    pbf.register(spark)
    load = lambda e: spark.read.format("osm_pbf").option("element", e).load(extract)
    area = estimate_category("tags", F.lit(False)) == "area"
    members = r.member_ids(load("relation").filter((x.tag("tags", "type") == "multipolygon") & area))
    ways = load("way").filter(F.size("refs") > 0).join(members.withColumn("is_member", F.lit(True)), "id", "left")
    ways = ways.withColumn("category", estimate_category("tags", F.coalesce("is_member", F.lit(False)))).filter(F.col("category").isNotNull())
    ways = ways.select("id", "category", "refs").persist(StorageLevel.DISK_ONLY)  # the extract's ways are read once
    points = r.way_points(ways, r.latest(load("node"), "id", ["blob_ix", "elem_ix"]).join(r.needed_nodes(ways), "id"))
    closed = F.element_at("refs", 1) == F.element_at("refs", -1)
    rows = ways.join(points, "id", "left").select("category", F.size("refs").alias("refs"), closed.alias("closed"), F.coalesce("pts", F.array().cast(POINTS)).alias("pts"))
    names = ["category", "ways", "vertices", "missing", "dropped_small", *(f"{w}_{n}" for n in range(1, 4) for w in ("vertices", "bytes"))]

    def run(batches):
        for b in batches:
            size, pts = t.ragged(b.column("pts"))
            lat, lon = (1e-9 * (pts.field(c).to_numpy(zero_copy_only=False).astype(float) * 100) for c in ("lat_e7", "lon_e7"))
            lines = geometry.Parts(geometry.on_ground(lat, lon, size), size)
            one = size >= 2
            small = one & b.column("closed").to_numpy(zero_copy_only=False) & np.array(pc.equal(b.column("category"), "area")) & (geometry.open_areas(lines) < k.LEAST_AREA)
            counted = one & ~small
            low = lines.start[counted]
            sizes = []
            for tolerance, units in k.ESTIMATE_LEVELS:
                keep = geometry.spans_kept(lines.points, low, low + size[counted] - 1, np.full(len(low), tolerance))
                left = lines.keep(keep)
                sizes += [left.size, encoded_sizes(lat[keep], lon[keep], left.size, units) * counted]
            out = (counted, size * counted, b.column("refs").to_numpy() - size, small, *sizes)
            yield pa.RecordBatch.from_arrays([b.column("category"), *(pa.array(v.astype(np.int64)) for v in out)], names=names)

    made = rows.mapInArrow(run, "category string, " + ", ".join(f"{n} long" for n in names[1:]))
    return made.groupBy("category").agg(*(F.sum(n).alias(n) for n in names[1:]))


def encoded_sizes(lat: np.ndarray, lon: np.ndarray, size: np.ndarray, units: int) -> np.ndarray:
    """Of each line of so many points the bytes of its differences at so many units for a zoom-12 tile, the first from
    nought, and of its head."""
    lines = geometry.Parts(np.floor(geometry.project(lon, np.clip(lat, -85.05, 85.05), 12) * units).astype(np.int64), size)
    step = lines.points.copy()
    step[1:] -= np.where((lines.part[1:] == lines.part[:-1])[:, None], lines.points[:-1], 0)
    folded = np.where(step >= 0, 2 * step, -2 * step - 1)
    wide = 1 + sum((folded >= 1 << 7 * n).astype(np.int64) for n in range(1, 9))
    return np.bincount(lines.part, wide.sum(axis=1), len(lines)).astype(np.int64) + 3


# ---- synthetic features ----


def synthetic(spark: SparkSession, lat: float, lon: float, km: float = 60.0, seed: int = 1, lakes: int = 200, rough: float = 0.18, high: float | None = None) -> DataFrame:
    """Lakes with rough shores, some with islands, and a sea in the west: a row each, seeded by its number. The box is `km`
    wide and `high` (or as much) high."""

    def shore(rng, cx, cy, radius, step) -> np.ndarray:
        angle = np.sort(rng.uniform(0, 2 * np.pi, 10))
        reach = radius * rng.uniform(0.6, 1.3, 10)
        ring = np.stack([cx + reach * np.cos(angle), cy + reach * np.sin(angle)], axis=1)
        while (size := np.hypot(*(np.roll(ring, -1, axis=0) - ring).T)).max() >= step:
            after = np.roll(ring, -1, axis=0)
            aside = np.stack([-(after - ring)[:, 1], (after - ring)[:, 0]], axis=1) * (rough * rng.uniform(-1, 1, len(size)))[:, None]
            ring = np.stack([ring, (ring + after) / 2 + aside], axis=1).reshape(-1, 2)
        return ring

    per = 111_320.0

    def degrees(ring: np.ndarray, outer: bool) -> dict:
        return {"lon": (lon + ring[:, 0] / (per * np.cos(np.radians(lat)))).tolist(), "lat": (lat + ring[:, 1] / per).tolist(), "outer": outer}

    def run(batches):
        half, up = km * 500.0, (high or km) * 500.0
        for b in batches:
            out = []
            for n in b.column("id").to_pylist():
                rng = np.random.default_rng([seed, n])
                if n == 0:
                    edge = np.linspace(-up, up, 64)
                    coast = np.stack([-half / 3 + half * rough * rng.uniform(-1, 1, 64), edge], axis=1)
                    rings = [degrees(np.concatenate([coast, [[-half * 1.1, up], [-half * 1.1, -up]]]), True)]
                else:
                    cx, cy, radius = *(rng.uniform(-1, 1, 2) * [half, up]), float(np.exp(rng.uniform(np.log(80), np.log(3000))))
                    rings = [degrees(shore(rng, cx, cy, radius, 30.0), True)]
                    if rng.uniform() < 0.2:
                        rings.append(degrees(shore(rng, cx, cy, radius / 6, 30.0), False))
                out.append(({"rank": 0 if n == 0 else 1, "a": n, "b": 0}, k.POLYGON, 1 if n == 0 else 2, None, rings))
            yield _ring_rows(out, ["ord", "geom", "cls", "attr", "rings"], [pa.struct([("rank", pa.int32()), ("a", pa.int64()), ("b", pa.int64())]), pa.int32(), pa.int32(), pa.int32(), shapefile.RINGS])

    return spark.range(lakes + 1).mapInArrow(run, t.FEATURE)


# ---- cropping, sidecars ----


def pack_name(extract: str) -> str:
    """A pack's name after its extract's: what stands before the first dot, without a mark that it is the latest."""
    return os.path.basename(extract).split(".")[0].replace("-latest", "")


def commit_stamp() -> str:
    """The commit that this library's code is from, or "unknown"."""
    try:
        done = subprocess.run(["git", "-C", os.path.dirname(os.path.abspath(__file__)), "rev-parse", "--short", "HEAD"], capture_output=True, text=True, check=True)
        return done.stdout.strip()
    except (OSError, subprocess.CalledProcessError):
        return "unknown"


def crop_file(spark: SparkSession, path: str, box: tuple[float, float, float, float], limits: str = "format") -> bytes:
    """A layer file of the tiles and grid cells that touch a box (south, west, north, east); the rest is as it was."""
    tilepack.register(spark)
    part = lambda p: spark.read.format("tilepack").option("part", p).option("limits", limits).load(path)
    levels = part("levels").orderBy("level").collect()
    with open(path.removeprefix("file://"), "rb") as f:
        source = codec.LayerFile(f.read())
    x0, y0, x1, y1 = t.tile_range(*box, k.GRID_ZOOM)
    specs = []
    for v, old in zip(levels, source.levels, strict=True):
        grid = None if old.grid is None else {(int(a), int(b)): int(old.grid[b, a]) for b, a in np.argwhere((old.grid > 0) & (old.grid < 3)) if x0 <= a <= x1 and y0 <= b <= y1}
        specs.append(codec.LevelSpec(v["tile_zoom"], v["zoom_min"], v["zoom_max"], v["bits"], v["buffer"], v["tolerance_dm"], [], v["full_class"], grid))
    ids = {n: (None if i == k.NO_STRING else i) for n, i in source.ids.items()}
    layer = codec.Layer(source.kind, specs, source.strings, ids, source.records, source.build_time, source.data_time)
    return t.assemble(t.crop(part("tiles"), part("levels").select("level", "tile_zoom"), box), layer)


def check(spark: SparkSession, path: str, limits: str = "format") -> DataFrame:
    """Levels, tiles and the first error of a layer file; a file that cannot be opened is an error of its own."""
    tilepack.register(spark)
    return spark.read.format("tilepack").option("limits", limits).load(path).agg(F.count_distinct("level").alias("levels"), F.count("*").alias("tiles"), F.count("error").alias("bad"), F.min_by("error", F.when(F.col("error").isNotNull(), F.col("level") * (1 << 33) + F.col("key"))).alias("first_error"))


def sources_json(kind: str, sources: list[dict], files: dict[str, tuple[int, str]], built: int) -> str:
    """What a pack was made from, and sizes and hashes of its files."""
    listed = {n: {"bytes": size, "sha256": digest} for n, (size, digest) in files.items()}
    return json.dumps({"format": kind, "built_utc": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime(built)), "sources": sources, "files": listed}, indent=2) + "\n"


ATTRIBUTION = "Map data © OpenStreetMap contributors, under the Open Database License (ODbL): openstreetmap.org/copyright. Not for navigation.\n"
LICENSE = "This map data is made available under the Open Database License (ODbL) 1.0: https://opendatacommons.org/licenses/odbl/1-0/. Contents © OpenStreetMap contributors.\n"


def hashed_files(spark: SparkSession, folder: str, name: str = "MANIFEST.sha256") -> DataFrame:
    """(sha256, name) of each file of a folder, without the manifest itself; read by Spark from any file system."""
    found = spark.read.format("binaryFile").load(folder).select(F.sha2("content", 256).alias("sha256"), F.element_at(F.split("path", "/"), -1).alias("name"))
    return found.filter(F.col("name") != name)


def dump_table(spark: SparkSession, path: str, limits: str = "format") -> DataFrame:
    """Lines of the canonical dump as (level, key, nth, line): the head's as level -1, then each tile's own, made where
    it is read. In order of the three numbers they are the dump."""
    tilepack.register(spark)
    with open(path.removeprefix("file://"), "rb") as f:
        file = codec.LayerFile(f.read())
    head = spark.createDataFrame([(-1, 0, n, line) for n, line in enumerate(codec.head_lines(file))], "level int, key long, nth int, line binary")
    params, attrs = [(v.bits, v.buffer) for v in file.levels], len(file.records)

    def run(batches):
        for b in batches:
            rows = []
            for level, key, crc, raw in zip(*(b.column(c).to_pylist() for c in ("level", "key", "crc", "blob")), strict=True):
                features = codec.decode_tile(raw, *params[level], attrs, codec.ANY_SIZE if limits == "any_size" else codec.FORMAT)
                if len(rows) > 100_000:
                    yield _ring_rows(rows, ["level", "key", "nth", "line"], [pa.int32(), pa.int64(), pa.int32(), pa.binary()])
                    rows = []
                rows += [(level, key, n, line) for n, line in enumerate(codec.tile_lines(level, key, len(raw), crc, features))]
            yield _ring_rows(rows, ["level", "key", "nth", "line"], [pa.int32(), pa.int64(), pa.int32(), pa.binary()])

    tiles = spark.read.format("tilepack").option("limits", limits).load(path).select("level", "key", "crc", "blob").mapInArrow(run, "level int, key long, nth int, line binary")
    return head.unionByName(tiles)


def lookup(places: DataFrame, path: str) -> DataFrame:
    """`places` (level, key) of a layer file with `len` of the tile there, or null: by page table and page, on the executors."""

    def run(batches):
        with open(path.removeprefix("file://"), "rb") as f:
            file = codec.LayerFile(f.read())
        for b in batches:
            found = [file.find(level, *codec.tile_place(key)) for level, key in zip(b.column("level").to_pylist(), b.column("key").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("level"), b.column("key"), pa.array([None if e is None else e[2] for e in found], pa.int64())], names=["level", "key", "len"])

    return places.select("level", "key").mapInArrow(run, "level int, key long, len long")


def manifest(folder: str, name: str = "MANIFEST.sha256") -> str:
    """Hash and name of each file of a folder by name, without the manifest itself."""
    files = [n for n in sorted(os.listdir(folder)) if n != name and os.path.isfile(f"{folder}/{n}")]
    return "".join(f"{t.file_digest(f'{folder}/{n}')}  {n}\n" for n in files)
