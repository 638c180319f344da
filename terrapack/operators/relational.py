"""Relational operators of the tile pipelines: joins by id, tile grouping, coverage, dedupe, layout and packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as k
from ..functions import exprs as x


def latest(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Of rows that share a key the last in order, as where a later element replaces an earlier one."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*(F.desc(c) for c in order)))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def member_ids(relations: DataFrame) -> DataFrame:
    """Distinct way ids among the members (type 1) of relations (members: array of type, ref, role)."""
    return relations.select(F.explode("members").alias("m")).filter(F.col("m.type") == 1).select(F.col("m.ref").alias("id")).distinct()


def wanted_ways(ways: DataFrame, kind: Column, members: DataFrame) -> DataFrame:
    """Ways of a kind, and ways that a relation has as member; ways without refs are left out. Adds kind, is_member."""
    out = ways.filter(F.size("refs") > 0).withColumn("kind", kind)
    out = out.join(members.withColumn("is_member", F.lit(True)), "id", "left").withColumn("is_member", F.coalesce("is_member", F.lit(False)))
    return out.filter(F.col("kind").isNotNull() | F.col("is_member"))


def needed_nodes(ways: DataFrame) -> DataFrame:
    return ways.select(F.explode("refs").alias("id")).distinct()


def way_points(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Each way's id with `pts`, its nodes (lat_e7, lon_e7) in order of refs; nodes that are missing fall out."""
    refs = ways.select("id", F.posexplode("refs").alias("pos", "ref"))
    found = refs.join(nodes.select(F.col("id").alias("ref"), "lat_e7", "lon_e7"), "ref")
    pts = F.array_sort(F.collect_list(F.struct("pos", "lat_e7", "lon_e7")))
    return found.groupBy("id").agg(F.transform(pts, lambda p: F.struct(p["lat_e7"].alias("lat_e7"), p["lon_e7"].alias("lon_e7"))).alias("pts"))


def relation_ways(relations: DataFrame, ways: DataFrame) -> DataFrame:
    """Each relation (blob_ix, elem_ix, cls, members) with `ways`: role, refs, ids and pts of its member ways in order.

    Members that are not there fall out; ways without found nodes stay, as rings are put together by ids.
    """
    member = relations.select("blob_ix", "elem_ix", "cls", F.posexplode("members").alias("pos", "m")).filter(F.col("m.type") == 1)
    member = member.join(ways.select(F.col("id").alias("wid"), "refs", "pts", "ids"), F.col("m.ref") == F.col("wid"))
    item = F.struct("pos", F.col("m.role").alias("role"), "refs", "ids", "pts")
    return member.groupBy("blob_ix", "elem_ix", "cls").agg(F.array_sort(F.collect_list(item)).alias("ways"))


def found_points(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """`ways` with `ids` and `pts` (lat_e7, lon_e7), the refs whose nodes are there, in order; empty where none is."""
    refs = ways.select("id", F.posexplode("refs").alias("pos", "ref")).join(nodes.select(F.col("id").alias("ref"), "lat_e7", "lon_e7"), "ref")
    got = refs.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "ref", "lat_e7", "lon_e7"))).alias("g"))
    pts = F.transform("g", lambda p: F.struct(p["lat_e7"].alias("lat_e7"), p["lon_e7"].alias("lon_e7")))
    got = got.select("id", pts.alias("pts"), F.transform("g", lambda p: p["ref"]).alias("ids"))
    empty = {"pts": "array<struct<lat_e7:int,lon_e7:int>>", "ids": "array<bigint>"}
    return ways.join(got, "id", "left").withColumns({c: F.coalesce(c, F.array().cast(kind)) for c, kind in empty.items()})


def data_cells(nodes: DataFrame) -> DataFrame:
    """Distinct zoom-8 cells that hold a node."""
    return nodes.select(x.cell_x(x.degrees_e7("lon_e7")).alias("cx"), x.cell_y(x.degrees_e7("lat_e7")).alias("cy")).distinct()


def regions_of(cells: DataFrame, zoom: int = k.REGION_ZOOM) -> DataFrame:
    """Distinct quadtree nodes at `zoom` over the cells, with their Morton key as order."""
    shift = k.GRID_ZOOM - zoom
    out = cells.select(F.shiftright("cx", shift).alias("rx"), F.shiftright("cy", shift).alias("ry")).distinct()
    return out.withColumn("region_key", x.morton("rx", "ry"))


def features_by_region(features: DataFrame, zoom: int = k.REGION_ZOOM, margin: float = k.REGION_MARGIN) -> DataFrame:
    """Features (lon_min, lat_min, lon_max, lat_max in 1e-7 degrees) with each region whose box, grown by the margin,
    may meet theirs: a range join as an exploded sequence of tiles. Exactness is left to the cutter."""
    grow = int(round(margin * 1e7))
    tile = lambda lon: x.clamped_tile(x.world_x(lon, zoom), zoom)
    row = lambda lat: x.clamped_tile(x.world_y(lat, zoom), zoom)
    deg = lambda c, d: x.degrees_e7(F.col(c).cast("long") + d)
    out = features.withColumn("rx", F.explode(F.sequence(tile(deg("lon_min", -grow)), tile(deg("lon_max", grow)))))
    return out.withColumn("ry", F.explode(F.sequence(row(deg("lat_max", grow)), row(deg("lat_min", -grow)))))


def group_tiles(parts: DataFrame) -> DataFrame:
    """One row per (level, x, y) with its features in draw order; `parts` has ord, geom, cls, attr, parts."""
    item = F.struct("ord", "geom", "cls", "attr", "parts")
    return parts.groupBy("level", "x", "y").agg(F.array_sort(F.collect_list(item)).alias("features"))


def coverage(tiles: DataFrame, cells: DataFrame, zoom: int) -> DataFrame:
    """Cells (cx, cy) with value 2 where more than half of the cell's tiles are open sea, else 1.

    `tiles` has x, y and open_sea. A cell without tiles is covered with value 1.
    """
    shift = zoom - k.GRID_ZOOM
    sea = tiles.filter("open_sea").groupBy(F.shiftright("x", shift).alias("cx"), F.shiftright("y", shift).alias("cy")).agg(F.count("*").alias("n"))
    side = 1 << shift
    return cells.join(sea, ["cx", "cy"], "left").select("cx", "cy", F.when(F.col("n") * 2 > side * side, 2).otherwise(1).alias("value"))


def fill_full_cells(tiles: DataFrame, grid: DataFrame, zoom: int) -> DataFrame:
    """The tiles to store: open sea in full cells goes, and absent tiles of full cells come as empty ones."""
    shift = zoom - k.GRID_ZOOM
    full = grid.filter(F.col("value") == 2).select("cx", "cy")
    span = lambda c: F.explode(F.sequence(F.shiftleft(F.col(c).cast("long"), shift), F.shiftleft(F.col(c).cast("long"), shift) + (1 << shift) - 1))
    every = full.withColumn("x", span("cx")).withColumn("y", span("cy"))
    empty = every.join(tiles.select("x", "y"), ["x", "y"], "left_anti").select("x", "y", F.lit(True).alias("empty"))
    inside = tiles.withColumn("cx", F.shiftright("x", shift)).withColumn("cy", F.shiftright("y", shift)).join(full.withColumn("full", F.lit(True)), ["cx", "cy"], "left")
    kept = inside.filter(~(F.col("open_sea") & F.coalesce("full", F.lit(False)))).select("x", "y", F.lit(False).alias("empty"))
    return kept.unionByName(empty)


def distinct_blobs(tiles: DataFrame) -> DataFrame:
    """Per level each blob once, with the first key that has it and its number of tiles; empty blobs are none."""
    return tiles.filter(F.length("blob") > 0).groupBy("level", "blob").agg(F.min("key").alias("first_key"), F.count("*").alias("tiles"))


def blob_offsets(blobs: DataFrame, chunk: int = 1 << 12) -> DataFrame:
    """`blobs` with `offset`, the running sum of lengths before them in order of first_key, per level.

    Sums are taken within ranges of keys, and each range starts after those before it: no level is summed in one task.
    """
    part = F.floor(F.col("first_key") / F.lit(chunk))
    rows = blobs.withColumns({"len": F.length("blob").cast("long"), "_part": part})
    before = Window.partitionBy("level").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("level", "_part").agg(F.sum("len").alias("_n")).withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = Window.partitionBy("level", "_part").orderBy("first_key").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("_at", F.coalesce(F.sum("len").over(within), F.lit(0))).join(parts, ["level", "_part"]).withColumn("offset", F.col("_start") + F.col("_at")).drop("_part", "_start", "_at")


def page_leaders(entries: DataFrame, chunk: int = 1 << 16) -> DataFrame:
    """The key of every 256th entry per level, by key. Entries are numbered within ranges of keys, and each range starts
    after those before it: no level is numbered in one task."""
    rows = entries.select("level", "key", F.floor(F.col("key") / F.lit(chunk)).alias("_part"))
    before = Window.partitionBy("level").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("level", "_part").agg(F.count("*").alias("_n")).withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = F.row_number().over(Window.partitionBy("level", "_part").orderBy("key"))
    out = rows.withColumn("_r", within - 1).join(parts, ["level", "_part"]).withColumn("_r", F.col("_start") + F.col("_r"))
    return out.filter(F.col("_r") % k.PAGE_ENTRIES == 0).select("level", F.expr(f"_r div {k.PAGE_ENTRIES}").alias("page"), "key")


def pack_files(sizes: DataFrame, most: int = k.MOST_PACK_BYTES) -> DataFrame:
    """`sizes` (region_key, bytes) with `file`, from 0: regions in key order, a new file where the next would exceed
    `most`. Regions are few (at most 4**zoom), and the fold is one aggregate over their sorted list."""
    rows = sizes.agg(F.array_sort(F.collect_list(F.struct("region_key", "bytes"))).alias("all"))
    none = F.array().cast("array<struct<region_key:bigint,bytes:bigint,file:int>>")

    def put(acc: Column, r: Column) -> Column:
        new = (acc["used"] > 0) & (acc["used"] + r["bytes"] > most)
        file = acc["file"] + F.when(new, 1).otherwise(0)
        item = F.struct(r["region_key"].cast("long").alias("region_key"), r["bytes"].cast("long").alias("bytes"), file.alias("file"))
        return F.struct(file.alias("file"), (F.when(new, F.lit(0).cast("long")).otherwise(acc["used"]) + r["bytes"]).cast("long").alias("used"), F.concat(acc["out"], F.array(item)).alias("out"))

    start = F.struct(F.lit(0).alias("file"), F.lit(0).cast("long").alias("used"), none.alias("out"))
    return rows.select(F.explode(F.aggregate("all", start, put, lambda a: a["out"])).alias("r")).select("r.*")


def number_records(rows: DataFrame, part: Column | None = None) -> DataFrame:
    """Distinct `record`s with `attr`, their index by first appearance (`ord`). Where they are those of one file, its
    header, of 16 MiB at most, holds them all, and one task numbers them. For more, `part` is a range that `ord` lies in:
    they are numbered within it, and each range starts after those before it."""
    first = rows.groupBy("record").agg(F.min("ord").alias("ord"))
    if part is None:
        return first.withColumn("attr", F.row_number().over(Window.orderBy("ord")) - 1)
    first, before = first.withColumn("_part", part), Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = first.groupBy("_part").agg(F.count("*").alias("_n")).withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = F.row_number().over(Window.partitionBy("_part").orderBy("ord"))
    return first.withColumn("_at", within - 1).join(parts, "_part").select("record", "ord", (F.col("_start") + F.col("_at")).cast("int").alias("attr"))


def grid_histogram(grid: DataFrame) -> DataFrame:
    """Cells for each value 0 to 3; cells that are not listed count as 0."""
    counts = grid.groupBy("value").agg(F.count("*").alias("n"))
    total = grid.agg(F.count("*").alias("total"))
    values = grid.sparkSession.range(4).select(F.col("id").cast("int").alias("value"))
    out = values.join(counts, "value", "left").crossJoin(F.broadcast(total))
    rest = F.when(F.col("value") == 0, F.lit(k.GRID_SIDE**2) - F.col("total")).otherwise(0)
    return out.select("value", (F.coalesce("n", F.lit(0)) + rest).cast("long").alias("cells"))
