"""Sources and pipelines end to end on small made inputs."""

import json
import os

import fixtures as made
import numpy as np
import pytest
from pyspark.sql import functions as F

from terrapack.functions import codec, geometry
from terrapack.functions import exprs as x
from terrapack.operators import relational as r
from terrapack.operators import tiles as tiles_
from terrapack.plans import fetching, packs
from terrapack.sources import geojson, pbf, shapefile, tilepack


def write(folder, name, raw) -> str:
    path = os.path.join(str(folder), name)
    with open(path, "wb") as f:
        f.write(raw)
    return path


def ring_nodes(first, lat, lon, size):
    """Four corner nodes (1e-7 degrees) of a square."""
    e = lambda v: round(v * 1e7)
    return [(first, e(lat), e(lon)), (first + 1, e(lat), e(lon + size)), (first + 2, e(lat + size), e(lon + size)), (first + 3, e(lat + size), e(lon))]


@pytest.fixture(scope="module")
def extract(tmp_path_factory):
    nodes = ring_nodes(1, 44.50, -63.50, 0.01) + ring_nodes(11, 44.60, -63.60, 0.0005) + ring_nodes(21, 44.40, -63.40, 0.05) + ring_nodes(31, 44.41, -63.39, 0.01) + ring_nodes(41, 44.00, -63.00, 0.01)
    lake = {"natural": "water"}
    ways = [
        (100, lake, [1, 2, 3, 4, 1]), (101, lake, [11, 12, 13, 14, 11]), (102, {}, [21, 22, 23]), (103, {}, [21, 24, 23]), (104, {}, [31, 32, 33, 34, 31]), (105, {}, [41, 42, 43, 44, 41]),
        (106, {"waterway": "river"}, [1, 99, 3]), (107, lake | {"intermittent": "yes"}, [1, 2, 3, 4, 1]), (108, {"waterway": "canal"} | lake, [21, 22, 23, 24, 21]), (109, {"highway": "x"}, [1, 2]),
    ]
    relations = [(200, {"type": "multipolygon", "natural": "water", "water": "reservoir"}, [(1, 102, "outer"), (1, 103, "outer"), (1, 104, "inner"), (1, 105, "inner"), (0, 1, "label"), (1, 999, "outer")])]
    return write(tmp_path_factory.mktemp("pbf"), "small.osm.pbf", made.extract(nodes, ways, relations))


def test_extract_source(spark, extract):
    pbf.register(spark)
    load = lambda e: spark.read.format("osm_pbf").option("element", e).load(extract)
    assert load("header").first() == (1_700_000_000, "writer", "here")
    assert load("node").count() == 20 and load("node").filter("id = 3").select("lat_e7", "lon_e7").first() == (445_100_000, -634_900_000)
    ways = {w.id: w for w in load("way").collect()}
    assert ways[106].refs == [1, 99, 3] and ways[108].tags == {"waterway": "canal", "natural": "water"}
    assert [tuple(m) for m in load("relation").first().members][:2] == [(1, 102, "outer"), (1, 103, "outer")]


def test_utc_text_of_far_years(spark):
    got = spark.createDataFrame([(253402300799,), (253402300800,), (777600000000,), (0,)], "s long").select(x.utc_text("s")).collect()
    assert [q[0] for q in got] == ["9999-12-31T23:59:59Z", "10000-01-01T00:00:00Z", "26611-03-02T00:00:00Z", "1970-01-01T00:00:00Z"]


def test_unknown_compression_is_refused():
    with pytest.raises(ValueError, match="compression"):
        pbf.payload(made.field(4, b"x"))


def test_water_features(spark, extract):
    found = packs.collect_water(spark, extract)
    got = {(f.ord.rank, f.cls, len(f.rings)) for f in found["features"].collect()}
    assert got == {(1, 2, 1), (2, 3, 2), (3, 16, 1), (3, 17, 1)}
    assert found["features"].filter("ord.rank = 1").count() == 2  # the lake, and the canal that is an area as well
    assert found["stats"].first().asDict() == {"sea": 0, "small": 1, "unclosed": 0, "orphan_holes": 1}
    assert found["features"].filter("geom = 2 and cls = 16").first().rings[0].lat == pytest.approx([44.5, 44.51])


def test_way_areas_of_a_batch_and_ways_joined_once(spark, extract):
    p = lambda *at: [{"lat_e7": a * 100_000 + 450_000_000, "lon_e7": b * 100_000} for a, b in at]
    square = p((0, 0), (0, 1), (1, 1), (1, 0), (0, 0))
    rows = [
        (0, 0, 2, [1, 2, 3, 4, 1], [1, 2, 3, 4, 1], square), (0, 1, 2, [1, 2, 3, 4, 1], [], []), (0, 2, 3, [1, 2, 3, 4, 1], [2, 3, 4], square[1:4]),
        (0, 3, 2, [1, 2, 3, 1], [1, 2, 1], square[:2] + square[:1]), (0, 4, 4, [1, 2, 3, 1], [1, 2, 3, 1], [{"lat_e7": q["lat_e7"], "lon_e7": q["lon_e7"] // 1000} for q in square[:3] + square[:1]]),
    ]
    found = spark.createDataFrame(rows, "blob_ix int, elem_ix int, cls int, refs array<long>, ids array<long>, pts array<struct<lat_e7:int,lon_e7:int>>").coalesce(1)
    got = {q.elem_ix: q for q in packs.way_areas(found).collect()}
    assert sorted(got) == [0, 2, 4] and [got[n].small for n in (0, 2, 4)] == [False, False, True] and [got[n].cls for n in (0, 2, 4)] == [2, 3, 4]
    assert [len(q["lon"]) for n in (0, 2, 4) for q in got[n].rings] == [4, 3] and got[2].rings[0].lat == pytest.approx([45.0, 45.01, 45.01]) and got[2].rings[0].outer
    plan = packs.collect_water(spark, extract)["features"]._jdf.queryExecution().withCachedData().toString()
    assert plan.count("InMemoryRelation") >= 3 and "osm_pbf" not in plan.split("InMemoryRelation")[0]


def test_water_pack(spark, extract, tmp_path):
    found = packs.collect_water(spark, extract)
    features, cells = found["features"].persist(), found["cells"].persist()
    whole = dict(packs.build_water(spark, extract, features=features, cells=cells))
    assert list(whole) == ["water.pmt"]
    one = codec.LayerFile(whole["water.pmt"])
    assert one.kind == 2 and all(v.count for v in one.levels) and one.warnings() == []
    pack = packs.plan_water(spark, extract, features=features, cells=cells, region_zoom=8, most=1)
    listed = {q["name"]: (q["bytes"], q["sha256"]) for q in packs.write_water(pack, str(tmp_path)).collect()}
    split = {n: (tmp_path / n).read_bytes() for n in pack.names}
    assert listed == {n: (len(raw), tiles_.digest(raw)) for n, raw in split.items()} and sorted(os.listdir(tmp_path)) == sorted(split)
    assert len(split) > 1 and list(split)[0] == "water-01.pmt"
    tiles = {}
    for raw in split.values():
        f = codec.LayerFile(raw)
        for n, v in enumerate(f.levels):
            tiles |= {(n, e[0]): f.tile_bytes(n, e) for e in v.index.tolist()}
    assert tiles == {(n, e[0]): one.tile_bytes(n, e) for n, v in enumerate(one.levels) for e in v.index.tolist()}


def test_sea_makes_full_cells(spark, extract, tmp_path):
    far = (5, [made.square(10, 10)])
    sea = write(tmp_path, "sea.zip", made.shapefile([(5, [made.square(-64.5, 44, 2.0)]), far, (0, [])]))
    cells = spark.createDataFrame([(82, 91)], "cx long, cy long")
    assert shapefile.sea_rings(spark, sea, cells).count() == 1
    features = packs.collect_water(spark, extract, sea)["features"]
    assert features.filter("ord.rank = 0").first().cls == 1
    tiles, grids = packs.water_tiles(features.filter("ord.rank = 0"), packs.collect_water(spark, extract)["cells"])
    assert {v.value for v in grids[2].collect()} <= {1, 2}
    assert tiles.count() >= 1


def test_estimate_takes_lines_together_and_reads_ways_once(spark, extract):
    rng = np.random.default_rng(3)
    size = np.array([1, 2, 7, 40, 0, 3])
    lat, lon = rng.uniform(20, 60, size.sum()), rng.uniform(-120, -60, size.sum())
    ends = np.cumsum(size)
    for units in (1024, 65_536):
        got = packs.encoded_sizes(lat, lon, size, units).tolist()
        for n, z in enumerate(ends.tolist()):
            p = np.floor(geometry.project(lon[z - size[n] : z], lat[z - size[n] : z], 12) * units).astype(np.int64)
            steps = np.diff(np.concatenate([[[0, 0]], p]), axis=0).ravel().tolist()
            assert got[n] == sum(len(made.signed(v)) for v in steps) + 3
    plan = packs.estimate(spark, extract)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("InMemoryRelation") >= 2


def test_estimate(spark, extract):
    got = {e.category: e for e in packs.estimate(spark, extract).collect()}
    assert set(got) == {"area", "line", "member"} and got["line"].missing == 1 and got["line"].ways == 1
    assert got["area"].ways == 3 and got["area"].dropped_small == 1 and got["area"].bytes_3 > 0


def test_coverage_rule(spark):
    tiles = [(x, y, True) for x in range(40, 44) for y in range(80, 83)] + [(40, 83, False), (41, 83, False), (44, 80, False)]
    df = spark.createDataFrame(tiles, "x long, y long, open_sea boolean")
    cells = spark.createDataFrame([(10, 20), (11, 20)], "cx long, cy long")
    grid = r.coverage(df, cells, 10)
    assert {(g.cx, g.cy): g.value for g in grid.collect()} == {(10, 20): 2, (11, 20): 1}
    assert {(q.x, q.y, q.empty) for q in r.fill_full_cells(df, grid, 10).collect()} == {(40, 83, False), (41, 83, False), (44, 80, False), (42, 83, True), (43, 83, True)}


def test_shapefiles(spark, tmp_path):
    raw = made.shapefile([(5, [made.square(0, 0), made.square(0.02, 0.02, 0.02, False)]), (0, []), (3, [[(1, 1), (2, 2)]])], [("min_zoom", 6), ("name", 8)], [(6, "a"), None, (3, "c")])
    path = write(tmp_path, "one.zip", raw)
    got = shapefile.read_shapes(spark, path).orderBy("rec_ix").collect()
    assert [(s.shape_type, len(s.parts)) for s in got] == [(5, 2), (0, 0), (3, 1)] and got[0].attrs == {"min_zoom": "6", "name": "a"}
    assert [q["outer"] for q in shapefile.rings_of([p.asDict() for p in got[0].parts])] == [True, False]
    key = lambda q: (q.rec_ix, q.shape_type, q.attrs, [(list(p.lon), list(p.lat)) for p in q.parts])
    for tasks in (1, 2, 5):
        assert [key(q) for q in shapefile.stream_shapes(spark, path, tasks=tasks).orderBy("rec_ix").collect()] == [key(q) for q in got]
        near = shapefile.stream_shapes(spark, path, None, (0.5, 0.5, 3, 3), tasks).collect()
        assert [(q.rec_ix, q.attrs) for q in near] == [(2, None)]
    with pytest.raises(ValueError, match="fewer rows"):
        list(shapefile.decode(made.shapefile([(0, []), (0, [])], [("a", 2)], [("x",)])))


def test_overview(spark, tmp_path):
    box = [(-120, 30), (-120, 60), (-80, 60), (-80, 30), (-120, 30)]
    hole = made.square(-100, 40, 2, False)
    sources = (("land", 1, True), ("lake", 2, True), ("river", 3, False), ("absent", 1, True))
    write(tmp_path, "land.zip", made.shapefile([(5, [box, hole]), (5, [made.square(10, 45, 5)])], [("min_zoom", 6)], [("0",), ("0",)]))
    write(tmp_path, "lake.zip", made.shapefile([(5, [made.square(-100, 50, 3)])], [("min_zoom", 6)], [("6",)]))
    write(tmp_path, "river.zip", made.shapefile([(3, [[(-110, 35), (-90, 55)]])], [("min_zoom", 6)], [("3",)]))
    f = codec.LayerFile(packs.build_overview(spark, str(tmp_path), 1, 1_700_000_000, sources))
    classes = [{feature[1] for e in v.index.tolist() for feature in f.tile(n, e)} for n, v in enumerate(f.levels)]
    assert classes[0] == {1, 3} and classes[1] == classes[2] == {1, 2, 3}
    assert all(codec.tile_place(e[0])[0] < 1 << (v.tile_zoom - 1) for v in f.levels for e in v.index.tolist())


def test_zones(spark, tmp_path):
    poly = {"type": "Polygon", "coordinates": [[[-82, 27], [-82, 27.05], [-81.95, 27.05], [-81.95, 27], [-82, 27]]]}
    doc = lambda props: json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": p, "geometry": poly} for p in props]}).encode()
    boating = write(tmp_path, "b.json", doc([{"RESTRICTION": "Idle Speed No Wake", "AREA_NAME": " Pass "}, {"RESTRICTION": "Max Speed 25 MPH (Conditional)", "RULE_NUM": "68D-24.1"}, {"RESTRICTION": "No Anchoring"}]))
    manatee = write(tmp_path, "m.json", doc([{"CLASS1_68C": "IS", "DATE1_68C": "NOV 15 - MAR 31", "CLASS2_68C": "SS", "DATE2_68C": "APR 1 - NOV 14", "COUNTY": "LEE"}, {"CLASS1_68C": "UN"}]))
    raw, skipped = packs.build_zones(geojson.read_features(spark, boating), geojson.read_features(spark, manatee), "2026-09", 1, 2)
    f = codec.LayerFile(raw)
    assert [tuple(s) for s in skipped.collect()] == [("No Anchoring", 1)]
    features = [q for e in f.levels[1].index.tolist() for q in f.tile(1, e)]
    records = [dict(codec.decode_record(q)) for q in f.records]
    assert sorted(q[1] for q in features[:4]) == [1, 1, 2, 3]
    assert records[0][1].decode() == "IDLE SPEED NO WAKE · Pass" and records[1][6].decode() == "FAC 68D-24.1" and codec.read_varints(records[1][2]) == [402]
    assert records[2][1].decode() == "MANATEE ZONE · IDLE SPEED · LEE COUNTY" and codec.read_varints(records[2][3]) == [0b110000000111] and codec.read_varints(records[2][5]) == [2]
    assert f.coverage(0, *np.floor(geometry.project(np.array([-82]), np.array([27]), 10)[0]).astype(int).tolist()) == 1


def test_multipolygons(spark, tmp_path):
    ring = [[0, 0], [0, 1], [1, 1], [0, 0]]
    doc = {"features": [{"properties": {}, "geometry": {"type": "MultiPolygon", "coordinates": [[ring, ring], [[[0, 0], [1, 1]], ring]]}}, {"properties": {}, "geometry": None}]}
    got = geojson.read_features(spark, write(tmp_path, "g.json", json.dumps(doc).encode())).select("ix", geojson.polygons().alias("p")).orderBy("ix").collect()
    assert [len(q.p) for q in got] == [1, 0] and [len(q.lon) for q in got[0].p[0]] == [3, 3] and [q.outer for q in got[0].p[0]] == [True, False]


def test_fetch_halves_and_checks(spark):
    def get(part):
        if len(part) > 2 and 7 in part:
            return "<html>busy</html>"
        return json.dumps({"features": [{"properties": {"OBJECTID": i}} for i in part]})

    ids = spark.createDataFrame([(i,) for i in range(1, 21)], "id long")
    found = geojson.fetch(spark, ids, get, 10)
    geojson.check_complete(found, ids)
    assert found.count() == 20
    with pytest.raises(ValueError, match="1 ids are missing"):
        geojson.check_complete(found.filter("id <> 3"), ids)


def test_fetched_layers_and_their_record(spark, tmp_path):

    def get(url):
        from urllib.parse import parse_qs, urlsplit

        q = {n: v[0] for n, v in parse_qs(urlsplit(url).query).items()}
        assert q["where"] == "1=1"
        if "returnIdsOnly" in q:
            return json.dumps({"objectIds": [3, 1, 2, 9]})
        ids = [int(v) for v in q["objectIds"].split(",")]
        return "busy" if len(ids) > 2 else json.dumps({"features": [{"id": i, "properties": {"OBJECTID": i}, "geometry": None} for i in ids]})

    counts = fetching.fetch_all(spark, str(tmp_path), get, "http://x/rest", {"a": "L/1"}, 100, 0)
    assert counts == {"a.geojson": 4}
    with open(tmp_path / "a.geojson") as f:
        assert [q["id"] for q in json.load(f)["features"]] == [1, 2, 3, 9]
    with open(tmp_path / "SOURCES.fwc.json") as f:
        record = json.load(f)
    assert record["retrieved_utc"] == "1970-01-01T00:00:00Z" and record["files"]["a.geojson"]["features"] == 4


def test_store_is_kept_and_reused(spark, extract, tmp_path):
    assert packs.open_store(spark, f"{tmp_path}/store") is None
    found = packs.collect_water(spark, extract)
    packs.keep_store(found, f"{tmp_path}/store")
    kept = packs.open_store(spark, f"{tmp_path}/store")
    built = lambda q: dict(packs.build_water(spark, extract, features=q["features"], cells=q["cells"]))
    assert built(kept) == built(found)
    assert packs.pack_name("/a/nova-scotia-latest.osm.pbf") == "nova-scotia" and packs.commit_stamp()


def test_ids_and_tags_are_pushed_down(spark, extract):
    pbf.register(spark)
    load = lambda e, **more: spark.read.format("osm_pbf").options(element=e, **more).load(extract)
    assert load("node").filter("id > 10 and id <= 14 and id <> 12").count() == 3
    assert {w.id for w in load("way", any_tag="waterway=river,landuse=x").collect()} == {106}
    assert {w.id for w in load("way").filter("id in (100, 109)").collect()} == {100, 109}
    assert load("relation", any_tag="natural=wood").count() == 0


def test_ways_without_nodes_still_close_rings(spark, tmp_path):
    """A ring of three ways of which one has no node in the extract: what is left of it has three points."""
    nodes = ring_nodes(1, 44.50, -63.50, 0.05)
    ways = [(1, {}, [1, 2, 3]), (2, {}, [3, 4, 9]), (3, {}, [9, 8]), (4, {}, [8, 1])]
    lost = [(1, {}, [1, 2, 3, 4, 9]), (3, {}, [9, 8]), (4, {}, [8, 1])]
    for n, some in enumerate((ways, lost)):
        raw = made.extract(nodes, some, [(200, {"type": "multipolygon", "natural": "water"}, [(1, w[0], "outer") for w in some])])
        found = packs.collect_water(spark, write(tmp_path, f"{n}.osm.pbf", raw))
        assert found["stats"].first().unclosed == 0
        assert [len(f.rings[0].lon) for f in found["features"].collect()] == [4]


def test_tilepack_source_and_crop(spark, tmp_path):
    tilepack.register(spark)
    tiles = [(codec.tile_key(px, py), codec.encode_tile([(1, 1, 0, [[(0, 0), (9 + px % 7, 0), (0, 9)]])], 12, 32)) for px in range(1000, 1020) for py in range(1500, 1515)]
    layer = codec.Layer(3, [codec.LevelSpec(12, 12, 13, 12, 32, 10, tiles, 1, {(62, 93): 1, (63, 94): 2})], ["a", "b"], {"layer": 0}, [codec.encode_record([(1, "n")])], 3, 4)
    path = write(tmp_path, "a.pmt", codec.write_layer(layer))
    part = lambda p: spark.read.format("tilepack").option("part", p).load(path)
    assert part("tiles").filter("error is null").count() == 300 and part("header").first().warnings == []
    assert part("records").first().value == b"n" and part("grid").count() == 2 and part("strings").first().fields == ["layer"]
    assert tuple(packs.check(spark, path).first()) == (1, 300, 0, None)
    lon, lat = geometry.unproject(np.array([[1003.5, 1504.5], [1006.5, 1502.5]]), 12)
    f = codec.LayerFile(packs.crop_file(spark, path, (float(lat[0]), float(lon[0]), float(lat[1]), float(lon[1]))))
    assert {codec.tile_place(e[0]) for e in f.levels[0].index.tolist()} == {(a, b) for a in range(1003, 1007) for b in range(1502, 1505)}
    assert f.build_time == 3 and f.strings == [b"a", b"b"]


def test_rules(spark):
    cases = {"NOV 15 - MAR 31": (0b110000000111, True), "APR 1 - NOV 14": (0b11111111000, True), "JAN 1 - FEB 28": (0b11, False), "dec - feb": (0b100000000011, False), "NOV 15 - NOV 1": (1 << 10, True), "all year": (0xFFF, True), None: (0xFFF, True)}
    df = spark.createDataFrame([(c,) for c in cases], "s string").select("s", x.season("s").alias("r"))
    assert {q.s: (q.r.months, q.r.partial) for q in df.collect()} == cases
    codes = {"ISAY": (1, 0, 0), "SSAY_25CH": (2, 0, 1), "35 DY/25 N": (3, 563, 2), "30 MPH": (3, 483, 0), "MPAY": (4, 0, 0), "QQ": (5, 0, 2), "UN": None, None: None}
    got = spark.createDataFrame([(c,) for c in codes], "c string").select("c", x.manatee_rule("c").alias("r")).collect()
    assert {q.c: q.r and (q.r.cls, q.r.speed, q.r.flags) for q in got} == codes


def test_sidecars(tmp_path):
    write(tmp_path, "b", b"2")
    write(tmp_path, "a", b"1")
    assert [q.split("  ")[1] for q in packs.manifest(str(tmp_path)).splitlines()] == ["a", "b"]
    assert json.loads(packs.sources_json("x", [], {"a": (1, "0")}, 0))["built_utc"] == "1970-01-01T00:00:00Z"


def test_packing_and_offsets(spark):
    sizes = spark.createDataFrame([(k, s) for k, s in enumerate((5, 6, 4, 20, 1))], "region_key long, bytes long")
    assert [q.file for q in r.pack_files(sizes, 10).orderBy("region_key").collect()] == [0, 1, 1, 2, 3]
    blobs = spark.createDataFrame([(0, k, b"x" * (k % 4 + 1)) for k in range(50)], "level int, key long, blob binary")
    got = {q.first_key: (q["len"], q.offset) for q in r.blob_offsets(r.distinct_blobs(blobs), 2).collect()}
    assert got == {0: (1, 0), 1: (2, 1), 2: (3, 3), 3: (4, 6)} and F.lit(1) is not None


def test_water_coverage_follows_the_table(spark, monkeypatch):
    from terrapack.plans import geometry_queries as g

    small = "/root/testdata/sf0.001"
    asked, synthetic = [], g.packs.synthetic
    monkeypatch.setattr(g.packs, "synthetic", lambda *a: asked.append(a[-1]) or synthetic(*a))
    assert g.q_water_coverage(spark, small).count() > 0
    assert asked == [spark.read.parquet(f"{small}/supplier.parquet").count()]
