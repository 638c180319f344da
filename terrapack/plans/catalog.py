"""The library's queries over the given tables, and the SQL that each equals.

The tables hold no geometry, so each query derives some from keys by whole-number arithmetic: points from customers,
rectangles from orders, ways from line items.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import constants as k
from ..functions import exprs as x
from ..operators import relational as r

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# ---- carriers ----

POINTS = "SELECT c_custkey AS id, (c_custkey * 7919 % 120000) * 10000 - 1700000000 AS lon_e7, (c_custkey * 104729 % 60000) * 10000 + 150000000 AS lat_e7 FROM customer"
WX = "((1e-9::DOUBLE * (lon_e7 * 100)) + 180.0::DOUBLE) / 360.0::DOUBLE * {n}::DOUBLE"
_S = "sin(radians(least(greatest(1e-9::DOUBLE * (lat_e7 * 100), -{m}::DOUBLE), {m}::DOUBLE)))"
WY = f"(0.5::DOUBLE - ln((1 + {_S}) / (1 - {_S})) / 12.566370614359172::DOUBLE) * {{n}}::DOUBLE"


def sql_x(bits: int) -> str:
    return WX.format(n=1 << bits)


def sql_y(bits: int, most: float = k.MAX_LATITUDE) -> str:
    return WY.format(n=1 << bits, m=most)


def sql_morton(a: str = "x", b: str = "y") -> str:
    bit = lambda v, n: f"(({v} >> {n}) & 1)"
    return "(" + " + ".join(f"{bit(a, n)} * {1 << 2 * n}::BIGINT + {bit(b, n)} * {2 << 2 * n}::BIGINT" for n in range(16)) + ")"


def sql_varint(v: str) -> str:
    return f"(CASE {' '.join(f'WHEN {v} < {1 << 7 * n}::BIGINT THEN {n}' for n in range(1, 9))} ELSE 9 END)::INTEGER"


def sql_zigzag(v: str) -> str:
    return f"(CASE WHEN {v} >= 0 THEN 2 * {v} ELSE -2 * {v} - 1 END)"


def points(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("c_custkey")
    return read(spark, d, "customer").select(c.alias("id"), ((c * 7919) % 120000 * 10000 - 1700000000).alias("lon_e7"), ((c * 104729) % 60000 * 10000 + 150000000).alias("lat_e7"))


def world(df: DataFrame, bits: int) -> DataFrame:
    return df.withColumns({"wx": x.world_x(x.degrees_e7("lon_e7"), bits), "wy": x.world_y(x.degrees_e7("lat_e7"), bits)})


RECTS = """SELECT o_orderkey AS id, (o_orderkey * 7919 % 1000000 + 1000000)::BIGINT AS x0, (o_orderkey * 104729 % 1000000 + 1000000)::BIGINT AS y0,
  (floor(o_totalprice)::BIGINT % 9000 + 1)::BIGINT AS w, (o_orderkey % 7000 + 1)::BIGINT AS h FROM orders"""


def rectangles(spark: SparkSession, d: str) -> DataFrame:
    o = F.col("o_orderkey")
    return read(spark, d, "orders").select(
        o.alias("id"), (o * 7919 % 1000000 + 1000000).alias("x0"), (o * 104729 % 1000000 + 1000000).alias("y0"),
        (F.floor("o_totalprice").cast("long") % 9000 + 1).alias("w"), (o % 7000 + 1).alias("h"),
    )


# ---- projection, keys, codes ----


@query(f"""WITH p AS ({POINTS}), t AS (SELECT id, floor({sql_x(22)})::BIGINT AS wx, floor({sql_y(22)})::BIGINT AS wy FROM p),
u AS (SELECT id, wx >> 12 AS x, wy >> 12 AS y, wx & 4095 AS lx, wy & 4095 AS ly FROM t),
v AS (SELECT x, y, lx - coalesce(lag(lx) OVER w, 0) AS dx, ly - coalesce(lag(ly) OVER w, 0) AS dy FROM u WINDOW w AS (PARTITION BY x, y ORDER BY id))
SELECT {sql_morton()} AS tile_key, x, y, count(*) AS features, sum({sql_varint(sql_zigzag('dx'))} + {sql_varint(sql_zigzag('dy'))})::BIGINT AS bytes FROM v GROUP BY x, y""")
def q_tile_bytes(spark, d):
    p = world(points(spark, d), 22).select("id", F.floor("wx").alias("wx"), F.floor("wy").alias("wy"))
    p = p.select("id", F.shiftright("wx", 12).alias("x"), F.shiftright("wy", 12).alias("y"), F.expr("wx & 4095").alias("lx"), F.expr("wy & 4095").alias("ly"))
    w = Window.partitionBy("x", "y").orderBy("id")
    size = lambda c: x.varint_bytes(x.zigzag(F.col(c) - F.lag(c, 1, 0).over(w)))
    return p.withColumn("n", size("lx") + size("ly")).groupBy("x", "y").agg(F.count("*").alias("features"), F.sum("n").alias("bytes")).withColumn("tile_key", x.morton("x", "y"))


@query(f"WITH p AS ({POINTS}) SELECT id, floor({sql_x(10)})::BIGINT AS x, floor({sql_y(10)})::BIGINT AS y FROM p")
def q_tile_of_point(spark, d):
    return world(points(spark, d), 10).select("id", F.floor("wx").alias("x"), F.floor("wy").alias("y"))


@query(f"WITH p AS ({POINTS}) SELECT DISTINCT least(greatest(trunc({sql_x(8)})::BIGINT, 0), 255) AS cx, least(greatest(trunc({sql_y(8, 85.0511)})::BIGINT, 0), 255) AS cy FROM p")
def q_cells(spark, d):
    return r.data_cells(points(spark, d))


@query(f"WITH p AS ({POINTS}), t AS (SELECT id, floor({sql_x(16)})::BIGINT AS x, floor({sql_y(16)})::BIGINT AS y FROM p) SELECT id, {sql_morton()} AS tile_key FROM t")
def q_morton(spark, d):
    return world(points(spark, d), 16).select("id", x.morton(F.floor("wx"), F.floor("wy")).alias("tile_key"))


@query(f"WITH p AS ({POINTS}) SELECT id, floor({sql_x(16)})::BIGINT AS x, floor({sql_y(16)})::BIGINT AS y FROM p")
def q_unmorton(spark, d):
    keys = q_morton(spark, d)
    return keys.select("id", x.unmorton_x("tile_key").alias("x"), x.unmorton_y("tile_key").alias("y"))


_LINES = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


@query(f"""WITH t AS (SELECT l_orderkey, l_partkey, l_partkey - coalesce(lag(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY {_LINES}), 0) AS delta FROM lineitem)
SELECT l_orderkey, l_partkey, {sql_zigzag('delta')} AS code, {sql_varint(sql_zigzag('delta'))} AS bytes FROM t""")
def q_zigzag_varint(spark, d):
    w = Window.partitionBy("l_orderkey").orderBy(*_LINES.split(", "))
    code = x.zigzag(F.col("l_partkey") - F.lag("l_partkey", 1, 0).over(w))
    return read(spark, d, "lineitem").select("l_orderkey", "l_partkey", code.alias("code")).withColumn("bytes", x.varint_bytes("code"))


@query(f"WITH t AS (SELECT l_orderkey, l_partkey - l_suppkey AS v FROM lineitem) SELECT l_orderkey, v FROM t")
def q_unzigzag(spark, d):
    return read(spark, d, "lineitem").select("l_orderkey", x.unzigzag(x.zigzag(F.col("l_partkey") - F.col("l_suppkey"))).alias("v"))


@query("SELECT o_orderkey, (o_orderkey * 37 - 500000) AS nano, (floor((o_orderkey * 37 - 500000) / 100.0) + CASE WHEN ((o_orderkey * 37 - 500000) % 100 + 100) % 100 >= 50 THEN 1 ELSE 0 END)::INTEGER AS e7 FROM orders")
def q_node_rounding(spark, d):
    nano = F.col("o_orderkey") * 37 - 500000
    return read(spark, d, "orders").select("o_orderkey", nano.alias("nano"), x.e7(nano).alias("e7"))


@query("SELECT o_orderkey, (((o_orderkey + 4095) // 4096) * 4096)::BIGINT AS aligned FROM orders")
def q_align(spark, d):
    return read(spark, d, "orders").select("o_orderkey", x.aligned("o_orderkey").alias("aligned"))


@query(f"""WITH p AS ({POINTS}), t AS (SELECT id, {sql_x(22)} AS wx, {sql_y(22)} AS wy FROM p)
SELECT id, round(wx / 4194304.0::DOUBLE * 360.0::DOUBLE - 180.0::DOUBLE, 6) AS lon, round(degrees(atan(sinh(pi() * (1 - 2 * wy / 4194304.0::DOUBLE)))), 6) AS lat FROM t""".replace("sinh(pi() * (1 - 2 * wy / 4194304.0::DOUBLE))", "((exp(pi() * (1 - 2 * wy / 4194304.0::DOUBLE)) - exp(-pi() * (1 - 2 * wy / 4194304.0::DOUBLE))) / 2)"))
def q_inverse_projection(spark, d):
    p = world(points(spark, d), 22)
    return p.select("id", F.round(x.longitude("wx", 22), 6).alias("lon"), F.round(x.latitude("wy", 22), 6).alias("lat"))


# ---- classes and rules ----

_WATER = ("lake", "reservoir", "river", "canal", "wastewater", "moat", "pond", "stream")
_KEYS = "SELECT p_partkey AS id, p_partkey % 3 AS a, p_partkey % 8 AS b, p_partkey % 5 AS c, p_partkey % 11 AS e FROM part"
_TAGS = f"""SELECT id, CASE WHEN a = 0 THEN 'water' ELSE '' END AS nat, CASE b {' '.join(f"WHEN {n} THEN '{w}'" for n, w in enumerate(_WATER))} END AS water,
 CASE c WHEN 0 THEN 'riverbank' WHEN 1 THEN 'river' WHEN 2 THEN 'canal' ELSE '' END AS waterway, CASE WHEN e = 0 THEN 'yes' ELSE '' END AS inter,
 CASE WHEN e = 1 THEN 'basin' WHEN e = 2 THEN 'reservoir' ELSE '' END AS landuse FROM ({_KEYS})"""
_AREA = """CASE WHEN inter = 'yes' OR water IN ('wastewater', 'reflecting_pool') OR landuse = 'basin' THEN NULL
 WHEN nat = 'water' THEN CASE WHEN water = 'reservoir' THEN 3 WHEN water IN ('river', 'stream', 'rapids') THEN 4 WHEN water IN ('canal', 'moat') THEN 5 ELSE 2 END
 WHEN waterway = 'riverbank' THEN 4 WHEN landuse = 'reservoir' THEN 3 END::INTEGER"""
_LINE = "CASE WHEN inter = 'yes' THEN NULL WHEN waterway = 'river' THEN 16 WHEN waterway = 'canal' THEN 17 END::INTEGER"


def tagged(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("p_partkey")
    water = F.element_at(F.array(*(F.lit(w) for w in _WATER)), (p % 8).cast("int") + 1)
    pick = lambda cond, value: F.when(cond, value).otherwise("")
    waterway = F.when(p % 5 == 0, "riverbank").when(p % 5 == 1, "river").when(p % 5 == 2, "canal").otherwise("")
    landuse = F.when(p % 11 == 1, "basin").when(p % 11 == 2, "reservoir").otherwise("")
    pairs = [F.lit("natural"), pick(p % 3 == 0, "water"), F.lit("water"), water, F.lit("waterway"), waterway, F.lit("intermittent"), pick(p % 11 == 0, "yes"), F.lit("landuse"), landuse, F.lit("type"), pick(p % 2 == 0, "multipolygon")]
    return read(spark, d, "part").select(p.alias("id"), F.create_map(*pairs).alias("tags"))


@query(f"WITH t AS ({_TAGS}) SELECT id, {_AREA} AS cls FROM t")
def q_area_class(spark, d):
    return tagged(spark, d).select("id", x.area_class("tags").alias("cls"))


@query(f"WITH t AS ({_TAGS}) SELECT id, {_LINE} AS cls FROM t")
def q_line_class(spark, d):
    return tagged(spark, d).select("id", x.line_class("tags").alias("cls"))


@query(f"WITH t AS ({_TAGS}), u AS (SELECT id, {_AREA} AS area, {_LINE} AS line FROM t) SELECT * FROM u WHERE area IS NOT NULL OR line IS NOT NULL")
def q_way_kind(spark, d):
    return tagged(spark, d).withColumn("kind", x.way_kind("tags")).filter(F.col("kind").isNotNull()).select("id", "kind.area", "kind.line")


@query(f"WITH t AS ({_TAGS}) SELECT id FROM t WHERE id % 2 = 0 AND {_AREA} IS NOT NULL")
def q_water_relation(spark, d):
    return tagged(spark, d).filter(x.is_water_relation("tags")).select("id")


_SEASONS = """SELECT c_custkey AS id, CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 13 = 1 THEN 'see rule' WHEN c_custkey % 13 = 2 THEN 'XYZ 1 - MAR 3'
 ELSE upper(m[c_custkey % 12 + 1]) || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ' ' || (c_custkey % 2 * 14 + 1)::VARCHAR END || ' - ' || lower(m[c_custkey * 7 % 12 + 1]) || CASE WHEN c_custkey % 4 = 0 THEN '' ELSE ' ' || (28 + c_custkey % 4)::VARCHAR END END AS text
 FROM customer, (SELECT ['JAN','FEB','MAR','APR','MAY','JUN','JUL','AUG','SEP','OCT','NOV','DEC'] AS m)"""


def seasons(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("c_custkey")
    month = lambda e: F.element_at(F.array(*(F.lit(m) for m in k.MONTH_NAMES)), e.cast("int") + 1)
    text = F.concat(
        month(c % 12), F.when(c % 3 == 0, "").otherwise(F.concat(F.lit(" "), (c % 2 * 14 + 1).cast("string"))), F.lit(" - "),
        F.lower(month(c * 7 % 12)), F.when(c % 4 == 0, "").otherwise(F.concat(F.lit(" "), (28 + c % 4).cast("string"))),
    )
    return read(spark, d, "customer").select(c.alias("id"), F.when(c % 13 == 0, F.lit(None)).when(c % 13 == 1, "see rule").when(c % 13 == 2, "XYZ 1 - MAR 3").otherwise(text).alias("text"))


@query(rf"""WITH s AS ({_SEASONS}), p AS (SELECT id, regexp_extract(upper(coalesce(text, '')), '^\s*([A-Z]{{3}})\s*([0-9]*)\s*-\s*([A-Z]{{3}})\s*([0-9]*)\s*$', ['a', 'b', 'c', 'd']) AS r FROM s),
n AS (SELECT id, r, list_position(['JAN','FEB','MAR','APR','MAY','JUN','JUL','AUG','SEP','OCT','NOV','DEC'], r.a) AS m0, list_position(['JAN','FEB','MAR','APR','MAY','JUN','JUL','AUG','SEP','OCT','NOV','DEC'], r.c) AS m1 FROM p),
g AS (SELECT id, r, coalesce(m0, 0) AS m0, coalesce(m1, 0) AS m1 FROM n)
SELECT id, CASE WHEN m0 > 0 AND m1 > 0 THEN list_sum(list_transform(range(0, (m1 - m0 + 12) % 12 + 1), lambda i: 1 << ((m0 - 1 + i) % 12)::INTEGER)) ELSE 4095 END::INTEGER AS months,
 CASE WHEN m0 > 0 AND m1 > 0 THEN coalesce(try_cast(r.b AS INTEGER), 1) <> 1 OR coalesce(try_cast(r.d AS INTEGER), 31) < [31,28,31,30,31,30,31,31,30,31,30,31][m1] ELSE true END AS partial FROM g""")
def q_season(spark, d):
    return seasons(spark, d).select("id", x.season("text").alias("s")).select("id", "s.months", "s.partial")


_CODES = ("", "UN", " is ", "SSAY", "SS WKND", "SSAY_25CH x", "NEAY", "MP", "25 MPH", "35 DY/25 N", "ZZ9", "30mph")
_CASES = " ".join(f"WHEN {n} THEN '{c}'" for n, c in enumerate(_CODES))
_RULE = """SELECT id, {fields} FROM t WHERE cls IS NOT NULL"""


@query(f"""WITH c AS (SELECT p_partkey AS id, upper(trim(CASE p_partkey % {len(_CODES)} {_CASES} END)) AS c FROM part), t AS (SELECT id, c,
 CASE WHEN c IN ('', 'UN') THEN NULL WHEN c LIKE 'SSAY\\_25CH%' ESCAPE '\\' OR c IN ('SS WKND', 'SS', 'SSAY') THEN 2 WHEN c IN ('IS', 'ISAY') THEN 1 WHEN c IN ('NE', 'NEAY', 'MP', 'MPAY') THEN 4 WHEN regexp_full_match(c, '[0-9]+\\s*DY\\s*/\\s*[0-9]+\\s*N|[0-9]+\\s*MPH') THEN 3 ELSE 5 END AS cls FROM c)
SELECT id, cls::INTEGER AS cls, CASE WHEN cls = 3 THEN round_even(regexp_extract(c, '^[0-9]+')::DOUBLE * 16.09344::DOUBLE, 0) ELSE 0 END::INTEGER AS speed,
 CASE WHEN c LIKE 'SSAY\\_25CH%' ESCAPE '\\' THEN 1 WHEN cls = 5 OR c LIKE '% DY%' THEN 2 ELSE 0 END::INTEGER AS flags, CASE WHEN c = 'SS WKND' THEN 96 END::INTEGER AS days,
 CASE WHEN c LIKE 'SSAY\\_25CH%' ESCAPE '\\' THEN 'SLOW SPEED (25 MPH IN CHANNEL)' WHEN c = 'SS WKND' THEN 'SLOW SPEED (WEEKENDS)' WHEN cls = 1 THEN 'IDLE SPEED' WHEN cls = 2 THEN 'SLOW SPEED' WHEN c IN ('NE', 'NEAY') THEN 'NO ENTRY' WHEN cls = 4 THEN 'MOTORBOATS PROHIBITED'
 WHEN c LIKE '% DY%' THEN regexp_extract(c, '^([0-9]+)', 1) || ' MPH DAY / ' || regexp_extract(c, '/\\s*([0-9]+)', 1) || ' NIGHT' WHEN cls = 3 THEN regexp_extract(c, '^([0-9]+)', 1) || ' MPH' ELSE c END AS name FROM t WHERE cls IS NOT NULL""")
def q_manatee(spark, d):
    code = F.element_at(F.array(*(F.lit(c) for c in _CODES)), (F.col("p_partkey") % len(_CODES)).cast("int") + 1)
    return read(spark, d, "part").select(F.col("p_partkey").alias("id"), x.manatee_rule(code).alias("r")).filter(F.col("r").isNotNull()).select("id", "r.*")


_BOATING = ("Idle Speed No Wake", "SLOW speed minimum wake", "Max Speed 25 MPH (Conditional)", "No Entry", "No Anchoring", "idle speed, conditional", "Max Speed 30mph")
_BCASES = " ".join(f"WHEN {n} THEN '{c}'" for n, c in enumerate(_BOATING))


@query(f"""WITH c AS (SELECT p_partkey AS id, lower(CASE p_partkey % {len(_BOATING)} {_BCASES} END) AS c FROM part), t AS (SELECT id, c,
 CASE WHEN c LIKE 'idle speed%' THEN 1 WHEN c LIKE 'slow speed%' THEN 2 WHEN regexp_matches(c, '^max speed [0-9]+\\s*mph') THEN 3 WHEN c LIKE 'no entry%' THEN 4 END AS cls FROM c)
SELECT id, cls::INTEGER AS cls, CASE WHEN cls = 3 THEN round_even(regexp_extract(c, '[0-9]+')::DOUBLE * 16.09344::DOUBLE, 0) ELSE 0 END::INTEGER AS speed, CASE WHEN c LIKE '%conditional%' THEN 2 ELSE 0 END::INTEGER AS flags,
 CASE cls WHEN 1 THEN 'IDLE SPEED NO WAKE' WHEN 2 THEN 'SLOW SPEED MINIMUM WAKE' WHEN 3 THEN 'MAX ' || regexp_extract(c, '[0-9]+') || ' MPH' ELSE 'NO ENTRY' END AS name FROM t WHERE cls IS NOT NULL""")
def q_boating(spark, d):
    text = F.element_at(F.array(*(F.lit(c) for c in _BOATING)), (F.col("p_partkey") % len(_BOATING)).cast("int") + 1)
    return read(spark, d, "part").select(F.col("p_partkey").alias("id"), x.boating_rule(text).alias("r")).filter(F.col("r").isNotNull()).select("id", "r.cls", "r.speed", "r.flags", "r.name")


@query(f"WITH t AS (SELECT p_partkey AS id, p_partkey % {len(_BOATING)} AS n FROM part) SELECT CASE n {_BCASES} END AS restriction, count(*) AS n FROM t WHERE n = 4 GROUP BY 1")
def q_skipped_rules(spark, d):
    text = F.element_at(F.array(*(F.lit(c) for c in _BOATING)), (F.col("p_partkey") % len(_BOATING)).cast("int") + 1)
    rows = read(spark, d, "part").select(text.alias("restriction"))
    return rows.filter(x.boating_rule("restriction").isNull()).groupBy("restriction").agg(F.count("*").alias("n"))


@query("SELECT p_partkey AS id, round_even((p_size * 16.09344::DOUBLE), 0)::INTEGER AS speed FROM part")
def q_speed(spark, d):
    return read(spark, d, "part").select(F.col("p_partkey").alias("id"), x.speed("p_size").alias("speed"))


# ---- joins by id ----


def ways(spark: SparkSession, d: str) -> DataFrame:
    """Orders as ways: refs are the parts of their lines in order; every fifth has a kind."""
    item = F.struct(*(F.col(c) for c in _LINES.split(", ")))
    refs = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_list(item)).alias("l"))
    return refs.select("id", F.transform("l", lambda s: s["l_partkey"]).alias("refs"))


def way_members(spark: SparkSession, d: str) -> DataFrame:
    """Customers as relations: their orders are the members; every third is a node."""
    o = read(spark, d, "orders")
    m = F.struct((F.when(F.col("o_orderkey") % 3 == 0, 0).otherwise(1)).alias("type"), F.col("o_orderkey").alias("ref"), F.lit("outer").alias("role"))
    return o.groupBy(F.col("o_custkey").alias("id")).agg(F.collect_list(m).alias("members"))


_MEMBER = "SELECT DISTINCT o_orderkey AS id FROM orders WHERE o_orderkey % 3 <> 0"


@query(f"""WITH w AS (SELECT DISTINCT l_orderkey AS id FROM lineitem), m AS ({_MEMBER})
SELECT w.id, m.id IS NOT NULL AS is_member, CASE WHEN w.id % 5 = 0 THEN 2 END::INTEGER AS kind FROM w LEFT JOIN m USING (id) WHERE m.id IS NOT NULL OR w.id % 5 = 0""")
def q_member_ways(spark, d):
    found = r.wanted_ways(ways(spark, d), F.when(F.col("id") % 5 == 0, 2), r.member_ids(way_members(spark, d)))
    return found.select("id", "is_member", "kind")


@query("SELECT DISTINCT l_partkey AS id FROM lineitem")
def q_needed_nodes(spark, d):
    return r.needed_nodes(ways(spark, d))


@query(f"""WITH n AS (SELECT p_partkey AS id, p_partkey * 1000 AS lat_e7, p_partkey * 2000 AS lon_e7 FROM part WHERE p_size > 5)
SELECT l_orderkey AS id, string_agg(lat_e7::VARCHAR || ' ' || lon_e7::VARCHAR, ',' ORDER BY {_LINES}) AS pts FROM lineitem JOIN n ON l_partkey = n.id GROUP BY 1""")
def q_ref_coords(spark, d):
    nodes = read(spark, d, "part").filter(F.col("p_size") > 5).select(F.col("p_partkey").alias("id"), (F.col("p_partkey") * 1000).alias("lat_e7"), (F.col("p_partkey") * 2000).alias("lon_e7"))
    got = r.way_points(ways(spark, d), nodes)
    return got.select("id", F.array_join(F.transform("pts", lambda p: F.concat_ws(" ", p["lat_e7"].cast("string"), p["lon_e7"].cast("string"))), ",").alias("pts"))


# ---- boxes, regions ----


@query(f"WITH b AS ({RECTS}) SELECT id FROM b WHERE x0 <= 1500000 AND x0 + w >= 1400000 AND y0 <= 1600000 AND y0 + h >= 1300000")
def q_bbox_select(spark, d):
    b = rectangles(spark, d)
    return b.filter(x.boxes_meet("y0", "x0", F.col("y0") + F.col("h"), F.col("x0") + F.col("w"), 1300000, 1400000, 1600000, 1500000)).select("id")


@query(f"""WITH p AS ({POINTS}), c AS (SELECT DISTINCT least(greatest(trunc({sql_x(8)})::BIGINT, 0), 255) AS cx, least(greatest(trunc({sql_y(8, 85.0511)})::BIGINT, 0), 255) AS cy FROM p),
g AS (SELECT DISTINCT cx >> 1 AS x, cy >> 1 AS y FROM c) SELECT x AS rx, y AS ry, {sql_morton()} AS region_key FROM g""")
def q_region_of(spark, d):
    return r.regions_of(r.data_cells(points(spark, d)))


_GROW = "SELECT id, lon_e7 - 500000 AS lon_e7, lat_e7 + 500000 AS lat_e7 FROM b"


@query(f"""WITH p AS ({POINTS}), q AS (SELECT id, lon_e7 AS a, lat_e7 AS b, lon_e7 + id % 50 * 1000000 AS c, lat_e7 + id % 20 * 1000000 AS e FROM p),
t AS (SELECT id, (SELECT least(greatest(trunc({sql_x(7)})::BIGINT, 0), 127) FROM (SELECT a - 500000 AS lon_e7)) AS x0, (SELECT least(greatest(trunc({sql_x(7)})::BIGINT, 0), 127) FROM (SELECT c + 500000 AS lon_e7)) AS x1,
 (SELECT least(greatest(trunc({sql_y(7)})::BIGINT, 0), 127) FROM (SELECT e + 500000 AS lat_e7)) AS y0, (SELECT least(greatest(trunc({sql_y(7)})::BIGINT, 0), 127) FROM (SELECT b - 500000 AS lat_e7)) AS y1 FROM q),
u AS (SELECT id, unnest(range(x0, x1 + 1)) AS rx, y0, y1 FROM t) SELECT id, rx, unnest(range(y0, y1 + 1)) AS ry FROM u""")
def q_features_x_regions(spark, d):
    p = points(spark, d)
    boxes = p.select("id", F.col("lon_e7").alias("lon_min"), F.col("lat_e7").alias("lat_min"), (F.col("lon_e7") + F.col("id") % 50 * 1000000).alias("lon_max"), (F.col("lat_e7") + F.col("id") % 20 * 1000000).alias("lat_max"))
    return r.features_by_region(boxes).select("id", "rx", "ry")


_TILES = f"SELECT id, x0 >> 12 AS tx0, y0 >> 12 AS ty0, (x0 + w) >> 12 AS tx1, (y0 + h) >> 12 AS ty1, x0, y0, x0 + w AS x1, y0 + h AS y1 FROM ({RECTS})"
_SHIFT = "(CASE " + " ".join(f"WHEN xor(tx0, tx1) < {1 << n} AND xor(ty0, ty1) < {1 << n} THEN {n}" for n in range(17)) + " END)::INTEGER"


def rect_tiles(spark: SparkSession, d: str) -> DataFrame:
    b = rectangles(spark, d).withColumns({"x1": F.col("x0") + F.col("w"), "y1": F.col("y0") + F.col("h")})
    t = {f"t{c}": F.shiftright(c, 12) for c in ("x0", "y0", "x1", "y1")}
    return b.withColumns(t).withColumn("up", x.start_shift("tx0", "ty0", "tx1", "ty1"))


@query(f"WITH t AS ({_TILES}), s AS (SELECT *, {_SHIFT} AS up FROM t) SELECT id, up, tx0 >> up AS nx, ty0 >> up AS ny FROM s")
def q_start_node(spark, d):
    return rect_tiles(spark, d).select("id", "up", F.expr("shiftright(tx0, up)").alias("nx"), F.expr("shiftright(ty0, up)").alias("ny"))


@query(f"""WITH t AS ({_TILES}), s AS (SELECT *, {_SHIFT} AS up FROM t),
g AS (SELECT *, unnest(range((x0 - 32) >> 12, ((x1 + 32) >> 12) + 1)) AS x FROM s), e AS (SELECT *, unnest(range((y0 - 32) >> 12, ((y1 + 32) >> 12) + 1)) AS y FROM g),
f AS (SELECT id, x, y, greatest(x0 - x * 4096, -32) AS ax, greatest(y0 - y * 4096, -32) AS ay, least(x1 - x * 4096, 4128) AS bx, least(y1 - y * 4096, 4128) AS by_ FROM e WHERE x >> up = tx0 >> up AND y >> up = ty0 >> up)
SELECT id, x, y, ax, ay, bx, by_ AS "by", 2 * (bx - ax) * (by_ - ay) AS area2 FROM f WHERE bx > ax AND by_ > ay""")
def q_rect_cut_tiles(spark, d):
    side, buf = 4096, 32
    span = lambda a, b: F.explode(F.sequence(F.shiftright(F.col(a) - buf, 12), F.shiftright(F.col(b) + buf, 12)))
    t = rect_tiles(spark, d).withColumn("x", span("x0", "x1")).withColumn("y", span("y0", "y1"))
    t = t.filter(F.expr("shiftright(x, up) = shiftright(tx0, up) and shiftright(y, up) = shiftright(ty0, up)"))
    low = lambda c, o: F.greatest(F.col(c) - F.col(o) * side, F.lit(-buf).cast("long"))
    high = lambda c, o: F.least(F.col(c) - F.col(o) * side, F.lit(side + buf).cast("long"))
    t = t.select("id", "x", "y", low("x0", "x").alias("ax"), low("y0", "y").alias("ay"), high("x1", "x").alias("bx"), high("y1", "y").alias("by"))
    return t.filter((F.col("bx") > F.col("ax")) & (F.col("by") > F.col("ay"))).withColumn("area2", 2 * (F.col("bx") - F.col("ax")) * (F.col("by") - F.col("ay")))


@query(f"SELECT id, 2 * w * h AS area2 FROM ({RECTS})")
def q_rect_area(spark, d):
    """Shoelace sum over the rectangle's corners, as a fold over array positions."""
    p = lambda a, b: F.struct(F.col("x0") + a, F.col("y0") + b)
    w, h, o = F.col("w"), F.col("h"), F.lit(0).cast("long")
    ring = rectangles(spark, d).select("id", F.array(p(o, o), p(w, o), p(w, h), p(o, h)).alias("ring"))
    at = lambda i: F.element_at("ring", F.pmod(i, F.lit(4)) + 1)
    cross = lambda i: at(i)["col1"] * at(i + 1)["col2"] - at(i + 1)["col1"] * at(i)["col2"]
    return ring.select("id", F.aggregate(F.sequence(F.lit(0), F.lit(3)), F.lit(0).cast("long"), lambda acc, i: acc + cross(i)).alias("area2"))


@query(f"SELECT id FROM ({RECTS}) WHERE w * h >= 10000")
def q_min_area(spark, d):
    return rectangles(spark, d).filter(F.col("w") * F.col("h") >= F.lit(int(k.LEAST_AREA))).select("id")


# ---- tiles: coverage, dedupe, layout ----

_SEA = f"WITH p AS ({POINTS}), t AS (SELECT DISTINCT floor({sql_x(10)})::BIGINT AS x, floor({sql_y(10)})::BIGINT AS y FROM p), s AS (SELECT x, y, x % 4 <> 0 AS open_sea FROM t), c AS (SELECT DISTINCT x >> 2 AS cx, y >> 2 AS cy FROM s), g AS (SELECT c.cx, c.cy, CASE WHEN 2 * count(*) FILTER (WHERE open_sea) > 2 THEN 2 ELSE 1 END::INTEGER AS value FROM c JOIN s ON x >> 2 = c.cx AND y >> 2 = c.cy GROUP BY 1, 2)"
_SEA16 = _SEA.replace("2 * count(*) FILTER (WHERE open_sea) > 2", "2 * count(*) FILTER (WHERE open_sea) > 16")


def sea_tiles(spark: SparkSession, d: str) -> DataFrame:
    """Tiles of zoom 10 around every point, three of four open sea."""
    p = world(points(spark, d), 10).select(F.floor("wx").alias("x"), F.floor("wy").alias("y"))
    for c in ("x", "y"):
        p = p.withColumn(c, F.explode(F.array(*(F.col(c) + n for n in range(4)))))
    return p.distinct().withColumn("open_sea", F.col("x") % 4 != 0)


_AROUND = f"""WITH p AS ({POINTS}), a AS (SELECT floor({sql_x(10)})::BIGINT AS x, floor({sql_y(10)})::BIGINT AS y FROM p),
t AS (SELECT DISTINCT x + i AS x, y + j AS y FROM a, range(4) r(i), range(4) q(j)), s AS (SELECT x, y, x % 4 <> 0 AS open_sea FROM t), c AS (SELECT DISTINCT x >> 2 AS cx, y >> 2 AS cy FROM s),
g AS (SELECT c.cx, c.cy, CASE WHEN 2 * count(*) FILTER (WHERE open_sea) > 16 THEN 2 ELSE 1 END::INTEGER AS value FROM c JOIN s ON x >> 2 = c.cx AND y >> 2 = c.cy GROUP BY 1, 2)"""


@query(f"{_AROUND} SELECT * FROM g")
def q_coverage(spark, d):
    t = sea_tiles(spark, d)
    cells = t.select(F.shiftright("x", 2).alias("cx"), F.shiftright("y", 2).alias("cy")).distinct()
    return r.coverage(t, cells, 10)


@query(f"""{_AROUND}, f AS (SELECT cx, cy FROM g WHERE value = 2), e AS (SELECT cx * 4 + i AS x, cy * 4 + j AS y FROM f, range(4) r(i), range(4) q(j))
SELECT x, y, true AS empty FROM e WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.x = e.x AND s.y = e.y)
UNION ALL SELECT x, y, false FROM s LEFT JOIN f ON x >> 2 = cx AND y >> 2 = cy WHERE NOT (open_sea AND cx IS NOT NULL)""")
def q_full_cell_fill(spark, d):
    t = sea_tiles(spark, d)
    return r.fill_full_cells(t, q_coverage(spark, d), 10)


@query(f"{_AROUND} SELECT v::INTEGER AS value, (CASE WHEN v = 0 THEN 65536 - (SELECT count(*) FROM g) ELSE (SELECT count(*) FROM g WHERE value = v) END)::BIGINT AS cells FROM range(4) r(v)")
def q_grid_histogram(spark, d):
    return r.grid_histogram(q_coverage(spark, d))


_BLOBS = "SELECT (doc_id % 3)::INTEGER AS level, doc_id AS key, encode(text) AS blob FROM documents"


def blobs(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select((F.col("doc_id") % 3).cast("int").alias("level"), F.col("doc_id").alias("key"), F.col("text").cast("binary").alias("blob"))


@query(f"WITH b AS ({_BLOBS}) SELECT level, min(key) AS first_key, count(*) AS tiles, octet_length(blob)::BIGINT AS len FROM b WHERE octet_length(blob) > 0 GROUP BY level, blob")
def q_blob_dedupe(spark, d):
    return r.distinct_blobs(blobs(spark, d)).select("level", "first_key", "tiles", F.length("blob").cast("long").alias("len"))


@query(f"""WITH b AS ({_BLOBS}), u AS (SELECT level, min(key) AS first_key, octet_length(blob)::BIGINT AS len FROM b WHERE octet_length(blob) > 0 GROUP BY level, blob)
SELECT level, first_key, len, coalesce(sum(len) OVER (PARTITION BY level ORDER BY first_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM u""")
def q_offsets(spark, d):
    return r.blob_offsets(r.distinct_blobs(blobs(spark, d)), 64).select("level", "first_key", "len", "offset")


@query("WITH t AS (SELECT (o_orderkey % 2)::INTEGER AS level, o_orderkey AS key, row_number() OVER (PARTITION BY o_orderkey % 2 ORDER BY o_orderkey) - 1 AS n FROM orders) SELECT level, (n // 256)::BIGINT AS page, key FROM t WHERE n % 256 = 0")
def q_pages(spark, d):
    return r.page_leaders(read(spark, d, "orders").select((F.col("o_orderkey") % 2).cast("int").alias("level"), F.col("o_orderkey").alias("key")))


@query("SELECT doc_id, sha256(text) AS digest FROM documents")
def q_sha256(spark, d):
    return read(spark, d, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))


@query("""SELECT doc_id, '"' || replace(replace(replace(replace(text, '\\', '\\\\'), '"', '\\"'), chr(10), '\\x0A'), chr(9), '\\x09') || '"' AS line FROM documents""")
def q_quote(spark, d):
    return read(spark, d, "documents").select("doc_id", x.quoted("text").alias("line"))


@query("""WITH RECURSIVE s AS (SELECT o_custkey % 200 AS region_key, sum(o_orderkey % 100000)::BIGINT AS bytes FROM orders GROUP BY 1), n AS (SELECT *, row_number() OVER (ORDER BY region_key) AS i FROM s),
f AS (SELECT region_key, bytes, i, 0 AS file, bytes AS used FROM n WHERE i = 1 UNION ALL
 SELECT n.region_key, n.bytes, n.i, CASE WHEN used > 0 AND used + n.bytes > 3000000 THEN file + 1 ELSE file END, CASE WHEN used > 0 AND used + n.bytes > 3000000 THEN n.bytes ELSE used + n.bytes END FROM f JOIN n ON n.i = f.i + 1)
SELECT region_key, bytes, file::INTEGER AS file FROM f""")
def q_file_packing(spark, d):
    sizes = read(spark, d, "orders").groupBy((F.col("o_custkey") % 200).alias("region_key")).agg(F.sum(F.col("o_orderkey") % 100000).alias("bytes"))
    return r.pack_files(sizes, 3_000_000)


@query("WITH f AS (SELECT p_brand || ' ' || p_type AS record, min(p_partkey) AS ord FROM part GROUP BY 1) SELECT record, ord, (row_number() OVER (ORDER BY ord) - 1)::INTEGER AS attr FROM f")
def q_zone_attrs(spark, d):
    return r.number_records(read(spark, d, "part").select(F.concat_ws(" ", "p_brand", "p_type").alias("record"), F.col("p_partkey").alias("ord")))


@query(f"""WITH p AS ({POINTS}), q AS (SELECT id % 4 AS category, id // 20 AS way, id, floor(({sql_x(12)}) * 4096)::BIGINT AS a, floor(({sql_y(12, 85.05)}) * 4096)::BIGINT AS b FROM p),
t AS (SELECT category, a - coalesce(lag(a) OVER w, 0) AS dx, b - coalesce(lag(b) OVER w, 0) AS dy FROM q WINDOW w AS (PARTITION BY category, way ORDER BY id))
SELECT category, count(*) AS vertices, sum({sql_varint(sql_zigzag('dx'))} + {sql_varint(sql_zigzag('dy'))})::BIGINT AS bytes FROM t GROUP BY 1""")
def q_estimate(spark, d):
    """Vertices and bytes by category of ways at 4096 units for a zoom-12 tile, each way's first point from nought."""
    p = points(spark, d)
    units = lambda e: F.floor(e * 4096)
    p = p.select((F.col("id") % 4).alias("category"), F.floor(F.col("id") / 20).alias("way"), "id", units(x.world_x(x.degrees_e7("lon_e7"), 12)).alias("a"), units(x.world_y(x.degrees_e7("lat_e7"), 12, 85.05)).alias("b"))
    w = Window.partitionBy("category", "way").orderBy("id")
    size = lambda c: x.varint_bytes(x.zigzag(F.col(c) - F.lag(c, 1, 0).over(w)))
    return p.withColumn("n", size("a") + size("b")).groupBy("category").agg(F.count("*").alias("vertices"), F.sum("n").alias("bytes"))


from . import format_queries, geometry_queries  # noqa: E402, F401  (add their queries)
