"""Column builders: projection, tile keys, integer codes, classes and rules, all within whole-stage codegen."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as k


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


# ---- projection ----


def world_x(lon, bits) -> Column:
    """Mercator x in units of a world that is 2**bits wide."""
    return (_c(lon) + F.lit(180.0)) / F.lit(360.0) * F.lit(float(1 << bits))


def world_y(lat, bits, most: float = k.MAX_LATITUDE) -> Column:
    """Mercator y, growing to the south; latitudes beyond the square world count as its edge."""
    s = F.sin(F.radians(F.least(F.greatest(_c(lat), F.lit(-most)), F.lit(most))))
    return (F.lit(0.5) - F.ln((1 + s) / (1 - s)) / F.lit(4 * math.pi)) * F.lit(float(1 << bits))


def longitude(x, bits) -> Column:
    return _c(x) / F.lit(float(1 << bits)) * 360.0 - 180.0


def latitude(y, bits) -> Column:
    return F.degrees(F.atan(F.sinh(F.lit(math.pi) * (1 - 2 * _c(y) / F.lit(float(1 << bits))))))


def units_per_metre(lat, bits) -> Column:
    return F.lit(float(1 << bits)) / (F.lit(2 * math.pi * k.EARTH_RADIUS) * F.cos(F.radians(_c(lat))))


def tile_of(value, bits) -> Column:
    return F.floor(_c(value) / F.lit(float(1 << bits))).cast("long")


def clamped_tile(world, zoom: int) -> Column:
    """Index of the zoom's tile at a world coordinate of that zoom, kept inside the world; cuts towards zero."""
    return F.least(F.greatest(world.cast("long"), F.lit(0)), F.lit((1 << zoom) - 1)).cast("long")


def cell_x(lon, zoom: int = k.GRID_ZOOM) -> Column:
    return clamped_tile(world_x(lon, zoom), zoom)


def cell_y(lat, zoom: int = k.GRID_ZOOM) -> Column:
    return clamped_tile(world_y(lat, zoom, 85.0511), zoom)


def e7(nanodegrees) -> Column:
    """Nanodegrees as 1e-7 degrees, halves up."""
    n = _c(nanodegrees)
    return (F.floor(n / F.lit(100)) + F.when(F.pmod(n, F.lit(100)) >= 50, 1).otherwise(0)).cast("int")


def degrees_e7(value) -> Column:
    return F.lit(1e-9) * (_c(value).cast("long") * F.lit(100))


# ---- keys and integer codes ----


def _spread(v: Column) -> Column:
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return v


def _gather(v: Column) -> Column:
    v = v.bitwiseAND(F.lit(0x55555555).cast("long"))
    for shift, mask in ((1, 0x33333333), (2, 0x0F0F0F0F), (4, 0x00FF00FF), (8, 0x0000FFFF)):
        v = v.bitwiseOR(F.shiftright(v, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return v


def morton(x, y) -> Column:
    """Tile key: the bits of x at even places, those of y at odd ones; both below 2**16."""
    return _spread(_c(x).cast("long")).bitwiseOR(F.shiftleft(_spread(_c(y).cast("long")), 1))


def unmorton_x(key) -> Column:
    return _gather(_c(key).cast("long"))


def unmorton_y(key) -> Column:
    return _gather(F.shiftright(_c(key).cast("long"), 1))


def zigzag(v) -> Column:
    v = _c(v).cast("long")
    return F.shiftleft(v, 1).bitwiseXOR(F.shiftright(v, 63))


def unzigzag(u) -> Column:
    u = _c(u).cast("long")
    return F.shiftright(u, 1).bitwiseXOR(-u.bitwiseAND(F.lit(1).cast("long")))


def varint_bytes(v) -> Column:
    """Bytes of an unsigned base-128 number."""
    v = _c(v)
    return reduce(lambda acc, n: F.when(v < F.lit(1 << (7 * n)), n).otherwise(acc), range(8, 0, -1), F.lit(9)).cast("int")


def aligned(n, to: int = k.PAGE_BYTES) -> Column:
    return (F.ceil(_c(n) / F.lit(to)) * to).cast("long")


def start_shift(x0, y0, x1, y1, most: int = k.MOST_TILE_ZOOM) -> Column:
    """Levels from the tiles up to the deepest quadtree node that holds both corners, given as tiles."""
    apart = _c(x0).bitwiseXOR(_c(x1)).bitwiseOR(_c(y0).bitwiseXOR(_c(y1)))
    return reduce(lambda acc, n: F.when(apart < F.lit(1 << n).cast("long"), n).otherwise(acc), range(most, -1, -1), F.lit(most + 1)).cast("int")


def nodes_overlap(z, x, y, rz, rx, ry) -> Column:
    """Whether one of two quadtree nodes lies within the other."""
    z, rz = _c(z), _c(rz)
    up = lambda v, n: F.floor(_c(v) / F.pow(F.lit(2.0), F.greatest(n, F.lit(0)))).cast("long")
    return (up(x, z - rz) == up(rx, rz - z)) & (up(y, z - rz) == up(ry, rz - z))


def is_closed(refs) -> Column:
    """Whether a way's refs make a ring by themselves."""
    refs = _c(refs)
    return (F.size(refs) >= 4) & (F.element_at(refs, 1) == F.element_at(refs, -1))


def members_by_role(members, outer: bool) -> Column:
    """The ways (type 1) among a relation's members that are outer rings, with or without saying so, or inner ones."""
    roles = ("outer", "") if outer else ("inner",)
    return F.filter(_c(members), lambda m: (m["type"] == 1) & m["role"].isin(*roles))


def utc_text(seconds) -> Column:
    """Seconds since 1970 as a UTC time to the second, whatever the session's time zone; a year has four digits or more,
    and no sign where it is over 9999."""
    s = _c(seconds).cast("long")
    day = F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(s / 86400).cast("int")), "yyyy-MM-dd")
    day = F.ltrim(day, F.lit("+"))
    clock = F.pmod(s, F.lit(86400))
    two = lambda v: F.lpad(v.cast("long").cast("string"), 2, "0")
    return F.concat(day, F.lit("T"), two(F.floor(clock / 3600)), F.lit(":"), two(F.floor(F.pmod(clock, F.lit(3600)) / 60)), F.lit(":"), two(F.pmod(clock, F.lit(60))), F.lit("Z"))


def query_url(base, layer, **params) -> Column:
    """Address of a query of a layer, its parameters encoded."""
    pairs = {"where": F.lit("1=1"), "f": F.lit("json")} | {name: _c(v) for name, v in params.items()}
    return F.concat(_c(base), F.lit("/"), _c(layer), F.lit("/query?"), F.concat_ws("&", *(F.concat(F.lit(f"{name}="), F.url_encode(v)) for name, v in pairs.items())))


def boxes_meet(s, w, n, e, south, west, north, east) -> Column:
    """Closed boxes that share a point."""
    return (_c(s) <= _c(north)) & (_c(n) >= _c(south)) & (_c(w) <= _c(east)) & (_c(e) >= _c(west))


# ---- classes of tagged elements ----


def tag(tags, name: str) -> Column:
    return F.coalesce(F.try_element_at(_c(tags), F.lit(name)), F.lit(""))


def area_class(tags) -> Column:
    """1 to 5 for water areas, null for all else."""
    water = tag(tags, "water")
    not_water = (tag(tags, "intermittent") == "yes") | water.isin("wastewater", "reflecting_pool") | (tag(tags, "landuse") == "basin")
    by_water = (
        F.when(water == "reservoir", 3)
        .when(water.isin("river", "stream", "rapids"), 4)
        .when(water.isin("canal", "ditch", "drain", "lock", "moat", "harbour", "marina"), 5)
        .otherwise(2)
    )
    return F.when(~not_water, F.when(tag(tags, "natural") == "water", by_water).when(tag(tags, "waterway") == "riverbank", 4).when(tag(tags, "landuse") == "reservoir", 3))


def line_class(tags) -> Column:
    return F.when(tag(tags, "intermittent") != "yes", F.when(tag(tags, "waterway") == "river", 16).when(tag(tags, "waterway") == "canal", 17))


def is_water_relation(tags) -> Column:
    return (tag(tags, "type") == "multipolygon") & area_class(tags).isNotNull()


def way_kind(tags) -> Column:
    """Both classes of a way, of which either, or both, may be set; null if neither is."""
    area, line = area_class(tags), line_class(tags)
    return F.when(area.isNotNull() | line.isNotNull(), F.struct(area.alias("area"), line.alias("line")))


# ---- rules of zones ----


def speed(mph) -> Column:
    return F.rint(_c(mph).cast("double") * F.lit(k.DKMH_PER_MPH)).cast("int")


_SEASON = r"^\s*([A-Z]{3})\s*([0-9]*)\s*-\s*([A-Z]{3})\s*([0-9]*)\s*$"


def season(text) -> Column:
    """Struct of months (bit 0 January) and partial, from ranges like NOV 15 - MAR 31.

    The range may wrap over the year's end; a month that is touched counts whole. Unreadable: all year, partial.
    """
    upper = F.upper(F.coalesce(_c(text), F.lit("")))
    part = lambda n: F.regexp_extract(upper, _SEASON, n)
    month = lambda n: F.array_position(F.array(*(F.lit(m) for m in k.MONTH_NAMES)), part(n)).cast("int")
    first, last = month(1), month(3)
    span = F.pmod(last - first, F.lit(12))
    run = F.shiftleft(F.lit(1), 1) * F.lit(0) + F.lit(0)
    run = F.aggregate(F.sequence(F.lit(0), span), run, lambda acc, n: acc.bitwiseOR(F.element_at(F.array(*(F.lit(1 << m) for m in range(12))), F.pmod(first - 1 + n, F.lit(12)) + 1)))
    begins = F.coalesce(F.try_to_number(F.nullif(part(2), F.lit("")), F.lit("99999")).cast("int"), F.lit(1))
    end = F.element_at(F.array(*(F.lit(d) for d in k.MONTH_ENDS)), last)
    ends = F.coalesce(F.try_to_number(F.nullif(part(4), F.lit("")), F.lit("99999")).cast("int"), end)
    ok = (first > 0) & (last > 0)
    return F.when(ok, F.struct(run.alias("months"), ((begins != 1) | (ends < end)).alias("partial"))).otherwise(F.struct(F.lit(k.ALL_YEAR).alias("months"), F.lit(True).alias("partial")))


def _rule(cls, limit, flags, days, name) -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(lit(cls).cast("int").alias("cls"), lit(limit).cast("int").alias("speed"), lit(flags).cast("int").alias("flags"), lit(days).cast("int").alias("days"), lit(name).alias("name"))


def manatee_rule(code) -> Column:
    """Struct cls, speed, flags, days, name of a manatee-zone code; null where it restricts nothing."""
    c = F.upper(F.trim(F.coalesce(_c(code), F.lit(""))))
    night, day = r"^([0-9]+)\s*DY\s*/\s*([0-9]+)\s*N$", r"^([0-9]+)\s*MPH$"
    got = lambda p, n: F.regexp_extract(c, p, n)
    return (
        F.when(c.isin("", "UN"), F.lit(None))
        .when(c.startswith("SSAY_25CH"), _rule(2, 0, k.CHANNEL, None, "SLOW SPEED (25 MPH IN CHANNEL)"))
        .when(c == "SS WKND", _rule(2, 0, 0, k.WEEKEND, "SLOW SPEED (WEEKENDS)"))
        .when(c.isin("IS", "ISAY"), _rule(1, 0, 0, None, "IDLE SPEED"))
        .when(c.isin("SS", "SSAY"), _rule(2, 0, 0, None, "SLOW SPEED"))
        .when(c.isin("NE", "NEAY"), _rule(4, 0, 0, None, "NO ENTRY"))
        .when(c.isin("MP", "MPAY"), _rule(4, 0, 0, None, "MOTORBOATS PROHIBITED"))
        .when(c.rlike(night), _rule(3, speed(got(night, 1)), k.PARTIAL, None, F.concat(got(night, 1), F.lit(" MPH DAY / "), got(night, 2), F.lit(" NIGHT"))))
        .when(c.rlike(day), _rule(3, speed(got(day, 1)), 0, None, F.concat(got(day, 1), F.lit(" MPH"))))
        .otherwise(_rule(5, 0, k.PARTIAL, None, c))
    )


def boating_rule(restriction) -> Column:
    """The same for a boating restriction; null where it is no rule of speed or entry."""
    r = F.lower(F.trim(F.coalesce(_c(restriction), F.lit(""))))
    flags = F.when(F.contains(r, F.lit("conditional")), k.PARTIAL).otherwise(0)
    most = r"^max speed ([0-9]+)\s*mph"
    return (
        F.when(r.startswith("idle speed"), _rule(1, 0, flags, None, "IDLE SPEED NO WAKE"))
        .when(r.startswith("slow speed"), _rule(2, 0, flags, None, "SLOW SPEED MINIMUM WAKE"))
        .when(r.rlike(most), _rule(3, speed(F.regexp_extract(r, most, 1)), flags, None, F.concat(F.lit("MAX "), F.regexp_extract(r, most, 1), F.lit(" MPH"))))
        .when(r.startswith("no entry"), _rule(4, 0, flags, None, "NO ENTRY"))
    )


def min_zoom(attrs) -> Column:
    """Least display zoom of a shape: min_zoom in either case, else scalerank and one, else 0."""
    number = lambda n: F.try_element_at(_c(attrs), F.lit(n)).try_cast("double")
    return F.coalesce(number("min_zoom"), number("MIN_ZOOM"), number("scalerank") + 1, number("SCALERANK") + 1, F.lit(0.0))


def quoted(raw) -> Column:
    """Text of the canonical dump: backslash and quote escaped, control characters as hexadecimal."""
    out = F.replace(F.replace(_c(raw), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for c in range(32):
        out = F.replace(out, F.lit(chr(c)), F.lit(f"\\x{c:02X}"))
    return F.concat(F.lit('"'), out, F.lit('"'))
