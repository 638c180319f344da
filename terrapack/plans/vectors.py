"""Golden layer files: small made layers whose bytes every writer of the format must give, and their text dumps."""

from __future__ import annotations

import os

import numpy as np

from ..functions import codec, geometry
from ..functions import constants as k

# Times, texts, levels, classes, points and records of the golden layers.
BUILD_TIME, DATA_TIME = 1790208000, 1790121600
OSM_TEXTS = ["osm-water", "© OpenStreetMap contributors", "ODbL 1.0", "OpenStreetMap", "2026-09-20", "test-vectors"]
BASE_TEXTS = ["ne-overview", "Made with Natural Earth", "Public domain", "Natural Earth", "1:10m", "test-vectors"]
ZONE_TEXTS = ["fwc-zones-test", "Florida FWC (test data)", "Public record (test)", "FWC", "2026-08", "test-vectors", 'tab\there\x01 and "quotes"']
SHAPE_TEXTS = ["zones-shapes-test", "Test shapes", "Public domain (test)", "none", "2026-09", "test-vectors"]
WATER_TILES = {
    (1000, 1500): [
        (k.POLYGON, 2, None, [[(100, 100), (3000, 150), (3100, 2900), (200, 3000)], [(1000, 1000), (1000, 2000), (2000, 2000), (2000, 1000)]]),
        (k.POLYGON, 1, None, [[(-32, -32), (4128, -32), (4128, 50), (-32, 60)]]),
        (k.LINE, 16, None, [[(0, 4000), (512, 3500), (1024, 3900), (4128, 3000)]]),
    ],
    (1001, 1500): [],
    (1000, 1501): [(k.POLYGON, 5, None, [[(0, 0), (4096, 0), (4096, 4096)]])],
}
BASE_TILES = {
    (7, 11): [
        (k.POLYGON, 1, None, [[(-32, 1000), (2000, 900), (4128, 1500), (4128, 4128), (-32, 4128)]]),
        (k.POLYGON, 2, None, [[(1500, 2500), (2500, 2400), (2600, 3300), (1600, 3400)]]),
        (k.LINE, 3, None, [[(300, 3900), (1200, 3000), (1550, 2950)]]),
    ],
    (7, 12): [(k.POLYGON, 1, None, [[(-32, -32), (4128, -32), (4128, 4128), (-32, 4128)]])],
}
ZONE_RECORDS = [
    [(k.NAME, "Test Idle Zone Ñ"), (k.SOURCE, "68D-24.test")],
    [(k.NAME, "Test 25 mph zone"), (k.SPEED, 402), (k.MONTHS, 0b111000000111), (k.DAYS, 0b1100000), (k.FLAGS, 1)],
    [(k.NAME, 'Quote " and \\ backslash'), (99, b"\x00\x01unknown tag")],
]
ZONE_TILES = {
    (2000, 3000): [(k.POLYGON, 1, 0, [[(1000, 1000), (9000, 1200), (8000, 9000)]]), (k.POLYGON, 3, 1, [[(20000, 20000), (40000, 20000), (40000, 40000), (20000, 40000)]])],
    (2001, 3000): [(k.POLYGON, 5, 2, [[(0, 0), (65536, 0), (65536, 65536), (0, 65536)], [(100, 100), (100, 200), (200, 200)]])],
}
SHAPE_RECORDS = ["Pair west", "Pair east", "Thin strip", "Large rectangle"]
#: Class and box of each shape.
SHAPES = [(1, (4000, 4000, 20000, 20000)), (1, (20000, 4000, 36000, 20000)), (1, (4000, 30000, 40000, 30600)), (5, (8000, 40000, 56000, 60000))]
LEVELS_GRID = {(62, 94): 1, (62, 95): 2, (63, 94): 2}
LEVELS_TRIANGLE = [(10, 10), (4000, 20), (2000, 4000)]
LEVELS_RING = [(-512, -512), (66048, -512), (66048, 66048), (30000, 40000), (-512, 66048)]
LEVELS_CANAL = [[(0, 0), (65536, 65536)], [(5, 5), (6, 7)], [(-500, 60000), (123, 456), (65000, 1)]]
#: The seam polygon: seed, first tile, and by ring: points, least and largest reach, phase and offset in tiles, whether outer.
SEAM_SEED, SEAM_TILE = 11, (1000, 1500)
SEAM_RINGS = [(90, 0.9, 1.45, 0.0, (0.0, 0.0), True), (24, 0.08, 0.2, 0.3, (-0.9, -0.2), False), (24, 0.08, 0.2, 0.3, (0.7, 0.6), False)]


def seam_rings() -> list[np.ndarray]:
    """The polygon with two holes that lies over three by three tiles, in world units of zoom 12 and 12 bits."""
    rng, side, out = np.random.default_rng(SEAM_SEED), 4096, []
    middle = (np.array(SEAM_TILE) + 1.5) * side
    for n, low, high, phase, offset, outer in SEAM_RINGS:
        angle, reach = np.linspace(0, 2 * np.pi, n, endpoint=False) + phase, rng.uniform(low * side, high * side, n)
        ring = np.rint(middle + reach[:, None] * np.stack([np.cos(angle), np.sin(angle)], axis=1)).astype(np.int64)
        out.append(geometry.wound(geometry.Parts.of([ring + [int(d * side) for d in offset]]), np.array([outer]))[0])
    return out


def seam_text() -> bytes:
    """The rings, each with its number of points, relative to the corner of the first tile."""
    corner = np.array(SEAM_TILE) * 4096
    return "".join(f"ring {len(r)}\n" + "".join(f"{x} {y}\n" for x, y in (r - corner).tolist()) for r in seam_rings()).encode()


def _level(zoom: int, first: int, last: int, bits: int, buffer: int, tolerance: int, tiles: dict, **more) -> codec.LevelSpec:
    return codec.LevelSpec(zoom, first, last, bits, buffer, tolerance, [(codec.tile_key(*at), codec.encode_tile(features, bits, buffer)) for at, features in tiles.items()], **more)


def _layer(kind: int, texts: list[str], *levels: codec.LevelSpec, records=()) -> codec.Layer:
    return codec.Layer(kind, list(levels), texts, {name: n for n, name in enumerate(k.ID_FIELDS)}, [codec.encode_record(r) for r in records], BUILD_TIME, DATA_TIME)


def layers() -> dict[str, codec.Layer]:
    """The golden layers by name."""
    box = lambda a, b, c, d: [(a, b), (c, b), (c, d), (a, d)]
    many = {(x, y): [(k.POLYGON, 2, None, [box(100, 100, 300 + 700 * ((x + y) % 5), 300 + 700 * ((x + y) % 5))])] for x in range(1000, 1020) for y in range(1500, 1515)}
    seam = {at: [(k.POLYGON, 2, None, parts)] for at, parts in geometry.cut(seam_rings(), True, 12, 12, 32).items()}
    shapes = {(2000, 3000): [(k.POLYGON, cls, n, [box(*corners)]) for n, (cls, corners) in enumerate(SHAPES)]}
    return {
        "water_minimal": _layer(k.WATER, OSM_TEXTS, _level(12, 12, 13, 12, 32, 100, WATER_TILES)),
        "water_levels": _layer(
            k.WATER, OSM_TEXTS,
            _level(10, 10, 11, 12, 32, 400, {(249, 377): [(k.POLYGON, 2, None, [LEVELS_TRIANGLE])], (250, 378): []}, full_class=1, grid=LEVELS_GRID),
            _level(12, 12, 13, 12, 32, 100, many),
            _level(12, 14, 16, 16, 512, 40, {(1000, 1500): [(k.POLYGON, 1, None, [LEVELS_RING]), (k.LINE, 17, None, LEVELS_CANAL)]}),
        ),
        "zones": _layer(k.ZONES, ZONE_TEXTS, _level(12, 12, 16, 16, 512, 10, ZONE_TILES), records=ZONE_RECORDS),
        "zones_shapes": _layer(k.ZONES, SHAPE_TEXTS, _level(12, 12, 16, 16, 512, 10, shapes), records=[[(k.NAME, n)] for n in SHAPE_RECORDS]),
        "base_minimal": _layer(k.BASE, BASE_TEXTS, _level(5, 5, 9, 12, 32, 3000, BASE_TILES)),
        "water_seam": _layer(k.WATER, OSM_TEXTS, _level(12, 12, 14, 12, 32, 100, seam)),
    }


def write(folder: str) -> dict[str, int]:
    """Writes each layer as NAME.pmt with its dump NAME.txt, and the seam polygon; sizes of the layers by name."""
    os.makedirs(folder, exist_ok=True)
    sizes = {}
    for name, layer in layers().items():
        raw = codec.write_layer(layer)
        sizes[name] = len(raw)
        for end, data in (("pmt", raw), ("txt", codec.dump(codec.LayerFile(raw)))):
            with open(f"{folder}/{name}.{end}", "wb") as f:
                f.write(data)
    with open(f"{folder}/water_seam_rings.txt", "wb") as f:
        f.write(seam_text())
    return sizes
