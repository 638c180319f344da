"""Golden layers: their tiles' lengths and checksums, and their dumps, are fixed values of the format."""

import hashlib

import pytest

from terrapack.functions import codec
from terrapack.plans import vectors

# SHA-256 of the dumps, and bytes and checksum of each tile in order of keys.
DUMPS = {
    "base_minimal": "3845b86f31114dbc320ec0a66b7cdd4e3c4a5343e3bb32d22244b15c4d9dd65e",
    "water_minimal": "9d8348674e4a1024dd7ecc58d80bba31d01a79493d5dab6b1daf9156d92c577d",
    "water_seam": "097646b9a6bed1dd4fb8b411eb2ff536f1d3f6c0f32fbd19a82893cc9ccbab8f",
    "zones": "325824c0cde963ca3a3b32e863a4a6473bb0c4005433a8bfec0ada4c3082697a",
    "zones_shapes": "1e4710cae6267d8684b8a9a5ba2de7bfa7217ac74faf8768c57fa41fcab7b70b",
}
SEAM_RINGS = "dd624a50b1058a2931e3e1489b3fb6f11d6264d4fd53183a78441955a9c91018"
TILES = {
    "base_minimal": [(53, "12d0bfe0"), (14, "dcda340c")],
    "water_minimal": [(67, "5d6a8a19"), (0, "00000000"), (11, "4b05c20f")],
    "water_seam": [(60, "c912f9cc"), (78, "0f54ad1c"), (167, "1bd0b185"), (14, "89311656"), (47, "bfb9825a"), (103, "0fa02250"), (58, "7cef9d96"), (71, "7a27eed3"), (130, "29914d4c")],
    "zones": [(38, "ff570429"), (30, "8e8c2de8")],
    "zones_shapes": [(84, "f71a2649")],
}


@pytest.mark.parametrize("name", sorted(DUMPS))
def test_tiles_and_dumps(name):
    f = codec.LayerFile(codec.write_layer(vectors.layers()[name]))
    entries = [(e[2], f"{e[3]:08x}") for v in f.levels for e in v.index.tolist()]
    assert entries == TILES[name]
    assert hashlib.sha256(codec.dump(f)).hexdigest() == DUMPS[name]


def test_seam_polygon():
    assert hashlib.sha256(vectors.seam_text()).hexdigest() == SEAM_RINGS


def test_levels_share_blobs():
    f = codec.LayerFile(codec.write_layer(vectors.layers()["water_levels"]))
    assert len({tuple(e[1:3]) for e in f.levels[1].index.tolist()}) == 5 and len(f.levels[1].pages) == 2


def test_written_vectors_read_alike(tmp_path):
    sizes = vectors.write(str(tmp_path))
    for name, size in sizes.items():
        raw = (tmp_path / f"{name}.pmt").read_bytes()
        f = codec.LayerFile(raw)
        assert len(raw) == size and codec.dump(f) == (tmp_path / f"{name}.txt").read_bytes()
        for n, v in enumerate(f.levels):
            assert all(codec.encode_tile(f.tile(n, e), v.bits, v.buffer) == f.tile_bytes(n, e) for e in v.index.tolist())
