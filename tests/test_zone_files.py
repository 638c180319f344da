"""Zones whose records no single header could hold: several files, each within the format, which together hold all."""

import json
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrapack import __main__ as cli
from terrapack.functions import codec
from terrapack.functions import constants as k
from terrapack.operators import relational as r
from terrapack.plans import catalog, packs
from terrapack.plans.format_queries import collections

SMALL = "/root/testdata/sf0.001"


def told(files):
    """Each tile with its features, in order, and their records, and the number of files that have it."""
    out = []
    for f in (codec.LayerFile(raw) for _, raw in files):
        assert f.warnings() == []
        for n, v in enumerate(f.levels):
            for entry in v.index.tolist():
                assert f.coverage(n, *codec.tile_place(entry[0])) == 1
                out.append((n, entry[0], tuple((geom, cls, bytes(f.records[attr]), tuple(map(tuple, parts))) for geom, cls, attr, parts in f.tile(n, entry))))
    return sorted(out)


def test_several_files_hold_what_one_does(spark):
    given = (*collections(spark, SMALL), "2026-09", 1, 2, "z")
    one, several = list(packs.zone_files(*given)), list(packs.zone_files(*given, most=900))
    assert [n for n, _ in one] == ["z.pmt"] and [n for n, _ in several] == [f"z-{n + 1:02d}.pmt" for n in range(len(several))] and len(several) > 3
    assert one[0][1] == packs.build_zones(*given)[0]
    assert told(several) == told(one)
    whole, parts = codec.LayerFile(one[0][1]), [codec.LayerFile(raw) for _, raw in several]
    assert {bytes(q) for f in parts for q in f.records} == {bytes(q) for q in whole.records}
    place = {bytes(q): n for n, q in enumerate(whole.records)}
    for f in parts:
        listed = [place[bytes(q)] for q in f.records]
        assert listed == sorted(set(listed))
    assert ((np.max([f.levels[0].grid for f in parts], axis=0)) == whole.levels[0].grid).all()


def test_query_with_more_records_than_a_header(spark, tmp_path):
    name = F.concat(F.lit("N"), F.lpad(F.col("id").cast("string"), 60_000, "x"))
    spark.range(900).select(F.col("id").alias("c_custkey"), name.alias("c_name")).write.parquet(f"{tmp_path}/customer.parquet")
    got = catalog.QUERIES["q_zones"](spark, str(tmp_path)).collect()
    plain = spark.read.parquet(f"{tmp_path}/customer.parquet").withColumn("c_name", F.lit("n"))
    plain.write.parquet(f"{tmp_path}/plain/customer.parquet")
    want = catalog.QUERIES["q_zones"](spark, f"{tmp_path}/plain").collect()
    assert {q["error"] for q in got} == {None}
    assert Counter((q["level"], q["key"]) for q in got) == Counter((q["level"], q["key"]) for q in want)


def test_starts_of_files():
    cells = [(0, 4), (1, 4), (16, 3), (17, 3), (32, 2), (48, 30), (49, 5), (50, 5), (64, 1)]
    assert packs.file_starts(cells, 10, 4) == [0, 16, 48, 49, 64]
    assert packs.file_starts(cells, 1000, 4) == [0] and packs.file_starts([], 10, 4) == [0]


def test_records_are_numbered_by_ranges(spark):
    rows = spark.range(400).select((F.col("id") * 37 % 400).alias("ord"), (F.col("id") * 37 % 400 % 90).cast("string").alias("record"))
    got, want = (sorted(tuple(q) for q in df.select("record", "ord", "attr").collect()) for df in (r.number_records(rows, F.floor(F.col("ord") / 16)), r.number_records(rows)))
    assert got == want and len(got) == 90


@pytest.mark.parametrize("value", [0, 127, 128, 402, (1 << 14) - 1, 1 << 14, (1 << 32) - 1])
def test_numbers_of_a_record(value):
    assert codec.number(value) == codec.varints([value])
    for bad in (-1, 1 << 32):
        with pytest.raises(codec.FormatError):
            codec.encode_record([(k.SPEED, bad)])


def test_zones_command(tmp_path):
    ring = [[-82, 27], [-82, 27.05], [-81.95, 27.05], [-81.95, 27], [-82, 27]]
    doc = {"features": [{"properties": {"RESTRICTION": v}, "geometry": {"type": "Polygon", "coordinates": [ring]}} for v in ("Idle Speed", "No Anchoring")]}
    for name, d in (("b", doc), ("m", {"features": []})):
        (tmp_path / f"{name}.json").write_text(json.dumps(d))
    cli.main(["zones", f"{tmp_path}/out", "--boating", f"{tmp_path}/b.json", "--manatee", f"{tmp_path}/m.json", "--date", "2026-09"])
    assert len(codec.LayerFile((tmp_path / "out" / "fwc-zones.pmt").read_bytes()).records) == 1
    assert list(json.loads((tmp_path / "out" / "SOURCES.json").read_text())["files"]) == ["fwc-zones.pmt"]
