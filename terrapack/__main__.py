"""Command line: python -m terrapack COMMAND ..."""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

from pyspark.sql import SparkSession

from .functions import codec
from .functions import constants as k
from .operators import tiles as t
from .plans import fetching, packs, vectors
from .sources import geojson, tilepack


def _sources(folder: str, files: dict[str, tuple[int, str]], kind: str, sources: list[str], built: int) -> None:
    listed = [{"file": os.path.basename(path), "sha256": t.file_digest(path)} for path in sources]
    with open(f"{folder}/SOURCES.json", "w", encoding="utf-8") as f:
        f.write(packs.sources_json(kind, listed, files, built))


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="terrapack", description="Builds, reads and checks vector tile packs.")
    sub = ap.add_subparsers(dest="command", required=True)

    def command(of: str, /, *args: str, **options):
        p = sub.add_parser(of)
        for a in args:
            p.add_argument(a)
        for o, default in options.items():
            flag = "--" + o.replace("_", "-")
            if default is False:
                p.add_argument(flag, action="store_true")
            else:
                p.add_argument(flag, default=default, type=type(default) if default is not None else str)

    command("water", "extract", "out_dir", name=None, sea=None, region_zoom=k.REGION_ZOOM, max_file_bytes=k.MOST_PACK_BYTES, keep_store=False, reuse_store=False)
    command("zones", "out_dir", boating=None, manatee=None, date=None, name="fwc-zones")
    command("overview", "folder", "out")
    command("dump", "file")
    command("check", "file")
    command("crop", "file", "out", "south", "west", "north", "east")
    command("estimate", "extract", json=None)
    command("synthetic", "out", lat=45.0, lon=-93.3, km="60x45", seed=7, lakes=140, rough=0.18)
    command("vectors", "out_dir")
    command("fetch", "out_dir", base=fetching.BASE)
    a = ap.parse_args(argv)
    if a.command == "water" and not 0 <= a.region_zoom <= k.GRID_ZOOM:
        ap.error("--region-zoom must be 0 to 8: regions hold whole cells of the coverage grid")
    if a.command == "vectors":
        for name, size in vectors.write(a.out_dir).items():
            print(f"{name}: {size} bytes")
        return 0
    spark = SparkSession.builder.appName("terrapack").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    now = int(time.time())
    try:
        if a.command == "water":
            name = a.name or packs.pack_name(a.extract)
            store = f"{os.path.abspath(a.out_dir)}/store"
            found = packs.open_store(spark, store) if a.reuse_store else None
            if found is None and (a.keep_store or a.reuse_store):
                packs.keep_store(packs.collect_water(spark, a.extract, a.sea), store)
                found = packs.open_store(spark, store)
            given = {"features": found["features"], "cells": found["cells"]} if found else {}
            pack = packs.plan_water(spark, a.extract, a.sea, now, a.max_file_bytes, a.region_zoom, name, maker=f"terrapack {packs.commit_stamp()}", **given)
            files = {row["name"]: (row["bytes"], row["sha256"]) for row in packs.write_water(pack, os.path.abspath(a.out_dir)).collect()}
            _sources(a.out_dir, files, "water", [a.extract, *([a.sea] if a.sea else [])], now)
            for name, text in (("LICENSE.txt", packs.LICENSE), ("ATTRIBUTION.txt", packs.ATTRIBUTION)):
                with open(f"{a.out_dir}/{name}", "w", encoding="utf-8") as f:
                    f.write(text)
            with open(f"{a.out_dir}/MANIFEST.sha256", "w", encoding="utf-8") as f:
                f.write(packs.manifest(a.out_dir))
        elif a.command == "zones":
            boating, files = geojson.read_features(spark, a.boating), {}
            os.makedirs(a.out_dir, exist_ok=True)
            for name, raw in packs.zone_files(boating, geojson.read_features(spark, a.manatee), a.date, now, now, a.name):
                with open(f"{a.out_dir}/{name}", "wb") as f:
                    f.write(raw)
                files[name] = (len(raw), t.digest(raw))
            _sources(a.out_dir, files, "zones", [a.boating, a.manatee], now)
            for row in packs.skipped_rules(boating).collect():
                print(f"left out: {row['restriction']} x{row['n']}")
        elif a.command == "overview":
            with open(a.out, "wb") as f:
                f.write(packs.build_overview(spark, a.folder, now, now))
        elif a.command == "dump":
            with open(a.file, "rb") as f:
                sys.stdout.buffer.write(codec.dump(codec.LayerFile(f.read())))
        elif a.command == "check":
            tilepack.register(spark)
            got = packs.check(spark, a.file).first()
            print(f"error: {got['first_error']}" if got["bad"] else f"ok: {got['levels']} levels, {got['tiles']} tiles")
            return 1 if got["bad"] else 0
        elif a.command == "crop":
            with open(a.out, "wb") as f:
                f.write(packs.crop_file(spark, a.file, (float(a.south), float(a.west), float(a.north), float(a.east))))
        elif a.command == "estimate":
            rows = [r.asDict() for r in packs.estimate(spark, a.extract).collect()]
            print(json.dumps(rows, indent=2))
            if a.json:
                with open(a.json, "w", encoding="utf-8") as f:
                    json.dump(rows, f)
        elif a.command == "fetch":
            for name, n in fetching.fetch_all(spark, a.out_dir, fetching.get_text, a.base).items():
                print(f"{name}: {n} features")
        else:
            wide, high = (float(v) for v in a.km.split("x"))
            tiles = t.tiles_of(packs.synthetic(spark, a.lat, a.lon, wide, a.seed, a.lakes, a.rough, high), k.WATER_LEVELS)
            layer = codec.Layer(k.WATER, t.level_specs(k.WATER_LEVELS, 1, None), ["synthetic"], {"layer": 0}, [], now, now)
            with open(a.out, "wb") as f:
                f.write(t.assemble(tiles, layer))
    except codec.FormatError as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
