"""Fetching of rule zones from a feature service: ids are listed, features come by pages, and a record tells what came."""

from __future__ import annotations

import json
import os
import time
import urllib.parse
import urllib.request
from collections.abc import Callable

from pyspark.sql import SparkSession

from ..operators import tiles as t
from ..sources import geojson

# The service, its layers, the terms, and the seconds that an answer may take.
BASE = "https://gis.myfwc.com/hosting/rest/services/Open_Data"
LAYERS = {"boating": "State_Boating_Safety_Zones_Florida/MapServer/10", "manatee": "State_Manatee_Protection_Zones_in_Florida/MapServer/9"}
TERMS = "Florida FWC open data; for general reference only (the FAC prevails); not for navigation"
PATIENCE = 300


def get_text(url: str) -> str:
    with urllib.request.urlopen(url, timeout=PATIENCE) as answer:
        return answer.read().decode("utf-8")


def query_url(base: str, layer: str, **params) -> str:
    """Address of a query of a layer."""
    return f"{base}/{layer}/query?" + urllib.parse.urlencode({"where": "1=1", "f": "json"} | params)


def listed_ids(get: Callable[[str], str], base: str, layer: str) -> list[int]:
    return sorted(json.loads(get(query_url(base, layer, returnIdsOnly="true")))["objectIds"])


def fetch_all(spark: SparkSession, folder: str, get: Callable[[str], str], base: str = BASE, layers: dict[str, str] = LAYERS, page: int = geojson.PAGE, now: int | None = None) -> dict[str, int]:
    """Writes each layer as a GeoJSON document and SOURCES.fwc.json, the record of the retrieval; features by file.

    Pages are fetched by the executors, in order of their ids; ids that come back otherwise than listed are an error.
    """
    os.makedirs(folder, exist_ok=True)
    record: dict = {"retrieved_utc": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime(now)), "terms": TERMS, "files": {}}
    counts = {}
    for name, layer in layers.items():
        ids = spark.createDataFrame([(i,) for i in listed_ids(get, base, layer)], "id long")
        features = lambda part, layer=layer: get(query_url(base, layer, outFields="*", outSR=4326, returnGeometry="true", orderByFields="OBJECTID", objectIds=",".join(map(str, part)), f="geojson"))
        found = geojson.fetch(spark, ids, features, page).persist()
        geojson.check_complete(found, ids)
        path = f"{folder}/{name}.geojson"
        counts[f"{name}.geojson"] = 0
        with open(path, "w", encoding="utf-8") as f:
            f.write('{"type": "FeatureCollection", "features": [')
            for n, row in enumerate(found.orderBy("id").toLocalIterator()):
                f.write(", " * (n > 0) + row["feature"])
                counts[f"{name}.geojson"] = n + 1
            f.write("]}")
        found.unpersist()
        record["files"][f"{name}.geojson"] = {"url": f"{base}/{layer}/query (outSR=4326, f=geojson, pages of {page} by OBJECTID)", "features": counts[f"{name}.geojson"], "sha256": t.file_digest(path)}
    with open(f"{folder}/SOURCES.fwc.json", "w", encoding="utf-8") as f:
        f.write(json.dumps(record, indent=2) + "\n")
    return counts
