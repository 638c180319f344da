"""Tiles of features that arrive as a stream: each micro-batch cuts what it brings and replaces the tiles it touches.

The tile pipeline is a pure function of features, so a batch needs no state but the stored features themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions import constants as k
from ..operators import relational, tiles
from ..plans import packs


def changed_tiles(new: DataFrame, stored: DataFrame, levels: tuple[tuple, ...]) -> DataFrame:
    """Encoded tiles that the new features touch, made from the new and the stored features (tiles.FEATURE)."""
    fresh = tiles.cut_features(new, levels)
    touched = fresh.select("level", "x", "y").distinct().persist()
    near = stored_near(stored, touched, levels)
    old = tiles.cut_features(near, levels).join(touched, ["level", "x", "y"], "left_semi")
    return tiles.encode_tiles(relational.group_tiles(fresh.unionByName(old)), levels)


def stored_near(stored: DataFrame, touched: DataFrame, levels: tuple[tuple, ...]) -> DataFrame:
    """Stored features whose boxes, grown by the margin, meet a coarse tile that holds a touched one; the others cannot
    share a tile with what is new, and are not cut again."""
    zoom = min(min(v[0] for v in levels), k.REGION_ZOOM)
    up = F.element_at(F.array(*(F.lit(v[0] - zoom) for v in levels)), F.col("level") + 1)
    here = touched.select(F.expr("x").alias("x"), F.col("y"), up.alias("up")).select(F.expr("shiftright(x, up)").alias("rx"), F.expr("shiftright(y, up)").alias("ry")).distinct()
    boxed = packs.with_box(stored).withColumn("_row", F.struct("ord", "geom", "cls"))
    met = relational.features_by_region(boxed.select("_row", "lon_min", "lat_min", "lon_max", "lat_max"), zoom).join(here, ["rx", "ry"], "left_semi").select("_row").distinct()
    return boxed.join(met, "_row", "left_semi").select(*stored.columns)


def retile(stream: DataFrame, features_path: str, tiles_path: str, levels: tuple[tuple, ...]) -> DataStreamWriter:
    """A writer that for each micro-batch appends its features and writes the tiles they change under the batch's number.

    The last number of a tile is its newest form. A batch that is run again writes the same folders again.
    """

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        batch.write.mode("overwrite").parquet(f"{features_path}/batch={number}")
        stored = spark.read.parquet(features_path).filter(f"batch < {number}").drop("batch")
        changed_tiles(batch, stored, levels).write.mode("overwrite").parquet(f"{tiles_path}/batch={number}")
        batch.unpersist()

    return stream.writeStream.foreachBatch(each)
