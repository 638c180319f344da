"""Tiles over the format's limits: refused by the format, coded whole where a table has such tiles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrapack.functions import codec
from terrapack.functions import constants as k
from terrapack.operators import tiles
from terrapack.plans import catalog

MANY = k.MOST_FEATURES + 10


def test_limits_are_the_formats_unless_lifted():
    one = np.ones(MANY, np.int64)
    t = codec.Tiles(np.array([MANY]), 2 * one, one, -one, one, 2 * one, np.tile([[1, 2], [3, 4]], (MANY, 1)))
    low, high = np.array([-32]), np.array([4128])
    with pytest.raises(codec.FormatError, match="too many features"):
        codec.encode_tiles(t, low, high)
    raw = codec.encode_tiles(t, low, high, codec.ANY_SIZE)[0].tobytes()
    assert not codec.decode_tiles([raw], low, high, 0)[1][0]
    got, read = codec.decode_tiles([raw], low, high, 0, codec.ANY_SIZE)
    assert read[0] and got.features.tolist() == [MANY] and (got.points == t.points).all()
    with pytest.raises(codec.FormatError, match="too many features"):
        codec.decode_tile(raw, 12, 32, 0)
    assert len(codec.decode_tile(raw, 12, 32, 0, codec.ANY_SIZE)) == MANY


def test_runs_of_tiles():
    assert list(tiles.slices(np.array([5, 5, 20, 1, 1]), 10)) == [(0, 2), (2, 1), (3, 2)]
    assert list(tiles.slices(np.zeros(5000, int), 10)) == [(0, 4096), (4096, 904)]


def test_crowded_tiles_in_a_layer_file(spark, tmp_path):
    spark.range(MANY).select((F.col("id") * 64).alias("o_orderkey")).write.parquet(f"{tmp_path}/orders.parquet")
    assert [tuple(r) for r in catalog.QUERIES["q_check"](spark, str(tmp_path)).collect()] == [(1, 1, 0, None)]
    assert catalog.QUERIES["q_decode_tiles"](spark, str(tmp_path)).count() == MANY
