from terrapack.functions import constants as k
from terrapack.operators import tiles
from terrapack.plans import packs
from terrapack.streaming import retile

LEVELS = k.WATER_LEVELS[:1]


def test_stream_equals_batch(spark, tmp_path):
    features = packs.synthetic(spark, 28.0, -82.0, 30.0, 3, 24)
    for n in (0, 1):
        features.filter(f"ord.a % 2 = {n}").coalesce(1).write.parquet(f"{tmp_path}/in/part{n}")
    stream = spark.readStream.schema(features.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    q = retile.retile(stream, f"{tmp_path}/features", f"{tmp_path}/tiles", LEVELS).option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    newest = {}
    for t in spark.read.parquet(f"{tmp_path}/tiles").orderBy("batch").collect():
        newest[t.key] = bytes(t.blob)
    assert newest == {t.key: bytes(t.blob) for t in tiles.tiles_of(features, LEVELS).collect()}
