"""The training-data queries on the small tables: against SQL where SQL expresses them, and the pipeline's stages."""

import collections

import corpus_pipeline
import duckdb
import pytest

from terrapack.llm import queries

SMALL = "/root/testdata/sf0.001"


def values(df):
    cols = sorted(df.columns)
    return sorted((tuple(r) for r in df[cols].astype(object).where(df[cols].notna(), None).values.tolist()), key=repr)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    got = queries.QUERIES[name](spark, SMALL).toPandas()
    assert len(got) > 0
    if name in queries.ORACLES:
        c = duckdb.connect()
        for t in ("documents", "embeddings"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
        assert values(got) == values(c.sql(queries.ORACLES[name]).df()[got.columns])


def test_pipeline(spark):
    docs, counts = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SMALL), name.replace(" ", "-"))
        assert docs.columns == columns
        counts.append(docs.count())
        if name.startswith("benchmark"):
            distinct = [r.doc_id for r in docs.collect()]
            assert len(distinct) == len(set(distinct))
    assert counts[0] > counts[1] > counts[2] > 0
    out = corpus_pipeline.run(spark, SMALL).collect()
    assert len(out) == counts[3]
    slots = collections.defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_pipeline_on_no_documents(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
