"""Exact top-k search by a Voronoi join: queries and data are grouped by pivots, bounds from the groups' summaries tell
which groups a query must meet, and each group is solved by itself."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

NEIGHBOURS = 10
#: Pivots are data rows, those of smallest hash; so many at most, at any size of input.
PIVOTS = 64
#: Vectors of one cell that one task solves together; larger cells are dealt into blocks by a hash.
BLOCK_ROWS = 4096
#: Queries that a block meets at once.
QUERY_ROWS = 512
SCALE = 1024


def grid(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, as longs."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    """Neither null nor holding a null, NaN or infinite component."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    return vector.isNotNull() & ~F.coalesce(F.exists(vector, bad), F.lit(True))


def _matrix(vectors, width: int) -> np.ndarray:
    """Rows of equal width; a shorter vector is filled up with zeros, which add nothing to a product."""
    out = np.zeros((len(vectors), width))
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of rows: in doubles while no sum can reach 2**53, else in longs."""
    bound = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    return (a @ b.T).astype(np.int64) if bound < 2**53 else a.astype(np.int64) @ b.astype(np.int64).T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id, in no order of their own."""
    if len(scores) <= k:
        return np.arange(len(scores))
    cut = -np.partition(-scores, k - 1)[k - 1]
    sure, tied = np.flatnonzero(scores > cut), np.flatnonzero(scores == cut)
    return np.concatenate([sure, tied[np.argsort(ids[tied], kind="stable")[: k - len(sure)]]])


def top_k(vectors: DataFrame, is_query: Column, k: int = NEIGHBOURS, pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its k best rows of `vectors` (vec_id, v: array of longs).

    Score is the inner product. Every row but the query's own is a candidate, whatever its group; rows that share a
    vec_id are the same to a query and all but the query's own id stay candidates; of queries that share a vec_id the
    one of the least vector counts. Rows with a null vec_id or v take no part. Fewer candidates than k: all of them.

    A cell is what lies nearest to a pivot; its summary is the pivot, the radius and the count. For a query q and a
    cell of pivot p and radius r no product exceeds <q, p> + |q| r, and the k-th best product with the pivots, which
    are rows, is a bound from below. A query goes to the cells whose bound from above reaches that from below: the
    queries, the smaller side, are replicated and the data stay in their cells.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).select("vec_id", "v")
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(pivots).collect()
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    if not chosen:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    centres, centre_ids = _matrix([x["v"] for x in chosen], width), np.array([x["vec_id"] for x in chosen])
    half, longest = (centres**2).sum(1) / 2, np.sqrt((centres**2).sum(1).max())

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = _matrix(b["v"].to_numpy(), width)
            cell = (x @ centres.T - half).argmax(1) if len(b) else np.zeros(0, int)
            far = np.sqrt(((x - centres[cell]) ** 2).sum(1))
            yield b.assign(cell=cell.astype(np.int32), far=far)

    data = stored(rows.mapInPandas(cells, "vec_id long, v array<long>, cell int, far double"), "knn-cells")
    summary = {x["cell"]: (x["far"], x["n"]) for x in data.groupBy("cell").agg(F.max("far").alias("far"), F.count("*").alias("n")).collect()}
    seen = np.array(sorted(summary))
    radius, blocks = np.array([summary[c][0] for c in seen]), np.array([-(-summary[c][1] // block_rows) for c in seen])

    def needed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            q, ids = _matrix(b["v"].to_numpy(), width), b["vec_id"].to_numpy()
            known = np.where(ids[:, None] == centre_ids[None, :], -np.inf, q @ centres.T)
            below = -np.partition(-known, k - 1, axis=1)[:, k - 1] if known.shape[1] >= k else np.full(len(b), -np.inf)
            below = below - 1e-9 * (1 + np.sqrt((q**2).sum(1)) * longest)  # products beyond 2**53 are rounded here, and exact in the cells
            above = q @ centres[seen].T + np.sqrt((q**2).sum(1))[:, None] * radius[None, :]
            slack = 1e-9 * (1 + np.sqrt((q**2).sum(1))[:, None] * (longest + radius[None, :]))
            at, cell = np.nonzero(above + slack >= below[:, None])
            times = blocks[cell]
            at, cell = np.repeat(at, times), np.repeat(cell, times)
            block = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
            yield pd.DataFrame({"vec_id": ids[at], "v": b["v"].to_numpy()[at], "cell": seen[cell].astype(np.int32), "block": block.astype(np.int32), "below": below[at]})

    def solve(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(left) and len(right):
            x, ids = _matrix(left["v"].to_numpy(), width), left["vec_id"].to_numpy()
            for lo in range(0, len(right), QUERY_ROWS):
                part = right.iloc[lo : lo + QUERY_ROWS]
                for q, below, scores in zip(part["vec_id"], part["below"], _products(_matrix(part["v"].to_numpy(), width), x), strict=True):
                    ok = np.flatnonzero((scores >= below) & (ids != q))
                    ok = ok[_best(scores[ok], ids[ok], k)]
                    out["query_id"].append(np.full(len(ok), q))
                    out["vec_id"].append(ids[ok])
                    out["score"].append(scores[ok])
        return pd.DataFrame({c: np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64) for c, v in out.items()})

    parts = F.element_at(F.array(*(F.lit(int(blocks[np.searchsorted(seen, c)])) if c in summary else F.lit(1) for c in range(len(chosen)))), F.col("cell") + 1)
    data = data.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), parts).cast("int"))
    asked = data.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v")).mapInPandas(needed, "vec_id long, v array<long>, cell int, block int, below double")
    found = data.groupBy("cell", "block").cogroup(asked.groupBy("cell", "block")).applyInPandas(solve, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").filter(usable(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), grid(F.col("embedding")).alias("v"))
    return top_k(rows, F.col("vec_id") % 100 == 0)


ORACLE = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM e q JOIN e d ON q.vec_id <> d.vec_id WHERE q.vec_id % 100 = 0
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
