"""Quality classifier: naive Bayes support vectors.

Indicators of word n-grams, scaled by the log-count ratios of the two classes, feed a linear hinge-loss model that dual
coordinate descent fits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_in_arrow, stored, table
from .words import MIX, REMEMBERED, shape

#: Labelled rows that the model is fitted on: those of smallest hash, so many at most.
TRAIN_ROWS = 6000
BITS = 18
#: Weight of the hinge losses, passes over the rows, and the count that smooths the ratios.
COST, PASSES, SMOOTH = 1.0, 12, 1.0


class Indicators:
    """Sorted indices of the n-grams of a text: words and pairs of words, and one to three word shapes.

    A word that repeats the one before has a shape of its own. The case of letters counts. Words are hashed into
    2**BITS indices; no words, no indices.
    """

    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.hashes = np.zeros((2, 1 << 12), np.uint64)

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").split()
        if not words:
            return np.zeros(0, np.int32)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        new = set(words).difference(known)
        while len(known) + len(new) > self.hashes.shape[1]:
            self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)], axis=1)
        for w in new:
            k = known[w] = len(known)
            self.hashes[0, k] = xxhash.xxh64_intdigest(w)
            self.hashes[1, k] = xxhash.xxh64_intdigest(shape(w), 7)
        at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        w, s = self.hashes[0][at], self.hashes[1][at].copy()
        s[1:][at[1:] == at[:-1]] = 99
        grams = [w, w[:-1] * MIX + w[1:], s, s[:-1] * MIX + s[1:], (s[:-2] * MIX + s[1:-1]) * MIX + s[2:]]
        mixed = np.concatenate([(g + np.uint64(k)) * MIX for k, g in enumerate(grams)])
        return np.unique((mixed ^ (mixed >> np.uint64(31))) * MIX >> np.uint64(64 - BITS)).astype(np.int32)


def log_count_ratios(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """For each index the log of its share among good rows' indicators over that among bad rows'."""
    size = 1 << BITS
    counts = [np.full(size, SMOOTH), np.full(size, SMOOTH)]
    for x, y in zip(rows, good, strict=True):
        counts[int(y)][x] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def dual_coordinate_descent(rows: list[np.ndarray], ratios: np.ndarray, scale: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Weights, the last for a constant 1, that minimise |w|^2 / 2 + COST * sum of hinge losses, one dual at a time.

    A row's values are the ratios of its indices times its scale; they are looked up, not kept.
    """
    w, y = np.zeros((1 << BITS) + 1), np.where(good, 1.0, -1.0)
    dual, square = np.zeros(len(rows)), np.array([float((ratios[x] * s) @ (ratios[x] * s)) + 1 for x, s in zip(rows, scale, strict=True)])
    random = np.random.default_rng(20)
    for _ in range(PASSES):
        moved = 0.0
        for k in random.permutation(len(rows)):
            x = rows[k]
            v = ratios[x] * scale[k]
            slope = y[k] * (w[x] @ v + w[-1]) - 1
            new = min(max(dual[k] - slope / square[k], 0.0), COST)
            if (step := new - dual[k]) != 0:
                dual[k] = new
                w[x] += step * y[k] * v
                w[-1] += step * y[k]
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w


def calibration(margins: np.ndarray, good: np.ndarray) -> float:
    """The factor of the margin in a logistic score whose threshold stays at margin 0, by Newton steps on its loss."""
    a, z = 1.0, np.where(good, margins, -margins)
    for _ in range(30):
        p = 1 / (1 + np.exp(np.clip(a * z, -50, 50)))
        curve = (z * z * p * (1 - p)).sum() + 1e-3
        a = min(max(a + ((z * p).sum() - 1e-3 * (a - 1)) / curve, 0.1), 50.0)
    return float(a)


def fit(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """Ratios, weights and calibration from a bounded number of rows (text, good boolean, and a long `order`)."""

    def indicators(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = Indicators()
        for b in batches:
            yield pd.DataFrame({"good": b["good"], "order": b["order"], "x": [of(t) for t in b["text"]]})

    got = labelled.select("text", "good", "order").mapInPandas(indicators, "good boolean, order long, x array<int>").toArrow().combine_chunks()
    lists = got["x"].chunk(0) if got["x"].num_chunks else None
    if lists is None or not len(lists):
        return np.zeros(1 << BITS), np.append(np.zeros(1 << BITS), -1.0), 1.0
    flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
    good, at = np.array(got["good"], bool), np.lexsort((np.array(got["good"], bool), np.array(got["order"])))
    rows, good = [flat[ends[k] : ends[k + 1]] for k in at.tolist()], good[at]
    if good.all() or not good.any():
        return np.zeros(1 << BITS), np.append(np.zeros(1 << BITS), 1.0 if good.all() else -1.0), 1.0
    ratios = log_count_ratios(rows, good)
    scale = np.array([1 / max(float(np.sqrt(ratios[x] @ ratios[x])), 1e-9) for x in rows])
    w = dual_coordinate_descent(rows, ratios, scale, good)
    return ratios, w, calibration(np.array([w[x] @ ratios[x] * s + w[-1] for x, s in zip(rows, scale, strict=True)]), good)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """All columns of `docs` with held_out, score (0 to 1, higher: good likelier) and predicted (score >= 0.5).

    It learns from labelled rows that are not held out, at most `train_rows` of them by a hash of the id, chosen by
    their ids before a text is read; nothing but the text enters a score. Null labels and null ids teach nothing, and
    of rows that share an id and a label one does. Null and empty texts
    have the score of a text without indicators. Without labels of both kinds the score is the same for all texts.
    """
    marked = labels.filter(F.col("quality").isNotNull()).select(F.col("doc_id").alias("__tp_doc"), (F.col("quality") == 1).alias("good"))
    ids = docs.select("doc_id").filter(~held_out(F.col("doc_id"))).join(marked, F.col("doc_id") == F.col("__tp_doc")).select("doc_id", "good").distinct()
    chosen = stored(ids.orderBy(F.xxhash64("doc_id"), "doc_id", "good").limit(train_rows), "quality-sample")
    train = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "good").agg(F.min("text").alias("text"))
    ratios, w, factor = fit(train.select("text", "good", F.xxhash64("doc_id").alias("order")))
    weights, bias, ratios = (w[:-1] * ratios).astype(np.float64), float(w[-1]), ratios.astype(np.float32)
    shared = docs.sparkSession.sparkContext.broadcast((weights, (ratios.astype(np.float64)) ** 2))

    def scores():
        of, (toward, square) = Indicators(), shared.value

        def score(texts: list) -> list:
            found = map(of, texts)
            margins = np.array([toward[x].sum() / max(float(np.sqrt(square[x].sum())), 1e-9) + bias for x in found])
            return [1 / (1 + np.exp(-np.clip(factor * margins, -50, 50)))]

        return score

    out = add_in_arrow(docs, ["text"], {"score": "double"}, scores)
    return out.withColumns({"held_out": held_out(F.col("doc_id")), "predicted": (F.col("score") >= 0.5).cast("int")})


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = classify(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")
