"""Benchmark decontamination by greedy string tiling, which also finds passages whose parts were put in another order."""

from __future__ import annotations

import re
import string
from functools import reduce

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_in_arrow, content_id, stored, table, text_or_empty
from .words import MIX, Words, shingles

#: Words of a seed, and the fewest that a tile may have; an item of fewer words is one seed and one tile.
SEED_WORDS = 5
#: Share of an item's words that tiles must cover.
COVERAGE = 0.8
#: Seeds of the items that the documents meet in one pass; a larger benchmark is met in as many passes as it takes.
SEEDS_PER_PASS = 1_000_000
PUNCTUATION = string.punctuation.encode()
#: Letters of scripts without spaces (Thai, Lao, Burmese, Khmer, kana, Han): each is a word.
SPACELESS = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")


class PlainWords(Words):
    """Hashes of a text's words in lower case, without ASCII punctuation; letters of scripts without spaces are words."""

    def __call__(self, text: str | None) -> np.ndarray:
        text = (text or "").lower()
        if not text.isascii():
            text = SPACELESS.sub(r" \g<0> ", text)
        return super().__call__(text.encode("utf-8", "surrogatepass").translate(None, PUNCTUATION).decode("utf-8", "surrogatepass"))


class Rolling:
    """Karp-Rabin sums of a word sequence: the hash of each run rolls from the last one's."""

    def __init__(self, words: np.ndarray, scale: int):
        self.words, self.scale = words, scale  # hashes of texts compare if `scale`, which no text's length exceeds, is the same
        with np.errstate(over="ignore"):
            self.power = np.cumprod(np.full(scale + 1, MIX, np.uint64))
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * self.power[: len(words)])])

    def hashes(self, starts: np.ndarray, size) -> np.ndarray:
        """Hashes of the runs of `size` words from the starts."""
        with np.errstate(over="ignore"):
            return (self.sums[starts + size] - self.sums[starts]) * self.power[self.scale - starts]

    def windows(self, free: np.ndarray, size: int) -> np.ndarray:
        """Starts of the runs of `size` words that hold no marked word."""
        if len(self.words) < size:
            return np.zeros(0, np.int64)
        marked = np.concatenate([[0], np.cumsum(~free)])
        return np.flatnonzero(marked[size:] == marked[:-size])


def _ahead(free: np.ndarray) -> np.ndarray:
    """From each place on the number of words up to the next marked one."""
    marked = np.append(np.flatnonzero(~free), len(free))
    return marked[np.searchsorted(marked, np.arange(len(free)))] - np.arange(len(free))


def _before(words: np.ndarray, free: np.ndarray, starts: np.ndarray, other: int) -> np.ndarray:
    """A number for the free word before each start, equal for equal words; `other` where there is none."""
    out = np.full(len(starts), other, np.int64)
    has = starts > 0
    has[has] = free[starts[has] - 1]
    out[has] = words[starts[has] - 1].view(np.int64)
    return out


def maximal_matches(item: Rolling, text: Rolling, free_p: np.ndarray, free_t: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths and starts (in item, in text) of the matches of `size` free words or more that cannot grow at either end.

    Windows of one hash are paired only where the words before them differ: within a repeated passage nearly all pairs
    are parts of a longer match and are never formed. Lengths are found by halving, by the hashes of the runs.
    """
    at_p, at_t = item.windows(free_p, size), text.windows(free_t, size)
    hash_p, hash_t = item.hashes(at_p, size), text.hashes(at_t, size)
    shared = np.intersect1d(hash_p, hash_t)
    none = np.zeros(0, np.int64)
    if not len(shared):
        return none, none, none
    in_p, in_t = np.isin(hash_p, shared), np.isin(hash_t, shared)
    at_p, hash_p, at_t, hash_t = at_p[in_p], hash_p[in_p], at_t[in_t], hash_t[in_t]
    last_p, last_t = _before(item.words, free_p, at_p, -1), _before(text.words, free_t, at_t, -2)
    order_p, order_t = np.lexsort((at_p, last_p, hash_p)), np.lexsort((at_t, last_t, hash_t))
    at_p, hash_p, last_p, at_t, hash_t, last_t = at_p[order_p], hash_p[order_p], last_p[order_p], at_t[order_t], hash_t[order_t], last_t[order_t]
    pairs_p, pairs_t = [none], [none]
    runs = np.flatnonzero(np.concatenate([[True], (hash_p[1:] != hash_p[:-1]) | (last_p[1:] != last_p[:-1])]))
    low, high = np.searchsorted(hash_t, hash_p[runs], "left"), np.searchsorted(hash_t, hash_p[runs], "right")
    for a, b, lo, hi in zip(runs.tolist(), np.append(runs[1:], len(at_p)).tolist(), low.tolist(), high.tolist(), strict=True):
        same = last_t[lo:hi] == last_p[a]
        apart = at_t[lo:hi][~same]
        pairs_p.append(np.repeat(at_p[a:b], len(apart)))
        pairs_t.append(np.tile(apart, b - a))
    j, k = np.concatenate(pairs_p), np.concatenate(pairs_t)
    if not len(j):
        return none, none, none
    least, most = np.full(len(j), size), np.minimum(_ahead(free_p)[j], _ahead(free_t)[k])
    while (least < most).any():
        middle = (least + most + 1) // 2
        equal = item.hashes(j, middle) == text.hashes(k, middle)
        least, most = np.where(equal, middle, least), np.where(equal, most, middle - 1)
    return least, j, k


def greedy_tiles(item: np.ndarray, text: np.ndarray, least: int = SEED_WORDS) -> list[tuple[int, int, int]]:
    """Tiles (start in item, start in text, length): longest matches first, none sharing a word with another.

    Running Karp-Rabin: windows of the search length are looked up by hash and grown to maximal matches. If one is
    more than twice the search length, the search starts again at its length; else the matches are marked, the longest
    first and those in part taken left to the next, shorter length, until `least` is done.
    """
    free_p, free_t, tiles = np.ones(len(item), bool), np.ones(len(text), bool), []
    if min(len(item), len(text)) < least:
        return tiles
    size, scale = max(least, min(20, len(item), len(text))), max(len(item), len(text))
    sums_p, sums_t = Rolling(item, scale), Rolling(text, scale)
    while True:
        length, at_p, at_t = maximal_matches(sums_p, sums_t, free_p, free_t, size)
        if (longest := int(length.max(initial=0))) > 2 * size:
            size = longest
            continue
        marked = False
        order = np.lexsort((at_t, at_p, -length))
        for n, j, k in zip(length[order].tolist(), at_p[order].tolist(), at_t[order].tolist(), strict=True):
            if free_p[j] and free_t[k] and free_p[j : j + n].all() and free_t[k : k + n].all():
                free_p[j : j + n] = free_t[k : k + n] = False
                tiles.append((j, k, n))
                marked = True
        if not marked:
            if size == least:
                return tiles
            size = max(least, size // 2)


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, least: int = SEED_WORDS, seeds_per_pass: int = SEEDS_PER_PASS) -> DataFrame:
    """All columns of `docs` with `items`: an array of (item_id, item_words, tiled_words) of the benchmark items whose
    words the tiles between item and text cover to `coverage` or more.

    Words are compared in lower case and without ASCII punctuation. Documents and items meet where they share a seed,
    `least` words in a row; items in which the shared seeds reach less than `coverage` are passed over, as no tiling
    can cover more. An item of fewer than `least` words is a seed as a whole. Null and empty texts hold no
    items, null item texts are in no text. Repeated item rows are reported each. The benchmark goes to the tasks in
    parts of about `seeds_per_pass` seeds, one pass over the documents for each: only one part is held at a time, and
    where there are several, each pass stores what it found and the texts get theirs by their content in the end.
    """
    items = benchmark.select(F.col("item_id"), F.col("text").alias("item"))
    total = items.agg(F.sum(F.length("item"))).first()[0] or 0
    passes = max(1, -(-total // (4 * seeds_per_pass)))
    kind, spark = items.schema["item_id"].dataType.simpleString(), docs.sparkSession
    shape = f"array<struct<item_id:{kind},item_words:int,tiled_words:int>>"

    def one_pass(rows: DataFrame, part: DataFrame) -> tuple[DataFrame, Broadcast]:
        """`rows` with `items`, what they hold of this part of the benchmark."""
        shared = spark.sparkContext.broadcast(sorted(((r["item_id"], r["item"]) for r in part.collect()), key=lambda r: (r[1] or "", str(r[0]))))

        def work():
            words, known = PlainWords(), [(i, t) for i, t in shared.value]
            tokens = [words(t) for _, t in known]
            seeds = [shingles(x, least) for x in tokens]
            sizes = sorted({min(least, len(x)) for x in tokens if len(x)})
            flat = np.concatenate([*seeds, np.zeros(0, np.uint64)])
            order = np.argsort(flat, kind="stable")
            flat, of = flat[order], np.repeat(np.arange(len(seeds)), [len(x) for x in seeds])[order]
            at = np.concatenate([*(np.arange(len(x)) for x in seeds), np.zeros(0, int)]).astype(np.int64)[order]
            table_ = np.zeros(1 << 20, bool)
            table_[(flat >> np.uint64(44)).astype(np.int64)] = True

            def tiled(text: str | None) -> list:
                x = words(text)
                if not len(flat) or len(x) < sizes[0]:
                    return []
                h = np.concatenate([shingles(x, n) for n in sizes if n <= len(x)])
                h = np.unique(h[table_[(h >> np.uint64(44)).astype(np.int64)]])
                low, high = np.searchsorted(flat, h, "left"), np.searchsorted(flat, h, "right")
                hit = np.concatenate([*(np.arange(a, b) for a, b in zip(low, high, strict=True) if b > a), np.zeros(0, int)]).astype(np.int64)
                found = []
                for item in np.unique(of[hit]).tolist():
                    reach = np.zeros(len(tokens[item]), bool)
                    seed = min(least, len(reach))
                    for j in range(seed):
                        reach[at[hit[of[hit] == item]] + j] = True
                    if reach.sum() >= coverage * len(reach):
                        n = sum(t[2] for t in greedy_tiles(tokens[item], x, seed))
                        if n >= coverage * len(reach):
                            found.append({"item_id": known[item][0], "item_words": len(reach), "tiled_words": n})
                return found

            return lambda texts: [list(map(tiled, texts))]

        return add_in_arrow(rows, ["text"], {"items": shape}, work), shared

    if passes == 1:
        return one_pass(docs, items)[0]
    found = []
    for k in range(passes):
        rows, shared = one_pass(docs.select("text"), items.filter(F.pmod(F.xxhash64("item"), F.lit(passes)) == k))
        rows = rows.filter(F.size("items") > 0).select(content_id(text_or_empty()).alias("__tp_of"), "items")
        found.append(stored(rows.groupBy("__tp_of").agg(F.first("items").alias("items")), "tiled-items"))  # equal texts hold equal items
        shared.destroy()
    held = stored(reduce(DataFrame.union, found).groupBy("__tp_of").agg(F.flatten(F.collect_list("items")).alias("__tp_items")), "tiled-items")
    out = docs.withColumn("__tp_id", content_id(text_or_empty())).join(held, F.col("__tp_id") == F.col("__tp_of"), "left")
    return out.withColumn("items", F.coalesce("__tp_items", F.array().cast(shape))).drop("__tp_id", "__tp_of", "__tp_items")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs of a document and a benchmark item that it contains; clean documents have no row."""
    out = contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", F.explode("items").alias("x")).select("doc_id", "x.item_id", "x.item_words", "x.tiled_words")
