"""Suffix-array dedup: bytes that lie in a string which also starts elsewhere are removed.

Suffixes are grouped by their Lyndon prefixes: groups are processed in descending order along pointers to the previous
smaller group, and each group's order is then emitted in one ascending pass, without recursion or renaming.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_in_arrow, content_id, stored, table, text_or_empty
from .words import MIX

#: Bytes of a string that counts.
LENGTH = 200
#: Bytes of the print that stands for a string; each string's least print is the same wherever the string is.
PRINT = 48
#: Starts, in blocks around the print, whose strings are told apart by what all of the block share; the last one is
#: a block of single strings.
BLOCKS = (32, 8, 1)
#: Different pieces of one block that are sorted together; larger groups are told apart in smaller blocks.
SORTED_PIECES = 256
#: Positions whose prints are taken at once.
STRETCH = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)


def suffix_array(t: list[int]) -> list[int]:
    """Starts of the suffixes of t in order; t ends in a value that is smaller than all others."""
    n = len(t)
    counts: dict[int, int] = {}
    for c in t:
        counts[c] = counts.get(c, 0) + 1
    size, first, at = [0] * (n + 1), {}, 0
    for c in sorted(counts):
        first[c], size[at] = at, counts[c]
        at += counts[c]
    group = [first[c] for c in t]
    sa, place, fill = [0] * n, [0] * n, dict(first)
    for s, c in enumerate(t):
        k = fill[c]
        sa[k], place[s], fill[c] = s, k, k + 1
    prev = [-1] * n
    end = n - 1
    while end >= 0:
        start = group[sa[end]]
        members = sa[start : end + 1]
        after: dict[int, int] = {}
        heads = []
        for s in members:
            p = s - 1
            while p >= 0 and group[p] > start:
                p = prev[p]
            if p >= 0 and group[p] == start:
                after[p] = s
            else:
                heads.append((s, p))
        # Those that follow their own kind have the root's pointer; the root's group is split by how often it is repeated.
        by_times: dict[int, list[int]] = {}
        for s, p in heads:
            times, x = 1, s
            prev[x] = p
            while after and x in after:
                x = after[x]
                prev[x] = p
                times += 1
            if p >= 0:
                by_times.setdefault(times, []).append(p)
        for times in sorted(by_times, reverse=True):
            moved = by_times[times]
            for p in moved:
                g = group[p]
                e, k = g + size[g] - 1, place[p]
                o = sa[e]
                sa[k], place[o] = o, k
                sa[e], place[p] = p, e
                size[g] -= 1
            new = [group[p] + size[group[p]] for p in moved]
            for p, g in zip(moved, new, strict=True):
                group[p] = g
                size[g] += 1
        end = start - 1
    out, done = [0] * n, bytearray(n)
    out[0] = n - 1
    done[n - 1] = 1
    fill_at = list(range(n + 1))
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not done[s]:
            g = group[s]
            out[fill_at[g]] = s
            fill_at[g] += 1
            done[s] = 1
            s = prev[s]
    return out


def repeated_starts(pieces: list[list[int]], length: int = LENGTH) -> list[np.ndarray]:
    """For each piece the sorted starts of its strings of that length that start more than once in all pieces.

    Pieces are lists of symbols from 2 on; a symbol that ends them all and one that ends the text sort before them.
    """
    t, base = [], []
    for piece in pieces:
        base.append(len(t))
        t += piece
        t.append(1)
    t.append(0)
    room = np.zeros(len(t), bool)
    for b, piece in zip(base, pieces, strict=True):
        room[b : b + max(0, len(piece) - length + 1)] = True
    order = np.array(suffix_array(t), np.int64)
    order = order[room[order]].tolist()
    marked = np.zeros(len(t), bool)
    for p, q in zip(order, order[1:], strict=False):
        if t[p : p + length] == t[q : q + length]:
            marked[p] = marked[q] = True
    return [np.flatnonzero(marked[b : b + len(piece)]) for b, piece in zip(base, pieces, strict=True)]


class Prints:
    """The least prints of a text's strings: for each stretch of starts that share one, its first and last start, the
    print's hash and its place. In a run of bytes that repeat at a short distance the stretches repeat each other; of
    such a chain only the first counts, and `sure` has the starts of the whole chain, all of which repeat."""

    def __init__(self, length: int = LENGTH, size: int = PRINT):
        self.length, self.size = length, size
        with np.errstate(over="ignore"):
            self.power = np.cumprod(np.array([1] + [_BASE] * (STRETCH + length), np.uint64))
            self.unpower = np.cumprod(np.array([1] + [_UNBASE] * (STRETCH + length), np.uint64))

    def _hashes(self, raw: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.power[: len(raw)])])
            h = (sums[self.size :] - sums[: -self.size]) * self.unpower[: len(raw) - self.size + 1]
            h = (h ^ (h >> np.uint64(32))) * MIX
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            return h ^ (h >> np.uint64(32))

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int]]]:
        out: tuple[list, list, list, list] = ([], [], [], [])
        sure: list[tuple[int, int]] = []
        last = -1
        width = self.length - self.size + 1
        for lo in range(0, max(len(text) - self.length + 1, 0), STRETCH):
            raw = np.frombuffer(text[lo : lo + STRETCH + self.length - 1], np.uint8)
            h = self._hashes(raw)
            # Leading bits of the hash and the position in one number: the least is the leftmost of the least hashes.
            packed = (h & ~np.uint64(0x1FFFFF)) | np.arange(len(h), dtype=np.uint64)
            pad = -len(packed) % width
            block = np.concatenate([packed, np.full(pad, np.uint64(2**64 - 1))]).reshape(-1, width)
            ahead = np.minimum.accumulate(block, axis=1).ravel()
            back = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
            n = len(raw) - self.length + 1
            at = (np.minimum(back[:n], ahead[width - 1 : width - 1 + n]) & np.uint64(0x1FFFFF)).astype(np.int64)
            new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            high, place = np.append(new[1:], n) - 1, at[new]
            first = self._chains(raw, new, high, place)
            if len(first) < len(new):
                stop = high[np.append(first[1:], len(new)) - 1]
                sure += [(lo + a, lo + b) for a, b, k in zip(new[first].tolist(), stop.tolist(), np.diff(np.append(first, len(new))).tolist(), strict=True) if k > 1]
            new, high, place = new[first], high[first], place[first]
            if out[0] and lo + int(place[0]) == last == out[3][-1][-1]:  # the stretch of starts goes on from the text before
                out[1][-1][-1] = lo + high[0]
                new, high, place = new[1:], high[1:], place[1:]
            if len(new):
                for x, y in zip(out, (lo + new, lo + high, h[place], lo + place), strict=True):
                    x.append(y)
            last = lo + int(at[-1])
        none = np.zeros(0, np.int64)
        lows, highs, keys, places = (np.concatenate([*x, none.astype(x[0].dtype if x else np.int64)]) for x in out)
        return lows, highs, keys, places, sure

    def _chains(self, raw: np.ndarray, low: np.ndarray, high: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Of stretches one after another those that do not repeat the one before, byte for byte."""
        step = np.diff(low)
        alike = (step == np.diff(place)) & (np.diff(high - low) == 0) & (step < self.length)
        for d in np.unique(step[alike]).tolist():
            k = np.flatnonzero(alike & (step == d))
            other = np.concatenate([[0], np.cumsum(raw[d:] != raw[:-d])])  # bytes that differ from the one d on
            alike[k] = other[high[k] + self.length] == other[low[k]]
        return np.flatnonzero(np.concatenate([[True], ~alike]))


def _utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def pieces(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(tid, keys, pieces, lows, highs, prints, sure): for each stretch of starts that share a print, the print's hash, the
    hash of the stretch's bytes, its first and last start, and how far from the first the print is; and the runs of
    starts that repeat within the text at a short distance."""

    def work():
        prints = Prints(length)

        def made(texts: list) -> list:
            out = ([], [], [], [], [], [])
            for t in texts:
                raw = _utf8(t)
                low, high, keys, place, sure = prints(raw)
                hashes = [int.from_bytes(hashlib.blake2b(raw[a:b], digest_size=8).digest(), "little", signed=True) for a, b in zip(low.tolist(), (high + length).tolist(), strict=True)]
                for x, y in zip(out, (keys.view(np.int64).tolist(), hashes, low.tolist(), high.tolist(), (place - low).tolist(), [{"first": a, "last": b} for a, b in sure]), strict=True):
                    x.append(y)
            return list(out)

        return made

    rows = add_in_arrow(docs.select("text"), ["text"], {"keys": "array<bigint>", "pieces": "array<bigint>", "lows": "array<bigint>", "highs": "array<bigint>", "prints": "array<int>", "sure": "array<struct<first:bigint,last:bigint>>"}, work)
    return rows.select(content_id(text_or_empty()).alias("tid"), "keys", "pieces", "lows", "highs", "prints", "sure")


def each_piece(rows: DataFrame) -> DataFrame:
    parts = F.arrays_zip(F.col("keys").alias("key"), F.col("pieces").alias("piece"), F.col("lows").alias("lo"), F.col("highs").alias("hi"), F.col("prints").alias("print"))
    return rows.filter(F.size("keys") > 0).select("tid", F.explode(parts).alias("x")).select("tid", "x.key", "x.piece", "x.lo", "x.hi", "x.print")


def sorted_repeats(found: DataFrame, block: int, spread: int) -> DataFrame:
    """(key, piece, offs): starts in pieces of strings that repeat, from suffix arrays over the pieces of each key.

    `found` are (key, piece, times, ahead, behind) with few pieces for each key. All strings of a key hold the bytes
    between ahead and behind, which are the same in all its pieces: they are one symbol, and a string is then as long
    as the block has starts. Of pieces that occur once, the offsets count.
    """
    shared = 258  # above all bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, rows = None, [], []

        def done() -> None:
            if len(held) > 1:
                starts = repeated_starts([x[2] for x in held], block)
                rows.extend((key, piece, s.tolist()) for (piece, times, _), s in zip(held, starts, strict=True) if times == 1 and len(s))

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.list_(pa.int64()))], names=["key", "piece", "offs"])

        for b in batches:
            for k, piece, times, ahead, behind in zip(*(b.column(c).to_pylist() for c in ("key", "piece", "times", "ahead", "behind")), strict=True):
                if k != key:
                    done()
                    key, held = k, []
                held.append((piece, times, [c + 2 for c in ahead] + [shared] + [c + 2 for c in behind]))
            yield told()
            rows.clear()
        done()
        yield told()

    rows = found.repartition(spread, "key").sortWithinPartitions("key", "piece").select("key", "piece", "times", "ahead", "behind")
    return rows.mapInArrow(run, "key long, piece long, offs array<long>")


def in_blocks(cuts: DataFrame, block: int, length: int) -> DataFrame:
    """(key, piece, times, first, last, core, part, bytes): the starts first to last of each piece, a row for each block.

    Equal strings stand alike to their print, so blocks are laid from the print on. `part` is the hash of the bytes that
    all strings of the whole block share, with key and block, and `core` their start; `bytes` is the hash of the row's
    own bytes. `cuts` are
    (key, piece, times, print, raw, first, last).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short = lambda raw: int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)
        for b in batches:
            out = ([], [], [], [], [], [], [], [])
            for key, piece, times, at, raw, first, last in zip(*(b.column(c).to_pylist() for c in ("key", "piece", "times", "print", "raw", "first", "last")), strict=True):
                for n in range((at - last) // block, (at - first) // block + 1):
                    u, v = max(first, at - block * n - block + 1), min(last, at - block * n)
                    core = raw[at - block * n : at - block * n - block + 1 + length]
                    for x, y in zip(out, (key, piece, times, u, v, at - block * n, short(core + b"%d %d" % (key, n)), short(raw[u : v + length] + b"%d" % (at - u))), strict=True):
                        x.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["key", "piece", "times", "first", "last", "core", "part", "bytes"])

    return cuts.select("key", "piece", "times", "print", "raw", "first", "last").mapInArrow(run, "key long, piece long, times long, first long, last long, core long, part long, bytes long")


def repeated_offsets(cuts: DataFrame, length: int, most: int, spread: int) -> list[DataFrame]:
    """Tables (key, piece, first, last): starts in pieces that occur once of strings that repeat in other pieces.

    Pieces are first parted by what all strings of a block share, and those that share it are sorted by their
    suffixes. Where more than `most` different ones do, as at the ends of a very common passage, smaller blocks part
    them, down to single strings; a block that occurs twice is repeated as it is. No key gathers more than `most`.
    """
    told, todo = [], cuts.withColumns({"first": F.lit(0).cast("long"), "last": F.length("raw").cast("long") - length})
    for block in BLOCKS:
        rows = stored(in_blocks(todo, block, length), "blocks")
        times = rows.groupBy("part", "bytes").agg(F.sum("times").alias("n"))
        parts = times.groupBy("part").agg(F.sum("n").alias("all"), F.count("*").alias("kinds"), F.min("n").alias("least")).filter(F.col("all") > 1)
        met = stored(rows.join(times.join(parts, "part"), ["part", "bytes"]), "blocks-met")
        told.append(met.filter((F.col("n") > 1) & (F.col("times") == 1)).select("key", "piece", "first", "last"))
        open_ = met.filter((F.col("kinds") > 1) & (F.col("least") == 1))
        small = open_.filter(F.col("kinds") <= most)
        one = small.groupBy("part", "bytes").agg(F.min(F.struct("key", "piece", "first", "last", "core", "n")).alias("o"))
        one = one.select("part", "bytes", "o.*").join(cuts.select("key", "piece", "raw"), ["key", "piece"])
        cut = lambda lo, hi: F.substring(F.col("raw"), (lo + 1).cast("int"), (hi - lo).cast("int"))
        first, last, core = F.col("first"), F.col("last"), F.col("core")
        one = one.select(F.col("part").alias("key"), F.col("bytes").alias("piece"), F.col("n").alias("times"), cut(first, core).alias("ahead"), cut(core + length - block + 1, last + length).alias("behind"))
        found = sorted_repeats(one, block, spread)
        found = stored(found.withColumnsRenamed({"key": "part", "piece": "bytes"}), "sorted")
        at = F.explode("offs").alias("o")
        told.append(small.filter(F.col("n") == 1).join(found, ["part", "bytes"]).select("key", "piece", "first", at).select("key", "piece", (F.col("first") + F.col("o")).alias("first"), (F.col("first") + F.col("o")).alias("last")))
        large = open_.filter(F.col("kinds") > most)
        if large.isEmpty():
            break
        todo = large.select("key", "piece", "first", "last").join(cuts, ["key", "piece"])
    return told


def dedup_spans(docs: DataFrame, length: int = LENGTH, most: int = SORTED_PIECES) -> DataFrame:
    """(tid, spans): for each distinct text that holds repeated strings, where they start, as runs of first and last start.

    Equal strings share their least print and lie at the same place around it, so they meet in one key. Around each
    print lies a piece of text, with all strings whose least print it is. A piece that occurs twice repeats all its
    strings; the other pieces of a key are sorted against each other and against those by their suffixes (see
    repeated_offsets).
    """
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(pieces(docs, length), "pieces")
    each = each_piece(rows)
    times = each.groupBy("key", "piece").agg(F.count("*").alias("times"))
    keys = times.groupBy("key").agg(F.sum("times").alias("all"), F.count("*").alias("kinds"), F.min("times").alias("least")).filter(F.col("all") > 1)
    known = stored(times.join(keys, "key").select("key", "piece", "times", ((F.col("kinds") > 1) & (F.col("least") == 1)).alias("open")), "piece-counts")
    met = stored(each.join(known, ["key", "piece"]), "repeated-prints")

    asked = met.filter("open").groupBy("tid").agg(F.collect_set(F.struct("lo", "hi", "key", "piece", "times", "print")).alias("asked"))
    texts = docs.select("text", content_id(text_or_empty()).alias("tid")).join(asked, "tid").select("text", "asked")

    def cut():
        return lambda found, ask: [[[_utf8(t)[x["lo"] : x["hi"] + length] for x in a] for t, a in zip(found, ask, strict=True)]]

    cuts = add_in_arrow(texts, ["text", "asked"], {"raws": "array<binary>"}, cut).select(F.explode(F.arrays_zip("asked", "raws")).alias("x"))
    cuts = cuts.select("x.asked.key", "x.asked.piece", "x.asked.times", "x.asked.print", F.col("x.raws").alias("raw"))
    cuts = stored(cuts.groupBy("key", "piece").agg(F.first("times").alias("times"), F.first("print").alias("print"), F.first("raw").alias("raw")), "cut-pieces")

    met_once = met.filter((F.col("times") == 1) & F.col("open")).select("key", "piece", "tid", "lo")
    runs = [rows.select("tid", F.explode("sure").alias("run")), met.filter(F.col("times") > 1).select("tid", F.struct(F.col("lo").alias("first"), F.col("hi").alias("last")).alias("run"))]
    for told in repeated_offsets(cuts, length, most, spread):
        runs.append(told.join(met_once, ["key", "piece"]).select("tid", F.struct((F.col("lo") + F.col("first")).alias("first"), (F.col("lo") + F.col("last")).alias("last")).alias("run")))
    return stored(reduce(DataFrame.union, runs).groupBy("tid").agg(F.collect_set("run").alias("spans")), "repeat-spans")


def remove_repeats(docs: DataFrame, length: int = LENGTH, most: int = SORTED_PIECES) -> DataFrame:
    """All columns of `docs` with `kept` (binary: the bytes that stay), n_bytes, n_removed and n_spans.

    A byte goes if a string of `length` bytes that covers it also starts anywhere else, in the same text (overlaps
    count) or in another; all strings are judged on the input. Texts are their UTF-8 bytes, null is empty; texts shorter
    than `length` stay whole. Repeated rows are texts that repeat each other. Null ids and other columns do not matter;
    names that start with __tp_ are reserved.
    """
    spans = dedup_spans(docs, length, most).select(F.col("tid").alias("__tp_of"), F.col("spans").alias("__tp_spans"))
    rows = docs.withColumn("__tp_id", content_id(text_or_empty())).join(spans, F.col("__tp_id") == F.col("__tp_of"), "left")

    def work():
        def kept(text: str | None, runs: list | None) -> tuple[bytes, int, int, int]:
            raw = _utf8(text)
            if not runs:
                return raw, len(raw), 0, 0
            edge = np.zeros(len(raw) + 1, np.int64)
            np.add.at(edge, [r["first"] for r in runs], 1)
            np.add.at(edge, [r["last"] + length for r in runs], -1)
            gone = np.cumsum(edge[:-1]) > 0
            n_spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum())
            return np.frombuffer(raw, np.uint8)[~gone].tobytes(), len(raw), int(gone.sum()), n_spans

        return lambda texts, runs: [list(x) for x in zip(*map(kept, texts, runs), strict=True)] if texts else [[], [], [], []]

    return add_in_arrow(rows, ["text", "__tp_spans"], {"kept": "binary", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint"}, work).drop("__tp_id", "__tp_of", "__tp_spans")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
