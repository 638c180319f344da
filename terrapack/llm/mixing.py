"""Mixing sources to target weights by entropy balancing. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, content_id, stored, table, text_or_empty

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (1, 2, 3)
#: No source's target and no document's share exceeds so many times its size.
MOST = 3
#: Documents of one source and size that are rounded together.
CELL_ROWS = 4096
#: Steps by Newton's rule, steps in all (the others halve the bracket), and the share of the target that may be missed.
NEWTON, STEPS, PRECISION = 40, 160, 1e-9


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """For a row per source (source, source_size, source_n): weight, target and whether the cap binds.

    All sizes are shared by weight; a target stops at `most` times its source's size and the excess is shared again
    by weight. By rising cap per weight the capped sources come first, so running sums give the level at which it ends.
    """
    order = Window.orderBy(F.asc_nulls_last("source"))
    out = sources.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1))
    out = out.withColumn("cap", F.col("source_size") * F.lit(float(most))).withColumn("total", F.sum("source_size").over(Window.partitionBy()))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    before = F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    out = out.withColumn("level", (F.col("total") - before) / rest)
    out = out.withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight"))
    level = F.max(F.when(~F.col("capped"), F.col("level"))).over(Window.partitionBy())
    return out.withColumn("target", F.when(F.col("capped"), F.col("cap")).otherwise(level * F.col("weight"))).drop("cap", "total", "level")


def rate(tilt: Column, size: Column, mean: Column, most: float = MOST) -> Column:
    """Copies of a document of that size in the mix: exp(tilt * size / mean), at most `most`; a null tilt is the limit."""
    return F.when(tilt.isNull(), F.lit(float(most))).otherwise(F.least(F.exp(F.least(tilt * size / mean, F.lit(50.0))), F.lit(float(most))))


def solve_tilts(cells: DataFrame, targets: DataFrame, most: float = MOST) -> DataFrame:
    """`targets` with each source's `tilt`, the multiplier of its token constraint.

    Of all rates up to `most` whose words meet the target, those of least entropy against one copy each are
    exponential in size. The dual is convex and falls apart by source; each step sums words and their derivative over
    the cells (source, size, n) of all sources at once and takes a Newton step on the logarithm of the sum, or halves
    the bracket where the step leaves it; after NEWTON steps it only halves. A source is done when its sum is met, or
    when its bracket holds no further number; one that is not done after STEPS is an error. The states are a stored
    table: no source's number or count reaches the driver.
    """
    live = F.when(F.col("capped") | (F.col("target") <= 0), F.lit(None)).otherwise(F.lit(0.0))
    state = targets.withColumn("tilt", live).withColumn("mean", F.greatest(F.col("source_size") / F.col("source_n"), F.lit(1e-300)))
    smallest = cells.filter(F.col("size") > 0).groupBy("source").agg(F.min("size").alias("least"))
    state = state.alias("a").join(smallest.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")), "left").select("a.*", "b.least")
    over = F.col("target") > F.col("source_size")
    state = state.withColumn("low", F.when(over, F.lit(0.0))).withColumn("high", F.when(over, F.lit(float(most)) * F.col("mean") / F.col("least")).otherwise(F.lit(0.0)))
    state = stored(state.drop("least"), "mix-state")
    for n in range(STEPS):
        at = cells.alias("c").join(state.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source"))).select("c.source", "c.size", "c.n", "s.tilt", "s.mean")
        at = at.filter(F.col("tilt").isNotNull() & (F.col("size") > 0))
        r, words = rate(F.col("tilt"), F.col("size"), F.col("mean"), most), F.col("size") * F.col("n")
        slope = F.when(r < most, words * r * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = at.groupBy("source").agg(F.sum(words * r).alias("now"), F.sum(slope).alias("slope"))
        state = state.alias("s").join(sums.alias("m"), F.col("s.source").eqNullSafe(F.col("m.source")), "left").select("s.*", "m.now", "m.slope")
        off = F.log("now") - F.log("target")
        step = F.col("tilt") - off * F.col("now") / F.col("slope")
        low, high = F.when(off < 0, F.col("tilt")).otherwise(F.col("low")), F.when(off > 0, F.col("tilt")).otherwise(F.col("high"))
        out = (F.col("slope") <= 0) | (step > high) | (step < low) | F.lit(n >= NEWTON)
        shut = F.coalesce(high - low <= 4e-16 * F.greatest(F.abs(high), F.abs(low)), F.lit(False))
        new = F.when(F.col("tilt").isNull() | (F.abs(off) <= PRECISION), F.col("tilt")).when(out & low.isNotNull() & high.isNotNull(), (low + high) / 2).otherwise(step)
        state = stored(state.select(*(F.col(c) for c in ("source", "source_size", "source_n", "weight", "capped", "target", "mean")), new.alias("tilt"), low.alias("low"), high.alias("high"), F.when(shut, 0.0).otherwise(F.coalesce(F.abs(off), F.lit(0.0))).alias("off")), "mix-state")
        if (state.agg(F.max("off")).first()[0] or 0) <= PRECISION:
            break
        state = state.drop("off")
    else:
        raise ArithmeticError(f"the mix did not converge in {STEPS} steps")
    return state.select("source", "source_size", "source_n", "target", "mean", F.round("tilt", 9).alias("tilt"))


def running(rows: DataFrame, value: Column) -> tuple[DataFrame, Column]:
    """`rows` (source, __tp_size, __tp_part, ...) and the sum of `value` over each source's rows before, by size and part.

    Sums are taken within each size, and each size starts after those below it: no task has more than a source's
    distinct sizes or a size's parts."""
    rows = rows.withColumn("__tp_value", value)
    sizes = rows.groupBy("source", "__tp_size").agg(F.sum("__tp_value").alias("__tp_sum"))
    below = F.sum("__tp_sum").over(Window.partitionBy("source").orderBy("__tp_size").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(F.col("source").alias("__tp_s"), F.col("__tp_size").alias("__tp_z"), F.coalesce(below, F.lit(0)).alias("__tp_below"))
    rows = rows.join(sizes, rows["source"].eqNullSafe(sizes["__tp_s"]) & (rows["__tp_size"] == sizes["__tp_z"])).drop("__tp_s", "__tp_z")
    within = F.sum("__tp_value").over(Window.partitionBy("source", "__tp_size").orderBy("__tp_part").rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("__tp_before", F.col("__tp_below") + F.coalesce(within, F.lit(0))).drop("__tp_value", "__tp_below"), F.col("__tp_before")


def round_parts(parts: DataFrame, targets: DataFrame, most: int = MOST) -> DataFrame:
    """`parts` (source, __tp_size, __tp_part, n documents, rate r) with `taken`, the copies that its documents share.

    Along each source's parts by rising size a running sum of rates takes a copy at each half. What words are then
    missing or too many are made up from the smallest documents on, by at most one copy of each.
    """
    parts, upto = running(parts, F.col("n") * F.col("r"))
    copies = F.floor(upto + F.col("n") * F.col("r") + F.lit(0.5)) - F.floor(upto + F.lit(0.5))
    parts = stored(parts.withColumn("copies", F.least(copies, F.lit(most) * F.col("n"))).drop("__tp_before"), "mix-rounded")
    sums = parts.groupBy("source").agg(F.sum(F.col("copies") * F.col("__tp_size")).alias("words"))
    sums = sums.alias("a").join(targets.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))).select(F.col("a.source").alias("__tp_of"), (F.col("b.target") - F.col("a.words")).alias("off"))
    parts = parts.join(sums, parts["source"].eqNullSafe(sums["__tp_of"])).drop("__tp_of")
    room = F.when(F.col("off") > 0, F.least(F.col("n"), F.lit(most) * F.col("n") - F.col("copies"))).otherwise(F.least(F.col("n"), F.col("copies")))
    parts, used = running(parts.withColumn("room", F.when(F.col("__tp_size") > 0, room).otherwise(F.lit(0))), F.col("room") * F.col("__tp_size"))
    fix = F.greatest(F.lit(0), F.least(F.col("room"), F.floor((F.abs("off") - used) / F.greatest(F.col("__tp_size"), F.lit(1)))))
    return parts.withColumn("taken", (F.col("copies") + F.signum("off") * fix).cast("long")).drop("__tp_before")


def _taken(docs: DataFrame, words: Column | None, weights: tuple[int, ...], most: int) -> DataFrame:
    """`docs` with __tp_size, __tp_source_size, __tp_target, __tp_rate and __tp_copies (see mix)."""
    rows = docs.withColumns({"__tp_size": word_count(F.col("text")) if words is None else words, "__tp_key": F.xxhash64("doc_id", "text")})
    sizes = rows.select("source", F.col("__tp_size").alias("size"))
    cells = stored(sizes.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-cells")
    totals = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("source_n"))
    tilts = solve_tilts(cells, stored(source_targets(totals, weights, most), "mix-targets"), most)
    plan = cells.alias("c").join(tilts.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source")))
    plan = plan.select(F.col("c.source").alias("__tp_s"), F.col("c.size").alias("__tp_z"), F.col("t.source_size").alias("__tp_source_size"), F.col("t.target").alias("__tp_target"), F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(CELL_ROWS))).alias("__tp_parts"), rate(F.col("t.tilt"), F.col("c.size"), F.col("t.mean"), most).alias("__tp_rate"))
    plan = stored(plan, "mix-rates")
    rows = rows.join(plan, rows["source"].eqNullSafe(plan["__tp_s"]) & (rows["__tp_size"] == plan["__tp_z"]))
    rows = rows.withColumn("__tp_part", F.pmod("__tp_key", "__tp_parts")).drop("__tp_s", "__tp_z", "__tp_parts")
    parts = stored(rows.groupBy("source", "__tp_size", "__tp_part").agg(F.count("*").alias("n"), F.first("__tp_rate").alias("r")), "mix-parts")
    parts = round_parts(parts, tilts.select("source", "target"), most).select(F.col("source").alias("__tp_s"), F.col("__tp_size").alias("__tp_z"), F.col("__tp_part").alias("__tp_p"), F.col("n").alias("__tp_n"), F.col("taken").alias("__tp_k"))
    at = F.row_number().over(Window.partitionBy("source", "__tp_size", "__tp_part").orderBy("__tp_key", "doc_id"))
    rows = rows.withColumn("__tp_at", at)
    rows = rows.join(stored(parts, "mix-copies"), rows["source"].eqNullSafe(F.col("__tp_s")) & (rows["__tp_size"] == F.col("__tp_z")) & (rows["__tp_part"] == F.col("__tp_p")))
    copies = F.expr("__tp_k div __tp_n") + F.when(F.col("__tp_at") <= F.col("__tp_k") % F.col("__tp_n"), 1).otherwise(0)
    return rows.withColumn("__tp_copies", copies.cast("long")).drop("__tp_key", "__tp_part", "__tp_at", "__tp_s", "__tp_z", "__tp_p", "__tp_n", "__tp_k")


def mix(docs: DataFrame, words: Column | None = None, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """All columns of `docs` with size, source_size, target, rate and `copies`, the whole copies that the mix takes.

    Each row counts as a document; `words` is its size where the caller has counted already. Rates are rounded along
    each source's documents by rising size, so that what one document loses its neighbours of near the same size gain
    (see round_parts). Cells of one source and size with more than CELL_ROWS documents are dealt into parts by a hash;
    the copies of a part are shared evenly, the rest by hash. A null source is a source of its own, the last; a null
    text has no words and keeps one copy, or `most` where its source's target is at its cap. Columns of `docs` that are
    named like an added one are replaced; names that start with __tp_ are reserved.
    """
    out = _taken(docs, words, weights, most)
    named = {c: F.col(f"__tp_{c}") for c in ("size", "source_size", "target", "rate", "copies")}
    return out.withColumns(named).drop(*(f"__tp_{c}" for c in named))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: the columns of `docs`, each row as often as it is taken."""
    out = _taken(docs, None, WEIGHTS, MOST).filter(F.col("__tp_copies") > 0)
    return out.withColumn("__tp_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__tp_copies")))).select(*docs.columns)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    narrow = stored(docs.select("doc_id", "source", content_id(text_or_empty()).alias("text"), word_count(F.col("text")).alias("words")), "mix-documents")
    out = mix(narrow, F.col("words"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
