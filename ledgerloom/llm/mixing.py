"""Mixing sources to target weights by entropy balancing.

Each document gets a rate, the expected number of its copies in the mix. The rates minimise the relative entropy to a rate of one,
the sum over documents of r log r - r + 1, under one token constraint per source: size * r summed over the source's documents equals the
source's target. No rate is above `most`. The minimiser is an exponential tilt, r = min(most, exp(lambda * size)) with one lambda per source
that minimises the convex dual; its derivative is the sum of size * r less the target. Newton's method solves the dual for all sources at once:
each step is one distributed aggregation of the gradient and the curvature over the documents, which enter as counts by source and size (the
tilt depends on nothing else, so these counts are exact). A step that leaves the bracket of the solution becomes a bisection.

A target below its source thins out long documents more than short ones, a target above it repeats long ones more: that is what the entropy
with token constraints asks for. A source whose target is `most` times its size takes every document that often.

Rates become copies in two steps. Along the documents of a source in order of size, every document gets floor(rate) copies
and systematic rounding deals out the fractions. The tokens still missing or in excess are then made up by changing the extra copy of the
smallest documents. Running sums have two levels: cells of like sizes, then rows of a cell, so that no task sorts a whole source.

Defined results: a null text has size 0 and rate 1; a null source is a source, the last one; sources without tokens have target 0;
repeated rows are separate documents; a null doc_id counts as the first of its size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, stored, text_or_empty
from .quality_rules import words_of

#: Rates are rounded to this part before copies are dealt, so that all running sums are whole numbers.
UNIT = 1_000_000
SUB_CELLS = 32


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size): shares by weight of all tokens, none above `most` times its source.

    Sources in order of source_size / weight reach their limit first, so the capped ones are a prefix of that order; the level
    theta at which the others share the rest by weight follows from running sums.
    """
    everything = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last()))
    df = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int")))
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_t", F.sum("source_size").over(everything)).withColumn("_w", F.sum("w").over(everything))
    df = df.withColumn("_s0", F.coalesce(F.sum("source_size").over(before), F.lit(0))).withColumn("_w0", F.coalesce(F.sum("w").over(before), F.lit(0)))
    df = df.withColumn("_theta", (F.col("_t") - most * F.col("_s0")).cast("double") / (F.col("_w") - F.col("_w0")))
    df = df.withColumn("_free", most * F.col("source_size") >= F.col("_theta") * F.col("w"))
    df = df.withColumn("_level", F.min(F.when(F.col("_free"), F.struct("_s0", "_theta"))).over(everything)["_theta"])
    share = F.least(F.col("_level") * F.col("w"), (most * F.col("source_size")).cast("double"))
    return df.select("source", "source_size", F.round(F.coalesce(share, (most * F.col("source_size")).cast("double")), 6).alias("target"))


def rate(tilt: Column, size: Column, most: int) -> Column:
    """min(most, exp(tilt * size)); a null tilt is that of a source that takes `most` copies of everything."""
    x = tilt * size
    return F.when(tilt.isNull() | (x >= math.log(most)), F.lit(float(most))).otherwise(F.exp(x))


def _newton(state: DataFrame, counts: DataFrame, most: int) -> DataFrame:
    """One step for all sources: state (source, target, tilt, low, high) with the next tilt, a narrower bracket and `off`, the relative error before the step."""
    size, r = F.col("size").cast("double"), rate(F.col("tilt"), F.col("size"), most)
    rows = counts.join(state.select(F.col("source").alias("_s"), "tilt"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    sums = rows.groupBy(F.col("source").alias("_s")).agg(
        F.sum(F.col("n") * size * r).alias("got"), F.sum(F.when(r < most, F.col("n") * size * size * r).otherwise(0.0)).alias("bend"))
    df = state.join(sums, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    gap = F.col("got") - F.col("target")
    df = df.withColumn("off", F.abs(gap) / F.col("target"))
    df = df.withColumn("low", F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))).withColumn("high", F.when(gap > 0, F.col("tilt")).otherwise(F.col("high")))
    moved = F.col("tilt") - F.try_divide(gap, F.col("bend"))
    inside = F.coalesce((moved >= F.col("low")) & (moved <= F.col("high")), F.lit(False))
    return df.select("source", "target", F.when(inside, moved).otherwise((F.col("low") + F.col("high")) / 2).alias("tilt"), "low", "high", "off")


def tilts(plan: DataFrame, counts: DataFrame, most: int = 3, steps: int = 80, tolerance: float = 1e-9) -> DataFrame:
    """(source, tilt) of every source of plan (source, source_size, target), from counts (source, size, n); null where everything is taken `most` times.

    The last step starts within `tolerance` of the targets, and Newton's method squares that. It is an error if that is not reached.
    """
    first = F.log(F.col("target") / F.col("source_size"))  # every rate is on the near side of exp(first) or on the far side: it brackets the solution with 0
    solved = (F.col("source_size") > 0) & (F.col("target") < most * F.col("source_size"))
    state = plan.where(solved).select("source", "target", F.lit(0.0).alias("tilt"), F.least(first, F.lit(0.0)).alias("low"), F.greatest(first, F.lit(0.0)).alias("high"), F.lit(1.0).alias("off"))
    state = stored(state, "mix-tilts")
    for _ in range(steps):
        before, state = state, stored(_newton(state, counts, most), "mix-tilts")
        discard(before)
        worst = state.agg(F.max("off")).first()[0]
        if worst is None or worst <= tolerance:
            break
    else:
        raise ArithmeticError(f"the dual is off by {worst} after {steps} steps")
    found = state.select(F.col("source").alias("_s"), "tilt")
    return plan.join(found, F.col("source").eqNullSafe(F.col("_s")), "left").select("source", F.when(F.col("source_size") > 0, F.col("tilt")).otherwise(0.0).alias("tilt"))


def _cell(size: Column, doc_id: Column) -> list[Column]:
    """Cells that follow one another by size: the bit length and the next three bits of the size, then doc_id modulo SUB_CELLS."""
    bits = F.length(F.bin(size))
    shift = F.greatest(bits - 4, F.lit(0))
    lead = F.floor(size / F.pow(F.lit(2.0), shift)).cast("long")
    return [(bits * 16 + lead).cast("int").alias("c1"), F.coalesce(F.pmod(doc_id, F.lit(SUB_CELLS)), F.lit(-1)).cast("int").alias("c2")]


def _running(df: DataFrame, value: str, out: str) -> DataFrame:
    """df with `out`: the sum of `value` over the rows of the same source up to this one, in order of cell, size and doc_id."""
    cells = df.groupBy("source", "c1", "c2").agg(F.sum(value).alias("_v"))
    order = Window.partitionBy("source").orderBy("c1", "c2").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(F.col("source").alias("_s"), F.col("c1").alias("_c1"), F.col("c2").alias("_c2"), F.coalesce(F.sum("_v").over(order), F.lit(0)).alias("_base"))
    joined = df.join(cells, F.col("source").eqNullSafe(F.col("_s")) & (F.col("c1") == F.col("_c1")) & (F.col("c2") == F.col("_c2")))
    inner = Window.partitionBy("source", "c1", "c2").orderBy("size", F.col("doc_id").asc_nulls_first(), "tie").rowsBetween(Window.unboundedPreceding, 0)
    return joined.withColumn(out, F.col("_base") + F.sum(value).over(inner)).drop("_s", "_c1", "_c2", "_base")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies, taken) and the columns `keep` for each row of docs (doc_id, source, text)."""
    size = F.size(words_of(text_or_empty())).cast("long")
    rows = stored(docs.select("doc_id", "source", size.alias("size"), F.xxhash64("text").alias("tie"), *keep), "mix-sizes")
    counts = stored(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    plan = stored(targets(counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, most), "mix-plan")
    tilt = stored(tilts(plan, counts, most), "mix-tilt")
    discard(counts)
    by_source = plan.join(tilt.select(F.col("source").alias("_t"), "tilt"), F.col("source").eqNullSafe(F.col("_t"))).select(F.col("source").alias("_p"), "source_size", "target", "tilt")
    df = rows.join(by_source, F.col("source").eqNullSafe(F.col("_p"))).drop("_p")
    df = df.withColumn("rate", rate(F.col("tilt"), F.col("size"), most)).drop("tilt").withColumn("_units", F.round(F.col("rate") * UNIT).cast("long"))
    df = df.withColumn("base", F.expr(f"_units div {UNIT}")).withColumn("part", F.col("_units") % UNIT).drop("_units")
    df = df.select("*", *_cell(F.col("size"), F.col("doc_id")))
    df = _running(df, "part", "_upto")
    df = df.withColumn("extra", F.expr(f"(_upto + {UNIT // 2}) div {UNIT} - (_upto - part + {UNIT // 2}) div {UNIT}")).drop("_upto")
    df = stored(df, "mix-rounded")
    discard(rows)
    got = df.groupBy("source").agg(F.sum((F.col("base") + F.col("extra")) * F.col("size")).alias("got"), F.max("target").alias("aim"))
    got = got.select(F.col("source").alias("_p"), F.round(F.col("aim") - F.col("got")).cast("long").alias("short"))
    df = df.join(got, F.col("source").eqNullSafe(F.col("_p"))).drop("_p")
    wanted = F.when(F.col("short") > 0, 1).otherwise(0)
    open_ = (F.col("part") > 0) & (F.col("extra") != wanted) & (F.col("short") != 0)
    df = _running(df.withColumn("_open", F.when(open_, F.col("size")).otherwise(F.lit(0).cast("long"))), "_open", "_sum")
    turn = open_ & (F.col("_sum") <= F.abs("short"))
    df = df.withColumn("copies", F.col("base") + F.when(turn, wanted).otherwise(F.col("extra")))
    return df.select("doc_id", "source", "size", "source_size", "target", "rate", F.col("copies").cast("long").alias("copies"), (F.col("copies") * F.col("size")).cast("long").alias("taken"), *keep)
