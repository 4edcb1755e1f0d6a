"""Mixing sources to target token shares by entropy balancing.

Every source has a target number of tokens. Among all document rates that meet
the targets, the ones nearest to 1 in relative entropy, with at most
``MAX_COPIES`` of a document, are ``min(MAX_COPIES, exp(lambda * size / mean))``
with one dual value ``lambda`` per source. The dual is solved by guarded Newton
steps; each step is one aggregate over the (source, size) histogram, and all
sums are exact decimals of fixed-point rates, so that reruns agree whatever
the order of rows. The rates are rounded into copies cell by cell: running
sums over a source's sizes decide how many documents of a cell get one copy
more, which leaves a source off its target by less than its longest document.
A few repairs then give or take single copies of the size nearest to what a
source is still off.

Cells with very many documents are split by a hash of the document id before
documents are ranked, so no task ranks more than about ``CELL_ROWS`` rows.

Defined results: null and empty texts have size 0 and take nothing (copies
follow the rate of size 0, which is 1); null is a source of its own, the last;
a source without words has target 0; with no words at all every target is 0.
Repeated rows are documents of their own; ties in the ranking are rows that
are alike. Columns of the added names (source_size, target, rate, copies) are
replaced; others, whatever their names, stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .words import free

MAX_COPIES = 3
#: Source weights repeat in this order over the sources by code point.
WEIGHTS = (1, 2, 3)
CELL_ROWS = 20_000
#: Rates are fixed-point numbers with this unit.
UNIT = 1 << 30
REPAIRS = 4
TOLERANCE = 1e-8
ADDED = ("source_size", "target", "rate", "copies")


def targets(per_source: DataFrame) -> DataFrame:
    """(source, source_size) with weight and target.

    The shares by weight are capped at MAX_COPIES times a source's size and
    the excess goes to the others by weight: in the order of cap / weight the
    capped sources come first, and what is left is shared by the rest. The
    windows run over one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(by_name) - 1) % len(WEIGHTS)) + 1)
    cap = (F.col("source_size") * MAX_COPIES).cast("double")
    rows = per_source.withColumn("weight", weight).withColumn("_cap", cap)
    order = Window.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("_total", F.sum("source_size").over(everything).cast("double"))
    rows = rows.withColumn("_left", F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
    rows = rows.withColumn("_level", F.col("_left") / F.sum("weight").over(onward))
    rows = rows.withColumn("_free", F.col("_cap") > F.col("_level") * F.col("weight"))
    # The first free source fixes the level for itself and all after it.
    level = F.min(F.when(F.col("_free"), F.struct(F.col("_cap") / F.col("weight"), F.col("_level"))))
    rows = rows.withColumn("_at", level.over(everything)["_level"])
    target = F.least(F.col("_cap"), F.coalesce(F.col("_at") * F.col("weight"), F.col("_cap")))
    return rows.select("source", "source_size", "weight", target.alias("target"))


def _rate(size: Column, mean: Column, dual: Column, capped: Column) -> Column:
    """The fixed-point rate of a size under a dual value."""
    tilted = F.least(F.lit(float(MAX_COPIES)), F.exp(F.least(dual * size / mean, F.lit(2.0))))
    return F.when(capped, F.lit(MAX_COPIES * UNIT)).otherwise(F.round(tilted * UNIT)).cast("decimal(20,0)")


def _same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def solve(cells: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, mean, dual, capped): the dual values that meet the targets.

    cells: (source, size, n); sources: (source, source_size, n_docs, target).
    A step reads the cells once and keeps one row per source. Steps go on until
    all sources meet their targets, or their brackets have closed. The Newton step
    is on the logarithm of the tokens taken; where it leaves the bracket that
    earlier steps have shown, the bracket's middle is taken; as long as one end of
    the bracket is unknown, a step at most doubles the dual value."""
    state = sources.select(
        "source",
        "target",
        F.greatest(F.col("source_size") / F.col("n_docs"), F.lit(1e-9)).alias("mean"),
        ((F.col("target") >= F.col("source_size") * MAX_COPIES) | (F.col("source_size") == 0)).alias("capped"),
        F.lit(0.0).alias("dual"),
        F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"),
    )
    state = stage(state, "mix-dual")
    while True:
        at = cells.alias("c").join(state.alias("s"), _same(F.col("c.source"), F.col("s.source")))
        rate = _rate(F.col("size"), F.col("mean"), F.col("dual"), F.col("capped"))
        taken = F.col("n").cast("decimal(18,0)") * rate
        bent = F.when(rate < MAX_COPIES * UNIT, F.col("size") * F.col("size")).otherwise(0)
        sums = at.groupBy("s.source").agg(
            F.sum(taken * F.col("size").cast("decimal(12,0)")).cast("double").alias("_taken"),
            F.sum(taken * bent.cast("decimal(18,0)")).cast("double").alias("_bent"),
        )
        moved = state.alias("s").join(sums.alias("m"), _same(F.col("s.source"), F.col("m.source")))
        error = F.log(F.greatest(F.col("_taken"), F.lit(1e-300)) / UNIT / F.greatest(F.col("target"), F.lit(1e-300)))
        slope = F.col("_bent") / F.col("mean") / F.greatest(F.col("_taken"), F.lit(1e-300))
        low = F.when(error < 0, F.col("dual")).otherwise(F.col("low"))
        high = F.when(error > 0, F.col("dual")).otherwise(F.col("high"))
        newton = F.col("dual") - error / F.greatest(slope, F.lit(1e-300))
        reach = F.greatest(F.lit(1.0), F.abs(F.col("dual")))
        near = F.greatest(F.least(newton, F.col("dual") + reach), F.col("dual") - reach)
        both = low.isNotNull() & high.isNotNull()
        inside = ~both | ((newton > low) & (newton < high))
        done = F.col("capped") | (F.abs(error) < TOLERANCE) | F.coalesce(high - low <= 1e-12 * F.greatest(F.lit(1.0), F.abs(low), F.abs(high)), F.lit(False))
        state = stage(
            moved.select(
                F.col("s.source"), "target", "mean", "capped",
                F.when(done, F.col("dual")).when(inside, near).otherwise((low + high) / 2).alias("dual"),
                low.alias("low"), high.alias("high"), done.alias("done"),
            ),
            "mix-dual",
        )
        if state.filter(~F.col("done")).isEmpty():
            return state.select("source", "mean", "dual", "capped")
        state = state.drop("done")


def _repaired(parts: DataFrame, sources: DataFrame) -> DataFrame:
    """Cells whose extra copies bring each source nearer to its target: in each
    round a source gives or takes one copy, if that helps, of the size nearest
    to what it is off. One aggregate over the cells a round."""
    whole = F.floor(F.col("_fixed") / UNIT).cast("long")
    for _ in range(REPAIRS):
        taken = parts.groupBy("_source").agg(
            F.sum((whole * F.col("n") + F.col("_extra")) * F.col("_size")).alias("_taken")
        )
        off = taken.join(sources, _same(F.col("_source"), F.col("source"))).select(
            F.col("_source").alias("_s"), (F.col("target") - F.col("_taken")).alias("_off")
        )
        may_more = (F.col("_off") > 0) & (F.col("_extra") < F.col("n")) & (whole < MAX_COPIES)
        may_less = (F.col("_off") < 0) & (F.col("_extra") + F.when(whole > 0, F.col("n")).otherwise(0) > 0)
        after = F.abs(F.abs(F.col("_off")) - F.col("_size"))
        best = (
            parts.join(off, _same(F.col("_source"), F.col("_s")))
            .filter((may_more | may_less) & (after < F.abs("_off")))
            .groupBy("_source")
            .agg(F.min(F.struct(after, "_size", "_bucket", F.signum("_off").cast("long").alias("_step"))).alias("_b"))
            .select(F.col("_source").alias("_s"), "_b._size", "_b._bucket", "_b._step")
        )
        p, b = parts.alias("p"), best.alias("b")
        at = (
            _same(F.col("p._source"), F.col("b._s"))
            & _same(F.col("p._size"), F.col("b._size"))
            & (F.col("p._bucket") == F.col("b._bucket"))
        )
        moved = F.col("p._extra") + F.coalesce("b._step", F.lit(0).cast("long"))
        parts = stage(
            p.join(b, at, "left").select(
                "p._source", "p._size", "p._bucket", "p.n", "p._fixed", moved.alias("_extra")
            ),
            "mix-extra",
        )
    return parts


def mix(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, source, size and any others) with source_size,
    target, rate and copies."""
    docs = docs.drop(*ADDED)
    # Apart, so that no name of theirs meets one of those below.
    whole = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("_row")
    docs = docs.select(whole, "doc_id", "source", "size")
    cells = stage(docs.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-cells")
    per_source = cells.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs")
    )
    aim = targets(per_source.select("source", "source_size"))
    sources = stage(
        per_source.alias("p").join(aim.alias("t"), _same(F.col("p.source"), F.col("t.source"))).select("p.*", "target"),
        "mix-sources",
    )
    duals = solve(cells, sources)
    known = sources.alias("p").join(duals.alias("d"), _same(F.col("p.source"), F.col("d.source")))
    rated = (
        cells.alias("c")
        .join(
            known.select("p.source", "source_size", "target", "mean", "dual", "capped").alias("k"),
            _same(F.col("c.source"), F.col("k.source")),
        )
        .select(
            "c.*", "source_size", "target",
            _rate(F.col("size"), F.col("mean"), F.col("dual"), F.col("capped")).alias("_fixed"),
            F.ceil(F.col("n") / CELL_ROWS).cast("int").alias("_splits"),
        )
    )
    rated = stage(rated.withColumnRenamed("source", "_source").withColumnRenamed("size", "_size"), "mix-rates")

    bucket = F.pmod(F.xxhash64("doc_id"), F.col("_splits")).cast("int").alias("_bucket")
    of_cell = _same(F.col("source"), F.col("_source")) & _same(F.col("size"), F.col("_size"))
    # Only split cells need counting anew.
    split = (
        docs.select("doc_id", "source", "size")
        .join(rated.filter(F.col("_splits") > 1), of_cell)
        .groupBy("_source", "_size", bucket)
        .agg(F.count("*").alias("n"), F.first("_fixed").alias("_fixed"))
    )
    parts = rated.filter(F.col("_splits") == 1).select(
        "_source", "_size", F.lit(0).alias("_bucket"), "n", "_fixed"
    ).unionByName(split)
    running = Window.partitionBy("_source").orderBy("_size", "_bucket")
    fraction = (F.col("_fixed") % UNIT) * F.col("n").cast("decimal(18,0)")
    parts = parts.withColumn("_sum", F.sum(fraction).over(running)).withColumn("_own", fraction)
    extra = F.floor(F.col("_sum") / UNIT) - F.floor((F.col("_sum") - F.col("_own")) / UNIT)
    parts = parts.withColumn("_extra", extra.cast("long")).drop("_sum", "_own")
    extras = (
        _repaired(stage(parts, "mix-extra"), sources)
        .groupBy("_source", "_size")
        .agg(F.map_from_entries(F.collect_list(F.struct("_bucket", "_extra"))).alias("_extras"))
    )
    r, x = rated.alias("r"), extras.alias("x")
    plan = r.join(x, _same(F.col("r._source"), F.col("x._source")) & _same(F.col("r._size"), F.col("x._size")))
    plan = stage(plan.select("r.*", "_extras").drop("n"), "mix-plan")

    cell = Window.partitionBy("source", "size", "_bucket").orderBy(F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = docs.join(plan, of_cell).withColumn("_bucket", bucket)
    chosen = chosen.withColumn("_rank", F.row_number().over(cell))
    extra = F.element_at("_extras", F.col("_bucket"))
    more = (F.col("_rank") <= extra).cast("long") - (F.col("_rank") <= -extra).cast("long")
    return chosen.select(
        "_row.*",
        "source_size",
        "target",
        (F.col("_fixed").cast("double") / UNIT).alias("rate"),
        (F.floor(F.col("_fixed") / UNIT).cast("long") + more).alias("copies"),
    )


def repeat_copies(mixed: DataFrame) -> DataFrame:
    """Each document as often as its copies say, without the added columns."""
    name = free("_copy", mixed)
    every = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return mixed.filter(F.col("copies") > 0).withColumn(name, every).drop(name, "size", *ADDED)
