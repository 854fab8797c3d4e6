"""Exact quantiles (linear interpolation, the pandas/NumPy default) at scale.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, which does not survive a hot group. This operator stays
exact without that buffer:

1. one pass: ``count`` and ``percentile_approx`` a little below and above each
   probability; the margin is several times the approximation's rank error
   and at least ``ROWS`` rows, so the wanted order statistics lie between;
2. one pass: the values inside a band grouped to (value, count), so ties of
   a hot value collapse into one row, and the values of each gap between the
   bands counted in one row. A value is met once, however many probabilities
   are asked for; only these counts meet each band. The band is cut into
   ``SLICES`` equal value ranges: the running total over slices finds the one
   that holds a rank, and only the values of that slice are ranked one by one.

Columns of a table (``quantiles_columns``) take their brackets from one scalar
array, so the rows are never shuffled; groups (``quantiles_long``) join them on
the group keys, by broadcast if the caller knows the groups to be few. Nothing
is collected. A group without values gives NULL, like pandas' NaN; a rank that
isn't found is an error, never a NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 100_000
#: Margins around a probability; the first that covers ROWS rows is used, else all rows.
MARGINS = (5.0 / ACCURACY, 0.01)
ROWS = 4
SLICES = 1024


def _grid(probs: Sequence[float]) -> list[float]:
    """Probabilities that the approximation is asked for."""
    return sorted({min(max(p + s * m, 0.0), 1.0) for p in probs for m in MARGINS for s in (-1, 1)})


def _number(c) -> Column:
    return F.nanvl((F.col(c) if isinstance(c, str) else c).cast("double"), F.lit(None).cast("double"))


def _stats(c: Column, grid: Column) -> Column:
    return F.struct(
        F.count(c).alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi"), F.percentile_approx(c, grid, ACCURACY).alias("edges")
    )


def _targets(stats: Column, probs: Sequence[float], grid: list[float]) -> Column:
    """array<struct<p, pos, r0, r1, n, lo, hi>>: bracket and ranks (from 0) of
    each probability; one lambda over the probabilities, whatever their number."""

    def place(x: float) -> Column:
        # where an edge stands in the approximation's answer; none beyond 0 and 1
        return F.lit(grid.index(x) if 0 < x < 1 else None).cast("int")

    wanted = F.array(*[
        F.struct(
            F.lit(p).alias("p"),
            *[place(min(max(p + s * m, 0.0), 1.0)).alias(f"{side}{i}") for side, s in (("lo", -1), ("hi", 1)) for i, m in enumerate(MARGINS)],
        )
        for p in probs
    ])

    def edge(t: Column, side: str, otherwise: Column) -> Column:
        # the narrowest margin that covers enough rows
        tries = [F.when(stats["n"] * m >= ROWS, F.get(stats["edges"], t[f"{side}{i}"])) for i, m in enumerate(MARGINS)]
        return F.coalesce(*tries, otherwise)

    def target(t: Column) -> Column:
        pos = t["p"] * (stats["n"] - 1)
        return F.struct(
            t["p"].alias("p"), pos.alias("pos"), F.floor(pos).cast("long").alias("r0"), F.ceil(pos).cast("long").alias("r1"),
            stats["n"].alias("n"), edge(t, "lo", stats["lo"]).alias("lo"), edge(t, "hi", stats["hi"]).alias("hi"),
        )

    return F.transform(wanted, target)


def _counted(values: DataFrame, keys: list[str], probs: int) -> DataFrame:
    """``values``: (*keys, _v, _b), a row for each value with the ``probs``
    brackets of its group. One row (*keys, _v, _c) for each value inside a
    bracket; values inside none are one row for each run of them that no
    bracket's start divides, with the smallest."""
    v = F.col("_v")
    ends = [(F.get("_b", F.lit(j))["lo"], F.get("_b", F.lit(j))["hi"]) for j in range(probs)]
    run = sum(((v >= lo).cast("int") for lo, _ in ends), F.lit(0))
    inside = reduce(or_, [(v >= lo) & (v <= hi) for lo, hi in ends])
    placed = values.where(v.isNotNull()).select(*keys, "_v", run.alias("_run"), F.when(inside, v).alias("_in"))
    return placed.groupBy(*keys, "_run", "_in").agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_v")).drop("_run", "_in")


def _values(joined: DataFrame, targets: DataFrame, keys: list[str], interpolate: bool = True) -> DataFrame:
    """``joined``: (*keys, _v, _c, p, lo, hi), a row for each count and bracket;
    ``targets``: (*keys, p, pos, r0, r1, n). One row (*keys, p, value) each."""
    v, lo, hi = F.col("_v"), F.col("lo"), F.col("hi")
    inside = v >= lo
    part = F.floor((v - lo) / F.nullif(hi - lo, F.lit(0.0)) * F.lit(float(SLICES)))
    part = F.least(F.greatest(F.coalesce(part, F.lit(0)), F.lit(0)), F.lit(SLICES - 1)).cast("int")
    # values above the bracket are dropped, values below it are one row
    band = joined.where(v <= hi).select(
        *keys, "p", F.when(inside, part).otherwise(F.lit(-1)).alias("_s"), F.when(inside, v).alias("_bv"), "_c"
    ).groupBy(*keys, "p", "_s", "_bv").agg(F.sum("_c").alias("_c"))
    slices = band.groupBy(*keys, "p", "_s").agg(F.sum("_c").alias("_sc"))
    upto = Window.partitionBy(*keys, "p").orderBy("_s").rowsBetween(Window.unboundedPreceding, 0)
    slices = slices.withColumn("_before", F.sum("_sc").over(upto) - F.col("_sc"))
    holds = lambda r, first, n: (F.col(r) >= first) & (F.col(r) < first + n)
    hit = _join(slices.where("_s >= 0"), targets, [*keys, "p"]).where(
        holds("r0", F.col("_before"), F.col("_sc")) | holds("r1", F.col("_before"), F.col("_sc"))
    )
    rows = _join(band.where("_s >= 0"), hit.select(*keys, "p", "_s", "_before", "r0", "r1"), [*keys, "p", "_s"])
    within = Window.partitionBy(*keys, "p", "_s").orderBy("_bv").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_first", F.col("_before") + F.sum("_c").over(within) - F.col("_c"))
    picked = rows.groupBy(*keys, "p").agg(
        *[F.max(F.when(holds(r, F.col("_first"), F.col("_c")), F.col("_bv"))).alias(o) for r, o in (("r0", "_v0"), ("r1", "_v1"))]
    )
    out = _join(targets, picked, [*keys, "p"], "left")
    lost = (F.col("n") > 0) & (F.col("_v0").isNull() | F.col("_v1").isNull())
    value = F.col("_v0")
    if interpolate:
        value = value + (F.col("pos") - F.col("r0")) * (F.col("_v1") - F.col("_v0"))
    value = F.when(lost, F.raise_error(F.lit("quantile: a rank lies outside its bracket")).cast("double")).otherwise(value)
    return out.select(*keys, "p", value.alias("value"))


def _join(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be NULL; keeps the left side's keys."""
    renamed = b.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & a[k].eqNullSafe(renamed[f"_k{i}"])
    return a.join(renamed, same, how).drop(*[f"_k{i}" for i in range(len(keys))])


def quantiles_columns(df: DataFrame, cols: Sequence[str], probs: Sequence[float], interpolate: bool = True) -> DataFrame:
    """One row per column and probability: ``variable, p, value`` (without
    ``interpolate``: the lower one of the two values around the rank).

    Two passes over ``df``, no shuffle of its rows: only partial counts and
    the values inside the brackets (about 1e-4 of them) are exchanged. The
    approximations of a column are merged by one task, those of another
    column by another.
    """
    cols, probs = list(cols), [float(p) for p in probs]
    if not cols:
        return df.sparkSession.createDataFrame([], "variable string, p double, value double")
    grid = _grid(probs)
    values = df.select(F.posexplode(F.array(*[_number(c) for c in cols])).alias("i", "_v"))
    # exchanged as it is (a row for each column), so the passes below share one merge
    found = values.groupBy("i").agg(_stats(F.col("_v"), F.lit(grid)).alias("s")).repartition(1)
    # a column of an empty table is there too
    names = df.sparkSession.range(0, 1, 1, 1).select(F.posexplode(F.lit(cols)).alias("i", "variable"))
    targets = names.join(F.broadcast(found), "i", "left").select("variable", "i", _targets(F.col("s"), probs, grid).alias("_b"))
    brackets = targets.agg(F.array_sort(F.collect_list(F.struct("i", "_b")))["_b"].alias("_b"))
    counts = _counted(values.withColumn("_b", F.get(brackets.scalar(), F.col("i"))), ["i"], len(probs))
    each = targets.select("variable", "i", F.inline("_b"))
    # a row for each column and probability: broadcast
    joined = counts.join(F.broadcast(each.select("variable", "i", "p", "lo", "hi")), "i").drop("i")
    return _values(joined, each.drop("i", "lo", "hi"), ["variable"], interpolate)


def quantiles_long(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] = (),
                   few_groups: bool = False) -> DataFrame:
    """One row per (group, p): columns ``*by, p, value``.

    ``few_groups``: the caller knows that ``by`` has a small fixed domain, so
    the brackets (groups x probabilities) are broadcast; otherwise rows and
    brackets meet on the group keys.
    """
    probs = [float(p) for p in probs]
    if not by:
        return quantiles_columns(df, [col], probs).drop("variable")
    grid, keys = _grid(probs), list(by)
    src = df.select(*keys, _number(col).alias("_v"))
    stats = src.groupBy(*keys).agg(_stats(F.col("_v"), F.lit(grid)).alias("_s"))
    targets = stats.select(*keys, _targets(F.col("_s"), probs, grid).alias("_b"))
    ends = targets.select(*keys, F.transform("_b", lambda t: F.struct(t["lo"].alias("lo"), t["hi"].alias("hi"))).alias("_b"))
    each = targets.select(*keys, F.inline("_b"))
    brackets = each.select(*keys, "p", "lo", "hi")
    if few_groups:
        ends, brackets = F.broadcast(ends), F.broadcast(brackets)
    counts = _counted(_join(src.where(F.col("_v").isNotNull()), ends, keys), keys, len(probs))
    return _values(_join(counts, brackets, keys), each.drop("lo", "hi"), keys)


def quantiles_wide(df: DataFrame, col: str, probs: Sequence[float], names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per group with one column per probability."""
    long = quantiles_long(df, col, probs, by)
    aggs = [F.max(F.when(F.col("p") == float(p), F.col("value"))).alias(n) for p, n in zip(probs, names)]
    return long.groupBy(*by).agg(*aggs)
