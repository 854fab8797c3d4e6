"""Nearest-neighbour estimate of mutual information (A19) between a number and a class.

For a row with value x and class y, d is the distance to its k-th nearest row
of the same class, and m the number of rows of any class nearer than d (itself
included). The estimate is psi(N) + mean(psi(k) - psi(N_y) - psi(m)), with psi
the digamma function, N the rows and N_y those of the class; in nats, 0 at
least. All rows are used, no sample.

Nothing is gathered by class or by column, so one value or class may hold most
rows. Equal (variable, class, value) rows are one cell with a count. Cells are
numbered within their class over range partitions; the k-th distance is a
window over blocks of ``BLOCK`` cells, with k cells of each neighbouring block
as a halo. The rows within a distance are the difference of two prefix sums:
cells and interval borders are sorted together, and running counts inside a
range partition are added to the counts of the partitions before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

NEIGHBORS = 3
#: Cells that a window sorts at once.
BLOCK = 4096
#: A distance is shortened by these parts of itself and of the value, so that
#: rounding of x - d and x + d doesn't let the k-th neighbour itself in.
SHORTER, ROUNDING = 1e-9, 4.5e-16


def digamma(c: Column) -> Column:
    """The digamma function of a positive number (error below 1e-12): six
    steps of the recurrence, then the asymptotic series."""
    z = c.cast("double") + 6.0
    s = F.lit(1.0) / (z * z)
    series = F.log(z) - 0.5 / z - s * (1 / 12 - s * (1 / 120 - s * (1 / 252 - s * (1 / 240 - s * (1 / 132)))))
    steps = sum((F.lit(1.0) / (c.cast("double") + float(i)) for i in range(1, 6)), F.lit(1.0) / c.cast("double"))
    return series - steps


def prefix_sums(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows of its group
    that come before it in ``order``. ``group`` and ``order`` together should
    be a key without NULL.

    The rows are range-partitioned and written once (a row's partition must
    not change between the passes); each partition adds up its own rows, and
    the totals of the partitions before (a row for each partition and group)
    are joined to it. No group is sorted as a whole.
    """
    part, total, before = "_part", "_total", "_offset"
    rows = cut_lineage(df.repartitionByRange(*group, *order).withColumn(part, F.spark_partition_id()))
    totals = rows.groupBy(*group, part).agg(F.sum(value).alias(total))
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*group, part, F.coalesce(F.sum(total).over(earlier), F.lit(0)).alias(before))
    inside = Window.partitionBy(*group, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = F.col(before) + F.coalesce(F.sum(value).over(inside), F.lit(0))
    return rows.join(offsets, [*group, part]).withColumn(name, summed).drop(part, before)


def _kth_distance(cells: DataFrame, k: int, block: int) -> DataFrame:
    """``cells`` (variable, y, x, n, ny) with ``d``, the distance to the k-th
    nearest other row of the class, or to the furthest if there are fewer."""
    at = prefix_sums(cells.withColumn("_one", F.lit(1)), ["variable", "y"], ["x"], "_one", "_at").drop("_one")
    own, place = F.floor(F.col("_at") / block), F.col("_at") % block
    near = F.array_compact(F.array(own, F.when(place < k, own - 1), F.when(place >= block - k, own + 1)))
    rows = at.withColumn("_own", own).withColumn("_block", F.explode(near))
    w = Window.partitionBy("variable", "y", "_block").orderBy("x")
    beside = [F.struct(F.lit(0.0).alias("d"), (F.col("n") - 1).alias("n"))]
    for i in range(1, k + 1):
        for move in (F.lag, F.lead):
            other = F.abs(F.col("x") - move("x", i).over(w))
            beside.append(F.when(other.isNotNull(), F.struct(other.alias("d"), move("n", i).over(w).alias("n"))))
    listed = rows.withColumn("_near", F.array_sort(F.array_compact(F.array(*beside)))).where("_own = _block")
    wanted = F.least(F.lit(k), F.col("ny") - 1)
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(0.0).alias("d"))
    step = lambda a, e: F.when(a["seen"] >= wanted, a).otherwise(
        F.struct((a["seen"] + e["n"]).alias("seen"), F.when(e["n"] > 0, e["d"]).otherwise(a["d"]).alias("d"))
    )
    return listed.withColumn("d", F.aggregate("_near", start, step)["d"]).drop("_at", "_own", "_block", "_near")


def nearest_information(pairs: DataFrame, neighbors: int = NEIGHBORS, block: int = BLOCK) -> DataFrame:
    """(variable, mutual_information) from rows (variable, x double, y string).

    Rows with a NULL or non-finite x, or a NULL y, are left out, as are
    classes of one row. Where k rows of the class have the row's own value, d
    is 0, and k is their number with the row itself (m is that of all classes),
    so a column of few values gets its plug-in estimate. A variable without
    rows has no result.
    """
    if not 1 <= neighbors <= block:
        raise ValueError("neighbors must lie between 1 and block")
    finite = F.col("x").isNotNull() & ~F.isnan("x") & (F.abs("x") < F.lit(float("inf")))
    # -0.0 and 0.0 are one value
    rows = pairs.where(finite & F.col("y").isNotNull()).select("variable", "y", (F.col("x") + F.lit(0.0)).alias("x"))
    cells = rows.groupBy("variable", "y", "x").agg(F.count(F.lit(1)).alias("n"))
    sizes = cells.groupBy("variable", "y").agg(F.sum("n").alias("ny")).where("ny > 1")
    near = cut_lineage(_kth_distance(cells.join(sizes, ["variable", "y"]), neighbors, block))
    r = F.greatest(F.col("d") * (1 - SHORTER) - F.abs("x") * ROUNDING, F.lit(0.0))
    borders = F.array(
        F.struct((F.col("x") - r).alias("v"), F.lit(0).alias("kind")), F.struct((F.col("x") + r).alias("v"), F.lit(2).alias("kind"))
    )
    cell = F.struct("y", "x", "n", "ny", "d")
    asked = near.select("variable", F.inline(borders), F.lit(0).cast("long").alias("c"), cell.alias("cell"))
    # a lower border comes before the rows at its place, an upper one after them
    held = near.groupBy("variable", F.col("x").alias("v")).agg(F.sum("n").alias("c")).select(
        "variable", "v", F.lit(1).alias("kind"), "c", F.lit(None).cast(asked.schema["cell"].dataType).alias("cell")
    )
    # the cell is part of the order, so borders that meet in one place spread over partitions
    placed = prefix_sums(asked.unionByName(held), ["variable"], ["v", "kind", "cell"], "c", "below").where("kind <> 1")
    counted = placed.groupBy("variable", "cell").agg(F.sum(F.when(F.col("kind") == 2, F.col("below")).otherwise(-F.col("below"))).alias("m"))
    k = F.when(F.col("cell.d") == 0, F.col("cell.n")).otherwise(F.least(F.lit(neighbors), F.col("cell.ny") - 1))
    each = F.col("cell.n") * (digamma(k) - digamma(F.col("cell.ny")) - digamma(F.col("m")))
    sums = counted.groupBy("variable").agg(F.sum("cell.n").alias("_n"), F.sum(each).alias("_s"))
    value = digamma(F.col("_n")) + F.col("_s") / F.col("_n")
    return sums.select("variable", F.greatest(value, F.lit(0.0)).alias("mutual_information"))
