"""Profiling and grouped reports.

Each report is one lazy DataFrame. Wide tables are reshaped to long
(variable, value) once, so a report over k columns is one grouped
aggregation keyed by ``variable`` rather than k separate jobs (correlation:
matrix products of Arrow batches). Small
constant-size sides (a 1-row total, k limit rows) are broadcast by
construction; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import numeric_columns, pct, round_half_up
from .information import nearest_information
from .joins import attach_row
from .quantiles import quantiles_columns, quantiles_long


def _const_join(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach a 1-row aggregate to every row (scalar subquery, no join)."""
    return attach_row(df, one_row)


def to_long(df: DataFrame, cols: Sequence[str], value_type: str = "double", keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., variable, value) with one row per input row and column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast(value_type).alias("value")) for c in cols])
    return df.select(*keep, F.explode(pairs).alias("_p")).select(*keep, "_p.variable", "_p.value")


# A1 ------------------------------------------------------------------------
def dataset_summary(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """rows, columns, duplicate rows, total NULL cells per table (exact).

    Full rows are not shuffled: one pass groups a 128-bit row fingerprint
    (two seeded xxhash64) with its row and NULL counts; only rows whose
    fingerprint repeats are then grouped on all their columns to count the
    true duplicates (NULLs compare equal, as in pandas ``duplicated``). When
    duplicates are rare the second shuffle is near empty.
    """
    parts = []
    for name, df in datasets.items():
        cols = df.columns
        row_nulls = sum((F.col(c).isNull().cast("long") for c in cols), F.lit(0).cast("long"))
        fp = F.struct(F.xxhash64(F.lit(17), *cols).alias("h1"), F.xxhash64(F.lit(9001), *cols).alias("h2"))
        by_fp = df.select(fp.alias("_fp"), row_nulls.alias("_nulls")).groupBy("_fp").agg(
            F.count(F.lit(1)).alias("_cnt"), F.sum("_nulls").alias("_nulls"))
        totals = by_fp.agg(
            F.coalesce(F.sum("_cnt"), F.lit(0)).cast("long").alias("filas"),
            F.coalesce(F.sum("_nulls"), F.lit(0)).cast("long").alias("valores_nulos_totales"),
        )
        candidates = by_fp.where(F.col("_cnt") > 1).select("_fp")
        cand_rows = df.withColumn("_fp", fp).join(candidates, "_fp", "left_semi").drop("_fp")
        dups = cand_rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c")).agg(
            F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("duplicados"))
        parts.append(_const_join(totals, dups).select(
            F.lit(name).alias("dataset"), "filas", F.lit(len(cols)).alias("columnas"), "duplicados", "valores_nulos_totales"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# A2 ------------------------------------------------------------------------
def null_report(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """NULLs and their percentage per column of every table, one aggregate per table."""
    parts = []
    for name, df in datasets.items():
        aggs = [F.count(F.lit(1)).alias("_n")] + [F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns]
        one = df.agg(*aggs)
        long = one.select("_n", F.explode(F.array(*[
            F.struct(F.lit(c).alias("columna"), F.coalesce(F.col(c), F.lit(0)).alias("nulos")) for c in df.columns
        ])).alias("_p"))
        parts.append(long.select(
            F.lit(name).alias("dataset"), "_p.columna", "_p.nulos",
            pct(F.col("_p.nulos") / F.nullif(F.col("_n"), F.lit(0))).alias("porcentaje_nulos"),
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy(F.col("porcentaje_nulos").desc(), "dataset", "columna")


# A3 ------------------------------------------------------------------------
def iqr_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """q1, q3, iqr, fences and the count of values strictly outside them."""
    q = quantiles_columns(df, cols, [0.25, 0.75]).groupBy("variable").agg(
        F.max(F.when(F.col("p") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("p") == 0.75, F.col("value"))).alias("q3"),
    ).where(F.col("q1").isNotNull()).withColumn("iqr", F.col("q3") - F.col("q1"))
    q = q.withColumns({
        "limite_inferior": F.col("q1") - F.lit(k) * F.col("iqr"),
        "limite_superior": F.col("q3") + F.lit(k) * F.col("iqr"),
    })
    # one row per column: broadcast is bounded by len(cols)
    flagged = to_long(df, cols).join(F.broadcast(q), "variable")
    outside = (F.col("value") < F.col("limite_inferior")) | (F.col("value") > F.col("limite_superior"))
    return flagged.groupBy("variable", "q1", "q3", "iqr", "limite_inferior", "limite_superior").agg(
        F.coalesce(F.sum(outside.cast("long")), F.lit(0)).cast("long").alias("cantidad_outliers")
    )


# A4 ------------------------------------------------------------------------
def describe(df: DataFrame) -> DataFrame:
    """``describe(include='all')`` in long form: one row per column."""
    num = numeric_columns(df)
    txt = [f.name for f in df.schema.fields if f.name not in num]
    parts = []
    if num:
        long = to_long(df, num)
        stats = long.groupBy("variable").agg(
            F.count("value").alias("count"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
        q = quantiles_columns(df, num, [0.25, 0.5, 0.75]).groupBy("variable").agg(
            *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n) for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))]
        )
        parts.append(stats.join(q, "variable").select(
            "variable", "count", F.lit(None).cast("long").alias("unique"), F.lit(None).cast("string").alias("top"),
            F.lit(None).cast("long").alias("freq"), "mean", "std", "min", "q25", "q50", "q75", "max",
        ))
    if txt:
        long = to_long(df, txt, "string")
        vc = long.where(F.col("value").isNotNull()).groupBy("variable", "value").agg(F.count(F.lit(1)).alias("_c"))
        stats = vc.groupBy("variable").agg(
            F.sum("_c").alias("count"),
            F.count(F.lit(1)).alias("unique"),
            F.min_by("value", F.struct(-F.col("_c"), F.col("value"))).alias("top"),
            F.max("_c").alias("freq"),
        )
        parts.append(stats.select(
            "variable", F.col("count").cast("long"), F.col("unique").cast("long"), "top", F.col("freq").cast("long"),
            *[F.lit(None).cast("double").alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")],
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# A5 ------------------------------------------------------------------------
def value_counts(df: DataFrame, col: str, count_name: str = "cantidad") -> DataFrame:
    """Counts of non-null values with their share of ALL rows (NULL rows included)."""
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    vc = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(count_name))
    return _const_join(vc, total).select(col, count_name, pct(F.col(count_name) / F.col("_total")).alias("porcentaje"))


# A6 ------------------------------------------------------------------------
def crosstab(df: DataFrame, row: str, col: str, values: Sequence[str]) -> DataFrame:
    """Counts of (row, col) pairs as a wide table; NULL keys dropped, gaps 0."""
    kept = df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    wide = kept.groupBy(row).pivot(col, list(values)).agg(F.count(F.lit(1)))
    return wide.na.fill(0, subset=list(values))


# A7 ------------------------------------------------------------------------
def _cross_products(cols: Sequence[str]):
    """Per task and pair of columns, over the rows where both are present: their
    number, means and central products; ``odd`` counts rows with a value that is no number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, shift, sums = len(cols), None, None
        for b in batches:
            present = np.stack([~np.asarray(c.is_null()) for c in b.columns], 1)
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], 1).astype(np.float64)
            odd = present & ~np.isfinite(x)
            m = (present & ~odd).astype(np.float64)
            x = np.where(m > 0, x, 0.0)
            if sums is None:
                shift, sums = x.sum(axis=0) / np.maximum(m.sum(axis=0), 1), np.zeros((5, k, k))
            x = np.where(m > 0, x - shift, 0.0)
            # number; sum and square sum of the first; product; odd rows
            sums += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x, odd.T.astype(float) @ present + present.T.astype(float) @ odd])
        if sums is None:
            return
        n, s, ss, xy, odd = sums
        i, j = np.triu_indices(k)
        some = np.maximum(n, 1)
        central = {
            "n": n, "ma": shift[:, None] + s / some, "mb": shift[None, :] + s.T / some, "caa": ss - s * s / some,
            "cbb": ss.T - s.T * s.T / some, "cab": xy - s * s.T / some, "odd": odd,
        }
        names = [pa.array([cols[v] for v in at]) for at in (i, j)]
        yield pa.RecordBatch.from_arrays([*names, *(pa.array(v[i, j]) for v in central.values())], names=["var_a", "var_b", *central])

    return run


def correlation_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation, long (var_a, var_b, corr).

    One pass: a task adds the cross-products of its rows up as matrices (of the
    number of columns squared, whatever the number of rows) and sends one row
    for each pair; those are joined about the common mean. A constant column
    gives NULL, not an error; a pair with a value that is no number gives NaN.
    """
    wanted = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    parts = wanted.mapInArrow(
        _cross_products(list(cols)), "var_a string, var_b string, " + ", ".join(f"{c} double" for c in ("n", "ma", "mb", "caa", "cbb", "cab", "odd"))
    )
    pair = Window.partitionBy("var_a", "var_b")
    mean = lambda m: F.sum(F.col("n") * F.col(m)).over(pair) / F.nullif(F.sum("n").over(pair), F.lit(0.0))
    apart = parts.withColumns({"da": F.col("ma") - mean("ma"), "db": F.col("mb") - mean("mb")})
    total = lambda c, a, b: F.sum(F.col(c) + F.coalesce(F.col("n") * F.col(a) * F.col(b), F.lit(0.0)))
    # of a column with itself the product of roots would miss 1 by a rounding error
    spread = F.when(F.first("var_a") == F.first("var_b"), total("caa", "da", "da")).otherwise(F.sqrt(total("caa", "da", "da")) * F.sqrt(total("cbb", "db", "db")))
    r = F.when(F.sum("odd") > 0, F.lit(float("nan"))).otherwise(total("cab", "da", "db") / F.nullif(spread, F.lit(0.0)))
    half = apart.groupBy("var_a", "var_b").agg(r.alias("corr"))
    both = F.when(F.col("var_a") == F.col("var_b"), F.array(F.struct("var_a", "var_b"))).otherwise(
        F.array(F.struct("var_a", "var_b"), F.struct(F.col("var_b").alias("var_a"), F.col("var_a").alias("var_b")))
    )
    return half.select(F.explode(both).alias("v"), "corr").select("v.*", "corr")


# A8 ------------------------------------------------------------------------
def alert_summary(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    long = to_long(df, targets)
    return long.groupBy(F.col("variable").alias("target")).agg(
        F.coalesce(F.sum("value"), F.lit(0.0)).cast("long").alias("cantidad_alertas"),
        pct(F.avg("value")).alias("porcentaje_alertas"),
    )


# A17 -----------------------------------------------------------------------
def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed, NULLs dropped.

    Empty bins are kept (the bin list is generated from the 1-row range).
    """
    x = F.col(col).cast("double")
    vals = df.select(x.alias("_x")).where(F.col("_x").isNotNull())
    rng = vals.agg(F.min("_x").alias("_lo0"), F.max("_x").alias("_hi0")).select(
        F.when(F.col("_lo0") == F.col("_hi0"), F.col("_lo0") - 0.5).otherwise(F.col("_lo0")).alias("_lo"),
        F.when(F.col("_lo0") == F.col("_hi0"), F.col("_hi0") + 0.5).otherwise(F.col("_hi0")).alias("_hi"),
    )
    idx = F.floor((F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * F.lit(float(bins)))
    counted = _const_join(vals, rng).select(F.least(idx, F.lit(bins - 1)).cast("int").alias("bin")).groupBy("bin").agg(
        F.count(F.lit(1)).alias("n")
    )
    step = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    grid = rng.select("_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    grid = grid.select("bin", (F.col("_lo") + F.col("bin") * step).alias("bin_lo"),
                       F.when(F.col("bin") == bins - 1, F.col("_hi")).otherwise(F.col("_lo") + (F.col("bin") + 1) * step).alias("bin_hi"))
    return grid.join(F.broadcast(counted), "bin", "left").select("bin", "bin_lo", "bin_hi", F.coalesce("n", F.lit(0)).alias("n"))


# A18 -----------------------------------------------------------------------
def boxplot_stats(df: DataFrame, col: str, by: str, k: float = 1.5) -> DataFrame:
    """Per group: quartiles, whiskers (extreme data inside the fences), flier count."""
    return boxplots(df, [col], by, k).drop("variable")


def boxplots(df: DataFrame, cols: Sequence[str], by: str, k: float = 1.5) -> DataFrame:
    """``boxplot_stats`` of several columns, a row for each column and group.
    ``by`` is a column of few fixed values, whose rows are broadcast."""
    long = to_long(df, cols, keep=[by]).withColumnRenamed("value", "_x")
    base = long.where(F.col(by).isNotNull() & F.col("_x").isNotNull())
    keys = ["variable", by]
    q = quantiles_long(base, "_x", [0.25, 0.5, 0.75], by=keys, few_groups=True).groupBy(*keys).agg(
        *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n) for p, n in ((0.25, "q1"), (0.5, "mediana"), (0.75, "q3"))]
    )
    q = q.withColumns({
        "_lo": F.col("q1") - F.lit(k) * (F.col("q3") - F.col("q1")),
        "_hi": F.col("q3") + F.lit(k) * (F.col("q3") - F.col("q1")),
    })
    j = base.join(F.broadcast(q), keys)
    inside = (F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi"))
    return j.groupBy(*keys, "q1", "mediana", "q3").agg(
        F.min(F.when(inside, F.col("_x"))).alias("bigote_inf"),
        F.max(F.when(inside, F.col("_x"))).alias("bigote_sup"),
        F.sum((~inside).cast("long")).alias("n_atipicos"),
        F.count(F.lit(1)).alias("n"),
    )


# A19 -----------------------------------------------------------------------
def _bins(rows: DataFrame, cols: Sequence[str], bins: int):
    """One row with ``_cuts``, the edges of each column's bins of about equal
    counts; and the bin, as text ('-1' for NULL), of a value of the i-th column."""
    edges = quantiles_columns(rows, cols, [i / bins for i in range(1, bins)], interpolate=False)
    # bins - 1 numbers for each column
    cuts = edges.groupBy("variable").agg(F.collect_list("value").alias("v")).agg(
        F.map_from_entries(F.collect_list(F.struct("variable", "v"))).alias("_cuts")
    )
    cuts = cuts.select(F.array(*[F.col("_cuts")[c] for c in cols]).cast("array<array<double>>").alias("_cuts"))

    def bin_of(i: Column, x: Column) -> Column:
        own = F.get("_cuts", i)
        n = sum((F.coalesce((F.get(own, F.lit(j)) <= x).cast("int"), F.lit(0)) for j in range(bins - 1)), F.lit(0))
        return F.when(x.isNull(), F.lit("-1")).otherwise(n.cast("string"))

    return cuts, bin_of


def _category(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("∅"))


def _plug_in(pairs: DataFrame) -> DataFrame:
    """Mutual information from (variable, x, y): with c ln c summed over the
    counts of x and y together, of each alone and of all, it is
    (together - x - y + all) / n. The counts are made once, map-side first;
    their margins are grouping sets of that small table."""
    joint = pairs.groupBy("variable", "x", "y").agg(F.count(F.lit(1)).alias("c"))
    sets = joint.groupingSets(
        [["variable", "x", "y"], ["variable", "x"], ["variable", "y"], ["variable"]], "variable", "x", "y"
    ).agg(F.sum("c").alias("c"), F.grouping("x").alias("gx"), F.grouping("y").alias("gy"))
    sign = F.when(F.col("gx") == F.col("gy"), F.lit(1.0)).otherwise(F.lit(-1.0))
    n = F.max(F.when((F.col("gx") == 1) & (F.col("gy") == 1), F.col("c")))
    return sets.groupBy("variable").agg((F.sum(sign * F.col("c") * F.log("c")) / n).alias("mutual_information"))


def mutual_information(df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str], bins: int = 10,
                       regression: bool = False, method: str = "binned") -> DataFrame:
    """Mutual information (nats) of each feature with the label, over all rows
    that have a label: (variable, mutual_information).

    ``binned``: plug-in estimate. Numeric features, and the label of a
    regression, are cut into ``bins`` bins of about equal counts (the edges are
    values of the data); NULL is a bin of its own, categorical values are used
    as they are. All features go through one explode, whose rows are counted
    map-side.

    ``nearest``: nearest-neighbour estimate between a number and a class
    (``information.nearest_information``); NULL in a numeric feature becomes
    its median. Classes are the label's or, in a regression, the categorical
    feature's; a numeric feature and a continuous label meet with the label cut
    into ``bins`` bins; two categories have the plug-in estimate.
    """
    if method not in ("binned", "nearest"):
        raise ValueError(f"unknown method {method!r}")
    rows = df.where(F.col(label).isNotNull())
    if method == "nearest":
        return _nearest(rows, label, list(numeric), list(categorical), bins, regression)
    cuts, bin_of = _bins(rows, [*numeric, *([label] if regression else [])], bins)
    number, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    pairs = [(c, F.lit(i), F.col(c).cast("double"), text) for i, c in enumerate(numeric)]
    pairs += [(c, F.lit(None).cast("int"), number, _category(c)) for c in categorical]
    each = F.array(*[F.struct(F.lit(c).alias("variable"), i.alias("i"), v.alias("v"), t.alias("t")) for c, i, v, t in pairs])
    # binned after the explode: one expression for all features, not one for each
    long = attach_row(rows.select(F.col(label).alias("y"), F.inline(each)), cuts)
    x = F.when(F.col("i").isNull(), F.col("t")).otherwise(bin_of(F.col("i"), F.col("v")))
    y = bin_of(F.lit(len(numeric)), F.col("y").cast("double")) if regression else F.col("y").cast("string")
    return _plug_in(long.select("variable", x.alias("x"), y.alias("y")))


def _nearest(rows: DataFrame, label: str, numeric: list[str], categorical: list[str], bins: int, regression: bool) -> DataFrame:
    y, found, pairs = F.col(label).cast("string"), [], []
    if not regression and categorical:
        found.append(_plug_in(rows.select(
            y.alias("y"), F.inline(F.array(*[F.struct(F.lit(c).alias("variable"), _category(c).alias("x")) for c in categorical]))
        )))
    middle = medians(rows, numeric).agg(F.map_from_entries(F.collect_list(F.struct("variable", "mediana"))).alias("_middle"))
    if numeric:
        filled = attach_row(rows, middle)
        if regression:
            cuts, bin_of = _bins(filled, [label], bins)
            filled, y = attach_row(filled, cuts), bin_of(F.lit(0), F.col(label).cast("double"))
        number = lambda c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.col("_middle")[c])
        each = F.array(*[F.struct(F.lit(c).alias("variable"), number(c).alias("x")) for c in numeric])
        pairs.append(filled.select(y.alias("y"), F.inline(each)).select("variable", "x", "y"))
    if regression and categorical:
        each = F.array(*[F.struct(F.lit(c).alias("variable"), _category(c).alias("y")) for c in categorical])
        pairs.append(rows.select(F.col(label).cast("double").alias("x"), F.inline(each)).select("variable", "x", "y"))
    if pairs:
        found.append(nearest_information(reduce(DataFrame.unionByName, pairs)))
    return reduce(DataFrame.unionByName, found)


# A24 -----------------------------------------------------------------------
def class_balance(df: DataFrame, label: str) -> DataFrame:
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    vc = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return _const_join(vc, total).select(label, "n", (F.col("n") / F.col("_total")).alias("share"))


# A25 -----------------------------------------------------------------------
def medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return quantiles_columns(df, cols, [0.5]).select("variable", F.col("value").alias("mediana"))


# A26 -----------------------------------------------------------------------
def vocabulary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct non-null values per categorical column, long (variable, value)."""
    return to_long(df, cols, "string").where(F.col("value").isNotNull()).distinct()


def vocabulary_arrays(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sorted value array per column (for a registry entry, which holds them
    all; ``vocabulary`` is the long form for columns of many values)."""
    return vocabulary(df, cols).groupBy("variable").agg(F.sort_array(F.collect_list("value")).alias("values"))


# A29 -----------------------------------------------------------------------
def prediction_range(df: DataFrame, y: str = "y_true", yhat: str = "y_pred") -> DataFrame:
    return df.agg(
        F.least(F.min(y), F.min(yhat)).alias("lo"),
        F.greatest(F.max(y), F.max(yhat)).alias("hi"),
        F.count(F.lit(1)).alias("n"),
    )


__all__ = [n for n in dir() if not n.startswith("_")] + ["round_half_up"]
