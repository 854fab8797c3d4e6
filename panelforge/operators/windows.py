"""Per-series window features over a (key, date) panel.

All frames are ROWS frames on one ``Window.partitionBy(key).orderBy(date)``
spec, so Spark plans a single exchange + sort for any number of features
(lags, trailing stats, forward labels). Feature frames end at ``-1`` so the
row being predicted never sees its own value.

Scale note: a panel holds at most one row per (key, day), so one series is
bounded by its calendar length (a few thousand rows) even when a key carries
a large share of the raw rows; the raw rows were already reduced by a
partial aggregation before they reach these windows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.exprs import clip_upper, col_


def series_window(key: str | list[str], order: str) -> WindowSpec:
    keys = [key] if isinstance(key, str) else list(key)
    return Window.partitionBy(*keys).orderBy(F.col(order).asc())


def rolling(agg: Callable[[Column], Column], c, w: WindowSpec, start: int, end: int, min_obs: int) -> Column:
    """``agg`` over rows [start, end] relative to the current one, or NULL when
    fewer than ``min_obs`` non-null values are in the frame (pandas
    ``rolling(n, min_periods=m)`` after a shift)."""
    frame = w.rowsBetween(start, end)
    x = col_(c)
    return F.when(F.count(x).over(frame) >= min_obs, agg(x).over(frame))


def trailing_mean(c, w: WindowSpec, n: int, min_obs: int) -> Column:
    """Mean of the previous ``n`` rows, current excluded."""
    return rolling(F.avg, c, w, -n, -1, min_obs)


def trailing_std(c, w: WindowSpec, n: int, min_obs: int) -> Column:
    """Sample standard deviation of the previous ``n`` rows."""
    return rolling(F.stddev_samp, c, w, -n, -1, min_obs)


def trailing_sum(c, w: WindowSpec, n: int, min_obs: int) -> Column:
    """Sum of the previous ``n`` rows."""
    return rolling(F.sum, c, w, -n, -1, min_obs)


def lags(c, w: WindowSpec, offsets, prefix: str) -> dict[str, Column]:
    """``{prefix}{k}`` = value ``k`` rows back."""
    return {f"{prefix}{k}": F.lag(col_(c), k).over(w) for k in offsets}


def days_since_last(flag_cond: Column, date_col: str, w: WindowSpec, cap: int | None = 60) -> Column:
    """Days from the last row (current included) where ``flag_cond`` holds;
    NULL before the first such row; clipped to ``cap`` with NULL kept."""
    frame = w.rowsBetween(Window.unboundedPreceding, 0)
    last_hit = F.last(F.when(flag_cond, F.col(date_col)), ignorenulls=True).over(frame)
    days = F.datediff(F.col(date_col), last_hit)
    return clip_upper(days, cap) if cap is not None else days


def inclusive_mean(c, w: WindowSpec, n: int) -> Column:
    """Mean of the last ``n`` rows including the current one, no minimum."""
    return F.avg(col_(c)).over(w.rowsBetween(-(n - 1), 0))


def forward_below(c, w: WindowSpec, horizon: int, threshold) -> Column:
    """1 if the minimum of the next ``horizon`` rows is below ``threshold``,
    0 if not, NULL unless all ``horizon`` future rows exist."""
    frame = w.rowsBetween(1, horizon)
    full = F.count(F.lit(1)).over(frame) == horizon
    return F.when(full, (F.min(col_(c)).over(frame) < col_(threshold)).cast("int"))


def ledger_checks(w: WindowSpec, tol: float = 0.15, start="stock_inicio", inflow="ingreso_stock",
                  used="consumo_real", end="stock_fin") -> dict[str, Column]:
    """opening = previous closing + inflow; closing = opening - use.

    ``carry_error`` is NULL on the first row of a series.
    """
    prev_end = F.lag(F.col(end), 1).over(w)
    return {
        "carry_error": F.abs(F.col(start) - (prev_end + F.col(inflow))) > tol,
        "balance_error": F.abs(F.col(end) - (F.col(start) - F.col(used))) > tol,
    }


def assert_unique_order(df: DataFrame, w: WindowSpec, order: str) -> DataFrame:
    """Fails the job if two rows of one series share an order value.

    Uses ``lag`` on the same window as the features, so it adds no exchange.
    """
    checked = df.withColumn("_prev_pos", F.lag(F.col(order), 1).over(w))
    msg = F.concat(F.lit("duplicate series position: "), F.col(order).cast("string"))
    dup = F.col("_prev_pos") == F.col(order)
    return checked.filter(F.when(dup, F.raise_error(msg)).otherwise(F.lit(True))).drop("_prev_pos")
