"""Panel windows against the pandas fixture (FIXTURES.md §2) and W10."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelforge.functions import exprs as X
from panelforge.operators import windows as W

ROWS = [
    ("A", "2025-01-01", 4, 0, 50), ("A", "2025-01-02", 6, 0, 44), ("A", "2025-01-03", 5, 20, 59),
    ("A", "2025-01-05", None, 0, 54), ("A", "2025-01-06", 0, 0, 54), ("A", "2025-01-07", 3, 0, 51),
    ("A", "2025-03-20", 2, 0, 9), ("A", "2025-03-21", 1, 30, 8),
    ("B", "2025-01-01", 0, 5, 10), ("B", "2025-01-02", 0, 0, 10), ("B", "2025-01-03", 0, 0, 10), ("B", "2025-01-04", 2, 0, 8),
]


@pytest.fixture(scope="module")
def panel(spark):
    df = spark.createDataFrame([(i, dt.date.fromisoformat(d), c, g, s) for i, d, c, g, s in ROWS],
                               "item string, fecha date, consumo int, ingreso int, stock int")
    w = W.series_window("item", "fecha")
    out = df.select(
        "item", "fecha",
        F.lag("consumo", 1).over(w).alias("lag1"),
        W.trailing_mean("consumo", w, 7, 3).alias("roll7"),
        W.trailing_std("consumo", w, 7, 3).alias("std7"),
        W.trailing_sum("ingreso", w, 7, 3).alias("ing7"),
        W.days_since_last(F.col("ingreso") > 0, "fecha", w, 60).alias("dsr"),
        X.clip_upper(X.safe_ratio("stock", W.trailing_mean("consumo", w, 7, 3)), 120.0).alias("cover"),
    )
    return {(r.item, r.fecha.isoformat()): r for r in out.collect()}


def _r(x, d=4):
    return None if x is None else round(x, d)


def test_lag_and_rolling(panel):
    a5 = panel[("A", "2025-01-05")]
    assert (a5.lag1, a5.roll7, _r(a5.std7), a5.ing7, a5.dsr, _r(a5.cover)) == (5, 5.0, 1.0, 20, 2, 10.8)
    a6 = panel[("A", "2025-01-06")]
    assert a6.lag1 is None and a6.roll7 == 5.0
    a7 = panel[("A", "2025-01-07")]
    assert (a7.roll7, _r(a7.std7), _r(a7.cover)) == (3.75, 2.63, 13.6)
    a20 = panel[("A", "2025-03-20")]
    assert (a20.roll7, _r(a20.std7), a20.dsr, _r(a20.cover)) == (3.6, 2.3022, 60, 2.5)
    a21 = panel[("A", "2025-03-21")]
    assert (_r(a21.roll7), _r(a21.std7), a21.dsr, _r(a21.cover)) == (3.3333, 2.1602, 0, 2.4)


def test_min_obs_and_zero_mean(panel):
    assert panel[("A", "2025-01-02")].roll7 is None
    assert panel[("A", "2025-01-01")].dsr is None and panel[("A", "2025-01-03")].dsr == 0
    b4 = panel[("B", "2025-01-04")]
    assert (b4.roll7, b4.std7, b4.ing7, b4.dsr, b4.cover) == (0.0, 0.0, 5, 3, None)


def test_forward_label(spark):
    df = spark.createDataFrame([("x", i, s) for i, s in enumerate([30, 20, 9, 15, 40])], "k string, t int, s int")
    w = W.series_window("k", "t")
    out = df.select("t", W.forward_below("s", w, 2, F.lit(10)).alias("y")).orderBy("t").collect()
    assert [r.y for r in out] == [1, 1, 0, None, None]


def test_duplicate_series_position_fails(spark):
    df = spark.createDataFrame([("x", 1), ("x", 1)], "k string, t int")
    with pytest.raises(Exception):
        W.assert_unique_order(df, W.series_window("k", "t"), "t").collect()


def test_window_block_single_exchange(spark):
    """All per-item features share one exchange and one sort."""
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"), (F.col("id") * 1.0).alias("v"))
    w = W.series_window("k", "t")
    out = df.select(F.lag("v", 1).over(w), W.trailing_mean("v", w, 7, 3), W.forward_below("v", w, 7, F.lit(5.0)))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
