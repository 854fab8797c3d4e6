"""Panel queries: windows W1-W11, join J1, features F3-F5, P12/P13/P14/P27."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import features as FE
from ..operators import windows as W
from . import oracle as O
from . import roles
from .registry import R, normalise, query

W_SQL = "PARTITION BY item_id ORDER BY fecha"


def _panel(spark, sf):
    return roles.panel(spark, sf)


@query(
    "w1_lag1",
    O.with_(O.PANEL) + f"""
SELECT fecha, item_id, consumo_real, LAG(consumo_real, 1) OVER ({W_SQL}) AS consumo_lag_1 FROM panel""",
)
def w1_lag1(spark, sf):
    w = W.series_window("item_id", "fecha")
    return _panel(spark, sf).select("fecha", "item_id", "consumo_real", F.lag("consumo_real", 1).over(w).alias("consumo_lag_1"))


@query(
    "w2_lags",
    O.with_(O.PANEL) + f"""
SELECT fecha, item_id,
  LAG(consumo_real, 1) OVER ({W_SQL}) AS consumo_lag_1, LAG(consumo_real, 2) OVER ({W_SQL}) AS consumo_lag_2,
  LAG(consumo_real, 3) OVER ({W_SQL}) AS consumo_lag_3, LAG(consumo_real, 7) OVER ({W_SQL}) AS consumo_lag_7,
  LAG(consumo_real, 14) OVER ({W_SQL}) AS consumo_lag_14
FROM panel""",
)
def w2_lags(spark, sf):
    w = W.series_window("item_id", "fecha")
    return _panel(spark, sf).select("fecha", "item_id", *[v.alias(k) for k, v in W.lags("consumo_real", w, FE.DEMAND_LAGS, "consumo_lag_").items()])


def _trailing_sql(fn: str, col: str, n: int, m: int, alias: str, d: int = 6) -> str:
    frame = f"({W_SQL} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN COUNT({col}) OVER {frame} >= {m} THEN {O.R(f'{fn}({col}) OVER {frame}', d)} END AS {alias}"


@query(
    "w3_rolling_mean",
    O.with_(O.PANEL) + f"""
SELECT fecha, item_id, {_trailing_sql('AVG', 'consumo_real', 7, 3, 'consumo_roll7')},
       {_trailing_sql('AVG', 'consumo_real', 14, 5, 'consumo_roll14')}
FROM panel""",
)
def w3_rolling_mean(spark, sf):
    w = W.series_window("item_id", "fecha")
    return _panel(spark, sf).select(
        "fecha", "item_id",
        R(W.trailing_mean("consumo_real", w, 7, 3)).alias("consumo_roll7"),
        R(W.trailing_mean("consumo_real", w, 14, 5)).alias("consumo_roll14"),
    )


@query(
    "w4_rolling_std",
    O.with_(O.PANEL) + f"""
SELECT fecha, item_id, {_trailing_sql('STDDEV_SAMP', 'consumo_real', 7, 3, 'consumo_std7')} FROM panel""",
)
def w4_rolling_std(spark, sf):
    w = W.series_window("item_id", "fecha")
    return _panel(spark, sf).select("fecha", "item_id", R(W.trailing_std("consumo_real", w, 7, 3)).alias("consumo_std7"))


@query(
    "w5_rolling_sum",
    O.with_(O.PANEL) + f"""
SELECT fecha, item_id, {_trailing_sql('SUM', 'ingreso_stock', 7, 3, 'ingreso_roll7')} FROM panel""",
)
def w5_rolling_sum(spark, sf):
    w = W.series_window("item_id", "fecha")
    return _panel(spark, sf).select("fecha", "item_id", R(W.trailing_sum("ingreso_stock", w, 7, 3)).alias("ingreso_roll7"))


@query(
    "w6_days_since_restock",
    O.with_(O.PANEL) + f"""
, t AS (SELECT fecha, item_id, MAX(CASE WHEN ingreso_stock > 0 THEN fecha END)
          OVER ({W_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_in FROM panel)
SELECT fecha, item_id, CASE WHEN date_diff('day', last_in, fecha) > 14 THEN 14
                            ELSE CAST(date_diff('day', last_in, fecha) AS INTEGER) END AS dias_sin_ingreso
FROM t""",
    note="cap 14: restock gaps in the bound panel are short, so 60 would never clip",
)
def w6_days_since_restock(spark, sf):
    w = W.series_window("item_id", "fecha")
    return _panel(spark, sf).select(
        "fecha", "item_id", W.days_since_last(F.col("ingreso_stock") > 0, "fecha", w, 14).alias("dias_sin_ingreso")
    )


@query(
    "w9_trailing_estimate",
    O.with_(O.CONSUMO) + """
SELECT fecha, item_id, consumo_estimado_7d, consumo_estimado_14d, dias_cobertura FROM consumo""",
)
def w9_trailing_estimate(spark, sf):
    """W9 + P27: inclusive 7-row mean turned into cover estimates."""
    return roles.consumo(spark, sf).select("fecha", "item_id", "consumo_estimado_7d", "consumo_estimado_14d", "dias_cobertura")


@query(
    "w10_forward_label",
    O.with_(O.CONSUMO) + """
SELECT fecha, item_id, stock_critico_7d, stock_critico_14d FROM consumo""",
)
def w10_forward_label(spark, sf):
    return roles.consumo(spark, sf).select("fecha", "item_id", "stock_critico_7d", "stock_critico_14d")


@query(
    "w11_ledger_check",
    O.with_(O.PANEL) + f"""
, t AS (SELECT item_id,
          ABS(stock_inicio - (LAG(stock_fin, 1) OVER ({W_SQL}) + ingreso_stock)) > 0.15 AS carry_error,
          ABS(stock_fin - (stock_inicio - consumo_real)) > 0.15 AS balance_error
        FROM panel)
SELECT item_id, COUNT(*) AS n_rows,
       CAST(SUM(CAST(carry_error AS BIGINT)) AS BIGINT) AS carry_errors,
       CAST(SUM(CAST(balance_error AS BIGINT)) AS BIGINT) AS balance_errors
FROM t GROUP BY item_id""",
)
def w11_ledger_check(spark, sf):
    w = W.series_window("item_id", "fecha")
    checks = _panel(spark, sf).select("item_id", *[v.alias(k) for k, v in W.ledger_checks(w).items()])
    return checks.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("carry_error").cast("long")).alias("carry_errors"),
        F.sum(F.col("balance_error").cast("long")).alias("balance_errors"),
    )


HIST_COLS_NUM = ["consumo_roll7", "consumo_roll14", "consumo_std7", "ingreso_roll7"]


@query(
    "j1_panel_catalogue",
    O.with_(O.PANEL, O.ITEMS) + """
SELECT p.fecha, p.item_id, p.consumo_real, i.consumo_base_por_familia, i.stock_seguridad_7d, i.es_critico
FROM panel p LEFT JOIN items i ON p.item_id = i.item_id""",
)
def j1_panel_catalogue(spark, sf):
    from ..operators.joins import many_to_one_join

    items = roles.catalogue(spark, sf).select("item_id", "consumo_base_por_familia", "stock_seguridad_7d", "es_critico")
    return many_to_one_join(_panel(spark, sf).select("fecha", "item_id", "consumo_real"), items, "item_id")


@query(
    "f3_inventory_history",
    O.with_(O.CONSUMO, O.history(60)) + """
SELECT fecha, item_id, consumo_lag_1, """ + ", ".join(f"{O.R(c)} AS {c}" for c in HIST_COLS_NUM) + """,
       dia_semana, mes, dias_sin_ingreso, consumo_base_por_familia, stock_seguridad_7d, es_critico
FROM hist""",
)
def f3_inventory_history(spark, sf):
    h = FE.inventory_history(roles.consumo(spark, sf), roles.catalogue(spark, sf), items_unique=True)
    h = normalise(h, HIST_COLS_NUM)
    return h.select("fecha", "item_id", "consumo_lag_1", *HIST_COLS_NUM, "dia_semana", "mes", "dias_sin_ingreso",
                    "consumo_base_por_familia", "stock_seguridad_7d", "es_critico")


def _stock_sql(h: int) -> str:
    num = []
    for c in FE.STOCK_NUM:
        if c in HIST_COLS_NUM or c in ("cobertura_bruta", "ratio_stock_seguridad"):
            num.append(f"{O.R(c)} AS {c}")
        else:
            num.append(c)
    return O.with_(O.CONSUMO, O.history(60)) + f"""
, s AS (
  SELECT *,
    CASE WHEN stock_inicio / NULLIF(consumo_roll7, 0) > 120 THEN 120.0 ELSE stock_inicio / NULLIF(consumo_roll7, 0) END AS cobertura_bruta,
    CASE WHEN stock_inicio / NULLIF(stock_seguridad_7d, 0) > 60 THEN 60.0 ELSE stock_inicio / NULLIF(stock_seguridad_7d, 0) END AS ratio_stock_seguridad
  FROM hist WHERE stock_critico_{h}d IS NOT NULL AND consumo_roll7 IS NOT NULL
)
SELECT {", ".join(num)}, COALESCE(categoria, 'desconocido') AS categoria,
       COALESCE(unidad_medida, 'desconocido') AS unidad_medida, item_id,
       CAST(stock_critico_{h}d AS INTEGER) AS label, fecha AS split_date
FROM s"""


def _stock(spark, sf, h, consumo=None):
    fs = FE.stock_features(consumo or roles.consumo(spark, sf), roles.catalogue(spark, sf), h, items_unique=True)
    return normalise(fs.df, HIST_COLS_NUM + ["cobertura_bruta", "ratio_stock_seguridad"])


@query("f4_stock_features_7d", _stock_sql(7))
def f4_stock_features_7d(spark, sf, consumo=None):
    return _stock(spark, sf, 7, consumo)


@query("f4_stock_features_14d", _stock_sql(14))
def f4_stock_features_14d(spark, sf, consumo=None):
    return _stock(spark, sf, 14, consumo)


def _demand_sql() -> str:
    num = [f"{O.R(c)} AS {c}" if c in HIST_COLS_NUM or c == "base_x_ocupacion" else c for c in FE.DEMAND_NUM]
    nn = " AND ".join(f"{c} IS NOT NULL" for c in FE.DEMAND_NUM)
    return O.with_(O.CONSUMO, O.history(60)) + f"""
, s AS (SELECT *, consumo_base_por_familia * ocupacion_familias AS base_x_ocupacion FROM hist)
SELECT {", ".join(num)}, COALESCE(categoria, 'desconocido') AS categoria, item_id,
       consumo_real AS label, fecha AS split_date
FROM s WHERE {nn} AND consumo_real IS NOT NULL"""


@query("f5_demand_features", _demand_sql())
def f5_demand_features(spark, sf, consumo=None):
    fs = FE.demand_features(consumo or roles.consumo(spark, sf), roles.catalogue(spark, sf), items_unique=True)
    return normalise(fs.df, HIST_COLS_NUM + ["base_x_ocupacion"])


@query(
    "p13_safe_ratio_clip",
    O.with_(O.CONSUMO, O.history(60)) + """
SELECT fecha, item_id,
  """ + O.R("CASE WHEN stock_inicio / NULLIF(consumo_roll7, 0) > 120 THEN 120.0 ELSE stock_inicio / NULLIF(consumo_roll7, 0) END") + """ AS cobertura_bruta,
  CASE WHEN consumo_roll7 = 0 THEN 1 ELSE 0 END AS zero_mean
FROM hist""",
    note="P12 + P13: zero denominator -> NULL, clip keeps NULL",
)
def p13_safe_ratio_clip(spark, sf):
    h = FE.inventory_history(roles.consumo(spark, sf), roles.catalogue(spark, sf), items_unique=True)
    return h.select(
        "fecha", "item_id",
        R(X.clip_upper(X.safe_ratio("stock_inicio", "consumo_roll7"), 120.0)).alias("cobertura_bruta"),
        F.when(F.col("consumo_roll7") == 0, 1).otherwise(0).alias("zero_mean"),
    )


@query(
    "p14_date_parts",
    O.with_(O.PANEL) + """
SELECT fecha, item_id, CAST(isodow(fecha) - 1 AS INTEGER) AS dia_semana, CAST(month(fecha) AS INTEGER) AS mes FROM panel""",
)
def p14_date_parts(spark, sf):
    return _panel(spark, sf).select("fecha", "item_id", X.weekday_monday0("fecha").alias("dia_semana"), F.month("fecha").alias("mes"))


NULLED_SQL = """
, pn AS (SELECT fecha, item_id,
           CASE WHEN dayofyear(fecha) % 10 = 0 THEN NULL ELSE consumo_real END AS consumo_real,
           CASE WHEN dayofyear(fecha) % 10 = 5 THEN NULL ELSE ingreso_stock END AS ingreso_stock
         FROM panel)"""


@query(
    "w3_windows_with_nulls",
    O.with_(O.PANEL) + NULLED_SQL + f"""
SELECT fecha, item_id, LAG(consumo_real, 1) OVER ({W_SQL}) AS consumo_lag_1,
  {_trailing_sql('AVG', 'consumo_real', 7, 3, 'consumo_roll7')},
  {_trailing_sql('STDDEV_SAMP', 'consumo_real', 7, 3, 'consumo_std7')},
  {_trailing_sql('SUM', 'ingreso_stock', 7, 3, 'ingreso_roll7')},
  CASE WHEN date_diff('day', MAX(CASE WHEN ingreso_stock > 0 THEN fecha END) OVER ({W_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), fecha) > 14
       THEN 14 ELSE CAST(date_diff('day', MAX(CASE WHEN ingreso_stock > 0 THEN fecha END)
            OVER ({W_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), fecha) AS INTEGER) END AS dias_sin_ingreso
FROM pn""",
    note="NULLs injected by day of year: minimum counts see only non-null values, NULL restocks never count",
)
def w3_windows_with_nulls(spark, sf):
    doy = F.dayofyear("fecha")
    p = _panel(spark, sf).select(
        "fecha", "item_id",
        F.when(doy % 10 == 0, F.lit(None)).otherwise(F.col("consumo_real")).cast("double").alias("consumo_real"),
        F.when(doy % 10 == 5, F.lit(None)).otherwise(F.col("ingreso_stock")).cast("double").alias("ingreso_stock"),
    )
    w = W.series_window("item_id", "fecha")
    return p.select(
        "fecha", "item_id", F.lag("consumo_real", 1).over(w).alias("consumo_lag_1"),
        R(W.trailing_mean("consumo_real", w, 7, 3)).alias("consumo_roll7"),
        R(W.trailing_std("consumo_real", w, 7, 3)).alias("consumo_std7"),
        R(W.trailing_sum("ingreso_stock", w, 7, 3)).alias("ingreso_roll7"),
        W.days_since_last(F.col("ingreso_stock") > 0, "fecha", w, 14).alias("dias_sin_ingreso"),
    )
