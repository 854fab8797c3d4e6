"""Report queries (A1-A30) and the entity / monthly feature sets."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import features as FE
from ..operators import metrics as M
from ..operators import profile as P
from ..sources.tables import read_table
from . import oracle as O
from . import roles
from .oracle import R as SR
from .registry import R, materialise, normalise, query

# Column lists of the driver tables used by the whole-catalogue reports.
PROFILED = {
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "region": ["r_regionkey", "r_name"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "labels": ["doc_id", "quality", "toxic"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "conversations": ["conv_id", "turn", "role", "text"],
}


def _datasets(spark, sf):
    return {t: read_table(spark, sf, t).select(*cols) for t, cols in PROFILED.items()}


def _a1_sql():
    parts = []
    for t, cols in PROFILED.items():
        nulls = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in cols)
        parts.append(f"""SELECT '{t}' AS dataset, CAST(COALESCE(SUM(_cnt), 0) AS BIGINT) AS filas, {len(cols)} AS columnas,
  CAST(COALESCE(SUM(_cnt - 1), 0) AS BIGINT) AS duplicados, CAST(COALESCE(SUM(_cnt * ({nulls})), 0) AS BIGINT) AS valores_nulos_totales
FROM (SELECT {", ".join(cols)}, COUNT(*) AS _cnt FROM {t} GROUP BY ALL) g""")
    return "\nUNION ALL\n".join(parts)


@query("a1_dataset_summary", _a1_sql())
def a1_dataset_summary(spark, sf):
    return P.dataset_summary(_datasets(spark, sf))


def _a2_sql():
    parts = []
    for t, cols in PROFILED.items():
        for c in cols:
            parts.append(f"""SELECT '{t}' AS dataset, '{c}' AS columna, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS nulos,
  {SR(f"(CAST(COUNT(*) - COUNT({c}) AS DOUBLE) / COUNT(*)) * 100", 2)} AS porcentaje_nulos FROM {t}""")
    return "\nUNION ALL\n".join(parts)


@query("a2_null_report", _a2_sql())
def a2_null_report(spark, sf):
    return P.null_report(_datasets(spark, sf))


IQR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _long_sql(table: str, cols, cast="DOUBLE", keep=""):
    k = f"{keep}, " if keep else ""
    return " UNION ALL ".join(f"SELECT {k}'{c}' AS variable, CAST({c} AS {cast}) AS value FROM {table}" for c in cols)


@query(
    "a3_iqr_outliers",
    f"""WITH long AS ({_long_sql('lineitem', IQR_COLS)}),
q AS (SELECT variable, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM long WHERE value IS NOT NULL GROUP BY variable),
lim AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS li, q3 + 1.5 * (q3 - q1) AS ls FROM q)
SELECT lim.variable, {SR('q1', 9)} AS q1, {SR('q3', 9)} AS q3, {SR('iqr', 9)} AS iqr, {SR('li', 9)} AS limite_inferior,
       {SR('ls', 9)} AS limite_superior,
       CAST((SELECT COUNT(*) FROM long WHERE long.variable = lim.variable AND (long.value < lim.li OR long.value > lim.ls)) AS BIGINT) AS cantidad_outliers
FROM lim""",
)
def a3_iqr_outliers(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return normalise(P.iqr_outliers(li, IQR_COLS), ["q1", "q3", "iqr", "limite_inferior", "limite_superior"], 9)


DESC_NUM = ["c_custkey", "c_nationkey", "c_acctbal"]
DESC_TXT = ["c_name", "c_mktsegment"]


@query(
    "a4_describe_customer",
    f"""WITH num AS ({_long_sql('customer', DESC_NUM)}),
txt AS ({_long_sql('customer', DESC_TXT, 'VARCHAR')}),
vc AS (SELECT variable, value, COUNT(*) AS c FROM txt WHERE value IS NOT NULL GROUP BY ALL)
SELECT variable, COUNT(value) AS count, CAST(NULL AS BIGINT) AS "unique", CAST(NULL AS VARCHAR) AS top,
       CAST(NULL AS BIGINT) AS freq, {SR('AVG(value)')} AS mean, {SR('STDDEV_SAMP(value)')} AS std, MIN(value) AS min,
       {SR('quantile_cont(value, 0.25)', 9)} AS q25, {SR('quantile_cont(value, 0.5)', 9)} AS q50,
       {SR('quantile_cont(value, 0.75)', 9)} AS q75, MAX(value) AS max
FROM num GROUP BY variable
UNION ALL
SELECT variable, CAST(SUM(c) AS BIGINT), CAST(COUNT(*) AS BIGINT), first(value ORDER BY c DESC, value ASC), CAST(MAX(c) AS BIGINT),
       NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM vc GROUP BY variable""",
)
def a4_describe_customer(spark, sf):
    c = read_table(spark, sf, "customer").select(*DESC_NUM, *DESC_TXT)
    return normalise(normalise(P.describe(c), ["mean", "std"]), ["q25", "q50", "q75"], 9)


@query(
    "a5_priority_counts",
    O.with_(O.PACIENTES) + f"""
SELECT nivel_prioridad_atencion, COUNT(*) AS cantidad,
       {SR("(CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM pacientes)) * 100", 2)} AS porcentaje
FROM pacientes WHERE nivel_prioridad_atencion IS NOT NULL GROUP BY nivel_prioridad_atencion""",
)
def a5_priority_counts(spark, sf):
    return P.value_counts(roles.pacientes(spark, sf), "nivel_prioridad_atencion")


@query(
    "a6_crosstab_state_priority",
    O.with_(O.PACIENTES) + """
SELECT estado_tratamiento,
  COUNT(*) FILTER (WHERE nivel_prioridad_atencion = 'Bajo') AS Bajo,
  COUNT(*) FILTER (WHERE nivel_prioridad_atencion = 'Medio') AS Medio,
  COUNT(*) FILTER (WHERE nivel_prioridad_atencion = 'Alto') AS Alto
FROM pacientes WHERE estado_tratamiento IS NOT NULL AND nivel_prioridad_atencion IS NOT NULL
GROUP BY estado_tratamiento""",
)
def a6_crosstab_state_priority(spark, sf):
    return P.crosstab(roles.pacientes(spark, sf), "estado_tratamiento", "nivel_prioridad_atencion", X.PRIORITY_CLASSES)


CORR_COLS = [
    "edad", "dias_hospedaje", "num_controles_mes", "num_quimios_mes", "hemoglobina_g_dl", "neutrofilos",
    "plaquetas", "temperatura_c", "peso_kg", "imc", "distancia_origen_km", "ingreso_familiar_mensual",
    "acompanante_presente", "requiere_apoyo_psicosocial",
]


def _a7_sql():
    sel, rows = [], []
    for i, a in enumerate(CORR_COLS):
        for b in CORR_COLS[i:]:
            both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
            xa, xb = f"CASE WHEN {both} THEN CAST({a} AS DOUBLE) END", f"CASE WHEN {both} THEN CAST({b} AS DOUBLE) END"
            tag = f"{i}_{CORR_COLS.index(b)}"
            sel.append(f"covar_pop({xa}, {xb}) / NULLIF(stddev_pop({xa}) * stddev_pop({xb}), 0) AS r{tag}")
            rows.append(f"SELECT '{a}' AS var_a, '{b}' AS var_b, {SR(f'r{tag}')} AS corr FROM one")
            if a != b:
                rows.append(f"SELECT '{b}' AS var_a, '{a}' AS var_b, {SR(f'r{tag}')} AS corr FROM one")
    return O.with_(O.PACIENTES) + f""", one AS (SELECT {", ".join(sel)} FROM pacientes)
""" + "\nUNION ALL\n".join(rows)


@query("a7_correlation", _a7_sql())
def a7_correlation(spark, sf):
    return normalise(P.correlation_long(roles.pacientes(spark, sf), CORR_COLS), ["corr"])


@query(
    "a8_alert_rates",
    O.with_(O.CONSUMO) + f"""
SELECT 'stock_critico_7d' AS target, CAST(COALESCE(SUM(stock_critico_7d), 0) AS BIGINT) AS cantidad_alertas,
       {SR('AVG(stock_critico_7d) * 100', 2)} AS porcentaje_alertas FROM consumo
UNION ALL
SELECT 'stock_critico_14d', CAST(COALESCE(SUM(stock_critico_14d), 0) AS BIGINT), {SR('AVG(stock_critico_14d) * 100', 2)} FROM consumo""",
)
def a8_alert_rates(spark, sf):
    return P.alert_summary(roles.consumo(spark, sf), ["stock_critico_7d", "stock_critico_14d"])


@query(
    "a9_category_summary",
    O.with_(O.CONSUMO) + f"""
SELECT categoria, {SR('AVG(consumo_real)')} AS consumo_promedio, {SR('COALESCE(SUM(consumo_real), 0)')} AS consumo_total,
       {SR('AVG(stock_fin)')} AS stock_promedio, {SR('AVG(dias_cobertura)')} AS dias_cobertura_promedio,
       {SR('AVG(stock_critico_7d) * 100', 2)} AS alerta_7d_rate, {SR('AVG(stock_critico_14d) * 100', 2)} AS alerta_14d_rate
FROM consumo WHERE categoria IS NOT NULL GROUP BY categoria""",
)
def a9_category_summary(spark, sf):
    c = roles.consumo(spark, sf).where(F.col("categoria").isNotNull())
    out = c.groupBy("categoria").agg(
        R(F.avg("consumo_real")).alias("consumo_promedio"),
        R(F.coalesce(F.sum("consumo_real"), F.lit(0.0))).alias("consumo_total"),
        R(F.avg("stock_fin")).alias("stock_promedio"),
        R(F.avg("dias_cobertura")).alias("dias_cobertura_promedio"),
        X.pct(F.avg("stock_critico_7d")).alias("alerta_7d_rate"),
        X.pct(F.avg("stock_critico_14d")).alias("alerta_14d_rate"),
    )
    return out


@query(
    "a10_top_items",
    O.with_(O.CONSUMO) + f"""
SELECT item_id, nombre_item, categoria, {SR('COALESCE(SUM(consumo_real), 0)')} AS consumo_total,
       {SR('AVG(consumo_real)')} AS consumo_promedio,
       CAST(COALESCE(SUM(stock_critico_7d), 0) AS BIGINT) AS alertas_7d, CAST(COALESCE(SUM(stock_critico_14d), 0) AS BIGINT) AS alertas_14d
FROM consumo WHERE item_id IS NOT NULL AND nombre_item IS NOT NULL AND categoria IS NOT NULL
GROUP BY item_id, nombre_item, categoria
ORDER BY consumo_total DESC, item_id LIMIT 10""",
    note="T1: top-10 is the feature; ties broken by item_id",
)
def a10_top_items(spark, sf):
    c = roles.consumo(spark, sf).dropna(subset=["item_id", "nombre_item", "categoria"])
    g = c.groupBy("item_id", "nombre_item", "categoria").agg(
        R(F.coalesce(F.sum("consumo_real"), F.lit(0.0))).alias("consumo_total"),
        R(F.avg("consumo_real")).alias("consumo_promedio"),
        F.coalesce(F.sum("stock_critico_7d"), F.lit(0)).cast("long").alias("alertas_7d"),
        F.coalesce(F.sum("stock_critico_14d"), F.lit(0)).cast("long").alias("alertas_14d"),
    )
    return g.orderBy(F.col("consumo_total").desc(), "item_id").limit(10)


A11_SQL = O.with_(O.CONSUMO) + f"""
SELECT fecha, {SR('AVG(ocupacion_familias)')} AS ocupacion_familias, {SR('COALESCE(SUM(consumo_real), 0)')} AS consumo_total_diario,
       {SR('COALESCE(SUM(stock_fin), 0)')} AS stock_total_fin,
       CAST(COALESCE(SUM(stock_critico_7d), 0) AS BIGINT) AS alertas_7d, CAST(COALESCE(SUM(stock_critico_14d), 0) AS BIGINT) AS alertas_14d
FROM consumo WHERE fecha IS NOT NULL GROUP BY fecha"""


def _daily(spark, sf):
    c = roles.consumo(spark, sf).where(F.col("fecha").isNotNull())
    return c.groupBy("fecha").agg(
        R(F.avg("ocupacion_familias")).alias("ocupacion_familias"),
        R(F.coalesce(F.sum("consumo_real"), F.lit(0.0))).alias("consumo_total_diario"),
        R(F.coalesce(F.sum("stock_fin"), F.lit(0.0))).alias("stock_total_fin"),
        F.coalesce(F.sum("stock_critico_7d"), F.lit(0)).cast("long").alias("alertas_7d"),
        F.coalesce(F.sum("stock_critico_14d"), F.lit(0)).cast("long").alias("alertas_14d"),
    )


@query("a11_daily_totals", A11_SQL)
def a11_daily_totals(spark, sf):
    return _daily(spark, sf)


@query(
    "a30_daily_series",
    A11_SQL.replace("SELECT fecha, ", "SELECT fecha, ", 1),
    note="A30: the daily series behind the occupancy/consumption plots, ordered by date",
)
def a30_daily_series(spark, sf):
    return _daily(spark, sf).orderBy("fecha")


@query(
    "a12_donor_type",
    O.with_(O.DONACIONES) + f"""
SELECT tipo_donante, COUNT(donacion_id) AS cantidad_donaciones, CAST(COALESCE(SUM(cantidad_donada), 0) AS BIGINT) AS cantidad_total_donada,
       {SR('COALESCE(SUM(valor_estimado_soles), 0)', 2)} AS valor_total_soles, {SR('AVG(valor_estimado_soles)')} AS valor_promedio_soles
FROM donaciones WHERE tipo_donante IS NOT NULL GROUP BY tipo_donante""",
)
def a12_donor_type(spark, sf):
    d = roles.donaciones(spark, sf).where(F.col("tipo_donante").isNotNull())
    return d.groupBy("tipo_donante").agg(
        F.count("donacion_id").alias("cantidad_donaciones"),
        F.coalesce(F.sum("cantidad_donada"), F.lit(0)).cast("long").alias("cantidad_total_donada"),
        R(F.coalesce(F.sum("valor_estimado_soles"), F.lit(0.0)), 2).alias("valor_total_soles"),
        R(F.avg("valor_estimado_soles")).alias("valor_promedio_soles"),
    ).orderBy(F.col("valor_total_soles").desc())


@query(
    "a13_donation_category",
    O.with_(O.DONACIONES) + f"""
SELECT categoria, COUNT(donacion_id) AS cantidad_donaciones, CAST(COALESCE(SUM(cantidad_donada), 0) AS BIGINT) AS cantidad_total_donada,
       {SR('COALESCE(SUM(valor_estimado_soles), 0)', 2)} AS valor_total_soles
FROM donaciones WHERE categoria IS NOT NULL GROUP BY categoria""",
)
def a13_donation_category(spark, sf):
    d = roles.donaciones(spark, sf).where(F.col("categoria").isNotNull())
    return d.groupBy("categoria").agg(
        F.count("donacion_id").alias("cantidad_donaciones"),
        F.coalesce(F.sum("cantidad_donada"), F.lit(0)).cast("long").alias("cantidad_total_donada"),
        R(F.coalesce(F.sum("valor_estimado_soles"), F.lit(0.0)), 2).alias("valor_total_soles"),
    ).orderBy(F.col("valor_total_soles").desc())


@query(
    "a14_confidence_by_type",
    O.with_(O.CAPTURAS) + f"""
SELECT tipo_documento, {SR('AVG(confianza_ocr)')} AS confianza_promedio FROM capturas
WHERE tipo_documento IS NOT NULL GROUP BY tipo_documento""",
)
def a14_confidence_by_type(spark, sf):
    c = roles.capturas(spark, sf).where(F.col("tipo_documento").isNotNull())
    return c.groupBy("tipo_documento").agg(R(F.avg("confianza_ocr")).alias("confianza_promedio")).orderBy(
        F.col("confianza_promedio").desc()
    )


MONTHLY_SQL = """
monthly AS (
  SELECT CAST(date_trunc('month', fecha) AS DATE) AS mes_periodo, categoria,
         COALESCE(SUM(valor_estimado_soles), 0.0) AS valor_total_soles, COUNT(donacion_id) AS num_donaciones
  FROM donaciones WHERE categoria IS NOT NULL GROUP BY 1, 2
)"""


@query(
    "a15_monthly_series",
    O.with_(O.DONACIONES, MONTHLY_SQL) + f"""
SELECT mes_periodo, categoria, {SR('valor_total_soles', 2)} AS valor_total_soles, num_donaciones FROM monthly""",
)
def a15_monthly_series(spark, sf):
    m = FE.monthly_series(roles.donaciones(spark, sf))
    return m.withColumn("valor_total_soles", R("valor_total_soles", 2))


@query(
    "a16_trend_index",
    O.with_(O.DONACIONES, MONTHLY_SQL) + """
SELECT mes_periodo, categoria, CAST(date_diff('month', (SELECT MIN(mes_periodo) FROM monthly), mes_periodo) AS INTEGER) AS tendencia
FROM monthly""",
)
def a16_trend_index(spark, sf):
    m = FE.monthly_series(roles.donaciones(spark, sf))
    first = m.agg(F.min("mes_periodo").alias("_first"))
    return P._const_join(m, first).select("mes_periodo", "categoria", F.months_between("mes_periodo", "_first").cast("int").alias("tendencia"))


def _f6_sql(select_cols: str, where_all: bool = True) -> str:
    nn = " AND ".join(f"{c} IS NOT NULL" for c in FE.DONATION_NUM)
    return O.with_(O.DONACIONES, MONTHLY_SQL) + f"""
, m2 AS (
  SELECT m.*, LAG(valor_total_soles, 1) OVER w AS valor_lag_1, LAG(valor_total_soles, 2) OVER w AS valor_lag_2,
    LAG(valor_total_soles, 3) OVER w AS valor_lag_3,
    CASE WHEN COUNT(valor_total_soles) OVER w3 >= 3 THEN AVG(valor_total_soles) OVER w3 END AS valor_roll3,
    CASE WHEN COUNT(valor_total_soles) OVER w6 >= 3 THEN AVG(valor_total_soles) OVER w6 END AS valor_roll6,
    CAST(LAG(num_donaciones, 1) OVER w AS DOUBLE) AS donaciones_lag_1,
    CAST(month(mes_periodo) AS INTEGER) AS mes,
    CAST(date_diff('month', (SELECT MIN(mes_periodo) FROM monthly), mes_periodo) AS INTEGER) AS tendencia
  FROM monthly m
  WINDOW w AS (PARTITION BY categoria ORDER BY mes_periodo),
         w3 AS (PARTITION BY categoria ORDER BY mes_periodo ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
         w6 AS (PARTITION BY categoria ORDER BY mes_periodo ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)
), m3 AS (
  SELECT *, sin({2 * 3.141592653589793!r} * mes / 12.0) AS mes_sin, cos({2 * 3.141592653589793!r} * mes / 12.0) AS mes_cos,
         CAST(mes IN (5, 8, 12) AS DOUBLE) AS mes_campania FROM m2
)
SELECT {select_cols} FROM m3""" + (f" WHERE {nn}" if where_all else "")


MONEY = ["valor_lag_1", "valor_lag_2", "valor_lag_3", "valor_roll3", "valor_roll6", "label", "valor_total_soles"]


@query(
    "f6_donation_features",
    _f6_sql(", ".join(
        [f"{SR(c, 4)} AS {c}" for c in ["valor_lag_1", "valor_lag_2", "valor_lag_3", "valor_roll3", "valor_roll6"]]
        + ["donaciones_lag_1", "tendencia", "mes", f"{SR('mes_sin')} AS mes_sin", f"{SR('mes_cos')} AS mes_cos", "mes_campania",
           "categoria", f"{SR('valor_total_soles', 4)} AS label", "mes_periodo AS split_date"]
    )),
)
def f6_donation_features(spark, sf):
    fs = FE.donation_features(roles.donaciones(spark, sf))
    return normalise(normalise(fs.df, MONEY, 4), ["mes_sin", "mes_cos"])


@query(
    "w7_monthly_lags",
    _f6_sql(f"mes_periodo, categoria, {SR('valor_lag_1', 4)} AS valor_lag_1, {SR('valor_lag_2', 4)} AS valor_lag_2, "
            f"{SR('valor_lag_3', 4)} AS valor_lag_3, donaciones_lag_1", where_all=False),
)
def w7_monthly_lags(spark, sf):
    from ..operators import windows as W

    m = FE.monthly_series(roles.donaciones(spark, sf))
    w = W.series_window("categoria", "mes_periodo")
    out = m.select("mes_periodo", "categoria", *[v.alias(k) for k, v in W.lags("valor_total_soles", w, [1, 2, 3], "valor_lag_").items()],
                   F.lag("num_donaciones", 1).over(w).cast("double").alias("donaciones_lag_1"))
    return normalise(out, ["valor_lag_1", "valor_lag_2", "valor_lag_3"], 4)


@query(
    "w8_monthly_rolling",
    _f6_sql(f"mes_periodo, categoria, {SR('valor_roll3', 4)} AS valor_roll3, {SR('valor_roll6', 4)} AS valor_roll6", where_all=False),
)
def w8_monthly_rolling(spark, sf):
    from ..operators import windows as W

    m = FE.monthly_series(roles.donaciones(spark, sf))
    w = W.series_window("categoria", "mes_periodo")
    out = m.select("mes_periodo", "categoria", W.rolling(F.avg, "valor_total_soles", w, -3, -1, 3).alias("valor_roll3"),
                   W.rolling(F.avg, "valor_total_soles", w, -6, -1, 3).alias("valor_roll6"))
    return normalise(out, ["valor_roll3", "valor_roll6"], 4)


HIST_BINS = 30


@query(
    "a17_histogram",
    f"""WITH v AS (SELECT l_extendedprice AS x FROM lineitem WHERE l_extendedprice IS NOT NULL),
r0 AS (SELECT MIN(x) AS lo0, MAX(x) AS hi0 FROM v),
r AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM r0),
c AS (SELECT CAST(LEAST(FLOOR((x - lo) / (hi - lo) * {float(HIST_BINS)!r}), {HIST_BINS - 1}) AS INTEGER) AS bin, COUNT(*) AS n FROM v, r GROUP BY 1),
g AS (SELECT CAST(b AS INTEGER) AS bin FROM range(0, {HIST_BINS}) t(b))
SELECT g.bin, {SR('lo + g.bin * ((hi - lo) / 30.0)')} AS bin_lo,
       {SR(f'CASE WHEN g.bin = {HIST_BINS - 1} THEN hi ELSE lo + (g.bin + 1) * ((hi - lo) / 30.0) END')} AS bin_hi,
       COALESCE(c.n, 0) AS n
FROM g CROSS JOIN r LEFT JOIN c ON g.bin = c.bin""",
)
def a17_histogram(spark, sf):
    h = P.histogram(read_table(spark, sf, "lineitem"), "l_extendedprice", HIST_BINS)
    return normalise(h, ["bin_lo", "bin_hi"])


@query(
    "a18_boxplot_by_priority",
    O.with_(O.PACIENTES) + f"""
, b AS (SELECT nivel_prioridad_atencion AS g, hemoglobina_g_dl AS x FROM pacientes WHERE nivel_prioridad_atencion IS NOT NULL AND hemoglobina_g_dl IS NOT NULL),
q AS (SELECT g, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS mediana, quantile_cont(x, 0.75) AS q3 FROM b GROUP BY g),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f.g AS nivel_prioridad_atencion, {SR('f.q1', 9)} AS q1, {SR('f.mediana', 9)} AS mediana, {SR('f.q3', 9)} AS q3,
       {SR('MIN(CASE WHEN b.x >= f.lo AND b.x <= f.hi THEN b.x END)', 9)} AS bigote_inf,
       {SR('MAX(CASE WHEN b.x >= f.lo AND b.x <= f.hi THEN b.x END)', 9)} AS bigote_sup,
       CAST(SUM(CASE WHEN b.x >= f.lo AND b.x <= f.hi THEN 0 ELSE 1 END) AS BIGINT) AS n_atipicos, COUNT(*) AS n
FROM f JOIN b ON f.g = b.g GROUP BY f.g, f.q1, f.mediana, f.q3""",
)
def a18_boxplot_by_priority(spark, sf):
    out = P.boxplot_stats(roles.pacientes(spark, sf), "hemoglobina_g_dl", "nivel_prioridad_atencion")
    return normalise(out, ["q1", "mediana", "q3", "bigote_inf", "bigote_sup"], 9)


#: Columns of the box plots by priority.
BOXPLOT_COLS = ["hemoglobina_g_dl", "neutrofilos", "plaquetas", "temperatura_c", "imc", "ingreso_familiar_mensual"]


@query(
    "a18_boxplots",
    O.with_(O.PACIENTES) + f"""
, b AS (SELECT nivel_prioridad_atencion AS g, variable, value AS x FROM
          ({_long_sql('pacientes', BOXPLOT_COLS, keep='nivel_prioridad_atencion')}) l
        WHERE nivel_prioridad_atencion IS NOT NULL AND value IS NOT NULL),
q AS (SELECT g, variable, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS mediana, quantile_cont(x, 0.75) AS q3 FROM b GROUP BY ALL),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f.variable, f.g AS nivel_prioridad_atencion, {SR('f.q1', 9)} AS q1, {SR('f.mediana', 9)} AS mediana, {SR('f.q3', 9)} AS q3,
       {SR('MIN(CASE WHEN b.x >= f.lo AND b.x <= f.hi THEN b.x END)', 9)} AS bigote_inf,
       {SR('MAX(CASE WHEN b.x >= f.lo AND b.x <= f.hi THEN b.x END)', 9)} AS bigote_sup,
       CAST(SUM(CASE WHEN b.x >= f.lo AND b.x <= f.hi THEN 0 ELSE 1 END) AS BIGINT) AS n_atipicos, COUNT(*) AS n
FROM f JOIN b ON f.g = b.g AND f.variable = b.variable GROUP BY f.variable, f.g, f.q1, f.mediana, f.q3""",
    note="six clinical columns in one pass over a long table",
)
def a18_boxplots(spark, sf):
    out = P.boxplots(roles.pacientes(spark, sf), BOXPLOT_COLS, "nivel_prioridad_atencion")
    return normalise(out, ["q1", "mediana", "q3", "bigote_inf", "bigote_sup"], 9)


#: Feature sets of the signal ranking: model, registered feature query, numbers, categories, continuous label.
SIGNAL_SETS = [
    ("prioridad_atencion", "f1_priority_features", FE.PRIORITY_NUM, FE.CLINICAL_CAT, False),
    ("stock_critico_7d", "f4_stock_features_7d", FE.STOCK_NUM, FE.STOCK_CAT, False),
    ("stock_critico_14d", "f4_stock_features_14d", FE.STOCK_NUM, FE.STOCK_CAT, False),
    ("demanda_consumo", "f5_demand_features", FE.DEMAND_NUM, FE.DEMAND_CAT, True),
    ("duracion_estadia", "f2_stay_features", FE.STAY_NUM, FE.CLINICAL_CAT, True),
    ("proyeccion_donaciones", "f6_donation_features", FE.DONATION_NUM, ["categoria"], True),
]


def _signal_sql(model: str, features_sql: str, num, cat, regression: bool) -> str:
    binned = [*num, *(["label"] if regression else [])]
    num_long = " UNION ALL ".join(f"SELECT rid, '{c}' AS variable, CAST({c} AS DOUBLE) AS value FROM f" for c in binned)
    cat_long = " UNION ALL ".join(f"SELECT rid, '{c}' AS variable, COALESCE(CAST({c} AS VARCHAR), '∅') AS x FROM f" for c in cat)
    probs = ", ".join(repr(i / 10) for i in range(1, 10))
    label = "SELECT rid, x AS y FROM b WHERE variable = 'label'" if regression else "SELECT rid, CAST(label AS VARCHAR) AS y FROM f"
    return f"""SELECT '{model}' AS modelo, * FROM (
WITH f AS (SELECT *, ROW_NUMBER() OVER () AS rid FROM ({features_sql}) q WHERE label IS NOT NULL),
l AS ({num_long}),
srt AS (SELECT variable, list_sort(list(value) FILTER (value IS NOT NULL)) AS v, COUNT(value) AS n FROM l GROUP BY variable),
e AS (SELECT variable, list_transform(CAST([{probs}] AS DOUBLE[]), lambda p: v[1 + CAST(floor(p * (n - 1)) AS BIGINT)]) AS e FROM srt),
b AS (SELECT rid, l.variable, CASE WHEN value IS NULL THEN '-1'
             ELSE CAST(len(list_filter(e.e, lambda c: c <= value)) AS VARCHAR) END AS x FROM l JOIN e ON l.variable = e.variable),
yy AS ({label}),
j AS (SELECT variable, x, y, COUNT(*) AS nxy FROM (SELECT * FROM b WHERE variable <> 'label' UNION ALL {cat_long}) a JOIN yy USING (rid) GROUP BY ALL),
j2 AS (SELECT *, SUM(nxy) OVER (PARTITION BY variable) AS n, SUM(nxy) OVER (PARTITION BY variable, x) AS nx,
              SUM(nxy) OVER (PARTITION BY variable, y) AS ny FROM j)
SELECT variable, {SR('SUM((CAST(nxy AS DOUBLE) / n) * ln((CAST(nxy AS DOUBLE) * n) / (CAST(nx AS DOUBLE) * ny)))')} AS mutual_information
FROM j2 GROUP BY variable)"""


def _a19_sql():
    from .registry import QUERIES

    parts = [_signal_sql(m, QUERIES[q].sql, num, cat, reg) for m, q, num, cat, reg in SIGNAL_SETS]
    every = "\nUNION ALL\n".join(parts)
    return f"SELECT *, ROW_NUMBER() OVER (PARTITION BY modelo ORDER BY mutual_information DESC, variable) AS posicion FROM ({every}) s"


def a19_signal(spark, sf):
    from .registry import QUERIES

    # tables that several feature sets are built from: derived once
    pacientes, consumo = materialise(roles.pacientes(spark, sf)), materialise(roles.consumo(spark, sf))
    built = {"f1_priority_features": {"pacientes": pacientes}, "f2_stay_features": {"pacientes": pacientes}}
    built |= {name: {"consumo": consumo} for name in ("f4_stock_features_7d", "f4_stock_features_14d", "f5_demand_features")}
    out = None
    for model, name, num, cat, regression in SIGNAL_SETS:
        # three passes over a derived table: written once
        rows = materialise(QUERIES[name].build(spark, sf, **built.get(name, {})).select(*num, *cat, "label"))
        one = P.mutual_information(rows, "label", num, cat, regression=regression).select(F.lit(model).alias("modelo"), "*")
        out = one if out is None else out.unionByName(one)
    order = Window.partitionBy("modelo").orderBy(F.col("mutual_information").desc(), "variable")  # a row for each feature
    return normalise(out, ["mutual_information"]).withColumn("posicion", F.row_number().over(order).cast("long"))


@query(
    "a20_classification_metrics",
    O.with_(O.CLASS_PRED) + f"""
, pc AS (SELECT y_true AS t, y_pred AS p, COUNT(*) AS n FROM class_pred GROUP BY ALL),
lt AS (SELECT t AS label, SUM(n) AS support, SUM(CASE WHEN t = p THEN n ELSE 0 END) AS tp FROM pc GROUP BY t),
lp AS (SELECT p AS label, SUM(n) AS predicted FROM pc GROUP BY p),
k AS (SELECT COALESCE(lt.label, lp.label) AS label, COALESCE(support, 0) AS support, COALESCE(tp, 0) AS tp,
             COALESCE(predicted, 0) AS predicted FROM lt FULL JOIN lp ON lt.label = lp.label),
m AS (SELECT *, COALESCE(CAST(tp AS DOUBLE) / NULLIF(predicted, 0), 0.0) AS prec,
             COALESCE(CAST(tp AS DOUBLE) / NULLIF(support, 0), 0.0) AS rec,
             COALESCE(CAST(2 * tp AS DOUBLE) / NULLIF(2 * tp + (predicted - tp) + (support - tp), 0), 0.0) AS f1 FROM k)
SELECT {SR('CAST(SUM(tp) AS DOUBLE) / SUM(support)')} AS accuracy, {SR('AVG(prec)')} AS precision_macro,
       {SR('AVG(rec)')} AS recall_macro, {SR('AVG(f1)')} AS f1_macro,
       {SR('SUM(prec * support) / SUM(support)')} AS precision_weighted, {SR('SUM(rec * support) / SUM(support)')} AS recall_weighted,
       {SR('SUM(f1 * support) / SUM(support)')} AS f1_weighted
FROM m""",
)
def a20_classification_metrics(spark, sf):
    m = M.classification_metrics(roles.class_predictions(spark, sf))
    return normalise(m, m.columns)


@query(
    "a21_regression_metrics",
    O.with_(O.REG_PRED) + f"""
SELECT {SR('AVG(ABS(y_pred - y_true))')} AS mae, {SR('SQRT(AVG((y_pred - y_true) * (y_pred - y_true)))')} AS rmse,
       {SR('1.0 - SUM((y_pred - y_true) * (y_pred - y_true)) / NULLIF(COUNT(y_true) * VAR_POP(y_true), 0)')} AS r2
FROM reg_pred""",
)
def a21_regression_metrics(spark, sf):
    m = M.regression_metrics(roles.regression_predictions(spark, sf))
    return normalise(m, m.columns)


@query(
    "a22_class_report",
    O.with_(O.CLASS_PRED) + f"""
, pc AS (SELECT y_true AS t, y_pred AS p, COUNT(*) AS n FROM class_pred GROUP BY ALL),
lt AS (SELECT t AS label, SUM(n) AS support, SUM(CASE WHEN t = p THEN n ELSE 0 END) AS tp FROM pc GROUP BY t),
lp AS (SELECT p AS label, SUM(n) AS predicted FROM pc GROUP BY p),
k AS (SELECT COALESCE(lt.label, lp.label) AS label, COALESCE(support, 0) AS support, COALESCE(tp, 0) AS tp,
             COALESCE(predicted, 0) AS predicted FROM lt FULL JOIN lp ON lt.label = lp.label),
m AS (SELECT *, COALESCE(CAST(tp AS DOUBLE) / NULLIF(predicted, 0), 0.0) AS prec,
             COALESCE(CAST(tp AS DOUBLE) / NULLIF(support, 0), 0.0) AS rec,
             COALESCE(CAST(2 * tp AS DOUBLE) / NULLIF(2 * tp + (predicted - tp) + (support - tp), 0), 0.0) AS f1 FROM k)
SELECT CAST(label AS VARCHAR) AS clase, {SR('prec')} AS precision, {SR('rec')} AS recall, {SR('f1')} AS f1_score,
       CAST(support AS DOUBLE) AS support FROM m
UNION ALL SELECT 'accuracy', {SR('CAST(SUM(tp) AS DOUBLE) / SUM(support)')}, {SR('CAST(SUM(tp) AS DOUBLE) / SUM(support)')},
       {SR('CAST(SUM(tp) AS DOUBLE) / SUM(support)')}, CAST(SUM(support) AS DOUBLE) FROM m
UNION ALL SELECT 'macro avg', {SR('AVG(prec)')}, {SR('AVG(rec)')}, {SR('AVG(f1)')}, CAST(SUM(support) AS DOUBLE) FROM m
UNION ALL SELECT 'weighted avg', {SR('SUM(prec * support) / SUM(support)')}, {SR('SUM(rec * support) / SUM(support)')},
       {SR('SUM(f1 * support) / SUM(support)')}, CAST(SUM(support) AS DOUBLE) FROM m""",
)
def a22_class_report(spark, sf):
    return normalise(M.class_report(roles.class_predictions(spark, sf)), ["precision", "recall", "f1_score"])


@query(
    "a23_confusion_matrix",
    O.with_(O.CLASS_PRED) + """
, lab AS (SELECT * FROM (VALUES (0, 0), (1, 1), (2, 2)) v(pos, t))
SELECT 'Real_' || CAST(lab.t AS VARCHAR) AS real, lab.pos,
  CAST(COUNT(c.y_pred) FILTER (WHERE c.y_pred = 0) AS BIGINT) AS Pred_0,
  CAST(COUNT(c.y_pred) FILTER (WHERE c.y_pred = 1) AS BIGINT) AS Pred_1,
  CAST(COUNT(c.y_pred) FILTER (WHERE c.y_pred = 2) AS BIGINT) AS Pred_2
FROM lab LEFT JOIN class_pred c ON c.y_true = lab.t GROUP BY lab.t, lab.pos""",
)
def a23_confusion_matrix(spark, sf):
    return M.confusion_matrix(roles.class_predictions(spark, sf), [0, 1, 2])


@query(
    "a24_class_balance",
    O.with_(O.CONSUMO, O.history(60)) + f"""
, s AS (SELECT CAST(stock_critico_7d AS INTEGER) AS label FROM hist WHERE stock_critico_7d IS NOT NULL AND consumo_roll7 IS NOT NULL)
SELECT label, COUNT(*) AS n, {SR('CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM s)')} AS share FROM s GROUP BY label""",
)
def a24_class_balance(spark, sf):
    fs = FE.stock_features(roles.consumo(spark, sf), roles.catalogue(spark, sf), 7, items_unique=True)
    return normalise(P.class_balance(fs.df, "label"), ["share"])


MEDIAN_COLS = ["hemoglobina_g_dl", "neutrofilos", "plaquetas", "imc", "ingreso_familiar_mensual", "temperatura_c"]


@query(
    "a25_medians",
    O.with_(O.PACIENTES) + f"""
, long AS ({_long_sql('pacientes', MEDIAN_COLS)})
SELECT variable, {SR('quantile_cont(value, 0.5)', 9)} AS mediana FROM long GROUP BY variable""",
)
def a25_medians(spark, sf):
    return normalise(P.medians(roles.pacientes(spark, sf), MEDIAN_COLS), ["mediana"], 9)


@query(
    "a26_vocabulary",
    O.with_(O.PACIENTES) + f"""
SELECT DISTINCT * FROM ({_long_sql('pacientes', FE.CLINICAL_CAT, 'VARCHAR')}) t WHERE value IS NOT NULL""",
)
def a26_vocabulary(spark, sf):
    return P.vocabulary(roles.pacientes(spark, sf), FE.CLINICAL_CAT)


@query(
    "a29_prediction_range",
    O.with_(O.REG_PRED) + """
SELECT LEAST(MIN(y_true), MIN(y_pred)) AS lo, GREATEST(MAX(y_true), MAX(y_pred)) AS hi, COUNT(*) AS n FROM reg_pred""",
)
def a29_prediction_range(spark, sf):
    return P.prediction_range(roles.regression_predictions(spark, sf))


# F1 / F2 / P5 / P26 -------------------------------------------------------------
CLIN_SQL = """
  neutrofilos < 500 AS _n5, neutrofilos < 200 AS _n2, temperatura_c >= 38.0 AS _fv
"""


def _clinical_select() -> str:
    return """CAST(neutrofilos < 500 AS DOUBLE) AS neutropenia,
  CAST(neutrofilos < 200 AS DOUBLE) AS neutropenia_severa,
  CAST(temperatura_c >= 38.0 AS DOUBLE) AS fiebre,
  CAST(neutrofilos < 500 AS DOUBLE) * CAST(temperatura_c >= 38.0 AS DOUBLE) AS neutropenia_febril,
  CAST(hemoglobina_g_dl < 8.0 AS DOUBLE) AS anemia_severa,
  CAST(plaquetas < 50000 AS DOUBLE) AS plaquetopenia,
  num_controles_mes + num_quimios_mes AS carga_clinica,
  COALESCE(CAST(ingreso_familiar_mensual < 600 AS DOUBLE), 0.0) + COALESCE(CAST(seguro_salud = 'Ninguno' AS DOUBLE), 0.0)
    + COALESCE(CAST(acompanante_presente = 0 AS DOUBLE), 0.0) + COALESCE(CAST(distancia_origen_km > 400 AS DOUBLE), 0.0) AS vulnerabilidad_social"""


def _entity_sql(num, label_sql: str, target: str) -> str:
    base = [c for c in num if c not in FE.CLINICAL_ENGINEERED]
    cats = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), 'desconocido') AS {c}" for c in FE.CLINICAL_CAT)
    return O.with_(O.PACIENTES) + f"""
SELECT {", ".join(base)}, {_clinical_select()}, {cats}, {label_sql} AS label
FROM pacientes WHERE {target} IS NOT NULL"""


@query(
    "f1_priority_features",
    _entity_sql(FE.PRIORITY_NUM, "CAST(CASE nivel_prioridad_atencion WHEN 'Bajo' THEN 0 WHEN 'Medio' THEN 1 WHEN 'Alto' THEN 2 END AS INTEGER)",
                "nivel_prioridad_atencion"),
)
def f1_priority_features(spark, sf, pacientes=None):
    return FE.priority_features(pacientes or roles.pacientes(spark, sf)).df


@query("f2_stay_features", _entity_sql(FE.STAY_NUM, "CAST(dias_hospedaje AS DOUBLE)", "dias_hospedaje"))
def f2_stay_features(spark, sf, pacientes=None):
    return FE.stay_features(pacientes or roles.pacientes(spark, sf)).df


@query(
    "p5_clinical_block",
    O.with_(O.PACIENTES) + f"""
SELECT paciente_id, {_clinical_select()} FROM pacientes""",
    note="P1-P5: flags keep NULL, vulnerability counts NULL as 0",
)
def p5_clinical_block(spark, sf):
    return roles.pacientes(spark, sf).select("paciente_id", *[v.alias(k) for k, v in X.clinical_block().items()])


@query(
    "p26_quantile_band",
    O.with_(O.PACIENTES) + """
SELECT paciente_id, nivel_prioridad_atencion FROM pacientes""",
)
def p26_quantile_band(spark, sf):
    return roles.pacientes(spark, sf).select("paciente_id", "nivel_prioridad_atencion")


# A6 (second table) -----------------------------------------------------------------
@query(
    "a6_crosstab_diagnosis_priority",
    O.with_(O.PACIENTES) + """
SELECT diagnostico_general,
  COUNT(*) FILTER (WHERE nivel_prioridad_atencion = 'Bajo') AS Bajo,
  COUNT(*) FILTER (WHERE nivel_prioridad_atencion = 'Medio') AS Medio,
  COUNT(*) FILTER (WHERE nivel_prioridad_atencion = 'Alto') AS Alto
FROM pacientes WHERE diagnostico_general IS NOT NULL AND nivel_prioridad_atencion IS NOT NULL
GROUP BY diagnostico_general""",
)
def a6_crosstab_diagnosis_priority(spark, sf):
    return P.crosstab(roles.pacientes(spark, sf), "diagnostico_general", "nivel_prioridad_atencion", X.PRIORITY_CLASSES)


# A4 over the domain tables -----------------------------------------------------------
DESCRIBED = {
    "pacientes": (["edad", "dias_hospedaje", "num_controles_mes", "num_quimios_mes", "hemoglobina_g_dl", "neutrofilos", "plaquetas"],
                  ["sexo", "region_origen", "diagnostico_general", "seguro_salud", "nivel_prioridad_atencion"]),
    "consumo": (["ocupacion_familias", "stock_inicio", "ingreso_stock", "consumo_real", "stock_fin"], ["item_id", "categoria", "unidad_medida"]),
    "donaciones": (["cantidad_donada", "valor_estimado_soles"], ["tipo_donante", "categoria", "campania"]),
    "capturas": (["confianza_ocr", "requiere_revision_manual"], ["tipo_documento", "calidad_imagen", "origen_captura"]),
}


def _describe_sql(table: str, num, txt) -> str:
    return f"""SELECT '{table}' AS dataset, * FROM (
WITH num AS ({_long_sql(table, num)}), txt AS ({_long_sql(table, txt, 'VARCHAR')}),
vc AS (SELECT variable, value, COUNT(*) AS c FROM txt WHERE value IS NOT NULL GROUP BY ALL)
SELECT variable, COUNT(value) AS count, CAST(NULL AS BIGINT) AS "unique", CAST(NULL AS VARCHAR) AS top,
       CAST(NULL AS BIGINT) AS freq, {SR('AVG(value)')} AS mean, {SR('STDDEV_SAMP(value)')} AS std, {SR('MIN(value)', 9)} AS min,
       {SR('quantile_cont(value, 0.25)', 9)} AS q25, {SR('quantile_cont(value, 0.5)', 9)} AS q50,
       {SR('quantile_cont(value, 0.75)', 9)} AS q75, {SR('MAX(value)', 9)} AS max
FROM num GROUP BY variable
UNION ALL
SELECT variable, CAST(SUM(c) AS BIGINT), CAST(COUNT(*) AS BIGINT), first(value ORDER BY c DESC, value ASC), CAST(MAX(c) AS BIGINT),
       NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM vc GROUP BY variable)"""


@query(
    "a4_describe_domains",
    O.with_(O.PACIENTES, O.CONSUMO, O.DONACIONES, O.CAPTURAS) + "\n" + "\nUNION ALL\n".join(_describe_sql(t, *c) for t, c in DESCRIBED.items()),
    note="numbers and texts of the four domain tables in one report",
)
def a4_describe_domains(spark, sf):
    tables = {"pacientes": roles.pacientes, "consumo": roles.consumo, "donaciones": roles.donaciones, "capturas": roles.capturas}
    out = None
    for name, (num, txt) in DESCRIBED.items():
        # four passes over a derived table: written once, these columns only
        rows = materialise(tables[name](spark, sf).select(*num, *txt))
        one = P.describe(rows).select(F.lit(name).alias("dataset"), "*")
        out = one if out is None else out.unionByName(one)
    return normalise(normalise(out, ["mean", "std"]), ["min", "q25", "q50", "q75", "max"], 9)
