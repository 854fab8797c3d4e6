"""DuckDB twins of the role bindings (``plans.roles``), as SQL CTE text.

Used only by ``__spark_entry__.oracle_sql`` to check the Spark queries; the
engine itself never runs SQL text from here.
"""

from __future__ import annotations


def R(x: str, d: int = 6) -> str:
    """Same normalisation as ``functions.exprs.round_half_up``."""
    return (
        f"(CASE WHEN ABS(({x}) * 1e{d}) < 9e18 THEN FLOOR(({x}) * 1e{d} + 0.5) / 1e{d} "
        f"ELSE CAST(({x}) AS DOUBLE) END)"
    )


PANEL = """
panel_lines AS (
  SELECT CAST(l.l_shipdate AS DATE) AS fecha, p.p_brand AS item_id, l.l_orderkey,
         SUM(CASE WHEN l.l_returnflag <> 'R' THEN l.l_quantity ELSE CAST(0 AS DOUBLE) END) AS _c,
         SUM(CASE WHEN l.l_returnflag = 'R' THEN l.l_quantity ELSE CAST(0 AS DOUBLE) END) AS _i,
         SUM(l.l_extendedprice) AS _p
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY 1, 2, 3
),
panel0 AS (
  SELECT fecha, item_id, CAST(COUNT(*) AS INTEGER) AS ocupacion_familias,
         ROUND(SUM(_p) / 100, 4) AS stock_inicio, SUM(_i) AS ingreso_stock, SUM(_c) AS consumo_real
  FROM panel_lines GROUP BY fecha, item_id
),
panel AS (
  SELECT *, ROUND(stock_inicio + ingreso_stock - consumo_real, 4) AS stock_fin FROM panel0
)"""

ITEMS = """
items0 AS (
  SELECT p_brand AS item_id, AVG(p_retailprice) AS _price, AVG(p_size) AS _size, MAX(p_size) AS _max_size
  FROM part GROUP BY p_brand
),
items AS (
  SELECT item_id,
         'producto_' || split_part(item_id, '#', 2) AS nombre_item,
         CASE CAST(split_part(item_id, '#', 2) AS INTEGER) % 4 WHEN 0 THEN 'alimentos' WHEN 1 THEN 'higiene'
              WHEN 2 THEN 'insumos_medicos' WHEN 3 THEN 'medicamentos_soporte' END AS categoria,
         CASE CAST(split_part(item_id, '#', 2) AS INTEGER) % 3 WHEN 0 THEN 'unidad' WHEN 1 THEN 'caja'
              WHEN 2 THEN 'kg' END AS unidad_medida,
         ROUND(_price / 1000, 6) AS consumo_base_por_familia,
         CAST(FLOOR(_size) AS INTEGER) AS stock_seguridad_7d,
         CAST(_max_size * 10 AS INTEGER) AS stock_maximo_referencial,
         CAST(_max_size >= 50 AS INTEGER) AS es_critico
  FROM items0
)"""

CONSUMO = (
    PANEL
    + ","
    + ITEMS
    + """,
consumo0 AS (
  SELECT p.*, i.nombre_item, i.categoria, i.unidad_medida,
         i.stock_seguridad_7d + 225.0 * i.consumo_base_por_familia AS _thr,
         AVG(p.consumo_real) OVER (PARTITION BY p.item_id ORDER BY p.fecha ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS _est,
         COUNT(*) OVER (PARTITION BY p.item_id ORDER BY p.fecha ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING) AS _n7,
         MIN(p.stock_fin) OVER (PARTITION BY p.item_id ORDER BY p.fecha ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING) AS _m7,
         COUNT(*) OVER (PARTITION BY p.item_id ORDER BY p.fecha ROWS BETWEEN 1 FOLLOWING AND 14 FOLLOWING) AS _n14,
         MIN(p.stock_fin) OVER (PARTITION BY p.item_id ORDER BY p.fecha ROWS BETWEEN 1 FOLLOWING AND 14 FOLLOWING) AS _m14
  FROM panel p LEFT JOIN items i ON p.item_id = i.item_id
),
consumo AS (
  SELECT fecha, item_id, nombre_item, categoria, unidad_medida, ocupacion_familias, stock_inicio,
         ingreso_stock, consumo_real, stock_fin,
         """
    + R("_est * 7", 2)
    + """ AS consumo_estimado_7d,
         """
    + R("_est * 14", 2)
    + """ AS consumo_estimado_14d,
         CASE WHEN _est > 0 THEN """
    + R("stock_fin / _est", 2)
    + """ ELSE 99.0 END AS dias_cobertura,
         CASE WHEN _n7 = 7 THEN CAST(_m7 < _thr AS INTEGER) END AS stock_critico_7d,
         CASE WHEN _n14 = 14 THEN CAST(_m14 < _thr AS INTEGER) END AS stock_critico_14d
  FROM consumo0
)"""
)


def history(cap: int = 60) -> str:
    """F3 over ``consumo`` (needs CONSUMO before it)."""
    return f"""
hist0 AS (
  SELECT c.*,
    CASE WHEN COUNT(consumo_real) OVER w7 >= 3 THEN AVG(consumo_real) OVER w7 END AS consumo_roll7,
    CASE WHEN COUNT(consumo_real) OVER w14 >= 5 THEN AVG(consumo_real) OVER w14 END AS consumo_roll14,
    CASE WHEN COUNT(consumo_real) OVER w7 >= 3 THEN STDDEV_SAMP(consumo_real) OVER w7 END AS consumo_std7,
    CASE WHEN COUNT(ingreso_stock) OVER w7 >= 3 THEN SUM(ingreso_stock) OVER w7 END AS ingreso_roll7,
    LAG(consumo_real, 1) OVER w AS consumo_lag_1,
    LAG(consumo_real, 2) OVER w AS consumo_lag_2,
    LAG(consumo_real, 3) OVER w AS consumo_lag_3,
    LAG(consumo_real, 7) OVER w AS consumo_lag_7,
    LAG(consumo_real, 14) OVER w AS consumo_lag_14,
    CAST(isodow(fecha) - 1 AS INTEGER) AS dia_semana,
    CAST(month(fecha) AS INTEGER) AS mes,
    MAX(CASE WHEN ingreso_stock > 0 THEN fecha END) OVER (PARTITION BY item_id ORDER BY fecha ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _last_in
  FROM consumo c
  WINDOW w AS (PARTITION BY item_id ORDER BY fecha),
         w7 AS (PARTITION BY item_id ORDER BY fecha ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
         w14 AS (PARTITION BY item_id ORDER BY fecha ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)
),
hist AS (
  SELECT h.*, CASE WHEN date_diff('day', _last_in, fecha) > {cap} THEN {cap}
                   ELSE CAST(date_diff('day', _last_in, fecha) AS INTEGER) END AS dias_sin_ingreso,
         i.consumo_base_por_familia, i.stock_seguridad_7d, i.es_critico
  FROM hist0 h LEFT JOIN items i ON h.item_id = i.item_id
)"""


PACIENTES = """
oa AS (
  SELECT o_custkey, COUNT(*) AS n_orders,
         SUM(CAST(o_orderstatus = 'O' AS INTEGER)) AS n_open,
         SUM(CAST(o_orderpriority = '1-URGENT' AS INTEGER)) AS n_urgent,
         MIN(o_orderdate) AS first_date
  FROM orders GROUP BY o_custkey
),
pac0 AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS paciente_id,
         CAST(oa.first_date AS DATE) AS fecha_registro,
         CAST(c.c_custkey % 18 AS INTEGER) AS edad,
         CASE WHEN c.c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sexo,
         g.n_name AS region_origen,
         c.c_mktsegment AS diagnostico_general,
         g.r_name AS estado_tratamiento,
         CAST(oa.n_orders AS INTEGER) AS dias_hospedaje,
         CAST(oa.n_open AS INTEGER) AS num_controles_mes,
         CAST(oa.n_urgent AS INTEGER) AS num_quimios_mes,
         CASE WHEN c.c_acctbal >= 0 THEN c.c_acctbal / 1000.0 + 5.0 END AS hemoglobina_g_dl,
         CAST((c.c_custkey * 37) % 1500 AS DOUBLE) AS neutrofilos,
         c.c_acctbal * 20 + 30000.0 AS plaquetas,
         36.5 + CAST(c.c_custkey % 30 AS DOUBLE) / 10.0 AS temperatura_c,
         CAST(10 + c.c_custkey % 50 AS DOUBLE) AS peso_kg,
         CASE WHEN c.c_custkey % 11 <> 0 THEN CAST(10 + c.c_custkey % 50 AS DOUBLE)
              / ((CAST(CAST(c.c_custkey % 18 AS INTEGER) * 5 + 60 AS DOUBLE) / 100.0)
                 * (CAST(CAST(c.c_custkey % 18 AS INTEGER) * 5 + 60 AS DOUBLE) / 100.0)) END AS imc,
         CAST(c.c_nationkey * 40 AS DOUBLE) AS distancia_origen_km,
         CASE WHEN c.c_acctbal >= 0 THEN c.c_acctbal / 10.0 END AS ingreso_familiar_mensual,
         CASE WHEN c.c_custkey % 3 = 0 THEN 0 ELSE 1 END AS acompanante_presente,
         CASE c.c_custkey % 4 WHEN 0 THEN 'Ninguno' WHEN 1 THEN 'SIS' WHEN 2 THEN 'EsSalud' ELSE 'Privado' END AS seguro_salud,
         CASE WHEN c.c_custkey % 5 = 0 THEN NULL WHEN c.c_custkey % 5 IN (1, 2) THEN 'Alta'
              WHEN c.c_custkey % 5 = 3 THEN 'Media' ELSE 'Baja' END AS alfabetizacion_digital,
         CASE WHEN oa.n_orders > 10 THEN 1 ELSE 0 END AS requiere_apoyo_psicosocial,
         c.c_acctbal AS _score
  FROM customer c
  LEFT JOIN (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) AS g
    ON c.c_nationkey = g.n_nationkey
  LEFT JOIN oa ON c.c_custkey = oa.o_custkey
),
bands AS (SELECT quantile_cont(_score, 0.45) AS q45, quantile_cont(_score, 0.8) AS q80 FROM pac0),
pacientes AS (
  SELECT pac0.* EXCLUDE (_score),
         CASE WHEN _score < q45 THEN 'Bajo' WHEN _score < q80 THEN 'Medio'
              WHEN _score IS NOT NULL THEN 'Alto' END AS nivel_prioridad_atencion
  FROM pac0, bands
)"""

DONACIONES = """
donaciones AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS donacion_id,
         CAST(o_orderdate AS DATE) AS fecha,
         o_orderstatus AS tipo_donante,
         'Brand#' || CAST(o_custkey % 25 + 1 AS VARCHAR) AS item_id,
         o_orderpriority AS categoria,
         CAST(o_custkey % 50 + 1 AS INTEGER) AS cantidad_donada,
         o_totalprice AS valor_estimado_soles,
         CASE month(o_orderdate) WHEN 5 THEN 'Aniversario' WHEN 8 THEN 'Día del Niño' WHEN 12 THEN 'Navidad'
              ELSE 'Regular' END AS campania
  FROM orders
)"""

CAPTURAS = """
capturas AS (
  SELECT CAST(event_id AS VARCHAR) AS captura_id,
         CAST(ts AS DATE) AS fecha_captura,
         ts,
         CAST(user_id AS VARCHAR) AS paciente_id,
         event_type AS tipo_documento,
         CASE WHEN CAST(regexp_extract(props, '"k":\\s*(\\d+)', 1) AS INTEGER) < 50 THEN 'Alta'
              WHEN CAST(regexp_extract(props, '"k":\\s*(\\d+)', 1) AS INTEGER) < 80 THEN 'Media'
              ELSE 'Baja' END AS calidad_imagen,
         value / (value + 20.0) AS confianza_ocr,
         CASE event_type WHEN 'view' THEN 'pagina|duracion|fecha' WHEN 'click' THEN 'elemento|posicion|fecha'
              WHEN 'purchase' THEN 'producto|monto|fecha|moneda' WHEN 'signup' THEN 'nombre|correo|fecha'
              WHEN 'error' THEN 'codigo|mensaje|fecha' END AS campos_extraidos,
         CAST(value / (value + 20.0) < 0.75 AS INTEGER) AS requiere_revision_manual,
         CASE user_id % 3 WHEN 0 THEN 'movil' WHEN 1 THEN 'escaner' ELSE 'web' END AS origen_captura
  FROM events
)"""

CLASS_PRED = """
class_pred AS (
  SELECT l.doc_id, CAST(l.quality + l.toxic AS INTEGER) AS y_true,
         CAST(CASE WHEN d.n_chars < 800 THEN 0 WHEN d.n_chars < 3000 THEN 1 ELSE 2 END AS INTEGER) AS y_pred
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id
)"""

REG_PRED = """
reg_pred AS (SELECT l_extendedprice AS y_true, l_quantity * 950.0 AS y_pred FROM lineitem)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)
