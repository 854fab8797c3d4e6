"""Role bindings: the domain tables built from the driver's TPC-H-like tables.

| role        | built from |
| ----------- | ---------- |
| panel       | lineitem x part, one row per (ship day, brand) |
| catalogue   | part grouped by brand |
| consumo     | panel + catalogue + trailing estimate + forward stock labels |
| donaciones  | orders |
| pacientes   | customer x nation x region + per-customer order aggregates |
| capturas    | events |
| predictions | labels x documents (classes), lineitem (regression) |

Every role is a lazy DataFrame over whole tables; the SQL twins live in
``plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import windows as W
from ..operators.joins import attach_row, many_to_one_join
from ..operators.quantiles import quantiles_wide
from ..sources.tables import read_table

# Fixed bucket names used by the bindings.
CATEGORIES = ["alimentos", "higiene", "insumos_medicos", "medicamentos_soporte"]
UNITS = ["unidad", "caja", "kg"]
INSURANCES = ["Ninguno", "SIS", "EsSalud", "Privado"]
DOC_FIELDS = {
    "view": "pagina|duracion|fecha",
    "click": "elemento|posicion|fecha",
    "purchase": "producto|monto|fecha|moneda",
    "signup": "nombre|correo|fecha",
    "error": "codigo|mensaje|fecha",
}


def _case_mod(c, values: list[str]):
    expr = None
    for i, v in enumerate(values):
        cond = (c % len(values)) == i
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    return expr


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily item panel: (fecha, item_id) unique.

    Two-level aggregation instead of ``count(distinct)``: lines are first
    reduced per (day, brand, order), then per (day, brand). That avoids the
    row duplication of Spark's distinct-aggregate rewrite and the second
    shuffle only carries partial aggregates.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"
    )
    pt = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    joined = li.join(pt, li.l_partkey == pt.p_partkey)
    per_order = joined.groupBy(
        F.to_date("l_shipdate").alias("fecha"), F.col("p_brand").alias("item_id"), "l_orderkey"
    ).agg(
        F.sum(F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).otherwise(F.lit(0.0))).alias("_c"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(F.lit(0.0))).alias("_i"),
        F.sum("l_extendedprice").alias("_p"),
    )
    out = per_order.groupBy("fecha", "item_id").agg(
        F.count(F.lit(1)).cast("int").alias("ocupacion_familias"),
        F.round(F.sum("_p") / 100, 4).alias("stock_inicio"),
        F.sum("_i").alias("ingreso_stock"),
        F.sum("_c").alias("consumo_real"),
    )
    return out.withColumn(
        "stock_fin", F.round(F.col("stock_inicio") + F.col("ingreso_stock") - F.col("consumo_real"), 4)
    )


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item master: one row per brand."""
    pt = read_table(spark, sf_dir, "part").select("p_brand", "p_size", "p_retailprice")
    agg = pt.groupBy(F.col("p_brand").alias("item_id")).agg(
        F.avg("p_retailprice").alias("_price"),
        F.avg("p_size").alias("_size"),
        F.max("p_size").alias("_max_size"),
    )
    num = F.substring_index(F.col("item_id"), "#", -1).cast("int")
    return agg.select(
        "item_id",
        F.concat(F.lit("producto_"), F.substring_index(F.col("item_id"), "#", -1)).alias("nombre_item"),
        _case_mod(num, CATEGORIES).alias("categoria"),
        _case_mod(num, UNITS).alias("unidad_medida"),
        F.round(F.col("_price") / 1000, 6).alias("consumo_base_por_familia"),
        F.floor("_size").cast("int").alias("stock_seguridad_7d"),
        (F.col("_max_size") * 10).cast("int").alias("stock_maximo_referencial"),
        (F.col("_max_size") >= 50).cast("int").alias("es_critico"),
    )


def consumo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full consumption table: panel + catalogue attributes + estimates + targets.

    Trailing estimate (W9, P27) and the forward labels (W10) share one window.
    """
    items = catalogue(spark, sf_dir)
    df = many_to_one_join(
        panel(spark, sf_dir),
        items.select("item_id", "nombre_item", "categoria", "unidad_medida", "consumo_base_por_familia", "stock_seguridad_7d"),
        "item_id",
        right_unique=True,  # catalogue() groups by item_id
    )
    w = W.series_window("item_id", "fecha")
    thr = F.col("stock_seguridad_7d") + F.lit(5.0 * 45.0) * F.col("consumo_base_por_familia")
    df = df.withColumn("_est", W.inclusive_mean("consumo_real", w, 7)).withColumn("_thr", thr)
    df = df.withColumns(X.estimated_cover("_est", "stock_fin")).withColumns(
        {
            "stock_critico_7d": W.forward_below("stock_fin", w, 7, "_thr"),
            "stock_critico_14d": W.forward_below("stock_fin", w, 14, "_thr"),
        }
    )
    return df.select(
        "fecha", "item_id", "nombre_item", "categoria", "unidad_medida", "ocupacion_familias",
        "stock_inicio", "ingreso_stock", "consumo_real", "stock_fin", "consumo_estimado_7d",
        "consumo_estimado_14d", "dias_cobertura", "stock_critico_7d", "stock_critico_14d",
    )


def donaciones(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    fecha = F.to_date("o_orderdate")
    return o.select(
        F.col("o_orderkey").cast("string").alias("donacion_id"),
        fecha.alias("fecha"),
        F.col("o_orderstatus").alias("tipo_donante"),
        F.concat(F.lit("Brand#"), ((F.col("o_custkey") % 25) + 1).cast("string")).alias("item_id"),
        F.col("o_orderpriority").alias("categoria"),
        ((F.col("o_custkey") % 50) + 1).cast("int").alias("cantidad_donada"),
        F.col("o_totalprice").alias("valor_estimado_soles"),
        X.campaign_name(F.month(fecha)).alias("campania"),
    )


def pacientes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    oa = o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum((F.col("o_orderstatus") == "O").cast("int")).alias("n_open"),
        F.sum((F.col("o_orderpriority") == "1-URGENT").cast("int")).alias("n_urgent"),
        F.min("o_orderdate").alias("first_date"),
    )
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    base = c.join(geo, c.c_nationkey == geo.n_nationkey, "left").join(oa, c.c_custkey == oa.o_custkey, "left")
    k = F.col("c_custkey")
    bal = F.col("c_acctbal")
    edad = (k % 18).cast("int")
    peso = (F.lit(10) + k % 50).cast("double")
    height = (edad * 5 + 60).cast("double") / F.lit(100.0)
    rows = base.select(
        k.cast("string").alias("paciente_id"),
        F.to_date("first_date").alias("fecha_registro"),
        edad.alias("edad"),
        F.when(k % 2 == 0, "F").otherwise("M").alias("sexo"),
        F.col("n_name").alias("region_origen"),
        F.col("c_mktsegment").alias("diagnostico_general"),
        F.col("r_name").alias("estado_tratamiento"),
        F.col("n_orders").cast("int").alias("dias_hospedaje"),
        F.col("n_open").cast("int").alias("num_controles_mes"),
        F.col("n_urgent").cast("int").alias("num_quimios_mes"),
        F.when(bal >= 0, bal / F.lit(1000.0) + F.lit(5.0)).alias("hemoglobina_g_dl"),
        ((k * 37) % 1500).cast("double").alias("neutrofilos"),
        (bal * 20 + F.lit(30000.0)).alias("plaquetas"),
        (F.lit(36.5) + (k % 30).cast("double") / F.lit(10.0)).alias("temperatura_c"),
        peso.alias("peso_kg"),
        F.when(k % 11 != 0, peso / (height * height)).alias("imc"),
        (F.col("c_nationkey") * 40).cast("double").alias("distancia_origen_km"),
        F.when(bal >= 0, bal / F.lit(10.0)).alias("ingreso_familiar_mensual"),
        F.when(k % 3 == 0, 0).otherwise(1).alias("acompanante_presente"),
        _case_mod(k, INSURANCES).alias("seguro_salud"),
        F.when(k % 5 == 0, None).when((k % 5).isin(1, 2), "Alta").when(k % 5 == 3, "Media").otherwise("Baja").alias(
            "alfabetizacion_digital"
        ),
        F.when(F.col("n_orders") > 10, 1).otherwise(0).alias("requiere_apoyo_psicosocial"),
        bal.alias("_score"),
    )
    # the left joins keep one row per customer, so the score's population is
    # the customer table itself: the quantiles read one column of it
    population = c.select(bal.alias("_score"))
    return band_priority(rows, "_score", population=population).drop("_score")


def band_priority(df: DataFrame, score: str, out: str = "nivel_prioridad_atencion",
                  population: DataFrame | None = None) -> DataFrame:
    """Score below its 45th percentile -> Bajo, below the 80th -> Medio, else Alto.

    ``population`` (default ``df``) is where the percentiles are taken.
    """
    src = df if population is None else population
    q = quantiles_wide(src, score, [0.45, 0.8], ["_q45", "_q80"])
    # q is exactly one row: a scalar subquery, not a join
    banded = attach_row(df, q).withColumn(out, X.band_by_quantiles(score, F.col("_q45"), F.col("_q80")))
    return banded.drop("_q45", "_q80")


def capturas(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    conf = F.col("value") / (F.col("value") + F.lit(20.0))
    k = F.regexp_extract("props", r'"k":\s*(\d+)', 1).cast("int")
    fields = None
    for t, f in DOC_FIELDS.items():
        fields = F.when(F.col("event_type") == t, f) if fields is None else fields.when(F.col("event_type") == t, f)
    return e.select(
        F.col("event_id").cast("string").alias("captura_id"),
        F.to_date("ts").alias("fecha_captura"),
        F.col("ts").alias("ts"),
        F.col("user_id").cast("string").alias("paciente_id"),
        F.col("event_type").alias("tipo_documento"),
        F.when(k < 50, "Alta").when(k < 80, "Media").otherwise("Baja").alias("calidad_imagen"),
        conf.alias("confianza_ocr"),
        fields.alias("campos_extraidos"),
        X.needs_review(conf).alias("requiere_revision_manual"),
        _case_mod(F.col("user_id"), ["movil", "escaner", "web"]).alias("origen_captura"),
    )


def class_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, y_true, y_pred) with three classes."""
    lb = read_table(spark, sf_dir, "labels")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    j = lb.join(docs, "doc_id")
    pred = F.when(F.col("n_chars") < 800, 0).when(F.col("n_chars") < 3000, 1).otherwise(2)
    return j.select("doc_id", (F.col("quality") + F.col("toxic")).cast("int").alias("y_true"), pred.cast("int").alias("y_pred"))


def regression_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_extendedprice", "l_quantity")
    return li.select(F.col("l_extendedprice").alias("y_true"), (F.col("l_quantity") * F.lit(950.0)).alias("y_pred"))
