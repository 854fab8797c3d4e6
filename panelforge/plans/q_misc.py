"""Splits (H*), scalar / text operators (P*), sampling (T6), unions (S9/U2),
the captures join (J3), the daily capture aggregate (ST2, batch form) and
request validation (V*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import features as FE
from ..operators import joins as J
from ..operators import splits as H
from ..operators import validation as V
from ..sources.tables import read_table
from ..streaming.captures import daily_confidence
from . import oracle as O
from . import roles
from .q_panel import _stock_sql
from .registry import R, materialise, query

M, A = 2147483647, 48271


def lehmer_sql(col: str, seed: int = H.SEED) -> str:
    return f"(((({col} + {seed}) % {M}) * {A}) % {M})"


# H1 ------------------------------------------------------------------------------
@query(
    "h1_stratified_split",
    O.with_(O.PACIENTES) + f"""
, s AS (SELECT CAST(paciente_id AS BIGINT) AS k, nivel_prioridad_atencion AS label FROM pacientes WHERE nivel_prioridad_atencion IS NOT NULL),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY label ORDER BY {lehmer_sql('k')} % 10000, {lehmer_sql('k')}, k) AS rk,
             COUNT(*) OVER (PARTITION BY label) AS n FROM s)
SELECT label, CASE WHEN rk <= FLOOR(n * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split, COUNT(*) AS n_rows
FROM r GROUP BY ALL""",
    note="exact per-class quota by hash order; brute force = rank by hash per class",
)
def h1_stratified_split(spark, sf):
    p = roles.pacientes(spark, sf).where(F.col("nivel_prioridad_atencion").isNotNull()).select(
        F.col("paciente_id").cast("long").alias("k"), F.col("nivel_prioridad_atencion").alias("label")
    )
    s = H.stratified_split(materialise(p), "label", ["k"], method="lehmer")
    return s.groupBy("label", "split").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "h1_stratified_split_nulls",
    O.with_(O.PACIENTES) + f"""
, s AS (SELECT CAST(paciente_id AS BIGINT) AS k,
          CASE WHEN CAST(paciente_id AS BIGINT) % 7 = 0 THEN NULL ELSE nivel_prioridad_atencion END AS label FROM pacientes),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY label ORDER BY {lehmer_sql('k')} % 10000, {lehmer_sql('k')}, k) AS rk,
             COUNT(*) OVER (PARTITION BY label) AS n FROM s)
SELECT label, CASE WHEN rk <= FLOOR(n * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split, COUNT(*) AS n_rows, CAST(SUM(k) AS BIGINT) AS ids
FROM r GROUP BY ALL""",
    note="a seventh of the classes missing: those rows form a class of their own",
)
def h1_stratified_split_nulls(spark, sf):
    k = F.col("paciente_id").cast("long")
    p = roles.pacientes(spark, sf).select(
        k.alias("k"), F.when(k % 7 != 0, F.col("nivel_prioridad_atencion")).alias("label")
    )
    s = H.stratified_split(p, "label", ["k"], method="lehmer")
    return s.groupBy("label", "split").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("k").alias("ids"))


# H2 ------------------------------------------------------------------------------
@query(
    "h2_random_split",
    f"""SELECT CASE WHEN {lehmer_sql('o_orderkey')} % 10000 < 2000 THEN 'test' ELSE 'train' END AS split,
       COUNT(*) AS n_rows, {O.R('SUM(o_totalprice)', 2)} AS value
FROM orders GROUP BY ALL""",
)
def h2_random_split(spark, sf):
    o = read_table(spark, sf, "orders")
    s = H.hash_split(o, ["o_orderkey"], method="lehmer")
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), R(F.sum("o_totalprice"), 2).alias("value"))


# H3 ------------------------------------------------------------------------------
def _h3_sql() -> str:
    feats = _stock_sql(7)
    return f"""{feats.split("SELECT ocupacion_familias")[0]}
, f AS (SELECT fecha AS split_date FROM s),
d AS (SELECT split_date, COUNT(*) AS c FROM f GROUP BY split_date),
d2 AS (SELECT split_date, c, SUM(c) OVER (ORDER BY split_date ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
              SUM(c) OVER () AS n FROM d),
cut AS (SELECT split_date AS cutoff FROM d2 WHERE cum - c <= FLOOR(n * CAST(0.8 AS DOUBLE)) AND cum > FLOOR(n * CAST(0.8 AS DOUBLE)))
SELECT CASE WHEN COALESCE(f.split_date < cut.cutoff, FALSE) THEN 'train' ELSE 'test' END AS split, cut.cutoff AS cutoff,
       COUNT(*) AS n_rows
FROM f LEFT JOIN cut ON TRUE GROUP BY ALL"""


@query("h3_temporal_split", _h3_sql())
def h3_temporal_split(spark, sf):
    fs = FE.stock_features(roles.consumo(spark, sf), roles.catalogue(spark, sf), 7, items_unique=True)
    s = H.temporal_split(materialise(fs.df.select("split_date")), "split_date")
    return s.groupBy("split", "cutoff").agg(F.count(F.lit(1)).alias("n_rows"))


# H4 / H5 -------------------------------------------------------------------------
@query(
    "h4_hash_folds",
    f"""SELECT CAST({lehmer_sql('o_orderkey', H.SEED + 1)} % 3 AS INTEGER) AS fold, o_orderstatus, COUNT(*) AS n_rows
FROM orders GROUP BY ALL""",
    note="H4/H5: fold column for CrossValidator(foldCol=...)",
)
def h4_hash_folds(spark, sf):
    o = read_table(spark, sf, "orders")
    return H.hash_folds(o, ["o_orderkey"], method="lehmer").groupBy("fold", "o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "h5_contiguous_folds",
    """SELECT fold, o_orderstatus, COUNT(*) AS n_rows, CAST(SUM(o_orderkey) AS BIGINT) AS ids
FROM (SELECT o_orderkey, o_orderstatus, CAST(NTILE(3) OVER (ORDER BY o_orderdate NULLS FIRST, o_orderkey) - 1 AS INTEGER) AS fold FROM orders)
GROUP BY ALL""",
    note="neighbouring rows in date order; sizes differ by one row at most",
)
def h5_contiguous_folds(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderdate", "o_orderkey", "o_orderstatus")
    return H.contiguous_folds(o, ["o_orderdate", "o_orderkey"]).groupBy("fold", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("ids")
    )


# H6 ------------------------------------------------------------------------------
def _h6_sql() -> str:
    feats = _stock_sql(7)
    head = feats.split("SELECT ocupacion_familias")[0]
    return f"""{head}
, f AS (SELECT fecha AS d FROM s),
dd AS (SELECT d, COUNT(*) AS c FROM f GROUP BY d),
d2 AS (SELECT d, c, SUM(c) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum, SUM(c) OVER () AS n FROM dd),
fl AS (SELECT * FROM (VALUES (1), (2), (3)) v(fold)),
b AS (SELECT fl.fold, d2.*, n - (3 - fold + 1) * FLOOR(n / 4) AS st, n - (3 - fold) * FLOOR(n / 4) AS en FROM d2, fl),
lo AS (SELECT fold, d AS lo FROM b WHERE cum - c <= st AND cum > st),
hi AS (SELECT fold, d AS hi FROM b WHERE cum - c <= en AND cum > en),
fb AS (SELECT fl.fold, lo.lo, hi.hi FROM fl LEFT JOIN lo ON fl.fold = lo.fold LEFT JOIN hi ON fl.fold = hi.fold),
x AS (SELECT fb.fold, fb.lo, fb.hi,
        CASE WHEN f.d < fb.lo THEN 'train' WHEN f.d >= fb.lo AND (fb.hi IS NULL OR f.d < fb.hi) THEN 'test' END AS role
      FROM f, fb)
SELECT CAST(fold AS INTEGER) AS fold, lo, hi, role, COUNT(*) AS n_rows FROM x WHERE role IS NOT NULL GROUP BY ALL"""


@query("h6_expanding_folds", _h6_sql())
def h6_expanding_folds(spark, sf):
    fs = FE.stock_features(roles.consumo(spark, sf), roles.catalogue(spark, sf), 7, items_unique=True)
    d = materialise(fs.df.select(F.col("split_date").alias("d")))
    folds = H.expanding_folds(d, "d", 3)
    return H.assign_expanding(d, "d", folds, 3).groupBy("fold", "lo", "hi", "role").agg(F.count(F.lit(1)).alias("n_rows"))


# P6 / P16 / P18 / P19 / P21 --------------------------------------------------------
@query(
    "p6_ordinal_encode",
    O.with_(O.PACIENTES) + """
SELECT paciente_id, CAST(CASE nivel_prioridad_atencion WHEN 'Bajo' THEN 0 WHEN 'Medio' THEN 1 WHEN 'Alto' THEN 2 END AS INTEGER) AS label
FROM pacientes WHERE nivel_prioridad_atencion IS NOT NULL""",
)
def p6_ordinal_encode(spark, sf):
    p = roles.pacientes(spark, sf).dropna(subset=["nivel_prioridad_atencion"])
    return p.select("paciente_id", X.ordinal_encode("nivel_prioridad_atencion").alias("label"))


@query(
    "p16_campaign_months",
    O.with_(O.DONACIONES) + f"""
SELECT campania, CAST(month(fecha) IN (5, 8, 12) AS DOUBLE) AS mes_campania, COUNT(*) AS n, {O.R('SUM(valor_estimado_soles)', 2)} AS valor
FROM donaciones GROUP BY ALL""",
)
def p16_campaign_months(spark, sf):
    d = roles.donaciones(spark, sf)
    return d.groupBy("campania", X.campaign_month_flag(F.month("fecha")).alias("mes_campania")).agg(
        F.count(F.lit(1)).alias("n"), R(F.sum("valor_estimado_soles"), 2).alias("valor")
    )


@query(
    "p18_grade_map",
    """SELECT o_orderkey, CASE CAST(o_orderkey % 7 + 1 AS INTEGER) WHEN 1 THEN 'Alto' WHEN 2 THEN 'Alto' WHEN 3 THEN 'Medio'
       WHEN 4 THEN 'Bajo' WHEN 5 THEN 'Bajo' END AS prioridad
FROM orders WHERE CAST(o_orderkey % 7 + 1 AS INTEGER) BETWEEN 1 AND 5""",
    note="grade 1..7 derived from the key; 6 and 7 are unmapped and dropped",
)
def p18_grade_map(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", ((F.col("o_orderkey") % 7) + 1).cast("int").alias("grade"))
    return o.withColumn("prioridad", X.triage_priority("grade")).dropna(subset=["prioridad"]).select("o_orderkey", "prioridad")


@query(
    "p19_top_k_other",
    """WITH top AS (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey ORDER BY COUNT(*) DESC, o_custkey ASC LIMIT 40)
SELECT o.o_orderkey, CASE WHEN t.o_custkey IS NOT NULL THEN CAST(o.o_custkey AS VARCHAR) ELSE 'otros' END AS motivo
FROM orders o LEFT JOIN top t ON o.o_custkey = t.o_custkey""",
    note="P19 / J4 / T2: top-40 frequent values kept, rest 'otros'",
)
def p19_top_k_other(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    k = J.keep_top_k(o, "o_custkey", 40, out="_m")
    return k.select("o_orderkey", F.col("_m").alias("motivo"))


RAW_LOS_SQL = """CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)
  || CASE WHEN l_quantity >= 45 THEN ' +' ELSE '' END END"""


@query(
    "p21_censored_parse",
    f"""SELECT l_orderkey, l_linenumber, {RAW_LOS_SQL} AS raw,
       TRY_CAST(TRIM(REPLACE({RAW_LOS_SQL}, ' +', '')) AS DOUBLE) AS dias
FROM lineitem""",
    note="censored '45 +' text built from quantities; 'n/a' rows parse to NULL",
)
def p21_censored_parse(spark, sf):
    li = read_table(spark, sf, "lineitem")
    raw = F.when(F.col("l_linenumber") == 7, F.lit("n/a")).otherwise(
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.when(F.col("l_quantity") >= 45, F.lit(" +")).otherwise(F.lit("")))
    )
    return li.select("l_orderkey", "l_linenumber", raw.alias("raw")).withColumn("dias", X.censored_number("raw"))


# P28 / P29 -----------------------------------------------------------------------
@query(
    "p28_field_counts",
    O.with_(O.CAPTURAS) + """
SELECT field, COUNT(*) AS n FROM (SELECT unnest(string_split(campos_extraidos, '|')) AS field FROM capturas) t GROUP BY field""",
)
def p28_field_counts(spark, sf):
    c = roles.capturas(spark, sf)
    return c.select(F.explode(X.split_fields("campos_extraidos")).alias("field")).groupBy("field").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p29_review_share",
    O.with_(O.CAPTURAS) + f"""
SELECT tipo_documento, COUNT(*) AS n, CAST(SUM(requiere_revision_manual) AS BIGINT) AS n_revision,
       {O.R('AVG(requiere_revision_manual)')} AS share
FROM capturas GROUP BY tipo_documento""",
)
def p29_review_share(spark, sf):
    c = roles.capturas(spark, sf)
    return c.groupBy("tipo_documento").agg(
        F.count(F.lit(1)).alias("n"), F.sum("requiere_revision_manual").cast("long").alias("n_revision"),
        R(F.avg("requiere_revision_manual")).alias("share"),
    )


# J3 ------------------------------------------------------------------------------
@query(
    "j3_captures_patients",
    O.with_(O.CAPTURAS, O.PACIENTES) + f"""
SELECT p.nivel_prioridad_atencion, c.calidad_imagen, COUNT(*) AS n, {O.R('AVG(c.confianza_ocr)')} AS confianza_promedio,
       {O.R('AVG(c.requiere_revision_manual)')} AS tasa_revision
FROM capturas c LEFT JOIN pacientes p ON c.paciente_id = p.paciente_id GROUP BY ALL""",
)
def j3_captures_patients(spark, sf):
    """Captures are pre-aggregated per (patient, image quality) before the
    join, so a patient with a huge share of captures is combined map-side
    and the join sees one row per pair."""
    c = roles.capturas(spark, sf)
    pre = c.groupBy("paciente_id", "calidad_imagen").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("confianza_ocr").alias("_conf"),
        F.sum("requiere_revision_manual").cast("long").alias("_rev"), F.count("confianza_ocr").alias("_nconf"),
        F.count("requiere_revision_manual").alias("_nrev"))
    p = roles.pacientes(spark, sf).select("paciente_id", "nivel_prioridad_atencion")
    j = pre.join(J.unique_on(p, "paciente_id"), "paciente_id", "left")
    return j.groupBy("nivel_prioridad_atencion", "calidad_imagen").agg(
        F.sum("_n").alias("n"), R(F.sum("_conf") / F.sum("_nconf")).alias("confianza_promedio"),
        R(F.sum("_rev") / F.sum("_nrev")).alias("tasa_revision"),
    )


# T6 ------------------------------------------------------------------------------
@query(
    "t6_exact_sample",
    f"""SELECT l_orderkey, l_linenumber FROM lineitem
ORDER BY {lehmer_sql('(l_orderkey * 8 + l_linenumber)')}, l_orderkey, l_linenumber LIMIT 1000""",
    note="sampling operator: the limit is the feature",
)
def t6_exact_sample(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    k = li.withColumn("_k", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    return FE.exact_sample(k, 1000, H.SEED, key="_k", method="lehmer").drop("_k")


# S9 / U2 ---------------------------------------------------------------------------
@query(
    "s9_yearly_union",
    """SELECT * FROM (
  SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS anio_alta, NULL::VARCHAR AS o_orderpriority
  FROM orders WHERE year(o_orderdate) < 1998 AND (o_orderpriority LIKE '1-%' OR o_orderstatus = 'P')
  UNION ALL
  SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER), o_orderpriority
  FROM orders WHERE year(o_orderdate) >= 1998 AND (o_orderpriority LIKE '1-%' OR o_orderstatus = 'P'))""",
    note="yearly extracts with different column sets, filtered and tagged, union by name",
)
def s9_yearly_union(spark, sf):
    from ..sources.files import filter_tag_extract, union_extracts

    o = read_table(spark, sf, "orders")
    pred = F.col("o_orderpriority").startswith("1-") | (F.col("o_orderstatus") == "P")
    year = F.year("o_orderdate")
    early = o.where(year < 1998).select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus", "o_orderpriority")
    late = o.where(year >= 1998).select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus", "o_orderpriority")
    tagged = [
        filter_tag_extract(e, pred, F.year("o_orderdate").cast("int")).select(*cols)
        for e, cols in ((early, ["o_orderkey", "o_totalprice", "anio_alta"]),
                        (late, ["o_orderkey", "o_totalprice", "anio_alta", "o_orderpriority"]))
    ]
    return union_extracts(tagged)


# ST2 (batch form) ------------------------------------------------------------------
@query(
    "st2_daily_confidence",
    O.with_(O.CAPTURAS) + f"""
SELECT CAST(date_trunc('day', ts) AS DATE) AS dia, tipo_documento, COUNT(*) AS n,
       {O.R('AVG(confianza_ocr)')} AS confianza_promedio, CAST(SUM(requiere_revision_manual) AS BIGINT) AS n_revision
FROM capturas GROUP BY ALL""",
    note="the same function runs on the streaming DataFrame with a watermark",
)
def st2_daily_confidence(spark, sf):
    out = daily_confidence(roles.capturas(spark, sf), watermark=None)
    return out.select("dia", "tipo_documento", "n",
                      R("confianza_promedio").alias("confianza_promedio"), "n_revision")


# P30 / P31 ---------------------------------------------------------------------------
@query(
    "p30_result_cards",
    O.with_(O.PACIENTES) + """
, cards AS (SELECT * FROM (VALUES
  ('Bajo', 'green', 'Prioridad', 'Prioridad BAJA'),
  ('Medio', 'amber', 'Prioridad', 'Prioridad MEDIA'),
  ('Alto', 'red', 'Prioridad', 'Prioridad ALTA — este paciente necesita atención inmediata')) v(label, color, eyebrow, headline))
SELECT p.paciente_id, COALESCE(c.color, 'teal') AS color, COALESCE(c.eyebrow, 'Resultado') AS eyebrow,
       COALESCE(c.headline, p.nivel_prioridad_atencion) AS headline,
       CAST(FLOOR((CAST((CAST(p.paciente_id AS BIGINT) * 37) % 1500 AS DOUBLE) / 1500.0) * 100 + 0.5) AS BIGINT) AS confianza
FROM pacientes p LEFT JOIN cards c ON p.nivel_prioridad_atencion = c.label""",
    note="prediction = banded priority, probability from the neutrophil proxy; broadcast lookup of the fixed card table",
)
def p30_result_cards(spark, sf):
    from ..functions.labels import result_cards

    p = roles.pacientes(spark, sf)
    scored = p.select("paciente_id", F.lit("prioridad_atencion").alias("model"), F.col("nivel_prioridad_atencion").alias("prediccion"),
                      (F.col("neutrofilos") / F.lit(1500.0)).alias("prob"))
    return result_cards(scored, "model", "prediccion", "prob").select("paciente_id", "color", "eyebrow", "headline", "confianza")


@query(
    "p30_regression_cards",
    """
WITH v AS (SELECT c_custkey, c_custkey % 4 AS m, CAST(abs(c_acctbal) AS DECIMAL(18, 2)) AS x FROM customer),
t AS (SELECT c_custkey, m, CASE m WHEN 0 THEN CAST(CAST(round(x, 0) AS DECIMAL(18, 0)) AS VARCHAR)
        WHEN 1 THEN CAST(CAST(round(x, 1) AS DECIMAL(18, 1)) AS VARCHAR) ELSE CAST(x AS VARCHAR) END AS n FROM v)
SELECT c_custkey, 'teal' AS color, CASE m WHEN 2 THEN 'Proyección' WHEN 3 THEN 'Resultado' ELSE 'Estimado' END AS eyebrow,
       CASE m WHEN 0 THEN n || ' días de hospedaje' WHEN 1 THEN n || ' unidades' WHEN 2 THEN 'S/ ' || n END AS headline,
       CASE m WHEN 0 THEN 'Se estima que este paciente necesitará aproximadamente ' || n || ' días de hospedaje.'
              WHEN 1 THEN 'Se estima un consumo de aproximadamente ' || n || ' unidades para este ítem.'
              WHEN 2 THEN 'Se proyecta un valor de donaciones de aproximadamente S/ ' || n || ' para esta categoría el próximo mes.'
              ELSE 'Resultado de la evaluación.' END AS message
FROM t""",
    note="account balances shown as values of the three regression models, and of one without a card",
)
def p30_regression_cards(spark, sf):
    from ..functions.labels import REGRESSION_CARDS, regression_cards

    names = F.array(*[F.lit(n) for n in REGRESSION_CARDS], F.lit("otro"))
    c = read_table(spark, sf, "customer").select(
        "c_custkey", F.get(names, (F.col("c_custkey") % 4).cast("int")).alias("model"), F.abs("c_acctbal").alias("value")
    )
    out = regression_cards(c, "model", "value")
    headline = F.when(F.col("model") != "otro", F.col("headline")).alias("headline")
    return out.select("c_custkey", "color", "eyebrow", headline, "message")


@query(
    "p31_display_labels",
    O.with_(O.ITEMS) + """
SELECT item_id, CASE categoria WHEN 'alimentos' THEN 'Alimentos' WHEN 'higiene' THEN 'Higiene'
  WHEN 'insumos_medicos' THEN 'Insumos médicos' WHEN 'medicamentos_soporte' THEN 'Medicamentos de soporte' ELSE categoria END AS categoria_label
FROM items""",
)
def p31_display_labels(spark, sf):
    from ..functions.labels import category_label

    return roles.catalogue(spark, sf).select("item_id", category_label("categoria", "categoria").alias("categoria_label"))


# V1-V7 -----------------------------------------------------------------------------
REQUEST_NUM = ["edad", "neutrofilos", "temperatura_c"]
REQUEST_CAT = ["sexo", "seguro_salud"]


def request_bodies(spark, sf, quoted: bool = False):
    """JSON request bodies built from the patient table, with faults injected
    by key; ``quoted``: some numbers come as text."""
    p = roles.pacientes(spark, sf)
    k = F.col("paciente_id").cast("long")
    obj = F.to_json(F.struct(
        F.col("edad"), F.col("neutrofilos"), F.col("temperatura_c"),
        F.when(k % 13 != 0, F.col("sexo")).alias("sexo"), F.col("seguro_salud"),
    ))
    obj = F.when(k % 17 == 0, F.regexp_replace(obj, r'"edad":\d+', '"edad":"diez"')).otherwise(obj)
    obj = F.when(k % 19 == 0, F.regexp_replace(obj, r'"edad":\d+', '"edad":true')).otherwise(obj)
    if quoted:
        obj = F.when(k % 11 == 0, F.regexp_replace(obj, r'"edad":(\d+)', '"edad":"$1"')).otherwise(obj)
    body = (F.when(k % 29 == 0, F.lit("[]"))
            .when(k % 23 == 0, F.concat(F.lit("["), obj, F.lit(","), obj, F.lit("]")))
            .when(k % 31 == 0, F.lit("42"))
            .otherwise(obj))
    return p.select(F.col("paciente_id").alias("request_id"), body.alias("body"))


#: The twin works out from the patient's fields what a check must say; it parses no JSON.
REQUESTS_SQL = """
, r AS (SELECT paciente_id AS request_id, CAST(paciente_id AS BIGINT) AS k, edad, neutrofilos, temperatura_c,
               CASE WHEN CAST(paciente_id AS BIGINT) % 13 <> 0 THEN sexo END AS sexo, seguro_salud FROM pacientes),
i AS (
  SELECT *, CASE WHEN k % 29 = 0 THEN 'empty list' WHEN k % 23 <> 0 AND k % 31 = 0 THEN 'body must be an object or a list of objects' END AS body_error,
         unnest(CASE WHEN k % 29 = 0 OR (k % 23 <> 0 AND k % 31 = 0) THEN [NULL] WHEN k % 23 = 0 THEN [0, 1] ELSE [0] END) AS item_index
  FROM r),
c AS (
  SELECT *, COALESCE(body_error, concat_ws('; ',
      CASE WHEN edad IS NULL THEN 'missing feature: edad' END,
      CASE WHEN edad IS NOT NULL AND k % 17 = 0 THEN '''edad'' must be numeric' END,
      CASE WHEN neutrofilos IS NULL THEN 'missing feature: neutrofilos' END,
      CASE WHEN temperatura_c IS NULL THEN 'missing feature: temperatura_c' END,
      CASE WHEN sexo IS NULL THEN 'missing feature: sexo' END,
      CASE WHEN seguro_salud IS NULL THEN 'missing feature: seguro_salud' END)) AS errors
  FROM i)
SELECT request_id, CAST(item_index AS INTEGER) AS item_index, CASE WHEN errors = '' THEN 200 ELSE 422 END AS status, errors,
       CASE WHEN errors = '' THEN CAST(CAST(CASE WHEN k % 19 = 0 THEN 1 ELSE edad END AS FLOAT) AS DOUBLE) END AS edad,
       CASE WHEN errors = '' THEN CAST(CAST(neutrofilos AS FLOAT) AS DOUBLE) END AS neutrofilos,
       CASE WHEN errors = '' THEN CAST(CAST(temperatura_c AS FLOAT) AS DOUBLE) END AS temperatura_c,
       CASE WHEN errors = '' THEN sexo END AS sexo, CASE WHEN errors = '' THEN seguro_salud END AS seguro_salud
FROM c"""


def _checked(items):
    return items.select("request_id", "item_index", "status", F.array_join("errors", "; ").alias("errors"), *REQUEST_NUM, *REQUEST_CAT)


@query("v1_request_validation", O.with_(O.PACIENTES) + REQUESTS_SQL, note="also against a Python brute force in tests/test_validation.py")
def v1_request_validation(spark, sf):
    return _checked(V.validate_items(V.explode_bodies(request_bodies(spark, sf)), REQUEST_NUM, REQUEST_CAT))


@query("v4_lenient_validation", O.with_(O.PACIENTES) + REQUESTS_SQL, note="numbers that come as text are accepted; words are not")
def v4_lenient_validation(spark, sf):
    items = V.explode_bodies(request_bodies(spark, sf, quoted=True))
    return _checked(V.validate_items(items, REQUEST_NUM, REQUEST_CAT, strict=False))


# V6 ----------------------------------------------------------------------------------
def _float(c: str) -> str:
    return f"CAST(CAST({c} AS FLOAT) AS DOUBLE)"


def _v6_sql() -> str:
    from .q_reports import _clinical_select

    asked = ["edad", *X.CLINICAL_RAW_NUMERIC, "sexo", *X.CLINICAL_RAW_TEXT]
    errors = ", ".join(f"CASE WHEN {c} IS NULL THEN 'missing feature: {c}' END" for c in asked)
    raw = ", ".join(f"{_float(c)} AS {c}" for c in X.CLINICAL_RAW_NUMERIC)
    out = ", ".join(f"CASE WHEN errors = '' THEN {c} END AS {c}" for c in FE.CLINICAL_ENGINEERED)
    return O.with_(O.PACIENTES) + f"""
, c AS (SELECT paciente_id AS request_id, concat_ws('; ', {errors}) AS errors, seguro_salud, {raw} FROM pacientes),
d AS (SELECT request_id, errors, {_clinical_select()} FROM c)
SELECT request_id, CASE WHEN errors = '' THEN 200 ELSE 422 END AS status, errors, {out} FROM d"""


@query("v6_derived_request_features", _v6_sql(), note="requests hold raw fields; engineered ones are derived, not asked for")
def v6_derived_request_features(spark, sf):
    p = roles.pacientes(spark, sf)
    raw = ["edad", *X.CLINICAL_RAW_NUMERIC, "sexo", *X.CLINICAL_RAW_TEXT]
    bodies = p.select(F.col("paciente_id").alias("request_id"), F.to_json(F.struct(*raw)).alias("body"))
    items = V.validate_for_model(V.explode_bodies(bodies), ["edad", *FE.CLINICAL_ENGINEERED], ["sexo"])
    return items.select("request_id", "status", F.array_join("errors", "; ").alias("errors"), *FE.CLINICAL_ENGINEERED)


# V8 ----------------------------------------------------------------------------------
@query(
    "v8_unknown_models",
    O.with_(O.PACIENTES) + """
SELECT paciente_id AS request_id, 404 AS status, 'unknown model ''modelo_' || CAST(CAST(paciente_id AS BIGINT) % 7 AS VARCHAR) || '''' AS errors
FROM pacientes WHERE CAST(paciente_id AS BIGINT) % 7 >= 4""",
    note="four of seven requested models are registered",
)
def v8_unknown_models(spark, sf):
    k = F.col("paciente_id").cast("long") % 7
    requests = roles.pacientes(spark, sf).select(F.col("paciente_id").alias("request_id"), F.concat(F.lit("modelo_"), k.cast("string")).alias("model"))
    registry = spark.range(4).select(F.concat(F.lit("modelo_"), F.col("id").cast("string")).alias("name"))
    bad = V.reject_unknown_model(requests, registry)
    return bad.select("request_id", "status", F.array_join("errors", "; ").alias("errors"))


# F7 / F8 -----------------------------------------------------------------------------
# Triage and discharge rows over the orders table; the same text binds both engines.
_K = "o_orderkey"
TRIAGE_ROLE = {
    "age": f"CAST({_K} % 95 AS DOUBLE)", "gender": f"CASE WHEN {_K} % 2 = 0 THEN 'F' ELSE 'M' END",
    "ChiefComplaint": f"CASE WHEN {_K} % 43 <> 0 THEN 'motivo ' || CAST(o_custkey % 60 AS VARCHAR(9)) END",
    "PainGrade": f"CAST({_K} % 11 AS DOUBLE)", "admission_month": f"CAST({_K} % 12 + 1 AS DOUBLE)",
    "admission_weekday": f"CAST({_K} % 7 AS DOUBLE)", "admission_hour": f"CAST({_K} % 24 AS DOUBLE)",
    "CriticalStatus": f"CAST({_K} % 2 AS DOUBLE)", "StuporStatus": f"CAST({_K} % 3 AS DOUBLE)",
    "MentalDistress": f"CAST({_K} % 4 AS DOUBLE)", "MaterialDistress": f"CAST({_K} % 5 AS DOUBLE)",
    "AVPU": f"CASE WHEN {_K} % 13 <> 0 THEN 'A' END", "BlooddpressurSystol": f"CASE WHEN {_K} % 9 <> 0 THEN CAST(90 + {_K} % 80 AS DOUBLE) END",
    "BlooddpressurDiastol": f"CAST(50 + {_K} % 50 AS DOUBLE)", "PulseRate": f"CAST(60 + {_K} % 60 AS DOUBLE)",
    "RespiratoryRate": f"CAST(12 + {_K} % 20 AS DOUBLE)", "O2Saturation": f"CAST(85 + {_K} % 15 AS DOUBLE)",
    "TriageGrade": f"CASE WHEN {_K} % 17 = 0 THEN NULL WHEN {_K} % 19 = 0 THEN 'x' ELSE CAST({_K} % 6 + 1 AS VARCHAR(9)) || '.0' END",
}
DISCHARGE_ROLE = {
    "length_of_stay": f"CASE WHEN {_K} % 50 = 0 THEN '120 +' WHEN {_K} % 51 = 0 THEN 'abc' WHEN {_K} % 53 = 0 THEN NULL "
                      f"ELSE ' ' || CAST({_K} % 30 AS VARCHAR(9)) || ' ' END",
    "anio_alta": "CAST(year(o_orderdate) AS DOUBLE)",
    **{c: f"CASE WHEN {_K} % {11 + i} <> 0 THEN '{c}_' || CAST({_K} % {3 + i} AS VARCHAR(9)) END" for i, c in enumerate(FE.SPARCS_CAT)},
}


def _f7_sql() -> str:
    raw = ", ".join(f"{e} AS {c}" for c, e in TRIAGE_ROLE.items())
    back = {v: k for k, v in FE.TRIAGE_RENAMES.items()}
    num = ", ".join(f"{back[c]} AS {c}" for c in FE.TRIAGE_NUM)
    return f"""WITH t AS (SELECT o_orderkey, {raw} FROM orders),
g AS (SELECT *, CASE TRY_CAST(TriageGrade AS DOUBLE) WHEN 1 THEN 2 WHEN 2 THEN 2 WHEN 3 THEN 1 WHEN 4 THEN 0 WHEN 5 THEN 0 END AS label FROM t),
k AS (SELECT * FROM g WHERE label IS NOT NULL),
top AS (SELECT ChiefComplaint AS m FROM k WHERE ChiefComplaint IS NOT NULL GROUP BY m ORDER BY COUNT(*) DESC, m LIMIT 40)
SELECT {num}, COALESCE(gender, 'desconocido') AS sexo, COALESCE(top.m, 'otros') AS motivo_consulta, COALESCE(AVPU, 'desconocido') AS avpu, label
FROM k LEFT JOIN top ON k.ChiefComplaint = top.m"""


@query("f7_triage_features", _f7_sql(), note="grades as text with decimals, complaints beyond the top 40 pooled")
def f7_triage_features(spark, sf):
    o = read_table(spark, sf, "orders")
    return FE.triage_features(o.select(*[F.expr(e).alias(c) for c, e in TRIAGE_ROLE.items()])).df


def _f8_sql() -> str:
    raw = ", ".join(f"{e} AS {c}" for c, e in DISCHARGE_ROLE.items())
    cat = ", ".join(f"COALESCE({c}, 'desconocido') AS {c}" for c in FE.SPARCS_CAT)
    return f"""WITH d AS (SELECT {raw} FROM orders)
SELECT anio_alta, {cat}, TRY_CAST(TRIM(REPLACE(length_of_stay, ' +', '')) AS DOUBLE) AS label
FROM d WHERE TRY_CAST(TRIM(REPLACE(length_of_stay, ' +', '')) AS DOUBLE) IS NOT NULL"""


@query("f8_discharge_features", _f8_sql(), note="censored stays ('120 +') as numbers, others dropped")
def f8_discharge_features(spark, sf):
    o = read_table(spark, sf, "orders")
    return FE.sparcs_features(o.select(*[F.expr(e).alias(c) for c, e in DISCHARGE_ROLE.items()])).df


# S17 -------------------------------------------------------------------------------
@query(
    "s17_contract_violations",
    O.with_(O.CAPTURAS) + """
, c AS (SELECT captura_id, ts AS fecha_captura, paciente_id, tipo_documento, calidad_imagen, confianza_ocr,
               campos_extraidos, CAST(requiere_revision_manual AS VARCHAR) AS requiere_revision_manual, origen_captura
        FROM capturas)
SELECT 'captura_id' AS columna, CAST(SUM(CAST(captura_id IS NULL AS INTEGER)) AS BIGINT) AS violaciones FROM c
UNION ALL SELECT 'fecha_captura', CAST(SUM(CAST(fecha_captura IS NULL AS INTEGER)) AS BIGINT) FROM c
UNION ALL SELECT 'paciente_id', CAST(SUM(CAST(paciente_id IS NULL AS INTEGER)) AS BIGINT) FROM c
UNION ALL SELECT 'tipo_documento', CAST(SUM(CAST(tipo_documento IS NULL AS INTEGER)) AS BIGINT) FROM c
UNION ALL SELECT 'calidad_imagen', CAST(COUNT(*) * 0 AS BIGINT) FROM c
UNION ALL SELECT 'confianza_ocr', CAST(SUM(CAST(confianza_ocr IS NULL AS INTEGER)) AS BIGINT) FROM c
UNION ALL SELECT 'campos_extraidos', CAST(COUNT(*) * 0 AS BIGINT) FROM c
UNION ALL SELECT 'requiere_revision_manual',
  CAST(SUM(CAST(requiere_revision_manual IS NULL OR requiere_revision_manual NOT IN ('0', '1') AS INTEGER)) AS BIGINT) FROM c
UNION ALL SELECT 'origen_captura', CAST(COUNT(*) * 0 AS BIGINT) FROM c""",
    note="the captures table checked against the typed contract of the other system",
)
def s17_contract_violations(spark, sf):
    from ..schema import CAPTURES_CONTRACT
    from ..sources.files import contract_violations

    c = roles.capturas(spark, sf).withColumn("fecha_captura", F.col("ts")).withColumn(
        "requiere_revision_manual", F.col("requiere_revision_manual").cast("string"))
    return contract_violations(c, CAPTURES_CONTRACT)

