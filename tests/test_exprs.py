"""Scalar expressions against the hand fixtures (FIXTURES.md §3, §5)."""

import pytest

from panelforge.functions import exprs as X
from panelforge.operators.joins import keep_top_k


def test_risk_flags_fixture(spark):
    rows = [
        (500.0, "Ninguno", 0, 401.0, 199.0, 38.0),
        (600.0, "SIS", 1, 400.0, 500.0, 37.9),
        (None, None, 1, None, None, 39.0),
        (700.0, "Ninguno", 0, 10.0, 499.0, None),
    ]
    df = spark.createDataFrame(
        rows, "ingreso_familiar_mensual double, seguro_salud string, acompanante_presente int, distancia_origen_km double, "
        "neutrofilos double, temperatura_c double")
    flags = X.clinical_flags()
    out = df.select(X.vulnerability_score().alias("v"), flags["neutropenia"].alias("n"), flags["neutropenia_febril"].alias("fn")).collect()
    assert [r.v for r in out] == [4.0, 0.0, 0.0, 2.0]
    assert [r.n for r in out] == [1.0, 0.0, None, 1.0]
    assert [r.fn for r in out] == [1.0, 0.0, None, None]


def test_ordinal_encode_and_unknown(spark):
    df = spark.createDataFrame([("Bajo",), ("Medio",), ("Alto",)], "c string")
    assert [r[0] for r in df.select(X.ordinal_encode("c")).collect()] == [0, 1, 2]
    bad = spark.createDataFrame([("Otro",)], "c string")
    with pytest.raises(Exception):
        bad.select(X.ordinal_encode("c")).collect()


def test_grade_map(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (5,), (9,), (None,)], "g int")
    out = df.withColumn("p", X.triage_priority("g")).dropna(subset=["p"]).orderBy("g").collect()
    assert [r.p for r in out] == ["Alto", "Alto", "Medio", "Bajo", "Bajo"]


def test_censored_number(spark):
    df = spark.createDataFrame([("120 +",), (" 7 ",), ("abc",)], "s string")
    assert [r[0] for r in df.select(X.censored_number("s")).collect()] == [120.0, 7.0, None]


def test_top_k_other(spark):
    vals = ["a"] * 3 + ["b"] * 2 + ["c", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    out = keep_top_k(df, "v", 2, out="m").orderBy("i").collect()
    assert [r.m for r in out] == ["a", "a", "a", "b", "b", "otros", "otros"]


def test_clip_keeps_null_and_safe_ratio(spark):
    df = spark.createDataFrame([(10.0, 0.0), (None, 1.0), (500.0, 2.0)], "a double, b double")
    out = df.select(X.clip_upper(X.safe_ratio("a", "b"), 120.0).alias("r")).collect()
    assert [r.r for r in out] == [None, None, 120.0]


def test_campaign_and_weekday(spark):
    df = spark.sql("SELECT DATE'2025-01-06' AS d, 12 AS m UNION ALL SELECT DATE'2025-01-05', 3")
    out = df.select(X.weekday_monday0("d").alias("w"), X.campaign_name("m").alias("c"), X.campaign_month_flag("m").alias("f")).collect()
    assert [(r.w, r.c, r.f) for r in out] == [(0, "Navidad", 1.0), (6, "Regular", 0.0)]


def test_regression_headline_and_labels(spark):
    from panelforge.functions import labels as L

    df = spark.createDataFrame([("duracion_estadia", 12.4), ("demanda_consumo", 3.25), ("proyeccion_donaciones", 1500.5),
                                ("otro", 2.0)], "m string, v double")
    out = [r[0] for r in df.select(L.regression_headline("m", "v")).collect()]
    assert out[0] == "12 días de hospedaje" and out[1].startswith("3.") and out[1].endswith(" unidades")
    assert out[2] == "S/ 1500.50" and out[3] == "2.00"
    names = spark.createDataFrame([("stock_critico_7d", "x"), ("nuevo", "Modelo nuevo")], "name string, description string")
    got = [r[0] for r in names.select(L.model_label("name", "description")).collect()]
    assert got == ["Riesgo de quiebre de stock (7 días)", "Modelo nuevo"]
    cats = spark.createDataFrame([("higiene",), ("otra",)], "c string")
    assert [r[0] for r in cats.select(L.category_label("categoria", "c")).collect()] == ["Higiene", "otra"]


def test_many_to_one_join_rejects_duplicate_keys(spark):
    from panelforge.operators.joins import many_to_one_join

    left = spark.createDataFrame([("a", 1), ("b", 2)], "item_id string, v int")
    ok = spark.createDataFrame([("a", 10.0), ("b", 20.0)], "item_id string, w double")
    assert many_to_one_join(left, ok, "item_id").count() == 2
    dup = spark.createDataFrame([("a", 10.0), ("a", 11.0)], "item_id string, w double")
    with pytest.raises(Exception, match="duplicate key"):
        many_to_one_join(left, dup, "item_id").collect()


def test_rounding_of_large_values(spark):
    from panelforge.plans.oracle import R as twin
    from panelforge.plans.registry import R
    import duckdb

    values = [1.5e13, -1.5e13, 9.3e9 + 0.25, 1e300, 0.125, -2.5, 1e18, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for d in (2, 6, 9):
        got = [r[0] for r in df.select(R("x", d)).collect()]
        want = [duckdb.sql(f"SELECT {twin('x', d)} FROM (SELECT CAST({'NULL' if v is None else repr(v)} AS DOUBLE) AS x)").fetchall()[0][0] for v in values]
        assert got == want
        assert all(g == pytest.approx(v) for g, v in zip(got, values) if v is not None and abs(v) > 1)


def test_regression_cards(spark):
    from panelforge.functions.labels import regression_cards

    rows = [("duracion_estadia", 12.5), ("demanda_consumo", 3.25), ("proyeccion_donaciones", 1.5), ("otro", 2.0), ("demanda_consumo", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "model string, value double")
    got = [tuple(r)[2:] for r in regression_cards(df, "model", "value").collect()]
    assert got[0] == ("teal", "Estimado", "13 días de hospedaje", "Se estima que este paciente necesitará aproximadamente 13 días de hospedaje.")
    assert got[1][2] == "3.3 unidades" and got[2][1:3] == ("Proyección", "S/ 1.50")
    assert got[3] == ("teal", "Resultado", "2.00", "Resultado de la evaluación.") and got[4] == ("teal", "Estimado", None, None)
    assert got[5][:2] == ("teal", "Resultado")
