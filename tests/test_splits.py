"""Splits and folds: fixtures, golden counts (FIXTURES.md §5, §6), brute force."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelforge.operators import features as FE
from panelforge.operators import splits as H


def test_temporal_split_fixture(spark):
    dates = ["2025-01-01"] * 4 + ["2025-01-02"] * 4 + ["2025-01-03", None]
    df = spark.createDataFrame([(dt.date.fromisoformat(d) if d else None,) for d in dates], "d date")
    cut = H.temporal_cutoff(df, "d").first()
    assert cut.cutoff == dt.date(2025, 1, 3)
    counts = H.check_split(H.temporal_split(df, "d"))
    assert counts == {"train": 8, "test": 2}


def test_temporal_split_empty_side(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, 1),)] * 5, "d date")
    with pytest.raises(ValueError):
        H.check_split(H.temporal_split(df, "d"))


def _golden_panel(spark, horizon_null: int):
    """30 items x 730 days, consumption never null, the last ``horizon`` rows of each item unlabeled."""
    base = spark.range(30 * 730).select(
        (F.col("id") / 730).cast("int").alias("i"), (F.col("id") % 730).cast("int").alias("t"))
    return base.select(
        F.concat(F.lit("IT"), F.col("i").cast("string")).alias("item_id"),
        F.date_add(F.lit(dt.date(2023, 1, 1)), F.col("t")).alias("fecha"),
        F.lit(10).alias("ocupacion_familias"), F.lit(100.0).alias("stock_inicio"), F.lit(0.0).alias("ingreso_stock"),
        (F.col("t") % 5 + 1).cast("double").alias("consumo_real"), F.lit(95.0).alias("stock_fin"),
        F.lit("alimentos").alias("categoria"), F.lit("kg").alias("unidad_medida"),
        F.when(F.col("t") < 730 - 7, F.col("t") % 2).alias("stock_critico_7d"),
        F.when(F.col("t") < 730 - 14, F.col("t") % 2).alias("stock_critico_14d"),
    )


def _items(spark):
    return spark.range(30).select(F.concat(F.lit("IT"), F.col("id").cast("string")).alias("item_id"),
                                  F.lit(0.5).alias("consumo_base_por_familia"), F.lit(20).alias("stock_seguridad_7d"),
                                  F.lit(1).alias("es_critico"))


@pytest.mark.parametrize("h,train,test", [(7, 17280, 4320), (14, 17100, 4290)])
def test_golden_stock_counts(spark, h, train, test):
    fs = FE.stock_features(_golden_panel(spark, h), _items(spark), h)
    counts = H.check_split(H.temporal_split(fs.df, "split_date"))
    assert (counts["train"], counts["test"]) == (train, test)


def test_golden_demand_counts(spark):
    fs = FE.demand_features(_golden_panel(spark, 7), _items(spark))
    counts = H.check_split(H.temporal_split(fs.df, "split_date"))
    assert (counts["train"], counts["test"]) == (17160, 4320)


def test_golden_donation_counts(spark):
    rows = []
    for m in range(48):
        for c in ("alimentos", "higiene", "insumos_medicos", "medicamentos_soporte"):
            y, mo = 2022 + (8 + m) // 12, (8 + m) % 12 + 1
            rows.append((dt.date(y, mo, 3), c, 100.0 + m, f"{m}{c}"))
    df = spark.createDataFrame(rows, "fecha date, categoria string, valor_estimado_soles double, donacion_id string")
    fs = FE.donation_features(df)
    counts = H.check_split(H.temporal_split(fs.df, "split_date"))
    assert (counts["train"], counts["test"]) == (144, 36)


def test_stratified_split_exact_quota_vs_brute_force(spark):
    n = 3000
    df = spark.range(n).select(F.col("id").alias("k"), F.when(F.col("id") % 10 < 2, "a").when(F.col("id") % 10 < 5, "b").otherwise("c").alias("y"))
    got = {(r.k, r.split) for r in H.stratified_split(df, "y", ["k"], method="lehmer").collect()}
    pdf = df.withColumn("h", H.hash_value(["k"], method="lehmer")).toPandas()
    want = set()
    for _, g in pdf.groupby("y"):
        q = int((len(g) * 0.2) + 0.5)
        g = g.assign(b=g.h % 10000).sort_values(["b", "h", "k"])
        want |= {(k, "test") for k in g.k[:q]} | {(k, "train") for k in g.k[q:]}
    assert got == want


def test_hash_split_is_stable_across_partitionings(spark):
    df = spark.range(5000).select(F.col("id").alias("k"))
    a = {r.k for r in H.hash_split(df.repartition(3), ["k"]).where("split='test'").collect()}
    b = {r.k for r in H.hash_split(df.repartition(11), ["k"]).where("split='test'").collect()}
    assert a == b and 800 < len(a) < 1200


def test_expanding_folds_vs_positions(spark):
    days = [dt.date(2025, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    df = spark.createDataFrame([(d,) for d in days for _ in range(3)], "d date")
    folds = {r.fold: (r.lo, r.hi) for r in H.expanding_folds(df, "d", 3).collect()}
    n, t = 120, 30
    srt = sorted(d for d in days for _ in range(3))
    for i in (1, 2, 3):
        start, end = n - (3 - i + 1) * t, n - (3 - i) * t
        assert folds[i][0] == srt[start]
        assert folds[i][1] == (srt[end] if end < n else None)
    roles = H.assign_expanding(df, "d", H.expanding_folds(df, "d", 3)).groupBy("fold", "role").count().collect()
    got = {(r.fold, r.role): r["count"] for r in roles}
    assert got[(1, "train")] == 30 and got[(1, "test")] == 30 and got[(3, "train")] == 90


def test_stratified_split_keeps_rows_without_a_class(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") % 10 != 0, F.col("id") % 3).alias("label"))
    got = {}
    for r in H.stratified_split(df, "label", ["k"]).groupBy("label", "split").count().collect():
        got.setdefault(r["label"], {})[r["split"]] = r["count"]
    assert {k: sum(v.values()) for k, v in got.items()} == {None: 100, 0: 300, 1: 300, 2: 300}
    assert {k: v["test"] for k, v in got.items()} == {None: 20, 0: 60, 1: 60, 2: 60}


def test_split_dates_must_be_days(spark):
    df = spark.range(3).select(F.timestamp_seconds("id").alias("t"))
    with pytest.raises(TypeError):
        H.temporal_cutoff(df, "t")


@pytest.mark.parametrize("n,k", [(0, 3), (2, 3), (7, 3), (300, 3), (301, 4)])
def test_contiguous_folds_against_sorting(spark, n, k):
    # a third of the rows shares one value, some have none
    rows = [(None if i % 11 == 0 else 5 if i % 3 == 0 else (i * 37) % 101, i) for i in range(n)]
    df = spark.createDataFrame(rows, "v int, i int")
    got = H.contiguous_folds(df, ["v", "i"], k)
    assert got.columns == ["v", "i", "fold"]
    in_order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    sizes = [n // k + (f < n % k) for f in range(k)]
    want = [f for f, size in enumerate(sizes) for _ in range(size)]
    assert {(r.v, r.i, r.fold) for r in got.collect()} == {(*r, f) for r, f in zip(in_order, want, strict=True)}


def test_contiguous_folds_ties_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a")] * 50 + [(1, f"b{i}") for i in range(50)], "v int, t string")
    got = [r.fold for r in H.contiguous_folds(df, ["v"], 3).collect()]
    assert [got.count(f) for f in range(3)] == [34, 33, 33]
