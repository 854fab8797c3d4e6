"""Reports and exact quantiles (FIXTURES.md §4, §5) plus brute-force checks."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelforge.operators import features as FE
from panelforge.operators import profile as P
from panelforge.operators.quantiles import quantiles_columns, quantiles_long, quantiles_wide


def test_iqr_fixture(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (100.0,), (None,)], "x double")
    r = P.iqr_outliers(df, ["x"]).first()
    assert (r.q1, r.q3, r.limite_inferior, r.limite_superior, r.cantidad_outliers) == (2.0, 4.0, -1.0, 7.0, 1)


def test_correlation_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 5.0)], "x double, y double")
    out = {(r.var_a, r.var_b): r.corr for r in P.correlation_long(df, ["x", "y"]).collect()}
    assert out[("x", "y")] is None and out[("x", "x")] is None
    assert out[("y", "y")] == pytest.approx(1.0)


def test_correlation_pairwise_complete(spark):
    rows = [(1.0, 2.0, None), (2.0, 4.1, 1.0), (3.0, 6.3, 0.0), (4.0, 7.9, 3.0), (None, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r.var_a, r.var_b): r.corr for r in P.correlation_long(df, ["a", "b", "c"]).collect()}
    want = pd.DataFrame(rows, columns=["a", "b", "c"]).corr()
    for (a, b), v in got.items():
        assert v == pytest.approx(want.loc[a, b])


def test_monthly_fixture(spark):
    rows = [("2025-01-05", "a", 10.0, "1"), ("2025-01-09", "a", 5.0, "2"), ("2025-02-01", "a", 7.0, "3"),
            ("2025-04-01", "a", 3.0, "4"), ("2025-05-02", "a", None, "5"), ("2025-05-03", "a", None, None)]
    df = spark.createDataFrame([(dt.date.fromisoformat(d), c, v, i) for d, c, v, i in rows],
                               "fecha date, categoria string, valor_estimado_soles double, donacion_id string")
    m = FE.monthly_series(df).orderBy("mes_periodo").collect()
    assert [(r.valor_total_soles, r.num_donaciones) for r in m] == [(15.0, 2), (7.0, 1), (3.0, 1), (0.0, 1)]
    from panelforge.operators import windows as W

    mm = FE.monthly_series(df)
    w = W.series_window("categoria", "mes_periodo")
    first = mm.agg(F.min("mes_periodo").alias("f"))
    out = P._const_join(mm, first).select(
        "mes_periodo", F.lag("valor_total_soles", 1).over(w).alias("lag1"),
        W.rolling(F.avg, "valor_total_soles", w, -3, -1, 3).alias("roll3"),
        F.months_between("mes_periodo", "f").cast("int").alias("trend"),
    ).orderBy("mes_periodo").collect()
    assert [r.lag1 for r in out] == [None, 15.0, 7.0, 3.0]
    assert out[3].roll3 == pytest.approx(8.3333, abs=1e-4) and out[2].roll3 is None
    assert [r.trend for r in out] == [0, 1, 3, 4]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=60),
       st.sampled_from([0.0, 0.1, 0.25, 0.45, 0.5, 0.75, 0.8, 1.0]))
def test_quantiles_match_pandas(spark, values, p):
    df = spark.createDataFrame([(v if v is None else float(v),) for v in values], "x double")
    got = quantiles_wide(df, "x", [p], ["q"]).first().q
    s = pd.Series(values, dtype="float64").dropna()
    want = None if s.empty else s.quantile(p)
    if want is None:
        assert got is None
    else:
        assert got == pytest.approx(want)


@pytest.mark.parametrize("n", [1, 3, 10, 399, 401, 79_999, 80_001, 200_000])
def test_quantiles_of_any_group_size(spark, n):
    """Sizes on either side of where a margin of the bracket begins to hold."""
    probs = [0.0, 0.25, 0.5, 0.999, 1.0]
    x = ((F.col("id") * 7919) % 100_003).cast("double")
    df = spark.range(2 * n).select(x.alias("x"), (F.col("id") % 2).alias("g"))
    names = list("abcde")
    pdf = df.toPandas()
    for r in quantiles_wide(df, "x", probs, names, by=["g"]).collect():
        assert [r[c] for c in names] == pytest.approx(pdf[pdf.g == r.g].x.quantile(probs).tolist())
    got = {(r.variable, r.p): r.value for r in quantiles_columns(df, ["x", "g"], probs).collect()}
    for c in ("x", "g"):
        assert [got[(c, p)] for p in probs] == pytest.approx(pdf[c].quantile(probs).tolist())


def test_quantiles_of_ties_nulls_and_missing_groups(spark):
    rows = [(None, 1.0), (None, 3.0), ("a", None), ("b", 5.0), ("b", 5.0), ("b", float("nan")), ("c", 1.0)] + [("t", 7.0)] * 900 + [("t", 8.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {(r.g, r.p): r.value for r in quantiles_long(df, "x", [0.5, 1.0], by=["g"]).collect()}
    assert got == {
        (None, 0.5): 2.0, (None, 1.0): 3.0, ("a", 0.5): None, ("a", 1.0): None, ("b", 0.5): 5.0, ("b", 1.0): 5.0,
        ("c", 0.5): 1.0, ("c", 1.0): 1.0, ("t", 0.5): 7.0, ("t", 1.0): 8.0,
    }
    same = quantiles_long(df, "x", [0.5, 1.0], by=["g"], few_groups=True).collect()
    assert {(r.g, r.p): r.value for r in same} == got
    empty = quantiles_columns(df.limit(0), ["x"], [0.5]).collect()
    assert [(r.variable, r.value) for r in empty] == [("x", None)]


@pytest.mark.parametrize("n", [150, 5000])
def test_quantiles_whose_brackets_overlap(spark, n):
    """Close probabilities in any order, on many distinct and on few values:
    the same value can lie in several brackets, or in the gap between two."""
    probs = [0.5, 0.1, 0.502, 0.501, 0.9, 0.11, 0.999, 0.0]
    k = F.col("id") * 7919 % n
    df = spark.range(n).select(
        (k - n / 2).cast("double").alias("x"), F.when(k % 3 != 0, k % 4).alias("few"), F.when(k % 2 == 0, -0.0).otherwise(0.0).alias("zero"),
        F.lit(None).cast("double").alias("none"), F.when(k % 5 == 0, "hot").alias("g"),
    )
    pdf = df.drop("g").toPandas().astype("float64")
    for interpolate, method in ((True, "linear"), (False, "lower")):
        got = {(r.variable, r.p): r.value for r in quantiles_columns(df, pdf.columns, probs, interpolate).collect()}
        assert len(got) == len(probs) * 4 and all(got[("none", p)] is None for p in probs)
        for c in ("x", "few", "zero"):
            assert [got[(c, p)] for p in probs] == pytest.approx(pdf[c].dropna().quantile(probs, interpolation=method).tolist())
    got = {(r.g, r.p): r.value for r in quantiles_long(df, "x", probs, by=["g"]).collect()}
    for g, own in ((None, pdf.x[pdf.x.add(n / 2) % 5 != 0]), ("hot", pdf.x[pdf.x.add(n / 2) % 5 == 0])):
        assert [got[(g, p)] for p in probs] == pytest.approx(own.quantile(probs).tolist())


def _rows_made(plan):
    """(operator, rows) of every operator that ran."""
    stages = dict.fromkeys(("ResultQueryStage", "ShuffleQueryStage", "BroadcastQueryStage"), "plan")
    inner = (stages | {"AdaptiveSparkPlan": "executedPlan"}).get(plan.nodeName())
    below = [getattr(plan, inner)()] if inner else [plan.children().apply(i) for i in range(plan.children().size())]
    made = plan.metrics().get("numOutputRows")
    own = [(plan.nodeName(), made.get().value())] if made.isDefined() else []
    return own + [x for p in below for x in _rows_made(p)]


def test_a_value_is_met_once_whatever_the_probabilities(spark):
    df = spark.range(20_000).select(F.col("id").cast("double").alias("x"), (F.col("id") % 7).alias("y"))
    out = quantiles_columns(df, ["x", "y"], [i / 10 for i in range(1, 10)])
    out.collect()
    made = _rows_made(out._jdf.queryExecution().executedPlan())
    # a row for each value; a row for each value and probability would be 360,000
    assert max(n for _, n in made) == 40_000, made


def test_rank_outside_its_bracket_is_an_error(spark, monkeypatch):
    from panelforge.operators import quantiles as Q

    monkeypatch.setattr(Q, "MARGINS", (0.0,))
    monkeypatch.setattr(Q, "ROWS", 0)
    df = spark.range(100).select(F.col("id").cast("double").alias("x"))
    with pytest.raises(Exception, match="outside its bracket"):
        Q.quantiles_columns(df, ["x"], [0.25]).collect()


def test_histogram_matches_numpy(spark):
    vals = [0.0, 1.0, 1.5, 2.0, 9.99, 10.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.n for r in P.histogram(df, "x", 30).orderBy("bin").collect()]
    want, _ = np.histogram([v for v in vals if v is not None], bins=30)
    assert got == want.tolist()


def test_dataset_summary_counts_duplicates_and_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "k int, v string")
    r = P.dataset_summary({"t": df}).first()
    assert (r.filas, r.columnas, r.duplicados, r.valores_nulos_totales) == (5, 2, 2, 2)


def test_value_counts_share_of_all_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    out = {r.c: (r.cantidad, r.porcentaje) for r in P.value_counts(df, "c").collect()}
    assert out == {"a": (2, 50.0), "b": (1, 25.0)}


def test_mutual_information_independent_is_zero(spark):
    rows = [(x, y) for x in ("a", "b") for y in (0, 1) for _ in range(5)]
    df = spark.createDataFrame(rows, "c string, label int")
    r = P.mutual_information(df, "label", [], ["c"]).first()
    assert r.mutual_information == pytest.approx(0.0, abs=1e-12)


def test_correlation_of_many_columns(spark):
    """200 columns with gaps and far-off means, against numpy; the rows aren't expanded."""
    import numpy as np

    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 200)) + rng.normal(size=(120, 1)) + 1e6 * rng.normal(size=200)
    gone = rng.random(x.shape) < 0.1
    names = [f"v{i}" for i in range(200)]
    rows = [tuple(None if g else float(v) for v, g in zip(a, b, strict=True)) for a, b in zip(x, gone, strict=True)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(5)
    out = P.correlation_long(df, names)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("MapInArrow") and plan.count("Generate") == 1  # pairs are mirrored, after the sums
    got = {(r.var_a, r.var_b): r.corr for r in out.collect()}
    assert len(got) == 200 * 200
    for i, j in [(0, 0), (0, 1), (17, 150), (199, 3), *rng.integers(0, 200, (300, 2))]:
        both = ~gone[:, i] & ~gone[:, j]
        assert abs(got[names[i], names[j]] - np.corrcoef(x[both, i], x[both, j])[0, 1]) < 1e-7


def test_correlation_of_odd_values(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, float("nan"), None), (3.0, 5.0, None)], "a double, b double, c double")
    got = {(r.var_a, r.var_b): r.corr for r in P.correlation_long(df, ["a", "b", "c"]).collect()}
    assert got["a", "a"] == 1.0 and str(got["a", "b"]) == "nan" and got["a", "c"] is None and got["c", "c"] is None
    assert P.correlation_long(df.limit(0), ["a", "b"]).count() == 0
