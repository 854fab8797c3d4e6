"""Plan properties: pruning and pushdown reach the scan, no Python UDFs,
forbidden columns absent, the flagship runs."""

import pytest

from panelforge.plans import load_all
from panelforge.sources.tables import read_table


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns_and_pushes_filters(spark, sf):
    from pyspark.sql import functions as F

    li = read_table(spark, sf, "lineitem").where(F.col("l_quantity") > 10).select("l_orderkey")
    p = _plan(li)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in p


@pytest.mark.parametrize("name", ["f3_inventory_history", "a7_correlation", "h1_stratified_split", "a18_boxplot_by_priority",
                                  "v1_request_validation", "f1_priority_features"])
def test_no_python_udf(spark, sf, name):
    p = _plan(load_all()[name].build(spark, sf))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p


def test_stock_features_exclude_forbidden(spark, sf):
    from panelforge.operators import features as FE
    from panelforge.plans import roles

    for h in (7, 14):
        fs = FE.stock_features(roles.consumo(spark, sf), roles.catalogue(spark, sf), h)
        assert not set(fs.df.columns) & set(FE.STOCK_LEAKAGE_FEATURES)
        assert "stock_critico_7d" not in fs.df.columns and "stock_critico_14d" not in fs.df.columns
    with pytest.raises(ValueError):
        FE.stock_features(roles.consumo(spark, sf), roles.catalogue(spark, sf), 10)


def test_demand_lags_have_no_nulls(spark, sf):
    from pyspark.sql import functions as F

    from panelforge.operators import features as FE
    from panelforge.plans import roles

    fs = FE.demand_features(roles.consumo(spark, sf), roles.catalogue(spark, sf))
    nulls = fs.df.select([F.sum(F.col(c).isNull().cast("int")).alias(c) for c in FE.DEMAND_NUM]).first()
    assert all(v == 0 for v in nulls)


def test_entry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_no_cross_joins_or_python_udfs_in_any_query(spark, sf):
    """Every registered query: no Cartesian product / nested-loop join (all
    joins are equi-joins) and no Python evaluation operators."""
    bad = {}
    for name, q in sorted(load_all().items()):
        if name.startswith("m") or name.startswith("a27"):
            continue  # model fits: their plans are built while fitting
        p = _plan(q.build(spark, sf))
        hits = [k for k in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython") if k in p]
        if hits:
            bad[name] = hits
    assert bad == {}


@pytest.mark.parametrize("name", ["p14_date_parts", "a15_monthly_series", "st2_daily_confidence", "w6_days_since_restock"])
def test_results_do_not_depend_on_session_zone(spark, sf, name):
    q = load_all()[name]
    utc = sorted(map(tuple, q.build(spark, sf).collect()))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        other = sorted(map(tuple, q.build(spark, sf).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert utc == other


def test_quantiles_do_not_shuffle_the_rows(spark, sf):
    """A3 when the table is too large to broadcast: its rows meet no sort-merge
    join; what is exchanged are partial counts and values inside brackets."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        df = load_all()["a3_iqr_outliers"].build(spark, sf)
        before = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    lines = before.split("\n")
    for i, line in enumerate(lines):
        if "FileScan parquet" in line and "l_quantity" in line:
            above = next(x for x in reversed(lines[:i]) if "Exchange" in x or "Aggregate" in x or "Join" in x)
            assert "Exchange" not in above and "SortMergeJoin" not in above, above


def test_signal_derives_shared_tables_once(spark, sf, monkeypatch):
    """A19 has two feature sets of patients and three of the item panel."""
    from panelforge.plans import roles

    built = []
    for name in ("panel", "pacientes"):
        monkeypatch.setattr(roles, name, lambda *a, name=name, f=getattr(roles, name): built.append(name) or f(*a))
    load_all()["a19_mutual_information"].build(spark, sf)
    assert sorted(built) == ["pacientes", "panel"]
