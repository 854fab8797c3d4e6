"""A19 over the six feature sets; registered after the feature queries it reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FE
from ..operators import information as I
from ..operators import profile as P
from .q_reports import a19_signal, _a19_sql
from . import q_panel  # noqa: F401  (its feature queries must be registered)
from .registry import QUERIES, materialise, normalise, query


@query("a19_mutual_information", _a19_sql(), note="binned plug-in MI of every feature of the six models, ranked")
def a19_mutual_information(spark, sf):
    return a19_signal(spark, sf)


def _nearest_sql(model: str, long: str) -> str:
    """The estimate row by row: ``long`` gives (rid, variable, x, y)."""
    k = I.NEIGHBORS
    beside = ", ".join(f"x - lag(x, {i}) OVER w, lead(x, {i}) OVER w - x" for i in range(1, k + 1))
    psi = lambda c: (
        "(" + f"ln({c} + 6.0) - 0.5 / ({c} + 6.0) - 1.0 / (12.0 * ({c} + 6.0) ** 2) + 1.0 / (120.0 * ({c} + 6.0) ** 4)"
        f" - 1.0 / (252.0 * ({c} + 6.0) ** 6)" + "".join(f" - 1.0 / ({c} + {i}.0)" for i in range(6)) + ")"
    )
    return f"""SELECT '{model}' AS modelo, variable, GREATEST({psi("CAST(MAX(nn) AS DOUBLE)")} + AVG({psi("kk")} - {psi("ny")} - {psi("m")}), 0.0) AS mutual_information FROM (
WITH l AS ({long}),
s AS (SELECT *, CAST(COUNT(*) OVER (PARTITION BY variable, y) AS DOUBLE) AS ny FROM l),
t AS (SELECT *, list_sort(list_filter([{beside}], lambda v: v IS NOT NULL)) AS near,
             CAST(COUNT(*) OVER (PARTITION BY variable, y, x) AS DOUBLE) AS nxy FROM s WHERE ny > 1 WINDOW w AS (PARTITION BY variable, y ORDER BY x)),
d AS (SELECT *, near[CAST(LEAST({k}, ny - 1) AS INTEGER)] AS d FROM t),
r AS (SELECT *, GREATEST(d * (1 - {I.SHORTER!r}) - ABS(x) * {I.ROUNDING!r}, 0.0) AS r FROM d),
u AS (SELECT variable, rid, CASE WHEN d = 0 THEN nxy ELSE LEAST({k}, ny - 1) END AS kk, ny, COUNT(*) OVER (PARTITION BY variable) AS nn,
             CAST(COUNT(*) OVER (PARTITION BY variable ORDER BY x RANGE BETWEEN r PRECEDING AND r FOLLOWING) AS DOUBLE) AS m FROM r)
SELECT * FROM u) z GROUP BY variable"""


def _features(name: str) -> str:
    return f"SELECT *, ROW_NUMBER() OVER () AS rid FROM ({QUERIES[name].sql}) q WHERE label IS NOT NULL"


def _nearest_numbers(model: str, name: str, cols) -> str:
    each = " UNION ALL ".join(
        f"SELECT rid, '{c}' AS variable, COALESCE(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM f)) AS x,"
        f" CAST(label AS VARCHAR) AS y FROM f" for c in cols
    )
    return _nearest_sql(model, f"WITH f AS ({_features(name)}) {each}")


def _nearest_categories(model: str, name: str, cols) -> str:
    each = " UNION ALL ".join(
        f"SELECT rid, '{c}' AS variable, CAST(label AS DOUBLE) AS x, COALESCE(CAST({c} AS VARCHAR), '∅') AS y FROM f" for c in cols
    )
    return _nearest_sql(model, f"WITH f AS ({_features(name)}) {each}")


@query(
    "a19_nearest_neighbours",
    "SELECT modelo, variable, floor(mutual_information * 1e6 + 0.5) / 1e6 AS mutual_information FROM ("
    + _nearest_numbers("prioridad_atencion", "f1_priority_features", FE.PRIORITY_NUM)
    + "\nUNION ALL\n" + _nearest_categories("duracion_estadia", "f2_stay_features", FE.CLINICAL_CAT) + ") s",
    note="nearest-neighbour MI: numbers with the priority class, categories with the length of stay",
)
def a19_nearest_neighbours(spark, sf):
    priority = materialise(QUERIES["f1_priority_features"].build(spark, sf).select(*FE.PRIORITY_NUM, "label"))
    stay = materialise(QUERIES["f2_stay_features"].build(spark, sf).select(*FE.CLINICAL_CAT, "label"))
    numbers = P.mutual_information(priority, "label", FE.PRIORITY_NUM, [], method="nearest")
    kinds = P.mutual_information(stay, "label", [], FE.CLINICAL_CAT, regression=True, method="nearest")
    out = numbers.select(F.lit("prioridad_atencion").alias("modelo"), "*").unionByName(
        kinds.select(F.lit("duracion_estadia").alias("modelo"), "*")
    )
    return normalise(out, ["mutual_information"])
