"""Query registry: name -> (Spark builder, DuckDB twin or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import round_half_up


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    note: str = ""


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, note: str = ""):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, sql.strip() if sql else None, note)
        return fn

    return deco


def R(c, d: int = 6) -> Column:
    """Output normalisation shared with the SQL twins (``round_half_up``)."""
    return round_half_up(c, d)


def normalise(df: DataFrame, cols, d: int = 6) -> DataFrame:
    return df.withColumns({c: R(c, d) for c in cols if c in df.columns})


def materialise(df: DataFrame) -> DataFrame:
    """A derived table that a multi-pass operator reads several times is
    written once to the shared checkpoint folder (reliable checkpoint:
    survives executor loss, cuts the lineage) instead of being re-derived
    on every pass."""
    from ..session import cut_lineage

    return cut_lineage(df)
