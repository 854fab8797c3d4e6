"""Joins: validated many-to-one lookups and top-k membership."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import OTHER_CATEGORY


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row aggregate to every row of ``df``.

    The row is a scalar subquery (``DataFrame.scalar``): computed once and
    used as a constant, so there is no join (and no cross join) at all.
    More than one row is a run-time error, as for any scalar subquery.
    """
    cols = one_row.columns
    s = one_row.select(F.struct(*cols).alias("_row")).scalar()
    return df.withColumn("_row", s).withColumns({c: F.col(f"_row.{c}") for c in cols}).drop("_row")


def unique_on(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Same rows, but the job fails if ``key`` repeats (pandas ``validate``).

    The check is a window on the join key, so a shuffle join on that key
    reuses its partitioning; it is a filter, hence never pruned away.
    """
    keys = [key] if isinstance(key, str) else list(key)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    msg = F.concat(F.lit(f"duplicate key in many-to-one join on {keys}: "), F.concat_ws(",", *[F.col(k).cast("string") for k in keys]))
    checked = df.withColumn("_dup_n", n)
    return checked.filter(F.when(F.col("_dup_n") > 1, F.raise_error(msg)).otherwise(F.lit(True))).drop("_dup_n")


def many_to_one_join(left: DataFrame, right: DataFrame, key: str | list[str], how: str = "left",
                     right_unique: bool = False) -> DataFrame:
    """``left`` joined to a right side whose key must be unique.

    The key is checked unless the caller states ``right_unique`` (a right
    side that is itself a ``groupBy`` on the key is unique by construction;
    skipping the check there also keeps it broadcastable). No broadcast
    hint: the optimizer broadcasts the right side when its estimated (or,
    with AQE, measured) size is under the threshold and keeps a shuffle join
    otherwise.
    """
    return left.join(right if right_unique else unique_on(right, key), on=key, how=how)


def top_k_values(df: DataFrame, col: str, k: int) -> DataFrame:
    """The ``k`` most frequent non-null values (ties broken by value)."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_freq"))
    return counts.orderBy(F.col("_freq").desc(), F.col(col).asc()).limit(k).select(col)


def keep_top_k(df: DataFrame, col: str, k: int, out: str | None = None, other: str = OTHER_CATEGORY) -> DataFrame:
    """Values outside the top ``k`` (and NULL) become ``other``.

    The membership side has at most ``k`` rows, so it is broadcast.
    """
    out = out or col
    top = top_k_values(df, col, k).withColumn("_hit", F.lit(True))
    joined = df.join(F.broadcast(top), on=col, how="left")
    kept = F.when(F.col("_hit"), F.col(col).cast("string")).otherwise(F.lit(other))
    return joined.withColumn(out, kept).drop("_hit")
