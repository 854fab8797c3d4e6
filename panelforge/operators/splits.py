"""Reproducible train/test splits and cross-validation folds (H1-H6).

Random splits are decided by a seeded hash of a stable key, never by
``rand()``/``randomSplit`` (both depend on partitioning), so a row lands on
the same side on every run and every cluster size, and no shuffle is
needed. Temporal cut points come from per-date counts: the distinct dates
are few next to the rows, so their running total is a small window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .joins import attach_row

SEED = 42
TEST_SIZE = 0.2
BUCKETS = 10_000
_M = 2147483647  # 2^31 - 1, modulus of the Lehmer generator
_A = 48271


def hash_value(keys: Sequence[str], seed: int = SEED, method: str = "xxhash") -> Column:
    """Seeded hash of the key columns.

    ``xxhash`` works for any key types; ``lehmer`` (one integer key) is
    plain modular arithmetic that any SQL engine can reproduce.
    """
    if method == "lehmer":
        if len(keys) != 1:
            raise ValueError("lehmer hashing takes one integer key")
        k = F.col(keys[0]).cast("long")
        return F.pmod(F.pmod(k + F.lit(seed), F.lit(_M)) * F.lit(_A), F.lit(_M))
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), F.lit(2**62))


def bucket(keys: Sequence[str], seed: int = SEED, method: str = "xxhash", buckets: int = BUCKETS) -> Column:
    return F.pmod(hash_value(keys, seed, method), F.lit(buckets))


def hash_split(df: DataFrame, keys: Sequence[str], test_size: float = TEST_SIZE, seed: int = SEED,
               method: str = "xxhash") -> DataFrame:
    """H2 (and H1 in expectation, per class): ``split`` = 'test' for the
    lowest ``test_size`` share of hash buckets."""
    cut = int(round(test_size * BUCKETS))
    return df.withColumn("split", F.when(bucket(keys, seed, method) < cut, "test").otherwise("train"))


def stratified_split(df: DataFrame, label: str, keys: Sequence[str], test_size: float = TEST_SIZE, seed: int = SEED,
                     method: str = "xxhash") -> DataFrame:
    """H1 with exact per-class test counts: round(test_size * n_class) rows of
    each class go to test, the first ones in (bucket, hash, key) order.

    Per (class, bucket) counts are a small table; their running total finds
    the bucket where each class crosses its quota, and only the rows of that
    single bucket are ranked. No class is ever sorted as a whole. Rows without
    a class form a class of their own.
    """
    h = hash_value(keys, seed, method)
    b = F.pmod(h, F.lit(BUCKETS))
    rows = df.withColumns({"_h": h, "_b": b})
    counts = rows.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_c"))
    wc = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumns({"_cum": F.sum("_c").over(wc), "_n": F.sum("_c").over(Window.partitionBy(label))})
    quota = F.floor(F.col("_n") * F.lit(test_size) + F.lit(0.5))
    counts = counts.withColumn("_q", quota)
    # buckets fully inside the quota, and the one bucket that crosses it
    plan = counts.select(
        label, "_b",
        F.when(F.col("_cum") <= F.col("_q"), F.lit("all"))
        .when(F.col("_cum") - F.col("_c") < F.col("_q"), F.lit("part"))
        .otherwise(F.lit("none")).alias("_mode"),
        (F.col("_q") - (F.col("_cum") - F.col("_c"))).alias("_take"),
    )
    # a missing class is a class of its own, with its own quota
    p = plan.select(F.col(label).alias("_label"), F.col("_b").alias("_pb"), "_mode", "_take")
    j = rows.join(p, rows[label].eqNullSafe(p["_label"]) & (rows["_b"] == p["_pb"]), "left")
    drop = ["_h", "_b", "_label", "_pb", "_mode", "_take"]
    whole = j.where(F.col("_mode") != "part").withColumn(
        "split", F.when(F.col("_mode") == "all", "test").otherwise("train")
    )
    # only the rows of one bucket per class are ranked (about n_class / BUCKETS)
    rk = F.row_number().over(Window.partitionBy(label, "_b").orderBy("_h", *keys))
    part = j.where(F.col("_mode") == "part").withColumn("_rk", rk).withColumn(
        "split", F.when(F.col("_rk") <= F.col("_take"), "test").otherwise("train")
    ).drop("_rk")
    return whole.drop(*drop).unionByName(part.drop(*drop))


def hash_folds(df: DataFrame, keys: Sequence[str], k: int = 3, seed: int = SEED, method: str = "xxhash",
               col: str = "fold") -> DataFrame:
    """H4 / H5: fold id 0..k-1 from the key hash (``foldCol`` for CrossValidator)."""
    return df.withColumn(col, F.pmod(hash_value(keys, seed + 1, method), F.lit(k)).cast("int"))


def _fold_at(position: Column, n: Column, k: int) -> Column:
    """Fold of a row position: the first n % k folds have one row more."""
    size, longer = F.floor(n / F.lit(k)), n % F.lit(k)
    border = longer * (size + 1)
    after = longer + F.floor((position - border) / F.greatest(size, F.lit(1)))
    return F.when(position < border, F.floor(position / (size + 1))).otherwise(after).cast("int")


def contiguous_folds(df: DataFrame, order_by: Sequence[str], k: int = 3, col: str = "fold") -> DataFrame:
    """H5, unshuffled: ``k`` folds of neighbouring rows in ascending
    ``order_by`` order (NULL first), sizes differing by one row at most.

    The rows are range-partitioned and written once; the counts of the
    partitions (a row each) give the positions they span. A partition inside
    one fold needs no order; only those that hold a fold's border, fewer than
    ``k``, are ranked. Rows with equal ``order_by`` are ordered by a digest of
    their other columns, so a hot value is spread over many partitions; rows
    equal in every column are interchangeable and stay together. Fewer rows
    than ``k`` leave the last folds empty; an empty table stays empty.
    """
    tie, part = "_tie", "_part"
    rows = df.withColumn(tie, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    keys = [*order_by, tie]
    # written: the partition of a row must not change between the passes
    rows = cut_lineage(rows.repartitionByRange(*keys).withColumn(part, F.spark_partition_id()))
    counts = rows.groupBy(part).agg(F.count(F.lit(1)).alias("_c"))
    # one row per partition
    w = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("_before", F.sum("_c").over(w) - F.col("_c"))
    counts = attach_row(counts, counts.agg(F.sum("_c").alias("_n")))
    spans = counts.select(
        F.col(part).alias("_span"), "_before", "_n",
        _fold_at(F.col("_before"), F.col("_n"), k).alias("_first"),
        _fold_at(F.col("_before") + F.col("_c") - 1, F.col("_n"), k).alias("_last"),
    )
    placed = rows.join(F.broadcast(spans), F.col(part) == F.col("_span"))
    drop = [tie, part, "_span", "_before", "_n", "_first", "_last"]
    inside = placed.where(F.col("_first") == F.col("_last")).withColumn(col, F.col("_first"))
    rank = F.row_number().over(Window.partitionBy(part).orderBy(*keys))
    border = placed.where(F.col("_first") != F.col("_last")).withColumn(
        col, _fold_at(F.col("_before") + rank - 1, F.col("_n"), k)
    )
    return inside.drop(*drop).unionByName(border.drop(*drop))


def _date_positions(df: DataFrame, date: str) -> DataFrame:
    """Per distinct date (NULL sorted last): rows, rows before, rows up to it, total."""
    kind = df.schema[date].dataType.simpleString()
    if kind != "date":
        # days keep the window over distinct values as small as a calendar
        raise TypeError(f"{date} is {kind}; a split date must be a DATE")
    per = df.groupBy(F.col(date).alias("_d")).agg(F.count(F.lit(1)).alias("_c"))
    # one row per distinct date: a calendar-sized window
    w = Window.orderBy(F.col("_d").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    per = per.withColumns({"_cum": F.sum("_c").over(w)})
    return per.withColumns({
        "_before": F.col("_cum") - F.col("_c"),
        "_n": F.sum("_c").over(Window.partitionBy(F.lit(1))),
    })


def temporal_cutoff(df: DataFrame, date: str, test_size: float = TEST_SIZE) -> DataFrame:
    """H3: one row, ``cutoff`` = the date at sorted position int(n*(1-test_size))."""
    pos = _date_positions(df, date)
    k = F.floor(F.col("_n") * F.lit(1.0 - test_size))
    hit = pos.where((F.col("_before") <= k) & (F.col("_cum") > k))
    return hit.select(F.col("_d").alias("cutoff"), F.col("_n").alias("n_rows"))


def temporal_split(df: DataFrame, date: str, test_size: float = TEST_SIZE) -> DataFrame:
    """H3: train = date < cutoff; test = the rest, NULL dates included."""
    cut = temporal_cutoff(df, date, test_size).select("cutoff")
    # at most one row: a scalar subquery (NULL when the table is empty)
    j = attach_row(df, cut)
    train = F.coalesce(F.col(date) < F.col("cutoff"), F.lit(False))
    return j.withColumn("split", F.when(train, "train").otherwise("test"))


def check_split(split_df: DataFrame) -> dict[str, int]:
    """Counts per side; raises when one side is empty (an action, for callers)."""
    counts = {r["split"]: r["n"] for r in split_df.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts.get("train") or not counts.get("test"):
        raise ValueError("temporal split left an empty side; check the dates")
    return counts


def expanding_folds(df: DataFrame, date: str, n_splits: int = 3) -> DataFrame:
    """H6: expanding-window folds over date order.

    Fold i (1-based) tests the rows at sorted positions
    [n - (n_splits - i + 1) * t, n - (n_splits - i) * t) with t = n // (n_splits + 1)
    and trains on everything before; boundaries are snapped to whole dates
    (a date never straddles train and test). Returns (fold, lo, hi) dates,
    ``hi`` NULL for the last fold.
    """
    pos = _date_positions(df.where(F.col(date).isNotNull()), date)
    t = F.floor(F.col("_n") / F.lit(n_splits + 1))
    rows = []
    for i in range(1, n_splits + 1):
        start = F.col("_n") - F.lit(n_splits - i + 1) * t
        end = F.col("_n") - F.lit(n_splits - i) * t
        rows.append(F.struct(F.lit(i).alias("fold"), start.alias("_start"), end.alias("_end")))
    bounds = pos.select("_d", "_before", "_cum", "_n", F.explode(F.array(*rows)).alias("_f")).select("_d", "_before", "_cum", "_n", "_f.*")
    lo = bounds.where((F.col("_before") <= F.col("_start")) & (F.col("_cum") > F.col("_start"))).select("fold", F.col("_d").alias("lo"))
    hi = bounds.where((F.col("_before") <= F.col("_end")) & (F.col("_cum") > F.col("_end"))).select("fold", F.col("_d").alias("hi"))
    folds = df.sparkSession.range(1, n_splits + 1).select(F.col("id").cast("int").alias("fold"))
    return folds.join(lo, "fold", "left").join(hi, "fold", "left")


def assign_expanding(df: DataFrame, date: str, folds: DataFrame, n_splits: int = 3) -> DataFrame:
    """Rows x folds with ``role`` train/test (rows outside a fold's range dropped).

    ``folds`` has n_splits rows, so it is broadcast.
    """
    ids = F.array(*[F.lit(i) for i in range(1, n_splits + 1)])
    j = df.withColumn("fold", F.explode(ids)).join(F.broadcast(folds), "fold")
    d = F.col(date)
    role = F.when(d < F.col("lo"), "train").when((d >= F.col("lo")) & (F.col("hi").isNull() | (d < F.col("hi"))), "test")
    return j.withColumn("role", role).where(F.col("role").isNotNull())
