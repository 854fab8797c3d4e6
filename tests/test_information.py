"""Nearest-neighbour mutual information against plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from panelforge.operators import information as I
from panelforge.operators import profile as P


def psi(m):
    return sum(1 / i for i in range(1, m)) - 0.5772156649015329


def brute(pairs, k):
    """The estimate by comparing all rows with all rows."""
    pairs = [(x, y) for x, y in pairs if x is not None and y is not None and math.isfinite(x)]
    classes = {}
    for x, y in pairs:
        classes.setdefault(y, []).append(x)
    pairs = [(x, y) for x, y in pairs if len(classes[y]) > 1]
    if not pairs:
        return None
    total = 0.0
    for x, y in pairs:
        other = sorted(abs(x - z) for z in classes[y])[1:]
        d = other[min(k, len(other)) - 1]
        if d == 0:
            kk, m = classes[y].count(x), sum(z == x for z, _ in pairs)
        else:
            kk, m = min(k, len(other)), sum(abs(z - x) < d * (1 - 1e-10) for z, _ in pairs)
        total += psi(kk) - psi(len(classes[y])) - psi(m)
    return max(0.0, psi(len(pairs)) + total / len(pairs))


def test_digamma(spark):
    df = spark.range(1, 3000).select("id", I.digamma(F.col("id")).alias("psi"))
    assert all(r.psi == pytest.approx(psi(r.id), abs=1e-11) for r in df.collect())


def test_prefix_sums_with_a_large_group(spark):
    rng = random.Random(3)
    rows = [("a" if i % 5 else "b", i, rng.randrange(9)) for i in range(2000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, o long, v long").repartition(7)
    got = {(r.g, r.o): r.s for r in I.prefix_sums(df, ["g"], ["o"], "v", "s").collect()}
    for g in "ab":
        seen = 0
        for _, o, v in sorted(r for r in rows if r[0] == g):
            assert got[(g, o)] == seen
            seen += v


@pytest.mark.parametrize("k,block", [(1, 1), (3, 3), (3, 16), (5, 4096)])
def test_against_brute_force(spark, k, block):
    rng = random.Random(k * 100 + block)
    cases = {
        "continuous": [(rng.gauss(i % 3, 1.0), str(i % 3)) for i in range(300)],
        "far": [(1e6 + rng.random() * 10, "p" if rng.random() < 0.7 else "q") for _ in range(300)],
        "ties": [(float(rng.randrange(6)), rng.choice("xyz")) for _ in range(300)],
        "one value": [(4.0, rng.choice("xy")) for _ in range(60)],
        "hot": [(0.0 if i % 3 == 0 else rng.random() - 0.5, "a" if i % 10 else "b") for i in range(300)],
        "odd": [(None, "a"), (1.0, None), (float("nan"), "a"), (float("inf"), "a"), (1.0, "a"), (2.0, "a"), (-0.0, "b"), (0.0, "b"), (9.0, "single")],
        "two classes of two": [(0.0, "a"), (1.0, "a"), (5.0, "b"), (6.0, "b")],
        "nothing": [(1.0, "a"), (2.0, "b")],
    }
    rows = [(name, x, y) for name, pairs in cases.items() for x, y in pairs]
    df = spark.createDataFrame(rows, "variable string, x double, y string").repartition(5)
    got = {r.variable: r.mutual_information for r in I.nearest_information(df, k, block).collect()}
    want = {name: brute(pairs, k) for name, pairs in cases.items()}
    assert got == {n: pytest.approx(v, abs=1e-9) for n, v in want.items() if v is not None}


def test_empty_table_and_wrong_arguments(spark):
    none = spark.createDataFrame([], "variable string, x double, y string")
    assert I.nearest_information(none).count() == 0
    with pytest.raises(ValueError):
        I.nearest_information(none, 5, 4)
    with pytest.raises(ValueError, match="unknown method"):
        P.mutual_information(none, "y", ["x"], [], method="other")


def test_no_class_goes_through_one_window(spark, monkeypatch):
    """The windows are by block or by range partition, never by class alone."""
    seen = []
    made = I.cut_lineage
    monkeypatch.setattr(I, "cut_lineage", lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or made(df))
    df = spark.range(200).select((F.col("id") % 2).cast("string").alias("variable"), F.col("id").cast("double").alias("x"), (F.col("id") % 3).cast("string").alias("y"))
    I.nearest_information(df).collect()
    plans = "\n".join(seen)
    assert "_block" in plans and "rangepartitioning" in plans
    assert "CartesianProduct" not in plans and "BroadcastNestedLoopJoin" not in plans


def test_signal_of_features(spark):
    rng = random.Random(11)
    rows = []
    for i in range(300):
        label = i % 2
        rows.append((label, rng.gauss(3.0 * label, 1.0), rng.gauss(0, 1) if i % 4 else None, "ab"[label], rng.gauss(2.0 * label, 0.5)))
    df = spark.createDataFrame(rows, "label int, near double, noise double, c string, days double")
    got = {r.variable: r.mutual_information for r in P.mutual_information(df, "label", ["near", "noise"], ["c"], method="nearest").collect()}
    filled = sorted(r[2] for r in rows if r[2] is not None)
    middle = (filled[len(filled) // 2] + filled[(len(filled) - 1) // 2]) / 2
    assert got["c"] == pytest.approx(math.log(2), abs=1e-9)
    assert got["near"] == pytest.approx(brute([(r[1], r[0]) for r in rows], 3), abs=1e-9)
    assert got["noise"] == pytest.approx(brute([(middle if r[2] is None else r[2], r[0]) for r in rows], 3), abs=1e-9)
    more = {r.variable: r.mutual_information for r in P.mutual_information(df, "days", ["near"], ["c"], regression=True, method="nearest").collect()}
    assert more["c"] == pytest.approx(brute([(r[4], r[3]) for r in rows], 3), abs=1e-9)
    assert more["near"] > 0.2
