import itertools
import random

import brute
import numpy as np
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelforge.llm import divergence as D

SCHEMA = "text string, lang string, source string"


def table():
    rng = random.Random(3)
    words = ["boat", "Quay", "storm", "été", "日本", "ÅNGSTRÖM", "x", "it's", "a1b"] + [f"w{chr(97 + i)}" for i in range(20)]
    out = []
    for lang, sources in (("en", 5), ("de", 2), ("fr", 1), (None, 3)):
        for i in range(30):
            n = rng.choice([0, 1, 8, 40])
            out.append((" ".join(rng.choices(words, range(1, len(words) + 1), k=n)), lang, f"s{i % sources}"))
    # a group without terms, one without kept terms, null and empty sources, repeated rows, a long text, ties
    out += [("", "en", "silent"), (None, "en", "silent"), ("only here once", "en", "rare"), ("boat storm", "en", None), ("boat", "en", "")]
    out += [("boat boat storm", "en", "s1")] * 3 + [("storm " * 30_000 + "quay", "de", "s0")] + [("12 !?", "xx", "a"), ("", "xx", "b"), ("...", "xx", "c")]
    return out + [("tie knot", "tt", "a"), ("tie knot", "tt", "b"), ("tie knot", "tt", "c")]


def test_against_brute_force(spark):
    df = spark.createDataFrame(table(), SCHEMA).repartition(4).withColumns({c: F.lit("other") for c in ("term", "n", "path", "sid", "s", "t", "x", "p", "q", "rank")})
    for top in (200, 4):
        want = brute.divergence(table(), top=top)
        assert rows(D.report(df, top=top)) == want
    assert any(w[2] == "pair" and w[4] == 0 for w in want) and any(w[1] == "silent" for w in want)
    assert D.report(df.limit(0)).count() == 0


def test_flushed_counts_and_salted_pairs(spark, monkeypatch):
    monkeypatch.setattr(D, "HELD_TERMS", 10)
    monkeypatch.setattr(D, "CHUNK", 3)
    df = spark.createDataFrame(table(), SCHEMA).repartition(2)
    want = brute.divergence(table())
    assert rows(D.report(df)) == want
    audit = D.Audit(df)
    few = {tuple(r) for r in audit.pairs().collect()}

    class Many:  # as if there were too many sources for a broadcast
        def __init__(self, df):
            self.df = df

        def limit(self, n):
            return spark.range(n)

        def __getattr__(self, name):
            return getattr(self.df, name)

    audit.groups = Many(audit.groups)
    assert {tuple(r) for r in audit.pairs().collect()} == few == {w[:2] + w[3:5] for w in want if w[2] == "pair"}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 4), st.integers(1, 3)), min_size=1, max_size=5, unique_by=lambda x: x[0]).map(sorted), max_size=12))
def test_tree_counts_pairs_once_per_node_and_ancestor(paths):
    """Node counts times (node, ancestor) give the pairs of all paths."""
    merged = {}
    for p in paths:
        merged[tuple(p)] = merged.get(tuple(p), 0) + 1
    order = sorted(merged)
    nodes = list(zip(*D.tree_nodes([list(p) for p in order], [merged[p] for p in order]), strict=True))
    found, want = {}, {}
    for row, depth, n in nodes:
        for up in range(depth):
            k = (order[row][up], order[row][depth])
            found[k] = found.get(k, 0) + n
    for p in paths:
        for k in itertools.combinations(p, 2):
            want[k] = want.get(k, 0) + 1
    assert found == want
    # no node twice: as many as there are different beginnings
    assert len({order[r][: d + 1] for r, d, _ in nodes}) == len(nodes)


def test_large_counts_do_not_overflow(spark):
    df = spark.createDataFrame([(9 * 10**17, 10**18, 5)], "n long, total long, kept long")
    got = df.select(D.share(F.col("n"), F.col("total"), F.col("kept")).alias("p")).first()["p"]
    assert got == 1 + 10**9 * (9 * 10**17 + 1) // (10**18 + 5)
    big, one = np.array([10**9 + 1]), np.array([1])
    assert D._f(big, one)[0] == 10**18


def test_plan_has_no_cross_join(spark, sf):
    df = D.report(spark.read.parquet(f"{sf}/documents.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
