import random

import brute
import numpy as np
import pytest
from conftest import TEXTS, rows
from pyspark.sql import functions as F

from panelforge.llm import simhash


def unsigned(x):
    return x & (2**64 - 1)


def test_fingerprints_and_classes(docs):
    got = rows(simhash.report(docs))
    fps = [brute.simhash(t) for _, t in TEXTS]
    ids = [k for k, _ in TEXTS]
    want = zip(ids, (f"{f:016x}" for f in fps), brute.components(ids, fps), strict=True)
    assert got == sorted(want, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


def near_codes(n, seed):
    """Codes of which many are near each other, some by chains."""
    rnd = random.Random(seed)
    out = {0}
    while len(out) < n:
        c = rnd.choice(sorted(out)) if rnd.random() < 0.8 else rnd.getrandbits(64)
        for _ in range(rnd.choice((0, 1, 2, 3, 3, 4, 5))):
            c ^= 1 << rnd.randrange(64)
        out.add(c)
    return np.array(sorted(out), np.uint64).view(np.int64)


def test_index_finds_all_links():
    codes = near_codes(300, 1)
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    bounds = np.array([0, 1, 120, 120 + 8, 300])
    got = {(int(a), int(b)) for x, y in simhash.index_links(codes, bounds) for a, b in zip(x, y, strict=True)}
    want = {
        (i, j)
        for a, b in zip(bounds, bounds[1:], strict=False)
        for i in range(a, b)
        for j in range(i + 1, b)
        if unsigned(int(codes[i]) ^ int(codes[j])).bit_count() <= 3
    }
    assert got == want


def test_gray_rank():
    rank = np.arange(64, dtype=np.uint64)
    assert (simhash.gray_rank((rank ^ (rank >> np.uint64(1))).view(np.int64)) == rank).all()


@pytest.mark.parametrize("group_rows", [4096, 20, 3])
def test_classes_with_groups_dealt_again(spark, group_rows):
    codes = [int(c) for c in near_codes(400, 2)]
    want = brute.components(list(range(len(codes))), [unsigned(c) for c in codes])
    fps = spark.createDataFrame([(c,) for c in codes], "fp long")
    sizes = simhash.candidate_groups(fps, group_rows=group_rows).groupBy("key").count().collect()
    assert group_rows > 400 or max(r["count"] for r in sizes) <= 4 * group_rows + 12
    edges = simhash.linked_edges(fps, group_rows=group_rows)
    label = {r["node"]: r["label"] for r in simhash.classes(edges).collect()}
    groups = {}
    for c, k in zip(codes, want, strict=True):
        groups.setdefault(k, set()).add(label.get(c, c))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_long_chain_of_labels(spark):
    n = 40
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "a long, b long")
    assert {r["label"] for r in simhash.classes(edges).collect()} == {0}


def test_keep_one(docs, no_docs):
    docs = docs.selectExpr("*", "'a' AS _at", "'g' AS _gone", "'i' AS gone_id", "'r' AS _row")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert [tuple(r) for r in kept.select("_at", "_gone", "gone_id", "_row").distinct().collect()] == [("a", "g", "i", "r")]
    fps = [brute.simhash(t) for _, t in TEXTS]
    ids = [k for k, _ in TEXTS]
    want = {k for k, c in zip(ids, brute.components(ids, fps), strict=True) if k == c and k is not None}
    got = [r[0] for r in rows(kept, "doc_id")]
    assert [k for k in got if k is not None] == sorted(want)
    assert got.count(None) == ids.count(None)
    assert simhash.keep_one(no_docs).count() == 0 and simhash.report(no_docs).count() == 0


def test_query_against_brute_force(spark, sf):
    from panelforge.llm.queries import op4_simhash

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    fps = [brute.simhash(r["text"]) for r in docs]
    ids = [r["doc_id"] for r in docs]
    want = list(zip(ids, (f"{f:016x}" for f in fps), brute.components(ids, fps), strict=True))
    assert rows(op4_simhash(spark, sf)) == want


def test_majority_over_chunks(monkeypatch):
    rnd = np.random.default_rng(0)
    h = rnd.integers(-(2**63), 2**63 - 1, 1000)
    ends = np.array([0, 3, 3, 700, 701, 1000, 1000])
    want = simhash.majority(h, ends)
    monkeypatch.setattr(simhash, "CHUNK", 64)
    assert (simhash.majority(h, ends) == want).all() and want[0] == 0


def test_keep_one_with_repeated_ids(spark):
    alone, pair = "quite another text about glass and iron and salt " * 3, "the boats came home before the storm broke over the bay " * 3
    table = [(1, pair, "a"), (5, pair, "b"), (5, alone, "d"), (5, alone, "c"), (9, "short one", "e"), (9, "gulls over the far hills at noon", "f")]
    df = spark.createDataFrame(table, "doc_id long, text string, source string")
    want = [(1, pair, "a"), (5, alone, "c"), (9, "gulls over the far hills at noon", "f"), (9, "short one", "e")]
    assert rows(simhash.keep_one(df)) == want
    assert rows(simhash.keep_one(df.orderBy(F.desc("source")).repartition(2))) == want
