import math
import random

import brute
import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from panelforge.llm import rangejoin as R
from panelforge.llm.queries import op13_embedding_dedup

SCHEMA = "vec_id long, embedding array<float>"


def order(found):
    return sorted(found, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


def table(dim=8, n=260, seed=5):
    """Groups of near-copies of several widths, copies, scaled copies, lone vectors, odd rows."""
    rng = np.random.default_rng(seed)
    out = []
    for width, size in ((0.02, 60), (0.08, 50), (0.15, 40), (0.3, 30)):
        centre = rng.normal(size=dim)
        centre /= np.linalg.norm(centre)
        out += [centre + rng.normal(size=dim) * width for _ in range(size)]
    out += [rng.normal(size=dim) for _ in range(n - len(out))]
    out = [np.float32(v).tolist() for v in out]
    out += [out[3]] * 25 + [[-x for x in out[3]]] * 3 + [[4 * x for x in out[70]], [x * 2.0**-60 for x in out[71]], [x * 2.0**90 for x in out[72]]]
    out += [None, [], [0.0] * dim, [None] + out[0][1:], [math.nan] + out[0][1:], [math.inf] + out[0][1:], out[0][:-1], out[0][:-1], [1.0], [2.0], [-1.0]]
    found = list(enumerate(out))
    random.Random(seed).shuffle(found)
    return found + [(None, out[5]), (None, out[6]), (7, out[100]), (7, None), (None, None)]


@pytest.mark.parametrize("sizes", [{}, {"cell_rows": 20}, {"cell_rows": 9, "chunk_rows": 64, "probe_rows": 30}])
@pytest.mark.parametrize("dim", [3, 8])
def test_against_brute_force(spark, sizes, dim):
    data = table(dim)
    df = spark.createDataFrame(data, SCHEMA).repartition(3).withColumns({c: F.lit("other") for c in ("uid", "cell", "times", "label", "links", "rep", "_same", "least")})
    want = brute.embedding_links(data)
    want = [(i, n, c, i == c) for i, n, c, _ in want]
    assert rows(R.near_duplicates(df, **sizes)) == order(want)
    kept = R.keep_one(df, **sizes)
    assert kept.columns == df.columns
    gone = {i for i, _, c, k in want if not k and i is not None}
    assert rows(kept, "vec_id") == order([(i,) for i, _ in data if i not in gone])


@pytest.mark.parametrize("threshold", [0.5, 0.99, 1.0])
def test_other_thresholds(spark, threshold):
    data = [r for r in table(4, seed=8)]
    want = [(i, n, c, i == c) for i, n, c, _ in brute.embedding_links(data, threshold)]
    if threshold == 1.0:  # only exact directions of small whole numbers, whose cosine is exact
        data = [(k, v) for k, v in enumerate([[3.0, 4.0], [6.0, 8.0], [3.0, 4.0], [4.0, 3.0], [-3.0, -4.0]])]
        want = [(i, n, c, i == c) for i, n, c, _ in brute.embedding_links(data, threshold)]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(R.near_duplicates(df, threshold, cell_rows=25)) == order(want)
    with pytest.raises(ValueError):
        R.near_duplicates(df, 0.0)


def test_cosine_on_the_border(spark):
    """9 / (1 * 10) is a link; one step of a float below it isn't."""
    down = float(np.nextafter(np.float32(9), np.float32(0)))
    data = [(0, [1.0, 0.0, 0.0, 0.0, 0.0]), (1, [9.0, 4.0, 1.0, 1.0, 1.0]), (2, [down, 4.0, 1.0, 1.0, 1.0]), (3, [0.0, 0.0, 0.0, 0.0, 1.0])]
    df = spark.createDataFrame(data, SCHEMA)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in R.near_duplicates(df).collect()}
    assert got == {0: (1, 0), 1: (2, 0), 2: (1, 0), 3: (0, 3)}


def test_chain_goes_through_cells(spark):
    """Each point is linked with its neighbours only; the chain is one component."""
    step = math.acos(0.9) * 0.98
    data = [(i, [math.cos(0.5 * a) * 3, math.sin(0.5 * a) * 3]) for i, a in enumerate(2 * step * k for k in range(7))]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, R.near_duplicates(df, cell_rows=2).collect()))
    assert got == [(i, 1 if i in (0, 6) else 2, 0, i == 0) for i in range(7)]


def test_whole_cells_are_not_copied(spark):
    """Of narrow groups nothing meets in a task: the triangle inequality links them whole."""
    rng = np.random.default_rng(1)
    centre = rng.normal(size=16)
    data = [(i, np.float32(centre + rng.normal(size=16) * 0.01).tolist()) for i in range(400)]
    df = spark.createDataFrame(data, SCHEMA)
    assert {tuple(r)[1:] for r in R.near_duplicates(df, cell_rows=50).collect()} == {(399, 0, True), (399, 0, False)}


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert R.near_duplicates(df).count() == 0
    none = spark.createDataFrame([(1, None), (2, [0.0])], SCHEMA)
    assert sorted(map(tuple, R.near_duplicates(none).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_query_on_the_whole_table(spark, sf):
    table = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    x = np.array([v for _, v in table], np.float64)
    near = (x @ x.T) / np.outer(*[np.linalg.norm(x, axis=1)] * 2) >= 0.9
    got = {r["vec_id"]: r["n_links"] for r in op13_embedding_dedup(spark, sf).collect()}
    assert got == {i: int(n) - 1 for (i, _), n in zip(table, near.sum(axis=1), strict=True)}


def test_query_on_planted_groups(spark):
    """All rows of the small check table, with groups of up to hundreds."""
    path = "/root/testdata/check_s/embeddings.parquet"
    try:
        df = spark.read.parquet(path)
    except Exception:
        pytest.skip("no such table here")
    t = df.select("vec_id", "embedding").toPandas().sort_values("vec_id")
    x = np.stack(t["embedding"]).astype(np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    n = np.concatenate([(x[k : k + 1000] @ x.T >= 0.9).sum(axis=1) - 1 for k in range(0, len(x), 1000)])
    got = op13_embedding_dedup(spark, "/root/testdata/check_s").toPandas().sort_values("vec_id")
    assert (got["n_links"].to_numpy() == n).all()
    assert (got["kept"].to_numpy() == (got["component_id"] == got["vec_id"]).to_numpy()).all()
