"""Embedding near-duplicates by an exact metric range join.

Vectors are compared by the angle between them, which is a metric: cosine at
least ``threshold`` is an angle of at most ``arccos(threshold)``, the range.
Equal vectors are one point with a multiplicity. Points are dealt to the cell
of their nearest pivot. A point is copied to another cell unless the triangle
inequality shows that nothing in there is in range:

* angle to the cell's pivot less the cell's radius is over the range, or
* the point is farther than the range from the plane half-way between its own
  pivot and the other one (points beyond it would be nearer to the other).

Where angle plus radius is within the range, all of the cell is in range: it
is counted whole, and nothing is copied. The same holds inside a cell of a
radius of at most half the range. Pairs are found once, as points are copied
to cells of higher numbers only. Cells join independently: each is cut into
chunks of bounded size, the points copied to it stream past a chunk (and are
dealt to several tasks where they are many), and a product of matrices in
single precision gives all cosines of a block; what is within its rounding
error of the threshold is computed again in double precision.

A task returns, for each point with a link, the number of its links there and
one point that it is connected with, never the pairs. Classes are joined over
these by least labels.

Bounds: at most ``MAX_PIVOTS`` pivots and ``PIVOT_VALUES`` numbers in them
(taken by least hash; they are part of the tasks' code), a chunk of
``CHUNK_ROWS`` points or ``CHUNK_VALUES`` numbers in a task. The work depends
on the data: vectors in groups or near a surface of few dimensions stay in few
cells, but vectors spread evenly in dozens of dimensions are at nearly the
same angle from every pivot, so most are copied to most cells, as any exact
join of such vectors has to compare most pairs.

Defined results: vectors that are null, empty, zero, or hold null or
non-finite components link with nothing; vectors of different length don't
link with each other. Repeated rows are vectors of their own that link. A null
``vec_id`` never names a component (one of such rows only has a null name, and
keeps its rows). Further columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared, small
from .simhash import classes

THRESHOLD = 0.9
#: Points for each pivot; most pivots, and most numbers in them.
CELL_ROWS = 4096
MAX_PIVOTS = 4096
PIVOT_VALUES = 4_000_000
#: Points of a cell that are held in memory together; fewer if they are long.
CHUNK_ROWS = 8192
CHUNK_VALUES = 8_000_000
#: Points that stream past a chunk in one task.
PROBE_ROWS = 200_000
#: Points of a block of the matrix product.
BLOCK_ROWS = 1024
#: Numbers that go to a Python worker at once.
ARROW_VALUES = 1_000_000
#: Angles are compared with so much to spare.
SLACK = 1e-6
#: Rows with vectors that may be broadcast.
BROADCAST_VECTORS = 50_000


# ---- vectors inside a task


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of equal length as rows of doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def units(x: np.ndarray) -> np.ndarray:
    x = _tame(x)
    return x / np.linalg.norm(x, axis=1)[:, None]


def _tame(x: np.ndarray) -> np.ndarray:
    """Rows whose squares would not fit a double are scaled by a power of two."""
    most = np.abs(x).max(axis=1, initial=0)
    odd = (most > 2.0**400) | (most < 2.0**-400)
    return np.ldexp(x, np.where(odd, -np.frexp(most)[1], 0)[:, None]) if odd.any() else x


def by_length(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    lengths = b.column("embedding").value_lengths().to_numpy(zero_copy_only=False)
    for n in np.unique(lengths):
        yield b if (lengths == n).all() else b.filter(pa.array(lengths == n))


class Points:
    """Vectors with their ids, multiplicities and norms."""

    def __init__(self, uid: np.ndarray, times: np.ndarray, x: np.ndarray):
        self.uid, self.times, self.x = uid, times, _tame(x)
        self.norm = np.linalg.norm(self.x, axis=1)
        self.unit = (self.x / self.norm[:, None]).astype(np.float32)

    def part(self, a: int, b: int | None = None) -> Points:
        out = object.__new__(Points)
        for k, v in vars(self).items():
            setattr(out, k, v[a:b])
        return out


def linked(a: Points, b: Points, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of all pairs with cosine of at least ``threshold``."""
    cos = a.unit @ b.unit.T
    error = (a.x.shape[1] + 8) * 2.0**-23  # of a product in single precision
    i, j = np.nonzero(cos >= np.float32(threshold - 2 * error))
    close = np.flatnonzero(cos[i, j] < np.float32(threshold + 2 * error))
    keep = np.ones(len(i), bool)
    for k in range(0, len(close), 65_536):
        at = close[k : k + 65_536]
        p, q = i[at], j[at]
        keep[at] = np.einsum("ij,ij->i", a.x[p], b.x[q]) / (a.norm[p] * b.norm[q]) >= threshold
    return i[keep], j[keep]


def unite(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Labels after joining the classes of each x and y; the least member names a class."""
    while True:
        lx, ly = label[x], label[y]
        open_ = lx != ly
        if not open_.any():
            return label
        x, y, lx, ly = x[open_], y[open_], lx[open_], ly[open_]
        low = np.minimum(lx, ly)
        np.minimum.at(label, lx, low)
        np.minimum.at(label, ly, low)
        while (label[label] != label).any():
            label = label[label]


class Chunk:
    """Some points of a cell, and what has been found out about them."""

    def __init__(self, parts: list[Points], alone: bool, threshold: float):
        whole = parts[0]
        if len(parts) > 1:
            whole = Points(*(np.concatenate([getattr(p, k) for p in parts]) for k in ("uid", "times", "x")))
        self.points, self.threshold = whole, threshold
        self.links = np.zeros(len(whole.uid))
        self.label = np.arange(len(whole.uid))
        if alone:
            self._inside()

    def _inside(self) -> None:
        p = self.points
        for at in range(0, len(p.uid), BLOCK_ROWS):
            i, j = linked(p.part(at, at + BLOCK_ROWS), p.part(at), self.threshold)
            i, j = i[j > i] + at, j[j > i] + at
            self.links += np.bincount(i, p.times[j], len(p.uid)) + np.bincount(j, p.times[i], len(p.uid))
            self.label = unite(self.label, i, j)

    def probe(self, others: Points) -> Iterator[pa.RecordBatch]:
        p = self.points
        for at in range(0, len(others.uid), BLOCK_ROWS):
            o = others.part(at, at + BLOCK_ROWS)
            i, j = linked(o, p, self.threshold)
            if not len(i):
                continue
            self.links += np.bincount(j, o.times[i], len(p.uid))
            hit, first = np.unique(i, return_index=True)
            self.label = unite(self.label, j, np.repeat(j[first], np.diff(np.append(first, len(i)))))
            yield _found(o.uid[hit], p.uid[j[first]], np.bincount(i, p.times[j], len(o.uid))[hit])

    def found(self) -> pa.RecordBatch:
        some = np.flatnonzero((self.links > 0) | (self.label != np.arange(len(self.label))))
        return _found(self.points.uid[some], self.points.uid[self.label[some]], self.links[some])


def _found(uid: np.ndarray, peer: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(uid), pa.array(peer), pa.array(links.astype(np.int64))], names=["uid", "peer", "links"])


def _join_batches(threshold: float):
    """Rows sorted by (cell, chunk, slice, side): side 0 is a chunk's points,
    side 1 what streams past it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, alone, chunk = None, [], False, None
        for b in batches:
            marks = np.stack([b.column(c).to_numpy().astype(np.int64) for c in ("cell", "chunk", "slice", "side")], 1)
            cuts = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(marks)], strict=True):
                if hi == lo:
                    continue
                now, side = tuple(marks[lo, :3]), marks[lo, 3]
                if now != key:
                    if parts:
                        chunk = Chunk(parts, alone, threshold)
                    if chunk:
                        yield chunk.found()
                    key, parts, alone, chunk = now, [], False, None
                rows = b.slice(lo, hi - lo)
                points = Points(rows.column("uid").to_numpy(), rows.column("times").to_numpy(), matrix(rows.column("embedding")))
                if side == 0:
                    parts.append(points)
                    alone = alone or rows.column("alone")[0].as_py()
                    continue
                if parts:
                    chunk, parts = Chunk(parts, alone, threshold), []
                if chunk:
                    yield from chunk.probe(points)
        if parts:
            chunk = Chunk(parts, alone, threshold)
        if chunk:
            yield chunk.found()

    return run


# ---- cells


def _cell_batches(pivots: dict[int, tuple[np.ndarray, np.ndarray]]):
    """Each point's cell (of its nearest pivot) and angle. A length without a
    pivot is one cell of unlimited radius."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in by_length(whole):
                x = matrix(b.column("embedding"))
                if x.shape[1] in pivots:
                    numbers, at = pivots[x.shape[1]]
                    cos = units(x) @ at.T
                    near = cos.argmax(axis=1)
                    cell, angle = numbers[near], np.arccos(np.clip(cos[np.arange(len(x)), near], -1, 1))
                else:
                    cell, angle = np.full(len(x), -x.shape[1]), np.full(len(x), math.pi)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int64)), pa.array(angle)], names=[*b.schema.names, "cell", "angle"])

    return run


def _target_batches(pivots: dict, radius: np.ndarray, threshold: float):
    """Higher cells that each point is copied to (``near``), and those that it is linked with whole (``whole``)."""
    reach, sine = math.acos(threshold), math.sqrt(1 - threshold * threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for every in batches:
            for b in by_length(every):
                x, cell = matrix(b.column("embedding")), b.column("cell").to_numpy()
                near, whole = np.zeros((len(x), 0), bool), np.zeros((len(x), 0), bool)
                numbers = np.zeros(0, np.int64)
                if x.shape[1] in pivots:
                    numbers, at = pivots[x.shape[1]]
                    cos = units(x) @ at.T
                    angle = np.arccos(np.clip(cos, -1, 1))
                    own = cell - numbers[0]
                    apart = np.sqrt(np.maximum(2 - 2 * (at @ at.T), 0))[own]
                    higher = (numbers[None, :] > cell[:, None]) & np.isfinite(radius[numbers])[None, :]
                    r = np.where(np.isfinite(radius[numbers]), radius[numbers], 0)[None, :]
                    beyond = cos[np.arange(len(x)), own][:, None] - cos > (sine + SLACK) * apart + SLACK
                    whole = higher & (angle + r <= reach - SLACK)
                    near = higher & ~whole & (angle - r <= reach + SLACK) & ~beyond
                lists = [
                    pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(m.sum(axis=1)))).astype(np.int32), numbers[np.nonzero(m)[1]])
                    for m in (near, whole)
                ]
                keep = [c for c in b.schema.names if c != "angle"]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *lists], names=[*keep, "near", "whole"])

    return run


def pivots_of(points: DataFrame, n: int, length: int, cell_rows: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Pivots by length of vector: their numbers and unit vectors. A sample by
    least hash, of bounded size."""
    most = min(MAX_PIVOTS, max(1, PIVOT_VALUES // max(length, 1)), math.ceil(n / cell_rows))
    sample = points.select("embedding").orderBy(F.xxhash64("embedding")).limit(most).collect()
    found: dict[int, list] = {}
    for r in sample:
        found.setdefault(len(r["embedding"]), []).append(r["embedding"])
    out, at = {}, 0
    for size, rows in sorted(found.items()):
        out[size] = (np.arange(at, at + len(rows)), units(np.array(rows, np.float64)))
        at += len(rows)
    return out


# ---- the join in Spark


def usable(v: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(v, finite) & F.exists(v, lambda x: x != 0), F.lit(False))


def range_join(points: DataFrame, threshold: float = THRESHOLD, cell_rows: int = CELL_ROWS, chunk_rows: int = CHUNK_ROWS, probe_rows: int = PROBE_ROWS) -> tuple[DataFrame, DataFrame]:
    """(uid, links) and edges (a, b) of a written table of points (uid, times,
    embedding) with unique ``uid``: the other rows linked with each point (its
    own copies not counted), and edges that connect each class."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be over 0 and at most 1")
    size = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("length")).first()
    length = size["length"] or 1
    at_once = max(64, min(10_000, ARROW_VALUES // length))
    chunk_rows = max(64, min(chunk_rows, CHUNK_VALUES // length))
    pivots = pivots_of(points, size["n"], length, cell_rows)
    kind = points.schema["embedding"].dataType.simpleString()
    fields = f"uid long, times long, embedding {kind}, cell long"
    placed = shared(points.select("uid", "times", "embedding").mapInArrow(_cell_batches(pivots), f"{fields}, angle double"), "placed", at_once)
    stats = shared(
        placed.groupBy("cell").agg(
            F.count(F.lit(1)).alias("points"), F.sum("times").alias("weight"), F.max("angle").alias("radius"), F.min("uid").alias("first")
        ),
        "cells",
    )
    radius = np.full(sum(len(n) for n, _ in pivots.values()), np.inf)
    for r in stats.filter("cell >= 0").select("cell", "radius").collect():  # as many as pivots
        radius[r["cell"]] = r["radius"]
    dealt = shared(
        placed.mapInArrow(_target_batches(pivots, radius, threshold), f"{fields}, near array<long>, whole array<long>"), "dealt", at_once
    )
    # how each cell is cut
    tight = 2 * F.col("radius") <= math.acos(threshold) - SLACK
    coming = dealt.select(F.explode("near").alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("coming"))
    cut = lambda n, size: F.greatest(F.lit(1), F.ceil(n / size)).cast("int")
    plan = (
        stats.join(coming, "cell", "left").withColumn("tight", tight)
        .withColumn("chunks", cut(F.col("points"), chunk_rows))
        .withColumn("own", F.when(~F.col("tight") & (F.col("chunks") > 1), F.col("points")).otherwise(0))
        .select("cell", "tight", "chunks", cut(F.coalesce("coming", F.lit(0)) + F.col("own"), probe_rows).alias("slices"))
    )
    plan = shared(plan, "cuts")
    tasks = plan.agg(F.sum(F.col("chunks").cast("long") * F.col("slices")).alias("n")).first()["n"] or 1
    chunk_of = F.pmod(F.xxhash64("uid"), F.col("chunks")).cast("int")
    slice_of = F.pmod(F.xxhash64("uid", F.lit(1)), F.col("slices")).cast("int")
    upto = lambda lo, n: F.when(lo < n, F.sequence(lo, n - 1)).otherwise(F.array().cast("array<int>"))
    zero, point = F.lit(0), ["uid", "times", "embedding"]
    here = dealt.select(*point, "cell").join(small(plan), "cell").withColumn("chunk", chunk_of)
    there = dealt.select(*point, F.explode("near").alias("cell")).join(small(plan), "cell")
    no = F.lit(False).alias("alone")
    meet = (
        here.select("*", F.explode(upto(zero, F.col("slices"))).alias("slice"))
        .select("cell", "chunk", "slice", zero.alias("side"), (~F.col("tight") & (F.col("slice") == 0)).alias("alone"), *point)
        .unionByName(
            here.filter(~F.col("tight")).select("cell", F.explode(upto(F.col("chunk") + 1, F.col("chunks"))).alias("chunk"), slice_of.alias("slice"), F.lit(1).alias("side"), no, *point)
        )
        .unionByName(there.select("cell", F.explode(upto(zero, F.col("chunks"))).alias("chunk"), slice_of.alias("slice"), F.lit(1).alias("side"), no, *point))
    )
    found = shared(
        meet.repartition(min(2 * tasks, 20_000), "cell", "chunk", "slice")
        .sortWithinPartitions("cell", "chunk", "slice", "side")
        .mapInArrow(_join_batches(threshold), "uid long, peer long, links long"),
        "met", at_once,
    )
    # what needed no comparison
    whole = dealt.select("uid", "times", F.explode("whole").alias("cell"))
    about = small(stats.select("cell", "weight", "first", tight.alias("tight")))
    out = whole.join(about, "cell").select("uid", F.col("first").alias("peer"), F.col("weight").alias("links"))
    back = whole.groupBy("cell").agg(F.sum("times").alias("extra"))
    inner = (
        dealt.select("uid", "times", "cell").join(small(shared(about.join(back, "cell", "left"), "whole-cells")), "cell")
        .filter(F.col("tight") | F.col("extra").isNotNull())
        .select("uid", F.col("first").alias("peer"), (F.coalesce("extra", F.lit(0)) + F.when(F.col("tight"), F.col("weight") - F.col("times")).otherwise(0)).alias("links"))
    )
    every = shared(found.unionByName(out).unionByName(inner), "range-links")
    return every.groupBy("uid").agg(F.sum("links").alias("links")), every.filter("uid <> peer").select(F.col("uid").alias("a"), F.col("peer").alias("b")).distinct()


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, **sizes: int) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per vector. ``sizes``: see ``range_join``."""
    rows = vectors.select("vec_id", "embedding")
    if rows.schema["embedding"].dataType.elementType.simpleString() not in ("float", "double"):
        rows = rows.withColumn("embedding", F.col("embedding").cast("array<double>"))
    equal = rows.filter(usable(F.col("embedding"))).groupBy("embedding").agg(F.count(F.lit(1)).alias("times"), F.min("vec_id").alias("rep"))
    points = shared(equal.withColumn("uid", F.monotonically_increasing_id()), "points")
    links, edges = range_join(points, threshold, **sizes)
    labels = classes(shared(edges, "range-edges")).withColumnRenamed("node", "uid")
    ids = points.select("uid", "times", "rep", "embedding").join(labels, "uid", "left").withColumn("label", F.coalesce("label", "uid"))
    least = ids.groupBy("label").agg(F.min("rep").alias("least"))
    named = shared(
        ids.join(least, "label").join(links, "uid", "left")
        .select("embedding", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), "least"),
        "named",
    )
    valued = small(named.withColumnRenamed("embedding", "_same"), BROADCAST_VECTORS)
    joined = rows.join(valued, F.col("embedding") == F.col("_same"), "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def keep_one(vectors: DataFrame, threshold: float = THRESHOLD, **sizes: int) -> DataFrame:
    """The rows, their columns in place, without those whose component is named by another vector."""
    gone = shared(near_duplicates(vectors, threshold, **sizes).filter("NOT kept").select(F.col("vec_id").alias("gone_id")).distinct(), "gone-vectors")
    away = small(gone)
    return vectors.join(away, vectors["vec_id"] == gone["gone_id"], "left_anti")
