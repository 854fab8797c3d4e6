"""SimHash near-duplicates by a hierarchical index in Gray order.

A document's fingerprint has a bit set if it is set in over half of the
XXH64 hashes (seed 42) of its shingles. Fingerprints that differ in at most
``distance`` bits are linked; documents of linked fingerprints form classes.

Search: two fingerprints within ``distance`` bits agree on one of
``distance + 1`` equal blocks of bits, so each is dealt to one group for each
block (its value). A group of more than ``group_rows`` fingerprints is dealt
once more by blocks of the bits left, and what is still larger is cut into
chunks whose pairs are groups of their own: every group is bounded and no
pair is lost. Inside a group the fingerprints are sorted by Gray rank, so
that neighbours share bits, and a tree is built over them: each node holds
the bits that all its members share (mask and pattern). Pairs of nodes are
followed from the top, adding up the bits in which the patterns differ; over
``distance``, the pair of whole groups is dropped. Links become one edge from
each fingerprint to the first of its class inside the group, so a class of m
members sends about m rows, not its pairs. Classes across groups are joined
by passing on least labels with pointer jumping.

Defined results: a null, empty or blank text has fingerprint 0, linked like
any other; repeated rows each get their row; a null ``doc_id`` never names a
class (a class of such rows has a null name); further columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, let, shared, small, unused, upto, words

SHINGLE = 3
DISTANCE = 3
BITS = 64
#: Most fingerprints that are compared in one group.
GROUP_ROWS = 4096
#: Texts whose hashes go to a Python worker at once.
ARROW_ROWS = 2000
#: Children of a node of the index.
FAN = 8
#: Hashes, or pairs of nodes, that are looked at together in memory.
CHUNK = 200_000


# ---- fingerprints


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """XXH64 (seed 42) of each shingle; fewer words than ``size`` make one."""
    return let(
        words(ascii_lower(text)),
        lambda w: F.when(F.size(w) == 0, F.array().cast("array<long>"))
        .when(F.size(w) < size, F.array(F.xxhash64(F.array_join(w, " "))))
        .otherwise(
            F.transform(
                upto(F.size(w) - (size - 1)),
                lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(w, i + k) for k in range(size)])),
            )
        ),
    )


def majority(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per document (``ends``: where its hashes end) the bits set in over half."""
    starts = np.concatenate(([0], ends[:-1]))
    ones = np.zeros((len(ends), BITS), np.int64)
    raw = np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)
    for at in range(0, len(hashes), CHUNK):
        stop = min(at + CHUNK, len(hashes))
        bits = np.unpackbits(raw[at:stop], axis=1, bitorder="little")
        first, last = np.searchsorted(ends, at, "right"), np.searchsorted(starts, stop, "left")
        rows = np.arange(first, last)
        rows = rows[ends[rows] > starts[rows]]
        cuts = np.maximum(starts[rows], at) - at
        ones[rows] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    set_bits = 2 * ones > (ends - starts)[:, None]
    return np.packbits(set_bits, axis=1, bitorder="little").view(np.int64).ravel()


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, 1024):
            part = b.slice(k, 1024)
            lists = part.column("hashes")
            offsets = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
            fp = majority(values, (offsets[1:] - offsets[0]).astype(np.int64))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fp)], names=["doc_id", "fp"])
    pa.default_memory_pool().release_unused()  # the worker stays for other stages


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): one row per document, without a shuffle."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    hashed = docs.select("doc_id", shingle_hashes(F.col("text"), size).alias("hashes"))
    return hashed.mapInArrow(_fingerprint_batches, f"doc_id {kind}, fp long")


# ---- the index inside a task


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Place of each code in Gray order."""
    x = fp.view(np.uint64).copy()
    for k in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(k)
    return x


def _nodes(fp: np.ndarray, bounds: np.ndarray) -> list[dict]:
    """Levels of the index over sorted codes, leaves first; ``bounds``: where
    groups begin (and the end). The last level has one node for each group."""
    codes = fp.view(np.uint64)
    levels = [{"all": codes, "any": codes, "bounds": bounds}]
    while (np.diff(levels[-1]["bounds"]) > 1).any():
        low = levels[-1]
        sizes = np.diff(low["bounds"])
        parents = -(-sizes // FAN)
        top = np.concatenate(([0], np.cumsum(parents)))
        nth = np.arange(top[-1]) - np.repeat(top[:-1], parents)
        first = np.repeat(low["bounds"][:-1], parents) + nth * FAN
        last = np.minimum(first + FAN, np.repeat(low["bounds"][1:], parents))
        levels.append(
            {
                "all": np.bitwise_and.reduceat(low["all"], first),
                "any": np.bitwise_or.reduceat(low["any"], first),
                "bounds": top,
                "first": first,
                "n": last - first,
            }
        )
    for lv in levels:  # bits that all members share, and their values
        lv["mask"] = ~(lv["all"] ^ lv["any"])
        lv["pattern"] = lv["all"] & lv["mask"]
    return levels


def index_links(fp: np.ndarray, bounds: np.ndarray, distance: int = DISTANCE) -> Iterator[tuple]:
    """Pairs (i, j), i < j, of places in the same group whose codes differ in
    at most ``distance`` bits, in pieces."""
    levels = _nodes(fp, bounds)
    top = len(levels) - 1
    roots = np.arange(len(levels[top]["bounds"]) - 1)
    if top == 0:
        return
    todo = [(top, roots[k : k + CHUNK // 8], roots[k : k + CHUNK // 8]) for k in range(0, len(roots), CHUNK // 8)]
    while todo:
        k, a, b = todo.pop()
        high, low = levels[k], levels[k - 1]
        na, nb = high["n"][a], high["n"][b]
        pairs = na * nb
        at = np.repeat(np.arange(len(a)), pairs)
        nth = np.arange(pairs.sum()) - np.repeat(np.cumsum(pairs) - pairs, pairs)
        x, y = high["first"][a][at] + nth // nb[at], high["first"][b][at] + nth % nb[at]
        keep = (x < y) if k == 1 else (x <= y)
        x, y = x[keep], y[keep]
        shared_bits = low["mask"][x] & low["mask"][y]
        differ = np.bitwise_count((low["pattern"][x] ^ low["pattern"][y]) & shared_bits)
        near = differ <= distance  # the others are dropped as whole groups
        x, y = x[near], y[near]
        if k == 1:
            yield x, y
        else:
            step = CHUNK // (FAN * FAN)
            todo += [(k - 1, x[s : s + step], y[s : s + step]) for s in range(0, len(x), step)]


def least_labels(n: int, links: Iterator[tuple]) -> np.ndarray:
    """For 0..n-1 the least member of each one's class."""
    label = np.arange(n)
    for x, y in links:
        while len(x):
            lx, ly = label[x], label[y]
            m = np.minimum(lx, ly)
            np.minimum.at(label, lx, m)
            np.minimum.at(label, ly, m)
            while (label[label] != label).any():
                label = label[label]
            open_ = label[x] != label[y]
            x, y = x[open_], y[open_]
    return label


def _group_edges(key: np.ndarray, fp: np.ndarray, distance: int) -> pa.RecordBatch:
    """Edges (fp, root) of rows sorted by group key; all groups are whole."""
    order = np.lexsort((gray_rank(fp), key))
    key, fp = key[order], fp[order]
    bounds = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)])) if len(key) else np.array([0])
    label = least_labels(len(fp), index_links(fp, bounds, distance)) if len(fp) else np.arange(0)
    child = np.flatnonzero(label != np.arange(len(fp)))
    return pa.RecordBatch.from_arrays([pa.array(fp[child]), pa.array(fp[label[child]])], names=["a", "b"])


def _edge_batches(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.empty(0, np.int64), np.empty(0, np.int64)
        for b in batches:
            key = np.concatenate((key, b.column("key").to_numpy()))
            fp = np.concatenate((fp, b.column("fp").to_numpy()))
            if len(key) and key[-1] != key[0]:
                cut = np.searchsorted(key, key[-1], "left")  # the last group may go on
                yield _group_edges(key[:cut], fp[:cut], distance)
                key, fp = key[cut:], fp[cut:]
        if len(key):
            yield _group_edges(key, fp, distance)

    return run


# ---- groups, edges and classes in Spark


def _bits(fp: Column, low: int, n: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << n) - 1))


def candidate_groups(fps: DataFrame, distance: int = DISTANCE, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(key, fp): groups of at most about ``2 * group_rows`` fingerprints, such
    that any two within ``distance`` bits are together in one."""
    parts = distance + 1
    width = BITS // parts
    if width * parts != BITS:
        raise ValueError("distance + 1 must divide 64")

    def blocks(df: DataFrame) -> DataFrame:
        return df.select(
            "fp",
            F.explode(F.array(*[F.struct(F.lit(b).alias("b"), _bits(F.col("fp"), b * width, width).alias("v")) for b in range(parts)])).alias("x"),
        ).select("fp", "x.b", "x.v")

    first = blocks(fps)
    count = shared(first.groupBy("b", "v").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > group_rows), "large")
    if count.isEmpty():
        return first.select(F.xxhash64("b", "v").alias("key"), "fp")
    few = first.join(small(count), ["b", "v"], "left_anti").select(F.xxhash64("b", "v").alias("key"), "fp")
    # the bits outside block b, rotated to the bottom, in ``parts`` blocks again
    rest = BITS - width
    many = first.join(small(count.select("b", "v")), ["b", "v"], "left_semi")
    turned = F.lit(None).cast("long")
    for b in range(parts):
        move = ((b + 1) * width) % BITS
        c = F.col("fp")
        t = c if move == 0 else F.shiftrightunsigned(c, move).bitwiseOR(F.shiftleft(c, BITS - move))
        turned = F.when(F.col("b") == b, t).otherwise(turned)
    cuts = [rest * k // parts for k in range(parts + 1)]
    second = many.select("b", "v", "fp", turned.alias("t")).select(
        "b", "v", "fp",
        F.explode(F.array(*[F.struct(F.lit(k).alias("b2"), _bits(F.col("t"), cuts[k], cuts[k + 1] - cuts[k]).alias("v2")) for k in range(parts)])).alias("x"),
    ).select("fp", "b", "v", "x.b2", "x.v2")
    by = ["b", "v", "b2", "v2"]
    sizes = shared(second.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > group_rows), "larger")
    mid = second.join(small(sizes), by, "left_anti").select(F.xxhash64(*by).alias("key"), "fp")
    # still larger: chunks by a hash, and a group for each two chunks
    chunks = second.join(small(sizes), by).select(
        *by, "fp", F.ceil(F.col("n") / group_rows).cast("int").alias("s")
    ).withColumn("c", F.pmod(F.xxhash64("fp"), F.col("s")).cast("int"))
    pairs = chunks.select(
        *by, "fp", "c", F.explode(F.sequence(F.lit(0), F.col("s") - 1)).alias("o")
    ).select(F.xxhash64(*by, F.least("c", "o"), F.greatest("c", "o")).alias("key"), "fp")
    return few.unionByName(mid).unionByName(pairs)


def linked_edges(fps: DataFrame, distance: int = DISTANCE, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(a, b): a fingerprint and the first of its class inside a group."""
    groups = candidate_groups(fps, distance, group_rows)
    # keys that meet by hash only add pairs that are then compared and dropped
    return (
        groups.repartition("key").sortWithinPartitions("key").mapInArrow(_edge_batches(distance), "a long, b long").distinct()
    )


def classes(edges: DataFrame, name: str = "labels") -> DataFrame:
    """(node, label): label the least node of the class, for nodes with edges.

    Each round takes the least label among neighbours, then the label's own
    label; it ends when a round changes nothing.
    """
    both = shared(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = shared(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")), name)
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("l")), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("l").alias("l"))
        )
        least = labels.join(near, "node").select("node", F.least("label", "l").alias("label"), F.col("label").alias("was"))
        least = shared(least, name)
        up = least.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = shared(
            least.join(up, "label").select("node", F.least("label", "next").alias("label"), "was"), name
        )
        if after.filter(F.col("label") != F.col("was")).isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """(doc_id, fp, component_id): one row per document; ``component_id`` is
    the least doc_id of all documents reachable over links."""
    marks = shared(fingerprints(docs, size), "fingerprints", arrow_rows=ARROW_ROWS)
    distinct = shared(marks.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct")
    edges = shared(linked_edges(distinct.select("fp"), distance, group_rows), "links")
    labels = classes(edges).withColumnRenamed("node", "fp")
    named = distinct.join(labels, "fp")
    least = named.groupBy("label").agg(F.min("rep").alias("least"))
    linked = named.join(least, "label").select("fp", "least")
    ids = distinct.join(linked, "fp", "left").select(F.col("fp").alias("of"), F.coalesce("least", "rep").alias("component_id"))
    ids = shared(ids, "classes")
    return marks.join(ids, F.col("fp") == F.col("of")).select("doc_id", "fp", "component_id")


def report(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    return near_duplicates(docs, size, distance).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The documents with the least doc_id of their class, once each. If
    doc_ids repeat, documents are told apart by a digest of the text too, and
    of rows equal in both the least one stays. A row without doc_id can't be
    named, so it stays."""
    id_, named, gone_id = F.col("doc_id"), unused("_at", docs), unused("_gone", docs)
    at = F.col(named)
    unique = docs.filter(id_.isNotNull()).groupBy("doc_id").count().filter("count > 1").isEmpty()
    name = id_ if unique else F.when(id_.isNotNull(), F.struct(id_, F.xxhash64("text").alias("key")))
    found = near_duplicates(docs.select(name.alias("doc_id"), "text"), size, distance)
    gone = shared(
        found.filter(id_ != F.col("component_id")).select(id_.alias(gone_id)).distinct(), "gone"
    )
    kept = docs.withColumn(named, name).join(small(gone), at == F.col(gone_id), "left_anti")
    if unique:
        return kept.drop(named)
    least = kept.filter(at.isNotNull()).groupBy(named).agg(F.min(F.struct(*docs.columns)).alias(gone_id))
    return least.select(f"{gone_id}.*").unionByName(kept.filter(at.isNull()).drop(named))
