"""Source divergence audit: how each source's terms differ from those of the other
sources of its language, summed over a frequent-pattern tree of term rows.

Terms are runs of letters and characters beyond ASCII (A-Z lower-cased). A
language keeps the terms that are in at least ``MIN_DOCS`` of its documents.
With ``c`` the occurrences of a kept term in a group (a language's source, or
the whole language), ``N`` their sum over the kept terms and ``V`` the number
of these, the group's share is ``p = 1 + floor(UNIT * (c + 1) / (N + V))``, and
the divergence of ``p`` from ``q`` is ``f(p, q) = floor((p - q)^2 / q)``. All
arithmetic is on whole numbers.

Pairs. The sum of ``f`` over all kept terms, for every two sources, is taken
apart, with ``0`` for a source in which a term does not occur:

    f(a, b) = f(0, 0) + [f(a, 0) - f(0, 0)] + [f(0, b) - f(0, 0)] + x(a, b)
    x(a, b) = f(a, b) - f(a, 0) - f(0, b) + f(0, 0)

The first part is the same for all V terms. The next two depend on one source:
terms with equal counts are added up first. ``x`` is needed only where a term
is in both sources. For that the term rows (nonzero counts, ordered by source)
go into a frequent-pattern tree: equal rows are one path with a multiplicity,
paths with the same beginning share its nodes, and a node's count is the
multiplicity of all paths through it. Each node corrects the pairs with its
ancestors, once, times its count. The rows are dealt by range of their paths
and sorted, so each task walks the tree of its range batch by batch with one
path open at a time, and it is no matter that neighbouring ranges or batches
may share a beginning: corrections add up.

Rows of documents go to Python as bytes; each task sends its counts per
(language, source, term). What is shuffled are such counts, term rows and pairs.

Defined results: null text, language or source are read as ''. Each row is a
document of its own, so repeated rows count again. A group without terms has
p = 1 + floor(UNIT / V) for each kept term; in a language without kept terms
every pair is 0. A source alone in its language has no pairs. Further columns
are ignored; an empty table gives an empty result. A term row holds at most
one entry for each source of a language.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared, small

MIN_DOCS = 3
UNIT = 1_000_000_000
TOP_TERMS = 200
#: Entries of a task's counts that are sent on together.
HELD_TERMS = 400_000
#: Node-ancestor combinations that are worked out together.
CHUNK = 200_000
#: Items of a path that it is dealt by.
HEAD = 6
#: Shares of a pair's group where the sources' table is too large to broadcast.
SALTS = 64

#: Bytes of UTF-8: letters lower-cased, all else of ASCII blank.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 0x20 if b < 0x80 and not 0x61 <= b <= 0x7A else b for b in range(256)
)


# ---- counts


def _held_counts(held: dict) -> pa.RecordBatch:
    langs, sources, terms, n, docs = [], [], [], [], []
    for (lang, source), (times, in_docs) in held.items():
        # a row without term says that the group occurs
        langs += [lang] * (len(times) + 1)
        sources += [source] * (len(times) + 1)
        terms += [None, *times]
        n += [0, *times.values()]
        docs += [0, *(in_docs[t] for t in times)]
    text = lambda v: pa.array(v, pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays(
        [text(langs), text(sources), text(terms), pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
        names=["lang", "source", "term", "n", "docs"],
    )


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple, tuple[Counter, Counter]] = {}
    size = 0
    for b in batches:
        columns = [b.column(c).cast(pa.binary()) for c in ("lang", "source", "text")]
        for at in range(0, b.num_rows, 256):
            for lang, source, text in zip(*(c.slice(at, 256).to_pylist() for c in columns), strict=True):
                times, in_docs = held.setdefault((lang or b"", source or b""), (Counter(), Counter()))
                was = len(times)
                terms = (text or b"").translate(_TERM_BYTES).split()
                times.update(terms)
                in_docs.update(set(terms))
                size += len(times) - was
            if size > HELD_TERMS:
                yield _held_counts(held)
                held, size = {}, 0
    if held:
        yield _held_counts(held)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in
    each group. A row with a null term, n = docs = 0, for each group."""
    parts = docs.select("lang", "source", "text").mapInArrow(
        _count_batches, "lang string, source string, term string, n long, docs long"
    )
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# ---- shares and divergences


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / (total + kept)); decimals, so no overflow."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.call_function("div", wide(n + 1) * F.lit(UNIT).cast("decimal(10,0)"), wide(total + kept)) + 1


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q). Shares are at most UNIT + 1, so squares fit."""
    return F.call_function("div", (p - q) * (p - q), q)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


# ---- the tree


def tree_nodes(paths: list[list], times: list[int]) -> tuple[list, list, list]:
    """Nodes below the first level of the tree over sorted ``paths``: (row,
    depth, count), by a path that passes through the node."""
    rows, depths, counts = [], [], []
    open_, first = [], []  # along the current path: count of each node, row it began in

    def close(depth: int) -> None:
        while len(open_) > depth:
            n, row = open_.pop(), first.pop()
            if open_:
                open_[-1] += n
                rows.append(row)
                depths.append(len(open_))
                counts.append(n)

    before: list = []
    for row, (path, n) in enumerate(zip(paths, times, strict=True)):
        common = 0
        for x, y in zip(before, path, strict=False):
            if x != y:
                break
            common += 1
        close(common)
        open_ += [0] * (len(path) - common)
        first += [row] * (len(path) - common)
        open_[-1] += n
        before = path
    close(0)
    return rows, depths, counts


def _tree_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of corrections (lang, s, t, hi, lo) of each task's tree; the sum is hi * 2**32 + lo."""
    for b in batches:
        langs = b.column("lang").to_pylist()
        path = b.column("path")
        off = path.offsets.to_numpy().astype(np.int64)
        item = path.values
        sid, n, p, z = (item.field(k).to_numpy(zero_copy_only=False) for k in ("sid", "n", "p", "z"))
        key = list(zip(sid.tolist(), n.tolist(), strict=True))
        times = b.column("times").to_pylist()
        at = 0
        while at < len(langs):
            stop = at
            while stop < len(langs) and langs[stop] == langs[at]:
                stop += 1
            rows, depths, counts = tree_nodes([key[off[i] : off[i + 1]] for i in range(at, stop)], times[at:stop])
            row, depth = np.array(rows, np.int64), np.array(depths, np.int64)
            count = np.array(counts, np.int64)
            ends = np.cumsum(depth)
            k = 0
            while k < len(row):
                base = ends[k - 1] if k else 0
                last = max(k + 1, int(np.searchsorted(ends, base + CHUNK, "right")))
                yield _corrections(langs[at], off[at + row[k:last]], depth[k:last], count[k:last], sid, p, z)
                k = last
            at = stop


def _corrections(lang, start, depth, count, sid, p, z) -> pa.RecordBatch:
    """One row for each (source, other source) of the nodes' ancestors."""
    node = np.repeat(np.arange(len(depth)), depth)
    up = np.arange(depth.sum()) - np.repeat(np.cumsum(depth) - depth, depth)
    i, j = start[node] + up, start[node] + depth[node]  # ancestor, node
    s = np.concatenate((sid[i], sid[j]))
    t = np.concatenate((sid[j], sid[i]))
    a, b, a0, b0 = (np.concatenate(x) for x in ((p[i], p[j]), (p[j], p[i]), (z[i], z[j]), (z[j], z[i])))
    x = _f(a, b) - _f(a, b0) - _f(a0, b) + _f(a0, b0)
    n = np.concatenate((count[node], count[node]))
    # |x| <= 4e18 and counts add up to less than 2**31 terms, so both halves fit
    hi, lo = (x >> 32) * n, (x & 0xFFFFFFFF) * n
    order = np.lexsort((t, s))
    s, t, hi, lo = s[order], t[order], hi[order], lo[order]
    new = np.flatnonzero(np.concatenate(([True], (s[1:] != s[:-1]) | (t[1:] != t[:-1]))))
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(new), pa.string()), pa.array(s[new]), pa.array(t[new]), pa.array(np.add.reduceat(hi, new)), pa.array(np.add.reduceat(lo, new))],
        names=["lang", "s", "t", "hi", "lo"],
    )


def tree_corrections(rows: DataFrame) -> DataFrame:
    """(lang, s, t, x): the sums of ``x`` over all terms in both sources.
    ``rows``: (lang, path) of each term, path an array of (sid, n, p, z)."""
    paths = rows.filter(F.size("path") > 1).groupBy("lang", "path").agg(F.count(F.lit(1)).alias("times"))
    # dealt by the first items, so that the sample for the ranges stays small, and a hash where many share them
    head = F.transform(F.slice("path", 1, HEAD), lambda x: F.struct(x["sid"], x["n"]))
    found = (
        paths.repartitionByRange("lang", head, F.xxhash64("path")).sortWithinPartitions("lang", "path")
        .mapInArrow(_tree_batches, "lang string, s long, t long, hi long, lo long")
    )
    wide = F.lit(2**32).cast("decimal(11,0)")
    return found.groupBy("lang", "s", "t").agg(
        (F.sum("hi").cast("decimal(20,0)") * wide + F.sum("lo").cast("decimal(20,0)")).cast("decimal(38,0)").alias("x")
    )


# ---- the audit


class Audit:
    """The tables of one audit, each written once.

    ``groups``: (lang, source, sid, total, kept, zero): numbered sources of
    each language, the occurrences of kept terms, their number, and the share
    of a term that does not occur (null where the language keeps none).
    ``rows``: (lang, term, n, total, path) of each kept term: occurrences in the
    language, those of all kept terms, and (sid, n, p, z) of the sources that
    have it, in their order.
    """

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS):
        counts = shared(term_counts(docs), "term-counts")
        named = counts.filter(F.col("term").isNull()).select("lang", "source")
        numbered = named.withColumn(
            "sid", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long")
        )
        sources = shared(numbered, "sources")
        c, g = counts.filter(F.col("term").isNotNull()).alias("c"), small(sources).alias("g")
        lists = (
            c.join(g, (F.col("c.lang") == F.col("g.lang")) & (F.col("c.source") == F.col("g.source")))
            .groupBy(F.col("c.lang").alias("lang"), "term")
            .agg(F.sum("docs").alias("docs"), F.array_sort(F.collect_list(F.struct("sid", "n"))).alias("path"))
        )
        kept = shared(lists.filter(F.col("docs") >= min_docs).select("lang", "term", "path"), "term-rows")
        each = kept.select("lang", F.explode("path").alias("x"))
        totals = each.groupBy("lang", F.col("x.sid").alias("sid")).agg(F.sum("x.n").alias("total"))
        langs = kept.groupBy("lang").agg(
            F.count(F.lit(1)).alias("kept"), F.sum(F.aggregate("path", F.lit(0).cast("long"), lambda a, x: a + x["n"])).alias("lang_total")
        )
        self.groups = shared(
            sources.join(totals, ["lang", "sid"], "left").join(langs, "lang", "left")
            .select("lang", "source", "sid", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("lang_total", F.lit(0)).alias("lang_total"))
            .withColumn("zero", F.when(F.col("kept") > 0, share(F.lit(0), F.col("total"), F.col("kept")))),
            "groups",
        )
        of = small(self.groups.select("lang", "sid", "total", "kept", "zero", "lang_total"))
        placed = kept.select("lang", "term", F.explode("path").alias("x")).select("lang", "term", "x.sid", "x.n").join(of, ["lang", "sid"])
        entry = F.struct("sid", "n", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"), F.col("zero").alias("z"))
        self.rows = shared(
            placed.groupBy("lang", "term").agg(
                F.sum("n").alias("n"),
                F.first("lang_total").alias("total"),
                F.first("kept").alias("kept"),
                F.array_sort(F.collect_list(entry)).alias("path"),
            ).withColumn("q", share(F.col("n"), F.col("total"), F.col("kept"))).drop("kept"),
            "shares",
        )

    def _pairs(self, left: DataFrame) -> DataFrame:
        """``left`` (with lang and s) beside every other source of its language."""
        other = self.groups.select("lang", F.col("sid").alias("t"), F.col("source").alias("item"), F.col("zero").alias("t_zero"))
        if self.groups.limit(10_001).count() > 10_000:  # too many to broadcast beside a hot language
            other = other.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            left = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)).cast("int"))
            return left.join(other, ["lang", "_salt"]).drop("_salt").filter(F.col("s") != F.col("t"))
        return left.join(F.broadcast(other), "lang").filter(F.col("s") != F.col("t"))

    def pairs(self) -> DataFrame:
        """(lang, source, item, value) for every source and every other one."""
        wide = lambda c: c.cast("decimal(20,0)")
        # terms that one source has with the same share are one row
        alone = (
            self.rows.select("lang", F.explode("path").alias("x")).groupBy("lang", F.col("x.sid").alias("s"), F.col("x.p").alias("p"), F.col("x.z").alias("z"))
            .agg(F.count(F.lit(1)).alias("times"))
        )
        both = self._pairs(alone)
        p, z, o = F.col("p"), F.col("z"), F.col("t_zero")
        rest = lambda d: wide(d) * wide(F.col("times"))
        single = both.groupBy("lang", "s", "t").agg(
            F.sum(rest(divergence(p, o) - divergence(z, o))).alias("forth"),
            F.sum(rest(divergence(o, p) - divergence(o, z))).alias("back"),
        )
        forth = single.select("lang", "s", "t", F.col("forth").cast("decimal(38,0)").alias("x"))
        back = single.select("lang", F.col("t").alias("s"), F.col("s").alias("t"), F.col("back").cast("decimal(38,0)").alias("x"))
        base = self._pairs(self.groups.select("lang", "source", F.col("sid").alias("s"), "zero", "kept"))
        start = base.select(
            "lang", "s", "t", "source", "item",
            F.coalesce(wide(divergence(F.col("zero"), F.col("t_zero"))) * wide(F.col("kept")), F.lit(0)).cast("decimal(38,0)").alias("x"),
        )
        none = F.lit(None).cast("string")
        parts = [d.withColumns({"source": none, "item": none}) for d in (forth, back, tree_corrections(self.rows))]
        every = start
        for d in parts:
            every = every.unionByName(d)
        return every.groupBy("lang", "s", "t").agg(
            F.max("source").alias("source"), F.max("item").alias("item"), F.sum("x").cast("long").alias("value")
        ).select("lang", "source", "item", "value")

    def terms(self) -> DataFrame:
        """(lang, source, item, value) of the kept terms that a source has more
        often than its language has."""
        x = F.col("x")
        each = self.rows.select("lang", "term", "q", F.explode("path").alias("x")).filter(x["p"] > F.col("q"))
        found = each.select("lang", x["sid"].alias("sid"), F.col("term").alias("item"), divergence(x["p"], F.col("q")).alias("value"))
        return found.join(small(self.groups.select("lang", "sid", "source")), ["lang", "sid"]).select("lang", "source", "item", "value")


def _ranked(df: DataFrame, part: str, top: int | None = None) -> DataFrame:
    """Ranks by value, then the bytes of the item."""
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = df.withColumn("rank", F.row_number().over(by))
    if top is not None:
        out = out.filter(F.col("rank") <= top)
    return out.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def report(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): every pair of sources of a
    language, and each source's ``top`` terms against its language."""
    audit = Audit(docs, min_docs)
    return _ranked(audit.pairs(), "pair").unionByName(_ranked(audit.terms(), "term", top))
