"""Benchmark decontamination by a broadcast hash set of test n-grams.

Test items and documents are normalised alike (A-Z lower-cased, words are
runs of digits, a-z and characters beyond ASCII). Each item gives its
windows of ``n`` consecutive words; an item of fewer words is one window.
Every window of every document is hashed over all its words: hashes of 1, 2,
4, ... neighbouring words are built on each other, and two of them cover a
window. A broadcast join on that one number finds hashes of test windows;
then the words of documents with such a hash are fetched and a hit counts
only if all words of the window are equal. What is joined or shuffled for a
window is its hash and place, never its words or its document.

The set of hashes is broadcast when it has at most ``BROADCAST_HASHES``
rows; a larger one goes through a shuffled join.

Defined results: a null or empty text has no words and no hits. Rows of
equal ``doc_id`` and text are judged alike, each keeping its row; a null
``doc_id`` is an id like any other. A null or word-less item has no windows;
an item without id marks words, but isn't counted or named. Further columns
of either table are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, let, shared, small, upto, words

#: What stands between words of items and documents: ASCII but digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
#: So many hashes of test windows (16 bytes each and the table's own need) may be broadcast.
BROADCAST_HASHES = 2_000_000


def item_words(text: Column) -> Column:
    return words(ascii_lower(text), BETWEEN)


def hashed_windows(w: Column, lengths: Column, n: int) -> Column:
    """Array of (h, pos, ln): each window of ``w`` with one of the ``lengths``
    (an array of numbers from 1 to ``n``), hashed over all its words and its
    length."""

    def grown(levels: list[Column]) -> Column:
        span = 1 << (len(levels) - 1)
        if 2 * span <= n:
            last = levels[-1]
            pairs = F.transform(upto(F.size(last) - span), lambda i: F.xxhash64(F.get(last, i), F.get(last, i + span)))
            return let(pairs, lambda p: grown([*levels, p]))
        return F.flatten(F.transform(lengths, lambda ln: of_length(levels, ln)))

    def of_length(levels: list[Column], ln: Column) -> Column:
        # the widest hashes that fit: one from the window's start, one up to its end
        fitting = None
        for k, level in reversed(list(enumerate(levels))):
            wide = F.struct(level.alias("a"), (ln - (1 << k)).alias("gap"))
            fitting = F.when(ln >= 1 << k, wide) if fitting is None else fitting.when(ln >= 1 << k, wide)
        return let(
            fitting,
            lambda f: F.transform(
                upto(F.size(f["a"]) - f["gap"]),
                lambda i: F.struct(
                    F.xxhash64(F.get(f["a"], i), F.get(f["a"], i + f["gap"]), ln).alias("h"), i.alias("pos"), ln.alias("ln")
                ),
            ),
        )

    return let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: grown([h]))


def item_windows(items: DataFrame, n: int = WINDOW) -> DataFrame:
    """(hash, len, name, item_id): the distinct windows of the items; ``name``
    is the words, joined."""
    grams = let(
        item_words(F.col("text")),
        lambda w: F.when(F.size(w) == 0, F.array().cast("array<array<string>>"))
        .when(F.size(w) < n, F.array(w))
        .otherwise(F.transform(upto(F.size(w) - (n - 1)), lambda i: F.slice(w, i + 1, F.lit(n)))),
    )
    return (
        items.select("item_id", F.explode(grams).alias("gram"))
        .select(
            hashed_windows(F.col("gram"), F.array(F.size("gram")), n)[0]["h"].alias("hash"),
            F.size("gram").alias("len"),
            F.array_join("gram", " ").alias("name"),
            "item_id",
        )
        .distinct()
    )


def probed(docs: DataFrame, windows: DataFrame, n: int = WINDOW) -> DataFrame:
    """(doc_id, key, hash, pos, len) of the windows of ``docs`` with the hash
    of a test window. ``windows`` is a written table."""
    # window lengths that occur: n, and those of shorter items (n values at most)
    lengths = windows.agg(F.array_sort(F.collect_set("len")).alias("l")).scalar()
    known = small(windows.select("hash").distinct(), BROADCAST_HASHES)
    worded = docs.select(
        "doc_id", F.xxhash64("text").alias("key"), item_words(F.col("text")).alias("w"), lengths.alias("lengths")
    )
    scanned = worded.select("doc_id", "key", F.inline(hashed_windows(F.col("w"), F.col("lengths"), n)))
    return scanned.join(known, F.col("h") == F.col("hash")).select(
        "doc_id", "key", "hash", "pos", F.col("ln").alias("len")
    )


def document_hits(docs: DataFrame, windows: DataFrame, n: int = WINDOW) -> DataFrame:
    """(doc_id, key, pos, len, name) of every occurrence of a test window.
    ``key`` is a digest of the text, so that rows that share a ``doc_id`` but
    not the text stay apart. ``windows`` is a written table."""
    # an array is no longer than the document: a place for each word and length
    places = shared(
        probed(docs, windows, n)
        .groupBy(F.col("doc_id").alias("hit_id"), F.col("key").alias("hit_key"))
        .agg(F.collect_set(F.struct("hash", "pos", "len")).alias("places")),
        "places",
    )
    texts = docs.select("doc_id", F.xxhash64("text").alias("key"), "text").join(
        small(places.select("hit_id", "hit_key")),
        F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("key") == F.col("hit_key")),
        "left_semi",
    )
    # rows that repeat are looked at once
    words_of = texts.dropDuplicates(["doc_id", "key"]).select("doc_id", "key", item_words(F.col("text")).alias("w"))
    found = words_of.join(
        places, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("key") == F.col("hit_key"))
    ).select(
        "doc_id",
        "key",
        F.inline(
            let(
                F.col("w"),
                lambda w: F.transform(
                    "places",
                    lambda x: F.struct(
                        x["hash"].alias("h"), x["pos"].alias("pos"), x["len"].alias("len"),
                        F.array_join(F.slice(w, x["pos"] + 1, x["len"]), " ").alias("found"),
                    ),
                ),
            )
        ),
    )
    grams = windows.select("hash", "name").distinct()
    return found.join(small(grams), (F.col("h") == F.col("hash")) & (F.col("found") == F.col("name"))).select(
        "doc_id", "key", "pos", "len", "name"
    )


def covered(spans: Column) -> Column:
    """Words covered by a sorted array of (start, length)."""
    end = lambda s: s["pos"] + s["len"]
    return F.aggregate(
        spans,
        F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")),
        lambda a, s: F.struct(
            F.greatest(a["upto"], end(s)).alias("upto"),
            (a["n"] + F.greatest(F.lit(0), end(s) - F.greatest(a["upto"], s["pos"]))).alias("n"),
        ),
        lambda a: a["n"].cast("long"),
    )


def contamination(docs: DataFrame, items: DataFrame, n: int = WINDOW) -> DataFrame:
    """(doc_id, key, spans, n_hit, item_ids) of each document with a hit:
    ``spans`` the sorted (pos, len) of hits in words, ``n_hit`` the words they
    cover, ``item_ids`` the items with occurring windows, sorted as strings."""
    windows = shared(item_windows(items, n), "windows")
    hits = shared(document_hits(docs, windows, n), "hits")
    # a hit stands once per (document, place), however often its row repeats
    spans = (
        hits.groupBy("doc_id", "key")
        .agg(F.array_sort(F.collect_set(F.struct("pos", "len"))).alias("spans"))
        .withColumn("n_hit", covered(F.col("spans")))
    )
    named = windows.filter(F.col("item_id").isNotNull()).select(
        "name", F.col("item_id").cast("string").alias("item")
    )
    items_hit = (
        hits.select("doc_id", "key", "name").distinct()
        .join(small(named), "name")
        .groupBy("doc_id", "key")
        .agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
    )
    a, b = spans.alias("a"), items_hit.alias("b")
    return a.join(
        b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.key") == F.col("b.key")), "left"
    ).select("a.doc_id", "a.key", "spans", "n_hit", F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def report(docs: DataFrame, items: DataFrame, n: int = WINDOW) -> DataFrame:
    """One row per document: counts, digest of the items, verdict."""
    found = shared(contamination(docs, items, n).withColumnsRenamed({"doc_id": "hit_id", "key": "hit_key"}), "found")
    counted = docs.select(
        "doc_id",
        F.xxhash64("text").alias("key"),
        # letter case doesn't change the number of words
        F.size(words(F.col("text"), BETWEEN)).cast("long").alias("n_words"),
    )
    joined = counted.join(
        small(found),
        F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("key") == F.col("hit_key")),
        "left",
    )
    items_hit = F.coalesce("item_ids", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items_hit).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_hit, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, n: int = WINDOW) -> DataFrame:
    """The documents without any hit, as they are."""
    windows = shared(item_windows(items, n), "windows")
    hits = document_hits(docs, windows, n).select(F.col("doc_id").alias("hit_id"), F.col("key").alias("hit_key"))
    found = shared(hits.distinct(), "found")
    same = docs["doc_id"].eqNullSafe(found["hit_id"]) & (F.xxhash64(docs["text"]) == found["hit_key"])
    return docs.join(small(found), same, "left_anti")
