"""Quality rules: fixed text rules, then a hashed n-gram log-likelihood ratio.

Words and pairs of neighbouring words are hashed into ``buckets`` cells.
Two multinomials over the cells are counted: one over trusted documents (those
labelled as good), one over all documents of the input. A document's score is the mean over its n-grams of
``ln(p_trusted / p_raw)``, both smoothed by adding ``alpha`` to each cell.
Documents with a score under a limit are rejected; there is no random draw,
the same input always gives the same verdicts.

The limit comes from the data, by one rule for any number of labels: the
trusted documents are dealt into ``PARTS`` parts (by hash of their id), each is
scored by a ratio that leaves its own part out, and the limit is the highest
multiple of 1 / ``GRID`` under which at most ``MISSED_SHARE`` of those that
pass the fixed rules score. If none of them passes (no labels, say) the ratio
says nothing and rejects nothing. A caller may give a ``threshold`` instead.

Only DataFrame functions; the corpus is read three times (count, score of the
trusted documents, score). It is shuffled, on ``doc_id``, only if there are
too many good labels for a broadcast; the counting pass sends at most
``buckets`` rows per task.

Defined results: a null or empty text has no words, so its counts are 0, its
score is 0 and it fails the rules (fewer than 20 words). Rows are judged one
by one: repeated rows get equal verdicts, and any further columns, whatever
their names, stay out of the way (the operator works on ``text`` and
``doc_id`` alone). An empty table gives an empty result. Without trusted rows
the ratio is that of a uniform cell distribution to the raw one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, shared, small, unused, upto, words

SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

BUCKETS = 10_000
ALPHA = 1.0
#: Parts of the trusted documents, each scored by a ratio without it.
PARTS = 5
#: Share of the trusted documents that the limit may reject, and its steps in a unit of score.
MISSED_SHARE = 0.005
GRID = 10_000


def repeated_words(w: Column, window: int = WINDOW) -> Column:
    """Words covered by windows of ``window`` words that occur at least twice
    in the array. 64-bit hashes tell whether any window can repeat; only then
    are the windows themselves compared."""
    starts = upto(F.size(w) - (window - 1))
    hashed = let(
        F.transform(w, lambda x: F.xxhash64(x)),
        lambda h: F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)])),
    )
    may_repeat = let(hashed, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    ordered = F.array_sort(
        F.transform(
            starts, lambda i: F.struct(F.array_join(F.slice(w, i + 1, F.lit(window)), " ").alias("g"), i.alias("p"))
        )
    )
    # a window repeats if its neighbour in text order of the windows is equal
    repeating = let(
        ordered,
        lambda s: F.array_sort(
            F.transform(
                F.filter(
                    s,
                    lambda x, k: (x["g"] == F.coalesce(F.get(s, k - 1)["g"], F.lit("")))
                    | (x["g"] == F.coalesce(F.get(s, k + 1)["g"], F.lit(""))),
                ),
                lambda x: x["p"],
            )
        ),
    )
    covered = let(
        repeating,
        lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1) - x, F.lit(window)))),
            F.lit(0),
            lambda a, x: a + x,
        ),
    )
    return F.when(may_repeat, covered).otherwise(F.lit(0)).cast("long")


def rule_columns(text: Column, w: Column) -> list[Column]:
    """The counts that the fixed rules use; ``w`` is the array of words of ``text``."""
    body = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return [
        F.size(w).cast("long").alias("n_words"),
        F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.char_length(x)).alias("word_chars"),
        (F.char_length(body) - F.char_length(F.regexp_replace(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(w).alias("n_repeat_words"),
    ]


def cells(w: Column, buckets: int) -> Column:
    """Cell numbers of the words and of the pairs of neighbouring words."""
    return let(
        F.transform(w, lambda x: F.xxhash64(x)),
        lambda h: F.concat(
            F.transform(h, lambda x: F.pmod(x, F.lit(buckets)).cast("int")),
            F.transform(
                upto(F.size(h) - 1),
                lambda i: F.pmod(F.xxhash64(F.get(h, i), F.get(h, i + 1)), F.lit(buckets)).cast("int"),
            ),
        ),
    )


def trusted_ids(labels: DataFrame, limit: int | None = None) -> DataFrame:
    """The ids of rows labelled as good; with a ``limit`` at most so many
    (those with the smallest hashes)."""
    ids = (
        labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").alias("trusted_id"))
        .distinct()
    )
    return ids if limit is None else ids.orderBy(F.xxhash64("trusted_id"), "trusted_id").limit(limit)


def part_of(trusted_id: Column) -> Column:
    return F.pmod(F.xxhash64(trusted_id, F.lit("held")), F.lit(PARTS)).cast("int")


def log_ratios(
    docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, alpha: float = ALPHA
) -> DataFrame:
    """One row with ``ratios``: ln(p_trusted / p_raw) of each cell, in order,
    and ``without``: for each part the same without its trusted documents.

    ``trusted`` should be a written table (its rows are counted for the join).
    """
    spark = docs.sparkSession
    parts = range(PARTS)
    counts = (
        docs.join(small(trusted), F.col("doc_id") == F.col("trusted_id"), "left")
        .select(
            F.when(F.col("trusted_id").isNotNull(), part_of(F.col("trusted_id"))).alias("part"),
            F.explode(cells(words(F.col("text")), buckets)).alias("cell"),
        )
        .groupBy("cell")
        .agg(F.count(F.lit(1)).alias("r"), *[F.count(F.when(F.col("part") == p, 1)).alias(f"t{p}") for p in parts])
    )
    number = lambda c: F.coalesce(c, F.lit(0))
    every = (
        spark.range(buckets)
        .select(F.col("id").cast("int").alias("cell"))
        .join(counts, "cell", "left")
        .select("cell", number("r").alias("r"), *[number(f"t{p}").alias(f"t{p}") for p in parts])
    )
    # ``buckets`` rows, a parameter: one small array
    gathered = every.agg(
        F.array_sort(F.collect_list(F.struct("cell", "r", *[f"t{p}" for p in parts]))).alias("c"),
        F.sum("r").alias("sr"),
        *[F.sum(f"t{p}").alias(f"s{p}") for p in parts],
    )

    def ratio(used: list[int]) -> Column:
        total = sum((F.col(f"s{p}") for p in used), F.lit(0))
        return F.transform(
            "c",
            lambda x: F.log((sum((x[f"t{p}"] for p in used), F.lit(0)) + alpha) / (total + alpha * buckets))
            - F.log((x["r"] + alpha) / (F.col("sr") + alpha * buckets)),
        )

    return gathered.select(
        ratio([*parts]).alias("ratios"), F.array(*[ratio([p for p in parts if p != out]) for out in parts]).alias("without")
    )


def measured(text: Column, model: Column, buckets: int) -> Column:
    """Struct of the rule counts, ``base_failed`` and ``score``; ``model``: the ratios."""

    def mean_ratio(w: Column) -> Column:
        return let(
            cells(w, buckets),
            lambda c: F.when(
                F.size(c) > 0,
                let(model, lambda m: F.aggregate(c, F.lit(0.0), lambda a, x: a + F.get(m, x))) / F.size(c),
            ).otherwise(F.lit(0.0)),
        )

    counted = let(words(text), lambda w: F.struct(*rule_columns(text, w), mean_ratio(w).alias("score")))
    failed = lambda v: (v["n_words"] < MIN_WORDS) | (
        F.lit(100) * v["n_repeat_words"] > F.lit(MAX_REPEAT_PERCENT) * v["n_words"]
    )
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return let(
        counted,
        lambda v: F.struct(*[v[n].alias(n) for n in names], failed(v).alias("base_failed"), v["score"].alias("score")),
    )


def limit_from(docs: DataFrame, trusted: DataFrame, ratios: DataFrame, buckets: int) -> float | None:
    """The limit that at most ``MISSED_SHARE`` of the trusted documents miss,
    each scored without its part; None if none of them passes the rules."""
    known = docs.join(small(trusted), F.col("doc_id") == F.col("trusted_id"))
    # No filter on what is measured: it would be moved below the join, to all documents.
    step = let(
        measured(F.col("text"), F.get(F.col("without"), part_of(F.col("trusted_id"))), buckets),
        lambda v: F.when(~v["base_failed"], F.floor(v["score"] * GRID)),
    )
    # as many rows as the scores have steps, whatever the number of documents
    steps = known.withColumn("without", ratios.select("without").scalar()).groupBy(step.alias("step")).count()
    found = sorted((r["step"], r["count"]) for r in steps.collect() if r["step"] is not None)
    most, below = MISSED_SHARE * sum(n for _, n in found), 0
    for step, n in found:
        below += n
        if below > most:
            return step / GRID
    return None


def judge(
    docs: DataFrame,
    labels: DataFrame,
    buckets: int = BUCKETS,
    alpha: float = ALPHA,
    threshold: float | None = None,
    trusted_rows: int | None = None,
    name: str = "verdict",
) -> DataFrame:
    """The input's rows with the column ``name``: a struct of the rule counts,
    ``base_failed``, ``score`` and ``kept``. It is new or replaces one of that
    name. Without a ``threshold`` the limit is set from the data."""
    texts = docs.select("doc_id", "text")
    trusted = shared(trusted_ids(labels, trusted_rows), "trusted")
    ratios = shared(log_ratios(texts, trusted, buckets, alpha), "ratios")
    if threshold is None:
        threshold = limit_from(texts, trusted, ratios, buckets)
    limit = float("-inf") if threshold is None else threshold
    model = unused("_ratios", docs)
    verdict = let(
        measured(F.col("text"), F.col(model), buckets),
        lambda v: v.withField("kept", ~v["base_failed"] & (v["score"] >= F.lit(limit))),
    )
    return docs.withColumn(model, ratios.select("ratios").scalar()).withColumn(name, verdict).drop(model)


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that are kept, as they are."""
    name = unused("_judged", docs)
    judged = judge(docs, labels, name=name, **options)
    return judged.filter(F.col(f"{name}.kept")).drop(name)
