import brute
import pytest
from conftest import PROSE, TEXTS, rows

from panelforge.llm import quality

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def limit_of(texts, trusted, doc_id, buckets):
    part = lambda k: brute.part_of(doc_id(k), quality.PARTS)
    return brute.quality_limit(texts, trusted, part, quality.PARTS, quality.MISSED_SHARE, quality.GRID, buckets, quality.ALPHA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(6, 1, 0), (8, 1, 0), (10, 0, 1), (None, 1, 0), (6, 1, 0), (99, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")


def test_counts_and_scores(docs, labels):
    got = quality.judge(docs, labels, buckets=512).select("doc_id", "text", "verdict.*").collect()
    assert len(got) == len(TEXTS)
    # ids are not unique here, so the counts go by place
    by_place = dict(enumerate(t for _, t in TEXTS))
    trusted = {i for i, (k, _) in enumerate(TEXTS) if k in (6, 8)}
    want = brute.quality_scores(by_place, trusted, 512, 1.0)
    score = {t: want[i] for i, t in by_place.items()}
    limit = limit_of(by_place, trusted, lambda i: TEXTS[i][0], 512)
    for r in got:
        b = brute.quality_counts(r["text"])
        assert {k: r[k] for k in NAMES} == b
        assert r["score"] == pytest.approx(score[r["text"]], abs=1e-9)
        assert r["kept"] == (not b["base_failed"] and score[r["text"]] >= limit)


def test_no_rows_and_no_labels(docs, no_docs, labels):
    assert quality.judge(no_docs, labels).count() == 0
    unlabelled = quality.judge(docs, labels.limit(0)).select("verdict.*").collect()
    assert len(unlabelled) == len(TEXTS)
    assert all(r["kept"] != r["base_failed"] for r in unlabelled)  # nothing is known of good ones


def test_kept_documents_keep_their_columns(docs, labels):
    kept = quality.keep_good(docs, labels, threshold=-100.0)
    assert kept.columns == docs.columns
    want = [(k, t) for k, t in TEXTS if not brute.quality_counts(t)["base_failed"]]
    assert len(rows(kept, "doc_id", "text")) == len(want)
    clashing = docs.withColumnsRenamed({"w": "_ratios", "x": "_judged", "fp": "without"})
    kept = quality.keep_good(clashing, labels, threshold=-100.0)
    assert kept.columns == clashing.columns
    assert {tuple(r) for r in kept.select("_ratios", "_judged", "without").collect()} == {("other",) * 3}


def test_trusted_sample_is_bounded(spark):
    labels = spark.range(100).selectExpr("id AS doc_id", "1 AS quality")
    assert quality.trusted_ids(labels, 7).count() == 7


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_brute_force(spark, sf):
    from panelforge.llm.queries import op8_quality

    texts = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    good = {r[0] for r in spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1").select("doc_id").collect()}
    score = brute.quality_scores(texts, good, quality.BUCKETS, quality.ALPHA)
    limit = limit_of(texts, good & texts.keys(), lambda k: k, quality.BUCKETS)
    for r in op8_quality(spark, sf).collect():
        b = brute.quality_counts(texts[r["doc_id"]])
        assert {k: r[k] for k in NAMES} == b
        assert r["kept"] == (not b["base_failed"] and score[r["doc_id"]] >= limit)


def test_good_documents_stay_and_bad_ones_go(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.judge(docs, labels).join(labels, "doc_id").filter("NOT verdict.base_failed").select("quality", "verdict.kept").collect()
    good = [r["kept"] for r in judged if r["quality"] == 1]
    bad = [r["kept"] for r in judged if r["quality"] == 0]
    assert all(good)
    assert sum(bad) < 0.5 * len(bad)


def test_limit_from_the_data_rejects_bad_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.judge(docs, labels).join(labels, "doc_id").filter("NOT verdict.base_failed").select("quality", "verdict.kept").collect()
    good = [r["kept"] for r in judged if r["quality"] == 1]
    bad = [r["kept"] for r in judged if r["quality"] == 0]
    assert sum(bad) <= 0.02 * len(bad)
    assert sum(good) >= 0.99 * len(good)


def test_all_good_labels_are_trusted(spark):
    labels = spark.range(30_000).selectExpr("id AS doc_id", "1 AS quality")
    assert quality.trusted_ids(labels).count() == 30_000
    docs = spark.createDataFrame([(i, PROSE) for i in (5, 29_999)], "doc_id long, text string")
    many = quality.judge(docs, labels, threshold=0.0).select("doc_id", "verdict.score").collect()
    assert {r["score"] for r in many} == {0.0}  # both are trusted, so the ratios are even
