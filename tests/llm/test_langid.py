import itertools

import numpy as np
import pytest
from conftest import TEXTS

from panelforge.llm import langid


def test_held_out_accuracy(spark):
    from panelforge.llm.queries import op1_language_id

    sf = "/root/testdata/sf0.01"
    lang = dict(tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect())
    got = op1_language_id(spark, sf).collect()
    assert len(got) == len(lang)
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert all(0 <= r["score"] <= 1 for r in got)
    out = [r["lang_pred"] == lang[r["doc_id"]] for r in got if r["held_out"]]
    assert np.mean(out) > 0.99


def kernel(a, b, orders):
    """Shared distinct n-grams, by the definition."""
    clean = lambda t: "".join(c.lower() if c.isalpha() else " " for c in t)
    grams = lambda t: {t[i : i + n] for n in range(1, orders + 1) for i in range(len(t) - n + 1)} - {" " * n for n in range(1, orders + 1)}
    return len(grams(clean(a)) & grams(clean(b)))


def test_presence_gives_the_kernel():
    texts = ["The cat sat.", "Der Hund, der Hund!", "le chat à côté", "", "x", "日本語"]
    codes, _ = langid.code_points(texts)
    keys = np.unique(np.concatenate([langid.gram_keys(codes, n) for n in (1, 2, 3)]))
    index = langid.GramIndex(np.array([k for k in keys if {(k >> s) & 0x1FFFFF for s in (0, 21, 42)} - {0, 32}]))
    p, letter = langid.presence(texts, index, 3)
    got = p @ p.T
    for i, j in itertools.product(range(len(texts)), repeat=2):
        assert got[i, j] == kernel(texts[i], texts[j], 3)
    assert list(letter) == [True, True, True, False, True, True]


def test_edge_rows(spark, docs, no_docs):
    got = langid.identify(docs, docs).collect()
    assert len(got) == len(TEXTS)
    blank = {t for _, t in TEXTS if not t or not any(c.isalpha() for c in t)}
    for r, _ in zip(got, TEXTS, strict=True):
        assert 0 <= r["score"] <= 1
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    for k, t in TEXTS:
        if k is not None:
            assert by_id[k]["lang_pred"] == ("und" if t in blank else "en")
    assert langid.report(no_docs).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs, no_docs).collect()} == {"und"}


def test_sample_is_bounded(spark):
    df = spark.range(1000).selectExpr("id AS doc_id", "concat('t', id) AS text", "if(id % 10 = 0, 'b', 'a') AS lang")
    sample = langid.training_sample(df, 30)
    assert sorted({lang: sum(x == lang for _, x in sample) for _, lang in sample}.items()) == [("a", 30), ("b", 30)]


def test_long_text_in_pieces(monkeypatch):
    rows = [("the cat and the dog " * 3, "en"), ("der hund und die katze " * 3, "de"), ("the house is old", "en"), ("das haus ist alt", "de")]
    model = langid.Model(*langid.fit(rows))
    text = "the dog and the old house " * 50
    want = model.predict([text, "das", ""])
    monkeypatch.setattr(langid, "CHARS", 17)
    got = model.predict([text, "das", ""])
    assert got[0] == want[0] == ["en", "de", "und"] and np.allclose(got[1], want[1])


@pytest.mark.parametrize("n", [1, 5, 5000])
def test_index_of_grams(n):
    keys = np.unique(np.random.default_rng(n).integers(1, 2**62, n))
    index = langid.GramIndex(keys)
    asked = np.concatenate((keys, keys + 1))
    where, number = index.find(asked)
    known = set(keys.tolist())
    assert sorted(where) == [i for i, k in enumerate(asked.tolist()) if k in known]
    assert (index.keys[number] == asked[where]).all()


def test_sample_is_of_least_hash(spark, monkeypatch):
    from pyspark.sql import functions as F

    df = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"), F.when(F.col("id") % 50 == 0, "fr").otherwise("en").alias("lang")
    )
    order = [(r["lang"], r["doc_id"]) for r in df.orderBy(F.xxhash64("doc_id")).select("lang", "doc_id").collect()]
    want = sorted((k, d) for k in ("en", "fr") for d in [d for lang, d in order if lang == k][:100])
    for bits in (1, 8, langid.SLICE_BITS):
        monkeypatch.setattr(langid, "SLICE_BITS", bits)
        assert langid.training_sample(df, 100) == [(f"t{d}", k) for k, d in want]


def test_sample_takes_one_row_of_a_repeated_id(spark):
    table = [(1, f"text {i:02d}", "en") for i in range(50)] + [(1, "texte", "fr"), (2, "other", "en")]
    df = spark.createDataFrame(table, "doc_id long, text string, lang string")
    assert langid.training_sample(df) == [("text 00", "en"), ("other", "en"), ("texte", "fr")]
