from pathlib import Path

import brute
import corpus_pipeline
import public_tokenizers
import pytest
from conftest import rows
from tokenizers import Tokenizer

from panelforge.llm import packing, quality
from panelforge.llm import secretscan as S


def expected(docs, trusted, items):
    """Ids and texts after the four filtering stages, in plain Python."""
    texts = dict(docs)
    score = brute.quality_scores(texts, trusted, quality.BUCKETS, quality.ALPHA)
    limit = brute.quality_limit(
        texts, trusted & texts.keys(), lambda k: brute.part_of(k, quality.PARTS), quality.PARTS, quality.MISSED_SHARE,
        quality.GRID, quality.BUCKETS, quality.ALPHA,
    )
    kept = {k: t for k, t in texts.items() if not brute.quality_counts(t)["base_failed"] and score[k] >= limit}
    ids = sorted(kept)
    label = brute.components(ids, [brute.simhash(kept[k]) for k in ids])
    kept = {k: kept[k] for k, c in zip(ids, label, strict=True) if k == c}
    hit = {r[0] for r in brute.contamination(list(kept.items()), items) if r[5]}
    out = {}
    for k, t in kept.items():
        if k not in hit:
            spans = brute.base_spans(t) + brute.entropy_spans(t, S.CLASSES, S.ALLOWED_PATTERNS, S.ALLOWED_TEXTS, S.WINDOW)
            out[k] = brute.redacted(t, spans) if spans else t
    return out


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_against_brute_force(spark, sf):
    read = lambda t: spark.read.parquet(f"{sf}/{t}.parquet")
    docs = [tuple(r) for r in read("documents").select("doc_id", "text").collect()]
    trusted = {r["doc_id"] for r in read("labels").filter("quality = 1").collect()}
    items = [tuple(r) for r in read("benchmark").select("item_id", "text").collect()]
    want = expected(docs, trusted, items)
    assert 0 < len(want) < len(docs)
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.glob("corpus-*"))
    packed = corpus_pipeline.run(spark, sf).collect()
    assert [p.name.split("-")[1] for p in set(folder.glob("corpus-*")) - before] == ["best_fit_packing"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = {}
    for r in packed:
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
    assert lengths == {k: len(library.encode(t, add_special_tokens=False).ids) + 1 for k, t in want.items()}
    assert {(r["doc_id"], r["piece"], r["start"]) for r in packed} == {
        (k, p, s) for k, n in lengths.items() for p, (s, _) in enumerate(packing.cut(n, packing.CAPACITY))
    }


def test_stages_keep_columns_and_take_any_rows(spark, docs, no_docs, sf):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for table in (docs, no_docs):
        d = table
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, d, sf)
            if name != names[-1]:
                assert out.columns == docs.columns
            n = len(rows(out, "doc_id"))
            assert n <= 10 * table.count()
            d = out
