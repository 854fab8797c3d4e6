import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import TEXTS, rows
from tokenizers import Tokenizer

from panelforge.llm import packing, pretokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 0]


def check(packed, texts, library, capacity):
    by = {}
    for r in packed:
        by.setdefault(r["doc_id"], []).append(r)
    for k, text in texts:
        ids = ids_of(library, text)
        want = {(p, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())) for p, (s, n) in enumerate(packing.cut(len(ids), capacity))}
        assert want <= {(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in by[k]}
    assert sum(r["length"] for r in packed) == sum(len(ids_of(library, t)) for _, t in texts)
    seqs = {}
    for r in packed:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in seqs.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= capacity
    return len(seqs)


@pytest.mark.parametrize(("capacity", "shard_rows"), [(2048, 50_000), (50, 100)])
def test_round_trip(docs, library, capacity, shard_rows):
    packed = packing.pack(docs, PATH, capacity=capacity, shard_rows=shard_rows, keep_ids=True).collect()
    check(packed, TEXTS, library, capacity)
    for r in packed:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]


def test_cut():
    assert packing.cut(5, 5) == [(0, 5)]
    assert packing.cut(12, 5) == [(0, 2), (2, 5), (7, 5)]
    assert packing.cut(1, 5) == [(0, 1)]


def least_squares_place(sizes, capacity):
    """The rule by its definition: try each place, sum all squares."""
    gaps, out = [], []
    squares = lambda g: sum(sum(1 for x in g if x == v) ** 2 for v in set(g) if 0 < v < capacity)
    for s in sizes:
        tries = []
        for g in sorted({x for x in gaps if x >= s}):
            i = max(k for k, x in enumerate(gaps) if x == g)
            after = [*gaps[:i], g - s, *gaps[i + 1 :]]
            tries.append((squares(after), 0, g, after))
        tries.append((squares([*gaps, capacity - s]), 1, 0, [*gaps, capacity - s]))
        best = min(tries, key=lambda t: t[:3])
        gaps = best[3]
        out.append(best[1])
    return sum(out), sorted(g for g in gaps)


@pytest.mark.parametrize("seed", range(6))
def test_sum_of_squares_rule(seed):
    rnd = np.random.default_rng(seed)
    sizes = rnd.integers(1, 21, 120)
    seq = packing.place(sizes, 20)
    filled = np.bincount(seq, weights=sizes).astype(int)
    opened, gaps = least_squares_place(sizes.tolist(), 20)
    assert filled.max() <= 20
    assert len(filled) == opened
    assert sorted(20 - filled) == gaps


def test_query_is_tight(spark, library):
    from panelforge.llm.queries import op2_packing

    sf = "/root/testdata/sf0.01"
    texts = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    packed = op2_packing(spark, sf).collect()
    n = check(packed, texts, library, 2048)
    assert n <= 1.02 * -(-sum(r["length"] for r in packed) // 2048)


def test_shards_and_second_round(spark, library):
    texts = [(i, "lorem ipsum dolor " * (i % 37)) for i in range(600)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    n = check(packing.pack(df, PATH, capacity=200, shard_rows=50).collect(), texts, library, 200)
    total = sum(len(ids_of(library, t)) for _, t in texts)
    assert n <= 1.1 * total / 200


def test_empty_table(no_docs):
    assert packing.pack(no_docs, PATH).count() == 0


def test_plain_characters_split_as_the_library_does(library):
    chars = [chr(c) for c in itertools.chain(range(0x250), range(0x2010, 0x2028), [0x20AC]) if c != 0x130]
    texts = [f"a{c}a 1{c} {c}{c}'s\n{c} '{c} {c}'ll" for c in chars]
    assert not any(pretokens.ODD.search(t) for t in texts)
    e = packing.Encoder(PATH)
    got = e.encode(texts)
    for t, g in zip(texts, got, strict=True):
        assert list(np.frombuffer(g, "<u4")) == ids_of(library, t)[:-1], repr(t)


def test_rows_keep_extra_columns_out(docs):
    assert "w" not in packing.pack(docs, PATH).columns
    assert len(rows(packing.pack(docs, PATH).filter("doc_id IS NULL"))) == 2
