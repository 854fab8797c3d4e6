import brute
import pytest
from conftest import PROSE, TEXTS, rows

from panelforge.llm import decontaminate

ITEMS = [
    (1, PROSE), (2, "two words"), (3, None), (4, "..."), (None, "a b c d e f g h a b"), (2, "two words"), (10, PROSE.upper() + " today"),
    (5, "word0 thing0 word1 thing1 word2 thing2 word3 thing3 word4 thing4 word5"), (6, "ONE"),
]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(*x, "z") for x in ITEMS], "item_id long, text string, hash string")


def test_report(docs, items):
    got = rows(decontaminate.report(docs, items))
    want = sorted(brute.contamination(TEXTS, ITEMS), key=lambda r: tuple((v is None, str(type(v)), v) for v in r))
    assert got == want


def test_shuffled_join_gives_the_same(docs, items, monkeypatch):
    want = rows(decontaminate.report(docs, items))
    monkeypatch.setattr(decontaminate, "small", lambda df, limit=0: df)
    assert rows(decontaminate.report(docs, items)) == want


def test_drop(docs, items):
    left = decontaminate.drop_contaminated(docs, items)
    clean = [r[0] for r, x in zip(TEXTS, brute.contamination(TEXTS, ITEMS), strict=True) if not x[5]]
    assert left.columns == docs.columns
    assert [r[0] for r in rows(left, "doc_id")] == sorted(clean, key=lambda k: (k is None, k))


def test_empty_tables(docs, no_docs, items):
    assert decontaminate.report(no_docs, items).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.report(docs, items.limit(0)).collect())
    assert decontaminate.drop_contaminated(docs, items.limit(0)).count() == len(TEXTS)


def test_no_words_in_what_is_joined_for_each_window(docs, items, monkeypatch):
    monkeypatch.setattr(decontaminate, "small", lambda df, limit=0: df)
    windows = decontaminate.shared(decontaminate.item_windows(items), "windows")
    plan = decontaminate.probed(docs, windows)._jdf.queryExecution().optimizedPlan().toString()
    join, above_scan = plan.split("Generate")[0], plan.split("Generate")[1]
    assert "Join Inner, (h#" in join and "AND" not in join.split("Join Inner")[1].split("\n")[0]
    assert " w#" not in above_scan.split("\n")[0] and "text#" not in above_scan.split("\n")[0]


@pytest.mark.parametrize("n", [1, 2, 3, 8, 10, 13])
def test_windows_of_any_length(docs, items, n):
    got = rows(decontaminate.report(docs, items, n))
    want = sorted(brute.contamination(TEXTS, ITEMS, n), key=lambda r: tuple((v is None, str(type(v)), v) for v in r))
    assert got == want


def test_equal_hashes_of_other_words_are_no_hits(docs, items, monkeypatch):
    want = rows(decontaminate.report(docs, items))
    real = decontaminate.hashed_windows
    one = decontaminate.F.lit(1).cast("long")
    monkeypatch.setattr(
        decontaminate, "hashed_windows", lambda w, ls, n: decontaminate.F.transform(real(w, ls, n), lambda x: x.withField("h", one))
    )
    short = docs.filter("length(text) < 1000 OR text IS NULL")
    ids = {r[0] for r in rows(short, "doc_id")}
    assert rows(decontaminate.report(short, items)) == [r for r in want if r[0] in ids]
