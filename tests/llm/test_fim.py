import brute
import pytest
from conftest import TEXTS, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelforge.llm import fim
from panelforge.llm.queries import op11_fill_in_middle

MORE = [(1000 + i, t) for i, t in enumerate(["a <P> b", "x<S>", "<M>", "a<", "<P", "S>end < S> <", "  lead and trail \n", "<<", "P> S> M>"] * 12)]


def order(found):
    return sorted(found, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


def test_results_and_round_trip(spark):
    table = TEXTS + MORE
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    want = []
    for k, t in table:
        n, form, p, m, out = brute.fill_in_middle(k, t)
        want.append((k, n, form, p, m, brute.sha(out), brute.sha(t or "")))
    assert rows(fim.report(df)) == order(want)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


@settings(max_examples=300, deadline=None)
@given(st.integers(), st.lists(st.sampled_from(["<P>", "<S>", "<M>", "<", "P>", "S>", " ", "\n\n", "\x0b", "\xa0", "é", "日本", "word", "\U0001f600"]), max_size=14).map("".join))
def test_any_text(doc_id, text):
    assert fim.rearranged(doc_id, text) == brute.fill_in_middle(doc_id, text)


def test_columns_pass_and_empty_table(docs, no_docs):
    out = fim.transform(docs.withColumn("fim", F.lit("old")).withColumn("output", F.lit("mine")))
    assert [c for c in out.columns if c != "fim"] == [*docs.columns, "output"]
    assert out.filter("output <> 'mine' OR w <> 'other'").count() == 0
    assert out.filter(~F.coalesce("text", F.lit("")).eqNullSafe(fim.restore(F.col("fim.output"), F.col("fim.form")))).count() == 0
    assert fim.report(no_docs).count() == 0


@pytest.mark.parametrize("unit", ["a ", " ", "word", "\t\tab\n"])
def test_very_long_texts(unit):
    text = unit * (2_000_000 // len(unit))
    assert fim.rearranged(6, text) == brute.fill_in_middle(6, text)


def test_query_on_the_whole_table(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = op11_fill_in_middle(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        n, form, p, m, out = brute.fill_in_middle(r["doc_id"], texts[r["doc_id"]])
        assert tuple(r) == (r["doc_id"], n, form, p, m, brute.sha(out), brute.sha(texts[r["doc_id"]]))


def test_text_is_cut_once_per_row(spark, sf):
    plan = op11_fill_in_middle(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan
