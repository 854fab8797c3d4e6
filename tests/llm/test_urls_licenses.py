from datetime import date
from pathlib import Path

import pytest
from conftest import TEXTS, rows

from panelforge.llm import licenses, urlfilter

D = lambda n: date(2024, 1, n)
LONG_HOST = "a." * 100_000 + "long"
EVENTS = [
    ("a", "example.com", "add", "block", D(5)), ("a", "example.com", "remove", "block", D(10)), ("a", "example.com", "add", "block", D(20)),
    ("b", "good.Example.com", "add", "allow", D(7)), ("b", "example.com", "add", "allow", D(8)), ("b", "example.com", "remove", None, D(9)),
    ("c", "one.test", "add", "block", D(3)), ("c", "one.test", "remove", None, D(3)), ("c", "two.test", "add", "block", D(1)),
    ("c", "two.test", "add", "allow", D(4)), (None, "x.test", "add", "block", D(1)), ("d", None, "add", "block", D(1)), ("d", "y.test", "add", "block", None),
    ("d", "localhost", "add", "block", D(1)), ("d", "10.0.0.1", "add", "block", D(1)),
    ("e", "2.3", "add", "block", D(1)), ("e", "::1]", "add", "block", D(1)), ("e", "good.example.com", "add", None, D(1)),
    ("f", "two.test", "add", None, D(2)), (LONG_HOST[2:], LONG_HOST[-5:], "add", "block", D(1)),
]
CAPTURES = [
    (1, "http://example.com/", D(4)), (2, "http://example.com/", D(5)), (3, "https://www.Example.COM.:8080/x?y#z", D(9)),
    (4, "http://example.com", D(10)), (5, "http://u:p@deep.good.example.com/", D(25)), (6, "http://example.com/", D(8)),
    (7, "http://one.test/", D(3)), (8, "http://two.test/", D(3)), (9, "http://two.test/", D(4)), (10, None, D(4)), (11, "no url", D(4)),
    (12, "http://two.test/", None), (13, "http://x.test/", D(9)), (14, "http://notexample.com/", D(6)), (15, "http://localhost/", D(2)),
    (16, "http://10.0.0.1:80/", D(2)), (2, "http://example.com/", D(5)), (17, "http:///path", D(5)), (18, "http://com/", D(5)), (19, "http://[::1]:8/", D(5)),
    (20, "http://10.1.2.3/", D(5)), (21, f"http://{LONG_HOST}/", D(5)), (22, "http://" + "x" * 1_000_000, D(5)),
    (23, "http://example.com" + "." * 100_000, D(5)), (24, f"http://{'a.' * 120}example.com/", D(5)), (25, "http://a..example.com/", D(5)),
]


def brute_verdict(url, day):
    import re

    m = re.match(urlfilter.HOST, url or "")
    host = m[1].lower().rstrip(".") if m else ""
    if len(host) > 253:
        host = ""
    if not host or day is None:
        return host, "none", None, None, None
    parts = host.split(".")
    names = [".".join(parts[i:]) for i in range(max(len(parts) - 1, 1))]
    if re.fullmatch(r"[0-9.]+|\[.*", host):
        names = [host]
    logs = {}
    for lst, pattern, event, verdict, on in EVENTS:
        if None not in (lst, pattern, event, on) and (event, verdict) != ("add", None):
            logs.setdefault((lst, pattern.lower()), []).append((on, event, verdict))
    best = []
    for (lst, pattern), log in logs.items():
        past = [x for x in sorted(log, key=lambda x: x[:2]) if x[0] <= day]
        if pattern in names and past and past[-1][1] == "add":
            best.append((-len(pattern), past[-1][2], lst, pattern, past[-1][0]))
    if not best:
        return host, "none", None, None, None
    _, verdict, lst, pattern, since = min(best)
    return host, verdict, pattern, lst, since


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(EVENTS, "list string, pattern string, event string, verdict string, day date")


def test_as_of_verdicts(spark, events):
    extra = ["pattern", "of", "on", "best", "_of", "_best", "host", "verdict", "list"]
    df = spark.createDataFrame([(*c, *extra) for c in CAPTURES], "page_id long, url string, day date, " + ", ".join(f"{c} string" for c in extra))
    kept = urlfilter.evaluate(df, events).select("pattern", "of", "on", "best", "_of", "_best", "list").distinct().collect()
    assert [tuple(r) for r in kept] == [("pattern", "of", "on", "best", "_of", "_best", "list")]
    got = rows(urlfilter.evaluate(df, events), "page_id", "host", "verdict", "rule", "rule_list", "rule_from")
    want = [(k, *brute_verdict(u, d)) for k, u, d in CAPTURES]
    assert got == sorted(want, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))
    assert {r[2] for r in got} == {"none", "block", "allow"}


def test_empty_sides(spark, events):
    df = spark.createDataFrame(CAPTURES, "page_id long, url string, day date")
    assert urlfilter.evaluate(df.limit(0), events).count() == 0
    assert {r["verdict"] for r in urlfilter.evaluate(df, events.limit(0)).collect()} == {"none"}


def test_known_texts_have_an_anchor():
    import re

    assert all(re.search(licenses.ANCHOR, t) for _, t in licenses.KNOWN)


MIT = licenses.KNOWN[0][1]
LICENSED = [
    (1, MIT), (2, "The software\n" + MIT), (3, "Copyright (c) 2024 Someone. All rights reserved.\n\n" + MIT.upper()),
    (4, MIT.replace("sublicense", "sub-license").replace("\n\n", "\n \n").replace(" shall", "\n   shall")), (5, MIT[:-30]),
    (6, "Some prose here.\nReleased under the MIT Licence!\nMore prose."), (7, "Released under the MIT License. And more on the same line."),
    (8, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY 4.0.\nLicensed under CC BY 4.0."), (9, "© 2020 X\nlicensed under the apache license version 2.0"),
]


def test_licenses(spark):
    others = [(k and k + 100, t) for k, t in TEXTS]
    df = spark.createDataFrame(LICENSED + others, "doc_id long, text string")
    got = {r["doc_id"]: (r["license_id"], r["notices"], r["n_notices"]) for r in licenses.report(df).collect()}
    whole = {k: v[0] for k, v in got.items() if v[0]}
    assert whole == {1: "MIT", 3: "MIT", 4: "MIT", 9: "Apache-2.0"}
    assert got[6] == (None, "MIT", 1) and got[7] == (None, "", 0) and got[5] == (None, "", 0)
    assert got[8] == (None, "CC-BY-4.0,CC-BY-NC-4.0", 2)
    assert licenses.report(df).count() == len(LICENSED) + len(TEXTS)


def test_canonical_forms_agree(spark):
    texts = [t for _, t in LICENSED + TEXTS if t is not None] + ["(c) 1999 a\n(c) 2000 b\nx LICENCES, non-infringement v2.0 É"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in df.select("t", licenses.canonical(df["t"]).alias("c")).collect()]
    assert all(c == licenses.canonical_text(t) for t, c in got)


def test_scan_keeps_columns(docs, no_docs):
    named = licenses.scan(docs.selectExpr("*", "'w' AS _whole", "'u' AS _units")).select("_whole", "_units").distinct().collect()
    assert [tuple(r) for r in named] == [("w", "u")]
    out = licenses.scan(docs)
    assert out.columns == [*docs.columns, "license_id", "notices", "n_notices"]
    assert licenses.scan(no_docs).count() == 0


def test_complete_texts_are_found(spark):
    folder = Path(licenses.__file__).parent / "license_texts"
    texts = {f.stem: f.read_text() for f in folder.glob("*.txt")}
    bsd3 = texts["BSD-3-Clause"]
    texts["BSD-2-Clause"] = bsd3[: bsd3.index("3. Neither")] + bsd3[bsd3.index("THIS SOFTWARE") :]
    mit = MIT.split("\n\n", 1)[1]
    cases = [(k, "Copyright Jane Doe\n\n" + t) for k, t in texts.items()] + [
        ("MIT", "The MIT License\n\nCopyright Jane Doe\n\n" + mit), ("MIT", "Copyright 2020 Jane Doe\nCopyright John Roe\n\n" + mit),
        ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, X\nAll rights reserved.\n\n" + " ".join(bsd3.split())),
        ("Apache-2.0", texts["Apache-2.0"].split("END OF TERMS")[0]), ("MIT", mit.replace(" OR COPYRIGHT HOLDERS", " OR\nCOPYRIGHT HOLDERS")),
    ]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "doc_id long, text string")
    got = {r["doc_id"]: r["license_id"] for r in licenses.report(df).collect()}
    assert got == {i: name for i, (name, _) in enumerate(cases)}
    assert {"BSD-2-Clause", "Apache-2.0", "GPL-3.0-only", "GPL-2.0-only", "LGPL-2.1-only", "LGPL-3.0-only", "MPL-2.0", "Unlicense"} <= set(got.values())


def test_texts_of_a_caller_are_never_skipped(spark):
    texts = (("own-1", "Anyone may copy this freely."), ("own-2", "© 2020 X\n\nDo as you like."), ("own-3", "v2.0"))
    for given in (texts, texts[:2]):
        df = spark.createDataFrame([(n, t) for n, t in given], "doc_id string, text string")
        assert all(r["license_id"] == r["doc_id"] for r in licenses.scan(df, texts=given).collect())
