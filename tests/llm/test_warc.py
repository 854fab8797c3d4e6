import re

import brute
import pytest
from conftest import rows

from panelforge.llm import warc

FAKE = warc.MAGIC + "WARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
PAGES = [(i, f"http://x/{i}", f"<p>{i} é</p>" * (i % 20)) for i in range(3, 90)] + [
    (300, "u", FAKE), (301, "u", FAKE * 3), (302, "u", "x" + warc.MAGIC), (303, "u", FAKE), (304, "u", None), (305, "u", ""),
    (306, "u", FAKE * 500 + "ü"), (307, "u", warc.MAGIC * 1000), (308, "u y\r\nX: 1", "\r\n\r\n"), (309, None, "z" * 100_000),
    (None, "u", "no id"), (310, "u", "\r\n\r\n" + FAKE), (300, "u", FAKE), (2, "u", "<p>7 é</p>" * 7), (311, "u", FAKE[:-4]),
    (312, "u", "WARC/1.1\r"), (313, "u", FAKE.replace("3", "9000")), (None, "u", FAKE), (314, "u", "日本語\x00\U0001f600"),
]


def in_order(pages):
    want = brute.archive_rows([(k, html) for k, _, html in pages])
    return sorted(want, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


@pytest.mark.parametrize("split", ["128m", "9000"])
def test_round_trip_over_splits(spark, split):
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        df = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id long, url string, html string, bytes int").repartition(2)
        assert rows(warc.round_trip(df)) == in_order(PAGES)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_small_payloads_are_no_revisits(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc" * 9), (4, "u", "abc" * 9)], "page_id long, url string, html string")
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.round_trip(df, min_bytes=10).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_broken_archive_is_an_error(spark, tmp_path):
    good = "WARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    (tmp_path / "a").mkdir()
    (tmp_path / "a/x.warc").write_bytes((warc.MAGIC + good + warc.MAGIC + good[:-6]).encode())
    with pytest.raises(Exception, match="broken record chain"):
        warc.read_archives(spark, str(tmp_path / "a")).collect()


def test_archive_is_plain_warc(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://x/", "hé"), (2, "http://y/", "hé")], "page_id long, url string, html string").coalesce(1)
    warc.write_archives(df, str(tmp_path / "w"))
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "w").glob("part-*")))
    at, types = 0, []
    while at < len(data):
        assert data[at:].startswith(b"WARC/1.1\r\n")
        head = data[at : data.index(b"\r\n\r\n", at)]
        fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        types.append(fields[b"WARC-Type"])
        assert re.fullmatch(rb"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", fields[b"WARC-Date"])
        assert (b"WARC-Profile" in fields) == (types[-1] == b"revisit")
        at += len(head) + 4 + int(fields[b"Content-Length"]) + 4
    assert at == len(data) and sorted(types) == [b"response", b"revisit"]
