"""WARC: exact round trip, revisits, selected reads."""

import hashlib
import random

from aerolake.llm import warc
from aerolake.session import scratch_dir

PAGES = "page_id long, url string, html string, digest int, payload string"


def pages():
    big, other = "<p>é" + "x" * 1200, "y" * 999
    rows = [(i, f"http://a/{i}", big if i % 3 == 0 else f"page {i} " * (i % 400), 1, "z")
            for i in range(60)]
    rows += [(100, None, None, 1, "z"), (101, "u", "", 1, "z"), (102, "u\r\n: v%0A", other, 1, "z"),
             (103, "u", other, 1, "z"), (None, "u", big, 1, "z"), (104, "u", "\r\n\r\n" * 400, 1, "z"),
             (104, "u", "\r\n\r\n" * 400, 1, "z"), (7, "u", "\r\n\r\n" * 400, 1, "z"),
             (105, "u", "long " * 100_000, 1, "z")]
    return rows


def test_round_trip(spark):
    rows = pages()
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, PAGES)
    root = scratch_dir(spark, "test-warc")
    index = warc.write_archives(df.repartition(3), root)
    got = warc.read_archives(index, root).collect()
    assert len(got) == len(rows)
    last = {}
    for page, _, html, *_ in rows:
        if page is not None:
            last[html or ""] = max(page, last.get(html or "", -1))
    expected = []
    for page, url, html, *_ in rows:
        raw = (html or "").encode()
        revisit = len(raw) >= 1000 and page != last[html or ""]
        expected.append((page, url, len(raw), hashlib.sha1(raw).hexdigest(),
                         "revisit" if revisit else "response",
                         last[html or ""] if revisit else None, None if revisit else raw))
    found = [(*r[:6], None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))


def test_selected_reads(spark):
    df = spark.createDataFrame(pages(), PAGES)
    root = scratch_dir(spark, "test-warc")
    index = warc.write_archives(df, root)
    some = index.where("url like 'http://a/1%'")
    got = warc.read_archives(some, root).collect()
    assert {r.url for r in got} == {f"http://a/{i}" for i in [1, *range(10, 20)]}


def test_empty_table(spark):
    assert warc.archive_pages(spark.createDataFrame([], PAGES)).count() == 0
