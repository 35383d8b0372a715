"""op2: every capture beside the right one would show; times of any ordered type; every
revisit is resolved and written whole."""

import datetime as dt

from pyspark.sql import functions as F

from starwright.llm import queries, revisits

RECORDS = ("id long, url string, captured_at timestamp, status int, etag string, "
           "last_modified string, headers map<string,string>, body string")


def test_competing_captures_decide_the_rows(spark, tmp_dir, monkeypatch):
    pages = [(i, u, f"<p>{i}</p>" * (i + 1)) for i, u in enumerate(
        ["http://a.org/x", "https://www.a.org/x/", "b.org?utm_s=1", " A.org/x#y ", "", "m.c.org "])]
    spark.createDataFrame(pages + [(9, None, "n")], "page_id long, url string, html string") \
        .coalesce(1).write.parquet(f"{tmp_dir}/pages.parquet")

    def rows():
        return {r.page_id: (r.response_id, r.resolved, r.body_chars)
                for r in queries.op2_revisits(spark, tmp_dir).collect()}

    want = {2 * i + 1: (2 * i, i % 3 != 0, len(h) if i % 3 else None) for i, _, h in pages}
    assert rows() == want
    # without the grouping by canonical URL the capture of another URL is taken
    same = revisits.canonical_url
    monkeypatch.setattr(revisits, "canonical_url", lambda url: F.when(same(url).isNotNull(), "u"))
    assert rows() != want


def test_times_are_timestamps_and_header_names_have_no_case(spark):
    day = [dt.datetime(2024, 1, d) for d in range(1, 5)]
    records = spark.createDataFrame([
        (1, "a.org", day[0], 200, "e", None, {"ETag": "e", "Server": "s"}, "one"),
        (2, "a.org", day[2], 200, "f", None, {"ETag": "f"}, "two"),
        (3, "a.org", day[1], 304, "e", None, {"etag": "e3"}, None),
        (4, "a.org", day[2], 304, "e", None, {}, None),       # not the one of its own time
        (5, "a.org", day[3], 304, "e", None, {}, None)], RECORDS)
    got = {r.id: (r.response_id, r.resolved, r.headers, r.body)
           for r in revisits.resolve_revisits(records, "id").collect()}
    assert got == {3: (1, True, {"Server": "s", "etag": "e3"}, "one"),
                   4: (1, True, {"ETag": "e", "Server": "s"}, "one"), 5: (2, False, None, None)}


def test_the_query_writes_every_revisit_whole(spark, tmp_dir, monkeypatch):
    pages = [(i, u, f"<p>\u00e9{i}</p>") for i, u in enumerate(["a.org/x", "a.org/x", "b.org", None])]
    spark.createDataFrame(pages, "page_id long, url string, html string") \
        .coalesce(1).write.parquet(f"{tmp_dir}/pages.parquet")
    tables, write = [], queries.written
    monkeypatch.setattr(queries, "written", lambda *a: tables.append(write(*a)) or tables[-1])
    rows = {r.page_id: r.body_chars for r in queries.op2_revisits(spark, tmp_dir).collect()}
    assert rows == {1: None, 3: 9, 5: 9}
    (table,) = tables
    got = {r.page_id: (r.response_id, r.headers, r.body) for r in table.collect()}
    tag = [r[0] for r in spark.createDataFrame(pages, "i long, u string, html string")
           .orderBy("i").select(F.md5(F.col("html").cast("binary"))).collect()]
    stored = {"Content-Type": "text/html", "Content-Length": "10"}
    assert got == {
        1: (0, None, None), 7: (None, None, None),  # a changed page, one without a URL
        3: (2, stored | {"ETag": tag[1], "date": "3", "last-modified": "1"}, pages[1][2]),
        5: (4, stored | {"etag": tag[2], "date": "5", "last-modified": "2"}, pages[2][2])}
    # the rows show a merge that takes every header of the 304
    monkeypatch.setattr(revisits, "PERMITTED", (*revisits.PERMITTED, "content-length"))
    assert {r.body_chars for r in queries.op2_revisits(spark, tmp_dir).collect()} == {None}


def test_captures_without_a_url_are_dealt_out(spark):
    records = spark.range(100).selectExpr(
        "id", "if(id < 0, 'a', null) url", "timestamp'2024-01-01' captured_at",
        "if(id % 2 = 0, 200, 304) status", "'e' etag", "cast(null as string) last_modified",
        "map('a', 'b') headers", "'x' body")
    made = revisits.resolve_revisits(records, "id")
    (dealt,) = [x for x in made._jdf.queryExecution().executedPlan().toString().splitlines()
                if "Exchange hashpartitioning" in x]
    assert dealt.count("#") == 2  # by the URL and, without one, the id
    assert [tuple(r[2:]) for r in made.collect()] == [(None, False, None, None)] * 50
