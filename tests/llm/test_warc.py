import random

import pytest
from pyspark.sql import functions as F

from subsight.llm.warc import canonical_url, header_text, resolve_revisits

SCHEMA = "record_id bigint, url string, at bigint, kind string, status int, headers map<string,string>, payload string"


@pytest.mark.parametrize(
    "url, want",
    [
        ("HTTP://User@WWW.Example.org:80/a/b/?utm_source=x&b=2&a=1#top", "example.org/a/b?a=1&b=2"),
        ("https://m.example.org", "example.org"),
        ("https://example.org/?", "example.org"),
        ("https://example.org:8443/A", "example.org:8443/A"),
        ("ftp://example.org/", None),
        ("", None),
        (None, None),
    ],
)
def test_canonical_url(spark, url, want):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(canonical_url(F.col("u"))).first()[0] == want


def resolve(spark, rows, **options):
    full = [(i, u, at, kind, 200 if kind == "response" else 304, h, p) for i, u, at, kind, h, p in rows]
    return {r.record_id: r for r in resolve_revisits(spark.createDataFrame(full, SCHEMA), **options).collect()}


def test_outcomes_and_headers(spark):
    url, day = "http://a.org/x", 86_400
    rows = [
        (1, url, 10, "revisit", {"ETag": "1"}, None),
        (2, url, 20, "response", {"ETag": '"1"', "Content-Length": "9", "Last-Modified": "d", "Age": "1"}, "p2"),
        (3, url + "#f", 30, "revisit", {"etag": 'W/"1"', "Content-Length": "0", "AGE": "5", "Connection": "close"}, None),
        (4, url, 5 * day, "revisit", {"Last-Modified": "d"}, None),
        (5, url, 5 * day + 1, "revisit", {"Last-Modified": "e"}, None),
        (6, url, 6 * day, "revisit", None, None),
        (7, None, 30, "revisit", {}, None),
        (8, url, None, "revisit", {}, None),
        (9, url, 7 * day, "response", {}, None),
        (10, url, 7 * day, "revisit", {"ETag": '"1"'}, None),
        (11, "http://other.org/", 7 * day, "revisit", {}, None),
        (12, None, None, None, None, None),
    ]
    got = resolve(spark, rows)
    outcomes = {i: (r.outcome, r.response_id, r.payload) for i, r in got.items()}
    assert outcomes == {
        1: ("unmatched", None, None),
        3: ("resolved", 2, "p2"),
        4: ("resolved", 2, "p2"),
        5: ("changed", 2, None),
        6: ("unverified", 2, "p2"),
        7: ("unmatched", None, None),
        8: ("unmatched", None, None),
        10: ("changed", 9, None),
        11: ("unmatched", None, None),
    }
    assert got[3].headers == {"etag": 'W/"1"', "content-length": "9", "last-modified": "d", "age": "5"}
    assert got[6].headers == {"etag": '"1"', "content-length": "9", "last-modified": "d", "age": "1"}
    assert got[5].headers == {"last-modified": "e"}


def test_other_statuses_are_no_responses(spark):
    rows = [(1, "http://a.org/", 1, "response", 404, {}, "no"), (2, "http://a.org/", 2, "revisit", 304, {}, None)]
    assert resolve_revisits(spark.createDataFrame(rows, SCHEMA)).first().outcome == "unmatched"


@pytest.mark.parametrize("period", [1, 7, 1000])
def test_as_of_matches_brute_force(spark, period):
    draw = random.Random(period)
    rows, seen = [], []
    for i in range(300):
        url = "http://hot.org/" if draw.random() < 0.5 else f"http://h.org/{draw.randrange(5)}"
        rows.append((i, url, draw.randrange(60), draw.choice(["response", "revisit"]), {}, f"p{i}"))
    rows += [rows[5], rows[6]]
    got = resolve(spark, rows, period_seconds=period)
    for i, url, at, kind, _, _ in rows:
        if kind == "revisit":
            before = [(t, j) for j, u, t, k, _, _ in rows if k == "response" and u == url and (t, j) < (at, i)]
            assert got[i].response_id == (max(before)[1] if before else None)
            seen.append(i)
    assert set(got) == set(seen)


def test_repeated_names_and_clashing_columns(spark):
    rows = [(1, "http://a.org/", 1, "revisit", 304, {"A": "1", "a": "2"}, None, "x")]
    df = spark.createDataFrame(rows, SCHEMA + ", stored string")
    row = resolve_revisits(df.withColumn("near", F.lit(1)).withColumn("period", F.lit(2))).first()
    assert list(row.headers) == ["a"]
    assert spark.createDataFrame([({"b": "1", "a": None},)], "h map<string,string>").select(header_text(F.col("h"))).first()[0] == "a: \nb: 1"


def test_empty_table(spark):
    assert resolve_revisits(spark.createDataFrame([], SCHEMA)).count() == 0
