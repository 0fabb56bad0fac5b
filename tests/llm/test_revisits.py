import random

import pytest

from matchbook.llm import queries, revisits
from tests.compare import connect, differences

SCHEMA = "record_id long, url string, captured_at long, kind string, status int, headers map<string,string>, payload string"


def test_query_against_sql(spark, folder):
    sql = queries.REGISTRY.oracle_sql()["op5_revisits"]
    assert differences(queries.op5_revisits(spark, folder), connect(folder), sql) is None


@pytest.mark.parametrize(
    "a, b",
    [
        ("http://www.Example.com:80/a/?utm_source=x#top", "https://example.com/a"),
        ("https://user@example.com/p?b=2&a=1&gclid=9", "example.com/p?a=1&b=2"),
        ("http://example.com", "https://example.com/"),
    ],
)
def test_canonical(spark, a, b):
    frame = spark.createDataFrame([(a,), (b,)], "url string").select(revisits.canonical("url").alias("u"))
    assert len({r.u for r in frame.collect()}) == 1


def plain(rows):
    for i, url, at, kind, status, headers, _ in rows:
        headers = {k.lower(): v for k, v in (headers or {}).items()}
        if kind == "response" and status == 200:
            yield i, "full", i
            continue
        if kind != "revisit":
            yield i, "other", None
            continue
        earlier = [r for r in rows if r[1] == url and url and at is not None and r[2] is not None and r[2] < at and r[3:5] == ("response", 200)]
        if not earlier:
            yield i, "missing", None
            continue
        ref = max(earlier, key=lambda r: (r[2], r[0]))
        old = {k.lower(): v for k, v in (ref[5] or {}).items()}
        for field in ("etag", "last-modified"):
            if field in headers and field in old:
                ok = headers[field].removeprefix("W/") == old[field].removeprefix("W/")
                yield i, "resolved" if ok else "mismatch", ref[0] if ok else None
                break
        else:
            yield i, "unchecked", None


@pytest.mark.parametrize("slices", [2, 50])
def test_random_captures_with_a_hot_url(spark, slices):
    rng = random.Random(slices)
    rows = []
    for i in range(500):
        url = "example.com/hot" if rng.random() < 0.5 else rng.choice(["example.com/a", "example.com/b", None])
        headers = {}
        if rng.random() < 0.7:
            headers["ETag"] = rng.choice(["", "W/"]) + rng.choice(['"x"', '"y"'])
        if rng.random() < 0.5:
            headers["last-modified"] = rng.choice(["monday", "sunday"])
        kind, status = rng.choice([("response", 200), ("revisit", 304), ("revisit", 304), ("response", 404), (None, None)])
        rows.append((i, url, rng.choice([None, *range(60)]), kind, status, rng.choice([headers, headers, None]), f"body {i}"))
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = revisits.resolve(frame, slices=slices).collect()
    assert sorted((r.record_id, r.outcome, r.ref_id) for r in got) == sorted(plain(rows))
    bodies = revisits.with_payloads(revisits.resolve(frame, slices=slices), frame).collect()
    assert all(r.payload == (None if r.ref_id is None else f"body {r.ref_id}") for r in bodies)


def test_headers_that_a_304_may_change(spark):
    rows = [
        (1, "example.com/a", 1, "response", 200, {"Content-Length": "9", "ETag": '"x"', "Cache-Control": "no-cache", "Server": "s"}, "x"),
        (2, "example.com/a", 2, "revisit", 304, {"content-length": "0", "etag": 'W/"x"', "cache-control": "max-age=5", "Expires": "never"}, None),
    ]
    got = {r.record_id: r for r in revisits.resolve(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[2].ref_id == 1
    assert got[2].headers == {"content-length": "9", "etag": 'W/"x"', "cache-control": "max-age=5", "server": "s", "expires": "never"}


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(None, None, None, None, None, None, None), (1, "", 3, "revisit", 304, None, None), (1, "", 3, "revisit", 304, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r.outcome for r in revisits.resolve(frame).collect()) == ["missing", "missing", "other"]
    assert revisits.resolve(frame.limit(0)).count() == 0
