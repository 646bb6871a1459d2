import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pricelens.llm.warc import canonical_url, parse, records_of, resolve

ROW = "record_id string, kind string, url string, captured_at long, digest string, status int, headers map<string,string>, body_sha256 string"


@pytest.mark.parametrize("url, want", [
    ("HTTP://WWW.Example.org:80/A/b/?b=2&utm_source=x&a=1#frag", "example.org/A/b?a=1&b=2"),
    ("https://example.org", "example.org"), ("http://example.org/?ref=x", "example.org"), 
    ("https://example.org:8080/q?reference=1", "example.org:8080/q?reference=1"), ("", ""), (None, None)])
def test_canonical_url(spark, url, want):
    got = spark.createDataFrame([(url,)], "url string").select(canonical_url(F.col("url"))).first()[0]
    assert got == want


def test_parse(spark):
    text = ("WARC/1.1\r\nWARC-Type: revisit\r\nWARC-Record-ID: v1\r\nWARC-Target-URI: http://a.org/x:y\r\nWARC-Date: 2024-01-01T00:00:01Z\r\n"
            "Content-Length: 9\r\n\r\nHTTP/1.1 304 Not Modified\r\nETag: \"a\"\r\netag: \"b\"\r\nodd line\r\n\r\nbody\r\n\r\nmore\r\n\r\n")
    rows = parse(spark.createDataFrame([(text, 1), (None, 2), ("", 3), ("junk", 4)], "record string, headers int")).collect()
    first = next(r for r in rows if r.record_id)
    assert (first.kind, first.url, first.captured_at, first.status) == ("revisit", "http://a.org/x:y", 1_704_067_201, 304)
    assert first.headers == {"etag": '"b"'}
    assert sum(r.record_id is None for r in rows) == 3


def brute(rows, kept):
    out = Counter()
    for v in rows:
        if v[1] != "revisit":
            continue
        full = [r for r in rows if r[1] == "response" and r[5] == 200 and r[2] == v[2] and v[2] is not None
                and None not in (r[3], v[3], r[0]) and r[3] < v[3]]
        hit = max(full, key=lambda r: (r[3], r[0]), default=None)
        if hit is None:
            out[(v[0], "no_response", None, None)] += 1
            continue
        a, b = v[6] or {}, hit[6] or {}
        if "etag" in a and "etag" in b:
            same = a["etag"].removeprefix("W/") == b["etag"].removeprefix("W/")
        elif "last-modified" in a and "last-modified" in b:
            same = a["last-modified"] == b["last-modified"]
        else:
            same = None if v[4] is None or hit[4] is None else v[4] == hit[4]
        name = "no_validator" if same is None else "resolved" if same else "mismatch"
        merged = tuple(sorted((b | {k: x for k, x in a.items() if k not in kept}).items())) if same else None
        out[(v[0], name, hit[0], merged)] += 1
    return out


@pytest.mark.parametrize("span", [1, 7, 10_000])
def test_revisits_resolve_as_by_brute_force(spark, span):
    r = random.Random(span)
    rows = []
    for i in range(400):
        kind = r.choice(["response", "revisit", "revisit", "request"])
        headers = {k: r.choice(["a", "W/a", "b"]) for k in ("etag", "last-modified", "date", "content-length") if r.random() < 0.5}
        rows.append((f"{kind[:3]}{i}", kind, r.choice(["hot", "hot", "hot", f"u{i % 20}", None]), r.choice([None, *range(60)] * 3 + [r.randint(0, 60)]),
                     r.choice([None, "d1", "d2"]), r.choice([200, 200, 304, 404, None]), headers, "body"))
    rows += rows[:20]
    kept = ("content-length",)
    got = Counter((x.record_id, x.outcome, x.response_id, tuple(sorted(x.headers.items())) if x.headers is not None else None)
                  for x in resolve(spark.createDataFrame(rows, ROW), span_seconds=span, kept=kept).collect())
    assert got == brute(rows, kept)


def test_empty_tables(spark):
    assert resolve(spark.createDataFrame([], ROW)).collect() == []
    pages = spark.createDataFrame([(1, None, None), (None, "http://a", "x")], "page_id long, url string, html string")
    assert resolve(parse(records_of(pages))).first().outcome == "no_response"


def test_clashing_columns_and_long_bodies(spark):
    text = lambda kind, i, day, status, body: (
        f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {i}\r\nWARC-Target-URI: http://a.org/x\r\nWARC-Date: 2024-01-0{day}T00:00:01Z\r\n\r\n"
        f"HTTP/1.1 {status} X\r\nETag: \"a\"\r\n\r\n{body}\r\n\r\n")
    rows = [(text("response", "r1", 1, 200, "long body " * 200_000),), (text("revisit", "v1", 3, 304, ""),), (text("response", "r2", 2, 404, "gone"),)]
    records = parse(spark.createDataFrame(rows, "record string"))
    for name in ("site", "span", "old", "full", "newest", "response_id", "outcome", "inside"):
        records = records.withColumn(name, F.lit("clash"))
    got = resolve(records).collect()
    assert [(r.record_id, r.outcome, r.response_id) for r in got] == [("v1", "resolved", "r1")]
    import hashlib
    assert got[0].body_sha256 == hashlib.sha256(("long body " * 200_000).encode()).hexdigest()


def test_bodies_end_where_the_content_length_says(spark):
    import hashlib
    head = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: {}\r\n{}\r\n"
    http = "HTTP/1.1 200 OK\r\nETag: é\r\n\r\n"
    block = http + "naïve\r\n\r\n"  # a body that ends in blank lines itself
    n = len(block.encode())
    rows = [(head.format(name, length) + block + "\r\n\r\n",) for name, length in [
        ("right", f"Content-Length: {n}\r\n"), ("none", ""), ("word", "Content-Length: many\r\n"), ("more", f"Content-Length: {n + 99}\r\n"),
        ("less", f"Content-Length: {len((http + 'na').encode())}\r\n"), ("short", "Content-Length: 3\r\n"), ("minus", "Content-Length: -5\r\n")]]
    got = {r.record_id: r for r in parse(spark.createDataFrame(rows, "record string")).collect()}
    assert {r.status for r in got.values()} == {200} and all(r.headers == {"etag": "é"} for r in got.values())
    want = {"right": "naïve\r\n\r\n", "none": "naïve\r\n\r\n", "word": "naïve\r\n\r\n", "more": "naïve\r\n\r\n", "less": "na", "short": "",
            "minus": "naïve\r\n\r\n"}
    assert {k: r.body_sha256 for k, r in got.items()} == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in want.items()}


def test_the_derived_records_hold_every_kind_of_capture(spark):
    pages = spark.createDataFrame([(i, f"http://a{i}.org/p", f"body {i}") for i in range(70)], "page_id long, url string, html string")
    got = resolve(parse(records_of(pages))).collect()
    seen = Counter((r.record_id[0], r.outcome, (r.response_id or "-")[0]) for r in got)
    assert set(seen) == {("v", "resolved", "r"), ("v", "mismatch", "r"), ("b", "no_response", "-"), ("w", "resolved", "h"), ("w", "mismatch", "h")}
    assert len(got) == 70 + 10 + 23


def test_header_lines_are_split_once(spark):
    """The lines of a header block are a column before the last of a repeated name is looked for."""
    df = spark.createDataFrame([("WARC/1.1\r\nA: 1\r\na: 2\r\nno colon\r\nB:x\r\n\r\nHTTP/1.1 200 OK\r\nC: 3\r\n\r\nbody\r\n\r\n",)], "record string")
    out = parse(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 2
    assert out.first()["headers"] == {"c": "3"}
