"""Web archive records: resolving "not modified" revisits to full responses.

``parse`` splits WARC/1.1 records into their fields with built-in functions. ``resolve``
is an as-of join: a revisit takes the latest full response (200) of the same canonical
URL captured before it, checks the validators of both, and on agreement gets that
response's headers, updated by those that a 304 may change.

Hot URLs. Captures are grouped by (URL, span of time): a window inside a span, one row a
span for what earlier spans leave. Windows carry ids only; headers are joined by id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROFILE = "http://netpreserve.org/warc/1.1/revisit/server-not-modified"
#: Headers of a 304 that never replace those of the stored response.
KEPT = ("connection", "content-encoding", "content-length", "content-location", "content-range", "content-type",
        "keep-alive", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade")
#: Query parameters that name how a page was reached, not the page.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"
#: Length of a span of captures.
SPAN_SECONDS = 86_400


def canonical_url(url: Column) -> Column:
    """The URL without scheme, ``www.``, default port, fragment, tracking parameters and closing slash.

    The host is lower-cased and parameters are sorted; null stays null.
    """
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1)), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.array_sort(F.filter(F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(""))


def _pairs(block: Column) -> Column:
    """Lower-cased names and values of header lines, in order; lines without a colon are left out."""
    return F.transform(F.filter(F.split(block, "\r\n"), lambda line: F.instr(line, ":") > 1), lambda line: F.struct(
        F.lower(F.trim(F.substring_index(line, ":", 1))).alias("key"),
        F.trim(F.substring(line, F.instr(line, ":") + 1, F.length(line))).alias("value")))


def _headers(pairs: Column) -> Column:
    """Names to values; the last of a repeated name holds. ``pairs`` is a column that is there already:
    an expression would be worked out anew for each line."""
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)


def parse(records: DataFrame, column: str = "record") -> DataFrame:
    """record_id, kind, url, captured_at (seconds), digest, status, headers, body_sha256 of whole records.

    A null or broken record gives null fields and no headers. The block has as many bytes as the record's
    Content-Length says; if that is missing, no number or more than there is, it ends before the closing blank
    lines. Headers end at the block's first blank line, the body is what the block holds after them.
    """
    text = F.col(column).cast("string")
    parts = records.select(text.alias("t"), F.instr(text, "\r\n\r\n").alias("at"))
    parts = parts.select(F.expr("substring(t, 1, at - 1)").alias("head"), F.expr("substring(t, at + 4, length(t))").alias("block"))
    parts = parts.select(_pairs(F.col("head")).alias("pairs"), "block")
    parts = parts.select(_headers(F.col("pairs")).alias("w"), "block", F.instr("block", "\r\n\r\n").alias("at"))
    there = F.octet_length("block")
    told = F.col("w")["content-length"].try_cast("int")
    size = F.when(told.between(0, there), told).otherwise(there - F.when(F.endswith("block", F.lit("\r\n\r\n")), 4).otherwise(0))
    start = F.when(F.col("at") > 0, F.octet_length(F.expr("substring(block, 1, at + 3)"))).otherwise(0)
    parts = parts.select("w", "block", _pairs(F.expr("substring(block, 1, at - 1)")).alias("http"), start.alias("start"), size.alias("size"))
    body = F.expr("substring(cast(block as binary), start + 1, greatest(size - start, 0))")
    return parts.select(
        F.col("w")["warc-record-id"].alias("record_id"), F.col("w")["warc-type"].alias("kind"),
        F.col("w")["warc-target-uri"].alias("url"),
        F.unix_timestamp(F.try_to_timestamp(F.col("w")["warc-date"], F.lit("yyyy-MM-dd'T'HH:mm:ssX"))).alias("captured_at"),
        F.col("w")["warc-payload-digest"].alias("digest"), F.col("w")["warc-profile"].alias("profile"),
        F.expr("try_cast(regexp_extract(substring(block, 1, 64), '^HTTP/[0-9.]+ ([0-9]+)', 1) as int)").alias("status"),
        _headers(F.col("http")).alias("headers"), F.sha2(body, 256).alias("body_sha256"))


def _agree(revisit: Column, response: Column) -> Column:
    """True, false, or null if they have no validator in common: entity tag, else date, else payload digest."""
    def both(name: str) -> tuple[Column, Column]:
        return revisit["headers"][name], response["headers"][name]

    tag = [F.regexp_replace(x, "^W/", "") for x in both("etag")]
    date = both("last-modified")
    return F.coalesce(tag[0] == tag[1], date[0] == date[1], revisit["digest"] == response["digest"])


def resolve(records: DataFrame, span_seconds: int = SPAN_SECONDS, kept: tuple[str, ...] = KEPT) -> DataFrame:
    """One row per revisit: record_id, canonical_url, captured_at, outcome, response_id, headers, body_sha256.

    ``outcome`` is ``resolved``, ``mismatch`` (validators differ), ``no_validator`` or
    ``no_response``; only resolved rows have headers and a body digest. Of responses
    captured in the same second, the one with the greatest id counts; a response in the
    revisit's own second is not earlier. Revisits without a URL or time find no response;
    repeated revisits get an answer each; an empty table gives an empty result. Responses without
    an id are not candidates, since an answer could not name them. Only the columns that ``parse`` gives
    are read; others, whatever their names, are left out.
    """
    records = records.select("record_id", "kind", "url", "captured_at", "digest", "status", "headers", "body_sha256")
    rows = records.select("*", canonical_url(F.col("url")).alias("site"), F.floor(F.col("captured_at") / span_seconds).alias("span"))
    full = rows.where("kind = 'response' and status = 200 and site is not null and captured_at is not null and record_id is not null")
    full = full.select("site", "span", "captured_at", F.lit(True).alias("full"), "record_id")
    revisits = rows.where("kind = 'revisit'")
    found = revisits.where("site is not null and captured_at is not null").select(
        "site", "span", "captured_at", F.lit(False).alias("full"), F.lit(None).cast("string").alias("record_id")).distinct()

    newest = F.max(F.when(F.col("full"), F.struct("captured_at", "record_id")))
    here = Window.partitionBy("site", "span").orderBy("captured_at").rangeBetween(Window.unboundedPreceding, -1)
    inside = full.unionByName(found).select("*", newest.over(here).alias("inside")).where("not full")
    spans = full.unionByName(found).groupBy("site", "span").agg(newest.alias("newest"))
    earlier = Window.partitionBy("site").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("site", "span", F.max("newest").over(earlier).alias("before"))
    asof = inside.join(spans, ["site", "span"]).select(
        "site", "captured_at", F.coalesce("inside", "before")["record_id"].alias("response_id"))

    old = records.where("kind = 'response'").select(
        F.col("record_id").alias("response_id"), F.struct("headers", "digest", "body_sha256").alias("old")).dropDuplicates(["response_id"])
    matched = revisits.join(asof, ["site", "captured_at"], "left").join(old, "response_id", "left")
    new = F.struct("headers", "digest")
    agree = _agree(new, F.col("old"))
    outcome = (F.when(F.col("response_id").isNull(), "no_response").when(agree, "resolved")
               .when(~agree, "mismatch").otherwise("no_validator"))
    merged = F.map_zip_with(F.col("old")["headers"], F.map_filter("headers", lambda k, _: ~k.isin(*kept)),
                            lambda k, before, after: F.coalesce(after, before))
    resolved = F.col("outcome") == "resolved"
    return matched.withColumn("outcome", outcome).select(
        "record_id", F.col("site").alias("canonical_url"), "captured_at", "outcome", "response_id",
        F.when(resolved, merged).alias("headers"), F.when(resolved, F.col("old")["body_sha256"]).alias("body_sha256"))


def records_of(pages: DataFrame) -> DataFrame:
    """WARC records derived from pages; rows without a page_id have none (records are named by it).

    r: the page's response, captured at its number in minutes. v: its revisit a day later under another spelling of
    the URL. By the page's number, it repeats the entity tag (weakly), repeats the date, has another tag, or has no
    validator but the digest. Some pages also have o: an older, other response; e: a 404 between response and
    revisit, with the page's tag; b: a revisit before any response. Every third page adds h and w: a response and a
    revisit of one and the same URL, which changes every ten pages.
    """
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    at = lambda seconds: F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    quoted = lambda value: F.concat(F.lit('"'), value, F.lit('"'))
    rows = pages.where("page_id is not null").select(
        F.col("page_id").cast("long").alias("id"), "url", F.coalesce("html", F.lit("")).alias("html"),
        (F.col("page_id") * 60 + 1_700_000_000).alias("s"))
    rows = rows.select("*", F.sha2("html", 256).alias("sha"), F.md5("html").alias("tag"), (F.col("id") % 4).alias("case"),
                       F.concat(F.lit("h"), F.floor(F.col("id") / 10).cast("string")).alias("version"))

    def record(name: str, kind: str, url: Column, seconds: Column, sha: Column, status: str, headers: Column, body: Column) -> Column:
        http = F.concat(F.lit(f"HTTP/1.1 {status}\r\n"), line("Date", at(seconds)), headers, F.lit("\r\n"), body)
        head = F.concat(F.lit("WARC/1.1\r\n"), line("WARC-Type", F.lit(kind)),
                        line("WARC-Record-ID", F.concat(F.lit(name), F.col("id").cast("string"))),
                        F.coalesce(line("WARC-Target-URI", url), F.lit("")), line("WARC-Date", at(seconds)),
                        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), sha)),
                        line("WARC-Profile", F.lit(PROFILE)) if kind == "revisit" else F.lit(""),
                        line("Content-Length", F.octet_length(http).cast("string")), F.lit("\r\n"))
        return F.concat(head, http, F.lit("\r\n\r\n"))

    none, html, plain = F.lit(""), line("Content-Type", F.lit("text/html")), line("Content-Type", F.lit("text/plain"))
    s, case, sha, tag, version = F.col("s"), F.col("case"), F.col("sha"), quoted("tag"), quoted("version")
    date = at(s - 86_400)
    spelled = F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("#again"))
    own = F.when(case != 3, F.concat(line("ETag", tag), line("Last-Modified", date))).otherwise("")
    other = F.when(case == 0, line("ETag", F.concat(F.lit("W/"), tag))).when(
        case == 1, line("Last-Modified", date)).when(case == 2, line("ETag", F.lit('"changed"'))).otherwise("")
    hot, hot_sha = F.lit("http://www.hot.example.org/a?utm_source=feed"), F.sha2("version", 256)
    every = lambda n, rest, made: F.when(F.col("id") % n == rest, made)
    length = line("Content-Length", F.octet_length("html").cast("string"))
    return rows.select(F.explode(F.array(
        record("r", "response", F.col("url"), s, sha, "200 OK", F.concat(html, length, own), F.col("html")),
        record("v", "revisit", spelled, s + 86_400, sha, "304 Not Modified", F.concat(plain, other), none),
        every(3, 0, record("o", "response", F.col("url"), s - 3600, F.sha2(F.lit("old"), 256), "200 OK",
                           F.concat(html, line("ETag", F.lit('"old"'))), F.lit("old"))),
        every(5, 0, record("e", "response", F.col("url"), s + 43_200, sha, "404 Not Found", F.concat(html, line("ETag", tag)), none)),
        every(7, 0, record("b", "revisit", spelled, s - 7200, sha, "304 Not Modified", line("ETag", tag), none)),
        every(3, 2, record("h", "response", hot, s, hot_sha, "200 OK", F.concat(html, line("ETag", version)), F.col("version"))),
        every(3, 2, record("w", "revisit", F.lit("https://HOT.example.org:443/a/#x"), s + 200, hot_sha, "304 Not Modified",
                           line("ETag", F.concat(F.lit("W/"), version)), none)))).alias("record")).where("record is not null")
