"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from pricelens.llm.quality_rules import LETTERS, STOP_WORDS

_STOPS = ", ".join(f"'{w}'" for w in sorted({w for ws in STOP_WORDS.values() for w in ws}))

#: The counts of the quality rules, then their verdict.
MEASURED = r"""
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
             list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
      FROM documents),
g AS (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS c FROM g) WHERE c > 1),
v AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY rid),
m AS (SELECT doc_id, t, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(n, 0)::BIGINT AS n_repeat_words,
             len(list_filter(w, lambda x: lower(x) IN (""" + _STOPS + r"""))) AS n_stop_words,
             length(regexp_replace(t, '\P{Lu}+', '', 'g')) AS n_upper,
             length(regexp_replace(t, '[\P{L}""" + LETTERS + r"""]+', '', 'g')) AS n_other
      FROM d LEFT JOIN v USING (rid)),
q AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
k AS (SELECT *, NOT base_failed AND coalesce(word_chars / n_words BETWEEN 2 AND 15 AND n_symbols / n_words <= 0.2
             AND (n_stop_words / n_words >= 0.02 OR 50 * n_other > word_chars) AND n_dup_lines / n_lines <= 0.5
             AND n_upper / word_chars <= 0.5, false) AS kept FROM q)
"""

ORACLE: dict[str, str] = {
    "op6_quality_rules": f"""WITH {MEASURED}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM k""",
    "op8_warc_revisits": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, 1700000000 + page_id * 60 AS s, page_id % 4 AS k,
             regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM pages
           WHERE page_id IS NOT NULL),
u AS (SELECT *, regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), '^www\.|:(80|443)$', '', 'g') AS host,
             regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
             list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
               lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS q FROM p),
c AS (SELECT *, host || path || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS site FROM u),
f AS (SELECT 'r' || page_id AS rid, page_id, site, s, CASE WHEN k <> 3 THEN '"' || md5(html) || '"' END AS etag,
             CASE WHEN k <> 3 THEN s - 86400 END AS modified, sha256(html) AS sha FROM c
      UNION ALL SELECT 'o' || page_id, page_id, site, s - 3600, '"old"', NULL, sha256('old') FROM c WHERE page_id % 3 = 0
      UNION ALL SELECT 'h' || page_id, page_id, 'hot.example.org/a', s, '"h' || page_id // 10 || '"', NULL, sha256('h' || page_id // 10)
                FROM c WHERE page_id % 3 = 2),
v AS (SELECT 'v' AS capture, page_id, site, s + 86400 AS s, CASE k WHEN 0 THEN 'W/"' || md5(html) || '"' WHEN 2 THEN '"changed"' END AS etag,
             CASE WHEN k = 1 THEN s - 86400 END AS modified, sha256(html) AS sha FROM c
      UNION ALL SELECT 'b', page_id, site, s - 7200, '"' || md5(html) || '"', NULL, sha256(html) FROM c WHERE page_id % 7 = 0
      UNION ALL SELECT 'w', page_id, 'hot.example.org/a', s + 200, 'W/"h' || page_id // 10 || '"', NULL, sha256('h' || page_id // 10)
                FROM c WHERE page_id % 3 = 2),
r AS (SELECT v.*, (SELECT max(struct_pack(s := f.s, rid := f.rid)) FROM f WHERE f.site = v.site AND f.s < v.s) AS hit FROM v),
d AS (SELECT r.capture, r.page_id, r.site, r.s, r.etag, f.rid, f.page_id AS oid, f.etag AS oetag, f.sha AS osha, coalesce(
        regexp_replace(r.etag, '^W/', '') = f.etag, r.modified = f.modified, r.sha = f.sha) AS agree
      FROM r LEFT JOIN f ON f.rid = r.hit.rid)
SELECT page_id, capture, site AS canonical_url,
       CASE WHEN rid IS NULL THEN 'no_response' WHEN agree THEN 'resolved' ELSE 'mismatch' END AS outcome,
       oid AS response_page_id, left(rid, 1) AS response_capture,
       CASE WHEN agree THEN coalesce(etag, oetag) END AS etag,
       CASE WHEN agree THEN strftime(to_timestamp(s) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') END AS date,
       CASE WHEN agree THEN 'text/html' END AS content_type, CASE WHEN agree THEN osha END AS body_sha256
FROM d""",
    "op10_exact_dedup": """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t""",
    "op12_lexical_search": r"""
WITH items AS (SELECT DISTINCT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
               FROM benchmark),
q AS (SELECT item_id, t, term, count(*) AS q
      FROM (SELECT *, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM items) GROUP BY ALL),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
c AS (SELECT count(*)::BIGINT AS n, sum(len(ts))::BIGINT AS l FROM d WHERE len(ts) > 0),
p AS (SELECT rid, term, count(*)::BIGINT AS tf FROM (SELECT rid, unnest(ts) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, c GROUP BY term, n),
s AS (SELECT item_id, t, rid, doc_id,
             sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(ts) * n) // l))))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN p USING (term) JOIN d USING (rid), c GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id, t ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 20""",
}
