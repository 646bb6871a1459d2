"""DuckDB SQL equivalents of the named queries (the correctness oracle).

Engine spellings that differ from Spark: strict date ``try_strptime``; HALF_UP rounding
of a double through its decimal text (Spark rounds the printed decimal); HALF_EVEN
``round_even``; exact mean via integer cents; ``quantile_disc`` for the percentiles
(Spark's ``percentile_approx`` returns an input element and is exact below its
accuracy; ``percentile_disc`` semantics).
"""

from __future__ import annotations


def _half_up(expr: str, scale: int) -> str:
    return f"CAST(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(18,{scale})) AS DOUBLE)"


def _rooms_bucket(col: str) -> str:
    return (f"CASE WHEN {col} = 1 THEN '1 room' WHEN {col} = 2 THEN '2 rooms' "
            f"WHEN {col} = 3 THEN '3 rooms' WHEN {col} = 4 THEN '4 rooms' "
            f"WHEN {col} >= 5 THEN '5+ rooms' ELSE 'unknown' END")


RAW_SALES = """
raw_sales AS (
  SELECT CASE WHEN l_partkey % 50 = 2 THEN '15/03/2024'
              ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS date_mutation,
         CASE WHEN l_partkey % 50 = 0 THEN ''
              ELSE replace(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR), '.', ',') END AS valeur_fonciere,
         CASE l_returnflag WHEN 'A' THEN 'Appartement' WHEN 'R' THEN 'MAISON' ELSE 'Dépendance' END AS type_local,
         CASE WHEN l_partkey % 50 = 1 THEN '0'
              ELSE replace(CAST(CAST(l_quantity AS DECIMAL(12,1)) AS VARCHAR), '.', ',') END AS surface_reelle_bati,
         CAST(l_linenumber AS VARCHAR) AS nombre_pieces_principales,
         CAST(1000 + s_nationkey AS VARCHAR) AS code_commune,
         n_name AS nom_commune,
         CAST(n_regionkey AS VARCHAR) AS code_departement
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
)"""

TYPED = """
typed AS (
  SELECT CAST(try_strptime(date_mutation, '%Y-%m-%d') AS DATE) AS sale_date,
         TRY_CAST(replace(valeur_fonciere, ',', '.') AS DOUBLE) AS sale_price,
         TRY_CAST(replace(surface_reelle_bati, ',', '.') AS DOUBLE) AS surface_m2,
         TRY_CAST(TRY_CAST(nombre_pieces_principales AS DOUBLE) AS INTEGER) AS rooms,
         lpad(code_commune, 5, '0') AS commune_code,
         nom_commune AS commune_name,
         code_departement AS department_code,
         type_local AS property_type_raw
  FROM raw_sales
)"""

REASON = """
reasons AS (
  SELECT *, CASE
      WHEN NOT coalesce(sale_price > 0 AND NOT isnan(sale_price), false) THEN 'invalid_price'
      WHEN NOT coalesce(surface_m2 > 0 AND NOT isnan(surface_m2), false) THEN 'invalid_surface'
      WHEN sale_date IS NULL THEN 'invalid_date'
      WHEN NOT coalesce(lower(property_type_raw) IN ('appartement', 'maison'), false) THEN 'not_residential'
      ELSE 'OK' END AS reject_reason
  FROM typed
)"""

SALES = f"""
sales AS (
  SELECT sha256(concat_ws('|', CAST(sale_date AS VARCHAR), commune_code,
                          CAST(sale_price AS VARCHAR), CAST(surface_m2 AS VARCHAR))) AS sale_id,
         sale_date,
         CAST(year(sale_date) AS INTEGER) AS year,
         commune_code, commune_name, department_code,
         CASE lower(property_type_raw) WHEN 'appartement' THEN 'Apartment'
              WHEN 'maison' THEN 'House' ELSE 'Other' END AS property_type,
         surface_m2, rooms,
         {_rooms_bucket('rooms')} AS rooms_bucket,
         sale_price,
         {_half_up('sale_price / surface_m2', 2)} AS price_per_m2
  FROM typed
  WHERE sale_price > 0 AND NOT isnan(sale_price) AND surface_m2 > 0 AND NOT isnan(surface_m2)
    AND sale_date IS NOT NULL AND lower(property_type_raw) IN ('appartement', 'maison')
)"""

_MEAN = ("CAST((2 * CAST(sum(CAST(price_per_m2 AS DECIMAL(28,2))) * 100 AS HUGEINT) + count(price_per_m2))"
         " // (2 * count(price_per_m2)) AS DOUBLE) / 100.0")

SEGMENTS = f"""
segments AS (
  SELECT commune_code, commune_name, department_code, property_type, rooms_bucket,
         count(sale_id) AS transaction_count,
         quantile_disc(price_per_m2, 0.5) AS median_price_m2,
         {_MEAN} AS avg_price_m2,
         quantile_disc(price_per_m2, 0.25) AS q25_price_m2,
         quantile_disc(price_per_m2, 0.75) AS q75_price_m2
  FROM sales
  GROUP BY commune_code, commune_name, department_code, property_type, rooms_bucket
)"""


def _rent_side(status: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT CAST(1000 + c_nationkey AS VARCHAR) AS k, CAST(year(o_orderdate) AS INTEGER) AS y,
         replace(CAST(CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) / count(*) / 10000
                      AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS r
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE o_orderstatus IN ({status})
  GROUP BY 1, 2
)"""


RAW_RENTS = _rent_side("'F', 'P'", "rent_apt") + "," + _rent_side("'O'", "rent_house") + """,
raw_rents AS (
  SELECT lpad(coalesce(a.k, h.k), 5, '0') AS code_commune,
         a.r AS loyer_m2_appartement,
         h.r AS loyer_m2_maison,
         coalesce(a.y, h.y) AS source_year
  FROM rent_apt a FULL OUTER JOIN rent_house h ON lpad(a.k, 5, '0') = lpad(h.k, 5, '0') AND a.y = h.y
)"""

RENTS = """
rents AS (
  SELECT * FROM (
    SELECT lpad(code_commune, 5, '0') AS commune_code,
           TRY_CAST(replace(loyer_m2_appartement, ',', '.') AS DOUBLE) AS rent_m2_apartment,
           TRY_CAST(replace(loyer_m2_maison, ',', '.') AS DOUBLE) AS rent_m2_house,
           source_year
    FROM raw_rents)
  WHERE commune_code IS NOT NULL AND (rent_m2_apartment IS NOT NULL OR rent_m2_house IS NOT NULL)
)"""

RENTS_LATEST = """
rents_latest AS (
  SELECT commune_code, rent_m2_apartment, rent_m2_house, source_year FROM (
    SELECT *, row_number() OVER (PARTITION BY commune_code
              ORDER BY source_year DESC NULLS LAST, rent_m2_apartment DESC NULLS LAST,
                       rent_m2_house DESC NULLS LAST) AS rn
    FROM rents) WHERE rn = 1
)"""

RAW_RATES = """
raw_rates AS (
  SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, value AS rate_value, event_type AS rate_type,
         'events' AS source, ts, event_id
  FROM events
)"""

RATES = """
rates AS (
  SELECT * FROM (
    SELECT CAST(try_strptime(date, '%Y-%m-%d') AS DATE) AS rate_date, rate_value, rate_type,
           DATE '2024-12-31' AS ingestion_date, ts, event_id
    FROM raw_rates)
  WHERE rate_date IS NOT NULL AND rate_value IS NOT NULL
)"""

_RATE_ORDER = "rate_date DESC, ts DESC, event_id DESC, rate_value DESC"

RATES_LATEST = f"""
rates_latest AS (
  SELECT rate_date, rate_value, rate_type, ingestion_date FROM (
    SELECT *, row_number() OVER (PARTITION BY rate_type ORDER BY {_RATE_ORDER}) AS rn FROM rates)
  WHERE rn = 1
),
rate_top AS (
  SELECT rate_date, rate_value, rate_type FROM rates_latest
  ORDER BY rate_date DESC, rate_type DESC, rate_value DESC LIMIT 1
)"""

SEG_RENT = """
seg_rent AS (
  SELECT s.*, CASE WHEN s.property_type = 'Apartment' THEN r.rent_m2_apartment
                   WHEN s.property_type = 'House' THEN r.rent_m2_house
                   ELSE r.rent_m2_apartment END AS rent_m2
  FROM segments s LEFT JOIN rents_latest r ON s.commune_code = r.commune_code
)"""


def _liquidity(n: str) -> str:
    return _half_up(f"least(1.0, ln(CAST({n} AS DOUBLE) + 1.0) / ln(1000.0))", 4)


def _yield(rent: str, median: str) -> str:
    return (f"CASE WHEN {median} IS NOT NULL AND {median} > 0 AND {rent} IS NOT NULL "
            f"THEN {_half_up(f'{rent} * 12 / {median}', 4)} ELSE NULL END")


def _confidence(n: str) -> str:
    return f"CASE WHEN {n} >= 100 THEN 'HIGH' WHEN {n} >= 30 THEN 'MEDIUM' ELSE 'LOW' END"


def _est(name: str, segments: str, rate_top: str, cdate: str) -> str:
    return f"""
{name} AS (
  SELECT s.commune_code, s.commune_name, s.department_code, s.property_type, s.rooms_bucket,
         s.transaction_count, s.median_price_m2, s.avg_price_m2, s.q25_price_m2, s.q75_price_m2,
         s.rent_m2,
         {_yield('s.rent_m2', 's.median_price_m2')} AS estimated_gross_yield,
         (SELECT rate_value FROM {rate_top}) AS latest_rate_value,
         {_liquidity('s.transaction_count')} AS market_liquidity_score,
         {_confidence('s.transaction_count')} AS fair_price_confidence,
         DATE '{cdate}' AS computation_date
  FROM {segments} s
)"""


EST = _est("est", "seg_rent", "rate_top", "2024-12-31")

LISTINGS = f"""
listings AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         lpad(CAST(1000 + s_nationkey AS VARCHAR), 5, '0') AS commune_code,
         CASE l_returnflag WHEN 'A' THEN 'Apartment' WHEN 'R' THEN 'House' ELSE 'Office' END AS property_type,
         {_rooms_bucket('l_linenumber')} AS rooms_bucket,
         l_quantity AS surface_m2,
         l_extendedprice AS asked_price
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  WHERE l_linestatus = 'O'
)"""

REF = """
ref AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY commune_code, property_type, rooms_bucket
              ORDER BY computation_date DESC NULLS LAST, transaction_count DESC NULLS LAST,
                       commune_name ASC NULLS LAST, department_code ASC NULLS LAST) AS rn
    FROM est) WHERE rn = 1
)"""

VERDICTS = """
verdicts AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.commune_code,
         r.commune_name, l.property_type, l.rooms_bucket, l.surface_m2, l.asked_price,
         round_even(r.median_price_m2 * l.surface_m2, 0) AS estimated_fair_price,
         round_even(r.q25_price_m2 * l.surface_m2, 0) AS low_fair_price,
         round_even(r.q75_price_m2 * l.surface_m2, 0) AS high_fair_price,
         CASE WHEN r.rn IS NULL THEN NULL
              WHEN l.asked_price < round_even(r.q25_price_m2 * l.surface_m2, 0) THEN 'UNDERPRICED'
              WHEN l.asked_price > round_even(r.q75_price_m2 * l.surface_m2, 0) THEN 'OVERPRICED'
              ELSE 'FAIRLY_PRICED' END AS label,
         r.fair_price_confidence AS confidence,
         r.transaction_count,
         r.median_price_m2,
         r.estimated_gross_yield,
         r.latest_rate_value,
         strftime(r.computation_date, '%Y-%m-%d') AS computation_date,
         CASE WHEN r.rn IS NULL THEN 'NO_REFERENCE' ELSE 'OK' END AS status
  FROM listings l
  LEFT JOIN ref r ON l.commune_code = r.commune_code AND l.property_type = r.property_type
                 AND l.rooms_bucket = r.rooms_bucket
  WHERE l.surface_m2 > 0 AND l.asked_price > 0
)"""

SALES_BASE = [RAW_SALES, TYPED, SALES]
EST_BASE = SALES_BASE + [SEGMENTS, RAW_RENTS, RENTS, RENTS_LATEST, RAW_RATES, RATES, RATES_LATEST,
                         SEG_RENT, EST]

_SEG_COLS = "commune_code, commune_name, department_code, property_type, rooms_bucket"
EST_COLS = ("commune_code, commune_name, department_code, property_type, rooms_bucket, transaction_count, "
            "median_price_m2, avg_price_m2, q25_price_m2, q75_price_m2, rent_m2, estimated_gross_yield, "
            "latest_rate_value, market_liquidity_score, fair_price_confidence, computation_date")


def _with(ctes, body: str) -> str:
    return "WITH " + ",".join(c.strip() for c in ctes) + "\n" + body


# The earlier run of ``estimates_history``: sales up to 1998, rates up to 1998-12-31.
_EARLY = [
    """sales_early AS (SELECT * FROM sales WHERE year <= 1998)""",
    SEGMENTS.replace("segments AS", "segments_early AS").replace("FROM sales", "FROM sales_early"),
    """seg_rent_early AS (
  SELECT s.*, CASE WHEN s.property_type = 'Apartment' THEN r.rent_m2_apartment
                   WHEN s.property_type = 'House' THEN r.rent_m2_house
                   ELSE r.rent_m2_apartment END AS rent_m2
  FROM segments_early s LEFT JOIN rents_latest r ON s.commune_code = r.commune_code)""",
    f"""rate_top_early AS (
  SELECT rate_date, rate_value, rate_type FROM (
    SELECT rate_date, rate_value, rate_type, row_number() OVER (PARTITION BY rate_type ORDER BY {_RATE_ORDER}) AS rn
    FROM rates WHERE rate_date <= DATE '1998-12-31') WHERE rn = 1
  ORDER BY rate_date DESC, rate_type DESC, rate_value DESC LIMIT 1)""",
    _est("est_early", "seg_rent_early", "rate_top_early", "1998-12-31"),
    f"""history AS (SELECT {EST_COLS} FROM est UNION ALL SELECT {EST_COLS} FROM est_early)""",
]


def _documents(runs: str) -> str:
    fields = EST_COLS.replace("computation_date", "strftime(computation_date, '%Y-%m-%d') AS computation_date")
    return f"SELECT 'fair_price_estimates' AS _index, {fields} FROM {runs}"


_FIELDS = [c.strip() for c in EST_COLS.split(",")]
_KEYS = _FIELDS[:5]


def _json_text(fields) -> str:
    """An object of the fields that are not NULL, dates as text; numbers here print alike in both engines."""
    text = {"computation_date": "strftime(computation_date, '%Y-%m-%d')"}
    parts = [f"""CASE WHEN {c} IS NOT NULL THEN '"{c}":' || CAST(to_json({text.get(c, c)}) AS VARCHAR) END""" for c in fields]
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


def _keyed(name: str, rows: str) -> str:
    content = [c for c in _FIELDS if c != "computation_date"]
    return (f"{name} AS (SELECT sha256({_json_text(_KEYS)}) AS _id, {_json_text(_FIELDS)} AS _source, "
            f"sha256({_json_text(content)}) AS digest FROM {rows})")


_CHANGED = [f"""earlier AS (
  SELECT * REPLACE (CASE WHEN transaction_count % 4 = 1 THEN median_price_m2 + 1 ELSE median_price_m2 END AS median_price_m2)
  FROM (SELECT {EST_COLS} FROM est WHERE transaction_count % 4 <> 0))""",
    """before_rows AS (SELECT * FROM earlier UNION ALL
  SELECT * REPLACE ('unknown' AS rooms_bucket) FROM earlier WHERE transaction_count % 4 = 2)""",
    _keyed("now_docs", "est"),
    _keyed("before_each", "before_rows"),
    "before_docs AS (SELECT _id, arg_max(digest, _source) AS digest FROM before_each GROUP BY _id)",
    """changed AS (
  SELECT coalesce(n._id, b._id) AS _id, CASE WHEN n._id IS NULL THEN 'delete' ELSE 'index' END AS action, n._source, n.digest
  FROM now_docs n FULL OUTER JOIN before_docs b ON n._id = b._id
  WHERE n.digest IS DISTINCT FROM b.digest)"""]

ORACLE: dict[str, str] = {
    "documents": _with(EST_BASE, f"SELECT 'fair_price_estimates' AS _index, {_json_text(_FIELDS)} AS _source FROM est"),
    "documents_changed": _with(EST_BASE + _CHANGED, "SELECT _id, action, digest FROM changed"),
    "documents_requests": _with(EST_BASE + _CHANGED, """
        SELECT part, CAST(row_number() OVER (PARTITION BY part ORDER BY first_id) AS INTEGER) AS block,
               n_documents, n_bytes, body_sha256
        FROM (SELECT part, min(_id) AS first_id, count(*) AS n_documents, CAST(sum(size) AS BIGINT) AS n_bytes,
                     sha256(string_agg(entry, '' ORDER BY _id)) AS body_sha256
              FROM (SELECT *, coalesce(sum(CASE WHEN size <= 700 THEN size END) OVER w, 0) // 4900 AS by_bytes,
                           coalesce(sum(CASE WHEN size <= 700 THEN 1 END) OVER w, 0) // 6 AS by_rows,
                           CASE WHEN size > 700 THEN _id END AS alone
                    FROM (SELECT left(_id, 1) AS part, _id, entry, strlen(entry) AS size
                          FROM (SELECT _id, '{"' || action || '":{"_index":"fair_price_estimates","_id":"' || _id || '"}}' || chr(10)
                                            || coalesce(_source || chr(10), '') AS entry FROM changed))
                    WINDOW w AS (PARTITION BY part ORDER BY _id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
              GROUP BY part, by_bytes, by_rows, alone)"""),
    "sales_parse": _with([RAW_SALES, TYPED], "SELECT * FROM typed"),
    "sales_filtered": _with([RAW_SALES, TYPED, REASON],
                            "SELECT * EXCLUDE (reject_reason) FROM reasons WHERE reject_reason = 'OK'"),
    "sales_formatted": _with(SALES_BASE, "SELECT * FROM sales"),
    "sales_reject_reasons": _with([RAW_SALES, TYPED, REASON],
                                  "SELECT reject_reason, count(*) AS n_rows FROM reasons GROUP BY reject_reason"),
    "sales_by_year": _with(SALES_BASE, "SELECT year, count(*) AS n_sales FROM sales GROUP BY year"),
    "sales_union_years": _with([RAW_SALES, TYPED], "SELECT * FROM typed"),
    "sales_scoped": _with(SALES_BASE, "SELECT * FROM sales WHERE year IN (1996, 1997, 1998) "
                                      "AND department_code IN ('1', '3')"),
    "rooms_bucket_counts": _with(SALES_BASE, "SELECT rooms_bucket, count(*) AS n_sales FROM sales "
                                             "GROUP BY rooms_bucket"),
    "rents_merged": _with([RAW_RENTS], "SELECT * FROM raw_rents"),
    "rents_formatted": _with([RAW_RENTS, RENTS], "SELECT * FROM rents"),
    "rents_latest": _with([RAW_RENTS, RENTS, RENTS_LATEST], "SELECT * FROM rents_latest"),
    "delimiter_detect": _with([RAW_RENTS], "SELECT ';' AS delimiter, "
                              "count(loyer_m2_appartement) + count(loyer_m2_maison) AS n_comma, "
                              "count(*) AS n_rows, 4 AS fields_per_line FROM raw_rents"),
    "rates_formatted": _with([RAW_RATES, RATES], "SELECT rate_date, rate_value, rate_type, ingestion_date FROM rates"),
    "rates_latest_per_type": _with([RAW_RATES, RATES, RATES_LATEST], "SELECT * FROM rates_latest"),
    "rates_last_n": _with([RAW_RATES, RATES], f"""
        SELECT rate_date, rate_value, rate_type, ingestion_date, obs_rank FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY rate_type ORDER BY {_RATE_ORDER}) AS INTEGER) AS obs_rank
          FROM rates) WHERE obs_rank <= 30"""),
    "rate_latest": _with([RAW_RATES, RATES, RATES_LATEST], "SELECT * FROM rate_top"),
    "rates_fallback": _with([RAW_RATES], """
        SELECT date, rate_value, rate_type, source FROM raw_rates
        UNION ALL
        SELECT '2024-12-31', 3.9, 'ESTR', 'ECB Data Portal (fallback)'
        WHERE NOT EXISTS (SELECT 1 FROM raw_rates)"""),
    "rates_sdmx": """
        SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS date, value AS rate_value,
               event_type AS rate_type, 'events' AS source
        FROM events WHERE value IS NOT NULL""",
    "rates_json_roundtrip": _with([RAW_RATES, RATES],
                                  "SELECT rate_date, rate_value, rate_type, ingestion_date FROM rates"),
    "segment_stats": _with(SALES_BASE + [SEGMENTS], "SELECT * FROM segments"),
    "segment_stats_approx": _with(SALES_BASE + [SEGMENTS], "SELECT * FROM segments"),
    "segment_stats_merged": _with(SALES_BASE + [SEGMENTS], "SELECT * FROM segments"),
    "segment_stats_streamed": _with(SALES_BASE + [SEGMENTS], "SELECT * FROM segments"),
    "segment_stats_sketch": _with(SALES_BASE + [SEGMENTS], "SELECT * FROM segments"),
    "segment_stats_hot": _with(SALES_BASE + [
        "sales_hot AS (SELECT * REPLACE ('all' AS commune_code, 'all' AS commune_name, 'all' AS department_code, "
        "'all' AS property_type, 'all' AS rooms_bucket) FROM sales)",
        SEGMENTS.replace("FROM sales", "FROM sales_hot")], "SELECT * FROM segments"),
    "segment_stats_exact": _with(SALES_BASE + [SEGMENTS], "SELECT * FROM segments"),
    "segment_rent": _with(SALES_BASE + [SEGMENTS, RAW_RENTS, RENTS, RENTS_LATEST, SEG_RENT],
                          "SELECT * FROM seg_rent"),
    "segment_rate": _with(SALES_BASE + [SEGMENTS, RAW_RATES, RATES, RATES_LATEST],
                          "SELECT s.*, (SELECT rate_value FROM rate_top) AS latest_rate_value FROM segments s"),
    "segment_liquidity": _with(SALES_BASE + [SEGMENTS],
                               f"SELECT {_SEG_COLS}, transaction_count, {_liquidity('transaction_count')} "
                               "AS market_liquidity_score FROM segments"),
    "segment_yield": _with(SALES_BASE + [SEGMENTS, RAW_RENTS, RENTS, RENTS_LATEST, SEG_RENT],
                           f"SELECT {_SEG_COLS}, median_price_m2, rent_m2, "
                           f"{_yield('rent_m2', 'median_price_m2')} AS estimated_gross_yield FROM seg_rent"),
    "segment_confidence": _with(SALES_BASE + [SEGMENTS],
                                f"SELECT {_SEG_COLS}, transaction_count, {_confidence('transaction_count')} "
                                "AS fair_price_confidence FROM segments"),
    "fair_price_estimates": _with(EST_BASE, "SELECT * FROM est"),
    "estimates_latest": _with(EST_BASE + _EARLY, f"""
        SELECT {EST_COLS} FROM (
          SELECT *, row_number() OVER (PARTITION BY commune_code, property_type, rooms_bucket
                    ORDER BY computation_date DESC NULLS LAST, transaction_count DESC NULLS LAST,
                             commune_name ASC NULLS LAST, department_code ASC NULLS LAST) AS rn
          FROM history) WHERE rn = 1"""),
    "estimates_roundtrip": _with(EST_BASE, "SELECT * FROM est"),
    "landing_roundtrip": _with(SALES_BASE, "SELECT * FROM sales"),
    "sales_incremental": _with(SALES_BASE, "SELECT * FROM sales"),
    "daily_run": _with(EST_BASE, "SELECT * FROM est"),
    "daily_incremental": _with(EST_BASE, "SELECT * FROM est"),
    "sales_deduplicated": _with(SALES_BASE, "SELECT DISTINCT * FROM sales"),
    "contract_violations": _with(EST_BASE, """
        SELECT CAST(count(*) FILTER (WHERE column_name IN ('avg_price_m2', 'q75_price_m2')) AS INTEGER) AS missing_columns,
               CAST(count(*) FILTER (WHERE column_name = 'rent_m2') AS INTEGER) AS type_mismatches,
               (SELECT count(*) FROM est WHERE transaction_count % 3 <> 1) AS confidence_violations
        FROM (SELECT unnest(['""" + "', '".join(EST_COLS.split(", ")) + """']) AS column_name)"""),
    "listing_ranges": _with(EST_BASE + [LISTINGS, REF, VERDICTS], """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, estimated_fair_price, low_fair_price,
               high_fair_price FROM verdicts WHERE status = 'OK'"""),
    "listing_verdicts": _with(EST_BASE + [LISTINGS, REF, VERDICTS], "SELECT * FROM verdicts"),
    "listing_unmatched": _with(EST_BASE + [LISTINGS], """
        SELECT * FROM listings l
        WHERE l.surface_m2 > 0 AND l.asked_price > 0 AND NOT EXISTS (
          SELECT 1 FROM est e WHERE e.commune_code = l.commune_code
            AND e.property_type = l.property_type AND e.rooms_bucket = l.rooms_bucket)"""),
    "verdict_summary": _with(EST_BASE + [LISTINGS, REF, VERDICTS],
                             "SELECT status, label, count(*) AS n_listings FROM verdicts GROUP BY status, label"),
    "communes": _with(EST_BASE, "SELECT DISTINCT commune_code, commune_name, department_code FROM est "
                                "ORDER BY commune_name NULLS LAST, commune_code"),
    "market_profile_rows": _with(EST_BASE, """
        SELECT commune_code,
               first_value(commune_name) OVER w AS profile_name,
               first_value(department_code) OVER w AS profile_department,
               count(*) OVER (PARTITION BY commune_code) AS segment_count,
               CAST(row_number() OVER w - 1 AS INTEGER) AS segment_pos,
               property_type, rooms_bucket, commune_name, department_code, transaction_count,
               median_price_m2, avg_price_m2, q25_price_m2, q75_price_m2, rent_m2,
               estimated_gross_yield, latest_rate_value, market_liquidity_score, fair_price_confidence,
               strftime(computation_date, '%Y-%m-%d') AS computation_date
        FROM est
        WINDOW w AS (PARTITION BY commune_code ORDER BY property_type NULLS FIRST, rooms_bucket NULLS FIRST, commune_name NULLS FIRST, department_code NULLS FIRST, transaction_count NULLS FIRST, median_price_m2 NULLS FIRST, avg_price_m2 NULLS FIRST, q25_price_m2 NULLS FIRST, q75_price_m2 NULLS FIRST, rent_m2 NULLS FIRST, estimated_gross_yield NULLS FIRST, latest_rate_value NULLS FIRST, market_liquidity_score NULLS FIRST, fair_price_confidence NULLS FIRST, computation_date NULLS FIRST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""),
    "market_profile_lookup": _with(EST_BASE, """
        SELECT commune_code,
               first_value(commune_name) OVER w AS profile_name,
               first_value(department_code) OVER w AS profile_department,
               count(*) OVER (PARTITION BY commune_code) AS segment_count,
               CAST(row_number() OVER w - 1 AS INTEGER) AS segment_pos,
               property_type, rooms_bucket, commune_name, department_code, transaction_count,
               median_price_m2, avg_price_m2, q25_price_m2, q75_price_m2, rent_m2,
               estimated_gross_yield, latest_rate_value, market_liquidity_score, fair_price_confidence,
               strftime(computation_date, '%Y-%m-%d') AS computation_date
        FROM est WHERE commune_code = (SELECT min(commune_code) FROM est)
        WINDOW w AS (PARTITION BY commune_code ORDER BY property_type NULLS FIRST, rooms_bucket NULLS FIRST, commune_name NULLS FIRST, department_code NULLS FIRST, transaction_count NULLS FIRST, median_price_m2 NULLS FIRST, avg_price_m2 NULLS FIRST, q25_price_m2 NULLS FIRST, q75_price_m2 NULLS FIRST, rent_m2 NULLS FIRST, estimated_gross_yield NULLS FIRST, latest_rate_value NULLS FIRST, market_liquidity_score NULLS FIRST, fair_price_confidence NULLS FIRST, computation_date NULLS FIRST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""),
    "documents_parsed": _with(EST_BASE, _documents("est")),
    "commune_count": _with(EST_BASE, "SELECT count(*) AS commune_count FROM "
                                     "(SELECT DISTINCT commune_code, commune_name, department_code FROM est)"),
}

_MIXED = """mixed AS (
  SELECT * REPLACE (CASE l_partkey % 7 WHEN 1 THEN CAST('nan' AS DOUBLE) WHEN 2 THEN 0 WHEN 3 THEN NULL ELSE surface_m2 END AS surface_m2,
                    CASE l_partkey % 7 WHEN 4 THEN CAST('nan' AS DOUBLE) WHEN 5 THEN -asked_price ELSE asked_price END AS asked_price)
  FROM listings)"""
_VALID = ("surface_m2 > 0 AND NOT isnan(surface_m2) AND asked_price > 0 AND NOT isnan(asked_price)")
ORACLE |= {
    "rates_fallback_empty": _with([RAW_RATES], """
        SELECT '2024-12-31' AS date, CAST(3.9 AS DOUBLE) AS rate_value, 'ESTR' AS rate_type,
               'ECB Data Portal' || ' (fallback)' AS source
        WHERE NOT EXISTS (SELECT 1 FROM raw_rates WHERE rate_type = 'no such type')"""),
    "rates_json_array": ORACLE["rates_json_roundtrip"],
    "estimates_json_snapshot": ORACLE["fair_price_estimates"],
    "daily_incremental_late": ORACLE["daily_incremental"],
    "daily_incremental_rents": ORACLE["daily_incremental"],
    "communes_run": ORACLE["communes"],
    "market_profile_run": ORACLE["market_profile_rows"],
    "documents_run": ORACLE["documents_parsed"],
    "documents_earlier_run": _with(EST_BASE + _EARLY, _documents("est_early")),
    "listing_invalid": _with(EST_BASE + [LISTINGS, _MIXED], f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, commune_code, property_type, rooms_bucket
        FROM mixed WHERE NOT coalesce({_VALID}, false)"""),
    "listing_verdicts_valid": _with(EST_BASE + [LISTINGS, _MIXED, REF, VERDICTS.replace("FROM listings l", "FROM (SELECT * FROM mixed WHERE "
                                    + _VALID + ") l")], "SELECT * FROM verdicts"),
    "listing_verdicts_stored": _with(EST_BASE + [LISTINGS, """moved AS (
        SELECT * REPLACE (CASE WHEN l_partkey % 3 = 0 THEN '01005' ELSE commune_code END AS commune_code,
                          CASE WHEN l_partkey % 3 = 0 THEN 'House' WHEN l_partkey % 11 <> 1 THEN property_type END AS property_type,
                          CASE WHEN l_partkey % 3 = 0 THEN '5+ rooms' ELSE rooms_bucket END AS rooms_bucket)
        FROM listings)""", REF, VERDICTS.replace("FROM listings l", "FROM moved l")], "SELECT * FROM verdicts"),
    "daily_incremental_relanded": ORACLE["daily_incremental"],
    "segment_stats_compacted": ORACLE["segment_stats"],
    "rates_json_mixed": _with([RAW_RATES, RATES], """
        SELECT rate_date, rate_value, rate_type, ingestion_date,
               (SELECT count(*) FROM raw_rates WHERE event_id % 98 = 0) AS n_unreadable
        FROM rates WHERE event_id % 98 <> 0"""),
    "sales_quarantine": _with([RAW_SALES, TYPED], """
        SELECT *, (SELECT count(*) FROM raw_sales WHERE code_departement = '2' AND valeur_fonciere = '') AS n_broken_lines
        FROM typed WHERE department_code <> '2'"""),
    "quality_rules_report": _with(EST_BASE, """
        SELECT rule, n_violations, true AS examples_ok FROM (
          SELECT unnest([{'rule': 'confidence_tier', 'n_violations': count(*) FILTER (transaction_count % 3 = 0)},
                         {'rule': 'quartiles_ordered', 'n_violations': count(*) FILTER (transaction_count % 3 = 1)},
                         {'rule': 'computation_date', 'n_violations': count(*) FILTER (transaction_count % 3 = 2)},
                         {'rule': 'count_positive', 'n_violations': count(*) FILTER (transaction_count <= 0)},
                         {'rule': 'price_positive', 'n_violations': count(*) FILTER (NOT median_price_m2 > 0)},
                         {'rule': 'liquidity_range', 'n_violations': count(*) FILTER (NOT market_liquidity_score BETWEEN 0 AND 1)},
                         {'rule': 'yield_not_negative', 'n_violations': count(*) FILTER (estimated_gross_yield < 0)},
                         {'rule': 'commune_code', 'n_violations': count(*) FILTER (commune_code IS NULL OR length(commune_code) <> 5)}],
                        recursive := true) FROM est)"""),
    "estimates_published": _with(EST_BASE, "SELECT *, (SELECT count(*) FROM est) AS n_rejected FROM est"),
    "daily_ledger": _with(EST_BASE + [REASON], """
        SELECT stage, n_rows, '2024-12-31' AS computation_date FROM (
          SELECT 'raw_sales' AS stage, count(*) AS n_rows FROM raw_sales
          UNION ALL SELECT 'formatted_sales', count(*) FROM sales
          UNION ALL SELECT 'rejected_sales:' || r, (SELECT count(*) FROM reasons WHERE reject_reason = r)
                    FROM (SELECT unnest(['invalid_price', 'invalid_surface', 'invalid_date', 'not_residential']) AS r)
          UNION ALL SELECT 'formatted_rents', count(*) FROM rents
          UNION ALL SELECT 'formatted_rates', count(*) FROM rates_latest
          UNION ALL SELECT 'segments', count(*) FROM est)"""),
}
