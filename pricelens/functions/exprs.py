"""Pure ``Column -> Column`` building blocks.

Everything here is a built-in Catalyst expression, so it stays inside whole-stage
codegen; nothing crosses into Python per row. Parsing uses the ``try_`` family so a
malformed value becomes NULL instead of failing the job under ANSI mode (Spark 4's
default).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on (must stay exactly as written).
ROOM_LABELS = {1: "1 room", 2: "2 rooms", 3: "3 rooms", 4: "4 rooms"}
ROOMS_OPEN_ENDED = (5, "5+ rooms")
ROOMS_UNKNOWN = "unknown"
RAW_TYPE_APARTMENT = "appartement"
RAW_TYPE_HOUSE = "maison"
APARTMENT = "Apartment"
HOUSE = "House"
OTHER = "Other"
COMMUNE_CODE_WIDTH = 5
HIGH_CONFIDENCE_MIN = 100
MEDIUM_CONFIDENCE_MIN = 30
CONFIDENCE_TIERS = ("LOW", "MEDIUM", "HIGH")
LIQUIDITY_SATURATION = 1000
UNDERPRICED = "UNDERPRICED"
FAIRLY_PRICED = "FAIRLY_PRICED"
OVERPRICED = "OVERPRICED"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    """Parse a date in exactly ``fmt``; anything else is NULL (PRJ-2).

    A text that is what its cast date is written as has the default format; only others need the formatter."""
    parsed = F.try_to_date(_c(c), fmt)
    if fmt != "yyyy-MM-dd":
        return parsed
    text = _c(c).cast("string")
    date = text.try_cast("date")
    return F.when((F.length(text) == 10) & (date.cast("string") == text) & (text >= "0001"), date).otherwise(parsed)


def decimal_comma_double(c) -> Column:
    """``"250000,50"`` -> 250000.5; blank or malformed -> NULL (PRJ-3)."""
    return F.translate(_c(c).cast("string"), ",", ".").try_cast("double")


def lenient_int(c) -> Column:
    """``"3"`` and ``"3.0"`` -> 3; malformed -> NULL (PRJ-4)."""
    return _c(c).try_cast("double").try_cast("int")


def commune_code(c) -> Column:
    """Left-pad to five characters with ``0`` (longer values are cut, NULL stays NULL) (PRJ-5)."""
    return F.lpad(_c(c).cast("string"), COMMUNE_CODE_WIDTH, "0")


def property_type(raw) -> Column:
    """Case-insensitive appartement/maison -> Apartment/House, else Other (PRJ-7)."""
    low = F.lower(_c(raw))
    return (F.when(low == RAW_TYPE_APARTMENT, APARTMENT)
            .when(low == RAW_TYPE_HOUSE, HOUSE)
            .otherwise(OTHER))


def is_positive(c) -> Column:
    """Strictly positive and not NaN (NaN sorts above every number, and text "nan"
    parses to it). NULL -> NULL, which a filter drops. The value is referenced once, so
    a parse expression feeding it is evaluated once."""
    return F.nanvl(_c(c), F.lit(-1.0)) > 0


def is_residential(raw) -> Column:
    """FLT-4: NULL type is rejected (``isin`` on NULL is NULL, which a filter drops)."""
    return F.lower(_c(raw)).isin(RAW_TYPE_APARTMENT, RAW_TYPE_HOUSE)


def price_per_m2(price, surface) -> Column:
    """HALF_UP round to cents of price / surface; surface 0 gives NULL (PRJ-9)."""
    return F.round(F.try_divide(_c(price), _c(surface)), 2)


def rooms_bucket(rooms) -> Column:
    """1 -> '1 room', 2..4 -> 'N rooms', >=5 -> '5+ rooms', else 'unknown' (PRJ-10)."""
    r = _c(rooms)
    expr = None
    for n, label in ROOM_LABELS.items():
        expr = F.when(r == n, label) if expr is None else expr.when(r == n, label)
    return expr.when(r >= ROOMS_OPEN_ENDED[0], ROOMS_OPEN_ENDED[1]).otherwise(ROOMS_UNKNOWN)


def sale_id(sale_date, code, price, surface) -> Column:
    """SHA-256 of ``date|commune|price|surface`` (NULL parts are skipped) (PRJ-11).

    ``concat_ws`` never returns NULL, so neither does the hash; the ``coalesce`` only
    tells the optimizer so (a non-nullable column lets ``count(sale_id)`` skip hashing)."""
    digest = F.sha2(F.concat_ws("|", _c(sale_date), _c(code), _c(price), _c(surface)), 256)
    return F.coalesce(digest, F.lit(""))


def rent_for_type(ptype, apt, house) -> Column:
    """Apartment -> apartment rent, House -> house rent, otherwise apartment rent (PRJ-16)."""
    t = _c(ptype)
    return (F.when(t == APARTMENT, _c(apt))
            .when(t == HOUSE, _c(house))
            .otherwise(_c(apt)))


def liquidity_score(count) -> Column:
    """``round(least(1, ln(n+1)/ln(1000)), 4)`` (PRJ-18)."""
    ratio = F.log(_c(count).cast("double") + F.lit(1.0)) / F.lit(math.log(LIQUIDITY_SATURATION))
    return F.round(F.least(F.lit(1.0), ratio), 4)


def gross_yield(rent, median) -> Column:
    """``round(rent*12/median, 4)`` when median > 0 and rent is known, else NULL (PRJ-19, FLT-12)."""
    m, r = _c(median), _c(rent)
    guard = m.isNotNull() & (m > 0) & r.isNotNull()
    return F.when(guard, F.round(r * 12 / m, 4)).otherwise(F.lit(None).cast("double"))


def confidence(count) -> Column:
    """>=100 HIGH, >=30 MEDIUM, else LOW (PRJ-20)."""
    n = _c(count)
    return (F.when(n >= HIGH_CONFIDENCE_MIN, CONFIDENCE_TIERS[2])
            .when(n >= MEDIUM_CONFIDENCE_MIN, CONFIDENCE_TIERS[1])
            .otherwise(CONFIDENCE_TIERS[0]))


def fair_bound(price_m2, surface, whole_euros: bool = True) -> Column:
    """price/m2 x surface; whole euros with HALF_EVEN (the quote path) or unrounded (PRJ-21)."""
    v = _c(price_m2) * _c(surface)
    return F.bround(v, 0) if whole_euros else v


def verdict(asked, low, high) -> Column:
    """Inclusive interquartile range: below -> UNDER, above -> OVER, else FAIRLY (PRJ-22)."""
    a = _c(asked)
    return (F.when(a < _c(low), UNDERPRICED)
            .when(a > _c(high), OVERPRICED)
            .otherwise(FAIRLY_PRICED))


def iso_date(c) -> Column:
    """A date as its 10-character ``yyyy-MM-dd`` text (PRJ-23)."""
    return F.date_format(_c(c), "yyyy-MM-dd")
