"""Amounts, areas, dates and what is computed from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(c: Column, places: int = 2) -> Column:
    """Rounded through DECIMAL(18,6), so that ties do not depend on binary digits."""
    return F.round(c.cast("decimal(18,6)"), places)


def parse_money(c: Column) -> Column:
    """An amount in euros out of mixed notations, as DOUBLE; NULL for what is no amount.

    The number before EUR or € counts if one is named. Of dot and comma, the last is the
    decimal mark; a dot alone is one, several dots are thousands.
    """
    named = F.regexp_extract(c, r"(?i)([\d.,\s  ]*\d[\d.,\s  ]*)(?:EUR|€)", 1)
    token = F.translate(F.when(named != "", named).otherwise(c), "   \t\n\r", "")
    comma, dot = F.instr(F.reverse(token), ","), F.instr(F.reverse(token), ".")
    plain = (
        F.when((comma > 0) & (dot > 0) & (comma < dot), F.translate(F.translate(token, ".", ""), ",", "."))
        .when((comma > 0) & (dot > 0), F.translate(token, ",", ""))
        .when(comma > 0, F.translate(token, ",", "."))
        .when(F.length(token) - F.length(F.translate(token, ".", "")) > 1, F.translate(token, ".", ""))
        .otherwise(token)
    )
    plain = F.regexp_replace(plain, r"\.+$", "")
    return F.when(plain.rlike(r"^\d+(\.\d+)?$"), quantize(plain.try_cast("double")))


def quantize(c: Column) -> Column:
    """Two decimals, half away from zero on the decimal digits."""
    return F.round(c, 2)


def parse_datetime(c: Column) -> Column:
    """The first of the three notations that fits; NULL otherwise."""
    text = F.trim(c)
    formats = ("dd.MM.yyyy HH:mm:ss", "dd.MM.yyyy HH:mm", "dd.MM.yyyy")
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in formats)).cast("timestamp_ntz")


#: A number with its unit; no look-behind, so that other engines read it too.
AREA = r"(?iu)(\d[\d.,]*)\s*(m²|m2|m 2|čhv|chv|ha)(?![\p{L}\p{N}_])"


def parse_area(c: Column) -> Column:
    """The largest area named, as struct<area DOUBLE in m², unit STRING>; NULL if none is plausible."""
    numbers, units = F.regexp_extract_all(c, F.lit(AREA), F.lit(1)), F.regexp_extract_all(c, F.lit(AREA), F.lit(2))
    factor = {"ha": 10_000.0, "čhv": 3.5966, "chv": 3.5966}

    def one(number: Column, unit: Column) -> Column:
        low = F.lower(unit)
        scale = F.lit(1.0)
        for name, f in factor.items():
            scale = F.when(low == name, f).otherwise(scale)
        return F.struct((parse_money(number) * scale).alias("area"), unit.alias("unit"))

    found = F.filter(F.zip_with(numbers, units, one), lambda x: (x["area"] > 0) & (x["area"] <= 10_000_000))
    return F.aggregate(
        found,
        F.lit(None).cast("struct<area:double,unit:string>"),
        lambda best, x: F.when(best.isNull() | (x["area"] > best["area"]), x).otherwise(best),
    )


def discount_pct(estimated: Column, opening: Column) -> Column:
    """How far the opening price lies below the estimate, in percent; NULL without a positive estimate."""
    return F.when(opening.isNotNull() & (estimated > 0), round_half_up((estimated - opening) / estimated * 100))


def is_suspicious(estimated: Column, opening: Column) -> Column:
    pct = discount_pct(estimated, opening)
    return F.coalesce((pct >= 99) | ((opening < 1) & (estimated > 1000)), F.lit(False))


def derive_status(start: Column, end: Column, as_of: Column) -> Column:
    return (
        F.when(start.isNull() | end.isNull(), "bez_termina")
        .when(as_of < start, "najavljeno")
        .when(as_of <= end, "u_tijeku")
        .otherwise("zavrseno")
    )


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Equirectangular distance with 111 km to a degree."""
    dx = (lon1 - lon2) * F.cos(F.radians((lat1 + lat2) / 2))
    return F.sqrt(F.pow(lat1 - lat2, 2) + F.pow(dx, 2)) * 111.0


def number_or_null(c: Column) -> Column:
    return c.try_cast("double")


def same_value(a: Column, b: Column) -> Column:
    """Equal as numbers within a cent, or as trimmed texts; two NULLs are equal."""
    x, y = (c.cast("string").try_cast("double") for c in (a, b))  # by way of text: times have no number
    as_text = F.trim(a.cast("string")).eqNullSafe(F.trim(b.cast("string")))
    return F.when(x.isNotNull() & y.isNotNull(), F.abs(x - y) < 0.01).otherwise(as_text)
