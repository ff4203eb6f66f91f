"""Scalar column functions.

Every function takes and returns ``Column`` objects built from
``pyspark.sql.functions`` only, so they stay inside whole-stage codegen and
never start a Python worker.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratus.functions import codes


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# Whitespace as Java's ``\s``: space, tab, newline, vertical tab, form feed,
# carriage return.
WHITESPACE = " \t\n\x0b\x0c\r"


def strip_ws(col) -> Column:
    """Remove leading and trailing whitespace (tabs and newlines too); a
    character trim, no regular expression."""
    return F.trim(_c(col), F.lit(WHITESPACE))


def split_ws(col) -> Column:
    """Split on runs of whitespace, dropping empty pieces (``''`` -> ``[]``):
    whitespace is mapped to spaces and split on a single space."""
    spaced = F.translate(_c(col), WHITESPACE[1:], " " * (len(WHITESPACE) - 1))
    return F.array_remove(F.split(spaced, " "), "")


def csv_fields(line, sep: str = ",") -> Column:
    """The fields of a CSV line, as many as it has, without their quotes.

    ``"`` quotes a field that starts with it, doubled quotes stand for one; a
    quote left open reaches to the end of the line.  ``sep`` is one character.
    A line without any quote is split plainly.
    """
    c, e = _c(line), re.escape(sep)
    field = rf'{e}("(?:[^"]++|"")*+"?[^{e}]*|[^{e}]*)'
    quoted = F.transform(
        F.regexp_extract_all(F.concat(F.lit(sep), c), F.lit(field), F.lit(1)),
        lambda x: F.when(x.startswith('"'), F.replace(F.regexp_replace(x, r'(?s)^"(.*?)"?$', "$1"),
                                                      F.lit('""'), F.lit('"'))).otherwise(x))
    return F.when(c.contains('"'), quoted).otherwise(F.split(c, e, -1))


def last_index(arr, value: str) -> Column:
    """0-based index of the last element equal to ``value`` (NULL if none):
    a repeated header name takes the right-most column."""
    return F.array_max(F.transform(arr, lambda x, i: F.when(x == value, i)))


def nan_to_null(col) -> Column:
    """One missing value: NaN becomes NULL."""
    c = _c(col)
    return F.nanvl(c, F.lit(None).cast("double"))


def lenient_int(col, default: int) -> Column:
    """First run of ASCII digits as a ``decimal(38,0)``, ``default`` when there
    is none.

    ``"?8" -> 8``, ``"YP" -> default``, ``"-5" -> 5`` (sign ignored).  A run that
    the type cannot hold gives its largest value.
    """
    digits = F.regexp_extract(F.coalesce(_c(col).cast("string"), F.lit("")), "[0-9]+", 0)
    significant = F.ltrim(digits, F.lit("0"))
    return (F.when(digits == "", F.lit(default))
            .when(significant == "", F.lit(0))
            .otherwise(F.coalesce(significant.try_cast("decimal(38,0)"), F.lit("9" * 38).cast("decimal(38,0)")))
            .cast("decimal(38,0)"))


def clamp(col, lo, hi) -> Column:
    """``lo <= col <= hi``; NULL stays NULL (``least``/``greatest`` skip NULLs)."""
    c = _c(col)
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.greatest(lo_c, F.least(hi_c, c)))


def map_lookup(mapping: dict, key) -> Column:
    """Literal map lookup, folded by the optimizer; missing key -> NULL."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), _c(key))


def visibility_m(vv) -> Column:
    """Visibility code VV (two characters) to metres; non-digits -> NULL."""
    c = _c(vv)
    v = F.when(c.rlike("^[0-9]{2}$"), c.cast("int"))
    table = map_lookup({k: float(m) for k, m in codes.VISIBILITY_91_98.items()}, v)
    return (F.when(v <= 50, v * 100.0)
            .when(v <= 80, (v - 50) * 1000.0 + 5000.0)
            .when(v <= 89, (v - 80) * 5000.0 + 35000.0)
            .when(v.between(91, 98), table))


def tenths_signed(group) -> Column:
    """``sSTTT`` temperature-style group: sign digit 1 is negative, tenths."""
    g = _c(group)
    value = g.substr(3, 3).cast("int") / 10.0
    return F.when(g.isNull(), F.lit(None)).when(g.substr(2, 1) == "1", -value).otherwise(value)


def pressure_hpa(group) -> Column:
    """``3PPPP`` / ``4PPPP`` group to hPa; below 500 the leading 1 was dropped."""
    g = _c(group)
    p = g.substr(2, 4).cast("int") / 10.0
    return F.when(p < 500.0, p + 1000.0).otherwise(p)


def rain_mm(group) -> Column:
    """``6RRRt`` group to millimetres: 990 is a trace (0.1), 991-999 tenths."""
    g = _c(group)
    r = g.substr(2, 3).cast("int")
    return (F.when(r == 990, F.lit(0.1))
            .when(r >= 991, (r - 990) / 10.0)
            .otherwise(r.cast("double")))


def humidity_magnus(temp, dewpoint) -> Column:
    """Relative humidity (%) from air and dew-point temperature (deg C).

    August-Roche-Magnus approximation, rounded to one decimal and clamped to
    0-100.  NULL unless both inputs are present.
    """
    t, td = _c(temp), _c(dewpoint)
    a, b = F.lit(codes.MAGNUS_A), F.lit(codes.MAGNUS_B)
    rh = F.round(F.lit(100.0) * F.exp(a * td / (b + td) - a * t / (b + t)), 1)
    return F.when(t.isNotNull() & td.isNotNull(),
                  F.greatest(F.lit(0.0), F.least(F.lit(100.0), rh)))
