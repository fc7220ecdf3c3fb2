"""Scalar column expressions shared by the operators.

All are compositions of built-in functions, so they stay inside whole-stage
codegen.  Money stays ``decimal(18,4)`` through arithmetic and is rounded
half-up as a decimal; it is converted to ``double`` only for output.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import AGE_BANDS, OLDEST_BAND, UNKNOWN_BAND


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def age_group(age="Age") -> Column:
    """Nine age bands; NULL or negative age is 'Unknown'."""
    a = _c(age)
    expr = None
    for label, lo, hi in AGE_BANDS:
        cond = a.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.when(a >= OLDEST_BAND[1], OLDEST_BAND[0]).otherwise(UNKNOWN_BAND)


def age_group_of_profile(age="age") -> Column:
    """Band of a looked-up age: like ``age_group``; NULL outside 0-150, so that such a profile
    matches nothing."""
    a = _c(age)
    expr = None
    for label, _lo, hi in AGE_BANDS:
        expr = F.when(a <= hi, label) if expr is None else expr.when(a <= hi, label)
    return F.when(a.between(0, 150), expr.otherwise(OLDEST_BAND[0]))


def length_of_stay(discharge="DischargeDate", admission="DateOfAdmission") -> Column:
    return F.datediff(_c(discharge), _c(admission))


def cost_per_day(billing="BillingAmount", los="LengthOfStay") -> Column:
    """Billing per day of stay; NULL for a stay of 0 days (or unknown)."""
    return F.when(_c(los) > 0, _c(billing) / _c(los))


def admission_month(d="DateOfAdmission") -> Column:
    return F.date_format(_c(d), "yyyy-MM")


# The characters Python's str.strip() treats as whitespace
# (str.isspace over the whole Unicode range), so trimming matches the reference.
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
              "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
              "\u2028\u2029\u202f\u205f\u3000")


def strip_ws(col) -> Column:
    """Remove leading/trailing whitespace of any kind (plain ``trim`` only drops spaces).

    Fast path: a value whose first and last characters are printable ASCII is
    returned as is (two one-character substrings, no scan).  Otherwise the native
    character-set ``TRIM(BOTH <whitespace> FROM x)`` runs — never a regex.
    """
    x = _c(col)
    first, last = F.substring(x, 1, 1), F.substring(x, -1, 1)
    edge = ((first <= F.lit(" ")) | (first >= F.lit("\x80"))
            | (last <= F.lit(" ")) | (last >= F.lit("\x80")))
    return F.when(edge, F.trim(x, F.lit(WHITESPACE))).otherwise(x)


def money(col, scale: int = 2) -> Column:
    """Round a decimal half-up and hand it out as double."""
    return F.round(_c(col), scale).cast("double")


def round_double(col, scale: int) -> Column:
    return F.round(_c(col).cast("double"), scale)


def avg_money(col="BillingAmount", scale: int = 2) -> Column:
    """``ROUND(AVG(decimal), scale)`` — exact decimal average, half-up."""
    return money(F.avg(_c(col)), scale)


def avg_int1(col) -> Column:
    """``ROUND(AVG(int), 1)`` with the average kept as an exact decimal (4 extra digits)."""
    return F.round(F.avg(_c(col).cast("decimal(20,0)")), 1).cast("double")


def collated(col, collation: str | None = None) -> Column:
    """Optionally compare/group a string column under a collation, e.g. ``UNICODE_CI_AI``
    (case- and accent-insensitive, like the reference database's default)."""
    return F.collate(_c(col), collation) if collation else _c(col)


def python_float(x: Column) -> Column:
    """A double as Python prints it: shortest digits, plain from 1e-4 up to 1e16, else as 1.5e-05."""
    s = x.cast("double").cast("string")
    part = lambda g: F.regexp_extract(s, r"^-?([0-9])\.([0-9]+)E(-?[0-9]+)$", g)
    sign, e = F.when(s.startswith("-"), "-").otherwise(""), part(3).try_cast("int")
    more = F.when(part(2) == "0", "").otherwise(part(2))
    digits = F.concat(part(1), more)
    wide = F.rpad(digits, F.greatest(e + 1, F.length(digits)), F.lit("0"))
    rest = F.substr(wide, e + 2)
    plain = F.concat(sign, F.substr(wide, F.lit(1), e + 1), F.lit("."), F.when(rest == "", "0").otherwise(rest))
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)
    power = F.concat(F.when(e < 0, "e-").otherwise("e+"), F.lpad(F.abs(e).cast("string"), F.greatest(F.lit(2), F.length(F.abs(e).cast("string"))), F.lit("0")))
    far = F.concat(sign, part(1), F.when(more == "", "").otherwise(F.concat(F.lit("."), more)), power)
    named = F.when(s == "Infinity", "inf").when(s == "-Infinity", "-inf").when(s == "NaN", "nan")
    return F.coalesce(named, F.when(e.isNull(), s).when((e >= 0) & (e < 16), plain).when((e < 0) & (e >= -4), small).otherwise(far))
