"""Null-safe scalar expressions (``Column -> Column``), all JVM-side.

NULL is the only missing value: NaN and +/-Inf are turned into NULL wherever
a double can appear, so aggregates never see them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: price band edges (half-open,
# lower edge included) and their labels, in order.
PRICE_BANDS = [
    ("Under $500K", float("-inf"), 500_000.0),
    ("$500K-$1M", 500_000.0, 1_000_000.0),
    ("$1M-$2M", 1_000_000.0, 2_000_000.0),
    ("$2M-$5M", 2_000_000.0, 5_000_000.0),
    ("$5M+", 5_000_000.0, float("inf")),
]

# A plain decimal or exponent literal, optionally signed; no suffixes, no
# thousands separators, no inf/nan words.
NUMERIC_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def known(x) -> Column:
    """A number as a double; NaN, which counts as missing everywhere, becomes NULL.  Infinities pass through."""
    c = _c(x).cast("double")
    return F.when(~F.isnan(c), c)


def finite_or_null(x) -> Column:
    """NaN, +Inf and -Inf become NULL; other values pass through."""
    c = _c(x)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(c)


def coerce_numeric(x) -> Column:
    """Lenient text/number -> double: anything unparsable becomes NULL."""
    c = _c(x)
    s = F.trim(c.cast("string"))
    parsed = F.when(s.rlike(NUMERIC_TEXT), s.try_cast("double"))
    return finite_or_null(parsed)


def safe_divide(num, den) -> Column:
    """num / den; a zero or NULL denominator and non-finite results give NULL."""
    return finite_or_null(F.try_divide(_c(num).cast("double"), _c(den).cast("double")))


def clip_lower(x, lower: float = 0.0) -> Column:
    """Like a lower clip: values below ``lower`` become ``lower``; NULL stays NULL."""
    c = _c(x)
    return F.when(c < F.lit(lower), F.lit(lower)).otherwise(c)


def log1p_clipped(x) -> Column:
    return F.log1p(clip_lower(x, 0.0))


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 with NULL counted as 0 (a missing value fails the test)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def band_label(x, bands=PRICE_BANDS) -> Column:
    """Label of the half-open band [lo, hi) that holds ``x``; NULL/NaN/+Inf -> NULL."""
    c = _c(x)
    expr = None
    for label, lo, hi in bands:
        cond = (c < F.lit(hi)) if lo == float("-inf") else ((c >= F.lit(lo)) & (c < F.lit(hi)))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def band_order(x, bands=PRICE_BANDS) -> Column:
    c = _c(x)
    expr = None
    for i, (_, lo, hi) in enumerate(bands, start=1):
        cond = (c < F.lit(hi)) if lo == float("-inf") else ((c >= F.lit(lo)) & (c < F.lit(hi)))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def slug(name, suffix: str = "") -> Column:
    """Lower case, spaces and hyphens to underscores, then a suffix."""
    return F.concat(F.translate(F.lower(_c(name)), " -", "__"), F.lit(suffix))


def slug_text(name: str, suffix: str = "") -> str:
    """Driver-side twin of ``slug`` for building column names."""
    return name.lower().replace(" ", "_").replace("-", "_") + suffix


def format_money(x, digits: int = 2) -> Column:
    """``$1,234.50`` (a minus sign, if any, comes before the dollar sign)."""
    c = _c(x)
    return F.when(c.isNull(), F.lit(None)).when(
        c < 0, F.concat(F.lit("-$"), F.format_number(-c, digits))
    ).otherwise(F.concat(F.lit("$"), F.format_number(c, digits)))


def _signed_number(c: Column, digits: int) -> Column:
    # format_number drops the sign of values that round to zero; keep it, as
    # Python's formatting does ("-0.0000").
    # (the text test also catches -0.0).
    neg = c.cast("string").startswith("-")
    return F.concat(F.when(neg, F.lit("-")).otherwise(F.lit("")), F.format_number(F.abs(c), digits))


def format_percent(x, digits: int = 2) -> Column:
    """``12.34%`` for a value already in percent units."""
    return F.concat(_signed_number(_c(x), digits), F.lit("%"))


def format_ratio(x, digits: int = 4) -> Column:
    return _signed_number(_c(x), digits)
