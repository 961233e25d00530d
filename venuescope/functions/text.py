"""Text -> number parsing with Python ``float()`` semantics, as Column math."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# What Python's float() accepts once surrounding whitespace is gone: digits
# with single underscores between them, optional point and exponent, or
# inf / infinity / nan with an optional sign (any case).
_DIGITS = r"\d(?:_?\d)*"
FLOAT_PATTERN = (
    r"^[+-]?(?:(?:(?:" + _DIGITS + r")?\." + _DIGITS + r"|" + _DIGITS + r"\.?)"
    r"(?:[eE][+-]?" + _DIGITS + r")?|(?i:inf|infinity|nan))$"
)
# pandas.to_numeric: no underscores.
NUMERIC_PATTERN = r"^[+-]?(?:(?:\d*\.\d+|\d+\.?)(?:[eE][+-]?\d+)?|(?i:inf|infinity|nan))$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Every character Python's str.strip() removes (derived by rule, not listed).
PY_WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip_ws(c) -> Column:
    """Python ``str.strip()``: drop leading/trailing whitespace of any kind.
    Spark's one-argument ``trim`` drops spaces only; trimming a character
    set looks at every character of the set, so it is left to texts that do not begin and end
    with a visible ASCII character once spaces are gone."""
    t = F.trim(_c(c))
    plain = F.ascii(t).between(33, 126) & F.ascii(F.right(t, F.lit(1))).between(33, 126)
    return F.when(plain, t).otherwise(F.trim(t, F.lit(PY_WHITESPACE)))


def nan_to_null(c) -> Column:
    """NaN -> null (one reference to ``c``, so the plan does not repeat it)."""
    return F.nanvl(_c(c), F.lit(None).cast("double"))


_WS_CLASS = "[" + "".join(f"\\x{{{ord(ch):x}}}" for ch in PY_WHITESPACE) + "]*"
PLAIN_PATTERN = r"\d{1,15}(?:\.\d{1,15})?"      # what every parser reads alike


def parse_double(c, pattern: str = FLOAT_PATTERN, without=()) -> Column:
    """Text to double; anything Python would reject becomes null, and so do the texts of ``without``
    (in any case).

    Plain decimals are cast at once.  For all else the regex keeps Spark from accepting forms Python refuses
    (``4.1d``), underscores between digits are dropped before the cast, and NaN is mapped to null so no NaN
    survives cleaning (Spark orders NaN above every number).  ``c`` is named several times: give it as a
    column of its own, not as the expression that builds the text."""
    x = _c(c)
    not_these = "".join(rf"(?!(?i:\Q{t}\E){_WS_CLASS}$)" for t in without if re.search(pattern, t))
    number = F.regexp_extract(x, f"^{_WS_CLASS}{not_these}({pattern.removeprefix('^').removesuffix('$')}){_WS_CLASS}$", 1)
    # what does not match comes out empty; a cast of that would build an exception first
    other = nan_to_null(F.nullif(F.replace(number, F.lit("_"), F.lit("")), F.lit("")).try_cast("double"))
    return F.when(x.rlike(f"^{not_these}{PLAIN_PATTERN}$"), x.try_cast("double")).otherwise(other)


def round_half_up(c, digits: int) -> Column:
    """Round half away from zero.

    The twelfth decimal is where sums of doubles differ by their order; what
    lies beyond is noise, so the value is read to twelve decimals and rounded
    there.  Beyond 1e26, where a DECIMAL(38,12) ends, a double has no decimals
    left to round: it stays, as do +-inf and NaN."""
    x = _c(c)
    r = F.round(x.try_cast("decimal(38,12)"), digits).cast("double")
    return F.when(r.isNull() & x.isNotNull(), x).otherwise(r)


def round_doubles(df, digits: int = 9, skip=()):
    """Present every double column rounded to ``digits`` decimals (for
    reports and engine-independent comparison); other columns unchanged."""
    from pyspark.sql.types import DoubleType, FloatType

    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)) and f.name not in skip:
            cols.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
