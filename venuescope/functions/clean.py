"""Cleaning rules for one venue column each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, StringType

from venuescope import config
from venuescope.functions.text import NUMERIC_PATTERN, _c, parse_double, strip_ws


def clean_rating(c, non_ratings=config.NON_RATINGS) -> Column:
    """'4.1' -> 4.1; not-rated texts and garbage -> null.  No range check:
    '0.0' is kept as 0.0 while '0' means unrated."""
    return parse_double(c, without=[t.lower() for t in non_ratings])


def without_commas(c) -> Column:
    return F.replace(_c(c), F.lit(","), F.lit(""))


def clean_cost(c, plain: bool = False) -> Column:
    """'1,200' -> 1200.0; only strictly positive amounts survive.  ``plain``: ``c`` is ``without_commas`` already."""
    v = parse_double(c if plain else without_commas(c))
    # the amount named once: Spark would parse the text again for each mention
    return F.nullif(F.greatest(v, F.lit(0.0)), F.lit(0.0))


def standardise_city(c, city_map=None, stripped: bool = False) -> Column:
    """Trim and fold aliases (case-sensitive).  A small map is a literal map
    lookup inside the projection, no join."""
    city_map = config.CITY_MAP if city_map is None else city_map
    s = _c(c) if stripped else strip_ws(c)
    if not city_map:
        return s
    lut = F.create_map(*[F.lit(x) for kv in city_map.items() for x in kv])
    return F.coalesce(lut[s], s)


def price_tier(cost) -> Column:
    cost = _c(cost)
    expr = None
    for bound, label in config.PRICE_TIERS:
        if bound is None:
            expr = expr.otherwise(F.lit(label))
        else:
            cond = cost < F.lit(bound)
            expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.when(cost.isNull(), F.lit(config.PRICE_TIER_UNKNOWN)).otherwise(expr)


def city_tier(city, tier1=config.TIER1_CITIES) -> Column:
    """Null cities fall to the Tier 2+ branch, as in the original."""
    return F.when(_c(city).isin(*tier1), F.lit(config.TIER1_LABEL)).otherwise(F.lit(config.TIER2_LABEL))


TRUE_TEXT = ("true", "t", "yes", "y", "1", "1.0")
FALSE_TEXT = ("false", "f", "no", "n", "0", "0.0")


def coerce_flag(c, dtype: DataType | None = None, legacy: bool = False) -> Column:
    """Boolean flag from a boolean or text column.

    Text true/false spellings map to booleans.  Other text and nulls are null
    by default; ``legacy=True`` reproduces ``astype(bool)``: any non-empty
    text and a missing value are True."""
    c = _c(c)
    if isinstance(dtype, BooleanType):
        return F.coalesce(c, F.lit(True)) if legacy else c
    s = F.lower(strip_ws(c.cast(StringType())))
    known = F.when(s.isin(*TRUE_TEXT), F.lit(True)).when(s.isin(*FALSE_TEXT), F.lit(False))
    if legacy:
        return known.when(c.isNull(), F.lit(True)).otherwise(c.cast(StringType()) != F.lit(""))
    return known


def clean_votes(c) -> Column:
    """to-numeric, bad or beyond 64 bits -> 0, truncate toward zero."""
    v = parse_double(c, NUMERIC_PATTERN)
    # try_cast refuses what lies beyond 64 bits, but for the two ends, where doubles are too coarse to tell
    v = F.nullif(F.nullif(v, F.lit(2.0 ** 63)), F.lit(-2.0 ** 63))
    return F.coalesce(v.try_cast("long"), F.lit(0).cast("long"))


def clean_location(c) -> Column:
    """Trimmed locality; a missing value stays null (documented deviation:
    the original turns it into the text 'nan' in one load path only)."""
    return strip_ws(c)
