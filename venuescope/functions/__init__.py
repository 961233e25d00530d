"""Column -> Column building blocks (no Python UDFs: all JVM expressions)."""

from venuescope.functions.text import strip_ws, parse_double, nan_to_null, round_half_up
from venuescope.functions.clean import (
    clean_rating, clean_cost, standardise_city, price_tier, city_tier,
    coerce_flag, clean_votes, without_commas, clean_location,
)

__all__ = [
    "strip_ws", "parse_double", "nan_to_null", "round_half_up",
    "clean_rating", "clean_cost", "standardise_city", "price_tier", "city_tier",
    "coerce_flag", "clean_votes", "without_commas", "clean_location",
]
