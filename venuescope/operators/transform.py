"""Raw listings -> clean venues (one projection) and venue -> cuisine rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuescope import config
from venuescope.config import Params, REFERENCE
from venuescope.functions import (
    city_tier, clean_cost, clean_location, clean_rating, clean_votes, coerce_flag,
    price_tier, standardise_city, strip_ws, without_commas,
)

# Raw role -> raw column name.
RAW_NAMES = {
    "name": "name", "city": "city", "area": "area", "cusine": "cusine",
    "rating": "rating", "rating_count": "rating_count", "cost_for_two": "cost_for_two",
    "online_order": "online_order", "table_reservation": "table_reservation",
    "delivery_only": "delivery_only",
}

CLEAN_COLUMNS = (
    "name", "city_clean", "city_tier", "location", "cusine", "rating", "votes",
    "cost_for_two", "price_tier", "has_online_order", "has_table_booking", "delivery_only",
)


def transform(raw: DataFrame, params: Params = REFERENCE, names: dict | None = None) -> DataFrame:
    """Every cleaning rule in one narrow projection; no row is dropped.

    Pure column expressions, so the whole step is one whole-stage-codegen
    span fused with the scan and no shuffle."""
    n = dict(RAW_NAMES, **(names or {}))
    dtypes = {f.name: f.dataType for f in raw.schema.fields}

    def flag(role):
        return coerce_flag(F.col(n[role]), dtypes.get(n[role]), params.legacy_flags)

    # what a rule names more than once is a step of its own, which Spark then works out once a row
    trimmed = raw.withColumns({"_city": strip_ws(F.col(n["city"])), "_cost": without_commas(F.col(n["cost_for_two"]))})
    stage = trimmed.select(
        F.col(n["name"]).alias("name"),
        standardise_city(F.col("_city"), params.city_map, stripped=True).alias("city_clean"),
        clean_location(F.col(n["area"])).alias("location"),
        F.col(n["cusine"]).alias("cusine"),
        clean_rating(F.col(n["rating"]), params.non_ratings).alias("rating"),
        clean_votes(F.col(n["rating_count"])).alias("votes"),
        clean_cost(F.col("_cost"), plain=True).alias("cost_for_two"),
        flag("online_order").alias("has_online_order"),
        flag("table_reservation").alias("has_table_booking"),
        flag("delivery_only").alias("delivery_only"),
    )
    return stage.select(
        "name", "city_clean",
        city_tier(F.col("city_clean"), params.tier1_cities).alias("city_tier"),
        "location", "cusine", "rating", "votes", "cost_for_two",
        price_tier(F.col("cost_for_two")).alias("price_tier"),
        "has_online_order", "has_table_booking", "delivery_only",
    )


def explode_cuisines(clean: DataFrame, drop_zero: bool = True, cuisine_col: str = "cusine") -> DataFrame:
    """One row per (venue, cuisine).

    A missing cell (and, with ``drop_zero``, the placeholder '0') becomes
    'Unknown'; pieces are stripped; empty pieces (and '0' pieces) are
    dropped; repeats inside a cell are kept.  ``drop_zero=False`` is the
    lenient notebook variant.  Generate + filter only: no shuffle."""
    cell = F.col(cuisine_col)
    missing = cell.isNull()
    if drop_zero:
        missing = missing | (cell == F.lit(config.CUISINE_MISSING))
    cell = F.when(missing, F.lit(config.CUISINE_UNKNOWN)).otherwise(cell)
    piece = F.explode(F.split(cell, ",")).alias("piece")
    out = clean.select("name", "city_clean", piece, "rating", "cost_for_two")
    out = out.select("name", "city_clean", strip_ws(F.col("piece")).alias("cuisine"),
                     "rating", "cost_for_two")
    keep = F.col("cuisine") != F.lit("")
    if drop_zero:
        keep = keep & (F.col("cuisine") != F.lit(config.CUISINE_MISSING))
    return out.where(keep)
