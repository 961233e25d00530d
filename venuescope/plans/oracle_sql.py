"""ANSI SQL (DuckDB dialect) restating each catalogued query.

Used only as the correctness oracle: the same binding, cleaning rules and
query shapes restated as SQL over the raw test tables.  Patterns, the white
space set, rounding and the t quantile are written here in their own terms;
only the parameters (config) are shared.  Every
statement is self-contained (CTEs), so it runs against the pre-registered
table views alone.
"""

from __future__ import annotations

from venuescope import config
from venuescope.config import TEST_BINDING as P


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lits(xs) -> str:
    return ", ".join(lit(x) for x in xs)


# white space by code point: tab..carriage return, the separators 28..31, space, next line,
# no-break space and the Unicode spaces
_WS = " || ".join(f"chr({c})" for c in (*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203),
                                        8232, 8233, 8239, 8287, 12288))

_INT = "[0-9]+"
_INT_US = "[0-9]+(_[0-9]+)*"


def _number(digits: str) -> str:
    """A decimal number, an infinity or a NaN, as text that a float parser accepts."""
    return (f"[-+]?((({digits})[.]?|({digits})?[.]({digits}))([eE][-+]?{digits})?"
            "|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])")


FLOAT_PATTERN, NUMERIC_PATTERN = _number(_INT_US), _number(_INT)


def strip(x: str) -> str:
    return f"trim({x}, {_WS})"


def parse(x: str, pattern: str = FLOAT_PATTERN) -> str:
    s = strip(x)
    v = f"TRY_CAST(replace({s}, '_', '') AS DOUBLE)"
    return f"(CASE WHEN regexp_full_match({s}, {lit(pattern)}) AND NOT isnan({v}) THEN {v} END)"


def rnd(x: str, n: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,12)), {n}) AS DOUBLE)"


def _city(x: str) -> str:
    s = strip(x)
    if not P.city_map:
        return s
    arms = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in P.city_map.items())
    return f"(CASE {s} {arms} ELSE {s} END)"


def _price_tier(x: str) -> str:
    arms = []
    for bound, label in config.PRICE_TIERS:
        arms.append(f"WHEN {x} < {bound} THEN {lit(label)}" if bound is not None else f"ELSE {lit(label)}")
    return f"(CASE WHEN {x} IS NULL THEN {lit(config.PRICE_TIER_UNKNOWN)} {' '.join(arms)} END)"


RAW_VENUES = """raw_venues AS (
  SELECT c.c_name AS name,
         ' ' || n.n_name || ' ' AS city,
         p.p_brand AS area,
         CASE WHEN p.p_size = 1 THEN '0' ELSE replace(p.p_name, ' ', ', ') END AS cusine,
         CASE WHEN l.l_discount = 0 THEN 'NEW'
              WHEN l.l_linenumber = 7 THEN '0'
              WHEN l.l_linenumber = 6 AND l.l_returnflag = 'R' THEN 'Nov...'
              ELSE CAST(CAST(l.l_discount * 50 AS DECIMAL(3,1)) AS VARCHAR) END AS rating,
         CAST(CAST(trunc(l.l_quantity) AS INTEGER) AS VARCHAR) AS rating_count,
         CASE WHEN l.l_quantity < 2 THEN '0'
              ELSE format('{:,}', CAST(floor(l.l_extendedprice / 50) AS BIGINT)) END AS cost_for_two,
         l.l_returnflag = 'N' AS online_order,
         l.l_linestatus = 'O' AS table_reservation,
         l.l_linenumber = 1 AS delivery_only
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey)"""

_votes = parse("rating_count", NUMERIC_PATTERN)
_rating = (f"CASE WHEN lower({strip('rating')}) IN ({lits(config.NON_RATINGS)}) THEN NULL "
           f"ELSE {parse('rating')} END")
_cost = parse("replace(cost_for_two, ',', '')")

STAGED = f"""staged AS (
  SELECT name,
         {_city('city')} AS city_clean,
         {strip('area')} AS location,
         cusine,
         {_rating} AS rating,
         CASE WHEN {_votes} IS NOT NULL AND abs({_votes}) < 9223372036854775808
              THEN CAST(trunc({_votes}) AS BIGINT) ELSE 0 END AS votes,
         CASE WHEN {_cost} > 0 THEN {_cost} END AS cost_for_two,
         online_order AS has_online_order,
         table_reservation AS has_table_booking,
         delivery_only
  FROM raw_venues)"""

RESTAURANTS = f"""restaurants AS (
  SELECT name, city_clean,
         CASE WHEN city_clean IN ({lits(P.tier1_cities)}) THEN {lit(config.TIER1_LABEL)}
              ELSE {lit(config.TIER2_LABEL)} END AS city_tier,
         location, cusine, rating, votes, cost_for_two,
         {_price_tier('cost_for_two')} AS price_tier,
         has_online_order, has_table_booking, delivery_only
  FROM staged)"""


def _cuisines(drop_zero: bool = True, name: str = "restaurant_cuisines") -> str:
    missing = "cusine IS NULL OR cusine = '0'" if drop_zero else "cusine IS NULL"
    keep = "cuisine <> '' AND cuisine <> '0'" if drop_zero else "cuisine <> ''"
    return f"""{name} AS (
  SELECT name, city_clean, cuisine, rating, cost_for_two FROM (
    SELECT name, city_clean, {strip('piece')} AS cuisine, rating, cost_for_two
    FROM (SELECT name, city_clean, rating, cost_for_two,
                 unnest(string_split(CASE WHEN {missing} THEN 'Unknown' ELSE cusine END, ',')) AS piece
          FROM restaurants))
  WHERE {keep})"""


CUISINES = _cuisines()
BASE = f"WITH {RAW_VENUES},\n{STAGED},\n{RESTAURANTS},\n{CUISINES}"


def with_base(body: str, *extra_ctes: str) -> str:
    ctes = "".join(f",\n{c}" for c in extra_ctes)
    return f"{BASE}{ctes}\n{body}"


def n_true(flag: str) -> str:
    return f"CAST(SUM(CASE WHEN {flag} THEN 1 ELSE 0 END) AS BIGINT)"


SQL: dict[str, str] = {}
BODY: dict[str, str] = {}

BODY["q1"] = (f"""
SELECT city_clean, city_tier, COUNT(*) AS total_restaurants,
       {rnd('AVG(rating)', 2)} AS avg_rating, {rnd('AVG(cost_for_two)', 0)} AS avg_cost
FROM restaurants WHERE city_clean IS NOT NULL
GROUP BY city_clean, city_tier
ORDER BY total_restaurants DESC, city_clean ASC, city_tier ASC
LIMIT {P.q1_limit}""")

BODY["q2"] = (f"""
SELECT cuisine, COUNT(DISTINCT name) AS restaurant_count,
       {rnd('AVG(rating)', 2)} AS avg_rating, {rnd('AVG(cost_for_two)', 0)} AS avg_cost
FROM restaurant_cuisines
WHERE cuisine NOT IN ('Unknown', '0') AND rating IS NOT NULL
GROUP BY cuisine
HAVING COUNT(DISTINCT name) > {P.q2_min_names}
ORDER BY avg_rating DESC NULLS LAST, restaurant_count ASC, cuisine ASC
LIMIT {P.q2_limit}""")

BODY["q3"] = (f"""
SELECT city_clean, COUNT(*) AS total, {n_true('has_online_order')} AS online_count,
       {rnd('100.0 * SUM(CASE WHEN has_online_order THEN 1 ELSE 0 END) / COUNT(*)', 1)} AS online_pct
FROM restaurants
GROUP BY city_clean
HAVING COUNT(*) > {P.q3_min_total}
ORDER BY online_pct ASC, city_clean ASC NULLS FIRST""")

BODY["q4"] = (f"""
SELECT price_tier, COUNT(*) AS restaurant_count, {rnd('AVG(rating)', 2)} AS avg_rating,
       COUNT(CASE WHEN rating >= {P.high_rating} THEN 1 END) AS high_rated_count,
       {rnd(f'100.0 * COUNT(CASE WHEN rating >= {P.high_rating} THEN 1 END) / COUNT(*)', 1)} AS high_rated_pct
FROM restaurants
WHERE price_tier <> 'Unknown' AND rating IS NOT NULL
GROUP BY price_tier
ORDER BY avg_rating DESC, price_tier ASC""")

BODY["q5"] = (f"""
SELECT * FROM (
  SELECT city_clean, COUNT(*) AS restaurant_count, {rnd('AVG(rating)', 2)} AS avg_rating,
         {rnd('AVG(cost_for_two)', 0)} AS avg_cost, {n_true('has_online_order')} AS online_ready
  FROM restaurants
  WHERE city_tier = {lit(P.q5_tier)} AND rating IS NOT NULL
  GROUP BY city_clean) t
WHERE restaurant_count BETWEEN {P.q5_min_count} AND {P.q5_max_count}
  AND avg_rating >= {P.q5_min_avg_rating}
ORDER BY avg_rating DESC, restaurant_count ASC, city_clean ASC NULLS FIRST
LIMIT {P.q5_limit}""")

BODY["q6"] = (f"""
SELECT location, COUNT(*) AS restaurants, {rnd('AVG(rating)', 2)} AS avg_rating,
       {rnd('AVG(cost_for_two)', 0)} AS avg_cost, {n_true('has_online_order')} AS online_count
FROM restaurants
WHERE city_clean = {lit(P.q6_city)} AND rating IS NOT NULL
GROUP BY location
HAVING COUNT(*) >= {P.q6_min_count}
ORDER BY avg_rating ASC, restaurants DESC, location ASC NULLS FIRST
LIMIT {P.q6_limit}""")

BODY["q7"] = (f"""
SELECT city_clean, cuisine, COUNT(*) AS count, {rnd('AVG(rating)', 2)} AS avg_rating
FROM restaurant_cuisines
WHERE cuisine IN ({lits(P.q7_cuisines)}) AND city_clean IN ({lits(P.q7_cities)})
GROUP BY city_clean, cuisine
ORDER BY city_clean, count DESC, cuisine""")

_online = "100.0 * SUM(CASE WHEN has_online_order THEN 1 ELSE 0 END) / COUNT(*)"
BODY["q8"] = (f"""
SELECT city_clean, city_tier, COUNT(*) AS restaurant_count, {rnd('AVG(rating)', 2)} AS avg_rating,
       {rnd(_online, 1)} AS online_pct, {rnd('AVG(cost_for_two)', 0)} AS avg_cost,
       {rnd(f'AVG(rating) * 20 + {_online} * 0.3 - COUNT(*) * 0.001', 1)} AS opportunity_score
FROM restaurants
WHERE rating IS NOT NULL
GROUP BY city_clean, city_tier
HAVING COUNT(*) >= {P.q8_min_count}
ORDER BY opportunity_score DESC, city_clean ASC NULLS FIRST, city_tier ASC
LIMIT {P.q8_limit}""")

for _k in list(BODY):
    SQL[_k] = with_base(BODY[_k])


def r9(x: str) -> str:
    return f"ROUND({x}, 9)"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


# --- cleaning rules ----------------------------------------------------------
def _mapping(raw_col: str, out_col: str, expr: str) -> str:
    return with_base(f"""
SELECT {raw_col}_raw, {out_col}, COUNT(*) AS n FROM (
  SELECT {raw_col} AS {raw_col}_raw, {expr} AS {out_col} FROM raw_venues) t
GROUP BY {raw_col}_raw, {out_col}""")


SQL["clean_rating"] = _mapping("rating", "rating", _rating)
SQL["clean_cost"] = _mapping("cost_for_two", "cost_for_two", f"CASE WHEN {_cost} > 0 THEN {_cost} END")
SQL["clean_votes"] = _mapping(
    "rating_count", "votes",
    f"CASE WHEN {_votes} IS NOT NULL AND abs({_votes}) < 9223372036854775808 THEN CAST(trunc({_votes}) AS BIGINT) ELSE 0 END")
SQL["standardise_city"] = _mapping("city", "city_clean", _city("city"))
SQL["clean_location"] = _mapping("area", "location", strip("area"))
SQL["price_tier"] = with_base("""
SELECT price_tier, COUNT(*) AS n, MIN(cost_for_two) AS min_cost, MAX(cost_for_two) AS max_cost
FROM restaurants GROUP BY price_tier""")
SQL["city_tier"] = with_base("SELECT city_clean, city_tier, COUNT(*) AS n FROM restaurants GROUP BY city_clean, city_tier")
SQL["clean_flags"] = with_base("""
SELECT has_online_order, has_table_booking, delivery_only, COUNT(*) AS n
FROM restaurants GROUP BY has_online_order, has_table_booking, delivery_only""")
SQL["transform"] = with_base("SELECT * FROM restaurants")
SQL["explode_cuisines"] = with_base("SELECT * FROM restaurant_cuisines")
SQL["explode_cuisines_lenient"] = with_base("SELECT * FROM lenient", _cuisines(False, "lenient"))

# --- publish and export ------------------------------------------------------
SQL["publish_tables"] = with_base("""
SELECT 'restaurants' AS table_name, COUNT(*) AS rows, CAST(0 AS BIGINT) AS zero_cuisines FROM restaurants
UNION ALL
SELECT 'restaurant_cuisines', COUNT(*), COUNT(*) FILTER (WHERE cuisine = '0') FROM restaurant_cuisines""")
SQL["query_export_counts"] = with_base("\nUNION ALL\n".join(
    f"SELECT '{k}_results.csv' AS file_name, COUNT(*) AS rows FROM ({BODY[k]}) t_{k}" for k in BODY))

# --- quality and profiling ---------------------------------------------------
SQL["quality_report"] = with_base(f"""
SELECT *, CASE WHEN data_quality_pct >= {P.quality_threshold} THEN 'PASS'
               ELSE 'FAIL - quality ' || CAST(data_quality_pct AS VARCHAR) || '% below {P.quality_threshold}% threshold' END
          AS pipeline_status
FROM (
  SELECT rows_read, rows_after_cleaning, duplicate_rows_in_raw, missing_ratings_new_restaurants,
         missing_costs, invalid_cities, structurally_valid_rows,
         CASE WHEN rows_read > 0 THEN {rnd(f"{dbl('100.0')} * structurally_valid_rows / rows_read", 2)}
              ELSE 0.0 END AS data_quality_pct
  FROM (
    SELECT (SELECT COUNT(*) FROM raw_venues) AS rows_read,
           COUNT(*) AS rows_after_cleaning,
           (SELECT COUNT(*) FROM raw_venues) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM raw_venues) d)
             AS duplicate_rows_in_raw,
           COUNT(*) FILTER (WHERE rating IS NULL) AS missing_ratings_new_restaurants,
           COUNT(*) FILTER (WHERE cost_for_two IS NULL) AS missing_costs,
           COUNT(*) FILTER (WHERE city_clean IS NULL) AS invalid_cities,
           COUNT(*) FILTER (WHERE cost_for_two IS NOT NULL AND city_clean IS NOT NULL) AS structurally_valid_rows
    FROM restaurants) a) b""")

RAW_VIEW_TYPES = (("name", "string"), ("city", "string"), ("area", "string"), ("cusine", "string"),
                  ("rating", "string"), ("rating_count", "string"), ("cost_for_two", "string"),
                  ("online_order", "boolean"), ("table_reservation", "boolean"), ("delivery_only", "boolean"))
SQL["profile_shape"] = with_base(f"""
SELECT column_name, position, data_type, (SELECT COUNT(*) FROM raw_venues) AS n_rows,
       CAST({len(RAW_VIEW_TYPES)} AS BIGINT) AS n_columns
FROM (VALUES {", ".join(f"({lit(c)}, {i + 1}, {lit(t)})" for i, (c, t) in enumerate(RAW_VIEW_TYPES))})
     AS t(column_name, position, data_type)""")

CLEAN_COLS = ("name", "city_clean", "city_tier", "location", "cusine", "rating", "votes", "cost_for_two",
              "price_tier", "has_online_order", "has_table_booking", "delivery_only")
SQL["profile_nulls"] = with_base(f"""
SELECT column_name, null_count FROM (
  UNPIVOT (SELECT {", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in CLEAN_COLS)} FROM restaurants)
  ON {", ".join(CLEAN_COLS)} INTO NAME column_name VALUE null_count)
ORDER BY null_count DESC, column_name""")
RAW_COLS = tuple(c for c, _ in RAW_VIEW_TYPES)
SQL["profile_raw_nulls"] = with_base(f"""
SELECT column_name, null_count FROM (
  UNPIVOT (SELECT {", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in RAW_COLS)} FROM raw_venues)
  ON {", ".join(RAW_COLS)} INTO NAME column_name VALUE null_count)
ORDER BY null_count DESC, column_name""")
SQL["profile_value_counts"] = with_base("""
SELECT rating, COUNT(*) AS count FROM raw_venues GROUP BY rating
ORDER BY count DESC, rating ASC NULLS FIRST LIMIT 15""")
SQL["profile_comma_count"] = with_base(
    "SELECT COUNT(*) FILTER (WHERE COALESCE(contains(cost_for_two, ','), FALSE)) AS n_containing FROM raw_venues")
SQL["profile_exact_dups"] = """
SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicates
FROM (SELECT COUNT(*) AS n FROM documents GROUP BY lang, source, text) t"""
SQL["profile_logical_dups"] = """
SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicates
FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) t"""
SQL["profile_distinct"] = with_base("SELECT COUNT(DISTINCT city_clean) AS n_distinct FROM restaurants")
SQL["profile_data_loss"] = with_base(f"""
SELECT (SELECT COUNT(*) FROM raw_venues) AS rows_read, COUNT(*) AS rows_kept,
       COUNT(*) FILTER (WHERE rating IS NULL) AS unrated,
       {r9(f"{dbl('100.0')} * COUNT(*) FILTER (WHERE rating IS NULL) / COUNT(*)")} AS unrated_pct,
       COUNT(*) FILTER (WHERE cost_for_two IS NULL) AS invalid_costs,
       COUNT(DISTINCT city_clean) AS distinct_cities,
       COUNT(*) FILTER (WHERE cost_for_two IS NOT NULL AND city_clean IS NOT NULL) AS valid_cost_city,
       {r9(f"{dbl('100.0')} * COUNT(*) FILTER (WHERE cost_for_two IS NOT NULL AND city_clean IS NOT NULL) / COUNT(*)")}
         AS valid_pct
FROM restaurants""")

# --- scoring and anomalies ---------------------------------------------------
_W = P.weights
_FACT = (("avg_rating", "rating"), ("demand_index", "demand"), ("online_pct", "online"),
         ("market_gap", "gap"), ("competition_density", "competition"))
_score = " + ".join(
    f"{dbl(repr(_W[k]))} * COALESCE(({x} - min_{x}) / NULLIF(max_{x} - min_{x}, 0), {dbl('0.0')})" for x, k in _FACT)
SQL["city_opportunity"] = with_base(f"""
SELECT city_clean, restaurant_count, {r9('avg_rating')} AS avg_rating, demand_index, {r9('online_pct')} AS online_pct,
       {r9('market_gap')} AS market_gap, competition_density, {r9(f'({_score}) * 100')} AS opportunity_score
FROM s, mm
ORDER BY opportunity_score DESC, city_clean""", f"""m AS (
  SELECT city_clean, COUNT(*) AS restaurant_count, AVG(rating) AS avg_rating,
         CAST(SUM(votes) AS BIGINT) AS demand_index,
         AVG(CAST(has_online_order AS DOUBLE)) * 100 AS online_pct,
         AVG(CAST(COALESCE(rating >= {P.high_rating}, FALSE) AS DOUBLE)) * 100 AS market_gap,
         COUNT(*) AS competition_density
  FROM restaurants WHERE city_clean IS NOT NULL GROUP BY city_clean)""",
    f"s AS (SELECT * FROM m WHERE avg_rating IS NOT NULL AND restaurant_count >= {P.min_city_venues})",
    "mm AS (SELECT " + ", ".join(f"MIN({x}) AS min_{x}, MAX({x}) AS max_{x}" for x, _ in _FACT) + " FROM s)")

_EV_Q = """b AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
       FROM events WHERE value IS NOT NULL AND NOT isnan(value))"""
SQL["anom_iqr"] = f"""WITH {_EV_Q}
SELECT event_id, value, COALESCE(value < q1 - (q3 - q1) * 1.5 OR value > q3 + (q3 - q1) * 1.5, FALSE) AS anom_iqr
FROM events, b"""
SQL["anom_iqr_bounds"] = f"""WITH {_EV_Q}
SELECT {r9('q1')} AS q1, {r9('q3')} AS q3, {r9('q3 - q1')} AS iqr,
       {r9('q1 - (q3 - q1) * 1.5')} AS lower, {r9('q3 + (q3 - q1) * 1.5')} AS upper FROM b"""
SQL["anom_zscore"] = """WITH st AS (SELECT AVG(value) AS m, STDDEV_POP(value) AS sd FROM events)
SELECT event_id, value, COALESCE(abs((value - m) / NULLIF(sd, 0)) > 3.0, FALSE) AS anom_zscore FROM events, st"""
SQL["anom_business_risk"] = with_base(f"""
SELECT r.*, COALESCE(r.cost_for_two > p.p75 AND r.rating < {P.low_rating}, FALSE) AS operational_risk
FROM restaurants r LEFT JOIN p ON r.city_clean = p.city_clean""", """p AS (
  SELECT city_clean, quantile_cont(cost_for_two, 0.75) AS p75 FROM restaurants
  WHERE city_clean IS NOT NULL AND cost_for_two IS NOT NULL GROUP BY city_clean)""")

# --- exploratory questions ---------------------------------------------------
def _top(src: str, col: str, k: int, where: str = "") -> str:
    cond = f"{col} IS NOT NULL" + (f" AND {where}" if where else "")
    return with_base(f"""
SELECT {col}, COUNT(*) AS count FROM {src} WHERE {cond}
GROUP BY {col} ORDER BY count DESC, {col} LIMIT {k}""")


SQL["e1_city_counts"] = _top("restaurants", "city_clean", P.e1_top)
SQL["e4_top_cuisines"] = _top("restaurant_cuisines", "cuisine", P.e4_top)
SQL["e8_city_localities"] = _top("restaurants", "location", P.e8_top, f"city_clean = {lit(P.e8_city)}")

_B = P.e2_bins


def _edge(i: str) -> str:
    return f"(CASE WHEN {i} >= {_B} THEN hi ELSE {i} * step + lo END)"


SQL["e2_rating_histogram"] = with_base(f"""
SELECT grid.bin, {r9(_edge('grid.bin'))} AS bin_lower, {r9(_edge('(grid.bin + 1)'))} AS bin_upper,
       COALESCE(c.count, 0) AS count, {r9('mean')} AS mean
FROM grid LEFT JOIN c ON grid.bin = c.bin, g2
ORDER BY grid.bin""",
    "hs AS (SELECT CAST(rating AS DOUBLE) AS x FROM restaurants WHERE rating IS NOT NULL AND NOT isnan(rating))",
    "hst AS (SELECT MIN(x) AS mn, MAX(x) AS mx, AVG(x) AS mean FROM hs)",
    """g AS (SELECT CASE WHEN mx > mn THEN mn ELSE mn - 0.5 END AS lo,
                CASE WHEN mx > mn THEN mx ELSE mx + 0.5 END AS hi, mean FROM hst)""",
    f"g2 AS (SELECT lo, hi, (hi - lo) / {_B} AS step, mean FROM g)",
    f"""t0 AS (SELECT x, lo, hi, step,
                 LEAST(CAST(floor((x - lo) * ({dbl(str(_B))} / (hi - lo))) AS BIGINT), {_B - 1}) AS i0 FROM hs, g2)""",
    f"t1 AS (SELECT x, lo, hi, step, CASE WHEN x < {_edge('i0')} THEN i0 - 1 ELSE i0 END AS i1 FROM t0)",
    f"""t2 AS (SELECT CASE WHEN x >= {_edge('(i1 + 1)')} AND i1 <> {_B - 1} THEN i1 + 1 ELSE i1 END AS bin
          FROM t1)""",
    "c AS (SELECT CAST(bin AS INTEGER) AS bin, COUNT(*) AS count FROM t2 GROUP BY bin)",
    f"grid AS (SELECT CAST(range AS INTEGER) AS bin FROM range({_B}))")

SQL["e3_online_rating"] = with_base(f"""
SELECT has_online_order, {r9('AVG(rating)')} AS avg_rating FROM restaurants
WHERE has_online_order IS NOT NULL GROUP BY has_online_order""")
SQL["e5_box_top_cities"] = with_base(f"""
SELECT city_clean, {r9('q1')} AS q1, {r9('median')} AS median, {r9('q3')} AS q3, {r9('q3 - q1')} AS iqr,
       COUNT(*) AS n,
       {r9('MIN(CASE WHEN cost_for_two >= q1 - (q3 - q1) * 1.5 THEN cost_for_two END)')} AS whisker_low,
       {r9('MAX(CASE WHEN cost_for_two <= q3 + (q3 - q1) * 1.5 THEN cost_for_two END)')} AS whisker_high,
       COUNT(*) FILTER (WHERE cost_for_two < q1 - (q3 - q1) * 1.5 OR cost_for_two > q3 + (q3 - q1) * 1.5)
         AS n_outliers
FROM sub JOIN q USING (city_clean)
WHERE cost_for_two IS NOT NULL
GROUP BY city_clean, q1, median, q3
ORDER BY city_clean""",
    f"""top AS (SELECT city_clean FROM restaurants WHERE city_clean IS NOT NULL GROUP BY city_clean
            ORDER BY COUNT(*) DESC, city_clean LIMIT {P.e5_top_cities})""",
    "sub AS (SELECT * FROM restaurants WHERE city_clean IN (SELECT city_clean FROM top))",
    """q AS (SELECT city_clean, quantile_cont(cost_for_two, 0.25) AS q1, quantile_cont(cost_for_two, 0.5) AS median,
               quantile_cont(cost_for_two, 0.75) AS q3
        FROM sub WHERE cost_for_two IS NOT NULL GROUP BY city_clean)""")
SQL["e6_service_mix"] = with_base(f"""
SELECT service, {r9('pct')} AS pct FROM (
  UNPIVOT (SELECT AVG(CAST(has_online_order AS DOUBLE)) * 100 AS "Online order",
                  AVG(CAST(has_table_booking AS DOUBLE)) * 100 AS "Table booking",
                  AVG(CAST(delivery_only AS DOUBLE)) * 100 AS "Delivery only" FROM restaurants)
  ON "Online order", "Table booking", "Delivery only" INTO NAME service VALUE pct)""")
SQL["e7_sample"] = with_base(f"""
SELECT name, city_clean, rating, cost_for_two FROM restaurants
WHERE rating IS NOT NULL AND cost_for_two IS NOT NULL
ORDER BY md5('{P.seed}' || '|' || coalesce(name, 'null') || '|' || coalesce(city_clean, 'null') || '|' ||
             CAST(rating AS VARCHAR) || '|' || CAST(cost_for_two AS VARCHAR))
LIMIT {P.e7_sample_size}""")
SQL["e7_rating_cost_corr"] = with_base(f"SELECT {r9('corr(rating, cost_for_two)')} AS corr FROM restaurants")
SQL["e9_tier_compare"] = with_base(f"""
SELECT city_tier, {r9('AVG(rating)')} AS avg_rating, {r9('AVG(cost_for_two)')} AS avg_cost_for_two
FROM restaurants WHERE city_tier IS NOT NULL GROUP BY city_tier ORDER BY city_tier""")
_TIERS = [label for _, label in config.PRICE_TIERS]
SQL["e10_price_tier_share"] = with_base(f"""
SELECT c.price_tier, tier_order, count, {r9(f"{dbl('100.0')} * count / SUM(count) OVER ()")} AS share_pct
FROM c JOIN cats ON c.price_tier = cats.price_tier
ORDER BY tier_order""",
    f"""cats AS (SELECT * FROM (VALUES {", ".join(f"({lit(t)}, {i + 1})" for i, t in enumerate(_TIERS))})
           AS v(price_tier, tier_order))""",
    f"""c AS (SELECT price_tier, COUNT(*) AS count FROM restaurants WHERE price_tier IN ({lits(_TIERS)})
        GROUP BY price_tier)""")

# --- statistics and forecasting ----------------------------------------------
_SC = ("rating", "cost_for_two", "votes")
SQL["stats_describe"] = with_base(f"""
SELECT column_name, COUNT(*) AS count, {r9('AVG(value)')} AS mean, {r9('STDDEV_SAMP(value)')} AS std,
       {r9('MIN(value)')} AS min, {r9('quantile_cont(value, 0.25)')} AS p25,
       {r9('quantile_cont(value, 0.5)')} AS p50, {r9('quantile_cont(value, 0.75)')} AS p75,
       {r9('MAX(value)')} AS max
FROM lg WHERE value IS NOT NULL GROUP BY column_name ORDER BY column_name""",
    f"""lg AS (UNPIVOT (SELECT {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _SC)} FROM restaurants)
         ON {", ".join(_SC)} INTO NAME column_name VALUE value)""")
SQL["stats_descriptive"] = with_base(f"""
SELECT COUNT(*) AS n, {r9('AVG(rating)')} AS mean, {r9('quantile_cont(rating, 0.5)')} AS median,
       {r9('VAR_SAMP(rating)')} AS variance, {r9('STDDEV_SAMP(rating)')} AS std
FROM restaurants WHERE rating IS NOT NULL""")
SQL["stats_corr_matrix"] = with_base("\nUNION ALL\n".join(
    f"SELECT {lit(a)} AS x, {lit(b)} AS y, {r9(f'corr({a}, {b})')} AS corr FROM restaurants"
    for a in _SC for b in _SC))
SQL["stats_zscore_share"] = with_base(f"""
SELECT n, outliers, {r9(f"{dbl('100.0')} * outliers / n")} AS outlier_pct FROM (
  SELECT COUNT(*) AS n,
         COUNT(*) FILTER (WHERE COALESCE(abs((rating - m) / NULLIF(sd, 0)) > 2.0, FALSE)) AS outliers
  FROM zs, zst) t""",
    "zs AS (SELECT rating FROM restaurants WHERE rating IS NOT NULL)",
    "zst AS (SELECT AVG(rating) AS m, STDDEV_POP(rating) AS sd FROM zs)")

# 97.5 % point of Student's t: the normal one and its corrections in 1 / dof (the test
# tables have thousands of rows, where four terms leave nothing in the ninth decimal)
_Z = 1.959963984540054
_t = f"""({_Z!r} + {(_Z**3 + _Z) / 4!r} / (n - 1) + {(5 * _Z**5 + 16 * _Z**3 + 3 * _Z) / 96!r} / (n - 1) ** 2
  + {(3 * _Z**7 + 19 * _Z**5 + 17 * _Z**3 - 15 * _Z) / 384!r} / (n - 1) ** 3)"""
SQL["stats_mean_ci"] = with_base(f"""
SELECT n, {r9('mean')} AS mean, {r9('sd / sqrt(n)')} AS sem, {r9(_t)} AS t_crit,
       {r9(f'mean - {_t} * (sd / sqrt(n))')} AS ci_low, {r9(f'mean + {_t} * (sd / sqrt(n))')} AS ci_high
FROM (SELECT COUNT(*) AS n, AVG(rating) AS mean, STDDEV_SAMP(rating) AS sd
      FROM restaurants WHERE rating IS NOT NULL) t""")

_MONTHLY = """mo AS (SELECT date_trunc('month', o_orderdate) AS month_start, CAST(COUNT(*) AS DOUBLE) AS value
       FROM orders WHERE o_orderdate IS NOT NULL GROUP BY date_trunc('month', o_orderdate)),
series AS (SELECT row_number() OVER (ORDER BY month_start) AS x, strftime(month_start, '%Y-%m') AS month, value
           FROM mo)"""
SQL["forecast_linear"] = f"""WITH {_MONTHLY},
fit AS (SELECT regr_slope(value, x) AS slope, regr_intercept(value, x) AS intercept, MAX(x) AS last_x FROM series)
SELECT s.x, ROUND(intercept + slope * s.x, 6) AS forecast, ROUND(slope, 6) AS slope, ROUND(intercept, 6) AS intercept
FROM fit, (SELECT unnest(range(last_x + 1, last_x + 7)) AS x FROM fit) s"""
SQL["forecast_moving_avg"] = f"""WITH {_MONTHLY}
SELECT x, {r9('value')} AS value,
       {r9('CASE WHEN COUNT(value) OVER w = 3 THEN AVG(value) OVER w END')} AS moving_avg
FROM series WINDOW w AS (ORDER BY x ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""


def _fmt(x: str, digits: int) -> str:
    return f"printf('%.{digits}f', {rnd(x, digits)})"


SQL["key_findings"] = with_base(f"""
SELECT 1 AS finding_no,
       'Top opportunity city: ' || city_clean || ' (score ' || {_fmt('opportunity_score', 1)} ||
       ', avg rating ' || {_fmt('avg_rating', 2)} || ').' AS finding FROM top
UNION ALL
SELECT 2, format('{{:,}}', unrated) || ' restaurants are unrated (new) - ' ||
       {_fmt(f"{dbl('100.0')} * unrated / n", 1)} || '% of the dataset.' FROM st
UNION ALL
SELECT 3, 'Average rating across rated restaurants is ' || {_fmt('mean_rated', 2)} || ' on a 5-point scale.'
FROM st
UNION ALL
SELECT 4, format('{{:,}}', risk) || ' restaurants flagged as operational risk (high cost + low rating).' FROM rk
UNION ALL
SELECT 5, 'Online ordering enabled at ' || {_fmt(f"{dbl('100.0')} * online", 1)} || '% of restaurants.'
FROM st""",
    f"""m AS (
  SELECT city_clean, COUNT(*) AS restaurant_count, AVG(rating) AS avg_rating,
         CAST(SUM(votes) AS BIGINT) AS demand_index,
         AVG(CAST(has_online_order AS DOUBLE)) * 100 AS online_pct,
         AVG(CAST(COALESCE(rating >= {P.high_rating}, FALSE) AS DOUBLE)) * 100 AS market_gap,
         COUNT(*) AS competition_density
  FROM restaurants WHERE city_clean IS NOT NULL GROUP BY city_clean)""",
    f"s AS (SELECT * FROM m WHERE avg_rating IS NOT NULL AND restaurant_count >= {P.min_city_venues})",
    "mm AS (SELECT " + ", ".join(f"MIN({x}) AS min_{x}, MAX({x}) AS max_{x}" for x, _ in _FACT) + " FROM s)",
    f"top AS (SELECT city_clean, avg_rating, ({_score}) * 100 AS opportunity_score FROM s, mm "
    "ORDER BY opportunity_score DESC, city_clean LIMIT 1)",
    """st AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE rating IS NULL) AS unrated, AVG(rating) AS mean_rated,
              AVG(CAST(has_online_order AS DOUBLE)) AS online FROM restaurants)""",
    """p AS (SELECT city_clean, quantile_cont(cost_for_two, 0.75) AS p75 FROM restaurants
       WHERE city_clean IS NOT NULL AND cost_for_two IS NOT NULL GROUP BY city_clean)""",
    f"""rk AS (SELECT COUNT(*) FILTER (WHERE COALESCE(r.cost_for_two > p.p75 AND r.rating < {P.low_rating}, FALSE))
              AS risk FROM restaurants r LEFT JOIN p ON r.city_clean = p.city_clean)""")


# --- flags and report without the forest -------------------------------------
_COST_STATS = (
    """p AS (SELECT city_clean, quantile_cont(cost_for_two, 0.75) AS p75 FROM restaurants
       WHERE city_clean IS NOT NULL AND cost_for_two IS NOT NULL GROUP BY city_clean)""",
    """c AS (SELECT quantile_cont(cost_for_two, 0.25) AS q1, quantile_cont(cost_for_two, 0.75) AS q3,
              AVG(cost_for_two) AS m, STDDEV_POP(cost_for_two) AS sd FROM restaurants)""",
    f"""flagged AS (
  SELECT r.*, COALESCE(cost_for_two < q1 - (q3 - q1) * 1.5 OR cost_for_two > q3 + (q3 - q1) * 1.5, FALSE) AS anom_iqr_cost,
         COALESCE(abs((cost_for_two - m) / NULLIF(sd, 0)) > 3.0, FALSE) AS anom_zscore_cost,
         COALESCE(cost_for_two > p75 AND rating < {P.low_rating}, FALSE) AS operational_risk
  FROM restaurants r CROSS JOIN c LEFT JOIN p ON r.city_clean = p.city_clean)""")
_COUNTED = ", ".join(f"{n_true(flag)} AS {name}" for flag, name in (
    ("anom_iqr_cost", "iqr_cost_anomalies"), ("anom_zscore_cost", "zscore_cost_anomalies"), ("operational_risk", "operational_risk_flags")))
SQL["anom_summary_statistical"] = with_base(f"SELECT {_COUNTED} FROM flagged", *_COST_STATS)
SQL["operational_risk_venues"] = with_base("SELECT * FROM flagged WHERE operational_risk", *_COST_STATS)


def _section(name: str, items) -> str:
    """One row for each (number, column) of a one-row statement."""
    return " UNION ALL ".join(f"SELECT '{name}' AS section, {i} AS item_no, '{c}' AS item, CAST({c} AS VARCHAR) AS value FROM {name}"
                              for i, c in enumerate(items, 1))


def _as_cte(name: str, sql: str) -> str:
    return f"{name} AS (\n{sql}\n)"


SQL["run_report_statistical"] = (
    "WITH " + ",\n".join(_as_cte(n, SQL[q]) for n, q in (("data_quality", "quality_report"), ("anomaly_detection", "anom_summary_statistical"),
                                                       ("found", "key_findings"))) + "\n"
    + _section("data_quality", ("rows_read", "rows_after_cleaning", "duplicate_rows_in_raw", "missing_ratings_new_restaurants", "missing_costs",
                                "invalid_cities", "structurally_valid_rows", "data_quality_pct", "pipeline_status"))
    + " UNION ALL " + _section("anomaly_detection", ("iqr_cost_anomalies", "zscore_cost_anomalies", "operational_risk_flags"))
    + " UNION ALL SELECT 'key_findings', finding_no, 'finding_' || finding_no, finding FROM found")
