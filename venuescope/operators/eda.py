"""The data behind each exploratory chart, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from venuescope import config
from venuescope.config import Params, REFERENCE
from venuescope.operators.profile import value_counts
from venuescope.operators.quantile import exact_percentiles


def top_counts(df: DataFrame, col: str, k: int) -> DataFrame:
    """value_counts().head(k) of non-null values (ties by value)."""
    return value_counts(df, col, top=k, dropna=True)


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram with numpy's edge rules: ``bins`` bins from min
    to max, the maximum in the last bin, values compared against the same
    edges numpy computes; empty bins listed with 0; plus the mean.

    Each step is its own projection so the bin expression stays small."""
    x = F.col(col).cast("double")
    s = df.where(x.isNotNull() & ~F.isnan(x)).select(x.alias("x"))
    st = s.agg(F.struct(F.min("x").alias("mn"), F.max("x").alias("mx"), F.avg("x").alias("mean")).alias("s")) \
        .select(F.when(F.col("s.mx") > F.col("s.mn"), F.col("s.mn")).otherwise(F.col("s.mn") - 0.5).alias("lo"),
                F.when(F.col("s.mx") > F.col("s.mn"), F.col("s.mx")).otherwise(F.col("s.mx") + 0.5).alias("hi"),
                F.col("s.mean").alias("mean"))
    st = st.select(F.struct("lo", "hi", "mean").alias("g")).select("g").scalar()
    lo, hi = F.col("_h.lo"), F.col("_h.hi")

    def edge(i):
        return F.when(i >= bins, F.col("hi")).otherwise(i * F.col("step") + F.col("lo"))

    t = s.withColumn("_h", st).select("x", lo.alias("lo"), hi.alias("hi"))
    t = t.select("x", "lo", "hi", ((F.col("hi") - F.col("lo")) / bins).alias("step"))
    i0 = F.floor((F.col("x") - F.col("lo")) * (F.lit(float(bins)) / (F.col("hi") - F.col("lo"))))
    t = t.select("x", "lo", "hi", "step", F.least(i0, F.lit(bins - 1)).alias("i0"))
    t = t.select("x", "lo", "hi", "step",
                 F.when(F.col("x") < edge(F.col("i0")), F.col("i0") - 1).otherwise(F.col("i0")).alias("i1"))
    i2 = F.when((F.col("x") >= edge(F.col("i1") + 1)) & (F.col("i1") != bins - 1), F.col("i1") + 1) \
        .otherwise(F.col("i1"))
    counts = t.select(i2.cast("int").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    grid = (df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"), st.alias("_h"))
            .select("bin", lo.alias("lo"), hi.alias("hi"), F.col("_h.mean").alias("mean")))
    grid = grid.select("bin", "lo", "hi", "mean", ((F.col("hi") - F.col("lo")) / bins).alias("step"))
    out = grid.join(F.broadcast(counts), "bin", "left")   # <= bins rows by construction
    return out.select("bin", edge(F.col("bin")).alias("bin_lower"), edge(F.col("bin") + 1).alias("bin_upper"),
                      F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
                      "mean").orderBy("bin")


def mean_by(df: DataFrame, key: str, cols) -> DataFrame:
    """groupby(key)[cols].mean(); null keys dropped."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(*[F.avg(c).alias(f"avg_{c}") for c in cols]).orderBy(key))


def box_stats(df: DataFrame, group: str, value: str, top: int = 8) -> DataFrame:
    """Box-plot numbers of ``value`` for the ``top`` most frequent groups:
    quartiles, whiskers at the furthest point within 1.5 IQR, outliers."""
    top_groups = top_counts(df, group, top).select(group)        # <= top rows
    sub = df.join(F.broadcast(top_groups), group, "left_semi")
    q = exact_percentiles(sub, value, [0.25, 0.5, 0.75], by=[group], names=["q1", "median", "q3"])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    j = sub.where(F.col(value).isNotNull()).join(F.broadcast(q), group)   # <= top rows
    lo = F.col("q1") - 1.5 * F.col("iqr")
    hi = F.col("q3") + 1.5 * F.col("iqr")
    v = F.col(value)
    return (j.groupBy(group, "q1", "median", "q3", "iqr")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.min(F.when(v >= lo, v)).alias("whisker_low"),
                 F.max(F.when(v <= hi, v)).alias("whisker_high"),
                 F.count_if((v < lo) | (v > hi)).alias("n_outliers"))
            .orderBy(group))


def service_mix(df: DataFrame, flags=("has_online_order", "has_table_booking", "delivery_only"),
                labels=("Online order", "Table booking", "Delivery only")) -> DataFrame:
    """Share (%) of venues with each service flag, long form."""
    agg = df.agg(*[(F.avg(F.col(f).cast("double")) * 100).alias(lab) for f, lab in zip(flags, labels)])
    return agg.unpivot([], list(labels), "service", "pct")


def deterministic_sample(df: DataFrame, n: int, seed: int = 42, dropna=None, digits: int = 5) -> DataFrame:
    """Exactly ``min(n, rows)`` rows: those with the smallest md5 of the seed and
    their content as text.  Same input -> same sample, however it is partitioned;
    rows with equal content are copies of one row.

    The first pass counts rows by the first ``digits`` hex digits of the hash; the
    first n counts that are not zero show below which digits n rows lie (at most n numbers
    are read).  Where the last of these digits hold more than n rows, as on very large input, they are counted
    again by more digits.  The final pass keeps the rows up to there, copies collapsed before the shuffle, and
    ranks those: about 2 n rows at any size."""
    src = df.dropna(subset=list(dropna)) if dropna else df
    cols = src.columns
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols])
    t = src.withColumn("_h", F.md5(text.cast("binary")))
    last, missing, at = "", int(n), digits
    while missing > 0:
        head = F.substring("_h", 1, at)
        inside = t.where(F.col("_h").startswith(last)) if last else t
        counts = inside.groupBy(head.alias("_p")).agg(F.count(F.lit(1)).alias("_c")).orderBy("_p").limit(missing).collect()
        if not counts:
            break
        seen = 0
        for r in counts:
            last, seen = r["_p"], seen + r["_c"]
            if seen >= missing:
                break
        if seen < missing or r["_c"] <= n or at >= 32:
            break
        missing, at = missing - (seen - r["_c"]), at + digits
    head = F.substring("_h", 1, max(1, len(last)))
    d = t.where(head <= last).groupBy(*cols, "_h").agg(F.count(F.lit(1)).alias("_m"))
    before = Window.orderBy("_h", *cols).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_left", F.lit(int(n)) - F.coalesce(F.sum("_m").over(before), F.lit(0)))
    return (d.where(F.col("_left") > 0)
            .select(*cols, F.explode(F.sequence(F.lit(1).cast("bigint"), F.least("_m", "_left"))).alias("_copy")).drop("_copy"))


def correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson on pairwise-complete rows."""
    return df.agg(F.corr(a, b).alias("corr"))


def ordered_share(df: DataFrame, col: str = "price_tier", order=None) -> DataFrame:
    """Counts of the listed categories in the given order, and each one's
    share of the listed total (other values, e.g. Unknown, excluded)."""
    order = list(order or [label for _, label in config.PRICE_TIERS])
    spark = df.sparkSession
    cats = spark.createDataFrame([(v, i + 1) for i, v in enumerate(order)], f"{col} string, tier_order int")
    counts = df.where(F.col(col).isin(*order)).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    j = counts.join(F.broadcast(cats), col)          # fixed, len(order) rows
    total = F.sum("count").over(Window.partitionBy())   # <= len(order) rows
    return (j.select(col, "tier_order", "count", (F.lit(100.0) * F.col("count") / total).alias("share_pct"))
            .orderBy("tier_order"))


def city_localities(df: DataFrame, params: Params = REFERENCE) -> DataFrame:
    return top_counts(df.where(F.col("city_clean") == params.e8_city), "location", params.e8_top)
