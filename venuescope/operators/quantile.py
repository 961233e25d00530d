"""Exact quantiles (linear interpolation) without a single-task merge.

Spark's ``percentile`` keeps a value->count map per group and merges all
maps of a group in one task: fine for a few thousand distinct prices, fatal
for a continuous column at 100 TB or for a group holding a third of all rows.
Here cells are counted instead, for any number of ranks and groups together:

1. one pass counts rows per (group, cell) with the least and largest value of the
   cell.  The cell is a fixed, never falling function of the value (a grid of about
   1.6 % on the asinh scale), so no result depends on how rows are laid out.
   These counts tell which cell holds each wanted rank, for the groups and for the whole
   column alike.  A cell of one value is an answer already;
2. a second pass reads the rows of the wanted cells.  While some cell holds more than
   ``LIMIT`` rows, it is cut again, evenly between its least and largest value, and only
   the piece with the wanted rank is kept;
3. what is left of a cell, collapsed to distinct values, is ranked in one task: ``LIMIT``
   rows at most, however large the input is.

Same result as ``percentile`` / ``quantile_cont`` / pandas ``quantile``.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from venuescope.session import scratch_path

_V, _W, _CELL = "_q_v", "_q_w", "_q_cell"
GRID = 64               # cells for a factor of e, at level 0
PIECES = 1024           # pieces of a cell, at the levels after it
LIMIT = 1_000_000       # rows of a cell that are ranked in one task, at most


def _stage(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, f"quantile/{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _stage_cells(cells: DataFrame) -> tuple[DataFrame, int | None]:
    """The cells staged, and the rows of the largest one with several values, seen by the same write."""
    seen = Observation(f"cells-{uuid.uuid4().hex}")
    out = _stage(cells.observe(seen, F.max(F.when(F.col("_lo") < F.col("_hi"), F.col("_n"))).alias("large")))
    return out, seen.get["large"]


def grid_cell(v: Column) -> Column:
    """The level 0 cell of a double; infinities have cells of their own.  asinh squares, so far out its
    logarithm is taken."""
    far = F.signum(v) * (F.ln(F.abs(v)) + math.log(2.0))
    at = F.when(F.abs(v) > 1e100, far).otherwise(F.asinh(v))
    return F.floor(F.greatest(F.least(at, F.lit(800.0)), F.lit(-800.0)) * GRID)


def piece_of(v: Column, lo: Column, hi: Column) -> Column:
    """Which of PIECES even pieces of [lo, hi], lo < hi, a value lies in: the ends lie in different ones."""
    return F.least(F.floor((v - lo) / (hi - lo) * PIECES), F.lit(PIECES - 1))


def _rows(df: DataFrame, value: str, by, weight) -> DataFrame:
    """(by.., value, weight, cell) of the rows that count: no null, NaN or zero weight."""
    keep = F.col(value).isNotNull()
    if dict(df.dtypes).get(value) in ("double", "float"):
        keep = keep & ~F.isnan(F.col(value))
    w = F.lit(1).cast("bigint") if weight is None else F.col(weight).cast("bigint")
    base = df.where(keep).select(*by, F.col(value).cast("double").alias(_V), w.alias(_W)).where(F.col(_W) > 0)
    return base.withColumn(_CELL, grid_cell(F.col(_V)))


def _merged(counts: DataFrame, keys) -> DataFrame:
    """Counts of finer cells added up."""
    return counts.groupBy(*keys).agg(F.sum("_n").alias("_n"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))


def _count(rows: DataFrame, keys) -> DataFrame:
    # the second moment rests on unweighted rows: weighted input asks for no variance
    return rows.groupBy(*keys).agg(F.sum(_W).alias("_n"), F.min(_V).alias("_lo"), F.max(_V).alias("_hi"), F.avg(_V).alias("_mean"),
                                   (F.var_pop(_V) * F.count(_V)).alias("_m2"))


def _ranks(n: Column, probs) -> Column:
    out = []
    for k, p in enumerate(probs):
        pos = F.lit(p) * (n - 1)
        rest = (pos - F.floor(pos)).alias("extra")
        out += [F.struct(F.lit(2 * k).alias("k"), F.floor(pos).cast("bigint").alias("r"), rest),
                F.struct(F.lit(2 * k + 1).alias("k"), F.ceil(pos).cast("bigint").alias("r"), rest)]
    return F.array(*out)


def _inside(t: Column) -> Column:
    """Whether a wanted rank lies in (``_to`` - ``_n``, ``_to``] of a running count."""
    return (t["r"] < F.col("_to")) & (t["r"] >= F.col("_to") - F.col("_n"))


def _wanted(counts: DataFrame, by, probs) -> DataFrame:
    """(by.., cell, n, lo, hi, from, ts): the cells that hold a wanted rank, with the rows before them."""
    part = Window.partitionBy(*by)
    run = part.orderBy(_CELL).rowsBetween(Window.unboundedPreceding, 0)
    c = counts.withColumn("_to", F.sum("_n").over(run)).withColumn("_all", F.sum("_n").over(part))
    c = c.withColumn("_ts", F.filter(_ranks(F.col("_all"), probs), _inside)).where(F.size("_ts") > 0)
    return c.select(*by, _CELL, "_n", "_lo", "_hi", (F.col("_to") - F.col("_n")).alias("_from"), "_ts")


def _single(cells: DataFrame, by) -> DataFrame:
    """(by.., k, extra, value) of the cells that hold one value."""
    return cells.where("_lo = _hi").select(*by, F.explode("_ts").alias("t"), F.col("_lo").alias(_V)).select(
        *by, F.col("t.k").alias("_k"), F.col("t.extra").alias("_extra"), _V)


def _settle(rows: DataFrame, cells: DataFrame, by, limit: int) -> DataFrame:
    """(by.., k, extra, value): the value at each wanted rank of ``cells``."""
    keys = [*by, _CELL]
    cells, large = _stage_cells(cells)
    done = _single(cells, by)
    open_ = cells.where("_lo < _hi")
    if large is None:
        return done
    if large <= limit:
        # cells of one value go the same way (one row a task after the partial sums), so the cells are read once
        done, open_ = None, cells
    inner = rows.join(open_, keys).select(*keys, _V, _W, "_n", "_lo", "_hi", "_from", "_ts")
    while large > limit:
        # cut the open cells again and keep the pieces with a wanted rank
        inner = _stage(inner.withColumn("_piece", piece_of(F.col(_V), F.col("_lo"), F.col("_hi"))))
        counts = inner.groupBy(*keys, "_piece").agg(F.sum(_W).alias("_n"), F.min(_V).alias("_lo"), F.max(_V).alias("_hi"),
                                                    F.first("_from").alias("_from"), F.first("_ts").alias("_ts"))
        run = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, 0)
        counts = counts.withColumn("_to", F.col("_from") + F.sum("_n").over(run)).withColumn("_ts", F.filter("_ts", _inside)).where(F.size("_ts") > 0)
        cells, large = _stage_cells(counts.select(*keys, "_piece", "_n", "_lo", "_hi", (F.col("_to") - F.col("_n")).alias("_from"), "_ts"))
        done = done.union(_single(cells, by))
        open_ = cells.where("_lo < _hi")
        if large is None:
            return done
        inner = inner.select(*keys, "_piece", _V, _W).join(open_, [*keys, "_piece"])
        # a cell may go on in two pieces, which are cells of their own from here on
        number = F.xxhash64(_CELL, "_piece").alias(_CELL)
        inner = inner.select(*by, number, _V, _W, "_n", "_lo", "_hi", "_from", "_ts")
    values = inner.groupBy(*keys, _V).agg(F.sum(_W).alias("_n"), F.first("_from").alias("_from"), F.first("_ts").alias("_ts"))
    run = Window.partitionBy(*keys).orderBy(_V).rowsBetween(Window.unboundedPreceding, 0)
    values = values.withColumn("_to", F.col("_from") + F.sum("_n").over(run)).withColumn("t", F.explode(F.filter("_ts", _inside)))
    hit = values.select(*by, F.col("t.k").alias("_k"), F.col("t.extra").alias("_extra"), _V)
    return hit if done is None else done.union(hit)


def _pivot(hit: DataFrame, by, probs, names) -> DataFrame:
    pick = lambda k, c: F.max(F.when(F.col("_k") == k, F.col(c)))
    cols = [x for k in range(len(probs)) for x in (pick(2 * k, _V).alias(f"_lo{k}"), pick(2 * k + 1, _V).alias(f"_up{k}"),
                                                   pick(2 * k, "_extra").alias(f"_fr{k}"))]
    agg = hit.groupBy(*by).agg(*cols) if by else hit.agg(*cols)
    return agg.select(*by, *[
        (F.col(f"_lo{k}") + (F.col(f"_up{k}") - F.col(f"_lo{k}")) * F.col(f"_fr{k}")).alias(nm)
        for k, nm in enumerate(names)])


def exact_percentiles(df: DataFrame, value: str, probs, by=(), names=None, weight: str | None = None,
                      limit: int = LIMIT) -> DataFrame:
    """One row per group with one column per probability (one row of nulls for no rows, ungrouped).

    Nulls and NaN in ``value`` are skipped; rows with a null group key are
    dropped (pandas ``groupby`` semantics).  ``weight`` (a non-negative
    integer column) counts a row that many times, for input that is already
    aggregated to (value, multiplicity)."""
    probs = [float(p) for p in probs]
    names = list(names) if names else [f"p{round(p * 100):g}" for p in probs]
    return column_percentiles(df, value, [(list(by), probs, names)], weight, limit)[0]


def column_percentiles(df: DataFrame, value: str, wanted, weight: str | None = None, limit: int = LIMIT,
                       counts: DataFrame | None = None) -> list[DataFrame]:
    """Quantiles of one column for several groupings from one counting pass: a DataFrame for each
    (by, probs, names) of ``wanted``, as ``exact_percentiles`` gives it.  ``counts``: ``cell_counts`` of
    the same rows, where they were taken ahead."""
    every = sorted({b for by, _, _ in wanted for b in by})
    if counts is None:
        counts = cell_counts(df, value, every, weight)
    out = []
    for by, probs, names in wanted:
        whole = counts
        rows = _rows(df, value, by, weight)
        for b in by:
            whole, rows = whole.where(F.col(b).isNotNull()), rows.where(F.col(b).isNotNull())
        whole = _merged(whole, [*by, _CELL]) if set(by) != set(every) else whole
        out.append(_pivot(_settle(rows, _wanted(whole, by, probs), by, limit), by, probs, names))
    return out


def cell_counts(df: DataFrame, value: str, by=(), weight: str | None = None) -> DataFrame:
    """(by.., cell, n, lo, hi, mean, m2): the rows of every level 0 cell with the mean and the squared
    deviations of their values, null groups included; staged."""
    return _stage(_count(_rows(df, value, by, weight), [*by, _CELL]))
