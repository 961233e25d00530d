"""Statistics of a group brought to its rows, however uneven the groups are."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from venuescope.session import scratch_path

BROADCAST_BYTES = 32 << 20       # of a statistics table that every executor may hold, about


def table_bytes(df: DataFrame) -> int:
    """Bytes of the rows of a table in memory, about: 8 for a field and the bytes of its texts."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, (StringType, BinaryType))]
    size = F.lit(8 * (len(df.columns) + 1)).cast("bigint")
    for t in texts:
        size = size + t
    return df.agg(F.sum(size)).first()[0] or 0


def hot_keys(rows: DataFrame, keys, parts: int) -> DataFrame:
    """(keys..): the keys that hold more than a ``parts``-th of the rows; fewer than ``parts``."""
    held = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    path = scratch_path(rows.sparkSession, f"keys/{uuid.uuid4().hex}")
    held.write.parquet(path)
    held = rows.sparkSession.read.schema(held.schema).parquet(path)
    total = held.agg(F.sum("_n")).first()[0] or 0
    return held.where(F.col("_n") > total // parts).select(*keys)


def attach(rows: DataFrame, stats: DataFrame, keys, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``rows`` with the other columns of ``stats`` (one row a key), null where a key is null or unknown.

    ``stats`` should be a staged table, as it is read several times.  Its size is measured:
    within ``max_bytes`` it is broadcast, and no row moves.  Beyond that, the keys that
    hold more than a partition's share of the rows are measured too: their statistics, fewer than there are
    shuffle partitions, are broadcast, null keys need none, and only the rows of all other keys
    meet theirs in a shuffle."""
    keys = list(keys)
    more = [c for c in stats.columns if c not in keys]
    if table_bytes(stats) <= max_bytes:
        return rows.join(F.broadcast(stats), keys, "left").select(*rows.columns, *more)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(rows.where(known).select(*keys), keys, parts)
    hot_stats = hot.join(stats, keys, "left").withColumn("_hot", F.lit(True))
    still = rows.join(F.broadcast(hot_stats), keys, "left").where(F.col("_hot") | ~known)
    moved = rows.where(known).join(F.broadcast(hot), keys, "left_anti").join(stats.hint("shuffle_merge"), keys, "left")
    return still.select(*rows.columns, *more).union(moved.select(*rows.columns, *more))
