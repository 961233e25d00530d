"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from venuescope.session import scratch_path

#: the white space of every contract here: space, tab, line feed, VT, FF, CR
SPACES = " \t\n\x0b\x0c\r"
#: bytes.split() without arguments splits at exactly these six, and bytes.lower()
#: lower-cases exactly A-Z, so both run on UTF-8 bytes
WORD = r"[^\x20\x09-\x0D]+"
#: bytes of rows in one batch between Spark and Python, about.  A batch lies in the JVM's buffers, which double as they
#: grow, and in the worker at once, for every core: Spark's 64 MB come to several hundred outside the heap
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table, read by Spark alone (any file system it knows)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside gets batches of BATCH_BYTES, unless the session names a size of its own."""
    own = spark.conf.get(_BATCH, None) is None
    if own:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    try:
        yield
    finally:
        if own:
            spark.conf.unset(_BATCH)


def stage_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Cut the lineage: write ``df`` under the shared checkpoint folder and read it back; also the folder.

    The written files outlive any executor, and what follows reads the same
    rows however often it is recomputed."""
    spark = df.sparkSession
    path = f"{scratch_path(spark, name)}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stage(df: DataFrame, name: str) -> DataFrame:
    """``stage_at`` without the folder."""
    return stage_at(df, name)[0]


def unstage(spark: SparkSession, path: str) -> None:
    """Remove a staged folder that nothing will read again."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def row_slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with about ``limit`` bytes of ``column`` each (one row at least)."""
    if batch.num_rows == 0:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size.astype(np.int64)) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def utf8_size(batch: pa.RecordBatch, column: str) -> pa.Array:
    """Bytes of a string column, 0 for null."""
    return pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64())


def crc_fold(doc_id: int | None, parts: int) -> int:
    """crc32 of the id's decimal text, mod ``parts``; a null id is in no fold (-1)."""
    return -1 if doc_id is None else zlib.crc32(str(doc_id).encode()) % parts


def fold(col: Column, parts: int) -> Column:
    """The same fold as a Spark column (-1 for null)."""
    return F.coalesce(F.crc32(F.encode(col.cast("string"), "UTF-8")) % parts, F.lit(-1))


def list_array(flat: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Arrow list column from its values laid end to end and the size of each row."""
    offsets = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=kind))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
