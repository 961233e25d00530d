"""File sources: the raw listing CSV and the published (cleaned) tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from venuescope import config, schemas


def normalise_na_tokens(df: DataFrame, tokens=config.CSV_NA_TOKENS) -> DataFrame:
    """Spark's CSV reader knows one null token; pandas knows ~20.  Turn every
    one of them into null in the string columns (a per-column projection)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, StringType):
            c = F.when(~c.isin(*tokens), c).alias(f.name)
        cols.append(c)
    return df.select(*cols)


def _headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """{header line: files}: the first line of every file under ``path`` (a file, a folder or a pattern), read from
    each file's first bytes."""
    hadoop, jvm = spark._jvm.org.apache.hadoop, spark._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    fs = hadoop.fs.Path(path).getFileSystem(conf)
    found = fs.globStatus(hadoop.fs.Path(path)) or []
    files, todo = [], [x for x in found]
    while todo:
        x = todo.pop()
        name = x.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        if x.isDirectory():
            todo += list(fs.listStatus(x.getPath()))
        elif x.getLen():
            files.append(x.getPath().toString())
    codecs = hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(file: str) -> str:
        at = hadoop.fs.Path(file)
        codec, stream = codecs.getCodec(at), fs.open(at)
        try:
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
            return reader.readLine() or ""
        finally:
            stream.close()

    out: dict[str, list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for file, line in zip(sorted(files), pool.map(first_line, sorted(files))):
            out.setdefault(line, []).append(file)
    return out


def _by_name(spark: SparkSession, path: str, schema: StructType, multiline: bool) -> DataFrame:
    """The columns of ``schema`` as text, found by the names in each file's own header: any order, also
    from file to file, other columns ignored; a missing one is an error that names a file.

    Files with the same header are read together, so a folder of any size is as many reads as it has headers."""
    out = None
    for files in _headers(spark, path).values():
        df = (spark.read.option("header", True).option("inferSchema", False)
              .option("multiLine", multiline)
              .option("escape", '"')
              .option("mode", "PERMISSIVE")
              .csv(files))
        there = {c.strip().removeprefix("\ufeff"): c for c in reversed(df.columns)}
        missing = [f.name for f in schema.fields if f.name not in there]
        if missing:
            raise ValueError(f"{files[0]}: no column {', '.join(missing)} in the header ({', '.join(df.columns)})")
        part = df.select(*[F.col(f"`{there[f.name]}`").alias(f.name) for f in schema.fields])
        out = part if out is None else out.union(part)
    if out is None:
        raise ValueError(f"{path}: no files with a header")
    return out


def extract(spark: SparkSession, path: str, schema: StructType = schemas.RAW_SCHEMA,
            multiline: bool = False) -> DataFrame:
    """Read the raw header CSV with every column as text (no inference), by column name.

    Fields with quoted newlines need ``multiline``; a file is then read by one
    task, so such data should land as many files.  Without it every file is split."""
    return normalise_na_tokens(_by_name(spark, path, schema, multiline))


def read_clean_csv(spark: SparkSession, path: str, schema: StructType = schemas.CLEAN_SCHEMA) -> DataFrame:
    """Typed re-read of a cleaned CSV (the published CSV pair), by column name; names may hold
    newlines and quotes, and the sink writes as many files as there are tasks."""
    df = _by_name(spark, path, schema, multiline=True)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
