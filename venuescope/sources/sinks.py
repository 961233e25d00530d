"""Table sinks: CSV/Parquet writes, versioned publish with a pointer swap,
per-query exports and the archived run report."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header CSV, overwrite.  ``single_file`` only for small, bounded
    results (top-k query outputs); big tables are written by every task."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def load_csv_pair(clean: DataFrame, cuisines: DataFrame, out_dir: str) -> None:
    """The cleaned CSV pair (raw input is never touched)."""
    write_csv(clean, os.path.join(out_dir, "venues_clean.csv"))
    write_csv(cuisines, os.path.join(out_dir, "venue_cuisines.csv"))


def stage_tables(tables: dict[str, DataFrame], base: str, version: str | None = None,
                 rows: dict[str, int] | None = None) -> dict[str, str]:
    """Write each table to ``<base>/<name>/v=<version>`` (a new folder per
    run, so readers of the current version are never disturbed).  ``rows`` takes
    the row counts seen by the writes."""
    version = version or uuid.uuid4().hex[:12]
    paths = {}
    for name, df in tables.items():
        p = os.path.join(base, name, f"v={version}")
        seen = Observation(f"stage_{name}")
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(p)
        if rows is not None:
            rows[name] = int(seen.get["rows"])
        paths[name] = p
    return paths


def published_counts(spark: SparkSession, paths: dict[str, str], cuisine_table: str = "restaurant_cuisines",
                     cuisine_col: str = "cuisine") -> DataFrame:
    """Row counts read back from the staged files, plus residual '0'
    cuisines: the check that must pass before the swap."""
    parts = []
    for name, p in paths.items():
        df = spark.read.parquet(p)
        zero = (F.count_if(F.col(cuisine_col) == "0") if name == cuisine_table and cuisine_col in df.columns
                else F.lit(0).cast("bigint"))
        parts.append(df.agg(F.count(F.lit(1)).alias("rows"), zero.alias("zero_cuisines"))
                     .select(F.lit(name).alias("table_name"), "rows", "zero_cuisines"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def verify_counts(counts: list[dict], expected: dict[str, int]) -> None:
    """Raise unless every staged table holds the expected rows and no '0' cuisine is left."""
    for row in counts:
        want = expected[row["table_name"]]
        if row["rows"] != want or row["zero_cuisines"]:
            raise ValueError(f"{row['table_name']}: {row['rows']} rows staged, {want} expected, "
                             f"{row['zero_cuisines']} '0' cuisines; nothing was swapped")


def swap_in(spark: SparkSession, paths: dict[str, str], catalog_tables: bool = False,
            database: str | None = None) -> None:
    """Point each table name at its new version: a metadata swap, no file
    moves, and readers of the old version are never disturbed.

    Session views always; with ``catalog_tables`` also an external catalog
    table per name whose location is switched (``ALTER TABLE .. SET
    LOCATION``), so other applications see the new version too."""
    for name, p in paths.items():
        spark.read.parquet(p).createOrReplaceTempView(name)
        if catalog_tables:
            # qualified, so the session view of the same name cannot shadow it
            full = f"{database or spark.catalog.currentDatabase()}.{name}"
            loc = p.replace("'", "\\'")
            if spark.catalog.tableExists(full):
                spark.sql(f"ALTER TABLE {full} SET LOCATION '{loc}'")
                spark.catalog.refreshTable(full)
            else:
                spark.sql(f"CREATE TABLE {full} USING parquet LOCATION '{loc}'")


class _Folder:
    """A folder on any file system that Spark knows."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.jvm = spark, spark._jvm
        self.hadoop = self.jvm.org.apache.hadoop.fs
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.path = path
        self.fs = self.at().getFileSystem(self.conf)

    def at(self, name: str = ""):
        return self.hadoop.Path(os.path.join(self.path, name) if name else self.path)

    def names(self, name: str = "") -> list[str]:
        here = self.at(name)
        return sorted(x.getPath().getName() for x in self.fs.listStatus(here)) if self.fs.exists(here) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_once(self, name: str, text: str) -> None:
        """The whole file appears under its name at once, or an error is raised; it never replaces another."""
        temp = self.at(f".{uuid.uuid4().hex}")
        stream = self.fs.create(temp, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        never = getattr(self.hadoop, "Options$Rename").NONE          # an existing file is an error
        how = self.spark.sparkContext._gateway.new_array(getattr(self.hadoop, "Options$Rename"), 1)
        how[0] = never
        self.hadoop.FileContext.getFileContext(self.fs.makeQualified(temp).toUri(), self.conf).rename(
            self.fs.makeQualified(temp), self.fs.makeQualified(self.at(name)), how)

    def remove(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


MANIFEST = "_manifest"


def commit_manifest(spark: SparkSession, base: str, paths: dict[str, str], counts: dict[str, int]) -> int:
    """Publish one version of all tables together: a numbered file under ``<base>/_manifest`` that names
    every table's folder and rows.  It is the last thing written and appears whole, so a run that dies before
    leaves the version before it in force, with its own staged folders beside.  Of two runs that commit
    at once, one gets an error."""
    folder = _Folder(spark, os.path.join(base, MANIFEST))
    folder.fs.mkdirs(folder.at())
    number = max([int(n.split(".")[0]) for n in folder.names() if n.endswith(".json")], default=0) + 1
    tables = {name: {"path": p, "rows": counts[name]} for name, p in paths.items()}
    folder.write_once(f"{number:012d}.json", json.dumps({"version": number, "tables": tables}))
    return number


def manifests(spark: SparkSession, base: str) -> list[dict]:
    """All published versions, oldest first."""
    folder = _Folder(spark, os.path.join(base, MANIFEST))
    return [json.loads(folder.read(n)) for n in folder.names() if n.endswith(".json")]


def open_published(spark: SparkSession, base: str, database: str | None = None) -> dict | None:
    """Point the table names at the last published version (None: nothing was published) and return its
    manifest.  Also what a session runs after another one died between two tables."""
    last = manifests(spark, base)[-1:]
    if not last:
        return None
    swap_in(spark, {name: t["path"] for name, t in last[0]["tables"].items()}, database is not None, database)
    return last[0]


def unpublished(spark: SparkSession, base: str) -> list[str]:
    """Staged folders that no manifest names: copies of runs that failed, or that have not got there yet."""
    named = {os.path.join(*t["path"].rstrip("/").split("/")[-2:]) for m in manifests(spark, base) for t in m["tables"].values()}
    folder = _Folder(spark, base)
    there = [os.path.join(t, v) for t in folder.names() if t != MANIFEST for v in folder.names(t) if v.startswith("v=")]
    return [os.path.join(base, x) for x in there if x not in named]


def remove_old(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Delete the table folders of all but the last ``keep`` published versions, and return them.  Manifests go
    first, so none ever names a folder that is gone.  Failed copies stay (see ``unpublished``)."""
    every = manifests(spark, base)
    old, kept = every[:max(0, len(every) - keep)], every[max(0, len(every) - keep):]
    used = {t["path"] for m in kept for t in m["tables"].values()}
    gone = [t["path"] for m in old for t in m["tables"].values() if t["path"] not in used]
    folder = _Folder(spark, base)
    for m in old:
        folder.remove(os.path.join(MANIFEST, f"{m['version']:012d}.json"))
    for p in gone:
        folder.remove(p)
    return gone


def publish(spark: SparkSession, paths: dict[str, str], expected: dict[str, int], base: str, database: str | None = None) -> list[dict]:
    """Verify the staged tables against the expected rows, commit them together, and swap them in.  An error
    before the commit leaves the tables before in force and the staged copy where it is."""
    counts = [r.asDict() for r in published_counts(spark, paths).orderBy("table_name").collect()]
    verify_counts(counts, expected)
    commit_manifest(spark, base, paths, {r["table_name"]: r["rows"] for r in counts})
    swap_in(spark, paths, catalog_tables=database is not None, database=database)
    return counts


def export_queries(results: dict[str, DataFrame], out_dir: str, timings: dict | None = None
                   ) -> list[tuple[str, int]]:
    """Write every named result as ``<name>_results.csv``; return (file,
    rows).  Results here are top-k / per-city outputs (bounded), so each is
    written as one file; the row count is observed during the write."""
    import time

    exported = []
    for name, df in results.items():
        t = time.perf_counter()
        obs = Observation(f"export_{name}")
        write_csv(df.observe(obs, F.count(F.lit(1)).alias("rows")),
                  os.path.join(out_dir, f"{name}_results.csv"), single_file=True)
        exported.append((f"{name}_results.csv", int(obs.get["rows"])))
        if timings is not None:
            timings[name] = round(time.perf_counter() - t, 3)
    return exported


def append_report(report: DataFrame, path: str) -> None:
    """Archive one run's report rows; one partition per run date."""
    report.write.mode("append").partitionBy("run_date").parquet(path)
