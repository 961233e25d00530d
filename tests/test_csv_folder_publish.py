"""A folder of CSV files whose columns differ in order, and two tables published together."""

import gzip
import os

import pytest

from venuescope import schemas
from venuescope.sources import files, sinks

COLUMNS = [f.name for f in schemas.RAW_SCHEMA.fields]


def write(path, names, rows, opener=open):
    with opener(path, "wt") as f:
        f.write(",".join(names) + "\n")
        for r in rows:
            f.write(",".join(r.get(n, "") for n in names) + "\n")


def test_every_file_is_read_by_its_own_header(spark, tmp_out):
    a = [{n: f"{n}-{i}" for n in COLUMNS} for i in range(3)]
    b = [{n: f"{n}-{i}" for n in COLUMNS} for i in range(3, 6)]
    write(os.path.join(tmp_out, "a.csv"), COLUMNS, a)
    write(os.path.join(tmp_out, "b.csv"), ["extra", *reversed(COLUMNS)], b)
    os.mkdir(os.path.join(tmp_out, "more"))
    write(os.path.join(tmp_out, "more", "c.csv.gz"), COLUMNS, a[:1], gzip.open)
    write(os.path.join(tmp_out, "_SUCCESS"), ["x"], [])
    open(os.path.join(tmp_out, "empty.csv"), "w").close()
    got = sorted(files.extract(spark, tmp_out).collect())
    assert [r.asDict() for r in got] == sorted(a + b + a[:1], key=lambda r: tuple(r[n] for n in COLUMNS))


def test_a_missing_column_names_its_file(spark, tmp_out):
    write(os.path.join(tmp_out, "a.csv"), COLUMNS, [])
    write(os.path.join(tmp_out, "b.csv"), [c for c in COLUMNS if c != "city"], [])
    with pytest.raises(ValueError, match=r"b\.csv: no column city"):
        files.extract(spark, tmp_out)
    with pytest.raises(ValueError, match="no files"):
        files.extract(spark, os.path.join(tmp_out, "nowhere"))


def pair(spark, base, n, version):
    rows = {}
    paths = sinks.stage_tables({"restaurants": spark.range(n), "restaurant_cuisines": spark.range(2 * n).selectExpr("'x' AS cuisine")},
                               base, version, rows)
    return paths, rows


def sizes(spark):
    return spark.table("restaurants").count(), spark.table("restaurant_cuisines").count()


def test_a_run_that_dies_between_the_tables_leaves_the_old_pair(spark, tmp_out, monkeypatch):
    base = os.path.join(tmp_out, "t")
    assert sinks.open_published(spark, base) is None
    sinks.publish(spark, *pair(spark, base, 5, "v1"), base)
    assert sizes(spark) == (5, 10)

    # dies once one table is staged
    sinks.stage_tables({"restaurants": spark.range(7)}, base, "v2")
    sinks.open_published(spark, base)
    assert sizes(spark) == (5, 10)
    assert [os.path.relpath(p, base) for p in sinks.unpublished(spark, base)] == ["restaurants/v=v2"]

    # dies after the commit, between the two names: the next session finds both
    paths, rows = pair(spark, base, 9, "v3")
    def torn(spark, paths, **kw):
        spark.read.parquet(paths["restaurants"]).createOrReplaceTempView("restaurants")
        raise RuntimeError("killed")
    with monkeypatch.context() as m:
        m.setattr(sinks, "swap_in", torn)
        with pytest.raises(RuntimeError, match="killed"):
            sinks.publish(spark, paths, rows, base)
    assert sinks.open_published(spark, base)["version"] == 2
    assert sizes(spark) == (9, 18)


def test_wrong_counts_publish_nothing_and_keep_the_copy(spark, tmp_out):
    base = os.path.join(tmp_out, "t")
    sinks.publish(spark, *pair(spark, base, 5, "v1"), base)
    paths, rows = pair(spark, base, 6, "v2")
    with pytest.raises(ValueError, match="nothing was swapped"):
        sinks.publish(spark, paths, rows | {"restaurants": 7}, base)
    assert sinks.open_published(spark, base)["version"] == 1 and sizes(spark) == (5, 10)
    assert len(sinks.unpublished(spark, base)) == 2


def test_old_versions_go_and_commits_never_replace(spark, tmp_out):
    base = os.path.join(tmp_out, "t")
    for i in range(1, 5):
        sinks.publish(spark, *pair(spark, base, i, f"v{i}"), base)
    gone = sinks.remove_old(spark, base, keep=2)
    assert len(gone) == 4 and not any(os.path.exists(p) for p in gone)
    assert [m["version"] for m in sinks.manifests(spark, base)] == [3, 4]
    sinks.open_published(spark, base)
    assert sizes(spark) == (4, 8)
    folder = sinks._Folder(spark, os.path.join(base, sinks.MANIFEST))
    with pytest.raises(Exception, match="exist"):
        folder.write_once("000000000004.json", "{}")
    assert sinks.manifests(spark, base)[-1]["tables"]["restaurants"]["rows"] == 4
