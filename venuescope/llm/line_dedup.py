"""Incremental line dedup: sharded cuckoo filters backed by exact reference counts.

``postings`` holds one row for each document and distinct long line key,
``counts`` the exact number of documents and the largest doc_id of each key, and
``filters`` one cuckoo filter for each shard of the keys that are frequent enough
to be dropped.  Inserting and deleting documents add to and subtract from the
counts, and keys that cross the limit enter or leave their shard's filter, so a
deletion gives back exactly what the insertion took.

To rewrite documents, line keys are probed in the filters (sent to the workers
while their measured size is within ``ship_bytes``, else left out, as they only save
rows), hits are settled by a join on the exact counts, and the keys to drop join the
documents.  Keys are 128-bit digests; a third of all documents may share one key,
as its postings are aggregated before the shuffle and joins on it can be split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, row_slices, stage
from .cuckoo import CuckooFilter

_BLANK = SPACES.encode()


def key_of(line: bytes, min_chars: int) -> bytes | None:
    """16-byte digest of a line's key, None if the key has fewer than ``min_chars`` code points.
    Stripping and lower-casing are those of the ASCII range, which bytes methods do."""
    import xxhash

    key = line.strip(_BLANK).lower()
    if len(key) < min_chars or not key.isascii() and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def line_keys(docs: DataFrame, min_chars: int, shards: int, doc_id: str, text: str,
              shipped=None) -> DataFrame:
    """(d, shard, hi, lo): the distinct long line keys of each row.  With ``shipped``
    (a broadcast of shard filters), only keys that their shard's filter knows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = shipped and {k: CuckooFilter.from_bytes(raw) for k, raw in shipped.value.items()}
        for batch in batches:
            for part in row_slices(batch, "t"):
                rows, keys = [], []
                for i, t in enumerate(part.column("t").to_pylist()):
                    if t:
                        own = {key_of(x, min_chars) for x in t.encode().split(b"\n") if len(x) >= min_chars}
                        own.discard(None)
                        rows += [i] * len(own)
                        keys += own
                pair = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
                row, shard = np.array(rows, np.int64), (pair[:, 0].astype(np.uint64) % np.uint64(shards)).astype(np.int32)
                if filters is not None:
                    hit = np.zeros(len(row), bool)
                    for k in np.unique(shard).tolist():
                        at = np.flatnonzero(shard == k)
                        if k in filters:
                            hit[at] = filters[k].contains(pair[at, 1].astype(np.uint64))
                    row, shard, pair = row[hit], shard[hit], pair[hit]
                yield pa.RecordBatch.from_arrays(
                    [part.column("d").take(pa.array(row)), pa.array(shard), pa.array(pair[:, 0]), pa.array(pair[:, 1])],
                    ["d", "shard", "hi", "lo"])

    return (docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t"))
            .mapInArrow(run, "d long, shard int, hi long, lo long"))


KEY = ["shard", "hi", "lo"]


class LineDedup:
    """State of the line dedup over the documents inserted so far; it begins empty, and so deletes and rewrites nothing.

    Every row counts as a document, so rows that repeat an id count each (one inserted again counts again, and a deletion
    takes out all of them); rows with a null id or text have no keys, so they neither
    count nor lose a line.  ``insert`` and ``delete`` take (id, text) rows and adjust the counts of the keys of these rows
    alone; ``rewrite`` drops lines."""

    def __init__(self, spark, min_chars: int = 40, min_docs: int = 5, shards: int = 64,
                 ship_bytes: int = 64 << 20, doc_id: str = "doc_id", text: str = "text"):
        self.spark, self.min_chars, self.min_docs, self.shards = spark, min_chars, min_docs, shards
        self.ship_bytes, self.doc_id, self.text = ship_bytes, doc_id, text
        self.filters = None
        self.postings: list[DataFrame] = []         # one staged table for each insertion
        self.counts = spark.createDataFrame([], "shard int, hi long, lo long, n_docs long, keeper long")

    def _keys(self, docs: DataFrame, shipped=None) -> DataFrame:
        return line_keys(docs, self.min_chars, self.shards, self.doc_id, self.text, shipped)

    def _held(self) -> DataFrame:
        """The postings of all insertions, without what was deleted after them."""
        out = self.postings[0]
        for p in self.postings[1:]:
            out = out.unionByName(p)
        return out

    def insert(self, docs: DataFrame) -> "LineDedup":
        """Add the documents of ``docs``; an empty table changes nothing."""
        first = not self.postings
        new = stage(self._keys(docs), "line-postings")
        self.postings.append(new)
        more = new.groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.max("d").alias("keeper"))
        if first:
            self.counts = stage(more, "line-counts")
            self._refilter(self.counts.select(*KEY, F.lit(0).cast("long").alias("was"), "n_docs"))
            return self
        both = self.counts.withColumn("was", F.col("n_docs")).withColumn("new", F.lit(False)).unionByName(
            more.withColumn("was", F.lit(0).cast("long")).withColumn("new", F.lit(True)))
        both = stage(both.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"), F.sum("was").alias("was"),
                                            F.max("new").alias("new")), "line-counts")
        self.counts = both.drop("was", "new")
        self._refilter(both.where("new").select(*KEY, "was", "n_docs"))
        return self

    def delete(self, docs: DataFrame) -> "LineDedup":
        """Take out documents inserted before, by id (all rows of an id go); unknown ids change nothing.
        Only the keys that these documents held are counted again, as their largest id may have gone."""
        if not self.postings:
            return self
        gone = docs.select(F.col(self.doc_id).cast("long").alias("d")).distinct()
        held = self._held()
        touched = stage(held.join(gone, "d", "left_semi").select(*KEY).distinct(), "line-touched")
        self.postings = [stage(p.join(gone, "d", "left_anti").select("d", *KEY), "line-postings") for p in self.postings]
        left = self._held().join(touched, KEY, "left_semi").groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.max("d").alias("keeper"))
        left = stage(left, "line-touched")
        was = self.counts.join(touched, KEY, "left_semi").select(*KEY, F.col("n_docs").alias("was"))
        change = stage(was.join(left.select(*KEY, "n_docs"), KEY, "left").select(*KEY, "was", F.coalesce("n_docs", F.lit(0)).alias("n_docs")), "line-change")
        self.counts = stage(self.counts.join(touched, KEY, "left_anti").unionByName(left), "line-counts")
        self._refilter(change)
        return self

    def _refilter(self, changed: DataFrame) -> None:
        """Bring each shard's filter up to the counts: of the ``changed`` keys (with their counts before and after), those that
        rose to the limit go in, those that fell below it come out.  A shard's changes are its frequent keys, one task each."""
        limit = self.min_docs
        now = self.counts.where(F.col("n_docs") >= limit).select(*KEY)
        rose = (F.col("was") < limit) & (F.col("n_docs") >= limit)
        fell = (F.col("was") >= limit) & (F.col("n_docs") < limit)
        change = changed.where(rose | fell).select(*KEY, F.when(rose, 1).otherwise(-1).alias("sign"))
        have = self.filters if self.filters is not None else self.spark.createDataFrame([], "shard int, filter binary")

        def update(keys, filters):
            import pandas as pd

            lo, sign = keys["lo"].to_numpy().astype(np.uint64), keys["sign"].to_numpy()
            if not len(filters):
                own, fits = CuckooFilter(lo[sign > 0]), True
            else:
                own = CuckooFilter.from_bytes(filters["filter"].iloc[0])
                own.remove(lo[sign < 0])
                fits = own.insert(lo[sign > 0])
            shard = (keys if len(keys) else filters)["shard"].iloc[0]
            return pd.DataFrame({"shard": [shard], "filter": [own.to_bytes() if fits else None]})

        def build(keys):
            import pandas as pd

            return pd.DataFrame({"shard": [keys["shard"].iloc[0]],
                                 "filter": [CuckooFilter(keys["lo"].to_numpy().astype(np.uint64)).to_bytes()]})

        schema = "shard int, filter binary"
        updated = stage(change.groupBy("shard").cogroup(have.groupBy("shard")).applyInPandas(update, schema), "line-filters")
        full = [r["shard"] for r in updated.where("filter is null").collect()]      # at most ``shards`` numbers
        if full:                                          # too full for the new keys: built anew, larger
            anew = now.where(F.col("shard").isin(full)).groupBy("shard").applyInPandas(build, schema)
            updated = stage(updated.where("filter is not null").unionByName(anew), "line-filters")
        self.filters = updated

    def dropped(self, docs: DataFrame) -> DataFrame:
        """(d, keys array<binary>): the line keys that each document loses."""
        if self.filters is None:
            return self._keys(docs.limit(0)).groupBy("d").agg(F.collect_set(F.struct("hi", "lo")).alias("_lost"))
        size = self.filters.agg(F.sum(F.length("filter"))).first()[0] or 0
        shipped = None
        if size <= self.ship_bytes:       # else the exact join below does without the filters' help
            shipped = self.spark.sparkContext.broadcast({r["shard"]: bytes(r["filter"]) for r in self.filters.collect()})
        hot = self.counts.where(F.col("n_docs") >= self.min_docs).select("hi", "lo", "keeper")
        lost = self._keys(docs, shipped).join(hot, ["hi", "lo"]).where(F.col("d") != F.col("keeper"))
        return lost.groupBy("d").agg(F.collect_set(F.struct("hi", "lo")).alias("_lost"))

    def rewrite(self, docs: DataFrame) -> DataFrame:
        """``docs`` with the text rewritten and n_lines, n_dropped (long) added.  A null text becomes
        empty (one empty line); input columns named n_lines or n_dropped are replaced."""
        id_, text, min_chars = self.doc_id, self.text, self.min_chars
        lost = self.dropped(docs)
        whole = docs.select(F.struct("*").alias("_row"), F.col(id_).cast("long").alias("_d"), F.col(text).alias("_t"))
        joined = whole.join(lost, F.col("_d") == F.col("d"), "left").drop("d", "_d")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in row_slices(batch, "_t"):
                    out, n, gone = [], [], []
                    pairs = part.column("_lost")
                    hi, lo = pairs.flatten().field("hi").to_numpy(zero_copy_only=False), pairs.flatten().field("lo").to_numpy(zero_copy_only=False)
                    raw = np.stack([hi, lo], axis=1).astype(np.int64).tobytes()
                    at = 0
                    sizes = pairs.value_lengths().to_pylist()
                    for t, size in zip(part.column("_t").to_pylist(), sizes):
                        lines = (t or "").encode().split(b"\n")
                        n.append(len(lines))
                        if size:
                            drop = {raw[16 * k:16 * k + 16] for k in range(at, at + size)}
                            at += size
                            keep = [x for x in lines if len(x) < min_chars or key_of(x, min_chars) not in drop]
                            gone.append(len(lines) - len(keep))
                            out.append(b"\n".join(keep).decode())
                        else:
                            gone.append(0)
                            out.append(t or "")
                    yield pa.RecordBatch.from_arrays(
                        [part.column("_row"), pa.array(out, pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.int64())],
                        ["_row", "_new", "_n", "_gone"])

        row = joined.schema["_row"].dataType.simpleString()
        done = joined.mapInArrow(run, f"_row {row}, _new string, _n long, _gone long")
        keep = [F.col("_new").alias(c) if c == text else F.col("_row")[c].alias(c)
                for c in docs.columns if c not in ("n_lines", "n_dropped")]
        return done.select(*keep, F.col("_n").alias("n_lines"), F.col("_gone").alias("n_dropped"))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, doc_id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """Line dedup of one table: insert every document, then rewrite every document."""
    state = LineDedup(docs.sparkSession, min_chars, min_docs, doc_id=doc_id, text=text)
    return state.insert(docs).rewrite(docs)
