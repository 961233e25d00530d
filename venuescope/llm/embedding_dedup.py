"""Embedding near-duplicates: random-hyperplane sign hashing in several tables, exact
cosine verification, distributed connected components.

Equal vectors of a label are first gathered into one representative with a count.
Representatives meet in the buckets of ``tables`` sign hashes; large buckets are
split into blocks, and each pair of blocks is one unit of work.  Inside it the cosine
of all pairs is a matrix product in double precision.  A pair counts in the first table
in which it meets, so what a task returns is a number of links and a root for each
vector, never a list of pairs.

With ``bits`` signs a table holds a pair at cosine c together with probability
(1 - arccos(c)/pi) ** bits; the number of tables follows from ``miss``, the accepted
chance that a pair at the threshold meets in none.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage
from .components import components
from .minhash import roots

BLOCK = 2048           # vectors of a bucket in one block
GROUP = 100_000        # memberships in one group of buckets, about


def shape(n: int, threshold: float, miss: float, bucket: int = 256) -> tuple[int, int]:
    """(bits, tables) for labels of up to ``n`` vectors."""
    bits = min(24, max(4, math.ceil(math.log2(max(n, 1) / bucket))))
    together = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - together))


def sign_keys(x: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """Bucket numbers (rows x tables, int32) of the rows of ``x``."""
    planes = np.random.default_rng([seed, x.shape[1]]).standard_normal((x.shape[1], bits * tables))
    signs = (x @ planes > 0).reshape(len(x), tables, bits)
    return (signs * (1 << np.arange(bits))).sum(axis=2).astype(np.int32)


def links(reps: DataFrame, threshold: float, bits: int, tables: int, seed: int, total: int) -> DataFrame:
    """(rep, links, root): for each bucket block, the links that a representative first meets
    there (copies counted) and the smallest representative tied to it inside the block."""
    def hash_rows(batches):
        for batch in batches:
            col = batch.column("vec")
            size = col.value_lengths().to_numpy()
            out = np.zeros((batch.num_rows, tables), np.int32)
            flat, ends = col.flatten().to_numpy().astype(np.float64), np.cumsum(size)
            for d in np.unique(size).tolist():
                at = np.flatnonzero(size == d)
                out[at] = sign_keys(flat[(ends[at] - d)[:, None] + np.arange(d)], bits, tables, seed)
            keys = pa.FixedSizeListArray.from_arrays(pa.array(out.ravel(), pa.int32()), tables).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], [*batch.schema.names, "keys"])

    kinds = {f.name: f.dataType.simpleString() for f in reps.schema.fields}
    hashed = stage(reps.mapInArrow(hash_rows, f"rep long, label {kinds['label']}, n long, vec {kinds['vec']}, keys array<int>"), "sign-hash")
    rows = hashed.select("*", F.size("vec").alias("dim"), F.posexplode("keys").alias("t", "key"))
    bucket = ["t", "label", "dim", "key"]
    sizes = rows.groupBy(*bucket).agg(F.count("*").alias("m")).where("m > 1")
    groups = max(1, total * tables // GROUP)
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64(F.lit(seed), "rep"), blocks).cast("int")
    parts = (rows.join(sizes, bucket).withColumn("blocks", blocks).withColumn("own", own)
             .withColumn("g", F.pmod(F.xxhash64(*bucket), F.lit(groups)).cast("int"))
             # a block meets itself and every other block of its bucket once
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("i", F.least("own", "with")).withColumn("j", F.greatest("own", "with"))
             .select("g", "i", "j", "own", F.xxhash64(*bucket).alias("b"), "t", "label", "dim", "key", "rep", "n", "vec", "keys"))

    def meet(part: pa.Table) -> pa.Table:
        col = lambda c: part.column(c).combine_chunks()
        num = lambda c: col(c).to_numpy(zero_copy_only=False)
        i, j = part.column("i")[0].as_py(), part.column("j")[0].as_py()
        rep, n, own, t, dim = (num(c) for c in ("rep", "n", "own", "t", "dim"))
        keys = col("keys").flatten().to_numpy().reshape(-1, tables)
        flat, ends = col("vec").flatten().to_numpy(), np.cumsum(dim)
        label = col("label").dictionary_encode().indices.to_numpy(zero_copy_only=False)     # labels of any type
        order = np.lexsort((num("key"), dim, label, t))
        same = np.stack([t, label, dim, num("key")])[:, order]
        cuts = np.flatnonzero(np.r_[True, (same[:, 1:] != same[:, :-1]).any(axis=0), True])
        got = []
        for x, y in zip(cuts, cuts[1:]):
            at = order[x:y]
            left, right = at[own[at] == i], at[own[at] == j]
            if not len(left) or not len(right) or i == j and len(left) < 2:
                continue
            d, table_no = int(dim[at[0]]), int(t[at[0]])
            unit = {}
            for side, rows_ in (("l", left), ("r", right)):
                v = flat[(ends[rows_] - d)[:, None] + np.arange(d)].astype(np.float64)
                unit[side] = v / np.sqrt((v * v).sum(axis=1))[:, None]
            p, q = np.nonzero(unit["l"] @ unit["r"].T >= threshold)
            a, b = left[p], right[q]
            keep = a < b if i == j else np.ones(len(a), bool)
            a, b = a[keep], b[keep]
            first = np.ones(len(a), bool)
            for s in range(table_no):                       # met in an earlier table: counted there
                first &= keys[a, s] != keys[b, s]
            a, b = a[first], b[first]
            if len(a):
                nodes = np.unique(np.r_[a, b])
                nodes = nodes[np.argsort(rep[nodes], kind="stable")]
                back = np.empty(len(rep), np.int64)
                back[nodes] = np.arange(len(nodes))
                a_, b_ = back[a], back[b]
                count = np.bincount(a_, weights=n[b], minlength=len(nodes)) + np.bincount(b_, weights=n[a], minlength=len(nodes))
                got.append((rep[nodes], count.astype(np.int64), rep[nodes[roots(len(nodes), a_, b_)]]))
        cat = lambda k: np.concatenate([g[k] for g in got]) if got else np.array([], np.int64)
        return pa.table({"rep": pa.array(cat(0), pa.int64()), "links": pa.array(cat(1), pa.int64()), "root": pa.array(cat(2), pa.int64())})

    return parts.groupBy("g", "i", "j").applyInArrow(meet, "rep long, links long, root long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, miss: float = 1e-6, seed: int = 11,
                    vec_id: str = "vec_id", vec: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per input row.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows with
    a null label or id, link with nothing (a null id has a null component and is not kept).
    Vectors of different lengths do not link.  Rows that repeat an id are vectors of their
    own and count as each other's links when they are near."""
    v = F.col("vec")
    good = (F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0)
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).alias("label"), F.col(vec).alias("vec"))
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    digest = [F.xxhash64(v).alias("h1"), F.xxhash64(F.lit(1), v).alias("h2")]
    known = stage(rows.where("good").select("id", "label", "vec", *digest), "vectors")
    keys = ["label", "h1", "h2"]
    # a class goes by a number of its own, as one id may stand in several
    classes = stage(known.groupBy(*keys).agg(F.min("id").alias("least"), F.count("*").alias("n"))
                    .withColumn("rep", F.monotonically_increasing_id()), "vector-classes")
    reps = (known.join(classes, keys).where("id = least").groupBy("rep", "label", "n").agg(F.first("vec").alias("vec")))
    counts = classes.groupBy("label").count().agg(F.max("count"), F.sum("count")).first()
    largest, total = counts[0] or 0, counts[1] or 0
    bits, tables = shape(largest, threshold, miss)
    found = stage(links(reps.select("rep", "label", "n", "vec"), threshold, bits, tables, seed, total), "vector-links")
    joined = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    sums = found.groupBy("rep").agg(F.sum("links").alias("links"))
    of_rep = (classes.join(sums, "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
              .withColumn("component", F.coalesce("component", "rep")))
    names = of_rep.groupBy("component").agg(F.min("least").alias("component_id"))
    of_rep = of_rep.join(names, "component").select(*keys, (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    linked = known.select("id", *keys).join(of_rep, keys).select("id", "n_links", "component_id")
    alone = rows.where("not good").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.union(alone)
    return out.select(F.col("id").alias(vec_id), "n_links", "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
