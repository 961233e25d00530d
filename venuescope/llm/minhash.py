"""Near-duplicate documents by circulant MinHash.

One permutation, sigma, scatters the shingles over a universe of 2**32 places, a second one of its own, pi,
circularly shifted by k, gives coordinate k of the signature, so two permutations make
all of them.  Bands of the signature propose pairs; full shingle sets confirm them.

Documents with equal sets form a class, which is a vertex of its own whatever ids its documents have.  Two classes that share
a band are a candidate pair unless their signatures agree in fewer coordinates than a linked
pair's would but for a chance of about 1e-5.  Candidate pairs are not listed.  The connected
components of their graph, the clusters, come from each band's pairs with its smallest member and,
where a band still spans clusters, from a comparison of signatures in blocks, the band's largest cluster with the others and
these with each other, that returns a root for each member.  A cluster's documents are then compared on their full sets: first each with the
smallest of its band, then, where the cluster is not yet tied together, all pairs that are not,
in pairs of blocks that again return roots.  So what moves grows with the documents, however
many of a group's pairs are alike without being linked.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import list_array, mix64, row_slices, stage
from .components import components
from .words import bytes_of, shingle_hashes, word_hashes

BANDS, ROWS = 32, 4                 # a pair at 0.75 shares a band but for 5e-6
COORDINATES = BANDS * ROWS
BLOCK = 1024                        # members of a band, or documents of a cluster, in one block
BLOCK_BYTES = 8 << 20               # of their texts
GROUP = 20_000                      # memberships in one group of bands, about


def _scatter(x: np.ndarray) -> np.ndarray:
    """sigma: a permutation of the 32-bit integers."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def _permute(x: np.ndarray) -> np.ndarray:
    """pi: another permutation of the 32-bit integers."""
    x = x ^ (x >> np.uint32(17))
    x *= np.uint32(0xED5AD4BB)
    x ^= x >> np.uint32(11)
    x *= np.uint32(0xAC4C1B51)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x31848BAB)
    x ^= x >> np.uint32(14)
    return x


def signatures(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Signatures (rows x COORDINATES, uint32) of sets laid end to end, each with a shingle or more.

    Coordinate k is the least place of pi(sigma(s) - k): sigma once for each shingle, pi on the
    places shifted around the circle."""
    out = np.empty((len(starts), COORDINATES), np.uint32)
    places = _scatter((shingles >> np.uint64(32)).astype(np.uint32))
    for k in range(COORDINATES):
        out[:, k] = np.minimum.reduceat(_permute(places - np.uint32(k)), starts)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each signature; bands do not share keys."""
    parts = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for j in range(ROWS):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return key.astype(np.int64)


def row_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each row."""
    words, ends = word_hashes(*bytes_of(column))
    return [np.unique(shingle_hashes(words[a:b], size)) for a, b in zip(ends, ends[1:])]


def sliced_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """row_sets for many texts, a slice at a time."""
    batch = pa.RecordBatch.from_arrays([column], ["t"])
    return [x for part in row_slices(batch, "t") for x in row_sets(part.column("t"), size)]


def sketch(docs: DataFrame, size: int, doc_id: str, text: str) -> DataFrame:
    """(d, m, n_shingles, h1, h2, bands, sig): md5 of the text, set size, a digest of the set, band keys and the
    low byte of each coordinate.  An empty set has null digest, bands and signature."""
    def run(batches):
        import xxhash

        for batch in batches:
            for part in row_slices(batch, "t", 1 << 19):
                sets = row_sets(part.column("t"), size)
                n = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(n)
                bands, sig, digest = np.empty((0, BANDS), np.int64), np.empty((0, COORDINATES), np.uint32), []
                if len(full):
                    sig = signatures(np.concatenate([sets[i] for i in full]), np.r_[0, np.cumsum(n[full])[:-1]])
                    bands = band_keys(sig)
                    digest = [xxhash.xxh3_128_digest(sets[i].tobytes()) for i in full]
                place = np.full(len(n), -1)
                place[full] = np.arange(len(full))
                take = pa.array([None if p < 0 else p for p in place.tolist()], pa.int64())
                halves = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([
                    part.column("d"), part.column("m"), pa.array(n), pa.array(halves[:, 0]).take(take), pa.array(halves[:, 1]).take(take),
                    list_array(bands.ravel(), np.full(len(bands), BANDS), pa.int64()).take(take),
                    pa.array([row.tobytes() for row in sig.astype(np.uint8)], pa.binary()).take(take)],
                    ["d", "m", "n_shingles", "h1", "h2", "bands", "sig"])

    return docs.select(F.col(doc_id).cast("long").alias("d"), F.md5(text).alias("m"), F.col(text).alias("t")).mapInArrow(
        run, "d long, m string, n_shingles long, h1 long, h2 long, bands array<long>, sig binary")


def agreement_floor(threshold: float) -> int:
    """Coordinates in which a pair at the threshold agrees but for a chance of about 1e-5."""
    return max(1, int(COORDINATES * threshold - 4.3 * np.sqrt(COORDINATES * threshold * (1 - threshold))))


def confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach ``percent`` of their union."""
    left = texts.select(F.col("d").alias("a"), F.col("t").alias("ta"))
    right = texts.select(F.col("d").alias("b"), F.col("t").alias("tb"))

    def run(batches):
        last: dict = {}
        for batch in batches:
            for part in row_slices(batch, "ta", 1 << 19):
                keep = []
                theirs = row_sets(part.column("tb"), size)
                for a, raw, y in zip(part.column("a").to_pylist(), part.column("ta"), theirs):
                    if a not in last:
                        if len(last) > 64:
                            last.clear()
                        last[a] = row_sets(pa.array([raw.as_py()], pa.string()), size)[0]
                    x = last[a]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= percent * (len(x) + len(y) - both))
                part = part.filter(pa.array(keep, pa.bool_()))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def similar(pairs: DataFrame, sigs: DataFrame, floor: int) -> DataFrame:
    """The pairs whose signatures agree in ``floor`` coordinates or more."""
    def run(batches):
        for batch in batches:
            mats = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, COORDINATES) for c in ("sa", "sb")]
            part = batch.filter(pa.array((mats[0] == mats[1]).sum(axis=1) >= floor))
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"])

    both = pairs.join(sigs.select(F.col("d").alias("a"), F.col("sig").alias("sa")), "a")
    both = both.join(sigs.select(F.col("d").alias("b"), F.col("sig").alias("sb")), "b")
    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of 0..n-1 by the links a-b."""
    low = np.arange(n)
    while len(a):
        m = np.minimum(low[a], low[b])
        new = low.copy()
        np.minimum.at(new, a, m)
        np.minimum.at(new, b, m)
        new = new[new]
        if np.array_equal(new, low):
            break
        low = new
    return low


def _edges(d: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """(2 x edges) one edge from each document of the links p-q to the root of its own."""
    nodes = np.unique(np.r_[p, q])
    low = nodes[roots(len(nodes), np.searchsorted(nodes, p), np.searchsorted(nodes, q))]
    return np.stack([d[nodes], d[low]])[:, nodes != low]


def _table(edges: list[np.ndarray]) -> pa.Table:
    flat = np.concatenate(edges, axis=1) if edges else np.empty((2, 0), np.int64)
    return pa.table({"a": pa.array(flat[0], pa.int64()), "b": pa.array(flat[1], pa.int64())})


def in_blocks(rows: DataFrame, group: str, part: str, size=None) -> DataFrame:
    """rows with (i, j, own): a row for each pair of blocks (i <= j) of its group in which it takes part, being of
    block ``own``.  The parts of a group are tied together in themselves, so those of its largest one meet only the
    others; these meet each other too.  Groups of one part are left out.  ``size``: bytes of a row."""
    size = F.lit(0).cast("bigint") if size is None else size
    parts_of = rows.groupBy(group, part).agg(F.count("*").alias("k"), F.sum(size).alias("s"))
    main = parts_of.groupBy(group).agg(F.max(F.struct("k", part, "s")).alias("main"), F.sum("k").alias("m"),
                                       F.sum("s").alias("bytes"), F.count("*").alias("parts")).where("parts > 1")
    blocks = lambda k, s: F.ceil(F.greatest(k / BLOCK, s / BLOCK_BYTES)).cast("int")
    k, s = F.col("main.k"), F.col("main.s")
    main = main.select(group, F.col(f"main.{part}").alias("main"), blocks(k, s).alias("mains"),
                       blocks(F.col("m") - k, F.col("bytes") - s).alias("rest"))
    out = rows.join(main, group).withColumn("first", F.col(part) == F.col("main"))
    spread = F.xxhash64(F.lit(5), "d")
    out = out.withColumn("own", F.when(F.col("first"), F.pmod(spread, F.col("mains"))).otherwise(F.col("mains") + F.pmod(spread, F.col("rest"))).cast("int"))
    # blocks 0..mains-1 hold the largest part; they meet the blocks after them, which also meet each other
    out = out.withColumn("with", F.explode(F.when(F.col("first"), F.sequence("mains", F.col("mains") + F.col("rest") - 1))
                                           .otherwise(F.sequence(F.lit(0), F.col("mains") + F.col("rest") - 1))))
    return out.select(*rows.columns, F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own")


def across_clusters(members: DataFrame, floor: int, groups: int) -> DataFrame:
    """Edges (a, b) that tie together the documents of different clusters which share a band and agree
    in ``floor`` coordinates.  members: (band, d, cluster, sig) of bands with several clusters."""
    parts = in_blocks(members, "band", "cluster").withColumn("g", F.pmod(F.xxhash64("band"), F.lit(groups)).cast("int"))

    def meet(part: pa.Table) -> pa.Table:
        num = lambda c: part.column(c).to_numpy()
        i, j = part.column("i")[0].as_py(), part.column("j")[0].as_py()
        d, cluster, own, band = num("d"), num("cluster"), num("own"), num("band")
        sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint8).reshape(-1, COORDINATES)
        order = np.argsort(band, kind="stable")
        cuts = np.flatnonzero(np.r_[True, band[order][1:] != band[order][:-1], True])
        out = []
        for x, y in zip(cuts, cuts[1:]):
            at = order[x:y]
            left, right = at[own[at] == i], at[own[at] == j]
            p, q = [], []
            for r in left.tolist():                            # one row against a block
                other = right[cluster[right] != cluster[r]]
                other = other[(sig[other] == sig[r]).sum(axis=1) >= floor]
                p.append(np.full(len(other), r))
                q.append(other)
            if p and sum(map(len, p)):
                out.append(_edges(d, np.concatenate(p), np.concatenate(q)))
        return _table(out)

    # bands are small next to a group of them: deal the groups to as many tasks
    return parts.repartition(groups, "g", "i", "j").groupBy("g", "i", "j").applyInArrow(meet, "a long, b long")


def linked_pairs(left: list[np.ndarray], right: list[np.ndarray], percent: int, width: int = 4096) -> np.ndarray:
    """Whether each pair of sets reaches ``percent`` of its union (len(left) x len(right)), exactly: the sizes of
    all intersections are a product of 0/1 matrices over the shingles that several sets hold."""
    sets = left + right
    size = np.array([len(x) for x in sets])
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    new = np.r_[True, flat[1:] != flat[:-1]]
    shared = ~(new & np.r_[new[1:], True])
    row, col = row[shared], np.cumsum(new[shared]) - 1
    both = np.zeros((len(left), len(right)), np.float32)        # whole numbers below 2**24: exact
    for begin in range(0, int(col[-1]) + 1 if len(col) else 0, width):
        a, b = np.searchsorted(col, [begin, begin + width])
        held = np.zeros((len(sets), width), np.float32)
        held[row[a:b], col[a:b] - begin] = 1
        both += held[:len(left)] @ held[len(left):].T
    both = both.astype(np.int64)
    return 100 * both >= percent * (size[:len(left), None] + size[None, len(left):] - both)


def across_components(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Edges (a, b) that tie together the documents of one cluster and different components whose full sets
    are linked.  docs: (d, cluster, component, t).  Each cluster's largest share may be tied together
    already: its documents meet those of the other components only."""
    rows = in_blocks(docs, "cluster", "component", F.octet_length("t"))

    def meet(part: pa.Table) -> pa.Table:
        i, j = part.column("i")[0].as_py(), part.column("j")[0].as_py()
        d, component, own = (part.column(c).to_numpy() for c in ("d", "component", "own"))
        sets = sliced_sets(pa.concat_arrays(part.column("t").chunks), size)
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        if not len(left) or not len(right):
            return _table([])
        hit = linked_pairs([sets[x] for x in left], [sets[x] for x in right], percent)
        hit &= component[left][:, None] != component[right][None, :]
        p, q = np.nonzero(hit)
        return _table([_edges(d, left[p], right[q])] if len(p) else [])

    return rows.groupBy("cluster", "i", "j").applyInArrow(meet, "a long, b long")


def _named(pairs: DataFrame, name: str) -> DataFrame:
    """(d, name): the smallest a that a document is paired with as b.  Equal names mean that the
    documents hang together; different names say nothing."""
    return pairs.groupBy(F.col("b").alias("d")).agg(F.min("a").alias(name))


def judged(docs: DataFrame, size: int, percent: int, doc_id: str, text: str) -> DataFrame:
    """(d, m, n_shingles, component, component_id) of every row: ``component`` is the number of its component (null
    for an empty set or a null id), ``component_id`` the smallest id of it."""
    all_ = stage(sketch(docs, size, doc_id, text), "minhash-sketch")
    full = all_.where("h1 is not null and d is not null")
    # the number of a class is fixed once it is written
    classes = stage(full.groupBy("h1", "h2").agg(F.min("d").alias("rep"), F.min_by(F.struct("d", "m"), F.struct("d", "m")).alias("of"))
                    .withColumn("v", F.monotonically_increasing_id()), "minhash-classes")
    named = classes.select(F.col("of.d").alias("d"), F.col("of.m").alias("m"), "h1", "h2", "v")
    reps = full.join(named, ["d", "m", "h1", "h2"]).dropDuplicates(["v"])
    reps = stage(reps.select(F.col("v").alias("d"), F.col("d").alias("id"), "m", "bands", "sig"), "minhash-reps")

    bands = reps.select("d", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("m"), F.min("d").alias("first")).where("m > 1")
    members = stage(bands.join(shared, "band").select("band", "d", "first"), "minhash-members")

    sigs = reps.select("d", "sig")
    floor = agreement_floor(percent / 100)
    star = members.where("d <> first").select(F.col("first").alias("a"), F.col("d").alias("b")).distinct()
    tried = stage(similar(star, sigs, floor), "minhash-pairs")
    # a document that is like the smallest of its band takes its name: enough to close most bands
    now = members.join(_named(tried, "cluster"), "d", "left").select("band", "d", F.coalesce("cluster", "d").alias("cluster"))
    several = now.groupBy("band").agg(F.min("cluster").alias("lo"), F.max("cluster").alias("hi")).where("lo < hi")
    open_ = stage(now.join(several.select("band"), "band").join(sigs, "d").select("band", "d", "cluster", "sig"), "minhash-open")
    more = stage(across_clusters(open_, floor, max(1, open_.count() // GROUP)), "minhash-pairs")
    clusters = stage(components(tried.union(more)), "minhash-clusters").select(F.col("node").alias("d"), F.col("component").alias("cluster"))

    # the text of each class that has a cluster, by its smallest id and the digest of the text
    wanted = clusters.join(reps.select("d", "id", "m"), "d")
    texts = stage(docs.select(F.col(doc_id).cast("long").alias("id"), F.md5(text).alias("m"), F.col(text).alias("t"))
                  .join(wanted, ["id", "m"]).dropDuplicates(["d"]).select("d", "cluster", "t"), "minhash-texts")
    linked = stage(confirm(tried, texts, size, percent), "minhash-links")
    parts = texts.join(_named(linked, "component"), "d", "left").select("d", "cluster", F.coalesce("component", "d").alias("component"), "t")
    rest = stage(across_components(parts, size, percent), "minhash-links")
    tied = stage(components(linked.union(rest)), "minhash-components")
    of_class = stage(classes.join(tied.withColumnRenamed("node", "v"), "v", "left").select(
        "h1", "h2", "rep", F.coalesce("component", "v").alias("component")), "minhash-of-class")
    least = of_class.groupBy("component").agg(F.min("rep").alias("component_id"), F.count("*").alias("k"))
    # a component of one class needs no table to know its smallest id
    joined = of_class.join(least.where("k > 1").drop("k"), "component", "left").select(
        "h1", "h2", "component", F.coalesce("component_id", "rep").alias("component_id"))
    out = all_.select("d", "m", "n_shingles", "h1", "h2").join(joined, ["h1", "h2"], "left")
    has = F.col("d").isNotNull()
    return out.select("d", "m", "n_shingles", F.when(has, F.col("component")).alias("component"),
                      F.when(has, F.coalesce("component_id", "d")).alias("component_id"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 75, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row.

    Null, empty and blank texts have an empty set and link with nothing.  Rows that repeat an id are vertices of their
    own, by their texts.  A null id links with nothing, has a null
    component and is not kept.  Other columns are not read."""
    out = judged(docs, size, percent, doc_id, text)
    return out.select(F.col("d").alias(doc_id), "n_shingles", "component_id",
                      F.coalesce(F.col("d") == F.col("component_id"), F.lit(False)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 75, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the smallest id (of several texts under
    it, that of the smallest digest).  Rows without an id and rows with an empty set stay; of rows that repeat both id and
    text one stays."""
    rows = stage(judged(docs, size, percent, doc_id, text).where("d is not null").select("d", "m", "component"), "minhash-judged")
    first = rows.where("component is not null").groupBy("component").agg(F.min(F.struct("d", "m")).alias("of"), F.count("*").alias("k")).where("k > 1")
    gone = (rows.join(first.select("component", "of"), "component").where((F.col("d") != F.col("of.d")) | (F.col("m") != F.col("of.m")))
            .select("d", "m").distinct())
    digest = F.md5(text)
    keyed = docs.select("*", F.struct(F.col(doc_id).cast("long").alias("d"), digest.alias("m")).alias("__row"))
    left = keyed.join(gone.select(F.struct("d", "m").alias("__gone")), (F.col("__row.d") == F.col("__gone.d")) & (F.col("__row.m") == F.col("__gone.m")), "left_anti")
    ids = rows.agg(F.count("*").alias("n"), F.countDistinct("d", F.coalesce("m", F.lit(""))).alias("k")).first()
    if ids.n != ids.k:
        left = left.where(F.col("__row.d").isNotNull()).dropDuplicates(["__row"]).union(left.where(F.col("__row.d").isNull()))
    return left.select(*docs.columns)
