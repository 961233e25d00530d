"""Removal of byte strings that repeat anywhere in the corpus, by suffix sorting in shards.

Every window of ``length`` bytes is owned by its least-hashed ``anchor`` bytes, so equal windows
have equal owners and meet in one shard.  Consecutive windows of one owner form a snippet.
Snippets whose owner occurs once hold no repeat.  Equal snippets are one string with a count: with
two or more occurrences all its windows repeat.  The distinct snippets of an owner are compared
in the shard of that owner: a Burrows-Wheeler transform of the shard and bounded interval
expansion (``bwt.py``) say which windows start twice.  An owner with very many
distinct snippets (a phrase in a large share of all documents, each time in other words) is no
single task: its windows are counted by digest in an aggregation instead.

Texts are told apart by a 128-bit digest, and what is found depends on the text alone, so copies
of a text share one result and no order or position of rows matters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bwt import repeated_starts
from .common import mix64, row_slices, stage
from .words import _power, bytes_of

LENGTH, ANCHOR = 200, 64
SHARD = 2_000_000                # bytes of snippets in a shard, about
CROWD = 4096                     # distinct snippets of one owner that a shard takes
_SNIPPET = "t1 long, t2 long, owner long, digest long, start int, size int"


def _running(raw: np.ndarray) -> np.ndarray:
    up, _ = _power(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    return total


def _hash(total: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges begin..end of a text with that running sum."""
    _, down = _power(len(total))
    return mix64((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width``, from minima towards both sides inside blocks."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, 2**64 - 1, np.uint64)
    padded[:len(x)] = x
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def snippets(raw: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(owner, digest, start, size) of the snippets of one text; none if it is shorter than ``length``.

    A new snippet starts where the owner's place moves: to another hash, or to the next occurrence of
    the same one as the first leaves the window.  So two equal windows are never in one snippet."""
    if len(raw) < length:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    total = _running(raw)
    at = np.arange(len(raw) - anchor + 1)
    h = _hash(total, at, at + anchor)
    owner = sliding_min(h, length - anchor + 1)
    start = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (h[:len(owner) - 1] == owner[:-1])])
    end = np.r_[start[1:], len(owner)] - 1 + length
    return owner[start], _hash(total, start, end), start, end - start


def _rows(batches, cut):
    """Run ``cut`` (row bytes -> columns) over the rows of batches of (t1, t2, t)."""
    for batch in batches:
        for part in row_slices(batch, "t"):
            raw, ends = bytes_of(part.column("t"))
            got = [cut(raw[a:b]) for a, b in zip(ends, ends[1:])]
            row = np.repeat(np.arange(len(got)), [len(g[0]) for g in got])
            yield part, row, [np.concatenate(c) for c in zip(*got)]


def find_snippets(texts: DataFrame, length: int, anchor: int) -> DataFrame:
    def run(batches):
        for part, row, (owner, digest, start, size) in _rows(batches, lambda raw: snippets(raw, length, anchor)):
            row = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [part.column("t1").take(row), part.column("t2").take(row), pa.array(owner.astype(np.int64)), pa.array(digest.astype(np.int64)),
                 pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32))], ["t1", "t2", "owner", "digest", "start", "size"])

    return texts.mapInArrow(run, _SNIPPET)


def _bytes_of_snippets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(owner, digest, bytes) of the snippets ``wanted`` (t1, t2, owner, digest, start, size)."""
    lists = wanted.groupBy("t1", "t2").agg(F.collect_list(F.struct("owner", "digest", "start", "size")).alias("w"))

    def run(batches):
        for batch in batches:
            for part in row_slices(batch, "t"):
                raw, ends = bytes_of(part.column("t"))
                count = part.column("w").value_lengths().to_numpy()
                flat = part.column("w").flatten()
                begin = np.repeat(ends[:-1], count) + flat.field("start").to_numpy()
                data = raw.tobytes()
                cut = [data[a:a + n] for a, n in zip(begin.tolist(), flat.field("size").to_pylist())]
                yield pa.RecordBatch.from_arrays([flat.field("owner"), flat.field("digest"), pa.array(cut, pa.binary())], ["owner", "digest", "bytes"])

    out = texts.join(lists, ["t1", "t2"]).select("t", "w").mapInArrow(run, "owner long, digest long, bytes binary")
    return out.dropDuplicates(["owner", "digest"])               # copies of a text bring the same snippets


def _runs(again: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begins, ends) of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.r_[False, again, False].astype(np.int8)))
    return edge[::2], edge[1::2]


def _expand(shards: DataFrame, length: int) -> DataFrame:
    """(owner, digest, begin, end) of the repeated bytes of the snippets of each shard."""
    def search(part: pa.Table) -> pa.Table:
        pieces = part.column("bytes").to_pylist()
        text = np.frombuffer(b"".join(p + b"\xff" for p in pieces), np.uint8)       # no byte of UTF-8 text
        again = repeated_starts(text, length)
        at, row, begins, ends = 0, [], [], []
        for i, p in enumerate(pieces):
            a, b = _runs(again[at:at + len(p) - length + 1])
            row += [i] * len(a)
            begins.append(a)
            ends.append(b - 1 + length)
            at += len(p) + 1
        take = pa.array(row, pa.int64())
        flat = lambda x: pa.array(np.concatenate(x).astype(np.int32)) if x else pa.array([], pa.int32())
        return pa.table({"owner": part.column("owner").take(take), "digest": part.column("digest").take(take),
                         "begin": flat(begins), "end": flat(ends)})

    return shards.groupBy("shard").applyInArrow(search, "owner long, digest long, begin int, end int")


def _count_windows(crowded: DataFrame, length: int) -> DataFrame:
    """The same for snippets of crowded owners, by counting the digest of every window."""
    def cut(batches):
        for batch in batches:
            for part in row_slices(batch, "bytes", 1 << 18):
                raw, ends = bytes_of(part.column("bytes"))
                got = []
                for a, b in zip(ends, ends[1:]):
                    at = np.arange(b - a - length + 1)
                    got.append(_hash(_running(raw[a:b]), at, at + length))
                size = [len(g) for g in got]
                row = pa.array(np.repeat(np.arange(len(got)), size))
                start = np.concatenate([np.arange(n) for n in size]) if size else np.zeros(0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("owner").take(row), part.column("digest").take(row), pa.array(start.astype(np.int32)),
                     pa.array(np.concatenate(got).astype(np.int64) if got else np.zeros(0, np.int64))], ["owner", "digest", "begin", "window"])

    windows = crowded.select("owner", "digest", "bytes").mapInArrow(cut, "owner long, digest long, begin int, window long")
    twice = windows.groupBy("owner", "window").count().where("count > 1").select("owner", "window")
    return windows.join(twice, ["owner", "window"]).select("owner", "digest", "begin", (F.col("begin") + length).alias("end"))


def repeated_ranges(texts: DataFrame, length: int, anchor: int) -> DataFrame:
    """(t1, t2, ranges array<struct<begin, end>>): the bytes of each text that lie in a repeated window.

    ``texts``: (t1, t2, t), the digest of each row's text and the text."""
    all_ = find_snippets(texts, length, anchor)
    owners = all_.groupBy("owner").agg(F.count("*").alias("n"), F.min("digest").alias("lo"), F.max("digest").alias("hi")).where("n > 1")
    several = all_.join(owners.select("owner", (F.col("lo") < F.col("hi")).alias("mixed")), "owner")
    # copies of a text bring equal rows: they are summed before the shuffle
    seen = stage(several.groupBy("t1", "t2", "owner", "digest", "start", "size", "mixed").agg(F.count("*").alias("m")), "suffix-snippets")
    mixed = seen.where("mixed").groupBy("owner", "digest").agg(
        F.sum("m").alias("m"), F.min(F.struct("t1", "t2", "start", "size")).alias("one"))
    mixed = stage(mixed.select("owner", "digest", "m", "one.*"), "suffix-distinct")
    crowds = mixed.groupBy("owner").agg(F.count("*").alias("k"), F.sum("size").alias("bytes"))
    total = crowds.agg(F.sum("bytes")).first()[0] or 0
    strings = _bytes_of_snippets(texts, mixed.select("t1", "t2", "owner", "digest", "start", "size"))
    strings = stage(strings.join(crowds.select("owner", (F.col("k") > CROWD).alias("crowded")), "owner"), "suffix-strings")
    shard = F.pmod(F.xxhash64("owner"), F.lit(max(1, total // SHARD))).cast("int").alias("shard")
    found = _expand(strings.where("not crowded").select("owner", "digest", "bytes", shard), length).union(
        _count_windows(strings.where("crowded"), length))
    # snippets that occur twice are covered whole; of the others, what the shards found
    twice = mixed.where("m > 1").select("owner", "digest", F.lit(0).alias("begin"), F.col("size").alias("end"))
    single = found.join(mixed.where("m = 1").select("owner", "digest"), ["owner", "digest"], "left_semi")
    parts = twice.union(single).groupBy("owner", "digest").agg(F.collect_list(F.struct("begin", "end")).alias("parts"))
    one = seen.where("not mixed").select("t1", "t2", F.col("start").alias("begin"), (F.col("start") + F.col("size")).alias("end"))
    some = (seen.where("mixed").join(parts, ["owner", "digest"]).select("t1", "t2", "start", F.explode("parts").alias("p"))
            .select("t1", "t2", (F.col("start") + F.col("p.begin")).alias("begin"), (F.col("start") + F.col("p.end")).alias("end")))
    return one.union(some).groupBy("t1", "t2").agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, text: str = "text",
                   rewrite: bool = False) -> DataFrame:
    """``docs`` with kept (binary: the bytes left), n_bytes, n_removed and n_spans (long) added.
    With ``rewrite`` only the columns of ``docs``, their text replaced by the bytes left, without characters
    that a removal cut through.

    Bytes covered by a ``length``-byte string that also starts anywhere else, in the same or another row, go.
    A null text counts as empty; texts shorter than ``length`` stay; each repeated row is an
    occurrence of its own.  Input columns named kept, n_bytes, n_removed or n_spans are replaced."""
    if not 0 < anchor < length:
        raise ValueError("the anchor must be shorter than the string")
    t = F.coalesce(F.col(text), F.lit(""))
    digest = [F.xxhash64(t).alias("t1"), F.xxhash64(F.lit(1), t).alias("t2")]
    ranges = repeated_ranges(docs.select(*digest, t.alias("t")), length, anchor)
    whole = docs.select(F.struct("*").alias("_row"), *digest, t.alias("_t")).join(ranges, ["t1", "t2"], "left").drop("t1", "t2")

    def run(batches):
        for batch in batches:
            for part in row_slices(batch, "_t"):
                raw, ends = bytes_of(part.column("_t"))
                count = np.nan_to_num(part.column("ranges").value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
                flat = part.column("ranges").flatten()
                step = np.zeros(len(raw) + 1, np.int64)
                base = np.repeat(ends[:-1], count)
                np.add.at(step, base + flat.field("begin").to_numpy(), 1)
                np.add.at(step, base + flat.field("end").to_numpy(), -1)
                gone = np.cumsum(step)[:-1] > 0
                first = gone & np.r_[True, ~gone[:-1]] if len(gone) else gone
                if len(gone):
                    first[ends[:-1][ends[:-1] < len(raw)]] |= gone[ends[:-1][ends[:-1] < len(raw)]]
                left = np.r_[0, np.cumsum(~gone)][ends]
                data = raw[~gone].tobytes()
                kept = [data[a:b] for a, b in zip(left, left[1:])]
                if rewrite:
                    new = pa.array([b.decode("utf-8", "ignore") for b in kept], pa.string())
                    yield pa.RecordBatch.from_arrays([part.column("_row"), new], ["_row", "_new"])
                    continue
                removed = np.diff(np.r_[0, np.cumsum(gone)][ends])
                spans = np.diff(np.r_[0, np.cumsum(first)][ends])
                yield pa.RecordBatch.from_arrays(
                    [part.column("_row"), pa.array(kept, pa.binary()), pa.array(np.diff(ends)), pa.array(removed.astype(np.int64)),
                     pa.array(spans.astype(np.int64))], ["_row", "kept", "n_bytes", "n_removed", "n_spans"])

    row = whole.schema["_row"].dataType.simpleString()
    if rewrite:
        done = whole.mapInArrow(run, f"_row {row}, _new string")
        return done.select(*[F.col("_new").alias(c) if c == text else F.col("_row")[c].alias(c) for c in docs.columns])
    done = whole.mapInArrow(run, f"_row {row}, kept binary, n_bytes long, n_removed long, n_spans long")
    own = ("kept", "n_bytes", "n_removed", "n_spans")
    return done.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c not in own], *own)
