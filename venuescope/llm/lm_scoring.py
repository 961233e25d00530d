"""Language-model scores from a log-frequency Bloom filter.

Texts are turned into chunks of numbered words.  Each chunk sends its distinct n-grams, with their
counts over its training documents, to shards by n-gram hash.  A shard sums the counts, stores them
in its part of the filter and answers every chunk from it, one byte an n-gram.  The filter stores, for an n-gram of count c, one entry for each step of a
growing series of counts up to c, so asking for one step after the other until a miss
gives back c up to the step width: it holds quantised counts in a few bits each.  It grows
with the corpus, in more shards, and is never in one place.

The score smooths bigrams towards unigrams by a Dirichlet prior, both read from the
filter.  The base score needs exact counts: words whose count reaches a cut are sent to
the workers in a table of bounded size, all other words are settled by a join.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, list_array, mix64, row_slices, stage, stage_at, unstage
from .words import bytes_of, word_hashes

END = np.uint64(0x9AE16A3B2F90404F)        # the token after the last word; also stands before the first
BLOCK_BITS = 1 << 16                       # all entries of an n-gram lie in one block of the filter
PROBES = 4
STEP = 1.3
SPARE = 17                                 # bits of an n-gram's key beyond those that number the tokens of the corpus
CHUNK = 1_000_000                          # tokens of a task that ask together, about
SHARD = 1_000_000                          # tokens of the corpus for each shard of the filter, at most about


def steps(limit: int = 2**50) -> np.ndarray:
    """Least count of each step: 1, 2, 3, 4, 5, 7, 9, 11, ..."""
    out, x = [1], 1.0
    while out[-1] < limit:
        x *= STEP
        if math.ceil(x) > out[-1]:
            out.append(math.ceil(x))
    return np.array(out, np.int64)


STEPS = steps()
#: the middle of each step's counts; step 0 is none
MIDDLE = np.r_[0.0, (STEPS[:-1] + STEPS[1:] - 1) / 2]


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes of all rows end to end, offsets of the rows): words, then one end."""
    words, ends = word_hashes(*bytes_of(column))
    out = np.full(len(words) + len(column), END, np.uint64)
    rows = np.repeat(np.arange(len(column)), np.diff(ends))
    out[np.arange(len(words)) + rows] = words
    return out, ends + np.arange(len(ends))


def bigrams(tok: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it; rows end with END, so the first of a row follows END."""
    before = np.empty_like(tok)
    if len(tok):
        before[0], before[1:] = END, tok[:-1]
    return mix64(before * np.uint64(0xA0761D6478BD642F) + tok * np.uint64(0xE7037ED1A0B428DB) + np.uint64(2))


def _places(h: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Bits of an entry inside its block (rows x PROBES)."""
    x = mix64(h * np.uint64(0x8CB92BA72F3D8DD7) + step.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return np.stack([(x >> np.uint64(16 * i)) & np.uint64(0xFFFF) for i in range(PROBES)], axis=1).astype(np.int64)


def block_of(h: np.ndarray, blocks: int) -> np.ndarray:
    """The block that holds all entries of an n-gram."""
    return (h >> np.uint64(16)).astype(np.int64) % blocks


class LogFrequencyFilter:
    """Blocked Bloom filter of (n-gram, step) entries, whole or the blocks of one shard: block b of
    ``blocks`` is the (b // shards)th of shard b % shards."""

    def __init__(self, raw: bytes, first: dict[int, int], blocks: int | None = None, shards: int = 1):
        self.bits = np.frombuffer(raw, np.uint8)
        self.blocks = len(raw) * 8 // BLOCK_BITS if blocks is None else blocks
        self.shards = shards
        self.first = first                     # order -> first step stored

    @staticmethod
    def fill(h: np.ndarray, low: np.ndarray, n: np.ndarray, blocks: int, shards: int = 1, shard: int = 0) -> bytes:
        """The bits of a shard's blocks with an entry for each step of an n-gram from ``low`` up to its count."""
        times = np.maximum(np.searchsorted(STEPS, n, side="right") - low + 1, 0)
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        h, step = np.repeat(h, times), np.repeat(low, times) + nth
        bits = np.zeros(-(-(blocks - shard) // shards) * BLOCK_BITS, bool)
        bits[((block_of(h, blocks) // shards)[:, None] * BLOCK_BITS + _places(h, step)).ravel()] = True
        return np.packbits(bits, bitorder="little").tobytes()

    def has(self, h: np.ndarray, step: int) -> np.ndarray:
        at = (block_of(h, self.blocks) // self.shards)[:, None] * BLOCK_BITS + _places(h, np.full(len(h), step))
        return ((self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)

    def steps(self, order: int, h: np.ndarray) -> np.ndarray:
        """The last step stored for each n-gram: probe step after step until one is missing."""
        step, out, left = self.first[order], np.zeros(len(h), np.uint8), np.arange(len(h))
        while len(left) and self.blocks:
            left = left[self.has(h[left], step)]
            out[left] = step
            step += 1
        return out

    def counts(self, order: int, h: np.ndarray) -> np.ndarray:
        """Quantised counts."""
        return MIDDLE[self.steps(order, h)]


def token_chunks(docs: DataFrame, kind: str) -> DataFrame:
    """docs (d, held, t) as chunks of whole rows: their ids, folds and token counts, the distinct token
    hashes (``types``) and each token's number among them (``here``, by ``squeeze``)."""
    def run(batches):
        task, part_no, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            types, back, n = np.unique(np.concatenate([x[2] for x in held]), return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")               # the frequent words get small numbers
            number = np.empty(len(types), np.int32)
            number[order] = np.arange(len(types))
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            return pa.RecordBatch.from_arrays([
                pa.array([task], pa.int32()), pa.array([part_no], pa.int32()), *[one(pa.concat_arrays([x[i] for x in held])) for i in (0, 1)],
                one(pa.array(np.concatenate([x[3] for x in held]))), one(pa.array(types[order].astype(np.int64))), pa.array([squeeze(number[back])])],
                ["task", "part", "d", "held", "size", "types", "here"])

        for batch in batches:
            for part in row_slices(batch, "t"):
                tok, ends = tokens(part.column("t"))
                held.append((part.column("d"), part.column("held"), tok, np.diff(ends)))
                size += len(tok)
                if size >= CHUNK:
                    yield flush()
                    held, size, part_no = [], 0, part_no + 1
        if held:
            yield flush()

    return docs.mapInArrow(run, f"task int, part int, d array<{kind}>, held array<boolean>, size array<long>, types array<long>, here binary")


def _flat(part: pa.Table | pa.RecordBatch, name: str) -> pa.Array:
    col = part.column(name)
    return (col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col).flatten()


def squeeze(x: np.ndarray) -> bytes:
    """Integers below 2**31, compressed: all lowest bytes, then all second ones and so on."""
    return pa.compress(x.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True)


def unsqueeze(raw: bytes, n: int) -> np.ndarray:
    flat = np.frombuffer(pa.decompress(raw, 4 * n, "zstd"), np.uint8) if n else np.empty(0, np.uint8)
    return np.ascontiguousarray(flat.reshape(4, n).T).view("<i4").ravel()


def _bytes(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=ends[1:])
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(flat.astype(np.uint8))])


def key_bits(tokens_: int) -> int:
    """Upper bits of its hash that an n-gram goes by between chunks and shards: so many that another of the corpus has the
    same ones with a chance of about 2 ** -(SPARE - 1), far below that of a false hit in the filter."""
    return min(64, max(1, int(tokens_).bit_length()) + SPARE)


def place(key: np.ndarray) -> np.ndarray:
    """What the filter hashes for a key."""
    return mix64(key + np.uint64(0x9E3779B97F4A7C15))


def by_shard(h: np.ndarray, bits: int, blocks: int, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, keys, sizes): the order of the n-grams by shard and key, their keys in that order, the size of each shard."""
    key = h.astype(np.uint64) >> np.uint64(64 - bits)
    g = block_of(place(key), blocks) % shards
    order = np.lexsort((key, g))
    return order, key[order], np.bincount(g, minlength=shards)


def pack_keys(keys: np.ndarray, sizes: np.ndarray, bits: int) -> list[bytes]:
    """The sorted keys of each shard as compressed differences, all lowest bytes first."""
    step = keys.copy()
    step[1:] -= keys[:-1]
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    step[starts] = keys[starts]
    planes = -(-bits // 8)
    return [pa.compress(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :planes].T).tobytes(), "zstd", asbytes=True) if len(x) else b""
            for x in np.split(step, np.cumsum(sizes)[:-1])]


def unpack_keys(raw: bytes, n: int, bits: int) -> np.ndarray:
    planes = -(-bits // 8)
    out = np.zeros((n, 8), np.uint8)
    if n:
        out[:, :planes] = np.frombuffer(pa.decompress(raw, planes * n, "zstd"), np.uint8).reshape(planes, n).T
    return np.cumsum(out.view("<u8").ravel(), dtype=np.uint64)


def _chunk(row: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(types, here, sizes of the rows) of one chunk."""
    size = _flat(row, "size").to_numpy()
    return _flat(row, "types").to_numpy().astype(np.uint64), unsqueeze(row.column("here")[0].as_py(), int(size.sum())), size


def _trains(row: pa.RecordBatch, size: np.ndarray) -> np.ndarray:
    return np.repeat(~_flat(row, "held").to_numpy(zero_copy_only=False).astype(bool), size)


def count_words(chunks: DataFrame) -> DataFrame:
    """(h, n): exact counts of the words of the training documents."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                types, here, size = _chunk(row := batch.slice(i, 1))
                n = np.bincount(here[_trains(row, size)], minlength=len(types))
                yield pa.RecordBatch.from_arrays([pa.array(types[n > 0].astype(np.int64)), pa.array(n[n > 0])], ["h", "n"])

    return chunks.select("held", "size", "types", "here").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def find_steps(chunks: DataFrame, bits: int, blocks: int, shards: int) -> DataFrame:
    """(task, part, g, uni, two): the steps that shard ``g`` of the filter holds for a chunk's distinct words
    and bigrams there, one byte each, in the order of ``by_shard``.  All n-grams are stored from a count of one."""
    def ask(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                types, here, size = _chunk(row := batch.slice(i, 1))
                train = _trains(row, size)
                pairs, back = np.unique(bigrams(types[here]), return_inverse=True)
                cols, held = [], np.zeros(shards, bool)
                for h, at in ((types, here), (pairs, back)):
                    order, keys, sizes = by_shard(h, bits, blocks, shards)
                    n = np.bincount(at[train], minlength=len(h))[order]
                    cols += [pa.array(sizes.astype(np.int32)), pa.array(pack_keys(keys, sizes, bits), pa.binary()),
                             pa.array([squeeze(x) if len(x) else b"" for x in np.split(n, np.cumsum(sizes)[:-1])], pa.binary())]
                    held |= sizes > 0
                out = pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(row.column("task").to_numpy(), shards)), pa.array(np.repeat(row.column("part").to_numpy(), shards)),
                    pa.array(np.arange(shards, dtype=np.int32)), *cols], ["task", "part", "g", "uni_size", "uni", "uni_n", "two_size", "two", "two_n"])
                yield out.filter(pa.array(held))

    asked = chunks.select("task", "part", "held", "size", "types", "here").mapInArrow(
        ask, "task int, part int, g int, uni_size int, uni binary, uni_n binary, two_size int, two binary, two_n binary")

    def answer(part: pa.Table) -> pa.Table:
        held = {}
        for name in ("uni", "two"):
            sizes = part.column(f"{name}_size").to_numpy().astype(np.int64)
            keys = np.concatenate([unpack_keys(x, m, bits) for x, m in zip(part.column(name).to_pylist(), sizes.tolist())])
            h, back = np.unique(keys, return_inverse=True)
            n = np.concatenate([unsqueeze(x, m) for x, m in zip(part.column(f"{name}_n").to_pylist(), sizes.tolist())])
            held[name] = place(h), np.bincount(back, weights=n, minlength=len(h)).astype(np.int64), back, sizes
        h, n = (np.concatenate([held[name][i] for name in ("uni", "two")]) for i in (0, 1))
        raw = LogFrequencyFilter.fill(h, np.ones(len(h), np.int64), n, blocks, shards, part.column("g")[0].as_py())
        lm = LogFrequencyFilter(raw, {1: 1, 2: 1}, blocks, shards)
        found = [_bytes(lm.steps(order, held[name][0])[held[name][2]], held[name][3])
                 for order, name in ((1, "uni"), (2, "two"))]
        return pa.table([part.column("task"), part.column("part"), part.column("g"), *found], ["task", "part", "g", "uni", "two"])

    return asked.groupBy("g").applyInArrow(answer, "task int, part int, g int, uni binary, two binary")


def score_texts(docs: DataFrame, folds: int = 10, max_bits: int = 1 << 28, bits_per_entry: int = 10,
                head_words: int = 1 << 20, prior: float = 1000.0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per input row.

    Documents whose crc32(doc_id as text) mod ``folds`` is 0 are held out, as are null ids; the others train.
    A null or empty text is one end token.  Repeated rows train once each.  Without training
    documents N = V = 0 and every token has the base probability 1.  ``max_bits`` bounds a shard of the
    filter, not the filter; scores do not depend on it."""
    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    held = fold(F.col(doc_id), folds) <= 0
    kind = docs.schema[doc_id].dataType.simpleString()
    chunks, where = stage_at(token_chunks(docs.select(F.col(doc_id).alias("d"), held.alias("held"), F.col(text).alias("t")), kind), "lm-tokens")
    words = stage(count_words(chunks), "lm-words")
    sums = words.agg(F.count("*").alias("v"), F.sum("n").alias("n")).first()
    types, total = sums.v or 0, sums.n or 0
    below = total + 0.1 * (types + 1)
    ranks = words.groupBy("n").agg(F.count("*").alias("m"))
    frequent = ranks.orderBy(F.desc("n")).limit(head_words).collect()      # at most head_words numbers
    cut, room = None, head_words
    for r in frequent:
        if r.m > room:
            break
        cut, room = r.n, room - r.m
    head = words.where(F.col("n") >= cut).toArrow() if cut is not None else words.limit(0).toArrow()
    order = np.argsort(head.column("h").to_numpy())
    known = sc.broadcast((head.column("h").to_numpy()[order], head.column("n").to_numpy()[order]))
    size = chunks.agg(F.sum(F.aggregate("size", F.lit(0).cast("long"), lambda x, y: x + y))).first()[0] or 0
    blocks = max(1, -(-2 * size * bits_per_entry // BLOCK_BITS))     # an n-gram has no more entries than occurrences
    shards = min(blocks, max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), size // SHARD, -(-blocks * BLOCK_BITS // max_bits)))
    bits = key_bits(2 * size)
    found = find_steps(chunks, bits, blocks, shards)

    def finish(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        head_h, head_n = known.value
        types_, back, size = _chunk(chunk)
        tok, starts = types_[back], np.cumsum(size) - size
        pair, pair_back = np.unique(bigrams(tok), return_inverse=True)
        answers = answers.sort_by("g")
        steps_ = []
        for name, h in (("uni", types_), ("two", pair)):
            at = np.empty(len(h), np.uint8)
            at[by_shard(h, bits, blocks, shards)[0]] = np.frombuffer(b"".join(answers.column(name).to_pylist()), np.uint8)
            steps_.append(MIDDLE[at])
        uni, two = steps_[0], steps_[1][pair_back]
        here = uni[back]
        before = np.empty_like(here)
        before[0], before[1:] = 0.0, here[:-1]
        before[starts] = uni[np.flatnonzero(types_ == END)[0]]          # every row ends with END
        p = (np.minimum(two, before) + prior * (here + 0.1) / below) / (before + prior)
        score = np.add.reduceat(np.log10(np.minimum(p, 1.0)), starts)
        at = np.minimum(np.searchsorted(head_h, types_.astype(np.int64)), max(0, len(head_h) - 1))
        hit = head_h[at] == types_.astype(np.int64) if len(head_h) else np.zeros(len(types_), bool)
        base = np.where(hit, np.log10((head_n[at] + 0.1) / below) if len(head_h) else 0.0, 0.0)[back]
        rest = np.flatnonzero(~hit[back])
        lists = list_array(tok[rest].astype(np.int64), np.add.reduceat(~hit[back], starts, dtype=np.int64), pa.int64())
        n = len(size)
        return pa.table([
            _flat(chunk, "d"), _flat(chunk, "held"), pa.array(np.repeat(chunk.column("task").to_numpy(), n)),
            pa.array((chunk.column("part")[0].as_py() << 32) + np.arange(n)), pa.array(size),
            pa.array(np.add.reduceat(hit[back], starts, dtype=np.int64)), pa.array(np.add.reduceat(base, starts)), pa.array(score), lists],
            ["d", "held", "task", "row", "n_tokens", "known", "base", "score", "rest"])

    scored = stage(chunks.groupBy("task", "part").cogroup(found.groupBy("task", "part")).applyInArrow(
        finish, f"d {kind}, held boolean, task int, row long, n_tokens long, known long, base double, score double, rest array<long>"), "lm-scored")
    unstage(spark, where)                              # what follows reads the scored rows alone
    rare = words if cut is None else words.where(F.col("n") < cut)
    c = F.coalesce("n", F.lit(0))
    missed = (scored.select("task", "row", F.explode("rest").alias("h")).groupBy("task", "row", "h").agg(F.count("*").alias("times"))
              .join(rare, "h", "left").groupBy("task", "row").agg(
                  F.sum(F.col("times") * F.log10((c + 0.1) / F.lit(below))).alias("more"),
                  F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("also")))
    return scored.join(missed, ["task", "row"], "left").select(
        F.col("d").alias(doc_id), F.col("held").alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("also", F.lit(0))).cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score")
