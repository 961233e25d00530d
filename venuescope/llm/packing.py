"""Best-fit packing planned on the histogram of lengths.

Texts become token pieces of at most ``capacity`` ids.  Best fit runs over the
counts of the lengths, which are at most ``capacity`` numbers however many pieces
there are: whole groups of equal bins move together.  Its plan says, for each range
of ranks within a length, which bins and offsets they take.  Pieces get their rank
within their length from a per-task counter and the counts of the tasks before, and
take their slot by a join on it; no piece passes the driver and no length is sorted
or numbered in one task.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import row_slices, stage

_WORKER: dict = {}
_NOT_BLANK = "[\x1c-\x1f]"      # utf8_split_whitespace parts words at these, the tokenizer does not drop them

# a tokenizer with these rules lower-cases a plain word (visible ASCII and Latin-1 letters, no apostrophe) and gives its
# runs of letters, its digits and its runs of other signs each to the model by itself
_LOWERED = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
                                                {"type": "Lowercase"}]}
_PARTED = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
_PLAIN = "^[!-&(-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+$"
_PART = "([a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+)"


def takes_parts(path: str) -> bool:
    """Whether the tokenizer of a file has the rules above, and no added token is a part."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    return (spec["normalizer"] == _LOWERED and spec["pre_tokenizer"] == _PARTED
            and all(len(re.findall(_PART, t["content"].lower())) > 1 for t in spec["added_tokens"]))


def _texts(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()      # to_pylist() makes a scalar of each


class Words:
    """Ids of words by the library, kept in two generations of at most ``room`` words each, so words
    in steady use stay and rare ones go.  The tokenizer drops white space and no token holds any, so
    the words between are tokenised alone; unknown ones go to the library many at a time, parted by a
    special token, which cuts a text before anything else looks at it.  Where the tokenizer's rules allow it
    (``takes_parts``), plain words are lower-cased and cut by Arrow and their parts, which many words share, go to its
    model."""

    def __init__(self, path: str, room: int = 500_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tok, self.room = Tokenizer.from_file(path), room
        special = [(t.content, i) for i, t in self.tok.get_added_tokens_decoder().items() if t.special]
        self.mark, self.mark_id = special[0] if special else (None, None)
        self.model = self.tok.model if takes_parts(path) else None
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        by_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.signs = {c: by_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _recall(self, words: set[str]) -> set[str]:
        """The words of no generation; those of the old one are young again."""
        new = words.difference(self.young)
        # not intersection(): of a dict it walks every word ever kept
        kept = {w: self.old[w] for w in new if w in self.old}
        self.young.update(kept)
        return new.difference(kept)

    def _learn_parts(self, parts: list[str]) -> None:
        ids, ends = [], []
        for p in parts:
            ids += [t.id for t in self.model.tokenize(p if p.isascii() else p.translate(self.signs))]
            ends.append(4 * len(ids))
        raw = np.array(ids, "<u4").tobytes()
        self.young.update((p, raw[begin:end]) for p, begin, end in zip(parts, [0, *ends], ends))

    def _learn_plain(self, words: set[str]) -> set[str]:
        """Learns the plain words from their parts; returns the others.  Arrow cuts the words and lays the ids of
        their parts end to end, so Python sees a word when it is kept and a part when it is asked for."""
        new = pa.array([*words], pa.string())
        plain = pc.match_substring_regex(new, _PLAIN)
        for t in self.added:
            plain = pc.and_not(plain, pc.match_substring(new, t))
        others, new = new.filter(pc.invert(plain)), new.filter(plain)
        low = pc.utf8_lower(new)
        cut = pc.split_pattern(pc.ascii_ltrim(pc.replace_substring_regex(low, _PART, r" \1"), " "), " ")
        places = cut.flatten().dictionary_encode()
        parts = _texts(places.dictionary)
        self._learn_parts([*self._recall(set(parts))])
        # a word that is its own part is known by now
        more = pc.or_(pc.greater(pc.list_value_length(cut), 1), pc.not_equal(low, new))
        laid, ends = self._laid(parts, places.indices, cut)
        keep = more.to_numpy(zero_copy_only=False)
        self.young.update((w, laid[begin:end]) for w, begin, end in
                          zip(_texts(new.filter(more)), ends[:-1][keep].tolist(), ends[1:][keep].tolist()))
        return set(_texts(others))

    def _laid(self, words: list[str], places: pa.Array, lists: pa.Array) -> tuple[bytes, np.ndarray]:
        """The ids of the words at ``places`` end to end, and where those of each list of places begin and end."""
        if not len(places):
            return b"", np.zeros(len(lists) + 1, np.int64)
        ids = pa.array([*map(self.young.__getitem__, words)], pa.large_binary()).take(places)
        _, offsets, raw = ids.buffers()
        return (raw or pa.py_buffer(b"")).to_pybytes(), np.frombuffer(offsets, np.int64, len(ids) + 1)[lists.offsets.to_numpy()]

    def learn(self, words: set[str]) -> None:
        if len(self.young) > self.room:
            self.young, self.old = {}, self.young
        new = self._recall(words)
        if self.model is not None:
            new = self._learn_plain(new)
        alone = [w for w in new if self.mark is None or self.mark in w]
        new = list(new.difference(alone))
        groups = [new[i:i + 50] for i in range(0, len(new), 50)]
        for start in range(0, len(groups), 400):
            part = groups[start:start + 400]
            for group, ids in zip(part, self._encode([self.mark.join(g) for g in part])):
                ids = np.array([*ids, self.mark_id], "<u4")
                ends, raw = np.flatnonzero(ids == self.mark_id).tolist(), ids.tobytes()
                begin = 0
                for w, end in zip(group, ends, strict=True):
                    self.young[w] = raw[4 * begin:4 * end]
                    begin = end + 1
        for w, ids in zip(alone, self._encode(alone)):
            self.young[w] = np.array(ids, "<u4").tobytes()

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        """The ids of each text (null: none).  A word is looked up once however often the texts hold it, and
        its ids are brought to its places by Arrow."""
        texts = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts, "")
        if pc.any(pc.match_substring_regex(texts, _NOT_BLANK)).as_py():
            cut = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        else:
            cut = pc.utf8_split_whitespace(texts)
        places = cut.flatten().dictionary_encode()
        words = _texts(places.dictionary)
        self.learn(set(words))
        raw, ends = self._laid(words, places.indices, cut)
        ends = ends.tolist()
        return [raw[begin:end] for begin, end in zip(ends, ends[1:])]


def token_pieces(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece int, start long, length long, ids binary): the ids of each text by the
    library, without added special tokens, then ``end_id``; texts of more than ``capacity`` ids
    are cut every ``capacity``.  ``ids`` holds little-endian unsigned 32-bit integers.  A null
    or empty text is the end id alone; repeated rows and null ids each give their own pieces."""
    end, width = int(end_id).to_bytes(4, "little"), 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _WORKER.get(path) or _WORKER.setdefault(path, Words(path))
            # the larger a slice, the fewer of its words are those of another
            for part in row_slices(batch, "t", 8 << 20):
                rows, piece, start, ids = [], [], [], []
                for i, raw in enumerate(words.encode(part.column("t"))):
                    raw += end
                    for k, at in enumerate(range(0, len(raw), width)):
                        rows.append(i)
                        piece.append(k)
                        start.append(at // 4)
                        ids.append(raw[at:at + width])
                yield pa.RecordBatch.from_arrays(
                    [part.column("d").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array(ids, pa.binary())], ["d", "piece", "start", "length", "ids"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("d"), F.col(text).alias("t")).mapInArrow(
        run, f"d {kind}, piece int, start long, length long, ids binary").withColumnRenamed("d", doc_id)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit decreasing over counts.  Rows (length, rank_from, rank_to, bin, per_bin, offset):
    ranks rank_from.. below rank_to of that length go to consecutive bins, per_bin each, laid
    end to end from offset.  Bins with equal room are kept as ranges of bin numbers, so the work
    depends on the number of lengths and not on the counts."""
    room: dict[int, list[tuple[int, int]]] = {}        # room left -> ranges (first bin, bins)
    keys: list[int] = []                               # its keys, sorted
    out, bins = [], 0

    def put(left: int, first: int, n: int) -> None:
        if left and n:
            if left not in room:
                room[left] = []
                insort(keys, left)
            room[left].append((first, n))

    for length in sorted(counts, reverse=True):
        todo, rank = counts[length], 0
        while todo:
            i = bisect_left(keys, length)              # the tightest bins that still hold one
            if i < len(keys):
                left = keys[i]
                first, n = room[left].pop()
                if not room[left]:
                    del room[left]
                    keys.pop(i)
            else:
                left, first, n = capacity, bins, -(-todo // (capacity // length))
                bins += n
            per = left // length
            full = min(n, todo // per)
            if full:
                out.append((length, rank, rank + full * per, first, per, capacity - left))
                put(left - per * length, first, full)
                rank, todo, first, n = rank + full * per, todo - full * per, first + full, n - full
            if n and todo:                             # fewer than per are left: one bin takes them
                out.append((length, rank, rank + todo, first, todo, capacity - left))
                put(left - todo * length, first, 1)
                rank, todo, first, n = rank + todo, 0, first + 1, n - 1
            put(left, first, n)
    return out


def pack(pieces: DataFrame, capacity: int = 2048, length: str = "length") -> DataFrame:
    """Every row of ``pieces`` with sequence_id and offset (long): a place in a sequence of at
    most ``capacity``, gapless from 0.  Lengths must lie in 1..capacity (an error otherwise);
    rows are told apart by position alone, so repeated rows each get their own place."""
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            size = batch.column("_size").to_numpy()
            if len(size) and (size.min() < 1 or size.max() > capacity):
                raise ValueError(f"a length lies outside 1..{capacity}")
            order = np.argsort(size, kind="stable")
            run = np.arange(len(size)) - np.searchsorted(size[order], size[order])
            rank = np.empty(len(size), np.int64)
            rank[order] = seen[size[order]] + run
            seen += np.bincount(size, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(size), task, np.int32)), pa.array(rank)],
                [*batch.schema.names, "_task", "_rank"])

    spark = pieces.sparkSession
    own = pieces.select(F.struct("*").alias("_row"), F.col(length).cast("long").alias("_size"))
    schema = own.schema.simpleString()[len("struct<"):-1]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own.schema.fields)
    # once written, a piece's task and rank stay what they are, also when tasks run again
    kept = stage(own.mapInArrow(number, schema + ", _task int, _rank long"), "pack-pieces")
    counts = kept.groupBy("_size", "_task").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_size").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    hist = {r["_size"]: r["_n"] for r in counts.groupBy("_size").agg(F.sum("_n").alias("_n")).collect()}
    slots = spark.createDataFrame(plan(hist, capacity) or [], "_size long, _from long, _to long, _bin long, _per long, _off long")
    # at most a few rows for each pair of lengths, whatever the input: the broadcast is bounded
    segments = base.join(F.broadcast(slots), "_size").where("_base < _to and _base + _n > _from")
    at = F.col("_base") + F.col("_rank")
    return (kept.join(segments, ["_size", "_task"]).where((at >= F.col("_from")) & (at < F.col("_to")))
            .select("_row.*",
                    (F.col("_bin") + F.floor((at - F.col("_from")) / F.col("_per"))).cast("long").alias("sequence_id"),
                    (F.col("_off") + ((at - F.col("_from")) % F.col("_per")) * F.col("_size")).cast("long").alias("offset")))
