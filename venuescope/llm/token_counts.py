"""Token counts without a pre-token shuffle.

Two tiers, both map-side.  Tier one is a compact table of the lengths of
frequent pre-tokens, found by counting pre-tokens inside a few whole partitions
and sent to the workers once; its size is a parameter.  Tier two is each
worker's own bounded cache: a batch's pre-tokens that neither tier knows are
encoded together by the library and remembered.  No pre-token ever crosses a
shuffle, and the tables only save work: the counts are the library's for any
choice of them.

A pre-token is a run of spaces with the characters up to the next space or line
feed.  That is exact for a piece vocabulary in which the space mark occurs only
in leading runs and no piece holds a line feed (``check_model`` tests both).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_slices, utf8_size

MARK = "▁"        # how the library writes a space; the same character in a text counts as a space
_RUNS = re.compile(" +[^ ]*|[^ ]+")
_WORKER: dict = {}     # model path -> Lengths, kept by a worker process from task to task


def load_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def check_model(sp) -> None:
    """Raise unless splitting at spaces and line feeds is exact for this model."""
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if MARK in piece.lstrip(MARK) or "\n" in piece:
            raise ValueError(f"piece {piece!r} crosses a pre-token boundary")
    if len(sp.encode("\n")) != 2 or sp.encode("a  b", out_type=str)[0] != MARK + "a":
        raise ValueError("the model must prefix one space and keep spaces and line feeds")


def pretokens(text: str) -> tuple[int, list[str]]:
    """(line feeds, keys).  A key ``w`` stands for one space and ``w``; a key that begins
    with a line feed stands for what follows it, without a space (the line feed itself
    is counted apart).  Empty text has no key: the library gives it no token."""
    if not text:
        return 0, []
    if MARK in text:
        text = text.replace(MARK, " ")
    lines = (" " + text).split("\n")
    keys: list[str] = []
    for line in lines:
        if "  " in line or line.endswith(" "):
            keys += [x[1:] if x[0] == " " else "\n" + x for x in _RUNS.findall(line)]
        elif line:
            head, *rest = line.split(" ")
            if head:
                keys.append("\n" + head)
            keys += rest
    return len(lines) - 1, keys


class Lengths(dict):
    """Pre-token key -> number of tokens: the frequent ones for good, others up to ``room``."""

    def __init__(self, path: str, frequent: dict[str, int], room: int):
        super().__init__(frequent)
        self.sp, self.fixed, self.room = load_model(path), frequent, room

    def learn(self, keys: Iterable[str]) -> None:
        """Encode the unknown keys in one call of the library."""
        new = [k for k in keys if k not in self]
        if len(self) + len(new) > len(self.fixed) + self.room:
            used = {k: self[k] for k in keys if k in self}
            self.clear()
            self.update(self.fixed)
            self.update(used)
        for k, ids in zip(new, self.sp.encode(new, num_threads=1)):
            # "\n" + x is the prefix mark, the line feed, then x; "" is a lone space
            self[k] = len(ids) - 2 if k[:1] == "\n" else len(ids) if k else 1


def _lengths(path: str, frequent: dict[str, int], room: int) -> Lengths:
    if path not in _WORKER:
        _WORKER[path] = Lengths(path, frequent, room)
    return _WORKER[path]


def frequent_lengths(docs: DataFrame, path: str, text: str = "text", entries: int = 32768,
                     probe_partitions: int = 8, keep: int = 16384) -> dict[str, int]:
    """The ``entries`` most frequent pre-tokens of ``probe_partitions`` whole partitions,
    evenly spaced over the input, with their lengths.  Each of those tasks sends at most
    ``keep`` pairs, so what reaches the driver is bounded by the parameters."""
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for part in row_slices(batch, text):
                for t in part.column(text).to_pylist():
                    seen.update(pretokens(t or "")[1])
                if len(seen) > 16 * keep:
                    seen = Counter(dict(seen.most_common(4 * keep)))
        top = seen.most_common(keep)
        yield pa.RecordBatch.from_pydict({"k": pa.array([k for k, _ in top], pa.string()),
                                          "n": pa.array([n for _, n in top], pa.int64())})

    rdd = docs.select(text).mapInArrow(profile, "k string, n long").rdd.map(tuple)
    n = rdd.getNumPartitions()
    chosen = sorted({int(i) for i in np.linspace(0, n - 1, min(n, probe_partitions))}) if n else []
    found: Counter = Counter()
    for k, c in docs.sparkSession.sparkContext.runJob(rdd, lambda it: list(it), chosen) if chosen else []:
        found[k] += c
    sp = load_model(path)
    check_model(sp)
    lengths = Lengths(path, {}, entries)
    lengths.learn([k for k, _ in found.most_common(entries)])
    return dict(lengths)


def count_tokens(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = 4096,
                 entries: int = 32768, room: int = 400_000, probe_partitions: int = 8) -> DataFrame:
    """Tokens of every whole text: (doc_id, n_bytes, n_tokens, over_limit).

    Null and empty texts have 0 bytes and 0 tokens.  Repeated rows and null ids each give
    a row of their own; other columns are not read."""
    sc = docs.sparkSession.sparkContext
    frequent = sc.broadcast(frequent_lengths(docs, path, text, entries, probe_partitions))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = _lengths(path, frequent.value, room)
            totals: list[int] = []
            for part in row_slices(batch, "t"):
                cut = [pretokens(t or "") for t in part.column("t").to_pylist()]
                lengths.learn({k for _, keys in cut for k in keys})
                get = lengths.__getitem__
                totals += [feeds + sum(map(get, keys)) for feeds, keys in cut]
            n = pa.array(totals, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("d"), utf8_size(batch, "t"), n], ["d", "b", "n"])

    kind = docs.schema[doc_id].dataType.simpleString()
    out = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("t")).mapInArrow(count, f"d {kind}, b long, n long")
    return out.select(F.col("d").alias(doc_id), F.col("b").alias("n_bytes"), F.col("n").alias("n_tokens"),
                      (F.col("n") > limit).alias("over_limit"))
