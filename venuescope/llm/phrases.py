"""Phrase collocations by vertical partitioning of a suffix tree over words.

The tree of all word sequences is never built whole.  It is cut into subtrees by the first word of a
suffix, the prefix, and prefixes are put into groups whose suffixes together fit a budget:

1. one pass counts the words.  Frequent words (a table of bounded size) are packed into groups first-fit by
   their counts; one above the budget alone is extended by the words after it, dealt to several groups, and
   pairs above the budget, counted in a pass of their own, by the words after those; all other prefixes are dealt by hash
   to so many groups that each stays about within the budget;
2. a next pass cuts every suffix after ``max_words`` words, within its piece, merges equal ones of a batch
   and sends each prefix's rest to its group;
3. a group builds its subtrees on its own: its suffixes sorted word by word, so that every node is a
   run of neighbours and its count the total of the leaves below.  Only the nodes of pairs above the budget
   lie in several groups, and their totals are added.

Phrase counts are exact: words are compared as bytes, never by hash.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import row_slices, stage
from .words import bytes_of

_PLAIN, _SPACE, _CUT = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[32, 9]] = _SPACE
_KIND[[*b".,;:!?\n\x0b\x0c\r"]] = _CUT
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
BATCH = 4 << 20                    # bytes of text whose suffixes are merged before they are sent


def piece_words(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words of all rows end to end as bytes, row of each, piece of each): A-Z lower-cased; words of
    different rows are in different pieces."""
    raw, ends = bytes_of(column)
    if not len(raw):
        return pa.array([], pa.binary()), np.empty(0, np.int64), np.empty(0, np.int64)
    kind = _KIND[raw]
    word = kind == _PLAIN
    edge = np.zeros(len(raw) + 1, bool)
    edge[ends] = True
    before = np.r_[False, word[:-1]] & ~edge[:-1]
    after = np.r_[word[1:], False] & ~edge[1:]
    start, stop = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    piece = np.cumsum(kind == _CUT)
    row = np.searchsorted(ends, start, side="right") - 1
    offsets = np.r_[0, np.cumsum(stop - start)].astype(np.int32)
    flat = _LOWER[raw[word]]
    words = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))])
    return words, row, piece[start] + row                     # a row's end is a cut as well


def _numbered(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(number of each word, the distinct words)."""
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _langs(part: pa.RecordBatch) -> tuple[np.ndarray, pa.Array]:
    coded = part.column("lang").dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, w, n): all word occurrences of docs (lang, t)."""
    def run(batches):
        for batch in batches:
            for part in row_slices(batch, "t", BATCH):
                words, row, _ = piece_words(part.column("t"))
                ids, types = _numbered(words)
                lang, names = _langs(part)
                pairs, n = np.unique(lang[row] * max(1, len(types)) + ids, return_counts=True)
                yield pa.RecordBatch.from_arrays([names.take(pa.array(pairs // max(1, len(types)))), types.take(pa.array(pairs % max(1, len(types)))),
                                                  pa.array(n, pa.int64())], ["lang", "w", "n"])

    return docs.mapInArrow(run, "lang string, w binary, n long").groupBy("lang", "w").agg(F.sum("n").alias("n"))


def pack_prefixes(heavy: list[tuple[str, bytes, int]], budget: int) -> tuple[dict[tuple[str, bytes], tuple[int, int]], int]:
    """({(lang, word): (first group, groups)}, groups in all).  Words go by falling count into the group
    with the most room, or a new one.  A word above the budget has groups of its own, as many as its count fills."""
    plan, room, used = {}, [], 0                    # room: heap of (-suffixes that still fit, group)
    for lang, w, n in sorted(heavy, key=lambda x: (-x[2], x[0], x[1])):
        parts = 1
        if n > budget:
            at, parts = used, -(-n // budget)
            used += parts
        elif room and -room[0][0] >= n:
            left, at = room[0]
            heapq.heapreplace(room, (left + n, at))
        else:
            at, used = used, used + 1
            heapq.heappush(room, (n - budget, at))
        plan[lang, w] = (at, parts)
    return plan, used


def count_pairs(docs: DataFrame, split) -> DataFrame:
    """(lang, w, w2, n): occurrences of each word pair whose first word is in the broadcast set ``split``."""
    def run(batches):
        for batch in batches:
            for part in row_slices(batch, "t", BATCH):
                words, row, piece = piece_words(part.column("t"))
                ids, types = _numbered(words)
                lang, names = _langs(part)
                known = {x.as_py(): i for i, x in enumerate(names)}
                here = pc.index_in(pa.array([w for l, w in split.value if l in known], pa.binary()), types)
                of = np.array([known[l] for l, _ in split.value if l in known], np.int64)
                at = here.to_numpy(zero_copy_only=False)
                wanted = of[~np.isnan(at.astype(float))] * max(1, len(types)) + at[~np.isnan(at.astype(float))].astype(np.int64)
                first = np.flatnonzero((piece[1:] == piece[:-1]) & np.isin(lang[row[:-1]] * max(1, len(types)) + ids[:-1], wanted)) if len(ids) else np.empty(0, np.int64)
                order = first[np.lexsort((ids[first + 1], ids[first], lang[row[first]]))]
                cols = lang[row[order]], ids[order], ids[order + 1]
                at = _runs(*cols)
                yield pa.RecordBatch.from_arrays([names.take(pa.array(cols[0][at])), types.take(pa.array(cols[1][at])), types.take(pa.array(cols[2][at])),
                                                  pa.array(np.diff(np.r_[at, len(order)]), pa.int64())], ["lang", "w", "w2", "n"])

    return docs.mapInArrow(run, "lang string, w binary, w2 binary, n long").groupBy("lang", "w", "w2").agg(F.sum("n").alias("n"))


def _runs(*cols: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins, in sorted columns."""
    new = np.zeros(len(cols[0]), bool)
    if len(new):
        new[0] = True
    for c in cols:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _joined(words: pa.Array, tails: list[pa.Array]) -> pa.Array:
    return pc.binary_join_element_wise(words, *tails, pa.scalar(b" ", pa.binary()), null_handling="skip") if tails else words


def send_suffixes(docs: DataFrame, plan, heavy_groups: int, light_groups: int, max_words: int) -> DataFrame:
    """(g, lang, w, tails, n): for a batch's prefixes the distinct rests of their suffixes, cut after ``max_words``
    words in all, one a line, and their counts.  ``plan`` is a broadcast of the groups of frequent prefixes and
    of those of pairs above the budget."""
    def run(batches):
        import xxhash

        where, pairs = plan.value
        for batch in batches:
            for part in row_slices(batch, "t", BATCH):
                words, row, piece = piece_words(part.column("t"))
                if not len(words):
                    continue
                ids, types = _numbered(words)
                lang, names = _langs(part)
                cols = [lang[row], ids]
                for j in range(1, max_words):                   # the word j places on, -1 beyond the piece
                    nxt = np.full(len(ids), -1)
                    nxt[:len(ids) - j] = np.where(piece[j:] == piece[:len(ids) - j], ids[j:], -1)
                    cols.append(nxt)
                order = np.lexsort(cols[::-1])
                cols = [c[order] for c in cols]
                at = _runs(*cols)
                n = np.diff(np.r_[at, len(order)]).astype("<u4")
                cols = [c[at] for c in cols]
                first = _runs(*cols[:2])
                # the group of each prefix; a split one deals its suffixes by the next word, or all of them
                keys, spans = [], []
                byte = types.to_pylist() if len(first) > len(types) // 2 else None
                for l, w in zip(names.take(pa.array(cols[0][first])).to_pylist(), cols[1][first].tolist()):
                    raw = byte[w] if byte else types[w].as_py()
                    keys.append((l, raw))
                    spans.append(where.get((l, raw)))
                digest = np.array([0 if s else xxhash.xxh3_64_intdigest(raw, len(l)) for (l, raw), s in zip(keys, spans)], np.uint64)
                start = np.array([s[0] if s else heavy_groups + int(d) % light_groups for s, d in zip(spans, digest.tolist())], np.int64)
                count = np.array([s[1] if s else 1 for s in spans], np.int64)
                size = np.diff(np.r_[first, len(at)])
                g = np.repeat(start, size)
                split = np.repeat(count, size)
                tails = [types.take(pa.array(c, mask=c < 0)) for c in cols[2:]]
                tail = _joined(pc.fill_null(tails[0], b""), tails[1:])      # where the first has ended, so have the others
                if (split > 1).any():
                    at = _runs(*cols[:3])
                    ends = np.r_[at, len(g)]
                    of = np.searchsorted(first, at, side="right") - 1
                    for i in np.flatnonzero(split[at] > 1).tolist():
                        x, y = ends[i], ends[i + 1]
                        second = types[int(cols[2][x])].as_py() if cols[2][x] >= 0 else b""
                        hot = pairs.get((*keys[of[i]], second))
                        if hot:
                            g[x:y] = hot[0] + np.array([xxhash.xxh3_64_intdigest(t) % hot[1] for t in tail[x:y].to_pylist()], np.int64)
                        else:
                            g[x:y] += xxhash.xxh3_64_intdigest(second) % int(split[x])
                    back = np.lexsort((np.arange(len(g)), g, cols[1], cols[0]))
                    g, n, tail, cols = g[back], n[back], tail.take(pa.array(back)), [c[back] for c in cols]
                at = _runs(cols[0], cols[1], g)
                ends = np.r_[at, len(g)]
                lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), tail.cast(pa.large_binary()))
                lines = pc.binary_join(lists, pa.scalar(b"\n", pa.large_binary())).cast(pa.binary())
                raw, offsets = n.tobytes(), (4 * ends).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(g[at]), names.take(pa.array(cols[0][at])), types.take(pa.array(cols[1][at])), lines,
                    pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])],
                    ["g", "lang", "w", "tails", "n"])

    return docs.mapInArrow(run, "g long, lang string, w binary, tails binary, n binary")


def _lines(col: pa.Array) -> pa.Array:
    """All lines of the rows end to end; a row without text holds one empty line."""
    raw, ends = bytes_of(col)
    # a line break after every row makes each line end with one
    size = np.diff(ends)
    whole = np.full(len(raw) + len(size), 10, np.uint8)
    if len(raw):
        whole[np.arange(len(raw)) + np.repeat(np.arange(len(size)), size)] = raw
    stop = np.flatnonzero(whole == 10)
    offsets = np.r_[0, stop - np.arange(len(stop))].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(stop), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(whole[whole != 10]))])


def subtrees(part: pa.Table, max_words: int) -> tuple[pa.Array, pa.Array, pa.Array, list[np.ndarray], np.ndarray]:
    """The subtrees of a group: (langs, prefix words, other words, columns of the sorted distinct suffixes, leaf
    counts).  The columns number the lang, the prefix and each word after it, -1 where the suffix has ended."""
    one = lambda c: pa.concat_arrays(part.column(c).chunks)
    lang, langs = _numbered(one("lang"))
    first, words = _numbered(one("w"))
    tails = _lines(one("tails"))
    n = np.frombuffer(b"".join(part.column("n").to_pylist()), "<u4").astype(np.int64)
    per = pc.binary_length(one("n")).to_numpy(zero_copy_only=False) // 4
    tail, distinct = _numbered(tails)
    split = pc.split_pattern(distinct, b" ")
    flat, dictionary = _numbered(split.flatten())
    size = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    size[pc.binary_length(distinct).to_numpy(zero_copy_only=False) == 0] = 0
    begin = split.offsets.to_numpy(zero_copy_only=False).astype(np.int64)[:-1]
    cols = [np.repeat(lang, per), np.repeat(first, per)]
    for j in range(max_words - 1):
        held = np.full(len(size), -1)
        held[size > j] = flat[begin[size > j] + j]
        cols.append(held[tail])
    order = np.lexsort(cols[::-1])
    cols = [c[order] for c in cols]
    at = _runs(*cols)
    return langs, words, dictionary, [c[at] for c in cols], np.add.reduceat(n[order], at)


def count_phrases(sent: DataFrame, plan, least: int, max_words: int) -> DataFrame:
    """(lang, phrase, k, f, whole): the nodes of ``k`` = 2 to ``max_words`` words of each group's subtrees with their
    counts: those of a pair above the budget are all there and not ``whole``, the others if they reach ``least``."""
    def build(part: pa.Table) -> pa.Table:
        langs, words, dictionary, cols, n = subtrees(part, max_words)
        pairs, out = plan.value[1], []
        whole = np.ones(len(n), bool)
        if pairs:
            names, texts, more = langs.to_pylist(), words.to_pylist(), dictionary.to_pylist()
            at = _runs(*cols[:3])
            split = [(names[a], texts[b], more[c] if c >= 0 else b"") in pairs for a, b, c in zip(*(col[at].tolist() for col in cols[:3]))]
            whole = np.repeat(~np.array(split, bool), np.diff(np.r_[at, len(n)]))
        for k in range(2, max_words + 1):
            at = _runs(*cols[:k + 1])
            if not len(at):
                continue
            f = np.add.reduceat(n, at)
            # a node of all its words is in one group even if its pair is not
            done = whole[at] | (k == max_words)
            keep = (cols[k][at] >= 0) & ((f >= least) | ~done)
            done = done[keep]
            at, f = at[keep], f[keep]
            phrase = _joined(words.take(pa.array(cols[1][at])), [dictionary.take(pa.array(c[at])) for c in cols[2:k + 1]])
            out.append(pa.table({"lang": langs.take(pa.array(cols[0][at])), "phrase": phrase, "k": pa.array(np.full(len(at), k, np.int32)),
                                 "f": pa.array(f), "whole": pa.array(done)}))
        empty = pa.table({c: pa.array([], t) for c, t in (("lang", pa.string()), ("phrase", pa.binary()), ("k", pa.int32()),
                                                          ("f", pa.int64()), ("whole", pa.bool_()))})
        return pa.concat_tables(out) if out else empty

    return sent.groupBy("g").applyInArrow(build, "lang string, phrase binary, k int, f long, whole boolean")


def _score(a: Column, l: Column, r: Column) -> Column:
    """floor(1000000 a a / (l r)) in whole decimal numbers (counts below 10**14)."""
    wide = lambda c: c.cast("decimal(14,0)")
    return F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * wide(a) * wide(a), wide(l) * wide(r))


def collocations(docs: DataFrame, max_words: int = 3, least: int = 10, contained_percent: int = 50, top: int = 2000,
                 budget: int = 1_000_000, heavy_words: int = 1 << 17, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each lang's first ``top`` phrases of 2 to ``max_words`` words.

    Texts are cut at ``.,;:!?`` and line breaks, A-Z lower-cased.  a is the phrase's count (``least`` or more), n
    the lang's word count; the cut of the phrase with the least floor(1000000 a a / (l r)) gives l, r
    and score (ties: the earliest cut).  A phrase whose words lie in a longer candidate with ``contained_percent`` of its count
    goes.  Null langs are ``und``; null, empty and wordless texts count nothing; repeated rows count each time;
    an empty table gives no rows.  Other columns are not read.

    ``budget`` is the number of suffixes in a group, about, before equal ones are merged; ``heavy_words``
    bounds the table of frequent prefixes that every worker holds."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("t"))
    words = stage(count_words(rows), "phrases-words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    total = words.agg(F.sum("n")).first()[0] or 0
    # no more than heavy_words words have a count of total / heavy_words
    cut = max(budget // 16, -(-total // heavy_words), 1)
    heavy = [(r.lang, bytes(r.w), r.n) for r in words.where(F.col("n") >= cut).collect()]
    table_, used = pack_prefixes(heavy, budget)
    over, pairs = {x for x, (_, parts) in table_.items() if parts > 1}, {}
    if over and max_words > 2:
        known = spark.sparkContext.broadcast(over)
        hot = count_pairs(rows, known).where(F.col("n") > max(budget, total // heavy_words)).collect()
        for r in sorted(hot, key=lambda r: (r.lang, bytes(r.w), bytes(r.w2))):
            pairs[r.lang, bytes(r.w), bytes(r.w2)] = (used, -(-r.n // budget))
            used += -(-r.n // budget)
    plan = spark.sparkContext.broadcast((table_, pairs))
    light = max(1, -(-(total - sum(n for *_, n in heavy)) // budget))
    # as many tasks as groups, so that a task's share stays as the corpus grows
    sent = send_suffixes(rows, plan, used, light, max_words).repartition(used + light, "g")
    nodes = count_phrases(sent, plan, least, max_words)
    nodes = stage(nodes, "phrases-nodes")
    split = nodes.where("not whole").groupBy("lang", "phrase", "k").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    found = nodes.where("whole").select("lang", "phrase", "k", "f").union(split)
    found = stage(found.select("lang", F.col("phrase").cast("string").alias("phrase"), "k", "f"), "phrases-found")

    parts = found.select("lang", "phrase", "f").union(
        words.where(F.col("n") >= least).select("lang", F.col("w").cast("string"), F.col("n")))
    parts = stage(parts, "phrases-counts")
    # every cut of every candidate with the counts of its two sides
    at = F.split("phrase", " ")
    cuts = found.select("lang", "phrase", F.col("f").alias("a"), at.alias("w"), "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("head"),
                       F.array_join(F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("tail"))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    scored = cuts.select("lang", "phrase", "a", F.struct(_score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "cut", "l", "r").alias("s"))
    scored = scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min("s").alias("s"))
    # the largest count of a longer candidate around each phrase
    inner = found.where("k > 2").select("lang", "f", at.alias("w"), "k", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("m"))
    inner = inner.select("lang", "f", "w", "m", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("m") + 1)).alias("from"))
    around = inner.groupBy("lang", F.array_join(F.slice("w", F.col("from"), F.col("m")), " ").alias("phrase")).agg(F.max("f").alias("longer"))
    kept = scored.join(around, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * contained_percent))
    kept = kept.select("lang", "phrase", "a", "s.l", "s.r", "s.score")
    # the first of each share, then the first of these
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(64))
    near = kept.withColumn("share", share).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(
        F.col("rank") <= top).drop("share", "rank")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
