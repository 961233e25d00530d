"""Spelling variants by a variable-length gram index.

A gram dictionary is built from the distinct words: a gram is extended by one more letter while it is
frequent, so it is short where letters are rare and long where they are common.  At each place of a word
stands exactly one gram, the shortest that is not frequent (or what is left of the word, or as much as
``gram_limit`` allows); it depends on the letters it covers alone, so an edit elsewhere leaves it as it is.

An index holds every gram of every word with its place and the word's length.  A word asks for few of
its own: the rarest ones of which no single edit affects all (the bound of affected grams is below
their number, so each near word shares one at least).  The lists of these grams are merged and
each word found is verified letter by letter.  Long lists are split into blocks, and
only verified pairs leave a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, row_slices, stage
from .words import bytes_of

SHORTEST = 2
BATCH = 4 << 20                    # bytes of text whose words are counted before they are sent
PAIRS = 4 << 20                    # letters that a task compares at a time, about
BLOCK = 4096                       # words of a list in one block
BUCKET = 100_000                   # index entries and questions of a task's group, about

_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> np.uint32(1)) ^ np.uint32(0xEDB88320), _CRC >> np.uint32(1)).astype(np.uint32)
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def letter_runs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased letters of all runs end to end as Latin-1 bytes, length of each run, its row).

    Letters are A-Z, a-z and U+00C0 to U+00FF, which UTF-8 writes as C3 80 to C3 BF."""
    raw, ends = bytes_of(column)
    if not len(raw):
        return np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64)
    lead = raw == 0xC3
    high = np.r_[False, lead[:-1]]
    letter = _LETTER[raw] | lead | high
    edge = np.zeros(len(raw) + 1, bool)
    edge[ends] = True
    start = np.flatnonzero(letter & (~np.r_[False, letter[:-1]] | edge[:-1]))
    keep = letter & ~lead                                    # one byte a letter: the lead byte goes
    flat = np.where(high, raw | 0x40, _LOWER[raw])[keep]     # C3 80 + x is U+00C0 + x
    run = np.cumsum(np.isin(np.arange(len(raw)), start, assume_unique=True))[keep] - 1 if len(start) else np.empty(0, np.int64)
    return flat.astype(np.uint8), np.bincount(run, minlength=len(start)), np.searchsorted(ends, start, side="right") - 1


def _crc_on(state: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return _CRC[(state ^ byte) & np.uint32(0xFF)] ^ (state >> np.uint32(8))


def run_crcs(prefix: np.ndarray, row: np.ndarray, flat: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of each row's prefix (its crc32 so far) followed by the UTF-8 of the run."""
    state = prefix[row] ^ np.uint32(0xFFFFFFFF)
    begin = np.cumsum(size) - size
    order = np.argsort(-size, kind="stable")
    left = np.searchsorted(-size[order], -np.arange(size.max(initial=0)), side="left")   # runs longer than j
    for j, m in enumerate(left.tolist()):
        at = order[:m]
        c = flat[begin[at] + j]
        wide = c >= 0xC0
        now = state[at]
        now = np.where(wide, _crc_on(now, np.uint32(0xC3)), now)
        state[at] = _crc_on(now, np.where(wide, c & 0xBF, c).astype(np.uint32))
    return state ^ np.uint32(0xFFFFFFFF)


def count_words(docs: DataFrame, modulus: int, least_length: int) -> DataFrame:
    """(w, n): the words of docs (d, t) with their counts; w holds one Latin-1 byte a letter."""
    def run(batches):
        import zlib

        for batch in batches:
            for part in row_slices(batch, "t", BATCH):
                flat, size, row = letter_runs(part.column("t"))
                prefix = np.array([zlib.crc32(f"{'' if d is None else d}:".encode()) for d in part.column("d").to_pylist()], np.uint32)
                h = run_crcs(prefix, row, flat, size).astype(np.int64) if len(size) else np.empty(0, np.int64)
                hit = np.flatnonzero(h % modulus == 0)
                begin = np.cumsum(size) - size
                keep = np.ones(len(flat), bool)
                keep[begin[hit] + h[hit] % size[hit]] = False
                size = size.copy()
                size[hit] -= 1
                flat = flat[keep]
                keep = np.repeat(size >= least_length, size)
                size, flat = size[size >= least_length], np.ascontiguousarray(flat[keep])
                offsets = np.r_[0, np.cumsum(size)].astype(np.int32)
                words = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(flat)]).value_counts()
                yield pa.RecordBatch.from_arrays([words.field(0), words.field(1).cast(pa.int64())], ["w", "n"])

    return docs.mapInArrow(run, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n"))


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(padded letters, one row a word between 1 and 2; padding is 0, lengths with both marks)."""
    raw, ends = bytes_of(column)
    size = np.diff(ends)
    out = np.zeros((len(size), int(size.max(initial=0)) + 2), np.uint8)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(raw)) - np.repeat(ends[:-1], size) + 1] = raw
    out[:, 0] = 1
    out[np.arange(len(size)), size + 1] = 2
    return out, size + 2


def _by_length(part: pa.RecordBatch, limit: int = 1 << 20):
    """Slices of a batch of words of like length, with about ``limit`` letters of padded matrix each."""
    size = np.diff(bytes_of(part.column("w"))[1])
    order = np.argsort(size, kind="stable")
    begin = 0
    while begin < len(order):
        end = begin + 1
        step = max(1, limit // int(size[order[begin]] + 2))
        end = min(len(order), begin + step)
        while end > begin + 1 and size[order[end - 1]] > 2 * size[order[begin]] + 8:
            end = begin + int(np.searchsorted(size[order[begin:end]], 2 * size[order[begin]] + 8, side="right"))
        yield part.take(pa.array(order[begin:end]))
        begin = end


def _gram_hashes(m: np.ndarray, longest: int):
    """For q = 1, 2, ..: the hash of the q letters from each place on (of fewer, beyond the word's end)."""
    h = np.zeros(m.shape, np.uint64)
    for q in range(1, longest + 1):
        letter = np.zeros(m.shape, np.uint64)
        letter[:, :m.shape[1] - q + 1] = m[:, q - 1:]
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + letter + np.uint64(q))
        yield q, h


def frequent_grams(words: DataFrame, longest: int, share: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, counts) of the grams of ``SHORTEST`` to ``longest`` - 1 letters that stand at
    more than 1 / ``share`` of all places: at most ``share`` of each length, wherever counted."""
    def run(batches):
        for batch in batches:
            for part in _by_length(batch):
                m, size = _matrix(part.column("w"))
                for q, h in _gram_hashes(m, longest - 1):
                    if q >= SHORTEST:
                        g, n = np.unique(h[np.arange(m.shape[1]) + q <= size[:, None]], return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), q, np.int32)), pa.array(g.astype(np.int64)), pa.array(n, pa.int64())],
                                                         ["q", "g", "n"])

    places = words.agg(F.sum(F.octet_length("w") + 1)).first()[0] or 0
    counts = words.select("w").mapInArrow(run, "q int, g long, n long").groupBy("q", "g").agg(F.sum("n").alias("n"))
    found = counts.where(F.col("n") > places // share).select("g", "n").collect()
    g, n = np.array([r.g for r in found], np.int64).astype(np.uint64), np.array([r.n for r in found], np.int64)
    order = np.argsort(g)
    return g[order], n[order]


def gram_limit(size: np.ndarray, longest: int) -> np.ndarray:
    """The letters of the longest gram that a word of ``size`` letters (with its marks) asks for: at most half
    of it, so that two grams without a common letter exist."""
    return np.clip(size // 2, SHORTEST, longest)


def variable_grams(m: np.ndarray, size: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], limit: np.ndarray):
    """(hash, letters, weight) of the gram at each place but the end mark, of at most ``limit`` letters; the weight
    is the count of a frequent gram that could not be extended, else 0."""
    known, count = frequent
    letters = np.zeros(m.shape, np.int64)
    out = np.zeros(m.shape, np.uint64)
    weight = np.zeros(m.shape, np.int64)
    going = np.arange(m.shape[1]) < size[:, None] - 1
    for q, h in _gram_hashes(m, int(limit.max(initial=0))):
        if q < SHORTEST:
            continue
        at = np.minimum(np.searchsorted(known, h), max(0, len(known) - 1))
        often = (known[at] == h) if len(known) else np.zeros(m.shape, bool)
        last = (np.arange(m.shape[1]) + q >= size[:, None]) | (q >= limit[:, None])
        stop = going & (~often | last)
        out[stop], letters[stop] = h[stop], q
        if len(known):
            weight[stop & often] = count[at][stop & often]
        going &= ~stop
    return out, letters, weight


def chosen_grams(size: np.ndarray, letters: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The places whose grams a word asks for: by rising weight until no single edit affects all of them.

    An edit affects the grams that cover its place, and an inserted letter those that cover both its sides, so
    the bound for a set is its size unless some two of its grams share no letter."""
    n, width = letters.shape
    place = np.arange(width)
    order = np.argsort(np.where(place < size[:, None] - 1, weight * width + place, np.iinfo(np.int64).max), axis=1, kind="stable")
    picked = np.zeros((n, width), bool)
    low_end = np.full(n, np.iinfo(np.int64).max)             # a letter common to all of a set of intervals exists
    high_begin = np.full(n, -1)                              # while the last begin lies before the first end
    open_ = np.ones(n, bool)
    for j in range(width):
        rows = np.flatnonzero(open_ & (j < size - 1))
        if not len(rows):
            break
        p = order[rows, j]
        picked[rows, p] = True
        low_end[rows] = np.minimum(low_end[rows], p + letters[rows, p])
        high_begin[rows] = np.maximum(high_begin[rows], p)
        open_[rows] = high_begin[rows] < low_end[rows]
    return picked


def entries(words: DataFrame, grams, longest: int) -> DataFrame:
    """(key, ask, w, n): index entries of every place's gram and, with ``ask``, the questions of the chosen ones.

    A key is a gram with its place, the sought word's length and the asking word's limit of grams.  Questions seek
    words as long as the word, with the gram in its place, and words with one letter more, with the gram there or
    one place on; so a word is held under the limits of its own length and of one letter less."""
    def run(batches):
        for batch in batches:
            for part in _by_length(batch):
                m, size = _matrix(part.column("w"))
                limits = gram_limit(size, longest), gram_limit(size - 1, longest)
                keys, take = [], []

                def add(r, p, h, shift, more, limit):
                    keys.append(mix64(h[r, p] + (p + shift).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
                                      + (64 * (size[r] + more) + limit[r]).astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB)))
                    take.append(r)

                h, letters, weight = variable_grams(m, size, grams.value, limits[0])
                add(*np.nonzero(letters), h, 0, 0, limits[0])
                other = np.flatnonzero(limits[0] != limits[1])
                if len(other):
                    less, short, _ = variable_grams(m[other], size[other], grams.value, limits[1][other])
                    r, p = np.nonzero(short)
                    whole = np.zeros_like(h)
                    whole[other] = less
                    add(other[r], p, whole, 0, 0, limits[1])
                held = sum(map(len, keys))
                mine, at = np.nonzero(chosen_grams(size, letters, weight))
                for shift, more in ((0, 0), (0, 1), (1, 1)):
                    add(mine, at, h, shift, more, limits[0])
                key, row = np.concatenate(keys).astype(np.int64), np.concatenate(take)
                ask = np.arange(len(key)) >= held
                for a in range(0, len(key), 1 << 16):
                    b = slice(a, a + (1 << 16))
                    yield pa.RecordBatch.from_arrays([pa.array(key[b]), pa.array(ask[b]), part.column("w").take(pa.array(row[b])),
                                                      part.column("n").take(pa.array(row[b]))], ["key", "ask", "w", "n"])

    return words.select("w", "n").mapInArrow(run, "key long, ask boolean, w binary, n long")


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of letters differ by one replaced letter, or by one more letter in b."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    same = a == b[:, :-1]
    front = np.where(same.all(axis=1), a.shape[1], same.argmin(axis=1))
    same = (a == b[:, 1:])[:, ::-1]
    back = np.where(same.all(axis=1), a.shape[1], same.argmin(axis=1))
    return front + back >= a.shape[1]


def near_pairs(rows: DataFrame) -> DataFrame:
    """(a, na, b, nb): the distinct pairs of near words, each once, that meet at a key of ``entries``."""
    rows = stage(rows, "spelling-entries")
    sizes = rows.groupBy("key").agg(F.sum(F.col("ask").cast("long")).alias("asks"), F.sum((~F.col("ask")).cast("long")).alias("held"))
    sizes = sizes.where("asks > 0 and held > 0")
    total = rows.count()
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    both = rows.join(sizes.select("key", blocks("asks").alias("i"), blocks("held").alias("j")), "key")
    # a question's block meets every block of the list, and the other way round
    own = lambda c: F.pmod(F.xxhash64(F.lit(7), "w"), F.col(c)).cast("int")
    both = both.withColumn("own", F.when(F.col("ask"), own("i")).otherwise(own("j")))
    both = both.withColumn("with", F.explode(F.sequence(F.lit(0), F.when(F.col("ask"), F.col("j")).otherwise(F.col("i")) - 1)))
    meet = F.xxhash64("key", F.when(F.col("ask"), F.col("own")).otherwise(F.col("with")), F.when(F.col("ask"), F.col("with")).otherwise(F.col("own")))
    both = both.select(meet.alias("meet"), "ask", "w", "n").withColumn("bucket", F.pmod("meet", F.lit(max(1, -(-total // BUCKET)))))

    def compare(part: pa.Table) -> pa.Table:
        meet = part.column("meet").to_numpy()
        ask = part.column("ask").to_numpy(zero_copy_only=False)
        words = pa.concat_arrays(part.column("w").chunks)
        raw, ends = bytes_of(words)
        size = np.diff(ends)
        order = np.lexsort((size, ~ask, meet))
        cuts = np.flatnonzero(np.r_[True, meet[order][1:] != meet[order][:-1], True])
        hits, held, letters = [], [], 0

        def settle():
            nonlocal letters
            if held:
                x, y = (np.concatenate([h[k] for h in held]) for k in (0, 1))
                shape = size[x] * 2 + (size[y] > size[x])
                by = np.argsort(shape, kind="stable")
                for at in np.split(by, np.flatnonzero(np.diff(shape[by])) + 1):
                    n, more = size[x[at[0]]], size[y[at[0]]]
                    ok = one_edit(raw[ends[x[at]][:, None] + np.arange(n)], raw[ends[y[at]][:, None] + np.arange(more)])
                    hits.append(np.stack([x[at[ok]], y[at[ok]]]))
                held.clear()
                letters = 0

        for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
            at = order[a:b]
            m = int(ask[at].sum())
            if m == 0 or m == b - a:
                continue
            other = at[m:]
            width = int(size[other].max()) + 1
            for step in np.array_split(at[:m], max(1, -(-m * len(other) * width // PAIRS))):
                x, y = np.repeat(step, len(other)), np.tile(other, len(step))
                fit = (size[y] == size[x]) | (size[y] == size[x] + 1)
                held.append((x[fit], y[fit]))
                letters += len(x) * width
                if letters > PAIRS:
                    settle()
        settle()
        x, y = np.concatenate(hits, axis=1) if hits else np.empty((2, 0), np.int64)
        n = part.column("n").combine_chunks() if isinstance(part.column("n"), pa.Array) else pa.concat_arrays(part.column("n").chunks)
        return pa.table({"a": words.take(pa.array(x)), "na": n.take(pa.array(x)), "b": words.take(pa.array(y)), "nb": n.take(pa.array(y))})

    found = both.groupBy("bucket").applyInArrow(compare, "a binary, na long, b binary, nb long")
    swap = F.col("a") > F.col("b")
    pick = lambda x, y: F.when(swap, F.col(y)).otherwise(F.col(x))
    return found.select(pick("a", "b").alias("a"), pick("na", "nb").alias("na"), pick("b", "a").alias("b"), pick("nb", "na").alias("nb")).distinct()


def last_forms(forms: DataFrame) -> DataFrame:
    """(w, root) for forms (w, form): the word at the end of each chain.  Pointers double their reach in each
    round; counts at least double along a chain, so there are few rounds."""
    now = stage(forms.select("w", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = now.select(F.col("w").alias("root"), F.col("root").alias("next"))
        step = stage(now.join(on, "root", "left").select("w", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                     "spelling-roots")
        now = step.select("w", "root")
        if step.where("moved").limit(1).count() == 0:
            return now


def group_variants(docs: DataFrame, modulus: int = 97, least_length: int = 5, least: int = 3, ratio: int = 2, longest: int = 6,
                   share: int = 1 << 15, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word.

    Runs of A-Z, a-z and U+00C0 to U+00FF are lower-cased in A-Z; where ``modulus`` divides the crc32 of
    ``<doc_id>:<run>``, the run loses its letter crc32 % length (0: none are changed).  Words are results of at least
    ``least_length`` letters with n >= ``least`` occurrences.  Near words differ by one inserted, deleted or
    replaced letter; the form of a word is its near word of largest n (ties: the smallest), if that is at least
    ``ratio`` times the word's; the root is the last form reached.  Null, empty and letterless texts have no words, a null id
    counts as an empty one, repeated rows count each time, and an empty table gives no rows.  Other columns are not read.

    ``least_length`` is 2 at least.  ``longest`` bounds a gram's letters and ``share`` the gram table that every worker holds; results do not
    depend on them."""
    if least_length < 2:
        raise ValueError("words of one letter have no two grams apart")
    counted = count_words(docs.select(F.col(doc_id).cast("string").alias("d"), F.col(text).alias("t")), modulus, least_length)
    words = stage(counted.where(F.col("n") >= least), "spelling-words")
    grams = docs.sparkSession.sparkContext.broadcast(frequent_grams(words, longest, share))
    pairs = stage(near_pairs(entries(words, grams, longest)), "spelling-pairs")
    both = pairs.union(pairs.select("b", "nb", "a", "na"))
    # text order is code-point order, for Latin-1 bytes too
    best = both.groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("nb")).alias("m"), "b")).alias("top"), F.first("na").alias("n"))
    best = stage(best.select(F.col("a").alias("w"), "n_near", F.when(-F.col("top.m") >= ratio * F.col("n"), F.col("top.b")).alias("form"),
                             (-F.col("top.m")).alias("form_n")), "spelling-forms")
    roots = last_forms(best.where("form is not null"))
    out = words.join(best, "w", "left").join(roots, "w", "left")
    name = lambda c: F.decode(F.col(c), "ISO-8859-1")
    return out.select(name("w").alias("word"), name("form").alias("form"), F.decode(F.coalesce("root", "w"), "ISO-8859-1").alias("root"), "n",
                      F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("form").isNotNull(), F.col("form_n")).alias("form_n"))
