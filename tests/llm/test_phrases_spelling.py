import re
import zlib
from collections import Counter, defaultdict

import pytest

from venuescope.llm import phrases, spelling
from llm_fixtures import MESSY, SF, messy  # noqa: F401

A_Z = {i: i + 32 for i in range(65, 91)}


def plain_phrases(rows, max_words=3, least=10, percent=50, top=2000):
    """Counts by plain loops; rows are (lang, text)."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(A_Z)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(inside[p[i:i + k]], a)
        best = []
        for p, a in cand.items():
            if 100 * inside[p] >= percent * a and inside[p]:
                continue
            score, k = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("budget", [500, 1_000_000])
def test_phrases_equal_plain_counts(spark, budget):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = plain_phrases([(r.lang, r.text) for r in docs.collect()])
    assert len(plain) > 50
    assert got(phrases.collocations(docs, budget=budget)) == plain


def test_phrases_messy_ties_and_longer_candidates(spark, messy):  # noqa: F811
    rows = [(r[2], r[1]) for r in MESSY]
    assert got(phrases.collocations(messy, least=2, budget=50)) == plain_phrases(rows, least=2)
    text = "New York City, " * 12 + "new york; " * 5 + "éa b. " * 10 + "z b\ta b! " * 10
    docs = spark.createDataFrame([(text, None, "x", 1)], "text string, lang string, phrase string, n int")
    out = got(phrases.collocations(docs, max_words=4))
    assert out == plain_phrases([(None, text)], max_words=4)
    assert "new york" not in [r[2] for r in out] and "new york city" in [r[2] for r in out]
    assert phrases.collocations(docs.limit(0)).count() == 0


def test_phrases_hot_pair_is_split(spark):
    """One word pair fills a third of the corpus, each time with another word after it."""
    rows = [("en", f"hot pair w{i}. x{i % 7} y{i % 7} z") for i in range(3000)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert got(phrases.collocations(docs, budget=400)) == plain_phrases(rows)


def test_prefix_packing_fits_the_budget():
    heavy = [("en", str(i).encode(), n) for i, n in enumerate([250, 90, 60, 50, 40, 30, 10])]
    plan, used = phrases.pack_prefixes(heavy, 100)
    assert plan["en", b"0"] == (0, 3) and used >= 6
    room = Counter()
    for (_, w), (g, parts) in plan.items():
        room[g] += heavy[int(w)][2] // parts
    assert max(room.values()) <= 100


def test_subtree_nodes_are_totals_of_their_leaves():
    import numpy as np
    import pyarrow as pa

    part = pa.table({"lang": ["en", "en"], "w": pa.array([b"a", b"a"], pa.binary()), "tails": pa.array([b"b c\nb d\n", b"b c\nx"], pa.binary()),
                     "n": pa.array([np.array([2, 1, 4], "<u4").tobytes(), np.array([5, 1], "<u4").tobytes()], pa.binary())})
    _, words, other, cols, n = phrases.subtrees(part, 3)
    name = lambda x: other[int(x)].as_py().decode() if x >= 0 else ""
    assert {(name(a), name(b)): int(m) for a, b, m in zip(cols[2], cols[3], n)} == {("b", "c"): 7, ("b", "d"): 1, ("", ""): 4, ("x", ""): 1}
    assert words.to_pylist() == [b"a"]


RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_variants(rows, modulus=97, least_length=5, least=3, ratio=2):
    """All pairs of words by the patterns with one letter left out; rows are (doc_id, text)."""
    c = Counter()
    for d, text in rows:
        for run in RUN.findall(text or ""):
            w = run.translate(A_Z)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % modulus == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            c[w] += 1
    c = {w: n for w, n in c.items() if len(w) >= least_length and n >= least}
    holes, near = defaultdict(set), defaultdict(set)
    for w in c:
        for i in range(len(w)):
            holes[w[:i] + "*" + w[i + 1:]].add(w)
            if (s := w[:i] + w[i + 1:]) in c:
                near[w].add(s)
                near[s].add(w)
    for ws in holes.values():
        for w in ws:
            near[w] |= ws - {w}
    form = {}
    for w in c:
        best = min(near[w], key=lambda x: (-c[x], x), default=None)
        if best and c[best] >= ratio * c[w]:
            form[w] = best
    def root(w):
        return root(form[w]) if w in form else w
    return sorted((w, form.get(w), root(w), n, len(near[w]), c[form[w]] if w in form else None) for w, n in c.items())


def variants(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=lambda r: r[0])


@pytest.mark.parametrize("share", [20, 1 << 15])
def test_variants_equal_plain_search(spark, share):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = plain_variants([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(r[4] for r in plain) > 500 and any(r[1] for r in plain)
    assert variants(spelling.group_variants(docs, share=share)) == plain


def test_variants_chain_ties_and_messy_rows(spark, messy):  # noqa: F811
    words = ["color"] * 40 + ["colour"] * 12 + ["colours"] * 5 + ["abcde"] * 9 + ["abcdf"] * 9 + ["abcdg"] * 3 + ["École"] * 6 + ["école"] * 3 + \
        ["straße"] * 3 + ["a" * 3000] * 3 + ["a" * 3001] * 8 + ["AAAAA"] * 3 + ["aaaaaa"] * 4
    docs = spark.createDataFrame([(i, w + " 1", 0, 0) for i, w in enumerate(words)], "doc_id long, text string, n int, word int").union(
        messy.select("doc_id", "text", "d", "_row"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for modulus in (97, 3):
        assert variants(spelling.group_variants(docs, modulus=modulus, least=2)) == plain_variants(rows, modulus, least=2)
    assert spelling.group_variants(docs.limit(0)).count() == 0


def test_variants_in_one_crowded_list(spark, monkeypatch):
    """Thousands of words that differ in few letters meet in hot lists; lists are split into small blocks."""
    monkeypatch.setattr(spelling, "BLOCK", 50)
    import itertools
    words = ["xy" + "".join(p) + "zz" for p in itertools.product("abcd", repeat=5)]
    docs = spark.createDataFrame([(i, " ".join([w] * (3 + i % 5))) for i, w in enumerate(words)], "doc_id long, text string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert variants(spelling.group_variants(docs, share=10, longest=3)) == plain_variants(rows)


def test_run_crcs_and_letters():
    import numpy as np
    import pyarrow as pa

    texts = ["Straße × œuvre naïve÷ x", None, "", "Zÿ-" + "q" * 300]
    flat, size, row = spelling.letter_runs(pa.array(texts))
    ends = np.cumsum(size)
    runs = [flat[a:b].tobytes().decode("latin-1") for a, b in zip(ends - size, ends)]
    assert runs == [m.translate(A_Z) for t in texts for m in RUN.findall(t or "")] and row.tolist() == [0] * (len(runs) - 2) + [3, 3]
    prefix = np.array([zlib.crc32(f"{i}:".encode()) for i in range(4)], np.uint32)
    assert spelling.run_crcs(prefix, row, flat, size).tolist() == [zlib.crc32(f"{r}:{w}".encode()) for r, w in zip(row, runs)]
