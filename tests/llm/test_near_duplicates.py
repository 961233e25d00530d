"""MinHash and embedding near-duplicates against all pairs in plain Python."""

import re

import numpy as np
import pandas as pd
import pytest

from llm_fixtures import MESSY, SF, corpus, messy  # noqa: F401
from venuescope.llm import embedding_dedup, minhash, words
from venuescope.llm.components import components
from venuescope.llm.queries import QUERIES

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def union_find(ids, pairs):
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {i: root(i) for i in ids}


def plain(docs):
    sets = {d: shingles(t) for d, t in docs}
    where = {}
    for d, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(d)
    pairs = {(a, b) for ds in where.values() for i, a in enumerate(ds) for b in ds[i + 1:]}
    linked = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    comp = union_find(sets, linked)
    return {d: (len(sets[d]), comp[d], comp[d] == d) for d in sets}


def as_dict(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_minhash_query(spark, corpus):
    got, want = as_dict(QUERIES["op1_minhash"](spark, SF)), plain(list(corpus.itertuples(index=False)))
    assert got == want and sum(not k for _, _, k in want.values()) > 5


def test_minhash_groups_near_the_threshold(spark, monkeypatch):
    """Families whose members differ in a few words: links on both sides of 0.75, several rounds."""
    rng = np.random.default_rng(8)
    vocab = [f"w{i}" for i in range(3000)]
    docs, n = [], 0
    for family in range(6):
        base = rng.choice(vocab, 120).tolist()
        for _ in range(25):
            own = list(base)
            for at in rng.integers(0, 120, int(rng.integers(0, 9))):
                own[at] = str(rng.choice(vocab))
            docs.append((n, " ".join(own)))
            n += 1
    monkeypatch.setattr(minhash, "BLOCK", 8)
    got = as_dict(minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == plain(docs) and len({c for _, c, _ in got.values()}) > 6


def test_minhash_messy(spark, messy):
    out = minhash.near_duplicates(messy)
    rows = sorted(map(tuple, out.collect()), key=repr)
    want = []
    for d, t, *_ in MESSY:
        want.append((d, len(shingles(t)), d, d is not None))
    assert rows == sorted(want, key=repr) and out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert minhash.near_duplicates(messy.limit(0)).count() == 0


def test_word_hashes_follow_the_words():
    import pyarrow as pa

    texts = ["Ab  cD\tab", None, "", " x", "x\x0bAB é\xa0É\n", "ab" * 3000, "cd"]
    h, ends = words.word_hashes(*words.bytes_of(pa.array(texts).slice(0)))
    want = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)) for t in texts]
    assert np.diff(ends).tolist() == [len(w) for w in want]
    flat = [x for w in want for x in w]
    by = {}
    for x, y in zip(flat, h.tolist()):
        assert by.setdefault(x, y) == y
    assert len(set(by.values())) == len(by)
    again, _ = words.word_hashes(*words.bytes_of(pa.array(texts).slice(4)))
    assert again.tolist() == h[ends[4]:].tolist()


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(4)
    for share in (0.3, 0.6, 0.75, 0.9):
        x = rng.integers(0, 2**63, 2000).astype(np.uint64)
        k = int(2000 * 2 * share / (1 + share))
        y = np.r_[x[:k], rng.integers(0, 2**63, 2000 - k).astype(np.uint64)]
        sig = minhash.signatures(np.r_[x, y], np.array([0, 2000]))
        assert abs((sig[0] == sig[1]).mean() - share) < 0.15


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    real = [p for p in pairs if p[0] != p[1]]
    assert got == union_find({x for p in real for x in p}, real)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_vectors(rows, threshold=0.93):
    ok = {}
    for i, (d, v, label) in enumerate(rows):
        if d is None or label is None or v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v) or not np.any(v):
            continue
        ok[i] = np.array(v, np.float64)
    pairs = [(i, j) for i in ok for j in ok if i < j and rows[i][2] == rows[j][2] and len(ok[i]) == len(ok[j])
             and ok[i] @ ok[j] / np.sqrt((ok[i] @ ok[i]) * (ok[j] @ ok[j])) >= threshold]
    comp = union_find({r[0] for r in rows if r[0] is not None}, [(rows[i][0], rows[j][0]) for i, j in pairs])
    out = []
    for i, (d, *_) in enumerate(rows):
        c = comp.get(d)
        out.append((d, sum(i in p for p in pairs), c, d is not None and c == d))
    return sorted(out, key=repr)


def test_embedding_query(spark):
    e = pd.read_parquet(f"{SF}/embeddings.parquet")
    rows = [(int(d), v, int(label)) for d, v, label in e[["vec_id", "embedding", "label"]].itertuples(index=False)]
    got = sorted(map(tuple, QUERIES["op10_embedding_dedup"](spark, SF).collect()), key=repr)
    want = plain_vectors(rows)
    assert got == want


@pytest.mark.parametrize("block", [2048, 7])
def test_embedding_groups(spark, monkeypatch, block):
    rng = np.random.default_rng(9)
    rows = []
    for g in range(8):
        base = rng.standard_normal(16)
        for _ in range(40):
            rows.append((len(rows), (base + rng.standard_normal(16) * rng.choice([0, 0.15, 0.3, 0.5])).astype(np.float32).tolist(), g % 3))
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [1.0] * 8, [2.0] * 8]
    rows += [(1000 + i, v, 0) for i, v in enumerate(odd)] + [(2000, rows[0][1], None), (None, rows[0][1], 0), (2001, rows[0][1], 0)]
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as rep", "2 as n", "3 as id")
    got = sorted(map(tuple, embedding_dedup.near_duplicates(df).collect()), key=repr)
    assert got == plain_vectors(rows)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embedding_repeated_ids(spark):
    """Rows of one id with different vectors, in one label and in two, are vectors of their own."""
    a, b, c = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0], [0.0, 0.0, 1.0, 0.0]
    near = lambda v: [x + 0.05 for x in v]
    rows = [(1, a, 0), (1, b, 0), (1, c, 1), (2, near(a), 0), (3, near(b), 0), (4, near(c), 1), (5, near(c), 1)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got.collect()) == [
        (1, 1, 1), (1, 1, 1), (1, 2, 1), (2, 1, 1), (3, 1, 1), (4, 2, 1), (5, 2, 1)]


def test_words_that_a_polynomial_hash_confuses(spark):
    """Two Thue-Morse words differ, and so do their hashes."""
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    got = as_dict(minhash.near_duplicates(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")))
    assert got == {1: (1, 1, True), 2: (1, 2, True)}


def test_repeated_ids_lose_no_text(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(1, a, 0), (1, b, 0), (2, b, 0), (1, a, 1), (3, b.upper(), 0), (3, b.upper() + " x", 0), (4, None, 0), (4, "", 0), (None, a, 0), (None, a, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, m int")
    kept = sorted(((r.doc_id, r.text) for r in minhash.drop_near_duplicates(docs).collect()), key=str)
    assert kept == sorted([(1, a), (1, b), (4, None), (4, ""), (None, a), (None, a)], key=str)
    got = {(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    assert got == {(1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (None, None, False)}


def test_open_band_without_its_main_cluster(spark, monkeypatch):
    """Members of the largest cluster meet the others only, so rows moved stay below a copy for every block."""
    monkeypatch.setattr(minhash, "BLOCK", 100)
    rows = [(7, i, 0 if i < 2000 else i, bytes([i % 251] * minhash.COORDINATES)) for i in range(2050)]
    members = spark.createDataFrame(rows, "band long, d long, cluster long, sig binary")
    moved = minhash.in_blocks(members, "band", "cluster")
    assert moved.where("cluster = 0").count() == 2000          # 20 blocks, one other block to meet
    assert moved.where("cluster <> 0").count() == 50 * 21
    edges = minhash.across_clusters(members, minhash.COORDINATES, 3).collect()
    tied = union_find(range(2050), [(r.a, r.b) for r in edges])
    assert all(tied[i] == tied[i % 251] for i in range(2000, 2050))


def test_two_permutations_are_different():
    x = np.arange(1 << 16, dtype=np.uint32)
    assert len(np.unique(minhash._permute(x))) == len(np.unique(minhash._scatter(x))) == 1 << 16
    assert (minhash._permute(x) == minhash._scatter(x)).sum() < 5


def test_doubles_and_text_labels(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((6, 8))
    rows = [(i, [float(x) for x in base[i % 6] + 0.01 * rng.standard_normal(8)], "xy"[i % 2]) for i in range(40)]
    rows += [(90, [1e200] * 8, "x"), (91, None, "x"), (92, [1.0] * 8, None)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(
        spark.createDataFrame(rows[:40] + rows[41:], "vec_id long, embedding array<double>, label string")).collect()}
    for i, v, label in rows[:40]:
        near = [j for j, w, other in rows[:40] if j != i and other == label
                and np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= 0.93]
        assert got[i] == (len(near), min([i, *near]))
    assert got[91] == (0, 91) and got[92] == (0, 92)


def test_pairs_of_long_texts_reach_a_task_in_small_batches(spark, monkeypatch):
    """1,000 pairs of texts of 40 kB: no batch of them, copied for every core, holds more than a few MB."""
    import pyarrow as pa

    from venuescope.llm import common

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    texts = spark.range(0, 1000, 1, 1).selectExpr("id d", "repeat(cast(id % 7 as string), 40000) t")
    pairs = texts.join(texts.withColumnRenamed("t", "u"), "d").coalesce(1)
    sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "b"]) for b in batches)
    got = common.stage(pairs.mapInArrow(sizes, "n long, b long"), "sizes").collect()
    assert sum(r.n for r in got) == 1000 and max(r.b for r in got) < 2 * common.BATCH_BYTES
    assert spark.conf.get(key, None) == before
    # a size that the session names stays
    monkeypatch.setattr(common, "BATCH_BYTES", 1)
    try:
        spark.conf.set(key, str(1 << 24))
        assert common.stage(pairs.mapInArrow(sizes, "n long, b long"), "sizes").agg({"b": "max"}).first()[0] > 1 << 23
        assert spark.conf.get(key) == str(1 << 24)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
