"""Language id and language-model scores: held-out accuracy, exact base scores, filter behaviour."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from llm_fixtures import MESSY, corpus, messy  # noqa: F401
from venuescope.llm import language_id, lm_scoring
from venuescope.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))


def fold(d, n):
    return zlib.crc32(str(d).encode()) % n


def plain_base(docs, folds=10):
    seen = Counter()
    for d, t in docs:
        if d is not None and fold(d, folds):
            seen.update([*words(t), None])
    total, types = sum(seen.values()), len(seen)
    out = []
    for d, t in docs:
        c = [seen[x] for x in [*words(t), None]]
        out.append((d, d is None or fold(d, folds) == 0, len(c), sum(x > 0 for x in c), total,
                    sum(math.log10((x + 0.1) / (total + 0.1 * (types + 1))) for x in c)))
    return out


@pytest.mark.parametrize("head", [1 << 20, 300, 0])
def test_lm_base_is_exact(spark, head):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = lm_scoring.score_texts(df, head_words=head).collect()
    got = {r.doc_id: tuple(r)[:6] for r in rows}
    for want in plain_base(list(docs[["doc_id", "text"]].itertuples(index=False))):
        assert got[want[0]][:5] == want[:5]
        assert got[want[0]][5] == pytest.approx(want[5], rel=1e-9)
    assert all(r.score < 0 for r in rows)
    per = lambda c: sum(r[c] for r in rows if r.held_out) / sum(r.n_tokens for r in rows if r.held_out)
    assert per("score") > per("base_score") - 0.02


def test_lm_prefers_learned_order(spark):
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(60)]
    follow = {w: rng.choice(vocab, 3).tolist() for w in vocab}

    def walk(n):
        out = [str(rng.choice(vocab))]
        while len(out) < n:
            out.append(str(rng.choice(follow[out[-1]])))
        return out

    docs = [(i, " ".join(walk(80))) for i in range(600)]
    rows = {r.doc_id: r for r in lm_scoring.score_texts(spark.createDataFrame(docs, "doc_id long, text string"), prior=50.0).collect()}
    held = [r for r in rows.values() if r.held_out]
    assert len(held) > 20
    assert np.mean([r.score - r.base_score for r in held]) / 81 > 0.4         # log10 a token
    counts = Counter(x for i, t in docs if fold(i, 10) for x in t.split())
    assert len(counts) == 60


def test_filter_quantises_counts():
    rng = np.random.default_rng(5)
    h = rng.integers(0, 2**63, 20000).astype(np.uint64)
    n = np.maximum(1, (rng.pareto(0.8, 20000) * 3).astype(np.int64))
    times = np.searchsorted(lm_scoring.STEPS, n, side="right")
    blocks = -(-int(times.sum()) * 10 // lm_scoring.BLOCK_BITS)
    got = np.zeros(len(h))
    for shards in (1, 3):
        for shard in range(shards):
            mine = np.flatnonzero(lm_scoring.block_of(h, blocks) % shards == shard)
            raw = lm_scoring.LogFrequencyFilter.fill(h[mine], np.ones(len(mine), np.int64), n[mine], blocks, shards, shard)
            lm = lm_scoring.LogFrequencyFilter(raw, {1: 1, 2: 1}, blocks, shards)
            got[mine] = lm.counts(1, h[mine])
        want = lm_scoring.MIDDLE[times]
        assert (got >= want).all()                         # a filter never loses an entry
        assert (got == want).mean() > 0.97
    other = rng.integers(0, 2**63, 20000).astype(np.uint64)
    other = other[lm_scoring.block_of(other, blocks) % 3 == 2]
    assert (lm.counts(1, other) > 0).mean() < 0.05


def test_keys_of_a_shard_survive_packing():
    rng = np.random.default_rng(6)
    h = np.r_[rng.integers(0, 2**63, 5000).astype(np.uint64) * np.uint64(2), np.uint64(0), np.uint64(2**64 - 1), np.uint64(2**64 - 1)]
    for bits in (20, 44, 64):
        order, keys, sizes = lm_scoring.by_shard(h, bits, 50, 7)
        assert sizes.sum() == len(h) and (keys == (h >> np.uint64(64 - bits))[order]).all()
        raws = lm_scoring.pack_keys(keys, sizes, bits)
        assert (np.concatenate([lm_scoring.unpack_keys(r, m, bits) for r, m in zip(raws, sizes.tolist())]) == keys).all()
    assert lm_scoring.key_bits(0) == 18 and lm_scoring.key_bits(10**9) == 47 and lm_scoring.key_bits(2**60) == 64


def plain_scores(docs, prior=1000.0):
    """Scores from all counts, quantised as the filter does but without its false hits."""
    at = lambda c: lm_scoring.MIDDLE[np.searchsorted(lm_scoring.STEPS, c, side="right")] if c else 0.0
    uni, two = Counter(), Counter()
    for d, t in docs:
        if d is not None and fold(d, 10):
            row = [*words(t), None]
            uni.update(row)
            two.update(zip([None, *row], row))
    below = sum(uni.values()) + 0.1 * (len(uni) + 1)
    out = {}
    for d, t in docs:
        row = [*words(t), None]
        out[d] = sum(math.log10(min(1.0, (min(at(two[a, b]), at(uni[a])) + prior * (at(uni[b]) + 0.1) / below) / (at(uni[a]) + prior)))
                     for a, b in zip([None, *row], row))
    return out, two


def test_lm_model_does_not_depend_on_a_cap(spark, monkeypatch, corpus):
    """The filter holds every step whatever ``max_bits`` is; shards and chunks only place the work."""
    df = spark.createDataFrame(corpus)
    scores = lambda **kw: {r.doc_id: (r.n_tokens, r.score) for r in lm_scoring.score_texts(df, **kw).collect()}
    whole = scores()
    assert sum(n for n, _ in whole.values()) * 20 > 17 << 16           # so that the smaller bound makes more shards
    monkeypatch.setattr(lm_scoring, "CHUNK", 3000)
    assert scores(max_bits=1 << 16) == {d: (n, pytest.approx(s, rel=1e-12)) for d, (n, s) in whole.items()}


def test_lm_model_holds_bigrams_seen_once(spark, corpus):
    docs = list(corpus.itertuples(index=False))
    # the same rare words, in an order seen once and in one never seen
    train, held = [i for i in range(10**6, 10**6 + 200) if fold(i, 10)], [i for i in range(10**6, 10**6 + 200) if not fold(i, 10)]
    docs += [(train[0], "rarea rareb rarec"), (held[0], "rarea rareb rarec"), (held[1], "rarec rareb rarea")]
    rows = {r.doc_id: r for r in lm_scoring.score_texts(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert rows[held[0]].score - rows[held[1]].score > 1.0
    want, two = plain_scores(docs)
    assert sum(n == 1 for n in two.values()) > len(two) / 2
    off = [(rows[d].score - want[d]) / rows[d].n_tokens for d, _ in docs]
    assert np.mean(np.abs(off)) < 0.01                     # the filter's false hits


def test_lm_messy(spark, messy):
    rows = sorted((tuple(r)[:5] for r in lm_scoring.score_texts(messy).collect()), key=repr)
    assert rows == sorted((w[:5] for w in plain_base([(d, t) for d, t, *_ in MESSY])), key=repr)
    assert lm_scoring.score_texts(messy.limit(0)).count() == 0
    only_null = messy.where("doc_id is null")
    assert [r.train_tokens for r in lm_scoring.score_texts(only_null).collect()] == [0]


def test_language_id_held_out_accuracy(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id")
    rows = QUERIES["op5_language_id"](spark, SF).collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    real = [r for r in held if r.lang_pred != "und"]
    hit = np.mean([r.lang_pred == docs.lang[r.doc_id] for r in real])
    assert hit > 0.95
    assert abs(np.mean([r.score for r in real]) - hit) < 0.06                 # calibrated
    for r in rows:
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, docs.text[r.doc_id] or "")))


def test_language_id_messy(spark, messy):
    out = language_id.identify_with_folds(messy)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"] and out.count() == len(MESSY)
    und = [r.doc_id for r in out.collect() if r.lang_pred == "und"]
    assert {1, 2, 3} <= set(und) and 4 not in und
    assert language_id.identify_with_folds(messy.limit(0)).count() == 0
    unlabelled = messy.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {(r.lang_pred, r.score) for r in language_id.identify_with_folds(unlabelled).collect()} == {("und", 0.0)}


def test_ftrl_is_sparse_and_learns():
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(400):
        y = int(rng.integers(0, 3))
        at = np.unique(np.r_[rng.integers(0, 5000, 30), 6000 + 10 * y + rng.integers(0, 10, 4)])
        rows.append((at.astype(np.int32), np.full(len(at), 1.0), y))
    w = language_id.ftrl(rows[:300], 3, 3, 0.5, 1.0, 0.5, 0.1, 1)
    hit = [np.argmax(w[:, at] @ x + w[:, -1]) == y for at, x, y in rows[300:]]
    assert np.mean(hit) > 0.9 and (w != 0).mean() < 0.2
