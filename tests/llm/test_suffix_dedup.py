"""Repeated byte strings against a count of every window."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import MESSY, SF, corpus, messy  # noqa: F401
from venuescope.llm import suffix_dedup
from venuescope.llm.bwt import repeated_starts
from venuescope.llm.queries import QUERIES


def plain(texts, length=200):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = True
        gone = gone[:len(r)]
        spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(r) else 0
        out.append((len(r), int(gone.sum()), spans, bytes(np.frombuffer(r, np.uint8)[~gone])))
    return out


def test_query(spark, corpus):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op8_suffix_dedup"](spark, SF).collect()}
    want = {d: (n, k, s, hashlib.sha256(b).hexdigest()) for d, (n, k, s, b) in zip(corpus.doc_id, plain(corpus.text))}
    assert got == want and sum(k for _, k, *_ in want.values()) > 1000


@pytest.mark.parametrize("crowd", [4096, 3, 0])
def test_shared_passages_and_periods(spark, monkeypatch, crowd):
    rng = np.random.default_rng(6)
    word = lambda: "".join(rng.choice(list("abcdé"), 4))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(30) for _ in range(4)]
    texts = [" ".join([prose(int(rng.integers(0, 30))), shared[int(rng.integers(0, 4))], prose(int(rng.integers(0, 30)))]) for _ in range(60)]
    texts += texts[:7] + ["ab" * 100, "ab" * 21, "x" * 45, "x" * 40, prose(10) * 3, "", None, shared[0][3:80]]
    for i in range(20):                               # near copies
        t = list(texts[7 + i % 3])
        t[int(rng.integers(0, len(t)))] = "#"
        texts.append("".join(t))
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    monkeypatch.setattr(suffix_dedup, "SHARD", 2000)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(df, 40, 12).collect()}
    assert out == dict(enumerate(plain(texts, 40)))


def test_messy(spark, messy):
    out = suffix_dedup.remove_repeats(messy.selectExpr("*", "1 as t1", "2 as owner", "3 as kept"))
    assert out.columns == [*messy.columns, "t1", "owner", "kept", "n_bytes", "n_removed", "n_spans"]
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()), key=repr)
    want = plain([t for _, t, *_ in MESSY])
    assert got == sorted(((d, *w) for (d, *_), w in zip(MESSY, want)), key=repr)
    assert suffix_dedup.remove_repeats(messy.limit(0)).count() == 0


def test_interval_expansion():
    rng = np.random.default_rng(0)
    for _ in range(300):
        length, letters = int(rng.integers(1, 12)), int(rng.integers(1, 4))
        pieces = [bytes(rng.integers(97, 97 + letters, int(rng.integers(0, 40))).astype(np.uint8)) for _ in range(int(rng.integers(1, 8)))]
        pieces += [p[2:] for p in pieces[:3]]
        seen = Counter(p[i:i + length] for p in pieces for i in range(len(p) - length + 1))
        again = repeated_starts(np.frombuffer(b"".join(p + b"\xff" for p in pieces), np.uint8), length)
        at = 0
        for p in pieces:
            for i in range(len(p) - length + 1):
                assert again[at + i] == (seen[p[i:i + length]] > 1)
            at += len(p) + 1


def test_equal_windows_have_equal_owners():
    rng = np.random.default_rng(2)
    for _ in range(50):
        text = np.frombuffer(bytes(rng.choice([97, 98], int(rng.integers(1, 300))).astype(np.uint8)), np.uint8)
        owner, digest, start, size = suffix_dedup.snippets(text, 20, 6)
        held, where = [], {}
        for o, s, n in zip(owner.tolist(), start.tolist(), size.tolist()):
            inside = [text[i:i + 20].tobytes() for i in range(s, s + n - 19)]
            assert len(set(inside)) == len(inside)
            held += inside
            for w in inside:
                assert where.setdefault(w, o) == o
        assert held == [text[i:i + 20].tobytes() for i in range(len(text) - 19)]
