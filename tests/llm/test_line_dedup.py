"""Line dedup against a plain restatement of its rule, and reversibility."""

import hashlib

import numpy as np

from llm_fixtures import MESSY, SF, corpus, messy  # noqa: F401
from venuescope.llm.cuckoo import CuckooFilter
from venuescope.llm.line_dedup import LineDedup, dedup_lines
from venuescope.llm.queries import QUERIES

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, min_chars=40, min_docs=5):
    """docs: [(id, text)] with distinct ids -> {id: (n_lines, n_dropped, text)}"""
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOW)
    held = {}
    for d, t in docs:
        for k in {key(x) for x in (t or "").split("\n")}:
            held.setdefault(k, []).append(d)
    out = {}
    for d, t in docs:
        lines = (t or "").split("\n")
        keep = [x for x in lines if not (len(key(x)) >= min_chars and len(held[key(x)]) >= min_docs and max(held[key(x)]) != d)]
        out[d] = (len(lines), len(lines) - len(keep), "\n".join(keep))
    return out


def test_query(spark, corpus):
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in QUERIES["op3_line_dedup"](spark, SF).collect()}
    want = {d: (n, k, hashlib.sha256(t.encode()).hexdigest())
            for d, (n, k, t) in plain(list(corpus.itertuples(index=False))).items()}
    assert got == want and any(k for _, k, _ in want.values())


def as_dict(df):
    return {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in df.select("doc_id", "n_lines", "n_dropped", "text").collect()}


def test_insert_delete_is_reversible(spark):
    rng = np.random.default_rng(2)
    pool = [f"Line number {i} of the POOL of lines, é" for i in range(12)]
    docs = [(i, "\n".join(("  " if rng.random() < .3 else "") + pool[j] for j in rng.integers(0, 12, 4))) for i in range(24)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    one, two = df.where("doc_id < 14"), df.where("doc_id >= 14")
    for ship in (1 << 20, -1):                       # with the filters at the workers, and without
        state = LineDedup(spark, 30, 5, shards=3, ship_bytes=ship).insert(one)
        first = as_dict(state.rewrite(one))
        assert first == plain(docs[:14], 30)
        state.insert(two)
        assert as_dict(state.rewrite(df)) == plain(docs, 30)
        state.delete(two)
        assert as_dict(state.rewrite(one)) == first
        hot = state.counts.where("n_docs >= 5").collect()
        shards = {r["shard"]: CuckooFilter.from_bytes(bytes(r["filter"])) for r in state.filters.collect()}
        assert all(shards[r.shard].contains(np.array([r.lo]).astype(np.uint64))[0] for r in hot)
        state.delete(one)
        assert state.counts.count() == 0
        assert all((CuckooFilter.from_bytes(bytes(r["filter"])).table == 0).all() for r in state.filters.collect())


def test_messy(spark, messy):
    out = dedup_lines(messy, min_chars=1, min_docs=2)
    assert set(messy.columns) <= set(out.columns) and out.count() == len(MESSY)
    got = {r.doc_id: r for r in out.collect()}
    assert (got[1].text, got[1].n_lines, got[1].n_dropped) == ("", 1, 0)
    assert (got[2].text, got[2].n_lines) == ("", 1)
    assert got[4].text == "a" and got[4].d == 4
    assert dedup_lines(messy.limit(0)).count() == 0


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**63, 50_000).astype(np.uint64))
    own = CuckooFilter(keys[:40_000])
    assert own.contains(keys[:40_000]).all() and own.contains(keys[40_000:]).mean() < 0.002
    own.remove(keys[:10_000])
    assert own.contains(keys[10_000:40_000]).all() and own.contains(keys[:10_000]).mean() < 0.002
    assert own.insert(keys[:5_000]) and own.contains(keys[:5_000]).all()
    assert not CuckooFilter(keys[:100]).insert(keys[100:10_000])
    assert CuckooFilter(np.array([], np.uint64)).contains(keys[:5]).sum() == 0


def test_an_empty_state_changes_nothing(spark):
    docs = spark.createDataFrame([(1, "x" * 50), (2, None)], "doc_id long, text string")
    state = LineDedup(spark, min_docs=1)
    assert as_dict(state.delete(docs).rewrite(docs)) == {1: (1, 0, "x" * 50), 2: (1, 0, "")}
    state.insert(docs.limit(0)).delete(docs)
    assert state.counts.count() == 0 and as_dict(state.rewrite(docs)) == {1: (1, 0, "x" * 50), 2: (1, 0, "")}


def test_counts_after_every_step_equal_those_from_scratch(spark):
    rng = np.random.default_rng(12)
    pool = [f"a line of more than ten characters, number {i}" for i in range(30)]
    docs = [(i, "\n".join(rng.choice(pool, 6))) for i in range(60)]
    table = lambda ds: spark.createDataFrame(ds, "doc_id long, text string")
    state, held = LineDedup(spark, min_chars=10, min_docs=3), []
    for step, part in (("insert", docs[:25]), ("insert", docs[25:40]), ("delete", docs[5:30]), ("insert", docs[40:]), ("delete", docs[38:60:3] + [(999, "")])):
        getattr(state, step)(table(part))
        ids = {d for d, _ in part}
        held = held + part if step == "insert" else [x for x in held if x[0] not in ids]
        fresh = LineDedup(spark, min_chars=10, min_docs=3).insert(table(held))
        assert sorted(map(tuple, state.counts.select("hi", "lo", "n_docs", "keeper").collect())) == sorted(
            map(tuple, fresh.counts.select("hi", "lo", "n_docs", "keeper").collect()))
        assert as_dict(state.rewrite(table(held))) == {d: x for d, x in plain(held, 10, 3).items()}
