"""The pipeline stage by stage against the plain versions of the operator tests."""

import pandas as pd
import public_tokenizers as P
import pytest

import corpus_pipeline
from llm_fixtures import SF, corpus, messy  # noqa: F401
from test_line_dedup import plain as plain_lines
from test_near_duplicates import plain as plain_near
from test_quality_rules import plain as plain_quality
from test_suffix_dedup import plain as plain_bytes
from test_tokens import best_fit, check_packing
from venuescope.llm.common import stage


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, step in corpus_pipeline.STAGES:
        out.append(stage(step(spark, out[-1], SF), "test"))
    return out


def frame(df):
    return df.toPandas().sort_values("doc_id").reset_index(drop=True)


def test_columns(stages):
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes


def test_quality_keeps_clean_documents(stages):
    before, after = frame(stages[0]), frame(stages[1])
    labels = pd.read_parquet(f"{SF}/labels.parquet").set_index("doc_id").quality
    kept = set(after.doc_id)
    failed = {d for d, t in zip(before.doc_id, before.text) if plain_quality(t)[-1]}
    assert not kept & failed and kept <= set(before.doc_id)
    good = [d for d in before.doc_id if d not in failed and labels.get(d) == 1]
    assert sum(d in kept for d in good) >= 0.98 * len(good)
    assert after.equals(before[before.doc_id.isin(kept)].reset_index(drop=True))


def test_line_stage(stages):
    before, after = frame(stages[1]), frame(stages[2])
    want = plain_lines(list(zip(before.doc_id, before.text)))
    assert dict(zip(after.doc_id, after.text)) == {d: t for d, (_, _, t) in want.items()}
    assert (after.n_chars == after.text.str.len()).all()


def test_near_duplicate_stage(stages):
    before, after = frame(stages[2]), frame(stages[3])
    want = plain_near(list(zip(before.doc_id, before.text)))
    assert after.equals(before[[want[d][2] for d in before.doc_id]].reset_index(drop=True))


def test_passage_stage(stages):
    before, after = frame(stages[3]), frame(stages[4])
    assert after.doc_id.tolist() == before.doc_id.tolist()
    assert after.text.tolist() == [b.decode("utf-8", "ignore") for *_, b in plain_bytes(before.text)]


def test_packing_stage(stages):
    from tokenizers import Tokenizer

    word = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    docs = frame(stages[4])
    rows = [tuple(r) for r in stages[5].collect()]
    n = check_packing(rows, [(d, word.encode(t, add_special_tokens=False).ids + [0]) for d, t in zip(docs.doc_id, docs.text)], 2048)
    assert n == best_fit([r[3] for r in rows], 2048)


def test_run_chains_the_stages(spark, monkeypatch):
    """Each stage gets what the one before it kept, and the folder of the tables."""
    monkeypatch.setattr(corpus_pipeline, "STAGES", [
        ("first", lambda s, docs, d: docs.where("doc_id < 50")), ("second one", lambda s, docs, d: docs.selectExpr("doc_id", f"'{d}' as d"))])
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "d"] and {r.d for r in got.collect()} == {SF}
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 50").count()


def test_empty_and_messy_tables(spark, messy, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = messy.limit(0)
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, str(tmp_path)), "test")
        assert docs.count() == 0 and (name == "packing" or docs.columns == messy.columns)
    for step in (corpus_pipeline.lines, corpus_pipeline.passages):
        out = step(spark, messy, str(tmp_path))
        assert out.columns == messy.columns and out.count() == messy.count()
    assert corpus_pipeline.pack(spark, messy, str(tmp_path)).select("doc_id").distinct().count() == messy.select("doc_id").distinct().count()


def test_quality_and_near_duplicates_of_messy_rows(spark, messy):
    """The real labels, nulls, repeated rows, ids with two texts and columns with clashing names."""
    rows = [tuple(r) for r in messy.collect()]
    failed = lambda t: plain_quality(t)[-1]
    got = [tuple(r) for r in corpus_pipeline.quality(spark, messy, SF).collect()]
    assert not any(failed(t) for _, t, *_ in got) and set(got) <= set(rows)
    prose = " ".join(f"word{i}" for i in range(60))
    docs = messy.union(spark.createDataFrame([(20, prose, "en", 1, 1), (20, prose.upper(), "en", 2, 1), (21, prose + " x", "en", 1, 1),
                                              (None, prose, "en", 1, 1), (20, "other text of five words", "de", 1, 1)], messy.schema))
    kept = [(r[0], r[1]) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()]
    wanted = {(r[0], r[1]) for r in docs.collect()} - {(21, prose + " x")}
    of_20 = [t for d, t in kept if d == 20]
    assert len(of_20) == 2 and "other text of five words" in of_20       # one of the two that share a set
    assert set(kept) == wanted - {(20, prose), (20, prose.upper())} | {(20, t) for t in of_20} and len(kept) == len(set(kept))
