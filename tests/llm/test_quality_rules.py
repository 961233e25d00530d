"""Quality statistics against plain Python; learned rules on held-out labels."""

import inspect
import re
from collections import Counter

import pandas as pd
from pyspark.sql import functions as F

from llm_fixtures import MESSY, SF, corpus, messy  # noqa: F401
from venuescope.llm import quality_rules
from venuescope.llm.queries import QUERIES


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = list(zip(w, w[1:], w[2:]))
    seen = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if seen[x] > 1 for k in range(3)}
    n, rep = len(w), len(covered)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), rep,
            n < 50 or 100 * rep > 50 * n)


COLS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_query_statistics_and_verdict(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = pd.read_parquet(f"{sf}/documents.parquet"), pd.read_parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in QUERIES["op7_quality_rules"](spark, sf).collect()}
    assert len(got) == len(docs)
    for d, t in docs[["doc_id", "text"]].itertuples(index=False):
        assert tuple(got[d][c] for c in COLS) == plain(t), d
        assert not (got[d].base_failed and got[d].kept)
    passed = labels[[not got[d].base_failed for d in labels.doc_id]]
    kept = [got[d].kept for d in passed.doc_id]
    good = passed.quality == 1
    assert pd.Series(kept, index=passed.index)[good].mean() > 0.98
    assert pd.Series(kept, index=passed.index)[~good].mean() < 0.4


def test_messy_and_repeats(spark, messy):
    extra = [(20 + i, t, None, None, None) for i, t in enumerate([
        "a b c a b c", "a b c d a b c", "a a a a", "a a", "x y z\nx y z\n \nx y z\n\n", "a b c x a b c b c x", "#| $%\n#| $%"])]
    df = messy.union(spark.createDataFrame(extra, messy.schema))
    out = quality_rules.text_statistics(df)
    got = sorted(((r.doc_id, *(r[c] for c in COLS[:5])) for r in out.collect()), key=repr)
    assert got == sorted(((d, *plain(t)[:5]) for d, t, *_ in [*MESSY, *extra]), key=repr)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    judged = quality_rules.judge_quality(df, none)
    assert {r.rule for r in judged.collect()} == {0}
    assert quality_rules.judge_quality(messy.limit(0), none).count() == 0
    odd = spark.createDataFrame([(None, 0), (1, None), (4, 7), (999, 0)], "doc_id long, quality int")
    assert quality_rules.judge_quality(df, odd).count() == len(MESSY) + len(extra)


def test_rules_find_planted_conjunction(spark):
    rows = spark.range(6000).select(
        F.col("id").alias("doc_id"), (F.lit(60) + F.pmod(F.xxhash64("id"), F.lit(1000))).alias("n_words"),
        F.lit(5).alias("w"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2000)).alias("share"), F.lit(0).cast("long").alias("n_dup_lines"),
        F.lit(0).cast("long").alias("n_repeat_words"), F.lit(10).cast("long").alias("n_lines")).withColumn("word_chars", F.col("n_words") * 5)
    rows = rows.withColumn("n_symbols", F.ceil(F.col("n_words") * F.col("share") / 1000))
    bad = (F.col("n_words") < 300) & (F.col("share") >= 700)
    rules = quality_rules.learn(rows.withColumn("bad", bad))
    assert 1 <= len(rules) <= 8
    hit = rows.withColumn("bad", bad).withColumn("rule", quality_rules.verdict(rules)).groupBy("bad").agg(F.avg((F.col("rule") > 0).cast("int")).alias("r"))
    rate = {r.bad: r.r for r in hit.collect()}
    assert rate[True] > 0.8 and rate[False] < 0.03
    assert quality_rules.verdict([]) is not None
    assert quality_rules.learn(rows.withColumn("bad", F.lit(False))) == []


def test_native_only():
    text = inspect.getsource(quality_rules)
    assert not re.search(r"pandas|mapIn|applyIn|udf|\.rdd|pyarrow|toPandas", text)
