"""Learned quality rules: a decision list over text statistics, in DataFrame functions only.

The statistics of a text are native expressions.  The list is learned by sequential
covering on labelled documents: a rule grows by the threshold condition of highest gain,
is cut back to its best prefix on rows it was not grown on, and joins the list if it is
precise there; its thresholds move to the middle of their gaps; the rows it covers leave.  Growing reads counts by feature and bin, a
few hundred numbers however many rows there are, so all labelled rows take part.  The
finished list is one ordered CASE expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, stage

BLANK = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def text_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines), longs.

    A null text counts as empty: all zero.  n_lines counts lines with a word.  Repeated rows and
    null ids each give a row; other columns are not read, but with ``whole`` doc_id is the whole
    row as a struct.

    Repeated words: each 3-word window becomes its hash with its position in the low bits; in the
    sorted array equal windows are neighbours, and of the positions so found each adds the words
    that the one before it does not cover.  Neighbours count only if their words are equal."""
    t = docs.select((F.struct("*") if whole else F.col(doc_id)).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    w = t.select("doc_id", F.filter(F.split("t", BLANK + "+"), lambda x: x != "").alias("w"),
                 F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                 F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    word = lambda i: F.get("w", i)
    low = F.when(F.size("w") < 2**24, F.lit(2**24 - 1)).otherwise(F.lit(2**31 - 1))
    windows = F.transform(F.slice("w", 1, F.greatest(F.size("w") - 2, F.lit(0))),
                          lambda x, i: F.xxhash64(x, word(i + 1), word(i + 2)).bitwiseAND(F.bitwise_not("low")).bitwiseOR(i.cast("long")))
    s = (w.withColumn("low", low.cast("long"))
         .select("doc_id", "w", "low", "n_symbols", "lines", F.sort_array(windows).alias("s")))
    place = lambda e: e.bitwiseAND(F.col("low")).cast("int")

    def equal(e: Column, other: Column) -> Column:
        p, q = place(e), place(other)
        near = e.bitwiseAND(F.bitwise_not("low")) == other.bitwiseAND(F.bitwise_not("low"))
        return F.coalesce(near & (word(p) == word(q)) & (word(p + 1) == word(q + 1)) & (word(p + 2) == word(q + 2)), F.lit(False))

    again = F.filter("s", lambda e, j: equal(e, F.get("s", j - 1)) | equal(e, F.get("s", j + 1)))
    p = s.select("doc_id", "w", "n_symbols", "lines", F.sort_array(F.transform(again, lambda e: e.bitwiseAND(F.col("low")))).alias("p"))
    covered = F.aggregate(F.transform("p", lambda x, j: F.coalesce(F.least(F.lit(3).cast("long"), x - F.get("p", j - 1)), F.lit(3).cast("long"))),
                          F.lit(0).cast("long"), lambda a, x: a + x)
    return p.select(F.col("doc_id").alias(doc_id), F.size("w").cast("long").alias("n_words"),
                    F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"), "n_symbols",
                    (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                    covered.alias("n_repeat_words"), F.size("lines").cast("long").alias("n_lines"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def features() -> dict[str, Column]:
    """Statistics that do not grow with the text, in thousandths, besides the number of words."""
    per = lambda a, b: F.floor(1000 * F.col(a) / F.greatest(F.col(b), F.lit(1))).cast("long")
    return {"n_words": F.col("n_words"), "chars_per_word": per("word_chars", "n_words"),
            "symbols_per_word": per("n_symbols", "n_words"), "repeated_words": per("n_repeat_words", "n_words"),
            "repeated_lines": per("n_dup_lines", "n_lines"), "words_per_line": per("n_words", "n_lines")}


@dataclass(frozen=True)
class Condition:
    """feature >= at, or feature < at."""

    feature: str
    above: bool
    at: int

    def column(self) -> Column:
        x = features()[self.feature]
        return x >= self.at if self.above else x < self.at

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.at}"


def _all(conditions, columns) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & (columns[c.feature] >= c.at if c.above else columns[c.feature] < c.at)
    return out


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    """FOIL's gain of narrowing (p0, n0) rejected and good rows to (p, n)."""
    return p * (math.log2((p + 1e-9) / (p + n + 1e-9)) - math.log2(p0 / (p0 + n0))) if p else -1.0


def learn(labelled: DataFrame, cuts: int = 32, max_rules: int = 8, max_conditions: int = 3,
          precision: float = 0.95, support: int = 3) -> list[list[Condition]]:
    """Rules that reject, in order.  ``labelled``: text_statistics columns, doc_id and
    ``bad`` (boolean; rows with null are left out).  Every third document by the hash of its id judges
    the rules, the others grow them.  A rule needs ``precision`` and ``support`` bad rows among those."""
    names = list(features())
    rows = (labelled.where(F.col("bad").isNotNull())
            .select(*[c.alias(k) for k, c in features().items()], F.col("bad"), (fold(F.col("doc_id"), 3) == 0).alias("judge")))
    rows = stage(rows, "quality-labelled")
    # candidate thresholds: quantiles of each feature within each class, at most 2 * cuts a feature
    at = [i / cuts for i in range(1, cuts)]
    quantiles = rows.groupBy("bad").agg(*[F.percentile_approx(k, at, 1000).alias(k) for k in names]).collect()
    values = {k: sorted({v + up for r in quantiles for v in r[k] for up in (0, 1)}) for k in names}
    cols = {k: F.col(k) for k in names}

    def bin_of(k: str) -> Column:
        return F.size(F.filter(F.array(*[F.lit(v) for v in values[k]]), lambda v: v <= F.col(k))) if values[k] else F.lit(0)

    binned = stage(rows.select("*", *[bin_of(k).alias("b_" + k) for k in names]), "quality-binned")

    def histogram(df: DataFrame) -> dict[tuple[str, int], tuple[int, int]]:
        stack = f"stack({len(names)}, " + ", ".join(f"'{k}', b_{k}" for k in names) + ") as (feature, bin)"
        got = df.select("bad", F.expr(stack)).groupBy("feature", "bin").agg(
            F.sum(F.col("bad").cast("long")).alias("p"), F.sum((~F.col("bad")).cast("long")).alias("n")).collect()
        return {(r.feature, r.bin): (r.p, r.n) for r in got}

    rules: list[list[Condition]] = []
    left = binned
    while len(rules) < max_rules:
        rule: list[Condition] = []
        grow = left.where("not judge")
        while len(rule) < max_conditions:
            counts = histogram(grow.where(_all(rule, cols)))
            p0, n0 = (sum(counts.get((names[0], b), (0, 0))[s] for b in range(len(values[names[0]]) + 1)) for s in (0, 1))
            if not p0 or not n0:
                break
            best = (0.0, None)
            for k in names:
                p = n = 0
                for b in range(len(values[k])):              # rows below threshold b
                    p, n = p + counts.get((k, b), (0, 0))[0], n + counts.get((k, b), (0, 0))[1]
                    for above, (x, y) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                        best = max(best, (_gain(x, y, p0, n0), Condition(k, above, values[k][b])), key=lambda z: z[0])
            if best[1] is None:
                break
            rule.append(best[1])
        if not rule:
            break
        # prune: the prefix that does best on the judging rows
        judge = left.where("judge").agg(*[F.sum((_all(rule[:i], cols) & (F.col("bad") == good)).cast("long")).alias(f"{'p' if good else 'n'}{i}")
                                          for i in range(1, len(rule) + 1) for good in (True, False)]).first()
        score = [((judge[f"p{i}"] or 0), (judge[f"n{i}"] or 0)) for i in range(1, len(rule) + 1)]
        size = max(range(len(rule)), key=lambda i: ((score[i][0] - score[i][1]) / max(1, sum(score[i])), -i))
        p, n = score[size]
        if p < support or p < precision * (p + n):
            break
        rules.append(_centre(left, rule[:size + 1], cols))
        left = left.where(~_all(rules[-1], cols))
    return rules


def _centre(rows: DataFrame, rule: list[Condition], cols: dict[str, Column]) -> list[Condition]:
    """The rule with each threshold in the middle of the gap that it stands in, among the rows
    that meet the rule's other conditions: as far from either side as the labels allow."""
    aggs = []
    for i, c in enumerate(rule):
        rest = _all(rule[:i] + rule[i + 1:], cols)
        aggs += [F.max(F.when(rest & (cols[c.feature] < c.at), cols[c.feature])).alias(f"lo{i}"),
                 F.min(F.when(rest & (cols[c.feature] >= c.at), cols[c.feature])).alias(f"hi{i}")]
    gap = rows.agg(*aggs).first()
    return [Condition(c.feature, c.above, (gap[f"lo{i}"] + gap[f"hi{i}"] + 1) // 2) if None not in (gap[f"lo{i}"], gap[f"hi{i}"]) else c
            for i, c in enumerate(rule)]


def verdict(rules: list[list[Condition]]) -> Column:
    """Number of the first rule that a row meets, 0 for none: one ordered CASE expression."""
    out = None
    for i, rule in enumerate(rules, 1):
        met = F.lit(True)
        for c in rule:
            met = met & c.column()
        out = F.when(met, i) if out is None else out.when(met, i)
    return F.lit(0) if out is None else out.otherwise(0)


def learn_from(stats: DataFrame, labels: DataFrame, doc_id: str = "doc_id", **learning) -> list[list[Condition]]:
    """The rules of the documents with statistics ``stats`` that pass the base check and are labelled.

    ``labels``: (doc_id, quality) with 1 good and 0 bad; other values, null ids and ids without a
    document teach nothing, an id with both values is bad.  Without labels of both kinds the list is empty."""
    known = labels.where("quality in (0, 1)").groupBy(F.col(doc_id).alias("doc_id")).agg((F.min("quality") == 0).alias("bad"))
    return learn(stats.where(~base_failed()).join(known, "doc_id"), **learning)


def judge_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **learning) -> DataFrame:
    """(doc_id, the five base statistics, base_failed, rule, kept), one row per input row: rule is the number
    of the learned rule that rejects it, 0 for none."""
    stats = stage(text_statistics(docs, doc_id, text).withColumnRenamed(doc_id, "doc_id"), "quality-statistics")
    rule = verdict(learn_from(stats, labels, doc_id, **learning)).cast("int")
    return stats.select(F.col("doc_id").alias(doc_id), *BASE, base_failed().alias("base_failed"), rule.alias("rule"),
                        (~base_failed() & (rule == 0)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **learning) -> DataFrame:
    """The rows of ``docs`` that pass the base check and that no learned rule rejects."""
    # written once with their statistics: a filter on them would otherwise be pushed into their array
    # expressions and evaluate those again for every element
    rows = stage(text_statistics(docs, text=text, whole=True), "quality-rows")
    stats = rows.select(F.col(f"doc_id.{doc_id}").alias("doc_id"), *BASE, "n_lines")
    rules = learn_from(stats, labels, doc_id, **learning)
    return rows.where(~base_failed() & (verdict(rules) == 0)).select("doc_id.*")
