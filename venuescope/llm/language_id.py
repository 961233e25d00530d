"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

n-grams of one to three characters of the lower-cased text fall into hashed columns.  A
column's value is its share of the text's n-grams times its inverse document frequency,
which is counted over all training documents.  The weights are learned by
follow-the-regularised-leader with elastic-net penalties on a bounded sample of the
training documents of each language: shards of the sample learn apart and their weights
are averaged.  A temperature fitted on sample documents kept apart calibrates the scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, row_slices, stage

COLUMNS = 1 << 16
ORDERS = 3
SCALE = 100.0                     # shares of a text are small numbers


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(columns: n-grams x 1, row of each): n-grams of every text, padded with one space at both ends."""
    padded = [f" {(t or '').lower()} " for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), "<u4")
    size = np.array([len(p) for p in padded])
    row = np.repeat(np.arange(len(texts), dtype=np.int32), size)
    cols, rows = [], []
    h = np.zeros(len(codes), np.uint32)
    for k in range(ORDERS):
        h = h[:len(codes) - k] * np.uint32(0x01000193) + (codes[k:] + np.uint32(1)) * np.uint32(0x9E3779B1)
        inside = row[:len(codes) - k] == row[k:]
        g = h ^ (h >> np.uint32(15))
        g = (g * np.uint32(0x85EBCA6B) + np.uint32(k)) >> np.uint32(16)
        cols.append(g[inside])
        rows.append(row[:len(codes) - k][inside])
    return np.concatenate(cols).astype(np.int32), np.concatenate(rows)


def sparse_rows(texts: list[str | None], idf: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(columns, TF-IDF values) of each text."""
    out = []
    for t in texts:
        count = np.bincount(ngrams([t])[0], minlength=COLUMNS)
        at = np.flatnonzero(count)
        out.append((at.astype(np.int32), (SCALE * count[at] / count.sum() * idf[at]).astype(np.float32)))
    return out


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int, alpha: float, beta: float,
         l1: float, l2: float, seed: int) -> np.ndarray:
    """Weights (classes x COLUMNS + 1, the last is the bias) by follow-the-regularised-leader."""
    z, n = np.zeros((classes, COLUMNS + 1)), np.zeros((classes, COLUMNS + 1))

    def weights(at):
        zs = z[:, at]
        return np.where(np.abs(zs) <= l1, 0.0, -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(n[:, at])) / alpha + l2))

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, x, y = rows[i]
            at, x = np.r_[at, COLUMNS], np.r_[x, 1.0]
            w = weights(at)
            p = softmax(w @ x)
            p[y] -= 1.0
            g = p[:, None] * x
            root = np.sqrt(n[:, at])
            n[:, at] += g * g
            z[:, at] += g - (np.sqrt(n[:, at]) - root) / alpha * w
    return weights(slice(None))


class Model:
    """Languages, weights folded with idf (COLUMNS x classes), bias and temperature."""

    def __init__(self, langs: list[str], table: np.ndarray, bias: np.ndarray, temperature: float = 1.0):
        self.langs, self.table, self.bias, self.temperature = langs, table, bias, temperature

    def logits(self, texts: list[str | None]) -> np.ndarray:
        cols, rows = ngrams(texts)
        out = np.zeros((len(texts), len(self.langs)))
        total = np.bincount(rows, minlength=len(texts))
        for c in range(len(self.langs)):
            out[:, c] = np.bincount(rows, weights=self.table[:, c][cols], minlength=len(texts))
        return out / np.maximum(total, 1)[:, None] + self.bias

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        p = softmax(self.logits(texts) / self.temperature)
        best = p.argmax(axis=1)
        score = p[np.arange(len(texts)), best]
        return [self.langs[i] for i in best], score


def document_frequency(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """(documents that hold each column, documents), over all rows; COLUMNS numbers from each task
    are summed before they reach the driver."""
    def run(batches):
        held, docs_ = np.zeros(COLUMNS + 1, np.int64), 0
        for batch in batches:
            for part in row_slices(batch, "t"):
                cols, rows = ngrams(part.column("t").to_pylist())
                order = np.argsort(rows, kind="stable")
                cuts = np.searchsorted(rows[order], np.arange(part.num_rows + 1))
                cols = cols[order]
                seen = np.zeros(COLUMNS, bool)
                for a, b in zip(cuts, cuts[1:]):
                    seen[cols[a:b]] = True
                    held[:COLUMNS] += seen
                    seen[cols[a:b]] = False
                docs_ += part.num_rows
        held[COLUMNS] = docs_
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(held[at])], ["c", "n"])

    rows = docs.select(F.col(text).alias("t")).mapInArrow(run, "c int, n long").groupBy("c").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(COLUMNS + 1, np.int64)
    out[rows.column("c").to_numpy()] = rows.column("n").to_numpy()
    return out[:COLUMNS], int(out[COLUMNS])


def fit(train: DataFrame, per_language: int = 3000, shards: int = 4, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0,
        l1: float = 0.02, l2: float = 0.5, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """The model of labelled documents; None without any.

    Rows with null text or lang teach nothing.  Weights and temperature are fitted on a sample of about ``per_language``
    documents of each language (all, where there are fewer), chosen by a hash of the id; a fifth of it
    is for the temperature.  Document frequencies are counted over all training rows."""
    rows = train.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(key).alias("d"), F.col(text).alias("t"), F.col(lang).cast("string").alias("l"))
    counts = {r.l: r["count"] for r in rows.groupBy("l").count().collect()}
    if not counts:
        return None
    langs = sorted(counts)
    df, docs = document_frequency(rows, "t")
    idf = np.log((1 + docs) / (1 + df)) + 1.0
    spark = train.sparkSession
    shares = spark.createDataFrame([(k, i, min(1.0, per_language / counts[k])) for i, k in enumerate(langs)], "l string, y int, share double")
    place = (F.pmod(F.xxhash64(F.lit(1), "d"), F.lit(1_000_003)) / 1_000_003).alias("place")
    sample = rows.join(F.broadcast(shares), "l").where(place < F.col("share"))       # one row a language
    sample = sample.select("y", "t", F.pmod(F.xxhash64(F.lit(2), "d"), F.lit(5 * shards)).cast("int").alias("part"))
    shipped = spark.sparkContext.broadcast(idf)

    def vectors(batches):
        for batch in batches:
            for piece in row_slices(batch, "t"):
                own = sparse_rows(piece.column("t").to_pylist(), shipped.value)
                yield pa.RecordBatch.from_arrays([piece.column("y"), piece.column("part"),
                                                  pa.array([a for a, _ in own], pa.list_(pa.int32())),
                                                  pa.array([x for _, x in own], pa.list_(pa.float32()))], ["y", "part", "at", "x"])

    vecs = stage(sample.mapInArrow(vectors, "y int, part int, at array<int>, x array<float>"), "lang-sample")

    def shard(part: pa.Table) -> pa.Table:
        own = [(np.array(a, np.int32), np.array(x, np.float64), y) for a, x, y in zip(
            part.column("at").to_numpy(), part.column("x").to_numpy(), part.column("y").to_pylist())]
        w = ftrl(own, len(langs), epochs, alpha, beta, l1, l2, 17)
        c, at = np.nonzero(w)
        return pa.table({"c": pa.array(c.astype(np.int32)), "at": pa.array(at.astype(np.int32)), "w": pa.array(w[c, at])})

    learn = vecs.where(F.col("part") % 5 != 0).withColumn("shard", (F.col("part") / 5).cast("int"))
    used = max(1, learn.select("shard").distinct().count())
    mean = learn.groupBy("shard").applyInArrow(shard, "c int, at int, w double").groupBy("c", "at").agg(F.sum("w").alias("w")).toArrow()
    weights = np.zeros((len(langs), COLUMNS + 1))
    weights[mean.column("c").to_numpy(), mean.column("at").to_numpy()] = mean.column("w").to_numpy() / used

    def losses(batches):
        """Log-loss of the held-apart sample at each temperature, summed in the task."""
        out = np.zeros(len(TEMPERATURES))
        for batch in batches:
            for at, x, y in zip(batch.column("at").to_pylist(), batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                logit = weights[:, at] @ np.array(x) + weights[:, COLUMNS]
                for i, temperature in enumerate(TEMPERATURES):
                    out[i] -= np.log(max(softmax(logit / temperature)[y], 1e-300))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(out), dtype=np.int32)), pa.array(out)], ["i", "loss"])

    loss = {r.i: r.loss for r in vecs.where(F.col("part") % 5 == 0).mapInArrow(losses, "i int, loss double")
            .groupBy("i").agg(F.sum("loss").alias("loss")).collect()}
    best = min(loss, key=lambda i: (loss[i], i)) if any(loss.values()) else TEMPERATURES.index(1.0)
    return Model(langs, np.ascontiguousarray((SCALE * weights[:, :COLUMNS] * idf).T), weights[:, COLUMNS], TEMPERATURES[best])


TEMPERATURES = [0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0, 1.1, 1.25, 1.5, 1.75, 2.0, 2.5, 3.0, 4.0, 5.0]


def identify(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text: the most probable language and its calibrated probability.
    ``und`` with score 0 for null texts and texts without a letter, and for all without a model.  Repeated
    rows and null ids each give a row; other columns are not read."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shipped.value
        for batch in batches:
            for part in row_slices(batch, "t"):
                texts = part.column("t").to_pylist()
                known = [own is not None and bool(t) and any(map(str.isalpha, t)) for t in texts]
                lang, score = own.predict(texts) if own is not None else ([], [])
                yield pa.RecordBatch.from_arrays([
                    part.column("d"), pa.array([lang[i] if k else "und" for i, k in enumerate(known)], pa.string()),
                    pa.array([float(score[i]) if k else 0.0 for i, k in enumerate(known)], pa.float64())], ["d", "lang_pred", "score"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("d"), F.col(text).alias("t")).mapInArrow(
        run, f"d {kind}, lang_pred string, score double").withColumnRenamed("d", key)


def identify_with_folds(docs: DataFrame, folds: int = 4, fold_out: int = 2, key: str = "doc_id", text: str = "text",
                        lang: str = "lang", **fitting) -> DataFrame:
    """identify() with a model that learns from every fold of crc32(doc_id as text) but ``fold_out``, with
    held_out (boolean) added; a null id is in no fold and does not teach."""
    at = fold(F.col(key), folds)
    model = fit(docs.where((at >= 0) & (at != fold_out)), key=key, text=text, lang=lang, **fitting)
    out = identify(docs, model, key, text)
    return out.select(key, (fold(F.col(key), folds) == fold_out).alias("held_out"), "lang_pred", "score")
