"""Quality classifier: a linear support vector machine on naive Bayes features.

Method: a text is a set of n-gram indicators. Each indicator is scaled by its class
log-count ratio (the naive Bayes weight), and a linear hinge-loss model is fitted on the
scaled indicators by dual coordinate descent; the weights are blended with their mean,
as is usual for this model. The score is the logistic function of the margin.

N-grams are runs of three bytes of the UTF-8, hashed, and runs of up to four word
repetitions (a word equal to the one before it), which bytes cannot show.

The model is fitted on at most ``SAMPLE`` labelled rows, chosen by a hash of doc_id among
those that are not held out; their ids and labels are broadcast, so no text is moved.
Labels, language, source and id are never inputs of a score.

Defined results: null and empty text score by the bias alone; null doc_id has no label
and is not held out; repeated and conflicting labels count by their mean (a half is 1),
null labels not at all; without labels of both classes every score is that class's (or
1); repeated rows are scored each; an empty table gives an empty table; extra columns
are kept by ``remove_rejected`` and otherwise ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnloom.llm.common import texts
from churnloom.session import stored

#: Labelled rows the model is fitted on, at most.
SAMPLE = 12_000
BITS = 18
#: Features by repetition follow the hashed ones, then the bias.
RUNS = 4
WIDTH = (1 << BITS) + RUNS + 1
SMOOTHING, COST, EPOCHS, BLEND = 1.0, 1.0, 20, 0.25
SEED = 7


def features(text: str) -> np.ndarray:
    """Sorted indices of the indicators that are set."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    grams = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
    hashed = np.unique((grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS))
    words = text.split()
    run = longest = 0
    for a, b in zip(words, words[1:]):
        run = run + 1 if a == b else 0
        longest = max(longest, run)
    runs = np.arange(min(longest, RUNS), dtype=np.uint32) + np.uint32(1 << BITS)
    return np.concatenate([hashed, runs, [np.uint32(WIDTH - 1)]]).astype(np.int64)


def ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Class log-count ratio of every indicator; the bias is left as it is."""
    counts = {c: np.full(WIDTH, SMOOTHING) for c in (0, 1)}
    for x, y in zip(rows, labels.tolist()):
        counts[y][x] += 1
    r = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    r[-1] = 1.0
    return r


def descend(rows: list[np.ndarray], labels: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Weights on the indicators, by dual coordinate descent on the hinge loss.

    The rarer class costs more, by the inverse of its share.
    """
    y = 2.0 * labels - 1
    share = labels.mean()
    cost = COST * np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    scaled = [r[x] for x in rows]
    norms = [1 / np.sqrt(v @ v) for v in scaled]
    scaled = [v * n for v, n in zip(scaled, norms)]
    w, alpha = np.zeros(WIDTH), np.zeros(len(rows))
    order = np.random.default_rng(SEED)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            x, v = rows[i], scaled[i]
            new = min(max(alpha[i] - (y[i] * (w[x] @ v) - 1), 0.0), cost[i])
            if new != alpha[i]:
                w[x] += (new - alpha[i]) * y[i] * v
                alpha[i] = new
    return w


def fit(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ratios, weights); with one class only, a bias that says so."""
    if len(set(labels.tolist())) < 2:
        w = np.zeros(WIDTH)
        w[-1] = 1.0 if not len(labels) or labels[0] == 1 else -1.0
        r = np.zeros(WIDTH)
        r[-1] = 1.0
        return r, w
    r = ratios(rows, labels)
    w = descend(rows, labels, r)
    used = w != 0
    mean = np.abs(w[used]).mean()
    return r, np.where(used, (1 - BLEND) * mean * np.sign(w) + BLEND * w, 0.0)


def margin(x: np.ndarray, r: np.ndarray, w: np.ndarray) -> float:
    v = r[x]
    return float(w[x] @ v / np.sqrt(v @ v)) if len(x) else 0.0


def held_out(doc_id: Column) -> Column:
    """Whether a row's label may not be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("bigint").cast("string")) % 3 == 1, F.lit(False))


def sample(labels: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """(id, label) of at most ``rows`` labelled rows that are not held out."""
    one = (
        labels.where("doc_id is not null and quality is not null")
        .where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("bigint").alias("id"))
        .agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    )
    one = stored(one, "labels")
    share = min(1.0, rows / max(1, one.count()))
    part = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    return one.where(part).orderBy(F.xxhash64("id"), "id").limit(rows)


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Fit in one task, on the bounded sample; the driver gets the weights."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t.as_py()).astype(np.int32) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(x, pa.list_(pa.int32()))],
                names=["id", "label", "x"],
            )

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("id", "ascending")])
        x = [v.values.to_numpy().astype(np.int64) for v in rows.column("x")]
        r, w = fit(x, rows.column("label").to_numpy().astype(np.int64))
        return pa.table({"r": [r.tolist()], "w": [w.tolist()]})

    chosen = stored(sample(labels), "sample")
    rows = texts(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))
    rows = rows.groupBy("id", "label").agg(F.min("text").alias("text"))
    x = stored(rows.mapInArrow(extract, "id bigint, label int, x array<int>"), "features")
    one = x.withColumn("one", F.lit(1)).groupBy("one")
    model = one.applyInArrow(run, "r array<double>, w array<double>").collect()
    if not model:
        return fit([], np.zeros(0))
    return np.array(model[0].r), np.array(model[0].w)


def _scorer(spark, r: np.ndarray, w: np.ndarray):
    """Score of a text; the model is sent to the workers once."""
    shared = spark.sparkContext.broadcast((r, w))

    def of(text: str) -> float:
        m = margin(features(text), *shared.value)
        return float(1 / (1 + np.exp(-np.clip(m, -700, 700))))

    return of


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted."""
    of = _scorer(docs.sparkSession, *train(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = [of(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(s, pa.float64())], names=["doc_id", "score"]
            )

    return texts(docs).mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def remove_rejected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are predicted good, with all their columns."""
    of = _scorer(docs.sparkSession, *train(docs, labels))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [of(t.as_py() or "") >= 0.5 for t in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
