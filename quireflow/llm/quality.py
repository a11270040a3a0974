"""Quality scores by naive Bayes support vectors.

Features of a text are the distinct n-grams that occur in it: words, and runs of one to three word
shapes (which kinds of characters a word holds, its size, whether it repeats the word before). They
are hashed to ``BITS`` bits. From labelled texts come each feature's log-count ratio between the
classes; the indicators scaled by these ratios, at unit length, go to a linear hinge-loss model fitted
by dual coordinate descent. A logistic curve fitted on the margins, with the classes weighted as they
occur among all labels, turns a margin into a score from 0 to 1.

The classifier is fitted on a bounded sample: ``PER_CLASS`` labelled rows of each class, spread by a
hash of the id. Class weights are counted over all labels, and every text is scored whole.

Edge cases: null and empty texts have no features and get the score of a zero margin; rows with null
or repeated ids each give a row; a label that repeats for an id counts once, an id with both labels
not at all; without labels of both classes every score is the share of label 1 (0.5 with no labels);
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

BITS = 18
#: Labelled rows of each class that the classifier is fitted on.
PER_CLASS = 2500
EPOCHS, COST = 20, 1.0

_KINDS = np.zeros(256, np.uint16)
_KINDS[97:123] = 1
_KINDS[65:91] = 2
_KINDS[48:58] = 4
_KINDS[128:] = 8
for _i, _c in enumerate((b".,;:", b"!?", b"#$%&*@", b"|<>{}[]\\^~`=_/", b"()\"'-+")):
    _KINDS[np.frombuffer(_c, np.uint8)] = 16 << _i


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # ratio x weight of each feature
    ratios: np.ndarray
    bias: float
    slope: float
    offset: float

    def scores(self, features: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        total, square = np.zeros(n), np.zeros(n)
        np.add.at(total, rows, self.weights[features])
        np.add.at(square, rows, self.ratios[features] ** 2)
        margin = total / np.sqrt(np.maximum(square, 1e-12)) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -40, 40)))


def features_of(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed n-grams of a batch's texts and their rows."""
    data, ends = common.bytes_of(part)
    found: list[np.ndarray] = []
    at = 0
    while at < len(data):  # a very long text is cut at spaces
        to = min(len(data), at + 4 * common.RUN_BYTES)
        if to < len(data):
            back = np.flatnonzero(common._SPACE[data[at:to]])
            to = at + int(back[-1]) + 1 if len(back) else to
        inner = ends[:-1][(ends[:-1] > at) & (ends[:-1] < to)] - at
        words, starts, stops, _ = common.words_of(data[at:to], np.append(0, inner), lower=False)
        docs = np.searchsorted(ends[:-1], starts + at, "right") - 1
        if len(words):
            kinds = np.bitwise_or.reduceat(np.where(common._SPACE[data[at:to]], 0, _KINDS[data[at:to]]), starts).astype(np.uint64)
            size = np.minimum(np.log2(stops - starts + 1), 7).astype(np.uint64)
            same = np.zeros(len(words), np.uint64)
            same[1:] = (words[1:] == words[:-1]) & (docs[1:] == docs[:-1])
            shape = common.mix(kinds << np.uint64(8) | size << np.uint64(1) | same)
            grams = [(words, docs), (shape, docs)]
            for width in (2, 3):
                grams.append(common.shingles(shape, docs, width))
            for salt, (values, rows) in enumerate(grams):
                hashed = common.mix(values + np.uint64(salt * 0x5851F42D)) >> np.uint64(64 - BITS)
                found.append(np.unique(rows.astype(np.uint64) << np.uint64(BITS) | hashed))
        at = to
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = np.unique(np.concatenate(found))
    return (both & np.uint64((1 << BITS) - 1)).astype(np.int64), (both >> np.uint64(BITS)).astype(np.int64)


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, costs: np.ndarray, seed: int = 1) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised hinge loss; rows are (features, values) at unit length."""
    w, bias = np.zeros(1 << BITS), 0.0
    alpha = np.zeros(len(rows))
    order = np.arange(len(rows))
    random = np.random.default_rng(seed)
    norms = np.array([v @ v + 1.0 for _, v in rows])
    for _ in range(EPOCHS):
        random.shuffle(order)
        moved = 0.0
        for i in order:
            f, v = rows[i]
            gradient = signs[i] * (w[f] @ v + bias) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), costs[i])
            if (step := (new - alpha[i]) * signs[i]) != 0.0:
                alpha[i] = new
                w[f] += step * v
                bias += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, bias


def platt(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through the margins, by Newton's method with a small ridge."""
    x = np.stack([margins, np.ones_like(margins)], 1)
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weights * (p - target)) + 1e-3 * beta
        curve = (x * (weights * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def fit(sample: list[tuple[np.ndarray, int]], share: float) -> Model:
    """A model of sampled (features, label); ``share`` of all labels are 1."""
    labels = np.array([y for _, y in sample], np.int64)
    if not len(sample) or labels.min() == labels.max():
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0, 0.0, float(np.log(share / (1 - share))))
    counts = np.ones((2, 1 << BITS))
    for f, y in sample:
        counts[y, f] += 1
    ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    ratios[(counts[0] == 1) & (counts[1] == 1)] = 0  # never seen
    rows = []
    for f, _ in sample:
        v = ratios[f]
        rows.append((f, v / max(np.sqrt(v @ v), 1e-6)))
    per_class = np.array([(labels == 0).mean(), (labels == 1).mean()])
    costs = COST * 0.5 / per_class[labels]
    # margins for the curve come from rows that a model has not seen
    fold, margins = np.arange(len(rows)) % 3, np.zeros(len(rows))
    for k in range(3):
        inside = np.flatnonzero(fold != k)
        w, b = dual_coordinate_descent([rows[i] for i in inside], 2.0 * labels[inside] - 1, costs[inside])
        for i in np.flatnonzero(fold == k):
            margins[i] = w[rows[i][0]] @ rows[i][1] + b
    slope, offset = platt(margins, labels, np.where(labels == 1, share / per_class[1], (1 - share) / per_class[0]))
    w, b = dual_coordinate_descent(rows, 2.0 * labels - 1, costs)
    return Model(w * ratios, ratios, b, max(slope, 0.0), offset)


def learn(docs: DataFrame, labels: DataFrame, train: Column, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS) -> Model:
    """Fit on the labelled rows of ``docs`` whose id meets ``train`` (a condition on the column ``doc_id``)."""
    known = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & train)
        .groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("other")).where("y = other")
    )
    # a bounded set of ids: TakeOrdered for each class
    key = F.xxhash64("doc_id")
    classes = [known.where(F.col("y") == y).orderBy(key, "doc_id").limit(per_class).select("doc_id", "y") for y in (0, 1)]
    total = {r[0]: r[1] for r in known.groupBy("y").count().collect()}
    chosen = docs.sparkSession.createDataFrame([tuple(r) for c in classes for r in c.collect()], "doc_id long, y int")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "doc_id")

    def work(part: pa.RecordBatch) -> Iterator[dict]:
        features, of = features_of(part)
        cuts = np.searchsorted(of, np.arange(part.num_rows + 1))
        yield {"doc_id": part.column("doc_id"), "y": part.column("y"), "features": [features[a:b].astype(np.int32).tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]}

    got = common.map_texts(rows.select("doc_id", "y", "text"), work, "doc_id long, y int, features binary").toArrow().to_pylist()
    got.sort(key=lambda r: (r["doc_id"], r["features"]))
    share = total.get(1, 0) / max(sum(total.values()), 1) if total else 0.5
    return fit([(np.frombuffer(r["features"], np.int32).astype(np.int64), r["y"]) for r in got], share)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id, score`` for every row, without a shuffle; ``keep`` names further columns to carry along."""
    weights, ratios = model.weights.astype(np.float32), model.ratios.astype(np.float32)
    small = Model(weights, ratios, model.bias, model.slope, model.offset)

    def work(part: pa.RecordBatch) -> Iterator[dict]:
        features, of = features_of(part)
        yield {**{c: part.column(c) for c in part.schema.names if c != "score"}, "score": small.scores(features, of, part.num_rows)}

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *[c for c in keep])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", score double"
    out = common.map_texts(rows, work, schema)
    return out if keep else out.drop("text").withColumnRenamed("doc_id", id_col)
