"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

Features are the hashed character n-grams of a text, present or not. Over the labelled
training documents every feature is counted by class, in tasks that each send one row a
feature. The logarithm of the ratio of its smoothed shares in toxic and other documents
scales the feature; one that few documents have, or that both classes have alike, is left
out. A text's features are brought to unit length, so that a long text has no more say than
a short one. On a bounded sample of training rows, as many of either class, a logistic
regression is fitted. Where a part of the training documents is told apart best by a model of
the others is the score of 0.5 of the model of all.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import fold, slices, stored
from terrace.llm.grams import codes, hashed
from terrace.llm.langid import sampled

ORDERS, BITS = (4, 6, 8), 20
#: Most labelled rows that the regression sees, both classes together, and most that the
#: threshold is chosen by. Counts see all rows. A row has 2**BITS features at most.
SAMPLE_ROWS = 4000
#: Documents a feature must have, and the least log-count ratio, up or down.
LEAST_DOCS, LEAST_RATIO = 5, 1.0
#: Labelled texts that a task counts at least; each sends a row a feature that they have.
COUNTED_ROWS = 20_000
#: What a share of other documents taken for toxic weighs against one of toxic ones missed.
ALARM = 5.0


def present(text: str | None, scratch: np.ndarray | None = None) -> np.ndarray:
    """The features of the text, each once, in no order."""
    found = hashed(codes(text or ""), ORDERS, BITS)
    if scratch is None:
        return np.unique(found)
    places = np.arange(len(found), dtype=scratch.dtype)
    scratch[found] = places  # the last place of each feature stays
    return found[scratch[found] == places]


def _scratch() -> np.ndarray:
    return np.zeros(1 << BITS, np.int64)


def unit(index: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features that have a ratio, and their values in a text of unit length."""
    x = ratios[index]
    kept = x != 0
    x = x[kept]
    return index[kept], x / max(float(np.sqrt(x @ x)), 1e-9)


@dataclass
class ToxicityModel:
    #: Log-count ratio of every feature, 0 where it is left out, and its weight.
    ratios: np.ndarray
    weights: np.ndarray
    intercept: float

    def margin(self, index: np.ndarray) -> float:
        index, x = unit(index, self.ratios)
        return float(self.weights[index] @ x) + self.intercept

    def score(self, text: str | None, scratch: np.ndarray | None = None) -> float:
        z = self.margin(present(text, scratch))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def class_counts(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Documents with each feature (rows: other, toxic), and documents, by class.

    ``labelled`` has ``text`` and ``toxic``, 0 or 1.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, scratch = np.zeros((2, 1 << BITS), np.int64), [0, 0], _scratch()
        for batch in slices(batches, 512):
            for text, toxic in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
            ):
                total[toxic][present(text, scratch)] += 1
                n[toxic] += 1
        index = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(index, -1), pa.int32()),
                pa.array(np.append(total[0][index], n[0]), pa.int32()),
                pa.array(np.append(total[1][index], n[1]), pa.int32()),
            ],
            names=["feature", "other", "toxic"],
        )

    rows = (
        labelled.select("text", "toxic")
        .mapInArrow(count, "feature int, other int, toxic int")
        .groupBy("feature")
        .agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
        .toArrow()  # one row a feature, 2**BITS + 1 at most
    )
    feature = rows["feature"].to_numpy()
    both = np.stack([rows["other"].to_numpy(), rows["toxic"].to_numpy()]).astype(np.int64)
    counts = np.zeros((2, 1 << BITS))
    counts[:, feature[feature >= 0]] = both[:, feature >= 0]
    return counts, both[:, feature < 0].sum(axis=1)


def log_ratios(
    counts: np.ndarray, documents: np.ndarray, smooth: float = 1.0,
    least_docs: int = LEAST_DOCS, least: float = LEAST_RATIO,
) -> np.ndarray:
    p = (counts + smooth) / (documents[:, None] + 2 * smooth)
    ratios = np.log(p[1] / p[0])
    return np.where((counts.sum(axis=0) >= least_docs) & (np.abs(ratios) >= least), ratios, 0.0)


def regress(
    rows: list[tuple[np.ndarray, int]], ratios: np.ndarray, passes: int = 8, rate: float = 0.1,
    l2: float = 1e-3,
) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression, by AdaGrad steps from row to row."""
    w, b = np.full(len(ratios), 1e-3), 0.0
    seen, seen_b = np.full(len(ratios), 1e-2), 1e-2
    made = [(*unit(index, ratios), label) for index, label in rows]
    for _ in range(passes):
        for index, x, label in made:
            own = w[index]
            error = 1 / (1 + np.exp(-np.clip(own @ x + b, -500, 500))) - label
            g = error * x + l2 * own
            seen[index] += g * g
            w[index] = own - rate * g / np.sqrt(seen[index])
            seen_b += error * error
            b -= rate * error / np.sqrt(seen_b)
    return w, b


def threshold(margins: np.ndarray, labels: np.ndarray, alarm: float = ALARM) -> float:
    """The margin that tells the classes apart best: the middle of the best gap.

    The cost is the share of toxic documents below it, and ``alarm`` times that of others
    not below. Without documents of both classes it is 0.
    """
    toxic = int(labels.sum())
    other = len(labels) - toxic
    if not toxic or not other:
        return 0.0
    order = np.argsort(margins, kind="stable")
    z, y = margins[order], labels[order]
    missed = np.append(0, np.cumsum(y)) / toxic
    alarms = 1 - np.append(0, np.cumsum(1 - y)) / other
    cost = missed + alarm * alarms
    # A cut between equal margins is none.
    cost[1:-1][z[1:] == z[:-1]] = np.inf
    at = np.flatnonzero(cost == cost.min())
    ends = np.concatenate([[z[0] - 1], z, [z[-1] + 1]])
    widest = at[np.argmax(ends[at + 1] - ends[at])]
    return float((ends[widest] + ends[widest + 1]) / 2)


def _features(
    labelled: DataFrame, ratios: np.ndarray, sample_rows: int, seed: int
) -> list[tuple[np.ndarray, int]]:
    """Features that have a ratio and label of a bounded sample, in an order of its own."""
    kept = labelled.sparkSession.sparkContext.broadcast(ratios != 0)

    def featurise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            found = [f[kept.value[f]] for f in map(present, batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.int32()))],
                names=["toxic", "draw", "features"],
            )

    sample = sampled(labelled, "toxic", sample_rows, seed).select("toxic", "text", "draw")
    table = sample.mapInArrow(featurise, "toxic int, draw bigint, features array<int>").toArrow()
    labels, draws = table["toxic"].to_pylist(), table["draw"].to_pylist()
    order = sorted(range(len(labels)), key=lambda i: (draws[i], labels[i]))
    return [(table["features"][i].values.to_numpy(), labels[i]) for i in order]


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 11) -> ToxicityModel:
    """The model of ``doc_id``, ``text``, ``toxic`` (0 or 1) and ``aside``, none of them null.

    Rows that are ``aside`` choose the threshold, by a model that has not seen them; then a
    model of all rows takes it over.
    """
    learnt, aside = labelled.filter("not aside"), labelled.filter("aside")
    (counts, documents), (more, further) = class_counts(learnt), class_counts(aside)
    nothing = np.zeros(1 << BITS)
    every = documents + further
    if not every.all():
        return ToxicityModel(nothing, nothing, 50.0 if every[1] else -50.0)
    cut = 0.0
    if documents.all():
        first = _fitted(learnt, counts, documents, sample_rows, seed)
        held = _features(aside, first.ratios, sample_rows, seed)
        margins = np.array([first.margin(index) for index, _ in held])
        cut = threshold(margins, np.array([label for _, label in held], np.int64))
    model = _fitted(labelled, counts + more, every, sample_rows, seed)
    return ToxicityModel(model.ratios, model.weights, model.intercept - cut)


def _fitted(
    labelled: DataFrame, counts: np.ndarray, documents: np.ndarray, sample_rows: int, seed: int
) -> ToxicityModel:
    ratios = log_ratios(counts, documents)
    return ToxicityModel(ratios, *regress(_features(labelled, ratios, sample_rows, seed), ratios))


def scored(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, folds: int = 5
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (0 or 1) of every row.

    The model learns from labelled rows outside fold 0, and its threshold from fold 1; labels that are null are none, and
    of repeated ones the greatest counts. Null and empty texts have the features of a
    blank, so they score like a text that says nothing. If only one class is labelled it
    is predicted for all; without labels it is 0. Repeated rows each have a row; an empty
    table gives an empty result; other columns are ignored.
    """
    held_out = fold("doc_id", folds) == 0
    marks = (
        labels.filter("doc_id is not null and toxic is not null")
        .filter(fold("doc_id", folds) != 0)
        .groupBy("doc_id")
        .agg(F.when(F.max("toxic") > 0, 1).otherwise(0).alias("toxic"))
    )
    learnt = docs.filter(~held_out).select("doc_id", "text").join(
        marks.hint("shuffle_hash"), "doc_id"
    ).withColumn("aside", fold("doc_id", folds) == 1)
    # Read several times: for the counts, the sizes of the classes and the samples.
    parts = 2 + marks.count() // COUNTED_ROWS
    model = fit(stored(learnt, "labelled_texts").coalesce(parts), sample_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("held_out", T.BooleanType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
        ]
    )

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scratch = _scratch()
        for batch in slices(batches, 512):
            scores = np.array(
                [shared.value.score(t, scratch) for t in batch.column(2).to_pylist()], float
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(scores, pa.float64()),
                    pa.array((scores >= 0.5).astype(np.int32), pa.int32()),
                ],
                names=schema.names,
            )

    return docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(predict, schema)
