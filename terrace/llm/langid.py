"""Language identification: sparse multinomial logistic regression on TF-IDF n-grams.

Features are hashed character n-grams of one to three characters, weighted by the
logarithm of their count and by inverse document frequency, at unit length. Document
frequencies are counted over all training documents, in tasks that each send one row a
feature. The weights are fitted with FTRL-proximal (follow the regularised leader with L1
and L2 penalties) on a bounded sample of training rows, as many of each language; a part
of the sample that the fit does not see sets the temperature that calibrates the scores.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import fold, slices
from terrace.llm.grams import codes, hashed

ORDERS, BITS = (1, 2, 3), 14
#: Most training rows that the fit sees, all languages together.
SAMPLE_ROWS = 4000
UNKNOWN = "und"


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features and their counts."""
    found = np.bincount(hashed(codes(text), ORDERS, BITS), minlength=1 << BITS)
    index = np.flatnonzero(found)
    return index, found[index]


def weighted(index: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(count)) * idf[index]
    return x / (np.sqrt(x @ x) or 1.0)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Ftrl:
    """FTRL-proximal state of a multinomial logistic regression with elastic-net penalty."""

    features: int
    classes: int
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.001

    def __post_init__(self) -> None:
        self.z = np.zeros((self.features, self.classes))
        self.n = np.zeros((self.features, self.classes))

    def weights(self, index: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[index], self.n[index]
        step = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / step)

    def update(self, index: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(index)
        error = softmax(x @ w)
        error[label] -= 1
        g = x[:, None] * error[None, :]
        n = self.n[index]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[index] += g - sigma * w
        self.n[index] = n + g * g


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The one, of a fine grid, that gives the held-out labels the greatest likelihood."""
    if not len(labels):
        return 1.0
    rows = np.arange(len(labels))

    def loss(t: float) -> float:
        return -np.log(np.maximum(softmax(logits / t)[rows, labels], 1e-12)).mean()

    return float(min(np.geomspace(0.02, 20, 121), key=loss))


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        index, count = counts(text)
        p = softmax(weighted(index, count, self.idf) @ self.weights[index] / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Number of documents, and of documents with each feature, over all rows of ``text``."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(1 << BITS, np.int64), 0
        for batch in slices(batches, 512):
            for text in batch.column(0).to_pylist():
                total[np.unique(hashed(codes(text or ""), ORDERS, BITS))] += 1
                n += 1
        index = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(index, -1), pa.int64()),
                pa.array(np.append(total[index], n), pa.int64()),
            ],
            names=["feature", "n"],
        )

    rows = texts.mapInArrow(count, "feature bigint, n bigint").groupBy("feature").agg(F.sum("n"))
    found = dict(map(tuple, rows.collect()))  # one row a feature, 2**BITS at most
    n = found.pop(-1, 0)
    df = np.zeros(1 << BITS)
    df[list(found)] = list(found.values())
    return n, df


def sampled(training: DataFrame, label: str, rows: int, seed: int = 7) -> DataFrame:
    """``label``, ``text`` and ``draw`` of about as many rows of every class, ``rows`` in all at most.

    The draw is a hash of id and text, so the sample does not depend on the order of rows.
    Rows are thinned out by the counts of their class first, so that the exact choice is
    made among about twice the rows that it keeps.
    """
    drawn = training.select(
        label, "text", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 40)).alias("draw")
    )
    sizes = training.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
    each = max(1, rows // max(1, len(sizes)))
    chosen = F.lit(False)
    for row in sizes:
        rate = min(1.0, 2 * each / row["n"] + 30 / row["n"])
        chosen = chosen | ((F.col(label) == row[label]) & (F.col("draw") < int(rate * (1 << 40))))
    order = Window.partitionBy(label).orderBy("draw", F.xxhash64("text"))
    kept = drawn.filter(chosen).withColumn("place", F.row_number().over(order))
    return kept.filter(F.col("place") <= each).drop("place")


def fit(
    training: DataFrame, sample_rows: int = SAMPLE_ROWS, passes: int = 3, seed: int = 7
) -> LanguageModel:
    """The model of ``doc_id``, ``text`` and ``lang`` (none null)."""
    n, df = document_frequencies(training.select("text"))
    idf = np.log((1 + n) / (1 + df)) + 1
    schema = "lang string, draw bigint, features array<int>, counts array<int>"

    def featurise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            found = [counts(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([f for f, _ in found], pa.list_(pa.int32())),
                    pa.array([c for _, c in found], pa.list_(pa.int32())),
                ],
                names=["lang", "draw", "features", "counts"],
            )

    sample = sampled(training, "lang", sample_rows, seed).select("lang", "text", "draw")
    rows = sample.mapInArrow(featurise, schema).toArrow()  # at most sample_rows
    labels = rows.column("lang").to_pylist()
    if not labels:
        return LanguageModel([], idf, np.zeros((1 << BITS, 0)), 1.0)
    order = sorted(range(len(labels)), key=lambda i: (rows["draw"][i].as_py(), labels[i]))
    languages = sorted(set(labels))
    place = {lang: i for i, lang in enumerate(languages)}
    data = []
    for i in order:
        index = rows["features"][i].values.to_numpy().astype(np.int64)
        data.append((index, weighted(index, rows["counts"][i].values.to_numpy(), idf), place[labels[i]]))
    held = data[::5] if len(data) >= 10 else []
    taught = [d for i, d in enumerate(data) if i % 5] if held else data
    state = Ftrl(1 << BITS, len(languages))
    for _ in range(passes):
        for index, x, y in taught:
            state.update(index, x, y)
    weights = state.weights()
    logits = np.array([x @ weights[index] for index, x, _ in held]).reshape(-1, len(languages))
    scale = temperature(logits, np.array([y for _, _, y in held], int))
    return LanguageModel(languages, idf, weights, scale)


def identified(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, folds: int = 5) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row.

    The model learns from the rows outside fold 0 whose text and language are not null.
    Texts that are null or have no letter are ``und`` with score 0, and so are all texts
    if there is nothing to learn from. With one language only, it is predicted with
    score 1. Repeated rows each have a row; an empty table gives an empty result; other
    columns are ignored.
    """
    held_out = fold("doc_id", folds) == 0
    training = docs.filter(~held_out & F.col("lang").isNotNull() & F.col("text").isNotNull())
    model = fit(training.select("doc_id", "text", "lang"), sample_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("held_out", T.BooleanType()),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 512):
            found = [shared.value.predict(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                names=schema.names,
            )

    return docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(predict, schema)
