"""Quality by nearest neighbours: labelled latent-semantic vectors vote on every text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.splits import held_out
from corpusloom.llm.textbytes import mix, row_of, slices, span_hashes, word_bounds

LABELLED = 4_000
DIMENSIONS = 32
NEIGHBOURS = 15
THRESHOLD = 0.7
SHAPES = 512
WORDS = 512
LAGS = 16
_CLASS = np.full(256, 3, np.uint64)  # letters of other scripts and accents count as lower case
_CLASS[:128] = np.arange(128) + 10
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 3, 4, 5


def features(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Term weights of each text of a slice: square roots of relative frequencies, in three groups.

    Terms are shapes (three consecutive character classes: lower, upper, digit, each other ASCII character), words
    (lower-cased), both hashed, and repeats (a word that also stands k words before, k up to ``LAGS``).
    """
    rows = len(at) - 1
    out = np.zeros((rows, SHAPES + WORDS + LAGS), np.float32)
    lengths = np.diff(at)
    if len(data) > 2:
        kinds = _CLASS[data]
        shape = (mix((kinds[:-2] << np.uint64(16)) | (kinds[1:-1] << np.uint64(8)) | kinds[2:]) % np.uint64(SHAPES)).astype(np.int64)
        row = row_of(at)
        inside = row[:-2] == row[2:]
        counts = np.bincount(row[:-2][inside] * SHAPES + shape[inside], minlength=rows * SHAPES).reshape(rows, SHAPES)
        out[:, :SHAPES] = np.sqrt(counts / np.maximum(lengths - 2, 1)[:, None])
    lowered = np.where((data > 64) & (data < 91), data + np.uint8(32), data)
    starts, ends, firsts = word_bounds(lowered, at)
    if len(starts):
        words, row = span_hashes(lowered, starts, ends), row_of(firsts)
        n = np.maximum(np.diff(firsts), 1)[:, None]
        counts = np.bincount(row * WORDS + (words % np.uint64(WORDS)).astype(np.int64), minlength=rows * WORDS)
        out[:, SHAPES : SHAPES + WORDS] = 0.5 * np.sqrt(counts.reshape(rows, WORDS) / n)
        for lag in range(1, min(LAGS, len(words) - 1) + 1):
            again = (words[lag:] == words[:-lag]) & (row[lag:] == row[:-lag])
            out[:, SHAPES + WORDS + lag - 1] = np.sqrt(np.bincount(row[lag:][again], minlength=rows) / n[:, 0])
    return out


@dataclass
class NeighbourModel:
    """A projection into latent dimensions and the labelled unit vectors there; its size is bounded by the fit."""

    mean: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def embed(self, weights: np.ndarray) -> np.ndarray:
        latent = (weights - self.mean) @ self.projection
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)

    def score(self, weights: np.ndarray, neighbours: int) -> np.ndarray:
        """Mean label of the nearest neighbours, weighted by cosine similarity; the mean of all if none is similar."""
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        k = min(neighbours, len(self.labels))
        if not k:
            return np.full(len(weights), prior)
        near = self.embed(weights) @ self.vectors.T
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(near, best, 1), 0).astype(np.float64) ** 4
        total = weight.sum(1)
        voted = (weight * self.labels[best]).sum(1) / np.maximum(total, 1e-300)
        return np.clip(np.where(total > 0, voted, prior), 0.0, 1.0)


def fit(texts: list[str], labels: list[int], dimensions: int = DIMENSIONS) -> NeighbourModel:
    """Latent dimensions are the leading singular vectors of the centred term weights."""
    column = pa.array(texts, pa.large_string())
    weights = np.concatenate([np.zeros((0, SHAPES + WORDS + LAGS), np.float32), *(features(d, at) for _, _, d, at in slices(column, 1 << 19))])
    mean = weights.mean(0) if len(texts) else np.zeros(weights.shape[1], np.float32)
    centred = (weights - mean).astype(np.float64)
    _, vectors = np.linalg.eigh(centred.T @ centred)
    model = NeighbourModel(mean, vectors[:, ::-1][:, :dimensions].astype(np.float32), np.zeros((0, dimensions)), np.array(labels, np.float64))
    model.vectors = model.embed(weights).astype(np.float32)
    return model


def learn(
    docs: DataFrame,
    labels: DataFrame,
    labelled: int = LABELLED,
    dimensions: int = DIMENSIONS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> NeighbourModel:
    """Fit on about ``labelled`` labelled texts, those of the smallest text hashes; equal texts count once.

    Rows without text, id or label are left out, as are all held-out rows.  Of several labels of a text the smallest
    counts.  Only this bounded sample reaches the driver; its limit comes from the number of labelled rows.
    """
    marked = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    marked = marked.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marked = marked.groupBy("doc_id").agg(F.min("label").alias("label"))
    share = min(1.0, labelled / max(1, marked.count()))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(text_col).alias("h"))
    texts = texts.where(F.col("text").isNotNull() & (F.pmod("h", F.lit(1 << 32)) / float(1 << 32) < share))
    rows = texts.join(marked, "doc_id").groupBy("text").agg(F.min("h").alias("h"), F.min("label").alias("label"))
    found = sorted((r["h"], r["text"], r["label"]) for r in rows.toLocalIterator())
    return fit([t for _, t, _ in found], [int(x > 0) for _, _, x in found], dimensions)


def classify(
    docs: DataFrame,
    model: NeighbourModel,
    neighbours: int = NEIGHBOURS,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, score, predicted`` of every whole text: exact cosine products of blocks of texts with all labelled
    vectors, and the vote of the nearest ``neighbours``, each weighted by the fourth power of its similarity.

    The model is sent with the job; its size depends on the fit's bounds only.  Equal similarities at the border of the
    neighbours are resolved the same way on every run.

    Defined cases: null and empty texts are scored as an empty text; repeated rows are kept; without any labelled row
    the score is 0.5; no rows give no rows.
    """

    def run(batches):
        for batch in batches:
            for row, end, data, at in slices(batch.column(1), 1 << 20):
                score = model.score(features(data, at), neighbours)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                    names=["doc_id", "score", "predicted"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def keep_good(
    docs: DataFrame, model: NeighbourModel, neighbours: int = NEIGHBOURS, threshold: float = THRESHOLD, text_col: str = "text"
) -> DataFrame:
    """The documents whose score reaches ``threshold``, with all their columns; one pass, nothing is shuffled."""
    at_column = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            good = [model.score(features(data, at), neighbours) >= threshold for _, _, data, at in slices(batch.column(at_column), 1 << 20)]
            if good:
                yield batch.filter(pa.array(np.concatenate(good)))

    return docs.mapInArrow(run, docs.schema)


def classify_held_out(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out and score all; adds ``held_out``."""
    found = classify(docs, learn(docs, labels))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
