"""Document quality by supervised subword embeddings: hashed vectors averaged per text, softmax on top, numpy SGD."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.grams import subword_counts
from sediment.llm.sampling import bounded_sample

BITS = 12
WIDTH = 16
SAMPLE_ROWS = 3000  # over both labels; the only bound on what the model is fitted to
ACCEPT = 0.7


@dataclass
class QualityModel:
    """Vectors of the hashed words and n-grams, and the output layer over their average."""

    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, epochs: int = 30, batch: int = 32, rate: float = 1.0, seed: int = 7) -> QualityModel:
        """Stochastic gradient descent on cross entropy; rows of x are shares of features, both labels weigh alike."""
        rng = np.random.default_rng(seed)
        e = rng.normal(0, 0.1, (1 << BITS, WIDTH)).astype(np.float32)
        w = rng.normal(0, 0.1, (WIDTH, 2)).astype(np.float32)
        b = np.zeros(2, dtype=np.float32)
        weight = np.array([0.5 / max((y == k).mean(), 1e-9) for k in (0, 1)], dtype=np.float32) if len(y) else None
        steps, done = epochs * -(-len(y) // batch), 0
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for at in range(0, len(y), batch):
                rows = order[at : at + batch]
                now = rate * (1 - done / steps)
                done += 1
                xb = x[rows]
                hidden = xb @ e
                z = hidden @ w + b
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(len(rows)), y[rows]] -= 1
                p *= weight[y[rows]][:, None] / len(rows)
                back = p @ w.T
                w -= now * (hidden.T @ p)
                b -= now * p.sum(axis=0)
                e -= (now * 30) * (xb.T @ back)
        return cls(e, w, b)

    def score(self, counts: np.ndarray) -> float:
        """Likeliness of label 1; a text without features is scored by the bias alone."""
        total = counts.sum()
        hidden = (counts.astype(np.float32) / total) @ self.vectors if total else np.zeros(WIDTH, dtype=np.float32)
        z = hidden @ self.output + self.bias
        return float(1.0 / (1.0 + np.exp(np.clip(float(z[0] - z[1]), -60, 60))))


def shares(counts: np.ndarray) -> np.ndarray:
    return (counts / max(counts.sum(), 1)).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Fit to a bounded sample of labelled documents, as many of either label as there are.

    ``docs`` has doc_id and text, ``labels`` doc_id and quality; ``may_learn`` looks at doc_id. Labels other than 0 and 1 are left out; an id that
    was labelled both ways counts for both.
    """

    @F.arrow_udf("binary")
    def sparse(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts:
            counts = subword_counts(t.as_py() or "", BITS)
            at = np.flatnonzero(counts)
            out.append(at.astype("<u2").tobytes() + shares(counts)[at].astype("<f4").tobytes())
        return pa.array(out, pa.binary())

    keys = labels.where(may_learn & F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int"))
    rows = bounded_sample(keys, docs, sample_rows)
    sample = sorted(rows.select("label", sparse(F.col("text")).alias("v")).collect(), key=lambda r: (r.label, bytes(r.v)))
    x = np.zeros((len(sample), 1 << BITS), dtype=np.float32)
    for row, r in zip(x, sample, strict=True):
        n = len(r.v) // 6
        row[np.frombuffer(r.v, "<u2", n)] = np.frombuffer(r.v, "<f4", n, offset=2 * n)
    return QualityModel.fit(x, np.array([r.label for r in sample], dtype=np.int64))


def quality_score(text: Column, model: QualityModel) -> Column:
    """Score of each whole text, null as empty. Only the text is looked at."""

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([model.score(subword_counts(t.as_py() or "", BITS)) for t in batch], pa.float64())

    return score.asNondeterministic()(text)  # keeps a filter on the result from running it again
