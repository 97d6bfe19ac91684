"""Hierarchical language identification: the family first, then one-versus-one linear SVMs within it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.grams import letter_grams
from sediment.llm.sampling import bounded_sample

BITS = 12
UNDETERMINED = "und"
SAMPLE_ROWS = 2000  # over all languages; the only bound on what the model is fitted to
RESULT = "lang_pred string, score double"

# Families of languages. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
}


def family_of(lang: str) -> str:
    return next((name for name, members in FAMILIES.items() if lang in members), lang)


def linear_svm(x: np.ndarray, y: np.ndarray, c: float = 30.0, rounds: int = 200) -> np.ndarray:
    """Weights and, last, the bias of a linear SVM with squared hinge loss; y is +1 or -1, classes weigh alike.

    Full-batch accelerated gradient descent on unit rows with a constant feature: no randomness.
    """
    x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w = v = np.zeros(x.shape[1], dtype=np.float32)
    step = 1.0 / (4 * c + 1)
    for k in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ v))
        after = v - step * (v - 2 * c * (x.T @ (weight * y * slack)))
        v = after + k / (k + 3) * (after - w)
        w = after
    return w


@dataclass
class LanguageModel:
    """Family detectors (one against the rest) and, by family, a detector for each two of its languages."""

    families: list[str]
    family_weights: np.ndarray
    members: list[list[str]]
    pair_weights: list[list[np.ndarray]]

    @classmethod
    def fit(cls, x: np.ndarray, langs: list[str]) -> LanguageModel:
        names = np.array(langs)
        of = np.array([family_of(n) for n in langs])
        families = sorted(set(of.tolist()))
        width = x.shape[1] + 1 if len(langs) else 1
        ways = [linear_svm(x, np.where(of == f, 1, -1).astype(np.float32)) for f in families] if len(families) > 1 else [np.zeros(width)]
        members = [sorted(set(names[of == f].tolist())) for f in families]
        pairs = []
        for langs_in in members:
            fits = []
            for a, b in combinations(langs_in, 2):
                rows = (names == a) | (names == b)
                fits.append(linear_svm(x[rows], np.where(names[rows] == a, 1, -1).astype(np.float32)))
            pairs.append(fits)
        return cls(families, np.array(ways, dtype=np.float32), members, pairs)

    def predict(self, vector: np.ndarray | None) -> tuple[str, float]:
        """Language and likeliness: of the family times that of the language in it."""
        if vector is None or not self.families:
            return UNDETERMINED, 0.0
        x = np.append(vector, np.float32(1))
        share = [1.0]
        if len(self.families) > 1:
            z = 4.0 * (self.family_weights @ x)
            e = np.exp(z - z.max())
            share = (e / e.sum()).tolist()
        f = int(np.argmax(share))
        langs = self.members[f]
        if len(langs) == 1:
            return langs[0], float(share[f])
        votes = dict.fromkeys(langs, 0.0)
        for (a, b), w in zip(combinations(langs, 2), self.pair_weights[f], strict=True):
            p = 1.0 / (1.0 + np.exp(-4.0 * float(w @ x)))
            votes[a] += p
            votes[b] += 1 - p
        lang = max(langs, key=lambda n: (votes[n], n))
        return lang, float(share[f] * votes[lang] / (len(langs) - 1))


def fit(docs: DataFrame, may_learn: Column, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Fit to a bounded sample of the rows that may be learned from: those with a language and a letter in the text.

    ``docs`` has doc_id, text and lang. The sample is spread evenly over languages and does not depend on layout.
    """

    @F.arrow_udf("binary")
    def vectors(texts: pa.Array) -> pa.Array:
        found = (letter_grams(t.as_py() or "", BITS) for t in texts)
        return pa.array([None if v is None else v.astype(np.float16).tobytes() for v in found], pa.binary())

    keys = docs.where(may_learn & F.col("lang").isNotNull()).select("doc_id", "lang")
    rows = bounded_sample(keys, docs, sample_rows)
    sample = [r for r in rows.select("label", vectors(F.col("text")).alias("v")).collect() if r.v is not None]
    sample.sort(key=lambda r: (r.label, bytes(r.v)))
    x = np.array([np.frombuffer(r.v, dtype=np.float16) for r in sample], dtype=np.float32).reshape(len(sample), 1 << BITS)
    return LanguageModel.fit(x, [r.label for r in sample])


def identify(text: Column, model: LanguageModel) -> Column:
    """struct(lang_pred, score) of a text: ``und`` and 0 if it is null or has no letter. Only the text is looked at."""

    @F.arrow_udf(RESULT)
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = [model.predict(letter_grams(t.as_py() or "", BITS)) for t in batch]
            langs, scores = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())
            yield pa.StructArray.from_arrays([langs, scores], ["lang_pred", "score"])

    return predict.asNondeterministic()(text)  # keeps a filter on the result from running it again
