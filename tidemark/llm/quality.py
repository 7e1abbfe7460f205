"""Quality scores from preference pairs: a Bradley-Terry ranking over features of the text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, numbered, text_or_empty
from tidemark.llm.labelled import labelled_sample

#: Labelled documents of each class that are fitted on, and preference pairs drawn from them.
PER_CLASS, PAIRS = 4_000, 40_000
#: Words in a stretch whose distinct words are counted.
STRETCH = 64
CUT = 0.7


def features(text: str) -> np.ndarray:
    """What the ranking sees of a text: shares of characters, and how it repeats itself."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n = max(1, len(data))
    counts = np.bincount(data, minlength=256)
    shares = np.sqrt(np.append(counts[:128], counts[128:].sum()) / n)
    words, lines = text.split(), text.split("\n")
    w = max(1, len(words))
    same = sum(map(str.__eq__, words, words[1:])) / w
    stretches = range(0, len(words), STRETCH)
    distinct = sum(len(set(words[i : i + STRETCH])) for i in stretches) / w
    upper, letters = counts[65:91].sum(), counts[65:91].sum() + counts[97:123].sum()
    marks = counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()
    extra = [same, np.sqrt(same), distinct, len(set(words)) / w, upper / max(1, letters), marks / n, np.sqrt(marks / n),
             counts[48:58].sum() / n, sum(map(len, words)) / w / 10, len(set(lines)) / len(lines), np.log1p(len(data)) / 10, np.log1p(len(data) / len(lines)) / 10]
    return np.concatenate([shares, extra])


@dataclass(frozen=True)
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    cut: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1; 0.7 where the ranking reaches its cut."""
        z = _standard(rows, self.mean, self.scale) @ self.weight - self.cut + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _standard(rows: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((rows - mean) / scale, -6, 6)


def fit(rows: np.ndarray, label: np.ndarray, pairs: int = PAIRS, steps: int = 300, penalty: float = 1e-4) -> Ranking | None:
    """Weights that put documents of label 1 above those of label 0; None unless both labels occur.

    Logistic loss on the difference of features over drawn pairs. The cut is the
    quantile of the scores that leaves as many below it as have label 0.
    """
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return None
    mean, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-3
    x = _standard(rows, mean, scale)
    draw = np.random.default_rng(7)
    better, worse = draw.choice(good, pairs), draw.choice(bad, pairs)
    difference = (x[better] - x[worse]).astype(np.float32)
    w, first, second = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for step in range(1, steps + 1):
        lost = 1 / (1 + np.exp(np.clip(difference @ w.astype(np.float32), -50, 50)))
        grad = penalty * w - difference.T @ lost.astype(np.float32) / pairs
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        w = w - 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    ordered = np.sort(x @ w)
    return Ranking(mean, scale, w, float((ordered[len(bad) - 1] + ordered[len(bad)]) / 2))


def feature_rows(docs: DataFrame, *others: str) -> DataFrame:
    """``docs`` (columns ``text`` and ``others``) with the features in place of the text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [features(t).tolist() for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(rows, pa.list_(pa.float64()))], [*others, "features"])

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in others)
    return map_batches(docs.select(*others, "text"), run, f"{kinds}, features array<double>")


def fit_ranking(docs: DataFrame, labels: DataFrame, allowed: Column, label: str = "quality", per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text") -> Ranking | None:
    """Fit on at most about ``per_class`` labelled documents of each class, whole texts; only their features reach the driver."""
    sample = labelled_sample(docs, labels, label, allowed, per_class, id_col, text_col)
    rows = sorted((r["doc_id"], r["label"], r["features"]) for r in feature_rows(sample.select("doc_id", "label", text_or_empty("text").alias("text")), "doc_id", "label").collect())
    return fit(np.array([r[2] for r in rows]), np.array([r[1] for r in rows])) if rows else None


def quality_scores(docs: DataFrame, ranking: Ranking | None, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a column ``score_col``; 0.5 for all if nothing could be fitted.

    Whole texts of any length are scored; a null text like an empty one. Rows and
    other columns stay as they are; a column of the same name is replaced; equal
    texts get equal scores, repeated rows stay and an empty table gives no rows.
    Nothing is shuffled.
    """
    text_col, docs = "c0", docs.select(F.col(text_col), *(c for c in docs.columns if c != score_col))
    names = docs.columns[1:]
    docs = docs.toDF(*(f"c{i}" for i in range(len(names) + 1)))
    plain = docs.columns[1:]
    rows = docs.select(*plain, text_or_empty(text_col).alias("__text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(len(plain)).to_pylist()
        scores = ranking.score(np.array([features(t) for t in texts])) if ranking and texts else np.full(len(texts), 0.5)
        return pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(plain))), pa.array(scores, pa.float64())], [*plain, "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return map_batches(rows, run, f"{kinds}, score double").toDF(*names, score_col)


def keep_good(docs: DataFrame, ranking: Ranking | None, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """``docs`` without those scored below ``cut``; all stay if nothing could be fitted."""
    if ranking is None:
        return docs
    names = docs.columns
    docs, text_col = numbered(docs, text_col)
    return quality_scores(docs, ranking, text_col).where(F.col("score") >= cut).drop("score").toDF(*names)
