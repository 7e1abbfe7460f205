"""Toxicity scores from embeddings of subwords, averaged over windows of words into a linear softmax.

Two departures from a plain average over a text with all subwords trained: a
text counts as its worst window of words, as a single sentence makes a long
text toxic; and only subwords that are clearly more frequent in toxic texts get
an embedding, as the few labelled texts would teach the others by heart.
"""

from __future__ import annotations

import uuid
from array import array
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, text_or_empty
from tidemark.llm.labelled import labelled_sample

#: Labelled documents of each class that are fitted on, and the longest text among them.
PER_CLASS, LONGEST = 2_000, 10_000
#: Embeddings of character n-grams share this many rows of this width.
BUCKETS, WIDTH = 1 << 19, 16
GRAMS = (3, 4, 5)
#: An embedding is trained for buckets this many deviations and this many times more frequent in toxic texts.
CLEAR, TIMES = 4.0, 3.0
#: Words whose embeddings are averaged; a text is as toxic as its worst window.
WINDOW = 24
#: Word scores kept by a Python worker; beyond that they are computed again.
KEPT = 500_000
#: What separates words, in the syntax of Java; ``str.split`` takes the same characters.
BLANKS = r"[\x09-\x0D\x1C-\x20\x85\p{Z}]+"
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def words_of(text: str) -> list[str]:
    return text.lower().split()


def subwords(word: str) -> set[int]:
    """Buckets of the whole word and of its n-grams of bytes, without marks at its edges."""
    marked = b"<%b>" % word.strip(EDGES).encode("utf-8", "surrogatepass")
    found = {crc32(marked) % BUCKETS}
    for k in GRAMS:
        found.update([crc32(marked[i : i + k]) % BUCKETS for i in range(len(marked) - k + 1)])
    return found


@dataclass(frozen=True)
class Detector:
    #: What a bucket adds to the logit: its embedding times the difference of the two softmax rows; 0 for all others.
    buckets: dict[int, float]
    bias: float

    def word(self, word: str) -> float:
        found = subwords(word)
        return sum(self.buckets.get(b, 0.0) for b in found) / len(found)

    def scores(self, lists: pa.ListArray, known: dict[str, float]) -> np.ndarray:
        """Between 0 and 1 for each list of words: the softmax of the worst window; the bias alone decides where there is no word."""
        coded = lists.flatten().dictionary_encode()
        if len(known) > KEPT:
            known.clear()
        each = np.empty(len(coded.dictionary))
        for i, w in enumerate(coded.dictionary.to_pylist()):
            if (v := known.get(w)) is None:
                v = known[w] = self.word(w)
            each[i] = v
        size = lists.value_lengths().to_numpy()
        logit = np.full(len(size), self.bias)
        if size.sum():
            values, end, some = each[coded.indices.to_numpy()], np.cumsum(size), size > 0
            windows = -(-size // WINDOW)
            first = np.cumsum(windows) - windows
            start = np.repeat(end - size, windows) + WINDOW * (np.arange(windows.sum()) - np.repeat(first, windows))
            mean = np.add.reduceat(values, start) / np.minimum(WINDOW, np.repeat(end, windows) - start)
            logit[some] += np.maximum.reduceat(mean, first[some])
        return _sigmoid(logit)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _telling(docs: list[np.ndarray], subs: np.ndarray, sub_end: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Buckets that clearly more toxic than clean texts have; rarer ones would only be learned by heart."""
    counts = np.zeros((2, BUCKETS))
    for words, y in zip(docs, label):
        counts[y, np.unique(np.concatenate([subs[sub_end[i] : sub_end[i + 1]] for i in np.unique(words).tolist()]))] += 1
    n = np.bincount(label, minlength=2)[:, None]
    rate = (counts + 0.5) / (n + 1)
    both = counts.sum(axis=0) / n.sum()
    deviation = (rate[1] - rate[0]) / np.sqrt(both * (1 - both) * (1 / n).sum() + 1e-9)
    return np.flatnonzero((counts[1] >= 3) & (deviation >= CLEAR) & (rate[1] >= TIMES * rate[0]))


def fit(texts: list[str], label: np.ndarray, steps: int = 300, rate: float = 0.1, decay: float = 1e-4) -> Detector | None:
    """Train embeddings and softmax jointly; None unless both labels occur.

    Only telling buckets get an embedding, the others stay zero. A text counts as
    its worst window. With two classes only the difference of the softmax rows
    matters, so the gradient of an embedding is that row times one number.
    """
    if len(set(label.tolist())) < 2:
        return None
    number: dict[str, int] = {}
    docs = [np.fromiter((number.setdefault(w, len(number)) for w in words_of(t) or [""]), np.int32) for t in texts]
    flat, sizes = array("i"), array("i")
    for word in number:
        found = subwords(word)
        flat.extend(found)
        sizes.append(len(found))
    subs, n_subs = np.frombuffer(flat, np.int32), np.frombuffer(sizes, np.int32)
    telling = _telling(docs, subs, np.concatenate([[0], np.cumsum(n_subs)]), label)
    # What words hold of the telling buckets, as (word, column) pairs.
    held = np.isin(subs, telling)
    owner = np.repeat(np.arange(len(n_subs), dtype=np.int32), n_subs)[held]
    column = np.searchsorted(telling, subs[held])
    share_of = 1 / n_subs[owner]

    ids = np.concatenate(docs)
    window_size = np.concatenate([np.minimum(WINDOW, len(d) - np.arange(0, len(d), WINDOW)) for d in docs])
    window_start = np.concatenate([[0], np.cumsum(window_size)[:-1]])
    doc_windows = np.array([-(-len(d) // WINDOW) for d in docs])
    doc_start = np.concatenate([[0], np.cumsum(doc_windows)[:-1]])
    doc_of_window = np.repeat(np.arange(len(docs)), doc_windows)
    window_of_word = np.repeat(np.arange(len(window_size)), window_size)

    draw = np.random.default_rng(11)
    table, row, bias = draw.normal(0, 0.1, (len(telling), WIDTH)), draw.normal(0, 0.5, WIDTH), -1.0
    moments = [[np.zeros_like(table), np.zeros_like(table)], [np.zeros_like(row), np.zeros_like(row)], [0.0, 0.0]]
    class_weight = np.where(label == 1, 0.5 / label.mean(), 0.5 / (1 - label.mean()))
    for step in range(1, steps + 1):
        word = np.bincount(owner, (table @ row)[column] * share_of, len(n_subs))
        window = np.add.reduceat(word[ids], window_start) / window_size
        top = np.maximum.reduceat(window, doc_start)
        share = (window == top[doc_of_window]).astype(float)
        share /= np.add.reduceat(share, doc_start)[doc_of_window]
        slope = (_sigmoid(top + bias) - label) * class_weight / len(label)
        per_word = np.bincount(ids, (slope[doc_of_window] * share / window_size)[window_of_word], len(n_subs))
        per_bucket = np.bincount(column, per_word[owner] * share_of, len(telling))
        grads = [np.outer(per_bucket, row) + decay / max(1, len(telling)) * table, table.T @ per_bucket, float(slope.sum())]
        moved = []
        for pair, grad in zip(moments, grads):
            pair[0], pair[1] = 0.9 * pair[0] + 0.1 * grad, 0.99 * pair[1] + 0.01 * grad**2
            moved.append(rate * (pair[0] / (1 - 0.9**step)) / (np.sqrt(pair[1] / (1 - 0.99**step)) + 1e-8))
        table, row, bias = table - moved[0], row - moved[1], bias - moved[2]
    return Detector(dict(zip(telling.tolist(), (table @ row).tolist())), float(bias))


#: Word scores that this Python worker has computed, for the detector in use.
_KNOWN: dict[str, dict[str, float]] = {}


def fit_detector(docs: DataFrame, labels: DataFrame, allowed: Column, label: str = "toxic", per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text") -> Detector | None:
    """Fit on the driver on at most about ``per_class`` labelled texts of each class with at most 10,000 characters."""
    sample = labelled_sample(docs, labels, label, allowed, per_class, id_col, text_col).where(F.char_length("text") <= LONGEST)
    rows = sorted((r["doc_id"], r["label"], r["text"]) for r in sample.collect())
    return fit([r[2] for r in rows], np.array([r[1] for r in rows])) if rows else None


def toxicity_scores(docs: DataFrame, detector: Detector | None, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a column ``score_col``; 0.5 for all if nothing could be fitted.

    Whole texts of any length are scored; a null text like an empty one. Rows and
    other columns stay as they are; a column of the same name is replaced; equal
    texts get equal scores, repeated rows stay and an empty table gives no rows.
    Nothing is shuffled; the detector (4 MB) goes to each worker once.
    """
    text_col, docs = "c0", docs.select(F.col(text_col), *(c for c in docs.columns if c != score_col))
    names = docs.columns[1:]
    docs = docs.toDF(*(f"c{i}" for i in range(len(names) + 1)))
    plain = docs.columns[1:]
    rows = docs.select(*plain, F.array_remove(F.split(F.lower(text_or_empty(text_col)), BLANKS), "").alias("__words"))
    shared, key = docs.sparkSession.sparkContext.broadcast(detector), str(uuid.uuid4())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if key not in _KNOWN:
            _KNOWN.clear()
            _KNOWN[key] = {}
        words = batch.column(len(plain))
        scores = shared.value.scores(words, _KNOWN[key]) if shared.value else np.full(len(words), 0.5)
        return pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(plain))), pa.array(scores, pa.float64())], [*plain, "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return map_batches(rows, run, f"{kinds}, score double").toDF(*names, score_col)
