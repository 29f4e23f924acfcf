"""Toxicity by averaged subword embeddings and a linear softmax.

Every word is the bag of its character n-grams of 3 to 5, with word marks; a document is the
mean of the embeddings of all its bags' members; a linear softmax reads the mean.  Embeddings and
softmax are trained together in numpy.  A misspelling that was never seen still shares n-grams, and
so vectors, with the words that were.

Scoring folds the softmax into the embeddings: each bucket has one number, each word their sum.

Defined results: a null or empty text, or one without a word, has the score of the bias alone.
Without rows of both labels every score is the share of label 1 (0 without any).  Rows are scored
one by one, so repeated rows get equal scores.  Only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import bounded, ngrams, segment_sums, slices, worker_wide, WordTable

#: Labelled documents to learn from, at most about so many.
SAMPLE_ROWS = 4000
_SIZES, _BUCKETS, _WIDTH = (3, 4, 5), 1 << 18, 4


@dataclass(frozen=True)
class ToxicityModel:
    #: What each subword bucket adds to the log-odds of a document that is nothing else.
    weights: np.ndarray
    bias: float


def _plain(word: str) -> str:
    return word.lower().strip(".,;:!?\"'()[]{}*#$%&|")


def _subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return ngrams([_plain(w) for w in words], _SIZES, _BUCKETS)


def _softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


#: Documents whose bags are made at a time.
_CHUNK = 200


def _bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket, share of the document's bag), ordered by document."""
    parts = [_some_bags(texts[at : at + _CHUNK], at) for at in range(0, len(texts), _CHUNK)]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _some_bags(texts: list[str], first_row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    numbers: dict[str, int] = {}
    rows, words, counts = [], [], []
    for row, text in enumerate(texts):
        own: dict[int, int] = {}
        for word in (text or "").split():
            number = numbers.setdefault(word, len(numbers))
            own[number] = own.get(number, 0) + 1
        rows += [row] * len(own)
        words += own.keys()
        counts += own.values()
    found, owner = _subwords(list(numbers))
    found = found[np.argsort(owner, kind="stable")]
    size = np.bincount(owner, minlength=len(numbers))
    row, word, count = (np.array(x, dtype=np.int64) for x in (rows, words, counts))
    take = np.repeat((np.cumsum(size) - size)[word], size[word]) + _within(size[word])
    cell = np.repeat(row, size[word]) * _BUCKETS + found[take]
    order = np.argsort(cell, kind="stable")
    cell, mass = cell[order], np.repeat(count, size[word])[order].astype(np.float64)
    first = np.flatnonzero(np.diff(cell, prepend=-1))
    mass = np.add.reduceat(mass, first) if len(first) else mass
    row, bucket = cell[first] // _BUCKETS, cell[first] % _BUCKETS
    share = mass / np.maximum(np.bincount(row, weights=mass, minlength=len(texts)), 1)[row]
    return (row + first_row).astype(np.int32), bucket.astype(np.int32), share.astype(np.float32)


def _within(sizes: np.ndarray) -> np.ndarray:
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def fit(texts: list[str], labels: list[int], steps: int = 60, rate: float = 0.02, seed: int = 7) -> ToxicityModel:
    """Train embeddings and softmax together by Adam over all rows at once.

    Both classes weigh alike.  A bucket enters the mean in proportion to the square of the smoothed
    log-ratio of the two classes' shares of documents that have it, so the many subwords that both
    classes use alike add little noise; buckets in too few documents (3, or one in 400) are not
    trained.
    """
    target = np.array(labels, dtype=np.int64)
    share = float(target.mean()) if len(target) else 0.0
    if len(set(labels)) < 2:
        edge = min(max(share, 1e-6), 1 - 1e-6)
        return ToxicityModel(np.zeros(_BUCKETS, dtype=np.float32), float(np.log(edge / (1 - edge))))
    row, bucket, cell = _bags(texts)
    often = np.bincount(bucket, minlength=_BUCKETS)[bucket] >= min(max(3, len(texts) // 400), len(texts))
    row, bucket, cell = row[often], bucket[often], cell[often]
    used, bucket = np.unique(bucket, return_inverse=True)
    bucket = bucket.astype(np.int32)
    one = target[row] == 1
    rates = [
        (np.bincount(bucket[side], minlength=len(used)) + 0.5) / (total + 1) + 0.01
        for side, total in ((one, target.sum()), (~one, len(target) - target.sum()))
    ]
    gauge = np.log(rates[0] / rates[1]) ** 2 * 10
    cell = (cell * gauge[bucket]).astype(np.float32)
    weight = np.where(target == 1, 0.5 / share, 0.5 / (1 - share)) / len(target)
    per_row = np.bincount(row, minlength=len(texts))
    by_bucket = np.argsort(bucket, kind="stable")
    cell_by_bucket, row_by_bucket, per_bucket = cell[by_bucket, None], row[by_bucket], np.bincount(bucket)

    random = np.random.default_rng(seed)
    state = [random.normal(0, 0.01, (len(used), _WIDTH)), random.normal(0, 0.7, (_WIDTH, 2)), np.zeros(2)]
    wanted = np.eye(2)[target]
    moments = [(np.zeros_like(x), 0.0) for x in state]
    for step in range(1, steps + 1):
        embedding, linear, bias = state
        mean = segment_sums(cell[:, None] * embedding.astype(np.float32)[bucket], per_row)
        error = (_softmax(mean @ linear + bias) - wanted) * weight[:, None]
        back = (error @ linear.T).astype(np.float32)
        slopes = [segment_sums(cell_by_bucket * back[row_by_bucket], per_bucket), mean.T @ error, error.sum(axis=0)]
        for k, slope in enumerate(slopes):
            first = 0.9 * moments[k][0] + 0.1 * slope
            second = 0.98 * moments[k][1] + 0.02 * float((slope**2).max())
            moments[k] = first, second
            pace = (10 * rate, rate, 2 * rate)[k]
            state[k] = state[k] - pace * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.98**step)) + 1e-9)
    embedding, linear, bias = state
    weights = np.zeros(_BUCKETS, dtype=np.float32)
    weights[used] = gauge * (embedding @ (linear[:, 1] - linear[:, 0]))
    return ToxicityModel(weights, float(bias[1] - bias[0]))


def learn(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = SAMPLE_ROWS
) -> ToxicityModel:
    """Fit to ``rows`` labelled documents (all, if fewer)."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    drawn = bounded(known.select(F.col(key).alias("k"), F.col(label).alias("y")).distinct(), rows, 2)
    # An id may have many texts.
    drawn = bounded(documents.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(drawn), "k"), rows, 12)
    found = sorted(zip(*(drawn.toArrow()[c].to_pylist() for c in ("k", "t", "y")), strict=True), key=str)
    return fit([t or "" for _, t, _ in found], [y for _, _, y in found])


def score(text: Column, model: ToxicityModel) -> Column:
    """The probability of label 1."""
    def features(words: list[str]) -> np.ndarray:
        found, owner = _subwords(words)
        sums = np.bincount(owner, weights=model.weights[found], minlength=len(words))
        return np.stack([sums, np.bincount(owner, minlength=len(words))], axis=1).astype(np.float32)

    memory = worker_wide(lambda: WordTable(features, 2))

    def judge(texts: pa.Array) -> pa.Array:
        scores = [np.zeros(0)]
        for part in slices(texts):
            rows, counts, known = memory()([(t or "").split() for t in part.to_pylist()])
            sums = segment_sums(known[rows], counts)
            logits = sums[:, 0] / np.maximum(sums[:, 1], 1) + model.bias
            scores.append(1 / (1 + np.exp(-np.clip(logits, -30, 30))))
        return pa.array(np.concatenate(scores), pa.float64())

    return F.arrow_udf(judge, "double").asNondeterministic()(text)
