"""Quality by learning from trusted positives and unlabelled text.

A small network reads the shape of a text: kinds of characters, words in capitals, repeated words
and pairs, separators.  It minimises the non-negative unbiased risk
``p * R(positive as 1) + max(0, R(unlabelled as 0) - p * R(positive as 0))``, where ``p`` is the class
prior.  Positives are rows labelled 1; the unlabelled are documents without a label; rows
labelled 0 serve only to estimate ``p``, the share of 1 among the labels to learn from.

Defined results: a null text counts as empty; an empty one is scored like any other, from its zero
features.  Without positives or without unlabelled rows every score is the prior (0.5 without
labels).  Rows are scored one by one, so repeated rows get equal scores.  Only the named columns
are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import bounded, segment_sums, slices, worker_wide, WordTable

#: Documents to learn from, at most about so many of either kind.
SAMPLE_ROWS = 6000
_SYMBOLS = frozenset("#$%&*|!<>{}[]=~^_\\/@+")
_HIDDEN = 12


@dataclass(frozen=True)
class QualityModel:
    prior: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    first: np.ndarray | None = None
    first_bias: np.ndarray | None = None
    second: np.ndarray | None = None
    second_bias: float = 0.0


def _word_shape(words: list[str]) -> np.ndarray:
    """Per word: length, letters, digits, symbols, is in capitals, no letter, marks within, title, long."""
    out = np.zeros((len(words), 9), dtype=np.float32)
    for row, word in enumerate(words):
        letters = sum(map(str.isalpha, word))
        digits = sum(map(str.isdigit, word))
        symbols = sum(c in _SYMBOLS for c in word)
        out[row] = (
            len(word), letters, digits, symbols, letters > 1 and word.isupper(), letters == 0, symbols > 0, word.istitle(), len(word) > 14
        )
    return out


def text_features(texts: list[str | None], memory: WordTable) -> np.ndarray:
    """One row of features per text."""
    split = [(t or "").split() for t in texts]
    rows, counts, known = memory(split)
    sums = segment_sums(known[rows], counts)
    same = np.zeros(len(rows), dtype=np.float64)
    same[1:] = rows[1:] == rows[:-1]
    starts = (np.cumsum(counts) - counts)[counts > 0]
    same[starts] = 0
    words = np.maximum(counts, 1)
    distinct, pairs, lines, stops = (np.zeros(len(texts)) for _ in range(4))
    end = 0
    for k, count in enumerate(counts.tolist()):
        own, end = rows[end : end + count].astype(np.int64), end + count
        if count:
            distinct[k] = len(np.unique(own)) / count
            pairs[k] = len(np.unique(own[1:] * (1 << 32) + own[:-1])) / max(count - 1, 1)
            lines[k] = texts[k].count("\n") / count
            stops[k] = (texts[k].count(".") + texts[k].count(",")) / count
    letters = np.maximum(sums[:, 0], 1)
    return np.column_stack(
        [
            np.log1p(counts), sums[:, 0] / words, sums[:, 1] / letters, sums[:, 2] / letters, sums[:, 3] / letters,
            *(sums[:, k] / words for k in range(4, 9)), segment_sums(same, counts) / words, distinct, pairs, lines, stops,
        ]
    )


_WIDTH = 15


def features(text: Column) -> Column:
    """The features as an array of doubles."""

    memory = worker_wide(lambda: WordTable(_word_shape, 9))

    def measure(texts: pa.Array) -> pa.Array:
        rows = [np.zeros((0, _WIDTH))] + [text_features(part.to_pylist(), memory()) for part in slices(texts)]
        flat = np.concatenate(rows)
        offsets = np.arange(len(flat) + 1, dtype=np.int32) * _WIDTH
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.ravel(), pa.float64()))

    return F.arrow_udf(measure, "array<double>").asNondeterministic()(text)


def _forward(model: QualityModel, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inputs = np.clip((rows - model.mean) / model.scale, -8, 8)
    hidden = np.tanh(inputs @ model.first + model.first_bias)
    return inputs, hidden, hidden @ model.second + model.second_bias


def _sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 1500, rate: float = 0.01, slack: float = 0.03, seed: int = 11) -> QualityModel:
    """Minimise the non-negative risk by Adam; where its second part is below ``-slack``, step back up instead."""
    if not len(positive) or not len(unlabelled):
        return QualityModel(prior)
    both = np.concatenate([positive, unlabelled])
    random = np.random.default_rng(seed)
    model = QualityModel(
        prior, both.mean(axis=0), both.std(axis=0) + 1e-3, random.normal(0, 0.4, (both.shape[1], _HIDDEN)),
        np.zeros(_HIDDEN), random.normal(0, 0.4, _HIDDEN), 0.0,
    )
    weights = [model.first, model.first_bias, model.second, np.zeros(1)]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    for step in range(1, steps + 1):
        p = positive[random.integers(0, len(positive), min(len(positive), 512))]
        u = unlabelled[random.integers(0, len(unlabelled), min(len(unlabelled), 512))]
        now = QualityModel(prior, model.mean, model.scale, *weights[:3], float(weights[3][0]))
        p_in, p_hidden, p_out = _forward(now, p)
        u_in, u_hidden, u_out = _forward(now, u)
        rest = np.logaddexp(0, u_out).mean() - prior * np.logaddexp(0, p_out).mean()
        as_one = -prior * _sigmoid(-p_out) / len(p)
        p_as_zero, u_as_zero = prior * _sigmoid(p_out) / len(p), _sigmoid(u_out) / len(u)
        p_slope, u_slope = (as_one - p_as_zero, u_as_zero) if rest >= -slack else (p_as_zero, -u_as_zero)
        slopes = [1e-4 * w for w in weights[:3]] + [np.zeros(1)]
        for inputs, hidden, slope in ((p_in, p_hidden, p_slope), (u_in, u_hidden, u_slope)):
            back = slope[:, None] * now.second * (1 - hidden**2)
            for k, part in enumerate((inputs.T @ back, back.sum(axis=0), hidden.T @ slope, np.array([slope.sum()]))):
                slopes[k] = slopes[k] + part
        for k, slope in enumerate(slopes):
            first, second = 0.9 * moments[k][0] + 0.1 * slope, 0.999 * moments[k][1] + 0.001 * slope**2
            moments[k] = first, second
            weights[k] = weights[k] - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return QualityModel(prior, model.mean, model.scale, *weights[:3], float(weights[3][0]))


def learn(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    may_learn: Column | None = None,
    rows: int = SAMPLE_ROWS,
) -> QualityModel:
    """Fit to ``rows`` positives and as many unlabelled documents (all, if fewer).

    ``may_learn`` is a condition on the rows of ``labels``: only labels of rows that meet it are read.
    """
    may = F.lit(True) if may_learn is None else may_learn
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    names = known.select(F.col(key).alias("k"), F.col(label).alias("y"), may.alias("may"))
    shares = names.where("may").agg(F.avg(F.col("y").cast("double")), F.count(F.lit(1))).first()
    prior = (shares[0] * shares[1] + 1) / (shares[1] + 2) if shares[1] else 0.5
    drawn = bounded(names.where("may AND y = 1").select("k").distinct(), rows, 5).withColumn("positive", F.lit(True))
    bare = documents.select(F.col(key).alias("k")).join(names.select("k"), "k", "left_anti").where("k IS NOT NULL").distinct()
    drawn = drawn.unionByName(bounded(bare, rows, 6).withColumn("positive", F.lit(False)))
    texts = documents.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(drawn), "k")
    # An id may have many texts.
    texts = bounded(texts, 2 * rows, 7)
    found = texts.select("k", "positive", features(F.col("t")).alias("f")).toArrow()
    order = np.argsort(found["k"].to_numpy(), kind="stable")
    values = np.array(found["f"].to_pylist(), dtype=np.float64).reshape(-1, _WIDTH)[order]
    positive = found["positive"].to_numpy()[order].astype(bool)
    return fit(values[positive], values[~positive], float(prior))


def score(text: Column, model: QualityModel) -> Column:
    """The probability of label 1."""

    memory = worker_wide(lambda: WordTable(_word_shape, 9))

    def judge(texts: pa.Array) -> pa.Array:
        scores = [np.zeros(0)]
        for part in slices(texts):
            if model.first is None:
                scores.append(np.full(len(part), model.prior))
            else:
                # The last digits depend on what rows are multiplied together.
                scores.append(_sigmoid(_forward(model, text_features(part.to_pylist(), memory()))[2]).round(9))
        return pa.array(np.concatenate(scores), pa.float64())

    return F.arrow_udf(judge, "double").asNondeterministic()(text)
