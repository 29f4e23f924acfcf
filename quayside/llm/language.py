"""Language identification by multilingual mixture inference.

A document is a mixture of languages: each word is drawn from one of them, with the likelihood
that the language's character n-grams give it.  Expectation-maximisation estimates the document's
proportions.  A further language is taken into the document's set only if it raises the
log-likelihood by more than a penalty; the prediction is the set's largest share.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and no languages.
Without any labelled row every text is ``und``.  Rows are judged one by one, so repeated rows get
equal results, and ties between languages go to the first in alphabetical order.  Only the named
columns are read, so other columns may have any name.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import bounded, ngrams, segment_sums, slices, worker_wide, WordTable

#: Labelled documents to learn from, at most about so many.
SAMPLE_ROWS = 4000
_SIZES, _BUCKETS = (1, 2, 3), 1 << 16
#: Rounds of expectation-maximisation: to see whether one language is enough, and to estimate shares.
_LOOK, _ROUNDS = 5, 12
_NO_LETTERS = re.compile(r"[\W\d_]+")


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    #: Log-probability of each n-gram bucket in each language.
    table: np.ndarray
    #: Log-likelihood that a further language must add, beside half the logarithm of the word count.
    penalty: float = 6.0


def _letters(word: str) -> str:
    return word.lower() if word.isalpha() else _NO_LETTERS.sub("", word.lower())


def fit(texts: list[str], languages: list[str], penalty: float = 6.0) -> LanguageModel:
    """Smoothed n-gram probabilities per language, every language alike in weight."""
    names = sorted(set(languages))
    table = np.zeros((_BUCKETS, len(names)), dtype=np.float32)
    for column, name in enumerate(names):
        counts: dict[str, int] = {}
        for text, language in zip(texts, languages, strict=True):
            if language == name:
                for word in text.split():
                    counts[word] = counts.get(word, 0) + 1
        words = list(counts)
        found, owner = ngrams([_letters(w) for w in words], _SIZES, _BUCKETS)
        weight = np.array([counts[w] for w in words], dtype=np.float64)
        seen = np.bincount(found, weights=weight[owner], minlength=_BUCKETS) + 0.5
        table[:, column] = np.log(seen / seen.sum())
    return LanguageModel(names, table, penalty)


def learn(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Fit to ``rows`` documents with a text and a language (all, if fewer), of every language its share at least."""
    labelled = documents.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    labelled = labelled.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l"))
    counts = {r.l: r["count"] for r in labelled.groupBy("l").count().collect()}
    # What languages with few documents leave free goes to the others.
    parts, free = [], rows
    for left, (name, count) in zip(range(len(counts), 0, -1), sorted(counts.items(), key=lambda item: (item[1], item[0])), strict=True):
        share = min(count, max(1, free // left))
        free -= share
        parts.append(bounded(labelled.where(F.col("l") == name), share, 3))
    texts, names = [], []
    for part in parts:
        drawn = part.toArrow()
        texts += drawn["t"].to_pylist()
        names += drawn["l"].to_pylist()
    return fit(texts, names)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of the columns' runs, in a row per run."""
    return np.stack([segment_sums(line, counts) for line in values], axis=1)


def _mixture(likelihood, counts, shares, rounds):
    """Shares after expectation-maximisation, and the log-likelihood; languages with share 0 stay out.

    ``likelihood`` has a line per language and a column per word.
    """
    words = np.maximum(counts, 1)[:, None]
    for _ in range(rounds):
        part = likelihood * np.repeat(shares.T.astype(np.float32), counts, axis=1)
        part /= part.sum(axis=0) + np.float32(1e-30)
        shares = _sums(part, counts) / words
    total = (likelihood * np.repeat(shares.T.astype(np.float32), counts, axis=1)).sum(axis=0)
    return shares, segment_sums(np.log(total + np.float32(1e-30)), counts)


def infer(model: LanguageModel, rows: np.ndarray, counts: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shares of the languages chosen for each document, its number of words with letters, and its margin.

    The margin is by how much the words, each in the language that suits it best, are likelier than n-grams
    drawn evenly, on average per word, in natural logarithms.
    """
    n = len(model.languages)
    real = table[rows, -1] > 0
    kept = segment_sums(real.astype(np.float64), counts).astype(np.int64)
    logs = np.ascontiguousarray(table[rows[real], :n].T)
    top = logs.max(axis=0)
    margin = segment_sums((top - table[rows[real], n]).astype(np.float64), kept) / np.maximum(kept, 1)
    logs -= top
    likelihood = np.exp(logs)
    single = _sums(np.maximum(logs, -60), kept)
    best = single.argmax(axis=1)
    shares = np.zeros((len(counts), n))
    shares[np.arange(len(counts)), best] = 1.0
    if n == 1:
        return shares, kept, margin
    reached = single.max(axis=1)
    price = model.penalty + 0.5 * np.log(np.maximum(kept, 1))
    _, most = _mixture(likelihood, kept, np.full((len(counts), n), 1 / n), _LOOK)
    open_ = np.flatnonzero(most - reached > price)
    while len(open_):
        pick = np.zeros(len(counts), dtype=bool)
        pick[open_] = True
        words = likelihood[:, np.repeat(pick, kept)]
        tried, gains = [], []
        for language in range(n):
            start = (shares[open_] > 0).astype(np.float64)
            fresh = start[:, language] == 0
            start[:, language] = 1.0
            found, level = _mixture(words, kept[open_], start / start.sum(axis=1, keepdims=True), _ROUNDS)
            tried.append(found)
            gains.append(np.where(fresh, level - reached[open_], -math.inf))
        choice = np.argmax(gains, axis=0)
        gain = np.max(gains, axis=0)
        taken = gain > price[open_]
        shares[open_[taken]] = np.stack(tried)[choice[taken], np.flatnonzero(taken)]
        reached[open_[taken]] += gain[taken]
        open_ = open_[taken]
        open_ = open_[(shares[open_] > 0).sum(axis=1) < n]
    return shares, kept, margin


_RESULT = "struct<lang_pred: string, score: double, languages: string, margin: double>"


def identify(text: Column, model: LanguageModel) -> Column:
    """A struct of ``lang_pred``, ``score`` (its share), ``languages`` (``en:0.83,de:0.17``) and ``margin``.

    Where the margin is not above 0, no learnt language makes the text likelier than chance.
    """
    names = np.array([*model.languages, "und"])

    def features(words: list[str]) -> np.ndarray:
        plain = [_letters(w) for w in words]
        out = np.zeros((len(words), len(model.languages) + 2), dtype=np.float32)
        found, owner = ngrams(plain, _SIZES, _BUCKETS)
        for column in range(len(model.languages)):
            sums = np.bincount(owner, weights=model.table[found, column], minlength=len(words))
            out[:, column] = sums / len(_SIZES)
        out[:, -2] = np.bincount(owner, minlength=len(words)) * (-math.log(_BUCKETS) / len(_SIZES))
        out[:, -1] = [bool(w) for w in plain]
        return out

    memory = worker_wide(lambda: WordTable(features, len(model.languages) + 2))

    def judge(texts: pa.Array) -> pa.Array:
        preds, scores, sets, margins = [], [], [], []
        for part in slices(texts):
            if not model.languages:
                preds, scores, sets = preds + ["und"] * len(part), scores + [0.0] * len(part), sets + [""] * len(part)
                margins += [0.0] * len(part)
                continue
            rows, counts, table = memory()([(t or "").split() for t in part.to_pylist()])
            shares, kept, margin = infer(model, rows, counts, table)
            margins += margin.round(6).tolist()
            top = np.where(kept > 0, shares.argmax(axis=1), len(model.languages))
            preds += names[top].tolist()
            scores += np.where(kept > 0, np.minimum(shares.max(axis=1), 1.0), 0.0).tolist()
            for share, any_ in zip(shares, kept > 0, strict=True):
                order = [k for k in np.argsort(-share, kind="stable") if share[k] > 0] if any_ else []
                sets.append(",".join(f"{names[k]}:{share[k]:.2f}" for k in order))
        return pa.StructArray.from_arrays(
            [pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.string()), pa.array(margins, pa.float64())],
            ["lang_pred", "score", "languages", "margin"],
        )

    return F.arrow_udf(judge, _RESULT).asNondeterministic()(text)
