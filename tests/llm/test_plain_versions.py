"""Scores and decodings next to versions that go one document, word and character after the other."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import language, pii, quality, toxicity
from quayside.llm.common import ngrams


def plain_mixture(words, shares, rounds):
    """Words are likelihoods per language; expectation-maximisation by loops."""
    n = len(shares)
    for _ in range(rounds):
        sums = [0.0] * n
        for word in words:
            total = sum(s * p for s, p in zip(shares, word))
            for k in range(n):
                sums[k] += shares[k] * word[k] / total
        shares = [s / len(words) for s in sums]
    level = sum(math.log(sum(s * p for s, p in zip(shares, word))) for word in words)
    return shares, level


def plain_language(model, text):
    """The language set by the penalised likelihood, one language added at a time."""
    n, words, margins = len(model.languages), [], []
    for word in (text or "").split():
        letters = language._letters(word)
        if not letters:
            continue
        found, _ = ngrams([letters], language._SIZES, language._BUCKETS)
        logs = [float(model.table[found, k].sum()) / len(language._SIZES) for k in range(n)]
        top = max(logs)
        margins.append(top + len(found) * math.log(language._BUCKETS) / len(language._SIZES))
        words.append([math.exp(x - top) for x in logs])
    if not words:
        return "und", 0.0, 0.0
    single = [sum(max(math.log(w[k]) if w[k] else -60, -60) for w in words) for k in range(n)]
    best = single.index(max(single))
    shares, reached = [float(k == best) for k in range(n)], max(single)
    price = model.penalty + 0.5 * math.log(len(words))
    _, most = plain_mixture(words, [1 / n] * n, language._LOOK)
    open_ = most - reached > price
    while open_ and sum(s > 0 for s in shares) < n:
        tried = []
        for k in range(n):
            if shares[k] == 0:
                start = [float(s > 0 or j == k) for j, s in enumerate(shares)]
                found, level = plain_mixture(words, [s / sum(start) for s in start], language._ROUNDS)
                tried.append((level - reached, k, found))
        gain, _, found = max(tried, key=lambda t: (t[0], -t[1]))
        open_ = gain > price
        if open_:
            shares, reached = found, reached + gain
    top = shares.index(max(shares))
    return model.languages[top], shares[top], sum(margins) / len(margins)


def test_languages_equal_the_plain_version(spark, held):
    model = language.fit([r[1] for r in held[:300]], [r[2] for r in held[:300]])
    texts = [r[1][:600] for r in held[300:360]]
    texts += [a[:400] + " " + b[:300] for a, b in zip(texts[:20], texts[20:40])] + ["", " ", "12 34", "один два", "the", None]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    found = {r.k: r.r for r in frame.select("k", language.identify(F.col("text"), model).alias("r")).collect()}
    for k, text in enumerate(texts):
        name, share, margin = plain_language(model, text)
        assert found[k].lang_pred == name and abs(found[k].score - share) < 2e-3 and abs(found[k].margin - margin) < 1e-2


def test_toxicity_equals_the_plain_version(spark, held):
    known = [r for r in held if r[4] is not None]
    model = toxicity.fit([r[1] or "" for r in known], [r[4] for r in known])
    texts = [r[1][:800] for r in held[:60]] + ["", "  ", "a", "ÄÖ! *#$ ...", "word " * 500, None]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    found = {r.k: r.s for r in frame.select("k", toxicity.score(F.col("text"), model).alias("s")).collect()}
    for k, text in enumerate(texts):
        total, members = 0.0, 0
        for word in (text or "").split():
            own, _ = ngrams([toxicity._plain(word)], toxicity._SIZES, toxicity._BUCKETS)
            total, members = total + float(model.weights[own].sum()), members + len(own)
        logit = total / max(members, 1) + model.bias
        assert abs(found[k] - 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))) < 1e-5


def plain_features(text):
    words = (text or "").split()
    n, w = len(words), max(len(words), 1)
    chars = sum(map(len, words))
    letters, digits = (sum(sum(map(f, x)) for x in words) for f in (str.isalpha, str.isdigit))
    symbols = [sum(c in quality._SYMBOLS for c in x) for x in words]
    flags = [
        sum(sum(map(str.isalpha, x)) > 1 and x.isupper() for x in words), sum(not any(map(str.isalpha, x)) for x in words),
        sum(s > 0 for s in symbols), sum(x.istitle() for x in words), sum(len(x) > 14 for x in words),
    ]
    distinct = len(set(words)) / w
    pairs = len(set(zip(words, words[1:]))) / max(n - 1, 1)
    same = sum(a == b for a, b in zip(words, words[1:])) / w
    marks = [text.count("\n") / n, (text.count(".") + text.count(",")) / n] if n else [0, 0]
    shares = [x / max(chars, 1) for x in (letters, digits, sum(symbols))]
    return [math.log1p(n), chars / w, *shares, *(f / w for f in flags), same, distinct if n else 0, pairs if n else 0, *marks]


def test_quality_equals_the_plain_version(spark, held):
    known = [r for r in held if r[3] is not None]
    rows = np.array([plain_features(r[1]) for r in known])
    good = np.array([r[3] == 1 for r in known])
    model = quality.fit(rows[good], rows[~good], float(good.mean()))
    texts = [r[1][:900] for r in held[:60]] + ["", " ", "A1 A1 A1 #", "x" * 200, None]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    found = {r.k: r for r in frame.select("k", quality.features(F.col("text")).alias("f"), quality.score(F.col("text"), model).alias("s")).collect()}
    for k, text in enumerate(texts):
        own = plain_features(text)
        assert np.allclose(found[k].f, own, atol=1e-5)
        inputs = [max(-8.0, min(8.0, (x - m) / s)) for x, m, s in zip(own, model.mean, model.scale)]
        hidden = [math.tanh(sum(x * w for x, w in zip(inputs, column)) + b) for column, b in zip(model.first.T, model.first_bias)]
        logit = sum(h * float(w) for h, w in zip(hidden, np.ravel(model.second))) + model.second_bias
        assert abs(found[k].s - 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))) < 1e-4


@pytest.mark.parametrize("seed", range(6))
def test_decoding_equals_all_ways_of_tagging(seed):
    """The best tags and each tag's chance, over every sequence of tags."""
    pick = np.random.default_rng(seed)
    tags, length = 4, 5
    emit, move = pick.normal(0, 1, (3, length, tags)), pick.normal(0, 1, (tags, tags))
    ways = list(itertools.product(range(tags), repeat=length))
    best, chances = pii._best_tags(emit, move), pii._marginals(emit, move)[0]
    for row in range(3):
        levels = [sum(emit[row, t, w[t]] for t in range(length)) + sum(move[a, b] for a, b in zip(w, w[1:])) for w in ways]
        assert tuple(best[row]) == ways[int(np.argmax(levels))]
        weights = np.exp(levels) / np.exp(levels).sum()
        for t in range(length):
            for tag in range(tags):
                assert abs(chances[row, t, tag] - sum(p for p, w in zip(weights, ways) if w[t] == tag)) < 1e-9
