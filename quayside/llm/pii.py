"""Personal data by rules and by a character-level bidirectional LSTM with CRF transitions.

The rules give the base spans of four kinds.  The network is trained in numpy on windows of a bounded
sample of the same texts, whose labels are the base spans, and adds spans in forms that the rules
miss.  Long texts are read in overlapping windows; each is decoded by itself, and every character
takes its tag from the window in whose middle it lies nearest, over the whole text, before spans are
cut.  The network only says something about characters within ``REACH`` of a digit or an ``@``, as no
span of the four kinds is without one; windows elsewhere could add nothing and are not computed.  A
span of the network counts if it has a digit or an ``@``, has as many characters as the kind's shortest
form, is certain enough, and overlaps no base span.

Whole texts are read, of any length; the rules take time linear in it, whatever the text.

Defined results: null texts count as empty; an empty text has no spans and its digest is of the
empty string; rows are judged one by one.  Without any base span in the sample the network adds
nothing.  Only the given column is read.  Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import bounded, slices

KINDS = ("email", "ip", "card", "phone")
#: Documents to learn from, at most about so many, and windows taken from them.
SAMPLE_ROWS, SAMPLE_WINDOWS = 3000, 1600
WINDOW, REACH = 48, 40
#: Steps of training that few windows are repeated for.
_LEAST_STEPS = 200
_STRIDE, _CLASSES, _HIDDEN, _TAGS = WINDOW // 2, 18, 14, 1 + 2 * len(KINDS)
_LEAST_CERTAIN, _SHORTEST = 0.9, {"email": 6, "ip": 7, "card": 12, "phone": 10}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match never begins inside a run of digits, as one from the run's first digit would have come before.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_MARK = re.compile("[0-9@]")

Span = tuple[str, int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str | None) -> list[Span]:
    """The rules' spans, by start and then kind."""
    found: list[Span] = []
    if not text:
        return found
    at, done = text.find("@"), 0
    while at >= 0:
        # What stands before the sign up to the last match is as in a search from the left.
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (rest := _DOMAIN.match(text, at + 1)):
            found.append(("email", start, rest.end()))
            done = rest.end()
        at = text.find("@", max(at + 1, done))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(part) < 4 and int(part or 0) <= 255 for part in (p.lstrip("0") for p in m[0].split("."))):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            if 12 <= len(digits := _digits(m[0])) <= 19 and _luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_digits(m[0])) <= 15:
                    found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _char_classes() -> np.ndarray:
    """Class of each character below 128; 17 is every other one, 0 is beyond the text."""
    table = np.full(128, 16, dtype=np.int64)
    for n, members in enumerate(
        ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "@", ".", "-", "_", "+", "(", ")", " ", "\n\r\t", ",;:", "%", "/")
    ):
        for c in members:
            table[ord(c)] = n + 1
    return table


_CLASS_OF = _char_classes()


def char_classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where(points < 128, _CLASS_OF[np.minimum(points, 127)], 17)


def tags_of(length: int, spans: list[Span]) -> np.ndarray:
    """Tags of characters: 0 outside, then for each kind its first and its other characters; the earlier span wins."""
    tags = np.zeros(length, dtype=np.int64)
    for kind, start, end in reversed(spans):
        tags[start:end] = 2 + 2 * KINDS.index(kind)
        tags[start] = 1 + 2 * KINDS.index(kind)
    return tags


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass(frozen=True)
class PiiModel:
    """Weights by name; empty: nothing was learnt."""

    weights: dict[str, np.ndarray]


def _lstm(classes: np.ndarray, weights: dict, side: str) -> tuple[np.ndarray, list]:
    """Hidden states of all characters (windows, characters, units), and what the way back needs."""
    inputs, rows = weights[f"in_{side}"], len(classes)
    hidden, cell = np.zeros((rows, _HIDDEN)), np.zeros((rows, _HIDDEN))
    out, trace = np.zeros((rows, classes.shape[1], _HIDDEN)), []
    steps = range(classes.shape[1]) if side == "f" else range(classes.shape[1] - 1, -1, -1)
    for t in steps:
        gates = inputs[classes[:, t]] + hidden @ weights[f"on_{side}"]
        opened, forget, given = (_sigmoid(gates[:, k * _HIDDEN : (k + 1) * _HIDDEN]) for k in range(3))
        fresh = np.tanh(gates[:, 3 * _HIDDEN :])
        before, earlier = cell, hidden
        cell = forget * cell + opened * fresh
        bent = np.tanh(cell)
        hidden = given * bent
        out[:, t] = hidden
        trace.append((t, opened, forget, given, fresh, before, earlier, bent))
    return out, trace


def _lstm_back(classes: np.ndarray, weights: dict, side: str, trace: list, slope: np.ndarray, slopes: dict) -> None:
    inputs, on = np.zeros_like(weights[f"in_{side}"]), np.zeros_like(weights[f"on_{side}"])
    d_hidden, d_cell = np.zeros((len(classes), _HIDDEN)), np.zeros((len(classes), _HIDDEN))
    for t, opened, forget, given, fresh, before, earlier, bent in reversed(trace):
        d_hidden = d_hidden + slope[:, t]
        d_cell = d_cell + d_hidden * given * (1 - bent**2)
        gates = np.concatenate(
            [
                d_cell * fresh * opened * (1 - opened), d_cell * before * forget * (1 - forget),
                d_hidden * bent * given * (1 - given), d_cell * opened * (1 - fresh**2),
            ],
            axis=1,
        )
        np.add.at(inputs, classes[:, t], gates)
        on += earlier.T @ gates
        d_hidden, d_cell = gates @ weights[f"on_{side}"].T, d_cell * forget
    slopes[f"in_{side}"], slopes[f"on_{side}"] = inputs, on


def _emissions(classes: np.ndarray, weights: dict) -> tuple[np.ndarray, np.ndarray, list, list]:
    ahead, trace_f = _lstm(classes, weights, "f")
    back, trace_b = _lstm(classes, weights, "b")
    states = np.concatenate([ahead, back], axis=2)
    return states @ weights["out"] + weights["bias"], states, trace_f, trace_b


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _marginals(emit: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chances of each character's tags, and the expected moves between tags, over all windows."""
    rows, length, _ = emit.shape
    ahead, back = np.zeros_like(emit), np.zeros_like(emit)
    ahead[:, 0] = emit[:, 0]
    for t in range(1, length):
        ahead[:, t] = emit[:, t] + _log_sum(ahead[:, t - 1, :, None] + move[None], 1)
    for t in range(length - 2, -1, -1):
        back[:, t] = _log_sum(move[None] + (emit[:, t + 1] + back[:, t + 1])[:, None, :], 2)
    whole = _log_sum(ahead[:, -1], 1)[:, None]
    chances = np.exp(ahead + back - whole[:, None])
    moves = np.zeros_like(move)
    for t in range(1, length):
        pair = ahead[:, t - 1, :, None] + move[None] + (emit[:, t] + back[:, t])[:, None, :]
        moves += np.exp(pair - whole[:, :, None]).sum(axis=0)
    return chances, moves


def fit(classes: np.ndarray, tags: np.ndarray, epochs: int = 8, rate: float = 0.02, batch: int = 64, seed: int = 5) -> PiiModel:
    """Train on windows (rows of classes) and their tags by Adam on the CRF's likelihood."""
    if not len(classes) or not tags.any():
        return PiiModel({})
    random = np.random.default_rng(seed)
    weights = {}
    for side in "fb":
        weights[f"in_{side}"] = random.normal(0, 0.3, (_CLASSES, 4 * _HIDDEN))
        weights[f"in_{side}"][:, _HIDDEN : 2 * _HIDDEN] += 1.0
        weights[f"on_{side}"] = random.normal(0, 0.2, (_HIDDEN, 4 * _HIDDEN))
    weights |= {"out": random.normal(0, 0.3, (2 * _HIDDEN, _TAGS)), "bias": np.zeros(_TAGS), "move": np.zeros((_TAGS, _TAGS))}
    moments = {k: (np.zeros_like(w), np.zeros_like(w)) for k, w in weights.items()}
    batches = -(-len(classes) // batch)
    epochs = max(epochs, -(-_LEAST_STEPS // batches))
    step, steps = 0, epochs * batches
    for _ in range(epochs):
        order = random.permutation(len(classes))
        for at in range(0, len(order), batch):
            part = order[at : at + batch]
            own, wanted = classes[part], tags[part]
            emit, states, trace_f, trace_b = _emissions(own, weights)
            chances, moves = _marginals(emit, weights["move"])
            slope = (chances - np.eye(_TAGS)[wanted]) / len(part)
            np.add.at(moves, (wanted[:, :-1].ravel(), wanted[:, 1:].ravel()), -1.0)
            slopes = {
                "out": states.reshape(-1, 2 * _HIDDEN).T @ slope.reshape(-1, _TAGS),
                "bias": slope.sum(axis=(0, 1)), "move": moves / len(part),
            }
            down = slope @ weights["out"].T
            _lstm_back(own, weights, "f", trace_f, down[:, :, :_HIDDEN], slopes)
            _lstm_back(own, weights, "b", trace_b, down[:, :, _HIDDEN:], slopes)
            step += 1
            pace = rate * (1 - 0.9 * step / steps)
            for k, slope in slopes.items():
                first, second = 0.9 * moments[k][0] + 0.1 * slope, 0.99 * moments[k][1] + 0.01 * slope**2
                moments[k] = first, second
                weights[k] = weights[k] - pace * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return PiiModel(weights)


def _training_windows(texts: list[str], most: int, seed: int = 9) -> tuple[np.ndarray, np.ndarray]:
    """Windows round base spans and round other marks, as many of each at most; drawn at random if there are more."""
    random = np.random.default_rng(seed)
    with_span, without = [], []
    for text in texts:
        if not text or not _MARK.search(text):
            continue
        classes, tags = char_classes(text), tags_of(len(text), base_spans(text))
        for mark in _MARK.finditer(text):
            if mark.start() and text[mark.start() - 1].isdigit():
                continue
            start = max(0, mark.start() - int(random.integers(4, WINDOW - 4)))
            window = np.zeros((2, WINDOW), dtype=np.int64)
            own = slice(start, start + WINDOW)
            window[0, : len(classes[own])], window[1, : len(tags[own])] = classes[own], tags[own]
            (with_span if window[1].any() else without).append(window)
    drawn = []
    for side in (with_span, without):
        drawn += [side[k] for k in sorted(random.permutation(len(side))[: most // 2])]
    both = np.array(drawn, dtype=np.int64).reshape(-1, 2, WINDOW)
    return both[:, 0], both[:, 1]


def learn(documents: DataFrame, key: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> PiiModel:
    """Fit to windows of ``rows`` documents (all, if fewer) that have a digit or an ``@``."""
    marked = documents.where(F.col(text).rlike("[0-9@]")).select(F.col(key).alias("k"), F.col(text).alias("t"))
    drawn = bounded(marked, rows, 8).select("t")
    return fit(*_training_windows(sorted(drawn.toArrow()["t"].to_pylist()), SAMPLE_WINDOWS))


def _best_tags(emit: np.ndarray, move: np.ndarray) -> np.ndarray:
    rows, length, _ = emit.shape
    level, came = emit[:, 0], np.zeros(emit.shape, dtype=np.int64)
    for t in range(1, length):
        reach = level[:, :, None] + move[None]
        came[:, t] = reach.argmax(axis=1)
        level = reach.max(axis=1) + emit[:, t]
    tags = np.zeros((rows, length), dtype=np.int64)
    tags[:, -1] = level.argmax(axis=1)
    for t in range(length - 1, 0, -1):
        tags[:, t - 1] = came[np.arange(rows), t, tags[:, t]]
    return tags


def _windows(text: str) -> list[int]:
    """Where the windows begin whose characters may lie in a span."""
    starts: set[int] = set()
    for mark in _MARK.finditer(text):
        low, high = max(0, mark.start() - REACH), mark.start() + REACH
        first = max(0, (low - WINDOW) // _STRIDE + 1)
        starts.update(range(first * _STRIDE, high + 1, _STRIDE))
    return sorted(s for s in starts if s < len(text))


def model_spans(texts: list[str], model: PiiModel) -> list[list[Span]]:
    """What the network finds in each text."""
    out: list[list[Span]] = [[] for _ in texts]
    if not model.weights:
        return out
    places = [(k, start) for k, text in enumerate(texts) for start in _windows(text)]
    known: dict[int, np.ndarray] = {}
    votes: dict[int, tuple[dict, dict]] = {}
    for at in range(0, len(places), 4096):
        part = places[at : at + 4096]
        classes = np.zeros((len(part), WINDOW), dtype=np.int64)
        for row, (k, start) in enumerate(part):
            if k not in known:
                known = {k: char_classes(texts[k])}
            own = known[k][start : start + WINDOW]
            classes[row, : len(own)] = own
        emit = _emissions(classes, model.weights)[0]
        tags, chances = _best_tags(emit, model.weights["move"]), _marginals(emit, model.weights["move"])[0]
        sure = np.take_along_axis(chances, tags[:, :, None], 2)[:, :, 0]
        for row, (k, start) in enumerate(part):
            tag_of, near_of = votes.setdefault(k, ({}, {}))
            for t in np.flatnonzero(classes[row]).tolist():
                near = abs(2 * t - WINDOW + 1)
                if near_of.get(start + t, WINDOW + 1) > near:
                    near_of[start + t] = near
                    tag_of[start + t] = (int(tags[row, t]), float(sure[row, t]))
    for k, (tag_of, _) in votes.items():
        span: list = []
        for place in [*sorted(tag_of), None]:
            tag, sure = tag_of.get(place, (0, 1.0))
            goes_on = span and place == span[2] and tag == 2 + 2 * span[0]
            if span and not goes_on:
                kind, certain = KINDS[span[0]], np.mean(span[3])
                if span[2] - span[1] >= _SHORTEST[kind] and certain >= _LEAST_CERTAIN and _MARK.search(texts[k], span[1], span[2]):
                    out[k].append((kind, span[1], span[2]))
                span = []
            if goes_on:
                span[2] += 1
                span[3].append(sure)
            elif tag:
                span = [(tag - 1) // 2, place, place + 1, [sure]]
    return out


def all_spans(texts: list[str | None], model: PiiModel) -> list[tuple[list[Span], list[Span]]]:
    """For each text the base spans, and these with what the network adds."""
    plain = [t or "" for t in texts]
    base = [base_spans(t) for t in plain]
    marked = [k for k, t in enumerate(plain) if _MARK.search(t)]
    out = [(own, own) for own in base]
    for k, found in zip(marked, model_spans([plain[k] for k in marked], model), strict=True):
        fresh = [s for s in found if all(s[2] <= b[1] or s[1] >= b[2] for b in base[k])]
        out[k] = base[k], sorted([*base[k], *fresh], key=lambda s: (s[1], KINDS.index(s[0])))
    return out


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def digest(text: Column, model: PiiModel) -> Column:
    """A struct of the base spans' number by kind and digest, and of all spans."""

    def run(texts: pa.Array) -> pa.Array:
        counts: list[list[int]] = [[] for _ in KINDS]
        sums, joined = [], []
        for part in slices(texts):
            for base, spans in all_spans(part.to_pylist(), model):
                for column, kind in zip(counts, KINDS, strict=True):
                    column.append(sum(s[0] == kind for s in base))
                sums.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                joined.append(_joined(spans))
        return pa.StructArray.from_arrays(
            [*(pa.array(c, pa.int64()) for c in counts), pa.array(sums, pa.string()), pa.array(joined, pa.string())],
            [*(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"],
        )

    kind = "struct<n_email: bigint, n_ip: bigint, n_card: bigint, n_phone: bigint, base_sha256: string, spans: string>"
    return F.arrow_udf(run, kind).asNondeterministic()(text)


def masked(text: Column, model: PiiModel) -> Column:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first counts, and covers the rest."""

    def run(texts: pa.Array) -> pa.Array:
        out = []
        for some in slices(texts):
            part = some.to_pylist()
            for own, (_, spans) in zip(part, all_spans(part, model), strict=True):
                if spans:
                    parts, done = [], 0
                    for kind, start, end in spans:
                        if start >= done:
                            parts += [own[done:start], f"[{kind.upper()}]"]
                        done = max(done, end)
                    own = "".join([*parts, own[done:]])
                out.append(own)
        return pa.array(out, pa.string())

    return F.arrow_udf(run, "string").asNondeterministic()(text)
