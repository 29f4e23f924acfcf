import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quayside.llm import language, pii, quality, toxicity
from quayside.llm.common import WordTable, ngrams, segment_sums, slices


def _rest(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_segment_sums_of_empty_runs():
    assert segment_sums(np.array([1.0, 2, 3]), np.array([0, 2, 0, 1, 0])).tolist() == [0, 3, 0, 3, 0]


def test_ngrams_stay_within_words():
    one, _ = ngrams(["ab"], (3,), 1 << 20)
    both, owner = ngrams(["ab", "ab"], (3,), 1 << 20)
    assert len(one) == 2 and both.tolist() == [*one, *one] and owner.tolist() == [0, 0, 1, 1]
    assert len(ngrams([], (3,), 8)[0]) == 0


def test_slices_cover_all_rows():
    array = pa.array(["x" * 100, None, "", "y" * 5000, "z"])
    parts = list(slices(array, 150))
    assert [t for p in parts for t in p.to_pylist()] == array.to_pylist() and len(parts) > 1


def test_language_of_held_out_texts(spark, held):
    learn = [r for r in held if _rest(r[0], 4) != 2]
    model = language.fit([r[1] for r in learn], [r[2] for r in learn])
    rows = spark.createDataFrame([(r[1], r[2]) for r in held if _rest(r[0], 4) == 2], "text string, lang string")
    found = rows.select("lang", language.identify(F.col("text"), model).alias("r")).collect()
    assert sum(r.lang == r.r.lang_pred for r in found) >= 0.97 * len(found)


def test_a_mixture_names_both_languages(spark, held):
    model = language.fit([r[1] for r in held], [r[2] for r in held])
    long = {lang: next(r[1] for r in held if r[2] == lang and len(r[1]) > 2000)[:2000] for lang in ("en", "de")}
    frame = spark.createDataFrame([(long["en"] + " " + long["de"][:900],)], "text string")
    found = frame.select(language.identify(F.col("text"), model).alias("r")).first().r
    assert found.lang_pred == "en" and {p.split(":")[0] for p in found.languages.split(",")} == {"en", "de"}
    assert 0.5 < found.score < 0.9


def test_language_of_odd_rows(spark, odd, empty, documents):
    model = language.learn(documents)
    rows = odd.select("doc_id", "text", language.identify(F.col("text"), model).alias("r")).collect()
    und = [r.text is None or not any(c.isalpha() for c in r.text) for r in rows]
    assert [r.r.lang_pred == "und" for r in rows] == und
    assert all(0 <= r.r.score <= 1 for r in rows) and all(r.r.score == 0 for r, u in zip(rows, und, strict=True) if u)
    nothing = language.learn(empty)
    assert {r.r.lang_pred for r in odd.select(language.identify(F.col("text"), nothing).alias("r")).collect()} == {"und"}
    assert empty.select(language.identify(F.col("text"), model)).count() == 0


def test_toxicity_of_held_out_texts(spark, held):
    learn = [r for r in held if r[4] is not None and _rest(r[0], 5)]
    model = toxicity.fit([r[1] for r in learn], [r[4] for r in learn])
    out = [(r[1], r[4]) for r in held if r[4] is not None and not _rest(r[0], 5)]
    scored = spark.createDataFrame(out, "text string, y int").select("y", toxicity.score(F.col("text"), model).alias("s")).collect()
    good = np.mean([(r.s >= 0.5) == bool(r.y) for r in scored])
    assert good >= 0.85
    # A misspelling shares subwords with what was learnt.
    frame = spark.createDataFrame([("you are a disgustingg morron",), ("you are a fine person",)], "text string")
    bad, fine = (r[0] for r in frame.select(toxicity.score(F.col("text"), model)).collect())
    assert bad > fine


def test_toxicity_of_odd_rows(odd, empty, documents, labels):
    model = toxicity.learn(documents, labels)
    rows = odd.select("text", toxicity.score(F.col("text"), model).alias("s")).collect()
    assert all(0 <= r.s <= 1 for r in rows)
    assert len({round(r.s, 12) for r in rows if not (r.text or "").split()}) == 1
    none = toxicity.learn(empty, labels)
    assert {r.s < 1e-5 for r in odd.select(toxicity.score(F.col("text"), none).alias("s")).collect()} == {True}


def test_quality_of_held_out_texts(spark, documents, held):
    memory = WordTable(quality._word_shape, 9)
    learn = [r for r in held if r[3] is not None and _rest(r[0], 5)]
    rows = [quality.text_features(t, memory) for t in ([r[1] for r in learn if r[3]], [r[1] for r in held if r[3] is None])]
    model = quality.fit(*rows, float(np.mean([r[3] for r in learn])))
    out = [(r[1], r[3]) for r in held if r[3] is not None and not _rest(r[0], 5)]
    scored = spark.createDataFrame(out, "text string, y int").select("y", quality.score(F.col("text"), model).alias("s")).collect()
    assert np.mean([(r.s >= 0.3) == bool(r.y) for r in scored]) >= 0.95


def test_quality_of_odd_rows(odd, empty, documents, labels):
    model = quality.learn(documents, labels)
    rows = odd.select("text", quality.score(F.col("text"), model).alias("s")).collect()
    assert all(0 <= r.s <= 1 for r in rows)
    assert len({r.s for r in rows if not r.text}) == 1
    bare = quality.learn(empty, labels.limit(0))
    assert {r.s for r in odd.select(quality.score(F.col("text"), bare).alias("s")).collect()} == {0.5}


def test_a_negative_risk_is_not_chased():
    random = np.random.default_rng(0)
    good, bad = random.normal(1, 0.5, (400, quality._WIDTH)), random.normal(-1, 0.5, (100, quality._WIDTH))
    model = quality.fit(good[:200], np.concatenate([good[200:], bad]), 0.66)
    chance = quality._sigmoid(quality._forward(model, np.concatenate([good, bad]))[2])
    assert chance[:400].min() > 0.5 > chance[400:].max()


def _by_patterns(text):
    import re

    found = []
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    for kind, pattern in patterns.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            doubled = [d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))]
            fits = {
                "email": True, "ip": all(int(p) < 256 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0, "phone": 9 <= len(digits) <= 15,
            }
            if fits[kind]:
                found.append((m.start(), list(patterns).index(kind), (kind, *m.span())))
    return [span for _, _, span in sorted(found)]


def test_base_spans_equal_the_patterns(held):
    odd = ["a@b@c.de.f", "..@x.y a@@b.c", "x@y z@w.q@r.s", "1.2.3.4.5.6.7.8 999.1.1.1", "+1 (2) 3-4.5 67890", "+123456789@x.y", "4111-1111 1111-1111"]
    for text in odd + [r[1] for r in held]:
        assert pii.base_spans(text) == _by_patterns(text)


def test_parts_of_any_length(spark):
    for long in ("5" * 5000, "0" * 5000 + "9" * 4):
        assert not any(kind == "ip" for kind, *_ in pii.base_spans(f"{long}.1.1.1"))
    wide = "0" * 5000 + "9.1.1.1"
    assert pii.base_spans(wide) == [("ip", 0, len(wide))]
    frame = spark.createDataFrame([("5" * 5000 + ".1.1.1",)], "text string")
    assert frame.select(pii.digest(F.col("text"), pii.learn(frame.select(F.lit(1).alias("doc_id"), "text")))).count() == 1


def test_the_network_finds_what_it_was_taught(held):
    with_spans = [r[1] for r in held if pii.base_spans(r[1])]
    model = pii.fit(*pii._training_windows(with_spans[::2], 600))
    base = [pii.base_spans(t) for t in with_spans[1::2]]
    found = pii.model_spans(with_spans[1::2], model)
    hit = sum(s in own for wanted, own in zip(base, found, strict=True) for s in wanted)
    assert hit >= 0.5 * sum(map(len, base))


def test_pii_of_odd_rows(odd, empty):
    model = pii.learn(odd)
    rows = odd.select("doc_id", pii.digest(F.col("text"), model).alias("r"), pii.masked(F.col("text"), model).alias("m")).collect()
    seven = [r for r in rows if r.doc_id == 7]
    assert len(seven) == 2 and all((r.r.n_email, r.r.n_ip, r.r.n_card, r.r.n_phone) == (1, 1, 1, 1) for r in seven)
    assert all("[EMAIL]" in r.m and "@" not in r.m for r in seven)
    assert {r.m for r in rows if r.doc_id in (2, 3)} == {None, ""}
    assert pii.learn(empty).weights == {} and empty.select(pii.digest(F.col("text"), model)).count() == 0
