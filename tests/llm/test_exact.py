import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import fingerprint, licenses, neardup, packing, pieces, topk
from quayside.llm.queries import BYTE_TOKENIZER, PIECE_MODEL, QUERIES

ODD_TEXTS = [
    "", " ", "  ", "a  b", "▁a", "a ▁b", "\n", "é\x00z", "日本", "a b  c​", "😀 😀x", " lead", "trail ", "x" * 300,
    "a <|endoftext|> b", "x<|endoftext|>", "\n\n a", "a\n b\n\n\nc", "don't I'll \"'s", "\u0085 a \x1c b",
]


def _model():
    with open(PIECE_MODEL, "rb") as file:
        return pieces.Model(file.read())


def test_pieces_equal_the_library(texts):
    import sentencepiece

    model, library = _model(), sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    for text in ODD_TEXTS + list(texts.values()):
        model.prepare([text])
        ids, places = model.encode(text)
        wanted = library.encode(text)
        assert ids.tolist() == wanted and model.decode(wanted) == library.decode(wanted)
        if text:
            assert places[0] == 0 and places[-1] == len(text.encode()) and (np.diff(places) >= 0).all()
    # The same by this package's own merging.
    model._plain = False
    for text in ODD_TEXTS + list(texts.values())[:40]:
        assert model.encode(text)[0].tolist() == library.encode(text)


def test_spans_are_those_of_the_pieces():
    model, text = _model(), "Grüße an 日本 😀!"
    ids, places = model.encode(text)
    data = text.encode()
    parts = [data[a:b] for a, b in zip(places, places[1:], strict=False)]
    assert b"".join(parts) == data
    for n, part in zip(ids.tolist(), parts, strict=True):
        if n not in model.byte_of:
            assert part.decode() in (model.shown[n], model.shown[n].lstrip(" "))


def test_normalising_takes_the_longest_prefix():
    import sentencepiece

    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    from sentencepiece import sentencepiece_model_pb2 as format_

    spec = format_.NormalizerSpec()
    spec.ParseFromString(library.serialized_normalizer_spec())
    table = pieces.CharacterMap(spec.precompiled_charsmap)
    model = _model()
    model.map, model.trim, model._plain = table, spec.remove_extra_whitespaces, False
    model.prefix, model.escape = spec.add_dummy_prefix, spec.escape_whitespaces
    for text in ["ﬁ Ａ①  x㍿", "  a  b ", "é é", "ｶﾞ", "", " ", "plain text"]:
        normal, starts = model.normalize(text)
        assert normal == library.normalize(text)
        assert len(starts) == len(normal) + 1 and (np.diff(starts) >= 0).all()


def test_pieces_of_odd_rows(odd, empty):
    with open(PIECE_MODEL, "rb") as file:
        content = file.read()
    rows = odd.select("text", pieces.digest(F.col("text"), content).alias("r"), pieces.encode(F.col("text"), content).alias("e")).collect()
    for r in rows:
        assert r.r.n_tokens == len(r.e.ids) == len(r.e.starts) == len(r.e.ends)
        assert r.r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
        assert r.r.covered == len((r.text or "").encode())
    assert empty.select(pieces.digest(F.col("text"), content)).count() == 0


def test_packing_is_whole_and_tight(spark, documents, odd, texts):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(BYTE_TOKENIZER)
    rows = packing.pack(spark, documents, BYTE_TOKENIZER, with_ids=True).collect()
    bins = defaultdict(list)
    own = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
        own[r.doc_id].append(r)
        assert r.length == len(r.ids) <= 1024
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    for doc_id, text in texts.items():
        parts = sorted(own[doc_id], key=lambda r: r.piece)
        assert [i for r in parts for i in r.ids] == whole.encode(text, add_special_tokens=False).ids + [2]
        assert [r.start for r in parts] == np.cumsum([0, *(r.length for r in parts[:-1])]).tolist()
        assert all(r.length == 1024 for r in parts[1:])
    total = sum(r.length for r in rows)
    assert len(bins) <= -(-total // 1024) + 2
    empties = [r for r in packing.pack(spark, odd, BYTE_TOKENIZER).collect() if r.doc_id in (2, 3)]
    assert [(r.length, r.piece, r.start) for r in empties] == [(1, 0, 0)] * 2
    assert packing.pack(spark, odd.limit(0), BYTE_TOKENIZER).count() == 0


def test_words_encode_as_whole_texts():
    from tokenizers import Tokenizer

    with open(BYTE_TOKENIZER) as file:
        content = file.read()
    whole, own = Tokenizer.from_str(content), packing.ByteEncoder(content)
    for text in ODD_TEXTS:
        assert np.frombuffer(own(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(5))
def test_plan_uses_every_piece_once(seed):
    pick = random.Random(seed)
    counts = Counter(pick.choice([pick.randint(1, 64), pick.randint(1, 16), 64]) for _ in range(500))
    lines = packing.plan(counts, 64)
    for size, count in counts.items():
        ranks = sorted(tuple(line[1:3]) for line in lines if line[0] == size)
        assert ranks[0][0] == 0 and ranks[-1][1] == count
        assert all(a[1] == b[0] for a, b in zip(ranks, ranks[1:], strict=False))
    total = sum(size * count for size, count in counts.items())
    assert max(line[3] + line[2] - line[1] for line in lines) <= 1.03 * total / 64 + 2


def test_two_replace_the_smallest_when_tighter():
    # Greedily 6 + 3 leaves 1; instead of the 3 two pieces of 2 fill the bin.
    assert packing.fill({6: 1, 3: 1, 2: 2}, 10) == [6, 2, 2]


def _components(rows, words, percent):
    """Brute force over all pairs."""
    sets = {}
    for doc_id, text in rows:
        own = (text or "").encode().lower().split()
        found = {tuple(own[k : k + words]) for k in range(len(own) - words + 1)} or ({tuple(own)} if own else set())
        sets[doc_id] = found
    label = {doc_id: doc_id for doc_id in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {doc_id: (len(sets[doc_id]), root(doc_id)) for doc_id in ids}


def _copies():
    """Groups of near copies at all degrees, chains, equal copies, and other texts."""
    pick = random.Random(4)
    word = lambda: "".join(pick.choice("abcdefgh") for _ in range(4))
    rows = []
    for group in range(12):
        base = [word() for _ in range(pick.choice([3, 8, 20, 60, 200]))]
        for _ in range(pick.choice([2, 5, 40])):
            copy = [word() if pick.random() < pick.choice([0, 0.01, 0.03, 0.06]) else w for w in base]
            rows.append((len(rows), " ".join(copy)))
            if group % 3 == 0:
                base = copy
    return rows


def test_links_equal_brute_force(spark):
    rows = _copies()
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for words, percent in ((3, 85), (5, 80)):
        found = neardup.link(spark, frame, words=words, percent=percent).collect()
        wanted = _components(rows, words, percent)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == wanted
        assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(neardup, "_BLOCK", 7)
    test_links_equal_brute_force(spark)


def test_links_of_documents(spark, documents, texts):
    found = neardup.link(spark, documents, words=3, percent=85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == _components(texts.items(), 3, 85)


def test_links_of_odd_rows(spark, odd, empty):
    found = neardup.link(spark, odd).collect()
    assert len(found) == odd.count()
    of = defaultdict(set)
    for r in found:
        of[r.doc_id].add((r.n_shingles, r.component_id, r.kept))
    assert of[4] == {(10, 1, False)} and of[1] == {(10, 1, True)}
    assert of[2] == {(0, 2, True)} and len(of[7]) == 1
    assert {(c, k) for _, c, k in of[None]} == {(None, True)}
    assert neardup.link(spark, empty).count() == 0


def _edited(rows):
    """(id, text, next text) in order of falling ids, by a plain loop."""
    rows = sorted(rows, key=lambda r: -r[0])
    return [(i, t or "", rows[(k + 1) % len(rows)][1] or "") for k, (i, t) in enumerate(rows)]


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_fingerprints_in_order(spark, documents, texts, partitions):
    found = {r.doc_id: r for r in fingerprint.compare_in_order(documents, partitions=partitions).collect()}
    wanted = _edited(texts.items())
    assert len(found) == len(wanted)
    walk = lambda t: fingerprint.walk([fingerprint.classes(t)])[0]
    for i, text, follows in wanted:
        cut = len(text) // 3
        edited = text[: len(text) - cut] + follows[:cut]
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        if i % 10 == 0:
            assert r.fingerprint == walk(text).text() and r.edited_fingerprint == walk(edited).text()
            assert r.near_edited == walk(text).likeness(walk(edited)) and r.near_next == walk(text).likeness(walk(follows))
    assert np.mean([r.near_edited > r.near_next for r in found.values()]) > 0.98


def test_a_walk_by_single_steps():
    """The definition, one character and step at a time."""
    for text in ("", "a", "abc" * 30, "the quick brown fox " * 200):
        own, at, step, notes, level = fingerprint.classes(text), 0, 0, [], fingerprint.level_of(len(text))
        while at < len(own):
            if fingerprint.levels(np.array([step]))[0] >= level:
                notes.append(int(fingerprint._NOTES_AT[own[at]]) & 15)
            at += int(fingerprint._MOVES[step % fingerprint._PERIOD][own[at]])
            step += 1
        assert fingerprint.walk([own])[0].notes.tolist() == notes


def test_fingerprints_of_odd_rows(odd, empty):
    rows = fingerprint.compare_in_order(odd, partitions=3).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    by = defaultdict(set)
    for r in rows:
        by[r.doc_id].add((r.n_chars, r.fingerprint))
    assert len(by[7]) == 1 and by[2] == by[3] == {(0, "00:")}
    assert all(r.near_next == 1 for r in rows if r.doc_id is None)
    assert fingerprint.compare_in_order(empty).count() == 0


def test_similar_documents(spark, documents, odd):
    base = documents.where("doc_id < 60 AND length(text) > 600").select("doc_id", "text")
    near = base.select((F.col("doc_id") + 1000).alias("doc_id"), F.expr("substring(text, 1, length(text) - 12)").alias("text"))
    found = {r.doc_id: r for r in fingerprint.similar(spark, base.union(near)).collect()}
    assert np.mean([found[i].class_id == found[i - 1000].class_id for i in found if i >= 1000]) > 0.9
    assert fingerprint.similar(spark, odd.limit(0)).count() == 0


def _near_texts():
    """Strangers with a shared start, short texts, chains of edits, and repeated ids."""
    pick = random.Random(9)
    word = lambda: "".join(pick.choice("abcdefghijklmnop") for _ in range(pick.randint(2, 8)))
    rows = []
    for group in range(40):
        base = list(" ".join(word() for _ in range(pick.choice([2, 4, 10, 40, 90, 300]))))
        if group % 2:
            base = list("shared boilerplate that starts many texts, all rights reserved " * 2) + base
        for _ in range(pick.choice([1, 3, 8])):
            copy = list(base)
            for _ in range(pick.choice([0, 1, 2, 4]) * (1 + len(base) // 400)):
                copy[pick.randrange(len(copy))] = pick.choice("xyz ")
            rows.append((500 - len(rows) // 2 * 2 if group % 7 == 0 else 500 - len(rows), "".join(copy)))
            if group % 3 == 0:
                base = copy
    return rows


def _like_components(rows):
    """The least id of each text's class, by brute force over all pairs of fingerprints."""
    notes = {t: fingerprint.walk([fingerprint.classes(t)])[0] for _, t in rows}
    prints = {n.text(): n for n in notes.values()}
    label = {p: p for p in prints}

    def root(p):
        while label[p] != p:
            p = label[p]
        return p

    for a in prints:
        for b in prints:
            if a < b and prints[a].likeness(prints[b]) >= fingerprint.LEAST_LIKENESS:
                label[root(a)] = root(b)
    least = defaultdict(lambda: 10**9)
    for i, t in rows:
        own = root(notes[t].text())
        least[own] = min(least[own], i)
    return sorted((i, least[root(notes[t].text())]) for i, t in rows)


@pytest.mark.parametrize("members", [512, 5])
def test_similar_equals_brute_force(spark, monkeypatch, members):
    monkeypatch.setattr(fingerprint, "_MEMBERS", members)
    rows = _near_texts()
    found = fingerprint.similar(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    wanted = _like_components(rows)
    assert len({c for _, c in wanted}) < len(rows) - 20
    assert sorted((r.doc_id, r.class_id) for r in found) == wanted


def test_the_query_links_its_fingerprints(spark, odd, empty):
    rows = QUERIES["op1_fingerprints"](spark, "/root/testdata/sf0.001").collect()
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    wanted = {(r.doc_id, r.class_id, r.joining_links) for r in fingerprint.similar(spark, documents).collect()}
    assert {(r.doc_id, r.class_id, r.joining_links) for r in rows} == wanted and len(rows) == documents.count()
    assert any(r.joining_links for r in rows) and any(r.class_id < r.doc_id for r in rows)
    rows = fingerprint.compare_and_link(spark, odd, partitions=3).collect()
    assert len(rows) == odd.count() and {(r.class_id, r.joining_links) for r in rows if r.doc_id is None} == {(None, 0)}
    assert {r.class_id for r in rows if r.doc_id in (2, 3)} == {2} and {r.class_id for r in rows if r.doc_id == 7} == {7}
    assert fingerprint.compare_and_link(spark, empty).count() == 0


def test_alike_by_pairs():
    prints = [n for n in fingerprint.walk([fingerprint.classes(t) for _, t in _near_texts()])]
    lines = fingerprint._Lines(prints)
    for k, a in enumerate(prints):
        others = np.array([n for n in range(len(prints)) if n != k])
        assert sorted(lines.like(k, others, 0.5).tolist()) == [n for n in others.tolist() if a.likeness(prints[n]) >= 0.5]


def test_topk_equals_brute_force(spark):
    pick = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in pick.normal(0, 0.2, 9)]) for i in range(700)]
    rows += [(700, rows[0][1]), (701, rows[0][1]), (702, None), (703, [None] * 9), (704, [float("nan")] + [0.0] * 8)]
    rows += [(None, rows[0][1]), (705, [float("inf")] + [0.0] * 8), (750, [1.0, 2.0]), (751, [1.0, 2.0]), (0, rows[0][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = defaultdict(list)
    for r in topk.search(frame, F.col("id") % 50 == 0).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    valid = [(i, np.floor(256.0 * np.array(v, dtype=np.float32).astype(float)).astype(int)) for i, v in rows if i is not None and v and np.isfinite(np.array(v, dtype=float)).all()]
    for q, v in {i: v for i, v in valid if i % 50 == 0}.items():
        scores = sorted((-int(v @ w), i) for i, w in valid if i != q and len(w) == len(v))[:5]
        assert found[q] == [(k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert topk.search(frame.limit(0), F.col("id") % 50 == 0).count() == 0


@pytest.mark.parametrize("left_out", [0, 1, 4])
def test_blocks_of_any_quantisation(left_out):
    pick = np.random.default_rng(left_out)
    vectors, ids = pick.integers(-40, 40, (300, 6)), np.arange(300)
    vectors[100:200] = vectors[0]
    block = topk.Block(ids, vectors, left_out)
    for q, (found, scores) in zip(ids[:20], block.best(ids[:20], vectors[:20], 5), strict=True):
        wanted = sorted((-int(vectors[q] @ v), i) for i, v in enumerate(vectors) if i != q)[:5]
        assert list(zip((-scores).tolist(), found.tolist(), strict=True)) == wanted


@pytest.fixture(scope="module")
def license_model():
    return licenses.fit([f"some ordinary words number {k} and more of them" for k in range(200)])


def test_license_scan(spark, odd, empty, license_model):
    texts = [(k, f"intro\n{t}\nnothing here") for k, (_, t) in enumerate((f, t) for f in licenses.TEMPLATES for t in licenses.TEMPLATES[f])]
    wanted = [f for f in licenses.TEMPLATES for _ in licenses.TEMPLATES[f]]
    frame = spark.createDataFrame([*texts, (900, "we released the public album"), (901, None), (902, "")], "doc_id long, text string")
    rows = licenses.scan(frame, license_model).collect()
    found = {r.doc_id: r for r in rows if r.doc_id < 900}
    assert [found[k].family for k in range(len(wanted))] == wanted
    assert {(r.paragraph, r.lines) for r in found.values()} == {(1, 1)} and len(found) == len([r for r in rows if r.doc_id < 900])
    assert {r.family for r in rows if r.doc_id >= 900} == {licenses.UNKNOWN}
    assert licenses.scan(odd, license_model).count() == 0 and licenses.scan(empty, license_model).count() == 0


def test_wrapped_notices_are_found(spark, license_model):
    """At any width, down to a word a line, as one row each and without rows for their lines."""
    import textwrap

    templates = [(f, t) for f in licenses.TEMPLATES for t in licenses.TEMPLATES[f] if len(t) > 60]
    texts, wanted = [], []
    for family, template in templates:
        for mark, width in (("", 1), ("", 40), ("", 75), (" * ", 50), ("# ", 70), ("// ", 80)):
            wrapped = [mark + line for line in textwrap.wrap(template, width, break_long_words=False)]
            texts.append((len(texts), "\n".join(["an intro", "", *wrapped, mark, "nothing here"])))
            wanted.append((family, 2, len(wrapped)))
    cut = '\n'.join(["Redistribution and use in source and binary forms, with or", "", "without modification, are permitted provided that the following conditions are met:"])
    texts += [(900, cut), (901, "All of it is new\nand no rights are\n" + "word " * 40 + "\nreserved for them")]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    found = defaultdict(list)
    for r in licenses.scan(frame, license_model).collect():
        found[r.doc_id].append((r.family, r.paragraph, r.lines))
    # A notice may be confirmed without its first or last words, when they are on lines of their own.
    for k, (family, first, lines) in enumerate(wanted):
        ((own, at, count),) = [row for row in found[k] if row[0] != licenses.UNKNOWN]
        assert own == family and first <= at and at + count <= first + lines and count >= 0.8 * lines - 1
    assert {row[0] for k in (900, 901) for row in found[k]} <= {licenses.UNKNOWN}


def _plain_notices(text, judge):
    """Word after word around every key word; then the classifier and the order."""
    words = []
    for number, line in enumerate(text.split("\n")):
        own = licenses.words_of(line)
        words += [(w, number) for w in own] or [(None, number)]
    found = []
    for template in licenses.templates():
        own = set(template.words)
        for p, (word, _) in enumerate(words):
            if word not in template.keys:
                continue
            seen, last, gap, end = set(), p, 0, p
            while end < min(len(words), p + template.most) and words[end][0] is not None and gap <= licenses.GAP:
                new = words[end][0] in own - seen
                seen |= {words[end][0]} & own
                last, gap = (end, 0) if new else (last, gap + 1)
                end += 1
            first, gap, start = p, 0, p - 1
            while start >= max(0, last + 1 - template.most) and words[start][0] not in (None, *template.keys) and gap <= licenses.GAP:
                new = words[start][0] in own - seen
                seen |= {words[start][0]} & own
                first, gap = (start, 0) if new else (first, gap + 1)
                start -= 1
            if len(seen) >= template.need:
                found.append((first, -len(template.words), -last))
    kept = []
    for start, _, end in sorted(found):
        if not kept or kept[-1][1] < start:
            kept.append((start, -end))
    out = []
    for start, end in kept:
        own = [w for w, _ in words[start : end + 1]]
        family, chance = judge(own)
        shares = [len(set(t.words) & set(own)) / len(t.words) for t in licenses.templates() if t.family == family]
        if chance >= licenses.LEAST_CHANCE and max(shares, default=0) >= licenses.CONFIRMS:
            out.append((words[start][1], words[end][1] - words[start][1] + 1, family))
    return out


def test_notices_equal_brute_force(spark, license_model):
    import textwrap

    place = {g: n for n, g in enumerate(license_model.grams)}

    def judge(words):
        row = np.zeros(len(place))
        row[[place[g] for g in licenses._grams(words) if g in place]] = 1
        logits = row @ np.round(license_model.weights, 6) + np.round(license_model.bias, 6)
        return license_model.families[int(logits.argmax())], 1 / np.exp(logits - logits.max()).sum()

    random_ = random.Random(12)
    every = [t for own in licenses.TEMPLATES.values() for t in own]
    stray = sorted({w for t in every for w in licenses.words_of(t)}) + ["x", "y", "z"] * 40
    texts = []
    for _ in range(150):
        parts = []
        for _ in range(random_.randrange(1, 6)):
            words = random_.choice(every).split() if random_.random() < 0.7 else random_.choices(stray, k=random_.randrange(1, 40))
            if random_.random() < 0.5:
                words = [w for w in words if random_.random() > 0.06]
            if random_.random() < 0.3:
                words = [w for own in words for w in ([own, random_.choice(stray)] if random_.random() < 0.3 else [own])]
            parts.append("\n".join(textwrap.wrap(" ".join(words), random_.choice([1, 15, 60, 500]))))
        texts.append(random_.choice(["\n", " ", "\n\n", "\n--\n"]).join(parts))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = defaultdict(list)
    for r in licenses.scan(frame, license_model).collect():
        if r.family != licenses.UNKNOWN:
            found[r.doc_id].append((r.paragraph, r.lines, r.family))
    for k, text in enumerate(texts):
        assert sorted(found[k]) == sorted(_plain_notices(text, judge)), text
    assert sum(map(len, found.values())) > 150


def test_unknown_lines_lie_outside_of_notices(spark, license_model):
    notice = "Licensed under the\nMIT License.\nall\nrights"
    (row, *rest) = sorted(licenses.scan(spark.createDataFrame([(1, notice)], "doc_id long, text string"), license_model).collect(), key=lambda r: r.paragraph)
    assert (row.family, row.paragraph, row.lines) == ("MIT", 0, 2)
    assert [(r.family, r.paragraph) for r in rest] == [(licenses.UNKNOWN, 3)]


@pytest.mark.parametrize("line", ["all rights of them are reserved by licence", "license mit software public", "word " * 9, "Permission is hereby granted, free of charge, to any person"])
def test_texts_of_many_lines_are_scanned_in_linear_time(spark, license_model, line):
    import time

    frame = spark.createDataFrame([(1, "\n".join([line] * 20_000))], "doc_id long, text string")
    start = time.perf_counter()
    licenses.scan(frame, license_model).write.format("noop").mode("overwrite").save()
    assert time.perf_counter() - start < 60


def test_key_words_cannot_all_be_missed():
    known = licenses.templates()
    for t in known:
        assert len(t.keys) == len(t.words) - t.need + 1 and set(t.keys) <= set(t.words) and len(t.words) < 63
    assert {w for t in known for w in t.keys} <= set(licenses.anchors())


def test_license_scan_is_native(documents):
    plan = licenses.scan(documents, licenses.fit(["a b c"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
