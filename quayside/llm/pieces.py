"""SentencePiece encoding with byte spans, and decoding.

A text is normalised by the model's compiled character map: at each place the longest prefix that
the map knows is replaced, and every resulting character remembers the source bytes it came from.
The normalised text is cut before each run of blanks (no piece of such a vocabulary has a blank
after another character), and each part is merged by the vocabulary's scores.  Pieces are projected
through the alignment to spans of the source's UTF-8 bytes.  Of the byte pieces of a character
outside the vocabulary the last one has the character's span; the others' are empty.

Defined results: a null text counts as empty and has no ids; rows are encoded one by one, so
repeated rows get equal results; long texts and long words take time in proportion to their length
(words: times its logarithm).  Only the given column is read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from struct import pack as pack_ints

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.llm.common import slices, worker_wide, Remembered

BLANK = "▁"
_UNITS = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")


class CharacterMap:
    """The compiled map: a double array over UTF-8 bytes, followed by the replacements it points to."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little") if compiled else 0
        self._units = np.frombuffer(compiled, dtype="<u4", offset=4, count=size // 4).tolist() if size else []
        self._texts = compiled[4 + size :]

    def __bool__(self) -> bool:
        return bool(self._units)

    def longest(self, data: bytes, at: int) -> tuple[bytes, int]:
        """What the longest known prefix at this place becomes, and how many bytes it has (0: none is known)."""
        units, node = self._units, 0
        node ^= self._offset(units[0])
        found, length = b"", 0
        for k in range(at, len(data)):
            node ^= data[k]
            if node >= len(units) or units[node] & 0x800000FF != data[k]:
                break
            leaf = units[node] >> 8 & 1
            node ^= self._offset(units[node])
            if leaf:
                start = units[node] & 0x7FFFFFFF
                found, length = self._texts[start : self._texts.index(0, start)], k + 1 - at
        return found, length

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)


class Model:
    """A BPE model of the sentencepiece library, read from its file's bytes."""

    def __init__(self, content: bytes):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as format_

        proto = format_.ModelProto()
        proto.ParseFromString(content)
        kinds = [p.type for p in proto.pieces]
        if proto.trainer_spec.model_type != 2 or 4 in kinds or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("a BPE model without user-defined symbols and with leading blanks is needed")
        spec = proto.normalizer_spec
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.trim, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        normal = [(n, p.piece, p.score) for n, p in enumerate(proto.pieces) if p.type in (1, 5)]
        self.ids = {piece: n for n, piece, _ in normal}
        order = sorted(range(len(normal)), key=lambda k: -normal[k][2])
        self.rank, last, place = {}, None, -1
        for k in order:
            if normal[k][2] != last:
                last, place = normal[k][2], place + 1
            self.rank[normal[k][1]] = place
        self.unused = {p.piece for p in proto.pieces if p.type == 5}
        self.bytes_ = [proto_id.get(f"<0x{b:02X}>") for b in range(256)] if (
            proto_id := {p.piece: n for n, p in enumerate(proto.pieces) if p.type == 6}
        ) and proto.trainer_spec.byte_fallback else None
        self.unknown = kinds.index(2)
        self.shown = [p.piece.replace(BLANK, " ") if p.type in (1, 5) else "" for p in proto.pieces]
        self.shown[self.unknown] = proto.trainer_spec.unk_surface
        self.byte_of = {n: int(p.piece[3:5], 16) for n, p in enumerate(proto.pieces) if p.type == 6}
        self.whole_only = any(re.search(f"[^{BLANK}]{BLANK}", piece) for _, piece, _ in normal)
        self.numerals = [str(n) for n in range(len(proto.pieces))]
        self._widths = np.array([len(p.piece) if p.type in (1, 5) else 1 for p in proto.pieces], dtype=np.int64)
        #: Of byte pieces their byte with a mark above it, of others 0.
        self._bytes_at = np.zeros(len(proto.pieces), dtype=np.int64)
        for n, byte in self.byte_of.items():
            self._bytes_at[n] = 0x100 | byte
        self._units = Remembered(self.ids_of)
        #: Blanks become marks and nothing else changes: a word by itself is encoded as within a text.
        self._plain = self.prefix and self.escape and not (self.map or self.trim or self.whole_only)
        if self._plain:
            self._library = SentencePieceProcessor(model_proto=content)
            self._words = Remembered(lambda word: self.ids_of(BLANK + word))

    # Normalisation

    def normalize(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its characters the byte where its source begins; the end last."""
        if not text:
            return "", np.zeros(1, dtype=np.int64)
        if not self.map and not self.trim and self.escape:
            points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
            widths = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
            starts = np.concatenate([[0] * (1 + self.prefix), np.cumsum(widths)])
            return BLANK * self.prefix + text.replace(" ", BLANK), starts
        data, at = text.encode(), 0
        out: list[str] = []
        starts: list[int] = []

        def step(at: int) -> tuple[str, int]:
            found, length = self.map.longest(data, at) if self.map else (b"", 0)
            if length:
                return found.decode(), length
            length = 1 if data[at] < 0x80 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
            return data[at : at + length].decode(), length

        if self.trim:
            while at < len(data) and (taken := step(at))[0] == " ":
                at += taken[1]
            if at == len(data):
                return "", np.zeros(1, dtype=np.int64)
        blank = BLANK if self.escape else " "
        if self.prefix:
            out.append(blank)
            starts.append(at)
        after_blank = self.trim
        while at < len(data):
            made, length = step(at)
            if self.trim and after_blank:
                made = made.lstrip(" ")
            for c in made:
                out.append(blank if c == " " else c)
                starts.append(at)
            if made:
                after_blank = made.endswith(" ")
            if not self.trim:
                after_blank = False
            at += length
        if self.trim:
            while out and out[-1] == blank and len(out) > 1:
                at = starts.pop()
                out.pop()
        return "".join(out), np.array([*starts, at], dtype=np.int64)

    # Merging

    def merge(self, unit: str) -> list[str]:
        """The pieces of a unit: the best-scored neighbours are joined first, the leftmost of equals."""
        rank, parts = self.rank, list(unit)
        if len(parts) > 60:
            return self._merge_long(parts)
        none = 1 << 60
        scores = [rank.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while scores:
            best = min(scores)
            if best == none:
                break
            k = scores.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del scores[k]
            if k:
                scores[k - 1] = rank.get(parts[k - 1] + parts[k], none)
            if k < len(scores):
                scores[k] = rank.get(parts[k] + parts[k + 1], none)
        return parts

    def _merge_long(self, parts: list) -> list[str]:
        rank, size = self.rank, len(parts)
        before, after = list(range(-1, size - 1)), [*range(1, size), -1]
        heap = [(r, k, a + b) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if (r := rank.get(a + b)) is not None]
        heapq.heapify(heap)
        while heap:
            _, k, joined = heapq.heappop(heap)
            right = after[k]
            if parts[k] is None or right < 0 or parts[k] + parts[right] != joined:
                continue
            parts[k], parts[right] = joined, None
            after[k] = after[right]
            if after[right] >= 0:
                before[after[right]] = k
            for a, b in ((before[k], k), (k, after[k])):
                if a >= 0 and b >= 0 and (r := rank.get(parts[a] + parts[b])) is not None:
                    heapq.heappush(heap, (r, a, parts[a] + parts[b]))
        return [p for p in parts if p is not None]

    def _resolved(self, unit: str) -> list[str]:
        """Pieces, with those out of use taken apart again."""
        found = self.merge(unit)
        if not self.unused or not self.unused.intersection(found):
            return found

        def apart(piece: str) -> list[str]:
            if piece not in self.unused or len(piece) == 1:
                return [piece]
            lesser = Model.merge(_Without(self.rank, piece), piece)
            return [p for part in lesser for p in apart(part)]

        return [p for piece in found for p in apart(piece)]

    def ids_of(self, unit: str) -> bytes:
        """The ids of a unit, as little-endian integers."""
        ids = []
        for piece in self._resolved(unit):
            known = self.ids.get(piece)
            if known is not None:
                ids.append(known)
            elif self.bytes_:
                ids += [self.bytes_[b] for b in piece.encode()]
            else:
                ids.append(self.unknown)
        return pack_ints(f"<{len(ids)}I", *ids)

    # Whole texts

    def prepare(self, texts: list[str | None]) -> None:
        """Have the words of plain texts merged at one go by the library, where normalising changes only blanks."""
        self._units.settle()
        if not self._plain:
            return
        self._words.settle()
        words = set()
        for text in texts:
            if text and BLANK not in text:
                words.update(text.split(" "))
        words.discard("")
        fresh = self._words.unknown(words)
        for word, ids in zip(fresh, self._library.encode(fresh, num_threads=1), strict=True):
            self._words[word] = pack_ints(f"<{len(ids)}I", *ids)

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The ids, and the byte places of the source where the pieces begin and the last one ends."""
        text = text or ""
        normal, starts = self.normalize(text)
        if not normal:
            return np.zeros(0, dtype="<u4"), starts
        if self._plain and BLANK not in text and "" not in (words := text.split(" ")):
            found = b"".join(map(self._words.__getitem__, words))
        elif self.whole_only:
            found = self._units[normal]
        else:
            found = b"".join(map(self._units.__getitem__, _UNITS.findall(normal)))
        ids = np.frombuffer(found, dtype="<u4")
        widths = self._widths[ids]
        if (own := self._bytes_at[ids]).any():
            # Of a character's bytes only the last one stands for it.
            widths = np.where(np.append(own[1:] & 0x1C0 == 0x180, False) & (own > 0), 0, widths)
        return ids, starts[np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(widths)])]

    def decode(self, ids: list[int]) -> str:
        """What the library's decoder makes of the ids."""
        if self.byte_of and not self.byte_of.keys().isdisjoint(ids):
            parts, held = [], bytearray()
            for n in ids:
                if n in self.byte_of:
                    held.append(self.byte_of[n])
                    continue
                if held:
                    parts.append(_text_of(bytes(held)))
                    held.clear()
                parts.append(self.shown[n])
            text = "".join(parts) + (_text_of(bytes(held)) if held else "")
        else:
            text = "".join(map(self.shown.__getitem__, ids))
        return text[1:] if (self.prefix or self.trim) and text.startswith(" ") else text


class _Without:
    """A model's ranks without one piece, to see what it was made of."""

    def __init__(self, rank: dict, piece: str):
        self.rank = {k: v for k, v in rank.items() if k != piece} if piece in rank else rank

    _merge_long = Model._merge_long


def _text_of(data: bytes) -> str:
    """Bytes as text; each byte that belongs to no character becomes U+FFFD."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(data):
            for width in (4, 3, 2, 1):
                try:
                    out.append(data[at : at + width].decode())
                    at += width
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


def encode(text: Column, content: bytes) -> Column:
    """A struct of ``ids``, ``starts`` and ``ends`` (bytes of the source) and ``decoded``; ``content``: the model file."""

    memory = worker_wide(lambda: Model(content))

    def run(texts: pa.Array) -> pa.Array:
        model, empty = memory(), np.zeros(0, dtype=np.int32)
        counts, ids, starts, ends, shown = [0], [empty], [empty], [empty], []
        for part in slices(texts):
            listed = part.to_pylist()
            model.prepare(listed)
            for text in listed:
                own, places = model.encode(text)
                counts.append(len(own))
                ids.append(own)
                starts.append(places[:-1] if len(own) else empty)
                ends.append(places[1:] if len(own) else empty)
                shown.append(model.decode(own.tolist()))
        offsets = pa.array(np.cumsum(counts), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x).astype(np.int32))) for x in (ids, starts, ends)]
        return pa.StructArray.from_arrays([*lists, pa.array(shown, pa.string())], ["ids", "starts", "ends", "decoded"])

    kind = "struct<ids: array<int>, starts: array<int>, ends: array<int>, decoded: string>"
    return F.arrow_udf(run, kind).asNondeterministic()(text)


def digest(text: Column, content: bytes) -> Column:
    """Of the same encoding: ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and ``covered``, the bytes that the spans cover."""

    memory = worker_wide(lambda: Model(content))

    def run(texts: pa.Array) -> pa.Array:
        model = memory()
        counts, sums, shown, covered = [], [], [], []
        for part in slices(texts):
            listed = part.to_pylist()
            model.prepare(listed)
            for text in listed:
                ids, places = model.encode(text)
                own = ids.tolist()
                counts.append(len(own))
                covered.append(int(places[-1] - places[0]))
                sums.append(hashlib.sha256(",".join(map(model.numerals.__getitem__, own)).encode()).hexdigest())
                shown.append(hashlib.sha256(model.decode(own).encode()).hexdigest())
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(sums, pa.string()), pa.array(shown, pa.string()), pa.array(covered, pa.int64())],
            ["n_tokens", "ids_sha256", "decoded_sha256", "covered"],
        )

    kind = "struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string, covered: bigint>"
    return F.arrow_udf(run, kind).asNondeterministic()(text)
