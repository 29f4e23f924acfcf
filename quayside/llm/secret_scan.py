"""Secrets by patterns, and by candidates that decode to a private key or a signed token.

The patterns give the base spans: assignments to a secret's name, access ids and runs of hex digits.
Structural confirmation adds spans.  A candidate is a run of base64 (over several lines, also those
written as ``\\n``) or of hex digits in either case.  It is reported only if what it decodes to parses
whole: a DER sequence whose nested lengths fill each other exactly and whose members are those of a
private key (PKCS#1, PKCS#8, encrypted PKCS#8, SEC 1, DSA, PKCS#12), an OpenSSH private key whose
length-prefixed parts fit, or an armoured text that holds one of these.  The outer length says where
the span ends, so what follows on the next line does no harm.  Three dotted parts are a signed token
if the first decodes to a JSON object naming its algorithm, the second to a JSON object, and the
signature has the length that the algorithm gives; a token for one reader (five parts) needs an
algorithm and an encryption in its header.  Certificates and public keys parse too, and are no secrets.

Defined results: null texts count as empty; an empty text has no spans and its digest is of the
empty string; rows are judged one by one, so repeated rows and ties have equal results, and an empty
table gives none.  Whole texts are read, of any length, in linear time.  Only the given column is
read.  Offsets are code points, ends exclusive; of spans with the same start the kind listed first
leads.  A confirmed span may overlap base ones.  DER of more than 65,535 bytes inside its first
header, and candidates that start in the middle of a run, are not looked at.
"""

from __future__ import annotations

import binascii
import hashlib
import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.llm.common import slices

BASE_KINDS = ("assign", "access", "hex")
#: What the structure confirms: an encoded private key, a signed or sealed token.
CONFIRMED_KINDS = ("key", "token")
KINDS = BASE_KINDS + CONFIRMED_KINDS

_ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Whether a text can have a span of each kind at all; a text may pass without having one.
_GATES = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6}""",
    "access": "AKIA[A-Z0-9]{16}",
    "hex": "[0-9a-f]{24}",
    "token": r"e[w-z][A-Za-z0-9_-]+\.[A-Za-z0-9_-]*\.",
    "base64": "(M[A-P]|b3BlbnNzaC1rZXktdjE|LS0tLS1CRUdJTi)[A-Za-z0-9+/]{14}",
    "hex_key": "(30|6[Ff]70656[Ee]7373682[Dd]|2[Dd]2[Dd]2[Dd]2[Dd]2[Dd]42)[0-9A-Fa-f]{32}",
}

_BASE64_START = re.compile(r"(?<![A-Za-z0-9+/])(?:M[A-P]|b3BlbnNzaC1rZXktdjE|LS0tLS1CRUdJTi)[A-Za-z0-9+/]{14}")
_BASE64_LINE = re.compile(r"[A-Za-z0-9+/]+")
_LINE_BREAK = re.compile(r"(?:\r?\n|(?:\\r)?\\n)[\x20\t]*")
_HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{40,}")
_TOKEN_START = re.compile(r"(?<![A-Za-z0-9_-])e[w-z][A-Za-z0-9_-]++(?=\.)")
_TOKEN_PARTS = re.compile(r"[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]*+){2,4}")
_ARMOUR = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----")

#: The magic of OpenSSH's private keys; object identifiers of password encryption
#: (1.2.840.113549.1.5 and .1.12) and of PKCS#7 data (1.2.840.113549.1.7), without tag and length;
#: signature bytes of the algorithms with one length.
_SSH_MAGIC = b"openssh-key-v1\x00"
_PBE = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c"))
_PKCS7 = bytes.fromhex("2a864886f70d0107")
_SIGNATURE_BYTES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES256K": 64, "ES384": 96, "ES512": 132}
_RSA_LEAST_BYTES = 128

#: Bytes of an encoded key at most, and how often a candidate may be wrapped in another encoding.
_MOST_BYTES, _WRAPS = 65_535 + 4, 2


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    form: str


# --- nested lengths -----------------------------------------------------------------------------


def _header(data: bytes, at: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the content of the element at a place; the end may lie beyond the data."""
    if at + 2 > len(data):
        return None
    tag, first = data[at], data[at + 1]
    if tag & 0x1F == 0x1F or first == 0x80 or first > 0x82:
        return None
    if first < 0x80:
        return tag, at + 2, at + 2 + first
    width = first & 0x7F
    if at + 2 + width > len(data):
        return None
    size = int.from_bytes(data[at + 2 : at + 2 + width], "big")
    # DER: the shortest form of a length is the only one.
    if size < 0x80 or (width == 2 and size < 0x100):
        return None
    return tag, at + 2 + width, at + 2 + width + size


def _members(data: bytes, start: int, end: int) -> list[tuple[int, bytes]] | None:
    """(tag, content) of the elements that fill the range exactly; none, if they do not."""
    found = []
    while start < end:
        head = _header(data, start)
        if head is None or head[2] > end:
            return None
        found.append((head[0], data[head[1] : head[2]]))
        start = head[2]
    return found


def _inside(content: bytes) -> list[tuple[int, bytes]] | None:
    return _members(content, 0, len(content))


def _is_algorithm(content: bytes, *prefixes: bytes) -> bool:
    members = _inside(content)
    return bool(members) and members[0][0] == 0x06 and (not prefixes or members[0][1].startswith(prefixes))


def _der_form(data: bytes) -> str | None:
    """What private key the DER sequence at the front of the data is."""
    head = _header(data, 0)
    if head is None or head[0] != 0x30 or head[2] > len(data):
        return None
    members = _members(data, head[1], head[2])
    if not members:
        return None
    tags = [tag for tag, _ in members]
    first = members[0][1]
    if tags[:9] == [0x02] * 9 and (len(tags) == 9 and first == b"\x00" or tags[9:] == [0x30] and first == b"\x01"):
        return "pkcs1" if len(members[1][1]) >= 32 and all(content for _, content in members[:9]) else None
    if tags == [0x02] * 6 and first == b"\x00" and len(members[1][1]) >= 32:
        return "dsa"
    if tags[:2] == [0x02, 0x04] and first == b"\x01" and set(tags[2:]) <= {0xA0, 0xA1} and 16 <= len(members[1][1]) <= 66:
        return "sec1" if all(_inside(content) for _, content in members[2:]) else None
    if tags[:3] == [0x02, 0x30, 0x04] and first in (b"\x00", b"\x01") and set(tags[3:]) <= {0xA0, 0x81, 0xA1}:
        return "pkcs8" if _is_algorithm(members[1][1]) and _inside(members[2][1]) else None
    if tags == [0x30, 0x04] and len(members[1][1]) >= 16:
        return "encrypted_pkcs8" if _is_algorithm(first, *_PBE) else None
    if tags[:2] == [0x02, 0x30] and first == b"\x03" and tags[2:] in ([], [0x30]):
        return "pkcs12" if _is_algorithm(members[1][1], _PKCS7) else None
    return None


def _ssh_end(data: bytes) -> int | None:
    """Where an OpenSSH private key ends whose length-prefixed parts all fit."""
    at = len(_SSH_MAGIC)

    def part() -> bytes | None:
        nonlocal at
        if at + 4 > len(data):
            return None
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return None
        at += 4 + size
        return data[at - size : at]

    cipher, derivation, options = part(), part(), part()
    if not cipher or not derivation or options is None or at + 4 > len(data):
        return None
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if not 1 <= keys <= 16 or not all(part() for _ in range(keys)):
        return None
    sealed = part()
    if not sealed or len(sealed) < 16 or len(sealed) % 8:
        return None
    # Without a cipher the sealed part starts with the same number twice.
    return at if cipher != b"none" or sealed[:4] == sealed[4:8] else None


def _key_at_front(data: bytes, wraps: int) -> tuple[str, int] | None:
    """Form and length in bytes of the key that the data begins with."""
    if data[:1] == b"\x30":
        form = _der_form(data)
        return (form, _header(data, 0)[2]) if form else None
    if data.startswith(_SSH_MAGIC):
        end = _ssh_end(data)
        return ("openssh", end) if end else None
    if wraps and data.startswith(b"-----BEGIN "):
        inner = data.decode("latin-1")
        if _ARMOUR.match(inner) and (found := next(_keys(inner, wraps - 1), None)):
            return f"armoured_{found.form}", len(data)
    return None


def _expected(front: bytes) -> int | None:
    """How many bytes have to be looked at, by the candidate's first bytes; none if it can be no key."""
    if front[:1] != b"\x30":
        return _MOST_BYTES
    head = _header(front, 0)
    if head is None or head[2] < 24 or len(front) <= head[1] or front[head[1]] not in (0x02, 0x30):
        return None
    return head[2]


def _base64(chars: str) -> bytes:
    chars = chars[: len(chars) - 1] if len(chars) % 4 == 1 else chars
    return binascii.a2b_base64(chars + "=" * (-len(chars) % 4))


def _base64_key(text: str, start: int, wraps: int) -> tuple[str, int] | None:
    """Form and end of the key whose base64 begins at a place, line after line."""
    wanted = _expected(_base64(text[start : start + 16]))
    if wanted is None:
        return None
    wanted_chars, lines, have, at = -(-wanted * 4 // 3), [], 0, start
    while have < wanted_chars and (line := _BASE64_LINE.match(text, at, at + wanted_chars - have)):
        lines.append(line.span())
        have, at = have + line.end() - line.start(), line.end()
        gap = _LINE_BREAK.match(text, at)
        at = gap.end() if gap else at
        if not gap:
            break
    found = _key_at_front(_base64("".join(text[a:b] for a, b in lines)), wraps)
    if found is None:
        return None
    form, size = found
    left = min(-(-size * 4 // 3), have)
    for a, b in lines:
        if left <= b - a:
            end = a + left
            break
        left -= b - a
    while end < len(text) and text[end] == "=" and (end - lines[-1][1]) < 2:
        end += 1
    return form, end


def _keys(text: str, wraps: int = _WRAPS) -> Iterator[Span]:
    """Encoded private keys, without overlaps, those in base64 first."""
    at = 0
    while start := _BASE64_START.search(text, at):
        found = _base64_key(text, start.start(), wraps)
        if found:
            yield Span("key", start.start(), found[1], found[0])
        at = found[1] if found else start.end()
    for run in _HEX_RUN.finditer(text):
        chars = run[0]
        front = bytes.fromhex(chars[:40])
        if not (front[:1] == b"\x30" or _SSH_MAGIC.startswith(front[:15]) or front.startswith(b"-----BEGIN ")):
            continue
        wanted = _expected(front)
        if wanted is None:
            continue
        own = chars[: 2 * wanted]
        found = _key_at_front(bytes.fromhex(own[: len(own) // 2 * 2]), wraps)
        if found:
            yield Span("key", run.start(), run.start() + 2 * found[1], found[0])


# --- signed tokens ------------------------------------------------------------------------------


def _decoded(part: str) -> bytes | None:
    if len(part) % 4 == 1:
        return None
    return binascii.a2b_base64(part.replace("-", "+").replace("_", "/") + "=" * (-len(part) % 4))


def _object(part: str) -> dict | None:
    content = _decoded(part)
    if not content:
        return None
    try:
        value = json.loads(content)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _token_form(parts: list[str]) -> tuple[str, int] | None:
    """Form and number of parts of the token that the dotted parts begin with."""
    header = _object(parts[0])
    algorithm = header.get("alg") if header else None
    if not isinstance(algorithm, str) or not algorithm:
        return None
    if len(parts) == 5 and isinstance(header.get("enc"), str):
        sizes = [_decoded(p) for p in parts[1:]]
        return ("sealed", 5) if None not in sizes and all(sizes[1:]) else None
    signature = _decoded(parts[2])
    if _object(parts[1]) is None or signature is None:
        return None
    if algorithm.lower() == "none":
        return ("unsigned", 3) if not signature else None
    if algorithm in _SIGNATURE_BYTES:
        return ("signed", 3) if len(signature) == _SIGNATURE_BYTES[algorithm] else None
    if algorithm[:2] in ("RS", "PS"):
        return ("signed", 3) if len(signature) >= _RSA_LEAST_BYTES else None
    return ("signed", 3) if signature else None


def _tokens(text: str) -> Iterator[Span]:
    at = 0
    while start := _TOKEN_START.search(text, at):
        at = start.end()
        whole = _TOKEN_PARTS.match(text, start.start())
        if whole and (found := _token_form(parts := whole[0].split("."))):
            at = start.start() + sum(map(len, parts[: found[1]])) + found[1] - 1
            yield Span("token", start.start(), at, found[0])


# --- texts --------------------------------------------------------------------------------------

_ALL = frozenset(_GATES)


def find(text: str | None, gates: frozenset[str] = _ALL) -> list[Span]:
    """All spans of a text, by start and then kind; ``gates`` are what the text can have."""
    found: list[Span] = []
    if not text:
        return found
    if "assign" in gates:
        found += (Span("assign", *m.span(), "pattern") for m in _ASSIGN.finditer(text) if len(m[1]) >= 6)
    if "access" in gates:
        found += (Span("access", *m.span(), "pattern") for m in _ACCESS.finditer(text))
    if "hex" in gates:
        found += (Span("hex", *m.span(), "pattern") for m in _HEX.finditer(text))
    if "base64" in gates or "hex_key" in gates:
        found += _keys(text)
    if "token" in gates:
        found += _tokens(text)
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def find_all(texts: pa.Array) -> Iterator[list[Span]]:
    """The spans of each text; patterns pass over whole slices first to see which texts can have any."""
    for part in slices(texts):
        part = pc.fill_null(part.cast(pa.string()), "")
        passed = {name: pc.match_substring_regex(part, gate).to_pylist() for name, gate in _GATES.items()}
        for row in range(len(part)):
            gates = frozenset(name for name, rows in passed.items() if rows[row])
            yield find(part[row].as_py(), gates) if gates else []


def spans(text: Column) -> Column:
    """An array of the text's spans: kind, start, end and the form that was recognised."""
    kind = "array<struct<kind: string, start: bigint, end: bigint, form: string>>"
    own = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("form", pa.string())]))

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([[s._asdict() for s in found] for found in find_all(texts)], own)

    return F.arrow_udf(run, kind)(text)


def masked(text: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first counts, and covers the rest."""

    def run(texts: pa.Array) -> pa.Array:
        out = []
        for own, found in zip(texts, find_all(texts), strict=True):
            own = own.as_py()
            if found:
                parts, done = [], 0
                for span in found:
                    if span.start >= done:
                        parts += [own[done : span.start], f"[{span.kind.upper()}]"]
                    done = max(done, span.end)
                own = "".join([*parts, own[done:]])
            out.append(own)
        return pa.array(out, pa.string())

    return F.arrow_udf(run, "string")(text)


def _joined(found: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in found)


def digest(text: Column) -> Column:
    """A struct of the spans' number by kind, the digest of the base spans, and all spans with their forms."""

    def run(texts: pa.Array) -> pa.Array:
        counts: list[list[int]] = [[] for _ in KINDS]
        sums, joined, forms = [], [], []
        for found in find_all(texts):
            for column, kind in zip(counts, KINDS, strict=True):
                column.append(sum(s.kind == kind for s in found))
            base = [s for s in found if s.kind in BASE_KINDS]
            sums.append(hashlib.sha256(_joined(base).encode()).hexdigest())
            joined.append(_joined(found))
            forms.append(",".join(s.form for s in found if s.kind in CONFIRMED_KINDS))
        return pa.StructArray.from_arrays(
            [*(pa.array(c, pa.int64()) for c in counts), *(pa.array(c, pa.string()) for c in (sums, joined, forms))],
            [*(f"n_{kind}" for kind in KINDS), "base_sha256", "spans", "forms"],
        )

    numbers = ", ".join(f"n_{kind}: bigint" for kind in KINDS)
    return F.arrow_udf(run, f"struct<{numbers}, base_sha256: string, spans: string, forms: string>").asNondeterministic()(text)
