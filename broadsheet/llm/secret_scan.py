"""Secrets in texts: three plain patterns, and encoded keys and signed tokens confirmed by their structure.

The plain findings are ``assign`` (a value given to a password, secret, token or API
key), ``access`` (access key ids) and ``hex`` (long runs of lower-case hex digits). The
others are reported only when the decoded bytes have the form of a secret:

    der      a private key in DER, written in base64 (in one line or wrapped) or hex
    ssh      a private key of OpenSSH, likewise
    token    a signed or encrypted JSON web token
    wrapped  base64 or hex of a text in armour, which itself holds a ``der`` or ``ssh``

A DER candidate states its length in its first bytes; so many characters are taken, no
run of its alphabet may go on behind them, and every length inside must fill its parent
exactly. PKCS#1, DSA, SEC1, PKCS#8 (plain, encrypted), and PKCS#12 count; the inner key of
PKCS#8 is parsed as well. Public keys and certificates are no secrets. An OpenSSH key
must hold its nested strings, and its two check numbers agree if it is not encrypted. A
token's header must be a JSON object whose ``alg`` is known and whose signature has that
algorithm's size, or have ``alg`` and ``enc`` and five parts. Tokens with ``alg`` none,
keys whose stated length takes more than two octets, PGP packets and encrypted PEM bodies of the old
kind (not DER) are not confirmed.

A text is searched in time linear in its length. Each row is one Python call on its
own text; nothing is shuffled.

Defined cases: a null or empty text has no spans; rows repeated in full are each
searched; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import tune

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "der", "ssh", "token", "wrapped")
SPANS = "array<struct<kind:string,start:int,end:int,detail:string>>"


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# fixed: the plain patterns; letters of the words in either case, ASCII only
_WORDS = "|".join([*map(_either_case, ("password", "passwd", "secret", "token")), _either_case("api") + "_?" + _either_case("key")])
ASSIGN = re.compile(rf"(?:{_WORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_VALUE = 8


def _at_run_start(literal: str) -> re.Pattern:
    return re.compile(f"{literal}(?<![A-Za-z0-9+/]{literal})")


# candidates do not start inside a word; a leading literal lets the search skip ahead
DER_START = re.compile(r"M(?<![A-Za-z0-9]M)[A-P][A-Za-z0-9+/_-]{6}")  # 0x30 and a length
HEX_DER = re.compile(r"30(?<![0-9A-Fa-f]30)[0-9A-Fa-f]{30,}")
SSH_MAGIC = b"openssh-key-v1\0"
SSH_START = _at_run_start(base64.b64encode(SSH_MAGIC).decode())
HEX_SSH = re.compile(f"(?i:{SSH_MAGIC.hex()})[0-9A-Fa-f]+")
TOKEN = re.compile(r"e(?<![A-Za-z0-9_-]e)[w-z0-9_-][A-Za-z0-9_-]{6,}+(?:\.[A-Za-z0-9_-]*+){2,4}")
ARMOUR = _at_run_start(base64.b64encode(b"-----BEGIN").decode()[:13])
HEX_ARMOUR = re.compile(f"(?i:{b'-----BEGIN'.hex()})[0-9A-Fa-f]+")
RUNS = re.compile(r"[A-Za-z0-9+/]+"), re.compile(r"[A-Za-z0-9_-]+")  # the two alphabets of base64
BREAK = re.compile(r"(?:\\[rn]|[\r\n\t\x20])+")

# fixed: object identifiers of key algorithms
OIDS = {
    "1.2.840.113549.1.1.1": "rsa",
    "1.2.840.113549.1.1.10": "rsa-pss",
    "1.2.840.10040.4.1": "dsa",
    "1.2.840.113549.1.3.1": "dh",
    "1.2.840.10045.2.1": "ec",
    "1.3.101.110": "x25519",
    "1.3.101.111": "x448",
    "1.3.101.112": "ed25519",
    "1.3.101.113": "ed448",
}
ENCRYPTION = ("1.2.840.113549.1.5.", "1.2.840.113549.1.12.1.")  # password-based schemes
# fixed: bytes of a signature by algorithm; RSA signatures have the size of the key
SIGNATURES = {
    "HS256": (32,), "HS384": (48,), "HS512": (64,),
    "ES256": (64,), "ES256K": (64,), "ES384": (96,), "ES512": (132,), "EdDSA": (64, 114),
    **{f"{a}{n}": (128, 256, 384, 512, 1024) for a in ("RS", "PS") for n in (256, 384, 512)},
}

INTEGER, BITS, OCTETS, OID, SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30


class _Malformed(ValueError):
    pass


def _header(data: bytes, at: int) -> tuple[int, int, int]:
    """Tag, start and end of the content of the element at a position."""
    if at + 2 > len(data):
        raise _Malformed
    tag, size, start = data[at], data[at + 1], at + 2
    if size >= 0x80:
        n = size - 0x80
        if not 1 <= n <= 2 or start + n > len(data):
            raise _Malformed
        size, start = int.from_bytes(data[start : start + n], "big"), start + n
    return tag, start, start + size


def _elements(data: bytes, start: int, end: int) -> list[tuple[int, int, int]]:
    """The elements that fill a range exactly."""
    out = []
    while start < end:
        element = _header(data, start)
        if element[2] > end:
            raise _Malformed
        out.append(element)
        start = element[2]
    return out


def _well_formed(data: bytes, start: int, end: int) -> None:
    """Every constructed element inside a range is filled exactly."""
    todo = [(start, end)]
    while todo:
        for tag, a, b in _elements(data, *todo.pop()):
            if tag & 0x20:
                todo.append((a, b))


def _oid(data: bytes, element: tuple[int, int, int]) -> str:
    tag, start, end = element
    if tag != OID or start == end:
        raise _Malformed
    arcs, value = [], 0
    for b in data[start:end]:
        value = value << 7 | b & 0x7F
        if not b & 0x80:
            arcs.append(value)
            value = 0
    first = min(arcs[0] // 40, 2) if arcs else 0
    return ".".join(map(str, [first, arcs[0] - 40 * first, *arcs[1:]])) if arcs else ""


def _numbers(data: bytes, parts: list[tuple[int, int, int]]) -> list[int]:
    """The values of elements that are all positive integers or zero."""
    out = []
    for tag, start, end in parts:
        if tag != INTEGER or start == end or data[start] & 0x80:
            raise _Malformed
        out.append(int.from_bytes(data[start:end], "big"))
    return out


def _scheme(data: bytes, element: tuple[int, int, int]) -> str:
    """Object identifier of an algorithm element."""
    tag, start, end = element
    inner = _elements(data, start, end) if tag == SEQUENCE else []
    if not inner:
        raise _Malformed
    _well_formed(data, start, end)
    return _oid(data, inner[0])


def _key(data: bytes) -> str:
    tag, start, end = _header(data, 0)
    if tag != SEQUENCE or end != len(data):
        raise _Malformed
    parts = _elements(data, start, end)
    tags = [t for t, _, _ in parts]
    if tags[:2] == [SEQUENCE, OCTETS] and len(parts) == 2 and parts[1][1] < parts[1][2]:
        if not _scheme(data, parts[0]).startswith(ENCRYPTION):
            raise _Malformed
        return "encrypted pkcs8"
    if tags[:1] != [INTEGER] or parts[0][2] - parts[0][1] != 1:
        raise _Malformed
    version = data[parts[0][1]]
    if set(tags) == {INTEGER}:
        numbers = _numbers(data, parts)
        if len(numbers) == 9 and version == 0 and min(numbers[1:]) > 0:
            return f"rsa {numbers[1].bit_length()}"
        if len(numbers) == 6 and version == 0 and min(numbers[1:]) > 0:
            return f"dsa {numbers[1].bit_length()}"
        raise _Malformed
    if tags[1:2] == [OCTETS] and version == 1 and all(t in (0xA0, 0xA1) for t in tags[2:]) and len(parts) <= 4:
        _well_formed(data, start, end)
        bits = 8 * (parts[1][2] - parts[1][1])
        if not 112 <= bits <= 576:
            raise _Malformed
        return f"ec {bits}"
    if tags[1:3] == [SEQUENCE, OCTETS] and version <= 1 and all(t in (0xA0, 0xA1, 0x80, 0x81) for t in tags[3:]):
        name = OIDS.get(_scheme(data, parts[1]))
        inner = data[parts[2][1] : parts[2][2]]
        if name is None:
            raise _Malformed
        if name in ("rsa", "rsa-pss", "ec"):
            if not _key(inner).startswith(name[:2]):
                raise _Malformed
        else:
            (t, _, b), want = _header(inner, 0), INTEGER if name in ("dsa", "dh") else OCTETS
            if t != want or b != len(inner):
                raise _Malformed
        return f"pkcs8 {name}"
    if tags[1:2] == [SEQUENCE] and version == 3 and tags[2:] in ([], [SEQUENCE]):
        if not _scheme(data, parts[1]).startswith("1.2.840.113549.1.7."):
            raise _Malformed
        return "pkcs12"
    raise _Malformed


def der_key(data: bytes) -> str | None:
    """What private key the bytes encode, or None."""
    try:
        return _key(data)
    except _Malformed:
        return None


def _strings(data: bytes, at: int, n: int) -> tuple[list[bytes], int]:
    """``n`` strings, each behind its length in four bytes."""
    out = []
    for _ in range(n):
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            raise _Malformed
        out.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return out, at


def ssh_key(data: bytes) -> tuple[str, int] | None:
    """Kind and size in bytes of the private key of OpenSSH that the bytes start with."""
    try:
        if not data.startswith(SSH_MAGIC):
            return None
        (cipher, kdf, _), at = _strings(data, len(SSH_MAGIC), 3)
        n = int.from_bytes(data[at : at + 4], "big")
        if not 1 <= n <= len(data) // 4:
            return None
        parts, end = _strings(data, at + 4, n + 1)
        secret = parts[-1]
        if len(secret) < 8 or (cipher == b"none") != (kdf == b"none"):
            return None
        if cipher == b"none" and secret[:4] != secret[4:8]:
            return None
        kinds, _ = _strings(parts[0], 0, 1)
        return f"{kinds[0].decode('ascii')} {cipher.decode('ascii')}", end
    except (_Malformed, UnicodeDecodeError):
        return None


def _bytes64(chars: str) -> bytes:
    """Bytes of base64 in either alphabet, without padding; no bytes for an impossible length."""
    if len(chars) % 4 == 1:
        return b""
    return base64.b64decode(chars.translate(_STANDARD) + "=" * (-len(chars) % 4))


_STANDARD = str.maketrans("-_", "+/")


def _padded(text: str, end: int) -> int:
    """The end behind up to two padding signs."""
    stop = end
    while stop < len(text) and stop - end < 2 and text[stop] == "=":
        stop += 1
    return stop


def _take(text: str, start: int, need: int) -> tuple[str, int] | None:
    """``need`` characters of base64 over line breaks, ended by the end of a run, and where they end."""
    for alphabet in RUNS:
        parts, left, at = [], need, start
        while left > 0 and (run := alphabet.match(text, at, at + left + 1)):
            parts.append(run[0])
            left, end = left - len(run[0]), run.end()
            gap = BREAK.match(text, end)
            if left <= 0 or gap is None:
                break
            at = gap.end()
        if parts and left == 0:
            return "".join(parts), end
    return None


def _wrapped_run(text: str, m: re.Match) -> Iterator[tuple[str, int]]:
    """The run at a start, alone and then with the lines as long as it and one shorter line, up to the next start."""
    match = RUNS[0].match
    run = match(text, m.start())
    yield run[0], run.end()
    parts, at, width = [run[0]], run.end(), len(run[0])
    while (gap := BREAK.match(text, at)) and (run := match(text, gap.end())) and len(run[0]) <= width:
        if m.re.match(run[0]):
            break
        parts.append(run[0])
        at = run.end()
        if len(run[0]) < width:
            break
    if len(parts) > 1:
        yield "".join(parts), at


def _hex_bytes(run: str) -> bytes:
    return bytes.fromhex(run) if len(run) % 2 == 0 else b""


def _der(text: str) -> Iterator[tuple[int, int, str]]:
    for m in DER_START.finditer(text):
        start = m.start()
        try:
            size = _header(_bytes64(m[0]), 0)[2]
        except _Malformed:
            continue
        taken = _take(text, start, -(-size * 4 // 3))
        if taken and (kind := der_key(_bytes64(taken[0]))):
            yield start, _padded(text, taken[1]), kind
    for m in HEX_DER.finditer(text):
        if kind := der_key(_hex_bytes(m[0])):
            yield m.start(), m.end(), kind


def _ssh(text: str) -> Iterator[tuple[int, int, str]]:
    for m in SSH_START.finditer(text):
        start = m.start()
        for chars, _ in _wrapped_run(text, m):
            found = ssh_key(_bytes64(chars[: len(chars) - (len(chars) % 4 == 1)]))
            taken = found and _take(text, start, -(-found[1] * 4 // 3))
            if taken:
                yield start, _padded(text, taken[1]), found[0]
                break
    for m in HEX_SSH.finditer(text):
        found = ssh_key(_hex_bytes(m[0]))
        if found and found[1] * 2 == len(m[0]):
            yield m.start(), m.end(), found[0]


def _json_object(part: str) -> dict:
    try:
        value = json.loads(_bytes64(part).decode())
    except (ValueError, RecursionError, binascii.Error):
        return {}
    return value if isinstance(value, dict) else {}


def token_kind(parts: list[str]) -> tuple[str, int] | None:
    """Algorithm of a token of so many parts and how many of them it takes."""
    head = _json_object(parts[0])
    alg = head.get("alg")
    if not isinstance(alg, str):
        return None
    if "enc" in head:
        whole = len(parts) == 5 and isinstance(head["enc"], str) and parts[2] and parts[3] and parts[4]
        return (f"{alg} {head['enc']}", 5) if whole else None
    signed = len(_bytes64(parts[2])) in SIGNATURES.get(alg, ())
    return (alg, 3) if signed else None


def _tokens(text: str) -> Iterator[tuple[int, int, str]]:
    for m in TOKEN.finditer(text):
        parts = m[0].split(".")
        if found := token_kind(parts):
            alg, n = found
            yield m.start(), m.start() + len(".".join(parts[:n])), alg


def _armoured(data: bytes) -> str | None:
    """What key a text in armour holds."""
    text = data.decode("latin-1")
    for find in (_der, _ssh):
        for _, _, kind in find(text):
            return kind
    return None


def _wrapped(text: str) -> Iterator[tuple[int, int, str]]:
    for m in ARMOUR.finditer(text):
        for chars, end in _wrapped_run(text, m):
            if kind := _armoured(_bytes64(chars)):
                yield m.start(), _padded(text, end), kind
                break
    for m in HEX_ARMOUR.finditer(text):
        if kind := _armoured(_hex_bytes(m[0])):
            yield m.start(), m.end(), kind


def spans_of(text: str | None) -> list[tuple[str, int, int, str | None]]:
    """``kind, start, end, detail`` of every finding, by start and then in the order of ``KINDS``."""
    if not text:
        return []
    out = [("assign", m.start(), m.end(), None) for m in ASSIGN.finditer(text) if len(m[1]) >= MIN_VALUE]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), None) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end(), None) for m in HEX.finditer(text)]
    for kind, find in (("der", _der), ("ssh", _ssh), ("token", _tokens), ("wrapped", _wrapped)):
        out += [(kind, *found) for found in find(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def find_secrets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, spans`` per row; spans are code points of the text, their end exclusive."""
    tune(docs.sparkSession)
    fields = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("detail", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[dict(zip(fields.names, s, strict=True)) for s in spans_of(t)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(fields))], ["doc_id", "spans"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id long, spans {SPANS}")


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts of the plain findings per row, the digest of their spans, and all spans as text."""
    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(written(of(*BASE)), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["kind"].isin(*BASE))).cast("long").alias("n_confirmed"),
    )
