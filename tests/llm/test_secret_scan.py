"""Plain findings against a pattern written apart, and planted keys and tokens of every form."""

import base64
import hashlib
import json
import os
import random
import re
import time

import pytest

from broadsheet.llm import queries
from broadsheet.llm import secret_scan as scan
from broadsheet.llm.common import table

DICE = random.Random(11)
ABOUT = {
    "assign": re.compile(r"(?ia:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def plain(text):
    out = []
    for k, (kind, pattern) in enumerate(ABOUT.items()):
        for m in pattern.finditer(text or ""):
            size = {"assign": len(m[m.re.groups]) >= 8, "access": len(m[0]) >= 16, "hex": len(m[0]) >= 32}[kind]
            if size:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def tlv(tag, *parts):
    body = b"".join(parts)
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x81, n]) if n < 256 else bytes([0x82, n >> 8, n & 255])
    return bytes([tag]) + size + body


def number(value):
    return tlv(2, value.to_bytes(value.bit_length() // 8 + 1, "big"))


def numbers(bits, n):
    return [number(DICE.getrandbits(bits) | 1 << (bits - 1)) for _ in range(n)]


def oid(text):
    a, b, *arcs = map(int, text.split("."))
    out = bytes([40 * a + b])
    for arc in arcs:
        part = [arc & 127]
        while arc := arc >> 7:
            part.append(arc & 127 | 128)
        out += bytes(reversed(part))
    return tlv(6, out)


RSA = tlv(0x30, number(0), *numbers(1024, 1), number(65537), *numbers(512, 6))
DSA = tlv(0x30, number(0), *numbers(1024, 1), *numbers(160, 1), *numbers(1024, 3))
EC = tlv(0x30, number(1), tlv(4, os.urandom(32)), tlv(0xA0, oid("1.2.840.10045.3.1.7")))
PKCS8 = tlv(0x30, number(0), tlv(0x30, oid("1.2.840.113549.1.1.1"), tlv(5)), tlv(4, RSA))
ED = tlv(0x30, number(0), tlv(0x30, oid("1.3.101.112")), tlv(4, tlv(4, os.urandom(32))))
LOCKED = tlv(0x30, tlv(0x30, oid("1.2.840.113549.1.5.13"), tlv(0x30)), tlv(4, os.urandom(128)))
PUBLIC = tlv(0x30, tlv(0x30, oid("1.2.840.113549.1.1.1"), tlv(5)), tlv(3, os.urandom(140)))


def string(b):
    return len(b).to_bytes(4, "big") + b


SSH = (
    b"openssh-key-v1\0" + string(b"none") * 2 + string(b"") + b"\0\0\0\1" + string(string(b"ssh-ed25519") + string(bytes(32)))
    + string(b"abcdabcd" + string(b"ssh-ed25519") + string(bytes(32)) + string(bytes(64)) + string(b"me") + b"\1\2\3")
)


def b64(data, url=False):
    return (base64.urlsafe_b64encode(data).rstrip(b"=") if url else base64.b64encode(data)).decode()


def token(head, signature, payload=b'{"sub":"x"}'):
    return ".".join(b64(p, True) for p in (json.dumps(head).encode(), payload, signature))


def wrap(text, width=64, end="\n"):
    return end.join(text[i : i + width] for i in range(0, len(text), width))


def found(text):
    return [(k, text[a:b], d) for k, a, b, d in scan.spans_of(text) if k not in scan.BASE]


@pytest.mark.parametrize(
    ("data", "detail"),
    [(RSA, "rsa 1024"), (DSA, "dsa 1024"), (EC, "ec 256"), (PKCS8, "pkcs8 rsa"), (ED, "pkcs8 ed25519"), (LOCKED, "encrypted pkcs8")],
)
def test_der(data, detail):
    body = b64(data)
    armour = "-----BEGIN PRIVATE KEY-----{}-----END PRIVATE KEY-----"
    for written in (body, wrap(body), wrap(body, 76, "\r\n    "), wrap(body, 64, "\\n"), wrap(body, 64, " "), data.hex(), data.hex().upper()):
        for text in (written, f"é key: '{written}'", f"x {written}\nand other words"):
            assert found(text) == [("der", written, detail)]
    assert found(armour.format("\n" + wrap(body) + "\n")) == [("der", wrap(body), detail)]
    assert found(armour.format(body)) == [("der", body, detail)]
    inside = armour.format("\n" + wrap(body) + "\n").encode()
    for written in (b64(inside), wrap(b64(inside), 76), inside.hex()):
        assert found(f"k8s: {written} .") == [("wrapped", written, detail)]


def test_changed_keys_are_not_reported():
    assert found(b64(PUBLIC)) == []
    for data in (RSA, PKCS8, EC, ED, LOCKED):
        body = b64(data).rstrip("=")
        assert found(body[:-8]) == found(body + "A") == found(body + "AAAA") == found("A" + body) == []
        inner = bytearray(data)
        inner[data.index(b"\x04" if data in (EC, ED, LOCKED) else b"\x02", 6 if data is LOCKED else 4) + 1] ^= 1  # a nested length
        assert found(b64(bytes(inner))) == found(bytes(inner).hex()) == []
    assert found("MIIEpAIBAAKCAQEA " * 50) == found("MIIF" * 5000) == found("3082" * 5000) == []


def test_ssh():
    body = b64(SSH)
    for written in (body, wrap(body, 70), SSH.hex()):
        assert found(f"a {written}\nwords behind") == [("ssh", written, "ssh-ed25519 none")]
    assert found(b64(SSH.replace(b"abcdabcd", b"abcdabce"))) == found(body[:-40]) == []


def test_tokens():
    good = token({"alg": "HS256", "typ": "JWT"}, os.urandom(32))
    spaced = ".".join([b64(b'{ "alg" : "ES256" }', True), b64(b"{}", True), b64(os.urandom(64), True)])
    assert found(f"Bearer {good}.") == [("token", good, "HS256")]
    assert found(f"{good}.Next {spaced}") == [("token", good, "HS256"), ("token", spaced, "ES256")]
    sealed = ".".join([b64(b'{"alg":"dir","enc":"A256GCM"}', True), "", *(b64(os.urandom(12), True) for _ in range(3))])
    assert found(sealed) == [("token", sealed, "dir A256GCM")]
    for bad in (
        token({"alg": "HS256"}, os.urandom(31)), token({"alg": "none"}, b""), token({"typ": "JWT"}, os.urandom(32)),
        token({"alg": 5}, os.urandom(32)), "A" + good, good.replace("e", "f", 1), "eyJhbGciOi.eyJh.abc",
        b64(b'{"a":' + b"[" * 50_000, True) + ".e30." + "A" * 43,
    ):
        assert found(bad) == []


def test_plain_forms():
    texts = [
        None, "", "password=abcdefgh", "PassWord' : 'abcdefg", "api_key=12345678 APIKEY:\"a.b-c_d+e/f=", "token=password=abcdefgh",
        "ſecret=abcdefgh toKen=abcdefgh", "AKIA" + "A" * 12 + "AKIA", "AKIA" * 5 + "é" + "AKIA" * 3, "AKIAAKIA0", "0" * 31 + "g" + "f" * 32,
        "é🙂 secret: " + "ab" * 20, "passwordpassword=xxxxxxxx", "token=short token=longer_value",
    ]
    letters = ["password", "TOKEN", "=", ":", " ", '"', "'", "abcdefgh", "AKIA", "B7", "0123456789abcdef", "é", ".", "\n", "api", "_key"]
    texts += ["".join(DICE.choices(letters, k=DICE.randrange(40))) for _ in range(3000)]
    for t in texts:
        assert [f"{k}:{a}:{b}" for k, a, b, _ in scan.spans_of(t) if k in scan.BASE] == plain(t)


def test_long_texts_take_linear_time():
    for unit in ("MIIF/", "eyJhbGciOi.", "b3BlbnNzaC1rZXktdjEA ", "30820100", "password=x ", "LS0tLS1CRUdJTi\n", "abcdef01 "):
        start = time.perf_counter()
        scan.spans_of(unit * (1_000_000 // len(unit)))
        assert time.perf_counter() - start < 30


def test_frames(spark):
    rows = [(1, "token=abcdefgh", "x"), (1, "token=abcdefgh", "x"), (None, None, None), (2, "", "y"), (3, b64(PKCS8), "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = scan.digest(scan.find_secrets(df)).collect()
    empty = hashlib.sha256(b"").hexdigest()
    one = (1, 1, 0, 0, hashlib.sha256(b"assign:0:14").hexdigest(), "assign:0:14", 0)
    assert sorted(map(tuple, got), key=str) == sorted(
        [one, one, (None, 0, 0, 0, empty, "", 0), (2, 0, 0, 0, empty, "", 0), (3, 0, 0, 0, empty, f"der:0:{len(b64(PKCS8))}", 1)], key=str
    )
    assert scan.digest(scan.find_secrets(df.limit(0))).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    want = {}
    for r in table(spark, folder, "documents").collect():
        spans = plain(r["text"])
        n = [sum(s.startswith(k) for s in spans) for k in scan.BASE]
        want[r["doc_id"]] = (*n, hashlib.sha256(",".join(spans).encode()).hexdigest())
    got = {r[0]: tuple(r)[1:5] for r in queries.QUERIES["op11_secret_scan"](spark, folder).collect()}
    assert got == want and sum(sum(w[:3]) for w in want.values()) > 10
