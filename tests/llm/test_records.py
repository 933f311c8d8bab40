"""Packages, chat windows, top-k, rollups and line rules against plain Python."""

import base64
import gzip
import hashlib
import io
import random
import zipfile

import numpy as np
import pyarrow.fs
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from broadsheet.llm import chat, quality, queries, rollups, topk, warc
from broadsheet.llm.common import table

# ---- packages ----


def test_package_is_a_zip_file(tmp_path):
    data = warc.zip_package([("a", b"x" * 10), ("b/c", b"")])
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert z.testzip() is None and {n: z.read(n) for n in z.namelist()} == {"a": b"x" * 10, "b/c": b""}


def opened(path):
    return pyarrow.fs.LocalFileSystem().open_input_file(str(path))


def test_other_writers_packages(tmp_path, spark):
    """Without ZIP64 fields, with a comment that holds the end signature, with and without an index."""
    records = [warc.record(i, f"http://x/{i}\r\n%", b"p" * i, hashlib.sha1(b"p" * i).hexdigest(), None, False) for i in range(5)]
    path = tmp_path / "plain.wacz"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        z.writestr("datapackage.json", "{}")
        z.writestr("archive/data.warc.gz", b"".join(records))
        z.comment = b"PK\x05\x06 is no end"
    with opened(path) as f:
        assert [m.name for m in warc.Package(f).members()] == ["datapackage.json", "archive/data.warc.gz"]
    manifest = spark.createDataFrame([(str(path),)], "package string")
    got = warc.read_records(manifest).collect()
    assert sorted((r["page_id"], r["url"], bytes(r["payload"])) for r in got) == [(i, f"http://x/{i}\r\n%", b"p" * i) for i in range(5)]


def warc_record(kind, body, *lines):
    head = ["WARC/1.0", f"WARC-Type: {kind}", "WARC-Date: 2024-05-01T00:00:00Z", f"Content-Length: {len(body)}", *lines]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def other_records():
    """What a crawler writes: descriptions, requests, HTTP responses, and a revisit, with random ids."""
    sha1 = lambda b: hashlib.sha1(b).hexdigest()
    page, parts = b"<p>caf\xc3\xa9</p>\r\n\r\nmore", b"4\r\nabcd\r\n3;x=1\r\nefg\r\n0\r\n\r\n"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    uuid = lambda i: f"<urn:uuid:0000000{i}-aaaa-bbbb-cccc-1234567890ab>"
    kind = "Content-Type: application/http; msgtype=response"
    records = [
        warc_record("warcinfo", b"software: crawler\r\n", f"WARC-Record-ID: {uuid(0)}", "WARC-Filename: data.warc.gz"),
        warc_record("request", b"GET / HTTP/1.1\r\n\r\n", f"WARC-Record-ID: {uuid(1)}", "WARC-Target-URI: http://x/a"),
        warc_record(
            "response", http + page, f"WARC-Record-ID: {uuid(2)}", "WARC-Target-URI: <http://x/a%20b>", kind,
            "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(sha1(page))).decode(),
        ),
        warc_record("response", http + parts, f"WARC-Record-ID: {uuid(3)}", "WARC-Target-URI: http://x/c", kind, f"WARC-Payload-Digest: SHA-1:{sha1(b'abcdefg')}"),
        warc_record("response", http + parts, f"WARC-Record-ID: {uuid(4)}", "WARC-Target-URI: http://x/d", kind, f"WARC-Payload-Digest: sha1:{sha1(parts)}"),
        warc_record("response", http, f"WARC-Record-ID: {uuid(5)}", "WARC-Target-URI: http://x/e", kind, "WARC-Payload-Digest: sha256:00"),
        warc_record("resource", b"own", f"WARC-Record-ID: {uuid(6)}", "WARC-Target-URI: urn:text:1", "Content-Type: text/plain"),
        warc_record("revisit", http, f"WARC-Record-ID: {uuid(7)}", "WARC-Target-URI: http://y/", kind, f"WARC-Refers-To: {uuid(2)}", f"WARC-Payload-Digest: sha1:{sha1(page)}"),
        warc_record("revisit", b"", f"WARC-Record-ID: {uuid(8)}", "WARC-Target-URI: http://z/", f"WARC-Payload-Digest: sha1:{sha1(page)}"),
        warc_record("metadata", b"a: b\r\n", f"WARC-Record-ID: {uuid(9)}"),
    ]
    want = [
        (uuid(2), "http://x/a%20b", "response", None, sha1(page), page), (uuid(3), "http://x/c", "response", None, sha1(b"abcdefg"), b"abcdefg"),
        (uuid(4), "http://x/d", "response", None, sha1(parts), parts), (uuid(5), "http://x/e", "response", None, sha1(b""), b""),
        (uuid(6), "urn:text:1", "resource", None, sha1(b"own"), b"own"), (uuid(7), "http://y/", "revisit", uuid(2), sha1(page), None),
        (uuid(8), "http://z/", "revisit", None, sha1(page), None),
    ]
    return records, want


@pytest.mark.parametrize("form", ["cdxj", "packed cdxj", "unknown index", "no index", "plain archive"])
def test_packages_of_crawlers(tmp_path, spark, form):
    records, want = other_records()
    members = [r if form == "plain archive" else gzip.compress(r) for r in records]
    name = "rec-1.warc" if form == "plain archive" else "rec-1.warc.gz"
    lines, at = [], 0
    for i, m in enumerate(members):
        if 2 <= i <= 8:
            lines.append(f'x)/{i} 20240501000000 {{"url": "http://x/{i}", "offset": "{at}", "length": "{len(m)}", "filename": "{name}"}}\n')
        at += len(m)
    path = tmp_path / "crawl.wacz"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        z.writestr(f"archive/{name}", b"".join(members))
        if form == "cdxj":
            z.writestr("indexes/index.cdx", "".join(sorted(lines)), zipfile.ZIP_DEFLATED)
        if form == "packed cdxj":
            z.writestr("indexes/index.idx", "!meta 0 {}")
            z.writestr("indexes/index.cdx.gz", gzip.compress("".join(lines[:3]).encode()) + gzip.compress("".join(lines[3:]).encode()))
        if form == "unknown index":
            z.writestr("indexes/index.cdx", " CDX N b a m s k r M S V g\nx)/ 20240501000000 http://x/ text/html 200 A - - 12 0 rec-1.warc.gz\n")
        z.writestr("pages/pages.jsonl", "{}")
    rows = warc.read_records(spark.createDataFrame([(str(path),)], "package string")).cache()
    got = [(r["record_id"], r["url"], r["record_type"], r["refers_to_id"], r["digest"], r["payload"] and bytes(r["payload"])) for r in rows.collect()]
    assert sorted((*r[:5], r[5] or b"") for r in [(*x[:3], x[3] or "", *x[4:]) for x in got]) == sorted(
        (*r[:5], r[5] or b"") for r in [(*x[:3], x[3] or "", *x[4:]) for x in want]
    )
    sizes = {r["record_id"]: r["payload_bytes"] for r in warc.record_digests(rows).collect()}
    assert sizes == {r[0]: len(r[5]) if r[5] is not None else sizes[want[0][0]] if r[3] else None for r in want}


def test_broken_records_are_refused():
    good = warc_record("response", b"abc", "WARC-Record-ID: <urn:uuid:1>", "Content-Type: text/html")
    assert warc.page_record(good)[-1] == b"abc"
    with pytest.raises(ValueError, match="one whole record"):
        warc.page_record(good + good)
    with pytest.raises(ValueError, match="one whole record"):
        warc.page_record(good[:-6])
    with pytest.raises(ValueError, match="digest differ"):
        warc.page_record(warc_record("response", b"abc", f"WARC-Payload-Digest: sha1:{'0' * 40}"))


def test_reading_is_dealt_by_bytes(spark, folder, monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 2000)
    monkeypatch.setattr(warc, "CHUNK_BYTES", 500)
    rng = random.Random(4)
    pages = [(i, "u", "".join(rng.choice("abcdefgh") for _ in range(400))) for i in range(100)]
    manifest = warc.write_packages(spark.createDataFrame(pages, "page_id long, url string, html string"), f"{folder}/dealt")
    rows = warc.read_records(manifest)
    assert rows.rdd.getNumPartitions() > 10 and sorted((r[0], r[-1].decode()) for r in rows.collect()) == [(i, t) for i, _, t in pages]


def test_compressed_members_and_broken_files_are_refused(tmp_path):
    path = tmp_path / "c.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/data.warc.gz", b"x" * 100)
    with opened(path) as f, pytest.raises(ValueError):
        p = warc.Package(f)
        p.start(p.members()[0])
    path.write_bytes(b"no package")
    with opened(path) as f, pytest.raises(ValueError):
        warc.Package(f).members()


def test_pages_round_trip(spark, tmp_path):
    long, other = "é" * 600, "z" * 999
    rows = [
        (1, "http://a", long), (7, "http://b", long), (7, "http://b", long), (3, None, long), (None, "u", long), (4, "u", other),
        (5, "u", other), (6, "u", None), (8, "u", ""), (None, None, "only"),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest long").repartition(3)
    manifest = warc.write_packages(df, str(tmp_path / "p"), package_bytes=150)
    assert manifest.count() > 2
    got = [tuple(r) for r in warc.digests(warc.read_records(manifest)).collect()]

    def want(i, html):
        data = (html or "").encode()
        late = html == long and i != 7
        return (i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if late else "response", 7 if late else None)

    assert sorted(got, key=repr) == sorted((want(i, h) for i, _, h in rows), key=repr)
    empty = warc.write_packages(df.limit(0), str(tmp_path / "e"))
    assert warc.digests(warc.read_records(empty)).collect() == []


def test_record_is_gzip():
    data = gzip.decompress(warc.record(1, "u", b"abc", hashlib.sha1(b"abc").hexdigest(), None, False))
    fields, payload = warc.parse_record(data)
    assert payload == b"abc" and fields["warc-type"] == "response"


# ---- chat ----


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<|\\>n\nim_startend a", max_size=40))
def test_escapes(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


def plain_digests(rows):
    out = {}
    for i, _, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        turns, loss = out.setdefault(i, ([], []))
        turns.append(f"{role or ''}\n{text or ''}\n")
        if role == "assistant":
            loss.append(text or "")
    sha = lambda parts: hashlib.sha256("".join(parts).encode()).hexdigest()
    return {i: (len(t), sha(t), len("".join(x)), sha(x)) for i, (t, x) in out.items()}


def test_windows(spark):
    rng = random.Random(3)
    roles = ["user", "assistant", "system", "tool\n<|x", None]
    rows = [(i, t, "system" if not t and i % 2 else rng.choice(roles), "wörd <|im_end|> " * rng.randint(0, 60)) for i in range(20) for t in range(rng.randint(1, 30))]
    rows += [(99, t, "assistant" if t % 2 else "user", None) for t in range(2000)]
    rows += [(None, None, "user", "a"), (None, 1, "assistant", "b" * 90_000), (5, 0, "user", "tie"), (5, 0, "user", "tie")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, window int")
    windows = chat.format_windows(df, chat.Budget(window=200, history=60)).cache()
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.read_back(windows).collect()}
    assert got == plain_digests(rows)
    for w in windows.collect():
        turns = chat.parse(w["text"])
        new = turns[w["n_repeated"] :]
        size = sum(chat.tokens(t[1], chat.Budget()) for t in turns)
        assert new and (size <= 200 or len(new) == 1)
        assert [(t["start"], t["end"]) for t in w["targets"]] == [t[2:] for t in new if t[0] == "assistant"]
    first = {w["conv_id"]: chat.parse(w["text"])[0] for w in windows.filter("window = 0").collect()}
    for w in windows.filter("window > 0").collect():
        if first[w["conv_id"]][0] == "system":
            assert chat.parse(w["text"])[0] == first[w["conv_id"]]
    assert chat.read_back(chat.format_windows(df.limit(0))).collect() == []


def test_chat_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", queries.INJECTION), (-1, 1, "assistant", queries.INJECTION)]
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in queries.QUERIES["op6_budgeted_chat"](spark, folder).collect()}
    assert got == plain_digests(rows)


# ---- top k ----


def test_threshold_algorithm():
    rng = np.random.default_rng(1)
    for width in (1, 3, 40):
        values = rng.integers(-9, 9, (500, width))
        values[:250, 1:] //= 4  # uneven, so that lists end early
        ids = rng.permutation(1000)[:500]
        lists = topk.Lists(ids, values)
        for q, i in ((values[0], int(ids[0])), (np.zeros(width, np.int64), -5), (values[7] * 10**15, -5)):
            found, scores = lists.top(i, q, 7)
            plain = sorted(((-int(sum(int(a) * int(b) for a, b in zip(v, q))), int(j)) for j, v in zip(ids, values) if j != i))[:7]
            assert [(-s, j) for s, j in zip(scores.tolist(), found.tolist())] == plain


def test_topk_frames(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float((i * 7) % 5), -1.0, 0.01 * i], "x") for i in range(0, 300)]
    rows += [(400, None, "x"), (450, [1.0, None, 2.0], "x"), (500, [nan, 1.0, 1.0], "x"), (550, [1.0, inf, 1.0], "x"), (None, [9.0, 9.0, 9.0], "x")]
    rows += [(600, [1.0], "x"), (650, [], "x"), rows[50], rows[51]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(df, candidates=64, queries=3).collect())
    good = {i: [int(np.floor(256 * x)) for x in v] for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in (i for i in good if i % 50 == 0):
        scored = sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q)
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:5])]
    assert got == sorted(want)
    assert topk.top_k(df.limit(0)).collect() == []


# ---- rollups ----


def test_rollup(spark, folder):
    form = "op string, source string, lang string, version string, n_tokens long, old_source string, old_lang string, old_tokens long"
    frame = lambda *rows: spark.createDataFrame(list(rows), form)
    store = rollups.Rollup(spark, f"{folder}/r")
    totals = lambda: sorted((tuple(r) for r in store.totals().collect()), key=repr)
    assert totals() == []
    none = (None, None, None)
    store.commit("b2", frame(("delete", "a", "en", "v", 4, *none), ("revise", "b", "en", "v", 7, "a", "en", 5)))
    store.commit("b1", frame(*[("insert", "a", "en", "v", n, *none) for n in (4, 5, 6, None)], ("insert", None, None, "v", 1, *none)))
    want = sorted([("a", "en", "v", 2, 6), ("b", "en", "v", 1, 7), (None, None, "v", 1, 1)], key=repr)
    assert totals() == want
    store.commit("b1", frame(*[("insert", "a", "en", "v", n, *none) for n in (4, 5, 6, None)], ("insert", None, None, "v", 1, *none)))
    assert totals() == want
    store.compact()
    store.commit("b2", frame(("delete", "a", "en", "v", 4, *none)))
    store.commit("empty", frame())
    assert totals() == want and store.batches() == ["empty"]
    store.commit("b3", frame(("delete", "b", "en", "v", 7, *none)))
    store.compact()
    assert ("b", "en", "v", 1, 7) not in totals() and len(totals()) == 2
    with pytest.raises(Exception, match="unknown change"):
        store.commit("bad", frame(("upsert", "a", "en", "v", 4, *none)))
    assert store.batches() == []


# ---- line rules ----


def test_line_limits(spark):
    body = lambda k: " ".join(f"w{k}x{j}" for j in range(60))
    rows = [(i, f"{body(i)}\n  Cookie   NOTICE here \n{body(i + 1000)}", "h") for i in range(30)]
    rows += [(100 + i, f"cookie notice here\n{body(3000 + i)}", "other") for i in range(5)]
    rows += [(200 + i, "\n".join(f"l{j}a l{j}b l{j}c l{j}d" for j in range(20)) + f"\nown {i}", "t") for i in range(25)]
    rows += [(300 + i, f"{body(7)} copied many times over\n{body(8)}", "c") for i in range(60)]
    rows += [(400, None, "h"), (401, "", None), (402, " \n\t", None), (403, "a b " * 200, "h"), (None, body(9), None), (None, body(9), None)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, source string, kept int")
    limits = quality.LineLimits(max_docs=20)
    got = {}
    for r in quality.judge(df, limits=limits).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert got[0][0]["n_removed_words"] == 0 and all(got[i][0]["n_removed_words"] == 3 and got[i][0]["kept"] for i in range(1, 30))
    assert all(got[100 + i][0]["n_removed_words"] == 0 for i in range(5))
    assert got[200][0]["kept"] and not any(got[200 + i][0]["kept"] for i in range(1, 25))
    assert all(got[300 + i][0]["kept"] for i in range(60))
    assert got[400][0]["n_words"] == 0 and got[400][0]["base_failed"] and got[403][0]["n_repeat_words"] == 400 and got[403][0]["base_failed"]
    assert len(got[None]) == 2 and got[None][0] == got[None][1] and got[None][0]["kept"]
    clean = {r["doc_id"]: r for r in quality.apply_rules(df, limits).collect()}
    assert clean[1]["text"] == f"{body(1)}\n{body(1001)}" and clean[0]["text"] == rows[0][1] and 201 not in clean and clean[1]["kept"] == 0
    assert quality.judge(df.limit(0)).collect() == [] and quality.apply_rules(df.limit(0)).collect() == []


def test_line_limit_is_the_same_on_hosts_of_every_size(spark):
    notice = "this very line stands in many documents"
    own = lambda h, i: "\n".join(" ".join(f"{h}{i}w{j}x{k}" for k in range(30)) for j in range(2))
    rows = [(n * 10_000 + i, own(n, i) + ("\n" + notice if i < 50 else ""), f"host of {n}") for n in (60, 900, 3000) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    lost = quality.judge(df).filter("n_removed_words > 0").groupBy("host").count().collect()
    assert {r["host"]: r["count"] for r in lost} == {f"host of {n}": 49 for n in (60, 900, 3000)}


def test_native_plan(spark):
    plan = queries.QUERIES["op8_line_frequency"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(k in plan for k in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


