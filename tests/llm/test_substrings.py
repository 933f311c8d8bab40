"""Removed words against a plain search over all windows."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from broadsheet.llm import queries, substrings
from broadsheet.llm.common import table


def plain(rows, window=20):
    """``(doc_id, n_words, n_removed, kept)`` per row."""
    low = -(1 << 63)
    docs = [(low if i is None else i, i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for key, _, ws in docs:
        for s in range(len(ws) - window + 1):
            w = tuple(ws[s : s + window])
            first[w] = min(first.get(w, (key, s)), (key, s))
    out = []
    for key, i, ws in docs:
        gone = set()
        for s in range(len(ws) - window + 1):
            if first[tuple(ws[s : s + window])] < (key, s):
                gone.update(range(s, s + window))
        out.append((i, len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone)))
    return sorted(out, key=repr)


def random_rows(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(30)] + ["é", "a\x1cb", "x\x85y"]
    passages = [[rng.choice(vocabulary) for _ in range(rng.choice([9, 10, 19, 20, 21, 33, 57]))] for _ in range(6)]
    rows = []
    for i in rng.sample(range(1000), n):
        ws = []
        for _ in range(rng.randint(0, 4)):
            ws += [rng.choice(vocabulary) for _ in range(rng.randint(0, 40))]
            if rng.random() < 0.7:
                ws += rng.choice(passages)
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(ws)))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_random_documents(spark, seed, monkeypatch):
    monkeypatch.setattr(substrings, "BATCH_BYTES", 2000)
    rows = random_rows(seed)
    # copies, repeated rows, nulls, blanks, a long text that repeats itself
    rows += [(2000, rows[3][1]), (2001, rows[3][1]), rows[5], (None, rows[7][1]), (None, None), (2002, None), (2003, ""), (2004, " \n")]
    rows += [(2005, "la " * 3000), (2006, " ".join(f"u{k % 700}" for k in range(2000)))]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kept string").repartition(5)
    got = substrings.remove_repeats(df, range_words=500).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows)


def test_short_probe_keys_change_nothing(spark):
    rows = random_rows(9)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = substrings.remove_repeats(df, window=8, probe_bits=10).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows, 8)


def test_empty_and_packing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.remove_repeats(df).collect() == []
    for n in (0, 1, 1000):
        a, b = np.arange(n, dtype=np.uint64) ** 3, np.arange(n, dtype="<u4")
        x, y = substrings.unpack(substrings.pack(a, b), "<u8", "<u4")
        assert (x == a).all() and (y == b).all() and len(x) == n


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, folder, "documents").select("doc_id", "text").collect()]
    want = [(i, n, r, hashlib.sha256(k.encode()).hexdigest()) for i, n, r, k in plain(rows)]
    got = [tuple(r) for r in queries.QUERIES["op3_block_anchors"](spark, folder).collect()]
    assert sorted(got) == sorted(want) and any(r[2] for r in got)


def batch_of(rows):
    texts = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, texts.schema) as w:
        w.write_batch(texts)
    return zstandard.ZstdCompressor().compress(sink.getvalue().to_pybytes())


def test_equal_first_parts_of_keys_remove_nothing(monkeypatch):
    """With first parts cut to three bits nearly all windows share one; results are as before."""
    whole = substrings.Words.windows

    def short(self, k):
        at, keys = whole(self, k)
        return at, keys & np.uint64(7) if k == 20 else keys

    monkeypatch.setattr(substrings.Words, "windows", short)
    rows = sorted(random_rows(5, 40))
    halves = rows[:20], rows[20:]
    sent, anchors = [], []
    for part, some in enumerate(halves):
        _, keys = whole(substrings.Words(batch_of(some)), 10)
        anchors.append(np.unique(keys >> np.uint64(24)))
    every = np.unique(np.concatenate(anchors))
    for part, some in enumerate(halves):
        form = pa.schema([("batch", pa.string()), ("is_text", pa.bool_()), ("data", pa.binary())])
        asked = pa.RecordBatch.from_pylist(
            [
                {"batch": str(part), "is_text": False, "data": substrings.pack(substrings.deltas(every))},
                {"batch": str(part), "is_text": True, "data": batch_of(some)},
            ],
            form,
        )
        sent += [r for b in substrings._send_windows(20, 40, 1)(iter([asked])) for r in b.to_pylist()]
    later = list(substrings._find_later(iter([pa.RecordBatch.from_pylist(sent, substrings._KEYS)])))
    got = []
    for part, some in enumerate(halves):
        answers = [r for b in later for r in b.to_pylist() if r["batch"] == str(part)]
        answers = [{"batch": str(part), "is_text": False, "data": r["data"]} for r in answers]
        asked = pa.RecordBatch.from_pylist([*answers, {"batch": str(part), "is_text": True, "data": batch_of(some)}], form)
        got += [tuple(r.values()) for b in substrings._remove(20)(iter([asked])) for r in b.to_pylist()]
    assert sorted(got, key=repr) == plain(rows) and any(r[2] for r in got)


def test_keys_among_others():
    a = lambda *x: np.array(x, np.uint64)
    found = substrings.among(a(1, 1, 2, 3, 9), a(5, 6, 5, 5, 5), a(3, 1, 1, 9), a(5, 7, 6, 4))
    assert found.tolist() == [False, True, False, True, False]
