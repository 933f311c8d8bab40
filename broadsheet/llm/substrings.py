"""Removal of repeated passages, found through fixed-block anchors.

A window is ``window`` consecutive words of one document. Every word is removed
that a window covers whose words also start earlier: in a document with a smaller
id, or before in the same one. Windows are judged on the input.

1. *Index.* Every document is cut into non-overlapping blocks of ``window / 2``
   words. Any window holds at least one whole block of its own document.
2. *Probe.* The rolling window of block length at every word probes the index. A
   block's key that occurs more than once anywhere is an anchor.
3. *Extend.* Full windows around anchors, and no others, are compared by their
   own keys across documents; the earliest holder of a key keeps it. Adjoining
   removed windows are the maximal exact repeats.

What travels is compact. Documents are packed into batches once, compressed, and
written to the shared folder. A batch sends each key once, however often it holds
it, sorted and delta-coded and split by key range, so a hot passage is one entry
per batch. Answers go back to the batch. A task holds one key range or one batch;
the number of ranges follows the number of words. No pairs are formed.

Anchor keys may be short (``probe_bits``): a false hit costs comparisons, never a
result. Window keys have 96 bits: 64, and 32 more that are made only of windows
around anchors. Among n of those the chance of any wrong match is about n^2 / 2^97,
a quarter of a percent for the words of 100 TB were all of them repeated.
Words meet by 64-bit hashes, but a pair of words with one hash tells only where all
other words of two windows are equal.

Defined cases: a null or empty text has no words; a null id counts as smaller
than any other; rows with one id and equal text are the same document and keep or
lose the same words; an empty table gives an empty result. Only the two named
columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import tune
from broadsheet.session import materialise

WINDOW = 20
PROBE_BITS = 40
RANGE_WORDS = 4_000_000  # words per key range aimed at
BATCH_BYTES = 8 << 20  # a batch ends after so many bytes of text (or one longer document)
PART_BYTES = 24 << 20  # compressed batches per task aimed at
KNOWN_WORDS = 1_000_000  # words whose hash a worker remembers

# odd, so that no position of a window is lost
_FACTOR, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint32(0x27D4EB2F)
_NO_ID = np.iinfo(np.int64).min

# ---- compact arrays ---------------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Unsigned arrays as compressed byte planes."""
    out = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
        data = zstandard.ZstdCompressor(level=1).compress(planes)
        out += [np.array([len(a), len(data)], "<u4").tobytes(), data]
    return b"".join(out)


def unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        n, size = np.frombuffer(data, "<u4", 2, at).tolist()
        width = np.dtype(kind).itemsize
        planes = zstandard.ZstdDecompressor().decompress(data[at + 8 : at + 8 + size], max_output_size=n * width or 1)
        out.append(np.frombuffer(planes, np.uint8).reshape(width, n).T.copy().view(kind).reshape(n))
        at += 8 + size
    return out


def deltas(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=np.uint64(0))


# ---- batches ------------------------------------------------------------------------


def _to_batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compressed batches of documents, named by task and number."""
    task, k = TaskContext.get().partitionId(), 0
    for b in rows:
        size = np.fromiter(((len(t.as_buffer()) if t.is_valid else 0) for t in b.column(1)), np.int64, b.num_rows)
        cut = np.cumsum(size) // BATCH_BYTES
        for lo, hi in zip(*_runs(cut), strict=True):
            part = b.slice(lo, hi - lo)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema) as w:
                w.write_batch(part)
            data = zstandard.ZstdCompressor(level=3).compress(sink.getvalue().to_pybytes())
            words = sum(t.as_buffer().to_pybytes().count(b" ") for t in part.column(1) if t.is_valid)
            yield pa.RecordBatch.from_pydict(
                {"batch": [f"{task}-{k}"], "size": [len(data)], "words": [words], "data": [data]}, schema=_BATCH
            )
            k += 1


_BATCH = pa.schema([("batch", pa.string()), ("size", pa.int64()), ("words", pa.int64()), ("data", pa.binary())])


def _runs(values: np.ndarray) -> tuple[list[int], list[int]]:
    """Starts and ends of runs of equal values."""
    if not len(values):
        return [], []
    cuts = (np.nonzero(values[1:] != values[:-1])[0] + 1).tolist()
    return [0, *cuts], [*cuts, len(values)]


def _by_key(keys: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The stable order by both parts of the keys."""
    order = np.argsort(keys, kind="stable")  # quick where they are sorted already
    k, s = keys[order], second[order]
    if ((k[1:] == k[:-1]) & (s[1:] != s[:-1])).any():  # hardly ever
        order = np.lexsort((second, keys))
    return order


def _key_runs(keys: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of equal keys."""
    if not len(keys):
        return np.array([], np.int64), np.array([], np.int64)
    cuts = np.nonzero((keys[1:] != keys[:-1]) | (second[1:] != second[:-1]))[0] + 1
    return np.append(0, cuts), np.append(cuts, len(keys))


def among(keys: np.ndarray, second: np.ndarray, wanted: np.ndarray, wanted_second: np.ndarray) -> np.ndarray:
    """Which keys are among the wanted ones, both parts compared."""
    order = np.argsort(wanted, kind="stable")
    wanted, wanted_second = wanted[order], wanted_second[order]
    at, end = np.searchsorted(wanted, keys), np.searchsorted(wanted, keys, "right")
    found = np.zeros(len(keys), bool)
    while (left := at < end).any():  # more than one turn only where first parts are equal by chance
        found[left] |= wanted_second[at[left]] == second[left]
        at = at + 1
    return found


class Words:
    """The words of a batch in one row, documents in order of id."""

    known: dict[bytes, int] = {}

    def __init__(self, data: bytes):
        raw = zstandard.ZstdDecompressor().decompress(data, max_output_size=1 << 31)
        table = pa.ipc.open_stream(raw).read_all()
        ids, texts = table.column(0).to_pylist(), table.column(1).to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (_NO_ID if ids[i] is None else ids[i], texts[i] or ""))
        self.ids = [ids[i] for i in order]
        self.words = [(texts[i] or "").encode().split() for i in order]
        if len(Words.known) > KNOWN_WORDS:
            Words.known = {}
        known, h = Words.known, xxhash.xxh64_intdigest
        hashes = []
        for ws in self.words:
            for w in set(ws):
                if w not in known:
                    known[w] = h(w)
            hashes.append(np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws)))
        self.hashes = np.concatenate(hashes) if hashes else np.array([], np.uint64)
        sizes = np.array([len(ws) for ws in self.words], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        self.pos = np.arange(len(self.hashes)) - self.starts[self.doc]
        self.id_values = np.array([_NO_ID if i is None else i for i in self.ids], np.int64)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all windows of ``k`` words, and their 64-bit keys."""
        n = max(0, len(self.hashes) - k + 1)
        total = np.zeros(n, np.uint64)
        for i in range(k):
            total = total * _FACTOR + self.hashes[i : i + n]
        total ^= total >> np.uint64(33)
        total *= np.uint64(0xFF51AFD7ED558CCD)
        total ^= total >> np.uint64(33)
        at = np.nonzero(np.arange(n) + k <= self.ends[self.doc[:n]])[0]
        return at, total[at]

    def second(self, at: np.ndarray, k: int) -> np.ndarray:
        """The second part of the keys of the windows of ``k`` words that start at ``at``."""
        high = (self.hashes >> np.uint64(32)).astype("<u4")
        total = np.zeros(len(at), "<u4")
        for i in range(k):
            total *= _SECOND
            total += high[at + i]
        return total


def _parts(keys: np.ndarray, bits: int, parts: int) -> Iterator[tuple[int, slice]]:
    """Sorted keys of ``bits`` bits cut into ``parts`` (a power of two) ranges."""
    edges = np.searchsorted(keys, np.arange(parts, dtype=np.uint64) << np.uint64(bits - parts.bit_length() + 1))
    for p, (lo, hi) in enumerate(zip(edges, [*edges[1:], len(keys)], strict=True)):
        if hi > lo:
            yield p, slice(int(lo), int(hi))


# ---- index and probe -------------------------------------------------------------------

_KEYS = pa.schema([("part", pa.int32()), ("batch", pa.string()), ("data", pa.binary())])


def _send_probes(block: int, bits: int, parts: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            for name, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ws = Words(data.as_py())
                at, keys = ws.windows(block)
                keys = keys >> np.uint64(64 - bits)
                order = np.argsort(keys, kind="stable")
                keys, is_block = keys[order], (ws.pos[at] % block == 0)[order]
                lo, hi = (np.array(x, np.int64) for x in _runs(keys))
                if not len(lo):
                    continue
                keys = keys[lo]
                # bit 0: the index holds it here, bit 1: it occurs here more than once
                flags = np.maximum.reduceat(is_block, lo).astype(np.uint8) | ((hi - lo > 1).astype(np.uint8) << 1)
                out = [(p, name, pack(deltas(keys[s]), flags[s])) for p, s in _parts(keys, bits, parts)]
                yield _table(out, _KEYS)

    return run


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _grouped(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple]]]:
    """Consecutive rows with equal first column."""
    key, held = None, []
    for b in rows:
        for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if held and r[0] != key:
                yield key, held
                held = []
            key = r[0]
            held.append(r)
    if held:
        yield key, held


def _find_anchors(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each batch's keys in a range, those that are a block somewhere and occur twice or more."""
    for _, held in _grouped(rows):
        keys, flags = zip(*(unpack(r[2], "<u8", "u1") for r in held), strict=True)
        keys = [np.cumsum(k, dtype=np.uint64) for k in keys]
        joined = np.concatenate(keys)
        order = np.argsort(joined, kind="stable")
        lo, hi = (np.array(x, np.int64) for x in _runs(joined[order]))
        seen = np.bitwise_or.reduceat(np.concatenate(flags)[order], lo)
        good = ((seen & 1) > 0) & ((hi - lo > 1) | ((seen & 2) > 0))
        anchors = joined[order][lo[good]]
        out = []
        for r, k in zip(held, keys, strict=True):
            mine = k[np.isin(k, anchors, assume_unique=True)]
            if len(mine):
                out.append((r[1], pack(deltas(mine))))
        if out:
            yield _table(out, _ANSWER)


_ANSWER = pa.schema([("batch", pa.string()), ("data", pa.binary())])

# ---- extend ----------------------------------------------------------------------------


def _by_batch(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], bytes]]:
    """Rows ``batch, is_text, data`` sorted: a batch's answers, then its documents."""
    for name, held in _grouped(rows):
        answers = [r[2] for r in held if not r[1]]
        for r in held:
            if r[1]:
                yield name, answers, r[2]


def _send_windows(window: int, bits: int, parts: int):
    block = window // 2

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, answers, data in _by_batch(rows):
            if not answers:
                continue
            anchors = np.concatenate([np.cumsum(unpack(a, "<u8")[0], dtype=np.uint64) for a in answers])
            ws = Words(data)
            at, keys = ws.windows(block)
            hit = np.zeros(len(ws.hashes) + 1, np.int64)
            hit[at + 1] = np.isin(keys >> np.uint64(64 - bits), anchors)
            hits = np.cumsum(hit)
            at, keys = ws.windows(window)
            # an anchor lies wholly inside the window
            near = hits[at + window - block + 1] > hits[at]
            at, keys = at[near], keys[near]
            if not len(at):
                continue
            second = ws.second(at, window)
            order = _by_key(keys, second)  # of equal keys the earliest first
            first = order[_key_runs(keys[order], second[order])[0]]
            keys, second, at = keys[first], second[first], at[first]
            out = []
            for p, s in _parts(keys, 64, parts):
                docs, place = np.unique(ws.doc[at[s]], return_inverse=True)
                ids = ws.id_values[docs].view(np.uint64)
                packed = pack(deltas(keys[s]), second[s], ids, place.astype("<u4"), ws.pos[at[s]].astype("<u4"))
                out.append((p, name, packed))
            yield _table(out, _KEYS)

    return run


def _find_later(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each batch's window keys in a range, those that another batch holds earlier."""
    for _, held in _grouped(rows):
        keys, seconds, ids, pos = [], [], [], []
        for r in held:
            k, second, doc, place, p = unpack(r[2], "<u8", "<u4", "<u8", "<u4", "<u4")
            keys.append(np.cumsum(k, dtype=np.uint64))
            seconds.append(second)
            ids.append(doc.view(np.int64)[place])
            pos.append(p)
        size = [len(k) for k in keys]
        key, second, doc, at = (np.concatenate(x) for x in (keys, seconds, ids, pos))
        order = np.lexsort((at, doc, key))
        order = order[_by_key(key[order], second[order])]
        lo, hi = _key_runs(key[order], second[order])
        lead = np.repeat(order[lo], hi - lo)
        late = np.zeros(len(key), bool)
        late[order] = (doc[order] != doc[lead]) | (at[order] != at[lead])
        out = []
        for r, k, second, x in zip(held, keys, seconds, np.split(late, np.cumsum(size)[:-1]), strict=True):
            if x.any():
                out.append((r[1], pack(deltas(k[x]), second[x])))
        if out:
            yield _table(out, _ANSWER)


_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])


def removed_words(ws: Words, window: int, later: np.ndarray, later_second: np.ndarray) -> np.ndarray:
    """Which words of a batch go, given the keys that start earlier in another batch."""
    at, keys = ws.windows(window)
    gone = np.zeros(len(at), bool)
    order = np.argsort(keys, kind="stable")
    lo, hi = (np.array(x, np.int64) for x in _runs(keys[order]))
    # only windows whose first part occurs again, here or elsewhere, need the second
    again = np.repeat((hi - lo > 1) | np.isin(keys[order][lo], later), hi - lo) if len(lo) else gone
    few = np.zeros(len(at), bool)
    few[order[again]] = True
    few = np.nonzero(few)[0]
    second = ws.second(at[few], window)
    here = _by_key(keys[few], second)
    few, second = few[here], second[here]
    lo, hi = _key_runs(keys[few], second)
    late = among(keys[few[lo]], second[lo], later, later_second)
    own, lead = at[few], np.repeat(at[few[lo]], hi - lo)
    same = (ws.id_values[ws.doc[own]] == ws.id_values[ws.doc[lead]]) & (ws.pos[own] == ws.pos[lead])
    gone[few] = np.repeat(late, hi - lo) | ~same
    edges = np.zeros(len(ws.hashes) + 1, np.int64)
    np.add.at(edges, at[gone], 1)
    np.add.at(edges, at[gone] + window, -1)
    return np.cumsum(edges)[:-1] > 0


def _remove(window: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, answers, data in _by_batch(rows):
            found = [unpack(a, "<u8", "<u4") for a in answers] or [(np.array([], np.uint64), np.array([], "<u4"))]
            later = np.concatenate([np.cumsum(k, dtype=np.uint64) for k, _ in found])
            ws = Words(data)
            gone = removed_words(ws, window, later, np.concatenate([k for _, k in found]))
            out = []
            for i, lo, hi, own in zip(ws.ids, ws.starts.tolist(), ws.ends.tolist(), ws.words, strict=True):
                mark = gone[lo:hi]
                n = int(mark.sum())
                kept = [w for w, g in zip(own, mark.tolist(), strict=True) if not g] if n else own
                out.append((i, hi - lo, n, b" ".join(kept).decode()))
            yield _table(out, _KEPT)

    return run


# ---- the operator -------------------------------------------------------------------------


def _answered(batches: DataFrame, answers: DataFrame, tasks: int) -> DataFrame:
    both = answers.select("batch", F.lit(False).alias("is_text"), "data").union(
        batches.select("batch", F.lit(True).alias("is_text"), "data")
    )
    return both.repartition(tasks, "batch").sortWithinPartitions("batch", "is_text")


def _ranged(df: DataFrame, step: Callable, parts: int, schema: str) -> DataFrame:
    return df.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(step, schema)


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    window: int = WINDOW,
    probe_bits: int = PROBE_BITS,
    range_words: int = RANGE_WORDS,
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` per row; ``kept`` joins the remaining words by a blank."""
    if window < 4 or window % 2:
        raise ValueError("the window has an even number of words, at least four")
    tune(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    batches = materialise(
        rows.mapInArrow(_to_batches, "batch string, size long, words long, data binary"), "batches"
    )
    size, words = (v or 0 for v in batches.agg(F.sum("size"), F.sum("words")).first())
    parts = 16
    while parts * range_words < words:
        parts *= 2
    tasks = max(8, -(-size // PART_BYTES), parts // 4)
    block, keys, answer = window // 2, "part int, batch string, data binary", "batch string, data binary"
    sent = batches.select("batch", "data").mapInArrow(_send_probes(block, probe_bits, parts), keys)
    anchors = _ranged(sent, _find_anchors, parts, answer)
    found = _answered(batches, anchors, tasks).mapInArrow(_send_windows(window, probe_bits, parts), keys)
    later = _ranged(found, _find_later, parts, answer)
    return _answered(batches, later, tasks).mapInArrow(
        _remove(window), "doc_id long, n_words long, n_removed long, kept string"
    )
