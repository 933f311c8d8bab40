"""Byte-pair encoding and decoding with a public tokenizer file, through a pair occurrence index.

A worker keeps the tokens of every chunk (run between white space) it has seen,
and encodes the new chunks of a batch together: their bytes become one row of
symbols, an index maps each adjacent pair that has a merge to all its positions,
and the active merges are applied in ascending rank. Applying one merge updates
the neighbours of its positions and adds the pairs they now form to the index.
Words never merge across their ends, so the order in which words take part does
not matter; within a word, the lowest rank goes first and equal ranks go from
left to right, as in the file's own library.

The vocabulary is read once by the driver and sent to the executors; its size is
that of the file. Rows are encoded where they lie, nothing is shuffled.

Supported files: BPE with byte-level symbols and a word-end suffix, no dropout,
no unknown token, normaliser NFC, white space to blank, lower case, special tokens
matched as they are. Anything else is refused when the file is read.

Defined cases: a null or empty text has no tokens and decodes to the empty text;
special tokens in a text are tokens of their own; rows repeated in full are each
encoded; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import tune

CACHE = 150_000  # chunks a worker remembers before it starts anew

MANY = 48  # places of a pair from which on it is merged with arrays

# fixed: the white space of the file's normaliser
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# fixed: what the file's normaliser and splitter must be
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALISERS = ["NFC", "Replace", "Lowercase"]


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def lower(text: str) -> str:
    """Lower case character by character: a final sigma is like any other."""
    return "".join(c.lower() for c in text) if "Σ" in text else text.lower()


class Vocabulary:
    """Merges, tokens and splitting rules of one tokenizer file."""

    def __init__(self, text: str):
        self.text = text
        file = json.loads(text)
        model, steps = file["model"], file["normalizer"]["normalizers"]
        split = file["pre_tokenizer"]["pretokenizers"][0]
        if (
            model["type"] != "BPE" or model["dropout"] or model["unk_token"] or model["byte_fallback"]
            or model["continuing_subword_prefix"] or model["ignore_merges"] or not model["end_of_word_suffix"]
            or [s["type"] for s in steps] != NORMALISERS or split["pattern"] != {"Regex": PATTERN}
            or file["decoder"] or file["post_processor"]
        ):
            raise ValueError("this tokenizer file is of another kind")
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.tokens = dict((i, t) for t, i in vocab.items())
        self.special = {}
        for t in file["added_tokens"]:
            if t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]:
                raise ValueError("special tokens are matched as they are only")
            self.special[t["content"]] = t["id"]
            self.tokens[t["id"]] = t["content"]
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.final = np.array([vocab[s + suffix] for s in symbols], np.int64)
        self.base = max(self.tokens) + 1
        # tokens by id, to be gathered by an array of ids
        self.written = np.full(self.base, None, object)
        for i, t in self.tokens.items():
            self.written[i] = t.encode()
        self.merges, self.ranks, made = [], {}, {}
        for rank, (a, b) in enumerate(model["merges"]):
            left, right, new = vocab[a], vocab[b], vocab[a + b]
            if max(made.get(left, -1), made.get(right, -1)) > rank or new in made:
                raise ValueError("a merge comes before the merges of its parts")
            made[new] = rank
            self.merges.append((left, right, new))
            self.ranks[left * self.base + right] = rank
        keys = np.array(list(self.ranks), np.int64)
        self.key_order = np.argsort(keys)
        self.keys = keys[self.key_order]
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split
        self.split_chunks = re.compile(f"[{WHITE}]+").split
        self.find_words = regex.compile(PATTERN).findall
        self.cache: dict[str, bytes] = {"": b""}
        self.library = None
        self.assigned: set[str] = set()

    # ---- words ----

    def words(self, chunk: str) -> list[str]:
        """Words of a chunk without white space, normalised."""
        if not chunk.isascii():
            if not self.assigned.issuperset(chunk):
                new = {c for c in chunk if unicodedata.category(c) != "Cn"}
                self.assigned |= new
                if not new.issuperset(chunk):
                    return self._words_of_library(chunk)
            chunk = unicodedata.normalize("NFC", chunk)
        return self.find_words(lower(chunk))

    def _words_of_library(self, chunk: str) -> list[str]:
        """Characters newer than Python's tables are classed by the library's own."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.text)
            self.bytes_of = {c: b for b, c in enumerate(byte_symbols())}
        found = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(chunk))
        return [bytes(self.bytes_of[c] for c in w).decode() for w, _ in found]

    # ---- merges ----

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Token ids of each word, all words taken together, as little-endian 32-bit integers."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        stops = np.cumsum(size)
        raw = np.frombuffer(b"".join(words), np.uint8)
        ids = self.inner[raw]
        ids[stops - 1] = self.final[raw[stops - 1]]
        ahead = np.arange(1, len(ids) + 1)
        ahead[stops - 1] = -1
        back = np.arange(-1, len(ids) - 1)
        back[stops - size] = -1

        # the index: each merge's rank to all positions of its pair
        pairs = np.nonzero(ahead >= 0)[0]
        keys = ids[pairs] * self.base + ids[pairs + 1]
        found = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[found] == keys
        pairs, rank = pairs[hit], self.key_order[found[hit]]
        order = np.argsort(rank, kind="stable")
        pairs, rank = pairs[order], rank[order]
        active, first = np.unique(rank, return_index=True)
        index = {
            r: part.tolist() for r, part in zip(active.tolist(), np.split(pairs, first[1:]), strict=True)
        } if len(active) else {}

        # the same memory, element by element for rare pairs and as arrays for frequent ones
        sym, nxt, prv = (array("q", x.astype(np.int64).tobytes()) for x in (ids, ahead, back))
        whole = tuple(np.frombuffer(x, np.int64) for x in (sym, nxt, prv))
        base, ranks = self.base, self.ranks
        heap = active.tolist()
        while heap:
            rank = heapq.heappop(heap)
            left, right, new = self.merges[rank]
            at = index.pop(rank)
            if left != right and len(at) >= MANY:
                for r, positions in self._apply(whole, left, right, new, at):
                    if r in index:
                        index[r] += positions
                    else:
                        index[r] = positions
                        heapq.heappush(heap, r)
                continue
            for p in sorted(at):
                q = nxt[p]
                if q < 0 or sym[p] != left or sym[q] != right:
                    continue  # the pair has gone
                sym[p], sym[q] = new, -1
                after = nxt[p] = nxt[q]
                before = prv[p]
                made = []
                if after >= 0:
                    prv[after] = p
                    made.append((ranks.get(new * base + sym[after]), p))
                if before >= 0:
                    made.append((ranks.get(sym[before] * base + new), before))
                for r, place in made:
                    if r is None:
                        continue
                    if r in index:
                        index[r].append(place)
                    else:
                        index[r] = [place]
                        heapq.heappush(heap, r)
        ends = np.cumsum(np.add.reduceat(whole[0] >= 0, stops - size)).tolist() if len(words) else []
        left_over = whole[0][whole[0] >= 0].astype("<u4")
        return [left_over[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def _apply(self, whole: tuple, left: int, right: int, new: int, at: list[int]) -> Iterator[tuple[int, list[int]]]:
        """Merge one pair of two different symbols, whose places cannot overlap, everywhere; the pairs this makes."""
        sym, nxt, prv = whole
        p = np.unique(np.array(at, np.int64))
        p = p[(sym[p] == left) & (nxt[p] >= 0)]
        p = p[sym[nxt[p]] == right]
        q = nxt[p]
        after = nxt[q]
        sym[p], sym[q], nxt[p] = new, -1, after
        has = after >= 0
        prv[after[has]] = p[has]
        before = prv[p]
        first = np.concatenate([p[has], before[before >= 0]])
        keys = sym[first] * self.base + sym[nxt[first]]
        found = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[found] == keys
        first, rank = first[hit], self.key_order[found[hit]]
        order = np.argsort(rank, kind="stable")
        first, rank = first[order], rank[order]
        kinds, starts = np.unique(rank, return_index=True)
        places = first.tolist()
        stops = np.append(starts, len(places))[1:]
        for r, a, b in zip(kinds.tolist(), starts.tolist(), stops.tolist(), strict=True):
            yield r, places[a:b]

    # ---- texts ----

    def _forget(self, chunks: set[str]) -> None:
        """Keep only what these chunks need: the frequent ones are among those of any batch."""
        self.cache = {"": b""} | {c: self.cache[c] for c in chunks if c in self.cache}

    def _learn(self, chunks: set[str]) -> None:
        new = [c for c in chunks if c not in self.cache]
        words = [self.words(c) for c in new]
        distinct = sorted({w for ws in words for w in ws})
        ids = {}
        if distinct:
            merged = self.merge([w.encode() for w in distinct])
            ids = {w: t.tobytes() for w, t in zip(distinct, merged, strict=True)}
        for c, ws in zip(new, words, strict=True):
            self.cache[c] = b"".join([ids[w] for w in ws])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Token ids of each text, as little-endian 32-bit integers."""
        cut, seen = [], set()
        for t in texts:
            parts = self.split_special(t) if t and "<|" in t else [t or ""]
            parts = [p if k % 2 else self.split_chunks(p) for k, p in enumerate(parts)]
            for k, p in enumerate(parts):
                if k % 2 == 0:
                    seen.update(p)
            cut.append(parts)
        if len(self.cache) > CACHE:
            self._forget(seen)
        self._learn(seen)
        get = self.cache.__getitem__
        special = {s: np.array([i], "<u4").tobytes() for s, i in self.special.items()}
        return [
            b"".join([special[p] if k % 2 else b"".join(map(get, p)) for k, p in enumerate(parts)]) for parts in cut
        ]

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The text the file's library gives, in UTF-8: without a decoder, tokens between blanks."""
        return b" ".join(self.written[ids].tolist())

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(np.array(ids, np.int64)).decode()


_loaded: dict[int, Vocabulary] = {}


def _vocabulary(packed) -> Vocabulary:
    """One vocabulary per worker and file."""
    data = packed.value
    key = zlib.crc32(data)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Vocabulary(zlib.decompress(data).decode())
    return _loaded[key]


def _pack(df: DataFrame, path: str):
    with open(path, encoding="utf-8") as f:
        text = f.read()
    Vocabulary(text)  # refuse other kinds at once
    return df.sparkSession.sparkContext.broadcast(zlib.compress(text.encode()))


def encode(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, ids`` per row."""
    tune(docs.sparkSession)
    packed = _pack(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(packed)
        for b in batches:
            found = vocabulary.encode(b.column(1).to_pylist())
            offsets = np.cumsum([0, *(len(x) // 4 for x in found)]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(found), "<u4").astype(np.int32))
            ids = pa.ListArray.from_arrays(pa.array(offsets), values)
            yield pa.RecordBatch.from_arrays([b.column(0), ids], ["doc_id", "ids"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, decoded`` per row of ``doc_id, ids``; null ids decode to the empty text."""
    packed = _pack(encoded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(packed)
        for b in batches:
            texts = [vocabulary.decode(ids or []) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def _digest_rows(doc_id: pa.Array, ids: list[bytes], texts: list[bytes]) -> pa.RecordBatch:
    columns = [
        doc_id, pa.array([len(i) // 4 for i in ids], pa.int64()),
        pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
        pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def round_trip(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: texts encoded and decoded in one pass.

    One worker per task holds the vocabulary; ids and decoded texts do not travel.
    """
    tune(docs.sparkSession)
    packed = _pack(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(packed)
        for b in batches:
            ids = vocabulary.encode(b.column(1).to_pylist())
            texts = [vocabulary.decode_bytes(np.frombuffer(i, "<u4")) for i in ids]
            yield _digest_rows(b.column(0), ids, texts)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
