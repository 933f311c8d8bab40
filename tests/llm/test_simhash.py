"""Fingerprints and components against plain loops over all pairs."""

import random

import numpy as np
import pytest
import xxhash

from broadsheet.llm import queries, simhash
from broadsheet.llm.common import table

SPACE = " \t\n\x0b\f\r"


def plain_words(text):
    out, word = [], ""
    for c in text or "":
        if c in SPACE:
            out, word = (out + [word] if word else out), ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    return out + [word] if word else out


def plain_fingerprint(text):
    ws = plain_words(text)
    if not ws:
        return 0
    grams = [" ".join(ws[i : i + 3]) for i in range(max(1, len(ws) - 2))]
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(ids, fps):
    distinct = sorted(set(fps))
    up = {f: f for f in distinct}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    values = np.array(distinct, np.uint64)
    for i, f in enumerate(distinct):
        for j in np.nonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= 3)[0] + i + 1:
            up[top(int(values[j]))] = top(f)
    least = {}
    for i, f in zip(ids, fps):
        if i is not None:
            least[top(f)] = min(least.get(top(f), i), i)
    return [least.get(top(f)) for f in fps]


TEXTS = [
    None, "", " \n\t", "one", "Two words", "a b c", "A B C", "Ä b c", "a\x1cb c d e", "x y z  q\x0br",
    "the same text twice over " * 30, "The same text twice over " * 30, "émile é É " * 5, "w " * 5000,
]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_groups_with_nulls_repeats_and_extra_columns(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "one", "y"), (3, "one", "y"), (3, "one", "y"), (None, "lonely words here", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted(map(tuple, simhash.near_duplicates(df).collect()), key=repr)
    fps = [plain_fingerprint(r[1]) for r in rows]
    want = [(r[0], f"{f:016x}", c) for r, f, c in zip(rows, fps, plain_components([r[0] for r in rows], fps))]
    assert got == sorted(want, key=repr)
    kept = simhash.keep_one(df).collect()
    assert kept[0].asDict().keys() == {"doc_id", "text", "component_id"}
    groups_ = {c if c is not None else f for _, f, c in want}
    assert len(kept) == len(groups_)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).collect() == [] and simhash.keep_one(df).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_tree_finds_every_pair(seed):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(40)]
    points = set(centres)
    for c in centres:
        for _ in range(60):
            for _ in range(rng.randint(1, 4)):
                c ^= 1 << rng.randrange(64)
            points.add(c)
    points = np.array(sorted(points), np.uint64)
    got = {(int(i), int(j)) for a, b in simhash.probe(simhash.build(points), points, points) for i, j in zip(a, b)}
    d = np.bitwise_count(points[:, None] ^ points[None, :])
    assert got == {(int(i), int(j)) for i, j in zip(*np.nonzero(d <= 3))}


def test_chains_across_many_shards(spark):
    rng = random.Random(7)
    points = []
    for _ in range(60):
        f = rng.getrandbits(64)
        for _ in range(40):
            points.append(f)
            for b in rng.sample(range(64), rng.randint(1, 5)):
                f ^= 1 << b
    signed = sorted({p - (1 << 64) if p >> 63 else p for p in points})
    edges = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "fp long"), shard_rows=16)
    stars = {r[0]: r[1] for r in simhash.components(edges).collect()}
    want = plain_components([p % (1 << 64) for p in signed], [p % (1 << 64) for p in signed])
    groups_, plain = {}, {}
    for p, w in zip(signed, want):
        groups_.setdefault(stars.get(p, p), set()).add(p)
        plain.setdefault(w, set()).add(p)
    assert sorted(map(sorted, groups_.values())) == sorted(map(sorted, plain.values()))


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = table(spark, folder, "documents").select("doc_id", "text").collect()
    fps = [plain_fingerprint(r[1]) for r in rows]
    want = {(r[0], f"{f:016x}", c) for r, f, c in zip(rows, fps, plain_components([r[0] for r in rows], fps))}
    assert {tuple(r) for r in queries.QUERIES["op10_simhash_groups"](spark, folder).collect()} == want
