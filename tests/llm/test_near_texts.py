"""Groups of similar texts against the similarity of every pair that shares a shingle."""

import random
from collections import Counter, defaultdict

import pytest
from test_simhash import plain_words

from broadsheet.llm import near_texts
from broadsheet.llm.common import table
from broadsheet.session import settings


def grams(text, size=5):
    ws = plain_words(text)
    return {tuple(ws[i : i + size]) for i in range(max(1, len(ws) - size + 1))} if ws else set()


def plain_pairs(texts, similarity=0.8):
    """Positions of all pairs of texts that are similar enough."""
    sets = [grams(t) for t in texts]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s or {None}:  # texts without words are near each other
            holders[g].append(i)
    shared = Counter((i, j) for at in holders.values() for k, i in enumerate(at) for j in at[k + 1 :])
    return [
        (i, j) for (i, j), n in shared.items()
        if not sets[i] or n >= similarity * (len(sets[i]) + len(sets[j]) - n) - 1e-9
    ]


def plain_groups(ids, texts):
    """The smallest id that each row reaches."""
    up = list(range(len(ids)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in plain_pairs(texts):
        up[top(j)] = top(i)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[top(i)] = min(x, least.get(top(i), x))
    return [least.get(top(i)) for i in range(len(ids))]


def edited(rng, words, n):
    words = list(words)
    for at in rng.sample(range(len(words)), n):
        words[at] = f"e{rng.randrange(10**6)}"
    return words


def family_texts(seed):
    """Families of edited copies, chains of edits, texts that only share a long passage, and odd ones."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = rng.choices(vocabulary, k=120)
    texts = []
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.randint(60, 300))
        texts += [" ".join(edited(rng, base, max(1, int(len(base) * rng.choice([0.005, 0.01, 0.05]))))) for _ in range(8)]
        chain = base
        for _ in range(6):
            chain = edited(rng, chain, max(1, len(chain) // 100))
            texts.append(" ".join(chain))
    texts += [" ".join(passage + rng.choices(vocabulary, k=rng.randint(40, 200))) for _ in range(60)]
    texts += [" ".join(rng.choices(vocabulary, k=rng.randint(1, 30))) for _ in range(40)]
    return texts + [None, "", " \n", "one two", "ONE  two", "one two three", "w " * 20_000, texts[0].upper()]


@pytest.mark.parametrize("seed, cell_rows", [(1, 8192), (2, 4)])
def test_groups(spark, seed, cell_rows):
    texts = family_texts(seed)
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, texts[3], "y"), (5, texts[5], "x"), (5, texts[5], "x"), (None, "lonely", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, root string")
    got = sorted(map(tuple, near_texts.near_duplicates(df, cell_rows=cell_rows).collect()), key=repr)
    want = plain_groups([r[0] for r in rows], [r[1] for r in rows])
    assert got == sorted([(r[0], g) for r, g in zip(rows, want)], key=repr)
    kept = near_texts.keep_one(df, cell_rows=cell_rows)
    assert kept.columns == ["doc_id", "text", "root"]
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted({g for g in want if g is not None})
    assert kept.filter("doc_id is null").count() == 1


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_texts.near_duplicates(df).collect() == [] and near_texts.keep_one(df).collect() == []


@pytest.mark.parametrize("edit, low", [(0.02, 0.97), (0.01, 0.99)])
def test_sketches_let_similar_pairs_pass(edit, low):
    """Share of pairs about and above 0.8 that share a band and lie within both radii."""
    rng = random.Random(3)
    found = total = 0
    for _ in range(400):
        base = [f"w{rng.randrange(5000)}" for _ in range(250)]
        other = edited(rng, base, round(len(base) * edit))
        a, b = (near_texts.shingles(" ".join(t)) for t in (base, other))
        common = len(set(a.tolist()) & set(b.tolist()))
        if common < 0.8 * (len(a) + len(b) - common):
            continue
        x, y = near_texts.sketch(a), near_texts.sketch(b)
        apart = [(p ^ q) & (2**64 - 1) for p, q in zip(x[:3], y[:3])]
        bits = [v.bit_count() for v in apart]
        total += 1
        differ = sum(p != q for p, q in zip(x[4], y[4]))
        found += differ <= near_texts.SKETCH_BYTES and bool(
            set(x[3].tolist()) & set(y[3].tolist()) and bits[0] <= near_texts.RADIUS and bits[1] + bits[2] <= near_texts.SKETCH_BITS
        )
    assert total > 100 and found >= low * total


def test_recall_on_documents(spark):
    rows = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").collect()
    group = {r[0]: r[1] for r in near_texts.near_duplicates(table(spark, "/root/testdata/sf0.01", "documents")).collect()}
    pairs = [(rows[i][0], rows[j][0]) for i, j in plain_pairs([r[1] for r in rows])]
    met = sum(group[a] == group[b] for a, b in pairs)
    print(len(pairs), "pairs,", met, "met")
    assert met >= 0.99 * len(pairs)
    want = plain_groups([r[0] for r in rows], [r[1] for r in rows])
    # no group joins texts that no chain of links connects
    plain = dict(zip([r[0] for r in rows], want))
    assert all(plain[d] == plain[g] for d, g in group.items())


def test_texts_are_dealt_out_twice(spark, monkeypatch):
    """Once for all rounds together, and once for the kept documents and their repeated rows."""
    hashed, own = [], near_texts._hashes
    monkeypatch.setattr(near_texts, "_hashes", lambda c: hashed.append(c) or own(c))
    df = spark.createDataFrame(list(enumerate(family_texts(1))), "doc_id long, text string")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        kept = near_texts.keep_one(df)
        plan = kept._jdf.queryExecution().executedPlan().toString()
    assert len(hashed) == 3  # the classes, the texts of cells, the kept documents
    above = plan[: plan.index("LeftSemi")]
    assert "Aggregate" in above and "Exchange" not in above


def test_repeated_rows_without_an_id(spark):
    rows = [(None, "one two"), (None, "one two"), (0, "three four"), (0, "three four"), (0, "five six"), (None, None), (None, "")]
    kept = near_texts.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted(((r[0], r[1] or "") for r in kept), key=repr)
    assert got == sorted([(None, "one two"), (0, "three four"), (0, "five six"), (None, "")], key=repr)
