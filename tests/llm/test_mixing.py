"""Raking and sampling against numpy, and the pipeline against plain Python."""

import hashlib

import numpy as np
import pytest
from test_near_texts import plain_groups

import corpus_pipeline
from broadsheet.llm import mixing, queries
from broadsheet.llm.common import table

DIMS = ["source", "lang", "topic"]


def plain_targets(rows, dim, mix):
    sums = {}
    for r in rows:
        sums[r[dim]] = sums.get(r[dim], 0) + r["n_tokens"]
    sums = {k: v for k, v in sums.items() if v}
    given = {k: v for k, v in mix.targets.get(dim, {}).items() if k in sums}
    open_ = {k: v ** mix.temperatures.get(dim, 1.0) for k, v in sums.items() if k not in given}
    rest = max(0.0, 1 - sum(given.values())) if open_ else 0.0
    out = given | {k: rest * v / sum(open_.values()) for k, v in open_.items()}
    return {k: v / sum(out.values()) for k, v in out.items()}


def plain_mix(rows, mix, rounds=400):
    cells = {}
    for r in rows:
        key = tuple(r[d] for d in DIMS)
        cells[key] = cells.get(key, 0) + r["n_tokens"]
    keys, t = list(cells), np.array(list(cells.values()), float)
    w, total = t.copy(), t.sum()
    for _ in range(rounds):
        for k, d in enumerate(DIMS):
            goal = plain_targets(rows, d, mix)
            for v in {key[k] for key in keys}:
                at = np.array([key[k] == v for key in keys])
                if w[at].sum() > 0:
                    w[at] *= goal[v] * total / w[at].sum()
    factor = np.where(t > 0, w / np.where(t > 0, t, 1), 1.0)
    low, high = 0.0, 1 / factor[factor > 0].min()
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (low, mid) if (t * np.minimum(1, factor * mid)).sum() >= min(mix.share * total, t[factor > 0].sum()) else (mid, high)
    return {k: min(1.0, f * high) for k, f in zip(keys, factor)}


def test_query_against_numpy(spark):
    got = queries.QUERIES["op1_raked_mixture"](spark, "/root/testdata/sf0.01").collect()
    want = plain_mix(got, queries.MIX)
    assert len(got) == 1000
    for r in got:
        assert r["probability"] == pytest.approx(want[tuple(r[d] for d in DIMS)], abs=2e-5)
        mark = hashlib.md5(f"mix/{r['doc_id']}".encode()).hexdigest()[:13]
        if abs(int(mark, 16) / 16**13 - r["probability"]) > 1e-4:
            assert r["sampled"] == (int(mark, 16) / 16**13 < r["probability"])


@pytest.mark.parametrize("small", [0, 50_000])
def test_nulls_repeats_and_empty(spark, monkeypatch, small):
    monkeypatch.setattr(mixing, "SMALL_CELLS", small)
    rows = [(i, "w " * (i % 9), "en" if i % 3 else None, "s" if i % 2 else None, 1) for i in range(40)]
    rows += [(None, None, None, None, 1), (3, "w w w", "en", "s", 1), (3, "w w w", "en", "s", 1), (50, "x" * 300_000, "de", "t", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, probability int")
    mix = mixing.Mix(targets={"lang": {"en": 0.5, "xx": 0.2}}, share=0.4)
    got = mixing.mix_documents(df, mix).collect()
    want = plain_mix(got, mix)
    assert len(got) == len(rows)
    assert all(r["probability"] == pytest.approx(want[tuple(r[d] for d in DIMS)], abs=1e-4) for r in got)
    kept = mixing.sample(df, mix).collect()
    assert sorted(r["doc_id"] or -1 for r in kept) == sorted(r["doc_id"] or -1 for r in got if r["sampled"])
    assert kept[0].asDict().keys() == {"doc_id", "text", "lang", "source", "probability"}
    assert mixing.mix_documents(df.limit(0), mix).collect() == [] and mixing.sample(df.limit(0), mix).collect() == []


def test_stages_take_effect(spark):
    folder = "/root/testdata/sf0.001"
    docs = table(spark, folder, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = stage(spark, docs, folder)
        after = {r["doc_id"]: r for r in docs.collect()}
        assert docs.columns == columns and after.keys() <= before.keys(), name
        if name == "near-duplicates":
            ids = sorted(before)
            groups_ = plain_groups(ids, [before[i]["text"] for i in ids])
            assert sorted(after) == sorted(set(groups_))
        if name == "personal data":
            assert after.keys() == before.keys() and after != before
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in rows} == set(after) and all(r["n_tokens"] >= 0 for r in rows)


def test_rows_without_an_id_are_drawn_one_by_one(spark):
    df = spark.createDataFrame([(None, f"w {i}", "en", "s") for i in range(400)], "doc_id long, text string, lang string, source string")
    assert 120 < mixing.sample(df, queries.MIX).count() < 280


@pytest.mark.parametrize("small", [0, 50_000])
def test_values_without_target_keep_their_share(spark, monkeypatch, small):
    """The targets of MIX sum to 1; a third of the rows is in none of its languages."""
    monkeypatch.setattr(mixing, "SMALL_CELLS", small)
    langs = ["en", "de", "fr", "es", "it", None]
    df = spark.createDataFrame(
        [(i, "w " * 10, langs[i % 6], "s") for i in range(600)], "doc_id long, text string, lang string, source string"
    )
    got = mixing.mix_documents(df, queries.MIX).collect()
    expected = {v: sum(r["probability"] for r in got if r["lang"] == v) for v in langs}
    assert all(r["probability"] > 0 and r["weight"] > 0 for r in got)
    # half of the 600 in all; a third of it without a target, the rest as in MIX
    uncut = {"it": 50, None: 50, "de": 30, "fr": 30, "es": 30}
    for v, n in uncut.items():
        assert expected[v] / expected["de"] == pytest.approx(n / 30, rel=1e-3)
    kept = {r["lang"] for r in mixing.sample(df, queries.MIX).collect()}
    assert {"it", None} <= kept
