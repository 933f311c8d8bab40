"""Whitening against numpy over all rows, and defined cases."""

import numpy as np
import pytest

from broadsheet.llm import queries, whitening
from broadsheet.llm.common import table

COLUMNS = "vec_id long, embedding array<double>, x string, key string, n long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "k", 1) for i, v in rows], COLUMNS)


def expected(rows, k=32, once=False):
    """Per row: exact deviation and whitened row of numpy; then n, eigenvalue shares."""
    width = max(len(v) for _, v in rows)
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] + [1_000_000] * (width - len(v)) for _, v in rows]
    fit = [list(t) for t in dict.fromkeys(map(tuple, x))] if once else x
    n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    d = np.array([[(n * a - b) / n for a, b in zip(r, s, strict=True)] for r in fit])
    v = d.T @ d / n
    e, a = np.linalg.eigh(v)
    e, a = e[::-1][:k], a[:, ::-1][:, :k]
    dev = [sum((n * p - q) ** 2 for p, q in zip(r, s, strict=True)) for r in x]
    all_d = np.array([[(n * p - q) / n for p, q in zip(r, s, strict=True)] for r in x])
    return n, dev, all_d @ a / np.sqrt(e), e / np.trace(v)


def check(got, rows, **kw):
    n, dev, y, share = expected(rows, **kw)
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    assert sorted(by) == sorted(i for i, _ in rows) and len(got) == len(rows) * y.shape[1]
    signs = None
    for at, (i, _) in enumerate(rows):
        mine = [by[i][c] for c in range(1, y.shape[1] + 1)]
        assert {r["n"] for r in mine} == {n} and {r["deviation"] for r in mine} == {dev[at]}
        w = np.array([r["whitened"] for r in mine])
        signs = np.sign(w * y[at]) if signs is None else signs
        assert np.allclose(w, y[at] * signs, atol=1e-6)
        assert np.allclose([r["explained"] for r in mine], share, rtol=1e-6)
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and 0 <= got[0]["identity_error"] < 1e-6


def test_copies_and_hot_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(2500, 5)) * [3, 2, 1, 0.5, 0.25]
    rows = [(i, base[i].tolist()) for i in range(2500)] + [(3000 + i, base[i % 3].tolist()) for i in range(1200)]
    check(whitening.whiten(frame(spark, rows)).collect(), rows)
    check(whitening.whiten(frame(spark, rows), components=2, weights="one").collect(), rows, k=2, once=True)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, folder, "embeddings").collect()]
    check(queries.QUERIES["op12_weighted_whitening"](spark, folder).collect(), rows)


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(90, None), (91, [1.0, None]), (92, [nan, 1.0]), (93, [inf, 1.0]), (94, [1e30, 0.0])]
    good = [(1, [1.0, 2.0]), (2, [3.0, -2.0]), (3, [0.5]), (4, [])]
    check(whitening.whiten(frame(spark, good + bad)).collect(), good)
    assert whitening.whiten(frame(spark, [])).collect() == whitening.whiten(frame(spark, bad)).collect() == []
    assert whitening.whiten(frame(spark, [(1, [])])).collect() == []
    # one distinct vector: no variance
    same = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])])).collect()
    assert sorted((str(r["vec_id"]), r["component"]) for r in same) == [("1", 1), ("1", 1), ("1", 2), ("1", 2), ("None", 1), ("None", 2)]
    assert {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in same} == {(3, 0, None, None, None)}
    # a flat dimension has no component of its own
    flat = whitening.whiten(frame(spark, [(i, [float(i), 7.0]) for i in range(10)])).collect()
    assert {(r["component"], r["whitened"] is None) for r in flat} == {(1, False), (2, True)}
    assert flat[0]["identity_error"] < 1e-9
    with pytest.raises(ValueError):
        whitening.whiten(frame(spark, good), weights="two")


def test_large_numbers(spark):
    rows = [(i, [1e12 * i, float(i % 7)]) for i in range(40)]
    got = whitening.whiten(frame(spark, rows)).collect()
    _, dev, _, _ = expected(rows)
    want = {i: d if d < 2**63 else None for (i, _), d in zip(rows, dev, strict=True)}
    assert {r["vec_id"]: r["deviation"] for r in got} == want and None in want.values()
