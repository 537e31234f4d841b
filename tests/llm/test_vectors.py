"""Whitening and hard negatives against plain versions."""

import math

import numpy as np
import pytest

from riskloom.llm import hard_negatives as negatives
from riskloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, id string, data string, n int, group int"


def vectors(seed, n, d, flat=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) / d
    x[:, d - flat:] = 0.25
    out = [(i, [float(np.float32(v)) for v in row], int(rng.integers(0, 3))) for i, row in enumerate(x)]
    out += [(1000 + i, out[3][1], 1) for i in range(4)] + [(0, *out[0][1:])]
    odd = [(2000, None, 1), (2001, [], 1), (2002, [float("nan")] + [0.0] * (d - 1), 1), (2003, [float("inf")] * d, 2), (2004, [1.0] * (d + 1), 1),
           (2005, [None] + [0.5] * (d - 1), 0), (None, out[1][1], 1), (2006, [3e30] * d, 1)]
    return out + odd


def frame(spark, rows):
    return spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA).repartition(3)


def usable(rows, d):
    return [r for r in rows if r[1] is not None and len(r[1]) == d and all(v is not None and math.isfinite(v) and abs(v) < 1e7 for v in r[1])]


@pytest.mark.parametrize(("n", "d", "flat"), [(300, 12, 0), (40, 24, 3), (9, 20, 0)])
def test_whitening(spark, n, d, flat):
    rows = vectors(n, n, d, flat)
    got = whitening.whitened(frame(spark, rows), components=16).collect()
    good = usable(rows, d)
    x = np.array([[math.floor(64 * v) + 1_000_000 for v in r[1]] for r in good])
    fit = np.unique(x, axis=0)
    m, sums = len(fit), fit.sum(0)
    y = fit - sums / m
    values, axes = np.linalg.eigh(y.T @ y / m)
    values, axes = values[::-1], axes[:, ::-1]
    count = min(16, int((values > values[0] * 1e-12).sum()))
    assert len(got) == len(good) * count and {r["n"] for r in got} == {m}
    by_row = {}
    for r in got:
        by_row.setdefault((r["vec_id"], r["component"]), set()).add((r["whitened"], r["deviation"]))
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-9) and r["identity_error"] < 1e-9
    signs = {}
    for (i, *_), one in zip(good, x.tolist(), strict=True):
        for k in range(1, count + 1):
            (w, deviation), = by_row[i, k]
            assert deviation == sum((m * a - int(s)) ** 2 for a, s in zip(one, sums, strict=True))
            want = (np.array(one) - sums / m) @ axes[:, k - 1] / math.sqrt(values[k - 1])
            if abs(want) > 1e-3:
                assert abs(w) == pytest.approx(abs(want), rel=1e-6)
                signs.setdefault(k, set()).add(w * want > 0)
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_odd_tables(spark):
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None, 1)], [(1, [0.5, 2.0], 1)] * 3):
        got = whitening.whitened(frame(spark, rows))
        assert got.columns == names and got.collect() == []
    huge = whitening.Centred(np.array([10, 20], object), 3)
    x = np.array([[2 ** 30, -5], [3, 7]])
    assert huge.deviation(x).to_pylist()[1] == (9 - 10) ** 2 + (21 - 20) ** 2
    assert huge.deviation(x).to_pylist()[0] is None or huge.deviation(x).to_pylist()[0] == (3 * 2 ** 30 - 10) ** 2 + 35 ** 2


def test_triangular_solves_and_shift():
    rng = np.random.default_rng(3)
    y = rng.normal(size=(500, 8)) * 10.0 ** -np.arange(8)  # condition 1e7: one plain pass fails
    q, rs = y, []
    for k in range(5):
        r = whitening.factor(q.T @ q, len(y), k == 0)
        assert np.allclose(np.tril(r, -1), 0)
        q = whitening.solved(q, r)
        rs.append(r)
    assert np.abs(q.T @ q - np.eye(8)).max() < 1e-12
    product = np.linalg.multi_dot(rs[::-1])
    assert np.allclose(np.linalg.svd(product)[1], np.linalg.svd(y)[1], rtol=1e-9)


def mined(rows, d, step, positives=5, count=10):
    good = {}
    for r in rows:
        if r[0] is not None and r[2] is not None and r[1] and all(v is not None and math.isfinite(v) and abs(v) < 1e5 for v in r[1]):
            x = tuple(math.floor(256 * v) for v in r[1])
            good[r[0]] = min(good.get(r[0], (r[2], x)), (r[2], x))
    out = []
    for a, (label, x) in good.items():
        if a % step:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y, strict=True)), i, own) for i, (own, y) in good.items() if i != a and len(y) == len(x))
        for p, i, _ in [s for s in scored if s[2] == label][:positives]:
            window = [(j, -n) for n, j, own in scored if own != label and 30 * -p <= 100 * -n <= 90 * -p]
            out += [(a, i, k, j, -p, n) for k, (j, n) in enumerate(window[:count], 1)]
    return sorted(out)


@pytest.mark.parametrize(("n", "d", "least", "most"), [(240, 6, 1024, 1 << 15), (240, 6, 20, 1 << 15), (90, 3, 1024, 7)])
def test_hard_negatives(spark, n, d, least, most):
    rows = vectors(n + d, n, d)
    rows += [(3000 + 5 * i, [0.0] * (d - 1) + [float(i % 2)], i % 3) for i in range(12)]  # ties and scores of 0
    rows += [(5, [9.0] * d, 2), (10, [1.0] * d, None)]
    df = frame(spark, rows)
    got = negatives.hard_negatives(df, df["vec_id"] % 5 == 0, most_rows=most, least_rows=least)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = mined(rows, d, 5)
    assert sorted(map(tuple, got.collect())) == want and any(w[4] == 0 for w in want)


def test_hard_negatives_odd_tables(spark):
    for rows in ([], [(0, None, 1)], [(0, [1.0, 2.0], 1)] * 3, [(0, [1.0], 1), (5, [1.0], 1), (7, [0.5, 0.5], 2)]):
        df = frame(spark, rows)
        assert negatives.hard_negatives(df, df["vec_id"] % 5 == 0).collect() == []


def test_products_are_exact():
    rng = np.random.default_rng(1)
    for top in (2 ** 8, 2 ** 25):
        a, b = rng.integers(-top, top, (5, 40)), rng.integers(-top, top, (7, 40))
        assert negatives.exact_product(a, b).tolist() == [[sum(int(p) * int(q) for p, q in zip(x, y, strict=True)) for y in b] for x in a]
