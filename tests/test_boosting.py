"""Leaf-wise boosting against a tree grown by plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescope.operators import boosting as B


def brute_fit(x, y, rounds, rate, leaves, l2, min_leaf):
    """Trains on the values themselves; every distinct value is a possible cut."""
    base = y.mean()
    resid = np.rint((y - base) * B.SCALE)
    fitted = np.full(len(y), base)
    for _ in range(rounds):
        parts = [np.arange(len(y))]

        def best(rows):
            top = None
            total, n = resid[rows].sum() / B.SCALE, len(rows)
            for j in range(x.shape[1]):
                for v in np.unique(x[rows, j])[:-1]:
                    left = rows[x[rows, j] <= v]
                    gl, nl = resid[left].sum() / B.SCALE, len(left)
                    if nl < min_leaf or n - nl < min_leaf:
                        continue
                    gain = round(gl ** 2 / (nl + l2) + (total - gl) ** 2 / (n - nl + l2) - total ** 2 / (n + l2), 9)
                    if gain > 0 and (top is None or gain > top[0]):
                        top = (gain, j, v)
            return top

        cuts = [best(parts[0])]
        while len(parts) < leaves and any(cuts):
            k = max((c[0], -i) for i, c in enumerate(cuts) if c)[1] * -1
            _, j, v = cuts[k]
            rows = parts[k]
            for part in (rows[x[rows, j] <= v], rows[x[rows, j] > v]):
                parts.append(part)
                cuts.append(best(part))
            del parts[k], cuts[k]
        if len(parts) == 1:
            break
        for rows in parts:
            step = rate * (resid[rows].sum() / B.SCALE) / (len(rows) + l2)
            fitted[rows] += step
            resid[rows] -= np.rint(step * B.SCALE)
    return fitted


def frame(spark, x, y):
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"x{j} double" for j in range(x.shape[1])) + ", y double")


@pytest.mark.parametrize("gather", [0, 40, 1 << 14])
@pytest.mark.parametrize("leaves,min_leaf", [(6, 3), (31, 1)])
def test_equals_brute_force(spark, monkeypatch, leaves, min_leaf, gather):
    monkeypatch.setattr(B, "GATHER", gather)
    rng = np.random.default_rng(leaves)
    x = np.stack([rng.integers(0, 12, 150), rng.integers(0, 3, 150), rng.normal(size=150).round(2)], axis=1)
    y = np.log1p(50 + 3 * x[:, 0] * (x[:, 1] == 1) + 10 * (x[:, 2] > 0.3) + rng.random(150))
    df = frame(spark, x, y)
    args = dict(rounds=4, rate=0.3, leaves=leaves, l2=0.05, min_leaf=min_leaf)
    model = B.fit(df.repartition(3), ["x0", "x1", "x2"], F.col("y"), **args)
    got = {r.id: r.prediction for r in B.predict(df, model).select("id", "prediction").collect()}
    want = brute_fit(x, y, **args)
    assert np.allclose([got[i] for i in range(len(y))], want, atol=1e-6)
    assert len(model.trees) == 4 and all(sum(f < 0 for f in t.feature) <= leaves for t in model.trees)
    assert all(a > b for a, b in zip(model.losses, model.losses[1:], strict=False))


def test_partitioning_does_not_matter(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 2))
    y = np.sin(3 * x[:, 0]) + 0.1 * rng.normal(size=700)
    df = frame(spark, x, y)
    monkeypatch.setattr(B, "GATHER", 100)
    one = B.fit(df.coalesce(1), ["x0", "x1"], F.col("y"), rounds=5)
    monkeypatch.setattr(B, "ROWS_PER_TASK", 200)
    monkeypatch.setattr(B, "CUT", 2)
    many = B.fit(df.repartition(5, "id"), ["x0", "x1"], F.col("y"), rounds=5)
    assert one.trees == many.trees and [list(b) for b in one.bounds] == [list(b) for b in many.bounds]
    assert max(len(b) for b in one.bounds) in (254, 255, 256)


def test_small_and_constant_inputs(spark):
    rng = np.random.default_rng(4)
    for n in (1, 2, 5, 9):
        x, y = rng.normal(size=(n, 2)), rng.normal(size=n)
        model = B.fit(frame(spark, x, y), ["x0", "x1"], F.col("y"), rounds=3)
        got = B.predict(frame(spark, x, y), model).collect()
        assert not model.trees and all(abs(r.prediction - y.mean()) < 1e-9 for r in got)
    same = B.fit(frame(spark, np.ones((60, 2)), rng.normal(size=60)), ["x0", "x1"], F.col("y"), rounds=3)
    flat = B.fit(frame(spark, rng.normal(size=(60, 2)), np.full(60, 7.0)), ["x0", "x1"], F.col("y"), rounds=3)
    assert not same.trees and not flat.trees and flat.base == 7.0
    none = B.fit(frame(spark, np.ones((1, 2)), np.ones(1)).limit(0), ["x0", "x1"], F.col("y"))
    assert none.base == 0.0 and not none.trees


def test_stops_when_nothing_is_gained(spark):
    x = np.repeat(np.arange(40.0), 5)[:, None]
    y = (x[:, 0] > 19).astype(float)
    model = B.fit(frame(spark, x, y), ["x0"], F.col("y"), rounds=200, rate=1.0, l2=0.0)
    assert len(model.trees) < 15 and model.losses[-1] < 1e-12


def test_one_of_two_large_children_is_summed(spark, monkeypatch):
    """The other one's sums are its parent's less its sibling's."""
    monkeypatch.setattr(B, "GATHER", 0)
    asked, fetched = [], B._fetched

    def counted(blocks, tree, wanted, *rest):
        asked.append(len(wanted))
        return fetched(blocks, tree, wanted, *rest)

    monkeypatch.setattr(B, "_fetched", counted)
    rng = np.random.default_rng(5)
    x = rng.integers(0, 40, (300, 2)).astype(float)
    model = B.fit(frame(spark, x, x[:, 0] + (x[:, 1] > 20) + rng.random(300)), ["x0", "x1"], F.col("y"), rounds=1, leaves=8, min_leaf=5)
    nodes = sum(f < 0 for f in model.trees[0].feature) * 2 - 1
    assert nodes > 8 and sum(asked) <= 1 + sum(2 ** k for k in range(len(asked) - 1))


def test_all_rows_are_summed_once(spark, monkeypatch):
    """Sums and loss behind a tree follow from its leaves: only the first tree asks for the root, and losses are exact."""
    monkeypatch.setattr(B, "GATHER", 0)
    asked, fetched = [], B._fetched

    def counted(blocks, tree, wanted, *rest):
        asked.append(list(wanted))
        return fetched(blocks, tree, wanted, *rest)

    monkeypatch.setattr(B, "_fetched", counted)
    rng = np.random.default_rng(6)
    x = rng.integers(0, 30, (400, 3)).astype(float)
    y = x[:, 0] + (x[:, 1] > 20) * 3 + rng.random(400)
    model = B.fit(frame(spark, x, y), ["x0", "x1", "x2"], F.col("y"), rounds=4, leaves=6)
    assert asked.count([0]) == 1 and len(model.trees) == 4
    bins = B.binned(model.bounds, list(x.T))
    resid = np.rint((y - model.base) * B.SCALE).astype(np.int64)
    for tree, loss in zip(model.trees, model.losses, strict=True):
        assert loss == sum(int(r) ** 2 for r in resid) / B.SCALE ** 2 / len(y)
        resid -= np.rint(np.array(tree.value) * B.SCALE).astype(np.int64)[B.leaf_of(tree, bins)]


def test_features_of_few_bins_share_a_code():
    rng = np.random.default_rng(7)
    sizes = [50, 11, 255, 2, 1, 12, 7, 2, 255]
    packing = B.Packing(sizes)
    assert len(packing.groups) < 5 and max(packing.values) <= B.CODES
    assert sorted(j for group in packing.groups for j in group) == list(range(len(sizes)))
    bins = np.stack([rng.integers(0, n, 3000) for n in sizes]).astype(np.uint8)
    resid = rng.integers(-10 ** 9, 10 ** 9, 3000)
    codes = packing.codes(bins)
    for rows in (None, np.flatnonzero(bins[0] < 20)):
        g, n = (packing.table(packing.sums(x)) for x in packing.counted(codes, resid, rows))
        at = slice(None) if rows is None else rows
        for j in range(len(sizes)):
            assert (packing.bins(j)[codes[packing.column[j]]] == bins[j]).all()
            assert (n[j] == np.bincount(bins[j][at], minlength=255)).all()
            assert (g[j] == np.bincount(bins[j][at], resid[at].astype(float), 255)).all()


def test_tasks_for_all_cores():
    assert [B._tasks(n, 8) for n in (0, 99_999, 250_000, 2_500_000, 40_000_000, 150_000_000)] == [1, 1, 2, 8, 16, 40]
