"""Answers from day cells against those from the rows."""

import math
from itertools import combinations

import numpy as np
import pytest

from salescope.operators import hypothesis as H
from salescope.operators import profile as PR
from salescope.operators.daycells import day_cells

VARS = ["units", "discount", "amount", "age"]
SCHEMA = ("ts timestamp_ntz, channel string, store long, units long, discount double, amount double, age double, "
          "outlier_amount int")


def sales(spark, n, seed):
    import datetime as dt
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        day = dt.datetime(2024, 4, 20) + dt.timedelta(days=int(rng.integers(0, 30)), seconds=int(rng.integers(0, 86_400)))
        if i % 9 == 0:
            day = day.replace(hour=23, minute=59, second=59, microsecond=int(rng.integers(0, 2)) * 500_000)
        rows.append((None if i % 40 == 0 else day, "ABC"[rng.integers(0, 3)], int(rng.integers(0, 7)), int(rng.integers(1, 6)),
                     None if i % 11 == 0 else float(rng.integers(0, 5)) / 10, float(rng.integers(1, 90)), float(rng.integers(18, 70)),
                     int(rng.random() < 0.1)))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("start,end", [("2024-04-25", "2024-05-03"), ("2024-05-01", "2024-05-01"), (None, "2024-04-30"),
                                       (None, None), ("2025-01-01", "2025-02-01")])
def test_ranges(spark, start, end):
    old, new = sales(spark, 500, 1), sales(spark, 130, 2)
    both = old.unionByName(new)
    part = PR.period(both, start, end)
    cells = day_cells(old, VARS, tuples=VARS).merged(day_cells(new, VARS, tuples=VARS)).between(start, end)
    got, want = cells.kpis().first().asDict(), PR.period_kpis(part).first().asDict()
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-12) for k in want)
    q = {(r["variable"], r["q"]): r["quantile"] for r in cells.quantiles().collect()}
    assert q == pytest.approx({(r["variable"], r["q"]): r["quantile"] for r in PR.quantile_table(part, VARS).collect()}, rel=1e-12)
    pairs = list(combinations(VARS, 2))
    rho = {(r["var_a"], r["var_b"]): (r["n"], r["rho"]) for r in cells.spearman(pairs).collect()}
    for r in H.spearman_pairs(part, pairs).collect():
        n, value = rho[r["var_a"], r["var_b"]]
        assert n == r["n"] and (value is None if r["rho"] is None else math.isclose(value, r["rho"], rel_tol=1e-10, abs_tol=1e-12))
    daily = {r["day"]: r["amount"] for r in cells.daily().collect()}
    assert daily == pytest.approx({r["day"]: r["amount"] for r in PR.daily_sales(part).collect()})


def test_a_range_that_ends_before_it_starts(spark):
    with pytest.raises(ValueError):
        day_cells(sales(spark, 5, 3), VARS, tuples=VARS).between("2024-05-02", "2024-05-01")


def test_only_the_cells_asked_for_are_stored(monkeypatch):
    """Indicators need no tuples, and no table of all checked lines."""
    from salescope.plans import catalog as CA

    class Cells:
        def stored(self, store):
            return [store(name, name) for name in ("moments", "members", "values", "tuples")]

    monkeypatch.setattr(CA.DC, "day_cells", lambda df: Cells())
    monkeypatch.setattr(CA, "clean_sales", lambda *a, **k: None)
    monkeypatch.setattr(CA, "written_table", lambda spark, name, d, build, by: f"stored {name}")
    assert CA._day_cells(None, "d", "moments", "values") == ["stored day-moments", "members", "stored day-values", "tuples"]
