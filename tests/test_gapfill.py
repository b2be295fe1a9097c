import random

import numpy as np
import pandas as pd
import pytest

from casaflow.operators.gapfill import interpolate_linear


def _run(spark, series):
    rows = [(sid, pos, v) for sid, vals in series.items() for pos, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "sid string, pos int, v double")
    out = interpolate_linear(df, ["sid"], "pos", "v", "filled").collect()
    got = {}
    for r in out:
        got.setdefault(r.sid, {})[r.pos] = r.filled
    return {k: [got[k][i] for i in range(len(v))] for k, v in series.items()}


def _pandas(vals):
    s = pd.DataFrame([vals], dtype="float64").interpolate(method="linear", axis=1,
                                                          limit_area="inside")
    return [None if np.isnan(x) else float(x) for x in s.iloc[0].tolist()]


def test_edge_cases(spark):
    series = {
        "leading": [None, None, 1.0, 2.0],
        "trailing": [1.0, 2.0, None, None],
        "one_gap": [1.0, None, 3.0],
        "long_gap": [10.0, None, None, None, 50.0],
        "all_null": [None, None, None],
        "single": [None, 5.0, None],
        "full": [1.0, 2.0, 3.0],
    }
    got = _run(spark, series)
    assert got["leading"] == [None, None, 1.0, 2.0]
    assert got["trailing"] == [1.0, 2.0, None, None]
    assert got["one_gap"] == [1.0, 2.0, 3.0]
    assert got["long_gap"] == [10.0, 20.0, 30.0, 40.0, 50.0]
    assert got["all_null"] == [None, None, None]
    assert got["single"] == [None, 5.0, None]
    assert got["full"] == [1.0, 2.0, 3.0]


def test_position_not_calendar(spark):
    # positions 0,1,2 even if the months behind them are unevenly spaced
    got = _run(spark, {"s": [100.0, None, 400.0]})
    assert got["s"] == [100.0, 250.0, 400.0]


def test_differential_against_pandas(spark):
    rnd = random.Random(42)
    series = {}
    for i in range(60):
        n = rnd.randint(1, 30)
        vals = [None if rnd.random() < 0.4 else round(rnd.uniform(1e3, 1e6), 2)
                for _ in range(n)]
        series[f"s{i}"] = vals
    got = _run(spark, series)
    for k, vals in series.items():
        exp = _pandas(vals)
        for a, b in zip(got[k], exp):
            if b is None:
                assert a is None
            else:
                assert a == pytest.approx(b, rel=1e-12, abs=1e-9)


def test_wide_matches_pandas_and_long(spark):
    from casaflow.operators.gapfill import interpolate_wide
    rnd = random.Random(3)
    k = 12
    rows = []
    for i in range(80):
        vals = [None if rnd.random() < 0.45 else round(rnd.uniform(1e3, 1e6), 2) for _ in range(k)]
        rows.append((f"s{i}", *vals))
    cols = [f"m{j}" for j in range(k)]
    df = spark.createDataFrame(rows, "sid string, " + ", ".join(f"{c} double" for c in cols))
    got = {r.sid: [r[c] for c in cols] for r in interpolate_wide(df, cols).collect()}
    long = _run(spark, {r[0]: list(r[1:]) for r in rows})
    for r in rows:
        exp = _pandas(list(r[1:]))
        assert got[r[0]] == [None if e is None else e for e in exp] or all(
            (a is None and b is None) or (a is not None and b is not None and abs(a - b) < 1e-9)
            for a, b in zip(got[r[0]], exp))
        assert got[r[0]] == long[r[0]]
