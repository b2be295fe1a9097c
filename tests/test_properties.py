"""Property tests (hypothesis): reshaping round trips, idempotent upserts,
null propagation of the metrics."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casaflow.functions import investment_metrics
from casaflow.operators.merge import keyed_merge
from casaflow.operators.reshape import to_wide, unpivot_wide

MONTHS = [dt.date(2020, m, 28) for m in range(1, 7)]
SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

cells = st.dictionaries(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.sampled_from(range(len(MONTHS)))),
    st.floats(min_value=1, max_value=1e6, allow_nan=False), min_size=1, max_size=18)


@SETTINGS
@given(cells)
def test_pivot_then_unpivot_is_identity_on_values(spark, data):
    rows = [(s, MONTHS[m], v) for (s, m), v in data.items()]
    long = spark.createDataFrame(rows, "sid string, metric_date date, v double")
    wide = to_wide(long, ["sid"], "metric_date", MONTHS, "v")
    back = unpivot_wide(wide, ["sid"], [(str(m), m, i) for i, m in enumerate(MONTHS)], "v")
    got = {(r.sid, r.metric_date, r.v) for r in back.where(F.col("v").isNotNull()).collect()}
    assert got == set(rows)
    assert back.count() == len({s for s, _ in data}) * len(MONTHS)


@SETTINGS
@given(st.dictionaries(st.integers(0, 20), st.floats(0, 100, allow_nan=False), max_size=12),
       st.dictionaries(st.integers(0, 20), st.floats(0, 100, allow_nan=False), max_size=12))
def test_upsert_twice_changes_only_timestamps(spark, old, new):
    t0 = dt.datetime(2020, 1, 1)
    e = spark.createDataFrame([(k, v, t0, t0) for k, v in old.items()],
                              "k int, v double, ins timestamp, upd timestamp")
    i = spark.createDataFrame(list(new.items()), "k int, v double")
    rules = {"v": "set", "ins": "stamp", "upd": "touch"}
    once = keyed_merge(e, i, ["k"], rules)
    twice = keyed_merge(once, i, ["k"], rules)
    a = {r.k: r.v for r in once.collect()}
    b = {r.k: r.v for r in twice.collect()}
    assert a == b == {**old, **new}
    ins_once = {r.k: r.ins for r in once.collect()}
    ins_twice = {r.k: r.ins for r in twice.collect()}
    assert {k: ins_once[k] for k in old} == {k: t0 for k in old}
    assert set(ins_twice) == set(ins_once)


@SETTINGS
@given(st.lists(st.tuples(*[st.one_of(st.none(), st.floats(0, 1e6, allow_nan=False))] * 3),
                min_size=1, max_size=10))
def test_cash_flow_null_iff_input_null(spark, rows):
    df = spark.createDataFrame(rows, "avg_house_value double, rental_income double, "
                                     "monthly_payment double")
    for r in investment_metrics(df).collect():
        assert (r.cash_flow is None) == (r.rental_income is None or r.monthly_payment is None)
        if r.avg_house_value in (None, 0.0) or r.rental_income is None:
            assert r.gross_yield is None
