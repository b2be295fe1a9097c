import datetime as dt

import pytest
from pyspark.sql import functions as F

from casaflow.operators.geo import distinct_on
from casaflow.operators.merge import (ConstraintViolation, assert_no_orphans, assert_unique,
                                      duplicate_keys, keyed_merge, orphan_keys)
from casaflow.plans.final import upsert_dim_rows, upsert_fact
from casaflow.schemas import DIM_GEOGRAPHY, FACT_SCHEMAS, empty

GEO = "metro string, state string, county_name string"


def _dim_first(spark, rows):
    df = spark.createDataFrame(rows, GEO)
    out = distinct_on(df, "metro", [("county_name", True), ("state", True)],
                      ["state", "county_name"])
    return {r.metro: (r.state, r.county_name) for r in out.collect()}


def test_distinct_on_cases(spark):
    got = _dim_first(spark, [
        ("A", "WA", None),                                    # null county only
        ("B", "WA", None), ("B", "OR", "King"),               # null and non-null
        ("C", "WA", "Pierce"), ("C", "OR", "Pierce"),         # equal county, other state
        ("D", None, "X"), ("D", "WA", "X"),                   # null state last
        ("E", "WA", "Zed"), ("E", "WA", "Zed"),               # duplicates
    ])
    assert got == {"A": ("WA", None), "B": ("OR", "King"), "C": ("OR", "Pierce"),
                   "D": ("WA", "X"), "E": ("WA", "Zed")}


def test_dim_upsert_rules(spark):
    t0 = dt.datetime(2020, 1, 1)
    existing = spark.createDataFrame(
        [(1, "M1", "WA", "King", t0, t0), (2, "M2", "WA", "Pierce", t0, t0),
         (3, "M3", "OR", "Lane", t0, t0)], DIM_GEOGRAPHY)
    incoming = spark.createDataFrame(
        [("M1", "WA", None),        # null county: existing kept
         ("M2", None, "Thurston"),  # null state: overwrites
         ("M4", "ID", "Ada")], GEO)  # new metro
    out = {r.metro: r for r in upsert_dim_rows(existing, incoming, with_action=True).collect()}
    assert out["M1"].county_name == "King" and out["M1"].state == "WA"
    assert out["M2"].state is None and out["M2"].county_name == "Thurston"
    assert out["M3"].merge_action == "unchanged" and out["M3"].updated_at == t0
    assert out["M4"].merge_action == "insert" and out["M4"].geo_key is not None
    assert [out[m].geo_key for m in ("M1", "M2", "M3")] == [1, 2, 3]
    assert out["M1"].inserted_at == t0 and out["M1"].updated_at > t0


def test_dim_upsert_repeat_is_stable(spark):
    inc = spark.createDataFrame([("M1", "WA", "King"), ("M2", "OR", None)], GEO)
    first = upsert_dim_rows(empty(spark, DIM_GEOGRAPHY), inc)
    keys1 = {r.metro: r.geo_key for r in first.collect()}
    stored = spark.createDataFrame(first.select(*DIM_GEOGRAPHY.fieldNames()).collect(),
                                   DIM_GEOGRAPHY)
    second = upsert_dim_rows(stored, inc)
    keys2 = {r.metro: r.geo_key for r in second.collect()}
    assert keys1 == keys2


def test_fact_upsert(spark):
    t0 = dt.datetime(2020, 1, 1)
    d1, d2, d3 = dt.date(2020, 1, 31), dt.date(2020, 2, 29), dt.date(2020, 3, 31)
    existing = spark.createDataFrame(
        [(1, 10.0, d1, 2020, t0, t0), (1, 20.0, d2, 2020, t0, t0)],
        FACT_SCHEMAS["house_value"])
    batch = spark.createDataFrame([(1, 25.0, d2, 2020), (1, 30.0, d3, 2020)],
                                  "geo_key long, avg_house_value double, metric_date date, year int")
    out = {r.metric_date: r for r in
           upsert_fact(existing, batch, "house_value", with_action=True).collect()}
    assert out[d1].avg_house_value == 10.0 and out[d1].merge_action == "unchanged"
    assert out[d2].avg_house_value == 25.0 and out[d2].inserted_at == t0
    assert out[d2].updated_at > t0
    assert out[d3].merge_action == "insert" and out[d3].inserted_at > t0


def test_duplicate_batch_fails(spark):
    batch = spark.createDataFrame([(1, 1.0, dt.date(2020, 1, 31)), (1, 2.0, dt.date(2020, 1, 31))],
                                  "geo_key long, v double, metric_date date")
    assert duplicate_keys(batch, ["geo_key", "metric_date"]).count() == 1
    with pytest.raises(ConstraintViolation):
        assert_unique(batch, ["geo_key", "metric_date"])


def test_orphans(spark):
    dim = spark.createDataFrame([(1,), (2,)], "geo_key long")
    fact = spark.createDataFrame([(1,), (3,), (None,)], "geo_key long")
    assert [r.geo_key for r in orphan_keys(fact, dim, "geo_key").collect()] == [3]
    with pytest.raises(ConstraintViolation):
        assert_no_orphans(fact, dim, "geo_key")


def test_merge_null_keys_never_match(spark):
    e = spark.createDataFrame([(None, 1.0)], "k string, v double")
    i = spark.createDataFrame([(None, 2.0)], "k string, v double")
    out = keyed_merge(e, i, ["k"], {"v": "set"}).collect()
    assert sorted(r.v for r in out) == [1.0, 2.0]


def test_merge_null_keys_rules_apply(spark):
    t0 = dt.datetime(2020, 1, 1)
    e = spark.createDataFrame([(None, 1.0, t0), ("a", 2.0, t0)], "k string, v double, ts timestamp")
    i = spark.createDataFrame([(None, 5.0), ("a", 6.0), ("b", 7.0)], "k string, v double")
    out = keyed_merge(e, i, ["k"], {"v": "set", "ts": "stamp"}, with_action=True).collect()
    got = sorted(((r.k or ""), r.v, r.merge_action, r.ts == t0) for r in out)
    assert got == [("", 1.0, "unchanged", True), ("", 5.0, "insert", False),
                   ("a", 6.0, "update", True), ("b", 7.0, "insert", False)]


def test_distinct_on_collation(spark):
    df = spark.createDataFrame([("M", "WA", "b"), ("M", "OR", "B"), ("M", "ID", "a")], GEO)
    order = [("county_name", True), ("state", True)]
    binary = distinct_on(df, "metro", order, ["state", "county_name"]).first()
    assert binary.county_name == "B"          # 'B' < 'a' < 'b' in binary order
    uni = distinct_on(df, "metro", order, ["state", "county_name"], "UNICODE").first()
    assert uni.county_name == "a"             # 'a' < 'b' < 'B' in UNICODE order
