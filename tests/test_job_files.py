"""Files in and out of the job: header discovery, rejects, atomic cleaning,
partitioned publication, merges by year, retention, restart, stored panels."""

import datetime as dt
import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from casaflow.operators.merge import ConstraintViolation
from casaflow.plans import landing as L
from casaflow.plans import orchestrate as O
from casaflow.plans.cleaning import clean_files
from casaflow.plans.dashboard import stored_panel
from casaflow.plans.final import FACT_KEYS, publish_by_year, upsert_fact
from casaflow.plans.landing import land, write_landing
from casaflow.schemas import FACT_SCHEMAS, HOUSE_VALUE, RENTAL_INCOME
from casaflow.sinks import publish as PB
from casaflow.sinks.publish import Publication, manifest, publish, read_current, read_entry, retire, unfinished, versions
from casaflow.sources.wide_csv import header_groups, scan_wide
from tests.test_landing import HV_HDR, _hv_files, _write
from tests.test_publish_pipeline import _raw_files


# --- header discovery ----------------------------------------------------------

def _py4j_calls(spark, fn):
    client = spark.sparkContext._gateway._gateway_client
    real, n = client.send_command, [0]

    def counted(*a, **k):
        n[0] += 1
        return real(*a, **k)
    client.send_command = counted
    try:
        return fn(), n[0]
    finally:
        client.send_command = real


def test_headers_of_thousands_of_files_need_no_call_for_each(spark, tmp_dir):
    for i in range(2000):
        months = ",".join(f"2012-{m:02d}-28" for m in range(1, 4 + i % 3))
        _write(os.path.join(tmp_dir, f"raw zhvi, {i}'s %.csv"), f"{HV_HDR},{months}\n{i},1,a,city,W,WA,M,C{',1' * (3 + i % 3)}\n")
    _write(os.path.join(tmp_dir, "empty zhvi.csv"), "")
    pattern = os.path.join(tmp_dir, "*zhvi*.csv")
    groups, calls = _py4j_calls(spark, lambda: header_groups(spark, pattern))
    few = os.path.join(tmp_dir, "raw zhvi, 1?'s*.csv")
    _, calls_of_few = _py4j_calls(spark, lambda: header_groups(spark, few))
    assert sorted((len(h) - 8, len(f)) for h, f in groups.items()) == [(3, 667), (4, 667), (5, 666)]
    assert calls < calls_of_few + 50
    assert header_groups(spark, os.path.join(tmp_dir, "nothing*.csv")) == {}
    scanned = scan_wide(spark, few, id_cols=list(HOUSE_VALUE.id_cols))
    assert sorted((len(g.measure_cols), g.df.count()) for g in scanned) == [(3, 3), (4, 4), (5, 3)]
    assert sorted(r[0] for g in scanned for r in g.df.select("RegionID").collect()) == sorted(str(i) for i in range(10, 20))


def test_a_group_opens_its_own_files_only(spark, tmp_dir):
    _hv_files(tmp_dir)
    for g in scan_wide(spark, os.path.join(tmp_dir, "*zhvi*.csv"), id_cols=list(HOUSE_VALUE.id_cols)):
        assert len(g.files) == 1
        assert {r[0] for r in g.df.select("source_file").distinct().collect()} == set(g.files)
        plan = g.df.select("RegionID")._jdf.queryExecution().executedPlan().toString()
        assert "file_path" in plan and os.path.basename(g.files[0]) in plan
    # a byte-order mark, doubled quotes and a long header are read whole
    long = ",".join(f"{2000 + i // 12}-{i % 12 + 1:02d}-28" for i in range(300))
    _write(os.path.join(tmp_dir, "x.csv"), f"﻿RegionID,\"Name, \"\"X\"\"\",{long}\n1,a{',1' * 300}\n")
    (header,) = header_groups(spark, os.path.join(tmp_dir, "x.csv"))
    assert header[:2] == ("RegionID", 'Name, "X"') and len(header) == 302


# --- rejects ---------------------------------------------------------------------

def _report(df):
    return {os.path.basename(r.source_file): tuple(r)[2:] for r in df.collect()}


def test_landing_writes_rejects_and_a_report_in_one_pass(spark, tmp_dir, monkeypatch):
    _hv_files(tmp_dir)
    _write(os.path.join(tmp_dir, "raw_zhvi_ids.csv"), f"{HV_HDR},2012-01-31,Note\n x1 ,?,A,city,Washington,WA,M,C,5,6\nNA,3,B,city,,,M,C,$7,\n")
    pattern = os.path.join(tmp_dir, "*zhvi*.csv")
    pub = Publication(spark, os.path.join(tmp_dir, "store"))
    landed = write_landing(spark, pub, HOUSE_VALUE, pattern)
    plain = land(spark, HOUSE_VALUE, pattern)
    assert landed.columns == plain.columns and landed.dtypes == plain.dtypes
    key = lambda df: sorted(map(str, df.drop("inserted_at").collect()))     # noqa: E731
    assert key(landed) == key(plain) and landed.where("inserted_at is null").count() == 0
    rejects = {(r.region_id, r.region_name, r.date_str, r.raw, r.reason) for r in pub.read("rejects_house_value").collect()}
    assert rejects == {(1, "Seattle", "2/29/2012", "oops", "bad_value"), (None, "B", "2012-01-31", "$7", "bad_value")}
    # n_rows, n_cells, n_landed, n_bad_value, n_bad_date, n_bad_id
    assert _report(pub.read("files_house_value")) == {
        "raw_City_zhvi_uc_sfrcondo_tier_0.0_0.33_sm_sa_month.csv": (2, 6, 3, 0, 0, 0),
        "raw_City_zhvi_uc_sfrcondo_tier_0.67_1.0_sm_sa_month.csv": (1, 4, 2, 1, 1, 0),
        "raw_zhvi_ids.csv": (2, 4, 1, 1, 2, 3)}
    # the ledger has it: nothing is scanned again
    monkeypatch.setattr(L, "landing_log", None)
    assert write_landing(spark, pub, HOUSE_VALUE, pattern).count() == landed.count()


def test_cells_without_a_date_are_reported_and_land_without_a_cut_off(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "a_zori.csv"), "RegionID,SizeRank,RegionName,RegionType,StateName,State,City,Metro,CountyName,2015-01-31,Note\n"
           "1,1,00501,zip,NY,NY,H,M,C,10,20\n2,2,00502,zip,,,H,M,C,,x\n")
    pub = Publication(spark, os.path.join(tmp_dir, "store"))
    landed = write_landing(spark, pub, RENTAL_INCOME, os.path.join(tmp_dir, "*zori*.csv"))
    assert sorted((r.region_id, str(r.metric_date), r.rental_income, r.year) for r in landed.collect()) == [(1, "2015-01-31", 10.0, 2015), (1, "None", 20.0, None)]
    assert sorted((r.region_name, r.raw, r.reason) for r in pub.read("rejects_rental_income").collect()) == [
        ("00501", "20", "bad_date"), ("00502", "x", "bad_value")]
    assert _report(pub.read("files_rental_income")) == {"a_zori.csv": (2, 4, 2, 1, 2, 0)}


def test_a_family_without_values_lands_empty(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "a_zhvi.csv"), f"{HV_HDR},2010-01-31\n1,1,A,city,W,WA,M,C,5\n")
    pub = Publication(spark, os.path.join(tmp_dir, "store"))
    assert write_landing(spark, pub, HOUSE_VALUE, os.path.join(tmp_dir, "*zhvi*.csv")).count() == 0
    assert pub.read("rejects_house_value").count() == 0
    assert _report(pub.read("files_house_value")) == {"a_zhvi.csv": (1, 1, 0, 0, 0, 0)}


# --- cleaning --------------------------------------------------------------------

def test_cleaning_counts_and_leaves_the_former_output_when_it_fails(spark, tmp_dir, monkeypatch):
    from casaflow.plans import cleaning as C
    two = os.path.join(tmp_dir, "in.csv")
    os.makedirs(two)
    _write(os.path.join(two, "part-1.csv"), f"{HV_HDR},2012-01-31,2012-02-29,2012-03-31\n1,1,A,city,W,WA,M,C,1,,3\n")
    _write(os.path.join(two, "part-2.csv"), f"{HV_HDR},2012-01-31,Note\nx,1,B,city,W,WA,M,C,oops,2\n")
    _write(os.path.join(tmp_dir, "other.csv"), f"{HV_HDR},2012-01-31\n3,1,D,city,W,WA,M,C,9\n")
    files = [(8, "in.csv", "out.csv"), (8, "other.csv", "out2.csv")]
    out = os.path.join(tmp_dir, "cleaned")
    assert clean_files(spark, tmp_dir, out, files) == [("in.csv", "out.csv", 2, 5, 1, 1, 1), ("other.csv", "out2.csv", 1, 1, 0, 0, 0)]

    def names():
        return sorted(r[0] for n in ("out.csv", "out2.csv") for r in
                      spark.read.option("header", True).csv(sorted(glob.glob(f"{out}/{n}/*.csv"))).select("RegionName").collect())
    assert names() == ["A", "B", "D"] and sorted(os.listdir(out)) == ["out.csv", "out2.csv"]
    _write(os.path.join(two, "part-1.csv"), f"{HV_HDR},2012-01-31,2012-02-29,2012-03-31\n1,1,NEW,city,W,WA,M,C,1,,3\n")
    real = C.clean_wide
    seen = []

    def failing(g, **k):
        seen.append(g)
        if len(seen) == 2:      # between the groups of the first input
            raise RuntimeError("lost")
        return real(g, **k)
    monkeypatch.setattr(C, "clean_wide", failing)
    with pytest.raises(RuntimeError):
        clean_files(spark, tmp_dir, out, files)
    assert names() == ["A", "B", "D"] and sorted(os.listdir(out)) == ["out.csv", "out2.csv"]
    monkeypatch.setattr(C, "clean_wide", real)
    clean_files(spark, tmp_dir, out, files)
    assert names() == ["B", "D", "NEW"]


def test_moves_are_taken_back(spark, tmp_dir):
    from casaflow.sinks.writers import replace_folders
    for path, text in (("t/a/f", "old a"), ("t/b/f", "old b"), ("s/a/f", "new a")):
        os.makedirs(os.path.dirname(os.path.join(tmp_dir, path)))
        _write(os.path.join(tmp_dir, path), text)
    with pytest.raises(Exception):
        replace_folders(spark, os.path.join(tmp_dir, "s"), os.path.join(tmp_dir, "t"), ["a", "b"])      # no s/b
    read = lambda p: open(os.path.join(tmp_dir, p)).read()      # noqa: E731
    assert (read("t/a/f"), read("t/b/f"), read("s/a/f")) == ("old a", "old b", "new a")


# --- published tables --------------------------------------------------------------

def test_published_landing_prunes_partitions(spark, tmp_dir):
    rows = [(1, 1, str(s), "city", s, s, "M", "C", "top", dt.date(y, 1, 31), float(y), y, None) for s in ("WA", "01", None) for y in (2012, 2013)]
    df = spark.createDataFrame(rows, L.landing_schema(HOUSE_VALUE))
    store = os.path.join(tmp_dir, "store")
    publish(spark, store, {"lnd_house_value": df}, partition_cols={"lnd_house_value": ("state", "year")})
    t = read_current(spark, store, ["lnd_house_value"])["lnd_house_value"]
    assert t.dtypes == df.dtypes and sorted(map(str, t.collect())) == sorted(map(str, df.collect()))
    one = t.where("state = '01' and year = 2013")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*state[^\]]*year", plan), plan
    assert [r.house_value for r in one.collect()] == [2013.0]
    assert len(_files_read(one)) == 1


def _files_read(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def _load(spark, store, version, batch, now=None):
    old = manifest(spark, store, versions(spark, store)[-1]) if versions(spark, store) else {}
    pub = Publication(spark, store, version)
    here = publish_by_year(pub, "fact_house_value", batch, old.get("fact_house_value"), FACT_SCHEMAS["house_value"], FACT_KEYS,
                           lambda e, b: upsert_fact(e, b, "house_value", now))
    pub.commit()
    return here


def _batch(spark, rows):
    return spark.createDataFrame([(k, v, dt.date(y, m, 28), y) for k, v, y, m in rows],
                                 "geo_key long, avg_house_value double, metric_date date, year int")


def _values(df):
    return {(r.geo_key, r.metric_date.year, r.metric_date.month): r.avg_house_value for r in df.collect()}


def test_merges_read_and_write_the_years_of_the_batch(spark, tmp_dir, monkeypatch):
    store = os.path.join(tmp_dir, "store")
    first = [(k, float(y), y, m) for k in (1, 2) for y in range(2000, 2010) for m in (1, 2)]
    _load(spark, store, "0001", _batch(spark, first))
    reads = []
    real = upsert_fact

    def spying(e, b, *a):
        reads.append(_files_read(e))
        return real(e, b, *a)
    monkeypatch.setattr("tests.test_job_files.upsert_fact", spying)
    here = _load(spark, store, "0002", _batch(spark, [(1, -1.0, 2004, 1), (3, -3.0, 2004, 5), (1, -2.0, 2012, 1)]))
    assert {re.search(r"year=(\d+)", f).group(1) for f in reads[0]} == {"2004"}
    assert {r.year for r in here.select("year").distinct().collect()} == {2004, 2012}
    assert sorted(os.path.basename(p) for p in glob.glob(f"{store}/v=0002/fact_house_value/year=*")) == ["year=2004", "year=2012"]
    expected = {(k, y, m): v for k, v, y, m in first} | {(1, 2004, 1): -1.0, (3, 2004, 5): -3.0, (1, 2012, 1): -2.0}
    now = read_current(spark, store, ["fact_house_value"])["fact_house_value"]
    assert _values(now) == expected
    assert _values(read_current(spark, store, ["fact_house_value"], "0001")["fact_house_value"]) == {(k, y, m): v for k, v, y, m in first}
    pruned = now.where("year = 2004")._jdf.queryExecution().executedPlan().toString()
    assert pruned.count("PartitionFilters: [isnotnull(year") == 2
    with pytest.raises(ConstraintViolation):
        _load(spark, store, "0003", _batch(spark, [(5, 1.0, 2005, 1), (5, 2.0, 2005, 1)]))
    assert versions(spark, store) == ["0001", "0002"]
    _load(spark, store, "0004", _batch(spark, []))       # an empty batch carries all years over
    assert _values(read_current(spark, store, ["fact_house_value"])["fact_house_value"]) == expected


def test_an_unpartitioned_table_is_partitioned_by_its_next_merge(spark, tmp_dir):
    store = os.path.join(tmp_dir, "store")
    old = _batch(spark, [(1, 1.0, 2000, 1), (1, 2.0, 2001, 1)]).withColumns({c: F.current_timestamp() for c in ("inserted_at", "updated_at")})
    publish(spark, store, {"fact_house_value": old}, "0001")
    _load(spark, store, "0002", _batch(spark, [(1, 5.0, 2001, 1)]))
    assert _values(read_current(spark, store, ["fact_house_value"])["fact_house_value"]) == {(1, 2000, 1): 1.0, (1, 2001, 1): 5.0}
    assert sorted(os.listdir(f"{store}/v=0002/fact_house_value"))[-2:] == ["year=2000", "year=2001"]


def test_retired_versions_leave_what_readers_and_later_versions_need(spark, tmp_dir):
    store = os.path.join(tmp_dir, "store")
    for i, years in enumerate(((2000, 2001), (2001,), (2002,), (2002,)), 1):
        _load(spark, store, f"000{i}", _batch(spark, [(1, float(i), y, 1) for y in years]))
    expected = {(1, 2000, 1): 1.0, (1, 2001, 1): 2.0, (1, 2002, 1): 4.0}
    reader = read_current(spark, store, ["fact_house_value"], "0003")["fact_house_value"]
    Publication(spark, store, "0002x").write("t", spark.range(3))          # a run that failed long ago
    Publication(spark, store, "0009").write("t", spark.range(3))           # a run at work
    assert retire(spark, store, keep=1) == []                              # all were replaced just now
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=30)
    assert retire(spark, store, keep=2, now=later) == ["0001", "0002", "0002x"]
    assert versions(spark, store) == ["0003", "0004"] and unfinished(spark, store) == "0009"
    assert _values(reader) == {(1, 2000, 1): 1.0, (1, 2001, 1): 2.0, (1, 2002, 1): 3.0}
    assert _values(read_current(spark, store, ["fact_house_value"])["fact_house_value"]) == expected
    assert retire(spark, store, keep=1, now=later) == ["0001", "0002", "0003"]
    assert _values(read_current(spark, store, ["fact_house_value"])["fact_house_value"]) == expected
    left = sorted(p[len(store):] for p in glob.glob(f"{store}/v=000?/fact_house_value/year=*"))
    assert left == ["/v=0001/fact_house_value/year=2000", "/v=0002/fact_house_value/year=2001", "/v=0004/fact_house_value/year=2002"]
    assert os.path.isdir(f"{store}/v=0009/t") and not os.path.isdir(f"{store}/v=0002x")


# --- restart, stored panels ----------------------------------------------------------

def test_a_failed_run_goes_on_where_it_stopped(spark, tmp_dir, monkeypatch):
    raw, store = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "store")
    os.makedirs(raw)
    _raw_files(raw)
    cfg = O.PipelineConfig(raw, store, cleaned_dir=os.path.join(tmp_dir, "cleaned"), feeds_dir=os.path.join(tmp_dir, "feeds"))
    real_final, real_log, real_clean = O.publish_final, L.landing_log, O.clean_files

    def killed(*a, **k):
        raise RuntimeError("killed between landing and final")
    monkeypatch.setattr(O, "publish_final", killed)
    with pytest.raises(RuntimeError):
        O.run(spark, cfg)
    assert versions(spark, store) == []
    failed = unfinished(spark, store)
    monkeypatch.setattr(O, "publish_final", real_final)
    monkeypatch.setattr(L, "landing_log", killed)       # neither landed nor cleaned again
    monkeypatch.setattr(O, "clean_files", killed)
    assert O.run(spark, cfg, resume="last") == failed and versions(spark, store) == [failed]
    with pytest.raises(ValueError):
        O.run(spark, cfg, resume=failed)                # published
    t = read_current(spark, store, ["fact_monthly_payment", "lnd_house_value", "files_cleaned"])
    assert (t["fact_monthly_payment"].count(), t["lnd_house_value"].count(), t["files_cleaned"].count()) == (3, 5, 5)
    monkeypatch.setattr(L, "landing_log", real_log)
    monkeypatch.setattr(O, "clean_files", real_clean)
    second = O.run(spark, cfg, resume="last")           # nothing to go on with: a new run
    assert versions(spark, store) == [failed, second]
    # a second export of a version reads the stored panel
    monkeypatch.setattr("casaflow.operators.panel.combined_panel", killed)
    assert stored_panel(spark, store, cfg.state, second).count() == stored_panel(spark, store, cfg.state).count() == 4
    with pytest.raises(RuntimeError):
        stored_panel(spark, store, None, second)        # another state was not stored
    assert glob.glob(f"{tmp_dir}/feeds/v={second}/house_value/*.parquet")


def test_merge_starts_anew_when_another_version_came_between(spark, tmp_dir):
    store = os.path.join(tmp_dir, "store")
    publish(spark, store, {"a": spark.range(1)}, "0001")
    pub = Publication(spark, store, "0003")
    assert not pub.based_on("0001")
    pub.write("fact_x", spark.range(2))
    publish(spark, store, {"a": spark.range(2)}, "0002")
    again = Publication(spark, store, "0003")
    assert again.based_on("0002")
    again.forget(["fact_x", "never"])
    assert again.done("fact_x") is None
    again.write("fact_x", spark.range(5))
    again.commit()
    assert read_current(spark, store, ["fact_x", "a"])["fact_x"].count() == 5
    assert read_entry(spark, store, {**manifest(spark, store, "0003")["fact_x"], "folders": {}}).count() == 0


def test_a_run_retires_old_versions(spark, tmp_dir):
    raw, store = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "store")
    os.makedirs(raw)
    _raw_files(raw)
    cfg = O.PipelineConfig(raw, store, legacy=False, keep_versions=1, grace_hours=0.0)
    first = O.run(spark, cfg)
    stored_panel(spark, store, "WA")
    second = O.run(spark, cfg)
    assert versions(spark, store) == [second] and not os.path.exists(f"{store}/{PB.PANELS}/{first}")
    assert read_current(spark, store, ["fact_monthly_payment"])["fact_monthly_payment"].count() == 3


# --- aliases -------------------------------------------------------------------------

def test_a_hundred_thousand_aliases(spark):
    from casaflow.operators.facts import fact_average
    from casaflow.operators.geo import geo_candidates, with_alias
    aliases = {f"name {i}": f"metro {i % 50}" for i in range(100_000)}
    rows = spark.range(300_000).selectExpr("concat('name ', id % 120000) AS metro", "DATE'2020-01-31' AS metric_date", "cast(id % 7 AS double) AS v")
    dim = spark.range(50).selectExpr("concat('metro ', id) AS metro", "id AS geo_key")
    got = {r.geo_key: r.a for r in fact_average(rows, dim, "v", "a", "metro", aliases).collect()}
    sums = {}
    for i in range(300_000):
        if i % 120_000 < 100_000:
            s = sums.setdefault(i % 120_000 % 50, [0, 0])
            s[0] += i % 7
            s[1] += 1
    assert {k: round(v, 9) for k, v in got.items()} == {k: round(a / n, 9) for k, (a, n) in sums.items()}
    table = spark.createDataFrame([("a", "z"), ("a", "y"), (None, "n"), ("b", None)], "name string, alias string")
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "m string")
    assert [r.o for r in with_alias(df, "m", table, "o").orderBy(F.col("m").asc_nulls_last()).collect()] == ["y", "b", "c", None]
    assert [r.o for r in with_alias(df, "m", {}, "o").orderBy(F.col("m").asc_nulls_last()).collect()] == ["a", "b", "c", None]
    geo = spark.createDataFrame([("name 1", "S", "C", "S"), ("name 51", "S", "C", "S")], "metro string, state string, county_name string, state_name string")
    payments = geo.select(F.col("metro").alias("region_name"), "state_name")
    found = geo_candidates(geo, payments, geo, aliases)
    assert sorted(map(str, found.collect())) == ["Row(metro='metro 1', state='S', county_name='C')", "Row(metro='metro 1', state='S', county_name=None)"]
