import os

import pytest
from pyspark.sql import functions as F

from casaflow.plans.orchestrate import PipelineConfig, run
from casaflow.sinks.publish import Publication, current_version, publish, read_current
from tests.test_landing import HV_HDR, _write


def test_failure_leaves_old_version_visible(spark, tmp_dir):
    root = os.path.join(tmp_dir, "store")
    v1 = publish(spark, root, {"a": spark.range(3), "b": spark.range(2)})
    pub = Publication(spark, root)
    pub.write("a", spark.range(10))
    pub.write("b", spark.range(20))
    bad = spark.range(5).withColumn("x", F.raise_error(F.lit("boom")))
    with pytest.raises(Exception):
        pub.write("c", bad)
    # no commit happened: readers still see v1
    assert current_version(spark, root) == v1
    cur = read_current(spark, root, ["a", "b"])
    assert cur["a"].count() == 3 and cur["b"].count() == 2
    v2 = publish(spark, root, {"a": spark.range(4)})
    assert current_version(spark, root) == v2 > v1


def _raw_files(d):
    _write(os.path.join(d, "raw_City_zhvi_uc_sfrcondo_tier_0.0_0.33_sm_sa_month.csv"),
           f"{HV_HDR},2011-12-31,2012-01-31,2012-02-29\n"
           "1,1,Seattle,city,Washington,WA,\"Seattle, WA\",King County,100,110,120\n"
           "2,2,Tacoma,city,Washington,WA,\"Tacoma, WA\",Pierce County,,200,\n")
    _write(os.path.join(d, "raw_City_zhvi_uc_sfrcondo_tier_0.67_1.0_sm_sa_month.csv"),
           f"{HV_HDR},2012-01-31,2012-02-29\n"
           "1,1,Seattle,city,Washington,WA,\"Seattle, WA\",King County,300,320\n")
    _write(os.path.join(d, "raw_Metro_total_monthly_payment_downpayment_0.20_uc_sfrcondo_tier_0.33_0.67_sm_sa_month.csv"),
           "RegionID,SizeRank,RegionName,RegionType,StateName,2012-01-31,2012-02-29\n"
           "100,1,\"Seattle, WA\",msa,WA,1500,1510\n"
           "101,2,\"Tacoma, WA\",msa,WA,1200,\n")
    _write(os.path.join(d, "raw_Zip_zori_uc_sfrcondomfr_sm_sa_month.csv"),
           "RegionID,SizeRank,RegionName,RegionType,StateName,State,City,Metro,CountyName,"
           "2012-01-31,2012-02-29\n"
           "7,1,98101,zip,WA,WA,Seattle,\"Seattle-Tacoma-Bellevue, WA\",King County,1800,1900\n"
           "8,2,98402,zip,WA,WA,Tacoma,\"Tacoma, WA\",Pierce County,1300,1350\n")
    # the other configured inputs of the cleaning job: headers without rows
    from casaflow.schemas import CLEANING_FILES
    for n_ids, name, _ in CLEANING_FILES:
        if not os.path.exists(os.path.join(d, name)):
            _write(os.path.join(d, name), "RegionID,SizeRank,RegionName,RegionType,StateName,State,Metro,"
                   "CountyName,2012-01-31,2012-02-29\n")


def test_end_to_end_pipeline(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    _raw_files(raw)
    store = os.path.join(tmp_dir, "store")
    cfg = PipelineConfig(raw, store, cleaned_dir=os.path.join(tmp_dir, "cleaned"))
    v1 = run(spark, cfg)
    names = ["dim_geography", "fact_house_value", "fact_monthly_payment", "fact_rental_income",
             "lnd_house_value", "house_value"]
    t = read_current(spark, store, names)
    dim = {r.metro: r for r in t["dim_geography"].collect()}
    # payment's "Seattle, WA" is aliased; house value's raw name is not in the dim
    assert set(dim) == {"Seattle-Tacoma-Bellevue, WA", "Tacoma, WA"}
    hv = t["fact_house_value"].join(t["dim_geography"], "geo_key").collect()
    assert {(r.metro, str(r.metric_date), r.avg_house_value) for r in hv} == {
        ("Tacoma, WA", "2012-01-31", 200.0)}
    mp = t["fact_monthly_payment"].join(t["dim_geography"], "geo_key").collect()
    assert {(r.metro, str(r.metric_date), r.monthly_payment) for r in mp} == {
        ("Seattle-Tacoma-Bellevue, WA", "2012-01-31", 1500.0),
        ("Seattle-Tacoma-Bellevue, WA", "2012-02-29", 1510.0),
        ("Tacoma, WA", "2012-01-31", 1200.0)}
    assert t["lnd_house_value"].count() == 5  # 2011-12-31 cut, empty cells dropped
    assert t["house_value"].where("region_id = 1 AND metric_date = '2012-01-31'") \
        .first().avg_house_value == 205.0  # legacy averages the tiers
    # cleaned copies exist, one per input file
    assert os.path.isdir(os.path.join(tmp_dir, "cleaned"))
    # second run: keys stable, old version kept
    keys1 = {r.metro: r.geo_key for r in t["dim_geography"].collect()}
    v2 = run(spark, cfg)
    assert v2 > v1
    t2 = read_current(spark, store, ["dim_geography", "fact_monthly_payment"])
    assert {r.metro: r.geo_key for r in t2["dim_geography"].collect()} == keys1
    assert t2["fact_monthly_payment"].count() == 3


def test_pipeline_from_cleaned_files_and_dashboard(spark, tmp_dir):
    from casaflow.plans.dashboard import Dashboard
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    _raw_files(raw)
    # an interior gap that only the cleaning step fills
    _write(os.path.join(raw, "raw_Zip_zori_uc_sfrcondomfr_sm_sa_month.csv"),
           "RegionID,SizeRank,RegionName,RegionType,StateName,State,City,Metro,CountyName,"
           "2012-01-31,2012-02-29,2012-03-31\n"
           "7,1,98101,zip,WA,WA,Seattle,\"Seattle-Tacoma-Bellevue, WA\",King County,1800,,2000\n")
    store = os.path.join(tmp_dir, "store")
    cfg = PipelineConfig(raw, store, cleaned_dir=os.path.join(tmp_dir, "cleaned"),
                         source="cleaned", legacy=False)
    run(spark, cfg)
    t = read_current(spark, store, ["dim_geography", "fact_house_value",
                                    "fact_monthly_payment", "fact_rental_income"])
    ri = t["fact_rental_income"].orderBy("metric_date").collect()
    assert [r.rental_income for r in ri] == [1800.0, 1900.0, 2000.0]
    facts = {k: t[f"fact_{k}"] for k in ("house_value", "monthly_payment", "rental_income")}
    dash = Dashboard(t["dim_geography"], facts, state="WA")
    try:
        assert [r.metro for r in dash.metros().collect()] == ["Seattle-Tacoma-Bellevue, WA",
                                                              "Tacoma, WA"]
        feeds = dash.feeds()
        assert set(feeds) == {"house_value", "rental_income", "monthly_payment", "value_vs_rent",
                              "gross_yield", "rent_vs_mortgage", "cash_flow", "raw_combined"}
        cf = {str(r.metric_month): r.cash_flow for r in feeds["cash_flow"].collect()
              if r.metro.startswith("Seattle")}
        assert cf == {"2012-01-01": 300.0, "2012-02-01": 390.0}
        cov = {r.metro: r for r in dash.coverage().collect()}
        assert cov["Tacoma, WA"].has_house_value and not cov["Seattle-Tacoma-Bellevue, WA"].has_house_value
    finally:
        dash.close()


def test_pipeline_lake_and_jdbc_landing(spark, tmp_dir):
    from casaflow.plans.orchestrate import main
    from casaflow.sources.tables import read_jdbc
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    _raw_files(raw)
    url = "jdbc:derby:memory:casaflow_pipe;create=true"
    drv = "org.apache.derby.jdbc.EmbeddedDriver"
    cfg = PipelineConfig(raw, os.path.join(tmp_dir, "store"), lake_root=os.path.join(tmp_dir, "lake"),
                         jdbc={"url": url, "driver": drv, "connections": 2}, legacy=False)
    run(spark, cfg)
    lnd = read_jdbc(spark, url, "landing.lnd_rental_income", driver=drv)
    assert lnd.count() == 4
    lake = spark.read.parquet(os.path.join(tmp_dir, "lake", "house_value"))
    assert {(r.state, r.year) for r in lake.select("state", "year").distinct().collect()} == {("WA", 2012)}
    # the command-line entry point runs the same job
    store2 = os.path.join(tmp_dir, "store2")
    feeds = os.path.join(tmp_dir, "feeds")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        version = main(["--raw", raw, "--store", store2, "--feeds", feeds, "--state", "WA"])
    finally:  # main() sizes the (shared) session; restore it for later tests
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert read_current(spark, store2, ["dim_geography"])["dim_geography"].count() == 2
    base = os.path.join(feeds, f"v={version}")
    assert sorted(os.listdir(base)) == sorted(
        ["house_value", "rental_income", "monthly_payment", "value_vs_rent", "gross_yield",
         "rent_vs_mortgage", "cash_flow", "raw_combined", "metros", "coverage"])
    assert spark.read.parquet(os.path.join(base, "metros")).count() == 2


def test_constraint_violation_aborts_before_publication(spark, tmp_dir):
    from casaflow.operators.merge import ConstraintViolation
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    _raw_files(raw)
    store = os.path.join(tmp_dir, "store")
    cfg = PipelineConfig(raw, store)
    v1 = run(spark, cfg)
    # a second rent file repeats region 7: its legacy key (region_id, month) collides
    _write(os.path.join(raw, "raw_Zip_zori_extra.csv"),
           "RegionID,SizeRank,RegionName,RegionType,StateName,State,City,Metro,CountyName,"
           "2012-01-31\n7,1,98101,zip,WA,WA,Seattle,\"Seattle-Tacoma-Bellevue, WA\",King,1850\n")
    with pytest.raises(ConstraintViolation):
        run(spark, cfg)
    from casaflow.sinks.publish import current_version
    assert current_version(spark, store) == v1


def test_alias_house_value_switch(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    _raw_files(raw)
    for flag, expected in ((False, {"Tacoma, WA"}),
                           (True, {"Tacoma, WA", "Seattle-Tacoma-Bellevue, WA"})):
        store = os.path.join(tmp_dir, f"store_{flag}")
        run(spark, PipelineConfig(raw, store, alias_house_value=flag, legacy=False))
        t = read_current(spark, store, ["dim_geography", "fact_house_value"])
        metros = {r.metro for r in t["fact_house_value"].join(t["dim_geography"], "geo_key")
                  .select("metro").collect()}
        assert metros == expected
