import datetime as dt

import pytest
from pyspark.sql import functions as F

from casaflow.functions import (header_date, investment_metrics, parse_date_multi,
                                replace_values, snake_case, tier_from_path, trim_all)


@pytest.mark.parametrize("name,expected", [
    ("RegionID", "region_id"), ("SizeRank", "size_rank"), ("RegionName", "region_name"),
    ("StateName", "state_name"), ("CountyName", "county_name"), ("State", "state"),
    ("Metro", "metro"), ("HTTPServer", "http_server"), ("already_snake", "already_snake"),
    ("aBcDe", "a_bc_de"), ("Area51B", "area51_b"), ("2012-01-31", "2012-01-31"),
    ("XAbCd", "x_ab_cd"), ("aAAb", "a_a_ab"), ("home_tier", "home_tier"),
])
def test_snake_case(name, expected):
    assert snake_case(name) == expected


def test_header_date():
    assert header_date("1/31/2012") == dt.date(2012, 1, 31)
    assert header_date("01/31/2012") == dt.date(2012, 1, 31)
    assert header_date("2012-01-31") == dt.date(2012, 1, 31)
    assert header_date("2012-02-30") is None
    assert header_date("RegionName") is None
    assert header_date("31/1/2012") is None


def test_parse_date_multi(spark):
    df = spark.createDataFrame([("1/31/2012",), ("2012-02-29",), ("garbage",), (None,),
                                ("13/1/2012",)], "s string")
    got = [r[0] for r in df.select(parse_date_multi("s")).collect()]
    assert got == [dt.date(2012, 1, 31), dt.date(2012, 2, 29), None, None, None]


def test_trim_all_matches_python_strip(spark):
    vals = ["  a  ", "\tb\t", " c ", "", None, "d", " 　e f  ",
            "\x1cg\x1f", "\n h \r\n", "   "]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(trim_all("s")).collect()]
    assert got == [None if v is None else v.strip() for v in vals]


def test_tier_from_path(spark):
    names = ["x_tier_0.0_0.33_sm.csv", "x_tier_0.33_0.67_sm.csv", "x_tier_0.67_1.0_sm.csv",
             "Zip_zori.csv", "/dir/0.33_0.67/tier_0.0_0.33.csv"]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    got = [r[0] for r in df.select(tier_from_path("f")).collect()]
    assert got == ["bottom", "medium", "top", "unknown", "bottom"]


def test_replace_values(spark):
    df = spark.createDataFrame([("Seattle, WA",), ("Tacoma, WA",), (None,)], "m string")
    got = [r[0] for r in df.select(replace_values("m", {"Seattle, WA": "Seattle-Tacoma-Bellevue, WA"})).collect()]
    assert got == ["Seattle-Tacoma-Bellevue, WA", "Tacoma, WA", None]


def test_investment_metrics_null_and_zero(spark):
    df = spark.createDataFrame([(300000.0, 2000.0, 1500.0), (0.0, 2000.0, None),
                                (300000.0, 0.0, 100.0), (None, None, None)],
                               "avg_house_value double, rental_income double, monthly_payment double")
    rows = investment_metrics(df).collect()
    assert rows[0].gross_yield == pytest.approx(0.08)
    assert rows[0].cash_flow == 500.0
    assert rows[0].price_to_rent_ratio == pytest.approx(12.5)
    assert rows[1].gross_yield is None and rows[1].cash_flow is None
    assert rows[2].price_to_rent_ratio is None and rows[2].gross_yield == 0.0
    assert rows[3].gross_yield is None and rows[3].cash_flow is None


def test_sizing():
    from casaflow.session import MB, sizing
    tb100 = 100 * (1 << 40)
    big = sizing(tb100, 8000)
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 256 * MB
    assert int(big["spark.sql.shuffle.partitions"]) == -(-tb100 // (200 * MB))
    mid = sizing(1 << 40, 8000)
    assert int(mid["spark.sql.shuffle.partitions"]) == 24000  # floor of 3 waves
    small = sizing(10 * MB, 8)
    assert int(small["spark.sql.files.maxPartitionBytes"]) == 32 * MB
    assert int(small["spark.sql.shuffle.partitions"]) == 24


def test_checkpoint_root_uses_the_configured_folder(spark):
    from casaflow.session import checkpoint_root, scratch_path
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    root = checkpoint_root(spark)
    assert configured and root.rstrip("/").endswith(configured.rstrip("/").split(":")[-1])
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root.rstrip("/"))


def test_apply_sizing_reads_metadata_only(spark, tmp_dir):
    import os
    from casaflow.session import MB, apply_sizing, input_size
    with open(os.path.join(tmp_dir, "a.csv"), "w") as f:
        f.write("x" * 1000)
    assert input_size(spark, tmp_dir) == 1000
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        conf = apply_sizing(spark, tmp_dir)
        assert int(conf["spark.sql.files.maxPartitionBytes"]) == 32 * MB
        assert spark.conf.get("spark.sql.shuffle.partitions") == conf["spark.sql.shuffle.partitions"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
