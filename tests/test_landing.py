import datetime as dt
import os

from pyspark.sql import functions as F

from casaflow.plans.landing import land, long_cells, reject_report
from casaflow.schemas import HOUSE_VALUE, RENTAL_INCOME
from casaflow.sources.wide_csv import list_files, read_header, scan_wide

HV_HDR = "RegionID,SizeRank,RegionName,RegionType,StateName,State,Metro,CountyName"


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def _hv_files(d):
    # bottom tier: months Dec 2011 (cut-off day itself), Jan, Feb 2012
    _write(os.path.join(d, "raw_City_zhvi_uc_sfrcondo_tier_0.0_0.33_sm_sa_month.csv"),
           f"{HV_HDR},2011-12-31,2012-01-31,2012-02-29\n"
           "1,1,Seattle,city,Washington,WA,\"Seattle, WA\",King County,100.5,101,\n"
           "2,2,Tacoma,city,Washington,WA,\"Tacoma, WA\",Pierce County,,200,201.25\n")
    # top tier: headers shifted by one month and in the other spelling
    _write(os.path.join(d, "raw_City_zhvi_uc_sfrcondo_tier_0.67_1.0_sm_sa_month.csv"),
           f"{HV_HDR},1/31/2012,2/29/2012,3/31/2012,notadate\n"
           "1,1,Seattle,city,Washington,WA,\"Seattle, WA\",King County,300,oops,302,9\n")


def test_header_groups_keep_their_dates(spark, tmp_dir):
    _hv_files(tmp_dir)
    files = list_files(spark, os.path.join(tmp_dir, "*zhvi*.csv"))
    assert len(files) == 2
    assert read_header(spark, files[0])[:2] == ["RegionID", "SizeRank"]
    groups = scan_wide(spark, os.path.join(tmp_dir, "*zhvi*.csv"),
                       id_cols=list(HOUSE_VALUE.id_cols))
    assert len(groups) == 2
    out = land(spark, HOUSE_VALUE, os.path.join(tmp_dir, "*zhvi*.csv"))
    assert out.columns == ["region_id", "size_rank", "region_name", "region_type", "state_name",
                           "state", "metro", "county_name", "home_tier", "metric_date",
                           "house_value", "year", "inserted_at"]
    rows = {(r.region_id, r.home_tier, r.metric_date): r.house_value for r in out.collect()}
    assert rows == {
        (1, "bottom", dt.date(2012, 1, 31)): 101.0,
        (2, "bottom", dt.date(2012, 1, 31)): 200.0,
        (2, "bottom", dt.date(2012, 2, 29)): 201.25,
        (1, "top", dt.date(2012, 1, 31)): 300.0,
        (1, "top", dt.date(2012, 3, 31)): 302.0,
    }


def test_rejects_and_unparseable_headers(spark, tmp_dir):
    _hv_files(tmp_dir)
    groups = scan_wide(spark, os.path.join(tmp_dir, "*zhvi*.csv"),
                       id_cols=list(HOUSE_VALUE.id_cols))
    rep = {os.path.basename(r.source_file): r for r in
           reject_report(long_cells(groups)).collect()}
    top = rep["raw_City_zhvi_uc_sfrcondo_tier_0.67_1.0_sm_sa_month.csv"]
    assert (top.n_cells, top.n_filled, top.n_bad_value, top.n_bad_date) == (4, 4, 1, 1)
    bottom = rep["raw_City_zhvi_uc_sfrcondo_tier_0.0_0.33_sm_sa_month.csv"]
    assert (bottom.n_cells, bottom.n_filled, bottom.n_bad_value) == (6, 4, 0)


def test_zip_codes_keep_zeros_and_empty_columns(spark, tmp_dir):
    hdr = "RegionID,SizeRank,RegionName,RegionType,StateName,State,City,Metro,CountyName"
    _write(os.path.join(tmp_dir, "raw_Zip_zori_uc_sfrcondomfr_sm_sa_month.csv"),
           f"{hdr},2015-01-31,2015-02-28,2015-03-31\n"
           "10,1,01001,zip,MA,MA,Agawam,\"Springfield, MA\",Hampden County,1200,,1210.5\n"
           "11,2,98101,zip,WA,WA,Seattle,\"Seattle, WA\",King County,2000,,2100\n")
    out = land(spark, RENTAL_INCOME, os.path.join(tmp_dir, "*zori*.csv"))
    rows = out.collect()
    assert {r.region_name for r in rows} == {"01001", "98101"}
    assert len(rows) == 4  # the all-empty February column drops out
    assert dict(out.dtypes)["rental_income"] == "double"
    assert dict(out.dtypes)["region_id"] == "int"
