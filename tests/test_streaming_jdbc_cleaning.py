import os

import numpy as np
import pandas as pd

from casaflow.plans.cleaning import clean_cells, clean_files, with_row_ids
from casaflow.schemas import HOUSE_VALUE, RENTAL_INCOME
from casaflow.sinks.writers import write_jdbc
from casaflow.sources.tables import read_jdbc
from casaflow.streaming.incremental import (compact, landing_stream, read_upserted,
                                           stream_to_lake, stream_upsert)
from tests.test_landing import HV_HDR, _write

ZORI_HDR = ("RegionID,SizeRank,RegionName,RegionType,StateName,State,City,Metro,CountyName,"
            "2015-01-31,2015-02-28")


def test_stream_to_lake_and_upsert(spark, tmp_dir):
    src = os.path.join(tmp_dir, "incoming")
    os.makedirs(src)
    _write(os.path.join(src, "a_zori.csv"),
           f"{ZORI_HDR}\n1,1,01001,zip,MA,MA,Agawam,\"Springfield, MA\",Hampden,1000,1010\n")
    header = ZORI_HDR.split(",")
    lake = os.path.join(tmp_dir, "lake")
    q = stream_to_lake(landing_stream(spark, RENTAL_INCOME, src, header), lake,
                       os.path.join(tmp_dir, "ck1"))
    q.awaitTermination()
    assert spark.read.parquet(lake).count() == 2

    log = os.path.join(tmp_dir, "log")
    snap = os.path.join(tmp_dir, "snap")
    ck = os.path.join(tmp_dir, "ck2")
    stream_upsert(landing_stream(spark, RENTAL_INCOME, src, header), log, ck).awaitTermination()
    first = {(r.region_id, str(r.metric_date)): r for r in read_upserted(spark, log).collect()}
    assert compact(spark, log, snap) is not None
    # a second file revises February and adds a region
    _write(os.path.join(src, "b_zori.csv"),
           f"{ZORI_HDR}\n1,1,01001,zip,MA,MA,Agawam,\"Springfield, MA\",Hampden,,1020\n"
           "2,2,98101,zip,WA,WA,Seattle,\"Seattle, WA\",King,2000,\n")
    stream_upsert(landing_stream(spark, RENTAL_INCOME, src, header), log, ck).awaitTermination()
    for t in (read_upserted(spark, log), read_upserted(spark, log, snapshot_root=snap)):
        got = {(r.region_id, str(r.metric_date)): r for r in t.collect()}
        assert {k: r.rental_income for k, r in got.items()} == {
            (1, "2015-01-31"): 1000.0, (1, "2015-02-28"): 1020.0, (2, "2015-01-31"): 2000.0}
        # first insertion time is kept for a revised key
        assert got[(1, "2015-02-28")].inserted_at == first[(1, "2015-02-28")].inserted_at


def test_jdbc_round_trip_in_process_derby(spark):
    url = "jdbc:derby:memory:casaflow_test;create=true"
    df = spark.createDataFrame([(1, "Seattle", 1.5), (2, "Tacoma", None)],
                               "region_id int, metro string, rental_income double")
    write_jdbc(df, url, "LND_RENTAL_INCOME", driver="org.apache.derby.jdbc.EmbeddedDriver",
               num_partitions=2)
    back = read_jdbc(spark, url, "LND_RENTAL_INCOME",
                     driver="org.apache.derby.jdbc.EmbeddedDriver",
                     partition_column="REGION_ID", lower_bound=1, upper_bound=3,
                     num_partitions=2)
    rows = sorted((r[0], r[1], r[2]) for r in back.collect())
    assert rows == [(1, "Seattle", 1.5), (2, "Tacoma", None)]


def test_cleaning_matches_pandas(spark, tmp_dir):
    text = (f"{HV_HDR},2012-01-31,2012-02-29,2012-03-31,2012-04-30,2012-05-31\n"
            " 1 ,1, Seattle ,city,Washington,WA,\"Seattle, WA\",King County\t,100,,,400,\n"
            "2,2,Tacoma,city,Washington,WA,\"Tacoma, WA\",Pierce County,,200,NA,300,\n"
            "3,3,Olympia,city,Washington,WA,\"Olympia, WA\",Thurston,,,,,\n")
    path = os.path.join(tmp_dir, "raw_City_zhvi_uc_sfrcondo_tier_0.0_0.33_sm_sa_month.csv")
    _write(path, text)
    cells = clean_cells(spark, [path], n_ids=8).collect()
    got = {}
    for r in cells:
        got.setdefault(r.RegionName, {})[r.pos] = r.value
    ref = pd.read_csv(path)
    for c in ref.columns[:8]:
        if ref[c].dtype == object:
            ref[c] = ref[c].str.strip()
    vals = ref[ref.columns[8:]].astype("float64").interpolate(method="linear", axis=1,
                                                               limit_area="inside")
    for i, name in enumerate(ref["RegionName"]):
        exp = [None if np.isnan(x) else x for x in vals.iloc[i].tolist()]
        assert [got[name][p] for p in range(5)] == exp
    out = os.path.join(tmp_dir, "cleaned")
    for _ in range(2):      # a second run replaces the first one's output
        clean_files(spark, tmp_dir, out, [(8, os.path.basename(path), "x.csv")])
    back = spark.read.option("header", True).option("escape", '"').csv(os.path.join(out, "x.csv"))
    assert sorted(r.RegionID for r in back.collect()) == ["1", "2", "3"]
    assert {r.RegionName for r in back.collect()} == {"Seattle", "Tacoma", "Olympia"}


def test_cleaning_to_parquet(spark, tmp_dir):
    path = os.path.join(tmp_dir, "raw_Zip_zori_x.csv")
    _write(path, f"{ZORI_HDR},2015-03-31\n1,1,01001,zip,MA,MA,Agawam,\"S, MA\",H,1000,,1020\n")
    out = os.path.join(tmp_dir, "cleaned_pq")
    clean_files(spark, tmp_dir, out, [(9, "raw_Zip_zori_x.csv", "x")], fmt="parquet")
    r = spark.read.parquet(os.path.join(out, "x")).first()
    assert (r.RegionName, r["2015-02-28"]) == ("01001", 1010.0)


def test_stream_rejects_a_shifted_header(spark, tmp_dir):
    import pytest
    src = os.path.join(tmp_dir, "incoming")
    os.makedirs(src)
    shifted = ZORI_HDR.replace("2015-01-31,2015-02-28", "2015-02-28,2015-03-31")
    _write(os.path.join(src, "c_zori.csv"),
           f"{shifted}\n1,1,01001,zip,MA,MA,Agawam,\"S, MA\",H,1000,1010\n")
    q = stream_to_lake(landing_stream(spark, RENTAL_INCOME, src, ZORI_HDR.split(",")),
                       os.path.join(tmp_dir, "lake"), os.path.join(tmp_dir, "ck"))
    with pytest.raises(Exception):
        q.awaitTermination()


DIRTY = (f"{HV_HDR},2012-01-31,2012-02-29,2012-03-31,Note\n"
         " 7 ,x, Seattle ,city,Washington,WA,N/A,\"The \"\"A\"\", B\",100,oops,300,4\n"
         "NA,2,Tacoma,city,Washington,WA,\"Tacoma, WA\",Pierce,100,,300,\n")


def test_cleaning_dirty_cells(spark, tmp_dir):
    """Padded, malformed and missing identifiers, doubled quotes, a malformed
    measure (never filled over) and an absent input."""
    import pytest
    from casaflow.plans.landing import file_rejects
    from casaflow.sources.wide_csv import scan_wide
    _write(os.path.join(tmp_dir, "raw.csv"), DIRTY)
    out = os.path.join(tmp_dir, "cleaned")
    clean_files(spark, tmp_dir, out, [(8, "raw.csv", "done.csv")])
    back = spark.read.option("header", True).option("escape", '"').csv(os.path.join(out, "done.csv"))
    rows = {r.RegionName: r for r in back.collect()}
    a, b = rows["Seattle"], rows["Tacoma"]
    assert (a.RegionID, a.SizeRank, a.Metro, a.CountyName) == ("7", None, None, 'The "A", B')
    assert (a["2012-01-31"], a["2012-02-29"], a["2012-03-31"]) == ("100.0", None, "300.0")
    assert (b.RegionID, b["2012-02-29"]) == (None, "200.0")
    cells = {(r.RegionName, r.pos): r.value for r in clean_cells(spark, [os.path.join(tmp_dir, "raw.csv")], n_ids=8).collect()}
    assert cells["Seattle", 1] is None and cells["Tacoma", 1] == 200.0
    r = file_rejects(scan_wide(spark, [os.path.join(tmp_dir, "raw.csv")], n_ids=8), ["NA", "N/A"]).first()
    assert (r.n_cells, r.n_bad_value, r.n_bad_date, r.n_bad_id) == (8, 1, 2, 1)
    with pytest.raises(FileNotFoundError):
        clean_files(spark, tmp_dir, out, [(8, "raw.csv", "done.csv"), (8, "missing.csv", "y.csv")])


def test_lake_overwrite_is_whole_unless_dynamic(spark, tmp_dir):
    from casaflow.sinks.writers import write_lake
    both = spark.createDataFrame([("WA", 2020, 1), ("OR", 2020, 2)], "state string, year int, v int")
    for dynamic, left in ((True, {"WA", "OR"}), (False, {"WA"})):
        path = os.path.join(tmp_dir, f"lake-{dynamic}")
        write_lake(both, path)
        write_lake(both.where("state = 'WA'"), path, dynamic=dynamic)
        assert {r.state for r in spark.read.parquet(path).collect()} == left


def test_long_fill_takes_nan_as_a_gap(spark):
    from casaflow.operators.gapfill import interpolate_linear
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 1, float("nan")), ("a", 2, None), ("a", 3, 4.0)], "k string, p int, v double")
    assert [r.v for r in interpolate_linear(df, ["k"], "p", "v").orderBy("p").collect()] == [1.0, 2.0, 3.0, 4.0]


def test_upserted_rows_without_a_whole_key_all_stay(spark):
    from casaflow.streaming.incremental import _latest
    rows = spark.createDataFrame([(1, None, 1.0, 0, "a"), (1, None, 2.0, 1, "b"), (1, "d", 3.0, 0, "a"), (1, "d", 4.0, 1, "b"), (None, "d", 5.0, 1, "b")],
                                 "region_id int, metric_date string, v double, batch long, inserted_at string")
    out = _latest(rows, ["region_id", "metric_date"])
    assert sorted((r.v, r.inserted_at) for r in out.collect()) == [(1.0, "a"), (2.0, "b"), (4.0, "a"), (5.0, "b")]
