"""Plan regression tests: the shuffle structure that the scale design relies on."""

import os
import re

from pyspark.sql import functions as F

from casaflow.session import materialize
from casaflow.operators import panel as P
from casaflow.operators.facts import fact_average
from casaflow.operators.gapfill import interpolate_wide
from casaflow.plans.cleaning import clean_wide
from casaflow.plans.landing import land
from casaflow.schemas import HOUSE_VALUE
from casaflow.sources.wide_csv import scan_wide
from tests.test_landing import _hv_files
from tests.test_panel_feeds import _facts


def _shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|"
                          r"RoundRobinPartitioning)", plan))


def test_landing_job_has_no_shuffle(spark, tmp_dir):
    _hv_files(tmp_dir)
    out = land(spark, HOUSE_VALUE, os.path.join(tmp_dir, "*zhvi*.csv"))
    assert _shuffles(out) == 0
    assert "Expand" in out._jdf.queryExecution().executedPlan().toString()


def test_cleaning_and_wide_fill_have_no_shuffle(spark, tmp_dir):
    _hv_files(tmp_dir)
    for g in scan_wide(spark, os.path.join(tmp_dir, "*zhvi*.csv"), n_ids=8):
        assert _shuffles(clean_wide(g)) == 0
    df = spark.createDataFrame([("a", 1.0, None, 3.0)], "k string, m0 double, m1 double, m2 double")
    assert _shuffles(interpolate_wide(df, ["m0", "m1", "m2"])) == 0


def test_fact_average_aggregates_before_a_broadcast_join(spark):
    lnd = spark.createDataFrame([("A", "2020-01-31", 1.0), ("A", "2020-01-31", 3.0)],
                                "metro string, metric_date string, house_value double") \
        .selectExpr("metro", "CAST(metric_date AS DATE) AS metric_date", "house_value")
    dim = materialize(spark.createDataFrame([("A", 1)], "metro string, geo_key long"), "dim")   # its size is known
    out = fact_average(lnd, dim, "house_value", "avg_house_value")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert _shuffles(out) == 1 and "BroadcastHashJoin" in plan
    assert plan.index("BroadcastHashJoin") < plan.index("HashAggregate")  # join above the agg


def test_panel_is_one_shuffle_with_checked_dimension(spark):
    facts, dim = _facts(spark)
    out = P.combined_panel(facts, materialize(dim, "dim"), "WA")
    assert _shuffles(out) == 1
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()


def test_payment_landing_moves_lineitem_once(spark):
    """Without broadcasts, lineitem is exchanged by order only."""
    from casaflow.sources import testdata as TD
    from tests.conftest import SF_SMALL
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        TD.landing_monthly_payment.cache_clear()
        plan = TD.landing_monthly_payment(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(l_orderkey") == 1
        narrow = plan[plan.index("Exchange hashpartitioning(o_custkey"):]
        assert "l_orderkey" not in narrow.split("Exchange hashpartitioning(c_custkey")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        TD.landing_monthly_payment.cache_clear()


def test_merge_reads_each_side_once_and_roi_shuffles_once(spark, tmp_dir):
    from casaflow.operators.analytics import roi_5y
    from casaflow.operators.merge import keyed_merge
    t = materialize(spark.createDataFrame([(1, 2.0)], "k int, v double"), "side")
    plan = keyed_merge(t, t, ["k"], {"v": "set"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2
    monthly = materialize(spark.createDataFrame([("a", 1.0)], "metro string, avg_house_value double")
                          .selectExpr("*", "DATE'2020-01-01' AS metric_month"), "monthly")
    assert _shuffles(roi_5y(monthly)) == 1


def test_pivot_compares_a_cell_with_few_columns(spark):
    """Cells are dealt to blocks: no aggregate has a condition per column."""
    from casaflow.operators.reshape import PIVOT_BLOCK, to_wide
    names = [f"{m}/28/2001" for m in range(1, 31)]      # not in the order of text
    rows = [("a", n, f"a{n}") for n in names] + [("b", names[9], "x"), ("c", "other", "y"), ("d", None, "z"), (None, names[29], "n")]
    wide = to_wide(spark.createDataFrame(rows, "k string, h string, v string"), ["k"], "h", names, "v")
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert max(line.count("first(") for line in plan.splitlines()) <= PIVOT_BLOCK
    got = {r["k"]: r for r in wide.collect()}
    assert wide.columns == ["k", *names] and set(got) == {"a", "b", "c", "d", None}
    assert all(got["a"][n] == f"a{n}" for n in names)
    assert {n: v for n, v in got["b"].asDict().items() if v} == {"k": "b", names[9]: "x"}
    assert not any(got[k][n] for k in ("c", "d") for n in names) and got[None][names[29]] == "n"


def test_landing_log_deals_a_partition_value_in_shares(spark, tmp_dir):
    """One state's rows go to several tasks, and kinds need no interpreted lambda."""
    import dataclasses
    from casaflow.plans.landing import landing_log
    from casaflow.schemas import LANDING_SPECS
    spec = dataclasses.replace(LANDING_SPECS["rental_income"], min_date=None)
    ids = list(spec.id_cols)
    with open(os.path.join(tmp_dir, "rent.csv"), "w") as f:
        f.write(",".join([*ids, "2020-01-31", "no date"]) + "\n")
        for i in range(50):
            f.write(",".join([str(i) if c in ("RegionID", "SizeRank") else "WA" for c in ids] + ["oops" if i == 7 else "1.5", "2" if i < 3 else ""]) + "\n")
    log = landing_log(spark, spec, os.path.join(tmp_dir, "rent.csv"))
    plan = log._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and re.search(r"RebalancePartitions \[\w+#\d+, __cf_share#", plan)
    kinds = sorted((r["kind"], r["reason"], r["date_str"]) for r in log.where("kind <> 'landed'").select("kind", F.coalesce("reason", F.lit("")).alias("reason"),
                   F.coalesce("date_str", F.lit("")).alias("date_str")).collect())
    assert kinds == [("file", "", "")] * 50 + [("reject", "bad_date", "no date")] * 3 + [("reject", "bad_value", "2020-01-31")]
    assert log.where("kind = 'landed'").count() == 52
