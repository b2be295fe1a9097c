"""Landing frames derived from the TPC-H-style test tables.

The test tables hold no property data, so each landing table is defined over
them (one row per region and month, the measure an average):

* house value   — orders x customer x nation x region; region = nation and
  market segment, metro = nation (none for nation 24), state = region,
  county = segment, tier from a file name made from the order priority,
  month = last day of the order month, kept after 1995-12-31.
* monthly payment — lineitem x orders x customer x nation x region; region =
  nation, payment = mean discounted price / 10, month of the ship date.
* rental income — lineitem x supplier x nation x region; region = supplier,
  metro and city = nation, county from the supplier key (none for key % 3 = 0),
  rent = mean of price x (discount + 0.01).

``NATION_7`` -> ``NATION_8`` stands in for the metro alias and ``AMERICA`` for
the state filter. The same definitions are written as SQL for the oracle.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casaflow.functions import tier_from_path

TEST_ALIASES = {"NATION_7": "NATION_8"}
TEST_STATE = "AMERICA"
TEST_CUTOFF = dt.date(1995, 12, 31)
SEGMENT_CODES = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3,
                 "HOUSEHOLD": 4, "MACHINERY": 5}
# order priority's first character -> synthetic tier fragment of a file name
PRIORITY_FILE_TIER = {"1": "0.67_1.0", "2": "0.67_1.0", "3": "0.33_0.67",
                      "4": "0.0_0.33"}


@functools.lru_cache(maxsize=256)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a (lazy) DataFrame, resolved once per session: each
    ``read.parquet`` call runs a schema job, which would otherwise repeat for
    every query that mentions the table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _geo(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return n.join(r, n.n_regionkey == r.r_regionkey).drop("n_regionkey", "r_regionkey")


def _month_end(c):
    return F.last_day(F.col(c).cast("date"))


def synthetic_file_name(priority_col) -> F.Column:
    frag = None
    first = F.substring(priority_col, 1, 1)
    for k, v in PRIORITY_FILE_TIER.items():
        frag = F.when(first == k, v) if frag is None else frag.when(first == k, v)
    frag = frag.otherwise("all")
    return F.concat(F.lit("raw_City_zhvi_uc_sfrcondo_tier_"), frag,
                    F.lit("_sm_sa_month.csv"))


@functools.lru_cache(maxsize=64)
def landing_house_value(spark: SparkSession, sf_dir: str,
                        cutoff: dt.date | None = TEST_CUTOFF) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice",
                                              "o_orderdate", "o_orderpriority")
    if cutoff is not None:
        # the exact rule is on the month end (below); the bound it implies on
        # the raw order date (a month ending after the cut-off starts no
        # earlier than the cut-off's month) reaches the Parquet scan as a
        # pushed filter and skips row groups by their statistics
        month_floor = dt.datetime(cutoff.year, cutoff.month, 1)
        o = o.where(F.col("o_orderdate") >= F.lit(month_floor).cast("timestamp_ntz"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey",
                                                "c_mktsegment")
    rows = (o.join(c, o.o_custkey == c.c_custkey)
            .select("c_nationkey", "c_mktsegment", "o_totalprice",
                    tier_from_path(synthetic_file_name(F.col("o_orderpriority"))).alias("home_tier"),
                    _month_end("o_orderdate").alias("metric_date")))
    if cutoff is not None:
        rows = rows.where(F.col("metric_date") > F.lit(cutoff))
    # aggregate on the natural key; every descriptive column is a function of
    # it and is attached afterwards from the 25-row geography
    agg = (rows.groupBy("c_nationkey", "c_mktsegment", "home_tier", "metric_date")
           .agg(F.avg("o_totalprice").alias("house_value")))
    seg = None
    for k, v in SEGMENT_CODES.items():
        cond = F.col("c_mktsegment") == k
        seg = F.when(cond, v) if seg is None else seg.when(cond, v)
    return (agg.join(_geo(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
            .select((F.col("c_nationkey") * 10 + seg.otherwise(0)).cast("int").alias("region_id"),
                    (F.col("n_nationkey") + 1).cast("int").alias("size_rank"),
                    F.concat(F.col("n_name"), F.lit("-"), F.col("c_mktsegment")).alias("region_name"),
                    F.lit("city").alias("region_type"),
                    F.col("r_name").alias("state_name"),
                    F.col("r_name").alias("state"),
                    F.when(F.col("n_nationkey") == 24, F.lit(None).cast("string"))
                     .otherwise(F.col("n_name")).alias("metro"),
                    F.col("c_mktsegment").alias("county_name"),
                    "home_tier", "metric_date", "house_value",
                    F.year("metric_date").alias("year")))


@functools.lru_cache(maxsize=64)
def landing_monthly_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice",
                                                 "l_discount", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation_of = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))      # narrow rows first,
                 .select("o_orderkey", "c_nationkey"))                    # lineitem moves once
    agg = (li.join(nation_of, li.l_orderkey == F.col("o_orderkey"))
           .groupBy("c_nationkey", _month_end("l_shipdate").alias("metric_date"))
           .agg((F.avg(F.col("l_extendedprice") * (1 - F.col("l_discount"))) / 10)
                .alias("monthly_payment")))
    return (agg.join(_geo(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("n_nationkey").cast("int").alias("region_id"),
                    (F.col("n_nationkey") + 1).cast("int").alias("size_rank"),
                    F.col("n_name").alias("region_name"),
                    F.lit("msa").alias("region_type"),
                    F.col("r_name").alias("state_name"),
                    "metric_date", "monthly_payment",
                    F.year("metric_date").alias("year")))


@functools.lru_cache(maxsize=64)
def landing_rental_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_extendedprice",
                                                 "l_discount", "l_shipdate")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    # lineitem is aggregated per (supplier, month) before any join
    agg = (li.groupBy("l_suppkey", _month_end("l_shipdate").alias("metric_date"))
           .agg(F.avg(F.col("l_extendedprice") * (F.col("l_discount") + 0.01))
                .alias("rental_income")))
    k3 = F.col("s_suppkey") % 3
    return (agg.join(s, agg.l_suppkey == s.s_suppkey)
            .join(_geo(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("s_suppkey").cast("int").alias("region_id"),
                    (F.col("s_suppkey") + 1).cast("int").alias("size_rank"),
                    F.col("s_name").alias("region_name"),
                    F.lit("zip").alias("region_type"),
                    F.col("r_name").alias("state_name"),
                    F.col("r_name").alias("state"),
                    F.col("n_name").alias("city"),
                    F.col("n_name").alias("metro"),
                    F.when(k3 == 0, F.lit(None).cast("string"))
                     .otherwise(F.concat(F.lit("COUNTY_"), k3.cast("string"))).alias("county_name"),
                    "metric_date", "rental_income",
                    F.year("metric_date").alias("year")))


def landings(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"house_value": landing_house_value(spark, sf_dir),
            "monthly_payment": landing_monthly_payment(spark, sf_dir),
            "rental_income": landing_rental_income(spark, sf_dir)}
