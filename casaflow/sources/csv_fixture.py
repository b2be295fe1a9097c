"""Write a landing frame back out as wide monthly CSV files (the source
format), for end-to-end runs of the landing job on data derived from the
test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casaflow.operators.reshape import month_ends, to_wide
from casaflow.session import scratch_path

# landing column -> source header (fixed values)
HV_SOURCE_NAMES = {"region_id": "RegionID", "size_rank": "SizeRank",
                   "region_name": "RegionName", "region_type": "RegionType",
                   "state_name": "StateName", "state": "State", "metro": "Metro",
                   "county_name": "CountyName"}
TIER_FILES = {"top": "0.67_1.0", "medium": "0.33_0.67", "bottom": "0.0_0.33",
              "unknown": "all"}
# two header spellings, so the scan sees two header groups
TIER_HEADER_FORMAT = {"top": "M/d/yyyy", "bottom": "M/d/yyyy",
                      "medium": "yyyy-MM-dd", "unknown": "yyyy-MM-dd"}


#: landing column -> source header of the other two families
MP_SOURCE_NAMES = {"region_id": "RegionID", "size_rank": "SizeRank", "region_name": "RegionName",
                   "region_type": "RegionType", "state_name": "StateName"}
RI_SOURCE_NAMES = {**MP_SOURCE_NAMES, "state": "State", "city": "City", "metro": "Metro",
                   "county_name": "CountyName"}


def write_dirty_csvs(landing: DataFrame, names: dict[str, str], measure: str, path: str) -> list:
    """One family as a folder of wide CSV part files with the faults real files
    have, each by key: padded ids, ``N/A`` metros, doubled quotes in counties
    and ``oops`` cells. Returns the month ends of its header."""
    months = month_ends(landing, "metric_date")
    key, month = F.col("region_id"), F.year("metric_date") * 12 + F.month("metric_date")
    ids = {"region_id": F.concat(F.lit("  "), key.cast("string"), F.lit(" ")),
           "metro": F.when(key % 5 == 0, "N/A").otherwise(F.col("metro") if "metro" in names else F.lit(None)),
           "county_name": F.when(key % 7 == 0, F.concat(F.lit('The "X", '), "county_name")).otherwise(F.col("county_name"))
           if "county_name" in names else F.lit(None)}
    cell = F.when((key + month) % 11 == 0, "oops").otherwise(F.col(measure).cast("string"))
    long = landing.where(F.col(measure).isNotNull()).select(
        *[ids.get(c, F.col(c)).alias(h) for c, h in names.items()], F.date_format("metric_date", "yyyy-MM-dd").alias("hdr"), cell.alias("cell"))
    wide = to_wide(long, list(names.values()), "hdr", [m.isoformat() for m in months], "cell")
    (wide.write.option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return months


def _py_format(d, fmt):
    return f"{d.month}/{d.day}/{d.year}" if fmt == "M/d/yyyy" else d.isoformat()


def write_house_value_csvs(spark: SparkSession, landing: DataFrame,
                           root: str | None = None) -> str:
    """One file family per tier; returns the glob that matches them all."""
    root = root or scratch_path(spark, "wide-csv")
    months = month_ends(landing, "metric_date")
    file_of = None
    for tier, frag in TIER_FILES.items():
        name = f"raw_City_zhvi_uc_sfrcondo_tier_{frag}_sm_sa_month.csv"
        cond = F.col("home_tier") == tier
        file_of = F.when(cond, name) if file_of is None else file_of.when(cond, name)
    src = landing.withColumn("file", file_of)
    ids = [F.col(k).alias(v) for k, v in HV_SOURCE_NAMES.items()]
    for fmt in sorted(set(TIER_HEADER_FORMAT.values())):
        tiers = [t for t, f in TIER_HEADER_FORMAT.items() if f == fmt]
        part = (src.where(F.col("home_tier").isin(tiers))
                .select(*ids, "file", F.date_format("metric_date", fmt).alias("hdr"),
                        "house_value"))
        hdrs = [_py_format(m, fmt) for m in months]
        wide = to_wide(part, [*HV_SOURCE_NAMES.values(), "file"], "hdr", hdrs, "house_value")
        (wide.write.mode("append").option("header", True)
         .partitionBy("file").csv(root))
    return f"{root}/file=*zhvi*.csv"
