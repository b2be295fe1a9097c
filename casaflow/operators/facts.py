"""Fact tables: average measure per metro and month, keyed by the dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casaflow.operators.geo import joined, with_alias


def fact_average(landing: DataFrame, dim: DataFrame, measure: str, out: str,
                 metro_col: str = "metro", aliases: dict | None = None) -> DataFrame:
    """avg(measure) per (geo_key, metric_date, year) over landing x dim on metro.

    The dimension is unique on metro, so grouping by the joined key equals
    grouping by metro: the average runs *before* the join (partial + final
    aggregate, hot metros combined map-side) and the join sees one row per
    metro and month. ``year`` derives from ``metric_date`` and is recomputed,
    which lets the grouping key match the later merge key.
    ``aliases`` (a dict or a table, see ``geo.with_alias``) maps metro names first
    (payment, rent); house value joins the raw name.
    """
    named = landing.where(F.col(metro_col).isNotNull()).withColumn("metro", F.col(metro_col))
    if joined(aliases):     # a large alias table meets sums by written name, not rows
        sums = named.groupBy("metro", "metric_date").agg(F.sum(measure).alias("_sum"), F.count(measure).alias("_n"))
        agg = (with_alias(sums, "metro", aliases, "metro").groupBy("metro", "metric_date")
               .agg(F.try_divide(F.sum("_sum"), F.sum("_n")).alias(out)))
    else:
        agg = (with_alias(named, "metro", aliases, "metro").groupBy("metro", "metric_date")
               .agg(F.avg(measure).alias(out)))
    d = dim.select("metro", "geo_key")
    return (agg.join(d, "metro")
            .select("geo_key", out, "metric_date",
                    F.year("metric_date").cast("int").alias("year")))


def with_metro(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Replace the surrogate key by the metro name (for reporting / comparison)."""
    d = dim.select("geo_key", "metro")
    return fact.join(d, "geo_key").drop("geo_key")


LEGACY_HV_KEYS = ["region_id", "size_rank", "region_name", "region_type", "state",
                  "metro", "county_name", "metric_date", "year"]


def legacy_house_value(landing: DataFrame) -> DataFrame:
    """Denormalised house-value final: average of the tiers of one region-month."""
    return (landing.groupBy(*LEGACY_HV_KEYS)
            .agg(F.avg("house_value").alias("avg_house_value"))
            .select(F.col("region_id").cast("int"), F.col("size_rank").cast("int"),
                    F.col("region_name").cast("string"), "region_type", "state",
                    "metro", "county_name", "avg_house_value", "metric_date",
                    F.col("year").cast("int")))


def legacy_monthly_payment(landing: DataFrame) -> DataFrame:
    """Payment final: landing rows re-labelled, no aggregation."""
    return landing.select(
        F.col("region_id").cast("int"), F.col("size_rank").cast("int"),
        F.col("region_name").alias("metro"), "region_type",
        F.col("state_name").alias("state"), "monthly_payment", "metric_date",
        F.col("year").cast("int"))


def legacy_rental_income(landing: DataFrame) -> DataFrame:
    """Rent final: landing rows re-labelled, region name kept as text."""
    return landing.select(
        F.col("region_id").cast("int"), F.col("size_rank").cast("int"),
        F.col("region_name").cast("string"), "region_type",
        F.col("state_name").alias("state"), "city", "metro", "county_name",
        "rental_income", "metric_date", F.col("year").cast("int"))
