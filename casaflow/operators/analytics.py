"""Investment analyses named in the project description but not defined there;
these are our definitions.

* five-year return: value(m) / value(m - 60 months) - 1, a self equi-join on
  the shifted month (robust to missing months, unlike a 60-row lag);
* cash-flow correlation: per metro, Pearson correlation of cash flow and house
  value over complete months; null below two months or with a constant input;
* market comparison: a metro's monthly value minus the mean over all metros
  of that month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casaflow.functions import safe_div


def roi_5y(monthly_value: DataFrame, value: str = "avg_house_value",
           months: int = 60) -> DataFrame:
    """Return over ``months`` months, for the months that have a value then: a
    range frame of exactly that distance in months (gaps are safe), one shuffle
    on the metro, whose rows are bounded by the calendar."""
    number = F.year("metric_month") * 12 + F.month("metric_month")
    then = Window.partitionBy("metro").orderBy(number).rangeBetween(-months, -months)
    past = F.first(F.struct(F.col(value).alias("v"))).over(then)
    return (monthly_value.where(F.col("metro").isNotNull() & F.col("metric_month").isNotNull())
            .select("metro", "metric_month", value, past.alias("_past"))
            .where(F.col("_past").isNotNull())
            .select("metro", "metric_month", value, F.col("_past.v").alias("value_5y_ago"))
            .withColumn("roi_5y", safe_div(F.col(value), F.col("value_5y_ago")) - 1))


def cash_flow_correlation(panel: DataFrame, x: str = "cash_flow",
                          y: str = "avg_house_value") -> DataFrame:
    rows = panel.dropna(subset=[x, y])
    n = F.count(F.lit(1))
    varies = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    return (rows.groupBy("metro")
            .agg(n.alias("n_months"),
                 F.when((n >= 2) & varies, F.corr(x, y)).alias("corr_cash_flow_value")))


def vs_market(panel: DataFrame, measures=("avg_house_value", "rental_income")) -> DataFrame:
    """Metro minus market mean per month.

    The market mean is an aggregate by month (bounded by the calendar, a few
    hundred rows), joined back; no window, so a large month never lands whole
    in one task.
    """
    market = (panel.groupBy("metric_month")
              .agg(*[F.avg(m).alias(f"market_{m}") for m in measures]))
    out = panel.select("metro", "metric_month", *measures).join(market, "metric_month")
    return out.withColumns({f"{m}_vs_market": F.col(m) - F.col(f"market_{m}")
                            for m in measures})
