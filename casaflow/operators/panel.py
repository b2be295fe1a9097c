"""Dashboard queries: monthly averages per metro, the combined panel, its feeds.

Every feed is a projection/filter of the combined panel, so a caller that
needs several feeds persists the panel once (see ``plans.dashboard``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casaflow.functions import investment_metrics, month_start
from casaflow.operators.reshape import melt
from casaflow.schemas import (DEFAULT_METRO_COUNT, PREFERRED_METROS,
                              RENT_VS_MORTGAGE_LABELS, VALUE_VS_RENT_LABELS)

PANEL_KEYS = ["metro", "metric_month"]
MEASURES = ("avg_house_value", "rental_income", "monthly_payment")


def _dim_in_state(dim: DataFrame, state: str | None) -> DataFrame:
    d = dim.where(F.col("metro").isNotNull())
    if state is not None:
        d = d.where(F.col("state") == state)
    return d.select("geo_key", "metro")


def monthly_metric(fact: DataFrame, dim: DataFrame, measure: str,
                   state: str | None) -> DataFrame:
    """avg(measure) per (metro, first day of month) for the dimension rows of
    one state (all states when ``state`` is None)."""
    return (fact.join(_dim_in_state(dim, state), "geo_key")
            .groupBy("metro", month_start("metric_date").alias("metric_month"))
            .agg(F.avg(measure).alias(measure)))


def combined_panel(facts: dict[str, DataFrame], dim: DataFrame,
                   state: str | None) -> DataFrame:
    """Metro x month with the three monthly averages and the three ratios.

    The three-way full outer join on (metro, month) is expressed as one
    aggregate over the union of the facts: ``avg`` skips the nulls of the
    other measures, and a (metro, month) appears when any measure has a row —
    the outer-join result, with one shuffle instead of two join shuffles.
    Rows with a null month are dropped (the outer merge drops null keys).
    """
    null = F.lit(None).cast("double")
    parts = []
    for name, measure in (("house_value", "avg_house_value"),
                          ("rental_income", "rental_income"),
                          ("monthly_payment", "monthly_payment")):
        parts.append(facts[name].select(
            "geo_key", "metric_date",
            *[(F.col(measure) if m == measure else null).alias(m) for m in MEASURES]))
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    panel = (u.where(F.col("metric_date").isNotNull())
             .join(_dim_in_state(dim, state), "geo_key")
             .groupBy("metro", month_start("metric_date").alias("metric_month"))
             .agg(*[F.avg(m).alias(m) for m in MEASURES]))
    return investment_metrics(panel)


def order_panel(panel: DataFrame) -> DataFrame:
    return panel.orderBy(F.asc_nulls_last("metro"), F.asc_nulls_last("metric_month"))


def metro_list(panel: DataFrame) -> DataFrame:
    return panel.select("metro").distinct().orderBy("metro")


def default_metros(panel: DataFrame, preferred=PREFERRED_METROS,
                   n: int = DEFAULT_METRO_COUNT) -> DataFrame:
    """All preferred metros that exist; if none does, the first ``n``
    alphabetically. One aggregate over the distinct metros gathers the
    preferred ones and the first ``n`` (the top-k is the feature)."""
    m = panel.select("metro").where(F.col("metro").isNotNull()).distinct()
    picked = m.where(F.col("metro").isin(list(preferred))).withColumn("preferred", F.lit(True))
    first = m.orderBy("metro").limit(n).withColumn("preferred", F.lit(False))
    both = picked.unionByName(first).agg(F.collect_set(F.when(F.col("preferred"), F.col("metro"))).alias("preferred"),
                                         F.collect_set(F.when(~F.col("preferred"), F.col("metro"))).alias("first"))
    return both.select(F.explode(F.when(F.size("preferred") > 0, F.col("preferred")).otherwise(F.col("first"))).alias("metro"))


def select_metros(panel: DataFrame, metros: DataFrame | list[str]) -> DataFrame:
    """Keep the panel rows of the selected metros (IN-list or semi-join)."""
    if isinstance(metros, DataFrame):
        return panel.join(metros.select("metro"), "metro", "left_semi")
    return panel.where(F.col("metro").isin(list(metros)))


def coverage_report(panel: DataFrame) -> DataFrame:
    """Which metro has which metric, with month counts: one pass over the panel."""
    return (panel.groupBy("metro")
            .agg(F.count(F.lit(1)).alias("n_months"),
                 F.count("avg_house_value").alias("n_house_value"),
                 F.count("rental_income").alias("n_rental_income"),
                 F.count("monthly_payment").alias("n_monthly_payment"))
            .withColumns({
                "has_house_value": F.col("n_house_value") > 0,
                "has_rental_income": F.col("n_rental_income") > 0,
                "has_monthly_payment": F.col("n_monthly_payment") > 0}))


# --- chart feeds -----------------------------------------------------------

def _complete(panel, cols):
    return panel.dropna(subset=list(cols))


def feed_trend(panel: DataFrame, measure: str) -> DataFrame:
    """One metric's trend, rows with that metric only."""
    return _complete(panel, [measure]).select("metro", "metric_month", measure)


def feed_value_vs_rent(panel: DataFrame) -> DataFrame:
    """Value and rent in long form; ``log10_amount`` feeds the log axis."""
    rows = _complete(panel, ["avg_house_value", "rental_income"])
    long = melt(rows, ["metric_month", "metro"], ["avg_house_value", "rental_income"],
                "metric", "amount", VALUE_VS_RENT_LABELS)
    return long.withColumn("log10_amount", F.log10("amount"))


def feed_gross_yield(panel: DataFrame) -> DataFrame:
    rows = _complete(panel, ["avg_house_value", "rental_income"])
    return rows.select("metro", "metric_month", "gross_yield")


def feed_rent_vs_mortgage(panel: DataFrame) -> DataFrame:
    rows = _complete(panel, ["rental_income", "monthly_payment", "cash_flow"])
    return melt(rows, ["metric_month", "metro"], ["rental_income", "monthly_payment"],
                "metric", "amount", RENT_VS_MORTGAGE_LABELS)


def feed_cash_flow(panel: DataFrame) -> DataFrame:
    """Cash-flow trend; ``above_break_even`` marks months above the $0 line."""
    rows = _complete(panel, ["rental_income", "monthly_payment", "cash_flow"])
    return rows.select("metro", "metric_month", "cash_flow",
                       (F.col("cash_flow") > 0).alias("above_break_even"))


def raw_combined_table(panel: DataFrame) -> DataFrame:
    return panel.orderBy(F.desc_nulls_last("metric_month"), F.asc_nulls_last("metro"))
