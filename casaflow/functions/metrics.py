"""Investment metrics. Division by zero yields null (``try_divide``), where a
pandas frame would give infinity; ANSI mode stays on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: Column | str, den: Column | str) -> Column:
    return F.try_divide(_c(num), _c(den))


def gross_yield(rent="rental_income", value="avg_house_value") -> Column:
    """Annualised rent over property value."""
    return safe_div(_c(rent) * F.lit(12), _c(value))


def cash_flow(rent="rental_income", payment="monthly_payment") -> Column:
    """Monthly rent minus mortgage payment; null if either is null."""
    return _c(rent) - _c(payment)


def price_to_rent(value="avg_house_value", rent="rental_income") -> Column:
    return safe_div(_c(value), _c(rent) * F.lit(12))


def investment_metrics(df: DataFrame, value="avg_house_value",
                       rent="rental_income", payment="monthly_payment") -> DataFrame:
    return df.withColumns({
        "gross_yield": gross_yield(rent, value),
        "cash_flow": cash_flow(rent, payment),
        "price_to_rent_ratio": price_to_rent(value, rent),
    })
