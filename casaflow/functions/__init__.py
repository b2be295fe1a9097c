"""Column-expression helpers. Everything here returns a ``Column`` built from
built-in Spark functions, so it stays inside whole-stage codegen."""

from casaflow.functions.dates import (header_date, month_start,
                                      parse_date_multi, year_of)
from casaflow.functions.metrics import (gross_yield, cash_flow,
                                        investment_metrics, price_to_rent,
                                        safe_div)
from casaflow.functions.text import (replace_values, snake_case, tier_from_path,
                                     trim_all)

__all__ = ["header_date", "month_start", "parse_date_multi", "year_of",
           "gross_yield", "cash_flow", "investment_metrics", "price_to_rent",
           "safe_div", "replace_values", "snake_case", "tier_from_path",
           "trim_all"]
