"""Dashboard data: the combined panel for one state and every chart feed.

The panel is computed once for all its feeds, which are cheap projections (the
source cached each query result for an hour). Over published tables it is stored
beside the version it was computed from (``stored_panel``): versions never change,
so a panel never expires and later sessions read it; over other tables it is
persisted while its feeds are produced.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from casaflow.operators import panel as P
from casaflow.schemas import DEFAULT_STATE, PREFERRED_METROS
from casaflow.sinks.publish import PANELS, current_version, publish, read_current

FACTS = ("house_value", "monthly_payment", "rental_income")


def stored_panel(spark: SparkSession, store_root: str, state: str | None = DEFAULT_STATE, version: str | None = None) -> DataFrame:
    """The combined panel of a published version (default: the newest) and a
    state (None: all), computed by the first caller and read by all later ones.
    Two callers at once store it twice, and the newer copy counts."""
    version = version or current_version(spark, store_root)
    if version is None:
        raise ValueError(f"nothing is published in {store_root}")
    place = f"{store_root.rstrip('/')}/{PANELS}/{version}/{'every' if state is None else 'state-' + quote(state, safe='')}"
    found = read_current(spark, place, ["panel"])
    if not found:
        tables = read_current(spark, store_root, ["dim_geography", *[f"fact_{k}" for k in FACTS]], version)
        publish(spark, place, {"panel": P.combined_panel({k: tables[f"fact_{k}"] for k in FACTS}, tables["dim_geography"], state)})
        found = read_current(spark, place, ["panel"])
    return found["panel"]


class Dashboard:
    def __init__(self, dim: DataFrame | None, facts: dict[str, DataFrame] | None,
                 state: str | None = DEFAULT_STATE, preferred=PREFERRED_METROS, panel: DataFrame | None = None):
        self.preferred = preferred
        self.panel = panel if panel is not None else P.combined_panel(facts, dim, state).persist(StorageLevel.MEMORY_AND_DISK)

    def metros(self) -> DataFrame:
        return P.metro_list(self.panel)

    def default_metros(self) -> DataFrame:
        return P.default_metros(self.panel, self.preferred)

    def selected(self, metros: DataFrame | list[str] | None = None) -> DataFrame:
        return P.select_metros(self.panel, self.default_metros() if metros is None else metros)

    def feeds(self, metros: DataFrame | list[str] | None = None) -> dict[str, DataFrame]:
        sel = self.selected(metros)
        return {
            "house_value": P.feed_trend(sel, "avg_house_value"),
            "rental_income": P.feed_trend(sel, "rental_income"),
            "monthly_payment": P.feed_trend(sel, "monthly_payment"),
            "value_vs_rent": P.feed_value_vs_rent(sel),
            "gross_yield": P.feed_gross_yield(sel),
            "rent_vs_mortgage": P.feed_rent_vs_mortgage(sel),
            "cash_flow": P.feed_cash_flow(sel),
            "raw_combined": P.raw_combined_table(sel),
        }

    def coverage(self) -> DataFrame:
        return P.coverage_report(self.panel)

    def close(self) -> None:
        self.panel.unpersist()


def export_feeds(dim: DataFrame | None, facts: dict[str, DataFrame] | None, out_root: str,
                 state: str | None = DEFAULT_STATE, metros=None,
                 preferred=PREFERRED_METROS, panel: DataFrame | None = None) -> list[str]:
    """Write every chart feed, the metro list and the coverage report as
    Parquet under ``out_root/<feed>`` for a BI tool; the panel (computed here
    unless given) serves all of them."""
    dash = Dashboard(dim, facts, state, preferred, panel)
    written = []
    try:
        outputs = {**dash.feeds(metros), "metros": dash.metros(), "coverage": dash.coverage()}
        for name, df in outputs.items():
            path = f"{out_root.rstrip('/')}/{name}"
            df.write.mode("overwrite").parquet(path)
            written.append(path)
    finally:
        dash.close()
    return written
