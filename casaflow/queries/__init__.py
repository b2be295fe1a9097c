"""Registered queries over the driver's test tables.

Each callable takes (spark, sf_dir) and runs library operators over data
derived from the whole test tables. Layers are materialised once per session
(landing -> dimension -> facts, plus the wide and CSV inputs of the reshaping
and cleaning queries) and each query computes its own layer from the one
below. Compared doubles are passed through ``amt`` (4 decimals) or ``ratio``
(6 decimals) offset floors here only, never inside the library.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casaflow.functions import (parse_date_multi, replace_values, tier_from_path,
                                trim_all)
from casaflow.operators import analytics
from casaflow.operators import panel as P
from casaflow.operators.facts import legacy_house_value as _legacy_hv
from casaflow.operators.facts import legacy_rental_income as _legacy_ri
from casaflow.operators.facts import with_metro
from casaflow.operators.gapfill import interpolate_linear
from casaflow.operators.geo import distinct_on, geo_candidates
from casaflow.operators.merge import duplicate_keys as _dups
from casaflow.operators.merge import orphan_keys
from casaflow.operators.reshape import month_ends, rename_snake, to_wide, unpivot_wide
from casaflow.plans.final import (batch_fact, batch_facts, build_dim, upsert_dim_rows,
                                  upsert_fact, upsert_legacy)
from casaflow.plans.landing import reject_report as _reject_report
from casaflow.session import materialize
from casaflow.sources import testdata as TD

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def amt(c: Column | str, scale: int = 10_000) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * scale + 0.3717) / scale


def ratio(c: Column | str) -> Column:
    return amt(c, 1_000_000)


def _round(df: DataFrame, amounts=(), ratios=()) -> DataFrame:
    repl = {c: amt(c) for c in amounts}
    repl.update({c: ratio(c) for c in ratios})
    return df.withColumns(repl)


# --- shared building blocks ---------------------------------------------------
# Like the pipeline, each layer is materialised once and the next layer reads
# it: landing tables -> dimension -> fact tables. Materialisation is a Parquet
# table in the shared scratch folder (lineage cut, survives executor loss, later
# scans are pruned and pushed down). A query recomputes only its own stage: ``fact_*`` aggregates the
# stored landing against the stored dimension, the dashboard queries read the
# stored facts. Memoised per (session, folder).

def _store(df: DataFrame) -> DataFrame:
    return materialize(df, "layer")


@functools.lru_cache(maxsize=32)
def _landings(spark, sf_dir):
    return {k: _store(v) for k, v in TD.landings(spark, sf_dir).items()}


@functools.lru_cache(maxsize=32)
def _dim(spark, sf_dir):
    return _store(build_dim(spark, _landings(spark, sf_dir), TD.TEST_ALIASES))


@functools.lru_cache(maxsize=32)
def _fact_tables(spark, sf_dir):
    facts = batch_facts(_landings(spark, sf_dir), _dim(spark, sf_dir), TD.TEST_ALIASES)
    return {k: _store(v) for k, v in facts.items()}


def _star(spark, sf_dir):
    """(stored landings, stored dimension, stored facts)."""
    return _landings(spark, sf_dir), _dim(spark, sf_dir), _fact_tables(spark, sf_dir)


@functools.lru_cache(maxsize=64)
def _panel(spark, sf_dir, state=TD.TEST_STATE):
    _, dim, facts = _star(spark, sf_dir)
    return P.combined_panel(facts, dim, state)


@functools.lru_cache(maxsize=32)
def _selected(spark, sf_dir):
    panel = _panel(spark, sf_dir)
    return P.select_metros(panel, P.default_metros(panel))


PANEL_AMOUNTS = ("avg_house_value", "rental_income", "monthly_payment", "cash_flow")
PANEL_RATIOS = ("gross_yield", "price_to_rent_ratio")


# --- landing --------------------------------------------------------------

@register
def landing_house_value(spark, sf_dir):
    return _round(TD.landing_house_value(spark, sf_dir), ["house_value"])


@register
def landing_monthly_payment(spark, sf_dir):
    return _round(TD.landing_monthly_payment(spark, sf_dir), ["monthly_payment"])


@register
def landing_rental_income(spark, sf_dir):
    return _round(TD.landing_rental_income(spark, sf_dir), ["rental_income"])


# --- geography ------------------------------------------------------------

@register
def metro_alias(spark, sf_dir):
    mp = _landings(spark, sf_dir)["monthly_payment"]
    return mp.select("region_name", "metric_date",
                     replace_values("region_name", TD.TEST_ALIASES).alias("metro"))


@register
def geo_union_distinct(spark, sf_dir):
    lands = _landings(spark, sf_dir)
    return geo_candidates(lands["house_value"], lands["monthly_payment"],
                          lands["rental_income"], TD.TEST_ALIASES)


@register
def dim_geography(spark, sf_dir):
    dim = build_dim(spark, _landings(spark, sf_dir), TD.TEST_ALIASES)
    return dim.select("metro", "state", "county_name")


# --- facts ----------------------------------------------------------------

def _fact(name, measure):
    def q(spark, sf_dir):
        lands, dim = _landings(spark, sf_dir), _dim(spark, sf_dir)
        fact = batch_fact(lands, dim, name, TD.TEST_ALIASES)
        return _round(with_metro(fact, dim), [measure])
    q.__name__ = f"fact_{name}"
    return q


fact_house_value = register(_fact("house_value", "avg_house_value"))
fact_monthly_payment = register(_fact("monthly_payment", "monthly_payment"))
fact_rental_income = register(_fact("rental_income", "rental_income"))


# --- dashboard ------------------------------------------------------------

def _monthly(name, measure):
    def q(spark, sf_dir):
        _, dim, facts = _star(spark, sf_dir)
        return _round(P.monthly_metric(facts[name], dim, measure, TD.TEST_STATE), [measure])
    q.__name__ = f"monthly_{name}"
    return q


monthly_house_value = register(_monthly("house_value", "avg_house_value"))
monthly_rental_income = register(_monthly("rental_income", "rental_income"))
monthly_monthly_payment = register(_monthly("monthly_payment", "monthly_payment"))


@register
def combined_panel(spark, sf_dir):
    """All states: the three monthly averages per metro and month."""
    panel = _panel(spark, sf_dir, None)
    return _round(panel.select("metro", "metric_month", *P.MEASURES), P.MEASURES)


@register
def investment_metrics(spark, sf_dir):
    """State panel with gross yield, cash flow and price-to-rent ratio."""
    return _round(P.order_panel(_panel(spark, sf_dir)), PANEL_AMOUNTS, PANEL_RATIOS)


@register
def selected_metros_panel(spark, sf_dir):
    return _round(_selected(spark, sf_dir), PANEL_AMOUNTS, PANEL_RATIOS)


@register
def raw_combined_table(spark, sf_dir):
    return _round(P.raw_combined_table(_selected(spark, sf_dir)), PANEL_AMOUNTS,
                  PANEL_RATIOS)


@register
def metro_list(spark, sf_dir):
    return P.metro_list(_panel(spark, sf_dir))


@register
def default_metros(spark, sf_dir):
    return P.default_metros(_panel(spark, sf_dir))


@register
def coverage_report(spark, sf_dir):
    return P.coverage_report(_panel(spark, sf_dir, None))


def _feed(measure):
    def q(spark, sf_dir):
        return _round(P.feed_trend(_selected(spark, sf_dir), measure), [measure])
    return q


feed_house_value = _feed("avg_house_value")
feed_house_value.__name__ = "feed_house_value"
register(feed_house_value)
feed_rental_income = _feed("rental_income")
feed_rental_income.__name__ = "feed_rental_income"
register(feed_rental_income)
feed_monthly_payment = _feed("monthly_payment")
feed_monthly_payment.__name__ = "feed_monthly_payment"
register(feed_monthly_payment)


@register
def feed_value_vs_rent(spark, sf_dir):
    f = P.feed_value_vs_rent(_selected(spark, sf_dir))
    return f.withColumns({"amount": amt("amount"), "log10_amount": ratio("log10_amount")})


@register
def feed_gross_yield(spark, sf_dir):
    return _round(P.feed_gross_yield(_selected(spark, sf_dir)), ratios=["gross_yield"])


@register
def feed_rent_vs_mortgage(spark, sf_dir):
    return _round(P.feed_rent_vs_mortgage(_selected(spark, sf_dir)), ["amount"])


@register
def feed_cash_flow(spark, sf_dir):
    return _round(P.feed_cash_flow(_selected(spark, sf_dir)), ["cash_flow"])


# --- analyses of our own definition ----------------------------------------

@register
def roi_5y(spark, sf_dir):
    _, dim, facts = _star(spark, sf_dir)
    monthly = P.monthly_metric(facts["house_value"], dim, "avg_house_value", None)
    return _round(analytics.roi_5y(monthly), ["avg_house_value", "value_5y_ago"],
                  ["roi_5y"])


@register
def cash_flow_correlation(spark, sf_dir):
    return _round(analytics.cash_flow_correlation(_panel(spark, sf_dir, None)),
                  ratios=["corr_cash_flow_value"])


@register
def vs_market(spark, sf_dir):
    m = ("avg_house_value", "rental_income")
    out = analytics.vs_market(_panel(spark, sf_dir, None), m)
    return _round(out, [*m, *[f"market_{c}" for c in m], *[f"{c}_vs_market" for c in m]])


# --- reshaping and gap filling ---------------------------------------------

SERIES = ["region_name", "home_tier"]
HV_IDS = ["region_id", "size_rank", "region_name", "region_type", "state_name",
          "state", "metro", "county_name", "home_tier"]
SPLIT_OLD = "1999-01-01"     # existing batch: months before this day
SPLIT_NEW = "1998-01-01"     # incoming batch: months from this day (overlap 1998)


@functools.lru_cache(maxsize=32)
def _landing_all(spark, sf_dir):
    """House values of every month: reshaping and cleaning know no cut-off."""
    return _store(TD.landing_house_value(spark, sf_dir, cutoff=None))


@functools.lru_cache(maxsize=32)
def _hv_months(spark, sf_dir):
    return tuple(month_ends(_landing_all(spark, sf_dir), "metric_date"))


@functools.lru_cache(maxsize=32)
def _wide_hv(spark, sf_dir, series=tuple(SERIES)):
    """House values in the wide source layout (one row per series, one column
    per month), stored once per session: the input of the interpolation
    queries, as the wide files are the input of the cleaning job."""
    lnd = _landing_all(spark, sf_dir)
    months = list(_hv_months(spark, sf_dir))
    wide = _store(to_wide(lnd, list(series), "metric_date", months, "house_value"))
    cols = [(str(m), m, i) for i, m in enumerate(months)]
    return wide, cols


@register
def unpivot_roundtrip(spark, sf_dir):
    """Landing -> wide (one column per month) -> unpivot -> non-null cells."""
    lnd = _landing_all(spark, sf_dir)
    months = list(_hv_months(spark, sf_dir))
    wide = to_wide(lnd, HV_IDS, "metric_date", months, "house_value")
    long = unpivot_wide(wide, HV_IDS, [(str(m), m, i) for i, m in enumerate(months)],
                        "house_value")
    return _round(long.dropna(subset=["house_value"])
                  .select(*HV_IDS, "metric_date", "house_value"), ["house_value"])


@register
def interpolate_series(spark, sf_dir):
    """Series x month grid with interior gaps filled linearly by position."""
    wide, cols = _wide_hv(spark, sf_dir)
    long = unpivot_wide(wide, SERIES, cols, "house_value")
    out = interpolate_linear(long, SERIES, "pos", "house_value")
    return _round(out.select(*SERIES, "metric_date", "house_value"), ["house_value"])


@register
def interpolate_wide_rows(spark, sf_dir):
    """The same fill done row-wise on the wide frame (no shuffle for the
    fill itself), reported in long form."""
    from casaflow.operators.gapfill import interpolate_wide
    wide, cols = _wide_hv(spark, sf_dir)
    filled = interpolate_wide(wide, [c for c, _, _ in cols])
    long = unpivot_wide(filled, SERIES, cols, "house_value")
    return _round(long.select(*SERIES, "metric_date", "house_value"), ["house_value"])


@register
def clean_house_value_files(spark, sf_dir):
    """The cleaning job over wide house-value CSVs derived from the test
    tables: identifiers trimmed, NA tokens null, interior gaps of every row
    filled (no shuffle); reported as cells per (region, tier, month)."""
    from casaflow.functions import header_date
    from casaflow.plans.cleaning import clean_wide
    from casaflow.sources.wide_csv import scan_wide
    out = None
    for g in scan_wide(spark, _hv_csv_files(spark, sf_dir), n_ids=8):
        cleaned = clean_wide(g).withColumn("home_tier", tier_from_path("file"))
        cols = [(c, header_date(c), i) for i, c in enumerate(g.measure_cols)]
        long = unpivot_wide(cleaned, ["RegionName", "home_tier"], cols, "house_value")
        out = long if out is None else out.unionByName(long)
    return _round(out.select(F.col("RegionName").alias("region_name"), "home_tier",
                             "metric_date", "house_value"), ["house_value"])


def _date_texts(spark, sf_dir):
    o = TD.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate",
                                                 "o_totalprice", "o_orderpriority")
    kind = F.col("o_orderkey") % 3
    text = (F.when(kind == 0, F.date_format("o_orderdate", "M/d/yyyy"))
            .when(kind == 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
            .otherwise(F.concat(F.lit("Q"), F.quarter("o_orderdate").cast("string"),
                                F.lit(" "), F.year("o_orderdate").cast("string"))))
    return o.withColumn("date_text", text)


@register
def parse_dates(spark, sf_dir):
    """Text dates in two formats (and unparseable text) -> date or null."""
    o = _date_texts(spark, sf_dir)
    return o.select("o_orderkey", "date_text",
                    parse_date_multi("date_text").alias("metric_date"))


@register
def snake_case_columns(spark, sf_dir):
    """CamelCase source names -> snake_case landing names."""
    ri = _landings(spark, sf_dir)["rental_income"]
    camel = ri.select(
        F.col("region_id").alias("RegionID"), F.col("size_rank").alias("SizeRank"),
        F.col("region_name").alias("RegionName"), F.col("region_type").alias("RegionType"),
        F.col("state_name").alias("StateName"), F.col("state").alias("State"),
        F.col("city").alias("City"), F.col("metro").alias("Metro"),
        F.col("county_name").alias("CountyName"), F.col("metric_date").alias("MetricDate"),
        amt("rental_income").alias("RentalIncome"))
    return rename_snake(camel)


@register
def home_tier_classify(spark, sf_dir):
    o = TD.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    f = TD.synthetic_file_name(F.col("o_orderpriority"))
    return o.select("o_orderkey", f.alias("source_file"),
                    tier_from_path(f).alias("home_tier"))


def _padded_names(spark, sf_dir):
    c = TD.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    k = F.col("c_custkey") % 4
    pad = (F.when(k == 0, F.concat(F.lit("  "), "c_name", F.lit("\t")))
           .when(k == 1, F.concat(F.lit("\u00a0"), "c_name", F.lit("\u3000")))
           .when(k == 2, F.col("c_name"))
           .otherwise(F.concat(F.lit("\t "), "c_name", F.lit(" \n"))))
    return c.withColumn("padded", pad)


@register
def trim_strings(spark, sf_dir):
    c = _padded_names(spark, sf_dir)
    return c.select("c_custkey", "padded", trim_all("padded").alias("trimmed"))


@register
def legacy_house_value(spark, sf_dir):
    return _round(_legacy_hv(_landings(spark, sf_dir)["house_value"]), ["avg_house_value"])


# --- keyed merges and constraints --------------------------------------------

def _hv_rows(lands, aliases):
    hv = lands["house_value"].where(F.col("metro").isNotNull())
    return hv.select(replace_values("metro", aliases).alias("metro"), "state", "county_name")


def _mp_ri_rows(lands, aliases):
    s = F.lit(None).cast("string")
    mp = (lands["monthly_payment"].where(F.col("region_name").isNotNull())
          .select(replace_values("region_name", aliases).alias("metro"),
                  F.col("state_name").alias("state"), s.alias("county_name")))
    ri = (lands["rental_income"].where(F.col("metro").isNotNull())
          .select(replace_values("metro", aliases).alias("metro"),
                  F.col("state_name").alias("state"), "county_name"))
    return mp.unionByName(ri)


def _first_per_metro(rows):
    return distinct_on(rows, "metro", [("county_name", True), ("state", True)],
                       ["state", "county_name"])


@register
def dim_upsert(spark, sf_dir):
    """Existing dimension from house values, incoming metros from payment and
    rent: new metros inserted, state overwritten, county coalesced."""
    from casaflow.schemas import DIM_GEOGRAPHY, empty
    lands = _landings(spark, sf_dir)
    existing = upsert_dim_rows(empty(spark, DIM_GEOGRAPHY),
                               _first_per_metro(_hv_rows(lands, TD.TEST_ALIASES)))
    incoming = _first_per_metro(_mp_ri_rows(lands, TD.TEST_ALIASES))
    merged = upsert_dim_rows(existing, incoming, with_action=True)
    return merged.select("metro", "state", "county_name", "merge_action")


@register
def fact_upsert(spark, sf_dir):
    """House-value fact: first load up to 1998, second load from 1998 on."""
    from casaflow.operators.facts import fact_average
    lands, dim = _landings(spark, sf_dir), _dim(spark, sf_dir)
    hv = lands["house_value"]
    old = fact_average(hv.where(F.col("metric_date") < F.lit(SPLIT_OLD).cast("date")),
                       dim, "house_value", "avg_house_value")
    new = fact_average(hv.where(F.col("metric_date") >= F.lit(SPLIT_NEW).cast("date")),
                       dim, "house_value", "avg_house_value")
    old = old.withColumns({"inserted_at": F.current_timestamp(),
                           "updated_at": F.current_timestamp()})
    merged = upsert_fact(old, new, "house_value", with_action=True)
    return _round(with_metro(merged, dim).select("metro", "metric_date", "year",
                                                 "avg_house_value", "merge_action"),
                  ["avg_house_value"])


@register
def legacy_upsert(spark, sf_dir):
    """Legacy rent final keyed by (region_id, metric_date), two loads."""
    ri = _landings(spark, sf_dir)["rental_income"]
    old = _legacy_ri(ri.where(F.col("metric_date") < F.lit(SPLIT_OLD).cast("date")))
    old = old.withColumn("inserted_at", F.current_timestamp())
    new = _legacy_ri(ri.where(F.col("metric_date") >= F.lit(SPLIT_NEW).cast("date")))
    merged = upsert_legacy(old, new, "rental_income", touch_updated=False, with_action=True)
    return _round(merged.select("region_id", "metric_date", "region_name", "metro",
                                "rental_income", "year", "merge_action"), ["rental_income"])


@register
def duplicate_keys(spark, sf_dir):
    """Payment rows colliding on (metro, month) once metros are aliased."""
    mp = _landings(spark, sf_dir)["monthly_payment"]
    keyed = mp.select(replace_values("region_name", TD.TEST_ALIASES).alias("metro"),
                      "metric_date")
    return _dups(keyed, ["metro", "metric_date"])


@register
def orphan_fact_keys(spark, sf_dir):
    """Payment fact rows whose key is missing from a dimension without the
    test state (the foreign-key check)."""
    _, dim, facts = _star(spark, sf_dir)
    partial = dim.where(F.col("state") != TD.TEST_STATE)
    orphans = orphan_keys(facts["monthly_payment"], partial, "geo_key")
    return with_metro(orphans, dim).select("metro", "metric_date")


# --- files: lake, CSV end to end, rejects -------------------------------------

@register
def lake_partition_counts(spark, sf_dir):
    """Landing written as a (state, year)-partitioned lake, read back, counted."""
    from casaflow.session import scratch_path
    from casaflow.sinks.writers import write_lake
    path = scratch_path(spark, "lake-house-value")
    write_lake(_landings(spark, sf_dir)["house_value"], path, ("state", "year"))
    lake = spark.read.parquet(path)
    return (lake.groupBy("state", "year")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.countDistinct("metro").alias("n_metros")))


@functools.lru_cache(maxsize=32)
def _hv_csv_files(spark, sf_dir):
    """The wide CSV input of the landing job, written once per session from
    the test tables (one file family per tier, two header date spellings)."""
    from casaflow.sources.csv_fixture import write_house_value_csvs
    return write_house_value_csvs(spark, _landing_all(spark, sf_dir))


@register
def csv_landing_house_value(spark, sf_dir):
    """End to end through files: the landing job over wide house-value CSVs
    (header groups, header-date parsing, cut-off pruning, unpivot, tier from
    the path, null drop, snake_case names)."""
    from casaflow.plans.landing import land
    from casaflow.schemas import HOUSE_VALUE
    import dataclasses
    pattern = _hv_csv_files(spark, sf_dir)
    spec = dataclasses.replace(HOUSE_VALUE, min_date=TD.TEST_CUTOFF)
    out = land(spark, spec, pattern)
    return _round(out.drop("inserted_at"), ["house_value"])


@register
def reject_report(spark, sf_dir):
    """Text cells made from orders (three date spellings, amounts with a
    currency sign for one priority) counted per synthetic source file."""
    o = _date_texts(spark, sf_dir)
    raw = F.when(F.substring("o_orderpriority", 1, 1) == "5",
                 F.concat(F.lit("$"), F.col("o_totalprice").cast("string"))
                 ).otherwise(F.col("o_totalprice").cast("string"))
    cells = o.select(TD.synthetic_file_name(F.col("o_orderpriority")).alias("source_file"),
                     raw.alias("raw"), raw.try_cast("double").alias("value"),
                     parse_date_multi("date_text").alias("metric_date"))
    return _reject_report(cells)


@functools.lru_cache(maxsize=8)
def _dirty_families(spark, sf_dir):
    """(family, tier, id names, folder, months) of wide CSVs with faults."""
    from casaflow.session import scratch_path
    from casaflow.sources import csv_fixture as X
    lands, root = _landings(spark, sf_dir), scratch_path(spark, "dirty-csv")
    hv = _landing_all(spark, sf_dir)
    jobs = [("house_value", t, X.HV_SOURCE_NAMES, hv.where(F.col("home_tier") == t)) for t in X.TIER_FILES]
    jobs += [("monthly_payment", None, X.MP_SOURCE_NAMES, lands["monthly_payment"]),
             ("rental_income", None, X.RI_SOURCE_NAMES, lands["rental_income"])]
    out = []
    for family, tier, names, landing in jobs:
        name = f"raw_{family}_{tier or 'all'}.csv"
        out.append((family, tier, tuple(names.items()), name, tuple(X.write_dirty_csvs(landing, names, family, f"{root}/{name}"))))
    return root, out


@register
def clean_files_roundtrip(spark, sf_dir):
    """The cleaning job run twice into one target over dirty wide CSVs of all
    three families (padded ids, N/A metros, doubled quotes, malformed cells),
    read back and reported with every identifier."""
    from casaflow.plans.cleaning import clean_files
    from casaflow.session import scratch_path
    raw, families = _dirty_families(spark, sf_dir)
    target = scratch_path(spark, "cleaned-csv")
    configured = [(len(names), name, f"cleaned_{name}") for _, _, names, name, _ in families]
    for _ in range(2):
        clean_files(spark, raw, target, configured)
    out = None
    for family, tier, names, name, months in families:
        back = spark.read.option("header", True).option("escape", '"').csv(f"{target}/cleaned_{name}")
        ids = {c: F.col(h) for c, h in names}
        ids |= {c: ids[c].cast("int") for c in ("region_id", "size_rank")}
        flat = back.select(*[ids.get(c, F.lit(None).cast("string")).alias(c) for c in HV_IDS[:-1]], *[f"`{m}`" for m in months])
        long = unpivot_wide(flat, HV_IDS[:-1], [(str(m), m, i) for i, m in enumerate(months)], "value").select(
            F.lit(family).alias("family"), F.lit(tier).cast("string").alias("home_tier"), *HV_IDS[:-1], "metric_date",
            amt(F.col("value").cast("double")).alias("value"))
        out = long if out is None else out.unionByName(long)
    return out


# --- the other two facts and finals -------------------------------------------

def _fact_upsert_of(name):
    from casaflow.operators.facts import fact_average
    from casaflow.plans.final import FACT_SPECS
    measure, out, metro_col, aliased = FACT_SPECS[name]

    def q(spark, sf_dir):
        lands, dim = _landings(spark, sf_dir), _dim(spark, sf_dir)
        aliases = TD.TEST_ALIASES if aliased else None
        part = lambda cond: fact_average(lands[name].where(cond), dim, measure, out, metro_col, aliases)
        old = part(F.col("metric_date") < F.lit(SPLIT_OLD).cast("date"))
        old = old.withColumns({"inserted_at": F.current_timestamp(), "updated_at": F.current_timestamp()})
        merged = upsert_fact(old, part(F.col("metric_date") >= F.lit(SPLIT_NEW).cast("date")), name, with_action=True)
        return _round(with_metro(merged, dim).select("metro", "metric_date", "year", out, "merge_action"), [out])
    q.__name__ = f"fact_upsert_{name}"
    return q


def _orphans_of(name):
    def q(spark, sf_dir):
        _, dim, facts = _star(spark, sf_dir)
        orphans = orphan_keys(facts[name], dim.where(F.col("state") != TD.TEST_STATE), "geo_key")
        return with_metro(orphans, dim).select("metro", "metric_date")
    q.__name__ = f"orphan_{name}_keys"
    return q


def _legacy_upsert_of(name, build, measure):
    def q(spark, sf_dir):
        land = _landings(spark, sf_dir)[name]
        old = build(land.where(F.col("metric_date") < F.lit(SPLIT_OLD).cast("date"))).withColumn("inserted_at", F.current_timestamp())
        new = build(land.where(F.col("metric_date") >= F.lit(SPLIT_NEW).cast("date")))
        merged = upsert_legacy(old, new, measure, touch_updated=False, with_action=True)
        return _round(merged.select("region_id", "metric_date", "metro", measure, "year", "merge_action"), [measure])
    q.__name__ = f"legacy_upsert_{name}"
    return q


def _legacy_mp(land):
    from casaflow.operators.facts import legacy_monthly_payment
    return legacy_monthly_payment(land)


for _q in (_fact_upsert_of("monthly_payment"), _fact_upsert_of("rental_income"), _orphans_of("house_value"),
           _orphans_of("rental_income"), _legacy_upsert_of("house_value", _legacy_hv, "avg_house_value"),
           _legacy_upsert_of("monthly_payment", _legacy_mp, "monthly_payment")):
    register(_q)


@register
def surrogate_keys(spark, sf_dir):
    """Keys of the dimension after a second load: unique, never null and
    unchanged for every metro of the first load."""
    dim = _dim(spark, sf_dir)
    second = upsert_dim_rows(dim, _first_per_metro(_mp_ri_rows(_landings(spark, sf_dir), TD.TEST_ALIASES)))
    both = second.select("metro", F.col("geo_key").alias("k2")).join(dim.select("metro", "geo_key"), "metro", "full")
    per_key = both.groupBy("k2").agg(F.count(F.lit(1)).alias("n_metros"), F.min("metro").alias("metro"),
                                     F.max((F.col("k2") == F.col("geo_key")).cast("int")).alias("same"))
    return per_key.select("metro", "n_metros", (F.col("same") == 1).alias("key_kept"))


@register
def published_tables(spark, sf_dir):
    """Two publications of the facts, the second one left without its marker:
    readers keep seeing the first."""
    from casaflow.session import scratch_path
    from casaflow.sinks.publish import Publication, publish, read_current
    _, dim, facts = _star(spark, sf_dir)
    root = scratch_path(spark, "published")
    publish(spark, root, {"dim_geography": dim, **{f"fact_{k}": v for k, v in facts.items()}}, "0001")
    Publication(spark, root, "0002").write("dim_geography", dim.where("false"))       # never committed
    names = ["dim_geography", *[f"fact_{k}" for k in facts]]
    counts = [t.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
              for n, t in read_current(spark, root, names).items()]
    return functools.reduce(DataFrame.unionByName, counts)


# --- the whole job over dirty files ---------------------------------------------

@functools.lru_cache(maxsize=8)
def _job(spark, sf_dir):
    """(configuration, version): the batch job run over the dirty wide files of
    all three families: cleaned, landed with rejects, merged, published; the feeds
    exported. A first load is already published, so the facts and finals are
    merged with it."""
    import dataclasses

    from casaflow.plans.orchestrate import PipelineConfig, run
    from casaflow.schemas import LANDING_SPECS
    from casaflow.session import scratch_path
    raw, families = _dirty_families(spark, sf_dir)
    cuts = {"house_value": TD.TEST_CUTOFF}
    specs = {k: dataclasses.replace(s, file_glob=f"raw_{k}_*.csv", min_date=cuts.get(k)) for k, s in LANDING_SPECS.items()}
    store = scratch_path(spark, "job-store")
    cfg = PipelineConfig(raw, store, cleaned_dir=f"{store}-cleaned", aliases=dict(TD.TEST_ALIASES), state=TD.TEST_STATE,
                         feeds_dir=f"{store}-feeds", specs=specs,
                         cleaning_files=tuple((len(names), name, f"cleaned_{name}") for _, _, names, name, _ in families))
    run(spark, dataclasses.replace(cfg, cleaned_dir=None, feeds_dir=None))
    return cfg, run(spark, cfg)


def _job_tables(spark, sf_dir, *names):
    from casaflow.sinks.publish import read_current
    cfg, version = _job(spark, sf_dir)
    tables = read_current(spark, cfg.store_root, list(names), version)
    return [tables[n] for n in names]


def _file_name(col="source_file"):
    """The input's name: the folder of the part files."""
    return F.regexp_extract(col, r"([^/]+)/[^/]+$", 1)


@register
def job_landing_files(spark, sf_dir):
    """The report that the landing job wrote for each input of every family."""
    from casaflow.schemas import LANDING_SPECS
    parts = _job_tables(spark, sf_dir, *[f"files_{k}" for k in LANDING_SPECS])
    counts = ("n_rows", "n_cells", "n_landed", "n_bad_value", "n_bad_date", "n_bad_id")
    return (functools.reduce(DataFrame.unionByName, parts).groupBy("family", _file_name().alias("input"))
            .agg(*[F.sum(c).alias(c) for c in counts]))


@register
def job_landing_rejects(spark, sf_dir):
    """Every cell that the landing job rejected."""
    from casaflow.schemas import LANDING_SPECS
    parts = _job_tables(spark, sf_dir, *[f"rejects_{k}" for k in LANDING_SPECS])
    return functools.reduce(DataFrame.unionByName, parts).select(
        "family", _file_name().alias("input"), "region_id", "region_name", "date_str", "raw", "reason")


@register
def job_cleaning_report(spark, sf_dir):
    """What the cleaning job counted while it wrote."""
    return _job_tables(spark, sf_dir, "files_cleaned")[0]


def _job_landing(name):
    def q(spark, sf_dir):
        out = _job_tables(spark, sf_dir, f"lnd_{name}")[0]
        return _round(out.withColumn("stamped", F.col("inserted_at").isNotNull()).drop("inserted_at"), [name])
    q.__name__ = f"job_landing_{name}"
    return q


for _name in ("house_value", "monthly_payment", "rental_income"):
    register(_job_landing(_name))


@register
def job_dimension(spark, sf_dir):
    dim = _job_tables(spark, sf_dir, "dim_geography")[0]
    return dim.select("metro", "state", "county_name", (F.col("updated_at") >= F.col("inserted_at")).alias("stamped"))


@register
def job_facts(spark, sf_dir):
    """The three published facts with their metros."""
    from casaflow.schemas import FACT_MEASURES
    dim, *facts = _job_tables(spark, sf_dir, "dim_geography", *[f"fact_{k}" for k in FACT_MEASURES])
    parts = [with_metro(f, dim).select(F.lit(k).alias("fact"), "metro", "metric_date", "year", amt(m).alias("amount"),
                                       (F.col("updated_at") >= F.col("inserted_at")).alias("stamped"))
             for (k, m), f in zip(FACT_MEASURES.items(), facts)]
    return functools.reduce(DataFrame.unionByName, parts)


@register
def job_finals(spark, sf_dir):
    """The three published denormalised finals."""
    measures = {"house_value": "avg_house_value", "monthly_payment": "monthly_payment", "rental_income": "rental_income"}
    parts = [t.select(F.lit(k).alias("final"), "region_id", "metro", "state", "metric_date", "year", amt(m).alias("amount"))
             for (k, m), t in zip(measures.items(), _job_tables(spark, sf_dir, *measures))]
    return functools.reduce(DataFrame.unionByName, parts)


@register
def job_table_keys(spark, sf_dir):
    """Rows and different keys of every published table."""
    from casaflow.plans.final import CONSTRAINTS
    parts = []
    for name, t in zip(CONSTRAINTS, _job_tables(spark, sf_dir, *CONSTRAINTS)):
        for keys in CONSTRAINTS[name][0]:
            parts.append(t.agg(F.lit(name).alias("table_name"), F.lit(",".join(keys)).alias("key"), F.count(F.lit(1)).alias("n_rows"),
                               F.countDistinct(*keys).alias("n_keys")))
    return functools.reduce(DataFrame.unionByName, parts)


@register
def job_stored_panel(spark, sf_dir):
    """The state's panel that the job stored for the version it published."""
    from casaflow.plans.dashboard import stored_panel
    cfg, version = _job(spark, sf_dir)
    return _round(stored_panel(spark, cfg.store_root, cfg.state, version), PANEL_AMOUNTS, PANEL_RATIOS)


@register
def job_partition_counts(spark, sf_dir):
    """Landing partitions of the state and of years from 1997 on, by family."""
    from casaflow.schemas import LANDING_SPECS
    names = list(LANDING_SPECS)
    parts = []
    for k, t in zip(names, _job_tables(spark, sf_dir, *[LANDING_SPECS[k].table for k in names])):
        state = LANDING_SPECS[k].partition_cols[0]
        parts.append(t.where((F.col(state) == TD.TEST_STATE) & (F.col("year") >= 1997)).groupBy("year")
                     .agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(k).alias("family"), "year", "n_rows"))
    return functools.reduce(DataFrame.unionByName, parts)


@register
def partition_upsert(spark, sf_dir):
    """All three facts published up to 1998, then merged by year with a batch of
    the months from 1998 on whose amounts are one higher: the years before 1998
    are taken over from the first version's files."""
    from casaflow.plans.final import FACT_KEYS, publish_by_year, upsert_fact
    from casaflow.schemas import FACT_MEASURES, FACT_SCHEMAS
    from casaflow.session import scratch_path
    from casaflow.sinks.publish import Publication, manifest, read_current
    _, dim, facts = _star(spark, sf_dir)
    root = scratch_path(spark, "by-year")
    loads = ((F.col("metric_date") < F.lit(SPLIT_OLD).cast("date"), 0.0), (F.col("metric_date") >= F.lit(SPLIT_NEW).cast("date"), 1.0))
    for i, (months, more) in enumerate(loads, 1):
        old = manifest(spark, root, f"{i - 1:04d}") if i > 1 else {}
        pub = Publication(spark, root, f"{i:04d}")
        for k, m in FACT_MEASURES.items():
            publish_by_year(pub, f"fact_{k}", facts[k].where(months).withColumn(m, F.col(m) + more), old.get(f"fact_{k}"),
                            FACT_SCHEMAS[k], FACT_KEYS, lambda e, b, k=k: upsert_fact(e, b, k))
        pub.commit()
    parts = [with_metro(t, dim).select(F.lit(k).alias("fact"), "metro", "metric_date", "year", amt(FACT_MEASURES[k]).alias("amount"))
             for k, t in zip(FACT_MEASURES, read_current(spark, root, [f"fact_{k}" for k in FACT_MEASURES]).values())]
    return functools.reduce(DataFrame.unionByName, parts)


@register
def alias_table_fact(spark, sf_dir):
    """Order prices averaged by nation and month: the orders name customers, and
    an alias table as long as the customer table says which nation two thirds
    of them stand for (the others have no metro in the dimension)."""
    from casaflow.operators.facts import fact_average
    o = TD.table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = TD.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = TD.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_name").alias("region_name"), F.last_day(F.col("o_orderdate").cast("date")).alias("metric_date"), F.col("o_totalprice").alias("price"))
    aliases = (c.where(F.col("c_custkey") % 3 != 0).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
               .select(F.col("c_name").alias("name"), F.col("n_name").alias("alias")))
    dim = _dim(spark, sf_dir)
    return _round(with_metro(fact_average(rows, dim, "price", "avg_price", "region_name", aliases), dim), ["avg_price"])


# --- row order -------------------------------------------------------------------

def _numbered(ordered: DataFrame) -> DataFrame:
    """The place of each row of an ordered (small) table as it comes out."""
    return ordered.coalesce(1).withColumn("place", F.monotonically_increasing_id())


@register
def panel_order(spark, sf_dir):
    panel = _panel(spark, sf_dir, None).select("metro", "metric_month")
    return _numbered(P.order_panel(panel))


@register
def raw_table_order(spark, sf_dir):
    return _numbered(P.raw_combined_table(_selected(spark, sf_dir)).select("metro", "metric_month"))
