"""Landing -> final star schema: dimension upsert, three fact upserts,
constraint checks, all-or-nothing publication.

``load_final`` and ``load_legacy`` give whole merged frames. The job publishes by
year instead (``publish_final``, ``publish_legacy``): a batch is merged with the
years it has, and all other years of the published table are taken over by name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casaflow.operators.facts import (fact_average, legacy_house_value,
                                      legacy_monthly_payment, legacy_rental_income)
from casaflow.operators.geo import dim_rows
from casaflow.operators.merge import (COALESCE, KEEP, SET, STAMP_INSERT, TOUCH,
                                      assert_no_orphans, assert_unique, keyed_merge,
                                      surrogate_key)
from casaflow.session import materialize
from casaflow.sinks.publish import Publication, read_entry
from casaflow.schemas import (DIM_GEOGRAPHY, FACT_MEASURES, FACT_SCHEMAS,
                              LEGACY_HOUSE_VALUE, LEGACY_MONTHLY_PAYMENT,
                              LEGACY_RENTAL_INCOME, METRO_ALIASES, empty)

DIM_RULES = {"state": SET, "county_name": COALESCE, "geo_key": KEEP,
             "inserted_at": STAMP_INSERT, "updated_at": TOUCH}
FACT_KEYS = ["geo_key", "metric_date"]
LEGACY_KEYS = ["region_id", "metric_date"]


def fact_rules(measure: str) -> dict[str, str]:
    return {measure: SET, "year": KEEP, "inserted_at": STAMP_INSERT,
            "updated_at": TOUCH}


def upsert_dim(existing: DataFrame, landings: dict[str, DataFrame],
               aliases=METRO_ALIASES, now: Column | None = None,
               with_action: bool = False, collation: str | None = None) -> DataFrame:
    """Insert new metros, update matched ones (state overwritten even by null,
    county only by a non-null value); keys of existing metros never change and
    new metros get a stable hash key."""
    incoming = dim_rows(landings["house_value"], landings["monthly_payment"],
                        landings["rental_income"], aliases, collation)
    return upsert_dim_rows(existing, incoming, now, with_action)


def upsert_dim_rows(existing: DataFrame, incoming: DataFrame,
                    now: Column | None = None, with_action: bool = False) -> DataFrame:
    """Merge one-row-per-metro ``incoming`` (metro, state, county_name)."""
    merged = keyed_merge(existing, incoming, ["metro"], DIM_RULES, now, with_action)
    return merged.withColumn("geo_key", F.coalesce("geo_key", surrogate_key("metro")))


def build_dim(spark: SparkSession, landings: dict[str, DataFrame],
              aliases=METRO_ALIASES) -> DataFrame:
    """A dimension built from scratch (first load)."""
    return upsert_dim(empty(spark, DIM_GEOGRAPHY), landings, aliases)


# fact name -> (landing measure, fact measure, landing metro column, aliased?)
FACT_SPECS = {
    "house_value": ("house_value", "avg_house_value", "metro", False),
    "monthly_payment": ("monthly_payment", "monthly_payment", "region_name", True),
    "rental_income": ("rental_income", "rental_income", "metro", True),
}


def batch_fact(landings: dict[str, DataFrame], dim: DataFrame, name: str,
               aliases=METRO_ALIASES, alias_house_value: bool = False) -> DataFrame:
    """One averaged fact batch. House value joins the raw metro name unless
    ``alias_house_value`` (the source pipeline does not alias it, so aliased
    house-value rows find no dimension row)."""
    measure, out, metro_col, aliased = FACT_SPECS[name]
    use_aliases = aliases if (aliased or alias_house_value) else None
    return fact_average(landings[name], dim, measure, out, metro_col, use_aliases)


def batch_facts(landings: dict[str, DataFrame], dim: DataFrame,
                aliases=METRO_ALIASES, alias_house_value: bool = False) -> dict[str, DataFrame]:
    """The three averaged fact batches."""
    return {name: batch_fact(landings, dim, name, aliases, alias_house_value)
            for name in FACT_SPECS}


def upsert_fact(existing: DataFrame, batch: DataFrame, name: str,
                now: Column | None = None, with_action: bool = False) -> DataFrame:
    """Star facts have whole keys: rows without a date (from a header that is no
    date) stay in the landing and its reject report."""
    return keyed_merge(existing, batch.dropna(subset=FACT_KEYS), FACT_KEYS, fact_rules(FACT_MEASURES[name]),
                       now, with_action)


def upsert_legacy(existing: DataFrame, batch: DataFrame, measure: str,
                  touch_updated: bool, now: Column | None = None,
                  with_action: bool = False) -> DataFrame:
    rules = {measure: SET, "inserted_at": STAMP_INSERT}
    if "updated_at" in existing.columns:
        rules["updated_at"] = TOUCH if touch_updated else KEEP
    return keyed_merge(existing, batch.dropna(subset=LEGACY_KEYS), LEGACY_KEYS, rules, now, with_action)


@dataclass
class FinalTables:
    dim: DataFrame
    facts: dict[str, DataFrame]

    def tables(self) -> dict[str, DataFrame]:
        return {"dim_geography": self.dim,
                **{f"fact_{k}": v for k, v in self.facts.items()}}


def load_final(spark: SparkSession, landings: dict[str, DataFrame],
               current: dict[str, DataFrame] | None = None, aliases=METRO_ALIASES,
               alias_house_value: bool = False, check: bool = True,
               collation: str | None = None) -> FinalTables:
    """Dimension upsert, then three fact upserts that read the new dimension.

    The dimension is written to the shared scratch folder: it feeds three
    joins, whose strategy Spark picks by its size in bytes, and a lost executor
    re-reads it instead of recomputing the landing union. Batches are checked for duplicate keys and every fact
    key for a dimension row before anything is returned for publication.
    """
    current = current or {}
    now = F.current_timestamp()
    dim_old = current.get("dim_geography", empty(spark, DIM_GEOGRAPHY))
    dim = materialize(upsert_dim(dim_old, landings, aliases, now, collation=collation), "dim-geography")
    if check:
        assert_unique(dim, ["metro"], "dim_geography")
        assert_unique(dim, ["geo_key"], "dim_geography")
    batches = batch_facts(landings, dim, aliases, alias_house_value)
    facts = {}
    for name, batch in batches.items():
        if check:
            assert_unique(batch, FACT_KEYS, f"fact_{name} batch")
        old = current.get(f"fact_{name}", empty(spark, FACT_SCHEMAS[name]))
        facts[name] = upsert_fact(old, batch, name, now)
        if check:
            assert_no_orphans(facts[name], dim, "geo_key", f"fact_{name}")
    return FinalTables(dim, facts)


LEGACY_SPECS = {
    "house_value": (legacy_house_value, LEGACY_HOUSE_VALUE, "avg_house_value", True),
    "monthly_payment": (legacy_monthly_payment, LEGACY_MONTHLY_PAYMENT, "monthly_payment", False),
    "rental_income": (legacy_rental_income, LEGACY_RENTAL_INCOME, "rental_income", False),
}


def load_legacy(spark: SparkSession, landings: dict[str, DataFrame],
                current: dict[str, DataFrame] | None = None,
                check: bool = True) -> dict[str, DataFrame]:
    """Denormalised finals keyed by (region_id, metric_date); only house value
    is pre-aggregated and touches ``updated_at``."""
    current = current or {}
    now = F.current_timestamp()
    out = {}
    for name, (build, schema, measure, touch) in LEGACY_SPECS.items():
        batch = build(landings[name])
        if check:
            assert_unique(batch, LEGACY_KEYS, f"{name} batch")
        old = current.get(name, empty(spark, schema))
        out[name] = upsert_legacy(old, batch, measure, touch, now)
    return out


# table -> (unique keys..., foreign key to the dimension or None)
CONSTRAINTS = {
    "dim_geography": ([["metro"], ["geo_key"]], None),
    "fact_house_value": ([FACT_KEYS], "geo_key"),
    "fact_monthly_payment": ([FACT_KEYS], "geo_key"),
    "fact_rental_income": ([FACT_KEYS], "geo_key"),
    "house_value": ([LEGACY_KEYS], None),
    "monthly_payment": ([LEGACY_KEYS], None),
    "rental_income": ([LEGACY_KEYS], None),
}


def check_tables(tables: dict[str, DataFrame]) -> None:
    """Uniqueness and reference checks on *written* tables (cheap scans of
    materialised data), before a version is published. A duplicate key in an
    incoming batch shows up here as a duplicate key of the merged table."""
    dim = tables.get("dim_geography")
    for name, df in tables.items():
        uniques, fk = CONSTRAINTS.get(name, ([], None))
        for keys in uniques:
            assert_unique(df, keys, name)
        if fk and dim is not None:
            assert_no_orphans(df, dim, fk, name)


YEAR = "year"


def publish_by_year(pub: Publication, name: str, batch: DataFrame, old: dict | None, schema, keys: list[str], merge) -> DataFrame:
    """Merge a stored batch into a published table (its manifest entry ``old``,
    or None) and write only the years the batch has; the table's other years are
    carried over unread. Returns what was written here.

    A key's date gives its year, so a batch row's partner can lie in no other
    year, and keys stay unique in the table if they are in the written years:
    these are checked, the others are not read. Rows without a whole key have no
    partner and are left out by the merge. A table published without partitions
    is read whole once and partitioned from then on.
    """
    spark = pub.spark
    if pub.done(name) is None:
        years = sorted(r[0] for r in batch.select(YEAR).where(F.col(YEAR).isNotNull()).distinct().collect())     # calendar years
        existing, carried = empty(spark, schema), {}
        if old is not None:
            existing = read_entry(spark, pub.root, old)
            if all(parts is not None for parts in old["folders"].values()):
                existing = existing.where(F.col(YEAR).isin(years))
                carried = {folder: [p for p in parts if p not in {f"{YEAR}={y}" for y in years}] for folder, parts in old["folders"].items()}
        pub.write(name, merge(existing, batch), (YEAR,), carried)
    here = pub.written(name)
    assert_unique(here, keys, name)
    return here


def publish_final(spark: SparkSession, pub: Publication, landings: dict[str, DataFrame], old: dict[str, dict], aliases=METRO_ALIASES,
                  alias_house_value: bool = False, collation: str | None = None) -> None:
    """The dimension, then the three facts, merged into the published tables
    (manifest entries ``old``) and checked: keys of the years written, and their
    references; years carried over refer to metros that never leave the dimension."""
    now = F.current_timestamp()
    if pub.done("dim_geography") is None:
        before = read_entry(spark, pub.root, old["dim_geography"]) if "dim_geography" in old else empty(spark, DIM_GEOGRAPHY)
        pub.write("dim_geography", upsert_dim(before, landings, aliases, now, collation=collation))
    dim = pub.read("dim_geography")
    assert_unique(dim, ["metro"], "dim_geography")
    assert_unique(dim, ["geo_key"], "dim_geography")
    for kind in FACT_SPECS:
        name = f"fact_{kind}"
        batch = None if pub.done(name) else materialize(
            batch_fact(landings, dim, kind, aliases, alias_house_value), f"batch-{kind}")
        here = publish_by_year(pub, name, batch, old.get(name), FACT_SCHEMAS[kind], FACT_KEYS,
                               lambda existing, b, kind=kind: upsert_fact(existing, b, kind, now))
        assert_no_orphans(here, dim, "geo_key", name)


def publish_legacy(spark: SparkSession, pub: Publication, landings: dict[str, DataFrame], old: dict[str, dict]) -> None:
    """The denormalised finals, merged by year like the facts."""
    now = F.current_timestamp()
    for name, (build, schema, measure, touch) in LEGACY_SPECS.items():
        batch = None if pub.done(name) else materialize(build(landings[name]), f"batch-legacy-{name}")
        publish_by_year(pub, name, batch, old.get(name), schema, LEGACY_KEYS,
                        lambda existing, b, m=measure, t=touch: upsert_legacy(existing, b, m, t, now))
