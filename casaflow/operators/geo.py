"""Geography dimension: candidate union, metro alias, distinct-on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casaflow.functions import replace_values
from casaflow.schemas import METRO_ALIASES


#: Aliases that are written as a CASE; more of them are joined.
CASE_LIMIT = 100


def joined(aliases) -> bool:
    """Whether ``with_alias`` joins these aliases."""
    return isinstance(aliases, DataFrame) or len(aliases or ()) > CASE_LIMIT


def with_alias(df: DataFrame, col: str, aliases, out: str) -> DataFrame:
    """``df`` with ``out``: the alias of ``col``, or the name itself where there
    is none. ``aliases`` is a dict or a table (name, alias): a short dict becomes a
    CASE in generated code, anything else a left join, which Spark broadcasts if
    the table is small. Null names and aliases are left alone; of several aliases
    for one name the smallest counts."""
    if not joined(aliases):
        return df.withColumn(out, replace_values(col, aliases or {}))
    if isinstance(aliases, dict):
        aliases = df.sparkSession.createDataFrame(list(aliases.items()), "name string, alias string")
    table = (aliases.where(F.col("name").isNotNull()).groupBy(F.col("name").alias("_name"))
             .agg(F.min("alias").alias("_alias")))
    found = df.join(table, F.col(col) == F.col("_name"), "left")
    return found.withColumn(out, F.coalesce("_alias", col)).drop("_name", "_alias")


def geo_candidates(house_value: DataFrame, monthly_payment: DataFrame,
                   rental_income: DataFrame, aliases=METRO_ALIASES,
                   distinct: bool = True) -> DataFrame:
    """(metro, state, county_name) from the three landing tables, metros aliased.

    Payment rows name the metro in ``region_name`` and carry no county; the
    others use ``metro``. ``distinct`` gives UNION (not UNION ALL) semantics;
    each branch is de-duplicated map-side first by the partial aggregate.
    """
    s = F.lit(None).cast("string")
    hv = house_value.select("metro", "state", "county_name")
    mp = monthly_payment.select(F.col("region_name").alias("metro"), F.col("state_name").alias("state"), s.alias("county_name"))
    ri = rental_income.select("metro", F.col("state_name").alias("state"), "county_name")
    out = hv.unionByName(mp).unionByName(ri).where(F.col("metro").isNotNull())
    if joined(aliases):
        out = out.distinct()        # a join sees each combination once
    out = with_alias(out, "metro", aliases, "metro")
    return out.distinct() if distinct else out


def distinct_on(df: DataFrame, key: str | list[str],
                order: list[tuple[str, bool]], payload: list[str],
                collation: str | None = None) -> DataFrame:
    """First row per ``key`` under ``order`` ((column, nulls_last) ascending).

    String order is binary unless ``collation`` names a Spark collation (e.g.
    ``"UNICODE"``, ``"UNICODE_CI"``) for the order columns; payload values
    are returned as stored.

    Written as ``min(struct(sort keys..., payload...))`` per key: a plain
    aggregate, so it combines map-side and never gathers a key's rows into one
    task. Payload columns after the sort keys break any remaining tie, making
    the result deterministic.

    A string-valued ``min`` runs as a sort aggregate, so the rows are first
    reduced by a hash aggregate on every referenced column (which keeps a row
    count, carried into the struct so the optimizer cannot drop the
    de-duplication as redundant). The sort then only sees distinct
    combinations, typically orders of magnitude fewer rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    used = list(dict.fromkeys([*keys, *[c for c, _ in order], *payload]))
    df = df.groupBy(*used).agg(F.count(F.lit(1)).alias("_rows"))
    fields: list[Column] = []
    for i, (c, nulls_last) in enumerate(order):
        if nulls_last:
            fields.append(F.col(c).isNull().alias(f"_n{i}"))
        else:
            fields.append(F.col(c).isNotNull().alias(f"_n{i}"))
        oc = F.col(c)
        if collation and dict(df.dtypes).get(c) == "string":
            oc = F.collate(oc, collation)
        fields.append(oc.alias(f"_o{i}"))
    for j, c in enumerate(payload):
        fields.append(F.col(c).alias(f"_p{j}"))
    fields.append(F.col("_rows"))
    best = F.min(F.struct(*fields)).alias("_best")
    return (df.groupBy(*keys).agg(best)
            .select(*keys, *[F.col(f"_best._p{j}").alias(c) for j, c in enumerate(payload)]))


def dim_rows(house_value: DataFrame, monthly_payment: DataFrame,
             rental_income: DataFrame, aliases=METRO_ALIASES,
             collation: str | None = None) -> DataFrame:
    """One row per metro: smallest county (nulls last), then state (nulls last)."""
    cand = geo_candidates(house_value, monthly_payment, rental_income, aliases,
                          distinct=False)
    return distinct_on(cand, "metro",
                       [("county_name", True), ("state", True)],
                       ["state", "county_name"], collation)
