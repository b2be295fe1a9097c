"""Table schemas, landing specifications and fixed values.

The fixed values below must equal the source pipeline's for results to match;
they are stated plainly and together.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values (must match the source pipeline)
# --------------------------------------------------------------------------
HOUSE_VALUE_ID_COLS = ("RegionID", "SizeRank", "RegionName", "RegionType",
                       "StateName", "State", "Metro", "CountyName")
MONTHLY_PAYMENT_ID_COLS = ("RegionID", "SizeRank", "RegionName", "RegionType",
                           "StateName")
RENTAL_INCOME_ID_COLS = ("RegionID", "SizeRank", "RegionName", "RegionType",
                         "StateName", "State", "City", "Metro", "CountyName")
HOUSE_VALUE_GLOB = "*zhvi*.csv"
MONTHLY_PAYMENT_GLOB = "*total_monthly_payment*.csv"
RENTAL_INCOME_GLOB = "*zori*.csv"
HOUSE_VALUE_CUTOFF = dt.date(2011, 12, 31)          # keep metric_date > cut-off
HEADER_DATE_FORMATS = ("M/d/yyyy", "yyyy-MM-dd")     # first that parses wins
# file-name substring -> home tier, first match wins, else "unknown"
TIER_PATTERNS = (("0.0_0.33", "bottom"), ("0.33_0.67", "medium"),
                 ("0.67_1.0", "top"))
TIER_UNKNOWN = "unknown"
METRO_ALIASES = {"Seattle, WA": "Seattle-Tacoma-Bellevue, WA"}
DEFAULT_STATE = "WA"
PREFERRED_METROS = ("Seattle", "Spokane", "Tacoma")
DEFAULT_METRO_COUNT = 3
VALUE_VS_RENT_LABELS = {"avg_house_value": "House Value",
                        "rental_income": "Monthly Rent"}
RENT_VS_MORTGAGE_LABELS = {"rental_income": "Rent Income",
                           "monthly_payment": "Mortgage Payment"}
# cleaning job inputs: (identifier count, raw file, cleaned file)
CLEANING_FILES = (
    (8, "raw_City_zhvi_uc_sfrcondo_tier_0.0_0.33_sm_sa_month.csv",
     "cleaned_City_zhvi_uc_sfrcondo_tier_0.0_0.33_sm_sa_month.csv"),
    (8, "raw_City_zhvi_uc_sfrcondo_tier_0.33_0.67_sm_sa_month.csv",
     "cleaned_City_zhvi_uc_sfrcondo_tier_0.33_0.67_sm_sa_month.csv"),
    (8, "raw_City_zhvi_uc_sfrcondo_tier_0.67_1.0_sm_sa_month.csv",
     "cleaned_City_zhvi_uc_sfrcondo_tier_0.67_1.0_sm_sa_month.csv"),
    (5, "raw_Metro_total_monthly_payment_downpayment_0.20_uc_sfrcondo_tier_0.33_0.67_sm_sa_month.csv",
     "cleaned_Metro_total_monthly_payment_downpayment.csv"),
    (9, "raw_Zip_zori_uc_sfrcondomfr_sm_sa_month.csv", "cleaned_Zip_zori.csv"),
)

# pandas' default missing-value tokens (public pandas documentation); the
# cleaning path treats these as null, the raw landing path only the empty cell.
PANDAS_NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN",
                    "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
                    "NULL", "NaN", "None", "n/a", "nan", "null")

# identifier columns that are integers in the source files; all others text
INT_ID_COLS = ("RegionID", "SizeRank")


@dataclass(frozen=True)
class LandingSpec:
    """One wide-file family and how it lands (one job instead of three copies)."""

    name: str                       # measure name, e.g. "house_value"
    table: str                      # landing table name
    file_glob: str
    id_cols: tuple[str, ...]
    min_date: dt.date | None = None  # exclusive cut-off on metric_date
    with_tier: bool = False          # derive home_tier from the file name
    partition_cols: tuple[str, ...] = ("state", "year")
    extra: dict = field(default_factory=dict)


HOUSE_VALUE = LandingSpec("house_value", "lnd_house_value", HOUSE_VALUE_GLOB,
                          HOUSE_VALUE_ID_COLS, HOUSE_VALUE_CUTOFF, True,
                          ("state", "year"))
MONTHLY_PAYMENT = LandingSpec("monthly_payment", "lnd_monthly_payment",
                              MONTHLY_PAYMENT_GLOB, MONTHLY_PAYMENT_ID_COLS,
                              None, False, ("state_name", "year"))
RENTAL_INCOME = LandingSpec("rental_income", "lnd_rental_income",
                            RENTAL_INCOME_GLOB, RENTAL_INCOME_ID_COLS,
                            None, False, ("state", "year"))
LANDING_SPECS = {s.name: s for s in (HOUSE_VALUE, MONTHLY_PAYMENT, RENTAL_INCOME)}


def _fields(spec: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in spec])


TS = T.TimestampType()
#: Why a cell was rejected: text that is no number, or a number under a header that is no date.
BAD_VALUE, BAD_DATE = "bad_value", "bad_date"
REJECTS = _fields([("family", T.StringType()), ("source_file", T.StringType()), ("region_id", T.IntegerType()),
                   ("region_name", T.StringType()), ("date_str", T.StringType()), ("raw", T.StringType()), ("reason", T.StringType())])
FILE_REPORT = _fields([("family", T.StringType()), ("source_file", T.StringType()), ("n_rows", T.LongType()), ("n_cells", T.LongType()),
                       ("n_landed", T.LongType()), ("n_bad_value", T.LongType()), ("n_bad_date", T.LongType()), ("n_bad_id", T.LongType())])
CLEANING_REPORT = _fields([("input", T.StringType()), ("output", T.StringType()), ("n_rows", T.LongType()), ("n_cells", T.LongType()),
                           ("n_bad_value", T.LongType()), ("n_bad_date", T.LongType()), ("n_bad_id", T.LongType())])
DIM_GEOGRAPHY = _fields([
    ("geo_key", T.LongType()), ("metro", T.StringType()), ("state", T.StringType()),
    ("county_name", T.StringType()), ("inserted_at", TS), ("updated_at", TS)])


def fact_schema(measure: str) -> T.StructType:
    return _fields([
        ("geo_key", T.LongType()), (measure, T.DoubleType()),
        ("metric_date", T.DateType()), ("year", T.IntegerType()),
        ("inserted_at", TS), ("updated_at", TS)])


FACT_MEASURES = {"house_value": "avg_house_value",
                 "monthly_payment": "monthly_payment",
                 "rental_income": "rental_income"}
FACT_SCHEMAS = {k: fact_schema(v) for k, v in FACT_MEASURES.items()}

LEGACY_HOUSE_VALUE = _fields([
    ("region_id", T.IntegerType()), ("size_rank", T.IntegerType()),
    ("region_name", T.StringType()), ("region_type", T.StringType()),
    ("state", T.StringType()), ("metro", T.StringType()),
    ("county_name", T.StringType()), ("avg_house_value", T.DoubleType()),
    ("metric_date", T.DateType()), ("year", T.IntegerType()),
    ("inserted_at", TS), ("updated_at", TS)])
LEGACY_MONTHLY_PAYMENT = _fields([
    ("region_id", T.IntegerType()), ("size_rank", T.IntegerType()),
    ("metro", T.StringType()), ("region_type", T.StringType()),
    ("state", T.StringType()), ("monthly_payment", T.DoubleType()),
    ("metric_date", T.DateType()), ("year", T.IntegerType()), ("inserted_at", TS)])
LEGACY_RENTAL_INCOME = _fields([
    ("region_id", T.IntegerType()), ("size_rank", T.IntegerType()),
    ("region_name", T.StringType()), ("region_type", T.StringType()),
    ("state", T.StringType()), ("city", T.StringType()), ("metro", T.StringType()),
    ("county_name", T.StringType()), ("rental_income", T.DoubleType()),
    ("metric_date", T.DateType()), ("year", T.IntegerType()), ("inserted_at", TS)])


def empty(spark, schema: T.StructType):
    """An empty table of ``schema`` — the state of a table that does not exist yet.

    Built as a false filter so the optimizer sees an empty relation and folds
    joins and unions against it away (a first load's merge is then a plain
    projection of the incoming batch).
    """
    from pyspark.sql import functions as F
    cols = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).select(*cols).where(F.lit(False))
