"""Silver layer: one cleansing job per raw feed (bronze DataFrame -> silver
DataFrame).

Each builder is a pure function of its input plus an explicit ``as_of``
date, so reruns give the same rows. ``audit`` names the load-timestamp
column (None switches it off). The rescued-data column of bronze is
dropped when present.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions import codes, dates, keys, numbers
from stratum.operators import dedup, versions
from stratum.operators.shape import fill_strings, move_column, with_audit
from stratum.sources.feeds import RESCUE_COLUMN

# Key pattern accepted for CRM customers, and the token removed
# from ERP customer ids.
CRM_CUSTOMER_KEY_PATTERN = r"^AW\d+$"
ERP_ID_NOISE = "NAS"


def latest_customers(bronze: DataFrame) -> DataFrame:
    """Newest raw row per raw ``cst_id`` by create date (then every other column
    as tie-breaker). Applied to rows it has picked before together with new ones,
    it picks as from all rows at once."""
    return dedup.keep_latest(bronze.drop(RESCUE_COLUMN), "cst_id", "cst_create_date")


def shape_customers(latest: DataFrame, audit: str | None = "DWH_create_date", keep: Sequence[str] = ()) -> DataFrame:
    """Typed id, accepted keys only, trimmed names, labelled marital status and
    gender, parsed create date; ``keep`` names further columns to pass on.

    The key filter comes after the de-duplication on purpose: a customer
    whose newest row carries a bad key is dropped, as in the source.
    """
    out = (latest
           .withColumn("cst_id", numbers.tolerant_cast("cst_id", "int"))
           .filter(F.col("cst_key").rlike(CRM_CUSTOMER_KEY_PATTERN))
           .withColumns({
               "cst_firstname": F.trim("cst_firstname"),
               "cst_lastname": F.trim("cst_lastname"),
               "cst_marital_status": codes.map_codes("cst_marital_status", codes.MARITAL_STATUS_MAP),
               "cst_gndr": codes.map_codes("cst_gndr", codes.CRM_GENDER_MAP),
               "cst_create_date": dates.parse_date("cst_create_date", dates.ISO_DATE),
               "newDateUpdate": F.lit(1),  # the rank of the row that was kept
           }))
    out = out.select("cst_id", "cst_key", "cst_firstname", "cst_lastname", "cst_marital_status",
                     "cst_gndr", "cst_create_date", "newDateUpdate", *keep)
    return with_audit(out, audit)


def clean_cust_info(bronze: DataFrame, audit: str | None = "DWH_create_date") -> DataFrame:
    """The latest row of each customer, cleansed."""
    return shape_customers(latest_customers(bronze), audit)


def product_versions(bronze: DataFrame) -> DataFrame:
    """Category id from the first two key parts, product key from the rest,
    cost with 0 for missing, labelled product line, start date: one row at a time."""
    df = bronze.drop(RESCUE_COLUMN)
    out = df.withColumns({
        "prd_id": numbers.tolerant_cast("prd_id", "int"),
        "cat_id": keys.head_parts("prd_key", 2, "-", "_"),
        "prd_key": keys.tail_parts("prd_key", 2, "-", "-"),
        "prd_cost": F.coalesce(numbers.tolerant_cast("prd_cost", "int"), F.lit(0)),
        "prd_line": codes.map_codes("prd_line", codes.PRODUCT_LINE_MAP),
        "prd_start_dt": dates.parse_date("prd_start_dt", dates.ISO_DATE),
    })
    return out.select("prd_id", "cat_id", "prd_key", "prd_nm", "prd_cost", "prd_line", "prd_start_dt")


def end_versions(found: DataFrame, as_of=None, audit: str | None = "DWH_update_date", keep: Sequence[str] = ()) -> DataFrame:
    """Versions with an end date at the next version's start (open versions end at
    ``as_of``). ``found`` holds all versions of each key that it holds."""
    out = versions.version_end(found, "prd_key", "prd_start_dt", "prd_end_dt", open_value=dates.as_of_date(as_of))
    out = out.select("prd_id", "cat_id", "prd_key", "prd_nm", "prd_cost", "prd_line",
                     "prd_start_dt", "prd_end_dt", *keep)
    return move_column(with_audit(out, audit), "cat_id", "prd_id")


def clean_prd_info(bronze: DataFrame, as_of=None,
                   audit: str | None = "DWH_update_date") -> DataFrame:
    """Product versions, each ended by the next one of its key."""
    return end_versions(product_versions(bronze), as_of, audit)


SALES_DATE_COLUMNS = ("sls_order_dt", "sls_ship_dt", "sls_due_dt")


def clean_sales_details(bronze: DataFrame, rule: str = "ratio",
                        audit: str | None = "DWH_update_date") -> DataFrame:
    """Typed customer id, repaired amount / quantity / price and three
    ``yyyyMMdd`` dates guarded against malformed codes."""
    df = bronze.drop(RESCUE_COLUMN)
    out = df.withColumns({
        "sls_cust_id": numbers.tolerant_cast("sls_cust_id", "int"),
        **numbers.repair_sales_columns("sls_sales", "sls_quantity", "sls_price", rule),
        **{c: dates.guarded_compact_date(c) for c in SALES_DATE_COLUMNS},
    })
    out = out.select("sls_ord_num", "sls_prd_key", "sls_cust_id", *SALES_DATE_COLUMNS,
                     "sls_sales", "sls_quantity", "sls_price")
    return with_audit(out, audit)


def clean_cust_az12(bronze: DataFrame, as_of=None, fill_all: bool = False,
                    audit: str | None = "DWH_create_date") -> DataFrame:
    """ERP customers: id without the noise token, birth dates not later than
    ``as_of``, labelled gender. ``fill_all`` also writes ``Unknown`` into
    every other null text column, as the notebook variant does."""
    df = bronze.drop(RESCUE_COLUMN)
    out = df.select(
        F.regexp_replace(F.col("CID"), ERP_ID_NOISE, "").alias("cid"),
        dates.cap_future_date("BDATE", as_of).alias("bdate"),
        codes.map_codes("GEN", codes.ERP_GENDER_MAP).alias("gen"),
    )
    if fill_all:
        out = fill_strings(out, codes.UNKNOWN)
    return with_audit(out, audit)


def clean_loc_a101(bronze: DataFrame, fill_all: bool = False,
                   audit: str | None = "DWH_create_date") -> DataFrame:
    """ERP locations: id without dashes and outer spaces, country labels."""
    df = bronze.drop(RESCUE_COLUMN)
    out = df.select(
        keys.strip_pattern("CID", "-", trim=True).alias("cid"),
        codes.map_country("CNTRY").alias("cntry"),
    )
    if fill_all:
        out = fill_strings(out, codes.UNKNOWN)
    return with_audit(out, audit)


def clean_px_cat(bronze: DataFrame, audit: str | None = "DWH_update_date") -> DataFrame:
    """Category reference: column names only (``ID`` -> ``id``,
    ``MAINTENANCE`` -> ``maintenance``; ``CAT`` and ``SUBCAT`` keep their
    case and resolve case-insensitively downstream)."""
    df = bronze.drop(RESCUE_COLUMN)
    out = df.withColumnsRenamed({"ID": "id", "CAT_ID": "cat_id", "CAT_NM": "cat_nm",
                                 "MAINTENANCE": "maintenance"})
    return with_audit(out, audit)


SILVER_BUILDERS = {
    "cust_info": clean_cust_info,
    "prd_info": clean_prd_info,
    "sales_details": clean_sales_details,
    "cust_az12": clean_cust_az12,
    "loc_a101": clean_loc_a101,
    "px_cat_g1v2": clean_px_cat,
}
