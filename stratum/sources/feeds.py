"""Raw feed definitions and batch readers.

Every raw feed is CSV with a header and is read as text: typing happens in
silver, where bad values become null instead of failing the load. Rows
that do not fit the declared columns (too many or too few tokens) keep
their original line in ``_rescued_data``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

RESCUE_COLUMN = "_rescued_data"

# Column layout of the six source-system extracts.
FEED_COLUMNS: dict[str, tuple[str, ...]] = {
    "cust_info": ("cst_id", "cst_key", "cst_firstname", "cst_lastname", "cst_marital_status",
                  "cst_gndr", "cst_create_date"),
    "prd_info": ("prd_id", "prd_key", "prd_nm", "prd_cost", "prd_line", "prd_start_dt",
                 "prd_end_dt"),
    "sales_details": ("sls_ord_num", "sls_prd_key", "sls_cust_id", "sls_order_dt", "sls_ship_dt",
                      "sls_due_dt", "sls_sales", "sls_quantity", "sls_price"),
    "cust_az12": ("CID", "BDATE", "GEN"),
    "loc_a101": ("CID", "CNTRY"),
    "px_cat_g1v2": ("ID", "CAT", "SUBCAT", "MAINTENANCE"),
}

# Source system each feed comes from (folder layout raw/<system>/<feed>).
FEED_SYSTEM = {"cust_info": "crm", "prd_info": "crm", "sales_details": "crm",
               "cust_az12": "erp", "loc_a101": "erp", "px_cat_g1v2": "erp"}


def feed_schema(feed: str, rescue: bool = True) -> StructType:
    fields = [StructField(c, StringType(), True) for c in FEED_COLUMNS[feed]]
    if rescue:
        fields.append(StructField(RESCUE_COLUMN, StringType(), True))
    return StructType(fields)


# Marker used as the CSV null token. With Spark's default (the empty string)
# a quoted empty field ``""`` would also turn into null; with a marker that
# never occurs, ``""`` stays an empty string and only an unquoted empty field
# is null, so bronze keeps the difference the silver rules rely on.
NULL_MARKER = "\u0000"


def csv_options(rescue: bool = True) -> dict[str, str]:
    opts = {"header": "true", "mode": "PERMISSIVE", "enforceSchema": "true",
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
            "nullValue": NULL_MARKER}
    if rescue:
        opts["columnNameOfCorruptRecord"] = RESCUE_COLUMN
    return opts


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given benchmark tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
