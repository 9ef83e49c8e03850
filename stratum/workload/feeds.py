"""Raw CRM / ERP feeds derived from the benchmark tables.

The source system ships no data, so each raw feed is derived, at full
table size, from the given TPC-H-like tables with deliberate dirt (padded
text, unmapped codes, malformed numbers and dates, missing matches). The
same SQL text runs unchanged in Spark SQL and in DuckDB, so the Spark jobs
and the SQL oracle start from identical text rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from stratum.sources.feeds import driver_table

FEED_SQL: dict[str, str] = {
    "cust_info": """
SELECT cast(o_custkey AS string) AS cst_id,
       CASE WHEN o_custkey % 17 = 0 THEN 'BAD-' || cast(o_custkey AS string)
            ELSE 'AW' || lpad(cast(o_custkey AS string), 8, '0') END AS cst_key,
       '  ' || c_name || ' ' AS cst_firstname,
       c_mktsegment || ' ' AS cst_lastname,
       CASE o_orderkey % 4 WHEN 0 THEN ' m' WHEN 1 THEN 'S' WHEN 3 THEN 'x' END AS cst_marital_status,
       CASE o_orderkey % 5 WHEN 0 THEN 'f ' WHEN 1 THEN 'M' WHEN 3 THEN '' WHEN 4 THEN 'n' END AS cst_gndr,
       cast(cast(o_orderdate AS date) AS string) AS cst_create_date
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "prd_info": """
SELECT cast(p_partkey AS string) AS prd_id,
       CASE WHEN p_partkey % 101 = 0 THEN 'AC-HE'
            ELSE substr(p_type, 1, 2) || '-' || substr(p_type, 3, 2) || '-P'
                 || lpad(cast(cast(floor(p_partkey / 2) AS bigint) AS string), 7, '0') || '-X' END AS prd_key,
       p_name AS prd_nm,
       CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN 'n/a'
            ELSE cast(cast(floor(p_retailprice) AS int) AS string) END AS prd_cost,
       CASE p_size % 6 WHEN 0 THEN 'r' WHEN 1 THEN 'S ' WHEN 2 THEN ' M' WHEN 3 THEN 'T' WHEN 4 THEN 'q' END AS prd_line,
       cast(date '2000-01-01' + cast(p_partkey % 3000 AS int) AS string) AS prd_start_dt
FROM part""",
    "sales_details": """
SELECT 'SO' || cast(l_orderkey AS string) AS sls_ord_num,
       CASE WHEN l_partkey % 53 = 0 THEN 'NONE'
            ELSE 'P' || lpad(cast(cast(floor(l_partkey / 2) AS bigint) AS string), 7, '0') || '-X' END AS sls_prd_key,
       CASE WHEN l_orderkey % 19 = 0 THEN 'x' ELSE cast(o_custkey AS string) END AS sls_cust_id,
       CASE WHEN l_orderkey % 11 = 0 THEN '0' WHEN l_orderkey % 23 = 0 THEN '5489'
            ELSE replace(cast(cast(o_orderdate AS date) AS string), '-', '') END AS sls_order_dt,
       replace(cast(cast(l_shipdate AS date) AS string), '-', '') AS sls_ship_dt,
       CASE WHEN l_orderkey % 37 = 0 THEN '20101399' WHEN l_orderkey % 41 = 0 THEN NULL
            ELSE replace(cast(cast(l_shipdate AS date) AS string), '-', '') END AS sls_due_dt,
       CASE l_partkey % 9 WHEN 0 THEN NULL
            WHEN 1 THEN cast(-cast(l_quantity AS int) * (l_partkey % 100 + 1) AS string) WHEN 2 THEN '0'
            WHEN 3 THEN cast(2 * cast(l_quantity AS int) * (l_partkey % 100 + 1) AS string) WHEN 4 THEN 'n/a'
            ELSE cast(cast(l_quantity AS int) * (l_partkey % 100 + 1) AS string) END AS sls_sales,
       CASE WHEN l_orderkey % 29 = 0 THEN '0' WHEN l_orderkey % 31 = 0 THEN 'x' WHEN l_orderkey % 43 = 0 THEN NULL
            WHEN l_orderkey % 47 = 0 THEN cast(-cast(l_quantity AS int) AS string)
            ELSE cast(cast(l_quantity AS int) AS string) END AS sls_quantity,
       CASE l_suppkey % 8 WHEN 0 THEN NULL WHEN 1 THEN cast(-(l_partkey % 100 + 1) AS string)
            WHEN 2 THEN cast(l_partkey % 100 + 1 AS string) || '.5' ELSE cast(l_partkey % 100 + 1 AS string) END AS sls_price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "cust_az12": """
SELECT CASE WHEN c_custkey % 2 = 0 THEN 'NAS' ELSE '' END || CASE WHEN c_custkey % 10 = 7 THEN 'ZZ' ELSE 'AW' END || lpad(cast(c_custkey AS string), 8, '0') AS CID,
       CASE WHEN c_custkey % 13 = 0 THEN '2100-01-01' WHEN c_custkey % 29 = 0 THEN 'bad'
            ELSE cast(date '1950-01-01' + cast((c_custkey * 23) % 18000 AS int) AS string) END AS BDATE,
       CASE c_custkey % 6 WHEN 0 THEN 'M' WHEN 1 THEN 'F ' WHEN 2 THEN 'female' WHEN 3 THEN ' Male' WHEN 4 THEN '  ' END AS GEN
FROM customer""",
    "loc_a101": """
SELECT CASE WHEN c_custkey % 10 = 3 THEN ' ZZ-' ELSE ' AW-' END || lpad(cast(c_custkey AS string), 8, '0') AS CID,
       CASE c_custkey % 7 WHEN 0 THEN 'DE' WHEN 1 THEN ' us' WHEN 2 THEN 'USA' WHEN 3 THEN ' ' WHEN 4 THEN 'France '
            WHEN 5 THEN 'Australia' END AS CNTRY
FROM customer""",
    "px_cat_g1v2": """
SELECT DISTINCT CASE WHEN p_type = 'LARGE' THEN 'none' ELSE substr(p_type, 1, 2) || '_' || substr(p_type, 3, 2) END AS ID, p_type AS CAT,
       p_type || ' parts' AS SUBCAT,
       CASE WHEN p_type IN ('SMALL', 'PROMO') THEN 'No' ELSE 'Yes' END AS MAINTENANCE
FROM part""",
}

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Tables each derived feed reads.
FEED_TABLES = {
    "cust_info": ("orders", "customer"),
    "prd_info": ("part",),
    "sales_details": ("lineitem", "orders"),
    "cust_az12": ("customer",),
    "loc_a101": ("customer",),
    "px_cat_g1v2": ("part",),
}


def raw_feed(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """Derived raw feed (all text columns) read from the tables in ``sf_dir``.

    The tables are passed to ``spark.sql`` as DataFrame arguments, so no
    session-wide temporary view is created or replaced."""
    names = FEED_TABLES[feed]
    pattern = re.compile(r"\b(FROM|JOIN)\s+(" + "|".join(names) + r")\b")
    sql = pattern.sub(lambda m: f"{m.group(1)} {{{m.group(2)}}}", FEED_SQL[feed])
    return spark.sql(sql, **{n: driver_table(spark, sf_dir, n) for n in names})


def feed_cte(*feeds: str) -> str:
    """``WITH`` prefix defining the named feeds for the SQL oracle."""
    return "WITH " + ",\n".join(f"{f} AS ({FEED_SQL[f]})" for f in feeds) + "\n"
