"""DuckDB SQL oracle for every registered query.

Written independently of the Spark code (plain SQL over the same derived
feeds): correlated sub-queries for version end dates, a global
``row_number`` for dense keys, ``NOT IN`` for upserts. DuckDB sorts
ascending nulls last, so Spark's default (nulls first) is spelled out.
Integer types are cast to match Spark's (``row_number`` in the silver rank
column is ``int``; surrogate keys are ``bigint``).
"""

from __future__ import annotations

from stratum.workload.feeds import feed_cte

AS_OF_SQL = "DATE '2024-06-30'"

SILVER_CUST_INFO = r"""
silver_cust_info AS (
  SELECT TRY_CAST(cst_id AS INTEGER) AS cst_id, cst_key,
         trim(cst_firstname) AS cst_firstname, trim(cst_lastname) AS cst_lastname,
         COALESCE(CASE trim(upper(cst_marital_status)) WHEN 'M' THEN 'Married' WHEN 'S' THEN 'Single'
                  ELSE trim(upper(cst_marital_status)) END, 'Unknown') AS cst_marital_status,
         COALESCE(CASE trim(upper(cst_gndr)) WHEN 'F' THEN 'Female' WHEN 'M' THEN 'Male'
                  ELSE trim(upper(cst_gndr)) END, 'Unknown') AS cst_gndr,
         CAST(try_strptime(cst_create_date, '%Y-%m-%d') AS DATE) AS cst_create_date,
         CAST(rn AS INTEGER) AS newDateUpdate
  FROM (SELECT *, row_number() OVER (
            PARTITION BY cst_id
            ORDER BY cst_create_date DESC NULLS LAST, cst_key ASC NULLS FIRST,
                     cst_firstname ASC NULLS FIRST, cst_lastname ASC NULLS FIRST,
                     cst_marital_status ASC NULLS FIRST, cst_gndr ASC NULLS FIRST) AS rn
        FROM cust_info) ranked
  WHERE rn = 1 AND regexp_matches(cst_key, '^AW\d+$'))"""

SILVER_PRD_INFO = f"""
prd_typed AS (
  SELECT TRY_CAST(prd_id AS INTEGER) AS prd_id,
         concat_ws('_', string_split(prd_key, '-')[1], string_split(prd_key, '-')[2]) AS cat_id,
         COALESCE(array_to_string(list_slice(string_split(prd_key, '-'), 3,
                                             len(string_split(prd_key, '-'))), '-'), '') AS prd_key,
         prd_nm,
         COALESCE(TRY_CAST(prd_cost AS INTEGER), 0) AS prd_cost,
         COALESCE(CASE trim(upper(prd_line)) WHEN 'R' THEN 'Road' WHEN 'S' THEN 'Other Sales'
                  WHEN 'M' THEN 'Mountain' WHEN 'T' THEN 'Touring' ELSE trim(upper(prd_line)) END,
                  'Unknown') AS prd_line,
         CAST(try_strptime(prd_start_dt, '%Y-%m-%d') AS DATE) AS prd_start_dt
  FROM prd_info),
silver_prd_info AS (
  SELECT p.prd_id, p.cat_id, p.prd_key, p.prd_nm, p.prd_cost, p.prd_line, p.prd_start_dt,
         COALESCE(CASE WHEN p.prd_start_dt IS NULL
                       THEN (SELECT min(q.prd_start_dt) FROM prd_typed q
                             WHERE q.prd_key IS NOT DISTINCT FROM p.prd_key)
                       ELSE (SELECT min(q.prd_start_dt) FROM prd_typed q
                             WHERE q.prd_key IS NOT DISTINCT FROM p.prd_key
                               AND q.prd_start_dt > p.prd_start_dt) END,
                  {AS_OF_SQL}) AS prd_end_dt
  FROM prd_typed p)"""


def _compact_date(c: str) -> str:
    return (f"CASE WHEN length({c}) = 8 AND TRY_CAST({c} AS BIGINT) > 0 "
            f"THEN CAST(try_strptime({c}, '%Y%m%d') AS DATE) END")


SILVER_SALES = f"""
sales_typed AS (
  SELECT sls_ord_num, sls_prd_key, TRY_CAST(sls_cust_id AS INTEGER) AS sls_cust_id,
         {_compact_date('sls_order_dt')} AS sls_order_dt,
         {_compact_date('sls_ship_dt')} AS sls_ship_dt,
         {_compact_date('sls_due_dt')} AS sls_due_dt,
         CAST(TRY_CAST(sls_sales AS FLOAT) AS DOUBLE) AS s,
         TRY_CAST(sls_quantity AS DOUBLE) AS qd,
         TRY_CAST(sls_quantity AS FLOAT) AS qf,
         TRY_CAST(sls_price AS DOUBLE) AS p
  FROM sales_details),
sales_amount AS (
  SELECT *, CASE WHEN s IS NULL OR s <= 0 OR s <> qd * abs(s / NULLIF(qd, 0))
                 THEN qd * abs(p) ELSE s END AS amount
  FROM sales_typed),
sales_price AS (
  SELECT *, amount / NULLIF(CAST(qf AS DOUBLE), 0) AS ratio,
         CASE WHEN (p IS NULL OR p <= 0) AND qf <> 0
              THEN amount / NULLIF(CAST(qf AS DOUBLE), 0) ELSE p END AS p1
  FROM sales_amount),
silver_sales_details AS (
  SELECT sls_ord_num, sls_prd_key, sls_cust_id, sls_order_dt, sls_ship_dt, sls_due_dt,
         amount AS sls_sales, qf AS sls_quantity,
         CASE WHEN ratio <> p1 THEN ratio ELSE p1 END AS sls_price
  FROM sales_price)"""

SILVER_CUST_AZ12 = f"""
silver_cust_az12 AS (
  SELECT regexp_replace(CID, 'NAS', '', 'g') AS cid,
         CASE WHEN TRY_CAST(BDATE AS DATE) <= {AS_OF_SQL} THEN TRY_CAST(BDATE AS DATE) END AS bdate,
         COALESCE(CASE trim(upper(GEN)) WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female'
                  WHEN 'FEMALE' THEN 'Female' WHEN 'MALE' THEN 'Male' WHEN '' THEN 'Unknown'
                  ELSE trim(upper(GEN)) END, 'Unknown') AS gen
  FROM cust_az12)"""

SILVER_LOC_A101 = """
silver_loc_a101 AS (
  SELECT trim(replace(CID, '-', '')) AS cid,
         COALESCE(CASE WHEN trim(upper(CNTRY)) = '' THEN 'Unknown'
                       WHEN trim(upper(CNTRY)) = 'DE' THEN 'Germany'
                       WHEN trim(upper(CNTRY)) IN ('US', 'USA') THEN 'United States'
                       ELSE CNTRY END, 'Unknown') AS cntry
  FROM loc_a101)"""

SILVER_PX_CAT = """
silver_px_cat AS (SELECT ID AS id, CAT, SUBCAT, MAINTENANCE AS maintenance FROM px_cat_g1v2)"""

DIM_CUSTOMERS = """
dim_customers AS (
  SELECT CAST(row_number() OVER (ORDER BY customer_id NULLS FIRST) AS BIGINT) AS customer_sk,
         customer_id, customer_number, first_name, last_name, country, marital_status, gender,
         birth_date, created_date
  FROM (SELECT *, row_number() OVER (
            PARTITION BY customer_id
            ORDER BY created_date DESC NULLS LAST, customer_number NULLS FIRST,
                     first_name NULLS FIRST, last_name NULLS FIRST, country NULLS FIRST,
                     marital_status NULLS FIRST, gender NULLS FIRST, birth_date NULLS FIRST) AS rn
        FROM (SELECT ci.cst_id AS customer_id, ci.cst_key AS customer_number,
                     ci.cst_firstname AS first_name, ci.cst_lastname AS last_name,
                     la.cntry AS country, ci.cst_marital_status AS marital_status,
                     CASE WHEN ci.cst_gndr <> 'Unknown' THEN ci.cst_gndr
                          ELSE COALESCE(ca.gen, 'Unknown') END AS gender,
                     ca.bdate AS birth_date, ci.cst_create_date AS created_date
              FROM silver_cust_info ci
              LEFT JOIN silver_cust_az12 ca ON ci.cst_key = ca.cid
              LEFT JOIN silver_loc_a101 la ON ci.cst_key = la.cid) j) d
  WHERE rn = 1)"""

DIM_PRODUCTS = """
dim_products AS (
  SELECT CAST(row_number() OVER (
             ORDER BY start_date NULLS FIRST, product_number NULLS FIRST, product_id NULLS FIRST,
                      product_name NULLS FIRST, category_id NULLS FIRST, cost NULLS FIRST,
                      product_line NULLS FIRST) AS BIGINT) AS product_sk, *
  FROM (SELECT pn.prd_id AS product_id, pn.prd_key AS product_number, pn.prd_nm AS product_name,
               pn.cat_id AS category_id, pc.CAT AS category, pc.SUBCAT AS subcategory,
               pc.maintenance AS maintenance, pn.prd_cost AS cost, pn.prd_line AS product_line,
               pn.prd_start_dt AS start_date
        FROM silver_prd_info pn LEFT JOIN silver_px_cat pc ON pn.cat_id = pc.id) j)"""


def _with(feeds: tuple[str, ...], *ctes: str) -> str:
    prefix = feed_cte(*feeds).rstrip("\n")
    return prefix + "".join("," + c for c in ctes) + "\n"


CUSTOMER_FEEDS = ("cust_info", "cust_az12", "loc_a101")
PRODUCT_FEEDS = ("prd_info", "px_cat_g1v2")

ORACLE_SQL: dict[str, str] = {
    "keep_latest": """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (
      PARTITION BY user_id
      ORDER BY ts DESC NULLS LAST, event_id ASC NULLS FIRST, event_type ASC NULLS FIRST,
               value ASC NULLS FIRST, props ASC NULLS FIRST) AS rn
  FROM events) t WHERE rn = 1""",

    "keep_any_deterministic": """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) t
WHERE rn = 1""",

    "regex_filter": feed_cte("cust_info") + r"""
SELECT cst_id, cst_key, cst_create_date FROM cust_info WHERE regexp_matches(cst_key, '^AW\d+$')""",

    "map_codes_fill": feed_cte("cust_info") + """
SELECT cst_id, cst_key, cst_create_date,
       COALESCE(CASE trim(upper(cst_marital_status)) WHEN 'M' THEN 'Married' WHEN 'S' THEN 'Single'
                ELSE trim(upper(cst_marital_status)) END, 'Unknown') AS cst_marital_status,
       COALESCE(CASE trim(upper(cst_gndr)) WHEN 'F' THEN 'Female' WHEN 'M' THEN 'Male'
                ELSE trim(upper(cst_gndr)) END, 'Unknown') AS cst_gndr
FROM cust_info""",

    "fill_all_strings": feed_cte("loc_a101") + """
SELECT COALESCE(CID, 'Unknown') AS CID, COALESCE(CNTRY, 'Unknown') AS CNTRY FROM loc_a101""",

    "multi_branch_map": feed_cte("loc_a101") + """
SELECT CID, COALESCE(CASE WHEN trim(upper(CNTRY)) = '' THEN 'Unknown'
                          WHEN trim(upper(CNTRY)) = 'DE' THEN 'Germany'
                          WHEN trim(upper(CNTRY)) IN ('US', 'USA') THEN 'United States'
                          ELSE CNTRY END, 'Unknown') AS cntry
FROM loc_a101""",

    "split_key_parts": feed_cte("prd_info") + """
SELECT prd_id,
       concat_ws('_', string_split(prd_key, '-')[1], string_split(prd_key, '-')[2]) AS cat_id,
       COALESCE(array_to_string(list_slice(string_split(prd_key, '-'), 3,
                                           len(string_split(prd_key, '-'))), '-'), '') AS prd_key
FROM prd_info""",

    "strip_tokens": feed_cte("cust_az12") + """
SELECT CID, regexp_replace(CID, 'NAS', '', 'g') AS cid_clean FROM cust_az12""",

    "guarded_dates": feed_cte("sales_details") + f"""
SELECT sls_ord_num, sls_prd_key,
       {_compact_date('sls_order_dt')} AS sls_order_dt,
       {_compact_date('sls_ship_dt')} AS sls_ship_dt,
       {_compact_date('sls_due_dt')} AS sls_due_dt
FROM sales_details""",

    "tolerant_casts": feed_cte("sales_details") + """
SELECT sls_ord_num, TRY_CAST(sls_cust_id AS INTEGER) AS sls_cust_id,
       TRY_CAST(sls_sales AS FLOAT) AS sls_sales, TRY_CAST(sls_quantity AS FLOAT) AS sls_quantity,
       TRY_CAST(sls_price AS DOUBLE) AS sls_price
FROM sales_details""",

    "cap_future_date": feed_cte("cust_az12") + f"""
SELECT CID, CASE WHEN TRY_CAST(BDATE AS DATE) <= {AS_OF_SQL} THEN TRY_CAST(BDATE AS DATE) END AS bdate
FROM cust_az12""",

    "repair_amount": _with(("sales_details",), SILVER_SALES) + """
SELECT sls_ord_num, sls_prd_key, amount AS sls_sales FROM sales_amount""",

    "repair_price": _with(("sales_details",), SILVER_SALES) + """
SELECT sls_ord_num, sls_prd_key, sls_sales, sls_quantity, sls_price FROM silver_sales_details""",

    "move_column": """
SELECT p_partkey, p_type, p_name, p_brand, p_size, p_retailprice FROM part""",

    "rename_drop_alias": """
SELECT n_nationkey, n_name AS nation_name, upper(substr(n_name, 1, 3)) AS nation_code,
       CAST(NULL AS DATE) AS no_date
FROM nation""",

    "clean_cust_info": _with(("cust_info",), SILVER_CUST_INFO) + """
SELECT * FROM silver_cust_info""",

    "clean_prd_info": _with(("prd_info",), SILVER_PRD_INFO) + """
SELECT * FROM silver_prd_info""",

    "clean_sales_details": _with(("sales_details",), SILVER_SALES) + """
SELECT * FROM silver_sales_details""",

    "clean_cust_az12": _with(("cust_az12",), SILVER_CUST_AZ12) + """
SELECT * FROM silver_cust_az12""",

    "clean_loc_a101": _with(("loc_a101",), SILVER_LOC_A101) + """
SELECT * FROM silver_loc_a101""",

    "clean_px_cat": _with(("px_cat_g1v2",), SILVER_PX_CAT) + """
SELECT * FROM silver_px_cat""",

    "version_end_date": f"""
WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS start_date FROM orders)
SELECT a.o_orderkey, a.o_custkey, a.start_date,
       COALESCE((SELECT min(b.start_date) FROM o b
                 WHERE b.o_custkey IS NOT DISTINCT FROM a.o_custkey
                   AND (a.start_date IS NULL OR b.start_date > a.start_date)),
                {AS_OF_SQL}) AS end_date
FROM o a""",

    "dense_key": """
WITH o AS (SELECT o_orderkey,
                  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderdate END
                  AS order_ts
           FROM orders)
SELECT o_orderkey, order_ts,
       CAST(row_number() OVER (ORDER BY order_ts NULLS FIRST, o_orderkey) AS BIGINT) AS row_key
FROM o""",

    "left_enrich": """
SELECT c.c_custkey, c.c_name, n.n_name, r.r_name
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",

    "dim_customers": _with(CUSTOMER_FEEDS, SILVER_CUST_INFO, SILVER_CUST_AZ12, SILVER_LOC_A101,
                           DIM_CUSTOMERS) + """
SELECT * FROM dim_customers""",

    "dim_products": _with(PRODUCT_FEEDS, SILVER_PRD_INFO, SILVER_PX_CAT, DIM_PRODUCTS) + """
SELECT * FROM dim_products""",

    "fact_sales": _with(CUSTOMER_FEEDS + PRODUCT_FEEDS + ("sales_details",),
                        SILVER_CUST_INFO, SILVER_CUST_AZ12, SILVER_LOC_A101, DIM_CUSTOMERS,
                        SILVER_PRD_INFO, SILVER_PX_CAT, DIM_PRODUCTS, SILVER_SALES) + """
SELECT sd.sls_ord_num AS order_number, pr.product_sk, cr.customer_sk,
       sd.sls_order_dt AS order_date, sd.sls_ship_dt AS ship_date, sd.sls_due_dt AS due_date,
       sd.sls_sales AS sales, sd.sls_quantity AS quantity, sd.sls_price AS price
FROM silver_sales_details sd
LEFT JOIN dim_products pr ON sd.sls_prd_key = pr.product_number
LEFT JOIN dim_customers cr ON sd.sls_cust_id = cr.customer_id""",

    "upsert_dim": """
WITH target AS (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING' OR c_acctbal <= 0),
source AS (SELECT c_custkey, upper(c_name) AS c_name, c_nationkey, c_acctbal + 1 AS c_acctbal,
                  c_mktsegment
           FROM customer WHERE c_acctbal > 0)
SELECT * FROM target WHERE c_custkey NOT IN (SELECT c_custkey FROM source)
UNION ALL SELECT * FROM source""",

    "replace_by_order": """
WITH target AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem),
source AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity + 1 AS l_quantity FROM lineitem
           WHERE l_returnflag = 'R' AND l_linenumber <= 2)
SELECT * FROM target WHERE l_orderkey NOT IN (SELECT l_orderkey FROM source)
UNION ALL SELECT * FROM source""",

    "append_replace_round_trip": """
SELECT p_partkey, p_name, CAST(NULL AS INTEGER) AS p_size FROM part
UNION ALL SELECT p_partkey, p_name, p_size FROM part""",

    "stream_ingest": feed_cte("cust_info") + """
SELECT *, CAST(NULL AS VARCHAR) AS _rescued_data FROM cust_info""",

    "stream_rescue": feed_cte("loc_a101") + """
SELECT CID,
       CASE WHEN CNTRY = 'Australia' THEN NULL ELSE NULLIF(COALESCE(CNTRY, ''), '') END AS CNTRY,
       CASE WHEN CNTRY = 'USA' THEN CID || ',' || CNTRY || ',EXTRA'
            WHEN CNTRY = 'Australia' THEN CID END AS _rescued_data
FROM loc_a101""",
}
ORACLE_SQL["version_end_timestamp"] = """
SELECT a.o_orderkey, a.o_custkey, a.o_orderdate AS start_ts,
       (SELECT min(b.o_orderdate) FROM orders b
        WHERE b.o_custkey IS NOT DISTINCT FROM a.o_custkey
          AND (a.o_orderdate IS NULL OR b.o_orderdate > a.o_orderdate)) AS end_ts
FROM orders a"""
ORACLE_SQL["keep_latest_hot_groups"] = """
SELECT flag_status, l_returnflag, l_linestatus, l_shipdate, l_orderkey, l_linenumber, l_partkey,
       l_quantity
FROM (SELECT concat_ws('|', l_returnflag, l_linestatus) AS flag_status, *,
             row_number() OVER (
                 PARTITION BY concat_ws('|', l_returnflag, l_linestatus)
                 ORDER BY l_shipdate DESC NULLS LAST, l_returnflag NULLS FIRST,
                          l_linestatus NULLS FIRST, l_orderkey NULLS FIRST,
                          l_linenumber NULLS FIRST, l_partkey NULLS FIRST,
                          l_quantity NULLS FIRST) AS rn
      FROM lineitem) t
WHERE rn = 1"""
ORACLE_SQL["stream_by_name"] = feed_cte("cust_info") + """
SELECT *, CASE WHEN cst_create_date >= '1995-01-01' THEN '{"cst_source":"crm"}' END AS _rescued_data
FROM cust_info"""
ORACLE_SQL["replace_with_empty_then_append"] = "SELECT * FROM part WHERE p_size > 25"
ORACLE_SQL["upsert_creates_missing"] = """
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN upper(c_name) ELSE c_name END AS c_name, c_nationkey, c_acctbal, c_mktsegment
FROM customer"""
ORACLE_SQL["read_by_name"] = "SELECT * FROM supplier"
ORACLE_SQL["audit_stamp"] = _with(("loc_a101",), SILVER_LOC_A101) + """
SELECT cid, cntry, true AS stamped FROM silver_loc_a101"""
ORACLE_SQL["repair_rule_price"] = _with(("sales_details",), SILVER_SALES) + """
SELECT sls_ord_num, sls_prd_key,
       CASE WHEN s IS NULL OR s <= 0 OR s <> qd * abs(p) THEN qd * abs(p) ELSE s END AS sls_sales
FROM sales_typed"""
ORACLE_SQL["fill_all_silver"] = _with(("cust_az12",), SILVER_CUST_AZ12) + """
SELECT COALESCE(cid, 'Unknown') AS cid, bdate, COALESCE(gen, 'Unknown') AS gen FROM silver_cust_az12"""
# Customers of the first load keep their key; new ones follow the largest.
ORACLE_SQL["gold_upsert_second_load"] = _with(("cust_info",), """
one AS (
  SELECT load, TRY_CAST(cst_id AS INTEGER) AS customer_id, cst_key AS customer_number, trim(cst_lastname) AS last_name
  FROM (SELECT *, row_number() OVER (
            PARTITION BY load, cst_id
            ORDER BY cst_create_date DESC NULLS LAST, cst_key ASC NULLS FIRST,
                     cst_firstname ASC NULLS FIRST, cst_lastname ASC NULLS FIRST,
                     cst_marital_status ASC NULLS FIRST, cst_gndr ASC NULLS FIRST) AS rn
        FROM (SELECT 1 AS load, * FROM cust_info WHERE NOT starts_with(cst_lastname, 'B')
              UNION ALL SELECT 2, * FROM cust_info WHERE NOT starts_with(cst_lastname, 'A')) loads) ranked
  WHERE rn = 1 AND regexp_matches(cst_key, '^AW\\d+$'))""", """
first_load AS (SELECT row_number() OVER (ORDER BY customer_id) AS sk, * FROM one WHERE load = 1)""", """
added AS (SELECT row_number() OVER (ORDER BY customer_id) + (SELECT max(sk) FROM first_load) AS sk, * FROM one
          WHERE load = 2 AND customer_id NOT IN (SELECT customer_id FROM first_load))""") + """
SELECT CAST(sk AS BIGINT) AS customer_sk, customer_id, customer_number, last_name
FROM (SELECT * FROM first_load UNION ALL SELECT * FROM added) s"""
ORACLE_SQL["star_build_stored"] = ORACLE_SQL["fact_sales"]
ORACLE_SQL["gold_changed_orders"] = ORACLE_SQL["fact_sales"]
ORACLE_SQL["silver_replayed_batch"] = ORACLE_SQL["clean_sales_details"]
ORACLE_SQL["silver_latest_two_batches"] = ORACLE_SQL["clean_cust_info"]
ORACLE_SQL["silver_versions_two_batches"] = ORACLE_SQL["clean_prd_info"]
ORACLE_SQL["stream_schema_log"] = feed_cte("cust_info") + """
SELECT CASE WHEN later THEN 1 ELSE 0 END AS first_batch,
       CASE WHEN later THEN 'cst_create_date,cst_marital_status,cst_lastname,cst_firstname,cst_key,cst_id,cst_source'
            ELSE 'cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,cst_create_date' END AS columns,
       CASE WHEN later THEN 'cst_source' ELSE '' END AS unknown, CASE WHEN later THEN 'cst_gndr' ELSE '' END AS missing, n_rows
FROM (SELECT cst_create_date >= '1998-04-01' AS later, count(*) AS n_rows FROM cust_info GROUP BY ALL) t"""
