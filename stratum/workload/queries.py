"""Registered queries: one per operator / table job, each reading the given
tables (directly or through a derived raw feed) at full size.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose
column names equal those of the matching SQL in ``oracle.py``. Audit
timestamps are switched off and "today" is pinned to ``AS_OF`` so results
are reproducible.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions import codes, dates, keys, numbers
from stratum.operators import dedup, shape, surrogate, versions
from stratum.plans import gold, layers, silver
from stratum.session import free, scratch_path, shuffles_freed
from stratum.sinks import tables
from stratum.sources.feeds import FEED_COLUMNS, driver_table
from stratum.streaming import by_name, ingest
from stratum.workload.feeds import raw_feed

# Fixed "today" for every date rule, so reruns and the oracle agree.
AS_OF = "2024-06-30"

Query = Callable[[SparkSession, str], DataFrame]


# --- single operators -------------------------------------------------------

def keep_latest(spark, sf):
    return dedup.keep_latest(driver_table(spark, sf, "events"), "user_id", "ts")


def keep_latest_hot_groups(spark, sf):
    """Newest line per (return flag, line status): a handful of groups, each
    holding a large share of all lines - the partial group limit keeps one
    row per group and map task before the shuffle."""
    lines = driver_table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey",
        "l_quantity")
    key = F.concat_ws("|", "l_returnflag", "l_linestatus").alias("flag_status")
    return dedup.keep_latest(lines.select(key, *lines.columns), "flag_status", "l_shipdate")


def keep_any_deterministic(spark, sf):
    orders = driver_table(spark, sf, "orders")
    one = dedup.keep_first(orders, ["o_custkey"], [F.col("o_orderkey").asc()])
    return one.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


def regex_filter(spark, sf):
    r1 = raw_feed(spark, sf, "cust_info")
    return (r1.filter(F.col("cst_key").rlike(silver.CRM_CUSTOMER_KEY_PATTERN))
              .select("cst_id", "cst_key", "cst_create_date"))


def map_codes_fill(spark, sf):
    r1 = raw_feed(spark, sf, "cust_info")
    return r1.select("cst_id", "cst_key", "cst_create_date",
                     codes.map_codes("cst_marital_status", codes.MARITAL_STATUS_MAP)
                     .alias("cst_marital_status"),
                     codes.map_codes("cst_gndr", codes.CRM_GENDER_MAP).alias("cst_gndr"))


def fill_all_strings(spark, sf):
    return shape.fill_strings(raw_feed(spark, sf, "loc_a101"), codes.UNKNOWN)


def multi_branch_map(spark, sf):
    r5 = raw_feed(spark, sf, "loc_a101")
    return r5.select("CID", codes.map_country("CNTRY").alias("cntry"))


def split_key_parts(spark, sf):
    r2 = raw_feed(spark, sf, "prd_info")
    return r2.select("prd_id", keys.head_parts("prd_key", 2, "-", "_").alias("cat_id"),
                     keys.tail_parts("prd_key", 2, "-", "-").alias("prd_key"))


def strip_tokens(spark, sf):
    r4 = raw_feed(spark, sf, "cust_az12")
    return r4.select("CID", keys.strip_pattern("CID", silver.ERP_ID_NOISE).alias("cid_clean"))


def guarded_dates(spark, sf):
    r3 = raw_feed(spark, sf, "sales_details")
    return r3.select("sls_ord_num", "sls_prd_key",
                     *[dates.guarded_compact_date(c).alias(c) for c in silver.SALES_DATE_COLUMNS])


def tolerant_casts(spark, sf):
    r3 = raw_feed(spark, sf, "sales_details")
    return r3.select("sls_ord_num",
                     numbers.tolerant_cast("sls_cust_id", "int").alias("sls_cust_id"),
                     numbers.tolerant_cast("sls_sales", "float").alias("sls_sales"),
                     numbers.tolerant_cast("sls_quantity", "float").alias("sls_quantity"),
                     numbers.tolerant_cast("sls_price", "double").alias("sls_price"))


def cap_future_date(spark, sf):
    r4 = raw_feed(spark, sf, "cust_az12")
    return r4.select("CID", dates.cap_future_date("BDATE", AS_OF).alias("bdate"))


def repair_amount(spark, sf):
    r3 = raw_feed(spark, sf, "sales_details")
    return r3.select("sls_ord_num", "sls_prd_key",
                     numbers.repaired_amount("sls_sales", "sls_quantity", "sls_price")
                     .alias("sls_sales"))


def repair_price(spark, sf):
    r3 = raw_feed(spark, sf, "sales_details")
    return (r3.withColumns(numbers.repair_sales_columns())
              .select("sls_ord_num", "sls_prd_key", "sls_sales", "sls_quantity", "sls_price"))


def repair_rule_price(spark, sf):
    """The amount check against the unit price (``rule="price"``)."""
    r3 = raw_feed(spark, sf, "sales_details")
    return r3.select("sls_ord_num", "sls_prd_key",
                     numbers.repaired_amount("sls_sales", "sls_quantity", "sls_price", rule="price")
                     .alias("sls_sales"))


def audit_stamp(spark, sf):
    """The load time that silver rows carry; only its presence can be compared."""
    silver_rows = silver.clean_loc_a101(raw_feed(spark, sf, "loc_a101"))
    stamp = silver_rows.columns[-1]
    return silver_rows.select("cid", "cntry", F.col(stamp).isNotNull().alias("stamped"))


def fill_all_silver(spark, sf):
    """Every text column of a silver table filled (``fill_all=True``)."""
    return silver.clean_cust_az12(raw_feed(spark, sf, "cust_az12"), as_of=AS_OF, audit=None, fill_all=True)


def move_column(spark, sf):
    return shape.move_column(driver_table(spark, sf, "part"), "p_type", "p_partkey")


def rename_drop_alias(spark, sf):
    n = driver_table(spark, sf, "nation").alias("n")
    out = (shape.rename_columns(n, {"n_name": "nation_name", "no_such_column": "ignored"})
           .drop("n_regionkey", "no_such_column")
           .withColumn("nation_code", F.upper(F.substring("nation_name", 1, 3)))
           .withColumn("no_date", F.lit(None).cast("date")))
    return out.select("n_nationkey", "nation_name", "nation_code", "no_date")


# --- silver jobs ------------------------------------------------------------

def clean_cust_info(spark, sf):
    return silver.clean_cust_info(raw_feed(spark, sf, "cust_info"), audit=None)


def clean_prd_info(spark, sf):
    return silver.clean_prd_info(raw_feed(spark, sf, "prd_info"), as_of=AS_OF, audit=None)


def clean_sales_details(spark, sf):
    return silver.clean_sales_details(raw_feed(spark, sf, "sales_details"), audit=None)


def clean_cust_az12(spark, sf):
    return silver.clean_cust_az12(raw_feed(spark, sf, "cust_az12"), as_of=AS_OF, audit=None)


def clean_loc_a101(spark, sf):
    return silver.clean_loc_a101(raw_feed(spark, sf, "loc_a101"), audit=None)


def clean_px_cat(spark, sf):
    return silver.clean_px_cat(raw_feed(spark, sf, "px_cat_g1v2"), audit=None)


# --- windows ----------------------------------------------------------------

def version_end_date(spark, sf):
    orders = driver_table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("start_date"))
    return versions.version_end(orders, "o_custkey", "start_date", "end_date",
                                open_value=dates.as_of_date(AS_OF))


def version_end_timestamp(spark, sf):
    """Same rule on timestamp starts: takes the range-partitioned path, where
    a customer with very many orders is split over several tasks."""
    orders = driver_table(spark, sf, "orders").select("o_orderkey", "o_custkey",
                                               F.col("o_orderdate").alias("start_ts"))
    return versions.version_end(orders, "o_custkey", "start_ts", "end_ts")


def dense_key(spark, sf):
    orders = driver_table(spark, sf, "orders").select(
        "o_orderkey",
        # orders without a stated priority carry no usable date here (nulls first)
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None))
         .otherwise(F.col("o_orderdate")).alias("order_ts"))
    return surrogate.dense_key(orders, [F.col("order_ts").asc_nulls_first(),
                                        F.col("o_orderkey").asc()], "row_key")


# --- joins and the star schema ----------------------------------------------

def left_enrich(spark, sf):
    c = driver_table(spark, sf, "customer").alias("c")
    n = driver_table(spark, sf, "nation").alias("n")
    r = driver_table(spark, sf, "region").alias("r")
    return (c.join(n, F.col("c.c_nationkey") == F.col("n.n_nationkey"), "left")
             .join(r, F.col("n.n_regionkey") == F.col("r.r_regionkey"), "left")
             .select("c.c_custkey", "c.c_name", "n.n_name", "r.r_name"))


def _silver_customers(spark, sf):
    return (silver.clean_cust_info(raw_feed(spark, sf, "cust_info"), audit=None),
            silver.clean_cust_az12(raw_feed(spark, sf, "cust_az12"), as_of=AS_OF, audit=None),
            silver.clean_loc_a101(raw_feed(spark, sf, "loc_a101"), audit=None))


def _silver_products(spark, sf):
    return (silver.clean_prd_info(raw_feed(spark, sf, "prd_info"), as_of=AS_OF, audit=None),
            silver.clean_px_cat(raw_feed(spark, sf, "px_cat_g1v2"), audit=None))


def dim_customers(spark, sf):
    return gold.dim_customers(*_silver_customers(spark, sf))


def dim_products(spark, sf):
    return gold.dim_products(*_silver_products(spark, sf))


def fact_sales(spark, sf):
    sales = silver.clean_sales_details(raw_feed(spark, sf, "sales_details"), audit=None)
    return gold.fact_sales(sales, dim_products(spark, sf), dim_customers(spark, sf))


# --- storage ----------------------------------------------------------------

def _customer_versions(spark, sf):
    customer = driver_table(spark, sf, "customer")
    # changes: customers in credit; the old snapshot lacks those of one segment
    target = customer.where((F.col("c_mktsegment") != "BUILDING") | (F.col("c_acctbal") <= 0))
    source = customer.where(F.col("c_acctbal") > 0).select(
        "c_custkey", F.upper("c_name").alias("c_name"), "c_nationkey",
        (F.col("c_acctbal") + 1).alias("c_acctbal"), "c_mktsegment")
    return target, source


def upsert_dim(spark, sf):
    target, source = _customer_versions(spark, sf)
    path = scratch_path(spark, "upsert_dim")
    tables.write_table(target, path, "overwrite", keys=["c_custkey"], buckets=8)
    tables.upsert(spark, path, source, ["c_custkey"])
    return tables.read_table(spark, path)


def replace_by_order(spark, sf):
    lineitem = driver_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    # a corrected order keeps only its first two returned lines
    returned = driver_table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
    source = (returned.where(F.col("l_linenumber") <= 2)
              .select("l_orderkey", "l_linenumber", "l_partkey",
                      (F.col("l_quantity") + 1).alias("l_quantity")))
    path = scratch_path(spark, "replace_by_order")
    tables.write_table(lineitem, path, "overwrite", keys=["l_orderkey"], buckets=8)
    tables.replace_by_keys(spark, path, source, ["l_orderkey"])
    return tables.read_table(spark, path)


def append_replace_round_trip(spark, sf):
    part = driver_table(spark, sf, "part")
    path = scratch_path(spark, "round_trip")
    tables.write_table(part, path, "overwrite")
    tables.write_table(part.select("p_partkey", "p_name"), path, "overwrite")
    tables.write_table(part.select("p_partkey", "p_name", "p_size"), path, "append")
    return tables.read_table(spark, path).select("p_partkey", "p_name", "p_size")


def replace_with_empty_then_append(spark, sf):
    """A table replaced by no rows holds none; a later append is all it has."""
    part = driver_table(spark, sf, "part")
    path = scratch_path(spark, "emptied")
    tables.write_table(part, path)
    tables.write_table(part.where(F.lit(False)), path)
    assert tables.read_table(spark, path).isEmpty()
    tables.write_table(part.where(F.col("p_size") > 25), path, "append")
    return tables.read_table(spark, path)


def upsert_creates_missing(spark, sf):
    """The first merge into a table that does not exist creates it; the second
    one updates and inserts."""
    customer = driver_table(spark, sf, "customer")
    path = scratch_path(spark, "created")
    target, _ = _customer_versions(spark, sf)
    tables.upsert(spark, path, target, ["c_custkey"], buckets=4)
    tables.upsert(spark, path, customer.where(F.col("c_acctbal") > 0).withColumn("c_name", F.upper("c_name")), ["c_custkey"])
    return tables.read_table(spark, path)


def read_by_name(spark, sf):
    """A stored table read by its registered name."""
    path = scratch_path(spark, "named")
    tables.write_table(driver_table(spark, sf, "supplier"), path)
    tables.register_table(spark, "stratum_supplier", path)
    return spark.read.table("stratum_supplier")


# --- streaming ingestion ----------------------------------------------------

CSV_WRITE = {"header": "true", "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false"}
BATCH_SPLIT = "1998-04-01"  # about half of the orders are later


def _ingest_twice(spark, feed, first, second):
    root = scratch_path(spark, f"ingest_{feed}")
    raw, bronze, ckpt = f"{root}/raw", f"{root}/bronze", f"{root}/_checkpoint"
    first.write.mode("append").options(**CSV_WRITE).csv(raw)
    ingest.ingest_feed(spark, raw, bronze, ckpt, feed)
    second.write.mode("append").options(**CSV_WRITE).csv(raw)
    ingest.ingest_feed(spark, raw, bronze, ckpt, feed)
    return ingest.read_bronze(spark, bronze, feed)


def stream_ingest(spark, sf):
    r1 = raw_feed(spark, sf, "cust_info")
    before = F.col("cst_create_date") < F.lit(BATCH_SPLIT)
    bronze = _ingest_twice(spark, "cust_info", r1.where(before), r1.where(~before))
    return bronze.select("cst_id", "cst_key", "cst_firstname", "cst_lastname",
                         "cst_marital_status", "cst_gndr", "cst_create_date", "_rescued_data")


def stream_rescue(spark, sf):
    """Lines with an extra or a missing token keep their text in
    ``_rescued_data``: locations in the USA get an extra token, those in
    Australia lose their country token."""
    r5 = raw_feed(spark, sf, "loc_a101")
    country = F.coalesce("CNTRY", F.lit(""))
    line = (F.when(F.col("CNTRY") == "USA", F.concat_ws(",", "CID", country, F.lit("EXTRA")))
             .when(F.col("CNTRY") == "Australia", F.col("CID"))
             .otherwise(F.concat_ws(",", "CID", country)))
    root = scratch_path(spark, "rescue")
    raw, bronze, ckpt = f"{root}/raw", f"{root}/bronze", f"{root}/_checkpoint"
    r5.select(line.alias("value")).write.text(raw)
    ingest.ingest_feed(spark, raw, bronze, ckpt, "loc_a101", header=False)
    return ingest.read_bronze(spark, bronze, "loc_a101").select("CID", "CNTRY", "_rescued_data")


def write_spaced(df, raw) -> None:
    """One file a task: a blank line, the header, then every row with a blank line after it."""
    header, line = ",".join(df.columns), F.concat(F.to_csv(F.struct(*df.columns), CSV_WRITE), F.lit("\n"))
    # The lower 33 bits are the row's number in its task.
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    (df.select(F.concat(F.when(first, F.lit(f"\n{header}\n")).otherwise(F.lit("")), line).alias("value"))
       .write.mode("append").option("lineSep", "\n").option("maxRecordsPerFile", 0).text(raw))


SOURCE_SINCE = "1995-01-01"  # extracts name the source system of rows from this day on


def stream_by_name(spark, sf):
    """Extract layouts of the same feed: the later one lists the columns in
    reverse order, another one has blank lines before its header and between its
    rows. Rows from ``SOURCE_SINCE`` on come, in each of the three, with a column
    the feed does not know, older and undated ones without it. Columns are mapped
    by header name, the unknown one is rescued as JSON, blank lines are no rows."""
    r1 = raw_feed(spark, sf, "cust_info")

    def since(day):
        return F.coalesce(F.col("cst_create_date") >= F.lit(day), F.lit(False))

    later, spaced = since(BATCH_SPLIT), F.coalesce(F.col("cst_key").startswith("BAD"), F.lit(False))
    root = scratch_path(spark, "by_name")
    raw, bronze, ckpt = f"{root}/raw", f"{root}/bronze", f"{root}/_checkpoint"
    for rows in (r1.where(since(SOURCE_SINCE)).withColumn("cst_source", F.lit("crm")), r1.where(~since(SOURCE_SINCE))):
        rows.where(~later & ~spaced).write.mode("append").options(**CSV_WRITE).csv(raw)
        write_spaced(rows.where(~later & spaced), raw)
        rows.where(later).select(*reversed(r1.columns), *rows.columns[len(r1.columns):]).write.mode("append").options(**CSV_WRITE).csv(raw)
    by_name.ingest_feed_by_name(spark, raw, bronze, ckpt, "cust_info")
    return ingest.read_bronze(spark, bronze, "cust_info")


def stream_schema_log(spark, sf):
    """Header layouts of a feed by the batch that first brought them, with the rows
    they brought: the second extract lists the columns in reverse order, has one
    the feed does not know and lacks one."""
    r1 = raw_feed(spark, sf, "cust_info")
    later = F.col("cst_create_date") >= F.lit(BATCH_SPLIT)
    root = scratch_path(spark, "schema_log")
    raw, bronze, ckpt, log = (f"{root}/{n}" for n in ("raw", "bronze", "_checkpoint", "layouts"))
    reordered = [c for c in reversed(r1.columns) if c != "cst_gndr"] + ["cst_source"]
    for extract in (r1.where(~later), r1.where(later).withColumn("cst_source", F.lit("crm")).select(*reordered)):
        extract.write.mode("append").options(**CSV_WRITE).csv(raw)
        by_name.ingest_feed_by_name(spark, raw, bronze, ckpt, "cust_info", schema_location=log)
    layouts = by_name.read_layouts(spark, log)
    rows = spark.read.schema("cst_id string, batch_id int").parquet(bronze).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
    # A batch brings the layout that was new last (two rows here).
    own = rows.join(layouts, F.col("first_batch") <= F.col("batch_id")).groupBy("batch_id").agg(F.max("first_batch").alias("first_batch"), F.first("n").alias("n"))
    counts = own.groupBy("first_batch").agg(F.sum("n").alias("n_rows"))
    joined = lambda c: F.array_join(c, ",").alias(c)
    return layouts.join(counts, "first_batch").select("first_batch", joined("columns"), joined("unknown"), joined("missing"), "n_rows")


# --- incremental silver -------------------------------------------------------

def _take_loads(spark, feed, loads, replay=False):
    """Extracts of a feed, each taken through bronze into incremental silver.
    ``replay``: every batch is written a second time, as after a crash between
    writing it and recording it."""
    root = scratch_path(spark, f"loads_{feed}")
    roots = layers.Roots(f"{root}/raw", f"{root}/bronze", f"{root}/silver", f"{root}/gold")
    places = roots.raw_feed(feed), roots.bronze_data(feed), roots.bronze_checkpoint(feed)
    for load in loads:
        load.write.mode("append").options(**CSV_WRITE).csv(roots.raw_feed(feed))
        by_name.ingest_feed_by_name(spark, *places, feed)
        layers.build_silver(spark, roots, as_of=AS_OF, audit=False, incremental=True, feeds=[feed])
        if replay:
            commits = f"{roots.bronze_checkpoint(feed)}/commits"
            free(spark, f"{commits}/{max(int(n) for n in tables.list_names(spark, commits) if n.isdigit())}")
            by_name.ingest_feed_by_name(spark, *places, feed)
            layers.build_silver(spark, roots, as_of=AS_OF, audit=False, incremental=True, feeds=[feed])
    return layers.read_silver(spark, roots, feed)


def silver_replayed_batch(spark, sf):
    """Sales in two loads, each of whose batches is written twice: silver has every line once."""
    sales = raw_feed(spark, sf, "sales_details")
    early = F.col("sls_ship_dt") < F.lit(BATCH_SPLIT.replace("-", ""))
    return _take_loads(spark, "sales_details", [sales.where(early), sales.where(~early)], replay=True)


def silver_latest_two_batches(spark, sf):
    """Customers in two loads, the older rows last: the newest row of each key stays."""
    customers = raw_feed(spark, sf, "cust_info")
    later = F.col("cst_create_date") >= F.lit(BATCH_SPLIT)
    return _take_loads(spark, "cust_info", [customers.where(later), customers.where(~later)])


def silver_versions_two_batches(spark, sf):
    """Products in two loads: versions of the second one end versions of the first one."""
    products = raw_feed(spark, sf, "prd_info")
    first = F.coalesce(F.trim("prd_line"), F.lit("")).isin("r", "S", "")
    return _take_loads(spark, "prd_info", [products.where(first), products.where(~first)])


# --- the whole layered build over stored tables -------------------------------

# A packed file is read by one task, so its length is bounded (about 128 MB of text).
CSV_PACKED = {"compression": "gzip", "maxRecordsPerFile": "2000000"}


def write_raw_feeds(spark, sf, roots) -> None:
    """Derived feeds written as packed raw CSV extracts, one folder per feed."""
    for feed, columns in FEED_COLUMNS.items():
        df = raw_feed(spark, sf, feed)
        for c in columns:
            if c not in df.columns:
                df = df.withColumn(c, F.lit(None).cast("string"))
        df.select(*columns).write.options(**CSV_WRITE, **CSV_PACKED).csv(roots.raw_feed(feed))


def star_build_stored(spark, sf):
    """Raw CSV -> bronze stream -> silver tables -> gold tables; the fact is
    read back from storage."""
    root = scratch_path(spark, "star")
    roots = layers.Roots(f"{root}/raw", f"{root}/bronze", f"{root}/silver", f"{root}/gold")
    with shuffles_freed(spark):
        write_raw_feeds(spark, sf, roots)
    layers.run_all(spark, roots, as_of=AS_OF)
    return tables.read_table(spark, roots.gold_table("fact_sales")).select(
        "order_number", "product_sk", "customer_sk", "order_date", "ship_date", "due_date",
        "sales", "quantity", "price")


def gold_upsert_second_load(spark, sf):
    """Two loads in upsert mode: the second lacks some customers and products
    and brings new ones; matched rows keep their surrogate key, vanished rows
    stay, new rows are numbered after the largest key."""
    root = scratch_path(spark, "second_load")
    roots = layers.Roots(f"{root}/raw", f"{root}/bronze", f"{root}/silver", f"{root}/gold")
    for feed in FEED_COLUMNS:
        if feed != "cust_info":
            extra = {"as_of": AS_OF} if feed in ("prd_info", "cust_az12") else {}
            df = silver.SILVER_BUILDERS[feed](raw_feed(spark, sf, feed), audit=None, **extra)
            tables.write_table(df, roots.silver_table(feed))
    for letter in ("B", "A"):
        # each load delivers all customers as they are then, without one segment
        present = raw_feed(spark, sf, "cust_info").where(~F.col("cst_lastname").startswith(letter))
        tables.write_table(silver.clean_cust_info(present, audit=None), roots.silver_table("cust_info"))
        layers.build_gold(spark, roots, mode="upsert", audit=False, buckets=4)
    return tables.read_table(spark, roots.gold_table("dim_customers")).select(
        "customer_sk", "customer_id", "customer_number", "last_name")


def gold_changed_orders(spark, sf):
    """Two loads in upsert mode: the first lacks late deliveries; the second brings
    them, and the merge touches only the orders they belong to."""
    root = scratch_path(spark, "changed_orders")
    roots = layers.Roots(f"{root}/raw", f"{root}/bronze", f"{root}/silver", f"{root}/gold")
    for feed in sorted(FEED_COLUMNS, key=lambda f: f == "sales_details"):  # sales last
        extra = {"as_of": AS_OF} if feed in ("prd_info", "cust_az12") else {}
        loads = [raw_feed(spark, sf, feed)]
        if feed == "sales_details":
            loads = [loads[0].where(F.col("sls_ship_dt") < "19980101"), loads[0].where(F.col("sls_ship_dt") >= "19980101")]
        for mode, load in zip(("overwrite", "append"), loads):
            if mode == "append":
                layers.build_gold(spark, roots, mode="upsert", audit=False, buckets=8)
            tables.write_table(silver.SILVER_BUILDERS[feed](load, audit=None, **extra), roots.silver_table(feed), mode)
    layers.build_gold(spark, roots, mode="upsert", audit=False, buckets=8)
    return tables.read_table(spark, roots.gold_table("fact_sales")).drop(layers.FACT_PARTITION)


QUERIES: dict[str, Query] = {
    "keep_latest": keep_latest,
    "keep_latest_hot_groups": keep_latest_hot_groups,
    "keep_any_deterministic": keep_any_deterministic,
    "regex_filter": regex_filter,
    "map_codes_fill": map_codes_fill,
    "fill_all_strings": fill_all_strings,
    "multi_branch_map": multi_branch_map,
    "split_key_parts": split_key_parts,
    "strip_tokens": strip_tokens,
    "guarded_dates": guarded_dates,
    "tolerant_casts": tolerant_casts,
    "cap_future_date": cap_future_date,
    "repair_amount": repair_amount,
    "repair_price": repair_price,
    "repair_rule_price": repair_rule_price,
    "audit_stamp": audit_stamp,
    "fill_all_silver": fill_all_silver,
    "move_column": move_column,
    "rename_drop_alias": rename_drop_alias,
    "clean_cust_info": clean_cust_info,
    "clean_prd_info": clean_prd_info,
    "clean_sales_details": clean_sales_details,
    "clean_cust_az12": clean_cust_az12,
    "clean_loc_a101": clean_loc_a101,
    "clean_px_cat": clean_px_cat,
    "version_end_date": version_end_date,
    "version_end_timestamp": version_end_timestamp,
    "dense_key": dense_key,
    "left_enrich": left_enrich,
    "dim_customers": dim_customers,
    "dim_products": dim_products,
    "fact_sales": fact_sales,
    "upsert_dim": upsert_dim,
    "replace_by_order": replace_by_order,
    "append_replace_round_trip": append_replace_round_trip,
    "replace_with_empty_then_append": replace_with_empty_then_append,
    "upsert_creates_missing": upsert_creates_missing,
    "read_by_name": read_by_name,
    "stream_ingest": stream_ingest,
    "stream_rescue": stream_rescue,
    "stream_by_name": stream_by_name,
    "star_build_stored": star_build_stored,
    "gold_upsert_second_load": gold_upsert_second_load,
    "gold_changed_orders": gold_changed_orders,
    "silver_replayed_batch": silver_replayed_batch,
    "silver_latest_two_batches": silver_latest_two_batches,
    "silver_versions_two_batches": silver_versions_two_batches,
    "stream_schema_log": stream_schema_log,
}
