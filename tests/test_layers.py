"""The stored bronze -> silver -> gold build: reruns are idempotent."""

from __future__ import annotations

from conftest import SF_SMALL

from stratum.plans import layers
from stratum.sinks import tables
from stratum.workload.queries import AS_OF, write_raw_feeds


def _counts(spark, roots):
    out = {f: tables.read_table(spark, roots.silver_table(f)).count()
           for f in layers.SILVER_AUDIT}
    out.update({g: tables.read_table(spark, roots.gold_table(g)).count()
                for g in layers.GOLD_KEYS})
    return out


def test_rerun_adds_nothing_in_both_modes(spark, tmp_dir):
    roots = layers.Roots(f"{tmp_dir}/raw", f"{tmp_dir}/bronze", f"{tmp_dir}/silver",
                         f"{tmp_dir}/gold")
    write_raw_feeds(spark, SF_SMALL, roots)
    first = layers.run_all(spark, roots, as_of=AS_OF)
    assert all(v > 0 for v in first.ingested_rows.values())
    before = _counts(spark, roots)

    second = layers.run_all(spark, roots, as_of=AS_OF)
    assert set(second.ingested_rows.values()) == {0}
    assert _counts(spark, roots) == before

    third = layers.run_all(spark, roots, as_of=AS_OF, mode="upsert")
    assert set(third.ingested_rows.values()) == {0}
    assert _counts(spark, roots) == before
    gold_cols = tables.read_table(spark, roots.gold_table("fact_sales")).columns
    assert gold_cols[-2:] == ["dwh_update_date", layers.FACT_PARTITION]


def test_by_position_build_gives_same_gold(spark, tmp_dir):
    a = layers.Roots(f"{tmp_dir}/a/raw", f"{tmp_dir}/a/bronze", f"{tmp_dir}/a/silver",
                     f"{tmp_dir}/a/gold")
    b = layers.Roots(a.raw, f"{tmp_dir}/b/bronze", f"{tmp_dir}/b/silver", f"{tmp_dir}/b/gold")
    write_raw_feeds(spark, SF_SMALL, a)
    layers.run_all(spark, a, as_of=AS_OF, audit=False)
    layers.run_all(spark, b, as_of=AS_OF, audit=False, by_name=False)
    fa = tables.read_table(spark, a.gold_table("fact_sales"))
    fb = tables.read_table(spark, b.gold_table("fact_sales"))
    assert fa.count() == fb.count() > 0
    assert fa.exceptAll(fb).count() == 0 and fb.exceptAll(fa).count() == 0


def test_silver_append_mode_duplicates_like_the_notebook(spark, tmp_dir):
    roots = layers.Roots(f"{tmp_dir}/raw", f"{tmp_dir}/bronze", f"{tmp_dir}/silver",
                         f"{tmp_dir}/gold")
    write_raw_feeds(spark, SF_SMALL, roots)
    layers.ingest_all(spark, roots)
    layers.build_silver(spark, roots, as_of=AS_OF)
    n = tables.read_table(spark, roots.silver_table("loc_a101")).count()
    layers.build_silver(spark, roots, as_of=AS_OF, mode="append")
    assert tables.read_table(spark, roots.silver_table("loc_a101")).count() == 2 * n
    layers.build_silver(spark, roots, as_of=AS_OF)
    assert tables.read_table(spark, roots.silver_table("loc_a101")).count() == n


def test_second_batch_of_files_equals_one_full_load(spark, tmp_dir):
    from pyspark.sql import functions as F

    from stratum.sources.feeds import FEED_COLUMNS
    from stratum.workload.feeds import raw_feed
    from stratum.workload.queries import CSV_WRITE

    full = layers.Roots(f"{tmp_dir}/f/raw", f"{tmp_dir}/f/bronze", f"{tmp_dir}/f/silver",
                        f"{tmp_dir}/f/gold")
    inc = layers.Roots(f"{tmp_dir}/i/raw", f"{tmp_dir}/i/bronze", f"{tmp_dir}/i/silver",
                       f"{tmp_dir}/i/gold")
    write_raw_feeds(spark, SF_SMALL, full)
    layers.run_all(spark, full, as_of=AS_OF, audit=False)

    feeds = {}
    for feed, columns in FEED_COLUMNS.items():
        df = raw_feed(spark, SF_SMALL, feed)
        for c in columns:
            if c not in df.columns:
                df = df.withColumn(c, F.lit(None).cast("string"))
        feeds[feed] = df.select(*columns)

    def split(feed, df):
        key = F.xxhash64(*[F.col(c) for c in FEED_COLUMNS[feed]])
        return df.where(key % 2 == 0), df.where(key % 2 != 0)

    halves = {f: split(f, df) for f, df in feeds.items()}
    for f, (a, _) in halves.items():
        a.write.options(**CSV_WRITE).csv(inc.raw_feed(f) + "/part=a")
    r1 = layers.run_all(spark, inc, as_of=AS_OF, audit=False)
    for f, (_, b) in halves.items():
        b.write.options(**CSV_WRITE).csv(inc.raw_feed(f) + "/part=b")
    r2 = layers.run_all(spark, inc, as_of=AS_OF, audit=False)
    for f, (a, b) in halves.items():
        assert r1.ingested_rows[f] == a.count() and r2.ingested_rows[f] == b.count()

    for g in layers.GOLD_KEYS:
        x = tables.read_table(spark, full.gold_table(g))
        y = tables.read_table(spark, inc.gold_table(g))
        assert x.count() == y.count() > 0
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_command_line_jobs(spark, tmp_dir):
    from stratum.__main__ import main

    roots = layers.Roots(f"{tmp_dir}/raw", f"{tmp_dir}/bronze", f"{tmp_dir}/silver",
                         f"{tmp_dir}/gold")
    write_raw_feeds(spark, SF_SMALL, roots)
    dirs = ["--raw", roots.raw, "--bronze", roots.bronze, "--silver", roots.silver,
            "--gold", roots.gold]
    out = main(["run", *dirs, "--as-of", AS_OF], spark=spark)
    assert all(v > 0 for v in out["ingested_rows"].values())
    again = main(["ingest", "--raw", roots.raw, "--bronze", roots.bronze, "--feed", "cust_info"],
                 spark=spark)
    assert again["rows"] == 0 and again["new_layouts"] == []
    assert out["new_layouts"]["loc_a101"] == [["CID", "CNTRY"]]
    merged = main(["gold", "--silver", roots.silver, "--gold", roots.gold, "--upsert", "--match-null-keys"], spark=spark)
    assert set(merged["gold_versions"]) == set(layers.GOLD_KEYS)
    assert tables.read_table(spark, roots.gold_table("fact_sales")).count() > 0


def _write(folder, name, text):
    import os
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as fh:
        fh.write(text)


HEADERS = {"cust_info": "cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,cst_create_date",
           "prd_info": "prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt",
           "sales_details": "sls_ord_num,sls_prd_key,sls_cust_id,sls_order_dt,sls_ship_dt,sls_due_dt,sls_sales,sls_quantity,sls_price",
           "cust_az12": "CID,BDATE,GEN", "loc_a101": "CID,CNTRY", "px_cat_g1v2": "ID,CAT,SUBCAT,MAINTENANCE"}


def _small_feeds(roots, load="1", **rows):
    for feed, header in HEADERS.items():
        body = "".join(f"{r}\n" for r in rows.get(feed, ()))
        _write(roots.raw_feed(feed), f"{load}.csv", f"{header}\n{body}")


def _roots(base):
    return layers.Roots(f"{base}/raw", f"{base}/bronze", f"{base}/silver", f"{base}/gold")


def test_build_with_empty_feeds_and_reordered_header(spark, tmp_dir):
    roots = _roots(tmp_dir)
    _small_feeds(roots, cust_info=["1,AW1,a,b,M,F,2020-01-01"], prd_info=["1,AC-HE-P1,n,5,R,2020-01-01,"],
                 sales_details=["SO1,P1,1,20200101,20200102,20200103,10,2,5"])
    _write(roots.raw_feed("loc_a101"), "2.csv", "\nCNTRY,CID\nFrance,AW-1\n\n")   # px_cat and az12: header only
    layers.run_all(spark, roots, as_of=AS_OF, audit=False)
    customer = tables.read_table(spark, roots.gold_table("dim_customers")).collect()
    assert [(r["customer_id"], r["country"]) for r in customer] == [(1, "France")]
    assert tables.read_table(spark, roots.gold_table("dim_products")).first()["category"] is None
    assert tables.read_table(spark, roots.gold_table("fact_sales")).count() == 1
    assert tables.read_table(spark, roots.silver_table("px_cat_g1v2")).count() == 0


def test_surrogate_keys_are_stable_in_upsert_mode(spark, tmp_dir):
    roots = _roots(tmp_dir)
    _small_feeds(roots, cust_info=[f"{i},AW{i},a,b,M,F,2020-01-01" for i in (1, 3, 5)],
                 prd_info=[f"{i},AC-HE-P{i},n,5,R,2020-01-0{i}," for i in (2, 4)],
                 sales_details=["SO1,P2,3,20200101,20200102,20200103,10,2,5"])
    layers.run_all(spark, roots, as_of=AS_OF, mode="upsert")

    def keys(name, natural, sk):
        return {r[natural]: r[sk] for r in tables.read_table(spark, roots.gold_table(name)).collect()}

    first = keys("dim_customers", "customer_id", "customer_sk")
    products = keys("dim_products", "product_id", "product_sk")
    assert first == {1: 1, 3: 2, 5: 3} and products == {2: 1, 4: 2}
    # customer 1's newest row gets a bad key (it vanishes from silver); 2 and 4 are new
    _small_feeds(roots, "2", cust_info=["1,BAD,a,b,M,F,2024-01-01", "2,AW2,a,b,M,F,2020-01-01", "4,AW4,a,b,M,F,2020-01-01",
                                        "5,AW5,new,b,M,F,2024-01-01"], prd_info=["1,AC-HE-P1,n,5,R,2019-01-01,"])
    layers.run_all(spark, roots, as_of=AS_OF, mode="upsert")
    second = keys("dim_customers", "customer_id", "customer_sk")
    assert second == {1: 1, 3: 2, 5: 3, 2: 4, 4: 5} and keys("dim_products", "product_id", "product_sk") == {2: 1, 4: 2, 1: 3}
    newest = tables.read_table(spark, roots.gold_table("dim_customers")).where("customer_id = 5").first()
    assert newest["first_name"] == "new"
    fact = tables.read_table(spark, roots.gold_table("fact_sales")).first()
    assert (fact["customer_sk"], fact["product_sk"]) == (2, 1)


def test_incremental_silver_reads_new_batches_only(spark, tmp_dir):
    roots = _roots(tmp_dir)
    line = "SO{0},P1,1,20200101,20200102,20200103,10,2,5"
    _small_feeds(roots, sales_details=[line.format(1), line.format(2)], loc_a101=["AW-1,DE"])
    layers.run_all(spark, roots, as_of=AS_OF, incremental=True)
    before = tables.state(spark, roots.silver_table("sales_details"))
    _small_feeds(roots, "2", sales_details=[line.format(3)])
    layers.run_all(spark, roots, as_of=AS_OF, incremental=True)
    added = tables.read_added(spark, roots.silver_table("sales_details"), before)
    assert [r["sls_ord_num"] for r in added.collect()] == ["SO3"]
    assert tables.read_table(spark, roots.silver_table("sales_details")).count() == 3
    assert tables.read_table(spark, roots.silver_table("loc_a101")).count() == 1
    assert tables.read_table(spark, roots.gold_table("fact_sales")).count() == 3
    layers.run_all(spark, roots, as_of=AS_OF, incremental=True)  # nothing new
    assert tables.read_table(spark, roots.silver_table("sales_details")).count() == 3


def test_build_leaves_no_scratch(spark, tmp_dir):
    import os

    from stratum.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark).removeprefix("file:") + "/stratum-scratch"
    roots = _roots(tmp_dir)
    _small_feeds(roots, cust_info=["1,AW1,a,b,M,F,2020-01-01"], prd_info=["1,AC-HE-P1,n,5,R,2020-01-01,"],
                 sales_details=["SO1,P1,1,20200101,20200102,20200103,10,2,5"])
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    layers.run_all(spark, roots, as_of=AS_OF)
    assert set(os.listdir(base)) - before == set()


def _forget_commit(roots, feed, batch):
    """As after a crash between writing a batch and recording it: the next run writes the batch again."""
    import os
    base = roots.bronze_checkpoint(feed)
    for name in (f"{batch}", f".{batch}.crc"):
        if os.path.exists(f"{base}/commits/{name}"):
            os.remove(f"{base}/commits/{name}")


def _rows(spark, path, *cols):
    return sorted(map(tuple, tables.read_table(spark, path).select(*cols).collect()), key=str)


def test_replayed_bronze_batch_leaves_silver_unchanged(spark, tmp_dir):
    roots = _roots(tmp_dir)
    line = "SO{0},P1,1,20200101,20200102,20200103,10,2,5"
    _small_feeds(roots, sales_details=[line.format(1)], loc_a101=["AW-1,DE"], cust_az12=["NASAW1,1980-01-01,F"],
                 px_cat_g1v2=["AC_HE,a,b,Yes"], cust_info=["1,AW1,a,b,M,F,2020-01-01"], prd_info=["1,AC-HE-P1,n,5,R,2020-01-01,"])
    layers.ingest_all(spark, roots)
    layers.build_silver(spark, roots, as_of=AS_OF, incremental=True)
    counts = {f: tables.read_table(spark, roots.silver_table(f)).count() for f in layers.SILVER_AUDIT}
    assert set(counts.values()) == {1}
    for _ in range(2):
        for feed in layers.SILVER_AUDIT:
            _forget_commit(roots, feed, 0)
        assert set(layers.ingest_all(spark, roots).ingested_rows.values()) == {1}      # every batch is written again
        layers.build_silver(spark, roots, as_of=AS_OF, incremental=True)
        assert {f: tables.read_table(spark, roots.silver_table(f)).count() for f in layers.SILVER_AUDIT} == counts
    # the next batch settles the first one
    _small_feeds(roots, "2", sales_details=[line.format(2)])
    layers.ingest_all(spark, roots)
    layers.build_silver(spark, roots, as_of=AS_OF, incremental=True)
    state = tables.state(spark, roots.silver_table("sales_details"))
    assert state.notes["batches"]["through"] == 0 and list(state.notes["batches"]["open"]) == ["1"]
    assert [r[0] for r in _rows(spark, roots.silver_table("sales_details"), "sls_ord_num")] == ["SO1", "SO2"]
    version = state.version
    layers.build_silver(spark, roots, as_of=AS_OF, incremental=True)
    assert tables.state(spark, roots.silver_table("sales_details")).version == version   # nothing new, nothing written


def test_a_rewritten_batch_replaces_its_own_rows(spark, tmp_dir):
    from stratum.sinks import batches

    source, path = f"{tmp_dir}/bronze", f"{tmp_dir}/silver"

    def put(batch, *values):
        spark.createDataFrame([(v,) for v in values], "v int").write.mode("overwrite").parquet(batches.batch_folder(source, batch))

    def take():
        def read(numbers):
            if not numbers:
                return spark.createDataFrame([], "v int")
            return spark.read.schema("v int").parquet(*[batches.batch_folder(source, b) for b in numbers])
        batches.take_batches(spark, path, source, read, lambda df: df, most_folders=3)
        return sorted(r["v"] for r in tables.read_table(spark, path).collect())

    assert take() == []                                   # no batch yet: an empty table
    put(0, 1, 2)
    assert take() == [1, 2]
    put(0, 1, 2, 3)                                       # written again, with a row more
    assert take() == [1, 2, 3]
    put(1, 4)
    put(3, 5)                                             # batch 2 had no rows
    assert take() == [1, 2, 3, 4, 5] == take()
    put(3, 6)
    assert take() == [1, 2, 3, 4, 6]
    spark.createDataFrame([(9,)], "v int").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(batches.batch_folder(source, 4))
    assert take() == [1, 2, 3, 4, 6]                      # not complete yet
    put(4, 7)
    for k in range(5, 15):
        put(k, k + 10)
        assert take()[-1] == k + 10
    now = tables.state(spark, path)
    assert len(now.folders) <= 4 + 1                      # settled folders were merged on the way
    assert sorted(r["v"] for r in tables.read_table(spark, path).collect()) == [1, 2, 3, 4, 6, 7, *range(15, 25)]


def _batches_of_feed(spark, roots, feed, *loads, incremental=True):
    for k, rows in enumerate(loads):
        _write(roots.raw_feed(feed), f"{k}.csv", HEADERS[feed] + "\n" + "".join(f"{r}\n" for r in rows))
        layers.ingest_all(spark, roots)
        if incremental:
            layers.build_silver(spark, roots, as_of=AS_OF, audit=False, incremental=True, feeds=[feed])


def test_incremental_latest_customer_equals_full_load(spark, tmp_dir):
    loads = [["1,AW1,old,b,M,F,2020-01-01", "2,AW2,two,b,S,M,2021-01-01", ",AW9,null id,b,M,F,2020-01-01", "x,AW8,odd,b,M,F,2020-01-01"],
             ["1,AW1,new,b,M,F,2022-01-01", "2,AW2,late,b,S,M,2019-01-01", "3,BAD,c,d,M,F,2020-01-01"],
             ["1,BAD,gone,b,M,F,2023-01-01", ",AW9,null again,b,M,F,2021-01-01", "3,AW3,good,d,M,F,2021-01-01", "y,AW7,odd,b,M,F,2020-01-01"],
             ["2,AW2,two,b,S,M,2021-01-01", "4,AW4,tie b,b,M,F,2020-01-01", "4,AW4,tie a,b,M,F,2020-01-01"]]
    inc, full = _roots(f"{tmp_dir}/i"), _roots(f"{tmp_dir}/f")
    for roots in (inc, full):
        for feed, header in HEADERS.items():
            _write(roots.raw_feed(feed), "none.csv", header + "\n")
    _batches_of_feed(spark, inc, "cust_info", *loads)
    _batches_of_feed(spark, full, "cust_info", *loads, incremental=False)
    layers.build_silver(spark, full, as_of=AS_OF, audit=False, feeds=["cust_info"])
    got = _rows(spark, inc.silver_table("cust_info"), "*")
    assert got == _rows(spark, full.silver_table("cust_info"), "*") and [r[2] for r in got if r[0] in (1, 2, 3, 4)] == ["two", "good", "tie a"]
    # a batch that changes one key leaves most buckets as they are
    before = set(tables.state(spark, inc.silver_table("cust_info")).folders)
    _batches_of_feed(spark, inc, "cust_info", *loads, ["2,AW2,newest,b,S,M,2024-01-01"])
    after = set(tables.state(spark, inc.silver_table("cust_info")).folders)
    assert len(before - after) == 1
    assert "newest" in [r[2] for r in _rows(spark, inc.silver_table("cust_info"), "*")]


def test_incremental_version_ends_equal_full_recompute(spark, tmp_dir):
    line = "{0},AC-HE-{1},n{0},5,R,{2},"
    loads = [[line.format(1, "P1", "2020-01-01"), line.format(2, "P1", "2022-01-01"), line.format(3, "P2", "2020-05-01"), "9,,n,5,R,2020-01-01,"],
             [line.format(4, "P1", "2021-01-01")],                                                  # in the middle
             [line.format(5, "P1", "2023-01-01"), line.format(6, "P2", "2019-01-01"),               # a late last one, an early first one
              line.format(7, "P3", "2020-01-01"), line.format(8, "P1", "2021-01-01"), line.format(10, "P2", "")]]
    inc, full = _roots(f"{tmp_dir}/i"), _roots(f"{tmp_dir}/f")
    for roots in (inc, full):
        for feed, header in HEADERS.items():
            _write(roots.raw_feed(feed), "none.csv", header + "\n")
    _batches_of_feed(spark, inc, "prd_info", *loads)
    _batches_of_feed(spark, full, "prd_info", *loads, incremental=False)
    layers.build_silver(spark, full, as_of=AS_OF, audit=False, feeds=["prd_info"])
    got = _rows(spark, inc.silver_table("prd_info"), "*")
    assert got == _rows(spark, full.silver_table("prd_info"), "*") and len(got) == 10
    # another as-of day ends open versions anew
    layers.build_silver(spark, inc, as_of="2030-01-01", audit=False, incremental=True, feeds=["prd_info"])
    layers.build_silver(spark, full, as_of="2030-01-01", audit=False, feeds=["prd_info"])
    assert _rows(spark, inc.silver_table("prd_info"), "*") == _rows(spark, full.silver_table("prd_info"), "*") != got


def test_a_new_order_rewrites_only_its_buckets(spark, tmp_dir):
    roots = _roots(tmp_dir)
    line = "SO{0},P{1},{2},20200101,20200102,20200103,10,2,5"
    _small_feeds(roots, cust_info=[f"{i},AW{i},a,b,M,F,2020-01-01" for i in range(1, 30)], loc_a101=[f"AW-{i},DE" for i in range(1, 30)],
                 prd_info=[f"{i},AC-HE-P{i},n,5,R,2020-01-01," for i in range(1, 10)], px_cat_g1v2=["AC_HE,a,b,Yes"],
                 sales_details=[line.format(i, i % 12, i % 40) for i in range(200)])
    layers.ingest_all(spark, roots)
    layers.build_silver(spark, roots, as_of=AS_OF, audit=True, incremental=True)
    layers.build_gold(spark, roots, mode="upsert", buckets=8)
    gold_tables = {n: roots.gold_table(n) for n in layers.GOLD_KEYS}
    first = {n: tables.state(spark, p) for n, p in gold_tables.items()}

    _small_feeds(roots, "2", sales_details=[line.format(777, 3, 5)])
    layers.run_all(spark, roots, as_of=AS_OF, mode="upsert", incremental=True)
    second = {n: tables.state(spark, p) for n, p in gold_tables.items()}
    assert second["dim_customers"].folders == first["dim_customers"].folders
    assert second["dim_products"].folders == first["dim_products"].folders
    old, new = (set(at["fact_sales"].folders) for at in (first, second))
    assert len({f.bucket for f in old ^ new}) == 1 and len({f.bucket for f in old}) == 8
    assert tables.read_table(spark, gold_tables["fact_sales"]).count() == 201

    # a customer that orders already named, a product that gets a second version, a moved customer
    _small_feeds(roots, "3", cust_info=["35,AW35,late,b,M,F,2020-01-01"], prd_info=["50,AC-HE-P3,again,5,R,2021-01-01,"], loc_a101=["AW-7,CA"])
    layers.run_all(spark, roots, as_of=AS_OF, mode="upsert", incremental=True)
    merged = {n: tables.read_table(spark, p) for n, p in gold_tables.items()}
    fresh = layers.Roots(roots.raw, roots.bronze, roots.silver, f"{tmp_dir}/gold2")
    layers.build_gold(spark, fresh, buckets=8)                       # all of it, from the same silver
    natural = {"dim_customers": ["customer_id", "customer_number", "first_name", "country"],
               "dim_products": ["product_id", "product_number", "product_name", "category", "start_date"]}
    for n, cols in natural.items():
        assert sorted(map(str, merged[n].select(*cols).collect())) == sorted(map(str, tables.read_table(spark, fresh.gold_table(n)).select(*cols).collect()))

    def lines(r):
        c, p = (tables.read_table(spark, r.gold_table(n)) for n in ("dim_customers", "dim_products"))
        f = tables.read_table(spark, r.gold_table("fact_sales"))
        return sorted(map(str, f.join(c, "customer_sk", "left").join(p, "product_sk", "left").select("order_number", "customer_id", "product_id", "sales").collect()))

    assert lines(roots) == lines(fresh) and len(lines(roots)) > 201
    # nothing new: no table gets a version
    versions = {n: tables.state(spark, p).version for n, p in gold_tables.items()}
    layers.run_all(spark, roots, as_of=AS_OF, mode="upsert", incremental=True)
    assert {n: tables.state(spark, p).version for n, p in gold_tables.items()} == versions


def test_null_natural_keys_in_upsert_mode(spark, tmp_dir):
    """A null id is inserted by a merge that brings it, unless null equals null."""
    for match in (False, True):
        roots = _roots(f"{tmp_dir}/{match}")
        rows = {"cust_info": ["x,AW1,a,b,M,F,2020-01-01", "2,AW2,a,b,M,F,2020-01-01"], "prd_info": ["x,AC-HE-P1,n,5,R,2020-01-01,"],
                "sales_details": [",P1,1,20200101,20200102,20200103,10,2,5"]}
        _small_feeds(roots, **rows)
        layers.ingest_all(spark, roots)
        for name in ("a", "b", "c"):
            layers.build_silver(spark, roots, as_of=AS_OF)
            layers.build_gold(spark, roots, mode="upsert", match_null_keys=match)
            counts = {n: tables.read_table(spark, roots.gold_table(n)).count() for n in layers.GOLD_KEYS}
            assert counts == {"dim_customers": 2, "dim_products": 1, "fact_sales": 1}   # unchanged rows bring nothing
        _write(roots.raw_feed("cust_info"), "4.csv", HEADERS["cust_info"] + "\nx,AW1,changed,b,M,F,2021-01-01\n")
        layers.run_all(spark, roots, as_of=AS_OF, mode="upsert")
        n = len([r for r in tables.read_table(spark, roots.gold_table("dim_customers")).collect() if r["customer_id"] is None])
        assert n == 2   # the run's default: null matches nothing
        layers.build_gold(spark, roots, mode="upsert", match_null_keys=True)
        assert tables.read_table(spark, roots.gold_table("dim_customers")).count() == 3


def test_bronze_that_began_anew_is_told_and_rebuilt(spark, tmp_dir):
    import pytest

    from stratum.sinks import batches

    roots = _roots(tmp_dir)
    for feed, header in HEADERS.items():
        _write(roots.raw_feed(feed), "none.csv", header + "\n")
    _batches_of_feed(spark, roots, "cust_info", *[[f"{k},AW{k},a,b,M,F,2020-01-01"] for k in range(4)])
    assert tables.state(spark, roots.silver_state("cust_info")).notes["batches"]["through"] == 2
    again = layers.Roots(f"{tmp_dir}/raw2", f"{tmp_dir}/bronze2", roots.silver, roots.gold)
    for feed, header in HEADERS.items():
        _write(again.raw_feed(feed), "none.csv", header + "\n")
    _write(again.raw_feed("cust_info"), "0.csv", HEADERS["cust_info"] + "\n9,AW9,a,b,M,F,2020-01-01\n")
    layers.ingest_all(spark, again)
    with pytest.raises(batches.RestartedSourceError):
        layers.build_silver(spark, again, as_of=AS_OF, audit=False, incremental=True, feeds=["cust_info"])
    layers.build_silver(spark, again, as_of=AS_OF, audit=False, feeds=["cust_info"])
    for _ in range(2):
        assert [r[0] for r in _rows(spark, roots.silver_table("cust_info"), "cst_id")] == [9]
        layers.build_silver(spark, again, as_of=AS_OF, audit=False, incremental=True, feeds=["cust_info"])
