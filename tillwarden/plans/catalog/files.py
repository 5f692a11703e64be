"""Readers and writers, each through files in the shared work folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwarden.functions import keys as K
from tillwarden.plans import tables as T
from tillwarden.plans.catalog import query
from tillwarden.session import work_dir
from tillwarden.sources import canonical, landing, registry as G, rtlog as R


PACKED = "lz4"  # about twice the bytes of gzip, in less time to write and to read


def _landed_json(spark, sf):
    """The till log written as packed JSON lines in store/date/hour folders."""
    path = work_dir(spark, "landing")
    R.write_rtlog(T.regional_log(T.till_log(spark, sf)), path, compression=PACKED)
    return path


@query(
    "rtlog_write_read",
    ["ev_facts"],
    """SELECT store % 5 + 1 AS store, CAST(date_trunc('month', business_date) AS DATE) AS date, strftime(ts, '%H') AS hour,
         tran_seq_no, record_channel AS rtlog_orig_sys, value, vendor_no, CAST(n_items AS INTEGER) AS n_items, tender_total FROM ev_facts""",
)
def rtlog_write_read(spark, sf):
    log = R.read_rtlog(spark, _landed_json(spark, sf))
    tender = F.aggregate(
        "tran_tender", F.lit(0).cast("decimal(20,4)"), lambda a, t: (a + t["tender_amt"]).cast("decimal(20,4)")
    )
    return log.select(
        "store", "date", "hour", "tran_head.tran_seq_no", "rtlog_orig_sys", "tran_head.value",
        "tran_head.vendor_no", F.size("tran_item").alias("n_items"), tender.alias("tender_total"),
    )


@query(
    "raw_lineage",
    ["ev_head"],
    """SELECT store % 5 + 1 AS store, strftime(ts, '%H') AS hour, count(*) AS n_lines, count(*) AS n_keys,
         CAST(1 AS BIGINT) AS n_files FROM ev_head GROUP BY 1, 2""",
)
def raw_lineage(spark, sf):
    raw = R.read_rtlog_raw(spark, _landed_json(spark, sf))
    return raw.groupBy("store", "hour").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_distinct("record_key").alias("n_keys"),
        F.count_distinct("source_file").alias("n_files"),
    )


@query(
    "partition_counts",
    ["ev_head"],
    "SELECT store, business_date AS date, strftime(ts, '%H') AS hour, count(*) AS n_records FROM ev_head GROUP BY 1, 2, 3",
)
def partition_counts(spark, sf):
    return R.partition_counts(T.till_log(spark, sf))


@query("count_lines", ["e0"], "SELECT 2 * count(*) AS n_lines FROM e0")
def count_lines(spark, sf):
    """Written, then replaced, then appended to: twice the records."""
    path = _landed_json(spark, sf)
    log = T.regional_log(T.till_log(spark, sf))
    R.write_rtlog(log, path, compression=PACKED)
    R.write_rtlog(log, path, append=True, compression=PACKED)
    return R.count_lines(spark, path)


@query("store_registry", ["stores"], "SELECT * FROM stores")
def store_registry(spark, sf):
    """The registry as a padded CSV with every row twice, read back."""
    path = work_dir(spark, "stores")
    stores = T.registry(spark, sf)
    padded = stores.withColumn("store_name", F.concat(F.lit(" "), "store_name", F.lit("  ")))
    padded.unionByName(padded).write.option("header", "true").option(
        "ignoreLeadingWhiteSpace", "false"
    ).option("ignoreTrailingWhiteSpace", "false").csv(path)
    return G.read_stores(spark, path)


@query("repeated_stores", ["stores"], "SELECT store_no, CAST(2 AS BIGINT) AS n_rows FROM stores WHERE tills > 15")
def repeated_stores(spark, sf):
    path = work_dir(spark, "stores")
    stores = T.registry(spark, sf)
    stores.unionByName(stores.filter("tills > 15")).write.option("header", "true").csv(path)
    return G.repeated_stores(G.read_stores_all(spark, path))


@query(
    "land_bronze",
    ["o_head"],
    """SELECT CASE WHEN business_date < DATE '1998-01-01' THEN DATE '2024-02-01' ELSE DATE '2024-02-02' END AS ingest_date,
         rtlog_orig_sys, count(*) AS n_rows, CAST(sum(value) AS DECIMAL(38,4)) AS value FROM o_head GROUP BY 1, 2""",
)
def land_bronze(spark, sf):
    """A first delivery, then everything: what has landed must not land again."""
    path = work_dir(spark, "bronze")
    keyed = T.order_head(spark, sf).withColumn("record_key", F.sha2(F.col("tran_no").cast("string"), 256))
    landing.land_bronze(keyed.filter("business_date < '1998-01-01'"), path, "2024-02-01")
    landing.land_bronze(keyed, path, "2024-02-02")
    return spark.read.parquet(path).groupBy("ingest_date", "rtlog_orig_sys").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("value").cast("decimal(38,4)").alias("value")
    )


@query(
    "land_csv",
    None,
    """SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(20,4)) AS c_acctbal, c_mktsegment, DATE '2024-02-01' AS ingest_date FROM customer""",
)
def land_csv(spark, sf):
    source, path = work_dir(spark, "csv"), work_dir(spark, "bronze_csv")
    T.table(spark, sf, "customer").write.option("header", "true").csv(source)
    ddl = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DECIMAL(20,4), c_mktsegment STRING"
    for _ in range(2):  # a re-delivery changes nothing
        landing.land_csv(spark, source, ddl, path, "2024-02-01")
    return spark.read.parquet(path).drop("record_key")


@query(
    "land_json",
    None,
    """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(20,4)) AS o_totalprice, DATE '2024-02-01' AS ingest_date FROM orders""",
)
def land_json(spark, sf):
    source, path = work_dir(spark, "json"), work_dir(spark, "bronze_json")
    T.table(spark, sf, "orders").write.json(source)
    ddl = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DECIMAL(20,4)"
    for _ in range(2):
        landing.land_json(spark, source, ddl, path, "2024-02-01")
    return spark.read.parquet(path).drop("record_key")


@query(
    "write_canonical",
    ["o_head"],
    """SELECT store % 5 + 1 AS store, CAST(date_trunc('month', business_date) AS DATE) AS business_date,
         CAST(dayofyear(date_trunc('month', business_date)) AS BIGINT) AS day, tran_no, tran_type, value, rtlog_orig_sys FROM o_head""",
)
def write_canonical(spark, sf):
    """Headers filed by group of stores and month, written twice (the second run replaces).

    The first of a month has one day number in all years; every year must stay.
    """
    base = work_dir(spark, "canonical")
    heads = T.order_head(spark, sf).withColumns(
        {
            "store": F.col("store") % 5 + 1,
            "business_date": F.trunc("business_date", "month"),
            "record_key": F.col("tran_no").cast("string"),
        }
    ).withColumn("day", K.day_number("business_date"))
    canonical.write_canonical({"sa_tran_head": heads}, base)
    canonical.write_canonical({"sa_tran_head": heads}, base)
    return canonical.read_canonical(spark, base, "sa_tran_head").select(
        F.col("store").cast("long").alias("store"), "business_date", "day", "tran_no", "tran_type", "value", "rtlog_orig_sys",
    )
