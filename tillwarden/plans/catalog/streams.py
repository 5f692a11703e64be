"""Streaming paths, run over everything that is there and then read from their tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwarden.plans import nightly, tables as T
from tillwarden.plans.catalog import query
from tillwarden.plans.catalog.files import _landed_json
from tillwarden.session import work_dir
from tillwarden.sources import canonical, rtlog as R
from tillwarden.streaming import conform as SC, gaps, late, revisions, sinks, windows


def _head_stream(spark, sf):
    return T.nest_events(T.event_stream(spark, sf)).select("event_id", "tran_head.*")


@query(
    "stream_hourly",
    ["ev_head"],
    """SELECT epoch(date_trunc('hour', ts - INTERVAL 330 MINUTE))::BIGINT AS hour_start, store, rtlog_orig_sys, count(*) AS n_trans,
         CAST(sum(CASE WHEN tran_type = 'SALE' THEN value END) AS DECIMAL(38,4)) AS sales FROM ev_head GROUP BY 1, 2, 3""",
)
def stream_hourly(spark, sf):
    path, cp = work_dir(spark, "hourly"), work_dir(spark, "cp")
    agg = windows.hourly_sales(windows.event_time(_head_stream(spark, sf)), "event_ts")
    sinks.run_available(windows.write_hourly(agg, path), cp)
    return windows.latest_hourly(spark, path).withColumn("hour_start", F.unix_seconds("hour_start"))


@query(
    "stream_dedup",
    ["ev_head"],
    "SELECT store, register, tran_type, count(*) AS n_trans FROM ev_head GROUP BY 1, 2, 3",
)
def stream_dedup(spark, sf):
    """Every record arrives twice and is kept once."""
    path, cp = work_dir(spark, "dedup"), work_dir(spark, "cp")
    twice = windows.event_time(_head_stream(spark, sf)).withColumn(
        "_copy", F.explode(F.array(F.lit(1), F.lit(2)))
    )
    once = windows.stream_dedup(twice, "event_ts", ["event_id"])
    sinks.run_available(
        once.select("event_id", "store", "register", "tran_type").writeStream.format("parquet").option("path", path), cp
    )
    return spark.read.parquet(path).groupBy("store", "register", "tran_type").agg(
        F.count(F.lit(1)).alias("n_trans")
    )


def _conformed(spark, sf):
    base, cp = work_dir(spark, "silver"), work_dir(spark, "cp")
    stream = R.stream_rtlog(spark, _landed_json(spark, sf), max_files=60)
    sinks.run_available(SC.stream_conform(stream, base), cp)
    return base


@query(
    "stream_conform",
    ["ev_head", "ev_item", "ev_disc", "ev_tender", "ev_tax", "ev_igtax", "ev_row_hits"],
    """WITH g AS (SELECT event_id FROM ev_head WHERE error_ind IN ('Y', 'N'))
       SELECT 'sa_tran_head' AS table_name, count(*) AS n_rows FROM g
       UNION ALL SELECT 'sa_tran_item', count(*) FROM ev_item SEMI JOIN g USING (event_id)
       UNION ALL SELECT 'sa_tran_disc', count(*) FROM ev_disc SEMI JOIN g USING (event_id)
       UNION ALL SELECT 'sa_tran_tender', count(*) FROM ev_tender SEMI JOIN g USING (event_id)
       UNION ALL SELECT 'sa_tran_tax', count(*) FROM ev_tax SEMI JOIN g USING (event_id)
       UNION ALL SELECT 'sa_tran_igtax', count(*) FROM ev_igtax SEMI JOIN g USING (event_id)
       UNION ALL SELECT '_quarantine', (SELECT count(*) FROM ev_head) - (SELECT count(*) FROM g)
       UNION ALL SELECT 'error_hits', count(*) FROM ev_row_hits SEMI JOIN g USING (event_id) WHERE error_code <> 'SEQ_FORMAT'""".replace(
        "WITH g AS (", "SELECT * FROM (WITH g AS ("
    )
    + ")",
)
def stream_conform(spark, sf):
    """Rows per table after several micro-batches of landing files."""
    base = _conformed(spark, sf)
    out = None
    names = ["sa_tran_head", "sa_tran_item", "sa_tran_disc", "sa_tran_tender", "sa_tran_tax", "sa_tran_igtax", "_quarantine"]
    for name in names + ["error_hits"]:
        rows = sinks.read_batches(spark, f"{base}/{name}")
        if name == "error_hits":
            # records were re-filed by group of stores, so all ids differ from their headers
            rows = rows.filter("error_code <> 'SEQ_FORMAT'")
        one = rows.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "stream_conform_heads",
    ["ev_head"],
    """SELECT store % 5 + 1 AS store, tran_no, tran_type, value, rtlog_orig_sys, tran_seq_no AS tran_seq_text
       FROM ev_head WHERE error_ind IN ('Y', 'N')""",
)
def stream_conform_heads(spark, sf):
    rows = sinks.read_batches(spark, f"{_conformed(spark, sf)}/sa_tran_head")
    return rows.select("store", "tran_no", "tran_type", "value", "rtlog_orig_sys", "tran_seq_text")


@query(
    "stream_missing_tran",
    ["ev_head"],
    """SELECT store, register, business_date, unnest(generate_series(p + 1, tran_no - 1)) AS tran_no FROM (
         SELECT store, register, business_date, tran_no,
           coalesce(lag(tran_no) OVER (PARTITION BY store, register, business_date ORDER BY tran_no), 0) AS p
         FROM (SELECT DISTINCT store, register, business_date, tran_no FROM ev_head
               WHERE tran_type NOT IN ('OPEN', 'CLOSE'))) WHERE tran_no - p > 1""",
)
def stream_missing_tran(spark, sf):
    base, cp = work_dir(spark, "gaps"), work_dir(spark, "cp")
    sinks.run_available(gaps.stream_missing_tran(_head_stream(spark, sf), base), cp)
    return gaps.current_gaps(spark, base)


@query(
    "stream_head_rev",
    ["e0"],
    """SELECT user_id, event_id, event_type AS status, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS rev_no
       FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM e0) WHERE p IS DISTINCT FROM event_type""",
)
def stream_head_rev(spark, sf):
    path, cp = work_dir(spark, "revs"), work_dir(spark, "cp")
    changes = T.event_stream(spark, sf).selectExpr(
        "user_id", "event_id", "event_type as status", "cast(ts as timestamp) as update_datetime"
    )
    writer = revisions.stream_head_rev(
        changes, path, ["user_id"], ["update_datetime", "event_id"], F.date_trunc("hour", "update_datetime"), ["status"]
    )
    sinks.run_available(writer, cp)
    return revisions.read_revisions(spark, path).select("user_id", "event_id", "status", "rev_no")


# ten deliveries: day d of the month comes with delivery 3 d mod 10, so old days follow new ones
_DELIVERIES = 10
_LATE_SQL = """
    SELECT *, delivery > 0 AND date_trunc('hour', event_ts) + INTERVAL 1 HOUR <= clock - INTERVAL 48 HOUR AS is_late
    FROM (SELECT h.*, c.clock FROM (SELECT *, ts - INTERVAL 330 MINUTE AS event_ts, day(ts) * 3 % 10 AS delivery FROM ev_head) h
      LEFT JOIN (SELECT d, max(m) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS clock
        FROM (SELECT day(ts) * 3 % 10 AS d, max(ts - INTERVAL 330 MINUTE) AS m FROM ev_head GROUP BY 1)) c ON c.d = h.delivery)"""


def _late_tables(spark, sf):
    """The deliveries one after the other through a stream, which is started again for each."""
    source, path, cp = work_dir(spark, "deliveries"), work_dir(spark, "late"), work_dir(spark, "cp")
    parted = work_dir(spark, "parted")
    log = T.till_log(spark, sf)
    delivery = F.day("tran_head.business_date") * 3 % _DELIVERIES
    events = log.select("tran_head.*", delivery.alias("delivery"))
    # the log is read once for all deliveries: each of them then takes its own folder
    events.write.partitionBy("delivery").parquet(parted)
    events = spark.read.schema(events.schema).parquet(parted)
    for n in range(_DELIVERIES):
        events.filter(F.col("delivery") == n).drop("delivery").write.mode("append").parquet(source)
        heads = spark.readStream.schema(events.drop("delivery").schema).parquet(source)
        sinks.run_available(late.stream_hourly_late(windows.event_time(heads), path), cp)
    return path, log


@query(
    "late_rows",
    ["ev_head"],
    f"""SELECT store, business_date, count(*) AS n_late FROM ({_LATE_SQL}) WHERE is_late GROUP BY 1, 2""",
)
def late_rows(spark, sf):
    """Rows of ten deliveries out of order that came after their hour was closed, per store-day."""
    path, _ = _late_tables(spark, sf)
    return late.late_rows(spark, path).groupBy("store", "business_date").agg(F.count(F.lit(1)).alias("n_late"))


@query(
    "late_reaudit",
    ["ev_head"],
    f"""SELECT store, business_date, rtlog_orig_sys, epoch(date_trunc('hour', event_ts))::BIGINT AS hour_start, count(*) AS n_trans,
          CAST(sum(CASE WHEN tran_type = 'SALE' THEN value END) AS DECIMAL(38,4)) AS sales FROM ({_LATE_SQL}) GROUP BY 1, 2, 3, 4""",
)
def late_reaudit(spark, sf):
    """Hours after the store-days of late rows were audited again: those of a batch over everything."""
    path, log = _late_tables(spark, sf)
    late.reaudit(spark, path, log)
    return late.current_hourly(spark, path).withColumn("hour_start", F.unix_seconds("hour_start"))


@query(
    "nightly_run",
    ["ev_head", "ev_row_hits", "ev_set_hits", "stores"],
    """SELECT store, business_date, CAST(sum(t) AS BIGINT) AS n_trans, CAST(sum(e) AS BIGINT) AS n_errors FROM (
         -- re-filed records: every id differs from its header, so each has one SEQ_FORMAT
         SELECT store, business_date, 1 AS t,
           1 + CASE WHEN count(*) OVER (PARTITION BY store, register, business_date, tran_no) > 1 THEN 1 ELSE 0 END
             + CASE WHEN count(*) OVER (PARTITION BY tran_seq_no) > 1 THEN 1 ELSE 0 END AS e
         FROM (SELECT * REPLACE (store % 5 + 1 AS store, CAST(date_trunc('month', business_date) AS DATE) AS business_date)
               FROM ev_head WHERE error_ind IN ('Y', 'N'))
         UNION ALL
         SELECT store % 5 + 1, CAST(date_trunc('month', business_date) AS DATE), 0, 1
         FROM (SELECT * FROM ev_row_hits UNION ALL SELECT * FROM ev_set_hits WHERE error_code <> 'REF_INTEGRITY')
         WHERE error_code <> 'SEQ_FORMAT' AND event_id IN (SELECT event_id FROM ev_head WHERE error_ind IN ('Y', 'N'))
           -- amounts are compared in the currency of the store
           AND (error_code <> 'CURR_AMT_MISMATCH' OR store % 5 + 1 IN (SELECT store_no FROM stores WHERE local_currency = 'INR')))
       GROUP BY 1, 2""",
)
def nightly_run(spark, sf):
    """Landing files to audited canonical tables in one batch run."""
    base = work_dir(spark, "nightly")
    nightly.run(spark, _landed_json(spark, sf), base, T.registry(spark, sf))
    heads = canonical.read_canonical(spark, base, "sa_tran_head")
    errors = canonical.read_canonical(spark, base, "sa_error")
    h = heads.groupBy(F.col("store").cast("long").alias("store"), "business_date").agg(
        F.count(F.lit(1)).alias("n_trans")
    )
    e = errors.groupBy(F.col("store").cast("long").alias("store"), "business_date").agg(
        F.count(F.lit(1)).alias("n_errors")
    )
    return h.join(e, ["store", "business_date"], "left").withColumn(
        "n_errors", F.coalesce("n_errors", F.lit(0))
    )
