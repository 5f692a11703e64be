"""Repeated, missing and assigned numbers; history; samples; unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwarden import reference as ref
from tillwarden.operators import audit, conform, sampling, sequence
from tillwarden.plans import tables as T
from tillwarden.plans.catalog import query


def _heads(spark, sf):
    return T.till_log(spark, sf).select("event_id", "tran_head.*")


@query(
    "dup_tran_no",
    ["ev_head"],
    """SELECT store, register, business_date, tran_no, tran_seq_no, c AS n_rows FROM (
         SELECT *, count(*) OVER (PARTITION BY store, register, business_date, tran_no) AS c FROM ev_head) WHERE c > 1""",
)
def dup_tran_no(spark, sf):
    return sequence.dup_tran_no(_heads(spark, sf)).select(
        "store", "register", "business_date", "tran_no", "tran_seq_no", "n_rows"
    )


@query(
    "dup_line_no",
    ["o_item"],
    """SELECT tran_no, item_seq_no, item, unit_retail, c AS n_rows FROM (
         SELECT *, count(*) OVER (PARTITION BY tran_no, item_seq_no) AS c FROM o_item) WHERE c > 1""",
)
def dup_line_no(spark, sf):
    return sequence.dup_tran_no(T.order_item(spark, sf), ["tran_no", "item_seq_no"]).select(
        "tran_no", "item_seq_no", "item", "unit_retail", "n_rows"
    )


@query(
    "missing_tran_gaps",
    ["ev_head"],
    """SELECT store, register, business_date, unnest(generate_series(p + 1, tran_no - 1)) AS tran_no FROM (
         SELECT store, register, business_date, tran_no,
           coalesce(lag(tran_no) OVER (PARTITION BY store, register, business_date ORDER BY tran_no), 0) AS p
         FROM (SELECT DISTINCT store, register, business_date, tran_no FROM ev_head
               WHERE tran_type NOT IN ('OPEN', 'CLOSE') AND tran_no NOT IN (9000, 9999))) WHERE tran_no - p > 1""",
)
def missing_tran_gaps(spark, sf):
    return sequence.missing_numbers(_heads(spark, sf))


@query(
    "missing_line_no",
    ["o_item"],
    """SELECT tran_no, unnest(generate_series(p + 1, item_seq_no - 1)) AS item_seq_no FROM (
         SELECT tran_no, item_seq_no, coalesce(lag(item_seq_no) OVER (PARTITION BY tran_no ORDER BY item_seq_no), 0) AS p
         FROM (SELECT DISTINCT tran_no, item_seq_no FROM o_item)) WHERE item_seq_no - p > 1""",
)
def missing_line_no(spark, sf):
    return sequence.missing_numbers(T.order_item(spark, sf), ["tran_no"], "item_seq_no")


@query(
    "missing_event_ids",
    ["e0"],
    """SELECT event_type, unnest(generate_series(p + 1, event_id - 1)) AS event_id FROM (
         SELECT event_type, event_id, coalesce(lag(event_id) OVER (PARTITION BY event_type ORDER BY event_id), 0) AS p
         FROM e0 WHERE event_id >= 1) WHERE event_id - p > 1""",
)
def missing_event_ids(spark, sf):
    """Few, long groups: each spans many ranges of numbers."""
    events = T.table(spark, sf, "events").select("event_type", "event_id")
    return sequence.missing_numbers(events, ["event_type"], "event_id", exclude_numbers=())


@query(
    "sa_missing_tran",
    ["ev_head"],
    """SELECT store, business_date, register, tran_no, 'MISSING' AS status, 'POS' AS rtlog_orig_sys FROM (
         SELECT store, register, business_date, unnest(generate_series(p + 1, tran_no - 1)) AS tran_no FROM (
         SELECT store, register, business_date, tran_no,
           coalesce(lag(tran_no) OVER (PARTITION BY store, register, business_date ORDER BY tran_no), 0) AS p
         FROM (SELECT DISTINCT store, register, business_date, tran_no FROM ev_head
               WHERE tran_type NOT IN ('OPEN', 'CLOSE'))) WHERE tran_no - p > 1)""",
)
def sa_missing_tran(spark, sf):
    return sequence.sa_missing_tran(_heads(spark, sf)).select(
        "store", "business_date", "register", "tran_no", "status", "rtlog_orig_sys"
    )


@query(
    "item_sequence",
    ["o_item"],
    """SELECT tran_no, count(*) AS n_items, count(DISTINCT item_seq_no) AS n_numbers, min(item_seq_no) AS first_no, max(item_seq_no) AS last_no
       FROM o_item GROUP BY tran_no
       HAVING NOT (min(item_seq_no) = 1 AND max(item_seq_no) = count(DISTINCT item_seq_no) AND count(*) = count(DISTINCT item_seq_no))""",
)
def item_sequence(spark, sf):
    return sequence.check_item_sequence(T.order_item(spark, sf), T.ORDER_KEYS)


@query(
    "register_sessions",
    ["ev_head"],
    """SELECT store, register, business_date, count(*) FILTER (WHERE tran_type = 'OPEN') AS n_open,
         count(*) FILTER (WHERE tran_type = 'CLOSE') AS n_close, count(*) AS n_trans
       FROM ev_head GROUP BY 1, 2, 3 HAVING n_open <> 1 OR n_close <> 1""",
)
def register_sessions(spark, sf):
    return sequence.register_session_check(_heads(spark, sf))


@query(
    "assign_counters",
    ["ev_head"],
    """SELECT event_id, store, register,
         row_number() OVER (PARTITION BY store, register ORDER BY tran_datetime, event_id) AS counter FROM ev_head""",
)
def assign_counters(spark, sf):
    heads = _heads(spark, sf).select("event_id", "store", "register", "tran_datetime")
    return sequence.assign_counters(
        heads,
        ["store", "register"],
        [F.col("tran_datetime"), F.col("event_id")],
        F.substring("tran_datetime", 1, 13),
        "counter",
    ).drop("tran_datetime")


@query(
    "assign_line_numbers",
    ["o_item"],
    """SELECT tran_no, row_number() OVER (PARTITION BY tran_no ORDER BY item_seq_no, l_partkey, unit_retail, qty) AS line_no, item, unit_retail FROM o_item""",
)
def assign_line_numbers(spark, sf):
    """New item numbers 1..n where the given ones repeat."""
    items = T.order_item(spark, sf)
    order = [F.col(c) for c in ("item_seq_no", "l_partkey", "unit_retail", "qty")]
    return sequence.assign_counters(items, ["tran_no"], order, out="line_no").select(
        "tran_no", "line_no", "item", "unit_retail"
    )


@query(
    "surrogate_keys",
    ["o_head"],
    """SELECT count(*) AS n_keys, count(*) AS n_ids, CAST(0 AS BIGINT) AS n_collisions
       FROM (SELECT DISTINCT store, register, business_date, tran_no FROM o_head)""",
)
def surrogate_keys(spark, sf):
    return sequence.surrogate_report(T.order_head(spark, sf), sequence.TRAN_NO_KEY)


def _versions(spark, sf):
    e = T.table(spark, sf, "events")
    return e.selectExpr(
        "user_id", "event_id", "event_type as status", "cast(ts as timestamp) as update_datetime"
    )


_REV_SQL = """SELECT user_id, event_id, ts, event_type AS status,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS rev_no FROM (
      SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM e0)
    WHERE p IS DISTINCT FROM event_type"""


@query("head_revisions", ["e0"], f"SELECT user_id, event_id, status, rev_no FROM ({_REV_SQL})")
def head_revisions(spark, sf):
    return sequence.head_revisions(
        _versions(spark, sf),
        ["user_id"],
        ["update_datetime", "event_id"],
        F.date_trunc("hour", "update_datetime"),
        ["status"],
    ).select("user_id", "event_id", "status", "rev_no")


@query(
    "as_of_revision",
    ["e0"],
    f"""SELECT user_id, arg_max(event_id, rev_no) AS event_id, arg_max(status, rev_no) AS status, max(rev_no) AS rev_no
        FROM ({_REV_SQL}) WHERE ts <= TIMESTAMP '2024-01-15 12:00:00' GROUP BY user_id""",
)
def as_of_revision(spark, sf):
    revs = sequence.head_revisions(
        _versions(spark, sf),
        ["user_id"],
        ["update_datetime", "event_id"],
        F.date_trunc("hour", "update_datetime"),
        ["status"],
    )
    at = F.lit("2024-01-15 12:00:00").cast("timestamp")
    return sequence.as_of_revision(revs, ["user_id"], at, ["rev_no"]).select(
        "user_id", "event_id", "status", "rev_no"
    )


@query(
    "sa_tran_head_rev",
    ["ev_head", "ev_hits"],
    """SELECT h.tran_no, CAST(r AS BIGINT) AS rev_no, CASE r WHEN 0 THEN status WHEN 1 THEN
           CASE WHEN b > 0 THEN 'ERRORED' WHEN e > 0 THEN 'VALIDATED' ELSE 'APPROVED' END END AS status
       FROM (SELECT event_id, tran_no, status FROM ev_head) h
       LEFT JOIN (SELECT event_id, count(*) AS e, count(*) FILTER (WHERE error_code NOT IN ('VOID_OOH', 'ITEM_SEQ_GAP',
           'TAX_MODE_MIX', 'PAIDIO_SHAPE', 'SEQ_FORMAT', 'BANNER_INVALID', 'CURR_AMT_MISMATCH', 'POS_DROP_SHIP')) AS b
         FROM ev_hits GROUP BY 1) x ON x.event_id = h.event_id, generate_series(0, 1) g(r)""",
)
def sa_tran_head_rev(spark, sf):
    """Imported headers, the same delivered again, then with their audited state."""
    log = T.till_log(spark, sf)
    head = conform.fan_out(log)["sa_tran_head"]
    again = head.withColumn("update_datetime", F.expr("update_datetime + interval 1 hour"))
    errors = audit.build_sa_error(audit.audit_nested(log)).drop("store", "business_date")
    audited = audit.advance_status(head, errors, ref.error_codes(spark)).select(*head.columns).withColumn(
        "update_datetime", F.expr("update_datetime + interval 1 day")
    )
    versions = head.unionByName(again).unionByName(audited)
    return sequence.sa_tran_head_rev(versions, ["status", "value"]).select("tran_no", "rev_no", "status")


@query(
    "first_n",
    ["o_head"],
    "SELECT tran_no, store, business_date, value FROM o_head ORDER BY store, business_date, tran_no LIMIT 1000",
)
def first_n(spark, sf):
    heads = T.order_head(spark, sf).select("tran_no", "store", "business_date", "value")
    order = [F.col("store"), F.col("business_date"), F.col("tran_no")]
    return sampling.first_n(heads, order, 1000)


@query(
    "sample_exact",
    ["o_head"],
    """SELECT tran_no, store, business_date, value FROM o_head
       QUALIFY row_number() OVER (ORDER BY md5('7|' || CAST(tran_no AS VARCHAR)), tran_no)
         <= (SELECT CAST(round_even(CAST(count(*) AS DOUBLE) * 0.02, 0) AS BIGINT) FROM o_head)""",
)
def sample_exact(spark, sf):
    sample = sampling.sample_exact(T.order_head(spark, sf), ["tran_no"], 0.02, seed=7)
    return sample.select("tran_no", "store", "business_date", "value")


@query(
    "sample_size",
    ["o_head"],
    """SELECT rate, CAST(round_even(CAST(count(*) AS DOUBLE) * rate, 0) AS BIGINT) AS n_rows, CAST(round_even(CAST(count(*) AS DOUBLE) * rate, 0) AS BIGINT) AS n_distinct
       FROM o_head, (VALUES (0.02), (0.1), (0.5)) r(rate) GROUP BY rate""",
)
def sample_size(spark, sf):
    out = None
    for rate in (0.02, 0.1, 0.5):
        s = sampling.sample_exact(T.order_head(spark, sf), ["tran_no"], rate, seed=7)
        one = s.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("tran_no").alias("n_distinct"))
        one = one.withColumn("rate", F.lit(str(rate)).cast("decimal(3,2)"))
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "round_robin",
    ["o_head"],
    """SELECT l AS label, (n - i) // 6 + CASE WHEN (n - i) % 6 > 0 THEN 1 ELSE 0 END AS n_rows
       FROM (SELECT count(*) AS n FROM o_head),
         (VALUES ('A', 0), ('B', 1), ('C', 2), ('D', 3), ('E', 4), ('F', 5)) t(l, i)""",
)
def round_robin(spark, sf):
    labelled = sampling.assign_round_robin(
        T.order_head(spark, sf), ["tran_no"], ["A", "B", "C", "D", "E", "F"], seed=7
    )
    return labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "union_channels",
    ["o_head", "ev_head"],
    """SELECT rtlog_orig_sys, tran_type, count(*) AS n_trans, CAST(sum(value) AS DECIMAL(38,4)) AS value, count(status) AS n_status
       FROM (SELECT rtlog_orig_sys, tran_type, value, NULL AS status FROM o_head WHERE rtlog_orig_sys <> 'POS'
             UNION ALL SELECT rtlog_orig_sys, tran_type, value, status FROM ev_head) GROUP BY 1, 2""",
)
def union_channels(spark, sf):
    shop = T.order_head(spark, sf).filter("rtlog_orig_sys <> 'POS'")
    both = conform.union_channels(_heads(spark, sf), shop)
    return both.groupBy("rtlog_orig_sys", "tran_type").agg(
        F.count(F.lit(1)).alias("n_trans"),
        F.sum("value").cast("decimal(38,4)").alias("value"),
        F.count("status").alias("n_status"),
    )


@query(
    "union_days",
    ["o_head"],
    "SELECT store, count(*) AS n_trans, min(business_date) AS first_day, max(business_date) AS last_day FROM o_head GROUP BY store",
)
def union_days(spark, sf):
    heads = T.order_head(spark, sf)
    early, late = heads.filter("business_date < '1998-01-01'"), heads.filter("business_date >= '1998-01-01'")
    return conform.union_days(early, late).groupBy("store").agg(
        F.count(F.lit(1)).alias("n_trans"),
        F.min("business_date").alias("first_day"),
        F.max("business_date").alias("last_day"),
    )
