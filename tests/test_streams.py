"""Streams in several micro-batches give what the batch operators give."""


from pyspark.sql import functions as F

from records import bare, frame, land, record
from tillwarden.operators import conform, rules, sequence
from tillwarden.sources import rtlog as R
from tillwarden.streaming import conform as SC, gaps, revisions, sinks, windows


def log():
    recs = [bare(9000, "OPEN", tran_datetime="2024-03-15T06:00:00+05:30")]
    recs += [record(n, tran_datetime=f"2024-03-15T{8 + n % 5:02d}:{n:02d}:00+05:30") for n in range(1, 30) if n % 6]
    bad = record(40, tran_datetime="2024-03-15T09:59:00+05:30", error_ind="?")
    recs[3]["tran_tender"] = []
    return recs + [bad]


def test_stream_conform_equals_batch(spark, tmp_path):
    path = land(log(), tmp_path / "in", lines_per_file=2)
    base = str(tmp_path / "out")
    q = sinks.run_available(SC.stream_conform(R.stream_rtlog(spark, path, 3), base), str(tmp_path / "cp"))
    assert len({p["batchId"] for p in q.recentProgress}) > 2
    good, bad = conform.quarantine(frame(spark, log()))
    for name, df in conform.fan_out(good).items():
        got = sinks.read_batches(spark, f"{base}/{name}").drop("batch_id").select(*df.columns)
        assert got.count() == df.count() and got.exceptAll(df).count() == 0, name
    assert sinks.read_batches(spark, f"{base}/_quarantine").count() == bad.count() == 1
    hits = [r.error_code for r in sinks.read_batches(spark, f"{base}/error_hits").collect()]
    assert hits == ["MISSING_TENDER"] == [r.error_code for r in rules.run_rules(rules.nested_facts(good)).collect()]
    # a batch that runs again replaces its own rows
    SC.conform_batch(R.read_rtlog(spark, path).limit(0), base, 0)
    first = spark.read.parquet(f"{base}/sa_tran_head/batch_id=0").count()
    assert first == 0


def test_stream_gaps_equal_batch(spark, tmp_path):
    path = land(log(), tmp_path / "in", lines_per_file=3)
    base = str(tmp_path / "gaps")
    heads = R.stream_rtlog(spark, path, 2).select("tran_head.*")
    sinks.run_available(gaps.stream_missing_tran(heads, base), str(tmp_path / "cp"))
    got = sorted(r.tran_no for r in gaps.current_gaps(spark, base).collect())
    want = sorted(r.tran_no for r in sequence.missing_numbers(frame(spark, log()).select("tran_head.*")).collect())
    assert got == want and 6 in got and 39 in got


def test_stream_revisions_continue_numbers(spark, tmp_path):
    path = str(tmp_path / "revs")
    key, order, compare = ["k"], ["update_datetime"], ["s"]
    batches = [
        [(1, "2024-01-01 10:00:00", "A"), (1, "2024-01-01 11:00:00", "B"), (2, "2024-01-01 10:00:00", "X")],
        [(1, "2024-01-02 10:00:00", "B"), (1, "2024-01-02 11:00:00", "C"), (3, "2024-01-02 10:00:00", "N")],
        [(2, "2024-01-03 10:00:00", "Y"), (1, "2024-01-03 11:00:00", "A")],
    ]
    for n, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "k long, t string, s string").selectExpr("k", "s", "cast(t as timestamp) update_datetime")
        for _ in range(2):  # every batch is delivered twice
            revisions.revision_batch(df, path, n, key, order, F.to_date("update_datetime"), compare)
    got = sorted((r.k, r.rev_no, r.s) for r in revisions.read_revisions(spark, path).collect())
    assert got == [(1, 0, "A"), (1, 1, "B"), (1, 2, "C"), (1, 3, "A"), (2, 0, "X"), (2, 1, "Y"), (3, 0, "N")]


def test_revisions_by_date_read_only_their_dates(spark, tmp_path):
    path = str(tmp_path / "revs")
    key, order = ["business_date", "k"], ["update_datetime"]
    batches = [
        [("2024-01-01", 1, "2024-01-01 10:00:00", "A"), ("2024-01-02", 1, "2024-01-02 10:00:00", "A")],
        [("2024-01-02", 1, "2024-01-03 10:00:00", "B"), ("2024-01-02", 2, "2024-01-03 11:00:00", "C")],
    ]
    for n, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "d string, k long, t string, s string").selectExpr(
            "cast(d as date) business_date", "k", "s", "cast(t as timestamp) update_datetime"
        )
        revisions.revision_batch(
            df, path, n, key, order, F.date_trunc("hour", "update_datetime"), ["s"], "business_date"
        )
    got = sorted((str(r.business_date), r.k, r.rev_no, r.s) for r in revisions.read_revisions(spark, path).collect())
    assert got == [("2024-01-01", 1, 0, "A"), ("2024-01-02", 1, 0, "A"), ("2024-01-02", 1, 1, "B"), ("2024-01-02", 2, 0, "C")]


def test_hourly_sales_and_dedup(spark, tmp_path):
    recs = log()
    path = land(recs + recs[:5], tmp_path / "in", lines_per_file=2)
    stream = R.stream_rtlog(spark, path, 4)
    keyed = conform.with_keys(stream).select("record_key", "tran_head.*")
    once = windows.stream_dedup(windows.event_time(keyed), "event_ts")
    sinks.run_available(
        once.select("record_key").writeStream.format("parquet").option("path", str(tmp_path / "d")), str(tmp_path / "cp1")
    )
    assert spark.read.parquet(str(tmp_path / "d")).count() == len(recs)
    agg = windows.hourly_sales(windows.event_time(R.stream_rtlog(spark, path, 4).select("tran_head.*")), "event_ts")
    sinks.run_available(windows.write_hourly(agg, str(tmp_path / "h")), str(tmp_path / "cp2"))
    table = windows.latest_hourly(spark, str(tmp_path / "h"))
    assert table.agg(F.sum("n_trans")).first()[0] == len(recs) + 5
    sales = sum(r["tran_head"]["value"] for r in recs + recs[:5] if r["tran_head"]["tran_type"] == "SALE")
    assert float(table.agg(F.sum("sales")).first()[0]) == sales
