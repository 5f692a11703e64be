"""Late rows: kept apart, counted, and audited again with their store-day."""

from pyspark.sql import functions as F

from records import frame, record
from tillwarden.plans.catalog import streams
from tillwarden.streaming import late, windows


def heads(spark, recs):
    return windows.event_time(frame(spark, recs).select("tran_head.*"))


def at(day, hour, n, **head):
    return record(n, business_date=f"2024-03-{day:02d}", tran_datetime=f"2024-03-{day:02d}T{hour:02d}:15:00+05:30", **head)


def hours(df):
    return sorted((str(r.business_date), str(r.hour_start), r.n_trans, r.sales) for r in df.collect())


def test_late_rows_are_kept_and_their_days_audited_again(spark, tmp_path):
    path = str(tmp_path)
    batches = [
        [at(10, 9, 1), at(10, 9, 2), at(12, 10, 3)],
        [at(10, 9, 4), at(12, 11, 5)],  # the 10th, 9 o'clock, is 48 hours back: late
        [at(12, 11, 6), at(9, 8, 7, error_ind="?"), at(13, 8, 8)],
    ]
    for n, recs in enumerate(batches):
        for _ in range(2):  # every batch is delivered twice
            late.late_batch(heads(spark, recs), path, n)
    rows = late.late_rows(spark, path).collect()
    assert sorted((r.tran_no, r.batch_id) for r in rows) == [(4, 1), (7, 2)]
    landed = frame(spark, [r for b in batches for r in b])
    truth = hours(late.hourly_by_day(heads(spark, [r for b in batches for r in b])))
    before = hours(late.current_hourly(spark, path))
    assert before != truth and sum(h[2] for h in before) == 6
    assert sorted(str(r.business_date) for r in late.touched_store_days(spark, path).collect()) == ["2024-03-09", "2024-03-10"]
    assert late.reaudit(spark, path, landed) == 0
    assert hours(late.current_hourly(spark, path)) == truth
    assert [(r.error_code, str(r.business_date)) for r in late.current_errors(spark, path).collect()] == [
        ("IND_INVALID", "2024-03-09")
    ]
    assert late.touched_store_days(spark, path).collect() == []
    # a row in time for a day that was audited again is added to it
    late.late_batch(heads(spark, [at(13, 9, 9)]), path, 3)
    batches.append([at(13, 9, 9)])
    assert hours(late.current_hourly(spark, path)) == hours(late.hourly_by_day(heads(spark, [r for b in batches for r in b])))
    # more comes late for a day that was audited again
    late.late_batch(heads(spark, [at(10, 12, 10)]), path, 4)
    assert [str(r.business_date) for r in late.touched_store_days(spark, path).collect()] == ["2024-03-10"]
    everything = [r for b in batches for r in b] + [at(10, 12, 10)]
    assert late.reaudit(spark, path, frame(spark, everything)) == 1
    assert hours(late.current_hourly(spark, path)) == hours(late.hourly_by_day(heads(spark, everything)))


def test_nothing_late_and_rows_without_a_time(spark, tmp_path):
    path = str(tmp_path)
    late.late_batch(heads(spark, [at(10, 9, 1)]), path, 0)
    assert late.touched_store_days(spark, path).collect() == []
    late.reaudit(spark, path, frame(spark, [at(10, 9, 1)]))
    assert sum(r.n_trans for r in late.current_hourly(spark, path).collect()) == 1
    lost = heads(spark, [at(10, 9, 2)]).withColumn("event_ts", F.lit(None).cast("timestamp"))
    late.late_batch(lost, path, 1)
    assert [r.tran_no for r in late.late_rows(spark, path).collect()] == [2]


def test_deliveries_read_the_log_once(spark, monkeypatch):
    log = frame(spark, [at(day, 9, day) for day in (1, 2, 4, 11)])
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(streams.T, "till_log", lambda spark, sf: log.mapInArrow(counted, log.schema))
    path, _ = streams._late_tables(spark, "unused")
    assert seen.value == 4
    # days 1 and 11 come with delivery 3, day 2 with 6 and day 4 with 2: 1 and 2 are late by the clocks of 4 and 11
    assert sorted(r.tran_no for r in late.late_rows(spark, path).collect()) == [1, 2]
