"""Skew-safe helpers against brute force, with one group holding most rows."""

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tillwarden.operators import sampling, sequence, spread


def skewed(spark, n=3000, seed=5):
    rng = random.Random(seed)
    rows = [(("hot" if rng.random() < 0.4 else f"k{rng.randint(0, 900)}"), rng.randint(0, 5000), i) for i in range(n)]
    rows += [(None, 1, n), (None, 1, n + 1), (None, 7, n + 2)]
    return rows, spark.createDataFrame(rows, "k string, v long, id long").repartition(4)


def test_repeated_key(spark):
    rows, df = skewed(spark)
    counts = Counter(r[0] for r in rows)
    want = sorted(((r[2], counts[r[0]]) for r in rows if counts[r[0]] > 1))
    got = sorted((r.id, r.n_rows) for r in spread.with_repeated_key(df, ["k"]).collect())
    assert got == want


def test_repeated_key_shuffled_join_keeps_the_salt(spark):
    rows, df = skewed(spark)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = spread.with_repeated_key(df, ["k"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        salted = [x for x in plan.splitlines() if "hashpartitioning" in x and "_salt" in x]
        assert len(salted) >= 2, plan
        counts = Counter(r[0] for r in rows)
        assert sorted((r.id, r.n_rows) for r in out.collect()) == sorted(
            (r[2], counts[r[0]]) for r in rows if counts[r[0]] > 1
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_row_number_and_previous(spark):
    rows, df = skewed(spark)
    groups = defaultdict(list)
    for k, v, i in rows:
        groups[k].append((v, i))
    want_no, want_prev = {}, {}
    for g in groups.values():
        prev = None
        for n, (v, i) in enumerate(sorted(g), start=1):
            want_no[i], want_prev[i] = n, prev
            prev = v
    bucket = F.floor(F.col("v") / 64)
    got = spread.with_row_number(df, ["k"], [F.col("v"), F.col("id")], bucket).collect()
    assert {r.id: r.row_no for r in got} == want_no
    got = spread.with_previous(df, ["k"], ["v", "id"], bucket, F.col("v"), "p").collect()
    assert {r.id: r.p for r in got} == want_prev


def test_row_number_without_a_bucket(spark):
    """Even ranges cut through one huge group and through ties."""
    rows = [("hot", n % 3, n) for n in range(2000)] + [("b", 5, 1), (None, 1, 2)]
    df = spark.createDataFrame(rows, "k string, v long, id long").repartition(4)
    got = spread.with_row_number(df, ["k"], [F.col("v")]).collect()
    by_key = defaultdict(list)
    for r in got:
        by_key[r.k].append((r.row_no, r.v))
    assert {k: len(x) for k, x in by_key.items()} == {"hot": 2000, "b": 1, None: 1}
    for x in by_key.values():
        x.sort()
        assert [n for n, _ in x] == list(range(1, len(x) + 1))
        assert [v for _, v in x] == sorted(v for _, v in x)


def test_missing_numbers_across_ranges(spark):
    have = {("a", n) for n in range(1, 12000) if n % 7 and not 4000 < n < 8500} | {("b", 3), (None, 2), ("c", 1)}
    df = spark.createDataFrame([*have, ("a", 1), ("b", None)], "k string, tran_no long")
    got = {tuple(r) for r in sequence.missing_numbers(df, ["k"]).collect()}
    want = set()
    for k in ("a", "b", "c", None):
        nos = {n for kk, n in have if kk == k}
        want |= {(k, n) for n in range(1, max(nos) + 1) if n not in nos}
    # the numbers of opening and closing records never count as present
    want |= {("a", n) for n in (9000, 9999)}
    assert got == want


def test_gap_example(spark):
    df = spark.createDataFrame([(n, "SALE") for n in (1, 2, 4, 5)] + [(9000, "OPEN"), (9999, "CLOSE")], "tran_no long, tran_type string")
    df = df.withColumns({"store": F.lit(1), "register": F.lit("TILL01"), "business_date": F.lit("2024-03-15").cast("date")})
    assert [r.tran_no for r in sequence.missing_numbers(df).collect()] == [3]


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(0, 1234).repartition(3)
    for rate, n in ((0.0, 0), (0.02, 25), (0.5, 617), (1.0, 1234)):
        a = {r.id for r in sampling.sample_exact(df, ["id"], rate, seed=3).collect()}
        b = {r.id for r in sampling.sample_exact(df.repartition(5), ["id"], rate, seed=3).collect()}
        assert len(a) == n and a == b
    # half to even
    assert sampling.sample_exact(spark.range(0, 25), ["id"], 0.1).count() == 2
    assert sampling.sample_exact(spark.range(0, 35), ["id"], 0.1).count() == 4
    assert sampling.sample_exact(spark.range(0), ["id"], 0.1).count() == 0


def test_round_robin_is_even(spark):
    got = Counter(r.label for r in sampling.assign_round_robin(spark.range(0, 100), ["id"], list("ABCDEF")).collect())
    assert sum(got.values()) == 100 and max(got.values()) - min(got.values()) <= 1


def test_revisions(spark):
    rows = [(1, "2024-01-01 10:00:00", "A"), (1, "2024-01-01 11:00:00", "A"), (1, "2024-01-02 09:00:00", "B"),
            (1, "2024-01-04 09:00:00", "B"), (1, "2024-01-05 09:00:00", "A"), (2, "2024-01-03 09:00:00", None)]
    df = spark.createDataFrame(rows, "k long, t string, s string").withColumn("update_datetime", F.col("t").cast("timestamp"))
    revs = sequence.head_revisions(df, ["k"], ["update_datetime"], F.to_date("update_datetime"), ["s"])
    assert sorted((r.k, r.rev_no, r.s) for r in revs.collect() if r.k == 1) == [(1, 0, "A"), (1, 1, "B"), (1, 2, "A")]
    assert [(r.rev_no, r.s) for r in revs.collect() if r.k == 2] == [(0, None)]
    at = F.lit("2024-01-03 00:00:00").cast("timestamp")
    state = sequence.as_of_revision(revs, ["k"], at, ["rev_no"]).collect()
    assert [(r.k, r.s) for r in state] == [(1, "B")]


def test_short_histories_are_shuffled_once_and_long_ones_bucketed(spark, monkeypatch):
    rng = random.Random(11)
    rows = [(k, n, rng.choice(["A", "B", None])) for k in ("x", "y", None) for n in range(40)] + [("long", n, "AB"[n // 3 % 2]) for n in range(400)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, n long, s string").repartition(3)

    def revisions():
        return sequence.head_revisions(df, ["k"], ["n"], F.floor(F.col("n") / 8), ["s"])

    want = {}
    for key in ("x", "y", None, "long"):
        own, before = sorted((n, s) for k, n, s in rows if k == key), ()
        for n, s in own:
            if (s,) != before:
                want[key, n] = (s, sum(k == key for k, _ in want))
            before = (s,)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = revisions()._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1, plan
        assert {(r.k, r.n): (r.s, r.rev_no) for r in revisions().collect()} == want
        monkeypatch.setattr(spread, "SLOTS", 64)
        monkeypatch.setattr(spread, "GROUP_ROWS", 150)
        few, many = spread.split_by_size(df, ["k"])
        assert many.filter("k = 'long'").count() == 400 and few.count() + many.count() == len(rows)
        assert {(r.k, r.n): (r.s, r.rev_no) for r in revisions().collect()} == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_long_gaps_are_intervals_and_are_written_out_by_many_tasks(spark, monkeypatch):
    top = 20_000_002
    df = spark.createDataFrame([("a", 1), ("a", top), ("b", 3), ("b", 3), ("b", 4100), (None, 2)], "k string, n long")
    gaps = {tuple(r) for r in sequence.gap_intervals(df, ["k"], "n", exclude_numbers=()).collect()}
    assert gaps == {("a", 2, top - 1), ("b", 1, 2), ("b", 4, 4099), (None, 1, 1)}
    rows = sequence.missing_numbers(df, ["k"], "n", exclude_numbers=())
    tasks = rows.filter("k = 'a'").groupBy(F.spark_partition_id()).agg(F.count("n"), F.min("n"), F.max("n")).collect()
    assert sum(t[1] for t in tasks) == top - 2 and min(t[2] for t in tasks) == 2 and max(t[3] for t in tasks) == top - 1
    assert len(tasks) > 1 and max(t[1] for t in tasks) < top / 2
    monkeypatch.setattr(sequence, "PIECE", 7)
    monkeypatch.setattr(sequence, "SPAN", 49)
    rows = sequence.missing_numbers(df.filter("k = 'b'"), ["k"], "n", exclude_numbers=())
    assert sorted(r.n for r in rows.collect()) == [1, 2, *range(4, 4100)]


def test_rows_are_shuffled_once_for_join_and_window(spark):
    rows = [(g, n) for g in ("a", None) for n in range(50)] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, n long").repartition(3)
    with_no = spread.with_row_number(df, ["g"], [F.col("n")], F.floor(F.col("n") / 8))
    lagged = spread.with_previous(df, ["g"], ["n"], F.floor(F.col("n") / 8), F.col("n"), "p")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for out in (with_no, lagged):
            plan = out.select("*")._jdf.queryExecution().executedPlan().toString()
            # the rows once, the buckets once or twice
            assert plan.count("Exchange hashpartitioning") <= 4, plan
        got = {(r.g, r.n): r.row_no for r in with_no.select("*").collect()}
        before = {(r.g, r.n): r.p for r in lagged.select("*").collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(got) == 101 and got[("a", None)] == 1 and got[("a", 0)] == 2 and got[(None, 49)] == 50
    assert before[("a", 0)] is None and before[(None, 0)] is None
    assert all(before[(g, n)] == n - 1 for g in ("a", None) for n in range(1, 50))
