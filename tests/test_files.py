"""Readers, writers, landing and the conforming of records."""

import hashlib
import json
import time

from pyspark.sql import functions as F

from records import bare, frame, land, record
from tillwarden import reference as ref, schemas
from tillwarden.functions import calendar as C, checks, keys as K, money as M, rawjson
from tillwarden.operators import conform, joins, tax, totals
from tillwarden.plans import nightly
from tillwarden.sources import canonical, landing, registry, rtlog as R


def some_records():
    return [
        bare(9000, "OPEN", tran_datetime="2024-03-15T06:05:00+05:30"),
        record(1), record(2, ref_no1="LOYALTY-çé"), record(3, store=5, tran_datetime="2024-03-15T02:10:00+05:30"),
    ]


def test_canonical_widths(spark):
    want = {"sa_store_day": 13, "sa_tran_head": 39, "sa_tran_item": 51, "sa_tran_disc": 22, "sa_tran_tender": 29,
            "sa_tran_tax": 11, "sa_tran_igtax": 16, "sa_missing_tran": 6, "sa_error": 17, "sa_error_codes": 12,
            "sa_total_head": 31, "sa_tran_head_rev": 39}
    assert {t: len(schemas.table_columns(t)) for t in schemas.table_names()} == want
    assert schemas.primary_key("sa_tran_head_rev") == ["store", "day", "tran_seq_no", "rev_no"]
    assert [len(schemas.struct_of(d).fields) for d in (schemas.HEAD_DDL, schemas.ITEM_DDL, schemas.DISC_DDL,
            schemas.TENDER_DDL, schemas.TAX_DDL, schemas.IGTAX_DDL)] == [29, 21, 11, 11, 4, 7]


def test_read_keeps_unreadable_lines_and_prunes_folders(spark, tmp_path):
    path = land(some_records(), tmp_path)
    d = tmp_path / "store=1" / "date=2024-03-15" / "hour=12"
    (d / "broken.json").write_text('{"rtlog_orig_sys": "POS", "tran_head": {\n{"tran_head": {"tran_no": "x"}}\n')
    df = R.read_rtlog(spark, path)
    assert df.count() == 6
    # the verdict does not depend on the columns a query asks for
    assert df.filter("_corrupt is not null").select("_corrupt").distinct().count() == 2
    assert df.filter("_corrupt is not null").select("rtlog_orig_sys").count() == 2
    plan = df.filter("store = 5 and hour = '02'").select("tran_head.value")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(store" in plan
    good, bad = conform.quarantine(df)
    assert good.count() == 4 and bad.count() == 2
    assert all(r.rejection_reason.startswith("MALFORMED_RECORD") for r in bad.collect())


def test_write_replaces_touched_folders_only_and_keeps_nulls(spark, tmp_path):
    out = str(tmp_path / "log")
    R.write_rtlog(frame(spark, some_records()), out)
    assert (tmp_path / "log" / "store=1" / "date=2024-03-15" / "hour=06").is_dir()
    assert R.count_lines(spark, out).first().n_lines == 4
    R.write_rtlog(frame(spark, [record(7)]), out)  # replaces the folder of hour 12 only
    assert R.count_lines(spark, out).first().n_lines == 3
    R.write_rtlog(frame(spark, [record(8)]), out, append=True)
    assert R.count_lines(spark, out).first().n_lines == 4
    lines = [json.loads(x) for f in (tmp_path / "log").rglob("*.json") for x in f.read_text().splitlines()]
    assert all(set(x) == set(schemas.RECORD_KEYS) for x in lines)
    assert all("vendor_no" in x["tran_head"] and x["tran_head"]["vendor_no"] is None for x in lines)
    items = [i for x in lines for i in x["tran_item"]]
    assert items and all("class" in i and "class_" not in i for i in items)
    back = R.read_rtlog(spark, out)
    assert sorted(r.n for r in back.select(F.col("tran_head.tran_no").alias("n")).collect()) == [3, 7, 8, 9000]


def test_partition_counts_match_lines(spark):
    counts = {(r.store, r.hour): r.n_records for r in R.partition_counts(frame(spark, some_records())).collect()}
    assert counts == {(1, "06"): 1, (1, "12"): 2, (5, "02"): 1}


def test_raw_lines_and_absent_keys(spark, tmp_path):
    r = record(1)
    del r["tran_head"]["vendor_no"]
    del r["tran_tax"]
    r["tran_head"]["value"] = 1598.00001
    raw = R.read_rtlog_raw(spark, land([r, record(2)], tmp_path))
    got = raw.select(
        rawjson.absent_keys("value").alias("top"), rawjson.absent_keys("value", "tran_head").alias("head"),
        rawjson.null_keys("value", "tran_head").alias("nulls"), rawjson.long_scale("value").alias("long"),
    ).collect()
    got = sorted(got, key=lambda x: -len(x.top))
    assert got[0].top == ["tran_tax"] and got[0].head == ["vendor_no"] and got[0].long
    assert got[1].top == [] and got[1].head == [] and not got[1].long
    assert "vendor_no" in got[1].nulls and "vendor_no" not in got[0].nulls


def test_fan_out_and_nest_again(spark):
    df = frame(spark, some_records())
    tables = conform.fan_out(df)
    assert {n: t.count() for n, t in tables.items()} == {
        "sa_tran_head": 4, "sa_tran_item": 3, "sa_tran_disc": 0, "sa_tran_tender": 3, "sa_tran_tax": 0, "sa_tran_igtax": 6,
    }
    for name, t in tables.items():
        want = [c.name for c in schemas.table_columns(name)]
        assert t.columns[: len(want)] == want
    kids = {c: conform.children(df, c) for c in schemas.CHILDREN}
    back = conform.nest_rtlog(conform.heads(df), kids)
    cols = schemas.RECORD_KEYS
    as_json = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    assert sorted(r[0] for r in back.select(as_json).collect()) == sorted(r[0] for r in df.select(as_json).collect())


def test_long_transaction_is_one_record(spark):
    n = 10_050
    items = spark.range(1, n + 1).select(F.lit("k").alias("record_key"), F.col("id").alias("item_seq_no"))
    head = spark.createDataFrame([("k", "POS", 1), ("e", "POS", 2)], "record_key string, rtlog_orig_sys string, tran_no long")
    out = conform.nest_rtlog(head, {"tran_item": items}).collect()
    assert sorted((r.tran_head.tran_no, r.n_aside, len(r.tran_item)) for r in out) == [(1, 0, n), (2, 0, 0)]
    assert [x.item_seq_no for r in out for x in r.tran_item] == list(range(1, n + 1))


def test_lines_beyond_the_bound_stand_aside(spark):
    """Null and repeated numbers, rows without a key, two numbers in the order of a child."""
    ddl = "record_key string, item_seq_no int, discount_seq_no int"
    lines = [("k", i % 7 or None, i // 7) for i in range(60)] + [("k", 3, 1)] * 40 + [("short", None, None)] * 5
    discs = spark.createDataFrame([*lines, *[(None, 1, 1)] * 30], ddl)
    items = spark.createDataFrame([("k", i) for i in range(1, 23)], "record_key string, item_seq_no int")
    head = spark.createDataFrame([("k", "POS", 1), ("short", "OMS", 2)], "record_key string, rtlog_orig_sys string, tran_no long")
    kids = {"tran_disc": discs, "tran_item": items}
    records = {r.record_key: r for r in conform.nest_rtlog(head, kids, most=20).collect()}
    aside = {c: sorted(df.collect(), key=lambda r: r.place) for c, df in conform.nest_overflow(kids, most=20).items()}
    assert len(records) == 2 and records["k"].n_aside == 82 and records["short"].n_aside == 0
    assert len(records["short"].tran_disc) == 5
    assert [r.place for r in aside["tran_disc"]] == list(range(21, 101))
    assert [(r.place, r.item_seq_no) for r in aside["tran_item"]] == [(21, 21), (22, 22)]
    number = lambda x: (x.item_seq_no, x.discount_seq_no)
    got = [number(x) for x in [*records["k"].tran_disc, *aside["tran_disc"]]]
    assert got == sorted((x[1:] for x in lines if x[0] == "k"), key=lambda x: (x[0] or 0, x[1]))


def test_store_registry(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "store_no,store_name,tills,country,local_currency,exchange_rate_to_usd\n"
        "33487, South Mall ,20,India, INR ,84.50\n70001,West,25,USA,USD,1.00\n70001,West,26,USA,USD,1.00\n"
    )
    path = str(tmp_path / "s.csv")
    stores = {r.store_no: r for r in registry.read_stores(spark, path).collect()}
    assert stores[33487].store_name == "South Mall" and stores[33487].local_currency == "INR"
    assert stores[70001].tills == 26 and len(stores) == 2
    rep = registry.repeated_stores(registry.read_stores_all(spark, path)).collect()
    assert [(r.store_no, r.n_rows) for r in rep] == [(70001, 2)]
    heads = spark.createDataFrame([(70001, 1), (4, 2)], "store long, tran_no long")
    rich = {r.store: r for r in joins.enrich_store(heads, registry.read_stores(spark, path)).collect()}
    assert (rich[70001].tills, rich[70001].local_currency, rich[70001].inv_store_ind) == (26, "USD", "N")
    assert (rich[4].tills, rich[4].local_currency, rich[4].inv_store_ind) == (4, "INR", "Y")


def test_landing_is_safe_to_repeat(spark, tmp_path):
    path = str(tmp_path / "bronze")
    a = spark.createDataFrame([("x", 1), ("y", 2), ("y", 2)], "record_key string, v int")
    landing.land_bronze(a, path, "2024-01-01")
    landing.land_bronze(a.unionByName(spark.createDataFrame([("z", 3)], a.schema)), path, "2024-01-02")
    rows = sorted((r.record_key, str(r.ingest_date)) for r in spark.read.parquet(path).collect())
    assert rows == [("x", "2024-01-01"), ("y", "2024-01-01"), ("z", "2024-01-02")]


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_scalar_functions(spark):
    day = lambda s: F.lit(s).cast("date")
    r = one(
        spark,
        K.build_tran_seq_no(F.lit(45), F.lit("TILL02"), day("2024-03-15"), F.lit(1234)).alias("seq"),
        K.parse_tran_seq_no(F.lit("STR045-TILL02-2024-03-15-001234")).alias("parts"),
        K.parse_tran_seq_no(F.lit("nonsense")).alias("none"),
        K.replace_seq_number(F.lit("STR045-TILL02-2024-03-15-001234"), F.lit(9)).alias("again"),
        K.wall_hour(F.lit("2024-03-15T23:34:22+05:30")).alias("hour"),
        F.unix_seconds(K.tran_instant(F.lit("2024-03-15T05:30:00+05:30"))).alias("t"),
        checks.mask_pan(F.lit("4111111111111234")).alias("pan"),
        M.round4(F.lit("1.23455").cast("decimal(20,8)")).cast("string").alias("up"),
        M.round4(F.lit("-1.00005").cast("decimal(20,8)")).cast("string").alias("down"),
        M.rate_amount(F.lit(3), F.lit(799), "0.09").cast("string").alias("tax"),
        M.net_value(F.lit(5), F.lit(7)).cast("string").alias("net"),
        C.day_factor(day("2024-11-29")).cast("string").alias("bf"),
        C.day_factor(day("2024-11-22")).cast("string").alias("fri"),
        C.day_factor(day("2024-03-16")).cast("string").alias("sat"),
        M.to_usd(F.lit(845), F.lit("84.50").cast("decimal(10,4)")).cast("string").alias("usd"),
        checks.has_4dp(F.lit("1.23450")).alias("ok4"), checks.has_4dp(F.lit("1.23451")).alias("bad4"),
    )
    assert r.seq == "STR045-TILL02-2024-03-15-001234"
    assert (r.parts.store, r.parts.register, str(r.parts.business_date), r.parts.tran_no) == (45, "TILL02", "2024-03-15", 1234)
    assert r.none.store is None and r.again.endswith("-000009") and r.hour == 23
    assert r.t == 1710460800 and r.pan == "************1234"
    assert (r.up, r.down, r.tax, r.net) == ("1.2346", "-1.0001", "215.7300", "0.0000")
    assert (r.bf, r.fri, r.sat, r.usd) == ("4.80", "1.20", "1.80", "10.0000")
    assert r.ok4 and not r.bad4


def test_tax_modes(spark):
    items = frame(spark, [record(1)]).select(F.lit(1).alias("t"), F.inline("tran_item"))
    for mode, n_tax, n_igtax, flag in (("IGTAX", 0, 2, "Y"), ("TAX", 1, 0, "N"), ("BOTH", 1, 2, "Y")):
        flagged, add, inc = tax.apply_tax_mode(items, ["t"], mode)
        assert (add.count() if add is not None else 0, inc.count() if inc is not None else 0) == (n_tax, n_igtax)
        assert flagged.first().unit_retail_vat_incl == flag
    inc = tax.apply_tax_mode(items, ["t"], "BOTH")[2].orderBy("igtax_seq_no").collect()
    assert [(r.igtax_seq_no, str(r.total_igtax_amt)) for r in inc] == [(1, "143.8200"), (2, "143.8200")]


def test_reference_tables(spark):
    p = ref.products(spark)
    assert p.count() == 75 and p.filter("sku = 'FTW-C-0003'").first().base_price == 1699
    assert ref.error_codes(spark).count() == 27 and len(ref.error_codes(spark).columns) == 12
    assert len(ref.total_heads(spark).columns) == 31
    heads = ref.total_heads(spark)
    assert conform.mandatory_report(heads, "sa_total_head").filter("n_null > 0").count() == 0
    assert conform.mandatory_report(ref.error_codes(spark), "sa_error_codes").filter("n_null > 0").count() == 0


def test_rates_fill_gaps_from_the_last_known_day(spark):
    rates = spark.createDataFrame([("INR", "2024-01-01", "84.5"), ("INR", "2024-01-04", "85.0")], "currency string, d string, r string")
    rates = rates.selectExpr("currency", "cast(d as date) rate_date", "cast(r as decimal(10,4)) rate")
    t = spark.createDataFrame([("INR", d, 2) for d in ("2023-12-31", "2024-01-03", "2024-01-04", "2024-01-09")], "orig_currency string, d string, a int")
    t = t.selectExpr("orig_currency", "cast(d as date) business_date", "cast(a as decimal(20,4)) orig_curr_amt")
    got = {str(r.business_date): r.converted_amt and str(r.converted_amt) for r in joins.fx_by_day(t, rates).collect()}
    assert got == {"2023-12-31": None, "2024-01-03": "169.0000", "2024-01-04": "170.0000", "2024-01-09": "170.0000"}


def test_store_day_closes_with_its_registers(spark):
    recs = [bare(9000, "OPEN"), record(1), bare(9999, "CLOSE"), bare(9000, "OPEN", store=2), record(1, store=2)]
    heads = frame(spark, recs).select("tran_head.*").withColumn("source_file", F.lit("f"))
    stores = spark.createDataFrame([(1, 4, "INR")], "store_no long, tills int, local_currency string")
    days = {r.store: r for r in totals.build_store_day(heads, stores).collect()}
    assert (days[1].store_status, days[1].data_status, days[1].inv_store_ind, days[1].files_loaded) == ("CLOSED", "F", "N", 1)
    assert (days[2].store_status, days[2].data_status, days[2].inv_store_ind) == ("OPEN", "P", "Y")


def test_same_day_number_of_two_years_stays_apart(spark, tmp_path):
    base = str(tmp_path / "canonical")
    for year, no in ((2023, 1), (2024, 2)):
        day = frame(spark, [record(no, business_date=f"{year}-01-05", tran_datetime=f"{year}-01-05T12:00:00+05:30")])
        canonical.write_canonical(conform.fan_out(day), base)
    heads = canonical.read_canonical(spark, base, "sa_tran_head")
    assert sorted((str(r.business_date), r.day) for r in heads.collect()) == [("2023-01-05", 5), ("2024-01-05", 5)]
    kids = {c: canonical.read_canonical(spark, base, f"sa_tran_{c}") for c in ("tender", "igtax")}
    empty = conform.fan_out(frame(spark, [record(1)]))
    sums = totals.calc_totals(heads, kids["tender"], empty["sa_tran_tax"], kids["igtax"], empty["sa_tran_disc"])
    counts = {str(r.business_date): r.total_value for r in sums.filter("total_id = 'TRANCOUNT'").collect()}
    assert counts == {"2023-01-05": 1, "2024-01-05": 1}


def test_nightly_run_takes_plain_deliveries_and_repeats(spark, tmp_path):
    """No discounts and no additive taxes; a file that comes twice; a later record of the same day."""
    base = str(tmp_path / "base")
    stores = spark.createDataFrame([(1, "A", 2, "India", "INR", "84.5")], "store_no long, store_name string, tills int, country string, local_currency string, exchange_rate_to_usd string")
    nightly.run(spark, land([record(1), record(2)], tmp_path / "day1"), base, stores, ingest_date="2024-03-15")
    again = land([record(1), record(2), record(3)], tmp_path / "day2")
    nightly.run(spark, again, base, stores, ingest_date="2024-03-16")
    heads = canonical.read_canonical(spark, base, "sa_tran_head")
    assert sorted(r.tran_no for r in heads.collect()) == [1, 2, 3]
    sums = {r.total_id: r.total_value for r in canonical.read_canonical(spark, base, "totals").collect()}
    assert sums["TRANCOUNT"] == 3 and sums["DISCTOTAL"] == 0
    assert spark.read.parquet(f"{base}/bronze").groupBy("ingest_date").count().count() == 2


def test_nightly_run_keeps_rejects_and_closes_gaps(spark, tmp_path):
    base = str(tmp_path / "base")
    stores = spark.createDataFrame([(1, "A", 2, "India", "INR", "84.5")], "store_no long, store_name string, tills int, country string, local_currency string, exchange_rate_to_usd string")

    def deliver(n, *recs):
        nightly.run(spark, land(list(recs), tmp_path / f"day{n}"), base, stores, ingest_date=f"2024-03-{15 + n}")

    def table(name):
        return canonical.read_canonical(spark, base, name)

    def gaps():
        return sorted(r.tran_no for r in table("sa_missing_tran").filter("store = 1").collect())

    other = record(1, store=2, tran_datetime="2024-03-15T13:00:00+05:30")
    no_tender = record(4, tran_datetime="2024-03-15T14:00:00+05:30")
    no_tender["tran_tender"] = []
    deliver(1, record(1), record(3), no_tender, record(9, error_ind="X"), record(3, store=2))
    assert gaps() == [2] and [r.error_code for r in table("sa_error").filter("store = 1").collect()] == ["MISSING_TENDER"]
    deliver(2, record(2), other)  # the gap of store 1 is closed, store 2 still lacks number 2
    assert gaps() == []
    assert [r.tran_no for r in table("sa_missing_tran").filter("store = 2").collect()] == [2]
    deliver(3, record(8, store=3, error_ind="X", tran_datetime="2024-03-15T15:00:00+05:30"))
    rejected = spark.read.parquet(f"{base}/_quarantine")
    assert sorted((str(r.ingest_date), r.tran_head.tran_no) for r in rejected.collect()) == [("2024-03-16", 9), ("2024-03-18", 8)]
    assert sorted((r.store, r.tran_no) for r in table("sa_tran_head").collect()) == [(1, 1), (1, 2), (1, 3), (1, 4), (2, 1), (2, 3)]
    deliver(3, record(8, store=3, error_ind="X", tran_datetime="2024-03-15T15:00:00+05:30"))  # the same run again
    assert spark.read.parquet(f"{base}/_quarantine").count() == 2


def test_nightly_run_writes_store_days_down_and_drops_its_shuffles(spark, tmp_path, monkeypatch):
    stores = spark.createDataFrame([(1, "A", 2, "India", "INR", "84.5")], "store_no long, store_name string, tills int, country string, local_currency string, exchange_rate_to_usd string")
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}

    given, write = [], canonical.write_canonical
    monkeypatch.setattr(canonical, "write_canonical", lambda *a, **b: given.append(b["touched"]) or write(*a, **b))
    before = shuffles()
    nightly.run(spark, land([record(n) for n in range(1, 6)], tmp_path / "day1"), str(tmp_path / "base"), stores, ingest_date="2024-03-15")
    # the size of a written list is known, so records of any number need no shuffle to meet it
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in given]
    assert len(plans) == 2 and not any("Aggregate" in p for p in plans), plans
    for _ in range(100):
        left = shuffles() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert canonical.read_canonical(spark, str(tmp_path / "base"), "sa_tran_head").count() == 5


def test_packed_keys_come_back(spark):
    digest = hashlib.sha256(b"x").hexdigest()
    texts = [digest, digest.upper(), digest[:-1] + "g", digest + "00", "", "k", "é" * 32, "\x01", None]
    df = spark.createDataFrame([(t,) for t in texts], "k string").withColumn("p", K.packed("k")).withColumn("u", K.unpacked("p"))
    rows = df.collect()
    assert [r.u for r in rows] == texts and len({r.p and bytes(r.p) for r in rows}) == len(texts) and len(rows[0].p) == 33


def test_post_voids_find_originals_of_earlier_days(spark):
    def void(day, number, of, **kw):
        return record(
            number, tran_type="PVOID", business_date=f"2024-03-{day}", tran_datetime=f"2024-03-{day}T12:00:00+05:30",
            orig_reg_no="TILL01", orig_tran_no=of, orig_tran_type="SALE", **kw,
        )

    def sale(day, number):
        return record(number, business_date=f"2024-03-{day}", tran_datetime=f"2024-03-{day}T11:00:00+05:30")

    recs = [sale("10", 1), sale("12", 1), sale("12", 2), sale("12", 2), sale("16", 1)]
    recs += [void("12", 50, 1), void("14", 51, 1), void("14", 52, 1), void("09", 53, 1), void("13", 54, 2), void("13", 55, 7)]
    recs += [void("11", 56, 1, store=2), void("15", 57, None)]
    recs += [sale(f"{d:02d}", 99) for d in range(1, 29)] + [void("15", 60 + n, 99) for n in range(40)]
    out = joins.link_post_void(frame(spark, recs).select("tran_head.*").repartition(5)).collect()
    got = {r.tran_no: (str(r.original_date), r.n_originals, (r.original_id or "")[-17:]) for r in out}
    assert got[50] == got[51] == got[52] == ("2024-03-12", 1, "2024-03-12-000001")
    assert got[54] == ("2024-03-12", 2, "2024-03-12-000002")
    assert got[53] == got[55] == got[56] == got[57] == ("None", 0, "")
    assert {got[60 + n] for n in range(40)} == {("2024-03-15", 1, "2024-03-15-000099")} and len(out) == 48


def test_equal_rows_of_a_file_all_land(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("k,v\n1,x\n1,x\n2,y\n")
    path = str(tmp_path / "bronze")
    for _ in range(2):
        landing.land_csv(spark, str(tmp_path / "in"), "k int, v string", path, "2024-01-01")
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 1, 2]


def test_keys_of_every_element_are_checked(spark, tmp_path):
    r = record(1)
    second = dict(r["tran_item"][0], item_seq_no=2, dept=None)
    del second["class"]
    r["tran_item"].append(second)
    raw = R.read_rtlog_raw(spark, land([r], tmp_path))
    got = raw.select(
        rawjson.absent_keys("value", "tran_item").alias("absent"),
        F.array_contains(rawjson.null_keys("value", "tran_item"), "dept").alias("null_dept"),
        F.array_contains(rawjson.present_keys("value", "tran_item"), "class").alias("has_class"),
    ).first()
    assert got.absent == ["class"] and got.null_dept and not got.has_class


def test_packed_till_log_reads_back_the_same(spark, tmp_path):
    plain, packed = str(tmp_path / "plain"), str(tmp_path / "packed")
    R.write_rtlog(frame(spark, some_records()), plain)
    R.write_rtlog(frame(spark, some_records()), packed, compression="gzip")
    R.write_rtlog(frame(spark, [record(8)]), packed, append=True, compression="gzip")
    assert {f.name.split(".", 1)[1] for f in (tmp_path / "packed").rglob("part-*")} == {"c000.json.gz"}
    assert R.count_lines(spark, packed).first().n_lines == R.count_lines(spark, plain).first().n_lines + 1 == 5
    a, b = R.read_rtlog(spark, plain), R.read_rtlog(spark, packed)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).count() == 1


def test_equal_rows_are_numbered_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "PIECE", 2)
    rows = ['{"a": 1, "x": -0.0}'] * 5 + ['{"a": 1, "x": 0.0}', '{"a": null, "x": null}'] + ['{"a": 2, "x": 1.5}'] * 2
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "d.json").write_text("\n".join(rows) + "\n")
    for day in ("2024-02-01", "2024-02-02"):  # the second delivery adds nothing
        landing.land_json(spark, str(tmp_path / "in"), "a bigint, x double", str(tmp_path / "out"), day)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(str((r.a, r.x)) for r in got) == sorted(["(1, -0.0)"] * 5 + ["(1, 0.0)", "(None, None)"] + ["(2, 1.5)"] * 2)
    assert len({r.record_key for r in got}) == 9


def test_rows_without_copies_are_not_shuffled_on_landing(spark, tmp_path):
    one = spark.createDataFrame([("a", 1), ("b", 2)], "record_key string, n int")
    assert "Exchange" not in landing._once(one)._jdf.queryExecution().executedPlan().toString()
    more = one.unionByName(one.filter("n = 2")).unionByName(spark.createDataFrame([(None, 3)] * 2, one.schema))
    assert sorted(r.n for r in landing._once(more).collect()) == [1, 2, 3]


def test_lines_of_lz4_files_are_read_and_counted(spark, tmp_path):
    packed = str(tmp_path / "lz4")
    R.write_rtlog(frame(spark, some_records()), packed, compression="lz4")
    assert {f.name.split(".", 1)[1] for f in (tmp_path / "lz4").rglob("part-*")} == {"c000.json.lz4"}
    n = len(some_records())
    assert R.count_lines(spark, packed).first().n_lines == n == R.read_rtlog(spark, packed).filter("_corrupt is null").count()
