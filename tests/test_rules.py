"""Every rule: clean records give no hits; each fault gives its own hit only."""

import copy

from pyspark.sql import functions as F

from records import bare, frame, record
from tillwarden.functions import rawjson
from tillwarden.operators import audit, conform, rules
from tillwarden import reference as ref


def hits(spark, records, **kw):
    rows = audit.audit_nested(frame(spark, records), **kw).select("error_code", "tran_seq_no").collect()
    return sorted((r[0], r[1]) for r in rows)


def clean_day():
    return [
        bare(9000, "OPEN", tran_datetime="2024-03-15T06:05:00+05:30"),
        *[record(n) for n in range(1, 6)],
        bare(6, "NOSALE"),
        bare(9999, "CLOSE", tran_datetime="2024-03-15T22:05:00+05:30"),
    ]


def test_clean_records_have_no_hits(spark):
    assert hits(spark, clean_day()) == []


def edit(fn):
    r = record(7)
    fn(r)
    return r


def set_head(**kw):
    return lambda r: r["tran_head"].update(kw)


def set_item(**kw):
    return lambda r: r["tran_item"][0].update(kw)


def set_tender(**kw):
    return lambda r: r["tran_tender"][0].update(kw)


def wrong_sequence(r):
    r["tran_item"][0]["item_seq_no"] = 2


def both_taxes(r):
    r["tran_tax"] = [{"tax_code": "GSTTOT", "tax_seq_no": 1, "tax_amt": 1.0, "error_ind": "N"}]


FAULTS = [
    ("MISSING_TENDER", lambda r: r.update(tran_tender=[])),
    ("TENDER_VAR_GT_01", set_tender(tender_amt=1598.02, orig_curr_amt=1598.02)),
    ("VOID_OOH", set_head(tran_type="PVOID", tran_datetime="2024-03-15T02:00:00+05:30")),
    ("VOID_OOH", set_head(tran_type="PVOID", tran_datetime="2024-03-15T23:00:00+05:30")),
    ("CC_NOT_MASKED", set_tender(cc_no="4111111111111234")),
    ("CHANNEL_INVALID", lambda r: r.update(rtlog_orig_sys="OMS")),
    ("CODE_INVALID", set_item(item_status="LOST")),
    ("CODE_INVALID", set_head(status="DONE")),
    ("IND_INVALID", set_item(tax_ind="true")),
    ("IND_INVALID", set_head(error_ind=None)),
    ("ITEM_SEQ_GAP", wrong_sequence),
    ("POS_DROP_SHIP", set_item(drop_ship_ind="Y")),
    ("TAX_MODE_MIX", both_taxes),
    ("VALUE_MISMATCH", set_item(unit_retail=800.0)),
    ("SEQ_FORMAT", set_head(tran_seq_no="STR001-TILL02-2024-03-15-000077")),
    ("BANNER_INVALID", set_head(banner_no=2)),
    ("CURR_AMT_MISMATCH", set_tender(orig_curr_amt=1.0)),
]


def test_each_fault_gives_exactly_its_hit(spark):
    """One faulty record per entry among clean ones; nothing else may be reported."""
    bad, want = [], []
    for n, (code, fault) in enumerate(FAULTS, start=10):
        r = record(n)
        fault(r)
        r["tran_head"]["cashier"] = f"F{n}"
        bad.append(r)
        want.append((code, f"F{n}"))
    df = frame(spark, clean_day() + bad)
    who = conform.heads(df).select("record_key", "cashier")
    found = audit.audit_nested(df).select("record_key", "error_code").join(who, "record_key")
    assert sorted((r.error_code, r.cashier) for r in found.collect()) == sorted(want)


def test_negative_quantity_without_reason(spark):
    def fault(r):
        r["tran_item"][0].update(qty=-2.0, uom_quantity=-2.0)
        r["tran_head"]["value"] = 0.0
        r["tran_tender"] = []

    bad = edit(fault)
    assert hits(spark, [bad]) == [("NEG_QTY_NO_REF", bad["tran_head"]["tran_seq_no"])]
    ret = edit(fault)
    ret["tran_head"]["tran_type"] = "RETURN"
    ret["tran_item"][0]["return_reason_code"] = "CUST"
    assert hits(spark, [ret]) == []


def test_tender_tolerance_is_exclusive(spark):
    ok = edit(set_tender(tender_amt=1598.01, orig_curr_amt=1598.01))
    assert hits(spark, [ok]) == []


def test_void_inside_hours_is_fine(spark):
    ok = [
        edit(set_head(tran_type="PVOID", tran_datetime=f"2024-03-15T{h}:00:00+05:30")) for h in ("06", "22")
    ]
    ok[1]["tran_head"].update(tran_no=8, tran_seq_no="STR001-TILL01-2024-03-15-000008")
    assert hits(spark, ok) == []


def test_sale_without_items(spark):
    bad = bare(3, "SALE")
    assert hits(spark, [bad]) == [("SALE_NO_ITEM", bad["tran_head"]["tran_seq_no"])]


def test_price_not_positive(spark):
    bad = edit(set_item(unit_retail=0.0))
    bad["tran_head"]["value"] = 0.0
    bad["tran_tender"] = []
    assert [h[0] for h in hits(spark, [bad])] == ["RETAIL_NOT_POSITIVE"]


def test_paid_in_shape(spark):
    good = bare(3, "PAIDIN")
    good["tran_head"].update(value=500.0, pos_tran_ind="N", vendor_no="VND123")
    good["tran_tender"] = [dict(record()["tran_tender"][0], tender_type_group="CASH", tender_type_id=1,
                                cc_no=None, tender_amt=500.0, orig_curr_amt=500.0)]
    assert hits(spark, [good]) == []
    for change in ({"vendor_no": None}, {"pos_tran_ind": "Y"}):
        bad = copy.deepcopy(good)
        bad["tran_head"].update(change)
        assert [h[0] for h in hits(spark, [bad])] == ["PAIDIO_SHAPE"]


def test_duplicate_numbers_are_per_day(spark):
    a, b = record(5), record(5, tran_datetime="2024-03-15T13:00:00+05:30")
    assert [h[0] for h in hits(spark, [a, b])] == ["TRAN_NO_DUP"] * 2 + ["TRAN_SEQ_DUP"] * 2
    other_day = record(5, business_date="2024-03-16", tran_datetime="2024-03-16T13:00:00+05:30")
    assert hits(spark, [a, other_day]) == []


def test_partition_mismatch_needs_partition_columns(spark):
    df = frame(spark, [record(1)])
    filed = df.withColumns({"store": F.lit(1), "date": F.lit("2024-03-15").cast("date"), "hour": F.lit(12)})
    wrong = filed.withColumn("hour", F.lit(13))
    rule = [rules.RULES["PARTITION_MISMATCH"]]
    assert rules.run_rules(rules.nested_facts(df), None).count() == 0
    assert rules.run_rules(rules.nested_facts(filed), rule).count() == 0
    assert rules.run_rules(rules.nested_facts(wrong), rule).count() == 1


def many_faulty_lines(r):
    """Item 1 and two items without a number, two open cards of which one has no number, a bad flag on a tax line."""
    first = r["tran_item"][0]
    first.update(tax_ind="1", unit_retail=0.0)
    r["tran_item"] += [dict(first, item_seq_no=None), dict(first, item_seq_no=None)]
    card = r["tran_tender"][0]
    card["cc_no"] = "4111111111111111"
    r["tran_tender"].append(dict(card, tender_seq_no=None, cc_no="4222222222222222"))
    r["tran_igtax"] = [dict(t, error_ind="?") if t["igtax_seq_no"] == 2 else t for t in r["tran_igtax"]]


def test_every_offending_line_has_an_error_row(spark):
    df = frame(spark, [edit(many_faulty_lines)])
    found = audit.audit_nested(df)
    rows = sorted(
        ((r.error_code, r.key_value_1, r.key_value_2, r.orig_value, r.section) for r in found.collect() if r.section), key=repr
    )
    want = [("RETAIL_NOT_POSITIVE", n, None, "0.0000", "tran_item") for n in (1, None, None)]
    want += [("IND_INVALID", n, None, "tax_ind=1", "tran_item") for n in (1, None, None)]
    want += [("IND_INVALID", 1, 2, "error_ind=?", "tran_igtax")]
    want += [("CC_NOT_MASKED", n, None, None, "tran_tender") for n in (1, None)]
    assert rows == sorted(want, key=repr)
    errors = audit.build_sa_error(found.unionByName(found))  # delivered twice: copies of an error are one row
    assert errors.count() == found.count() == errors.select("error_seq_no").distinct().count()
    lines = errors.filter("error_code = 'RETAIL_NOT_POSITIVE'").collect()
    assert sorted((r.key_value_1, r.key_value_2) for r in lines if r.key_value_1) == [(1, None)] and len(lines) == 3
    assert {r.orig_cc_no for r in errors.filter("error_code = 'CC_NOT_MASKED'").collect()} == {
        "************1111", "************2222"
    }


def test_amount_in_another_currency_is_no_mismatch(spark):
    def foreign(r):
        r["tran_tender"][0].update(orig_currency="USD", orig_curr_amt=19.0)

    stores = spark.createDataFrame([(1, "USD"), (1, "USD"), (2, "INR")], "store_no long, local_currency string")
    df = frame(spark, [edit(foreign)])
    assert hits(spark, [edit(foreign)]) == []  # the default currency is another one
    assert [h[0] for h in hits(spark, [edit(foreign)], stores=stores)] == ["CURR_AMT_MISMATCH"]
    home = edit(set_tender(orig_curr_amt=19.0))
    assert [h[0] for h in hits(spark, [home])] == ["CURR_AMT_MISMATCH"] and hits(spark, [home], stores=stores) == []
    assert rules.nested_facts(df, stores).count() == 1


def test_header_without_a_value_agrees_with_nothing(spark):
    assert [h[0] for h in hits(spark, [edit(set_head(value=None))])] == ["TENDER_VAR_GT_01", "VALUE_MISMATCH"]


def all_hits(spark, records, **kw):
    df = frame(spark, records)
    rows = audit.audit_all(df, ref.products(spark), ref.promotions(spark), **kw).collect()
    return sorted(((r.error_code, r.key_value_1, r.key_value_2, r.orig_value, r.section) for r in rows), key=repr)


def test_checks_on_sets_are_part_of_all_hits(spark):
    assert all_hits(spark, clean_day()) == []

    def wrong(r):
        r["tran_item"][0].update(item="APP-M-9999", total_igtax_amt=1.0)
        r["tran_tender"][0].update(tender_type_id=1)
        r["tran_disc"] = [
            {"item_seq_no": 1, "discount_seq_no": n, "promotion": 500009, "qty": 0.0, "unit_discount_amt": 5.0, "error_ind": "N"}
            for n in (1, 2)
        ]

    assert all_hits(spark, [edit(wrong)]) == sorted(
        [
            ("DISC_RECALC", 1, 1, "5.0000", "tran_disc"), ("DISC_RECALC", 1, 2, "5.0000", "tran_disc"),
            ("IGTAX_ROLLUP", 1, None, "1.0000", "tran_item"),
            ("REF_DATA_INVALID", 1, 1, "500009", "tran_disc"), ("REF_DATA_INVALID", 1, 2, "500009", "tran_disc"),
            ("REF_DATA_INVALID", 1, None, "APP-M-9999", "tran_item"),
            ("REF_DATA_INVALID", 1, None, "CARD", "tran_tender"),
        ],
        key=repr,
    )
    # a rejected record has no header, so each of its rows is an orphan
    rejected = all_hits(spark, [edit(set_head(error_ind="X"))])
    assert [h for h in rejected if h[0] == "REF_INTEGRITY"] == [
        ("REF_INTEGRITY", 1, 1, None, "tran_igtax"), ("REF_INTEGRITY", 1, 2, None, "tran_igtax"),
        ("REF_INTEGRITY", 1, None, None, "tran_item"), ("REF_INTEGRITY", 1, None, None, "tran_tender"),
    ]


def test_sets_inside_a_record_give_what_joins_give(spark):
    def disc(**kw):
        return {"item_seq_no": 1, "discount_seq_no": 1, "promotion": 500001, "qty": 0.0, "unit_discount_amt": 5.0, "error_ind": "N"} | kw

    def of(n, fault):
        return edit(lambda r: (r["tran_head"].update(cashier=f"C{n}"), fault(r)))

    faults = [
        lambda r: r["tran_item"][0].update(total_igtax_amt=None),
        lambda r: r["tran_item"][0].update(item="APP-M-9999", unit_retail=None),
        lambda r: r["tran_igtax"][1].update(igtax_rate=0.05),
        lambda r: r["tran_igtax"][1].update(item_seq_no=7),
        lambda r: r.update(tran_disc=[disc(), disc(item_seq_no=9, discount_seq_no=2), disc(discount_seq_no=3, promotion=None)]),
        lambda r: r["tran_head"].update(error_ind="X"),
        lambda r: r.update(tran_igtax=None, tran_tender=None),
        # numbers that are missing or repeated
        lambda r: r["tran_item"].append(dict(r["tran_item"][0], item="APP-M-9999")),
        lambda r: r["tran_item"][0].update(item_seq_no=None),
        lambda r: r["tran_igtax"].extend([dict(r["tran_igtax"][0], total_igtax_amt=1.0)] * 2),
        lambda r: (r.update(tran_disc=[disc(), disc()]), r["tran_head"].update(error_ind="X")),
    ]
    df = frame(spark, [of(n, f) for n, f in enumerate(faults)] + clean_day())
    children = {c: audit.typed_children(df, c) for c in ("tran_item", "tran_disc", "tran_tender", "tran_tax", "tran_igtax")}
    accepted = conform.with_keys(df).filter(F.size(conform.rejection_reasons(df)) == 0).select("record_key")
    seeds = ref.products(spark), ref.promotions(spark)
    cols = [*audit.ERROR_KEYS, *audit.HIT_KEYS]

    def shown(hits):
        return sorted(map(tuple, hits.select(*cols).collect()), key=repr)

    want = shown(audit.audit_sets(accepted, children, *seeds))
    assert shown(audit.nested_sets(df, *seeds)) == want and len(want) > 20


def test_sets_need_no_shuffle_and_count_no_copy_twice(spark):
    df = frame(spark, clean_day())
    hits = audit.nested_sets(df, ref.products(spark), ref.promotions(spark))
    assert "Exchange hashpartitioning" not in hits._jdf.queryExecution().executedPlan().toString()
    # the tax lines of both copies were summed up for the item of each
    assert all(code in ("TRAN_NO_DUP", "TRAN_SEQ_DUP") for code, *_ in all_hits(spark, clean_day() * 2))


def test_long_scale_is_found_in_any_notation(spark):
    texts = ["1.00001", "1e-5", "0.1E-4", '"1.00001"', '"\\u0031.\\u0030\\u0030001"', '"\u0661.\u0660\u0660\u0660\u0660\u0661"']
    fine = ["1.50000", "5E-4", "1.0001", "1e5", "null", '"x1.00001"']
    lines = spark.createDataFrame([(f'{{"tran_tender": [{{"tender_amt": {t}}}]}}',) for t in texts + fine], "value string")
    assert [r.b for r in lines.select(rawjson.long_scale("value").alias("b")).collect()] == [True] * 6 + [False] * 6


def test_orphans_with_and_without_a_key(spark):
    head = spark.createDataFrame([("a",), (None,)], "record_key string")
    rows = [("a", 1), ("b", 2), ("b", 2), (None, 3)] + [("hot", n) for n in range(500)]
    items = spark.createDataFrame(rows, "record_key string, item_seq_no long")
    tender = spark.createDataFrame([("a", 1)], "record_key string, tender_seq_no long")
    got = audit.orphan_hits(head, {"tran_item": items, "tran_tender": tender}).collect()
    assert sorted(((r.record_key, r.key_value_1) for r in got), key=repr) == sorted(rows[1:], key=repr)
    both = audit.numbered(audit.orphan_hits(head, {"tran_item": items})).filter("record_key = 'b'").collect()
    assert sorted(r.line for r in both) == [1, 2]


def test_orphans_read_a_child_once(spark):
    head = spark.range(5).select(F.col("id").alias("tran_no"))
    items = spark.range(77).selectExpr("id % 7 as tran_no", "cast(id % 7 as string) as record_key", "id as item_seq_no")
    tender = spark.range(3).selectExpr("id as tran_no", "cast(id as string) as record_key", "id as tender_seq_no")
    hits = audit.orphan_hits(head, {"tran_item": items, "tran_tender": tender}, key="tran_no")
    assert hits._jdf.queryExecution().optimizedPlan().toString().count("Range (0, 77,") == 1
    assert sorted(r.key_value_1 for r in hits.collect()) == [n for n in range(77) if n % 7 > 4]


def test_flat_and_nested_facts_agree(spark):
    recs = clean_day() + [edit(f) for _, f in FAULTS] + [edit(many_faulty_lines)]
    for i, r in enumerate(recs):
        r["tran_head"]["tran_no"] = i + 1
        r["tran_head"]["cashier"] = f"C{i}"
    df = frame(spark, recs)
    nested = rules.run_rules(rules.nested_facts(df))
    head = conform.heads(df).join(
        conform.with_keys(df).select("record_key", F.col("rtlog_orig_sys").alias("record_channel")), "record_key"
    )
    kids = {c: conform.children(df, c).drop("store", "day", "tran_seq_no") for c in
            ("tran_item", "tran_disc", "tran_tender", "tran_tax", "tran_igtax")}
    flat = rules.run_rules(rules.flat_facts(head, kids, ["record_key"]))
    cols = ["record_key", *audit.HIT_KEYS, "orig_cc_no"]
    a = sorted(map(tuple, nested.select(*cols).collect()), key=repr)
    b = sorted(map(tuple, flat.select(*cols).collect()), key=repr)
    assert a == b and len(a) >= len(FAULTS)


def test_own_rule(spark):
    big = rules.Rule("BIG_SALE", lambda: F.col("value") > 1000, orig_value=lambda: F.col("value").cast("string"))
    rows = rules.run_rules(rules.nested_facts(frame(spark, [record(1)])), [big]).collect()
    assert [(r.error_code, r.orig_value) for r in rows] == [("BIG_SALE", "1598.0000")]


def test_error_table_never_stores_an_open_card(spark):
    bad = edit(set_tender(cc_no="4111111111111234"))
    e = audit.build_sa_error(audit.audit_nested(frame(spark, [bad]))).collect()
    assert [r.orig_cc_no for r in e] == ["************1234"]
    assert all("4111111111111234" not in str(r) for r in e)


def test_status_follows_errors(spark):
    recs = clean_day() + [
        edit(set_tender(cc_no="4111111111111234")),
        dict(edit(set_head(tran_type="PVOID", tran_datetime="2024-03-15T02:00:00+05:30"))),
    ]
    recs[-1]["tran_head"].update(tran_no=8, tran_seq_no="STR001-TILL01-2024-03-15-000008")
    df = frame(spark, recs)
    e = audit.build_sa_error(audit.audit_nested(df)).drop("store", "business_date")
    st = audit.advance_status(conform.heads(df), e, ref.error_codes(spark))
    got = {r.tran_no: (r.status, r.error_ind) for r in st.collect()}
    assert got[7] == ("ERRORED", "Y")
    assert got[8] == ("VALIDATED", "Y")
    assert got[1] == ("APPROVED", "N")
    days = audit.advance_audit_status(st).collect()
    assert [d.audit_status for d in days] == ["INPROGRESS"]
    # an override by head office unblocks the record
    over = audit.advance_status(conform.heads(df), e.withColumn("hq_override_ind", F.lit("Y")), ref.error_codes(spark))
    assert {r.status for r in over.collect()} == {"APPROVED", "VALIDATED"}
    assert [d.audit_status for d in audit.advance_audit_status(over, post=True).collect()] == ["POSTED"]


def test_faulty_lines_without_a_number_are_reported(spark):
    def faults(r):
        r["tran_item"][0].update(item_seq_no=None, unit_retail=None)
        r["tran_tender"][0].update(tender_seq_no=None, cc_no="4111111111111111")

    codes = {c for c, _ in hits(spark, [edit(faults)])}
    assert {"RETAIL_NOT_POSITIVE", "CC_NOT_MASKED"} <= codes


def test_sale_without_value_and_tender_is_reported(spark):
    def faults(r):
        r["tran_head"]["value"] = None
        r["tran_tender"] = []

    assert "MISSING_TENDER" in {c for c, _ in hits(spark, [edit(faults)])}


def test_card_shown_is_that_of_the_line_named(spark):
    def faults(r):
        first = dict(r["tran_tender"][0], tender_seq_no=2, cc_no="4222222222222222", tender_amt=0.0, orig_curr_amt=0.0)
        r["tran_tender"][0]["cc_no"] = "4111111111111111"
        r["tran_tender"].insert(0, first)

    row = audit.audit_nested(frame(spark, [edit(faults)])).filter("error_code = 'CC_NOT_MASKED'").first()
    assert row.key_value_1 == 1 and row.orig_cc_no.endswith("1111")


def test_tax_numbers_are_unique_with_repeated_items(spark):
    from tillwarden.operators import tax

    items = spark.createDataFrame(
        [(1, 1, 2.0, 10.0), (1, 1, 1.0, 5.0), (1, 3, 1.0, 7.0)], "tran_no long, item_seq_no long, qty double, unit_retail double"
    ).withColumns({"qty": F.col("qty").cast("decimal(12,4)"), "unit_retail": F.col("unit_retail").cast("decimal(20,4)")})
    lines = tax.igtax_lines(items, ["tran_no"]).collect()
    assert sorted(r.igtax_seq_no for r in lines) == [1, 2, 3, 4, 5, 6]
    assert sorted(r.tax_seq_no for r in tax.additive_tax_lines(items, ["tran_no"]).collect()) == [1, 2, 3]
