"""Pseudonyms, toxicity, quality, licences and templates: planted cases, plain versions, odd rows."""

import datetime
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwarden.llm import licence_rules as L, pseudonyms as P, quality_rules as Q, templates as T, toxicity as X

KEY = "k"
ODD = [(1, None), (2, ""), (3, "plain words"), (3, "plain words"), (None, "no id"), (4, "x" * 200_000), (5, "a b " * 40_000)]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, 1.0, "c", 2) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, score double, found string, hash int")


# --- pseudonyms


def feistel(left, right, a, b, tweak):
    """The same permutation, plainly."""
    for r in range(P.ROUNDS):
        half = right if r % 2 == 0 else left
        digest = hashlib.sha256(f"{KEY}|{tweak}|{r}|{half}".encode()).hexdigest()
        if r % 2 == 0:
            left = (left + int(digest[:15], 16)) % a
        else:
            right = (right + int(digest[:15], 16)) % b
    return left, right


def luhn(digits):
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits)))
    return -total % 10


def test_permutation_is_one_of_its_domain(spark):
    df = spark.range(35).select(F.floor(F.col("id") / 7).alias("l"), (F.col("id") % 7).alias("r"))
    got = df.select("l", "r", P.permuted(F.col("l"), F.col("r"), 5, 7, KEY, "t").alias("p")).collect()
    assert {(x.p.l, x.p.r) for x in got} == {(i // 7, i % 7) for i in range(35)}
    assert all((x.p.l, x.p.r) == feistel(x.l, x.r, 5, 7, "t") for x in got)


def pseudonyms(spark, *values):
    df = spark.createDataFrame([(i, f"a {v}, b") for i, v in enumerate(values)], "doc_id long, text string")
    rows = P.pseudonymised(df, KEY).orderBy("doc_id").collect()
    return [r.text[2:-3] for r in rows], [r.found for r in rows]


def test_values_keep_their_format_and_check(spark):
    card, account = "4111111111111111", "4111111111111112"
    values = [card, "4111 1111 1111 1111", account, "078-05-1120", "10.1.2.3", "2024-02-29", "31.12.1999",
              "+1 (212) 555-0187", "212-555-0187", "me.x@mail.example.org", 'token = "0123456789abcdef0123"']
    new, found = pseudonyms(spark, *values)
    kinds = ["card", "card", "card", "ssn", "ip", "date", "date", "phone", "phone", "email", "secret"]
    assert found == [[k] for k in kinds] and all(a != b for a, b in zip(new, values, strict=True))
    payload = feistel(4111111, 11111111, 10**7, 10**8, "card15")
    payload = f"{payload[0]:07d}{payload[1]:08d}"
    assert new[0] == payload + str(luhn(payload)) == new[1].replace(" ", "")
    assert new[2] == payload + str((luhn(payload) + 1) % 10)
    l, r = feistel(77 * 99 + 4, 1119, 898 * 99, 9999, "ssn")
    area = l // 99 + 1 + (l // 99 + 1 >= 666)
    assert new[3] == f"{area:03d}-{l % 99 + 1:02d}-{r + 1:04d}"
    l, r = feistel(10 * 256 + 1, 2 * 256 + 3, 65536, 65536, "ip")
    assert new[4] == ".".join(map(str, (*divmod(l, 256), *divmod(r, 256))))
    day = (datetime.date(2024, 2, 29) - datetime.date(1900, 1, 1)).days
    l, r = feistel(*divmod(day, 270), 270, 270, "date0")
    assert new[5] == str(datetime.date(1900, 1, 1) + datetime.timedelta(270 * l + r))
    assert datetime.datetime.strptime(new[6], "%d.%m.%Y")
    assert new[7].startswith("+1 (") and new[7].replace("+1 (", "").replace(") ", "-") == new[8]
    assert new[9].endswith("@mail.example.org") and new[10].startswith('token = "') and len(new[10]) == len(values[10])


def test_labels_of_secrets_within_longer_names(spark):
    secret = "AbCdEfGhIjKlMnOpQrSt1234"
    labels = ["access_token=", "secret_key=", "api key = ", "aws_secret_access_key=", "client-secret: ", "API_KEY='"]
    others = ["brokentoken=", "mytokens="]
    df = spark.createDataFrame([(i, f"x {n}{secret} y") for i, n in enumerate(labels + others)], "doc_id long, text string")
    rows = P.pseudonymised(df.withColumn("matches", F.lit(1)), "k").orderBy("doc_id").collect()
    assert [secret in r.text for r in rows] == [False] * len(labels) + [True] * len(others)
    assert all(r.text.startswith(f"x {n}") and r.matches == 1 for r, n in zip(rows, labels + others, strict=True))


def test_whole_secrets_and_further_formats(spark):
    body = "".join(hashlib.sha256(str(i).encode()).hexdigest() for i in range(80))
    jwt = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0In0.dBjftJeZ4CVP-mB92K27uhbUJU1p=="
    secrets = [body[:400], jwt, body]
    values = ["token=" + s for s in secrets] + ["25/12/1990", "31/01/2001", "3782-822463-10005", "555 123 4567"]
    new, found = pseudonyms(spark, *values, f"token={jwt}. Then")
    assert found == [["secret"]] * 3 + [["date"]] * 2 + [["card"], ["phone"], ["secret"]]
    for old, got in zip(secrets, new, strict=False):
        value = got.removeprefix("token=")
        assert len(value) == len(old) and not any(old[i : i + 12] in value for i in range(len(old) - 11))
        assert len({value[i : i + 64] for i in range(0, len(value) - 63, 64)}) == len(value) // 64
    for got in new[3:5]:
        assert datetime.datetime.strptime(got, "%d/%m/%Y").day > 12
    assert new[3] != values[3] and new[5][4] == new[5][11] == "-" and new[6][3] == new[6][7] == " "
    assert new[7].endswith(". Then") and jwt.split(".")[1] not in new[7]


def test_values_that_fail_their_check_stay(spark):
    values = ["2023-02-29", "000-12-3456", "666-01-0001", "999.1.1.1", "12345", "v1.2.3", "1999-99-99", "a@b", "abc123456789012"]
    new, found = pseudonyms(spark, *values)
    assert new == values and not any(found)


def test_pseudonyms_of_odd_rows(spark, odd):
    rows = P.pseudonymised(odd, KEY, "kinds").collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in rows) == sorted((i or 0, t or "") for i, t in ODD)
    assert all(r.kinds == [] and r.found == "c" for r in rows)
    assert P.pseudonymised(odd.limit(0), KEY).collect() == []


# --- toxicity


def test_ordinal_model_orders_grades():
    rng = np.random.default_rng(1)
    rows, grades = [], []
    for _ in range(600):
        n = rng.integers(0, 4)  # marked words in a text
        rows.append(np.concatenate([rng.integers(100, 400, 20), rng.choice(5, n, replace=False)]))
        grades.append(n)
    model = X.fit_ordinal(rows, np.array(grades))
    assert (np.diff(model.thresholds) > 0).all() and set(range(5)) <= set(model.buckets.tolist())
    weight = dict(zip(model.buckets.tolist(), model.weights, strict=True))
    value = np.array([sum(weight.get(b, 0) for b in set(r.tolist())) for r in rows])
    reach = model.at_least(value)
    plain = [[1 / (1 + math.exp(-(v - t))) for t in model.thresholds] for v in value]
    assert np.allclose(reach, plain) and (np.diff(reach, axis=1) <= 0).all()
    assert np.corrcoef(reach.sum(axis=1), grades)[0, 1] > 0.9


def test_toxic_words_are_learned_and_odd_rows_scored(spark, odd):
    text = lambda i, bad: f"word{i % 17} other{i % 5} thing " + ("vilely, foul " * bad)
    rows = [(i, text(i, i % 3 == 0)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    words, toxic, weights = X.sample_rows(docs, labels, "toxic", F.lit(True))
    model = X.fit_ordinal(words, X.graded(words, toxic > 0), weights)
    got = {r.doc_id: r for r in X.scored(docs, model).collect()}
    assert all((got[i].p_toxic > 0.5) == (i % 3 == 0) for i in range(300))
    out = X.scored(odd, model).collect()
    assert len(out) == len(ODD) and all(r.p_toxic < 0.5 for r in out)
    assert X.scored(odd.limit(0), model).collect() == []
    words, toxic, weights = X.sample_rows(docs, labels.limit(0), "toxic", F.lit(True))
    assert all(r.severity < 1e-6 for r in X.scored(odd, X.fit_ordinal(words, toxic, weights)).collect())


# --- quality


def test_rules_are_compiled_as_they_read(spark):
    rules = ((("words", ">", 2.0), ("odd_marks", "<=", 0.1)), 1.5), ((("digits", ">", 0.2),), -2.0)
    model = Q.RuleModel(0.25, rules)
    texts = ["a b c", "a b", "1 2 3 4", "## ## ##", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [0.25 + 1.5, 0.25, 0.25 + 1.5 - 2.0, 0.25, 0.25, 0.25]
    got = [r.score for r in Q.scored(df, model).orderBy("doc_id").collect()]
    assert np.allclose(got, [1 / (1 + math.exp(-w)) for w in want])


def test_quality_is_learned_from_labels_not_held_out(spark, odd):
    good = "The quick brown fox number {} went over all the lazy dogs. It was a nice day in town.\nThen it rained."
    rows = [(i, good.format(i) if i % 4 else "buy ### now $$$ " * (5 + i % 3)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(400)], "doc_id long, quality int")
    model = Q.fit(docs, labels, "quality")
    assert model.rules
    out = Q.scored(docs, model).collect()
    assert all((r.score > 0.5) == (r.doc_id % 4 > 0) for r in out)
    seen = Q.scored(odd, model).collect()
    assert len(seen) == len(ODD) and all(0 <= r.score <= 1 and r.found == "c" for r in seen)
    assert Q.scored(odd.limit(0), model).collect() == []
    none = Q.fit(docs, labels.limit(0), "quality")
    one = Q.fit(docs, labels.filter("quality = 1"), "quality")
    assert [r.score for r in Q.scored(docs.limit(1), none).collect()] == [0.5]
    assert Q.scored(docs.limit(1), one).first().score > 0.99


def test_filter_on_the_score_does_not_copy_the_figures_into_its_rules(odd):
    rules = tuple(((("words", ">", float(n)),), 0.001 * n) for n in range(20))
    kept = Q.scored(odd, Q.RuleModel(-0.05, rules), "s").filter("s >= 0.5").drop("s")
    # words and lines are split once each at most, not once more for every rule in the filter
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("split(") <= 2
    assert sorted(r.doc_id for r in kept.collect()) == [5]


# --- licences

MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""


def test_every_known_sentence_has_a_cue():
    import re

    assert all(re.search("|".join(L.CUES), s) for s in L.SENTENCES)
    assert {i for _, ids in L.RULES for i in ids} <= set(L.SENTENCES.values())


def test_licences_and_leftover_sentences(spark, odd):
    rows = [
        (1, MIT), (2, "x.\nLicensed under the Apache License, Version 2.0.\nThis work is licensed under the GNU General "
                      "Public License, version 3."),
        (3, "prose without a stop\nReleased under the MIT License.\nmore"), (4, "# " + MIT.replace("\n", "\n# ")),
        (5, "You may obtain a copy of the License at here."), (6, "The licence of the driver expired."),
    ]
    out = {r.doc_id: r for r in L.licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [out[i].licences for i in range(1, 7)] == [["MIT"], ["Apache-2.0", "GPL-3-only"], ["MIT"], ["MIT"], [], []]
    assert out[1].sentence_ids == [f"mit-{x}:" for x in ("title", "grant", "condition", "warranty", "liability")]
    assert [out[i].n_unmatched for i in range(1, 7)] == [0] * 6
    assert L.licences(spark.createDataFrame([(1, "See the GNU General Public License for more details.")], "doc_id long, text string")).first().n_unmatched == 1
    seen = L.licences(odd).collect()
    assert len(seen) == len(ODD) and not any(r.licences or r.sentence_ids for r in seen)
    assert L.licences(odd.limit(0)).collect() == []


# --- templates

ITEM = "When Anna has 3 apples and buys 4 kg more of them today, how many does Anna have?"


def leaks(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    return sorted((r.doc_id, r.item_id) for r in T.leaks(d, b, **kw).collect())


def test_reparameterised_items_are_found_and_mixed_ones_not(spark):
    docs = [
        (1, "Intro. " + ITEM + " More."), (2, "So when Maria has 17 apples and buys 5,5 lb more of them today, how many does "
                                              "Maria have then?"),
        (3, "When Maria has 17 apples and buys 5 lb more of them today, how many does Eva have?"),
        (4, "something else entirely about apples and what one buys more of today"), (5, ITEM), (5, ITEM), *ODD[:2], (None, ITEM),
    ]
    items = [(1, ITEM), (1, ITEM), (2, None), (3, ""), (4, "short one"), (None, ITEM)]
    assert leaks(spark, docs, items, percent=70) == [(1, 1), (2, 1), (5, 1)]
    assert leaks(spark, [(1, "a short one here"), (2, "short"), (3, "short one")], items) == [(1, 4), (3, 4)]
    assert leaks(spark, [], items) == [] and leaks(spark, docs, []) == []


def test_a_conflict_removes_only_the_windows_that_hold_it(spark):
    text = ("A shop sells {} red kites to each of the children who come by in the morning and then {} blue boats "
            "to those who are still there when it closes")  # fmt: skip
    named = "So {} went to the old market by the river and bought bread there before {} came home to the house on the hill"
    items = [(1, text.format(3, 3)), (2, named.format("Anna", "Anna"))]
    docs = [(1, text.format(5, 2)), (2, text.format(3, 4)), (3, named.format("Maria", "Eva")), (4, named.format("Anna", "Eva"))]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): (r.n_windows, r.item_windows) for r in T.leaks(d, b).collect()}
    # the second name stands in 8 windows, the first in 2
    assert found == {(1, 1): (24, 24), (2, 1): (24, 24), (3, 2): (7, 17), (4, 2): (9, 17)}


def test_names_at_sentence_starts_and_slot_heavy_items(spark):
    tom = "Tom has 3 red apples. Tom gives 2 away. How many are left?"
    sums = "12 + 30 = 42, 5 kg + 6 kg = 11 kg, 7 - 2 = 5"
    wrapped = "the price that\nAnna paid for it\n    Bella wrote down in the book"
    items = [(1, tom), (2, sums), (3, wrapped)]
    docs = [
        (1, "Yes. " + tom.replace("Tom", "Anna").replace("3", "5").replace("2", "4")), (2, "See: " + sums + " and so on"),
        (3, "13 + 31 = 44, 6 kg + 7 kg = 13 kg, 8 - 2 = 6"), (4, " ".join(wrapped.replace("Anna", "Maria").split())),
        (5, tom.replace("3", "8").replace("Tom gives", "They give")),
    ]
    assert leaks(spark, docs, items) == [(1, 1), (2, 2), (4, 3)]
    lone = "Anna 5 Bella 6 Clara 7 kg 8 met a man who then sold them a loaf of bread"
    assert leaks(spark, [(1, lone.replace("5", "6").replace("Anna", "Eva"))], [(1, lone)], percent=100) == [(1, 1)]


def test_windows_are_those_of_a_plain_version(spark):
    """Documents of plain words: a leak is a share of the item's windows, counted by hand."""
    import random

    rng = random.Random(4)
    pool = [f"w{c}{d}" for c in "abcdefghij" for d in "klmno"]
    items = [(i, " ".join(rng.choice(pool) for _ in range(rng.randrange(8, 30)))) for i in range(8)]
    docs = []
    for n in range(40):
        words = [rng.choice(pool) for _ in range(20)]
        cut = rng.choice(items)[1].split()
        a = rng.randrange(len(cut))
        words[5:5] = cut[a : a + rng.randrange(1, len(cut) + 1)]
        docs.append((n, " ".join(words)))

    def windows(text):
        w = text.split()
        return [tuple(w[i : i + 8]) for i in range(len(w) - 7)]

    want = []
    for d, text in docs:
        held = set(windows(text))
        for i, item in items:
            own = windows(item)
            if 100 * sum(w in held for w in own) >= 30 * len(own):
                want.append((d, i))
    assert leaks(spark, docs, items) == sorted(want) and want
