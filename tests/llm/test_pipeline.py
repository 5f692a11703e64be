"""The pipeline's stages on the smallest tables and on odd rows."""

from pathlib import Path

import pytest

import corpus_pipeline
from tillwarden.llm import near_duplicates, pseudonyms, templates
from tillwarden.llm.shared import table, tokenizer_file, written

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).is_dir(), reason="no test tables here")


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage."""
    docs, out = table(spark, DATA, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = written(stage(spark, docs, DATA), f"test-{name}")
        out[name] = (docs, result)
        docs = result
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_all_but_the_last_keep_the_columns(stages, spark):
    columns = table(spark, DATA, "documents").columns
    for name, (_, out) in list(stages.items())[:-1]:
        assert out.columns == columns, name


def test_quality_rejects_what_labels_reject(stages, spark):
    before, after = (set(ids(x)) for x in stages["quality"])
    labels = {r.doc_id: r.quality for r in table(spark, DATA, "labels").collect()}
    right = [(i in after) == bool(labels[i]) for i in before if i in labels]
    assert after < before and sum(right) >= 0.9 * len(right)


def test_one_document_of_each_group_stays(stages):
    before, after = stages["near_duplicates"]
    found = near_duplicates.near_duplicates(before, 5, 80).collect()
    assert ids(after) == sorted(r.doc_id for r in found if r.doc_id == r.component_id)


def test_no_leak_is_left_and_others_stay(stages, spark):
    before, after = stages["decontamination"]
    items = [r.text for r in table(spark, DATA, "benchmark").collect()]
    holds = lambda t: any(x in t for x in items)
    assert not any(holds(r.text) for r in after.collect())
    gone = set(ids(before)) - set(ids(after))
    leaked = {r.doc_id for r in templates.leaks(before, table(spark, DATA, "benchmark")).collect()}
    assert gone == leaked >= {r.doc_id for r in before.collect() if holds(r.text)}


def test_private_data_is_replaced(stages):
    before, after = stages["private_data"]
    assert ids(before) == ids(after)
    texts = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        assert r.n_chars == len(r.text)
        for value in __import__("re").findall(r"[\w.]+@[\w.]+\.com|\b\d{16}\b", texts[r.doc_id]):
            assert value not in r.text


def test_encoding_decodes_to_the_texts(stages):
    from tillwarden.llm.merge_dropout import decoded

    before, after = stages["encoding"]
    back = {r.doc_id: r.text for r in decoded(after, tokenizer_file("piece_bpe_32k.model")).collect()}
    assert back == {r.doc_id: r.text for r in before.collect()}


def test_stages_take_odd_and_empty_tables(spark):
    rows = [(1, None, 5), (2, "", 0), (3, "The same text stands here for all to read.", 1),
            (3, "The same text stands here for all to read.", 1), (None, "Mail me at a.b@c.example.com today", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, docs, DATA).collect()
        assert len(out) == (4 if name == "near_duplicates" else 5), name
        assert stage(spark, docs.limit(0), DATA).collect() == []
    assert {k for r in pseudonyms.pseudonymised(docs, "k").collect() for k in r.found} == {"email"}


def test_stages_keep_columns_of_any_name(spark):
    names = ["score", "row", "kept_row", "__row", "leaked_id", "found", "matches", "__words", "__stat_chars", "__score"]
    columns = ", ".join(f"{n} string" for n in names)
    rows = [(i, "A plain text of the day, with some words in it.", *(f"{n}{i}" for n in names)) for i in range(3)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {columns}")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns, name
        assert all(r[n] == f"{n}{r.doc_id}" for r in out.collect() for n in names), name


def test_a_real_run_needs_its_key(spark, monkeypatch):
    monkeypatch.delenv(corpus_pipeline.KEY_VARIABLE, raising=False)
    docs = table(spark, DATA, "documents")
    with pytest.raises(RuntimeError, match=corpus_pipeline.KEY_VARIABLE):
        dict(corpus_pipeline.REAL_STAGES)["private_data"](spark, docs, DATA)


def test_different_texts_of_one_id_are_different_documents(spark):
    a, b, c = ("".join(f"{w}{i} " for i in range(30)) for w in ("apple", "boat", "cloud"))
    rows = [(7, a), (7, b), (7, b), (2, b), (9, c), (9, c + "more"), (7, ""), (7, ""), (7, None), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = corpus_pipeline.near_duplicate(spark, docs, DATA).collect()
    texts = sorted((r.doc_id or 0, r.text or "none" if r.text is None else r.text) for r in out if r.doc_id != 9)
    assert texts == sorted([(0, a), (2, b), (7, a), (7, ""), (7, "none")])
    assert len([r for r in out if r.doc_id == 9]) == 1


def test_a_worker_keeps_the_store_of_one_operator():
    import gc
    import weakref

    from tillwarden.llm import merge_dropout, shared, token_records

    with open(tokenizer_file("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    gone = weakref.ref(merge_dropout.encoder(model, 0.1, 1))
    assert merge_dropout.encoder(model, 0.1, 1) is gone()
    with open(tokenizer_file("word_bpe_49k.json"), encoding="utf-8") as f:
        words = weakref.ref(token_records.encoder(f.read()))
    gc.collect()
    assert gone() is None and words() is not None
    shared.release()
    assert words() is None
