"""Near-duplicates and repeated passages against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from tillwarden.llm import near_duplicates as N, repeated_passages as P
from tillwarden.llm.components import components

WORD = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    low = {c: c + 32 for c in range(65, 91)}
    return [w.translate(low) for w in WORD.findall(text or "")]


def shingles(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def expected_components(rows, k):
    """Brute force over all pairs of rows; rows of one id are one node."""
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                lo, hi = sorted((root(i), root(j)))
                parent[hi] = lo
    return {i: root(i) for i in parent}


def varied(rng):
    """Groups of copies with few and many edits, short texts, exact copies and singles."""
    vocabulary = [f"w{i}" for i in range(400)]
    rows, n = [], 100
    for size, length in ((30, 60), (8, 15), (5, 200)):
        base = [rng.choice(vocabulary) for _ in range(length)]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randrange(0, 4)):
                text[rng.randrange(length)] = rng.choice(vocabulary).upper()
            rows.append((n, " ".join(text)))
            n -= 1 if n % 2 else -3
    rows += [(500 + i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 40)))) for i in range(40)]
    return rows


EDGES = [
    (900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "ONE"), (905, "one two"), (None, "one"),
    (906, "one"), (906, "entirely different words stand here now"), (907, "entirely different words stand here now"),
    (908, "x" * 300_000), (909, "x" * 300_000),
]


def test_components_are_those_of_all_pairs(spark):
    rows = varied(random.Random(3)) + EDGES
    rows += rows[:5]
    df = spark.createDataFrame([(i, t, 1, "c") for i, t in rows], "doc_id long, text string, n int, comp string")
    out = N.near_duplicates(df, shingle=4).collect()
    want = expected_components(rows, 4)
    assert len(out) == len(rows)
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id], r
            assert r.kept == (r.component_id == r.doc_id)
    sizes = {(r.doc_id, r.n_shingles) for r in out}
    assert sizes == {(i, len(shingles(t, 4))) for i, t in rows}


def test_empty_table_has_no_components(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert N.near_duplicates(df).collect() == []


def test_chains_and_stars_of_links(spark):
    chain = [(i, i + 1) for i in range(1, 60)]
    star = [(100, i) for i in range(101, 140)] + [(100, 100), (101, 100)]
    out = components(spark.createDataFrame(chain + star, "a long, b long")).collect()
    assert {r.doc_id: r.component_id for r in out} == {i: 1 for i in range(1, 61)} | {i: 100 for i in range(100, 140)}


def expected_parse(rows, window):
    seen, out = set(), defaultdict(list)
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            if key in seen:
                gone[s : s + window] = [True] * window
            seen.add(key)
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i].append((len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return {i: sorted(v) for i, v in out.items()}


def passages(rng):
    vocabulary = [f"v{i}" for i in range(30)]
    shared = [[rng.choice(vocabulary) for _ in range(rng.randrange(5, 60))] for _ in range(6)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(rng.randrange(1, 5)):
            text += rng.choice(shared) if rng.random() < 0.6 else [rng.choice(vocabulary) for _ in range(rng.randrange(1, 30))]
        rows.append((i * 7 % 61, "  ".join(text)))
    return rows + [(70, "a " * 100), (71, "a b " * 60), (72, None), (73, ""), (74, "x" * 3000), (75, rows[0][1])]


@pytest.mark.parametrize("window", [8, 20])
def test_passages_are_those_of_all_windows(spark, window):
    rows = passages(random.Random(window))
    # wholly equal rows of one id: the first is the original
    rows += [rows[3], rows[3], (None, rows[4][1])]
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, doc int, span string")
    out = P.repeated_passages(df, window).collect()
    got = defaultdict(list)
    for r in out:
        got[r.doc_id].append((r.n_words, r.n_removed, r.kept_sha256))
        assert hashlib.sha256(bytes(r.kept_text)).hexdigest() == r.kept_sha256
        covered = set()
        for f in r.factors:
            assert f.words >= window
            covered |= set(range(f.start, f.start + f.words))
        assert len(covered) == r.n_removed
    assert {i: sorted(v) for i, v in got.items()} == expected_parse(rows, window)


def test_no_documents_no_passages(spark):
    assert P.repeated_passages(spark.createDataFrame([], "doc_id long, text string")).collect() == []
