"""Recursive merges against the tiktoken library."""

import base64
import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pytest

from tillwarden.llm import byte_merges as B
from tillwarden.llm.shared import WordStore, tokenizer_file

RANKS = tokenizer_file("byte_bpe_multi_50k.tiktoken")
TEXTS = [
    (3, "Hello  World.\nthe the\tthe, café don't we'll a b"),
    (1, None), (2, ""), (4, " "), (6, "a  "), (8, "\n \n b  \r\n"), (9, "x \n y"), (10, "   lead"), (11, "tail \n"),
    (5, "<|endoftext|> \x00\x01\x1c\x1f \x85x 　 y 12.5 中文 \U00010348 é ‍ 👩‍👩‍👧"),
    (5, "the same id, another text"),
    (7, "again and again"), (7, "again and again"),
    (None, "no id"),
    (12, "w" * 5000 + " end " + "ab" * 900 + " " * 300 + "." + "\n" * 200),
]


@pytest.fixture(scope="module")
def mine():
    with open(RANKS, "rb") as f:
        return B.RankEncoder(f.read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    import tiktoken

    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_words_of_random_letters(mine, library):
    rng = random.Random(4)
    letters = "abcdeéßñ中文のひらがなабв 0123.,'!\n\t"
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 90))) for _ in range(3000)]
    assert [i.tolist() for i in mine.encode(words)] == [library.encode_ordinary(w) for w in words]


def test_query_and_heap_agree(mine):
    rng = random.Random(5)
    words = [bytes(rng.choice(b"aabetnr ") for _ in range(rng.randrange(1, B.LONG + 1))) for _ in range(400)]
    words += [b"a" * n for n in range(1, B.LONG + 1)] + [bytes(range(i, i + 40)) for i in range(200)]
    assert mine.merged(words) == [mine.by_heap(w) for w in words]


def test_white_space_in_every_place(mine, library):
    marks = [" ", "\n", "\t", "\x1c", "\x85", " ", "　", "a", "1", "."]
    texts = ["".join(c) for n in (1, 2, 3, 4) for c in itertools.product(marks, repeat=n)]
    assert [i.tolist() for i in mine.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_every_character_is_of_the_librarys_class(mine, library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}1{chr(c)}. {chr(c)}" for c in points[at : at + 4096]) for at in range(0, len(points), 4096)]
    for t in texts:
        words = mine.word.findall(t)
        # a word ends where the library's does, else their tokens would differ somewhere in 4,096 characters
        assert "".join(words) == t
        assert [i for w in words for i in library._encode_single_piece(w)] == library.encode_ordinary(t)


def test_frames_in_and_out(spark, library):
    rows = [(i, t, "clash", -1) for i, t in TEXTS]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int").repartition(3)
    got = B.decoded(B.encoded(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    digests = B.digests(got).collect()
    assert sorted(map(repr, B.encoded(docs, RANKS, public_tokenizers.PATTERN, decode=True).collect())) == sorted(map(repr, got.collect()))

    def sha(data):
        return hashlib.sha256(data).hexdigest()

    want = []
    for i, t in TEXTS:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert sorted(map(tuple, digests), key=repr) == sorted(want, key=repr)
    assert {r.doc_id: r.bytes for r in got.collect() if r.doc_id == 3}[3] == bytearray(TEXTS[0][1].encode())
    assert B.encoded(docs.limit(0), RANKS, public_tokenizers.PATTERN).collect() == []


def test_unknown_ids_are_an_error(mine):
    with pytest.raises(ValueError, match="vocabulary"):
        mine.decode([np.array([5, 10**6])])


def test_store_keeps_what_is_met_again():
    asked = []

    def learn(words):
        asked.extend(words)
        return {w: w.upper() for w in words}

    store = WordStore(2)
    for words in ({"a", "b", "c"}, {"a"}, {"d", "e"}, {"a"}, {"a", "b"}):
        assert {w: store.ready(set(words), learn)[w] for w in words} == {w: w.upper() for w in words}
    assert sorted(asked) == ["a", "b", "b", "c", "d", "e"] and len(store.new) + len(store.old) <= 6
