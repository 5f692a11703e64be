"""Byte-level BPE by recursive queries of an in-process DuckDB in every task.

A text is cut into words by the pattern of the rank file.  Bytes of the words not met before become rows (word,
position, token) of a table; a recursive query joins neighbouring rows with the merge table (left token,
right token, merged token), takes each word's pair of least rank, the leftmost of equal ones, puts the
merged token in its place, and goes on with the words that changed until no word changes.  A word that is a token
itself is that token at once, as in the library.

Decoding joins the rows (text, position, token) with the vocabulary and puts their bytes together in the
order of positions, by an ordered aggregation.

A task's database is in memory, has one thread and a bounded share of memory, and writes no files.  Words are
kept from batch to batch in a store of bounded size.  Words of more than LONG bytes need as many steps as tokens
to merge, and rows in each, so their cost in the query would grow with the square of their length; they
are merged with a heap, which gives the same tokens.

Cases: a null text is encoded as an empty one; an empty text has no ids; a null doc_id stays null; repeated rows are all
encoded; an empty table gives no rows; further columns are ignored; lone surrogates cannot occur in a
string column.  A text of any length is encoded whole.
"""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tillwarden.llm.shared import WordStore, kept, texts

LONG = 64  # bytes of a word that the query takes
QUERY_WORDS = 65_536  # in one query
KNOWN = 350_000  # pieces in a generation of the store
SLICE = 4 << 20  # bytes of text encoded at once
DATABASE = {"threads": 1, "memory_limit": "256MB", "temp_directory": ""}
# Fixed lists: White_Space of Unicode, and the letters and numbers of Unicode 17 and 18, which the library's
# tables (Unicode 16) do not hold yet and therefore take for marks.
SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
NOT_YET = (
    r"\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c-\uab6d"
    r"\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb"
    r"\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016eb8"
    r"\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20"
    r"\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6"
    r"\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6ff"
    r"\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
# a blank before white space: a cut there may part a run of white space
_RUNS = tuple(" " + chr(c) for c in (*range(9, 14), *range(28, 33)))
_WIDE_RUNS = tuple(" " + c for c in "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000") + tuple(" " + chr(c) for c in range(0x2000, 0x200B))

# k is word << 16 | position, and a pair is rank << 16 | position: the least is the one of least rank, then the leftmost
MERGE = """
    WITH RECURSIVE state(step, k, t) AS (
        SELECT 0, (w::BIGINT << 16) | p, t FROM start
        UNION ALL
        (WITH neighbours AS MATERIALIZED (
            SELECT step, k, k >> 16 AS w, t, lag(k) OVER place AS k_before, lead(k) OVER place AS k_next, lead(t) OVER place AS t_next
            FROM state WINDOW place AS (ORDER BY k)
        ),
        chosen AS (
            SELECT w, min((merged::BIGINT << 16) | (k & 65535)) AS pair
            FROM neighbours JOIN merges ON merges.l = t AND merges.r = t_next WHERE k_next >> 16 = w GROUP BY w
        )
        SELECT step + 1, k, CASE WHEN k & 65535 = pair & 65535 THEN (pair >> 16)::INTEGER ELSE t END
        FROM neighbours JOIN chosen USING (w)
        WHERE k_before IS DISTINCT FROM (w << 16) | (pair & 65535))
    ),
    last AS (SELECT k >> 16 AS w, max(step) AS step FROM state GROUP BY k >> 16)
    SELECT last.w, list(t ORDER BY k) AS tokens
    FROM state JOIN last ON last.w = k >> 16 AND last.step = state.step GROUP BY last.w ORDER BY last.w
"""

DECODE = """
    SELECT d, string_agg(s, '' ORDER BY p) AS bytes
    FROM tokens JOIN vocabulary ON vocabulary.t = tokens.t GROUP BY d ORDER BY d
"""


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes and their ranks from the lines of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}


def _as_in_the_library(pattern: str) -> str:
    """The pattern with its classes spelled out: white space, letters and numbers as the library has them."""
    spelled = {
        r"[^\s\p{L}\p{N}]": rf"[[^{SPACES}\p{{L}}\p{{N}}]||[{NOT_YET}]]",
        r"\p{L}": rf"[\p{{L}}--[{NOT_YET}]]",
        r"\p{N}": rf"[\p{{N}}--[{NOT_YET}]]",
        r"\S": f"[^{SPACES}]",
        r"\s": f"[{SPACES}]",
    }
    return re.sub("|".join(map(re.escape, spelled)), lambda m: spelled[m[0]], pattern)


class RankEncoder:
    """Ids of whole texts and texts of ids, for one rank file and word pattern."""

    def __init__(self, rank_file: bytes, pattern: str):
        import duckdb
        import regex

        self.ranks = read_ranks(rank_file)
        self.word = regex.compile(_as_in_the_library(pattern), regex.VERSION1)
        self.plain_word = regex.compile(pattern.replace(r"\S", f"[^{SPACES}]").replace(r"[^\s", f"[^{SPACES}").replace(r"\s", f"[{SPACES}]"))
        self.not_yet = regex.compile(f"[{NOT_YET}]")
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        self.pairs = {
            (self.ranks[token[:k]], self.ranks[token[k:]]): rank
            for token, rank in self.ranks.items()
            for k in range(1, len(token))
            if token[:k] in self.ranks and token[k:] in self.ranks
        }
        self.database = duckdb.connect(":memory:", config=DATABASE)
        left, right = zip(*self.pairs, strict=True) if self.pairs else ((), ())
        self._table("merges", l=left, r=right, merged=list(self.pairs.values()))
        # one character a byte, so that bytes can be put together as a string
        self._table("vocabulary", t=list(self.ranks.values()), s=[t.decode("latin-1") for t in self.ranks])
        self.store: WordStore[bytes] = WordStore(KNOWN)

    def _table(self, name: str, **columns) -> None:
        kinds = {str: pa.string()}
        arrays = {c: pa.array(v, kinds.get(type(v[0]) if len(v) else int, pa.int32())) for c, v in columns.items()}
        self.database.register("given", pa.table(arrays))
        self.database.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.database.unregister("given")

    def _ask(self, name: str, rows: dict[str, np.ndarray], query: str) -> pa.Table:
        self.database.register(name, pa.table(rows))
        try:
            return self.database.sql(query).to_arrow_table()
        finally:
            self.database.unregister(name)

    def merged(self, words: list[bytes]) -> list[bytes]:
        """Packed tokens of words of 1 to LONG bytes, by the recursive query."""
        out: list[bytes] = []
        for at in range(0, len(words), QUERY_WORDS):
            part = words[at : at + QUERY_WORDS]
            sizes = np.fromiter(map(len, part), dtype=np.int64, count=len(part))
            flat = np.frombuffer(b"".join(part), dtype=np.uint8)
            first = np.repeat(np.cumsum(sizes) - sizes, sizes)
            rows = {
                "w": np.repeat(np.arange(len(part), dtype=np.int32), sizes),
                "p": (np.arange(len(flat)) - first).astype(np.int32),
                "t": self.byte[flat],
            }
            found = self._ask("start", rows, MERGE).column("tokens").combine_chunks()
            ends = (found.offsets.to_numpy() * 4).tolist()
            packed = found.values.to_numpy().astype("<i4").tobytes()
            out.extend(packed[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True))
        return out

    def by_heap(self, word: bytes) -> bytes:
        """Packed tokens of a word of any length."""
        token = self.byte[np.frombuffer(word, dtype=np.uint8)].tolist()
        n = len(token)
        before, after = list(range(-1, n - 1)), [*range(1, n), n]
        alive = [True] * n
        agenda: list[tuple[int, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            rank = self.pairs.get((token[i], token[j]))
            if rank is not None:
                heapq.heappush(agenda, (rank, i, j, token[i], token[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            rank, i, j, left, right = heapq.heappop(agenda)
            if not alive[i] or not alive[j] or token[i] != left or token[j] != right or after[i] != j:
                continue
            token[i], alive[j] = rank, False
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                offer(i, after[j])
            if before[i] >= 0:
                offer(before[i], i)
        return np.array([t for t, lives in zip(token, alive, strict=True) if lives], dtype="<i4").tobytes()

    def _pieces(self, text: str) -> list[str]:
        """Cuts before blanks, where words always end; words lie within pieces.

        A run of white space belongs together, so a text with a blank before white space or at its end is not cut.
        """
        if not text:
            return []
        runs = _RUNS if text.isascii() else _RUNS + _WIDE_RUNS
        if text[-1] == " " or any(run in text for run in runs):
            return [text] if len(text) <= 256 else self.word.findall(text)  # long ones are not kept whole
        first, *rest = text.split(" ")
        return ([first] if first else []) + [" " + piece for piece in rest]

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Packed ids of pieces: whole tokens at once, long words by heap, all others in the query."""
        # the plain pattern is twice as fast, and the same unless one of the newer letters occurs
        newer = self.not_yet.search("".join(set("".join(pieces))))
        words_of = (self.word if newer else self.plain_word).findall
        one: dict[str, bytes] = {}
        more: dict[str, list[bytes]] = {}
        for piece in pieces:
            words = words_of(piece)
            if len(words) == 1:
                one[piece] = piece.encode()
            else:
                more[piece] = [w.encode() for w in words]
        packed: dict[bytes, bytes] = {}
        asked = []
        for word in set(one.values()).union(*more.values()):
            rank = self.ranks.get(word)
            if rank is not None:
                packed[word] = rank.to_bytes(4, "little")
            elif len(word) > LONG:
                packed[word] = self.by_heap(word)
            else:
                asked.append(word)
        packed.update(zip(asked, self.merged(asked), strict=True))
        learned = {piece: packed[word] for piece, word in one.items()}
        learned.update((piece, b"".join([packed[w] for w in words])) for piece, words in more.items())
        return learned

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        cut = [self._pieces(text) for text in batch]
        known = self.store.ready({p for pieces in cut for p in pieces}, self._learn)
        return [np.frombuffer(b"".join(map(known.__getitem__, pieces)), dtype="<i4") for pieces in cut]

    def decode(self, batch: list[np.ndarray]) -> list[bytes]:
        """Bytes of each list of ids; an id outside the vocabulary is an error."""
        out = [b""] * len(batch)
        sizes = np.fromiter(map(len, batch), dtype=np.int64, count=len(batch))
        if not sizes.sum():
            return out
        flat = np.concatenate(batch).astype(np.int32)
        if not np.isin(flat, np.fromiter(self.ranks.values(), dtype=np.int32), kind="table").all():
            raise ValueError("an id is not in the vocabulary")
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        rows = {
            "d": np.repeat(np.arange(len(batch), dtype=np.int32), sizes),
            "p": (np.arange(len(flat)) - first).astype(np.int32),
            "t": flat,
        }
        found = self._ask("tokens", rows, DECODE)
        for d, joined in zip(found.column("d").to_pylist(), found.column("bytes").to_pylist(), strict=True):
            out[d] = joined.encode("latin-1")
        return out


def encoder(rank_file: bytes, pattern: str) -> RankEncoder:
    """One per Python worker and vocabulary, kept between tasks."""
    key = (zlib.crc32(rank_file), len(rank_file), pattern)
    return kept("byte_merges", key, lambda: RankEncoder(rank_file, pattern))


def _ranks(df: DataFrame, path: str):
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about SLICE bytes of text (column 1); a longer text is a run of its own."""
    first = total = 0
    for at, length in enumerate(pc.binary_length(batch.column(1)).to_pylist()):
        if at > first and total + length > SLICE:
            yield batch.slice(first, at - first)
            first, total = at, 0
        total += length
    if first < batch.num_rows:
        yield batch.slice(first)


def _lists(ids: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    """Sizes and values as columns."""
    sizes = np.array([0, *map(len, ids)], dtype=np.int64)
    values = pa.array(np.concatenate(ids), pa.int32())
    return pa.array(sizes[1:]), pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)), values)


ENCODED = "doc_id long, n_tokens long, ids array<int>"
DECODED = "doc_id long, n_tokens long, ids array<int>, bytes binary"


def encoded(docs: DataFrame, rank_path: str, pattern: str, decode: bool = False) -> DataFrame:
    """doc_id, n_tokens and ids of every row; with ``decode`` also ``bytes``, to which the ids are decoded in the same task."""
    ranks = _ranks(docs, rank_path)
    names = ["doc_id", "n_tokens", "ids", "bytes"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks.value, pattern)
        for whole in batches:
            for batch in _slices(whole):
                ids = enc.encode(batch.column(1).to_pylist())
                columns = [batch.column(0), *_lists(ids)]
                if decode:
                    columns.append(pa.array(enc.decode(ids), pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    return texts(docs).mapInArrow(encode, DECODED if decode else ENCODED)


def decoded(ids: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and ids with ``bytes``, what the ids decode to; null ids decode to nothing."""
    ranks = _ranks(ids, rank_path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks.value, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                lists = [np.asarray(i.values) if i.is_valid else np.empty(0, np.int32) for i in batch.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(enc.decode(lists), pa.binary())], ["doc_id", "n_tokens", "ids", "bytes"]
                )

    columns = ids.select("doc_id", "n_tokens", F.col("ids").cast("array<int>").alias("ids"))
    return columns.mapInArrow(decode, DECODED)


def digests(decoded_ids: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of rows with ids and bytes."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded_ids.select(
        "doc_id", "n_tokens", F.sha2(joined, 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256")
    )
