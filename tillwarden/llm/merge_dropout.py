"""SentencePiece BPE encoding with seeded merge-dropout, and its lossless decoding.

A unit is a word with the blanks before it (no piece holds a blank after a letter, so merges
never cross units), or a line end.  Its symbols start as characters; all pairs that form a piece are the
agenda, taken by rank, leftmost first.  Every occurrence of a unit makes its own draws: the t-th candidate taken
from the agenda is skipped, for good, if the t-th 16 bits of a keyed hash of seed, document and place fall
below ``dropout`` (rounded to 1/65,536); pairs with a new neighbour are new candidates.

So a segmentation depends on the unit and on which of its candidates were skipped, and on nothing else.  A task
keeps segmentations as a tree of bounded size: the node of a path of skips holds the ids and how many candidates
are taken if none further is skipped, and a child for each of these candidates.  An occurrence walks down by
its draws, so that occurrences share a result only if they skip the same candidates.  New nodes are worked out many at
once: each step takes the best live pair of every unit.  Where nothing is skipped, ids are the library's.

Characters without a piece become byte pieces, and so does a literal U+2581, which otherwise stands
for a blank: decoding gives back every text exactly.  With dropout 0 ids equal the library's.

Cases: a null text is encoded as an empty one; an empty text has no ids; a null doc_id draws
as doc_id 0; repeated rows are encoded alike; a unit of any length is encoded (long ones, and those that take more
than BITS candidates, one by one with a heap); an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq
import itertools
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillwarden.llm.shared import kept, slices, texts
from tillwarden.llm.wordhash import mix

U = np.uint64
MASK = (1 << 64) - 1
STEP = 0x9E3779B97F4A7C15
LONG = 24  # longer units are worked out one by one
BITS = 24  # candidates whose draws are made at once
SLICE = 1 << 20  # bytes of text encoded at once
KNOWN = 500_000  # nodes kept by a worker; beyond, it forgets all and starts again
APART = b""  # stands for a result that every occurrence works out for itself
BLANK = "▁"
UNIT = re.compile(r" *[^ \n]+|\n| +")
NO_RANK = np.int32(2**31 - 1)
NO_PAIR = np.int64(2**62)
_BYTES = re.compile(r"<0x([0-9A-F]{2})>")


def mix_one(x: int) -> int:
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


class Vocabulary:
    """Pieces, ranks and pair merges of a BPE model with byte fallback."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.surface: list[bytes] = []
        self.byte_id = [0] * 256
        self.piece: dict[str, int] = {}
        rank: dict[str, int] = {}
        order = sorted(range(n), key=lambda i: (-sp.get_score(i), i))
        place = {i: r for r, i in enumerate(order)}
        for i in range(n):
            text = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(_BYTES.fullmatch(text)[1], 16)
                self.byte_id[value] = i
                self.surface.append(bytes([value]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.surface.append(b"")
            else:
                text = text.replace(BLANK, " ")
                self.surface.append(text.encode())
                self.piece[text] = i
                rank[text] = place[i]
        # piece of every character, -1 for one without
        self.by_code = np.full(0x110000, -1, dtype=np.int32)
        for text, i in self.piece.items():
            if len(text) == 1:
                self.by_code[ord(text)] = i
        self.dtype = np.dtype("<u2") if n <= 1 << 16 else np.dtype("<u4")
        pairs = [
            (self.piece[t[:k]], self.piece[t[k:]], rank[t], i)
            for t, i in self.piece.items()
            for k in range(1, len(t))
            if t[:k] in self.piece and t[k:] in self.piece
        ]
        self.pairs = {(a, b): (r, i) for a, b, r, i in pairs}
        self.n = n + 1  # id n stands for "no symbol"
        self.tables = self._hashed(pairs)

    def _hashed(self, pairs) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Tables key -> (rank, piece); pairs that collide in one go on to the next."""
        keys = np.array([a * self.n + b for a, b, _, _ in pairs], dtype=np.uint64)
        ranks = np.array([r for _, _, r, _ in pairs], dtype=np.int32)
        ids = np.array([i for _, _, _, i in pairs], dtype=np.int32)
        tables, bits = [], 18
        left = np.arange(len(keys))
        while len(left):
            factor = mix_one(len(tables) + 1) | 1
            slot = ((keys[left] * U(factor)) >> U(64 - bits)).astype(np.int64)
            _, first = np.unique(slot, return_index=True)
            table = np.full(1 << bits, MASK, dtype=np.uint64)
            rank, piece = np.full(1 << bits, NO_RANK, dtype=np.int32), np.zeros(1 << bits, dtype=np.int32)
            placed = left[first]
            table[slot[first]], rank[slot[first]], piece[slot[first]] = keys[placed], ranks[placed], ids[placed]
            tables.append((factor, table, rank, piece))
            left = np.delete(left, first)
        self.bits = bits
        return tables

    def merges(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NO_RANK: none) and piece of each pair of symbols."""
        keys = left.astype(np.uint64) * U(self.n) + right.astype(np.uint64)
        rank, piece = np.full(len(keys), NO_RANK, dtype=np.int32), np.zeros(len(keys), dtype=np.int32)
        for factor, table, ranks, pieces in self.tables:
            slot = ((keys * U(factor)) >> U(64 - self.bits)).astype(np.int64)
            hit = table[slot] == keys
            rank[hit], piece[hit] = ranks[slot[hit]], pieces[slot[hit]]
        return rank, piece


class Tree:
    """Nodes in columns: ids in one buffer, children by candidate in another."""

    def __init__(self, dtype: np.dtype):
        self.node: dict[str, int] = {}  # units to the nodes where nothing is skipped
        self.unit: list[str] = []
        self.n = self.n_ids = self.n_children = 0
        self.taken, self.path = np.zeros(1024, dtype=np.int64), np.zeros(1024, dtype=np.int64)
        self.start, self.size = np.zeros(1024, dtype=np.int64), np.zeros(1024, dtype=np.int64)
        self.first_child = np.zeros(1024, dtype=np.int64)
        self.ids = np.zeros(1024, dtype=dtype)
        self.child = np.full(1024, -1, dtype=np.int32)

    @staticmethod
    def _room(column: np.ndarray, n: int, empty: int = 0) -> np.ndarray:
        if n <= len(column):
            return column
        larger = np.full(max(n, 2 * len(column)), empty, dtype=column.dtype)
        larger[: len(column)] = column
        return larger

    def add(self, units: list[str], paths: np.ndarray, results: list[tuple[int, bytes]]) -> np.ndarray:
        """New nodes: units, their skips as bits, candidates taken and ids."""
        first, last = self.n, self.n + len(units)
        self.n = last
        self.unit += units
        taken = np.array([t for t, _ in results], dtype=np.int64)
        ids = np.frombuffer(b"".join([i for _, i in results]), dtype=self.ids.dtype)
        sizes = np.array([len(i) for _, i in results], dtype=np.int64) // self.ids.dtype.itemsize
        for name, values in (
            ("taken", taken),
            ("path", paths),
            ("size", sizes),
            ("start", self.n_ids + np.cumsum(sizes) - sizes),
            ("first_child", self.n_children + np.cumsum(taken) - taken),
        ):
            column = self._room(getattr(self, name), last)
            column[first:last] = values
            setattr(self, name, column)
        self.ids = self._room(self.ids, self.n_ids + len(ids))
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.n_ids += len(ids)
        self.n_children += int(taken.sum())
        self.child = self._room(self.child, self.n_children, -1)
        return np.arange(first, last)


class DropoutEncoder:
    def __init__(self, model: bytes, dropout: float, seed: int):
        self.vocabulary = Vocabulary(model)
        self.limit = min(max(round(dropout * (1 << 16)), 0), 1 << 16)
        self.seed = mix_one(seed & MASK)
        self.tree = Tree(self.vocabulary.dtype)

    def _places(self, doc_id: int, n: int) -> np.ndarray:
        """A key for each of a document's units."""
        start = U((mix_one(doc_id & MASK) + self.seed) & MASK)
        return mix(start + np.arange(n, dtype=np.uint64) * U(STEP))

    def _draws(self, places: np.ndarray) -> np.ndarray:
        """Which of the first BITS candidates each unit skips, as bits."""
        if not self.limit:
            return np.zeros(len(places), dtype=np.int64)
        blocks = np.arange(1, BITS // 4 + 1, dtype=np.uint64) * U(STEP)
        fields = mix(places[:, None] + blocks[None, :]).view("<u2")
        packed = np.packbits(fields.astype(np.uint32) < self.limit, axis=1, bitorder="little").astype(np.int64)
        return packed[:, 0] | packed[:, 1] << 8 | packed[:, 2] << 16

    def skips(self, place: int, t: int) -> bool:
        """Whether the t-th candidate of the unit with this key is skipped."""
        return mix_one((place + (t // 4 + 1) * STEP) & MASK) >> (t % 4 * 16) & 0xFFFF < self.limit

    def _symbols(self, unit: str) -> list[int]:
        """Piece ids of the characters; -1 for one without a piece."""
        piece = self.vocabulary.piece
        return [piece.get(c, -1) for c in unit]

    def _spelled(self, unit: str, cuts: list[tuple[int, int]]) -> bytes:
        """Ids from (first character, piece), byte pieces for what has no piece."""
        out = []
        for at, piece in cuts:
            if piece >= 0:
                out.append(piece)
            else:
                out.extend(self.vocabulary.byte_id[b] for b in unit[at].encode("utf-8", "surrogatepass"))
        return np.array(out, dtype=self.vocabulary.dtype).tobytes()

    def one(self, unit: str, place: int) -> bytes:
        """A single unit by a heap: the way for long units."""
        pairs = self.vocabulary.pairs
        symbol: list[int | None] = list(self._symbols(unit))
        n = len(symbol)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[int, int, int, int, int]] = []
        taken = 0

        def offer(i: int, j: int) -> None:
            found = pairs.get((symbol[i], symbol[j]))
            if found:
                heapq.heappush(agenda, (found[0], i, j, symbol[i], symbol[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, i, j, left, right = heapq.heappop(agenda)
            if symbol[i] != left or symbol[j] != right or after[i] != j:
                continue
            taken += 1
            if self.limit and self.skips(place, taken - 1):
                continue
            symbol[i], symbol[j] = pairs[left, right][1], None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
                offer(i, after[j])
            if before[i] >= 0:
                offer(before[i], i)
        return self._spelled(unit, [(i, s) for i, s in enumerate(symbol) if s is not None])

    def _many(self, units: list[str], skipped: np.ndarray) -> list[tuple[int, bytes]]:
        """Candidates taken and ids of units of at most LONG characters, all at once.

        Ids are APART where more than BITS candidates are taken.
        """
        none = self.vocabulary.n - 1
        width = max(map(len, units))
        lengths = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
        inside = np.arange(width)[None, :] < lengths[:, None]
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        # one row a unit with an empty last column: all links that leave the unit lead there
        columns = width + 1
        table = np.full((len(units), columns), none, dtype=np.int64)
        table[:, :width][inside] = self.vocabulary.by_code[codes]
        unknown = (table < 0).any(axis=1)
        no_piece = table < 0
        table[no_piece] = none  # forms no pair
        symbol = table.reshape(-1)
        after = np.tile(np.minimum(np.arange(1, columns + 1), width), len(units))
        before = np.tile(np.append(np.arange(-1, width - 1) % columns, width), len(units))
        gone = np.ones((len(units), columns), dtype=bool)
        gone[:, :width] = ~inside
        gone = gone.reshape(-1)
        taken = np.zeros(len(units), dtype=np.int64)
        # rank and piece of the pair of every symbol with the one after it
        pairs = np.full((len(units), columns), NO_PAIR, dtype=np.int64)
        flat = pairs.reshape(-1)

        def offer(at: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
            r, p = self.vocabulary.merges(left, right)
            flat[at] = np.where(r < NO_RANK, r.astype(np.int64) << 32 | p, NO_PAIR)

        starts = np.flatnonzero(~gone)
        offer(starts, symbol[starts], symbol[starts + 1])
        live = np.arange(len(units))
        while len(live):
            rows = pairs[live]
            at = rows.argmin(axis=1)
            best = rows[np.arange(len(live)), at]
            some = best < NO_PAIR
            live, at, best = live[some], at[some], best[some]
            skip = (skipped[live] >> np.minimum(taken[live], BITS)) & 1 == 1
            taken[live] += 1
            base = live * columns
            flat[base[skip] + at[skip]] = NO_PAIR
            merge = ~skip
            base, at, piece = base[merge], at[merge], best[merge] & 0xFFFFFFFF
            here = base + at
            there = base + after[here]
            beyond, ahead = base + after[there], base + before[here]
            symbol[here] = piece
            gone[there], flat[there] = True, NO_PAIR
            after[here] = after[there]
            before[beyond] = at
            offer(
                np.concatenate((here, ahead)),
                np.concatenate((piece, symbol[ahead])),
                np.concatenate((symbol[beyond], piece)),
            )
            live = live[taken[live] <= BITS]
        kept = ~gone
        ends = np.cumsum(kept.reshape(-1, columns).sum(axis=1)).tolist()
        packed = symbol[kept].astype(self.vocabulary.dtype).tobytes()
        size = self.vocabulary.dtype.itemsize
        odd = unknown.tolist()
        out, first = [], 0
        for i, (unit, t, end) in enumerate(zip(units, taken.tolist(), ends, strict=True)):
            if t > BITS:
                out.append((BITS, APART))
            elif odd[i]:
                left = np.flatnonzero(kept[i * columns : (i + 1) * columns]).tolist()
                cuts = [(c, -1 if no_piece[i, c] else int(table[i, c])) for c in left]
                out.append((t, self._spelled(unit, cuts)))
            else:
                out.append((t, packed[first * size : end * size]))
            first = end
        return out

    def _worked_out(self, units: list[str], skipped: np.ndarray) -> np.ndarray:
        """New nodes of units of at most LONG characters that skip what the bits say and nothing else."""
        order = sorted(range(len(units)), key=lambda i: len(units[i]))
        results: list = [None] * len(units)
        for at in range(0, len(order), 4096):
            part = order[at : at + 4096]
            for i, result in zip(part, self._many([units[i] for i in part], skipped[part]), strict=True):
                results[i] = result
        return self.tree.add(units, skipped, results)

    def _first_met(self, units: list[str]) -> None:
        """Nodes of new units where nothing is skipped: the library's ids.

        Without byte pieces every merge, and so every candidate taken, makes one symbol fewer.
        """
        byte_ids, kind = set(self.vocabulary.byte_id), "H" if self.vocabulary.dtype.itemsize == 2 else "I"
        plain = [u for u in units if u[0] == " " and u[1:2].strip() and BLANK not in u]
        names, results = [], []
        for unit, ids in zip(plain, self.vocabulary.library.encode([u[1:] for u in plain], num_threads=1), strict=True):
            if byte_ids.isdisjoint(ids):
                names.append(unit)
                results.append((len(unit) - len(ids), array(kind, ids).tobytes()))
        nodes = self.tree.add(names, np.zeros(len(names), dtype=np.int64), results)
        self.tree.node.update(zip(names, nodes.tolist(), strict=True))
        others = [u for u in units if u not in self.tree.node]
        if others:
            nodes = self._worked_out(others, np.zeros(len(others), dtype=np.int64))
            self.tree.node.update(zip(others, nodes.tolist(), strict=True))

    def _walk(self, nodes: np.ndarray, drawn: np.ndarray) -> None:
        """From the nodes where nothing is skipped down to those of the draws."""
        tree = self.tree
        going = np.flatnonzero(nodes >= 0)
        while len(going):
            at = nodes[going]
            rest = drawn[going] & ~tree.path[at] & ((1 << tree.taken[at]) - 1)
            some = rest > 0
            going, at, rest = going[some], at[some], rest[some]
            bit = rest & -rest
            place = tree.first_child[at] + np.bitwise_count(bit - 1)
            new, first = np.unique(place[tree.child[place] < 0], return_index=True)
            if len(new):
                first = np.flatnonzero(tree.child[place] < 0)[first]
                made = self._worked_out([tree.unit[i] for i in at[first].tolist()], tree.path[at[first]] | bit[first])
                tree.child[new] = made
            nodes[going] = tree.child[place]

    def encode(self, batch: list[tuple[int, str]]) -> Iterator[bytes]:
        """Ids of (doc_id, text) as packed integers."""
        if self.tree.n > KNOWN:
            self.tree = Tree(self.vocabulary.dtype)
        tree = self.tree
        cut = [UNIT.findall(" " + text) if text else [] for _, text in batch]
        units = list(itertools.chain.from_iterable(cut))
        ends = np.cumsum([0, *map(len, cut)]).tolist()
        places = np.concatenate([self._places(i, len(c)) for (i, _), c in zip(batch, cut, strict=True)])
        new = [u for u in set(units).difference(tree.node) if len(u) <= LONG]
        if new:
            self._first_met(new)
        known = tree.node
        nodes = np.array([known.get(u, -1) for u in units], dtype=np.int64)
        self._walk(nodes, self._draws(places))
        sizes = np.where(nodes >= 0, tree.size[nodes], 0)
        shift = np.cumsum(sizes) - sizes
        total = int(sizes.sum())
        ids = tree.ids[np.repeat(tree.start[nodes] - shift, sizes) + np.arange(total)]
        bounds = np.append(shift, total)
        for first, last in itertools.pairwise(ends):
            apart = np.flatnonzero(sizes[first:last] == 0) + first
            at, parts = bounds[first], []
            for i in apart.tolist():
                parts += [ids[at : bounds[i]].tobytes(), self.one(units[i], int(places[i]))]
                at = bounds[i]
            yield b"".join([*parts, ids[at : bounds[last]].tobytes()])

    def decode(self, ids: list[int]) -> str:
        surface = self.vocabulary.surface
        return b"".join(map(surface.__getitem__, ids)).decode("utf-8", "surrogatepass")[1:]


def encoder(model: bytes, dropout: float, seed: int) -> DropoutEncoder:
    """One per Python worker and setting, kept between tasks."""
    key = (zlib.crc32(model), dropout, seed)
    return kept("merge_dropout", key, lambda: DropoutEncoder(model, dropout, seed))


def _model(docs: DataFrame, path: str):
    with open(path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encoded(docs: DataFrame, model_path: str, dropout: float = 0.1, seed: int = 1) -> DataFrame:
    """doc_id, n_ids, ids and lossless (whether the ids decode to the text) of every row."""
    model = _model(docs, model_path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model.value, dropout, seed)
        for whole in batches:
            for batch in slices(whole, SLICE):
                rows = [(i or 0, t) for i, t in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
                packed = list(enc.encode(rows))
                ids = [np.frombuffer(p, dtype=enc.vocabulary.dtype) for p in packed]
                lossless = [enc.decode(i.tolist()) == t for i, (_, t) in zip(ids, rows, strict=True)]
                sizes = np.array([0, *map(len, ids)], dtype=np.int32)
                flat = np.concatenate(ids).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes, dtype=np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes[1:].astype(np.int64)), lists, pa.array(lossless)],
                    ["doc_id", "n_ids", "ids", "lossless"],
                )

    return texts(docs).mapInArrow(encode, "doc_id long, n_ids long, ids array<int>, lossless boolean")


def decoded(encoded_docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text from doc_id and ids; null ids give an empty text."""
    model = _model(encoded_docs, model_path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model.value, 0.0, 0)
        for batch in batches:
            texts_back = [enc.decode(i or []) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts_back, pa.string())], ["doc_id", "text"])

    return encoded_docs.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")
