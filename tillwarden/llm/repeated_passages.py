"""Repeated passages by relative Lempel-Ziv parsing against indexed reference blocks.

A passage is repeated where a window of ``window`` words also starts earlier: in a smaller doc_id,
or earlier in the same document.

Reference blocks.  Every window is filed under its least 5-gram hash (the leftmost on a tie), its
anchor.  Consecutive windows with one anchor form a block, about one per 8 words for
windows of 20.  Equal windows have equal anchors, so all copies of a window lie in blocks of one
anchor, and where a copy goes on, its blocks are equal as a whole.

Parsing.  The index of all blocks of all documents is one shuffle by anchor, sorted by content.
A block that also stands earlier is copied as a whole; consecutive copied blocks with consecutive
sources are joined greedily into one factor.  At factor boundaries, where an anchor has blocks
of different content, windows are looked up one by one by a second shuffle, so
the removed words are exactly those of the definition.

Hot groups.  Rows are combined before each shuffle: of equal blocks that a task meets, the
earliest alone goes to the index, the others are known to be repeated and are spread.
Anchors that are frequent in a sample of documents (at most 10,000) are dealt by content
instead of by anchor, and all their windows are looked up; whatever the sample holds, the result
is the same.

Cases: a null text has no words; texts shorter than a window stay whole; a null doc_id comes after
all others; rows of equal doc_id are ordered by a hash of their text, of wholly equal rows the first
is the original; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillwarden.llm import wordhash
from tillwarden.llm.shared import texts, written

U = np.uint64
ANCHOR_WORDS = 5
SAMPLE_DOCS = 10_000  # documents looked at for frequent anchors
HOT_SHARE = 10_000  # an anchor is frequent beyond 1/HOT_SHARE of the sampled blocks
LAST = (1 << 63) - 1  # stands for a null doc_id
COMBINE_ROWS = 1_000_000

# span: start << 10 | hot << 9 | number of windows
ROWS = "key long, content long, doc long, variant long, span long, source_doc long, source_start long"
NAMES = [c.split()[0] for c in ROWS.split(", ")]
ORDER = ["key", "content", "doc", "variant", "span"]
COPIED, LOOK_UP = 1, 0
FOUND = "doc long, variant long, span long, source_doc long, source_start long, kind int"


def blocks(hashes: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, content hash, first window and number of windows of a text's blocks."""
    n = len(hashes) - window + 1
    if n <= 0:
        return (np.empty(0, U), np.empty(0, U), np.empty(0, np.int64), np.empty(0, np.int64))
    value = wordhash.grams(hashes, ANCHOR_WORDS)
    place = np.arange(len(value))
    have, want = 1, window - ANCHOR_WORDS + 1
    while have < want:  # least of the next `have` values becomes least of the next have + step
        step = min(have, want - have)
        right = value[step:] < value[:-step]
        value = np.where(right, value[step:], value[:-step])
        place = np.where(right, place[step:], place[:-step])
        have += step
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    count = np.diff(np.append(first, n))
    wordhash._grow(len(hashes) + 1)
    sums = np.concatenate(([U(0)], np.cumsum(hashes * wordhash._POWER[: len(hashes)])))
    content = (sums[first + count + window - 1] - sums[first]) * wordhash._INVERSE[first]
    shape = (count * 1024 + (place[first] - first)).astype(np.uint64)
    return value[first], wordhash.mix(content + shape), first, count


def _combined(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows of one task; all but the first of a content get a spread key and their source."""
    if not rows:
        return
    table = np.concatenate(rows, axis=1)
    order = np.lexsort(table[[4, 3, 2, 1, 0]])
    table = table[:, order]
    again = np.zeros(table.shape[1], dtype=bool)
    again[1:] = (table[0, 1:] == table[0, :-1]) & (table[1, 1:] == table[1, :-1])
    origin = np.maximum.accumulate(np.where(again, 0, np.arange(len(again))))
    source_doc = table[2, origin]
    source_start = table[4, origin] >> 10
    spread = wordhash.mix((table[2] ^ (table[4] << 20) ^ table[3]).view(U)).view(np.int64)
    key = np.where(again, spread, table[0])
    known = ~again
    columns = [pa.array(key), *(pa.array(table[i]) for i in range(1, 5))]
    columns += [pa.array(source_doc, mask=known), pa.array(source_start, mask=known)]
    for at in range(0, len(key), 50_000):
        yield pa.RecordBatch.from_arrays([c.slice(at, 50_000) for c in columns], NAMES)


def _rows(key, content, doc: int, variant: int, start, count, hot) -> np.ndarray:
    out = np.empty((5, len(key)), dtype=np.int64)
    out[0], out[1], out[2], out[3] = key.view(np.int64), content.view(np.int64), doc, variant
    out[4] = (start << 10) | (hot.astype(np.int64) << 9) | count
    return out


def _marked(rows: DataFrame, classes_matter: bool) -> DataFrame:
    """Copied rows with their source and, if asked for, rows to be looked up window by window.

    Rows are sorted by key and content: a row is copied if it equals the one before it, or was known
    to be.  A first row of its content is looked up if its key has more than one content.
    Only the row before and the state of the last key are carried along.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending = np.empty((5, 0), dtype=np.int64)  # first content of the last key, not yet emitted
        last = None  # key, content, source doc, source start, whether the key has several contents
        for batch in batches:
            if not batch.num_rows:
                continue
            now = np.stack([batch.column(i).to_numpy() for i in range(5)])
            known = ~np.asarray(batch.column(5).is_null())
            doc_of = batch.column(5).fill_null(0).to_numpy()
            start_of = batch.column(6).fill_null(0).to_numpy()
            n = now.shape[1]
            new_key = np.empty(n, dtype=bool)
            new_key[1:] = now[0, 1:] != now[0, :-1]
            new_key[0] = last is None or now[0, 0] != last[0]
            first = new_key.copy()
            first[1:] |= now[1, 1:] != now[1, :-1]
            first[0] |= last is None or now[1, 0] != last[1]
            copied = known | ~first
            origin = np.maximum.accumulate(np.where(first, np.arange(n), -1))
            inside = origin >= 0
            own_doc = np.where(inside, now[2, origin], last[2] if last else 0)
            own_start = np.where(inside, now[4, origin] >> 10, last[3] if last else 0)
            source_doc = np.where(known, doc_of, own_doc)
            source_start = np.where(known, start_of, own_start)

            out = [(now[:, copied], source_doc[copied], source_start[copied], COPIED)]
            if classes_matter:
                group = np.cumsum(new_key)  # 0: the key of the batch before
                lead = first & ~known
                leads = np.bincount(group[lead], minlength=group[-1] + 1)
                several = leads > 1
                if last is not None:
                    several[0] = last[4] or (leads[0] > 0 and pending.shape[1] > 0) or leads[0] > 1
                    if several[0] and pending.shape[1]:
                        out.append((pending, None, None, LOOK_UP))
                        pending = pending[:, :0]
                hot = (now[4] >> 9) & 1 == 1
                emit = lead & (several[group] | hot)
                out.append((now[:, emit], None, None, LOOK_UP))
                tail = lead & ~emit & (group == group[-1])
                if group[-1] > 0:
                    pending = pending[:, :0]
                if tail.any():
                    pending = now[:, tail]
                is_several = bool(several[-1])
            else:
                is_several = False
            last = (now[0, -1], now[1, -1], own_doc[-1], own_start[-1], is_several)
            for part, docs, starts, kind in out:
                size = part.shape[1]
                none = pa.nulls(size, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part[2]), pa.array(part[3]), pa.array(part[4]),
                        none if docs is None else pa.array(docs), none if docs is None else pa.array(starts),
                        pa.array(np.full(size, kind, dtype=np.int32)),
                    ],
                    [c.split()[0] for c in FOUND.split(", ")],
                )

    return rows.repartition("key").sortWithinPartitions(*ORDER).mapInArrow(mark, FOUND)


def _distinct_rows(docs: DataFrame) -> DataFrame:
    """doc, variant, text and copies: one row per doc_id and text."""
    plain = texts(docs).select(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "text")
    repeated = written(plain.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc"), "repeats")
    single = plain.select("doc", F.lit(0).cast("long").alias("variant"), "text", F.lit(1).cast("long").alias("copies"))
    if repeated.isEmpty():
        return single
    several = (
        plain.join(repeated, "doc", "left_semi")
        .groupBy("doc", "text")
        .agg(F.count(F.lit(1)).alias("copies"))
        .select("doc", F.xxhash64("text").alias("variant"), "text", "copies")
    )
    return written(single.join(repeated, "doc", "left_anti").union(several), "distinct-rows")


def _frequent_anchors(source: DataFrame, window: int) -> np.ndarray:
    """At most HOT_SHARE anchors, from a bounded sample of documents."""
    total = source.count()
    sample = source.sample(min(1.0, SAMPLE_DOCS / max(total, 1)), seed=9)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                found = np.unique(blocks(wordhash.words(text.as_py())[0], window)[0])
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["anchor"])

    counts = (
        sample.select(F.col("text").cast("binary"))
        .mapInArrow(anchors, "anchor long")
        .groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n >= 20")
    )
    top = counts.orderBy(F.desc("n")).limit(HOT_SHARE).collect()
    seen = sum(r.n for r in top)
    return np.sort(np.array([r.anchor for r in top if r.n * HOT_SHARE > seen], dtype=np.int64).view(U))


def _index_blocks(source: DataFrame, window: int, hot: np.ndarray) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            docs, variants = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, last, hashes, offsets in wordhash.word_batches(batch.column(2).to_pylist()):
                for i in range(first, last):
                    own = hashes[offsets[i - first] : offsets[i - first + 1]]
                    anchor, content, start, count = blocks(own, window)
                    is_hot = np.isin(anchor, hot)
                    key = np.where(is_hot, content, anchor)
                    rows.append(_rows(key, content, docs[i], variants[i], start, count, is_hot))
                    size += len(key)
            if size > COMBINE_ROWS:
                yield from _combined(rows)
                rows, size = [], 0
        yield from _combined(rows)

    return source.select("doc", "variant", F.col("text").cast("binary")).mapInArrow(cut, ROWS)


def _boundary_windows(source: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """The windows of all blocks to be looked up, one row each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            docs, variants = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            spans = batch.column(3)
            for first, last, hashes, offsets in wordhash.word_batches(batch.column(2).to_pylist()):
                for i in range(first, last):
                    span = np.asarray(spans[i].values)
                    content = wordhash.grams(hashes[offsets[i - first] : offsets[i - first + 1]], window)
                    count = span & 511
                    start = np.repeat(span >> 10, count) + _places(count)
                    none = np.zeros(len(start), dtype=bool)
                    own = content[start]
                    rows.append(_rows(own, own, docs[i], variants[i], start, np.ones_like(start), none))
                    size += len(start)
            if size > COMBINE_ROWS:
                yield from _combined(rows)
                rows, size = [], 0
        yield from _combined(rows)

    spans = wanted.groupBy(F.col("doc").alias("w_doc"), F.col("variant").alias("w_variant")).agg(
        F.collect_list("span").alias("spans")
    )
    joined = source.join(spans, (F.col("doc") == F.col("w_doc")) & (F.col("variant") == F.col("w_variant")))
    return joined.select("doc", "variant", F.col("text").cast("binary"), "spans").mapInArrow(cut, ROWS)


def _places(count: np.ndarray) -> np.ndarray:
    """0 .. c-1 for each c, in a row."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count)


def _factors(spans: np.ndarray, docs: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """Copied spans joined greedily where text and source both go on: start, words, source."""
    order = np.lexsort((starts, docs, spans))
    start, count = spans[order] >> 10, spans[order] & 511
    docs, shift = docs[order], starts[order] - start
    goes_on = np.zeros(len(start), dtype=bool)
    goes_on[1:] = (start[1:] <= start[:-1] + count[:-1]) & (docs[1:] == docs[:-1]) & (shift[1:] == shift[:-1])
    head = np.flatnonzero(~goes_on)
    stop = np.maximum.reduceat(start + count, head) + window - 1
    return np.stack([start[head], stop - start[head], docs[head], (start + shift)[head]])


PARSED = (
    "doc_id long, n_words long, n_removed long, kept_text binary, "
    "factors array<struct<start: long, words: long, source_doc: long, source_start: long>>"
)


def repeated_passages(docs: DataFrame, window: int = 50, keep_text: bool = True) -> DataFrame:
    """Every row's words without repeated passages, and the factors they were copied by.

    Returns doc_id, n_words, n_removed, kept_sha256, kept_text (words joined by one blank; null unless
    ``keep_text``) and factors: start and length in words, source document and start there.
    ``window`` is at most 500 words.
    """
    if not ANCHOR_WORDS < window <= 500:
        raise ValueError("window must be between 6 and 500 words")
    source = _distinct_rows(docs)
    hot = _frequent_anchors(source, window)
    found = written(_marked(_index_blocks(source, window, hot), True), "blocks")
    wanted = found.filter(F.col("kind") == LOOK_UP)
    windows = written(_marked(_boundary_windows(source, wanted, window), False), "windows")
    copied = found.filter(F.col("kind") == COPIED).union(windows)
    spans = copied.groupBy(F.col("doc").alias("s_doc"), F.col("variant").alias("s_variant")).agg(
        F.collect_list("span").alias("spans"),
        F.collect_list("source_doc").alias("docs"),
        F.collect_list("source_start").alias("starts"),
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        struct = pa.struct([(n, pa.int64()) for n in ("start", "words", "source_doc", "source_start")])
        for batch in batches:
            out = []
            for doc, copies, text, spans, docs, starts in zip(*batch.columns, strict=True):
                words = text.as_py().split()  # splits bytes at exactly the separators named above
                n = len(words)
                factors = np.empty((4, 0), dtype=np.int64)
                if spans.is_valid:
                    arrays = [np.asarray(x.values) for x in (spans, docs, starts)]
                    factors = _factors(*arrays, window)
                    edges = np.zeros(n + 1, dtype=np.int64)
                    np.add.at(edges, factors[0], 1)
                    np.add.at(edges, factors[0] + factors[1], -1)
                    kept = list(compress(words, (np.cumsum(edges[:-1]) == 0).tolist()))
                else:
                    kept = words
                listed = pa.StructArray.from_arrays([pa.array(f) for f in factors], fields=list(struct)).to_pylist()
                doc_id = doc.as_py() if doc.as_py() != LAST else None
                out.append((doc_id, n, n - len(kept), b" ".join(kept), listed))
                # further equal rows: each window starts earlier, so all words of a long text go
                for _ in range(copies.as_py() - 1):
                    gone = n >= window
                    copy = {"start": 0, "words": n, "source_doc": doc_id, "source_start": 0}
                    out.append((doc_id, n, n if gone else 0, b"" if gone else out[-1][3], [copy] if gone else []))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(struct)]
            sums = pa.array([hashlib.sha256(t).hexdigest() for t in columns[3]], pa.string())
            if not keep_text:
                columns[3] = [None] * len(out)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*arrays, sums], ["doc_id", "n_words", "n_removed", "kept_text", "factors", "kept_sha256"]
            )

    joined = source.join(
        spans, (F.col("doc") == F.col("s_doc")) & (F.col("variant") == F.col("s_variant")), "left"
    ).select("doc", "copies", F.col("text").cast("binary"), "spans", "docs", "starts")
    return joined.mapInArrow(parse, f"{PARSED}, kept_sha256 string")
