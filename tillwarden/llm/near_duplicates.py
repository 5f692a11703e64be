"""Near-duplicate documents by MinHash with tensored banding, links confirmed on full sets.

Plain banding of T tables with k minima each needs T * k hash functions.  Here two
small collections of m groups of k/2 minima are computed, and the T = m * m table keys are the
pairs of one group of either collection: 2 * m * k / 2 functions, about the square root.  A pair of
similarity s meets in a table with probability (1 - (1 - s ** (k/2)) ** m) ** 2; with m = 8 and
k/2 = 2 this is 0.9994 at 0.8 and 0.99998 at 0.87.

1. Shingle sets, signatures and a 64-bit sketch per document; equal sets become one class.
2. Every class enters its m * m tables; buckets of one class go.
3. Rounds of star-shaped candidates: all members of a bucket against one (first the least, then
   a drawn one), only between different components of the links so far.  Pairs stay linear in the
   size of a bucket, however large a group of copies is.
4. What is still in another component than its bucket's drawn member is compared with every
   member of the bucket outside its own component, so no link of a bucket is left out.  A large
   group whose members are a little too different has many such pairs, so the join
   itself compares finer sketches: 512 bins of the hash range with four bits of each bin's least
   shingle.  A pair is looked at in its first common table only, and goes on unless its share of
   agreeing bins is four standard errors below the threshold.
5. Candidates that fit in size and sketch get their texts by two joins, and are confirmed on
   the full sets.  Up to 100,000 pairs their ids are broadcast, so only their texts are shuffled;
   beyond that, all texts are.

The sketch holds two bits of each minimum; a pair of similarity 0.8 agrees in 27 of 32 places on
average, and one below 17 (five standard deviations) is not looked at.

Cases: a null or wordless text has an empty set and no link; a null doc_id is linked with nothing,
its component_id is null and it is kept; rows of one doc_id share a component and are all
returned; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillwarden.llm import wordhash
from tillwarden.llm.components import components, joined_components
from tillwarden.llm.shared import release, texts, written

U = np.uint64
GROUPS = 8  # m: groups in a collection
MINIMA = 2  # minima in a group
SKETCH_LEAST = 17
BROADCAST_PAIRS = 100_000
BIN_BITS = 9
CODES = (1 << BIN_BITS) // 16  # longs of 16 four-bit codes
STANDARD_ERRORS = 4.0

_draw = np.random.Generator(np.random.PCG64(8))
_COUNT = 2 * GROUPS * MINIMA
_FACTORS = _draw.integers(0, 1 << 63, _COUNT, dtype=np.uint64) * U(2) + U(1)
_ADDENDS = _draw.integers(0, 1 << 63, _COUNT, dtype=np.uint64)


def shingle_sets(batch: list[bytes], k: int) -> Iterator[np.ndarray]:
    """The sorted set of k-word shingle hashes of each text."""
    for first, last, hashes, offsets in wordhash.word_batches(batch, lower=True):
        spans = wordhash.grams(hashes, k)
        for i in range(last - first):
            a, b = int(offsets[i]), int(offsets[i + 1])
            if b - a >= k:
                yield np.unique(spans[a : b - k + 1])
            elif b > a:
                yield np.array([wordhash.whole(hashes[a:b])], dtype=np.uint64)
            else:
                yield np.empty(0, dtype=np.uint64)


def _codes(values: np.ndarray) -> np.ndarray:
    """Four bits (1 to 15, 0: none) of the least value in each of 512 ranges, in 32 numbers."""
    bins = (values >> U(64 - BIN_BITS)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1]))) if len(values) else bins
    code = np.zeros(16 * CODES, dtype=np.uint64)
    code[bins[first]] = U(1) + (values[first] & U(0xFFFFFFFF)) % U(15)
    return (code.reshape(CODES, 16) << (U(4) * np.arange(16, dtype=np.uint64))).sum(axis=1, dtype=np.uint64)


def _minima(sets: list[np.ndarray]) -> np.ndarray:
    """(functions, sets) minima; every set has an element."""
    begins = np.cumsum([0, *(len(s) for s in sets[:-1])])
    flat = np.concatenate(sets)
    out = np.empty((_COUNT, len(sets)), dtype=np.uint64)
    for f in range(_COUNT):
        h = flat * _FACTORS[f] + _ADDENDS[f]
        h ^= h >> U(32)
        out[f] = np.minimum.reduceat(h, begins)
    return out


SIGNED = (
    "doc_id long, n_shingles long, set_id string, sketch long, "
    "left_groups array<long>, right_groups array<long>, codes array<long>"
)


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """Set size, set digest, sketch and the two collections of group hashes per document."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            sets = list(shingle_sets(batch.column(1).to_pylist(), k))
            sizes = [len(s) for s in sets]
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None for s in sets]
            filled = [i for i, s in enumerate(sets) if len(s)]
            sketch = np.zeros(len(sets), dtype=np.uint64)
            groups = np.zeros((len(sets), 2, GROUPS), dtype=np.uint64)
            for at in range(0, len(filled), 256):
                part = filled[at : at + 256]
                minima = wordhash.mix(_minima([sets[i] for i in part]))
                for f in range(_COUNT):
                    sketch[part] |= (minima[f] & U(3)) << U(2 * f)
                by_group = minima.reshape(2, GROUPS, MINIMA, len(part))
                hashed = by_group[:, :, 0]
                for i in range(1, MINIMA):
                    hashed = wordhash.mix(hashed * U(0x9E3779B97F4A7C15) + by_group[:, :, i])
                groups[part] = hashed.transpose(2, 0, 1)
            signed = groups.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(sketch.view(np.int64)),
                    pa.array(list(signed[:, 0]), pa.list_(pa.int64())),
                    pa.array(list(signed[:, 1]), pa.list_(pa.int64())),
                    pa.array([_codes(s).view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "set_id", "sketch", "left_groups", "right_groups", "codes"],
            )

    return texts(docs).select("doc_id", F.col("text").cast("binary")).mapInArrow(sign, SIGNED)


def _agreement(x: Column, y: Column) -> Column:
    """In how many of the 32 places two sketches agree."""
    differ = x.bitwiseXOR(y)
    either = differ.bitwiseOR(F.shiftrightunsigned(differ, 1)).bitwiseAND(F.lit(0x5555555555555555))
    return F.lit(_COUNT) - F.bit_count(either)


def _fits(percent: int) -> Column:
    small, large = F.least("n", "other_n"), F.greatest("n", "other_n")
    return (small * 100 >= large * percent) & (_agreement(F.col("sketch"), F.col("other_sketch")) >= SKETCH_LEAST)


def _table_key(table: Column, left: Column, right: Column) -> Column:
    return F.xxhash64(table, left, right)


def _close(percent: int) -> Column:
    """Whether two rows' codes agree in as many bins as similar sets' do, up to chance.

    The bins are a draw without replacement from the union, whose size two similar sets tell.
    """

    def filled(x: Column) -> Column:
        any_bit = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(any_bit, 2))
        return F.bit_count(any_bit.bitwiseAND(F.lit(0x1111111111111111)))

    share = percent / 100
    bins, differ = F.lit(0), F.lit(0)
    for i in range(CODES):
        x, y = F.get("codes", F.lit(i)), F.get("other_codes", F.lit(i))
        bins, differ = bins + filled(x.bitwiseOR(y)), differ + filled(x.bitwiseXOR(y))
    union = (F.col("n") + F.col("other_n")) / (1 + share)
    # a hundredth of a bin keeps the error above 0 where the bins hold the whole union
    spread = share * (1 - share) * F.greatest(1 - bins / union, F.lit(0.01)) * bins
    return bins - differ >= share * bins - STANDARD_ERRORS * F.sqrt(spread) - 1


def _first_common_table() -> Column:
    def first(mine: str, other: str) -> Column:
        return F.array_position(F.zip_with(mine, other, lambda x, y: x == y), F.lit(True)).cast("int") - 1

    i, j = first("left_groups", "other_left"), first("right_groups", "other_right")
    return _table_key(i * GROUPS + j, F.get("left_groups", i), F.get("right_groups", j)) == F.col("key")


def confirmed(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough; ``pairs`` is a written table.

    An id that stands on several rows is similar if any of its texts is.  The side of a star's
    centre is joined last, so rows that share it arrive together and its set is built once.
    """
    source = texts(docs)
    n_pairs = pairs.count()
    if n_pairs == 0:
        return pairs.select("a", "b")
    if n_pairs <= BROADCAST_PAIRS:
        ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        source = source.join(F.broadcast(ids), F.col("doc_id") == F.col("id"), "left_semi")
    one = source.select(F.col("doc_id").alias("a_id"), F.col("text").alias("a_text"))
    other = source.select(F.col("doc_id").alias("b_id"), F.col("text").alias("b_text"))
    both = (
        pairs.join(one, F.col("a") == F.col("a_id"))
        .select("a", "b", "a_text")
        .join(other, F.col("b") == F.col("b_id"))
        .select("a", "b", F.col("a_text").cast("binary"), F.col("b_text").cast("binary"))
    )

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        centre, centre_set = None, None
        for batch in batches:
            keep = []
            sets = shingle_sets(batch.column(2).to_pylist(), k)
            for mine, text in zip(sets, batch.column(3), strict=True):
                if text.as_py() != centre:
                    centre = text.as_py()
                    centre_set = next(shingle_sets([centre], k))
                common = len(np.intersect1d(mine, centre_set, assume_unique=True))
                keep.append(100 * common >= percent * (len(mine) + len(centre_set) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(confirm, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``."""
    signed = written(signatures(docs, shingle), "signatures")
    linkable = signed.filter("doc_id is not null and set_id is not null")
    first = F.min(F.struct("doc_id", "n_shingles", "sketch", "left_groups", "right_groups", "codes"))
    by_set = linkable.groupBy("set_id").agg(first.alias("c"), F.count(F.lit(1)).alias("n_rows"))
    classes = written(by_set.select("set_id", "n_rows", "c.*"), "classes")

    # tables: one row per class and pair of groups, buckets of a single class dropped
    keys = F.flatten(
        F.transform(
            "left_groups",
            lambda x, i: F.transform("right_groups", lambda y, j: _table_key(i * GROUPS + j, x, y)),
        )
    )
    entries = classes.select(
        F.explode(keys).alias("key"), "doc_id", F.col("n_shingles").cast("int").alias("n"), "sketch"
    )
    least = F.min(F.struct("doc_id", "n", "sketch")).alias("r")
    buckets = entries.groupBy("key").agg(least, F.count(F.lit(1)).alias("size")).filter("size > 1")
    # written, so that both sides of the join are plain shuffles and a large bucket can be split
    centres = written(buckets.select(F.col("key").alias("bucket"), "r"), "centres")
    members = written(
        entries.join(centres, F.col("key") == F.col("bucket")).select(
            "key", "doc_id", "n", "sketch", F.col("r.doc_id").alias("other"),
            F.col("r.n").alias("other_n"), F.col("r.sketch").alias("other_sketch"),
        ),
        "buckets",
    )

    repeated = linkable.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
    # a doc_id may stand on several rows: its classes are one node
    same_id = (
        linkable.join(repeated.select("doc_id"), "doc_id", "left_semi")
        .join(classes.select("set_id", F.col("doc_id").alias("b")), "set_id")
        .select(F.col("doc_id").alias("a"), "b")
    )

    def pairs_of(candidates: DataFrame) -> DataFrame:
        fit = candidates.filter((F.col("doc_id") != F.col("other")) & _fits(percent))
        return fit.select(F.col("doc_id").alias("a"), F.col("other").alias("b")).distinct()

    tried = written(pairs_of(members), "pairs")
    labels = written(components(confirmed(tried, docs, shingle, percent).union(same_id)), "labels")

    def untried(pairs: DataFrame) -> DataFrame:
        both = tried.union(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
        return pairs.join(both, ["a", "b"], "left_anti")

    def labelled() -> DataFrame:
        known = labels.select(F.col("doc_id").alias("node"), "component_id")
        return members.join(known, F.col("doc_id") == F.col("node"), "left").select(
            "key", "doc_id", "n", "sketch", F.coalesce("component_id", "doc_id").alias("comp")
        )

    # a drawn centre for every bucket that still holds several components
    now = written(labelled(), "labelled")
    drawn = F.min_by(F.struct("doc_id", "n", "sketch", "comp"), F.xxhash64("doc_id", "key"))
    mixed = now.groupBy("key").agg(drawn.alias("r"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    mixed = written(mixed.filter("lo < hi").select(
        F.col("key").alias("bucket"), F.col("r.doc_id").alias("other"), F.col("r.n").alias("other_n"),
        F.col("r.sketch").alias("other_sketch"), F.col("r.comp").alias("other_comp"),
    ), "mixed")
    apart = written(
        now.join(mixed, F.col("key") == F.col("bucket")).filter("comp != other_comp").drop("bucket"), "apart"
    )
    second = written(untried(pairs_of(apart)), "pairs")
    tried = tried.union(second)
    labels = joined_components(labels, written(confirmed(second, docs, shingle, percent), "links"))

    # the rest: rows outside their centre's component against the whole bucket
    comps = labels.select(F.col("doc_id").alias("node"), F.col("component_id").alias("new_comp"))
    comps_other = comps.select(F.col("node").alias("other_node"), F.col("new_comp").alias("new_other_comp"))
    rest = (
        apart.join(comps, F.col("doc_id") == F.col("node"), "left")
        .join(comps_other, F.col("other") == F.col("other_node"), "left")
        .withColumn("comp", F.coalesce("new_comp", "comp"))
        .filter(F.col("comp") != F.coalesce("new_other_comp", "other_comp"))
        .select("key", "doc_id", "n", "sketch", "comp")
    )
    rest = written(rest, "rest")
    signed_as = classes.select(F.col("doc_id").alias("signed_id"), "left_groups", "right_groups", "codes")
    mine = rest.join(signed_as, F.col("doc_id") == F.col("signed_id"))
    whole = (
        labelled()
        .join(rest.select(F.col("key").alias("rest_key")).distinct(), F.col("key") == F.col("rest_key"), "left_semi")
        .join(signed_as, F.col("doc_id") == F.col("signed_id"))
        .select(
            F.col("key").alias("bucket"), F.col("doc_id").alias("other"), F.col("n").alias("other_n"),
            F.col("sketch").alias("other_sketch"), F.col("comp").alias("other_comp"),
            F.col("left_groups").alias("other_left"), F.col("right_groups").alias("other_right"),
            F.col("codes").alias("other_codes"),
        )
    )
    crossed = mine.join(
        whole,
        (F.col("key") == F.col("bucket"))
        & (F.col("comp") != F.col("other_comp"))
        & _fits(percent)
        & _close(percent)
        & _first_common_table(),
    )
    third = written(untried(pairs_of(crossed)), "pairs")
    labels = joined_components(labels, written(confirmed(third, docs, shingle, percent), "links"))
    labels = labels.select(F.col("doc_id").alias("node"), "component_id")

    # only classes of several rows need to be looked up by their set
    shared_sets = classes.filter("n_rows > 1").select(
        F.col("set_id").alias("class_set"), F.col("doc_id").alias("class_id")
    )
    own = F.coalesce("class_id", "doc_id")
    placed = signed.select("doc_id", "n_shingles", "set_id").join(
        shared_sets, F.col("set_id") == F.col("class_set"), "left"
    ).select("doc_id", "n_shingles", own.alias("rep"))
    component = F.coalesce("component_id", "rep")
    return placed.join(labels, F.col("rep") == F.col("node"), "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
