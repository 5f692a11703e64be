"""Token ids as length-delimited binary records with a separate offset index.

File format, little-endian, one file per shard:

    u64  length of the payload
    u32  masked CRC-32 of those 8 bytes
    ...  payload: i64 doc_id, u8 flags (1: doc_id is null), u8 bytes per id (2 or 4), the ids
    u32  masked CRC-32 of the payload
    \\n   end of the record

Masking rotates the checksum right by 15 bits and adds 0xa282ead8, so that a checksum of
data that holds checksums is not weak.  The closing byte is the line separator of Spark's text
writer, through which the frames go: files appear by its commit protocol on any file
system Spark writes to, and a lost or repeated task leaves no half or double record.

Records ascend by doc_id over the shards; rows of equal doc_id follow the hash of their text.
The index is a table of its own: shard, path, offset and length of every frame, so a
reader can fetch records in any order (``read_shuffled``).

Cases: a null text is encoded as an empty one; an empty text has the end id only; a null doc_id
sorts first and stays null; repeated rows are all kept; an empty table gives an empty index;
further columns are ignored.  A text of any length is one record.
"""

from __future__ import annotations

import itertools
import os
import struct
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillwarden.llm.shared import WordStore, kept, parts_for, slices, texts, total_bytes

MASK_DELTA = 0xA282EAD8
HEAD = struct.Struct("<QI")
META = struct.Struct("<qBB")
TAIL = struct.Struct("<I")
FRAME_EXTRA = HEAD.size + TAIL.size + 1  # with the closing byte
CLOSE = "\n"
SLICE = 2 << 20  # bytes of text encoded at once

INDEX = "shard int, path string, doc_id long, offset long, length long, n_tokens long, before long, ids_crc32 long"


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, width: int) -> bytes:
    """One record without its closing byte; ids as little-endian integers of ``width`` bytes."""
    payload = META.pack(doc_id or 0, doc_id is None, width) + ids
    size = struct.pack("<Q", len(payload))
    return b"".join((size, TAIL.pack(masked_crc(size)), payload, TAIL.pack(masked_crc(payload))))


def unframe(data: bytes | memoryview, at: int) -> tuple[int, int | None, np.ndarray]:
    """Length of the frame at an offset, its doc_id and ids; a damaged frame is an error."""
    length, length_crc = HEAD.unpack_from(data, at)
    payload = bytes(data[at + HEAD.size : at + HEAD.size + length])
    end = at + HEAD.size + length
    if masked_crc(bytes(data[at : at + 8])) != length_crc or len(payload) != length:
        raise ValueError(f"damaged record length at byte {at}")
    if TAIL.unpack_from(data, end)[0] != masked_crc(payload) or data[end + TAIL.size] != ord(CLOSE):
        raise ValueError(f"damaged record at byte {at}")
    doc_id, is_null, width = META.unpack_from(payload)
    ids = np.frombuffer(payload, dtype=f"<u{width}", offset=META.size)
    return FRAME_EXTRA + length, None if is_null else doc_id, ids


class WordEncoder:
    """Ids of whole texts, with each distinct word given to the tokenizer once.

    The vocabulary's normaliser and pre-tokenizer never join anything across a blank or a line
    end, so a text's ids are its words' ids in a row.  Words between these two
    separators go to the library as they are (other white space inside included).  The store
    of known words is bounded: words met again stay, those met once go (``WordStore``).
    """

    KNOWN = 250_000  # words in a generation of the store
    LONG = 80  # longer words are encoded each time
    SEPARATOR = "\x01"
    ENDS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII marks; the pre-tokenizer has forms of its own for an apostrophe

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.model = self.tokenizer.model
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.store: WordStore[bytes] = WordStore(self.KNOWN)
        one = self.tokenizer.encode(self.SEPARATOR, add_special_tokens=False).ids
        self.mark = one[0] if len(one) == 1 else None
        # whether ASCII letters are only lower-cased before they reach the model
        self.direct = all(self._direct(w) == self._one(w) for w in ("a", "Word", "THE", "dont", "ILL", "xyzzyQ"))
        vocabulary = self.tokenizer.get_vocab()
        suffix = self.model.end_of_word_suffix
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        if suffix:
            self.ends_word[[i for entry, i in vocabulary.items() if entry.endswith(suffix)]] = True

    def _packed(self, ids: list[int]) -> bytes:
        return array("H" if self.width == 2 else "I", ids).tobytes()

    def _direct(self, word: str) -> bytes:
        return self._packed([token.id for token in self.model.tokenize(word.lower())])

    def _one(self, text: str) -> bytes:
        return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _stem(self, word: str) -> str:
        """The letters of a word that is letters and a run of end marks, and stays so when normalised; else nothing.

        The pre-tokenizer parts letters from marks.  Some letters are written as a letter and a mark by the normaliser
        (composed forms that it takes apart, a dotted capital I), and such a mark joins an end mark.
        """
        stem = word.rstrip(self.ENDS)
        if len(stem) == len(word) or not stem.isalpha():
            return ""
        return stem if stem.isascii() or unicodedata.normalize("NFC", stem).lower().isalpha() else ""

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of new words; a word of letters and end marks is put together from the two."""
        found = {"": b""}
        marked, parts, wanted = [], set(), []
        for word in words:
            stem = "" if word.isalpha() else self._stem(word)
            if stem:
                end = word[len(stem) :]
                marked.append((word, stem, end))
                parts.add(stem)
                parts.add(end)
            else:
                wanted.append(word)
        for part in parts:
            known = self.store.get(part)
            if known is None:
                wanted.append(part)
            else:
                found[part] = known
        self._learn_whole(list(set(wanted).difference(found)), found)
        for word, stem, end in marked:
            found[word] = found[stem] + found[end]
        return found

    def _learn_whole(self, words: list[str], found: dict[str, bytes]) -> None:
        """Words in three kinds, each the cheapest way through the library.

        ASCII letters go to the model at once, as normalising only lower-cases them and nothing cuts them.  Words that are
        letters when normalised are one word each to the pre-tokenizer, so the last token of each is one that ends
        a word; they are encoded many in a row.  All others are parted by a separator.
        """
        plain, letters, others = [], [], []
        for word in words:
            if not word.isalpha():
                others.append(word)
            elif word.isascii():
                (plain if self.direct else letters).append(word)
            elif unicodedata.normalize("NFC", word).lower().isalpha():
                letters.append(word)
            else:
                others.append(word)
        ids, ends, tokenize = [], [], self.model.tokenize
        for word in plain:
            ids += [token.id for token in tokenize(word.lower())]
            ends.append(len(ids) * self.width)
        packed, start = self._packed(ids), 0
        for word, end in zip(plain, ends, strict=True):
            found[word] = packed[start:end]
            start = end
        for group in (letters[i : i + 500] for i in range(0, len(letters), 500)):
            (encoded,) = self.tokenizer.encode_batch_fast([" ".join(group)], add_special_tokens=False)
            ids = np.asarray(encoded.ids, dtype=f"<u{self.width}")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(group):
                self._cut(group, ids, np.concatenate(([0], ends[:-1])), ends, found)
            else:  # letters that the library does not know as such
                others += group
        apart = [w for w in others if self.mark is None or self.SEPARATOR in w]
        for w in apart:
            found[w] = self._one(w)
        rest = [w for w in others if w not in found]
        gap = f" {self.SEPARATOR} "
        for group in (rest[i : i + 500] for i in range(0, len(rest), 500)):
            (encoded,) = self.tokenizer.encode_batch_fast([gap.join(group)], add_special_tokens=False)
            ids = np.asarray(encoded.ids, dtype=f"<u{self.width}")
            ends = np.flatnonzero(ids == self.mark)
            self._cut(group, ids, np.concatenate(([0], ends + 1)), np.concatenate((ends, [len(ids)])), found)

    def _cut(self, group: list[str], ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, found: dict[str, bytes]) -> None:
        packed = ids.tobytes()
        for word, start, end in zip(group, (starts * self.width).tolist(), (ends * self.width).tolist(), strict=True):
            found[word] = packed[start:end]

    def encode(self, batch: pa.Array | list[str]) -> Iterator[bytes]:
        """Packed ids of each text.

        Arrow cuts the texts and tells equal words apart; ids of distinct words are looked up, and numpy lays them out.
        """
        column = batch if isinstance(batch, pa.Array) else pa.array(batch, pa.string())
        cut = pc.split_pattern(pc.replace_substring(column, "\n", " "), " ")
        ends = (cut.offsets.to_numpy() - cut.offsets[0].as_py()).tolist()
        coded = cut.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        long = {w for w in words if len(w) > self.LONG}
        known = self.store.ready(set(words).difference(long), self._learn)
        packed = [self._one(w) if w in long else known[w] for w in words] if long else [known[w] for w in words]
        sizes = np.fromiter(map(len, packed), dtype=np.int64, count=len(packed)) // self.width
        starts = np.cumsum(sizes) - sizes
        word_ids = np.frombuffer(b"".join(packed), dtype=f"<u{self.width}")
        places = coded.indices.to_numpy()
        lengths = sizes[places]
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        ids = word_ids[np.repeat(starts[places] - bounds[:-1], lengths) + np.arange(bounds[-1])].tobytes()
        cuts = (bounds[ends] * self.width).tolist()
        for first, last in itertools.pairwise(cuts):
            yield ids[first:last]


def encoder(tokenizer_json: str) -> WordEncoder:
    """One per Python worker, kept between tasks."""
    return kept("token_records", hash(tokenizer_json), lambda: WordEncoder(tokenizer_json))


def write_records(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1, shard_bytes: int = 32 << 20
) -> None:
    """Encode every text and write the record files to ``folder``.

    The shard number follows the bytes of text, ranges of doc_id follow sampled quantiles.
    One shuffle of the texts; the vocabulary (a fixed file) is broadcast.
    """
    spark = docs.sparkSession
    source = texts(docs)
    with open(tokenizer_path, encoding="utf-8") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())
    # equal rows may be cut anywhere, hence the row's place in the input as the last key
    keyed = source.withColumn("tie", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    shards = parts_for(total_bytes(source, "text"), shard_bytes)
    ordered = keyed.repartitionByRange(shards, "doc_id", "tie", "place").sortWithinPartitions("doc_id", "tie", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary.value)
        end = np.asarray([end_id], dtype=f"<u{enc.width}").tobytes()
        for whole in batches:
            for batch in slices(whole, SLICE):
                doc_ids = batch.column(0).to_pylist()
                all_ids = enc.encode(batch.column(1))
                out = [frame(doc_id, ids + end, enc.width) for doc_id, ids in zip(doc_ids, all_ids, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    frames = ordered.select("doc_id", "text").mapInArrow(encode, "record binary")
    frames.select(F.col("record").cast("string").alias("value")).write.option("lineSep", CLOSE).text(folder)


def scan_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every frame of the files: its place, doc_id, counts and the CRC-32 of its ids as u32."""
    files = spark.read.format("binaryFile").load(folder).select("path", "content")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shard", "path", "doc_id", "offset", "length", "n_tokens", "before", "ids_crc32"]
        kinds = [pa.int32(), pa.string(), *[pa.int64()] * 6]
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = memoryview(content.as_buffer())
                shard = int(path.rpartition("/part-")[2].split("-")[0])
                at = before = 0
                rows = []
                while at < len(data):
                    length, doc_id, ids = unframe(data, at)
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    rows.append((shard, path, doc_id, at, length, len(ids), before, crc))
                    at += length
                    before += len(ids)
                columns = list(zip(*rows, strict=True)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
                )

    return files.mapInArrow(scan, INDEX)


def write_index(spark: SparkSession, folder: str, index_folder: str) -> None:
    """The offset index of the record files, from a scan that checks every checksum."""
    scan_records(spark, folder).write.parquet(index_folder)


def read_index(spark: SparkSession, index_folder: str) -> DataFrame:
    """The index with ``start``: the number of ids in all records before this one.

    Totals are summed per shard first; only one row per shard meets in the running sum.
    """
    index = spark.read.schema(INDEX).parquet(index_folder)
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("shard_tokens"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        F.col("shard").alias("base_shard"), F.coalesce(F.sum("shard_tokens").over(earlier), F.lit(0)).alias("base")
    )
    return index.join(bases, index.shard == bases.base_shard).select(
        *index.columns, (F.col("base") + F.col("before")).cast("long").alias("start")
    )


def read_shuffled(spark: SparkSession, index_folder: str, seed: int, parts: int) -> DataFrame:
    """Records in an order drawn by ``seed``: partition by partition, row by row.

    Rows of the index, not records, are shuffled; each task then fetches its frames by offset.
    """
    index = spark.read.schema(INDEX).parquet(index_folder)
    drawn = index.withColumn("draw", F.xxhash64(F.lit(seed), "path", "offset"))
    ordered = drawn.repartitionByRange(parts, "draw", "path", "offset").sortWithinPartitions("draw", "path", "offset")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        open_files: dict = {}
        for batch in batches:
            doc_ids, all_ids = [], []
            for row in batch.to_pylist():
                if row["path"] not in open_files:
                    if len(open_files) >= 64:
                        open_files.pop(next(iter(open_files))).close()
                    system, path = fs.FileSystem.from_uri(row["path"])
                    open_files[row["path"]] = system.open_input_file(path)
                data = open_files[row["path"]].read_at(row["length"], row["offset"])
                _, doc_id, ids = unframe(data, 0)
                doc_ids.append(doc_id)
                all_ids.append(ids.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(all_ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    return ordered.select("path", "offset", "length").mapInArrow(fetch, "doc_id long, ids array<int>")
