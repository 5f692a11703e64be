"""Small helpers of the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import math
import os
from collections.abc import Callable, Hashable, Iterator
from typing import Any, Generic, TypeVar

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillwarden.session import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Where a public vocabulary lies: the folder of ``TOKENIZER_DIR``, or the installed one."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def word_pattern() -> str:
    """The pattern that cuts texts into words for the rank files."""
    import public_tokenizers

    return public_tokenizers.PATTERN


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text only, so that further columns of any name cannot clash; a null text is empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def unused(df: DataFrame, name: str) -> str:
    """The name, or a longer one that no column of the frame has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: lineage ends here."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def total_bytes(df: DataFrame, column: str) -> int:
    return df.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0)).cast("long")).first()[0]


def parts_for(n_bytes: int, each: int) -> int:
    """Partitions of about ``each`` bytes."""
    return max(1, math.ceil(n_bytes / each))


# a blank before white space: a cut there may part a run of white space
_RUNS = tuple(" " + chr(c) for c in (*range(9, 14), *range(28, 33)))
_WIDE_RUNS = tuple(" " + chr(c) for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


def cut_before_blanks(text: str) -> list[str] | None:
    """The text cut before every blank; None if a run of white space would be parted.

    A blank begins a word for every tokenizer here, so tokens never cross such a cut.
    """
    if text.endswith(" ") or any(run in text for run in (_RUNS if text.isascii() else _RUNS + _WIDE_RUNS)):
        return None
    first, *rest = text.split(" ")
    return ([first] if first else []) + [" " + piece for piece in rest]


def slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows (id, text) with about ``size`` bytes of text; a longer text is a run of its own."""
    first = total = 0
    for at, length in enumerate(pc.binary_length(batch.column(1)).to_pylist()):
        if at > first and total + length > size:
            yield batch.slice(first, at - first)
            first, total = at, 0
        total += length
    if first < batch.num_rows:
        yield batch.slice(first)


def u32(column: Column) -> Column:
    """A signed 64-bit column's low 32 bits as a number from 0 on."""
    return column.bitwiseAND(F.lit(0xFFFFFFFF))


T = TypeVar("T")
_UNKNOWN: Any = object()

_KEPT: dict[tuple, Any] = {}  # of one operator at a time


def kept(operator: str, key: Hashable, make: Callable[[], T]) -> T:
    """What an operator keeps between the tasks of a Python worker, made at first use.

    A worker that changes to another operator drops what the one before kept, as workers outlive stages and stores
    of several operators would add up.
    """
    release(operator)
    if (operator, key) not in _KEPT:
        _KEPT[operator, key] = make()
    return _KEPT[operator, key]


def release(operator: str | None = None) -> None:
    """Drop what other operators kept in this worker, and give their memory back to the system."""
    others = [k for k in _KEPT if k[0] != operator]
    if not others:
        return
    for k in others:
        del _KEPT[k]
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


class WordStore(Generic[T]):
    """What is known of words, in two generations of bounded size.

    When the new generation is full it becomes the old one, and what was old goes.  A word that is met again
    moves from the old to the new one, so words met often stay, and those met once go.  A generation is full
    beyond ``limit`` words, or beyond a sum of ``limit`` of their weights, where words may be long.
    """

    def __init__(self, limit: int, weigh: Callable[[str, T], int] | None = None):
        self.limit = limit
        self.weigh = weigh
        self.weight = 0  # of the new generation
        self.new: dict[str, T] = {}
        self.old: dict[str, T] = {}

    def get(self, word: str) -> T | None:
        """What is known of a word, which is not marked as met again."""
        return self.new.get(word, self.old.get(word))

    def ready(self, words: set[str], learn: Callable[[set[str]], dict[str, T]]) -> dict[str, T]:
        """The new generation, in which all ``words`` are now known; ``learn`` gives those met for the first time."""
        if (len(self.new) if self.weigh is None else self.weight) > self.limit:
            self.old, self.new, self.weight = self.new, {}, 0
        first = set()
        met = words.difference(self.new)
        for word in met:
            known = self.old.pop(word, _UNKNOWN)
            if known is _UNKNOWN:
                first.add(word)
            else:
                self.new[word] = known
        if first:
            self.new.update(learn(first))
        if self.weigh is not None:
            self.weight += sum(self.weigh(word, self.new[word]) for word in met)
        return self.new
