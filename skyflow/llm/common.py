"""Helpers shared by the operators: written tables, state of a Python worker, Arrow batches, memoised tokenizing."""

from __future__ import annotations

import string
import sys
import types
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyflow.session import ensure_checkpoint_dir

ASCII_SPACE = " \t\n\x0b\x0c\r"


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches: a thousand texts at a time keep a Python worker's memory bounded."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a Parquet table in the folder of ``spark.checkpoint.dir``, read again.

    A written table outlives any executor; its later readers compute nothing twice.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes that a memory of a Python worker holds, about; longer keys are never kept.
KEPT_BYTES, LONGEST_KEY = 64 << 20, 64
#: An entry of a dict of short strings or bytes takes about so much besides their own lengths.
ENTRY_BYTES = 200


def worker_state(key: tuple, make: Callable[[], Any]) -> Any:
    """A value that tasks of one Python worker share; tasks of another operator (``key[0]``) drop it first."""
    store = _store()
    if key not in store:
        store[key] = make()
    return store[key]


def _store() -> dict:
    return sys.modules.setdefault("_skyflow_worker", types.ModuleType("_skyflow_worker")).__dict__.setdefault("kept", {})


def begin(owner: str = "") -> None:
    """First step of a task: lets go what other operators kept in this Python worker, and gives freed memory back."""
    import ctypes

    store = _store()
    for key in [k for k in store if k[0] != owner]:
        del store[key]
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Memory(dict):
    """A dict that takes new short keys until it holds about ``KEPT_BYTES``."""

    def __init__(self) -> None:
        self.room = KEPT_BYTES

    def keep(self, items: Iterable[tuple]) -> None:
        for key, value in items:
            if self.room <= 0:
                return
            if len(key) <= LONGEST_KEY:
                self[key] = value
                self.room -= ENTRY_BYTES + len(key) + len(value)


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with columns 0, 1, ... named ``c0``, ``c1``, ..., so that no name clashes with one that a step adds."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def id_crc32(col: Column) -> Column:
    """Unsigned crc32 of an id's decimal text."""
    return F.crc32(col.cast("string").cast("binary"))


def map_rows(df: DataFrame, fn: Callable[[Iterator[tuple]], Iterable[tuple]], schema: str, flush: int = 2000, owner: str = "") -> DataFrame:
    """``mapInArrow`` for a function from an iterator of row tuples to an iterable of row tuples.

    ``owner``: whose ``worker_state`` the tasks share.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for b in it:
                yield from zip(*(c.to_pylist() for c in b.columns))

        begin(owner)
        held: list[tuple] = []
        for row in fn(rows()):
            held.append(row)
            if len(held) >= flush:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), out)], schema=out)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), out)], schema=out)

    return df.mapInArrow(batches, schema)


#: What may trail a word as a match of its own: ASCII marks, but for the apostrophe, which can open a contraction.
_MARKS = string.punctuation.replace("'", "")


class WordEncoder:
    """Ids of the ``tokenizers`` library for whole texts, memoised by the words between spaces and line ends.

    The tokenizer lower-cases, drops white space and merges inside words only, so the ids of a text are those of its
    words one after another; each distinct word goes through the library. A word of Latin letters and marks behind
    them is looked up as two. Words and stems are kept within ``KEPT_BYTES`` each.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known, self.stems = Memory(), Memory()
        self.known[""] = b""

    @staticmethod
    def shared(path: str) -> WordEncoder:
        return worker_state(("words", path), lambda: WordEncoder(path))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        words = text.replace("\n", " ").split(" ")
        found = list(map(self.known.get, words))
        if None in found:
            missing = [i for i, f in enumerate(found) if f is None]
            new = self.look_up({words[i] for i in missing})
            for i in missing:
                found[i] = new[words[i]]
        return b"".join(found)

    def look_up(self, words: set[str]) -> dict[str, bytes]:
        split, new = {}, {}
        for w in words:
            stem = w.rstrip(_MARKS)
            if stem.isalpha() and max(stem) < "\u0250" and len(stem.lower()) == len(stem):
                split[w] = stem.lower(), w[len(stem) :]
        stems = self.letters({s for s, _ in split.values() if s not in self.stems})
        whole = list({w for w in words if w not in split} | {m for _, m in split.values() if m not in self.known})
        for w, e in zip(whole, self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)):
            new[w] = np.array(e.ids, "<u4").tobytes()
        for w, (stem, marks) in split.items():
            tail = new[marks] if marks in new else self.known[marks]
            new[w] = (stems[stem] if stem in stems else self.stems[stem]) + tail
        self.stems.keep(stems.items())
        self.known.keep(new.items())
        return new

    def letters(self, stems: set[str]) -> dict[str, bytes]:
        """Words of letters alone: many go through the library as one text, where each is a word of its own."""
        out, todo = {}, list(stems)
        for lo in range(0, len(todo), 2000):
            part = todo[lo : lo + 2000]
            e = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids, word = np.array(e.ids, "<u4"), np.array(e.word_ids)
            cuts = np.searchsorted(word, np.arange(len(part) + 1)) * 4
            data = ids.tobytes()
            out.update((w, data[a:b]) for w, a, b in zip(part, cuts.tolist(), cuts[1:].tolist()))
        return out
