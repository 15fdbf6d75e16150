"""Lines that repeat across documents, found with two Bloom filters.

Every task sets the hashes of its lines in a filter "seen" and, when they come again, in a filter "seen twice";
the filters of all tasks meet by segment, a bit set in two "seen" filters counting as seen twice. Only lines
that the merged second filter holds are shuffled, grouped by their full key, and confirmed exactly.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from skyflow.llm.common import ASCII_SPACE, begin, map_rows, numbered, prepare, written

SEGMENT_BITS = 16
#: The filter has 16 bits for each line, within these powers of two; 2**28 bits are 32 MB a filter in each task.
#: Beyond that more lines pass the filter and are shuffled; the result stays exact.
LEAST_BITS, MOST_BITS = 20, 28
_STRIP = ASCII_SPACE.encode()


def line_key(line: bytes) -> bytes:
    return line.strip(_STRIP).lower()  # bytes.lower() changes A-Z only


def keys_of(text: str | None, least: int) -> set[bytes]:
    """Keys of at least ``least`` code points among the lines of a text."""
    if not text:
        return set()
    keys = {line_key(x) for x in text.encode().split(b"\n")}
    return {k for k in keys if len(k) >= least and (len(k) >= 4 * least or len(k.decode()) >= least)}


def positions(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bits for each hash, in the same segment."""
    inner = np.uint64((1 << SEGMENT_BITS) - 1)
    base = (hashes >> np.uint64(64 - bits)) & ~inner
    return base | (hashes & inner), base | ((hashes >> np.uint64(20)) & inner)


def read_bits(packed: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (packed[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 > 0


def set_bits(packed: np.ndarray, at: np.ndarray) -> None:
    if len(at):
        at = np.sort(at)
        byte = (at >> np.uint64(3)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, byte[1:] != byte[:-1]])
        packed[byte[first]] |= np.bitwise_or.reduceat((128 >> (at & np.uint64(7)).astype(np.int64)).astype(np.uint8), first)


def _task_filters(rows: Iterator[tuple], bits: int, least: int) -> Iterator[tuple]:
    from xxhash import xxh3_64_intdigest

    once, twice = np.zeros(1 << (bits - 3), np.uint8), np.zeros(1 << (bits - 3), np.uint8)

    def add(hashes: list[int]) -> None:
        h, n = np.unique(np.array(hashes, np.uint64), return_counts=True)
        a, b = positions(h, bits)
        again = (n > 1) | (read_bits(once, a) & read_bits(once, b))
        set_bits(once, np.concatenate([a, b]))
        set_bits(twice, np.concatenate([a[again], b[again]]))

    held: list[int] = []
    for (text,) in rows:
        held += [xxh3_64_intdigest(k) for k in keys_of(text, least)]
        if len(held) > 100_000:
            add(held)
            held = []
    if held:
        add(held)
    once, twice = (x.reshape(-1, 1 << (SEGMENT_BITS - 3)) for x in (once, twice))
    for k in np.flatnonzero(once.any(1)):
        yield int(k), *(zlib.compress(x[k].tobytes(), 1) for x in (once, twice))


def _merge(rows: Iterator[tuple]) -> Iterator[tuple]:
    met: dict[int, list[np.ndarray]] = {}
    for k, *parts in rows:
        one, two = (np.frombuffer(zlib.decompress(p), np.uint8) for p in parts)
        if k not in met:
            met[k] = [one.copy(), two.copy()]
            continue
        once, twice = met[k]
        twice |= two | (once & one)
        once |= one
    for k, (_, twice) in met.items():
        if twice.any():
            yield k, zlib.compress(twice.tobytes(), 1)


def suspects(docs: DataFrame, least: int = 10) -> DataFrame:
    """doc_id and key (bytes) of every line that may occur in two documents; each key once a document."""
    spark = docs.sparkSession
    lines = docs.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1)).first()[0] or 0
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * lines).bit_length()))
    parts = map_rows(docs.select("text"), lambda rows: _task_filters(rows, bits, least), "segment int, once binary, twice binary", 64)
    merged = map_rows(parts.repartition("segment"), _merge, "segment int, twice binary", 64)
    # at most 2**(MOST_BITS - 3) bytes
    sent = spark.sparkContext.broadcast({r["segment"]: bytes(r["twice"]) for r in merged.toLocalIterator()})

    def probe(rows: Iterator[tuple]) -> Iterator[tuple]:
        from xxhash import xxh3_64_intdigest

        seen = np.zeros(1 << (bits - SEGMENT_BITS), bool)
        packed = np.zeros((len(seen), 1 << (SEGMENT_BITS - 3)), np.uint8)
        for k, twice in sent.value.items():
            seen[k], packed[k] = True, np.frombuffer(zlib.decompress(twice), np.uint8)
        packed = packed.reshape(-1)
        for doc_id, text in rows:
            keys = sorted(keys_of(text, least)) if doc_id is not None else ()
            if keys:
                a, b = positions(np.array([xxh3_64_intdigest(k) for k in keys], np.uint64), bits)
                for i in np.flatnonzero(read_bits(packed, a) & read_bits(packed, b)):
                    yield doc_id, keys[i]

    return map_rows(docs.select("doc_id", "text"), probe, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, key binary")


def dedup_lines(docs: DataFrame, least: int = 10) -> DataFrame:
    """Every row of ``docs`` with its repeated lines dropped, in the columns ``text``, ``n_lines`` and ``n_dropped``.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Keys of at least ``least``
    code points in two or more documents keep their lines in the smallest doc_id only. A null or empty text is one
    empty line. Rows of one doc_id are one document. A null doc_id takes no part: its lines all stay. All columns
    of ``docs`` are carried; clashing ``n_lines`` and ``n_dropped`` are replaced.
    """
    prepare(docs.sparkSession)
    found = written(suspects(docs, least), "lines")
    first = found.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    # written, so that the join deals both sides anew and AQE can split the rows of a line that most documents have
    first = written(first.where("first < last").select("key", "first"), "repeated-lines")
    drops = found.join(first, "key").where("doc_id > first").groupBy("doc_id").agg(F.collect_set("key").alias("drop"))
    docs = docs.drop("n_lines", "n_dropped")
    names, plain = docs.columns, numbered(docs)
    at, id_at, columns = names.index("text"), names.index("doc_id"), plain.columns
    drops = drops.select(F.col("doc_id").alias("id"), "drop")
    # rows without an id meet no drops: a null key would bring them all into one task
    plain = plain.withColumn("spread", F.when(F.col(columns[id_at]).isNull(), -F.rand(1)).otherwise(F.lit(0.0)))
    joined = plain.join(drops.withColumn("zero", F.lit(0.0)), (plain[columns[id_at]] == F.col("id")) & (F.col("spread") == F.col("zero")), "left").select(*columns, "drop")
    fields = [StructField(columns[at], StringType()) if i == at else f for i, f in enumerate(joined.schema.fields[:-1])]

    def strip(batches):
        import pyarrow as pa

        begin()
        for b in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, drop in zip(b.column(at).to_pylist(), b.column(len(columns)).to_pylist()):
                lines = (text or "").encode().split(b"\n")
                kept = lines
                if drop:
                    gone = set(drop)
                    kept = [x for x in lines if line_key(x) not in gone]
                texts.append(b"\n".join(kept).decode())
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            found = [pa.array(texts, pa.string()) if i == at else b.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*found, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=[*columns, "n_lines", "n_dropped"])

    out = StructType([*fields, StructField("n_lines", LongType()), StructField("n_dropped", LongType())])
    return joined.mapInArrow(strip, out).toDF(*names, "n_lines", "n_dropped")
