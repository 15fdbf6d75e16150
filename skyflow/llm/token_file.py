"""Token ids of a corpus in a file of canonical, length-limited Huffman codes.

Codes come from the counts of all ids. The file is a Parquet table whose rows are independent blocks of whole
documents: the coded bits, the documents' ids and lengths, and the bit offset of every ``LANE``-th id, from which
decoding can start. All lanes of a block are decoded side by side through one table of the next ``LIMIT`` bits.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyflow.llm.common import WordEncoder, map_rows, prepare, written

#: Longest code in bits; at most 24.
LIMIT = 18
#: A block ends with the document that reaches so many ids.
BLOCK_IDS = 1 << 18
LANE = 64


def token_ids(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """doc_id, ids and width of every text and the end id; a null text is empty.

    ``ids`` are little-endian unsigned integers of ``width`` bytes: 2 where the tokenizer's ids allow it, else 4.
    """
    from tokenizers import Tokenizer

    width = 2 if max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    end = end_id.to_bytes(4, "little")

    def encode(rows: Iterator[tuple]) -> Iterator[tuple]:
        encoder = WordEncoder.shared(tokenizer)
        for doc_id, text in rows:
            yield doc_id, np.frombuffer(encoder.encode(text or "") + end, "<u4").astype(f"<u{width}").tobytes(), width

    prepare(docs.sparkSession)
    return map_rows(docs.select("doc_id", "text"), encode, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary, width int", 500, "words")


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``limit`` bits (package-merge); 0 for ids that don't occur."""
    lengths = np.zeros(len(counts), np.uint8)
    ids = np.flatnonzero(counts)
    ids = ids[np.argsort(counts[ids], kind="stable")]
    leaves = counts[ids].astype(np.int64)
    n = len(ids)
    if n < 2:
        lengths[ids] = 1
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} ids do not fit in codes of {limit} bits")
    level, leaf_at = leaves, []
    for _ in range(limit):
        leaf_at.append(np.ones(n, bool) if not leaf_at else order < n)
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, pairs])
        order = np.argsort(both, kind="stable")
        level = both[order]
    need = 2 * n - 2
    for is_leaf in reversed(leaf_at):
        taken = int(is_leaf[:need].sum())
        lengths[ids[:taken]] += 1
        need = 2 * (need - taken)
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes = np.zeros(len(lengths), np.uint32)
    code = last = 0
    for bits in range(1, int(lengths.max(initial=0)) + 1):
        code <<= bits - last
        last = bits
        ids = np.flatnonzero(lengths == bits)
        codes[ids] = code + np.arange(len(ids), dtype=np.uint32)
        code += len(ids)
    return codes


def encode_block(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Coded bits and the bit offset of every LANE-th id."""
    if not len(ids):
        return b"", np.zeros(0, np.int64)
    bits = lengths[ids].astype(np.int64)
    at = np.cumsum(bits) - bits
    placed = codes[ids].astype(np.uint64) << (64 - bits - (at & 31)).astype(np.uint64)
    word = at >> 5  # codes are shorter than a word, so one starts in every word
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    out = np.zeros(len(first) + 1, np.uint32)
    out[:-1] = np.bitwise_or.reduceat(placed >> np.uint64(32), first)
    out[1:] |= np.bitwise_or.reduceat(placed & np.uint64(0xFFFFFFFF), first).astype(np.uint32)
    return out.astype(">u4").tobytes()[: int(at[-1] + bits[-1] + 7) // 8], at[::LANE]


def decode_table(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Id and code length for each value of the next ``limit`` bits."""
    codes, ids = canonical(lengths), np.flatnonzero(lengths)
    symbol, size = np.zeros(1 << limit, np.uint32), np.ones(1 << limit, np.uint8)
    ids = ids[np.lexsort((ids, lengths[ids]))]
    width = 1 << (limit - lengths[ids].astype(np.int64))
    n = int(width.sum())
    symbol[:n], size[:n] = np.repeat(ids, width), np.repeat(lengths[ids], width)
    assert not len(ids) or codes[ids[0]] == 0
    return symbol, size


def decode_block(payload: bytes, lanes: np.ndarray, n: int, table: tuple[np.ndarray, np.ndarray], limit: int) -> np.ndarray:
    """The ``n`` ids of a block; every lane starts at its own bit offset."""
    symbol, size = table
    data = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
    word = (data[:-3] << np.uint32(24)) | (data[1:-2] << np.uint32(16)) | (data[2:-1] << np.uint32(8)) | data[3:]
    out = np.zeros((len(lanes), LANE), np.uint32)
    pos, most, mask = lanes.astype(np.int64).copy(), 8 * len(payload), np.uint32((1 << limit) - 1)
    for k in range(LANE):
        low = np.minimum(pos, most)
        look = (word[low >> 3] >> (32 - limit - (low & 7)).astype(np.uint32)) & mask
        out[:, k] = symbol[look]
        pos += size[look]
    return out.reshape(-1)[:n]


def write_token_file(ids: DataFrame, path: str, limit: int = LIMIT) -> None:
    """Writes ``ids`` (doc_id, ids, width) in ascending doc_id order to ``path``/blocks, and its codes to ``path``/codes.

    Null ids come first; rows of equal doc_id lie in the order of their ids' bytes. No rows make empty tables.
    """
    spark = ids.sparkSession

    def count(rows: Iterator[tuple]) -> Iterator[tuple]:
        total = np.zeros(0, np.int64)
        held: list[np.ndarray] = []

        def add() -> None:
            nonlocal total
            part = np.bincount(np.concatenate(held)) if held else np.zeros(0, np.int64)
            if len(part) > len(total):
                total, part = part, total
            total[: len(part)] += part
            held.clear()

        for data, width in rows:
            held.append(np.frombuffer(data, f"<u{width}"))
            if len(held) == 500:
                add()
        add()
        yield from ((int(i), int(total[i])) for i in np.flatnonzero(total))

    # one row for each id of the vocabulary
    counted = map_rows(ids.select("ids", "width"), count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max([r["id"] + 1 for r in counted], default=0), np.int64)
    for r in counted:
        counts[r["id"]] = r["n"]
    limit = max(limit, len(counted).bit_length())
    lengths = code_lengths(counts, limit)
    rows = [(int(i), int(lengths[i]), limit) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(rows, "id int, bits int, limit int").coalesce(1).write.parquet(f"{path}/codes")
    sent = spark.sparkContext.broadcast((canonical(lengths), lengths))
    id_type = ids.schema["doc_id"].dataType.simpleString()

    def blocks(rows: Iterator[tuple]) -> Iterator[tuple]:
        from pyspark import TaskContext

        codes, sizes = sent.value
        part, number, start = TaskContext.get().partitionId(), 0, 0
        doc_ids: list = []
        held: list[np.ndarray] = []
        total = 0
        for doc_id, data, width in rows:
            doc_ids.append(doc_id)
            held.append(np.frombuffer(data, f"<u{width}"))
            total += len(held[-1])
            if total >= BLOCK_IDS:
                yield part, number, start, total, doc_ids, [len(x) for x in held], *_block(held, codes, sizes)
                number, start, total, doc_ids, held = number + 1, start + total, 0, [], []
        if held:
            yield part, number, start, total, doc_ids, [len(x) for x in held], *_block(held, codes, sizes)

    ordered = ids.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    schema = f"part int, block int, start_in_part long, n_ids long, doc_ids array<{id_type}>, sizes array<int>, lanes array<int>, payload binary"
    map_rows(ordered, blocks, schema, 1).write.parquet(f"{path}/blocks")


def _block(held: list[np.ndarray], codes: np.ndarray, sizes: np.ndarray) -> tuple[list[int], bytes]:
    payload, lanes = encode_block(np.concatenate(held), codes, sizes)
    return lanes.tolist(), payload


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids (little-endian, 4 bytes each), decoded from the file."""
    prepare(spark)
    rows = spark.read.parquet(f"{path}/codes").collect()  # one for each id of the vocabulary
    lengths = np.zeros(max([r["id"] + 1 for r in rows], default=0), np.uint8)
    for r in rows:
        lengths[r["id"]] = r["bits"]
    limit = rows[0]["limit"] if rows else LIMIT
    stored = spark.read.parquet(f"{path}/blocks")
    id_type = stored.schema["doc_ids"].dataType.elementType.simpleString()
    before, total = {}, 0  # one number for each part of the file
    for r in sorted(stored.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()):
        before[r["part"]], total = total, total + r["n"]
    sent = spark.sparkContext.broadcast((lengths, before))

    def decode(rows: Iterator[tuple]) -> Iterator[tuple]:
        sizes_of, starts = sent.value
        table = decode_table(sizes_of, limit)
        for part, start, n, doc_ids, sizes, lanes, payload in rows:
            ids = decode_block(payload, np.array(lanes, np.int64), n, table, limit)
            at, start = 0, start + starts[part]
            for doc_id, size in zip(doc_ids, sizes):
                yield doc_id, start + at, ids[at : at + size].astype("<u4").tobytes()
                at += size

    coded = stored.select("part", "start_in_part", "n_ids", "doc_ids", "sizes", "lanes", "payload")
    return map_rows(coded, decode, f"doc_id {id_type}, start long, ids binary", 500)


def encode_corpus(docs: DataFrame, tokenizer: str, path: str, end_id: int = 2) -> DataFrame:
    """Writes the token file of ``docs`` to ``path`` and returns what it holds."""
    write_token_file(written(token_ids(docs, tokenizer, end_id), "ids"), path)
    return read_token_file(docs.sparkSession, path)


def digests(file: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of the documents of a file."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("ids").to_pylist()
            n, crc = pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), n, crc], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return file.mapInArrow(digest, f"doc_id {file.schema['doc_id'].dataType.simpleString()}, start long, n_tokens long, ids_crc32 long")
