"""Exact dedup in three skew-safe steps, with full contents compared in each.

Equal texts of one task are combined there, so a group of any size leaves one row in each task. Those winners are
combined by digest and salt, and the salts' winners by digest. A digest only brings rows together: contents decide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyflow.llm.common import map_rows, prepare, written

#: A digest's winners of single tasks are dealt over so many salts first.
SALTS = 16
#: Bytes of contents that a task holds at once; past them it starts anew, leaving one more row for a group.
HELD_BYTES = 64 << 20


def normalised(text: str | None) -> bytes:
    return (text or "").encode().lower()  # bytes.lower() changes A-Z only


def dedup(docs: DataFrame, digest: Callable[[bytes], bytes] | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept and digest of every row of ``docs``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The largest doc_id of a group stays;
    a null id is smaller than any other, so a group of null ids only has the keep_id null. Rows repeated with the
    largest doc_id are all marked kept. Other columns of ``docs`` are not looked at. ``digest`` (SHA-256) may collide.
    """
    spark = prepare(docs.sparkSession)
    hashed = digest or (lambda data: hashlib.sha256(data).digest())
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def local(rows: Iterator[tuple]) -> Iterator[tuple]:
        """Every row with its group in the task; then a row of each group, with its content (packed without loss)."""
        from pyspark import TaskContext

        part, pack = TaskContext.get().partitionId(), zstandard.ZstdCompressor(level=3).compress
        groups: dict[bytes, list[list]] = {}
        number, held = 0, 0
        for doc_id, text in rows:
            content = normalised(text)
            key = hashed(content)
            same = groups.setdefault(key, [])
            found = next((g for g in same if (zstandard.decompress(g[0]) if g[0] else b"") == content), None)
            if found is None:
                found = [pack(content) if content else b"", number, doc_id, 0]
                same.append(found)
                number, held = number + 1, held + len(found[0]) + len(key) + 200
            elif found[2] is None or (doc_id is not None and doc_id > found[2]):
                found[2] = doc_id
            found[3] += 1
            yield doc_id, key, part, found[1], None, None
            if held > HELD_BYTES:
                yield from ((g[2], k, part, g[1], g[3], g[0]) for k, same in groups.items() for g in same)
                groups, held = {}, 0
        yield from ((g[2], k, part, g[1], g[3], g[0]) for k, same in groups.items() for g in same)

    found = written(map_rows(docs.select("doc_id", "text"), local, f"doc_id {id_type}, digest binary, part int, local int, n long, content binary", 500), "exact")
    rows, winners = found.where("n is null"), found.where("n is not null").withColumnRenamed("doc_id", "keep_id")
    member = "members array<struct<part:int,local:int>>"
    schema = f"salt int, digest binary, content binary, keep_id {id_type}, n long, {member}"

    def combine(items: Iterator[tuple]) -> Iterator[tuple]:
        """Rows sorted by digest: those of one content become one. Holds the contents of one digest at a time."""
        now, groups = None, {}
        for salt, key, content, keep_id, n, members in items:
            if (salt, key) != now:
                yield from groups.values()
                now, groups = (salt, key), {}
            was = groups.get(content)
            if was is None:
                groups[content] = (salt, key, content, keep_id, n, list(members))
            else:
                best = was[3] if keep_id is None or (was[3] is not None and was[3] >= keep_id) else keep_id
                was[5].extend(members)
                groups[content] = (salt, key, content, best, was[4] + n, was[5])
        yield from groups.values()

    salted = winners.select(
        F.pmod("part", F.lit(SALTS)).alias("salt"), "digest", "content", "keep_id", "n", F.array(F.struct("part", "local")).alias("members")
    )
    once = map_rows(salted.repartition("digest", "salt").sortWithinPartitions("digest", "salt"), combine, schema, 200)
    whole = once.withColumn("salt", F.lit(0)).repartition("digest").sortWithinPartitions("digest")
    whole = map_rows(whole.select(*once.columns), combine, schema, 200)
    # members: one for each task that holds the content
    groups = whole.select(F.explode("members").alias("m"), "keep_id", F.col("n").alias("group_size"))
    groups = groups.select("m.part", "m.local", "keep_id", "group_size")
    out = rows.select("doc_id", "digest", "part", "local").join(groups, ["part", "local"])
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")
