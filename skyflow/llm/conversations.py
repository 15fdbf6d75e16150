"""Repair of the structure of conversations: cheapest edits that leave ``(s?(ua)+)?`` of role initials.

Rows and the four states of that pattern make a graph; its arcs are the edits Delete, Insert, Keep and Rerole. A cost DP
from the end leaves the optimal arcs. Their nodes are ranked by the audit letters ahead of them, for lengths one, two,
four and so on: a rank of twice the length is the pair of the rank here and the rank at the doubled pointer. No two arcs
of a node share a letter, so the least letter is a pointer; nodes of one rank share their audit, which is read off once,
over doubled pointers, for all conversations that have it.

Rows are range-partitioned by conversation and turn. A conversation inside one partition is solved there. One that
reaches into others, or is long, is solved by segments: a segment's costs between any two states are a 4 x 4 matrix,
matrices are chained to the cost behind each segment, and exits of segments to the state in front of it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyflow.llm.common import ASCII_SPACE, map_rows, prepare, written

# The costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLANK, DUPLICATE, CUT = 1, 2, 3
#: States: nothing yet, after the system's turn, after the user's, after the assistant's.
ACCEPTED = np.array([0, 1 << 50, 1 << 50, 0])
NEXT = np.array([2, 2, 3, 2])
#: State after keeping a row of initial s, u, a or another (-1: can't be kept).
KEEP = np.array([[1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1], [-1, -1, -1, -1]])
INITIALS = {"s": 0, "u": 1, "a": 2}
LEGAL = {"su", "ua", "au"}
LETTERS = "DIKR"
FAR = 1 << 40
#: A conversation with more rows or characters than this is solved by segments even inside one partition.
HELD_ROWS, HELD_CHARS = 4096, 8 << 20


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the damaged rows, by crc32 of ``conv_id:turn`` modulo 20; nulls are one space."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")), F.lit(20))
    out = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), text_of("role").alias("role"), text_of("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    out = out.where("kind != 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))
    return out.select("conv_id", "turn", "role", "text", F.explode("copies").alias("copy")).drop("copy")


def relaxed(cost: np.ndarray) -> np.ndarray:
    """Costs with inserts allowed in front; two in a row are enough to reach any state."""
    for _ in range(2):
        cost = np.minimum(cost, INSERT + cost[:, NEXT])
    return cost


class Graph:
    """Graphs of several segments, their costs to the end, optimal arcs, and audits.

    ``initial`` and ``fault`` hold the rows of all segments one after another, ``end`` the costs behind each segment by
    state; ``closing`` segments may insert rows behind their last one. Node 4 * p + s: state s in front of row p.
    """

    def __init__(self, lengths: np.ndarray, initial: np.ndarray, fault: np.ndarray, end: np.ndarray, closing: np.ndarray):
        self.lengths, n = lengths, len(lengths)
        self.first = np.cumsum(lengths + 1) - (lengths + 1)
        self.last = self.first + lengths
        size = int((lengths + 1).sum())
        self.row = np.ones(size, bool)
        self.row[self.last] = False
        self.initial, self.fault = np.full(size, 3), np.zeros(size, int)
        self.initial[self.row], self.fault[self.row] = initial, fault
        self.cost = np.zeros((size, 4), np.int64)
        self.cost[self.last] = np.where(closing[:, None], relaxed(end), end)
        self.closes = np.zeros(size, bool)
        self.closes[self.last] = closing
        order = np.argsort(-lengths, kind="stable")
        active = n - np.searchsorted(np.sort(lengths), np.arange(1, (lengths.max() if n else 0) + 1))
        for back, count in enumerate(active.tolist(), 1):
            at = self.last[order[:count]] - back
            self.cost[at] = relaxed(np.minimum.reduce([*self._row_arcs(at)]))

    def _row_arcs(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Costs of the nodes ``at`` by deleting, keeping and re-roling their row."""
        behind, keep = self.cost[at + 1], KEEP[self.initial[at]]
        stays = (np.where(self.fault[at] == CUT, TRUNCATED, 0) + np.where((self.fault[at] == BLANK) | (self.fault[at] == DUPLICATE), FAR, 0))[:, None]
        kept = np.where(keep >= 0, np.take_along_axis(behind, np.maximum(keep, 0), 1), FAR)
        return DELETE + behind, stays + kept, stays + REROLE + behind[:, NEXT]

    def point(self) -> None:
        """Pointers along the least optimal arcs, doubled until they reach the ends, and the ranks of the nodes."""
        size = len(self.cost)
        at = np.flatnonzero(self.row)
        delete, keep, rerole = self._row_arcs(at)
        letter = np.full((size, 4), -1)
        to = np.arange(4 * size).reshape(size, 4)
        node = 4 * at[:, None]
        options = [(3, rerole, 4 + node + NEXT), (2, keep, 4 + node + np.maximum(KEEP[self.initial[at]], 0)), (0, delete, 4 + node + np.arange(4))]
        for code, cost, target in options:  # the least letter is written last, Insert in between
            if code == 0:
                inserted = (self.row | self.closes)[:, None] & (self.cost == INSERT + self.cost[:, NEXT])
                letter[inserted], to[inserted] = 1, (4 * np.arange(size)[:, None] + NEXT)[inserted]
            optimal = cost == self.cost[at]
            letter[at] = np.where(optimal, code, letter[at])
            to[at] = np.where(optimal, target, to[at])
        self.letter, to = letter.ravel(), to.ravel()
        rank, steps, ends = self.letter + 1, (self.letter >= 0).astype(np.int64), self.letter < 0
        self.pointers = []
        while True:
            self.pointers.append(to)
            if ends[to].all():
                break
            rank = np.unique(rank * (rank.max() + 1) + rank[to], return_inverse=True)[1]
            steps, to = steps + steps[to], to[to]
        # once more, so that the rank covers the letter at the last pointer
        self.rank = np.unique(rank * (rank.max() + 1) + rank[to], return_inverse=True)[1]
        self.steps, self.end = steps, to

    def audits(self, starts: np.ndarray) -> list[str]:
        """The least audit from each of the nodes; those of one rank are read once."""
        _, one, which = np.unique(self.rank[starts], return_index=True, return_inverse=True)
        starts = starts[one]
        steps = self.steps[starts]
        cuts = np.cumsum(steps)
        step = np.arange(cuts[-1] if len(cuts) else 0) - np.repeat(cuts - steps, steps)
        at = np.repeat(starts, steps)
        for k, to in enumerate(self.pointers):
            at = np.where(step >> k & 1, to[at], at)
        text = np.frombuffer(LETTERS.encode(), np.uint8)[self.letter[at]].tobytes().decode()
        found = [text[b - n : b] for b, n in zip(cuts.tolist(), steps.tolist())]
        return [found[w] for w in which.tolist()]


def edited(audit: str, state: int, rows: Iterator[tuple]) -> Iterator[tuple[str, int | None, str, str]]:
    """Edit, turn, role and text along an audit; ``rows`` has turn, role and text of the rows it consumes."""
    for letter in audit:
        turn, role, text = (None, "", "") if letter == "I" else next(rows)
        if letter in "IR":
            role = "assistant" if state == 2 else "user"
        if letter != "D":
            state = 1 if role[:1] == "s" else int(NEXT[state])
        yield letter, turn, role, text


def counts(rows: list[tuple]) -> tuple[int, int, int, int, int]:
    """Gaps, blank, duplicate, truncated, illegal of a whole conversation; rows: turn, role, text, fault."""
    turns = {r[0] for r in rows if r[0] is not None}
    faults = [r[3] for r in rows]
    illegal = sum(a[1][:1] + b[1][:1] not in LEGAL for a, b in zip(rows, rows[1:]))
    return max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(k) for k in (BLANK, DUPLICATE, CUT)), illegal


def solved(conversations: list[tuple]) -> Iterator[tuple]:
    """Turns and report of whole conversations: (id, [(turn, role, text, fault), ...])."""
    lengths = np.array([len(rows) for _, rows in conversations], np.int64)
    initial = np.array([INITIALS.get(r[1][:1], 3) for _, rows in conversations for r in rows], int)
    fault = np.array([r[3] for _, rows in conversations for r in rows], int)
    graph = Graph(lengths, initial, fault, np.tile(ACCEPTED, (len(lengths), 1)), np.ones(len(lengths), bool))
    graph.point()
    for (conv, rows), audit, cost in zip(conversations, graph.audits(4 * graph.first), graph.cost[graph.first, 0].tolist()):
        digest, joint = hashlib.sha256(), b""
        for place, (edit, turn, role, text) in enumerate(edited(audit, 0, (r[:3] for r in rows))):
            if edit != "D":
                digest.update(joint + f"{role}:{text}".encode())
                joint = b"\n"
            yield conv, 0, place, turn, role, text, None, edit, *[None] * 8
        yield conv, *[None] * 7, *counts(rows), cost, audit, digest.hexdigest()


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def marked(rows: DataFrame) -> DataFrame:
    """Rows with their first fault: blank, duplicate (role and text seen earlier in the conversation) or truncated."""
    text = F.col("text")
    blank = F.translate(text, ASCII_SPACE, "") == ""
    cut = ~F.substring(F.rtrim(text, F.lit(ASCII_SPACE)), -1, 1).isin(".", "!", "?")
    conv = F.coalesce(F.concat(F.lit(":"), F.col("conv_id").cast("string")), F.lit(""))
    key = F.unhex(F.sha2(F.concat_ws("\n", conv, F.length("role").cast("string"), "role", "text"), 256))
    out = rows.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("row"), blank.alias("blank"), cut.alias("cut"), key.alias("key"))
    out = written(out, "conversation-rows")
    again = out.where(~F.col("blank")).groupBy("key").agg(F.min(F.struct("turn", "row")).alias("at"), F.count("*").alias("n"))
    again = again.where("n > 1").select("key", F.col("at.row").alias("earliest"))
    out = out.join(again, "key", "left")
    fault = F.when(F.col("blank"), BLANK).when(F.col("row") != F.col("earliest"), DUPLICATE).when(F.col("cut"), CUT).otherwise(0)
    return out.select("conv_id", "turn", "row", "role", "text", fault.cast("int").alias("fault"))


def solve_inside(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Conversations that lie inside a partition, solved; rows of the others, which its first and last one may be."""
    from pyspark import TaskContext

    part, conv, whole, at = TaskContext.get().partitionId(), None, False, 0
    held: list[tuple] = []
    held_chars, batch, batch_rows = 0, [], 0

    def let_go(items: list[tuple], start: int) -> Iterator[tuple]:
        return ((conv, part, start + k, turn, role, text, fault, *[None] * 9) for k, (turn, role, text, fault) in enumerate(items))

    for n, (row_conv, *row) in enumerate(rows):
        if n == 0 or row_conv != conv:
            if whole:
                batch.append((conv, held))
                batch_rows += len(held)
                if batch_rows >= HELD_ROWS or held_chars > HELD_CHARS:
                    yield from solved(batch)
                    batch, batch_rows, held_chars = [], 0, 0
            conv, whole, at, held = row_conv, n > 0, 0, []
        held.append(tuple(row))
        held_chars += len(row[2])
        if not whole or len(held) > HELD_ROWS or held_chars > 2 * HELD_CHARS:
            if whole and batch:
                yield from solved(batch)
                batch, batch_rows = [], 0
            yield from let_go(held, at)
            whole, at, held, held_chars = False, at + len(held), [], 0
    yield from let_go(held, at)
    if batch:
        yield from solved(batch)


def segment_costs(rows: pd.DataFrame) -> pd.DataFrame:
    """One row for a segment: its costs between states, what its neighbours need, and its counts."""
    rows = rows.sort_values("nth")
    initial, fault = rows["initial"].map(lambda c: INITIALS.get(c, 3)).to_numpy(int), rows["fault"].to_numpy(int)
    n = len(rows)
    end = np.where(np.eye(4, dtype=bool), 0, FAR)
    graph = Graph(np.full(4, n), np.tile(initial, 4), np.tile(fault, 4), end, np.zeros(4, bool))
    turns = rows["turn"].dropna().astype("int64")
    letters = rows["initial"].tolist()
    out = {
        "conv_id": [rows["conv_id"].iloc[0]], "part": [rows["part"].iloc[0]], "matrix": [graph.cost[graph.first].T.ravel().tolist()],
        "low": [int(turns.min()) if len(turns) else None], "high": [int(turns.max()) if len(turns) else None], "turns": [turns.nunique()],
        "head": [letters[0]], "tail": [letters[-1]], "illegal": [sum(a + b not in LEGAL for a, b in zip(letters, letters[1:]))],
        **{name: [int((fault == k).sum())] for name, k in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", CUT))},
    }
    return pd.DataFrame(out).astype({"conv_id": rows["conv_id"].dtype, "low": "Int64", "high": "Int64"})


def chain(rows: pd.DataFrame) -> pd.DataFrame:
    """Segments of one conversation (one a partition at most): the costs behind each; the first carries the counts."""
    rows = rows.sort_values("part").reset_index(drop=True)
    behind, cost = [], relaxed(ACCEPTED[None])[0]
    for matrix in rows["matrix"][::-1]:
        behind.append(cost.tolist())
        cost = (np.asarray(matrix).reshape(4, 4) + cost).min(1)
    behind.reverse()
    behind[-1] = ACCEPTED.tolist()
    low, high = rows["low"].astype("Int64"), rows["high"].astype("Int64")
    known = low.notna()
    turns = int(rows["turns"].sum()) - int((low[known].to_numpy()[1:] == high[known].to_numpy()[:-1]).sum())
    illegal = int(rows["illegal"].sum()) + sum(a + b not in LEGAL for a, b in zip(rows["tail"], rows["head"][1:]))
    total = [int(high.max()) - int(low.min()) + 1 - turns if known.any() else 0, *(int(rows[c].sum()) for c in ("blank", "duplicate", "truncated")), illegal, int(cost[0])]
    out = rows[["conv_id", "part"]].copy()
    out["behind"], out["closing"] = behind, [False] * (len(rows) - 1) + [True]
    for name, value in zip(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), total):
        out[name] = pd.array([value] + [None] * (len(rows) - 1), "Int64")
    return out


def segment_audits(rows: pd.DataFrame, behind: pd.DataFrame) -> pd.DataFrame:
    """Audits of a segment and the states it ends in, by the state in front of it."""
    rows = rows.sort_values("nth")
    initial, fault = rows["initial"].map(lambda c: INITIALS.get(c, 3)).to_numpy(int), rows["fault"].to_numpy(int)
    one = behind.iloc[0]
    graph = Graph(np.array([len(rows)]), initial, fault, np.asarray(one["behind"], np.int64)[None], np.array([one["closing"]]))
    graph.point()
    out = behind.iloc[:1][["conv_id", "part"]].copy()
    out["audits"], out["exits"] = [graph.audits(np.arange(4))], [(graph.end[:4] % 4).tolist()]
    return out


def entries(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("part")
    state, found = 0, []
    for exits in rows["exits"]:
        found.append(state)
        state = int(exits[state])
    return rows[["conv_id", "part"]].assign(entry=np.array(found, "int32"))


def solve_segments(rows: DataFrame, id_type: str) -> tuple[DataFrame, DataFrame]:
    """Turns and report of conversations that are given as segments of one partition each."""
    key, both = f"conv_id {id_type}, part int", ["conv_id", "part"]
    narrow = rows.select("conv_id", "part", "nth", "turn", F.substring("role", 1, 1).alias("initial"), "fault")
    schema = f"{key}, matrix array<long>, low long, high long, turns long, head string, tail string, illegal long, blank long, duplicate long, truncated long"
    costs = narrow.groupBy(*both).applyInPandas(segment_costs, schema)
    total = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    behind = written(costs.groupBy("conv_id").applyInPandas(chain, f"{key}, behind array<long>, closing boolean, {total}"), "segments")
    audits = narrow.groupBy(*both).cogroup(behind.select(*both, "behind", "closing").groupBy(*both))
    audits = written(audits.applyInPandas(segment_audits, f"{key}, audits array<string>, exits array<int>"), "segment-audits")
    entry = audits.select(*both, "exits").groupBy("conv_id").applyInPandas(entries, f"{key}, entry int")
    entry = entry.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), "entry")
    audits = audits.join(entry, audits["conv_id"].eqNullSafe(entry["c"]) & (audits["part"] == entry["p"]))
    audits = audits.select(*both, F.lit(-1).cast("long").alias("nth"), F.col("entry").cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.expr("audits[entry]").alias("text"))
    lines = rows.select(*both, "nth", "turn", "role", "text").union(audits)

    def follow(items: Iterator[tuple]) -> Iterator[tuple]:
        """A segment's audit comes first, then the rows that it consumes."""
        item = next(items, None)
        while item is not None:
            conv, part, _, state, _, audit = item
            own = ((turn, role, text) for _, _, _, turn, role, text in items)
            for place, (edit, turn, role, text) in enumerate(edited(audit, state, own)):
                yield conv, part, place, turn, role, text, edit
            item = next(items, None)

    lines = lines.repartition(*both).sortWithinPartitions(*both, "nth")
    turns = written(map_rows(lines, follow, f"{key}, place long, turn long, role string, text string, edit string"), "segment-turns")

    def digests(items: Iterator[tuple]) -> Iterator[tuple]:
        """Audit and SHA-256 of the repaired lines, which pass in order; no more than the audit is held."""
        last, digest, audit, joint = None, None, [], b""
        for conv, edit, role, text in items:
            if digest is None or conv != last:
                if digest is not None:
                    yield last, "".join(audit), digest.hexdigest()
                last, digest, audit, joint = conv, hashlib.sha256(), [], b""
            audit.append(edit)
            if edit != "D":
                digest.update(joint + f"{role}:{text}".encode())
                joint = b"\n"
        if digest is not None:
            yield last, "".join(audit), digest.hexdigest()

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place").select("conv_id", "edit", "role", "text")
    ends = map_rows(ordered, digests, f"c {id_type}, audit string, repaired_sha256 string")
    report = behind.where("cost is not null").join(ends, behind["conv_id"].eqNullSafe(ends["c"]))
    return turns, report.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and report of repaired conversations; ``rows`` has conv_id, turn, role and text.

    Turns: conv_id, part and place (their order in a conversation), turn (null for an inserted one), edit (D, I, K or R),
    role and text; those with D are not part of the repaired conversation. Report: one row for each conversation with gaps,
    blank, duplicate, truncated, illegal, cost, audit and the SHA-256 of the repaired ``role:text`` lines.

    Rows of a conversation are taken by turn, nulls first; equal turns in the table's order. Null roles and texts are one
    space, null ids one conversation. Rows that repeat are duplicates. A role that starts with neither s, u nor a can't be
    kept. No rows give no conversation. Other columns are not looked at.
    """
    prepare(rows.sparkSession)
    id_type = rows.schema["conv_id"].dataType.simpleString()
    space: Column = F.lit(" ")
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    order = ["conv_id", "turn", "row"]
    ordered = marked(rows).repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "fault")
    schema = f"conv_id {id_type}, part int, nth long, turn long, role string, text string, fault int, edit string, {REPORT}"
    found = written(map_rows(ordered, solve_inside, schema), "conversations")
    turns, report = solve_segments(found.where("fault is not null"), id_type)
    inside = found.where("edit is not null").select("conv_id", "part", F.col("nth").alias("place"), "turn", "role", "text", "edit")
    return inside.union(turns), found.where("cost is not null").select(*report.columns).union(report)
