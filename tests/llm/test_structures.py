"""Whitening, conversation repair and sharding against brute force, and their edge cases."""

import hashlib
import random
import zlib
from collections import defaultdict
from decimal import Decimal

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
EMPTY = hashlib.sha256(b"").hexdigest()


def least(rows):
    """Least (cost, audit) over all edits, by a forward search that keeps the least pair of every state."""
    far, following = (10**9, "~"), {0: 2, 1: 2, 2: 3, 3: 2}
    keeps = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}

    def inserted(best):
        for _ in range(3):
            best = {t: min([best[t]] + [(best[s][0] + 5, best[s][1] + "I") for s in range(4) if following[s] == t]) for t in range(4)}
        return best

    best = {0: (0, ""), 1: far, 2: far, 3: far}
    for role, _, fault in rows:
        best, new, extra = inserted(best), dict.fromkeys(range(4), far), 5 * (fault == "truncated")
        for s, (cost, audit) in best.items():
            new[s] = min(new[s], (cost + 2, audit + "D"))
            if fault in ("blank", "duplicate"):
                continue
            if (role[:1], s) in keeps:
                t = keeps[role[:1], s]
                new[t] = min(new[t], (cost + extra, audit + "K"))
            t = following[s]
            new[t] = min(new[t], (cost + extra + 1, audit + "R"))
        best = new
    best = inserted(best)
    return min(best[0], best[3])


def expected(rows):
    """The report of one conversation, from its (turn, role, text) in order."""
    space, seen, found = " \t\n\x0b\x0c\r", set(), []
    for _, role, text in rows:
        bare = text.strip(space)
        found.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    cost, audit = least([(r, t, f) for (_, r, t), f in zip(rows, found)])
    lines, queue, state = [], iter(rows), 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(queue)[1:]
        if edit in "IR":
            role = "assistant" if state == 2 else "user"
        if edit != "D":
            state = 1 if role[0] == "s" else {0: 2, 1: 2, 2: 3, 3: 2}[state]
            lines.append(f"{role}:{text}")
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def ordered(rows):
    out = defaultdict(list)
    for conv, *row in rows:
        out[conv].append(tuple(row))
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0)) for c, r in out.items()}


NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def reported(report):
    return {r["conv_id"]: tuple(r[n] for n in NAMES) for r in report.collect()}


def test_repair_query(spark):
    from skyflow.llm.queries import op12_conversation_repair

    table = pq.read_table(f"{SF}/conversations.parquet").to_pylist()
    rows = []
    for r in table:
        kind = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        text = {1: "", 2: r["text"].translate(str.maketrans("", "", ".!?"))}.get(kind, r["text"])
        rows += [(r["conv_id"], r["turn"], "user" if kind == 4 else r["role"], text)] * {0: 0, 3: 2}.get(kind, 1)
    want = {c: expected(v) for c, v in ordered(rows).items()}
    got = reported(op12_conversation_repair(spark, SF))
    assert got == {r["conv_id"]: want.get(r["conv_id"], (0,) * 6 + ("", EMPTY)) for r in table}


@pytest.fixture(scope="module")
def talk():
    rnd, rows = random.Random(5), []
    texts = ["Yes.", "No", " ", "", "Why?\n", "a long answer. " * 9, "é!", "x\t"]
    for conv in [*range(60), None]:
        for turn in range(rnd.randrange(14)):
            rows.append((conv, rnd.choice([turn, turn, turn + 2, None]), rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]), rnd.choice(texts) + rnd.choice(["", "", str(turn) + "."])))
    # a conversation of a third of all rows, in turn order; its middle repeats one row
    hot = [(1000, k, "user" if k % 2 else "assistant", f"line {k}." if k < 200 or k > 300 else "again.") for k in range(400)]
    return rows + hot


@pytest.mark.parametrize("held", [4096, 3])
def test_repair_of_any_rows(spark, talk, held, monkeypatch):
    from skyflow.llm import conversations

    monkeypatch.setattr(conversations, "HELD_ROWS", held)
    rows = spark.createDataFrame([(*r, "x", 1) for r in talk], "conv_id long, turn long, role string, text string, part string, row int").coalesce(1)
    turns, report = conversations.repair(rows)
    want = {c: expected(v) for c, v in ordered(talk).items()}
    assert reported(report) == want
    lines = defaultdict(list)
    for t in turns.orderBy("conv_id", "part", "place").collect():
        lines[t["conv_id"]].append(t)
    for conv, found in want.items():
        assert "".join(t["edit"] for t in lines[conv]) == found[6]
        text = "\n".join(f"{t['role']}:{t['text']}" for t in lines[conv] if t["edit"] != "D")
        assert hashlib.sha256(text.encode()).hexdigest() == found[7]


def test_repair_of_few_rows(spark):
    from skyflow.llm import conversations

    schema = "conv_id long, turn long, role string, text string"
    turns, report = conversations.repair(spark.createDataFrame([], schema))
    assert turns.count() == 0 and report.count() == 0
    rows = [(1, None, None, None), (2, 5, "system", "Be kind."), (3, 1, "user", "Hm " * 200_000), (3, 1, "user", "Hm " * 200_000)]
    _, report = conversations.repair(spark.createDataFrame(rows, schema))
    assert reported(report) == {c: expected([(t, r or " ", x or " ") for _, t, r, x in rows if _ == c]) for c in (1, 2, 3)}


def test_ranks_order_audits():
    from skyflow.llm.conversations import ACCEPTED, Graph

    rnd = np.random.default_rng(2)
    lengths = rnd.integers(0, 9, 200)
    n = int(lengths.sum())
    graph = Graph(lengths, rnd.integers(0, 4, n), rnd.integers(0, 4, n), np.tile(ACCEPTED, (200, 1)), np.ones(200, bool))
    graph.point()
    starts = 4 * graph.first
    audits = graph.audits(starts)
    assert [audits[k] for k in np.argsort(graph.rank[starts], kind="stable")] == sorted(audits)


def test_damage_of_nulls(spark):
    from skyflow.llm.conversations import damage

    rows = [(c, t, None, None) for c in (None, 1, 2) for t in [None, *range(40)]]
    got = defaultdict(list)
    for r in damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect():
        got[r["conv_id"], r["turn"]].append((r["role"], r["text"]))
    for c, t, _, _ in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        assert got[c, t] == [("user" if kind == 4 else " ", "" if kind == 1 else " ")] * {0: 0, 3: 2}.get(kind, 1)


def whitened(rows):
    out = {}
    for r in rows:
        out.setdefault(r["vec_id"], {})[r["component"]] = r
    return out


def test_whitening_query(spark):
    from skyflow.llm.queries import op11_qd_whitening

    table = pq.read_table(f"{SF}/embeddings.parquet").to_pydict()
    x = np.floor(1024 * np.array(table["embedding"], float)).astype(int) + 100_000
    n, sums = len(x), x.sum(0)
    deviation = ((n * x - sums) ** 2).sum(1)
    centred = x - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1][:, :8]
    want = centred @ vectors / np.sqrt(values[:8])
    got = whitened(op11_qd_whitening(spark, SF).collect())
    z = np.array([[got[i][k]["whitened"] for k in range(1, 9)] for i in table["vec_id"]])
    assert np.abs(z * np.sign((z * want).sum(0)) - want).max() < 1e-9
    assert [got[i][1]["deviation"] for i in table["vec_id"]] == deviation.tolist()
    one = got[table["vec_id"][0]]
    assert all(abs(one[k]["explained"] / (values[k - 1] / values.sum()) - 1) < 1e-12 and one[k]["n"] == n for k in one)
    assert 0 <= one[1]["identity_error"] < 1e-10


def test_whitening_of_any_rows(spark):
    from skyflow.llm import whitening

    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.25]), (2, []), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]), (7, [2.0]), (8, [-1.5, 0.75])]
    frame = spark.createDataFrame([(*r, "s", 1) for r in data], "vec_id long, embedding array<float>, state string, x int")
    good = [(i, (v + [0.0, 0.0])[:2]) for i, v in data if v is not None and all(c is not None and abs(c) < inf for c in v)]
    x = np.floor(1024 * np.array([v for _, v in good])).astype(int) + 100_000
    n, sums = len(x), x.sum(0)
    centred = x - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    want = np.abs(centred @ vectors[:, ::-1] / np.sqrt(values[::-1]))
    got = whitening.whiten(whitening.whole_vectors(frame)).collect()
    assert len(got) == 2 * n and {r["component"] for r in got} == {1, 2}
    key = lambda r: (r[0] is None, r[0] or 0, *np.round(r[1:], 6))
    pairs = defaultdict(list)
    for r in got:
        pairs[r["vec_id"], r["deviation"], r["component"]].append(abs(r["whitened"]))
    first = sorted(((i, float(a), float(b)) for (i, _), (a, b) in zip(good, want)), key=key)
    found = sorted(((i, a, b) for (i, d, k), v in pairs.items() if k == 1 for a, b in zip(v, pairs[i, d, 2])), key=key)
    assert [r[0] for r in first] == [r[0] for r in found] and np.allclose([r[1:] for r in first], [r[1:] for r in found])
    assert {d for _, d, _ in pairs} == {Decimal(int(d)) for d in ((n * x - sums) ** 2).sum(1)}
    for rows in (frame.limit(0), frame.where("vec_id = 3")):
        assert whitening.whiten(whitening.whole_vectors(rows)).count() == 0
    flat = whitening.whiten(whitening.whole_vectors(frame.where("vec_id = 0"))).collect()
    assert len(flat) == 4 and all(r["whitened"] == r["explained"] == r["identity_error"] == r["deviation"] == 0 for r in flat)
    large = spark.createDataFrame([(1, [3e38, 1.0]), (2, [-3e38, 2.0])], "vec_id long, embedding array<float>")
    top = 1 << 52
    assert {int(r["deviation"]) for r in whitening.whiten(whitening.whole_vectors(large)).collect()} == {(2 * top) ** 2 + 1024**2}


def test_singular_values():
    from skyflow.llm.whitening import singular

    rnd = np.random.default_rng(4)
    same = np.linalg.qr(rnd.standard_normal((12, 12)))[0]
    shapes = [rnd.standard_normal((12, 12)), rnd.standard_normal((12, 12)) * np.logspace(0, -12, 12), same, np.diag([5.0, 5, 5, 3, 3, 1, 1, 1, 0, 0, 0, 0]),
              np.tile(rnd.standard_normal((12, 6)), 2), np.zeros((12, 12)), np.eye(1), np.triu(np.ones((3, 3)))]
    for a in shapes:
        k = min(8, len(a))
        squares, v = singular(a, k)
        true = np.linalg.svd(a, compute_uv=False)
        assert np.allclose(np.sqrt(squares), true, rtol=1e-12, atol=1e-14 * max(1, true[0]))
        assert np.abs(v.T @ v - np.eye(k)).max() < 1e-10
        assert np.abs(a.T @ (a @ v) - v * squares[:k]).max() <= 1e-12 * max(true[0] ** 2, 1)


def test_sharding_query(spark):
    from skyflow.llm.queries import op13_bounded_ring

    table = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    want = {i: (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in zip(table["doc_id"], table["text"])}
    slots, rows = defaultdict(list), op13_bounded_ring(spark, SF).collect()
    for r in rows:
        assert (r["size"], r["text_crc32"]) == want[r["doc_id"]] and r["law"] == "rows" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert len(rows) == len(want) == len({r["doc_id"] for r in rows})
    assert sorted(slots) == list(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def walked(positions, points, owner, shards):
    """Shards one row at a time: all rows of a round ask, in the order of the ring, the point so many steps ahead."""
    room = [len(positions) // shards + (s < len(positions) % shards) for s in range(shards)]
    home = [int(np.searchsorted(points, p)) % len(points) for p in positions]
    # rows of the first arc that lie behind the last point come after those in front of the first one
    order = sorted(range(len(positions)), key=lambda i: (home[i], home[i] == 0 and positions[i] > points[-1], positions[i]))
    found, step = {}, 0
    while order:
        rest = []
        for i in order:
            s = int(owner[(home[i] + step) % len(owner)])
            if room[s]:
                room[s], found[i] = room[s] - 1, s
            else:
                rest.append(i)
        order, step = rest, step + 1
    return [found[i] for i in range(len(positions))]


@pytest.mark.parametrize("virtual", [2, 40])
def test_sharding_follows_the_ring(spark, virtual):
    from skyflow.llm import sharding

    frame = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit(1).alias("rank"), F.lit(2).alias("arc"))
    position = {r[0]: r[1] for r in frame.select("doc_id", F.xxhash64(F.col("doc_id").cast("string"))).collect()}
    got = {r["doc_id"]: r["shard"] for r in sharding.sharded(frame, 7, virtual).collect()}
    ids = sorted(position)
    assert [got[i] for i in ids] == walked([position[i] for i in ids], *sharding.ring(7, virtual), 7)


def test_sharding_of_any_rows(spark):
    from skyflow.llm import sharding

    rows = [(None, None)] * 300 + [(5, "same")] * 200 + [(i, "x" * (i % 7)) for i in range(400)] + [(5, "other é"), (401, "long " * 100_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = sharding.sharded(frame, 24).collect()
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in out) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and {len(s) for s in slots.values()} <= {37, 38}
    assert sharding.sharded(frame.limit(0), 24).count() == 0
    assert sorted(r["shard"] for r in sharding.sharded(frame.limit(2), 24).collect()) == [0, 1]


def test_growth_moves_few_rows():
    from skyflow.llm import sharding

    rnd = np.random.default_rng(6)
    positions, found = np.sort(rnd.integers(-(1 << 63), (1 << 63) - 1, 20_000, dtype=np.int64)), []
    for shards in (24, 25):
        points, owner = sharding.ring(shards)
        arc = np.searchsorted(points, positions) % len(points)
        shard = np.full(len(arc), -1)
        rank = np.zeros(len(arc), int)
        for a in np.unique(arc):
            rank[arc == a] = np.arange((arc == a).sum())
        for a, low, high, s, _ in sharding.place(np.bincount(arc, minlength=len(points)), owner, shards):
            shard[(arc == a) & (rank >= low) & (rank < high)] = s
        found.append(shard)
    assert (found[0] != found[1]).mean() < 1.5 / 25
