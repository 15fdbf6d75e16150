"""The registered queries against brute force over the whole small tables."""

import hashlib
import os
import zlib
from collections import defaultdict

import public_tokenizers
import pyarrow.parquet as pq
import pytest

SF = os.environ.get("LLM_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def docs():
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


@pytest.fixture(scope="module")
def rows(spark):
    from skyflow.llm.queries import catalog

    queries = catalog()
    return lambda name: [r.asDict() for r in next(f for k, (f, _) in queries.items() if k.startswith(name))(spark, SF).collect()]


@pytest.fixture(scope="module")
def word_ids(docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = t.encode_batch([d["text"] or "" for d in docs], add_special_tokens=False)
    return {d["doc_id"]: e.ids for d, e in zip(docs, got)}


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def test_packing(rows, word_ids):
    got, total = defaultdict(dict), 0
    sequences = defaultdict(list)
    for r in rows("op1_"):
        got[r["doc_id"]][r["piece"]] = r
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc_id, ids in word_ids.items():
        ids, total = [*ids, 0], total + len(ids) + 1
        for k in range(-(-len(ids) // 2048)):
            part, r = ids[k * 2048 : (k + 1) * 2048], got[doc_id][k]
            assert (r["start"], r["length"], r["ids_crc32"]) == (k * 2048, len(part), crc(part))
        assert len(got[doc_id]) == k + 1
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(sequences) <= 1.01 * -(-total // 2048) + 1


def line_brute(docs):
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for d in docs:
        for x in (d["text"] or "").split("\n"):
            holders[key(x)].add(d["doc_id"])
    for d in docs:
        lines = (d["text"] or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or min(holders[key(x)]) == d["doc_id"]]
        yield d["doc_id"], len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()


def test_line_dedup(rows, docs):
    assert {tuple(r[c] for c in ("doc_id", "n_lines", "n_dropped", "kept_sha256")) for r in rows("op2_")} == set(line_brute(docs))


def test_quality_on_held_out(rows, docs):
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    got = rows("op3_")
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    judged = [(r["score"], labels[r["doc_id"]]) for r in got if r["held_out"] and labels.get(r["doc_id"]) in (0, 1)]
    pairs = [(a > b) + (a == b) / 2 for a, x in judged for b, y in judged if x == 1 and y == 0]
    assert not pairs or sum(pairs) / len(pairs) > 0.9
    assert sum((s >= 0.5) == y for s, y in judged) >= 0.85 * len(judged)


def test_top_k(rows):
    from math import floor

    v = {r["vec_id"]: [floor(1024 * x) for x in r["embedding"]] for r in pq.read_table(f"{SF}/embeddings.parquet").to_pylist()}
    want = set()
    for q in v:
        if q % 100 == 0:
            best = sorted((-sum(a * b for a, b in zip(v[q], x)), i) for i, x in v.items() if i != q)[:10]
            want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows("op4_")} == want


def test_byte_bpe(rows, docs):
    import tiktoken

    from skyflow.llm.byte_bpe import read_ranks

    t = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    sha = lambda data: hashlib.sha256(data).hexdigest()
    want = set()
    for d in docs:
        ids = t.encode_ordinary(d["text"] or "")
        want.add((d["doc_id"], len(ids), sha(" ".join(map(str, ids)).encode()), sha((d["text"] or "").encode())))
    assert {tuple(r[c] for c in ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")) for r in rows("op5_")} == want


def test_token_file(rows, word_ids):
    start, want = 0, set()
    for doc_id in sorted(word_ids):
        ids = [*word_ids[doc_id], 2]
        want.add((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert {tuple(r[c] for c in ("doc_id", "start", "n_tokens", "ids_crc32")) for r in rows("op6_")} == want


def test_section_counts(rows, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    got = defaultdict(list)
    for r in sorted(rows("op7_"), key=lambda r: (r["doc_id"], r["section"])):
        got[r["doc_id"]].append((r["n_chars"], r["n_tokens"]))
    for d in docs:
        text = d["text"] or ""
        line_of = [k for k, x in enumerate(text.split("\n")) for _ in range(len(x) + 1)]
        counts = [0] * (text.count("\n") + 1)
        for a, b in t.encode(text, add_special_tokens=False).offsets:
            lines = [line_of[i] for i in range(a, b) for _ in text[i].encode()]
            counts[min(set(lines), key=lambda k: (-lines.count(k), k))] += 1
        assert [n for _, n in got[d["doc_id"]]] == counts
        assert sum(n for n, _ in got[d["doc_id"]]) == len(text)


def simhash_brute(text):
    import re

    from xxhash import xxh64_intdigest

    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    if not words:
        return 0
    h = [xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def reachable(prints, radius):
    """Smallest id reachable over links, all pairs compared."""
    values = sorted(set(prints.values()))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= radius:
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for d, v in prints.items():
        least[find(v)] = min(d, least.get(find(v), d))
    return {d: least[find(v)] for d, v in prints.items()}


def test_simhash(rows, docs):
    prints = {d["doc_id"]: simhash_brute(d["text"]) for d in docs}
    roots = reachable(prints, 3)
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows("op8_")}
    assert got == {(d, f"{v:016x}", roots[d]) for d, v in prints.items()}


def test_exact_dedup(rows, docs):
    groups = defaultdict(list)
    for d in docs:
        groups[(d["text"] or "").encode().lower()].append(d["doc_id"])
    want = {(i, max(ids), len(ids), i == max(ids), hashlib.sha256(t).hexdigest()) for t, ids in groups.items() for i in ids}
    assert {tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in rows("op9_")} == want


def test_language_on_held_out(rows, docs):
    lang = {d["doc_id"]: d["lang"] for d in docs}
    got = rows("op10_")
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    judged = [r["lang_pred"] == lang[r["doc_id"]] for r in got if r["held_out"] and r["lang_pred"] != "und"]
    assert sum(judged) >= 0.95 * len(judged)
