"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, by operator."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, length long, offset long, score double, "
          "fingerprint string, n_lines long, _rank int, key string")
LONG = "wordy " * 30_000
TEXTS = [(1, None), (2, ""), (3, "The same line of text\nand one more"), (4, "  THE SAME LINE OF TEXT\t\nother words here"), (4, "  THE SAME LINE OF TEXT\t\nother words here"),
         (5, LONG), (None, "a text without an id"), (None, None), (6, "\n\n\n"), (7, "..."), (8, "x" * 20_000), (9, "Ünïcödé \U0001f600 日本"), (10, "aB"), (11, "Ab")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, None if i in (2, 3) else "en", "s", None, 1, 2, 0.5, "f", 3, 4, "k") for i, t in TEXTS], SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(3, 1, 0), (4, 0, 0), (5, 1, 0), (None, 1, 0), (7, None, 0), (9, 5, 0)], "doc_id long, quality int, toxic int")


def test_packing(docs, none):
    from skyflow.llm import packing

    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack(packing.token_pieces(docs, path)).collect()
    assert {r["doc_id"] for r in rows} == {i for i, _ in TEXTS}
    assert sum(r["piece"] == 0 for r in rows) == len(TEXTS)
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in rows)
    assert all(o == (places[k - 1][1] + places[k - 1][2] if k and places[k - 1][0] == s else 0) for k, (s, o, _) in enumerate(places))
    assert packing.pack(packing.token_pieces(none, path)).count() == 0
    for shape in ({}, {2048: 5}, {1: 5000}, {1025: 3, 1: 1}, {700: 10, 648: 7, 3: 2}):
        runs = packing.plan(shape, 2048)
        assert sum(int(b - a) for _, a, b, _, _ in runs) == sum(shape.values())


def test_line_dedup(docs, none):
    from skyflow.llm.line_dedup import dedup_lines

    out = dedup_lines(docs)
    rows = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in out.collect()]
    assert len(rows) == len(TEXTS) and set(out.columns) == set(docs.columns) | {"n_dropped"}
    assert rows.count((4, 2, 1, "other words here")) == 2 and (3, 2, 0, TEXTS[2][1]) in rows
    assert (1, 1, 0, "") in rows and (None, 1, 0, "") in rows and (6, 4, 0, "\n\n\n") in rows
    assert dedup_lines(none).count() == 0


def test_quality(docs, none, labels):
    from skyflow.llm.quality import classify

    rows = classify(docs, labels).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    assert classify(none, labels).count() == 0
    assert all(0 <= r["score"] <= 1 for r in classify(docs, labels.limit(0)).collect())


def test_top_k(spark):
    from skyflow.llm import knn_join

    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (100, [0.5, 0.5]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]), (7, [2.0])]
    v = knn_join.whole_vectors(spark.createDataFrame([(*r, 1) for r in data], "vec_id long, embedding array<float>, score int"))
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in knn_join.top_k(v, F.col("vec_id") % 100 == 0, 3).collect()}
    assert got[0, 1] == (7, 2 << 20) and got[0, 2] == (1, 1 << 20) and got[0, 3] == (2, 1 << 20)
    assert got[100, 1] == (7, 1 << 20) and got[100, 2] == got[100, 3] == (0, 1 << 19)
    assert knn_join.top_k(v.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert knn_join.top_k(v.where("vec_id = 100"), F.col("vec_id") % 100 == 0).count() == 0


def test_top_k_with_an_id_repeated_more_than_k_times(spark):
    import random

    from skyflow.llm import knn_join

    frame = lambda data: spark.createDataFrame(data, "vec_id long, v array<long>")
    rows = [(100, [10, 0])] * 3 + [(1, [0, 5])]
    assert [tuple(r) for r in knn_join.top_k(frame(rows), F.col("vec_id") == 100, 1).collect()] == [(100, 1, 1, 0)]
    rng = random.Random(5)
    point = lambda: [rng.randrange(-50, 50) for _ in range(3)]
    near = [[500 + rng.randrange(-30, 30), rng.randrange(30), rng.randrange(30)] for _ in range(40)]
    rows = [(i, point()) for i in range(1, 60)] + [(100, v) for v in near]  # one id over several cells
    own = min(near)
    want = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in rows if i != 100)[:4]
    got = knn_join.top_k(frame(rows), F.col("vec_id") == 100, 4).orderBy("rank").collect()
    assert [(-r["score"], r["vec_id"]) for r in got] == want


def test_byte_bpe(docs, none):
    from skyflow.llm import byte_bpe

    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    rows = byte_bpe.encode_texts(docs, ranks, pattern).collect()
    assert sorted(bytes(r["decoded"]) for r in rows) == sorted((t or "").encode() for _, t in TEXTS)
    assert byte_bpe.encode_texts(none, ranks, pattern).count() == 0


def test_byte_bpe_edits():
    import random

    import tiktoken

    from skyflow.llm.byte_bpe import ByteBpe, DecimalCoder, EditedPart, read_ranks

    bpe = ByteBpe(read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    lib = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    rng, coder = random.Random(1), DecimalCoder(bpe)
    for _ in range(300):
        text = "".join(rng.choice(["a", "the", " ", "  ", "\n", "1", "é", "'s", "日", "!", "\t", "\x1c", "Z", "ing"]) for _ in range(rng.randrange(40)))
        assert coder.texts.encode(text) == " ".join(map(str, lib.encode_ordinary(text)))
    for _ in range(60):
        part = EditedPart(bpe, bytes(rng.choices(b"ationheringsz", k=rng.randrange(400))))
        part.append(bytes(rng.choices(b"ation", k=rng.randrange(9))))
        start = rng.randrange(len(part.data) + 1)
        part.replace(start, min(len(part.data), start + rng.randrange(6)), bytes(rng.choices(b"ering", k=rng.randrange(6))))
        assert part.ids() == EditedPart(bpe, part.data).ids() and b"".join(bpe.tokens[i] for i in part.ids()) == part.data


def test_token_file(spark, docs, none, tmp_path):
    import numpy as np

    from skyflow.llm import token_file

    path = public_tokenizers.path("word_bpe_49k.json")
    rows = token_file.digests(token_file.encode_corpus(docs, path, str(tmp_path / "a"))).collect()
    rows.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == sorted((i for i, _ in TEXTS), key=lambda i: (i is not None, i or 0))
    assert all(b["start"] == a["start"] + a["n_tokens"] for a, b in zip(rows, rows[1:])) and rows[0]["start"] == 0
    assert token_file.digests(token_file.encode_corpus(none, path, str(tmp_path / "b"))).count() == 0
    counts = np.array([1 << min(k, 40) for k in range(60)])
    lengths = token_file.code_lengths(counts, 12)
    assert lengths.max() <= 12 and sum(2.0 ** -int(x) for x in lengths) == 1
    ids = np.random.default_rng(0).integers(0, 60, 1000)
    payload, lanes = token_file.encode_block(ids, token_file.canonical(lengths), lengths)
    assert (token_file.decode_block(payload, lanes, 1000, token_file.decode_table(lengths, 12), 12) == ids).all()


def test_section_counts(docs, none):
    from skyflow.llm.token_counts import line_token_counts

    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    rows = line_token_counts(docs, ranks, pattern).collect()
    assert len(rows) == sum((t or "").count("\n") + 1 for _, t in TEXTS)
    assert {(r["section"], r["n_tokens"]) for r in rows if r["doc_id"] in (1, 2)} == {(0, 0)}
    assert line_token_counts(none, ranks, pattern).count() == 0


def test_simhash(docs, none):
    from skyflow.llm.simhash import near_duplicates

    rows = near_duplicates(docs).collect()
    assert len(rows) == len(TEXTS)
    assert {r["component_id"] for r in rows if r["fingerprint"] == 0} == {1}
    assert near_duplicates(none).count() == 0


def test_large_shards_and_trees(spark, monkeypatch):
    import random

    from skyflow.llm import simhash
    from skyflow.llm.components import components

    from test_queries import reachable

    monkeypatch.setattr(simhash, "SEARCHED", 16)
    rng = random.Random(2)
    base = [rng.getrandbits(63) for _ in range(30)]
    values = {b ^ sum(1 << rng.randrange(63) for _ in range(rng.randrange(5))) for b in base for _ in range(8)}
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    for radius in (1, 3, 6):
        got = {r["node"]: r["root"] for r in components(simhash.linked(frame, radius)).collect()}
        want = reachable({v: v for v in values}, radius)
        assert {v: got.get(v, v) for v in values} == want
        links = {(r["a"], r["b"]) for r in simhash.linked(frame, radius, shortest=True).collect()}
        assert all(a < b and (a ^ b).bit_count() <= radius for a, b in links)
        got = {r["node"]: r["root"] for r in components(spark.createDataFrame(list(links), "a long, b long")).collect()}
        assert {v: got.get(v, v) for v in values} == want


def test_shortest_links_of_one_tree():
    import itertools
    import random

    import numpy as np

    from skyflow.llm.simhash import ShortestLinks

    rng = random.Random(4)
    value = np.array(sorted({rng.getrandbits(10) for _ in range(60)}), np.uint64)
    distance = lambda a, b: (int(value[a]) ^ int(value[b])).bit_count()
    pairs = list(itertools.combinations(range(len(value)), 2))
    root = list(range(len(value)))
    want = []
    for a, b in sorted(pairs, key=lambda p: (distance(*p), p)):
        if root[a] != root[b]:
            want.append((a, b))
            root = [root[a] if r == root[b] else r for r in root]
    links = ShortestLinks(value, block=100)
    rng.shuffle(pairs)
    for lo in range(0, len(pairs), 50):
        a, b = np.array(pairs[lo : lo + 50]).T
        links.add(b, a)
    assert sorted(zip(*(x.tolist() for x in links.forest()))) == sorted(want)


def test_near_copies(spark, docs, none):
    import random

    from skyflow.llm.simhash import fingerprint, near_copies, near_duplicates, shingles

    rng = random.Random(7)
    texts = []
    for _ in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(300)]
        copy = list(words)
        for _ in range(rng.choice((1, 3, 5, 12))):
            copy[rng.randrange(300)] = "changed"
        texts += [" ".join(words), " ".join(copy)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_copies(frame).collect()}
    narrow = {r["doc_id"]: r["component_id"] for r in near_duplicates(frame).collect()}
    joined = 0
    for k in range(0, len(texts), 2):
        bits = (fingerprint(texts[k]) ^ fingerprint(texts[k + 1])).bit_count()
        x, y = shingles(texts[k], 5), shingles(texts[k + 1], 5)
        close = bits <= 3 or bits <= 7 and len(x & y) >= 0.8 * len(x | y)
        assert got[k] == k and got[k + 1] == (k if close else k + 1)
        joined += got[k + 1] != narrow[k + 1]
    assert joined > 5  # of those beyond three bits
    rows = near_copies(docs).collect()
    assert len(rows) == len(TEXTS) and {r["component_id"] for r in rows if r["fingerprint"] == 0} == {1}
    assert near_copies(none).count() == 0


def test_near_copies_behind_refused_links(spark):
    import itertools
    import random

    from skyflow.llm.simhash import fingerprint, near_copies, shingles

    rng = random.Random(3)
    texts = []
    for _ in range(10):
        base = [f"w{rng.randrange(5000)}" for _ in range(200)]
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randrange(1, 7)):
                copy[rng.randrange(200)] = f"w{rng.randrange(5000)}"
            texts.append(" ".join(copy))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    root, refused = list(range(len(texts))), 0
    for i, k in itertools.combinations(range(len(texts)), 2):
        x, y = shingles(texts[i], 5), shingles(texts[k], 5)
        if (fingerprint(texts[i]) ^ fingerprint(texts[k])).bit_count() <= 12:
            if len(x & y) >= 0.8 * len(x | y):
                low, high = sorted((root[i], root[k]))
                root = [low if r == high else r for r in root]
            else:
                refused += 1
    assert refused > 100
    got = {r["doc_id"]: r["component_id"] for r in near_copies(frame, radius=0, reach=12).collect()}
    assert got == dict(enumerate(root))


def test_forests_take_all_links_in_the_end():
    import itertools

    import numpy as np

    from skyflow.llm.simhash import ShortestLinks

    pairs = np.array(list(itertools.combinations(range(8), 2)))
    for forests, block in ((1, 1000), (2, 1000), (4, 1000), (4, 1)):
        links = ShortestLinks(np.arange(8, dtype=np.uint64), block, forests)
        for _ in range(2):  # a link found from both of its ends counts once
            links.add(*pairs.T)
        a, b = links.forest()
        assert len(a) == len(set(zip(a.tolist(), b.tolist()))) <= 7 * forests
        assert links.more.any() == (len(a) < len(pairs)) and set(links.label) == {0}


def test_exact_dedup(docs, none):
    from skyflow.llm.exact_dedup import dedup

    for digest in (None, lambda data: hashlib.md5(data).digest()[:0], lambda data: data[:1]):  # collisions
        got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in dedup(docs, digest).collect()}
        assert {(1, 2, 3, False), (2, 2, 3, True), (None, 2, 3, False), (4, 4, 2, True), (10, 11, 2, False), (11, 11, 2, True), (None, None, 1, True)} <= got
    assert dedup(none).count() == 0


def test_language(docs, none):
    from skyflow.llm.lang_id import identify

    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = identify(docs, path).collect()
    assert len(rows) == len(TEXTS)
    assert all((r["lang_pred"], r["score"]) == ("und", 0.0) for r in rows if r["doc_id"] in (1, 2, 6, 7))
    assert all(r["lang_pred"] == "en" for r in rows if r["doc_id"] in (5, 8, 9))
    assert identify(none, path).count() == 0
    assert {r["lang_pred"] for r in identify(docs, path, none).collect()} == {"und"}


def test_pipeline_stages(spark, docs, none, labels, tmp_path):
    import corpus_pipeline

    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES:
        for rows in (docs, none):
            out = stage(spark, rows, str(tmp_path))
            out.count()
            if stage is not corpus_pipeline.pack:
                assert out.columns == docs.columns
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path))
    assert sorted(r["doc_id"] for r in kept.where("doc_id in (1, 2, 4)").collect()) == [1, 4]


def test_languages_not_learned_are_dropped(spark, tmp_path):
    import corpus_pipeline
    from test_queries import SF

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    more = [(-1, "Обычный русский текст, которого модель никогда не видела. " * 5, None), (-2, "xkq zvbt wqpfh gjklm bnvcx qwrtp " * 20, None)]
    rows = docs.withColumn("lang", F.when(F.col("lang") == "en", F.col("lang"))).unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string"))
    kept = {r["doc_id"] for r in corpus_pipeline.keep_language(spark, rows, str(tmp_path)).collect()}
    every = [(r["doc_id"], r["lang"]) for r in docs.where("text rlike '[a-z]'").collect()]
    english, others = ([i for i, lang in every if (lang == "en") == own] for own in (True, False))
    assert len(others) > 10 and not kept & {-1, -2}
    assert sum(i in kept for i in others) <= 0.03 * len(others) and sum(i in kept for i in english) >= 0.97 * len(english)


def test_near_duplicates_of_repeated_ids(spark, tmp_path):
    import random

    import corpus_pipeline

    rng = random.Random(11)
    a, b, c, d, e = (" ".join(f"w{rng.randrange(5000)}" for _ in range(300)) for _ in range(5))
    near = lambda text: text + " end"
    rows = [(1, a), (2, near(a)), (2, b), (3, c), (3, near(c)), (None, d), (None, a.upper()), (None, e), (4, e.upper())]
    kept = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path))
    got = [(r["doc_id"], r["text"].lower().removesuffix(" end")) for r in kept.collect()]
    assert sorted(got, key=str) == sorted([(1, a), (2, b), (3, c), (None, d), (4, e)], key=str)
