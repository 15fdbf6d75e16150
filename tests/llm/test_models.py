"""The learned stages against slow sums of the same models, and the pipeline against its stages by brute force."""

import math
import re
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


def crc(i, m):
    return zlib.crc32(str(i).encode()) % m


def quality_model(spark):
    from skyflow.llm import quality

    labels = spark.read.parquet(f"{SF}/labels.parquet").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    return quality.fit(spark.read.parquet(f"{SF}/documents.parquet"), labels)


def slow_quality(model, text, known={}):
    """Mean over words of the mean over their hash places, place by place."""
    from skyflow.llm.quality import BUCKETS

    total, words = 0.0, (text or "").split()
    for w in words:
        if (id(model), w) not in known:
            b = b"<" + w.encode() + b">"
            places = [zlib.crc32(b) % BUCKETS]
            for n in (3, 4):
                for k in range(len(b) - n + 1):
                    places.append((int.from_bytes(b[k : k + n], "little") * (0x9E3779B97F4A7C15 + 2 * n) % 2**64 >> 40) % BUCKETS)
            known[id(model), w] = sum(float(model.place_score[p]) for p in places) / len(places)
        total += known[id(model), w]
    return 1 / (1 + math.exp(-(model.bias + (total / len(words) if words else 0))))


def test_quality_scores_are_sums_over_places(spark, docs):
    from skyflow.llm.queries import op3_quality_classifier

    model = quality_model(spark)
    got = {r["doc_id"]: r for r in op3_quality_classifier(spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        want = slow_quality(model, d["text"])
        r = got[d["doc_id"]]
        assert abs(r["score"] - want) < 1e-6 and r["predicted"] == (r["score"] >= 0.5) and r["held_out"] == (crc(d["doc_id"], 3) == 1)


def test_a_training_step_follows_the_gradient():
    from skyflow.llm.quality import BUCKETS, WIDTH, SubwordModel, text_features

    rows = [(*map(np.array, text_features(t)), y) for t, y in (("good words here", 1), ("bad spam spam", 0), ("good spam", 1))]
    model = SubwordModel.train(rows, epochs=1, batch=3, rate=0.3, seed=1)
    vectors = np.random.default_rng(1).uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    hidden = np.array([(vectors[p] * w[:, None]).sum(0) for p, w, _ in rows], float)

    def loss(theta):
        layer, bias = theta[: 2 * WIDTH].reshape(WIDTH, 2), theta[2 * WIDTH :]
        logits = hidden @ layer + bias
        return np.mean([np.log(np.exp(z).sum()) - z[y] for z, (_, _, y) in zip(logits, rows)])

    theta = np.r_[np.zeros(2 * WIDTH), 0.0, np.log(3 / 2)]
    slope = np.array([(loss(theta + h) - loss(theta - h)) / 2e-5 for h in np.eye(len(theta)) * 1e-5])
    theta -= 0.3 * slope / np.sqrt(1e-6 + slope**2)
    layer = theta[: 2 * WIDTH].reshape(WIDTH, 2)
    touched = np.unique(np.concatenate([p for p, _, _ in rows]))
    # the layer starts at zero, so the first step leaves the vectors in place
    assert np.allclose(model.place_score[touched], vectors[touched] @ (layer[:, 1] - layer[:, 0]), atol=1e-3)
    assert abs(model.bias - (theta[-1] - theta[-2])) < 1e-3


def test_contradictory_and_repeated_labels(spark):
    from skyflow.llm import quality

    docs = spark.createDataFrame([(i, "fine text of words" if i % 2 else "junk junk junk") for i in range(40)], "doc_id long, text string")
    labels = [(i, i % 2) for i in range(40)]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int")
    plain = quality.fit(docs, frame(labels))
    again = quality.fit(docs, frame(labels + labels[:10] * 3))
    assert np.array_equal(plain.place_score, again.place_score)
    without = quality.fit(docs, frame(labels[2:]))
    torn = quality.fit(docs, frame([(0, 1), (1, 0), *labels]))
    assert np.array_equal(without.place_score, torn.place_score)
    none = quality.fit(docs, frame(labels), places=10)
    assert not none.place_score.any()


def cuts(word, longest):
    if not word:
        yield []
    for n in range(1, min(len(word), longest) + 1):
        for rest in cuts(word[n:], longest):
            yield [word[:n], *rest]


def test_segmentations_are_summed_and_counted():
    from skyflow.llm.lang_id import FLOOR, LanguageModel, Trie, expected, forward, long_word

    pieces = sorted({"▁", "▁a", "a", "ab", "b", "ba", "bab", "c", "▁ab"})
    prob = np.vstack([np.random.default_rng(3).dirichlet(np.ones(len(pieces)), 2).T, [[0, 0]]])
    trie, place = Trie(pieces), {p: i for i, p in enumerate(pieces)}
    words = ["▁ab", "▁abab", "▁cab", "▁xba", "▁", "▁bab"]

    def chance(cut, k):
        return math.prod((prob[place[p], k] if p in place else 0) + (FLOOR if len(p) == 1 else 0) for p in cut)

    alpha, _, sizes = forward(trie, prob, words)
    counts = np.array([3.0, 1, 2, 5, 1, 4])
    for k in range(2):
        sums = [sum(chance(c, k) for c in cuts(w, 16)) for w in words]
        assert np.allclose(alpha[np.arange(len(words)), sizes, k], sums)
        assert np.allclose([long_word(trie, prob, w)[k] for w in words], np.log(sums))
        uses = np.zeros(len(pieces))
        for w, n, total in zip(words, counts, sums):
            for c in cuts(w, 16):
                for j, p in enumerate(c):
                    if p in place:  # a character's floor is no use of its piece
                        rest = chance(c[:j] + c[j + 1 :], k)
                        uses[place[p]] += n * prob[place[p], k] * rest / total
        assert np.allclose(expected(trie, prob[:, [k]], words, counts), uses)
    model = LanguageModel(["x", "y"], pieces, prob)
    assert np.allclose(model.log_words([w[1:] for w in words]), np.log(alpha[np.arange(len(words)), sizes]))
    assert LanguageModel(["x", "y"], [], prob[-1:]).log_words(["ab"]).shape == (1, 2)


def test_long_words_are_learned_from(spark):
    from skyflow.llm import lang_id

    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = [(i, ("lorem" * 30) if i % 2 else ("tusan" * 30), "aa" if i % 2 else "bb") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("_lang", F.lit("kept"))
    out = lang_id.identify(docs, path).collect()
    assert all(r["lang_pred"] == r["lang"] and r["_lang"] == "kept" for r in out)


def test_languages_are_learned_from_all_rows(spark):
    from skyflow.llm import lang_id

    greek = [chr(c) for c in range(0x3B1, 0x3CA) if c != 0x3C2]
    rows = [(i, "lorem " + (greek[i // 100] if i % 100 == 0 and i // 100 < len(greek) else "tusan"), "aa") for i in range(3000)]
    model = lang_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), public_tokenizers.path("piece_bpe_32k.model"))
    assert set(greek) <= set("".join(model.pieces))


def test_quantiles_are_exact(spark):
    from skyflow.llm import lang_id

    rng = np.random.default_rng(3)
    values = {"a": [*rng.normal(-2, 0.4, 997), *[-2.0] * 50], "b": [-1.5], "c": [-3.0, -1.0]}
    rows = [(k, float(v)) for k, vs in values.items() for v in vs] + [("d", None)]
    got = lang_id.quantiles(spark.createDataFrame(rows, "lang string, v double"), "lang", "v", (0.01, 0.5)).collect()
    assert {r["lang"] for r in got} == set(values)
    assert all(np.allclose(r["q"], np.quantile(values[r["lang"]], (0.01, 0.5)), atol=1e-12) for r in got)


def language_model(spark, rows=None):
    from skyflow.llm import lang_id

    docs = spark.read.parquet(f"{SF}/documents.parquet") if rows is None else rows
    docs = docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    return lang_id.fit(docs, public_tokenizers.path("piece_bpe_32k.model")), docs


def slow_language(model, text, known):
    """Best language, its share, and log probability a letter, by a plain sum over segmentations of each word."""
    from skyflow.llm.lang_id import FLOOR

    if not text or not any(map(str.isalpha, text)):
        return "und", 0.0, None
    place = known.setdefault("place", {p: i for i, p in enumerate(model.pieces)})
    words, total = re.findall(r"[^\W\d_]+", text.lower()), np.zeros(len(model.langs))
    for w in words:
        if w not in known:
            marked, alpha = "▁" + w, [np.ones(len(model.langs))]
            scale = np.zeros(len(model.langs))
            for end in range(1, len(marked) + 1):
                now = np.zeros(len(model.langs))
                for n in range(1, min(16, end) + 1):
                    i = place.get(marked[end - n : end])
                    if n == 1 or i is not None:
                        now = now + alpha[-n] * ((model.prob[i] if i is not None else 0) + (FLOOR if n == 1 else 0))
                alpha.append(now)
                if end % 16 == 0:  # keep long words within doubles
                    scale, alpha = scale + np.log(now), [a / now for a in alpha]
            known[w] = scale + np.log(np.maximum(alpha[-1], 1e-300))
        total += known[w]
    k = int(total.argmax())
    return model.langs[k], float(1 / np.exp(total - total[k]).sum()), float(total[k]) / max(1, sum(map(len, words)))


def test_language_scores_are_sums_over_segmentations(spark, docs):
    from skyflow.llm.queries import op10_unigram_language

    model, _ = language_model(spark)
    got, known = {r["doc_id"]: r for r in op10_unigram_language(spark, SF).collect()}, {}
    for d in docs:
        lang, score, _ = slow_language(model, d["text"], known)
        r = got[d["doc_id"]]
        assert (r["lang_pred"], r["held_out"]) == (lang, crc(d["doc_id"], 5) == 0) and abs(r["score"] - score) < 1e-6


def test_pipeline_is_its_stages(spark, docs):
    import corpus_pipeline
    from skyflow.llm import lang_id, quality
    from skyflow.llm.simhash import fingerprint
    from tokenizers import Tokenizer

    tables = []
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        frame = corpus_pipeline.written(stage(spark, frame, SF), "stage")
        tables.append(frame)
    found = [{r["doc_id"]: r["text"] for r in t.collect()} for t in tables[:-1]]

    model = quality_model(spark)
    texts = {d["doc_id"]: d["text"] for d in docs}
    texts = {i: t for i, t in texts.items() if slow_quality(model, t) >= 0.5}
    assert found[0] == texts

    model, rows = language_model(spark, tables[0])
    least, known = lang_id.least_per_letter(rows, model), {}
    judged = {i: slow_language(model, t, known) for i, t in texts.items()}
    texts = {i: t for i, t in texts.items() if judged[i][0] != "und" and judged[i][1] >= 0.5 and judged[i][2] >= least.get(judged[i][0], -math.inf)}
    assert found[1] == texts

    first = {}
    lines = {i: (t or "").split("\n") for i, t in texts.items()}
    key = lambda x: re.sub(r"[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    held = defaultdict(set)
    for i, xs in lines.items():
        for x in xs:
            held[key(x)].add(i)
    first = {k: min(v) for k, v in held.items() if len(v) > 1 and len(k) >= 10}
    texts = {i: "\n".join(x for x in xs if first.get(key(x), i) == i) for i, xs in lines.items()}
    assert found[2] == texts

    prints = {i: fingerprint(t) for i, t in texts.items()}

    def shingles(t):
        w = t.encode().lower().split()
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}

    root = {i: i for i in texts}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(texts), 2):
        apart = (prints[a] ^ prints[b]).bit_count()
        if apart <= 3 or (apart <= 7 and len((x := shingles(texts[a])) & (y := shingles(texts[b]))) >= 0.8 * len(x | y)):
            p, q = sorted((top(a), top(b)))
            root[q] = p
    texts = {i: t for i, t in texts.items() if top(i) == i}
    assert found[3] == texts

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = set()
    for i, t in texts.items():
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            want.add((i, k // 2048, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    packed = tables[-1].collect()
    assert {tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in packed} == want and len(packed) == len(want)
    sequences = defaultdict(list)
    for r in packed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        ends = np.cumsum([0] + [n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == ends[:-1].tolist() and ends[-1] <= 2048


def test_clashing_columns(spark, docs):
    import corpus_pipeline
    from skyflow.llm import line_dedup, packing, quality

    names = ["_drop", "_parts", "_rank", "_before", "_part", "_own", "_id", "drop", "spread", "row", "part", "c0", "c7"]
    rows = [(i, f"a line that repeats\nline {i} of its own", 1) for i in (1, 2, 2, 3, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, length long").withColumns({n: F.lit(n) for n in names})
    frame = frame.withColumn("a.b", F.lit("dotted"))
    kept = line_dedup.dedup_lines(frame).collect()
    assert len(kept) == 6 and all(r["a.b"] == "dotted" and all(r[n] == n for n in names) for r in kept)
    assert sorted((r["doc_id"] or 0, r["n_dropped"]) for r in kept) == [(0, 0), (0, 0), (1, 0), (2, 1), (2, 1), (3, 1)]
    packed = packing.pack(frame).collect()
    assert len(packed) == 6 and all(r["a.b"] == "dotted" and all(r[n] == n for n in names) for r in packed)
    near = corpus_pipeline.drop_near_duplicates(spark, frame, SF)
    assert near.columns == frame.columns and all(r["_own"] == "_own" for r in near.collect())
    assert corpus_pipeline.drop_lines(spark, frame, SF).columns == frame.columns
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert quality.classify(frame, labels).columns == [*frame.columns, "score"]


def test_repeated_ids_are_packed_in_several_parts(spark, monkeypatch):
    from skyflow.llm import packing

    monkeypatch.setattr(packing, "RANKED", 50)
    frame = spark.createDataFrame([(None, 700)] * 400 + [(1, 600)] * 400, "doc_id long, length long").repartition(3)
    out = packing.pack(frame)
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in out.collect())
    assert len(places) == 800 and len({s for s, _, _ in places}) <= 270
    assert all(o == (places[k - 1][1] + places[k - 1][2] if k and places[k - 1][0] == s else 0) for k, (s, o, _) in enumerate(places))


@pytest.mark.parametrize("kind", ["uniform", "log-normal", "middle"])
def test_plan_is_no_worse_than_best_fit(kind):
    from skyflow.llm.packing import fill, plan

    rng = np.random.default_rng(9)
    sizes = {"uniform": rng.integers(1, 2049, 3000), "log-normal": np.clip(rng.lognormal(6, 1, 3000), 1, 2048).astype(int), "middle": rng.integers(900, 1200, 3000)}[kind]
    total = np.bincount(sizes, minlength=2049)
    best_fit = sum(n for n, _ in fill(total, 2048, [], np.zeros(0)))
    runs = plan({int(k): int(n) for k, n in enumerate(total) if n}, 2048)
    assert int(runs[:, 3].max() + (runs[:, 2] - runs[:, 1])[runs[:, 3].argmax()]) <= best_fit
