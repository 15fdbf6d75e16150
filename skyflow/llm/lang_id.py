"""Language identification by unigrams over a fixed public vocabulary, summed over all segmentations.

Each language has a probability for every piece of the vocabulary, learned by expectation-maximisation on the words of
all rows. A word's probability in a language is the sum over all ways to cut it into pieces, found by a
forward pass; a text's score multiplies its words. Both passes run on arrays of many words at a time.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyflow.llm.common import ENTRY_BYTES, KEPT_BYTES, LONGEST_KEY, begin, map_rows, numbered, prepare, worker_state, written

#: Words that a task counts before it hands its counts on.
COUNTED = 100_000
#: Width of the cells of log probabilities by letter in which ranks are looked up.
CELL = 0.001
#: Probability of any single character besides its learned share, so that every word can be cut.
FLOOR = 1e-6
#: Words up to this length go through the passes as arrays; longer ones one by one.
LONG = 32
LONGEST_PIECE = 16
_WORD = re.compile(r"[^\W\d_]+")
START = "▁"


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def vocabulary(path: str) -> list[str]:
    """Pieces of a sentencepiece model that can occur in a word; bytes and control pieces are left out."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)))
    return sorted({p for p in pieces if len(p) <= LONGEST_PIECE and START not in p[1:] and p == p.lower()})


class Trie:
    """Trie over the pieces; ``key`` has node and class of every edge in order, ``to`` where it leads, ``piece[node]`` the
    node's piece or -1."""

    def __init__(self, pieces: list[str]):
        self.classes = {c: i + 1 for i, c in enumerate(sorted(set("".join(pieces))))}
        nodes: list[dict[int, int]] = [{}, {}]  # 0: nothing, 1: root
        ends = [-1, -1]
        for i, p in enumerate(pieces):
            at = 1
            for c in p:
                k = self.classes[c]
                if k not in nodes[at]:
                    nodes[at][k] = len(nodes)
                    nodes.append({})
                    ends.append(-1)
                at = nodes[at][k]
            ends[at] = i
        self.wide = len(self.classes) + 1
        edges = sorted((n * self.wide + k, v) for n, to in enumerate(nodes) for k, v in to.items())
        self.key, self.to = np.array([k for k, _ in edges], np.int64), np.array([v for _, v in edges], np.int64)
        self.piece = np.array(ends, np.int32)

    def step(self, node: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """The next nodes, 0 where there is none."""
        if not len(self.key):
            return np.zeros_like(node)
        key = node * self.wide + kind
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.to[at], 0)

    def edges(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces found in words: columns (end, length, word, piece), by end and length; and the words' lengths.

        Every single character is an edge, with piece -1 where it is no piece.
        """
        sizes = np.array([len(w) for w in words])
        chars = np.zeros((len(words), int(sizes.max())), np.int64)
        get = self.classes.get
        chars[np.arange(chars.shape[1]) < sizes[:, None]] = [get(c, 0) for w in words for c in w]
        row, start = np.nonzero(np.arange(chars.shape[1]) < sizes[:, None])
        node, found = np.ones(len(row), np.int64), []
        for length in range(1, LONGEST_PIECE + 1):
            inside = start + length <= sizes[row]
            row, start, node = row[inside], start[inside], node[inside]
            node = self.step(node, chars[row, start + length - 1])
            keep = np.ones(len(row), bool) if length == 1 else self.piece[node] >= 0
            found.append(np.stack([start[keep] + length, np.full(keep.sum(), length), row[keep], self.piece[node[keep]]], 1))
            alive = node > 0
            row, start, node = row[alive], start[alive], node[alive]
            if not len(row):
                break
        out = np.concatenate(found)
        return out[np.lexsort((out[:, 1], out[:, 0]))], sizes


def runs(edges: np.ndarray) -> Iterator[slice]:
    """Edges of one end and length: in each run a word occurs once at most."""
    if len(edges):
        cuts = np.flatnonzero((np.diff(edges[:, 0]) != 0) | (np.diff(edges[:, 1]) != 0)) + 1
        yield from map(slice, [0, *cuts.tolist()], [*cuts.tolist(), len(edges)])


def forward(trie: Trie, prob: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums over the segmentations of every prefix, by word, place and language; with edges and lengths."""
    edges, sizes = trie.edges(words)
    alpha = np.zeros((len(words), int(sizes.max()) + 1, prob.shape[1]))
    alpha[:, 0] = 1
    for part in runs(edges):
        end, length, _, _ = edges[part.start]
        row, piece = edges[part, 2], edges[part, 3]
        alpha[row, end] += alpha[row, end - length] * (prob[piece] + (FLOOR if length == 1 else 0))
    return alpha, edges, sizes


def expected(trie: Trie, prob: np.ndarray, words: list[str], counts: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations of the words; ``prob`` has one language."""
    alpha, edges, sizes = forward(trie, prob, words)
    beta = np.zeros_like(alpha)
    at = np.arange(len(words))
    beta[at, sizes] = 1
    order = np.lexsort((edges[:, 1], edges[:, 0] - edges[:, 1]))  # by start
    back = edges[order]
    starts = back[:, 0] - back[:, 1]
    cuts = np.flatnonzero((np.diff(starts) != 0) | (np.diff(back[:, 1]) != 0)) + 1
    for part in reversed(list(map(slice, [0, *cuts.tolist()], [*cuts.tolist(), len(back)]))):
        end, length, _, _ = back[part.start]
        row, piece = back[part, 2], back[part, 3]
        beta[row, end - length] += beta[row, end] * (prob[piece] + (FLOOR if length == 1 else 0))
    whole = alpha[at, sizes, 0]
    end, length, row, piece = edges.T
    use = alpha[row, end - length, 0] * prob[piece, 0] * beta[row, end, 0] / whole[row] * counts[row]
    return np.bincount(piece[piece >= 0], use[piece >= 0], len(prob) - 1)


def long_word(trie: Trie, prob: np.ndarray, word: str) -> np.ndarray:
    """Log of the sum over segmentations for a word of any length, scaled as it goes; memory of a few places."""
    ring = np.zeros((LONGEST_PIECE + 1, prob.shape[1]))
    ring[0] = 1
    scale = np.zeros(prob.shape[1])
    codes = np.array([trie.classes.get(c, 0) for c in word], np.int64)
    for i in range(len(codes)):
        if i % 4096 == 0:  # nodes from the next places on, by length
            places = np.arange(i, min(i + 4096, len(codes)))
            nodes = [np.ones(len(places), np.int64)]
            for k in range(LONGEST_PIECE):
                ahead = np.minimum(places + k, len(codes) - 1)
                nodes.append(np.where(places + k < len(codes), trie.step(nodes[-1], codes[ahead]), 0))
            found = np.array(nodes).T.tolist()
        now = ring[0].copy()
        ring[:-1], ring[-1] = ring[1:].copy(), 0
        for length in range(1, min(LONGEST_PIECE, len(codes) - i) + 1):
            node = found[i % 4096][length]
            piece = int(trie.piece[node])
            if length == 1 or piece >= 0:
                ring[length - 1] += now * (prob[piece] + (FLOOR if length == 1 else 0))
            if not node:
                break
        top = ring.max(0)
        ring /= top
        scale += np.log(top)
    return scale + np.log(np.maximum(ring[0], 1e-300))


class LanguageModel:
    """``prob[piece, language]`` with a last row of zeros, so that piece -1 has none; ``prior`` as logs."""

    def __init__(self, langs: list[str], pieces: list[str], prob: np.ndarray):
        self.langs = langs
        prob = prob[: len(pieces)]
        used = np.flatnonzero((prob > 1e-9).any(1)) if langs else np.zeros(0, int)
        self.pieces, self.prob = [pieces[i] for i in used], np.vstack([prob[used], np.zeros((1, prob.shape[1]))])
        self.trie = Trie(self.pieces)

    def log_words(self, words: list[str]) -> np.ndarray:
        marked = [START + w for w in words]
        out = np.empty((len(words), len(self.langs)))
        short = [i for i, w in enumerate(marked) if len(w) <= LONG]
        short.sort(key=lambda i: len(marked[i]))
        for lo in range(0, len(short), 4000):
            part = short[lo : lo + 4000]
            alpha, _, sizes = forward(self.trie, self.prob, [marked[i] for i in part])
            out[part] = np.log(np.maximum(alpha[np.arange(len(part)), sizes], 1e-300))
        for i, w in enumerate(marked):
            if len(w) > LONG:
                out[i] = long_word(self.trie, self.prob, w)
        return out


class WordScores:
    """Log probabilities of words by language; new words of a batch are scored together. Words are kept within
    ``KEPT_BYTES``, long ones not beyond their batch."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.values, self.bytes = np.zeros((0, len(self.model.langs))), 0

    def batch(self, texts: list[list[str]]) -> list[np.ndarray]:
        if self.bytes > KEPT_BYTES:
            self.clear()
        place = self.place
        new = sorted({w for t in texts for w in t if w not in place}, key=len)
        if new:
            old = self.values
            place.update(zip(new, range(len(old), len(old) + len(new))))
            self.values = np.concatenate([old, self.model.log_words(new)])
        get = place.__getitem__
        out = [self.values[np.fromiter(map(get, t), np.int64, len(t))].sum(0) for t in texts]
        while new and len(new[-1]) > LONGEST_KEY:  # these have the last places
            del place[new.pop()]
        self.values = self.values[: len(place)]
        self.bytes += sum(map(len, new)) + len(new) * (ENTRY_BYTES + 8 * len(self.model.langs))
        return out


def known_rows(docs: DataFrame) -> DataFrame:
    """lang and text of every row that has both and an id."""
    known = docs.where("lang is not null and doc_id is not null and text is not null")
    return known.select(F.col("lang").cast("string").alias("lang"), "text")


def fit(docs: DataFrame, vocabulary_path: str, rounds: int = 3) -> LanguageModel:
    """Learns from all rows of ``docs`` with a language.

    Null languages, ids and texts are left out. No such rows: a model of no languages. Words of ``LONG`` letters or more
    are learned in cuts of fewer.
    """
    spark = prepare(docs.sparkSession)
    known = known_rows(docs)
    langs = sorted(r["lang"] for r in known.select("lang").distinct().collect())

    def count(items: Iterator[tuple]) -> Iterator[tuple]:
        seen: Counter = Counter()
        for lang, text in items:
            seen.update((lang, w[k : k + LONG - 1]) for w in words_of(text) for k in range(0, len(w), LONG - 1))
            if len(seen) > COUNTED:
                yield from ((a, b, n) for (a, b), n in seen.items())
                seen.clear()
        yield from ((a, b, n) for (a, b), n in seen.items())

    table = map_rows(known, count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    table = written(table, "words")
    # pieces with a character that no word has would get no probability; without them the trie is small
    chars = {START} | {r[0] for r in table.select(F.explode(F.split("word", ""))).distinct().collect()}
    pieces = [p for p in vocabulary(vocabulary_path) if chars.issuperset(p)]
    prob = np.full((len(pieces), len(langs)), 1 / max(1, len(pieces)))
    for _ in range(rounds if langs else 0):
        sent = spark.sparkContext.broadcast(prob)  # pieces x languages

        def spread(items: Iterator[tuple]) -> Iterator[tuple]:
            trie, uses = Trie(pieces), np.zeros(sent.value.shape)
            own = [np.vstack([sent.value[:, [k]], [[0]]]) for k in range(len(langs))]
            held: dict[str, list[tuple[str, int]]] = {lang: [] for lang in langs}

            def flush(lang: str) -> None:
                k = langs.index(lang)
                part, held[lang] = held[lang], []
                if part:
                    uses[:, k] += expected(trie, own[k], [w for w, _ in part], np.array([n for _, n in part], float))

            for lang, word, n in items:
                held[lang].append((START + word, n))
                if len(held[lang]) >= 4000:
                    flush(lang)
            for lang in langs:
                flush(lang)
            for i, k in zip(*np.nonzero(uses)):
                yield int(i), int(k), float(uses[i, k])

        total = np.zeros(prob.shape)
        for r in map_rows(table, spread, "piece int, lang int, uses double").groupBy("piece", "lang").agg(F.sum("uses")).collect():
            total[r[0], r[1]] = r[2]
        prob = total / np.maximum(total.sum(0), 1e-300)
    return LanguageModel(langs, pieces, prob)


def predicted(text: Column, model: LanguageModel, spark) -> Column:
    """Struct of lang_pred, score (share of the best language, 0 to 1) and per_letter (log probability of the words in
    that language by letter) of a text column.

    ``und`` with score 0 for texts that are null or have no letter; equal scores go to the language first by name.
    """
    # plain values: a broadcast is pickled by reference, and workers need not have this package
    sent, key = spark.sparkContext.broadcast((model.langs, model.pieces, model.prob)), uuid.uuid4().hex

    @F.pandas_udf("lang_pred string, score double, per_letter double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        begin(key)
        m = worker_state((key, "language"), lambda: LanguageModel(*sent.value))
        scores = WordScores(m)
        for texts in batches:
            texts = texts.tolist()
            langs, best, fits = [], [], []
            for lo in range(0, len(texts), 250):
                part = texts[lo : lo + 250]
                words = [words_of(t) for t in part]
                for t, w, s in zip(part, words, scores.batch(words)):
                    if not m.langs or not has_letter(t):
                        langs.append("und")
                        best.append(0.0)
                        fits.append(None)
                    else:
                        k = int(s.argmax())
                        langs.append(m.langs[k])
                        best.append(float(1 / np.exp(s - s[k]).sum()))
                        fits.append(float(s[k]) / max(1, sum(map(len, w))))
            yield pd.DataFrame({"lang_pred": langs, "score": pd.Series(best, dtype="float64"), "per_letter": pd.Series(fits, dtype="float64")})

    return predict(text)


def quantiles(df: DataFrame, key: str, value: str, shares: Sequence[float]) -> DataFrame:
    """Exact quantiles of a column by key, between two ranks linear: ``key`` and an array ``q``.

    Rows are counted by narrow cells; only those in the cell of a wanted rank are ranked.
    """
    df = df.select(F.col(key).alias("k"), F.col(value).alias("v")).where("v is not null")
    df = df.withColumn("cell", F.floor(F.col("v") / CELL))
    cells = df.groupBy("k", "cell").agg(F.count("*").alias("n"))
    every, ordered = Window.partitionBy("k"), Window.partitionBy("k").orderBy("cell")
    cells = cells.select("k", "cell", "n", (F.sum("n").over(ordered) - F.col("n")).alias("below"), F.sum("n").over(every).alias("all"))
    at = [F.lit(share) * (F.col("all") - 1) for share in shares]
    ranks = [(F.floor(a), F.ceil(a)) for a in at]

    def inside(rank: Column) -> Column:
        return (F.col("below") <= rank) & (rank < F.col("below") + F.col("n"))

    asked = cells.where(reduce(or_, [inside(r) for pair in ranks for r in pair])).drop("n")
    values = df.groupBy("k", "cell", "v").agg(F.count("*").alias("n")).join(asked, ["k", "cell"])
    upto = F.sum("n").over(Window.partitionBy("k", "cell").orderBy("v"))
    values = values.withColumn("below", F.col("below") + upto - F.col("n"))

    def value_at(rank: Column) -> Column:
        return F.max(F.when(inside(rank), F.col("v")))

    q = [value_at(lo) + (value_at(hi) - value_at(lo)) * F.max(a - lo) for a, (lo, hi) in zip(at, ranks)]
    return values.groupBy("k").agg(F.array(*q).alias("q")).withColumnRenamed("k", key)


def least_of(fits: DataFrame) -> dict[str, float]:
    """For each language, the log probability by letter below which a text is not taken for it; one number a language.

    ``fits`` has ``lang`` and ``found`` (of ``predicted``) of the rows to fit. Twice as far below the median of the rows
    that are found in their language as their lowest hundredth, so that clean texts stay.
    """
    own = fits.where("found.lang_pred = lang").select("lang", "found.per_letter")
    return {r["lang"]: 2 * r["q"][0] - r["q"][1] for r in quantiles(own, "lang", "per_letter", (0.01, 0.5)).collect()}


def least_per_letter(docs: DataFrame, model: LanguageModel) -> dict[str, float]:
    """``least_of`` all rows of ``docs`` with a language."""
    return least_of(known_rows(docs).select("lang", predicted(F.col("text"), model, docs.sparkSession).alias("found")))


def identify(docs: DataFrame, vocabulary_path: str, train_docs: DataFrame | None = None) -> DataFrame:
    """All rows and columns of ``docs`` with ``lang_pred`` and ``score`` (replaced if there)."""
    model = fit(train_docs if train_docs is not None else docs, vocabulary_path)
    docs = docs.drop("lang_pred", "score")
    plain = numbered(docs)
    text = F.col(plain.columns[docs.columns.index("text")])
    got = plain.withColumn("found", predicted(text, model, docs.sparkSession))
    return got.select(*plain.columns, "found.lang_pred", "found.score").toDF(*docs.columns, "lang_pred", "score")
