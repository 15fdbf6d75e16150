"""Byte-level BPE by prefix dynamic programming.

Of the tokens that can end a prefix of the bytes, exactly one is the last token of that prefix's encoding: the one
that stays unmerged next to the last token of the prefix before it. Keeping that token for every prefix gives the
encoding by walking back, makes appending exact without a second look at what is there, and limits the work of an
edit to the prefixes behind it.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import DataFrame

from skyflow.llm.common import LONGEST_KEY, map_rows, prepare, worker_state

#: Entries of each memory of a worker; strings longer than ``LONGEST_KEY`` are not kept, so this bounds its bytes.
KEPT = 300_000
HEAD = 8
_SPACES = re.compile(r"\s ")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class ByteBpe:
    """Encoder and decoder for a rank file; ``pattern`` splits a text into parts that are encoded separately."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks, self.tokens = ranks, {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks))
        ending: dict[bytes, set[int]] = {}
        for b in ranks:
            if len(b) > 2:
                ending.setdefault(b[-3:], {1, 2}).add(len(b))
        self.lengths = {b: tuple(sorted(n, reverse=True)) for b, n in ending.items()}  # of tokens with these last bytes
        self.heads: dict[bytes, list[int]] = {}
        self.split = regex.compile(pattern).findall
        self.fits: dict[int, bool] = {}
        self.parts: dict[str, tuple[int, ...]] = {}

    @staticmethod
    def shared(path: str, pattern: str) -> ByteBpe:
        return worker_state(("bpe", "ranks", path, pattern), lambda: ByteBpe(read_ranks(path), pattern))

    def merged(self, data: bytes) -> list[bytes]:
        """Merges the pair of lowest rank, leftmost first, until none is left; for the few bytes of two tokens."""
        parts = [data[i : i + 1] for i in range(len(data))]
        rank = self.ranks.get
        while len(parts) > 1:
            pairs = [(r, i) for i in range(len(parts) - 1) if (r := rank(parts[i] + parts[i + 1])) is not None]
            if not pairs:
                break
            i = min(pairs)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def beside(self, left: int, right: int) -> bool:
        """Whether two tokens stay apart when their bytes are encoded together."""
        key = left << 32 | right
        known = self.fits.get(key)
        if known is None:
            a, b = self.tokens[left], self.tokens[right]
            known = self.merged(a + b) == [a, b]
            if len(self.fits) < 2 * KEPT:
                self.fits[key] = known
        return known

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """``last[i]`` is the last token of the first i + 1 bytes; goes on from where ``last`` ends."""
        rank, fits, beside, lengths = self.ranks.get, self.fits.get, self.beside, self.lengths.get
        for end in range(len(last) + 1, len(data) + 1):
            for n in lengths(data[end - 3 : end], (2, 1)) if end > 2 else (2, 1):  # the longest token first
                if n > end:
                    continue
                token = rank(data[end - n : end])
                if token is not None:
                    if n == end:
                        if n == 1 or self.alone(token):
                            break
                        continue
                    left = last[end - n - 1]
                    known = fits(left << 32 | token)
                    if beside(left, token) if known is None else known:
                        break
            else:
                raise ValueError("the ranks lack single bytes")
            last.append(token)
        return last

    def alone(self, token: int) -> bool:
        """Whether a token's bytes are encoded as that token."""
        key = -1 - token
        if key not in self.fits:
            self.fits[key] = self.merged(self.tokens[token]) == [self.tokens[token]]
        return self.fits[key]

    def prefixes(self, data: bytes) -> list[int]:
        """``extend`` from nothing; many parts begin alike, so what belongs to their first bytes is kept."""
        if len(data) <= HEAD:
            return self.extend(data, [])
        head = self.heads.get(data[:HEAD])
        if head is None:
            head = self.extend(data[:HEAD], [])
            if len(self.heads) < KEPT:
                self.heads[data[:HEAD]] = head
        return self.extend(data, head.copy())

    def walk(self, last: list[int]) -> list[int]:
        out, at = [], len(last)
        while at:
            out.append(last[at - 1])
            at -= len(self.tokens[out[-1]])
        return out[::-1]

    def encode_part(self, part: str) -> tuple[int, ...]:
        ids = self.parts.get(part)
        if ids is None:
            data = part.encode()
            whole = self.ranks.get(data)
            ids = (whole,) if whole is not None else tuple(self.walk(self.prefixes(data)))
            if len(self.parts) < KEPT and len(part) <= LONGEST_KEY:
                self.parts[part] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        return [i for part in self.split(text) for i in self.encode_part(part)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class EditedPart:
    """One part's bytes with the last token of every prefix; appends and edits redo only what follows them."""

    def __init__(self, bpe: ByteBpe, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, data, bpe.extend(data, [])

    def append(self, more: bytes) -> None:
        self.data += more
        self.bpe.extend(self.data, self.last)

    def replace(self, start: int, end: int, new: bytes) -> None:
        """Redoes the prefixes from ``start`` until they agree with the old ones over a longest token's bytes."""
        old, old_at = self.last, end
        self.data = self.data[:start] + new + self.data[end:]
        self.last = old[:start]
        same, at = 0, start
        while len(self.last) < len(self.data):
            at = len(self.last) + 1
            self.bpe.extend(self.data[:at], self.last)
            before = at - 1 - (start + len(new))
            if before >= 0:
                same = same + 1 if old[old_at + before] == self.last[-1] else 0
                if same >= self.bpe.longest:  # no later prefix looks further back
                    self.last += old[old_at + before + 1 :]

    def ids(self) -> list[int]:
        return self.bpe.walk(self.last)


class TextCoder:
    """Codes whole texts piecewise, memoised by what stands between spaces.

    Where no white space comes before a space, every space followed by a text opens a match of the pattern, so the
    text may be cut there; other texts go through ``encode`` whole. ``encode`` gives what ``glue`` joins.
    """

    def __init__(self, encode: Callable[[str], Any], glue: Any):
        self.code, self.glue, self.known = encode, glue, {}

    def encode(self, text: str) -> Any:
        if not text or text[-1] == " " or _SPACES.search(text):
            return self.code(text)
        first, *rest = text.split(" ")
        known = self.known
        try:
            found = list(map(known.__getitem__, rest))
        except KeyError:
            found = []
            for word in rest:
                got = known.get(word)
                if got is None:
                    got = self.code(" " + word)
                    if len(known) < KEPT and len(word) <= LONGEST_KEY:
                        known[word] = got
                found.append(got)
        return self.glue.join([self.code(first), *found] if first else found)


class DecimalCoder:
    """Ids of whole texts as decimal strings, and back to bytes."""

    def __init__(self, bpe: ByteBpe):
        self.texts = TextCoder(lambda text: " ".join(map(str, bpe.encode(text))), " ")
        self.bytes_of = {str(i): b for i, b in bpe.tokens.items()}

    def decode(self, decimal: str) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, decimal.split(" "))) if decimal else b""


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, ids (decimal, one space between) and decoded (bytes of those ids) of every row; a null text is empty.

    Other columns are not looked at; repeated rows and null ids give rows of their own.
    """
    prepare(docs.sparkSession)

    def code(rows: Iterator[tuple]) -> Iterator[tuple]:
        coder = worker_state(("bpe", "coder", ranks_path, pattern), lambda: DecimalCoder(ByteBpe.shared(ranks_path, pattern)))
        for doc_id, text in rows:
            ids = coder.texts.encode(text or "")
            yield doc_id, ids, coder.decode(ids)

    return map_rows(docs.select("doc_id", "text"), code, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids string, decoded binary", 500, "bpe")
