"""Token counts of the fields or sections of a text, attributed by offsets.

The whole text is encoded once, so its tokens are those that training sees. Each token's span is then joined to the
spans of the sections. A token that crosses a boundary counts for the section that holds most of its bytes, the
earlier of two with equally many; so the sections' counts sum to the text's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from skyflow.llm.byte_bpe import TextCoder, read_ranks
from skyflow.llm.common import map_rows, prepare, worker_state


def attribute(ends: np.ndarray, section_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and of these the ones that cross a boundary.

    ``ends`` are the ends of consecutive tokens, ``section_ends`` those of consecutive sections (empty ones
    allowed), both in bytes from the start of the text and ending at the same place.
    """
    starts = np.r_[0, ends[:-1]] if len(ends) else ends
    first = np.searchsorted(section_ends, starts, side="right")
    last = np.searchsorted(section_ends, ends - 1, side="right")
    owner, most = first.copy(), np.minimum(section_ends[first], ends) - starts
    crossing = first != last
    low = first.copy()
    while (open_ := np.flatnonzero(low < last)).size:  # as often as a token meets sections
        low[open_] += 1
        k = low[open_]
        held = np.minimum(section_ends[k], ends[open_]) - np.maximum(section_ends[k - 1], starts[open_])
        better = held > most[open_]
        owner[open_[better]], most[open_[better]] = k[better], held[better]
    n = len(section_ends)
    return np.bincount(owner, minlength=n), np.bincount(owner[crossing], minlength=n)


class Spans:
    """Byte lengths of the tokens of whole texts, by the ``tiktoken`` library, memoised by what stands between spaces."""

    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken

        ranks = read_ranks(ranks_path)
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        size = {i: len(b).to_bytes(2, "little") for b, i in ranks.items()}
        self.texts = TextCoder(lambda text: b"".join(size[i] for i in encoding.encode_ordinary(text)), b"")

    def ends(self, text: str) -> np.ndarray:
        return np.cumsum(np.frombuffer(self.texts.encode(text), "<u2"), dtype=np.int64)


def line_token_counts(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, section, n_chars, n_tokens and n_crossing of every line of every text, numbered from 0.

    A section is a line with the line end behind it. A null or empty text is one section without tokens. n_chars are
    code points, n_crossing those of n_tokens that reach into other sections. Other columns are not looked at;
    repeated rows and null ids give rows of their own.
    """
    prepare(docs.sparkSession)

    def count(rows: Iterator[tuple]) -> Iterator[tuple]:
        spans = worker_state(("bpe", "spans", ranks_path, pattern), lambda: Spans(ranks_path, pattern))
        for doc_id, text in rows:
            lines = (text or "").split("\n")
            sizes = np.array([len(x.encode()) + 1 for x in lines], np.int64)
            sizes[-1] -= 1
            ends = spans.ends(text) if text else np.zeros(0, np.int64)
            tokens, crossing = attribute(ends, np.cumsum(sizes))
            for i, line in enumerate(lines):
                yield doc_id, i, len(line) + (i + 1 < len(lines)), int(tokens[i]), int(crossing[i])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs.select("doc_id", "text"), count, f"doc_id {id_type}, section int, n_chars long, n_tokens long, n_crossing long", owner="bpe")
