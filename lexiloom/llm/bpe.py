"""Token ids of texts by the vocabulary of a public byte-pair tokenizer.

A text is split by the tokenizer's pattern; each piece is a doubly linked list of symbols whose adjacent pairs wait in a priority queue
by merge rank. Entries whose symbols have changed since are skipped. Pieces are memoised per worker.
"""

from __future__ import annotations

import base64
import heapq
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Folder of the public vocabulary files.
TOKENIZERS = os.environ.get("LEXILOOM_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: how byte-level tokenizers of this family cut a text into pieces.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MEMO = 400_000
#: A single space between two visible characters always begins a piece, so texts may be cut there first.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_NO_IDS: tuple = ()


class Tokenizer:
    """Encodes and decodes with the ranks of a vocabulary file; special tokens are ordinary text."""

    def __init__(self, path: str | None = None):
        with open(path or os.path.join(TOKENIZERS, VOCABULARY), "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.vocabulary = {v: k for k, v in self.ranks.items()}
        self.pieces = regex.compile(PATTERN).findall
        self.memo: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return [whole]
        n = len(piece)
        symbol: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = []
        for i in range(n - 1):
            if (r := ranks.get(piece[i : i + 2])) is not None:
                queue.append((r, i, piece[i : i + 2]))
        heapq.heapify(queue)
        while queue:
            _, i, pair = heapq.heappop(queue)
            j = right[i] if symbol[i] is not None else -1
            if j < 0 or symbol[i] + symbol[j] != pair:
                continue  # stale: one of its symbols has been merged since
            symbol[i], symbol[j] = pair, None
            k = right[i] = right[j]
            if k >= 0:
                left[k] = i
                if (r := ranks.get(pair + symbol[k])) is not None:
                    heapq.heappush(queue, (r, i, pair + symbol[k]))
            if (h := left[i]) >= 0 and (r := ranks.get(symbol[h] + pair)) is not None:
                heapq.heappush(queue, (r, h, symbol[h] + pair))
        return [ranks[s] for s in symbol if s is not None]

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        ids: list[int] = []
        for p in self.pieces(chunk):
            ids += self.merge(p.encode("utf-8", "replace"))
        if len(self.memo) >= MEMO:
            self.memo.clear()
        if len(chunk) < 64:
            self.memo[chunk] = tuple(ids)
        return tuple(ids)

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; those of a null or empty text are an empty list."""
        if not text:
            return []
        get, out = self.memo.get, []
        chunks = _CUT.split(text)
        first = chunks[0]
        out.extend(get(first) or self._chunk(first))
        for c in chunks[1:]:
            c = " " + c
            out.extend(get(c) or self._chunk(c))
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids: their byte strings joined."""
        return b"".join(self.vocabulary[i] for i in ids).decode("utf-8", "replace")


def token_ids(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids: one row per document; ids of null and empty texts are empty lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Tokenizer(path)
        for b in batches:
            for start in range(0, b.num_rows, 2000):
                part = b.slice(start, 2000)
                flat, ends = [], [0]
                for text in part.column(1).to_pylist():
                    flat.extend(t.encode(text))
                    ends.append(len(flat))
                lists = pa.ListArray.from_arrays(pa.array(np.asarray(ends, np.int32)), pa.array(np.asarray(flat, np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, source, n_tokens of each document; 0 for null and empty texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Tokenizer(path)
        for b in batches:
            n = [len(t.encode(x)) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], ["doc_id", "source", "n_tokens"])

    return docs.select("doc_id", "source", "text").mapInArrow(run, "doc_id long, source string, n_tokens long")
