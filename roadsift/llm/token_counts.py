"""Operator 7: token counts by heap-and-linked-list byte-pair merging.

A pre-split piece starts as its bytes in a doubly linked list. A heap holds the adjacent pairs
that have a merge, by rank and place. The lowest is popped, its two symbols become one and the
new neighbours are pushed; an entry whose symbols have changed since is skipped. The count is
the number of bytes less the number of merges: no identifiers are emitted.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadsift.llm.common import map_batches
from roadsift.llm.pretokens import Vocabulary, WordCache, blocks, byte_symbols


class MergeCounter:
    def __init__(self, vocabulary_json: str):
        self.vocabulary = v = Vocabulary(vocabulary_json)
        if v.suffix:
            raise ValueError("counts are for byte-level models without word ends")
        self.start = [v.ids[c] for c in byte_symbols()]
        self.ranks = {v.ids[a] << 20 | v.ids[b]: rank for rank, (a, b) in enumerate(v.merges)}
        self.made = [v.ids[a + b] for a, b in v.merges]
        self.words = WordCache(lambda words: list(map(self.count_piece, words)))
        self.chunks = WordCache(self._pieces)

    def count_piece(self, piece: str) -> int:
        symbol = [self.start[b] for b in piece.encode()]
        n, ranks = len(symbol), self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        due = [ranks.get(a << 20 | b, -1) for a, b in zip(symbol, symbol[1:], strict=False)]  # of the pair that begins here
        due.append(-1)
        heap = [r << 32 | i for i, r in enumerate(due) if r >= 0]
        heapify(heap)
        merged = 0
        while heap:
            entry = heappop(heap)
            i, rank = entry & 0xFFFFFFFF, entry >> 32
            if due[i] != rank:
                continue
            merged += 1
            new = symbol[i] = self.made[rank]
            j = after[i]
            due[j] = due[i] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get(new << 20 | symbol[k], -1)) >= 0:
                    due[i] = r
                    heappush(heap, r << 32 | i)
            h = before[i]
            if h >= 0:
                r = due[h] = ranks.get(symbol[h] << 20 | new, -1)
                if r >= 0:
                    heappush(heap, r << 32 | h)
        return n - merged

    def _pieces(self, texts: list[str]) -> list[int]:
        pieces, ends = self.vocabulary.pieces_of(texts)
        told = pieces.dictionary_encode()
        distinct = told.dictionary.to_pylist()
        counts = self.words.many(distinct)
        sums = np.concatenate([[0], np.cumsum(np.array([counts[w] for w in distinct], np.int64)[told.indices.to_numpy()])])
        return np.diff(sums[ends]).tolist()

    def count(self, texts: list[str | None]) -> list[int]:
        return [n for block in blocks(texts) for n in self._count(block)]

    def _count(self, texts: list[str | None]) -> list[int]:
        split = [self.vocabulary.split(t or "") for t in texts]
        counts = {kind: cache.many(itertools.chain.from_iterable(s for part in split for s, of, _ in part if of == kind)) for kind, cache in (("chunks", self.chunks), ("pieces", self.words))}
        return [sum(sum(map(counts[kind].__getitem__, s)) if kind else 1 for s, kind, _ in part) for part in split]


@functools.lru_cache(maxsize=2)
def counter(vocabulary_json: str) -> MergeCounter:
    return MergeCounter(vocabulary_json)


def count_tokens(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every whole text.

    Null text counts as empty: zero bytes, zero tokens. Rows are kept one for one, null and
    repeated ids included; other columns are left out. An empty table gives an empty result.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary).count
        for batch in batches:
            n = count(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return map_batches(source, run, "doc_id long, n_bytes long, n_tokens long")
