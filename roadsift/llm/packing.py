"""Operator 6: packing by power-of-two decomposition.

A document of n ids is cut into as many pieces of the largest length as fit and then one piece
for each binary digit of what is left, longest first. Each piece is a sequence of its own and
sequences of one length form a bucket, so that no sequence crosses documents and none is padded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadsift.llm.bpe_automaton import encoder
from roadsift.llm.common import is_heavy, map_batches


def binary_lengths(n: int, longest: int) -> list[int]:
    """Piece lengths of n ids, longest first; ``longest`` is a power of two."""
    left = n % longest
    return [longest] * (n // longest) + [1 << b for b in reversed(range(longest.bit_length())) if left >> b & 1]


def pack_documents(docs: DataFrame, vocabulary_path: str, longest: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: doc_id, start, length, ids (binary, little-endian u32), doc_tokens, bucket, sequence_id, offset.

    ``bucket`` is the binary logarithm of the length; sequences of a bucket stack into batches
    without padding. ``sequence_id`` is unique over the result and depends on the input's
    partitions alone, so a task that runs again gives the same ids. Null text counts as empty and
    gives one piece that holds the end id. Null and repeated doc_ids keep pieces of their own;
    other columns are left out. An empty table gives an empty result.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = f.read()
    end = np.uint32(end_id).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, "merges")
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for doc_id, ids in zip(batch.column(0).to_pylist(), enc.encode_array(batch.column(1)), strict=True):
                ids, start = ids + end, 0
                for length in binary_lengths(len(ids) // 4, longest):
                    for col, x in zip(cols, (doc_id, start, length, ids[4 * start : 4 * (start + length)], len(ids) // 4), strict=True):
                        col.append(x)
                    start += length
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "start", "length", "ids", "doc_tokens"])
        enc.rest()
        if is_heavy():  # other stages of a pipeline run in the same workers
            del enc
            encoder.cache_clear()

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = map_batches(source, run, "doc_id long, start long, length long, ids binary, doc_tokens long")
    return pieces.select(
        "*",
        F.log2(F.col("length").cast("double")).cast("int").alias("bucket"),
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write sequences by bucket, so that a reader takes equal lengths from one folder."""
    pieces.write.partitionBy("bucket").parquet(path)
