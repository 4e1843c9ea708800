"""Operator 13: alignment of two tokenizers' tokens, between whitespace-token anchors.

Both tokenizers encode each whole text, a space before it. Where both have a token that begins with
a space, and the tokens before these end at the same byte, a window of token ids begins. Windows are
told apart by their two tuples of ids; the alignment of each tuple pair is computed once and
remembered: its groups (between shared ends) and its links (tokens whose bytes overlap).

How many documents hold a pair of ids linked is counted over the corpus. Documents are written in
blocks, each with its distinct pairs; these are counted, and the counts come back to the blocks, so
that a pair travels once a block and not once a document.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadsift.llm.common import cut, map_batches
from roadsift.llm.pretokens import BYTE_LEVEL_PATTERN, LOOSE, NOT_PLAIN, Vocabulary, byte_symbols

#: Characters of texts that form one block; a longer text is a block of its own.
BLOCK_CHARACTERS = 4 << 20
MARK = "▁"


def _places(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1 ..., size[0] of them, then start[1] ..."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)


class Aligner:
    def __init__(self, json_text: str, model: bytes):
        self.vocabulary = v = Vocabulary(json_text)
        if v.suffix or v.lower:
            raise ValueError("the first tokenizer must be byte-level, without a normalizer")
        self.library = v.library
        self.library.encode_special_tokens = True
        byte = {c: b for b, c in enumerate(byte_symbols())}
        spelled = {i: bytes(map(byte.__getitem__, token)) for token, i in v.ids.items() if token not in v.special}
        if [v.ids[a + b] for a, b in v.merges] != sorted(v.ids[a + b] for a, b in v.merges):
            raise ValueError("ids must be in order of rank")
        self.ranked = tiktoken.Encoding("first", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks={t: i for i, t in spelled.items()}, special_tokens={})
        self.pieces = s = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [s.id_to_piece(i) for i in range(s.get_piece_size())]
        if any(MARK in name.lstrip(MARK) for name in names):
            raise ValueError("a piece of the second tokenizer reaches over a space")
        second = [bytes([int(name[3:5], 16)]) if s.is_byte(i) else name.replace(MARK, " ").encode() for i, name in enumerate(names)]
        self.spelled = [[spelled.get(i, b"") for i in range(max(v.ids.values()) + 1)], second]
        self.length = [np.array(list(map(len, t))) for t in self.spelled]
        self.marked = [np.array([x[:1] == b" " for x in t]) for t in self.spelled]
        self.size_b = len(names)

    # Tokens of texts.

    def encode(self, parts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """(both streams of ids of all parts, how many ids each part has in both, whether both spell a space and the part)."""
        raw = [b" " + x.encode() for x in parts]
        sizes = np.array(list(map(len, raw)), np.int64)
        kinds = np.array(["other" if NOT_PLAIN.search(x) else "text" if " " in x else "word" for x in parts])
        words = np.flatnonzero(kinds == "word")
        first: list[np.ndarray] = []
        count = np.zeros(len(parts), np.int64)
        if len(words):  # no token reaches over a space, so all at once
            first.append(np.array(self.ranked.encode_ordinary(" " + " ".join(parts[k] for k in words)), np.int32))
            count[words] = np.diff(np.searchsorted(np.cumsum(self.length[0][first[0]]), np.cumsum(sizes[words]), side="right"), prepend=0)
        for k in np.flatnonzero(kinds != "word"):
            # Other than plain characters are split by the library's own Unicode tables.
            ids = self.ranked.encode_ordinary(" " + parts[k]) if kinds[k] == "text" else self.library.encode(" " + parts[k], add_special_tokens=False).ids
            first.append(np.array(ids, np.int32))
            count[k] = len(ids)
        order = np.r_[words, np.flatnonzero(kinds != "word")]
        begin = np.zeros(len(parts), np.int64)
        begin[order] = np.cumsum(count[order]) - count[order]
        told = self.pieces.encode(parts, num_threads=1)
        counts = [count, np.array(list(map(len, told)), np.int64)]
        streams = [np.concatenate(first)[_places(begin, count)], np.fromiter(itertools.chain.from_iterable(told), np.int32, counts[1].sum())]
        same = np.ones(len(parts), bool)
        for spelled, ids, n in zip(self.spelled, streams, counts, strict=True):
            upto = np.append(0, np.cumsum(self.length[0 if spelled is self.spelled[0] else 1][ids]))[np.cumsum(n)]
            if not np.array_equal(upto, np.cumsum(sizes)) or b"".join(map(spelled.__getitem__, ids.tolist())) != b"".join(raw):
                ends = np.cumsum(n).tolist()
                same &= [b"".join(map(spelled.__getitem__, ids[x:y].tolist())) == r for x, y, r in zip([0, *ends], ends, raw, strict=False)]
        return streams, counts, same

    def _parts(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(distinct parts, each text's parts by their places there, and where each text's begin). Parts are words where
        both tokenizers treat each word alike wherever it stands: all spaces single, and plain characters; else whole texts."""
        whole = np.array([t[:1] == " " or bool(LOOSE.search(t) or NOT_PLAIN.search(t)) for t in texts])
        given = pa.array([t for t, w in zip(texts, whole, strict=True) if not w], pa.string())
        split = pc.split_pattern(given, " ")
        told = split.flatten().dictionary_encode()
        distinct = told.dictionary.to_pylist() + [t for t, w in zip(texts, whole, strict=True) if w]
        count = np.ones(len(texts), np.int64)
        count[~whole] = pc.list_value_length(split).to_numpy()
        begin = np.cumsum(count) - count
        code = np.empty(count.sum(), np.int64)
        code[begin[whole]] = np.arange(len(told.dictionary), len(distinct))
        code[_places(begin[~whole], count[~whole])] = told.indices.to_numpy()
        return distinct, code, begin

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """(texts that both tokenizers spell, both streams of ids of these, and the number of ids of each of them)."""
        distinct, code, begin = self._parts(texts)
        told, counts, same = self.encode(distinct)
        fits = np.minimum.reduceat(same[code], begin)
        count = np.diff(np.append(begin, len(code)))
        code = code[np.repeat(fits, count)]
        begin = np.cumsum(count[fits]) - count[fits]
        streams = [ids[_places((np.cumsum(size) - size)[code], size[code])] for ids, size in zip(told, counts, strict=True)]
        sizes = [np.add.reduceat(size[code], begin) if len(begin) else np.zeros(0, np.int64) for size in counts]
        return np.flatnonzero(fits), streams, sizes

    # Windows and their alignment.

    def align_windows(self, streams: list[np.ndarray], starts: list[np.ndarray]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """(groups as text, number of groups, links one after the other, number of links) of windows, which begin at starts in both streams."""
        a, b = streams
        ends = [np.cumsum(self.length[side][ids]) for side, ids in enumerate(streams)]
        cuts = np.union1d(*ends)  # between two cuts, one token of each side: a link
        links = a[np.searchsorted(ends[0], cuts)].astype(np.int64) * self.size_b + b[np.searchsorted(ends[1], cuts)]
        shared = np.intersect1d(*ends, assume_unique=True)
        sides = []
        for ids, end in zip(streams, ends, strict=True):
            offsets = np.append(0, np.searchsorted(end, shared) + 1).astype(np.int32)
            sides.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids).cast(pa.string())), ","))
        groups = pc.binary_join_element_wise(*sides, "|")
        until = ends[0][np.append(starts[0][1:], len(a)) - 1]  # the byte at which each window ends
        upto = np.searchsorted(shared, until) + 1
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(0, upto).astype(np.int32)), groups), ";")
        return text, np.diff(upto, prepend=0), links, np.diff(np.searchsorted(cuts, until) + 1, prepend=0)

    def find_windows(self, streams: list[np.ndarray]) -> list[np.ndarray]:
        """Where windows begin in both streams, which spell the same bytes: at spaces that begin a token in both."""
        begins = []
        for side, ids in enumerate(streams):
            size = self.length[side][ids]
            mark = np.flatnonzero(self.marked[side][ids])
            begins.append((mark, (np.cumsum(size) - size)[mark]))
        _, i, j = np.intersect1d(begins[0][1], begins[1][1], assume_unique=True, return_indices=True)
        return [begins[0][0][i], begins[1][0][j]]

    def align(self, streams: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
        """(where windows begin, which of the distinct windows each is, the alignment of these): each pair of id tuples is aligned once."""
        starts = self.find_windows(streams)
        codes, tuples = [], []
        for ids, start in zip(streams, starts, strict=True):
            offsets = np.append(start, len(ids)).astype(np.int32)
            told = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(4 * offsets), pa.py_buffer(np.ascontiguousarray(ids))]).dictionary_encode()
            codes.append(told.indices.to_numpy().astype(np.int64))
            tuples.append(told.dictionary)
        both = pa.array(codes[0] * len(tuples[1]) + codes[1]).dictionary_encode()
        parts, begins = [], []
        for of, which in zip(tuples, np.divmod(both.dictionary.to_numpy(), len(tuples[1])), strict=True):
            taken = of.take(pa.array(which))
            parts.append(np.frombuffer(b"".join(taken.to_pylist()), np.int32))
            size = pc.binary_length(taken).to_numpy().astype(np.int64) // 4
            begins.append(np.cumsum(size) - size)
        return starts, both.indices.to_numpy().astype(np.int64), self.align_windows(parts, begins)

    # Blocks of documents.

    def block(self, texts: list[str | None], digest: bool) -> dict:
        """What a block's row holds: for each text the figures and the links by their places among the block's distinct pairs, with how often each stands there."""
        at = np.array([k for k, t in enumerate(texts) if t], np.int64)
        out = {name: np.zeros(len(texts), np.int64) for name in ("n_a", "n_b", "n_groups", "n_links", "n_pairs")}
        groups = np.full(len(texts), "", object)
        empty = {"pairs": np.zeros(0, np.int64), "documents": np.zeros(0, np.int64), "place": b"", "often": b""}
        if not len(at):
            return out | {"groups": groups.tolist()} | empty
        fits, streams, sizes = self.tokens([texts[k] for k in at])
        at = at[fits]
        if not len(at):
            return out | {"groups": groups.tolist()} | empty
        out["n_a"][at], out["n_b"][at] = sizes
        starts, code, (window_groups, n_groups, window_links, each) = self.align(streams)
        first = np.searchsorted(starts[0], np.cumsum(sizes[0]) - sizes[0])  # each document begins a window
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(first, len(code)).astype(np.int32)), window_groups.take(pa.array(code))), ";").to_pylist()
        groups[at] = [hashlib.sha256(x.encode()).hexdigest() for x in joined] if digest else joined
        out["n_groups"][at] = np.add.reduceat(n_groups[code], first)
        pairs, local = np.unique(window_links, return_inverse=True)
        links = np.add.reduceat(each[code], first)
        out["n_links"][at] = links
        key = local[_places((np.cumsum(each) - each)[code], each[code])] + np.repeat(np.arange(len(at)) * len(pairs), links)
        key.sort()
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        often, (document, place) = np.diff(np.append(new, len(key))), np.divmod(key[new], len(pairs))
        del key
        out["n_pairs"][at] = np.bincount(document, minlength=len(at))
        step = np.diff(place, prepend=0)
        begins = np.flatnonzero(np.r_[True, document[1:] != document[:-1]])
        step[begins] = place[begins]
        return out | {"groups": groups.tolist(), "pairs": pairs, "documents": np.bincount(place, minlength=len(pairs)), "place": _pack(step), "often": _pack(often)}


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32, by bytes of the same weight, compressed."""
    return pa.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True) if len(numbers) else b""


def _unpack(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n).T.copy().view("<u4")[:, 0].astype(np.int64) if n else np.zeros(0, np.int64)


@functools.lru_cache(maxsize=2)
def aligner(json_text: str, model: bytes) -> Aligner:
    return Aligner(json_text, model)


COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_pairs")


def _blocks(docs: DataFrame, json_text: str, model: bytes, digest: bool) -> DataFrame:
    """One row for each block of documents."""
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
        ids, texts, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and held + len(text or "") > BLOCK_CHARACTERS:
                    yield ids, texts
                    ids, texts, held = [], [], 0
                ids.append(doc_id)
                texts.append(text)
                held += len(text or "")
        if ids:
            yield ids, texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(json_text, model)
        part = TaskContext.get().partitionId()
        for k, (ids, texts) in enumerate(blocks(batches)):
            b = own.block(texts, digest)
            longs, lists = pa.int64(), pa.list_(pa.int64())
            columns = [pa.array([part << 32 | k], longs), pa.array([ids], lists), pa.array([b["groups"]], pa.list_(pa.string())), *(pa.array([b[c]], lists) for c in (*COUNTS, "pairs", "documents")), pa.array([b["place"]], pa.binary()), pa.array([b["often"]], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "doc_id", "groups", *COUNTS, "pairs", "documents", "place", "often"])

    source = docs.select(F.col("_id").cast("long").alias("doc_id"), F.col("_text").cast("string").alias("text"))
    lists = ", ".join(f"{c} array<long>" for c in (*COUNTS, "pairs", "documents"))
    return map_batches(source, run, f"block long, doc_id array<long>, groups array<string>, {lists}, place binary, often binary")


def _scored(left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of a block, with sums over their links of what the corpus says of each pair."""
    block = left.slice(0, 1).to_pylist()[0]
    pairs = right["pair"].to_numpy()
    order = pairs.argsort()
    if not np.array_equal(pairs[order], np.array(block["pairs"], np.int64)):
        raise ValueError("a block's pairs and their counts don't fit")
    count, best = right["n"].to_numpy()[order], right["best"].to_numpy()[order]
    n_pairs = np.array(block["n_pairs"])
    step, often = _unpack(block["place"], n_pairs.sum()), _unpack(block["often"], n_pairs.sum())
    before = np.append(0, np.cumsum(step))
    ends = np.cumsum(n_pairs)
    place = before[1:] - np.repeat(before[ends - n_pairs], n_pairs)
    sums = [np.append(0, np.cumsum(often * of[place])) for of in (best, count)]
    columns = [pa.array(block[c], pa.string() if c == "groups" else pa.int64()) for c in ("doc_id", *COUNTS[:-1], "groups")]
    columns += [pa.array(s[ends] - s[ends - n_pairs]) for s in sums]
    return pa.Table.from_arrays(columns, ["doc_id", *COUNTS[:-1], "groups", "n_best", "count_sum"])


def align_tokens(docs: DataFrame, vocabulary_path: str, model_path: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every whole text.

    A's tokens are those of the byte-level vocabulary for a space and the text, B's those of the
    piece model for the text, special strings being plain text for both. groups: the ids between
    byte offsets at which both end, as `a1,a2|b1;a3|b2,b3`, or with digest its SHA-256 in lowercase
    hex. Links are the pairs of tokens whose bytes overlap. A pair of ids counts the documents
    (rows) that hold it linked anywhere in the table; count_sum is the sum over a text's links, and
    n_best how many of them have the highest count of their A id, ties included.

    Texts that are null, empty or not spelled alike by both (characters that a tokenizer changes)
    have no tokens: zeros and an empty groups, not hashed. Rows are kept one for one, null and
    repeated ids included; other columns are left out whatever their names. An empty table gives
    an empty result. Blocks hold about BLOCK_CHARACTERS of texts or one longer text; the only table
    broadcast has at most one row for each id of A.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        json_text = f.read()
    with open(model_path, "rb") as f:
        model = f.read()
    blocks = cut(_blocks(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), json_text, model, digest))
    size_b = sentencepiece.SentencePieceProcessor(model_proto=model).get_piece_size()
    held = blocks.select("block", F.explode(F.arrays_zip("pairs", "documents")).alias("x")).select("block", F.col("x.pairs").alias("pair"), F.col("x.documents").alias("documents"))
    counts = held.groupBy("pair").agg(F.sum("documents").alias("n")).withColumn("a", F.expr(f"pair div {size_b}"))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    told = counts.join(F.broadcast(most), "a").select(F.bitwise_not("pair").alias("key"), "n", (F.col("n") == F.col("most")).cast("long").alias("best"))  # dealt anew, so that a frequent pair can be split
    answers = held.select("block", "pair", F.bitwise_not("pair").alias("key")).join(told, "key").select(F.col("block").alias("of"), "pair", "n", "best")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long"
    return blocks.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(_scored, schema)
