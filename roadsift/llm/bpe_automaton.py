"""Operator 4: byte-pair encoding and decoding by a tokenization automaton.

The automaton's states stand for the token read last and its arcs are labelled with tokens.
It begins with one state and an arc for each base symbol. Each merge ``u v -> w``, in rank
order, is one gadget:

* a new state ``w`` that copies the state of ``v`` as it is at that moment;
* an arc ``w`` wherever an arc ``u`` leaves (after the next step, which matters for ``u = v``);
* the arc ``v`` out of state ``u`` is taken away, as ``u v`` would have been merged.

The result accepts exactly the token sequences that merging in rank order yields, so a word
has one accepted path. Copies share structure (a state keeps the state that it copied and
when), so the automaton needs room in proportion to the merges and not to their square.
An arc that was looked up once stays in a table.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadsift.llm.common import map_batches
from roadsift.llm.int_table import IntTable
from roadsift.llm.rank_merges import RankMerger
from roadsift.llm.pretokens import Vocabulary, WordCache, blocks, byte_symbols, plain_blocks, spread

_NEVER = 1 << 40
_ARCS = 1_000_000
#: Words that step through the tables together.
WORDS_AT_ONCE = 25_000
#: Words of more bytes than this take encode_word(), as stepping them beside short ones wastes steps.
LONG_WORD = 64


class TokenAutomaton:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        ids, suffix = vocabulary.ids, vocabulary.suffix
        size = max(ids.values(), default=-1) + 1
        self.copied, self.first, self.born = [-1] * size, [-1] * size, [0] * size
        self.cut: dict[int, int] = {}
        self.arcs: dict[int, bool] = {}
        for rank, (left, right) in enumerate(vocabulary.merges, 1):
            self._gadget(rank, ids[left], ids[right], ids[left + right])
        self.go: dict[int, int] = {}
        self.token = [-1]
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        for label, token in ids.items():
            ends = bool(suffix) and label.endswith(suffix)
            spelled = [byte_of[c] for c in (label[: -len(suffix)] if ends else label)]
            if ends and spelled:
                spelled[-1] += 256
            self._spell(spelled, token)
        self.transitions = IntTable(np.fromiter(self.go.keys(), np.int64), np.fromiter(self.go.values(), np.int64))
        self.cuts = IntTable(np.fromiter(self.cut.keys(), np.int64), np.fromiter(self.cut.values(), np.int64))
        self.tokens, self.births = np.array(self.token, np.int64), np.array(self.born, np.int64)
        self.copies, self.firsts = np.array(self.copied, np.int64), np.array(self.first, np.int64)
        self.label = {i: s for s, i in [*ids.items(), *vocabulary.special.items()]}

    def _gadget(self, rank: int, u: int, v: int, w: int) -> None:
        if self.born[w]:
            raise ValueError(f"two merges yield token {w}")
        self.copied[w], self.first[w], self.born[w] = v, u, rank
        self.cut[u << 20 | v] = rank

    def _spell(self, symbols: list[int], token: int) -> None:
        at = 0
        for s in symbols:
            key = at << 9 | s
            if key not in self.go:
                self.go[key] = len(self.token)
                self.token.append(-1)
            at = self.go[key]
        if at:
            self.token[at] = token

    def arc(self, state: int, token: int) -> bool:
        """Whether the arc ``token`` leaves ``state`` once all gadgets are built."""
        key = state << 20 | token
        known = self.arcs.get(key)
        if known is None:
            if len(self.arcs) >= _ARCS:
                self.arcs.clear()
            known = self.arcs[key] = self._resolve(state, token)
        return known

    def _resolve(self, state: int, token: int) -> bool:
        until = _NEVER
        while True:
            if self.cut.get(state << 20 | token, _NEVER) < until:
                return False
            a, b = self.born[state], self.born[token]
            if a == b == 0:
                return True
            if a >= b:  # the state is the younger: look at what it copied, as that was then
                state, until = self.copied[state], min(until, a)
            else:  # the arc is the younger: it was laid beside the arc of its first part
                token, until = self.first[token], min(until, b + 1)

    def encode_word(self, word: str) -> list[int]:
        """Tokens of one pre-split word: the accepted path.

        From each state the longest arc is tried first. A place reached by some path is reached
        by one accepted path alone, so a place from which the end can't be reached is closed for
        good and the search stays within the word's length times the longest label.
        """
        symbols = list(word.encode())
        if self.vocabulary.suffix:
            symbols[-1] += 256
        n, go, token, arc = len(symbols), self.go, self.token, self.arcs
        closed, path, places, at = set(), [], [], 0
        options: list[list[int]] = []
        while at < n:
            found, node = [], 0
            for i in range(at, n):
                node = go.get(node << 9 | symbols[i])
                if node is None:
                    break
                t = token[node]
                if t >= 0:
                    found.append(i + 1)
                    found.append(t)
            options.append(found)
            places.append(at)
            while True:
                found = options[-1]
                if not found:
                    closed.add(places[-1])
                    options.pop()
                    places.pop()
                    path.pop()
                    continue
                t, end = found.pop(), found.pop()
                if end in closed:
                    continue
                if path:
                    before = path[-1]
                    ok = arc.get(before << 20 | t)
                    if not (self.arc(before, t) if ok is None else ok):
                        continue
                path.append(t)
                at = end
                break
        return path

    def arcs_of(self, states: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """arc() of many pairs."""
        state, token, until = states.copy(), tokens.copy(), np.full(len(states), _NEVER, np.int64)
        out, left = np.zeros(len(states), bool), np.arange(len(states))
        while len(left):
            s, t, limit = state[left], token[left], until[left]
            open_ = self.cuts.get(s << 20 | t, _NEVER) >= limit
            a, b = self.births[s], self.births[t]
            base = (a == 0) & (b == 0)
            out[left[open_ & base]] = True
            on = open_ & ~base
            left, s, t, a, b, limit = left[on], s[on], t[on], a[on], b[on], limit[on]
            older = a >= b
            state[left] = np.where(older, self.copies[s], s)
            token[left] = np.where(older, t, self.firsts[t])
            until[left] = np.minimum(limit, np.where(older, a, b + 1))
        return out

    def encode_words(self, words: list[str]) -> list[bytes]:
        """encode_word() of many words at once, as little-endian unsigned 32-bit ids.

        First every arc label is found at every place by walking the transition table from all
        places together. Then places are settled by their distance from the word's start: the
        labels that end there and leave a settled state are tried, and one of them is accepted.
        """
        raw = [w.encode() for w in words]
        short = [k for k, x in enumerate(raw) if 0 < len(x) <= LONG_WORD]
        out: list[bytes] = [b""] * len(words)
        for k, x in enumerate(raw):
            if len(x) > LONG_WORD:
                out[k] = np.array(self.encode_word(words[k]), dtype="<u4").tobytes()
        if not short:
            return out
        sizes = np.array([len(raw[k]) for k in short])
        symbols = np.frombuffer(b"".join(raw[k] for k in short), np.uint8).astype(np.int64)
        stop = np.cumsum(sizes)
        if self.vocabulary.suffix:
            symbols[stop - 1] += 256
        begin = np.repeat(stop - sizes, sizes)
        starts, places, labels = self._labels(symbols, np.repeat(stop, sizes))
        state, came = np.full(len(symbols), -1, np.int64), np.zeros(len(symbols), np.int64)
        distance = places - begin[places]
        order = np.argsort(distance, kind="stable")
        starts, places, labels = starts[order], places[order], labels[order]
        cuts = np.concatenate([[0], np.cumsum(np.bincount(distance))])
        for a, b in itertools.pairwise(cuts.tolist()):
            start, place, label = starts[a:b], places[a:b], labels[a:b]
            ok = start == begin[start]
            rest = np.flatnonzero(~ok)
            before = state[start[rest] - 1]
            rest, before = rest[before >= 0], before[before >= 0]
            ok[rest] = self.arcs_of(before, label[rest])
            state[place[ok]], came[place[ok]] = label[ok], start[ok]
        owners, tokens, owner, at = [], [], np.arange(len(short)), stop - 1
        while len(owner):
            owners.append(owner)
            tokens.append(state[at])
            start = came[at]
            on = start > begin[at]
            owner, at = owner[on], start[on] - 1
        owner, token = np.concatenate(owners[::-1]), np.concatenate(tokens[::-1])
        flat = token[np.argsort(owner, kind="stable")].astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(owner))).tolist()
        for k, a, b in zip(short, [0, *ends], ends, strict=False):
            out[k] = flat[a:b]
        return out

    def _labels(self, symbols: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the first symbol, of the last one, token) of every arc label in the words."""
        walk = np.arange(len(symbols))
        node, place, found = np.zeros(len(symbols), np.int64), walk.copy(), []
        while len(walk):
            step = self.transitions.get(node << 9 | symbols[place])
            on = step >= 0
            walk, place, node = walk[on], place[on], step[on]
            label = self.tokens[node]
            some = label >= 0
            found.append((walk[some], place[some], label[some]))
            on = place + 1 < stop[walk]
            walk, place, node = walk[on], place[on] + 1, node[on]
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def joined(cache: WordCache, words: pa.Array, ends: np.ndarray) -> list[bytes]:
    """The cache's values of the words, joined from each end to the next one; each distinct word is looked up once."""
    told = words.dictionary_encode()
    distinct = told.dictionary.to_pylist()
    found = cache.many(distinct)
    values = pa.array([found[w] for w in distinct], pa.large_binary()).take(told.indices)
    at = np.frombuffer(values.buffers()[1], np.int64)[ends].tolist()
    data = values.buffers()[2].to_pybytes()
    return [data[a:b] for a, b in itertools.pairwise(at)]


class Encoder:
    """Whole texts to little-endian unsigned 32-bit ids and back, with bounded caches."""

    def __init__(self, vocabulary_json: str, method: str = "automaton"):
        self.vocabulary = Vocabulary(vocabulary_json)
        self.automaton = TokenAutomaton(self.vocabulary) if method == "automaton" else None
        self.encode_words = self.automaton.encode_words if self.automaton else RankMerger(self.vocabulary).encode_words
        self.words = WordCache(self._words)
        self.chunks = WordCache(self._pieces)

    def _words(self, words: list[str]) -> list[bytes]:
        return [ids for k in range(0, len(words), WORDS_AT_ONCE) for ids in self.encode_words(words[k : k + WORDS_AT_ONCE])]

    def _pieces(self, texts: list[str]) -> list[bytes]:
        pieces, ends = self.vocabulary.pieces_of(texts)
        return joined(self.words, pieces, ends)

    def rest(self) -> None:
        """Let go of what takes most room between tasks; the words that were met last stay."""
        self.chunks.clear()
        self.words.old = {}

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text; texts go through in blocks of bounded size."""
        for block in blocks(texts):
            yield from self._encode(block)

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        split = [self.vocabulary.split(t or "") for t in texts]
        ids = {kind: cache.many(itertools.chain.from_iterable(s for part in split for s, of, _ in part if of == kind)) for kind, cache in (("chunks", self.chunks), ("pieces", self.words))}
        return [b"".join(b"".join(map(ids[kind].__getitem__, s)) if kind else special.to_bytes(4, "little") for s, kind, special in part) for part in split]

    def encode_array(self, texts: pa.Array) -> list[bytes]:
        """encode() of an Arrow array: words of plain texts are split and told apart by Arrow, so that each distinct one is looked up once a block."""
        out: list[bytes] = [b""] * len(texts)
        for places, block, kind in plain_blocks(texts, self.vocabulary.special):
            if kind == "odd" or not self.vocabulary.lower:
                ids = list(self.encode(block.to_pylist()))
            else:
                low = pc.utf8_lower(block)
                split = pc.utf8_split_whitespace(spread(low) if kind == "simple" else low)
                ids = joined(self.words if kind == "simple" else self.chunks, split.flatten(), split.offsets.to_numpy() - split.offsets[0].as_py())
            for k, x in zip(places.tolist(), ids, strict=True):
                out[k] = x
        return out

    def decode(self, ids: bytes) -> str:
        """Arc labels joined by spaces: a model without a decoder joins its tokens so."""
        return " ".join(map(self.automaton.label.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@functools.lru_cache(maxsize=2)
def encoder(vocabulary_json: str, method: str = "automaton") -> Encoder:
    """One for each worker process, vocabulary and method."""
    return Encoder(vocabulary_json, method)


def encode_texts(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded string) of every whole text.

    Null text counts as empty: no ids, decoded "". Rows are kept one for one, null and repeated
    ids included; other columns of ``docs`` are left out, so their names can't clash. An empty
    table gives an empty result. Special strings inside a text become their special ids.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            ids = enc.encode_array(batch.column(1))
            ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
            values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
            decoded = pa.array([enc.decode(x) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), values), decoded], ["doc_id", "ids", "decoded"])
        enc.rest()

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(source, run, "doc_id long, ids array<int>, decoded string")
